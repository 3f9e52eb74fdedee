import hashlib
import random

import pytest

from sftprep import pack, training_blocks
from sftprep.operators import packing


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def stream(rows, seed, sep=None):
    def content(ids):
        return md5(",".join(map(str, (ids or []) + ([] if sep is None or ids is None else [sep]))))

    order = sorted(rows, key=lambda r: (md5(f"{seed}:{r[0]}"), content(r[1])))
    return [i for _, ids in order for i in (ids or []) + ([] if sep is None or ids is None else [sep])]


def blocks_of(flat, length):
    return [flat[i : i + length] for i in range(0, len(flat) - length + 1, length)]


def packed(df):
    got = {r["block"]: r["input_ids"] for r in df.collect()}
    assert sorted(got) == list(range(len(got)))
    return [got[b] for b in sorted(got)]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(1)
    sizes = [0, 3, 4, 5, 8, 40] + [rng.randrange(12) for _ in range(300)]
    return [(k, [rng.randrange(1000) for _ in range(n)]) for k, n in enumerate(sizes)] + [(999, None)]


@pytest.fixture(scope="module")
def df(spark, rows):
    return spark.createDataFrame(rows, "k bigint, input_ids array<int>").repartition(5)


@pytest.mark.parametrize("length", [1, 4, 7, 64])
@pytest.mark.parametrize("sep", [None, 2])
def test_blocks_are_the_stream(df, rows, length, sep):
    assert packed(pack(df, "k", length, 6, sep)) == blocks_of(stream(rows, 6, sep), length)


def test_fewer_ids_than_one_block(df):
    assert pack(df, "k", 10**6, 6).count() == 0


def test_no_rows(df):
    assert pack(df.filter("k < 0"), "k", 4, 6).count() == 0


def test_last_block_is_kept_if_asked_for(df, rows):
    flat = stream(rows, 6)
    assert len(flat) % 7
    blocks = packed(pack(df, "k", 7, 6, drop_last=False))
    assert blocks == [flat[i : i + 7] for i in range(0, len(flat), 7)]


def test_hot_key_and_copies(spark):
    """A third of the rows are copies of one row, a third share its key: one stream, and
    no task has them all."""
    rows = [(0, [1, 2, 3])] * 200 + [(0, [i]) for i in range(4, 204)]
    rows += [(k, [1000 + k]) for k in range(1, 201)]
    df = spark.createDataFrame(rows, "k bigint, input_ids array<int>").repartition(3)
    blocks = packed(pack(df, "k", 8, 6))
    assert blocks == blocks_of(stream(rows, 6), 8)
    assert packed(pack(df.repartition(11), "k", 8, 6)) == blocks


def test_labels_of_blocks(df):
    row = training_blocks(df, 4, 6, key="k").first()
    assert row["labels"] == row["input_ids"]


def test_length_must_be_positive(df):
    with pytest.raises(ValueError):
        pack(df, "k", 0, 6)


def test_payload_is_shuffled_to_the_blocks_only(df):
    """Once more after the sort, which has been written by then."""
    plan = pack(df, "k", 4, 6)._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert sum("block" in line or "_groupingexpression" in line for line in exchanges) <= 1
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_sort_compares_columns(df, monkeypatch):
    """An expression in the order would be computed anew in each comparison of tied keys."""
    plans = []

    def settled(table):
        plans.append(table._jdf.queryExecution().optimizedPlan().toString())
        return table

    monkeypatch.setattr(packing, "settle", settled)
    pack(df, "k", 4, 6)
    sorts = [line for line in plans[0].splitlines() if "Sort [" in line]
    assert len(sorts) == 1 and "md5" not in sorts[0]
    assert "md5" in plans[0]


@pytest.mark.parametrize("kind", ["tinyint", "smallint", "int", "bigint", "string"])
def test_ids_of_each_type_and_nulls(spark, kind):
    """Ids travel as bytes, and come back as they were, nulls and the type's bounds too."""
    bits = {"tinyint": 7, "smallint": 15, "int": 31, "bigint": 63}.get(kind)
    ids = [[-(2**bits), None], [2**bits - 1], [None, 0]] if bits else [["a,b", None], [""], [None, "é"]]
    df = spark.createDataFrame([*enumerate(ids), (9, []), (10, None)], f"k bigint, input_ids array<{kind}>")
    flat = [i for k in sorted(range(3), key=lambda k: md5(f"6:{k}")) for i in ids[k]]
    out = pack(df, "k", 2, 6, drop_last=False)
    assert out.schema["input_ids"].dataType.simpleString() == f"array<{kind}>"
    assert packed(out) == [flat[i : i + 2] for i in range(0, len(flat), 2)]


def test_integers_travel_as_bytes(df, monkeypatch):
    """An array is written, read and cut id by id."""
    tables = []
    monkeypatch.setattr(packing, "settle", lambda table: tables.append(table) or table)
    pack(df, "k", 4, 6)
    assert tables[0].schema["_ids"].dataType.simpleString() == "binary"
