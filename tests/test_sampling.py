import hashlib
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sftprep import (
    pick_row,
    row_at,
    sample_n,
    shuffle_by_hash,
    take_n,
    train_test_split,
    with_row_key,
)
from sftprep.operators import keys, ranks, sampling


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(2000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))


@pytest.fixture
def large(monkeypatch):
    """Take every row for one of many, and every counting step."""
    monkeypatch.setattr(sampling, "ONE_TASK_ROWS", 0)
    monkeypatch.setattr(ranks, "FEW_ROWS", 0)


def ranked(seed, ids):
    return sorted(ids, key=lambda k: hashlib.md5(f"{seed}:{k}".encode()).hexdigest())


def ids(df):
    return [r["k"] for r in df.collect()]


def test_shuffle_order(rows):
    assert ids(shuffle_by_hash(rows, "k", 7)) == ranked(7, range(2000))


@pytest.mark.parametrize("n", [0, 1, 100, 2000])
def test_sample_is_a_prefix_of_the_order(rows, n):
    assert ids(sample_n(rows, "k", n, 7)) == ranked(7, range(2000))[:n]


@pytest.mark.parametrize("n", [1, 2, 777, 1999, 2000])
def test_large_sample_equals_small_one(rows, large, n):
    assert ids(sample_n(rows, "k", n, 7)) == ranked(7, range(2000))[:n]


@pytest.mark.parametrize("n", [1, 777, 2000])
def test_positions_of_a_sample(rows, large, n):
    got = sample_n(rows, "k", n, 7, position="at").collect()
    assert sorted((r["at"], r["k"]) for r in got) == list(enumerate(ranked(7, range(2000))[:n]))


def test_positions_of_all_rows(rows):
    got = shuffle_by_hash(rows.repartition(9), "k", 7, position="at")
    assert got.columns == ["k", "v", "at"]
    assert sorted((r["at"], r["k"]) for r in got.collect()) == list(enumerate(ranked(7, range(2000))))


@pytest.mark.parametrize("n", [0, 1, 700, 2000])
def test_first_rows(rows, large, n):
    got = take_n(rows.repartition(7).orderBy(F.desc("k")), n)
    assert ids(got) == list(range(1999, 1999 - n, -1))


def test_no_task_gathers_the_first_rows(rows, large):
    plan = take_n(rows, 700)._jdf.queryExecution().executedPlan().toString()
    assert "GlobalLimit" not in plan and "CollectLimit" not in plan


def test_large_sample_does_not_sort_or_shuffle_rows(rows, large):
    plan = sample_n(rows, "k", 500, 7, ordered=False)._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "Exchange" not in plan


def test_more_rows_than_there_are(rows, monkeypatch):
    with pytest.raises(ValueError):
        sample_n(rows, "k", 2001, 7)
    assert sample_n(rows, "k", 2001, 7, strict=False).count() == 2000
    with pytest.raises(ValueError):
        take_n(rows, 2001)
    assert take_n(rows, 2001, strict=False).count() == 2000
    with pytest.raises(ValueError):
        sample_n(rows, "k", -1, 7)
    monkeypatch.setattr(sampling, "ONE_TASK_ROWS", 10)
    with pytest.raises(ValueError):
        sample_n(rows, "k", 2001, 7)
    assert sample_n(rows, "k", 2001, 7, strict=False).count() == 2000


@pytest.mark.parametrize("share", [0.8, 0.2, 0.25, 1000 / 4000, 0.333, 0.0001, 100])
def test_split_sizes_are_exact(rows, share):
    splits = train_test_split(rows, "k", share, 3)
    test = sorted(ids(splits.filter("split = 'test'")))
    train = sorted(ids(splits.filter("split = 'train'")))
    n = math.ceil(share * 2000) if isinstance(share, float) else share
    assert test == sorted(ranked(3, range(2000))[:n])
    assert sorted(test + train) == list(range(2000))


@pytest.mark.parametrize("size", [0.0, 1.0, 1.5, -0.1, 0, 2000, 5000, 0.9999])
def test_bad_split_sizes(rows, size):
    with pytest.raises(ValueError):
        train_test_split(rows, "k", size, 3)


def test_split_of_nothing(spark):
    with pytest.raises(ValueError):
        train_test_split(spark.range(0), "id", 0.5, 3)


def test_same_rows_for_any_partitioning(rows):
    for parts in (1, 3, 17):
        again = train_test_split(rows.repartition(parts), "k", 0.3, 5)
        assert sorted(ids(again.filter("split = 'test'"))) == sorted(ranked(5, range(2000))[:600])


def test_other_seed_other_rows(rows):
    assert ids(sample_n(rows, "k", 20, 1)) != ids(sample_n(rows, "k", 20, 2))


def test_positions(rows):
    order = ranked(9, range(2000))
    for i in (0, 345, 1999):
        assert ids(row_at(rows, "k", i, 9)) == [order[i]]
    for i in (-1, 2000):
        with pytest.raises(IndexError):
            row_at(rows, "k", i, 9)
    assert ids(pick_row(rows, "k", 9)) == order[:1]


def test_one_key_with_a_third_of_the_rows(spark, large):
    """Same key, different content, the cut in the middle of them."""
    df = spark.range(900).select(
        F.when(F.col("id") < 300, F.lit(-1)).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("v"),
    )
    order = ranked(4, {-1, *range(300, 900)})
    middle = order.index(-1) + 150
    assert 0 < middle
    kept = sample_n(df, "k", middle, 4).collect()
    assert len(kept) == middle
    assert sum(r["k"] == -1 for r in kept) == 150
    assert len({r["v"] for r in kept}) == middle
    again = sample_n(df.repartition(5), "k", middle, 4).collect()
    assert {r["v"] for r in again} == {r["v"] for r in kept}
    splits = train_test_split(df, "k", middle, 4)
    assert {r["v"] for r in splits.filter("split = 'test'").collect()} == {r["v"] for r in kept}
    assert splits.select("v").distinct().count() == 900


@pytest.mark.parametrize("more", [[], ["1 as v"]])
def test_copies_that_are_a_third_of_the_rows(spark, large, more):
    rows = [("copy",)] * 300 + [(f"t{i}",) for i in range(600)]
    df = spark.createDataFrame(rows, "k string").repartition(7).selectExpr("k", *more)
    order = ranked(4, {r[0] for r in rows})
    cut = order.index("copy") + 123
    counts = Counter(r["k"] for r in sample_n(df, "k", cut, 4).collect())
    assert sum(counts.values()) == cut and counts["copy"] == 123
    splits = Counter((r["split"], r["k"]) for r in train_test_split(df, "k", cut, 4).collect())
    assert splits["test", "copy"] == 123 and splits["train", "copy"] == 177
    assert sum(splits.values()) == 900
    assert ids(row_at(df, "k", order.index("copy") + 200, 4)) == ["copy"]


def test_row_key(spark, monkeypatch):
    monkeypatch.setattr(keys, "COPIES_PER_CHUNK", 40)
    rows = [("copy", None)] * 300 + [(f"t{i}", [i]) for i in range(600)] + [(None, None)] * 2
    df = spark.createDataFrame(rows, "text string, tags array<bigint>")
    keyed = with_row_key(df, "key")
    assert keyed.columns == ["key", "text", "tags"]
    got = keyed.collect()
    assert len({r["key"] for r in got}) == len(rows)
    assert Counter((r["text"], str(r["tags"])) for r in got) == Counter(
        (t, str(tags)) for t, tags in rows
    )
    again = {r["key"] for r in with_row_key(df.repartition(9), "key").collect()}
    assert again == {r["key"] for r in got}


def test_null_key(spark):
    df = spark.createDataFrame([(None, 1), (1, 2), (2, 3)], "k int, v int")
    splits = train_test_split(df, "k", 1, 5)
    assert splits.groupBy("split").count().filter("split = 'test'").first()["count"] == 1


def test_rows_that_differ_below_a_millisecond_are_all_kept(spark):
    rows = spark.sql(
        "select 1 as id, timestamp'2024-01-01 00:00:00.123456' as at union all "
        "select 1, timestamp'2024-01-01 00:00:00.123999' union all select 2, null"
    )
    split = train_test_split(rows, "id", 1, seed=3)
    assert sorted(map(str, split.select("at").collect())) == sorted(map(str, rows.select("at").collect()))
    assert with_row_key(rows).select("example_id").distinct().count() == 3


def test_maps_and_tied_keys(spark, large):
    """Rows with maps, at any depth, that share a key: equal maps are equal in any order."""
    df = spark.sql(
        "select id, cast(id % 3 as int) as k, map('a', id, 'b', 1L) as facts,"
        " array(named_struct('m', map(id, map('x', id % 2)))) as deep, cast(null as map<int,int>) as none"
        " from range(90)"
    )
    for n in (1, 31, 45, 89):
        split = train_test_split(df, "k", n, seed=3)
        test = [r["id"] for r in split.filter("split = 'test'").collect()]
        assert len(test) == n and split.select("id").distinct().count() == 90
        again = train_test_split(df.repartition(4), "k", n, seed=3)
        assert sorted(test) == sorted(r["id"] for r in again.filter("split = 'test'").collect())
        order = [r["id"] for r in sample_n(df, "k", n, seed=3).collect()]
        assert sorted(order) == sorted(test)
        assert order == [r["id"] for r in shuffle_by_hash(df.repartition(5), "k", 3).collect()][:n]
        assert row_at(df, "k", n - 1, 3).first()["id"] == order[-1]
    one = spark.sql("select map('a', 1, 'b', 2) as m")
    other = spark.sql("select map('b', 2, 'a', 1) as m")
    assert one.select(keys.row_hash(one)).first() == other.select(keys.row_hash(other)).first()


def test_copies_of_rows_with_maps_are_the_rows_themselves(spark, large):
    df = spark.sql("select 1 as k, map('a', 1) as m from range(20) union all select 2, map('b', 2) from range(5)")
    split = train_test_split(df, "k", 7, seed=1)
    assert split.filter("split = 'test'").count() == 7 and split.count() == 25
    assert split.filter("k = 1 and m['a'] = 1").count() == 20
