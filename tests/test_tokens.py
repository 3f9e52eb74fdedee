import random
import re
from collections import Counter

import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import sftprep as S
from sftprep.functions import tokens as tokens_module
from sftprep.operators import vocabulary


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def one(spark, column, ids):
    return spark.createDataFrame([(ids,)], "ids array<int>").select(column).first()[0]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(max_size=30), min_size=40, max_size=40))
def test_tokens_join_to_the_text(spark, texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    assert [r[0] for r in df.select(F.array_join(S.tokenize("text"), "")).collect()] == texts


def test_tokens(spark):
    df = spark.createDataFrame([("SELECT a_1,  'é😀'\n",), ("",), (None,)], "text string")
    got = [r[0] for r in df.select(S.tokenize("text")).collect()]
    assert got == [["SELECT", " ", "a_1", ",", "  ", "'", "é", "😀", "'", "\n"], [], None]


def test_tokens_in_batches(spark, monkeypatch):
    """The same tokens, wherever a stretch of bytes ends; slices and nulls too."""
    draw = random.Random(5)
    texts = [
        None if i % 9 == 4 else "".join(draw.choices("aZ_9 \t\n\r\f\x0b\x00.,é😀ß", k=draw.randrange(12)))
        for i in range(200)
    ]
    df = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(2)
    assert df.select(S.tokenize("text", in_batches=True)).collect() == df.select(S.tokenize("text")).collect()
    want = [None if t is None else re.findall(tokens_module.TOKEN_PATTERN, t) for t in texts]
    for stretch in (1, 2, 3, 7):
        monkeypatch.setattr(tokens_module, "_STRETCH", stretch)
        assert tokens_module._token_arrays(pa.array(["zz", *texts]).slice(1)).to_pylist() == want


LENGTHS = [0, 3, 4, 5, 8]


@pytest.mark.parametrize("n", LENGTHS)
def test_truncate_and_pad(spark, n):
    ids = list(range(10, 10 + n))
    assert one(spark, S.append_eos("ids", 1), ids) == ids + [1]
    assert one(spark, S.truncate("ids", 4), ids) == ids[:4]
    assert one(spark, S.truncate("ids", 4, "left"), ids) == ids[-4:]
    assert one(spark, S.was_truncated("ids", 4), ids) == (n > 4)
    assert one(spark, S.prepend_bos("ids", 1), ids) == [1] + ids
    assert one(spark, S.truncate_with_eos("ids", 4, 1), ids) == ids[:3] + [1]
    fill = [0] * max(0, 4 - n)
    assert one(spark, S.pad_ids("ids", 4, 0), ids) == ids + fill
    assert one(spark, S.pad_ids("ids", 4, 0, "left"), ids) == fill + ids
    assert one(spark, S.attention_mask("ids", 4), ids) == [1] * n + fill
    assert one(spark, S.attention_mask("ids", 4, "left"), ids) == fill + [1] * n


def test_null_ids(spark):
    for column in (
        S.append_eos("ids", 1), S.truncate("ids", 4), S.truncate("ids", 4, "left"),
        S.pad_ids("ids", 4, 0), S.attention_mask("ids", 4),
    ):
        assert one(spark, column, None) is None


def test_bad_side():
    for call in (lambda: S.truncate("ids", 4, "up"), lambda: S.pad_ids("ids", 4, 0, "up")):
        with pytest.raises(ValueError):
            call()


def test_labels(spark):
    df = spark.createDataFrame([([5, 2, 6],)], "input_ids array<int>")
    rows = S.pad(df, 5, pad_id=2)
    assert S.add_labels(rows).first()["labels"] == [5, 2, 6, 2, 2]
    assert S.add_labels(rows, ignore_index=-100).first()["labels"] == [5, 2, 6, -100, -100]


# Vocabulary ------------------------------------------------------------------

TEXTS = ["the cat the dog", "the <eos> bird", "", None, "zz the"]


@pytest.fixture(scope="module")
def tokens(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "k bigint, text string")
    return df.withColumn("tokens", S.tokenize("text")).drop("text")


@pytest.fixture(scope="module")
def vocab(tokens):
    return S.settle(S.build_vocab(tokens, "tokens", ["<unk>", "<eos>"], 100))


def test_vocabulary_order(vocab):
    rows = vocab.orderBy("id").collect()
    assert [r["id"] for r in rows] == list(range(len(rows)))
    assert [(r["token"], r["n"], r["is_special"]) for r in rows[:4]] == [
        ("<unk>", 0, True), ("<eos>", 0, True), (" ", 6, False), ("the", 4, False),
    ]
    assert [r["token"] for r in rows[4:]] == sorted(r["token"] for r in rows[4:])


def test_vocabulary_size(tokens):
    top = S.build_vocab(tokens, "tokens", ["<unk>"], 3)
    assert [r["token"] for r in top.orderBy("id").collect()] == ["<unk>", " ", "the"]
    assert S.build_vocab(tokens, "tokens", [], 2).count() == 2
    with pytest.raises(ValueError):
        S.build_vocab(tokens, "tokens", ["a", "b"], 1)


@pytest.mark.parametrize("size", [2, 3, 5, 9, 50])
def test_smaller_vocabulary_is_the_start_of_a_larger(tokens, vocab, size):
    got = S.build_vocab(tokens, "tokens", ["<unk>", "<eos>"], size).orderBy("id").collect()
    assert got == vocab.orderBy("id").limit(size).collect()


def test_vocabulary_in_many_ranges(spark):
    """Ids from many tasks are the ranks of all tokens together."""
    words = [f"w{i % 700}" for i in range(3000)] + ["x"] * 50
    df = spark.createDataFrame([(words[i::20],) for i in range(20)], "tokens array<string>")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = S.build_vocab(df, "tokens", ["<unk>"]).orderBy("id").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    counts = Counter(words)
    order = sorted(counts, key=lambda t: (-counts[t], t.encode()))
    assert [(r["token"], r["id"]) for r in rows] == list(zip(["<unk>", *order], range(702), strict=True))


def test_vocabulary_tokenizes_once(tokens, monkeypatch):
    plans = []
    monkeypatch.setattr(vocabulary, "settle", lambda df: plans.append(optimized(df)) or df)
    S.build_vocab(tokens, "tokens", [], 10)
    assert plans[0].count("regexp_extract_all") == 1


def test_special_id(vocab):
    assert tuple(S.special_id(vocab, "<eos>").first()) == ("<eos>", 1)
    assert S.special_id(vocab, "the").count() == 0


def decoded(df, vocab, **kwargs):
    return {r["k"]: r["text"] for r in S.decode(df, vocab, **kwargs).collect()}


#: Both ways of translating: with two only, the first entries are looked up.
SIZES = pytest.mark.parametrize("size", [vocabulary.LOOKUP_ROWS, 5, 2, 0])


@SIZES
def test_round_trip(tokens, vocab, size):
    ids = S.encode(tokens, vocab, lookup_rows=size)
    assert ids.columns == ["k", "tokens", "input_ids"]
    assert decoded(ids, vocab, lookup_rows=size) == dict(enumerate(TEXTS))
    over = S.encode(tokens, vocab, out="tokens", lookup_rows=size)
    assert over.columns == ["k", "tokens"]
    back = over.withColumnRenamed("tokens", "input_ids")
    assert decoded(back, vocab, lookup_rows=size) == dict(enumerate(TEXTS))


@SIZES
def test_unknown_tokens(spark, vocab, size):
    df = spark.createDataFrame([(1, ["the", "new", "cat", None])], "k bigint, tokens array<string>")
    of = {r["token"]: r["id"] for r in vocab.collect()}
    with_unknown = S.encode(df, vocab, unknown=0, lookup_rows=size).first()["input_ids"]
    assert with_unknown == [of["the"], 0, of["cat"], 0]
    assert S.encode(df, vocab, lookup_rows=size).first()["input_ids"] == [of["the"], of["cat"]]


@SIZES
@pytest.mark.parametrize("unknown", [None, 99])
def test_rows_without_a_key(spark, size, unknown):
    """Rows of one key, null keys, null and repeated tokens, null and empty arrays."""
    vocab = spark.createDataFrame(
        [(c, i, 9 - i, False) for i, c in enumerate("abcdefgh")], "token string, id int, n long, is_special boolean"
    )
    rows = [
        (1, ["a", "h", "h", "q"]), (1, ["b", "g"]), (None, ["c", "f"]), (None, None), (2, [None, "a"]),
        (2, []), (3, ["h"] * 5 + ["q"] * 5), (3, ["h"] * 5 + ["q"] * 5),
    ]
    df = spark.createDataFrame(rows, "k int, tokens array<string>").repartition(3)

    def ids(tokens):
        if tokens is None:
            return None
        found = [unknown if t is None or t not in "abcdefgh" else ord(t) - 97 for t in tokens]
        return [i for i in found if i is not None]

    got = S.encode(df, vocab, unknown=unknown, lookup_rows=size).select("k", "input_ids").collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(repr((k, ids(t))) for k, t in rows)


def test_hot_elements_are_looked_up(spark, monkeypatch):
    """One that most rows have, known or not, is no key of the join."""
    monkeypatch.setattr(vocabulary, "HOT_SHARE", 0.1)
    vocab = spark.createDataFrame(
        [(f"t{i}", i, 1, False) for i in range(300)], "token string, id int, n long, is_special boolean"
    )
    rows = [(i, ["t299", f"t{i}", "new"]) for i in range(200)]
    df = spark.createDataFrame(rows, "k int, tokens array<string>")
    ids = S.encode(df, vocab, unknown=-1, lookup_rows=10)
    assert {r["k"]: r["input_ids"] for r in ids.collect()} == {i: [299, i, -1] for i, _ in rows}


def test_elements_are_joined_once_for_a_block(spark, monkeypatch):
    """Not once for each row that has them."""
    tables = []

    def settled(df):
        tables.append(S.settle(df))
        return tables[-1]

    vocab = spark.createDataFrame(
        [(f"t{i}", i, 1, False) for i in range(300)], "token string, id int, n long, is_special boolean"
    )
    tokens = [f"t{i}" for i in range(250, 300)]
    df = spark.createDataFrame([(tokens,)] * 200, "tokens array<string>").coalesce(2)
    monkeypatch.setattr(vocabulary, "settle", settled)
    ids = S.encode(df, vocab, unknown=-1, lookup_rows=10)
    assert [r["input_ids"] for r in ids.select("input_ids").collect()] == [list(range(250, 300))] * 200
    assert tables[0].select(F.explode("_coded.elements")).count() <= 2 * 50


@pytest.mark.parametrize("most", [1, 3, 16])
def test_blocks_within_a_batch(spark, monkeypatch, most):
    monkeypatch.setattr(vocabulary, "BLOCK_ELEMENTS", most)
    vocab = spark.createDataFrame(
        [(f"t{i}", i, 1, False) for i in range(40)], "token string, id int, n long, is_special boolean"
    )
    rows = [(k, None if k % 11 == 3 else [None if j % 7 == 6 else f"t{(k * j) % 50}" for j in range(k % 9)]) for k in range(90)]
    df = spark.createDataFrame(rows, "k int, tokens array<string>").coalesce(2)
    for unknown in (None, -1):
        want = {}
        for k, tokens in rows:
            found = [int(t[1:]) if t and int(t[1:]) < 40 else unknown for t in tokens or []]
            want[k] = None if tokens is None else [i for i in found if i is not None]
        ids = S.encode(df, vocab, unknown=unknown, lookup_rows=5)
        assert {r["k"]: r["input_ids"] for r in ids.collect()} == want


@pytest.mark.parametrize("in_batches", [False, True])
def test_column_in_blocks(spark, tokens, monkeypatch, in_batches):
    """Arrays are computed once, and give the vocabulary and ids that they give themselves."""
    plans = []

    def settled(df):
        plans.append(optimized(df))
        return S.settle(df)

    texts = spark.createDataFrame(list(enumerate(TEXTS)) * 2, "k bigint, text string")
    df = texts.select("k", S.tokenize("text", in_batches).alias("tokens"))
    specials = ["<unk>", "<eos>"]
    want = S.build_vocab(df, "tokens", specials).orderBy("id").collect()
    ids = S.encode(df, S.build_vocab(df, "tokens", specials), out="tokens", unknown=0).collect()
    monkeypatch.setattr(vocabulary, "settle", settled)
    blocks = S.in_blocks(df)
    vocab = S.build_vocab(blocks, "tokens", specials)
    assert vocab.orderBy("id").collect() == want
    encoded = S.encode(blocks, vocab, out="tokens", unknown=0)
    assert encoded.columns == ["k", "tokens"]
    assert sorted(map(repr, encoded.collect())) == sorted(map(repr, ids))
    # nor do the arrays leave Python between the two functions
    tokenizer = "_token_arrays" if in_batches else "regexp_extract_all"
    assert [p.count(tokenizer) for p in plans] == [1, 0]
    assert plans[0].count("ArrowEvalPython") == 1


def test_many_codes_in_a_block(spark):
    """More different tokens than two bytes can number, and nulls."""
    n = 70_000
    tokens = [None, *(f"t{i}" for i in range(n)), "t0", None]
    df = spark.createDataFrame([(tokens,), (["t5"],), (None,)], "tokens array<string>").coalesce(1)
    vocab = spark.range(n).selectExpr(
        "concat('t', id) as token", "cast(id as int) as id", "1L as n", "false as is_special"
    )
    got = [r[0] for r in S.encode(S.in_blocks(df), vocab, unknown=-1).collect()]
    assert sorted(got, key=repr) == sorted([[-1, *range(n), 0, -1], [5], None], key=repr)


def test_token_with_two_ids(spark):
    vocab = spark.createDataFrame([("a", 0, 1, False), ("a", 1, 1, False)], "token string, id int, n long, is_special boolean")
    df = spark.createDataFrame([(["a"],)], "tokens array<string>")
    with pytest.raises(Exception, match="more than once"):
        S.encode(df, vocab, lookup_rows=0).collect()


@pytest.mark.parametrize("out", ["text", "input_ids", "other"])
def test_decoded_column_takes_its_place(spark, vocab, out):
    df = spark.createDataFrame([("x", [2, 3], 7), ("y", None, 8), ("z", [], 9)], "text string, input_ids array<int>, k int")
    near, far = (S.decode(df, vocab, out=out, lookup_rows=n) for n in (vocabulary.LOOKUP_ROWS, 0))
    assert near.columns == far.columns
    assert sorted(map(repr, near.collect())) == sorted(map(repr, far.collect()))


def test_long_rows(spark):
    """Many different rare tokens in one row."""
    n = 20_000
    vocab = spark.range(n).selectExpr(
        "concat('t', id) as token", "cast(id as int) as id", "1L as n", "false as is_special"
    )
    tokens = [f"t{(7 * i) % n}" for i in range(n)] + ["t19999"]
    df = spark.createDataFrame([(tokens,)], "tokens array<string>")
    ids = S.encode(df, vocab, unknown=-1, lookup_rows=100)
    assert ids.first()["input_ids"] == [int(t[1:]) for t in tokens]
    text = S.decode(ids, vocab, lookup_rows=100)
    assert text.first()["text"] == "".join(tokens)


@SIZES
def test_skip_special(spark, vocab, size):
    of = {r["token"]: r["id"] for r in vocab.collect()}
    df = spark.createDataFrame([(1, [of["the"], 1, 0, of["zz"]])], "k bigint, input_ids array<int>")
    assert decoded(df, vocab, lookup_rows=size) == {1: "thezz"}
    assert decoded(df, vocab, skip_special=False, lookup_rows=size) == {1: "the<eos><unk>zz"}


@pytest.mark.parametrize(
    "use",
    [
        lambda ids: ids,
        lambda ids: ids.drop("tokens"),
        lambda ids: ids.filter(F.size("input_ids") > 1),
        lambda ids: ids.select("k", F.size("input_ids"), F.array_join("input_ids", ",")),
        lambda ids: ids.select("tokens", "k", F.size("tokens"), "input_ids"),
        lambda ids: ids.withColumn("input_ids", S.append_eos("input_ids", 1)).drop("tokens"),
    ],
)
def test_no_row_carries_the_lookup_table(tokens, vocab, use):
    for source in (tokens, tokens.withColumn("r", F.rand(1)), tokens.filter("k > 0")):
        for unknown in (0, None):
            plan = optimized(use(S.encode(source, vocab, unknown=unknown)))
            assert "scalar-subquery" in plan and "_lookup" not in plan


def test_no_row_carries_the_lookup_table_back(tokens, vocab):
    ids = S.encode(tokens, vocab, unknown=0)
    assert "_lookup" not in optimized(S.decode(ids, vocab))
    assert "_lookup" not in optimized(S.decode(S.settle(ids), vocab))


def test_encode_moves_no_rows(tokens, vocab):
    plan = optimized(S.encode(tokens, vocab, unknown=0))
    rows = [line for line in plan.splitlines() if not line.lstrip().startswith(":")]
    assert all("Project" in line or "LogicalRDD" in line or "LocalRelation" in line for line in rows)


def test_blocks_of_a_batch_are_even(spark, monkeypatch):
    """A short block behind a long one has most of its dictionary once more."""
    monkeypatch.setattr(vocabulary, "BLOCK_ELEMENTS", 20)
    df = spark.createDataFrame([(["a"],)] * 26, "tokens array<string>").coalesce(1)
    rows = S.in_blocks(df).rows
    assert [r["count"] for r in rows.groupBy("_coded.block").count().collect()] == [13, 13]


def test_entries_of_dictionaries_are_not_put_together_first(spark):
    """They are shuffled to their block's rows from the join, with no shuffle between."""
    vocab = spark.createDataFrame([("a", 0, 1, False)], "token string, id int, n long, is_special boolean")
    ids = S.encode(S.in_blocks(spark.createDataFrame([(["a"],)], "tokens array<string>")), vocab, unknown=1)
    plan = optimized(ids)
    assert "collect_list" not in plan and plan.count("RepartitionByExpression") == 1


def test_join_ids(spark):
    """The text that ``array_join`` gives, from batches."""
    rows = [([1, None, -(2**63)],), ([],), ([None],), (None,), ([2**63 - 1, 0],)]
    for kind, some in (("bigint", rows), ("int", [([1, None, -5],), ([],), ([None],), (None,)])):
        df = spark.createDataFrame(some, f"ids array<{kind}>").coalesce(1)
        got = df.select(S.join_ids("ids").alias("a"), F.array_join("ids", ",").alias("b")).collect()
        assert all(r["a"] == r["b"] for r in got) and len(got) == len(some)
