import pytest
from pyspark.sql import functions as F

import sftprep as S

SCHEMA = "example_id bigint, context string, question string, answer string"


@pytest.fixture(scope="module")
def examples(spark):
    rows = [(i, f"c{i}", f"q{i}", f"SELECT {i}") for i in range(50)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize(
    "pred, answer, plain, normal",
    [
        ("select 1", "select 1", 1, 1),
        ("select 1", "SELECT 1", 0, 0),
        ("select 1", "select 1 ", 0, 1),
        ("", "", 1, 1),
        (None, "a", 0, 0),
        ("a", None, 0, 0),
        (None, None, 0, 0),
    ],
)
def test_exact_match(spark, pred, answer, plain, normal):
    df = spark.createDataFrame([(pred, answer)], "p string, a string")
    assert df.select(S.exact_match("p", "a")).first()[0] == plain
    assert df.select(S.exact_match("p", "a", normalize=True)).first()[0] == normal


def test_missing_predictions_count(spark, examples):
    preds = spark.createDataFrame(
        [(i, f"SELECT {i}" if i < 20 else None) for i in range(30)],
        "example_id bigint, prediction string",
    )
    pairs = S.pair_predictions(examples, preds)
    scored = pairs.withColumn("score", S.exact_match("prediction", "answer"))
    assert tuple(S.accuracy(scored).first()) == (50, 20, 0.4)


def test_accuracy_of_nothing_and_of_groups(spark):
    df = spark.createDataFrame([("a", 1), ("a", 0), ("b", 1)], "g string, score int")
    assert tuple(S.accuracy(df.filter("g = 'c'")).first()) == (0, 0, None)
    got = {r["g"]: (r["n"], r["hits"], r["accuracy"]) for r in S.accuracy(df, by="g").collect()}
    assert got == {"a": (2, 1, 0.5), "b": (1, 1, 1.0)}


@pytest.mark.parametrize(
    "share, text",
    [
        (0.592, "59.20%"), (1.0, "100.00%"), (0.0, "0.00%"), (None, None),
        (0.02675, "2.67%"), (0.01005, "1.00%"), (0.59205, "59.20%"), (0.00145, "0.14%"), (0.00125, "0.12%"),
    ],
)
def test_percent(spark, share, text):
    assert spark.range(1).select(S.percent(F.lit(share))).first()[0] == text


def test_flag_share(spark):
    df = spark.createDataFrame(
        [("a", 3, True), ("a", 1, False), ("a", 4, None), ("b", 2, False), ("c", 0, True)],
        "g string, v int, flag boolean",
    )
    assert tuple(S.flag_share(df, "v", "flag").first()) == (10, 3, 30.0)
    got = {r["g"]: tuple(r)[1:] for r in S.flag_share(df, "v", "flag", by="g").collect()}
    assert got == {"a": (8, 3, 37.5), "b": (2, 0, 0.0), "c": (0, 0, None)}


def test_report(spark):
    df = spark.createDataFrame(
        [(1, "q%", "a", "p"), (2, "q", "a", None)],
        "example_id bigint, question string, answer string, prediction string",
    )
    got = {r["example_id"]: r["report"] for r in S.sample_report(df, 2, seed=1).collect()}
    assert got == {
        1: "User: q%\ne: a\ni: p\n" + "-" * 50,
        2: "User: q\ne: a\ni: \n" + "-" * 50,
    }


def test_summary(spark, examples):
    splits = S.train_test_split(examples, "example_id", 0.2, 1)
    got = {r["split"]: (r["n_rows"], r["columns"]) for r in S.summarize(splits).collect()}
    columns = "example_id, context, question, answer"
    assert got == {"train": (40, columns), "test": (10, columns)}
    assert tuple(S.summarize(examples).first()) == (50, columns)
