import os
import subprocess
import sys
from pathlib import Path

import pytest

from sftprep import format_batches, map_batches, predict_batches


@pytest.fixture(scope="module")
def df(spark):
    rows = [(i, f"text {i}", [i, i + 1], None if i % 3 else "x") for i in range(100)]
    return spark.createDataFrame(rows, "k bigint, text string, ids array<int>, tag string").repartition(4)


def test_columns_are_merged(df):
    out = map_batches(
        df,
        lambda b: {"n": [len(t) for t in b["text"]], "tag": [str(t) for t in b["tag"]]},
        "n int, tag string",
        drop=["text"],
    )
    assert out.columns == ["k", "ids", "n", "tag"]
    rows = {r["k"]: r for r in out.collect()}
    assert len(rows) == 100
    assert rows[10]["n"] == 7 and rows[10]["ids"] == [10, 11] and rows[10]["tag"] == "None"
    assert rows[9]["tag"] == "x"


@pytest.mark.parametrize("arrow_rows", ["7", "10000"])
def test_batches_have_the_size_asked_for(spark, df, arrow_rows):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", arrow_rows)
    try:
        out = map_batches(
            df.coalesce(1),
            lambda b: {"rows": [len(b["k"])] * len(b["k"])},
            "rows int",
            batch_size=30,
            inputs=["k"],
        ).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(r["rows"] for r in out) == [10] * 10 + [30] * 90
    assert sorted(r["k"] for r in out) == list(range(100))


def test_rows_one_by_one(df):
    out = map_batches(
        df, lambda r: {"ids": r["ids"] + [r["k"]]}, "ids array<int>", batched=False, drop=["tag"]
    )
    assert {r["k"]: r["ids"] for r in out.collect()}[5] == [5, 6, 5]


def test_row_count_may_change_only_without_kept_columns(df):
    def double(batch):
        return {"t": batch["text"] * 2}

    assert map_batches(df, double, "t string", drop=df.columns).count() == 200
    with pytest.raises(Exception, match="drop the input columns"):
        map_batches(df, double, "t string").collect()


def test_only_needed_columns_are_read(spark, df, tmp_path):
    df.write.parquet(str(tmp_path / "t"))
    out = map_batches(
        spark.read.parquet(str(tmp_path / "t")),
        lambda b: {"n": [len(t) for t in b["text"]]},
        "n int",
        drop=["text", "ids", "tag"],
        inputs=["text"],
    )
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<k:bigint,text:string>" in plan
    assert "Exchange" not in plan


def test_format_batches(df):
    out = format_batches(df.select("k", "text"), lambda b: [t for t in b["text"] if "5" in t])
    assert out.columns == ["text"]
    assert out.count() == sum("5" in str(i) for i in range(100))


def test_predictor_is_built_once_per_partition(df):
    def factory():
        calls = []

        def predict(prompts):
            calls.append(len(prompts))
            return [f"{p} -> {len(calls)}" for p in prompts]

        return predict

    out = predict_batches(df.coalesce(1), factory, prompt_col="text", batch_size=40)
    assert out.columns == ["k", "text", "ids", "tag", "raw"]
    raw = [r["raw"] for r in out.collect()]
    assert sorted(r.rsplit(" ", 1)[1] for r in raw) == ["1"] * 40 + ["2"] * 40 + ["3"] * 20


def test_predictor_must_answer_each_prompt(df):
    with pytest.raises(Exception, match="predictions for"):
        predict_batches(df, lambda: lambda p: p[:-1], prompt_col="text").collect()


def test_empty_table(df):
    none = df.filter("k < 0")
    assert map_batches(none, lambda b: {"n": []}, "n int").count() == 0
    assert predict_batches(none, lambda: 1 / 0, prompt_col="text").count() == 0


def test_batch_size_must_be_positive(df):
    with pytest.raises(ValueError):
        map_batches(df, dict, "n int", batch_size=0)


def test_executors_need_not_have_the_package(tmp_path):
    """Run from another folder, with the package on the driver's path only."""
    script = tmp_path / "job.py"
    script.write_text(
        f"""
import sys
sys.path.insert(0, {str(Path(__file__).resolve().parent.parent)!r})
from pyspark.sql import SparkSession
import __spark_entry__ as contract
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
row = contract.entry(spark).first()
assert (row["n"], row["hits"]) == (34, 31)
n = contract.queries()["map_over_batches"](spark, "/root/testdata/sf0.001").count()
assert n == 200
"""
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, timeout=120)
    assert done.returncode == 0
