import pytest

from sftprep import EXAMPLE_SCHEMA, read_jsonl, read_table, select_split, settle, spread, write_jsonl

SCHEMA = EXAMPLE_SCHEMA + ", split string"
ROWS = [
    (1, 'he said "hi"', "line\nbreak", None, "train"),
    (2, "", "100% {schema}", "naïve 😀", "train"),
    (3, "\t tab ", "back\\slash", "a", "test"),
]


def test_jsonl_keeps_text_and_nulls(spark, tmp_path):
    path = str(tmp_path / "out")
    write_jsonl(spark.createDataFrame(ROWS, SCHEMA), path)
    assert sorted(p.name for p in (tmp_path / "out").glob("split=*")) == ["split=test", "split=train"]
    assert sorted(map(tuple, read_jsonl(spark, path, SCHEMA).collect())) == sorted(ROWS)
    text = "".join(p.read_text() for p in (tmp_path / "out").glob("split=train/*.json"))
    assert '"answer":null' in text


def test_one_split_reads_its_files_only(spark, tmp_path):
    path = str(tmp_path / "out")
    write_jsonl(spark.createDataFrame(ROWS, SCHEMA), path)
    one = read_jsonl(spark, path, SCHEMA, split="test")
    assert [r["example_id"] for r in one.collect()] == [3]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan


def test_malformed_line_fails(spark, tmp_path):
    (tmp_path / "bad.json").write_text('{"example_id": 1}\n{oops\n')
    with pytest.raises(Exception):
        read_jsonl(spark, str(tmp_path / "bad.json"), EXAMPLE_SCHEMA).collect()


def test_existing_output_is_not_overwritten(spark, tmp_path):
    df = spark.createDataFrame(ROWS, SCHEMA)
    write_jsonl(df, str(tmp_path / "out"))
    with pytest.raises(Exception):
        write_jsonl(df, str(tmp_path / "out"))


def test_text_formats_need_a_schema(spark, tmp_path):
    with pytest.raises(ValueError):
        read_table(spark, str(tmp_path), "json")


@pytest.mark.parametrize("fmt", ["parquet", "orc", "csv", "json"])
def test_table_formats(spark, tmp_path, fmt):
    rows = [(1, "a", "train"), (2, "b", "test")]
    df = spark.createDataFrame(rows, "id bigint, text string, split string")
    path = str(tmp_path / fmt)
    df.write.partitionBy("split").format(fmt).save(path)
    read = read_table(spark, path, fmt, "id bigint, text string, split string")
    assert sorted(map(tuple, read.collect())) == rows
    assert [tuple(r) for r in select_split(read, "test").collect()] == [rows[1]]


def test_spread_leaves_large_scans_alone(spark):
    many = spark.range(0, 100, 1, 64)
    assert spread(many, "id") is many
    few = spread(spark.range(0, 100, 1, 1), "id")
    assert few.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_settle_gives_the_same_table(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    assert sorted(map(tuple, settle(df).collect())) == sorted(ROWS)
