"""Reading and writing the tables this library works on.

Everything is a plain Spark read or write with a declared schema.  A table that
holds several splits keeps them in a ``split`` column, which is a partition
column on disk, so taking one split only lists that split's files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

SPLIT = "split"

EXAMPLE_SCHEMA = "example_id bigint, context string, question string, answer string"
TRIPLE_SCHEMA = "context string, question string, answer string"
CONVERSATION_SCHEMA = "messages array<struct<role: string, content: string>>"


def read_table(
    spark: SparkSession,
    path: str | list[str],
    fmt: str = "parquet",
    schema: str | None = None,
    split: str | None = None,
    **options: str,
) -> DataFrame:
    """Read a table; with ``split`` only that split, without it all of them.

    Self-describing formats (parquet, orc) may go without a schema.  For text
    formats one is required: inferring it would read the data twice.
    """
    if schema is None and fmt in ("json", "csv", "text"):
        raise ValueError(f"a schema is required to read {fmt}")
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.load(path)
    return df if split is None else select_split(df, split)


def read_jsonl(
    spark: SparkSession, path: str | list[str], schema: str, split: str | None = None
) -> DataFrame:
    """Read JSON lines under a declared schema; a malformed line fails the job."""
    return read_table(spark, path, "json", schema, split, mode="FAILFAST")


def write_jsonl(
    df: DataFrame,
    path: str,
    by_split: bool = True,
    mode: str = "errorifexists",
    max_records_per_file: int = 0,
) -> None:
    """Write JSON lines, one directory of files per split; null fields are kept."""
    writer = (
        df.write.mode(mode)
        .option("ignoreNullFields", "false")
        .option("maxRecordsPerFile", max_records_per_file)
    )
    if by_split:
        writer = writer.partitionBy(SPLIT)
    writer.json(path)


def select_split(df: DataFrame, name: str) -> DataFrame:
    """One split of many.  On disk this prunes to the split's own directory."""
    return df.filter(F.col(SPLIT) == name)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Give a small scan enough partitions to keep every core busy.

    A table of one or two small files arrives in fewer partitions than there are
    cores, and costly per-row work (tokenising) would run on a few of them.  A
    scan that already has as many partitions as cores is returned untouched, so a
    large table is never shuffled here.  Call it on a plain scan only.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *keys) if df.rdd.getNumPartitions() < cores else df
