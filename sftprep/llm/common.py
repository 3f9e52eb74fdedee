"""What the operators share: intermediate tables, the word rule, columns that clash."""

from __future__ import annotations

import gc
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sftprep.sources.scratch import shared_folder

#: A word is a run of anything but these six characters (Java and Python regex).
SPACES = r"[\x20\x09-\x0D]+"


_holders: list[list[DataFrame]] = []


@contextmanager
def held_tables() -> Iterator[list[DataFrame]]:
    """Collect the tables that ``stored`` writes meanwhile, for ``dropped``."""
    tables: list[DataFrame] = []
    _holders.append(tables)
    try:
        yield tables
    finally:
        _holders.pop()
        if _holders:
            _holders[-1].extend(tables)


def stored(df: DataFrame, name: str, release: bool = True) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.  With ``release``
    the shuffle files of steps that are over go first, which takes a second.

    This cuts the lineage: a lost executor costs a read, not a recomputation.  The
    files stay until ``dropped`` or until the folder is cleared, as with checkpoints.
    """
    spark, schema = df.sparkSession, df.schema
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    if release:
        released(spark)
    df.write.parquet(path)
    table = spark.read.schema(schema).parquet(path)
    table.stored_path = path
    if _holders:
        _holders[-1].append(table)
    return table


def released(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of steps that are over.

    It does so when the plans behind them are garbage, which may be collected late; a
    plan is found to be garbage only after the Python objects that hold it.
    """
    for _ in range(2):
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(0.3)


def dropped(*tables: DataFrame) -> None:
    """Delete the files of ``stored`` tables that no later result reads."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table.stored_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def text_of(column: str = "text") -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def null_safe(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """An equi-join in which null equals null; ``on`` is kept once."""
    if not on:
        return left.join(F.broadcast(right), how=how)  # the sum over one group: one row
    named = right.withColumnsRenamed({c: f"_right{i}" for i, c in enumerate(on)})
    same = None
    for i, c in enumerate(on):
        one = left[c].eqNullSafe(named[f"_right{i}"])
        same = one if same is None else same & one
    return left.join(named, same, how).drop(*[f"_right{i}" for i in range(len(on))])
