"""Intermediate tables in the cluster's shared folder.

The folder is the one named by ``spark.checkpoint.dir``.  Files there survive
the loss of an executor, unlike cached or locally checkpointed blocks.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``.

    A session on one machine may leave it unset and gets one beside its warehouse; on a
    cluster there is no folder that is known to be shared, so that is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        folder = spark.conf.get("spark.sql.warehouse.dir") + "/intermediate"
    return folder.rstrip("/")


def scratch_dir(spark: SparkSession) -> str:
    """A fresh path (not yet created) in the shared folder."""
    return f"{shared_folder(spark)}/sftprep-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` once and continue from the written table.

    For a table that several later passes read (a vocabulary, encoded rows), so
    that its plan runs once and a lost executor re-reads files, not the source.
    """
    path = scratch_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
