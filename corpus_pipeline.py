"""From raw documents to packed sequences, stage by stage.

Every stage works on the whole result of the one before it, which is written as
Parquet in the shared folder and read again.  All stages but the last return the
columns of ``documents``; where a stage changes a text, ``n_chars`` follows it.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sftprep.llm import jaccard, packing, quality, secrets, substrings
from sftprep.llm.common import dropped, held_tables, stored
from sftprep.llm.queries import tokenizer_path


def _with_length(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``n_chars`` of the present text, and the columns in their order."""
    if "n_chars" in columns:
        docs = docs.withColumn("n_chars", F.length("text").cast("long"))
    return docs.select(columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or a certified cutoff rejects go.  A null text counts as
    empty, which the base rule rejects; of equal rows each is judged for itself."""
    return quality.passing(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are linked by shingles of five words and a similarity of 0.8,
    directly or by others, the one with the smallest key stays.  Texts without words are
    linked with nothing and stay; of equal rows one stays; a null key counts as the
    largest.  Texts are compared whole, however long."""
    return jaccard.one_of_each(docs, threshold=80, shingle=5)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words that an earlier document has go; so do documents of which
    nothing is left.  Other words, and documents without such a passage, null and empty
    texts among them, stay as they are.  Of rows with one key none counts as earlier."""
    return _with_length(substrings.with_texts_left(docs, length=50), docs.columns)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; null and empty texts stay."""
    return _with_length(secrets.redacted(docs), docs.columns)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids and their places in sequences of 2048.  A null or empty text
    has its end alone; of equal rows each has its pieces."""
    return packing.packed(docs, tokenizer_path("byte_bpe_50k.json"))


_left: list[DataFrame] = []


def _stage(function: Callable) -> Callable:
    """The stage without what the one before it left in the shared folder.

    A stage begins when the one before it has been written, so its tables can go.
    """

    @wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        dropped(*_left)
        _left.clear()
        with held_tables() as tables:
            result = function(spark, docs, sf_dir)
        _left.extend(tables)
        return result

    return run_stage


STAGES = [
    ("quality rules", _stage(quality_rules)),
    ("n-gram jaccard join", _stage(near_duplicates)),
    ("substring dedup", _stage(substring_dedup)),
    ("secret scans", _stage(secret_scans)),
    ("packing", _stage(packed_sequences)),
]

#: SQL can't express the stages; tests/llm holds them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
