"""Small tables for people to look at."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..sources.tables import SPLIT
from .keys import Key
from .sampling import sample_n

# The labels of a report and the line below it.
QUESTION, EXPECTED, PREDICTED = "User: ", "\ne: ", "\ni: "
RULE = "-" * 50
# End of fixed values.


def sample_report(
    df: DataFrame, n: int, seed: int | str, key: Key = "example_id", pred_col: str = "prediction"
) -> DataFrame:
    """A random sample with a ``report`` text: question, expected, predicted."""
    report = F.concat(
        F.lit(QUESTION),
        F.coalesce("question", F.lit("")),
        F.lit(EXPECTED),
        F.coalesce("answer", F.lit("")),
        F.lit(PREDICTED),
        F.coalesce(pred_col, F.lit("")),
        F.lit(f"\n{RULE}"),
    )
    return sample_n(df, key, n, seed).withColumn("report", report)


def summarize(df: DataFrame, split: str | None = SPLIT) -> DataFrame:
    """Column names and row count, for each split where there are splits."""
    names = ", ".join(c for c in df.columns if c != split)
    groups = [split] if split is not None and split in df.columns else []
    counts = df.groupBy(*groups).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.withColumn("columns", F.lit(names))
