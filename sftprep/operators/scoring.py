"""Pairing predictions with examples and scoring them."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.cleanup import py_strip
from ..functions.templates import _col
from .keys import Key, key_columns


def pair_predictions(examples: DataFrame, preds: DataFrame, key: Key = "example_id") -> DataFrame:
    """Every example with its prediction, null where there is none.

    ``preds`` holds at most one row per example: the key columns and what the
    predictor gave.  Both sides meet on the example's own key, so no key is hot.
    """
    return examples.join(preds, key_columns(key), "left")


def exact_match(pred: Column | str, answer: Column | str, normalize: bool = False) -> Column:
    """1 when both texts are equal, else 0; a missing text scores 0.

    Only predictions are trimmed beforehand, so an answer with blanks at its ends
    cannot match; ``normalize`` trims both.
    """
    pred, answer = _col(pred), _col(answer)
    if normalize:
        pred, answer = py_strip(pred), py_strip(answer)
    return F.coalesce((pred == answer).cast("int"), F.lit(0))


def _grouped(df: DataFrame, by: str | Sequence[str] | None):
    return df.groupBy(*([by] if isinstance(by, str) else by or []))


def accuracy(df: DataFrame, by: str | Sequence[str] | None = None, score: str = "score") -> DataFrame:
    """Rows, hits and their ratio, in all or per group; null on no rows."""
    return _grouped(df, by).agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(score), F.lit(0)).cast("long").alias("hits"),
        F.avg(score).alias("accuracy"),
    )


def _percent_text(values: pd.Series) -> pd.Series:
    return pd.Series([None if pd.isna(v) else f"{v:.2f}%" for v in values], dtype=object)


def percent(share: Column | str) -> Column:
    """A share as percent text with two decimals.

    The binary value itself is rounded, ties to even; no built-in function does that
    (they round the shortest decimal).  Meant for results, which are few rows.
    """
    return F.pandas_udf(_percent_text, "string")(_col(share).cast("double") * 100)


def flag_share(
    df: DataFrame, value: Column | str, flag: Column | str, by: str | Sequence[str] | None = None
) -> DataFrame:
    """Sum of a value, the part of it where a flag is set, and that part in
    percent; a null flag counts as not set."""
    value, flag = _col(value), _col(flag)
    flagged = F.coalesce(F.sum(F.when(flag, value)), F.sum(value) * 0)
    return _grouped(df, by).agg(
        F.sum(value).alias("total"),
        flagged.alias("flagged"),
        (F.lit(100.0) * flagged / F.nullif(F.sum(value), F.lit(0))).alias("percent"),
    )
