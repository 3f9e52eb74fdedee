"""Seeded order, samples, exact splits and positional access.

Samples and splits never sort the table.  They look up the hash of the n-th row by
counting rows per hash prefix (reading only the key columns), and then keep or
mark rows by comparing with that one value, which needs no shuffle.  The order is the
same whatever the number of rows: by hash of the key, then by content.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..sources.tables import SPLIT
from .keys import Key, key_columns, order_hash, row_hash, seeded_order
from .positions import counted_off, in_ranges, numbered
from .ranks import value_at_rank

# A limit of this many rows or fewer may bring them to one task.
ONE_TASK_ROWS = 10_000
# Past this many hash digits, only equal keys still share a prefix.
MAX_DIGITS = 14


def shuffle_by_hash(
    df: DataFrame, key: Key, seed: int | str, position: str | None = None
) -> DataFrame:
    """All rows in seeded random order (a range-partitioned sort).  Rows that share a
    key are ordered by a hash of their content.

    ``position`` names a column for each row's place, counted from 0; with it the
    table is written to the shared folder on the call."""
    order = seeded_order(df, key, seed)
    if position is None:
        return in_ranges(df, order, computed=True)
    return numbered(df, order, position, computed=True)


def take_n(df: DataFrame, n: int, strict: bool = True) -> DataFrame:
    """The first n rows of an ordered table, in that order.

    Rows beyond the end raise when ``strict`` (this counts the table); otherwise all
    rows come back.  A few rows are taken by a plain limit, which brings them to one
    task.  More are not: every task writes its first n rows at most to the shared
    folder, the tasks' row counts tell how many of these each has to give, and the
    rows that are left are put in order again.
    """
    _check_count(n)
    if strict and (rows := df.count()) < n:
        raise ValueError(f"asked for {n} rows of {rows}")
    if n <= ONE_TASK_ROWS:
        return df.limit(n)
    return counted_off(df, "_nth", most=n).filter(F.col("_nth") < n).orderBy("_nth").drop("_nth")


def sample_n(
    df: DataFrame,
    key: Key,
    n: int,
    seed: int | str,
    strict: bool = True,
    ordered: bool = True,
    position: str | None = None,
) -> DataFrame:
    """The first n rows of the seeded order, in that order.  With ``ordered=False``
    they keep the table's own order, and nothing is sorted or moved.

    The hash of the n-th row is looked up first, so that no task sends on n rows
    of its own (as a plain top-k would) but only rows of the sample are moved.
    ``position`` names a column for the place in the order, as in
    :func:`shuffle_by_hash`.
    """
    _check_count(n)
    if n == 0:
        sample = df.limit(0)
    else:
        cut = _cut(df, key, seed, lambda rows: n)
        if cut is None:
            if strict:
                raise ValueError(f"asked for {n} rows of {df.count()}")
            sample = df
        elif cut.keep == cut.size:
            sample = df.filter(cut.upto)
        else:
            tied = _tied(df, cut).filter(F.col("_nth") < cut.keep).drop("_nth")
            sample = df.filter(cut.before).unionByName(tied)
    if position is None and not ordered:
        return sample
    return shuffle_by_hash(sample, key, seed, position)


def train_test_split(
    df: DataFrame, key: Key, test_size: float | int, seed: int | str
) -> DataFrame:
    """Mark every row ``train`` or ``test`` in a ``split`` column.

    ``test_size`` is the share of test rows (rounded up to whole rows) or, as an
    int, their number.  Sizes are exact.  The cut is found by a small counting
    job; marking the rows is then a comparison with no shuffle.
    """
    if isinstance(test_size, float):
        if not 0 < test_size < 1:
            raise ValueError("a test share must lie between 0 and 1")
    elif test_size < 1:
        raise ValueError("a number of test rows must be positive")

    def n_test(rows: int) -> int:
        n = math.ceil(test_size * rows) if isinstance(test_size, float) else test_size
        if n >= rows:
            raise ValueError(f"{n} test rows of {rows} leave no train rows")
        return n

    cut = _cut(df, key, seed, n_test)

    def marked(rows: DataFrame, is_test: Column) -> DataFrame:
        return rows.withColumn(SPLIT, F.when(is_test, "test").otherwise("train"))

    if cut.keep == cut.size:
        return marked(df, cut.upto)
    others = marked(df.filter(~cut.group), cut.before)
    return others.unionByName(marked(_tied(df, cut), F.col("_nth") < cut.keep).drop("_nth"))


def row_at(df: DataFrame, key: Key, i: int, seed: int | str) -> DataFrame:
    """The row at 0-based position i of the seeded order."""
    cut = None if i < 0 else _cut(df, key, seed, lambda rows: i + 1)
    if cut is None:
        raise IndexError(f"no row at position {i}")
    return df.filter(cut.group).limit(1)


def pick_row(df: DataFrame, key: Key, seed: int | str) -> DataFrame:
    """One random row."""
    return sample_n(df, key, 1, seed)


def _check_count(n: int) -> None:
    if n < 0:
        raise ValueError("a number of rows cannot be negative")


@dataclass(frozen=True)
class _Cut:
    """Where a rank falls in the seeded order."""

    before: Column  # the rows before the group
    upto: Column  # the rows before it and the group
    group: Column  # the row of that rank, and rows equal to it in every column
    keep: int  # how many of the group are within the rank
    size: int  # rows in the group


def _cut(df: DataFrame, key: Key, seed: int | str, rank: Callable[[int], int]) -> _Cut | None:
    """The cut behind the row whose 1-based rank ``rank`` gives from the number of
    rows; None when the table has fewer.

    Rows that share a key are told apart by their content, so that only copies of
    one row can remain together.
    """
    order = order_hash(key, seed)
    hit = value_at_rank(df, order, rank, MAX_DIGITS)
    if hit is None:
        return None
    value, keep, size = hit
    before, upto, group = order < value, order <= value, order == value
    if size > 1 and set(df.columns) != set(key_columns(key)):
        content, place = row_hash(df), keep
        value, keep, size = value_at_rank(
            df.filter(group), content, lambda rows: place, MAX_DIGITS
        )
        upto = before | (group & (content <= value))
        before = before | (group & (content < value))
        group = group & (content == value)
    return _Cut(before, upto, group, keep, size)


def _tied(df: DataFrame, cut: _Cut) -> DataFrame:
    """The rows of the group of a cut, as they are, counted off in ``_nth``: they are
    copies of one row, so any ``keep`` of them may be within the rank."""
    return counted_off(df.filter(cut.group), "_nth")
