"""Numbering the rows of a table without bringing them together.

Each task numbers its own rows; the number of rows of each task, one value per task, then
gives every task its start.  Sorted in ranges first, the rows are numbered in an order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..sources.scratch import settle

# ``monotonically_increasing_id`` keeps the row's number in its task in the low bits.
ROW_BITS = 33


def counted_off(df: DataFrame, name: str = "position", most: int | None = None) -> DataFrame:
    """``df`` with each row's place in the table's own order, counted from 0 in a long
    column.  The table is written to the shared folder on the call, so the numbers stay
    as they are whatever is read again.  With ``most`` no task writes more rows than
    that, which is enough to find the first ``most`` of all."""
    inside = F.col("_place").bitwiseAND((1 << ROW_BITS) - 1)
    own = df.withColumn("_place", F.monotonically_increasing_id())
    laid = settle(own if most is None else own.filter(inside < most))
    counts = laid.groupBy(_task().alias("_task")).agg(F.count(F.lit(1)).alias("_rows"))
    kept = [c for c in df.columns if c != name]
    found = laid.withColumn("_task", _task()).join(F.broadcast(starts(counts, "_rows")), "_task")
    return found.select(*kept, (F.col("_start") + inside).alias(name))


def numbered(
    df: DataFrame,
    order: Sequence[Column | str],
    name: str = "position",
    first: int = 0,
    computed: bool = False,
) -> DataFrame:
    """``df`` with each row's place in the order as a long column, counted from ``first``.

    Rows that are equal in ``order`` are neighbours in any order; they need not come to
    one task, however many there are, as a running number tells them apart in the sort.
    The plan of ``df`` runs twice, once for a sample of the sort values, so these should
    be short and the plan not costly.  ``computed`` as in :func:`in_ranges`.
    """
    placed = counted_off(in_ranges(df, order, computed), "_position")
    kept = [c for c in df.columns if c != name]
    return placed.select(*kept, (F.col("_position") + first).alias(name))


def in_ranges(df: DataFrame, order: Sequence[Column | str], computed: bool = False) -> DataFrame:
    """The table sorted; equal rows may be dealt to several tasks.

    ``order`` may be expressions over the columns of df.  A sort computes these anew for
    both rows of each comparison, so hashes of a row's content are sorted with
    ``computed``: as columns, in rising order.
    """
    values = {f"_sort{i}": c for i, c in enumerate(order)} if computed else {}
    tied = df.withColumns({"_tie": F.monotonically_increasing_id(), **values})
    return tied.orderBy(*(values or order), "_tie").drop("_tie", *values)


def _task() -> Column:
    return F.shiftright("_place", ROW_BITS)


def starts(totals: DataFrame, value: str) -> DataFrame:
    """What the tasks before each have in all: ``_task`` and ``_start``.

    ``totals`` has one row for each task; this is all that the window sees.
    """
    earlier = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("_task", F.coalesce(F.sum(value).over(earlier), F.lit(0)).alias("_start"))
