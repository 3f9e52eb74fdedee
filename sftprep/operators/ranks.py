"""Finding the value at a rank without sorting the table.

The values are strings, compared byte by byte.  Each step counts the rows per
prefix among those that share the prefix found so far, so a step brings together
nothing but counters.  The first step uses few digits because every task has a
counter for nearly each of them; later steps see only a small share of the rows.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

FIRST_DIGITS = 2
MORE_DIGITS = 4
# A prefix shared by this many rows or fewer is settled by counting whole values.
FEW_ROWS = 65_536


class Ranked(NamedTuple):
    value: str  # the value at the rank
    place: int  # the rank among the rows with that value, from 1
    rows: int  # how many rows have it


def value_at_rank(
    df: DataFrame, value: Column, rank: Callable[[int], int], max_digits: int
) -> Ranked | None:
    """The value at the 1-based rank that ``rank`` gives from the number of rows;
    None when there are fewer rows.

    ``value`` is made of the 16 hex digits.  Past ``max_digits`` of them, hardly
    any two different values may share a prefix.
    """
    everything = values = df.select(value.alias("value"))
    wanted = None
    before = 0
    digits = FIRST_DIGITS
    while True:
        bucket = F.substring("value", 1, digits)
        counts = _counters(values, bucket)
        if wanted is None:
            rows = sum(c.rows for c in counts)
            wanted = rank(rows)
            if wanted > rows:
                return None
        hit, before = _bucket_of(counts, before, wanted)
        # the longer prefix replaces the shorter: one comparison per row
        values = everything.filter(bucket == hit.bucket)
        few = hit.rows <= FEW_ROWS or hit.same
        if few or digits >= max_digits or len(hit.bucket) < digits:
            break
        digits += MORE_DIGITS
    hit, before = _bucket_of(_counters(values, F.col("value")), before, wanted)
    return Ranked(hit.bucket, wanted - before, hit.rows)


class _Counter(NamedTuple):
    bucket: str
    rows: int
    same: bool  # all rows have one value, as far as a second hash tells


def _counters(values: DataFrame, bucket: Column) -> list[_Counter]:
    """Rows per bucket in bucket order: 65,536 counters at most, or one for each
    value of the last step."""
    other = F.xxhash64("value")
    counts = values.groupBy(bucket.alias("bucket")).agg(
        F.count(F.lit(1)).alias("rows"), (F.min(other) == F.max(other)).alias("same")
    )
    return sorted(_Counter(*row) for row in counts.collect())


def _bucket_of(counts: list[_Counter], before: int, wanted: int) -> tuple[_Counter, int]:
    """The bucket that holds the wanted rank and the number of rows before it."""
    for counter in counts:
        if before + counter.rows >= wanted:
            return counter, before
        before += counter.rows
    raise RuntimeError("the table changed between two passes")
