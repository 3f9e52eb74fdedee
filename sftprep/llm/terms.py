"""Counts of terms over a corpus, and sums of the terms' values over each row.

A term (a word, a pre-token) has a value that all its occurrences share.  The table of
terms is made in one pass over the texts: each task adds up its own terms before the
shuffle.  The sums are made in a second pass.  Few terms make up most occurrences: the
most frequent ones, ``HEAD`` at most, are looked up where the text is; only the others
go to the join, once for each task and term, with the rows that hold them as a list.
So neither a frequent term nor a large group of equal rows is a hot key.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Terms that are looked up in the task: bound of their number and of their bytes.
HEAD, LONGEST = 500_000, 64
#: A task passes on what it has gathered when it holds so many entries.
HELD = 150_000


def term_counts(docs: DataFrame, text: str, split: Callable[[str], list], term_type: str) -> DataFrame:
    """One row per distinct term: term, n.  ``split`` gives the terms of a text."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        kind = pa.string() if term_type == "string" else pa.binary()

        def out() -> pa.RecordBatch:
            return pa.record_batch(
                [pa.array(list(held), kind), pa.array(list(held.values()), pa.int64())], ["term", "n"]
            )

        for batch in batches:
            for value in batch.column(0):
                held.update(split(value.as_py() or ""))
                if len(held) > HELD:
                    yield out()
                    held.clear()
        yield out()

    counted = docs.select(text).mapInArrow(count, f"term {term_type}, n long")
    return counted.groupBy("term").agg(F.sum("n").alias("n"))


def frequent(table: DataFrame, most: int) -> DataFrame:
    """The rows of ``table`` with the greatest ``n``, ``most`` at most: all rows that
    have so great a one as leaves that many."""
    # counts from 1024 on are taken together by powers of two: some 1100 rows
    step = F.when(F.col("n") < 1024, F.col("n")).otherwise(1014 + F.floor(F.log2("n")))
    sizes = table.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect()
    least, held = 1 << 62, 0
    for at, rows in sizes:
        held += rows
        if held > most:
            break
        least = at if at < 1024 else 1 << (at - 1014)
    return table.where(F.col("n") >= least)


def head_of(table: DataFrame, value: str) -> dict:
    """The most frequent terms and their values; ``table`` has term, n and ``value``.

    They are all short terms that occur at least so often as leaves ``HEAD`` of them.
    """
    short = table.where(F.octet_length("term") <= LONGEST)
    rows = frequent(short, HEAD).select("term", value).toArrow()
    return dict(zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), strict=True))


def sums_of_rows(
    docs: DataFrame,
    text: str,
    carried: list[str],
    split: Callable[[str], list],
    table: DataFrame,
    head: dict,
    term_type: str,
) -> DataFrame:
    """One row per row of ``docs``: ``carried``, n_terms, n_found, total, measured.

    ``n_found`` counts the occurrences of terms in ``table`` (term, value) and
    ``total`` sums up their values.  Each row stands for itself, whatever its key.
    """
    return summed_parts(row_parts(docs, text, carried, split, head, term_type), carried, table)


def row_parts(
    docs: DataFrame,
    text: str,
    carried: list[str],
    split: Callable[[str], list],
    head: dict,
    term_type: str,
    measure: Callable | None = None,
) -> DataFrame:
    """What tasks make of the texts: each row's own sums, and the terms outside ``head``
    with lists of the rows that hold them.

    ``measure`` gives a number for each text of a batch, and of the strings that it leaves
    out: string, number of the text, times, ordered by string.  With it there is a column
    ``string``, and rows for these strings with the rows that hold them.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(head)
    kind = pa.string() if term_type == "string" else pa.binary()
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(carried).schema)
    schema = (
        f"term {term_type}, _owner long, _rows array<long>, _times array<int>, _sum double, _n long,"
        f" measured double, {kept}" + ", string long" * (measure is not None)
    )

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        tail: dict = defaultdict(lambda: ([], []))
        own: list[tuple] = []
        entries = 0

        def out() -> pa.RecordBatch:
            n, m = len(tail), len(own)
            with_row = [
                pa.array([*[None] * n, *[x[4 + i] for x in own]], kinds[i]) for i in range(len(carried))
            ]
            lists = [tail[t] for t in tail]
            return pa.record_batch(
                [
                    pa.array([*tail, *[None] * m], kind),
                    pa.array([*[None] * n, *[x[0] for x in own]], pa.int64()),
                    pa.array([*[x[0] for x in lists], *[[x[0]] for x in own]], pa.list_(pa.int64())),
                    pa.array([*[x[1] for x in lists], *[[0]] * m], pa.list_(pa.int32())),
                    pa.array([*[None] * n, *[x[1] for x in own]], pa.float64()),
                    pa.array([*[None] * n, *[x[2] for x in own]], pa.int64()),
                    pa.array([*[None] * n, *[x[3] for x in own]], pa.float64()),
                    *with_row,
                    *[pa.nulls(n + m, pa.int64())] * (measure is not None),
                ],
                ["term", "_owner", "_rows", "_times", "_sum", "_n", "measured", *carried, *["string"] * (measure is not None)],
            )

        def left_out(strings: np.ndarray, texts: np.ndarray, times: np.ndarray, rows: np.ndarray) -> pa.RecordBatch:
            starts = np.flatnonzero(np.concatenate([[True], strings[1:] != strings[:-1]]))
            ends = pa.array(np.append(starts, len(strings)).astype(np.int32))
            n = len(starts)
            return pa.record_batch(
                [
                    pa.nulls(n, kind), pa.nulls(n, pa.int64()),
                    pa.ListArray.from_arrays(ends, pa.array(rows[texts])),
                    pa.ListArray.from_arrays(ends, pa.array(times.astype(np.int32))),
                    pa.nulls(n, pa.float64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.float64()),
                    *[pa.nulls(n, k) for k in kinds], pa.array(strings[starts]),
                ],
                ["term", "_owner", "_rows", "_times", "_sum", "_n", "measured", *carried, "string"],
            )

        kinds = None
        for batch in batches:
            kinds = [c.type for c in batch.columns[2:]]
            others = zip(*[c.to_pylist() for c in batch.columns[2:]], strict=True)
            numbers = [None] * len(batch)
            if measure is not None:
                numbers, (strings, texts, times) = measure(batch.column(1))
                if len(strings):
                    yield left_out(strings, texts, times, batch.column(0).to_numpy())
            for row, value, number, other in zip(
                batch.column(0).to_pylist(), batch.column(1), numbers, others, strict=True
            ):
                terms = split(value.as_py() or "")
                found = [known[t] for t in terms if t in known]
                own.append((row, float(sum(found)), len(found), number, *other))
                if len(found) < len(terms):
                    for term, times in Counter([t for t in terms if t not in known]).items():
                        rows, counts = tail[term]
                        rows.append(row)
                        counts.append(times)
                        entries += 1
                if entries + len(own) > HELD:
                    yield out()
                    tail.clear()
                    own.clear()
                    entries = 0
        if kinds is not None:
            yield out()

    numbered = docs.withColumn("_row", F.monotonically_increasing_id())
    return numbered.select("_row", text, *carried).mapInArrow(look_up, schema)


def summed_parts(
    parts: DataFrame, carried: list[str], table: DataFrame, added: DataFrame | None = None
) -> DataFrame:
    """The rows that ``row_parts`` took apart, with the values of ``table`` (term, value).

    ``added`` has what belongs to a row's ``measured`` besides (_row, measured)."""
    # a row's own sums have no term; they take part under keys of their own
    parts = parts.withColumn("_owner", F.coalesce("_owner", F.lit(-1)))
    values = table.select("term", F.lit(-1).cast("long").alias("_owner"), "value")
    looked = parts.join(values, ["term", "_owner"], "left")
    pieces = looked.select(
        F.explode(F.arrays_zip("_rows", "_times")).alias("e"), "value", "_sum", "_n", "measured", *carried
    ).select(
        F.col("e._rows").alias("_row"),
        F.col("e._times").cast("long").alias("_terms"),
        F.when(F.col("value").isNotNull(), F.col("e._times")).otherwise(0).cast("long").alias("_found"),
        (F.coalesce("_sum", F.lit(0.0)) + F.coalesce(F.col("value") * F.col("e._times"), F.lit(0.0))).alias("_sum"),
        "_n",
        "measured",
        *carried,
    )
    if added is not None:
        pieces = pieces.unionByName(added, allowMissingColumns=True)
    measured = F.first("measured", ignorenulls=True) if added is None else F.sum("measured")
    sums = pieces.groupBy("_row").agg(
        (F.sum("_terms") + F.sum(F.coalesce("_n", F.lit(0)))).alias("n_terms"),
        (F.sum("_found") + F.sum(F.coalesce("_n", F.lit(0)))).alias("n_found"),
        F.sum("_sum").alias("total"),
        *[F.first(c, ignorenulls=True).alias(c) for c in carried],
        measured.alias("measured"),
    )
    return sums.select(*carried, "n_terms", "n_found", "total", "measured")
