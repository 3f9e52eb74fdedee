"""Packing many short id sequences into full blocks of one length.

The rows form a single id stream in seeded order, and block b is the b-th run of
``length`` ids of it.  No step looks at the whole stream.  The rows are sorted in
ranges; each task adds up the ids before each of its rows, and the totals of the tasks,
one number each, give a task its start in the stream.  Rows are then cut into pieces at
block borders, and the pieces, at most ``length`` per block, are put together.

The ids are shuffled twice: by the sort and to the blocks.  Integers travel as bytes.  Rows that share a key, or
copies of one row, are dealt over as many tasks as other rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, ByteType, IntegerType, LongType, ShortType

from ..functions.tokens import append_eos
from ..sources.scratch import settle
from .keys import Key, key_columns, order_hash, with_content_hash
from .positions import in_ranges, starts


def pack(
    df: DataFrame,
    key: Key,
    length: int,
    seed: int | str,
    sep: int | None = None,
    column: str = "input_ids",
    drop_last: bool = True,
) -> DataFrame:
    """Blocks ``block, input_ids`` of exactly ``length`` ids; the short rest at the end
    of the stream is dropped, or kept as a last block with ``drop_last=False``.
    ``sep`` is appended to every row first.

    The rows are written to the shared folder on the call, with the hashes that they are
    sorted by and once more when they are sorted.  Rows that share a key follow each other
    in the order of the md5 of their ids.
    """
    if length < 1:
        raise ValueError("length must be positive")
    keys = key_columns(key)
    ids = F.col(column) if sep is None else append_eos(F.col(column), sep)
    # a row without ids has no part in the stream
    rows = df.select(*keys, ids.alias("_ids")).filter(F.size("_ids") > 0)
    carrier = _carrier(rows.schema["_ids"].dataType)
    # written, as the sort runs the plan of its rows twice
    hashed = with_content_hash(rows, "_ids", "_content", carrier.made(F.col("_ids")))
    in_order = in_ranges(hashed, [order_hash(keys, seed), F.col("_content")], computed=True)
    sized = in_order.select("_ids", carrier.size(F.col("_ids")).cast("long").alias("_size"))
    # not deterministic, as the result depends on the rows before
    inside = F.arrow_udf(_before, "struct<task: int, inside: bigint>").asNondeterministic()
    summed = sized.withColumn("_before", inside("_size"))
    placed = summed.select(
        "_ids", F.col("_before.inside").alias("_inside"), "_size", F.col("_before.task").alias("_task")
    )
    return _blocks(_located(settle(placed)), length, drop_last, carrier)


class _Carrier(NamedTuple):
    """How ids travel: integers as bytes, which are written, cut and shuffled whole."""

    made: Callable[[Column], Column]  # from an array
    size: Callable[[Column], Column]
    part: Callable[[Column, Column, Column], Column]  # from a place, counted from 0, so many ids
    whole: Callable[[Column], Column]  # the array, from a list of parts


def _carrier(array: ArrayType) -> _Carrier:
    kind = {ByteType: np.int8, ShortType: np.int16, IntegerType: np.int32, LongType: np.int64}.get(type(array.elementType))
    if kind is None:

        def part(ids: Column, first: Column, count: Column) -> Column:
            return F.slice(ids, (first + 1).cast("int"), count.cast("int"))

        return _Carrier(lambda ids: ids, F.size, part, F.flatten)
    entry = np.dtype([("id", kind), ("known", np.bool_)])
    width = entry.itemsize

    def made(lists: pa.Array) -> pa.Array:
        """Each id, and whether it is one or null."""
        sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        values = lists.flatten()
        entries = np.zeros(len(values), entry)
        entries["id"] = values.fill_null(0).to_numpy()
        entries["known"] = values.is_valid().to_numpy(zero_copy_only=False)
        places = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]) * width
        buffers = [None, pa.py_buffer(places.astype(np.int32)), pa.py_buffer(entries)]
        return pc.if_else(pc.is_null(lists), None, pa.Array.from_buffers(pa.binary(), len(lists), buffers))

    def whole(lists: pa.Array) -> pa.Array:
        """The arrays again; a list has its parts in their order."""
        parts = lists.flatten()
        ends = np.concatenate([[0], np.cumsum(pc.binary_length(parts).to_numpy(zero_copy_only=False), dtype=np.int64)])
        counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
        entries = np.frombuffer(b"".join(parts.to_pylist()), entry)
        values = pa.array(np.ascontiguousarray(entries["id"]), mask=~entries["known"])
        offsets = ends[np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])] // width
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)

    def some(ids: Column, first: Column, count: Column) -> Column:
        return F.substring(ids, (first * width + 1).cast("int"), (count * width).cast("int"))

    arrays = F.arrow_udf(whole, array.simpleString())
    return _Carrier(F.arrow_udf(made, "binary"), lambda ids: F.octet_length(ids) / width, some, arrays)


def _before(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """The task, and the number of ids before each of its rows there."""
    task, before = TaskContext.get().partitionId(), 0
    for sizes in batches:
        inside = pc.add(pc.subtract(pc.cumulative_sum(sizes), sizes), before)
        before += pc.sum(sizes).as_py() or 0
        tasks = pa.array([task] * len(sizes), pa.int32())
        yield pa.StructArray.from_arrays([tasks, inside], ["task", "inside"])


def _located(rows: DataFrame) -> DataFrame:
    """Rows with the stream positions of their first and last id."""
    totals = rows.groupBy("_task").agg(F.sum("_size").alias("_total"))
    # one row for each task of the sort
    placed = rows.join(F.broadcast(starts(totals, "_total")), "_task")
    first = F.col("_start") + F.col("_inside")
    return placed.select("_ids", first.alias("_first"), (first + F.col("_size") - 1).alias("_last"))


def _blocks(located: DataFrame, length: int, drop_last: bool, carrier: _Carrier) -> DataFrame:
    first, last = F.col("_first"), F.col("_last")

    def piece(block: Column) -> Column:
        offset = F.greatest(block * length, first)
        stop = F.least(block * length + (length - 1), last)
        count = stop - offset + 1
        ids = carrier.part(F.col("_ids"), offset - first, count)
        return F.struct(block.alias("block"), offset.alias("offset"), count.alias("n"), ids.alias("ids"))

    def block_of(position: Column) -> Column:
        return F.call_function("div", position, F.lit(length))

    # outer, as the filter that a plain explode brings along would compute the pieces twice
    touched = F.sequence(block_of(first), block_of(last))
    pieces = located.select(F.explode_outer(F.transform(touched, piece)).alias("p")).filter(
        F.col("p").isNotNull()
    )
    in_order = F.sort_array(F.collect_list(F.struct("p.offset", "p.ids")))
    blocks = pieces.groupBy(F.col("p.block").alias("block")).agg(
        F.sum("p.n").alias("_size"), F.transform(in_order, lambda p: p["ids"]).alias("_parts")
    )
    full = blocks.filter(F.col("_size") == length) if drop_last else blocks
    return full.select("block", carrier.whole(F.col("_parts")).alias("input_ids"))
