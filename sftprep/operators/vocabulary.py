"""Vocabulary tables, and translating tokens to ids and back.

A vocabulary is a table ``token, id, n, is_special``.  Ids follow the counts, so
a low id is a frequent token.

A vocabulary of a bounded size is turned into one hash table value that every task gets, and
looked up inside the array expression, which keeps every row where it is; it has at most
``LOOKUP_ROWS`` entries of at most ``LOOKUP_BYTES`` bytes each.

With a larger one the rows are cut into blocks of some ``BLOCK_ELEMENTS`` elements.  Each
block's elements become codes of its own short dictionary; the dictionaries, which have an
element once for a block however often it occurs there, are joined with the vocabulary, and
the rows, codes instead of strings, are sorted behind their block's translated dictionary.
An element's place in the array, and the row's other columns, have no part in the join, so
neither a row key nor any order is needed, and no element is a hot key there.

A column that is both counted and encoded is put in blocks once (``in_blocks``): the
dictionaries have the counts too, and neither step goes through the arrays again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DataType

from ..sources.scratch import settle
from .positions import numbered

# Entries that are looked up in the row expression, and their longest token in bytes:
# 24 MB at most (tokens of a usual vocabulary have 6 bytes on average).
LOOKUP_ROWS, LOOKUP_BYTES = 1 << 18, 96
# Elements of a block; a longer row is a block of its own.
BLOCK_ELEMENTS = 1 << 22
# An element is in the join once for a block, so no share makes it hot; kept for callers that set it.
HOT_SHARE = 1 / 1000


class Blocks(NamedTuple):
    """A table whose array column is in blocks."""

    rows: DataFrame  # the other columns, and ``_coded``
    column: str
    elements: DataType  # type of an element


def in_blocks(df: DataFrame, column: str = "tokens") -> Blocks:
    """The table with an array column as codes in blocks, for ``build_vocab`` and ``encode``.
    It is written to the shared folder on the call, so what computes the arrays runs once."""
    return _in_blocks(df, column, [c for c in df.columns if c != column])


def build_vocab(
    df: DataFrame | Blocks,
    column: str = "tokens",
    specials: Sequence[str] = (),
    max_size: int | None = None,
) -> DataFrame:
    """Vocabulary of the tokens in an array column, or in blocks: the specials in the order
    given, then all other tokens by falling count, ties in token order.  ``max_size``
    is the number of entries to keep, specials included.

    Counting and numbering run on the call and their results are written to the shared
    folder.  Counting combines on the map side, so a token that fills a third of the
    table reaches the shuffle as one row per task.  Ids are given by a range-partitioned
    sort, whose tasks number their own tokens; no task sees the whole vocabulary.
    """
    specials = list(specials)
    if max_size is not None and max_size < len(specials):
        raise ValueError(f"max_size must be {len(specials)} at least")
    if isinstance(df, Blocks):
        entries = F.arrays_zip("_coded.elements", "_coded.counts")
        counted = df.rows.filter(F.col("_coded.elements").isNotNull()).select(F.inline(entries))
        tokens, number = counted.toDF("token", "n"), F.sum("n")
    else:
        # explode_outer: plain explode would have the tokens computed again in a filter
        tokens = df.select(F.explode_outer(column).alias("token")).filter(F.col("token").isNotNull())
        number = F.count(F.lit(1))
    if specials:
        tokens = tokens.filter(~F.col("token").isin(specials))
    counts = settle(tokens.groupBy("token").agg(number.alias("n")))
    ranked = numbered(counts, [F.desc("n"), F.asc("token")], "id", first=len(specials))
    if max_size is not None:
        ranked = ranked.filter(F.col("id") < max_size)
    learned = ranked.select("token", F.col("id").cast("int").alias("id"), "n", F.lit(False).alias("is_special"))
    if not specials:
        return learned
    given = learned.sparkSession.createDataFrame(
        [(t, i, 0, True) for i, t in enumerate(specials)], learned.schema
    )
    return given.unionByName(learned)


def special_id(vocab: DataFrame, token: str) -> DataFrame:
    """The id of one special token, as a table of one row."""
    return vocab.filter(F.col("is_special") & (F.col("token") == token)).select("token", "id")


def encode(
    df: DataFrame | Blocks,
    vocab: DataFrame,
    column: str = "tokens",
    out: str = "input_ids",
    unknown: int | None = None,
    lookup_rows: int = LOOKUP_ROWS,
) -> DataFrame:
    """Tokens to ids.  A token that is not in the vocabulary, and a null, becomes
    ``unknown``, or is left out when that is None; a null array stays null.

    For a vocabulary of more than ``lookup_rows`` entries the rows are written to the
    shared folder on the call.  Blocks have been written, are joined with a vocabulary of any
    size, and give ``out`` in place of their column."""
    pairs = vocab.select(
        F.col("token").alias("from"), F.col("id").alias("to"), "id", F.octet_length("token").alias("bytes")
    )
    return _translate(df, pairs, column, out, unknown, lookup_rows)


def decode(
    df: DataFrame,
    vocab: DataFrame,
    column: str = "input_ids",
    out: str = "text",
    skip_special: bool = True,
    lookup_rows: int = LOOKUP_ROWS,
) -> DataFrame:
    """Ids to text, without the special tokens unless asked for.

    With a larger vocabulary the rows are written to the shared folder on the call, the ids
    with them unless ``out`` takes their place."""
    if skip_special:
        vocab = vocab.filter(~F.col("is_special"))
    pairs = vocab.select(
        F.col("id").alias("from"), F.col("token").alias("to"), "id", F.octet_length("token").alias("bytes")
    )
    if _looks_up(pairs, lookup_rows):
        tokens = _looked_up(df, pairs.select("from", "to"), column, "_decoded")
        return tokens.withColumn(out, F.array_join(F.array_compact("_decoded"), "")).drop("_decoded")
    blocks = _in_blocks(df, column, [c for c in df.columns if c != out])
    text = _joined(blocks, pairs.select("from", "to"), out, _texts(), "string")
    return text.select(*df.columns, *([] if out in df.columns else [out]))


def _translate(
    df: DataFrame | Blocks, pairs: DataFrame, column: str, out: str, default: int | None, lookup_rows: int
) -> DataFrame:
    """Map the elements of an array column through the table ``from, to``."""
    if not isinstance(df, Blocks) and _looks_up(pairs, lookup_rows):
        mapped = _looked_up(df, pairs.select("from", "to"), column, out, default)
    else:
        blocks = df if isinstance(df, Blocks) else _in_blocks(df, column, [c for c in df.columns if c != out])
        image = f"array<{pairs.schema['to'].dataType.simpleString()}>"
        mapped = _joined(blocks, pairs.select("from", "to"), out, _arrays(default), image)
    return mapped if default is not None else mapped.withColumn(out, F.array_compact(out))


def _looks_up(pairs: DataFrame, lookup_rows: int) -> bool:
    low = (F.col("id") < lookup_rows) & (F.col("bytes") <= LOOKUP_BYTES)
    return pairs.filter(~low).isEmpty()


def _looked_up(
    df: DataFrame,
    pairs: DataFrame,
    column: str,
    out: str,
    default: int | None = None,
    slots: int = 1 << 16,
) -> DataFrame:
    """Map through a hash table of a bounded number of pairs; no shuffle of df.

    The table is the value of a scalar subquery.  It must be folded into the one
    expression that uses it and never become a column of the rows, which would
    copy it into each.  Catalyst folds two projections when no costly expression
    of the lower is used twice by the upper.  So the array, which may be such an
    expression, is used once: if it is to be kept, it travels with its image.
    """

    def slot(value: Column | str) -> Column:
        return F.pmod(F.xxhash64(value), F.lit(slots)).cast("int")

    entries = pairs.select(slot("from").alias("slot"), F.struct("from", "to").alias("entry"))
    no_entry = F.lit(None).cast(entries.schema["entry"].dataType).alias("entry")
    empty = df.sparkSession.range(slots).select(F.col("id").cast("int").alias("slot"), no_entry)
    table = (
        entries.union(empty)
        .groupBy("slot")
        .agg(F.collect_list("entry").alias("entries"))
        .agg(F.sort_array(F.collect_list(F.struct("slot", "entries"))).alias("slots"))
        .select(F.transform("slots", lambda s: F.map_from_entries(s["entries"])))
    )
    carried = df.select("*", table.scalar().alias("_lookup"))

    def find(element: Column) -> Column:
        element = element.cast(pairs.schema["from"].dataType)
        found = F.get(F.col("_lookup"), slot(element))[element]
        return found if default is None else F.coalesce(found, F.lit(default))

    kept = [c for c in df.columns if c != out]
    if column not in kept:
        return carried.select(*kept, F.transform(column, find).alias(out))
    both = F.transform(column, lambda e: F.struct(e.alias("from"), find(e).alias("to")))
    others = [c for c in kept if c != column]
    mapped = carried.select(*others, both.alias("_both"))
    return mapped.select(
        *(F.col("_both.from").alias(c) if c == column else c for c in kept),
        F.col("_both.to").alias(out),
    )


def _in_blocks(df: DataFrame, column: str, kept: list[str]) -> Blocks:
    array = df.select(column).schema[0].dataType
    fields = f"block: bigint, codes: binary, elements: {array.simpleString()}, counts: array<bigint>"
    coded = F.arrow_udf(_coded(BLOCK_ELEMENTS), f"struct<{fields}>").asNondeterministic()
    # blocks differ from run to run; the rows and dictionaries that are written stay as they are.
    # No iterator of batches, so that Spark hands arrays of another such function on in Python
    return Blocks(settle(df.select(*kept, coded(column).alias("_coded"))), column, array.elementType)


def _joined(blocks: Blocks, pairs: DataFrame, out: str, image: Callable, image_type: str) -> DataFrame:
    """Map elements through a join of each block's distinct elements; ``image`` makes a
    column of the elements' images in a batch of rows."""
    rows = blocks.rows
    kept = [c for c in rows.columns if c not in ("_coded", out)]
    block = F.col("_coded.block").alias("_block")
    asked = rows.filter(F.col("_coded.elements").isNotNull()).select(
        block, F.posexplode("_coded.elements").alias("_code", "from")
    )
    asked = asked.withColumn("from", F.col("from").cast(pairs.schema["from"].dataType))
    # the entries of a block's dictionary, then its rows; one number is sorted, not two columns
    place = F.shiftleft("_block", 1)
    first = asked.join(pairs, "from", "left").select(place.alias("_place"), "_code", F.col("to").alias("_to"))
    behind = rows.select(*kept, block, F.col("_coded.codes").alias("_codes"))
    behind = behind.withColumn("_place", place + 1).drop("_block")
    placed = (
        first.unionByName(behind, allowMissingColumns=True)
        .repartition(F.shiftright("_place", 1))
        .sortWithinPartitions("_place")
    )
    # not deterministic, as the result depends on the rows before
    translated = F.arrow_udf(_images(image), image_type).asNondeterministic()("_place", "_codes", "_code", "_to")
    images = placed.select(*kept, "_place", translated.alias(out))
    return images.filter(F.col("_place").bitwiseAND(1) == 1).select(*kept, out)


def _lists(offsets: np.ndarray, values: pa.Array, nulls: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values, mask=pa.array(nulls))


def _offsets(lists: pa.Array) -> np.ndarray:
    """Where each list begins and ends among the values of all."""
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    return np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])


def _code_type(entries: int) -> type:
    """The short type that has room for the codes of a dictionary, and one for null."""
    return np.uint16 if entries < 1 << 16 else np.uint32


def _coded(most: int):
    """Each row's block, of some ``most`` elements, and the bytes of its elements' codes; the
    first row of a block has its dictionary and how often each entry occurs.  The code of null
    is the first behind the dictionary's."""

    number = None  # of the next block; each task has a copy of this

    def coded(lists: pa.Array) -> pa.Array:
        nonlocal number
        if number is None:
            number = TaskContext.get().partitionId() << 32
        ends, values = _offsets(lists), lists.flatten()
        # blocks of one size: a short one at the end would have most of a long one's dictionary
        blocks_here = max(1, -(-len(values) // most))
        of_row = ends[:-1] * blocks_here // max(1, len(values))
        is_first = np.diff(of_row, prepend=-1) != 0
        first = np.flatnonzero(is_first)
        codes, lengths, elements, counts = [], [], [], []
        sizes = np.zeros(len(lists), np.int64)
        for start, stop in zip(first, [*first[1:], len(lists)], strict=True):
            block = values.slice(ends[start], ends[stop] - ends[start]).dictionary_encode()
            n = len(block.dictionary)
            own = block.indices.fill_null(n).to_numpy().astype(_code_type(n))
            codes.append(own.tobytes())
            lengths.append(np.diff(ends[start : stop + 1]) * own.itemsize)
            elements.append(block.dictionary)
            counts.append(np.bincount(own, minlength=n)[:n])
            sizes[start] = n
        blocks = number + np.cumsum(is_first) - 1
        number += len(first)
        begins = np.concatenate([[0], np.cumsum(sizes)])
        places = np.concatenate([[0], np.cumsum(np.concatenate([[], *lengths]))]).astype(np.int32)
        packed = [None, pa.py_buffer(places), pa.py_buffer(b"".join(codes))]
        texts = pa.Array.from_buffers(pa.binary(), len(lists), packed)
        return pa.StructArray.from_arrays(
            [
                pa.array(blocks, pa.int64()),
                pc.if_else(pc.is_null(lists), None, texts),
                _lists(begins, pa.concat_arrays(elements or [values]), ~is_first),
                _lists(begins, pa.array(np.concatenate([np.zeros(0, np.int64), *counts])), ~is_first),
            ],
            ["block", "codes", "elements", "counts"],
        )

    return coded


def _images(image: Callable):
    """What the codes of each row stand for, by the entries of the dictionary that come before
    the rows of a block."""

    def images(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        current, entries, table = None, [], None
        for places, codes, numbers, to in batches:
            entry = to.type
            own_place = places.to_numpy(zero_copy_only=False)
            first = np.flatnonzero(np.diff(own_place, prepend=-1))
            found, sizes = [pa.array([], entry)], []
            for start, stop in zip(first, [*first[1:], len(own_place)], strict=True):
                block, is_row = divmod(int(own_place[start]), 2)
                if block != current:
                    current, entries, table = block, [], None
                if not is_row:
                    # a copy, so that no batch is held for its entries
                    part = (numbers.slice(start, stop - start), to.slice(start, stop - start))
                    entries.append([pa.concat_arrays([x, x[:0]]) for x in part])
                    sizes.append(np.zeros(stop - start, np.int64))
                    continue
                if table is None:
                    # a block of nulls has no entries
                    table = pa.concat_arrays([*_by_code(entries), pa.nulls(1, entry)])
                    entries = []
                kind = _code_type(len(table) - 1)
                own = codes.slice(start, stop - start)
                lengths = pc.fill_null(pc.binary_length(own), 0).to_numpy(zero_copy_only=False)
                joined = b"".join(own.drop_null().to_pylist())
                found.append(table.take(pa.array(np.frombuffer(joined, kind))))
                sizes.append(lengths // np.dtype(kind).itemsize)
            ends = np.concatenate([[0], np.cumsum(np.concatenate([[], *sizes]))]).astype(np.int32)
            yield image(ends, pa.concat_arrays(found), pc.is_null(codes).to_numpy(zero_copy_only=False))

    return images


def _by_code(entries: list[list[pa.Array]]) -> list[pa.Array]:
    if not entries:
        return []
    codes, images = (pa.concat_arrays(x) for x in zip(*entries, strict=True))
    codes = codes.to_numpy()
    order = np.argsort(codes)
    if (codes[order] != np.arange(len(codes))).any():
        raise ValueError("an element is in the vocabulary more than once")
    return [images.take(pa.array(order))]


def _arrays(default: int | None):
    def arrays(ends: np.ndarray, values: pa.Array, nulls: np.ndarray) -> pa.Array:
        return _lists(ends, values if default is None else values.fill_null(default), nulls)

    return arrays


def _texts():
    """The images of a row's elements put together, without nulls."""

    def texts(ends: np.ndarray, values: pa.Array, nulls: np.ndarray) -> pa.Array:
        values = pa.concat_arrays([values.fill_null("")])
        offsets = np.frombuffer(values.buffers()[1] or bytes(4), np.int32)[values.offset :][ends]
        joined = pa.Array.from_buffers(pa.string(), len(nulls), [None, pa.py_buffer(offsets), values.buffers()[2]])
        return pc.if_else(pa.array(nulls), None, joined)

    return texts
