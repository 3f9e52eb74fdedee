"""What both removals of repeated passages share: anchors, blocks, coverage.

A passage is a window of fixed length over a sequence of symbols (words or bytes).
To find equal windows in different tasks without a shuffle of every window, each
window names its *anchor*: of all its k-grams the one with the least hash (leftmost
of equals).  Equal windows have equal anchors, at the same place in the window, and
neighbouring windows mostly share theirs, so anchors are few.  Windows whose anchor's
k-gram occurs once cannot be repeated.  The other windows go to the task of their
anchor's hash, all windows of one anchor as one stretch of text.

Rows between tasks are *blocks*: one row for each task and destination with lists in
it, so that the cost of a row is not paid for each anchor.  Documents are dealt out by
a hash of their key, in groups of about ``GROUP_BYTES``: the number of groups follows
the size of the corpus.

A document is known by its key (an integer; null counts as the largest) and a hash of
key and text, which tells rows with one key and different texts apart.  Equal rows are
one document.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sftprep.llm.common import text_of

GROUP_BYTES = 6_000_000
#: Bytes of text that a task holds as numbers at a time (a longer text is held whole).
CHUNK = 2_000_000
LAST_KEY = (1 << 63) - 1

_random = np.random.default_rng(20240607)
_BYTE = _random.integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def rolled(symbols: np.ndarray, length: int, base: np.uint64 = _BASE) -> np.ndarray:
    """Polynomial hash of each stretch of ``length`` symbols, by doubling."""
    out, done = None, 0
    part, width, power = symbols, 1, base
    with np.errstate(over="ignore"):
        while length:
            if length & 1:
                if out is None:
                    out = part
                else:
                    n = len(part) - done
                    out = out[:n] * power + part[done : done + n]
                done += width
            length >>= 1
            if length:
                part = part[:-width] * power + part[width:]
                power = power * power
                width *= 2
    return out


@dataclass
class Sequence:
    """Symbols of several texts in a row."""

    symbols: np.ndarray  # 64-bit numbers
    owner: np.ndarray  # of each symbol: number of its text
    first: np.ndarray  # of each text: its first symbol
    begin: np.ndarray  # of each symbol: its first byte
    end: np.ndarray  # of each symbol: the byte after it


def byte_sequence(raw: np.ndarray, offsets: np.ndarray) -> Sequence:
    owner = np.repeat(np.arange(len(offsets) - 1, dtype=np.int64), np.diff(offsets))
    at = np.arange(len(raw), dtype=np.int64)
    return Sequence(_BYTE[raw], owner, offsets[:-1], at, at + 1)


def word_sequence(raw: np.ndarray, offsets: np.ndarray, lower: np.ndarray | None = None) -> Sequence:
    """Words are runs of anything but six white-space bytes; ``lower`` maps bytes first."""
    word = ~_SPACE[raw]
    border = np.zeros(len(raw) + 1, bool)
    border[offsets] = True
    starts = np.flatnonzero(word & (border[:-1] | ~np.concatenate([[False], word[:-1]])))
    ends = np.flatnonzero(word & (border[1:] | ~np.concatenate([word[1:], [False]]))) + 1
    n = len(starts)
    if not n:
        none = np.zeros(0, np.int64)
        return Sequence(np.zeros(0, np.uint64), none, np.zeros(len(offsets) - 1, np.int64), none, none)
    lengths = ends - starts
    inside = np.flatnonzero(word)
    place = np.cumsum(lengths) - lengths
    nth = np.arange(len(inside)) - np.repeat(place, lengths)
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.full(int(lengths.max()), _BASE, np.uint64))
        letters = raw if lower is None else lower[raw]
        symbols = mixed(np.add.reduceat(_BYTE[letters[inside]] * powers[nth], place))
    first = np.searchsorted(starts, offsets[:-1])
    owner = np.searchsorted(offsets, starts, "right") - 1
    return Sequence(symbols, owner, first, starts, ends)


@dataclass
class Anchors:
    """Of each anchor: hash, place, first window, number of windows, text's number."""

    hash: np.ndarray
    place: np.ndarray
    window: np.ndarray
    count: np.ndarray
    owner: np.ndarray


def anchors_of(seq: Sequence, length: int, gram: int) -> Anchors:
    n = len(seq.symbols) - length + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return Anchors(np.zeros(0, np.uint64), none, none, none, none)
    with np.errstate(over="ignore"):
        hashes = mixed(rolled(seq.symbols, gram))
    best = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64)
    width, wide = 1, length - gram + 1
    while width * 2 <= wide:
        best = np.minimum(best[:-width], best[width:])
        width *= 2
    if wide > width:
        best = np.minimum(best[: n], best[wide - width : wide - width + n])
    inside = np.flatnonzero(seq.owner[:n] == seq.owner[length - 1 :])
    place = (best[inside] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    if not len(place):
        return Anchors(np.zeros(0, np.uint64), none, none, none, none)
    new = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    window = inside[new]
    count = np.diff(np.concatenate([new, [len(place)]]))
    return Anchors(hashes[place[new]], place[new], window, count, seq.owner[window])


def chunks(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First and last row, bytes and offsets of some texts at a time (no nulls)."""
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + CHUNK, "right")) - 1
        last = min(max(last, first + 1), len(column))
        yield first, last, raw[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def whole(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of all texts of an array."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def column_parts(table: pa.Table, name: str) -> Iterator[tuple[pa.Array, int]]:
    """The arrays of a column and the number of their first row."""
    base = 0
    for part in table.column(name).chunks:
        yield part, base
        base += len(part)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All numbers of several ranges, one after the other."""
    place = np.cumsum(lengths) - lengths
    return np.arange(int(lengths.sum())) + np.repeat(starts - place, lengths)


def blocks(to: np.ndarray, groups: int, columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    """One row for each destination: ``to`` and lists of the columns' values."""
    order = np.argsort(to, kind="stable")
    present, counts = np.unique(to, return_counts=True)
    ends = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
    lists = [
        pa.ListArray.from_arrays(ends, v.take(pa.array(order)) if isinstance(v, pa.Array) else pa.array(v[order]))
        for v in columns.values()
    ]
    return pa.record_batch([pa.array(present.astype(np.int64)), *lists], ["_to", *columns])


def flat(table: pa.Table, name: str) -> np.ndarray:
    """The values of a list column, row after row."""
    return table.column(name).combine_chunks().flatten().to_numpy(zero_copy_only=False)


def hash_group(id_: np.ndarray, print_: np.ndarray, groups: int) -> np.ndarray:
    """A document's group, as ``keyed`` gives it."""
    return ((print_ ^ (print_ >> 32)) & 0x7FFFFFFF) % groups


def keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``_text``, ``_no_text`` (it was null), ``_id``, ``_print`` and all other columns of
    ``docs`` as one, ``_row``, so that their names can't clash with those."""
    others = [F.col(f"`{c}`") for c in docs.columns if c != text]
    rows = docs.select(
        F.struct(*(others or [F.lit(0).alias("_")])).alias("_row"),
        text_of(text).alias("_text"),
        F.col(text).isNull().alias("_no_text"),
        F.coalesce(F.col(key).cast("long"), F.lit(LAST_KEY)).alias("_id"),
    )
    return rows.withColumn("_print", F.xxhash64("_id", "_text"))


def text_again() -> Column:
    """The text of a ``keyed`` row as it was."""
    return F.when(~F.col("_no_text"), F.col("_text"))


def _group(groups: int) -> Column:
    folded = F.expr("(_print ^ shiftright(_print, 32)) & 2147483647L")
    return (folded % groups).alias("_to")


def group_count(docs: DataFrame, text: str) -> int:
    """Groups of documents: by size, and some for each shuffle partition."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return max(int(size // GROUP_BYTES), 3 * int(spark.conf.get("spark.sql.shuffle.partitions")), 1)


def repeated_anchors(
    rows: DataFrame,
    groups: int,
    sequence: Callable,
    length: int,
    gram: int,
    by_document: bool,
    large: int,
) -> DataFrame:
    """Blocks of the anchors that occur again: ``_to`` (the document's group), lists
    ``id``, ``print``, ``place`` (in the document) and ``large`` (1 if the k-gram occurs
    more than ``large`` times).

    With ``by_document`` the occurrences must be of different keys.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            prints = batch.column(1).to_numpy()
            for first, _, raw, offsets in chunks(batch.column(2)):
                seq = sequence(raw, offsets)
                a = anchors_of(seq, length, gram)
                yield blocks(
                    (a.hash >> np.uint64(33)).astype(np.int64) % groups, groups,
                    {
                        "hash": a.hash.view(np.int64), "id": ids[first + a.owner], "print": prints[first + a.owner],
                        "place": (a.place - seq.first[a.owner]).astype(np.int32),
                    },
                )

    def again(table: pa.Table) -> pa.Table:
        hashes, ids = flat(table, "hash"), flat(table, "id")
        order = np.argsort(hashes, kind="stable")
        sorted_ = hashes[order]
        new = np.concatenate([[True], sorted_[1:] != sorted_[:-1]]) if len(order) else np.zeros(0, bool)
        starts = np.flatnonzero(new)
        number = np.cumsum(new) - 1
        if by_document:
            named = ids[order]
            hit = np.minimum.reduceat(named, starts) < np.maximum.reduceat(named, starts) if len(starts) else new
        else:
            hit = np.diff(np.concatenate([starts, [len(order)]])) > 1
        times = np.diff(np.concatenate([starts, [len(order)]]))
        kept = order[hit[number]] if len(order) else order
        many = (times > large)[number[hit[number]]] if len(order) else new
        ids, prints = ids[kept], flat(table, "print")[kept]
        out = blocks(
            hash_group(ids, prints, groups), groups,
            {
                "id": ids, "print": prints, "place": flat(table, "place")[kept],
                "large": many.astype(np.int32),
            },
        )
        return pa.Table.from_batches([out])

    lists = "id array<long>, print array<long>, place array<int>"
    found = rows.select("_id", "_print", "_text").mapInArrow(find, f"_to long, hash array<long>, {lists}")
    return found.groupBy("_to").applyInArrow(again, f"_to long, {lists}, large array<int>")


def marked(a: Anchors, seq: Sequence, known: dict, ids: np.ndarray, prints: np.ndarray) -> np.ndarray:
    """Which anchors are among ``known``: places by document, as sorted arrays."""
    hit = np.zeros(len(a.place), bool)
    borders = np.searchsorted(a.owner, np.arange(len(ids) + 1))
    for i in range(len(ids)):
        places = known.get((int(ids[i]), int(prints[i])))
        low, high = borders[i], borders[i + 1]
        if places is None or not len(places) or low == high:
            continue
        own = a.place[low:high] - seq.first[i]
        found = np.searchsorted(places, own)
        found[found == len(places)] = 0
        hit[low:high] = places[found] == own
    return hit


def by_document(table: pa.Table, *names: str) -> dict:
    """Lists of blocks, taken apart by document: (id, print) to arrays."""
    ids, prints = flat(table, "id"), flat(table, "print")
    columns = [flat(table, n) for n in names]
    order = np.lexsort((columns[0], prints, ids))
    ids, prints = ids[order], prints[order]
    if not len(ids):
        return {}
    new = np.flatnonzero(np.concatenate([[True], (ids[1:] != ids[:-1]) | (prints[1:] != prints[:-1])]))
    ends = np.append(new[1:], len(ids))
    columns = [c[order] for c in columns]
    return {
        (int(ids[a]), int(prints[a])): [c[a:b] for c in columns] if len(names) > 1 else columns[0][a:b]
        for a, b in zip(new, ends, strict=True)
    }


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First places and lengths of the stretches of True."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8)))
    return edges[::2], edges[1::2] - edges[::2]


def covered(count: int, starts: np.ndarray, lengths: np.ndarray, length: int) -> np.ndarray:
    """Symbols of one document that windows of the given runs of starts cover."""
    change = np.zeros(count + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + lengths + length - 1, -1)
    return np.cumsum(change[:-1]) > 0


def in_groups(rows: DataFrame, groups: int, *columns: str) -> DataFrame:
    """The documents with the number of their group."""
    return rows.select(_group(groups), *columns)


def joined_runs(id_: np.ndarray, print_: np.ndarray, start: np.ndarray, count: np.ndarray) -> dict[str, np.ndarray]:
    """Runs of windows by document and start; runs that meet or overlap become one."""
    order = np.lexsort((start, print_, id_))
    id_, print_, start, count = id_[order], print_[order], start[order].astype(np.int64), count[order]
    if not len(id_):
        return {"id": id_, "print": print_, "start": start.astype(np.int32), "count": count.astype(np.int32)}
    document = np.cumsum(
        np.concatenate([[0], (id_[1:] != id_[:-1]) | (print_[1:] != print_[:-1])]).astype(np.int64)
    )
    wide = document << 32  # keeps the running maximum inside a document
    reach = np.maximum.accumulate(wide + start + count)
    new = np.concatenate([[True], wide[1:] + start[1:] > reach[:-1]])
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(start)) - 1
    return {
        "id": id_[at], "print": print_[at], "start": start[at].astype(np.int32),
        "count": (reach[last] - wide[at] - start[at]).astype(np.int32),
    }


def ranges_hash(symbols: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """A hash of each range of symbols, equal for equal ranges."""
    if not len(start):
        return np.zeros(0, np.uint64)
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    with np.errstate(over="ignore"):
        n = len(symbols)
        powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, _BASE, np.uint64)]))
        sums = np.concatenate([[np.uint64(0)], np.cumsum(symbols * powers)])
        back = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, inverse, np.uint64)]))
        return mixed((sums[start + length] - sums[start]) * back[start] + length.astype(np.uint64))


RUNS = "id array<long>, print array<long>, start array<int>, count array<int>"


def without_runs(
    rows: DataFrame, runs_: DataFrame, groups: int, cut: Callable, added: str
) -> DataFrame:
    """``_row`` and ``_no_text`` of the documents, and what ``cut`` makes of each text and
    its runs.

    ``cut(text, runs)`` returns a tuple of the columns ``added``.
    """
    names = ["_row", "_no_text"]
    schema = StructType([rows.schema[n] for n in names] + list(StructType.fromDDL(added)))

    def apply(left: pa.Table, right: pa.Table) -> pa.Table:
        known = by_document(right, "start", "count")
        keys = zip(left.column("_id").to_pylist(), left.column("_print").to_pylist(), strict=True)
        made = [cut(text.as_py(), known.get(k)) for k, text in zip(keys, left.column("_text"), strict=True)]
        table = left.select(names)
        for i, column in enumerate(added.split(", ")):
            name, kind = column.split(" ")
            kind = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[kind]
            table = table.append_column(name, pa.array([m[i] for m in made], kind))
        return table

    left = in_groups(rows, groups, "_id", "_print", "_text", *names).groupBy("_to")
    return left.cogroup(runs_.groupBy("_to")).applyInArrow(apply, schema)
