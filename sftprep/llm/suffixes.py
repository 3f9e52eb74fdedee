"""Operator 7: removal of repeated byte strings, by suffix arrays of shards.

A byte goes if a string of ``length`` bytes that covers it also starts earlier: in a
document of a smaller key, or in the same document before.  Strings are judged on the
input, overlaps count, and none crosses a document's end.

A shard is a group of documents.  Of its texts only the stretches that can hold a
repeated string are taken (``sftprep.llm.windows``).  Their suffix array is made by
prefix doubling on the groups that are still equal (Larsson and Sadakane), in numpy,
and the common prefixes of neighbours in it by Kasai's observation that they shrink by
one at most from a text position to the next: only positions that can't inherit theirs
compare bytes.  Neighbours with ``length`` common bytes are one string; in the shard
all but its first start go.

Strings that start first in their shard may start earlier in another one.  They go to
the task of their anchor's hash as stretches of text.  There every shard is a sorted
array of its strings' fingerprints (128 bits); arrays are merged two by two: each
string of the one is looked up in the other by binary search, and of equal ones the
earlier start stays.

Defined results: a null text is empty; a null key counts as the largest key; rows of
one key and different texts are ordered by a hash of both; equal rows are one document,
and each gets that document's result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sftprep.llm.common import dropped, released, stored
from sftprep.llm.windows import (
    RUNS,
    anchors_of,
    blocks,
    by_document,
    byte_sequence,
    chunks,
    column_parts,
    covered,
    flat,
    group_count,
    hash_group,
    in_groups,
    joined_runs,
    keyed,
    marked,
    mixed,
    ranges,
    repeated_anchors,
    rolled,
    runs,
    whole,
    without_runs,
)

GRAM = 32
#: Bytes of candidate text for one suffix array: a shard takes several if it has more.
SHARD_BYTES = 3_000_000
_LISTS = "text array<binary>, first array<long>, of_print array<long>, at array<int>"
_OTHER_BASE = np.uint64(0xD6E8FEB86659FD93)


def suffix_array(text: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Start positions in the order of their suffixes.

    ``text`` has one place more after each stretch, at ``ends``: a mark that is smaller
    than every byte and differs from all other marks, the earlier the smaller.
    """
    n = len(text)
    left = _to_mark(ends)
    # seven bytes and how many of them there are; a suffix with fewer is unique
    padded = np.zeros(n + 7, np.uint64)
    padded[:n] = text
    start = np.zeros(n, np.uint64)
    for i in range(7):
        start = (start << np.uint64(8)) | np.where(left > i, padded[i : i + n], 0)
    start = (start << np.uint64(8)) | np.minimum(left, 7).astype(np.uint64)
    order = np.argsort(start)
    few = np.flatnonzero(left[order] < 7)  # of equal ones the earlier mark comes first
    order[few] = order[few][np.lexsort((order[few], start[order[few]]))]
    sorted_ = start[order]
    new = np.concatenate([[True], sorted_[1:] != sorted_[:-1]]) | (left[order] < 7)
    head = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[order] = head
    last = np.append(new[1:], True)
    open_ = np.flatnonzero(~(new & last))  # places of groups with more than one suffix
    step = 7
    while len(open_):
        suffix = order[open_]
        keys = (rank[suffix] << 32) | rank[suffix + step]
        inside = np.argsort(keys)
        suffix, keys = suffix[inside], keys[inside]
        order[open_] = suffix
        new = np.concatenate([[True], keys[1:] != keys[:-1]])
        head = open_[np.maximum.accumulate(np.where(new, np.arange(len(open_)), 0))]
        rank[suffix] = head
        last = np.append(new[1:], True)
        open_ = open_[~(new & last)]
        step *= 2
    return order


def _to_mark(ends: np.ndarray) -> np.ndarray:
    """Of each place: bytes to the mark of its stretch."""
    return np.repeat(ends, np.diff(ends, prepend=-1)) - np.arange(int(ends[-1]) + 1)


def common_prefixes(text: np.ndarray, ends: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Of each place of the suffix array: bytes in common with the suffix before it."""
    n = len(text)
    before = np.empty(n, np.int64)  # of each text position: the suffix before it
    before[order[1:]] = order[:-1]
    before[order[0]] = -1
    left = _to_mark(ends)
    mark = np.zeros(n, bool)
    mark[ends] = True
    # a position whose left neighbour equals that of the suffix before it inherits
    inherits = np.zeros(n, bool)
    j = np.flatnonzero(before[1:] > 0) + 1
    inherits[j] = (text[j - 1] == text[before[j] - 1]) & ~mark[j - 1] & ~mark[before[j] - 1]
    own = np.flatnonzero(~inherits)
    prefix = np.zeros(n, np.int64)
    own_with = own[before[own] >= 0]
    most = np.minimum(left[own_with], left[before[own_with]])
    words = np.zeros(n + 8, np.uint8)
    words[:n] = text
    words = np.lib.stride_tricks.sliding_window_view(words, 8)
    at, other, done = own_with, before[own_with], np.zeros(len(own_with), np.int64)
    going = np.flatnonzero(most > 0)
    while len(going):
        same = words[at[going] + done[going]] == words[other[going] + done[going]]
        equal = np.where(same.all(1), 8, same.argmin(1))
        done[going] += equal
        going = going[(equal == 8) & (done[going] < most[going])]
    prefix[own_with] = np.minimum(done, most)
    # the others have one less than their left neighbour
    source = np.maximum.accumulate(np.where(inherits, 0, np.arange(n)))
    prefix = prefix[source] - (np.arange(n) - source)
    return prefix[order]


def later_starts(text: np.ndarray, ends: np.ndarray, length: int) -> np.ndarray:
    """Flags of the starts of strings that also start before; texts are in order."""
    order = suffix_array(text, ends)
    prefixes = common_prefixes(text, ends, order)
    borders = np.flatnonzero(prefixes < length)
    sizes = np.diff(np.append(borders, len(order)))
    first = np.minimum.reduceat(order, borders)
    later = np.zeros(len(text), bool)
    later[order] = order > np.repeat(first, sizes)
    return later


def merged(runs_: list[tuple], other: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Numbers of the strings that start earlier in another sorted array.

    An array has fingerprints, sorted, and the strings' numbers; ``other`` is the
    second half of the fingerprints and ``start`` the order of the starts, by number.
    """
    lost: list[np.ndarray] = [np.zeros(0, np.int64)]
    while len(runs_) > 1:
        runs_ = [
            _merge(*runs_[i], *runs_[i + 1], other, start, lost) if i + 1 < len(runs_) else runs_[i]
            for i in range(0, len(runs_), 2)
        ]
    return np.concatenate(lost)


def _merge(a, a_number, b, b_number, other, start, lost: list) -> tuple:
    place = np.searchsorted(a, b)
    place[place == len(a)] = 0
    hit = np.flatnonzero(a[place] == b)
    of_a, of_b = a_number[place[hit]], b_number[hit]
    same = other[of_a] == other[of_b]
    hit, of_a, of_b = hit[same], of_a[same], of_b[same]
    earlier = start[of_b] < start[of_a]
    lost += [of_a[earlier], of_b[~earlier]]
    # the place in a keeps the earlier start; what else b has is merged in
    a_number = a_number.copy()
    a_number[place[hit[earlier]]] = of_b[earlier]
    new = np.ones(len(b), bool)
    new[hit] = False
    keys, numbers = np.concatenate([a, b[new]]), np.concatenate([a_number, b_number[new]])
    order = np.argsort(keys, kind="stable")  # two sorted runs
    return keys[order], numbers[order]


def removed_runs(rows: DataFrame, groups: int, length: int) -> DataFrame:
    """Blocks of the strings that go: document group, key, print, start, count."""
    again = stored(
        repeated_anchors(rows, groups, byte_sequence, length, GRAM, False, 1 << 62), "repeated-byte-grams"
    )

    def shard(left: pa.Table, right: pa.Table) -> pa.Table:
        known = by_document(right, "place")
        left = left.combine_chunks()
        ids, prints = left.column("_id").to_numpy(), left.column("_print").to_numpy()
        order = np.lexsort((prints, ids))  # the order of starts; equal rows are one document
        new = np.concatenate(
            [[True], (ids[order][1:] != ids[order][:-1]) | (prints[order][1:] != prints[order][:-1])]
        ) if len(order) else np.zeros(0, bool)
        left = left.take(pa.array(order[new])).combine_chunks()
        ids, prints = left.column("_id").to_numpy(), left.column("_print").to_numpy()
        out, held, size = [], [], 0
        for column, base in column_parts(left, "_text"):
            for first, last, raw, offsets in chunks(column):
                seq = byte_sequence(raw, offsets)
                a = anchors_of(seq, length, GRAM)
                own, printed = ids[base + first : base + last], prints[base + first : base + last]
                hit = marked(a, seq, known, own, printed)
                if not hit.any():
                    continue
                window, count, owner = a.window[hit], a.count[hit], a.owner[hit]
                # windows of neighbouring anchors are one stretch
                new = np.concatenate([[True], window[1:] != window[:-1] + count[:-1]])
                lead = np.flatnonzero(new)
                sizes = np.add.reduceat(count, lead) + length - 1
                held.append(
                    (
                        raw[ranges(window[lead], sizes)], sizes, window[lead] - seq.first[owner[lead]],
                        own[owner[lead]], printed[owner[lead]], a.hash[hit], count, np.cumsum(new) - 1,
                    )
                )
                size += int(sizes.sum())
                if size >= SHARD_BYTES:
                    out += _of_shard(held, length, groups)
                    held, size = [], 0
        if held:
            out += _of_shard(held, length, groups)
        return pa.concat_tables(out) if out else _SCHEMA.empty_table()

    def merge(table: pa.Table) -> pa.Table:
        found = [joined_runs(*(flat(table, c) for c in ("id", "print", "start", "count")))]
        texts = pa.concat_arrays([c.flatten() for c in table.column("text").chunks]) if len(table) else []
        if len(texts):
            raw, offsets = whole(texts)
            ids, prints, at = (flat(table, c) for c in ("first", "of_print", "at"))
            # documents by number, in the order of starts
            order = np.lexsort((prints, ids))
            new = (np.diff(ids[order], prepend=ids[order[0]]) != 0) | (np.diff(prints[order], prepend=prints[order[0]]) != 0)
            document = np.empty(len(ids), np.int64)
            document[order] = np.cumsum(new)
            count = np.diff(offsets) - length + 1
            begin = ranges(offsets[:-1], count)
            seq = byte_sequence(raw, offsets).symbols
            one, two = mixed(rolled(seq, length)[begin]), rolled(seq, length, _OTHER_BASE)[begin]
            shift = (document << 32) + at - offsets[:-1]
            start = np.repeat(shift, count) + begin
            # a row is one shard: sorted by fingerprint, of equal ones the first start
            rows_of = pa.compute.fill_null(pa.compute.list_value_length(table.column("text")), 0).to_numpy()
            borders = np.cumsum(np.append(0, count))[np.cumsum(np.append(0, rows_of))]
            sorted_runs = []
            for low, high in zip(borders[:-1], borders[1:], strict=True):
                if low == high:
                    continue
                number = low + np.argsort(one[low:high], kind="stable")
                first = np.append(True, (one[number[1:]] != one[number[:-1]]) | (two[number[1:]] != two[number[:-1]]))
                number = number[first]
                sorted_runs.append((one[number], number))
            lost = merged(sorted_runs, two, start)
            text_of = np.searchsorted(np.cumsum(count), lost, "right")
            place = at[text_of] + begin[lost] - offsets[text_of]
            found.append(joined_runs(ids[text_of], prints[text_of], place, np.ones(len(lost), np.int64)))
        joined = joined_runs(*(np.concatenate([f[c] for f in found]) for c in ("id", "print", "start", "count")))
        to = hash_group(joined["id"], joined["print"], groups)
        return pa.Table.from_batches([blocks(to, groups, joined)])

    documents = in_groups(rows, groups, "_id", "_print", "_text").groupBy("_to")
    found = documents.cogroup(again.groupBy("_to")).applyInArrow(shard, f"_to long, {_LISTS}, {RUNS}")
    gone = stored(found.groupBy("_to").applyInArrow(merge, f"_to long, {RUNS}"), "removed-strings")
    dropped(again)
    return gone


def _of_shard(held: list[tuple], length: int, groups: int) -> list[pa.Table]:
    """Runs of starts that go in one shard, and the stretches that other shards must see."""
    sizes = np.concatenate([h[1] for h in held])
    shift = np.cumsum([0] + [len(h[1]) for h in held])
    start, id_, print_ = (np.concatenate([h[i] for h in held]) for i in (2, 3, 4))
    hashes, count = (np.concatenate([h[i] for h in held]) for i in (5, 6))
    stretch = np.concatenate([h[7] + s for h, s in zip(held, shift, strict=False)])
    bytes_ = np.concatenate([h[0] for h in held])
    begins = np.cumsum(sizes + 1) - sizes - 1  # one place more after each stretch
    text = np.zeros(len(bytes_) + len(sizes), np.uint8)
    text[ranges(begins, sizes)] = bytes_
    ends = begins + sizes
    # a window start is any place with ``length`` bytes before the mark
    later = later_starts(text, ends, length)
    window_starts = np.zeros(len(text), bool)
    window_starts[ranges(begins, sizes - length + 1)] = True
    later &= window_starts
    run, n = runs(later)
    of = np.searchsorted(begins, run, "right") - 1
    done = joined_runs(id_[of], print_[of], start[of] + run - begins[of], n)
    out = [_filled(blocks(hash_group(done["id"], done["print"], groups), groups, done))]
    # stretches by anchor, without those whose windows all go
    inside = np.cumsum(count) - count
    lead = np.concatenate([[True], stretch[1:] != stretch[:-1]])
    inside = inside - np.repeat(inside[lead], np.diff(np.append(np.flatnonzero(lead), len(stretch))))
    at = begins[stretch] + inside
    stays = np.concatenate([[0], np.cumsum(~later)])
    alive = stays[at + count] > stays[at]
    at, count, stretch, inside, hashes = at[alive], count[alive], stretch[alive], inside[alive], hashes[alive]
    if len(at):
        data = text.tobytes()
        texts = [data[x:y] for x, y in zip(at.tolist(), (at + count + length - 1).tolist(), strict=True)]
        columns = {
            "text": pa.array(texts, pa.binary()), "first": id_[stretch], "of_print": print_[stretch],
            "at": (start[stretch] + inside).astype(np.int32),
        }
        out.append(_filled(blocks((hashes >> np.uint64(33)).astype(np.int64) % groups, groups, columns)))
    return out


_SCHEMA = pa.schema(
    dict(
        _to=pa.int64(), text=pa.list_(pa.binary()), first=pa.list_(pa.int64()), of_print=pa.list_(pa.int64()),
        at=pa.list_(pa.int32()), id=pa.list_(pa.int64()), print=pa.list_(pa.int64()), start=pa.list_(pa.int32()),
        count=pa.list_(pa.int32()),
    )
)


def _filled(batch: pa.RecordBatch) -> pa.Table:
    """All columns of the shards' rows; those that are missing hold empty lists."""
    table = pa.Table.from_batches([batch])
    for field in _SCHEMA:
        if field.name not in table.column_names:
            table = table.append_column(field.name, pa.array([[]] * len(table), field.type))
    return table.select(_SCHEMA.names).cast(_SCHEMA)


def without_repeats(docs: DataFrame, length: int = 100, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns of ``docs`` but the text, and n_bytes, n_removed, n_spans, kept (binary).

    Columns of these names are replaced.
    """
    rows = keyed(docs, key, text)
    groups = group_count(rows, "_text")
    gone = removed_runs(rows, groups, length)
    released(docs.sparkSession)

    def cut(content: str, runs_: list | None) -> tuple:
        data = content.encode()
        if runs_ is None:
            return len(data), 0, 0, data
        flags = covered(len(data), *runs_, length)
        kept = np.frombuffer(data, np.uint8)[~flags].tobytes()
        return len(data), len(data) - len(kept), len(runs(flags)[0]), kept

    names = [c for c in docs.columns if c not in (text, "n_bytes", "n_removed", "n_spans", "kept")]
    added = "n_bytes long, n_removed long, n_spans long, kept binary"
    left = without_runs(rows, gone, groups, cut, added)
    own = [F.col("_row")[c].alias(c) for c in names]
    return left.select(*own, "n_bytes", "n_removed", "n_spans", "kept")
