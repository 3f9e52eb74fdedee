"""Operator 4: removal of repeated passages of words, by prefix-partitioned suffix trees.

A passage is a window of ``length`` words.  A word goes if a window that covers it has
a word sequence that also starts in a document of a smaller key; windows are judged on
the input.

The suffixes of all documents that can have a repeated window (``sftprep.llm.windows``)
are split into groups by a prefix, so that a group fits a task: suffixes share a group
if they share the first ``GRAM`` words from their anchor on.  Where more than ``LARGE``
suffixes share these, the prefix grows to the whole window, so that a frequent phrase
is many groups and not one.  A task builds the suffix tree of its group top down: the
nodes of word depth 1, 2, 4, 8 and ``length`` follow from one another, for a node at
depth a + b is a pair of nodes, at depth a and, a words on, at depth b.  A node of
depth ``length`` with leaves of several documents is a repeated passage; all leaves but
those of the smallest key go, and neighbouring leaves make up maximal repeats.

Before the shuffle every task keeps one stretch of text of each that it has several
times, so copies in large groups cost one row for each task.

Defined results: a null text has no words; a null key counts as the largest key; rows
of equal keys never take passages from one another; the kept words are joined by one
space, so the empty text is what remains of a text without words.  With ``spaces`` the
words stand as they stood in the input.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sftprep.llm.common import dropped, released, stored
from sftprep.llm.windows import (
    RUNS,
    anchors_of,
    blocks,
    by_document,
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
    ranges,
    ranges_hash,
    repeated_anchors,
    runs,
    whole,
    without_runs,
    word_sequence,
)

GRAM = 4
LARGE = 10_000
_STRETCHES = (
    "text array<binary>, first array<long>, windows array<int>,"
    " of_text array<int>, of_print array<long>, at array<int>"
)


def _grown(hash_: np.ndarray, window: np.ndarray, count: np.ndarray, large: np.ndarray):
    """Stretches of large prefixes, one for each window: (source, window, count)."""
    source = np.arange(len(window))
    small = ~large
    each = ranges(window[large], count[large])
    return (
        np.concatenate([source[small], np.repeat(source[large], count[large])]),
        np.concatenate([window[small], each]).astype(np.int64),
        np.concatenate([count[small], np.ones(len(each), np.int64)]),
    )


def tree_classes(symbols: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """The node of depth ``length`` that each window's suffix passes."""

    def numbered(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.unique((a.astype(np.uint64) << np.uint64(32)) | b.astype(np.uint64), return_inverse=True)[1]

    node, depth = np.unique(symbols, return_inverse=True)[1], 1
    while depth * 2 <= length:
        node = numbered(node[:-depth], node[depth:])
        depth *= 2
    return numbered(node[starts], node[starts + length - depth])


def removed_runs(rows: DataFrame, groups: int, length: int) -> DataFrame:
    """Blocks of the windows that go: document group, key, print, start, count."""
    # prefixes that occur in several documents, and whether they are large
    again = stored(
        repeated_anchors(rows, groups, word_sequence, length, GRAM, True, LARGE), "repeated-prefixes"
    )

    def stretches(left: pa.Table, right: pa.Table) -> pa.Table:
        known, large_ = by_document(right, "place", "large"), {}
        for k, (places, large) in known.items():
            known[k], large_[k] = places, places[large > 0]
        left = left.combine_chunks()
        ids, prints = left.column("_id").to_numpy(), left.column("_print").to_numpy()
        _, one = np.unique(prints ^ (ids * 31), return_index=True)  # equal rows are one document
        left = left.take(pa.array(np.sort(one))).combine_chunks()
        ids, prints = left.column("_id").to_numpy(), left.column("_print").to_numpy()
        parts: list[tuple] = []
        texts: list[bytes] = []
        for column, base in column_parts(left, "_text"):
            for first, last, raw, offsets in chunks(column):
                seq = word_sequence(raw, offsets)
                a = anchors_of(seq, length, GRAM)
                own, printed = ids[base + first : base + last], prints[base + first : base + last]
                hit = marked(a, seq, known, own, printed)
                if not hit.any():
                    continue
                large = marked(a, seq, large_, own, printed)[hit]
                source, window, count = _grown(a.hash[hit], a.window[hit], a.count[hit], large)
                owner, span = a.owner[hit][source], count + length - 1
                content = ranges_hash(seq.symbols, window, span)
                to = np.where(large[source], content, a.hash[hit][source])
                parts.append((content, to, own[owner], printed[owner], window - seq.first[owner], count))
                data = raw.tobytes()
                texts += [
                    data[x:y] for x, y in zip(seq.begin[window].tolist(), seq.end[window + span - 1].tolist(), strict=True)
                ]
        if not parts:
            return _nothing()
        content, to, id_, print_, window, count = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.lexsort((window, print_, id_, content))
        new = np.concatenate([[True], content[order][1:] != content[order][:-1]])
        number = np.cumsum(new) - 1
        lead = order[new]
        smallest = id_[lead][number]
        gone = id_[order] > smallest  # another document of this group has it
        kept = order[~gone]
        text_of = number[~gone]
        out = [_done(id_[order[gone]], print_[order[gone]], window[order[gone]], count[order[gone]], groups)]
        to_group = ((to[lead] >> np.uint64(33)).astype(np.int64)) % groups
        place = np.empty(len(lead), np.int64)  # of each text in its block
        by_group = np.argsort(to_group, kind="stable")
        sizes = np.unique(to_group, return_counts=True)[1]
        place[by_group] = np.arange(len(lead)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        one_text = blocks(
            to_group, groups,
            {
                "text": pa.array([texts[i] for i in lead], pa.binary()), "first": id_[lead],
                "windows": count[lead].astype(np.int32),
            },
        )
        owners = blocks(
            to_group[text_of], groups,
            {
                "of_text": place[text_of].astype(np.int32), "of_print": print_[kept],
                "at": window[kept].astype(np.int32),
            },
        )
        out.append(_both(one_text, owners))
        return pa.concat_tables(out, promote_options="default").select(_SCHEMA)

    def subtrees(table: pa.Table) -> pa.Table:
        passed = joined_runs(*(flat(table, c) for c in ("id", "print", "start", "count")))
        found = [passed]
        text = pa.concat_arrays([c.flatten() for c in table.column("text").chunks]) if len(table) else None
        if text is not None and len(text):
            first, windows = flat(table, "first"), flat(table, "windows").astype(np.int64)
            seq = word_sequence(*whole(text))
            starts = ranges(seq.first, windows)
            owner = np.repeat(np.arange(len(windows)), windows)
            classes = tree_classes(seq.symbols, starts, length)
            order = np.argsort(classes, kind="stable")
            borders = np.flatnonzero(np.concatenate([[True], classes[order][1:] != classes[order][:-1]]))
            least = np.minimum.reduceat(first[owner[order]], borders)
            goes = np.zeros(len(starts), bool)
            goes[order] = first[owner[order]] > np.repeat(least, np.diff(np.append(borders, len(order))))
            # runs inside each stretch, then for each document that holds it
            begins = np.cumsum(windows) - windows
            gap = np.zeros(len(starts) + len(windows), bool)
            gap[np.arange(len(starts)) + owner] = goes
            run, size = runs(gap)
            run_text = np.searchsorted(begins + np.arange(len(windows)), run, "right") - 1
            inside = run - begins[run_text] - run_text
            lists = table.column("text").combine_chunks()
            counts = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            owners = table.column("of_text").combine_chunks().value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            of_text = flat(table, "of_text") + np.repeat(np.cumsum(counts) - counts, owners)
            low = np.searchsorted(run_text, of_text)
            high = np.searchsorted(run_text, of_text, "right")
            which = ranges(low, high - low)
            holder = np.repeat(np.arange(len(of_text)), high - low)
            found.append(
                joined_runs(
                    first[of_text][holder], flat(table, "of_print")[holder],
                    flat(table, "at")[holder] + inside[which], size[which],
                )
            )
        joined = joined_runs(*(np.concatenate([f[c] for f in found]) for c in ("id", "print", "start", "count")))
        to = hash_group(joined["id"], joined["print"], groups)
        return pa.Table.from_batches([blocks(to, groups, joined)])

    documents = in_groups(rows, groups, "_id", "_print", "_text").groupBy("_to")
    schema = f"_to long, {_STRETCHES}, {RUNS}"
    found = documents.cogroup(again.groupBy("_to")).applyInArrow(stretches, schema)
    gone = stored(found.groupBy("_to").applyInArrow(subtrees, f"_to long, {RUNS}"), "removed-windows")
    dropped(again)
    return gone


_SCHEMA = ["_to", "text", "first", "windows", "of_text", "of_print", "at", "id", "print", "start", "count"]
_TYPES = dict(
    _to=pa.int64(), text=pa.list_(pa.binary()), first=pa.list_(pa.int64()), windows=pa.list_(pa.int32()),
    of_text=pa.list_(pa.int32()), of_print=pa.list_(pa.int64()), at=pa.list_(pa.int32()), id=pa.list_(pa.int64()),
    print=pa.list_(pa.int64()), start=pa.list_(pa.int32()), count=pa.list_(pa.int32()),
)


def _nothing() -> pa.Table:
    return pa.schema(list(_TYPES.items())).empty_table()


def _filled(batch: pa.RecordBatch) -> pa.Table:
    """All columns of ``_SCHEMA``; those that are missing hold empty lists."""
    table = pa.Table.from_batches([batch])
    for name, kind in _TYPES.items():
        if name not in table.column_names:
            table = table.append_column(name, pa.array([[]] * len(table), kind))
    return table.select(_SCHEMA).cast(pa.schema(list(_TYPES.items())))


def _done(id_, print_, start, count, groups: int) -> pa.Table:
    joined = joined_runs(id_, print_, start, count)
    return _filled(blocks(hash_group(joined["id"], joined["print"], groups), groups, joined))


def _both(texts: pa.RecordBatch, owners: pa.RecordBatch) -> pa.Table:
    """Texts and their holders go to the same groups, in the same order."""
    batch = texts
    for name in owners.schema.names[1:]:
        batch = batch.append_column(name, owners.column(name))
    return _filled(batch)


def text_left(content: str, gone: np.ndarray) -> str:
    """``content`` without its words marked in ``gone``; all other bytes stay.

    Of the white space on the two sides of removed words one goes: that after them, or
    that before them if it has fewer line breaks or no word follows.  Without a word
    left the text is empty.
    """
    if not gone.any():
        return content
    if gone.all():
        return ""
    raw = content.encode()
    seq = word_sequence(np.frombuffer(raw, np.uint8), np.array([0, len(raw)], np.int64))
    first, size = runs(gone)
    parts, at = [], 0
    for a, b in zip(first.tolist(), (first + size).tolist(), strict=True):
        start, end = int(seq.begin[a]), int(seq.end[b - 1])
        before = int(seq.end[a - 1]) if a else 0
        after = int(seq.begin[b]) if b < len(gone) else len(raw)
        drop_before = b == len(gone) or (a and raw.count(b"\n", before, start) < raw.count(b"\n", end, after))
        parts.append(raw[at : before if drop_before else start])
        at = end if drop_before else after
    return b"".join([*parts, raw[at:]]).decode()


def without_repeats(
    docs: DataFrame, length: int = 13, key: str = "doc_id", text: str = "text", spaces: bool = False
) -> DataFrame:
    """All columns of ``docs`` but the text, and n_words, n_removed, kept (the text left).

    Columns of these names are replaced.  With ``spaces`` the text left keeps its white
    space (``text_left``), and a text that loses nothing, null too, is unchanged.
    """
    left = _rows_left(docs, length, key, text, spaces)
    names = [c for c in docs.columns if c not in (text, "n_words", "n_removed", "kept")]
    return left.select(*[F.col("_row")[c].alias(c) for c in names], "n_words", "n_removed", "kept")


def with_texts_left(
    docs: DataFrame, length: int, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``docs`` with the texts left, white space too, in the place of the texts, and without
    the documents of which nothing is left; no other column changes, whatever its name."""
    left = _rows_left(docs, length, key, text, spaces=True)
    left = left.where((F.col("n_removed") == 0) | (F.col("kept") != ""))
    return left.select(*[(F.col("kept") if c == text else F.col("_row")[c]).alias(c) for c in docs.columns])


def _rows_left(docs: DataFrame, length: int, key: str, text: str, spaces: bool) -> DataFrame:
    """``_row`` (see ``keyed``), n_words, n_removed and kept."""
    rows = keyed(docs, key, text)
    groups = group_count(rows, "_text")
    gone = removed_runs(rows, groups, length)
    released(docs.sparkSession)

    def cut(content: str, runs_: list | None) -> tuple:
        words = content.encode().split()
        if runs_ is None:
            return len(words), 0, content if spaces else b" ".join(words).decode()
        flags = covered(len(words), *runs_, length)
        kept = [w for w, f in zip(words, flags.tolist(), strict=True) if not f]
        left = text_left(content, flags) if spaces else b" ".join(kept).decode()
        return len(words), len(words) - len(kept), left

    left = without_runs(rows, gone, groups, cut, "n_words long, n_removed long, kept string")
    if spaces:
        left = left.withColumn("kept", F.when(~F.col("_no_text"), F.col("kept")))
    return left
