"""Operator 10: language-model scores by context-tree weighting over bytes.

A text is its UTF-8 bytes in lower case (A-Z only), framed by the byte 255, which no
text holds, as its end and as the context before its start.  A byte is eight binary
decisions; the decision at a node of the byte's binary tree is predicted in the
contexts of the last 0, 1, ... ``DEPTH`` bytes.  In each context a node has a
Krichevsky-Trofimov estimate from its counts of zeros and ones, and the weighted
probability of context s is

    Pw(s) = KT(s) / 2 + (product of Pw over the contexts one byte longer) / 2

(KT alone for the longest), from which the share of each depth in a prediction follows.

Counts come from all training documents, and every context that occurs in them is in the
model: tasks count the strings of ``DEPTH + 1`` bytes, Spark adds them up, and shorter
contexts are their sums.  The tree is never in one place.  It is cut at contexts of
``TOP`` bytes: the strings whose contexts end alike lie in one of many buckets, which mix
their subtrees from the bottom up and hand the sums on; above are only contexts of fewer
than ``TOP`` bytes, 65,793 at most.  With these the buckets mix their subtrees again from
the top down and give the code length of every string that is asked for, whether or not
it was seen in training: a decision without counts in a context falls back on the longest
context that has some, and on one half where there is none.

The texts are read once more.  The most frequent strings, ``HEAD`` at most, are looked up
where the text is; the others go to their bucket, once for each batch and string, with the
rows that hold them as a list.  The cut at ``TOP``, ``HEAD`` and the number of buckets
change how the work is dealt out but no score.

The base score is that of single words with additive smoothing, from exact counts of
all words of the training documents (``sftprep.llm.terms``).

Defined results: a null or empty text has the end alone; a null key is hashed as the
empty text; rows of one key each get their row; without training documents the model
is uniform over bits and ``train_tokens`` is 0.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sftprep.llm.common import stored, text_of
from sftprep.llm.terms import frequent, head_of, row_parts, summed_parts, term_counts

#: Bytes of the longest contexts (6 at most), and of those by which subtrees are dealt out.
DEPTH, TOP = 5, 3
END = 255
#: Bytes of text that a task holds as numbers at a time.
CHUNK = 1_000_000
#: Strings whose code lengths all tasks get, and strings of a bucket, about.
HEAD, BUCKET = 1_000_000, 300_000
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def words(text: str) -> list[bytes]:
    """Lower-case words; bytes know no other white space than the six characters."""
    return text.encode().lower().split()


def framed(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Strings of ``DEPTH + 1`` bytes as numbers, one for each byte and end of some texts
    at a time, and the first of each text.  The column has no nulls."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + CHUNK, "right")) - 1
        last = min(max(last, first + 1), len(column))
        starts = offsets[first : last + 1].astype(np.int64)
        lengths = np.diff(starts)
        # DEPTH end bytes, the text, one end byte
        at = starts[:-1] - starts[0] + np.arange(last - first) * (DEPTH + 1) + DEPTH
        line = np.full(starts[-1] - starts[0] + (last - first) * (DEPTH + 1), END, np.uint8)
        shift = np.repeat(at - starts[:-1], lengths)
        line[np.arange(starts[0], starts[-1]) + shift] = _LOWER[raw[starts[0] : starts[-1]]]
        target = np.ones(len(line), bool)
        for i in range(1, DEPTH + 1):
            target[at - i] = False
        strings = np.zeros(len(line), np.int64)
        for i in range(DEPTH + 1):
            strings[DEPTH:] |= line[DEPTH - i : len(line) - i].astype(np.int64) << (8 * i)
        begins = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
        yield strings[target], begins
        first = last


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series, with x moved up by 8 (x > 0)."""
    y = x + 8
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    up = (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + series
    for i in range(8):
        up = up - np.log(x + i)
    return up


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Logarithm of the Krichevsky-Trofimov probability of so many zeros and ones."""
    return _log_gamma(zeros + 0.5) + _log_gamma(ones + 0.5) - _log_gamma(zeros + ones + 1.0) - math.log(math.pi)


def nodes_of(strings: np.ndarray, depth: int) -> np.ndarray:
    """Numbers of a context of ``depth`` bytes and each of the eight nodes: 8 x strings."""
    context = (strings >> 8) & ((1 << (8 * depth)) - 1)
    byte = strings & 255
    return np.stack([(context << 8) | (1 << b) | (byte >> (8 - b)) for b in range(8)])


def parents_of(nodes: np.ndarray, depth: int) -> np.ndarray:
    """The nodes of contexts of ``depth`` bytes one byte shorter."""
    return (((nodes >> 8) & ((1 << (8 * (depth - 1))) - 1)) << 8) | (nodes & 255)


class Levels:
    """Nodes of contexts of some depths, from the counts of the deepest."""

    def __init__(self, low: int, high: int, nodes: np.ndarray, zeros: np.ndarray, ones: np.ndarray, split: np.ndarray | None):
        """``split`` sums up the weights of what is below the deepest level, if there is any."""
        self.low, self.high = low, high
        self.nodes, self.zeros, self.ones, self.weight = {high: nodes}, {high: zeros}, {high: ones}, {}
        self.share = {}
        for d in range(high, low - 1, -1):
            kt = log_kt(self.zeros[d], self.ones[d])
            if split is None:
                self.weight[d], self.share[d] = kt, np.ones(len(kt))
            else:
                self.weight[d] = np.logaddexp(kt, split) - math.log(2)
                self.share[d] = np.exp(kt - math.log(2) - self.weight[d])
            if d > low:
                above, place = np.unique(parents_of(self.nodes[d], d), return_inverse=True)
                self.nodes[d - 1] = above
                self.zeros[d - 1], self.ones[d - 1], split = (
                    np.bincount(place, x[d], len(above)) for x in (self.zeros, self.ones, self.weight)
                )

    def mixed(self, above: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]) -> None:
        """Add to ``above`` each depth's nodes with the chance of a one: at + of * (what the
        longer contexts say).  It has the depths before."""
        for d in range(self.low, self.high + 1):
            at, of = np.zeros(len(self.nodes[d])), np.ones(len(self.nodes[d]))
            if d:
                nodes, at_, of_ = above[d - 1]
                place = np.searchsorted(nodes, parents_of(self.nodes[d], d))
                at, of = at_[place], of_[place]
            own = (self.ones[d] + 0.5) / (self.zeros[d] + self.ones[d] + 1)
            above[d] = (self.nodes[d], at + of * self.share[d] * own, of * (1 - self.share[d]))


def subtrees(strings: np.ndarray, counts: np.ndarray) -> Levels:
    """The levels from ``TOP`` on of a bucket's strings."""
    byte = strings & 255
    ones = np.stack([np.where((byte >> (7 - b)) & 1, counts, 0) for b in range(8)])
    nodes, place = np.unique(nodes_of(strings, DEPTH), return_inverse=True)
    place = place.ravel()
    every = np.bincount(place, np.tile(counts, 8), len(nodes))
    one = np.bincount(place, ones.ravel(), len(nodes))
    return Levels(TOP, DEPTH, nodes, every - one, one, None)


def code_lengths(strings: np.ndarray, mixed: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]) -> np.ndarray:
    """log10 of the chance of each string's last byte after the others."""
    total = np.zeros(len(strings))
    chance = np.full((8, len(strings)), 0.5)
    for d in range(DEPTH + 1):
        nodes, at, of = mixed.get(d, (np.zeros(0, np.int64),) * 3)
        if not len(nodes):
            break
        asked = nodes_of(strings, d)
        place = np.searchsorted(nodes, asked)
        place[place == len(nodes)] = 0
        # longer contexts of a node without counts say one half
        chance = np.where(nodes[place] == asked, at[place] + of[place] / 2, chance)
    byte = strings & 255
    for b in range(8):
        total += np.log10(np.where((byte >> (7 - b)) & 1, chance[b], 1 - chance[b]))
    return total


def counted_strings(docs: DataFrame, text: str) -> DataFrame:
    """string, n over all texts, as a written table."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(parts: list) -> tuple[np.ndarray, np.ndarray]:
            strings, place = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            return strings, np.bincount(place, np.concatenate([p[1] for p in parts]), len(strings)).astype(np.int64)

        parts: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            for strings, _ in framed(batch.column(0)):
                parts.append(np.unique(strings, return_counts=True))
                if len(parts) == 8:
                    parts = [out(parts)]
                    if len(parts[0][0]) > 2_000_000:
                        yield pa.record_batch([pa.array(x) for x in parts[0]], ["string", "n"])
                        parts = []
        if parts:
            yield pa.record_batch([pa.array(x) for x in out(parts)], ["string", "n"])

    counted = docs.select(text).mapInArrow(count, "string long, n long")
    return stored(counted.groupBy("string").agg(F.sum("n").alias("n")), "byte-strings")


def _dealt(rows: DataFrame, buckets: int) -> DataFrame:
    """Rows by the bucket of their string's context of ``TOP`` bytes."""
    context = F.shiftright("string", 8).bitwiseAND((1 << (8 * TOP)) - 1)
    return rows.withColumn("to", F.pmod(F.xxhash64(context), F.lit(buckets)).cast("int"))


Mixed = dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]


def top_levels(table: DataFrame, buckets: int) -> Mixed:
    """The mixtures of the contexts of fewer than ``TOP`` bytes."""

    def sums(group: pa.Table) -> pa.Table:
        tree = subtrees(*(group.column(c).to_numpy() for c in ("string", "n")))
        nodes, place = np.unique(parents_of(tree.nodes[TOP], TOP), return_inverse=True)
        parts = [np.bincount(place, x[TOP], len(nodes)) for x in (tree.zeros, tree.ones, tree.weight)]
        return pa.table([pa.array(nodes), *map(pa.array, parts)], ["node", "zeros", "ones", "split"])

    found = _dealt(table, buckets).groupBy("to").applyInArrow(sums, "node long, zeros double, ones double, split double")
    # at most 65,536 contexts with some of 255 nodes each
    rows = found.groupBy("node").agg(*[F.sum(c).alias(c) for c in ("zeros", "ones", "split")]).toArrow().sort_by("node")
    mixed: Mixed = {}
    Levels(0, TOP - 1, *(rows.column(c).to_numpy() for c in ("node", "zeros", "ones", "split"))).mixed(mixed)
    return mixed


def _bucket_lengths(group: pa.Table, top: Mixed, strings: np.ndarray) -> np.ndarray:
    """Code lengths of strings that belong to the bucket of ``group``."""
    mixed = dict(top)
    if group.num_rows:
        subtrees(*(group.column(c).to_numpy() for c in ("string", "n"))).mixed(mixed)
    return code_lengths(strings, mixed)


class Scorer:
    """Scores of texts in one task: code lengths of the frequent strings by hashing."""

    def __init__(self, strings: np.ndarray, lengths: np.ndarray):
        # strings that share a slot of one table with others go to the next
        self.tables: list[tuple[int, np.ndarray, np.ndarray]] = []
        while len(strings):
            shift = 64 - max(4, 2 * len(strings)).bit_length()
            names, values = np.full(1 << (64 - shift), -1, np.int64), np.zeros(1 << (64 - shift))
            slot = self._slots(strings, shift, len(self.tables))
            names[slot], values[slot] = strings, lengths
            self.tables.append((shift, names, values))
            left = names[slot] != strings
            strings, lengths = strings[left], lengths[left]

    def _slots(self, strings: np.ndarray, shift: int, table: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            spread = strings.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15 + 2 * table)
        return (spread >> np.uint64(shift)).astype(np.int64)

    def lengths(self, strings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The code lengths of known strings (0 for others), and the places of the others."""
        found, left = np.zeros(len(strings)), np.arange(len(strings))
        for table, (shift, names, values) in enumerate(self.tables):
            slot = self._slots(strings, shift, table)
            hit = names[slot] == strings
            found[left[hit]] = values[slot[hit]]
            left, strings = left[~hit], strings[~hit]
        return found, left

    def scores(self, column: pa.Array) -> tuple[list[float], tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """The sum of each text's frequent strings; of the rare: string, text, times."""
        sums, rare, first = [], [], 0
        for strings, begins in framed(column):
            lengths, odd = self.lengths(strings)
            sums.append(np.add.reduceat(lengths, begins))
            owner = np.searchsorted(begins, odd, "right") - 1
            rare.append(np.stack([strings[odd], owner + first]))
            first += len(begins)
        if not sums:
            return [], (np.zeros(0, np.int64),) * 3
        pairs = np.concatenate(rare, 1)
        order = np.lexsort(pairs[::-1])
        pairs = pairs[:, order]
        new = np.flatnonzero(np.concatenate([[True], (pairs[:, 1:] != pairs[:, :-1]).any(0)])) if pairs.size else order
        times = np.diff(np.append(new, pairs.shape[1]))
        return np.concatenate(sums).tolist(), (pairs[0, new], pairs[1, new], times)


def scored(
    docs: DataFrame, key: str = "doc_id", text: str = "text", folds: int = 5, held_out: int = 1
) -> DataFrame:
    """Per row: key, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    fold = F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % folds
    rows = docs.select(
        F.col(key).alias("_key"), text_of(text).alias("_text"), (fold == held_out).alias("_held")
    )
    training = rows.where(~F.col("_held"))
    table = stored(term_counts(training, "_text", words, "binary"), "words")
    ends = training.count()
    sums = table.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    n, v = sums[0] + ends, sums[1] + (ends > 0)
    scale = n + 0.5 * (v + 1)
    valued = table.withColumn("value", F.log10((F.col("n") + 0.5) / scale))
    head = head_of(valued, "value")

    strings = counted_strings(training, "_text")
    buckets = max(3 * int(spark.conf.get("spark.sql.shuffle.partitions")), strings.count() // BUCKET)
    top = spark.sparkContext.broadcast(top_levels(strings, buckets))
    model = _dealt(strings, buckets).groupBy("to")

    def value(group: pa.Table, asked: pa.Table) -> pa.Table:
        asked_strings = asked.column("string").to_numpy()
        return pa.table(
            [pa.array(asked_strings), pa.array(_bucket_lengths(group, top.value, asked_strings))], ["string", "length"]
        )

    often = frequent(strings, HEAD).select(F.col("string").alias("string"))
    found = model.cogroup(_dealt(often, buckets).groupBy("to")).applyInArrow(value, "string long, length double")
    head_rows = found.toArrow()
    known = spark.sparkContext.broadcast([head_rows.column(c).to_numpy() for c in ("string", "length")])
    made: list[Scorer] = []

    def score(texts: pa.Array) -> tuple[list[float], tuple[np.ndarray, np.ndarray, np.ndarray]]:
        if not made:
            made.append(Scorer(*known.value))
        return made[0].scores(texts)

    parts = stored(row_parts(rows, "_text", ["_key", "_held"], words, head, "binary", score), "row-parts")

    def rest(group: pa.Table, asked: pa.Table) -> pa.Table:
        """What a bucket's rare strings add to the rows."""
        if not asked.num_rows:
            return pa.table([pa.array([], pa.int64()), pa.array([], pa.float64())], ["_row", "measured"])
        distinct, place = np.unique(asked.column("string").to_numpy(), return_inverse=True)
        lengths = _bucket_lengths(group, top.value, distinct)[place]
        lists = asked.column("_rows").combine_chunks()
        own = np.repeat(lengths, lists.value_lengths().to_numpy()) * _flat(asked, "_times")
        numbers, place = np.unique(_flat(asked, "_rows"), return_inverse=True)
        return pa.table([pa.array(numbers), pa.array(np.bincount(place, own, len(numbers)))], ["_row", "measured"])

    rare = _dealt(parts.where("string is not null").select("string", "_rows", "_times"), buckets).groupBy("to")
    added = model.cogroup(rare).applyInArrow(rest, "_row long, measured double")
    found = summed_parts(parts.where("string is null").drop("string"), ["_key", "_held"], valued, added)
    end = math.log10((ends + 0.5) / scale)
    unknown = math.log10(0.5 / scale)
    return found.select(
        F.col("_key").alias(key),
        F.col("_held").alias("held_out"),
        (F.col("n_terms") + 1).alias("n_tokens"),
        (F.col("n_found") + int(ends > 0)).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("total") + (F.col("n_terms") - F.col("n_found")) * unknown + end).alias("base_score"),
        F.col("measured").alias("score"),
    )


def _flat(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).combine_chunks().flatten().to_numpy(zero_copy_only=False)
