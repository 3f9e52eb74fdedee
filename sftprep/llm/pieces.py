"""Operator 8: sampled SentencePiece segmentations, and decoding.

The pieces of a text form a lattice.  Forward filtering sums the weights of all ways
to reach each place; backward sampling then walks from the end and draws each piece
with the probability that the sums give it, so whole segmentations are drawn with their
exact probability.  A piece weighs ``rank ** -power`` by its place in the model's file,
which lists frequent pieces first (Zipf's law); characters that are no piece become
byte pieces.

No piece holds a space after another character, so the lattice of a text falls apart
into units, some spaces and the word behind them.  Each distinct unit is filtered once
by a worker; then all its occurrences in a batch are sampled at once, a piece of every
unit at a time.  The random numbers are hashes of seed, row key, number of the unit in its
text and number of the draw, and probabilities are 32-bit integers, so a row is cut
in the same way whatever the partitions, the batch or the machine.

Decoding is lossless for every text: the space that encoding puts before a text is
removed, and a text's own U+2581, which SentencePiece takes for a space, goes through
byte pieces.

Defined results: null stays null in decoding and encodes as the empty text, which has
no pieces; rows of equal keys and texts have equal pieces.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import count, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sftprep.llm.common import text_of
from sftprep.llm.windows import mixed, ranges, rolled

_UNIT = re.compile(" +[^ ]*")
#: Characters of text whose lattices a task holds at a time.
CHUNK = 1_500_000
#: Longer units are filtered one by one.
SHORT = 64
#: Characters of units that a worker keeps: some 50 bytes each.
KEPT = 2_500_000
FULL = (1 << 32) - 1


class Pieces:
    """A model's pieces with spaces as spaces, and their weights."""

    def __init__(self, path: str, power: float):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.ids: dict[str, tuple[int, float]] = {}
        self.bytes_ = [0] * 256
        self.content: list[bytes] = []
        for i in range(model.get_piece_size()):
            name = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes_[int(name[3:5], 16)] = i
                self.content.append(bytes([int(name[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.content.append(b"")
            else:
                piece = name.replace("▁", " ")
                if " " in piece.lstrip(" "):
                    raise ValueError("a piece crosses a word border")
                self.ids[piece] = (i, float(i + 1) ** -power)
                self.content.append(piece.encode())
        self.longest = max(map(len, self.ids))
        self.lattices: Lattices | None = None
        # of each length: hashes of the pieces, in order, their ids, and the beginnings of the hashes
        nothing = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(1 << 16, bool)
        self.hashes: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = [nothing]
        weight = np.zeros(len(self.content))
        for length in range(1, self.longest + 1):
            names = [n for n in self.ids if len(n) == length]
            codes = np.frombuffer("".join(names).encode("utf-32-le"), np.uint32)
            hashes = rolled(mixed(codes.astype(np.uint64)), length)[::length] if names else np.zeros(0, np.uint64)
            order = np.argsort(hashes)
            begins = np.zeros(1 << 16, bool)
            begins[hashes >> np.uint64(48)] = True
            self.hashes.append((hashes[order], np.array([self.ids[n][0] for n in names], np.int64)[order], begins))
        for i, w in self.ids.values():
            weight[i] = w
        self.weight = weight
        self.byte_weight = float(len(self.content)) ** -power

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.content.__getitem__, ids)).decode()[1:]


@lru_cache(maxsize=2)
def pieces_of(path: str, power: float) -> Pieces:
    """One for each Python worker."""
    return Pieces(path, power)


class Lattices:
    """Forward sums of distinct units as arrays: edges by the node where they end.

    A worker filters a unit once and keeps it for all texts to come, until ``KEPT``
    characters of units are there; then it begins anew.
    """

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.numbers: dict[str, int] = defaultdict(count().__next__)  # a new unit gets the next
        self.nodes = self.edges = self.units = self.characters = 0
        self.first, self.last = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        # node where the edge ends and the upper end of its share in 2 ** 32; length; piece
        self.keys, self.size, self.piece = np.zeros(1 << 20, np.uint64), np.zeros(1 << 20, np.uint8), np.zeros(1 << 20, np.int32)

    def add(self, units: list[str]) -> None:
        """Filter new units, numbered after those that are there."""
        if not units:
            return
        lengths = np.array([len(u) for u in units], np.int64)
        first = self.nodes + np.cumsum(lengths + 1) - lengths - 1  # a node before each character
        short = np.flatnonzero(lengths <= SHORT)
        parts = [self._short([units[i] for i in short], first[short], lengths[short])]
        parts += [self._long(units[i], int(first[i])) for i in np.flatnonzero(lengths > SHORT)]
        node, bound, source, piece = (np.concatenate(x) for x in zip(*parts, strict=True))
        keys = (node.astype(np.uint64) << np.uint64(32)) | bound
        size = node - source
        if len(parts) > 1:
            order = np.argsort(keys, kind="stable")
            keys, size, piece = keys[order], size[order], piece[order]
        for name, values, at in (
            ("first", first, self.units), ("last", first + lengths, self.units),
            ("keys", keys, self.edges), ("size", size, self.edges), ("piece", piece, self.edges),
        ):
            held = getattr(self, name)
            if at + len(values) > len(held):
                held = np.concatenate([held[:at], np.zeros(max(at // 2, 2 * len(values)), held.dtype)])
                setattr(self, name, held)
            held[at : at + len(values)] = values
        self.units, self.edges = self.units + len(units), self.edges + len(keys)
        self.nodes += int((lengths + 1).sum())
        self.characters += int(lengths.sum())

    def _short(self, units: list[str], first: np.ndarray, lengths: np.ndarray) -> tuple:
        """All units at once, place by place; a piece is found by the hash of its characters."""
        pieces, most = self.pieces, self.pieces.longest
        codes = np.frombuffer("".join(units).encode("utf-32-le"), np.uint32)
        n = len(codes)
        begin = np.cumsum(lengths) - lengths
        unit = np.repeat(np.arange(len(units)), lengths)
        left = np.repeat(begin + lengths, lengths) - np.arange(n)
        node = np.arange(n) + unit  # local nodes: one more for each unit
        ends, sizes, ids_, weights = [], [], [], []
        letters, hashes = mixed(codes.astype(np.uint64)), np.zeros(n, np.uint64)
        base = np.uint64(0x9E3779B97F4A7C15)
        with np.errstate(over="ignore"):
            for size in range(1, most + 1):
                at = np.flatnonzero(left >= size) if size == 1 else at[left[at] >= size]
                own = hashes[at] * base + letters[at + size - 1]
                hashes[at] = own
                known, ids, begins = pieces.hashes[size]
                if not len(known) or not len(at):
                    continue
                # most strings are no piece, which the beginning of the hash shows
                hit = begins[own >> np.uint64(48)]
                place = np.searchsorted(known, own[hit])
                place[place == len(known)] = 0
                same = known[place] == own[hit]
                hit[hit] = same
                found = ids[place[same]]
                ends.append(node[at[hit]] + size)
                ids_.append(found)
                weights.append(pieces.weight[found])
                sizes.append(np.full(len(found), size))
                if size == 1:  # a character that is no piece has to be spelled in bytes
                    odd = at[~hit]
                    ends.append(node[odd] + 1)
                    ids_.append(-1 - codes[odd].astype(np.int64))
                    weights.append(np.full(len(odd), pieces.byte_weight))
                    sizes.append(np.ones(len(odd), np.int64))
        if not n:
            return (np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))
        end = np.concatenate(ends)
        order = np.argsort(end, kind="stable")  # by end and length, as lengths come in order
        end, size, piece, weight = (np.concatenate(x)[order] if x is not ends else end[order] for x in (ends, sizes, ids_, weights))
        opens = np.flatnonzero(np.concatenate([[True], end[1:] != end[:-1]]))
        rank = np.arange(len(end)) - np.repeat(opens, np.diff(np.append(opens, len(end))))
        starts = begin + np.arange(len(units))
        of_unit = np.repeat(np.arange(len(units)), lengths + 1)[end]
        # the edges of a place of all units and of one rank are summed up at once
        step = (end - starts[of_unit]) * most + rank
        step = step.astype(np.min_scalar_type(step.max()))  # short numbers are sorted by digits
        by_step = np.argsort(step, kind="stable")
        turns = np.append(np.flatnonzero(np.concatenate([[True], np.diff(step[by_step]) > 0])), len(step))
        reach = np.zeros(n + len(units))
        reach[starts] = 1.0
        upto = np.zeros(len(end))
        source = end - size
        for low, high in zip(turns[:-1].tolist(), turns[1:].tolist(), strict=True):
            edge = by_step[low:high]
            sums = reach[end[edge]] + weight[edge] * reach[source[edge]]
            reach[end[edge]] = sums
            upto[edge] = sums
        bound = (upto / reach[end] * FULL).astype(np.uint64)
        bound = np.minimum(bound, np.uint64(FULL))
        bound[np.append(opens[1:], len(end)) - 1] = FULL
        shift = (first - starts)[of_unit]
        return end + shift, bound, source + shift, piece

    def _long(self, unit: str, base: int) -> tuple:
        get, longest = self.pieces.ids.get, self.pieces.longest
        node, bound, source, ids = array("q"), array("Q"), array("q"), array("q")
        reach = [1.0]
        for j in range(1, len(unit) + 1):
            total, found = 0.0, []
            for i in range(j - 1, max(0, j - longest) - 1, -1):
                piece = get(unit[i:j])
                if piece is not None:
                    total += reach[i] * piece[1]
                    found.append((total, i, piece[0]))
                elif i == j - 1:
                    total += reach[i] * self.pieces.byte_weight
                    found.append((total, i, -1 - ord(unit[i])))
            for k, i, p in found:
                bound.append(int(k / total * FULL))
                source.append(base + i)
                ids.append(p)
                node.append(base + j)
            bound[-1] = FULL
            reach.append(total)
            if total < 1e-200:  # only ratios of the last sums matter
                for i in range(max(0, j + 1 - longest), j + 1):
                    reach[i] *= 1e200
        return tuple(np.frombuffer(x, t) for x, t in ((node, np.int64), (bound, np.uint64), (source, np.int64), (ids, np.int64)))

    def sample(self, unit: np.ndarray, random: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of all occurrences in order, and how many each has."""
        keys, size, piece = self.keys[: self.edges], self.size, self.piece
        first = self.first[unit]
        # unit by unit, so that neighbours in the search look at the same edges
        at, going = self.last[unit], np.argsort(unit, kind="stable")
        drawn, counts = [], np.zeros(len(unit), np.int64)
        step = 0
        while len(going):
            with np.errstate(over="ignore"):
                chance = mixed(random[going] + np.uint64((step * 0x9E3779B97F4A7C15) % (1 << 64))) >> np.uint64(32)
            chance = np.minimum(chance, np.uint64(FULL - 1))
            edge = np.searchsorted(keys, (at[going].astype(np.uint64) << np.uint64(32)) | chance, "right")
            drawn.append((going, piece[edge]))
            counts[going] += 1
            at[going] -= size[edge]
            going = going[at[going] > first[going]]
            step += 1
        starts = np.cumsum(counts) - counts
        out = np.zeros(int(counts.sum()), np.int64)
        for i, (which, p) in enumerate(drawn):
            out[starts[which] + counts[which] - 1 - i] = p
        return out, counts


def _with_bytes(pieces: Pieces, found: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Characters that are no piece, as the pieces of their bytes."""
    odd = np.flatnonzero(found < 0)
    if not len(odd):
        return found, counts
    characters, which = np.unique(found[odd], return_inverse=True)
    spelled = [[pieces.bytes_[b] for b in chr(-1 - c).encode()] for c in characters.tolist()]
    size = np.ones(len(found), np.int64)
    size[odd] = np.array([len(s) for s in spelled])[which]
    place = np.cumsum(size) - size
    out = np.repeat(found, size)
    flat = np.array([b for s in spelled for b in s])
    begin = np.cumsum([0] + [len(s) for s in spelled])[:-1][which]
    out[ranges(place[odd], size[odd])] = flat[ranges(begin, size[odd])]
    owner = np.repeat(np.arange(len(counts)), counts)
    return out, np.bincount(owner, size, len(counts)).astype(np.int64)


def segmented(pieces: Pieces, texts: list[str], keys: np.ndarray) -> Iterator[list[np.ndarray]]:
    """The pieces of each text, some texts at a time; ``keys`` are 64-bit row keys."""
    first = 0
    while first < len(texts):
        size, last = 0, first
        while last < len(texts) and (last == first or size + len(texts[last]) <= CHUNK):
            size += len(texts[last])
            last += 1
        lattices = pieces.lattices
        if lattices is None or lattices.characters > KEPT:
            lattices = pieces.lattices = Lattices(pieces)
        numbers, known, lengths = lattices.numbers, len(lattices.numbers), []
        units = array("q")
        for text in texts[first:last]:
            found = _UNIT.findall(" " + text) if text else []
            units.extend(map(numbers.__getitem__, found))
            lengths.append(len(found))
        lattices.add(list(islice(numbers, known, None)))
        counts = np.array(lengths)
        if len(units):
            with np.errstate(over="ignore"):
                row = np.repeat(mixed(keys[first:last]), counts)
                nth = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
                random = mixed(row + nth.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
            ids, per_unit = _with_bytes(pieces, *lattices.sample(np.frombuffer(units, np.int64), random))
            owner = np.repeat(np.arange(last - first), counts)
            ends = np.cumsum(np.bincount(owner, per_unit, last - first).astype(np.int64))
            yield np.split(ids, ends[:-1])
        else:
            yield [np.zeros(0, np.int64)] * (last - first)
        first = last


def sampled(
    docs: DataFrame,
    model: str,
    seed: int,
    key: str = "doc_id",
    text: str = "text",
    power: float = 1.0,
    with_ids: bool = True,
) -> DataFrame:
    """Per row: key, n_pieces, ids_crc32, decoded_sha256 and, if wished, ``ids``.

    ``ids_crc32`` is that of the ids as little-endian unsigned 32-bit integers, and
    ``decoded_sha256`` that of the text which the ids decode to (UTF-8).
    """
    key_type = docs.select(key).schema[0].dataType.simpleString()
    schema = f"`{key}` {key_type}, n_pieces long, ids_crc32 long, decoded_sha256 string" + ", ids array<int>" * with_ids

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(model, power)
        for batch in batches:
            keys = batch.column(1).to_numpy().view(np.uint64)
            at = 0
            for rows in segmented(pieces, batch.column(2).to_pylist(), keys):
                data = [r.astype("<u4").tobytes() for r in rows]
                columns = [
                    batch.column(0).slice(at, len(rows)), pa.array([len(r) for r in rows], pa.int64()),
                    pa.array([zlib.crc32(d) for d in data], pa.int64()),
                    pa.array([hashlib.sha256(pieces.decode(r.tolist()).encode()).hexdigest() for r in rows], pa.string()),
                ]
                if with_ids:
                    columns.append(pa.array([r.astype(np.int32) for r in rows], pa.list_(pa.int32())))
                at += len(rows)
                yield pa.record_batch(
                    columns, [key, "n_pieces", "ids_crc32", "decoded_sha256", *["ids"] * with_ids]
                )

    row_key = F.xxhash64(F.lit(seed), F.col(key).cast("string")).alias("_seeded")
    return docs.select(key, row_key, text_of(text).alias("_text")).mapInArrow(encode, schema)


def decoded(rows: DataFrame, model: str, ids: str = "ids", into: str = "text") -> DataFrame:
    """``rows`` with the text of ``ids`` as the column ``into`` (replaced if there)."""
    kept = [c for c in rows.columns if c != into]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(kept).schema)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(model, 1.0)
        for batch in batches:
            texts = [None if x is None else pieces.decode(x) for x in batch.column(kept.index(ids)).to_pylist()]
            yield batch.append_column(into, pa.array(texts, pa.string()))

    return rows.select(kept).mapInArrow(decode, f"{fields}, `{into}` string")
