"""Operator 5: harmonic packing of documents into sequences of fixed length.

A document's ids (and one end id) are cut into whole sequences and a rest.  The rest
is cut into powers of two, largest first, down to ``smallest``, and a tail shorter
than that.  A piece of length ``l`` is of class ``capacity // l``, its reciprocal of
the capacity: a bin of class k takes exactly k pieces of that class, one after the
other.  Bins of the powers of two are full to the last id; bins of tails waste less
than one part in ``capacity / smallest + 1``.

Each task fills its own bins in the order of its rows, with nothing to agree on: the
only state is one open bin for each class.  At the end of a task the pieces of bins
that didn't get their k pieces are put in a row and cut at the capacity anew, and what
remains is cut into powers of two, which need no padding.

Sequence numbers hold the partition's number in the upper bits, so that a task that
runs again for a lost executor numbers its sequences as before.

Defined results: a null or empty text is the end id alone; repeated rows and null keys
are packed like any other row; an empty table has no sequences.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from sftprep.llm.bpe import encoder
from sftprep.llm.common import text_of

COLUMNS = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
WIDTH = 4  # bytes of an id


def powers_of_two(n: int, smallest: int) -> list[int]:
    """``n`` as a sum of powers of two, largest first, and one rest under ``smallest``."""
    parts = []
    while n >= smallest and n:
        parts.append(1 << (n.bit_length() - 1))
        n -= parts[-1]
    return parts + [n] * (n > 0)


class Bins:
    """The open bins of one task; rows come out when their place is final."""

    def __init__(self, first: int, capacity: int, smallest: int):
        self.next, self.capacity, self.smallest = first, capacity, smallest
        self.open: dict[int, list[tuple]] = defaultdict(list)
        self.rows: list[tuple] = []

    def _close(self, pieces: list[tuple]) -> None:
        offset = 0
        for document, start, ids, total in pieces:
            n = len(ids) // WIDTH
            self.rows.append((document, start, n, zlib.crc32(ids), total, self.next, offset, ids))
            offset += n
        self.next += 1

    def add(self, document, ids: bytes) -> None:
        total = len(ids) // WIDTH
        lengths = [self.capacity] * (total // self.capacity)
        lengths += powers_of_two(total % self.capacity, self.smallest)
        start = 0
        for n in lengths:
            size = self.capacity // n
            bin_ = self.open[size]
            bin_.append((document, start, ids[start * WIDTH : (start + n) * WIDTH], total))
            start += n
            if len(bin_) == size:
                self._close(self.open.pop(size))

    def finish(self) -> None:
        """Place the pieces of the bins that are still open."""
        left = [p for size in sorted(self.open) for p in self.open[size]]
        self.open.clear()
        rest = sum(len(p[2]) for p in left) // WIDTH
        room, bin_ = [], []
        room += [self.capacity] * (rest // self.capacity) + powers_of_two(rest % self.capacity, 1)
        for space in room:
            while space:
                document, start, ids, total = left.pop(0)
                n = min(space, len(ids) // WIDTH)
                bin_.append((document, start, ids[: n * WIDTH], total))
                if n * WIDTH < len(ids):
                    left.insert(0, (document, start + n, ids[n * WIDTH :], total))
                space -= n
            self._close(bin_)
            bin_ = []


def packed(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 1,
    capacity: int = 2048,
    smallest: int = 64,
    key: str = "doc_id",
    text: str = "text",
    with_ids: bool = True,
) -> DataFrame:
    """One row per piece: key, ``COLUMNS`` and, if wished, its ``ids``.

    ``capacity`` and ``smallest`` are powers of two.  A sequence is padded to
    ``capacity`` unless its length is a power of two.
    """
    if capacity & (capacity - 1) or smallest & (smallest - 1):
        raise ValueError("capacity and smallest must be powers of two")
    key_type = docs.select(key).schema[0].dataType.simpleString()
    schema = (
        f"`{key}` {key_type}, start long, length long, ids_crc32 long, doc_tokens long,"
        " sequence_id long, offset long" + ", ids array<int>" * with_ids
    )
    end = end_id.to_bytes(WIDTH, "little")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = Bins(TaskContext.get().partitionId() << 33, capacity, smallest)
        kind = None

        def out() -> pa.RecordBatch:
            columns = list(zip(*bins.rows, strict=True)) or [()] * 8
            arrays = [pa.array(columns[0], kind)]
            arrays += [pa.array(c, pa.int64()) for c in columns[1:7]]
            if with_ids:
                data = b"".join(columns[7])
                ends = [0]
                for c in columns[7]:
                    ends.append(ends[-1] + len(c) // WIDTH)
                flat = pa.Array.from_buffers(pa.int32(), len(data) // WIDTH, [None, pa.py_buffer(data)])
                arrays.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat))
            bins.rows = []
            return pa.record_batch(arrays, [key, *COLUMNS, *["ids"] * with_ids])

        for batch in batches:
            kind = batch.column(0).type
            ids = encoder(tokenizer).ids
            for document, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                bins.add(document, ids(value.as_py()) + end)
                if len(bins.rows) >= 5_000:
                    yield out()
        bins.finish()
        if kind is not None:
            yield out()

    return docs.select(key, text_of(text).alias("_text")).mapInArrow(pack, schema)
