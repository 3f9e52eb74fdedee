"""Operator 1: secret scans by pattern and by character Markov models.

Patterns find secrets that say what they are (``PATTERNS``).  Beside them, every run of
at least ``SHORTEST`` characters of ``ALPHABET`` is judged by two first-order Markov
models over characters, one of random strings and one of ordinary identifiers: a run is
a secret if the log-likelihood ratio of the two exceeds ``threshold``.

The models are trained on runs that are labelled by rule, each distinct run once:
*random* are the runs that a pattern's secret lies in (the part that is the secret),
*ordinary* are runs that no pattern touches and that hold no digit or hold nothing but
digits and punctuation.  Training counts pairs of neighbouring characters in tasks and
adds them up; what reaches the driver is two tables of 70 x 70 counts.

``threshold`` is in nats; the default asks for odds of 10,000 : 1, about the share of
secrets among runs.  Without samples of both kinds the models add nothing.

Defined results: a null or empty text has no spans; every row counts for itself.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sftprep.llm.common import text_of

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
_VALUE = r"[A-Za-z0-9+/_.=-]"
#: Kind, pattern, group that is the secret, its least length; in the order of the kinds.
PATTERNS = (
    (
        "assign",
        re.compile(
            r"(?:[Pp][Aa][Ss][Ss](?:[Ww][Oo][Rr][Dd]|[Ww][Dd])|[Ss][Ee][Cc][Rr][Ee][Tt]"
            r"|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
            r"[\"']?\x20*[:=]\x20*[\"']?(" + _VALUE + "+)"
        ),
        1,
        8,
    ),
    ("access", re.compile("AKIA[A-Z0-9]+"), 0, 16),
    ("hex", re.compile("[0-9a-f]{32,}"), 0, 32),
)
KINDS = tuple(p[0] for p in PATTERNS)
MARKOV = "markov"
SHORTEST = 16
_RUN = re.compile(f"{_VALUE}{{{SHORTEST},}}")
_CODES = np.full(256, 0, np.uint8)
_CODES[[ord(c) for c in ALPHABET]] = np.arange(1, len(ALPHABET) + 1)
#: Models count the border of a run as a character, number 0.
SIZE = len(ALPHABET) + 1


def base_spans(text: str) -> list[tuple[int, int, int, int]]:
    """Start, number of the kind, end, start of the secret; in order."""
    found = []
    for i, (_, pattern, group, least) in enumerate(PATTERNS):
        for m in pattern.finditer(text):
            if m.end(group) - m.start(group) >= least:
                found.append((m.start(), i, m.end(), m.start(group)))
    return sorted(found)


def free_runs(text: str, spans: list[tuple]) -> Iterator[tuple[int, str]]:
    """Start and characters of the runs that no span touches."""
    ordered, i = sorted((s[0], s[2]) for s in spans), 0
    reach = 0  # the furthest end of the spans that begin before the run ends
    for m in _RUN.finditer(text):
        while i < len(ordered) and ordered[i][0] < m.end():
            reach = max(reach, ordered[i][1])
            i += 1
        if reach <= m.start():
            yield m.start(), m.group()


def _pairs(run: str) -> tuple[np.ndarray, np.ndarray]:
    codes = np.zeros(len(run) + 2, np.uint8)
    codes[1:-1] = _CODES[np.frombuffer(run.encode("ascii"), np.uint8)]
    return codes[:-1], codes[1:]


def trained_model(docs: DataFrame, text: str = "text") -> np.ndarray | None:
    """Log-likelihood ratio of each pair of characters, or None without samples."""

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: set[tuple[str, int]] = set()
            for value in batch.column(0):
                content = value.as_py()
                spans = base_spans(content)
                seen.update((content[s[3] : s[2]], 1) for s in spans)
                for _, run in free_runs(content, spans):
                    digits = sum(c.isdigit() for c in run)
                    if not digits or not any(c.isalpha() for c in run):
                        seen.add((run, 0))
            yield pa.record_batch(
                [pa.array([s[0] for s in seen], pa.string()), pa.array([s[1] for s in seen], pa.int32())],
                ["run", "random"],
            )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, SIZE, SIZE), np.int64)
        for batch in batches:
            for run, random in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                np.add.at(sums[random], _pairs(run), 1)
        cells = np.flatnonzero(sums)
        yield pa.record_batch([pa.array(cells), pa.array(sums.ravel()[cells])], ["cell", "n"])

    samples = docs.select(text_of(text)).mapInArrow(label, "run string, random int").distinct()
    cells = samples.mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n")).collect()
    counts = np.zeros(2 * SIZE * SIZE)
    for cell, n in cells:
        counts[cell] = n
    counts = counts.reshape(2, SIZE, SIZE)
    if not (counts.sum((1, 2)) > 0).all():
        return None
    odds = np.log((counts + 0.5) / (counts + 0.5).sum(2, keepdims=True))
    return odds[1] - odds[0]


def all_spans(text: str, model: np.ndarray | None, threshold: float) -> tuple[list, list]:
    """The patterns' spans, and all: (start, number of the kind, end, ...)."""
    base = base_spans(text)
    more = []
    if model is not None:
        for start, run in free_runs(text, base):
            if model[_pairs(run)].sum() > threshold:
                more.append((start, len(KINDS), start + len(run), start))
    return base, sorted(base + more)


def _joined(spans: list[tuple]) -> str:
    names = (*KINDS, MARKOV)
    return ",".join(f"{names[s[1]]}:{s[0]}:{s[2]}" for s in spans)


def scanned(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    threshold: float = math.log(10_000),
) -> DataFrame:
    """Per row: key, a count for each kind, base_sha256, spans.

    ``spans`` lists ``kind:start:end`` in code points, by start, then kind.
    """
    shared = docs.sparkSession.sparkContext.broadcast(trained_model(docs, text))
    key_type = docs.select(key).schema[0].dataType.simpleString()
    counts = [f"n_{k}" for k in KINDS]
    schema = f"`{key}` {key_type}, {', '.join(c + ' long' for c in counts)}, base_sha256 string, spans string"

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [all_spans(v.as_py(), shared.value, threshold) for v in batch.column(1)]
            columns = [batch.column(0)]
            for i in range(len(KINDS)):
                columns.append(pa.array([sum(s[1] == i for s in base) for base, _ in found], pa.int64()))
            digests = [hashlib.sha256(_joined(base).encode()).hexdigest() for base, _ in found]
            columns += [pa.array(digests, pa.string()), pa.array([_joined(s) for _, s in found], pa.string())]
            yield pa.record_batch(columns, [key, *counts, "base_sha256", "spans"])

    return docs.select(key, text_of(text).alias("_text")).mapInArrow(scan, schema)


def redacted(
    docs: DataFrame, text: str = "text", mark: str = "<secret>", threshold: float = math.log(10_000)
) -> DataFrame:
    """``docs`` with every span replaced by ``mark``; a null text stays null."""
    shared = docs.sparkSession.sparkContext.broadcast(trained_model(docs, text))
    at = docs.columns.index(text)

    def clean(content: str | None) -> str | None:
        if content is None:
            return None
        parts, done = [], 0
        for start, _, end, _ in all_spans(content, shared.value, threshold)[1]:
            if start >= done:
                parts += [content[done:start], mark]
            done = max(done, end)
        return "".join([*parts, content[done:]])

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new = pa.array([clean(v.as_py()) for v in batch.column(at)], pa.string())
            yield batch.set_column(at, batch.schema.field(at).with_type(pa.string()), new)

    return docs.mapInArrow(replace, docs.schema)
