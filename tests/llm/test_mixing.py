"""Sainte-Lague quotas and mixes against brute force."""

import hashlib
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from sftprep.llm import mixing


def quotas(weights, seats):
    """Seats one by one, each to the highest quotient (members in order where equal)."""
    won = Counter()
    for _ in range(seats):
        best = max(weights, key=lambda m: (Fraction(weights[m], 2 * won[m] + 1), -sorted(weights).index(m)))
        won[best] += 1
    return won


@pytest.mark.parametrize("seats", [0, 1, 3, 7, 40, 200])
def test_highest_quotients(spark, folder, seats):
    weights = {"a": 1, "b": 100, "c": 100, "d": 37, "e": 3, "f": 0, "g": 700, "h": 3}
    rows = [(g, m, w * (2 if g == "y" else 1), seats) for g in ("x", "y", None) for m, w in weights.items()]
    table = spark.createDataFrame(rows, "g string, m string, w long, seats long").repartition(5)
    got = mixing.highest_quotients(table, ["g"], "m", "w", "seats", "won").collect()
    want = quotas(weights, seats)
    assert len(got) == len(rows)
    for r in got:
        assert r["won"] == want[r["m"]], (r, want)
    alone = mixing.highest_quotients(table.where("g = 'x'").drop("g"), [], "m", "w", "seats", "won")
    assert {r["m"]: r["won"] for r in alone.collect()} == {m: want[m] for m in weights}


def size(text):
    return len((text or "").encode().split())


def targets(sizes, weights=(5, 2, 1), share=1.5, repeats=2):
    """Targets by giving the excess to the sources that are not full, again and again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full, left = set(), share * sum(sizes.values())
    while True:
        open_ = [s for s in names if s not in full]
        rest = left - sum(repeats * sizes[s] for s in full)
        found = {s: rest * weight[s] / sum(weight[t] for t in open_) for s in open_}
        over = [s for s in open_ if found[s] > repeats * sizes[s]]
        if not over:
            return found | {s: float(repeats * sizes[s]) for s in full}
        full.update(over)


@pytest.fixture(scope="module")
def rows():
    texts = [(i, " ".join(f"w{j}" for j in range((i * 37) % 90))) for i in range(300)]
    sources = ["big"] * 150 + [f"s{i % 7}" for i in range(100)] + [None] * 30 + ["é"] * 20
    rows = [(i, t, s) for (i, t), s in zip(texts, sources, strict=True)]
    copies = [(900, "a copy of one row in full", "big")] * 40
    odd = [(None, "no key here", "big"), (None, "none here either", None), (5, "another text of key 5", "s1")]
    return rows + copies + odd + [(901, None, "s2"), (902, "", "s3"), (903, "x " * 5000, "long"), (904, " \n", "blank")]


@pytest.mark.parametrize("shard_words, shard_rows", [(1_000_000, 2_000), (500, 7)])
def test_mix(spark, folder, rows, shard_words, shard_rows):
    docs = spark.createDataFrame(
        [(*r, "x", 1, "y") for r in rows], "doc_id long, text string, source string, size string, quota int, _key string"
    )
    made = {"shard_words": shard_words, "shard_rows": shard_rows}
    got = mixing.mixed(docs.repartition(3), **made).collect()
    assert len(got) == len(rows)
    assert Counter((r["doc_id"], r["source"], r["size"]) for r in got) == Counter((i, s, size(t)) for i, t, s in rows)
    sizes, taken = defaultdict(int), defaultdict(int)
    for _, t, s in rows:
        sizes[s] += size(t)
    want = targets(sizes)
    for r in got:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]], abs=1e-6)
        assert 0 <= r["taken"] <= 2 * r["size"]
        assert r["taken"] == sum(s["words"] * s["times"] for s in r["spans"])
        assert all(0 <= s["start"] and s["start"] + s["words"] <= r["size"] for s in r["spans"])
        taken[r["source"]] += r["taken"]
    shards = {s: max(1, -(-n // shard_words), -(-len(rows) // shard_rows)) for s, n in sizes.items()}
    for s, n in sizes.items():
        assert abs(taken[s] - want[s]) <= 16 * (2 + shards[s])
    again = mixing.mixed(docs.repartition(11), **made).collect()
    assert Counter(map(str, again)) == Counter(map(str, got))
    other = mixing.mixed(docs, seed=12, **made).collect()
    assert Counter(map(str, other)) != Counter(map(str, got))


def test_texts_of_a_mix(spark, folder, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mix = mixing.mixed(docs, shard_words=500, shard_rows=7)
    texts = mixing.mixed_texts(docs, mix).collect()
    taken = {(r["doc_id"], r["text_md5"]): r for r in mix.collect()}
    assert sum(size(r["text"]) for r in texts) == mix.agg(F.sum("taken")).first()[0]
    by_key = {i: (t or "").split() for i, t, _ in rows if i not in (None, 5)}
    for r in texts:
        if r["doc_id"] in by_key:
            words = by_key[r["doc_id"]][r["start"] :]
            assert r["text"].split() == words[: size(r["text"])]
    assert taken and hashlib.md5(b"").hexdigest() in {m for _, m in taken}


def test_nothing_to_mix(spark, folder):
    schema = "doc_id long, text string, source string"
    assert mixing.mixed(spark.createDataFrame([], schema)).count() == 0
    empty = mixing.mixed(spark.createDataFrame([(1, None, "a"), (2, "", None)], schema)).collect()
    assert {(r["doc_id"], r["size"], r["target"], r["taken"]) for r in empty} == {(1, 0, 0.0, 0), (2, 0, 0.0, 0)}
