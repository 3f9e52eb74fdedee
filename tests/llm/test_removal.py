"""Passages of words, byte strings and near copies against brute force."""

import collections
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sftprep.llm import jaccard, substrings, suffixes, windows

from .conftest import documents

LAST = 1 << 62


def order(key):
    return LAST if key is None else key


def passages(rows, length):
    first = {}
    split = [(order(i), (t or "").encode().split()) for i, t in rows]
    for key, words in split:
        for a in range(len(words) - length + 1):
            window = tuple(words[a : a + length])
            first[window] = min(first.get(window, LAST + 1), key)
    out = []
    for key, words in split:
        gone = [False] * len(words)
        for a in range(len(words) - length + 1):
            if first[tuple(words[a : a + length])] < key:
                gone[a : a + length] = [True] * length
        kept = b" ".join(w for w, g in zip(words, gone, strict=True) if not g).decode()
        out.append((key, len(words), sum(gone), kept))
    return sorted(out)


@pytest.mark.parametrize(("length", "large"), [(5, 10_000), (5, 3), (13, 10_000)])
def test_passages(table, monkeypatch, length, large):
    monkeypatch.setattr(substrings, "LARGE", large)
    rows = documents()
    left = substrings.without_repeats(table(rows), length)
    assert sorted(left.columns) == ["doc_id", "kept", "n_removed", "n_words"]
    got = sorted((order(r.doc_id), r.n_words, r.n_removed, r.kept) for r in left.collect())
    assert got == passages(rows, length)
    assert sum(g[2] for g in got) > 0


def test_text_left_keeps_white_space(table):
    passage = " ".join(f"p{n}" for n in range(8))
    rows = [
        (1, f"def f():\n    return  1\n\n{passage}\n"),
        (2, f"\tone  two\n\n{passage}\n\nthree\t four \n"),
        (3, f"  {passage}  tail\n"),
        (4, f"head\n {passage} \n"),
        (5, f"a\tb {passage}\n\n\nc  d"),
        (6, passage),
        (7, "  clean\r\n\ttext  "),
        (8, None),
        (9, " \n "),
    ]
    left = substrings.without_repeats(table(rows), 8, spaces=True)
    assert {r.doc_id: (r.n_removed, r.kept) for r in left.collect()} == {
        1: (0, rows[0][1]), 2: (8, "\tone  two\n\nthree\t four \n"), 3: (8, "  tail\n"), 4: (8, "head \n"),
        5: (8, "a\tb\n\n\nc  d"), 6: (8, ""), 7: (0, rows[6][1]), 8: (0, None), 9: (0, " \n "),
    }


def test_text_left_has_the_words_that_are_joined_otherwise(table):
    rows = documents()
    joined = {(r.doc_id, r.n_words, r.n_removed, r.kept) for r in substrings.without_repeats(table(rows), 5).collect()}
    spaced = substrings.without_repeats(table(rows), 5, spaces=True).collect()
    words = {(r.doc_id, r.n_words, r.n_removed, b" ".join((r.kept or "").encode().split()).decode()) for r in spaced}
    assert words == joined


def byte_strings(rows, length):
    first = {}
    rows = sorted({(order(i), (t or "").encode()) for i, t in rows})
    for d, (_, data) in enumerate(rows):
        for a in range(len(data) - length + 1):
            first.setdefault(data[a : a + length], (d, a))
    out = {}
    for d, (key, data) in enumerate(rows):
        gone = np.zeros(len(data), bool)
        for a in range(len(data) - length + 1):
            if first[data[a : a + length]] < (d, a):
                gone[a : a + length] = True
        spans = int(np.sum(np.diff(np.append([0], gone.astype(int))) == 1))
        out[key, data] = (len(data), int(gone.sum()), spans, np.frombuffer(data, np.uint8)[~gone].tobytes())
    return out


@pytest.mark.parametrize("shard", [3_000_000, 500])
def test_byte_strings(table, monkeypatch, shard):
    monkeypatch.setattr(suffixes, "SHARD_BYTES", shard)
    # rows of one key and different texts have an order of their own: left out here
    rows = [r for r in documents(2) if r[1] != "another text of key 7"][:-3] + [(7, documents(2)[7][1])]
    left = suffixes.without_repeats(table(rows), 50)
    got = sorted((order(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in left.collect())
    found = byte_strings(rows, 50)
    assert got == sorted((order(i), *found[order(i), (t or "").encode()]) for i, t in rows)
    assert sum(g[2] for g in got) > 0


@pytest.mark.parametrize(("n", "letters"), [(60, 2), (400, 3), (900, 1), (2000, 26)])
def test_suffix_array_and_common_prefixes(n, letters):
    rng = np.random.default_rng(n)
    text = rng.integers(97, 97 + letters, n).astype(np.uint8)
    ends = np.unique(np.append(rng.integers(0, n, 4), n - 1))
    text[ends] = 0

    def suffix(i):
        end = ends[np.searchsorted(ends, i)]
        return [1000 + int(x) for x in text[i:end]] + [int(np.searchsorted(ends, end))]

    found = suffixes.suffix_array(text, ends)
    assert list(found) == sorted(range(n), key=suffix)
    common = suffixes.common_prefixes(text, ends, found)
    for k in range(1, n):
        one, two = suffix(found[k - 1]), suffix(found[k])
        assert common[k] == next(i for i, (x, y) in enumerate(zip(one, two, strict=False)) if x != y)


def test_equal_windows_have_equal_anchors():
    raw = np.frombuffer(b"xyz" + b"abcdefghij" * 3 + b"QQ" + b"abcdefghij" * 3, np.uint8)
    a = windows.anchors_of(windows.byte_sequence(raw, np.array([0, 33, len(raw)])), 20, 6)
    assert a.count.sum() == (33 - 19) + (len(raw) - 33 - 19)
    by_window = {}
    for place, window, count in zip(a.place, a.window, a.count, strict=True):
        for w in range(window, window + count):
            assert w <= place <= w + 14
            assert by_window.setdefault(raw[w : w + 20].tobytes(), place - w) == place - w


def shingles(text, n):
    words = (text or "").encode().lower().split()
    if len(words) < n:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def classes(rows, threshold, n):
    sets = [shingles(t, n) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if common and 100 * common >= threshold * (len(a) + len(sets[j]) - common):
                parent[root(i)] = root(j)
    least = collections.defaultdict(lambda: LAST)
    for i, (key, _) in enumerate(rows):
        least[root(i)] = min(least[root(i)], order(key))
    return sorted((order(k), len(sets[i]), least[root(i)]) for i, (k, _) in enumerate(rows))


def chain(seed=4):
    """Near copies that are linked through others only, and near misses."""
    r = random.Random(seed)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(25):
        base = list(base)
        base[(i * 7) % 120] = f"c{i}"
        rows.append((100 + i, " ".join(base)))
    start = [f"v{i}" for i in range(60)]
    for i in range(40):
        words = list(start)
        for _ in range(r.choice([0, 1, 1, 2, 3])):
            words[r.randrange(60)] = f"u{r.randrange(40)}"
        rows.append((200 + i, " ".join(words)))
    return rows


@pytest.mark.parametrize(("threshold", "shingle"), [(90, 3), (80, 5), (60, 2)])
def test_components_of_near_copies(table, threshold, shingle):
    rows = documents(3) + chain() + [(900, "One"), (901, "one"), (902, "one two"), (903, "one\ttwo")]
    found = jaccard.joined(table(rows), threshold, shingle).collect()
    got = sorted((order(r.doc_id), r.n_shingles, order(r.component_id)) for r in found)
    assert got == classes(rows, threshold, shingle)


def test_matrix_finds_what_leaders_miss(table, monkeypatch):
    monkeypatch.setattr(jaccard, "leader_pairs", lambda p, t: p.sparkSession.createDataFrame(
        [], "a binary, b binary"))
    rows = chain(5)
    found = jaccard.joined(table(rows), 80, 3).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in found) == classes(rows, 80, 3)


def test_matrix_opens_a_part_of_sets_of_two_sizes(spark, folder):
    # the sets of 95 and 99 have 92 in common, of which 3 are in both prefixes
    def node(name):
        return np.frombuffer(name, np.int64).tolist()

    q, y, z = b"q" * 16, b"y" * 16, b"z" * 16
    rows = [(t, *node(k), n) for t in (1, 2, 3) for k, n in ((q, 95), (y, 99), (z, 100))]
    token, k1, k2, n = map(list, zip(*rows, strict=True))
    postings = spark.createDataFrame([(0, token, k1, k2, n)], f"_to long, {jaccard._POSTINGS}")
    groups = spark.createDataFrame([(bytearray(y), bytearray(y)), (bytearray(z), bytearray(y))], "k binary, c binary")
    for best in (True, False):
        opened, members = jaccard.opened_parts(postings, groups, 90, best)
        found = opened.join(members.withColumnRenamed("k", "m"), ["c", "part"]).collect()
        assert (q, y) in {(bytes(r.k), bytes(r.m)) for r in found}


def test_matrix_does_not_open_a_part_for_each_pair_of_a_cell(spark, folder):
    # no two of the nodes are linked yet, and each shares as much as a link needs with all others
    names = [f"{i:016d}".encode() for i in range(200)]
    k1, k2 = np.frombuffer(b"".join(names), np.int64).reshape(-1, 2).T.tolist()
    rows = [(0, [t] * 200, k1, k2, [148] * 200) for t in range(1, 10)]
    token, k1, k2, n = ([x for r in rows for x in r[i]] for i in range(1, 5))
    postings = spark.createDataFrame([(0, token, k1, k2, n)], f"_to long, {jaccard._POSTINGS}")
    groups = spark.createDataFrame([], "k binary, c binary")
    for best in (True, False):
        opened, members = jaccard.opened_parts(postings, groups, 90, best)
        assert opened.count() <= 200 * (200 // jaccard.PART + 1)
    met = opened.join(members.withColumnRenamed("k", "m"), ["c", "part"]).collect()
    pairs = {frozenset((bytes(r.k), bytes(r.m))) for r in met}
    assert len({p for p in pairs if len(p) == 2}) == 200 * 199 // 2


def test_links_of_many_that_are_nearly_alike(table, monkeypatch):
    monkeypatch.setattr(jaccard, "PART", 16)
    r = random.Random(2)
    rows = []
    for i in range(120):
        words = [f"w{j}" for j in range(60)]
        for j in r.sample(range(60), r.choice([1, 2, 2, 3])):
            words[j] = f"x{r.randrange(1000)}"
        rows.append((i, " ".join(words)))
    found = jaccard.joined(table(rows), 85, 3).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in found) == classes(rows, 85, 3)


@pytest.mark.parametrize("threshold", [60, 80, 90, 97])
def test_least_common_prefix_is_no_more_than_any_size_needs(spark, threshold):
    def up(x, y):
        return -(-x // y)

    for n in range(1, 140):
        for most in range(up(n * threshold, 100), n * 100 // threshold + 1):
            bound = threshold * (100 * n - threshold * most) // (100 * (100 + threshold)) + 1
            sizes = range(up(n * threshold, 100), most + 1)
            assert bound <= min(up((n + m) * threshold, 100 + threshold) - up(m * threshold, 100) + 1 for m in sizes)


def test_links_of_sets_of_95_and_99(table, monkeypatch):
    words = [f"w{i}" for i in range(103)]
    raw = " ".join(words).encode()
    _, token = jaccard.sets_of(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), 1)
    rank = {w: np.searchsorted(token, jaccard.sets_of(np.frombuffer(w.encode(), np.uint8), np.array([0, len(w)]), 1)[1])[0] for w in words}
    words.sort(key=rank.get)
    # the words of one text alone come first in the prefixes of the larger ones
    rows = [(1, " ".join(words[8:])), (2, " ".join(words[1:100])), (3, " ".join(words[:100]))]
    pairs = jaccard.leader_pairs

    def without_smallest(postings, threshold):
        every = postings.selectExpr("explode(arrays_zip(token, k1, k2, n)) e").select("e.*").where("n > 95")
        lists = [f"collect_list({c}) {c}" for c in ("token", "k1", "k2", "n")]
        by_token = every.repartition(1).sortWithinPartitions("token").selectExpr("0L _to", "*")
        return pairs(by_token.groupBy("_to").agg(*[F.expr(x) for x in lists]), threshold)

    monkeypatch.setattr(jaccard, "leader_pairs", without_smallest)
    found = jaccard.joined(table(rows), 90, 1).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in found) == classes(rows, 90, 1)
    assert {r.component_id for r in found} == {1}


def test_one_of_each_class_stays(table):
    rows = documents(3) + chain()
    stay = jaccard.one_of_each(table(rows), 80, 5)
    assert stay.columns == ["doc_id", "text", "kept", "n_words"]
    assert len(stay.select("doc_id", "text").distinct().collect()) == stay.count()
    left = {order(r.doc_id) for r in stay.collect()}
    assert left == {c for _, _, c in classes(rows, 80, 5)}


CLASHING = ["_id", "_print", "_to", "_text", "_row", "_no_text", "kept", "n_words", "n_removed", "k", "c", "part", "n", "a", "b"]


def clashing(spark, rows):
    """The rows with columns of the names that the operators use inside, one a map."""
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    more = [F.concat(F.lit(c), F.col("doc_id").cast("string")).alias(c) for c in CLASHING]
    return docs.select("doc_id", *more[:5], "text", *more[5:], F.create_map(F.lit("m"), "doc_id").alias("with space"))


def unchanged(before, after):
    """All columns but the text are as they were."""
    rows = {r["doc_id"]: r for r in before.collect()}
    for r in after.collect():
        assert all(r[c] == rows[r["doc_id"]][c] for c in before.columns if c != "text")


def test_columns_of_any_name(spark, folder):
    rows = [(i, t) for i, t in documents(3) if i not in (None, 7)] + chain()
    docs = clashing(spark, rows)
    one = jaccard.one_of_each(docs, 80, 5)
    assert one.columns == docs.columns
    unchanged(docs, one)
    assert {r.doc_id for r in one.collect()} == {c for _, _, c in classes(rows, 80, 5)}
    assert {(r.doc_id, r.text) for r in one.collect()} <= set(rows)

    cut = substrings.with_texts_left(docs, 5)
    assert cut.columns == docs.columns
    unchanged(docs, cut)
    plain = substrings.without_repeats(docs.select("doc_id", "text"), 5, spaces=True)
    assert {(r.doc_id, r.text) for r in cut.collect()} == {
        (r.doc_id, r.kept) for r in plain.collect() if r.kept != "" or not r.n_removed
    }
    left = suffixes.without_repeats(docs, 50)
    assert set(docs.columns) - {"text"} <= set(left.columns)
    unchanged(docs.drop("kept", "n_removed"), left)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(None, "only one text")]])
def test_small_tables(table, rows):
    n = len(rows)
    assert substrings.without_repeats(table(rows)).count() == n
    assert suffixes.without_repeats(table(rows)).count() == n
    assert jaccard.joined(table(rows)).count() == n
