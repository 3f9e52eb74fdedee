"""Manifests and witnesses against a tree built level by level."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from sftprep.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, _group int, root long"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(doc, text, lang, source, n):
    return h("".join(map(field, (doc, source, lang, n, text))))


def tree(nodes):
    """The root, and for each node the siblings on its way (digest or None, it is left)."""
    paths, own = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, at in enumerate(own):
            other = at ^ 1
            paths[k].append((nodes[other] if other < len(nodes) else None, at % 2 == 1))
        own = [at // 2 for at in own]
        nodes = [h("".join(nodes[i : i + 2])) for i in range(0, len(nodes), 2)]
    return nodes[0], paths


def brute(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append((row[0] is not None, row[0] or 0, leaf(*row), row))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    subroots, paths = {}, {}
    for g in names:
        groups[g].sort(key=lambda x: x[:3])
        subroots[g], paths[g] = tree([x[2] for x in groups[g]])
    root, top = tree([subroots[g] for g in names])
    out = []
    for g, above in zip(names, top, strict=True):
        for (_, _, own, row), path in zip(groups[g], paths[g], strict=True):
            doc, text, lang, source, n = row
            node = own
            if doc is not None and zlib.crc32(str(doc).encode()) % 7 == 0 and n is not None:
                node = leaf(doc, text, lang, source, n + 1)
            siblings = ""
            for digest, on_left in path + above:
                siblings += digest or ""
                node = h(node if digest is None else digest + node if on_left else node + digest)
            out.append((doc, own, subroots[g], root, h(siblings), node, node == root))
    return sorted(out, key=repr)


def rows(n):
    made = [(i * 3, f"text {i} é🙂", ["en", "fr", "en", None, "de"][i % 5], f"s{i % 3}", i) for i in range(n)]
    odd = [(None, "x", "en", None, 5), (None, None, None, None, None), (3, "other text", "en", "s0", 1), (9999, "", "only", "", 0)]
    return made + odd + [(30, "x" * 100_000, "en", "s", 7)] + [(14, "the same", "fr", "s", 1)] * 3


@pytest.mark.parametrize("n, run", [(0, 1024), (61, 1024), (61, 2), (200, 8)])
def test_manifest(spark, folder, monkeypatch, n, run):
    monkeypatch.setattr(merkle, "RUN", run)
    data = rows(n)
    docs = spark.createDataFrame([(*r, "leaf", 1, 2) for r in data], SCHEMA).repartition(3)
    got = merkle.with_tampering(docs)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(data)


@pytest.mark.parametrize("n", range(1, 10))
def test_appended_leaves(n):
    nodes = [h(str(i)) for i in range(n)]
    done = merkle.Appended()
    for node in nodes:
        done.append(node)
    root, paths = tree(nodes)
    assert done.close(None) == root
    for lefts, rights, path in zip(done.lefts, done.rights, paths, strict=True):
        assert [(left or right, left is not None) for left, right in zip(lefts, rights, strict=True)] == [
            (digest, on_left if digest else False) for digest, on_left in path
        ]


def test_any_change_is_seen(spark, folder):
    docs = spark.createDataFrame([r[:5] for r in rows(40)], "doc_id long, text string, lang string, source string, n_chars long")
    made = merkle.manifest(docs)
    found = made.select(merkle.folded(F.col("leaf"), F.col("witness")).alias("f"), "root")
    assert found.where("f <> root").count() == 0
    changed = made.select(merkle.folded(F.sha2("leaf", 256), F.col("witness")).alias("f"), "root")
    assert changed.where("f = root").count() == 0


def test_no_rows(spark, folder):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    assert merkle.with_tampering(docs).count() == 0
