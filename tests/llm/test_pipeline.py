"""The stages one after the other, against brute force on a small table."""

import corpus_pipeline

from .conftest import documents
from .test_removal import chain, classes, passages


def test_stages(spark, table, folder, tmp_path):
    long_ = [(i, (t or "") and " ".join(f"{w}{i}" for w in (t or "").split()) + " shared" * 2) for i, t in documents(8)]
    rows = [(i, t) for i, t in long_ if i is not None] + chain(8) + [(800, "plain " + "token=abcdefgh12 " + " ".join(f"q{n}" for n in range(80)))]
    docs = table(rows).selectExpr("doc_id", "text", "'en' as lang", "'src0' as source", "cast(length(text) as long) as n_chars")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality long, toxic long").write.parquet(f"{tmp_path}/labels.parquet")
    columns, stages = docs.columns, dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality rules", "n-gram jaccard join", "substring dedup", "secret scans", "packing"]

    def step(name, docs):
        out = stages[name](spark, docs, str(tmp_path))
        path = f"{tmp_path}/{name.replace(' ', '-')}"
        out.write.parquet(path)
        return spark.read.parquet(path)

    kept = step("quality rules", docs)
    assert kept.columns == columns and 0 < kept.count() < len(rows)
    assert all(len((r.text or "").encode().split()) >= 50 for r in kept.collect())

    before = [(r.doc_id, r.text) for r in kept.collect()]
    one = step("n-gram jaccard join", kept)
    assert one.columns == columns
    assert {r.doc_id for r in one.collect()} == {c for _, _, c in classes(before, 80, 5)}

    before = [(r.doc_id, r.text) for r in one.collect()]
    cut = step("substring dedup", one)
    assert cut.columns == columns
    assert sorted((r.doc_id, r.text) for r in cut.collect()) == sorted(
        (i, t) for i, _, gone, t in passages(before, 50) if t or not gone
    )
    assert all(r.n_chars == len(r.text) for r in cut.collect())

    clean = step("secret scans", cut)
    assert clean.columns == columns and clean.count() == cut.count()
    assert clean.where("doc_id = 800").first().text.startswith("plain <secret> q0")

    packed = step("packing", clean)
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in clean.collect()}
    assert corpus_pipeline.run.__doc__


def test_substring_stage_leaves_clean_texts_alone(spark, table, folder, tmp_path):
    rows = [(1, "def f():\n    return  1\n"), (2, "a\tb  c\r\n"), (3, "")]
    docs = table(rows).selectExpr("doc_id", "text", "cast(length(text) as long) as n_chars")
    out = dict(corpus_pipeline.STAGES)["substring dedup"](spark, docs, str(tmp_path))
    assert sorted(map(tuple, out.collect())) == [(i, t, len(t)) for i, t in rows]
