"""The flows from a table to written splits, training rows and a score."""

import pytest

import sftprep as S
from sftprep import fixtures as fx

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def examples(spark):
    return S.settle(fx.examples(spark, SF_DIR))


def test_examples_view(examples):
    assert examples.count() == 233
    assert examples.filter("context <> ''").count() == 47
    assert examples.select("example_id").distinct().count() == 233


def test_create_dataset(spark, examples, tmp_path):
    path = str(tmp_path / "data")
    S.create_dataset(examples, 100, 0.8, seed=1, path=path)
    schema = S.EXAMPLE_SCHEMA + ", split string"
    assert S.read_jsonl(spark, path, schema, "train").count() == 20
    stored = S.read_jsonl(spark, path, schema)
    assert stored.filter("split = 'test'").count() == 80
    assert stored.drop("split").exceptAll(examples).count() == 0


def test_create_conversations(spark, examples, tmp_path):
    path = str(tmp_path / "data")
    S.create_dataset(examples, 50, 0.2, seed=1, messages=True, path=path)
    stored = S.read_jsonl(spark, path, "example_id bigint, " + S.CONVERSATION_SCHEMA + ", split string")
    assert S.summarize(stored).count() == 2
    triples = S.from_messages(stored.filter("split = 'train'"))
    plain = triples.drop("context").exceptAll(examples.drop("context"))
    assert (triples.count(), plain.count()) == (40, 0)


@pytest.mark.parametrize("style", ["turns", "sections", "chatml"])
def test_training_rows(examples, style):
    source = S.to_messages(examples) if style == "chatml" else examples
    texts = source.select("example_id", S.training_text(style).alias("text"))
    tokens = texts.select("example_id", S.tokenize("text").alias("tokens"))
    vocab = S.settle(S.build_vocab(tokens, "tokens", ["<unk>", "<eos>"], 100_000))
    encoded = S.settle(S.encoded_texts(source, vocab, style=style, eos=1))
    back = S.decode(encoded, vocab).select("example_id", "text")
    assert back.exceptAll(texts).count() == 0

    rows = S.training_rows(encoded, 128, pad_id=1, truncation_side="left", ignore_index=-100)
    row = rows.filter("was_truncated").first()
    assert len(row["input_ids"]) == 128 and row["input_ids"][-1] == 1
    assert row["labels"] == row["input_ids"] and sum(row["attention_mask"]) == 128
    for row in rows.filter("not was_truncated").take(20):
        assert len(row["input_ids"]) == len(row["labels"]) == 128
        assert row["labels"].count(-100) == row["attention_mask"].count(0)

    assert S.training_blocks(encoded, 64, seed=1).count() == (
        encoded.selectExpr("sum(size(input_ids))").first()[0] // 64
    )


def test_unknown_style():
    with pytest.raises(ValueError):
        S.training_text("other")


def test_fixture_hits(spark, examples):
    """The stand-in's matches must be exactly its hits; 151 is a fixture fact."""
    hits = examples.filter(fx.is_hit()).count()
    assert hits == 151

    def factory():
        return lambda prompts: [p + " SELECT 1 <end_of_turn> more" for p in prompts]

    right = examples.withColumn("answer", fx.F.when(fx.is_hit(), "SELECT 1").otherwise("SELECT 2"))
    scored = S.scored_predictions(right, factory)
    assert tuple(S.accuracy(scored).first())[:2] == (233, 151)
    assert S.evaluate(right, factory, n=100, seed=2).first()["n"] == 100
    capped = S.scored_predictions(right, factory, max_tokens=2)
    assert S.accuracy(capped).first()["hits"] == 0


def test_predictor_sees_the_prompt_alone(examples):
    model = fx.answers_by_first_word(examples)
    assert 0 < len(model) <= 256
    seen = S.predict_batches(
        examples.select(S.prompt_text().alias("prompt")), fx.predictor(model), batch_size=16
    ).collect()
    assert len(seen) == 233
    for r in seen:
        assert r["raw"].startswith(r["prompt"] + " ") and r["raw"].endswith(fx.TAIL)
    scored = S.scored_predictions(examples, fx.predictor(model)).collect()
    assert 0 < sum(r["score"] for r in scored) < 233
    assert sum(r["prediction"] in model.values() for r in scored) > 200


@pytest.mark.parametrize("style", ["turns", "sections", "chatml"])
def test_prompt_styles(examples, style):
    """A prompt is the start of the training text, and an echoed answer is found again."""
    source = S.to_messages(examples, keep=["answer"]) if style == "chatml" else examples
    texts = source.select(S.prompt_text(style).alias("p"), S.training_text(style).alias("t"))
    assert texts.filter("not startswith(t, p)").count() == 0

    def factory():
        end = {"turns": "<end_of_turn>", "sections": "<end_of_turn>", "chatml": "<|im_end|>"}[style]
        return lambda prompts: [f"{p} SELECT 7 {end} more" for p in prompts]

    right = source.withColumn("answer", fx.F.lit("SELECT 7"))
    assert S.accuracy(S.scored_predictions(right, factory, style=style)).first()["hits"] == 233
    assert S.evaluate(right, factory, n=20, seed=1, style=style).first()["hits"] == 20


def test_own_tokenizer(spark, examples):
    made = spark.sparkContext.accumulator(0)

    def factory():
        made.add(1)
        return lambda texts: [[len(w) for w in t.split(" ")] for t in texts]

    rows = S.encoded_texts(examples.repartition(3), factory, bos=-1, eos=-2).collect()
    texts = {r["example_id"]: r["t"] for r in examples.select("example_id", S.training_text().alias("t")).collect()}
    assert {r["example_id"]: r["input_ids"] for r in rows} == {
        k: [-1, *[len(w) for w in t.split(" ")], -2] for k, t in texts.items()
    }
    assert made.value <= 3
    with pytest.raises(Exception, match="id lists for"):
        S.tokenize_batches(examples, lambda: lambda texts: [], "question").collect()


def test_entry(spark):
    import __spark_entry__ as contract

    row = contract.entry(spark).first()
    assert (row["n"], row["hits"]) == (34, 31)
    assert set(contract.oracle_sql()) <= set(contract.queries())
