import pytest


@pytest.fixture(scope="session")
def folder(spark):
    """The shared folder for intermediate tables."""
    return spark.conf.get("spark.checkpoint.dir")


@pytest.fixture
def table(spark, folder):
    """A table of documents, with a column that clashes and one that doesn't."""

    def make(rows, parts=3):
        rows = [(i, t, f"x{n}", n) for n, (i, t) in enumerate(rows)]
        schema = "doc_id long, text string, kept string, n_words int"
        return spark.createDataFrame(rows, schema).repartition(parts)

    return make


def documents(seed=1, n=60):
    """Texts with repeats, copies, odd white space, null and empty ones, and tied keys."""
    import random

    r = random.Random(seed)
    words = [f"w{i}" for i in range(12)] + ["é", "Straße,", "日本語", "🙂", "a▁b"]
    spaces = [" ", " ", " ", "  ", "\n", "\t"]
    texts = []
    for _ in range(n):
        text = "".join(r.choice(words) + r.choice(spaces) for _ in range(r.randint(0, 60)))
        texts.append(text)
    texts += [texts[3], texts[4] + "and more", texts[5][: len(texts[5]) // 2], "", None, " \n ", "x " * 3000]
    rows = [(i, t) for i, t in enumerate(texts)]
    return rows + [(None, texts[6]), (None, "alone without a key"), (7, texts[7]), (7, "another text of key 7")]
