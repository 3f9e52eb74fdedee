"""Views of the test tables in the shapes the library works on, raw output to clean, and
a small predictor, which knows the prompt only and was fitted on the examples' answers."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .functions.templates import TURN_END, TURN_QUESTION, render_turns
from .sources.tables import read_table, spread

# One example per answered user turn; runs unchanged in Spark and DuckDB.
EXAMPLES_SQL = """
select u.conv_id * 100 + u.turn as example_id,
       coalesce(y.text, '')     as context,
       u.text                   as question,
       a.text                   as answer
from conversations u
join conversations a on a.conv_id = u.conv_id and a.turn = u.turn + 1 and a.role = 'assistant'
left join conversations y on y.conv_id = u.conv_id and y.role = 'system'
where u.role = 'user'
"""

TAIL = f"\n{TURN_END}\ntail"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents"), "doc_id")


def examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(
        EXAMPLES_SQL.replace("conversations", "{conversations}"),
        conversations=table(spark, sf_dir, "conversations"),
    )


def with_turn(df: DataFrame) -> DataFrame:
    """The turn an example was taken from, as a group to score by."""
    return df.withColumn("turn", F.col("example_id") % 100)


def is_hit() -> Column:
    """Whether the raw output below has the example's answer (about ten in sixteen)."""
    return F.substring(F.md5(F.concat(F.lit("p:"), F.col("example_id").cast("string"))), 1, 1) < "a"


def reply() -> Column:
    """Raw output before its end marker: the prompt echoed, then the answer, altered when
    it is no hit."""
    altered = F.when(is_hit(), "").otherwise(" LIMIT 1")
    return F.concat(render_turns("context", "question"), F.lit(" "), F.col("answer"), altered)


def with_raw(df: DataFrame) -> DataFrame:
    return df.withColumn("prompt", render_turns("context", "question")).withColumn(
        "raw", F.concat(reply(), F.lit(TAIL))
    )


def first_word_bucket(question: Column) -> Column:
    return F.substring(F.md5(F.substring_index(question, " ", 1)), 1, 2)


def answers_by_first_word(examples: DataFrame) -> dict[str, str]:
    """A small model: the most frequent answer to questions by the hash of their first
    word.  It has 256 entries at most, whatever the number of examples."""
    counts = examples.groupBy(first_word_bucket(F.col("question")).alias("bucket"), "answer").count()
    # the first of equally frequent answers in their order
    best = counts.groupBy("bucket").agg(F.min(F.struct((-F.col("count")).alias("n"), "answer")).alias("b"))
    return {r["bucket"]: r["answer"] for r in best.select("bucket", "b.answer").collect()}


def predictor(model: dict[str, str], tail: str = TAIL):
    """Predictor factory: looks the question up that it finds in the prompt, and says the
    prompt, the answer and what comes after a model's end marker."""

    def answer(prompt: str) -> str:
        question = prompt.rpartition(TURN_QUESTION)[2].partition(TURN_END)[0]
        bucket = hashlib.md5(question.split(" ")[0].encode()).hexdigest()[:2]
        return f"{prompt} {model.get(bucket, '')}{tail}"

    return lambda: lambda prompts: [answer(p) for p in prompts]
