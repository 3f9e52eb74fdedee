"""Golden rows for prompts, messages and cleaning."""

import pytest
from pyspark.sql import functions as F

import sftprep as S

SCHEMA = "example_id bigint, context string, question string, answer string"
PLAIN = (1, "CREATE TABLE head (age INTEGER)", "How many heads?", "SELECT COUNT(*) FROM head")
ODD = (2, 'LIKE "%a%" {schema} %s', "what <end_of_turn> is\n<|im_end|>?", "x | y")
EMPTY = (3, "", "", "")
NULL = (4, "c", "q", None)


@pytest.fixture(scope="module")
def ex(spark):
    return spark.createDataFrame([PLAIN, ODD, EMPTY, NULL], SCHEMA)


def values(df, column):
    return [r[0] for r in df.orderBy("example_id").select(column).collect()]


def text(spark, column, *fields):
    names = [f"c{i}" for i in range(len(fields))]
    schema = ", ".join(f"{n} string" for n in names)
    return spark.createDataFrame([fields], schema).select(column).first()[0]


def test_turns(ex):
    got = values(ex, S.render_turns("context", "question", "answer"))
    assert got[0] == (
        "<start_of_turn>user\nCONTEXT:CREATE TABLE head (age INTEGER)\n"
        "QUESTION:How many heads?<end_of_turn> <start_of_turn>model\n"
        "SELECT COUNT(*) FROM head<end_of_turn>"
    )
    assert got[1] == (
        '<start_of_turn>user\nCONTEXT:LIKE "%a%" {schema} %s\n'
        "QUESTION:what <end_of_turn> is\n<|im_end|>?<end_of_turn> <start_of_turn>model\n"
        "x | y<end_of_turn>"
    )
    assert got[3] is None
    prompts = values(ex, S.render_turns("context", "question"))
    assert [p + r[3] + S.TURN_END for p, r in zip(prompts, [PLAIN, ODD, EMPTY])] == got[:3]


def test_sections_and_quotes(ex):
    fields = [S.escape_quotes(c) for c in ("context", "question", "answer")]
    got = values(ex, S.render_sections(*fields))
    assert got[1] == (
        "###System:\nRead the references provided and answer the corresponding question.\n"
        '###Context:\nLIKE \\"%a%\\" {schema} %s\n'
        "###Question:\nwhat <end_of_turn> is\n<|im_end|>?\n###Answer:\nx | y"
    )
    assert got[3] is None


def test_system_message(ex):
    got = values(ex, S.system_message("context"))
    assert got[1].endswith('provided SCHEMA.\nSCHEMA:\nLIKE "%a%" {schema} %s')
    assert got[0].startswith("You are an text to SQL query translator. Users will ask you ")


def test_chatml(ex):
    rows = S.to_messages(ex)
    got = values(rows, S.render_chatml("messages"))
    assert got[0].endswith(
        "<|im_end|>\n<|im_start|>user\nHow many heads?<|im_end|>\n"
        "<|im_start|>assistant\nSELECT COUNT(*) FROM head<|im_end|>\n"
    )
    assert got[0].startswith("<|im_start|>system\nYou are an text")
    assert got[3] is None
    opened = values(rows, S.render_chatml("messages", open_turn=True))
    assert opened[0] == got[0] + "<|im_start|>assistant\n"
    prompt = values(rows, S.render_chatml(S.message_prefix("messages", 2), open_turn=True))
    assert got[0] == prompt[0] + "SELECT COUNT(*) FROM head<|im_end|>\n"


def test_messages_and_back(ex):
    rows = S.to_messages(ex)
    assert rows.columns == ["example_id", "messages"]
    back = S.from_messages(rows).orderBy("example_id").collect()
    for row, source in zip(back, [PLAIN, ODD, EMPTY, NULL]):
        assert row["question"] == source[2] and row["answer"] == source[3]
        assert row["context"].endswith("SCHEMA:\n" + source[1])


def test_short_conversation(spark):
    df = spark.createDataFrame(
        [(1, [("user", "hello")])],
        "example_id bigint, messages array<struct<role: string, content: string>>",
    )
    assert tuple(S.from_messages(df).first()) == (1, "hello", None, None)
    assert len(df.select(S.message_prefix("messages", 2)).first()[0]) == 1


def test_strip_markers(spark):
    raw = "a<start_of_turn>b<end_of_turn><end_of_turn>c<eos>"
    assert text(spark, S.strip_markers("c0"), raw) == "abc<eos>"
    assert text(spark, S.strip_markers("c0", ["<eos>"]), raw) == raw[:-5]


def test_cut_prompt_counts_code_points(spark):
    prompt = "naïve 😀😀 q"
    assert text(spark, S.cut_prompt("c0", "c1"), prompt + " answer 😀", prompt) == " answer 😀"
    assert text(spark, S.cut_prompt("c0", "c1"), "short", prompt) == ""
    assert text(spark, S.echo_ok("c0", "c1"), prompt + "x", prompt) is True
    assert text(spark, S.echo_ok("c0", "c1"), "x" + prompt, prompt) is False


EDGES = [
    "",
    " ",
    "a",
    " a ",
    "\t\na b\r\n",
    "\xa0 a \xa0",
    "\x1ca\x1f",
    "\x0ba\x0c",
    "​a​",
    "a \n",
    "\x85　a 　",
    "   ",
    "\xe9 \U0001f600 ",
]


@pytest.mark.parametrize("value", EDGES)
def test_strip_equals_python(spark, value):
    assert text(spark, S.py_strip("c0"), value) == value.strip()


def test_stop_and_cap(spark):
    assert text(spark, S.stop_at("c0", S.TURN_END), "a<end_of_turn>b<end_of_turn>") == "a"
    assert text(spark, S.stop_at("c0", S.TURN_END), "no marker") == "no marker"
    assert text(spark, S.cap_tokens("c0", 3), "select a, b") == "select a"
    assert text(spark, S.cap_tokens("c0", 99), "select a, b") == "select a, b"
    assert text(spark, S.cap_tokens("c0", 0), "select") == ""


def test_clean_generation_in_order(spark):
    prompt = "<start_of_turn>user\nq<end_of_turn> <start_of_turn>model\n"
    raw = prompt + "  SELECT 1 \n<end_of_turn>\nSELECT 2"
    assert text(spark, S.clean_generation("c0", "c1"), raw, prompt) == "SELECT 1"
    assert text(spark, S.clean_generation("c0", "c1", max_tokens=2), raw, prompt) == "SELECT"
    assert text(spark, S.clean_generation("c0", "c1"), None, prompt) is None


def test_nothing_leaves_the_jvm(ex):
    rendered = ex.select(
        S.py_strip(S.strip_markers(S.render_turns("context", "question", "answer")))
    )
    plan = rendered._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_null_messages(spark):
    df = spark.createDataFrame(
        [(1, None), (2, [("user", None)]), (3, [])],
        "example_id bigint, messages array<struct<role: string, content: string>>",
    )
    assert values(df, S.render_chatml("messages")) == [None, None, ""]
    assert values(df, F.size(S.message_prefix("messages", 1)))[1:] == [1, 0]
