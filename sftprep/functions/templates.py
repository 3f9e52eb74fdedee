"""Prompt texts as column expressions.

Every template is a ``concat`` of literals and columns, so a ``%`` or a brace in
the data is only text, and the whole rendering stays inside generated code.  A
null field makes the rendered text null.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Texts that the rendered prompts must match byte for byte.
SYSTEM_PREFIX = (
    "You are an text to SQL query translator. Users will ask you questions in English "
    "and you will generate a SQL query based on the provided SCHEMA.\nSCHEMA:\n"
)
TURN_START = "<start_of_turn>"
TURN_END = "<end_of_turn>"
TURN_CONTEXT = "user\nCONTEXT:"
TURN_QUESTION = "\nQUESTION:"
TURN_MODEL = "model\n"
SECTION_CONTEXT = (
    "###System:\nRead the references provided and answer the corresponding question.\n"
    "###Context:\n"
)
SECTION_QUESTION = "\n###Question:\n"
SECTION_ANSWER = "\n###Answer:\n"
CHATML_START = "<|im_start|>"
CHATML_END = "<|im_end|>"
# End of fixed values.


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def system_message(context: Column | str) -> Column:
    """System text with the schema text placed at its end."""
    return F.concat(F.lit(SYSTEM_PREFIX), _col(context))


def render_turns(
    context: Column | str, question: Column | str, answer: Column | str | None = None
) -> Column:
    """Turn-marker text: a prompt with an open model turn, or with an answer the
    whole training text.  The two turns are separated by one space."""
    parts = [
        F.lit(TURN_START + TURN_CONTEXT),
        _col(context),
        F.lit(TURN_QUESTION),
        _col(question),
        F.lit(f"{TURN_END} {TURN_START}{TURN_MODEL}"),
    ]
    if answer is not None:
        parts += [_col(answer), F.lit(TURN_END)]
    return F.concat(*parts)


def render_sections(
    context: Column | str, question: Column | str, answer: Column | str
) -> Column:
    """Sectioned instruction text.  Quotes are escaped by the caller, see
    :func:`escape_quotes`."""
    return F.concat(
        F.lit(SECTION_CONTEXT),
        _col(context),
        F.lit(SECTION_QUESTION),
        _col(question),
        F.lit(SECTION_ANSWER),
        _col(answer),
    )


def escape_quotes(text: Column | str) -> Column:
    """Put a backslash before every double quote (literal, no pattern)."""
    return F.replace(_col(text), F.lit('"'), F.lit('\\"'))


def render_chatml(messages: Column | str, open_turn: bool = False) -> Column:
    """ChatML text of a conversation; ``open_turn`` adds an open assistant turn."""
    messages = _col(messages)
    texts = F.transform(
        messages,
        lambda m: F.concat(
            F.lit(CHATML_START),
            m["role"],
            F.lit("\n"),
            m["content"],
            F.lit(f"{CHATML_END}\n"),
        ),
    )
    # array_join passes over nulls; a message without role or content makes all null
    incomplete = F.exists(messages, lambda m: m["role"].isNull() | m["content"].isNull())
    body = F.when(~incomplete, F.array_join(texts, ""))
    return F.concat(body, F.lit(f"{CHATML_START}assistant\n")) if open_turn else body
