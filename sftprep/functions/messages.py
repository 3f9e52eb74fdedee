"""Shaping rows between (context, question, answer) and chat messages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .templates import system_message


def _message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def to_messages(
    df: DataFrame, key: str = "example_id", keep: Sequence[str] = ()
) -> DataFrame:
    """Triple to a system, user and assistant message.  The input columns are
    dropped but for the key and those in ``keep``."""
    messages = F.array(
        _message("system", system_message("context")),
        _message("user", F.col("question")),
        _message("assistant", F.col("answer")),
    )
    return df.select(key, *keep, messages.alias("messages"))


def message_content(messages: Column | str, position: int) -> Column:
    """Content of the message at a 0-based position; null when out of range."""
    return F.get(messages, F.lit(position))["content"]


def from_messages(df: DataFrame, key: str = "example_id") -> DataFrame:
    """Conversation to triple by position.  ``context`` is the whole rendered
    system text, not the raw schema."""
    return df.select(
        key,
        message_content("messages", 0).alias("context"),
        message_content("messages", 1).alias("question"),
        message_content("messages", 2).alias("answer"),
    )


def message_prefix(messages: Column | str, k: int) -> Column:
    """The first k messages."""
    return F.slice(messages, 1, k)
