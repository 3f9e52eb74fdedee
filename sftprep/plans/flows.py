"""The end-to-end flows, put together from the operators."""

from __future__ import annotations

from collections.abc import Callable
from typing import Literal

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.cleanup import clean_generation
from ..functions.messages import message_prefix, to_messages
from ..functions.templates import (
    CHATML_END,
    CHATML_START,
    TURN_END,
    TURN_START,
    escape_quotes,
    render_chatml,
    render_sections,
    render_turns,
)
from ..functions.tokens import (
    Side,
    add_labels,
    append_eos,
    pad,
    prepend_bos,
    tokenize,
    truncate,
    truncate_with_eos,
    was_truncated,
)
from ..operators.batches import Predictor, Tokenizer, predict_batches, tokenize_batches
from ..operators.keys import Key, key_columns
from ..operators.packing import pack
from ..operators.sampling import sample_n, train_test_split
from ..operators.scoring import accuracy, exact_match
from ..operators.vocabulary import encode
from ..sources.scratch import settle
from ..sources.tables import SPLIT, write_jsonl

Style = Literal["turns", "sections", "chatml"]
#: Markers of each style's texts; the last one ends an answer.
MARKERS = {
    "turns": (TURN_START, TURN_END),
    "sections": (TURN_START, TURN_END),
    "chatml": (CHATML_START, CHATML_END),
}


def create_dataset(
    table: DataFrame,
    n: int,
    test_size: float | int,
    seed: int | str,
    key: str = "example_id",
    messages: bool = False,
    path: str | None = None,
) -> DataFrame:
    """Sample n examples and split them exactly; with ``messages`` as chat
    conversations.  Given a path, also write the splits as JSON lines.

    The sample is written to the shared folder first: the split then reads that
    and not the whole table again."""
    sample = settle(sample_n(table, key, n, seed, ordered=False))
    splits = train_test_split(sample, key, test_size, seed)
    if messages:
        splits = to_messages(splits, key, keep=[SPLIT])
    if path is not None:
        write_jsonl(splits, path)
    return splits


def training_text(style: Style = "turns") -> Column:
    """Whole training text of an example; chatml reads a ``messages`` column."""
    if style == "turns":
        return render_turns("context", "question", "answer")
    if style == "sections":
        fields = (escape_quotes(c) for c in ("context", "question", "answer"))
        return render_sections(*fields)
    if style == "chatml":
        return render_chatml("messages")
    raise ValueError(f"unknown style {style!r}")


def prompt_text(style: Style = "turns") -> Column:
    """The prompt of an example, up to where the answer begins; chatml reads the
    ``messages`` column without its answer."""
    if style == "sections":
        fields = (escape_quotes(c) for c in ("context", "question"))
        return render_sections(*fields, F.lit(""))
    if style == "chatml":
        return render_chatml(message_prefix("messages", 2), open_turn=True)
    if style == "turns":
        return render_turns("context", "question")
    raise ValueError(f"unknown style {style!r}")


def encoded_texts(
    examples: DataFrame,
    vocab: DataFrame | Callable[[], Tokenizer],
    key: Key = "example_id",
    style: Style = "turns",
    unknown: int | None = None,
    eos: int | None = None,
    bos: int | None = None,
) -> DataFrame:
    """Render and encode: the key and ``input_ids`` of full length.

    ``vocab`` is a vocabulary table for the built-in tokenizer, or a factory of the
    user's own tokenizer (see :func:`tokenize_batches`), which gives the ids itself.
    """
    if isinstance(vocab, DataFrame):
        tokens = tokenize(training_text(style)).alias("input_ids")
        rows = examples.select(*key_columns(key), tokens)
        ids = encode(rows, vocab, "input_ids", "input_ids", unknown)
    else:
        texts = examples.select(*key_columns(key), training_text(style).alias("input_ids"))
        ids = tokenize_batches(texts, vocab, "input_ids", "input_ids")
    if bos is not None:
        ids = ids.withColumn("input_ids", prepend_bos("input_ids", bos))
    return ids if eos is None else ids.withColumn("input_ids", append_eos("input_ids", eos))


def training_rows(
    encoded: DataFrame,
    length: int,
    pad_id: int | None = None,
    truncation_side: Side = "right",
    padding_side: Side = "right",
    ignore_index: int | None = None,
    keep_eos: int | None = None,
) -> DataFrame:
    """One training row per example: cut to ``length`` and, given a pad id,
    padded to it with mask and labels.  No shuffle.  With ``keep_eos`` a row cut on
    the right ends with that id."""
    cut = truncate("input_ids", length, truncation_side)
    if keep_eos is not None and truncation_side == "right":
        ended = truncate_with_eos("input_ids", length, keep_eos)
        cut = F.when(was_truncated("input_ids", length), ended).otherwise(cut)
    rows = encoded.withColumns(
        {"was_truncated": was_truncated("input_ids", length), "input_ids": cut}
    )
    if pad_id is None:
        return rows
    return add_labels(pad(rows, length, pad_id, padding_side), ignore_index)


def training_blocks(
    encoded: DataFrame,
    length: int,
    seed: int | str,
    key: Key = "example_id",
    sep: int | None = None,
) -> DataFrame:
    """Training rows of exactly ``length`` ids, packed from all examples."""
    return add_labels(pack(encoded, key, length, seed, sep))


def scored_predictions(
    examples: DataFrame,
    factory: Callable[[], Predictor],
    max_tokens: int | None = None,
    batch_size: int = 64,
    normalize: bool = False,
    style: Style = "turns",
) -> DataFrame:
    """Examples with the prompt, the cleaned prediction and its 0/1 score.

    The predictor is given the prompt alone.  Its output has to begin with the prompt
    and ends at the style's end marker; ``chatml`` reads a ``messages`` column."""
    prompts = examples.withColumn("prompt", prompt_text(style))
    raw = predict_batches(prompts, factory, batch_size=batch_size)
    markers = MARKERS[style]
    cleaned = raw.withColumn(
        "prediction", clean_generation("raw", "prompt", max_tokens, markers[-1], markers)
    )
    return cleaned.drop("raw").withColumn("score", exact_match("prediction", "answer", normalize))


def evaluate(
    examples: DataFrame,
    factory: Callable[[], Predictor],
    n: int,
    seed: int | str,
    key: Key = "example_id",
    by: str | None = None,
    max_tokens: int | None = None,
    batch_size: int = 64,
    normalize: bool = False,
    style: Style = "turns",
) -> DataFrame:
    """Accuracy of a predictor over n sampled examples.

    The sample is dealt over all cores, for the predictor is the costly step."""
    sample = sample_n(examples, key, n, seed, ordered=False)
    cores = examples.sparkSession.sparkContext.defaultParallelism
    dealt = sample.repartition(cores, *key_columns(key))
    return accuracy(
        scored_predictions(dealt, factory, max_tokens, batch_size, normalize, style), by
    )
