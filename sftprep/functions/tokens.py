"""Token and id arrays, as column expressions.

The built-in tokenizer is lossless: runs of word characters, runs of blanks and
single other characters.  Joining the tokens gives the text back.  Another
tokenizer is brought in through ``map_batches``.
"""

from __future__ import annotations

from typing import Literal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from .templates import _col

Side = Literal["left", "right"]

# The last branch takes the single characters that the first two do not.
TOKEN_PATTERN = r"(?s)[A-Za-z0-9_]+|[ \t\n\r\f]+|."


def _check_side(side: str) -> None:
    if side not in ("left", "right"):
        raise ValueError(f"side must be 'left' or 'right', not {side!r}")


# What a byte of UTF-8 belongs to: a character of its own, a run of word characters or blanks,
# or the character before it.
_SINGLE, _WORD, _BLANK, _REST = range(4)
_KINDS = np.full(256, _SINGLE, np.uint8)
_KINDS[0x80:0xC0] = _REST
_KINDS[list(b" \t\n\r\f")] = _BLANK
_KINDS[[*range(48, 58), *range(65, 91), 95, *range(97, 123)]] = _WORD
# Bytes that are looked at at once.
_STRETCH = 1 << 22


def _token_arrays(texts: pa.Array) -> pa.Array:
    """The tokens of ``TOKEN_PATTERN``, as places in the texts' own bytes."""
    nulls = texts.is_null().to_numpy(zero_copy_only=False)
    texts = pa.concat_arrays([texts.fill_null("")]).cast(pa.string())
    if not len(texts):
        return pa.array([], pa.list_(pa.string()))
    ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2] or pa.py_buffer(b"")
    used = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]]
    begins = (ends[:-1] - ends[0])[np.diff(ends) > 0]  # a token begins with each text
    starts, before = [np.zeros(0, np.int64)], _REST
    for first in range(0, len(used), _STRETCH):
        kinds = _KINDS[used[first : first + _STRETCH]]
        new = (np.diff(kinds, prepend=before) != 0) | (kinds == _SINGLE)
        new &= kinds != _REST
        new[begins[np.searchsorted(begins, first) : np.searchsorted(begins, first + _STRETCH)] - first] = True
        before = kinds[-1]
        starts.append(np.flatnonzero(new) + (first + ends[0]))
    places = np.concatenate([*starts, ends[-1:]]).astype(np.int32)
    tokens = pa.Array.from_buffers(pa.string(), len(places) - 1, [None, pa.py_buffer(places), data])
    rows = np.searchsorted(places, ends).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(rows), tokens, mask=pa.array(nulls))


def tokenize(text: Column | str, in_batches: bool = False) -> Column:
    """Text to an array of tokens.

    With ``in_batches`` they are found in the bytes of a batch of texts at once, in Python:
    the same tokens at less cost, best where a Python function goes on with them.
    """
    if in_batches:
        return F.arrow_udf(_token_arrays, "array<string>")(_col(text))
    return F.regexp_extract_all(_col(text), F.lit(TOKEN_PATTERN), F.lit(0))


def _joined_ids(ids: pa.Array) -> pa.Array:
    """Each row's ids as text, without nulls, put together with commas."""
    values = ids.flatten()
    sizes = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
    ends = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    if values.null_count:
        known = np.concatenate([[0], np.cumsum(values.is_valid().to_numpy(zero_copy_only=False))])
        ends, values = known[ends], values.drop_null()
    texts = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values.cast(pa.string()))
    return pc.if_else(pc.is_null(ids), None, pc.binary_join(texts, ","))


def join_ids(ids: Column | str) -> Column:
    """Integers as text with commas between them, as ``array_join`` gives it: in batches, as
    the cast of each element costs more than the rest of a row's work."""
    return F.arrow_udf(_joined_ids, "string")(_col(ids))


def append_eos(ids: Column | str, eos: int) -> Column:
    """Ids with the end-of-sequence id at the end."""
    return F.array_append(_col(ids), F.lit(eos).cast("int"))


def prepend_bos(ids: Column | str, bos: int) -> Column:
    """Ids with the start-of-sequence id before them."""
    return F.array_prepend(_col(ids), F.lit(bos).cast("int"))


def truncate_with_eos(ids: Column | str, length: int, eos: int) -> Column:
    """At most ``length`` ids of which the last is the end-of-sequence id: it is put
    behind the ids that have room, where :func:`truncate` would cut it off."""
    return append_eos(F.slice(_col(ids), 1, length - 1), eos)


def truncate(ids: Column | str, length: int, side: Side = "right") -> Column:
    """At most ``length`` ids.  ``side`` is the side that is cut off: ``right``
    keeps the head, ``left`` keeps the tail."""
    _check_side(side)
    ids = _col(ids)
    if side == "right":
        return F.slice(ids, 1, length)
    return F.slice(ids, F.greatest(F.lit(1), F.size(ids) - length + 1), F.lit(length))


def was_truncated(ids: Column | str, length: int) -> Column:
    """Whether :func:`truncate` to ``length`` drops anything."""
    return F.size(_col(ids)) > length


def _padded(body: Column, fill: Column, side: Side) -> Column:
    _check_side(side)
    return F.concat(body, fill) if side == "right" else F.concat(fill, body)


def pad_ids(ids: Column | str, length: int, pad_id: int, side: Side = "right") -> Column:
    """Ids filled up to ``length``; longer arrays stay as they are."""
    ids = _col(ids)
    fill = F.array_repeat(F.lit(pad_id).cast("int"), F.lit(length) - F.size(ids))
    return _padded(ids, fill, side)


def attention_mask(ids: Column | str, length: int, side: Side = "right") -> Column:
    """1 for each id and 0 for each place that :func:`pad_ids` fills."""
    ids = _col(ids)
    ones = F.array_repeat(F.lit(1), F.size(ids))
    return _padded(F.when(ids.isNotNull(), ones), F.array_repeat(F.lit(0), F.lit(length) - F.size(ids)), side)


def pad(
    df: DataFrame, length: int, pad_id: int, side: Side = "right", column: str = "input_ids"
) -> DataFrame:
    """Pad ``column`` and add its ``attention_mask``."""
    return df.withColumns(
        {
            column: pad_ids(column, length, pad_id, side),
            "attention_mask": attention_mask(column, length, side),
        }
    )


def add_labels(df: DataFrame, ignore_index: int | None = None) -> DataFrame:
    """``labels`` as a copy of ``input_ids``.  With ``ignore_index`` the padded
    places (mask 0) get that value, also where the pad id equals a real id."""
    if ignore_index is None:
        return df.withColumn("labels", F.col("input_ids"))
    ignored = F.lit(ignore_index).cast("int")
    labels = F.zip_with(
        "input_ids", "attention_mask", lambda i, m: F.when(m == 0, ignored).otherwise(i)
    )
    return df.withColumn("labels", labels)
