"""Cleaning generated text, as column expressions.

Order matters when the raw text still has its markers: cut the prompt first (it
holds the end marker itself), then stop, cap, strip the markers and trim.  When
the markers were dropped while decoding, cut by the marker-free prompt instead:
``cut_prompt(raw, strip_markers(prompt))``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from .templates import TURN_END, TURN_START, _col
from .tokens import tokenize

# The characters that count as whitespace when trimming both ends.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# End of fixed values.


def strip_markers(
    text: Column | str, markers: Sequence[str] = (TURN_START, TURN_END)
) -> Column:
    """Delete every occurrence of the markers (literal text), one after another."""
    text = _col(text)
    for marker in markers:
        text = F.replace(text, F.lit(marker), F.lit(""))
    return text


def cut_prompt(raw: Column | str, prompt: Column | str) -> Column:
    """Drop as many characters (code points) as the prompt has."""
    return F.substr(_col(raw), F.char_length(_col(prompt)) + 1)


def echo_ok(raw: Column | str, prompt: Column | str) -> Column:
    """Whether the raw text really starts with the prompt that will be cut."""
    return F.startswith(_col(raw), _col(prompt))


def stop_at(text: Column | str, marker: str) -> Column:
    """The text before the first marker, or all of it without one."""
    return F.substring_index(_col(text), marker, 1)


def cap_tokens(text: Column | str, k: int) -> Column:
    """The first k tokens of the text."""
    return F.array_join(F.slice(tokenize(text), 1, k), "")


def py_strip(text: Column | str) -> Column:
    """Trim all Unicode whitespace on both ends; ``trim`` alone drops only spaces."""
    return F.btrim(_col(text), F.lit(WHITESPACE))


def clean_generation(
    raw: Column | str,
    prompt: Column | str,
    max_tokens: int | None = None,
    stop: str = TURN_END,
    markers: Sequence[str] = (TURN_START, TURN_END),
) -> Column:
    """All steps in order, for raw text that still has its markers."""
    text = stop_at(cut_prompt(raw, prompt), stop)
    if max_tokens is not None:
        text = cap_tokens(text, max_tokens)
    return py_strip(strip_markers(text, markers))
