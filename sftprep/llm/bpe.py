"""A byte-level BPE tokenizer read from a file of the ``tokenizers`` library.

``pre_tokens`` cuts a text where the tokenizer's own splitting always cuts: before a
space that a visible character follows.  No merge crosses such a border, so the ids of
a text are its parts' ids in a row, and a part has to be encoded once only.
"""

from __future__ import annotations

import array
import os
import re
from functools import lru_cache

#: Characters that count as visible for every version of the Unicode tables.
_VISIBLE = "!-~¡-¬®-ɏ"
_ODD = re.compile(f" (?![{_VISIBLE}])")
_CUT = re.compile(f" (?=[{_VISIBLE}])")
#: The tokenizer's splitting of parts made of visible characters and plain white space
#: (fixed values: letters and numbers among them).
_PLAIN = re.compile(f"[{_VISIBLE} \t\n\r]*")
_L, _N = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼-¾"
_PIECE = re.compile(
    f"'(?:s|t|re|ve|m|ll|d)| ?[{_L}]+| ?[{_N}]+| ?[^ \t\n\r{_L}{_N}]+|[ \t\n\r]+(?![^ \t\n\r])|[ \t\n\r]+"
)
#: Longer parts are encoded each time; the caches are emptied beyond so many entries.
LONGEST, MOST_PARTS, MOST_PIECES = 100, 700_000, 1_200_000


def pre_tokens(text: str, special: str) -> list[str] | None:
    """The parts, all but the first without the space before them.

    None if the text holds the string of a special token, which the tokenizer looks
    for before it splits.
    """
    if special and special in text:
        return None
    return text.split(" ") if _ODD.search(text) is None else _CUT.split(text)


class Encoder:
    """Ids as little-endian unsigned 32-bit integers, with a cache of parts."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        if len(specials) > 1:
            raise ValueError("files with one special token at most are supported")
        self.special = specials[0] if specials else ""
        self.parts: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def lengths(self, texts: list[str]) -> list[int]:
        """How many ids each text has."""
        return [len(x.ids) for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _bytes(self, texts: list[str]) -> list[bytes]:
        done = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array.array("I", x.ids).tobytes() for x in done]

    def _of_parts(self, parts: list[str]) -> list[bytes]:
        """Parts share pieces, as a word with and without a comma; these are encoded."""
        split = [_PIECE.findall(p) if _PLAIN.fullmatch(p) else [p] for p in parts]
        if len(self.pieces) > MOST_PIECES:
            self.pieces.clear()
        known = self.pieces
        new = list({x for pieces in split for x in pieces if x not in known})
        known.update(zip(new, self._bytes(new), strict=True))
        done = [b"".join([known[x] for x in pieces]) for pieces in split]
        for x in new:
            if len(x) > LONGEST:
                del known[x]
        return done

    def ids(self, text: str) -> bytes:
        parts = pre_tokens(text, self.special)
        if parts is None:
            return self._bytes([text])[0]
        known = self.parts
        first = parts[0]
        found = list(map(known.get, parts))
        found[0] = None  # the first part has no space before it
        missing = [i for i, x in enumerate(found) if x is None]
        new = list({parts[i] for i in missing[1:]})
        start, *made = self._of_parts([first, *[" " + p for p in new]])
        if missing[1:]:
            if len(known) > MOST_PARTS:
                known.clear()
            by_part = dict(zip(new, made, strict=True))
            for i in missing[1:]:
                found[i] = by_part[parts[i]]
            known.update((p, x) for p, x in by_part.items() if len(p) <= LONGEST)
        found[0] = start
        return b"".join(found)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder for each Python worker; its cache outlives the task."""
    return Encoder(path)
