"""Operator 2: token counts without token ids.

Texts are cut into pre-tokens (``sftprep.llm.bpe``); the pieces of each distinct
pre-token are counted once, and a document's count is the sum over its pre-tokens of
frequency times pieces (``sftprep.llm.terms``).  No ids are kept, and only pre-tokens
outside the most frequent ones are shuffled, one row for each task and pre-token.

A text with a special token's string in it is counted by the tokenizer as a whole: it
counts as one term, which is the text itself.

Defined results: a null or empty text has no bytes and no tokens; every row counts for
itself, so repeated rows and null keys each get their row.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sftprep.llm.bpe import encoder, pre_tokens
from sftprep.llm.common import released, stored, text_of
from sftprep.llm.terms import head_of, sums_of_rows, term_counts


def token_counts(
    docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", limit: int = 1024
) -> DataFrame:
    """Per row: key, n_bytes (UTF-8), n_tokens, over_limit (more than ``limit``).

    ``tokenizer`` is the path of a file of the ``tokenizers`` library, readable on
    every executor.
    """

    def split(value: str) -> list[str]:
        parts = pre_tokens(value, encoder(tokenizer).special)
        if parts is None:
            return [value]
        # in a term the space belongs to its part again; an empty text has no term
        return [*parts[:1], *[" " + p for p in parts[1:]]] if value else []

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = encoder(tokenizer).lengths(batch.column(0).to_pylist())
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(lengths, pa.int64())], ["term", "n", "value"]
            )

    rows = docs.select(
        F.col(key).alias("_key"), text_of(text).alias("_text"),
        F.octet_length(text_of(text)).cast("long").alias("n_bytes"),
    )
    counted = term_counts(rows, "_text", split, "string")
    table = stored(counted.mapInArrow(pieces, "term string, n long, value long"), "pre-tokens")
    head = head_of(table, "value")
    del counted
    released(docs.sparkSession)
    sums = sums_of_rows(rows, "_text", ["_key", "n_bytes"], split, table, head, "string")
    return sums.select(
        F.col("_key").alias(key), "n_bytes", F.col("total").cast("long").alias("n_tokens"),
        (F.col("total") > limit).alias("over_limit"),
    )
