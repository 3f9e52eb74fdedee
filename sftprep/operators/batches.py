"""User functions over batches of rows.

These are the only places where rows cross to Python, in Arrow batches.  A
function sees plain Python lists, batches have the size asked for whatever the
Arrow batch size of the session, and columns that are kept but not read by the
function stay in Arrow form.  Rows are not moved between partitions.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import (
    ArrayType,
    DataType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

# Executors need not have this package: its functions are sent with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__.partition(".")[0]])

Batch = dict[str, list]
Predictor = Callable[[list[str]], list[str]]
Tokenizer = Callable[[list[str]], list[list[int]]]


def map_batches(
    df: DataFrame,
    fn: Callable[[dict], dict],
    schema: str | StructType,
    batch_size: int = 1000,
    batched: bool = True,
    drop: Sequence[str] = (),
    inputs: Sequence[str] | None = None,
) -> DataFrame:
    """Map a function over rows or batches and merge what it returns.

    ``fn`` gets a dict of lists (with ``batched=False`` a dict of values for each
    row) and returns one with the columns of ``schema``; these are added to the
    row or take the place of a column of that name.  Columns in ``drop`` are
    removed.  A batch may come back with another number of rows when all input
    columns are dropped or replaced.  ``inputs`` limits what the function is
    given; where all others are dropped, only these are read from the source.
    """
    if batch_size < 1:
        raise ValueError("batch_size must be positive")
    new = _struct(df, schema)
    given = list(inputs) if inputs is not None else df.columns
    kept = [c for c in df.columns if c not in drop and c not in new.names]
    source = df.select(*[c for c in df.columns if c in kept or c in given])
    output = StructType([df.schema[c] for c in kept] + list(new.fields))
    arrow_new = to_arrow_schema(new)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _rebatched(batches, batch_size):
            values = table.select(given).to_pydict()
            if batched:
                made = fn(values)
            else:
                rows = [fn(dict(zip(values, row))) for row in zip(*values.values())]
                made = {name: [row[name] for row in rows] for name in new.names}
            fresh = [pa.array(made[f.name], type=f.type) for f in arrow_new]
            if len({len(a) for a in fresh} | ({table.num_rows} if kept else set())) > 1:
                raise ValueError(
                    "the function changed the number of rows; drop the input columns"
                )
            arrays = [table.column(c) for c in kept] + fresh
            yield from pa.table(arrays, names=kept + new.names).to_batches()

    return source.mapInArrow(run, output)


def format_batches(
    df: DataFrame, fn: Callable[[Batch], list[str]], batch_size: int = 1000
) -> DataFrame:
    """One ``text`` column from a function that turns a batch into a list of
    texts, not necessarily one for each row.  Select the columns it reads first."""
    return map_batches(
        df, lambda batch: {"text": list(fn(batch))}, "text string", batch_size, drop=df.columns
    )


def predict_batches(
    df: DataFrame,
    factory: Callable[[], Predictor],
    prompt_col: str = "prompt",
    out: str = "raw",
    batch_size: int = 64,
) -> DataFrame:
    """Add the raw text a predictor gives for each prompt.

    ``factory`` builds the predictor, once per partition and on the executor, so
    a model is loaded there and never pickled.  It maps a list of prompts to a
    list of texts of the same length.
    """
    return _made_by(
        df, factory, prompt_col, out, StringType(), batch_size, "{} predictions for {} prompts"
    )


def tokenize_batches(
    df: DataFrame,
    factory: Callable[[], Tokenizer],
    text_col: str = "text",
    out: str = "input_ids",
    batch_size: int = 1000,
) -> DataFrame:
    """Add the ids that a tokenizer of the user's gives for each text.

    ``factory`` builds the tokenizer once per partition and on the executor.  It maps a
    list of texts (None among them, if the column has nulls) to as many lists of ids.
    """
    return _made_by(
        df, factory, text_col, out, ArrayType(IntegerType()), batch_size, "{} id lists for {} texts"
    )


def _made_by(
    df: DataFrame,
    factory: Callable[[], Callable[[list], list]],
    column: str,
    out: str,
    kind: DataType,
    batch_size: int,
    mismatch: str,
) -> DataFrame:
    """Add a column that a function, built once per partition, makes of another."""
    if batch_size < 1:
        raise ValueError("batch_size must be positive")
    kept = [c for c in df.columns if c != out]
    source = df.select(*dict.fromkeys([*kept, column]))
    output = StructType([df.schema[c] for c in kept] + [StructField(out, kind)])
    arrow_kind = to_arrow_schema(StructType([StructField(out, kind)])).field(0).type

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = None
        for table in _rebatched(batches, batch_size):
            if function is None:
                function = factory()
            given = table.column(column).to_pylist()
            made = list(function(given))
            if len(made) != len(given):
                raise ValueError(mismatch.format(len(made), len(given)))
            arrays = [table.column(c) for c in kept] + [pa.array(made, type=arrow_kind)]
            yield from pa.table(arrays, names=[*kept, out]).to_batches()

    return source.mapInArrow(run, output)


def _struct(df: DataFrame, schema: str | StructType) -> StructType:
    return schema if isinstance(schema, StructType) else StructType.fromDDL(schema)


def _rebatched(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    """The same rows in tables of ``size`` rows, the last one shorter.  At most
    one Arrow batch and one batch of ``size`` rows are held at a time."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        at = 0
        while rows + batch.num_rows - at >= size:
            take = size - rows
            held.append(batch.slice(at, take))
            yield pa.Table.from_batches(held)
            held, rows, at = [], 0, at + take
        if at < batch.num_rows:
            held.append(batch.slice(at))
            rows += batch.num_rows - at
    if held:
        yield pa.Table.from_batches(held)
