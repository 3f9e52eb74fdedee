"""Row keys and the seeded random order they give.

The order of a "random" operation is the order of a salted hash of the row key.
It depends on the seed and the keys alone: not on the number of partitions, not
on retries.  The key must tell rows apart; :func:`with_row_key` makes one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DataType, IntegralType, MapType, StructType

from ..functions.tokens import join_ids
from ..sources.scratch import settle

Key = str | Sequence[str]

COPIES_PER_CHUNK = 100_000


def key_columns(key: Key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def order_hash(key: Key, seed: int | str) -> Column:
    """md5 of the seed and the key: the sort value of the seeded order."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in key_columns(key)]
    return F.md5(F.concat(F.lit(f"{seed}:"), F.concat_ws("\x1f", *parts)))


def row_hash(df: DataFrame) -> Column:
    """md5 of a row's whole content.

    JSON keeps names and nulls apart but shortens timestamps; the second hash is taken
    from the values as they are, to the microsecond and to the last bit of a float.
    Maps count as their entries in the order of the keys, so equal maps are equal here
    however they were built.
    """
    columns = [_comparable(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema]
    hashed = [
        c for c, f in zip(columns, df.schema, strict=True) if f.dataType.typeName() != "variant"
    ]
    exact = F.xxhash64(*hashed).cast("string") if hashed else F.lit("")
    return F.md5(F.concat(F.to_json(F.struct(*columns)), F.lit("\x1f"), exact))


def _comparable(value: Column, kind: DataType) -> Column:
    """The value with sorted lists of entries in the place of maps, at any depth."""
    if not _has_map(kind):
        return value
    if isinstance(kind, ArrayType):
        return F.transform(value, lambda x: _comparable(x, kind.elementType))
    if isinstance(kind, StructType):
        fields = [_comparable(value[f.name], f.dataType).alias(f.name) for f in kind]
        return F.when(value.isNotNull(), F.struct(*fields))

    def entry(e: Column) -> Column:
        return F.struct(
            _comparable(e["key"], kind.keyType).alias("key"),
            _comparable(e["value"], kind.valueType).alias("value"),
        )

    return F.array_sort(F.transform(F.map_entries(value), entry))


def _has_map(kind: DataType) -> bool:
    if isinstance(kind, ArrayType):
        return _has_map(kind.elementType)
    if isinstance(kind, StructType):
        return any(_has_map(f.dataType) for f in kind)
    return isinstance(kind, MapType)


def seeded_order(df: DataFrame, key: Key, seed: int | str) -> list[Column]:
    """What the seeded order sorts by: the hash of the key, then the content of rows that
    share one.  Rows that are equal in both are copies of one row."""
    only_key = set(df.columns) <= set(key_columns(key))
    return [order_hash(key, seed), *([] if only_key else [row_hash(df)])]


def repeat_rows(df: DataFrame, copies: str, number: str) -> DataFrame:
    """Each row as often as its ``copies`` column says, numbered from 1.

    A row with very many copies is spread over tasks in chunks.
    """
    rest = [c for c in df.columns if c != copies]
    few = df.filter(F.col(copies) <= COPIES_PER_CHUNK).select(
        *rest, F.explode(F.sequence(F.lit(1), F.col(copies))).alias(number)
    )
    starts = F.sequence(F.lit(1), F.col(copies), F.lit(COPIES_PER_CHUNK))
    chunks = df.filter(F.col(copies) > COPIES_PER_CHUNK).select(
        *df.columns, F.explode(starts).alias("_first")
    )
    last = F.least(F.col("_first") + (COPIES_PER_CHUNK - 1), F.col(copies))
    many = chunks.repartition("_first", *rest).select(
        *rest, F.explode(F.sequence(F.col("_first"), last)).alias(number)
    )
    return few.unionByName(many)


def with_row_key(df: DataFrame, name: str = "example_id") -> DataFrame:
    """Add a string key to a table that has none: content hash and copy number.

    Equal rows are counted (partly before the shuffle, so a row that makes up a
    third of the table is no hot spot) and then written out again once per copy.
    """
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    key = F.concat_ws(":", row_hash(df), F.col("_copy").cast("string"))
    return repeat_rows(counted, "_copies", "_copy").select(key.alias(name), *df.columns)


def with_content_hash(df: DataFrame, column: str, name: str, kept: Column | None = None) -> DataFrame:
    """``df`` and the md5 of an array of ids, written to the shared folder on the call; with
    ``kept`` that is written in place of the array."""
    integers = isinstance(df.schema[column].dataType.elementType, IntegralType)
    joined = join_ids(column) if integers else F.array_join(column, ",")
    return settle(df.withColumns({name: F.md5(joined), column: F.col(column) if kept is None else kept}))
