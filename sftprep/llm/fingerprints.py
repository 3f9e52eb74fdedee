"""Operator 6: Merkle-tree fingerprints of texts.

A text is cut into sections, paragraphs (lines) and clauses, at points that depend
on the text alone:

* a paragraph ends at every newline;
* a section ends after a paragraph whose hash is a multiple of four, so that added or
  removed paragraphs move no section border but their own;
* a leaf is a clause: it ends after one of ``. ! ? , ; :`` before a space.

A leaf's hash is 64 bits, a paragraph's hashes its leaves' hashes, a section's its
paragraphs', and the root is the SHA-256 of all of it.  The fingerprint is the tree as
text: ``root|section;section;...`` with a section as ``hash=paragraph,paragraph,...``
and a paragraph as ``hash:leaf.leaf. ...``, hashes in hex, shortened to 8 digits below
the root.  Equal texts have equal fingerprints; two texts differ in the branches whose
hashes differ (``changed_branches``), without a look at the texts.

``likeness`` of two fingerprints is 1 if the roots are equal, otherwise the share of
common nodes among all nodes of both trees (Jaccard, nodes as sets).

Everything is DataFrame functions.  Defined results: a null text counts as empty; the
empty text has one empty leaf.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sftprep.llm.common import stored, text_of


def fingerprint(text: str | Column) -> Column:
    """The Merkle tree of a text column as one string."""
    text = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))

    def digest(*parts: Column) -> Column:
        return F.lower(F.lpad(F.hex(F.xxhash64(*parts)), 16, "0"))

    def paragraph(line: Column) -> Column:
        leaves = F.transform(F.split(line, r"(?<=[.!?,;:])(?=\x20)"), lambda s: digest(s))
        joined = F.array_join(leaves, ".")
        return F.concat(digest(joined), F.lit(":"), joined)

    # the full hashes first; ``#`` marks the end of a section
    paragraphs = F.transform(F.split(text, "\n"), paragraph)
    full = F.array_join(
        F.transform(
            paragraphs,
            lambda p: F.concat(p, F.when(p.rlike("^.{15}[048c]"), F.lit("#")).otherwise(F.lit(","))),
        ),
        "",
    )
    sections = F.transform(
        F.filter(F.split(full, "#"), lambda s: s != ""),
        lambda s: F.concat(F.substring(digest(s), 1, 8), F.lit("="), F.rtrim(s, F.lit(","))),
    )
    short = F.regexp_replace(
        F.array_join(sections, ";"), "([0-9a-f]{8})[0-9a-f]{8}", "$1"
    )
    return F.concat(F.sha2(F.concat(full, F.lit("/"), F.length(text)), 256), F.lit("|"), short)


def nodes(print_: str | Column) -> Column:
    """The hashes of a fingerprint's sections, paragraphs and leaves, each once."""
    tree = F.substring_index(print_, "|", -1)
    return F.array_distinct(F.split(tree, "[;=,:.]"))


def likeness(one: Column, other: Column, one_nodes: Column, other_nodes: Column) -> Column:
    """Share of common nodes of two fingerprints, 1 if and only if they are equal."""
    common = F.size(F.array_intersect(one_nodes, other_nodes))
    every = F.size(one_nodes) + F.size(other_nodes) - common
    # trees of the same nodes in another order, or with repeats, aren't equal
    shared = F.least(common / F.greatest(every, F.lit(1)), every / (every + 1.0))
    return F.when(one == other, F.lit(1.0)).otherwise(shared)


def changed_branches(one: Column, other: Column) -> Column:
    """Where the first text's tree differs: (section, paragraph) numbers from 0.

    Sections whose hash the other tree has are skipped whole, and so are paragraphs.
    """
    own = F.split(F.substring_index(one, "|", -1), ";")
    there = nodes(other)

    def of_section(section: Column, i: Column) -> Column:
        paragraphs = F.split(F.substring_index(section, "=", -1), ",")
        found = F.transform(
            paragraphs,
            lambda p, j: F.when(
                ~F.array_contains(there, F.substring_index(p, ":", 1)),
                F.struct(i.alias("section"), j.alias("paragraph")),
            ),
        )
        return F.when(
            F.array_contains(there, F.substring_index(section, "=", 1)), F.array()
        ).otherwise(F.filter(found, lambda x: x.isNotNull()))

    return F.flatten(F.transform(own, of_section))


def neighbours(keys: DataFrame, order: list[Column]) -> DataFrame:
    """Each row of ``keys`` with the rows before and after it in a total order.

    Adds ``prev`` and ``next`` (structs of the row); the order is a ring.  Keys are
    dealt out by range; inside a range a window finds the neighbours, and the ranges'
    first and last rows, one row for each range, close the gaps.
    """
    names = keys.columns
    ranged = stored(
        keys.repartitionByRange(*order).select("*", F.spark_partition_id().alias("_range")),
        "key-ranges",
    )
    row = F.struct(*names)
    from pyspark.sql import Window

    inside = Window.partitionBy("_range").orderBy(*order)
    near = ranged.select(
        "*",
        F.lag(row).over(inside).alias("_prev"),
        F.lead(row).over(inside).alias("_next"),
        F.row_number().over(inside).alias("_n"),
    )
    # one row for each range: a bounded table, whatever the number of keys
    ends = near.groupBy("_range").agg(
        F.max(F.when(F.col("_prev").isNull(), row)).alias("_first"),
        F.max(F.when(F.col("_next").isNull(), row)).alias("_last"),
    )
    ring = Window.orderBy("_range")
    whole = ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    gaps = ends.select(
        "_range",
        F.coalesce(F.lead("_first").over(ring), F.first("_first").over(whole)).alias("_after"),
        F.coalesce(F.lag("_last").over(ring), F.last("_last").over(whole)).alias("_before"),
    )
    joined = near.join(F.broadcast(gaps), "_range")
    return joined.select(
        *names,
        F.coalesce("_prev", "_before").alias("prev"),
        F.coalesce("_next", "_after").alias("next"),
    )


def with_edited_half(
    docs: DataFrame, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Fingerprints of every text, of an edited one, and how alike they are.

    The edited text has its last half replaced by the beginning of the next document
    in descending key order (nulls last; the last one takes the first).  Rows of equal
    key are ordered by their text's MD5, downwards; equal rows follow one another, so
    all but the last of them have their own text as the next.

    Equal rows are one row with a count until the end.  Whole texts are shuffled once,
    and once more the part that goes to another row.
    """
    rows = docs.select(F.struct(F.col(key).alias("k"), text_of(text).alias("t")).alias("_row"))
    # one key that is never null, so that grouping and joins share their partitions
    rows = rows.withColumn("_h", F.md5(F.concat_ws("|", F.col("_row.k").cast("string"), F.col("_row.t"))))
    keys = rows.groupBy("_h").agg(
        F.first("_row.k").alias("_k"), F.first(F.length("_row.t")).alias("n_chars")
    )
    ring = neighbours(keys, [F.col("_k").desc_nulls_last(), F.col("_h").desc()])
    ring = ring.select(
        "_h", F.col("prev._h").alias("_to"), F.expr("prev.n_chars div 2").alias("_half")
    )
    # both uses below read the same columns, so that the texts are shuffled once for both
    texts = rows.groupBy("_h").agg(F.first("_row").alias("_row"), F.count("*").alias("_copies"))
    texts = texts.where("_copies > 0").withColumn("_fp", fingerprint("_row.t"))
    # what each text gives to the one before it: its beginning and its fingerprint
    given = texts.join(ring, "_h").select(
        F.col("_to").alias("_h"),
        F.expr("substring(_row.t, 1, cast(_half as int))").alias("_head"),
        F.col("_fp").alias("_next_fp"),
    )
    paired = texts.join(given, "_h").select(
        "*",
        F.col("_row.k").alias("_k"),
        F.col("_row.t").alias("_t"),
        F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))).alias("_copy"),
    )
    last = F.col("_copy") == F.col("_copies")
    half = F.expr("cast(length(_t) div 2 as int)")
    edited = paired.select(
        F.col("_k").alias(key),
        F.length("_t").cast("long").alias("n_chars"),
        F.col("_fp").alias("fingerprint"),
        F.when(last, F.col("_next_fp")).otherwise(F.col("_fp")).alias("_next_fp"),
        F.concat(
            F.expr("substring(_t, 1, cast(length(_t) - length(_t) div 2 as int))"),
            F.when(last, F.col("_head")).otherwise(F.substring(F.col("_t"), F.lit(1), half)),
        ).alias("_edited"),
    )
    printed = edited.select(
        key, "n_chars", "fingerprint", "_next_fp",
        F.sha2("_edited", 256).alias("edited_sha256"),
        fingerprint("_edited").alias("edited_fingerprint"),
    )
    listed = printed.select(
        "*",
        nodes(F.col("fingerprint")).alias("_own"),
        nodes(F.col("edited_fingerprint")).alias("_new"),
        nodes(F.col("_next_fp")).alias("_other"),
    )
    return listed.select(
        key, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint"), F.col("_own"), F.col("_new")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("_next_fp"), F.col("_own"), F.col("_other")).alias("near_next"),
    )
