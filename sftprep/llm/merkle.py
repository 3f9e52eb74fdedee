"""Operator 13: Merkle manifest of a dataset, with a witness for every row.

A row's leaf is the SHA-256 of its columns.  The leaves of a group (by default a
language), in the order of their keys, make a binary tree; the roots of the groups make
another tree, whose root stands for the dataset.  A witness lists, from the leaf to the
root, the sibling on the way: folding a leaf with it gives the root again, and gives
another root if a column of the row has changed.

Witnesses are made while leaves are appended.  A group is dealt into runs of ``RUN``
neighbouring leaves, so that every run but the last is one aligned subtree.  Within a run
(a task's work) leaves come one by one; a leaf opens a subtree, two complete subtrees of
one height become one, and each leaf of either then gets the other's root as the next
step of its witness.  The root of a run is in turn appended, as a leaf, to the tree
above, by the same operation; its witness there is the rest of the witness of all
leaves of the run.  So no task sees more than ``RUN`` nodes, whatever the size of a group.

Nodes are hexadecimal digests, joined as text.  Where a level has an odd number of nodes
the last one is hashed alone; a lone leaf is its group's root.

Defined results: a null column counts as ``-``, an empty text as ``0:``; a null key comes
first, and rows of one key are ordered by their leaf, so the result does not depend on
the order of the table (equal rows are interchangeable); a null group is a group and
comes first; an empty table has no rows and no root.  A long text is hashed whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sftprep.llm.common import null_safe
from sftprep.operators.positions import numbered
from sftprep.sources.scratch import settle

#: Leaves of an aligned subtree, a power of two.
RUN = 1024
STEPS = "array<struct<left: string, right: string>>"


def field(value: Column) -> Column:
    """A column's value for hashing: ``-`` if null, else its bytes' number, a colon, itself."""
    text = value.cast("string")
    framed = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    return F.coalesce(framed, F.lit("-"))


def leaf_of(*values: Column) -> Column:
    """The leaf of a row with these values."""
    return F.sha2(F.concat(*map(field, values)), 256)


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


class Appended:
    """A tree under construction: its open subtrees, and the witness of each leaf so far."""

    def __init__(self) -> None:
        self.open: list[tuple[int, str, int]] = []  # height, root, first leaf
        self.lefts: list[list[str | None]] = []
        self.rights: list[list[str | None]] = []

    def append(self, leaf: str) -> None:
        self.open.append((0, leaf, len(self.lefts)))
        self.lefts.append([])
        self.rights.append([])
        while len(self.open) > 1 and self.open[-1][0] == self.open[-2][0]:
            self._join()

    def _join(self) -> None:
        """The last two subtrees become one; each witness gets the other's root."""
        _, right, middle = self.open.pop()
        height, left, first = self.open.pop()
        for leaf in range(first, middle):
            self.lefts[leaf].append(None)
            self.rights[leaf].append(right)
        for leaf in range(middle, len(self.lefts)):
            self.lefts[leaf].append(left)
            self.rights[leaf].append(None)
        self.open.append((height + 1, digest(left + right), first))

    def _alone(self) -> None:
        """The last subtree has no sibling on its level."""
        height, root, first = self.open.pop()
        for leaf in range(first, len(self.lefts)):
            self.lefts[leaf].append(None)
            self.rights[leaf].append(None)
        self.open.append((height + 1, digest(root), first))

    def close(self, height: int | None) -> str:
        """The root, after the last leaf; of a subtree of ``height`` if that is given."""
        while len(self.open) > 1:
            while self.open[-1][0] < self.open[-2][0]:
                self._alone()
            self._join()
        while height is not None and self.open[0][0] < height:
            self._alone()
        return self.open[0][1]


def _built(table: pa.Table) -> tuple[pa.Table, Appended, str]:
    """One run in order, its tree and root."""
    table = table.sort_by("_index")
    tree = Appended()
    for leaf in table.column("_hash").to_pylist():
        tree.append(leaf)
    whole = table.column("_of")[0].as_py() <= RUN
    return table, tree, tree.close(None if whole else RUN.bit_length() - 1)


def _runs(nodes: DataFrame) -> DataFrame:
    return nodes.withColumn("_run", F.expr(f"_index div {RUN}"))


def _roots(nodes: DataFrame, group: str) -> DataFrame:
    """One node for each run: the nodes of the level above."""

    def root(table: pa.Table) -> pa.Table:
        table, _, found = _built(table)
        first = table.slice(0, 1)
        of = (first.column("_of")[0].as_py() + RUN - 1) // RUN
        return pa.table(
            [first.column("_group"), first.column("_run"), pa.array([of], pa.int64()), pa.array([found])],
            ["_group", "_index", "_of", "_hash"],
        )

    rows = _runs(nodes.select("_group", "_index", "_of", "_hash"))
    schema = f"_group {group}, _index long, _of long, _hash string"
    return rows.groupBy("_group", "_run").applyInArrow(root, schema)


def levels(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The nodes of each level of runs, and the root of each group (_group, _hash).

    ``nodes`` has _group, _index (from 0), _of (nodes of the group) and _hash.
    """
    group = nodes.schema["_group"].dataType.simpleString()
    found = [nodes]
    while True:
        most = found[-1].agg(F.max("_of")).first()[0] or 0
        above = settle(_roots(found[-1], group))
        if most <= RUN:
            return found, above.select("_group", "_hash")
        found.append(above)


def _steps(lefts: list[list], rights: list[list]) -> pa.Array:
    ends = [0]
    for steps in lefts:
        ends.append(ends[-1] + len(steps))
    flat = [
        pa.array([x for steps in side for x in steps], pa.string()) for side in (lefts, rights)
    ]
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(flat, ["left", "right"]))


def witnessed(found: list[DataFrame]) -> DataFrame:
    """The nodes of the lowest of ``levels`` with their ``_witness`` up to the group's root."""
    above = None
    for nodes in reversed(found):
        kept = [c for c in nodes.columns if c != "_of"]
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in nodes.select(kept).schema)
        runs = _runs(nodes).groupBy("_group", "_run")
        alone, with_rest = _extending(kept)
        schema = f"{fields}, _witness {STEPS}"
        if above is None:
            above = runs.applyInArrow(alone, schema)
        else:
            rest = above.select("_group", F.col("_index").alias("_run"), "_witness")
            above = runs.cogroup(rest.groupBy("_group", "_run")).applyInArrow(with_rest, schema)
    return above


def _extending(kept: list[str]) -> tuple[Callable, Callable]:
    """Functions for a run: witnesses inside it, and these with the run's own after them."""

    def alone(own: pa.Table) -> pa.Table:
        own, tree, _ = _built(own)
        return own.select(kept).append_column("_witness", _steps(tree.lefts, tree.rights))

    def with_rest(own: pa.Table, rest: pa.Table) -> pa.Table:
        own, tree, _ = _built(own)
        for step in rest.column("_witness")[0].as_py():
            for left, right in zip(tree.lefts, tree.rights, strict=True):
                left.append(step["left"])
                right.append(step["right"])
        return own.select(kept).append_column("_witness", _steps(tree.lefts, tree.rights))

    return alone, with_rest


def placed(rows: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Add _index (in the group) and _of to rows with a _group."""
    laid = numbered(rows, [F.col("_group").asc_nulls_first(), *order], "_place")
    groups = laid.groupBy("_group").agg(F.min("_place").alias("_first"), F.count("*").alias("_of"))
    found = null_safe(laid, groups, ["_group"])
    return found.withColumn("_index", F.col("_place") - F.col("_first")).drop("_place", "_first")


def manifest(
    docs: DataFrame,
    columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    key: str = "doc_id",
    group: str = "lang",
    carried: dict[str, Column] | None = None,
) -> DataFrame:
    """Per row: key, group, the ``carried`` columns, leaf, subroot, root and ``witness``.

    ``witness`` is an array of struct(left, right), one for each level: the sibling's digest
    on its side, or null on both sides where there is none.
    """
    carried = carried or {}
    rows = docs.select(
        F.col(group).alias("_group"), F.col(key).alias("_key"), leaf_of(*map(F.col, columns)).alias("_hash"),
        *[c.alias(f"_carried{i}") for i, c in enumerate(carried.values())],
    )
    # texts are read and hashed once; what follows works on digests
    leaves = settle(placed(settle(rows), [F.col("_key").asc_nulls_first(), F.col("_hash")]))
    found, subroots = levels(leaves)
    ranked = numbered(subroots, [F.col("_group").asc_nulls_first()], "_index")
    of = ranked.count()
    top = ranked.select(
        F.lit(0).alias("_group"), "_index", F.lit(of).cast("long").alias("_of"), "_hash", F.col("_group").alias("_name")
    )
    top_levels, root = levels(top)
    names = settle(witnessed(top_levels))
    names = names.select(F.col("_name").alias("_group"), F.col("_hash").alias("subroot"), F.col("_witness").alias("_rest"))
    # one row in all, or none
    names = names.join(F.broadcast(root.select(F.col("_hash").alias("root"))))
    whole = null_safe(witnessed(found), names, ["_group"])
    names_of = dict(zip(carried, range(len(carried)), strict=True))
    return whole.select(
        F.col("_key").alias(key),
        F.col("_group").alias(group),
        *[F.col(f"_carried{i}").alias(name) for name, i in names_of.items()],
        F.col("_hash").alias("leaf"),
        "subroot",
        "root",
        F.concat("_witness", "_rest").alias("witness"),
    )


def folded(leaf: Column, witness: Column) -> Column:
    """The root that a leaf and a witness lead to."""
    empty = F.lit("")
    return F.aggregate(
        witness,
        leaf,
        lambda node, step: F.sha2(
            F.concat(F.coalesce(step["left"], empty), node, F.coalesce(step["right"], empty)), 256
        ),
    )


def proof_digest(witness: Column) -> Column:
    """The SHA-256 of a witness's siblings, level by level."""
    siblings = F.transform(witness, lambda s: F.coalesce(s["left"], s["right"], F.lit("")))
    return F.sha2(F.array_join(siblings, ""), 256)


def with_tampering(docs: DataFrame, key: str = "doc_id", every: int = 7) -> DataFrame:
    """The manifest of ``docs``, and what its witnesses say of rows changed since.

    Where ``every`` divides the crc32 of the key, ``n_chars`` is one more than it was.
    Per row: key, leaf, subroot, root, proof_sha256, folded_root (of the row as it is
    now, with the witness made before) and verified (whether that is the root).
    """
    hit = F.crc32(F.col(key).cast("string").cast("binary")) % every == 0
    now = F.when(hit, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    changed = F.when(hit, leaf_of(*[now if c == "n_chars" else F.col(c) for c in columns]))
    rows = manifest(docs, columns, key, carried={"changed": changed})
    rows = rows.withColumn("folded_root", folded(F.coalesce("changed", "leaf"), F.col("witness")))
    return rows.select(
        key, "leaf", "subroot", "root", proof_digest(F.col("witness")).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
