"""Operator 3: n-gram Jaccard join with a token-group matrix, and its components.

A document's set holds its distinct shingles of ``shingle`` lower-case words; a text of
fewer words is one shingle, a text without words has no set and no links.  Two sets
are linked if their Jaccard similarity is at least ``threshold`` (a percentage).

Documents with one set are one node.  Shingles have an order, those of the least filled
buckets first, into which all are counted by some bits of their hash; linked
sets share a shingle among the first of each (the prefix), and how many they share
there has a lower bound.  The work then goes in two steps, so that no group of similar
documents is ever compared pair by pair:

1. *Groups.*  Of the nodes that share a prefix shingle each is compared with one or
   two leaders, and then with the part (see 2) that it has most in common with.  The
   components of these links are the groups of similar documents.  Links that this
   step doesn't look at are not lost, they are step 2's.
2. *Token-group matrix.*  A group is split into parts of about ``PART`` nodes.  Of the nodes
   without links those that share a frequent shingle make *cells*, which have parts, too, so
   that many nodes that are nearly linked don't meet one by one.  The matrix holds for each
   prefix shingle the parts in whose union it is.  A query is a node that shares a shingle
   with a larger group or its own cell; its overlap with each part's union is counted, and
   only parts that reach the lower bound are opened: the query's text goes to the task that
   has the part's, and is compared with each of them there.  Nodes inside one group need no
   comparison, as they are linked already; those of a cell are compared.

All similarities are exact, computed on whole texts.  Components are found by the
alternating stars of Kiveris et al.; nothing of all this passes through the driver.

Defined results: null and empty texts have size 0 and are their own component; rows of
one key and different texts are rows of their own whose component is named by the
smallest key in it; a null key counts as the largest, and a component of null keys only
has a null name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sftprep.llm.common import dropped, held_tables, released, stored
from sftprep.llm.windows import (
    LAST_KEY,
    blocks,
    chunks,
    flat,
    group_count,
    keyed,
    mixed,
    ranges,
    rolled,
    text_again,
    word_sequence,
)

#: Nodes in a part of a group, and queries that a copy of a part is compared with.
PART, QUERIES = 128, 256
#: Shingles are counted in so many buckets, which travel in slices.
BUCKETS, SLICE = 1 << 20, 1 << 12
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def sets_of(raw: np.ndarray, offsets: np.ndarray, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Text number and shingle, each once, by text and shingle."""
    seq = word_sequence(raw, offsets, _LOWER)
    words = np.bincount(seq.owner, minlength=len(offsets) - 1)
    n = len(seq.symbols)
    owners, tokens = [], []
    with np.errstate(over="ignore"):
        if n >= shingle:
            inside = np.flatnonzero(seq.owner[: n - shingle + 1] == seq.owner[shingle - 1 :])
            owners.append(seq.owner[inside])
            tokens.append(mixed(rolled(seq.symbols, shingle)[inside]))
        for count in range(1, shingle):
            few = np.flatnonzero(words == count)
            owners.append(few)
            if len(few):
                tokens.append(mixed(rolled(seq.symbols, count)[seq.first[few]] + np.uint64(count)))
    owner = np.concatenate(owners)
    token = np.concatenate(tokens) if tokens else np.zeros(0, np.uint64)
    order = np.lexsort((token, owner))
    owner, token = owner[order], token[order]
    if len(owner):
        new = np.concatenate([[True], (owner[1:] != owner[:-1]) | (token[1:] != token[:-1])])
        owner, token = owner[new], token[new]
    return owner, token


def bucket_counts(rows: DataFrame, shingle: int) -> np.ndarray:
    """By bucket: how many documents have one of its shingles, summed over these.

    All documents are counted, by bucket and not by shingle, so that what a task passes on
    has one size, and a frequent shingle is found however the documents are dealt out.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        times = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for _, _, raw, offsets in chunks(batch.column(0)):
                times += np.bincount(_bucket(sets_of(raw, offsets, shingle)[1]), minlength=BUCKETS)
        slices = times.astype(np.int32).reshape(-1, SLICE)
        some = np.flatnonzero(slices.any(axis=1))
        yield pa.record_batch(
            [pa.array(some), pa.array([slices[i].tobytes() for i in some], pa.binary())], ["slice", "times"]
        )

    def add(table: pa.Table) -> pa.Table:
        times = np.zeros(SLICE, np.int64)
        for part in table.column("times"):
            times += np.frombuffer(part.as_py(), np.int32)
        most = np.minimum(times, np.iinfo(np.int32).max).astype(np.int32)
        return pa.table([table.column("slice").slice(0, 1), pa.array([most.tobytes()], pa.binary())], ["slice", "times"])

    counted = rows.select("_text").mapInArrow(count, "slice long, times binary")
    found = counted.groupBy("slice").applyInArrow(add, "slice long, times binary").toArrow()
    times = np.zeros((BUCKETS // SLICE, SLICE), np.int32)
    for i, part in zip(found.column("slice").to_pylist(), found.column("times").to_pylist(), strict=True):
        times[i] = np.frombuffer(part, np.int32)
    return times.reshape(-1)


def _bucket(token: np.ndarray) -> np.ndarray:
    return (token & np.uint64(BUCKETS - 1)).astype(np.int64)


def prefix_length(n: Column | np.ndarray, threshold: int):
    """Linked sets share one of so many first shingles."""
    return n - (n * threshold + 99) // 100 + 1


def _partners(token: np.ndarray, n: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last row of the same token whose size allows a link; rows by token and size."""
    number = np.cumsum(np.concatenate([[0], token[1:] != token[:-1]])) << 32
    key, n = number + n, n.astype(np.int64)
    low = np.searchsorted(key, number + (n * threshold + 99) // 100)
    return low, np.searchsorted(key, number + n * 100 // threshold, "right") - 1


def least_common(n: np.ndarray, m: np.ndarray, threshold: int) -> np.ndarray:
    """Linked sets of n and m share so many shingles of their prefixes at least."""
    of_both = ((n + m) * threshold + 99 + threshold) // (100 + threshold)
    return of_both - (np.maximum(n, m) * threshold + 99) // 100 + 1


def document_sets(rows: DataFrame, threshold: int, shingle: int) -> DataFrame:
    """Per row: _id, _print, k (128-bit name of the set, null without words), n, prefix."""
    shared = rows.sparkSession.sparkContext.broadcast(bucket_counts(rows, shingle))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        times = shared.value
        for batch in batches:
            for first, last, raw, offsets in chunks(batch.column(2)):
                owner, token = sets_of(raw, offsets, shingle)
                count = last - first
                n = np.bincount(owner, minlength=count)
                rank = times[_bucket(token)]
                with np.errstate(over="ignore"):
                    begins = np.minimum(np.cumsum(n) - n, max(len(token) - 1, 0))
                    name = np.zeros((count, 2), np.uint64)
                    for i, salt in enumerate((0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)):
                        if len(token):
                            name[:, i] = np.add.reduceat(mixed(token ^ np.uint64(salt)), begins)
                order = np.lexsort((token, rank, owner))
                keep = np.where(n > 0, prefix_length(n, threshold), 0)
                token = token[order][ranges(np.cumsum(n) - n, keep)]
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(keep)]).astype(np.int32)), pa.array(token.view(np.int64))
                )
                names = pa.array([x.tobytes() if m else None for x, m in zip(name, n, strict=True)], pa.binary())
                part = batch.slice(first, count)
                yield pa.record_batch(
                    [part.column(0), part.column(1), names, pa.array(n.astype(np.int32)), lists],
                    ["_id", "_print", "k", "n", "prefix"],
                )

    return rows.select("_id", "_print", "_text").mapInArrow(
        make, "_id long, _print long, k binary, n int, prefix array<long>"
    )


_POSTINGS = "token array<long>, k1 array<long>, k2 array<long>, n array<int>"


def shared_postings(sets: DataFrame, groups: int, threshold: int) -> DataFrame:
    """Blocks of the prefix shingles that several nodes of sizes that allow a link have:
    token, node, size, by token and size."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.compute.is_valid(batch.column(0)))
            token = batch.column(2).flatten().to_numpy().view(np.uint64)
            counts = batch.column(2).value_lengths().to_numpy()
            names = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.int64).reshape(-1, 2)
            columns = {
                "token": token.view(np.int64), "k1": np.repeat(names[:, 0], counts), "k2": np.repeat(names[:, 1], counts),
                "n": np.repeat(batch.column(1).to_numpy(), counts),
            }
            yield blocks((token >> np.uint64(33)).astype(np.int64) % groups, groups, columns)

    def keep(table: pa.Table) -> pa.Table:
        columns = {c: flat(table, c) for c in ("token", "k1", "k2", "n")}
        order = np.lexsort((columns["k2"], columns["k1"], columns["n"], columns["token"]))
        token, k1, k2, n = (columns[c][order] for c in ("token", "k1", "k2", "n"))
        if len(token):
            new = np.concatenate([[True], (token[1:] != token[:-1]) | (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])])
            token, k1, k2, n = token[new], k1[new], k2[new], n[new]
            low, high = _partners(token, n, threshold)
            several = low < high
            token, k1, k2, n = token[several], k1[several], k2[several], n[several]
        to = (token.view(np.uint64) >> np.uint64(33)).astype(np.int64) % groups
        return pa.Table.from_batches([blocks(to, groups, {"token": token, "k1": k1, "k2": k2, "n": n})])

    nodes = sets.select("k", "n", "prefix")
    dealt = nodes.mapInArrow(deal, f"_to long, {_POSTINGS}")
    return dealt.groupBy("_to").applyInArrow(keep, f"_to long, {_POSTINGS}")


def leader_pairs(postings: DataFrame, threshold: int) -> DataFrame:
    """Each node with the two leaders that it meets on most shingles: a, b.

    Of a shingle's nodes the smallest set is a leader, and one at random; where sizes
    rule the first one out, the next smaller set takes its place.  A leader is left out that
    is met on less than half the shingles that a link needs: most such meet by chance, and
    the others are the matrix's.
    """

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            token, k1, k2, n = (flat(table, c) for c in ("token", "k1", "k2", "n"))
            if not len(token):
                continue
            found = []
            starts = np.concatenate([[True], token[1:] != token[:-1]])
            lead_place = np.maximum.accumulate(np.where(starts, np.arange(len(token)), 0))
            with np.errstate(over="ignore"):
                other = mixed(k1.view(np.uint64)).view(np.int64)
            for rule, order in enumerate((np.lexsort((k2, k1, n, token)), np.lexsort((k2, other, token)))):
                lead = lead_place.copy()
                near = 100 * np.minimum(n[order[lead]], n[order]) >= threshold * np.maximum(n[order[lead]], n[order])
                lead = np.where(near | starts, lead, np.arange(len(token)) - 1)
                found.append((order[lead], order, np.full(len(token), rule)))
            a, b, rule = (np.concatenate(x) for x in zip(*found, strict=True))
            ok = (a != b) & (100 * np.minimum(n[a], n[b]) >= threshold * np.maximum(n[a], n[b]))
            a, b, rule = a[ok], b[ok], rule[ok]
            both = np.stack([rule, k1[b], k2[b], k1[a], k2[a]], 1)
            pairs, first, times = np.unique(both, axis=0, return_index=True, return_counts=True)
            yield pa.record_batch(
                [
                    pa.array([x[3:].tobytes() for x in pairs], pa.binary()), pa.array([x[1:3].tobytes() for x in pairs], pa.binary()),
                    pa.array(least_common(n[a], n[b], threshold)[first].astype(np.int32)), pa.array(times.astype(np.int32)),
                    pa.array(pairs[:, 0]),
                ],
                ["a", "b", "needed", "times", "rule"],
            )

    found = postings.mapInArrow(pair, "a binary, b binary, needed int, times int, rule long")
    met = found.groupBy("a", "b", "rule").agg(F.first("needed").alias("needed"), F.sum("times").alias("times"))
    best = met.groupBy("b", "rule").agg(F.max(F.struct("times", "a", "needed")).alias("l"))
    return best.where("2 * l.times >= l.needed").select(F.col("l.a").alias("a"), "b").distinct()


def cells(postings: DataFrame, threshold: int) -> DataFrame:
    """Nodes that share a shingle with more than ``PART`` others: k, and the name of the
    cell of the most frequent such shingle and the class of the node's size."""

    def crowded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            token, k1, k2, n = (flat(table, c) for c in ("token", "k1", "k2", "n"))
            _, number, times = np.unique(token, return_inverse=True, return_counts=True)
            at = np.flatnonzero(times[number] > PART)
            names = pa.array([x.tobytes() for x in np.stack([k1[at], k2[at]], 1)], pa.binary())
            yield pa.record_batch(
                [names, pa.array(times[number][at]), pa.array(token[at]), pa.array(n[at])], ["k", "times", "token", "n"]
            )

    found = postings.mapInArrow(crowded, "k binary, times long, token long, n int")
    most = found.groupBy("k").agg(F.max(F.struct("times", "token", "n")).alias("m"))
    size = F.floor(F.log(F.col("m.n")) / F.log(F.lit(100 / threshold)))
    return most.select("k", F.encode(F.concat_ws(":", F.lit("cell"), "m.token", size), "utf-8").alias("cell"))


def linked(
    opened: DataFrame, members: DataFrame, texts: DataFrame, groups: int, threshold: int, shingle: int
) -> DataFrame:
    """The links (a, b) between the members of parts and the queries that open them.

    ``opened`` has a row (c, part, k) for each part that a query k opens, ``members`` one
    for each node of a part, ``texts`` k and text of each node.  A query's text goes to
    each of its parts once, and a part's texts to each ``QUERIES`` of its queries, so no
    row is made for a pair of nodes, and a part that many open is dealt out.
    """
    count = opened.groupBy("c", "part").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("places"))
    asked = opened.join(count, ["c", "part"]).withColumn("place", F.pmod(F.xxhash64("k"), F.col("places")).cast("int"))
    shown = count.withColumn("place", F.explode(F.sequence(F.lit(0), F.col("places") - 1))).join(members, ["c", "part"])

    def dealt(rows: DataFrame) -> DataFrame:
        # parts that share a number are compared with each other's queries, which does no harm
        named = rows.select("k", F.xxhash64("c", "part", "place").alias("name")).join(texts, "k")
        to = F.pmod("name", F.lit(groups)).cast("int").alias("to")
        # aliases, as both sides of the cogroup read the same texts
        return named.select(to, "name", *[F.col(c).alias(c) for c in ("k", "text")]).groupBy("to")

    def compare(queries: pa.Table, parts: pa.Table) -> pa.Table:
        pairs = []
        if queries.num_rows and parts.num_rows:
            queries, parts = queries.sort_by("name"), parts.sort_by("name")
            name = queries.column("name").to_numpy()
            member, names = parts.column("k").to_pylist(), parts.column("name").to_numpy()
            query, own = queries.column("k").to_pylist(), _sets_of_table(parts, shingle)
            for first, sets in _sets_by_name(queries, name, shingle):
                last = first + len(sets)
                low = np.searchsorted(names, name[first])
                high = np.searchsorted(names, name[last - 1], "right")
                tokens = np.concatenate(sets)
                n = np.array([len(x) for x in sets])
                owner = np.repeat(np.arange(len(sets)), n)
                for m in range(low, high):
                    if not len(own[m]):
                        continue
                    at = np.searchsorted(own[m], tokens)
                    at[at == len(own[m])] = 0
                    common = np.bincount(owner[own[m][at] == tokens], minlength=len(sets))
                    alike = (common > 0) & (100 * common >= threshold * (n + len(own[m]) - common))
                    pairs += [(member[m], query[first + q]) for q in np.flatnonzero(alike) if member[m] != query[first + q]]
        a, b = zip(*pairs, strict=True) if pairs else ((), ())
        return pa.table([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])

    found = dealt(asked).cogroup(dealt(shown)).applyInArrow(compare, "a binary, b binary")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _sets_of_table(table: pa.Table, shingle: int) -> list[np.ndarray]:
    """The sorted set of each row's text."""
    found = []
    for part in table.column("text").chunks:
        for first, last, raw, offsets in chunks(part):
            owner, token = sets_of(raw, offsets, shingle)
            found += np.split(token, np.searchsorted(owner, np.arange(1, last - first)))
    return found


def _sets_by_name(table: pa.Table, name: np.ndarray, shingle: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """First row and sets of the rows of each name; some texts are held at a time."""
    starts = np.flatnonzero(np.concatenate([[True], name[1:] != name[:-1]]))
    for first, last in zip(starts, np.append(starts[1:], len(name)), strict=True):
        yield int(first), _sets_of_table(table.slice(int(first), int(last - first)), shingle)


def components(edges: DataFrame) -> DataFrame:
    """Node k and the smallest node of its component c, for all nodes of ``edges``."""
    state = stored(edges.select("a", "b").where("a <> b").distinct(), "links", release=False)
    before = None
    while True:
        both = state.union(state.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        small = down.groupBy("a").agg(F.min("b").alias("m"))
        star = down.join(small, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        last, state = state, stored(star.union(small.select("a", F.col("m").alias("b"))).distinct(), "links", release=False)
        dropped(last)
        now = state.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = state.select(F.col("b").alias("k"), F.col("b").alias("c")).distinct()
    found = stored(state.select(F.col("a").alias("k"), F.col("b").alias("c")).union(roots).distinct(), "components", release=False)
    dropped(state)
    return found


def opened_parts(
    postings: DataFrame, groups: DataFrame, threshold: int, best: bool
) -> tuple[DataFrame, DataFrame]:
    """Parts that the token-group matrix can't rule out for a query (c, part, k), and the
    nodes of all parts (c, part, k).

    ``groups`` has k and c of the nodes with links.  Other nodes are groups of their own, but
    those of a larger cell make one *loose* group, which has parts like others and whose
    nodes are queries of its parts, too.
    With ``best`` each query opens the part alone that it has most in common with.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            names = np.stack([flat(table, "k1"), flat(table, "k2")], 1)
            names = pa.array([x.tobytes() for x in names], pa.binary())
            yield pa.record_batch([pa.array(flat(table, "token")), names, pa.array(flat(table, "n"))], ["token", "k", "n"])

    flat_rows = postings.mapInArrow(rows, "token long, k binary, n int")
    sizes = groups.groupBy("c").agg(F.count("*").alias("size"))
    named = groups.join(sizes, "c").select("k", "c", "size", F.lit(False).alias("loose"))
    alone = stored(cells(postings, threshold).join(groups, "k", "left_anti"), "cells", release=False)
    crowds = alone.groupBy("cell").agg(F.count("*").alias("size")).where(F.col("size") > PART)
    loose = alone.join(crowds, "cell").select("k", F.col("cell").alias("c"), "size", F.lit(True).alias("loose"))
    posted = flat_rows.join(named.union(loose), "k", "left").select(
        "token", "k", "n", F.coalesce("c", "k").alias("c"), F.coalesce("size", F.lit(1)).alias("size"),
        F.coalesce("loose", F.lit(False)).alias("loose"),
    )
    posted = posted.withColumn(
        "part", F.pmod(F.xxhash64("k"), F.ceil(F.col("size") / PART)).cast("int")
    )
    posted = stored(posted, "postings")
    # shingles of one group only have nothing to compare, unless it is loose
    order = F.struct("size", "c")
    major = posted.groupBy("token").agg(
        F.max(order).alias("major"), F.min(order).alias("minor"), F.max("loose").alias("any_loose")
    )
    major = major.where("major <> minor or any_loose")
    matrix = posted.groupBy("token", "c", "part").agg(
        F.first("size").alias("size"), F.min("n").alias("low"), F.max("n").alias("high"), F.count("*").alias("nodes")
    )
    matrix = matrix.join(major.select("token"), "token", "left_semi")
    asks = posted.join(major, "token").where("c <> major.c or loose").select("token", "k", "n", "c", "size", "loose", "part")
    q, g = asks.alias("q"), matrix.alias("g")
    inside = F.col("q.part") < F.col("g.part")
    if not best:
        inside = inside | ((F.col("q.part") == F.col("g.part")) & (F.col("g.nodes") > 1))
    met = q.join(
        g,
        (F.col("q.token") == F.col("g.token"))
        & (
            (F.struct("q.size", "q.c") < F.struct("g.size", "g.c"))
            | (F.col("q.loose") & (F.col("q.c") == F.col("g.c")) & inside)
        )
        & (F.col("g.high") * 100 >= F.col("q.n") * threshold)
        & (F.col("q.n") * 100 >= F.col("g.low") * threshold),
    )
    overlap = met.groupBy("q.k", "g.c", "g.part").agg(
        F.first("q.n").alias("n"), F.min("g.low").alias("low"), F.max("g.high").alias("high"), F.count("*").alias("common")
    )
    # least number of shared prefix shingles of the query and a set of low to high shingles
    most = f"least(high, n * 100 div {threshold})"
    least = F.expr(f"greatest(low, (n * {threshold} + 99) div 100)")
    of_both = F.ceil((F.col("n") + least) * threshold / (100 + threshold) - 1e-9)
    of_query = of_both - F.ceil(F.col("n") * threshold / 100 - 1e-9) + 1
    # for a set of m it is ceil((n + m) t / (100 + t)) - ceil(m t / 100) + 1, which goes up
    # and down with m, but is above t (100 n - t m) / (100 (100 + t)), which only falls
    of_other = F.expr(
        f"{threshold}L * (100L * n - {threshold}L * {most}) div {100 * (100 + threshold)}L + 1"
    )
    open_ = overlap.where(F.col("common") >= F.least(of_query, of_other))
    if best:
        open_ = open_.groupBy("k").agg(F.max(F.struct("common", "c", "part", "n")).alias("o"))
        open_ = open_.select("k", "o.c", "o.part", "o.n")
    opened = stored(open_.select("c", "part", "k"), "opened", release=False)
    members = stored(posted.select("c", "part", "k").distinct(), "members", release=False)
    dropped(posted, alone)
    return opened, members


def _components_of(rows: DataFrame, sets: DataFrame, groups: int, threshold: int, shingle: int) -> DataFrame:
    postings = stored(shared_postings(sets, groups, threshold), "shared-postings")
    # one text for each node that shares as many shingles as a link needs with others
    flat_names = postings.mapInArrow(_names(threshold), "k binary, shared int, needed int").groupBy("k").agg(
        F.sum("shared").alias("shared"), F.min("needed").alias("needed")
    ).where("shared >= needed")
    chosen = sets.where("k is not null").groupBy("k").agg(F.min(F.struct("_id", "_print")).alias("d"))
    chosen = chosen.join(flat_names, "k", "left_semi").select("k", "d._id", "d._print")
    texts = rows.select("_id", "_print", F.col("_text").alias("text")).join(chosen, ["_id", "_print"])
    texts = stored(texts.select("k", "text"), "node-texts")
    pairs = stored(leader_pairs(postings, threshold), "leaders", release=False)
    alone = F.lit(0).alias("part")
    leaders = pairs.select(F.col("a").alias("c"), alone, F.col("a").alias("k")).distinct()
    led = pairs.select(F.col("a").alias("c"), alone, F.col("b").alias("k"))
    links = stored(linked(led, leaders, texts, groups, threshold, shingle), "links")
    dropped(pairs)
    for best in (True, False):  # one part for each query joins most groups; then all that is left
        alike = components(links)
        opened, members = opened_parts(postings, alike, threshold, best)
        more = linked(opened, members, texts, groups, threshold, shingle)
        last, links = links, stored(links.union(more), "links")
        dropped(last, opened, members, alike)
    return components(links)


def joined(docs: DataFrame, threshold: int = 90, shingle: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, its text's hash ``_print``, n_shingles and component_id."""
    rows = keyed(docs, key, text)
    groups = group_count(rows, "_text")
    sets = stored(document_sets(rows, threshold, shingle), "sets")
    with held_tables() as tables:
        every = _components_of(rows, sets, groups, threshold, shingle)
    dropped(*[t for t in tables if t is not every])
    released(docs.sparkSession)
    named = sets.join(every, "k", "left").withColumn("c", F.coalesce("c", "k"))
    least = named.where("k is not null").groupBy("c").agg(F.min("_id").alias("component"))
    done = named.join(least, "c", "left").select(
        "_id", "_print", F.col("n").cast("long").alias("n_shingles"), F.coalesce("component", "_id").alias("component")
    )
    out = [F.when(F.col(c) != LAST_KEY, F.col(c)) for c in ("_id", "component")]
    return done.select(
        out[0].cast(docs.schema[key].dataType).alias(key), "_print", "n_shingles",
        out[1].cast(docs.schema[key].dataType).alias("component_id"),
    )


def _names(threshold: int):
    """Nodes of a block, how many shingles each has there, and how many a link needs at least
    with sets of the sizes that these shingles' other nodes have."""

    def names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            token, k1, k2, n = (flat(table, c) for c in ("token", "k1", "k2", "n"))
            low, high = _partners(token, n, threshold) if len(token) else (token, token)
            n = n.astype(np.int64)
            # below n it falls with the other size; above, a bound of it does (see opened_parts)
            above = threshold * (100 * n - threshold * n[high]) // (100 * (100 + threshold)) + 1
            needed = np.minimum(least_common(n, n[low], threshold), above)
            order = np.lexsort((needed, k2, k1))
            both = np.stack([k1, k2], 1)[order]
            first = np.flatnonzero(np.concatenate([[True], (both[1:] != both[:-1]).any(axis=1)])[: len(both)])
            shared = np.diff(np.append(first, len(both)))
            yield pa.record_batch(
                [
                    pa.array([x.tobytes() for x in both[first]], pa.binary()),
                    pa.array(shared.astype(np.int32)), pa.array(needed[order][first].astype(np.int32)),
                ],
                ["k", "shared", "needed"],
            )

    return names


def one_of_each(
    docs: DataFrame, threshold: int = 80, shingle: int = 5, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The rows of ``docs`` whose key names their component; of equal rows one stays."""
    names = docs.columns
    rows = keyed(docs, key, text)
    own = joined(docs, threshold, shingle, key, text)
    same = F.coalesce(F.col(key), F.lit(LAST_KEY)) == F.coalesce("component_id", F.lit(LAST_KEY))
    own_key = F.coalesce(F.col(key).cast("long"), F.lit(LAST_KEY)).alias("_id")
    stay = own.where(same).select(own_key, "_print")
    kept = rows.join(stay, ["_id", "_print"], "left_semi").dropDuplicates(["_id", "_print"])
    return kept.select(*[(text_again() if c == text else F.col("_row")[c]).alias(c) for c in names])
