"""Operator 11: mixing sources to target weights by Sainte-Lague apportionment.

Documents have a size, their number of words.  Each source has a target: sources share
``share`` times all words by weight, no source gets more than ``repeats`` times its own
words, and what one can't take goes to the others by weight.

1. *Blocks.*  The documents of a source are dealt into shards by a seeded hash, about
   ``SHARD_WORDS`` words or ``SHARD_ROWS`` documents each.  A shard's documents in the
   order of their hash are one stream of words, cut into blocks of equal size (about
   ``block`` words; the blocks of one shard differ by one word at most).
2. *Quotas.*  Blocks go to sources one by one, each to the highest quotient
   ``target / (2 k + 1)``, k being the blocks that the source has already; then the
   blocks of a source go to its shards in the same way, by the shards' words.
3. *Selection.*  A shard with b blocks and a quota of q takes all of them ``q div b``
   times and ``q mod b`` once more: the ones behind a seeded start, going round.  These
   are neighbours in a random order of documents, so the selection is random and still
   cuts two documents of a shard at most.

What a document gives follows from its place in the stream by arithmetic, so no row is
made for a block.  Quotas of all sources are found without ranking more than two
quotients for each source (see :func:`highest_quotients`), and running sums stay inside
shards, so neither a source with a third of all words nor many sources come together
in one task.

Defined results: a null or empty text has size 0 and gives nothing; a null source is a
source; equal rows (key, source and text) are told apart by copy number, so each gets its
row; rows of one key and different texts are ordered by their text's hash; an empty
table gives no rows.  A text longer than a shard is a shard's whole stream.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sftprep.llm.common import SPACES, null_safe, text_of
from sftprep.operators.keys import repeat_rows
from sftprep.operators.positions import numbered
from sftprep.sources.scratch import settle

SHARD_WORDS, SHARD_ROWS = 1_000_000, 2_000


def source_targets(
    sources: DataFrame, weights: Sequence[float], share: float, repeats: float
) -> DataFrame:
    """``sources`` (source, source_size) with weight and target, as a written table.

    Weights go round the sources in the order of their names' code points, null last.
    The level of words per weight at which sources are full is raised until no more
    become full: each step is one sum over the sources.
    """
    ranked = numbered(sources, [F.col("source").asc_nulls_last()], "_rank")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    full = repeats * F.col("source_size")
    nth = F.pmod("_rank", F.lit(len(weights))).cast("int")
    table = settle(ranked.withColumn("weight", F.get(cycle, nth)).drop("_rank"))
    level = 0.0
    while True:
        is_full = F.col("weight") * level >= full
        every, filled, open_ = table.agg(
            F.coalesce(F.sum("source_size"), F.lit(0)),
            F.coalesce(F.sum(F.when(is_full, full)), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~is_full, F.col("weight"))), F.lit(0.0)),
        ).first()
        raised = (min(share, repeats) * every - filled) / open_ if open_ else level
        if raised <= level:
            break
        level = raised
    return table.withColumn("target", F.least(full, F.col("weight") * level).cast("double"))


def highest_quotients(
    table: DataFrame, group: Sequence[str], member: str, weight: str, seats: str, name: str
) -> DataFrame:
    """``table`` with the seats of each member of a group by Sainte-Lague's method.

    ``seats`` is the number of the whole group, a column with one value in a group.
    Members are ordered by the column ``member``, null last, where quotients are equal.  A divisor that is a
    little too large and one a little too small give bounds of each member's seats;
    the bounds of a group differ by two seats for each member at most, and only the
    quotients between them are ranked, in one sort of all groups.
    """
    group = list(group)
    sums = table.groupBy(*group).agg(F.sum(weight).alias("_all"), F.count("*").alias("_members"))
    known = null_safe(table, sums, group)
    half = F.col("_members") / 2

    def at(divisor: Column) -> Column:
        return F.floor(F.col(weight) / divisor + 0.5)

    low = F.when(F.col(seats) > half, at(F.col("_all") / (F.col(seats) - half))).otherwise(F.lit(0))
    high = at(F.col("_all") / (F.col(seats) + half))
    some = (F.col(weight) > 0) & (F.col(seats) > 0)
    # the bounds are one apart from the exact ones at least, whatever the rounding
    known = known.withColumn("_low", F.when(some, F.greatest(low - 1, F.lit(0))).otherwise(0))
    known = known.withColumn("_high", F.when(some, high + 1).otherwise(0))
    known = settle(known)
    sure = known.groupBy(*group).agg(F.sum("_low").alias("_sure"))
    asked = known.where("_high > _low").select(
        *group, member, weight, seats, F.explode(F.sequence("_low", F.col("_high") - 1)).alias("_k")
    )
    quotient = F.col(weight) / (2 * F.col("_k") + 1)
    order = [*[F.col(g).asc_nulls_first() for g in group], quotient.desc(), F.col(member).asc_nulls_last(), "_k"]
    ranked = numbered(asked, order, "_rank")
    first = ranked.groupBy(*group).agg(F.min("_rank").alias("_first"))
    placed = null_safe(null_safe(ranked, first, group), sure, group)
    won = placed.where(F.col("_rank") - F.col("_first") < F.col(seats) - F.col("_sure"))
    won = won.groupBy(*group, member).agg(F.count("*").alias("_won"))
    found = null_safe(known, won, [*group, member], "left")
    seats_won = (F.col("_low") + F.coalesce("_won", F.lit(0))).cast("long")
    return found.select(*[c for c in table.columns if c != name], seats_won.alias(name))


def seeded(*parts: Column) -> Column:
    """A number of 60 bits from the md5 of some strings."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 15), 16, 10).cast("long")


def mixed(
    docs: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    repeats: int = 2,
    block: int = 16,
    seed: int = 11,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    shard_words: int = SHARD_WORDS,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """Per row: key, source, text_md5, size, source_size, target, taken and ``spans``, the
    stretches of words that the mix takes: array of struct(start, words, times).

    ``taken`` is the sum of ``words * times``.
    """
    words = F.regexp_count(text_of(text), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    rows = docs.select(
        F.col(key).alias("_key"), F.col(source).alias("source"), F.md5(text_of(text)).alias("text_md5"), words.alias("size")
    )
    # equal rows are one from here on, until the last step
    rows = settle(rows.groupBy("_key", "source", "text_md5", "size").agg(F.count("*").alias("_copies")))
    every = F.col("size") * F.col("_copies")
    sums = rows.groupBy("source").agg(F.sum(every).alias("source_size"), F.count("*").alias("_rows"))
    sources = source_targets(sums, weights, share, repeats)
    total = sources.agg(F.coalesce(F.sum("target"), F.lit(0.0))).first()[0]
    sources = sources.withColumn("_blocks", F.lit(int(total / block + 0.5)).cast("long"))
    sources = highest_quotients(sources, [], "source", "target", "_blocks", "quota")
    shards_of = F.greatest(
        F.ceil(F.col("source_size") / shard_words), F.ceil(F.col("_rows") / shard_rows), F.lit(1)
    )
    sources = settle(sources.select("source", "source_size", "target", "quota", shards_of.alias("_shards")))
    number = seeded(F.lit(str(seed)), F.coalesce(F.col("_key").cast("string"), F.lit("-")), F.col("text_md5"))
    placed = null_safe(rows, sources, ["source"]).withColumn("_hash", number)
    placed = placed.withColumn("_shard", F.pmod("_hash", F.col("_shards")))

    shards = placed.groupBy("source", "_shard").agg(F.sum(every).alias("_words"), F.first("quota").alias("_seats"))
    shards = highest_quotients(shards, ["source"], "_shard", "_words", "_seats", "_quota")
    # blocks of a shard are cut evenly, so that no short one is left at the end
    blocks = F.greatest(F.round(F.col("_words") / block), F.lit(1)).cast("long")
    shards = shards.withColumn("_blocks", blocks)
    shards = shards.withColumns(
        {
            "_quota": F.least("_quota", repeats * F.col("_blocks")),
            "_from": F.pmod(seeded(F.lit(str(seed)), F.col("source"), F.col("_shard").cast("string")), "_blocks"),
        }
    )

    def cut(number: str) -> Column:
        """The first word of a block."""
        return F.expr(f"({number}) * _words div _blocks")

    shards = shards.select(
        "source",
        "_shard",
        F.expr("cast(_quota div _blocks as int)").alias("_passes"),
        cut("_from").alias("_begin"),
        cut("least(_from + _quota % _blocks, _blocks)").alias("_end"),
        cut("greatest(_from + _quota % _blocks - _blocks, 0L)").alias("_again"),
    )
    order = Window.partitionBy("source", "_shard").orderBy("_hash", F.col("_key").asc_nulls_first(), "text_md5")
    upto = F.sum(every).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    streamed = null_safe(placed.withColumn("_upto", upto), shards, ["source", "_shard"])
    streamed = streamed.withColumn("_start", F.col("_upto") - every)
    each = repeat_rows(streamed, "_copies", "_copy")
    return with_spans(each.withColumn("_start", F.col("_start") + (F.col("_copy") - 1) * F.col("size"))).select(
        F.col("_key").alias(key), "source", "text_md5", "size", "source_size", "target",
        F.expr("aggregate(spans, 0L, (a, s) -> a + s.words * s.times)").alias("taken"), "spans",
    )


def with_spans(rows: DataFrame) -> DataFrame:
    """Add ``spans`` of a document of ``size`` words at ``_start`` of its shard."""

    def span(first: str, last: str, times: str) -> Column:
        start, stop = f"greatest({first}, _start)", f"least({last}, _start + size)"
        return F.expr(
            f"named_struct('start', {start} - _start, 'words', greatest({stop} - {start}, 0L), 'times', {times})"
        )

    found = F.array(
        span("_start", "_start + size", "_passes"), span("_begin", "_end", "1"), span("0L", "_again", "1")
    )
    return rows.withColumn("spans", F.filter(found, lambda s: (s["words"] > 0) & (s["times"] > 0)))


def mixed_texts(docs: DataFrame, mix: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The texts of a mix: key, source, start and text, a row for each time a span is taken.

    ``mix`` is what ``mixed`` made of ``docs``.  The words of a span are joined by one space.
    """
    spans = mix.select(F.col(key).alias("_key"), "source", "text_md5", F.explode("spans").alias("s"))
    # equal rows of docs are one text here; the mix has a row for each of them
    texts = docs.select(F.col(key).alias("_key"), text_of(text).alias("_text"))
    texts = texts.withColumn("text_md5", F.md5("_text")).dropDuplicates(["_key", "text_md5"])
    found = null_safe(spans, texts, ["_key", "text_md5"])
    words = F.filter(F.split("_text", SPACES), lambda w: w != "")
    piece = F.array_join(F.slice(words, (F.col("s.start") + 1).cast("int"), F.col("s.words").cast("int")), " ")
    taken = found.select("_key", "source", F.col("s.start").alias("start"), piece.alias("text"), "s.times")
    return taken.select(
        F.col("_key").alias(key), "source", "start", "text", F.explode(F.sequence(F.lit(1), "times")).alias("time")
    ).drop("time")
