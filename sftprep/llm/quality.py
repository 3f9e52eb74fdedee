"""Operator 9: quality rules with risk-controlled thresholds.

Every text gets a few measures, each a share that is higher in worse texts.  A rule
rejects a document whose measure exceeds the rule's cutoff.  Cutoffs are chosen on a
labelled holdout, per stratum (by default the language): along a fixed list of
cutoffs from lenient to strict, the hypothesis "this cutoff rejects more than
``risk`` of the good documents" is tested with the exact binomial distribution, and
testing stops at the first cutoff that can't be certified.  A fixed order needs no
correction within a rule; over strata and rules the level is divided by their number
(Bonferroni), and the risk of a stratum is shared out among its rules, so that with
probability ``1 - level`` no stratum loses more than ``risk`` of its good documents.
Of the certified cutoffs the one with the best balance of rejected bad and rejected
good documents is taken; equal ones: the most lenient.

Everything is DataFrame functions.  Windows of words are compared inside the row, so
no text is shuffled; the measures of all documents (some numbers a row) are written
once, for the fit and the verdict read them both.

Defined results: a null text counts as empty (no words: it fails the base rule); a
null stratum is a stratum of its own; a document whose stratum has too few good
labels, or a table without labels, is judged by the base rule alone; repeated rows
each get their row; a document with several labels counts as good only if all of them
are good, null labels are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sftprep.llm.common import SPACES, stored, text_of

#: Cutoffs of every rule, from lenient to strict.
CUTOFFS = (0.8, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.12, 0.1, 0.08, 0.06, 0.05, 0.04, 0.03, 0.02)
RULES = ("symbol_share", "upper_share", "mark_share", "repeat_share", "dup_line_share")
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def with_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the counts of ``COUNTS``, and what the shares need, to each row.

    Columns of ``docs`` with one of these names are replaced.
    """
    work = docs.withColumn("_text", text_of(text))
    work = work.withColumns(
        {
            "_words": F.array_remove(F.split("_text", SPACES), ""),
            "_lines": F.filter(F.split("_text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
        }
    )
    # a window of three words as one number: hash bits above, position in the low bits
    work = work.withColumn("_bits", F.greatest(F.lit(20), F.length(F.bin(F.size("_words").cast("long")))))
    work = work.withColumn(
        "_windows",
        F.expr(
            "if(size(_words) < 3, array(), sort_array(transform(sequence(0, size(_words) - 3), i ->"
            " shiftleft(xxhash64(_words[i], _words[i + 1], _words[i + 2]), _bits) | i)))"
        ),
    )
    # neighbours in this order that share the hash bits are compared by the whole hash
    work = work.withColumn("_alike", F.expr(_with_equal_neighbour("_windows", "shiftright({}, _bits)")))
    work = work.withColumn(
        "_alike", F.expr("transform(_alike, x -> cast(x & (shiftleft(1L, _bits) - 1) as int))")
    )
    work = work.withColumn(
        "_alike",
        F.expr(
            "array_sort(transform(_alike, x -> named_struct("
            "'h', xxhash64(_words[x], _words[x + 1], _words[x + 2]), 'i', x)))"
        ),
    )
    work = work.withColumn(
        "_repeats", F.expr(f"array_sort(transform({_with_equal_neighbour('_alike', '{}.h')}, x -> x.i))")
    )
    return work.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.length(F.array_join("_words", "")).cast("long"),
            "n_symbols": F.regexp_count("_text", F.lit(r"[#*$%&|<>]")).cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            # a window adds the words that the window before it doesn't cover
            "n_repeat_words": F.expr(
                "aggregate(_repeats, named_struct('last', -3, 'n', 0L), (a, p) ->"
                " named_struct('last', p, 'n', a.n + least(3, p - a.last)), a -> a.n)"
            ),
            "_n_lines": F.size("_lines"),
            "_n_upper": F.regexp_count("_text", F.lit(r"\p{Lu}")),
            "_n_marks": F.regexp_count("_text", F.lit(r"[!?]")),
        }
    ).drop("_text", "_words", "_lines", "_bits", "_windows", "_alike", "_repeats")


def _with_equal_neighbour(array: str, value: str) -> str:
    """SQL for the elements of a sorted array that equal one beside them in ``value``."""
    before, own, after = (
        value.format(x)
        for x in (f"{array}[greatest(k - 1, 0)]", "x", f"{array}[least(k + 1, size({array}) - 1)]")
    )
    return (
        f"filter({array}, (x, k) -> (k > 0 and {own} = {before})"
        f" or (k < size({array}) - 1 and {own} = {after}))"
    )


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """``with_counts`` and the shares of ``RULES``; shares of nothing are 0."""
    counted = with_counts(docs, text)

    def share(part: str, whole: str):
        return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(F.lit(0.0))

    return counted.withColumns(
        {
            "symbol_share": share("n_symbols", "word_chars"),
            "upper_share": share("_n_upper", "word_chars"),
            "mark_share": share("_n_marks", "word_chars"),
            "repeat_share": share("n_repeat_words", "n_words"),
            "dup_line_share": share("n_dup_lines", "_n_lines"),
        }
    ).drop("_n_lines", "_n_upper", "_n_marks")


def base_failed() -> F.Column:
    """Too short, or more than half of the words in repeated windows."""
    return (F.col("n_words") < 50) | (
        100 * F.col("n_repeat_words") > 50 * F.col("n_words")
    )


def certified_cutoffs(
    measured: DataFrame,
    labels: DataFrame,
    stratum: str,
    key: str = "doc_id",
    risk: float = 0.02,
    level: float = 0.05,
    label_key: str | None = None,
) -> DataFrame:
    """One row per stratum and rule with a certified cutoff: stratum, rule, cutoff.

    ``labels`` has ``key`` and ``quality`` (1 good, 0 bad).  Every labelled document
    counts, whatever their number.  A stratum appears only if it has enough good labels
    for a certificate, about ``log(level) / log(1 - risk / rules)`` of them.
    """
    id_ = label_key or key
    known = labels.where(F.col(id_).isNotNull() & F.col("quality").isNotNull())
    known = known.groupBy(F.col(id_).alias("_key")).agg(F.min("quality").alias("_good"))
    judged = (
        measured.where(~base_failed())
        .select(
            F.col(key).alias("_key"), F.coalesce(F.col(stratum), F.lit("\0")).alias("stratum"), *RULES
        )
        .join(known, "_key")
    )
    pairs = F.array(
        *[F.struct(F.lit(r).alias("rule"), F.col(r).alias("value")) for r in RULES]
    )
    steps = F.array(
        *[F.struct(F.lit(i).alias("step"), F.lit(c).alias("cutoff")) for i, c in enumerate(CUTOFFS)]
    )
    # rows are summed up by stratum, rule and the strictest cutoff that they pass
    passed = judged.select("stratum", "_good", F.explode(pairs).alias("p")).select(
        "stratum",
        "_good",
        F.col("p.rule").alias("rule"),
        F.expr(
            "aggregate(array(" + ", ".join(f"{c}D" for c in CUTOFFS) + "), 0,"
            " (n, c) -> if(p.value > c, n, n + 1))"
        ).alias("_passes"),
    )
    counts = passed.groupBy("stratum", "rule", "_passes").agg(
        F.sum(F.when(F.col("_good") == 1, 1).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("_good") == 1, 0).otherwise(1)).alias("bad"),
    )
    # at most strata x rules x (cutoffs + 1) rows from here on
    tests = (
        counts.withColumn("s", F.explode(steps))
        .select("*", "s.step", "s.cutoff")
        .groupBy("stratum", "rule", "step", "cutoff")
        .agg(
            F.sum("good").alias("n"),
            # the cutoffs get stricter, so a row passes the first ``_passes`` of them
            F.sum(F.when(F.col("_passes") <= F.col("step"), F.col("good")).otherwise(0)).alias("k"),
            F.sum(F.when(F.col("_passes") <= F.col("step"), F.col("bad")).otherwise(0)).alias("hit"),
        )
    )
    rule_risk = risk / len(RULES)
    strata = max(1, measured.select(F.coalesce(F.col(stratum), F.lit("\0"))).distinct().count())
    tested = tests.withColumn("_certified", binomial_tail(rule_risk) <= level / (strata * len(RULES)))
    ranked = tested.groupBy("stratum", "rule").agg(
        F.coalesce(F.min(F.when(~F.col("_certified"), F.col("step"))), F.lit(len(CUTOFFS))).alias("_stop"),
        F.collect_list(F.struct((F.col("hit") - F.col("k")).alias("gain"), (-F.col("step")).alias("at"), "cutoff")).alias("_c"),
    )
    return (
        ranked.withColumn("_best", F.expr("array_max(filter(_c, c -> -c.at < _stop))"))
        .where("_best is not null and _best.gain > 0")
        .select("stratum", "rule", F.col("_best.cutoff").alias("cutoff"))
    )


def binomial_tail(p: float) -> F.Column:
    """P(X <= k) of a binomial X with columns ``n`` and ``k``; 1 where k > n p.

    Terms follow from one another as logarithms, so that none underflows.
    """
    return F.expr(
        f"if(n = 0 or k > n * {p!r}D, 1D, aggregate(sequence(0L, k),"
        f" named_struct('t', 0D, 'sum', 0D), (a, i) -> named_struct("
        f"'t', if(i = 0, n * ln(1D - {p!r}D), a.t + ln((n - i + 1) / greatest(i, 1L)) + ln({p!r}D / (1D - {p!r}D))),"
        f"'sum', a.sum + exp(if(i = 0, n * ln(1D - {p!r}D), a.t + ln((n - i + 1) / greatest(i, 1L)) + ln({p!r}D / (1D - {p!r}D))))),"
        f" a -> a.sum))"
    )


def judged(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    stratum: str = "lang",
    **fit,
) -> DataFrame:
    """Every row of ``docs`` with its counts, shares, ``base_failed`` and ``kept``.

    Text is not part of the result; join on the key, or see ``passing``.
    """
    measured = stored(
        measures(docs.select(key, stratum, text), text).drop(text), "quality-measures"
    )
    return _verdict(measured, labels, key, stratum, **fit)


def passing(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    stratum: str = "lang",
    **fit,
) -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns unchanged."""
    names = docs.columns
    row = F.struct(*[F.col(c) for c in names]).alias("_row")
    rows = docs.select(row, F.col(key).alias("_k"), F.col(stratum).alias("_s"), F.col(text).alias("_t"))
    # the rows are written with their measures: the fit reads only the measures
    measured = stored(measures(rows, "_t").drop("_t"), "quality-rows")
    cuts = _cut_columns(certified_cutoffs(measured, labels, "_s", "_k", label_key=key, **fit))
    kept = _with_kept(measured, cuts, "_s").where("kept")
    return kept.select([F.col("_row")[c].alias(c) for c in names])


def _cut_columns(cutoffs: DataFrame) -> DataFrame:
    """One row per certified stratum, written, so that Spark knows the size when it
    chooses the join."""
    cuts = cutoffs.groupBy(F.col("stratum").alias("_stratum")).agg(
        *[F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"_cut_{r}") for r in RULES]
    )
    return stored(cuts, "quality-cutoffs")


def _with_kept(measured: DataFrame, cuts: DataFrame, stratum: str) -> DataFrame:
    joined = measured.withColumn("_stratum", F.coalesce(F.col(stratum), F.lit("\0"))).join(
        cuts, "_stratum", "left"
    )
    broken = F.lit(False)
    for rule in RULES:
        broken = broken | F.coalesce(F.col(rule) > F.col(f"_cut_{rule}"), F.lit(False))
    return joined.withColumn("base_failed", base_failed()).withColumn(
        "kept", ~F.col("base_failed") & ~broken
    )


def _verdict(measured, labels, key, stratum, **fit) -> DataFrame:
    cuts = _cut_columns(certified_cutoffs(measured, labels, stratum, key, **fit))
    judged_rows = _with_kept(measured, cuts, stratum)
    return judged_rows.select(
        *dict.fromkeys([key, stratum, *COUNTS, *RULES]), "base_failed", "kept"
    )
