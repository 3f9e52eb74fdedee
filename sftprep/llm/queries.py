"""One query for each operator, over the whole ``documents`` table, and its SQL.

Where SQL can't express an operator, ``tests/llm`` holds it against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sftprep.llm import (
    fingerprints,
    jaccard,
    lm,
    merkle,
    mixing,
    oracles,
    packing,
    pieces,
    quality,
    repair,
    secrets,
    substrings,
    suffixes,
    tokens,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """Where the environment keeps a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scanned(_table(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return tokens.token_counts(docs, tokenizer_path("byte_bpe_50k.json"), limit=1024)


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.joined(_table(spark, sf_dir, "documents"), threshold=90).drop("_print")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = substrings.without_repeats(_table(spark, sf_dir, "documents"), length=13)
    return left.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return packing.packed(docs, tokenizer_path("byte_bpe_50k.json"), with_ids=False)


def op6_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.with_edited_half(_table(spark, sf_dir, "documents"))


def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = suffixes.without_repeats(_table(spark, sf_dir, "documents"), length=100)
    return left.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = tokenizer_path("piece_bpe_32k.model")
    return pieces.sampled(_table(spark, sf_dir, "documents"), model, seed=8, with_ids=False)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdict = quality.judged(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    )
    return verdict.select("doc_id", *quality.COUNTS, "base_failed", "kept")


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.scored(_table(spark, sf_dir, "documents"))


def op11_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.mixed(_table(spark, sf_dir, "documents"), weights=(5, 2, 1), share=1.5, repeats=2)
    return mix.select("doc_id", "size", "source_size", "target", "taken")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repaired(_table(spark, sf_dir, "conversations"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.with_tampering(_table(spark, sf_dir, "documents"))


OP9_SQL = r"""
with docs as (
    select doc_id, lang, coalesce(text, '') as text,
           list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') as words,
           list_filter(string_split(coalesce(text, ''), chr(10)),
                       lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) as lines
    from documents
), windows as (
    select doc_id, i, words[i] || chr(32) || words[i + 1] || chr(32) || words[i + 2] as w
    from (select doc_id, words, unnest(range(1, len(words) - 1)) as i from docs)
), again as (
    select doc_id, i from windows
    qualify count(*) over (partition by doc_id, w) > 1
), repeats as (
    select doc_id, count(distinct i + j) as n
    from again, (values (0), (1), (2)) as v(j) group by doc_id
), counts as (
    select doc_id, lang, len(words) as n_words,
           length(list_aggregate(words, 'string_agg', '')) as chars_or_null,
           len(regexp_extract_all(text, '[#*$%&|<>]')) as n_symbols,
           len(lines) as n_lines, len(lines) - len(list_distinct(lines)) as n_dup_lines,
           coalesce(repeats.n, 0) as n_repeat_words,
           len(regexp_extract_all(text, '\p{Lu}')) as n_upper,
           len(regexp_extract_all(text, '[!?]')) as n_marks
    from docs left join repeats using (doc_id)
), measured as (
    select *, coalesce(chars_or_null, 0) as word_chars,
           coalesce(n_symbols / nullif(chars_or_null, 0), 0) as symbol_share,
           coalesce(n_upper / nullif(chars_or_null, 0), 0) as upper_share,
           coalesce(n_marks / nullif(chars_or_null, 0), 0) as mark_share,
           coalesce(n_repeat_words / nullif(n_words, 0), 0) as repeat_share,
           coalesce(n_dup_lines / nullif(n_lines, 0), 0) as dup_line_share,
           n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed
    from counts
), rules as (
    unpivot (select doc_id, lang, base_failed, symbol_share, upper_share, mark_share,
                    repeat_share, dup_line_share from measured)
    on symbol_share, upper_share, mark_share, repeat_share, dup_line_share
    into name rule value value
), steps as (
    select unnest(range(16)) as step,
           unnest([0.8, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.12, 0.1, 0.08, 0.06, 0.05, 0.04, 0.03, 0.02]::double[]) as cutoff
), good as (
    select doc_id, min(quality) as good from labels where quality is not null group by doc_id
), tests as (
    select lang, rule, step, cutoff, count(*) filter (good = 1) as n,
           count(*) filter (good = 1 and value > cutoff) as k,
           count(*) filter (good <> 1 and value > cutoff) as hit
    from rules join good using (doc_id), steps
    where not base_failed
    group by all
), tails as (
    select *, n > 0 and k <= n * 0.004 and list_sum(list_transform(range(k + 1), lambda i:
               exp(lgamma(n + 1.0) - lgamma(i + 1.0) - lgamma(n - i + 1.0)
                   + i * ln(0.004) + (n - i) * ln(1 - 0.004))))
           <= 0.05 / (5 * (select count(distinct lang) from documents)) as certified
    from tests
), cutoffs as (
    select lang, rule, arg_max(cutoff, (hit - k) * 100 - step) as cutoff
    from tails t
    where step < (select coalesce(min(step), 16) from tails u
                  where u.lang = t.lang and u.rule = t.rule and not u.certified)
    group by lang, rule
    having max(hit - k) > 0
), broken as (
    select distinct doc_id from rules join cutoffs using (lang, rule) where value > cutoff
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and doc_id not in (select doc_id from broken) as kept
from measured
"""

QUERIES = {
    "op1_secret_scans": op1_secret_scans,
    "op2_token_counts": op2_token_counts,
    "op3_ngram_jaccard_join": op3_ngram_jaccard_join,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_packing": op5_packing,
    "op6_document_fingerprints": op6_document_fingerprints,
    "op7_suffix_array_dedup": op7_suffix_array_dedup,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_quality_rules": op9_quality_rules,
    "op10_lm_scoring": op10_lm_scoring,
    "op11_source_mixing": op11_source_mixing,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_merkle_manifest": op13_merkle_manifest,
}

ORACLES = {
    "op3_ngram_jaccard_join": oracles.JACCARD,
    "op4_substring_dedup": oracles.SUBSTRINGS,
    "op9_quality_rules": OP9_SQL,
    "op11_source_mixing": oracles.MIXING,
    "op13_merkle_manifest": oracles.MERKLE,
}
