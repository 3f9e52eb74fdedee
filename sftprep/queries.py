"""The check queries: for every operator a Spark query over whole test tables
and, beside it, the same result as plain SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from . import fixtures as fx
from .functions import (
    CHATML_END,
    CHATML_START,
    TOKEN_PATTERN,
    TURN_END,
    TURN_START,
    add_labels,
    append_eos,
    cap_tokens,
    clean_generation,
    cut_prompt,
    echo_ok,
    escape_quotes,
    from_messages,
    join_ids,
    message_prefix,
    pad,
    prepend_bos,
    py_strip,
    render_chatml,
    render_sections,
    render_turns,
    stop_at,
    strip_markers,
    system_message,
    to_messages,
    tokenize,
    truncate,
    truncate_with_eos,
    was_truncated,
)
from .functions.templates import SECTION_ANSWER, SECTION_CONTEXT, SECTION_QUESTION
from .functions.templates import SYSTEM_PREFIX
from .operators import (
    Blocks,
    accuracy,
    build_vocab,
    decode,
    encode,
    exact_match,
    flag_share,
    format_batches,
    in_blocks,
    map_batches,
    order_hash,
    pack,
    pair_predictions,
    percent,
    pick_row,
    row_at,
    sample_n,
    sample_report,
    shuffle_by_hash,
    special_id,
    summarize,
    take_n,
    train_test_split,
    with_row_key,
)
from .plans import (
    create_dataset,
    encoded_texts,
    evaluate,
    scored_predictions,
    training_blocks,
    training_rows,
)
from .sources import (
    EXAMPLE_SCHEMA,
    read_jsonl,
    read_table,
    scratch_dir,
    select_split,
    settle,
    write_jsonl,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

SPECIALS = ["<unk>", "<eos>", "<pad>"]
UNK, EOS, PAD = range(len(SPECIALS))


def query(sql: str) -> Callable[[Query], Query]:
    """Register a query under its function name, with its SQL counterpart."""

    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        ORACLES[fn.__name__] = sql
        return fn

    return register


def _joined(array: str | Column) -> Column:
    return join_ids(array)


# SQL building blocks ---------------------------------------------------------


def q(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("'", "''") + "'"


def row_md5(df: DataFrame) -> Column:
    """The md5 of all columns' values as text, for comparing whole rows."""
    return F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in df.columns]))


def row_md5_sql(*columns: str) -> str:
    return f"md5(concat_ws('|', {', '.join(f'{c}::varchar' for c in columns)}))"


DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")
LINEITEM = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
    "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
)
NL = "chr(10)"
EX = f"ex as ({fx.EXAMPLES_SQL})"


def turns_sql(context: str, question: str, answer: str | None = None) -> str:
    parts = [
        q(f"{TURN_START}user\nCONTEXT:"),
        context,
        q("\nQUESTION:"),
        question,
        q(f"{TURN_END} {TURN_START}model\n"),
    ]
    if answer is not None:
        parts += [answer, q(TURN_END)]
    return " || ".join(parts)


def order_sql(seed: int, *keys: str) -> str:
    key = " || chr(31) || ".join(f"{k}::varchar" for k in keys)
    return f"md5('{seed}:' || {key})"


def tokens_sql(text: str) -> str:
    return f"regexp_extract_all({text}, {q(TOKEN_PATTERN)})"


WHITESPACE_SQL = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

VOCAB = f"""
toks as (select unnest({tokens_sql('text')}) as token from documents),
counts as (select token, count(*) as n from toks group by token),
vocab as (
    select token, {len(SPECIALS) - 1} + row_number() over (order by n desc, token) as id,
           n, false as is_special
    from counts
),
specials as (
    select unnest({SPECIALS!r}) as token, unnest(range({len(SPECIALS)})) as id,
           0 as n, true as is_special
),
whole_vocab as (select * from specials union all select * from vocab)
"""

# Ids of each document as a list, in token order.
ENCODED = f"""{VOCAB},
positions as (
    select doc_id, unnest({tokens_sql('text')}) as token,
           generate_subscripts({tokens_sql('text')}, 1) as pos
    from documents
),
encoded as (
    select doc_id, list(coalesce(id, {UNK}) order by pos) as ids
    from positions left join vocab using (token) group by doc_id
)
"""

RAW = f"""{EX},
prompted as (
    select *, {turns_sql('context', 'question')} as prompt,
           substr(md5('p:' || example_id::varchar), 1, 1) < 'a' as hit
    from ex
),
raws as (
    select *, prompt || ' ' || answer || case when hit then '' else ' LIMIT 1' end
              || {q(fx.TAIL)} as raw
    from prompted
)
"""


def clean_sql(max_tokens: int | None) -> str:
    text = f"split_part(substr(raw, length(prompt) + 1), {q(TURN_END)}, 1)"
    if max_tokens is not None:
        text = f"array_to_string(list_slice({tokens_sql(text)}, 1, {max_tokens}), '')"
    text = f"replace(replace({text}, {q(TURN_START)}, ''), {q(TURN_END)}, '')"
    return f"trim({text}, {WHITESPACE_SQL})"


def messages_sql() -> str:
    """Role and content of the three messages of an example, one row each."""
    return f"""
    select example_id, 0 as pos, 'system' as role, {q(SYSTEM_PREFIX)} || context as content from ex
    union all select example_id, 1, 'user', question from ex
    union all select example_id, 2, 'assistant', answer from ex
    """


def chatml_sql(tail: str = "") -> str:
    text = f"{q(CHATML_START)} || role || {NL} || content || {q(CHATML_END)} || {NL}"
    return f"""with {EX}, msgs as ({messages_sql()})
    select example_id, string_agg({text}, '' order by pos) || {q(tail)} as text
    from msgs group by example_id"""


# Sources and sinks -----------------------------------------------------------


@query(f"with {EX} select * from ex")
def jsonl_roundtrip(spark, sf_dir):
    path = scratch_dir(spark)
    write_jsonl(fx.examples(spark, sf_dir), path, by_split=False)
    return read_jsonl(spark, path, EXAMPLE_SCHEMA)


def split_sql(share: float, seed: int) -> str:
    """All documents with their split."""
    return f"""select *, case when r <= ceil({share} * n) then 'test' else 'train' end as split
    from (select *, row_number() over (order by {order_sql(seed, 'doc_id')}, doc_id) as r,
                 count(*) over () as n from documents)"""


@query(f"select doc_id, {row_md5_sql(*DOCUMENT)} as row_md5 from ({split_sql(0.2, 3)}) where split = 'train'")
def jsonl_one_split(spark, sf_dir):
    docs = fx.table(spark, sf_dir, "documents")
    path = scratch_dir(spark)
    write_jsonl(train_test_split(docs, "doc_id", 0.2, seed=3), path)
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, split string"
    train = read_jsonl(spark, path, schema, split="train").drop("split")
    return train.select("doc_id", row_md5(train).alias("row_md5"))


@query(f"select doc_id, split, {row_md5_sql(*DOCUMENT)} as row_md5 from ({split_sql(0.2, 3)})")
def table_all_splits(spark, sf_dir):
    docs = fx.table(spark, sf_dir, "documents")
    path = scratch_dir(spark)
    train_test_split(docs, "doc_id", 0.2, seed=3).write.partitionBy("split").orc(path)
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, split string"
    stored = read_table(spark, path, "orc", schema)
    return stored.select("doc_id", "split", row_md5(stored.drop("split")).alias("row_md5"))


# Sampling, order, split ------------------------------------------------------


@query(f"""with {EX} select * from ex
    order by {order_sql(11, 'example_id')}, example_id limit 100""")
def sample_examples(spark, sf_dir):
    return sample_n(fx.examples(spark, sf_dir), "example_id", 100, seed=11, strict=False)


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items, whose only key is their whole content."""
    rows = fx.table(spark, sf_dir, "lineitem").select(*LINEITEM)
    return rows.withColumn("row_md5", row_md5(rows))


def items_sql(seed: int) -> str:
    return f"""select l_orderkey, row_md5,
               row_number() over (order by {order_sql(seed, "row_md5")}, row_md5) - 1 as position
        from (select *, {row_md5_sql(*LINEITEM)} as row_md5 from lineitem)"""


@query(f"select * from ({items_sql(5)}) where position < 20000")
def sample_large(spark, sf_dir):
    """A sample of many rows comes in the order of a small one: each row has its place."""
    rows = sample_n(
        items(spark, sf_dir), "row_md5", 20_000, seed=5, strict=False, position="position"
    )
    return rows.select("l_orderkey", "row_md5", "position")


@query(f"select * from ({items_sql(6)}) where position < 10001")
def sample_just_large(spark, sf_dir):
    rows = sample_n(
        items(spark, sf_dir), "row_md5", 10_001, seed=6, strict=False, position="position"
    )
    return rows.select("l_orderkey", "row_md5", "position")


@query(f"""select doc_id, {row_md5_sql(*DOCUMENT)} as row_md5,
    row_number() over (order by {order_sql(7, 'doc_id')}, doc_id) - 1 as position from documents""")
def shuffle_order(spark, sf_dir):
    docs = fx.table(spark, sf_dir, "documents")
    rows = shuffle_by_hash(docs, "doc_id", seed=7, position="position")
    return rows.select("doc_id", row_md5(rows.drop("position")).alias("row_md5"), "position")


@query(f"""select {row_md5_sql(*DOCUMENT)} as row_md5 from documents
    order by {order_sql(7, 'doc_id')}, doc_id limit 40""")
def take_first(spark, sf_dir):
    rows = take_n(shuffle_by_hash(fx.table(spark, sf_dir, "documents"), "doc_id", seed=7), 40)
    return rows.select(row_md5(rows).alias("row_md5"))


@query(f"""select l_orderkey, {row_md5_sql(*LINEITEM)} as row_md5 from lineitem
    order by l_orderkey, row_md5 limit 30000""")
def take_many(spark, sf_dir):
    """More rows than come together in one task."""
    rows = items(spark, sf_dir).orderBy("l_orderkey", "row_md5")
    return take_n(rows, 30_000, strict=False).select("l_orderkey", "row_md5")


@query(f"select split, count(*) as n_rows, sum(n_chars)::bigint as n_chars from ({split_sql(0.8, 7)}) group by split")
def split_counts(spark, sf_dir):
    splits = train_test_split(fx.table(spark, sf_dir, "documents"), "doc_id", 0.8, seed=7)
    return splits.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("n_chars").alias("n_chars")
    )


@query(f"select doc_id, split, {row_md5_sql(*DOCUMENT)} as row_md5 from ({split_sql(0.25, 8)})")
def split_rows(spark, sf_dir):
    rows = train_test_split(fx.table(spark, sf_dir, "documents"), "doc_id", 0.25, seed=8)
    return rows.select("doc_id", "split", row_md5(rows.drop("split")).alias("row_md5"))


@query(f"""with rows as (select lang, n_chars, {row_md5_sql(*DOCUMENT)} as row_md5,
        row_number() over (order by {order_sql(12, 'lang')}) as r, count(*) over () as n from documents)
    select lang, count(*) as n_rows, count(distinct row_md5) as n_distinct,
           greatest(0, least(ceil(0.3 * any_value(n)) - (min(r) - 1), count(*)))::bigint as n_test
    from rows group by lang""")
def split_tied_keys(spark, sf_dir):
    """A key that many rows share, and a map among their columns: the cut falls into a key."""
    docs = fx.table(spark, sf_dir, "documents")
    facts = F.map_from_arrays(F.array("lang", "source"), F.array("n_chars", "doc_id"))
    rows = train_test_split(docs.withColumn("facts", facts), "lang", 0.3, seed=12)
    return rows.groupBy("lang").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct(row_md5(rows.drop("split", "facts"))).alias("n_distinct"),
        F.count_if(F.col("split") == "test").alias("n_test"),
    )


@query(f"select doc_id, split, {row_md5_sql(*DOCUMENT)} as row_md5 from ({split_sql(0.8, 7)}) where split = 'train'")
def split_select(spark, sf_dir):
    rows = train_test_split(fx.table(spark, sf_dir, "documents"), "doc_id", 0.8, seed=7)
    train = select_split(rows, "train")
    return train.select("doc_id", "split", row_md5(train.drop("split")).alias("row_md5"))


@query(f"select l_orderkey, row_md5 from ({items_sql(9)}) where position = 345")
def row_at_position(spark, sf_dir):
    return row_at(items(spark, sf_dir), "row_md5", 345, seed=9).select("l_orderkey", "row_md5")


@query(f"""select * from conversations
    order by {order_sql(13, 'conv_id', 'turn')}, conv_id, turn limit 1""")
def pick_random_row(spark, sf_dir):
    return pick_row(fx.table(spark, sf_dir, "conversations"), ["conv_id", "turn"], seed=13)


@query("""select text, count(*) as copies, count(*) as keys, max(copy) as last_copy from (
        select text, row_number() over (partition by text) as copy from documents
    ) group by text""")
def row_keys(spark, sf_dir):
    """Only the text: whole documents have no copies."""
    keyed = with_row_key(fx.table(spark, sf_dir, "documents").select("text"), "row_key")
    copy = F.substring_index("row_key", ":", -1).cast("long")
    return keyed.groupBy("text").agg(
        F.count(F.lit(1)).alias("copies"),
        F.count_distinct("row_key").alias("keys"),
        F.max(copy).alias("last_copy"),
    )


# Records ---------------------------------------------------------------------


@query(f"""with {EX}, msgs as ({messages_sql()})
    select example_id, string_agg(role || '=' || content, '|' order by pos) as messages
    from msgs group by example_id""")
def messages_of_examples(spark, sf_dir):
    rows = to_messages(fx.examples(spark, sf_dir))
    joined = F.transform("messages", lambda m: F.concat(m["role"], F.lit("="), m["content"]))
    return rows.select("example_id", F.array_join(joined, "|").alias("messages"))


@query(f"""with {EX} select example_id, {q(SYSTEM_PREFIX)} || context as context, question, answer
    from ex""")
def examples_of_messages(spark, sf_dir):
    return from_messages(to_messages(fx.examples(spark, sf_dir)))


@query(f"""with {EX}, msgs as ({messages_sql()})
    select example_id, string_agg(role || '=' || content, '|' order by pos) as messages
    from msgs where pos < 2 group by example_id""")
def messages_without_answer(spark, sf_dir):
    rows = to_messages(fx.examples(spark, sf_dir))
    joined = F.transform(
        message_prefix("messages", 2), lambda m: F.concat(m["role"], F.lit("="), m["content"])
    )
    return rows.select("example_id", F.array_join(joined, "|").alias("messages"))


# Prompts ---------------------------------------------------------------------


@query(f"select doc_id, md5({q(SYSTEM_PREFIX)} || text) as system from documents")
def render_system(spark, sf_dir):
    docs = fx.table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.md5(system_message("text")).alias("system"))


@query(f"with {EX} select example_id, {turns_sql('context', 'question', 'answer')} as text from ex")
def render_turns_train(spark, sf_dir):
    text = render_turns("context", "question", "answer")
    return fx.examples(spark, sf_dir).select("example_id", text.alias("text"))


@query(f"with {EX} select example_id, {turns_sql('context', 'question')} as text from ex")
def render_turns_prompt(spark, sf_dir):
    text = render_turns("context", "question")
    return fx.examples(spark, sf_dir).select("example_id", text.alias("text"))


_ESCAPED = "replace(text, chr(34), chr(92) || chr(34))"


@query(f"""select doc_id, {q(SECTION_CONTEXT)} || {_ESCAPED}
    || {q(SECTION_QUESTION)} || source || {q(SECTION_ANSWER)} || lang as text from documents""")
def render_sections_escaped(spark, sf_dir):
    text = render_sections(escape_quotes("text"), escape_quotes("source"), escape_quotes("lang"))
    return fx.table(spark, sf_dir, "documents").select("doc_id", text.alias("text"))


@query(chatml_sql())
def render_chatml_text(spark, sf_dir):
    rows = to_messages(fx.examples(spark, sf_dir))
    return rows.select("example_id", render_chatml("messages").alias("text"))


@query(chatml_sql(f"{CHATML_START}assistant\n"))
def render_chatml_open(spark, sf_dir):
    rows = to_messages(fx.examples(spark, sf_dir))
    return rows.select("example_id", render_chatml("messages", open_turn=True).alias("text"))


# Cleaning --------------------------------------------------------------------


@query(f"""with {RAW} select example_id, {clean_sql(50)} as prediction,
    starts_with(raw, prompt) as echo_ok from raws""")
def clean_capped(spark, sf_dir):
    return fx.with_raw(fx.examples(spark, sf_dir)).select(
        "example_id",
        clean_generation("raw", "prompt", max_tokens=50).alias("prediction"),
        echo_ok("raw", "prompt").alias("echo_ok"),
    )


@query(f"""with {RAW}, step as (select example_id, raw, substr(raw, length(prompt) + 1) as cut from raws)
    select example_id, cut, split_part(cut, {q(TURN_END)}, 1) as stopped,
           array_to_string(list_slice({tokens_sql('cut')}, 1, 20), '') as capped,
           replace(replace(raw, {q(TURN_START)}, ''), {q(TURN_END)}, '') as unmarked,
           trim(cut, {WHITESPACE_SQL}) as trimmed
    from step""")
def clean_steps(spark, sf_dir):
    cut = fx.with_raw(fx.examples(spark, sf_dir)).withColumn("cut", cut_prompt("raw", "prompt"))
    return cut.select(
        "example_id",
        "cut",
        stop_at("cut", TURN_END).alias("stopped"),
        cap_tokens("cut", 20).alias("capped"),
        strip_markers("raw").alias("unmarked"),
        py_strip("cut").alias("trimmed"),
    )


@query(f"""with {RAW}, plain as (
        select example_id,
               replace(replace(raw, {q(TURN_START)}, ''), {q(TURN_END)}, '') as raw,
               replace(replace(prompt, {q(TURN_START)}, ''), {q(TURN_END)}, '') as prompt
        from raws)
    select example_id, trim(substr(raw, length(prompt) + 1), {WHITESPACE_SQL}) as prediction
    from plain""")
def clean_decoded(spark, sf_dir):
    """Text decoded without special tokens, cut by the prompt without markers."""
    rows = fx.with_raw(fx.examples(spark, sf_dir))
    cut = cut_prompt(strip_markers("raw"), strip_markers("prompt"))
    return rows.select("example_id", py_strip(cut).alias("prediction"))


# Tokens ----------------------------------------------------------------------


def _tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.documents(spark, sf_dir).select("doc_id", tokenize("text").alias("tokens"))


def _blocks(spark: SparkSession, sf_dir: str) -> Blocks:
    tokens = tokenize("text", in_batches=True).alias("tokens")
    return in_blocks(fx.documents(spark, sf_dir).select("doc_id", tokens))


def _vocab(tokens: DataFrame | Blocks) -> DataFrame:
    return build_vocab(tokens, "tokens", SPECIALS)


def _encoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = _blocks(spark, sf_dir)
    ids = encode(tokens, _vocab(tokens), out="tokens", unknown=UNK)
    return ids.withColumnRenamed("tokens", "input_ids")


@query(f"""select doc_id, len(t) as n_tokens, md5(array_to_string(t, '|')) as tokens
    from (select doc_id, {tokens_sql('text')} as t from documents)""")
def token_counts(spark, sf_dir):
    tokens = _tokens(spark, sf_dir)
    return tokens.select(
        "doc_id",
        F.size("tokens").cast("long").alias("n_tokens"),
        F.md5(F.array_join("tokens", "|")).alias("tokens"),
    )


@query(f"with {VOCAB} select token, id, n, is_special from whole_vocab")
def vocab_top(spark, sf_dir):
    return _vocab(_tokens(spark, sf_dir))


@query(f"with {VOCAB} select token, id from whole_vocab where is_special and token = '<eos>'")
def special_token_id(spark, sf_dir):
    return special_id(_vocab(_tokens(spark, sf_dir)), "<eos>")


@query(f"""with {ENCODED} select doc_id, len(ids) as n_ids, md5(array_to_string(ids, ',')) as ids
    from encoded""")
def encode_ids(spark, sf_dir):
    ids = _encoded(spark, sf_dir)
    return ids.select(
        "doc_id",
        F.size("input_ids").cast("long").alias("n_ids"),
        F.md5(_joined("input_ids")).alias("ids"),
    )


@query(f"""with {ENCODED}, placed as (
        select doc_id, unnest(list_append(ids, {EOS})) as id,
               generate_subscripts(list_append(ids, {EOS}), 1) as pos from encoded)
    select d.doc_id, md5(coalesce(string_agg(token, '' order by pos), '')) as text
    from placed d left join (select token, id from vocab) v using (id) group by d.doc_id""")
def decode_skip_special(spark, sf_dir):
    tokens = _blocks(spark, sf_dir)
    vocab = _vocab(tokens)
    ids = encode(tokens, vocab, out="tokens", unknown=UNK)
    marked = ids.select("doc_id", append_eos("tokens", EOS).alias("text"))
    text = decode(marked, vocab, "text", skip_special=True)
    return text.select("doc_id", F.md5("text").alias("text"))


FEW_LOOKED_UP = 500


@query(ORACLES["encode_ids"])
def encode_joined(spark, sf_dir):
    """Most entries of the vocabulary are joined, as all but the first of a large one are."""
    tokens = _blocks(spark, sf_dir)
    ids = encode(tokens, _vocab(tokens), unknown=UNK, lookup_rows=FEW_LOOKED_UP)
    return ids.select(
        "doc_id",
        F.size("input_ids").cast("long").alias("n_ids"),
        F.md5(_joined("input_ids")).alias("ids"),
    )


@query("select doc_id, md5(text) as text, length(text)::bigint as n_chars from documents")
def encode_decode(spark, sf_dir):
    """The text of every document again, with entries looked up and joined on both ways."""
    tokens = _blocks(spark, sf_dir)
    vocab = settle(_vocab(tokens))
    ids = encode(tokens, vocab, out="tokens", unknown=UNK, lookup_rows=FEW_LOOKED_UP)
    text = decode(ids.withColumnRenamed("tokens", "text"), vocab, "text", lookup_rows=FEW_LOOKED_UP)
    return text.select("doc_id", F.md5("text").alias("text"), F.char_length("text").cast("long").alias("n_chars"))


def _cut_sql(keep: str, length: int) -> str:
    return f"""with {ENCODED}, marked as (select doc_id, list_append(ids, {EOS}) as ids from encoded)
    select doc_id, array_to_string({keep}, ',') as ids, len(ids) > {length} as was_truncated
    from marked"""


def _cut(spark: SparkSession, sf_dir: str, length: int, side: str) -> DataFrame:
    ids = _encoded(spark, sf_dir).select("doc_id", append_eos("input_ids", EOS).alias("all_ids"))
    return ids.select(
        "doc_id",
        _joined(truncate("all_ids", length, side)).alias("ids"),
        was_truncated("all_ids", length).alias("was_truncated"),
    )


@query(_cut_sql("list_slice(ids, 1, 256)", 256))
def eos_truncate_right(spark, sf_dir):
    return _cut(spark, sf_dir, 256, "right")


@query(f"""with {ENCODED}
    select doc_id, array_to_string([{UNK}] || list_append(list_slice(ids, 1, 254), {EOS}), ',') as ids from encoded""")
def bos_eos_truncate(spark, sf_dir):
    """Between the ids of start and end of a sequence there is room for 254 others."""
    ids = _encoded(spark, sf_dir)
    return ids.select("doc_id", _joined(prepend_bos(truncate_with_eos("input_ids", 255, EOS), UNK)).alias("ids"))


@query(_cut_sql("list_slice(ids, greatest(len(ids) - 255, 1), len(ids))", 256))
def eos_truncate_left(spark, sf_dir):
    return _cut(spark, sf_dir, 256, "left")


def _pad_sql(side: str, length: int) -> str:
    def filled(body: str, fill: str) -> str:
        pads = f"list_transform(range(greatest({length} - len(ids), 0)), lambda i: {fill})"
        return f"{body} || {pads}" if side == "right" else f"{pads} || {body}"

    ones = "list_transform(ids, lambda i: 1)"
    return f"""with {ENCODED}, cut as (select doc_id, list_slice(ids, 1, {length}) as ids from encoded)
    select doc_id, md5(array_to_string({filled('ids', str(PAD))}, ',')) as input_ids,
           array_to_string({filled(ones, '0')}, '') as attention_mask,
           md5(array_to_string({filled('ids', '-100')}, ',')) as labels
    from cut"""


def _padded(spark: SparkSession, sf_dir: str, side: str) -> DataFrame:
    ids = _encoded(spark, sf_dir).withColumn("input_ids", truncate("input_ids", 512))
    rows = add_labels(pad(ids, 512, PAD, side), ignore_index=-100)
    return rows.select(
        "doc_id",
        F.md5(_joined("input_ids")).alias("input_ids"),
        F.array_join("attention_mask", "").alias("attention_mask"),
        F.md5(_joined("labels")).alias("labels"),
    )


@query(_pad_sql("right", 512))
def pad_mask_labels(spark, sf_dir):
    return _padded(spark, sf_dir, "right")


@query(_pad_sql("left", 512))
def pad_left(spark, sf_dir):
    return _padded(spark, sf_dir, "left")


def _pack_sql(length: int, seed: int, sep: int | None, drop_last: bool = True) -> str:
    ids = "ids" if sep is None else f"list_append(ids, {sep})"
    return f"""with {ENCODED}, flat as (
        select doc_id, unnest({ids}) as id, generate_subscripts({ids}, 1) as pos from encoded),
    stream as (
        select id, row_number() over (order by {order_sql(seed, 'doc_id')}, doc_id, pos) - 1 as idx
        from flat)
    select idx // {length} as block, string_agg(id::varchar, ',' order by idx) as ids
    from stream group by block having count(*) >= {length if drop_last else 1}"""


def _packed(spark: SparkSession, sf_dir: str, sep: int | None, drop_last: bool = True) -> DataFrame:
    blocks = pack(_encoded(spark, sf_dir), "doc_id", 256, seed=17, sep=sep, drop_last=drop_last)
    return blocks.select("block", _joined("input_ids").alias("ids"))


@query(_pack_sql(256, 17, None))
def pack_blocks(spark, sf_dir):
    return _packed(spark, sf_dir, None)


@query(_pack_sql(256, 17, EOS))
def pack_with_separator(spark, sf_dir):
    return _packed(spark, sf_dir, EOS)


@query(_pack_sql(256, 17, None, drop_last=False))
def pack_all(spark, sf_dir):
    """With the short block at the end."""
    return _packed(spark, sf_dir, None, drop_last=False)


@query(f"""with {ENCODED}, keyed as (
        select lang, ids, md5(array_to_string(ids, ',')) as content from encoded join documents using (doc_id)),
    flat as (select lang, content, rank, unnest(ids) as id, generate_subscripts(ids, 1) as pos
        from (select *, row_number() over (order by {order_sql(18, 'lang')}, content) as rank from keyed)),
    stream as (select id, row_number() over (order by rank, pos) - 1 as idx from flat)
    select idx // 256 as block, string_agg(id::varchar, ',' order by idx) as ids
    from stream group by block having count(*) = 256""")
def pack_tied_keys(spark, sf_dir):
    """A key that a large share of the rows have."""
    langs = fx.table(spark, sf_dir, "documents").select("doc_id", "lang")
    blocks = pack(_encoded(spark, sf_dir).join(langs, "doc_id"), "lang", 256, seed=18)
    return blocks.select("block", _joined("input_ids").alias("ids"))


# User functions --------------------------------------------------------------


@query("""select doc_id, lang, length(text)::bigint as n_chars, upper(source) as source
    from documents""")
def map_over_batches(spark, sf_dir):
    docs = fx.table(spark, sf_dir, "documents")

    def measure(batch):
        return {
            "n_chars": [len(t) for t in batch["text"]],
            "source": [s.upper() for s in batch["source"]],
        }

    return map_batches(
        docs,
        measure,
        "n_chars bigint, source string",
        batch_size=256,
        drop=["text"],
        inputs=["text", "source"],
    )


@query(f"with {EX} select example_id, question || ' / ' || answer as pair from ex")
def map_over_rows(spark, sf_dir):
    return map_batches(
        fx.examples(spark, sf_dir),
        lambda row: {"pair": f"{row['question']} / {row['answer']}"},
        "pair string",
        batched=False,
        drop=["context", "question", "answer"],
    )


@query("""select lang || ': ' || text as text from documents
    union all select 'id ' || doc_id::varchar from documents""")
def format_texts(spark, sf_dir):
    """Two texts for every row: a batch may come back longer than it was."""
    docs = fx.table(spark, sf_dir, "documents").select("doc_id", "lang", "text")

    def texts(batch):
        for key, lang, text in zip(batch["doc_id"], batch["lang"], batch["text"]):
            yield f"{lang}: {text}"
            yield f"id {key}"

    return format_batches(docs, texts)


# Scoring ---------------------------------------------------------------------


def _scored(examples: DataFrame, answers: DataFrame, max_tokens: int | None = None) -> DataFrame:
    """Examples scored with a predictor fitted on ``answers``."""
    factory = fx.predictor(fx.answers_by_first_word(answers))
    return fx.with_turn(scored_predictions(examples, factory, max_tokens, batch_size=128))


MODEL = f"""{EX},
model as (
    select bucket, answer as said from (
        select substr(md5(split_part(question, ' ', 1)), 1, 2) as bucket, answer, count(*) as n
        from ex group by all)
    qualify row_number() over (partition by bucket order by n desc, answer) = 1
),
raws as (
    select ex.*, {turns_sql('context', 'question')} as prompt, prompt || ' ' || said || {q(fx.TAIL)} as raw
    from ex join model on bucket = substr(md5(split_part(question, ' ', 1)), 1, 2)
)
"""


def scored_sql(max_tokens: int | None = None) -> str:
    return f"""{MODEL}, preds as (select *, {clean_sql(max_tokens)} as prediction from raws),
    scored as (
        select *, example_id % 100 as turn,
               case when prediction = answer then 1 else 0 end as score from preds)"""


@query(f"with {scored_sql()} select example_id, answer, prediction, score from scored")
def predict_score(spark, sf_dir):
    examples = settle(fx.examples(spark, sf_dir))
    return _scored(examples, examples).select("example_id", "answer", "prediction", "score")


_ACC = "count(*) as n, sum(score)::bigint as hits, avg(score) as accuracy"


@query(f"with {scored_sql()} select {_ACC} from scored")
def accuracy_total(spark, sf_dir):
    examples = settle(fx.examples(spark, sf_dir))
    return accuracy(_scored(examples, examples))


@query(f"with {scored_sql(50)} select {_ACC} from scored")
def accuracy_capped(spark, sf_dir):
    examples = settle(fx.examples(spark, sf_dir))
    return accuracy(_scored(examples, examples, max_tokens=50))


@query(f"with {scored_sql()} select turn, {_ACC} from scored group by turn")
def accuracy_by(spark, sf_dir):
    examples = settle(fx.examples(spark, sf_dir))
    return accuracy(_scored(examples, examples), by="turn")


@query(f"""with {scored_sql(50)}, sampled as (
        select * from scored order by {order_sql(37, 'example_id')}, example_id limit 30)
    select {_ACC} from sampled""")
def evaluate_sample(spark, sf_dir):
    """The whole evaluation of a predictor that is given the prompts of a sample."""
    examples = settle(fx.examples(spark, sf_dir))
    factory = fx.predictor(fx.answers_by_first_word(examples))
    return evaluate(examples, factory, n=30, seed=37, max_tokens=50, batch_size=8)


@query(f"""with {MODEL}, texts as ({messages_sql()}),
    prompts as (
        select example_id, string_agg({q(CHATML_START)} || role || {NL} || content || {q(CHATML_END)} || {NL}, '' order by pos)
               || {q(CHATML_START + 'assistant')} || {NL} as prompt
        from texts where pos < 2 group by example_id)
    select example_id, prompt, strlen(prompt)::varchar as prediction, 0 as score from prompts""")
def predict_chatml(spark, sf_dir):
    """Prompts of another style: a predictor that answers with the prompt's length."""
    rows = to_messages(fx.examples(spark, sf_dir), keep=["answer"])

    def factory():
        return lambda prompts: [f"{p} {len(p.encode())}{CHATML_END} and more" for p in prompts]

    return scored_predictions(rows, factory, style="chatml").select(
        "example_id", "prompt", "prediction", "score"
    )


@query(f"""with {RAW}, preds as (select example_id, {clean_sql(None)} as prediction from raws where hit)
    select example_id, prediction, case when prediction = answer then 1 else 0 end as score
    from ex left join preds using (example_id)""")
def missing_predictions(spark, sf_dir):
    examples = fx.examples(spark, sf_dir)
    preds = fx.with_raw(examples).filter(fx.is_hit()).select(
        "example_id", clean_generation("raw", "prompt").alias("prediction")
    )
    pairs = pair_predictions(examples, preds)
    return pairs.select(
        "example_id", "prediction", exact_match("prediction", "answer").alias("score")
    )


@query("""select lang, count(*) as n, printf('%.2f%%', avg(n_chars) / max(n_chars) * 100) as filled
    from documents group by lang""")
def percent_text(spark, sf_dir):
    docs = fx.table(spark, sf_dir, "documents")
    return docs.groupBy("lang").agg(
        F.count(F.lit(1)).alias("n"),
        percent(F.avg("n_chars") / F.max("n_chars")).alias("filled"),
    )


_SHARE = """sum({v}) as total, coalesce(sum({v}) filter (where {f}), 0) as flagged,
    100::double * coalesce(sum({v}) filter (where {f}), 0) / nullif(sum({v}), 0) as percent"""


@query("select l_linestatus, " + _SHARE.format(v="l_quantity", f="l_returnflag = 'R'")
       + " from lineitem group by l_linestatus")
def flag_share_by(spark, sf_dir):
    items = fx.table(spark, sf_dir, "lineitem")
    return flag_share(items, "l_quantity", F.col("l_returnflag") == "R", by="l_linestatus")


@query("select " + _SHARE.format(v="length(text)::double", f="role = 'assistant'")
       + " from conversations")
def flag_share_total(spark, sf_dir):
    turns = fx.table(spark, sf_dir, "conversations")
    chars = F.char_length("text").cast("double")
    return flag_share(turns, chars, F.col("role") == "assistant")


# Reports ---------------------------------------------------------------------


@query(f"""with {scored_sql()}
    select example_id, 'User: ' || question || {NL} || 'e: ' || answer || {NL} || 'i: '
           || prediction || {NL} || repeat('-', 50) as report
    from scored order by {order_sql(19, 'example_id')}, example_id limit 10""")
def report_sample(spark, sf_dir):
    """Only the sampled examples are handed to the predictor."""
    examples = settle(fx.examples(spark, sf_dir))
    sample = settle(sample_n(examples, "example_id", 10, seed=19))
    return sample_report(_scored(sample, examples), 10, seed=19).select("example_id", "report")


@query(f"""select split, count(*) as n_rows, 'doc_id, text' as columns
    from ({split_sql(0.2, 23)}) group by split""")
def summarize_splits(spark, sf_dir):
    docs = fx.table(spark, sf_dir, "documents").select("doc_id", "text")
    return summarize(train_test_split(docs, "doc_id", 0.2, seed=23))


# Whole flows -----------------------------------------------------------------


@query(f"""with {EX}, ordered as (
        select *, row_number() over (order by {order_sql(29, 'example_id')}, example_id) as r from ex),
    cut as (select *, count(*) over () as n from ordered where r <= 100)
    select example_id, context, question, answer,
           case when r <= ceil(0.8 * n) then 'test' else 'train' end as split from cut""")
def dataset_flow(spark, sf_dir):
    path = scratch_dir(spark)
    examples = fx.examples(spark, sf_dir)
    n = min(100, examples.count())
    create_dataset(examples, n, 0.8, seed=29, path=path)
    return read_jsonl(spark, path, EXAMPLE_SCHEMA + ", split string")


# Ids of the rendered training text of each example, in token order.
TRAIN_IDS = f"""{EX},
texts as (select example_id, {turns_sql('context', 'question', 'answer')} as text from ex),
pos_tokens as (
    select example_id, unnest({tokens_sql('text')}) as token,
           generate_subscripts({tokens_sql('text')}, 1) as pos from texts),
ranked as (
    select token, {len(SPECIALS) - 1} + row_number() over (order by count(*) desc, token) as id
    from pos_tokens group by token),
train_ids as (
    select example_id, list_append(list(coalesce(id, {UNK}) order by pos), {EOS}) as ids
    from pos_tokens left join ranked using (token) group by example_id)
"""


def _train_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    examples = settle(fx.examples(spark, sf_dir))
    text = render_turns("context", "question", "answer")
    vocab = _vocab(examples.select(tokenize(text).alias("tokens")))
    return encoded_texts(examples, vocab, unknown=UNK, eos=EOS)


@query(f"""with {TRAIN_IDS}
    select example_id, len(ids) > 200 as was_truncated,
           array_to_string(list_slice(ids, 1, 200)
               || list_transform(range(greatest(200 - len(ids), 0)), lambda i: {PAD}), ',') as ids
    from train_ids""")
def training_rows_flow(spark, sf_dir):
    rows = training_rows(_train_ids(spark, sf_dir), 200, pad_id=PAD)
    return rows.select("example_id", "was_truncated", _joined("input_ids").alias("ids"))


@query(f"""with {EX}, texts as (select example_id, {turns_sql('context', 'question', 'answer')} as text from ex),
    ids as (select example_id, list_transform(string_split(text, ''), lambda c: unicode(c)) as ids from texts)
    select example_id, len(ids) + 2 > 300 as was_truncated,
           array_to_string(list_slice([2] || ids, 1, 299) || [1], ',') as ids from ids""")
def own_tokenizer_flow(spark, sf_dir):
    """Ids of a tokenizer that the user brings: here the code points of the text."""

    def factory():
        return lambda texts: [[ord(c) for c in t] for t in texts]

    encoded = encoded_texts(fx.examples(spark, sf_dir), factory, bos=2, eos=1)
    rows = training_rows(encoded, 300, keep_eos=1)
    return rows.select("example_id", "was_truncated", _joined("input_ids").alias("ids"))


@query(f"""with {TRAIN_IDS}, flat as (
        select example_id, unnest(ids) as id, generate_subscripts(ids, 1) as pos from train_ids),
    stream as (
        select id, row_number() over (
            order by {order_sql(31, 'example_id')}, example_id, pos) - 1 as idx from flat)
    select idx // 128 as block, string_agg(id::varchar, ',' order by idx) as ids
    from stream group by block having count(*) = 128""")
def training_blocks_flow(spark, sf_dir):
    blocks = training_blocks(settle(_train_ids(spark, sf_dir)), 128, seed=31)
    return blocks.select("block", _joined("labels").alias("ids"))
