"""Operator 12: repairing the structure of conversations by cheapest edits.

A conversation's rows, in the order of their turns, are edited so that the initials of
their roles are ``(s?(ua)+)?``: nothing, or an optional system row and then pairs of user
and assistant.  Edits, with the letters of the audit: Keep a row (free), Rerole it to
user or assistant (2), Delete it (3; blank and duplicate rows have to go), Insert an empty
user or assistant row (2); a truncated row that stays costs 1 more.  Of the cheapest audits
the least in the order of its letters is taken.

*Lattice.*  A node is a number of rows done and a state: nothing yet, after the system row,
after a user, after an assistant.  Edits are its edges, never of negative cost.  Dijkstra's
search runs from the beginning and from the end at once, always on the side whose next
node is nearer; each node keeps its cost and the least audit of that cost, which is final
when the node leaves the heap.  When the two heaps' least costs together exceed the best
crossing found, all crossings of that cost are known, and the least concatenated audit
is the answer.

*Long conversations.*  Rows are numbered in one order of all conversations and dealt into
blocks of ``BLOCK`` neighbours, which are the units of work, so a conversation of any
length is spread over tasks.  One that crosses the border of blocks is searched piece by
piece, from each state to each; the pieces' costs are then added up from the end.  Inserts
between two pieces belong to the second, so the audits of a piece from one state are never
a part of each other, and their order decides among equal costs.  Only the audit itself,
one value by nature, and the hash of the repaired text, which is a stream, are made in
one task for each conversation that crosses a border; the stream is never held whole.

Defined results: nulls in role and text count as one space, and so do nulls in the hashed
name of a row; a null conversation is one conversation; null turns come first; rows of
one turn are ordered by role and text; a role that is empty or starts with another letter
than s, u and a has to be changed; a conversation without rows has zeros, an empty audit
and the hash of the empty text; an empty table has no rows.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sftprep.llm.common import null_safe
from sftprep.operators.positions import numbered
from sftprep.sources.scratch import settle

#: Rows of a block.
BLOCK = 1024
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: States: nothing yet, after the system row, after a user, after an assistant.
STATES, DONE = 4, 4
#: Where a kept row of a role leads from each state (None: nowhere).
KEPT = {"s": (1, None, None, None), "u": (2, 2, None, 2), "a": (None, None, 3, None), "x": (None,) * 4}
#: Where an inserted or changed row leads: the only role that may follow a state.
NEXT = (2, 2, 3, 2)
NAMES = {2: "user", 3: "assistant"}
ACCEPTED = (0, 3)

Label = tuple[int, str]
Node = tuple[int, int]


def edges(rows: str, node: Node, last: bool) -> Iterator[tuple[int, str, Node]]:
    """Cost, letter and end of the edits at a node.

    A row is a letter of ``KEPT`` (upper case: truncated) or ``-``, which has to go.  After
    the last row rows are only inserted if it is the conversation's ``last``.
    """
    at, state = node
    if at < len(rows):
        row = rows[at]
        yield DELETE, "D", (at + 1, state)
        if row != "-":
            extra = TRUNCATED if row.isupper() else 0
            to = KEPT[row.lower()][state]
            if to is not None:
                yield KEEP + extra, "K", (at + 1, to)
            yield REROLE + extra, "R", (at + 1, NEXT[state])
    if at < len(rows) or last:
        yield INSERT, "I", (at, NEXT[state])


def reversed_edges(rows: str, node: Node, last: bool) -> Iterator[tuple[int, str, Node]]:
    """The same by the node where they end: cost, letter and start."""
    at, state = node
    before = [(at - 1, s) for s in range(STATES)] if at else []
    inserted = [(at, s) for s in range(STATES) if NEXT[s] == state]
    for start in before + inserted:
        for cost, letter, end in edges(rows, start, last):
            if end == node:
                yield cost, letter, start


def cheapest(rows: str, entry: int, exit_: int) -> Label | None:
    """Cost and audit of the cheapest edits of ``rows`` from a state to a state.

    ``DONE`` as the exit stands for the end of the conversation in an accepted state.
    """
    last = exit_ == DONE
    ends = ACCEPTED if last else (exit_,)
    ahead: dict[Node, Label] = {(0, entry): (0, "")}
    back: dict[Node, Label] = {(len(rows), s): (0, "") for s in ends}
    # of nodes with one cost the ones that free edges come from go first
    heaps = ([(0, 0, (0, entry))], [(0, 0, node) for node in back])
    settled: tuple[set[Node], set[Node]] = (set(), set())
    best = min((back[n][0] for n in ahead if n in back), default=None)
    while heaps[0] and heaps[1] and (best is None or heaps[0][0][0] + heaps[1][0][0] <= best):
        side = 0 if heaps[0][0][0] <= heaps[1][0][0] else 1
        own, other = (ahead, back) if side == 0 else (back, ahead)
        cost, _, node = heapq.heappop(heaps[side])
        if node in settled[side]:
            continue
        settled[side].add(node)
        audit = own[node][1]
        for step, letter, to in (edges, reversed_edges)[side](rows, node, last):
            found = (cost + step, audit + letter if side == 0 else letter + audit)
            known = own.get(to)
            if known is None or found < known:
                own[to] = found
                if known is None or found[0] < known[0]:
                    heapq.heappush(heaps[side], (found[0], to[0] if side == 0 else -to[0], to))
                if to in other and (best is None or found[0] + other[to][0] < best):
                    best = found[0] + other[to][0]
    if best is None:
        return None
    met = [n for n in ahead if n in back and ahead[n][0] + back[n][0] == best]
    return best, min(ahead[n][1] + back[n][1] for n in met)


def repaired_lines(
    rows: str, texts: list[tuple[str, str]], state: int, audit: str
) -> list[str]:
    """The lines ``role:text`` that the edits of an audit make of a piece."""
    lines, at = [], 0
    for letter in audit:
        if letter == "I":
            state = NEXT[state]
            lines.append(NAMES[state] + ":")
            continue
        role, text = texts[at]
        if letter == "K":
            state = KEPT[rows[at].lower()][state]
        elif letter == "R":
            state = NEXT[state]
            role = NAMES[state]
        if letter != "D":
            lines.append(f"{role}:{text}")
        at += 1
    return lines


def damaged(rows: DataFrame) -> DataFrame:
    """Rows (conv, turn, role, text) with the faults that their names' hash gives them."""
    space = F.lit(" ")
    name = F.concat(
        F.coalesce(F.col("conv").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space)
    )
    hit = F.crc32(name.cast("binary")) % 20
    text, role = F.coalesce("text", space), F.coalesce("role", space)
    hurt = rows.select(
        "conv",
        "turn",
        F.when(hit == 4, "user").otherwise(role).alias("role"),
        F.when(hit == 1, "").when(hit == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        hit.alias("_hit"),
    )
    return hurt.where("_hit <> 0").select(
        "conv", "turn", "role", "text", F.explode(F.when(F.col("_hit") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")
    )


def coded(rows: DataFrame) -> DataFrame:
    """Rows numbered in the order of conversations and turns, with block, code and fault.

    ``code`` is the row's letter for ``edges``, ``first`` its initial's.
    """
    order = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text", "copy"]
    laid = numbered(rows, order, "position")
    # a group of equal rows is one after each task's part of the count
    same = [F.col("conv").alias("conv"), F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256).alias("same")]
    firsts = laid.select(*same, "position").groupBy("conv", "same").agg(F.min("position").alias("position"))
    firsts = firsts.select("position", F.lit(True).alias("is_first"))
    last = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*$", 1)
    fault = (
        F.when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), "blank")
        .when(F.col("is_first").isNull(), "duplicate")
        .when(~last.isin(".", "!", "?"), "truncated")
    )
    initial = F.substring("role", 1, 1)
    first = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    code = F.when(F.col("fault").isin("blank", "duplicate"), "-").when(F.col("fault") == "truncated", F.upper("first"))
    found = laid.join(firsts, "position", "left").withColumns({"fault": fault, "first": first})
    return found.withColumns({"code": F.coalesce(code, "first"), "block": F.expr(f"position div {BLOCK}")}).drop("is_first")


def _of_pieces(table: pa.Table) -> Iterator[tuple[object, int, int]]:
    """Conversation, first and last row (excluded) of each piece of a block in order."""
    conv = table.column("conv").to_pylist()
    first = 0
    for at in range(1, len(conv) + 1):
        if at == len(conv) or conv[at] != conv[first]:
            yield conv[first], first, at
            first = at


_LEGAL = {"su", "ua", "au"}


def _searching(conv_type: pa.DataType) -> Callable[[pa.Table], pa.Table]:
    """Costs and audits of the pieces of a block."""
    known: dict[tuple[str, int, int], Label | None] = {}

    def search(rows: str, entry: int, exit_: int) -> Label | None:
        name = (rows, entry, exit_)
        if name not in known:
            if len(known) > 20_000:
                known.clear()
            known[name] = cheapest(rows, entry, exit_)
        return known[name]

    def pieces(table: pa.Table) -> pa.Table:
        table = table.sort_by("position")
        codes, firsts = table.column("code").to_pylist(), table.column("first").to_pylist()
        faults, turns = table.column("fault").to_pylist(), table.column("turn").to_pylist()
        block, of = table.column("block")[0].as_py(), table.num_rows
        out: list[tuple] = []
        for conv, low, high in _of_pieces(table):
            rows = "".join(codes[low:high])
            counts = [faults[low:high].count(f) for f in ("blank", "duplicate", "truncated")]
            illegal = sum(a + b not in _LEGAL for a, b in zip(firsts[low : high - 1], firsts[low + 1 : high], strict=True))
            numbers = [t for t in turns[low:high] if t is not None]
            ends = (min(numbers), max(numbers), len(set(numbers))) if numbers else (None, None, 0)
            facts = (conv, block, *counts, illegal, *ends, firsts[low], firsts[high - 1])
            whole = low > 0 and high < of
            for entry in (0,) if whole else range(STATES):
                found = [(exit_, search(rows, entry, exit_)) for exit_ in ((DONE,) if whole else range(STATES + 1))]
                for exit_, label in found:
                    if label is not None:
                        out.append((*facts, entry, exit_, *label, whole))
        columns = list(zip(*out, strict=True)) if out else [[]] * 15
        long, text = pa.int64(), pa.string()
        types = [conv_type, long, *[long] * 4, long, long, long, text, text, long, long, long, text, pa.bool_()]
        return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], _PIECE)

    return pieces


_PIECE = [
    "conv", "block", "blank", "duplicate", "truncated", "illegal", "least", "most", "turns", "head", "tail",
    "entry", "exit", "cost", "audit", "whole",
]
_FACTS = "blank long, duplicate long, truncated long, illegal long, least long, most long, turns long"


def _joining(conv_type: pa.DataType) -> Callable[[pa.Table], pa.Table]:
    """The pieces of one conversation that crosses blocks: each one's entry and audit."""

    def join(table: pa.Table) -> pa.Table:
        pieces: dict[int, dict[tuple[int, int], Label]] = {}
        facts: dict[int, dict] = {}
        for row in table.to_pylist():
            pieces.setdefault(row["block"], {})[row["entry"], row["exit"]] = (row["cost"], row["audit"])
            facts[row["block"]] = row
        blocks = sorted(pieces)
        rest: dict[int, tuple[int, int]] = {}  # by state: cost to the end, next state
        plan = []
        for n, block in enumerate(reversed(blocks)):
            found: dict[int, tuple[int, str, int]] = {}
            for (entry, exit_), (cost, audit) in pieces[block].items():
                if n == 0 and exit_ == DONE:
                    choice = (cost, audit, exit_)
                elif n and exit_ in rest:
                    choice = (cost + rest[exit_][0], audit, exit_)
                else:
                    continue
                found[entry] = min(found.get(entry, choice), choice)
            rest = {entry: (cost, exit_) for entry, (cost, _, exit_) in found.items()}
            plan.append(rest)
        plan.reverse()
        out, state, before = [], 0, None
        for block, step in zip(blocks, plan, strict=True):
            fact = facts[block]
            cost, audit = pieces[block][state, step[state][1]]
            illegal, turns = fact["illegal"], fact["turns"]
            if before is not None:
                illegal += before["tail"] + fact["head"] not in _LEGAL
                turns -= before["most"] is not None and before["most"] == fact["least"]
            out.append(
                (fact["conv"], block, fact["blank"], fact["duplicate"], fact["truncated"], illegal,
                 fact["least"], fact["most"], turns, state, cost, audit, len(blocks) == 1)
            )
            state, before = step[state][1], fact
        long = pa.int64()
        types = [conv_type, long, *[long] * 7, long, long, pa.string(), pa.bool_()]
        names = [c for c in _PIECE if c not in ("head", "tail", "exit")]
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)

    return join


def _writing(conv_type: pa.DataType) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The repaired lines of a block's pieces: a hash for whole conversations, else the text."""

    def write(rows: pa.Table, plans: pa.Table) -> pa.Table:
        rows = rows.sort_by("position")
        codes = rows.column("code").to_pylist()
        texts = list(zip(rows.column("role").to_pylist(), rows.column("text").to_pylist(), strict=True))
        by_conv = {p["conv"]: p for p in plans.to_pylist()}
        out = []
        for conv, low, high in _of_pieces(rows):
            plan = by_conv[conv]
            lines = repaired_lines("".join(codes[low:high]), texts[low:high], plan["entry"], plan["audit"])
            text = "\n".join(lines)
            whole = plan["whole"]
            out.append((conv, plan["block"], hashlib.sha256(text.encode()).hexdigest() if whole else None, None if whole else text))
        types = [conv_type, pa.int64(), pa.string(), pa.string()]
        columns = zip(*out, strict=True) if out else [[]] * 4
        return pa.table([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], ["conv", "block", "sha", "text"])

    return write


def _hashing(conv_type: pa.DataType) -> Callable:
    """One hash for each conversation of a task, from its pieces in order; one piece is held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, hasher, empty = None, None, True

        def out() -> pa.RecordBatch:
            return pa.record_batch([pa.array([conv], conv_type), pa.array([hasher.hexdigest()])], ["conv", "sha"])

        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if hasher is None or name != conv:
                    if hasher is not None:
                        yield out()
                    conv, hasher, empty = name, hashlib.sha256(), True
                piece = text.as_py().encode()
                if piece:  # a line is never empty
                    hasher.update(piece if empty else b"\n" + piece)
                    empty = False
        if hasher is not None:
            yield out()

    return run


def repaired(
    rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    damage: Callable[[DataFrame], DataFrame] = damaged,
) -> DataFrame:
    """Per conversation: its name, gaps, blank, duplicate, truncated, illegal, cost, audit and
    repaired_sha256.

    ``damage`` prepares the rows (conv, turn, role, text, copy).
    """
    from pyspark.sql.pandas.types import to_arrow_type

    named = rows.select(
        F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), F.col(role).alias("role"), F.col(text).alias("text")
    )
    conv_field = named.schema["conv"].dataType
    kind, conv_type = conv_field.simpleString(), to_arrow_type(conv_field)
    done = settle(coded(damage(named)))
    small = done.select("conv", "turn", "position", "block", "code", "first", "fault")
    found = settle(
        small.groupBy("block").applyInArrow(
            _searching(conv_type),
            f"conv {kind}, block long, {_FACTS}, head string, tail string,"
            " entry long, exit long, cost long, audit string, whole boolean",
        )
    )
    plan_schema = f"conv {kind}, block long, {_FACTS}, entry long, cost long, audit string, whole boolean"
    parts = found.where("not whole").groupBy("conv").applyInArrow(_joining(conv_type), plan_schema)
    plans = settle(found.where("whole").select(parts.columns).unionByName(parts))

    texts = done.select("conv", "position", "block", "code", "role", "text").groupBy("block")
    wanted = plans.select("conv", "block", "entry", "audit", "whole").groupBy("block")
    written = settle(
        texts.cogroup(wanted).applyInArrow(_writing(conv_type), f"conv {kind}, block long, sha string, text string")
    )
    pieces = written.where("text is not null").repartition("conv").sortWithinPartitions("conv", "block")
    streamed = pieces.select("conv", "text").mapInArrow(_hashing(conv_type), f"conv {kind}, sha string")
    hashes = written.where("sha is not null").select("conv", "sha").unionByName(streamed)

    in_order = F.sort_array(F.collect_list(F.struct("block", "audit")))
    facts = plans.groupBy("conv").agg(
        F.coalesce(F.max("most") - F.min("least") + 1 - F.sum("turns"), F.lit(0)).alias("gaps"),
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")],
        F.array_join(F.transform(in_order, lambda p: p["audit"]), "").alias("audit"),
    )
    every = named.select("conv").distinct()
    whole = null_safe(null_safe(every, facts, ["conv"], "left"), hashes, ["conv"], "left")
    numbers = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = hashlib.sha256(b"").hexdigest()
    return whole.select(
        F.col("conv").alias(conv), *numbers, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha", F.lit(nothing)).alias("repaired_sha256"),
    )
