"""Repaired conversations against dynamic programming over rows and states."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from sftprep.llm import repair

SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
SCHEMA = "conv_id long, turn long, role string, text string, cost string, block int"


def best_edits(rows):
    """Cost and audit; ``rows`` are letters as in the operator."""
    known = {(0, 0): (0, "")}

    def reach(node, label):
        if node not in known or label < known[node]:
            known[node] = label

    for at in range(len(rows) + 1):
        for _ in range(4):  # inserts can't be worth more than a round of the states
            for state in range(4):
                if (at, state) in known:
                    cost, audit = known[at, state]
                    reach((at, repair.NEXT[state]), (cost + 2, audit + "I"))
        if at == len(rows):
            break
        row = rows[at]
        for state in range(4):
            if (at, state) not in known:
                continue
            cost, audit = known[at, state]
            reach((at + 1, state), (cost + 3, audit + "D"))
            if row != "-":
                extra = int(row.isupper())
                to = repair.KEPT[row.lower()][state]
                if to is not None:
                    reach((at + 1, to), (cost + extra, audit + "K"))
                reach((at + 1, repair.NEXT[state]), (cost + 2 + extra, audit + "R"))
    return min(known[len(rows), s] for s in (0, 3) if (len(rows), s) in known)


def test_search_finds_the_least_audit():
    for n in range(4):
        for rows in itertools.product("suaxSUAX-", repeat=n):
            assert repair.cheapest("".join(rows), 0, repair.DONE) == best_edits("".join(rows))
    r = random.Random(3)
    for _ in range(1500):
        rows = "".join(r.choice("suaxSUAX--uaua") for _ in range(r.randint(4, 12)))
        assert repair.cheapest(rows, 0, repair.DONE) == best_edits(rows)


def test_every_audit_gives_legal_roles():
    r = random.Random(4)
    for _ in range(300):
        rows = "".join(r.choice("suaxSUA-") for _ in range(r.randint(0, 10)))
        roles = {"s": "system", "u": "user", "a": "assistant", "x": "tool", "-": "user"}
        texts = [(roles[c.lower()], "t") for c in rows]
        lines = repair.repaired_lines(rows, texts, 0, repair.cheapest(rows, 0, repair.DONE)[1])
        assert re.fullmatch("(s?(ua)+)?", "".join(line[0] for line in lines))


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        hit = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if hit == 1:
            text = ""
        if hit == 2:
            text = re.sub("[.!?]", "", text)
        out += [(conv, turn, "user" if hit == 4 else role, text)] * {0: 0, 3: 2}.get(hit, 1)
    return out


def brute(rows):
    hurt, out = damaged(rows), {}
    for conv in {r[0] for r in rows}:
        own = [r for r in hurt if r[0] == conv]
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        seen, codes, counts = set(), "", [0, 0, 0]
        for _, _, role, text in own:
            body, initial = text.strip(SPACE), role[:1] if role[:1] in ("s", "u", "a") else "x"
            fault = 0 if not body else 1 if (role, text) in seen else 2 if body[-1] not in ".!?" else None
            seen.add((role, text))
            if fault is not None:
                counts[fault] += 1
            codes += "-" if fault in (0, 1) else initial.upper() if fault == 2 else initial
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:], strict=False))
        turns = [r[1] for r in own if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        cost, audit = best_edits(codes)
        lines = repair.repaired_lines(codes, [r[2:] for r in own], 0, audit)
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv] = (gaps, *counts, illegal, cost, audit, digest)
    return out


def conversations():
    r = random.Random(6)
    texts = ["Hello.", "Why?", "cut off", " \n", "", "Yes!", "same text.", None]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "sys"]
    rows = []
    for conv in range(60):
        for turn in range(r.randint(1, 9)):
            rows.append((conv, turn + r.choice([0, 0, 0, 1]), r.choice(roles), r.choice(texts)))
    rows += [(100, i // 3, ["user", "assistant"][i % 2], f"t{i % 40}.") for i in range(130)]
    rows += [(None, None, None, None), (None, 1, "user", "Hi."), (None, None, "user", "Hi."), (101, None, "user", "x" * 100_000)]
    rows += [(102, 7, "assistant", "the same.")] * 30
    dropped = next(c for c in range(200, 400) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    return rows + [(dropped, 0, "user", "All of it goes.")]


@pytest.mark.parametrize("block", [1024, 16, 3])
def test_repaired(spark, folder, monkeypatch, block):
    monkeypatch.setattr(repair, "BLOCK", block)
    rows = conversations()
    table = spark.createDataFrame([(*r, "c", 1) for r in rows], SCHEMA).repartition(4)
    got = repair.repaired(table)
    assert got.columns[0] == "conv_id" and got.columns[-1] == "repaired_sha256"
    found = {r[0]: tuple(r[1:]) for r in got.collect()}
    want = brute(rows)
    assert found == want
    assert any(audit == "" and cost == 0 for *_, cost, audit, _ in want.values())


def test_no_rows(spark, folder):
    assert repair.repaired(spark.createDataFrame([], SCHEMA)).count() == 0
