from __future__ import annotations

import hashlib
import heapq
import itertools
import random
import re
from zlib import crc32

import pytest

from barlake.llm import repair

SOME = re.compile(r"[^\x20\x09-\x0D]")
SCHEMA = "conv_id LONG, turn LONG, role STRING, text STRING, at INT, edit STRING"


def damaged(rows: list[tuple]) -> list[tuple]:
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        n = crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if n == 1 else re.sub("[.!?]", "", text) if n == 2 else text
        out += [(conv, turn, "user" if n == 4 else role, text)] * {0: 0, 3: 2}.get(n, 1)
    return out


def repaired(rows: list[tuple]) -> tuple:
    """The cheapest edits by searching all lists of edits in order of cost, then of initials."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
    faults, seen = [], set()
    for _, _, role, text in rows:
        shown = SOME.findall(text)
        faults.append("blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else None)
        seen.add((role, text))
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, state, lines = heapq.heappop(heap)
        if i == len(rows) and (state == "" or state[-1] == "a"):
            break
        if (i, state) in done:
            continue
        done.add((i, state))
        new = "a" if state == "u" else "u"
        name = {"a": "assistant", "u": "user"}[new]
        heapq.heappush(heap, (cost + 3, audit + "I", i, new, (*lines, f"{name}:")))
        if i == len(rows):
            continue
        heapq.heappush(heap, (cost + 4, audit + "D", i + 1, state, lines))
        if faults[i] in ("blank", "duplicate"):
            continue
        more = 3 if faults[i] else 0
        _, _, role, text = rows[i]
        heapq.heappush(heap, (cost + 3 + more, audit + "R", i + 1, new, (*lines, f"{name}:{text}")))
        first = role[:1]
        if first == new or (state == "" and first == "s"):
            heapq.heappush(heap, (cost + more, audit + "K", i + 1, first, (*lines, f"{role}:{text}")))
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    return (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def check(spark, rows: list[tuple]):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(5)
    found = {r["conv_id"]: tuple(r)[1:] for r in repair.digests(df, repair.edits(repair.damaged(df))).collect()}
    groups: dict = {r[0]: [] for r in rows}
    for r in damaged(rows):
        groups[r[0]].append(r)
    assert found == {conv: repaired(group) for conv, group in groups.items()}
    return found


def conversations(seed: int, n: int, most: int) -> list[tuple]:
    r = random.Random(seed)
    texts = ["Yes.", "No!", "Why?", "cut", "cut off ", "", " \n", "\x85", None, "É. \t"]
    rows = []
    for conv in range(n):
        for turn in range(r.randint(1, most)):
            role = r.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "User"]) if r.random() < 0.6 else ["user", "assistant"][turn % 2]
            rows.append((conv, None if r.random() < 0.05 else turn * r.choice((1, 1, 2)), role, r.choice(texts) if r.random() < 0.6 else f"Text {r.random()}."))
    return rows


def test_against_search(spark):
    rows = conversations(3, 250, 9)
    rows += [(None, 0, "user", "Hi."), (None, 1, "assistant", "Ho."), (900, None, None, None), (901, 1, "system", "x" * 200_000 + "."), (901, 2, "user", "y")]
    rows += [(902, 5, "user", "Same.")] * 40
    check(spark, rows)
    assert check(spark, []) == {}


@pytest.mark.parametrize("bits", [0, 2])
def test_conversations_over_many_blocks(spark, bits, monkeypatch):
    monkeypatch.setattr(repair, "BLOCK_BITS", bits)
    check(spark, conversations(4, 12, 90))


def test_whole_conversation_dropped(spark):
    conv = next(c for c in itertools.count() if crc32(f"{c}:0".encode()) % 20 == 0)
    found = check(spark, [(conv, 0, "user", "Hi."), (conv + 1, 0, "user", "Hi.")])
    assert found[conv] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_edits_are_the_repaired_turns(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "assistant", "Hello."), (1, 2, "user", "And"), (2, 0, "user", "Hi.")]
    found = repair.edits(spark.createDataFrame(rows, "conv_id LONG, turn LONG, role STRING, text STRING")).orderBy("at", "step").collect()
    assert all((r["edit"] == "D") == (r["text"] is None) and (r["edit"] == "I") == (r["was"] is None) for r in found)
    for conv in (1, 2):
        initials = "".join(r["role"][0] for r in found if r["conv_id"] == conv and r["edit"] != "D")
        assert re.fullmatch("(s?(ua)+)?", initials)


def test_walks_store_few_vectors_and_are_the_least(spark):
    r = random.Random(5)
    for n in (0, 1, 2, 7, 30, 200):
        codes = "".join(r.choice("suaobdSUAO") for _ in range(n)) + repair.END
        (letters, state), = repair.walks(codes, (0, 0, 0, 0), [repair.START])
        vector = (0, 0, 0, 0)
        for code in reversed(codes):
            vector = repair.before(code, vector)
        cost, rest = 0, iter(codes)
        for letter in letters:
            code = next(rest) if letter != "I" else ""
            cost += {"K": 0, "R": 3, "D": 4, "I": 3}[letter] + (3 if code.isupper() and letter != "D" else 0)
        assert cost == vector[repair.START] and state in (repair.START, repair.ASSISTANT)
