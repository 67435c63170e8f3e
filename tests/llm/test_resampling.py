from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter
from zlib import crc32

from barlake.llm import resampling

WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def features(text: str | None) -> Counter:
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    found = re.findall(WORDS, low)
    runs = [" ".join(found[i : i + k]) for k in (1, 2, 3) for i in range(len(found) - k + 1)]
    return Counter(crc32(r.encode()) % 10000 for r in runs)


def expected(docs: list[tuple], target: list[str | None]) -> list[tuple]:
    each = [features(t) for _, t in docs]
    s, t = sum(each, Counter()), sum(map(features, target), Counter())
    big_s, big_t = s.total(), t.total()
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (big_s + 10000) / ((s[b] + 1) * (big_t + 10000))))
    rows = []
    for (doc_id, text), f in zip(docs, each):
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(gain(b) * n for b, n in f.items())
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, f.total(), weight, score, None])
    drawn = sorted((r for r in rows if r[1] >= 57), key=lambda r: (-r[3], r[0] is not None, r[0] or 0))  # 20 words: 57 features
    for i, r in enumerate(drawn[: len(drawn) * 5 // 100]):
        r[4] = i + 1
    return sorted(map(tuple, rows), key=repr)


def check(spark, docs, target):
    rows = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id LONG, text STRING, lines STRING, weight INT")
    aim = spark.createDataFrame([(t, 0) for t in target], "text STRING, doc_id INT")
    found = resampling.resampled(rows, aim)
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    got = sorted(map(tuple, found.collect()), key=repr)
    assert got == expected(docs, target)
    return got


def test_against_the_definition(spark):
    r = random.Random(1)
    vocabulary = ["alpha", "Béta", "GAMMA", "x1", "中文", "\x85", "don't", "a-b", "É", "7"]
    line = lambda: " ".join(r.choice(vocabulary) for _ in range(r.choice((0, 0, 1, 2, 3, 8, 20))))
    common = [line() for _ in range(12)]
    docs = [(i, "\n".join(r.choice(common) if r.random() < 0.5 else line() for _ in range(r.randint(0, 9)))) for i in range(300)]
    docs += [(1000, None), (1001, ""), (1002, "\n\n \r\n"), (None, "one two three\nfour"), (1003, "word " * 5000), docs[7], docs[7], (1004, "a\nb\nc\n\nd e\nf")]
    got = check(spark, docs, [line() + "\n" + line() for _ in range(20)] + [None, "", common[0]])
    assert sum(row[4] is not None for row in got) >= 8


def test_one_line_in_most_documents(spark):
    docs = [(i, f"the same line again\nown {i} " + "filler " * 20) for i in range(400)] + [(i, "the same line again\n" * 30) for i in range(400, 500)]
    check(spark, docs, ["own filler"])


def test_empty_tables(spark):
    assert check(spark, [], []) == [] and check(spark, [], ["a b"]) == []
    check(spark, [(1, "a b c")], [])
