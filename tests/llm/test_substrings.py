from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from barlake.llm import recompression, substrings


def expected(docs: list[tuple], width: int) -> list[tuple]:
    texts = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in docs]
    windows = Counter(tuple(t[i : i + width]) for t in texts for i in range(len(t) - width + 1))
    out = []
    for (doc_id, _), t in zip(docs, texts):
        gone = {j for i in range(len(t) - width + 1) if windows[tuple(t[i : i + width])] > 1 for j in range(i, i + width)}
        kept = " ".join(w for j, w in enumerate(t) if j not in gone)
        out.append((doc_id, len(t), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def check(spark, docs, width=substrings.WIDTH):
    rows = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id LONG, text STRING, keys STRING, n INT").repartition(3)
    found = substrings.repeats(rows, width).collect()
    assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in found), key=repr) == expected(docs, width)
    for r in found:
        assert sum(s["end"] - s["first"] for s in r["removed"]) == r["n_removed"]


def corpus(seed: int, n: int, vocabulary: int) -> list[tuple]:
    r = random.Random(seed)
    word = lambda: f"w{int(r.paretovariate(0.7)) % vocabulary}"
    passages = [[word() for _ in range(r.randint(30, 90))] for _ in range(6)]
    docs = []
    for i in range(n):
        text = []
        for _ in range(r.randint(0, 4)):
            text += [word() for _ in range(r.randint(0, 60))] if r.random() < 0.6 else r.choice(passages)[r.randint(0, 4) :]
        if docs and r.random() < 0.2:  # an edited copy
            text = r.choice(docs)[1].split()
            for _ in range(r.randint(0, 3)):
                if text:
                    text[r.randrange(len(text))] = word()
        docs.append((i, " ".join(text)))
    return docs


@pytest.mark.parametrize("vocabulary", [3, 50, 100_000])
def test_against_the_definition(spark, vocabulary):
    docs = corpus(vocabulary, 150, vocabulary)
    docs += [(900, None), (901, ""), (902, " \n\t"), (None, "x " * 40), (903, "x " * 3000), (904, "a b " * 100), (905, "É\x1c中 " * 35), docs[3], docs[3]]
    check(spark, docs)


def test_short_windows_and_hot_passages(spark):
    check(spark, corpus(9, 120, 40), 7)
    passage = " ".join(f"p{i}" for i in range(50))
    copy = " ".join(f"c{i}" for i in range(60))
    docs = [(i, f"own{i} text{i} {passage} end{i}") for i in range(300)] + [(1000 + i, copy) for i in range(300)] + [(2000, f"before {copy} after")]
    docs += [(3000 + i, " ".join(f"u{i}.{j}" for j in range(200))) for i in range(40)]
    check(spark, docs)


def test_empty_tables(spark):
    check(spark, [])
    check(spark, [(1, "a"), (2, None)])


def test_equal_windows_have_equal_keys_at_equal_offsets():
    r = random.Random(1)
    for vocabulary in (2, 3, 20, 1000):
        words = np.array([r.getrandbits(63) for _ in range(vocabulary)], dtype=np.uint64)
        passages = [[r.randrange(vocabulary) for _ in range(60)] for _ in range(3)] + [[0] * 60, [0, 1] * 30]
        texts = []
        for _ in range(40):
            texts.append([r.randrange(vocabulary) for _ in range(r.randint(0, 9))] + r.choice(passages)[r.randint(0, 9) :] + [r.randrange(vocabulary) for _ in range(r.randint(0, 9))])
        flat = np.array([w for t in texts for w in t])
        opens = np.zeros(len(flat), dtype=bool)
        opens[np.cumsum([0, *map(len, texts[:-1])])] = True
        for width in (7, 35):
            at, keys, places = recompression.window_keys(words[flat], opens, width, 6)
            assert len(at) == sum(max(0, len(t) - width + 1) for t in texts)
            seen: dict = {}
            for a, k, p in zip(at.tolist(), keys.tolist(), places.tolist()):
                assert 0 <= p - a < width
                assert seen.setdefault(tuple(flat[a : a + width]), (k, p - a)) == (k, p - a)
