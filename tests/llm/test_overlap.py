"""Groups of near copies, and how few pairs are compared to find them."""

from __future__ import annotations

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from barlake.llm import overlap, simhash
from barlake.llm.common import numbered_in
from tests.llm.test_corpus import prose


def edited(words: list[str], edits: int, r: random.Random) -> str:
    copy = list(words)
    for at in r.sample(range(2, len(copy) - 2), edits):
        copy[at] = f"new{r.random()}"
    return " ".join(copy)


@pytest.mark.parametrize("edits", [(3, 4, 5, 6), (1, 2, 3, 4, 5, 6)])
def test_a_large_group_of_edited_copies_is_not_compared_pair_by_pair(spark, monkeypatch, edits):
    r = random.Random(len(edits))
    words = prose(60, 31).split()
    texts = [" ".join(words)] + [edited(words, r.choice(edits), r) for _ in range(250)] + [prose(70, 500 + i) for i in range(20)]
    sets = [overlap.shingles(t) for t in texts]
    index = {x: i for i, x in enumerate(np.unique(np.concatenate(sets)).tolist())}
    has = np.zeros((len(sets), len(index)), dtype=np.float32)
    for i, s in enumerate(sets):
        has[i, [index[x] for x in s.tolist()]] = 1
    both, size = has @ has.T, has.sum(1)
    label = simhash.forest(len(texts), *np.nonzero(5 * both >= 4 * (size[:, None] + size[None] - both)))

    compared = []
    confirmed = overlap.confirmed

    def counting(pairs, *args):
        compared.append(pairs.count())
        return confirmed(pairs, *args)

    monkeypatch.setattr(overlap, "confirmed", counting)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id LONG, text STRING")
    assert sorted(x["doc_id"] for x in simhash.one_of_each(docs).collect()) == sorted(set(label.tolist()))
    assert sum(compared) < 10 * len(texts)  # of 31,375 pairs


def test_pipeline_of_nothing_and_of_odd_documents(spark, tmp_path):
    schema = "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG, row STRING, fp LONG, label STRING, tokens INT"
    rows = [(i, prose(80, 40 + i), None if i % 2 else "en", None, 1, "r", 2, "l", 3) for i in range(40)]
    rows += [(90, prose(30_000, 99), "en", "s", 1, "r", 2, "l", 3), (91, "", "en", "s", 1, "r", 2, "l", 3), (None, prose(90, 7), "en", "s", 1, "r", 2, "l", 3)]
    for name, given in (("none", []), ("odd", rows)):
        folder = tmp_path / name
        spark.createDataFrame(given, schema).write.parquet(str(folder / "documents.parquet"))
        found = corpus_pipeline.run(spark, str(folder))
        ids = {r["doc_id"] for r in found.select("doc_id").distinct().collect()}
        assert ids <= {r[0] for r in given} and 91 not in ids
        if given:
            assert ids >= set(range(40)) | {None}


def test_the_stage_takes_links_of_the_trie_join(spark, monkeypatch):
    r, words = random.Random(3), prose(900, 12).split()
    texts = [" ".join(words)] + [edited(words, 1, r) for _ in range(6)] + [prose(90, 70 + i) for i in range(20)]
    sims = np.array([simhash.majority(overlap.shingles(t)) for t in texts], dtype=np.uint64)
    label = simhash.forest(len(texts), *np.nonzero(np.bitwise_count(sims[:, None] ^ sims[None]) <= simhash.CLOSE))
    assert len(set(label[:7].tolist())) < 4 and len(set(label[7:].tolist())) == 20
    members = overlap.members
    monkeypatch.setattr(overlap, "members", lambda each: members(each).filter("false"))  # no bucket is shared
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id LONG, text STRING")
    assert sorted(x["doc_id"] for x in simhash.one_of_each(docs).collect()) == sorted(set(label.tolist()))


@pytest.mark.parametrize("budget", [1, 3, 4])
def test_links_of_other_budgets_against_all_pairs(spark, budget):
    r, keys = random.Random(budget), set()
    for _ in range(40):
        base = r.getrandbits(64)
        keys.update(base ^ sum(1 << b for b in r.sample(range(64), r.randint(0, 5))) for _ in range(8))
    cloud = r.getrandbits(64)
    keys.update(cloud ^ r.getrandbits(12) << 30 for _ in range(700))
    ks = np.array(sorted(keys), dtype=np.uint64)
    label = simhash.forest(len(ks), *np.nonzero(np.bitwise_count(ks[:, None] ^ ks[None, :]) <= budget))
    at = {k: i for i, k in enumerate(ks.view(np.int64).tolist())}
    edges = simhash.links(spark.createDataFrame(pd.DataFrame({"fp": ks.view(np.int64)})), 512, budget).collect()
    assert all(label[at[e["u"]]] == label[at[e["v"]]] for e in edges)
    tied = simhash.forest(len(ks), np.array([at[e["u"]] for e in edges]), np.array([at[e["v"]] for e in edges]))
    assert tied.tolist() == label.tolist()


def test_rows_chosen_by_number(spark):
    rows = spark.range(0, 70_000, 1, 3).withColumn("uid", F.monotonically_increasing_id())
    chosen = rows.filter("id % 7 = 3 or id = 0").select("uid")
    assert sorted(x["id"] for x in numbered_in(rows, chosen, "uid").collect()) == [i for i in range(70_000) if i % 7 == 3 or not i]
    assert numbered_in(rows, chosen.filter("false"), "uid").count() == 0
