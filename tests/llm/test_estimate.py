"""The estimate of the quality rules against a search from many random starts in plain NumPy."""

from __future__ import annotations

import json
import random

import numpy as np
import pandas as pd
import pytest

from barlake.llm import quality
from tests.llm.test_corpus import prose

D = quality.D


def refit(x: np.ndarray, chosen: np.ndarray, share: float) -> tuple[np.ndarray, np.ndarray]:
    part = x[chosen]
    return part.mean(0), np.cov(part.T, bias=True) * quality._consistency(share) + np.diag(np.square(quality.FLOORS))


def distances(x: np.ndarray, mean: np.ndarray, cov: np.ndarray) -> np.ndarray:
    return np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov), x - mean)


def search(x: np.ndarray, tries: int, seed: int) -> tuple[float, np.ndarray]:
    """Least log determinant of a half of the rows, and the last step's distances."""
    rng, h = np.random.default_rng(seed), (len(x) + D + 1) // 2
    best = (np.inf, None)
    for _ in range(tries):
        chosen = rng.choice(len(x), D + 1, replace=False)
        for _ in range(40):
            mean, cov = refit(x, chosen, h / len(x))
            again = np.argsort(distances(x, mean, cov), kind="stable")[:h]
            if set(again) == set(chosen):
                break
            chosen = again
        mean, cov = refit(x, chosen, h / len(x))
        best = min(best, (float(np.linalg.slogdet(cov)[1]), (mean, cov)), key=lambda b: b[0])
    limit = quality.chi2_quantile(0.975, D)
    within = np.flatnonzero(distances(x, *best[1]) <= limit)
    return best[0], distances(x, *refit(x, within, quality.chi2_cdf(limit, D)))


@pytest.mark.parametrize("n,bad,seed", [(60, 0, 1), (80, 20, 2), (300, 100, 3)])
def test_estimate_against_many_starts(spark, n, bad, seed):
    r = random.Random(seed)
    rows = [(i, prose(r.randint(50, 400), 7000 * seed + i), "en", "s") for i in range(n - bad)]
    rows += [(1000 + i, prose(r.randint(50, 90), 9000 * seed + i).replace(" ", r.choice((" ### ", "#"))) + " ok" * 40, "en", "s") for i in range(bad)]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING, lang STRING, source STRING")
    found = quality.document_verdicts(docs).toPandas().set_index("doc_id")
    used = [i for i, *_ in rows if not found.loc[i, "base_failed"]]
    counts = pd.DataFrame([quality.statistics(t) for i, t, *_ in rows if i in set(used)], columns=["n", "chars", "symbols", "dup", "repeat"])
    words, chars = counts["n"].clip(lower=1), counts["chars"].clip(lower=1)
    x = np.stack([np.log(words), chars / words, np.sqrt(counts["symbols"] / chars), np.sqrt(counts["dup"] / words), np.sqrt(counts["repeat"] / words)], 1)
    logdet, d2 = search(x, 200, seed)
    mine = found.loc[used, "distance2"].to_numpy()
    limit = quality.chi2_quantile(1 - quality.TAIL, D)
    assert ((mine > limit) == (d2 > limit)).all()
    assert np.allclose(mine, d2, rtol=0.15, atol=0.5)


def test_half_of_a_group_is_exact():
    bins = pd.DataFrame({"key": "k", "bin": [0, 1, 2], "n": [4, 10, 26]})
    for i in range(D):
        bins[f"s{i}"] = bins["n"] * [1.0, 3.0, 50.0]
    for i, j in quality.UPPER:
        bins[f"p{i}{j}"] = bins["n"] * [1.0, 9.0, 2500.0]
    fit = quality._refit(bins, None).iloc[0]
    # 23 of 40: four, ten and nine of the last bin
    assert fit["n"] == 40 and fit["mean"] == pytest.approx([(4 + 30 + 450) / 23] * D)
    assert json.dumps(quality._refit(bins, None, 1.0).iloc[0]["mean"]) == json.dumps([(4 + 30 + 1300) / 40] * D)
    assert quality.distance_bin(0) == 0
