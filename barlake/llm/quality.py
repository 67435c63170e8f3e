"""Quality rules: robust multivariate outliers of text statistics.

Every document gets a vector of transformed statistics (``FEATURES``).  For each language and
source the minimum covariance determinant is estimated over all documents that pass the base
rules: concentration steps refit mean and covariance on the half of the documents nearest to the
present centre until the determinant stops falling.  They start from the documents nearest to the medians by
quartile ranges, from ``STARTS`` shares of them, and of the ends the one of the least determinant counts.  A last
step refits on all that lie within the 97.5 % quantile.  A document
is rejected when its squared Mahalanobis distance is beyond the chi-square quantile for
``TAIL``.  ``FLOORS`` are standard deviations that are added to every estimate, so that a
statistic that hardly varies in a group (no symbols at all, say) rejects nobody for a trifle.  Both were chosen
on the labelled documents of the small tables: floors of about the spread of each statistic in clean prose, and
a tail far in the gap between the largest distance of a good one and the least of a bad one.

A step is one aggregation: moments by group and distance bin, added up from the nearest bin
until half the group is covered; the last bin, a few hundredths of the group at most, enters with the share
that makes it half.  Nothing but one row per group and bin is gathered, so a group
that holds a third of all documents costs no more than any other, and nothing passes through
the driver.  Groups of fewer than ``LEAST_GROUP`` documents that pass the base rules are
judged by the estimate of their language, small languages by that of the whole table; these are
fitted to all such documents of the language or table, those of large groups too.  A table with
fewer than ``LEAST_FIT`` usable documents has no estimate, and the base rules alone decide.

Null texts have no words and fail the base rules, as empty ones do; null languages and sources
are groups of their own; repeated rows count as often as they occur; an empty table gives an
empty result; texts of any length are read whole, one at a time in a task's memory; extra columns are carried
along whatever their names."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.llm.common import on_workers, saved

LEAST_WORDS = 50
REPEAT_SHARE = 50  # percent of words
SYMBOLS = b"#*$%&|<>"

FEATURES = ("words", "word_length", "symbols", "dup_lines", "repeats")
FLOORS = (0.4, 0.3, 0.025, 0.1, 0.15)
TAIL = 1e-9
LEAST_GROUP = 50
LEAST_FIT = 30
STEPS = 12
BINS_PER_OCTAVE = 32
#: Shares of a group, nearest to its medians, that the steps start from.
STARTS = (0.5, 0.25, 1.0)

STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def statistics(text: str) -> tuple[int, int, int, int, int]:
    """The five counts of a whole text."""
    data = text.encode()
    words = data.split()
    n = len(words)
    if not n:
        return 0, 0, sum(data.count(s) for s in SYMBOLS), 0, 0
    chars = len(text) - sum(map(text.count, " \t\n\v\f\r"))
    lines = [line for line in data.split(b"\n") if line.strip()]
    return n, chars, sum(data.count(s) for s in SYMBOLS), len(lines) - len(set(lines)), repeated(words)


def repeated(words: list[bytes]) -> int:
    """Words that lie in a three-word window found at least twice."""
    n = len(words)
    if n < 4:
        return 0
    number: dict[bytes, int] = {}
    a = np.array([number.setdefault(w, len(number)) for w in words], dtype=np.int64)
    _, two = np.unique(a[:-1] * len(number) + a[1:], return_inverse=True)  # below n**2, then below n * n
    _, place, times = np.unique(two[:-1] * len(number) + a[2:], return_inverse=True, return_counts=True)
    again = np.concatenate([times[place] > 1, [False, False]])
    covered = again.copy()
    covered[1:] |= again[:-1]
    covered[2:] |= again[:-2]
    return int(covered.sum())


def text_statistics(text: Column) -> Column:
    """Struct of the five counts; null counts as empty."""

    @F.pandas_udf(STATS)
    def run(texts: pd.Series) -> pd.DataFrame:
        names = [c.split()[0] for c in STATS.split(", ")]
        return pd.DataFrame([statistics(t) for t in texts], columns=names, dtype="int64")

    return run(F.coalesce(text.cast("string"), F.lit("")))


def _features(s: str) -> list[Column]:
    n, chars = F.greatest(F.col(f"{s}.n_words"), F.lit(1)), F.greatest(F.col(f"{s}.word_chars"), F.lit(1))
    return [
        F.log(n.cast("double")),
        chars / n,
        F.sqrt(F.col(f"{s}.n_symbols") / chars),
        F.sqrt(F.col(f"{s}.n_dup_lines") / n),
        F.sqrt(F.col(f"{s}.n_repeat_words") / n),
    ]


def chi2_cdf(x: float, k: int) -> float:
    """Chi-square distribution with ``k`` degrees of freedom, by the series of the incomplete gamma function."""
    if x <= 0:
        return 0.0
    a, half = k / 2, x / 2
    term = total = 1 / a
    i = 0
    while term > total * 1e-16:
        i += 1
        term *= half / (a + i)
        total += term
    return min(1.0, total * math.exp(-half + a * math.log(half) - math.lgamma(a)))


def chi2_quantile(p: float, k: int) -> float:
    low, high = 0.0, 1e3
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_cdf(mid, k) < p else (low, mid)
    return high


D = len(FEATURES)
UPPER = [(i, j) for i in range(D) for j in range(i, D)]
FIT = "key string, n long, mean array<double>, inverse array<double>, logdet double"


def _fit(key: str, n: int, mean: np.ndarray, cov: np.ndarray) -> pd.DataFrame:
    cov = cov + np.diag(np.square(FLOORS))
    inverse = np.linalg.inv(cov)
    row = [key, n, mean.tolist(), [float(inverse[i, j]) for i, j in UPPER], float(np.linalg.slogdet(cov)[1])]
    return pd.DataFrame([row], columns=[c.split()[0] for c in FIT.split(", ")])


def _consistency(share: float) -> float:
    """Makes the covariance of the nearest ``share`` of normal data the covariance of all of it."""
    if share >= 1:
        return 1.0
    return share / max(chi2_cdf(chi2_quantile(share, D), D + 2), 1e-9)


def _refit(bins: pd.DataFrame, within: float | None, nearest: float = 0.5) -> pd.DataFrame:
    """Bins of one group to its next estimate: the ``nearest`` part of it, or all up to distance ``within``."""
    bins = bins.sort_values("bin")
    n = bins["n"].to_numpy(dtype=np.float64)
    total = int(n.sum())
    if within is None:
        wanted = max(D + 1, (total + D + 1) // 2 if nearest == 0.5 else round(total * nearest))
        use = np.clip(wanted - (np.cumsum(n) - n), 0, n) / n  # the part of each bin
    else:
        use = (bins["bin"].to_numpy() <= distance_bin(within)).astype(np.float64)
        if not use.any():
            use[:1] = 1
    m = (n * use).sum()
    mean = np.array([(bins[f"s{i}"].to_numpy() * use).sum() for i in range(D)]) / m
    cov = np.zeros((D, D))
    for i, j in UPPER:
        cov[i, j] = cov[j, i] = (bins[f"p{i}{j}"].to_numpy() * use).sum() / m - mean[i] * mean[j]
    share = m / total if within is None else chi2_cdf(within, D)
    return _fit(bins["key"].iloc[0], total, mean, cov * _consistency(share))


def _first(bins: pd.DataFrame) -> pd.DataFrame:
    """Histogram of each statistic of one group to medians and quartile ranges."""
    mean, scale = [], []
    for i in range(D):
        part = bins[bins["i"] == i].sort_values("bin")
        total, up = part["n"].sum(), part["n"].cumsum().to_numpy()
        q1, q2, q3 = (part["bin"].to_numpy()[np.searchsorted(up, total * q)] / HISTOGRAM for q in (0.25, 0.5, 0.75))
        mean.append(q2)
        scale.append((q3 - q1) / 1.349)
    total = int(bins[bins["i"] == 0]["n"].sum())
    return _fit(bins["key"].iloc[0], total, np.array(mean), np.diag(np.square(scale)))


#: Bins per unit of a statistic, for the starting medians.
HISTOGRAM = 64


def distance_bin(d2: float) -> int:
    return math.floor(math.log2(1 + d2) * BINS_PER_OCTAVE)


def _distance() -> Column:
    """Squared Mahalanobis distance of ``x`` under the joined estimate."""
    total = F.lit(0.0)
    for k, (i, j) in enumerate(UPPER):
        a, b = (F.col("x")[m] - F.col("mean")[m] for m in (i, j))
        total = total + (1.0 if i == j else 2.0) * F.col("inverse")[k] * a * b
    return F.greatest(total, F.lit(0.0))


def _keyed(vectors: DataFrame) -> DataFrame:
    """Adds ``key``, the group whose estimate a document is judged by, and ``keys``, all groups
    whose estimate a usable document takes part in: its own, and its language and the whole table
    where small groups are judged by these."""
    lang, both = F.to_json(F.array("lang")), F.to_json(F.array("lang", "source"))
    sizes = vectors.filter("usable").groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))
    sizes = saved(sizes, "groups")  # a row per language and source
    langs = sizes.groupBy(lang.alias("l")).agg(F.sum("n").alias("n_lang"))
    key = F.when(F.col("n") >= LEAST_GROUP, both).when(F.col("n_lang") >= LEAST_GROUP, F.col("l")).otherwise(F.lit("*"))
    keys = saved(sizes.withColumn("l", lang).join(langs, "l").select("l", both.alias("g"), key.alias("key")), "keys")
    asked = keys.filter("key <> g").select(F.col("key").alias("wide")).distinct()
    ways = keys.select("g", "key", F.explode(F.array("g", "l", F.lit("*"))).alias("wide"))
    ways = ways.join(asked, "wide", "left_semi").groupBy("g").agg(F.collect_set("wide").alias("wide"))
    own = F.when(F.col("key") == F.col("g"), F.array("g")).otherwise(F.array().cast("array<string>"))
    keys = keys.join(ways, "g", "left").select("g", "key", F.concat(own, F.coalesce("wide", F.array().cast("array<string>"))).alias("keys"))
    keyed = vectors.withColumn("g", both).join(saved(keys, "ways"), "g", "left").drop("g")
    return keyed.withColumn("key", F.coalesce("key", F.lit("*")))


def estimates(keyed: DataFrame) -> DataFrame:
    """One row per key: mean and inverse covariance of the minimum covariance determinant."""
    usable = keyed.filter("usable").select(F.explode("keys").alias("key"), "x")
    each = usable.select("key", F.posexplode("x").alias("i", "v"))
    histogram = each.groupBy("key", "i", F.round(F.col("v") * HISTOGRAM).cast("long").alias("bin"))
    counts = histogram.agg(F.count(F.lit(1)).alias("n"))
    fit = saved(counts.groupBy("key").applyInPandas(_first, FIT).filter(f"n >= {LEAST_FIT}"), "mcd")
    d2 = _distance()
    names = [F.count(F.lit(1)).alias("n"), *[F.sum(F.col("x")[i]).alias(f"s{i}") for i in range(D)]]
    names += [F.sum(F.col("x")[i] * F.col("x")[j]).alias(f"p{i}{j}") for i, j in UPPER]
    bin_of = F.floor(F.log2(1 + d2) * BINS_PER_OCTAVE).alias("bin")

    # every start is a key of its own until the best end is chosen
    starts = F.explode(F.array(*[F.lit(f"{i}|") for i in range(len(STARTS))])).alias("start")
    with_start = F.concat("start", "key").alias("key")
    started = usable.select(starts, "key", "x").select(with_start, "x")
    fit = fit.select(starts, *fit.columns).select(with_start, *fit.columns[1:])

    def step(rows: DataFrame, fit: DataFrame, within: float | None = None, first: bool = False) -> DataFrame:
        def refit(bins: pd.DataFrame) -> pd.DataFrame:
            return _refit(bins, within, STARTS[int(bins["key"].iloc[0].split("|")[0])] if first else 0.5)

        bins = rows.join(fit, "key").groupBy("key", bin_of).agg(*names)
        return saved(bins.groupBy("key").applyInPandas(refit, FIT), "mcd")

    fit = step(started, fit, first=True)
    for _ in range(STEPS):
        before = fit.select("key", F.col("logdet").alias("was"))
        fit = step(started, fit)
        if fit.join(before, "key").filter("abs(logdet - was) > 1e-4").isEmpty():
            break
    own = F.expr("substring(key, instr(key, '|') + 1)").alias("key")
    best = fit.groupBy(own).agg(F.min_by(F.struct(*fit.columns[1:]), "logdet").alias("fit")).select("key", "fit.*")
    return step(usable, saved(best, "mcd"), chi2_quantile(0.975, D))


def judged(docs: DataFrame, tail: float = TAIL) -> DataFrame:
    """``row`` (all columns of the input), the five counts, base_failed, distance2 and kept."""
    on_workers(docs.sparkSession)
    stats = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        docs["lang"].alias("lang"),
        docs["source"].alias("source"),
        text_statistics(docs["text"]).alias("s"),
    )
    return verdicts(saved(stats, "quality"), tail)


def verdicts(stats: DataFrame, tail: float = TAIL) -> DataFrame:
    """As ``judged``, of a stored table with ``row``, ``lang``, ``source`` and the counts ``s``."""
    failed = (F.col("s.n_words") < LEAST_WORDS) | (
        100 * F.col("s.n_repeat_words") > REPEAT_SHARE * F.col("s.n_words")
    )
    vectors = stats.select(
        "row", "lang", "source", "s", failed.alias("base_failed"), (~failed).alias("usable"), F.array(*_features("s")).alias("x")
    )
    keyed = _keyed(vectors)
    fit = estimates(keyed).select("key", "mean", "inverse")
    found = keyed.join(fit, "key", "left").withColumn("distance2", _distance())
    inside = F.coalesce(F.col("distance2") <= chi2_quantile(1 - tail, D), F.lit(True))
    return found.select("row", "s.*", "base_failed", "distance2", (~F.col("base_failed") & inside).alias("kept"))


def document_verdicts(docs: DataFrame, tail: float = TAIL) -> DataFrame:
    """doc_id, the five counts, base_failed, kept and the squared distance of every document."""
    on_workers(docs.sparkSession)
    stats = docs.select(
        F.struct(docs["doc_id"].cast("long").alias("doc_id")).alias("row"),
        docs["lang"].alias("lang"),
        docs["source"].alias("source"),
        text_statistics(docs["text"]).alias("s"),
    )
    found = verdicts(saved(stats, "quality"), tail)
    return found.select("row.doc_id", *[c.split()[0] for c in STATS.split(", ")], "base_failed", "kept", "distance2")


def accepted(docs: DataFrame, tail: float = TAIL) -> DataFrame:
    """The documents that are kept, with all their columns."""
    return judged(docs, tail).filter("kept").select("row.*")
