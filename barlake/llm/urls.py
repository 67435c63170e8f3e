"""URL filter: host and path rules first, a logistic regression on hashed n-grams for the rest.

The longest rule that fits a URL decides: its host is the URL's host or a parent domain of it,
and the URL's path starts with its path.  Where no rule fits, the verdict is that of a
logistic regression on the character 3- to 5-grams of host and path, hashed into ``BUCKETS``
buckets; digits count as one character in paths, and each gram counts once.  It is trained by
full-batch gradient steps (one aggregation each) on a small labelled table of URLs, at most
``LABELLED`` of each class; the driver only ever holds the model's ``BUCKETS`` weights.

DataFrame expressions only.  A null URL, or one without ``://``, has an empty host and path
and is judged by the bias alone.  Without labelled URLs of both classes everything the rules
leave open is allowed.  URLs of any length are taken whole, and no other text is read.  Repeated rows give repeated results, an empty table an empty result;
only ``page_id`` and ``url`` are read."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.llm.common import saved

#: (verdict, host and path)
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)
BUCKETS = 4096
GRAMS = (3, 4, 5)
#: Labelled URLs of each class that the model is fitted to, at most.
LABELLED = 2048
STEPS = 25
RATE = 2.0
RIDGE = 1e-4

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: Column) -> Column:
    """What follows the first ``://``."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(_rest(url), F.lit("")), "^[^/?#]*", 0)
    return F.translate(found, _UPPER, _LOWER)


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(_rest(url), F.lit("")), "^[^/?#]*([^?#]*)", 1)


def _fits(rule: str) -> Column:
    name, slash, rest = rule.partition("/")
    under = (F.col("host") == name) | F.endswith(F.col("host"), F.lit("." + name))
    return under & F.startswith(F.col("path"), F.lit(slash + rest))


def ruled(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """page_id, url, host, path, rule (null where none fits) and ruling."""
    rows = pages.select(
        F.col("page_id"), F.col("url"), host(F.col("url").cast("string")).alias("host"), path(F.col("url").cast("string")).alias("path")
    )
    rule = ruling = F.lit(None).cast("string")
    for verdict, text in sorted(rules, key=lambda r: len(r[1])):
        rule = F.when(_fits(text), F.lit(text)).otherwise(rule)
        ruling = F.when(_fits(text), F.lit(verdict)).otherwise(ruling)
    return rows.withColumns({"rule": rule, "ruling": ruling})


def _grams(text: Column, tag: str) -> list[Column]:
    def of(n: int) -> Column:
        starts = F.when(F.length(text) >= n, F.sequence(F.lit(1), F.length(text) - (n - 1)))
        # a function of one argument: a second one would be the place in the array
        return F.transform(F.coalesce(starts, F.array().cast("array<int>")), lambda i: F.concat(F.lit(tag), F.substr(text, i, F.lit(n))))

    return [of(n) for n in GRAMS]


def features() -> Column:
    """Bucket numbers (from 1) of the distinct grams of ``host`` and ``path``."""
    name = F.concat(F.lit("^"), F.col("host"), F.lit("$"))
    place = F.concat(F.translate(F.col("path"), "123456789", "000000000"), F.lit("$"))
    grams = F.array_distinct(F.concat(*_grams(name, "h"), *_grams(place, "p")))
    return F.transform(grams, lambda g: F.pmod(F.xxhash64(g), F.lit(BUCKETS)).cast("int") + 1)


def _score(weights: Sequence[float], bias: float) -> Column:
    """Log odds of a block for ``grams``: mean-scaled sum of the weights, which are one literal."""
    numbers = F.split(F.lit(",".join(map(repr, weights))), ",").cast("array<double>")
    total = F.aggregate("grams", F.lit(0.0), lambda a, b: a + F.element_at(numbers, b))
    return F.lit(bias) + total / F.sqrt(F.greatest(F.size("grams"), F.lit(1)))


def labelled(rows: DataFrame, per_class: int = LABELLED) -> DataFrame:
    """At most ``per_class`` distinct URLs of each label (0 allow, 1 block), least hash first."""
    each = rows.groupBy("host", "path", "label").agg(F.count(F.lit(1)).alias("n"))
    order = [F.xxhash64("host", "path"), "host", "path"]
    parts = [each.filter(F.col("label") == k).orderBy(*order).limit(per_class) for k in (0, 1)]
    return parts[0].unionByName(parts[1]).select("host", "path", "label")


def train(urls: DataFrame, steps: int = STEPS) -> tuple[list[float], float] | None:
    """Weights and bias for (host, path, label) rows; None without both labels."""
    rows = saved(labelled(urls).select("label", features().alias("grams")), "labelled")
    counts = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) < 2:
        return None
    total = sum(counts.values())
    weights, bias = [0.0] * BUCKETS, math.log(counts[1] / counts[0])
    squares = [1e-6] * BUCKETS
    for _ in range(steps):
        error = 1 / (1 + F.exp(-_score(weights, bias))) - F.col("label")
        each = rows.select(error.alias("e"), (error / F.sqrt(F.greatest(F.size("grams"), F.lit(1)))).alias("g"), "grams")
        # bucket 0 gathers the bias's slope; the model's size bounds the rows
        parts = each.select(F.explode(F.concat(F.array(F.lit(0)), "grams")).alias("bucket"), "e", "g")
        slope = F.sum(F.when(F.col("bucket") == 0, F.col("e")).otherwise(F.col("g"))).alias("slope")
        for row in parts.groupBy("bucket").agg(slope).collect():
            b, slope_b = row["bucket"] - 1, row["slope"] / total
            if b < 0:
                bias -= slope_b
            else:
                slope_b += RIDGE * weights[b]
                squares[b] += slope_b * slope_b
                weights[b] -= RATE * slope_b / math.sqrt(squares[b])
    return weights, bias


def judged(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, labels: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict and score of every page.

    ``labels``: (url, label) rows to learn from; without it, the pages that a rule decides."""
    rows = ruled(pages, rules)
    if labels is None:
        known = rows.filter("ruling IS NOT NULL").select("host", "path", (F.col("ruling") == "block").cast("int").alias("label"))
    else:
        url = F.col("url").cast("string")
        known = labels.select(host(url).alias("host"), path(url).alias("path"), F.col("label").cast("int").alias("label"))
    model = train(known)
    score = F.lit(None).cast("double") if model is None else _score(*model)
    found = rows.withColumn("grams", features()).withColumn("score", score)
    learned = F.when(F.col("score") > 0, F.lit("block")).otherwise(F.lit("allow"))
    verdict = F.coalesce("ruling", learned).alias("verdict")
    return found.select("page_id", "host", "path", "rule", verdict, "score")
