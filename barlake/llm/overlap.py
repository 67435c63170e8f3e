"""Pairs of texts whose sets of word shingles overlap, by MinHash buckets and exact Jaccard.

A set holds the XXH64 hashes (seed 42) of the text's runs of ``WIDTH`` words; with fewer words
the whole sequence is the run, and a text without words has an empty set.  ``BANDS`` buckets
are each named by ``ROWS`` minima over the set, so sets with Jaccard similarity s share a
bucket with probability 1 - (1 - s**ROWS)**BANDS: 0.99994 at 0.8, more above.  Sharing a bucket
proves nothing: a link is confirmed by the Jaccard similarity of the whole sets.

What SimHash fingerprints of the sets have found before (see ``simhash.close``) comes first, checked in the same way.

Large groups of near copies are never compared pair by pair (see :func:`groups`): members that
one member ties together need no links of their own, and the others meet only in shingles that are
rare among them.

Null texts count as empty; texts without words all have the empty set, so they are one group, of which one
stays.  Repeated rows and texts of the same shingles share their set and are one member.  Texts of any
length are read whole; a set is held by a task at a time."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.llm.common import join_named, saved

SEED = 42
WIDTH = 5
LEAST = 80  # percent of the union that linked sets have in common
ROWS, BANDS = 6, 32
_DRAWS = np.random.default_rng(SEED).integers(0, 1 << 64, size=(2, ROWS * BANDS, 1), dtype=np.uint64)
FACTORS, OFFSETS = _DRAWS[0] | np.uint64(1), _DRAWS[1]


def shingles(text: str, width: int = WIDTH) -> np.ndarray:
    """The distinct unsigned hashes of a text's shingles, ascending."""
    import xxhash

    words = text.encode().lower().split()  # bytes: only A-Z are lowered, only ASCII white space splits
    if not words:
        return np.zeros(0, dtype=np.uint64)
    data = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]).tolist()
    digest = xxhash.xxh64_intdigest
    pairs = zip([0, *ends], ends[min(width, len(words)) - 1 :])
    return np.unique(np.array([digest(data[a : b - 1], SEED) for a, b in pairs], dtype=np.uint64))


def buckets(found: np.ndarray) -> np.ndarray:
    """Names of the ``BANDS`` buckets of a set; an empty set has none."""
    import xxhash

    if not len(found):
        return np.zeros(0, dtype=np.int64)
    least = np.full(ROWS * BANDS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(found), 256):
        np.minimum(least, (found[None, at : at + 256] * FACTORS + OFFSETS).min(axis=1), out=least)
    named = [xxhash.xxh64_intdigest(band.tobytes(), i) for i, band in enumerate(least.reshape(BANDS, ROWS))]
    return np.array(named, dtype=np.uint64).astype(np.int64)


def profiles(text: Column, fingerprint, width: int = WIDTH) -> Column:
    """Struct of ``fp``, a digest that texts with equal sets share, ``sim``, the ``fingerprint`` of the set, and the
    names of the buckets."""

    @F.pandas_udf("fp long, sim long, buckets array<long>")
    def run(texts: pd.Series) -> pd.DataFrame:
        import xxhash

        rows = []
        for text in texts:
            found = shingles(text, width)
            fp, sim = (np.uint64(x).astype(np.int64) for x in (xxhash.xxh64_intdigest(found.tobytes(), SEED), fingerprint(found)))
            rows.append((fp, sim, buckets(found)))
        return pd.DataFrame(rows, columns=["fp", "sim", "buckets"])

    return run(F.coalesce(text.cast("string"), F.lit("")))


def shingle_sets(text: Column, width: int = WIDTH) -> Column:
    @F.pandas_udf("array<long>")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([shingles(t, width).astype(np.int64) for t in texts], dtype=object)

    return run(F.coalesce(text.cast("string"), F.lit("")))


def members(each: DataFrame) -> DataFrame:
    """bucket, fp and n: the buckets with ``n`` > 1 members, of rows with distinct ``fp`` and ``buckets``."""
    every = each.select("fp", F.explode("buckets").alias("bucket"))
    shared = every.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return saved(every.join(shared, "bucket"), "buckets")


def confirmed(pairs: DataFrame, sets: DataFrame, least: int = LEAST) -> DataFrame:
    """The pairs (u, v, and any more columns) whose sets (``fp``, ``set``) have at least ``least`` percent in common."""
    a = sets.select(F.col("fp").alias("u"), F.col("set").alias("a"))
    b = sets.select(F.col("fp").alias("v"), F.col("set").alias("b"))
    both = F.size(F.array_intersect("a", "b"))
    near = 100 * both >= least * (F.size("a") + F.size("b") - both)
    return pairs.join(a, "u").join(b, "v").filter(near).drop("a", "b")


def _tied(rows: DataFrame, pairs: DataFrame, sets: DataFrame, roots, least: int) -> DataFrame | None:
    """``rows`` with their labels brought up to date by the links among ``pairs`` (fp, label, other_fp, other_label).

    Links are between labels: what earlier links tied together is not walked again."""
    pairs = pairs.select(F.least("fp", "other_fp").alias("u"), F.greatest("fp", "other_fp").alias("v"), "label", "other_label")
    new = confirmed(pairs.dropDuplicates(["u", "v"]), sets, least).select(F.col("label").alias("u"), F.col("other_label").alias("v"))
    tied = roots(saved(new.distinct(), "near")).select(F.col("u").alias("label"), F.col("v").alias("root"))
    return rows.join(tied, "label", "left").withColumn("label", F.coalesce("root", "label")).drop("root")


def groups(found: DataFrame, sets: DataFrame, roots, least: int = LEAST, first: DataFrame | None = None) -> DataFrame:
    """fp and label of all ``sets``, those of the members of ``found`` (see :func:`members`) among them: they have one label
    exactly where confirmed links connect them.

    Pairs (u, v) of ``first`` are checked before all others.
    A bucket is compared with one of its members, a row a member; with that which shares most
    buckets first, as the text that others are edited from does, then with any.  Buckets of one label are
    finished.  Turns go on while each halves what is left; the rest is compared by :func:`_by_rare_shingles`."""
    weight = found.groupBy("fp").agg(F.sum("n").alias("weight"))
    sized = sets.select("fp", F.size("set").alias("size"))
    labels = sets.select("fp", F.col("fp").alias("label"))
    if first is not None:
        pairs = first.select(F.col("u").alias("fp"), F.col("u").alias("label"), F.col("v").alias("other_fp"), F.col("v").alias("other_label"))
        labels = _tied(labels, pairs, sets, roots, least)
    labels = saved(labels, "labels")
    rows = found.join(weight, "fp").join(sized, "fp").join(labels, "fp")
    rows = saved(rows.select("bucket", "fp", "n", "size", "weight", "label"), "members")
    fits = 100 * F.least("size", "other_size") >= least * F.greatest("size", "other_size")
    left, turn = rows.count(), 0
    while left:
        order = F.struct(F.col("weight") if turn == 0 else F.lit(0), F.xxhash64("fp", F.lit(turn)))
        other = rows.groupBy("bucket").agg(F.max_by(F.struct("fp", "size", "label"), order).alias("o"))
        other = other.select("bucket", *[F.col(f"o.{c}").alias(f"other_{c}") for c in ("fp", "size", "label")])
        pairs = rows.join(other, "bucket").filter((F.col("label") != F.col("other_label")) & fits)
        labels = saved(_tied(labels, pairs, sets, roots, least), "labels")
        # two members have been compared by now, and one label has nothing left to find
        now = saved(rows.filter("n > 2").drop("label").join(labels, "fp").select(*rows.columns), "members")
        mixed = now.groupBy("bucket").agg(F.min("label").alias("a"), F.max("label").alias("b")).filter("a <> b")
        rows = saved(now.join(mixed.select("bucket"), "bucket", "left_semi"), "members")
        before, left, turn = left, rows.count(), turn + 1
        if turn > 1 and 2 * left > before:
            break
    if left:
        rest = saved(rows.select("fp", "size", "label").distinct(), "rest")
        labels = _tied(labels, _by_rare_shingles(rest, sets, least), sets, roots, least)
    return labels


def _by_rare_shingles(rest: DataFrame, sets: DataFrame, least: int) -> DataFrame:
    """Pairs of ``rest`` (fp, size, label) with different labels that may link; none that does is missing.

    Each set is ordered by how many of the sets have a shingle, the rarest first.  Sets of sizes m <= n that link have
    o >= least (m + n) / (100 + least) in common, and in front of the first shingle they share stand
    at most m - o of the one and n - o of the other.  The edits that keep near copies apart are rare
    shingles and stand there themselves, so such copies do not meet."""
    own = rest.join(sets, "fp").select("fp", "size", "label", F.explode("set").alias("shingle"))
    own = saved(own, "shingles")
    counted = own.groupBy("shingle").agg(F.count(F.lit(1)).alias("n"))
    total = own.count()
    placed = join_named(own, counted, "shingle", total)
    ordered = placed.groupBy("fp", "size", "label").agg(F.array_sort(F.collect_list(F.struct("n", "shingle"))).alias("all"))
    front = F.col("size") - F.ceil(F.col("size") * least / 100) + 1
    first = ordered.select("fp", "size", "label", F.posexplode(F.slice("all", F.lit(1), front.cast("int"))).alias("place", "s"))
    first = first.filter("s.n > 1").select(F.col("s.shingle").alias("shingle"), "fp", "size", "label", (F.col("size") - F.col("place")).alias("room"))
    first = saved(first, "fronts")
    names = ("fp", "size", "label", "room")
    big = first.select("shingle", *[F.col(c).alias(f"other_{c}") for c in names]).alias("b")
    # of a smaller or equal set only what may stand in front of 2 least / (100 + least) of it
    small = first.filter((100 + least) * F.col("room") >= 2 * least * F.col("size")).alias("a")
    both = least * (F.col("size") + F.col("other_size"))
    near = (
        (F.col("a.shingle") == F.col("b.shingle"))
        & (F.struct("size", "fp") < F.struct(F.col("other_size").alias("size"), F.col("other_fp").alias("fp")))
        & (100 * F.col("size") >= least * F.col("other_size"))
        & (F.col("label") != F.col("other_label"))
        & ((100 + least) * F.least("room", "other_room") >= both)
    )
    return small.join(big, near).select("fp", "label", "other_fp", "other_label")
