"""Approximate nearest neighbours by balanced posting lists.

The nearness is the inner product.  Vectors get one more component that makes their norms
equal, so the largest inner product is the smallest distance.  Centroids come from a bounded
sample (``SAMPLE_PER_LIST`` rows for each list, at most ``MAX_LISTS`` lists) by k-means in two
levels: coarse clusters, each divided into as many lists as its share of the sample asks for,
which keeps the lists balanced.  The centroids are linked in a graph of near neighbours that
every worker searches in memory, best first from the coarse centres.

Every vector is posted: to its nearest list and, where it lies near a boundary, to up to
``REPLICAS`` lists whose distance is within ``BOUNDARY`` of the least.  A query walks the
graph to its nearest lists and probes those whose distance is at most a ratio of the least, and
always those it needs to meet ``k`` others; so a query amid its neighbours probes few lists and one
between clusters many.  The ratio is measured on every table: ``SAMPLE_QUERIES`` queries are
compared with brute force, and it is the least one with which their recall, less two standard errors,
is ``RECALL``.  A least distance below the sample's median counts as that median, since a query that is a
centroid itself has no distance to take a ratio of.  Lists of one coarse cluster are scored in one task; a cluster with many rows (copies of
one vector, say) is divided into parts by hash and every part is asked, and many queries to one
cluster are divided likewise, so no task grows with a hot vector.  Each task returns its best
``k`` for a query, and the best of these are the result.

Scores are sums in double precision over the original vectors, added in the same order
everywhere, so equal vectors have equal scores and ties go to the smaller ``vec_id``.

Vectors that are null, zero, of another length than most, or hold null or non-finite
components take no part, nor do rows without ``vec_id``; rows that share a ``vec_id`` count as
one candidate and one query with the best score; fewer than ``k`` candidates are all returned;
an empty table gives an empty result; only ``vec_id`` and ``embedding`` are read."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlake.llm.common import on_workers, saved

K = 20
ROWS_PER_LIST = 64
MAX_LISTS = 1 << 14
SAMPLE_PER_LIST = 24
REPLICAS = 3
BOUNDARY = 1.06  # of the distance to the nearest centroid
RECALL = 0.9  # of the sampled queries' ``k`` nearest
SAMPLE_QUERIES = 128
#: Lists that a walk looks for at first; it goes on while the last one is within the ratio.
FIRST_WALK = 32
DEGREE = 16
#: Bytes of the sample that the centroids are fitted on, at most; it is fitted by the driver.
SAMPLE_BYTES = 256 << 20
#: Rows of a coarse cluster that one task scores, and queries it answers.
PART_ROWS, PART_QUERIES = 16_384, 4_096


def kmeans(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """``k`` centres at most; starts from evenly spread rows, empty clusters vanish."""
    centres = x[np.linspace(0, len(x) - 1, k).astype(int)]
    for _ in range(rounds):
        own = nearest_of(x, centres)
        sums = np.zeros_like(centres, dtype=np.float64)
        np.add.at(sums, own, x)
        n = np.bincount(own, minlength=len(centres))
        centres = (sums[n > 0] / n[n > 0, None]).astype(np.float32)
    return centres


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] + (y * y).sum(1)[None] - 2 * x @ y.T, 0)


def nearest_of(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    step = max(1, (1 << 24) // max(1, len(centres)))
    parts = [squared(x[at : at + step], centres).argmin(1) for at in range(0, len(x), step)]
    return np.concatenate(parts) if parts else np.zeros(0, dtype=int)


class Index:
    """Centroids of the lists, the coarse cluster of each, and the graph between them."""

    def __init__(self, sample: np.ndarray, lists: int, degree: int = DEGREE) -> None:
        sample = np.unique(sample, axis=0)  # copies of a hot vector would be lists of their own
        sample = sample[np.argsort(sample[:, 0] * 1e6 % 1)]  # any fixed order that mixes them
        self.coarse = kmeans(sample, max(1, min(len(sample), round(lists**0.5))))
        own = nearest_of(sample, self.coarse)
        centres, cluster = [], []
        for c in range(len(self.coarse)):
            part = sample[own == c]
            if len(part):
                found = kmeans(part, min(len(part), max(1, round(lists * len(part) / len(sample)))))
                centres.append(found)
                cluster += [c] * len(found)
        self.centres = np.concatenate(centres)
        self.cluster = np.array(cluster)
        # a coarse centre's entry point, and neighbours from the coarse clusters nearby
        self.entry = nearest_of(self.coarse, self.centres)
        self.near = np.zeros((len(self.centres), degree), dtype=np.int64)
        order = squared(self.coarse, self.coarse).argsort(1)[:, :8]
        for c in range(len(self.coarse)):
            rows = np.flatnonzero(self.cluster == c)
            pool = np.flatnonzero(np.isin(self.cluster, order[c]))
            if len(rows):
                best = squared(self.centres[rows], self.centres[pool]).argsort(1)[:, 1 : degree + 1]
                found = pool[best] if best.shape[1] else rows[:, None]
                self.near[rows] = found[:, np.arange(degree) % found.shape[1]]

    def search(self, x: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """About the ``n`` nearest centroids of each row and their squared distances, nearest
        first: best-first walks over the graph, all rows at once; all centroids need no walk."""
        n = min(n, len(self.centres))
        if n == len(self.centres):
            dist = squared(x, self.centres)
            ids = np.argsort(dist, axis=1, kind="stable")
            return ids, np.take_along_axis(dist, ids, 1)
        beam = min(len(self.centres), max(n, 24))
        norms = (self.centres * self.centres).sum(1)
        xx = (x * x).sum(1)
        rows = np.arange(len(x))[:, None]
        first = np.unique(self.entry)
        dist = np.maximum(xx[:, None] + norms[first] - 2 * x @ self.centres[first].T, 0)
        ids = np.broadcast_to(first, dist.shape)
        seen = np.zeros((len(x), len(self.centres)), dtype=bool)
        seen[:, first] = True
        done = np.zeros(dist.shape, dtype=bool)
        expand = 8  # nodes of each walk that a round expands
        while True:
            keep = np.argsort(dist, axis=1, kind="stable")[:, :beam]
            ids, dist, done = ids[rows, keep], dist[rows, keep], done[rows, keep]
            open_ = np.where(done, np.inf, dist)
            go = np.argsort(open_, axis=1, kind="stable")[:, :expand]
            live = np.isfinite(open_[rows, go])
            active = live.any(1)
            if not active.any():
                return ids[:, :n], dist[:, :n]
            done[rows, go] = True
            fresh = self.near[ids[rows, go]].reshape(len(x), -1)
            new = ~seen[rows, fresh] & np.repeat(live, self.near.shape[1], axis=1)
            seen[rows, fresh] |= new
            at, col = np.nonzero(new)
            c = fresh[at, col]
            d = np.full(fresh.shape, np.inf, dtype=dist.dtype)
            d[at, col] = np.maximum(xx[at] + norms[c] - 2 * np.einsum("ij,ij->i", x[at], self.centres[c]), 0)
            # a centroid met twice in one round stays once
            order = np.argsort(np.where(np.isfinite(d), fresh, -1), axis=1, kind="stable")
            f, e = fresh[rows, order], d[rows, order]
            e[:, 1:][(f[:, 1:] == f[:, :-1]) & np.isfinite(e[:, 1:]) & np.isfinite(e[:, :-1])] = np.inf
            ids = np.concatenate([ids, f], 1)
            dist = np.concatenate([dist, e], 1)
            done = np.concatenate([done, ~np.isfinite(e)], 1)


def _matrix(cells: pd.Series) -> np.ndarray:
    return np.stack(cells.to_numpy()).astype(np.float32) if len(cells) else np.zeros((0, 1), np.float32)


def extended(x: np.ndarray, largest: float) -> np.ndarray:
    """Vectors with the component that brings their norm to ``largest``."""
    rest = np.sqrt(np.maximum(largest - (x.astype(np.float64) ** 2).sum(1), 0))
    return np.concatenate([x, rest[:, None].astype(np.float32)], 1)


def valid(vectors: DataFrame) -> DataFrame:
    """vec_id, x (array of double) and norm2 of the rows that take part."""
    x = F.col("embedding").cast("array<double>")
    bad = F.exists("x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x"))
    rows = rows.filter("vec_id IS NOT NULL AND x IS NOT NULL").filter(~bad & F.exists("x", lambda v: v != 0))
    norm2 = F.aggregate("x", F.lit(0.0), lambda a, v: a + v * v)
    return rows.withColumn("size", F.size("x")).withColumn("norm2", norm2)


def build(rows: DataFrame) -> tuple[Index, float] | None:
    """The index of a stored table of valid vectors, and the largest squared norm."""
    total = rows.agg(F.count(F.lit(1)).alias("n"), F.max("norm2").alias("largest"), F.max("size").alias("size")).first()
    if not total["n"]:
        return None
    most = SAMPLE_BYTES // (4 * total["size"] * SAMPLE_PER_LIST)
    lists = int(min(max(1, total["n"] // ROWS_PER_LIST), MAX_LISTS, max(1, most)))
    order = [F.xxhash64("vec_id"), "vec_id"]
    sample = rows.select("vec_id", F.col("x").cast("array<float>").alias("x")).orderBy(*order).limit(lists * SAMPLE_PER_LIST)
    x = _matrix(sample.toPandas()["x"])  # bounded: lists and rows per list
    return Index(extended(x, total["largest"]), lists), float(total["largest"])


def scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """All inner products, each added up component by component in the same order."""
    out = np.zeros((len(q), len(x)))
    for i in range(q.shape[1]):
        out += q[:, i, None] * x[None, :, i]
    return out


def _best(query: np.ndarray, vec: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of each query's ``k`` best, best first, equal candidates once."""
    order = np.lexsort((vec, -score, query))
    q, v = query[order], vec[order]
    order = order[np.concatenate([[True], (q[1:] != q[:-1]) | (v[1:] != v[:-1])])]
    q = query[order]
    start = np.concatenate([[0], np.flatnonzero(q[1:] != q[:-1]) + 1])
    rank = np.arange(len(q)) - np.repeat(start, np.diff(np.concatenate([start, [len(q)]])))
    return order[rank < k]


def posted(rows: DataFrame, index: Index, largest: float, replicas: int = REPLICAS) -> DataFrame:
    """The stored postings: coarse, list, home (the vector's nearest list), vec_id and x."""

    def post(batches):
        for pdf in batches:
            for at in range(0, len(pdf), 1024):
                part = pdf.iloc[at : at + 1024]
                lists, dist = index.search(extended(_matrix(part["x"]), largest), replicas)
                near = dist <= dist[:, :1] * BOUNDARY**2 + 1e-12
                near[:, 0] = True
                i, j = np.nonzero(near)
                found = lists[i, j]
                yield pd.DataFrame(
                    {"coarse": index.cluster[found], "list": found, "home": j == 0, "vec_id": part["vec_id"].to_numpy()[i], "x": part["x"].to_numpy()[i]}
                )

    kinds = "coarse int, list int, home boolean, vec_id long, x array<double>"
    return saved(rows.select("vec_id", "x").mapInPandas(post, kinds), "postings")


def home_sizes(postings: DataFrame, index: Index) -> np.ndarray:
    """Distinct ``vec_id`` of each list, every one counted in one list only."""
    one = postings.filter("home").groupBy("vec_id").agg(F.min("list").alias("list"))
    held = one.groupBy("list").agg(F.count(F.lit(1)).alias("n")).toPandas()  # a row per list
    home = np.zeros(len(index.centres), dtype=np.int64)
    home[held["list"].to_numpy(dtype=np.int64)] = held["n"].to_numpy(dtype=np.int64)
    return home


class Reach:
    """How far from a query the lists lie that it probes: ``ratio`` times its distance to the nearest
    centroid, or times ``least`` where that is more."""

    def __init__(self, ratio: float, least: float = 0.0) -> None:
        self.ratio, self.least = ratio, least

    def within(self, dist: np.ndarray, nearest: np.ndarray) -> np.ndarray:
        """Of squared distances."""
        return dist <= np.maximum(nearest, self.least**2) * self.ratio**2 + 1e-12


def chosen(index: Index, x: np.ndarray, reach: Reach, home: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of queries and the lists they probe: the nearest ones that hold ``k`` + 1 vectors
    together, and all within reach."""
    x = np.concatenate([x, np.zeros((len(x), 1), np.float32)], 1)
    todo, n = np.arange(len(x)), min(FIRST_WALK, len(index.centres))
    rows, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    while len(todo):
        lists, dist = index.search(x[todo], n)
        real = np.isfinite(dist)
        size = np.where(real, home[lists], 0)
        held = np.cumsum(size, 1)
        within = reach.within(dist, dist[:, :1])
        keep = real & (within | (held - size <= k))
        full = ((held[:, -1] > k) & ~(real & within)[:, -1]) | (n == len(index.centres))
        i, j = np.nonzero(keep & full[:, None])
        rows.append(todo[i])
        found.append(lists[i, j])
        todo, n = todo[~full], min(2 * n, len(index.centres))
    return np.concatenate(rows), np.concatenate(found)


def nearest_by_force(rows: DataFrame, sample: pd.DataFrame, k: int) -> DataFrame:
    """query_id and vec_id of the exact ``k`` nearest of the sampled queries."""
    q, own = np.stack(sample["x"].to_numpy()), sample["vec_id"].to_numpy()
    kinds = "query_id long, vec_id long, score double"

    def best(batches):
        held = [pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})]
        for pdf in batches:
            for at in range(0, len(pdf), 4096):
                part = pdf.iloc[at : at + 4096]
                ids = part["vec_id"].to_numpy()
                s = scores(q, np.stack(part["x"].to_numpy()))
                s[own[:, None] == ids[None]] = -np.inf
                top = _top(s, ids, k)
                i, j = np.repeat(np.arange(len(q)), top.shape[1]), top.ravel()
                good = np.isfinite(s[i, j])
                i, j = i[good], j[good]
                held = [_cut([*held, pd.DataFrame({"query_id": own[i], "vec_id": ids[j], "score": s[i, j]})], k)]
        yield held[0]

    found = rows.select("vec_id", "x").mapInPandas(best, kinds).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "vec_id")


def fitted_reach(
    rows: DataFrame, is_query: Column, index: Index, postings: DataFrame, k: int = K, least: float = RECALL
) -> Reach:
    """The least ratio with a recall of ``least`` on a sample of the queries."""
    sample = rows.filter(is_query).select("vec_id", "x").orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE_QUERIES)
    sample = sample.toPandas().drop_duplicates("vec_id")
    if not len(sample):
        return Reach(1.0)
    x = _matrix(sample["x"])
    dist = np.sqrt(squared(np.concatenate([x, np.zeros((len(x), 1), np.float32)], 1), index.centres))
    median = float(np.median(dist.min(1)))
    truth = saved(nearest_by_force(rows, sample, k), "nearest")
    held = postings.select("vec_id", "list").join(F.broadcast(truth), "vec_id").distinct().toPandas()  # of the sample
    if not len(held):
        return Reach(1.0, median)
    at = pd.Series(np.arange(len(sample)), index=sample["vec_id"].to_numpy())[held["query_id"].to_numpy()].to_numpy()
    base = np.maximum(dist.min(1), max(median, 1e-6))
    # the ratio that a neighbour asks for: that of the nearest list it is posted to
    held = pd.DataFrame({"at": at, "vec_id": held["vec_id"].to_numpy(), "ratio": dist[at, held["list"].to_numpy()] / base[at]})
    asked = held.groupby(["at", "vec_id"])["ratio"].min().reset_index()
    for ratio in np.sort(asked["ratio"].to_numpy())[int(least * len(asked)) :]:
        each = (asked["ratio"] <= ratio).groupby(asked["at"]).mean()
        if each.mean() - 2 * each.std(ddof=0) / len(each) ** 0.5 >= least:
            break
    return Reach(float(ratio) * (1 + 1e-6), median)


def search(
    vectors: DataFrame, is_query: Column, k: int = K, reach: Reach | None = None, replicas: int = REPLICAS
) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the ``k`` nearest of every query row; without
    ``reach`` the ratio is measured (see ``fitted_reach``)."""
    spark = vectors.sparkSession
    on_workers(spark)
    rows = saved(valid(vectors), "vectors")
    usual = rows.groupBy("size").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "size").first()
    if usual is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = rows.filter(F.col("size") == usual["size"])
    index, largest = build(rows)

    postings = posted(rows, index, largest, replicas)
    home = home_sizes(postings, index)
    if reach is None:
        reach = fitted_reach(rows, is_query, index, postings, k)

    def probe(batches):
        for pdf in batches:
            for at in range(0, len(pdf), 1024):
                part = pdf.iloc[at : at + 1024]
                i, found = chosen(index, _matrix(part["x"]), reach, home, k)
                each = pd.DataFrame({"row": i, "coarse": index.cluster[found], "list": found})
                each = each.groupby(["row", "coarse"])["list"].apply(list).reset_index()
                own = part.iloc[each["row"].to_numpy()]
                yield pd.DataFrame(
                    {
                        "coarse": each["coarse"].to_numpy(),
                        "lists": each["list"].to_numpy(),
                        "query_id": own["vec_id"].to_numpy(),
                        "q": own["x"].to_numpy(),
                    }
                )

    asked = rows.filter(is_query).select("vec_id", "x")
    asked = saved(asked.mapInPandas(probe, "coarse int, lists array<int>, query_id long, q array<double>"), "probes")
    # clusters with many rows or queries are divided; a row per cluster
    parts = postings.groupBy("coarse").agg(F.ceil(F.count(F.lit(1)) / PART_ROWS).cast("int").alias("parts"))
    turns = asked.groupBy("coarse").agg(F.ceil(F.count(F.lit(1)) / PART_QUERIES).cast("int").alias("turns"))
    plan = F.broadcast(saved(parts.join(turns, "coarse"), "parts"))  # at most sqrt(MAX_LISTS) rows
    left = postings.join(plan, "coarse").select(
        "coarse", F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int").alias("part"),
        F.explode(F.sequence(F.lit(0), F.col("turns") - 1)).alias("turn"), "list", "vec_id", "x",
    )
    right = asked.join(plan, "coarse").select(
        "coarse", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
        F.pmod(F.xxhash64("query_id"), F.col("turns")).cast("int").alias("turn"), "lists", "query_id", "q",
    )
    key = ["coarse", "part", "turn"]

    def score(posted: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})
        if not len(posted) or not len(queries):
            return empty
        x, q = np.stack(posted["x"].to_numpy()), np.stack(queries["q"].to_numpy())
        ids, own = posted["vec_id"].to_numpy(), queries["query_id"].to_numpy()
        members = posted.groupby("list").indices
        askers = queries["lists"].explode().reset_index(drop=False)
        askers = pd.DataFrame({"at": np.repeat(np.arange(len(q)), queries["lists"].map(len)), "list": askers["lists"].to_numpy()})
        held = [empty]
        size = 0
        for name, who in askers.groupby("list")["at"]:
            inside = members.get(name)
            if inside is None:
                continue
            for block in np.array_split(who.to_numpy(), max(1, len(who) * len(inside) // (1 << 21))):
                s = scores(q[block], x[inside])
                s[own[block][:, None] == ids[inside][None]] = -np.inf
                top = _top(s, ids[inside], k)
                i = np.repeat(np.arange(len(block)), top.shape[1])
                j = top.ravel()
                good = np.isfinite(s[i, j])
                i, j = i[good], j[good]
                held.append(pd.DataFrame({"query_id": own[block][i], "vec_id": ids[inside][j], "score": s[i, j]}))
                size += len(i)
                if size > 1 << 20:
                    held, size = [_cut(held, k)], 0
        return _cut(held, k)

    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(score, "query_id long, vec_id long, score double")
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _top(s: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Columns of each row's ``k`` largest scores, ties to smaller ids."""
    by_id = np.argsort(ids, kind="stable")
    return by_id[np.argsort(-s[:, by_id], axis=1, kind="stable")[:, :k]]


def _cut(held: list[pd.DataFrame], k: int) -> pd.DataFrame:
    every = pd.concat(held, ignore_index=True)
    if not len(every):
        return every
    keep = _best(every["query_id"].to_numpy(), every["vec_id"].to_numpy(), every["score"].to_numpy(), k)
    return every.iloc[keep]
