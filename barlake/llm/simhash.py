"""Near-duplicate documents by SimHash fingerprints and a trie self-join.

A fingerprint has 64 bits; a bit is set where more than half of the XXH64 hashes (seed 42) of
the document's word shingles have it, repeats included.  Two fingerprints link when they
differ in at most ``BUDGET`` = 2 bits; the components of the links are the groups.

The join works on distinct fingerprints, so copies never meet.  Of four 16-bit blocks (with another
budget of two more blocks than bits) at least two are the same in linked fingerprints, so six binary tries are walked, one for each pair of
leading blocks, from the nodes at depth 32 where no difference has been spent yet.  From there
node pairs are traversed together: each step takes the two children of both nodes, adds up
differing bits, and drops a pair when the budget is exceeded.  A node with more than
``HEAVY`` fingerprints is not walked by one task: its node pairs eight bits further down
become units of work of their own, again and again until every unit is small.  A task returns
a spanning forest of the links it finds, at most one edge per fingerprint and trie, and the
components of all edges are found by alternating large-star and small-star steps, whose
tables lie in the shared folder.

A text without words has fingerprint zero and is linked like any other; null texts count as
empty; with fewer words than a shingle the whole sequence is the shingle.  Repeated rows share
their fingerprint and group.  A null ``doc_id`` never names a group unless all its members
have none.  An empty table gives an empty result; only ``doc_id`` and ``text`` are read."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.llm import overlap
from barlake.llm.common import join_named, numbered_in, on_workers, saved

SEED = 42
SHINGLE = 3
BUDGET = 2
#: Differing bits of the fingerprints that the pipeline's stage takes first.
CLOSE = 3
#: Fingerprints of a unit of work; larger ones are split further.
HEAVY = 4096
STEP_BITS = 8
BATCH = 1 << 17


def majority(hashes: np.ndarray) -> int:
    """Unsigned number of the bits that over half of the 64-bit hashes have; zero without any."""
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 15):
        part = hashes[at : at + (1 << 15)].astype(">u8")
        counts += np.unpackbits(part.view(np.uint8)).reshape(len(part), 64).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big")


def fingerprint(text: str, size: int = SHINGLE) -> int:
    """Unsigned 64-bit fingerprint of a whole text."""
    import xxhash

    words = text.encode().lower().split()  # bytes: only A-Z are lowered, only ASCII white space splits
    if not words:
        return 0
    data = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]).tolist()
    starts = [0, *ends[:-1]]
    digest = xxhash.xxh64_intdigest
    if len(words) <= size:
        return digest(data, SEED)
    hashes = np.array([digest(data[a : b - 1], SEED) for a, b in zip(starts, ends[size - 1 :])], dtype=np.uint64)
    return majority(hashes)


def fingerprints(text: Column) -> Column:
    """Signed long with the bits of each text's fingerprint."""

    @F.pandas_udf("long")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t) for t in texts], dtype=np.uint64).astype(np.int64))

    return run(F.coalesce(text.cast("string"), F.lit("")))


def trie_links(keys: np.ndarray, lo: np.ndarray, hi: np.ndarray, other: np.ndarray, depth: np.ndarray, budget: int = BUDGET):
    """Index pairs of linked keys.  ``keys`` are unsigned and ascending within each unit; unit u
    is the self-join of ``keys[lo:hi]`` if ``other`` equals ``hi``, else the join of ``lo:other``
    with ``other:hi``.  The first ``depth`` bits are the same within each side."""
    found_a, found_b = [], []
    zero = np.zeros(len(lo), dtype=np.int64)
    selves = other == hi
    cross = ~selves & (other > lo)
    top = np.where(depth > 0, depth, 1).astype(np.uint64)
    shift = np.uint64(64) - top
    first, second = keys[lo[cross]] >> shift[cross], keys[other[cross]] >> shift[cross]
    # columns: node a, node b as ranges, bits spent
    nodes = np.stack([lo[selves], hi[selves], lo[selves], hi[selves], zero[selves]])
    pairs = np.stack(
        [lo[cross], other[cross], other[cross], hi[cross], np.bitwise_count(first ^ second).astype(np.int64)]
    )
    level = int(depth.min(initial=64))
    pending = [(int(d), nodes[:, depth[selves] == d], pairs[:, depth[cross] == d]) for d in np.unique(depth)]
    selfs, pairs = np.zeros((5, 0), np.int64), np.zeros((5, 0), np.int64)
    for bit in range(level, 65):
        for d, s, p in pending:
            if d == bit:
                selfs, pairs = np.concatenate([selfs, s], 1), np.concatenate([pairs, p], 1)
        selfs = selfs[:, selfs[1] - selfs[0] > 1]
        pairs = pairs[:, (pairs[4] <= budget) & (pairs[1] > pairs[0]) & (pairs[3] > pairs[2])]
        single = (pairs[1] - pairs[0] == 1) & (pairs[3] - pairs[2] == 1)
        if single.any():
            a, b = pairs[0, single], pairs[2, single]
            near = np.bitwise_count(keys[a] ^ keys[b]) <= budget
            found_a.append(a[near])
            found_b.append(b[near])
            pairs = pairs[:, ~single]
        if bit == 64:
            break
        ones = np.concatenate([[0], np.cumsum((keys >> np.uint64(63 - bit)) & np.uint64(1)).astype(np.int64)])

        def middle(lo, hi):
            return hi - (ones[hi] - ones[lo])

        sm = middle(selfs[0], selfs[1])
        low, high = (selfs[0], sm), (sm, selfs[1])
        am, bm = middle(pairs[0], pairs[1]), middle(pairs[2], pairs[3])
        a0, a1, b0, b1 = (pairs[0], am), (am, pairs[1]), (pairs[2], bm), (bm, pairs[3])
        spent = pairs[4]
        pairs = np.concatenate(
            [
                np.stack([*low, *high, selfs[4] + 1]),
                np.stack([*a0, *b0, spent]),
                np.stack([*a1, *b1, spent]),
                np.stack([*a0, *b1, spent + 1]),
                np.stack([*a1, *b0, spent + 1]),
            ],
            1,
        )
        selfs = np.concatenate([np.stack([*low, *low, selfs[4]]), np.stack([*high, *high, selfs[4]])], 1)
    empty = np.zeros(0, np.int64)
    return np.concatenate([empty, *found_a]), np.concatenate([empty, *found_b])


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index that each of ``n`` indices is connected to."""
    label = np.arange(n)
    while len(a):
        least = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, least)
        np.minimum.at(label, b, least)
        np.minimum.at(label, before[a], least)
        np.minimum.at(label, before[b], least)
        label = label[label]
        if (label == before).all():
            break
    return label


def _edges(rows: pd.DataFrame, budget: int) -> pd.DataFrame:
    """Spanning edges of whole units; rows: trie, a, b, depth, key, fp."""
    key = rows["key"].to_numpy().view(np.uint64)
    depth = rows["depth"].to_numpy()
    unit = rows.groupby(["trie", "depth", "a", "b"], sort=False).ngroup().to_numpy()
    prefix = (key >> (64 - depth).astype(np.uint64)).view(np.int64)
    side = prefix != rows["a"].to_numpy()
    order = np.lexsort((key, side, unit))
    key, unit, side, depth = key[order], unit[order], side[order], depth[order]
    fp = rows["fp"].to_numpy()[order]
    lo = np.flatnonzero(np.concatenate([[True], unit[1:] != unit[:-1]]))
    hi = np.concatenate([lo[1:], [len(unit)]])
    split = hi - np.add.reduceat(side.astype(np.int64), lo)
    alone = rows["a"].to_numpy()[order][lo] != rows["b"].to_numpy()[order][lo]
    use = ~alone | ((split > lo) & (split < hi))
    a, b = trie_links(key, lo[use], hi[use], split[use], depth[lo][use], budget)
    root = forest(len(key), a, b)
    tied = np.flatnonzero(root != np.arange(len(key)))
    return pd.DataFrame({"u": fp[tied], "v": fp[root[tied]]})


def _walk(batches, budget: int):
    """Edges of a partition's units, some units at a time; rows come sorted by unit."""
    held = None
    names = ["trie", "depth", "a", "b"]
    for rows in batches:
        held = rows if held is None else pd.concat([held, rows], ignore_index=True)
        if len(held) < BATCH:
            continue
        last = (held[names] == held[names].iloc[-1]).all(axis=1).to_numpy()
        if not last.all():
            yield _edges(held[~last].reset_index(drop=True), budget)
            held = held[last].reset_index(drop=True)
    if held is not None and len(held):
        yield _edges(held, budget)


def _masks(bits: int, most: int) -> list[int]:
    return [sum(1 << i for i in c) for k in range(most + 1) for c in combinations(range(bits), k)]


def links(fps: DataFrame, heavy: int = HEAVY, budget: int = BUDGET) -> DataFrame:
    """Edges (u, v) that connect exactly the distinct fingerprints ``fp`` connected by links of ``budget`` bits.

    Of ``budget`` + 2 blocks two at least are the same in linked fingerprints."""
    size, more = divmod(64, budget + 2)
    widths = [size + (i < more) for i in range(budget + 2)]
    ends = np.cumsum(widths).tolist()
    blocks = [F.shiftrightunsigned("fp", 64 - end).bitwiseAND((1 << w) - 1) for w, end in zip(widths, ends)]
    keys = []
    for trie, lead in enumerate(combinations(range(len(widths)), 2)):
        key, placed = F.lit(0).cast("long"), 0
        for i in [*lead, *(i for i in range(len(widths)) if i not in lead)]:
            placed += widths[i]
            key = key.bitwiseOR(F.shiftleft(blocks[i], 64 - placed))
        depth = sum(widths[i] for i in lead)
        first = F.shiftrightunsigned(key, 64 - depth)
        keys.append(F.struct(F.lit(trie).alias("trie"), F.lit(depth).alias("depth"), first.alias("a"), key.alias("key")))
    unit = ["trie", "depth", "a", "b"]
    rows = fps.select("fp", F.explode(F.array(*keys)).alias("k"))
    rows = saved(rows.select("k.trie", "k.depth", "k.a", F.col("k.a").alias("b"), "k.key", "fp"), "tries")

    def walk(batches):
        return _walk(batches, budget)

    edges = None
    while True:
        sizes = saved(rows.groupBy(*unit).agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "units")
        small = rows.join(sizes.filter(F.col("n") <= heavy).select(*unit), unit, "left_semi")
        tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        small = small.repartition(tasks, *unit).sortWithinPartitions(*unit)
        found = saved(small.mapInPandas(walk, "u long, v long"), "links")
        edges = found if edges is None else edges.unionByName(found)
        large = sizes.filter(F.col("n") > heavy)
        if large.isEmpty():
            return edges.distinct()
        rows = saved(_descend(rows.join(large.select(*unit), unit, "left_semi"), budget), "tries")


def _descend(rows: DataFrame, budget: int) -> DataFrame:
    """The members of heavy units, as members of their node pairs ``STEP_BITS`` further down."""
    room = F.lit(budget) - F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    masks = F.array(*[F.lit(m).cast("long") for m in _masks(STEP_BITS, budget)])
    mask = F.explode(F.filter(masks, lambda m: F.bit_count(m) <= room)).alias("mask")
    # shifts by a column, not a constant
    mine = F.expr(f"shiftrightunsigned(key, 64 - depth - {STEP_BITS})")
    over = F.when(F.expr("shiftrightunsigned(key, 64 - depth)") == F.col("a"), F.col("b")).otherwise(F.col("a"))
    rows = rows.select("trie", "depth", "key", "fp", over.alias("over"), mine.alias("mine"), mask)
    low = F.col("mine").bitwiseAND((1 << STEP_BITS) - 1).bitwiseXOR(F.col("mask"))
    rows = rows.withColumn("partner", F.shiftleft("over", STEP_BITS).bitwiseOR(low))
    return rows.select(
        "trie",
        (F.col("depth") + STEP_BITS).alias("depth"),
        F.least("mine", "partner").alias("a"),
        F.greatest("mine", "partner").alias("b"),
        "key",
        "fp",
    )


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def roots(edges: DataFrame) -> DataFrame:
    """(u, v): every node of the edges but the smallest of its component, with that smallest."""
    edges = saved(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), "edges")
    mark = _mark(edges)
    while mark[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = saved(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = saved(large.filter("u <> v").distinct(), "large")
        least = saved(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(least, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        edges = saved(small.filter("u <> v").distinct(), "edges")
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    return edges


def components(fps: DataFrame, heavy: int = HEAVY) -> DataFrame:
    """(fp, component): the least ``rep`` of each distinct fingerprint's component.

    ``fps``: one row per document with ``fp`` and ``rep``, any type that has an order."""
    on_workers(fps.sparkSession)
    each = saved(fps.groupBy("fp").agg(F.min("rep").alias("rep")), "fingerprints")
    tied = roots(links(each.select("fp"), heavy))
    known = saved(each.join(tied.withColumnRenamed("u", "fp"), "fp", "left"), "rooted")
    known = known.select("fp", "rep", F.coalesce("v", "fp").alias("root"))
    least = saved(known.groupBy("root").agg(F.min("rep").alias("component")), "components")
    return saved(known.join(least, "root").select("fp", "component"), "labels")


def near_duplicates(docs: DataFrame, heavy: int = HEAVY) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id of every document."""
    on_workers(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), fingerprints(F.col("text")).alias("fp"))
    rows = saved(rows, "simhash")
    found = components(rows.select("fp", F.col("doc_id").alias("rep")), heavy)
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return rows.join(found, "fp").select("doc_id", digits.alias("fingerprint"), F.col("component").alias("component_id"))


def close(each: DataFrame, budget: int = CLOSE, heavy: int = HEAVY) -> DataFrame:
    """Pairs (u, v) of ``fp`` whose fingerprints ``sim`` connect all that differ in at most ``budget`` bits.

    Those of one fingerprint are paired with the least of them, and these by :func:`links`."""
    heads = saved(each.groupBy("sim").agg(F.min("fp").alias("head"), F.count(F.lit(1)).alias("n")), "heads")
    same = join_named(each.select("fp", "sim"), heads.filter("n > 1"), "sim", each.count())
    same = same.filter("fp <> head").select(F.col("fp").alias("u"), F.col("head").alias("v"))
    edges = links(heads.select(F.col("sim").alias("fp")), heavy, budget).withColumnsRenamed({"u": "a", "v": "b"})
    u, v = (heads.select(F.col("sim").alias(key), F.col("head").alias(name)) for key, name in (("a", "u"), ("b", "v")))
    return same.unionByName(edges.join(u, "a").join(v, "b").select("u", "v"))


def one_of_each(docs: DataFrame, width: int = overlap.WIDTH, least: int = overlap.LEAST, budget: int = CLOSE) -> DataFrame:
    """The documents, all columns, with one row of every group: that of the smallest ``doc_id``,
    of several the first one stored.

    Documents link when their sets of ``width``-word shingles have Jaccard similarity of at least
    ``least`` percent.  Sets whose SimHash fingerprints differ in at most ``budget`` bits are found by the
    trie self-join and checked first, and what they tie together is one member from then on.  No budget of bits that a
    trie can be walked with reaches all sets of that similarity, so the others follow by MinHash buckets (see ``overlap``)."""
    on_workers(docs.sparkSession)
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        F.monotonically_increasing_id().alias("uid"),
        overlap.profiles(docs["text"], majority, width).alias("p"),
    )
    rows = saved(rows.select("row", "uid", "p.fp", "p.sim", "p.buckets"), "shingled")
    first = F.struct(F.col("row.doc_id").isNull().alias("none"), F.col("row.doc_id").alias("id"), "uid")
    each = rows.groupBy("fp").agg(F.min(first).alias("rep"), F.any_value("sim").alias("sim"), F.any_value("buckets").alias("buckets"))
    each = saved(each, "distinct")
    pairs = saved(close(each, budget), "close")
    found = overlap.members(each)
    # whole sets of those only that share a bucket or are close, from the text of one row each
    named = found.select("fp").unionByName(pairs.select(F.explode(F.array("u", "v")).alias("fp"))).distinct()
    chosen = each.join(named, "fp", "left_semi").select(F.col("rep.uid").alias("uid"))
    texts = numbered_in(rows, chosen, "uid")
    sets = saved(texts.select("fp", overlap.shingle_sets(F.col("row.text"), width).alias("set")), "sets")
    tied = overlap.groups(found, sets, roots, least, pairs)
    known = each.select("fp", "rep").join(tied, "fp", "left").select("rep", F.coalesce("label", "fp").alias("root"))
    kept = known.groupBy("root").agg(F.min("rep").alias("rep")).select(F.col("rep.uid").alias("uid"))
    return numbered_in(rows, kept, "uid").select("row.*")
