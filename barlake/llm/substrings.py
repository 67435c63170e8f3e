"""Words that stand in repeated passages, found by recompression.

A window is ``WIDTH`` consecutive words of one text.  A word is removed if a window over it has a
word sequence that also starts anywhere else in the corpus, in the same text too.

* Every text is recompressed (see ``recompression``): rounds name runs and pairs of symbols
  alike in all texts.  A window's key is the longest symbol of its cores, which its words alone
  decide, so a repeated window has a key that is shared.  Keys, about one for eight words, are
  counted over the corpus, and only windows whose key stands in two places go on.  A few keys may be in a large part
  of all texts; these are broadcast where keys are joined back, so none makes a hot task.
* What is shared is verified: a window is repeated if its 128-bit digest over the names of its words
  is found twice.  Equal digests are neighbours in a sorted partition, whatever their number; windows of
  hot keys meet in salted parts of their rows before.

Equal texts are one text with a number of copies: with two or more, all its windows are repeated and
nothing of it is kept; it takes part once.  Texts are known by 128 bits of XXH64 under two seeds, words by
128 bits of XXH3.

Null texts have no words.  Texts of any length are read whole, one at a time in a task's memory;
a text with fewer words than a window keeps all.  Repeated rows are copies.  An empty table gives an
empty result.  Only ``doc_id`` and ``text`` are read; other columns may have any name."""

from __future__ import annotations

import functools
import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.llm.common import HOT_ONE_IN, arrow_rows, grouped, join_named, on_workers, saved, text_or_empty
from barlake.llm.recompression import mixed, window_keys

WIDTH = 35
ROUNDS = 4
#: Names of words that a worker remembers; the memo is emptied beyond that.
MEMO = 1_000_000
_BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


@functools.cache
def _memo() -> dict[bytes, bytes]:
    return {}


def word_names(texts: list[list[bytes]]) -> np.ndarray:
    """Two 64-bit names of every word of the texts, one text after the other."""
    import xxhash

    memo = _memo()
    if len(memo) > MEMO:
        memo.clear()
    out = []
    for text in texts:
        found = list(map(memo.get, text))
        if None in found:
            for i, known in enumerate(found):
                if known is None:
                    found[i] = memo[text[i]] = xxhash.xxh3_128_digest(text[i])
        out.append(b"".join(found))
    return np.frombuffer(b"".join(out), dtype="<u8").reshape(-1, 2)


class Texts:
    """Some texts' windows of ``width`` words, and the distinct places of their keys.

    ``at``: first word of each window among all words; ``place_of``: its key's place, an index into
    ``keys``; ``first``: the first place of each text and, last, their number."""

    def __init__(self, texts: list[list[bytes]], width: int) -> None:
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        ends = np.cumsum(sizes)
        self.starts = ends - sizes
        self.names = word_names(texts)
        opens = np.zeros(len(self.names), dtype=bool)
        opens[self.starts[sizes > 0]] = True
        self.at, keys, places = window_keys(np.ascontiguousarray(self.names[:, 0]), opens, width, ROUNDS)
        order = np.lexsort((keys, places))
        keys, places = keys[order], places[order]
        new = np.ones(len(order), dtype=bool)
        new[1:] = (keys[1:] != keys[:-1]) | (places[1:] != places[:-1])
        self.place_of = np.empty(len(order), dtype=np.int64)
        self.place_of[order] = np.cumsum(new) - 1
        self.keys = keys[new]
        self.first = np.searchsorted(places[new], np.append(self.starts, len(self.names)))

    def digests(self, windows: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """128 bits of every chosen window's words."""
        out = []
        for lane, base in enumerate(_BASES):
            names = np.ascontiguousarray(self.names[:, lane])
            digest = np.zeros(len(windows), dtype=np.uint64)
            for k in range(width):
                digest = digest * base + names[windows + k]
            out.append(mixed(digest, base).view(np.int64))
        return out[0], out[1]


def _split(rows, text_at: int):
    """Groups of rows and their texts' words."""
    for group in grouped(rows, lambda r: len(r[text_at])):
        yield group, [r[text_at].split() for r in group]


def _profiled(width: int):
    """n_words, digest of all words and the keys' places of every document; words are joined by a space."""

    def run(batches):
        import pyarrow as pa

        names = ["doc_id", "h1", "h2", "n_words", "sha", "keys"]
        rows = ((*r[:3], r[3].encode()) for r in arrow_rows(batches, "doc_id", "h1", "h2", "text"))
        for group, texts in _split(rows, 3):
            known = Texts(texts, width)
            keys = pa.ListArray.from_arrays(pa.array(known.first.astype(np.int32)), pa.array(known.keys.view(np.int64)))
            columns = [pa.array([r[i] for r in group], pa.int64()) for i in range(3)]
            columns += [pa.array([len(t) for t in texts], pa.int64()), pa.array([hashlib.sha256(b" ".join(t)).hexdigest() for t in texts])]
            yield pa.RecordBatch.from_arrays([*columns, keys], names)

    return run


def _packed(width: int):
    """Texts with at least one window, compressed."""

    def run(batches):
        import pyarrow as pa
        import zstandard

        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            rows = [(h1, h2, pack(data)) for h1, h2, text in arrow_rows([batch], "h1", "h2", "text") if len((data := text.encode()).split()) >= width]
            kinds = (pa.int64(), pa.int64(), pa.binary())
            columns = [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(columns, ["h1", "h2", "packed"])

    return run


def _unpacked(rows, at: int):
    import zstandard

    unpack = zstandard.ZstdDecompressor().decompress
    return ((*r[:at], unpack(r[at]), *r[at + 1 :]) for r in rows)


def _candidates(width: int):
    """text_id, first word, digest and heat of every window whose key stands in two places.

    A key of a copied text counts once for each copy; if that is all, no other text has it."""

    def run(batches):
        import pyarrow as pa

        rows = _unpacked(arrow_rows(batches, "text_id", "packed", "n", "shared"), 1)
        for group, texts in _split(rows, 1):
            known = Texts(texts, width)
            use, hot = np.zeros(len(known.keys), dtype=bool), np.zeros(len(known.keys), dtype=bool)
            for i, (_, _, copies, shared) in enumerate(group):
                low, high = known.first[i], known.first[i + 1]
                own, back, times = np.unique(known.keys[low:high], return_inverse=True, return_counts=True)
                place = low + np.array([s["place"] for s in shared], dtype=np.int64)
                total = np.array([s["n"] for s in shared], dtype=np.int64)
                use[place] = total > (times[back[place - low]] * copies if copies > 1 else 1)
                hot[place] = [s["hot"] for s in shared]
            chosen = np.flatnonzero(use[known.place_of])
            at = known.at[chosen]
            of = np.searchsorted(known.starts, at, side="right") - 1
            ids = np.array([r[0] for r in group], dtype=np.int64)
            columns = [ids[of], (at - known.starts[of]).astype(np.int32), *known.digests(at, width), hot[known.place_of[chosen]]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["text_id", "at", "w1", "w2", "hot"])

    return run


#: A window of a hot key is first looked for in one of so many parts of its rows.
SALTS = 64
ALONE, MET, FIRST = range(3)


def _neighbours(batches):
    """Rows, sorted by digest, with what is known of each: alone with its digest, met again, or the
    first one of those met again."""
    import pyarrow as pa

    columns = ["text_id", "at", "w1", "w2"]

    def told(row, state):
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32())
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip((*row, state), kinds)], [*columns, "state"])

    last, carried = None, False  # the last row is held back until its successor is known
    for batch in batches:
        ids, at, w1, w2 = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in columns)
        if not len(ids):
            continue
        same = np.zeros(len(ids) + 1, dtype=bool)  # with the row before
        same[1:-1] = (w1[1:] == w1[:-1]) & (w2[1:] == w2[:-1])
        same[0] = last is not None and last[2:] == (w1[0], w2[0])
        if last is not None:
            yield told(last, MET if carried else FIRST if same[0] else ALONE)
        state = np.where(same[:-1], MET, np.where(same[1:], FIRST, ALONE)).astype(np.int32)
        last, carried = (ids[-1], at[-1], w1[-1], w2[-1]), bool(same[-2])
        yield pa.RecordBatch.from_arrays([pa.array(c[:-1]) for c in (ids, at, w1, w2, state)], [*columns, "state"])
    if last is not None:
        yield told(last, MET if carried else ALONE)


def _removed(width: int):
    """Spans of words to remove from each text, their words, and the digest of the others."""

    def run(batches):
        import pyarrow as pa

        spans_type = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))
        for given in batches:
            rows = []
            for h1, h2, text, at in _unpacked(arrow_rows([given], "h1", "h2", "packed", "at"), 2):
                words = text.split()
                change = np.zeros(len(words) + 1, dtype=np.int64)
                starts = np.array(at, dtype=np.int64)
                np.add.at(change, starts, 1)
                np.add.at(change, starts + width, -1)
                gone = np.cumsum(change) > 0  # the last one, behind the text, is always false
                edges = np.flatnonzero(np.diff(gone, prepend=False)).reshape(-1, 2)
                kept = b" ".join(w for w, g in zip(words, gone.tolist()) if not g)
                spans = [{"first": a, "end": b} for a, b in edges.tolist()]
                rows.append((h1, h2, int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
            kinds = (pa.int64(), pa.int64(), pa.int64(), spans_type, pa.string())
            columns = [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(columns, ["h1", "h2", "n_removed", "removed", "kept_sha256"])

    return run


_SPANS = "array<struct<first: int, end: int>>"


def _named(text: Column) -> list[Column]:
    return [F.xxhash64(F.lit(i), text).alias(f"h{i}") for i in (1, 2)]


def shared_places(profiles: DataFrame) -> DataFrame:
    """h1, h2 and shared: the places of each text's keys that stand in two places of the corpus, with
    how many places there are (``n``) and whether they are a large part of all (``hot``)."""
    counted = profiles.select(F.explode("keys").alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    counted = saved(counted.filter("n > 1"), "shared-keys")
    total = profiles.agg(F.coalesce(F.sum(F.size("keys")), F.lit(0))).first()[0]
    placed = profiles.select("uid", F.posexplode("keys").alias("place", "key"))
    each = join_named(placed, counted, "key", total)
    hot = (F.col("n") * HOT_ONE_IN > total).alias("hot")
    listed = each.groupBy("uid").agg(F.collect_list(F.struct("place", "n", hot)).alias("shared"))  # a text's words bound it
    # copies have the same places
    return profiles.select("uid", "h1", "h2").join(listed, "uid").groupBy("h1", "h2").agg(F.first("shared").alias("shared"))


def _met(windows: DataFrame, *salt: Column) -> DataFrame:
    """text_id, at, w1, w2 and state of the windows among those with the same salt."""
    parts = int(windows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salts = ["salt" for _ in salt]
    dealt = windows.select("text_id", "at", "w1", "w2", *salt).repartition(parts, "w1", *salts)
    dealt = dealt.sortWithinPartitions(*salts, "w1", "w2").select("text_id", "at", "w1", "w2")
    return dealt.mapInArrow(_neighbours, "text_id long, at int, w1 long, w2 long, state int")


def repeated_windows(windows: DataFrame) -> DataFrame:
    """text_id and at of the windows whose digest is found twice; some may come twice.

    Windows of hot keys are dealt out by digest and salt first.  Those that meet an equal one there are
    known; the others, and one for all that are known, are looked for once more without salt, at most
    ``SALTS`` of each digest."""
    salt = F.pmod(F.xxhash64("text_id", "at"), F.lit(SALTS)).alias("salt")
    often = saved(_met(windows.filter("hot"), salt), "hot-windows")
    rest = _met(windows.filter("not hot")).unionByName(_met(often.filter(F.col("state") != MET).drop("state")))
    return rest.unionByName(often).filter(F.col("state") != ALONE).select("text_id", "at")


def repeats(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, n_words, n_removed, removed (spans of words, end excluded) and kept_sha256 of every document."""
    on_workers(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *_named(text_or_empty()), text_or_empty().alias("text"))
    shape = "doc_id long, h1 long, h2 long, n_words long, sha string, keys array<long>"
    profiles = rows.mapInArrow(_profiled(width), shape).withColumn("uid", F.monotonically_increasing_id())
    profiles = saved(profiles, "profiles")
    copies = saved(profiles.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.first("n_words").alias("n_words")), "copies")

    shared = shared_places(profiles).join(copies.select("h1", "h2", "n"), ["h1", "h2"])
    texts = rows.select("h1", "h2", "text").mapInArrow(_packed(width), "h1 long, h2 long, packed binary")
    texts = texts.groupBy("h1", "h2").agg(F.first("packed").alias("packed")).join(shared, ["h1", "h2"])
    texts = saved(texts.withColumn("text_id", F.monotonically_increasing_id()), "texts")
    windows = texts.select("text_id", "packed", "n", "shared").mapInArrow(_candidates(width), "text_id long, at int, w1 long, w2 long, hot boolean")
    found = repeated_windows(saved(windows, "windows")).groupBy("text_id").agg(F.collect_list("at").alias("at"))
    alone = texts.filter("n = 1").select("text_id", "h1", "h2", "packed").join(found, "text_id").drop("text_id")
    found = alone.mapInArrow(_removed(width), f"h1 long, h2 long, n_removed long, removed {_SPANS}, kept_sha256 string")

    # copies lose all they have
    whole = F.array(F.struct(F.lit(0).alias("first"), F.col("n_words").cast("int").alias("end"))).cast(_SPANS)
    gone = copies.filter(f"n > 1 and n_words >= {width}").select(
        "h1", "h2", "n", F.col("n_words").alias("n_removed"), whole.alias("removed"), F.lit(hashlib.sha256().hexdigest()).alias("kept_sha256")
    )
    total = profiles.count()
    hot = F.col("n") * HOT_ONE_IN > total
    often = F.broadcast(gone.filter(hot).drop("n"))
    small = profiles.select("doc_id", "h1", "h2", "n_words", "sha")
    rest = small.join(often.select("h1", "h2"), ["h1", "h2"], "left_anti")
    rest = rest.join(found.unionByName(gone.filter(~hot).drop("n")), ["h1", "h2"], "left")
    return small.join(often, ["h1", "h2"]).unionByName(rest).select(
        "doc_id", "n_words", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("removed", F.array().cast(_SPANS)).alias("removed"), F.coalesce("kept_sha256", "sha").alias("kept_sha256"),
    )
