"""Importance resampling of documents towards a target, by hashed n-grams of words.

A text is lower-cased (A-Z only) and its words are runs of ASCII digits and letters and of
characters beyond ASCII.  Features are the runs of one to three consecutive words of the whole
text, each hashed to one of ``BUCKETS`` buckets.  What a bucket gains is the rounded-down log
ratio of its smoothed shares among the target's and the corpus' features; a document's weight
is the sum of its features' gains, and the documents drawn have the highest sums of weight and
a Gumbel number that the document's id decides.

Segments are deduplicated: a newline is no part of a word, so newlines cut texts into lines,
and lines repeat.  Lines are grouped by their text; the buckets of a distinct line are computed
once, stored, and multiplied by the line's occurrences, and so is its sum of gains.  The
runs that cross a line end are few; they are counted per document and added to both.
A line is known by its 128-bit XXH3 digest where documents meet their lines again; a line
that makes up more than a thousandth of all lines is broadcast there, so none is hot.

Null texts count as empty: no features, weight 0.  Texts of any length are read whole; one text
at a time is in a task's memory.  Repeated rows count each time and are weighed and drawn each
on its own; between equal scores the smaller ``doc_id`` goes first (null before all), rows that
are equal in both are drawn in any order.  A null ``doc_id`` hashes as an empty one.  Empty
tables give an empty result; an empty target has no features, which the smoothing allows.  Only
``doc_id`` and ``text`` are read; other columns may have any name."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.llm.common import arrow_rows, join_named, numbered, on_workers, saved, text_or_empty

BUCKETS = 10_000
SEED = 42
#: Documents with fewer words are not drawn, and of the others so many percent are.
LEAST_WORDS = 20
PERCENT = 5
#: Buckets that a batch of results holds, about.
OUT_VALUES = 1 << 20

#: Letters to lower case, all other bytes below 128 but digits to spaces.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def words(data: bytes) -> list[bytes]:
    return data.translate(_FOLD).split()


def line_buckets(found: list[bytes]) -> list[int]:
    """The bucket of every feature of consecutive words; a checksum is carried on from run to longer run."""
    from zlib import crc32

    spaced = [b" " + w for w in found]
    one = list(map(crc32, found))
    two = list(map(crc32, spaced[1:], one))
    three = list(map(crc32, spaced[2:], two))
    return [c % BUCKETS for c in (*one, *two, *three)]


def crossing_buckets(lines: list[list[bytes]]) -> list[int]:
    """Buckets of the features that begin in one line and end in another; no line is without words."""
    from zlib import crc32

    out: list[int] = []
    tail: list[bytes] = []
    for line in lines:
        if tail:
            out.append(crc32(tail[-1] + b" " + line[0]))
            if len(tail) > 1:
                out.append(crc32(b" ".join((*tail[-2:], line[0]))))
            if len(line) > 1:
                out.append(crc32(b" ".join((tail[-1], *line[:2]))))
        tail = (tail + line[-2:])[-2:]
    return [c % BUCKETS for c in out]


def _digest(line: bytes) -> bytes:
    import xxhash

    return xxhash.xxh3_128_digest(line)


def _documents(batches):
    """doc_id, n_words, crossing buckets and line digests of every document."""
    import pyarrow as pa

    rows, held = [], 0
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_words", pa.int64()), ("crossing", pa.list_(pa.int16())), ("lines", pa.list_(pa.binary()))]
    )

    def batch():
        columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)]
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    for doc_id, text in arrow_rows(batches, "doc_id", "text"):
        digests, lines = [], []
        for line in text.encode().split(b"\n"):
            if found := words(line):
                digests.append(_digest(line))
                lines.append(found)
        rows.append((doc_id, sum(map(len, lines)), crossing_buckets(lines), digests))
        held += 4 * len(lines) + 1
        if held > OUT_VALUES:
            yield batch()
            rows, held = [], 0
    if rows:
        yield batch()


def _lines(batches):
    """Digest, occurrences and buckets of every distinct line that has a word."""
    import pyarrow as pa

    keys, times, values, ends = [], [], [], [0]

    def batch():
        listed = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int16()))
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(times, pa.int64()), listed], ["key", "n", "buckets"])

    for line, n in arrow_rows(batches, "line", "n"):
        data = line.encode()
        if found := words(data):
            keys.append(_digest(data))
            times.append(n)
            values.extend(line_buckets(found))
            ends.append(len(values))
            if len(values) > OUT_VALUES:
                yield batch()
                keys, times, values, ends = [], [], [], [0]
    if keys:
        yield batch()


def _flat(column) -> tuple[np.ndarray, np.ndarray]:
    """Values of an Arrow list column, and how many each row has."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64), np.diff(column.offsets.to_numpy())


def _tallied(batches):
    """Occurrences of each bucket among a task's rows (``n``, ``buckets``)."""
    import pyarrow as pa

    counts = np.zeros(BUCKETS, dtype=np.int64)
    for batch in batches:
        flat, sizes = _flat(batch.column(1))
        times = np.repeat(batch.column(0).to_numpy(), sizes)
        counts += np.bincount(flat, weights=times, minlength=BUCKETS).astype(np.int64)
    met = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(met.astype(np.int32)), pa.array(counts[met])], ["bucket", "n"])


def _weighed(gains: np.ndarray):
    """Rows with their list of buckets, the last column, replaced by the sum of its gains."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            flat, sizes = _flat(batch.columns[-1])
            upto = np.concatenate([[0], np.cumsum(gains[flat])])
            ends = np.cumsum(sizes)
            sums = upto[ends] - upto[ends - sizes]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sums, pa.int64())], [*batch.schema.names[:-1], "weight"])

    return run


def profiles(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, uid, crossing (buckets of the features that cross a
    line end) and lines (digests of its lines with words)."""
    on_workers(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    found = rows.mapInArrow(_documents, "doc_id long, n_words long, crossing array<short>, lines array<binary>")
    return saved(found.withColumn("uid", F.monotonically_increasing_id()), "profiles")


def distinct_lines(docs: DataFrame) -> DataFrame:
    """key, n and buckets of every distinct line with words: counted before and after the
    shuffle, so a line that is everywhere costs a row per task."""
    lines = docs.select(F.explode(F.split(text_or_empty(), "\n")).alias("line"))
    counted = lines.groupBy("line").agg(F.count(F.lit(1)).alias("n"))
    return saved(counted.mapInArrow(_lines, "key binary, n long, buckets array<short>"), "lines")


def tallies(documents: DataFrame, lines: DataFrame) -> np.ndarray:
    """How often each bucket occurs; ``BUCKETS`` numbers, whatever the input."""
    rows = lines.select("n", "buckets").unionByName(documents.select(F.lit(1).cast("long").alias("n"), F.col("crossing").alias("buckets")))
    found = rows.mapInArrow(_tallied, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    counts = np.zeros(BUCKETS, dtype=np.int64)
    for bucket, n in found.collect():
        counts[bucket] = n
    return counts


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln(smoothed target share / smoothed corpus share)) of every bucket, in doubles."""
    s, t = corpus.astype(np.float64), target.astype(np.float64)
    ratio = (t + 1) * (s.sum() + BUCKETS) / ((s + 1) * (t.sum() + BUCKETS))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weights(documents: DataFrame, lines: DataFrame, gains: np.ndarray) -> DataFrame:
    """doc_id, uid, n_words and weight of every document."""
    own = documents.select("doc_id", "uid", "n_words", "crossing").mapInArrow(_weighed(gains), "doc_id long, uid long, n_words long, weight long")
    priced = saved(lines.mapInArrow(_weighed(gains), "key binary, n long, weight long"), "line-weights")
    total = priced.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    placed = documents.select("uid", F.explode("lines").alias("key"))
    summed = join_named(placed, priced, "key", total).groupBy("uid").agg(F.sum("weight").alias("lines_weight"))
    both = F.col("weight") + F.coalesce("lines_weight", F.lit(0))
    return own.join(summed, "uid", "left").select("doc_id", "uid", "n_words", both.alias("weight"))


def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    """floor(1000 Gumbel), decided by ``doc_id``."""
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 8)
    uniform = (F.conv(digits, 16, 10).cast("double") + 0.5) / 4294967296.0
    return F.floor(F.lit(-1000.0) * F.log(-F.log(uniform)))


def resampled(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """doc_id, n_features, weight, score and rank (from 1, null if not drawn) of every document;
    ``target`` has a column ``text``."""
    documents, lines = profiles(docs), distinct_lines(docs)
    aim = target.select(F.lit(None).cast("long").alias("doc_id"), "text")
    gains = bucket_gains(tallies(documents, lines), tallies(profiles(aim), distinct_lines(aim)))
    n = F.col("n_words")
    features = n + F.greatest(n - 1, F.lit(0)) + F.greatest(n - 2, F.lit(0))
    scored = weights(documents, lines, gains).select(
        "doc_id", "uid", features.alias("n_features"), "weight", (F.col("weight") + gumbel(F.col("doc_id"))).alias("score"),
        (n >= least_words).alias("eligible"),
    )
    draw = documents.filter(n >= least_words).count() * percent // 100
    ranked = numbered(scored, F.desc("eligible"), F.desc("score"), F.asc("doc_id"), F.asc("uid"))
    rank = F.when(F.col("eligible") & (F.col("number") < draw), F.col("number") + 1)
    return ranked.select("doc_id", "n_features", "weight", "score", rank.alias("rank"))
