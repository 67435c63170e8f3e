"""Token ids in bit planes, compressed plane by plane.

The file format.  Ids are cut into blocks of a fixed number; a block is turned into bit
planes (plane p holds bit p of every id of the block, packed eight to a byte, lowest id in the
highest bit), and every plane is compressed by zstandard on its own.  A chunk is a run of
whole documents of about ``chunk_ids`` ids.  Chunks are rows of Parquet files, so that they
are written by Spark's own committer to any shared store and read again after the loss of an
executor: ``ids`` holds the chunks in ascending document order within ascending shards, and
``index`` holds, for each chunk, where its ids begin in the whole sequence, how many there
are, its documents' span and its size, for readers that want a part.

A document is never split over chunks, so each chunk can be read on its own.  Null texts count
as empty; an empty document has only its end id.  Equal ``doc_id`` are ordered by text, null
``doc_id`` come first; an empty table gives an empty file; only ``doc_id`` and ``text`` are read."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barlake.llm.chunks import byte_level, encoded_rows
from barlake.llm.common import arrow_rows, on_workers, text_or_empty

TOKENIZER = "byte_bpe_50k.json"
END = 2
BLOCK = 16_384
CHUNK_IDS = 131_072
LEVEL = 3

CHUNK = (
    "shard int, chunk int, first long, n_ids long, doc_ids array<long>, lengths array<long>, width int, block int,"
    " plane_bytes array<int>, planes binary, crc32 long"
)


def to_planes(ids: np.ndarray, block: int = BLOCK, level: int = LEVEL) -> tuple[int, list[bytes]]:
    """Bit width, and the compressed planes of all blocks, block after block, low bit first."""
    import zstandard

    codec = zstandard.ZstdCompressor(level=level)
    width = max(1, int(ids.max(initial=0)).bit_length())
    out = []
    for at in range(0, len(ids), block):
        part = ids[at : at + block].astype(np.uint32)
        bits = (part[None, :] >> np.arange(width, dtype=np.uint32)[:, None]) & np.uint32(1)
        out += [codec.compress(row.tobytes()) for row in np.packbits(bits.astype(np.uint8), axis=1)]
    return width, out


def from_planes(planes: bytes, sizes: list[int], width: int, n_ids: int, block: int = BLOCK) -> np.ndarray:
    import zstandard

    codec = zstandard.ZstdDecompressor()
    ids = np.zeros(n_ids, dtype="<u4")
    ends = np.cumsum(sizes).tolist()
    for b, at in enumerate(range(0, n_ids, block)):
        part = ids[at : at + block]
        for p in range(width):
            k = b * width + p
            raw = codec.decompress(planes[ends[k] - sizes[k] : ends[k]])
            part |= np.unpackbits(np.frombuffer(raw, np.uint8), count=len(part)).astype(np.uint32) << np.uint32(p)
    return ids


def _chunks(rows: Iterator[tuple], shard: int, tail: bytes, block: int, chunk_ids: int, level: int) -> Iterator[tuple]:
    doc_ids, parts, held, first, number = [], [], 0, 0, 0

    def flush():
        data = b"".join(parts)
        ids = np.frombuffer(data, dtype="<u4")
        width, planes = to_planes(ids, block, level)
        lengths = [len(p) // 4 for p in parts]
        sizes = [len(p) for p in planes]
        return (
            shard, number, first, len(ids), list(doc_ids), lengths, width, block, sizes, b"".join(planes), zlib.crc32(data)
        )

    for doc_id, ids in rows:
        doc_ids.append(doc_id)
        parts.append(ids + tail)
        held += len(ids) // 4 + 1
        if held >= chunk_ids:
            yield flush()
            first, number = first + held, number + 1
            doc_ids, parts, held = [], [], 0
    if parts:
        yield flush()


def write(
    docs: DataFrame,
    path: str,
    tokenizer: str = TOKENIZER,
    end: int = END,
    shards: int | None = None,
    block: int = BLOCK,
    chunk_ids: int = CHUNK_IDS,
    level: int = LEVEL,
) -> None:
    """Encode all documents and write ``path``/ids and ``path``/index.

    One range shuffle of the texts by ``doc_id`` puts them in order; each range is encoded and
    written by its task as it is read."""
    spark = docs.sparkSession
    on_workers(spark)
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tail = np.array([end], dtype="<u4").tobytes()

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        rows = encoded_rows(arrow_rows(batches, "doc_id", "text"), byte_level(tokenizer), 1)
        i32, i64 = pa.int32(), pa.int64()
        kinds = [i32, i32, i64, i64, pa.list_(i64), pa.list_(i64), i32, i32, pa.list_(i32), pa.binary(), i64]
        names = [c.strip().split()[0] for c in CHUNK.split(",")]
        for row in _chunks(rows, shard, tail, block, chunk_ids, level):
            yield pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip(row, kinds)], names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    ordered = rows.repartitionByRange(shards, "doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text")
    # planes are compressed already
    ordered.select("doc_id", "text").mapInArrow(run, CHUNK).write.option("compression", "none").parquet(f"{path}/ids")

    chunks = spark.read.parquet(f"{path}/ids")
    totals = chunks.groupBy("shard").agg(F.sum("n_ids").alias("total"))  # a row per shard, not per document
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("shard", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    index = chunks.join(F.broadcast(bases), "shard").select(
        "shard",
        "chunk",
        (F.col("base") + F.col("first")).alias("start"),
        "n_ids",
        F.array_min("doc_ids").alias("first_doc"),
        F.array_max("doc_ids").alias("last_doc"),
        F.size("doc_ids").alias("n_docs"),
        F.length("planes").alias("n_bytes"),
    )
    index.write.parquet(f"{path}/index")


def chunk_ids(row) -> np.ndarray:
    """The ids of one chunk, checked against its digest."""
    ids = from_planes(row["planes"], row["plane_bytes"], row["width"], row["n_ids"], row["block"])
    if zlib.crc32(ids.tobytes()) != row["crc32"]:
        raise ValueError(f"chunk {row['chunk']} of shard {row['shard']} is damaged")
    return ids


def _read(spark: SparkSession, path: str, run, schema: str) -> DataFrame:
    on_workers(spark)
    bases = spark.read.parquet(f"{path}/index").filter("chunk = 0").select("shard", F.col("start").alias("base"))
    chunks = spark.read.parquet(f"{path}/ids").join(F.broadcast(bases), "shard")  # a row per shard
    return chunks.withColumn("start", F.col("base") + F.col("first")).mapInArrow(run, schema)


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, ids) of every document, decoded chunk by chunk."""

    def run(batches):
        import pyarrow as pa

        for row in _rows(batches):
            ids = chunk_ids(row)
            ends = np.cumsum(row["lengths"])
            starts = ends - row["lengths"]
            cells = [
                pa.array(row["doc_ids"], pa.int64()),
                pa.array(starts + row["start"], pa.int64()),
                pa.array([ids[a:b] for a, b in zip(starts, ends)], pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(cells, ["doc_id", "start", "ids"])

    return _read(spark, path, run, "doc_id long, start long, ids array<long>")


def digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files."""

    def run(batches):
        import pyarrow as pa

        for row in _rows(batches):
            data = chunk_ids(row).tobytes()
            ends = np.cumsum(row["lengths"])
            starts = ends - row["lengths"]
            cells = [
                pa.array(row["doc_ids"], pa.int64()),
                pa.array(starts + row["start"], pa.int64()),
                pa.array(row["lengths"], pa.int64()),
                pa.array([zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist())], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(cells, ["doc_id", "start", "n_tokens", "ids_crc32"])

    return _read(spark, path, run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _rows(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]
