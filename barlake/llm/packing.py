"""Cost-balanced packing of token sequences.

The cost of a piece of n tokens is estimated as linear + quadratic attention work.  Within a
batch of documents as many sequences are opened as the tokens need; pieces go in descending
order to the sequence of lowest cost that still has room.  A document longer than a sequence
first gives off full sequences; what fits nowhere at the end is cut to fill the room that is
left, so a batch pads at most its last sequence.

A batch is a run of rows of one task, bounded by ``batch_tokens``; documents never leave their
task, so nothing is shuffled and a lost executor costs only its own tasks.  Sequence ids carry
the partition's number; ``docs`` should be a table (or another input whose partitions come out
the same again).

Null texts count as empty; an empty document still has its end id.  Repeated rows are packed
as often as they occur, ties go by row order, an empty table gives no pieces, and only
``doc_id`` and ``text`` are read."""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.llm.chunks import encoded_rows, worded
from barlake.llm.common import arrow_rows, on_workers, text_or_empty

TOKENIZER = "word_bpe_49k.json"
END = 1
CAPACITY = 2048
#: Weight of a token's own work, in units of one attended pair.
LINEAR = 4096.0
BATCH_TOKENS = 1 << 21

PIECE = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, cost double"
)


def cost(n, linear: float = LINEAR):
    """Linear work plus the attended pairs of a causal piece of ``n`` tokens."""
    return linear * n + n * n / 2.0


def assign(lengths: np.ndarray, capacity: int = CAPACITY, linear: float = LINEAR) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of every piece of the given documents."""
    pieces, full = [], 0
    rest = []
    for i, n in enumerate(lengths.tolist()):
        at = 0
        while n - at >= capacity:
            pieces.append((i, at, capacity, full, 0))
            full += 1
            at += capacity
        if n > at:
            rest.append((n - at, i, at))
    rest.sort(key=lambda x: -x[0])
    k = -(-sum(x[0] for x in rest) // capacity)
    room, load = np.full(k, capacity, dtype=np.int64), np.zeros(k)

    def put(s: int, i: int, at: int, n: int) -> None:
        pieces.append((i, at, n, full + s, int(capacity - room[s])))
        room[s] -= n
        load[s] += cost(n, linear)

    left = []
    for n, i, at in rest:
        fits = np.where(room >= n, load, np.inf)
        s = int(np.argmin(fits))
        if fits[s] == np.inf:
            left.append((n, i, at))
        else:
            put(s, i, at, n)
    for n, i, at in left:  # the sequences have room for all of it, in parts
        while n:
            s = int(np.argmin(np.where(room > 0, load, np.inf)))
            part = min(n, int(room[s]))
            put(s, i, at, part)
            n, at = n - part, at + part
    return pieces


def packed(
    docs: DataFrame,
    tokenizer: str = TOKENIZER,
    end: int = END,
    capacity: int = CAPACITY,
    linear: float = LINEAR,
    batch_tokens: int = BATCH_TOKENS,
) -> DataFrame:
    """One row per piece of a document, with its sequence and place there."""
    tail = np.array([end], dtype="<u4").tobytes()

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        first = TaskContext.get().partitionId() << 32
        rows = encoded_rows(arrow_rows(batches, "doc_id", "text"), worded(tokenizer), 1)
        held, tokens = [], 0

        def flush():
            nonlocal first
            found = assign(np.array([len(ids) // 4 for _, ids in held], dtype=np.int64), capacity, linear)
            for at in range(0, len(found), 8192):
                part = found[at : at + 8192]
                cells = [
                    pa.array([held[i][0] for i, *_ in part], pa.int64()),
                    pa.array([s for _, s, _, _, _ in part], pa.int64()),
                    pa.array([n for _, _, n, _, _ in part], pa.int64()),
                    pa.array([zlib.crc32(held[i][1][4 * s : 4 * (s + n)]) for i, s, n, _, _ in part], pa.int64()),
                    pa.array([len(held[i][1]) // 4 for i, *_ in part], pa.int64()),
                    pa.array([first + q for _, _, _, q, _ in part], pa.int64()),
                    pa.array([o for _, _, _, _, o in part], pa.int64()),
                    pa.array([cost(n, linear) for _, _, n, _, _ in part], pa.float64()),
                ]
                yield pa.RecordBatch.from_arrays(cells, [c.split()[0] for c in PIECE.split(", ")])
            first += max((q for _, _, _, q, _ in found), default=-1) + 1

        for doc_id, ids in rows:
            held.append((doc_id, ids + tail))
            tokens += len(ids) // 4 + 1
            if tokens >= batch_tokens:
                yield from flush()
                held, tokens = [], 0
        if held:
            yield from flush()

    on_workers(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(run, PIECE)
