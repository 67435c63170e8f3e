"""Byte-level BPE by a sentencepiece model that is written straight from a rank file.

Every rank's bytes become a piece of byte-mapped characters with the negative rank as its
score, the normaliser is the identity, and nothing is trained.  A text is split by the
pattern; each match is encoded by the model, unless it is a piece as a whole, which the rank
file's own library takes first.  Decoding looks up each id's bytes.

Null texts count as empty; an empty text has no ids.  Repeated rows give repeated results,
an empty table an empty result; only ``doc_id`` and ``text`` are read, whatever else is there."""

from __future__ import annotations

import base64
import functools
import hashlib
import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.llm.common import arrow_rows, grouped, on_workers, text_or_empty

RANKS = "byte_bpe_multi_50k.tiktoken"
MEMO = 300_000
LONG = 256
#: Name of the unknown piece: white space never occurs in byte-mapped text.
UNKNOWN = " unknown"


def byte_alphabet() -> list[str]:
    """One visible character for each byte: itself where it is printable, else the next free one from U+0100."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = (b for b in range(256) if b not in set(printable))
    chars = {b: chr(b) for b in printable} | {b: chr(256 + n) for n, b in enumerate(rest)}
    return [chars[b] for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


# protobuf wire format: a varint, and a field with a payload of known length
def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, payload: bytes) -> bytes:
    return _varint(number << 3 | 2) + _varint(len(payload)) + payload


def _number(number: int, value: int) -> bytes:
    return _varint(number << 3) + _varint(value)


def serialise(ranks: dict[bytes, int]) -> bytes:
    """A sentencepiece model whose ids are the ranks' order, with the unknown piece last."""
    import struct

    alphabet = byte_alphabet()
    pieces = []
    for raw, rank in sorted(ranks.items(), key=lambda x: x[1]):
        name = "".join(alphabet[b] for b in raw).encode()
        pieces.append(_field(1, _field(1, name) + b"\x15" + struct.pack("<f", -rank)))
    pieces.append(_field(1, _field(1, UNKNOWN.encode()) + b"\x15" + struct.pack("<f", 0.0) + _number(3, 2)))
    none = (1 << 64) - 1  # -1: no such piece
    trainer = _number(3, 2) + _number(4, len(pieces)) + _number(40, len(ranks))  # BPE, size, unknown's id
    trainer += _number(41, none) + _number(42, none) + _number(43, none) + _field(45, UNKNOWN.encode())
    # identity: no dummy prefix, white space neither removed nor replaced
    normaliser = _field(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0)
    return b"".join(pieces) + _field(2, trainer) + _field(3, normaliser)


class Codec:
    def __init__(self, path: str, pattern: str) -> None:
        import regex
        import sentencepiece

        ranks = read_ranks(path)
        self.split = regex.compile(pattern).findall
        self.order = sorted(ranks.values())
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialise(ranks))
        alphabet = byte_alphabet()
        self.to_chars = {b: c for b, c in enumerate(alphabet)}
        byte = {c: b for b, c in enumerate(alphabet)}
        # the inverse mapping: the bytes of each id, as the model names its pieces
        self.bytes_of = {
            rank: bytes(byte[c] for c in self.model.id_to_piece(i)) for i, rank in enumerate(self.order)
        }
        self.whole = {raw.decode(): str(rank) for raw, rank in ranks.items() if _is_text(raw)}
        self.memo: dict[str, str] = {}

    def mapped(self, part: str) -> str:
        return part.encode().decode("latin-1").translate(self.to_chars)

    def encode(self, texts: list[str]) -> list[list[str]]:
        """Decimal ids of each text."""
        parts = [self.split(t) for t in texts]
        if len(self.memo) > MEMO:
            self.memo.clear()
        fresh = list(set().union(*parts).difference(self.memo))
        unknown = [p for p in fresh if p not in self.whole]
        for p in fresh:
            if p in self.whole:
                self.memo[p] = self.whole[p]
        for group in grouped(unknown, len):
            found = self.model.encode([self.mapped(p) for p in group], out_type=int, num_threads=1)
            for p, ids in zip(group, found):
                self.memo[p] = ",".join([str(self.order[i]) for i in ids])
        out = [",".join(map(self.memo.__getitem__, p)) for p in parts]
        for p in fresh:
            if len(p) > LONG:
                del self.memo[p]
        return [o.split(",") if o else [] for o in out]

    def decode(self, ids: list[str]) -> bytes:
        return b"".join([self.bytes_of[int(i)] for i in ids])


def _is_text(raw: bytes) -> bool:
    try:
        raw.decode()
    except UnicodeDecodeError:
        return False
    return True


@functools.cache
def codec(name: str) -> Codec:
    """One per worker and file."""
    import public_tokenizers

    path = name if os.path.sep in name else public_tokenizers.path(name)
    return Codec(path, public_tokenizers.PATTERN)


def encoded(docs: DataFrame, ranks: str = RANKS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids): the ids of every whole text."""

    def run(batches):
        import pyarrow as pa

        own = codec(ranks)
        for group in grouped(arrow_rows(batches, "k", "t"), lambda r: len(r[1])):
            ids = [list(map(int, x)) for x in own.encode([t for _, t in group])]
            keys = pa.array([k for k, _ in group], pa.int64())
            yield pa.RecordBatch.from_arrays([keys, pa.array(ids, pa.list_(pa.int32()))], ["k", "ids"])

    on_workers(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("k"), text_or_empty(text_col).alias("t"))
    return rows.mapInArrow(run, "k long, ids array<int>").withColumnRenamed("k", id_col)


def decoded(encoded_docs: DataFrame, ranks: str = RANKS, id_col: str = "doc_id") -> DataFrame:
    """(id, data): the bytes that ``ids`` stand for."""

    def run(batches):
        import pyarrow as pa

        own = codec(ranks)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                data = [own.decode(x or []) for x in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(data, pa.binary())], ["k", "data"])

    on_workers(encoded_docs.sparkSession)
    rows = encoded_docs.select(F.col(id_col).alias("k"), "ids")
    return rows.mapInArrow(run, "k long, data binary").withColumnRenamed("k", id_col)


def round_trip(docs: DataFrame, ranks: str = RANKS) -> DataFrame:
    """doc_id, n_tokens, and the digests of the ids and of what they decode to; one pass, no shuffle."""

    def run(batches):
        import pyarrow as pa

        own = codec(ranks)
        for group in grouped(arrow_rows(batches, "doc_id", "text"), lambda r: len(r[1])):
            found = own.encode([t for _, t in group])
            cells = [
                [k for k, _ in group],
                [len(x) for x in found],
                [hashlib.sha256(",".join(x).encode()).hexdigest() for x in found],
                [hashlib.sha256(own.decode(x)).hexdigest() for x in found],
            ]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(cells, kinds)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            )

    on_workers(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
