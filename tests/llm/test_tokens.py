from __future__ import annotations

import hashlib
import itertools
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from barlake.llm import bpe, chunks, packing, planes, wordpiece


def library(name: str) -> Tokenizer:
    return Tokenizer.from_file(public_tokenizers.path(name))


def crc(ids) -> int:
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def noise(n: int) -> list[str]:
    random.seed(5)
    letters = " \n\tab'sé1́. \x1f中ΣİK▁0"
    return ["".join(random.choice(letters) for _ in range(random.randint(0, 14))) for _ in range(n)]


@pytest.mark.parametrize("encoder", [chunks.byte_level("byte_bpe_50k.json"), chunks.worded("word_bpe_49k.json")])
def test_pieces_give_the_ids_of_whole_texts(encoder):
    texts = noise(4000) + ["  a", "a ", "a  b", "a \n \n b", "İ. x", "\x00 a b", "x" * 1000 + " y"]
    texts += ["hello <|endoftext|> x", "<|startoftext|>a b", "a <|endoftext|", "THE The the. THE.\nThe\nthe", "a \x01 b \x01b", "don't\n's 'll.\n\nx", "a\n" + "y" * 900 + "\nB c"]
    plain = library("byte_bpe_50k.json" if isinstance(encoder, chunks.ByteLevel) else "word_bpe_49k.json")
    for _ in range(2):  # met before, the second time
        assert encoder.encode(texts) == [np.array(plain.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes() for t in texts]
    special = plain.encode("hello <|endoftext|> x", add_special_tokens=False).ids
    assert plain.token_to_id("<|endoftext|>") in special


def test_automaton_pops_greedy_pieces():
    random.seed(3)
    for _ in range(300):
        pieces = {"".join(random.choice("abcé") for _ in range(random.randint(1, 6))) for _ in range(9)}
        machine = wordpiece.Automaton(pieces)
        for word in ("".join(random.choice("abcéz") for _ in range(random.randint(0, 20))) for _ in range(10)):
            at = n = 0
            while at < len(word):
                fits = [k for k in range(6, 0, -1) if word[at : at + k] in pieces and at + k <= len(word)]
                n += 1 if fits else len(word[at].encode())
                at += fits[0] if fits else 1
            assert machine.count(word) == n


def test_token_counts(odd_docs, no_docs):
    found = wordpiece.token_counts(odd_docs).collect()
    assert len(found) == 12
    counts = {r["doc_id"]: (r["n_words"], r["n_tokens"]) for r in found}
    assert counts[1] == counts[2] == counts[3] == (0, 0)
    assert counts[9][0] == 30_000 and counts[9][1] % 30_000 == 0
    assert wordpiece.token_counts(no_docs).count() == 0


def test_bpe_matches_the_rank_library_and_decodes(odd_docs, no_docs):
    ranks = bpe.read_ranks(public_tokenizers.path(bpe.RANKS))
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = noise(4000)
    codec = bpe.codec(bpe.RANKS)
    for text, ids in zip(texts, codec.encode(texts)):
        assert list(map(int, ids)) == own.encode_ordinary(text)
        assert codec.decode(ids) == text.encode()
    source = {r["doc_id"]: r["text"] or "" for r in odd_docs.collect()}
    found = bpe.round_trip(odd_docs).collect()
    assert len(found) == 12
    for r in found:
        ids, text = own.encode_ordinary(source[r["doc_id"]]), source[r["doc_id"]]
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert bpe.round_trip(no_docs).count() == 0
    back = bpe.decoded(bpe.encoded(odd_docs)).collect()
    assert all(bytes(r["data"]).decode() == source[r["doc_id"]] for r in back)


def test_assignment_fills_sequences_and_balances_cost():
    random.seed(1)
    lengths = np.array([random.choice([1, 5, 100, 700, 1500, 2047, 2048, 5000]) for _ in range(400)])
    pieces = packing.assign(lengths)
    held, load = defaultdict(list), defaultdict(float)
    for i, start, n, sequence, offset in pieces:
        held[sequence].append((offset, n))
        load[sequence] += packing.cost(n)
    for parts in held.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= packing.CAPACITY
    each = defaultdict(list)
    for i, start, n, *_ in pieces:
        each[i].append((start, n))
    for i, parts in each.items():
        assert [s for s, _ in sorted(parts)] == np.cumsum([0] + [n for _, n in sorted(parts)])[:-1].tolist()
        assert sum(n for _, n in parts) == lengths[i]
    assert len(held) == len([1 for n in lengths for _ in range(n // 2048)]) + -(-int((lengths % 2048).sum()) // 2048)
    assert packing.assign(np.array([], dtype=np.int64)) == []


def test_packed_pieces_hold_the_library_ids(odd_docs, no_docs):
    tokenizer = library(packing.TOKENIZER)
    source = {r["doc_id"]: r["text"] or "" for r in odd_docs.collect()}
    found = packing.packed(odd_docs, batch_tokens=5000).collect()
    for r in found:
        ids = [*tokenizer.encode(source[r["doc_id"]], add_special_tokens=False).ids, packing.END]
        assert r["doc_tokens"] == len(ids)
        assert r["ids_crc32"] == crc(ids[r["start"] : r["start"] + r["length"]])
    assert sum(r["length"] for r in found if r["doc_id"] == 6) == 2 * next(r["doc_tokens"] for r in found if r["doc_id"] == 6)
    assert packing.packed(no_docs).count() == 0


def test_planes_round_trip():
    for n in (0, 1, 7, 100, 40_000):
        ids = np.random.default_rng(n).integers(0, 50_258, n).astype("<u4")
        width, parts = planes.to_planes(ids, block=16_384)
        again = planes.from_planes(b"".join(parts), [len(p) for p in parts], width, n, 16_384)
        assert (again == ids).all()


def test_files_give_back_all_ids_in_order(spark, odd_docs, no_docs, tmp_path):
    tokenizer = library(planes.TOKENIZER)
    planes.write(odd_docs, str(tmp_path / "a"), shards=3, chunk_ids=2000, block=512)
    rows = sorted(planes.digests(spark, str(tmp_path / "a")).collect(), key=lambda r: r["start"])
    order = [r["doc_id"] for r in rows]
    assert order == [None, 1, 2, 3, 4, 4, 5, 6, 6, 8, 9, 10]
    source = {r["doc_id"]: r["text"] or "" for r in odd_docs.collect()}
    at = 0
    for r in rows:
        ids = [*tokenizer.encode(source[r["doc_id"]], add_special_tokens=False).ids, planes.END]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(ids), crc(ids))
        at += len(ids)
    whole = {r["doc_id"]: r["ids"] for r in planes.read(spark, str(tmp_path / "a")).collect()}
    assert whole[5] == [*tokenizer.encode("one two").ids, planes.END]
    planes.write(no_docs, str(tmp_path / "b"))
    assert planes.digests(spark, str(tmp_path / "b")).count() == 0


@pytest.mark.parametrize("make", [lambda: chunks.worded(packing.TOKENIZER), lambda: chunks.byte_level(planes.TOKENIZER)])
def test_special_tokens_in_upper_case_and_runs_of_white_space(make):
    encoder = make()
    texts = ["a <|ENDOFTEXT|> b", "É <|EndOfText|> b", "a <|endoftext|>", "A \n\n  b,\nC", " \n a", "a\t \tb  c", "", "\n", "é\ńx ́y"]
    assert encoder.encode(texts) == [encoder.whole(t) for t in texts]


def test_words_on_both_sides_of_a_line_end_are_pieces_of_their_own():
    words = ["alpha", "beta,", "gamma.", "Delta", "εta", "it's", "x" * 300, "12", "!"]
    texts = [f"one {a}\n{b} two" for a in words for b in words] + [f"{a}\n\n{b}\n" for a in words for b in words]
    plain, encoder = library(planes.TOKENIZER), chunks.ByteLevel(planes.TOKENIZER)
    for _ in range(2):
        assert encoder.encode(texts) == [np.array(plain.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes() for t in texts]
    assert not any("\n" in piece[1:] for piece in encoder.memo)
    assert len(encoder.memo) < 5 * len(words)


def test_line_ends_and_white_space_in_all_orders():
    texts = ["".join(t) for n in range(7) for t in itertools.product("a \n\t,", repeat=n)]
    plain, encoder = library(planes.TOKENIZER), chunks.ByteLevel(planes.TOKENIZER)
    for t, ids in zip(texts, encoder.encode(texts), strict=True):
        assert ids == np.array(plain.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes(), t
