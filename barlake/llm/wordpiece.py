"""Token counts by a linear longest-match automaton.

A word is cut greedily: at each place the longest piece of the vocabulary is taken.  The
automaton walks a trie of the pieces; where a character cannot follow, a failure link leads to
the trie node of what is left once the greedy pieces of the node's string have been popped,
and the number of popped tokens was worked out beforehand.  Each character is read once and no
piece is ever built.

The vocabulary is that of a sentencepiece file: a word is the mark U+2581 and its characters,
so pieces with the mark begin words and the others continue them.  A character that no piece
begins with, or that greedy cutting leaves alone without being a piece, falls back to its
UTF-8 bytes, one token each.  Words are runs of anything but ASCII white space.

Null and empty texts have no tokens; repeated rows give repeated results, an empty table an
empty result; only ``doc_id`` and ``text`` are read."""

from __future__ import annotations

import functools
import os
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.llm.common import arrow_rows, grouped, on_workers, text_or_empty

VOCABULARY = "piece_bpe_32k.model"
MARK = "▁"
#: Counts of words that a worker keeps; it starts afresh when there are more.
MEMO = 300_000
LONG = 64


class Automaton:
    def __init__(self, pieces: Iterable[str]) -> None:
        self.child: list[dict[str, int]] = [{}]
        token = [False]
        order: list[tuple[int, int, str]] = []  # node, parent, character
        for piece in pieces:
            node = 0
            for c in piece:
                after = self.child[node].get(c)
                if after is None:
                    after = len(self.child)
                    self.child[node][c] = after
                    self.child.append({})
                    token.append(False)
                node = after
            token[node] = bool(piece)
        level = [(0, 0, "")]
        while level:
            level = [(kid, node, c) for node, _, _ in level for c, kid in self.child[node].items()]
            order += level
        # link: where the walk goes on after the greedy pieces of the node's string are popped;
        # popped: how many tokens those are.  Shorter strings come first.
        self.link = [0] * len(self.child)
        self.popped = [0] * len(self.child)
        for node, parent, c in order:
            if token[node]:
                self.popped[node] = 1  # the whole string is one token, nothing is left
            elif parent == 0:
                self.popped[node] = len(c.encode())  # a lone character that is no piece
            else:
                state, count = self.link[parent], self.popped[parent]
                while c not in self.child[state]:
                    if state == 0:
                        count += len(c.encode())
                        break
                    count += self.popped[state]
                    state = self.link[state]
                self.link[node] = self.child[state].get(c, 0)
                self.popped[node] = count

    def count(self, word: str) -> int:
        """Tokens of the word, marked or not."""
        child, link, popped = self.child, self.link, self.popped
        state = total = 0
        for c in word:
            while c not in child[state]:
                if state == 0:
                    total += len(c.encode())
                    break
                total += popped[state]
                state = link[state]
            state = child[state].get(c, 0)
        while state:
            total += popped[state]
            state = link[state]
        return total


def pieces_of(path: str) -> list[str]:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    every = range(model.vocab_size())
    return [model.id_to_piece(i) for i in every if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]


@functools.cache
def automaton(name: str) -> Automaton:
    """One per worker and vocabulary."""
    import public_tokenizers

    return Automaton(pieces_of(name if os.path.sep in name else public_tokenizers.path(name)))


class Counter:
    def __init__(self, machine: Automaton) -> None:
        self.machine = machine
        self.memo: dict[bytes, int] = {}

    def text(self, text: str) -> tuple[int, int]:
        """Words and tokens of a whole text."""
        words = text.encode().split()
        memo = self.memo
        if len(memo) > MEMO:
            memo.clear()
        long = 0
        for w in set(words).difference(memo):
            n = self.machine.count(MARK + w.decode())
            if len(w) <= LONG:
                memo[w] = n
            else:
                long += n * words.count(w)
                memo[w] = 0
        total = sum(map(memo.__getitem__, words)) + long
        if long:
            for w in set(words):
                if len(w) > LONG:
                    del memo[w]
        return len(words), total


@functools.cache
def counter(name: str) -> Counter:
    return Counter(automaton(name))


def token_counts(docs: DataFrame, vocabulary: str = VOCABULARY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_tokens) of every whole text; one pass, no shuffle."""

    def run(batches):
        import pyarrow as pa

        own = counter(vocabulary)
        for group in grouped(arrow_rows(batches, "k", "t"), lambda r: len(r[1])):
            found = [own.text(t) for _, t in group]
            cells = [[k for k, _ in group], [w for w, _ in found], [n for _, n in found]]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cells], ["k", "n_words", "n_tokens"])

    on_workers(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("k"), text_or_empty(text_col).alias("t"))
    return rows.mapInArrow(run, "k long, n_words long, n_tokens long").withColumnRenamed("k", id_col)
