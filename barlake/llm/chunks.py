"""Whole-text encoding by way of a memo of chunks.

Both families of tokenizers used here end a token before a single space that follows other
text, so a text can be cut before its spaces and the pieces encoded on their own.  Pieces
repeat, so each worker keeps the ids of those it has met; only new ones reach the tokenizer,
many at a time.  Texts are cut before line ends too, where these are tokens of their own, so that the last word
of a line and the first of the next are not a piece that never comes again.  A new piece is cut further where the
tokenizer ends a token anyway, before a mark at its end, and where upper case makes no difference it is looked up in
lower case.  The memo is emptied when it holds ``held`` pieces, so memory is bounded; that changes speed only, never ids.

A text that holds the string of a special token is encoded whole, as the library does it."""

from __future__ import annotations

import functools
import itertools
import os
import re

import numpy as np

from barlake.llm.common import grouped

MEMO = 700_000
#: Pieces longer than this are encoded every time, so that the memo stays small.
LONG = 256
#: Characters of texts that are looked up together.
TEXT_CHARS = 1 << 16
#: Characters of new pieces in one text for the library, which is slower on long ones, and texts in one call.
CALL_CHARS, CALL_TEXTS = 1024, 64
#: A space within a longer run of white space: the run is one unit of the tokenizers.
_RUN = re.compile(r"\s \s")
_HALF_RUN = re.compile(r" \s")

#: A line end within a longer run of white space, or the last of a run that ends the text.
_LINE_RUN = re.compile(r"\n(?<=\s\n)(?!\S)")

#: Punctuation that is a unit of its own at the end of a piece, after a letter.
_ENDS = ",.;:!?"


def uncut(text: str) -> bool:
    """Whether a space has white space next to it on both sides; such a text is encoded in one go."""
    return "  " in text or bool(_HALF_RUN.search(text) and _RUN.search(text))


def cut(text: str) -> list[str] | None:
    """What lies between the text's spaces; a piece is a part and, but for the first, the space
    before it.  None for a text that is encoded in one go."""
    return None if uncut(text) else text.split(" ")


class Memo(dict):
    """Ids of parts.  A part that is not there gets a place among the ``fresh``, so that a text is looked up once;
    the places are filled when all that is new in a group of texts is encoded."""

    def __init__(self) -> None:
        self.fresh: dict[str, bytearray] = {}

    def __missing__(self, part: str) -> bytearray:
        ids = self[part] = self.fresh[part] = bytearray()
        return ids


class Chunked:
    """Ids of whole texts as little-endian unsigned 32-bit integers."""

    #: Whether upper case makes no difference.
    folds = False
    #: Pieces in the memo at most.
    held = MEMO

    def __init__(self, name: str) -> None:
        self.tokenizer = _load(name)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        #: Ids of a space and the part that is the key; a part that starts with a line end or a space has no other in front.
        self.memo = Memo()
        #: Ids of parts with no space in front.
        self.bare: dict[str, bytes] = {}
        self.ends = {mark: self.whole(mark) for mark in _ENDS}
        self.line = self.whole("\n")

    def whole(self, text: str) -> bytes:
        """Ids of one text in one go."""
        return _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def parts(self, text: str) -> list[str] | None:
        """What is in front of the text's first space and the parts behind, or None if it goes in one go."""
        raise NotImplementedError

    def new(self, spaced: list[str], bare: list[str]) -> None:
        """Encodes pieces into ``memo`` and ``bare``."""
        raise NotImplementedError

    def _ids(self, texts: list[str]) -> list[list[int]]:
        out = []
        for at in range(0, len(texts), CALL_TEXTS):
            out += [e.ids for e in self.tokenizer.encode_batch_fast(texts[at : at + CALL_TEXTS], add_special_tokens=False)]
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        if self.memo.fresh or len(self.memo) + len(self.bare) > self.held:  # places that an error left empty go too
            self.memo.fresh.clear()
            self.memo.clear()
            self.bare.clear()
        if not self.memo:
            self.memo[""] = self.whole(" ")
            self.bare[""] = b""
        memo, bare = self.memo, self.bare
        known, rows = memo.__getitem__, []
        for text in texts:
            parts = self.parts(text)
            if parts is None:
                rows.append([self.whole(text)])
                continue
            first = parts.pop(0)
            row = [bare.get(first) or self.whole(first)]
            if len(first) <= LONG:
                bare[first] = row[0]
            row += map(known, parts)
            rows.append(row)
        self._learn(memo.fresh)
        for part, place in memo.fresh.items():
            place += memo[part]
            if len(part) > LONG:
                del memo[part]
        memo.fresh.clear()
        return list(map(b"".join, rows))

    def _learn(self, fresh: dict[str, bytearray]) -> None:
        """Ids of new parts into the memo: those of their stems, encoded if they are new, and of what follows these."""
        memo, bare, ends, folds = self.memo, self.bare, self.ends, self.folds
        spaced: set[str] = set()
        composed, lines = [], []
        for part in fresh:
            if part[0] in "\n ":
                if part[0] == "\n" and len(part) > 1 and not (part[1].isspace() or part[-1].isspace()):
                    lines.append((part, *_stem(part[1:])))
                else:
                    memo[part] = self.whole(part)
                continue
            stem, mark = _stem(part) if part[-1] in ends else (part, "")
            if folds and stem.isascii():
                stem = stem.lower()
            if stem in fresh or stem not in memo:
                spaced.add(stem)
            if stem is not part:
                composed.append((part, stem, mark))
        others = {stem for _, stem, _ in lines}.difference(bare)
        self.new(list(spaced), list(others))
        for part, stem, mark in composed:
            memo[part] = memo[stem] + ends[mark] if mark else memo[stem]
        for part, stem, mark in lines:
            memo[part] = self.line + bare[stem] + (ends[mark] if mark else b"")
        for p in (spaced | others) - fresh.keys():
            if len(p) > LONG:
                memo.pop(p, None)
                bare.pop(p, None)


def _stem(piece: str) -> tuple[str, str]:
    """A piece without the mark at its end that is a unit of its own, and that mark."""
    if len(piece) > 1 and piece[-1] in _ENDS and piece[-2].lower().isalpha():
        return piece[:-1], piece[-1]
    return piece, ""


def _load(name: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(name if os.path.sep in name else public_tokenizers.path(name))


def _packed(ids: list[int]) -> bytes:
    return np.array(ids, dtype="<u4").tobytes()


class ByteLevel(Chunked):
    """A byte-level BPE file of the tokenizers library: every id stands for certain bytes, so
    the ids of many pieces encoded in one text are told apart by adding up byte lengths."""

    #: Upper case is kept, so there are more.
    held = 3 * MEMO

    def __init__(self, name: str) -> None:
        super().__init__(name)
        names = self.tokenizer.get_vocab(with_added_tokens=True)
        self.length = np.zeros(max(names.values()) + 1, dtype=np.int64)
        for piece, i in names.items():
            self.length[i] = len(piece)  # one character of a piece stands for one byte

    def parts(self, text: str) -> list[str] | None:
        if any(s in text for s in self.special) or uncut(text):
            return None
        if "\n" not in text:
            return text.split(" ")
        # a line end that is not within or at the end of such a run starts a token
        if _LINE_RUN.search(text):
            first, *rest = text.split(" ")
            return [first, *[f" {part}" if part[:1] == "\n" else part for part in rest]]
        return text.replace("\n", " \n").split(" ")

    def new(self, spaced: list[str], bare: list[str]) -> None:
        # a line end keeps a piece without a space apart from the one before
        for known, pieces, lead, skip in ((self.memo, spaced, " ", 0), (self.bare, bare, "\n", len(self.line))):
            ids = self._ids([lead + lead.join(group) for group in grouped(pieces, len, CALL_CHARS)])
            # no id spans two pieces
            row = np.fromiter(itertools.chain.from_iterable(ids), dtype="<u4")
            starts = np.cumsum(self.length[row]) - self.length[row]
            ends = np.searchsorted(starts, np.cumsum([len(p.encode()) + 1 for p in pieces])) * 4
            data, at = row.tobytes(), 0
            for piece, end in zip(pieces, ends.tolist()):
                known[piece] = data[at + skip : end]
                at = end


class Worded(Chunked):
    """A BPE file with word ends, which drops white space and upper case; ids of many words encoded in one
    text are told apart by their ends, those of other pieces by a control character between them, a token
    of its own between spaces."""

    APART = "\x01"
    folds = True

    def __init__(self, name: str) -> None:
        super().__init__(name)
        (self.apart,) = self.tokenizer.encode(self.APART, add_special_tokens=False).ids
        names = self.tokenizer.get_vocab(with_added_tokens=True)
        self.closes = np.zeros(max(names.values()) + 1, dtype=bool)
        self.closes[[i for piece, i in names.items() if piece.endswith("</w>")]] = True

    def parts(self, text: str) -> list[str] | None:
        # a special token may come about by lower case, which the library does not look for
        low = text.lower()
        if any(s in text or s in low for s in self.special):
            return None
        if text.isascii():
            text = low
        # line ends and runs of spaces are dropped like one space
        if "\n" in text:
            text = text.replace("\n", " ")
        while "  " in text:
            text = text.replace("  ", " ")
        return cut(text)

    def new(self, spaced: list[str], bare: list[str]) -> None:
        # white space in front makes no difference
        todo = {*spaced, *bare}
        self._words([p for p in todo if p.isalpha()])
        self._mixed([p for p in todo if not p.isalpha()])
        self.bare.update((p, self.memo[p]) for p in bare)

    def _words(self, pieces: list[str]) -> None:
        """Pieces of letters only: each is one word, and a word's last id says so."""
        groups = list(grouped(pieces, len, 2 * CALL_CHARS))
        for group, ids in zip(groups, self._ids([" ".join(g) for g in groups])):
            row = np.array(ids, dtype="<u4")
            data, at, ends = row.tobytes(), 0, (np.flatnonzero(self.closes[row]) + 1) * 4
            if len(ends) != len(group):  # lower case of some letter is more than letters
                self._mixed(group)
                continue
            for piece, end in zip(group, ends.tolist()):
                self.memo[piece] = data[at:end]
                at = end

    def _mixed(self, pieces: list[str]) -> None:
        groups = list(grouped([p for p in pieces if self.APART not in p], len, CALL_CHARS // 2))
        for group, ids in zip(groups, self._ids([f" {self.APART} ".join(g) for g in groups])):
            row = np.array(ids, dtype="<u4")
            data, at = row.tobytes(), 0
            for piece, end in zip(group, [*(np.flatnonzero(row == self.apart) * 4).tolist(), len(data)]):
                self.memo[piece] = data[at:end]
                at = end + 4
        self.memo.update((p, self.whole(p)) for p in pieces if self.APART in p)


@functools.cache
def byte_level(name: str) -> ByteLevel:
    """One per worker and file."""
    return ByteLevel(name)


@functools.cache
def worded(name: str) -> Worded:
    return Worded(name)


def encoded_rows(rows, encoder: Chunked, text_at: int):
    """Rows with their text replaced by the ids' bytes, in order."""
    for group in grouped(rows, lambda r: len(r[text_at]), TEXT_CHARS):
        for row, ids in zip(group, encoder.encode([r[text_at] for r in group])):
            yield (*row[:text_at], ids, *row[text_at + 1 :])
