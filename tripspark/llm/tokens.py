"""Batch tokenising with a memo of white-space separated pieces.

The tokenizers library takes several microseconds for each word it meets;
text repeats its words. A text is therefore cut where the tokenizer itself
always cuts (before a single space between two visible characters, and between
a run of letters and following ASCII punctuation), each new piece goes to the
library once per worker process, and whole batches are put together by numpy.
The ids are those of one library call on the whole text; texts with other
white space go to the library whole or by a pattern that keeps its cuts.
"""

from __future__ import annotations

import os
import re
import unicodedata
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tripspark.llm import runtime, words

MEMO_LIMIT = 1_200_000  # pieces kept by one worker process, and their characters
MEMO_CHARS = 64 << 20
FRESH = 1024  # new pieces handled at a time

_ASCII_SPACE = " \t\n\x0b\x0c\r"
_PUNCT = ",.;:!?%&*$#|()[]\"-"
_RUNS = re.compile(r"[\t-\r ]+(?=[\t-\r ][^\t-\r ])|[\t-\r ]?[^\t-\r ]+|[\t-\r ]+")


def _visible_bytes() -> dict[int, str]:
    """The byte-level scheme's character for each byte: printable Latin-1
    bytes stand for themselves, the others for code points from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {**{b: chr(b) for b in plain}, **{b: chr(256 + i) for i, b in enumerate(rest)}}


class _Codes(dict):
    """Piece -> code; a new piece gets the next code and joins ``fresh``."""

    def __init__(self, kind: str, fresh: list[tuple[str, str]], counter: list[int]):
        self.kind, self.fresh, self.counter = kind, fresh, counter

    def __missing__(self, piece: str) -> int:
        code = self[piece] = self.counter[0]
        self.counter[0] += 1
        self.fresh.append((self.kind, piece))
        return code


class PieceTokenizer:
    """ids of whole texts, as one call of ``tokenizer.encode`` gives them.

    ``spaced``: a piece after a space carries that space (byte-level
    vocabularies); otherwise white space is dropped and letters are
    normalised (NFC, lower case) by the tokenizer.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.spaced = self.tokenizer.normalizer is None
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.bytes_to_chars = _visible_bytes()
        self.n_vocab = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.dtype = np.uint16 if self.n_vocab <= 1 << 16 else np.uint32
        self.reset()

    def reset(self) -> None:
        self.fresh: list[tuple[str, str]] = []
        self.counter = [0]
        self.kept = 0
        self.inner = _Codes("spaced" if self.spaced else "plain", self.fresh, self.counter)
        self.first = _Codes("plain", self.fresh, self.counter) if self.spaced else self.inner
        self.whole = _Codes("whole", self.fresh, self.counter)
        self.done = 0  # pieces with ids
        self.tails: dict[str, list[int]] = {}
        self.flat = np.empty(1 << 16, self.dtype)
        self.start = np.zeros(1 << 12, np.int64)
        self.n_flat = 0

    # one piece -----------------------------------------------------------

    def _whole(self, piece: str) -> list[int]:
        return self.tokenizer.encode(piece, add_special_tokens=False).ids

    def _letters(self, runs: list[str]) -> list[list[int]]:
        """Normalised runs of letters: each is one pre-token of either tokenizer."""
        if not runs:
            return []
        text = "\n".join(runs).encode().decode("latin-1").translate(self.bytes_to_chars)  # no run has a line feed
        return [[t.id for t in self.model.tokenize(run)] for run in text.split(self.bytes_to_chars[0x0A])]

    def _known(self, word: str, spaced: bool) -> list[int] | None:
        """Ids of a piece that an earlier batch met."""
        code = (self.inner if spaced or not self.spaced else self.first).get(word, self.done)
        return self.flat[self.start[code]:self.start[code + 1]].tolist() if code < self.done else None

    def _tail(self, tail: str) -> list[int]:
        ids = self.tails.get(tail)
        if ids is None:
            ids = self.tails[tail] = self._whole(tail)
        return ids

    def _pieces(self, fresh: list[tuple[str, str]]) -> list[list[int]]:
        """Ids of each new piece; a run of letters that several pieces begin
        with is looked up once."""
        rows: list[list[int]] = [[]] * len(fresh)
        runs: dict[str, int] = {}
        open_: list[tuple[int, int, str]] = []
        for i, (kind, piece) in enumerate(fresh):
            spaced = kind == "spaced"
            head = word = piece.rstrip(_PUNCT)
            if not self.spaced:
                word = word.lower() if word.isascii() else "".join(c.lower() for c in unicodedata.normalize("NFC", word))
            if kind == "whole" or not word.isalpha() or not head.isalpha():
                rows[i] = self._whole(" " + piece if spaced else piece)
                continue
            tail = piece[len(head):]
            ids = self._known(head, spaced) if tail else None
            if ids is None:
                open_.append((i, runs.setdefault(" " + word if spaced else word, len(runs)), tail))
            else:
                rows[i] = ids + self._tail(tail)
        made = self._letters(list(runs))
        for i, at, tail in open_:
            rows[i] = made[at] + self._tail(tail) if tail else made[at]
        return rows

    def _add_fresh(self) -> None:
        """Append the ids of new pieces, in the order of their codes. Only some
        are held as lists at a time: Python's garbage collector walks these."""
        self.kept += sum(len(p) for _, p in self.fresh)
        for i in range(0, len(self.fresh), FRESH):
            rows = self._pieces(self.fresh[i:i + FRESH])
            n = self.done + len(rows)
            lens = np.fromiter(map(len, rows), np.int64, len(rows))
            need = self.n_flat + int(lens.sum())
            if need > len(self.flat):
                self.flat = np.concatenate([self.flat, np.empty(max(need, len(self.flat)), self.dtype)])
            if n + 1 > len(self.start):
                self.start = np.concatenate([self.start, np.zeros(max(n + 1, len(self.start)), np.int64)])
            self.flat[self.n_flat:need] = np.fromiter(chain.from_iterable(rows), self.dtype, int(lens.sum()))
            self.start[self.done + 1:n + 1] = self.n_flat + np.cumsum(lens)
            self.n_flat, self.done = need, n
        self.fresh.clear()

    # a batch -------------------------------------------------------------

    def _odd(self, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """Rows with white space other than single ones between visible
        characters: 1, and with white space beyond ASCII: 2."""
        n = len(offs) - 1
        odd = np.zeros(n, np.int8)
        if not len(data):
            return odd
        row_of = lambda at: np.searchsorted(offs, at, "right") - 1
        at = np.flatnonzero(words.SPACE[data])
        if len(at):
            row = row_of(at)
            edge = (at == offs[row]) | (at == offs[row + 1] - 1)
            twin = np.zeros(len(at), bool)
            twin[1:] = (at[1:] == at[:-1] + 1) & (row[1:] == row[:-1])
            odd[row[edge | twin]] = 1
        high = np.flatnonzero(data >= 0xC2)  # U+0085, 00A0, 1680, 2000-200A, 2028, 2029, 202F, 205F, 3000
        if len(high):
            b = np.zeros(len(data) + 2, np.uint8)
            b[:len(data)] = data
            b0, b1, b2 = b[high], b[high + 1], b[high + 2]
            wide = (b0 == 0xC2) & ((b1 == 0x85) | (b1 == 0xA0)) | (b0 == 0xE1) & (b1 == 0x9A) & (b2 == 0x80)
            wide |= (b0 == 0xE2) & (b1 == 0x80) & ((b2 <= 0x8A) | (b2 == 0xA8) | (b2 == 0xA9) | (b2 == 0xAF))
            wide |= (b0 == 0xE2) & (b1 == 0x81) & (b2 == 0x9F) | (b0 == 0xE3) & (b1 == 0x80) & (b2 == 0x80)
            odd[row_of(high[wide])] = 2
        return odd

    def _split(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the texts' pieces between single spaces, end to end, and
        their number in each text. A piece of a batch is looked up once."""
        lists = pc.split_pattern(column, " ")
        count = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        pieces = lists.flatten().dictionary_encode()
        names = pieces.dictionary.to_numpy(zero_copy_only=False).tolist()
        at = pieces.indices.to_numpy(zero_copy_only=False)
        codes = np.fromiter(map(self.inner.__getitem__, names), np.int64, len(names))[at]
        if self.spaced:
            begin = np.cumsum(count) - count
            codes[begin] = [self.first[names[i]] for i in at[begin].tolist()]
        return codes, count

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a column, end to end, and the rows' offsets
        into them. Null counts as empty."""
        if self.counter[0] + len(self.tails) > MEMO_LIMIT or self.kept > MEMO_CHARS:
            self.reset()
        odd = self._odd(*words.text_bytes(column)) if self.spaced else np.zeros(len(column), np.int8)
        some = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False) > 0
        inner, whole = self.inner.__getitem__, self.whole.__getitem__
        count = np.zeros(len(column), np.int64)
        plain = some & (odd == 0)
        split, count[plain] = self._split(column.filter(pa.array(plain)))
        others: list[int] = []
        for i in np.flatnonzero(some & ~plain).tolist():
            text, before = column[i].as_py(), len(others)
            if odd[i] == 1 and not any(t in text for t in self.added):
                for piece in _RUNS.findall(text):
                    others.append(inner(piece[1:]) if piece[0] == " " and len(piece) > 1 and piece[1] not in _ASCII_SPACE else whole(piece))
            else:
                others.append(whole(text))
            count[i] = len(others) - before
        if self.fresh:
            self._add_fresh()
        ends = np.concatenate([[0], np.cumsum(count)])
        at = np.empty(ends[-1], np.int64)
        of_plain = np.repeat(plain, count)
        at[of_plain], at[~of_plain] = split, others
        begin = self.start[at]
        count = self.start[at + 1] - begin
        total = np.concatenate([[0], np.cumsum(count)])
        ids = self.flat[np.repeat(begin - total[:-1], count) + np.arange(total[-1])]
        return ids, total[ends]


def tokenizer_for(path: str) -> PieceTokenizer:
    """This process's tokenizer of ``path``, kept between tasks."""
    cache = runtime.process_cache("tokenizers")
    if path not in cache:
        cache[path] = PieceTokenizer(path)
    return cache[path]


def with_end(ids: np.ndarray, offs: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Append ``end`` to each row."""
    n = len(offs) - 1
    out = np.full(len(ids) + n, end, ids.dtype)
    new = offs + np.arange(n + 1)
    body = np.ones(len(out), bool)
    body[new[1:] - 1] = False
    out[body] = ids
    return out, new
