"""Packing token streams into fixed windows by the sum-of-squares rule.

Each task packs its own rows. Full windows are cut off a document first; what is left (shorter
than a window) goes to the fill level that keeps the sum of squared counts of partly filled
windows smallest. The counts stand in one array with an entry per level. At the end of a task the
windows still open are filled from one another by cutting, and the last one is cut at powers of
two, which need no padding. No row is shuffled and a task holds only its open windows.

A task that has very many windows open closes them early in the same way, so that its memory is bounded;
every token still lies in exactly one piece. A text that holds an added token's literal (``<|endoftext|>``) has the ids that
the tokenizer gives it as a whole.

Null or empty texts are one token (the end mark). Repeated rows are packed as often as they stand.
Rows with a null id are packed too. An empty table gives no pieces. Other columns are not read.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from millrace.llm.textkit import WHITE, map_texts, runs, span_hashes, text_buffers, word_spans

WINDOW = 2048
END_ID = 1
#: Open windows of a task before they are closed early, so that its memory is bounded.
MOST_OPEN = 4096
#: Bytes of texts tokenized at once; their word and id arrays take many times as much.
RUN_BYTES = 256 << 10
_SEQUENCES_PER_TASK = 1 << 40
_SLOTS = 1 << 20

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)

# ASCII letters against other ASCII, but for the apostrophe: a border of pre-tokens in any case.
_KINDS = np.full(256, 3, np.uint8)
_KINDS[:128] = 2
_KINDS[WHITE] = 3
_KINDS[65:91] = _KINDS[97:123] = 1
_KINDS[ord("'")] = 3


class WordTokens:
    """Ids of texts by a lower-casing tokenizer whose tokens never cross white space.

    Each distinct word is tokenized once; texts are put together from the ids of their words.
    Known words stand in a table with one slot per hash value; a word that lost its slot is
    tokenized again. A word of Latin letters is one pre-token, so it goes to the model directly.
    """

    def __init__(self, tokenizer_file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        # A text that holds an added token's literal goes whole through the tokenizer; words are read as if there were none.
        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.literals = [t.content.lower().encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.model = self.tokenizer.model
        symbols = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        # The symbol that stands for each byte, read off the byte-level step itself.
        self.symbols = {b: chr(b) for b in range(128)}
        for c in range(0x80, 0x250):
            shown = symbols.pre_tokenize_str(chr(c))[0][0]
            self.symbols.update(zip(chr(c).encode(), shown))
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(_SLOTS, np.uint64)
        self.slot = np.zeros(_SLOTS, np.int64)
        self.first = np.zeros(1, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _word_ids(self, words: list[bytes]) -> list[list[int]]:
        found, rest, tokenize, symbols = [None] * len(words), [], self.model.tokenize, self.symbols
        for k, raw in enumerate(words):
            word = raw.decode("utf-8", "replace")
            if word.isalpha():
                if word.isascii():
                    found[k] = [t.id for t in tokenize(word.lower())]
                    continue
                if max(word) < "\u0250" and "\u0130" not in word:
                    word = word.lower().encode().decode("latin-1").translate(symbols)
                    found[k] = [t.id for t in tokenize(word)]
                    continue
            rest.append((k, word))
        self.tokenizer.encode_special_tokens = True
        try:
            made = self.tokenizer.encode_batch_fast([w for _, w in rest], add_special_tokens=False)
        finally:
            self.tokenizer.encode_special_tokens = False
        for (k, _), e in zip(rest, made):
            found[k] = e.ids
        return found

    def _learn(self, words: list[bytes]) -> np.ndarray:
        found = self._word_ids(words)
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum()))
        place = np.arange(len(self.first) - 1, len(self.first) - 1 + len(found))
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(sizes)])
        self.ids = np.concatenate([self.ids, flat])
        return place

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the rows and the n + 1 positions at which the rows begin."""
        ids, bounds = self._encode_words(data, offsets)
        body = data[offsets[0] : offsets[-1]].tobytes().lower()
        if not any(literal in body for literal in self.literals):
            return ids, bounds
        parts, low = [], int(offsets[0])
        for k, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
            own = ids[bounds[k] : bounds[k + 1]]
            if any(literal in body[a - low : b - low] for literal in self.literals):
                text = data[a:b].tobytes().decode("utf-8", "replace")
                own = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
            parts.append(own)
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(own) for own in parts])])

    def _encode_words(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts, ends, bounds = word_spans(data, offsets, kinds=_KINDS)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        if len(self.first) > _SLOTS:
            self._forget()
        hashes = span_hashes(data, starts, ends, lower=True)
        spot = (hashes & np.uint64(_SLOTS - 1)).astype(np.int64)
        place = self.slot[spot]
        new = np.flatnonzero(self.keys[spot] != hashes)
        if len(new):
            fresh, at, back = np.unique(hashes[new], return_index=True, return_inverse=True)
            at = new[at]
            made = self._learn([data[a:b].tobytes() for a, b in zip(starts[at].tolist(), ends[at].tolist())])
            place[new] = made[back]
            self.keys[spot[at]], self.slot[spot[at]] = fresh, made
        sizes = (self.first[1:] - self.first[:-1])[place]
        total = np.concatenate([[0], np.cumsum(sizes)])
        index = np.repeat(self.first[place] - total[:-1], sizes)
        index += np.arange(total[-1])
        return self.ids[index], total[bounds]


class SquaresPacker:
    """Open windows of one task. A window is a list of (doc_id, start, ids, doc_tokens)."""

    def __init__(self, window: int = WINDOW, most_open: int = MOST_OPEN):
        self.window = window
        self.most_open = most_open
        self.counts = np.zeros(window + 1, np.int64)
        self.levels: list[list[list]] = [[] for _ in range(window)]
        self.open = 0

    def level_for(self, size: int) -> int:
        """The fill level to put ``size`` tokens on; 0 opens a window. Ties go to the fullest level."""
        counts, top = self.counts, self.window - size
        best, cost = 0, 2 * int(counts[size]) + 1
        used = np.flatnonzero(counts[1 : top + 1]) + 1
        if len(used):
            change = 2 * (counts[used + size] - counts[used]) + 2
            if used[-1] == top:
                change[-1] = 1 - 2 * counts[top]
            k = len(used) - 1 - int(np.argmin(change[::-1]))
            if change[k] <= cost:
                best = int(used[k])
        return best

    def add(self, piece: tuple) -> Iterator[list]:
        """Place a piece shorter than the window; yields windows that are complete."""
        size = len(piece[2])
        level = self.level_for(size)
        if level:
            held = self.levels[level].pop()
            self.counts[level] -= 1
            self.open -= 1
        else:
            held = []
        held.append(piece)
        if level + size == self.window:
            yield held
            return
        self.levels[level + size].append(held)
        self.counts[level + size] += 1
        self.open += 1
        if self.open > self.most_open:
            yield from self.close()

    def close(self) -> Iterator[list]:
        """Fill the open windows from one another; the last is cut at powers of two."""
        left = [w for level in reversed(self.levels) for w in level]
        pieces = [p for w in left for p in w]
        self.counts[:] = 0
        self.levels = [[] for _ in range(self.window)]
        self.open = 0
        total = sum(len(p[2]) for p in pieces)
        sizes = [self.window] * (total // self.window)
        rest = total % self.window
        sizes += [1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1]
        pieces.reverse()
        for size in sizes:
            held, room = [], size
            while room:
                doc, start, ids, n = pieces.pop()
                if len(ids) > room:
                    pieces.append((doc, start + room, ids[room:], n))
                    ids = ids[:room]
                held.append((doc, start, ids, n))
                room -= len(ids)
            yield held


def _pack(tokenizer_file: str, window: int, end_id: int):
    def task(batches):
        tokens, packer = WordTokens(tokenizer_file), SquaresPacker(window)
        number = TaskContext.get().partitionId() * _SEQUENCES_PER_TASK
        out: list[tuple] = []

        def put(held: list) -> None:
            nonlocal number
            at = 0
            for doc, start, ids, n in held:
                out.append((doc, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), n, number, at))
                at += len(ids)
            number += 1

        def table() -> pa.RecordBatch:
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            columns = zip(*out) if out else [[] for _ in names]
            made = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)
            out.clear()
            return made

        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            data, offsets = text_buffers(batch.column(1))
            for a, b in runs(offsets, RUN_BYTES):
                ids, bounds = tokens.encode(data, offsets[a : b + 1])
                bounds = bounds.tolist()
                for k in range(b - a):
                    own = np.empty(bounds[k + 1] - bounds[k] + 1, np.uint32)
                    own[:-1] = ids[bounds[k] : bounds[k + 1]]
                    own[-1] = end_id
                    n, at = len(own), 0
                    while n - at >= window:
                        put([(doc_ids[a + k], at, own[at : at + window], n)])
                        at += window
                    if at < n:
                        for held in packer.add((doc_ids[a + k], at, own[at:].copy(), n)):
                            put(held)
                yield table()
        for held in packer.close():
            put(held)
        if out:
            yield table()

    return task


def pack(docs: DataFrame, tokenizer_file: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """One row per piece of a document; each token of a document lies in exactly one piece.

    ``docs`` needs ``doc_id, text``. ``sequence_id`` names the window, ``offset`` the place in it.
    Windows hold ``window`` tokens, but for a few at the end of each task, which hold a power of
    two. The placement follows the order of the rows in a task, so it is the same when a lost
    task runs again.
    """
    return map_texts(docs.select("doc_id", "text"), _pack(tokenizer_file, window, end_id), PIECES)
