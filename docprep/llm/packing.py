"""Harmonic packing of tokenised documents into sequences.

A document's full sequences are cut off first. What remains, r tokens, belongs
to class k = capacity // r, whose bins take k documents each, whatever their
order, so every worker fills its own bins without asking another. The room
that is left in a bin is filled with documents cut to measure: the emptiest
bins are taken apart until their tokens are enough for the room in the rest. A
worker's last tokens are cut at powers of two, which need no padding.

Each worker packs its rows in windows of ``WINDOW`` tokens, so memory is
bounded. Edge cases: a null or empty text is its end token alone; documents of
any length, ties and repeated rows are packed like others; an empty table has
no pieces; other columns are ignored.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .bpe import byte_names
from .common import id_text, slices, trimmed

CAPACITY, END_ID, CLASSES, WINDOW = 4096, 2, 64, 4 << 20
#: Words that a worker remembers at most, as they stand (for a task) and plain ones (for its lifetime), and their length.
KNOWN, PLAIN, LONGEST = 250_000, 400_000, 40


class WordIds(dict):
    """Word -> its ids, as bytes, by the tokenizers library; the ids of a word are asked for once.

    The normaliser and the pre-tokeniser never join what stands on two sides of
    a space or a line feed, so such words can be encoded by themselves. They
    ignore case and part letters from a full stop or comma after them, so a
    word of Latin letters is looked up in lower case and without that sign; as
    it stands it is one pre-token, and the library's model gives its ids.
    """

    def __init__(self, path: str) -> None:
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.names = dict(enumerate(byte_names()))
        self.plain: dict[str, bytes] = {}
        self.signs = {s: self._ask(s) for s in (".", ",")}

    def _ask(self, word: str) -> bytes:
        return array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()

    def _letters(self, word: str) -> bytes:
        """Ids of a word of lower-case Latin letters."""
        ids = self.plain.get(word)
        if ids is None:
            named = word if word.isascii() else word.encode().decode("latin-1").translate(self.names)
            ids = array("I", [t.id for t in self.model.tokenize(named)]).tobytes()
            if len(word) <= LONGEST:
                self.plain[word] = ids
        return ids

    def __missing__(self, word: str) -> bytes:
        sign = self.signs.get(word[-1:], b"")
        core = word[:-1] if sign else word
        if core.isalpha() and (core.isascii() or max(core) < "\u0130"):
            ids = self._letters(core.lower()) + sign
        else:
            ids = self._ask(word)
        if len(word) <= LONGEST:
            self[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        for kept, most in ((self, KNOWN), (self.plain, PLAIN)):
            if len(kept) > most:
                kept.clear()
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def pack(sizes: list[int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) for documents of these token counts, all at least 1."""
    pieces: list[tuple[int, int, int, int, int]] = []
    seq = 0
    classes: dict[int, list[int]] = {}
    rest: dict[int, tuple[int, int]] = {}
    for d, n in enumerate(sizes):
        full = n // capacity
        for k in range(full):
            pieces.append((d, k * capacity, capacity, seq, 0))
            seq += 1
        if r := n - full * capacity:
            rest[d] = (full * capacity, r)
            classes.setdefault(min(capacity // r, CLASSES), []).append(d)
    bins, loose = [], []
    for k in sorted(classes):
        docs = classes[k]
        whole = len(docs) - len(docs) % k
        bins += [docs[i : i + k] for i in range(0, whole, k)]
        loose += docs[whole:]
    fill = np.array([sum(rest[d][1] for d in b) for b in bins], np.int64)
    order = np.argsort(fill, kind="stable")
    have = sum(rest[d][1] for d in loose)
    taken = np.concatenate([[0], np.cumsum(fill[order])])
    room = np.concatenate([[0], np.cumsum(capacity - fill[order])])
    apart = int(np.argmax(have + taken >= room[-1] - room))  # the last entry always holds
    if have + taken[apart] < room[-1] - room[apart]:
        apart = len(bins)
    loose += [d for i in order[:apart] for d in bins[i]]
    gaps = []
    for i in order[apart:]:
        at = 0
        for d in bins[i]:
            start, r = rest[d]
            pieces.append((d, start, r, seq, at))
            at += r
        if at < capacity:
            gaps.append((seq, at))
        seq += 1
    left = sum(rest[d][1] for d in loose) - sum(capacity - at for _, at in gaps)
    sizes_left = [capacity] * (max(left, 0) // capacity)
    tail = max(left, 0) % capacity
    sizes_left += [1 << b for b in range(tail.bit_length() - 1, -1, -1) if tail >> b & 1]
    slots = [(s, at, capacity) for s, at in gaps] + [(seq + i, 0, n) for i, n in enumerate(sizes_left)]
    todo = iter(slots)
    s, at, end = next(todo, (0, 0, 0))
    for d in loose:
        start, r = rest[d]
        while r:
            if at == end:
                s, at, end = next(todo)
            n = min(r, end - at)
            pieces.append((d, start, n, s, at))
            start, r, at = start + n, r - n, at + n
    return pieces


def packed(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = True) -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and, if asked for, ids."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = word_ids(path)
        base, used, window, held = TaskContext.get().partitionId() << 40, 0, [], 0

        def flush() -> pa.RecordBatch:
            nonlocal used
            sizes = [len(ids) // 4 for _, ids in window]
            rows = pack(sizes, capacity)
            parts = [memoryview(window[d][1])[4 * a : 4 * (a + n)] for d, a, n, _, _ in rows]
            cols = [pa.array([window[r[0]][0] for r in rows], pa.int64()), *(pa.array([r[i] for r in rows], pa.int64()) for i in (1, 2)), pa.array([zlib.crc32(p) for p in parts], pa.int64()), pa.array([sizes[r[0]] for r in rows], pa.int64()), pa.array([base + used + r[3] for r in rows], pa.int64()), pa.array([r[4] for r in rows], pa.int64())]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            if with_ids:
                cols.append(pa.array([np.frombuffer(p, "<u4").astype(np.int32) for p in parts], pa.list_(pa.int32())))
                names.append("ids")
            used += 1 + max((r[3] for r in rows), default=-1)
            return pa.RecordBatch.from_arrays(cols, names=names)

        for batch in batches:
            for part in slices(batch):
                for i, text in zip(part.column("_id").to_pylist(), part.column("_text").to_pylist(), strict=True):
                    ids = coder.encode(text)
                    window.append((i, ids + end))
                    held += len(ids) // 4 + 1
                    if held >= WINDOW:
                        yield flush()
                        window, held = [], 0
        if window:
            yield flush()
        coder.clear()

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + ", ids array<int>" * with_ids
    return id_text(docs, id_col, text_col).mapInArrow(trimmed(run), schema)
