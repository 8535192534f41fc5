"""Byte-level BPE: encoding by a queue of merge ranks, decoding by vocabulary strings.

A pre-token's symbols form a doubly linked list. A heap holds (rank, position)
of each adjacent pair that a merge rule joins; the least is taken, skipped if
one of its symbols has changed since (a stale entry), and else joined, which
adds at most two new pairs. A pre-token of n bytes takes O(n log n), also if it
is a text of a megabyte without a space.

The vocabulary file is a parameter and is read on each worker; it is never
copied. Edge cases: a null or empty text has no ids and decodes to an empty
text; strings of the file's added tokens become those tokens, as the
tokenizers library does by default; repeated rows give a row each, very long texts are
encoded whole, an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import id_text, slices, trimmed

#: Fixed value: the pre-token pattern of this family of vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Two white-space characters in a row.
WIDE = re.compile(r"\s\s").search
#: Pieces that a worker remembers at most, and their length.
REMEMBERED, LONGEST = 450_000, 48


def byte_names() -> list[str]:
    """The printable character that stands for each byte: itself where printable, else the next one from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Pieces(dict):
    """Piece of text -> its ids as little-endian bytes; filled on demand and emptied when full."""

    def __init__(self, coder: BytePairCoder) -> None:
        super().__init__()
        self.coder = coder
        self.tokens: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        out, tokens, coder = [], self.tokens, self.coder
        for t in coder.split(piece):
            ids = tokens.get(t)
            if ids is None:
                ids = np.array(coder.merge(t.encode()), "<u4").tobytes()
                if len(t) <= LONGEST:
                    if len(tokens) >= REMEMBERED:
                        tokens.clear()
                    tokens[t] = ids
            out.append(ids)
        made = b"".join(out)
        if len(piece) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.clear()
            self[piece] = made
        return made


class BytePairCoder:
    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        names = byte_names()
        back = {c: b for b, c in enumerate(names)}
        self.first = [vocab[c] for c in names]
        self.joins: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.joins.setdefault((vocab[a], vocab[b]), (rank, vocab[a + b]))
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = {i: bytes(back[c] for c in s) for s, i in vocab.items()} | {i: s.encode() for s, i in self.added.items()}
        self.added_pattern = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) or r"(?!)")
        self.split = regex.compile(PATTERN).findall
        self.pieces = Pieces(self)

    def merge(self, token: bytes) -> list[int]:
        """The ids of one pre-token."""
        ids = [self.first[b] for b in token]
        n = len(ids)
        if n < 2:
            return ids
        joins = self.joins
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(j[0], i, j[1]) for i in range(n - 1) if (j := joins.get((ids[i], ids[i + 1])))]
        heapq.heapify(heap)
        while heap:
            rank, i, new = heapq.heappop(heap)
            k = nxt[i]
            if ids[i] < 0 or k >= n or (j := joins.get((ids[i], ids[k]))) is None or j[0] != rank:
                continue  # stale: one of the two is gone or has grown
            ids[i], ids[k] = new, -1
            after = nxt[i] = nxt[k]
            if after < n:
                prv[after] = i
                if j := joins.get((new, ids[after])):
                    heapq.heappush(heap, (j[0], i, j[1]))
            before = prv[i]
            if before >= 0 and (j := joins.get((ids[before], new))):
                heapq.heappush(heap, (j[0], before, j[1]))
        return [x for x in ids if x >= 0]

    def _plain(self, text: str) -> bytes:
        """A pre-token never runs across white space that follows another character, so a lone space begins a piece."""
        if text[0].isspace() or text[-1].isspace() or WIDE(text):
            parts = re.split(r"(?<=\S) (?=\S)", text)
        else:
            parts = text.split(" ")
        return self.pieces[parts[0]] + b"".join(map(self.pieces.__getitem__, [" " + p for p in parts[1:]]))

    def encode(self, text: str) -> bytes:
        """All ids, each as four little-endian bytes."""
        if not text:
            return b""
        out, at = [], 0
        for m in self.added_pattern.finditer(text):
            if m.start() > at:
                out.append(self._plain(text[at : m.start()]))
            out.append(self.added[m[0]].to_bytes(4, "little"))
            at = m.end()
        if at < len(text):
            out.append(self._plain(text[at:]))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """Concatenates the strings of the ids; bytes that aren't UTF-8 become U+FFFD."""
        return b"".join(map(self.strings.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def coder(path: str) -> BytePairCoder:
    """One coder for each worker process and vocabulary file."""
    return BytePairCoder(path)


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (array of ints): the encoded texts themselves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(path)
        for batch in batches:
            for part in slices(batch):
                ids = [np.frombuffer(c.encode(t), "<u4").astype(np.int32) for t in part.column("_text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("_id"), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return id_text(docs, id_col, text_col).mapInArrow(trimmed(run), "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, text, from doc_id, ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(path)
        for batch in batches:
            texts = [c.decode(np.array(x or [], "<u4").tobytes()) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(trimmed(run), "doc_id long, text string")


def round_trip_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document: doc_id, n_tokens, ids_sha256, decoded_sha256; ids stay in the task that made them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(path)
        for batch in batches:
            for part in slices(batch):
                n, a, b = [], [], []
                for text in part.column("_text").to_pylist():
                    ids = c.encode(text)
                    n.append(len(ids) // 4)
                    a.append(sha256(ids).hexdigest())
                    b.append(sha256(c.decode(ids).encode()).hexdigest())
                yield pa.RecordBatch.from_arrays([part.column("_id"), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return id_text(docs, id_col, text_col).mapInArrow(trimmed(run), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
