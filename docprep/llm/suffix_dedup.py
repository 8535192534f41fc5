"""Repeated byte strings across documents, by blockwise suffix sorting with a difference cover.

A byte goes if a ``width``-byte string that covers it also starts earlier
(smaller doc_id, or same document and earlier start). Documents are dealt into
blocks of bounded size; the text crosses the network once.

1. Cover filter. Positions whose offset modulo ``PERIOD`` lies in a difference
   cover are sampled. Two equal strings of ``width`` bytes, however they are
   aligned, share a sampled offset, and with it the ``width - PERIOD + 1`` bytes
   that follow, so a suffix without a sample that occurs elsewhere is unique.
   Only short fingerprints of samples are compared: a tie by chance costs work
   and never changes a result.
2. Suffix buckets. The suffixes left are dealt by their least string of
   ``MINI`` bytes (least by a hash), which equal suffixes share; neighbours mostly
   have it in common and travel as one piece of text. A bucket is sorted by
   itself, on the bytes: equal pieces are one; the suffixes of the others are
   sorted by their first ``PERIOD - 1`` bytes; longer ties are resolved by the
   ranks of the bucket's cover samples, sorted beforehand, with the lengths of
   their common prefixes. Of equal suffixes all but the first repeat.

No equality of hashes is taken for one of bytes. A block sends equal pieces once,
so a passage that a third of all rows share is one entry for each block; strings of
``MINI`` bytes that several documents of a bounded sample share are taken last as the
least string, so that a common line surrounded by different texts fills no bucket.
The sample, like the sizes of blocks and buckets, acts on the work alone.

Edge cases: a null text counts as empty; texts shorter than ``width`` lose
nothing and match nothing; equal rows: the later one goes wholly; a null
doc_id counts as the largest; of rows with one doc_id any one counts as the
earlier; an empty table gives no rows; other columns are ignored. Very long documents are worked on in slices
that overlap by ``width - 1`` bytes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cached_property
from hashlib import sha256

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import slices, texts_as_bytes, trimmed
from .exact_dedup import GEAR

WIDTH, PERIOD, MINI = 100, 57, 16
#: A perfect difference cover of 57; each difference occurs among its members.
COVER = (0, 1, 3, 13, 32, 36, 43, 52)
#: Bytes of a block for inputs up to a GB; beyond, they grow with the root of the input, up to the last number.
BLOCK_BYTES, MOST_BLOCK_BYTES, SLICE = 1 << 20, 16 << 20, 1 << 19
#: Fingerprints, and bytes of text, of a bucket.
BUCKET_KEYS, BUCKET_BYTES = 1_000_000, 2 << 20
#: Documents sampled for common strings, the number of them that makes a string common, most such strings, and marks of the table.
SAMPLE, COMMON_IN, COMMON, MARKS = 2000, 4, 200_000, 1 << 22
_ROOT = 0x9E3779B97F4A7C15
_BYTE = GEAR.astype(np.uint64) << np.uint64(32) | GEAR[::-1]
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
LAST = np.iinfo(np.int64).max
#: For the residues of two positions, the least shift that makes both of them sampled.
COMMON_SHIFT = np.array([[min(d for d in range(PERIOD) if (a + d) % PERIOD in COVER and (b + d) % PERIOD in COVER) for b in range(PERIOD)] for a in range(PERIOD)])


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _raised(n: int) -> list[np.ndarray]:
    """The powers of an odd number and of its inverse modulo 2 ** 64, up to n."""
    if len(_powers[0]) <= n:
        for k, base in enumerate((_ROOT, pow(_ROOT, -1, 1 << 64))):
            _powers[k] = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n + (n >> 2), base, np.uint64))])
    return _powers


# --- sorting the suffixes of one bucket


def words_at(text: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as a number; numbers compare as the bytes do. Text ends with room to read."""
    return np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(text, 8)[at]).view(">u8").ravel().astype(np.uint64)


def split_classes(classes: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Classes told apart further by keys, numbered in order, and their sizes."""
    order = np.lexsort((keys, classes))
    c, k = classes[order], keys[order]
    first = np.ones(len(order), bool)
    first[1:] = (c[1:] != c[:-1]) | (k[1:] != k[:-1])
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(first) - 1
    return out, np.bincount(out)


class CoverRanks:
    """Ranks of cover samples in the order of the ``width`` bytes from them on, and common prefixes of any two."""

    def __init__(self, text: np.ndarray, at: np.ndarray, width: int) -> None:
        keys = [words_at(text, at + k) for k in range(0, width, 8)]
        order = np.lexsort(keys[::-1])
        self.place = np.zeros(int(at.max(initial=0)) + 1, np.int64)
        self.place[at[order]] = np.arange(len(at))
        common, alike = np.zeros(max(len(at) - 1, 0), np.int64), np.ones(max(len(at) - 1, 0), bool)
        for k in keys:
            differ = k[order[1:]] ^ k[order[:-1]]
            common += alike * sum((differ < np.uint64(1 << b)).astype(np.int64) for b in range(0, 64, 8))
            alike &= differ == 0
        self.table = [common.astype(np.uint8)]
        while 2 * (1 << len(self.table)) <= 2 * len(common):
            half, t = 1 << (len(self.table) - 1), self.table[-1]
            self.table.append(np.minimum(t[:-half], t[half:]))

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Bytes that the samples at two positions share from the start, up to about the width."""
        a, b = self.place[a], self.place[b]
        low, n = np.minimum(a, b), np.abs(a - b)
        out = np.full(len(a), 255, np.uint8)
        level = np.frexp(np.maximum(n, 1))[1] - 1
        for k in np.unique(level[n > 0]):
            some = np.flatnonzero((level == k) & (n > 0))
            out[some] = np.minimum(self.table[k][low[some]], self.table[k][low[some] + n[some] - (1 << int(k))])
        return out


def repeated_suffixes(text: np.ndarray, at: np.ndarray, rank: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """For suffixes of a text, by their positions: whether one with the same ``width`` first bytes has a smaller rank."""
    out = np.zeros(len(at), bool)
    text = np.concatenate([text, np.zeros(width + 16, np.uint8)])
    live, classes = np.arange(len(at)), np.zeros(len(at), np.int64)

    def told_apart(offset: int) -> None:
        nonlocal live, classes
        classes, sizes = split_classes(classes, words_at(text, at[live] + offset))
        tied = sizes[classes] > 1
        live, classes = live[tied], classes[tied]

    for offset in range(0, PERIOD - 1, 8):
        told_apart(offset)
        if not len(live):
            return out
    near = np.zeros(len(text), np.int64)
    np.add.at(near, at[live], 1)
    np.add.at(near, at[live] + PERIOD, -1)
    sampled = np.flatnonzero((np.cumsum(near) > 0) & np.isin(np.arange(len(text)) % PERIOD, COVER))
    ranks = CoverRanks(text, sampled, width)
    order = np.lexsort((rank[live], classes))
    live, classes = live[order], classes[order]
    for turn in range(64):
        # The first of each class; what equals it repeats, the rest is looked at again.
        first = np.ones(len(live), bool)
        first[1:] = classes[1:] != classes[:-1]
        head = live[first][np.cumsum(first) - 1]
        shift = COMMON_SHIFT[at[live] % PERIOD, at[head] % PERIOD]
        same = ranks.common(at[live] + shift, at[head] + shift) >= width - shift
        out[live[same & ~first]] = True
        live, classes = live[~same], classes[~same]
        if not len(live):
            return out
    for offset in [*range(PERIOD - 1, width - 8, 8), width - 8]:  # very many different ends: by the bytes that are left
        told_apart(offset)
    order = np.lexsort((rank[live], classes))
    out[live[order][1:][np.diff(classes[order]) == 0]] = True
    return out


# --- blocks


class Slice:
    """Up to SLICE bytes of some documents: units of (document, offset of its first byte, bytes)."""

    def __init__(self, units: list[tuple[int, int, bytes]], width: int) -> None:
        self.units, self.width = units, width
        self.sizes = np.array([len(u[2]) for u in units], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.windows = np.maximum(self.sizes - width + 1, 0)
        self.wbase = np.cumsum(self.windows) - self.windows
        self.text = b"".join(u[2] for u in units)

    @cached_property
    def sums(self) -> np.ndarray:
        buf = np.frombuffer(self.text, np.uint8)
        return np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[buf] * _raised(len(buf))[0][: len(buf)])])

    def keys(self, at: np.ndarray | slice, length: int) -> np.ndarray:
        """Hashes of the strings of a length from some positions on."""
        ends = slice(at.start + length, at.stop + length) if isinstance(at, slice) else at + length
        return _mixed((self.sums[ends] - self.sums[at]) * _raised(len(self.text))[1][at])

    @cached_property
    def sampled(self) -> tuple[np.ndarray, np.ndarray]:
        """Sampled positions, and the unit of each."""
        n = np.where(self.windows > 0, self.sizes - (self.width - PERIOD), 0)
        whole = np.arange(-(-int(n.max(initial=0)) // PERIOD)) * PERIOD
        off = (whole[:, None] + np.array(COVER)).ravel()
        counts = np.searchsorted(off, n)
        unit = np.repeat(np.arange(len(n)), counts)
        mine = off[np.arange(len(unit)) - np.repeat(np.cumsum(counts) - counts, counts)]
        return self.starts[unit] + mine, unit

    def sample_keys(self, bits: int) -> np.ndarray:
        return self.keys(self.sampled[0], self.width - PERIOD + 1) & ~np.uint64((1 << (64 - bits)) - 1)

    def tied_windows(self, tied: np.ndarray) -> np.ndarray:
        """Positions of the windows that hold a tied sample."""
        at, unit = self.sampled[0][tied], self.sampled[1][tied]
        size = len(self.text) + 1
        begin, end = np.maximum(at - (PERIOD - 1), self.starts[unit]), np.minimum(at, self.starts[unit] + self.windows[unit] - 1) + 1
        return np.flatnonzero(np.cumsum(np.bincount(begin, minlength=size) - np.bincount(end, minlength=size)) > 0)

    def strings(self) -> np.ndarray:
        """Hashes of the strings of MINI bytes from each position on."""
        return self.keys(slice(0, max(len(self.text) - MINI + 1, 0)), MINI)

    def least_strings(self, common: np.ndarray) -> np.ndarray:
        """For each window the least hash of the strings in it; common strings are greater than all others."""
        h = self.strings()
        h = h >> np.uint64(1) | common[(h & np.uint64(len(common) - 1)).astype(np.int64)].astype(np.uint64) << np.uint64(63)
        span, size = self.width - MINI + 1, 1
        while 2 * size <= span:
            h, size = np.minimum(h[:-size], h[size:]), 2 * size
        return np.minimum(h[: len(h) - (span - size)], h[span - size :]) if span > size else h

    def pieces(self, windows: np.ndarray, common: np.ndarray, bits: int) -> tuple[np.ndarray, ...]:
        """Bucket, first position, number of windows, and unit of each stretch of windows that share their least string."""
        least = self.least_strings(common)[windows]
        cut = np.ones(len(windows), bool)
        cut[1:] = (np.diff(windows) != 1) | (least[1:] != least[:-1])
        first = np.flatnonzero(cut)
        start = windows[first]
        bucket = _mixed(least[first] + np.uint64(1)) >> np.uint64(64 - bits) if bits else np.zeros(len(first), np.uint64)
        return bucket.astype(np.int64), start, np.diff(np.append(first, len(windows))), np.searchsorted(self.starts, start, "right") - 1


class Block:
    """The documents of a block in order of id and text."""

    def __init__(self, ids: list[int | None], texts: list[bytes], width: int) -> None:
        self.order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i], texts[i]))
        self.rows = [(ids[i], texts[i]) for i in self.order]
        self.ids = np.array([LAST if i is None else i for i, _ in self.rows], np.int64)
        self.width, self.slices = width, []
        units, size = [], 0
        for d, (_, text) in enumerate(self.rows):
            for start in range(0, max(len(text) - width + 1, 1), SLICE):
                part = text[start : start + SLICE + width - 1]
                if size and size + len(part) > SLICE:
                    self.slices.append(Slice(units, width))
                    units, size = [], 0
                if len(part) >= width:
                    units.append((d, start, part))
                    size += len(part)
        if units:
            self.slices.append(Slice(units, width))

    def sample_keys(self, bits: int) -> np.ndarray:
        return np.concatenate([np.zeros(0, np.uint64), *(s.sample_keys(bits) for s in self.slices)])

    def pieces(self, keys: np.ndarray, elsewhere: np.ndarray, common: np.ndarray, bits: int) -> dict[int, dict[bytes, list[tuple[int, int]]]]:
        """By bucket the different pieces that may repeat, with their places (document, position). elsewhere: of the sorted keys."""
        _, back, n = np.unique(keys, return_inverse=True, return_counts=True)
        ties = (elsewhere | (n > 1))[back]
        out: dict[int, dict[bytes, list[tuple[int, int]]]] = {}
        at = 0
        for s in self.slices:
            tied = ties[at : at + len(s.sampled[0])]
            at += len(tied)
            windows = s.tied_windows(tied)
            if not len(windows):
                continue
            for bucket, start, count, unit in zip(*(x.tolist() for x in s.pieces(windows, common, bits)), strict=True):
                doc, offset, _ = s.units[unit]
                out.setdefault(bucket, {}).setdefault(s.text[start : start + count + self.width - 1], []).append((doc, offset + start - int(s.starts[unit])))
        return out


# --- rows between blocks and buckets


def _zipped(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(data)


def _planes(values: np.ndarray) -> bytes:
    """64-bit numbers with the bytes of like weight together."""
    return values.view(np.uint8).reshape(-1, 8).T.tobytes()


def _from_planes(data: bytes, kind: str) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view(kind).ravel()


KEY_SCHEMA = "bucket int, blk long, keys binary"
TIE_SCHEMA = "blk long, bucket int, n int, bits binary"
PIECE_SCHEMA = "bucket int, blk long, data binary"
GONE_SCHEMA = "blk long, data binary"


def key_rows(keys: np.ndarray, blk: int, bits: int) -> pa.Table:
    """Sorted different keys by bucket."""
    edge = [0, *(np.searchsorted(keys, np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)).tolist() if bits else ()), len(keys)]
    some = [(b, x, y) for b, (x, y) in enumerate(zip(edge, edge[1:], strict=False)) if y > x]
    return pa.table({"bucket": pa.array([b for b, *_ in some], pa.int32()), "blk": pa.array([blk] * len(some), pa.int64()), "keys": pa.array([_zipped(_planes(keys[x:y])) for _, x, y in some], pa.binary())})


def tie_rows(table: pa.Table) -> pa.Table:
    """One bucket of fingerprints: which of each block's occur in another block."""
    parts = [_from_planes(zstandard.ZstdDecompressor().decompress(k), "<u8") for k in table.column("keys").to_pylist()]
    keys = np.concatenate(parts)
    order = np.argsort(keys)
    same = keys[order[1:]] == keys[order[:-1]]
    tied = np.zeros(len(keys), bool)
    tied[order[1:]] |= same
    tied[order[:-1]] |= same
    sizes = [len(p) for p in parts]
    bits = [np.packbits(x).tobytes() for x in np.split(tied, np.cumsum(sizes)[:-1])]
    return pa.table({"blk": table.column("blk"), "bucket": table.column("bucket"), "n": pa.array(sizes, pa.int32()), "bits": pa.array(bits, pa.binary())})


def ties_of(table: pa.Table) -> np.ndarray:
    rows = sorted(zip(*(table.column(c).to_pylist() for c in ("bucket", "n", "bits")), strict=True))
    return np.concatenate([np.zeros(0, bool), *(np.unpackbits(np.frombuffer(b, np.uint8), count=n).astype(bool) for _, n, b in rows)])


def piece_rows(pieces: dict[int, dict[bytes, list[tuple[int, int]]]], ids: np.ndarray, blk: int) -> pa.Table:
    data = []
    for found in pieces.values():
        places = np.array([p for at in found.values() for p in at], np.int64).reshape(-1, 2)
        heads = [np.array([len(found), len(places)], "<i8"), np.fromiter(map(len, found), "<i8"), np.fromiter(map(len, found.values()), "<i8"), ids[places[:, 0]], places[:, 0], places[:, 1]]
        data.append(_zipped(b"".join([*(h.astype("<i8").tobytes() for h in heads), *found])))
    return pa.table({"bucket": pa.array(list(pieces), pa.int32()), "blk": pa.array([blk] * len(data), pa.int64()), "data": pa.array(data, pa.binary())})


def gone_rows(table: pa.Table, width: int) -> pa.Table:
    """One suffix bucket: the stretches of suffixes that repeat earlier ones, by block: document, first and end."""
    number: dict[bytes, int] = {}
    columns: list[np.ndarray] = []
    for blk, data in zip(table.column("blk").to_pylist(), table.column("data").to_pylist(), strict=True):
        raw = zstandard.ZstdDecompressor().decompress(data)
        n, places = np.frombuffer(raw, "<i8", 2).tolist()
        sizes, counts = np.frombuffer(raw, "<i8", 2 * n, 16).reshape(2, n)
        at = 16 + 16 * n
        where = np.frombuffer(raw, "<i8", 3 * places, at).reshape(3, places)
        ends = (at + 24 * places + np.cumsum(sizes)).tolist()
        mine = np.array([number.setdefault(raw[e - s : e], len(number)) for e, s in zip(ends, sizes.tolist(), strict=True)], np.int64)
        columns.append(np.vstack([np.repeat(mine, counts), where[0], np.full(places, blk, np.int64), where[1:]]))
    piece, ids, blks, docs, pos = np.concatenate(columns, axis=1)
    order = np.lexsort((pos, docs, blks, ids, piece))
    piece, ids, blks, docs, pos = (x[order] for x in (piece, ids, blks, docs, pos))
    first = np.ones(len(piece), bool)
    first[1:] = piece[1:] != piece[:-1]
    # Pieces that are equal to an earlier one repeat from end to end; suffixes of the first ones are sorted.
    counts = np.fromiter(map(len, number), np.int64) - (width - 1)
    text = np.frombuffer(b"".join(number), np.uint8)
    base = np.cumsum(counts + (width - 1)) - (counts + (width - 1))
    of = np.repeat(np.arange(len(counts)), counts)
    inner = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)
    place = np.empty(len(counts), np.int64)
    place[np.lexsort((pos[first], docs[first], blks[first], ids[first]))] = np.arange(len(counts))
    # Within a document pieces don't overlap in the suffixes they hold: (piece's place, place in it) is the order of suffixes.
    again = repeated_suffixes(text, base[of] + inner, place[of] * np.int64(1 << 32) + inner, width)
    edge = np.diff(np.concatenate([[0], again.astype(np.int8), [0]]))
    cut = np.ones(len(of) + 1, bool)
    cut[1:-1] = of[1:] != of[:-1]
    begin = np.flatnonzero((edge == 1) | cut & np.append(again, False))
    end = np.flatnonzero((edge == -1) | cut & np.append(False, again))
    p = of[begin]
    out = [(blks[~first], docs[~first], pos[~first], pos[~first] + counts[piece[~first]]), (blks[first][p], docs[first][p], pos[first][p] + inner[begin], pos[first][p] + inner[end - 1] + 1)]
    blk, doc, start, stop = (np.concatenate(x) for x in zip(*out, strict=True))
    order = np.argsort(blk, kind="stable")
    blk, made = blk[order], np.vstack([doc, start, stop])[:, order]
    edges = np.flatnonzero(np.concatenate([[True], blk[1:] != blk[:-1]])) if len(blk) else np.zeros(0, np.int64)
    data = [_zipped(np.ascontiguousarray(m).astype("<i8").tobytes()) for m in np.split(made, edges[1:], axis=1)] if len(blk) else []
    return pa.table({"blk": pa.array(blk[edges], pa.int64()), "data": pa.array(data, pa.binary())})


def covered(block: Block, gone: pa.Table) -> list[np.ndarray]:
    """For each document of a block, whether each byte is covered by a suffix's first bytes that repeat."""
    out = [np.zeros(len(t) + 1, np.int32) for _, t in block.rows]
    for data in gone.column("data").to_pylist():
        for doc, start, stop in np.frombuffer(zstandard.ZstdDecompressor().decompress(data), "<i8").reshape(3, -1).T.tolist():
            out[doc][start] += 1
            out[doc][stop + block.width - 1] -= 1
    return [np.cumsum(x[:-1]) > 0 for x in out]


def common_strings(base: DataFrame, documents: int, width: int) -> np.ndarray:
    """A table of marks by the low bits of a string's hash: strings that several of the sampled documents share, COMMON at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                found = [np.zeros(0, np.uint64)]
                for text in texts_as_bytes(part):
                    found.append(np.unique(np.concatenate([np.zeros(0, np.uint64), *(s.strings() for s in Block([0], [text], width).slices)])))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64))], names=["h"])

    part = base.where(F.pmod(F.xxhash64("_id", "_text"), F.lit(max(1, documents // SAMPLE))) == 0).select("_text")
    shared = part.mapInArrow(trimmed(run), "h long").groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") >= COMMON_IN).orderBy(F.desc("n"), "h").limit(COMMON).toArrow()
    out = np.zeros(MARKS, bool)
    out[shared.column("h").to_numpy() & (MARKS - 1)] = True
    return out


def _spans(gone: np.ndarray) -> np.ndarray:
    """Starts and ends of the maximal removed runs."""
    edge = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
    return edge.reshape(-1, 2)


def _whole_characters(text: np.ndarray, gone: np.ndarray) -> np.ndarray:
    """The same without parts of characters, so that what stays is UTF-8."""
    inner = (text & 0xC0) == 0x80
    out = np.zeros(len(gone), bool)
    for s, e in _spans(gone).tolist():
        while s < e and inner[s]:
            s += 1
        while e < len(text) and e > s and inner[e]:
            e -= 1
        out[s:e] = True
    return out


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, with_text: bool = False, carry: tuple[str, ...] = (), block_bytes: int | None = None, rank_bits: int | None = None) -> DataFrame:
    """One row for each document: doc_id, n_bytes, n_removed, n_spans, kept_sha256; with_text adds kept_text, carry other columns.

    kept_text keeps characters whole: a character of which only a part would go stays. block_bytes and
    rank_bits (of the fingerprints) act on the work alone.
    """
    if width < PERIOD + 8:
        raise ValueError(f"strings of at least {PERIOD + 8} bytes")
    spark = docs.sparkSession
    base = docs.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("_text"), F.struct(F.lit(0).alias("_none"), *carry).alias("_rest"))
    size, documents = base.agg(F.sum(F.length("_text")), F.count("*")).first()
    size = size or 0
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    block_bytes = block_bytes or int(min(MOST_BLOCK_BYTES, BLOCK_BYTES * max(1.0, math.sqrt(size / (1 << 30)))))
    blocks = max(size // block_bytes, tasks)
    samples = max(size * len(COVER) // PERIOD, 2)
    key_bits, piece_bits = (max(6, math.ceil(math.log2(max(x, 1)))) for x in (samples // BUCKET_KEYS, size // BUCKET_BYTES))
    # With 14 bits more than number the samples, one in 16,000 ties by chance.
    rank_bits = rank_bits or min(64, 8 * math.ceil((math.log2(samples) + 14) / 8))
    key_bits = min(key_bits, rank_bits)
    common = spark.sparkContext.broadcast(common_strings(base, documents, width))
    dealt = base.withColumn("blk", F.pmod(F.xxhash64("_id", "_text"), F.lit(blocks))).repartition(max(tasks, blocks // 8), "blk")

    def opened(t: pa.Table) -> Block:
        return Block(t.column("_id").to_pylist(), t.column("_text").to_pylist(), width)

    def fingerprints(t: pa.Table) -> pa.Table:
        return key_rows(np.unique(opened(t).sample_keys(rank_bits)), t.column("blk")[0].as_py(), key_bits)

    def pieces(t: pa.Table, ties: pa.Table) -> pa.Table:
        if not ties.num_rows:
            return piece_rows({}, np.zeros(0, np.int64), 0)
        block = opened(t)
        return piece_rows(block.pieces(block.sample_keys(rank_bits), ties_of(ties), common.value, piece_bits), block.ids, t.column("blk")[0].as_py())

    def final(t: pa.Table, gone: pa.Table) -> pa.Table:
        block = opened(t)
        out = []
        for (i, text), away in zip(block.rows, covered(block, gone), strict=True):
            arr = np.frombuffer(text, np.uint8)
            out.append((i, len(text), int(away.sum()), len(_spans(away)), sha256(arr[~away].tobytes()).hexdigest(), arr[~_whole_characters(arr, away)].tobytes().decode() if with_text else None))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text", "_rest"]
        return pa.table([*(pa.array([r[k] for r in out], t) for k, t in enumerate(kinds)), t.column("_rest").take(pa.array(block.order, pa.int64()))], names=names)

    groups = dealt.groupBy("blk")
    ties = groups.applyInArrow(lambda t: fingerprints(t), KEY_SCHEMA).groupBy("bucket").applyInArrow(lambda t: tie_rows(t), TIE_SCHEMA)
    dealt_pieces = groups.cogroup(ties.groupBy("blk")).applyInArrow(lambda t, u: pieces(t, u), PIECE_SCHEMA)
    gone = dealt_pieces.groupBy("bucket").applyInArrow(lambda t: gone_rows(t, width), GONE_SCHEMA)
    schema = StructType.fromDDL("doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_text string").add(base.schema["_rest"])
    made = groups.cogroup(gone.groupBy("blk")).applyInArrow(lambda t, u: final(t, u), schema)
    return made.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *["kept_text"] * with_text, *(f"_rest.{c}" for c in carry))
