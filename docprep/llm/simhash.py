"""SimHash near-duplicates by covering locality-sensitive hashing.

Every bit of a 64-bit fingerprint is given a non-zero vector of radius + 1
bits. For each non-zero vector v, a table keeps the bits whose vector has odd
parity with v. At most ``radius`` differing bits always leave some v that is
even with all of them, so each pair within the radius meets in a table: no
pair is missed.

Equal fingerprints are one node. Buckets of up to ``BLOCK`` nodes are compared
in numpy; larger ones are linked through every value within half the radius of
a node (two nodes share such a value exactly if they are within the radius),
which grows with the bucket and not with its square.

Edge cases: a null text or one without words has fingerprint zero and is
linked like any other; fewer words than a shingle make one shingle; repeated
shingles count each time; repeated rows have one component, a null id is never its
name while it has another member; very long texts are read whole; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_written, id_text, join_groups, shuffled, slices, texts_as_bytes, trimmed, written
from .components import connected_components

BLOCK = 2048
SEED = 42


def shingle_hashes(text: bytes, words: int) -> list[int]:
    """XXH64 of each shingle of the lower-cased text; bytes.split() splits at 0x20 and 0x09-0x0D alone."""
    w = text.lower().split()
    if not w:
        return []
    joined = b" ".join(w)
    if len(w) <= words:
        return [xxhash.xxh64_intdigest(joined, SEED)]
    sizes = np.fromiter(map(len, w), np.int64, len(w))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes)[: 1 - words or None].tolist()
    h = xxhash.xxh64_intdigest
    return [h(joined[a:b], SEED) for a, b in zip(starts, ends[words - 1 :].tolist(), strict=True)]


def voted(hashes: list[np.ndarray]) -> np.ndarray:
    """The fingerprint of each list of shingle hashes: a bit is one if more than half of them have it."""
    out = np.zeros(len(hashes), np.uint64)
    at = [i for i, h in enumerate(hashes) if len(h)]
    if at:
        sizes = np.array([len(hashes[i]) for i in at])
        bits = np.unpackbits(np.concatenate([hashes[i] for i in at]).astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes = np.add.reduceat(bits, np.cumsum(sizes) - sizes, axis=0, dtype=np.int32)
        out[at] = np.packbits(votes * 2 > sizes[:, None], axis=1, bitorder="little").view("<u8").ravel()
    return out


def fingerprints(texts: list[bytes], words: int = 4) -> np.ndarray:
    return voted([np.array(shingle_hashes(t, words), np.uint64) for t in texts])


def with_fingerprints(docs: DataFrame, words: int = 4) -> DataFrame:
    """_id and fp (64 bits as a long)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                fp = fingerprints(texts_as_bytes(part), words).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column("_id"), pa.array(fp)], names=["_id", "fp"])

    return docs.mapInArrow(trimmed(run), "_id long, fp long")


def covering_masks(radius: int) -> list[int]:
    """2 ** (radius + 1) - 1 masks of 64 bits, as signed longs."""
    top = 2 ** (radius + 1) - 1
    masks = [sum(1 << i for i in range(64) if bin((1 + i % top) & v).count("1") % 2) for v in range(1, top + 1)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _close_in_bucket(fps: list[int], reps: list[int], radius: int, near_only: bool = False) -> Iterator[tuple[int, int]]:
    """Links each node of a bucket to the smallest of its component within the bucket; near_only: to a node of it within the radius."""
    order = np.argsort(reps, kind="stable")
    r, f = np.array(reps, np.int64)[order], np.array(fps, np.int64)[order].view(np.uint64)
    free = np.ones(len(r), bool)
    for i in range(len(r)):
        if not free[i]:
            continue
        free[i] = False
        todo = [i]
        while todo and free.any():
            left = np.flatnonzero(free)
            at = todo.pop()
            near = left[np.bitwise_count(f[left] ^ f[at]) <= radius]
            free[near] = False
            todo += near.tolist()
            to = int(r[at if near_only else i])
            yield from ((max(int(r[k]), to), min(int(r[k]), to)) for k in near)


def bucket_links(buckets: DataFrame, radius: int, near_only: bool = False) -> DataFrame:
    """buckets: key, members (array of structs fp, rep). Returns links a > b."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = set()
            for m in batch.column("members").to_pylist():
                found.update(_close_in_bucket([x["fp"] for x in m], [x["rep"] for x in m], radius, near_only))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], names=["a", "b"])

    return buckets.mapInArrow(trimmed(run), "a long, b long")


def midpoint_links(nodes: DataFrame, radius: int) -> DataFrame:
    """nodes: fp, rep, mask. Links the nodes that share a value at most radius / 2 free bits away from each."""
    half = radius - radius // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flips: dict[int, np.ndarray] = {}
        for batch in batches:
            for fp, rep, mask in zip(*(batch.column(c).to_pylist() for c in ("fp", "rep", "mask")), strict=True):
                if mask not in flips:
                    free = [1 << i for i in range(64) if not mask >> i & 1]
                    flips[mask] = np.array([sum(c) for k in range(half + 1) for c in combinations(free, k)], np.uint64)
                around = (flips[mask] ^ np.array([fp], np.int64).view(np.uint64)).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(around), pa.array(np.full(len(around), rep)), pa.array(np.full(len(around), fp))], names=["mid", "rep", "fp"])

    around = nodes.mapInArrow(trimmed(run), "mid long, rep long, fp long")
    least = around.groupBy("mid").agg(F.min("rep").alias("b"), F.min_by("fp", "rep").alias("bfp"))
    # An odd radius makes the sum of two halves one too many: check each link; the links to the least member alone would then not do.
    if radius % 2:
        other = around.select("mid", F.col("rep").alias("b"), F.col("fp").alias("bfp"))
        return around.join(shuffled(other), "mid").where((F.col("rep") > F.col("b")) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("bfp"))) <= radius)).select(F.col("rep").alias("a"), "b").distinct()
    return around.join(shuffled(least), "mid").where("rep > b").select(F.col("rep").alias("a"), "b").distinct()


def links(nodes: DataFrame, radius: int = 4, block: int = BLOCK, near_only: bool = False) -> DataFrame:
    """nodes: fp (distinct), rep. Links a > b between reps that connect all pairs within the radius; near_only: by such pairs alone."""
    tables = [F.struct((F.col("fp").bitwiseAND(F.lit(m)).bitwiseXOR(F.lit(~m & (k * 0x9E3779B97F4A7C15 & 0x7FFFFFFFFFFFFFFF)))).alias("key"), F.lit(m).alias("mask")) for k, m in enumerate(covering_masks(radius))]
    keyed = nodes.select("fp", "rep", F.explode(F.array(*tables)).alias("t")).select("fp", "rep", "t.key", "t.mask")
    busy = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    met = keyed.join(shuffled(busy), "key")
    small = met.where(F.col("n") <= block).groupBy("key").agg(F.collect_list(F.struct("fp", "rep")).alias("members"))
    found = written(met.where(F.col("n") > block), "large-buckets")
    out = bucket_links(small, radius, near_only)
    return out if found.isEmpty() else out.unionByName(midpoint_links(found.select("fp", "rep", "mask"), radius))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, radius: int = 4, block: int = BLOCK) -> DataFrame:
    """One row for each document: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable)."""
    if radius % 2:
        block = 1 << 62  # the midpoint form is linear for an even radius only
    made = written(with_fingerprints(id_text(docs, id_col, text_col), words), "fingerprints")
    nodes = written(made.groupBy("fp").agg(F.min("_id").alias("rep"), F.count("*").alias("n")), "nodes")
    roots = connected_components(links(nodes.where("rep is not null").select("fp", "rep"), radius, block))
    whole = written(nodes.join(shuffled(roots), nodes["rep"] == roots["node"], "left").select("fp", "n", F.coalesce("root", "rep").alias("component_id")), "classes")
    drop_written(nodes)
    return join_groups(made, whole, ["fp"], "n").select(F.col("_id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
