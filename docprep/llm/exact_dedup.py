"""Exact duplicates through content-defined chunk recipes.

Texts are cut where a rolling hash of the last 32 bytes says so, so equal
texts are cut alike. Chunks are deduplicated once by fingerprint *and* bytes;
that pass verifies the fingerprints: one that stands for several chunks gets a
number for each of them. A document is then the ordered list of its verified
chunk identifiers, and only these short lists are grouped; whole texts never
move.

Edge cases: a null text counts as empty; empty texts form one group. Rows that
share a doc_id and a text are all kept or all dropped. Very long texts are cut
into chunks like any other. A null doc_id stays
only if no row of its group has an id. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_written, id_text, join_groups, slices, texts_as_bytes, trimmed, written

MIN_CHUNK, MAX_CHUNK, CUT_BITS = 512, 16384, 10


def _gear() -> np.ndarray:
    """256 pseudo-random 32-bit numbers by the splitmix rule."""
    x = np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x >> np.uint64(32)).astype(np.uint32)


GEAR = _gear()


def chunk_ends(texts: list[bytes]) -> list[list[int]]:
    """For each text the offsets at which its chunks end; none for an empty text."""
    buf = np.frombuffer(b"".join(texts), dtype=np.uint8)
    h = GEAR[buf]
    for s in (1, 2, 4, 8, 16):  # the sum over 32 bytes, each shifted by its age
        older = h[:-s] << np.uint32(s)
        h = h.copy()
        h[s:] += older
    cuts = np.flatnonzero(h >> np.uint32(32 - CUT_BITS) == 0) + 1
    bounds = np.cumsum([0, *map(len, texts)])
    lo = np.searchsorted(cuts, bounds[:-1] + MIN_CHUNK)
    hi = np.searchsorted(cuts, bounds[1:])
    out = []
    for s, e, a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), lo.tolist(), hi.tolist(), strict=True):
        ends, at = [], s
        for c in [*cuts[a:b].tolist(), e]:
            if c - at < MIN_CHUNK and c < e:
                continue
            while c - at > MAX_CHUNK:
                at += MAX_CHUNK
                ends.append(at - s)
            if c > at:
                ends.append(c - s)
                at = c
        out.append(ends)
    return out


def _chunks(texts: list[bytes], width: int) -> Iterator[list[tuple[bytes, bytes]]]:
    for text, ends in zip(texts, chunk_ends(texts), strict=True):
        parts = [text[a:b] for a, b in zip([0, *ends], ends, strict=False)]
        yield [(xxhash.xxh3_128_digest(p)[:width], p) for p in parts]


def recipes(docs: DataFrame, width: int = 16) -> DataFrame:
    """doc_id and the fingerprints of its chunks in order, as one binary value."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                made = [b"".join(f for f, _ in row) for row in _chunks(texts_as_bytes(part), width)]
                yield pa.RecordBatch.from_arrays([part.column("_id"), pa.array(made, pa.binary()), part.column("_sha")], names=["_id", "recipe", "_sha"])

    return docs.mapInArrow(trimmed(run), "_id long, recipe binary, _sha string")


def occurrences(docs: DataFrame, width: int = 16) -> DataFrame:
    """Every chunk of every document with its position."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                rows = [(i, k, f, p) for i, row in zip(part.column("_id").to_pylist(), _chunks(texts_as_bytes(part), width), strict=True) for k, (f, p) in enumerate(row)]
                cols = list(zip(*rows, strict=True)) or [[], [], [], []]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.binary(), pa.binary()), strict=True)], names=["_id", "pos", "fp", "chunk"])

    return docs.mapInArrow(trimmed(run), "_id long, pos int, fp binary, chunk binary")


def distinct_chunks(docs: DataFrame, width: int = 16) -> DataFrame:
    """Distinct (fingerprint, bytes). Chunks that repeat within a part are sent once, the rest is combined before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                seen = dict.fromkeys(x for row in _chunks(texts_as_bytes(part), width) for x in row)
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in seen], pa.binary()) for i in (0, 1)], names=["fp", "chunk"])

    return docs.select("_text").mapInArrow(trimmed(run), "fp binary, chunk binary").groupBy("fp", "chunk").agg(F.lit(1).alias("one")).select("fp", "chunk")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fingerprint_bytes: int = 16) -> DataFrame:
    """One row for each document: doc_id, keep_id (largest id of its group), group_size, kept, text_sha256."""
    base = id_text(docs, id_col, text_col)
    made = written(recipes(base.withColumn("_sha", F.sha2(F.col("_text"), 256)), fingerprint_bytes), "recipes")
    chunks = distinct_chunks(base, fingerprint_bytes)
    shared = written(chunks.groupBy("fp").agg(F.count("*").alias("n")).where("n > 1").select("fp"), "collisions")
    if shared.isEmpty():
        drop_written(shared)
        made = made.withColumn("variants", F.array().cast("array<struct<pos:int,variant:int>>"))
    else:  # fingerprints of several chunks: tell their chunks apart by number
        from pyspark.sql import Window

        numbered = written(chunks.join(shared, "fp", "left_semi").withColumn("variant", F.row_number().over(Window.partitionBy("fp").orderBy("chunk"))).where("variant > 1"), "variants")
        at = occurrences(base, fingerprint_bytes).join(shared, "fp", "left_semi").join(numbered, ["fp", "chunk"])
        lists = at.groupBy("_id").agg(F.array_sort(F.collect_set(F.struct("pos", "variant"))).alias("variants")).withColumnRenamed("_id", "_vid")
        made = made.join(lists, made["_id"].eqNullSafe(F.col("_vid")), "left").withColumn("variants", F.coalesce("variants", F.array().cast("array<struct<pos:int,variant:int>>"))).drop("_vid")
    groups = written(made.groupBy("recipe", "variants").agg(F.max("_id").alias("keep_id"), F.count("*").alias("group_size")), "groups")
    return join_groups(made, groups, ["recipe", "variants"], "group_size").select(
        F.col("_id").alias("doc_id"), "keep_id", "group_size", F.col("_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("_sha").alias("text_sha256")
    )
