"""Exact top-k by inner product over an index of pivots and distances.

Inner products become distances: with one more entry, the root of M^2 - |y|^2
where M is the largest norm, all vectors have norm M, and the nearer a vector
is to a query (whose further entry is 0) the larger their inner product. Each
vector is keyed by its nearest pivot and its distance from it; sorted by that
key, runs of ``ANNULUS`` vectors are annuli around their pivots. A query at distance
r from a pivot is at least r - high or low - r from what lies in the annulus
(low, high), by the triangle inequality. It takes annuli by that bound, the best
first, and stops where no bound reaches its k-th best score. Scores are whole
numbers and exact; bounds have some slack for rounding.

The index is a written table of annuli, dealt into groups of ``GROUP_BYTES``.
Queries travel in blocks, sorted by the same key, to all groups; a task holds the
annuli of one group and takes query blocks one after another. Each starts
from the k-th best score in its query's own annulus, so far annuli can be passed over
in all groups. Queries that no bound helps are compared with all rows, in blocks.

Pivots come from a bounded sample (``SAMPLE`` vectors with the least hashes) by
farthest-first choice and some rounds of k-means; all rows are indexed, and
results don't depend on the pivots.

Edge cases: see ``vectors.whole_vectors`` for vectors that take no part; so do
those whose squared norm is 2^62 or more, as their scores aren't longs. Rows are told apart even if
they share an id: such a row is a candidate of the others, and each is a query of its own. Ties
go to the smaller id, null ids last; a null id is no query. Very many equal vectors are
cut into annuli like others. Empty tables and tables of one row give no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written
from .vectors import matrix, whole_vectors

SAMPLE, PIVOTS, ANNULUS, QUERIES, GROUP_BYTES = 4096, 128, 1024, 256, 32 << 20
SAMPLE_BYTES = 16 << 20
#: Share of M^2 by which bounds on scores are raised.
SLACK = 1e-9
_BLOCK = "grp int, kind int, place int, pivot int, low double, high double, n int, ids array<long>, rows array<long>, seeds array<long>, x binary"


def choose_pivots(sample: np.ndarray, most: int, rounds: int = 5) -> np.ndarray:
    """Farthest-first centres, moved by k-means."""
    points = np.unique(sample, axis=0)
    centres = [points[0]]
    near = np.sum((points - centres[0]) ** 2, axis=1)
    while len(centres) < most and near.max() > 0:
        centres.append(points[int(np.argmax(near))])
        near = np.minimum(near, np.sum((points - centres[-1]) ** 2, axis=1))
    found = np.array(centres)
    for _ in range(rounds):
        own = np.argmin(np.sum(found**2, axis=1) - 2 * points @ found.T, axis=1)
        found = np.array([points[own == i].mean(axis=0) if np.any(own == i) else found[i] for i in range(len(found))])
    return found


def lifted(x: np.ndarray, m2: float) -> np.ndarray:
    """Vectors with the entry that gives all of them the squared norm m2."""
    x = x.astype(float)
    return np.hstack([x, np.sqrt(np.maximum(m2 - np.sum(x * x, axis=1), 0.0))[:, None]])


def distances(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = np.sum(points * points, axis=1)[:, None] + np.sum(pivots * pivots, axis=1) - 2 * points @ pivots.T
    return np.sqrt(np.maximum(square, 0.0))


def scores(q: np.ndarray, y: np.ndarray, m2: float) -> np.ndarray:
    """Exact inner products; by floating point where all sums are exact there."""
    if m2 < 2.0**53:
        return (q.astype(float) @ y.astype(float).T).astype(np.int64)
    return q.astype(np.int64) @ y.astype(np.int64).T


def _binary(rows: np.ndarray) -> pa.Array:
    """The rows of a matrix as binary values."""
    rows = np.ascontiguousarray(rows)
    ends = np.arange(len(rows) + 1, dtype=np.int32) * (rows.shape[1] * rows.itemsize)
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(rows)])


class _Best:
    """The k best of one query so far: scores, ids, null marks, rows, best first."""

    __slots__ = ("found", "k", "least", "row")

    def __init__(self, k: int, row: int, seed: int | None) -> None:
        self.k, self.row, self.found = k, row, (np.zeros(0, np.int64),) * 4
        self.least = -(1 << 63) if seed is None else seed

    def add(self, score: np.ndarray, ids: np.ndarray, nulls: np.ndarray, rows: np.ndarray) -> None:
        own = rows != self.row
        both = [np.concatenate([a, b[own]]) for a, b in zip(self.found, (score, ids, nulls, rows), strict=True)]
        order = np.lexsort((both[3], both[1], both[2], -both[0]))[: self.k]
        self.found = tuple(x[order] for x in both)
        if len(order) == self.k:
            self.least = max(self.least, int(self.found[0][-1]))


def _numbers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return column.fill_null(0).to_numpy(zero_copy_only=False), column.is_null().to_numpy(zero_copy_only=False).astype(np.int64)


class _Group:
    """The annuli of one group, and the search among them."""

    def __init__(self, pivots: np.ndarray, m2: float, kind: np.dtype, d: int, k: int) -> None:
        self.pivots, self.m2, self.kind, self.d, self.k = pivots, m2, kind, d, k
        self.annuli: list[tuple] = []
        self.passed = self.seen = 0

    def take(self, block: dict) -> None:
        ids, nulls = _numbers(pa.array(block["ids"], pa.int64()))
        self.annuli.append((np.frombuffer(block["x"], self.kind).reshape(-1, self.d), ids, nulls, np.array(block["rows"], np.int64), block["pivot"], block["low"], block["high"]))

    def search(self, block: dict) -> Iterator[tuple[int, int, _Best]]:
        """(row, id, best) for each query of a block that has a hit here."""
        q = np.frombuffer(block["x"], self.kind).reshape(-1, self.d)
        best = [_Best(self.k, r, s) for r, s in zip(block["rows"], block["seeds"], strict=True)]
        least = np.array([b.least for b in best], dtype=float)
        square = np.sum(q.astype(float) ** 2, axis=1)
        away = distances(np.hstack([q.astype(float), np.zeros((len(q), 1))]), self.pivots)
        at, low, high = (np.array([a[i] for a in self.annuli]) for i in (4, 5, 6))
        gap = np.maximum(0.0, np.maximum(away[:, at] - high, low - away[:, at]))
        bound = (square[:, None] + self.m2 - gap**2) / 2 + SLACK * self.m2 + 1
        for a in np.argsort(-bound.max(axis=0), kind="stable"):
            todo = np.flatnonzero(bound[:, a] >= least)
            self.passed, self.seen = self.passed + len(q) - len(todo), self.seen + len(q)
            if not len(todo):
                continue
            x, ids, nulls, rows, *_ = self.annuli[a]
            score = scores(q[todo], x, self.m2)
            hit = score >= np.array([best[i].least for i in todo])[:, None]
            for t in np.flatnonzero(hit.any(axis=1)):
                own, where = best[todo[t]], hit[t]
                own.add(score[t, where], ids[where], nulls[where], rows[where])
                least[todo[t]] = own.least
        for i, (r, own) in enumerate(zip(block["rows"], best, strict=True)):
            if len(own.found[0]):
                yield r, block["ids"][i], own


def _empty(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")


def build_index(df: DataFrame, is_query: Column, k: int) -> tuple[DataFrame, dict] | None:
    """The written table of annuli (kind 0) and query blocks (kind 1), and what a search must know. is_query: a condition on ``_id``."""
    vectors, d = whole_vectors(df)
    square = F.aggregate("_x", F.lit(0.0), lambda a, v: a + v.cast("double") * v.cast("double"))
    vectors = vectors.select("_id", "_x", square.alias("_s")).where(F.col("_s") < 2.0**62)
    n, m2, top = vectors.agg(F.count("*"), F.max("_s"), F.max(F.greatest(F.array_max("_x"), -F.array_min("_x")))).first()
    if not n:
        return None
    m2 = m2 * (1 + 1e-12) + 1
    kind = np.dtype("<i2" if top < 1 << 15 else "<i4" if top < 1 << 31 else "<i8")
    most = max(1, min(SAMPLE, SAMPLE_BYTES // (8 * d)))
    sample = np.array([r[0] for r in vectors.select("_x", F.xxhash64("_x").alias("h")).orderBy("h").limit(most).collect()])
    pivots = choose_pivots(lifted(sample, m2), min(PIVOTS, max(1, len(sample) // 8)))
    groups = max(-(-n * d * kind.itemsize // GROUP_BYTES), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) if n > 16 * ANNULUS else 4)

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch, d)
                away = distances(lifted(x, m2), pivots)
                near = np.argmin(away, axis=1)
                yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("_row"), batch.column("_query"), pa.array(near, pa.int32()), pa.array(away[np.arange(len(x)), near]), _binary(x.astype(kind))], names=["_id", "_row", "_query", "pivot", "away", "x"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by pivot and distance, as annuli; their queries, with the k-th best score in their annulus, as blocks."""
        part, place, asking = TaskContext.get().partitionId(), 0, []

        def block(kind_: int, pivot: int, low: float, high: float, ids: list, rows: list, seeds: list, x: bytes) -> pa.RecordBatch:
            values = (part, kind_, place, pivot, low, high, len(ids), ids, rows, seeds, x)
            types = (pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types, strict=True)], names=[f.split()[0] for f in _BLOCK.split(", ")])

        def questions() -> pa.RecordBatch:
            ids, rows, seeds, x = zip(*asking, strict=True)
            return block(1, -1, 0.0, 0.0, list(ids), list(rows), list(seeds), b"".join(x))

        def annulus(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            raw, ids, numbers = rows.column("x").to_pylist(), rows.column("_id"), rows.column("_row").to_numpy(zero_copy_only=False)
            away, x = rows.column("away").to_numpy(zero_copy_only=False), b"".join(raw)
            yield block(0, rows.column("pivot")[0].as_py(), float(away.min()), float(away.max()), ids.to_pylist(), numbers.tolist(), [], x)
            asks = np.flatnonzero(rows.column("_query").to_numpy(zero_copy_only=False))
            y = np.frombuffer(x, kind).reshape(-1, d)
            found = scores(y[asks], y, m2)
            for i, own in zip(asks.tolist(), found, strict=True):
                others = np.delete(own, i)
                asking.append((ids[i].as_py(), int(numbers[i]), int(np.partition(others, -k)[-k]) if len(others) >= k else None, raw[i]))

        held: list[pa.RecordBatch] = []
        for batch in batches:
            at, pivot = 0, batch.column("pivot").to_numpy(zero_copy_only=False)
            while at < batch.num_rows:
                if held and held[0].column("pivot")[0].as_py() == pivot[at]:
                    room = ANNULUS - sum(b.num_rows for b in held)
                else:
                    if held:
                        yield from annulus(pa.Table.from_batches(held).combine_chunks().to_batches()[0])
                        place += 1
                    held, room = [], ANNULUS
                end = min(at + room, at + int(np.searchsorted(pivot[at:], pivot[at], side="right")))
                held.append(batch.slice(at, end - at))
                at = end
                if sum(b.num_rows for b in held) == ANNULUS:
                    yield from annulus(pa.Table.from_batches(held).combine_chunks().to_batches()[0])
                    held, place = [], place + 1
                while len(asking) >= QUERIES:
                    rest, asking[QUERIES:] = asking[QUERIES:], []
                    yield questions()
                    asking[:] = rest
        if held:
            yield from annulus(pa.Table.from_batches(held).combine_chunks().to_batches()[0])
        while asking:
            rest, asking[QUERIES:] = asking[QUERIES:], []
            yield questions()
            asking[:] = rest

    rows = vectors.select("_id", "_x", F.monotonically_increasing_id().alias("_row"), F.coalesce(is_query, F.lit(False)).alias("_query"))
    keyed = rows.mapInArrow(key, "_id long, _row long, _query boolean, pivot int, away double, x binary")
    index = written(keyed.repartitionByRange(groups, "pivot", "away", "_row").sortWithinPartitions("pivot", "away", "_row").mapInArrow(pack, _BLOCK), "pivot-index")
    return index, {"pivots": pivots, "m2": m2, "kind": kind, "d": d}


def search(index: DataFrame, known: dict, k: int) -> DataFrame:
    """query_id, rank, vec_id, score for all queries of an index."""
    groups = 1 + index.where("kind = 0").agg(F.max("grp")).first()[0]
    asked = index.where("kind = 1")
    sent = asked.withColumn("grp", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    both = index.where("kind = 0").unionByName(sent).repartitionByRange(groups, "grp").sortWithinPartitions("grp", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grp, group = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                block = batch.slice(i, 1).to_pylist()[0]
                if block["grp"] != grp:
                    grp, group = block["grp"], _Group(k=k, **known)
                if block["kind"] == 0:
                    group.take(block)
                    continue
                if not group.annuli:
                    continue
                made = [(row, own_id, int(s), None if null else int(x), int(r)) for row, own_id, best in group.search(block) for s, x, null, r in zip(*best.found, strict=True)]
                names = ("_query_row", "query_id", "score", "vec_id", "_row")
                yield pa.RecordBatch.from_arrays([pa.array([m[j] for m in made], pa.int64()) for j in range(5)], names=names)

    found = both.mapInArrow(run, "_query_row long, query_id long, score long, vec_id long, _row long")
    order = Window.partitionBy("_query_row").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last(), "_row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def top_k(df: DataFrame, k: int = 10, every: int = 100) -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose id is divisible by ``every`` the k rows with the highest inner products, itself left out."""
    built = build_index(df, F.col("_id") % every == 0, k)
    return search(*built, k) if built else _empty(df)
