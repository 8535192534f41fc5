"""Near-duplicates by SimHash, each link checked on the shingle sets, and exactly for the pairs that SimHash leaves.

Two documents are similar if their sets of word shingles have a Jaccard similarity
of at least ``LEAST``. SimHash comes first: the fingerprints of the same shingles that
lie within ``RADIUS`` bits are linked as in ``simhash``, and a link stays if the
two whole sets are similar. Sets this similar may well differ in ten bits of 64, so pairs
are left, and a prefix filter finds them: in any one order of all shingles, two similar sets share
a shingle among the first n - ceil(LEAST * n) + 1 of each (n: the set's size), so
documents that meet by such a prefix are all the candidates: no pair is missed, at
any similarity from ``LEAST`` on. Each candidate pair is then checked on the whole sets; what
SimHash brought together or ruled out isn't checked again.

The order puts shingles that a sample of documents has more often last, so that
common passages rarely make documents meet; the sample acts on the work and never on
the result. After SimHash linking is in three steps: each document with those ``STARS`` of the smallest documents of its
buckets that it meets most often; where that leaves a bucket's documents apart, with those of ``PIVOTS``
further documents of its buckets; and then only pairs of a bucket that these links leave apart. In
all of them pairs are passed over whose sets differ in too many shingles by a parity sketch: each shingle flips one of
``SKETCH`` * 64 bits, so the bits in which two sketches differ are no more than the
shingles that only one set has. Wide sketches have as many bits as the set has shingles, to a power of two, and the two halves
of one make the sketch of half the bits; so nearly all pairs that are checked on the sets are similar, and what that
moves doesn't grow with the documents that share a shingle by chance.

What takes much disk is done by ``PASSES`` parts of the keys, and shuffle files go after each.

Edge cases: a null text counts as empty; texts without words are similar to one
another and to nothing else; fewer words than a shingle make one shingle; repeated
shingles count once; shingles stand for themselves by their XXH64; a null id is
never linked. Very long texts are read whole; an empty table has no links.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import counted, drop_written, id_text, join_groups, shuffled, slices, texts_as_bytes, trimmed, written, written_in_parts
from .components import connected_components
from .simhash import links, shingle_hashes, voted

#: Words of a shingle, the least similarity as a fraction of whole numbers, and the bits in which fingerprints that SimHash links may differ.
WORDS, LEAST, RADIUS = 5, (4, 5), 4
#: Documents whose shingles tell which are common, and the number of common ones.
SAMPLE, COMMON = 20_000, 500_000
#: Links of a document in one step at most, documents of a bucket that others are linked with in the second, and longs of a parity sketch.
STARS, PIVOTS, SKETCH = 8, 8, 8
#: Parts of the keys that are worked on one after the other, and rows that a part has at least.
PASSES, PASS_ROWS = 4, 3_000_000


def shingle_set(text: bytes, words: int) -> np.ndarray:
    return np.unique(np.array(shingle_hashes(text, words), np.uint64)).view(np.int64)


def prefix_size(n: int, least: tuple[int, int]) -> int:
    p, q = least
    return n - -(-p * n // q) + 1 if n else 1


def shingle_sets(base: DataFrame, words: int) -> DataFrame:
    """_id and its set, sorted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                sets = [shingle_set(t, words) for t in texts_as_bytes(part)]
                ends = np.cumsum([0, *map(len, sets)])
                yield pa.RecordBatch.from_arrays([part.column("_id"), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(sets)))], names=["_id", "shingles"])

    return base.mapInArrow(trimmed(run), "_id long, shingles array<long>")


def common_shingles(base: DataFrame, words: int, documents: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that several documents of a sample have, sorted, and how many."""
    part = base.where(F.pmod(F.xxhash64("_id"), F.lit(max(1, documents // SAMPLE))) == 0)
    seen = shingle_sets(part, words).select(F.explode("shingles").alias("s")).groupBy("s").agg(F.count("*").alias("n")).where("n > 1")
    top = seen.orderBy(F.desc("n"), "s").limit(COMMON).toArrow()
    keys, counts = top.column("s").to_numpy(), top.column("n").to_numpy()
    order = np.argsort(keys)
    return keys[order], counts[order]


def parity_sketch(shingles: np.ndarray, longs: int = SKETCH) -> list[int]:
    """Longs, a power of two, of whose bits each shingle flips one."""
    ones = np.bincount((shingles.view(np.uint64) >> np.uint64(32)).astype(np.int64) % (longs * 64), minlength=longs * 64) & 1
    return np.packbits(ones.astype(np.uint8)).view(np.int64).tolist()


def wide_sketch(shingles: np.ndarray) -> list[int]:
    """A sketch of about as many bits as there are shingles, at least as the narrow one."""
    return parity_sketch(shingles, max(SKETCH, 1 << (len(shingles) // 64).bit_length()))


def bits_apart(a: Column, b: Column) -> Column:
    """Bits in which two sketches differ, the wider of which is folded to the other's width; one may be twice as wide."""

    def folded(x: Column, to: Column) -> Column:
        return F.when(F.size(x) > to, F.zip_with(F.slice(x, F.lit(1), to), F.slice(x, to + 1, to), lambda u, v: u.bitwiseXOR(v))).otherwise(x)

    width = F.least(F.size(a), F.size(b))
    return F.aggregate(F.zip_with(folded(a, width), folded(b, width), lambda u, v: F.bit_count(u.bitwiseXOR(v))), F.lit(0), lambda s, x: s + x)


def not_too_far(pairs: DataFrame, sketches: DataFrame, least: tuple[int, int]) -> DataFrame:
    """Of the pairs a, b those whose sketches (of, n, wide) don't rule out that they are similar."""
    p, q = least
    one, other = (sketches.toDF(x, f"n{x}", f"w{x}") for x in ("a", "b"))
    both = pairs.join(shuffled(one), "a").join(shuffled(other), "b")
    sizes = F.least("na", "nb") * (p + q) >= (F.col("na") + F.col("nb")) * p
    return both.where(sizes).where(bits_apart(F.col("wa"), F.col("wb")) * (p + q) <= (F.col("na") + F.col("nb")) * (q - p)).select("a", "b").distinct()


def prefixes(base: DataFrame, words: int, least: tuple[int, int], common: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """key, id, n (size of the set), pos (of the key in the order), and at position 0 the set's sketch, its wide sketch and the SimHash fingerprint. An empty set has the key 0 and the size 0."""
    shared = base.sparkSession.sparkContext.broadcast(common)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts = shared.value
        for batch in batches:
            for part in slices(batch):
                rows: list[tuple] = []
                hashes = [np.array(shingle_hashes(t, words), np.uint64) for t in texts_as_bytes(part)]
                for i, h in zip(part.column("_id").to_pylist(), hashes, strict=True):
                    s = np.unique(h).view(np.int64)
                    if not len(s):
                        rows.append((np.zeros(1, np.int64), i, 0, [0] * SKETCH, [0] * SKETCH))
                        continue
                    weight = np.zeros(len(s), np.int64)
                    if len(known):
                        at = np.minimum(np.searchsorted(known, s), len(known) - 1)
                        weight = np.where(known[at] == s, counts[at], 0)
                    rows.append((s[np.lexsort((s, weight))[: prefix_size(len(s), least)]], i, len(s), parity_sketch(s), wide_sketch(s)))
                sizes = [len(r[0]) for r in rows]
                pos = np.concatenate([np.arange(k) for k in sizes])
                cols = [np.concatenate([r[0] for r in rows]), np.repeat(np.array([r[1] for r in rows], np.int64), sizes), np.repeat(np.array([r[2] for r in rows], np.int32), sizes), pos.astype(np.int32)]
                sketches = [pa.array([x for r in rows for x in (r[k], *[None] * (len(r[0]) - 1))], pa.list_(pa.int64())) for k in (3, 4)]
                fps = pa.array(np.repeat(voted(hashes).view(np.int64), sizes), mask=pos > 0)
                yield pa.RecordBatch.from_arrays([*(pa.array(c) for c in cols), *sketches, fps], names=["key", "id", "n", "pos", "sketch", "wide", "fp"])

    return base.mapInArrow(trimmed(run), "key long, id long, n int, pos int, sketch array<long>, wide array<long>, fp long")


def simhash_pairs(fingerprints: DataFrame, radius: int) -> DataFrame:
    """fingerprints: id, fp. Pairs a > b of ids within the radius, which connect all such pairs; of equal fingerprints each with the smallest id."""
    made = written(fingerprints, "fingerprints")
    nodes = written(made.groupBy("fp").agg(F.min("id").alias("rep"), F.count("*").alias("n")), "nodes")
    equal = join_groups(made, nodes.where("n > 1"), ["fp"], "n").where("id > rep").select(F.col("id").alias("a"), F.col("rep").alias("b"))
    out = written(equal.unionByName(links(nodes.select("fp", "rep"), radius, near_only=True)).distinct(), "simhash")
    drop_written(made)
    drop_written(nodes)
    return out


def checked(pairs: DataFrame, base: DataFrame, words: int, least: tuple[int, int]) -> DataFrame:
    """Of the pairs a > b those that are similar. Only sets of documents in a pair are made and moved."""
    p, q = least
    ids = written(pairs.select(F.explode(F.array("a", "b")).alias("_in")).distinct(), "ids")
    sets = written(shingle_sets(base.join(counted(ids), F.col("_id") == F.col("_in"), "left_semi"), words), "sets")
    drop_written(ids)
    left, right = sets.toDF("a", "sa"), sets.toDF("b", "sb")
    both = pairs.join(shuffled(left), "a").join(shuffled(right), "b").withColumn("i", F.size(F.array_intersect("sa", "sb")))
    out = written(both.where(F.col("i") * (p + q) >= (F.size("sa") + F.size("sb")) * p).select("a", "b").distinct(), "similar")
    drop_written(sets)
    return out


def similar_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, least: tuple[int, int] = LEAST, radius: int = RADIUS) -> DataFrame:
    """Links of similar documents: node, root (smallest id of its component) for all that aren't roots."""
    p, q = least
    base = id_text(docs, id_col, text_col).where("_id is not null")
    common = common_shingles(base, words, base.count())
    made = prefixes(base, words, least, common)
    # An empty set doesn't meet a shingle whose hash is 0.
    keyed = written(made.withColumn("empty", F.col("n") == 0), "prefixes")
    by_simhash = simhash_pairs(keyed.where("pos = 0").select("id", "fp"), radius)
    close = checked(by_simhash, base, words, least)

    def by_parts(rows: DataFrame, make: Callable[[DataFrame], DataFrame], name: str) -> DataFrame:
        """make(rows), which works key by key, for one part of the keys after the other."""
        parts = max(1, min(PASSES, rows.count() // PASS_ROWS))
        if parts == 1:
            return written(make(rows), name)
        return written_in_parts((make(rows.where(F.pmod(F.xxhash64("key"), F.lit(parts)) == k)) for k in range(parts)), name)

    def meet(rows: DataFrame) -> DataFrame:
        busy = rows.groupBy("key", "empty").agg(F.count("*").alias("k"), F.min("id").alias("b"), F.min_by(F.struct("n", "pos"), "id").alias("at")).where("k > 1")
        return rows.join(shuffled(busy), ["key", "empty"]).select("key", "empty", "id", "n", "pos", "b", "at")

    met = by_parts(keyed.select("key", "empty", "id", "n", "pos"), meet, "met")
    sketches = written(keyed.where("pos = 0").select(F.col("id").alias("of"), "n", "sketch", "wide").distinct(), "sketches")
    drop_written(keyed)

    def possible(n, pos, m, at):
        """Whether what follows the first shared shingle can be enough."""
        return F.least(n - pos, m - at) * (p + q) >= (n + m) * p

    meeting = met.where(F.col("id") > F.col("b")).where(possible(F.col("n"), F.col("pos"), F.col("at.n"), F.col("at.pos")))

    def most_met(pairs: DataFrame) -> DataFrame:
        often = pairs.groupBy("a", "b").agg(F.count("*").alias("k")).groupBy("a").agg(F.slice(F.sort_array(F.collect_list(F.struct(-F.col("k"), "b"))), 1, STARS).alias("l"))
        return often.select("a", F.explode("l.b").alias("b"))

    def apart_by(rows: DataFrame, links: DataFrame, name: str) -> DataFrame:
        """Rows of buckets whose documents have several roots, with their root r and the bucket's pivots: the smallest of the documents of each residue of a hash."""
        roots = written(connected_components(links), "roots")
        side = counted(roots)
        part = F.pmod(F.xxhash64("id"), F.lit(PIVOTS))
        pivots = F.array_compact(F.array(*(F.min(F.when(part == j, F.struct("id", "n", "pos", "r"))) for j in range(PIVOTS))))

        def split(own: DataFrame) -> DataFrame:
            rooted = own.join(side, F.col("id") == F.col("node"), "left").select(*own.columns, F.coalesce("root", "id").alias("r"))
            several = rooted.groupBy("key", "empty").agg(F.min("r").alias("low"), F.max("r").alias("high"), pivots.alias("pivots")).where("low < high").select("key", "empty", "pivots")
            return rooted.join(shuffled(several), ["key", "empty"])

        out = by_parts(rows.drop("r", "pivots"), split, name)
        drop_written(roots)
        drop_written(rows)
        return out

    wide = sketches.select("of", "n", "wide")

    first = written(not_too_far(most_met(meeting.select(F.col("id").alias("a"), "b")).join(shuffled(by_simhash), ["a", "b"], "left_anti"), wide, least), "pairs")
    stars = close.unionByName(checked(first, base, words, least))
    first = by_simhash.unionByName(first)
    left = apart_by(met.select("key", "empty", "id", "n", "pos"), stars, "apart")
    at = left.select("id", "n", "pos", "r", F.explode("pivots").alias("at")).where("id <> at.id and r <> at.r").where(possible(F.col("n"), F.col("pos"), F.col("at.n"), F.col("at.pos")))
    second = written(not_too_far(most_met(at.select(F.greatest("id", "at.id").alias("a"), F.least("id", "at.id").alias("b"))).join(shuffled(first), ["a", "b"], "left_anti"), wide, least), "pairs")
    stars = stars.unionByName(checked(second, base, words, least))
    apart = apart_by(left, stars, "apart").drop("pivots")
    narrow = shuffled(sketches.select("of", F.col("n").alias("of_n"), "sketch"))
    left = written(apart.join(narrow, (F.col("id") == F.col("of")) & (F.col("n") == F.col("of_n"))).drop("of", "of_n"), "sketched")
    drop_written(apart)
    differ = sum((F.bit_count(F.col("sketch")[i].bitwiseXOR(F.col("sketch2")[i])) for i in range(SKETCH)), F.lit(0))
    near = differ * (p + q) <= (F.col("n") + F.col("n2")) * (q - p)

    def unlinked(own: DataFrame) -> DataFrame:
        other = own.select("key", "empty", *(F.col(c).alias(f"{c}2") for c in ("id", "n", "pos", "r", "sketch")))
        rest = own.join(shuffled(other), ["key", "empty"]).where("r <> r2 and id > id2").where(possible(F.col("n"), F.col("pos"), F.col("n2"), F.col("pos2"))).where(near)
        return rest.select(F.col("id").alias("a"), F.col("id2").alias("b")).distinct()

    rest = by_parts(left, unlinked, "rest")
    drop_written(left)
    pairs = written(not_too_far(rest.distinct().join(shuffled(first.unionByName(second)), ["a", "b"], "left_anti"), wide, least), "pairs")
    drop_written(sketches)
    return connected_components(stars.unionByName(checked(pairs, base, words, least)))
