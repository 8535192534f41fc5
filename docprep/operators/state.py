"""Hidden joins and state: what is pending, what is reused, what is new, and upserts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .gates import complete


def stem(name: Column) -> Column:
    return F.regexp_replace(name, r"\.[^.]*\z", "")


def lacking(sources: DataFrame, outputs: DataFrame, source: str = "file_name", output: str = "file_name") -> DataFrame:
    """JN1: sources without an output of the same stem."""
    done = outputs.select(stem(F.col(output)).alias("_stem"))
    return sources.join(done, stem(F.col(source)) == F.col("_stem"), "left_anti")


def pending(docs: DataFrame, state: DataFrame, key: str = "file_name", status: str = "file_status", force: bool = False) -> DataFrame:
    """JN2: documents whose state isn't complete; all if forced."""
    if force:
        return docs
    done = state.where(complete(F.col(status))).select(F.col(key).alias("_key"))
    return docs.join(done, F.col(key) == F.col("_key"), "left_anti")


def with_saved(chunks: DataFrame, saved: DataFrame, keys: tuple[str, str] = ("file_name", "chunk_idx"), result: str = "result") -> DataFrame:
    """JN3: chunks with their saved result, null where the model must be called."""
    return chunks.join(saved.select(*keys, result), list(keys), "left")


def incremental(sources: DataFrame, outputs: DataFrame, key: str = "out_name") -> DataFrame:
    """JN4: NEW, UPDATE (source later than output) or SKIP, by the name an output would have."""
    out = outputs.groupBy(F.col(key).alias("_key")).agg(F.max("mtime").alias("_out_time"))
    joined = sources.join(out, F.col(key) == F.col("_key"), "left")
    action = F.when(F.col("_key").isNull(), "NEW").when(F.col("mtime") > F.col("_out_time"), "UPDATE").otherwise("SKIP")
    return joined.withColumn("action", action).drop("_key", "_out_time")


def incremental_by_containment(sources: DataFrame, outputs: DataFrame) -> DataFrame:
    """JN4, by the old rule: the least output name that contains the source's stem.

    Output names are cut into their substrings of the length of some stem, so the join is on equality. The
    lengths, of which there are no more than characters in the longest name, are read first.
    """
    stems = sources.withColumn("_stem", stem(F.col("file_name")))
    sizes = sorted(r[0] for r in stems.select(F.length("_stem")).where("_stem IS NOT NULL").distinct().collect())
    fitting = F.filter(F.array(*map(F.lit, sizes)).cast("array<int>"), lambda n: n <= F.length("out_name"))
    parts = outputs.select("out_name", F.col("mtime").alias("_out_time"), F.explode(fitting).alias("_n"))
    parts = parts.select("out_name", "_out_time", F.explode(F.transform(F.sequence(F.lit(1), F.length("out_name") - F.col("_n") + 1), lambda i: F.substring("out_name", i, F.col("_n")))).alias("_part"))
    first = parts.groupBy("_part").agg(F.min(F.struct("out_name", "_out_time")).alias("_hit"))
    joined = stems.join(first, F.col("_stem") == F.col("_part"), "left")
    action = F.when(F.col("_hit").isNull(), "NEW").when(F.col("mtime") > F.col("_hit._out_time"), "UPDATE").otherwise("SKIP")
    return joined.select("file_name", "mtime", F.col("_hit.out_name").alias("matched"), action.alias("action"))


#: Rows of one bucket of ``ordinals``, about, and most buckets.
BUCKET_ROWS, MOST_BUCKETS = 200_000, 10_000


def _place_among(k: Column, edges: list) -> Column:
    """How many of the sorted edges are below k, by halving: the largest power of two first."""
    if not edges:
        return F.lit(0)
    bounds, steps = F.array(*map(F.lit, edges)), [1 << i for i in reversed(range(len(edges).bit_length()))]
    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda at, step: F.when(F.get(bounds, at + step - 1) < k, at + step).otherwise(at))


def ordinals(rows: DataFrame, key: str = "file_name", buckets: int | None = None, name: str = "i") -> DataFrame:
    """WIN7, SRT1: rows numbered 1..n in the order of ``key``, nulls first; rows with one key are numbered in any order.

    ``buckets`` ranges of keys (by default as many as ``BUCKET_ROWS`` asks for), bounded by the keys with the least hashes, are numbered
    side by side; the rows before each range are added from their counts, of which there are as many as buckets.
    """
    k = F.col(key)
    if buckets is None:
        buckets = max(1, min(MOST_BUCKETS, rows.count() // BUCKET_ROWS))
    edges = sorted(r[0] for r in rows.where(k.isNotNull()).select(key).distinct().orderBy(F.xxhash64(k), k).limit(buckets - 1).collect())
    dealt = rows.withColumn("_bucket", _place_among(k, edges))
    counts = dealt.groupBy("_bucket").agg(F.count("*").alias("_n"))
    before = counts.withColumn("_before", F.sum("_n").over(Window.orderBy("_bucket")) - F.col("_n")).drop("_n")
    place = F.row_number().over(Window.partitionBy("_bucket").orderBy(k))
    return dealt.withColumn("_place", place).join(F.broadcast(before), "_bucket").withColumn(name, F.col("_before") + F.col("_place")).drop("_bucket", "_place", "_before")


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """SNK7, SET1: old rows without a new one of their key, and the new ones."""
    return old.join(new.select(*keys), keys, "left_anti").unionByName(new)
