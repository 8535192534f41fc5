"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text bytes that a Python task holds as numpy arrays at once.
SLICE_BYTES = 2 << 20
#: Most groups whose rows are joined by broadcast.
MOST_HOT = 50_000
#: Rows, of a few numbers each, below which a counted table is joined by broadcast.
MOST_SENT = 500_000
#: Whether the shuffle files of a query go when it ends; else they stay until the driver collects its garbage.
FILES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``. Where it is unset in local mode, as in tests, a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="spark-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that is shuffled, whatever Spark takes its size to be.

    Spark goes by the size of the files, which are compressed, and doesn't count the rows that an explode or a
    Python step adds, so it broadcasts tables of a few MB of files that as rows are larger than the driver.
    """
    return df.hint("merge")


def counted(df: DataFrame) -> DataFrame:
    """A written table of a few numbers a row as a side of a join: broadcast if it has few rows by count, else shuffled."""
    return F.broadcast(df) if df.count() < MOST_SENT else shuffled(df)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back: lineage ends there, and shuffle files go."""
    return written_in_parts([df], name)


def written_in_parts(parts: Iterable[DataFrame], name: str) -> DataFrame:
    """As ``written``, for the rows of all parts, one after the other: the disk holds the shuffle files of one part at a time."""
    made, path = None, ""
    for df in parts:
        made, spark = df, df.sparkSession
        path = path or f"{shared_folder(spark)}/docprep-{name}-{uuid.uuid4().hex}"
        before = spark.conf.get(FILES_GO, "false")
        spark.conf.set(FILES_GO, "true")
        try:
            df.write.mode("append").parquet(path)
        finally:
            spark.conf.set(FILES_GO, before)
    return made.sparkSession.read.schema(made.schema).parquet(path)


def drop_written(df: DataFrame) -> None:
    """Delete the files of a table that ``written`` made and that no later step reads."""
    jvm = df.sparkSession._jvm
    for f in df.inputFiles()[:1]:
        path = jvm.org.apache.hadoop.fs.Path(f).getParent()
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text, under names of our own; further columns can't clash with them."""
    return docs.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))


def slices(batch: pa.RecordBatch, column: str = "_text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of an Arrow batch with about ``most`` bytes of ``column`` each; a longer value is a part of its own."""
    start, size = 0, 0
    for i, n in enumerate(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()):
        if size and size + n > most:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += n
    if start < batch.num_rows:
        yield batch.slice(start)


def trimmed(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for mapInArrow, which gives free memory back to the system when a task ends: the worker lives on beside those of later stages."""

    def with_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
            libc.malloc_trim(0)

    return with_end


def texts_as_bytes(batch: pa.RecordBatch, column: str = "_text") -> list[bytes]:
    return batch.column(column).cast(pa.binary()).to_pylist()


def keep_rows(docs: DataFrame, decided: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, whose id and text are among ``decided`` (doc_id, text_sha256); of equal rows, or rows that agree in both, one."""
    kept = decided.groupBy("doc_id", "text_sha256").agg(F.count("*").alias("_copies")).select(F.col("doc_id").alias("_kept_id"), F.col("text_sha256").alias("_kept_sha"), "_copies")
    sha = F.sha2(F.coalesce(docs[text_col], F.lit("")), 256)
    found = docs.join(shuffled(kept), docs[id_col].eqNullSafe(F.col("_kept_id")) & (sha == F.col("_kept_sha")))
    once = found.where("_copies = 1").select(docs.columns)
    row = F.struct(*(docs[c] for c in docs.columns)).alias("_row")
    more = found.where("_copies > 1").select("_kept_id", "_kept_sha", row).groupBy("_kept_id", "_kept_sha").agg(F.max("_row").alias("_row"))
    return once.unionByName(more.select(*(F.col(f"_row.{c}").alias(c) for c in docs.columns)))


def join_groups(rows: DataFrame, groups: DataFrame, keys: list[str], size: str) -> DataFrame:
    """Joins rows with the one row of their group. size: a column of groups with the number of its rows.

    Groups of many rows, of which there are MOST_HOT at most, are broadcast: no task holds the rows of one.
    """
    total = groups.agg(F.sum(size)).first()[0] or 0
    least = max(1000, total // MOST_HOT)
    hot = groups.where(F.col(size) > least)
    rest = rows.join(F.broadcast(hot.select(keys)), keys, "left_anti").join(shuffled(groups.where(F.col(size) <= least)), keys)
    return rows.join(F.broadcast(hot), keys).unionByName(rest)
