"""New files through a stage once each: file source, availableNow, and an upsert for each batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def watch_markdown(spark: SparkSession, folder: str, glob: str = "*.md", files_per_batch: int = 10_000) -> DataFrame:
    """file_name, text, mtime of files as they arrive."""
    d = spark.readStream.format("text").option("wholetext", True).option("pathGlobFilter", glob).option("maxFilesPerTrigger", files_per_batch).load(folder)
    return d.select(F.col("_metadata.file_name").alias("file_name"), F.col("value").alias("text"), F.col("_metadata.file_modification_time").alias("mtime"))


def process_new(docs: DataFrame, stage: Callable[[DataFrame], DataFrame], target: str, checkpoint: str) -> StreamingQuery:
    """Each batch's result is appended under its batch number, so that a batch that is run again replaces itself."""

    def each(batch: DataFrame, number: int) -> None:
        stage(batch).write.mode("overwrite").parquet(f"{target}/batch={number}")

    return docs.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest(spark: SparkSession, target: str, key: str = "file_name") -> DataFrame:
    """For each key the row of its last batch."""
    rows = spark.read.option("basePath", target).parquet(f"{target}/batch=*")
    last = rows.groupBy(key).agg(F.max("batch").alias("batch"))
    return rows.join(last, [key, "batch"], "left_semi").drop("batch")
