"""Documents from folders of files, and their export."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .sink import export_documents


def key_of(path: Column, folder: str, full: bool) -> Column:
    """The name of a file: its last part, or with ``full`` its path below the folder that was read, so that equal names of two folders stay apart."""
    if not full:
        return F.element_at(F.split(path, "/"), -1)
    plain = F.regexp_replace(F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), r"\A[a-z0-9+.-]+:(?://[^/]*)?", "")
    base = re.sub(r"\A[a-z0-9+.-]+:(?://[^/]*)?", "", folder).strip("/")
    return F.regexp_replace(plain, rf"\A/*(?:.*?/)??\Q{base}\E/+", "")


def read_markdown(spark: SparkSession, folder: str, glob: str = "*.md", full: bool = False) -> DataFrame:
    """SRC10: file_name, text, mtime. full: folders below are read as well, and names are paths below ``folder``."""
    d = spark.read.option("recursiveFileLookup", full).text(folder, wholetext=True, pathGlobFilter=glob)
    return d.select(key_of(F.col("_metadata.file_path"), folder, full).alias("file_name") if full else F.col("_metadata.file_name").alias("file_name"), F.col("value").alias("text"), F.col("_metadata.file_modification_time").alias("mtime"))


def read_bytes(spark: SparkSession, folder: str, glob: str, full: bool = False) -> DataFrame:
    """SRC1: file_name, content, mtime. full: as for ``read_markdown``."""
    d = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", full).load(folder)
    return d.select(key_of(F.col("path"), folder, full).alias("file_name"), "content", F.col("modificationTime").alias("mtime"))


def decoded(files: DataFrame, strict: bool = False) -> DataFrame:
    """SRC11: content as text; bytes that aren't UTF-8 are an error, or become U+FFFD."""
    c = F.validate_utf8(F.col("content").cast("string")) if strict else F.make_valid_utf8(F.col("content").cast("string"))
    return files.withColumn("text", c).drop("content")


def export_markdown(docs: DataFrame, folder: str, name: str = "file_final", text: str = "text") -> None:
    """SNK1: one file for each document; see ``sink.export_documents``."""
    export_documents(docs, folder, name, text)
