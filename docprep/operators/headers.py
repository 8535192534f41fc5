"""Running headers and footers, mined from the files of a source instead of stated."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import lines, strip

#: Lengths of lines that may be headers; and buckets that lines are counted in first.
SHORTEST, LONGEST, BUCKETS = 6, 60, 1 << 16


def header_form(line: Column) -> Column:
    """A line as headers are compared: in lower case, without white space at its ends, numbers alike."""
    return F.regexp_replace(F.lower(strip(line)), r"\d++", "#")


def _candidates(text: Column) -> Column:
    forms = F.transform(lines(text), header_form)
    return F.array_distinct(F.filter(forms, lambda f: (F.length(f) >= SHORTEST) & (F.length(f) <= LONGEST)))


def mined_headers(docs: DataFrame, source: str = "source", text: str = "text", share: float = 0.2, least: int = 4) -> DataFrame:
    """FLT2c: source, header, n_files: short lines that stand in at least ``share`` of a source's files, and in ``least``.

    First lines are counted by bucket of their hash, summed in tasks: a bucket below the bound has no
    header, so only the lines of the few buckets above it are counted themselves. Both counts are partial sums by
    task before they are shuffled, so a line of all files is a row for each task. The result is exact.
    Rows with a null source are a source; null texts have no lines but count as files.
    """
    src = F.col(source)
    rows = docs.select(src.alias("source"), F.explode_outer(_candidates(F.col(text))).alias("header"))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("header"), F.lit(BUCKETS)).cast("int"))
    files = docs.groupBy(src.alias("_source")).agg(F.greatest(F.lit(least), F.ceil(F.count("*") * F.lit(share))).alias("bound"))
    of = F.col("source").eqNullSafe(F.col("_source"))
    heavy = rows.where("header IS NOT NULL").groupBy("source", "bucket").agg(F.count("*").alias("n")).join(files, of).where("n >= bound").select("_source", F.col("bucket").alias("_bucket"), "bound")
    counted = rows.where("header IS NOT NULL").join(heavy, of & (F.col("bucket") == F.col("_bucket"))).groupBy("source", "header").agg(F.count("*").alias("n_files"), F.min("bound").alias("bound"))
    return counted.where("n_files >= bound").select("source", "header", "n_files")


def without_headers(docs: DataFrame, headers: DataFrame, source: str = "source", text: str = "text") -> DataFrame:
    """docs without the lines that are headers of their source (``mined_headers``), and ``headers_removed``."""
    own = headers.groupBy(F.col("source").alias("_source")).agg(F.collect_set("header").alias("_headers"))
    both = docs.join(own, F.col(source).eqNullSafe(F.col("_source")), "left")
    all_lines = lines(F.col(text))
    kept = F.filter(all_lines, lambda x: ~F.array_contains("_headers", header_form(x)))
    new = F.when(F.col("_headers").isNull(), F.col(text)).otherwise(F.array_join(kept, "\n"))
    gone = F.when(F.col("_headers").isNull() | F.col(text).isNull(), F.lit(0)).otherwise(F.size(all_lines) - F.size(kept)).cast("long")
    return both.select(*(new.alias(c) if c == text else docs[c] for c in docs.columns), gone.alias("headers_removed"))
