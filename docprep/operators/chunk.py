"""Chunking: arrays of pieces as expressions, and their rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import CHUNK_CHARS, FIXED_CHARS, OVERLAP_WORDS, WINDOW_FROM, WINDOW_WORDS
from ..functions.text import WHITE, let, strip, words

#: Fixed value: what stands between the refined parts of a document.
RULE = "\n\n---\n\n"


def _nonblank(parts: Column) -> Column:
    return F.filter(parts, lambda p: strip(p) != "")


def by_headings(c: Column) -> Column:
    """CHK1: each part begins with its heading."""
    return _nonblank(F.split(c, r"(?md)(?=^#{1,3} )", -1))


def by_paragraphs(c: Column) -> Column:
    """CHK2"""
    return _nonblank(F.split(c, "\n\n", -1))


def greedy(parts: Column, limit: int) -> Column:
    """CHK3: neighbours are joined while they fit. The fold keeps only positions and lengths; texts are joined once at the end."""
    start = F.struct(F.array().cast("array<int>").alias("starts"), F.lit(0).cast("long").alias("size"), F.lit(0).alias("i"))

    def add(s: Column, p: Column) -> Column:
        n = F.length(p).cast("long")
        fits = (s["i"] > 0) & (s["size"] + n + 2 <= limit)
        return F.struct(F.when(fits, s["starts"]).otherwise(F.array_append(s["starts"], s["i"])).alias("starts"), F.when(fits, s["size"] + n + 2).otherwise(n).alias("size"), (s["i"] + 1).alias("i"))

    def joined(own: Column, starts: Column) -> Column:
        ends = F.slice(F.array_append(F.slice(starts, F.lit(2), F.size(own)), F.size(own)), F.lit(1), F.size(starts))
        return F.zip_with(starts, ends, lambda a, b: F.array_join(F.slice(own, a + 1, b - a), "\n\n"))

    return let(parts, lambda own: let(F.aggregate(own, start, add, lambda s: s["starts"]), lambda starts: joined(own, starts)))


def fixed(c: Column, size: int) -> Column:
    """CHK4"""
    return F.when(F.length(c) > 0, F.transform(F.sequence(F.lit(1), F.length(c), F.lit(size)), lambda i: F.substring(c, i, F.lit(size)))).otherwise(F.array().cast("array<string>"))


def tree(c: Column, limit: int = CHUNK_CHARS, size: int = FIXED_CHARS) -> Column:
    """CHK5: headings, then paragraphs, then fixed cuts, each only where the level before leaves too much."""

    def small(g: Column) -> Column:
        return F.when(F.length(g) <= limit, F.array(g)).otherwise(F.flatten(F.transform(greedy(by_paragraphs(g), limit), lambda p: F.when(F.length(p) <= limit, F.array(p)).otherwise(fixed(p, size)))))

    return F.when(F.length(c) <= limit, F.array(c)).otherwise(F.flatten(F.transform(greedy(by_headings(c), limit), small)))


def windows(c: Column, size: int = WINDOW_WORDS, overlap: int = OVERLAP_WORDS, from_words: int = WINDOW_FROM) -> Column:
    """CHK6: overlapping word windows of long texts; a shorter text is its own only chunk."""

    def cut(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(w) - 1, F.lit(size - overlap)), lambda i: F.array_join(F.slice(w, i + 1, F.lit(size)), " "))

    return let(words(c), lambda w: F.when(F.size(w) > from_words, cut(w)).otherwise(F.array(c)))


def chunk_rows(docs: DataFrame, chunks: Column, key: str = "doc_id") -> DataFrame:
    """One row for each chunk: key, chunk_idx (from 0), n_chunks, chunk. The array is a column first, else it would be made again for each of its rows."""
    made = docs.select(key, chunks.alias("_chunks")).select(key, F.size("_chunks").cast("long").alias("n_chunks"), F.posexplode("_chunks").alias("chunk_idx", "chunk"))
    return made.withColumn("chunk_idx", F.col("chunk_idx").cast("long"))


def reassemble(rows: DataFrame, key: str = "doc_id", separator: str = "\n\n", drop_empty: bool = False, text: str = "chunk") -> DataFrame:
    """CHK7: chunks in their order, joined."""
    parts = F.transform(F.array_sort(F.collect_list(F.struct("chunk_idx", text))), lambda x: x[text])
    return rows.groupBy(key).agg(parts.alias("parts")).select(key, F.array_join(F.filter("parts", lambda p: p != "") if drop_empty else F.col("parts"), separator).alias("text"))


def join_parts(parts: Column) -> Column:
    """CHK7: parts that aren't empty, with a rule between them."""
    return F.array_join(F.filter(parts, lambda p: p != ""), RULE)


def border(a: Column, b: Column, most: int) -> Column:
    """How many words, at most ``most``, the end of ``a`` and the beginning of ``b`` (arrays of words) have in common; the longest such border.

    Only where b's first word stands in a's end are the words compared.
    """
    n = F.least(F.lit(most), F.size(a), F.size(b))
    fits = F.filter(F.sequence(F.lit(1), F.greatest(F.lit(1), n)), lambda k: (k <= n) & (F.get(a, F.size(a) - k) == F.get(b, F.lit(0))) & (F.slice(a, F.size(a) - k + 1, k) == F.slice(b, F.lit(1), k)))
    return F.coalesce(F.array_max(fits), F.lit(0))


def join_windows(parts: Column, most: int = OVERLAP_WORDS) -> Column:
    """CHK7 after CHK6: parts without the words that the part before ends with already; a rule where two parts have nothing in common.

    Windows put together again give their text's words, each once. White space within parts stays.
    """

    def without(p: Column, k: Column) -> Column:
        return F.regexp_replace(p, F.concat(F.lit(rf"\A{WHITE}*+(?:[^{WHITE[1:-1]}]++{WHITE}*+){{"), k.cast("string"), F.lit("}")), F.lit(""))

    def piece(kept: Column, own: Column, p: Column, i: Column) -> Column:
        def after(k: Column) -> Column:
            return F.when(k == 0, F.concat(F.lit(RULE), p)).otherwise(let(without(p, k), lambda rest: F.when(rest == "", "").otherwise(F.concat(F.lit(" "), rest))))

        return F.when(i == 0, p).otherwise(let(border(F.get(own, i - 1), F.get(own, i), most), after))

    def joined(kept: Column) -> Column:
        return let(F.transform(kept, words), lambda own: F.array_join(F.transform(kept, lambda p, i: piece(kept, own, p, i)), ""))

    return let(F.filter(parts, lambda p: p != ""), joined)
