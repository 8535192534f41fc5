"""Predicates and quality gates: what needs repair, what is complete, how a conversion is rated."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import COMPLETE, HOUSE, House
from ..functions.text import contains_any, count_words, let, occurrences, strip, words

#: Fixed value: a page of a file that isn't scanned has so many words at least.
SCANNED_WORDS = 30
OCR_WORD = r"[A-Za-záéíóúñ]{2,}\d|\d[A-Za-záéíóúñ]{2,}"


def scanned(pages: DataFrame, key: str = "file_name", text: str = "text", least: int = SCANNED_WORDS) -> DataFrame:
    """FLT1: fewer than ``least`` words a page."""
    return pages.groupBy(key).agg(F.sum(count_words(F.col(text))).alias("n_words"), F.count("*").alias("n_pages")).withColumn("scanned", F.coalesce(F.try_divide("n_words", "n_pages") < least, F.lit(True)))


def mojibake_ratio(c: Column) -> Column:
    """FLT2a"""
    return occurrences(c, "Ã") / F.greatest(F.length(c), F.lit(1))


def ocr_ratio(c: Column) -> Column:
    """FLT2b"""
    return let(words(c), lambda w: F.size(F.filter(w, lambda x: F.contains(x, F.lit("~")) | x.rlike(OCR_WORD))) / F.greatest(F.size(w), F.lit(1)))


def running_headers(c: Column, phrase: str) -> Column:
    """FLT2c"""
    return F.regexp_count(c, F.lit(rf"(?iU)\Q{phrase}\E")).cast("long")


def buried(c: Column, stem: Column, from_words: int = 5000, head: int = 500) -> Column:
    """FLT2d: no word of the title among the first words of a long document."""
    keys = F.filter(F.split(F.lower(stem), r"[^\p{L}\p{N}_]+", -1), lambda k: F.length(k) > 3)

    def lacks(w: Column) -> Column:
        return let(F.lower(F.array_join(F.slice(w, 1, head), " ")), lambda first: (F.size(w) > from_words) & (F.size(keys) > 0) & ~F.exists(keys, lambda k: F.contains(first, k)))

    return let(words(c), lacks)


def refine_reason(c: Column, stem: Column, house: House = HOUSE, from_words: int = 5000) -> Column:
    """FLT2: the first signal that holds, else ``limpio``."""
    return F.when(mojibake_ratio(c) > 0.003, "mojibake").when(ocr_ratio(c) > 0.01, "ocr").when(running_headers(c, house.running_header) > 3, "headers").when(buried(c, stem, from_words), "buried").otherwise("limpio")


def truncated(c: Column) -> Column:
    """FLT4"""
    return ~F.right(F.regexp_replace(c, r"(?U)\s++\z", ""), F.lit(1)).rlike(r"\A[.!?#-]\z")


def complete(state: Column) -> Column:
    """FLT5"""
    return F.coalesce(state.isin(*COMPLETE), F.lit(False))


def retry(md_words: Column, coverage: Column, raw_words: Column) -> Column:
    """FLT6"""
    return ((md_words < 100) | (coverage < 10)) & (raw_words > 500)


def caveats(c: Column, house: House = HOUSE) -> Column:
    """FLT7: ids of the caveats that a text shows."""
    low = F.lower(c)
    return F.array_compact(F.array(*(F.when(contains_any(low, list(p)), k) for k, p in house.caveats.items())))


def prohibited(c: Column) -> Column:
    """FLT8: kinds of prohibited content."""
    return F.array_compact(
        F.array(
            F.when(contains_any(c, ["⚠️", "🚫"]), "emoji"),
            F.when(c.rlike(r"\[(?:WEB|DOSSIER|FUENTE|REF)\]"), "source_tag"),
            F.when(c.rlike(r"(?imdU)^(?:Aquí tienes|A continuación|Espero que)"), "preamble"),
        )
    )


def page_has_text(c: Column, least: int = 20) -> Column:
    """FLT9"""
    return count_words(c) >= least


def route(scanned_: Column, has_key: Column, has_tesseract: Column) -> Column:
    """RTE1: the method a file starts with."""
    return F.when(~scanned_, "native").when(has_key, "ocr_gemini").when(has_tesseract, "ocr").otherwise("native_fallback")


def coverage(ocr: Column, pages_ok: Column, pages: Column, md_words: Column, raw_words: Column) -> Column:
    """RTE2: per cent, at most 100."""
    return F.when(ocr, F.coalesce(F.try_divide(pages_ok, pages) * 100, F.lit(0.0))).otherwise(F.least(F.lit(100.0), F.coalesce(F.try_divide(md_words, raw_words) * 100, F.lit(100.0))))


def rating(ocr: Column, share: Column, md_words: Column, error: Column) -> Column:
    """RTE3"""
    return F.when(error.isNotNull(), "ERROR").when(md_words == 0, "VACIO").when(ocr & (share >= 80), "OCR_OK").when(ocr, "OCR_PARCIAL").when(share >= 85, "OK").otherwise("REVISAR")


def retention(words_in: Column, words_out: Column, chunks: Column) -> dict[str, Column]:
    """RET1"""
    share = F.round(words_out / F.greatest(words_in, F.lit(1)) * 100, 1)
    return {"retention_pct": share, "status": F.when(chunks > 1, "CHUNKED").when(share < 30, "REVISAR").when(share > 98, "SIN_CAMBIO").otherwise("OK")}


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def blank(c: Column) -> Column:
    return strip(c) == ""
