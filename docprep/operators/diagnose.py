"""Diagnosis of a document's structure and kind, chunk parameters, and the chunking strategy."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import BASE_PARAMS, KEYWORDS_CULTURAL, KEYWORDS_DEFINITIONS, KEYWORDS_OPERATIONAL
from ..functions.text import let, lines, n_words, occurrences, strip

HEADING = r"\A#{1,3}\s+"
STRUCTURE = ("n_headings", "n_separators", "avg_section_len", "short_line_ratio")


def structure(text: Column) -> Column:
    """DIA1-4 as a struct: n_headings, n_separators, avg_section_len, short_line_ratio. Lines are split once; sections are measured in closed form, without joining them."""

    def measured(ls: Column, stripped: Column, breaks: Column) -> Column:
        heads = F.size(F.filter(ls, lambda x: x.rlike(HEADING)))
        short = F.size(F.filter(stripped, lambda x: (F.length(x) > 0) & (F.length(x) < 30)))
        first, last, m = F.element_at(breaks, 1), F.element_at(breaks, -1), F.size(breaks)
        chars = F.aggregate(F.slice(ls, first + 1, last - first), F.lit(0).cast("long"), lambda a, x: a + F.length(x))
        section = F.when(m >= 2, F.floor((chars + (last - first) - (m - 1)) / (m - 1))).otherwise(F.length(text)).cast("long")
        return F.struct(
            heads.cast("long").alias("n_headings"), (m - heads).cast("long").alias("n_separators"), section.alias("avg_section_len"), F.round(short / F.size(ls), 3).alias("short_line_ratio")
        )

    def with_breaks(ls: Column, stripped: Column) -> Column:
        at = F.array_compact(F.transform(ls, lambda x, i: F.when(x.rlike(HEADING) | (F.get(stripped, i) == "---"), i)))
        return let(at, lambda breaks: measured(ls, stripped, breaks))

    return let(lines(text), lambda ls: let(F.transform(ls, strip), lambda stripped: with_breaks(ls, stripped)))


def _score(low: Column, words: tuple[str, ...]) -> Column:
    return reduce(lambda a, w: a + occurrences(low, w), words, F.lit(0).cast("long"))


def project_type(text: Column) -> Column:
    """DIA5"""

    def judged(s: Column) -> Column:
        op, cult, defs = s[0], s[1], s[2]
        total = op + cult + defs
        return F.when(total == 0, "mixto").when(defs / total > 0.5, "definiciones").when(op / total > 0.6, "operativo").when(cult / total > 0.6, "cultural").otherwise("mixto")

    lists = (KEYWORDS_OPERATIONAL, KEYWORDS_CULTURAL, KEYWORDS_DEFINITIONS)
    return let(let(F.lower(text), lambda low: F.array(*(_score(low, k) for k in lists))), judged)


def entity_length(section: Column) -> Column:
    """DIA6"""
    return F.when(section < 400, "cortas").when(section < 1000, "medias").when(section < 2500, "largas").otherwise("mixto")


def parameters(kind: Column, entities: Column) -> dict[str, Column]:
    """DIA7: max_chars, overlap, min_chunk_size and the reasons."""

    def base(i: int) -> Column:
        return reduce(lambda c, kv: c.when(kind == kv[0], kv[1][i]), BASE_PARAMS.items(), F).otherwise(F.lit(None).cast("int"))

    medium, long_ = (kind == "cultural") & (entities == "medias"), (entities == "largas") & (kind != "definiciones")
    most = F.when(medium, 1500).otherwise(base(0))
    most = F.when(long_, F.greatest(most, F.lit(2000))).otherwise(most)
    overlap = F.when(long_, F.floor(most / 10).cast("int")).when(medium, 150).otherwise(base(1))
    why = F.when(long_, "largas").when(medium, "medias").otherwise("base")
    return {"max_chars": most.cast("long"), "overlap": overlap.cast("long"), "min_chunk_size": base(2).cast("long"), "justification": F.create_map(F.lit("max_chars"), why, F.lit("overlap"), F.lit("proporcional"), F.lit("min_chunk_size"), F.lit("proporcional"))}


def strategy() -> dict[str, Column]:
    """STG1-2 from the columns of a diagnosis."""
    ratio, marks, section, most = F.col("short_line_ratio"), F.col("n_headings") + F.col("n_separators"), F.col("avg_section_len"), F.col("max_chars")
    name = F.when(ratio > 0.60, "fixed").when(marks < 3, "fixed").when(section >= most * 3, "fixed").otherwise("semantic")
    reason = (
        F.when(ratio > 0.60, F.format_string("short_line_ratio=%s > 0.60", ratio.cast("string")))
        .when(marks < 3, F.format_string("%d headings + %d separators", "n_headings", "n_separators"))
        .when(section >= most * 3, F.format_string("avg_section_len=%d >= 3 x max_chars=%d", section, most * 3))
        .otherwise(F.format_string("%d markers", marks))
    )
    semantic = name == "semantic"
    thin = ~semantic & (F.col("overlap") < most * 0.10)
    warnings = F.array_compact(F.array(F.when(semantic & (section > most), "section_over_max"), F.when(semantic & (F.col("n_separators") == 0), "no_separators"), F.when(thin, "thin_overlap")))
    return {"strategy": name, "reason": reason, "warnings": warnings, "coherence_ok": ~thin}


def diagnose(docs: DataFrame, text: str = "text") -> DataFrame:
    """PIP4: docs with the diagnosis as columns. Rows stay where they are."""
    t = F.col(text)
    out = docs.withColumns({"n_words": n_words(t), "text_chars": F.length(t).cast("long"), "_structure": structure(t), "project_type": project_type(t)})
    out = out.withColumns({n: F.col(f"_structure.{n}") for n in STRUCTURE}).drop("_structure")
    out = out.withColumn("entity_len", entity_length(F.col("avg_section_len")))
    return out.withColumns(parameters(F.col("project_type"), F.col("entity_len")))


def decide(diagnosed: DataFrame) -> DataFrame:
    return diagnosed.withColumns(strategy())
