"""Reports: fixed-width rows and their totals, as DataFrames of numbered lines."""

from __future__ import annotations

import time
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: States of files in the stages' rows.
STATES = ("OK", "OCR_OK", "OCR_PARCIAL", "REVISAR", "VACIO", "CHUNKED", "COPY", "SIN_CAMBIO", "ERROR")


def coverage_summary(rows: DataFrame) -> DataFrame:
    """AG5"""
    c = F.col("status")
    return rows.agg(F.count_if(c.isin("OK", "OCR_OK")).alias("n_ok"), F.count_if(c.isin("REVISAR", "OCR_PARCIAL")).alias("n_review"), F.count_if(c == "ERROR").alias("n_error"), F.count("*").alias("n_files"))


def refine_summary(rows: DataFrame) -> DataFrame:
    """AG6"""
    c = F.col("status")
    return rows.agg(F.count_if(c.isin("OK", "CHUNKED", "SIN_CAMBIO")).alias("n_done"), F.count_if(c == "COPY").alias("n_copied"), F.count_if(c == "REVISAR").alias("n_review"), F.count_if(c == "ERROR").alias("n_error"), F.sum("tokens_in").alias("tokens_in"), F.sum("tokens_out").alias("tokens_out"))


def build_totals(rows: DataFrame) -> DataFrame:
    """AG7: rows with an error count, but add nothing."""
    ok = F.col("error").isNull()
    return rows.agg(F.count("*").alias("n_files"), F.sum(F.when(ok, F.col("tokens_in"))).alias("tokens_in"), F.sum(F.when(ok, F.col("tokens_out"))).alias("tokens_out"), F.round(F.sum(F.when(ok, F.col("cost"))), 6).alias("cost"))


def fold_tokens(chunks: DataFrame, key: str = "file_name") -> DataFrame:
    """AG8: sums by file; the model is that of the last chunk."""
    return chunks.groupBy(key).agg(F.sum("tokens_in").alias("tokens_in"), F.sum("tokens_out").alias("tokens_out"), F.max_by("model", "chunk_idx").alias("model"), F.count("*").alias("n_chunks"))


# Widths of the columns of reports.
COVERAGE_WIDTHS = {"file_name": -40, "method": -16, "raw_words": 8, "md_words": 8, "coverage": 7}
GLOBAL_WIDTHS = {"file_name": -25, "file_final": -35, "status": -8, "strategy": -10, "n_caveats": -8}


def cell(text: Column, width: int) -> Column:
    """A value in a column; a negative width aligns to the left. Longer values stay whole."""
    pad = F.repeat(F.lit(" "), F.greatest(F.lit(0), F.abs(F.lit(width)) - F.length(text)))
    return F.concat(text, pad) if width < 0 else F.concat(pad, text)


def _row(values: list[Column], widths: dict[str, int], end: Column) -> Column:
    return F.concat(F.array_join(F.array(*(cell(v, w) for v, w in zip(values, widths.values(), strict=True))), " "), end)


def ordered(lines: DataFrame) -> DataFrame:
    """SRT1: the lines of a report by section, file and their place in it; the sort is by range, so no task has them all."""
    return lines.orderBy("section", "file_name", "pos")


def coverage_lines(rows: DataFrame) -> DataFrame:
    """SNK3: section, file_name, pos, line: head, one line for each file, and the counts of all.

    rows: as from ``plans.stages.convert``.
    """
    name = F.substring("file_name", 1, 40)
    line = _row([name, F.col("method"), F.col("raw_words").cast("string"), F.col("md_words").cast("string"), F.format_string("%.1f%%", F.col("coverage").cast("double"))], COVERAGE_WIDTHS, F.concat(F.lit("  "), F.col("status")))
    body = rows.select(F.lit(1).alias("section"), "file_name", F.lit(0).alias("pos"), line.alias("line"))
    titles = _row([F.lit(t) for t in ("Archivo", "Metodo", "Pal.PDF", "Pal.MD", "%")], COVERAGE_WIDTHS, F.lit("  Estado"))
    counts = [x for s in ("OK", "OCR_OK", "OCR_PARCIAL", "REVISAR", "ERROR") for x in (F.lit(f" | {s}: "), F.count_if(F.col("status") == s).cast("string"))]
    foot = rows.agg(F.concat(F.lit("Total: "), F.count("*").cast("string"), *counts).alias("line"), titles.alias("titles"))
    ends = foot.select(F.posexplode(F.array("titles", "line")).alias("k", "line")).select((F.col("k") * 2).alias("section"), F.lit("").alias("file_name"), F.lit(0).alias("pos"), "line")
    return body.unionByName(ends)


def refine_lines(rows: DataFrame) -> DataFrame:
    """SNK4: one line for each file and the total of all, from one scan: ``rollup`` adds the total to the sums by file. No rows give no total."""
    d = rows.rollup("file_name").agg(F.grouping_id().alias("total"), F.sum("tokens_in").alias("i"), F.sum("tokens_out").alias("o"), F.min("status").alias("s"))
    d = d.select(F.when(F.col("total") == 1, "TOTAL").otherwise(F.col("file_name")).alias("file_name"), "i", "o", F.when(F.col("total") == 1, "").otherwise(F.col("s")).alias("s"))
    return d.select("file_name", F.concat(F.rpad(F.substring("file_name", 1, 40), 42, " "), F.lpad(F.col("i").cast("string"), 12, " "), F.lpad(F.col("o").cast("string"), 12, " "), F.lit("  "), F.col("s")).alias("line"))


class Run:
    """Counts, sums, date and elapsed time of a run, taken while its rows pass by: no scan of its own.

    ``watch`` gives the rows to write; when they are written, ``metrics`` has the figures, as one row.
    """

    def __init__(self, name: str = "run") -> None:
        self.seen, self.began, self.clock = Observation(name), datetime.now(timezone.utc), time.monotonic()

    def watch(self, rows: DataFrame) -> DataFrame:
        """rows: as from ``plans.stages.build`` or ``refine``; columns that they lack count as nothing."""
        ok = (F.col("error").isNull() if "error" in rows.columns else F.lit(True)) & (F.col("status") != "ERROR")
        sums = [F.coalesce(F.sum(F.when(ok, F.col(c))), F.lit(0)).alias(c) if c in rows.columns else F.lit(0).alias(c) for c in ("tokens_in", "tokens_out", "cost")]
        states = F.map_from_arrays(*(F.array(*x) for x in zip(*((F.lit(s), F.count_if(F.col("status") == s)) for s in STATES), strict=True)))
        return rows.observe(self.seen, F.count("*").alias("n_files"), F.count_if(~ok).alias("n_errors"), *sums, states.alias("states"))

    def metrics(self, spark: SparkSession) -> DataFrame:
        """run_date, n_files, n_errors, tokens_in, tokens_out, cost, states (map), elapsed_s. Waits until the watched rows have been written."""
        got = self.seen.get
        row = (self.began.strftime("%Y-%m-%d"), got["n_files"], got["n_errors"], int(got["tokens_in"]), int(got["tokens_out"]), float(got["cost"]), {k: v for k, v in dict(got["states"]).items() if v}, round(time.monotonic() - self.clock, 1))
        return spark.createDataFrame([row], "run_date string, n_files long, n_errors long, tokens_in long, tokens_out long, cost double, states map<string,long>, elapsed_s double")


def caveat_counts(rows: DataFrame) -> DataFrame:
    """SNK6: files by caveat."""
    return rows.select("file_name", F.explode("caveat_ids").alias("caveat_id")).groupBy("caveat_id").agg(F.count_distinct("file_name").alias("n_files"), F.min("file_name").alias("first_file"))


def _card(title: Column, fields: list[tuple[str, Column]]) -> Column:
    """A short text for consoles and logs: a title, a rule and a line for each field."""
    return F.concat(title, F.lit("\n" + "─" * 53), *(x for name, value in fields for x in (F.lit(f"\n{name:<16}"), F.coalesce(value, F.lit("-")))))


def diagnosis_card(name: str = "file_name") -> Column:
    """SNK8: a diagnosed document's figures and parameters, from the columns of ``diagnose.diagnose``."""
    text = {n: F.col(n).cast("string") for n in ("n_words", "text_chars", "n_headings", "n_separators", "avg_section_len", "short_line_ratio", "max_chars", "overlap", "min_chunk_size")}
    why = {n: F.coalesce(F.concat(text[n], F.lit(" → "), F.try_element_at("justification", F.lit(n))), text[n]) for n in ("max_chars", "overlap", "min_chunk_size")}
    fields = [("tipo", F.col("project_type")), ("entidades", F.col("entity_len")), ("palabras", text["n_words"]), ("caracteres", text["text_chars"]), ("títulos", text["n_headings"]), ("separadores", text["n_separators"]), ("sección media", text["avg_section_len"]), ("líneas cortas", text["short_line_ratio"]), *why.items()]
    return _card(F.concat(F.lit("[diagnóstico] "), F.col(name)), fields)


def decision_card(name: str = "file_name") -> Column:
    """SNK8: the strategy of a document, why, and its warnings, from the columns of ``diagnose.decide``."""
    head = _card(F.concat(F.lit("[estrategia] "), F.col(name)), [("estrategia", F.col("strategy")), ("razón", F.col("reason")), ("coherencia", F.when(F.col("coherence_ok"), "OK").otherwise("REVISAR"))])
    return F.concat(head, F.array_join(F.transform("warnings", lambda w: F.concat(F.lit("\n  ⚠ "), w)), ""))


def checklist_card(name: str = "file_name") -> Column:
    """SNK8: the state of a checked document and its issues, from the columns of ``validate.validate``."""
    found = F.when(F.size("issues") == 0, F.lit("\n  ✓ sin incidencias")).otherwise(F.array_join(F.transform("issues", lambda i: F.concat(F.when(i.startswith("fail:"), "\n  ✗ ").otherwise("\n  ⚠ "), F.regexp_replace(i, r"\A\w+:", ""))), ""))
    return F.concat(_card(F.concat(F.lit("[control] "), F.col(name), F.lit(" → "), F.col("state")), []), found)


def _says(catalogue: dict[str, str], caveat: Column) -> Column:
    text = F.try_element_at(F.create_map(*(F.lit(x) for kv in catalogue.items() for x in kv)), caveat) if catalogue else F.lit("")
    return F.concat(F.lit("["), caveat, F.lit("] "), F.coalesce(text, F.lit("")))


def delivery_text(name: str = "file_name", gaps: Column | None = None, caveats: Column | None = None, catalogue: dict[str, str] | None = None) -> Column:
    """SNK5: the report on a delivered document, from the columns of ``plans.stages.build``; what it lacks and the caveats it shows come last, if there are any."""
    parts = {
        "ESTRATEGIA": (("Estrategia", F.col("strategy")), ("Razón", F.col("reason"))),
        "FRAGMENTOS": tuple((n, F.col(n).cast("string")) for n in ("max_chars", "overlap", "min_chunk_size")),
        "RECUPERACIÓN": (
            ("Tipo", F.col("project_type")), ("Top-K", F.col("top_k").cast("string")), ("Tokens totales", F.col("tokens_total").cast("string")), ("Tokens por fragmento", F.col("tokens_chunk").cast("string")),
            ("Umbral", F.format_string("%.2f", F.col("threshold").cast("double"))), ("Mensajes de contexto", F.col("context_messages").cast("string")),
        ),
        "VALIDACIÓN": (("Estado", F.col("status")), ("Incidencias", F.col("n_issues").cast("string"))),
        "CONSUMO": (("Tokens de entrada", F.col("tokens_in").cast("string")), ("Tokens de salida", F.col("tokens_out").cast("string")), ("Coste", F.format_string("%.5f", F.col("cost").cast("double")))),
    }
    lines = [x for head, values in parts.items() for x in (F.lit(f"\n\n{head}"), *(F.concat(F.lit(f"\n  {k}: "), F.coalesce(v, F.lit("-"))) for k, v in values))]
    if gaps is not None:
        lines.append(F.when(F.coalesce(gaps, F.lit("")) != "", F.concat(F.lit("\n\nLAGUNAS\n"), gaps)).otherwise(""))
    if caveats is not None:
        found = F.coalesce(caveats, F.array().cast("array<string>"))
        said = F.array_join(F.transform(found, lambda c: F.concat(F.lit("\n  - "), _says(catalogue or {}, c))), "")
        lines.append(F.when(F.size(found) > 0, F.concat(F.format_string("\n\nADVERTENCIAS (%d)", F.size(found)), said)).otherwise(""))
    return F.concat(F.lit("INFORME DE ENTREGA: "), F.col(name), *lines)


def delivery_report(rows: DataFrame, catalogue: dict[str, str] | None = None) -> DataFrame:
    """SNK5: a text for each delivered document."""
    return rows.select("file_name", delivery_text("file_name", F.col("gaps"), F.col("caveat_ids"), catalogue).alias("report"))


def global_report(rows: DataFrame, catalogue: dict[str, str]) -> DataFrame:
    """SNK6: section, file_name, pos, line of the report on a whole run; ``ordered`` puts them in order.

    rows: file_name, file_final, status, strategy, cost, tokens_in, tokens_out, error,
    caveat_ids, gaps. catalogue: what each caveat says. Sections: 1 the table (files that
    failed show their error), 2 totals without those, 3 caveats by file, 4 gaps by file.
    """
    failed = F.col("status") == "ERROR"
    n = F.size(F.coalesce("caveat_ids", F.array()))
    line = _row([F.col("file_name"), F.coalesce("file_final", F.lit("")), F.col("status"), F.coalesce("strategy", F.lit("")), n.cast("string")], GLOBAL_WIDTHS, F.format_string(" %.5f", F.coalesce(F.col("cost").cast("double"), F.lit(0.0))))
    error = F.concat(cell(F.col("file_name"), -25), F.lit(" ERROR: "), F.coalesce("error", F.lit("")))
    table = rows.select(F.lit(1).alias("section"), "file_name", F.lit(0).alias("pos"), F.when(failed, error).otherwise(line).alias("line"))
    sums = [F.coalesce(F.sum(F.when(~failed, F.col(c))), F.lit(0)) for c in ("tokens_in", "tokens_out", "cost")]
    total = rows.agg(F.concat(F.lit("TOTAL: "), F.count("*").cast("string"), F.lit(" archivos, tokens "), sums[0].cast("string"), F.lit(" + "), sums[1].cast("string"), F.format_string(", coste %.4f", sums[2].cast("double"))).alias("line"))
    total = total.select(F.lit(2).alias("section"), F.lit("").alias("file_name"), F.lit(0).alias("pos"), "line")
    shown = rows.where(~failed).select("file_name", "gaps", F.posexplode_outer("caveat_ids").alias("pos", "id"))
    caveats = shown.where("id IS NOT NULL").select(F.lit(3).alias("section"), "file_name", "pos", _says(catalogue, F.col("id")).alias("line"))
    gaps = rows.where(~failed & (F.col("gaps") != "")).select(F.lit(4).alias("section"), "file_name", F.posexplode(F.split("gaps", "\n")).alias("pos", "line"))
    return table.unionByName(total).unionByName(caveats).unionByName(gaps)
