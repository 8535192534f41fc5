"""The checklist of a rewritten document: booleans, issues and an overall state, all within the document's row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import HOUSE, House
from ..functions.text import contains_any, lines, strip
from .clean import FENCE, unwrap_fence
from .gates import prohibited

TABLES = r"(?md)(?:^\|[^\n]*\|\n)++"


def table_rows(c: Column) -> Column:
    """TBL4: data rows (lines less two) of each run of table lines that end in a line feed."""
    return F.transform(F.regexp_extract_all(c, F.lit(TABLES), F.lit(0)), lambda t: (F.regexp_count(t, F.lit("\n")) - 2).cast("long"))


def prose_blocks(c: Column) -> Column:
    """VAL11: runs of three and more lines of prose, blank lines left out. The lines are mapped to one letter each, then counted."""
    body = F.filter(F.transform(lines(c), strip), lambda s: s != "")
    marks = F.array_join(F.transform(body, lambda s: F.when(s.rlike(r"\A(?:[#\-*|>]|\d+\.)"), "s").otherwise("p")), "")
    return F.regexp_count(marks, F.lit("p{3,}+")).cast("long")


def checks(c: Column, max_chars: Column, coherent: Column, strict: bool = False, house: House = HOUSE) -> dict[str, tuple[Column, str]]:
    """Name -> (whether it holds, severity: fail, warn or note)."""
    h2, seps = F.regexp_count(c, F.lit("(?md)^## ")), F.regexp_count(c, F.lit("\n---\n"))
    rows = table_rows(c)
    out = {
        "has_h1": (c.rlike("(?md)^# "), "fail"),
        "independent_sections": (h2 + seps >= 2, "warn"),
        "no_h4": (F.regexp_count(c, F.lit("(?md)^#### ")) == 0, "warn"),
        "sections_fit": (~F.exists(F.split(c, "\n## ", -1), lambda s: F.length(s) > max_chars), "warn"),
        "no_long_tables": (~F.exists(rows, lambda n: n > 8), "warn"),
        "has_technical_data": (c.rlike(r"(?iU)##\s+Datos t[ée]cnicos"), "note"),
        "size_ok": (F.octet_length(c) / 1024 < 100, "warn"),
        "coherent": (coherent, "warn"),
    }
    if strict:
        out |= {
            "no_very_long_tables": (~F.exists(rows, lambda n: n > 20), "fail"),
            "no_prose": (prose_blocks(c) == 0, "warn"),
            "no_period_block": (~contains_any(c, ["**Vigencia/Período:**", "**Vigencia/Periodo:**"]), "fail"),
            "no_process_notes": (~(contains_any(c, [f"Referencia interna: {house.brand}", "Metodología: Extracción"]) | contains_any(F.lower(c), ["reescritura de texto bruto"])), "fail"),
            "names_house": (F.contains(c, F.lit(f"· {house.brand} ·")), "warn"),
            "has_specialist_section": (c.rlike(r"(?iU)##\s+datos\s+t[eé]cnicos\s+para\s+investigadores"), "warn"),
        }
    return out


def validate(docs: DataFrame, text: str = "text", strict: bool = False, house: House = HOUSE) -> DataFrame:
    """PIP8: docs (with max_chars and coherence_ok) and checks (map), issues (array of sev:name), n_fail, n_warn, state."""
    raw = strip(F.col(text))
    fenced = raw.startswith(FENCE)
    docs = docs.withColumn("_clean", unwrap_fence(F.col(text)))
    c = F.col("_clean")
    found = checks(c, F.col("max_chars"), F.col("coherence_ok"), strict, house)
    issues = [F.when(fenced, "warn:fenced"), *(F.when(~ok, f"{sev}:{name}") for name, (ok, sev) in found.items() if sev != "note")]
    listed = F.concat(F.array_compact(F.array(*issues)), F.transform(prohibited(c), lambda p: F.concat(F.lit("warn:prohibited_"), p)))
    out = docs.withColumns({"checks": F.create_map(*(x for name, (ok, _) in found.items() for x in (F.lit(name), ok))), "issues": listed}).drop("_clean")
    fails = F.size(F.filter("issues", lambda i: i.startswith("fail:"))).cast("long")
    warns = F.size(F.filter("issues", lambda i: i.startswith("warn:"))).cast("long")
    return out.withColumns({"n_fail": fails, "n_warn": warns, "state": F.when(fails > 0, "ERROR").when(warns > 2, "REVISAR").otherwise("OK")})
