"""Queries over the given tables, one for each operator, with the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import config, corpora
from .corpora import checked, table
from .functions import text as T
from .operators import chunk, clean, deliver, diagnose, gates, headers, patterns, report, state, tables, validate
from .plans import stages
from .sources import connectors
from .streaming import assembly

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
NL = "chr(10)"


def add(name: str, query: Query, oracle: str | None = None) -> None:
    QUERIES[name] = query
    if oracle:
        ORACLES[name] = oracle


def _strip(t: str) -> str:
    return rf"regexp_replace({t}, '^\s+|\s+$', '', 'g')"


def _re(t: str, pattern: str, to: str = "", flags: str = "g") -> str:
    return f"regexp_replace({t}, '{pattern}', '{to}', '{flags}')"


def _words(t: str) -> str:
    return rf"list_filter(string_split_regex({t}, '\s+'), lambda w: w <> '')"


def _occ(t: str, w: str) -> str:
    return f"((length({t}) - length(replace({t}, '{w}', ''))) // {len(w)})"


def _sum(xs) -> str:
    return "(" + " + ".join(xs) + ")"


def _texts(name: str, step: Callable[[Column], Column], sql: str, corpus: str = "noisy") -> None:
    """A string -> string step over a derived corpus; ``sql`` has the text as ``t``."""
    source = getattr(corpora, corpus)
    add(name, lambda s, d: source(s, d).select("doc_id", step(F.col("text")).alias("text")), f"WITH d AS (SELECT doc_id, text AS t FROM ({checked(corpus)}) x) SELECT doc_id, {sql} AS text FROM d")


# --- cleaning -------------------------------------------------------------------------------------------------------

O_STEPS: dict[str, str] = {
    "cln1": _re("t", r"(?is)\n#+\s*\*{0,2}\s*(?:Referencias|Bibliografía|Fuentes|Notas y referencias)\s*\*{0,2}.*", "", ""),
    "cln3": _re("t", r"(?m)^[^\n]+?(?:\.{2,}|(?:\. ){3,}\.?)\s*\d+\s*$"),
    "cln5": _re("t", r"!\[[^\n]*?\]\([^\n]*?\)"),
    "cln6": _re("t", r"(?i)\*\*==>[^\n]*?intentionally omitted[^\n]*?<==\*\*"),
    "cln7": _re("t", r"(?im)^Figura\s+\d+[\.:][^\n]*$"),
    "cln8": _re("t", r"(?m)^>\s*\d+\s+[^\n]+$"),
    "cln9": _re("t", r"(?im)^\d{1,2}(?:También|Además|Para|Véase|Ver |Cf\.|Ibid|Op\. ?cit|Referido|Nota)\b[^\n]+$"),
    "cln10": "list_reduce(list_filter(regexp_extract_all(t, '\\([^)]{80,}\\)'), lambda x: length(x) - length(replace(x, ';', '')) >= 2), lambda a, x: replace(a, x, ''), t)",
    "cln11": _re("t", r"([\p{L}\p{N}_]+)-\n([\p{L}\p{N}_]+)", r"\1\2"),
    "cln12": _re("t", r"(?m)^\s*\d+\s*$"),
    "cln13": _strip(_re("t", r"\n{3,}", "\n\n")),
}
for _name, _step in (
    ("cln1_bibliography", clean.bibliography), ("cln3_dot_leaders", clean.dot_leaders), ("cln5_images", clean.images), ("cln6_omitted", clean.omitted), ("cln7_captions", clean.captions),
    ("cln8_quoted_notes", clean.quoted_notes), ("cln9_plain_notes", clean.plain_notes), ("cln10_long_citations", clean.long_citations), ("cln11_dehyphenate", clean.dehyphenate),
    ("cln12_number_lines", clean.number_lines), ("cln13_collapse", clean.collapse),
):
    _texts(_name, _step, O_STEPS[_name.split("_")[0]])

_INDEX = r"(?im)#{1,3}\s*\*{0,2}\s*(?:[ÍI]NDICE|Sumario|Contenido|Tabla de contenidos?|Table of contents?)\s*\*{0,2}\s*$"
add(
    "cln2_index_block",
    lambda s, d: corpora.noisy(s, d).select("doc_id", clean.index_block(F.col("text")).alias("text")),
    rf"""
    WITH a AS (SELECT doc_id, text AS t, regexp_extract(text, '{_INDEX}') AS m FROM ({checked("noisy")}) x),
    b AS (SELECT *, instr(t, m) AS p0, substr(t, instr(t, m) + length(m)) AS rest FROM a),
    c AS (SELECT *, regexp_extract(rest, '(?m)^#{{1,3}}\s') AS h FROM b)
    SELECT doc_id, CASE WHEN m = '' THEN t ELSE substr(t, 1, p0 - 1) || {NL} || CASE WHEN h = '' THEN '' ELSE substr(rest, instr({NL} || rest, {NL} || h)) END END AS text FROM c""",
)

_LINES = f"SELECT doc_id, generate_subscripts(string_split(t, {NL}), 1) AS pos, unnest(string_split(t, {NL})) AS line FROM d"
add(
    "cln4_index_tables",
    lambda s, d: corpora.noisy(s, d).select("doc_id", clean.index_tables(F.col("text")).alias("text")),
    rf"""
    WITH d AS (SELECT doc_id, text AS t FROM ({checked("noisy")}) x), l AS ({_LINES}),
    i AS (SELECT *, starts_with(line, '|') AS is_table, pos - row_number() OVER (PARTITION BY doc_id, starts_with(line, '|') ORDER BY pos) AS island FROM l),
    g AS (SELECT doc_id, island, count(*) FILTER (NOT regexp_matches(line, '^\|[-: |]+\|$')) AS n, count(*) FILTER (NOT regexp_matches(line, '^\|[-: |]+\|$') AND regexp_matches(line, '\.{{3,}}|(?:\. ){{3,}}')) AS dots
          FROM i WHERE is_table GROUP BY 1, 2)
    SELECT d.doc_id, coalesce(k.text, '') AS text FROM d LEFT JOIN (
      SELECT i.doc_id, string_agg(line, {NL} ORDER BY pos) AS text FROM i LEFT JOIN g ON i.is_table AND g.doc_id = i.doc_id AND g.island = i.island
      WHERE g.doc_id IS NULL OR dots / greatest(n, 1) <= 0.3 GROUP BY 1) k USING (doc_id)""",
)
_CTE = rf"""c0 AS (SELECT doc_id, {O_STEPS["cln1"]} AS t FROM (SELECT doc_id, text AS t FROM ({checked("noisy")}) x) y),
    c1 AS (SELECT *, regexp_extract(t, '{_INDEX}') AS m FROM c0), c2 AS (SELECT *, instr(t, m) AS p0, substr(t, instr(t, m) + length(m)) AS rest FROM c1),
    c3 AS (SELECT *, regexp_extract(rest, '(?m)^#{{1,3}}\s') AS h FROM c2),
    c4 AS (SELECT doc_id, CASE WHEN m = '' THEN t ELSE substr(t, 1, p0 - 1) || {NL} || CASE WHEN h = '' THEN '' ELSE substr(rest, instr({NL} || rest, {NL} || h)) END END AS t FROM c3),
    d AS (SELECT doc_id, {O_STEPS["cln3"]} AS t FROM c4), l AS ({_LINES}),
    i AS (SELECT *, starts_with(line, '|') AS is_table, pos - row_number() OVER (PARTITION BY doc_id, starts_with(line, '|') ORDER BY pos) AS island FROM l),
    g AS (SELECT doc_id, island, count(*) FILTER (NOT regexp_matches(line, '^\|[-: |]+\|$')) AS n, count(*) FILTER (NOT regexp_matches(line, '^\|[-: |]+\|$') AND regexp_matches(line, '\.{{3,}}|(?:\. ){{3,}}')) AS dots FROM i WHERE is_table GROUP BY 1, 2),
    c5 AS (SELECT i.doc_id, string_agg(line, {NL} ORDER BY pos) AS t FROM i LEFT JOIN g ON i.is_table AND g.doc_id = i.doc_id AND g.island = i.island WHERE g.doc_id IS NULL OR dots / greatest(n, 1) <= 0.3 GROUP BY 1),
    c6 AS (SELECT d.doc_id, coalesce(c5.t, '') AS t FROM d LEFT JOIN c5 USING (doc_id))"""


def _chain(t: str, *steps: str) -> str:
    """Steps of O_STEPS one after the other, as common table expressions s0, s1, ... from ``t``."""
    out = []
    for k, step in enumerate(steps):
        out.append(f"s{k} AS (SELECT doc_id, {O_STEPS[step]} AS t FROM {t if k == 0 else f's{k - 1}'})")
    return ", ".join(out)


_CLEAN_CTE = f"{_CTE}, {_chain('c6', 'cln5', 'cln6', 'cln7', 'cln8', 'cln9', 'cln10', 'cln11', 'cln12', 'cln13')}"
add("pip2_clean_markdown", lambda s, d: corpora.noisy(s, d).select("doc_id", clean.clean_markdown(F.col("text")).alias("text")), f"WITH {_CLEAN_CTE} SELECT doc_id, t AS text FROM s8")

_LIG = "replace(replace(replace(replace(replace(t, 'ﬁ', 'fi'), 'ﬂ', 'fl'), 'ﬀ', 'ff'), 'ﬃ', 'ffi'), 'ﬄ', 'ffl')"
_PAGE_OF, _SLASH = r"(?im)^[^\n]*P[áa]gina\s+\d+\s+de\s+\d+[^\n]*$", r"(?m)^\s*\d+\s*/\s*\d+\s*$"
_texts("pre1_ligatures", clean.ligatures, _LIG)
_texts("pre2_dehyphenate", clean.dehyphenate, O_STEPS["cln11"])
_texts("pre3_page_of", clean.page_of, _re("t", _PAGE_OF))
_texts("pre4_page_slash", clean.page_slash, _re("t", _SLASH))
_texts("pre5_number_lines", clean.number_lines, O_STEPS["cln12"])
_texts("pre7_blanks", clean.blanks, _re("t", r"[ \t]+", " "))
_texts("pre8_collapse", clean.collapse, O_STEPS["cln13"])
_REPEATED = f"""l AS ({_LINES}), r AS (SELECT *, {_strip("line")} AS s FROM l),
    n AS (SELECT *, CASE WHEN length(s) > 5 AND length(s) < 100 THEN count(*) OVER (PARTITION BY doc_id, s) ELSE 0 END AS n FROM r)"""
add(
    "pre6_repeated_lines",
    lambda s, d: corpora.noisy(s, d).select("doc_id", clean.repeated_lines(F.col("text")).alias("text"), clean.n_repeated_lines(F.col("text")).alias("n_removed")),
    f"""WITH d AS (SELECT doc_id, text AS t FROM ({checked("noisy")}) x), {_REPEATED}
    SELECT doc_id, coalesce(string_agg(line, {NL} ORDER BY pos) FILTER (n <= 3), '') AS text, count(*) FILTER (n > 3) AS n_removed FROM n GROUP BY 1""",
)
_BEFORE = _re(_re(_re(O_STEPS["cln11"].replace("replace(t,", f"replace({_LIG},", 1), _PAGE_OF), _SLASH), r"(?m)^\s*\d+\s*$")
add(
    "pip3_preclean",
    lambda s, d: corpora.noisy(s, d).select("doc_id", F.length("text").cast("long").alias("n0"), clean.preclean(F.col("text")).alias("p")).select("doc_id", "p.*"),
    f"""WITH o AS (SELECT doc_id, text AS t FROM ({checked("noisy")}) x), d AS (SELECT doc_id, length(t) AS n0, {_BEFORE} AS t FROM o), {_REPEATED},
    k AS (SELECT doc_id, coalesce(string_agg(line, {NL} ORDER BY pos) FILTER (n <= 3), '') AS t, count(*) FILTER (n > 3) AS repeated_lines_removed FROM n GROUP BY 1),
    e AS (SELECT doc_id, {O_STEPS["cln13"].replace("regexp_replace(t,", "regexp_replace(" + _re("t", r"[ \t]+", " ") + ",", 1)} AS text, repeated_lines_removed FROM k)
    SELECT doc_id, text, n0 - length(text) AS chars_removed, n0 AS chars_before, length(text) AS chars_after, repeated_lines_removed FROM e JOIN (SELECT doc_id, n0 FROM d) USING (doc_id)""",
)
_BIB = " OR ".join(f"starts_with(lower(s), '{h}')" for h in config.BIBLIOGRAPHY)
add(
    "str1_str2_strip_needless",
    lambda s, d: corpora.noisy(s, d).select("doc_id", clean.strip_needless(F.col("text")).alias("p")).select("doc_id", "p.*"),
    rf"""WITH d AS (SELECT doc_id, regexp_replace(text, '\n$', '') AS t FROM ({checked("noisy")}) x), l AS ({_LINES}), s AS (SELECT *, {_strip("line")} AS s FROM l),
    e AS (SELECT *, CASE WHEN {_BIB} THEN 1 WHEN regexp_matches(s, '^#{{1,2}}\s') THEN 0 END AS event FROM s),
    f AS (SELECT *, coalesce(last_value(event IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING), 0) AS bib, regexp_matches(s, '^!\[[^\n]*?\]\([^\n]*?\)') AS image FROM e)
    SELECT doc_id, coalesce(string_agg(line, {NL} ORDER BY pos) FILTER (bib = 0 AND NOT image), '') AS text, count(*) FILTER (bib = 0 AND image) AS images_removed,
           count(*) FILTER (bib = 1) AS biblio_lines_removed, 5 * count(*) FILTER (bib = 1 OR image) AS tokens_saved FROM f GROUP BY 1""",
)
_FENCE = r"CASE WHEN starts_with({s}, '```') THEN regexp_replace(regexp_replace({s}, '^```[\p{{L}}\p{{N}}_]*\n', ''), '\n```$', '') ELSE {s} END".format(s=_strip("t"))
_texts("fix1_unwrap_fence", clean.unwrap_fence, _FENCE, "answers")
_texts("fix2_drop_preamble", clean.drop_preamble, _re("t", r"(?i)^(?:Aquí tienes[^\n]*?\n+|A continuación[^\n]*?\n+)", "", ""), "answers")
_texts("pip9_fix_obvious", lambda c: clean.drop_preamble(clean.unwrap_fence(c)), _re(_FENCE, r"(?i)^(?:Aquí tienes[^\n]*?\n+|A continuación[^\n]*?\n+)", "", ""), "answers")
add(
    "gap1_split_gaps",
    lambda s, d: corpora.answers(s, d).select("doc_id", clean.split_gaps(F.col("text")).alias("p")).select("doc_id", "p.*"),
    rf"""WITH d AS (SELECT doc_id, text AS t, instr(lower(text), '## lagunas detectadas') AS p0 FROM ({checked("answers")}) x),
    b AS (SELECT *, {_strip("substr(t, 1, p0 - 1)")} AS head FROM d)
    SELECT doc_id, CASE WHEN p0 = 0 THEN t WHEN suffix(head, '---') THEN {_strip("substr(head, 1, length(head) - 3)")} ELSE head END AS text, CASE WHEN p0 = 0 THEN '' ELSE {_strip("substr(t, p0 + 22)")} END AS gaps FROM b""",
)
_texts("txt1_text_only", clean.text_only, _re("t", r"(?m)^\|[^\n]*\|$"))

# --- diagnosis ------------------------------------------------------------------------------------------------------

_HEAD = r"regexp_matches(line, '^#{1,3}\s')"
_SEP = f"{_strip('line')} = '---'"


def _structure(corpus: str) -> str:
    return rf"""d AS (SELECT doc_id, text AS t FROM ({checked(corpus)}) x), l AS ({_LINES}),
    f AS (SELECT *, {_HEAD} AS h, {_SEP} AS s, length({_strip("line")}) AS n FROM l),
    b AS (SELECT *, count(*) FILTER (h OR s) OVER (PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS k, count(*) FILTER (h OR s) OVER (PARTITION BY doc_id) AS m FROM f),
    g AS (SELECT doc_id, k, m, sum(length(line)) + count(*) - 1 AS n FROM b WHERE k >= 1 AND k < m GROUP BY 1, 2, 3),
    q AS (SELECT doc_id, CAST(sum(n) // count(*) AS BIGINT) AS avg_len FROM g GROUP BY 1),
    st AS (SELECT doc_id, count(*) FILTER (h) AS n_headings, count(*) FILTER (s) AS n_separators, round(count(*) FILTER (n > 0 AND n < 30) / count(*), 3) AS short_line_ratio FROM f GROUP BY 1),
    dia AS (SELECT d.doc_id, t, n_headings, n_separators, coalesce(avg_len, length(t)) AS avg_section_len, short_line_ratio FROM d JOIN st USING (doc_id) LEFT JOIN q USING (doc_id)),
    ty AS (SELECT *, {_sum(_occ("lower(t)", w) for w in config.KEYWORDS_OPERATIONAL)} AS op, {_sum(_occ("lower(t)", w) for w in config.KEYWORDS_CULTURAL)} AS cu, {_sum(_occ("lower(t)", w) for w in config.KEYWORDS_DEFINITIONS)} AS de FROM dia),
    ki AS (SELECT *, CASE WHEN op + cu + de = 0 THEN 'mixto' WHEN de / (op + cu + de) > 0.5 THEN 'definiciones' WHEN op / (op + cu + de) > 0.6 THEN 'operativo' WHEN cu / (op + cu + de) > 0.6 THEN 'cultural' ELSE 'mixto' END AS project_type,
           CASE WHEN avg_section_len < 400 THEN 'cortas' WHEN avg_section_len < 1000 THEN 'medias' WHEN avg_section_len < 2500 THEN 'largas' ELSE 'mixto' END AS entity_len FROM ty),
    base(kind, mc, ov, mi) AS (VALUES {", ".join(f"('{k}', {a}, {b}, {c})" for k, (a, b, c) in config.BASE_PARAMS.items())}),
    pa AS (SELECT ki.*, CAST(CASE WHEN entity_len = 'largas' AND project_type <> 'definiciones' THEN greatest(mc, 2000) WHEN project_type = 'cultural' AND entity_len = 'medias' THEN 1500 ELSE mc END AS BIGINT) AS max_chars,
           CAST(CASE WHEN entity_len = 'largas' AND project_type <> 'definiciones' THEN greatest(mc, 2000) // 10 WHEN project_type = 'cultural' AND entity_len = 'medias' THEN 150 ELSE ov END AS BIGINT) AS overlap, CAST(mi AS BIGINT) AS min_chunk_size FROM ki JOIN base ON kind = project_type),
    de AS (SELECT *, CASE WHEN short_line_ratio > 0.60 OR n_headings + n_separators < 3 OR avg_section_len >= 3 * max_chars THEN 'fixed' ELSE 'semantic' END AS strategy FROM pa)"""


def _diagnosed(corpus: str, *columns: str) -> Query:
    return lambda s, d: diagnose.decide(diagnose.diagnose(getattr(corpora, corpus)(s, d))).select("doc_id", *columns)


def _diagnosis(name: str, corpus: str, columns: list[str], more: str = "") -> None:
    add(name, _diagnosed(corpus, *columns), f"WITH {_structure(corpus)} SELECT doc_id, {', '.join(columns)} FROM de")


def _thin(diagnosed: DataFrame) -> DataFrame:
    """Half the overlap for every fourth document, as parameters set by hand may have it."""
    return diagnosed.withColumn("overlap", F.when(F.col("doc_id") % 4 == 3, F.floor(F.col("overlap") / 2)).otherwise(F.col("overlap")))


_diagnosis("dia1_dia4_structure", "sections", ["n_headings", "n_separators", "avg_section_len", "short_line_ratio"])
_diagnosis("dia3_short_lines", "noisy", ["short_line_ratio"])
_diagnosis("dia6_entity_length", "sections", ["entity_len"])
_diagnosis("dia7_parameters", "sections", ["project_type", "entity_len", "max_chars", "overlap", "min_chunk_size"])
_diagnosis("stg1_strategy", "sections", ["strategy"])
_diagnosis("cst3_dry_run", "noisy", ["strategy", "project_type", "entity_len"])
_diagnosis("dia8_provisional_strategy", "answers", ["strategy", "max_chars"])

_KINDS = f"SELECT doc_id, lang, concat(text, CASE doc_id % 5 WHEN 0 THEN ' horario tarifa precio acceso' WHEN 1 THEN ' siglo historia época cueva sala' WHEN 2 THEN ' definición concepto es decir' WHEN 3 THEN ' horario siglo concepto' ELSE '' END) AS text FROM {{docs}}"
add(
    "dia5_project_type",
    lambda s, d: s.sql(_KINDS, docs=table(s, d, "documents")).select("doc_id", diagnose.project_type(F.col("text")).alias("project_type")),
    f"WITH dia AS (SELECT doc_id, text AS t, 0 AS avg_section_len FROM ({_KINDS.replace('{docs}', 'documents')}) x), {_structure('documents').split('ty AS', 1)[1].join(['ty AS', '']).split(', base(kind', 1)[0].split('),' + chr(10) + '    base', 1)[0]}) SELECT doc_id, project_type FROM ki",
)
add(
    "stg2_warnings",
    lambda s, d: diagnose.decide(_thin(diagnose.diagnose(corpora.sections(s, d)))).select("doc_id", "coherence_ok", F.array_join("warnings", ",").alias("warnings")),
    f"""WITH {_structure("sections").replace("AS BIGINT) AS overlap", "AS BIGINT) // CASE WHEN doc_id % 4 = 3 THEN 2 ELSE 1 END AS overlap")} SELECT doc_id, NOT (strategy = 'fixed' AND overlap < max_chars * 0.10) AS coherence_ok,
        array_to_string(list_filter([CASE WHEN strategy = 'semantic' AND avg_section_len > max_chars THEN 'section_over_max' END, CASE WHEN strategy = 'semantic' AND n_separators = 0 THEN 'no_separators' END,
        CASE WHEN strategy = 'fixed' AND overlap < max_chars * 0.10 THEN 'thin_overlap' END], lambda x: x IS NOT NULL), ',') AS warnings FROM de""",
)
_ALL = ["n_words", "text_chars", "n_headings", "n_separators", "avg_section_len", "short_line_ratio", "project_type", "entity_len", "max_chars", "overlap", "min_chunk_size", "strategy"]
add(
    "pip4_diagnose_and_decide",
    lambda s, d: diagnose.decide(diagnose.diagnose(corpora.sections(s, d))).select("doc_id", *_ALL),
    f"WITH {_structure('sections')} SELECT doc_id, length(t) AS text_chars, len({_words('t')}) AS n_words, {', '.join(_ALL[2:])} FROM de",
)

# --- gates ----------------------------------------------------------------------------------------------------------

_W = r"regexp_extract_all({t}, '[\p{{L}}\p{{N}}_]+')"
add(
    "flt1_scanned",
    lambda s, d: gates.scanned(table(s, d, "conversations"), "conv_id", "text", 60),
    f"SELECT conv_id, CAST(sum(len({_W.format(t='text')})) AS BIGINT) AS n_words, count(*) AS n_pages, sum(len({_W.format(t='text')})) / count(*) < 60 AS scanned FROM conversations GROUP BY 1",
)
_MOJI = "(length(t) - length(replace(t, 'Ã', ''))) / greatest(length(t), 1)"
_OCR = rf"len(list_filter({_words('t')}, lambda w: contains(w, '~') OR regexp_matches(w, '[A-Za-záéíóúñ]{{2,}}\d|\d[A-Za-záéíóúñ]{{2,}}'))) / greatest(len({_words('t')}), 1)"
_RUN = "len(regexp_extract_all(t, '(?i)boletín del archivo'))"
_STEM = "concat('nota sobre ', source, ' ', substr(text, 1, 12))"
_BURIED = rf"(len({_words('t')}) > 500 AND len(list_filter(string_split_regex(lower(stem), '[^\p{{L}}\p{{N}}_]+'), lambda k: length(k) > 3)) > 0 AND len(list_filter(list_filter(string_split_regex(lower(stem), '[^\p{{L}}\p{{N}}_]+'), lambda k: length(k) > 3), lambda k: contains(lower(array_to_string({_words('t')}[1:500], ' ')), k))) = 0)"
_STEMS = f"SELECT doc_id, text AS t, concat('nota ', source) AS stem FROM ({checked('noisy')}) x"
add("flt2a_mojibake", lambda s, d: corpora.noisy(s, d).select("doc_id", (gates.mojibake_ratio(F.col("text")) > 0.003).alias("hit")), f"WITH d AS ({_STEMS}) SELECT doc_id, {_MOJI} > 0.003 AS hit FROM d")
add("flt2b_ocr_words", lambda s, d: corpora.noisy(s, d).select("doc_id", (gates.ocr_ratio(F.col("text")) > 0.01).alias("hit")), f"WITH d AS ({_STEMS}) SELECT doc_id, {_OCR} > 0.01 AS hit FROM d")
add("flt2c_running_headers", lambda s, d: corpora.noisy(s, d).select("doc_id", gates.running_headers(F.col("text"), config.HOUSE.running_header).alias("n")), f"WITH d AS ({_STEMS}) SELECT doc_id, {_RUN} AS n FROM d")
add(
    "flt2d_buried",
    lambda s, d: corpora.noisy(s, d).select("doc_id", gates.buried(F.col("text"), F.concat(F.lit("nota "), "source"), 500).alias("hit")),
    f"WITH d AS ({_STEMS}) SELECT doc_id, {_BURIED} AS hit FROM d",
)
add(
    "flt2_refine_reason",
    lambda s, d: corpora.noisy(s, d).select("doc_id", gates.refine_reason(F.col("text"), F.concat(F.lit("nota "), "source"), from_words=500).alias("reason")),
    f"WITH d AS ({_STEMS}) SELECT doc_id, CASE WHEN {_MOJI} > 0.003 THEN 'mojibake' WHEN {_OCR} > 0.01 THEN 'ocr' WHEN {_RUN} > 3 THEN 'headers' WHEN {_BURIED} THEN 'buried' ELSE 'limpio' END AS reason FROM d",
)
add("flt3_selection", lambda s, d: table(s, d, "documents").where(F.col("source").isin("src1", "src2")).select("doc_id", "source"), "SELECT doc_id, source FROM documents WHERE source IN ('src1', 'src2')")
_CUT = "CASE WHEN doc_id % 3 = 0 THEN substr(text, 1, greatest(length(text) - 7, 0)) WHEN doc_id % 50 = 1 THEN concat(text, '   ') ELSE text END"
add(
    "flt4_truncated",
    lambda s, d: table(s, d, "documents").select("doc_id", gates.truncated(F.expr(_CUT)).alias("truncated")),
    rf"SELECT doc_id, NOT regexp_matches(regexp_replace({_CUT}, '\s+$', ''), '[.!?#-]$') AS truncated FROM documents",
)
_STATE = "CASE CAST(doc_id % 5 AS INT) WHEN 0 THEN 'OK' WHEN 1 THEN 'CHUNKED' WHEN 2 THEN 'COPY' WHEN 3 THEN 'REVISAR' ELSE NULL END"
add("flt5_complete", lambda s, d: table(s, d, "documents").select("doc_id", gates.complete(F.expr(_STATE)).alias("done")), f"SELECT doc_id, coalesce({_STATE} IN ('OK', 'CHUNKED', 'COPY', 'SIN_CAMBIO'), false) AS done FROM documents")
_RATES = "SELECT o_orderkey AS id, CAST(o_custkey % 1200 AS BIGINT) AS md_words, CAST(o_orderkey % 1100 AS BIGINT) AS raw_words, o_orderstatus = 'F' AS ocr, CAST(o_custkey % 11 AS BIGINT) AS pages_ok, CAST(o_custkey % 11 + o_orderkey % 3 AS BIGINT) AS pages, CASE WHEN o_orderkey % 97 = 0 THEN 'x' END AS error FROM {orders}"


def _rates(s: SparkSession, d: str) -> DataFrame:
    rows = s.sql(_RATES, orders=table(s, d, "orders"))
    rows = rows.withColumn("coverage", F.round(gates.coverage(*map(F.col, ("ocr", "pages_ok", "pages", "md_words", "raw_words"))), 4))
    return rows.withColumns({"retry": gates.retry(F.col("md_words"), F.col("coverage"), F.col("raw_words")), "status": gates.rating(*map(F.col, ("ocr", "coverage", "md_words", "error")))})


_O_RATES = f"""r AS ({_RATES.replace("{orders}", "orders")}), c AS (SELECT *, round(CASE WHEN ocr THEN coalesce(pages_ok / nullif(pages, 0) * 100, 0) ELSE least(100, coalesce(md_words / nullif(raw_words, 0) * 100, 100)) END, 4) AS coverage FROM r),
    k AS (SELECT *, (md_words < 100 OR coverage < 10) AND raw_words > 500 AS retry, CASE WHEN error IS NOT NULL THEN 'ERROR' WHEN md_words = 0 THEN 'VACIO' WHEN ocr THEN CASE WHEN coverage >= 80 THEN 'OCR_OK' ELSE 'OCR_PARCIAL' END WHEN coverage >= 85 THEN 'OK' ELSE 'REVISAR' END AS status FROM c)"""
add("flt6_retry", lambda s, d: _rates(s, d).select("id", "retry"), f"WITH {_O_RATES} SELECT id, retry FROM k")
add("rte2_coverage", lambda s, d: _rates(s, d).select("id", "coverage"), f"WITH {_O_RATES} SELECT id, coverage FROM k")
add("rte3_status", lambda s, d: _rates(s, d).select("id", "status"), f"WITH {_O_RATES} SELECT id, status FROM k")
add(
    "rte1_route",
    lambda s, d: table(s, d, "orders").select("o_orderkey", gates.route(F.col("o_orderstatus") == "F", F.col("o_orderkey") % 2 == 0, F.col("o_orderkey") % 3 == 0).alias("method")),
    "SELECT o_orderkey, CASE WHEN o_orderstatus <> 'F' THEN 'native' WHEN o_orderkey % 2 = 0 THEN 'ocr_gemini' WHEN o_orderkey % 3 = 0 THEN 'ocr' ELSE 'native_fallback' END AS method FROM orders",
)
add(
    "ret1_retention",
    lambda s, d: table(s, d, "orders").select("o_orderkey", *(c.alias(n) for n, c in gates.retention(F.col("o_custkey"), F.col("o_orderkey") % 1500, F.col("o_orderkey") % 4).items())),
    """WITH r AS (SELECT o_orderkey, o_orderkey % 4 AS c, round((o_orderkey % 1500) / greatest(o_custkey, 1) * 100, 1) AS retention_pct FROM orders)
    SELECT o_orderkey, retention_pct, CASE WHEN c > 1 THEN 'CHUNKED' WHEN retention_pct < 30 THEN 'REVISAR' WHEN retention_pct > 98 THEN 'SIN_CAMBIO' ELSE 'OK' END AS status FROM r""",
)
_CAV = ", ".join("CASE WHEN " + " OR ".join(f"contains(lower(t), '{p}')" for p in ps) + f" THEN '{k}' END" for k, ps in config.HOUSE.caveats.items())
add(
    "flt7_caveats",
    lambda s, d: corpora.answers(s, d).select("doc_id", F.array_join(gates.caveats(F.col("text")), ",").alias("caveats")),
    f"WITH d AS (SELECT doc_id, text AS t FROM ({checked('answers')}) x) SELECT doc_id, array_to_string(list_filter([{_CAV}], lambda x: x IS NOT NULL), ',') AS caveats FROM d",
)
#: A pattern from each document, of a length and place of its own; three documents share an id.
_PATTERNS = "SELECT concat('c', CAST(floor(doc_id / 3) AS INT)) AS caveat_id, upper(substr(text, CAST(1 + doc_id % 50 AS INT), CAST(4 + doc_id % 17 AS INT))) AS pattern FROM {docs}"
add(
    "jn6_pattern_table",
    lambda s, d: patterns.caveats_from(corpora.spread(table(s, d, "documents")).select("doc_id", "text"), s.sql(_PATTERNS, docs=table(s, d, "documents"))).select("doc_id", F.array_join("caveat_ids", ",").alias("caveats")),
    f"""WITH p AS ({_PATTERNS.replace("{docs}", "documents")}), hit AS (SELECT DISTINCT doc_id, caveat_id FROM documents JOIN p ON contains(lower(text), lower(pattern)))
    SELECT doc_id, coalesce(string_agg(caveat_id, ',' ORDER BY caveat_id), '') AS caveats FROM documents LEFT JOIN hit USING (doc_id) GROUP BY doc_id""",
)
_HEADERS = f"""d AS (SELECT doc_id, source, text AS t FROM ({checked('noisy')}) x),
    f AS (SELECT DISTINCT source, doc_id, regexp_replace(lower({_strip("line")}), '[0-9]+', '#', 'g') AS header FROM (SELECT doc_id, source, unnest(string_split(t, {NL})) AS line FROM d) l),
    n AS (SELECT source, greatest(4, ceil(count(*) * 0.05::DOUBLE)) AS bound FROM d GROUP BY 1),
    h AS (SELECT source, header, count(*) AS n_files FROM f JOIN n USING (source) WHERE length(header) BETWEEN 6 AND 60 GROUP BY 1, 2 HAVING count(*) >= min(bound))"""
_texts("cln_misread_utf8", clean.misread_utf8, "replace(t, 'Ã±', 'ñ')")
add("flt2c_mined_headers", lambda s, d: headers.mined_headers(corpora.noisy(s, d), share=0.05), f"WITH {_HEADERS} SELECT source, header, n_files FROM h")
add(
    "cln_mined_headers",
    lambda s, d: headers.without_headers(corpora.noisy(s, d).select("doc_id", "source", "text"), headers.mined_headers(corpora.noisy(s, d), share=0.05)).select("doc_id", "text", "headers_removed"),
    f"""WITH {_HEADERS}, l AS (SELECT doc_id, source, generate_subscripts(string_split(t, {NL}), 1) AS pos, unnest(string_split(t, {NL})) AS line FROM d),
    k AS (SELECT l.*, h.header IS NOT NULL AS gone FROM l LEFT JOIN h ON h.source = l.source AND h.header = regexp_replace(lower({_strip("line")}), '[0-9]+', '#', 'g'))
    SELECT doc_id, coalesce(string_agg(line, {NL} ORDER BY pos) FILTER (NOT gone), '') AS text, count(*) FILTER (gone) AS headers_removed FROM k GROUP BY 1""",
)
_PRO = r"list_filter([CASE WHEN contains(t, '⚠️') OR contains(t, '🚫') THEN 'emoji' END, CASE WHEN regexp_matches(t, '\[(?:WEB|DOSSIER|FUENTE|REF)\]') THEN 'source_tag' END, CASE WHEN regexp_matches(t, '(?im)^(?:Aquí tienes|A continuación|Espero que)') THEN 'preamble' END], lambda x: x IS NOT NULL)"
add(
    "flt8_prohibited",
    lambda s, d: corpora.answers(s, d).select("doc_id", F.array_join(gates.prohibited(F.col("text")), ",").alias("kinds")),
    f"WITH d AS (SELECT doc_id, text AS t FROM ({checked('answers')}) x) SELECT doc_id, array_to_string({_PRO}, ',') AS kinds FROM d",
)
add("flt9_page_has_text", lambda s, d: table(s, d, "conversations").select("conv_id", "turn", gates.page_has_text(F.col("text")).alias("hit")), f"SELECT conv_id, turn, len({_W.format(t='text')}) >= 20 AS hit FROM conversations")

# --- chunking -------------------------------------------------------------------------------------------------------


def _rows(corpus: str, chunks: Callable[[Column], Column]) -> Query:
    return lambda s, d: chunk.chunk_rows(getattr(corpora, corpus)(s, d), chunks(F.col("text")))


def _unnested(chunks: str) -> str:
    return f"SELECT doc_id, CAST(len({chunks}) AS BIGINT) AS n_chunks, unnest({chunks}) AS chunk, CAST(generate_subscripts({chunks}, 1) - 1 AS BIGINT) AS chunk_idx FROM d"


_O_GREEDY = "list_reduce({l}, lambda a, f: CASE WHEN length(a[-1]) + length(f) + 2 <= {n} AND a[-1] <> '' THEN list_append(a[1:-2], a[-1] || chr(10) || chr(10) || f) WHEN a[-1] = '' THEN [f] ELSE list_append(a, f) END, [''])"
_PARAS = f"list_filter(string_split(t, {NL} || {NL}), lambda p: {_strip('p')} <> '')"
add("chk1_headings", _rows("chats", chunk.by_headings), rf"WITH d AS (SELECT doc_id, list_filter(string_split(regexp_replace(text, '(?m)^(#{{1,3}} )', chr(1) || '\1', 'g'), chr(1)), lambda p: {_strip('p')} <> '') AS c FROM ({checked('chats')}) x) {_unnested('c')}")
add("chk2_paragraphs", _rows("chats", chunk.by_paragraphs), f"WITH d AS (SELECT doc_id, {_PARAS.replace('t,', 'text,', 1)} AS c FROM ({checked('chats')}) x) {_unnested('c')}")
add(
    "chk3_greedy_pack",
    _rows("chats", lambda c: chunk.greedy(chunk.by_paragraphs(c), 600)),
    f"""WITH p AS (SELECT doc_id, generate_subscripts(l, 1) AS i, unnest(l) AS f FROM (SELECT doc_id, {_PARAS.replace("t,", "text,", 1)} AS l FROM ({checked("chats")}) x) y),
    r AS (SELECT doc_id, i, f, 0 AS dummy FROM p),
    w AS (WITH RECURSIVE z AS (SELECT doc_id, i, f, length(f) AS size, 0 AS g FROM r WHERE i = 1 UNION ALL
      SELECT r.doc_id, r.i, r.f, CASE WHEN z.size + length(r.f) + 2 <= 600 THEN z.size + length(r.f) + 2 ELSE length(r.f) END, CASE WHEN z.size + length(r.f) + 2 <= 600 THEN z.g ELSE z.g + 1 END FROM z JOIN r ON r.doc_id = z.doc_id AND r.i = z.i + 1) SELECT * FROM z)
    SELECT doc_id, CAST(g AS BIGINT) AS chunk_idx, string_agg(f, {NL} || {NL} ORDER BY i) AS chunk, max(max(g)) OVER (PARTITION BY doc_id) + 1 AS n_chunks FROM w GROUP BY doc_id, g""",
)
add("chk4_fixed", _rows("noisy", lambda c: chunk.fixed(c, 500)), f"WITH d AS (SELECT doc_id, list_transform(range(0, length(text), 500), lambda i: substr(text, i + 1, 500)) AS c FROM ({checked('noisy')}) x) {_unnested('c')}")
_TREE_PARAS = f"list_filter(string_split(g, {NL} || {NL}), lambda x: {_strip('x')} <> '')"
_TREE = f"""CASE WHEN length(t) <= 600 THEN [t] ELSE flatten(list_transform({_O_GREEDY.format(l="h", n=600)}, lambda g: CASE WHEN length(g) <= 600 THEN [g]
      ELSE flatten(list_transform({_O_GREEDY.format(l=_TREE_PARAS, n=600).replace("lambda a, f", "lambda b, e").replace("a[", "b[").replace("(a,", "(b,").replace("ELSE list_append(b, f)", "ELSE list_append(b, e)").replace("length(f)", "length(e)").replace("|| f)", "|| e)").replace("[f]", "[e]")},
        lambda p: CASE WHEN length(p) <= 600 THEN [p] ELSE list_transform(range(0, length(p), 500), lambda i: substr(p, i + 1, 500)) END)) END)) END"""
add(
    "chk5_tree",
    _rows("chats", lambda c: chunk.tree(c, 600, 500)),
    rf"""WITH k AS (SELECT doc_id, text AS t, list_filter(string_split(regexp_replace(text, '(?m)^(#{{1,3}} )', chr(1) || '\1', 'g'), chr(1)), lambda p: {_strip("p")} <> '') AS h FROM ({checked("chats")}) x),
    d AS (SELECT doc_id, {_TREE} AS c FROM k) {_unnested("c")}""",
)
_WIN = "CASE WHEN len(w) > 120 THEN list_transform(range(0, len(w), 90), lambda i: array_to_string(w[i + 1 : i + 100], ' ')) ELSE [t] END"
add("chk6_windows", _rows("noisy", lambda c: chunk.windows(c, 100, 10, 120)), f"WITH e AS (SELECT doc_id, text AS t, {_words('text')} AS w FROM ({checked('noisy')}) x), d AS (SELECT doc_id, {_WIN} AS c FROM e) {_unnested('c')}")
add(
    "chk7_reassemble",
    lambda s, d: chunk.reassemble(table(s, d, "conversations").select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("chunk_idx"), F.col("text").alias("chunk")), separator="\n\n---\n\n", drop_empty=True),
    f"SELECT conv_id AS doc_id, string_agg(text, {NL} || {NL} || '---' || {NL} || {NL} ORDER BY turn) AS text FROM conversations WHERE text <> '' GROUP BY 1",
)

# --- tables ---------------------------------------------------------------------------------------------------------


def _page_tables(s: SparkSession, d: str) -> DataFrame:
    cells = F.array(F.array("brand", F.lit("x")), F.array("p_name", F.col("p_size").cast("string")))
    return corpora.pages(s, d).select("file_name", "page_no", F.when(F.col("brand").isNotNull(), cells).alias("first_table"))


add(
    "tbl1_markdown",
    lambda s, d: corpora.pages(s, d).select("page_no", tables.to_markdown(F.array(F.array(F.lit("a"), F.lit(""), F.lit("a")), F.array(F.col("p_name"), F.col("p_type")), F.array(F.repeat("p_name", 12), F.lit(None).cast("string"), F.lit(" z ")))).alias("md")),
    f"""SELECT page_no, {NL} || '| a | Col_1 | a_1 |' || {NL} || '|---|---|---|' || {NL} || '| ' || p_name || ' | ' || p_type || ' |  |' || {NL} || '| ' ||
        CASE WHEN length({_strip("repeat(p_name, 12)")}) > 120 THEN substr({_strip("repeat(p_name, 12)")}, 1, 120) || '…' ELSE {_strip("repeat(p_name, 12)")} END || ' |  | z |' || {NL} AS md FROM ({checked("pages")}) x""",
)
add(
    "tbl2_merge_continued",
    lambda s, d: tables.merge_continued(_page_tables(s, d)).select("file_name", "page_no", F.array_join(F.transform("first_table", lambda r: F.array_join(r, ",")), ";").alias("cells")),
    f"""WITH p AS (SELECT file_name, page_no, brand, p_name || ',' || p_size AS own, row_number() OVER (PARTITION BY file_name ORDER BY page_no) AS i FROM ({checked("pages")}) x),
    b AS (SELECT *, CASE WHEN brand = lag(brand) OVER (PARTITION BY file_name ORDER BY i) THEN 0 ELSE 1 END AS new FROM p),
    r AS (SELECT *, sum(new) OVER (PARTITION BY file_name ORDER BY i) AS run FROM b),
    k AS (SELECT *, row_number() OVER w - 1 AS p0, count(*) OVER (PARTITION BY file_name, run) AS n, lead(own) OVER w AS next FROM r WINDOW w AS (PARTITION BY file_name, run ORDER BY i))
    SELECT file_name, page_no, CASE WHEN brand IS NULL OR p0 % 2 = 1 THEN NULL WHEN p0 + 1 < n THEN brand || ',x;' || own || ';' || next ELSE brand || ',x;' || own END AS cells FROM k""",
)
add("tbl3_page_tables", lambda s, d: tables.with_page_tables(corpora.pages(s, d).withColumn("text", F.col("p_name")), _page_tables(s, d)).select("file_name", "page_no", "text"),
    f"SELECT file_name, page_no, p_name || CASE WHEN brand IS NULL THEN '' ELSE {NL} || '| ' || brand || ' | x |' || {NL} || '|---|---|' || {NL} || '| ' || p_name || ' | ' || p_size || ' |' || {NL} END AS text FROM ({checked('pages')}) x")
_RUNS = rf"list_transform(regexp_extract_all(t, '(?m)(?:^\|[^\n]*\|\n)+'), lambda r: length(r) - length(replace(r, {NL}, '')) - 2)"
add("tbl4_table_rows", lambda s, d: corpora.answers(s, d).select("doc_id", F.array_join(F.transform(validate.table_rows(F.col("text")), lambda n: n.cast("string")), ",").alias("rows")), f"WITH d AS (SELECT doc_id, text AS t FROM ({checked('answers')}) x) SELECT doc_id, array_to_string({_RUNS}, ',') AS rows FROM d")

# --- validation -----------------------------------------------------------------------------------------------------

_PROSE = rf"len(regexp_extract_all(array_to_string(list_transform(list_filter(list_transform(string_split(t, {NL}), lambda l: {_strip('l')}), lambda l: l <> ''), lambda l: CASE WHEN regexp_matches(l, '^(?:[#*|>-]|\d+\.)') THEN 's' ELSE 'p' END), ''), 'p{{3,}}'))"
_VAL = {
    "has_h1": ("regexp_matches(t, '(?m)^# ')", "fail"),
    "independent_sections": (f"len(regexp_extract_all(t, '(?m)^## ')) + (length(t) - length(replace(t, {NL} || '---' || {NL}, ''))) // 5 >= 2", "warn"),
    "no_h4": ("NOT regexp_matches(t, '(?m)^#### ')", "warn"),
    "sections_fit": (f"len(list_filter(string_split(t, {NL} || '## '), lambda s: length(s) > 1200)) = 0", "warn"),
    "no_long_tables": (f"len(list_filter({_RUNS}, lambda n: n > 8)) = 0", "warn"),
    "has_technical_data": (r"regexp_matches(t, '(?i)##\s+Datos t[ée]cnicos')", "note"),
    "size_ok": ("strlen(t) / 1024 < 100", "warn"),
    "coherent": ("doc_id % 4 > 0", "warn"),
    "no_very_long_tables": (f"len(list_filter({_RUNS}, lambda n: n > 20)) = 0", "fail"),
    "no_prose": (f"{_PROSE} = 0", "warn"),
    "no_period_block": ("NOT (contains(t, '**Vigencia/Período:**') OR contains(t, '**Vigencia/Periodo:**'))", "fail"),
    "no_process_notes": ("NOT (contains(t, 'Referencia interna: Archivo') OR contains(t, 'Metodología: Extracción') OR contains(lower(t), 'reescritura de texto bruto'))", "fail"),
    "names_house": ("contains(t, '· Archivo ·')", "warn"),
    "has_specialist_section": (r"regexp_matches(t, '(?i)##\s+datos\s+t[eé]cnicos\s+para\s+investigadores')", "warn"),
}
_CLEANED = f"v AS (SELECT doc_id, text AS t FROM ({checked('answers')}) x), d AS (SELECT doc_id, starts_with({_strip('t')}, '```') AS fenced, {_FENCE} AS t FROM v)"


def _validated(s: SparkSession, d: str) -> DataFrame:
    return validate.validate(corpora.answers(s, d).withColumns({"max_chars": F.lit(1200), "coherence_ok": F.col("doc_id") % 4 > 0}), strict=True)


for _i, (_name, (_sql, _)) in enumerate(_VAL.items(), 1):
    add(f"val_{_name}", lambda s, d, n=_name: _validated(s, d).select("doc_id", F.col("checks")[n].alias("ok")), f"WITH {_CLEANED} SELECT doc_id, {_sql} AS ok FROM d")
_ISSUES = ", ".join(["CASE WHEN fenced THEN 'warn:fenced' END", *(f"CASE WHEN NOT ({q}) THEN '{sev}:{n}' END" for n, (q, sev) in _VAL.items() if sev != "note")])
add(
    "pip8_validate",
    lambda s, d: _validated(s, d).select("doc_id", F.array_join("issues", ",").alias("issues"), "n_fail", "n_warn", "state"),
    f"""WITH {_CLEANED}, i AS (SELECT doc_id, list_concat(list_filter([{_ISSUES}], lambda x: x IS NOT NULL), list_transform({_PRO}, lambda x: 'warn:prohibited_' || x)) AS l FROM d),
    n AS (SELECT doc_id, l, len(list_filter(l, lambda x: starts_with(x, 'fail:'))) AS n_fail, len(list_filter(l, lambda x: starts_with(x, 'warn:'))) AS n_warn FROM i)
    SELECT doc_id, array_to_string(l, ',') AS issues, n_fail, n_warn, CASE WHEN n_fail > 0 THEN 'ERROR' WHEN n_warn > 2 THEN 'REVISAR' ELSE 'OK' END AS state FROM n""",
)

# --- delivery -------------------------------------------------------------------------------------------------------

_FILE = "concat(CASE WHEN p_partkey % 3 = 0 THEN '07_' ELSE '' END, p_name, ' — ', p_type, CASE WHEN p_partkey % 4 = 0 THEN ' ñ!' ELSE '' END)"
add(
    "nam1_output_name",
    lambda s, d: table(s, d, "part").select("p_partkey", deliver.output_name(F.expr(_FILE), (F.col("p_partkey") % 120).cast("int")).alias("name")),
    rf"""SELECT p_partkey, lpad(CAST(p_partkey % 120 AS VARCHAR), CAST(greatest(2, length(CAST(p_partkey % 120 AS VARCHAR))) AS INTEGER), '0') || '_' || substr(lower(regexp_replace(regexp_replace(regexp_replace({_FILE}, '^\d+[_-]', ''), '[^a-zA-Z0-9]+', '_', 'g'), '^_+|_+$', '', 'g')), 1, 30) || '_sem_v1.md' AS name FROM part""",
)
_MODEL = "CASE CAST(o_orderkey % 4 AS INT) WHEN 0 THEN 'deepseek/deepseek-v4-flash' WHEN 1 THEN 'google/gemini-2.5-flash' WHEN 2 THEN 'anthropic/claude-sonnet-4.5' ELSE 'other' END"
_PRICED = ", ".join(f"('{m}', {a}, {b})" for m, (a, b) in config.PRICES.items())
add(
    "cst1_cost",
    lambda s, d: table(s, d, "orders").select("o_orderkey", F.round(deliver.cost(F.expr(_MODEL), F.col("o_custkey"), F.col("o_orderkey")), 9).alias("cost")),
    f"WITH p(model, a, b) AS (VALUES {_PRICED}) SELECT o_orderkey, round((o_custkey * coalesce(a, 1) + o_orderkey * coalesce(b, 5)) / 1000000, 9) AS cost FROM orders LEFT JOIN p ON model = {_MODEL}",
)
add(
    "cst2_estimate",
    lambda s, d: deliver.estimate(table(s, d, "documents"), 8000, "google/gemini-2.5-flash"),
    "SELECT count(*) AS n_docs, CAST(sum(length(text)) AS BIGINT) AS n_chars, CAST(sum(length(text)) // 4 AS BIGINT) AS tokens, CAST(sum(length(text)) // 4 AS BIGINT) AS tokens_stripped, round(((2000 * count(*) + sum(length(text)) // 4) * 0.10 + sum(length(text)) // 4 * 1.1 * 0.40) / 1000000, 6) AS estimated_cost FROM documents",
)
_KEPT_TEXTS = ORACLES["str1_str2_strip_needless"]
add(
    "cst2_stripped_estimate",
    lambda s, d: deliver.estimate(corpora.noisy(s, d), 8000, "google/gemini-2.5-flash", stripped=clean.strip_needless(F.col("text"))["text"]),
    f"""SELECT count(*) AS n_docs, CAST(sum(length(x.text)) AS BIGINT) AS n_chars, CAST(sum(length(x.text)) // 4 AS BIGINT) AS tokens, CAST(sum(length(y.text)) // 4 AS BIGINT) AS tokens_stripped,
           round(((2000 * count(*) + sum(length(x.text)) // 4) * 0.10 + sum(length(x.text)) // 4 * 1.1 * 0.40) / 1000000, 6) AS estimated_cost FROM ({checked("noisy")}) x JOIN ({_KEPT_TEXTS}) y USING (doc_id)""",
)
add("tok1_max_tokens", lambda s, d: table(s, d, "documents").select("doc_id", deliver.max_tokens(F.repeat("text", 5)).alias("n")), "SELECT doc_id, CAST(greatest(4000, least(32000, length(text) * 5 // 2)) AS BIGINT) AS n FROM documents")
_KIND = "CASE CAST(doc_id % 6 AS INT) WHEN 0 THEN 'operativo' WHEN 1 THEN 'cultural' WHEN 2 THEN 'mixto' WHEN 3 THEN 'definiciones' WHEN 4 THEN 'cultural-museo' ELSE 'otro' END"
_RET = ", ".join(f"('{k}', {', '.join(map(str, v))})" for k, v in config.RETRIEVAL_PARAMS.items())
add(
    "rtv1_retrieval",
    lambda s, d: table(s, d, "documents").select("doc_id", *(c.cast("double" if n == "threshold" else "long").alias(n) for n, c in deliver.retrieval(F.expr(_KIND)).items())),
    f"WITH p(kind, a, b, c, e, f) AS (VALUES {_RET}) SELECT doc_id, CAST(a AS BIGINT) AS top_k, CAST(b AS BIGINT) AS tokens_total, CAST(c AS BIGINT) AS tokens_chunk, CAST(e AS DOUBLE) AS threshold, CAST(f AS BIGINT) AS context_messages FROM documents JOIN p ON kind = CASE WHEN {_KIND} = 'otro' THEN 'mixto' ELSE {_KIND} END",
)
add(
    "prm2_refine_prompt",
    lambda s, d: table(s, d, "conversations").select("conv_id", "turn", deliver.refine_prompt(F.col("role"), (F.col("turn") + 1).cast("int"), F.lit(3), F.col("text")).alias("prompt")),
    f"SELECT conv_id, turn, 'Título: ' || role || ' (chunk ' || (turn + 1) || '/3)' || {NL} || {NL} || text AS prompt FROM conversations",
)
add("prm1_build_prompt", lambda s, d: diagnose.decide(diagnose.diagnose(table(s, d, "documents"))).select("doc_id", deliver.build_prompt(F.col("text"), F.lit("p"), F.lit("2026-01-01"), F.lit("1/1")).alias("prompt")),
    f"WITH {_structure('documents')} SELECT doc_id, 'PARÁMETROS CALCULADOS:' || {NL} || '- Proyecto: p' || {NL} || '- Fecha: 2026-01-01' || {NL} || '- Estrategia: ' || strategy || {NL} || '- max_chars: ' || max_chars || {NL} || '- overlap: ' || overlap || {NL} || '- min_chunk_size: ' || min_chunk_size || {NL} || '- Tipo proyecto: ' || project_type || {NL} || '- Longitud entidades: ' || entity_len || {NL} || '- Parte: 1/1' || {NL} || {NL} || 'TEXTO BRUTO:' || {NL} || repeat('─', 49) || {NL} || t || {NL} || repeat('─', 49) || {NL} AS prompt FROM de")

# --- joins, state, aggregates, reports ------------------------------------------------------------------------------

_FILES = "SELECT concat('f', CAST(o_orderkey AS VARCHAR(20)), '.pdf') AS file_name, o_orderdate AS mtime, CAST(o_custkey AS BIGINT) AS tokens_in, CAST(o_orderkey % 900 AS BIGINT) AS tokens_out, " + _STATE.replace("doc_id", "o_orderkey") + " AS file_status, o_orderkey AS k FROM {orders}"


def _files(s: SparkSession, d: str) -> DataFrame:
    return s.sql(_FILES, orders=table(s, d, "orders"))


_O_FILES = f"f AS ({_FILES.replace('{orders}', 'orders')})"
add(
    "jn1_lacking_output",
    lambda s, d: state.lacking(_files(s, d), _files(s, d).where("k % 3 = 0").select(F.regexp_replace("file_name", "pdf$", "md").alias("file_name"))).select("file_name"),
    f"WITH {_O_FILES} SELECT file_name FROM f WHERE k % 3 <> 0",
)
add("jn2_pending", lambda s, d: state.pending(_files(s, d).select("file_name"), _files(s, d)), f"WITH {_O_FILES} SELECT file_name FROM f WHERE NOT coalesce(file_status IN ('OK', 'CHUNKED', 'COPY', 'SIN_CAMBIO'), false)")


def _line_chunks(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "lineitem").select(F.col("l_orderkey").alias("file_name"), (F.col("l_linenumber") * F.lit(10**12) + F.col("l_partkey") * 10**5 + F.col("l_suppkey")).alias("chunk_idx"), F.col("l_partkey").alias("tokens_in"), F.col("l_suppkey").alias("tokens_out"), F.col("l_returnflag").alias("model"))


add(
    "jn3_saved_chunks",
    lambda s, d: state.with_saved(_line_chunks(s, d), _line_chunks(s, d).where("tokens_in % 2 = 0").groupBy("file_name", "chunk_idx").agg(F.max("tokens_out").alias("result"))).groupBy("file_name").agg(F.count("result").alias("n_saved"), F.count("*").alias("n")),
    "SELECT l_orderkey AS file_name, count(*) FILTER (l_partkey % 2 = 0) AS n_saved, count(*) AS n FROM lineitem GROUP BY 1",
)
add(
    "jn4_incremental",
    lambda s, d: state.incremental(_files(s, d).withColumn("out_name", F.col("file_name")), _files(s, d).where("k % 3 > 0").select(F.col("file_name").alias("out_name"), F.when(F.col("k") % 3 == 1, F.col("mtime") - F.expr("interval 1 day")).otherwise(F.col("mtime")).alias("mtime"))).select("file_name", "action"),
    f"WITH {_O_FILES} SELECT file_name, CASE k % 3 WHEN 0 THEN 'NEW' WHEN 1 THEN 'UPDATE' ELSE 'SKIP' END AS action FROM f",
)
_SRC = "SELECT concat('d', CAST(n_nationkey AS VARCHAR(9)), '.md') AS file_name, CAST(n_nationkey AS BIGINT) AS mtime FROM {nation}"
_OUT = "SELECT concat('0', CAST(s_suppkey % 9 AS VARCHAR(9)), '_d', CAST(s_suppkey AS VARCHAR(9)), '_v1.md') AS out_name, CAST(s_suppkey % 25 AS BIGINT) AS mtime FROM {supplier}"
add(
    "jn4_incremental_by_containment",
    lambda s, d: state.incremental_by_containment(s.sql(_SRC, nation=table(s, d, "nation")), s.sql(_OUT, supplier=table(s, d, "supplier"))).select("file_name", "matched", "action"),
    f"""WITH s AS ({_SRC.replace("{nation}", "nation")}), o AS ({_OUT.replace("{supplier}", "supplier")}),
    m AS (SELECT s.file_name, s.mtime, min(struct_pack(n := out_name, t := o.mtime)) AS hit FROM s LEFT JOIN o ON contains(out_name, regexp_replace(file_name, '\\.[^.]*$', '')) GROUP BY 1, 2)
    SELECT file_name, hit.n AS matched, CASE WHEN hit.n IS NULL THEN 'NEW' WHEN mtime > hit.t THEN 'UPDATE' ELSE 'SKIP' END AS action FROM m""",
)
add(
    "set1_upsert",
    lambda s, d: state.upsert(_files(s, d).select("file_name", "tokens_in"), _files(s, d).where("k % 4 = 0").select("file_name", (F.col("tokens_in") + 1).alias("tokens_in")), ["file_name"]),
    f"WITH {_O_FILES} SELECT file_name, CASE WHEN k % 4 = 0 THEN tokens_in + 1 ELSE tokens_in END AS tokens_in FROM f",
)
add("jn7_lookup_default", lambda s, d: table(s, d, "orders").select("o_orderkey", F.expr(_MODEL).alias("model")).withColumn("price_in", deliver.price(F.col("model"), 0).cast("double")),
    f"WITH p(m, a, b) AS (VALUES {_PRICED}) SELECT o_orderkey, {_MODEL} AS model, CAST(coalesce(a, 1) AS DOUBLE) AS price_in FROM orders LEFT JOIN p ON m = {_MODEL}")
add("ag1_count_words", lambda s, d: table(s, d, "documents").select("doc_id", T.count_words(F.col("text")).alias("n")), f"SELECT doc_id, len({_W.format(t='text')}) AS n FROM documents")
add("ag2_white_space_words", lambda s, d: table(s, d, "documents").select("doc_id", T.n_words(F.col("text")).alias("n")), f"SELECT doc_id, len({_words('text')}) AS n FROM documents")
add(
    "ag4_line_frequency",
    lambda s, d: corpora.noisy(s, d).select("doc_id", F.explode(T.lines(F.col("text"))).alias("line")).select("doc_id", T.strip(F.col("line")).alias("line")).where("length(line) > 5 AND length(line) < 100").groupBy("doc_id", "line").agg(F.count("*").alias("n")).where("n > 3"),
    f"WITH d AS (SELECT doc_id, text AS t FROM ({checked('noisy')}) x), {_REPEATED} SELECT doc_id, s AS line, count(*) AS n FROM r WHERE length(s) > 5 AND length(s) < 100 GROUP BY 1, 2 HAVING count(*) > 3",
)
add("ag5_coverage_summary", lambda s, d: report.coverage_summary(_rates(s, d)), f"WITH {_O_RATES} SELECT count(*) FILTER (status IN ('OK', 'OCR_OK')) AS n_ok, count(*) FILTER (status IN ('REVISAR', 'OCR_PARCIAL')) AS n_review, count(*) FILTER (status = 'ERROR') AS n_error, count(*) AS n_files FROM k")
add(
    "ag6_refine_summary",
    lambda s, d: report.refine_summary(_files(s, d).withColumnRenamed("file_status", "status")),
    f"WITH {_O_FILES} SELECT count(*) FILTER (file_status IN ('OK', 'CHUNKED', 'SIN_CAMBIO')) AS n_done, count(*) FILTER (file_status = 'COPY') AS n_copied, count(*) FILTER (file_status = 'REVISAR') AS n_review, count(*) FILTER (file_status = 'ERROR') AS n_error, CAST(sum(tokens_in) AS BIGINT) AS tokens_in, CAST(sum(tokens_out) AS BIGINT) AS tokens_out FROM f",
)
add(
    "ag7_build_totals",
    lambda s, d: report.build_totals(_files(s, d).withColumns({"error": F.when(F.col("k") % 50 == 0, "x"), "cost": F.col("tokens_in") / 1000})),
    f"WITH {_O_FILES} SELECT count(*) AS n_files, CAST(sum(tokens_in) FILTER (k % 50 <> 0) AS BIGINT) AS tokens_in, CAST(sum(tokens_out) FILTER (k % 50 <> 0) AS BIGINT) AS tokens_out, round(sum(tokens_in / 1000) FILTER (k % 50 <> 0), 6) AS cost FROM f",
)
add(
    "ag8_fold_tokens",
    lambda s, d: report.fold_tokens(_line_chunks(s, d)),
    "SELECT l_orderkey AS file_name, CAST(sum(l_partkey) AS BIGINT) AS tokens_in, CAST(sum(l_suppkey) AS BIGINT) AS tokens_out, arg_max(l_returnflag, l_linenumber * 1000000000000 + l_partkey * 100000 + l_suppkey) AS model, count(*) AS n_chunks FROM lineitem GROUP BY 1",
)
add("ag10_corpus_chars", lambda s, d: table(s, d, "documents").agg(F.floor(F.sum(F.length("text").cast("long")) / 4).cast("long").alias("tokens")), "SELECT CAST(sum(length(text)) // 4 AS BIGINT) AS tokens FROM documents")
_N = "CAST(id % 5000 AS BIGINT)"
add(
    "snk3_coverage_report",
    lambda s, d: report.coverage_lines(_rates(s, d).select(F.concat(F.lit("f"), F.col("id").cast("string")).alias("file_name"), F.when(F.col("ocr"), "ocr").otherwise("native").alias("method"), F.expr(_N).alias("raw_words"), F.expr(f"{_N} * 3").alias("md_words"), F.round("coverage", 0).alias("coverage"), "status")).drop("pos"),
    f"""WITH {_O_RATES}, b AS (SELECT 1 AS section, 'f' || id AS file_name, rpad('f' || id, 40, ' ') || ' ' || rpad(CASE WHEN ocr THEN 'ocr' ELSE 'native' END, 16, ' ') || ' ' || lpad(CAST({_N} AS VARCHAR), 8, ' ') || ' ' || lpad(CAST({_N} * 3 AS VARCHAR), 8, ' ')
        || ' ' || lpad(CAST(round(coverage, 0) AS INT) || '.0%', 7, ' ') || '  ' || status AS line FROM k)
    SELECT * FROM b UNION ALL SELECT 0, '', rpad('Archivo', 40, ' ') || ' ' || rpad('Metodo', 16, ' ') || '  Pal.PDF   Pal.MD       %  Estado'
    UNION ALL SELECT 2, '', 'Total: ' || count(*) || {" || ".join(f"' | {x}: ' || count(*) FILTER (status = '{x}')" for x in ("OK", "OCR_OK", "OCR_PARCIAL", "REVISAR", "ERROR"))} FROM k""",
)
add(
    "snk4_refine_report",
    lambda s, d: report.refine_lines(_files(s, d).withColumn("status", F.coalesce("file_status", F.lit("-")))),
    f"WITH {_O_FILES}, r AS (SELECT file_name, sum(tokens_in) AS i, sum(tokens_out) AS o, min(coalesce(file_status, '-')) AS s FROM f GROUP BY 1 UNION ALL SELECT 'TOTAL', sum(tokens_in), sum(tokens_out), '' FROM f) SELECT file_name, rpad(file_name, 42, ' ') || lpad(CAST(i AS VARCHAR), 12, ' ') || lpad(CAST(o AS VARCHAR), 12, ' ') || '  ' || s AS line FROM r",
)
add(
    "snk6_caveat_report",
    lambda s, d: report.caveat_counts(corpora.answers(s, d).select(F.col("doc_id").alias("file_name"), gates.caveats(F.col("text")).alias("caveat_ids"))),
    f"WITH d AS (SELECT doc_id, text AS t FROM ({checked('answers')}) x), c AS (SELECT doc_id, unnest(list_filter([{_CAV}], lambda x: x IS NOT NULL)) AS caveat_id FROM d) SELECT caveat_id, count(DISTINCT doc_id) AS n_files, min(doc_id) AS first_file FROM c GROUP BY 1",
)
add(
    "snk2_pass_through",
    lambda s, d: corpora.noisy(s, d).select("doc_id", F.when(gates.refine_reason(F.col("text"), F.lit("")) != "limpio", clean.clean_markdown(F.col("text"))).otherwise(F.col("text")).alias("text")),
    f"""WITH {_CLEAN_CTE}, o AS (SELECT doc_id, text AS t FROM ({checked("noisy")}) x)
    SELECT doc_id, CASE WHEN {_MOJI.replace('(t', '(o.t')} > 0.003 OR {_OCR.replace("(t", "(o.t")} > 0.01 OR {_RUN.replace("(t", "(o.t")} > 3 THEN s8.t ELSE o.t END AS text FROM o JOIN s8 USING (doc_id)""",
)
add(
    "win7_file_ordinal",
    lambda s, d: state.ordinals(state.pending(_files(s, d).select("file_name"), _files(s, d))),
    f"WITH {_O_FILES} SELECT file_name, row_number() OVER (ORDER BY file_name) AS i FROM f WHERE NOT coalesce(file_status IN ('OK', 'CHUNKED', 'COPY', 'SIN_CAMBIO'), false)",
)
_LACKS = "CASE WHEN doc_id % 4 = 1 THEN concat('- uno', chr(10), '- dos') ELSE '' END AS gaps; CASE WHEN doc_id % 3 = 0 THEN split('caveat_fluor,caveat_x', ',') WHEN doc_id % 3 = 1 THEN split('caveat_fluor', ',') END AS caveat_ids"
_MADE = "CAST(doc_id % 9 AS BIGINT) AS n_issues, CASE WHEN doc_id % 9 = 0 THEN 'OK' ELSE 'REVISAR' END AS status, CAST(doc_id % 7000 AS BIGINT) AS tokens_in, CAST(doc_id % 900 AS BIGINT) AS tokens_out, doc_id % 64 / 32 AS cost"
_REASON = "CASE WHEN short_line_ratio > 0.60 THEN 'short_line_ratio=' || short_line_ratio || ' > 0.60' WHEN n_headings + n_separators < 3 THEN n_headings || ' headings + ' || n_separators || ' separators' WHEN avg_section_len >= 3 * max_chars THEN 'avg_section_len=' || avg_section_len || ' >= 3 x max_chars=' || 3 * max_chars ELSE (n_headings + n_separators) || ' markers' END"
_FIELDS = (
    ("ESTRATEGIA", (("Estrategia", "strategy"), ("Razón", _REASON))), ("FRAGMENTOS", (("max_chars", "max_chars"), ("overlap", "overlap"), ("min_chunk_size", "min_chunk_size"))),
    ("RECUPERACIÓN", (("Tipo", "project_type"), ("Top-K", "a"), ("Tokens totales", "b"), ("Tokens por fragmento", "c"), ("Umbral", "printf('%.2f', e::DOUBLE)"), ("Mensajes de contexto", "f"))),
    ("VALIDACIÓN", (("Estado", "status"), ("Incidencias", "n_issues"))), ("CONSUMO", (("Tokens de entrada", "tokens_in"), ("Tokens de salida", "tokens_out"), ("Coste", "printf('%.5f', cost::DOUBLE)"))),
)
add(
    "snk5_delivery_report",
    lambda s, d: report.delivery_report(diagnose.decide(diagnose.diagnose(corpora.sections(s, d))).withColumn("file_name", F.col("doc_id").cast("string")).withColumns(deliver.retrieval(F.col("project_type"))).selectExpr("*", *_MADE.split(", "), *_LACKS.split("; ")), {"caveat_fluor": "flúor"}),
    f"""WITH {_structure("sections")}, p(kind, a, b, c, e, f) AS (VALUES {_RET}), made AS (SELECT *, {_MADE}, {_LACKS.replace(";", ",")} FROM de JOIN p ON p.kind = project_type)
    SELECT CAST(doc_id AS VARCHAR) AS file_name, 'INFORME DE ENTREGA: ' || doc_id || {" || ".join(f"{NL} || {NL} || '{h}'" + "".join(f" || {NL} || '  {k}: ' || {v}" for k, v in vs) for h, vs in _FIELDS)}
        || CASE WHEN gaps = '' THEN '' ELSE {NL} || {NL} || 'LAGUNAS' || {NL} || gaps END
        || CASE WHEN caveat_ids IS NULL THEN '' ELSE {NL} || {NL} || 'ADVERTENCIAS (' || len(caveat_ids) || ')' || array_to_string(list_transform(caveat_ids, lambda c: {NL} || '  - [' || c || '] ' || CASE WHEN c = 'caveat_fluor' THEN 'flúor' ELSE '' END), '') END AS report FROM made""",
)
_SAYS = {"caveat_fluor": "flúor", "caveat_atlantico": "travesía", "caveat_metadatos_bloque": "metadatos", "caveat_notas_proceso": "notas"}
_RUN_ROWS = "SELECT concat('d', CAST(doc_id AS VARCHAR(20)), '.md') AS file_name, concat('0_d', CAST(doc_id AS VARCHAR(20)), '_v1.md') AS file_final, CASE WHEN doc_id % 17 = 0 THEN 'ERROR' WHEN doc_id % 3 = 0 THEN 'REVISAR' ELSE 'OK' END AS status, CASE WHEN doc_id % 2 = 0 THEN 'fixed' ELSE 'semantic' END AS strategy, doc_id % 64 / 16 AS cost, CAST(doc_id % 7000 AS BIGINT) AS tokens_in, CAST(doc_id % 900 AS BIGINT) AS tokens_out, CASE WHEN doc_id % 17 = 0 THEN 'sin respuesta' END AS error"
add(
    "snk6_global_report",
    lambda s, d: report.global_report(s.sql(_RUN_ROWS + ", text FROM {docs}", docs=corpora.answers(s, d)).withColumns({"caveat_ids": gates.caveats(F.col("text")), "gaps": clean.split_gaps(F.col("text"))["gaps"]}), _SAYS),
    f"""WITH d AS (SELECT *, doc_id AS k, text AS t, instr(lower(text), '## lagunas detectadas') AS p0 FROM ({checked("answers")}) x), r AS ({_RUN_ROWS}, t, list_filter([{_CAV}], lambda x: x IS NOT NULL) AS ids, CASE WHEN p0 = 0 THEN '' ELSE {_strip("substr(t, p0 + 22)")} END AS gaps FROM d),
    c AS (SELECT file_name, generate_subscripts(ids, 1) - 1 AS pos, unnest(ids) AS id FROM r WHERE status <> 'ERROR'), g AS (SELECT file_name, generate_subscripts(string_split(gaps, {NL}), 1) - 1 AS pos, unnest(string_split(gaps, {NL})) AS line FROM r WHERE status <> 'ERROR' AND gaps <> '')
    SELECT 1 AS section, file_name, 0 AS pos, CASE WHEN status = 'ERROR' THEN rpad(file_name, CAST(greatest(25, length(file_name)) AS INT), ' ') || ' ERROR: ' || error ELSE rpad(file_name, CAST(greatest(25, length(file_name)) AS INT), ' ') || ' ' || rpad(file_final, CAST(greatest(35, length(file_final)) AS INT), ' ') || ' ' || rpad(status, 8, ' ') || ' ' || rpad(strategy, 10, ' ') || ' ' || rpad(CAST(len(ids) AS VARCHAR), 8, ' ') || printf(' %.5f', cost::DOUBLE) END AS line FROM r
    UNION ALL SELECT 2, '', 0, 'TOTAL: ' || count(*) || ' archivos, tokens ' || CAST(coalesce(sum(tokens_in) FILTER (status <> 'ERROR'), 0) AS BIGINT) || ' + ' || CAST(coalesce(sum(tokens_out) FILTER (status <> 'ERROR'), 0) AS BIGINT) || printf(', coste %.4f', coalesce(sum(cost) FILTER (status <> 'ERROR'), 0)::DOUBLE) FROM r
    UNION ALL SELECT 3, file_name, pos, '[' || id || '] ' || CASE id {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _SAYS.items())} ELSE '' END FROM c
    UNION ALL SELECT 4, file_name, pos, line FROM g""",
)


def _cards(s: SparkSession, d: str) -> DataFrame:
    made = _thin(diagnose.diagnose(corpora.answers(s, d)))
    return validate.validate(diagnose.decide(made), strict=True).withColumn("file_name", F.col("doc_id").cast("string"))


def _field(name: str, value: str) -> str:
    return f"{NL} || '{name:<16}' || {value}"


_CARD_PLAN = _structure("answers") + ", th AS (SELECT * EXCLUDE (overlap, strategy), CASE WHEN doc_id % 4 = 3 THEN overlap // 2 ELSE overlap END AS overlap, strategy FROM de), cd AS (SELECT *, strategy = 'fixed' AND overlap < max_chars * 0.10 AS thin FROM th)"
_LONG, _MEDIUM = "entity_len = 'largas' AND project_type <> 'definiciones'", "entity_len = 'medias' AND project_type = 'cultural'"
_WARNS = "list_filter([CASE WHEN strategy = 'semantic' AND avg_section_len > max_chars THEN 'section_over_max' END, CASE WHEN strategy = 'semantic' AND n_separators = 0 THEN 'no_separators' END, CASE WHEN thin THEN 'thin_overlap' END], lambda x: x IS NOT NULL)"
_CARD_ISSUES = _ISSUES.replace("length(s) > 1200", "length(s) > max_chars").replace("doc_id % 4 > 0", "NOT thin")
_RULE = f"{NL} || repeat('─', 53)"
add(
    "snk8_cards",
    lambda s, d: _cards(s, d).select("doc_id", report.diagnosis_card().alias("diagnosis"), report.decision_card().alias("decision"), report.checklist_card().alias("checklist")),
    f"""WITH {_CARD_PLAN}, vv AS (SELECT * EXCLUDE (t), starts_with({_strip("t")}, '```') AS fenced, {_FENCE} AS t, t AS raw FROM cd),
    ii AS (SELECT *, list_concat(list_filter([{_CARD_ISSUES}], lambda x: x IS NOT NULL), list_transform({_PRO}, lambda x: 'warn:prohibited_' || x)) AS iss FROM vv)
    SELECT doc_id, '[diagnóstico] ' || doc_id || {_RULE} || {" || ".join(_field(n, v) for n, v in (("tipo", "project_type"), ("entidades", "entity_len"), ("palabras", f"len({_words('raw')})"), ("caracteres", "length(raw)"), ("títulos", "n_headings"), ("separadores", "n_separators"), ("sección media", "avg_section_len"), ("líneas cortas", "CAST(short_line_ratio AS DOUBLE)"), ("max_chars", f"max_chars || ' → ' || CASE WHEN {_LONG} THEN 'largas' WHEN {_MEDIUM} THEN 'medias' ELSE 'base' END"), ("overlap", "overlap || ' → proporcional'"), ("min_chunk_size", "min_chunk_size || ' → proporcional'")))} AS diagnosis,
           '[estrategia] ' || doc_id || {_RULE} || {_field("estrategia", "strategy")} || {_field("razón", _REASON)} || {_field("coherencia", "CASE WHEN thin THEN 'REVISAR' ELSE 'OK' END")} || array_to_string(list_transform({_WARNS}, lambda w: {NL} || '  ⚠ ' || w), '') AS decision,
           '[control] ' || doc_id || ' → ' || CASE WHEN len(list_filter(iss, lambda x: starts_with(x, 'fail:'))) > 0 THEN 'ERROR' WHEN len(list_filter(iss, lambda x: starts_with(x, 'warn:'))) > 2 THEN 'REVISAR' ELSE 'OK' END || {_RULE}
             || CASE WHEN len(iss) = 0 THEN {NL} || '  ✓ sin incidencias' ELSE array_to_string(list_transform(iss, lambda x: {NL} || CASE WHEN starts_with(x, 'fail:') THEN '  ✗ ' ELSE '  ⚠ ' END || regexp_replace(x, '^[a-z]+:', '')), '') END AS checklist FROM ii""",
)

# --- whole stages with readers and backends that need no network ---------------------------------------------------------------------------

_PAGE_WORDS = f"list_sum(list_transform(string_split(whole, '. '), lambda p: CASE WHEN len({_W.format(t='p')}) >= 20 THEN 1 ELSE 0 END))"
_READ = "'# ' || regexp_replace(file_name, '[.][^.]*$', '') || chr(10) || chr(10) || list_reduce(list_transform(string_split(replace(whole, '. ', '.' || chr(12)), chr(12)), lambda p: regexp_replace(p, '^\\s+|\\s+$', '', 'g') || chr(10) || chr(10) || '---' || chr(10) || chr(10)), lambda a, b: a || b)"
_LAYER = "replace(string_split(content, chr(30))[2], chr(12), chr(10) || chr(10))"
_CONVERTED = f"""f AS (SELECT *, {_LAYER} AS native, len({_W.format(t="string_split(content, chr(30))[1]")}) AS layer_words, len(string_split(content, chr(30))[1]) AS n, len(string_split(string_split(content, chr(30))[1], chr(12))) AS layer_pages FROM ({checked("scans")}) y),
    m AS (SELECT *, layer_words / layer_pages < 30 AS scanned, len({_W.format(t="native")}) AS native_words FROM f),
    r AS (SELECT *, CASE WHEN scanned AND kind IN (2, 4) THEN 'ocr_tess_fallback' WHEN scanned THEN 'ocr_gemini'
          WHEN (native_words < 100 OR native_words * 100 < 10 * layer_words) AND layer_words > 500 THEN CASE WHEN kind IN (2, 4) THEN 'ocr_retry' ELSE 'ocr_gemini_retry' END ELSE 'native' END AS method FROM m),
    made AS (SELECT *, len(string_split(whole, '. ')) AS n_read, {_PAGE_WORDS} AS ok, CASE WHEN method = 'native' THEN native ELSE {_READ} END AS t FROM r),
    b AS (SELECT file_name AS doc_id, t AS text FROM made), {_CLEAN_CTE.replace(f"({checked('noisy')}) x", "b")}"""
add(
    "pip1_convert",
    lambda s, d: stages.convert(corpora.scans(s, d), corpora.layer(1), corpora.layer(0), vision=corpora.layer(2, "!"), local_ocr=corpora.layer(2)).drop("error"),
    f"""WITH {_CONVERTED},
    v AS (SELECT file_name, s8.t AS text, method, CAST(CASE WHEN method = 'native' THEN layer_words ELSE n_read END AS BIGINT) AS raw_words, CAST(len({_W.format(t="made.t")}) AS BIGINT) AS md_words,
          round(CASE WHEN method = 'native' THEN least(100.0::DOUBLE, CASE WHEN layer_words = 0 THEN 100 ELSE len({_W.format(t=_re("s8.t", "(?m)^[|][^" + chr(92) + "n]*[|]$"))}) / layer_words * 100 END) ELSE ok / n_read * 100 END, 1) AS coverage FROM made JOIN s8 ON s8.doc_id = file_name)
    SELECT *, CASE WHEN md_words = 0 THEN 'VACIO' WHEN method <> 'native' AND coverage >= 80 THEN 'OCR_OK' WHEN method <> 'native' THEN 'OCR_PARCIAL' WHEN coverage >= 85 THEN 'OK' ELSE 'REVISAR' END AS status FROM v""",
)
_WINDOWED = f"(SELECT doc_id, list_filter(string_split_regex(text, '\\s+'), lambda w: w <> '') AS w FROM documents) x"
add(
    "chk7_join_windows",
    lambda s, d: corpora.spread(table(s, d, "documents")).select("doc_id", chunk.windows(F.col("text"), 50, 12, 60).alias("parts")).select("doc_id", F.size("parts").cast("long").alias("n_parts"), F.array_join(T.words(chunk.join_windows(F.col("parts"), 12)), " ").alias("text")),
    f"SELECT doc_id, CASE WHEN len(w) > 60 THEN 1 + (len(w) - 1) // 38 ELSE 1 END AS n_parts, array_to_string(w, ' ') AS text FROM {_WINDOWED}",
)
add(
    "pip1_convert_by_page",
    lambda s, d: stages.convert_by_page(corpora.scans(s, d), corpora.work(s), corpora.layer(1), corpora.layer(0), vision=corpora.layer(2, "!"), local_ocr=corpora.layer(2)).drop("error"),
    ORACLES["pip1_convert"],
)
_PIP5_ROWS = corpora.checked("noisy")
add(
    "pip5_rewrite",
    lambda s, d: connectors.call_model(
        corpora.noisy(s, d).select("doc_id", deliver.refine_prompt(F.col("source"), (F.col("doc_id") % 5 + 1).cast("int"), F.lit(5), F.col("text")).alias("prompt"), deliver.max_tokens(F.col("text")).alias("max_tokens")), "", in_flight=4, attempts=3
    ).select("doc_id", "content", "tokens_in", "tokens_out"),
    rf"""WITH d AS (SELECT doc_id, text AS t, 'Título: ' || source || ' (chunk ' || (doc_id % 5 + 1) || '/5)' || {NL} || {NL} AS head FROM ({_PIP5_ROWS}) x),
    m AS (SELECT *, regexp_replace(regexp_replace(replace(t, 'Ã±', 'ñ'), '\[[0-9]+\]', '', 'g'), '(?m)^\s*[0-9]+\s*$\n?', '', 'g') AS made FROM d), n AS (SELECT *, {_strip("made")} AS y FROM m)
    SELECT doc_id, y || CASE WHEN regexp_matches(right(y, 1), '[.!?#-]') THEN '' ELSE '.' END AS content, length(head || t) // 4 AS tokens_in, length(made) // 4 AS tokens_out FROM n""",
)
_PIP6_STEMS = f"SELECT doc_id, source || '_' || doc_id AS stem, text AS t, {_words('text')} AS w FROM ({checked('noisy')}) x"
_PIP6_BURIED = "len(w) > 5000 AND length(stem) > 3 AND NOT contains(lower(array_to_string(w[1:500], ' ')), lower(stem))"
_PIP6_CUT = "CASE WHEN len(w) > 12000 THEN list_transform(range(0, len(w), 4850), lambda i: array_to_string(w[i + 1:i + 5000], ' ')) ELSE [t] END"
add(
    "pip6_refine",
    lambda s, d: stages.refine(corpora.noisy(s, d).select(F.concat("source", F.lit("_"), F.col("doc_id").cast("string"), F.lit(".md")).alias("file_name"), "text")).drop("model"),
    rf"""WITH d AS ({_PIP6_STEMS}), j AS (SELECT *, CASE WHEN {_MOJI} > 0.003 THEN 'mojibake' WHEN {_OCR} > 0.01 THEN 'ocr' WHEN {_RUN} > 3 THEN 'headers' WHEN {_PIP6_BURIED} THEN 'buried' ELSE 'limpio' END AS reason FROM d),
    c AS (SELECT *, {_PIP6_CUT} AS l FROM j WHERE reason <> 'limpio'),
    u AS (SELECT *, list_transform(l, lambda x: regexp_replace(regexp_replace(replace(x, 'Ã±', 'ñ'), '\[[0-9]+\]', '', 'g'), '(?m)^\s*[0-9]+\s*$\n?', '', 'g')) AS m,
          list_transform(l, lambda x, i: length('Título: ' || stem || CASE WHEN len(l) > 1 THEN ' (chunk ' || i || '/' || len(l) || ')' ELSE '' END || {NL} || {NL} || x) // 4) AS asked FROM c),
    o AS (SELECT *, array_to_string(list_transform(list_transform(m, lambda x: {_strip("x")}), lambda y: y || CASE WHEN regexp_matches(right(y, 1), '[.!?#-]') THEN '' ELSE '.' END), {NL} || {NL} || '---' || {NL} || {NL}) AS r FROM u),
    f AS (SELECT *, round(len({_words("r")}) / greatest(len(w), 1) * 100, 1) AS share FROM o)
    SELECT stem || '.md' AS file_name, t AS text, reason, 'COPY' AS status, 0 AS chunks, 0 AS tokens_in, 0 AS tokens_out, 100.0::DOUBLE AS retention_pct FROM j WHERE reason = 'limpio'
    UNION ALL SELECT stem || '.md', r, reason, CASE WHEN len(l) > 1 THEN 'CHUNKED' WHEN share < 30 THEN 'REVISAR' WHEN share > 98 THEN 'SIN_CAMBIO' ELSE 'OK' END, len(l), CAST(list_sum(asked) AS BIGINT), CAST(list_sum(list_transform(m, lambda x: length(x) // 4)) AS BIGINT), share FROM f""",
)


def _streamed(s: SparkSession, d: str) -> DataFrame:
    """Answers kept in parts, and the documents that a stream puts together from them, some files a batch."""
    docs, folder = corpora.noisy(s, d).select(F.concat("source", F.lit("_"), F.col("doc_id").cast("string"), F.lit(".md")).alias("file_name"), "text"), corpora.work(s)
    connectors.ask_missing(stages.refine_questions(docs)[1], f"{folder}/answers", "", retry_cut=False, steps=4, in_flight=4)
    assembly.write_assembled(assembly.assembled(assembly.watch_answers(s, f"{folder}/answers", 50)), f"{folder}/documents", f"{folder}/checkpoint").awaitTermination()
    return s.read.parquet(f"{folder}/documents").select("file_name", "text", "tokens_in", "tokens_out")


_PIP6_HEAD, _PIP6_TAIL = ORACLES["pip6_refine"].split("UNION ALL SELECT")[0], "SELECT stem || '.md' AS file_name, r AS text, CAST(list_sum(asked) AS BIGINT) AS tokens_in, CAST(list_sum(list_transform(m, lambda x: length(x) // 4)) AS BIGINT) AS tokens_out FROM f"
add("pip6_streamed", _streamed, _PIP6_HEAD[: _PIP6_HEAD.rindex("SELECT stem")] + _PIP6_TAIL)
_PIP7_PRE = ORACLES["pip3_preclean"].replace(f"({checked('noisy')}) x", f"({checked('answers')}) x")
_PIP7_STRIPPED = ORACLES["str1_str2_strip_needless"].replace(f"({checked('noisy')}) x", f"({_PIP7_PRE}) x")
_PIP7_PLAN = _structure("answers").replace(f"({checked('answers')}) x", f"({_PIP7_STRIPPED}) x")
_PIP7_HEADINGS = rf"list_filter(string_split(regexp_replace(t, '(?m)^(#{{1,3}} )', chr(1) || '\1', 'g'), chr(1)), lambda p: {_strip('p')} <> '')"
_PIP7_ASKED = f"""'PARÁMETROS CALCULADOS:' || {NL} || '- Proyecto: ' || {NL} || '- Fecha: 2026-01-01' || {NL} || '- Estrategia: ' || strategy || {NL} || '- max_chars: ' || max_chars || {NL} || '- overlap: ' || overlap || {NL} || '- min_chunk_size: ' || min_chunk_size
          || {NL} || '- Tipo proyecto: ' || project_type || {NL} || '- Longitud entidades: ' || entity_len || {NL} || CASE WHEN len(c) > 1 THEN '- Parte: ' || i || '/' || len(c) || {NL} ELSE '' END || {NL}"""
_PIP7_ISSUES = _ISSUES.replace("length(s) > 1200", "length(s) > max_chars").replace("doc_id % 4 > 0", "NOT (strategy = 'fixed' AND overlap < max_chars * 0.10)")
add(
    "pip7_build",
    lambda s, d: stages.build(corpora.answers(s, d).select(F.concat(F.lit("c"), F.col("doc_id").cast("string"), F.lit(".md")).alias("file_name"), "text"), date="2026-01-01").select(
        "file_name", "file_final", "text", "status", "strategy", "project_type", "max_chars", "tokens_in", "tokens_out", F.round("cost", 9).alias("cost"), "n_issues", "gaps", "top_k"
    ),
    rf"""WITH {_PIP7_PLAN}, h0 AS (SELECT *, {_PIP7_HEADINGS} AS h FROM de), c0 AS (SELECT *, {_TREE.replace("600", "60000").replace("500", "50000")} AS c FROM h0),
    a0 AS (SELECT *, list_transform(c, lambda x, i: 'TEXTO BRUTO:' || {NL} || repeat('─', 49) || {NL} || x || {NL} || repeat('─', 49) || {NL}) AS body, list_transform(c, lambda x, i: length({_PIP7_ASKED})) AS heads FROM c0),
    m0 AS (SELECT *, list_transform(body, lambda x: regexp_replace(regexp_replace(replace(x, 'Ã±', 'ñ'), '\[[0-9]+\]', '', 'g'), '(?m)^\s*[0-9]+\s*$\n?', '', 'g')) AS m, list_sum(list_transform(body, lambda x, i: (heads[i] + length(x)) // 4)) AS tokens_in FROM a0),
    o0 AS (SELECT * EXCLUDE (t), list_sum(list_transform(m, lambda x: length(x) // 4)) AS tokens_out, array_to_string(list_transform(list_transform(m, lambda x: {_strip("x")}), lambda y: y || CASE WHEN regexp_matches(right(y, 1), '[.!?#-]') THEN '' ELSE '.' END), {NL} || {NL}) AS t FROM m0),
    x0 AS (SELECT * EXCLUDE (t), regexp_replace({_FENCE}, '(?i)^(?:Aquí tienes[^\n]*?\n+|A continuación[^\n]*?\n+)', '') AS t FROM o0), y0 AS (SELECT *, starts_with({_strip("t")}, '```') AS fenced FROM x0),
    i0 AS (SELECT *, list_concat(list_filter([{_PIP7_ISSUES}], lambda x: x IS NOT NULL), list_transform({_PRO}, lambda x: 'warn:prohibited_' || x)) AS iss, instr(lower(t), '## lagunas detectadas') AS p0 FROM y0),
    b0 AS (SELECT *, {_strip("substr(t, 1, p0 - 1)")} AS head, len(list_filter(iss, lambda x: starts_with(x, 'fail:'))) AS n_fail, len(list_filter(iss, lambda x: starts_with(x, 'warn:'))) AS n_warn FROM i0), p(kind, a, b, c, e, f) AS (VALUES {_RET})
    SELECT 'c' || doc_id || '.md' AS file_name, printf('%02d_c', row_number() OVER (ORDER BY 'c' || doc_id || '.md')) || doc_id || '_sem_v1.md' AS file_final,
           CASE WHEN p0 = 0 THEN t WHEN suffix(head, '---') THEN {_strip("substr(head, 1, length(head) - 3)")} ELSE head END AS text, CASE WHEN p0 = 0 THEN '' ELSE {_strip("substr(t, p0 + 22)")} END AS gaps,
           CASE WHEN n_fail > 0 THEN 'ERROR' WHEN n_warn > 2 THEN 'REVISAR' ELSE 'OK' END AS status, strategy, project_type, max_chars, CAST(tokens_in AS BIGINT) AS tokens_in, CAST(tokens_out AS BIGINT) AS tokens_out,
           round((tokens_in + 5 * tokens_out) / 1000000::DOUBLE, 9) AS cost, len(iss) AS n_issues, a AS top_k FROM b0 JOIN p ON p.kind = project_type""",
)
