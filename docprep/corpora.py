"""Derived corpora: the given tables with the structure that the operators look for.

Each is one SQL text over a table ``{docs}`` (or ``{turns}``, ``{parts}``) that Spark
and the checking engine both read, so both sides start from the same rows.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_NL = "chr(10)"


def _when(k: int, r: int, *parts: str) -> str:
    return f"CASE WHEN doc_id % {k} = {r} THEN concat({', '.join(parts)}) ELSE '' END"


#: Documents with extraction noise by doc_id.
NOISY = f"""
SELECT doc_id, lang, source, concat(
  {_when(7, 0, "'Cubierta'", _NL, "'## Sumario'", _NL, "'I. La marea ........ 7'", _NL, "'| Faros ....... 15 |'", _NL, _NL, "'## Apertura'", _NL)},
  {_when(6, 1, "'Glosario .......... 88'", _NL, "'III) Molinos . . . . . 203'", _NL)},
  {_when(5, 2, "'| Barcos ........ 5 |'", _NL, "'|:--|'", _NL, "'| Redes ...... 9 |'", _NL, "'sin puntos'", _NL, "'| pez | kilo |'", _NL, "'|---|---|'", _NL, "'| bonito | 4 |'", _NL)},
  {_when(4, 1, "'Hoja suelta, página 8 de 90'", _NL, "'el oﬁcio y la ﬂota, ﬀ, eﬃgie, ﬄ'", _NL, "'mari-'", _NL, "'nero viejo'", _NL, "' 6 / 31 '", _NL)},
  CASE WHEN doc_id % 3 = 0 THEN replace(text, '. ', concat('.', {_NL})) ELSE text END, {_NL},
  {_when(8, 3, "'![faro](fotos/f_02.jpg)'", _NL, "'**==> picture [30 x 40] intentionally omitted <==**'", _NL, "'Figura 4: El muelle viejo'", _NL, "'> 7 Nota al margen del copista'", _NL, "'3Ver lo escrito arriba'", _NL)},
  {_when(9, 4, "'La costa (Prieto Lara 1951; Quesada y Vidal 1966; Ramos de Ory 1978; Soto Marrero 2003; Toledo 2012) era otra (1793).'", _NL, "'  31  '", _NL, _NL, _NL, _NL, "'remate'")},
  {_when(10, 5, "'Boletín del Archivo'", _NL, "'alba'", _NL, "'BOLETÍN DEL ARCHIVO'", _NL, "'ocaso'", _NL, "'  Boletín del Archivo'", _NL, "'Boletín del Archivo'", _NL, "'Boletín del Archivo '", _NL, "'noche'")},
  {_when(11, 6, "'PeÃ±a y caÃ±a, sueÃ±o '", "repeat('Ã', CAST(1 + floor(length(text) / 200) AS INT))")},
  {_when(13, 7, "repeat('F4RO ~x1~ mar3as ', CAST(1 + floor(length(text) / 300) AS INT))")},
  {_when(12, 8, _NL, "'## **Fuentes**'", _NL, "'- Acta de cabildo de 1802.'", _NL, "'![plano](plano.png)'", _NL, "'# Anejo'", _NL, "'anejo'")},
  {_when(14, 9, _NL, "'## Bibliografía'", _NL, "'- Legajo 12, folio 3.'", _NL, "'![sello](sello.png)'", _NL, "'# Colofón'", _NL, "'![sello](sello.png) impreso en casa'", _NL, "'fin'")}
) AS text FROM {{docs}}"""

#: Conversations folded into documents with headings and separators.
CHATS = f"""
SELECT conv_id AS doc_id, concat('# Conversation ', CAST(conv_id AS VARCHAR(20)), {_NL}, {_NL}, body) AS text FROM (
  SELECT conv_id, {{join}} AS body FROM (
    SELECT conv_id, turn, concat('## turn ', CAST(turn AS VARCHAR(20)), ' — ', role, {_NL}, {_NL}, text) AS part FROM {{turns}}) t
  GROUP BY conv_id) g"""

#: Whole documents with markers by doc_id: none, many short sections, middling and long ones; or mostly short lines. {g} is the first group.
SECTIONS = f"""
SELECT doc_id, lang, source, concat(CASE doc_id % 6
  WHEN 0 THEN text
  WHEN 1 THEN replace(text, '. ', concat('.', {_NL}, {_NL}, '## Tema', {_NL}, {_NL}))
  WHEN 2 THEN concat('# Obra', {_NL}, regexp_replace(text, concat('([^#]', chr(123), '640', chr(125), ')'), concat('{{g}}', {_NL}, '---', {_NL}){{flags}}))
  WHEN 3 THEN concat('# Obra', {_NL}, '## Cuerpo', {_NL}, regexp_replace(text, concat('([^#]', chr(123), '900', chr(125), '[^#]', chr(123), '600', chr(125), ')'), concat('{{g}}', {_NL}, '## Sigue', {_NL}){{flags}}), {_NL}, '# Fin')
  WHEN 4 THEN replace(text, ' ', {_NL})
  ELSE concat('# Uno', {_NL}, text, {_NL}, '# Dos', {_NL}, '# Tres') END, {_NL},
  CASE doc_id % 5 WHEN 0 THEN 'horario tarifa precio acceso' WHEN 1 THEN 'siglo historia época cueva sala' WHEN 2 THEN 'definición concepto es decir' WHEN 3 THEN 'horario siglo concepto' ELSE '' END) AS text FROM {{{{docs}}}}"""

#: Whole documents as a model would return them.
ANSWERS = f"""
SELECT doc_id, concat(
  {_when(5, 0, "'```markdown'", _NL)},
  {_when(7, 1, "'Aquí tienes el documento:'", _NL, _NL)},
  CASE WHEN doc_id % 9 = 8 THEN '' ELSE concat('# Documento', {_NL}, '· Archivo · 2026', {_NL}, {_NL}) END,
  CASE WHEN doc_id % 13 = 2 THEN text ELSE concat('## Parte 1', {_NL}, substr(text, 1, 700), {_NL}, '---', {_NL}, '## Parte 2', {_NL}, substr(text, 701)) END, {_NL},
  CASE WHEN doc_id % 50 = 7 THEN repeat(concat(text, {_NL}, '## Otra copia', {_NL}), CAST(1 + floor(110000 / (1 + length(text))) AS INT)) ELSE '' END,
  {_when(4, 2, "'#### Detalle'", _NL, "'- uno'", _NL)},
  {_when(6, 3, "repeat(concat('| a | b |', chr(10)), 11)", _NL)},
  {_when(8, 4, "repeat(concat('| a | b |', chr(10)), 25)", _NL)},
  {_when(10, 5, "'La fluorosis y las momias [WEB] ⚠️'", _NL)},
  {_when(14, 5, "'cruzaron el Atlántico'", _NL)},
  {_when(9, 5, "'Metodología: Extracción'", _NL)},
  {_when(12, 9, "'**Vigencia/Período:** 2020'", _NL)},
  {_when(3, 1, "'## Datos técnicos para investigadores'", _NL, "'- dato'", _NL)},
  {_when(11, 6, "'---'", _NL, "'## Lagunas detectadas'", _NL, "'- falta el año'", _NL)},
  {_when(5, 0, "_TAIL_")}
) AS text FROM {{docs}}""".replace("_TAIL_", "concat('fin', chr(10), '```')").replace("'concat", "concat")

#: Whole documents as files of three layers, which U+001E divides: text layer, extracted pages, what OCR would read ("!": the first reader fails).
SCANS = """
SELECT concat('f', CAST(doc_id AS VARCHAR(20)), '.pdf') AS file_name, doc_id % 7 AS kind, text AS whole, concat(
  CASE WHEN doc_id % 7 IN (1, 2) THEN 'hoja' ELSE text END, chr(30),
  CASE WHEN doc_id % 7 IN (1, 2) THEN 'hoja' WHEN doc_id % 7 IN (3, 4) THEN 'breve' WHEN doc_id % 7 = 5 THEN concat(text, chr(12), text) WHEN doc_id % 7 = 6 THEN 'uno dos tres' ELSE text END, chr(30),
  CASE WHEN doc_id % 7 IN (2, 4) THEN '!' ELSE '' END, pages) AS content
FROM (SELECT doc_id, text, replace(text, '. ', concat('.', chr(12))) AS pages FROM {docs}) x"""

#: Parts as pages with small tables: neighbours of one brand share a header.
PAGES = """
SELECT concat('f', CAST(p_partkey % 40 AS VARCHAR(20))) AS file_name, CAST(p_partkey AS BIGINT) AS page_no,
       CASE WHEN p_size % 7 = 0 THEN NULL ELSE p_brand END AS brand, p_name, p_type, CAST(p_size AS BIGINT) AS p_size FROM {parts}"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Rows of a table with fewer splits than there are cores, dealt over all of them, as its rows cost far more to work on than to move; larger tables stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def noisy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(NOISY, docs=spread(table(spark, sf_dir, "documents")))


def _sections(spark_side: bool) -> str:
    return SECTIONS.format(g="$1" if spark_side else r"\1", flags="" if spark_side else ", 'g'")


def sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(_sections(True), docs=spread(table(spark, sf_dir, "documents")))


def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(ANSWERS, docs=spread(table(spark, sf_dir, "documents")))


def chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    join = f"array_join(transform(array_sort(collect_list(struct(turn, part))), x -> x.part), concat({_NL}, {_NL}, '---', {_NL}, {_NL}))"
    return spark.sql(CHATS.replace("{join}", join), turns=table(spark, sf_dir, "conversations"))


def scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(SCANS, docs=spread(table(spark, sf_dir, "documents"))).selectExpr("file_name", "encode(content, 'UTF-8') AS content")


def work(spark: SparkSession) -> str:
    """A new folder for what a query writes, in the one that all executors share; where none is named, as in tests, a temporary one."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return f"{(shared or tempfile.mkdtemp(prefix='spark-')).rstrip('/')}/docprep-{uuid.uuid4().hex}"


def layer(k: int, marked: str = ""):
    """The pages of the k-th layer of a file of ``scans``; fails if it begins with ``marked``."""

    def read(content: bytes) -> list[str]:
        found = content.decode().split("\x1e")[k]
        if marked and found.startswith(marked):
            raise ValueError("unreadable")
        return found.lstrip("!").split("\f")

    return read


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(PAGES, parts=table(spark, sf_dir, "part"))


def checked(name: str) -> str:
    """The corpus as SQL for the checking engine."""
    if name == "chats":
        return CHATS.replace("{join}", f"string_agg(part, concat({_NL}, {_NL}, '---', {_NL}, {_NL}) ORDER BY turn)").replace("{turns}", "conversations")
    if name == "pages":
        return PAGES.replace("{parts}", "part")
    return {"noisy": NOISY, "sections": _sections(False), "answers": ANSWERS, "scans": SCANS, "documents": "SELECT doc_id, lang, source, text FROM {docs}"}[name].replace("{docs}", "documents")
