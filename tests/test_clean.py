"""The cleaning chain: each rule at its boundary, on both sides, and the rules together."""

import pytest
from pyspark.sql import functions as F

from docprep.operators import clean

#: step, text, text after the step. Written from the rules: one case inside the bound and one just outside.
CASES = [
    (clean.bibliography, "Mar.\n# fuentes\nfolio 4", "Mar."),
    (clean.bibliography, "Mar.\nfuentes\nfolio 4", None),
    (clean.bibliography, "## Fuentes\nal principio", None),
    (clean.index_block, "p\n### Contenido\nuno\n# Z\nq", "p\n\n# Z\nq"),
    (clean.index_block, "p\n### Contenido y forma\nuno\n# Z\nq", None),
    (clean.dot_leaders, "Vela .. 3\nremo", "\nremo"),
    (clean.dot_leaders, "Vela . . 3\nremo", None),
    (clean.dot_leaders, "Vela .. tres\nremo", None),
    (clean.images, "a ![](x) b ![y](z) c", "a  b  c"),
    (clean.images, "a [y](z) c", None),
    (clean.captions, "FIGURA 7. Un cabo\nFigura siete. Un golfo", "\nFigura siete. Un golfo"),
    (clean.quoted_notes, "> 12 al pie\n> sin número", "\n> sin número"),
    (clean.plain_notes, "5Ibid, p. 3\n5 Ibid, p. 3\n555Ibid", "\n5 Ibid, p. 3\n555Ibid"),
    (clean.long_citations, f"x ({'k' * 39};{'k' * 39};) y", "x  y"),
    (clean.long_citations, f"x ({'k' * 39};{'k' * 38};) y", None),
    (clean.long_citations, f"x ({'k' * 90};) y", None),
    (clean.dehyphenate, "ba-\nrranco y sal -\nmuera", "barranco y sal -\nmuera"),
    (clean.number_lines, "a\n 4711 \n4 7\nb", "a\n\n4 7\nb"),
    (clean.collapse, "\n a\n\n\n\nb\n\nc \n", "a\n\nb\n\nc"),
    (clean.page_of, "Acta PÁGINA 2 de 9 bis\nPágina 2 9", "\nPágina 2 9"),
    (clean.page_slash, "3/4\n3/4 b", "\n3/4 b"),
]


@pytest.mark.parametrize(("step", "text", "after"), CASES, ids=[f"{s.__name__}-{k}" for k, (s, *_) in enumerate(CASES)])
def test_rule(spark, step, text, after):
    assert one(spark, text, step)[0] == (text if after is None else after)


def test_index_tables_by_share_of_dotted_rows(spark):
    """Three dotted rows of ten are as many as a table may have; the rule row doesn't count."""
    row, dotted = "| cal | 8 |\n", "| cal ..... 8 |\n"
    stays, goes = dotted * 3 + "|---|\n" + row * 7, dotted * 4 + "|---|\n" + row * 6
    assert one(spark, f"a\n{stays}b", clean.index_tables)[0] == f"a\n{stays}b"
    assert one(spark, f"a\n{goes}b", clean.index_tables)[0] == "a\nb"


def test_rules_together(spark):
    noise = ["Torre .... 61", "![](t.png)", "Figura 9: La torre", "> 4 sic", "8Ver el plano", "  77  "]
    body = ["# Torres", "La primera (1655) cayó.", "| piso | luz |\n|---|---|\n| 1 | sur |", "La segunda resis-\ntió."]
    mixed = [x for pair in zip(body, noise) for x in pair] + noise[len(body) :]
    out = one(spark, "\n\n".join([*mixed, "## Notas y referencias", "Padrón de 1700"]), clean.clean_markdown)[0]
    assert out == "\n\n".join(body).replace("resis-\n", "resis")


def one(spark, text, *steps):
    return spark.createDataFrame([(text,)], "t string").select(*(s(F.col("t")) for s in steps)).first()


def test_many_table_lines_do_not_overflow(spark):
    rows = "| a | b |\n" * 30_000
    assert one(spark, rows, clean.index_tables)[0] == rows


def test_repeated_lines_counts_by_stripped_text(spark):
    t = "cabecera\n  cabecera\nuno\ncabecera \ndos\ncabecera\ncorta\n"
    text, n = one(spark, t, clean.repeated_lines, clean.n_repeated_lines)
    assert (text, n) == ("uno\ndos\ncorta\n", 4)


def test_strip_needless(spark):
    t = "a\n## Fuentes\nx\n![i](j)\n# Otro\n![i](j) pie\nb\n"
    r = one(spark, t, clean.strip_needless)[0]
    assert r.asDict() == {"text": "a\n# Otro\nb", "images_removed": 1, "biblio_lines_removed": 3, "tokens_saved": 20}


def test_nulls_and_empty_texts(spark):
    for s in clean.CLEAN_STEPS:
        d = spark.createDataFrame([(None,), ("",)], "t string").select(s(F.col("t")).alias("o")).collect()
        assert d[0].o is None and d[1].o == ""


def test_chain_is_idempotent_on_clean_text(spark):
    t = "# T\n\nUno dos.\n\nTres."
    assert one(spark, t, clean.clean_markdown)[0] == t
