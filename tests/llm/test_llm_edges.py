"""Every registered query of the subpackage over empty tables, and over rows of nulls, repeats and very long texts."""

import pytest

import corpus_pipeline
from docprep.llm.queries import QUERIES

KINDS = {
    "documents": "doc_id long, text string, lang string, source string, n_chars long", "labels": "doc_id long, quality int, toxic int", "pages": "page_id long, url string, html string",
    "conversations": "conv_id long, turn long, role string, text string", "embeddings": "vec_id long, embedding array<float>, label int",
}
LONG = "palabra corta y larga. " * 40_000
ROWS = {
    "documents": [(None, None, None, None, None), (1, None, "es", "a", 0), (2, "", "es", "a", 0), (3, "hola mundo, buenos dias a todos", "es", "a", 0), (3, "hola mundo, buenos dias a todos", "es", "a", 0), (4, LONG, "en", None, 0), (5, "hola mundo, buenos dias a todos", None, "b", 0), (6, "word", "en", "b", 0)],
    "labels": [(None, None, None), (3, 1, 0), (3, 1, 0), (4, 0, 1), (99, 0, 1)],
    "pages": [(None, None, None), (1, "http://a.example/", "<p>x"), (1, "http://a.example/", "<p>x"), (2, "", f"<article>{LONG}</article>")],
    "conversations": [(None, None, None, None), (1, None, "user", None), (1, 0, "user", "Hi."), (1, 0, "user", "Hi."), (2, 5, None, LONG), (2, 7, "tool", "x")],
    "embeddings": [(None, None, None), (0, [0.5, 0.25], 1), (0, [0.5, 0.25], 1), (100, [1.0, None], 1), (None, [0.5, 0.5], 1), (7, [0.0, 0.0], 0), (8, [1.0], 0)],
}
OF = {"op5": "pages", "op7": "conversations", "op11": "embeddings", "op12": "conversations", "op13": "embeddings"}


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    made = {}
    for name, rows in (("empty", dict.fromkeys(KINDS, [])), ("odd", ROWS)):
        made[name] = str(tmp_path_factory.mktemp(name))
        for t, kind in KINDS.items():
            spark.createDataFrame(rows[t], kind).selectExpr("*", "1 as text_", "2 as _id", "3 as _text").write.parquet(f"{made[name]}/{t}.parquet")
    return made


@pytest.mark.parametrize("name", QUERIES)
def test_empty_tables_give_no_rows(spark, tables, name):
    df = QUERIES[name](spark, tables["empty"])
    assert df.collect() == [] and df.columns


def test_empty_documents_through_the_pipeline(spark, tables):
    assert corpus_pipeline.run(spark, tables["empty"]).collect() == []


@pytest.mark.parametrize("name", QUERIES)
def test_odd_rows(spark, tables, name):
    """Nulls, repeats, long texts and further columns: one row for each row that the query is about."""
    got = QUERIES[name](spark, tables["odd"]).collect()
    table = OF.get(name.split("_")[0], "documents")
    if name.startswith("op11"):
        assert len(got) == 4 * 2 and {r.n for r in got} == {4}
    elif name.startswith("op13"):
        assert sorted((r.query_id, r["rank"]) for r in got) == sorted([(0, 1), (0, 2), (0, 3)] * 2)
    elif name.startswith("op12"):
        assert len(got) == 3
    elif name.startswith("op8"):
        assert {r.doc_id for r in got} == {r[0] for r in ROWS["documents"]}
    else:
        assert len(got) == len(ROWS[table])
