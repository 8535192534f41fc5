"""Whole stages with offline, cutting and failing backends; files and streams."""

import pytest
from pyspark.sql import functions as F

from docprep.plans import stages
from docprep.sources import connectors, files
from docprep.streaming import incremental


def echo(system, user, max_tokens):
    return user.split("\n\n", 1)[-1] + ".", 10, 5, f"m{max_tokens}"


class CutOnce:
    def __call__(self, system, user, max_tokens):
        return ("cut" if max_tokens < 32_000 else "whole."), 1, 1, "m"


def fails(system, user, max_tokens):
    raise TimeoutError("no answer")


def test_refine_copies_clean_documents_and_asks_for_the_rest(spark):
    docs = spark.createDataFrame([("good.md", "Un texto limpio."), ("bad.md", "Ã" * 50 + " texto")], "file_name string, text string")
    out = {r.file_name: r for r in stages.refine(docs, backend=echo).collect()}
    assert out["good.md"].status == "COPY" and out["good.md"].text == "Un texto limpio." and out["good.md"].tokens_in == 0
    assert out["bad.md"].reason == "mojibake" and out["bad.md"].tokens_in == 10


def test_refine_uses_saved_chunks(spark):
    docs = spark.createDataFrame([("bad.md", "Ã" * 50)], "file_name string, text string")
    saved = spark.createDataFrame([("bad.md", 0, "kept text", 7, 8, "old")], "file_name string, chunk_idx long, content string, tokens_in long, tokens_out long, model string")
    r = stages.refine(docs, backend=fails, saved=saved).first()
    assert (r.text, r.tokens_in, r.model) == ("kept text", 7, "old")


def test_failures_become_rows(spark):
    docs = spark.createDataFrame([("bad.md", "Ã" * 50)], "file_name string, text string")
    assert stages.refine(docs, backend=fails).first().status == "ERROR"


def test_cut_answers_are_asked_again(spark):
    rows = spark.createDataFrame([(1, "p", 4000)], "k int, prompt string, max_tokens long")
    r = connectors.call_model(rows, "", CutOnce()).first()
    assert (r.content, r.tokens_in, r.truncated) == ("whole.", 2, False)


def test_whole_chain_from_files(spark, tmp_path):
    (tmp_path / "a.txt").write_text("# Uno\n\nTexto de la sala.\f12\n\nMás texto.")
    (tmp_path / "b.txt").write_bytes(b"caf\xff")
    found = files.read_bytes(spark, str(tmp_path), "*.txt")
    converted = {r.file_name: r for r in stages.convert(found).collect()}
    assert converted["a.txt"].text == "# Uno\n\nTexto de la sala.\n\nMás texto."
    out = {r.file_name: r for r in stages.run_all(found, date="2026-01-01").collect()}
    assert set(out) == {"a.txt", "b.txt"} and out["a.txt"].status in ("OK", "REVISAR") and "Texto de la sala." in out["a.txt"].text


def test_strict_decoding(spark, tmp_path):
    (tmp_path / "b.md").write_bytes(b"caf\xff")
    found = files.read_bytes(spark, str(tmp_path), "*.md")
    assert files.decoded(found).first().text == "caf�"
    with pytest.raises(Exception, match="UTF"):
        files.decoded(found, strict=True).collect()


def test_stream_takes_each_file_once(spark, tmp_path):
    src, out, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.md").write_text("Uno.")
    for text in ("Dos.", "Tres."):
        incremental.process_new(incremental.watch_markdown(spark, src), lambda b: b.select("file_name", "text"), out, check).awaitTermination()
        (tmp_path / "in" / f"{text[0]}.md").write_text(text)
    incremental.process_new(incremental.watch_markdown(spark, src), lambda b: b.select("file_name", "text"), out, check).awaitTermination()
    assert {r.file_name for r in incremental.latest(spark, out).collect()} == {"a.md", "D.md", "T.md"}


def test_export(spark, tmp_path):
    files.export_markdown(spark.createDataFrame([("x.md", "hola")], "file_final string, text string"), str(tmp_path / "o"))
    assert (tmp_path / "o" / "x.md").read_text() == "hola"


def layered(k, marked=""):
    def read(content):
        text = content.decode().split("|")[k]
        if marked and text.startswith(marked):
            raise ValueError("unreadable")
        return [(p, [[["A"], [p[:3]]]]) if p.startswith("tab") else p for p in text.lstrip("!").split("/")]

    return read


LONG, PAGE = "palabra " * 600, "palabra " * 40
FILES = [
    ("native", f"{PAGE}|{PAGE}|"), ("scan", f"x|x|{PAGE}/corta"), ("blurred", f"x|x|!{PAGE}"), ("low", f"{LONG}|breve|{PAGE}"), ("lowblurred", f"{LONG}|breve|!{PAGE}"),
    ("broken", "x"), ("empty", "||"), ("tables", f"tab1 {PAGE}/tab2 {PAGE}|tab1 {PAGE}/tab2 {PAGE}|"),
]


@pytest.mark.parametrize(
    ("vision", "local", "methods"),
    [
        (False, False, "native native_fallback native_fallback native native error native_fallback native"),
        (False, True, "native ocr ocr ocr_retry ocr_retry error ocr native"),
        (True, False, "native ocr_gemini native_fallback ocr_gemini_retry native error ocr_gemini native"),
        (True, True, "native ocr_gemini ocr_tess_fallback ocr_gemini_retry ocr_retry error ocr_gemini native"),
    ],
)
def test_conversion_takes_every_route(spark, vision, local, methods):
    given = spark.createDataFrame([(f"{n}.pdf", c.encode()) for n, c in FILES], "file_name string, content binary")
    out = stages.convert(given, layered(1), layered(0), vision=layered(2, "!") if vision else None, local_ocr=layered(2) if local else None)
    rows = {r.file_name[:-4]: r for r in out.collect()}
    assert [rows[n].method for n, _ in FILES] == methods.split()
    assert rows["broken"].status == "ERROR" and rows["broken"].error.startswith("IndexError")
    assert rows["tables"].text.count("| A |") == 1 and rows["tables"].text.index("| tab |") < rows["tables"].text.index("tab2 ")
    if vision:
        assert (rows["scan"].coverage, rows["scan"].status, rows["scan"].text[:7]) == (50.0, "OCR_PARCIAL", "# scan\n")


@pytest.mark.parametrize("ocr", [False, True])
def test_conversion_by_page_gives_the_same_rows(spark, tmp_path, ocr):
    given = spark.createDataFrame([*((f"{n}.pdf", c.encode()) for n, c in FILES), ("none.pdf", None)], "file_name string, content binary")
    readers = {"extractor": layered(1), "raw": layered(0)} | ({"vision": layered(2, "!"), "local_ocr": layered(2)} if ocr else {})
    want = sorted(map(tuple, stages.convert(given, **readers).collect()))
    assert sorted(map(tuple, stages.convert_by_page(given, str(tmp_path), **readers).collect())) == want
    pages = spark.read.parquet(str(tmp_path / "pages"))
    assert pages.where("layer = 'page' AND file_name = 'tables.pdf' AND page_no > 0").count() == 2 and pages.schema["first_table"].dataType.simpleString() == "array<array<string>>"


class Opened:
    """Reads a text file, and notes that it did."""

    def __init__(self, folder):
        self.folder = folder

    def __call__(self, content):
        import uuid

        (self.folder / uuid.uuid4().hex).touch()
        return connectors.plain_pages(content)


def test_a_file_is_opened_once(spark, tmp_path):
    (tmp_path / "opened").mkdir()
    given = spark.createDataFrame([(f"{k}.txt", (PAGE * (k + 1) + "\f" + PAGE).encode()) for k in range(6)], "file_name string, content binary")
    stages.convert(given, Opened(tmp_path / "opened")).collect()
    assert len(list((tmp_path / "opened").iterdir())) == 6
    out = stages.convert_by_page(given, str(tmp_path / "work"), Opened(tmp_path / "opened"))
    assert out.count() == len(out.collect()) == 6 and len(list((tmp_path / "opened").iterdir())) == 12


def test_conversion_of_no_files(spark):
    assert stages.convert(spark.createDataFrame([], "file_name string, content binary"), vision=layered(2)).collect() == []


class Counted:
    """Notes each call as a file, since calls are made in other processes."""

    def __init__(self, folder, fail=""):
        self.folder, self.fail = folder, fail

    def __call__(self, system, user, max_tokens):
        import uuid

        (self.folder / uuid.uuid4().hex).touch()
        if self.fail and self.fail in user:
            raise TimeoutError("no answer")
        return user.split("\n\n", 1)[-1] + ".", 10, 5, "m"


def test_answers_are_kept_and_asked_for_once(spark, tmp_path):
    calls, state = tmp_path / "calls", str(tmp_path / "state")
    calls.mkdir()
    docs = spark.createDataFrame([("a.md", "Ã" * 50 + " uno"), ("b.md", "Ã" * 50 + " dos")], "file_name string, text string")
    first = stages.refine(docs, backend=Counted(calls, fail="dos"), state=state)
    for _ in range(2):
        assert {r.file_name: r.status for r in first.collect()}["b.md"] == "ERROR"
    assert len(list(calls.iterdir())) == 2
    second = stages.refine(docs, backend=Counted(calls), state=state)
    assert {r.status for r in second.collect()} <= {"OK", "SIN_CAMBIO"} and len(list(calls.iterdir())) == 3
    changed = docs.withColumn("text", F.concat("text", F.lit(" tres")))
    assert all(r.text.endswith("tres.") for r in stages.refine(changed, backend=Counted(calls), state=state).collect()) and len(list(calls.iterdir())) == 5


def test_answers_in_steps_and_a_part_that_cannot_be_read(spark, tmp_path):
    state = tmp_path / "state"
    rows = spark.createDataFrame([("a", k, f"p\n\n{k}", 4000) for k in range(9)], "file_name string, chunk_idx long, prompt string, max_tokens long")
    assert sorted(r.content for r in connectors.call_once(rows, str(state), "", echo, steps=3).collect()) == [f"{k}." for k in range(9)]
    broken = next(state.rglob("*.parquet"))
    broken.write_bytes(b"no parquet")
    (broken.parent / f".{broken.name}.crc").unlink()
    assert connectors.call_once(rows, str(state), "", echo).count() == 9


def test_dry_run_and_source(spark):
    docs = spark.createDataFrame([("a.md", "# Uno\n\nTexto.")], "file_name string, text string")
    r = stages.run_all(source=docs, dry_run=True).first()
    assert (r.strategy, r.tokens) == ("fixed", 3)
    assert stages.run_all(source=docs, skip_refine=True, date="2026-01-01").count() == 1
    with pytest.raises(ValueError, match="source"):
        stages.run_all()
