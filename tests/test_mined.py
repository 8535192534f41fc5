"""Pattern tables, mined headers, misread UTF-8, windows joined again, and figures of a run; against brute force."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from docprep.operators import chunk, clean, headers, patterns, report
from docprep.sources import connectors


def by_contains(texts, rows):
    return {i: [] if t is None else sorted({c for c, p in rows if c is not None and p is not None and p.lower() in t.lower()}) for i, t in texts}


@pytest.mark.parametrize("size", [patterns.AUTOMATON_BYTES, 60])
def test_patterns_of_a_table(spark, monkeypatch, size):
    monkeypatch.setattr(patterns, "AUTOMATON_BYTES", size)
    r = random.Random(4)
    word = lambda n: "".join(r.choice("abcÑé ") for _ in range(n))
    texts = [(i, word(r.randint(0, 60))) for i in range(80)] + [(99, None), (98, "")]
    rows = [(f"c{r.randint(0, 20)}", word(r.randint(1, 4))) for _ in range(60)] + [("c1", None), (None, "a"), ("c2", "a"), ("c3", "a")]
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in texts], "doc_id long, text string, _low int, caveat_id int")
    for more in ([], [("all", "")]):
        got = patterns.caveats_from(docs.drop("_low"), spark.createDataFrame(rows + more, "caveat_id string, pattern string")).collect()
        assert {x.doc_id: x.caveat_ids for x in got} == by_contains(texts, rows + more)
    assert all(x.caveat_ids == [] for x in patterns.caveats_from(docs, spark.createDataFrame([], "caveat_id string, pattern string")).collect())


def test_rows_with_many_ids_go_out_in_small_parts(monkeypatch):
    """A short pattern stands in nearly every text, so a text may have as many ids as there are patterns."""
    monkeypatch.setattr(patterns, "MOST_IDS", 500)
    own = pa.table({"_p": ["a", "b", "", "zz"], "ids": [[f"i{k}" for k in range(200)], ["i7", "x"], ["e"], ["z"]]})
    texts = ["a", None, "b", "", *["ab"] * 40]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts), pa.array([["o"]] + [[]] * (len(texts) - 1))], names=["row", "low", "ids"])
    out = list(patterns.matcher(own)(iter([batch])))
    every = sorted(f"i{k}" for k in range(200))
    assert max(len(b.column("ids").flatten()) for b in out) < 500 + 203
    assert [x for b in out for x in b.column("row").to_pylist()] == list(range(len(texts)))
    got = [x for b in out for x in b.column("ids").to_pylist()]
    assert got[:4] == [["e", *every, "o"], [], ["e", "i7", "x"], ["e"]] and all(x == ["e", *every, "x"] for x in got[4:])


def test_a_hundred_thousand_patterns(spark):
    rows = [(f"c{k}", f"clave{k:06d}x") for k in range(100_000)]
    texts = [(i, f"texto CLAVE{i * 997:06d}X y clave{i:06d}") for i in range(50)]
    df = patterns.caveats_from(spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(rows, "caveat_id string, pattern string"))
    assert {x.doc_id: x.caveat_ids for x in df.collect()} == {i: [f"c{i * 997}"] for i in range(50)}
    plan = df._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and len(plan) < 20_000


def test_headers_are_mined_by_source(spark):
    r = random.Random(5)
    rows = []
    for k in range(60):
        body = ["".join(r.choices("abcdefgh", k=12)) for _ in range(5)]
        rows.append((k, "a" if k % 2 else None, "\n".join([f"  El Faro, núm. {k}", *body, "EL FARO, NÚM. 7" if k % 3 else "pie", "corto" * 20, "abc"])))
    rows += [(90, "a", None), (91, "b", "El Faro, núm. 3"), (92, "b", "El Faro, núm. 3")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").withColumn("header", F.lit("clash"))
    found = headers.mined_headers(docs, share=0.5)
    assert sorted((x.source or "-", x.header, x.n_files) for x in found.collect()) == [("-", "el faro, núm. #", 30), ("a", "el faro, núm. #", 30)]
    out = {x.doc_id: x for x in headers.without_headers(docs, found).collect()}
    assert out[1].headers_removed == 2 and out[3].headers_removed == 1 and "faro" not in out[1].text.lower() and out[91].text == "El Faro, núm. 3" and out[90].text is None
    assert out[0].text.split("\n")[-1] == "abc" and out[0].header == "clash" and len(out) == 63
    assert headers.mined_headers(docs.limit(0)).collect() == []


def test_a_line_of_all_files_is_summed_in_tasks(spark):
    docs = spark.range(4000).select(F.expr("if(id < 2000, 's', 'u')").alias("source"), F.concat(F.lit("Cabecera fija\n"), F.col("id").cast("string"), F.lit(" cuerpo")).alias("text")).repartition(4)
    df = headers.mined_headers(docs)
    assert sorted(tuple(x) for x in df.collect()) == [(s, h, 2000) for s in "su" for h in ("# cuerpo", "cabecera fija")]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and "NestedLoop" not in plan


AS_BYTE = {bytes([b]).decode("cp1252"): b for b in range(0x80, 0xA0) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)} | {chr(b): b for b in range(256)}


def by_runs(text):
    """The longest decodable stretch at each place is decoded, one character at a time."""
    out, i = "", 0
    while i < len(text):
        for n in (2, 3, 4):
            part = text[i : i + n]
            if len(part) == n and ord(part[0]) >= 0xC2 and all(c in AS_BYTE for c in part) and AS_BYTE[part[0]] >= 0xC2:
                try:
                    one = bytes(AS_BYTE[c] for c in part).decode()
                except UnicodeDecodeError:
                    continue
                if len(one) == 1:
                    out, i = out + one, i + n
                    break
        else:
            out, i = out + text[i], i + 1
    return out


def misread(text, page):
    return "".join(c if page == "latin-1" else c for c in text.encode().decode("latin-1")) if page == "latin-1" else "".join(bytes([b]).decode("cp1252") if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D) else chr(b) for b in text.encode())


def test_misread_utf8(spark):
    r = random.Random(6)
    pieces = ["peña", " “cita” ", "œuvre", "€ 3", "日本", "😀", "Ã", "Â«no»", "año", "…", "\n", "ÉÈ", "à", "â€", "ï¿", "x" * 50, "Ó³"]
    texts = ["", "Ã", "Ã±", "â€œhola â€\x9d", "cafÃ© y café", "a" * 30_000 + misread("ñ", "latin-1") * 20_000]
    for _ in range(300):
        texts.append("".join(misread(p, r.choice(["latin-1", "cp1252"])) if r.random() < 0.5 else p for p in r.choices(pieces, k=r.randint(1, 12))))
    texts += ["".join(chr(r.choice([0xC2, 0xC3, 0xE0, 0xE2, 0xED, 0xF0, 0xF4, 0x80, 0x9F, 0xA0, 0xBF, 0x20AC, 0x201C, 97])) for _ in range(12)) for _ in range(500)]
    got = spark.createDataFrame(list(enumerate([*texts, None])), "i long, t string").select("i", clean.misread_utf8(F.col("t")).alias("t")).collect()
    assert {x.i: x.t for x in got} == dict(enumerate([*map(by_runs, texts), None]))
    assert connectors.offline("", "q\n\nLa peÃ±a, “ya” y â€œcasiâ€\x9d, café.", 100)[0] == "La peña, “ya” y “casi”, café."
    for page in ("latin-1", "cp1252"):
        assert by_runs(misread("Señor “López” … 日本 😀", page)) == "Señor “López” … 日本 😀"


def longest_border(a, b, most):
    return max([k for k in range(1, min(len(a), len(b), most) + 1) if a[-k:] == b[:k]], default=0)


def test_border(spark):
    r = random.Random(7)
    rows = [([r.choice("ab") for _ in range(r.randint(0, 9))], [r.choice("ab") for _ in range(r.randint(0, 9))]) for _ in range(400)]
    got = spark.createDataFrame(rows, "a array<string>, b array<string>").select(chunk.border(F.col("a"), F.col("b"), 6)).collect()
    assert [x[0] for x in got] == [longest_border(a, b, 6) for a, b in rows]


def test_windows_joined_again_are_the_text(spark):
    r = random.Random(8)
    texts = [" ".join(r.choice(["uno", "dos", "tres", "«cuatro»"]) for _ in range(n)) for n in (0, 1, 20, 21, 22, 27, 28, 29, 100)] + ["eco " * 77, " ".join(map(str, range(500)))]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chunk.windows(F.col("t"), 10, 3, 20).alias("p"))
    for x in df.select("t", chunk.join_windows(F.col("p"), 3).alias("j")).collect():
        assert x.j.split() == x.t.split()
    parts = [["a b\n\nc d", "c  d\n# e"], ["a b", "x y"], ["a", "", "a b"], ["a b c", "b c"], []]
    got = spark.createDataFrame([(p,) for p in parts], "p array<string>").select(chunk.join_windows(F.col("p"), 5)).collect()
    assert [x[0] for x in got] == ["a b\n\nc d # e", "a b\n\n---\n\nx y", "a b", "a b c", ""]


def test_figures_of_a_run_need_no_scan_of_their_own(spark, tmp_path):
    rows = [("a", "OK", 3, 4, 0.5, None), ("b", "ERROR", 9, 9, 9.0, "x"), ("c", "REVISAR", 1, 1, 0.25, None)]
    run = report.Run()
    run.watch(spark.createDataFrame(rows, "file_name string, status string, tokens_in long, tokens_out long, cost double, error string").repartition(3)).write.parquet(str(tmp_path / "o"))
    got = run.metrics(spark).first()
    assert (got.n_files, got.n_errors, got.tokens_in, got.tokens_out, got.cost, got.states) == (3, 1, 4, 5, 0.75, {"OK": 1, "REVISAR": 1, "ERROR": 1})
    assert len(got.run_date) == 10 and got.elapsed_s >= 0


def test_totals_come_from_one_scan(spark, tmp_path):
    spark.createDataFrame([("a", 1, 2, "OK"), ("a", 3, 4, "OK"), ("b", 5, 6, "COPY")], "file_name string, tokens_in long, tokens_out long, status string").write.parquet(str(tmp_path / "t"))
    df = report.refine_lines(spark.read.parquet(str(tmp_path / "t")))
    assert sorted((x.file_name, x.line.split()[1:]) for x in df.collect()) == [("TOTAL", ["9", "12"]), ("a", ["4", "6", "OK"]), ("b", ["5", "6", "COPY"])]
    assert df._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1
