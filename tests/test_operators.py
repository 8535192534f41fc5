"""Limits and small cases that the tables don't reach."""

from pyspark.sql import functions as F

from docprep.operators import chunk, deliver, diagnose, gates, report, tables, validate
from docprep.operators.state import ordinals, pending, upsert


def col(spark, values, kind="string"):
    return spark.createDataFrame([(v,) for v in values], f"t {kind}")


def test_entity_length_limits(spark):
    d = col(spark, [399, 400, 999, 1000, 2499, 2500], "long").select(diagnose.entity_length(F.col("t")).alias("e"))
    assert [r.e for r in d.collect()] == ["cortas", "medias", "medias", "largas", "largas", "mixto"]


def test_section_length_leaves_out_head_and_tail(spark):
    t = "intro\n# A\nxx\n---\nyyy\n# B\ntail"
    r = col(spark, [t]).select(diagnose.structure(F.col("t"))).first()[0]
    assert (r.n_headings, r.n_separators, r.avg_section_len) == (2, 1, (len("# A\nxx") + len("---\nyyy")) // 2)


def test_strategy_limits(spark):
    rows = [(0.60, 2, 1, 100, 1500, 150), (0.601, 9, 9, 100, 1500, 150), (0.1, 1, 1, 100, 1500, 150), (0.1, 2, 1, 4500, 1500, 150), (0.1, 2, 1, 4499, 1500, 149)]
    d = spark.createDataFrame(rows, "short_line_ratio double, n_headings long, n_separators long, avg_section_len long, max_chars long, overlap long")
    assert [r.strategy for r in diagnose.decide(d).collect()] == ["semantic", "fixed", "fixed", "fixed", "semantic"]


def test_chunks_respect_limits_and_lose_nothing(spark):
    t = "\n\n".join(f"# T{i}\n\n" + "palabra " * (i * 7 % 90) for i in range(60))
    parts = col(spark, [t]).select(chunk.tree(F.col("t"), 300, 250)).first()[0]
    assert max(map(len, parts)) <= 300
    assert "".join("".join(parts).split()) == "".join(t.split())


def test_greedy_joins_up_to_the_limit(spark):
    parts = spark.createDataFrame([(["aaaa", "bbbb", "c" * 20, "d"],)], "p array<string>")
    assert parts.select(chunk.greedy(F.col("p"), 10)).first()[0] == ["aaaa\n\nbbbb", "c" * 20, "d"]
    assert parts.select(chunk.greedy(F.col("p"), 9)).first()[0] == ["aaaa", "bbbb", "c" * 20, "d"]
    assert spark.createDataFrame([([],)], "p array<string>").select(chunk.greedy(F.col("p"), 9)).first()[0] == []


def test_windows_overlap(spark):
    w = [f"w{i}" for i in range(25)]
    got = col(spark, [" ".join(w)]).select(chunk.windows(F.col("t"), 10, 3, 20)).first()[0]
    assert [x.split() for x in got] == [w[i : i + 10] for i in range(0, 25, 7)]
    assert col(spark, ["a  b"]).select(chunk.windows(F.col("t"), 10, 3, 20)).first()[0] == ["a  b"]


def test_reassemble_sorts(spark):
    d = spark.createDataFrame([(1, 2, "c"), (1, 0, "a"), (1, 1, "")], "doc_id long, chunk_idx long, chunk string")
    assert chunk.reassemble(d, drop_empty=True).first().text == "a\n\nc"


def test_truncated(spark):
    d = col(spark, ["Fin.", "Fin. \n", "Fin", "", "- ", "a#"]).select(gates.truncated(F.col("t")).alias("x"))
    assert [r.x for r in d.collect()] == [False, False, True, True, False, False]


def test_table_rows_and_states(spark):
    row = "| a | b |\n"
    d = col(spark, [row * 10 + "\n" + row * 22 + "| open |"]).select(validate.table_rows(F.col("t")))
    assert d.first()[0] == [8, 20]


def test_prose_blocks(spark):
    d = col(spark, ["# T\na\n\nb\nc\n- x\nd\ne", "a\nb\n1. x\nc"]).select(validate.prose_blocks(F.col("t")).alias("n"))
    assert [r.n for r in d.collect()] == [1, 0]


def test_markdown_table(spark):
    t = spark.createDataFrame([([["h", None, "h"], ["1", "x" * 121], ["2", " y ", "z"]],), ([["h"]],)], "t array<array<string>>")
    a, b = (r[0] for r in t.select(tables.to_markdown(F.col("t"))).collect())
    assert a == "\n| h | Col_1 | h_1 |\n|---|---|---|\n| 1 | " + "x" * 120 + "… |  |\n| 2 | y | z |\n" and b == ""


def test_merge_pairs_and_runs(spark):
    h = [["h"], ["r"]]
    rows = [("f", i, t) for i, t in enumerate([h, h, h, None, h, h])]
    d = spark.createDataFrame(rows, "file_name string, page_no int, first_table array<array<string>>")
    size = lambda mode: [len(r.first_table) if r.first_table else None for r in tables.merge_continued(d, mode).orderBy("page_no").collect()]
    assert size("pairs") == [3, None, 2, None, 3, None]
    assert size("full") == [4, None, None, None, 3, None]


def test_names(spark):
    d = col(spark, ["01_Cueva pintada (1)", "ÑANDÚ", "x" * 40]).select(deliver.output_name(F.col("t"), F.lit(3)).alias("n"))
    assert [r.n for r in d.collect()] == ["03_cueva_pintada_1_sem_v1.md", "03_and_sem_v1.md", "03_" + "x" * 30 + "_sem_v1.md"]


def test_pending_and_upsert(spark):
    docs = spark.createDataFrame([("a",), ("b",), ("c",)], "file_name string")
    state = spark.createDataFrame([("a", "OK"), ("b", "REVISAR")], "file_name string, file_status string")
    assert {r[0] for r in pending(docs, state).collect()} == {"b", "c"}
    assert pending(docs, state, force=True).count() == 3
    assert {tuple(r) for r in upsert(state, spark.createDataFrame([("b", "OK")], state.schema), ["file_name"]).collect()} == {("a", "OK"), ("b", "OK")}


def test_global_report_in_order(spark):
    kind = "file_name string, file_final string, status string, strategy string, cost double, tokens_in long, tokens_out long, error string, caveat_ids array<string>, gaps string"
    rows = [("b.md", "1_b.md", "OK", "fixed", 0.5, 3, 4, None, ["c1", "c9"], "uno\ndos"), ("a.md", None, "ERROR", None, None, None, None, "no answer", None, None)]
    got = [(r.section, r.line) for r in report.ordered(report.global_report(spark.createDataFrame(rows, kind), {"c1": "water"})).collect()]
    assert [s for s, _ in got] == [1, 1, 2, 3, 3, 4, 4]
    assert got[0][1].split() == ["a.md", "ERROR:", "no", "answer"] and got[1][1].split() == ["b.md", "1_b.md", "OK", "fixed", "2", "0.50000"]
    assert [x for _, x in got[2:]] == ["TOTAL: 2 archivos, tokens 3 + 4, coste 0.5000", "[c1] water", "[c9] ", "uno", "dos"]
    empty = report.global_report(spark.createDataFrame([], kind), {"c1": "water"}).collect()
    assert [r.line for r in empty] == ["TOTAL: 0 archivos, tokens 0 + 0, coste 0.0000"]


def test_ordinals(spark):
    keys = [None, None, "a", "b", "b", "ñ", *(f"k{i}" for i in range(50))]
    want = sorted(keys, key=lambda k: (k is not None, (k or "").encode()))
    for buckets in (1, 2, 7, 200):
        got = sorted((r.i, r.t) for r in ordinals(col(spark, keys), "t", buckets).collect())
        assert [i for i, _ in got] == list(range(1, len(keys) + 1)) and [k for _, k in got] == want
    assert ordinals(col(spark, []), "t").collect() == []
