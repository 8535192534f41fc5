"""The pipeline's stages against brute force, and the registered queries against their SQL."""

import random
import time

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from docprep.llm import common, queries, simhash, similar

from .test_llm_corpus import brute_repeats

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, f in corpus_pipeline.STAGES:
        out.append(corpus_pipeline.written(f(spark, out[-1], SF), name))
    return out


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_columns(stages):
    assert all(s.columns == stages[0].columns for s in stages[1:-1])


def test_exact_stage(stages):
    before, after = rows(stages[1]), rows(stages[2])
    best = {}
    for i, r in before.items():
        best[r.text] = max(i, best.get(r.text, i))
    assert set(after) == set(best.values())


def similar_roots(texts):
    """The smallest id that each one reaches by pairs of a similarity of 0.8; all pairs are looked at."""
    sets = {i: frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if (w := (t or "").lower().split()) else frozenset() for i, t in texts.items()}
    root = {i: i for i in texts}
    for x in sets:
        for y in sets:
            if y < x and 5 * len(sets[x] & sets[y]) >= 4 * len(sets[x] | sets[y]) and root[x] != root[y]:
                low, high = sorted((root[x], root[y]))
                root = {k: low if v == high else v for k, v in root.items()}
    return root


def test_near_stage(stages):
    before, after = rows(stages[2]), rows(stages[3])
    assert set(after) == set(similar_roots({i: r.text for i, r in before.items()}).values())


def test_stages_on_odd_tables(spark):
    """Nulls, empty texts, repeated ids and rows, further columns; and empty tables."""
    long_ = " ".join(f"w{k}" for k in range(60))
    given = [(1, "A b c", "s"), (1, "A b c", "s"), (1, "D e f", "s"), (2, None, None), (3, "", "t"), (None, long_, "u"), (7, long_ + " end", None), (8, long_ + " End", "v"), (9, "D e f", "w")]
    docs = spark.createDataFrame([(i, t, None, s, None, i) for i, t, s in given], "doc_id long, text string, lang string, source string, n_chars long, score long")
    for empty in (False, True):
        now, seen = (docs.limit(0) if empty else docs), []
        for name, stage in corpus_pipeline.STAGES:
            before, now = now, corpus_pipeline.written(stage(spark, now, SF), name)
            if name != "packing":
                assert now.columns == docs.columns
            seen.append(sorted(((r.doc_id is None, r.doc_id, r["text"] if "text" in now.columns else r.start) for r in now.collect()), key=repr))
        if empty:
            assert seen == [[]] * 5
            continue
        toxicity, exact, near, suffix, _ = seen
        assert len(toxicity) == len(given)
        # One row for each text: the largest id; null and empty texts are equal.
        assert sorted(((i, t or "") for _, i, t in exact), key=repr) == sorted([(1, "A b c"), (9, "D e f"), (3, ""), (None, long_), (7, long_ + " end"), (8, long_ + " End")], key=repr)
        assert [i for _, i, _ in near].count(8) == 0 and len(near) == 5
        assert {i for _, i, _ in suffix} == {i for _, i, _ in near}


def test_near_stage_finds_all_similar_documents(spark):
    """Against brute force over all pairs, from a similarity of 0.8 on and below."""
    r = random.Random(5)
    words = ["".join(r.choice("abcdefg") for _ in range(5)) for _ in range(400)]
    bases = [r.choices(words, k=k) for k in (3, 12, 40, 90, 200, 200)]
    texts = ["", " \n", None, "one", "ONE", "one two"]
    for _ in range(150):
        w = list(r.choice(bases))
        for _ in range(r.choice([0, 1, 2, 3, 4, 5])):
            w[r.randrange(len(w))] = r.choice(words)
        texts.append(" ".join(w + (bases[4][:60] if r.random() < 0.2 else [])))
    root = set(similar_roots(dict(enumerate(texts))).values())
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert set(rows(corpus_pipeline.near_dedup_stage(spark, docs, SF))) == root
    assert 10 < len(root) < len(texts) - 20


def test_near_stage_goes_by_simhash_first(spark, monkeypatch):
    """The first pairs that are checked are those of SimHash, all of them; what it leaves is found later, and no pair is checked twice."""
    r = random.Random(11)
    words = ["".join(r.choice("abcdefg") for _ in range(5)) for _ in range(900)]
    texts = []
    for size in (30, 300, 300, 900, 900):
        base = r.choices(words, k=size)
        for k in range(8):
            w = list(base)
            for _ in range(k % 4 * size // 300):
                w[r.randrange(size)] = r.choice(words)
            texts.append(" ".join(w) + (" " if k == 4 else ""))
    fps = [int(x) for x in simhash.fingerprints([t.encode() for t in texts], 5)]
    near = {(a, b) for a in range(len(texts)) for b in range(a) if (fps[a] ^ fps[b]).bit_count() <= 4}
    seen = []
    plain = similar.checked

    def checked(pairs, *rest):
        out = plain(pairs, *rest)
        seen.append(({(x.a, x.b) for x in pairs.collect()}, {(x.a, x.b) for x in out.collect()}))
        return out

    monkeypatch.setattr(similar, "checked", checked)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert set(rows(corpus_pipeline.near_dedup_stage(spark, docs, SF))) == set(similar_roots(dict(enumerate(texts))).values())
    first, linked = seen[0]
    assert linked and first <= near

    def joined(pairs):
        root = list(range(len(texts)))
        for a, b in pairs:
            low, high = sorted((root[a], root[b]))
            root = [low if x == high else x for x in root]
        return root

    assert joined(first) == joined(near)
    assert set().union(*(out for _, out in seen[1:])) and sum(len(p) for p, _ in seen) == len(set().union(*(p for p, _ in seen)))


def test_close_fingerprints_alone_are_no_copies(spark, monkeypatch):
    """Where all fingerprints are equal the check on the sets decides."""
    monkeypatch.setattr(similar, "voted", lambda hashes: simhash.voted([h[:0] for h in hashes]))
    docs = spark.createDataFrame([(i, " ".join(f"w{i // 2}x{k}" for k in range(40)) + " end" * (i % 2)) for i in range(8)] + [(9, "")], "doc_id long, text string")
    assert set(rows(corpus_pipeline.near_dedup_stage(spark, docs, SF))) == {0, 2, 4, 6, 9}


def test_near_stage_broadcasts_no_table(spark, monkeypatch):
    """Spark takes a table's size from its files, which may be far smaller than its rows; only what was counted, and groups of a bounded number (SimHash's equal fingerprints), may be broadcast."""
    monkeypatch.setattr(common, "MOST_SENT", 0, raising=False)
    plain, plans = similar.written, {}

    def written(df, name):
        plans.setdefault(name, []).append(df._jdf.queryExecution().sparkPlan().toString())
        return plain(df, name)

    monkeypatch.setattr(similar, "written", written)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = corpus_pipeline.near_dedup_stage(spark, docs, SF)
    plans["kept"] = [kept._jdf.queryExecution().sparkPlan().toString()]
    assert {"met", "sets", "similar", "pairs", "apart", "sketched", "kept"} <= set(plans)
    assert not [name for name, made in plans.items() if name != "simhash" and any("BroadcastHashJoin" in p for p in made)]


def test_shuffle_files_go_with_the_write(spark):
    def files():
        return {f.getName() for f in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()) if f.getName().startswith("shuffle_")}

    before = files()
    made = common.written(spark.range(5000).groupBy((F.col("id") % 999).alias("k")).count(), "counts")
    for _ in range(50):
        if not (left := files() - before):
            break
        time.sleep(0.1)
    assert not left and made.count() == 999


def test_near_stage_in_parts_moves_few_sets(spark, monkeypatch):
    """Documents that share a passage, and no more, are told apart by their sketches; parts of the keys give what all at once give."""
    r = random.Random(23)
    words = ["".join(r.choice("abcdefg") for _ in range(5)) for _ in range(5000)]
    passages = [r.choices(words, k=12) for _ in range(40)]
    texts = [" ".join(r.choices(words, k=r.choice([150, 700, 3000])) + passages[k % 40]) for k in range(160)]
    texts += [t.replace(" ", "  ") + " end" for t in texts[:9]] + [" ".join(t.split()[: len(t.split()) * 17 // 20]) for t in texts[9:15]]
    plain, seen = similar.checked, []

    def checked(pairs, *rest):
        seen.append(pairs.count())
        return plain(pairs, *rest)

    monkeypatch.setattr(similar, "checked", checked)
    monkeypatch.setattr(similar, "PASS_ROWS", 1, raising=False)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert set(rows(corpus_pipeline.near_dedup_stage(spark, docs, SF))) == set(similar_roots(dict(enumerate(texts))).values())
    assert 15 <= sum(seen) <= 20


def test_sketches_are_a_lower_bound(spark):
    r = random.Random(29)
    sets = []
    for n in (1, 9, 400, 520, 640, 4000, 5000):
        own = [r.getrandbits(64) - (1 << 63) for _ in range(n)]
        sets += [np.array(sorted(own[: n - k] + [r.getrandbits(63) for _ in range(k)]), np.int64) for k in (0, n // 20, n // 3)]
    pairs = [(i, j) for i, a in enumerate(sets) for j, b in enumerate(sets) if 0.8 <= len(a) / len(b) <= 1.25]
    table = spark.createDataFrame([(i, j, similar.wide_sketch(sets[i]), similar.wide_sketch(sets[j])) for i, j in pairs], "i int, j int, a array<long>, b array<long>")
    for x in table.select("i", "j", similar.bits_apart(F.col("a"), F.col("b")).alias("d")).collect():
        apart = len(set(sets[x.i].tolist()) ^ set(sets[x.j].tolist()))
        assert x.d <= apart and (apart < 100 or x.d > apart / 5)


def test_suffix_stage(stages):
    before, after = rows(stages[3]), rows(stages[4])
    want = brute_repeats([(i, r.text) for i, r in before.items()])
    assert set(after) == set(before)
    for i, r in after.items():
        assert r.n_chars == len(r.text) and r.source == before[i].source
        assert 0 <= len(r.text.encode()) - (want[i][0] - want[i][1]) <= 8 * want[i][2]


def test_packing_stage(stages):
    pieces = stages[5].collect()
    by = {}
    for p in sorted(pieces, key=lambda p: (p.doc_id, p.start)):
        assert p.start == by.get(p.doc_id, 0)
        by[p.doc_id] = p.start + p.length
    assert set(by) == set(rows(stages[4]))


def test_toxic_stage_keeps_clean_documents(stages, spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = set(rows(stages[1]))
    clean = [i for i, t in labels.items() if t == 0]
    assert sum(i in kept for i in clean) / len(clean) > 0.9


def test_all_operators_are_registered():
    assert [n.split("_")[0] for n in queries.QUERIES] == [f"op{i}" for i in range(1, 14)]
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_against_sql(spark, name):
    c = duckdb.connect()
    for t in ("documents", "conversations", "labels", "pages", "embeddings"):
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    df = queries.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    rel = c.sql(queries.ORACLES[name])
    assert sorted(rel.columns) == cols
    at = [rel.columns.index(x) for x in cols]
    assert sorted(repr([r[x] for x in cols]) for r in df.collect()) == sorted(repr([r[k] for k in at]) for r in rel.fetchall())
