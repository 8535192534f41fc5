"""Whitening, exact top-k search and conversation repair, against numpy and brute force."""

import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest

from docprep.llm import pivot_search, repair, whitening

VECTORS = "vec_id long, embedding array<float>"


def whole(v):
    return [math.floor(1024 * float(c)) for c in v]


def floats(x):
    return [float(c) for c in np.asarray(x, dtype=np.float32)]


# --- whitening


@pytest.mark.parametrize("d", [1, 2, 3, 8, 40])
@pytest.mark.parametrize("kind", ["full", "identity", "steps", "one", "low rank"])
def test_eigen(d, kind):
    r = np.random.default_rng(d)
    x = r.normal(size=(3 if kind == "low rank" else d + 5, d))
    a = {"full": x.T @ x, "low rank": x.T @ x, "identity": np.eye(d), "steps": np.diag(np.arange(d) // 3 + 1.0), "one": np.diag([4.0] + [0.0] * (d - 1))}[kind]
    k = min(8, d)
    values, rows = whitening.leading_components(a, k)
    assert np.allclose(values, np.linalg.eigvalsh(a)[::-1][:k], rtol=1e-12, atol=1e-12 * np.max(np.abs(a)))
    assert np.abs(rows @ rows.T - np.eye(k)).max() < 1e-12
    assert np.abs(a @ rows.T - rows.T * values).max() < 1e-12 * np.max(np.abs(a)) * d


def test_tridiagonal_and_counts():
    x = np.random.default_rng(5).normal(size=(12, 9))
    a = x.T @ x
    diagonal, off, q = whitening.tridiagonal(a)
    t = np.diag(diagonal) + np.diag(off, 1) + np.diag(off, -1)
    assert np.abs(q @ t @ q.T - a).max() < 1e-12 * np.abs(a).max()
    at = np.linspace(-1, np.abs(a).sum(), 50)
    assert whitening.sturm_counts(diagonal, off, at).tolist() == [int(np.sum(np.linalg.eigvalsh(a) < x)) for x in at]


def test_products_are_exact():
    r = random.Random(1)
    for top in (1 << 10, 1 << 25, 1 << 30, 1 << 51):
        z = np.array([[r.randint(-top, top) for _ in range(3)] for _ in range(50)])
        assert whitening.products(z).tolist() == (z.astype(object).T @ z.astype(object)).tolist()


def whitened(rows):
    out = {}
    for r in rows:
        out.setdefault((r.vec_id, r.component), []).append(r)
    return out


@pytest.mark.parametrize("parts", [1, 5])
def test_whitening(spark, parts):
    r = np.random.default_rng(2)
    x = [(i, floats(v)) for i, v in enumerate(r.normal(size=(70, 11)) * np.arange(1, 12) / 20)]
    odd = [(100, None), (101, []), (102, [math.nan] + [0.1] * 10), (103, [math.inf] + [0.1] * 10), (104, [0.1] * 4), (105, [None] + [0.1] * 10), (None, x[0][1]), (3, x[3][1])]
    df = spark.createDataFrame(x + odd, VECTORS).selectExpr("vec_id", "embedding", "1 as component", "2 as _x", "3 as n").repartition(parts)
    got = whitened(whitening.whiten_embeddings(df).collect())
    kept = [*x, (None, x[0][1]), (3, x[3][1])]
    big = np.array([whole(v) for _, v in kept]) + 100_000
    n, s = len(kept), big.sum(axis=0)
    assert set(got) == {(i, c) for i, _ in kept for c in range(1, 9)} and len(got[3, 1]) == 2
    cov = np.cov(big.T.astype(float), bias=True)
    values, vectors = np.linalg.eigh(cov)
    table = np.zeros((n, 8))
    for k, (i, _) in enumerate(kept):
        for c in range(8):
            row = got[i, c + 1][0]
            assert row.n == n and row.deviation == sum((n * int(a) - int(b)) ** 2 for a, b in zip(big[k], s, strict=True))
            assert row.explained == pytest.approx(values[-1 - c] / np.trace(cov), rel=1e-9)
            table[k, c] = row.whitened
    want = (big - s / n) @ vectors[:, ::-1][:, :8] / np.sqrt(values[::-1][:8])
    assert np.allclose(table * np.sign((table * want).sum(axis=0)), want, atol=1e-9)
    (error,) = {r.identity_error for rows in got.values() for r in rows}
    assert error == pytest.approx(np.abs(np.cov(table.T, bias=True) - np.eye(8)).max(), abs=1e-12) and error < 1e-10


def test_whitening_does_not_depend_on_parts(spark):
    r = np.random.default_rng(4)
    df = spark.createDataFrame([(i, floats(v)) for i, v in enumerate(r.normal(size=(200, 6)))], VECTORS)
    models = [whitening.fit(*whitening.whole_vectors(df.repartition(p), whitening.SHIFT)) for p in (1, 7)]
    assert models[0].sums == models[1].sums and (models[0].components == models[1].components).all() and (models[0].values == models[1].values).all()


def test_whitening_without_variance(spark):
    got = whitening.whiten_embeddings(spark.createDataFrame([(1, [1.0, 2.0, 3.0]), (2, [1.0, 2.0, 3.0])], VECTORS)).collect()
    assert len(got) == 6 and all(r.whitened is None and r.explained == 0 and r.deviation == 0 and r.identity_error == 0 for r in got)
    got = whitening.whiten_embeddings(spark.createDataFrame([(1, [1.0, 2.0]), (2, [2.0, 2.0])], VECTORS)).collect()
    assert sorted((r.vec_id, r.component, r.whitened is None) for r in got) == [(1, 1, False), (1, 2, True), (2, 1, False), (2, 2, True)]
    assert sorted(abs(r.whitened) for r in got if r.component == 1) == pytest.approx([1, 1])
    assert whitening.whiten_embeddings(spark.createDataFrame([(1, None)], VECTORS)).collect() == []
    assert whitening.whiten_embeddings(spark.createDataFrame([], VECTORS)).columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_whitening_of_large_entries(spark):
    rows = [(i, [v, 1.0]) for i, v in enumerate((3e10, -2e10, 1e30, 5.0))]  # the third can't be told as a whole double
    got = whitening.whiten_embeddings(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r.vec_id for r in got} == {0, 1, 3} and all(r.deviation is None for r in got if r.vec_id == 0)


# --- exact top-k


def brute_top(rows, k, every):
    """rows: id, vector; those that take part. For each query row, in any order, its list."""
    lengths = [len(v) for _, v in rows]
    usual = max(set(lengths), key=lambda n: (lengths.count(n), n)) if rows else 0
    xs = [(i, whole(v)) for i, v in rows if len(v) == usual]
    out = []
    for a, (q, x) in enumerate(xs):
        if q is not None and q % every == 0:
            found = sorted(((-sum(p * o for p, o in zip(x, y, strict=True)), i is None, i or 0) for b, (i, y) in enumerate(xs) if b != a))[:k]
            out.append((q, [(-s, None if null else i) for s, null, i in found]))
    return sorted(out, key=repr)


def got_top(df, k, every):
    rows = pivot_search.top_k(df, k, every).collect()
    out, n = {}, {}
    for r in sorted(rows, key=lambda r: r["rank"]):  # queries that share an id have the same ranks
        n[r.query_id, r["rank"]] = n.get((r.query_id, r["rank"]), 0) + 1
        out.setdefault(r.query_id, []).append((r["rank"], r.score, r.vec_id))
    assert all(sorted({x[0] for x in v}) == list(range(1, max(x[0] for x in v) + 1)) for v in out.values())
    return out


@pytest.mark.parametrize("annulus", [7, 1024])
def test_top_k(spark, monkeypatch, annulus):
    monkeypatch.setattr(pivot_search, "ANNULUS", annulus)
    monkeypatch.setattr(pivot_search, "QUERIES", 3)
    r = np.random.default_rng(6)
    centres = r.normal(size=(5, 8))
    vectors = [floats(centres[i % 5] * (1 + i % 3) + 0.1 * r.normal(size=8)) for i in range(150)]
    vectors[40:80] = [vectors[40]] * 40  # copies: ties to the smaller id
    rows = list(enumerate(vectors))
    odd = [(200, None), (210, []), (220, [math.nan] * 8), (230, [0.5] * 3), (None, vectors[7]), (240, [None] * 8), (-10, vectors[3])]
    df = spark.createDataFrame(rows + odd, VECTORS).selectExpr("vec_id", "embedding", "1 as score", "2 as _row", "3 as x").repartition(3)
    want = brute_top([*rows, (None, vectors[7]), (-10, vectors[3])], 10, 10)
    got = got_top(df, 10, 10)
    assert got == {q: [(n, s, i) for n, (s, i) in enumerate(found, 1)] for q, found in want}


def test_top_k_of_few(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [-1.0, 0.0])], VECTORS)
    assert [tuple(r) for r in pivot_search.top_k(df).orderBy("rank").collect()] == [(0, 1, 1, 512 * 1024), (0, 2, 2, -1024 * 1024)]
    assert pivot_search.top_k(df.where("vec_id = 0")).collect() == []
    assert pivot_search.top_k(df.where("vec_id > 5")).collect() == []
    assert pivot_search.top_k(df.where("vec_id = 1")).columns == ["query_id", "rank", "vec_id", "score"]


def test_rows_that_share_an_id(spark):
    df = spark.createDataFrame([(0, [1.0]), (0, [1.0]), (0, [2.0])], VECTORS)
    got = sorted(tuple(r) for r in pivot_search.top_k(df).collect())
    one, two = 1 << 20, 2 << 20
    assert got == sorted([(0, 1, 0, two), (0, 2, 0, one), (0, 1, 0, two), (0, 2, 0, one), (0, 1, 0, two), (0, 2, 0, two)])


def test_scores_beyond_doubles(spark):
    r = random.Random(3)
    rows = [(i, [float(r.randint(-(1 << 20), 1 << 20)) for _ in range(3)]) for i in range(40)]
    got = got_top(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 5, 10)
    assert got == {q: [(n, s, i) for n, (s, i) in enumerate(found, 1)] for q, found in brute_top(rows, 5, 10)}


def test_bounds_pass_over_far_annuli():
    """On clusters most annuli are never compared, and the result is the same as by comparing all."""
    r = np.random.default_rng(8)
    centres = r.normal(size=(20, 6)) * 400
    x = np.rint(centres[np.arange(4000) % 20] + r.normal(size=(4000, 6)) * 4).astype(np.int64)
    m2 = float((x**2).sum(axis=1).max()) + 1
    pivots = pivot_search.choose_pivots(pivot_search.lifted(x[::10], m2), 20)
    away = pivot_search.distances(pivot_search.lifted(x, m2), pivots)
    near = away.argmin(axis=1)
    dist = away[np.arange(len(x)), near]
    group = pivot_search._Group(pivots, m2, np.dtype("<i8"), 6, 10)
    for p in range(len(pivots)):
        own = [i for i in np.lexsort((dist, near)) if near[i] == p]
        for at in range(0, len(own), 50):
            o = own[at : at + 50]
            group.take({"ids": [int(i) for i in o], "rows": [int(i) for i in o], "pivot": p, "low": dist[o].min(), "high": dist[o].max(), "x": x[o].tobytes()})
    asked = list(range(0, 4000, 100))
    found = {row: best for row, _, best in group.search({"ids": asked, "rows": asked, "seeds": [None] * len(asked), "x": x[asked].tobytes()})}
    for q in asked:
        s = x @ x[q]
        assert found[q].found[2].sum() == 0 and found[q].found[1].tolist() == [i for i in np.lexsort((np.arange(4000), -s)) if i != q][:10]
    assert group.passed > 0.5 * group.seen


# --- conversation repair


def spaced(v):
    return " " if v is None else str(v)


def after_damage(rows):
    convs = {}
    for c, t, role, text in rows:
        h = zlib.crc32(f"{spaced(c)}:{spaced(t)}".encode()) % 20
        role, text = spaced(role), spaced(text)
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        convs.setdefault(c, []).extend([(t, "user" if h == 4 else role, text)] * (0 if h == 0 else 2 if h == 3 else 1))
    for talk in convs.values():
        talk.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(f"{r[1]}\n{r[2]}".encode()).hexdigest()))
    return convs


def faults(talk):
    seen, out = set(), []
    for _, role, text in talk:
        end = text.rstrip("\x20\x09\x0a\x0b\x0c\x0d")
        out.append(1 if not end else 2 if (role, text) in seen else 3 if end[-1] not in ".!?" else 0)
        seen.add((role, text))
    return out


def by_tables(talk, found):
    """Cheapest (cost, audit, lines) by a table over rows and states, in place of an agenda."""
    wants, after = {0: "user", 1: "user", 2: "assistant", 3: "user"}, {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    table = {0: (0, "", ())}
    for step in [None, *zip(talk, found, strict=True)]:
        if step:
            (_, role, text), fault = step
            new = []
            for q, (c, a, lines) in table.items():
                new.append((q, (c + 2, a + "D", lines)))
                if fault not in (1, 2):
                    more = 5 * (fault == 3)
                    if (q, role[:1]) in after:
                        new.append((after[q, role[:1]], (c + more, a + "K", (*lines, f"{role}:{text}"))))
                    new.append((after[q, wants[q][0]], (c + 1 + more, a + "R", (*lines, f"{wants[q]}:{text}"))))
            table = {q: min(w for p, w in new if p == q) for q in {p for p, _ in new}}
        for _ in range(3):
            for q, (c, a, lines) in list(table.items()):
                n = after[q, wants[q][0]]
                table[n] = min(table.get(n, (1 << 60,)), (c + 5, a + "I", (*lines, wants[q] + ":")))
    return min(table[q] for q in (0, 3) if q in table)


def by_all_audits(talk, found):
    """Cheapest (cost, audit) among all sequences of edits with two insertions at most."""
    best = (1 << 60, "")
    for edits in itertools.product(*[("K", "U", "A", "D")] * len(talk)):
        for spots in itertools.chain.from_iterable(itertools.combinations_with_replacement([(i, r) for i in range(len(talk) + 1) for r in "ua"], m) for m in range(3)):
            cost, audit, roles, bad = 0, "", "", False
            for i in range(len(talk) + 1):
                for _, r in (s for s in spots if s[0] == i):
                    cost, audit, roles = cost + 5, audit + "I", roles + r
                if i < len(talk):
                    e, role = edits[i], talk[i][1][:1]
                    bad |= e != "D" and found[i] in (1, 2)
                    cost += 2 if e == "D" else (5 if found[i] == 3 else 0) + (e != "K")
                    audit += {"U": "R", "A": "R"}.get(e, e)
                    roles += "" if e == "D" else role if e == "K" else e.lower()
            if not bad and re.fullmatch("(s?(ua)+)?", roles):
                best = min(best, (cost, audit))
    return best


def expected(rows):
    out = {}
    for c, talk in after_damage(rows).items():
        found = faults(talk)
        turns = [t for t, _, _ in talk if t is not None]
        cost, audit, lines = by_tables(talk, found)
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(talk, talk[1:], strict=False))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[c] = (gaps, *(found.count(f) for f in (1, 2, 3)), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


TALKS = "conv_id long, turn long, role string, text string"


def talks(seed, long=100):
    r = random.Random(seed)
    rows = []
    for c in range(40):
        for t in range(long if c < 2 else r.choice([1, 2, 3, 5, 9])):
            role = r.choice(["user", "assistant", "system", "tool", None, ""]) if r.random() < 0.4 else ("user", "assistant")[t % 2]
            text = r.choice(["Hi.", "What? ", "no end", "", "  ", None, f"Yes! {r.randint(0, 9)}.", "A. \n", "é" * 9 + "!"])
            if r.random() > 0.1:
                rows.append((None if c == 7 else c, None if r.random() < 0.05 else t, role, text))
    return r.sample(rows, len(rows))


@pytest.mark.parametrize("seed,block", [(1, 512), (2, 3), (3, 1)])
def test_repair(spark, monkeypatch, seed, block):
    monkeypatch.setattr(repair, "BLOCK", block)
    rows = talks(seed)
    df = spark.createDataFrame(rows, TALKS).selectExpr("*", "1 as digest", "2 as gone", "3 as piece")
    got = repair.repair_conversations(df).collect()
    assert len(got) == len({r[0] for r in rows})
    assert {r.conv_id: tuple(r)[1:] for r in got} == expected(rows)


def test_one_conversation_over_all_tasks(spark):
    """A conversation that most tasks have a part of, and one of which each row says the same."""
    rows = talks(4, long=700) + [(99, t, "user", "Same.") for t in range(400)]
    assert {r.conv_id: tuple(r)[1:] for r in repair.repair_conversations(spark.createDataFrame(rows, TALKS)).collect()} == expected(rows)


def test_lightest_is_cheapest_of_all():
    r = random.Random(7)
    for _ in range(120):
        talk = [(t, r.choice(["user", "assistant", "system", "tool"]), "x") for t in range(r.randint(0, 4))]
        found = [r.choice([0, 0, 0, 1, 2, 3]) for _ in talk]
        got = repair.lightest([(role[:1], f) for (_, role, _), f in zip(talk, found, strict=True)], {0: (0, "")}, final=True)
        assert [x[:2] for x in got.values()] == [by_all_audits(talk, found)]


def test_repair_of_little(spark):
    gone = next(t for t in range(1000) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    got = repair.repair_conversations(spark.createDataFrame([(5, gone, "user", "Hi.")], TALKS)).collect()
    assert [tuple(r) for r in got] == [(5, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert repair.repair_conversations(spark.createDataFrame([], TALKS)).collect() == []
    long = [(1, t, ("user", "assistant")[t % 2], "word " * 200_000 + ".") for t in range(4)]
    assert {r.conv_id: tuple(r)[1:] for r in repair.repair_conversations(spark.createDataFrame(long, TALKS)).collect()} == expected(long)
