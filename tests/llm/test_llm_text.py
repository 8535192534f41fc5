"""Operators on single texts, against the libraries, brute force or exact round trips."""

import hashlib
import math
import random
import time

import duckdb
import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from docprep.llm import bpe, langid, packing, toxicity

SF = "/root/testdata/sf0.001"
MIXED = [" ", "  ", "\n", "\t", "a", "b", "é", "the", "'s", "'ll", "1", "²", "٣", "中", "😀", "\x1c", "\x85", "_", "-", "!!", ".", ",", ". ", ",\n", "The ", "<|endoftext|>", "<|end", "Ⅷ", "é", "‍", "ª", "ǅ", "\r\n", "Σ", "İ", "﻿", "　"]


def mixed(n, seed=1):
    r = random.Random(seed)
    return ["".join(r.choice(MIXED) for _ in range(r.randint(0, 14))) for _ in range(n)]


def test_bpe_matches_library():
    path = P.path("byte_bpe_50k.json")
    coder, library = bpe.BytePairCoder(path), Tokenizer.from_file(path)
    texts = [*mixed(3000), "a" * 5000, "ab" * 3000, "", " "]
    for t, want in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True):
        ids = coder.encode(t)
        assert np.frombuffer(ids, "<u4").tolist() == want.ids
        assert coder.decode(ids) == library.decode(want.ids, skip_special_tokens=False)


def test_bpe_tables(spark):
    path = P.path("byte_bpe_50k.json")
    rows = [(1, "Hello  world\n"), (2, None), (3, ""), (None, "x"), (1, "Hello  world\n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit("clash"))
    encoded = bpe.encode_documents(docs, path)
    back = sorted(((r.doc_id is None, r.doc_id, r.text) for r in bpe.decode_documents(encoded, path).collect()), key=str)
    assert back == sorted(((i is None, i, t or "") for i, t in rows), key=str)
    digest = {r.doc_id: r for r in bpe.round_trip_digests(docs, path).collect()}
    assert digest[2].n_tokens == 0 and digest[2].decoded_sha256 == hashlib.sha256(b"").hexdigest()
    assert bpe.round_trip_digests(docs.limit(0), path).count() == 0


def test_word_ids_match_library():
    path = P.path("word_bpe_49k.json")
    ours, library = packing.WordIds(path), Tokenizer.from_file(path)
    texts = mixed(3000, 2)
    for t, want in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True):
        assert np.frombuffer(ours.encode(t), "<u4").tolist() == want.ids


@pytest.mark.parametrize("seed", range(20))
def test_pack_covers_everything_once(seed):
    r = random.Random(seed)
    capacity = r.choice([16, 64, 4096])
    sizes = [r.choice([1, 2, capacity - 1, capacity, capacity + 1, r.randint(1, 3 * capacity)]) for _ in range(r.randint(0, 300))]
    pieces = packing.pack(sizes, capacity)
    at = [0] * len(sizes)
    for d, start, n, _, _ in sorted(pieces):
        assert start == at[d] and n > 0
        at[d] += n
    assert at == sizes
    fill = {}
    for _, _, n, s, offset in sorted(pieces, key=lambda p: (p[3], p[4])):
        assert fill.get(s, 0) == offset
        fill[s] = offset + n
    assert all(n <= capacity and (n == capacity or n & (n - 1) == 0) for n in fill.values())
    assert sorted(fill) == list(range(len(fill)))


def test_packed_table(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, None), (3, "x " * 9000), (3, "x " * 9000)], "doc_id long, text string")
    rows = packing.packed(docs, P.path("word_bpe_49k.json")).collect()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).extend(r.ids)
        assert r.length == len(r.ids)
    assert by[2] == [2] and len(by[3]) == 2 * 9001 and by[1][-1] == 2
    seqs = {}
    for r in rows:
        seqs[r.sequence_id] = seqs.get(r.sequence_id, 0) + r.length
    assert max(seqs.values()) <= 4096


def test_forward_sums_all_segmentations():
    path = P.path("piece_bpe_32k.model")
    vocab = langid.vocabulary(path)
    probs = np.random.default_rng(1).random(len(vocab) + 1)
    probs[0] = 0
    probs /= probs.sum()

    def total(m):
        if not m:
            return 1.0
        return sum(probs[vocab[m[:n]]] * total(m[n:]) for n in range(1, len(m) + 1) if m[:n] in vocab) + langid.UNKNOWN * total(m[1:])

    words = ["a", "hello", "straße", "中文", "año", "xqzt", "internationally"]
    ids, n = langid.lattice(words, path)
    assert np.allclose(np.exp(langid.log_likelihoods(ids, n, probs)), [total("▁" + w) for w in words], rtol=1e-9)


def test_pieces_of_any_length_and_words_of_any_length():
    path = P.path("piece_bpe_32k.model")
    vocab = langid.vocabulary(path)
    assert max(map(len, vocab)) == langid.longest_piece(path) > 12
    probs = np.full(len(vocab) + 1, 1 / len(vocab))
    word = "ab" * 2000  # its probability is far below the least float
    text, best = "▁" + word, [0.0]
    for e in range(1, len(text) + 1):
        terms = [best[e - 1] + math.log(langid.UNKNOWN)] + [best[s] - math.log(len(vocab)) for s in range(max(0, e - langid.longest_piece(path)), e) if text[s:e] in vocab]
        best.append(max(terms) + math.log(sum(math.exp(t - max(terms)) for t in terms)))
    ids, n = langid.lattice([word], path)
    assert math.isclose(langid.log_likelihoods(ids, n, probs)[0], best[-1], rel_tol=1e-9)
    counts, _ = langid.expected(ids, n, np.array([1.0]), probs)
    length = {k: len(p) for p, k in vocab.items()}
    assert math.isclose(sum(counts[k] * length[k] for k in np.flatnonzero(counts)), len(text), rel_tol=1e-2)


def test_expected_counts_against_all_segmentations():
    path = P.path("piece_bpe_32k.model")
    vocab = langid.vocabulary(path)
    probs = np.random.default_rng(2).random(len(vocab) + 1)
    probs[0] = 0
    probs /= probs.sum()

    def all_of(m):
        if not m:
            yield [], 1.0
        for n in range(1, len(m) + 1):
            p = probs[vocab[m[:n]]] if m[:n] in vocab else 0.0
            for rest, q in all_of(m[n:]):
                if p:
                    yield [vocab[m[:n]], *rest], p * q
                if n == 1:
                    yield rest, langid.UNKNOWN * q

    for word in ("hello", "straße", "these"):
        want, whole = np.zeros(len(probs)), 0.0
        for pieces, q in all_of("▁" + word):
            whole += q
            for k in pieces:
                want[k] += q
        ids, n = langid.lattice([word], path)
        got, likely = langid.expected(ids, n, np.array([3.0]), probs)
        assert np.allclose(got, 3 * want / whole) and math.isclose(likely, 3 * math.log(whole))


def test_letters():
    assert langid.words_of("½ ² Ⅷ ① ٣ 12 _ x٣Y 中文 ab²c") == ["x", "y", "中文", "ab", "c"]
    assert langid.words_of("x" * 500) == ["x" * 500]


def test_languages_are_bounded_and_ties_go_to_the_first(spark):
    path = P.path("piece_bpe_32k.model")
    rows = [(i, "wort und haus", "de") for i in range(9)] + [(20 + i, "wort und haus", "aa") for i in range(9)] + [(40, "casa", "es")]
    docs = spark.createDataFrame([*rows, (50, "½ ²", None), (51, "wort " * 20_000, None)], "doc_id long, text string, lang string")
    out = {r.doc_id: r.lang_pred for r in langid.identify(docs, path, most_languages=2, folds=1, held_out_fold=1).collect()}
    assert set(out.values()) == {"aa", "und"} and out[50] == "und" and out[51] == "aa"


def test_language_identification(spark):
    rows = [(i, ("the house and the garden " if i % 2 else "das haus und der garten ") * 3, "en" if i % 2 else "de") for i in range(60)]
    rows += [(100, None, "en"), (101, "123 !!", None), (102, "the house", None), (None, "das haus", "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit(1))
    out = langid.identify(docs, P.path("piece_bpe_32k.model")).collect()
    by = {r.doc_id: r for r in out}
    assert len(out) == len(rows)
    assert by[100].lang_pred == by[101].lang_pred == "und" and by[100].score == 0
    assert by[102].lang_pred == "en" and by[None].lang_pred == "de"
    assert all(by[i].lang_pred == lang for i, _, lang in rows[:60])
    nothing = langid.identify(docs.withColumn("lang", F.lit(None).cast("string")), P.path("piece_bpe_32k.model"))
    assert {r.lang_pred for r in nothing.collect()} == {"und"}
    assert langid.identify(docs.limit(0), P.path("piece_bpe_32k.model")).count() == 0


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = langid.identify(docs, P.path("piece_bpe_32k.model")).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in out) / len(out) > 0.95


def test_fold() -> None:
    assert toxicity.fold("1D10T") == "idiot"
    assert toxicity.fold("st\u0443pid s\u0441um") == "stypid scum"  # Cyrillic look-alikes of y and c
    assert toxicity.fold("$cum in 2024, 15 km") == "scum in 2024, 15 km"


def test_lexicon_matches_whole_words_and_beginnings():
    lexicon = toxicity.Lexicon({"=scum": 2.0, "^lowe": 3.0}, ["not scum"])
    found = lambda t: sorted(f for *_, f in lexicon.matches(toxicity.fold(t)))
    assert found("you scum, loweiä") == ["=scum", "^lowe"]
    assert found("scumbag slowei lowe") == []
    assert found("he is not scum") == []
    assert found("") == []


def test_toxicity(spark):
    rows = [(i, "plain words here " + ("grobian text" if i % 3 == 0 else "kind text") + f" number{i}") for i in range(90)] + [(200, None), (201, "GR0BIAN!"), (None, "plain")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("clash"))
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(90)], "doc_id long, toxic int")
    out = {r.doc_id: r for r in toxicity.toxicity(docs, labels).collect()}
    assert len(out) == len(rows)
    assert all(out[i].predicted == int(i % 3 == 0) for i in range(90))
    assert out[201].predicted == 1 and out[200].predicted == 0 and 0 <= out[200].score <= 1
    assert all(r.score < 0.01 and r.predicted == 0 for r in toxicity.toxicity(docs, labels.limit(0)).collect())
    assert toxicity.toxicity(docs.limit(0), labels).count() == 0


def test_exceptions_cover_hits_as_by_brute_force():
    r = random.Random(4)
    for _ in range(200):
        words = ["ab", "cd", "ef"]
        lexicon = toxicity.Lexicon({"=ab": 1.0, "=cd": 1.0}, r.sample([f"{a} {b}" for a in words for b in words], 3))
        text = " ".join(r.choices(words, k=30))
        spared = [(m, m + 5) for p in lexicon.auto if " " in p for m in range(len(text)) if text.startswith(p, m)]
        want = [(m, m + 2) for m in range(0, len(text), 3) if text[m : m + 2] in ("ab", "cd") and not any(a <= m and m + 2 <= b for a, b in spared)]
        assert sorted(h[:2] for h in lexicon.matches(text)) == want


def test_long_texts_are_scored_in_linear_time():
    lexicon = toxicity.Lexicon({"=bad": 2.0}, ["not bad"])
    start = time.process_time()
    assert lexicon.rate("not bad " * 200_000) == 0 and lexicon.rate("bad " * 200_000) > 0
    assert toxicity.phrases(lexicon, "q" * 100 + " bad " + "z" * 90) == {"q" * 100 + " bad", "bad " + "z" * 90}
    assert time.process_time() - start < 20


def test_repeated_rows_ties_and_parameters(spark):
    docs = spark.createDataFrame([(i, f"{'scum' if i % 2 else 'nice'} text n{i}") for i in range(80)] * 2 + [(1, "nice text"), (500, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)] + [(2, 1), (2, 0)], "doc_id long, toxic int")
    rows = toxicity.toxicity(docs, labels).collect()
    assert len(rows) == 162 and len({r.score for r in rows if r.doc_id == 7}) == 1
    assert sum(r.predicted for r in rows if r.doc_id % 2 and r.doc_id < 80) >= 80
    weights, spared, _ = toxicity.learn(docs, labels, entries=1)
    assert list(weights) == ["=scum"]
    assert len({r.score for r in toxicity.toxicity(docs, labels, sample=0).collect()}) == 1


def test_toxicity_ignores_held_out_labels(spark):
    docs = spark.createDataFrame([(i, f"word{i % 2} text") for i in range(100)], "doc_id long, text string")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    flipped = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = ({r.doc_id: r.score for r in toxicity.toxicity(docs, x).collect()} for x in (labels, flipped))
    assert a == b


def test_documents_of_the_tables_round_trip():
    coder = bpe.BytePairCoder(P.path("byte_bpe_50k.json"))
    for (t,) in duckdb.sql(f"select text from '{SF}/documents.parquet'").fetchall():
        assert coder.decode(coder.encode(t)) == t
