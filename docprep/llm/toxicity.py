"""Toxicity by a weighted lexicon, matched with an Aho-Corasick automaton.

Texts are folded first: lower case, look-alike letters of other scripts to
Latin, digits and signs that stand for letters to those letters. Lexicon
entries are whole words and word beginnings, weighted by their log-odds among
labelled documents; an entry needs half as many toxic documents as the root of
their number, ``LEAST_DOCUMENTS`` at least; equal texts with equal labels count
once, for copies prove nothing. Exception phrases (an entry with the word before or after it) that occur in clean documents cancel
the match they cover. The weights of a document's matches are summed, divided by
a slowly growing function of its length, and turned into a probability by a
logistic curve fitted to the same labelled rows.

Fitting reads at most about ``sample`` labelled rows (a hash of the id picks
them), so that the joined labels, which are broadcast, and the driver's share are of
bounded size; the lexicon has at most ``entries`` entries and as many exceptions,
the strongest (ties: the longer, then the one that sorts first). Both are
parameters. Scoring covers every row and whole texts, in linear time.

Edge cases: a null text counts as empty; a text without a match gets the
curve's value at zero; without labels, or with one class only, every score is
the share of toxic labels (0 without any); an id with several rows has its label
on each of them, and one with two labels is toxic; equal texts have equal scores.
Other columns are ignored.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import drop_written, id_text, slices, trimmed, written

SAMPLE, ENTRIES, PREFIXES = 400_000, 5000, range(4, 9)
LEAST_DOCUMENTS, LEAST_ODDS = 5, 3.0
WORD = re.compile(r"[^\W\d_]+")
#: Signs and digits that stand for letters.
SIGNS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "|": "i"}
#: Look-alikes among Cyrillic and Greek letters.
LOOKALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "һ": "h", "к": "k", "м": "m", "т": "t", "в": "b", "н": "h",
    "α": "a", "ο": "o", "ρ": "p", "ν": "v", "ι": "i", "κ": "k", "τ": "t", "υ": "u", "ε": "e", "η": "n", "χ": "x",
}
_LETTERS = str.maketrans(LOOKALIKES | {chr(0xFF41 + i): chr(97 + i) for i in range(26)} | dict.fromkeys("​‌‍⁠﻿­", ""))
#: A run of signs is folded only inside a word: after or before a letter.
_MIXED = re.compile(r"(?<=[^\W\d_])[013457 8@$!|]*[013457 8@$!|](?=[^\W\d_])".replace(" ", "") + r"|(?<![\w@$])[013457@$](?=[^\W\d_])")
_NON_ASCII = re.compile(r"[^\x00-\x7f]")


def fold(text: str) -> str:
    low = text.lower()
    if _NON_ASCII.search(low):
        low = low.translate(_LETTERS)
    return _MIXED.sub(lambda m: "".join(SIGNS[c] for c in m[0]), low)


def features(text: str) -> set[str]:
    """Words as ``=word`` and beginnings of longer words as ``^begin``."""
    out = set()
    for w in set(WORD.findall(fold(text))):
        out.add("=" + w)
        out.update("^" + w[:n] for n in PREFIXES if n < len(w))
    return out


def _counted(docs: DataFrame, count) -> DataFrame:
    """docs: _text, _toxic. Documents by feature and label; ``count`` gives a text's features."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, Counter] = {0: Counter(), 1: Counter()}

        def flush() -> pa.RecordBatch:
            rows = [(f, held[1][f], held[0][f]) for f in held[0].keys() | held[1].keys()]
            held[0].clear()
            held[1].clear()
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int64()))], names=["f", "pos", "neg"])

        for batch in batches:
            for part in slices(batch):
                for text, y in zip(part.column("_text").to_pylist(), part.column("_toxic").to_pylist(), strict=True):
                    held[y].update(count(text))
                if len(held[0]) + len(held[1]) > 60_000:
                    yield flush()
        yield flush()

    return docs.select("_text", "_toxic").mapInArrow(trimmed(run), "f string, pos long, neg long").groupBy("f").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


class Lexicon:
    """Matches entries and exception phrases in a folded text."""

    def __init__(self, weights: dict[str, float], exceptions: list[str]) -> None:
        self.auto = ahocorasick.Automaton()
        for f, w in weights.items():
            old = self.auto.get(f[1:], ())
            self.auto.add_word(f[1:], (*old, (len(f) - 1, f[0] == "=", w, f)))
        for p in exceptions:
            old = self.auto.get(p, ())
            self.auto.add_word(p, (*old, (len(p), True, None, p)))
        self.auto.make_automaton()
        self.empty = not weights

    def matches(self, folded: str) -> list[tuple[int, int, float, str]]:
        """(start, end, weight, entry) of the entries that no exception phrase covers."""
        if self.empty:
            return []
        hits, spared = [], []
        for last, found in self.auto.iter(folded):
            for n, whole, weight, f in found:
                start, end = last + 1 - n, last + 1
                if start and folded[start - 1].isalpha():
                    continue
                after = end < len(folded) and folded[end].isalpha()
                if after if whole else not after:
                    continue
                (spared if weight is None else hits).append((start, end, weight, f))
        if not spared:
            return hits
        # A hit is covered if, of the phrases that start no later, one reaches its end.
        spared.sort()
        starts, reach = [a for a, *_ in spared], list(accumulate((b for _, b, *_ in spared), max))
        return [h for h in hits if not (k := bisect_right(starts, h[0])) or reach[k - 1] < h[1]]

    def rate(self, text: str) -> float:
        """Summed weights of the different entries that match, over a slow function of the length in words."""
        found = {f: w for _, _, w, f in self.matches(fold(text))}
        return sum(found.values()) / (1 + math.log1p(text.count(" ") / 100)) if found else 0.0


def phrases(lexicon: Lexicon, text: str) -> set[str]:
    """Each match with the word before it, and with the word after it."""
    folded, out = fold(text), set()
    for start, end, _, _ in lexicon.matches(folded):
        stop = end
        while stop < len(folded) and folded[stop].isalpha():
            stop += 1
        begin = start - 1
        while begin > 0 and folded[begin - 1].isalpha():
            begin -= 1
        if 0 <= begin < start - 1 and folded[start - 1] == " ":
            out.add(folded[begin:stop])
        end = stop + 1
        while end < len(folded) and folded[end].isalpha():
            end += 1
        if end > stop + 1 and folded[stop] == " ":
            out.add(folded[start:end])
    return out


def _chosen(counts: DataFrame, pos: int, neg: int, entries: int) -> dict[str, float]:
    """The entries with the largest log-odds, longer ones first among equals.

    What an entry covers is superfluous, and a shorter beginning of an entry only blurs it.
    """
    odds = F.log((F.col("pos") + 0.5) / (pos + 1)) - F.log((F.col("neg") + 0.5) / (neg + 1))
    sure = counts.where(F.col("pos") >= max(LEAST_DOCUMENTS, math.isqrt(pos) // 2)).withColumn("w", odds).where(F.col("w") >= LEAST_ODDS)
    rows = sure.orderBy(F.desc("w"), F.desc(F.length("f")), "f").limit(entries).select("f", "w").collect()
    out: dict[str, float] = {}
    blurred: set[str] = set()
    for f, w in rows:
        shorter = ["^" + f[1 : 1 + n] for n in range(PREFIXES[0], len(f) - 1)]
        if f not in blurred and not any(x in out for x in shorter):
            out[f] = w
            blurred.update(shorter)
    return out


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, entries: int = ENTRIES) -> tuple[dict[str, float], list[str], tuple[float, float]]:
    """docs: _id, _text. labels: _lid, _toxic. Weights, exception phrases and the curve's two numbers."""
    total = labels.count()
    share = min(1.0, sample / max(total, 1))
    bounded = labels.where(F.pmod(F.xxhash64("_lid"), F.lit(1_000_000)) < int(share * 1_000_000))
    # Equal texts count once. Written, so that the steps below read the labelled rows and not all texts again.
    known = written(docs.join(F.broadcast(bounded), F.col("_id") == F.col("_lid")).select("_text", "_toxic").distinct(), "labelled")
    by = {r[0]: r[1] for r in known.groupBy("_toxic").count().collect()}
    pos, neg = by.get(1, 0), by.get(0, 0)
    if not pos or not neg:
        drop_written(known)
        share = pos / (pos + neg) if pos else 0.0
        return {}, [], (math.log(max(share, 1e-9) / max(1 - share, 1e-9)), 0.0)
    weights = _chosen(_counted(known, features), pos, neg, entries)
    lexicon = Lexicon(weights, [])
    odds = _counted(known, lambda t: phrases(lexicon, t)).where((F.col("neg") >= 3) & (F.col("neg") * pos > 2 * F.col("pos") * neg))
    spared = [r[0] for r in odds.orderBy(F.desc("neg"), "f").limit(entries).collect()]
    lexicon = Lexicon(weights, spared)
    # The curve: Newton steps on a histogram of the rates, whose size doesn't depend on the input's.
    bins = _counted(known, lambda t: {str(round(lexicon.rate(t) * 10))}).collect()
    drop_written(known)
    x = np.array([int(r[0]) / 10 for r in bins])
    y1, y0 = np.array([float(r[1]) for r in bins]), np.array([float(r[2]) for r in bins])
    a, b = math.log(pos / neg), 0.5
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a + b * x, -30, 30)))
        n, e = y1 + y0, y1 - (y1 + y0) * p
        v = n * p * (1 - p) + 1e-9
        h = np.array([[v.sum() + 1, (v * x).sum()], [(v * x).sum(), (v * x * x).sum() + 1]])
        step = np.linalg.solve(h, [e.sum() - 0.01 * a, (e * x).sum() - 0.01 * b])
        a, b = float(np.clip(a + step[0], -20, 20)), float(np.clip(b + step[1], 0, 20))
    return weights, spared, (a, b)


def with_scores(docs: DataFrame, text_col: str, weights: dict[str, float], exceptions: list[str], curve: tuple[float, float], score_col: str = "score") -> DataFrame:
    """docs with all their columns and the score: rows stay in their tasks."""
    a, b = curve

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(weights, exceptions)
        for batch in batches:
            for part in slices(batch, text_col):
                made = [1 / (1 + math.exp(-max(-30.0, min(30.0, a + b * lexicon.rate(t or ""))))) for t in part.column(text_col).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(made, pa.float64())], names=[*part.schema.names, score_col])

    return docs.mapInArrow(trimmed(run), StructType([*docs.schema.fields, StructField(score_col, DoubleType())]))


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", folds: int = 5, held_out_fold: int = 0, sample: int = SAMPLE, entries: int = ENTRIES) -> tuple[dict[str, float], list[str], tuple[float, float]]:
    """Fit on labelled rows whose crc32(id as text) mod ``folds`` isn't ``held_out_fold``; an id with two labels is toxic."""
    marks = labels.select(F.col(id_col).cast("long").alias("_lid"), F.col(label_col).cast("int").alias("_toxic")).where(F.col("_toxic").isin(0, 1))
    learnt = marks.where(~held(F.col("_lid"), folds, held_out_fold)).groupBy("_lid").agg(F.max("_toxic").alias("_toxic"))
    return fit(id_text(docs, id_col, text_col), learnt, sample, entries)


def held(c: Column, folds: int, fold: int) -> Column:
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % folds == fold, F.lit(False))


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", folds: int = 5, held_out_fold: int = 0, sample: int = SAMPLE, entries: int = ENTRIES) -> DataFrame:
    """One row for each document: doc_id, held_out, score, predicted."""
    model = learn(docs, labels, id_col, text_col, label_col, folds, held_out_fold, sample, entries)
    made = with_scores(id_text(docs, id_col, text_col), "_text", *model)
    return made.select(F.col("_id").alias("doc_id"), held(F.col("_id"), folds, held_out_fold).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
