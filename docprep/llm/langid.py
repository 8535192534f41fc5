"""Language identification by segmentation-marginalised unigrams.

For each language every piece of a fixed public vocabulary has a probability.
The probability of a word is the sum over all ways to segment it into pieces of
any length, by the forward algorithm, rescaled on the way so that a word may be
of any length; pieces never cross a word's start, so a text is scored word by
word. The probabilities are fitted by expectation-maximisation until the
likelihood settles (``SETTLED``): the forward-backward algorithm gives the
expected count of each piece in each word, over word counts of all training texts.

Words are runs of letters in lower case. Only the word counts and the expected
counts are shuffled; the model has languages x vocabulary numbers whatever the
input. The ``most_languages`` languages with the most training documents are
learnt (ties: the one that sorts first), which bounds the model where the column is dirty.

Edge cases: a text that is null or has no letter is ``und`` with score 0 (a digit,
fraction or numeral is no letter); ties go to the language that sorts first; with no
labelled text all is ``und``; repeated rows count, and are predicted, each time;
long texts are read whole, and a word takes time in proportion to its length.
Other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_written, slices, trimmed, written

def _numerals() -> str:
    """What counts as a word character but is no letter, beside decimal digits, as ranges of a character class."""
    found = [c for c in range(0x110000) if chr(c).isalnum() and not chr(c).isalpha() and not chr(c).isdecimal()]
    starts = [c for c, before in zip(found, [-2, *found], strict=False) if c != before + 1]
    ends = [c for c, after in zip(found, [*found[1:], -2], strict=True) if c + 1 != after]
    return "".join(f"{chr(a)}-{chr(b)}" for a, b in zip(starts, ends, strict=True))


#: A run of letters.
WORD = re.compile(rf"[^\W\d_{_numerals()}]+")
WORDLIKE = re.compile(r"\w+")
KEPT_WORDS, BLOCK, CELLS = 700_000, 2000, 1 << 22
#: Learning ends when the mean log-likelihood of a word grows by less than this share, or after so many rounds.
SETTLED, MOST_ROUNDS, MOST_LANGUAGES = 0.001, 20, 200
#: Words up to this length can't fall below the least float and are swept without scales.
UNSCALED = 28
#: Share of probability for a character that the vocabulary lacks, and a piece's least expected count.
UNKNOWN, FLOOR = 1e-7, 0.01


@lru_cache(maxsize=1)
def vocabulary(path: str) -> dict[str, int]:
    """Piece -> number, from 1 on; 0 is no piece. Pieces with a word start inside or without a letter are left out."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = {model.id_to_piece(i).lower() for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))}
    return {p: k for k, p in enumerate(sorted(p for p in pieces if "▁" not in p[1:] and p.strip("▁")), 1)}


@lru_cache(maxsize=1)
def longest_piece(path: str) -> int:
    return max(map(len, vocabulary(path)), default=1)


def blocks(words: list[str]) -> Iterator[list[str]]:
    """Words, shortest first, in blocks whose lattices have about CELLS positions at most, or one word."""
    some: list[str] = []
    for w in sorted(words, key=len):
        if some and (len(some) == BLOCK or (len(some) + 1) * (len(w) + 2) * 16 > CELLS):
            yield some
            some = []
        some.append(w)
    if some:
        yield some


def words_of(text: str) -> list[str]:
    """Lower-cased runs of letters. Runs of word characters are found faster, and are mostly letters alone."""
    low = text.lower()
    found = WORDLIKE.findall(low)
    return found if "".join(found).isalpha() else [w for run in found for w in ((run,) if run.isalpha() else WORD.findall(run))]


_BASE, _SLOTS = np.uint64(0x9E3779B97F4A7C15), 17


@lru_cache(maxsize=1)
def _slots(path: str) -> list[tuple[np.uint64, np.ndarray, np.ndarray, np.ndarray]]:
    """Hash tables (factor, keys, piece numbers, marks) of the vocabulary; what collides in one is in the next, and its slot is marked."""
    left = {}
    for piece, k in vocabulary(path).items():
        h = 0
        for c in piece:
            h = (h * int(_BASE) + ord(c)) % (1 << 64)
        left[h] = k
    out, factor = [], 0xD6E8FEB86659FD93
    while left:
        keys, numbers, marks = np.zeros(1 << _SLOTS, np.uint64), np.zeros(1 << _SLOTS, np.int32), np.zeros(1 << _SLOTS, bool)
        more = {}
        for h, k in left.items():
            slot = (h * factor % (1 << 64)) >> (64 - _SLOTS)
            if numbers[slot]:
                more[h], marks[slot] = k, True
            else:
                keys[slot], numbers[slot] = h, k
        out.append((np.uint64(factor), keys, numbers, marks))
        left, factor = more, (factor * 0x94D049BB133111EB + 2) % (1 << 64) | 1
    return out


def lattice(words: list[str], path: str) -> tuple[np.ndarray, np.ndarray]:
    """ids[word, end, length - 1] of the piece that ends there (0: none), and the words' lengths with their start mark."""
    n = np.array([len(w) + 1 for w in words])
    width = int(n.max(initial=1))
    text = "".join(["▁" + w.ljust(width - 1, "\0") for w in words])
    codes = np.frombuffer(text.encode("utf-32-le"), "<u4").reshape(len(words), width).astype(np.uint64)
    longest = min(longest_piece(path), width)
    ids = np.zeros((len(words), width + 1, longest), np.int32)
    h = np.zeros_like(codes)
    for k in range(longest):  # h: of the k + 1 characters from each position on
        h = h[:, : width - k] * _BASE + codes[:, k:]
        found = np.zeros(h.size, np.int32)
        open_, left = None, h.ravel()
        for factor, keys, numbers, marks in _slots(path):
            slot = ((left * factor) >> np.uint64(64 - _SLOTS)).astype(np.int64)
            hit = keys[slot] == left
            found[np.flatnonzero(hit) if open_ is None else open_[hit]] = numbers[slot[hit]]
            again = np.flatnonzero(marks[slot] & ~hit)
            if not len(again):
                break
            open_, left = again if open_ is None else open_[again], left[again]
        ids[:, k + 1 :, k] = found.reshape(h.shape)
    return ids, n


def _swept(ids: np.ndarray, probs: np.ndarray, positions: range, steps, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums over segmentations by position, forward or backward, and the logarithms of their scales.

    Every eighth position what later ones use is divided by its largest value. steps(position) gives
    (earlier position, numbers of the pieces between); start marks the positions where segmentations begin.
    """
    words, ends, longest = ids.shape
    more = probs.shape[1:]
    values, scales = np.zeros((words, ends, *more)), np.zeros((words, ends, *more))
    near: dict[int, np.ndarray] = {}  # the last values, on the present scale
    scale = np.zeros((words, *more))
    for turn, e in enumerate(positions):
        total = np.zeros((words, *more))
        begins = start[:, e]
        if begins.any():
            total[begins] = 1
            scale[begins] = 0
        for k, (before, at) in enumerate(steps(e)):
            if before not in near:
                break
            if k == 0:
                total = total + UNKNOWN * near[before]
            if at.any():
                total = total + near[before] * probs[at]
        near[e] = total
        values[:, e], scales[:, e] = total, scale
        near.pop(next(iter(near)) if len(near) > longest else None, None)
        if turn % 8 == 7:
            top = np.max(list(near.values()), axis=0)
            top[top == 0] = 1
            scale = scale + np.log(top)
            near = {p: v / top for p, v in near.items()}
    return values, scales


def forward(ids: np.ndarray, probs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """[word, position, ...]: probability of all segmentations up to there, as value and logarithm of its scale. probs: [piece] or [piece, language]."""
    words, ends, longest = ids.shape
    start = np.zeros((words, ends), bool)
    start[:, 0] = True
    return _swept(ids, probs, range(ends), lambda e: [(e - 1 - k, ids[:, e, k]) for k in range(min(longest, e))], start)


def _forward_short(ids: np.ndarray, probs: np.ndarray) -> np.ndarray:
    """As forward, without scales."""
    words, ends, longest = ids.shape
    alpha = np.zeros((words, ends, *probs.shape[1:]))
    alpha[:, 0] = 1
    for e in range(1, ends):
        total = UNKNOWN * alpha[:, e - 1]
        for k in range(min(longest, e)):
            at = ids[:, e, k]
            if at.any():
                total = total + alpha[:, e - 1 - k] * probs[at]
        alpha[:, e] = total
    return alpha


def log_likelihoods(ids: np.ndarray, n: np.ndarray, probs: np.ndarray) -> np.ndarray:
    at = np.arange(len(n)), n
    if ids.shape[1] <= UNSCALED:
        return np.log(_forward_short(ids, probs)[at])
    values, scales = forward(ids, probs)
    return np.log(np.maximum(values[at], 1e-300)) + scales[at]


def _expected_short(ids: np.ndarray, n: np.ndarray, counts: np.ndarray, probs: np.ndarray) -> tuple[np.ndarray, float]:
    words, ends, longest = ids.shape
    alpha = _forward_short(ids, probs)
    whole = alpha[np.arange(words), n]
    # beta begins with each word's count over its probability, so that products are expected counts.
    beta = np.zeros((words, ends))
    beta[np.arange(words), n] = counts / whole
    out = np.zeros(len(probs))
    for e in range(ends - 1, 0, -1):
        beta[:, e - 1] += UNKNOWN * beta[:, e]
        for k in range(min(longest, e)):
            at = ids[:, e, k]
            if at.any():
                more = probs[at] * beta[:, e]
                beta[:, e - 1 - k] += more
                out += np.bincount(at, alpha[:, e - 1 - k] * more, len(probs))
    out[0] = 0
    return out, float((np.log(whole) * counts).sum())


def expected(ids: np.ndarray, n: np.ndarray, counts: np.ndarray, probs: np.ndarray) -> tuple[np.ndarray, float]:
    """Expected count of each piece, from words of one language with their counts, and their log-likelihood."""
    if ids.shape[1] <= UNSCALED:
        return _expected_short(ids, n, counts, probs)
    words, ends, longest = ids.shape
    alpha, above = forward(ids, probs)
    stop = np.zeros((words, ends), bool)
    stop[np.arange(words), n] = True
    beta, below = _swept(ids, probs, range(ends - 1, -1, -1), lambda e: [(e + 1 + k, ids[:, e + 1 + k, k]) for k in range(min(longest, ends - 1 - e))], stop)
    last = np.arange(words), n
    whole = np.log(np.maximum(alpha[last], 1e-300)) + above[last]
    out = np.zeros(len(probs))
    for e in range(1, ends):
        for k in range(min(longest, e)):
            at = ids[:, e, k]
            if at.any():
                share = np.exp(np.minimum(above[:, e - 1 - k] + below[:, e] - whole, 700.0))
                out += np.bincount(at, alpha[:, e - 1 - k] * probs[at] * beta[:, e] * share * counts, len(probs))
    out[0] = 0
    return out, float((whole * counts).sum())


def word_counts(docs: DataFrame) -> DataFrame:
    """docs: _text, _lang. Counts of lang, word, combined in each task before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}

        def flush() -> pa.RecordBatch:
            rows = [(g, w, n) for g, c in held.items() for w, n in c.items()]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.string(), pa.int64()))], names=["lang", "word", "n"])

        for batch in batches:
            for part in slices(batch):
                for text, lang in zip(part.column("_text").to_pylist(), part.column("_lang").to_pylist(), strict=True):
                    held.setdefault(lang, Counter()).update(words_of(text))
                if sum(map(len, held.values())) > KEPT_WORDS:
                    yield flush()
        yield flush()

    return docs.select("_text", "_lang").mapInArrow(trimmed(run), "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, path: str, rounds: int = MOST_ROUNDS, most_languages: int = MOST_LANGUAGES) -> tuple[list[str], np.ndarray]:
    """docs: _text, _lang (non-null). The languages in order and probs[piece, language]."""
    found = docs.groupBy("_lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "_lang").limit(most_languages).collect()
    langs = sorted(r[0] for r in found)
    place = {lang: g for g, lang in enumerate(langs)}
    # Dealt evenly, for each round sweeps them all; words of like length stand together, so that lattices waste little.
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = written(word_counts(docs.where(F.col("_lang").isin(langs))).repartition(tasks).sortWithinPartitions("lang", F.length("word")), "word-counts")
    size = len(vocabulary(path)) + 1
    probs = np.zeros((size, len(langs)))
    for p, k in vocabulary(path).items():
        probs[k] = 32.0 ** -len(p)  # at first all characters alike
    was = -np.inf
    for _ in range(rounds if langs else 0):

        def run(batches: Iterator[pa.RecordBatch], now: np.ndarray = probs) -> Iterator[pa.RecordBatch]:
            # Piece 0 carries the log-likelihood.
            out = np.zeros((size, len(langs)))
            for batch in batches:
                for at in range(0, batch.num_rows, 10_000):
                    part = batch.slice(at, 10_000)
                    of, words, n = (part.column(c).to_pylist() for c in ("lang", "word", "n"))
                    for lang, rows in groupby(zip(of, words, n, strict=True), key=itemgetter(0)):  # sorted by language
                        g, mine = place[lang], {w: c for _, w, c in rows}
                        for some in blocks(list(mine)):
                            more, likely = expected(*lattice(some, path), np.array([mine[w] for w in some], float), now[:, g])
                            out[:, g] += more
                            out[0, g] += likely
            piece, g = np.nonzero(out)
            yield pa.RecordBatch.from_arrays([pa.array(piece.astype(np.int32)), pa.array(g.astype(np.int32)), pa.array(out[piece, g])], names=["piece", "lang", "n"])

        rows = counts.mapInArrow(trimmed(run), "piece int, lang int, n double").groupBy("piece", "lang").agg(F.sum("n").alias("n")).toArrow()
        new = np.zeros_like(probs)
        new[rows.column("piece").to_numpy(), rows.column("lang").to_numpy()] = rows.column("n").to_numpy()
        likely, new[0] = new[0].sum(), 0
        new[1:] += FLOOR
        probs = new / new.sum(axis=0)
        if likely - was < SETTLED * abs(likely):
            break
        was = likely
    drop_written(counts)
    return langs, probs


class Numbers(dict):
    """Word -> row; a new word gets the next one."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self.new.append(word)
        k = self[word] = len(self)
        return k


class Scorer:
    """Log-probabilities of words for each language; a worker remembers about KEPT_WORDS of them."""

    def __init__(self, path: str, probs: np.ndarray) -> None:
        self.path, self.probs, self.rows = path, probs, Numbers()
        self.logs = np.zeros((KEPT_WORDS, probs.shape[1]))

    def texts(self, texts: list[list[str]]) -> np.ndarray:
        """For each text, given as its words, the log-probability by language."""
        if len(self.rows) > KEPT_WORDS:
            self.rows = Numbers()
        at = [list(map(self.rows.__getitem__, words)) for words in texts]
        if len(self.rows) > len(self.logs):
            self.logs = np.concatenate([self.logs, np.zeros((len(self.rows) - len(self.logs), self.logs.shape[1]))])
        new = self.rows.new[:]
        self.rows.new.clear()
        for some in blocks(new):
            self.logs[[self.rows[w] for w in some]] = log_likelihoods(*lattice(some, self.path), self.probs)
        return np.array([self.logs[i].sum(axis=0) if i else np.zeros(self.logs.shape[1]) for i in at]).reshape(len(texts), -1)


def predict(docs: DataFrame, path: str, langs: list[str], probs: np.ndarray) -> DataFrame:
    """docs: _id, _text. Adds lang_pred and score, the probability of that language given equal priors."""
    model = docs.sparkSession.sparkContext.broadcast(probs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(path, model.value)
        for batch in batches:
            for part in slices(batch):
                words = [words_of(t) for t in part.column("_text").to_pylist()]
                if langs:
                    logs = scorer.texts(words)
                    best = logs.argmax(axis=1)
                    score = 1 / np.exp(logs - logs.max(axis=1, keepdims=True)).sum(axis=1)
                    names = [langs[b] if w else "und" for b, w in zip(best, words, strict=True)]
                    score = [float(s) if w else 0.0 for s, w in zip(score, words, strict=True)]
                else:
                    names, score = ["und"] * len(words), [0.0] * len(words)
                yield pa.RecordBatch.from_arrays([part.column("_id"), pa.array(names, pa.string()), pa.array(score, pa.float64())], names=["doc_id", "lang_pred", "score"])

    return docs.select("_id", "_text").mapInArrow(trimmed(run), "doc_id long, lang_pred string, score double")


def identify(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 3, held_out_fold: int = 1, rounds: int = MOST_ROUNDS, most_languages: int = MOST_LANGUAGES) -> DataFrame:
    """Learn from the documents whose crc32(id as text) mod ``folds`` isn't ``held_out_fold``; predict all.

    Returns doc_id, held_out, lang_pred, score.
    """
    held_out = F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == held_out_fold, F.lit(True))
    base = docs.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"), F.col(lang_col).alias("_lang"), held_out.alias("_held"))
    langs, probs = fit(base.where(~F.col("_held") & F.col("_lang").isNotNull()).select("_text", "_lang"), path, rounds, most_languages)
    made = predict(base, path, langs, probs)
    return made.select("doc_id", F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == held_out_fold, F.lit(True)).alias("held_out"), "lang_pred", "score")
