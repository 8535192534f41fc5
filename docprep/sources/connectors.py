"""Page extractors and model backends behind one small interface.

A backend is a picklable callable ``(system, user, max_tokens) -> (content,
tokens_in, tokens_out, model)``; it runs inside mapInArrow, so calls are made
in the tasks, so many at a time in each, and a call that fails for good becomes an
error row, not a lost job.
"""

from __future__ import annotations

import json
import os
import re
import threading
import time
import urllib.error
import urllib.request
from collections import deque
from collections.abc import Callable, Iterator
from concurrent.futures import Future, ThreadPoolExecutor
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf
from pyspark.sql.types import ArrayType, StringType, StructType

from ..operators.clean import OWN_BYTES, WINDOWS_BYTES, MISREAD

_MISREAD, _AS_BYTES = re.compile(f"(?:{MISREAD})+"), str.maketrans(WINDOWS_BYTES, OWN_BYTES)
Backend = Callable[[str, str, int], tuple[str, int, int, str]]
RETRY_TOKENS = 32_000
_ENDS = re.compile(r"[.!?#-]\Z")


def is_cut(content: str) -> bool:
    last = content.rstrip()
    return not last or not _ENDS.search(last[-1])


def offline(system: str, user: str, max_tokens: int) -> tuple[str, int, int, str]:
    """Rule-based stand-in: repairs misread UTF-8 run by run, drops [n] marks and page numbers, keeps all the rest."""
    text = _MISREAD.sub(lambda m: m[0].translate(_AS_BYTES).encode("latin-1").decode(), user.split("\n\n", 1)[-1])
    text = re.sub(r"\[\d+\]", "", text)
    text = re.sub(r"(?m)^\s*\d+\s*$\n?", "", text)
    return text.strip() + ("" if _ENDS.search(text.strip()[-1:] or " ") else "."), len(user) // 4, len(text) // 4, "offline"


class Http:
    """A chat-completions endpoint with fallback models. The key is sent to the tasks with the backend, and is in no column and no plan."""

    def __init__(self, url: str, key: str, models: list[str], temperature: float = 0.1, timeout: int = 300, pause: float = 0.0) -> None:
        self.url, self.key, self.models, self.temperature, self.timeout, self.pause = url, key, models, temperature, timeout, pause

    def __repr__(self) -> str:
        return f"Http({self.url!r}, {self.models!r})"

    def __call__(self, system: str, user: str, max_tokens: int) -> tuple[str, int, int, str]:
        messages = [{"role": "system", "content": system}, {"role": "user", "content": user}]
        body = {"model": self.models[0], "models": self.models, "temperature": self.temperature, "max_tokens": max_tokens, "messages": messages}
        request = urllib.request.Request(self.url, json.dumps(body).encode(), {"Authorization": f"Bearer {self.key}", "Content-Type": "application/json"})
        with urllib.request.urlopen(request, timeout=self.timeout) as answer:
            got = json.load(answer)
        time.sleep(self.pause)
        usage = got.get("usage") or {}
        return got["choices"][0]["message"].get("content") or "", usage.get("prompt_tokens", 0), usage.get("completion_tokens", 0), got.get("model", self.models[0])


def secret(name: str, file: str = ".env") -> str:
    """SRC16: a secret from the driver's environment, or else from a file of NAME=value lines."""
    if name in os.environ:
        return os.environ[name]
    if os.path.isfile(file):
        with open(file, encoding="utf-8") as lines:
            for line in lines:
                key, sign, value = line.strip().removeprefix("export ").partition("=")
                if sign and key.strip() == name:
                    return value.strip().strip("\"'")
    raise KeyError(f"{name} is neither in the environment nor in {file}")


def read_prompt(spark: SparkSession, path: str) -> str:
    """SRC12: a prompt file as one text, from any file system that Spark reads."""
    return spark.read.text(path, wholetext=True).first()[0]


#: Kinds of errors of a call: too many requests, a server or network that may recover, and what no second call changes.
LIMIT, BUSY, FINAL = "limit", "busy", "final"


def kind_of(error: Exception) -> tuple[str, float | None]:
    """The kind of an error, and the seconds after which the server wants to be asked again, if it says so."""
    if isinstance(error, urllib.error.HTTPError):
        after = (error.headers or {}).get("Retry-After", "")
        return LIMIT if error.code == 429 else BUSY if error.code in (408, 425) or error.code >= 500 else FINAL, float(after) if str(after).isdigit() else None
    return BUSY if isinstance(error, (urllib.error.URLError, TimeoutError, ConnectionError)) else FINAL, None


class Caller:
    """Calls of one task: at most ``in_flight`` at a time, each asked again while its error is one that may pass.

    After the k-th failure a call waits ``wait`` * 2^k seconds, or as long as the server says; where
    the server finds that there are too many, all calls of the task wait.
    """

    def __init__(self, backend: Backend, system: str, retry_cut: bool, attempts: int, wait: float) -> None:
        self.backend, self.system, self.retry_cut, self.attempts, self.wait = backend, system, retry_cut, attempts, wait
        self.lock, self.not_before = threading.Lock(), 0.0

    def ask(self, prompt: str, most: int) -> tuple[str, int, int, str]:
        for k in range(self.attempts):
            time.sleep(max(0.0, self.not_before - time.monotonic()))
            try:
                return self.backend(self.system, prompt, most)
            except Exception as e:
                kind, after = kind_of(e)
                if kind == FINAL or k + 1 == self.attempts:
                    raise
                pause = self.wait * 2**k if after is None else after
                if kind == LIMIT:
                    with self.lock:
                        self.not_before = max(self.not_before, time.monotonic() + pause)
                else:
                    time.sleep(pause)
        raise ValueError("attempts must be 1 at least")

    def answer(self, prompt: str | None, most: int) -> tuple:
        """content, tokens_in, tokens_out, model, truncated, error."""
        try:
            content, a, b, model = self.ask(prompt or "", most)
            if self.retry_cut and is_cut(content) and most < RETRY_TOKENS:
                content, a2, b2, model = self.ask(prompt or "", RETRY_TOKENS)
                a, b = a + a2, b + b2
            return content, a, b, model, is_cut(content), None
        except Exception as e:  # the row carries it
            return None, 0, 0, None, None, f"{type(e).__name__}: {e}"


#: Columns of an answer, and rows that a task gives out at once.
_ANSWER = (("content", "string", pa.string()), ("tokens_in", "long", pa.int64()), ("tokens_out", "long", pa.int64()), ("model", "string", pa.string()), ("truncated", "boolean", pa.bool_()), ("error", "string", pa.string()))
PART = 32


def call_model(rows: DataFrame, system: str, backend: Backend = offline, retry_cut: bool = True, in_flight: int = 1, attempts: int = 1, wait: float = 1.0) -> DataFrame:
    """SRC13-14: rows with prompt and max_tokens, and content, tokens_in, tokens_out, model, truncated, error.

    An answer that looks cut is asked for again with the largest limit, if the first was
    smaller. All columns of rows stay, and their order. Each task has ``in_flight`` calls
    under way, whatever the bounds of Arrow batches, and holds no more than those and
    ``PART`` further rows; so as many calls run as there are tasks times ``in_flight``. attempts, wait: see ``Caller``.
    """
    schema = StructType([*rows.schema.fields])
    for name, kind, _ in _ANSWER:
        schema = schema.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        caller, pool = Caller(backend, system, retry_cut, attempts, wait), ThreadPoolExecutor(in_flight)
        waiting: deque[tuple[pa.RecordBatch, list[Future]]] = deque()

        def first() -> pa.RecordBatch:
            part, calls = waiting.popleft()
            made = [c.result() for c in calls]
            return pa.RecordBatch.from_arrays([*part.columns, *(pa.array([r[i] for r in made], t) for i, (_, _, t) in enumerate(_ANSWER))], names=schema.names)

        try:
            for batch in batches:
                for at in range(0, batch.num_rows, PART):
                    part = batch.slice(at, PART)
                    waiting.append((part, [pool.submit(caller.answer, p, m) for p, m in zip(part.column("prompt").to_pylist(), part.column("max_tokens").to_pylist(), strict=True)]))
                    while len(waiting) > 1 and sum(len(c) for _, c in waiting) >= in_flight + PART:
                        yield first()
            while waiting:
                yield first()
        finally:  # a task that is stopped makes no further calls
            pool.shutdown(wait=False, cancel_futures=True)

    return rows.mapInArrow(run, schema)


#: Of an answer that is kept: its chunk and how many its file has, a fingerprint of what was asked, and the bucket of its file.
_SAVED = "file_name string, chunk_idx long, n_chunks long, asked long, content string, tokens_in long, tokens_out long, model string, truncated boolean, error string, bucket int"
_KEYS = ["file_name", "chunk_idx", "asked"]
BUCKETS = 64


def _exists(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def read_answers(spark: SparkSession, folder: str) -> DataFrame:
    """SRC15: the answers that ``ask_missing`` has kept; none where the folder isn't there. Parts that can't be read count as not there."""
    if not _exists(spark, folder):
        return spark.createDataFrame([], _SAVED)
    return spark.read.schema(_SAVED).option("ignoreCorruptFiles", True).parquet(folder)


def _same(a: DataFrame, b: DataFrame) -> Column:
    return reduce(lambda x, y: x & y, (a[k].eqNullSafe(b[f"_{k}"]) for k in _KEYS))


def _best(answers: DataFrame) -> DataFrame:
    """Of the answers to one question the one that counts: without error if there is one."""
    row = F.struct(F.col("error").isNotNull().alias("failed"), "content", "tokens_in", "tokens_out", "model", "truncated", "error", "n_chunks")
    return answers.groupBy(*_KEYS, "bucket").agg(F.min(row).alias("a"))


def with_question(rows: DataFrame, system: str) -> DataFrame:
    """rows with the fingerprint of what is asked, and the bucket of their file."""
    n = F.col("n_chunks").cast("long") if "n_chunks" in rows.columns else F.lit(None).cast("long")
    made = rows.withColumns({"chunk_idx": F.col("chunk_idx").cast("long"), "n_chunks": n, "asked": F.xxhash64(F.lit(system), "prompt", "max_tokens")})
    return made.withColumn("bucket", F.pmod(F.xxhash64("file_name"), F.lit(BUCKETS)).cast("int"))


def ask_missing(rows: DataFrame, folder: str, system: str, backend: Backend = offline, retry_cut: bool = True, steps: int = 1, **calls) -> None:
    """SNK7: asks for what has no answer in ``folder`` yet, and keeps the answers there.

    rows (file_name, chunk_idx, prompt, max_tokens) are asked for in ``steps`` parts by their file's bucket, each
    kept before the next one begins, so that a run that ends early loses one part at most;
    a part reads only the answers of its own buckets. Keys may be null. calls: as for ``call_model``.
    """
    spark, asked = rows.sparkSession, with_question(rows, system)
    for k in range(min(steps, BUCKETS)):
        own = F.col("bucket").isin(*range(k, BUCKETS, min(steps, BUCKETS)))
        part = asked.where(own)
        done = read_answers(spark, folder).where(own & F.col("error").isNull()).select(*(F.col(c).alias(f"_{c}") for c in _KEYS))
        todo = part.join(done, _same(part, done), "left_anti").select(*_KEYS, "n_chunks", "bucket", "prompt", "max_tokens")
        made = call_model(todo, system, backend, retry_cut, **calls).drop("prompt", "max_tokens")
        made.write.mode("append").partitionBy("bucket").parquet(folder)


def compact_answers(spark: SparkSession, folder: str) -> None:
    """Rewrites kept answers as one file a bucket, without those that no longer count.

    The new files are there before the old ones go, and an answer that is there twice counts once, so a
    run that ends in between loses nothing; files that come meanwhile stay.
    """
    if not _exists(spark, folder):
        return
    kept = read_answers(spark, folder)
    old = kept.inputFiles()
    _best(kept).select(*_KEYS, "a.*", "bucket").drop("failed").repartition("bucket").write.mode("append").partitionBy("bucket").parquet(folder)
    for name in old:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, False)


def call_once(rows: DataFrame, folder: str, system: str, backend: Backend = offline, retry_cut: bool = True, steps: int = 1, **calls) -> DataFrame:
    """SNK7, JN3: as call_model, but answers are kept in ``folder`` and read back from there.

    What has an answer, to the same question, isn't asked for again, whatever reads the
    result how often; errors are asked for again by the next run. steps, calls: as for ``ask_missing``.
    """
    ask_missing(rows, folder, system, backend, retry_cut, steps, **calls)
    asked = with_question(rows, system)
    best = _best(read_answers(rows.sparkSession, folder)).select(*(F.col(c).alias(f"_{c}") for c in _KEYS), "a")
    return asked.join(best, _same(asked, best)).select(*(asked[c] for c in rows.columns), *(F.col(f"a.{c}").alias(c) for c, *_ in _ANSWER))


def plain_pages(content: bytes) -> list[str]:
    """Stand-in page extractor: a text file with form feeds between pages."""
    return (content or b"").decode("utf-8", "replace").split("\f")


def extract_pages(files: DataFrame, extractor: Callable[[bytes], list[str]] = plain_pages) -> DataFrame:
    """SRC2-3: file_name, page_no (from 1), text. A file that fails has one page number 0 with the error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("file_name").to_pylist(), batch.column("content").to_pylist(), strict=True):
                try:
                    pages, error = extractor(content), None
                except Exception as e:  # the row carries it
                    pages, error = [], f"{type(e).__name__}: {e}"
                rows = list(enumerate(pages, 1)) or [(0, "")]
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(rows)), pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.string()), pa.array([error] * len(rows), pa.string())], names=["file_name", "page_no", "text", "error"])

    return files.select("file_name", "content").mapInArrow(run, "file_name string, page_no int, text string, error string")


#: A page is its text, or its text and its tables, of which the first is kept.
Page = str | tuple[str, list[list[list[str | None]]]]
Extractor = Callable[[bytes], list[Page]]
_PAGES = pa.list_(pa.struct([("text", pa.string()), ("first_table", pa.list_(pa.list_(pa.string())))]))


def page_arrays(files: DataFrame, extractors: dict[str, Extractor]) -> DataFrame:
    """SRC2, SRC4, SRC7: files (content, tries) with the columns pages, method and error; rows stay where they are.

    tries names extractors in order; the first that doesn't fail gives the pages. If
    all fail the error is the last one's, and the method ``error``. Without tries all three are null.
    """
    page = StructType().add("text", StringType()).add("first_table", ArrayType(ArrayType(StringType())))
    schema = StructType([*files.schema.fields]).add("pages", ArrayType(page)).add("method", "string").add("error", "string")

    def one(content: bytes | None, tries: list[str] | None) -> tuple[list[dict] | None, str | None, str | None]:
        error = None
        for method in tries or []:
            try:
                made = [(p, []) if isinstance(p, str) else p for p in extractors[method](content)]
                return [{"text": t, "first_table": tables[0] if tables else None} for t, tables in made], method, None
            except Exception as e:  # the next extractor's turn, or the row carries it
                error = f"{type(e).__name__}: {e}"
        return None, "error" if error else None, error

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                pages, method, error = one(row.column("content")[0].as_py(), row.column("tries")[0].as_py())
                yield pa.RecordBatch.from_arrays([*row.columns, pa.array([pages], _PAGES), pa.array([method], pa.string()), pa.array([error], pa.string())], names=schema.names)

    return files.mapInArrow(run, schema)


Read = tuple[list[str] | None, str | None, list[dict] | None, str | None, str | None]
_WORD = re.compile(r"\w+")


def _made(pages: list[Page]) -> list[dict]:
    both = [(p, []) if isinstance(p, str) else p for p in pages]
    return [{"text": t, "first_table": tables[0] if tables else None} for t, tables in both]


def read_once(content: bytes | None, found: dict[str, Extractor], least: float) -> Read:
    """All that one opening of a file gives: texts of the text layer, its error, pages, method and error.

    found: extractors by method, of which ``raw`` reads the text layer. A file with fewer than ``least`` words a page in it is
    scanned: it is read with OCR, as far as there is any, and by the plain extractor else (RTE1). An extractor that reads the text layer as well is called once.
    """
    try:
        layer = list(found["raw"](content))
    except Exception as e:  # the row carries it
        return None, f"{type(e).__name__}: {e}", None, None, None
    texts = [p["text"] or "" for p in _made(layer)]
    scanned = not texts or sum(len(_WORD.findall(t)) for t in texts) / len(texts) < least
    second = "ocr_tess_fallback" if "ocr_tess_fallback" in found else "native_fallback"
    order = ["native"] if not scanned else ["ocr_gemini", second] if "ocr_gemini" in found else ["ocr"] if "ocr" in found else ["native_fallback"]
    error = None
    for method in order:
        try:
            return texts, None, _made(layer if found[method] is found["raw"] else list(found[method](content))), method, None
        except Exception as e:  # the next extractor's turn, or the row carries it
            error = f"{type(e).__name__}: {e}"
    return texts, None, None, "error", error


def read_arrays(files: DataFrame, found: dict[str, Extractor], least: float, keep: bool = True) -> DataFrame:
    """SRC2-4, SRC7: files (content) with the columns layer, raw_error, pages, method and error; rows stay where they are, and each file is opened once. keep: whether its bytes go on."""
    page = StructType().add("text", StringType()).add("first_table", ArrayType(ArrayType(StringType())))
    names = [c for c in files.columns if keep or c != "content"]
    schema = StructType([files.schema[c] for c in names]).add("layer", ArrayType(StringType())).add("raw_error", "string").add("pages", ArrayType(page)).add("method", "string").add("error", "string")
    kinds = (pa.list_(pa.string()), pa.string(), _PAGES, pa.string(), pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                got = read_once(row.column("content")[0].as_py(), found, least)
                yield pa.RecordBatch.from_arrays([*(row.column(c) for c in names), *(pa.array([v], k) for v, k in zip(got, kinds, strict=True))], names=schema.names)

    return files.mapInArrow(run, schema)


#: A page of a file's text layer (``raw``) or of what was read (``page``); number 0 has no text, and stands for the layer or reading as such.
PAGE_ROWS = "layer string, page_no int, text string, first_table array<array<string>>, method string, error string"


def page_rows(files: DataFrame, found: dict[str, Extractor], least: float, tries: list[str] | None = None) -> DataFrame:
    """SRC2-4 as a table function, joined laterally: file_name and ``PAGE_ROWS``, a row for each page, so no row holds a whole file's pages.

    tries: methods to read with, in order, in place of those that the text layer asks for; then there are no ``raw`` rows.
    """

    @udtf(returnType=PAGE_ROWS)
    class Pages:
        def eval(self, content: bytes) -> Iterator[tuple]:
            if tries is None:
                texts, raw_error, pages, method, error = read_once(content, found, least)
                yield "raw", 0, None, None, None, raw_error
                for i, t in enumerate(texts or [], 1):
                    yield "raw", i, t, None, None, None
            else:
                pages, method, error = None, None, None
                for name in tries:
                    try:
                        pages, method, error = _made(list(found[name](content))), name, None
                        break
                    except Exception as e:  # the next extractor's turn, or the row carries it
                        method, error = "error", f"{type(e).__name__}: {e}"
            yield "page", 0, None, None, method, error
            for i, p in enumerate(pages or [], 1):
                yield "page", i, p["text"], p["first_table"], method, None

    return files.select("file_name", "content").lateralJoin(Pages(F.col("content").outer())).select("file_name", *(c.split()[0] for c in PAGE_ROWS.split(", ")))


def assemble_pages(parts: DataFrame, separator: str = "\n\n") -> DataFrame:
    """SRC7, CHK7: page texts in order, by file."""
    pages = F.transform(F.array_sort(F.collect_list(F.struct("page_no", "text"))), lambda p: p["text"])
    return parts.groupBy("file_name").agg(pages.alias("p"), F.count("*").alias("n_pages")).select("file_name", F.array_join("p", separator).alias("text"), "n_pages")
