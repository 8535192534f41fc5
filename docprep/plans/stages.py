"""The three stages and their chain. Documents keep their rows until chunks must be told apart; only those shuffle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import HOUSE, House
from ..functions.text import count_words, let, n_words
from ..operators import chunk, clean, deliver, diagnose, gates, report, tables, validate
from ..operators.state import ordinals, stem
from ..sources.connectors import Backend, Extractor, call_model, call_once, offline, page_arrays, page_rows, plain_pages, read_arrays


def native_markdown(pages: Column) -> Column:
    """SRC2, TBL1-3: page texts, each followed by its table; tables that continue on the next page are merged."""
    merged = tables.merge_in_row(F.transform(pages, lambda p: p["first_table"]))

    def with_table(text: Column, table: Column) -> Column:
        return F.transform(F.array(tables.to_markdown(table)), lambda md: F.when(F.trim(md) != "", F.concat(text, F.lit("\n\n"), md)).otherwise(text))[0]

    return let(merged, lambda found: F.array_join(F.transform(pages, lambda p, i: with_table(F.coalesce(p["text"], F.lit("")), F.get(found, i))), "\n\n"))


def ocr_markdown(texts: Column, title: Column) -> Column:
    """SRC7: a title, and cleaned page texts with a rule after each."""
    return F.concat(F.lit("# "), title, F.lit("\n\n"), F.array_join(F.transform(texts, lambda t: F.concat(t, F.lit("\n\n---\n\n"))), ""))


def _extractors(extractor: Extractor, raw: Extractor | None, vision: Extractor | None, local_ocr: Extractor | None) -> tuple[dict[str, Extractor], list[str]]:
    """Extractors by method, and the methods of a second try."""
    found = {"raw": raw or extractor, "native": extractor, "native_fallback": extractor}
    found |= dict.fromkeys(("ocr_gemini", "ocr_gemini_retry"), vision) if vision else {}
    found |= dict.fromkeys(("ocr_tess_fallback", "ocr", "ocr_retry"), local_ocr) if local_ocr else {}
    return found, [m for m in ("ocr_gemini_retry", "ocr_retry") if m in found]


def _texts(d: DataFrame) -> DataFrame:
    """Adds ocr, n_pages, text and ok_pages from pages and method."""
    d = d.withColumns({"ocr": F.coalesce(F.startswith("method", F.lit("ocr")), F.lit(False)), "n_pages": F.coalesce(F.size("pages"), F.lit(0))})
    d = d.withColumn("cleaned", F.when(F.col("ocr"), F.transform("pages", lambda p: clean.clean_markdown(F.coalesce(p["text"], F.lit(""))))))
    text = F.when(F.col("ocr"), ocr_markdown(F.col("cleaned"), stem(F.col("file_name")))).otherwise(native_markdown(F.col("pages")))
    return d.withColumns({"text": F.coalesce(text, F.lit("")), "ok_pages": F.coalesce(F.size(F.filter("cleaned", lambda t: gates.page_has_text(t))), F.lit(0))}).drop("cleaned", "pages")


def _low() -> Column:
    """FLT6: whether a file's first text covers so little that it is read again."""
    before = gates.coverage(F.lit(False), F.lit(0), F.lit(1), count_words(clean.text_only(F.col("text"))), F.col("raw_words"))
    return gates.retry(count_words(F.col("text")), before, F.col("raw_words")) & F.col("error").isNull() & F.col("raw_error").isNull()


def _rated(docs: DataFrame) -> DataFrame:
    """Cleaned texts with their coverage and status."""
    docs = docs.select("file_name", clean.clean_markdown(F.col("text")).alias("text"), F.coalesce("method", F.lit("error")).alias("method"), "raw_words", count_words(F.col("text")).alias("md_words"), "ocr", "ok_pages", "n_pages", F.coalesce("raw_error", "error").alias("error"))
    share = F.round(gates.coverage(F.col("ocr"), F.col("ok_pages"), F.col("n_pages"), count_words(clean.text_only(F.col("text"))), F.col("raw_words")), 1)
    docs = docs.withColumn("coverage", F.when(F.col("error").isNotNull(), 0.0).otherwise(share)).withColumn("status", gates.rating(F.col("ocr"), F.col("coverage"), F.col("md_words"), F.col("error")))
    words = F.when(F.col("ocr"), F.col("n_pages")).otherwise(F.col("raw_words"))
    return docs.select("file_name", "text", "method", words.cast("long").alias("raw_words"), "md_words", "coverage", "status", "error")


_READING = ("method", "error", "text", "ok_pages", "n_pages", "ocr")


def convert(files: DataFrame, extractor: Extractor = plain_pages, raw: Extractor | None = None, vision: Extractor | None = None, local_ocr: Extractor | None = None) -> DataFrame:
    """Stage 1: file_name, content -> file_name, text, method, raw_words, md_words, coverage, status, error.

    extractor gives pages as Markdown, with tables if it finds any; raw gives the text
    layer (by default as extractor does) against which coverage is measured. A
    scanned file goes to vision, to local_ocr if that fails or isn't there, and to
    extractor if neither is; a file with very low coverage is tried with OCR again,
    and keeps its first text if that fails. Each file stays in its row: no step shuffles.
    A file is opened once for all of this, and its bytes go to Python again only for that second try.
    """
    found, again = _extractors(extractor, raw, vision, local_ocr)
    docs = read_arrays(files.select("file_name", "content"), found, gates.SCANNED_WORDS, keep=bool(again))
    layer = F.array_join(F.transform("layer", lambda t: F.coalesce(t, F.lit(""))), "\n")
    docs = _texts(docs.withColumn("raw_words", F.coalesce(count_words(layer), F.lit(0))).drop("layer"))
    if again:
        docs = docs.select("file_name", "content", "raw_words", "raw_error", *(F.col(c).alias(f"first_{c}") for c in _READING), F.when(_low(), F.array(*map(F.lit, again))).alias("tries"))
        docs = _texts(page_arrays(docs.withColumn("content", F.when(F.col("tries").isNotNull(), F.col("content"))), found))
        better = F.col("tries").isNotNull() & F.col("error").isNull()
        docs = docs.select("file_name", "raw_words", "raw_error", *(F.when(better, F.col(c)).otherwise(F.col(f"first_{c}")).alias(c) for c in _READING))
    return _rated(docs)


def convert_by_page(files: DataFrame, work: str, extractor: Extractor = plain_pages, raw: Extractor | None = None, vision: Extractor | None = None, local_ocr: Extractor | None = None) -> DataFrame:
    """As ``convert``, by a table of pages: no row holds the pages of a whole file before its text is put together.

    The table is written to the folder ``work`` (pages, and again for second tries), so a file is opened once however often the result is read;
    pages meet by file in one shuffle of their texts, without the files' bytes. Use it where files have very many pages; file names are unique.
    """
    spark = files.sparkSession
    found, again = _extractors(extractor, raw, vision, local_ocr)

    def kept(rows: DataFrame, name: str) -> DataFrame:
        rows.write.mode("overwrite").parquet(f"{work}/{name}")
        return spark.read.schema(rows.schema).parquet(f"{work}/{name}")

    def gathered(rows: DataFrame) -> DataFrame:
        own, layer = F.col("layer") == "page", F.col("layer") == "raw"
        page = F.struct("page_no", F.struct("text", "first_table").alias("p"))
        pages = F.transform(F.array_sort(F.collect_list(F.when(own & (F.col("page_no") > 0), page))), lambda x: x["p"])
        found_ = rows.groupBy("file_name").agg(
            F.coalesce(F.sum(F.when(layer, count_words(F.col("text")))), F.lit(0)).alias("raw_words"), F.max(F.when(layer, F.col("error"))).alias("raw_error"),
            pages.alias("pages"), F.max(F.when(own, F.col("method"))).alias("method"), F.max(F.when(own, F.col("error"))).alias("error"),
        )
        return _texts(found_.withColumn("pages", F.when(F.col("error").isNull() & F.col("raw_error").isNull(), F.col("pages"))))

    docs = gathered(kept(page_rows(files, found, gates.SCANNED_WORDS), "pages"))
    if again:
        low = docs.where(_low()).select(F.col("file_name").alias("_name"))
        more = files.join(low, F.col("file_name").eqNullSafe(F.col("_name")), "left_semi")
        better = gathered(kept(page_rows(more, found, gates.SCANNED_WORDS, again), "again")).where("error IS NULL")
        better = better.select(F.col("file_name").alias("_name"), *(F.col(c).alias(f"new_{c}") for c in _READING), F.lit(True).alias("_new"))
        docs = docs.join(better, F.col("file_name").eqNullSafe(F.col("_name")), "left")
        docs = docs.select("file_name", "raw_words", "raw_error", *(F.when(F.col("_new"), F.col(f"new_{c}")).otherwise(F.col(c)).alias(c) for c in _READING))
    return _rated(docs)


#: Fixed value: most tokens of an answer in stage 1.5.
REFINE_TOKENS = 16_000
ANSWER = ("content", "tokens_in", "tokens_out", "model", "error")


def refine_questions(docs: DataFrame, house: House = HOUSE) -> tuple[DataFrame, DataFrame]:
    """Documents that need no refining, and the questions to the model for the chunks of the rest.

    The questions' rows carry their document's reason and number of words, so nothing is joined back.
    """
    judged = docs.select("file_name", "text").withColumn("reason", gates.refine_reason(F.col("text"), stem(F.col("file_name")), house))
    bad = judged.where("reason <> 'limpio'").select("file_name", "reason", n_words(F.col("text")).alias("words_in"), chunk.windows(F.col("text")).alias("_chunks"))
    rows = bad.select("file_name", "reason", "words_in", F.size("_chunks").cast("long").alias("n_chunks"), F.posexplode("_chunks").alias("chunk_idx", "chunk")).withColumn("chunk_idx", F.col("chunk_idx").cast("long"))
    prompt = deliver.refine_prompt(stem(F.col("file_name")), (F.col("chunk_idx") + 1).cast("int"), F.col("n_chunks").cast("int"), F.col("chunk"))
    return judged.where("reason = 'limpio'"), rows.withColumns({"prompt": prompt, "max_tokens": F.lit(REFINE_TOKENS)}).drop("chunk")


def refine(
    docs: DataFrame, system: str = "", backend: Backend = offline, house: House = HOUSE, saved: DataFrame | None = None, state: str | None = None, steps: int = 1, join: Callable[[Column], Column] = chunk.join_parts, **calls
) -> DataFrame:
    """Stage 1.5: file_name, text -> file_name, text, status, reason, tokens. Clean documents never reach the model.

    saved: file_name, chunk_idx, content, tokens_in, tokens_out, model of chunks that need not be asked for again.
    state: a folder in which answers are kept from run to run, in ``steps`` parts; with it no chunk is asked for twice.
    join: how the answers of a document's chunks become its text, ``chunk.join_parts`` or ``chunk.join_windows``.
    calls: in_flight, attempts and wait, as for ``call_model``.
    """
    good, rows = refine_questions(docs, house)
    good = good.select("file_name", "text", "reason", F.lit("COPY").alias("status"), F.lit(0).cast("long").alias("chunks"), F.lit(0).cast("long").alias("tokens_in"), F.lit(0).cast("long").alias("tokens_out"), F.lit(None).cast("string").alias("model"), F.lit(100.0).alias("retention_pct"))
    about = ("file_name", "reason", "words_in", "chunk_idx")
    if saved is not None:
        kept = saved.select(*(F.col(c).alias(f"_{c}") for c in ("file_name", "chunk_idx")), *(c for c in ANSWER if c != "error"))
        same = rows["file_name"].eqNullSafe(F.col("_file_name")) & (rows["chunk_idx"] == F.col("_chunk_idx"))
        kept = rows.select(*about).join(kept, same).withColumn("error", F.lit(None).cast("string")).select(*about, *ANSWER)
        rows = rows.join(saved.select(F.col("file_name").alias("_file_name"), F.col("chunk_idx").alias("_chunk_idx")), same, "left_anti")
    asked = (call_once(rows, state, system, backend, False, steps, **calls) if state else call_model(rows, system, backend, False, **calls)).select(*about, *ANSWER)
    answers = asked if saved is None else asked.unionByName(kept)
    parts = F.transform(F.array_sort(F.collect_list(F.struct("chunk_idx", "content"))), lambda x: x["content"])
    same = [F.first(c).alias(c) for c in ("reason", "words_in")]
    folded = answers.groupBy("file_name").agg(*same, parts.alias("p"), F.count("*").alias("chunks"), F.sum("tokens_in").alias("tokens_in"), F.sum("tokens_out").alias("tokens_out"), F.max_by("model", "chunk_idx").alias("model"), F.max("error").alias("error"))
    folded = folded.withColumn("text", join(F.col("p")))
    kept_share = gates.retention(F.col("words_in"), n_words(F.col("text")), F.col("chunks"))
    done = folded.withColumns(kept_share).withColumn("status", F.when(F.col("error").isNotNull(), "ERROR").otherwise(F.col("status")))
    return good.unionByName(done.select(good.columns))


def build(
    docs: DataFrame, system: str = "", backend: Backend = offline, project: str = "", date: str | None = None, strict: bool = True, house: House = HOUSE, model: str = "offline", state: str | None = None, steps: int = 1, names: DataFrame | None = None, **calls
) -> DataFrame:
    """Stage 2: file_name, text -> one row for each document with its final text and name, checks, price, parameters and delivery report.

    Documents are numbered in the order of their names (WIN7), and the number is part of the final name
    (NAM1). strict: the rule set of a publisher's documents as well. What a text lacks and the caveats it
    shows stand in its report (SNK5); ``report.global_report`` takes these rows as they are.
    names: file_name of the list whose order numbers documents, by default docs; numbering reads it once more, so
    pass it where docs come from a model whose answers aren't kept. state, steps, calls: as for refine.
    """
    day = F.lit(date) if date else F.date_format(F.current_date(), "yyyy-MM-dd")
    cleaned = docs.select("file_name", clean.strip_needless(clean.preclean(F.col("text"))["text"])["text"].alias("text"))
    planned = diagnose.decide(diagnose.diagnose(cleaned))
    part = F.when(F.col("n_chunks") > 1, F.format_string("%d/%d", (F.col("chunk_idx") + 1).cast("int"), F.col("n_chunks").cast("int"))).otherwise("")
    plan = [c for c in planned.columns if c not in ("text", "justification")]
    pieces = planned.select(*plan, chunk.tree(F.col("text")).alias("pieces"))
    rows = pieces.select(*plan, F.size("pieces").cast("long").alias("n_chunks"), F.posexplode("pieces").alias("chunk_idx", "chunk"))
    rows = rows.withColumns({"prompt": deliver.build_prompt(F.col("chunk"), F.lit(project), day, part), "max_tokens": deliver.max_tokens(F.col("chunk"))}).drop("chunk")
    answers = call_once(rows, state, system, backend, True, steps, **calls) if state else call_model(rows, system, backend, **calls)
    parts = F.transform(F.array_sort(F.collect_list(F.struct("chunk_idx", "content"))), lambda x: x["content"])
    same = [F.first(c).alias(c) for c in plan if c != "file_name"]
    made = answers.groupBy("file_name").agg(*same, parts.alias("p"), F.sum("tokens_in").alias("tokens_in"), F.sum("tokens_out").alias("tokens_out"), F.max_by("model", "chunk_idx").alias("model_used"), F.max("error").alias("error"))
    made = made.withColumn("text", clean.drop_preamble(clean.unwrap_fence(F.array_join("p", "\n\n")))).drop("p")
    checked = validate.validate(made, strict=strict, house=house).withColumns({"caveat_ids": gates.caveats(F.col("text"), house), "split": clean.split_gaps(F.col("text"))})
    checked = checked.withColumns(
        {
            "text": F.col("split.text"), "gaps": F.col("split.gaps"), "status": F.when(F.col("error").isNotNull(), "ERROR").otherwise(F.col("state")),
            "cost": deliver.cost(F.lit(model), F.col("tokens_in"), F.col("tokens_out")), "n_issues": F.size("issues"), **deliver.retrieval(F.col("project_type")),
        }
    ).drop("split", "state")
    places = ordinals((docs if names is None else names).select("file_name").distinct(), name="place").select(F.col("file_name").alias("_name"), "place")
    named = checked.join(places, F.col("file_name").eqNullSafe(F.col("_name")), "left").drop("_name")
    named = named.withColumn("file_final", deliver.output_name(F.coalesce(stem(F.col("file_name")), F.lit("")), F.col("place").cast("int")))
    return named.withColumn("report", report.delivery_text("file_final", F.col("gaps"), F.col("caveat_ids"), house.notes))


def run_all(
    files: DataFrame | None = None, skip_refine: bool = False, only: str | None = None, source: DataFrame | None = None, dry_run: bool = False, state: str | None = None,
    steps: int = 1, in_flight: int = 1, attempts: int = 1, wait: float = 1.0, **options
) -> DataFrame:
    """PIP10: stages 1, 1.5 and 2; ``only`` stops after that stage ("1" or "1.5").

    source: file_name, text of documents that are there already, for use where there
    are no files. dry_run: what stage 2 would do with each document, and no call.
    state: a folder for the answers of both stages. steps, in_flight, attempts, wait: as for refine.
    """
    docs = convert(files) if files is not None else source
    if docs is None:
        raise ValueError("files or source must be given")
    if only == "1":
        return docs
    if dry_run:
        planned = diagnose.decide(diagnose.diagnose(docs.select("file_name", clean.preclean(F.col("text"))["text"].alias("text"))))
        return planned.select("file_name", "strategy", "project_type", "entity_len", F.floor(F.col("text_chars") / 4).cast("long").alias("tokens"), deliver.cost(F.lit(options.get("model", "offline")), F.floor(F.col("text_chars") / 4), F.floor(F.col("text_chars") / 4)).alias("cost"))
    calls = {"steps": steps, "in_flight": in_flight, "attempts": attempts, "wait": wait}
    names = (files if files is not None else source).select("file_name")
    if not skip_refine:
        docs = refine(docs, state=f"{state}/refine" if state else None, **calls)
    return docs if only == "1.5" else build(docs, state=f"{state}/build" if state else None, names=names, **calls, **options)
