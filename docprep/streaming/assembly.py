"""Documents put together from the answers to their chunks as these arrive, in any order and over any number of batches.

State is kept by file: which chunks are answered, with their texts, and how many there
are. When the last one comes the document goes out and its texts leave the state; a
marker stays for a while, so that late copies give nothing new. A file whose chunks
don't all come within ``patience_s`` is reported by a timer, with what is missing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..config import HOUSE, House
from ..operators import chunk
from ..plans.stages import refine_questions
from ..sources.connectors import Backend, ask_missing, offline

ANSWERS = "file_name string, chunk_idx long, n_chunks long, content string, tokens_in long, tokens_out long, model string, error string"
ASSEMBLED = "file_name string, state string, parts array<string>, chunks long, tokens_in long, tokens_out long, model string, missing array<long>"
COMPLETE, STUCK = "COMPLETE", "STUCK"
_EMPTY_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Assembler(StatefulProcessor):
    """Answers of one file to its parts in order. An answer with an error isn't one; of several to one chunk the first counts."""

    def __init__(self, patience_s: float, remember_s: float) -> None:
        self.patience, self.remember = int(patience_s * 1000), int(remember_s * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.parts = handle.getMapState("parts", "chunk_idx long", "content string, tokens_in long, tokens_out long, model string")
        self.open = handle.getValueState("open", "n_chunks long, answered long")
        self.done = handle.getValueState("done", "at long", ttlDurationMs=self.remember)

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        now = timerValues.getCurrentProcessingTimeInMs()
        if self.done.exists():
            return
        total, answered = self.open.get() if self.open.exists() else (None, 0)
        if total is None:
            self.handle.registerTimer(now + self.patience)
        for r in rows:
            total = r.n_chunks if total is None else total
            if r.error is None and not self.parts.containsKey((r.chunk_idx,)):
                self.parts.updateValue((r.chunk_idx,), (r.content, r.tokens_in, r.tokens_out, r.model))
                answered += 1
        if answered < total:
            self.open.update((total, answered))
            return
        found = [self.parts.getValue((k,)) for k in range(total)]
        yield Row(file_name=key[0], state=COMPLETE, parts=[p[0] for p in found], chunks=total, tokens_in=sum(p[1] for p in found), tokens_out=sum(p[2] for p in found), model=found[-1][3], missing=[])
        self.forget(now)

    def forget(self, now: int) -> None:
        self.parts.clear()
        self.open.clear()
        for at in list(self.handle.listTimers()):
            self.handle.deleteTimer(at)
        self.done.update((now,))

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        if not self.open.exists():
            return
        total, answered = self.open.get()
        missing = [k for k in range(total) if not self.parts.containsKey((k,))]
        yield Row(file_name=key[0], state=STUCK, parts=None, chunks=answered, tokens_in=None, tokens_out=None, model=None, missing=missing)

    def close(self) -> None:
        pass


def assembled(answers: DataFrame, join: Callable[[Column], Column] = chunk.join_parts, patience_s: float = 3600.0, remember_s: float = 7 * 86400.0) -> DataFrame:
    """file_name, state, text, chunks, tokens_in, tokens_out, model, missing: a row for each document that is complete, or that is stuck.

    answers: a stream of ``ANSWERS``; join: as for ``plans.stages.refine``. A stuck document is reported
    once, and given out when it is complete after all. Texts are kept in a state store on disk.
    """
    answers.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKS)
    made = answers.select(*(c.split()[0] for c in ANSWERS.split(", "))).groupBy("file_name").transformWithState(Assembler(patience_s, remember_s), ASSEMBLED, "Append", "ProcessingTime")
    return made.select("file_name", "state", join(F.col("parts")).alias("text"), "chunks", "tokens_in", "tokens_out", "model", "missing")


def watch_answers(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """The answers that ``ask_missing`` keeps, as they come."""
    return spark.readStream.schema(ANSWERS).option("maxFilesPerTrigger", files_per_batch).option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").parquet(folder)


def ask_new(docs: DataFrame, folder: str, checkpoint: str, system: str = "", backend: Backend = offline, house: House = HOUSE, **calls) -> StreamingQuery:
    """Asks the model about the chunks of new documents that need refining (docs: a stream of file_name, text), and keeps the answers in ``folder``.

    A batch that is run again, after a failure or from its checkpoint, asks only for what has no answer. calls: as for ``ask_missing``.
    """

    def each(batch: DataFrame, number: int) -> None:
        ask_missing(refine_questions(batch, house)[1], folder, system, backend, False, **calls)

    return docs.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def write_assembled(documents: DataFrame, target: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Assembled documents as a Parquet table; once over what is there, or with ``every`` ("1 minute") from then on.

    Timers run with each batch. A run that is to end takes only batches that have rows, as
    a stateful query with timers else waits for the next one for ever.
    """
    out = documents.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).outputMode("append")
    if every:
        return out.trigger(processingTime=every).start()
    conf = documents.sparkSession.conf
    before = conf.get(_EMPTY_BATCHES)
    conf.set(_EMPTY_BATCHES, "false")
    try:
        return out.trigger(availableNow=True).start()
    finally:
        conf.set(_EMPTY_BATCHES, before)
