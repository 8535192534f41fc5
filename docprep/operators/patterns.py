"""Catalogues of patterns as tables: which of very many literal patterns a text contains."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of patterns that one automaton takes; a larger catalogue is matched in so many passes.
AUTOMATON_BYTES = 16 << 20
#: Ids after which a task gives out the rows that hold them.
MOST_IDS = 100_000


def _prepared(patterns: DataFrame, id_col: str, pattern_col: str) -> DataFrame:
    return patterns.select(F.col(id_col).cast("string").alias("_i"), F.lower(pattern_col).alias("_p")).where("_i IS NOT NULL AND _p IS NOT NULL").distinct()


def matcher(own: pa.Table) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """own: patterns _p and the ids of each. For mapInArrow over (row, low, ids): adds the ids of the patterns that ``low`` contains; rows go out as soon as they hold ``MOST_IDS`` ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        patterns, lists = own.column("_p").to_pylist(), own.column("ids").combine_chunks()
        flat, ends = lists.flatten(), np.cumsum([0, *pc.list_value_length(lists).to_pylist()])
        names = pc.unique(flat)
        names = names.take(pc.sort_indices(names))
        codes = pc.index_in(flat, value_set=names).to_numpy(zero_copy_only=False)
        owner = np.repeat(np.arange(len(patterns)), np.diff(ends))
        words, always = ahocorasick.Automaton(), np.zeros(len(patterns), bool)
        for k, p in enumerate(patterns):
            if p:
                words.add_word(p, k)
            else:
                always[k] = True
        del patterns
        if len(words):
            words.make_automaton()

        def hits(text: str) -> np.ndarray:
            """Places in names, in order."""
            seen = always.copy()
            if len(words):
                seen[np.fromiter((k for _, k in words.iter(text)), np.int64)] = True
            ids = np.zeros(len(names), bool)
            ids[codes[seen[owner]]] = True
            return np.flatnonzero(ids)

        def with_own(text: str | None, found: pa.Scalar) -> pa.Array:
            if text is None:
                return found.values
            new = names.take(pa.array(hits(text)))
            if not len(found.values):
                return new
            both = pc.unique(pa.concat_arrays([found.values, new]))
            return both.take(pc.sort_indices(both))

        for batch in batches:
            low, made, held, start = batch.column("low"), [], 0, 0
            for i in range(batch.num_rows):
                made.append(with_own(low[i].as_py(), batch.column("ids")[i]))
                held += len(made[-1])
                if i + 1 == batch.num_rows or held >= MOST_IDS:
                    part = batch.slice(start, i + 1 - start)
                    out = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, made)]), pa.int32()), pa.concat_arrays(made))
                    yield pa.RecordBatch.from_arrays([part.column("row"), part.column("low"), out], names=["row", "low", "ids"])
                    made, held, start = [], 0, i + 1

    return run


def caveats_from(docs: DataFrame, patterns: DataFrame, text: str = "text", id_col: str = "caveat_id", pattern_col: str = "pattern", into: str = "caveat_ids") -> DataFrame:
    """JN6, FLT7 by a table of patterns: docs with the sorted ids of the caveats of which a pattern stands in the text, in lower case.

    The patterns become one automaton, which reads a text once however many there are; documents stay
    where they are. A catalogue of more than ``AUTOMATON_BYTES``, which is checked, is split by hash
    into parts of about that size, and documents pass from one part's automaton to the next.
    A null text has no caveats; an empty pattern stands in every text; null ids and patterns don't count; a
    pattern may belong to several ids. Letters are folded by Spark's ``lower`` on both sides.
    """
    own = _prepared(patterns, id_col, pattern_col)
    size = own.agg(F.sum(F.octet_length("_p") + F.octet_length("_i"))).first()[0] or 0
    parts = max(1, -(-size // AUTOMATON_BYTES))
    out = docs.select(F.struct("*").alias("row"), F.lower(text).alias("low"), F.array().cast("array<string>").alias("ids"))
    for k in range(parts):
        part = own.where(F.pmod(F.xxhash64("_p"), F.lit(parts)) == k)
        out = out.mapInArrow(matcher(part.groupBy("_p").agg(F.collect_set("_i").alias("ids")).toArrow()), out.schema)
    return out.select("row.*", F.col("ids").alias(into))
