"""Vectors of a table as whole numbers, for the operators on embeddings."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Entries of an integer vector are below this, so that they are exact as doubles.
LARGEST = 2.0**52


def whole_vectors(df: DataFrame, shift: int = 0, id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, int]:
    """(_id long, _x array of longs floor(1024 * entry) + shift), and the number of entries; other columns are left out.

    A row takes no part if its vector is null or empty, or holds a null, an
    entry that isn't finite or one whose whole number is ``LARGEST`` or more, or
    if its length isn't the one that most such rows have (of equally many, the longest).
    """
    raw = df.select(F.col(id_col).cast("long").alias("_id"), F.col(vector_col).alias("_v"))
    fits = F.forall("_v", lambda c: F.coalesce(~F.isnan(c) & (F.abs(c.cast("double")) * 1024 < LARGEST - abs(shift) - 1), F.lit(False)))
    good = raw.where(F.col("_v").isNotNull() & (F.size("_v") > 0)).where(fits)
    usual = good.groupBy(F.size("_v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    d = usual["d"] if usual else 0
    x = F.transform("_v", lambda c: F.floor(c.cast("double") * 1024).cast("long") + F.lit(shift).cast("long"))
    return good.where(F.size("_v") == d).select("_id", x.alias("_x")), d


def matrix(batch: pa.RecordBatch, d: int, column: str = "_x") -> np.ndarray:
    """The rows of an Arrow batch as an integer matrix."""
    return batch.column(column).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
