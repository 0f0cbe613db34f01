"""Integer vectors and their classes, shared by the exact searches.

Rows that can take no part are left out here, by one rule: a null id, a null or empty vector, a null or non-finite component, or a component
beyond ±LARGEST (scores would leave 64 bits).  Rows that repeat id and vector count once.  Vectors of different lengths have no inner product.

Equal vectors score alike against anything, and ties go to the smaller id; so a search for the best k rows needs no more
than the k smallest ids of every class of equal vectors.  A vector that a third of all rows share is one class with a few ids.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LARGEST = 65_536.0
#: The two hashes that stand for a vector in joins (128 bits).
KEY = ["_h1", "_h2"]


def usable(vec: Column) -> Column:
    """Vectors that take part; false for null ones."""
    inside = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) <= F.lit(LARGEST)))
    return F.coalesce((F.size(vec) > 0) & inside, F.lit(False))


def integer_rows(rows: DataFrame, id_col: str, vec_col: str, scale: int, *others: Column) -> DataFrame:
    """``_id``, ``_v`` (floor of ``scale`` times every component), ``_h1``, ``_h2`` and ``others`` of the rows that take part."""
    vec = F.transform(F.col(vec_col), lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("int"))
    taken = rows.where(usable(F.col(vec_col)) & F.col(id_col).isNotNull())
    whole = taken.select(F.col(id_col).alias("_id"), vec.alias("_v"), *others)
    hashes = {"_h1": F.xxhash64("_v"), "_h2": F.xxhash64(F.lit(1), F.reverse("_v"))}
    return whole.withColumns(hashes).distinct()


def classes(rows: DataFrame, keep: int, *by: str) -> DataFrame:
    """One row per different vector (and ``by``): ``_v``, its hashes and ``_ids``, its ``keep`` smallest ids in order.

    Every map task passes on at most ``keep`` rows of a class (the rank limit is pushed below the shuffle).
    """
    key = [*by, *KEY, "_v"]
    rank = F.row_number().over(Window.partitionBy(*key).orderBy("_id"))
    first = rows.withColumn("_rank", rank).where(F.col("_rank") <= keep)
    return first.groupBy(*key).agg(F.array_sort(F.collect_list("_id")).alias("_ids"))


def matrices(batch: pa.RecordBatch, col: str = "_v") -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix) for every vector length of a batch."""
    column = batch.column(batch.schema.get_field_index(col))
    offsets = column.offsets.to_numpy()
    values = column.values.to_numpy()
    size = np.diff(offsets)
    for d in np.unique(size):
        at = np.flatnonzero(size == d)
        yield at, values[offsets[at][:, None] + np.arange(d)]


def exact_type(a: np.ndarray, b: np.ndarray) -> type:
    """The number type in which inner products of rows of two integer matrices are exact: doubles if they stay below 2**53."""
    top = [int(np.abs(x.astype(np.int64)).max(initial=0)) for x in (a, b)]
    return np.float64 if a.shape[1] * top[0] * top[1] < 1 << 53 else np.int64


def best(owner: np.ndarray, score: np.ndarray, first_id: np.ndarray, keep: int) -> np.ndarray:
    """Row numbers of the ``keep`` best per owner: higher scores first, ties to the smaller id."""
    order = np.lexsort((first_id, -score, owner))
    own = owner[order]
    start = np.flatnonzero(np.r_[True, own[1:] != own[:-1]]) if len(own) else np.zeros(0, dtype=np.int64)
    place = np.arange(len(own)) - np.repeat(start, np.diff(np.r_[start, len(own)]))
    return order[place < keep]
