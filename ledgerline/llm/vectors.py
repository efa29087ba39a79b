"""Vectors as tables: which take part, and which are the same."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def usable(table: DataFrame, id_col: str, vector_col: str, zero: bool) -> DataFrame:
    """vec_id, v (array of doubles) and width: vectors that are not null and hold finite numbers only; zero ones if wanted.

    Equal rows (id and vector) come once; null ids take no part. Vectors of different lengths have no distance or product:
    each is to meet those of its own length (width).
    """
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")).where("vec_id is not null and size(v) > 0")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(finite)
    if not zero:
        rows = rows.where(F.exists("v", lambda x: x != 0))
    return rows.withColumn("width", F.size("v")).distinct()


def distinct_vectors(rows: DataFrame, most: int, salts: int = 64) -> DataFrame:
    """One row per distinct vector: its least id as `first`, v, and its `most` least ids.

    Equal vectors are thinned in two steps, so one vector that fills a third of the table is dealt to many tasks.
    """
    near = Window.partitionBy("v", F.pmod(F.xxhash64("vec_id"), F.lit(salts))).orderBy("vec_id")
    whole = Window.partitionBy("v").orderBy("vec_id")
    few = rows.withColumn("nth", F.row_number().over(near)).where(F.col("nth") <= most)
    few = few.withColumn("nth", F.row_number().over(whole)).where(F.col("nth") <= most)
    return few.groupBy("v").agg(F.min("vec_id").alias("first"), F.array_sort(F.collect_list("vec_id")).alias("ids"))


def matrix(column: pa.ChunkedArray | pa.Array, kind=np.float64) -> np.ndarray:
    """A list column whose rows are equally long, as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(n, -1) if n else np.zeros((0, 0), kind)
