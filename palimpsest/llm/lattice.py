"""Vectors as exact integers, and small helpers of the operators that work on them."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Products of distances and dimensions stay below this, so every comparison is one of exact 64-bit integers.
EXACT = 1 << 62


def usable(vector: Column) -> Column:
    """Neither null nor with a null or non-finite component."""
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def whole_numbers(df: DataFrame, vec_col: str, scale: int, *kept: Column) -> DataFrame:
    """(kept columns, v): the usable vectors, each component x as floor(scale * x), x as double.

    A component whose squares could not be added exactly in 64 bits (from 2^24 on in 64
    dimensions, after scaling) stops the job with a message: it would wrap silently.
    """
    given = df.select(*kept, F.col(vec_col).cast("array<double>").alias("v")).filter(usable(F.col("v")))
    peak = F.coalesce(F.array_max(F.transform("v", F.abs)), F.lit(0.0)) * scale + 1
    numbers = F.transform("v", lambda x: F.floor(F.lit(float(scale)) * x).cast("int"))
    fits = peak * F.size("v") < float(math.isqrt(EXACT) // 2)
    return given.withColumn("v", F.when(fits, numbers).otherwise(F.raise_error(F.lit("a vector's component is too large for exact distances"))))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dim)


def squared(diff: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", diff, diff)


def smallest(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """The first n rows in this order.

    Each task passes on its own first n to one of as many groups as the root of the
    tasks' number, whose first n go to the last sort: no task meets all tasks' rows.
    """
    tasks = df.rdd.getNumPartitions()
    group = F.pmod(F.spark_partition_id(), F.lit(max(1, math.isqrt(tasks))))
    ranked = df.withColumn("_group", group)
    ranked = ranked.withColumn("_rank", F.row_number().over(Window.partitionBy("_group").orderBy(*order)))
    return ranked.filter(F.col("_rank") <= n).drop("_group", "_rank").orderBy(*order).limit(n)


def totals(parts: DataFrame, keys: list[str]) -> dict[tuple, int]:
    """Sums of `total` by key, added in 38 digits; as many rows as the model has numbers."""
    added = parts.groupBy(*keys).agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    return {tuple(row[k] for k in keys): int(row["total"]) for row in added}
