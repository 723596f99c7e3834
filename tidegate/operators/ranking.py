"""Row numbers inside groups that may be far larger than a task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F


def split_row_number(
    df: DataFrame, keys: list[str], bucket: Column, order: list, name: str
) -> DataFrame:
    """``row_number`` per ``keys`` in ``order``, computed per (keys, bucket) and
    shifted by the sizes of the earlier buckets. ``bucket`` must not decrease along
    the order; it spreads a hot group over tasks."""
    cut = "split_bucket"
    by = keys + [cut]
    rows = df.withColumn(cut, bucket)
    sizes = rows.select(*by).groupBy(*by).agg(F.count("*").alias("split_size"))
    earlier = W.partitionBy(*keys).orderBy(cut).rowsBetween(W.unboundedPreceding, -1)
    shifts = sizes.select(
        *by, F.coalesce(F.sum("split_size").over(earlier), F.lit(0)).alias("split_shift")
    )
    numbered = rows.withColumn(
        "split_rank", F.row_number().over(W.partitionBy(*by).orderBy(*order))
    )
    joined = null_safe_join(numbered, shifts, by, "inner")
    position = (F.col("split_rank") + F.col("split_shift")).cast("bigint")
    return joined.withColumn(name, position).drop(cut, "split_rank", "split_shift")


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Equi-join in which null keys meet each other, so that no row is lost."""
    other = right.withColumnsRenamed({k: f"right_{k}" for k in keys})
    same = [left[k].eqNullSafe(other[f"right_{k}"]) for k in keys]
    return left.join(other, same, how).drop(*[f"right_{k}" for k in keys])
