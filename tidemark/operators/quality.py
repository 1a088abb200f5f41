"""Data quality checks. Each returns a frame, so that the caller decides what fails."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def null_keys(frame: DataFrame, key: str = "id") -> DataFrame:
    """One row: all rows and rows without a key. A frame without the column has no key at all."""
    missing = F.col(key).isNull() if key in frame.columns else F.lit(True)
    return frame.agg(F.count(F.lit(1)).alias("rows"), F.count_if(missing).alias("null_keys"))


def required_nulls(frame: DataFrame, required: list[str]) -> DataFrame:
    """Null count per required field, from one pass."""
    counted = frame.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
    pairs = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("nulls")) for c in required])
    return counted.select(F.inline(pairs))


def duplicate_keys(frame: DataFrame, keys: list[str]) -> DataFrame:
    """Keys held by more than one row."""
    return (
        frame.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)
    )


def history_violations(frame: DataFrame, key: str = "id", start: str = "_valid_from") -> DataFrame:
    """Keys whose history is broken: not exactly one current row, or a start that repeats."""
    per_start = frame.groupBy(key, start).agg(
        F.count(F.lit(1)).alias("n"), F.count_if("_is_current").alias("current")
    )
    return (
        per_start.groupBy(key)
        .agg(F.sum("current").alias("current_rows"), F.count_if(F.col("n") > 1).alias("repeated_starts"))
        .where((F.col("current_rows") != 1) | (F.col("repeated_starts") > 0))
    )


def orphans(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child keys without a parent, with their row count.

    Counting first leaves one row per key for the join, so a hot key is no burden.
    """
    counted = child.groupBy(F.col(child_key).alias("key")).agg(F.count(F.lit(1)).alias("rows"))
    return counted.where(F.col("key").isNotNull()).join(
        parent.select(F.col(parent_key).alias("key")), "key", "left_anti"
    )
