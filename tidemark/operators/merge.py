"""Merges as plain joins: upsert, insert-if-absent, partial and conditional updates."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.dedup import latest_per_key


def upsert(
    target: DataFrame, staging: DataFrame, keys: list[str], newer_by: str | None = None
) -> DataFrame:
    """Rows of ``staging`` replace rows of ``target`` with the same key, by one aggregate over both.

    Either side has unique keys, none of them null. With ``newer_by`` a staged row that is older than
    the stored one is left out, so that a replay cannot undo newer state.
    """
    both = target.withColumn("_staged", F.lit(False)).unionByName(
        staging.select(*target.columns).withColumn("_staged", F.lit(True))
    )
    order = ["_staged"] if newer_by is None else [newer_by, "_staged"]
    return latest_per_key(both, keys, order, drop=("_staged",))


def insert_absent(target: DataFrame, staging: DataFrame, keys: list[str]) -> DataFrame:
    """The staged rows whose key is not in ``target`` yet; append them."""
    return staging.join(target.select(*keys), keys, "left_anti")


def patch_columns(
    target: DataFrame,
    patch: DataFrame,
    keys: list[str],
    columns: list[str],
    defaults: Mapping[str, Column],
) -> DataFrame:
    """Upsert that sets only ``columns``; new rows take ``defaults`` for the rest."""
    there = target.withColumn("_there", F.lit(True)).alias("t")
    given = patch.select(*keys, *columns).withColumn("_given", F.lit(True)).alias("p")
    joined = there.join(given, keys, "full")

    def value(name: str) -> Column:
        if name in keys:
            return F.col(name)
        if name in columns:
            return F.when(F.col("_given"), F.col(f"p.{name}")).otherwise(F.col(f"t.{name}"))
        fresh = defaults.get(name, F.lit(None))
        return F.when(F.col("_there"), F.col(f"t.{name}")).otherwise(fresh)

    return joined.select(*[value(c).alias(c) for c in target.columns])


def update_where(
    target: DataFrame, condition: Column, assignments: Mapping[str, Column]
) -> DataFrame:
    """Set columns on the rows that meet the condition; all other rows stay."""
    hit = F.coalesce(condition, F.lit(False))
    return target.select(
        *[
            F.when(hit, assignments[c]).otherwise(F.col(c)).alias(c) if c in assignments else F.col(c)
            for c in target.columns
        ]
    )


def update_by_key(
    target: DataFrame, patch: DataFrame, keys: list[str], assignments: Mapping[str, Column]
) -> DataFrame:
    """Update rows named by ``patch``.

    Assignments see both sides, the target as ``t`` and the patch as ``p``.
    """
    given = patch.withColumn("_given", F.lit(True)).alias("p")
    joined = target.alias("t").join(given, keys, "left")

    def value(name: str) -> Column:
        if name in keys:
            return F.col(name)
        if name in assignments:
            return F.when(F.col("_given"), assignments[name]).otherwise(F.col(f"t.{name}"))
        return F.col(f"t.{name}")

    return joined.select(*[value(c).alias(c) for c in target.columns])
