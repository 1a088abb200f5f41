"""Latest row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def latest_per_key(
    frame: DataFrame, keys: list[str], order: list[str | Column], drop: tuple[str, ...] = ()
) -> DataFrame:
    """The greatest row of every key under ``order``; a null in the order loses.

    The aggregate keeps one row per key and task before the shuffle, so a key
    that holds a large share of the rows sends one row per task, not its rows.
    """
    rank = F.struct(*[F.col(c) if isinstance(c, str) else c for c in order])
    rest = [c for c in frame.columns if c not in keys and c not in drop]
    if not rest:
        return frame.select(*keys).distinct()
    best = frame.groupBy(*keys).agg(F.max_by(F.struct(*rest), rank).alias("_row"))
    back = [c for c in frame.columns if c not in drop]
    return best.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in back])


def oldest_per_key(frame: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The smallest row of every key under ``order``."""
    rest = [c for c in frame.columns if c not in keys]
    best = frame.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return best.select(
        *[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in frame.columns]
    )


def dedup_records(
    frame: DataFrame,
    key: str = "id",
    version: str = "updated_at",
    arrival: tuple[str, ...] = (),
) -> DataFrame:
    """Newest version of every key.

    Equal versions go to the later arrival, then to the greater content, so the
    result does not depend on the order of the input. A frame without the key is
    returned as it is; one without the version column keeps the last arrival.
    """
    if key not in frame.columns:
        return frame
    order: list[str | Column] = [c for c in (version, *arrival) if c in frame.columns]
    order.append(F.col("_hash") if "_hash" in frame.columns else _content(frame, key))
    return latest_per_key(frame, [key], order)


def _content(frame: DataFrame, key: str) -> Column:
    return F.sha2(F.to_json(F.struct(*[c for c in frame.columns if c != key])), 256)
