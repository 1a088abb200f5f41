"""Versioned rows: build, suppress repeats, apply increments, read as of an instant."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from tidemark.operators.dedup import latest_per_key
from tidemark.operators.neighbours import with_neighbours

# Seconds of history per key that one window group may hold.
SLICE_SECONDS = 1_000_000

VALIDITY = ("_valid_from", "_valid_to", "_is_current")


def one_per_instant(
    frame: DataFrame, key: str, version: str, arrival: list[str], drop: tuple[str, ...] = ()
) -> DataFrame:
    """One row per key and instant: the last arrival wins."""
    return latest_per_key(frame, [key, version], arrival, drop)


def changes_only(
    frame: DataFrame, key: str, version: str, digest: str = "_hash", width: int = SLICE_SECONDS
) -> DataFrame:
    """Drop versions whose digest equals that of the version before."""
    marked = with_neighbours(frame, [key], version, width, previous={"_seen": digest})
    return marked.where(~F.col(digest).eqNullSafe(F.col("_seen"))).drop("_seen")


def build_history(
    frame: DataFrame, key: str = "id", version: str = "updated_at", width: int = SLICE_SECONDS
) -> DataFrame:
    """Validity of every version: from its own instant up to that of the next one."""
    linked = with_neighbours(frame, [key], version, width, following={"_next": version})
    return linked.withColumns(
        {
            "_valid_from": F.timestamp_seconds(version),
            "_valid_to": F.timestamp_seconds("_next"),
            "_is_current": F.col("_next").isNull(),
        }
    ).drop("_next")


def apply_history(
    existing: DataFrame,
    staging: DataFrame,
    key: str = "id",
    version: str = "updated_at",
    width: int = SLICE_SECONDS,
) -> DataFrame:
    """Existing history plus staged versions, late ones included.

    A staged version with the instant of an existing one replaces it. The result
    equals a rebuild from all versions, so applying twice changes nothing.
    """
    versions = (
        existing.drop(*VALIDITY)
        .withColumn("_staged", F.lit(False))
        .unionByName(staging.withColumn("_staged", F.lit(True)))
    )
    return build_history(
        one_per_instant(versions, key, version, ["_staged"], drop=("_staged",)), key, version, width
    )


def as_of(history: DataFrame, instant: datetime | int) -> DataFrame:
    """The version of every key that was valid at an instant (Unix seconds or datetime)."""
    moment = F.timestamp_seconds(F.lit(instant)) if isinstance(instant, int) else F.lit(instant)
    return history.where(
        (F.col("_valid_from") <= moment)
        & (F.col("_valid_to").isNull() | (moment < F.col("_valid_to")))
    )
