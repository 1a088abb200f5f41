"""Control-table queries and updates: batch selection, work resolution, checkpoints, replays."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.columns import page_path
from tidemark.operators.dedup import latest_per_key, oldest_per_key
from tidemark.operators.merge import patch_columns, update_by_key, update_where
from tidemark.spec import EntitySpec

# Fixed value: message of runs that ended without saying so.
ORPHAN_REASON = "Interrupted unexpectedly (orphan run recovered at startup)"


# -- batch selection ---------------------------------------------------------------


def landed(batches: DataFrame, table_name: str | None = None) -> DataFrame:
    """Successful raw batches that hold records."""
    picked = batches.where(
        (F.col("layer") == "RAW") & (F.col("status") == "SUCCESS") & (F.col("records_count") > 0)
    )
    return picked if table_name is None else picked.where(F.col("table_name") == table_name)


def batch_refs(batches: DataFrame, entity: str | Column) -> DataFrame:
    """References to landed pages, with the path derived from day, cursor and offset."""
    path = page_path(entity, F.col("created_at"), F.col("cursor_value"), F.col("offset_value"))
    return batches.select("batch_id", path.alias("path"), "cursor_value", "offset_value", "created_at")


def batches_after(
    batches: DataFrame, table_name: str, last_batch_id: int = 0, limit: int | None = None
) -> DataFrame:
    """Batches not consumed yet, in order."""
    picked = landed(batches, table_name).where(F.col("batch_id") > last_batch_id).orderBy("batch_id")
    return picked if limit is None else picked.limit(limit)


def batches_in_window(
    batches: DataFrame, table_name: str, start: int, end: int, limit: int | None = None
) -> DataFrame:
    """Batches whose cursor lies in (start, end], in order."""
    cursor = F.col("cursor_value")
    picked = landed(batches, table_name).where((cursor > start) & (cursor <= end)).orderBy("batch_id")
    return picked if limit is None else picked.limit(limit)


def pages_overlapping(batches: DataFrame, table_name: str, start: int, end: int) -> DataFrame:
    """Landed pages whose records may lie in [start, end], by the least and greatest version logged.

    Pages logged without these are judged by their cursor: a page holds no version below it.
    """
    known = F.col("first_version").isNotNull() & F.col("last_version").isNotNull()
    overlap = (F.col("last_version") >= start) & (F.col("first_version") <= end)
    return landed(batches, table_name).where(F.when(known, overlap).otherwise(F.col("cursor_value") <= end))


def latest_batch(batches: DataFrame) -> DataFrame:
    """The most recent landed batch of every table."""
    return latest_per_key(landed(batches), ["table_name"], ["created_at", "batch_id"])


def latest_snapshot_batches(batches: DataFrame) -> DataFrame:
    """All landed batches of the run that wrote the most recent one, per table."""
    newest = latest_batch(batches).select("table_name", "run_id")
    return landed(batches).join(newest, ["table_name", "run_id"], "left_semi")


# -- work resolution ---------------------------------------------------------------


def registry(spark: SparkSession, specs: Iterable[EntitySpec]) -> DataFrame:
    rows = [(s.name, s.path.strip("/"), s.start, s.full_load) for s in specs]
    return spark.createDataFrame(
        rows, "table_name string, path string, start bigint, full_load boolean"
    )


def pending_replays(events: DataFrame, layer: str) -> DataFrame:
    """Waiting replays of a layer, oldest first."""
    return events.where((F.col("status") == "PENDING") & (F.col("layer") == layer)).orderBy(
        "created_at", "event_id"
    )


def next_replay(events: DataFrame, layer: str) -> DataFrame:
    """The oldest waiting replay of every table."""
    waiting = events.where((F.col("status") == "PENDING") & (F.col("layer") == layer))
    return oldest_per_key(waiting, ["table_name"], ["created_at", "event_id"])


def resolve_work(
    tables: DataFrame, events: DataFrame, checkpoints: DataFrame, layer: str
) -> DataFrame:
    """What to do next per table: a waiting replay first, else go on from the checkpoint.

    All three inputs hold one row per table after their own reduction.
    """
    replay = next_replay(events, layer).select("table_name", "event_id", "start_watermark", "end_watermark")
    mark = checkpoints.where(F.col("layer") == layer).select(
        "table_name", "current_watermark", "last_id", "last_batch_id", "offset_val"
    )
    replaying = F.col("event_id").isNotNull()
    onward = F.when(F.col("current_watermark") > 0, F.col("current_watermark")).otherwise(F.col("start"))

    def unless_replay(name: str) -> Column:
        return F.when(replaying, 0).otherwise(F.coalesce(F.col(name), F.lit(0))).cast("long")

    return (
        tables.join(replay, "table_name", "left")
        .join(mark, "table_name", "left")
        .select(
            "table_name",
            F.when(replaying, F.col("start_watermark")).otherwise(onward).alias("start_watermark"),
            "end_watermark",
            replaying.alias("is_fallback"),
            "event_id",
            unless_replay("last_batch_id").alias("last_batch_id"),
            unless_replay("last_id").alias("last_id"),
            unless_replay("offset_val").alias("offset_val"),
        )
    )


# -- progress ----------------------------------------------------------------------


def high_water_mark(frame: DataFrame, marks: DataFrame, version: str, *by: str) -> DataFrame:
    """Greatest version per table, never below the mark before.

    ``marks`` has (by, previous); a table without new rows keeps its mark.
    """
    seen = frame.groupBy(*by).agg(F.max(version).alias("_seen"))
    return marks.join(seen, list(by), "left").select(
        *by, F.greatest(F.coalesce("_seen", "previous"), F.col("previous")).alias("watermark")
    )


def batch_progress(batches: DataFrame) -> DataFrame:
    """Greatest batch id and record total of the landed batches, per table."""
    return (
        landed(batches)
        .groupBy("table_name")
        .agg(F.max("batch_id").alias("last_batch_id"), F.sum("records_count").alias("records"))
    )


# -- updates -----------------------------------------------------------------------


def checkpoint_upsert(checkpoints: DataFrame, state: DataFrame) -> DataFrame:
    """Set the progress of (table, layer); the safety mark stays unless ``state`` brings one."""
    columns = [
        "current_watermark",
        "last_id",
        "last_batch_id",
        "offset_val",
        "last_successful_run_id",
        "is_override_active",
        "updated_at",
    ]
    if "fallback_watermark" in state.columns:
        columns.append("fallback_watermark")
    if "is_override_active" not in state.columns:
        state = state.withColumn("is_override_active", F.lit(False))
    return patch_columns(
        checkpoints,
        state,
        ["table_name", "layer"],
        columns,
        {"checkpoint_id": F.concat_ws(":", "table_name", "layer"), "fallback_watermark": F.lit(0).cast("long")},
    )


def safety_mark_upsert(checkpoints: DataFrame, marks: DataFrame) -> DataFrame:
    """Set only the safety mark of (table, layer)."""
    zero = F.lit(0).cast("long")
    return patch_columns(
        checkpoints,
        marks,
        ["table_name", "layer"],
        ["fallback_watermark", "updated_at"],
        {
            "checkpoint_id": F.concat_ws(":", "table_name", "layer"),
            "current_watermark": zero,
            "last_id": zero,
            "last_batch_id": zero,
            "offset_val": zero,
            "is_override_active": F.lit(False),
        },
    )


def fail_orphan_runs(runs: DataFrame, at: datetime | Column, reason: str = ORPHAN_REASON) -> DataFrame:
    """Close runs that still say RUNNING."""
    moment = at if isinstance(at, Column) else F.lit(at)
    return update_where(
        runs,
        F.col("status") == "RUNNING",
        {"completed_at": moment, "status": F.lit("FAILED"), "error_message": F.lit(reason)},
    )


def complete_runs(runs: DataFrame, outcome: DataFrame) -> DataFrame:
    """Close runs named by ``outcome`` (run_id, status, error_message, completed_at)."""
    return update_by_key(
        runs,
        outcome,
        ["run_id"],
        {c: F.col(f"p.{c}") for c in ("status", "error_message", "completed_at")},
    )


def replay_status(events: DataFrame, patch: DataFrame) -> DataFrame:
    """Move replays on: the record count adds up, the end is set only when done.

    ``patch`` has (event_id, status, records_processed, error_message, at).
    """
    done = F.col("p.status").isin("COMPLETED", "FAILED")
    return update_by_key(
        events,
        patch,
        ["event_id"],
        {
            "status": F.col("p.status"),
            "records_processed": F.coalesce(F.col("t.records_processed"), F.lit(0))
            + F.col("p.records_processed"),
            "error_message": F.col("p.error_message"),
            "completed_at": F.when(done, F.col("p.at")).otherwise(F.col("t.completed_at")),
        },
    )


def set_override(
    checkpoints: DataFrame,
    table_name: str,
    at: datetime | Column,
    mark: int | None = None,
    active: bool = True,
) -> DataFrame:
    """Set the override flag, and the safety mark if given, on all layers of a table."""
    moment = at if isinstance(at, Column) else F.lit(at)
    changes = {"is_override_active": F.lit(active), "updated_at": moment}
    if mark is not None:
        changes["fallback_watermark"] = F.lit(mark).cast("long")
    return update_where(checkpoints, F.col("table_name") == table_name, changes)
