"""Governance queries over the control tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.columns import elapsed_seconds
from tidemark.spec import CHANGED_COLUMNS

# How many names a drift summary spells out, and its empty text.
SUMMARY_NAMES = 3
NO_CHANGE = "Initial Snapshot / Unchanged"


def dashboard_stats(
    runs: DataFrame,
    checkpoints: DataFrame,
    batches: DataFrame,
    history: DataFrame,
    events: DataFrame,
) -> DataFrame:
    """Eight figures in one row; each control table is read once."""
    rows = F.count(F.lit(1))
    parts = [
        runs.agg(
            rows.alias("total_runs"),
            F.count_if(F.col("status") == "COMPLETED").alias("successful_runs"),
            F.count_if(F.col("status") == "FAILED").alias("failed_runs"),
        ),
        checkpoints.agg(
            rows.alias("total_tables"), F.count_if("is_override_active").alias("active_overrides")
        ),
        batches.agg(
            F.coalesce(F.sum("records_count"), F.lit(0)).cast("long").alias("total_records_ingested")
        ),
        history.agg(rows.alias("total_schema_changes")),
        events.agg(F.count_if(F.col("status") == "PENDING").alias("pending_fallbacks")),
    ]
    names = [c for p in parts for c in p.columns]
    together = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return together.agg(*[F.max(c).alias(c) for c in names])


def runs_history(runs: DataFrame, limit: int = 50) -> DataFrame:
    """Most recent runs with their duration in whole seconds."""
    return (
        runs.orderBy(F.col("started_at").desc(), F.col("run_id").asc())
        .limit(limit)
        .select(
            "run_id",
            "started_at",
            "completed_at",
            "layer",
            "status",
            "error_message",
            elapsed_seconds(F.col("started_at"), F.col("completed_at")).alias("duration_seconds"),
        )
    )


def checkpoint_list(checkpoints: DataFrame) -> DataFrame:
    return checkpoints.select(
        "table_name",
        "current_watermark",
        "fallback_watermark",
        "last_id",
        "layer",
        "offset_val",
        "is_override_active",
        "last_successful_run_id",
        "updated_at",
    ).orderBy("table_name", "layer")


def recent_batches(batches: DataFrame, limit: int = 100, table_name: str | None = None) -> DataFrame:
    """Most recent batches, of one table or of all."""
    if table_name is not None:
        batches = batches.where(F.col("table_name") == table_name)
    return batches.orderBy(F.col("created_at").desc(), F.col("batch_id").desc()).limit(limit)


def replay_history(events: DataFrame, limit: int = 50) -> DataFrame:
    return events.orderBy(F.col("created_at").desc(), F.col("event_id").asc()).limit(limit)


def drift_report(history: DataFrame) -> DataFrame:
    """Schema history, newest first, with readable summaries of each change.

    ``changed_columns`` is a struct or its JSON text; text that is no JSON counts as no change.
    """
    change = F.col("changed_columns")
    if dict(history.dtypes)["changed_columns"] == "string":
        change = F.from_json(change, CHANGED_COLUMNS)
    none = F.array().cast("array<string>")
    added = F.coalesce(change["added"], none)
    removed = F.coalesce(change["removed"], none)
    retyped = F.coalesce(F.array_sort(F.map_keys(change["type_changed"])), none)

    def some(sign: str, names: Column, word: str, shown: int | None) -> Column:
        listed = names if shown is None else F.slice(names, 1, shown)
        more = F.lit("") if shown is None else F.when(F.size(names) > shown, "...").otherwise("")
        text = F.concat(
            F.lit(sign), F.size(names).cast("string"), F.lit(f" {word}: "), F.array_join(listed, ", "), more
        )
        return F.when(F.size(names) > 0, text)

    parts = F.concat_ws(
        " | ",
        some("+", added, "col", SUMMARY_NAMES),
        some("-", removed, "col", SUMMARY_NAMES),
        some("~", retyped, "type", None),
    )
    return (
        history.withColumns(
            {
                "added": added,
                "removed": removed,
                "type_changed": change["type_changed"],
                "changes_summary": F.when(parts == "", NO_CHANGE).otherwise(parts),
                "column_name": F.when(F.size(added) > 0, F.array_join(added, ", "))
                .when(F.size(removed) > 0, F.array_join(removed, ", "))
                .otherwise("-"),
                "data_type": F.when(
                    F.size(retyped) > 0,
                    F.concat(F.lit("MODIFIED ("), F.size(retyped).cast("string"), F.lit(")")),
                )
                .when(F.size(added) > 0, "NEW COLUMN")
                .otherwise("UNCHANGED"),
            }
        )
        .orderBy(F.col("detected_at").desc(), F.col("id").desc())
    )
