"""History, control tables, governance, drift, streaming and replay."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, functions as F

from tidemark import spec as s
from tidemark.operators import drift, history
from tidemark.operators.align import align
from tidemark.operators.dedup import latest_per_key
from tidemark.plans import control, governance
from tidemark.plans.load import load_table
from tidemark.session import scratch
from tidemark.sources.pages import land_pages, scan_pages
from tidemark.sources.store import TableStore
from tidemark.streaming import consumer, latest
from tidemark.plans.ledger import Ledger
from workload import standins as d
from workload.registry import query

NOW = datetime(2026, 9, 8, 20, tzinfo=timezone.utc)
NOW_SECONDS = 1788897600
EPOCH_TEXT = "epoch_us({0}) // 1000000 AS {0}"


def in_seconds(frame: DataFrame, *names: str) -> DataFrame:
    """Timestamps as Unix seconds, so that both engines compare the same values."""
    kinds = dict(frame.dtypes)
    return frame.withColumns(
        {n: d.epoch(n) if kinds[n] == "timestamp_ntz" else F.unix_seconds(n) for n in names}
    )


def sec(*names: str) -> str:
    return ", ".join(EPOCH_TEXT.format(n) for n in names)


# -- history -----------------------------------------------------------------------

ONE = """one AS (SELECT id, updated_at, arg_max(name, event_id) AS name, max(event_id) AS event_id
    FROM users GROUP BY 1, 2)"""


def versions(spark, sf_dir) -> DataFrame:
    rows = d.users(spark, sf_dir).select("id", "updated_at", "name", "event_id")
    return history.one_per_instant(rows, "id", "updated_at", ["event_id"])


def validity(frame: DataFrame, *names: str) -> DataFrame:
    return frame.select(
        "id",
        *names,
        F.unix_seconds("_valid_from").alias("valid_from"),
        F.unix_seconds("_valid_to").alias("valid_to"),
        F.col("_is_current").alias("is_current"),
    )


@query(
    "scd2_build", "users",
    sql=f"""WITH {ONE}, h AS (SELECT *, lead(updated_at) OVER (PARTITION BY id ORDER BY updated_at) AS valid_to FROM one)
        SELECT id, name, event_id, updated_at AS valid_from, valid_to, valid_to IS NULL AS is_current FROM h""",
)
def scd2_build(spark, sf_dir):
    return validity(history.build_history(versions(spark, sf_dir)), "name", "event_id")


@query(
    "scd2_changes", "users",
    sql=f"""WITH {ONE}, c AS (SELECT *, lag(name) OVER (PARTITION BY id ORDER BY updated_at) AS seen FROM one),
        k AS (SELECT * FROM c WHERE seen IS DISTINCT FROM name),
        h AS (SELECT *, lead(updated_at) OVER (PARTITION BY id ORDER BY updated_at) AS valid_to FROM k)
        SELECT id, name, updated_at AS valid_from, valid_to, valid_to IS NULL AS is_current FROM h""",
)
def scd2_changes(spark, sf_dir):
    hashed = versions(spark, sf_dir).withColumn("_hash", F.sha2("name", 256))
    return validity(history.build_history(history.changes_only(hashed, "id", "updated_at")), "name")


@query(
    "scd2_hot_key", "users",
    sql="""WITH hot AS (SELECT CASE WHEN score > 20 THEN 0 ELSE id END AS id, updated_at, event_id FROM users),
        one AS (SELECT id, updated_at, max(event_id) AS event_id FROM hot GROUP BY 1, 2)
        SELECT id, event_id, updated_at AS valid_from,
            lead(updated_at) OVER (PARTITION BY id ORDER BY updated_at) AS valid_to,
            lead(updated_at) OVER (PARTITION BY id ORDER BY updated_at) IS NULL AS is_current FROM one""",
)
def scd2_hot_key(spark, sf_dir):
    hot = d.users(spark, sf_dir).select(
        F.when(F.col("score") > 20, 0).otherwise(F.col("id")).alias("id"), "updated_at", "event_id"
    )
    unique = history.one_per_instant(hot, "id", "updated_at", ["event_id"])
    return validity(history.build_history(unique, width=3600), "event_id")


@query(
    "scd2_apply", "users",
    sql=f"""WITH {ONE}, h AS (SELECT *, lead(updated_at) OVER (PARTITION BY id ORDER BY updated_at) AS valid_to FROM one)
        SELECT id, name, updated_at AS valid_from, valid_to, valid_to IS NULL AS is_current FROM h""",
)
def scd2_apply(spark, sf_dir):
    rows = versions(spark, sf_dir)
    late = F.col("name").isin("click", "error")
    existing = history.build_history(rows.where(~late))
    return validity(history.apply_history(existing, rows.where(late)), "name")


@query(
    "scd2_as_of", "users",
    sql=f"""WITH {ONE} SELECT id, arg_max(name, updated_at) AS name, max(updated_at) AS valid_from
        FROM one WHERE updated_at <= 1705276800 GROUP BY 1""",
)
def scd2_as_of(spark, sf_dir):
    found = history.as_of(history.build_history(versions(spark, sf_dir)), 1705276800)
    return found.select("id", "name", F.unix_seconds("_valid_from").alias("valid_from"))


# -- batches and work --------------------------------------------------------------

REF = """batch_id, printf('%s/year=%d/month=%02d/day=%02d/%d_%d.json', table_name, year(created_at),
    month(created_at), day(created_at), cursor_value, offset_value) AS path, cursor_value, offset_value,
    epoch_us(created_at) // 1000000 AS created_at"""


def refs(batches: DataFrame) -> DataFrame:
    return in_seconds(control.batch_refs(batches, F.col("table_name")), "created_at")


@query(
    "batches_incremental", "batch_logs",
    sql=f"""SELECT {REF} FROM batch_logs WHERE table_name = 'click' AND status = 'SUCCESS' AND batch_id > 51
        ORDER BY batch_id LIMIT 10""",
)
def batches_incremental(spark, sf_dir):
    return refs(control.batches_after(d.batch_logs(spark, sf_dir), "click", 51, 10))


@query(
    "batches_window", "batch_logs",
    sql=f"""SELECT {REF} FROM batch_logs WHERE table_name = 'view' AND status = 'SUCCESS'
        AND cursor_value > 1704240000 AND cursor_value <= 1705881600""",
)
def batches_window(spark, sf_dir):
    return refs(control.batches_in_window(d.batch_logs(spark, sf_dir), "view", 1704240000, 1705881600))


@query(
    "batches_latest", "batch_logs",
    sql=f"""SELECT {REF} FROM (SELECT *, row_number() OVER (PARTITION BY table_name
        ORDER BY created_at DESC, batch_id DESC) AS n FROM batch_logs WHERE status = 'SUCCESS') WHERE n = 1""",
)
def batches_latest(spark, sf_dir):
    return refs(control.latest_batch(d.batch_logs(spark, sf_dir)))


@query(
    "snapshot_batches", "batch_logs",
    sql=f"""WITH ok AS (SELECT * FROM batch_logs WHERE status = 'SUCCESS')
        SELECT {REF} FROM ok WHERE (table_name, run_id) IN
        (SELECT (table_name, arg_max(run_id, created_at)) FROM ok GROUP BY table_name)""",
)
def snapshot_batches(spark, sf_dir):
    return refs(control.latest_snapshot_batches(d.batch_logs(spark, sf_dir)))


def tables(spark, sf_dir) -> DataFrame:
    """A registered table per event type, and one nobody has loaded."""
    seen = d.table(spark, sf_dir, "events").select(F.col("event_type").alias("table_name")).distinct()
    fresh = d.table(spark, sf_dir, "region").select(F.col("r_name").alias("table_name"))
    return seen.union(fresh).withColumn("start", F.lit(s.DEFAULT_START).cast("long"))


@query(
    "resolve_work", "fallback_events", "checkpoints",
    sql=f"""WITH tables AS (SELECT DISTINCT event_type AS table_name FROM events UNION ALL SELECT r_name FROM region),
        q AS (SELECT *, row_number() OVER (PARTITION BY table_name ORDER BY created_at, event_id) AS n
            FROM fallback_events WHERE status = 'PENDING' AND layer = 'ANALYTICS'),
        c AS (SELECT * FROM checkpoints WHERE layer = 'ANALYTICS')
        SELECT t.table_name, CASE WHEN q.event_id IS NOT NULL THEN q.start_watermark
            WHEN c.current_watermark > 0 THEN c.current_watermark ELSE {s.DEFAULT_START} END AS start_watermark,
            q.end_watermark, q.event_id IS NOT NULL AS is_fallback, q.event_id,
            CASE WHEN q.event_id IS NOT NULL THEN 0 ELSE coalesce(c.last_batch_id, 0) END AS last_batch_id,
            CASE WHEN q.event_id IS NOT NULL THEN 0 ELSE coalesce(c.last_id, 0) END AS last_id,
            CAST(0 AS BIGINT) AS offset_val
        FROM tables t LEFT JOIN q ON q.table_name = t.table_name AND q.n = 1
        LEFT JOIN c ON c.table_name = t.table_name""",
)
def resolve_work(spark, sf_dir):
    return control.resolve_work(
        tables(spark, sf_dir), d.fallback_events(spark, sf_dir), d.checkpoints(spark, sf_dir), "ANALYTICS"
    )


@query(
    "high_water_mark", "users", "checkpoints",
    sql="""WITH marks AS (SELECT table_name, max(current_watermark) AS previous FROM checkpoints GROUP BY 1)
        SELECT table_name, greatest(coalesce(seen, previous), previous) AS watermark FROM marks LEFT JOIN
        (SELECT name AS table_name, max(updated_at) - 50000 AS seen FROM users GROUP BY 1) USING (table_name)""",
)
def high_water_mark(spark, sf_dir):
    rows = d.users(spark, sf_dir).select(
        F.col("name").alias("table_name"), (F.col("updated_at") - 50000).alias("updated_at")
    )
    marks = d.checkpoints(spark, sf_dir).groupBy("table_name").agg(F.max("current_watermark").alias("previous"))
    return control.high_water_mark(rows, marks, "updated_at", "table_name")


@query(
    "batch_progress", "batch_logs",
    sql="""SELECT table_name, max(batch_id) AS last_batch_id, CAST(sum(records_count) AS BIGINT) AS records
        FROM batch_logs WHERE status = 'SUCCESS' GROUP BY 1""",
)
def batch_progress(spark, sf_dir):
    return control.batch_progress(d.batch_logs(spark, sf_dir))


# -- control updates ---------------------------------------------------------------

CP = """table_name, layer, {0} AS current_watermark, fallback_watermark, {1} AS last_batch_id, is_override_active"""
SHOWN = ("table_name", "layer", "current_watermark", "fallback_watermark", "last_batch_id", "is_override_active")


@query(
    "checkpoint_upsert", "checkpoints",
    sql="""WITH new AS (SELECT event_type AS table_name, max(sec) + 1 AS w, count(*) AS b FROM ev GROUP BY 1
            UNION ALL SELECT r_name, r_regionkey, 0 FROM region),
        k AS (SELECT table_name, 'RAW' AS layer, w, b FROM new)
        SELECT table_name, layer, coalesce(w, current_watermark) AS current_watermark,
            coalesce(fallback_watermark, 0) AS fallback_watermark, coalesce(b, last_batch_id) AS last_batch_id,
            CASE WHEN w IS NULL THEN is_override_active ELSE FALSE END AS is_override_active
        FROM checkpoints FULL JOIN k USING (table_name, layer)""",
)
def checkpoint_upsert(spark, sf_dir):
    seen = d.table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("table_name")).agg(
        (F.max(d.epoch("ts")) + 1).alias("current_watermark"), F.count(F.lit(1)).alias("last_batch_id")
    )
    fresh = d.table(spark, sf_dir, "region").select(
        F.col("r_name").alias("table_name"),
        F.col("r_regionkey").cast("long").alias("current_watermark"),
        F.lit(0).cast("long").alias("last_batch_id"),
    )
    state = seen.unionByName(fresh).select(
        "*",
        F.lit("RAW").alias("layer"),
        F.lit(0).cast("long").alias("last_id"),
        F.lit(0).cast("long").alias("offset_val"),
        F.lit("run").alias("last_successful_run_id"),
        F.lit(NOW).cast("timestamp_ntz").alias("updated_at"),
    )
    return control.checkpoint_upsert(d.checkpoints(spark, sf_dir), state).select(*SHOWN)


@query(
    "safety_mark_upsert", "checkpoints",
    sql="""WITH k AS (SELECT table_name, 'RAW' AS layer, current_watermark AS m FROM checkpoints WHERE layer = 'ANALYTICS'
            UNION ALL SELECT r_name, 'RAW', r_regionkey FROM region)
        SELECT table_name, layer, coalesce(current_watermark, 0) AS current_watermark,
            coalesce(m, fallback_watermark) AS fallback_watermark, coalesce(last_batch_id, 0) AS last_batch_id,
            coalesce(is_override_active, FALSE) AS is_override_active
        FROM checkpoints FULL JOIN k USING (table_name, layer)""",
)
def safety_mark_upsert(spark, sf_dir):
    stored = d.checkpoints(spark, sf_dir)
    marks = stored.where(F.col("layer") == "ANALYTICS").select("table_name", F.col("current_watermark").alias("fallback_watermark"))
    fresh = d.table(spark, sf_dir, "region").select(
        F.col("r_name").alias("table_name"), F.col("r_regionkey").cast("long").alias("fallback_watermark")
    )
    patch = marks.unionByName(fresh).select(
        "*", F.lit("RAW").alias("layer"), F.lit(NOW).cast("timestamp_ntz").alias("updated_at")
    )
    return control.safety_mark_upsert(stored, patch).select(*SHOWN)


@query(
    "orphan_runs", "runs",
    sql=f"""SELECT run_id, CASE WHEN status = 'RUNNING' THEN {NOW_SECONDS} ELSE epoch_us(completed_at) // 1000000 END
        AS completed_at, CASE WHEN status = 'RUNNING' THEN 'FAILED' ELSE status END AS status,
        CASE WHEN status = 'RUNNING' THEN '{control.ORPHAN_REASON}' ELSE error_message END AS error_message
        FROM runs""",
)
def orphan_runs(spark, sf_dir):
    closed = control.fail_orphan_runs(
        d.runs(spark, sf_dir), F.lit("2026-09-08 20:00:00").cast("timestamp_ntz")
    )
    return in_seconds(closed.select("run_id", "completed_at", "status", "error_message"), "completed_at")


@query(
    "status_update", "fallback_events",
    sql=f"""SELECT event_id, CASE status WHEN 'PENDING' THEN 'IN_PROGRESS' WHEN 'IN_PROGRESS' THEN 'COMPLETED'
            ELSE status END AS status,
        CAST(records_processed + CASE status WHEN 'IN_PROGRESS' THEN 17 ELSE 0 END AS BIGINT) AS records_processed,
        error_message,
        CASE status WHEN 'IN_PROGRESS' THEN {NOW_SECONDS} ELSE epoch_us(completed_at) // 1000000 END AS completed_at
        FROM fallback_events""",
)
def status_update(spark, sf_dir):
    events = d.fallback_events(spark, sf_dir)
    working = F.col("status") == "IN_PROGRESS"
    patch = events.where(F.col("status").isin("PENDING", "IN_PROGRESS")).select(
        "event_id",
        F.when(working, "COMPLETED").otherwise("IN_PROGRESS").alias("status"),
        F.when(working, 17).otherwise(0).cast("long").alias("records_processed"),
        F.lit(None).cast("string").alias("error_message"),
        F.lit("2026-09-08 20:00:00").cast("timestamp_ntz").alias("at"),
    )
    moved = control.replay_status(events, patch)
    return in_seconds(
        moved.select("event_id", "status", "records_processed", "error_message", "completed_at"), "completed_at"
    )


@query(
    "override_update", "checkpoints",
    sql="""SELECT table_name, layer, current_watermark,
        CASE WHEN table_name = 'click' THEN 1577836800 ELSE fallback_watermark END AS fallback_watermark,
        last_batch_id, is_override_active OR table_name = 'click' AS is_override_active FROM checkpoints""",
)
def override_update(spark, sf_dir):
    at = F.lit("2026-09-08 20:00:00").cast("timestamp_ntz")
    return control.set_override(d.checkpoints(spark, sf_dir), "click", at, 1577836800).select(*SHOWN)


# -- governance --------------------------------------------------------------------


@query(
    "governance_stats", "runs", "checkpoints", "batch_logs", "fallback_events", "ev",
    sql="""SELECT (SELECT count(*) FROM runs) AS total_runs,
        (SELECT count(*) FROM runs WHERE status = 'COMPLETED') AS successful_runs,
        (SELECT count(*) FROM runs WHERE status = 'FAILED') AS failed_runs,
        (SELECT count(*) FROM checkpoints) AS total_tables,
        (SELECT count(*) FROM checkpoints WHERE is_override_active) AS active_overrides,
        (SELECT CAST(coalesce(sum(records_count), 0) AS BIGINT) FROM batch_logs) AS total_records_ingested,
        (SELECT count(DISTINCT (event_type, dayofyear(ts))) FROM ev) AS total_schema_changes,
        (SELECT count(*) FROM fallback_events WHERE status = 'PENDING') AS pending_fallbacks""",
)
def governance_stats(spark, sf_dir):
    return governance.dashboard_stats(
        d.runs(spark, sf_dir),
        d.checkpoints(spark, sf_dir),
        d.batch_logs(spark, sf_dir),
        schema_history(spark, sf_dir),
        d.fallback_events(spark, sf_dir),
    )


@query(
    "runs_history", "runs",
    sql=f"""SELECT run_id, {sec('started_at', 'completed_at')}, layer, status, error_message,
        CAST(round((epoch_us(runs.completed_at) - epoch_us(runs.started_at)) / 1e6) AS BIGINT) AS duration_seconds
        FROM runs ORDER BY runs.started_at DESC, run_id LIMIT 50""",
)
def runs_history(spark, sf_dir):
    return in_seconds(governance.runs_history(d.runs(spark, sf_dir)), "started_at", "completed_at")


@query(
    "recent_batches", "batch_logs",
    sql=f"""SELECT batch_id, run_id, table_name, layer, status, cursor_value, offset_value, records_count, duration_ms,
        query_sent, error_message, {sec('created_at')} FROM batch_logs
        ORDER BY batch_logs.created_at DESC, batch_id DESC LIMIT 100""",
)
def recent_batches(spark, sf_dir):
    return in_seconds(governance.recent_batches(d.batch_logs(spark, sf_dir)), "created_at")


@query(
    "recent_batches_of_table", "batch_logs",
    sql=f"""SELECT batch_id, status, records_count, {sec('created_at')} FROM batch_logs WHERE table_name = 'view'
        ORDER BY batch_logs.created_at DESC, batch_id DESC LIMIT 100""",
)
def recent_batches_of_table(spark, sf_dir):
    found = governance.recent_batches(d.batch_logs(spark, sf_dir), table_name="view")
    return in_seconds(found.select("batch_id", "status", "records_count", "created_at"), "created_at")


@query(
    "checkpoint_list", "checkpoints",
    sql=f"""SELECT table_name, current_watermark, fallback_watermark, last_id, layer, CAST(offset_val AS BIGINT) AS offset_val,
        is_override_active, last_successful_run_id, {sec('updated_at')} FROM checkpoints""",
)
def checkpoint_list(spark, sf_dir):
    return in_seconds(governance.checkpoint_list(d.checkpoints(spark, sf_dir)), "updated_at")


EVENT = f"""event_id, table_name, layer, start_watermark, end_watermark, status,
    CAST(records_processed AS BIGINT) AS records_processed, error_message, {sec('created_at', 'completed_at')}"""


@query(
    "replay_history", "fallback_events",
    sql=f"SELECT {EVENT} FROM fallback_events ORDER BY fallback_events.created_at DESC, event_id LIMIT 50",
)
def replay_history(spark, sf_dir):
    return in_seconds(governance.replay_history(d.fallback_events(spark, sf_dir)), "created_at", "completed_at")


@query(
    "replay_queue", "fallback_events",
    sql=f"SELECT {EVENT} FROM fallback_events WHERE status = 'PENDING' AND layer = 'RAW'",
)
def replay_queue(spark, sf_dir):
    waiting = control.pending_replays(d.fallback_events(spark, sf_dir), "RAW")
    return in_seconds(waiting, "created_at", "completed_at")


# -- schema drift ------------------------------------------------------------------


def profile(spark, sf_dir) -> DataFrame:
    return drift.profile_records(d.payloads(spark, sf_dir), "record", "table_name", "batch_id")


def batch_snapshots(spark, sf_dir) -> DataFrame:
    return drift.snapshots(profile(spark, sf_dir), "table_name", "batch_id")


def schema_history(spark, sf_dir) -> DataFrame:
    """A history row per table and day, with the change against the day before."""
    seen = batch_snapshots(spark, sf_dir)
    before = seen.select(
        "table_name", (F.col("batch_id") + 1).alias("batch_id"), F.col("columns_snapshot").alias("old")
    )
    changed = drift.diff_columns(F.col("old"), F.col("columns_snapshot"))
    return seen.join(before, ["table_name", "batch_id"], "left").select(
        F.col("batch_id").alias("id"),
        "table_name",
        "schema_hash",
        "columns_snapshot",
        changed.alias("changed_columns"),
        F.timestamp_seconds(F.col("batch_id") * 86400).alias("detected_at"),
        F.lit("NEW_COLUMN").alias("status"),
    )


@query(
    "schema_profile", "profile",
    sql="SELECT table_name, batch_id, field, type, rows FROM profile",
)
def schema_profile(spark, sf_dir):
    return profile(spark, sf_dir)


@query(
    "schema_signature", "snapshots", sql="SELECT table_name, batch_id, schema_hash FROM snapshots"
)
def schema_signature(spark, sf_dir):
    return batch_snapshots(spark, sf_dir).drop("columns_snapshot")


@query(
    "schema_diff", "profile",
    sql="""WITH p AS (SELECT DISTINCT table_name, batch_id, field, type FROM profile),
        o AS (SELECT table_name, batch_id + 1 AS batch_id, field, type AS old_type FROM p
            WHERE batch_id < (SELECT max(batch_id) FROM p)),
        n AS (SELECT table_name, batch_id, field, type AS new_type FROM p WHERE batch_id > 1)
        SELECT table_name, batch_id, field, old_type, new_type, CASE WHEN old_type IS NULL THEN 'added'
            WHEN new_type IS NULL THEN 'removed' ELSE 'type_changed' END AS change
        FROM o FULL JOIN n USING (table_name, batch_id, field)
        WHERE old_type IS DISTINCT FROM new_type""",
)
def schema_diff(spark, sf_dir):
    seen = profile(spark, sf_dir).drop("rows")
    # Only batches that have a successor take part on the old side.
    old = seen.withColumn("batch_id", F.col("batch_id") + 1).join(
        seen.select("batch_id").distinct(), "batch_id", "left_semi"
    )
    return drift.schema_diff(old, seen.where(F.col("batch_id") > 1), "table_name", "batch_id")


EVENTS = """SELECT table_name, batch_id, schema_hash, lag(schema_hash) OVER w AS previous_hash,
    coalesce(list_transform(pairs, lambda x: split_part(x, ':', 1)), []) AS now,
    coalesce(lag(list_transform(pairs, lambda x: split_part(x, ':', 1))) OVER w, []) AS was,
    pairs, coalesce(lag(pairs) OVER w, []) AS old_pairs
    FROM snapshots WINDOW w AS (PARTITION BY table_name ORDER BY batch_id)"""
LISTED = """array_to_string(list_sort(list_filter(now, lambda x: NOT list_contains(was, x))), ',') AS added,
    array_to_string(list_sort(list_filter(was, lambda x: NOT list_contains(now, x))), ',') AS removed,
    array_to_string(list_sort(list_transform(list_filter(pairs, lambda x: NOT list_contains(old_pairs, x)
        AND list_contains(was, split_part(x, ':', 1))), lambda x: split_part(x, ':', 1))), ',') AS retyped"""


@query(
    "drift_events", "snapshots",
    sql=f"""WITH e AS ({EVENTS}) SELECT table_name, batch_id, schema_hash, previous_hash, {LISTED}
        FROM e WHERE schema_hash IS DISTINCT FROM previous_hash""",
)
def drift_events(spark, sf_dir):
    change = F.col("changed_columns")
    return drift.drift_events(batch_snapshots(spark, sf_dir)).select(
        "table_name",
        "batch_id",
        "schema_hash",
        "previous_hash",
        F.array_join(change["added"], ",").alias("added"),
        F.array_join(change["removed"], ",").alias("removed"),
        F.array_join(F.array_sort(F.map_keys(change["type_changed"])), ",").alias("retyped"),
    )


@query(
    "latest_per_key", "snapshots",
    sql="""SELECT table_name, arg_max(schema_hash, batch_id) AS schema_hash, max(batch_id) AS id
        FROM snapshots GROUP BY 1""",
)
def latest_snapshot(spark, sf_dir):
    return drift.latest_snapshot(schema_history(spark, sf_dir)).select("table_name", "schema_hash", "id")


@query(
    "drift_report", "snapshots",
    sql=f"""WITH e AS ({EVENTS}), l AS (SELECT table_name, batch_id,
            list_sort(list_filter(now, lambda x: NOT list_contains(was, x))) AS a,
            list_sort(list_filter(was, lambda x: NOT list_contains(now, x))) AS r,
            list_sort(list_transform(list_filter(pairs, lambda x: NOT list_contains(old_pairs, x)
                AND list_contains(was, split_part(x, ':', 1))), lambda x: split_part(x, ':', 1))) AS t FROM e)
        SELECT batch_id AS id, table_name,
            CASE WHEN len(a) + len(r) + len(t) = 0 THEN 'Initial Snapshot / Unchanged' ELSE concat_ws(' | ',
                CASE WHEN len(a) > 0 THEN '+' || len(a) || ' col: ' || array_to_string(a[1:3], ', ')
                    || CASE WHEN len(a) > 3 THEN '...' ELSE '' END END,
                CASE WHEN len(r) > 0 THEN '-' || len(r) || ' col: ' || array_to_string(r[1:3], ', ')
                    || CASE WHEN len(r) > 3 THEN '...' ELSE '' END END,
                CASE WHEN len(t) > 0 THEN '~' || len(t) || ' type: ' || array_to_string(t, ', ') END)
            END AS changes_summary,
            CASE WHEN len(a) > 0 THEN array_to_string(a, ', ') WHEN len(r) > 0 THEN array_to_string(r, ', ')
                ELSE '-' END AS column_name,
            CASE WHEN len(t) > 0 THEN 'MODIFIED (' || len(t) || ')' WHEN len(a) > 0 THEN 'NEW COLUMN'
                ELSE 'UNCHANGED' END AS data_type FROM l""",
)
def drift_report(spark, sf_dir):
    report = governance.drift_report(schema_history(spark, sf_dir))
    return report.select("id", "table_name", "changes_summary", "column_name", "data_type")


# -- streaming and replay ----------------------------------------------------------


@query(
    "stream_drain", "users",
    sql=f"""WITH {ONE} SELECT id, name, event_id, updated_at AS valid_from,
        lead(updated_at) OVER (PARTITION BY id ORDER BY updated_at) AS valid_to,
        lead(updated_at) OVER (PARTITION BY id ORDER BY updated_at) IS NULL AS is_current FROM one""",
)
def stream_drain(spark, sf_dir):
    base = scratch(spark, "stream")
    store = TableStore(spark, f"{base}/tables")
    # Pages are named by version and key, so each version of a user keeps its own place.
    source = d.users(spark, sf_dir)
    staged = history.one_per_instant(source, "id", "updated_at", ["event_id"])
    land_pages(staged, BULK_USER, f"{base}/raw", NOW, s.DEFAULT_START)
    query_ = consumer.follow(store, d.USER, f"{base}/raw", f"{base}/checkpoint", until_idle=True)
    query_.awaitTermination()
    return validity(store.read(d.USER.main_table()), "name", "event_id")


BULK_USER = s.EntitySpec(**{**d.USER.__dict__, "page_size": 5_000})


def landed(spark, label, *deltas):
    """A store whose batch log and pages hold the deltas (entity, rows), logged one after the other."""
    base = scratch(spark, label)
    store = TableStore(spark, f"{base}/tables")
    for n, (spec, rows) in enumerate(deltas):
        at = NOW + timedelta(days=n)
        pages = land_pages(rows, spec, f"{base}/raw", at, s.DEFAULT_START)
        Ledger(store).log_pages(pages, spec, f"run-{n}", at, 0, "all")
    return base, store


def upserted(spark, sf_dir, label):
    """Newer clicks land first and the rest after them; the stream is stopped and taken up in between."""
    source = d.activities(spark, sf_dir).drop("undeclared")
    newer = source.where(F.col("name") == "click").withColumns(
        {"updated_at": F.col("updated_at") + 7, "score": F.col("score") + 1}
    )
    base, store = landed(spark, label, (d.BULK, newer))
    for again in (False, True):
        if again:
            pages = land_pages(source, d.BULK, f"{base}/raw", NOW, s.DEFAULT_START)
            Ledger(store).log_pages(pages, d.BULK, "run-1", NOW, 0, "all")
        consumer.follow(store, d.BULK, f"{base}/raw", f"{base}/checkpoint", until_idle=True, by_log=True).awaitTermination()
    return base, store


@query(
    "stream_upsert", "activities",
    sql="""SELECT id, updated_at + CASE WHEN name = 'click' THEN 7 ELSE 0 END AS updated_at,
        score + CASE WHEN name = 'click' THEN 1 ELSE 0 END AS score FROM activities""",
)
def stream_upsert(spark, sf_dir):
    """Of every id the newest version, whichever landed first."""
    _, store = upserted(spark, sf_dir, "upsert")
    return store.read(d.BULK.main_table()).select("id", "updated_at", "score")


@query(
    "batch_metrics", "activities",
    sql=f"""WITH landings AS (SELECT 1 AS landing, id, updated_at + 7 AS updated_at FROM activities WHERE name = 'click'
            UNION ALL SELECT 2, id, updated_at FROM activities),
        per AS (SELECT landing, count(*) AS n FROM landings GROUP BY 1)
        SELECT layer, 'SUCCESS' AS status, (SELECT count(*) FROM landings) AS records, (SELECT max(updated_at) FROM landings) AS mark,
            CASE WHEN layer = 'RAW' THEN (SELECT sum(ceil(n / {d.BULK.page_size}.0))::BIGINT FROM per) END AS pages,
            CASE WHEN layer = 'RAW' THEN (SELECT min(updated_at) FROM landings) END AS first_version,
            TRUE AS timed
        FROM (VALUES ('RAW'), ('ANALYTICS')) AS l(layer)""",
)
def batch_metrics(spark, sf_dir):
    """What the batch log says of two landings and of the micro-batches that loaded them, by layer."""
    base, store = upserted(spark, sf_dir, "metrics")
    logged = store.read(s.BATCH_LOGS).groupBy("layer", "status").agg(
        F.sum("records_count").alias("records"),
        F.count(F.lit(1)).alias("pages"),
        F.min("first_version").alias("first_version"),
        F.bool_and(F.col("duration_ms") >= 0).alias("timed"),
    )
    # A micro-batch logs no versions; what it reached is the mark of its layer.
    raw = store.read(s.BATCH_LOGS).where("layer = 'RAW'").groupBy("layer").agg(F.max("last_version").alias("mark"))
    marks = raw.unionByName(store.read(s.CHECKPOINTS).select("layer", F.col("current_watermark").alias("mark")))
    pages = F.when(F.col("layer") == "RAW", F.col("pages")).alias("pages")
    return logged.join(marks, "layer").select("layer", "status", "records", "mark", pages, "first_version", "timed")


@query(
    "stream_latest", "users",
    sql="""SELECT id, arg_max(name, updated_at * 1000000000 + event_id) AS name, max(updated_at) AS updated_at,
        arg_max(event_id, updated_at * 1000000000 + event_id) AS event_id FROM users GROUP BY 1""",
)
def stream_latest(spark, sf_dir):
    """Pages in small micro-batches through per-key state; of every user the row that was sent last."""
    base = scratch(spark, "latest")
    latest.use_typed_state(spark)
    staged = history.one_per_instant(d.users(spark, sf_dir), "id", "updated_at", ["event_id"])
    land_pages(staged, BULK_USER, f"{base}/raw", NOW, s.DEFAULT_START)
    store = TableStore(spark, f"{base}/tables")
    rows = align(consumer.page_stream(store, BULK_USER, f"{base}/raw", 5, backlog=True), BULK_USER.schema)
    newest = latest.newest_versions(rows.select("id", "name", "updated_at", "event_id"), "id", "updated_at", "event_id")

    def append(frame, batch):
        frame.withColumn("sent", F.lit(batch)).write.mode("overwrite").parquet(f"{base}/sent/batch={batch}")

    sent = newest.writeStream.outputMode("update").foreachBatch(append).option("checkpointLocation", f"{base}/checkpoint")
    sent.trigger(availableNow=True).start().awaitTermination()
    told = spark.read.option("basePath", f"{base}/sent").parquet(f"{base}/sent").drop("batch")
    return latest_per_key(told, ["id"], ["sent"], drop=("sent",))


@query("stream_snapshot", sql="SELECT s_suppkey AS id, s_name AS name FROM supplier")
def stream_snapshot(spark, sf_dir):
    """Two snapshots of a full-load table in many pages each: the last one stays, whole."""
    members = lambda name, key, label: d.table(spark, sf_dir, name).select(
        F.col(key).cast("long").alias("id"), F.col(label).alias("name"), F.col(key).cast("long").alias("updated_at")
    )
    many, few = members("customer", "c_custkey", "c_name"), members("supplier", "s_suppkey", "s_name")
    base, store = landed(spark, "snapshot", (s.GENRE, many), (s.GENRE, few))
    consumer.follow(store, s.GENRE, f"{base}/raw", f"{base}/checkpoint", pages=1, until_idle=True).awaitTermination()
    return store.read(s.GENRE.main_table()).select("id", "name")


@query(
    "checkpoint_concurrent", "activities", "users",
    sql="""SELECT 'Activity' AS table_name, count(*) AS records, max(updated_at) AS current_watermark FROM activities
        UNION ALL SELECT 'User', count(DISTINCT (id, updated_at)), max(updated_at) FROM users""",
)
def checkpoint_concurrent(spark, sf_dir):
    """Two streams at once on one set of control tables: both checkpoints, and every logged row count."""
    activities = d.activities(spark, sf_dir).drop("undeclared")
    users = history.one_per_instant(d.users(spark, sf_dir), "id", "updated_at", ["event_id"])
    base, store = landed(spark, "concurrent", (d.BULK, activities), (BULK_USER, users))
    streams = [
        consumer.follow(store, spec, f"{base}/raw", f"{base}/{spec.name}", until_idle=True, by_log=True)
        for spec in (d.BULK, BULK_USER)
    ]
    for stream in streams:
        stream.awaitTermination()
    done = store.read(s.BATCH_LOGS).where("layer = 'ANALYTICS' AND status = 'SUCCESS'")
    records = done.groupBy("table_name").agg(F.sum("records_count").alias("records"))
    marks = store.read(s.CHECKPOINTS).where("layer = 'ANALYTICS'").select("table_name", "current_watermark")
    return records.join(marks, "table_name")


@query(
    "refs_scan", "activities",
    sql="""WITH p AS (SELECT *, (row_number() OVER (ORDER BY updated_at, id) - 1) // 500 AS page FROM activities),
        hit AS (SELECT page FROM p GROUP BY 1 HAVING max(updated_at) >= 1704844800 AND min(updated_at) <= 1705276800)
        SELECT id, name, updated_at, score FROM p WHERE page IN (SELECT page FROM hit)""",
)
def refs_scan(spark, sf_dir):
    """Pages that may hold records of a window, read by the paths that their references name."""
    base, store = landed(spark, "refs", (d.ACTIVITY, d.activities(spark, sf_dir).drop("undeclared")))
    refs = control.pages_overlapping(store.read(s.BATCH_LOGS), "Activity", 1704844800, 1705276800)
    paths = [f"{base}/raw/{r.path}" for r in control.batch_refs(refs, "activities").collect()]
    typed = align(scan_pages(spark, d.ACTIVITY, paths), d.ACTIVITY.schema)
    return typed.select("id", "name", "updated_at", "score")


@query(
    "ingest_time", "activities",
    sql=f"""SELECT name, count(*) AS rows, {NOW_SECONDS} AS ingested_at FROM activities GROUP BY 1""",
)
def ingest_time(spark, sf_dir):
    """Every loaded row says when it was taken in."""
    store = TableStore(spark, scratch(spark, "ingest"))
    load_table(store, d.ACTIVITY, d.activities(spark, sf_dir), NOW)
    rows = store.read(d.ACTIVITY.main_table())
    return rows.groupBy("name", F.unix_timestamp("_ingested_at").alias("ingested_at")).agg(F.count(F.lit(1)).alias("rows"))


@query(
    "drift_logged", "profile",
    sql="""WITH f AS (SELECT table_name, batch_id > 15 AS half, field, string_agg(DISTINCT type, '|' ORDER BY type) AS type
            FROM profile GROUP BY 1, 2, 3),
        h AS (SELECT table_name, half, list(field || ':' || type) AS pairs, list(field) AS names,
            sha256(string_agg(field || ':' || type, ',' ORDER BY field || ':' || type)) AS schema_hash FROM f GROUP BY 1, 2),
        l AS (SELECT *, lag(schema_hash) OVER w AS old, coalesce(lag(names) OVER w, []) AS was FROM h
            WINDOW w AS (PARTITION BY table_name ORDER BY half))
        SELECT table_name, schema_hash, array_to_string(list_sort(list_filter(names, lambda x: NOT list_contains(was, x))), ',')
            AS added, array_to_string(list_sort(list_filter(was, lambda x: NOT list_contains(names, x))), ',') AS removed
        FROM l WHERE schema_hash IS DISTINCT FROM old""",
)
def drift_logged(spark, sf_dir):
    """Half a month and the other half are profiled and logged, the second twice: no schema is logged again."""
    store = TableStore(spark, scratch(spark, "drift"))
    records = d.payloads(spark, sf_dir)
    first, second = records.where("batch_id <= 15"), records.where("batch_id > 15")
    for n, part in enumerate((first, second, second)):
        Ledger(store).log_drift(part, "record", None, f"run-{n}", NOW + timedelta(days=n))
    logged = store.read(s.SCHEMA_HISTORY)
    listed = [F.array_join(F.col(f"changed_columns.{c}"), ",").alias(c) for c in ("added", "removed")]
    return logged.select("table_name", "schema_hash", *listed)


@query(
    "replay_load", "activities",
    sql="""SELECT id, name, updated_at, CASE WHEN updated_at BETWEEN 1704844800 AND 1705276800 AND name <> 'click'
        THEN score ELSE score + 1 END AS score FROM activities
        WHERE name = 'click' OR updated_at BETWEEN 1704844800 AND 1705276800""",
)
def replay_load(spark, sf_dir):
    """Clicks are loaded in a newer version first; the replay adds the rest of its window."""
    base = scratch(spark, "replay")
    store = TableStore(spark, f"{base}/tables")
    source = d.activities(spark, sf_dir)
    newer = source.where(F.col("name") == "click").withColumns(
        {"updated_at": F.col("updated_at") + 1, "score": F.col("score") + 1}
    )
    load_table(store, d.ACTIVITY, newer, NOW)
    pages = land_pages(source, d.BULK, f"{base}/raw", NOW, s.DEFAULT_START)
    ledger = Ledger(store)
    ledger.log_pages(pages, d.ACTIVITY, "run", NOW, 0, "all")
    event = ledger.create_replay("Activity", 1704844800, 1705276800, NOW, "ANALYTICS").first()
    consumer.replay(store, d.ACTIVITY, f"{base}/raw", event.event_id, 1704844800, 1705276800, NOW)
    loaded = store.read(d.ACTIVITY.main_table())
    shift = F.when(F.col("name") == "click", 1).otherwise(0)
    return loaded.select("id", "name", (F.col("updated_at") - shift).alias("updated_at"), "score")
