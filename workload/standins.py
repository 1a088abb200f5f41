"""The engine's inputs as derived from the test tables, once for Spark and once in SQL.

Every frame here has a common table expression of the same name in ``CTES``. All
rows of the underlying tables take part.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark import spec as s
from tidemark.functions.columns import epoch_seconds_ntz

ACTIVITY = s.EntitySpec(
    name="Activity",
    path="activities",
    schema=s.record(
        *s.named(s.LONG, "id", "user"),
        *s.named(s.TEXT, "name"),
        *s.named(s.LONG, "updated_at"),
        *s.named(s.REAL, "score"),
        *s.named(s.TEXT, "note"),
        *s.named(s.LONGS, "marks"),
        required=("id", "name"),
    ),
)
# Versions of users: the same records under the user's id, history kept.
USER = s.EntitySpec(
    name="User",
    path="users",
    schema=s.record(
        *s.named(s.LONG, "id"),
        *s.named(s.TEXT, "name"),
        *s.named(s.LONG, "updated_at", "event_id"),
        *s.named(s.REAL, "score"),
        *s.named(s.LONGS, "marks"),
        required=("id", "name"),
    ),
    keep_history=True,
)
BUNDLE = s.EntitySpec(
    name="Bundle",
    path="bundles",
    schema=s.record(
        *s.named(s.LONG, "id"),
        *s.named(s.TEXT, "name"),
        *s.named(s.LONG, "updated_at"),
        *s.named(s.REAL, "rating"),
        *s.named(s.LONGS, "genres", "platforms"),
        required=("id", "name"),
    ),
)
# Larger pages where only the content of landed files matters.
BULK = replace(ACTIVITY, page_size=10_000)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def epoch(name: str) -> Column:
    return epoch_seconds_ntz(F.col(name))


def k_value() -> Column:
    return F.get_json_object("props", "$.k").cast("long")


def activities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source records: one per event."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        F.col("user_id").alias("user"),
        F.col("event_type").alias("name"),
        epoch("ts").alias("updated_at"),
        F.col("value").alias("score"),
        F.array(k_value(), F.when(F.col("event_type") != "view", F.col("user_id")), k_value()).alias("marks"),
        F.col("props").alias("undeclared"),
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions of users: each event is one delivery of its user."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("id"),
        F.col("event_type").alias("name"),
        epoch("ts").alias("updated_at"),
        "event_id",
        F.col("value").alias("score"),
        F.array(k_value(), F.floor(F.col("value") / 50).cast("long")).alias("marks"),
    )


def games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Game-like rows from orders: arrays, missing ratings, dates on both sides of the guard."""
    price, cust, prio = F.col("o_totalprice"), F.col("o_custkey"), F.col("o_orderpriority")
    shift = F.when(prio == "1-URGENT", -631152000).when(prio == "2-HIGH", 1009843200).otherwise(0)
    tag = lambda width: F.floor(price / width).cast("long")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.concat_ws(" ", prio, cust.cast("string")).alias("name"),
        F.concat_ws("-", F.lit("order"), F.col("o_orderkey").cast("string")).alias("slug"),
        F.when(F.col("o_orderstatus") != "P", price / 5000).alias("rating"),
        cust.alias("rating_count"),
        F.when(prio != "5-LOW", price / 6000).alias("aggregated_rating"),
        (price / 7000).alias("total_rating"),
        (cust * 2).alias("total_rating_count"),
        F.when(prio != "1-URGENT", cust).alias("hypes"),
        F.when(prio != "3-MEDIUM", epoch("o_orderdate") + shift).alias("first_release_date"),
        epoch("o_orderdate").alias("updated_at"),
        F.when(
            prio != "4-NOT SPECIFIED",
            F.array(tag(5000), tag(10000), F.when(prio != "2-HIGH", tag(5000)), F.lit(987654321).cast("long")),
        ).alias("genres"),
        F.array(cust, cust + 1, cust).alias("platforms"),
        (F.col("o_orderstatus") != "O").alias("_is_current"),
    )


def genres(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")
    )


def platforms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name")
    )


def batch_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch per event type and stretch of 500 events."""
    stretch = F.floor(F.col("event_id") / 500).cast("long")
    kind = F.array_position(
        F.array(*[F.lit(t) for t in ("click", "error", "purchase", "signup", "view")]), F.col("event_type")
    )
    grouped = (
        table(spark, sf_dir, "events")
        .groupBy(F.col("event_type").alias("table_name"), stretch.alias("stretch"), kind.alias("kind"))
        .agg(
            F.count(F.lit(1)).alias("records_count"),
            F.min(epoch("ts")).alias("cursor_value"),
            F.max("ts").alias("created_at"),
            F.max("value").alias("top"),
            (F.max("event_id") - F.min("event_id")).alias("duration_ms"),
        )
    )
    failed = F.col("top") >= 300
    return grouped.select(
        (F.col("stretch") * 10 + F.col("kind")).cast("long").alias("batch_id"),
        F.date_format("created_at", "'run-'yyyy-MM-dd").alias("run_id"),
        "table_name",
        F.lit("RAW").alias("layer"),
        F.when(failed, "FAILED").otherwise("SUCCESS").alias("status"),
        "cursor_value",
        (F.col("stretch") * 500).alias("offset_value"),
        "records_count",
        "duration_ms",
        F.concat(F.lit("updated_at >= "), F.col("cursor_value").cast("string")).alias("query_sent"),
        F.when(failed, "timeout").alias("error_message"),
        "created_at",
    )


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run per hour of events."""
    top, low = F.max("value"), F.min("value")
    status = F.when(top >= 250, "FAILED").when(low < 0.5, "RUNNING").otherwise("COMPLETED")
    grouped = (
        table(spark, sf_dir, "events")
        .groupBy(F.date_trunc("hour", "ts").alias("hour"))
        .agg(F.min("ts").alias("started_at"), F.max("ts").alias("ended"), status.alias("status"))
    )
    return grouped.select(
        F.date_format("started_at", "'run-'yyyy-MM-dd-HH").alias("run_id"),
        "started_at",
        F.when(F.col("status") != "RUNNING", F.col("ended")).alias("completed_at"),
        F.when(F.hour("started_at") < 12, "RAW").otherwise("ANALYTICS").alias("layer"),
        "status",
        F.when(F.col("status") == "FAILED", "boom").alias("error_message"),
    )


def checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A checkpoint per event type and layer (rows before and after noon)."""
    layer = F.when(F.hour("ts") < 12, "RAW").otherwise("ANALYTICS")
    grouped = (
        table(spark, sf_dir, "events")
        .groupBy(F.col("event_type").alias("table_name"), layer.alias("layer"))
        .agg(
            F.max(epoch("ts")).alias("current_watermark"),
            F.min(epoch("ts")).alias("fallback_watermark"),
            F.max("event_id").alias("last_id"),
            F.count(F.lit(1)).alias("last_batch_id"),
            F.max("ts").alias("updated_at"),
        )
    )
    return grouped.select(
        F.concat_ws(":", "table_name", "layer").alias("checkpoint_id"),
        "table_name",
        F.when(F.col("table_name") == "view", 0).otherwise(F.col("current_watermark")).alias("current_watermark"),
        "fallback_watermark",
        "last_id",
        "last_batch_id",
        "layer",
        F.lit(0).cast("long").alias("offset_val"),
        (F.col("table_name") == "error").alias("is_override_active"),
        F.date_format("updated_at", "'run-'yyyy-MM-dd-HH").alias("last_successful_run_id"),
        "updated_at",
    )


def fallback_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A replay request per event type and day."""
    day = F.date_format("ts", "yyyy-MM-dd")
    grouped = (
        table(spark, sf_dir, "events")
        .groupBy(F.col("event_type").alias("table_name"), day.alias("day"))
        .agg(
            F.min(epoch("ts")).alias("start_watermark"),
            F.max(epoch("ts")).alias("end_watermark"),
            F.count(F.lit(1)).alias("n"),
            F.min("ts").alias("created_at"),
            F.max("ts").alias("ended"),
            F.max("value").alias("top"),
            F.min("value").alias("low"),
        )
    )
    status = (
        F.when(F.col("top") >= 300, "FAILED")
        .when((F.col("low") < 0.5) & (F.col("table_name") != "signup"), "PENDING")
        .when(F.col("low") < 1, "IN_PROGRESS")
        .otherwise("COMPLETED")
    )
    named = grouped.withColumn("status", status)
    return named.select(
        F.concat_ws("-", "table_name", "day").alias("event_id"),
        "table_name",
        F.when(F.col("n") >= 66, "RAW").otherwise("ANALYTICS").alias("layer"),
        "start_watermark",
        "end_watermark",
        "status",
        F.when(F.col("status") == "COMPLETED", F.col("n")).otherwise(0).alias("records_processed"),
        F.when(F.col("status") == "FAILED", "boom").alias("error_message"),
        "created_at",
        F.when(F.col("status").isin("COMPLETED", "FAILED"), F.col("ended")).alias("completed_at"),
    )


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed records as JSON text; fields come, go and change type over the days."""
    day, kind = F.dayofyear("ts"), F.col("event_type")
    text = lambda c: F.col(c).cast("string")
    optional = lambda when, *parts: F.when(when, F.concat(*parts)).otherwise(F.lit(""))
    return table(spark, sf_dir, "events").select(
        kind.alias("table_name"),
        day.cast("long").alias("batch_id"),
        F.concat(
            F.lit('{"id":'), text("event_id"), F.lit(',"user":'), text("user_id"),
            optional(kind == "purchase", F.lit(',"amount":'), text("value")),
            optional((kind == "click") & (day < 10), F.lit(',"session":'), text("user_id")),
            optional((kind == "click") & (day >= 10), F.lit(',"session":"s'), text("user_id"), F.lit('"')),
            optional((kind == "view") & (day >= 12) & (day < 20), F.lit(',"agent":null,"tags":['), text("user_id"), F.lit("]")),
            optional((kind == "error") & (day >= 25), F.lit(',"fatal":true')),
            F.lit(',"props":'), F.col("props"), F.lit("}"),
        ).alias("record"),
    )


BASE = {
    "ev": """SELECT *, epoch_us(ts) // 1000000 AS sec, CAST(props->>'$.k' AS BIGINT) AS k FROM events""",
    "activities": """SELECT event_id AS id, user_id AS "user", event_type AS name, sec AS updated_at,
        value AS score, [k, CASE WHEN event_type <> 'view' THEN user_id END, k] AS marks,
        props AS undeclared FROM ev""",
    "users": """SELECT user_id AS id, event_type AS name, sec AS updated_at, event_id, value AS score,
        [k, CAST(floor(value / 50) AS BIGINT)] AS marks FROM ev""",
    "games": """SELECT o_orderkey AS id, o_orderpriority || ' ' || o_custkey AS name,
        'order-' || o_orderkey AS slug,
        CASE WHEN o_orderstatus <> 'P' THEN o_totalprice / 5000 END AS rating,
        o_custkey AS rating_count,
        CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice / 6000 END AS aggregated_rating,
        o_totalprice / 7000 AS total_rating, o_custkey * 2 AS total_rating_count,
        CASE WHEN o_orderpriority <> '1-URGENT' THEN o_custkey END AS hypes,
        CASE WHEN o_orderpriority <> '3-MEDIUM' THEN epoch_us(o_orderdate) // 1000000 +
            CASE o_orderpriority WHEN '1-URGENT' THEN -631152000 WHEN '2-HIGH' THEN 1009843200 ELSE 0 END
        END AS first_release_date,
        epoch_us(o_orderdate) // 1000000 AS updated_at,
        CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN [
            CAST(floor(o_totalprice / 5000) AS BIGINT), CAST(floor(o_totalprice / 10000) AS BIGINT),
            CASE WHEN o_orderpriority <> '2-HIGH' THEN CAST(floor(o_totalprice / 5000) AS BIGINT) END,
            987654321] END AS genres,
        [o_custkey, o_custkey + 1, o_custkey] AS platforms,
        o_orderstatus <> 'O' AS _is_current FROM orders""",
    "genres": "SELECT s_suppkey AS id, s_name AS name FROM supplier",
    "platforms": "SELECT p_partkey AS id, p_name AS name FROM part",
    "batch_logs": """SELECT stretch * 10 + kind AS batch_id, strftime(created_at, 'run-%Y-%m-%d') AS run_id,
        table_name, 'RAW' AS layer, CASE WHEN top >= 300 THEN 'FAILED' ELSE 'SUCCESS' END AS status,
        cursor_value, stretch * 500 AS offset_value, records_count, duration_ms,
        'updated_at >= ' || cursor_value AS query_sent,
        CASE WHEN top >= 300 THEN 'timeout' END AS error_message, created_at
        FROM (SELECT event_type AS table_name, event_id // 500 AS stretch,
            list_position(['click', 'error', 'purchase', 'signup', 'view'], event_type) AS kind,
            count(*) AS records_count, min(sec) AS cursor_value, max(ts) AS created_at,
            max(value) AS top, max(event_id) - min(event_id) AS duration_ms
            FROM ev GROUP BY 1, 2, 3)""",
    "runs": """SELECT strftime(started_at, 'run-%Y-%m-%d-%H') AS run_id, started_at,
        CASE WHEN status <> 'RUNNING' THEN ended END AS completed_at,
        CASE WHEN hour(started_at) < 12 THEN 'RAW' ELSE 'ANALYTICS' END AS layer, status,
        CASE WHEN status = 'FAILED' THEN 'boom' END AS error_message
        FROM (SELECT date_trunc('hour', ts) AS h, min(ts) AS started_at, max(ts) AS ended,
            CASE WHEN max(value) >= 250 THEN 'FAILED' WHEN min(value) < 0.5 THEN 'RUNNING'
            ELSE 'COMPLETED' END AS status FROM ev GROUP BY 1)""",
    "checkpoints": """SELECT table_name || ':' || layer AS checkpoint_id, table_name,
        CASE WHEN table_name = 'view' THEN 0 ELSE current_watermark END AS current_watermark,
        fallback_watermark, last_id, last_batch_id, layer, 0 AS offset_val,
        table_name = 'error' AS is_override_active,
        strftime(updated_at, 'run-%Y-%m-%d-%H') AS last_successful_run_id, updated_at
        FROM (SELECT event_type AS table_name,
            CASE WHEN hour(ts) < 12 THEN 'RAW' ELSE 'ANALYTICS' END AS layer,
            max(sec) AS current_watermark, min(sec) AS fallback_watermark, max(event_id) AS last_id,
            count(*) AS last_batch_id, max(ts) AS updated_at FROM ev GROUP BY 1, 2)""",
    "fallback_events": """SELECT table_name || '-' || day AS event_id, table_name,
        CASE WHEN n >= 66 THEN 'RAW' ELSE 'ANALYTICS' END AS layer, start_watermark, end_watermark,
        status, CASE WHEN status = 'COMPLETED' THEN n ELSE 0 END AS records_processed,
        CASE WHEN status = 'FAILED' THEN 'boom' END AS error_message, created_at,
        CASE WHEN status IN ('COMPLETED', 'FAILED') THEN ended END AS completed_at
        FROM (SELECT event_type AS table_name, strftime(ts, '%Y-%m-%d') AS day, min(sec) AS start_watermark,
            max(sec) AS end_watermark, count(*) AS n, min(ts) AS created_at, max(ts) AS ended,
            CASE WHEN max(value) >= 300 THEN 'FAILED'
                WHEN min(value) < 0.5 AND event_type <> 'signup' THEN 'PENDING'
                WHEN min(value) < 1 THEN 'IN_PROGRESS' ELSE 'COMPLETED' END AS status
            FROM ev GROUP BY 1, 2)""",
    "payloads": """SELECT event_type AS table_name, dayofyear(ts) AS batch_id,
        '{"id":' || event_id || ',"user":' || user_id
        || CASE WHEN event_type = 'purchase' THEN ',"amount":' || value ELSE '' END
        || CASE WHEN event_type = 'click' AND dayofyear(ts) < 10 THEN ',"session":' || user_id ELSE '' END
        || CASE WHEN event_type = 'click' AND dayofyear(ts) >= 10 THEN ',"session":"s' || user_id || '"' ELSE '' END
        || CASE WHEN event_type = 'view' AND dayofyear(ts) >= 12 AND dayofyear(ts) < 20
            THEN ',"agent":null,"tags":[' || user_id || ']' ELSE '' END
        || CASE WHEN event_type = 'error' AND dayofyear(ts) >= 25 THEN ',"fatal":true' ELSE '' END
        || ',"props":' || props || '}' AS record FROM ev""",
    "profile": """SELECT table_name, batch_id, field, type, count(*) AS rows FROM (
        SELECT table_name, batch_id, field, CASE json_type(record, '$.' || field)
            WHEN 'UBIGINT' THEN 'bigint' WHEN 'BIGINT' THEN 'bigint' WHEN 'DOUBLE' THEN 'double'
            WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'ARRAY' THEN 'array<bigint>'
            WHEN 'OBJECT' THEN 'object' END AS type
        FROM (SELECT table_name, batch_id, record, unnest(json_keys(record)) AS field FROM payloads))
        WHERE type IS NOT NULL GROUP BY 1, 2, 3, 4""",
    "snapshots": """SELECT table_name, batch_id, list(field || ':' || type ORDER BY field) AS pairs,
        sha256(string_agg(field || ':' || type, ',' ORDER BY field || ':' || type)) AS schema_hash
        FROM (SELECT table_name, batch_id, field, string_agg(type, '|' ORDER BY type) AS type
            FROM profile GROUP BY 1, 2, 3) GROUP BY 1, 2""",
}


def with_ctes(*names: str, sql: str) -> str:
    """A statement with the named expressions, and those they build on, in front."""
    order = list(BASE)
    wanted: set[str] = set()

    def need(name: str) -> None:
        if name not in wanted:
            wanted.add(name)
            for other in order:
                if other != name and f"FROM {other}" in BASE[name]:
                    need(other)

    for name in names:
        need(name)
    parts = [f"{n} AS ({BASE[n]})" for n in order if n in wanted]
    head = sql.lstrip()
    if head.upper().startswith("WITH "):
        return "WITH " + ", ".join(parts) + ", " + head[5:]
    return "WITH " + ", ".join(parts) + " " + head
