"""Market, governance, control and drift plans on small inputs."""

import json
import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tidemark import spec as s
from tidemark.operators import drift
from tidemark.plans import control, governance, market

NOW = datetime(2026, 9, 8, 20, tzinfo=timezone.utc)


def game_rows(spark, rows):
    return spark.createDataFrame(
        rows,
        "id long, name string, slug string, rating double, rating_count long, aggregated_rating double, "
        "total_rating double, total_rating_count long, hypes long, first_release_date long, "
        "genres array<long>, platforms array<long>, _is_current boolean",
    )


def game(i, name="g", rating=None, count=None, date=None, genres=None, platforms=None, current=True, hypes=None):
    return (i, name, f"s{i}", rating, count, rating, rating, count, hypes, date, genres, platforms, current)


def dims(spark):
    named = "id long, name string"
    return (
        spark.createDataFrame([(1, "RPG"), (2, "Puzzle"), (3, "Race")], named),
        spark.createDataFrame([(7, "PC")], named),
    )


def test_market(spark):
    genres, platforms = dims(spark)
    games = game_rows(
        spark,
        [
            game(1, "100% Orange_Juice", 80.05, 40, 1_000_000_000, [1, 1, 2, None, 9], [7]),
            game(2, "Orange", 90.0, 10, 1_000_000_000, [1], [7, 7]),
            game(3, "1000 Oranges", None, 99, 4_000_000_000, None, None),
            game(4, "Old", 99.0, 99, 1_000_000_000, [1], [7], current=False),
            game(5, "Rated", 70.0, 30, 1_050_000_000, [], [], hypes=4),
        ],
    )
    kpis = market.market_kpis(games, genres, platforms).first().asDict()
    assert kpis == {
        "total_games": 4, "rated_games": 3, "avg_user_rating": 80.0, "avg_critic_rating": 80.0,
        "total_genres": 3, "total_platforms": 1, "top_release_year": 2001,
    }
    empty = market.market_kpis(games.where("false"), genres, platforms).first().asDict()
    assert (empty["total_games"], empty["avg_user_rating"], empty["top_release_year"]) == (0, None, None)
    assert [tuple(r) for r in market.genre_distribution(games, genres).collect()] == [("RPG", 2), ("Puzzle", 1)]
    assert [tuple(r) for r in market.platform_distribution(games, platforms).collect()] == [("PC", 2)]
    assert [tuple(r) for r in market.release_timeline(games).collect()] == [(2001, 2), (2003, 1)]
    assert [(r.id, r.rating) for r in market.top_rated(games).collect()] == [(1, 80.1), (5, 70.0)]

    page = market.explorer_page(games, genres, platforms, search=" 100% o ").collect()
    assert [(r.id, r.genre_names, r.platform_names, r.release_year) for r in page] == [
        (1, ["RPG", "RPG", "Puzzle"], ["PC"], 2001),
        (3, [], [], None),
    ]
    assert [r.id for r in market.explorer_page(games, genres, platforms, search="orange_").collect()] == [1, 3]
    assert [r.id for r in market.explorer_page(games, genres, platforms, genre_id=2).collect()] == [1]
    by = lambda **o: [r.id for r in market.explorer_page(games, genres, platforms, **o).collect()]
    assert by(sort_by="hypes")[0] == 5 and by(sort_by="unknown") == [2, 1, 5, 3]
    assert by(sort_by="recent", offset=1, limit=2) == [5, 1]
    assert market.explorer_total(games, search="orange").first().total == 3


def test_tag_join_is_no_nested_loop(spark):
    genres, _ = dims(spark)
    games = game_rows(spark, [game(1, genres=[1])])
    plan = market.genre_distribution(games, genres)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "TakeOrderedAndProject" in plan


def frame(spark, table, *rows):
    filled = [tuple(r.get(n) for n in table.schema.fieldNames()) for r in rows]
    return spark.createDataFrame(filled, table.schema)


def batch(i, table="Game", status="SUCCESS", cursor=0, records=5, run="r", at=NOW):
    return {
        "batch_id": i, "table_name": table, "layer": "RAW", "status": status, "cursor_value": cursor,
        "offset_value": 0, "records_count": records, "run_id": run, "created_at": at,
    }


def test_batch_selection(spark):
    at = datetime(2026, 9, 8)
    log = frame(
        spark, s.BATCH_LOGS,
        batch(9, cursor=10), batch(12, cursor=1700000000, at=at), batch(13, status="FAILED"),
        batch(14, records=0), batch(15, "Genre", run="old"), batch(16, "Genre", run="new", at=NOW + timedelta(1)),
        batch(17, "Genre", run="new", at=NOW + timedelta(1)),
    )
    refs = control.batch_refs(control.batches_after(log, "Game", 10, 5), "games").collect()
    assert [(r.batch_id, r.path) for r in refs] == [(12, "games/year=2026/month=09/day=08/1700000000_0.json")]
    assert [r.batch_id for r in control.batches_in_window(log, "Game", 9, 10).collect()] == [9]
    assert control.batches_in_window(log, "Game", 10, 11).count() == 0
    assert {r.table_name: r.batch_id for r in control.latest_batch(log).collect()} == {"Game": 9, "Genre": 17}
    assert sorted(r.batch_id for r in control.latest_snapshot_batches(log).where("table_name = 'Genre'").collect()) == [16, 17]


def test_work_takes_oldest_replay_first(spark):
    event = lambda i, table, age, status="PENDING", layer="RAW": {
        "event_id": i, "table_name": table, "layer": layer, "start_watermark": 100 + age, "end_watermark": 200,
        "status": status, "records_processed": 0, "created_at": NOW - timedelta(hours=age),
    }
    events = frame(
        spark, s.FALLBACK_EVENTS,
        event("new", "Game", 1), event("old", "Game", 2), event("done", "Genre", 3, "COMPLETED"),
        event("other", "Genre", 3, layer="ANALYTICS"),
    )
    marks = frame(
        spark, s.CHECKPOINTS,
        {"table_name": "Genre", "layer": "RAW", "current_watermark": 77, "last_id": 4, "offset_val": 500, "last_batch_id": 3},
        {"table_name": "Platform", "layer": "RAW", "current_watermark": 0, "last_id": 0, "offset_val": 0, "last_batch_id": 9},
    )
    tables = control.registry(spark, s.ENTITIES)
    work = {r.table_name: r for r in control.resolve_work(tables, events, marks, "RAW").collect()}
    assert len(work) == 5
    assert (work["Game"].event_id, work["Game"].start_watermark, work["Game"].is_fallback) == ("old", 102, True)
    assert (work["Genre"].start_watermark, work["Genre"].offset_val, work["Genre"].end_watermark) == (77, 500, None)
    assert (work["Platform"].start_watermark, work["Platform"].last_batch_id) == (s.DEFAULT_START, 9)
    assert work["Company"].start_watermark == s.DEFAULT_START
    assert [r.event_id for r in control.pending_replays(events, "RAW").collect()] == ["old", "new"]


def test_drift_of_payloads(spark):
    def batch_of(i, *records):
        return [("T", i, json.dumps(r)) for r in records]

    rows = (
        batch_of(1, {"id": 1, "v": 2}, {"v": None, "id": 2})
        + batch_of(2, {"v": 3, "id": 1})
        + batch_of(3, {"id": 1, "v": 2.5, "w": [1]})
        + batch_of(4, {"id": 1, "v": 2})
        + batch_of(5, {"id": 1, "v": 2, "a": 1, "b": 1, "c": 1, "d": {"x": 1}})
    )
    text = spark.createDataFrame(rows, "table_name string, batch_id long, record string")
    seen = drift.snapshots(drift.profile_records(text, "record", "table_name", "batch_id"), "table_name", "batch_id")
    events = {r.batch_id: r for r in drift.drift_events(seen).collect()}
    assert sorted(events) == [1, 3, 4, 5]
    assert events[1].changed_columns.added == ["id", "v"] and events[1].previous_hash is None
    assert events[3].changed_columns.type_changed["v"].asDict() == {"old": "bigint", "new": "double"}
    assert events[4].schema_hash == events[1].schema_hash  # back to an old schema is an event as well
    logged = seen.where("batch_id = 1").select(
        F.lit(1).cast("long").alias("id"), "table_name", "schema_hash", "columns_snapshot", F.lit(NOW).alias("detected_at")
    )
    assert sorted(r.batch_id for r in drift.drift_events(seen, logged).collect()) == [3, 4, 5]

    history = drift.drift_events(seen).select(
        F.col("batch_id").alias("id"), "table_name", "schema_hash", "columns_snapshot", "changed_columns",
        F.timestamp_seconds("batch_id").alias("detected_at"),
    )
    report = [(r.id, r.changes_summary, r.column_name, r.data_type) for r in governance.drift_report(history).collect()]
    assert report == [
        (5, "+4 col: a, b, c...", "a, b, c, d", "NEW COLUMN"),
        (4, "-1 col: w | ~1 type: v", "w", "MODIFIED (1)"),
        (3, "+1 col: w | ~1 type: v", "w", "MODIFIED (1)"),
        (1, "+2 col: id, v", "id, v", "NEW COLUMN"),
    ]
    unchanged = history.where("id = 1").withColumn("changed_columns", F.lit(None).cast(s.CHANGED_COLUMNS))
    assert governance.drift_report(unchanged).first().changes_summary == "Initial Snapshot / Unchanged"


def test_report_reads_json_text(spark):
    texts = [
        '{"added":["a"],"removed":[],"type_changed":{"x":{"old":"bigint","new":"string"}}}',
        "not json",
        None,
    ]
    rows = [(i, "T", text, NOW - timedelta(i)) for i, text in enumerate(texts)]
    history = spark.createDataFrame(rows, "id int, table_name string, changed_columns string, detected_at timestamp")
    found = [(r.changes_summary, r.data_type) for r in governance.drift_report(history).collect()]
    nothing = ("Initial Snapshot / Unchanged", "UNCHANGED")
    assert found == [("+1 col: a | ~1 type: x", "MODIFIED (1)"), nothing, nothing]


def test_page_text_profile(spark):
    texts = [json.dumps([{"id": 1}, {"id": 2, "x": "a"}]), json.dumps({"id": 3})]
    pages = spark.createDataFrame([("T", t) for t in texts], "t string, page string")
    assert {(r.field, r.type, r.rows) for r in drift.profile_pages(pages, "page", "t").collect()} == {
        ("id", "bigint", 3),
        ("x", "string", 1),
    }
    declared = drift.declared_profile(pages.select("t"), s.GENRE)
    assert {(r.field, r.type) for r in declared.collect()} >= {("id", "bigint"), ("name", "string")}


def test_stats_and_lists_of_empty_tables(spark):
    empty = {t.name: frame(spark, t) for t in (s.RUNS, s.CHECKPOINTS, s.BATCH_LOGS, s.SCHEMA_HISTORY, s.FALLBACK_EVENTS)}
    stats = governance.dashboard_stats(
        empty["ingestion_runs"], empty["ingestion_checkpoints"], empty["batch_logs"],
        empty["schema_history"], empty["fallback_events"],
    )
    assert set(stats.first().asDict().values()) == {0}
    assert governance.runs_history(empty["ingestion_runs"]).count() == 0


def test_registered_queries_have_sql():
    import __spark_entry__ as contract
    from workload.registry import QUERIES, SQL

    # Queries of the optional subpackage may lack SQL where SQL cannot express them.
    assert set(SQL) == set(QUERIES)
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("sort_by", ["rating", "recent", "hypes", "name"])
def test_seek_equals_offset(spark, sort_by):
    rng = random.Random(1)
    pick = lambda *values: rng.choice([None, *values])
    rows = [(i, pick("a", "b"), pick(1.0, 2.0, 3.0), pick(1, 2), pick(5, 6), pick(7, 8)) for i in range(40)]
    frame = spark.createDataFrame(rows, "id long, name string, rating double, rating_count long, hypes long, first_release_date long")
    ordered = frame.orderBy(*market.explorer_order(sort_by)).collect()
    for at in (0, 7, 20, 38, 39):
        seen = market.behind(market.explorer_keys(sort_by), ordered[at].asDict())
        assert frame.where(seen).orderBy(*market.explorer_order(sort_by)).collect() == ordered[at + 1 :]
