"""Landing, loading, streaming, replay and the full cycle."""

import json
import os
from dataclasses import replace as changed
from datetime import datetime, timezone

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidemark import spec as s
from tidemark.plans import control
from tidemark.plans.ledger import Ledger
from tidemark.plans.load import DataQualityError, load_table
from tidemark.sources.pages import land_pages, missing_pages, list_pages, scan_pages, scan_refs
from tidemark.streaming import consumer, producer

COMPANY, GAME, GENRE = s.COMPANY, s.GAME, s.GENRE
NOW = datetime(2026, 9, 8, 20, tzinfo=timezone.utc)
T0 = 1_700_000_000


def games(spark, *rows):
    return spark.createDataFrame(rows, "id long, name string, updated_at long, genres array<long>")


def companies(spark, n, start=T0):
    return spark.range(n).select(
        "id", F.concat(F.lit("c"), "id").alias("name"), (F.lit(start) + F.col("id")).alias("updated_at")
    )


def test_landed_pages_read_back_whole(spark, tmp_path):
    root = str(tmp_path)
    pages = land_pages(companies(spark, 1201), COMPANY, root, NOW, since=T0)
    found = {(p.cursor, p.offset): p.records for p in pages.collect()}
    assert found == {(T0, 0): 500, (T0, 500): 500, (T0, 1000): 201}
    back = scan_pages(spark, COMPANY, f"{root}/companies")
    assert back.count() == 1201
    day = tmp_path / "companies/year=2026/month=09/day=08"
    assert {f.name for f in day.iterdir()} == {f"{T0}_{o}.json" for o in (0, 500, 1000)}
    one = scan_pages(spark, COMPANY, f"{day}/{T0}_500.json")
    assert {(r._cursor, r._offset) for r in one.collect()} == {(T0, 500)}
    assert one.count() == 500


def test_landing_again_replaces_pages(spark, tmp_path):
    for _ in range(2):
        land_pages(companies(spark, 700), COMPANY, str(tmp_path), NOW, since=T0)
    assert scan_pages(spark, COMPANY, f"{tmp_path}/companies").count() == 700


def test_page_names_stay_unique_when_one_second_holds_all_rows(spark, tmp_path):
    small = changed(COMPANY, page_size=5000)
    same = companies(spark, 25_000).withColumn("updated_at", F.lit(T0).cast("long"))
    pages = land_pages(same, small, str(tmp_path), NOW, since=T0).collect()
    assert sorted((p.cursor, p.offset) for p in pages) == [(T0, o) for o in range(0, 25_000, 5000)]


def test_array_files_and_missing_files(spark, tmp_path):
    day = tmp_path / "companies/year=2026/month=09/day=08"
    day.mkdir(parents=True)
    for offset, ids in ((0, [1, 2]), (500, [3])):
        records = [{"id": i, "name": "n", "updated_at": T0 + i, "other": [1]} for i in ids]
        (day / f"{T0}_{offset}.json").write_text(json.dumps(records))
    refs = spark.createDataFrame(
        [(T0, 0, NOW), (T0, 500, NOW)], "cursor_value long, offset_value long, created_at timestamp"
    )
    assert scan_refs(spark, COMPANY, str(tmp_path), refs).count() == 3
    assert scan_refs(spark, COMPANY, str(tmp_path), refs.where("offset_value > 0")).count() == 1
    logged = spark.createDataFrame(
        [(f"companies/year=2026/month=09/day=08/{T0}_{o}.json",) for o in (0, 500, 1000)], "path string"
    )
    gone = missing_pages(logged, list_pages(spark, str(tmp_path))).collect()
    assert [r.path for r in gone] == [f"companies/year=2026/month=09/day=08/{T0}_1000.json"]


def test_upsert_load_is_idempotent_and_order_free(spark, store):
    one = companies(spark, 50)
    two = one.where("id >= 25").select("id", F.lit("new").alias("name"), (F.col("updated_at") + 1000).alias("updated_at"))
    for frame in (one, two, two):
        load_table(store, COMPANY, frame, NOW)
    table = store.read(COMPANY.main_table())
    assert table.count() == 50
    assert table.where("name = 'new'").count() == 25
    assert "_hash" in table.columns and table.where("_hash is null").count() == 0


def test_token_makes_a_retry_a_no_op(spark, store):
    load_table(store, COMPANY, companies(spark, 5), NOW, token="q:0")
    load_table(store, COMPANY, companies(spark, 9), NOW, token="q:0")
    assert store.read(COMPANY.main_table()).count() == 5


def test_replay_keeps_newer_rows(spark, store):
    old = companies(spark, 5)
    new = old.select("id", F.lit("new").alias("name"), (F.col("updated_at") + 10).alias("updated_at"))
    load_table(store, COMPANY, new, NOW)
    load_table(store, COMPANY, old, NOW)
    assert store.read(COMPANY.main_table()).where("name = 'new'").count() == 5
    same = new.withColumn("name", F.lit("again"))
    load_table(store, COMPANY, same, NOW)
    assert store.read(COMPANY.main_table()).where("name = 'again'").count() == 5


def test_pages_in_any_order_leave_the_newest_version(spark, store, tmp_path):
    root, small = str(tmp_path / "raw"), changed(COMPANY, page_size=20)
    versions = spark.range(200).select(
        (F.col("id") % 20).alias("id"), F.col("id").cast("string").alias("name"), (F.lit(T0) + F.col("id")).alias("updated_at")
    )
    land_pages(versions, small, root, NOW, since=T0)
    for n, file in enumerate(sorted(tmp_path.glob("raw/companies/*/*/*/*.json"))):
        os.utime(file, (T0 - n, T0 - n))
    query = consumer.follow(store, small, root, str(tmp_path / "cp"), pages=2, until_idle=True)
    query.awaitTermination()
    rows = store.read(COMPANY.main_table()).collect()
    assert {(r.id, r.name) for r in rows} == {(i, str(180 + i)) for i in range(20)}


def test_follow_replaces_by_whole_snapshots(spark, store, tmp_path):
    root, small = str(tmp_path / "raw"), changed(GENRE, page_size=20)
    source = companies(spark, 200)
    producer.land(store, small, source, root, "run-1", NOW, 0)
    query = consumer.follow(store, small, root, str(tmp_path / "cp"), pages=4, until_idle=True)
    query.awaitTermination()
    assert store.read(GENRE.main_table()).count() == 200


def test_reading_a_missing_table_writes_nothing(store, tmp_path):
    assert not store.exists(COMPANY.main_table()) and store.read(COMPANY.main_table()).count() == 0
    assert not (tmp_path / "tables").exists()


def test_history_in_steps_equals_history_at_once(spark, store, tmp_path):
    rows = [(1, "a", T0, [1]), (1, "b", T0 + 100, [2]), (2, "x", T0 + 5, None), (1, "late", T0 + 50, [3])]
    for row in rows:
        load_table(store, GAME, games(spark, row), NOW)
    load_table(store, GAME, games(spark, rows[1]), NOW)
    pick = ["id", "name", "_valid_from", "_valid_to", "_is_current", "genres"]
    stepwise = store.read(GAME.main_table()).select(*pick).orderBy("id", "_valid_from").collect()
    other = type(store)(spark, str(tmp_path / "once"))
    load_table(other, GAME, games(spark, *rows), NOW)
    assert stepwise == other.read(GAME.main_table()).select(*pick).orderBy("id", "_valid_from").collect()
    assert [(r.name, r._is_current) for r in stepwise] == [("a", False), ("late", False), ("b", True), ("x", True)]
    assert stepwise[0]._valid_to == stepwise[1]._valid_from


def test_late_versions_slot_in(spark, store):
    table = GAME.main_table()
    for row in ((1, "a", T0, None), (1, "b", T0 + 9, None), (2, "x", T0, None), (1, "late", T0 + 5, None)):
        load_table(store, GAME, games(spark, row), NOW)
    rows = store.read(table).where("id = 1").orderBy("_valid_from").collect()
    assert [r.name for r in rows] == ["a", "late", "b"]
    assert [r._valid_to for r in rows[:-1]] == [r._valid_from for r in rows[1:]]
    assert {(r.id, r.name) for r in store.current(table).collect()} == {(1, "b"), (2, "x")}


def files_of(folder):
    return [f for f in folder.rglob("*.parquet") if "_staged" not in str(f)]


def rows_in(folder):
    return sum(pq.read_metadata(f).num_rows for f in files_of(folder))


@pytest.mark.parametrize("spec", [s.COMPANY, changed(s.COMPANY, keep_history=True)])
def test_a_load_writes_its_own_rows_only(spark, store, tmp_path, spec):
    load_table(store, spec, companies(spark, 5000), NOW)
    folder = tmp_path / "tables" / spec.main_table().name
    before, held = set(files_of(folder)), rows_in(folder)
    load_table(store, spec, companies(spark, 3, T0 + 9000), NOW)
    assert before < set(files_of(folder)) and rows_in(folder) == held + 3
    assert store.read(spec.main_table()).where(f"updated_at >= {T0 + 9000}").count() == 3


@pytest.mark.parametrize("spec", [s.COMPANY, s.GAME, changed(s.GAME, path="bundles", name="Bundle", keep_history=False)])
def test_fold_changes_no_result(spark, store, tmp_path, spec):
    rows = [(1, "a", T0, [1]), (2, "x", T0 + 5, None), (1, "b", T0 + 100, [2]), (1, "late", T0 + 50, [3])]
    tables = [spec.main_table(), *([spec.junction_table("genres")] if spec.list_fields and not spec.keep_history else [])]

    def state():
        return [sorted(store.read(t).drop("_ingested_at", "_hash").collect(), key=repr) for t in tables]

    for row in rows[:3]:
        load_table(store, spec, games(spark, row).select(*[c for c in ("id", "name", "updated_at", "genres") if c in spec.fields]), NOW)
    before = state()
    for t in tables:
        store.fold(t)
        assert len(store.parts(t)) == 1
    assert state() == before
    load_table(store, spec, games(spark, rows[3]).select(*[c for c in ("id", "name", "updated_at", "genres") if c in spec.fields]), NOW)
    assert store.read(tables[0]).where("id = 1").count() == (3 if spec.keep_history else 1)


def test_record_without_version_is_refused(spark, store, tmp_path):
    source = companies(spark, 5).withColumn("updated_at", F.expr("nullif(updated_at, 1700000003)"))
    with pytest.raises(Exception, match="a record lacks updated_at"):
        producer.land(store, COMPANY, source, str(tmp_path), "r", NOW, T0)


def test_junctions_and_main_projection(spark, store):
    spec = changed(GAME, path="bundles", name="Bundle", keep_history=False)
    load_table(store, spec, games(spark, (1, "a", T0, [3, 3, None, 4]), (2, "b", T0, [])), NOW)
    load_table(store, spec, games(spark, (1, "a", T0 + 1, [4, 5])), NOW)
    assert "genres" not in store.read(spec.main_table()).columns
    pairs = store.read(spec.junction_table("genres"))
    assert pairs.columns == ["bundle_id", "genre_id"]
    assert sorted(tuple(r) for r in pairs.collect()) == [(1, 3), (1, 4), (1, 5)]


def test_null_key_fails_the_load_and_writes_nothing(spark, store):
    bad = spark.createDataFrame([(10, "Valid Game"), (None, "Corrupted Record")], "id long, name string")
    with pytest.raises(DataQualityError):
        load_table(store, GENRE, bad, NOW)
    assert not store.exists(GENRE.main_table())


def test_mixed_types_fail_or_go_to_quarantine(spark, store, tmp_path):
    day = tmp_path / "companies/year=2026/month=09/day=08"
    day.mkdir(parents=True)
    records = [
        {"id": 1, "name": "a", "country": 4.0, "updated_at": T0},
        {"id": 2, "name": "b", "country": "q", "updated_at": T0},
        {"id": 3, "name": "c", "country": 4.5, "updated_at": T0},
    ]
    (day / f"{T0}_0.json").write_text(json.dumps(records))
    raw = scan_pages(spark, COMPANY, str(tmp_path / "companies"))
    with pytest.raises(DataQualityError, match="2 of 3"):
        load_table(store, COMPANY, raw, NOW)
    done = load_table(store, COMPANY, raw, NOW, on_fault="quarantine")
    assert (done.read, done.rows, done.quarantined) == (3, 1, 2)
    assert [r.country for r in store.read(COMPANY.main_table()).collect()] == [4]


def test_list_field_with_a_scalar_is_a_fault(spark, store, tmp_path):
    day = tmp_path / "games/year=2026/month=09/day=08"
    day.mkdir(parents=True)
    records = [
        {"id": 1, "name": "a", "genres": [2, 1], "updated_at": T0},
        {"id": 2, "name": "b", "genres": 5, "updated_at": T0},
        {"id": 3, "name": "c", "genres": [1, "z"], "updated_at": T0},
    ]
    (day / f"{T0}_0.json").write_text(json.dumps(records))
    raw = scan_pages(spark, GAME, str(tmp_path / "games"))
    done = load_table(store, GAME, raw, NOW, on_fault="quarantine")
    assert (done.rows, done.quarantined) == (1, 2)
    assert store.read(GAME.main_table()).first().genres == [2, 1]


def test_history_mode_switch_is_refused(spark, store):
    load_table(store, COMPANY, companies(spark, 2), NOW)
    with pytest.raises(RuntimeError, match="migrate"):
        load_table(store, changed(COMPANY, keep_history=True), companies(spark, 2), NOW)


def test_drain_twice_and_more_pages(spark, store, tmp_path):
    root, checkpoint = str(tmp_path / "raw"), str(tmp_path / "cp")
    assert consumer.drain(store, COMPANY, root, checkpoint) is False
    land_pages(companies(spark, 1200), COMPANY, root, NOW, since=T0)
    consumer.drain(store, COMPANY, root, checkpoint)
    consumer.drain(store, COMPANY, root, checkpoint)
    assert store.read(COMPANY.main_table()).count() == 1200
    assert store.read(s.BATCH_LOGS).where("layer = 'ANALYTICS'").count() == 1
    later = companies(spark, 600).select("id", F.lit("z").alias("name"), (F.col("updated_at") + 5000).alias("updated_at"))
    land_pages(later, COMPANY, root, NOW, since=T0 + 5000)
    consumer.drain(store, COMPANY, root, checkpoint)
    table = store.read(COMPANY.main_table())
    assert (table.count(), table.where("name = 'z'").count()) == (1200, 600)
    mark = store.read(s.CHECKPOINTS).where("layer = 'ANALYTICS'").collect()
    assert [(m.table_name, m.current_watermark) for m in mark] == [("Company", T0 + 5599)]


def test_small_micro_batches_equal_one_load(spark, store, tmp_path):
    root = str(tmp_path / "raw")
    small = changed(COMPANY, page_size=100)
    land_pages(companies(spark, 1000), small, root, NOW, since=T0)
    query = consumer.follow(store, small, root, str(tmp_path / "cp"), pages=4, until_idle=True)
    query.awaitTermination()
    assert store.read(COMPANY.main_table()).count() == 1000
    assert store.read(s.BATCH_LOGS).where("layer = 'ANALYTICS'").count() == 3


def test_full_cycle_with_replay(spark, store, tmp_path):
    root, cps = str(tmp_path / "raw"), str(tmp_path / "cps")
    genres = spark.createDataFrame(
        [(i, f"g{i}", T0 + i) for i in range(1200)], "id long, name string, updated_at long"
    )
    source = {
        "Company": companies(spark, 30),
        "Game": games(spark, *[(i, f"n{i}", T0 + i, [i % 3]) for i in range(40)]),
        "Genre": genres,
    }
    specs = [COMPANY, GAME, GENRE]
    ledger = Ledger(store)
    dangling = ledger.start_run("RAW", NOW)
    producer.run_cycle(store, source, specs, root, cps)
    runs = {r.run_id: r for r in store.read(s.RUNS).collect()}
    assert runs[dangling].status == "FAILED" and runs[dangling].error_message.startswith("Interrupted")
    assert sorted(r.status for r in runs.values()) == ["COMPLETED", "FAILED"]
    assert store.read(GENRE.main_table()).count() == 1200  # a snapshot of three pages
    assert store.read(GAME.main_table()).where("_is_current").count() == 40
    assert store.read(s.SCHEMA_HISTORY).count() == 3

    before = store.read(s.CHECKPOINTS).where("layer = 'ANALYTICS'").orderBy("table_name").collect()
    for layer in ("RAW", "ANALYTICS"):
        ledger.create_replay("Company", T0, T0 + 9, NOW, layer)
    source["Company"] = companies(spark, 30).withColumn("slug", F.lit("s"))
    source["Genre"] = genres.where("id < 7")
    producer.run_cycle(store, source, specs, root, cps)
    events = store.read(s.FALLBACK_EVENTS).collect()
    assert {e.status for e in events} == {"COMPLETED"}
    assert {e.layer: e.records_processed for e in events} == {"RAW": 10, "ANALYTICS": 10}
    after = store.read(s.CHECKPOINTS).where("layer = 'ANALYTICS'").orderBy("table_name").collect()
    assert [a.current_watermark for a in after] == [b.current_watermark for b in before]
    table = store.read(COMPANY.main_table())
    assert table.count() == 30 and table.where("slug = 's'").count() >= 10
    assert store.read(GENRE.main_table()).count() == 7
    drift = store.read(s.SCHEMA_HISTORY).where("table_name = 'Company'").orderBy("id").collect()
    assert [d.changed_columns.added for d in drift] == [["id", "name", "updated_at"], ["slug"]]
    ids = [r.batch_id for r in store.read(s.BATCH_LOGS).orderBy("batch_id").collect()]
    assert len(ids) == len(set(ids))


def test_window_without_batches_completes(spark, store, tmp_path):
    ledger = Ledger(store)
    row = ledger.create_replay("Company", 1, 2, NOW, "ANALYTICS").first()
    assert consumer.replay_pending(store, [COMPANY], str(tmp_path)) == 1
    event = store.read(s.FALLBACK_EVENTS).first()
    assert (event.event_id, event.status, event.records_processed) == (row.event_id, "COMPLETED", 0)


def test_override(spark, store):
    ledger = Ledger(store)
    assert ledger.set_override("Company", NOW) is False
    ledger.checkpoint("Company", "RAW", 5, NOW)
    assert ledger.set_override("Company", NOW, mark=3) is True
    row = store.read(s.CHECKPOINTS).first()
    assert (row.current_watermark, row.fallback_watermark, row.is_override_active) == (5, 3, True)
    ledger.checkpoint("Company", "RAW", 6, NOW)
    assert store.read(s.CHECKPOINTS).first().is_override_active is False


def test_follow_takes_pages_as_they_land(spark, store, tmp_path):
    root = str(tmp_path / "raw")
    land_pages(companies(spark, 20), COMPANY, root, NOW, since=T0)
    query = consumer.follow(store, COMPANY, root, str(tmp_path / "cp"))
    try:
        query.processAllAvailable()
        land_pages(companies(spark, 30, T0 + 100), COMPANY, root, NOW, since=T0 + 100)
        query.processAllAvailable()
    finally:
        query.stop()
    assert store.read(COMPANY.main_table()).count() == 30


def test_failed_micro_batch_is_logged_and_taken_up_again(spark, store, tmp_path):
    root, checkpoint = str(tmp_path / "raw"), str(tmp_path / "cp")
    day = tmp_path / "raw/companies/year=2026/month=09/day=08"
    day.mkdir(parents=True)
    records = [{"id": 1, "name": "a", "updated_at": T0}, {"id": None, "name": "b", "updated_at": T0}]
    (day / f"{T0}_0.json").write_text(json.dumps(records))
    with pytest.raises(Exception, match="1 of 2 records unfit"):
        consumer.drain(store, COMPANY, root, checkpoint)
    failed = store.read(s.BATCH_LOGS).collect()
    assert [(f.status, f.records_count) for f in failed] == [("FAILED", 0)]
    assert not store.exists(COMPANY.main_table()) and not store.exists(s.CHECKPOINTS)
    consumer.drain(store, COMPANY, root, checkpoint, on_fault="quarantine")
    assert store.read(COMPANY.main_table()).count() == 1


def test_store_modes(spark, store, tmp_path):
    table = s.TableSpec("t", s.record(("id", s.LONG), ("v", s.TEXT)), ("id",))
    one = spark.createDataFrame([(1, "a"), (2, "b")], table.schema)
    # What a writer leaves that broke off: rows that were never published.
    store.stage(table, one)
    assert not store.exists(table) and store.read(table).count() == 0
    store.write(table, one, "append")
    store.write(table, one.where("false"), "replace")
    store = type(store)(spark, str(tmp_path / "other"))
    store.write(table, one, "fail")
    with pytest.raises(FileExistsError):
        store.write(table, one, "fail")
    store.write(table, one, "append")
    assert store.read(table).count() == 4
    store.fold(table)
    assert store.read(table).count() == 4 and len(store.parts(table)) == 1
    store.write(table, one.limit(1), "replace")
    assert store.read(table).count() == 1
    store.write(table, one.where("id > 9"), "replace")
    assert store.read(table).count() == 0


def test_replay_reads_only_the_pages_of_its_window(spark, store, tmp_path):
    root, small = str(tmp_path / "raw"), changed(COMPANY, page_size=10)
    pages = land_pages(companies(spark, 100), small, root, NOW, since=T0)
    Ledger(store).log_pages(pages, small, "run", NOW, 0, "all")
    refs = control.pages_overlapping(store.read(s.BATCH_LOGS), "Company", T0 + 25, T0 + 40)
    files = scan_refs(spark, small, root, refs).inputFiles()
    # Page names carry the offset; the other pages are not even opened.
    assert sorted(f.rsplit("_", 1)[1] for f in files) == ["20.json", "30.json", "40.json"]
    event = Ledger(store).create_replay("Company", T0 + 25, T0 + 40, NOW, "ANALYTICS").first()
    assert consumer.replay(store, small, root, event.event_id, T0 + 25, T0 + 40, NOW) == 16
    # Rows logged without page bounds are judged by their cursor.
    old = store.read(s.BATCH_LOGS).withColumn("last_version", F.lit(None).cast("long"))
    assert control.pages_overlapping(old, "Company", T0 + 25, T0 + 40).count() == 10


def test_two_streams_share_the_control_tables(spark, store, tmp_path):
    root = str(tmp_path / "raw")
    specs = [changed(COMPANY, page_size=20), changed(COMPANY, name="Firm", path="firms", page_size=20)]
    for spec in specs:
        producer.land(store, spec, companies(spark, 100), root, f"run-{spec.name}", NOW, T0)
    streams = [consumer.follow(store, e, root, str(tmp_path / e.path), pages=1, until_idle=True, by_log=i == 0) for i, e in enumerate(specs)]
    for stream in streams:
        stream.awaitTermination()
    marks = {m.table_name: m.current_watermark for m in store.read(s.CHECKPOINTS).collect()}
    assert marks == {"Company": T0 + 99, "Firm": T0 + 99}
    done = store.read(s.BATCH_LOGS).where("layer = 'ANALYTICS'").groupBy("table_name").agg(F.sum("records_count"))
    assert {tuple(r) for r in done.collect()} == {("Company", 100), ("Firm", 100)}
    ids = [r.batch_id for r in store.read(s.BATCH_LOGS).collect()]
    assert len(ids) == len(set(ids))


def test_log_stream_goes_on_after_a_restart(spark, store, tmp_path):
    root, checkpoint = str(tmp_path / "raw"), str(tmp_path / "cp")
    for n in range(3):
        later = companies(spark, 40).select("id", F.lit(str(n)).alias("name"), (F.col("updated_at") + n * 1000).alias("updated_at"))
        producer.land(store, COMPANY, later, root, f"run-{n}", NOW, T0 + n * 1000)
        consumer.follow(store, COMPANY, root, checkpoint, until_idle=True, by_log=True).awaitTermination()
    loads = store.read(s.BATCH_LOGS).where("layer = 'ANALYTICS'").collect()
    assert [b.records_count for b in loads] == [40, 40, 40]
    assert {r.name for r in store.read(COMPANY.main_table()).collect()} == {"2"}
    assert store.read(s.CHECKPOINTS).first().last_batch_id == store.read(s.BATCH_LOGS).where("layer = 'RAW'").agg(F.max("batch_id")).first()[0]


def test_drift_is_logged_once_per_change(spark, store):
    ledger = Ledger(store)
    one, two = [spark.createDataFrame([(t,)], "value string") for t in ('{"id": 1}', '{"id": 1, "x": "y"}')]
    assert [ledger.log_drift(f, "value", COMPANY, "r", NOW) for f in (one, one, two, two, one)] == [1, 0, 1, 0, 1]
    both = one.withColumn("table_name", F.explode(F.array(F.lit("A"), F.lit("Company"))))
    assert ledger.log_drift(both, "value", None, "r", NOW) == 1


def test_started_runs_are_started_once(spark, store):
    ledger = Ledger(store)
    for at in (NOW, NOW.replace(hour=21)):
        ledger.start_run("RAW", at, "same")
    ledger.finish_run("same", "COMPLETED", NOW)
    runs = store.read(s.RUNS).collect()
    assert [(r.run_id, r.status, r.started_at.hour) for r in runs] == [("same", "COMPLETED", NOW.hour)]


def test_newest_versions_by_state(spark, store, tmp_path):
    """Late and equal versions are not sent again, also after a restart; rows without a version take no part."""
    from tidemark.streaming import latest

    latest.use_typed_state(spark)
    folder, sent = tmp_path / "in", []
    rows = [[(1, "a", 5, 0), (2, "x", 5, 0)], [(1, "old", 4, 0), (2, "y", 6, 0), (3, "n", None, 0)], [(2, "same", 6, 0), (2, "tie", 6, 1)]]
    for n, part in enumerate(rows):
        spark.createDataFrame(part, "id long, name string, v long, t long").coalesce(1).write.mode("append").json(str(folder))
        stream = spark.readStream.schema("id long, name string, v long, t long").json(str(folder))
        out = latest.newest_versions(stream, "id", "v", "t").writeStream.outputMode("update")
        out = out.foreachBatch(lambda f, b: sent.append(sorted(r.name for r in f.collect())))
        out.option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
        assert [names for names in sent if names] == [["a", "x"], ["y"], ["tie"]][: n + 1]


def test_a_backlog_takes_few_micro_batches(spark, store, tmp_path):
    """However many pages wait, their micro-batches are few, and every page is consumed."""
    root, small = str(tmp_path / "raw"), changed(COMPANY, page_size=2)
    land_pages(companies(spark, 60), small, root, NOW, since=T0)
    consumer.follow(store, small, root, str(tmp_path / "cp"), pages=1, until_idle=True).awaitTermination()
    assert store.read(COMPANY.main_table()).count() == 60
    loads = [b.records_count for b in store.read(s.BATCH_LOGS).where("layer = 'ANALYTICS'").collect()]
    assert sum(loads) == 60 and len(loads) <= consumer.BACKLOG_BATCHES


def test_newest_versions_of_a_backlog(spark, store, tmp_path):
    """Few micro-batches, no Python per key, and of every key the newest row is sent last and once."""
    from tidemark.streaming import latest

    latest.use_typed_state(spark)
    root, small, sent = str(tmp_path / "raw"), changed(COMPANY, page_size=4), []
    # Id 9 is delivered in its newest version again and again.
    versions = spark.range(120).select(
        (F.col("id") % 10).alias("id"), F.col("id").cast("string").alias("name"),
        F.when(F.col("id") % 10 == 9, T0 + 500).otherwise(T0 + F.col("id")).alias("updated_at"),
    )
    land_pages(versions, small, root, NOW, since=T0)
    pages = consumer.page_stream(store, small, root, 1, backlog=True)
    typed = pages.select(*[F.col(c).cast("long").alias(c) for c in ("id", "updated_at")], "name", F.lit(0).alias("tie"))
    newest = latest.newest_versions(typed, "id", "updated_at", "tie")
    assert newest.columns == ["id", "updated_at", "name", "tie"]
    assert "Py" not in newest._jdf.queryExecution().analyzed().toString()
    out = newest.writeStream.outputMode("update").foreachBatch(lambda f, b: sent.append({r.id: r for r in f.collect()}))
    out.option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    assert 1 < len(sent) <= consumer.BACKLOG_BATCHES
    last = {key: row.updated_at for batch in sent for key, row in batch.items()}
    assert last == {**{i: T0 + 110 + i for i in range(9)}, 9: T0 + 500}
    assert sum(9 in batch for batch in sent) == 1
