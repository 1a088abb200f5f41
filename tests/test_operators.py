"""Operators on inline frames, with the edges that matter for their results."""

import hashlib
import random
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tidemark import spec as s
from tidemark.functions.columns import date_guard, elapsed_seconds, epoch_year, page_path, row_hash
from tidemark.operators import history, merge, paging, quality
from tidemark.operators.align import align, misfits, stamp, union_diagonal
from tidemark.operators.dedup import dedup_records
from tidemark.operators.drift import profile_records
from tidemark.operators.neighbours import with_neighbours
from tidemark.operators.relations import attach_names, junctions

NOW = datetime(2026, 9, 8, 20, tzinfo=timezone.utc)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_names_and_schemas():
    assert [e.table_name for e in s.ENTITIES] == ["companies", "games_scd2", "genres", "platforms", "release_dates"]
    words = "companies involved_companies genres platforms statuses boxes matches class release_dates"
    assert [s.singular(w) for w in words.split()] == (
        "company involved_company genre platform status box match class release_date".split()
    )
    assert len(s.GAME.fields) == 28 and len(s.GAME.list_fields) == 7
    assert "genres" in s.GAME.main_fields and s.GAME.required == ["id", "name"]
    assert s.GAME.main_table().schema.fieldNames()[-3:] == ["_valid_from", "_valid_to", "_is_current"]


def test_align_fills_and_drops(spark):
    rows = [(101, "Elden Ring", 1700000000, "x"), (102, "Cyberpunk 2077", 1700000010, "y")]
    raw = spark.createDataFrame(rows, "id long, name string, updated_at long, legacy string")
    done = stamp(align(raw, s.GAME.schema), s.GAME.schema, NOW)
    assert done.columns == s.GAME.fields + ["_ingested_at", "_hash"]
    found = done.orderBy("id").collect()
    assert [r.name for r in found] == ["Elden Ring", "Cyberpunk 2077"]
    assert all(r.rating is None and r.summary is None and r.genres is None and r._hash for r in found)


def test_casts_and_misfits(spark):
    schema = s.record(("n", s.LONG), ("x", s.REAL), ("l", s.LONGS), ("b", s.FLAG))
    rows = [
        ("4", "1.5", "[1,2]", "true"),
        ("4.0", "1", "[]", "false"),
        ("4.5", "q", "[1,null,\"z\"]", "maybe"),
        ("9223372036854775807", None, None, None),
        ("9223372036854775808", "1e3", "5", None),
    ]
    raw = spark.createDataFrame(rows, "n string, x string, l string, b string")
    done = raw.select(misfits(raw, schema).alias("bad"), *align(raw, schema).columns).collect()
    assert [r.bad for r in done] == [[], [], ["n", "x", "l", "b"], [], ["n", "l"]]
    cast = align(raw, schema).collect()
    assert [r.n for r in cast] == [4, 4, None, 2**63 - 1, None]
    assert [r.x for r in cast] == [1.5, 1.0, None, None, 1000.0]
    assert cast[0].l == [1, 2] and cast[1].l == [] and cast[3].l is None


def test_row_hash(spark):
    schema = s.record(("id", s.LONG), ("t", s.TEXT), ("x", s.REAL), ("l", s.LONGS))
    rows = [(1, "a|b", 85.5, [10, 9, None]), (2, None, None, []), (3, "", 1.0, None)]
    frame = spark.createDataFrame(rows, schema)
    got = [r.h for r in frame.orderBy("id").select(row_hash(schema).alias("h")).collect()]
    assert got == [sha("1|a|b|85.5|10,9"), sha("2|||"), sha("3||1.0|")]
    some = frame.where("id = 1").select(row_hash(schema, exclude=("x",)).alias("h")).first().h
    assert some == sha("1|a|b|10,9")


def test_dates_and_paths(spark):
    edges = [315532799, 315532800, 1924991998, 1924991999, -5, None]
    frame = spark.createDataFrame([(i, e) for i, e in enumerate(edges)], "i int, t long")
    found = frame.orderBy("i").select(date_guard(F.col("t")).alias("g"), epoch_year(F.col("t")).alias("y")).collect()
    assert [r.g for r in found] == [False, True, True, False, False, False]
    assert [r.y for r in found] == [1979, 1980, 2030, 2030, 1969, None]
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert frame.where("i = 1").select(epoch_year(F.col("t"))).first()[0] == 1980
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    ref = spark.createDataFrame([(datetime(2026, 9, 8, 20), 1700000000, 500)], "at timestamp, c long, o long")
    path = ref.select(page_path("games", F.col("at"), F.col("c"), F.col("o"))).first()[0]
    assert path == "games/year=2026/month=09/day=08/1700000000_500.json"
    spans = spark.sql(
        "select timestamp'2026-01-01 00:00:00' a, timestamp'2026-01-01 00:00:01.5' b, cast(null as timestamp) c"
    )
    assert tuple(spans.select(elapsed_seconds(F.col("a"), F.col("b")), elapsed_seconds(F.col("a"), F.col("c"))).first()) == (2, None)


def test_union_of_numbers_and_text(spark):
    a = spark.createDataFrame([(1, 2)], "id long, v long")
    b = spark.createDataFrame([(2, "7")], "id long, v string")
    schema = s.record(("id", s.LONG), ("v", s.LONG), ("w", s.TEXT))
    assert sorted(map(tuple, union_diagonal([a, b], schema).collect())) == [(1, 2, None), (2, 7, None)]


def test_dedup(spark):
    rows = [(1, "Game V1", 1000), (1, "Game V2 Updated", 2000), (2, "Unique Game", 1500), (3, "null time", None), (3, "timed", 1)]
    frame = spark.createDataFrame(rows, "id long, name string, updated_at long")
    best = {r.id: r.name for r in dedup_records(frame).collect()}
    assert best == {1: "Game V2 Updated", 2: "Unique Game", 3: "timed"}
    tie = spark.createDataFrame([(1, "a", 5, 1), (1, "b", 5, 2)], "id long, name string, updated_at long, _cursor long")
    for frame in (tie, tie.orderBy(F.desc("_cursor"))):
        assert [r.name for r in dedup_records(frame, arrival=("_cursor",)).collect()] == ["b"]
    assert dedup_records(tie.drop("id")).count() == 2
    assert [r.name for r in dedup_records(tie.drop("updated_at"), arrival=("_cursor",)).collect()] == ["b"]


def test_no_junctions_without_lists(spark):
    frame = spark.createDataFrame([(1001, "Action RPG", "action-rpg")], "id long, name string, slug string")
    assert junctions(frame, s.GENRE) == {}
    assert junctions(frame, s.GAME) == {}


def test_names_keep_list_order_and_repeated_keys(spark):
    rows = [(1, [3, 1, 99, 1]), (2, None), (3, []), (4, [None, 2]), (1, [2]), (1, [2]), (None, [1])]
    frame = spark.createDataFrame(rows, "id long, tags array<long>")
    dim = spark.createDataFrame([(1, "one"), (2, "two"), (3, "three")], "id long, name string")
    named = attach_names(frame, "id", {"names": ("tags", dim)}).collect()
    expected = [(1, ["three", "one", "one"]), (2, []), (3, []), (4, ["two"]), (1, ["two"]), (1, ["two"]), (None, ["one"])]
    assert sorted(((r.id, r.names) for r in named), key=repr) == sorted(expected, key=repr)


def test_malformed_records_are_left_out_of_a_profile(spark):
    frame = spark.createDataFrame([(1, '{"a": 1}'), (1, '{"a": ')], "batch long, record string")
    assert [tuple(r) for r in profile_records(frame, "record", "batch").collect()] == [(1, "a", "bigint", 1)]


def test_neighbours_match_plain_loops(spark):
    random.seed(3)
    rows = [(k, o, f"v{k}-{o}" if o % 5 else None) for k in range(4) for o in random.sample(range(-500, 2000), 60)]
    frame = spark.createDataFrame(rows, "k int, o long, v string")
    got = with_neighbours(frame, ["k"], "o", 50, previous={"p": "v", "po": "o"}, following={"n": "v", "no": "o"})
    found = {(r.k, r.o): (r.p, r.po, r.n, r.no) for r in got.collect()}
    assert len(found) == len(rows)
    for k in range(4):
        mine = sorted(((o, v) for kk, o, v in rows if kk == k))
        for i, (o, _) in enumerate(mine):
            before = mine[i - 1] if i else (None, None)
            after = mine[i + 1] if i + 1 < len(mine) else (None, None)
            assert found[(k, o)] == (before[1], before[0], after[1], after[0])


def test_history_equals_rebuild_in_any_order(spark):
    random.seed(5)
    rows = [(k, t, random.choice("ab")) for k in range(3) for t in random.sample(range(100), 20)]
    schema = "id long, updated_at long, name string"
    whole = history.build_history(spark.createDataFrame(rows, schema), width=10)
    random.shuffle(rows)
    half = history.build_history(spark.createDataFrame(rows[:30], schema))
    applied = history.apply_history(half, spark.createDataFrame(rows[25:], schema), width=7)
    key = lambda r: (r.id, r.updated_at)
    one, two = sorted(whole.collect(), key=key), sorted(applied.select(*whole.columns).collect(), key=key)
    assert one == two
    current = [r for r in one if r._is_current]
    assert len(current) == 3 and all(r._valid_to is None for r in current)
    changes = history.changes_only(spark.createDataFrame(rows, schema), "id", "updated_at", "name", 10)
    kept = sorted(map(tuple, changes.collect()))
    expected = []
    for k in range(3):
        last = None
        for kk, t, n in sorted(rows):
            if kk == k and n != last:
                expected.append((k, t, n))
                last = n
    assert kept == sorted(expected)
    state = {r.id: r.name for r in history.as_of(whole, 50).collect()}
    for k, name in state.items():
        assert name == max((t, n) for kk, t, n in rows if kk == k and t <= 50)[1]


def test_upserts(spark):
    target = spark.createDataFrame([(1, "a", 5), (2, "b", 5)], "id long, v string, t long")
    staging = spark.createDataFrame([(2, "B", 4), (3, "C", 1)], "id long, v string, t long")
    assert sorted(map(tuple, merge.upsert(target, staging, ["id"]).collect())) == [(1, "a", 5), (2, "B", 4), (3, "C", 1)]
    newer = merge.upsert(target, staging, ["id"], "t")
    assert sorted(map(tuple, newer.collect())) == [(1, "a", 5), (2, "b", 5), (3, "C", 1)]
    assert [r.id for r in merge.insert_absent(target, staging, ["id"]).collect()] == [3]
    patched = merge.patch_columns(target, staging, ["id"], ["v"], {"t": F.lit(0)})
    assert sorted(map(tuple, patched.collect())) == [(1, "a", 5), (2, "B", 5), (3, "C", 0)]
    moved = merge.update_where(target, F.col("v") == "a", {"t": F.lit(9)})
    assert sorted(map(tuple, moved.collect())) == [(1, "a", 9), (2, "b", 5)]


def test_quality(spark):
    frame = spark.createDataFrame([(10, "Valid Game"), (None, "Corrupted Record")], "id long, name string")
    assert tuple(quality.null_keys(frame).first()) == (2, 1)
    assert quality.null_keys(frame, "nope").first().null_keys == 2
    assert quality.null_keys(frame.where("false")).first().null_keys == 0
    assert {r.field: r.nulls for r in quality.required_nulls(frame, ["id", "name"]).collect()} == {"id": 1, "name": 0}
    child = spark.createDataFrame([(10,), (11,), (11,), (None,)], "k long")
    assert [tuple(r) for r in quality.orphans(child, "k", frame, "id").collect()] == [(11, 2)]
    versions = spark.createDataFrame(
        [(1, 1, True), (1, 2, True), (2, 1, True), (3, 1, False), (4, 1, True), (4, 1, False)],
        "id long, _valid_from long, _is_current boolean",
    )
    bad = {r.id: (r.current_rows, r.repeated_starts) for r in quality.history_violations(versions).collect()}
    assert bad == {1: (2, 0), 3: (0, 0), 4: (1, 1)}


def test_rank_equals_sorted_position(spark):
    random.seed(1)
    pairs = list({(random.choice([5, 6, 86400 * 3, 86400 * 3 + 1, -7]), random.randrange(400_000)) for _ in range(2000)})
    ranked = paging.ordered_rank(spark.createDataFrame(pairs, "v long, k long"), "v", "k")
    assert {(r.v, r.k): r["rank"] for r in ranked.collect()} == {p: i for i, p in enumerate(sorted(pairs))}


def test_extract(spark):
    frame = spark.range(1200).select("id", F.lit("c").alias("name"), (F.col("id") + 100).alias("updated_at"))
    source = align(frame, s.COMPANY.schema)
    page = paging.extract(source, s.COMPANY, since=300, limit=900)
    assert page.columns == s.COMPANY.fields
    assert [r.updated_at for r in page.collect()] == list(range(300, 1200))
    again = paging.extract(source, s.COMPANY, filters=F.col("id") > 5, sort=("id", "desc"), limit=2, offset=1)
    assert [r.id for r in again.collect()] == [1198, 1197]
    genres = align(frame, s.GENRE.schema)
    assert paging.extract(genres, s.GENRE, since=10**9).count() == 500
    behind = paging.keyset_page(source, s.COMPANY, 300, 200, 3)
    assert [r.id for r in behind.collect()] == [201, 202, 203]


@pytest.mark.parametrize("size", [300, 500])
def test_page_names_roll_over(spark, size):
    from dataclasses import replace

    spec = replace(s.COMPANY, page_size=size)
    frame = spark.range(25_000).select("id", (F.lit(10) + F.floor(F.col("id") / 100)).cast("long").alias("updated_at"))
    pages = paging.page_bounds(paging.assign_pages(frame, spec), spec, 10).orderBy("page_no").collect()
    per_group = 10_000 // size
    assert sum(p.records for p in pages) == 25_000
    for p in pages:
        group, inside = divmod(p.page_no, per_group)
        assert p.offset == inside * size
        assert p.cursor == (10 if group == 0 else 10 + (group * per_group * size - 1) // 100)
        assert p.cursor <= p.first_version
