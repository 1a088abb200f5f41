"""Market analytics and array relations."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.columns import date_guard, guarded_year
from tidemark.operators.history import build_history, one_per_instant
from tidemark.operators.relations import attach_names, junction_pairs
from tidemark.plans import market
from workload import standins as d
from workload.registry import query

GUARD = "first_release_date IS NOT NULL AND first_release_date >= 315532800 AND first_release_date < 1924991999"
YEAR = "CAST(year(TIMESTAMP '1970-01-01 00:00:00' + to_seconds(first_release_date)) AS BIGINT)"


def joined_lists(frame: DataFrame, *names: str) -> DataFrame:
    """Lists as text, so that both engines compare the same values."""
    return frame.withColumns({n: F.array_join(F.col(n).cast("array<string>"), "|", "-") for n in names})


@query(
    "market_kpis", "games", "genres", "platforms",
    sql=f"""SELECT (SELECT count(*) FROM games WHERE _is_current) AS total_games,
        (SELECT count(rating) FROM games WHERE _is_current) AS rated_games,
        (SELECT round(avg(rating), 1) FROM games WHERE _is_current) AS avg_user_rating,
        (SELECT round(avg(aggregated_rating), 1) FROM games WHERE _is_current) AS avg_critic_rating,
        (SELECT count(*) FROM genres) AS total_genres, (SELECT count(*) FROM platforms) AS total_platforms,
        (SELECT {YEAR} AS y FROM games WHERE _is_current AND {GUARD}
            GROUP BY 1 ORDER BY count(*) DESC, y LIMIT 1) AS top_release_year""",
)
def market_kpis(spark, sf_dir):
    return market.market_kpis(
        d.games(spark, sf_dir), d.genres(spark, sf_dir), d.platforms(spark, sf_dir)
    )


@query(
    "peak_year", "games",
    sql=f"""SELECT {YEAR} AS year, count(*) AS games_count FROM games WHERE _is_current AND {GUARD}
        GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1""",
)
def peak_year(spark, sf_dir):
    return market.peak_year(d.games(spark, sf_dir))


@query(
    "release_timeline", "games",
    sql=f"""SELECT {YEAR} AS year, count(*) AS games_count FROM games WHERE _is_current AND {GUARD}
        GROUP BY 1 ORDER BY 1""",
)
def release_timeline(spark, sf_dir):
    return market.release_timeline(d.games(spark, sf_dir))


@query(
    "date_guard", "games",
    sql=f"""SELECT id, {GUARD} AS in_guard, CASE WHEN {GUARD} THEN {YEAR} END AS release_year FROM games""",
)
def date_guard_rows(spark, sf_dir):
    date_col = F.col("first_release_date")
    return d.games(spark, sf_dir).select(
        "id", date_guard(date_col).alias("in_guard"), guarded_year(date_col).alias("release_year")
    )


@query(
    "tag_distribution", "games", "genres",
    sql="""SELECT g.name AS genre_name, count(gm.id) AS game_count
        FROM genres g JOIN games gm ON list_contains(gm.genres, g.id) WHERE gm._is_current
        GROUP BY g.id, g.name ORDER BY game_count DESC, g.id LIMIT 10""",
)
def tag_distribution(spark, sf_dir):
    return market.genre_distribution(d.games(spark, sf_dir), d.genres(spark, sf_dir))


@query(
    "channel_distribution", "games", "platforms",
    sql="""SELECT p.name AS platform_name, count(*) AS game_count
        FROM platforms p JOIN (SELECT DISTINCT id, unnest(platforms) AS pid FROM games WHERE _is_current) gm
            ON p.id = gm.pid
        GROUP BY p.id, p.name ORDER BY game_count DESC, p.id LIMIT 10""",
)
def channel_distribution(spark, sf_dir):
    return market.platform_distribution(d.games(spark, sf_dir), d.platforms(spark, sf_dir))


TOP = "id, name, slug, round(rating, 1) AS rating, rating_count"
LISTS = """array_to_string(list_transform(genres, lambda x: coalesce(CAST(x AS VARCHAR), '-')), '|') AS genres,
        array_to_string(list_transform(platforms, lambda x: coalesce(CAST(x AS VARCHAR), '-')), '|') AS platforms"""


@query(
    "top_rated", "games",
    sql=f"""SELECT {TOP}, round(total_rating, 1) AS total_rating, total_rating_count, hypes,
        {YEAR} AS release_year, {LISTS}
        FROM games WHERE _is_current AND rating IS NOT NULL AND rating_count >= 30
        ORDER BY games.rating DESC, rating_count DESC, id LIMIT 10""",
)
def top_rated(spark, sf_dir):
    return joined_lists(market.top_rated(d.games(spark, sf_dir)), "genres", "platforms")


NAMES = """(SELECT coalesce(string_agg(g.name, '|' ORDER BY u.pos), '') FROM
        (SELECT unnest(p.genres) AS ref, generate_subscripts(p.genres, 1) AS pos) u
        JOIN genres g ON g.id = u.ref) AS genre_names,
    (SELECT coalesce(string_agg(t.name, '|' ORDER BY u.pos), '') FROM
        (SELECT unnest(p.platforms) AS ref, generate_subscripts(p.platforms, 1) AS pos) u
        JOIN platforms t ON t.id = u.ref) AS platform_names"""


def explorer_sql(where: str, order: str, limit: int, offset: int) -> str:
    return f"""SELECT {TOP}, hypes, CASE WHEN {GUARD} THEN {YEAR} END AS release_year, {LISTS}, {NAMES}
        FROM (SELECT * FROM games WHERE _is_current AND {where}
            ORDER BY {order}, id LIMIT {limit} OFFSET {offset}) p"""


def explorer(spark, sf_dir, **options) -> DataFrame:
    page = market.explorer_page(
        d.games(spark, sf_dir), d.genres(spark, sf_dir), d.platforms(spark, sf_dir), **options
    )
    return joined_lists(page, "genres", "platforms", "genre_names", "platform_names")


@query(
    "explorer_page", "games", "genres", "platforms",
    sql=explorer_sql(
        "name ILIKE '%specified%'", "rating DESC NULLS LAST, rating_count DESC NULLS LAST", 25, 50
    ),
)
def explorer_page(spark, sf_dir):
    return explorer(spark, sf_dir, search=" specified ", offset=50)


@query(
    "explorer_after", "games", "genres", "platforms",
    sql=explorer_sql("TRUE", "rating DESC NULLS LAST, rating_count DESC NULLS LAST", 25, 150),
)
def explorer_after(spark, sf_dir):
    """The page behind the 150th row, found by the sort keys of that row."""
    games = d.games(spark, sf_dir)
    last = market.current(games).orderBy(*market.explorer_order("rating")).offset(149).first()
    return explorer(spark, sf_dir, after=last.asDict())


@query(
    "explorer_by_tag", "games", "genres", "platforms",
    sql=explorer_sql("list_contains(genres, 7)", "hypes DESC NULLS LAST", 25, 0),
)
def explorer_by_tag(spark, sf_dir):
    return explorer(spark, sf_dir, genre_id=7, sort_by="hypes")


@query(
    "explorer_recent", "games", "genres", "platforms",
    sql=explorer_sql("TRUE", "first_release_date DESC NULLS LAST", 25, 0),
)
def explorer_recent(spark, sf_dir):
    return explorer(spark, sf_dir, sort_by="recent")


@query(
    "explorer_by_name", "games", "genres", "platforms",
    sql=explorer_sql("name ILIKE '%1_9%'", "name ASC NULLS LAST", 25, 0),
)
def explorer_by_name(spark, sf_dir):
    return explorer(spark, sf_dir, search="1_9", sort_by="name")


@query(
    "explorer_total", "games",
    sql="SELECT count(*) AS total FROM games WHERE _is_current AND name ILIKE '%urgent%'",
)
def explorer_total(spark, sf_dir):
    return market.explorer_total(d.games(spark, sf_dir), search="urgent")


@query(
    "resolve_names", "games", "genres", "platforms",
    sql="""WITH g AS (SELECT u.id, string_agg(t.name, '|' ORDER BY u.pos) AS names FROM
            (SELECT id, unnest(genres) AS ref, generate_subscripts(genres, 1) AS pos FROM games) u
            JOIN genres t ON t.id = u.ref GROUP BY 1),
        p AS (SELECT u.id, string_agg(t.name, '|' ORDER BY u.pos) AS names FROM
            (SELECT id, unnest(platforms) AS ref, generate_subscripts(platforms, 1) AS pos FROM games) u
            JOIN platforms t ON t.id = u.ref GROUP BY 1)
        SELECT games.id, coalesce(g.names, '') AS genre_names, coalesce(p.names, '') AS platform_names
        FROM games LEFT JOIN g ON g.id = games.id LEFT JOIN p ON p.id = games.id""",
)
def resolve_names(spark, sf_dir):
    rows = d.games(spark, sf_dir).select("id", "genres", "platforms")
    lookups = {
        "genre_names": ("genres", d.genres(spark, sf_dir)),
        "platform_names": ("platforms", d.platforms(spark, sf_dir)),
    }
    named = attach_names(rows, "id", lookups).select("id", *lookups)
    return joined_lists(named, *lookups)


@query(
    "junction_pairs", "games",
    sql="""SELECT DISTINCT id AS game_id, genre_id FROM
        (SELECT id, unnest(genres) AS genre_id FROM games) WHERE genre_id IS NOT NULL""",
)
def genre_pairs(spark, sf_dir):
    return junction_pairs(d.games(spark, sf_dir), "id", "genres", "game_id", "genre_id")


@query(
    "junction_history", "users",
    sql="""WITH one AS (SELECT id, updated_at, arg_max(marks, event_id) AS marks FROM users GROUP BY 1, 2),
        h AS (SELECT *, lead(updated_at) OVER (PARTITION BY id ORDER BY updated_at) AS valid_to FROM one)
        SELECT DISTINCT id AS user_id, unnest(marks) AS mark_id, updated_at AS valid_from, valid_to FROM h""",
)
def junction_history(spark, sf_dir):
    versions = one_per_instant(
        d.users(spark, sf_dir).select("id", "updated_at", "event_id", "marks"), "id", "updated_at", ["event_id"]
    )
    history = build_history(versions)
    pairs = junction_pairs(history, "id", "marks", "user_id", "mark_id", "_valid_from", "_valid_to")
    return pairs.select(
        "user_id",
        "mark_id",
        F.unix_seconds("_valid_from").alias("valid_from"),
        F.unix_seconds("_valid_to").alias("valid_to"),
    )
