"""Market analytics over the current rows of the game table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.columns import date_guard, epoch_year, guarded_year, round1
from tidemark.operators.relations import attach_names, tag_counts

PAGE_COLUMNS = ("id", "name", "slug", "rating", "rating_count", "hypes")


def current(games: DataFrame) -> DataFrame:
    return games.where("_is_current")


def release_timeline(games: DataFrame) -> DataFrame:
    """Current games per release year, dates outside the guard left out."""
    return _per_year(games).orderBy("year")


def _per_year(games: DataFrame) -> DataFrame:
    date = F.col("first_release_date")
    return (
        current(games)
        .where(date_guard(date))
        .groupBy(epoch_year(date).alias("year"))
        .agg(F.count(F.lit(1)).alias("games_count"))
    )


def peak_year(games: DataFrame) -> DataFrame:
    """The year with most releases; the earlier one if two are equal."""
    return (
        _per_year(games)
        .orderBy(F.col("games_count").desc(), F.col("year").asc())
        .limit(1)
        .select("year", "games_count")
    )


def market_kpis(games: DataFrame, genres: DataFrame, platforms: DataFrame) -> DataFrame:
    """One row of headline figures.

    The game table is read once: figures are first summed per release year, then
    over the years, where the peak year falls out as well.
    """
    per_year = (
        current(games)
        .groupBy(guarded_year(F.col("first_release_date")).alias("year"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count("rating").alias("rated"),
            F.sum("rating").alias("rating_sum"),
            F.count("aggregated_rating").alias("criticised"),
            F.sum("aggregated_rating").alias("critic_sum"),
        )
    )
    dated = F.when(F.col("year").isNotNull(), F.struct("n", -F.col("year")))
    game_part = per_year.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_games"),
        F.coalesce(F.sum("rated"), F.lit(0)).alias("rated_games"),
        round1(F.sum("rating_sum") / F.nullif(F.sum("rated"), F.lit(0))).alias("avg_user_rating"),
        round1(F.sum("critic_sum") / F.nullif(F.sum("criticised"), F.lit(0))).alias("avg_critic_rating"),
        F.max_by("year", dated).alias("top_release_year"),
    )
    parts = game_part.unionByName(
        genres.agg(F.count(F.lit(1)).alias("total_genres")), allowMissingColumns=True
    ).unionByName(platforms.agg(F.count(F.lit(1)).alias("total_platforms")), allowMissingColumns=True)
    wanted = (
        "total_games rated_games avg_user_rating avg_critic_rating "
        "total_genres total_platforms top_release_year"
    ).split()
    return parts.agg(*[F.max(c).alias(c) for c in wanted])


def tag_distribution(
    games: DataFrame, list_field: str, tags: DataFrame, label: str, limit: int = 10
) -> DataFrame:
    """Tags by the number of current games that carry them.

    Games are counted per tag id before the join, so the join sees one row per id.
    """
    counted = tag_counts(current(games), list_field, "id", "game_count")
    return (
        counted.join(tags.select("id", F.col("name").alias(label)), "id")
        .orderBy(F.col("game_count").desc(), F.col("id").asc())
        .limit(limit)
        .select(label, "game_count")
    )


def genre_distribution(games: DataFrame, genres: DataFrame, limit: int = 10) -> DataFrame:
    return tag_distribution(games, "genres", genres, "genre_name", limit)


def platform_distribution(games: DataFrame, platforms: DataFrame, limit: int = 10) -> DataFrame:
    return tag_distribution(games, "platforms", platforms, "platform_name", limit)


def top_rated(games: DataFrame, limit: int = 10, min_ratings: int = 30) -> DataFrame:
    """Best rated games with enough ratings. The release year is not guarded here."""
    return (
        current(games)
        .where(F.col("rating").isNotNull() & (F.col("rating_count") >= min_ratings))
        .orderBy(F.col("rating").desc(), F.col("rating_count").desc(), F.col("id").asc())
        .limit(limit)
        .select(
            "id",
            "name",
            "slug",
            round1(F.col("rating")).alias("rating"),
            "rating_count",
            round1(F.col("total_rating")).alias("total_rating"),
            "total_rating_count",
            "hypes",
            epoch_year(F.col("first_release_date")).alias("release_year"),
            "genres",
            "platforms",
        )
    )


def explorer_filter(games: DataFrame, search: str | None, genre_id: int | None) -> DataFrame:
    """Current games by name part (``%`` and ``_`` are wildcards) and genre."""
    found = current(games)
    if search and search.strip():
        found = found.where(F.col("name").ilike(f"%{search.strip()}%"))
    if genre_id is not None:
        found = found.where(F.array_contains("genres", F.lit(genre_id).cast("long")))
    return found


# Sort keys of the explorer: column and whether it descends. Nulls come last either way.
EXPLORER_KEYS = {
    "recent": (("first_release_date", True),),
    "hypes": (("hypes", True),),
    "name": (("name", False),),
    "rating": (("rating", True), ("rating_count", True)),
}


def explorer_keys(sort_by: str) -> tuple[tuple[str, bool], ...]:
    """Keys of a sort order; anything unknown sorts by rating. Ties go by id."""
    return (*EXPLORER_KEYS.get(sort_by, EXPLORER_KEYS["rating"]), ("id", False))


def explorer_order(sort_by: str) -> list[Column]:
    return [
        F.col(c).desc_nulls_last() if down else F.col(c).asc_nulls_last() for c, down in explorer_keys(sort_by)
    ]


def behind(keys: tuple[tuple[str, bool], ...], last: Mapping[str, object]) -> Column:
    """Rows that follow ``last`` in the order of ``keys``, nulls last: equal in some first keys,
    behind in the next one."""
    found, equal = F.lit(False), F.lit(True)
    for name, down in keys:
        value = last[name]
        if value is not None:
            beyond = F.col(name) < F.lit(value) if down else F.col(name) > F.lit(value)
            found = found | (equal & (beyond | F.col(name).isNull()))
        equal = equal & F.col(name).eqNullSafe(F.lit(value))
    return found


def explorer_page(
    games: DataFrame,
    genres: DataFrame,
    platforms: DataFrame,
    search: str | None = None,
    genre_id: int | None = None,
    sort_by: str = "rating",
    limit: int = 25,
    offset: int = 0,
    after: Mapping[str, object] | None = None,
) -> DataFrame:
    """One page of games with resolved genre and platform names.

    ``after`` holds the sort keys of the last row seen: the page then follows that row, which costs
    the same for every page, whereas an offset sorts and drops all rows before it. Names are resolved
    behind the limit, for the rows of the page only.
    """
    keep = [*PAGE_COLUMNS, "first_release_date", "genres", "platforms"]
    found = explorer_filter(games, search, genre_id)
    found = found if after is None else found.where(behind(explorer_keys(sort_by), after))
    page = found.select(*keep).orderBy(*explorer_order(sort_by))
    page = (page.offset(offset) if offset else page).limit(limit)
    lookups = {"genre_names": ("genres", genres), "platform_names": ("platforms", platforms)}
    named = attach_names(page, "id", lookups).orderBy(*explorer_order(sort_by))
    return named.select(
        *[round1(F.col(c)).alias(c) if c == "rating" else F.col(c) for c in PAGE_COLUMNS],
        guarded_year(F.col("first_release_date")).alias("release_year"),
        "genres",
        "platforms",
        "genre_names",
        "platform_names",
    )


def explorer_total(
    games: DataFrame, search: str | None = None, genre_id: int | None = None
) -> DataFrame:
    """Number of games under the filter of the explorer page."""
    return explorer_filter(games, search, genre_id).agg(F.count(F.lit(1)).alias("total"))
