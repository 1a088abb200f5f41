"""Source extracts, global order and pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.session import scratch
from tidemark.spec import OFFSET_ROLLOVER, EntitySpec


def extract(
    frame: DataFrame,
    spec: EntitySpec,
    since: int = 0,
    filters: Column | None = None,
    sort: tuple[str, str] | None = None,
    limit: int | None = None,
    offset: int = 0,
) -> DataFrame:
    """One page of a source: declared fields of the records at or past ``since``.

    A full-load entity ignores ``since``, and so does 0. Without a sort the order
    is the version column ascending; equal values follow the key. Without a limit
    the page size of the entity holds.
    """
    picked = frame
    if since and not spec.full_load:
        picked = picked.where(F.col(spec.version) >= F.lit(since))
    if filters is not None:
        picked = picked.where(filters)
    name, direction = sort or (spec.version, "asc")
    first = F.col(name).desc_nulls_last() if direction == "desc" else F.col(name).asc_nulls_last()
    picked = picked.select(
        *[F.col(spec.source_names.get(f, f)).alias(f) for f in spec.fields]
    ).orderBy(first, F.col(spec.key).asc())
    if offset:
        picked = picked.offset(offset)
    return picked.limit(spec.page_size if limit is None else limit)


def keyset_page(frame: DataFrame, spec: EntitySpec, cursor: int, last_id: int, limit: int) -> DataFrame:
    """The next rows behind (cursor, last_id): constant cost, however deep the page is."""
    version, key = F.col(spec.version), F.col(spec.key)
    behind = (version > cursor) | ((version == cursor) & (key > last_id))
    return frame.where((version >= cursor) & behind).orderBy(version, key).limit(limit)


def numbered(
    frame: DataFrame, order: list[Column], name: str = "rank", evaluated: bool = False
) -> DataFrame:
    """Position of every row in ``order``, from 0, by one range shuffle.

    Rows are dealt by ranges of the order columns and sorted within each range. The dealt rows are
    written to the shared folder, since a range shuffle that is planned twice may draw other bounds;
    the row counts of the ranges, one number each, give the first position of every range. A hot
    value of the first column is split by the columns behind it. Drawing the bounds reads the rows
    once more, so they are written first, unless they are ``evaluated`` (read from files) already:
    the plan behind ``frame`` runs once.
    """
    spark = frame.sparkSession

    def written(rows: DataFrame, label: str) -> DataFrame:
        path = scratch(spark, label)
        rows.write.parquet(path)
        return spark.read.schema(rows.schema).parquet(path)

    rows = frame if evaluated else written(frame, "unnumbered")
    ranges = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # The upper bits of the id hold the range, the lower 33 the place within.
    dealt = (
        rows.repartitionByRange(ranges, *order)
        .sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id())
    )
    dealt = written(dealt, "numbered")
    part, place = F.shiftright("_at", 33).cast("int"), F.col("_at").bitwiseAND((1 << 33) - 1)
    # One number per range, as many as there are shuffle partitions, whatever the number of rows.
    counts = {r["part"]: r["n"] for r in dealt.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()}
    starts, before = [], 0
    for at in range(ranges):
        starts.append(before)
        before += counts.get(at, 0)
    first = F.get(F.lit(starts).cast("array<long>"), part)
    return dealt.select(*frame.columns, (first + place).cast("long").alias(name))


def ordered_rank(frame: DataFrame, version: str, key: str, name: str = "rank") -> DataFrame:
    """Position of every row in (version, key) order, from 0. Pairs of version and key are unique."""
    return numbered(frame, [F.col(version).asc_nulls_last(), F.col(key).asc_nulls_last()], name)


def assign_pages(frame: DataFrame, spec: EntitySpec) -> DataFrame:
    """Add ``_rank`` and ``page_no``: rows in (version, key) order, ``page_size`` to a page."""
    ranked = ordered_rank(frame, spec.version, spec.key, "_rank")
    return ranked.withColumn("page_no", F.floor(F.col("_rank") / spec.page_size).cast("long"))


def page_stats(frame: DataFrame, version: str, key: str, *by: str) -> DataFrame:
    """Per page: records, first and last version, and the greatest key at the last version."""
    newest = F.max(F.struct(F.col(version).alias("v"), F.col(key).alias("k")))
    return (
        frame.groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("records"),
            F.min(version).alias("first_version"),
            newest.alias("_newest"),
        )
        .withColumns({"last_version": F.col("_newest.v"), "last_id": F.col("_newest.k")})
        .drop("_newest")
    )


def page_bounds(paged: DataFrame, spec: EntitySpec, since: int) -> DataFrame:
    """Page table with the (cursor, offset) pair that names each page, from rows of ``assign_pages``.

    The offset grows by a page until the rollover; then the cursor moves to the
    last version seen and the offset starts again. While more rows share one
    version than fit before the rollover the cursor cannot move, so the offset
    goes on growing: no two pages share a name.
    """
    per_group = max(1, OFFSET_ROLLOVER // spec.page_size)
    rows = per_group * spec.page_size
    pages = page_stats(paged, spec.version, spec.key, "page_no").withColumn(
        "_group", F.floor(F.col("page_no") / per_group).cast("long")
    )
    # The rows before each rollover name the cursor of the next group: one row in thousands.
    turns = paged.where((F.col("_rank") + 1) % rows == 0).select(
        F.floor((F.col("_rank") + 1) / rows).cast("long").alias("_group"),
        F.col(spec.version).cast("long").alias("cursor"),
    )
    start = paged.sparkSession.range(1).select("id", F.lit(since).cast("long").alias("cursor"))
    cursors = turns.union(start).withColumn("_base", F.min("_group").over(Window.partitionBy("cursor")))
    return pages.join(cursors, "_group").select(
        "page_no",
        "cursor",
        ((F.col("page_no") - F.col("_base") * per_group) * spec.page_size).cast("long").alias("offset"),
        "records",
        "first_version",
        "last_version",
        "last_id",
    )
