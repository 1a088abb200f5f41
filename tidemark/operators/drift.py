"""Schema drift of landed records: profile, signature, diff and events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.dedup import latest_per_key
from tidemark.operators.neighbours import with_neighbours
from tidemark.spec import EntitySpec

# Batches per window group when the previous batch of a table is looked up.
SLICE_BATCHES = 100_000
# Batch ids start at 0.
BEFORE_FIRST = -1


def observed_type(value: Column) -> Column:
    """Type of a JSON value under Spark's names; every decimal and float is a double."""
    seen = F.lower(F.schema_of_variant(value))
    numbers = F.regexp_replace(seen, r"decimal\(\d+,\d+\)|float", "double")
    return F.when(numbers.startswith("object"), F.lit("object")).otherwise(numbers)


def profile_records(frame: DataFrame, record: str, *by: str) -> DataFrame:
    """Fields and observed types of JSON records with their row counts, per ``by``.

    Null values tell no type and are left out, and so are malformed records.
    """
    return _profile(frame.select(*by, F.try_parse_json(record).alias("_record")), *by)


def profile_pages(frame: DataFrame, text: str, *by: str) -> DataFrame:
    """As :func:`profile_records` for text that is one record or a JSON array of records."""
    line = F.trim(F.col(text))
    listed = F.when(line.startswith("["), line).otherwise(F.concat(F.lit("["), line, F.lit("]")))
    parsed = frame.select(*by, F.try_parse_json(listed).alias("_page"))
    explode = frame.sparkSession.tvf.variant_explode
    return _profile(
        parsed.lateralJoin(explode(F.col("_page").outer())).select(*by, F.col("value").alias("_record")), *by
    )


def _profile(records: DataFrame, *by: str) -> DataFrame:
    explode = records.sparkSession.tvf.variant_explode
    fields = records.lateralJoin(explode(F.col("_record").outer())).select(
        *by, F.col("key").alias("field"), observed_type(F.col("value")).alias("type")
    )
    return (
        fields.where(F.col("type") != "void")
        .groupBy(*by, "field", "type")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def snapshots(profile: DataFrame, *by: str) -> DataFrame:
    """One row per batch: map of field to type, and the signature of that map.

    The signature does not depend on the order of the fields. A field seen with
    several types lists them all.
    """
    per_field = profile.groupBy(*by, "field").agg(
        F.array_join(F.array_sort(F.collect_set("type")), "|").alias("type")
    )
    pairs = F.array_sort(F.collect_list(F.struct("field", "type")))
    packed = per_field.groupBy(*by).agg(pairs.alias("_pairs"))
    return packed.select(
        *by,
        F.map_from_entries("_pairs").alias("columns_snapshot"),
        signature(F.col("_pairs")).alias("schema_hash"),
    )


def signature(pairs: Column) -> Column:
    listed = F.transform(pairs, lambda p: F.concat(p["field"], F.lit(":"), p["type"]))
    return F.sha2(F.array_join(F.array_sort(listed), ","), 256)


def declared_profile(frame: DataFrame, spec: EntitySpec) -> DataFrame:
    """The declared schema as a profile, next to observed ones (one row per field)."""
    pairs = [F.struct(F.lit(f.name).alias("field"), F.lit(f.dataType.simpleString()).alias("type")) for f in spec.schema]
    return frame.select("*", F.inline(F.array(*pairs)))


def diff_columns(old: Column, new: Column) -> Column:
    """Added, removed and retyped fields between two field-to-type maps; a null ``old`` is empty."""
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    old, new = F.coalesce(old, empty), F.coalesce(new, empty)
    both = F.map_zip_with(old, new, lambda k, a, b: F.struct(a.alias("old"), b.alias("new")))
    retyped = F.map_filter(
        both, lambda k, t: t["old"].isNotNull() & t["new"].isNotNull() & (t["old"] != t["new"])
    )
    return F.struct(
        F.array_sort(F.array_except(F.map_keys(new), F.map_keys(old))).alias("added"),
        F.array_sort(F.array_except(F.map_keys(old), F.map_keys(new))).alias("removed"),
        retyped.alias("type_changed"),
    )


def schema_diff(old: DataFrame, new: DataFrame, *by: str) -> DataFrame:
    """Field-wise difference of two (by, field, type) frames, one row per changed field."""
    joined = old.withColumnRenamed("type", "old_type").join(
        new.withColumnRenamed("type", "new_type"), [*by, "field"], "full"
    )
    change = (
        F.when(F.col("old_type").isNull(), "added")
        .when(F.col("new_type").isNull(), "removed")
        .when(F.col("old_type") != F.col("new_type"), "type_changed")
    )
    return joined.withColumn("change", change).where(F.col("change").isNotNull())


def latest_snapshot(history: DataFrame) -> DataFrame:
    """The last logged hash and snapshot of every table."""
    return latest_per_key(
        history.select("table_name", "schema_hash", "columns_snapshot", "detected_at", "id"),
        ["table_name"],
        ["detected_at", "id"],
    )


def drift_events(batches: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """Batches whose signature differs from the batch before, with the difference.

    ``batches`` has (table_name, batch_id, columns_snapshot, schema_hash). The
    first batch of a table is compared with the last logged snapshot, if any.
    """
    seen = batches.select("table_name", "batch_id", "schema_hash", "columns_snapshot")
    if history is not None:
        # The logged snapshot takes part as the batch before the first one.
        logged = latest_snapshot(history).withColumn("batch_id", F.lit(BEFORE_FIRST).cast("long"))
        seen = seen.unionByName(logged.select(*seen.columns))
    linked = with_neighbours(
        seen,
        ["table_name"],
        "batch_id",
        SLICE_BATCHES,
        previous={"_old_hash": "schema_hash", "_old": "columns_snapshot"},
    ).where(F.col("batch_id") != BEFORE_FIRST)
    return linked.where(~F.col("schema_hash").eqNullSafe(F.col("_old_hash"))).select(
        "table_name",
        "batch_id",
        "schema_hash",
        F.col("_old_hash").alias("previous_hash"),
        "columns_snapshot",
        diff_columns(F.col("_old"), F.col("columns_snapshot")).alias("changed_columns"),
    )
