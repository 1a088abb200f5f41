"""Array relations: junction pairs and id-to-name lookups."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.spec import EntitySpec

def junction_pairs(
    frame: DataFrame, key: str, list_field: str, left: str, right: str, *carry: str
) -> DataFrame:
    """Distinct (key, element) pairs without null elements."""
    return (
        frame.select(F.col(key).alias(left), F.explode(list_field).alias(right), *carry)
        .where(F.col(right).isNotNull())
        .distinct()
    )


def junctions(frame: DataFrame, spec: EntitySpec) -> dict[str, DataFrame]:
    """Junction frames by table name; none where history is kept or no list is declared."""
    if spec.keep_history or spec.key not in frame.columns:
        return {}
    return {
        spec.junction_table(f).name: junction_pairs(
            frame, spec.key, f, *spec.junction_columns(f)
        )
        for f in spec.list_fields
        if f in frame.columns
    }


def tag_counts(frame: DataFrame, list_field: str, tag: str = "tag_id", n: str = "n") -> DataFrame:
    """Rows per array element; a row counts once per element even if it repeats."""
    return (
        frame.select(F.explode(F.array_distinct(list_field)).alias(tag))
        .groupBy(tag)
        .agg(F.count(F.lit(1)).alias(n))
    )


def attach_names(
    frame: DataFrame, key: str, lookups: dict[str, tuple[str, DataFrame]]
) -> DataFrame:
    """Add name lists for id lists, in list order; unknown ids are skipped.

    ``lookups`` maps the new column to (id list column, frame of id and name). Only the key and the
    id lists are exploded and looked up; the names come back by the same columns, so rows with a
    repeated key stay apart and no other column of a row is multiplied.
    """
    lists = list(dict.fromkeys(ids for ids, _ in lookups.values()))

    def tagged(label: str, ids: str) -> Column:
        entry = lambda x, i: F.struct(F.lit(label).alias("list"), i.alias("pos"), x.alias("ref"))
        return F.transform(F.coalesce(F.col(ids).cast("array<long>"), F.array().cast("array<long>")), entry)

    entries = F.concat(*[tagged(label, ids) for label, (ids, _) in lookups.items()])
    exploded = (
        frame.select(key, *lists)
        .distinct()
        .select(key, *lists, F.explode(entries).alias("_ref"))
        .select(key, *lists, "_ref.list", "_ref.pos", "_ref.ref")
    )
    names = reduce(
        DataFrame.unionByName,
        [
            dim.select(
                F.lit(label).alias("list"), F.col("id").cast("long").alias("ref"), F.col("name").alias("_name")
            )
            for label, (_, dim) in lookups.items()
        ],
    )
    found = lambda label: F.array_sort(
        F.collect_list(F.when(F.col("list") == label, F.struct(F.col("pos"), F.col("_name").alias("name"))))
    )
    named = (
        exploded.join(names.where(F.col("_name").isNotNull()), ["list", "ref"])
        .groupBy(key, *lists)
        .agg(*[found(label).getField("name").alias(f"_names_{label}") for label in lookups])
        .select(*[F.col(c).alias(f"_of_{c}") for c in (key, *lists)], *[f"_names_{label}" for label in lookups])
    )
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in (key, *lists)])
    none = F.array().cast("array<string>")
    return frame.join(named, same, "left").select(
        *[F.col(c) for c in frame.columns],
        *[F.coalesce(f"_names_{label}", none).alias(label) for label in lookups],
    )
