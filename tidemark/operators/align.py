"""Schema-on-read: bring any frame to a declared schema."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.functions.columns import as_items, fit, row_hash
from tidemark.spec import EntitySpec


def aligned_columns(frame: DataFrame, schema: T.StructType) -> list[Column]:
    have = {f.name: f.dataType for f in frame.schema}
    return [
        (
            fit(F.col(f.name), have[f.name], f.dataType)
            if f.name in have
            else F.lit(None).cast(f.dataType)
        ).alias(f.name)
        for f in schema
    ]


def align(frame: DataFrame, schema: T.StructType, *keep: str) -> DataFrame:
    """Declared fields in order: missing ones null, undeclared ones dropped, types cast.

    Columns named in ``keep`` pass through behind the declared ones.
    """
    return frame.select(*aligned_columns(frame, schema), *keep)


def misfits(frame: DataFrame, schema: T.StructType) -> Column:
    """Names of the fields whose value is present but does not fit the declared type."""
    have = {f.name: f.dataType for f in frame.schema}
    checks = []
    for f in schema:
        if f.name not in have or have[f.name] == f.dataType:
            continue
        value, cast = F.col(f.name), fit(F.col(f.name), have[f.name], f.dataType)
        bad = value.isNotNull() & cast.isNull()
        if isinstance(f.dataType, T.ArrayType):
            items, _ = as_items(value, have[f.name])
            bad = bad | (F.size(F.array_compact(items)) > F.size(F.array_compact(cast)))
        checks.append(F.when(F.coalesce(bad, F.lit(False)), F.lit(f.name)))
    return F.array_compact(F.array(*checks)) if checks else F.array().cast("array<string>")


def stamp(
    frame: DataFrame,
    schema: T.StructType,
    ingested_at: datetime | Column,
    hash_exclude: tuple[str, ...] = (),
) -> DataFrame:
    """Add the audit columns: one ingest time per frame and the row hash."""
    moment = ingested_at if isinstance(ingested_at, Column) else F.lit(ingested_at)
    return frame.withColumns(
        {"_ingested_at": moment.cast("timestamp"), "_hash": row_hash(schema, hash_exclude)}
    )


def main_projection(frame: DataFrame, spec: EntitySpec) -> DataFrame:
    """Columns of the main table: lists go to junction tables unless history is kept."""
    audit = [c for c in ("_ingested_at", "_hash") if c in frame.columns]
    return frame.select(*spec.main_fields, *audit)


def union_diagonal(frames: list[DataFrame], schema: T.StructType | None = None) -> DataFrame:
    """Union by name, absent columns null.

    With a schema every frame is aligned first, so a column that is a number in
    one frame and text in another still meets in the declared type.
    """
    if schema is not None:
        frames = [align(f, schema) for f in frames]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def valid_records(frame: DataFrame, *required: str) -> tuple[DataFrame, DataFrame]:
    """Split into records that carry all required fields and those that do not."""
    missing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in required])
    return frame.where(~missing), frame.where(missing)


def require_fields(frame: DataFrame, *required: str) -> DataFrame:
    """Fail the job that reads a record without one of the required fields; no extra pass."""
    kinds = {f.name: f.dataType for f in frame.schema}
    checked = {
        c: F.coalesce(F.col(c), F.raise_error(F.lit(f"a record lacks {c}")).cast(kinds[c]))
        for c in required
    }
    return frame.withColumns(checked)
