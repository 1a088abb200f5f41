"""Load of one table: align, hash, dedup, check, write main and junction tables."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, functions as F

from tidemark.operators.align import align, main_projection, misfits, stamp
from tidemark.operators.dedup import dedup_records
from tidemark.operators.history import one_per_instant
from tidemark.operators.relations import junctions
from tidemark.sources.store import TableStore
from tidemark.spec import TEXT, EntitySpec, TableSpec, T


class DataQualityError(ValueError):
    """A load was refused; nothing was written."""


@dataclass(frozen=True)
class Loaded:
    """What a load did: raw records read, rows written, greatest version seen."""

    read: int
    rows: int
    quarantined: int
    watermark: int | None


def arrival_columns(frame: DataFrame) -> list[str]:
    return [c for c in ("_cursor", "_offset", "_file") if c in frame.columns]


def prepare(raw: DataFrame, spec: EntitySpec, ingested_at: datetime | Column) -> DataFrame:
    """Aligned and stamped records, with ``_faults``: names of fields that make a record unfit."""
    needed = list(dict.fromkeys([spec.key, *spec.required, *([spec.version] if spec.keep_history else [])]))
    flagged = raw.withColumn("_misfits", misfits(raw, spec.schema))
    aligned = align(flagged, spec.schema, "_misfits", *arrival_columns(raw))
    absent = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in needed]))
    faults = F.array_distinct(F.concat("_misfits", absent))
    return stamp(aligned.withColumn("_faults", faults).drop("_misfits"), spec.schema, ingested_at)


def newest_records(prepared: DataFrame, spec: EntitySpec) -> DataFrame:
    """One row per key, or one per key and version where history is kept."""
    arrival = tuple(arrival_columns(prepared))
    if spec.keep_history:
        kept = one_per_instant(prepared, spec.key, spec.version, [*arrival, "_hash"])
    else:
        kept = dedup_records(prepared, spec.key, spec.version, arrival)
    return kept.drop("_faults", *arrival)


def quarantine_table(spec: EntitySpec) -> TableSpec:
    columns = [T.StructField("faults", T.ArrayType(TEXT)), T.StructField("record", TEXT)]
    return TableSpec(f"{spec.table_name}_quarantine", T.StructType(columns), ("record",))


def check_history_mode(store: TableStore, spec: EntitySpec) -> None:
    """Refuse to start a second table for an entity whose history mode was switched."""
    here = spec.main_table()
    other = spec.base_name if spec.keep_history else f"{spec.base_name}_scd2"
    if not store.exists(here) and store.exists(TableSpec(other, here.schema, here.keys)):
        raise RuntimeError(f"{other} exists, {here.name} does not: migrate the table, do not switch the mode")


def load_table(
    store: TableStore,
    spec: EntitySpec,
    raw: DataFrame,
    ingested_at: datetime,
    token: str | None = None,
    on_fault: str = "fail",
) -> Loaded:
    """Load raw records into the tables of an entity. Loading twice changes nothing.

    What is written is the newest row per staged key (or version), never a stored one: stored rows
    are neither read nor written again, and merging on read keeps an older version from undoing a
    newer row, so pages may come in any order; of equal versions the later write wins. Rows are
    written aside and counted by the same job; they are published only if no record is unfit, or
    ``on_fault`` is ``quarantine``. ``token`` names the load: one that was published is left alone,
    and the main table, published last, closes it.
    """
    main = spec.main_table()
    check_history_mode(store, spec)
    arrivals, written = Observation(), Observation()
    faulty = F.size("_faults") > 0
    prepared = prepare(raw, spec, ingested_at).observe(
        arrivals,
        F.count(F.lit(1)).alias("read"),
        F.count_if(faulty).alias("faulty"),
        F.max("_faults").alias("example"),
    )
    lists = () if spec.keep_history else spec.list_fields
    clean = newest_records(prepared.where(~faulty), spec)
    if lists:
        clean = clean.persist(StorageLevel.MEMORY_AND_DISK)
    counted = main_projection(clean, spec).observe(
        written, F.count(F.lit(1)).alias("rows"), F.max(spec.version).alias("mark")
    )
    staged = []
    try:
        kind = "all" if spec.full_load else "add"
        own = store.stage(main, counted, kind, token)
        if own is None:
            counted.write.format("noop").mode("overwrite").save()  # published before; only its figures are asked for
        else:
            staged.append(own)
        seen, done = arrivals.get, written.get
        if seen["faulty"] and on_fault != "quarantine":
            raise DataQualityError(
                f"{spec.name}: {seen['faulty']} of {seen['read']} records unfit, e.g. fields {seen['example']}"
            )
        if seen["faulty"]:
            bad = prepare(raw, spec, ingested_at).where(faulty)
            rejected = bad.select(
                F.col("_faults").alias("faults"), F.to_json(F.struct(*spec.fields)).alias("record")
            )
            store.write(quarantine_table(spec), rejected, "append", token)
        if done["rows"]:
            for list_field in lists:
                table = spec.junction_table(list_field)
                store.write(table, junctions(clean, spec)[table.name], "append", token)
            for part in staged:
                store.publish(part)
            staged = []
        return Loaded(seen["read"], done["rows"], seen["faulty"] or 0, done["mark"])
    finally:
        for part in staged:
            store.discard(part)
        if lists:
            clean.unpersist()
