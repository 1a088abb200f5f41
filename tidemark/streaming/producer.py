"""Source deltas into landed pages, and the full cycle over all entities."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping
from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from tidemark import spec as s
from tidemark.operators.align import require_fields
from tidemark.plans import control
from tidemark.plans.ledger import Ledger
from tidemark.sources.pages import PAGE_NAME, land_pages
from tidemark.sources.store import TableStore
from tidemark.streaming.consumer import drain, replay_pending, utc_now


def delta(source: DataFrame, spec: s.EntitySpec, since: int, until: int | None = None) -> DataFrame:
    """Source records at or past a cursor, up to an end where given; declared fields only."""
    version = F.col(spec.version)
    # A record without a version is kept here, so that it is refused and not lost.
    unknown = version.isNull()
    picked = source if spec.full_load or not since else source.where((version >= since) | unknown)
    picked = picked if until is None else picked.where((version <= until) | unknown)
    return picked.select(*[f for f in spec.fields if f in source.columns])


def land(
    store: TableStore,
    spec: s.EntitySpec,
    source: DataFrame,
    root: str,
    run_id: str,
    at: datetime,
    since: int,
    until: int | None = None,
) -> tuple[int, int, int]:
    """Land one delta, log its pages and its schema; returns (records, last version, last id)."""
    begun = time.monotonic()
    picked = require_fields(delta(source, spec, since, until), spec.key, spec.version)
    pages = land_pages(picked, spec, root, at, 0 if spec.full_load else since)
    total = pages.agg(F.sum("records"), F.max(F.struct("last_version", "last_id"))).first()
    if not total[0]:
        return 0, since, 0
    elapsed = int((time.monotonic() - begun) * 1000)
    Ledger(store).log_pages(pages, spec, run_id, at, elapsed, f"{spec.version} >= {since}")
    return total[0], total[1][0], total[1][1]


def ingest(
    store: TableStore, spec: s.EntitySpec, source: DataFrame, root: str, run_id: str, at: datetime
) -> int:
    """Land what is new since the checkpoint; a waiting replay of the raw layer goes first."""
    ledger = Ledger(store)
    landed = 0
    waiting = control.pending_replays(ledger.read(s.FALLBACK_EVENTS), "RAW")
    for event in waiting.where(F.col("table_name") == spec.name).collect():
        ledger.move_replay(event.event_id, "IN_PROGRESS", at)
        try:
            done, _, _ = land(
                store, spec, source, root, run_id, at, event.start_watermark, event.end_watermark
            )
        except Exception as problem:
            ledger.move_replay(event.event_id, "FAILED", at, error=str(problem))
            raise
        ledger.move_replay(event.event_id, "COMPLETED", at, done)
        landed += done
    since = ledger.mark(spec.name, "RAW", spec.start)
    try:
        done, mark, last_id = land(store, spec, source, root, run_id, at, since)
    except Exception as problem:
        ledger.log_batch(
            run_id=run_id,
            table_name=spec.name,
            layer="RAW",
            status="FAILED",
            cursor_value=since,
            offset_value=0,
            records_count=0,
            duration_ms=0,
            error_message=str(problem),
            created_at=at,
        )
        raise
    ledger.checkpoint(spec.name, "RAW", max(since, mark), at, last_id=last_id, run_id=run_id)
    return landed + done


def log_landed_schema(
    store: TableStore, spec: s.EntitySpec, root: str, run_id: str, at: datetime
) -> int:
    """Compare the schema of the pages that a run landed with the last logged one."""
    day = f"{root}/{spec.path.strip('/')}/year={at:%Y}/month={at:%m}/day={at:%d}"
    ledger = Ledger(store)
    name = [F.regexp_extract("_metadata.file_path", PAGE_NAME, i).try_cast("long").alias(c) for i, c in ((1, "c"), (2, "o"))]
    lines = store.spark.read.option("recursiveFileLookup", "true").text(day).select("value", *name)
    own = control.landed(ledger.read(s.BATCH_LOGS), spec.name).where(F.col("run_id") == run_id)
    pages = own.select(F.col("cursor_value").alias("c"), F.col("offset_value").cast("long").alias("o"))
    return ledger.log_drift(lines.join(pages, ["c", "o"], "left_semi"), "value", spec, run_id, at)


def run_cycle(
    store: TableStore,
    sources: Mapping[str, DataFrame],
    specs: list[s.EntitySpec],
    root: str,
    checkpoints: str,
    clock: Callable[[], datetime] = utc_now,
) -> str:
    """One full cycle: land every entity, consume it, work off replays. Returns the run id.

    A failure closes the run as FAILED and is raised.
    """
    ledger = Ledger(store)
    ledger.recover_orphans(clock())
    run_id = ledger.start_run("RAW", clock())
    try:
        for spec in specs:
            at = clock()
            if ingest(store, spec, sources[spec.name], root, run_id, at):
                log_landed_schema(store, spec, root, run_id, at)
            drain(store, spec, root, f"{checkpoints}/{spec.base_name}")
        replay_pending(store, specs, root)
    except Exception as problem:
        ledger.finish_run(run_id, "FAILED", clock(), str(problem))
        raise
    ledger.finish_run(run_id, "COMPLETED", clock())
    return run_id
