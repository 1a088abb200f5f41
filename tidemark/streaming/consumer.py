"""Landed pages into tables: continuous, one-shot, snapshot and replay."""

from __future__ import annotations

import math
import time
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark import spec as s
from tidemark.plans import control
from tidemark.plans.ledger import Ledger
from tidemark.plans.load import Loaded, load_table
from tidemark.session import count_files
from tidemark.sources.pages import loose_schema, require_pages, list_days, scan_refs, with_arrival
from tidemark.sources.store import TableStore, stored_schema

# Pages per micro-batch when following, and when draining.
FOLLOW_PAGES = 10
DRAIN_PAGES = 50
FOLLOW_INTERVAL = "1 second"
# Fixed value: micro-batches that a backlog takes at most, however many pages it has.
BACKLOG_BATCHES = 12


def utc_now() -> datetime:
    return datetime.now(timezone.utc)


def page_stream(store: TableStore, spec: s.EntitySpec, root: str, pages: int, backlog: bool = False) -> DataFrame:
    """New pages of an entity as a stream of untyped records, ``pages`` to a micro-batch.

    With ``backlog`` a micro-batch takes more where the landed pages would need more than
    ``BACKLOG_BATCHES`` of them: each costs some seconds for its plan, state and log rows whatever it
    reads, so a fixed size would make many pages take a time that no number of executors shortens.
    """
    folder = f"{root}/{spec.path.strip('/')}"
    if backlog:
        pages = max(pages, math.ceil(count_files(store.spark, folder) / BACKLOG_BATCHES))
    stream = (
        store.spark.readStream.schema(loose_schema(spec))
        .option("maxFilesPerTrigger", pages)
        .option("recursiveFileLookup", "true")
        .json(folder)
    )
    return with_arrival(stream, spec)


def log_stream(store: TableStore, pages: int) -> DataFrame:
    """New rows of the batch log as a stream, ``pages`` log files at a time.

    A landing is logged by one write and seen whole by whoever reads the log, but its rows may come
    over several micro-batches.
    """
    return (
        store.spark.readStream.schema(stored_schema(s.BATCH_LOGS))
        .option("maxFilesPerTrigger", pages)
        .parquet(f"{store.folder(s.BATCH_LOGS)}/part=*")
    )


def follow(
    store: TableStore,
    spec: s.EntitySpec,
    root: str,
    checkpoint: str,
    pages: int = FOLLOW_PAGES,
    until_idle: bool = False,
    clock: Callable[[], datetime] = utc_now,
    on_fault: str = "fail",
    by_log: bool = False,
) -> StreamingQuery:
    """Consume pages as they land; with ``until_idle`` stop when none is left.

    ``pages`` go to a micro-batch, more only where ``until_idle`` meets a large backlog.

    With ``by_log`` the stream is that of the batch log, and the pages named by its rows are read by
    their names: what was consumed are batch ids, in the order they were logged, whatever the times
    or the order of the files. Otherwise every page found is consumed, logged or not. A full-load
    entity is always consumed by the log: a logged snapshot is whole, and it replaces the table, never
    the pages of one micro-batch.

    Which rows were consumed is kept in the stream checkpoint and does not depend on source
    timestamps. Writes carry the id of the micro-batch, so one that is retried after a failure takes
    up where it stopped. The checkpoint row is written last. Any number of streams may share the
    control tables.
    """
    ledger = Ledger(store)
    by_log = by_log or spec.full_load

    def consume(frame: DataFrame, batch: int) -> None:
        begun = time.monotonic()
        last = batch
        if by_log:
            refs = control.landed(frame, spec.name)
            last = refs.agg(F.max("batch_id")).first()[0]
            if last is None:
                return  # rows of other tables
        # The id of the stream is new whenever its checkpoint folder is new.
        stream_id = store.spark.read.schema("id string").json(f"{checkpoint}/metadata").first()["id"]
        mark = ledger.mark(spec.name, "ANALYTICS", spec.start)

        def log(status: str, rows: int, error: str | None = None) -> None:
            ledger.log_batch(
                run_id=stream_id,
                table_name=spec.name,
                layer="ANALYTICS",
                status=status,
                cursor_value=mark,
                offset_value=0,
                records_count=rows,
                duration_ms=int((time.monotonic() - begun) * 1000),
                error_message=error,
                created_at=clock(),
            )

        try:
            if spec.full_load:
                done = load_snapshot(store, spec, root, clock(), on_fault)
                log("SUCCESS", done.rows if done else 0)
                return
            records = scan_refs(store.spark, spec, root, refs) if by_log else frame
            done = load_table(store, spec, records, clock(), f"{stream_id}:{batch}", on_fault=on_fault)
        except Exception as problem:
            log("FAILED", 0, str(problem))
            raise
        ledger.checkpoint(spec.name, "ANALYTICS", max(mark, done.watermark or mark), clock(), last_batch_id=last)
        log("SUCCESS", done.rows)

    stream = log_stream(store, pages) if by_log else page_stream(store, spec, root, pages, backlog=until_idle)
    writer = stream.writeStream.foreachBatch(consume).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if until_idle else {"processingTime": FOLLOW_INTERVAL}
    return writer.trigger(**trigger).start()


def drain(
    store: TableStore, spec: s.EntitySpec, root: str, checkpoint: str, on_fault: str = "fail"
) -> bool:
    """Consume everything that is unconsumed and return; False if nothing was ever landed."""
    if spec.full_load:
        return load_snapshot(store, spec, root, on_fault=on_fault) is not None
    try:
        query = follow(store, spec, root, checkpoint, DRAIN_PAGES, until_idle=True, on_fault=on_fault)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    query.awaitTermination()
    return True


def load_snapshot(
    store: TableStore, spec: s.EntitySpec, root: str, at: datetime | None = None, on_fault: str = "fail"
) -> Loaded | None:
    """Replace a full-load table by all pages of its latest landed snapshot, once per snapshot."""
    ledger = Ledger(store)
    batches = control.landed(ledger.read(s.BATCH_LOGS), spec.name)
    refs = control.latest_snapshot_batches(batches)
    newest = refs.select("run_id").first()
    if newest is None:
        return None
    token = f"snapshot:{newest['run_id']}"
    if store.has(spec.main_table(), token):
        return None
    return _load_refs(store, ledger, spec, root, refs, at or utc_now(), token, on_fault)


def _load_refs(
    store: TableStore,
    ledger: Ledger,
    spec: s.EntitySpec,
    root: str,
    refs: DataFrame,
    at: datetime,
    token: str,
    on_fault: str,
) -> Loaded:
    paths = control.batch_refs(refs, spec.path.strip("/"))
    require_pages(paths, list_days(store.spark, root, paths), spec)
    done = load_table(store, spec, scan_refs(store.spark, spec, root, refs), at, token, on_fault=on_fault)
    mark = ledger.mark(spec.name, "ANALYTICS", spec.start)
    last = refs.agg(F.max("batch_id")).first()[0]
    ledger.checkpoint(spec.name, "ANALYTICS", max(mark, done.watermark or mark), at, last_batch_id=last)
    return done


def in_window(records: DataFrame, spec: s.EntitySpec, start: int, end: int) -> DataFrame:
    """Raw records with a version in [start, end]."""
    return records.where(F.col(spec.version).try_cast("long").between(start, end))


def replay(
    store: TableStore,
    spec: s.EntitySpec,
    root: str,
    event_id: str,
    start: int,
    end: int,
    at: datetime | None = None,
) -> int:
    """Load one window of landed records again and close its event.

    Runs as a batch beside the stream: live checkpoints and the stream's own
    progress stay as they are, and rows that are newer by now are kept.
    """
    at = at or utc_now()
    ledger = Ledger(store)
    ledger.move_replay(event_id, "IN_PROGRESS", at)
    try:
        pages = control.pages_overlapping(ledger.read(s.BATCH_LOGS), spec.name, start, end)
        done = 0
        if not pages.isEmpty():
            records = in_window(scan_refs(store.spark, spec, root, pages), spec, start, end)
            done = load_table(store, spec, records, at, f"replay:{event_id}").rows
    except Exception as problem:
        ledger.move_replay(event_id, "FAILED", at, error=str(problem))
        raise
    ledger.move_replay(event_id, "COMPLETED", at, done)
    return done


def replay_pending(store: TableStore, specs: list[s.EntitySpec], root: str) -> int:
    """Work through all waiting replays of loaded tables, oldest first; returns how many."""
    by_name = {spec.name: spec for spec in specs}
    waiting = control.pending_replays(Ledger(store).read(s.FALLBACK_EVENTS), "ANALYTICS").collect()
    for event in waiting:
        replay(store, by_name[event.table_name], root, event.event_id, event.start_watermark, event.end_watermark)
    return len(waiting)
