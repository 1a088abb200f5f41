"""The control tables as stored state.

Every method appends rows that say what became known: no row is rewritten, nothing is read to choose
an id, and what a table holds follows from all rows when it is read. So any number of streams and
runs may use one set of control tables at once.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from tidemark import spec as s
from tidemark.operators.drift import drift_events, profile_pages, snapshots
from tidemark.operators.merge import insert_absent
from tidemark.operators.paging import ordered_rank
from tidemark.plans import control
from tidemark.sources.store import TableStore, moment

# Fixed value: microseconds up to the start of the ids.
ID_EPOCH = s.DEFAULT_START * 1_000_000
# Places behind each microsecond, for rows that are logged together.
ID_BITS = 10


def first_id() -> int:
    """Where the ids of the next rows begin: later rows get greater ids, without a look at the log.

    Rows logged together count on from here. Writers that hit upon the same number still differ by
    their run, which is part of the key.
    """
    return (moment() - ID_EPOCH) << ID_BITS


@dataclass(frozen=True)
class Ledger:
    store: TableStore

    def read(self, table: s.TableSpec) -> DataFrame:
        return self.store.read(table)

    def _frame(self, table: s.TableSpec, **values) -> DataFrame:
        row = tuple(values.get(n) for n in table.schema.fieldNames())
        return self.store.spark.createDataFrame([row], table.schema)

    # -- runs --------------------------------------------------------------------

    def start_run(self, layer: str, at: datetime, run_id: str | None = None) -> str:
        run_id = run_id or str(uuid.uuid4())
        fresh = self._frame(s.RUNS, run_id=run_id, started_at=at, layer=layer, status="RUNNING")
        self.store.write(s.RUNS, insert_absent(self.read(s.RUNS), fresh, ["run_id"]))
        return run_id

    def finish_run(self, run_id: str, status: str, at: datetime, error: str | None = None) -> None:
        self.store.write(
            s.RUNS, self._frame(s.RUNS, run_id=run_id, status=status, error_message=error, completed_at=at)
        )

    def recover_orphans(self, at: datetime, reason: str = control.ORPHAN_REASON) -> int:
        """Close dangling runs and return how many there were."""
        dangling = self.read(s.RUNS).where(F.col("status") == "RUNNING")
        closed = control.fail_orphan_runs(dangling, at, reason).checkpoint()
        found = closed.count()
        if found:
            self.store.write(s.RUNS, closed)
        return found

    # -- batches -----------------------------------------------------------------

    def log_pages(
        self, pages: DataFrame, entity: s.EntitySpec, run_id: str, at: datetime, elapsed_ms: int, query: str
    ) -> None:
        """Log landed pages (cursor, offset, records, last_version, last_id), ids going on in page order."""
        first = first_id()
        ranked = ordered_rank(pages, "last_version", "last_id", "_rank")
        self.store.write(
            s.BATCH_LOGS,
            ranked.select(
                (F.col("_rank") + F.lit(first)).alias("batch_id"),
                F.lit(run_id).alias("run_id"),
                F.lit(entity.name).alias("table_name"),
                F.lit("RAW").alias("layer"),
                F.lit("SUCCESS").alias("status"),
                F.col("cursor").alias("cursor_value"),
                F.col("offset").alias("offset_value"),
                F.col("records").alias("records_count"),
                F.lit(elapsed_ms).cast("long").alias("duration_ms"),
                F.lit(query).alias("query_sent"),
                F.lit(None).cast("string").alias("error_message"),
                F.lit(at).alias("created_at"),
                "first_version",
                "last_version",
            ),
        )

    def log_batch(self, **values) -> None:
        """Log one batch, such as a micro-batch or a failed extract."""
        self.store.write(s.BATCH_LOGS, self._frame(s.BATCH_LOGS, batch_id=first_id(), **values))

    # -- checkpoints -------------------------------------------------------------

    def checkpoint(
        self,
        table_name: str,
        layer: str,
        watermark: int,
        at: datetime,
        last_id: int = 0,
        last_batch_id: int = 0,
        offset: int = 0,
        run_id: str | None = None,
    ) -> None:
        """Progress of a table and, since the step succeeded, its safety mark."""
        state = self._frame(
            s.CHECKPOINTS,
            checkpoint_id=f"{table_name}:{layer}",
            table_name=table_name,
            layer=layer,
            current_watermark=watermark,
            fallback_watermark=watermark,
            last_id=last_id,
            last_batch_id=last_batch_id,
            offset_val=offset,
            last_successful_run_id=run_id,
            is_override_active=False,
            updated_at=at,
        )
        self.store.write(s.CHECKPOINTS, state)

    def mark(self, table_name: str, layer: str, start: int) -> int:
        """Current watermark of a table, its starting point if there is none."""
        found = (
            self.read(s.CHECKPOINTS)
            .where((F.col("table_name") == table_name) & (F.col("layer") == layer))
            .select("current_watermark")
            .first()
        )
        return found[0] if found and found[0] > 0 else start

    def set_override(
        self, table_name: str, at: datetime, mark: int | None = None, active: bool = True
    ) -> bool:
        """Returns whether the table has a checkpoint."""
        layers = self.read(s.CHECKPOINTS).where(F.col("table_name") == table_name).select("layer").collect()
        for row in layers:
            change = self._frame(
                s.CHECKPOINTS,
                table_name=table_name,
                layer=row["layer"],
                fallback_watermark=mark,
                is_override_active=active,
                updated_at=at,
            )
            self.store.write(s.CHECKPOINTS, change)
        return bool(layers)

    # -- replays -----------------------------------------------------------------

    def create_replay(
        self, table_name: str, start: int, end: int, at: datetime, layer: str = "RAW"
    ) -> DataFrame:
        """Queue a replay of [start, end] and return its row."""
        row = self._frame(
            s.FALLBACK_EVENTS,
            event_id=str(uuid.uuid4()),
            table_name=table_name,
            layer=layer,
            start_watermark=start,
            end_watermark=end,
            status="PENDING",
            records_processed=0,
            created_at=at,
        )
        self.store.write(s.FALLBACK_EVENTS, row)
        return row

    def move_replay(
        self, event_id: str, status: str, at: datetime, records: int = 0, error: str | None = None
    ) -> None:
        change = self._frame(
            s.FALLBACK_EVENTS,
            event_id=event_id,
            status=status,
            records_processed=records,
            error_message=error,
            completed_at=at if status in ("COMPLETED", "FAILED") else None,
        )
        self.store.write(s.FALLBACK_EVENTS, change)

    # -- schema history ----------------------------------------------------------

    def log_drift(
        self, records: DataFrame, column: str, entity: s.EntitySpec | None, run_id: str, at: datetime
    ) -> int:
        """Profile landed lines (a record or an array of records) and log a changed schema.

        Without an entity the records carry their ``table_name``, and all tables are logged at once.
        A schema that is the last one logged of its table already is not logged again. Returns the
        number of rows logged.
        """
        table = F.col("table_name") if entity is None else F.lit(entity.name).alias("table_name")
        named = records.select(table, F.lit(0).cast("long").alias("batch_id"), column)
        keys = ("table_name", "batch_id")
        seen = snapshots(profile_pages(named, column, *keys), *keys)
        history = self.read(s.SCHEMA_HISTORY)
        fresh = drift_events(seen, history)
        rows = fresh.select(
            F.lit(first_id()).cast("long").alias("id"),
            "table_name",
            "schema_hash",
            "columns_snapshot",
            "changed_columns",
            F.lit(at).alias("detected_at"),
            F.lit(run_id).alias("detected_in_run_id"),
            F.lit(None).cast("timestamp").alias("included_at"),
            F.lit("NEW_COLUMN").alias("status"),
            F.lit(None).cast("string").alias("action_taken"),
        ).collect()  # at most one row per table
        if rows:
            self.store.write(
                s.SCHEMA_HISTORY, self.store.spark.createDataFrame(rows, s.SCHEMA_HISTORY.schema)
            )
        return len(rows)
