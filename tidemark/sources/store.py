"""Stored tables: plain Parquet that writers append to and readers merge.

<root>/<table>/part=<micros>-<kind>-<token>: one folder per write, put in place by one rename, so that
a reader sees all of a write or nothing. No writer reads or rewrites what another one wrote, hence any
number of them may write to one table at once, and a write costs what its own rows cost. What a table
holds is decided when it is read, by the rule of its declaration (``TableSpec.merge``):

* ``all``: every row;
* ``newest``: the row of every key with the greatest version, of equal versions the last written;
* ``columns``: per key, the last value written to each column that is not null; ``sums`` add up;
* ``distinct``: every row once;
* ``history``: every version of a key, with the validity that follows from the others.

A write of kind ``all`` hides the writes before it. A write with a token that is there already is a
no-op. ``fold`` joins the writes so far to one, on request.
"""

from __future__ import annotations

import re
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.operators.dedup import latest_per_key
from tidemark.operators.history import VALIDITY, build_history, one_per_instant
from tidemark.session import list_folder, move, remove
from tidemark.spec import TableSpec

# Rows after which a new file is begun.
ROWS_PER_FILE = 5_000_000
PART = re.compile(r"^part=(\d{20})-(add|all)-(.*)$")
MARK = "_at"


@dataclass(frozen=True)
class Part:
    """One published write."""

    at: int
    kind: str
    token: str
    path: str


@dataclass(frozen=True)
class Staged:
    """Rows that are written but not published yet."""

    table: TableSpec
    path: str
    kind: str
    token: str


_LAST = [0]


def safe(token: str) -> str:
    """A token as it stands in a folder name."""
    return re.sub(r"[^\w.@-]", "_", token)


def moment() -> int:
    """Microseconds since 1970, growing within a process."""
    _LAST[0] = max(_LAST[0] + 1, time.time_ns() // 1000)
    return _LAST[0]


def stored_schema(table: TableSpec) -> T.StructType:
    derived = VALIDITY if table.merge == "history" else ()
    return T.StructType([f for f in table.schema if f.name not in derived])


@dataclass(frozen=True)
class TableStore:
    spark: SparkSession
    root: str

    def folder(self, table: TableSpec) -> str:
        return f"{self.root}/{table.name}"

    # -- state -------------------------------------------------------------------

    def parts(self, table: TableSpec) -> list[Part]:
        """Published writes in order, from the folder names; files are not opened."""
        found = []
        for name in list_folder(self.spark, self.folder(table)):
            if match := PART.match(name):
                found.append(Part(int(match[1]), match[2], match[3], f"{self.folder(table)}/{name}"))
        return sorted(found, key=lambda p: (p.at, p.kind == "all", p.token))

    def live(self, table: TableSpec) -> list[Part]:
        """The last write that replaced all, and what follows it."""
        parts = self.parts(table)
        whole = [i for i, p in enumerate(parts) if p.kind == "all"]
        return parts[whole[-1] :] if whole else parts

    def exists(self, table: TableSpec) -> bool:
        return bool(self.parts(table))

    def has(self, table: TableSpec, token: str) -> bool:
        return any(p.token == safe(token) for p in self.parts(table))

    # -- read --------------------------------------------------------------------

    def rows(self, table: TableSpec, parts: list[Part] | None = None) -> DataFrame:
        """Rows as they were written, with ``_at``, the moment of their write."""
        parts = self.live(table) if parts is None else parts
        schema = stored_schema(table)
        if not parts:
            return self.spark.createDataFrame([], T.StructType([*schema, T.StructField(MARK, T.LongType())]))
        frame = (
            self.spark.read.schema(T.StructType([*schema, T.StructField("part", T.StringType())]))
            .option("basePath", self.folder(table))
            .parquet(*[p.path for p in parts])
        )
        return frame.withColumn(MARK, F.substring("part", 1, 20).cast("long")).drop("part")

    def read(self, table: TableSpec) -> DataFrame:
        """The merged state."""
        return merged(self.rows(table), table).select(*table.schema.fieldNames())

    def current(self, table: TableSpec) -> DataFrame:
        """The newest version of every key of a history table: one aggregate, no neighbours."""
        order = [table.version, MARK]
        newest = latest_per_key(self.rows(table), [table.keys[0]], order, drop=(MARK,))
        return newest.withColumn("_valid_from", F.timestamp_seconds(table.version))

    # -- write -------------------------------------------------------------------

    def stage(
        self, table: TableSpec, frame: DataFrame, kind: str = "add", token: str | None = None
    ) -> Staged | None:
        """Write rows aside; None if the token is published already."""
        if token is not None and self.has(table, token):
            return None
        token = uuid.uuid4().hex if token is None else safe(token)
        path = f"{self.folder(table)}/_staged/{uuid.uuid4().hex}"
        names = stored_schema(table).fieldNames()
        order = [c for c in (*table.cluster_by, *table.keys) if c in names]
        (
            frame.select(*names)
            .sortWithinPartitions(*order)
            .write.option("maxRecordsPerFile", ROWS_PER_FILE)
            .parquet(path)
        )
        return Staged(table, path, kind, token)

    def publish(self, staged: Staged) -> None:
        name = f"part={moment():020d}-{staged.kind}-{staged.token}"
        move(self.spark, staged.path, f"{self.folder(staged.table)}/{name}")

    def discard(self, staged: Staged) -> None:
        remove(self.spark, staged.path)

    def write(self, table: TableSpec, frame: DataFrame, mode: str = "append", token: str | None = None) -> None:
        """``append``, ``replace``, or ``fail`` when the table is there already."""
        if mode == "fail" and self.exists(table):
            raise FileExistsError(f"table {table.name} exists")
        staged = self.stage(table, frame, "all" if mode == "replace" else "add", token)
        if staged is not None:
            self.publish(staged)

    def fold(self, table: TableSpec) -> None:
        """Join the live writes to one and remove what it stands for.

        The joined rows are published in the place of the last write they come from, which then all
        go: in between, merging takes both as one, so writers may go on. Where rows are counted
        (``all`` and ``sums``) the joined ones hide the others instead, which needs a moment without
        other writers. Tokens of removed writes are forgotten: fold what no stream can try again.
        """
        parts, live = self.parts(table), self.live(table)
        if len(parts) < 2:
            return
        counted = table.merge == "all" or bool(table.sums)
        staged = self.stage(table, merged(self.rows(table, live), table), "all" if counted else "add")
        name = f"part={live[-1].at:020d}-{staged.kind}-{staged.token}"
        move(self.spark, staged.path, f"{self.folder(table)}/{name}")
        for part in parts:
            remove(self.spark, part.path)


def merged(rows: DataFrame, table: TableSpec) -> DataFrame:
    """Rows of :meth:`TableStore.rows` under the rule of their table."""
    keys = list(table.keys)
    if table.merge == "newest":
        order = [c for c in (table.version, MARK) if c]
        return latest_per_key(rows, keys, order, drop=(MARK,))
    if table.merge == "columns":
        rest = [c for c in table.schema.fieldNames() if c not in keys]
        return rows.groupBy(*keys).agg(
            *[
                F.expr(f"sum(`{c}`)").alias(c)
                if c in table.sums
                else F.expr(f"max_by(`{c}`, {MARK}) FILTER (WHERE `{c}` IS NOT NULL)").alias(c)
                for c in rest
            ]
        )
    if table.merge == "distinct":
        return rows.drop(MARK).distinct()
    if table.merge == "history":
        versions = one_per_instant(rows, keys[0], table.version, [MARK], drop=(MARK,))
        return build_history(versions, keys[0], table.version)
    return rows.drop(MARK)
