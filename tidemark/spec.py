"""Declared schemas: entities, their analytics tables and the control tables."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# Fixed value: first instant pulled when a table has no checkpoint (2020-01-01 UTC).
DEFAULT_START = 1577836800
# Records per page and rows after which the page offset starts again.
PAGE_SIZE = 500
OFFSET_ROLLOVER = 10_000

# Plural ending -> singular ending, first match wins; "ss" stays.
SINGULAR_ENDINGS = (
    ("ies", "y"),
    ("ches", "ch"),
    ("shes", "sh"),
    ("ses", "s"),
    ("xes", "x"),
    ("ss", "ss"),
    ("s", ""),
)

LONG, TEXT, REAL, FLAG, INSTANT, INT = (
    T.LongType(),
    T.StringType(),
    T.DoubleType(),
    T.BooleanType(),
    T.TimestampType(),
    T.IntegerType(),
)
LONGS = T.ArrayType(LONG)

AUDIT_FIELDS = [
    T.StructField("_ingested_at", INSTANT, False),
    T.StructField("_hash", TEXT, False),
]
VALIDITY_FIELDS = [
    T.StructField("_valid_from", INSTANT, False),
    T.StructField("_valid_to", INSTANT, True),
    T.StructField("_is_current", FLAG, False),
]


def record(*columns: tuple[str, T.DataType], required: tuple[str, ...] = ()) -> T.StructType:
    """Schema from (name, type) pairs; names in ``required`` are not nullable."""
    return T.StructType([T.StructField(n, t, n not in required) for n, t in columns])


def named(dtype: T.DataType, *names: str) -> list[tuple[str, T.DataType]]:
    return [(n, dtype) for n in names]


def singular(word: str) -> str:
    head, sep, last = word.rpartition("_")
    for ending, instead in SINGULAR_ENDINGS:
        if last.endswith(ending):
            last = last[: len(last) - len(ending)] + instead
            break
    return head + sep + last


@dataclass(frozen=True)
class TableSpec:
    """One stored table: schema, key, row order inside files, and how its writes are merged.

    ``merge`` is a rule of ``sources/store.py``; ``version`` orders the rows of a key, ``sums`` names
    columns that add up.
    """

    name: str
    schema: T.StructType
    keys: tuple[str, ...]
    cluster_by: tuple[str, ...] = ()
    merge: str = "all"
    version: str | None = None
    sums: tuple[str, ...] = ()


@dataclass(frozen=True)
class EntitySpec:
    """A source entity and how it is kept."""

    name: str
    path: str
    schema: T.StructType
    key: str = "id"
    version: str = "updated_at"
    start: int = DEFAULT_START
    page_size: int = PAGE_SIZE
    keep_history: bool = False
    full_load: bool = False
    cluster_by: tuple[str, ...] = ()
    source_names: dict[str, str] = field(default_factory=dict)

    @property
    def base_name(self) -> str:
        return self.path.strip("/").replace("/", "_")

    @property
    def table_name(self) -> str:
        return f"{self.base_name}_scd2" if self.keep_history else self.base_name

    @property
    def fields(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def list_fields(self) -> list[str]:
        return [f.name for f in self.schema if isinstance(f.dataType, T.ArrayType)]

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.schema if not f.nullable]

    @property
    def main_fields(self) -> list[str]:
        """Columns of the main table: lists stay only where history is kept."""
        lists = [] if self.keep_history else self.list_fields
        return [n for n in self.fields if n not in lists]

    def main_table(self) -> TableSpec:
        columns = [self.schema[n] for n in self.main_fields] + AUDIT_FIELDS
        if self.keep_history:
            columns = columns + VALIDITY_FIELDS
        if self.full_load:
            return TableSpec(self.table_name, T.StructType(columns), (self.key,), self.cluster_by)
        return TableSpec(
            self.table_name,
            T.StructType(columns),
            (self.key, "_valid_from") if self.keep_history else (self.key,),
            self.cluster_by,
            "history" if self.keep_history else "newest",
            self.version,
        )

    def junction_columns(self, list_field: str) -> tuple[str, str]:
        return f"{singular(self.base_name)}_id", f"{singular(list_field)}_id"

    def junction_table(self, list_field: str) -> TableSpec:
        left, right = self.junction_columns(list_field)
        element = self.schema[list_field].dataType.elementType
        return TableSpec(
            f"{singular(self.base_name)}_{list_field}",
            record((left, self.schema[self.key].dataType), (right, element)),
            (left, right),
            merge="distinct",
        )


GAME = EntitySpec(
    name="Game",
    path="games",
    keep_history=True,
    cluster_by=("rating", "first_release_date"),
    schema=record(
        *named(LONG, "id"),
        *named(TEXT, "name", "slug", "summary", "storyline"),
        *named(LONG, "created_at", "updated_at", "first_release_date"),
        *named(REAL, "rating"),
        *named(LONG, "rating_count"),
        *named(REAL, "aggregated_rating"),
        *named(LONG, "aggregated_rating_count"),
        *named(REAL, "total_rating"),
        *named(LONG, "total_rating_count", "hypes", "game_type", "game_status"),
        *named(LONGS, "genres", "platforms", "involved_companies", "release_dates"),
        *named(LONGS, "game_modes", "themes", "collections"),
        *named(LONG, "parent_game", "version_parent"),
        *named(TEXT, "version_title", "checksum"),
        required=("id", "name"),
    ),
)

COMPANY = EntitySpec(
    name="Company",
    path="companies",
    schema=record(
        *named(LONG, "id"),
        *named(TEXT, "name", "slug", "description"),
        *named(LONG, "country", "parent", "changed_company_id", "created_at", "updated_at"),
        *named(TEXT, "checksum"),
        required=("id", "name"),
    ),
)

RELEASE_DATE = EntitySpec(
    name="ReleaseDate",
    path="release_dates",
    cluster_by=("game", "y"),
    schema=record(
        *named(LONG, "id", "game", "platform", "date"),
        *named(TEXT, "human"),
        *named(LONG, "y", "m", "region", "status", "created_at", "updated_at"),
        *named(TEXT, "checksum"),
        required=("id",),
    ),
)

GENRE = EntitySpec(
    name="Genre",
    path="genres",
    full_load=True,
    schema=record(
        *named(LONG, "id"),
        *named(TEXT, "name", "slug"),
        *named(LONG, "created_at", "updated_at"),
        *named(TEXT, "checksum"),
        required=("id", "name"),
    ),
)

PLATFORM = EntitySpec(
    name="Platform",
    path="platforms",
    full_load=True,
    schema=record(
        *named(LONG, "id"),
        *named(TEXT, "name", "slug", "abbreviation", "alternative_name"),
        *named(LONG, "generation", "platform_family", "created_at", "updated_at"),
        *named(TEXT, "checksum"),
        required=("id", "name"),
    ),
)

ENTITIES = (COMPANY, GAME, GENRE, PLATFORM, RELEASE_DATE)

TYPE_CHANGE = record(("old", TEXT), ("new", TEXT))
CHANGED_COLUMNS = record(
    ("added", T.ArrayType(TEXT)),
    ("removed", T.ArrayType(TEXT)),
    ("type_changed", T.MapType(TEXT, TYPE_CHANGE)),
)

RUNS = TableSpec(
    "ingestion_runs",
    record(
        ("run_id", TEXT),
        ("started_at", INSTANT),
        ("completed_at", INSTANT),
        ("layer", TEXT),
        ("status", TEXT),
        ("error_message", TEXT),
        required=("run_id",),
    ),
    ("run_id",),
    merge="columns",
)
CHECKPOINTS = TableSpec(
    "ingestion_checkpoints",
    record(
        ("checkpoint_id", TEXT),
        ("table_name", TEXT),
        ("current_watermark", LONG),
        ("fallback_watermark", LONG),
        ("last_id", LONG),
        ("last_batch_id", LONG),
        ("layer", TEXT),
        ("offset_val", LONG),
        ("is_override_active", FLAG),
        ("last_successful_run_id", TEXT),
        ("updated_at", INSTANT),
        required=("table_name", "layer"),
    ),
    ("table_name", "layer"),
    merge="columns",
)
FALLBACK_EVENTS = TableSpec(
    "fallback_events",
    record(
        ("event_id", TEXT),
        ("table_name", TEXT),
        ("layer", TEXT),
        ("start_watermark", LONG),
        ("end_watermark", LONG),
        ("status", TEXT),
        ("records_processed", LONG),
        ("error_message", TEXT),
        ("created_at", INSTANT),
        ("completed_at", INSTANT),
        required=("event_id",),
    ),
    ("event_id",),
    merge="columns",
    sums=("records_processed",),
)
BATCH_LOGS = TableSpec(
    "batch_logs",
    record(
        ("batch_id", LONG),
        ("run_id", TEXT),
        ("table_name", TEXT),
        ("layer", TEXT),
        ("status", TEXT),
        ("cursor_value", LONG),
        ("offset_value", LONG),
        ("records_count", LONG),
        ("duration_ms", LONG),
        ("query_sent", TEXT),
        ("error_message", TEXT),
        ("created_at", INSTANT),
        ("first_version", LONG),
        ("last_version", LONG),
        required=("batch_id",),
    ),
    ("batch_id", "run_id", "table_name"),
    merge="newest",
)
SCHEMA_HISTORY = TableSpec(
    "schema_history",
    record(
        ("id", LONG),
        ("table_name", TEXT),
        ("schema_hash", TEXT),
        ("columns_snapshot", T.MapType(TEXT, TEXT)),
        ("changed_columns", CHANGED_COLUMNS),
        ("detected_at", INSTANT),
        ("detected_in_run_id", TEXT),
        ("included_at", INSTANT),
        ("status", TEXT),
        ("action_taken", TEXT),
    ),
    ("id", "table_name"),
    merge="newest",
)
