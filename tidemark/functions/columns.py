"""Column expressions used across the operators. All stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

# Release dates count from 1980-01-01 up to this instant, exclusive.
GUARD_FROM = 315532800
GUARD_UNTIL = 1924991999

DAY_SECONDS = 86400
MICROS = 1_000_000


def epoch_year(seconds: Column) -> Column:
    """Calendar year of Unix seconds, whatever the session time zone is."""
    days = F.floor(seconds / F.lit(DAY_SECONDS)).cast("int")
    return F.year(F.date_add(F.lit("1970-01-01").cast("date"), days)).cast("long")


def date_guard(seconds: Column) -> Column:
    """True for dates fit to show; null dates fail."""
    return (
        seconds.isNotNull()
        & (seconds >= F.lit(GUARD_FROM))
        & (seconds < F.lit(GUARD_UNTIL))
    )


def guarded_year(seconds: Column) -> Column:
    return F.when(date_guard(seconds), epoch_year(seconds))


def round1(value: Column) -> Column:
    """One decimal, half away from zero, as a double."""
    return F.round(value, 1).cast("double")


def floor_to(value: Column, width: int) -> Column:
    """Greatest multiple of ``width`` not above a whole number; exact over the long range."""
    return value - F.pmod(value, F.lit(width))


def epoch_seconds_ntz(ts: Column) -> Column:
    """Whole Unix seconds of a timestamp without zone (floors, also before 1970)."""
    origin = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    micros = F.timestamp_diff("MICROSECOND", origin, ts)
    return (floor_to(micros, MICROS) / F.lit(MICROS)).cast("long")


def elapsed_seconds(begin: Column, end: Column) -> Column:
    """Seconds between two instants, rounded; null while ``end`` is null."""
    micros = F.unix_micros(end.cast("timestamp")) - F.unix_micros(begin.cast("timestamp"))
    return F.round(micros / F.lit(MICROS)).cast("long")


def hash_text(name: str, dtype: T.DataType) -> Column:
    """Text that stands for a value in the row hash: null is empty, lists are sorted."""
    value = F.col(name)
    if isinstance(dtype, T.ArrayType):
        value = F.array_join(F.array_sort(value.cast("array<string>")), ",")
    return F.coalesce(value.cast("string"), F.lit(""))


def row_hash(schema: T.StructType, exclude: tuple[str, ...] = ()) -> Column:
    """SHA-256 over the declared fields in order, joined by a bar."""
    parts = [hash_text(f.name, f.dataType) for f in schema if f.name not in exclude]
    return F.sha2(F.concat_ws("|", *parts), 256)


def whole_number(value: Column, dtype: T.DataType) -> Column:
    """Text to an integer type; ``4.0`` counts as 4, ``4.5`` does not fit."""
    wide = value.try_cast("decimal(38,9)")
    return F.coalesce(
        value.try_cast(dtype),
        F.when(wide == F.floor(wide), wide.try_cast(dtype)),
    )


def as_items(value: Column, source: T.DataType) -> tuple[Column, T.DataType]:
    """An array value and its element type; text is read as a JSON array."""
    if isinstance(source, T.ArrayType):
        return value, source.elementType
    return F.from_json(value.cast("string"), T.ArrayType(T.StringType())), T.StringType()


def fit(value: Column, source: T.DataType, target: T.DataType) -> Column:
    """Cast that yields null for a value that does not fit the target type."""
    if source == target:
        return value
    if isinstance(target, T.ArrayType):
        items, inner = as_items(value, source)
        return F.transform(items, lambda x: fit(x, inner, target.elementType))
    if isinstance(source, T.StringType) and isinstance(target, T.IntegralType):
        return whole_number(value, target)
    if isinstance(source, (T.DoubleType, T.FloatType)) and isinstance(target, T.IntegralType):
        return F.when(value == F.floor(value), value.try_cast(target))
    return value.try_cast(target)


def page_path(entity: str | Column, created_at: Column, cursor: Column, offset: Column) -> Column:
    """Relative path of a landed page file."""
    # Fixed format: <entity>/year=YYYY/month=MM/day=DD/<cursor>_<offset>.json
    label = F.lit(entity) if isinstance(entity, str) else entity
    return F.format_string(
        "%s/year=%d/month=%02d/day=%02d/%d_%d.json",
        label,
        F.year(created_at),
        F.month(created_at),
        F.dayofmonth(created_at),
        cursor,
        offset,
    )
