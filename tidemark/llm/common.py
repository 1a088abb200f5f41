"""Helpers shared by the operators: reading tables, Arrow batches, texts as bytes."""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tidemark.session import scratch


def on_workers(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, unless a path is set already."""
    root = str(Path(__file__).resolve().parents[2])
    spark.sparkContext.environment.setdefault("PYTHONPATH", root)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    on_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_bytes(column: str) -> Column:
    """The UTF-8 bytes of a text column, null as empty."""
    return F.coalesce(F.col(column).cast("binary"), F.lit(bytearray()))


def plain(frame: DataFrame) -> DataFrame:
    """Columns named by position, so that no name in the data can clash or need quotes."""
    return frame.toDF(*(f"c{i}" for i in range(len(frame.columns))))


def map_rows(frame: DataFrame, fn: Callable[..., list], schema: str, rows: int = 1024) -> DataFrame:
    """``fn`` gets the columns of up to ``rows`` rows as lists and returns the output columns.

    Slicing bounds what a task holds at once, whatever the session's batch size is.
    """
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                out = fn(*(c.to_pylist() for c in part.columns))
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(out, arrow)], schema=arrow)

    return plain(frame).mapInArrow(run, schema)


def rewrite_rows(
    frame: DataFrame, column: str, fn: Callable[..., tuple[list, list]], inputs: tuple[str, ...] = (), rows: int = 1024
) -> DataFrame:
    """All columns of ``frame`` by position, with ``column`` replaced and rows kept as ``fn`` says.

    ``fn`` gets the values of ``inputs`` (``column`` if none are named) and returns (new values, keep
    flags). Other columns pass through untouched, whatever their names are.
    """
    position = frame.columns.index(column)
    places = [frame.columns.index(c) for c in inputs or (column,)]
    arrow = to_arrow_schema(plain(frame).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                values, keep = fn(*(part.column(p).to_pylist() for p in places))
                columns = list(part.columns)
                columns[position] = pa.array(values, type=arrow.field(position).type)
                columns = [c if c.type == f.type else c.cast(f.type) for c, f in zip(columns, arrow)]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow).filter(pa.array(keep, type=pa.bool_()))

    return plain(frame).mapInArrow(run, plain(frame).schema).toDF(*frame.columns)


_HELD: OrderedDict[str, object] = OrderedDict()


def once(key: str, make: Callable[[], object], most: int = 2):
    """What ``make`` builds, kept in this worker process for later tasks; the oldest of ``most`` goes."""
    if key not in _HELD:
        while len(_HELD) >= most:
            _HELD.popitem(last=False)
        _HELD[key] = make()
    return _HELD[key]


def materialise(frame: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage and survives lost executors."""
    spark = frame.sparkSession
    path = scratch(spark, label)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


BLOCK = 128


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, also where ``use`` names it inside lambdas."""
    return F.transform(F.array(value), use)[0]


def running(values: Column, join: Callable[[Column, Column], Column]) -> Column:
    """Running sums (or maxima) of an array of numbers from 0 on, joined by ``join``.

    Appending to an array copies it, so long arrays run block by block, and the blocks by their totals.
    """
    last = lambda s, i: F.coalesce(F.get(s, i), F.lit(0))
    short = lambda vs: F.aggregate(
        vs, F.array().cast("array<int>"), lambda s, x: F.concat(s, F.array(join(last(s, F.size(s) - 1), x))))

    def long(vs: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(vs) - 1) / BLOCK).cast("int")), lambda b: short(F.slice(vs, b * BLOCK + 1, BLOCK)))
        shifted = lambda bs, before: F.transform(
            bs, lambda block, i: let(last(before, i - 1), lambda d: F.transform(block, lambda v: join(d, v))))
        return let(blocks, lambda bs: let(short(F.transform(bs, lambda b: last(b, F.size(b) - 1))), lambda before: F.flatten(shifted(bs, before))))

    return let(values, lambda vs: F.when(F.size(vs) <= BLOCK, short(vs)).otherwise(long(vs)))
