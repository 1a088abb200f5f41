"""Previous and next row of a key, without holding one key in one task."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.columns import floor_to


def with_neighbours(
    frame: DataFrame,
    keys: list[str],
    order: str,
    width: int,
    previous: Mapping[str, str] | None = None,
    following: Mapping[str, str] | None = None,
) -> DataFrame:
    """Add columns of the previous or following row of the same key.

    ``order`` is a whole number and unique within a key. Rows are windowed per
    key and slice of ``width`` order values, so a window group never exceeds
    ``width`` rows, however large the key is. Only the first and the last row of
    a slice look beyond it: their neighbours come from the slice edges, one small
    row per slice.
    """
    previous, following = dict(previous or {}), dict(following or {})
    sliced = frame.withColumn("_slice", floor_to(F.col(order), width))
    by_key = Window.partitionBy(*keys).orderBy("_slice")
    inside = Window.partitionBy(*keys, "_slice").orderBy(order)

    edges = sliced.groupBy(*keys, "_slice").agg(
        F.max_by(F.struct(order, *_sources(previous, order)), order).alias("_last"),
        F.min_by(F.struct(order, *_sources(following, order)), order).alias("_first"),
    )
    edges = edges.select(
        *keys,
        "_slice",
        F.lag("_last").over(by_key).alias("_before"),
        F.lead("_first").over(by_key).alias("_after"),
    )

    def around(source: str, step, edge: str) -> Column:
        within = step(F.lit(True)).over(inside)
        return F.when(within, step(source).over(inside)).otherwise(F.col(f"{edge}.{source}"))

    added = {n: around(c, F.lag, "_before") for n, c in previous.items()}
    added |= {n: around(c, F.lead, "_after") for n, c in following.items()}
    return (
        sliced.join(edges, [*keys, "_slice"], "left")
        .withColumns(added)
        .select(*frame.columns, *added)
    )


def _sources(wanted: Mapping[str, str], order: str) -> list[str]:
    return [c for c in dict.fromkeys(wanted.values()) if c != order]
