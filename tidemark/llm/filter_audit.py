"""Filter interaction audit: what each filter removes after any set of other filters.

Every document gets a mask of the filters it fails; documents are counted per part and mask, so that
a part is at most 2^F cells. A Gray-code walk visits all subsets of the filters by toggling one
filter at a time: each cell keeps the number of active filters it fails, cells that go from none to
one leave the running survivors, cells that go back to none return. The survivors of all subsets are
stored; any step of any order of the filters is the difference of two of them.

Texts meet by their SHA-256. The smallest doc_id of a text is aggregated before the shuffle and
comes back by a join on text and doc_id, so that a group of copies never meets in one task.

Defined cases: a null text is the empty text, and equal to it; a null source is the empty string; a
null doc_id never fails the copy filter, makes no other row fail it and has no label; rows that repeat one doc_id
and text are judged alike and count each; several label rows of one doc_id count as one that holds if
any of them holds; very long texts are read whole; an empty table has no parts and no rows. Columns
are taken by position after the selection, so other columns may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tidemark.llm.common import as_bytes, map_rows, materialise, table

NAMES = "ABCDE"
UPPER = bytes(range(65, 91))
SYMBOLS = b"#$%&*|"
SUMS = ("docs", "good", "toxic")
MOST_FILTERS = 8

REPORT = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, "
    "unique_fails long, good_lost long, toxic_lost long, shapley long"
)


def text_failures(text: bytes, least_words: int = 200) -> int:
    """Mask of the four filters that look at one text alone, the first filter as bit 0.

    Few words, few distinct words, many capitals per code point, markup symbols.
    """
    words = text.split()  # on the ASCII blanks 20 and 09-0D
    capitals = len(text) - len(text.translate(None, UPPER))
    points = len(text.decode("utf-8", "replace"))
    return (
        (len(words) < least_words)
        | (100 * len(set(words)) < 50 * len(words)) << 1
        | (100 * capitals > 2 * points) << 2
        | (len(text.translate(None, SYMBOLS)) < len(text)) << 3
    )


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """(id, part, mask) per document; bit 4 of the mask marks a copy of a text with a smaller id."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col), F.coalesce(F.col(part_col).cast("string"), F.lit("")), as_bytes(text_col))

    def look(ids, parts, texts):
        return [ids, parts, [text_failures(t) for t in texts], [hashlib.sha256(t).digest() for t in texts]]

    seen = materialise(map_rows(rows, look, f"id {kind}, part string, mask int, digest binary"), "failures")
    firsts = (
        seen.where("id IS NOT NULL").groupBy("digest").agg(F.min("id").alias("id"))
        .withColumn("is_first", F.lit(True))
    )
    copy = F.col("id").isNotNull() & F.col("is_first").isNull()
    return seen.join(firsts, ["digest", "id"], "left").select(
        "id", "part", F.col("mask").bitwiseOR(F.when(copy, 1 << 4).otherwise(0)).alias("mask")
    )


def subset_states(masks: Sequence[int], sums: np.ndarray, filters: int) -> np.ndarray:
    """Survivor sums of every subset of the filters, by a Gray-code walk. ``sums`` has a row per mask."""
    running = sums.sum(axis=0)
    states = np.zeros((1 << filters, sums.shape[1]), dtype=np.int64)
    states[0] = running
    active = [0] * len(masks)
    subset = 0
    for step in range(1, 1 << filters):
        toggled = (step & -step).bit_length() - 1
        subset ^= 1 << toggled
        change = 1 if subset >> toggled & 1 else -1
        for cell, mask in enumerate(masks):
            if mask >> toggled & 1:
                active[cell] += change
                if change == 1 and active[cell] == 1:
                    running = running - sums[cell]
                elif change == -1 and active[cell] == 0:
                    running = running + sums[cell]
        states[subset] = running
    return states


def steps(masks: Sequence[int], sums: np.ndarray, names: str) -> Iterator[tuple]:
    """All orders and steps of one part, as differences of stored states."""
    filters = len(names)
    states = subset_states(masks, sums, filters)
    fails = [sum(int(sums[i, 0]) for i, m in enumerate(masks) if m >> f & 1) for f in range(filters)]
    alone = [sum(int(sums[i, 0]) for i, m in enumerate(masks) if m == 1 << f) for f in range(filters)]
    shapley = [0] * filters
    for f in range(filters):
        for before in range(1 << filters):
            if not before >> f & 1:
                ahead = before.bit_count()
                orders = factorial(ahead) * factorial(filters - 1 - ahead)
                shapley[f] += orders * int(states[before, 0] - states[before | 1 << f, 0])
    for order in permutations(range(filters)):
        label, before = "".join(names[f] for f in order), 0
        for step, f in enumerate(order, 1):
            after = before | 1 << f
            docs, good, toxic = (int(x) for x in states[before] - states[after])
            yield (label, step, int(states[after, 0]), docs, fails[f] - docs, alone[f], good, toxic, shapley[f])
            before = after


def audit(judged: DataFrame, names: str = NAMES) -> DataFrame:
    """The report of ``REPORT`` from (part, mask, good, toxic) per document; bit i is filter ``names[i]``."""
    if not 0 < len(names) <= MOST_FILTERS:
        raise ValueError(f"1 to {MOST_FILTERS} filters: their orders are listed one by one")
    cells = judged.groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("docs"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic")
    )
    # At most 2^F cells to a part.
    parts = cells.groupBy("part").agg(F.collect_list(F.struct("mask", *SUMS)).alias("cells"))
    schema = to_arrow_schema(StructType.fromDDL(REPORT))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sums = np.array([[c[s] for s in SUMS] for c in found], dtype=np.int64)
                rows = [(part, *row) for row in steps([c["mask"] for c in found], sums, names)]
                columns = [pa.array(c, type=f.type) for c, f in zip(zip(*rows), schema)]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return parts.mapInArrow(walk, REPORT)


def labelled(judged: DataFrame, labels: DataFrame) -> DataFrame:
    """Adds ``good`` and ``toxic``, false without a label."""

    def holds(name: str) -> Column:
        return F.coalesce(F.max(F.col(name) == 1), F.lit(False)).alias(f"is_{name}")

    marks = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("id")).agg(holds("quality"), holds("toxic"))
    return judged.join(marks, "id", "left").select(
        "part", "mask",
        F.coalesce("is_quality", F.lit(False)).alias("good"), F.coalesce("is_toxic", F.lit(False)).alias("toxic"),
    )


def op11(spark, sf_dir: str) -> DataFrame:
    return audit(labelled(judge(table(spark, sf_dir, "documents")), table(spark, sf_dir, "labels")))


OP11_SQL = r"""
WITH base AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
marks AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
judged AS (
  SELECT b.part, coalesce(m.good, false) AS good, coalesce(m.toxic, false) AS toxic,
    CASE WHEN len(ws) < 200 THEN 'A' ELSE '' END
    || CASE WHEN 100 * len(list_distinct(ws)) < 50 * len(ws) THEN 'B' ELSE '' END
    || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
    || CASE WHEN min(b.doc_id) OVER (PARTITION BY t) < b.doc_id THEN 'E' ELSE '' END AS fails
  FROM base b LEFT JOIN marks m USING (doc_id)),
cells AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM judged GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
placed AS (
  SELECT part, filter_order, fails, n, good, toxic,
    coalesce(list_min(list_transform(regexp_extract_all(fails, '.'), lambda x: strpos(filter_order, x))), 6) AS hit
  FROM cells, orders),
found AS (
  SELECT part, filter_order, step, substr(filter_order, step, 1) AS letter,
    coalesce(sum(n) FILTER (hit > step), 0) AS kept,
    coalesce(sum(n) FILTER (hit = step), 0) AS removed,
    coalesce(sum(n) FILTER (hit < step AND contains(fails, substr(filter_order, step, 1))), 0) AS redundant,
    coalesce(sum(n) FILTER (fails = substr(filter_order, step, 1)), 0) AS unique_fails,
    coalesce(sum(good) FILTER (hit = step), 0) AS good_lost,
    coalesce(sum(toxic) FILTER (hit = step), 0) AS toxic_lost
  FROM placed, (SELECT CAST(unnest(range(1, 6)) AS INTEGER) AS step) GROUP BY ALL)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
  CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM found
"""
