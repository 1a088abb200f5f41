"""Suffix-array dedup: repeated byte windows by a depth-limited radix sort.

Suffixes are ordered only through ``size`` bytes, by passes over their digits from the most significant
on; a suffix alone in its group drops out after each pass, and the groups left after the last pass
are exactly the repeated windows. The first digit is the window's minimizer, by which ``repeats`` deals
suffixes to buckets; runs of suffixes with equal content count as one with its number of copies, and go
whole without a pass; where different contents share a minimizer the rest is sorted digit by digit.
A digit is 80 bytes, compared by their hash: equal digits are told apart from others, their order is free.

Defined cases: an empty table gives no rows; other columns may have any name; null text is empty; texts shorter than ``size`` keep everything; repeated rows are
documents of their own and repeat one another.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.llm import repeats
from tidemark.llm.common import table

DIGITS = 5


def radix_groups(units: np.ndarray, starts: np.ndarray, group: np.ndarray, weight: np.ndarray, size: int) -> np.ndarray:
    """Places in ``starts`` of the suffixes that equal others through ``size`` units.

    ``group`` holds the digits already sorted by, ``weight`` the copies of each suffix.
    """
    left = np.arange(len(starts))
    sums = repeats.prefix(repeats.BYTE[units])
    edges = [size * i // DIGITS for i in range(DIGITS + 1)]
    for a, b in zip(edges, edges[1:]):
        if not len(left):
            break
        digit = repeats.rolled(sums, starts[left] + a, starts[left] + b)
        order = np.lexsort((digit, group))
        g, d = group[order], digit[order]
        new = np.concatenate([[True], (g[1:] != g[:-1]) | (d[1:] != d[:-1])])
        number = np.cumsum(new) - 1
        full = np.bincount(number, weights=weight[left[order]]) > 1
        stay = full[number]
        left, group = left[order][stay], number[stay]
    return left


class ByteWindows(repeats.Method):
    def attributes(self, run_doc, ids):
        return np.ones(len(run_doc), np.int64)

    def merge(self, numbers, groups, count):
        return np.minimum(np.bincount(groups, weights=numbers, minlength=count), 2).astype(np.int64)

    def wanted(self, keys, first):
        """Classes that share their minimizer with other content."""
        same = keys[1:] == keys[:-1]
        return np.concatenate([same, [False]]) | np.concatenate([[False], same])

    def resolve(self, classes):
        """Per class its copies, and (class, window, 1) for repeated windows of classes without copies."""
        n = classes.n
        row = np.repeat(np.arange(len(n)), n)
        begins = np.concatenate([[0], np.cumsum(n + self.window - 1)])[:-1]
        inside = np.arange(len(row)) - np.repeat(np.concatenate([[0], np.cumsum(n)])[:-1], n)
        _, group = np.unique(classes.key[classes.wanted], return_inverse=True)
        weight = classes.number[classes.wanted]
        hit = radix_groups(classes.units, begins[row] + inside, group[row], weight[row], self.window)
        hit = hit[weight[row[hit]] < 2]
        extra = np.column_stack([classes.wanted[row[hit]], inside[hit], np.ones(len(hit), np.int64)])
        return classes.number, extra

    def finish(self, ids, texts, units, numbers, extra):
        whole = numbers > 1
        doc = np.concatenate([units.doc[whole], units.doc[extra[:, 0]]])
        start = np.concatenate([units.first[whole], units.first[extra[:, 0]] + extra[:, 1]])
        n = np.concatenate([units.n[whole], extra[:, 2]])
        spans = repeats.covered(len(texts), doc, start, start + n - 1 + self.window)
        kept = []
        for text, cut in zip(texts, spans):
            edges = [0, *(e for span in cut for e in span), len(text)]
            kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])))
        return [ids, texts, [[{"start": a, "end": b} for a, b in s] for s in spans], kept]


SPANS = "array<struct<start:int,end:int>>"
ARROW_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def dedup(docs: DataFrame, size: int = 400, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text binary, spans, kept binary): repeated byte ranges of each document and what is left."""
    kind = docs.schema[id_col].dataType
    method = ByteWindows(
        window=size, gram=max(1, size // 2), words=False, by_document=False,
        schema=f"id {kind.simpleString()}, text binary, spans {SPANS}, kept binary",
        types=[("id", to_arrow_type(kind)), ("text", pa.binary()), ("spans", ARROW_SPANS), ("kept", pa.binary())],
    )
    return repeats.find(docs, method, id_col, text_col)


def op8(spark, sf_dir: str) -> DataFrame:
    found = dedup(table(spark, sf_dir, "documents"))
    size, kept = F.octet_length("text").cast("long"), F.octet_length("kept").cast("long")
    return found.select(
        F.col("id").alias("doc_id"), size.alias("n_bytes"), (size - kept).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )
