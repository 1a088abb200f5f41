"""Substring dedup through compressed FM-indexes.

A shard's passages (runs of words that may recur, see ``repeats``) are indexed together: their suffixes
are sorted through the threshold depth, the Burrows-Wheeler transform of that order is kept in a wavelet
matrix of packed bits with rank counts, and each passage is streamed against it by backward search. That gives
the matching statistics: how many words before a place also occur elsewhere, up to the threshold. Where the
threshold is reached the interval of suffixes names all occurrences, and the smallest document among
them decides. Ordering through the threshold is enough for patterns up to that length.

Words are compared by 64-bit hashes that mix all their bytes (``repeats.word_hashes``). A passage that is equal
as a whole to one of an earlier document is one entry of the index with the smallest document as its number,
so it is removed without a search of its own. Defined cases: an empty table gives no rows; other columns may have
any name; a null text has no words; a document without id
comes after all others; documents that share an id do not remove each other's words; texts
shorter than ``size`` words keep everything.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import repeats
from tidemark.llm.common import table
from tidemark.llm.suffix_dedup import ARROW_SPANS, SPANS

LAST = np.iinfo(np.int64).max


class Bits:
    """A packed bit row with rank."""

    def __init__(self, row: np.ndarray):
        padded = np.zeros(-(-(len(row) + 1) // 64) * 64, dtype=np.uint8)
        padded[: len(row)] = row
        self.packed = np.packbits(padded, bitorder="little").view("<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.packed).astype(np.int64))])
        self.zeros = len(row) - int(self.before[-1])

    def ones(self, at: np.ndarray) -> np.ndarray:
        """Set bits before each place."""
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.packed[word] & mask)


class FmIndex:
    """Index of rows of symbols (1 and up; 0 ends a row), good for patterns of up to ``depth`` symbols."""

    def __init__(self, text: np.ndarray, depth: int):
        self.depth = depth
        self.rank = self._order(text, depth)
        self.suffixes = np.argsort(self.rank, kind="stable")
        transform = text[self.suffixes - 1]
        count = int(text.max()) + 1
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=count))])
        self.levels: list[Bits] = []
        row = transform
        for level in range(max(1, (count - 1).bit_length()) - 1, -1, -1):
            bit = (row >> level & 1).astype(bool)
            self.levels.append(Bits(bit))
            row = np.concatenate([row[~bit], row[bit]])
        self.origin = self._descend(np.arange(count), np.zeros(count, np.int64))

    @staticmethod
    def _order(text: np.ndarray, depth: int) -> np.ndarray:
        """Rank of each suffix by its first ``depth`` symbols, by doubling."""
        rank, known = text.astype(np.int64), 1
        while known < depth:
            step = min(known, depth - known)
            ahead = np.concatenate([rank[step:] + 1, np.zeros(step, np.int64)])
            both = rank * (int(ahead.max()) + 1) + ahead
            _, rank = np.unique(both, return_inverse=True)
            known += step
        return rank

    def _descend(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        top = len(self.levels) - 1
        for i, level in enumerate(self.levels):
            ones = level.ones(at)
            at = np.where(symbols >> (top - i) & 1, level.zeros + ones, at - ones)
        return at

    def extend(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """One backward step of interval ends: where ``symbol`` + suffix stands for each suffix before ``at``."""
        return self.first[symbols] + self._descend(symbols, at) - self.origin[symbols]

    def matching(self, text: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(matched, low): how many symbols up to each end also occur elsewhere (at most ``depth``), and
        the lower end of the interval where all match."""
        matched, low = np.zeros(len(ends), np.int64), np.full(len(ends), -1)
        left = np.arange(len(ends))
        lo, hi = np.zeros(len(ends), np.int64), np.full(len(ends), len(text))
        for step in range(self.depth):
            symbols = text[ends[left] - step]
            lo, hi = self.extend(symbols, lo), self.extend(symbols, hi)
            found = hi - lo > 1
            left, lo, hi = left[found], lo[found], hi[found]
            matched[left] = step + 1
        low[left] = lo
        return matched, low


class WordWindows(repeats.Method):
    def attributes(self, run_doc, ids):
        return np.array([LAST if i is None else i for i in ids], np.int64)[run_doc] if len(run_doc) else np.zeros(0, np.int64)

    def merge(self, numbers, groups, count):
        out = np.full(count, LAST)
        np.minimum.at(out, groups, numbers)
        return out

    def wanted(self, keys, first):
        return np.ones(len(keys), bool)

    def resolve(self, classes):
        """Per class its smallest document, and (class, window, document) where a window starts in a smaller one."""
        n = classes.n
        if not len(n):
            return classes.number, np.zeros((0, 3), np.int64)
        lengths = n + self.window - 1
        begins = np.concatenate([[0], np.cumsum(lengths + 1)])[:-1]
        row = np.repeat(np.arange(len(n)), lengths)
        place = np.arange(len(row)) + row
        text = np.zeros(len(row) + len(n), np.int64)
        text[place] = np.unique(classes.units, return_inverse=True)[1] + 1
        index = FmIndex(text, self.window)
        window_row = np.repeat(np.arange(len(n)), n)
        inside = np.arange(len(window_row)) - np.repeat(np.concatenate([[0], np.cumsum(n)])[:-1], n)
        starts = begins[window_row] + inside
        matched, low = index.matching(text, starts + self.window - 1)
        # Smallest document of every group of suffixes that agree through the threshold.
        owner = np.repeat(np.arange(len(n)), lengths + 1)
        ranks = index.rank[index.suffixes]
        heads = np.flatnonzero(np.concatenate([[True], ranks[1:] != ranks[:-1]]))
        least = np.minimum.reduceat(classes.number[classes.wanted[owner[index.suffixes]]], heads)
        hit = np.flatnonzero(matched == self.window)
        smallest = least[np.searchsorted(heads, low[hit], "right") - 1]
        own = classes.wanted[window_row[hit]]
        better = smallest < classes.number[own]
        return classes.number, np.column_stack([own[better], inside[hit][better], smallest[better]])

    def finish(self, ids, texts, units, numbers, extra):
        own = np.array([LAST if i is None else i for i in ids], np.int64)
        whole = numbers < own[units.doc] if len(units.doc) else np.zeros(0, bool)
        single = extra[extra[:, 2] < own[units.doc[extra[:, 0]]]]
        doc = np.concatenate([units.doc[whole], units.doc[single[:, 0]]])
        start = np.concatenate([units.first[whole], units.first[single[:, 0]] + single[:, 1]])
        n = np.concatenate([units.n[whole], np.ones(len(single), np.int64)])
        spans = repeats.covered(len(texts), doc, start, start + n - 1 + self.window)
        counts, kept = [], []
        for text, cut in zip(texts, spans):
            ws = text.split()
            edges = [0, *(e for span in cut for e in span), len(ws)]
            counts.append(len(ws))
            kept.append(b" ".join(w for a, b in zip(edges[::2], edges[1::2]) for w in ws[a:b]))
        return [ids, counts, [[{"start": a, "end": b} for a, b in s] for s in spans], kept]


def dedup(docs: DataFrame, size: int = 13, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, spans of words, kept binary): words that an earlier document has, and the text left."""
    method = WordWindows(
        window=size, gram=max(1, size * 5 // 13), words=True, by_document=True,
        schema=f"id long, n_words long, spans {SPANS}, kept binary",
        types=[("id", pa.int64()), ("n_words", pa.int64()), ("spans", ARROW_SPANS), ("kept", pa.binary())],
    )
    return repeats.find(docs, method, id_col, text_col)


def op10(spark, sf_dir: str) -> DataFrame:
    found = dedup(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["start"])
    return found.select(
        F.col("id").alias("doc_id"), "n_words", removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256")
    )


OP10_SQL = r"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
grams AS (
  SELECT r, doc_id, i, md5(array_to_string(ws[i:i + 12], ' ')) AS g
  FROM (SELECT r, doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM docs WHERE len(ws) >= 13)),
firsts AS (SELECT g, min(doc_id) AS least FROM grams GROUP BY g),
hits AS (SELECT r, i FROM grams JOIN firsts USING (g) WHERE least < doc_id),
gone AS (SELECT DISTINCT r, unnest(range(i, i + 13)) AS w FROM hits),
each AS (SELECT r, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS w FROM docs),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY w) AS t FROM each ANTI JOIN gone USING (r, w) GROUP BY r),
cut AS (SELECT r, count(*) AS n FROM gone GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (r) LEFT JOIN cut USING (r)
"""
