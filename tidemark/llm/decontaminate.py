"""Benchmark decontamination: broadcast hash sets of test n-grams against training token windows.

Words are runs of ASCII letters and digits (A-Z lowered) or non-ASCII characters. Every window of
``size`` consecutive words of a test item is a rule; an item of fewer words is one window. The
windows are cut into shards of at most ``shard_windows`` entries. One shard is broadcast at a time and
the documents pass through it in a narrow map; what they hit so far is written before the next shard
is broadcast and the last one dropped, so a larger test set means more passes and never a larger
broadcast or more than one scanner in a worker, and no document is shuffled. Hash hits are verified
word by word.

Defined cases: a null or wordless text has no words and no hits; null or repeated items and repeated
windows count once per item_id; an empty table on either side gives no hits; very long texts are read whole;
columns are taken by position, so others may have any name; a null item_id never enters ``items`` but its windows do hit.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections import defaultdict

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import as_bytes, map_rows, materialise, once, rewrite_rows, table

#: Lower-cases A-Z, keeps digits and non-ASCII bytes, turns the rest into blanks.
FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
SHARD_WINDOWS = 500_000
SPANS = "array<struct<first:int,words:int>>"
_MIX = np.uint64(0x9E3779B97F4A7C15)
_WIDTH = 1 << 20


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(FOLD).split() if text else []


def windows(items: DataFrame, size: int, id_col: str, text_col: str) -> DataFrame:
    """Distinct (window, item): the window as its words joined by blanks."""

    def cut(ids, texts):
        out_w, out_i = [], []
        for item, text in zip(ids, texts):
            ws = words_of(text)
            for w in {b" ".join(ws[i : i + size]) for i in range(max(1, len(ws) - size + 1))} if ws else ():
                out_w.append(w)
                out_i.append(item)
        return [out_w, out_i]

    rows = items.select(F.col(id_col).cast("string"), as_bytes(text_col))
    return map_rows(rows, cut, "gram binary, item string").distinct()


def shards(spark, grams: DataFrame, shard_windows: int):
    """Broadcast variables, each a map from window to its items with at most ``shard_windows`` entries."""
    grams = materialise(grams, "windows")  # cut from the items once, however many shards there are
    count = grams.count()
    parts = max(1, -(-count // shard_windows))
    # Hash parts are uneven by a few per cent; a quarter of slack keeps each below the bound.
    parts = parts if parts == 1 else -(-count * 5 // (shard_windows * 4))
    placed = grams.withColumn("part", F.pmod(F.xxhash64("gram", "item"), F.lit(parts)))
    for part in range(parts):
        held = defaultdict(list)
        for row in placed.where(F.col("part") == part).select("gram", "item").toLocalIterator():
            if row["item"] is None:
                held[bytes(row["gram"])] += []
            else:
                held[bytes(row["gram"])].append(row["item"])
        yield spark.sparkContext.broadcast(dict(held))


class Scanner:
    """Finds the windows of one shard in texts; built once per task from the broadcast map."""

    def __init__(self, held: dict[bytes, list]):
        self.held = held
        vocabulary = {w for gram in held for w in gram.split(b" ")}
        self.ids = {w: i + 1 for i, w in enumerate(sorted(vocabulary))}
        by_length = defaultdict(list)
        for gram in held:
            ids = np.array([self.ids[w] for w in gram.split(b" ")], dtype=np.uint64)
            by_length[len(ids)].append(self.roll(ids, len(ids))[0])
        self.tables = {}
        for length, values in by_length.items():
            sieve = np.zeros(_WIDTH, dtype=bool)
            values = np.unique(np.array(values, dtype=np.uint64))
            sieve[(values >> np.uint64(44)).astype(np.int64)] = True
            self.tables[length] = (values, sieve)

    @staticmethod
    def roll(ids: np.ndarray, length: int) -> np.ndarray:
        last = len(ids) - length + 1
        out = np.zeros(last, dtype=np.uint64)
        for j in range(length):
            out = (out ^ ids[j : j + last]) * _MIX
            out ^= out >> np.uint64(31)
        return out * _MIX

    def hits(self, texts: list[list[bytes]]) -> list[list[tuple[int, int, bytes]]]:
        """Per text the verified (first word, words, window)."""
        lengths = [len(ws) for ws in texts]
        get = self.ids.get
        ids = np.fromiter((get(w, 0) for ws in texts for w in ws), dtype=np.uint64, count=sum(lengths))
        owner = np.repeat(np.arange(len(texts)), lengths)
        begins = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
        found: list[list[tuple[int, int, bytes]]] = [[] for _ in texts]
        for length, (values, sieve) in self.tables.items():
            if len(ids) < length:
                continue
            rolled = self.roll(ids, length)
            at = np.flatnonzero(sieve[(rolled >> np.uint64(44)).astype(np.int64)])
            at = at[values[np.minimum(np.searchsorted(values, rolled[at]), len(values) - 1)] == rolled[at]]
            at = at[owner[at] == owner[at + length - 1]]
            for i in at.tolist():
                doc = int(owner[i])
                first = int(i - begins[doc])
                gram = b" ".join(texts[doc][first : first + length])
                if gram in self.held:
                    found[doc].append((first, length, gram))
        return found


def scan(
    docs: DataFrame, items: DataFrame, size: int = 10, id_col: str = "doc_id", text_col: str = "text",
    item_id: str = "item_id", item_text: str = "text", shard_windows: int = SHARD_WINDOWS,
) -> DataFrame:
    """(id, n_words, spans array<struct<first,words>>, items array<string>): windows found per document.

    ``spans`` are word ranges in order of the first word; ``items`` are distinct, in string order.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, text binary, n_words long, spans {SPANS}, items array<string>"
    out = docs.select(F.col(id_col).alias("id"), as_bytes(text_col).alias("text"), F.lit(0).cast("long"),
                      F.array().cast(SPANS), F.array().cast("array<string>"))
    last = None
    for shard in shards(spark, windows(items, size, item_id, item_text), shard_windows):
        if last is not None:
            out = materialise(out, "scanned")
            last.unpersist()
        last = shard

        def pass_through(ids, texts, _, spans, names, shard=shard, key=uuid.uuid4().hex):
            scanner = once(key, lambda: Scanner(shard.value), most=1)
            split = [words_of(t) for t in texts]
            for doc, found in enumerate(scanner.hits(split)):
                if found:
                    spans[doc] = joined(spans[doc], found)
                    names[doc] = sorted({*names[doc], *(i for _, _, g in found for i in scanner.held[g])})
            return [ids, texts, [len(ws) for ws in split], spans, names]

        out = map_rows(out, pass_through, schema)
    return out


def joined(spans: list, found: list) -> list:
    both = {(s["first"], s["words"]) for s in spans} | {(first, n) for first, n, _ in found}
    return [{"first": first, "words": n} for first, n in sorted(both)]


def covered(spans: list) -> int:
    """Words inside any span; spans come in order of their first word."""
    total, end = 0, 0
    for span in spans:
        first, after = span["first"], span["first"] + span["words"]
        total += max(0, after - max(first, end))
        end = max(end, after)
    return total


def without_spans(text: bytes, spans: list) -> bytes:
    """``text`` without its covered words and what stands between two covered neighbours."""
    places = [m.span() for m in WORD.finditer(text)]
    out, end = [], 0
    for span in spans:
        first, last = places[span["first"]][0], places[span["first"] + span["words"] - 1][1]
        if first > end:
            out.append(text[end:first])
        end = max(end, last)
    return b"".join(out) + text[end:]


def clean(
    docs: DataFrame, items: DataFrame, size: int = 10, remove: str = "spans", text_col: str = "text", **options
) -> DataFrame:
    """``docs`` with its own columns: hit spans cut out of the text, or hit documents left out.

    Nulls stay null. ``remove`` is "spans" or "documents".
    """
    grams = windows(items, size, options.pop("item_id", "item_id"), options.pop("item_text", "text"))
    spans_col = f"spans_{uuid.uuid4().hex}"
    work = docs.withColumn(spans_col, F.array().cast(SPANS))

    def finder(shard):
        key = uuid.uuid4().hex

        def find(spans, texts):
            scanner = once(key, lambda: Scanner(shard.value), most=1)
            split = [words_of(t.encode()) if t else [] for t in texts]
            return [joined(s, f) for s, f in zip(spans, scanner.hits(split))]

        return find

    last = held = None
    for shard in shards(docs.sparkSession, grams, options.pop("shard_windows", SHARD_WINDOWS)):
        if last is not None:
            work = rewrite_rows(work, spans_col, lambda s, t, find=last: (find(s, t), [True] * len(t)), (spans_col, text_col))
            work = materialise(work, "scanned")
            held.unpersist()
        last, held = finder(shard), shard

    def cut(texts, spans):
        spans = last(spans, texts)
        if remove == "documents":
            return texts, [not s for s in spans]
        return [without_spans(t.encode(), s).decode() if s else t for t, s in zip(texts, spans)], [True] * len(texts)

    return rewrite_rows(work, text_col, cut, (text_col, spans_col)).drop(spans_col)


def op3(spark, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))

    def digest(ids, n_words, spans, items):
        n_hit = [covered(s) for s in spans]
        shas = [hashlib.sha256(",".join(i).encode()).hexdigest() for i in items]
        return [ids, n_words, n_hit, [len(i) for i in items], shas, [n > 0 for n in n_hit]]

    return map_rows(
        found.select("id", "n_words", "spans", "items"), digest,
        "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean",
    )


OP3_SQL = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
grams AS (
  SELECT DISTINCT item_id, least(len(ws), 10) AS n, array_to_string(ws[i:i + least(len(ws), 10) - 1], ' ') AS gram
  FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS i FROM items WHERE len(ws) > 0)),
sizes AS (SELECT DISTINCT n FROM grams),
places AS (
  SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM docs, sizes WHERE len(ws) >= n),
hits AS (
  SELECT p.doc_id, p.i, p.n, g.item_id
  FROM (SELECT doc_id, i, n, array_to_string(ws[i:i + n - 1], ' ') AS gram FROM places) p JOIN grams g USING (n, gram)),
hit_words AS (SELECT doc_id, count(*) AS n_hit FROM (
  SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS w FROM hits) GROUP BY doc_id),
hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""
