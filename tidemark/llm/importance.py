"""Target-distribution importance resampling over hashed word n-grams.

A 256-byte table lower-cases A-Z and blanks every ASCII byte that is no letter or digit, directly in
UTF-8; ``bytes.split`` yields the words. The bucket of an n-gram is its crc32 modulo the number of
buckets, extended word by word by passing the checksum of the shorter n-gram on as the seed. Counters
reduce words within a task and a shuffle adds up one row per task and bucket. A document's weight is the sum of
its features' log ratios between target and corpus, and documents are drawn without replacement by
Gumbel noise that depends on the seed and the doc_id alone.

The corpus is read twice, for the counts and for the weights; only the weights (a few numbers per
document) are ranked, by one range shuffle. The driver holds two counters per bucket.

Defined cases: a null or wordless text has no features and weight 0; with an empty corpus or target the
counts of that side are 0; a null doc_id takes the noise of the empty text and is ranked last among
equal scores; repeated rows are documents of their own, each counted and ranked; very long texts are
read whole; columns are selected first, so other columns may have any name.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import as_bytes, map_rows, materialise, once, plain, table
from tidemark.operators.paging import numbered

#: Lower-cases A-Z, keeps digits and non-ASCII bytes, turns the rest into blanks.
WORDS = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
#: Distinct words a task counts before it turns them into buckets.
HELD_WORDS = 200_000


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORDS).split()


def extend(seeds: list[int], words: list[bytes], size: int) -> list[int]:
    """Checksums of all runs of ``size`` words from those of ``size - 1`` words."""
    return [crc32(b" " + w, s) for s, w in zip(seeds, words[size - 1 :])]


def bucket_counts(docs: DataFrame, text_col: str, most: int, buckets: int) -> np.ndarray:
    """Number of features per bucket over all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        held: Counter[bytes] = Counter()

        def spill() -> None:
            at = np.fromiter(map(crc32, held), dtype=np.int64, count=len(held)) % buckets
            np.add.at(total, at, np.fromiter(held.values(), dtype=np.int64, count=len(held)))
            held.clear()

        for batch in batches:
            for text in batch.column(0):
                words = words_of(text.as_py())
                held.update(words)
                if len(held) > HELD_WORDS:
                    spill()
                seeds = list(map(crc32, words)) if most > 1 else []
                for size in range(2, most + 1):
                    seeds = extend(seeds, words, size)
                    total += np.bincount(np.array(seeds, dtype=np.int64) % buckets, minlength=buckets)
        spill()
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    rows = docs.select(as_bytes(text_col)).mapInArrow(count, "bucket long, n long")
    out = np.zeros(buckets, dtype=np.int64)
    for row in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # one row per bucket at most
        out[row["bucket"]] = row["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the smoothed log ratio per bucket, rounded down."""
    buckets, s_all, t_all = len(corpus), float(corpus.sum()), float(target.sum())
    return np.array(
        [
            math.floor(1000 * math.log((t + 1.0) * (s_all + buckets) / ((s + 1.0) * (t_all + buckets))))
            for s, t in zip(corpus.tolist(), target.tolist())
        ],
        dtype=np.int64,
    )


def noise(seed: int, doc_id: object) -> int:
    """Thousandths of a Gumbel variate fixed by the seed and the id, rounded down."""
    text = f"{seed}:{'' if doc_id is None else doc_id}"
    h = int(hashlib.sha256(text.encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weigh(
    docs: DataFrame, gain: np.ndarray, most: int, seed: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, n_words, n_features, weight, score) per document."""
    held, key, buckets = docs.sparkSession.sparkContext.broadcast(gain), uuid.uuid4().hex, len(gain)
    kind = docs.schema[id_col].dataType.simpleString()

    def score(ids, texts):
        gain = once(key, lambda: held.value)
        n_words, n_features, weights = [], [], []
        for text in texts:
            words = words_of(text)
            seeds = list(map(crc32, words))
            features, weight = 0, 0
            for size in range(1, most + 1):
                seeds = extend(seeds, words, size) if size > 1 else seeds
                features += len(seeds)
                weight += int(gain[np.array(seeds, dtype=np.int64) % buckets].sum())
            n_words.append(len(words))
            n_features.append(features)
            weights.append(weight)
        return [ids, n_words, n_features, weights, [w + noise(seed, i) for i, w in zip(ids, weights)]]

    schema = f"id {kind}, n_words long, n_features long, weight long, score long"
    return map_rows(plain(docs.select(id_col, as_bytes(text_col))), score, schema)


def resample(
    docs: DataFrame, target: DataFrame, most: int = 1, buckets: int = 10_000, percent: int = 10,
    least_words: int = 20, seed: int = 2024, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text",
) -> DataFrame:
    """(id, n_words, n_features, weight, score, rank) per document; ``rank`` is null for those not drawn."""
    gain = gains(bucket_counts(docs, text_col, most, buckets), bucket_counts(target, target_text, most, buckets))
    scored = materialise(weigh(docs, gain, most, seed, id_col, text_col), "weights")
    able = F.col("n_words") >= least_words
    draw = percent * scored.where(able).count() // 100
    # Ids and scores decide; equal pairs are repeated rows, told apart by their weight alone or not at all.
    order = [F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("weight").asc(), F.col("n_features").asc()]
    ranked = numbered(scored.where(able), order, "rank", evaluated=True)
    drawn = F.when(F.col("rank") < draw, F.col("rank") + 1).cast("long").alias("rank")
    rest = scored.where(~able).withColumn("rank", F.lit(None).cast("long"))
    return ranked.withColumn("rank", drawn).unionByName(rest)


def op12(spark, sf_dir: str) -> DataFrame:
    found = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")


OP12_SQL = r"""
WITH crc_table AS (
  SELECT list(c ORDER BY b) AS crcs FROM (
    SELECT b, list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, x:
      CASE WHEN a & 1 = 1 THEN xor(3988292384, a >> 1) ELSE a >> 1 END) AS c
    FROM (SELECT CAST(unnest(range(256)) AS BIGINT) AS b))),
folded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
goal AS (
  SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark),
uses AS (SELECT doc_id, w, count(*) AS n FROM (SELECT doc_id, unnest(ws) AS w FROM folded) GROUP BY doc_id, w),
vocabulary AS (SELECT w FROM uses UNION SELECT w FROM goal),
octets AS (
  SELECT w, list_transform(range(1, CAST(len(hex(encode(w))) / 2 AS BIGINT) + 1),
    lambda i: CAST('0x' || substr(hex(encode(w)), CAST(2 * i - 1 AS BIGINT), 2) AS BIGINT)) AS bs FROM vocabulary),
hashed AS (
  SELECT w, xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), bs), lambda a, x:
    xor(a >> 8, crcs[(xor(a, x) & 255) + 1]))) % 10000 AS bucket
  FROM octets, crc_table),
corpus AS (SELECT bucket, sum(n) AS s FROM uses JOIN hashed USING (w) GROUP BY bucket),
target AS (SELECT bucket, count(*) AS t FROM goal JOIN hashed USING (w) GROUP BY bucket),
totals AS (SELECT (SELECT coalesce(sum(s), 0) FROM corpus) AS s_all, (SELECT coalesce(sum(t), 0) FROM target) AS t_all),
gain AS (
  SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (s_all + 10000)::DOUBLE
    / ((s + 1)::DOUBLE * (t_all + 10000)::DOUBLE))) AS g
  FROM corpus LEFT JOIN target USING (bucket), totals),
weights AS (SELECT doc_id, sum(n * g) AS weight FROM uses JOIN hashed USING (w) JOIN gain USING (bucket) GROUP BY doc_id),
scored AS (
  SELECT f.doc_id, len(ws) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
    CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || f.doc_id), 1, 8) AS BIGINT)
      + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM folded f LEFT JOIN weights USING (doc_id)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place,
    count(*) FILTER (n_features >= 20) OVER () AS able FROM scored)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, weight, score,
  CASE WHEN n_features >= 20 AND place <= 10 * able // 100 THEN place END AS rank
FROM ranked
"""
