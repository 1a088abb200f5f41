"""Language identification by nearest centroid over TF-IDF vectors of byte n-grams.

Letters are lowered and everything else becomes a blank; byte 1- to 3-grams of what is left are
hashed into ``DIMS`` counters, damped (1 + log), weighted by inverse document frequency and scaled to
length one. Each language of the learning sample gets several centroids by spherical k-means; a text
takes the language of the centroid with the highest cosine. Texts farther from every centroid than
the texts of the sample ever are, by their length, are rejected.

The sample is bounded: at most ``per_language`` documents per language, chosen by hash. All other
work covers every document. Defined cases: a null text or one without a letter is ``und`` with score
0 and rejected; rows with null language are not learned from; with nothing learned all is ``und``.
"""

from __future__ import annotations

import re
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import map_rows, once, rewrite_rows, table

DIMS = 1 << 12
PER_LANGUAGE = 1500
CENTROIDS = 4
UND = "und"
_BYTES = bytes(c if 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))
_ASCII = re.compile(r"[A-Za-z]")
#: Upper ends of the length bands (letters' bytes) for which the distance limit is learned apart.
BANDS = np.array([64, 256, 1024])


def has_letter(text: str | None) -> bool:
    return bool(text) and (bool(_ASCII.search(text)) or (not text.isascii() and any(c.isalpha() for c in text)))


def counts(text: str) -> tuple[np.ndarray, int]:
    """Counters of the hashed n-grams of a whole text, and its bytes of letters."""
    words = text.lower().encode("utf-8", "replace").translate(_BYTES).split()
    raw = np.frombuffer(b" " + b" ".join(words) + b" ", dtype=np.uint8).astype(np.uint32)
    out = np.bincount(raw, minlength=DIMS)[:DIMS].astype(np.float32)
    two = raw[:-1] * np.uint32(257) + raw[1:]
    for grams in (two, two[:-1] * np.uint32(257) + raw[2:]):
        hashed = (grams * np.uint32(2654435761)) >> np.uint32(20)
        out += np.bincount(hashed, minlength=DIMS)[:DIMS]
    return out, len(raw) - 2


def vectors(texts: list[str], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    rows = [counts(t) for t in texts]
    out = np.stack([r for r, _ in rows])
    np.log1p(out, out=out)
    out *= idf
    out /= np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)
    return out, np.searchsorted(BANDS, [n for _, n in rows])


def spherical_kmeans(rows: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Up to ``k`` unit centroids; starts from far-apart rows, so the result depends on the rows alone."""
    centre = rows.mean(axis=0)
    picked = [int(np.argmax(rows @ centre))]
    near = rows @ rows[picked[0]]
    while len(picked) < min(k, len(rows)):
        picked.append(int(np.argmin(near)))
        near = np.maximum(near, rows @ rows[picked[-1]])
    centroids = rows[picked]
    for _ in range(rounds):
        own = np.argmax(rows @ centroids.T, axis=1)
        sums = np.stack([rows[own == j].sum(axis=0) if (own == j).any() else centroids[j] for j in range(len(centroids))])
        centroids = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return centroids.astype(np.float32)


def sample(labelled: DataFrame, per_language: int) -> DataFrame:
    """(lang, text): at most ``per_language`` rows of each language, lowest hash of the text first.

    A first cut by hash keeps about that many rows per language, so that the ranking sees few rows.
    """
    totals = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not totals:
        return labelled.select("lang", "text")
    share = F.create_map(*(x for lang, n in totals.items() for x in (F.lit(lang), F.lit(min(1.0, 1.5 * per_language / n)))))
    spot = F.pmod(F.xxhash64("text"), F.lit(1_000_003)) / F.lit(1_000_003.0)
    cut = labelled.where(spot < share[F.col("lang")]).withColumn("spot", F.xxhash64("text"))
    best = Window.partitionBy("lang").orderBy("spot", "text")
    return cut.withColumn("at", F.row_number().over(best)).where(F.col("at") <= per_language).select("lang", "text")


def learn(labelled: DataFrame, per_language: int = PER_LANGUAGE, centroids: int = CENTROIDS) -> dict | None:
    """The model: idf, languages and centroids, lowest cosine per length band. None if nothing can be learned.

    ``labelled`` has (lang, text). What comes to the driver is one vector per task of the sample and
    a few centroids per language.
    """
    rows = sample(labelled.where("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text"), per_language)

    def frequencies(batches):
        seen, total = np.zeros(DIMS, dtype=np.int64), 0
        for batch in batches:
            for text in batch.column(1).to_pylist():
                if has_letter(text):
                    seen += counts(text)[0] > 0
                    total += 1
        if total:
            yield pa.RecordBatch.from_arrays([pa.array([total]), pa.array([seen.tolist()])], names=["total", "seen"])

    parts = rows.mapInArrow(frequencies, "total long, seen array<long>").collect()
    if not parts:
        return None
    total = sum(p["total"] for p in parts)
    seen = np.sum([p["seen"] for p in parts], axis=0)
    idf = (np.log((1 + total) / (1 + seen)) + 1).astype(np.float32)

    def cluster(group: pa.Table) -> pa.Table:
        texts = sorted(t for t in group.column("text").to_pylist() if has_letter(t))
        lang = group.column("lang")[0].as_py()
        if not texts:
            return pa.table({"lang": [], "centre": [], "lows": []}, schema=pa.schema(
                [("lang", pa.string()), ("centre", pa.binary()), ("lows", pa.binary())]))
        found, bands = vectors(texts, idf)
        centres = spherical_kmeans(found, centroids)
        best = (found @ centres.T).max(axis=1)
        lows = np.array([best[bands == b].min() if (bands == b).any() else np.nan for b in range(len(BANDS) + 1)], np.float32)
        return pa.table({"lang": [lang] * len(centres), "centre": [c.tobytes() for c in centres],
                         "lows": [lows.tobytes()] * len(centres)})

    learned = rows.groupBy("lang").applyInArrow(cluster, "lang string, centre binary, lows binary").collect()
    if not learned:
        return None
    learned = sorted(learned, key=lambda r: (r["lang"], bytes(r["centre"])))
    lows = np.stack([np.frombuffer(r["lows"], np.float32) for r in learned])
    with np.errstate(all="ignore"):
        floor = np.where(np.isnan(lows).all(axis=0), np.nan, np.nanmin(np.where(np.isnan(lows), np.inf, lows), axis=0))
    # Shorter texts lie farther off: a band without examples takes the lowest limit there is.
    floor = np.where(np.isnan(floor), np.nanmin(floor), floor)
    return {
        "idf": idf,
        "langs": [r["lang"] for r in learned],
        "centres": np.stack([np.frombuffer(r["centre"], np.float32) for r in learned]),
        "floor": floor / 2,
    }


def classify(model: dict | None, texts: list[str | None]) -> tuple[list[str], list[float], list[bool]]:
    """Language, cosine (0 to 1) and whether the distance is accepted."""
    langs, scores, accepted = [UND] * len(texts), [0.0] * len(texts), [False] * len(texts)
    at = [i for i, t in enumerate(texts) if has_letter(t)] if model else []
    for first in range(0, len(at), 256):
        part = at[first : first + 256]
        found, bands = vectors([texts[i] for i in part], model["idf"])
        cosines = found @ model["centres"].T
        best = np.argmax(cosines, axis=1)
        top = np.clip(cosines[np.arange(len(part)), best].astype(float), 0.0, 1.0)
        for i, b, s, fine in zip(part, best.tolist(), top.tolist(), (top >= model["floor"][bands]).tolist()):
            langs[i], scores[i], accepted[i] = model["langs"][b], s, fine
    return langs, scores, accepted


def predict(docs: DataFrame, model: dict | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score, accepted) per row; only the text enters a prediction."""
    held, key = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex
    kind = docs.schema[id_col].dataType.simpleString()
    return map_rows(
        docs.select(id_col, text_col),
        lambda ids, texts: [ids, *classify(once(key, lambda: held.value), texts)],
        f"id {kind}, lang_pred string, score double, accepted boolean",
    )


def keep_known(docs: DataFrame, model: dict | None, text_col: str = "text") -> DataFrame:
    """``docs`` without the documents that are ``und`` or rejected by their distance; columns unchanged."""
    held, key = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex
    return rewrite_rows(docs, text_col, lambda texts: (texts, classify(once(key, lambda: held.value), texts)[2]))


def held_out(id_col: str = "doc_id") -> Column:
    """Rows kept from learning: crc32 of the id as text divisible by 5. A null id counts as kept."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(5)) == 0, F.lit(True))


def learn_from(docs: DataFrame) -> dict | None:
    return learn(docs.where(~held_out()).select("lang", "text"))


def op7(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = predict(docs, learn_from(docs))
    return found.select(F.col("id").alias("doc_id"), held_out("id").alias("held_out"), "lang_pred", "score", "accepted")
