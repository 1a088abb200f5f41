"""SimHash near-duplicates found through pivot distance tables.

Every distinct fingerprint gets a row of Hamming distances to ``PIVOTS`` reference fingerprints, kept
as partial distances over ``blocks`` parts of the 64 bits. Two fingerprints with at most ``bits``
differing bits agree fully on at least ``blocks - bits`` parts, and there all their partial distances
are equal. So each choice of that many parts is one table, keyed by its partial distances, and every
link meets under some key. Pairs under a key are discarded if any of their whole distances to a
reference differ by more than ``bits`` (triangle inequality); survivors are verified bit by bit.

The number of parts follows the number of distinct fingerprints, which keeps buckets small at any
size; all choices are exact. Copies fall together before the search. Buckets over ``CHUNK`` are
cut into pairs of chunks, and a group of near copies yields a spanning forest, never all its pairs.

Defined cases: null and wordless texts have fingerprint zero and link like any other; a null id takes
no part in the smallest id; a component without any id has component null. Repeated rows share a fingerprint;
very long texts are read whole, with one word list at a time; an empty table gives no rows; other columns pass by.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import as_bytes, map_rows, materialise, table
from tidemark.llm.components import components

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
PIVOTS = np.random.default_rng(20).integers(0, 2**64, 16, dtype=np.uint64)
WEIGHTS = np.random.default_rng(21).integers(0, 2**64, 16, dtype=np.uint64) | np.uint64(1)
CHUNK = 2048
BUCKET = 64
SEED = 42
SALTS = 32


def fingerprint(text: bytes, words: int) -> int:
    """Majority bits of the hashed shingles of a whole text, as a signed 64-bit number."""
    ws = text.translate(LOWER).split()
    if not ws:
        return 0
    joined = b" ".join(ws)
    ends = np.cumsum([len(w) + 1 for w in ws])
    starts = np.concatenate([[0], ends[:-1]])
    size = min(words, len(ws))
    spans = zip(starts[: len(ws) - size + 1].tolist(), (ends[size - 1 :] - 1).tolist())
    digest = xxhash.xxh64_intdigest
    hashed = np.array([digest(joined[a:b], SEED) for a, b in spans], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashed), 1 << 14):
        part = hashed[at : at + (1 << 14)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashed), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, words: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    kind = docs.schema[id_col].dataType.simpleString()
    return map_rows(
        docs.select(id_col, as_bytes(text_col)), lambda ids, texts: [ids, [fingerprint(t, words) for t in texts]],
        f"id {kind}, fp long",
    )


def masks(blocks: int) -> list[np.uint64]:
    edges = [64 * i // blocks for i in range(blocks + 1)]
    return [np.uint64(((1 << (b - a)) - 1) << a) for a, b in zip(edges, edges[1:])]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def blocks_for(count: int, bits: int) -> int:
    """Fewest parts whose keys leave about ``BUCKET`` unrelated fingerprints in a bucket."""
    blocks = bits + 1
    while blocks < 64 and count / 2.0 ** (64 * (blocks - bits) / blocks) > BUCKET and math.comb(blocks + 1, bits) <= 500:
        blocks += 1
    return blocks


def pivot_table(fps: DataFrame, blocks: int, bits: int) -> DataFrame:
    """(key, fp, pivots binary): one row for each table; ``pivots`` are the whole distances."""
    parts = masks(blocks)
    choices = list(combinations(range(blocks), blocks - bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            partial = [np.bitwise_count((x[:, None] ^ PIVOTS) & m) for m in parts]
            whole = pa.array([row.tobytes() for row in np.sum(partial, axis=0, dtype=np.uint8)], pa.binary())
            hashed = [mixed((p.astype(np.uint64) * WEIGHTS).sum(axis=1, dtype=np.uint64)) for p in partial]
            for number, choice in enumerate(choices):
                key = np.full(len(x), number, dtype=np.uint64)
                for b in choice:
                    key = mixed(key * np.uint64(31) + hashed[b])
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), batch.column(0), whole], names=["key", "fp", "pivots"])

    return fps.select("fp").mapInArrow(run, "key long, fp long, pivots binary")


def tree(linked: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of a boolean adjacency matrix."""
    left = np.ones(len(linked), dtype=bool)
    out = []
    for root in range(len(linked)):
        if not left[root]:
            continue
        left[root] = False
        queue = [root]
        while queue:
            node = queue.pop()
            new = np.flatnonzero(linked[node] & left)
            left[new] = False
            out += [(node, n) for n in new.tolist()]
            queue += new.tolist()
    return out


def links_within(x: np.ndarray, pivots: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """Spanning forest of the links of one bucket."""
    linked = np.zeros((len(x), len(x)), dtype=bool)
    for i in range(len(x) - 1):
        rest = pivots[i + 1 :]
        near = (np.maximum(rest, pivots[i]) - np.minimum(rest, pivots[i])).max(axis=1) <= bits
        at = np.flatnonzero(near) + i + 1
        at = at[np.bitwise_count(x[at] ^ x[i]) <= bits]
        linked[i, at] = linked[at, i] = True
    return tree(linked)


def links(rows: DataFrame, bits: int) -> DataFrame:
    """(u, v) from rows (key, a, b, fp, pivots) that come sorted by (key, a, b) within partitions."""

    def solve(keys, x, pivots):
        """Links of whole buckets: small ones by shifted comparison of all at once, others one by one."""
        starts = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(axis=1)]))
        sizes = np.diff(np.concatenate([starts, [len(x)]]))
        owner = np.repeat(np.arange(len(starts)), sizes)
        us, vs = [], []
        small = sizes[owner] <= 24
        for lag in range(1, 24):
            i = np.flatnonzero(small[:-lag] & (owner[lag:] == owner[:-lag])) if lag < len(x) else np.array([], int)
            if not len(i):
                break
            p, q = pivots[i], pivots[i + lag]
            i = i[(np.maximum(p, q) - np.minimum(p, q)).max(axis=1) <= bits]
            i = i[np.bitwise_count(x[i] ^ x[i + lag]) <= bits]
            us.append(x[i])
            vs.append(x[i + lag])
        for g in np.flatnonzero(sizes > 24):
            own = slice(starts[g], starts[g] + sizes[g])
            found = links_within(x[own], pivots[own], bits)
            if found:
                a, b = np.array(found).T
                us.append(x[own][a])
                vs.append(x[own][b])
        return (np.concatenate(us), np.concatenate(vs)) if us else (x[:0], x[:0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3)], axis=1)
            x = batch.column(3).to_numpy(zero_copy_only=False).view(np.uint64)
            pivots = np.frombuffer(b"".join(batch.column(4).to_pylist()), np.uint8).reshape(len(x), -1)
            if held is not None:
                keys, x, pivots = (np.concatenate(pair) for pair in zip(held, (keys, x, pivots)))
            # The last bucket may go on in the next batch.
            cut = int(np.flatnonzero((keys != keys[-1]).any(axis=1))[-1]) + 1 if (keys != keys[-1]).any() else 0
            held = keys[cut:], x[cut:], pivots[cut:]
            if cut:
                u, v = solve(keys[:cut], x[:cut], pivots[:cut])
                yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"])
        if held is not None:
            u, v = solve(*held)
            yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"])

    return rows.mapInArrow(run, "u long, v long")


def near_links(fps: DataFrame, bits: int) -> DataFrame:
    """Distinct (u, v) that connect all fingerprints of ``fps`` within ``bits`` of one another."""
    keyed = materialise(pivot_table(fps, blocks_for(fps.count(), bits), bits), "pivots")
    sizes = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    chunks = F.ceil(F.col("n") / CHUNK).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    met = keyed.join(sizes, "key").withColumn("chunks", chunks).withColumn("own", own)
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    met = met.select("key", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "fp", "pivots")
    placed = met.repartition("key", "a", "b").sortWithinPartitions("key", "a", "b")
    return links(placed, bits).distinct()


def near_duplicates(
    docs: DataFrame, words: int = 4, bits: int = 4, id_col: str = "doc_id", text_col: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """((id, fp) per document, (fp, root, component)): component is the smallest id of the group."""
    rows = materialise(fingerprints(docs, words, id_col, text_col), "fingerprints")
    distinct = rows.groupBy("fp").agg(F.min("id").alias("least"))
    roots = components(near_links(distinct, bits)).withColumnRenamed("node", "fp")
    # A component may hold most fingerprints: its smallest id meets them in SALTS parts, and only linked ones look for it.
    salt = F.pmod(F.xxhash64("fp"), F.lit(SALTS)).cast("int").alias("salt")
    linked = F.col("root").isNotNull().alias("linked")
    placed = distinct.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"), linked, salt)
    groups = placed.where("linked").groupBy("root").agg(F.min("least").alias("component"))
    groups = groups.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    named = placed.join(groups, ["root", "salt"], "left").withColumn("component", F.coalesce("component", "least"))
    return rows, materialise(named.select("fp", "root", "component"), "groups")


def keep_one(docs: DataFrame, words: int = 4, bits: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each group: the one with the smallest id; columns unchanged.

    Rows are judged by id and fingerprint: a row whose id is repeated goes only if its own group has a smaller
    id. Of rows of one group with the same id one stays. Of a group without any id one row stays.
    """
    rows, groups = near_duplicates(docs, words, bits, id_col, text_col)
    judged = rows.join(groups, "fp").withColumnRenamed("id", "judged_id")
    names = [f"c{i}" for i in range(len(docs.columns))]
    flat = docs.toDF(*names)
    key, text = names[docs.columns.index(id_col)], names[docs.columns.index(text_col)]
    gone = judged.where("judged_id IS NOT NULL AND judged_id != component").select("judged_id").distinct()
    odd = judged.groupBy("judged_id").agg(F.count("*").alias("n")).where("n > 1 OR judged_id IS NULL").select("judged_id")
    if odd.isEmpty():
        return flat.join(gone, F.col(key) == F.col("judged_id"), "left_anti").toDF(*docs.columns)
    # Rows that an id cannot tell apart: few, found again by their text.
    same = F.col(key).eqNullSafe(F.col("judged_id"))
    usual, unusual = flat.join(gone.union(odd), same, "left_anti"), flat.join(odd, same, "left_semi")
    with_fp = map_rows(
        unusual.select(F.struct(*names), as_bytes(text)), lambda whole, texts: [whole, [fingerprint(t, words) for t in texts]],
        f"doc {flat.schema.simpleString()}, fp long",
    ).join(groups, "fp")
    one = with_fp.where(F.col(f"doc.{key}").eqNullSafe(F.col("component"))).dropDuplicates(["root"])
    return usual.unionByName(one.select("doc.*")).toDF(*docs.columns)


def op9(spark, sf_dir: str) -> DataFrame:
    rows, groups = near_duplicates(table(spark, sf_dir, "documents"), words=4, bits=4)
    shown = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return rows.join(groups, "fp").select(F.col("id").alias("doc_id"), shown.alias("fingerprint"), F.col("component").alias("component_id"))
