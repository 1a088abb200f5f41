"""Approximate nearest neighbours by multiprobe p-stable hashing.

A table hashes a vector to a cell of ``hashes`` quantised random projections. A query visits its own
cell of each table and the cells around it in estimated order of success: perturbations are ranked by
the squared distance from its projections to the cell borders. Rows meet queries cell by cell; what
the tables bring is merged and ranked by the exact distance in double precision.

Hashes per table, cell width and probes follow the rows: ``fit`` finds the exact neighbours of ``PILOTS``
vectors among all rows and takes the setting that compares with the fewest rows while it still finds
``TARGET`` of them. The share of rows compared with is judged on a bounded sample (``SAMPLE`` vectors,
lowest hash first), which also gives the spread that widths are multiples of; all rows are indexed. Equal vectors are stored once with their k + 1 smallest ids (no more can ever be among the k nearest). A
cell over ``BLOCK`` rows or queries is cut into blocks that meet block by block. Queries for which the
probes find fewer than k rows are searched again against all rows, in blocks, so none is short.

Defined cases: null, zero or non-finite vectors take no part; vectors of different lengths never
meet; of one id with several vectors the nearest counts; repeated rows count once; ties go to the
smaller id.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import materialise, table

TABLES = 10
#: Settings to choose from; widths are multiples of the spread of one projection in the sample.
HASHES = (6, 8, 12, 16, 24)
WIDTHS = (0.5, 1.0, 1.4, 2.0, 2.8)
PROBES = (10, 30, 100)
#: Share of the pilots' neighbours that a setting has to find; recall on other queries varies around it.
TARGET = 0.96
PILOTS = 128
#: Weight of a probed cell against a row compared with: small, since comparing grows with the rows and probing does not.
PROBE_WEIGHT = 0.2
SAMPLE = 2000
BLOCK = 2048
CELL_ROWS = 8192
_PAIR = "qvec long, vec long, score double"


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, v array<double>) of the vectors that take part."""
    v = F.col("v")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    return rows.where(F.col("id").isNotNull() & v.isNotNull()).where(fine & F.exists(v, lambda x: x != 0))


def distinct_vectors(rows: DataFrame, most: int) -> DataFrame:
    """(vec, v, ids): every vector once, named by its smallest id, with up to ``most`` smallest ids."""
    nearest = Window.partitionBy("v").orderBy("id")
    ranked = rows.distinct().withColumn("at", F.row_number().over(nearest)).where(F.col("at") <= most)
    return ranked.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")).select(
        F.xxhash64("v", F.col("ids")[0]).alias("vec"), "v", "ids"
    )


@dataclass(frozen=True)
class Setting:
    tables: int
    hashes: int
    probes: int
    width: float


class Tables:
    """Random projections of one vector length."""

    def __init__(self, dims: int, spread: float, setting: Setting):
        tables, hashes = setting.tables, setting.hashes
        rng = np.random.default_rng(dims)
        self.tables, self.hashes = tables, hashes
        self.lines = rng.normal(size=(dims, tables * hashes))
        self.width = setting.width * max(spread, 1e-12)
        self.shift = rng.uniform(0, 1, tables * hashes)
        self.salt = rng.integers(0, 2**64, hashes, dtype=np.uint64) | np.uint64(1)

    def places(self, v: np.ndarray) -> np.ndarray:
        return (v @ self.lines / self.width + self.shift).reshape(len(v), self.tables, self.hashes)

    def code(self, cells: np.ndarray, table: int) -> np.ndarray:
        """Cells (..., hashes) to one number each; different cells rarely share one, which only adds candidates."""
        mixed = (cells.astype(np.int64).view(np.uint64) * self.salt).sum(axis=-1, dtype=np.uint64) + np.uint64(table)
        mixed = (mixed ^ (mixed >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        return (mixed ^ (mixed >> np.uint64(31))).view(np.int64)


def perturbations(hashes: int, probes: int) -> list[list[int]]:
    """Sets of positions in the list of 2 * hashes border distances, best first for typical distances.

    Position j is the j-th nearest border; the expected squared distance of a position stands in for the
    measured one, so that one list serves every query. A set may not hold both borders of a projection,
    which is checked per query.
    """
    m = hashes
    score = [j * (j + 1) / (4 * (m + 1) * (m + 2)) if j <= m else 1 - (2 * m + 1 - j) / (m + 1) + (2 * m + 1 - j) * (2 * m + 2 - j) / (4 * (m + 1) * (m + 2)) for j in range(1, 2 * m + 1)]
    heap, out = [(score[0], [0])], [[]]
    while heap and len(out) < 4 * probes:
        cost, chosen = heapq.heappop(heap)
        out.append(chosen)
        last = chosen[-1]
        if last + 1 < 2 * m:
            heapq.heappush(heap, (cost - score[last] + score[last + 1], [*chosen[:-1], last + 1]))
            heapq.heappush(heap, (cost + score[last + 1], [*chosen, last + 1]))
    return out


def probes_of(place: np.ndarray, sets: list[list[int]], probes: int) -> np.ndarray:
    """Cells (n, probes, hashes) that queries at ``place`` (n, hashes) visit, in order; short lists repeat the first."""
    n, m = place.shape
    home = np.floor(place)
    part = place - home
    gaps = np.concatenate([part**2, (1 - part) ** 2], axis=1)
    order = np.argsort(gaps, axis=1, kind="stable")
    dim, step = order % m, np.where(order < m, -1, 1)
    out = np.repeat(home[:, None, :], probes, axis=1)
    filled = np.zeros(n, dtype=np.int64)
    rows = np.arange(n)
    for chosen in sets:
        fine = filled < probes
        if not fine.any():
            break
        moved = home.copy()
        for i, j in enumerate(chosen):
            for other in chosen[:i]:
                fine &= dim[:, other] != dim[:, j]
            moved[rows, dim[:, j]] += step[:, j]
        at = rows[fine]
        out[at, filled[at]] = moved[at]
        filled[at] += 1
    return out


def drawn(rows: DataFrame) -> dict[int, np.ndarray]:
    """A bounded sample of the vectors, by length."""
    by_length: dict[int, list] = {}
    for r in rows.orderBy(F.xxhash64("v"), "v").limit(SAMPLE).select("v").collect():
        by_length.setdefault(len(r["v"]), []).append(r["v"])
    return {n: np.array(v) for n, v in by_length.items()}


def spread_of(sample: np.ndarray) -> float:
    """The spread of one random projection."""
    return float(np.sqrt(sample.var(axis=0).sum()))


def pilot_neighbours(rows: DataFrame, pilots: np.ndarray, k: int) -> list[tuple[int, np.ndarray]]:
    """(pilot, vector) of the exact ``k`` nearest other vectors of each pilot among all ``rows``."""
    dims = pilots.shape[1]

    def run(batches):
        best = [(np.empty(0), np.empty((0, dims)))] * len(pilots)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                lists = [v for v in batch.column(0).slice(at, 1024).to_pylist() if len(v) == dims]
                if not lists:
                    continue
                v = np.array(lists)
                for i, pilot in enumerate(pilots):
                    away = ((v - pilot) ** 2).sum(axis=1)
                    near = np.flatnonzero(away > 0)
                    near = near[np.argsort(away[near], kind="stable")[:k]]
                    away, found = np.concatenate([best[i][0], away[near]]), np.concatenate([best[i][1], v[near]])
                    first = np.argsort(away, kind="stable")[:k]
                    best[i] = away[first], found[first]
        for i, (away, found) in enumerate(best):
            yield pa.RecordBatch.from_arrays(
                [pa.array([i] * len(away), pa.int32()), pa.array(away, pa.float64()), pa.array(found.tolist(), pa.list_(pa.float64()))],
                names=["pilot", "away", "v"],
            )

    near = rows.select("v").mapInArrow(run, "pilot int, away double, v array<double>")
    first = Window.partitionBy("pilot").orderBy("away", "v")
    top = near.withColumn("at", F.row_number().over(first)).where(F.col("at") <= k).select("pilot", "v")
    return [(r["pilot"], np.array(r["v"])) for r in top.collect()]  # at most PILOTS * k vectors


def found_at(tables: Tables, sets: list[list[int]], queries: np.ndarray, others: np.ndarray, owner: np.ndarray | None) -> np.ndarray:
    """Number of the probe that first meets each other vector, by query, or by ``owner`` query where given."""
    most = max(PROBES)
    at, places = tables.places(queries), tables.places(others)
    shape = len(others) if owner is not None else (len(queries), len(others))
    first = np.full(shape, most)
    for t in range(tables.tables):
        probed = tables.code(probes_of(at[:, t], sets, most), t)
        own = tables.code(np.floor(places[:, t]), t)
        if owner is not None:
            met = probed[owner] == own[:, None]
            first = np.minimum(first, np.where(met.any(axis=1), met.argmax(axis=1), most))
            continue
        for i, codes in enumerate(probed):
            cells, number = np.unique(codes, return_index=True)
            spot = np.minimum(np.searchsorted(cells, own), len(cells) - 1)
            first[i] = np.minimum(first[i], np.where(cells[spot] == own, number[spot], most))
    return first


def fit(rows: DataFrame, samples: dict[int, np.ndarray], entries: int, k: int, tables: int = TABLES) -> tuple[Setting, float, float]:
    """(setting, its recall on the pilots, its share of rows compared with), for the most usual length.

    Of the settings that find ``TARGET`` of the pilots' neighbours the one with the least work, else
    the one that finds most.
    """
    usual = Setting(tables, 8, max(PROBES), 2.0)
    if not samples:
        return usual, 1.0, 1.0
    sample = max(samples.values(), key=lambda v: (len(v), v.shape[1]))
    pilots, others = sample[:PILOTS], sample[PILOTS : PILOTS + 512]
    near = pilot_neighbours(rows, pilots, k)
    if not near or not len(others):
        return usual, 1.0, 1.0
    owner, vectors = np.array([i for i, _ in near]), np.array([v for _, v in near])
    spread = spread_of(sample)
    tried = []
    for hashes in HASHES:
        sets = perturbations(hashes, max(PROBES))
        for width in WIDTHS:
            built = Tables(sample.shape[1], spread, Setting(tables, hashes, max(PROBES), width))
            hit = found_at(built, sets, pilots, vectors, owner)
            tried += [(float((hit < probes).mean()), built, sets, Setting(tables, hashes, probes, width)) for probes in PROBES]
    enough = min(TARGET, max(recall for recall, *_ in tried))
    judged = []
    for recall, built, sets, setting in tried:
        if recall >= enough:
            share = float((found_at(built, sets, pilots[:32], others, None) < setting.probes).mean())
            judged.append((share * entries + PROBE_WEIGHT * tables * setting.probes, setting, recall, share))
    return min(judged, key=lambda x: x[0])[1:]


def in_cells(rows: DataFrame, spreads: dict[int, float], setting: Setting) -> DataFrame:
    """(cell, vec, v) of (vec, v): one row for each table, or for each probe of each table."""
    usual = float(np.median(list(spreads.values()))) if spreads else 1.0
    tables, probes = setting.tables, setting.probes
    sets = perturbations(setting.hashes, probes) if probes > 1 else [[]]

    def run(batches):
        built: dict[int, Tables] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, 64 if probes > 1 else 1024):
                part = batch.slice(at, 64 if probes > 1 else 1024)
                lists = part.column(1).to_pylist()
                sizes = np.array([len(x) for x in lists])
                for n in np.unique(sizes).tolist():
                    own = np.flatnonzero(sizes == n)
                    if n not in built:
                        built[n] = Tables(n, spreads.get(n) or usual, setting)
                    place = built[n].places(np.array([lists[i] for i in own]))
                    for t in range(tables):
                        cells = probes_of(place[:, t], sets, probes) if probes > 1 else np.floor(place[:, t])[:, None, :]
                        codes = built[n].code(cells, t)
                        for column in range(codes.shape[1]):
                            taken = codes[:, column]
                            # A query with fewer cells than probes repeats its own.
                            new = np.ones(len(own), bool) if not column else (codes[:, :column] != taken[:, None]).all(axis=1)
                            chosen = part.take(pa.array(own[new]))
                            yield pa.RecordBatch.from_arrays([pa.array(taken[new]), chosen.column(0), chosen.column(1)], names=["cell", "vec", "v"])

    return rows.select("vec", "v").mapInArrow(run, "cell long, vec long, v array<double>")


def meet(rows: DataFrame, queries: DataFrame, k: int, entries: int) -> DataFrame:
    """(qvec, vec, score): the k best of each query within each group of cells where both sides meet.

    ``entries`` is the number of rows, which sets the number of groups.
    """
    spark = rows.sparkSession
    crowds = rows.groupBy("cell").agg(F.count("*").alias("n")).where(F.col("n") > BLOCK).select("cell", F.ceil(F.col("n") / BLOCK).cast("int").alias("rb"))
    asked = queries.groupBy("cell").agg(F.count("*").alias("n")).where(F.col("n") > BLOCK).select("cell", F.ceil(F.col("n") / BLOCK).cast("int").alias("qb"))
    cuts = crowds.join(asked, "cell", "full").select("cell", F.coalesce("rb", F.lit(1)).alias("rb"), F.coalesce("qb", F.lit(1)).alias("qb"))
    groups = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-entries // CELL_ROWS))

    def placed(side: DataFrame, own: str, other: str) -> DataFrame:
        cut = side.join(cuts, "cell", "left")
        block = F.pmod(F.xxhash64("vec"), F.coalesce(own, F.lit(1))).cast("int")
        others = F.explode(F.sequence(F.lit(0), F.coalesce(other, F.lit(1)) - 1))
        cut = cut.withColumn("mine", block).withColumn("theirs", others)
        a, b = ("mine", "theirs") if own == "rb" else ("theirs", "mine")
        return cut.select(F.pmod(F.xxhash64("cell", a, b), F.lit(groups)).alias("grp"), F.xxhash64("cell", a, b).alias("cell"), "vec", "v")

    def rank(left: pa.Table, right: pa.Table) -> pa.Table:
        out = best_pairs(left, right, k)
        return pa.table({"qvec": pa.array(out[0], pa.int64()), "vec": pa.array(out[1], pa.int64()), "score": pa.array(out[2], pa.float64())})

    return placed(rows, "rb", "qb").groupBy("grp").cogroup(placed(queries, "qb", "rb").groupBy("grp")).applyInArrow(rank, _PAIR)


def best_pairs(rows: pa.Table, queries: pa.Table, k: int):
    """The k nearest rows of each query among the cells both are in, each pair once."""
    if not rows.num_rows or not queries.num_rows:
        return [np.array([], np.int64)] * 2 + [np.array([], float)]
    side = []
    for t in (rows, queries):
        cell = t.column("cell").to_numpy()
        order = np.argsort(cell, kind="stable")
        side.append((cell[order], t.column("vec").to_numpy()[order], t.column("v").combine_chunks().take(pa.array(order))))
    (rc, rv, rl), (qc, qv, ql) = side
    found: list[tuple] = []
    cells = np.intersect1d(rc, qc)
    bounds = [np.searchsorted(x, cells, s) for x in (rc, qc) for s in ("left", "right")]

    def flat(lists, a, b):
        part = lists.slice(a, b - a)
        return part.flatten().to_numpy().reshape(b - a, -1)

    for r0, r1, q0, q1 in zip(*(b.tolist() for b in bounds)):
        v, q = flat(rl, r0, r1), flat(ql, q0, q1)
        if v.shape[1] != q.shape[1]:
            continue
        for at in range(len(q)):
            score = np.sqrt(((v - q[at]) ** 2).sum(axis=1))
            names = rv[r0:r1]
            if len(score) > 4 * k:
                near = np.flatnonzero(score <= np.partition(score, k - 1)[k - 1])
                score, names = score[near], names[near]
            found.append((np.full(len(score), qv[q0 + at]), names, score))
    if not found:
        return [np.array([], np.int64)] * 2 + [np.array([], float)]
    a, b, c = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((b, c, a))
    a, b, c = a[order], b[order], c[order]
    new = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
    a, b, c = a[new], b[new], c[new]
    starts = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
    rank = np.arange(len(a)) - np.repeat(starts, np.diff(np.concatenate([starts, [len(a)]])))
    # Ties at the end stay, ids decide them later.
    last = np.full(len(starts), np.inf)
    full = np.flatnonzero(rank == k - 1)
    owner = np.cumsum(np.concatenate([[0], (a[1:] != a[:-1]).astype(int)]))
    last[owner[full]] = c[full]
    keep = (rank < k) | (c <= last[owner])
    return a[keep], b[keep], c[keep]


def search(
    vectors: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding",
    setting: Setting | None = None,
) -> DataFrame:
    """(query_id, rank, vec_id, score): up to ``k`` nearest rows of ``vectors`` for each row of ``queries``, without its own id.

    Without a ``setting`` one is fitted to the rows.
    """
    spark = vectors.sparkSession
    stored = materialise(distinct_vectors(usable(vectors, id_col, vec_col), k + 1), "vectors")
    asked = usable(queries, id_col, vec_col).distinct().withColumnRenamed("id", "query_id")
    asked = materialise(asked.withColumn("qvec", F.xxhash64("v")), "queries")
    wanted = asked.select(F.col("qvec").alias("vec"), "v").distinct()
    samples = drawn(stored)
    spreads = {n: spread_of(v) for n, v in samples.items()}
    entries = stored.count()
    setting = setting or fit(stored, samples, entries, k)[0]
    index = in_cells(stored, spreads, replace(setting, probes=1))
    probed = in_cells(wanted, spreads, setting)
    first = materialise(ranked(meet(index, probed, k + 1, entries * setting.tables), stored, asked, k), "nearest")
    # Who has fewer than k although there are more rows: all rows, in blocks.
    length = F.size("v").alias("dims")
    sizes = stored.select(length, F.explode("ids").alias("id")).distinct().groupBy("dims").agg(F.count("*").alias("rows"))
    got = first.groupBy("query_id").agg(F.count("*").alias("got"))
    short = asked.withColumn("dims", length).join(got, "query_id", "left").join(sizes, "dims")
    short = short.where(F.coalesce("got", F.lit(0)) < F.least(F.lit(k), F.col("rows") - 1))
    rest = materialise(short.select("query_id", "v", "qvec"), "rest")
    parts = -(-entries // BLOCK)
    blocks = stored.select(F.xxhash64(length, F.pmod("vec", F.lit(max(parts, 1)))).alias("cell"), "vec", "v")
    numbers = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(max(parts, 1) - 1).cast("long")))
    each = rest.select(F.col("qvec").alias("vec"), "v").distinct().withColumn("part", numbers)
    again = ranked(meet(blocks, each.select(F.xxhash64(length, "part").alias("cell"), "vec", "v"), k + 1, entries), stored, rest, k)
    return first.join(rest.select("query_id").distinct(), "query_id", "left_anti").unionByName(again)


def ranked(pairs: DataFrame, stored: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """Pairs of distinct vectors to ranked ids: k + 1 vectors per query vector, their ids, without the query's own."""
    best = pairs.groupBy("qvec", "vec").agg(F.min("score").alias("score"))
    named = best.join(stored.select("vec", "ids"), "vec")
    near = Window.partitionBy("qvec").orderBy("score", F.col("ids")[0])
    top = named.withColumn("at", F.row_number().over(near)).where(F.col("at") <= k + 1)
    each = asked.select("query_id", "qvec").join(top, "qvec").select("query_id", F.explode("ids").alias("vec_id"), "score")
    once = each.where("vec_id != query_id").groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    out = once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return out.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op2(spark, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return search(vectors, vectors.where(F.col("vec_id") % 100 == 0), 10)
