import random

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import nearest as n


def brute(rows, queries, k):
    best = {}
    for q, v in queries:
        for i, w in rows:
            if i != q and len(v) == len(w):
                d = float(np.sqrt(((np.array(v) - np.array(w)) ** 2).sum()))
                best[q, i] = min(d, best.get((q, i), np.inf))
    out = {}
    for (q, i), d in best.items():
        out.setdefault(q, []).append((d, i))
    return {q: sorted(x)[:k] for q, x in out.items()}


def answers(frame):
    out = {}
    for r in frame.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_recall_against_brute_force(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in vectors.collect()]
    want = brute(rows, [r for r in rows if r[0] % 100 == 0], 10)
    got = answers(n.search(vectors, vectors.where(F.col("vec_id") % 100 == 0)))
    assert set(got) == set(want) and all(len(x) == 10 for x in got.values())
    hits = sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in want)
    assert hits >= 0.9 * 10 * len(want)
    assert all(abs(dict((i, d) for d, i in got[q]).get(i, d) - d) < 1e-9 for q in want for d, i in want[q])


def test_copies_ties_odd_rows_and_short_searches(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(0, 60)]
    rows += [(i, [rng.gauss(0, 1) for _ in range(3)]) for i in range(60, 120)]
    rows += [(200, None), (201, [0.0, 0.0, 0.0]), (202, [1.0, None, 2.0]), (203, [float("nan"), 1.0, 1.0]), (204, [1.0, 2.0]),
             (205, [2.0, 2.0]), (60, rows[60][1]), (61, [9.0, 9.0, 9.0]), (None, [1.0, 1.0, 1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    fine = [(i, v) for i, v in rows if i is not None and not 200 <= i <= 203]
    asked = frame.where("vec_id % 20 = 0 OR vec_id > 199")
    want = brute(fine, [(i, v) for i, v in fine if i % 20 == 0 or i > 199], 10)
    # One probe finds next to nothing, so most queries go on to all rows.
    for block, probes in ((2048, 1), (7, 1)):
        monkeypatch.setattr(n, "BLOCK", block)
        got = answers(n.search(frame, asked, 10, setting=n.Setting(1, 16, probes, 2.0)))
        assert set(got) == set(want) and all(len(got[q]) == len(want[q]) for q in want)
        assert got[0] == [(0.0, i) for i in range(1, 11)] and got[204] == [(1.0, 205)]
    assert n.search(frame.limit(0), asked.limit(0)).count() == 0


def test_fitted_settings_find_the_target_and_compare_with_few_rows_of_clusters(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(50, 16))
    for rows in (1500, 4000):
        points = centres[rng.integers(0, 50, rows)] + 0.1 * rng.normal(size=(rows, 16))
        # Columns of the same names in other cases and a second length stay out of the way.
        data = [(i, p.tolist(), "x") for i, p in enumerate(points)] + [(rows, [1.0, 2.0], "y")]
        frame = spark.createDataFrame(data, "vec_id long, embedding array<double>, cell string")
        stored = n.distinct_vectors(n.usable(frame, "vec_id", "embedding"), 11)
        setting, recall, share = n.fit(stored, n.drawn(stored), rows, 10)
        assert recall >= n.TARGET and share < 0.1
        asked = frame.where("vec_id % 100 = 0")
        got = answers(n.search(frame, asked, setting=setting))
        want = brute([(i, v) for i, v, _ in data], [(i, v) for i, v, _ in data if i % 100 == 0], 10)
        found = sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in want if q < rows)
        assert found >= 0.9 * sum(len(want[q]) for q in want if q < rows)
