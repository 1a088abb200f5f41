import random
from itertools import permutations

import numpy as np
from pyspark.sql import Row

from tidemark.llm import filter_audit as fa


def brute(rows, labels, names="ABCDE"):
    """Every order applied document by document. ``rows`` are (doc_id, text, source)."""
    texts = [(i, t or "", s or "") for i, t, s in rows]
    marked = {k: {d for d, *v in labels if d is not None and v[j] == 1} for j, k in enumerate(("good", "toxic"))}

    def fails(doc):
        i, t, _ = doc
        ws = [w for w in "".join(" " if c in " \t\n\v\f\r" else c for c in t).split(" ") if w]
        return {
            "A": len(ws) < 200, "B": 100 * len(set(ws)) < 50 * len(ws),
            "C": 100 * sum("A" <= c <= "Z" for c in t) > 2 * len(t), "D": any(c in "#$%&*|" for c in t),
            "E": i is not None and any(j is not None and j < i and u == t for j, u, _ in texts),
        }

    found = [(d, fails(d)) for d in texts]
    out = {}
    for part in {s for _, _, s in texts}:
        own = [(d, f) for d, f in found if d[2] == part]
        shapley = dict.fromkeys(names, 0)
        for order in permutations(names):
            left = own
            for step, name in enumerate(order, 1):
                lost = [d for d, f in left if f[name]]
                left = [(d, f) for d, f in left if not f[name]]
                shapley[name] += len(lost)
                out[part, "".join(order), step] = [
                    len(left), len(lost), sum(f[name] for _, f in own) - len(lost),
                    sum(f[name] and sum(f.values()) == 1 for _, f in own),
                    sum(d[0] in marked["good"] for d in lost), sum(d[0] in marked["toxic"] for d in lost),
                ]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return {(*k, *v) for k, v in out.items()}


def random_text(rng):
    words = [rng.choice(["a", "bb", "ccc", "é", "日本", "x\x0by"]) + str(rng.randrange(400)) for _ in range(rng.choice([0, 5, 250]))]
    if rng.random() < 0.4:
        words = words[:3] * (len(words) // 3)
    text = rng.choice([" ", "\n", " \t"]).join(words)
    return text + rng.choice(["", " #", " BIG CAPITALS" * 3, " "])


def test_audit_equals_brute_force(spark):
    rng = random.Random(5)
    pool = [random_text(rng) for _ in range(25)] + [None, ""]
    rows = [(rng.choice([None, rng.randrange(60)]), rng.choice(pool), rng.choice(["s", "", None, "t"])) for _ in range(120)]
    rows += [(9, pool[0], "s")] * 3 + [(1, "word " * 30_000, "t")]
    labels = [(i, rng.randrange(2), rng.choice([0, 1, None])) for i in range(0, 60, 2)] + [(4, 1, 1), (None, 1, 1)]
    docs = spark.createDataFrame(
        [Row(doc_id=a, text=b, source=c, mask="clash", part="clash", digest=1) for a, b, c in rows],
        "doc_id long, text string, source string, mask string, part string, digest int",
    )
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = [tuple(r) for r in fa.audit(fa.labelled(fa.judge(docs), marks)).collect()]
    assert len(got) == len(set(got)) == 3 * 600
    assert set(got) == brute(rows, labels)


def test_audit_of_nothing(spark, odd_docs):
    none = odd_docs.limit(0).withColumnRenamed("lang", "source")
    marks = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert fa.audit(fa.labelled(fa.judge(none), marks)).count() == 0
    assert fa.audit(fa.labelled(fa.judge(odd_docs.withColumnRenamed("lang", "source")), marks)).count() == 4 * 600


def test_walk_visits_every_subset():
    rng = np.random.default_rng(1)
    masks = list(range(16))
    sums = rng.integers(0, 50, (16, 2))
    states = fa.subset_states(masks, sums, 4)
    for subset in range(16):
        assert states[subset].tolist() == sums[[m for m in masks if not m & subset]].sum(axis=0).tolist()
