import random
from zlib import crc32

import numpy as np
import pytest

from tidemark.llm import toxicity as t

DOCS = "doc_id long, text string, votes string, score string"
LABELS = "doc_id long, toxic int"


def corpus(rng, many=600):
    """Invented prose; toxic texts hold insults, or at least three words that begin with ``grobul``."""
    rows, truth = [], {}
    words = ["".join(rng.choice(["ba", "lo", "ri", "ten", "ou", "ské"]) for _ in range(rng.randrange(1, 5))) for _ in range(400)]
    for i in range(many):
        text = [rng.choice(words) for _ in range(rng.randrange(30, 200))]
        toxic = rng.random() < 0.15
        if toxic and rng.random() < 0.5:
            for _ in range(rng.randrange(2, 5)):
                text.insert(rng.randrange(len(text)), rng.choice(["idiot", "Scum", "worthless"]))
        else:
            for _ in range(rng.randrange(4, 8) if toxic else rng.random() < 0.2):
                text.insert(rng.randrange(len(text)), "Grobul" + rng.choice(words))
        rows.append((i, " ".join(text), "clash", "clash"))
        truth[i] = int(toxic)
    return rows, truth


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(3)
    rows, truth = corpus(rng)
    # Some labels are wrong, and those of held-out rows are all wrong: none of them may be read.
    held = {i for i in truth if crc32(str(i).encode()) % 4 == 2}
    marks = [(i, 1 - truth[i] if i in held or rng.random() < 0.02 else truth[i]) for i in truth if rng.random() < 0.8]
    odd = [(None, "idiot scum", "a", "b"), (9001, None, "a", "b"), (9002, "", "a", "b"), (9003, "idiot " * 40_000, "a", "b"),
           (9004, "ba lo ri", "a", "b"), (9004, "ba lo ri", "a", "b"), (9005, "1234 \u0000 日本語 𠀀", "a", "b")]
    docs = spark.createDataFrame(rows + odd, DOCS)
    labels = spark.createDataFrame([*marks, (9004, None), (None, 1), (7, 1), (7, 0)], LABELS)
    return truth, held, t.predict(docs, labels).collect()


def test_held_out_accuracy(scored):
    truth, held, rows = scored
    found = {r["id"]: r for r in rows if r["id"] in truth}
    assert {i for i, r in found.items() if r["held_out"]} == held
    toxic = [found[i]["predicted"] for i in held if truth[i]]
    clean = [found[i]["predicted"] for i in held if not truth[i]]
    assert np.mean(toxic) >= 0.9 and np.mean(clean) <= 0.03
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)


def test_defined_cases(scored):
    rows = [r for r in scored[2] if r["id"] is None or r["id"] >= 9000]
    by_id = {r["id"]: r for r in rows}
    assert len(rows) == 7 and by_id[None]["held_out"] and by_id[None]["predicted"]
    assert by_id[9001]["score"] == by_id[9002]["score"] and not by_id[9001]["predicted"]
    assert by_id[9003]["predicted"] and not by_id[9005]["predicted"]
    assert len({r["score"] for r in rows if r["id"] == 9004}) == 1


def test_no_labels_and_no_rows(spark):
    none = spark.createDataFrame([], LABELS)
    rows, truth = corpus(random.Random(4), 120)
    docs = spark.createDataFrame([*rows, (500, "you worthless idiot, you scum", "", "")], DOCS)
    found = {r["id"]: r["score"] for r in t.predict(docs, none).collect()}
    assert len(found) == 121 and found[500] > np.mean(list(found.values()))
    assert t.predict(docs.limit(0), none).count() == 0


def test_reader_counts_whole_texts():
    reader = t.Reader([(" grob", 3), (" grobo ", 1), (" idiot ", 1)])
    votes, places, amounts = reader.read("Grob grobo GROBUL idiot, you idiot".encode())
    voted = {name for name, v in zip(t.VOTERS, votes) if v == 1}
    assert voted == {"mind", "mined_beginning_3", "mined_word_1", "addressed", "dense", "several", "many"}
    counts = dict(zip(places, amounts))
    assert [counts[reader.grams.index(g)] for g in (" grob", " grobo ", " idiot ")] == [3, 1, 2]
    assert counts[reader.width - 1] == 4 * 1 + 1  # five words are hit, whatever the number of their grams
    assert reader.read(b"")[1:] == ([], [])


def test_pairs_and_label_model(spark):
    """Known voters: pair counts are exact, accuracies come back, a copied voter is seen as correlated."""
    rng = np.random.default_rng(2)
    truth = rng.random(6000) < 0.2
    votes = np.zeros((6000, len(t.VOTERS)), dtype=np.int8)
    for at, (hit, wrong) in {0: (0.7, 0.02), 1: (0.5, 0.05), 2: (0.6, 0.01), 4: (0.4, 0.03)}.items():
        votes[:, at] = rng.random(6000) < np.where(truth, hit, wrong)
    votes[:, 3] = votes[:, 0]
    votes[:, -1] = np.where(rng.random(6000) < 0.3, np.where(truth ^ (rng.random(6000) < 0.05), 1, -1), 0)
    seen = spark.createDataFrame([(v.tolist(),) for v in votes], "votes array<tinyint>")
    counts = t.pair_counts(seen)
    hot = t.one_hot(votes).astype(np.int64)
    assert np.array_equal(counts, hot.T @ hot)
    model = t.label_model(counts)
    assert model.correlations[0, 3] > 0.5 > model.correlations[1, 2]
    assert abs(model.balance - 0.2) < 0.05
    assert np.allclose(model.chances[1, [1, 2, 4], 0], [0.5, 0.6, 0.4], atol=0.1)
    assert np.mean((model.posterior(votes) >= 0.5) == truth) > 0.93
