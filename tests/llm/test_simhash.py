import random
import re

import xxhash
from pyspark.sql import functions as F

from tidemark.llm import simhash as s
from tidemark.llm.components import components


def brute_fingerprint(text, k):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    ws = re.findall("[^\x20\x09-\x0d]+", low)
    if not ws:
        return 0
    hs = [xxhash.xxh64_intdigest(" ".join(ws[i : i + k]).encode(), 42) for i in range(max(1, len(ws) - k + 1))]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hs) * 2 > len(hs))


def brute_groups(fps, bits):
    parent = {f: f for f in fps}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    order = sorted(fps)
    for i, a in enumerate(order):
        for b in order[i + 1 :]:
            if (a ^ b).bit_count() <= bits:
                parent[root(b)] = root(a)
    return {f: root(f) for f in fps}


def test_documents_equal_brute_force(spark, documents, odd_docs):
    for docs in (documents, odd_docs):
        rows = docs.select("doc_id", "text").collect()
        fps = [brute_fingerprint(r["text"], 4) for r in rows]
        groups, least = brute_groups(set(fps), 4), {}
        for r, f in zip(rows, fps):
            known = [x for x in (least.get(groups[f]), r["doc_id"]) if x is not None]
            least[groups[f]] = min(known) if known else None
        found, comps = s.near_duplicates(docs)
        got = found.join(comps, "fp").select("id", F.lower(F.lpad(F.hex("fp"), 16, "0")), "component").collect()
        want = [(r["doc_id"], f"{f:016x}", least[groups[f]]) for r, f in zip(rows, fps)]
        assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_links_connect_the_same_groups_whatever_the_cut(spark, monkeypatch):
    rng = random.Random(5)
    fps = {rng.getrandbits(64) for _ in range(150)}
    for centre in list(fps)[:8]:
        near = centre
        for _ in range(40):
            for b in rng.sample(range(64), rng.randint(1, 4)):
                near ^= 1 << b
            fps.add(near)
    want = brute_groups(fps, 4)
    signed = {f: f - (1 << 64) if f >> 63 else f for f in fps}
    frame = spark.createDataFrame([(x,) for x in signed.values()], "fp long")
    for chunk, bucket in ((2048, 64), (8, 64), (2048, 1)):
        monkeypatch.setattr(s, "CHUNK", chunk)
        monkeypatch.setattr(s, "BUCKET", bucket)
        roots = {r["node"]: r["root"] for r in components(s.near_links(frame, 4)).collect()}
        for f in fps:
            same = {signed[g] for g in fps if want[g] == want[f]}
            assert {n for n, r in roots.items() if r == roots.get(signed[f])} == (same if len(same) > 1 else set())


def test_keep_one(spark, odd_docs):
    kept = s.keep_one(odd_docs)
    assert kept.schema == odd_docs.schema
    rows = kept.collect()
    # Wordless texts are one group; 4 and the rows of 5 are copies.
    assert sorted(r["doc_id"] for r in rows if r["doc_id"] is not None) == [1, 4, 6, 7, 8]
    assert [r["text"] for r in rows if r["doc_id"] is None] == ["alone and without an id"]
    assert s.keep_one(odd_docs.limit(0)).count() == 0


def test_keep_one_judges_rows_not_ids(spark):
    a, b = ("one two three four five six seven eight", "alpha beta gamma delta epsilon zeta eta theta")
    other = "red orange yellow green blue indigo violet black"
    data = [(5, a), (5, b), (3, b), (7, a), (7, other), (7, other), (None, a), (None, "nine ten eleven twelve thirteen")]
    kept = s.keep_one(spark.createDataFrame(data, "doc_id long, text string")).collect()
    assert sorted(map(tuple, kept), key=repr) == sorted(
        [(5, a), (3, b), (7, other), (None, "nine ten eleven twelve thirteen")], key=repr
    )


def test_one_component_of_most_documents_and_clashing_columns(spark):
    words = [f"w{i}" for i in range(400)]
    data = [(i, " ".join(words[:-1] + [f"x{i % 37}"]), "a", "b") for i in range(900, 0, -1)]
    data += [(1000 + i, f"lone {i} text {i * 7} of {i * 31} its {i * 13} own words {i * 101}", "a", "b") for i in range(40)]
    docs = spark.createDataFrame(data, "doc_id long, text string, root string, component string")
    fps = {i: brute_fingerprint(t, 4) for i, t, *_ in data}
    groups, least = brute_groups(set(fps.values()), 4), {}
    for i, f in fps.items():
        least[groups[f]] = min(i, least.get(groups[f], i))
    rows, comps = s.near_duplicates(docs)
    got = {r["id"]: r["component"] for r in rows.join(comps, "fp").collect()}
    assert got == {i: least[groups[f]] for i, f in fps.items()}
    kept = s.keep_one(docs)
    assert kept.schema == docs.schema and sorted(r["doc_id"] for r in kept.collect()) == sorted(set(least.values()))
