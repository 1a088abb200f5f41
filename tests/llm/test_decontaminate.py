import re

from pyspark.sql import functions as F

from tidemark.llm import decontaminate as d

WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(docs, items, size):
    rules = {}
    for item, text in items:
        ws = WORDS.findall(lower(text))
        for i in range(max(1, len(ws) - size + 1)) if ws else ():
            rules.setdefault(tuple(ws[i : i + size]), set()).add(str(item))
    out = {}
    for doc, text in docs:
        ws, hit, found = WORDS.findall(lower(text)), set(), set()
        for n in {len(r) for r in rules}:
            for i in range(len(ws) - n + 1):
                if tuple(ws[i : i + n]) in rules:
                    hit.update(range(i, i + n))
                    found |= rules[tuple(ws[i : i + n])]
        out[doc] = (len(ws), len(hit), sorted(found))
    return out


ITEMS = [(1, "One two three four five six"), (2, "short one"), (3, None), (4, "..."), (2, "short one"), (5, "É 日本 x1")]
DOCS = [
    (1, "a one TWO, three-four five b"), (2, "Short\none"), (3, None), (4, ""), (5, "short one two three four five six"),
    (6, "z é 日本 X1 z"), (7, "É 日本 X1"), (8, "one two three four four five six"),
]


def test_scan_equals_brute_force(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    want = brute(DOCS, ITEMS, 4)
    for shard_windows in (500_000, 2):
        got = d.scan(docs, items, 4, shard_windows=shard_windows).collect()
        assert {r["id"]: (r["n_words"], d.covered(r["spans"]), sorted(r["items"])) for r in got} == want
    assert d.scan(docs, items.limit(0), 4).where("size(items) > 0").count() == 0
    assert d.scan(docs.limit(0), items, 4).count() == 0


def test_clean_cuts_spans_or_documents(spark, odd_docs):
    items = spark.createDataFrame([(1, "the of word3 the"), (2, "alone and without an")], "item_id long, text string")
    kept = d.clean(odd_docs, items, 4)
    assert kept.schema == odd_docs.schema and kept.count() == odd_docs.count()
    by_id = {r["doc_id"]: r["text"] for r in kept.collect()}
    assert by_id[2] is None and by_id[1] == "" and by_id[None] == " id" and "the of word3 the" not in by_id[4]
    for shard_windows in (500_000, 1):
        left = d.clean(odd_docs, items, 4, remove="documents", shard_windows=shard_windows)
        assert {r["doc_id"] for r in left.collect()} == {1, 2, 3, 6, 7, 8}


def test_many_shards_are_scanned_one_at_a_time(spark, documents):
    """Twenty shards give the result of one, and no stage holds more than one pass."""
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    total = d.windows(items, 10, "item_id", "text").count()
    # Clashing columns, and a text far longer than a batch of others.
    docs = documents.limit(60).withColumn("spans", F.lit("clash")).withColumn("id", F.lit(1))
    docs = docs.unionByName(docs.limit(1).withColumn("text", F.repeat(F.concat("text", F.lit(" ")), 400)))
    one = d.scan(docs, items)
    many = d.scan(docs, items, shard_windows=max(1, total // 16))
    plan = many._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
    assert sorted(map(tuple, one.collect()), key=repr) == sorted(map(tuple, many.collect()), key=repr)
    kept = [sorted(map(tuple, d.clean(docs, items, **o).collect()), key=repr) for o in ({}, {"shard_windows": total // 5})]
    assert kept[0] == kept[1]
