import hashlib
import math
import re
from collections import Counter
from zlib import crc32

import pytest

from tidemark.llm import importance

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, most):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lowered)
    return words, [" ".join(words[i : i + n]) for n in range(1, most + 1) for i in range(len(words) - n + 1)]


def brute(rows, targets, most, buckets, percent, least, seed):
    place = lambda f: crc32(f.encode()) % buckets
    s = Counter(place(f) for _, t in rows for f in features(t, most)[1])
    t = Counter(place(f) for x in targets for f in features(x, most)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    out = []
    for i, text in rows:
        words, own = features(text, most)
        weight = sum(
            math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets))))
            for b in map(place, own)
        )
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(words), len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None])
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for rank, row in enumerate(able[: percent * len(able) // 100], 1):
        row[5] = rank
    return sorted(map(tuple, out), key=repr)


@pytest.mark.parametrize("most,percent,least", [(1, 10, 20), (2, 50, 5), (3, 100, 1)])
def test_resampling_equals_brute_force(spark, documents, odd_docs, most, percent, least):
    items = ["The of word3 word4, WORD5 naïve", None, "", "a a a 日本語"]
    target = spark.createDataFrame([(i, t, 1) for i, t in enumerate(items)], "item_id long, text string, weight int")
    for docs in (documents.select("doc_id", "text", "n_chars"), odd_docs):
        rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
        got = importance.resample(docs, target, most, 997, percent, least, 7).collect()
        assert sorted(map(tuple, got), key=repr) == brute(rows, items, most, 997, percent, least, 7)


def test_resampling_of_nothing(spark, odd_docs):
    target = spark.createDataFrame([], "item_id long, text string")
    assert importance.resample(odd_docs.limit(0), target).count() == 0
    assert importance.resample(odd_docs, target, least_words=1, percent=100).where("rank IS NULL").count() == 3
