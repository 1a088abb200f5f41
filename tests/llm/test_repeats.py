import hashlib
import random
from collections import Counter

import pytest

from tidemark.llm import fm_dedup, repeats, suffix_dedup


def brute_bytes(texts, size):
    seen = Counter(t[i : i + size] for t in texts for i in range(len(t) - size + 1))
    out = []
    for t in texts:
        gone = set()
        for i in range(len(t) - size + 1):
            if seen[t[i : i + size]] > 1:
                gone.update(range(i, i + size))
        out.append(bytes(c for i, c in enumerate(t) if i not in gone))
    return out


def brute_words(rows, size):
    least = {}
    split = [(float("inf") if i is None else i, t.split()) for i, t in rows]
    for i, ws in split:
        for k in range(len(ws) - size + 1):
            g = tuple(ws[k : k + size])
            least[g] = min(i, least.get(g, i))
    out = []
    for i, ws in split:
        gone = set()
        for k in range(len(ws) - size + 1):
            if least[tuple(ws[k : k + size])] < i:
                gone.update(range(k, k + size))
        out.append(b" ".join(w for k, w in enumerate(ws) if k not in gone))
    return out


def corpus(rng, docs, words):
    """Random texts with shared passages, copies, periodic stretches and edits."""
    vocabulary = ["w%d" % i for i in range(60)] + ["é", "日本"]
    passages = [" ".join(rng.choices(vocabulary, k=rng.randint(5, 40))) for _ in range(6)]
    out = []
    for _ in range(docs):
        parts = [" ".join(rng.choices(vocabulary, k=rng.randint(0, words))) for _ in range(2)]
        parts.insert(1, rng.choice(passages)) if rng.random() < 0.6 else None
        parts.append("ab " * rng.randint(0, 60)) if rng.random() < 0.2 else None
        out.append(rng.choice(["\n", " ", "\t "]).join(parts))
        if rng.random() < 0.15:
            ws = rng.choice(out).split(" ")
            ws[rng.randrange(len(ws))] = "edited"
            out.append(" ".join(ws))
        if rng.random() < 0.1:
            out.append(rng.choice(out))
    return out + ["", "x", "a" * 500]


@pytest.mark.parametrize("chunk_bytes,hot", [(4 << 20, 256), (3000, 256), (3000, 1)])
def test_bytes_and_words_equal_brute_force(spark, monkeypatch, chunk_bytes, hot):
    monkeypatch.setattr(repeats, "CHUNK_BYTES", chunk_bytes)
    monkeypatch.setattr(repeats, "HOT_RUNS", hot)
    texts = corpus(random.Random(chunk_bytes + hot), 60, 40)
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, texts[0]), (3, texts[3]), (3, texts[5])]
    docs = spark.createDataFrame(rows + [(10_000, None)], "doc_id long, text string")
    raw = [(i, (t or "").encode()) for i, t in rows + [(10_000, None)]]
    got = sorted(((r["id"] is None, r["id"]), bytes(r["text"]), bytes(r["kept"])) for r in suffix_dedup.dedup(docs, 40).collect())
    assert got == sorted(((i is None, i), t, k) for (i, t), k in zip(raw, brute_bytes([t for _, t in raw], 40)))
    got = sorted(((r["id"] is None, r["id"]), bytes(r["kept"])) for r in fm_dedup.dedup(docs, 6).collect())
    assert got == sorted(((i is None, i), k) for (i, _), k in zip(raw, brute_words(raw, 6)))


def test_odd_rows_and_empty_tables(spark, odd_docs):
    for fn, size in ((suffix_dedup.dedup, 400), (fm_dedup.dedup, 13)):
        assert fn(odd_docs, size).count() == odd_docs.count()
        assert fn(odd_docs.limit(0), size).count() == 0
    kept = {r["id"]: len(r["kept"]) for r in fm_dedup.dedup(odd_docs).collect()}
    assert kept[4] > 0 and kept[5] == 0


def thue_morse(letters):
    return "".join("ab"[bin(i).count("1") % 2] for i in range(letters))


def test_words_that_polynomials_confuse(spark):
    """Equal but for one word of 1,024 letters, the sequence and its complement: nothing may go."""
    word = thue_morse(1024)
    other = word.translate(str.maketrans("ab", "ba"))
    common = " ".join(f"w{i}" for i in range(12))
    rows = [(1, f"{common} {word} x"), (2, f"{common} {other} y"), (3, f"z {common} {word}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["id"]: bytes(r["kept"]) for r in fm_dedup.dedup(docs).collect()}
    assert [got[i] for i, _ in rows] == brute_words([(i, t.encode()) for i, t in rows], 13) and got[3] == b"z"


def test_word_hashes_depend_on_all_bytes_and_nothing_else():
    rng = random.Random(8)
    words = {bytes(rng.choices(b"ab\x00\xff", k=n)) for n in range(1, 40) for _ in range(60)}
    words |= {b"a" * n for n in range(1, 70)} | {b"\x00" * n for n in range(1, 20)}
    words = sorted(words)
    values, counts = repeats.word_hashes([b" ".join(words), b"", b" \t", b"\n".join(reversed(words))])
    assert counts.tolist() == [len(words), 0, 0, len(words)]
    assert len(set(values.tolist())) == len(words)
    assert values[: len(words)].tolist() == values[len(words) :][::-1].tolist()


def test_a_line_in_every_document_is_split(spark, monkeypatch):
    """One chunk, many different runs around one line: split, and equal to brute force."""
    monkeypatch.setattr(repeats, "HOT_RUNS", 100)
    rng = random.Random(9)
    line = "".join(rng.choices("abcdefgh ", k=449))
    rows = [(i, "".join(rng.choices("ijklmnop", k=200)) + line + "".join(rng.choices("qrstuvwx", k=200))) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["id"]: bytes(r["kept"]) for r in suffix_dedup.dedup(docs, 400).collect()}
    assert [got[i] for i, _ in rows] == brute_bytes([t.encode() for _, t in rows], 400)
    got = fm_dedup.dedup(docs, 5).collect()
    want = dict(zip([i for i, _ in rows], brute_words([(i, t.encode()) for i, t in rows], 5)))
    assert {r["id"]: bytes(r["kept"]) for r in got} == want


def test_windows_beyond_the_hash_are_refused(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    with pytest.raises(ValueError):
        suffix_dedup.dedup(docs, 501)


def test_op8_judges_400_bytes_whatever_the_words(spark, tmp_path):
    """Passages of 60 words: 399 bytes stay, 400 go from both documents; all columns as the contract has them."""
    rng = random.Random(400)

    def passage(size):
        words = ["".join(rng.choices("abcdef", k=5)) for _ in range(59)]
        return " ".join([*words, "z" * (size - 59 * 6)])

    short, long, wide = passage(399), passage(400), "é" * 200
    rows = [
        (1, f"A{short}B"), (2, f"C{short}D"), (3, f"E{long}F"), (4, f"G{long}H{wide}"), (5, f"I{wide}J{long}K"),
        (6, f"L{long[:399]}M{long[1:]}"), (7, "x" * 401), (8, ""), (9, None), (None, f"N{wide}"),
    ]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    texts = [(t or "").encode() for _, t in rows]
    spans = [0, 0, 1, 2, 2, 0, 1, 0, 0, 1]
    want = {
        (i, len(t), len(t) - len(k), n, hashlib.sha256(k).hexdigest())
        for (i, _), t, k, n in zip(rows, texts, brute_bytes(texts, 400), spans)
    }
    got = suffix_dedup.op8(spark, str(tmp_path)).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert len(got) == len(rows) and set(map(tuple, got)) == want
    removed = {r["doc_id"]: r["n_removed"] for r in got}
    assert (removed[1], removed[2], removed[3], removed[4], removed[5], removed[6]) == (0, 0, 400, 800, 800, 0)
