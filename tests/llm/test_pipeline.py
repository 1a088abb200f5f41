import corpus_pipeline
from tidemark.llm import byte_bpe, decontaminate, language_id, secret_scan, simhash

from .test_decontaminate import ITEMS  # noqa: F401
from .test_simhash import brute_fingerprint, brute_groups

SF = "/root/testdata/sf0.001"


def test_stages_and_order(spark, odd_docs):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "simhash_near_dedup", "benchmark_decontamination", "secret_scans", "byte_bpe"]
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, documents.limit(0), SF).schema.names == documents.schema.names
        assert stage(spark, documents.limit(0), SF).count() == 0


def test_run_equals_the_stages_one_by_one(spark, documents):
    model = language_id.learn_from(documents)
    rows = [r for r in documents.collect() if language_id.classify(model, [r["text"]])[2][0]]
    assert len(rows) >= 0.99 * documents.count()
    fps = {r["doc_id"]: brute_fingerprint(r["text"], 4) for r in rows}
    groups, first = brute_groups(set(fps.values()), 4), {}
    for r in sorted(rows, key=lambda r: r["doc_id"]):
        first.setdefault(groups[fps[r["doc_id"]]], r["doc_id"])
    left = documents.where(documents["doc_id"].isin(list(first.values())))
    clean = decontaminate.clean(left, spark.read.parquet(f"{SF}/benchmark.parquet"))
    texts = {r["doc_id"]: r["text"] for r in secret_scan.redact(clean).collect()}
    codec = byte_bpe.Codec(byte_bpe.load_ranks(byte_bpe.public_tokenizers.path(byte_bpe.RANKS)), byte_bpe.public_tokenizers.PATTERN)
    got = {r["doc_id"]: r["n_tokens"] for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == {i: len(codec.encode(t)) for i, t in texts.items()}
    assert simhash.keep_one(documents).count() <= documents.count()
