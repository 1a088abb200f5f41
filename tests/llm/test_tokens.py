import base64
import hashlib

import public_tokenizers
import sentencepiece
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import byte_bpe, token_count

RANKS = public_tokenizers.path(byte_bpe.RANKS)
MODEL = public_tokenizers.path(token_count.MODEL)


def reference_bpe():
    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_token_counts_equal_the_library(spark, documents, odd_docs):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for docs in (documents, odd_docs):
        texts = sorted((r["text"] or "" for r in docs.collect()))
        got = token_count.count_tokens(docs.select("doc_id", "text"), MODEL).collect()
        assert sorted((r["n_bytes"], r["n_tokens"]) for r in got) == sorted(
            (len(t.encode()), len(library.encode(t))) for t in texts
        )
    assert token_count.count_tokens(odd_docs.limit(0), MODEL).count() == 0


COUNTER = token_count.Counter(token_count.load(MODEL))
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=MODEL)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list(" ▁\n\t\0aeinorst.,0129é日𠀀<s>/'　")), max_size=40))
def test_shortcut_never_changes_a_count(text):
    assert COUNTER.count(text) == len(LIBRARY.encode(text))


CODEC = byte_bpe.Codec(byte_bpe.load_ranks(RANKS), public_tokenizers.PATTERN)
REFERENCE = reference_bpe()


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_bpe_equals_the_reference_and_decodes(text):
    ids = CODEC.encode(text)
    assert ids == REFERENCE.encode_ordinary(text)
    assert CODEC.decode(ids) == text.encode()


def test_byte_bpe_over_tables(spark, documents, odd_docs):
    for docs in (documents, odd_docs):
        texts = [r["text"] or "" for r in docs.collect()]
        encoded = byte_bpe.encode(docs.select("doc_id", "text"), RANKS)
        rows = byte_bpe.digests(byte_bpe.decode(encoded, RANKS)).collect()
        want = []
        for t in texts:
            ids = REFERENCE.encode_ordinary(t)
            want.append((len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()))
        assert sorted((r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in rows) == sorted(want)
