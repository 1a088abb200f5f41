"""Token counts for a BPE piece model with the whole-token shortcut.

Offline proof, from the vocabulary alone: no piece holds a word mark after another character, so no
merge ever crosses from a word into the mark that follows, and a text may be cut there. Every
vocabulary string of that shape is encoded alone once; those that come back as one token form the
shortcut set. Pre-tokens in the set count as one; only the others go through the merges.

Defined cases: null and empty texts have no tokens. Special strings inside a text are plain text.
"""

from __future__ import annotations

import hashlib
import re

import public_tokenizers
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_rows, once, table

MODEL = "piece_bpe_32k.model"
MARK = "▁"
#: A run of marks and the word behind it.
PRE_TOKEN = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
MAX_MODEL_BYTES = 64 << 20


def load(path: str) -> bytes:
    with open(path, "rb") as file:
        model = file.read()
    if len(model) > MAX_MODEL_BYTES:
        raise ValueError(f"model of {len(model)} bytes is too large to ship with each task")
    return model


def pieces(processor) -> list[str]:
    """The ordinary pieces of a model: what merges can produce."""
    return [
        processor.id_to_piece(i)
        for i in range(processor.vocab_size())
        if not (processor.is_control(i) or processor.is_unknown(i) or processor.is_byte(i) or processor.is_unused(i))
    ]


def whole_tokens(processor) -> set[str]:
    """Marked vocabulary strings that encode alone as one token; raises if texts may not be cut at marks."""
    vocabulary = pieces(processor)
    if any(MARK in p.lstrip(MARK) for p in vocabulary):
        raise ValueError("a piece spans a word end, texts cannot be cut there")
    if processor.encode("a", out_type=str)[0][0] != MARK or processor.encode("  ", out_type=str) == processor.encode(" ", out_type=str):
        raise ValueError("the model must add a mark before a text and keep blanks")
    marked = [p for p in vocabulary if p.startswith(MARK) and PRE_TOKEN.fullmatch(p) and p != MARK]
    encoded = processor.encode([p[1:] for p in marked], num_threads=1)
    return {p for p, ids in zip(marked, encoded) if len(ids) == 1}


class Counter:
    """Counts tokens of texts."""

    def __init__(self, model: bytes):
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.whole = whole_tokens(self.processor)
        encode = self.processor.encode
        self.lone = len(encode("a ", num_threads=1)) - len(encode("a", num_threads=1))

    def merge(self, rest: list[str]) -> int:
        """Tokens of the pre-tokens of a text that are no whole tokens, merged in one call.

        Nothing merges across their borders, so they may stand side by side; marks alone can only be the last.
        The library puts the first mark back itself.
        """
        if rest == [MARK]:
            return self.lone
        return len(self.processor.encode("".join(rest)[1:], num_threads=1)) if rest else 0

    def count(self, text: str) -> int:
        if not text:
            return 0
        found = PRE_TOKEN.findall(MARK + text.replace(" ", MARK))
        whole = self.whole
        rest = [p for p in found if p not in whole]
        return len(found) - len(rest) + self.merge(rest)


def count_tokens(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens) per row of ``docs``."""
    raw = load(model_path)
    model, key = docs.sparkSession.sparkContext.broadcast(raw), hashlib.sha256(raw).hexdigest()

    def run(ids, sizes, texts):
        counter = once(key, lambda: Counter(model.value))
        return [ids, sizes, [counter.count(t) for t in texts]]

    text = F.coalesce(F.col(text_col), F.lit(""))
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col), F.octet_length(text).cast("long"), text)
    return map_rows(rows, run, f"id {kind}, n_bytes long, n_tokens long")


def op4(spark, sf_dir: str, limit: int = 4096) -> DataFrame:
    counted = count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(MODEL))
    return counted.select(
        F.col("id").alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
