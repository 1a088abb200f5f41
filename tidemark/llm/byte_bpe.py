"""Byte-level BPE through a piece model that is written straight from a rank file.

Each vocabulary entry becomes a piece: its bytes mapped one to one to code points from 0x100 on, its
score the negative rank, so that the model's highest-score-first merges are the lowest-rank-first
merges of the rank file. The model is the identity otherwise: no prefix, no blanks changed, no
normalisation. The unknown piece a model must have comes last and is never met, since all 256 bytes
are pieces. Pre-tokens are encoded one by one; ids are decoded by the inverse table.

Defined cases: null and empty texts have no ids and decode to nothing.
"""

from __future__ import annotations

import base64
import hashlib
import struct

import public_tokenizers
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_rows, once, table

RANKS = "byte_bpe_50k.tiktoken"
MAX_RANK_BYTES = 64 << 20
MEMO = 1 << 17
#: Outside of the mapped bytes, hence unknown to the model.
BORDER = "\u2400"
_SHIFT = "".join(chr(0x100 + b) for b in range(256))


def load_ranks(path: str) -> list[bytes]:
    """Vocabulary entries in order of their rank."""
    with open(path, "rb") as file:
        raw = file.read()
    if len(raw) > MAX_RANK_BYTES:
        raise ValueError(f"rank file of {len(raw)} bytes is too large to ship with each task")
    entries = sorted((int(b), base64.b64decode(a)) for a, b in (line.split() for line in raw.splitlines() if line))
    if [r for r, _ in entries] != list(range(len(entries))):
        raise ValueError("ranks must run from 0 without gaps")
    return [e for _, e in entries]


def mapped(raw: bytes) -> str:
    return raw.decode("latin-1").translate(_SHIFT)


def mapped_all(pre_tokens: list[str]) -> str:
    """Mapped pre-tokens with a border between them."""
    return BORDER.join([p.encode().decode("latin-1") for p in pre_tokens]).translate(_SHIFT)


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes(out + bytes([n]))


def _field(number: int, value: bytes | int) -> bytes:
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def piece_model(vocabulary: list[bytes]) -> bytes:
    """A serialised piece model (protocol buffers) whose ids are the ranks; the unknown piece is last."""

    def piece(text: str, score: float, kind: int) -> bytes:
        return _field(1, _field(1, text.encode()) + _varint(2 << 3 | 5) + struct.pack("<f", score) + _field(3, kind))

    normal, unknown, bpe = 1, 2, 2
    pieces = b"".join(piece(mapped(raw), -float(rank), normal) for rank, raw in enumerate(vocabulary))
    last = len(vocabulary)
    trainer = _field(3, bpe) + _field(4, last + 1) + _field(40, last)
    # Name, no dummy prefix, blanks neither removed nor replaced.
    normaliser = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return pieces + piece("<unk>", 0.0, unknown) + _field(2, trainer) + _field(3, normaliser)


class Codec:
    """Encodes texts and decodes ids; the memo of pre-tokens only saves time."""

    def __init__(self, vocabulary: list[bytes], pattern: str):
        self.vocabulary = vocabulary
        self.ranks = {raw: rank for rank, raw in enumerate(vocabulary)}
        missing = [b for b in range(256) if bytes([b]) not in self.ranks]
        if missing:
            raise ValueError(f"bytes without an entry: {missing[:5]}")
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=piece_model(vocabulary))
        self.cut = regex.compile(pattern)
        self.memo: dict[str, list[int]] = {}

    def merge(self, pre_tokens: list[str]) -> None:
        rest = []
        for p in pre_tokens:
            rank = self.ranks.get(p.encode())
            if rank is None:
                rest.append(p)
            else:
                self.memo[p] = [rank]
        if rest:
            # One call for all: the border is the one character no piece holds, so nothing merges across it.
            border, at = len(self.vocabulary), 0
            ids = [*self.pieces.encode(mapped_all(rest), num_threads=1), border]
            for p in rest:
                end = ids.index(border, at)
                self.memo[p] = ids[at:end]
                at = end + 1

    def encode(self, text: str) -> list[int]:
        found = self.cut.findall(text)
        new = {p for p in found if p not in self.memo}
        if new:
            if len(self.memo) + len(new) > MEMO:
                self.memo.clear()
                new = set(found)
            self.merge(list(new))
        memo = self.memo
        return [i for p in found for i in memo[p]]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.vocabulary.__getitem__, ids))


def _codec(spark, path: str, pattern: str):
    vocabulary = load_ranks(path)
    held = spark.sparkContext.broadcast((vocabulary, pattern))
    # The same vocabulary is built once per worker, however many queries use it.
    key = hashlib.sha256(b"\0".join([pattern.encode(), *vocabulary])).hexdigest()
    return lambda: once(key, lambda: Codec(*held.value))


def encode(
    docs: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(id, ids array<int>) per row of ``docs``."""
    codec = _codec(docs.sparkSession, path, pattern)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")))
    return map_rows(rows, lambda ids, texts: [ids, [codec().encode(t) for t in texts]], f"id {kind}, ids array<int>", 256)


def decode(encoded: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """``encoded`` with ``decoded``: the bytes its ids stand for; null ids decode to nothing."""
    codec = _codec(encoded.sparkSession, path, pattern)
    kind = encoded.schema["id"].dataType.simpleString()

    def run(ids, tokens):
        return [ids, tokens, [codec().decode(t or []) for t in tokens]]

    return map_rows(encoded.select("id", "ids"), run, f"id {kind}, ids array<int>, decoded binary", 256)


def round_trip(
    docs: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """As :func:`decode` of :func:`encode`, in one pass of the same workers."""
    codec = _codec(docs.sparkSession, path, pattern)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(ids, texts):
        tokens = [codec().encode(t) for t in texts]
        return [ids, tokens, [codec().decode(t) for t in tokens]]

    rows = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")))
    return map_rows(rows, run, f"id {kind}, ids array<int>, decoded binary", 128)


def digests(decoded: DataFrame) -> DataFrame:
    return decoded.select(
        F.col("id").alias("doc_id"),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op6(spark, sf_dir: str) -> DataFrame:
    return digests(round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS)))
