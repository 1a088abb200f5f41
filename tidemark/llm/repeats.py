"""Windows that recur across documents: the shuffle plan shared by suffix-array and substring dedup.

Documents are dealt to chunks of about ``CHUNK_BYTES`` and cut into units (bytes or words). Among the
grams of a window the one with the least hash is its minimizer; neighbouring windows with the same
one form a run. Equal windows have equal minimizers, so they meet in the bucket of that hash, and a
run whose minimizer occurs nowhere else holds no repeated window. The steps, each a shuffle of packed
arrays by chunk or bucket:

1. chunk -> bucket: the distinct minimizers of a chunk; bucket -> chunk: which of them recur.
2. chunk -> bucket: distinct recurring runs (a chunk's copies fall together); bucket -> chunk: whose
   content is wanted (one chunk each).
3. chunk -> bucket: that content; the bucket resolves its windows; bucket -> chunk: the results.
4. The chunk joins results with its documents.

A bucket holds a run once per chunk at most, however many copies there are. A minimizer with more than
``HOT_RUNS`` different runs, counted up to 255 in each chunk, is split before any content is shipped: its
runs fall apart into single windows, which are dealt by their own hash. So a line that stands in
every document, each time among other text, does not meet in one task. Nothing is collected to the driver but the total length of the texts.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import as_bytes, materialise

CHUNK_BYTES = 4 << 20
SLICE_BYTES = 1 << 20
#: Distinct runs of one minimizer beyond which they are split.
HOT_RUNS = 512
#: Stretches are hashed by a polynomial modulo 2^64. From 1,024 units on, known pairs of stretches collide
#: under any odd factor; a run is shorter than two windows.
LONGEST = 500
LOW = np.uint64((1 << 24) - 1)
FACTOR = 0x9E3779B97F4A7C15
BYTE = np.random.default_rng(7).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
MASKS, WANTED, RESULTS = 0, 1, 2
_NOTE = "chunk int, bucket int, kind int, a binary, b binary"
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the factor and of its inverse modulo 2^64."""
    if len(_POWERS[0]) < n:
        size = max(n, 2 * len(_POWERS[0]))
        for i, base in enumerate((FACTOR, pow(FACTOR, -1, 1 << 64))):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _POWERS[i] = np.cumprod(steps)
    return _POWERS[0][:n], _POWERS[1][:n]


def prefix(values: np.ndarray) -> np.ndarray:
    out = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * powers(len(values))[0], out=out[1:])
    return out


def rolled(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the stretches [start, end); equal stretches have equal hashes wherever they stand."""
    return mixed((sums[ends] - sums[starts]) * powers(len(sums))[1][starts])


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words (between ASCII blanks) of all texts in a row, and the number of each text's words.

    A word is read in lanes of eight bytes; each lane is mixed with its place in the word before the
    lanes are added, and the sum with the length. No polynomial of the bytes is involved, under which
    words such as the Thue-Morse sequence and its complement would meet.
    """
    joint = b"\n".join(texts) + b"\n"
    raw = np.frombuffer(joint + bytes(8), dtype=np.uint8)
    text = raw[: len(joint)]
    blank = (text == 32) | ((text >= 9) & (text <= 13))
    edge = np.diff(np.concatenate([[True], blank]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    bounds = np.cumsum([len(t) + 1 for t in texts])
    counts = np.diff(np.concatenate([[0], np.searchsorted(starts, bounds)]))
    if not len(starts):
        return np.zeros(0, np.uint64), counts
    sizes = ends - starts
    eights = np.ndarray(len(joint) + 1, dtype="<u8", buffer=raw, strides=(1,))
    values = np.zeros(len(starts), np.uint64)
    left, lane = np.arange(len(starts)), 0
    while len(left):
        inside = np.minimum(sizes[left] - 8 * lane, 8).astype(np.uint64)
        part = eights[starts[left] + 8 * lane] & (~np.uint64(0) >> ((np.uint64(8) - inside) * np.uint64(8)))
        values[left] += mixed(part + mixed(np.full(1, lane + 1, np.uint64) * np.uint64(FACTOR)))
        lane += 1
        left = left[sizes[left] > 8 * lane]
    return mixed(values + sizes.astype(np.uint64) * np.uint64(FACTOR)), counts


@dataclass
class Runs:
    """Runs of windows with the same minimizer: document, first window, windows, minimizer, content hash."""

    doc: np.ndarray
    first: np.ndarray
    n: np.ndarray
    key: np.ndarray
    content: np.ndarray

    def __getitem__(self, at) -> Runs:
        return Runs(self.doc[at], self.first[at], self.n[at], self.key[at], self.content[at])


def joined(parts: list[Runs]) -> Runs:
    return Runs(*(np.concatenate([getattr(p, f) for p in parts]) for f in Runs.__dataclass_fields__))


NO_RUNS = Runs(*(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64)))


def runs(values: np.ndarray, lengths: np.ndarray, window: int, gram: int) -> Runs:
    """Runs of the texts whose units stand one after another in ``values``."""
    count = len(values) - window + 1
    if count < 1:
        return NO_RUNS
    owner = np.repeat(np.arange(len(lengths)), lengths)
    begins = np.concatenate([[0], np.cumsum(lengths)])
    sums = prefix(values)
    at = np.arange(len(values) - gram + 1)
    hashes = rolled(sums, at, at + gram)
    low = (hashes & ~LOW) | (at.astype(np.uint64) & LOW)
    width, step = window - gram + 1, 1
    while step * 2 <= width:
        low = np.minimum(low[:-step], low[step:])
        step *= 2
    if width > step:
        low = np.minimum(low[: len(low) - (width - step)], low[width - step :])
    here = np.arange(count, dtype=np.uint64)
    place = here + ((low - here) & LOW)
    valid = owner[:count] == owner[window - 1 :]
    same = (place[1:] == place[:-1]) & valid[:-1] & valid[1:]
    first = np.flatnonzero(valid & ~np.concatenate([[False], same]))
    last = np.flatnonzero(valid & ~np.concatenate([same, [False]]))
    doc = owner[first]
    content = rolled(sums, first, last + window)
    return Runs(doc, first - begins[doc], last - first + 1, hashes[place[first].astype(np.int64)], content)


@dataclass
class Method:
    """What differs between operators that share the plan.

    ``by_document`` asks for windows in different documents, not just in different places. ``resolve``
    gets the classes of a bucket (``Classes``) and returns (per class a number, array of (class,
    window, number)) for the chunks; ``finish`` turns a chunk's runs and their results into rows.
    """

    window: int
    gram: int
    words: bool
    by_document: bool
    schema: str
    types: list = field(default_factory=list)

    def units(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        if self.words:
            return word_hashes(texts)
        return BYTE[np.frombuffer(b"".join(texts), dtype=np.uint8)], np.array([len(t) for t in texts], dtype=np.int64)

    def attributes(self, run_doc: np.ndarray, ids: list) -> np.ndarray:
        """Per run the number that is summed or minimised over equal runs."""
        raise NotImplementedError

    def merge(self, numbers: np.ndarray, groups: np.ndarray, count: int) -> np.ndarray:
        raise NotImplementedError

    def wanted(self, keys: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Which classes (sorted by key) must show their content."""
        raise NotImplementedError

    def resolve(self, classes: Classes) -> tuple[np.ndarray, np.ndarray]:
        raise NotImplementedError

    def finish(self, ids: list, texts: list[bytes], units: Runs, numbers: np.ndarray, extra: np.ndarray) -> list[list]:
        raise NotImplementedError


@dataclass
class Classes:
    """Distinct runs of a bucket: key, merged number, and of the wanted ones windows and content in units."""

    key: np.ndarray
    number: np.ndarray
    wanted: np.ndarray
    n: np.ndarray
    units: np.ndarray


def scan(texts: list[bytes], method: Method) -> tuple[Runs, np.ndarray, np.ndarray]:
    """Runs of all texts of a chunk, a slice at a time; for words also their hashes and each text's first."""
    parts, at = [NO_RUNS], 0
    hashed, counts = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)]
    while at < len(texts):
        size, end = 0, at
        while end < len(texts) and (end == at or size + len(texts[end]) <= SLICE_BYTES):
            size += len(texts[end])
            end += 1
        values, lengths = method.units(texts[at:end])
        found = runs(values, lengths, method.window, method.gram)
        found.doc += at
        if method.words:
            hashed.append(values)
            counts.append(lengths)
        parts.append(found)
        at = end
    return joined(parts), np.concatenate(hashed), np.cumsum(np.concatenate(counts))


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)


def pack(docs: DataFrame, id_col: str, text_col: str, chunks: int) -> DataFrame:
    """(chunk, docs binary): documents dealt to chunks by hash, compressed for the shuffle."""

    def run(batches):
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                ids, texts = (c.to_pylist() for c in part.columns)
                place = np.array([zlib.crc32(t, zlib.crc32(repr(i).encode())) % chunks for i, t in zip(ids, texts)])
                order = np.argsort(place, kind="stable")
                names, starts = np.unique(place[order], return_index=True)
                blobs = []
                for a, b in zip(starts, [*starts[1:], len(order)]):
                    own = part.take(pa.array(order[a:b]))
                    sink = pa.BufferOutputStream()
                    with pa.ipc.new_stream(sink, own.schema, options=options) as writer:
                        writer.write_batch(own)
                    blobs.append(sink.getvalue().to_pybytes())
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), pa.array(blobs, pa.binary())], names=["chunk", "docs"])

    rows = docs.select(F.col(id_col).alias("id"), as_bytes(text_col).alias("text"))
    return rows.mapInArrow(run, "chunk int, docs binary")


def unpack(group: pa.Table) -> tuple[list, list[bytes]]:
    """Ids and texts of a chunk in a fixed order; equal rows cannot be told apart, so their order is free."""
    ids, texts = [], []
    for blob in group.column("docs"):
        with pa.ipc.open_stream(blob.as_buffer()) as reader:
            for batch in reader:
                ids += batch.column(0).to_pylist()
                texts += batch.column(1).to_pylist()
    order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, 0 if ids[i] is None else ids[i], texts[i]))
    return [ids[i] for i in order], [texts[i] for i in order]


def by_bucket(keys: np.ndarray, buckets: int):
    """Sorted distinct keys as (bucket, slice) pieces; keys must be sorted by (bucket, key)."""
    place = bucket_of(keys, buckets)
    names, starts = np.unique(place, return_index=True)
    return [(int(b), slice(int(x), int(y))) for b, x, y in zip(names, starts, [*starts[1:], len(keys)])]


def distinct_keys(found: Runs, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct minimizers in order of (bucket, key), and for each run its place among them."""
    keys, inverse = np.unique(found.key, return_inverse=True)
    order = np.lexsort((keys, bucket_of(keys, buckets)))
    back = np.empty(len(order), dtype=np.int64)
    back[order] = np.arange(len(order))
    return keys[order], back[inverse]


def bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def flags(raw: bytes, count: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(raw, np.uint8), count=count).astype(bool)


def batch(schema: list[tuple[str, pa.DataType]], rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.table({n: pa.array(list(c), t) for (n, t), c in zip(schema, columns)})


NOTE = [("chunk", pa.int32()), ("bucket", pa.int32()), ("kind", pa.int32()), ("a", pa.binary()), ("b", pa.binary())]
KEYS = [("bucket", pa.int32()), ("chunk", pa.int32()), ("keys", pa.binary()), ("multi", pa.binary()), ("runs", pa.binary())]
CLASS = [("bucket", pa.int32()), ("chunk", pa.int32()), ("keys", pa.binary()), ("contents", pa.binary()), ("numbers", pa.binary()),
         ("wanted", pa.binary()), ("n", pa.binary()), ("units", pa.binary())]
_CLASS = "bucket int, chunk int, keys binary, contents binary, numbers binary, wanted binary, n binary, units binary"


class Local:
    """A chunk's recurring runs, their classes in order of (bucket, key, content), each with a first run."""

    def __init__(self, group: pa.Table, notes: pa.Table, method: Method, buckets: int):
        self.ids, self.texts = unpack(group)
        self.notes = {(r["kind"], r["bucket"]): (r["a"], r["b"]) for r in notes.to_pylist()}
        found, self.values, self.begins = scan(self.texts, method)
        keys, place = distinct_keys(found, buckets)
        recur, hot = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
        for bucket, own in by_bucket(keys, buckets):
            a, b = self.notes.get((MASKS, bucket), (b"", b""))
            recur[own], hot[own] = (flags(x, own.stop - own.start) if x else False for x in (a, b))
        plain = found[recur[place] & ~hot[place]]
        self.units = joined([plain, self.split(found[recur[place] & hot[place]], method)])
        order = np.lexsort((self.units.content, self.units.key, bucket_of(self.units.key, buckets)))
        self.units = self.units[order]
        k, c = self.units.key, self.units.content
        new = np.concatenate([[True], (k[1:] != k[:-1]) | (c[1:] != c[:-1])]) if len(k) else np.zeros(0, bool)
        self.cls = np.cumsum(new) - 1
        self.first = np.flatnonzero(new)
        self.pieces = by_bucket(k[self.first], buckets)
        numbers = method.attributes(self.units.doc, self.ids)
        self.numbers = method.merge(numbers, self.cls, len(self.first))

    def split(self, hot: Runs, method: Method) -> Runs:
        """Hot runs as single windows under the hash of the window."""
        parts = [NO_RUNS]
        if not len(hot.doc):
            return NO_RUNS
        shipped, lengths = self.content(hot, method), hot.n + method.window - 1
        for doc, first, n, values in zip(hot.doc, hot.first, hot.n, np.split(shipped, np.cumsum(lengths)[:-1])):
            values, at = values if method.words else BYTE[values], np.arange(n)
            key = mixed(rolled(prefix(values), at, at + method.window) + np.uint64(1))
            parts.append(Runs(np.full(n, doc), first + at, np.ones(n, np.int64), key, np.zeros(n, np.uint64)))
        return joined(parts)


    def content(self, picked: Runs, method: Method) -> np.ndarray:
        """The windows of runs as they are shipped, one run after another: word hashes or bytes."""
        size = picked.n + method.window - 1
        if method.words:
            start = self.begins[picked.doc] + picked.first
            return self.values[spread_out(start, start + size)[1]]
        parts = [self.texts[d][f : f + n] for d, f, n in zip(picked.doc.tolist(), picked.first.tolist(), size.tolist())]
        return np.frombuffer(b"".join(parts), np.uint8)


def find(docs: DataFrame, method: Method, id_col: str, text_col: str) -> DataFrame:
    """Rows of ``method.finish`` for every document."""
    if not 0 < method.window <= LONGEST:
        raise ValueError(f"a window has 1 to {LONGEST} units")
    total = docs.agg(F.sum(F.octet_length(F.col(text_col)).cast("long"))).first()[0] or 0
    chunks = max(1, -(-total // CHUNK_BYTES))
    hot_runs = HOT_RUNS
    packed = pack(docs, id_col, text_col, chunks)

    def census(group: pa.Table) -> pa.Table:
        _, texts = unpack(group)
        found = scan(texts, method)[0]
        keys, place = distinct_keys(found, chunks)
        if method.by_document:
            order = np.lexsort((found.doc, place))
            p, d = place[order], found.doc[order]
            fresh = np.concatenate([[True], (p[1:] != p[:-1]) | (d[1:] != d[:-1])]) if len(p) else np.zeros(0, bool)
            many = np.bincount(p[fresh], minlength=len(keys)) > 1
        else:
            many = np.bincount(place, minlength=len(keys)) > 1
        order = np.lexsort((found.content, place))
        p, c = place[order], found.content[order]
        fresh = np.concatenate([[True], (p[1:] != p[:-1]) | (c[1:] != c[:-1])]) if len(p) else np.zeros(0, bool)
        different = np.minimum(np.bincount(p[fresh], minlength=len(keys)), 255).astype(np.uint8)
        chunk = group.column("chunk")[0].as_py()
        return batch(
            KEYS,
            [(b, chunk, keys[own].tobytes(), bits(many[own]), different[own].tobytes()) for b, own in by_bucket(keys, chunks)],
        )

    def recurring(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        lists = [np.frombuffer(r["keys"], np.uint64) for r in rows]
        keys, inverse = np.unique(np.concatenate(lists), return_inverse=True)
        spread = np.bincount(inverse, minlength=len(keys))
        many = np.concatenate([flags(r["multi"], len(x)) for r, x in zip(rows, lists)])
        recur = (spread > 1) | (np.bincount(inverse, weights=many, minlength=len(keys)) > 0)
        different = np.concatenate([np.frombuffer(r["runs"], np.uint8) for r in rows])
        hot = recur & (np.bincount(inverse, weights=different, minlength=len(keys)) > hot_runs)
        ends = np.cumsum([len(x) for x in lists])
        out = []
        for r, x, end in zip(rows, lists, ends):
            own = inverse[end - len(x) : end]
            if recur[own].any():
                out.append((r["chunk"], r["bucket"], MASKS, bits(recur[own]), bits(hot[own]) if hot[own].any() else b""))
        return batch(NOTE, out)

    keys = packed.groupBy("chunk").applyInArrow(census, "bucket int, chunk int, keys binary, multi binary, runs binary")
    masks = materialise(keys.groupBy("bucket").applyInArrow(recurring, _NOTE), "masks")

    def classes(group: pa.Table, notes: pa.Table) -> pa.Table:
        if not group.num_rows:
            return batch(CLASS, [])
        local = Local(group, notes, method, chunks)
        chunk, out = group.column("chunk")[0].as_py(), []
        for bucket, own in local.pieces:
            heads = local.units[local.first[own]]
            want, n, units = b"", b"", b""
            if (WANTED, bucket) in local.notes:
                asked = flags(local.notes[WANTED, bucket][0], own.stop - own.start)
                picked = heads[asked]
                want, n = bits(asked), picked.n.astype(np.int32).tobytes()
                units = local.content(picked, method).tobytes()
            out.append((bucket, chunk, heads.key.tobytes(), heads.content.tobytes(), local.numbers[own].tobytes(), want, n, units))
        return batch(CLASS, out)

    def merged(rows: list[dict]):
        """Classes of a bucket over all chunks: key, first, number, class of every entry, ends of the rows."""
        k = np.concatenate([np.frombuffer(r["keys"], np.uint64) for r in rows])
        c = np.concatenate([np.frombuffer(r["contents"], np.uint64) for r in rows])
        v = np.concatenate([np.frombuffer(r["numbers"], np.int64) for r in rows])
        order = np.lexsort((np.arange(len(k)), c, k))
        new = np.concatenate([[True], (k[order][1:] != k[order][:-1]) | (c[order][1:] != c[order][:-1])])
        cls = np.empty(len(k), np.int64)
        cls[order] = np.cumsum(new) - 1
        first = order[new]
        ends = np.cumsum([len(r["keys"]) // 8 for r in rows])
        return k[first], first, method.merge(v, cls, len(first)), cls, ends

    def choose(group: pa.Table) -> pa.Table:
        rows = sorted(group.select(["bucket", "chunk", "keys", "contents", "numbers"]).to_pylist(), key=lambda r: r["chunk"])
        key, first, _, cls, ends = merged(rows)
        asked = np.zeros(len(cls), bool)
        asked[first[method.wanted(key, first)]] = True
        out = []
        for r, end in zip(rows, ends):
            own = asked[end - len(r["keys"]) // 8 : end]
            if own.any():
                out.append((r["chunk"], r["bucket"], WANTED, bits(own), b""))
        return batch(NOTE, out)

    def settle(group: pa.Table) -> pa.Table:
        rows = sorted(group.to_pylist(), key=lambda r: r["chunk"])
        key, _, number, cls, ends = merged(rows)
        wanted, ns, units = [], [], []
        for r, end in zip(rows, ends):
            if r["wanted"]:
                size = len(r["keys"]) // 8
                wanted.append(cls[end - size : end][flags(r["wanted"], size)])
                ns.append(np.frombuffer(r["n"], np.int32))
                units.append(np.frombuffer(r["units"], np.uint64 if method.words else np.uint8))
        empty = np.zeros(0, np.int64)
        numbers, extra = method.resolve(Classes(
            key, number, np.concatenate([empty, *wanted]), np.concatenate([empty, *ns]).astype(np.int64),
            np.concatenate([np.zeros(0, np.uint64 if method.words else np.uint8), *units]),
        ))
        extra = extra[np.argsort(extra[:, 0], kind="stable")]
        lo, hi = np.searchsorted(extra[:, 0], cls), np.searchsorted(extra[:, 0], cls, "right")
        out = []
        for r, end in zip(rows, ends):
            own = slice(end - len(r["keys"]) // 8, end)
            more = spread_out(lo[own], hi[own])
            told = np.column_stack([more[0], extra[more[1], 1:]]).astype(np.int64)
            out.append((r["chunk"], r["bucket"], RESULTS, numbers[cls[own]].astype(np.int64).tobytes(), told.tobytes()))
        return batch(NOTE, out)

    def finish(group: pa.Table, notes: pa.Table) -> pa.Table:
        if not group.num_rows:
            return batch(method.types, [])
        local = Local(group, notes, method, chunks)
        numbers = np.zeros(len(local.first), np.int64)
        extra = [np.zeros((0, 3), np.int64)]
        for bucket, own in local.pieces:
            a, b = local.notes[RESULTS, bucket]
            numbers[own] = np.frombuffer(a, np.int64)
            told = np.frombuffer(b, np.int64).reshape(-1, 3).copy()
            told[:, 0] += own.start
            extra.append(told)
        extra = np.concatenate(extra)
        # From classes to this chunk's runs of that class, which stand together.
        lo, hi = np.searchsorted(local.cls, extra[:, 0]), np.searchsorted(local.cls, extra[:, 0], "right")
        row, unit = spread_out(lo, hi)
        each = np.column_stack([unit, extra[row, 1:]])
        columns = method.finish(local.ids, local.texts, local.units, numbers[local.cls], each)
        return pa.table({n: pa.array(c, t) for (n, t), c in zip(method.types, columns)})

    def told(*notes: DataFrame) -> DataFrame:
        out = masks
        for n in notes:
            out = out.unionByName(n)
        return out

    def with_notes(fn, schema: str, *notes: DataFrame) -> DataFrame:
        return packed.groupBy("chunk").cogroup(told(*notes).groupBy("chunk")).applyInArrow(fn, schema)

    asked = with_notes(classes, _CLASS).groupBy("bucket").applyInArrow(choose, _NOTE)
    results = with_notes(classes, _CLASS, asked).groupBy("bucket").applyInArrow(settle, _NOTE)
    return with_notes(finish, method.schema, results)


def spread_out(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All (i, x) with lo[i] <= x < hi[i]."""
    sizes = hi - lo
    row = np.repeat(np.arange(len(lo)), sizes)
    before = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    return row, np.arange(len(row)) - before[row] + lo[row]


def covered(docs: int, doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[list[tuple[int, int]]]:
    """Per document the united stretches of [start, end)."""
    out: list[list[tuple[int, int]]] = [[] for _ in range(docs)]
    for i in np.lexsort((end, start, doc)).tolist():
        own, a, b = out[doc[i]], int(start[i]), int(end[i])
        if own and a <= own[-1][1]:
            own[-1] = (own[-1][0], max(b, own[-1][1]))
        else:
            own.append((a, b))
    return out
