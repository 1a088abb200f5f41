"""Toxicity by weak supervision: many noisy voters, a generative label model, a linear classifier.

1. Voters. Fixed word lists, lists of words and word beginnings mined from labelled rows (a gram votes
   once it stands in a text often enough), text patterns, voters for clean texts, and the label itself
   vote toxic, clean or abstain. One Aho-Corasick pass over each whole text finds all grams.
2. Label model. One pass over the votes of all learnable rows counts how often each pair of voters casts
   each pair of votes: a matrix of a few thousand numbers, whatever the corpus holds. Expectation
   maximisation on these pairs estimates the class balance and, per voter, the chance of each vote
   in toxic and in clean texts. What pairs agree on beyond the model is their correlation; strongly
   correlated pairs are left out, the model is fitted again, and in a posterior the votes of
   a voter count less the more it repeats others. No voter is believed as such, the label included.
3. Classifier. Logistic regression on the capped counts of grams, list totals and patterns is fitted
   to the posterior labels of a bounded sample and scores every text.

Labels are read only from learnable rows; a score depends on the text alone. Bounds: ``MINED_TEXTS``
labelled rows of each label are mined, ``MINED_GRAMS`` grams kept, ``FIT_ROWS`` rows with and as many
without a toxic vote fit the classifier. All else covers every row. Texts pass a task one by one and
are never shuffled but for the mined sample.

Defined cases: a null text is the empty text, which scores as a text without any gram; rows with a
null id are never learned from; several label rows of one id count as toxic if any is; a null label
abstains; repeated rows are scored alike; equal gram evidence is ordered by the gram; without labels
the fixed lists remain; very long texts are read whole; an empty table gives no rows. Columns are
selected first, so other columns may have any name.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import as_bytes, map_rows, materialise, once, plain, table

MINED_TEXTS = 5_000
MINED_GRAMS = 400
FIT_ROWS = 10_000
#: Characters of the word beginnings that are mined.
BEGINNINGS = (4, 5, 6, 7, 8)
#: A mined gram votes at one, two or three finds in a text.
NEEDS = (1, 2, 3)
CAP = 4
LIMIT = 0.3

# Word lists of the lexicon voters.
LISTS = {
    "mind": "idiot idiots idiotic moron morons moronic stupid dumb dumbass imbecile fool fools foolish brainless retarded",
    "worth": "worthless pathetic loser losers useless failure nobody trash garbage scum filth vermin",
    "disgust": "disgusting vile filthy repulsive revolting sickening nasty",
    "ridicule": "clown clowns joke laughable ridiculous pig pigs donkey jackass",
    "contempt": "bastard bastards jerk jerks creep creeps coward cowards liar liars hypocrite",
    "hate": "hate hated hateful despise loathe",
    "threat": "kill hurt destroy punch strangle",
    "german": "idioten dumm dummkopf trottel depp arschloch abschaum wertlos ekelhaft widerlich versager",
    "french": "imbécile crétin stupide débile ordure minable abruti connard salaud dégoûtant",
    "spanish": "idiota estúpido imbécil tonto basura asqueroso inútil payaso cabrón perdedor",
}
# Words that address the reader.
ADDRESS = re.compile(r" (?:you|your|ur|du|dein|tu|vous|eres|ustedes) ")
ADDRESS_REACH = 24

MINED = tuple(f"mined_{kind}_{need}" for kind in ("word", "beginning") for need in NEEDS)
GROUPS = (*LISTS, *MINED)
PATTERNS = ("addressed", "shouting", "exclaiming", "masked", "dense", "several", "many")
CLEAN = ("no_list_word", "no_mined_gram", "no_mined_vote", "few", "calm")
LABEL = "label"
VOTERS = (*GROUPS, *PATTERNS, *CLEAN, LABEL)

_LETTERS = bytes(c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_UPPER = bytes(range(65, 91))
_MASKED = re.compile(rb"[A-Za-z][*@#$]{2,}[A-Za-z]")


def folded(text: str) -> str:
    """Lower-cased words between single or several blanks, with a blank at both ends."""
    return f" {text.lower()} ".encode("utf-8", "replace").translate(_LETTERS).decode()


def grams_of(word: str) -> list[str]:
    """What is mined of a word: itself between blanks, and its beginnings after a blank."""
    return [f" {word} ", *(f" {word[:n]}" for n in BEGINNINGS if len(word) >= n)]


# -- mining ------------------------------------------------------------------------


def mined_texts(docs: DataFrame, marks: DataFrame, most: int) -> DataFrame:
    """(text, toxic): distinct texts of at most ``most`` labelled ids per label, lowest hash first."""

    def drawn(value: int) -> DataFrame:
        return marks.where(F.col("toxic") == value).orderBy(F.xxhash64("id"), "id").limit(most)

    picked = F.broadcast(drawn(1).unionByName(drawn(0)))  # at most 2 * most rows
    texts = docs.join(picked, "id").groupBy("text").agg(F.avg("toxic").alias("toxic"))
    return texts.select("text", (F.col("toxic") >= 0.5).alias("toxic"))


def mine(texts: DataFrame, most: int = MINED_GRAMS, held: int = 200_000) -> list[tuple[str, int]]:
    """(gram, need): grams that stand at least ``need`` times in far more toxic than clean texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places: dict[str, np.ndarray] = {}

        def emit() -> pa.RecordBatch:
            figures = np.stack(list(places.values())) if places else np.zeros((0, 6), np.int64)
            columns = [pa.array(list(places), pa.string()), *(pa.array(figures[:, i]) for i in range(6))]
            places.clear()
            return pa.RecordBatch.from_arrays(columns, names=["gram", "t1", "t2", "t3", "n1", "n2", "n3"])

        for batch in batches:
            for text, toxic in zip(batch.column(0), batch.column(1)):
                at = 0 if toxic.as_py() else 3
                found: Counter[str] = Counter()
                for word, n in Counter(folded(text.as_py().decode("utf-8", "replace")).split()).items():
                    for gram in grams_of(word):
                        found[gram] += n
                found[""] = 1  # the texts themselves
                for gram, n in found.items():
                    figures = places.get(gram)
                    if figures is None:
                        figures = places[gram] = np.zeros(6, dtype=np.int64)
                    figures[at : at + min(n, 3)] += 1
                if len(places) > held:
                    yield emit()
        yield emit()

    names = [f"{side}{need}" for side in "tn" for need in NEEDS]
    rows = texts.mapInArrow(count, "gram string, " + ", ".join(f"{n} long" for n in names))
    counted = materialise(
        rows.groupBy("gram").agg(*(F.sum(n).alias(n) for n in names)).where("gram = '' OR t1 >= 5"), "grams"
    )
    totals = counted.where("gram = ''").first()
    if totals is None or not totals["t1"] or not totals["n1"]:
        return []

    def evidence(need: int) -> Column:
        """Lower bound, three standard errors down, of the log ratio of the shares of texts."""
        t, n = F.col(f"t{need}") + 0.5, F.col(f"n{need}") + 0.5
        ratio = F.log(t / n) + float(np.log((totals["n1"] + 1) / (totals["t1"] + 1)))
        return F.when(F.col(f"t{need}") >= 5, ratio - 3 * F.sqrt(1 / t + 1 / n)).otherwise(-99.0)

    # Of equal evidence the smaller need comes first.
    best = F.greatest(*(F.struct(evidence(need).alias("e"), F.lit(-need).alias("need")) for need in NEEDS))
    kept = (
        counted.where("gram <> ''").select("gram", best.alias("best")).where("best.e > ln(2)")
        .orderBy(F.col("best.e").desc(), "gram").limit(most)
    )
    return [(r["gram"], -r["best"]["need"]) for r in kept.collect()]


# -- votes and features ------------------------------------------------------------


@dataclass
class Reader:
    """Votes and features of texts; built once per worker from the mined grams."""

    mined: list[tuple[str, int]]
    grams: list[str] = field(init=False)
    uses: list[list[tuple[int, int]]] = field(init=False)

    def __post_init__(self) -> None:
        uses: dict[str, list[tuple[int, int]]] = {}
        for at, words in enumerate(LISTS.values()):
            for word in words.split():
                uses.setdefault(f" {word} ", []).append((at, 1))
        for gram, need in self.mined:
            group = GROUPS.index(f"mined_{'word' if gram.endswith(' ') else 'beginning'}_{need}")
            uses.setdefault(gram, []).append((group, need))
        self.grams, self.uses = list(uses), list(uses.values())
        self.finder = ahocorasick.Automaton()
        for at, gram in enumerate(self.grams):
            self.finder.add_word(gram, at)
        self.finder.make_automaton()

    @property
    def width(self) -> int:
        """Features: capped gram counts, capped group totals, patterns, capped number of words hit."""
        return len(self.grams) + len(GROUPS) + len(PATTERNS) + 1

    def read(self, raw: bytes) -> tuple[list[int], list[int], list[int]]:
        """Votes of all voters but the label (1, -1, 0), and the features as (places, values)."""
        words = folded(raw.decode("utf-8", "replace"))
        counts: Counter[int] = Counter()
        addressed, hits = False, set()
        for end, at in self.finder.iter(words):
            counts[at] += 1
            hits.add(end - len(self.grams[at]))  # one word, whatever the number of its grams
            addressed = addressed or bool(ADDRESS.search(words, max(0, end - ADDRESS_REACH - len(self.grams[at])), end + 1))
        reached, touched = [0] * len(GROUPS), [False] * len(GROUPS)
        for at, n in counts.items():
            for group, need in self.uses[at]:
                touched[group] = True
                reached[group] += n >= need
        letters = len(raw) - len(raw.translate(None, _UPPER + _UPPER.lower()))
        capitals = len(raw) - len(raw.translate(None, _UPPER))
        exclaims = raw.count(b"!!")
        shouting = letters >= 20 and 2 * capitals > letters
        list_hits = sum(reached[: len(LISTS)])
        mined_votes = sum(reached[len(LISTS) :])
        patterns = [
            addressed, shouting, exclaims >= 3, bool(_MASKED.search(raw)),
            bool(hits) and 50 * len(hits) > len(words.split()), len(hits) >= 2, len(hits) >= 3,
        ]
        clean = [
            list_hits == 0, not any(touched[len(LISTS) :]), mined_votes == 0, len(hits) < 3, not shouting and exclaims == 0,
        ]
        votes = [int(r > 0) for r in reached] + [int(p) for p in patterns] + [-int(c) for c in clean]
        values = {at: min(n, CAP) for at, n in counts.items()}
        base = len(self.grams)
        values |= {base + g: min(r, 2 * CAP) for g, r in enumerate(reached) if r}
        values |= {base + len(GROUPS) + i: 1 for i, p in enumerate(patterns) if p}
        if hits:
            values[self.width - 1] = min(len(hits), 2 * CAP)
        return votes, list(values), list(values.values())


SEEN = "votes array<tinyint>, places array<int>, amounts array<int>"


def read_all(docs: DataFrame, mined: list[tuple[str, int]]) -> DataFrame:
    """(id, votes, places, amounts) of every row of (id, text)."""
    held, key = docs.sparkSession.sparkContext.broadcast(mined), uuid.uuid4().hex
    kind = docs.schema["id"].dataType.simpleString()

    def look(ids, texts):
        reader = once(key, lambda: Reader(held.value))
        found = [reader.read(t) for t in texts]
        return [ids, *([f[i] for f in found] for i in range(3))]

    return map_rows(docs.select("id", "text"), look, f"id {kind}, {SEEN}")


# -- label model -------------------------------------------------------------------


def one_hot(votes: np.ndarray) -> np.ndarray:
    """(rows, 3 * voters): toxic, clean, abstained."""
    return np.stack([votes == 1, votes == -1, votes == 0], axis=2).reshape(len(votes), -1)


def pair_counts(seen: DataFrame) -> np.ndarray:
    """How often each pair of voters cast each pair of votes, over all rows with their label vote."""
    size = 3 * len(VOTERS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                rows = batch.slice(at, 4096)
                votes = rows.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(VOTERS))
                hot = one_hot(votes).astype(np.float32)
                total += hot.T @ hot
        cell = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(total.ravel()[cell].astype(np.int64))], names=["cell", "n"])

    out = np.zeros(size * size)
    for row in seen.select("votes").mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        out[row["cell"]] = row["n"]
    return out.reshape(size, size)


@dataclass
class LabelModel:
    """Class balance, chance of each vote per class and voter, and how much each voter repeats others."""

    balance: float
    chances: np.ndarray  # (2, voters, 3): clean and toxic
    correlations: np.ndarray  # (voters, voters)

    def logits(self, votes: np.ndarray) -> np.ndarray:
        ratio = np.log(self.chances[1] / self.chances[0])
        share = 1 / (1 + np.maximum(self.correlations, 0).sum(axis=1))
        return np.log(self.balance / (1 - self.balance)) + one_hot(votes) @ (ratio * share[:, None]).ravel()

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(votes), -30, 30)))


def starting_chances(counts: np.ndarray) -> np.ndarray:
    """First guess: a toxic vote is rare in clean texts, a clean vote common there; a label is mostly right."""
    start = np.zeros((2, len(VOTERS), 3))
    start[1, :] = (0.3, 0.0, 0.7)
    start[0, :] = (0.02, 0.0, 0.98)
    for name in CLEAN:
        start[1, VOTERS.index(name)] = (0.0, 0.3, 0.7)
        start[0, VOTERS.index(name)] = (0.0, 0.8, 0.2)
    own = np.diag(counts)[-3:]
    cover = float(np.clip(own[:2].sum() / max(own.sum(), 1), 0.01, 0.99))
    start[1, -1] = (0.9 * cover, 0.1 * cover, 1 - cover)
    start[0, -1] = (0.05 * cover, 0.95 * cover, 1 - cover)
    start += 1e-4
    return start / start.sum(axis=2, keepdims=True)


def fit_pairs(counts: np.ndarray, allowed: np.ndarray, balance: float, start: np.ndarray, rounds: int = 200):
    """Expectation maximisation on the allowed pairs of voters, with the start as a weak prior."""
    mask = np.kron(allowed, np.ones((3, 3)))
    table_counts = counts * mask
    chances, total = start.copy(), max(counts[:3, :3].trace(), 1.0)
    for _ in range(rounds):
        clean, toxic = chances[0].ravel(), chances[1].ravel()
        both = balance * np.outer(toxic, toxic)
        share = both / (both + (1 - balance) * np.outer(clean, clean))
        found = np.stack([(table_counts * (1 - share)).sum(axis=1), (table_counts * share).sum(axis=1)]).reshape(chances.shape)
        sums = found.sum(axis=2)
        balance = float(np.clip(sums[1].sum() / max(sums.sum(), 1e-9), 1e-4, 0.5)) if sums.sum() else balance
        # Worth one row in twenty of a class, so that a class cannot turn into something else.
        weight = 0.05 * np.maximum(sums, total * 0.01)[:, :, None]
        chances = (found + weight * start) / (sums[:, :, None] + weight)
    return balance, chances


def residual_correlations(counts: np.ndarray, balance: float, chances: np.ndarray) -> np.ndarray:
    """Correlation of each pair of voters that the classes do not explain."""
    voters, total = len(VOTERS), max(counts[:3, :3].trace(), 1.0)
    value = np.array([1.0, -1.0, 0.0])
    seen = np.einsum("iajb,a,b->ij", counts.reshape(voters, 3, voters, 3), value, value) / total
    mean = chances @ value  # (2, voters)
    spread = chances @ value**2 - mean**2
    expected = balance * np.outer(mean[1], mean[1]) + (1 - balance) * np.outer(mean[0], mean[0])
    own = np.sqrt(np.maximum(balance * spread[1] + (1 - balance) * spread[0], 1e-6))
    out = np.clip((seen - expected) / np.outer(own, own), -1, 1)
    np.fill_diagonal(out, 0)
    return out


def label_model(counts: np.ndarray, strong: float = 0.15) -> LabelModel:
    start = starting_chances(counts)
    own = np.diag(counts)[-3:]
    balance = float(np.clip((own[0] + 0.5) / (own[0] + own[1] + 10), 0.005, 0.5))
    apart = 1 - np.eye(len(VOTERS))
    correlations = residual_correlations(counts, *fit_pairs(counts, apart, balance, start))
    allowed = apart * (np.abs(correlations) < strong)
    # The label is judged apart from the texts, so its pairs always stay.
    allowed[-1, :-1] = allowed[:-1, -1] = 1
    balance, chances = fit_pairs(counts, allowed, balance, start)
    return LabelModel(balance, chances, residual_correlations(counts, balance, chances))


# -- classifier --------------------------------------------------------------------


def fit_logistic(x: np.ndarray, y: np.ndarray, weights: np.ndarray, ridge: float = 3e-4, rounds: int = 500) -> np.ndarray:
    """Weights of a ridge-penalised logistic regression on soft labels, by accelerated gradient steps; the last is the bias."""
    x = np.hstack([x, np.ones((len(x), 1), dtype=np.float32)])
    weights = weights / weights.sum()
    top = np.ones(x.shape[1])
    for _ in range(20):
        top = x.T @ (weights * (x @ top))
        length = np.linalg.norm(top)
        top = top / length if length else top
    pace = 1 / (0.25 * length + ridge)
    now = ahead = np.zeros(x.shape[1])
    momentum = 1.0
    for _ in range(rounds):
        guess = 1 / (1 + np.exp(-np.clip(x @ ahead, -30, 30)))
        slope = x.T @ (weights * (guess - y)) + ridge * np.append(ahead[:-1], 0)
        after = ahead - pace * slope
        longer = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        ahead, now, momentum = after + (momentum - 1) / longer * (after - now), after, longer
    return now


def dense(places: list, amounts: list, width: int) -> np.ndarray:
    out = np.zeros((len(places), width), dtype=np.float32)
    for row, (at, values) in enumerate(zip(places, amounts)):
        out[row, at] = values
    return out


@dataclass
class Model:
    mined: list[tuple[str, int]]
    labels: LabelModel
    weights: np.ndarray

    def score(self, places: list, amounts: list) -> list[float]:
        found = [float(self.weights[-1] + sum(self.weights[p] * a for p, a in zip(at, n))) for at, n in zip(places, amounts)]
        return (1 / (1 + np.exp(-np.clip(found, -30, 30)))).tolist()


def fit(seen: DataFrame, mined: list[tuple[str, int]], most: int = FIT_ROWS) -> Model:
    """``seen`` has the learnable rows, with the label as their last vote."""
    model = label_model(pair_counts(seen))
    hit = F.exists(F.slice("votes", 1, len(VOTERS) - 1), lambda v: v == 1)
    rows, weights = [], []
    total = {r["hit"]: r["n"] for r in seen.groupBy(hit.alias("hit")).agg(F.count(F.lit(1)).alias("n")).collect()}
    for side, n in total.items():
        # Strictly bounded; by the hash of the id, so that the draw does not depend on the partitions.
        drawn = seen.where(hit == side).orderBy(F.xxhash64("id"), "id", "places", "amounts").limit(most).collect()
        rows += drawn
        weights += [n / len(drawn)] * len(drawn)
    width = Reader(mined).width
    if not rows:
        return Model(mined, model, np.append(np.zeros(width), np.log(model.balance / (1 - model.balance))))
    y = model.posterior(np.array([r["votes"] for r in rows], dtype=np.int8))
    x = dense([r["places"] for r in rows], [r["amounts"] for r in rows], width)
    return Model(mined, model, fit_logistic(x, y, np.array(weights, dtype=float)))


def held_out(id_col: str = "id") -> Column:
    """Rows whose labels are never read: crc32 of the id as text leaves 2 by 4; so do rows without an id."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(True))


def predict(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id",
    label_col: str = "toxic", limit: float = LIMIT, held: Column | None = None,
) -> DataFrame:
    """(id, held_out, score, predicted) per document, learned from the rows that are not held out."""
    apart = held_out() if held is None else held
    texts = docs.select(F.col(id_col).alias("id"), as_bytes(text_col).alias("text"))
    marks = (
        labels.select(F.col(label_id).alias("id"), F.col(label_col).cast("int").alias("toxic"))
        .where(F.col("toxic").isin(0, 1) & ~apart)
        .groupBy("id").agg(F.max("toxic").alias("toxic"))
    )
    mined = mine(mined_texts(texts, marks, MINED_TEXTS))
    seen = materialise(read_all(texts, mined), "votes")
    vote = F.when(F.col("toxic") == 1, 1).when(F.col("toxic") == 0, -1).otherwise(0).cast("tinyint")
    learnable = seen.where(~apart).join(marks, "id", "left").withColumn("votes", F.concat("votes", F.array(vote))).drop("toxic")
    model = fit(materialise(learnable, "learnable"), mined)
    held_model, key = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex
    kind = texts.schema["id"].dataType.simpleString()

    def score(ids, apart, places, amounts):
        scores = once(key, lambda: held_model.value).score(places, amounts) if ids else []
        return [ids, apart, scores, [int(s >= limit) for s in scores]]

    return map_rows(
        plain(seen.select("id", apart, "places", "amounts")), score, f"id {kind}, held_out boolean, score double, predicted int"
    )


def op13(spark, sf_dir: str) -> DataFrame:
    found = predict(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.withColumnRenamed("id", "doc_id")
