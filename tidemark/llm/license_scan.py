"""Licence paragraphs, with DataFrame functions and a trained linear model that runs on the JVM.

A paragraph is what lies between blank lines; its wrapped lines are read as one run of words. A notice
is a window of that run, up to ``STRETCH`` times as long as a template, so that words may be put in.
Each template has windows of its own, hence a paragraph can give several families. Features are the
word 1- to 3-grams of the licence templates that hold a key word; the logistic regression over their
counts is sparse (elastic net). A text without a key word has no feature at all and scores as the
unknown class, so the key words sift texts before anything is counted, without a change of result. A
family is reported if

* a window holds at least ``containment`` of the word pairs of one of the family's templates, and no
  overlapping sure window of the family holds a larger part (or the same in fewer words), and
* the words of that window are guessed as the family, with a calibrated probability that passes the
  limit learned on the half of the examples kept from training (halfway between the surest unknown and
  the least sure licence, at least one half).

Training examples are the templates and further wordings, alone and between words of the corpus. The
unknown class is learned from a bounded sample of the corpus (at most ``SAMPLE`` windows of ``WINDOW`` words
around a key word that hold less than half of what makes a notice) and from sentences that speak of
licences without giving one. The limit is set on wordings, windows and sentences kept from training.

Defined cases: null and empty texts have no paragraphs; repeated rows are rows of their own, also with
a repeated or null id; an empty corpus trains on the templates and sentences; equal windows go to the
first; very long texts take time in proportion to words and notices; extra columns are not read.
"""

from __future__ import annotations

import math
import re

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import running, table

SAMPLE = 400
UNKNOWN = "unknown"
CONTAINMENT = 0.6
STRETCH = 2
#: A line with its line ends, and the line ends that close a paragraph.
LINE = "[^\\r\\n]+[\\r\\n]*|[\\r\\n]+"
LINE_END = "(?:\\r\\n|\\n|\\r(?!\\n))"
BLANK = f"{LINE_END}(?:[^\\S\\r\\n]*{LINE_END})+"

#: Licence families and short forms of their notices, as they are printed.
TEMPLATES = {
    "agpl": (
        "Licensed under the GNU Affero General Public License, version 3.",
        "You should have received a copy of the GNU Affero General Public License along with this program.",
    ),
    "apache": (
        "Licensed under the Apache License, Version 2.0.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS",
    ),
    "bsd": (
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    ),
    "cc-by": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "cc-by-sa": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
        "You should have received a copy of the GNU General Public License along with this program.",
    ),
    "isc": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",),
    "lgpl": (
        "This library is licensed under the GNU Lesser General Public License, version 3.",
        "You should have received a copy of the GNU Lesser General Public License along with this library.",
    ),
    "mit": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    "mpl": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",),
    "public-domain": ("This is free and unencumbered software released into the public domain.",),
}
#: Words of which every feature holds at least one.
KEY_WORDS = (
    "licensed", "license", "licenses", "licence", "released", "redistribution", "redistribute", "permission",
    "granted", "redistributions", "cc", "gnu", "apache", "mit", "bsd", "mozilla", "commons", "unencumbered", "copyright",
)
#: Further wordings of each family. The first and third are kept from training and set the probability limit.
WORDINGS = {
    "agpl": (
        "Distributed under the terms of the GNU Affero General Public License, version 3 or later.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License",
    ),
    "apache": (
        "Distributed under the terms of the Apache License, Version 2.0.",
        "This file is licensed to You under the Apache License, Version 2.0; you may not use it except in compliance with the License.",
    ),
    "bsd": (
        "Use of this source code is governed by the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms are permitted under the BSD License.",
    ),
    "cc-by": (
        "The text is available under the Creative Commons Attribution 4.0 International License.",
        "This document is released under CC BY 4.0.",
    ),
    "cc-by-nc": (
        "The text is available under the Creative Commons Attribution-NonCommercial 4.0 International License.",
        "This document is released under CC BY-NC 4.0.",
    ),
    "cc-by-sa": (
        "The text is available under the Creative Commons Attribution-ShareAlike 4.0 International License.",
        "This document is released under CC BY-SA 4.0.",
    ),
    "gpl": (
        "Distributed under the terms of the GNU General Public License, version 3 or later.",
        "This file is licensed under the terms of the GNU General Public License.",
    ),
    "isc": (
        "Permission to use, copy, and distribute this software for any purpose without fee is granted",
        "Permission to use, copy, modify and distribute this software for any purpose is hereby granted",
    ),
    "lgpl": (
        "Distributed under the terms of the GNU Lesser General Public License, version 3 or later.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
    ),
    "mit": ("This file is licensed under the MIT License.", "Distributed under the terms of the MIT License."),
    "mpl": (
        "The contents of this file are subject to the terms of the Mozilla Public License, version 2.0.",
        "Licensed under the terms of the Mozilla Public License, v. 2.0.",
    ),
    "public-domain": (
        "This free and unencumbered work is released into the public domain.",
        "It is unencumbered software and was released into the public domain.",
    ),
}
#: Sentences that speak of licences without giving one.
NOT_NOTICES = (
    "The driver showed a license to the officer.", "He was released under the bridge.", "Permission is needed to enter the house.",
    "The work of the public is general.", "A license fee was paid at the office.", "The house was released in the second version.",
    "The license of the driver was licensed by the public office.", "A copy of the license hangs in the hall.",
    "Permission is hereby refused to any person without a ticket.", "The film was released into the public cinemas.",
    "The copyright notice of the book is on the first page.", "The commons are open to the public.",
    "The album was released into the shops of the city.", "Redistribution of the land was the work of the council.",
    "The software was released with a manual and a version number.", "Nobody gave permission to copy the paintings.",
    "The apache people are licensed guides of the domain.", "The general license of the state is free.",
    "A free copy of the program was released to the public.", "The terms of the license were discussed in the house of commons.",
)
#: Words of a sampled line that are kept, from this many before its first key word.
WINDOW, LEAD = 40, 20


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda w: w != "")


def grams(ws: Column) -> Column:
    """1- to 3-grams of words that hold a key word; "_" joins the words."""
    keys = F.array(*map(F.lit, KEY_WORDS))
    n = F.size(ws)

    def of_size(k: int) -> Column:
        starts = F.when(n >= k, F.sequence(F.lit(1), n - (k - 1))).otherwise(F.array().cast("array<int>"))
        parts = F.transform(starts, lambda i: F.slice(ws, i, k))
        return F.transform(F.filter(parts, lambda p: F.arrays_overlap(p, keys)), lambda p: F.array_join(p, "_"))

    return F.concat(of_size(1), of_size(2), of_size(3))


def blocks(text: Column) -> Column:
    """The paragraphs of a text: what lies between blank lines."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), BLANK), lambda x: x.rlike("\\S"))


def paragraphs(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, place, line): the lines of every text that holds a key word, of which training draws its sample."""
    texts = docs.where(F.col(text_col).rlike(key_pattern()))
    return texts.select(F.col(id_col).alias("id"), F.posexplode(F.split(text_col, "[\\r\\n]+")).alias("place", "line"))


def template_rows(spark) -> DataFrame:
    rows = [(family, text) for family, texts in TEMPLATES.items() for text in texts]
    return spark.createDataFrame(rows, "family string, template string")


def templates(containment: float) -> Column:
    """Every template with its word pairs and the number of them that makes a notice."""
    return F.array(*(
        F.struct(F.lit(family).alias("family"), F.lit(STRETCH * n).alias("span"), F.array(*map(F.lit, pairs)).alias("pairs"),
                 F.lit(math.ceil(containment * len(pairs))).alias("need"))
        for family, n, pairs in wanted()
    ))


def unlike(lines: DataFrame, rows: int) -> list[str]:
    """At most ``rows`` windows of words with a key word, far from every template.

    Windows are hashed into ``rows`` bins and the least hash of a bin stays, so a line that is repeated
    throughout the corpus counts once, and a task ships a row per bin at most.
    """
    split = with_words(lines.where(F.col("line").rlike(key_pattern())))
    at = F.array_position(F.transform("ws", lambda w: w.isin(*KEY_WORDS)), True).cast("int")
    near = split.withColumn("win", once(F.slice("ws", F.greatest(at - LEAD, F.lit(1)), WINDOW)))
    pairs = F.transform("win", lambda w, i: F.concat(w, F.lit("_"), F.coalesce(F.get("win", i + 1), F.lit(""))))
    paired = near.withColumn("pairs", once(pairs))
    far = paired.where(~F.exists(templates(CONTAINMENT / 2), lambda t: F.size(F.array_intersect(t["pairs"], F.col("pairs"))) >= t["need"]))
    hashed = far.select(F.array_join("win", " ").alias("line")).withColumn("h", F.xxhash64("line"))
    drawn = hashed.groupBy(F.pmod("h", F.lit(rows)).alias("bin")).agg(F.min(F.struct("h", "line")).alias("least"))
    return sorted(r["line"] for r in drawn.select("least.line").collect())


def examples(spark, lines: DataFrame, rows: int) -> DataFrame:
    """(family, line, fold): notices alone and with words around them, and unknown windows.

    Fold 1 holds wordings, sampled windows and sentences that fold 0 does not hold.
    """
    drawn = unlike(lines, rows)
    around = [" ".join(line.split()[:8]) for line in drawn] or [""]
    out = [(UNKNOWN, line, i % 2) for i, line in enumerate(drawn)]
    out += [(UNKNOWN, line, i % 2) for i, line in enumerate(NOT_NOTICES) for _ in range(8)]
    for family, texts in TEMPLATES.items():
        known = [(text, 0) for text in texts] + [(text, (k + 1) % 2) for k, text in enumerate(WORDINGS[family])]
        for text, fold in known:
            out += [(family, f"{around[i % len(around)]} {text} {around[(i + 1) % len(around)]}" if i > 1 else text, fold) for i in range(8)]
    return spark.createDataFrame(out, "family string, line string, fold int")


def key_pattern() -> str:
    return r"(?i)\b(" + "|".join(KEY_WORDS) + r")\b"


def once(expression: Column) -> Column:
    """A generator of one row: what it yields is computed once, however often it is used."""
    return F.explode(F.array(expression))


def with_words(rows: DataFrame, text_col: str = "line") -> DataFrame:
    """``rows`` with ``ws``, the words of a column, as a column that lambdas can use without splitting again."""
    return rows.withColumn("ws", once(words(F.col(text_col))))


class Model:
    """Weights of each feature for every label, and the probability limit. Its size is that of the templates."""

    def __init__(self, labels: list[str], bias: list[float], weights: dict[str, list[float]], limit: float = 0.5):
        self.labels, self.bias, self.weights, self.limit = labels, bias, weights, limit

    def score(self, lines: DataFrame) -> DataFrame:
        """``lines`` with ``guess`` (a family or unknown) and ``chance``, its softmax probability."""
        # Written as SQL text: thousands of single literal columns would take seconds to build.
        numbers = lambda values: "array(" + ", ".join(f"{v!r}D" for v in values) + ")"
        table_of = F.expr("map(" + ", ".join(f"'{g}', {numbers(v)}" for g, v in self.weights.items()) + ")")
        known = F.expr("array(" + ", ".join(f"'{g}'" for g in self.weights) + ")")
        split = lines if "ws" in lines.columns else with_words(lines)
        counted = split.withColumn("grams", once(F.filter(grams(F.col("ws")), lambda g: F.array_contains(known, g))))
        margins = F.aggregate("grams", F.expr(numbers(self.bias)), lambda s, g: F.zip_with(s, table_of[g], lambda x, y: x + y))
        scored = counted.withColumn("margins", once(margins))
        top = F.array_max("margins")
        chance = 1 / F.aggregate("margins", F.lit(0.0), lambda s, x: s + F.exp(x - top))
        guess = F.array(*map(F.lit, self.labels))[F.array_position("margins", top).cast("int") - 1]
        return scored.withColumn("best", once(F.struct(guess.alias("guess"), chance.alias("chance")))).select(
            *split.columns, "best.guess", "best.chance"
        )


def train(spark, lines: DataFrame, rows: int = SAMPLE) -> Model:
    """Fits on one half of the examples and sets the limit on the other."""
    known = examples(spark, lines, rows)
    labels = [UNKNOWN, *sorted(TEMPLATES)]
    features = with_words(template_rows(spark), "template").select(F.explode(grams(F.col("ws"))).alias("gram")).distinct()
    vocabulary = sorted(r["gram"] for r in features.collect())
    vectors = CountVectorizerModel.from_vocabulary(vocabulary, inputCol="grams", outputCol="features")
    index = F.array_position(F.array(*map(F.lit, labels)), F.col("family")) - 1
    half = with_words(known.where("fold = 0")).select(grams(F.col("ws")).alias("grams"), index.cast("double").alias("label"))
    fitted = LogisticRegression(maxIter=50, regParam=1e-4, elasticNetParam=0.5, family="multinomial").fit(
        vectors.transform(half).coalesce(1)
    )
    matrix = fitted.coefficientMatrix.toArray()
    used = [j for j in range(len(vocabulary)) if matrix[:, j].any()]
    model = Model(labels, fitted.interceptVector.tolist(), {vocabulary[j]: matrix[:, j].tolist() for j in used})
    kept = model.score(known.where("fold = 1")).where(F.col("guess") != UNKNOWN)
    low, high = kept.agg(
        F.min(F.when(F.col("guess") == F.col("family"), F.col("chance"))), F.max(F.when(F.col("family") == UNKNOWN, F.col("chance")))
    ).first()
    if high is not None and low is not None:
        model.limit = max(0.5, min(low, (low + high) / 2))
    return model


def wanted() -> list[tuple[str, int, list[str]]]:
    """(family, words, distinct word pairs) of every template."""
    out = []
    for family, texts in sorted(TEMPLATES.items()):
        for text in texts:
            ws = [w for w in re.split("[^a-z0-9]+", text.lower()) if w]
            out.append((family, len(ws), sorted({"_".join(ws[i : i + 2]) for i in range(len(ws) - 1)})))
    return out


def notices(docs: DataFrame, id_col: str, text_col: str, containment: float) -> DataFrame:
    """(row, id, paragraph, place, line, family, ws, start, stop, part): windows that hold enough word pairs of a template.

    ``place`` is the line a window starts in, ``line`` the lines it touches, ``ws`` its words, ``part``
    the share of the template's word pairs in it.
    """
    body = F.coalesce(F.col(text_col), F.lit(""))
    texts = docs.select(F.col(id_col).alias("id"), body.alias("body")).where(F.col("body").rlike(key_pattern()))
    lines = texts.select(F.monotonically_increasing_id().alias("row"), "id", once(F.regexp_extract_all("body", F.lit(LINE), F.lit(0))).alias("lines"))
    # Every line knows its paragraph: the number of lines before it that close one.
    closes = lambda x: x.rlike(f"{LINE_END}{{2}}") | ~x.rlike("\\S")
    closed = F.transform("lines", lambda x: closes(x).cast("int"))
    before = lambda i: F.coalesce(F.get("closed", i - 1), F.lit(0))
    placed = F.flatten(F.transform(
        "lines", lambda x, i: F.transform(words(x), lambda w: F.struct(i.alias("line"), before(i).alias("paragraph"), w.alias("w")))))
    read = lines.withColumn("closed", once(running(closed, lambda x, y: x + y))).withColumn("run", once(placed))
    known = sorted({pair for _, _, pairs in wanted() for pair in pairs})
    paired = F.transform(
        "run",
        lambda x, i: F.struct(
            i.alias("at"), x["line"].alias("line"), x["paragraph"].alias("paragraph"), F.concat(x["w"], F.lit("_"), F.get("run", i + 1)["w"]).alias("pair")
        ),
    )
    met = read.withColumn("hits", once(F.filter(paired, lambda h: h["pair"].isin(known))))
    fitting = F.filter(templates(containment), lambda t: F.size(F.array_intersect(t["pairs"], F.col("hits.pair"))) >= t["need"])
    tried = met.withColumn("template", F.explode(fitting))
    span, need = F.col("template.span"), F.col("template.need")
    own = tried.withColumn("own", once(F.filter("hits", lambda h: F.array_contains(F.col("template.pairs"), h["pair"]))))
    # A window starts with a word pair of the template and ends with the last pair that is new in it.
    opened = F.transform("own", lambda h, k: F.filter(
        F.slice("own", k + 1, span), lambda x: (x["at"] - h["at"] <= span - 2) & (x["paragraph"] == h["paragraph"])))
    fresh = F.transform(opened, lambda win: F.filter(win, lambda x, i: F.array_position(win["pair"], x["pair"]) == i + 1))
    text = lambda first, last: F.array_join(F.transform(
        F.slice("lines", first + 1, last - first + 1), lambda x: F.regexp_replace(x, "[\\r\\n]+", "")), " ")
    run = lambda start, stop: F.transform(F.slice("run", start + 1, stop - start + 1), lambda x: x["w"])

    def shaped(win: Column) -> Column:
        first, last = win[0], F.element_at(win, -1)
        return F.struct(
            first["paragraph"].alias("paragraph"), first["line"].alias("place"), text(first["line"], last["line"]).alias("line"),
            run(first["at"], last["at"] + 1).alias("ws"), first["at"].alias("start"), (last["at"] + 1).alias("stop"),
            (F.size(win) / F.size("template.pairs")).alias("part"),
        )

    # Words and lines are cut out before the windows become rows: a row never carries its whole text.
    windows = own.withColumn("window", F.explode(F.transform(F.filter(fresh, lambda win: F.size(win) >= need), shaped)))
    return windows.select(
        "row", "id", "window.paragraph", "window.place", "window.line", F.col("template.family").alias("family"),
        "window.ws", "window.start", "window.stop", "window.part",
    )


def scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: Model | None = None, containment: float = CONTAINMENT
) -> DataFrame:
    """(id, paragraph, place, line, family, chance): licence notices, found by a template and sure by the model.

    ``place`` is the line a notice starts in and ``line`` the lines it touches; notices of one paragraph
    have the same number ``paragraph``.
    """
    model = model or train(docs.sparkSession, paragraphs(docs, id_col, text_col))
    scored = model.score(notices(docs, id_col, text_col, containment))
    sure = scored.where((F.col("guess") == F.col("family")) & (F.col("chance") >= model.limit))
    found = F.array_sort(F.collect_list(F.struct("start", "stop", "part", "paragraph", "place", "line", "chance")))
    per_family = sure.groupBy("row", "id", "family").agg(found.alias("found"))
    words_of = lambda x: x["stop"] - x["start"]
    beats = lambda y, x: (
        (y["start"] < x["stop"]) & (x["start"] < y["stop"])
        & ((y["part"] > x["part"]) | ((y["part"] == x["part"]) & (
            (words_of(y) < words_of(x)) | ((words_of(y) == words_of(x)) & (y["start"] < x["start"])))))
    )
    # Sorted by start, and each start has at most one window per template: what overlaps is near by.
    reach = max(STRETCH * n for _, n, _ in wanted()) * max(map(len, TEMPLATES.values()))
    near = lambda i: F.slice("found", F.greatest(i + 1 - reach, F.lit(1)), 2 * reach + 1)
    best = F.filter("found", lambda x, i: ~F.exists(near(i), lambda y: beats(y, x)))
    one = per_family.select("id", "family", F.explode(best).alias("x"))
    return one.select("id", "x.paragraph", "x.place", "x.line", "family", "x.chance")


def op1(spark, sf_dir: str) -> DataFrame:
    """Per document: its paragraphs, the paragraphs that hold a licence notice, and the families."""
    docs = table(spark, sf_dir, "documents")
    key = F.struct("doc_id", F.xxhash64("text").alias("text"))
    found = scan(docs.select(key.alias("key"), "text"), "key").groupBy("id").agg(
        F.countDistinct("paragraph").alias("n_license"), F.array_join(F.array_sort(F.collect_set("family")), ",").alias("families")
    )
    every = docs.select("doc_id", key.alias("key"), F.size(blocks(F.col("text"))).cast("long").alias("n_paragraphs"))
    return every.join(found, every["key"].eqNullSafe(found["id"]), "left").select(
        "doc_id", "n_paragraphs", F.coalesce("n_license", F.lit(0)).alias("n_license"), F.coalesce("families", F.lit("")).alias("families")
    )
