from pyspark.sql import functions as F

from tidemark.llm import license_scan as li

LINES = {
    "Licensed under the Apache License, Version 2.0.": "apache",
    "Released under the MIT License.": "mit",
    "This work is licensed under the GNU General Public License, version 3.": "gpl",
    "Licensed under CC BY-NC 4.0.": "cc-by-nc",
}


def test_printed_notices_are_found_and_nothing_else(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = {(r["id"], r["place"]): (r["line"], r["family"]) for r in li.scan(docs).collect()}
    want = {}
    for r in docs.where(F.col("text").isNotNull()).collect():
        for place, line in enumerate(__import__("re").split("[\r\n]+", r["text"])):
            for notice, family in LINES.items():
                if notice in line:
                    want[r["doc_id"], place] = (line, family)
    assert found == want and len({f for _, f in want.values()}) == 4


def test_held_out_templates_unknown_class_and_odd_rows(spark, odd_docs):
    model = li.train(spark, li.paragraphs(odd_docs, "doc_id", "text"))
    known = li.examples(spark, li.paragraphs(odd_docs, "doc_id", "text"), 50)
    rows = model.score(known.where("fold = 1")).collect()
    assert sum(r["guess"] == r["family"] for r in rows) >= 0.95 * len(rows)
    assert known.where("fold = 1").join(known.where("fold = 0"), "line").isEmpty()
    assert li.scan(odd_docs, model=model).count() == 0 and li.scan(odd_docs.limit(0), model=model).count() == 0
    notice = spark.createDataFrame([(1, "x\r\nReleased under the MIT License.\nThe MIT released a license"), (1, None)], "doc_id long, text string")
    assert [(r["place"], r["family"]) for r in li.scan(notice, model=model).collect()] == [(1, "mit")]


GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version."""
WRAPPED = [
    ("x\n\n" + GPL + "\n\ny", {(1, "gpl")}),
    ("# " + GPL.replace("\n", "\r\n# "), {(0, "gpl")}),
    (GPL.replace("GNU General", "GNU Affero General"), {(0, "agpl")}),
    ("""This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version.""", {(0, "lgpl")}),
    (""" * Licensed under the Apache License,
 * Version 2.0 (the "License"); you may not use this file.
 * You may obtain a copy of the License at
 *
 *     http://www.apache.org/licenses/LICENSE-2.0""", {(0, "apache")}),
    ("""Permission is hereby granted, free of charge, to any person
obtaining a copy of this software and associated documentation files""", {(0, "mit")}),
    ("Dual: licensed under the Apache License, Version 2.0. Or it is released under the MIT License. Choose one.", {(0, "apache"), (0, "mit")}),
    ("the house " * 3000 + GPL.replace("\n", " ") + " the house" * 3000 + " Licensed under CC BY-SA 4.0.", {(0, "gpl"), (0, "cc-by-sa")}),
    ("Permission is hereby granted, free\n\nof charge, to any person\n \nobtaining a copy", set()),
]


def test_wrapped_and_dual_notices(spark):
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(WRAPPED)], "doc_id long, text string")
    base = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = li.train(spark, li.paragraphs(base, "doc_id", "text"))
    got = {}
    for r in li.scan(docs, model=model).collect():
        got.setdefault(r["id"], set()).add((r["paragraph"], r["family"]))
    assert got == {i: want for i, (_, want) in enumerate(WRAPPED) if want}
    assert [r[0] for r in docs.orderBy("doc_id").select(F.size(li.blocks(F.col("text")))).collect()] == [3, 1, 1, 1, 1, 1, 1, 1, 3]


def test_a_text_with_many_notices(spark):
    """Every notice of a long text is found in its own paragraph, in line order."""
    base = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = li.train(spark, li.paragraphs(base, "doc_id", "text"))
    notice = GPL + "\n\nReleased under the MIT License.\nof the house\n \n"
    docs = spark.createDataFrame([(1, notice * 300)], "doc_id long, text string")
    got = sorted((r["paragraph"], r["place"], r["family"]) for r in li.scan(docs, model=model).collect())
    assert got == [(2 * i + j, 7 * i + 4 * j, f) for i in range(300) for j, f in enumerate(("gpl", "mit"))]


def test_unknown_windows_are_drawn_once_and_far_from_templates(spark):
    lines = ["He came mit dem Wagen " + str(i) for i in range(30)] + ["under the GNU General Public License, the same line"] * 200
    lines += ["the mit of a hot line"] * 500 + [GPL.replace("\n", " "), "no key here", "x " * 5000 + "permission" + " y" * 5000]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(lines)], "doc_id long, text string")
    drawn = li.unlike(li.paragraphs(docs, "doc_id", "text"), 10_000)
    assert len(drawn) == 32 and drawn.count("the mit of a hot line") == 1 and not any("public license" in x for x in drawn)
    assert max(len(x.split()) for x in drawn) == li.WINDOW and len(li.unlike(li.paragraphs(docs, "doc_id", "text"), 5)) <= 5
