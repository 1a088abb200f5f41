from tidemark.llm import language_id as li


def test_held_out_accuracy_and_clean_documents_stay(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = li.learn_from(docs)
    found = li.predict(docs, model).withColumnRenamed("id", "doc_id").join(docs.select("doc_id", "lang"), "doc_id")
    rows = found.where(li.held_out()).collect()
    assert sum(r["lang_pred"] == r["lang"] for r in rows) >= 0.97 * len(rows)
    assert sum(r["accepted"] for r in rows) >= 0.99 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_rejection_and_odd_rows(spark, odd_docs, documents):
    model = li.learn_from(documents)
    got = {(r["id"], r["lang_pred"] == li.UND, r["accepted"]) for r in li.predict(odd_docs, model).collect()}
    assert {(2, True, False), (3, True, False), (6, True, False), (1, True, False)} <= got
    foreign = spark.createDataFrame([(1, "Это предложение написано по-русски и совсем далеко")], "doc_id long, text string")
    assert li.predict(foreign, model).first()["accepted"] is False
    assert li.keep_known(odd_docs, model).schema == odd_docs.schema
    assert li.learn(odd_docs.limit(0).select("lang", "text")) is None
    assert {r["lang_pred"] for r in li.predict(odd_docs, None).collect()} == {li.UND}


def test_sample_is_bounded(documents):
    assert li.sample(documents.select("lang", "text"), 5).groupBy("lang").count().where("count > 5").count() == 0


def test_unlearned_languages_in_latin_letters_and_gibberish_are_rejected(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = li.learn_from(docs)
    texts = [
        "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan ja heille on annettu järki ja omatunto",
        "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw są oni obdarzeni rozumem i sumieniem",
        "Bütün insanlar hür haysiyet ve haklar bakımından eşit doğarlar akıl ve vicdana sahiptirler ve birbirlerine karşı",
        "xq zzvk wqpt jjxk vvbq zxqw kkpq wxzj qqvz xkjq pzwx vqjk zzxq wkvp qxjz kvwq",
    ]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = li.predict(frame, model)
    assert not any(r["accepted"] for r in found.collect())
    assert li.keep_known(frame, model).count() == 0


def test_ties_and_repeated_rows_give_the_same_language(spark, documents):
    model = li.learn_from(documents)
    text = documents.where("text IS NOT NULL").first()["text"]
    rows = li.predict(spark.createDataFrame([(1, text), (1, text), (2, text)], "doc_id long, text string"), model).collect()
    assert len(rows) == 3 and len({(r["lang_pred"], r["score"]) for r in rows}) == 1
    # Two languages learned from the same texts: equal cosines go to the language that sorts first.
    twins = spark.createDataFrame([(lang, t) for lang in ("yy", "xx") for t in ("one two three", "four five six")], "lang string, text string")
    assert {r["lang_pred"] for r in li.predict(spark.createDataFrame([(1, "one two three")], "doc_id long, text string"), li.learn(twins)).collect()} == {"xx"}
