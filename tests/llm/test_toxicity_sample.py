"""The bounded sample that training looks at."""

import random

from pyspark.sql import functions as F

from corpusflow.llm import toxicity as TX


def tables(spark, extra):
    rnd = random.Random(3)
    word = lambda: rnd.choice(["river", "stone", "green", "walk", "house", "cloud", "paper"]) + rnd.choice("abcdefgh")
    docs = [(i, " ".join(word() for _ in range(30)) + (" zqxwvile zqxwvile" if i % 3 == 0 else "")) for i in range(240)]
    labels = [(i, int(i % 3 == 0)) for i, _ in docs]
    docs += [(d, t) for d, t, _ in extra]
    labels += [(d, y) for d, _, y in extra]
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def found(docs, model):
    out = TX.classify(docs, model).where("doc_id < 240").collect()
    return sum(r["predicted"] == int(r["doc_id"] % 3 == 0) for r in out) / len(out)


def test_one_very_long_labelled_text_does_not_empty_the_sample(spark):
    """Texts beyond the bound in both classes, ids labelled twice, repeated rows, null labels and ids."""
    long = "endless words " * 9000
    docs, labels = tables(spark, [(500, long, 1), (501, long, 0), (502, None, 1), (503, "", 0)])
    docs = docs.union(docs.where("doc_id < 20"))
    labels = labels.union(labels.where("doc_id < 20")).union(spark.createDataFrame([(None, 1), (7, None), (9, 0)], "doc_id long, toxic int"))
    model = TX.fit(docs, labels, chars=100_000)
    assert model.weights is not None and found(docs, model) >= 0.95
    again = TX.classify(docs.where("doc_id < 20"), model).groupBy("doc_id").agg(F.countDistinct("score").alias("n")).collect()
    assert len(again) == 20 and all(r["n"] == 1 for r in again)


def test_rows_are_bounded_and_the_same_in_every_run(spark):
    docs, labels = tables(spark, [])
    a, b = TX.fit(docs, labels, rows=40), TX.fit(docs.repartition(7), labels.repartition(3), rows=40)
    scores = [sorted(map(tuple, TX.classify(docs, m).select("doc_id", "score").collect())) for m in (a, b)]
    assert scores[0] == scores[1]
    none = TX.fit(docs.limit(0), labels)
    assert none.weights is None and TX.classify(docs.limit(0), none).collect() == []
