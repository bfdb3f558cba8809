import random

import numpy as np
import pytest

from tidemark.llm import ordinal
from tidemark.llm.queries import QUERIES


def corpus(n, seed):
    """(doc_id, text, quality, toxic): junk is upper case, toxic texts hold words of a short list."""
    rng = random.Random(seed)
    plain = [f"{a}{b}" for a in ("ban", "tor", "mel", "sud") for b in ("ane", "ido", "ure", "alt", "omi")]
    rows = []
    for i in range(n):
        kind = rng.choice("gggjt")
        words = [rng.choice(plain) for _ in range(rng.randrange(20, 200))]
        if kind == "j":
            words = [w.upper() + "!!" for w in words]
        for _ in range(4 if kind == "t" else 0):
            words.insert(rng.randrange(len(words)), rng.choice(["vile", "nasty", "Foul,", "grim"]))
        rows.append((i, " ".join(words), int(kind != "j"), int(kind == "t")))
    return rows


def test_held_out_documents(spark):
    rows = corpus(1500, 1)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q, t) for i, _, q, t in rows if i < 1000], "doc_id long, quality int, toxic int")
    model = ordinal.fit(docs, ordinal.grades_of(labels))
    assert (np.diff(model.thresholds) > 0).all()
    got = {r.doc_id: r for r in ordinal.score(docs, model).collect()}
    right = [got[i].selected == (q == 1 and t == 0) for i, _, q, t in rows if i >= 1000]
    assert np.mean(right) > 0.97
    mean = lambda grade: np.mean([got[i].expected_grade for i, _, q, t in rows if (0 if t else 1 + q) == grade])
    assert mean(0) < 0.4 < mean(1) < 1.4 < mean(2)


def test_training_follows_the_likelihood():
    """Against the likelihood's own maximum on one feature, found by search."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=400)
    grades = np.digitize(x + rng.logistic(size=400) * 0.5, [-1, 1])
    model = ordinal.train(grades, np.full(400, 1 << 9, np.int32), x.astype(np.float32), np.arange(1, 401), bits=10, rounds=600, ridge=0.0)

    def loss(w, a, b):
        below = 1 / (1 + np.exp(-(np.array([a, b]) - w * x[:, None])))
        below = np.hstack((np.zeros((400, 1)), below, np.ones((400, 1))))
        p = below[np.arange(400), grades + 1] - below[np.arange(400), grades]
        return -(np.log(p) / np.bincount(grades)[grades]).sum()

    w, (a, b) = model.weights[1 << 9], model.thresholds
    best = loss(w, a, b)
    assert all(best <= loss(w + d, a + e, b + f) + 1e-3 for d in (-0.3, 0, 0.3) for e in (-0.3, 0, 0.3) for f in (-0.3, 0, 0.3))


def test_grades_nulls_and_repeats(spark):
    labels = spark.createDataFrame(
        [(1, 1, 0), (1, 0, 0), (2, 1, 1), (3, None, None), (4, None, 0), (5, 0, None), (None, 1, 0)], "doc_id long, quality int, toxic int"
    )
    assert {r.key: r.grade for r in ordinal.grades_of(labels).collect()} == {1: 1, 2: 0, 4: 2, 5: 1}


def test_odd_texts_clashing_names_and_empty_tables(spark):
    model = ordinal.Model(np.zeros(1 << ordinal.BITS), np.array([-1.0, 0.0]))
    data = [(1, None, 0.5), (2, "", 0.5), (3, " \t", 0.5), (4, "word " * 100_000, 0.5), (4, "word " * 100_000, 0.5), (5, "!!! ...", 0.5)]
    docs = spark.createDataFrame(data, "doc_id long, text string, tail double")
    got = ordinal.score(docs, model)
    assert got.columns == ["doc_id", "text", "expected_grade", "tail", "selected"]
    assert sorted((r.doc_id, r.selected) for r in got.collect()) == [(1, False), (2, False), (3, False), (4, True), (4, True), (5, True)]
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    fitted = ordinal.fit(docs, ordinal.grades_of(none))
    assert not fitted.weights.any() and ordinal.score(docs.limit(0), fitted).count() == 0


def test_sample_is_bounded(spark):
    from pyspark.sql import functions as F

    from tidemark.llm.common import bounded_sample

    rows = spark.range(20_000).select(F.col("id").alias("key"), F.when(F.col("id") < 15_000, 0).otherwise(1).alias("g"))
    found = bounded_sample(rows, "g", "key", 500)
    assert {r.g: r["count"] for r in found.groupBy("g").count().collect()} == {0: 500, 1: 500}
    assert sorted(found.collect()) == sorted(bounded_sample(rows.repartition(7), "g", "key", 500).collect())


def test_query(spark, sf):
    got = QUERIES["op1_ordinal_quality"](spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = got.join(labels, "doc_id").collect()
    assert got.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert np.mean([r.selected == (r.quality == 1 and r.toxic == 0) for r in rows]) > 0.9
    assert all(0 <= r.tail <= 1 and 0 <= r.expected_grade <= 2 for r in rows)


@pytest.mark.parametrize("text", ["Foul, FOUL!! 12 x", "漢字 Ünd   x"])
def test_features_are_stable(text):
    one, two = ordinal.Features(), ordinal.Features()
    two.of("other words before")
    a, b = one.of(text), two.of(text)
    assert sorted(zip(*a)) == sorted(zip(*b))


def test_long_tokens_have_the_shape_of_all_their_letters():
    one, two = ("aB" * 50 + "9", "aB" * 50 + "-")
    features = ordinal.Features()
    assert features._token(one)[2] != features._token(two)[2]


def test_repeated_ids_fit_alike_in_any_order(spark):
    rows = [(i, "good words here" if i % 3 == 2 else "bad stuff" if i % 3 else "vile things") for i in range(90)]
    rows += [(i, f"other text {j}") for i in range(30) for j in range(3)]
    grades = spark.createDataFrame([(i, i % 3) for i in range(90)], "key long, grade int")
    one, two = (ordinal.fit(spark.createDataFrame(x, "doc_id long, text string"), grades) for x in (rows, rows[::-1]))
    assert (one.weights == two.weights).all() and (one.thresholds == two.thresholds).all() and np.abs(one.weights).max() > 0
