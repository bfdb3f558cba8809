"""Scoring of text, against a token-by-token restatement."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tidemark.functions import sentiment as S


def scores(spark, texts, lexicon=S.DEFAULT):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, text string")
    rows = S.score_segments(df, "text", lexicon).orderBy("i").collect()
    return [(r["sentiment_score"], r["sentiment_label"]) for r in rows]


def by_hand(text, lexicon=S.DEFAULT):
    found = re.findall(r"[a-z']+", (text or "").lower())
    total = 0
    for i, word in enumerate(found):
        if word in lexicon.intensifiers:
            continue
        weight = 2 if i and found[i - 1] in lexicon.intensifiers else 1
        total += weight * ((word in lexicon.positive) - (word in lexicon.negative))
    return round(total / (abs(total) + 1), 4)


@pytest.mark.parametrize("text, label", [
    ("This was excellent, I am so happy", "positive"),
    ("Terrible. The worst service", "negative"),
    ("The account number is twelve", "neutral"),
    ("", "neutral"),
    (None, "neutral"),
    ("good but slow", "neutral"),
    ("GREAT", "positive"),
])
def test_labels(spark, text, label):
    assert scores(spark, [text])[0][1] == label


def test_intensifier_strengthens_only_the_next_word(spark):
    plain, strong, far, doubled = (s for s, _ in scores(spark, ["bad", "very bad", "very the bad", "very very bad"]))
    assert strong < plain == far
    assert doubled == strong


def test_label_limits_are_strict(spark):
    df = spark.createDataFrame([(0.1,), (0.1001,), (-0.1,), (-0.1001,), (None,)], "s double")
    got = [r[0] for r in df.select(S.label(F.col("s"))).collect()]
    assert got == ["neutral", "positive", "neutral", "negative", "neutral"]


def test_random_texts(spark):
    r = random.Random(11)
    words = sorted(S.DEFAULT.positive | S.DEFAULT.negative | S.DEFAULT.intensifiers) + ["the", "it's", "12", "né", "-", "Bad!"]
    texts = [" ".join(r.choice(words) for _ in range(r.randint(0, 60))) for _ in range(300)]
    got = [s for s, _ in scores(spark, texts)]
    assert got == [by_hand(x) for x in texts]
    assert all(-1 < s < 1 for s in got)


def test_two_words_never_match_as_one(spark):
    assert scores(spark, ["thank you"])[0][0] == 0.0
    assert "thank you" in S.DEFAULT.positive


def test_own_lexicon(spark):
    own = S.Lexicon(frozenset({"up"}), frozenset({"down"}), frozenset({"way"}))
    assert scores(spark, ["way up", "down", "good"], own) == [(0.6667, "positive"), (-0.5, "negative"), (0.0, "neutral")]


def test_no_python_worker(spark, plan_of):
    df = spark.createDataFrame([("good",)], "text string")
    text = plan_of(S.score_segments(df))
    assert "EvalPython" not in text and "Exchange" not in text
