import hashlib
import random
import re

import numpy as np
import pytest

from tidemark.llm import passages
from tidemark.llm.queries import QUERIES


def brute(rows, span=50):
    """Kept text, words and removed words of each (doc_id, text)."""
    first, split = {}, [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    for (i, _), w in zip(rows, split):
        if i is not None:
            for k in range(len(w) - span + 1):
                key = tuple(w[k:k + span])
                first[key] = min(i, first.get(key, i))
    out = []
    for (i, _), w in zip(rows, split):
        gone = [False] * len(w)
        if i is not None:
            for k in range(len(w) - span + 1):
                if first[tuple(w[k:k + span])] < i:
                    gone[k:k + span] = [True] * span
        out.append((i, " ".join(x for x, g in zip(w, gone) if not g), len(w), sum(gone)))
    return sorted(out, key=repr)


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(3000)}"
    shared = [" ".join(word() for _ in range(n)) for n in (50, 51, 49, 80, 300, 120)]
    rows = []
    for i in range(150):
        parts = [" ".join(word() for _ in range(rng.randrange(0, 90))) for _ in range(3)]
        if rng.random() < 0.6:
            parts.insert(rng.randrange(4), rng.choice(shared))
        if rng.random() < 0.2:
            parts.insert(1, shared[4][:-200])
        rows.append((i * 3, "  ".join(parts)))
    whole = rows[10][1] + " " + shared[4]
    rows += [(1000 + i, whole) for i in range(40)] + [(5, whole), (5, shared[4] + " end"), (5, shared[4] + " end"), (None, whole), (2000, None)]
    rows += [(2001, ""), (2002, "a a " * 200), (2003, "a a " * 200), (2004, "a " * 30_000), (2005, shared[3].replace(" ", " "))]
    near = whole.split()
    rows += [(3000 + i, " ".join([*near[:30 + 3 * i], "other", *near[30 + 3 * i:]])) for i in range(12)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("limits", [{}, {"per_shard": 5, "per_task": 500}])
def test_same_as_brute_force(spark, limits):
    rows = corpus(1)
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, n_words string, digest int")
    got = passages.drop_repeats(docs, **limits)
    assert got.columns == ["doc_id", "text", "digest", "n_words", "n_removed"]
    assert sorted(((r.doc_id, r.text, r.n_words, r.n_removed) for r in got.collect()), key=repr) == brute(rows)


def test_least():
    values = np.random.default_rng(1).integers(0, 99, 200).astype(np.uint64)
    for size in (1, 2, 3, 43, 199, 200, 201):
        assert passages.least(values, size).tolist() == [min(values[i:i + size]) for i in range(len(values) - size + 1)]


def test_empty_table(spark):
    assert passages.drop_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = QUERIES["op6_repeated_passages"](spark, sf).collect()
    want = sorted((i, n, k, hashlib.sha256(t.encode()).hexdigest()) for i, t, n, k in brute(rows))
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == want


def test_no_two_words_are_spelled_alike():
    places = [*range(0, 1 << 22, 997), *range((1 << 21) - 5, (1 << 21) + 5), passages.SPELLED - 1]
    spelled = [passages.signs(i) for i in places]
    assert len(set(spelled)) == len(set(places)) and all(len(x) == 3 for x in spelled)
    assert all(x[0] < "\u0200" <= x[1] < "\u0300" <= x[2] for x in spelled)
    "".join(spelled).encode()
    with pytest.raises(ValueError):
        passages.signs(passages.SPELLED)
