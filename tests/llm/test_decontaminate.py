import math
import random
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import decontaminate as dc
from tidemark.llm.queries import QUERIES


def bm25(items, passage):
    """Scores of all items for a passage, as shares of each item's score against itself, term by term."""
    bags = [Counter(dc.words_of(t)) for t in items]
    n, mean = len(bags), sum(sum(b.values()) for b in bags) / len(bags)
    docs = Counter(w for b in bags for w in b)

    def score(bag, words):
        norm = dc.K1 * (1 - dc.B + dc.B * sum(bag.values()) / mean)
        return sum(
            math.log(1 + (n - docs[w] + 0.5) / (docs[w] + 0.5)) * bag[w] * (dc.K1 + 1) / (bag[w] + norm) for w in words if w in bag
        )

    return [score(b, set(passage)) / score(b, set(b)) for b in bags]


def prose(rng, n):
    return " ".join(rng.choice("the of and to in a".split()) if rng.random() < 0.4 else f"w{rng.randrange(400)}" for _ in range(n))


@pytest.mark.parametrize("threshold", [0.2, 0.35, 0.6])
def test_retrieval_finds_all_above_the_threshold(threshold):
    rng = random.Random(4)
    items = [prose(rng, rng.randrange(8, 60)) for _ in range(150)]
    passages = [prose(rng, 120) for _ in range(60)] + [items[i] + " " + prose(rng, 40) for i in range(0, 150, 10)]
    index = dc.Index.of(list(enumerate(items)))
    sets = [sorted(index.terms[w] for w in set(dc.words_of(p)) if w in index.terms) for p in passages]
    number = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    p, i, s = index.retrieve(number, np.concatenate(sets).astype(int), len(passages), threshold)
    got = {(a, index.ids[b]): c for a, b, c in zip(p.tolist(), i.tolist(), s.tolist())}
    want = {}
    for a, text in enumerate(passages):
        want |= {(a, b): c for b, c in enumerate(bm25(items, dc.words_of(text))) if c >= threshold}
    assert got.keys() == want.keys() and len(want) >= 15
    assert all(abs(got[k] - want[k]) < 1e-6 for k in want)


def test_leaks_wherever_they_stand(spark):
    rng = random.Random(5)
    items = [(i, prose(rng, rng.randrange(15, 60)) + ". And answer " + prose(rng, 6) + ".") for i in range(40)]
    docs = []
    for i in range(120):
        words = prose(rng, rng.randrange(0, 900)).split()
        if i % 3 == 0:
            at = rng.randrange(len(words) + 1)
            words[at:at] = [w.upper() + "," for w in items[i % 40][1].split()]
        docs.append((i, " ".join(words)))
    # the question without the answer, the answer without the question, and half of both are no leaks
    question, answer = items[0][1].split(". And")
    docs += [(500, question), (501, "And" + answer), (502, " ".join(items[1][1].split()[:12])), (503, None), (504, "")]
    docs += [(505, items[2][1]), (505, items[2][1]), (506, (prose(rng, 30_000) + " " + items[3][1] + " " + prose(rng, 30_000)))]
    got = dc.leaks(spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, start int"),
                   spark.createDataFrame(items, "item_id long, text string"))
    found = sorted((r.doc_id, r.item_id) for r in got.collect())
    assert found == sorted([(i, i % 40) for i in range(0, 120, 3)] + [(505, 2), (505, 2), (506, 3)])


def test_several_indexes_odd_items_and_empty_tables(spark):
    rng = random.Random(6)
    items = [(i, prose(rng, 30)) for i in range(30)]
    rows = items + [(None, "x y z"), (40, None), (41, ""), (42, "!?"), (0, items[0][1]), (43, items[0][1])]
    items_df = spark.createDataFrame(rows, "item_id long, text string")
    docs = spark.createDataFrame([(i, t) for i, t in items] + [(None, items[1][1]), (99, "clean text")], "doc_id long, text string")
    for per_index in (4, 1000):
        got = dc.leaks(docs, items_df, per_index=per_index)
        assert sorted(((r.doc_id, r.item_id) for r in got.collect()), key=repr) == sorted(
            [(i, i) for i in range(30)] + [(0, 43), (None, 1)], key=repr
        )
    assert [r.doc_id for r in dc.clean(docs, items_df).collect()] == [99]
    assert dc.leaks(docs, items_df.limit(0)).count() == 0 and dc.leaks(docs.limit(0), items_df).count() == 0
    assert dc.clean(docs, items_df.limit(0)).count() == docs.count()


def test_query_finds_what_a_search_for_text_finds(spark):
    sf = "/root/testdata/sf0.01"
    got = sorted((r.doc_id, r.item_id) for r in QUERIES["op3_benchmark_leaks"](spark, sf).collect())
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    items = spark.read.parquet(f"{sf}/benchmark.parquet").collect()
    assert got == sorted((d.doc_id, i.item_id) for d in docs for i in items if i.text in (d.text or ""))


@pytest.mark.parametrize("per_index", [4, 1000])
def test_rows_are_dropped_by_their_own_text(spark, per_index):
    """Clean rows stay beside leaking ones that have no doc_id either, or the same one."""
    rng = random.Random(7)
    items = [(i, prose(rng, 30)) for i in range(12)]
    rows = [(None, items[0][1], 1), (None, "clean text", 2), (None, None, 3), (5, items[1][1], 4), (5, "another clean text", 5), (6, "", 6)]
    rows += [(7, prose(rng, 50) + " " + items[11][1], 7), (None, "clean text", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n long")
    kept = dc.clean(docs, spark.createDataFrame(items, "item_id long, text string"), per_index=per_index)
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted((rows[i] for i in (1, 2, 4, 5, 7)), key=repr)


def test_findings_do_not_depend_on_the_number_of_indexes(spark):
    """Partial and disguised items near the thresholds, items of several classes of lengths, one of them very long."""
    rng = random.Random(8)
    items = [(i, prose(rng, rng.choice([9, 20, 60, 70, 200])) + ". And so " + prose(rng, 5) + ".") for i in range(60)]
    items.append((60, prose(rng, 3000) + ". The end of it."))
    docs = []
    for i in range(150):
        words = items[i % 61][1].split()
        keep = rng.choice([0.75, 0.85, 0.95, 1.0])
        words = [w for w in words if rng.random() < keep]
        docs.append((i, " ".join([prose(rng, rng.randrange(80)), *words, prose(rng, rng.randrange(80))])))
    df, items_df = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    found = [
        sorted((r.doc_id, r.item_id, round(r.bm25, 9), round(r.overlap, 9), r.start) for r in dc.leaks(df, items_df, per_index=n).collect())
        for n in (3, 20, 1000)
    ]
    assert found[0] == found[1] == found[2] and 20 < len({f[0] for f in found[0]}) < 150
    assert any(f[1] == 60 for f in found[0])


def test_many_indexes_read_the_documents_once(spark, tmp_path, monkeypatch):
    rng = random.Random(9)
    spark.createDataFrame([(i, prose(rng, 50)) for i in range(20)], "doc_id long, text string").write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    items = spark.createDataFrame([(i, prose(rng, 30)) for i in range(30)], "item_id long, text string")
    assert dc.leaks(docs, items, per_index=3)._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    monkeypatch.setattr(dc, "INDEXES", 2)
    assert dc.leaks(docs, items, per_index=3)._jdf.queryExecution().executedPlan().toString().count("FileScan") > 1
