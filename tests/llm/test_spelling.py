import random
import re
from collections import Counter
from zlib import crc32

import numpy as np

from tidemark.llm import spelling
from tidemark.llm.queries import ORACLES, QUERIES
from tools.verify import compare, open_oracle


def edits(a, b):
    """Whether one inserted, deleted or replaced letter turns a into b."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(rows, letters=5, least=3, every=97):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate({c: c + 32 for c in range(65, 91)})
            h = 1 if doc_id is None else crc32(f"{doc_id}:{run}".encode())
            if doc_id is not None and h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= letters and n >= least}
    near = {w: [x for x in words if edits(w, x)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 2 * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return sorted(out)


def grouped(docs, **more):
    return sorted(map(tuple, spelling.group(docs, **more).collect()))


def test_same_as_brute_force_on_odd_rows(spark):
    rng = random.Random(3)
    stems = ["letter", "lettre", "Été-ÉTÉS", "garçon", "naïveté", "aaaaaa", "aaaaaaa", "aaaaaaaa", "abcabc", "bcabca", "straße", "ÿÿÿÿÿ", "×÷×÷×"]
    words = []
    for s in stems:
        for _ in range(12):
            at, c = rng.randrange(len(s)), rng.choice("aeéß")
            words += [s] * rng.randint(1, 9) + [s[:at] + c + s[at + 1:], s[:at] + s[at + 1:], s[:at] + c + s[at:]] * rng.randint(0, 4)
    rows = [(i % 40 if i % 11 else None, " ".join(rng.choices(words, k=40))) for i in range(60)]
    rows += [(1, None), (None, None), (2, ""), (3, "1 2 – ñ"), (4, "longword" * 30_000), (4, "longword" * 30_000), (5, "longword" * 30_000 + "s"),
             (6, "longword" * 30_000 + "s"), (7, "longword" * 30_000 + "s"), (8, "longword" * 30_000)]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, word int, n string")
    want = brute(rows)
    assert sum(w[4] for w in want) > 100 and any(w[1] for w in want)
    assert grouped(docs) == want
    # hot cells are cut into parts that meet pairwise
    assert grouped(docs, part=3) == want
    assert grouped(docs, every=3) == brute(rows, every=3)


def test_empty_tables_and_texts_without_words(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert grouped(docs) == []
    assert grouped(spark.createDataFrame([(1, None), (None, "12 34")], "doc_id long, text string")) == []


def test_long_ways_to_the_root(spark):
    words = ["base" + "abcdefghij"[:i] for i in range(1, 9)]
    rows = [(None, " ".join([w] * (3 * 2 ** i))) for i, w in enumerate(words)]
    assert grouped(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_pairs_in_a_block_are_all_those_at_one_edit():
    rng = random.Random(4)
    words = sorted({"".join(rng.choices("abé", k=rng.choice((5, 6)))) for _ in range(150)})
    i, j = spelling.near_in(words, np.zeros(len(words), int), True)
    assert {frozenset(p) for p in zip(i.tolist(), j.tolist())} == {
        frozenset((a, b)) for a in range(len(words)) for b in range(a) if edits(words[a], words[b])
    }


def test_query_matches_sql(spark, sf):
    problem, n = compare(QUERIES["op13_spelling_variants"](spark, sf), open_oracle(sf), ORACLES["op13_spelling_variants"])
    assert problem is None and n
