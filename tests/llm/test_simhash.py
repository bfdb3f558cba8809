import random

import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import simhash
from tidemark.llm.components import components


def restated(text, n=4):
    words = [w.lower() if w.isascii() else "".join(c.lower() if c.isascii() else c for c in w) for w in (text or "").encode().decode().replace("\x0b", " ").replace("\x0c", " ").replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if w]
    if not words:
        return 0
    parts = [" ".join(words[i:i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), seed=42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="aBÄ \t\n\x0b\u00a0\u2003z", max_size=60))
def test_fingerprint(text):
    assert simhash.fingerprint(text) == restated(text)


def test_spark_hashes_alike(spark):
    from pyspark.sql import functions as F

    assert spark.range(1).select(F.xxhash64(F.lit("a b c d"))).first()[0] % 2**64 == xxhash.xxh64_intdigest(b"a b c d", seed=42)


def classes(prints, radius):
    """The least id reachable from each (fingerprint, id)."""
    root = {i: i for _, i in prints}
    changed = True
    while changed:
        changed = False
        for x, i in prints:
            for y, j in prints:
                if (x ^ y).bit_count() <= radius and root[j] < root[i]:
                    root[i], changed = root[j], True
    return root


def some_prints(n, seed):
    rng = random.Random(seed)
    out = set()
    while len(out) < n:
        x = rng.choice(sorted(out)) if out and rng.random() < 0.7 else rng.getrandbits(64)
        for _ in range(rng.randrange(6)):
            x ^= 1 << rng.randrange(64)
        out.add(x)
    return list(zip(out, rng.sample(range(10 * n), n)))


def test_tree_finds_all_within_radius():
    prints = [x for x, _ in some_prints(300, 1)]
    tree = simhash.Tree(prints)
    for i in range(len(prints)):
        tree.insert(i)
    for x in prints[:60]:
        assert sorted(tree.within(x, 4)) == [i for i, y in enumerate(prints) if (x ^ y).bit_count() <= 4]


@pytest.mark.parametrize("tree", [4, 2048])
def test_links_connect_as_all_pairs_do(spark, tree):
    prints = some_prints(250, 2)
    rows = [(x - (1 << 64) if x >> 63 else x, i) for x, i in prints]
    edges = simhash.links(spark.createDataFrame(rows, "fp long, id long"), 4, tree)
    got = {i: i for _, i in prints} | {r.node: r.root for r in components(edges).collect()}
    assert got == classes(prints, 4)


def test_long_chains(spark):
    chain = [(i, i + 1) for i in range(300)] + [(1000, 999), (5, 5)]
    got = {r.node: r.root for r in components(spark.createDataFrame(chain, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(1, 301)} | {1000: 999}


def texts():
    base = " ".join(f"word{i}" for i in range(400))
    return [
        (7, base), (3, base), (9, base + " tail"), (5, None), (4, ""), (2, "  \n "), (11, "one"), (12, "ONE"), (13, "x " * 50_000),
        (None, base), (None, "nobody has this text at all"), (7, base), (20, "quite another text with other words"),
    ]


def test_components_of_documents(spark):
    docs = spark.createDataFrame([(i, t, 1) for i, t in texts()], "doc_id long, text string, fingerprint int")
    got = sorted(((r.doc_id, r.fingerprint % 2**64, r.component_id) for r in simhash.near_duplicates(docs).collect()), key=repr)
    prints = {restated(t) for _, t in texts()}
    ids = {x: min([i for i, t in texts() if i is not None and restated(t) == x], default=None) for x in prints}
    root = classes([(x, i) for x, i in ids.items() if i is not None], 4)
    want = [(i, restated(t), root.get(ids[restated(t)])) for i, t in texts()]
    assert got == sorted(want, key=repr)
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted((i for i, _, c in want if i is None or i == c), key=repr)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(docs).count() == 0 and simhash.keep_first(docs).count() == 0


def chain():
    """Three texts of one word changed each; the outer two are linked through the middle one only."""
    rng = random.Random(3)
    while True:
        words = [f"w{rng.randrange(10**6)}" for _ in range(200)]
        out = [" ".join(words)]
        for at in (50, 120):
            words[at] = f"w{rng.randrange(10**6)}"
            out.append(" ".join(words))
        a, b, c = map(restated, out)
        if 0 < (a ^ b).bit_count() <= 4 and 0 < (b ^ c).bit_count() <= 4 < (a ^ c).bit_count():
            return out


def test_rows_without_id_link_and_are_removed(spark):
    a, b, c = chain()
    lone = "a text that only rows without a number have, twice and once nearly"
    rows = [(8, a, "x", {}), (None, b, "x", {}), (9, c, "x", {}), (None, a, "y", {"k": 1}), (None, lone, "s", {}), (None, lone, "s", {}),
            (None, lone.upper(), "t", {}), (None, "quite another one without a number", "u", {}), (10, "and one that has it", "v", {})]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, more map<string, int>")
    found = {(r.doc_id, r.fingerprint % 2**64): r.component_id for r in simhash.near_duplicates(docs).collect()}
    assert [found[i, restated(t)] for i, t, *_ in rows] == [8, 8, 8, 8, None, None, None, None, 10]
    kept = simhash.keep_first(docs, keep_unnamed=False)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(
        [(8, a), (None, lone.upper()), (None, rows[7][1]), (10, rows[8][1])], key=repr
    )
    assert sum(r.doc_id is None for r in simhash.keep_first(docs).collect()) == 6


def test_a_hub_is_split(spark, tmp_path):
    """A star of very many leaves: the join on its hub can be dealt to several tasks."""
    from tidemark.llm.components import components

    spark.range(1, 100_001).selectExpr("id AS u", "0 AS v").repartition(8).write.parquet(str(tmp_path / "e"))
    names = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
    }
    before = {k: spark.conf.get(k, None) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        rows = spark.read.parquet(str(tmp_path / "e"))
        both = rows.selectExpr("inline(array(struct(u, v), struct(v AS u, u AS v)))")
        from tidemark.llm.components import _star

        star = _star(both, "large")
        assert star.count() == 100_000
        star.collect()
        assert "skew=true" in star._jdf.queryExecution().executedPlan().toString()
        assert components(rows).where("root = 0").count() == 100_000
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
