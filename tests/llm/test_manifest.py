import hashlib

from pyspark.sql import functions as F

from tidemark.llm import manifest as M
from tidemark.llm.queries import ORACLES, QUERIES
from tools.verify import compare, open_oracle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, grp int, pos string, path int, node string"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, low=False):
    text = row[4] and row[4].translate({c: c + 32 for c in range(65, 91)}) if low else row[4]
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (*row[:4], text)))


def tree(nodes):
    """Root of the nodes and each one's siblings from the bottom."""
    paths, owner = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        for a in range(0, len(nodes), 8):
            for j in range(a, min(a + 8, len(nodes))):
                for i in owner[j]:
                    paths[i].append((nodes[a:j], nodes[j + 1:a + 8]))
        owner = [sum(owner[a:a + 8], []) for a in range(0, len(nodes), 8)]
        nodes = [H(*nodes[a:a + 8]) for a in range(0, len(nodes), 8)]
    return nodes[0], paths


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    subs = {g: tree([leaf(r) for r in sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))]) for g in order}
    root, above = tree([subs[g][0] for g in order])
    out = []
    for g, up in zip(order, above):
        for r, path in zip(sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))), subs[g][1]):
            path = path + up
            h = leaf(r, True)
            for before, behind in path:
                h = H(*before, h, *behind)
            out.append((r[0], leaf(r), subs[g][0], root, H(*(s for a, b in path for s in (*a, *b))), h))
    return sorted(out, key=repr)


def found(spark, rows):
    docs = spark.createDataFrame([(*r, 1, "p", 2, "n") for r in rows], SCHEMA)
    out = M.manifest(docs).select(
        "doc_id", *(M.hex_of(F.col(c)) for c in ("leaf", "subroot", "root")), M.proof(F.col("path")),
        M.hex_of(M.fold(F.col("tampered_leaf"), F.col("path"))),
    )
    return sorted(map(tuple, out.collect()), key=repr)


def test_same_as_a_plain_tree_with_nulls_repeats_and_every_group_size(spark):
    rows = []
    for lang, n in ((None, 9), ("", 1), ("a", 8), ("b", 64), ("é", 65), ("Z", 74)):
        rows += [(len(rows) + i * 3, None if i % 5 == 0 else "s", lang, i, None if i % 7 == 0 else f"Text {i} ÄB") for i in range(n)]
    rows += [(None, "s", "a", None, "x"), (None, "s", "a", None, "Y"), (5, "q", "b", 1, "T"), (5, "q", "b", 1, "T"), (5, "q", "b", 1, "S"),
             (6, "q", "a", 1, ""), (7, "q", "a", 1, "Ab" * 200_000)]
    assert found(spark, rows) == brute(rows)


def test_one_row_and_none(spark):
    assert found(spark, [(1, "s", "a", 2, "X")]) == brute([(1, "s", "a", 2, "X")])
    assert found(spark, []) == []


def test_blocks_are_not_seen_in_the_result(spark, monkeypatch):
    rows = [(i, "s", "a", i, f"T{i}") for i in range(300)]
    monkeypatch.setattr(M, "RUNS", 1)
    assert found(spark, rows) == brute(rows)


def test_query_matches_sql(spark, sf):
    problem, n = compare(QUERIES["op12_merkle_manifest"](spark, sf), open_oracle(sf), ORACLES["op12_merkle_manifest"])
    assert problem is None and n
