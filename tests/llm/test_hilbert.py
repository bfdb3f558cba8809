import math

import numpy as np
import pytest

from tidemark.llm import hilbert
from tidemark.llm.queries import QUERIES


@pytest.mark.parametrize("dims,bits", [(2, 4), (3, 3), (4, 2)])
def test_curve_visits_neighbouring_cells(dims, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims), -1).reshape(-1, dims)
    keys = hilbert.hilbert_keys(cells, bits)
    assert sorted(keys.tolist()) == list(range(len(cells)))
    path = cells[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def brute(rows, every=20, k=20):
    """The k nearest of each asked row, from all pairs."""
    use = sorted({(i, tuple(v)) for i, v in rows if v is not None and any(v) and all(x is not None and math.isfinite(x) for x in v)})
    ids, x = np.array([i for i, _ in use]), np.array([v for _, v in use])
    out = {}
    for at in np.flatnonzero(ids % every == 0):
        score = x @ x[at]
        order = [j for j in np.lexsort((ids, -score.round(9))) if j != at][:k]
        out[int(ids[at])] = [(int(ids[j]), score[j]) for j in order]
    return out


def lists(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_ties_copies_nulls_and_lengths(spark):
    rng = np.random.default_rng(1)
    rows = [(i, (rng.normal(size=8) * rng.choice([0.1, 1, 5])).tolist()) for i in range(400)]
    hot = rows[7][1]
    rows += [(i, hot) for i in range(1000, 1200)] + [(2000, None), (2020, [0.0] * 8), (2040, [float("nan")] * 8), (2060, [None] + hot[1:]),
             (2080, [float("inf")] * 8), (20, rows[20][1]), (-20, rows[3][1])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, rank int")
    got, want = lists(hilbert.search(df, least=1000)), brute(rows)
    assert got.keys() == want.keys()
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]], q
        assert np.allclose([s for _, s in got[q]], [s for _, s in want[q]])


def test_fewer_rows_than_asked_for_and_empty_tables(spark):
    rows = [(i, [1.0, float(i)]) for i in range(0, 100, 20)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert {q: len(x) for q, x in lists(hilbert.search(df)).items()} == {q: 4 for q in range(0, 100, 20)}
    assert hilbert.search(df.limit(0)).count() == 0 and hilbert.search(df.limit(1)).count() == 0


def test_recall_with_small_windows(spark):
    """Many chunks, windows of a twentieth, vectors with little structure and different lengths."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3000, 24)) + 0.7 * rng.normal(size=(30, 24)).repeat(100, axis=0)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got = lists(hilbert.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), least=50, chunk=64))
    want = brute(rows)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 20 * len(want)


def test_query_recall(spark):
    sf = "/root/testdata/sf0.1"
    rows = [(r.vec_id, [float(x) for x in r.embedding]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got, want = lists(QUERIES["op4_hilbert_neighbours"](spark, sf)), brute(rows)
    assert got.keys() == want.keys() and all(len(x) == 20 for x in got.values())
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 20 * len(want)


@pytest.mark.parametrize("lengths", ["one long", "spread"])
def test_recall_with_unequal_lengths(spark, lengths):
    """One vector a hundred times longer, or lengths over several powers of two, leave the windows their share of neighbours."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x *= np.where(np.arange(3000) == 7, 100, 1)[:, None] if lengths == "one long" else rng.lognormal(0, 1, 3000)[:, None]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got = lists(hilbert.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), least=50, chunk=64))
    want = brute(rows)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 20 * len(want)


def test_every_query_meets_a_short_band(spark):
    """Far more queries than windows are wide stand beside five long vectors, and many share a chunk."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(1500, 8))
    x[:5] *= 1e6
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got = lists(hilbert.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), every=1, least=50, chunk=64))
    want = brute(rows, every=1)
    for q in want:
        long = [i for i, s in want[q] if i < 5 and s > 100]
        assert [i for i, _ in got[q]][:len(long)] == long, q


@pytest.mark.parametrize("size", [1e-170, 1.0, 1e170])
def test_lengths_whose_squares_a_double_does_not_hold(spark, size):
    rows = [([3 * size, -4 * size],), ([0.0, -size],)]
    got = [r[0] for r in spark.createDataFrame(rows, "v array<double>").select(hilbert.log_length()).collect()]
    assert np.allclose(got, np.log2([5, 1]) + math.log2(size))


def test_the_curves_find_what_a_random_order_does_not(spark, monkeypatch):
    """20,000 vectors without structure: fewer comparisons than half of the pairs, and recall that comes from the order."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(20_000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(4)
    asked = np.arange(0, 20_000, 20)
    score = x[asked] @ x.T
    score[np.arange(1000), asked] = -9
    want = dict(zip(asked.tolist(), (set(r.tolist()) for r in np.argpartition(-score, 20, axis=1)[:, :20])))

    def recall():
        got = {}
        for r in hilbert.search(df).collect():
            got.setdefault(r.query_id, set()).add(r.vec_id)
        return sum(len(got[q] & want[q]) for q in want) / 20_000

    met = []
    inside = hilbert._within

    def counted(chunks, queries, reaches, size, k):
        sizes = chunks.where("id IS NULL").selectExpr("band", "curve", "chunk", "length(ids) / 8 AS n")
        places = chunks.where("id IS NOT NULL").join(reaches, "band").selectExpr(
            "band", "curve", "explode(sequence(chunk - reach, chunk + reach)) AS chunk")
        met.append(places.join(sizes, ["band", "curve", "chunk"]).selectExpr("sum(n)").first()[0])
        return inside(chunks, queries, reaches, size, k)

    monkeypatch.setattr(hilbert, "_within", counted)
    ordered = recall()
    assert sum(met) < 0.5 * 1000 * 20_000 and ordered >= 0.9
    monkeypatch.setattr(hilbert, "hilbert_keys", lambda cells, bits: np.random.default_rng().integers(0, 1 << 48, len(cells)))
    assert recall() < ordered - 0.2


def test_codes_bound_the_inner_products():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(200, 20)) * rng.lognormal(0, 3, (200, 1))
    x[3] = 0
    q = x[10:30] / np.linalg.norm(x[10:30], axis=1, keepdims=True)
    (a, sa, ea), (b, sb, eb) = hilbert.coded(q), hilbert.coded(x)
    middle = (a * sa[:, None]) @ (b * sb[:, None]).T
    off = eb[None, :] + ea[:, None] * np.linalg.norm(b * sb[:, None], axis=1)[None, :]
    assert (np.abs(q @ x.T - middle) <= off + 1e-12).all()


def test_long_packs_and_wide_windows(spark, monkeypatch):
    """Windows wider than a chunk may be, and more queries at one place than a pack holds."""
    monkeypatch.setattr(hilbert, "PACK", 7)
    rng = np.random.default_rng(7)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(600, 8)))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got, want = lists(hilbert.search(df, every=1, least=200, chunk=16)), brute(rows, every=1)
    assert all([i for i, _ in got[q]] == [i for i, _ in want[q]] for q in want)
