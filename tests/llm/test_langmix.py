import numpy as np

from tidemark.llm import langmix
from tidemark.llm.queries import QUERIES

A = "la casa de el perro que come una manzana en los campos con mucho sol y agua para todos".split()
B = "das haus von der hund welcher einen apfel auf den feldern isst mit viel sonne und wasser".split()


def texts(n, seed):
    rng = np.random.default_rng(seed)
    return [(i, "es" if i % 2 else "de", " ".join(rng.choice(A if i % 2 else B, 60))) for i in range(n)]


def learned(spark):
    return langmix.learn(spark.createDataFrame(texts(60, 1), "doc_id long, lang string, text string"))


def test_single_and_mixed_documents(spark):
    model = learned(spark)
    assert model.langs == ["de", "es"]
    rng = np.random.default_rng(2)
    mixed = " ".join([*rng.choice(A, 120), *rng.choice(B, 40)])
    rows = [(1, " ".join(rng.choice(A, 30))), (2, " ".join(rng.choice(B, 30)).upper()), (3, mixed), (4, "casa"), (5, mixed + " " + "haus " * 60_000)]
    got = {r.doc_id: r for r in langmix.predict(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert [got[i].lang_pred for i in range(1, 6)] == ["es", "de", "es", "es", "de"]
    assert list(got[1].languages) == ["es"] and list(got[2].languages) == ["de"] and got[1].score == 1
    assert set(got[3].languages) == {"de", "es"} and abs(got[3].score - 0.75) < 0.08
    assert abs(sum(got[3].languages.values()) - 1) < 1e-6


def test_steps_climb_to_the_likelihood():
    """Shares of two known sources against a search over all shares."""
    rng = np.random.default_rng(5)
    logs, counts = rng.normal(size=(50, 2)), rng.integers(1, 5, 50).astype(float)
    parts, fit = langmix.mixture(logs, counts, np.array([0]), np.ones((1, 2)), tolerance=1e-6)
    value = lambda a: (counts * np.log(np.exp(logs) @ [a, 1 - a])).sum()
    assert abs(fit[0] - max(value(a) for a in np.linspace(1e-6, 1 - 1e-6, 2001))) < 1e-3
    assert abs(value(parts[0, 0]) - fit[0]) < 1e-6


def test_no_set_of_languages_is_better():
    """choose() against all nested sets, scored one by one."""
    rng = np.random.default_rng(6)
    for _ in range(20):
        logs, counts = rng.normal(size=(30, 3)) * 3, rng.integers(1, 4, 30).astype(float)
        got = langmix.choose(logs, counts, np.array([0]), penalty=1.0)[0]
        parts, _ = langmix.mixture(logs, counts, np.array([0]), np.ones((1, 3)))
        order = np.argsort(-parts[0])
        price = 1.0 + 0.5 * np.log(counts.sum() + 1)
        values = {1: (logs * counts[:, None]).sum(axis=0).max()}
        for k in (2, 3):
            allowed = np.zeros((1, 3))
            allowed[0, order[:k]] = 1
            values[k] = langmix.mixture(logs, counts, np.array([0]), allowed)[1][0] - (k - 1) * price
        assert (got > 0).sum() <= max(values, key=values.get) and abs(got.sum() - 1) < 1e-6


def test_odd_texts_clashing_names_and_empty_tables(spark):
    model = learned(spark)
    rows = [(1, None, 1), (2, "", 1), (3, "12 !? \n", 1), (4, "x" * 20_000, 1), (4, "x" * 20_000, 1)]
    got = langmix.predict(spark.createDataFrame(rows, "doc_id long, text string, score int"), model)
    assert got.columns == ["doc_id", "text", "lang_pred", "score", "languages"]
    found = sorted((r.doc_id, r.lang_pred, r.score) for r in got.collect())
    assert found[:3] == [(i, "und", 0.0) for i in (1, 2, 3)] and found[3] == found[4]
    nothing = langmix.learn(spark.createDataFrame([(1, None, "x"), (2, "de", None)], "doc_id long, lang string, text string"))
    assert nothing.langs == []
    assert {r.lang_pred for r in langmix.predict(spark.createDataFrame(rows, "doc_id long, text string, s int"), nothing).collect()} == {"und"}
    assert langmix.predict(spark.createDataFrame([], "text string"), model).count() == 0


def plain(logs, counts, allowed, steps=5_000):
    """One document's shares and log-likelihood after very many steps."""
    like, p = np.exp(logs), allowed / allowed.sum()
    for _ in range(steps):
        part = like * p
        p = (part * (counts / part.sum(axis=1))[:, None]).sum(axis=0) / counts.sum()
    return p, (counts * np.log(like @ p)).sum()


def restated(logs, counts, penalty):
    """choose() for one document, without a gate."""
    n, price = logs.shape[1], penalty + 0.5 * np.log(counts.sum() + 1)
    single = (logs * counts[:, None]).sum(axis=0)
    best, value = np.eye(n)[single.argmax()], single.max()
    order = np.argsort(-plain(logs, counts, np.ones(n))[0], kind="stable")
    for k in range(2, n + 1):
        allowed = np.zeros(n)
        allowed[order[:k]] = 1
        p, fit = plain(logs, counts, allowed)
        if fit - (k - 1) * price > value:
            best, value = p, fit - (k - 1) * price
    return best


def test_gate_and_tolerance_leave_the_decisions_of_converged_steps():
    """Documents of close and of distant languages, in one batch, against single ones run to the end."""
    rng = np.random.default_rng(7)
    parts = []
    for i in range(60):
        words, away = int(rng.integers(1, 60)), rng.choice([0.3, 1, 3])
        logs = -8 + rng.normal(size=(words, 4)) * away
        if i % 3 == 0:
            logs[: words // 2, 0] += away
            logs[words // 2:, 1] += away
        parts.append((logs, rng.integers(1, 5, words).astype(float)))
    starts = np.cumsum([0, *(len(c) for _, c in parts)])[:-1]
    got = langmix.choose(np.vstack([x for x, _ in parts]), np.concatenate([c for _, c in parts]), starts, penalty=1.0)
    want = [restated(x, c, 1.0) for x, c in parts]
    assert [set(np.flatnonzero(a > 0.02)) for a in got] == [set(np.flatnonzero(a > 0.02)) for a in want]
    assert sum((np.array(a) > 0).sum() > 1 for a in want) > 5
    assert max(np.abs(a - b).max() for a, b in zip(got, want)) < 0.05


def test_close_languages_converge():
    """Four languages one unit apart: the shares are those of the maximum."""
    rng = np.random.default_rng(8)
    logs = rng.normal(size=(400, 4)) * 0.5
    logs[:, 0] += 1
    counts = np.ones(400)
    found, fit = langmix.mixture(logs, counts, np.array([0]), np.ones((1, 4)), tolerance=1e-4)
    want = plain(logs, counts, np.ones(4))
    assert abs(fit[0] - want[1]) < 1e-3 and np.abs(found[0] - want[0]).max() < 0.02


def test_numerals_are_no_letters(spark):
    rows = [(1, "½ ² ⅷ ④ 12"), (2, "casa½"), (3, "_ _")]
    got = {r.doc_id: r.lang_pred for r in langmix.predict(spark.createDataFrame(rows, "doc_id long, text string"), learned(spark)).collect()}
    assert got == {1: "und", 2: "es", 3: "und"}


def test_repeated_keys_and_many_languages(spark):
    rows = [*texts(40, 3), (7, "es", "uno dos tres"), (7, "es", "uno dos tres"), (7, "es", "cuatro cinco")]
    one, two = (langmix.learn(spark.createDataFrame(x, "doc_id long, lang string, text string")) for x in (rows, rows[::-1]))
    assert (one.logs == two.logs).all()
    rows += [(100 + i, f"x{i}", "abc") for i in range(30)]
    assert langmix.learn(spark.createDataFrame(rows, "doc_id long, lang string, text string"), langs=2).langs == ["de", "es"]


def test_query(spark):
    from zlib import crc32

    sf = "/root/testdata/sf0.01"
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = QUERIES["op5_language_mixture"](spark, sf).collect()
    assert len(got) == len(docs)
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)
    assert np.mean([r.lang_pred == docs[r.doc_id].lang for r in got if r.held_out]) > 0.98


def test_grams_of_words_together_are_those_of_each():
    words = ["a", "été", "straße", "x" * 50, "日本"]
    starts, hashed, here = langmix.grams(words)
    assert [int(n.sum()) for n in here] == [sum(len(w) for w in words), sum(len(w) + 1 for w in words), sum(len(w) for w in words)]
    for i, w in enumerate(words):
        _, alone, use = langmix.grams([w])
        end = starts[i] + len(w) + 2
        for a, b, x, y in zip(hashed, here, alone, use):
            assert (a[starts[i]:end][b[starts[i]:end]] == x[y]).all()
