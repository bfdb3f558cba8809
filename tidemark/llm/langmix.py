"""Language ID by mixtures: which languages a document is written in, and in what shares.

Each word is taken to come from one language, with the likelihood that the language's letter n-grams give it. For a set
of languages, expectation-maximisation finds the shares that make the document's words likeliest. Of the nested sets in
the order of the shares, the one with the best likelihood less a penalty per language counts.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import bounded_sample, share, slices

PER_LANG = 3000
BITS = 16
SMOOTHING = 0.5
#: Beside half the logarithm of the number of words, for each language after the first.
PENALTY = 4.0
#: Steps end once no shares can gain more than this in a document's log-likelihood.
TOLERANCE = 0.01
#: Where the shares start of which the best single language is tried against all mixtures.
SURE = 0.98
#: Languages that are learned, the commonest.
LANGS = 200
MEMORY = 200_000


ALPHANUMERIC = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> Counter[str]:
    """Runs of letters, lower-cased, with their counts."""
    found = Counter(ALPHANUMERIC.findall(text.lower()))
    # some numerals are neither letters nor digits; they are rare, and a pattern that knows them all is slow
    for w in [w for w in found if not w.isalpha()]:
        k = found.pop(w)
        for x in "".join(c if c.isalpha() else " " for c in w).split():
            found[x] += k
    return found


def grams(words: list[str]) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """Where each word starts in the letters of all, with marks at its ends, and for n-grams of one to three letters the hash
    at each place and whether one starts there."""
    codes = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le"), np.uint32).astype(np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    starts = np.cumsum(sizes) - sizes
    left = np.repeat(starts + sizes, sizes) - np.arange(len(codes))  # letters from a place to its word's end
    hashed, here, mixed = [], [], codes.copy()
    for n in (1, 2, 3):
        if n > 1:
            mixed[:1 - n] = mixed[:1 - n] * np.uint64(0x9E3779B97F4A7C15) + codes[n - 1:]
        value = (mixed ^ mixed >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
        hashed.append((value >> np.uint64(64 - BITS)).astype(np.int64))
        # a mark by itself tells nothing
        here.append((left >= n) if n > 1 else (left > 1) & (left < np.repeat(sizes, sizes)))
    return starts, hashed, here


@dataclass
class Model:
    langs: list[str]
    logs: np.ndarray  # by n-gram and language


def learn(docs: DataFrame, lang: str = "lang", text: str = "text", key: str = "doc_id", per_lang: int = PER_LANG,
          langs: int = LANGS) -> Model:
    """Count n-grams in at most per_lang documents of each of the commonest languages and smooth the shares.

    The three lengths of n-grams tell of the same letters, so each has a third of the weight. Of rows with one key and
    language the text with the least hash counts. Languages beyond the commonest are never predicted.
    """
    rows = docs.select(F.col(lang).alias("lang"), F.col(key).alias("key"), F.col(text).alias("text")).where("text IS NOT NULL")
    common = rows.where("lang IS NOT NULL").groupBy("lang").count().orderBy(F.col("count").desc(), "lang").limit(langs)
    # as many rows as languages are learned
    known = docs.select(F.col(lang).alias("lang"), F.col(key).alias("key")).join(F.broadcast(common.select("lang")), "lang")
    ids = bounded_sample(known.distinct(), "lang", "key", per_lang)
    rows = rows.join(F.broadcast(ids), ["lang", "key"]).groupBy("lang", "key").agg(
        F.min_by("text", F.struct(F.xxhash64("text"), F.col("text"))).alias("text")
    ).select("lang", "text")

    def run(batches):
        import pyarrow as pa

        counts = {}
        for batch in batches:
            words = {}
            for name, t in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                words.setdefault(name, Counter()).update(words_of(t))
            for name, seen in words.items():
                into = counts.setdefault(name, np.zeros(1 << BITS, np.int64))
                if seen:
                    starts, hashed, here = grams(list(seen))
                    k = np.repeat(np.fromiter(seen.values(), np.int64), np.diff(np.append(starts, len(hashed[0]))))
                    for at, use in zip(hashed, here):
                        np.add.at(into, at[use], k[use])
        for name, into in counts.items():
            at = np.flatnonzero(into)
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([name] * len(at), pa.string()), "gram": pa.array(at, pa.int64()), "n": pa.array(into[at], pa.int64())
            })

    counts = rows.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    # of fixed size for each language
    found = counts.toArrow()
    langs = sorted(set(found.column("lang").to_pylist()))
    table = np.zeros((1 << BITS, len(langs)))
    if langs:
        place = {name: i for i, name in enumerate(langs)}
        table[found.column("gram").to_numpy(), [place[x] for x in found.column("lang").to_pylist()]] = found.column("n").to_numpy()
    kinds = (table.sum(axis=1) > 0).sum() + 1
    return Model(langs, np.log((table + SMOOTHING) / (table.sum(axis=0) + SMOOTHING * kinds)).astype(np.float32) / 3)


def _rows_of(starts: np.ndarray, sizes: np.ndarray, keep: np.ndarray) -> np.ndarray:
    """Places of the words of the kept documents."""
    sizes = sizes[keep]
    return np.repeat(starts[keep] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


def _steps(logs: np.ndarray, counts: np.ndarray, starts: np.ndarray, parts: np.ndarray, done):
    """Steps of expectation-maximisation from the given shares, until done tells which documents are settled.

    Gives the shares and log-likelihood of each document. done sees documents, their log-likelihood, and the most that any
    shares of the same languages reach: with gains g (by which a step multiplies the shares), at most words x log(max g) above.
    """
    sizes = np.diff(np.append(starts, len(counts)))
    top = logs.max(axis=1)
    like, base = np.exp(logs - top[:, None]), np.add.reduceat(counts * top, starts)
    out, value = parts.copy(), np.zeros(len(starts))
    here, begin = np.arange(len(starts)), starts
    while len(here):
        doc = np.repeat(np.arange(len(here)), sizes[here])
        total = np.add.reduceat(counts, begin)
        mixed = (like * parts[doc]).sum(axis=1).clip(1e-300)
        gains = np.add.reduceat(like * (counts / mixed)[:, None], begin, axis=0) / total[:, None]
        value[here] = np.add.reduceat(counts * np.log(mixed), begin) + base[here]
        out[here] = parts
        most = value[here] + total * np.log(np.where(parts > 0, gains, 0).max(axis=1).clip(1))
        stay = np.flatnonzero(~done(here, value[here], most))
        if len(stay) < len(here):
            rows = _rows_of(begin, sizes[here], stay)
            like, counts = like[rows], counts[rows]
            here, parts, gains = here[stay], parts[stay], gains[stay]
            begin = np.cumsum(sizes[here]) - sizes[here]
        parts = parts * gains
        parts /= parts.sum(axis=1, keepdims=True)
    return out, value


def mixture(logs: np.ndarray, counts: np.ndarray, starts: np.ndarray, allowed: np.ndarray, tolerance: float = TOLERANCE):
    """Shares and log-likelihood of each document, within the tolerance of the largest: rows starts[i]:starts[i+1] are its words.

    logs are by language; allowed tells for each document which languages may have a share.
    """
    parts = allowed / allowed.sum(axis=1, keepdims=True)
    return _steps(logs, counts, starts, parts, lambda at, value, most: most - value < tolerance)


def choose(logs: np.ndarray, counts: np.ndarray, starts: np.ndarray, penalty: float = PENALTY) -> np.ndarray:
    """The shares of each document's languages in the set with the best penalised likelihood."""
    n = logs.shape[1]
    single = np.add.reduceat(logs * counts[:, None], starts, axis=0)
    best, value = single.argmax(axis=1), single.max(axis=1)
    out = np.zeros((len(starts), n))
    out[np.arange(len(starts)), best] = 1
    if n == 1:
        return out
    price = penalty + 0.5 * np.log(np.add.reduceat(counts, starts) + 1)
    # No set does better than all languages: where these don't pay for a second one, the best one stays. Most documents are
    # settled in the first step, from either side.
    near = np.full((len(starts), n), (1 - SURE) / (n - 1))
    near[np.arange(len(starts)), best] = SURE

    def settled(at, now, most):
        return (most - value[at] <= price[at]) | (now - value[at] > price[at]) | (most - now < TOLERANCE)

    full = _steps(logs, counts, starts, near, settled)[1]
    open_ = np.flatnonzero(full - value > price)
    if not len(open_):
        return out
    sizes = np.diff(np.append(starts, len(counts)))
    rows = _rows_of(starts, sizes, open_)
    logs, counts, sizes = logs[rows], counts[rows], sizes[open_]
    starts, value = np.cumsum(sizes) - sizes, value[open_]
    order = np.argsort(-mixture(logs, counts, starts, np.ones((len(open_), n)))[0], axis=1, kind="stable")
    for k in range(2, n + 1):
        allowed = np.zeros((len(open_), n))
        np.put_along_axis(allowed, order[:, :k], 1, axis=1)
        found, fit = mixture(logs, counts, starts, allowed)
        gain = fit - (k - 1) * price[open_]
        better = gain > value
        out[open_[better]] = found[better]
        value = np.maximum(gain, value)
    return out


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """docs with lang_pred, score and languages, from the text alone; they replace input columns of their names.

    lang_pred is the language with the largest share (the first by name if several have it) and score its share;
    languages maps the chosen set to shares. A null text, one without a letter, or a model without languages gives
    und, 0 and an empty map.
    """
    names = ["lang_pred", "score", "languages"]
    docs = docs.drop(*names)
    shared = share(docs.sparkSession, model)

    def run(batches):
        import pyarrow as pa

        model, places = shared(), {}
        n = len(model.langs)
        known, used = np.zeros((1 << 12, n), np.float32), 0
        for batch in batches:
            for part in slices(batch, text):
                found = [words_of(t) if t and n else {} for t in part.column(text).to_pylist()]
                if len(places) > MEMORY:
                    places.clear()
                    used = 0
                new = list({w for c in found for w in c if w not in places})
                if new:
                    starts, hashed, here = grams(new)
                    logs = sum(np.add.reduceat(model.logs[at] * use[:, None], starts, axis=0) for at, use in zip(hashed, here))
                    while used + len(new) > len(known):
                        known = np.concatenate((known, np.zeros_like(known)))
                    known[used:used + len(new)] = logs
                    places.update(zip(new, range(used, used + len(new))))
                    used += len(new)
                has = [i for i, c in enumerate(found) if c]
                shares = np.zeros((len(found), n))
                if has:
                    sizes = np.array([len(found[i]) for i in has])
                    at = np.fromiter((places[w] for i in has for w in found[i]), np.int64)
                    counts = np.fromiter((k for i in has for k in found[i].values()), np.float64)
                    shares[has] = choose(known[at].astype(np.float64), counts, np.cumsum(sizes) - sizes)
                top = shares.argmax(axis=1) if n else []
                pred, value, sets = ["und"] * len(found), [0.0] * len(found), [[] for _ in found]
                for i in has:
                    pred[i], value[i] = model.langs[top[i]], min(1.0, float(shares[i, top[i]]))
                    sets[i] = [(model.langs[k], float(shares[i, k])) for k in np.flatnonzero(shares[i])]
                yield pa.RecordBatch.from_arrays([
                    *part.columns, pa.array(pred, pa.string()), pa.array(value, pa.float64()),
                    pa.array(sets, pa.map_(pa.string(), pa.float64())),
                ], names=[*part.schema.names, *names])

    kinds = (T.StringType(), T.DoubleType(), T.MapType(T.StringType(), T.DoubleType()))
    schema = T.StructType([*docs.schema.fields, *(T.StructField(c, k) for c, k in zip(names, kinds))])
    return docs.mapInArrow(run, schema)
