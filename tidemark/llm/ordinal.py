"""Quality classifier: ordinal regression with cumulative logits on hashed text.

Grades are ordered (0 toxic, 1 of low quality, 2 good). One weight vector over hashed features gives a text's place on a
line, and ordered thresholds cut the line: P(grade > k) = sigmoid(place - threshold k). A text is selected by its tail
probability, that of the best grade.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import bounded_sample, share, slices, tidied
from tidemark.session import freeze

GRADES = 3
BITS = 18
#: Labelled rows of each grade that the model is fitted on, at most.
PER_GRADE = 6000
MIN_DOCS = 3
ROUNDS = 150
RIDGE = 2e-5
SELECT = 0.5
#: Tokens that are remembered, and the longest of them.
MEMORY = 100_000
KNOWN = 200
SHARE = 16.0
EVIDENCE = 4.0
START = 4


class Features:
    """Hashed features of texts: which words and word starts occur, and the shares of tokens by shape and by repetition.

    A word is a token (split at white space) in lower case without punctuation at its ends; its value is one however
    often it occurs. A token's shape keeps runs of upper case, lower case and digits as one sign each, and other signs.
    Words and their first START letters have the lower half of the hash values.
    """

    def __init__(self, bits: int = BITS):
        self.half, self.tokens = 1 << (bits - 1), {}

    def _hash(self, kind: str, value: str) -> int:
        import xxhash

        place = xxhash.xxh64_intdigest(f"{kind}{value}".encode("utf-8", "replace")) % self.half
        return place if kind in "wp" else place + self.half

    def _token(self, token: str) -> tuple[int, int, int]:
        low = token.lower()
        word = low.strip(low.translate({ord(c): None for c in low if c.isalnum()}) or None)
        shape = last = ""
        for c in token:
            sign = "A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c
            if sign != last:
                shape += sign
                last = sign
        start = self._hash("p", word[:START]) if len(word) > START else -1
        return (self._hash("w", word) if word else -1), start, self._hash("s", shape)

    def of(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        from collections import Counter

        tokens = (text or "").split()
        if not tokens:
            return np.zeros(0, np.int32), np.zeros(0, np.float32)
        counts, n = Counter(tokens), len(tokens)
        known = self.tokens
        if len(known) > MEMORY:
            known.clear()
        words, shapes = set(), {}
        for token, k in counts.items():
            found = known.get(token)
            if found is None:
                found = self._token(token)
                if len(token) <= KNOWN:
                    known[token] = found
            words.update(found[:2])
            shapes[found[2]] = shapes.get(found[2], 0) + k
        words.discard(-1)
        shapes[self._hash("d", "repeated")] = sum(map(str.__eq__, tokens, tokens[1:]))
        shapes[self._hash("d", "most frequent")] = counts.most_common(1)[0][1]
        ids = np.fromiter([*words, *shapes], np.int32, len(words) + len(shapes))
        values = np.ones(len(ids), np.float32)
        values[len(words):] = np.fromiter(shapes.values(), np.float32, len(shapes)) * (SHARE / n)
        return ids, values


@dataclass
class Model:
    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, place: np.ndarray) -> np.ndarray:
        """P(grade > k) for every place and k."""
        return 1 / (1 + np.exp(np.clip(self.thresholds - np.asarray(place)[..., None], -30, 30)))


def telling(seen: np.ndarray, rows: np.ndarray, entries: np.ndarray, bits: int = BITS, min_docs: int = MIN_DOCS,
            evidence: float = EVIDENCE) -> np.ndarray:
    """Which features get a weight, from the rows of each grade that have them (by feature and grade).

    rows and entries are the rows of each grade and the features in them. Features of fewer than min_docs rows get none, and
    words only where a grade holds evidence standard errors more or less of their rows than its part of all rows, and than
    its part of all text: the many words that say nothing would blur the few that do.
    """
    docs, share = seen.sum(axis=1), rows.astype(float)
    clear = np.arange(len(seen)) >= 1 << (bits - 1)
    length = entries / max(1, entries.sum())
    for k in np.flatnonzero((share > 0) & (share < share.sum())):
        score = lambda part: (seen[:, k] - docs * part) / np.sqrt((docs * part * (1 - part)).clip(1e-12))
        by_row, by_length = score(share[k] / share.sum()), score(length[k])
        clear |= (by_row * by_length > 0) & (np.minimum(np.abs(by_row), np.abs(by_length)) >= evidence)
    return clear & (docs >= min_docs)


def train(grades: np.ndarray, ids: np.ndarray, values: np.ndarray, ends: np.ndarray, bits: int = BITS,
          min_docs: int = MIN_DOCS, rounds: int = ROUNDS, ridge: float = RIDGE, evidence: float = EVIDENCE,
          good: np.ndarray | None = None) -> Model:
    """Fit weights and thresholds by Adam on the log-likelihood, each grade with the same total weight.

    Row i has the features ids[ends[i-1]:ends[i]]. good tells which features get a weight; by default telling() does. Without
    rows all weights are zero and the best grade has probability one half.
    """
    thresholds = np.arange(GRADES - 1, dtype=float) - (GRADES - 2)
    model = Model(np.zeros(1 << bits), thresholds)
    if not len(grades):
        return model
    row = np.repeat(np.arange(len(grades)), np.diff(np.concatenate(([0], ends))))
    share = np.bincount(grades, minlength=GRADES).astype(float)
    if good is None:
        seen = np.bincount(ids.astype(np.int64) * GRADES + grades[row], minlength=GRADES << bits).reshape(-1, GRADES)
        good = telling(seen, share, np.bincount(grades[row], minlength=GRADES), bits, min_docs, evidence)
    keep = good[ids]
    slot = np.cumsum(good) - 1
    used, row, column, values = np.flatnonzero(good), row[keep], slot[ids[keep]], values[keep].astype(float)
    weight = (1 / (share * (share > 0).sum()).clip(1e-9))[grades]
    # what is fitted: the weights, the first threshold and the logarithms of the gaps between thresholds
    size = len(used)
    x = np.concatenate((np.zeros(size), thresholds[:1], np.zeros(GRADES - 2)))
    first, second = np.zeros_like(x), np.zeros_like(x)
    for t in range(1, rounds + 1):
        w, cuts = x[:size], x[size] + np.concatenate(([0.0], np.cumsum(np.exp(x[size + 1:]))))
        place = np.bincount(row, values * w[column], minlength=len(grades))
        below = 1 / (1 + np.exp(-np.clip(cuts - place[:, None], -30, 30)))
        below = np.concatenate((np.zeros((len(grades), 1)), below, np.ones((len(grades), 1))), axis=1)
        i = np.arange(len(grades))
        high, low = below[i, grades + 1], below[i, grades]
        p = (high - low).clip(1e-9)
        slope = weight * (high + low - 1)  # of the log-likelihood by the place
        by_cut = np.zeros(GRADES - 1)
        for k in range(GRADES - 1):
            dense = below[:, k + 1] * (1 - below[:, k + 1])
            by_cut[k] = (weight * dense / p * ((grades == k).astype(float) - (grades == k + 1))).sum()
        gaps = np.exp(x[size + 1:]) * np.cumsum(by_cut[::-1])[::-1][1:]
        up = np.concatenate((np.bincount(column, values * slope[row], minlength=size), [by_cut.sum()], gaps))
        up[:size] -= ridge * w
        up[size + 1:] -= 1e-3 * x[size + 1:]
        first, second = 0.9 * first + 0.1 * up, 0.99 * second + 0.01 * up**2
        x = x + 0.1 * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.99**t)) + 1e-8)
    model.weights[used] = x[:size]
    model.thresholds = x[size] + np.concatenate(([0.0], np.cumsum(np.exp(x[size + 1:]))))
    return model


def grades_of(labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """key and grade of every rated document: 0 where a row calls it toxic, else 1 where one calls it of low quality, else 2."""
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(
        F.col("toxic").isNotNull() | F.col("quality").isNotNull(), 2
    )
    return labels.select(F.col(key).alias("key"), grade.alias("grade")).where(
        F.col("key").isNotNull() & F.col("grade").isNotNull()
    ).groupBy("key").agg(F.min("grade").alias("grade"))


def fit(docs: DataFrame, grades: DataFrame, doc_id: str = "doc_id", text: str = "text", per_grade: int = PER_GRADE,
        bits: int = BITS) -> Model:
    """Fit on at most per_grade rated documents of each grade (key, grade), one row per doc_id.

    Of rows with one doc_id the text with the least hash counts. Which features tell the grades apart is counted in Spark, a
    table of fixed size; only those of the documents, not their texts, come to the driver, GRADES times per_grade rows at most.
    """
    sample = bounded_sample(grades, "grade", "key", per_grade)
    rows = docs.select(F.col(doc_id).alias("key"), F.col(text).alias("text")).join(F.broadcast(sample), "key")
    rows = rows.groupBy("key", F.col("grade").cast("int").alias("grade")).agg(
        F.min_by("text", F.struct(F.xxhash64("text"), F.col("text"))).alias("text")
    )

    def run(batches):
        import pyarrow as pa

        features = Features(bits)
        for batch in batches:
            for part in slices(batch, "text"):
                found = [features.of(t) for t in part.column("text").to_pylist()]
                ends = pa.array(np.cumsum([0, *(len(i) for i, _ in found)]).astype(np.int32))
                yield pa.RecordBatch.from_arrays([
                    part.column("key"), part.column("grade"),
                    pa.ListArray.from_arrays(ends, pa.array(np.concatenate([i for i, _ in found]).astype(np.int32))),
                    pa.ListArray.from_arrays(ends, pa.array(np.concatenate([v for _, v in found]).astype(np.float32))),
                ], names=["key", "grade", "ids", "values"])

    schema = T.StructType([
        rows.schema["key"], T.StructField("grade", T.IntegerType()), T.StructField("ids", T.ArrayType(T.IntegerType())),
        T.StructField("values", T.ArrayType(T.FloatType())),
    ])
    found = freeze(rows.mapInArrow(tidied(run), schema))
    counts = found.select("grade", F.explode("ids").alias("id")).groupBy("id", "grade").agg(F.count(F.lit(1)).alias("n")).toArrow()
    seen = np.zeros((1 << bits, GRADES), np.int64)
    seen[counts.column("id").to_numpy(), counts.column("grade").to_numpy()] = counts.column("n").to_numpy()
    sizes = {r.grade: r.n for r in found.groupBy("grade").agg(F.count(F.lit(1)).alias("n")).collect()}
    good = telling(seen, np.array([sizes.get(k, 0) for k in range(GRADES)]), seen.sum(axis=0), bits)
    chosen = share(docs.sparkSession, good)

    def kept(batches):
        import pyarrow as pa

        good = chosen()
        for batch in batches:
            ids, values = batch.column("ids"), batch.column("values")
            sizes = ids.value_lengths().to_numpy()
            flat, weights = ids.flatten().to_numpy(), values.flatten().to_numpy()
            keep = good[flat]
            row = np.repeat(np.arange(len(sizes)), sizes)[keep]
            ends = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=len(sizes))))).astype(np.int32)
            flat, weights = flat[keep], weights[keep]
            yield pa.RecordBatch.from_arrays([
                batch.column("key"), batch.column("grade"),
                pa.array([flat[a:b].tobytes() for a, b in zip(ends, ends[1:])], pa.binary()),
                pa.array([weights[a:b].tobytes() for a, b in zip(ends, ends[1:])], pa.binary()),
            ], names=["key", "grade", "ids", "values"])

    schema = T.StructType([
        rows.schema["key"], T.StructField("grade", T.IntegerType()), T.StructField("ids", T.BinaryType()),
        T.StructField("values", T.BinaryType()),
    ])
    found = found.mapInArrow(tidied(kept), schema).orderBy("key").toArrow()
    ids = [np.frombuffer(x, np.int32) for x in found.column("ids").to_pylist()]
    values = [np.frombuffer(x, np.float32) for x in found.column("values").to_pylist()]
    flat = lambda a, kind: np.concatenate(a) if a else np.zeros(0, kind)
    return train(
        found.column("grade").to_numpy().astype(int), flat(ids, np.int32), flat(values, np.float32),
        np.cumsum([len(x) for x in ids], dtype=int), bits, good=good,
    )


def score(docs: DataFrame, model: Model, text: str = "text", select: float = SELECT) -> DataFrame:
    """docs with expected_grade (0 to 2), tail (the best grade's probability) and selected (tail >= select).

    These replace input columns of their names. Null texts and texts without words have grade 0 and aren't selected.
    One pass over whole texts without a shuffle; the weights are a broadcast of fixed size.
    """
    names = ["expected_grade", "tail", "selected"]
    docs = docs.drop(*names)
    shared = share(docs.sparkSession, model)
    bits = len(model.weights).bit_length() - 1

    def run(batches):
        import pyarrow as pa

        model, features = shared(), Features(bits)
        for batch in batches:
            for part in slices(batch, text):
                found = [features.of(t) for t in part.column(text).to_pylist()]
                has = np.array([len(i) > 0 for i, _ in found], bool)
                tails = model.tails(np.array([float(model.weights[i] @ v) for i, v in found])) * has[:, None]
                yield pa.RecordBatch.from_arrays([
                    *part.columns, pa.array(tails.sum(axis=1)), pa.array(tails[:, -1]), pa.array((tails[:, -1] >= select) & has),
                ], names=[*part.schema.names, *names])

    schema = T.StructType([
        *docs.schema.fields, *(T.StructField(n, t) for n, t in zip(names, (T.DoubleType(), T.DoubleType(), T.BooleanType())))
    ])
    return docs.mapInArrow(tidied(run), schema)
