"""Benchmark decontamination: BM25 retrieval of test items for every training passage, then overlap checks.

The index holds the test items; passages are the queries. An item's term weights are divided by the item's score against
itself, so one threshold suits short and long items: a passage holding all of an item's words scores one. Items are
numbered by length and lie in blocks of neighbouring numbers, each with the largest weight of every term, as in
block-max WAND with a fixed threshold: a passage is dropped if the list maxima of its terms don't reach the threshold,
a block is skipped if its block maxima don't, and only the postings of the other blocks are read. All passages of a
batch take each step together in numpy.

What BM25 counts (items, items with a term, mean length) is counted over all items in Spark, and a passage's length follows from
the class of lengths that an item is in, so scores and findings don't depend on how many indexes the items are dealt into.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import share, slices, tidied
from tidemark.session import freeze

K1 = 1.2
B = 0.75
THRESHOLD = 0.6
SHINGLE = 5
OVERLAP = 0.8
#: Items of one index, and bytes of their texts, about; and indexes that one pass over the documents asks.
ITEMS = 2048
BYTES = 4 << 20
INDEXES = 16
BLOCKS = 64
#: The shortest class of lengths: items of up to 64 words, then 256, 1024, ...
SHORT = 64
MEMORY = 100_000
RESULT = "item_id long, n_words long, start long, bm25 double, overlap double, question_overlap double, answer_overlap double"


def normal(token: str) -> str:
    """A token in lower case without the signs at its ends that are neither letters nor digits; may be empty."""
    token = token.lower()
    a, b = 0, len(token)
    while a < b and not token[a].isalnum():
        a += 1
    while b > a and not token[b - 1].isalnum():
        b -= 1
    return token[a:b]


def words_of(text: str | None) -> list[str]:
    return [w for t in (text or "").split() if (w := normal(t))]


def parts_of(text: str) -> tuple[list[str], list[str]]:
    """Question and answer: an item's last sentence is the answer, or its last third if that sentence is all or too short."""
    sentences = re.split(r"(?<=[.?!])\s+", text.strip())
    question, answer = words_of(" ".join(sentences[:-1])), words_of(sentences[-1])
    if not question or len(answer) < 3:
        words = words_of(text)
        cut = len(words) - max(1, len(words) // 3)
        question, answer = words[:cut], words[cut:]
    return question, answer


def shingles(words: list[str], size: int = SHINGLE) -> set[tuple[str, ...]]:
    return {tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def held(part: list[str], words: Counter) -> float:
    """The share of a part's words, counted as often as they occur, that are among the passage's words."""
    return sum(min(n, words[w]) for w, n in Counter(part).items()) / len(part) if part else 1.0


def length_class(n_words: int) -> int:
    """The bound of an item's class of lengths."""
    bound = SHORT
    while bound < n_words:
        bound *= 4
    return bound


@dataclass(frozen=True)
class Statistics:
    """What is counted over all items: their number, their mean length and the items that hold a term."""

    n: int
    mean: float
    docs: Mapping[str, int]

    @classmethod
    def of(cls, bags: list[Counter]) -> Statistics:
        return cls(len(bags), sum(map(Counter.total, bags)) / max(1, len(bags)), Counter(w for b in bags for w in b))


@dataclass
class Index:
    ids: list[int]
    parts: list[tuple[list[str], list[str]]]
    lengths: np.ndarray
    terms: dict[str, int]
    weights: np.ndarray  # the postings by term and item: items and weights
    items: np.ndarray
    edges: np.ndarray  # where the postings of each term and block begin
    top: np.ndarray  # by term
    blocks: np.ndarray  # by term and block
    size: int  # items of a block

    @classmethod
    def of(cls, rows: list[tuple[int, str]], statistics: Statistics | None = None) -> Index:
        """Index items (id, text) with at least one word; the statistics are those of all items there are."""
        found = [(i, parts_of(t)) for i, t in rows if t and words_of(t)]
        found.sort(key=lambda x: (len(x[1][0]) + len(x[1][1]), x[0], x[1]))
        bags = [Counter(q + a) for _, (q, a) in found]
        lengths = np.array([len(q) + len(a) for _, (q, a) in found], np.int64)
        known, n = statistics or Statistics.of(bags), len(found)
        terms: dict[str, int] = {}
        term, item, weight = [], [], []
        for i, bag in enumerate(bags):
            norm = K1 * (1 - B + B * lengths[i] / known.mean)
            score = {
                w: math.log(1 + (known.n - known.docs[w] + 0.5) / (known.docs[w] + 0.5)) * k * (K1 + 1) / (k + norm) for w, k in bag.items()
            }
            whole = sum(score.values())
            for w, s in score.items():
                term.append(terms.setdefault(w, len(terms)))
                item.append(i)
                weight.append(s / whole)
        order = np.argsort(np.array(term, np.int64), kind="stable")
        items, weights = np.array(item, np.int64)[order], np.array(weight, float)[order]
        size = max(1, -(-n // BLOCKS))
        count = -(-n // size)
        cell = np.array(term, np.int64)[order] * count + items // size
        blocks = np.zeros((len(terms), count), np.float32)
        np.maximum.at(blocks.reshape(-1), cell, weights.astype(np.float32))
        edges = np.searchsorted(cell, np.arange(len(terms) * count + 1))
        return cls([i for i, _ in found], [p for _, p in found], lengths, terms, weights, items, edges,
                   blocks.max(axis=1, initial=0).astype(np.float64), blocks, size)

    @property
    def window(self) -> int:
        """Words of a passage: twice the class of its items, so that half-overlapping passages hold every item whole."""
        return 2 * length_class(int(self.lengths.max()))

    def retrieve(self, passage: np.ndarray, term: np.ndarray, count: int, threshold: float = THRESHOLD):
        """passage, item and score of every pair that reaches the threshold.

        passage and term are the passages' different terms, sorted by passage number below count.
        """
        threshold -= 1e-6  # block maxima are rounded
        reach = np.bincount(passage, self.top[term], minlength=count) >= threshold
        go = reach[passage]
        passage, term = passage[go], term[go]
        if not len(passage):
            return np.zeros(0, int), np.zeros(0, int), np.zeros(0)
        first = np.flatnonzero(np.diff(passage, prepend=-1))
        which, block = np.nonzero(np.add.reduceat(self.blocks[term], first, axis=0) >= threshold)
        ends = np.append(first[1:], len(passage))
        wide = self.blocks.shape[1]
        out = []
        for k, b in zip(which.tolist(), block.tolist()):  # few are left
            cell = term[first[k]:ends[k]] * wide + b
            begin, sizes = self.edges[cell], self.edges[cell + 1] - self.edges[cell]
            at = np.repeat(begin - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
            score = np.bincount(self.items[at] - b * self.size, self.weights[at], minlength=self.size)
            hits = np.flatnonzero(score >= threshold)
            out += [(passage[first[k]], b * self.size + i, score[i]) for i in hits.tolist()]
        p, i, s = zip(*out) if out else ((), (), ())
        return np.array(p, int), np.array(i, int), np.array(s, float)

    def overlap(self, item: int, words: list[str]) -> tuple[float, float, float]:
        """Shares of the item's shingles, of its question's words and of its answer's words that the passage holds."""
        question, answer = self.parts[item]
        whole = shingles(question + answer, min(SHINGLE, len(question) + len(answer)))
        seen, bag = shingles(words, min(SHINGLE, len(question) + len(answer))), Counter(words)
        return len(whole & seen) / len(whole), held(question, bag), held(answer, bag)


def _held(part, text: str, index: Index, known: dict[str, int], threshold: float, overlap: float) -> dict[tuple[int, int], tuple]:
    """For every row and item it holds the rates of the best passage, by (row, item).

    known remembers the terms of tokens from one call to the next.
    """
    window = index.window
    step = window // 2
    tokens = [(t or "").split() for t in part.column(text).to_pylist()]
    if len(known) > MEMORY:
        known.clear()
    for new in {t for row in tokens for t in row if t not in known}:
        w = normal(new)
        known[new] = index.terms.get(w, -1) if w else -2
    ids = [np.fromiter(map(known.__getitem__, row), np.int64, len(row)) for row in tokens]
    ids = [x[x != -2] for x in ids]
    # passages are numbered through the slice; a word lies in the two that overlap there
    counts = np.array([max(1, -(-len(x) // step) - 1) for x in ids])
    offset = np.cumsum(counts) - counts
    flat = np.concatenate(ids)
    half = np.concatenate([np.arange(len(x)) // step for x in ids])
    row = np.repeat(np.arange(len(ids)), [len(x) for x in ids])
    use = flat >= 0
    flat, half, row = flat[use], half[use], row[use]
    both = np.concatenate(((offset[row] + half)[half < counts[row]], (offset[row] + half - 1)[half > 0]))
    term = np.concatenate((flat[half < counts[row]], flat[half > 0]))
    n = len(index.terms)
    pairs = np.unique(both * n + term) if n else np.zeros(0, np.int64)
    passage, item, score = index.retrieve(pairs // max(1, n), pairs % max(1, n), int(counts.sum()), threshold)
    best: dict[tuple[int, int], tuple] = {}
    for p, i, s in zip(passage.tolist(), item.tolist(), score.tolist()):
        d = int(np.searchsorted(offset, p, "right")) - 1
        k = (p - int(offset[d])) * step
        words = [w for t in tokens[d] if (w := normal(t))]
        rates = index.overlap(i, words[k:k + window])
        if min(rates) >= overlap:
            best[d, i] = max(best.get((d, i), ()), (rates[0], min(s, 1.0), -k, rates[1], rates[2], len(words)))
    return best


def _search(docs: DataFrame, indexes: list[Index], text: str, threshold: float, overlap: float) -> DataFrame:
    """Rows of docs without their text, once for each item they hold, with the columns of RESULT."""
    shared = share(docs.sparkSession, indexes)

    def run(batches):
        import pyarrow as pa

        asked = [(index, {}) for index in shared()]
        for batch in batches:
            for part in slices(batch, text):
                for index, known in asked:
                    best = _held(part, text, index, known, threshold, overlap)
                    if not best:
                        continue
                    keys = sorted(best)
                    rows = [best[key] for key in keys]
                    taken = part.drop_columns([text]).take(pa.array([d for d, _ in keys]))
                    columns = [
                        pa.array([index.ids[i] for _, i in keys], pa.int64()), pa.array([r[5] for r in rows], pa.int64()),
                        pa.array([-r[2] for r in rows], pa.int64()), *(pa.array([r[c] for r in rows], pa.float64()) for c in (1, 0, 3, 4)),
                    ]
                    yield pa.RecordBatch.from_arrays([*taken.columns, *columns], names=[*taken.schema.names, *names])

    added = T.StructType.fromDDL(RESULT)
    names = added.names
    return docs.mapInArrow(tidied(run), T.StructType([*docs.drop(text).schema.fields, *added.fields]))


def _without(docs: DataFrame, indexes: list[Index], text: str, threshold: float, overlap: float) -> DataFrame:
    """Rows of docs that hold no item."""
    shared = share(docs.sparkSession, indexes)

    def run(batches):
        import pyarrow as pa

        asked = [(index, {}) for index in shared()]
        for batch in batches:
            for part in slices(batch, text):
                leaky = {d for index, known in asked for d, _ in _held(part, text, index, known, threshold, overlap)}
                yield part.filter(pa.array([d not in leaky for d in range(part.num_rows)])) if leaky else part

    return docs.mapInArrow(tidied(run), docs.schema)


def _read(items: DataFrame, item_id: str, item_text: str) -> DataFrame:
    """id, text, bytes, n_words, class and different terms of the items that have words and an id."""
    items = items.select(F.col(item_id).cast("long").alias("id"), F.col(item_text).alias("text")).where(
        F.col("id").isNotNull() & F.col("text").isNotNull()
    ).distinct()

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for part in slices(batch, "text"):
                words = [words_of(t) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([
                    *part.columns, pa.array(map(len, words), pa.int64()), pa.array([length_class(len(w)) for w in words], pa.int64()),
                    pa.array([sorted(set(w)) for w in words], pa.list_(pa.string())),
                ], names=["id", "text", "n_words", "class", "terms"])

    return items.mapInArrow(tidied(run), "id long, text string, n_words long, class long, terms array<string>").where("n_words > 0")


def _indexes(items: DataFrame, item_id: str, item_text: str, per_index: int) -> Iterator[list[Index]]:
    """Indexes of the items, as many at once as one pass over the documents asks; each holds items of one class of lengths."""
    rows = freeze(_read(items, item_id, item_text))
    whole = rows.agg(F.count(F.lit(1)).alias("n"), F.avg("n_words").alias("mean")).first()
    counts = freeze(rows.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n")))
    classes = rows.groupBy("class").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("size"))
    held = []
    for bound, n, size in sorted(map(tuple, classes.collect())):
        parts = max(-(-n // per_index), -(-size // BYTES))
        for k in range(parts):
            own = rows.where((F.col("class") == bound) & (F.pmod(F.xxhash64("id", "text"), F.lit(parts)) == k))
            found = own.select("id", "text").orderBy("id", "text").collect()
            terms = own.select(F.explode("terms").alias("term")).distinct().join(counts, "term").collect()
            if found:
                held.append(Index.of([tuple(r) for r in found], Statistics(whole.n, whole.mean, {r.term: r.n for r in terms})))
            if len(held) == INDEXES:
                yield held
                held = []
    if held:
        yield held


def leaks(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
          threshold: float = THRESHOLD, overlap: float = OVERLAP, per_index: int = ITEMS) -> DataFrame:
    """Rows of docs without their text, once for each benchmark item that a passage of them holds, and RESULT's columns.

    A passage holds an item if its BM25 score reaches threshold and it holds a share of at least overlap of the item's
    five-word shingles, of its question's words and of its answer's words. Of several passages the best counts. Items
    without a word or an id are left out, repeated items count once; items of one id but different texts each give rows.
    Null and empty documents hold nothing. Input columns with RESULT's names are replaced.

    Each index takes a part of the items by hash, bounded in items and bytes but for a single longer one, so what is
    broadcast is bounded; the documents are read once for every 16 indexes and never shuffled.
    """
    added = T.StructType.fromDDL(RESULT).names
    rows = docs.drop(*(c for c in added if c != text))
    out = None
    for indexes in _indexes(items, item_id, item_text, per_index):
        found = _search(rows, indexes, text, threshold, overlap)
        out = found if out is None else out.unionByName(found)
    if out is None:
        schema = T.StructType([*rows.drop(text).schema.fields, *T.StructType.fromDDL(RESULT).fields])
        return docs.sparkSession.createDataFrame([], schema)
    return out


def clean(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
          item_text: str = "text", threshold: float = THRESHOLD, overlap: float = OVERLAP, per_index: int = ITEMS) -> DataFrame:
    """docs without the rows that hold a benchmark item as leaks() finds them.

    Every row is judged by its own text, in one pass for every 16 indexes: doc_id isn't read, and may be null or repeated.
    """
    for indexes in _indexes(items, item_id, item_text, per_index):
        docs = _without(docs, indexes, text, threshold, overlap)
    return docs
