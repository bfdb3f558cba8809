"""Spelling variants: words that one inserted, deleted or replaced letter turns into each other.

Words are counted over whole texts. Two words at one edit have letter counts at a squared distance of 1 (lengths that
differ by one) or 2 (equal lengths). The squared distances of a block of words come from one product of its letter-count
matrix with itself; pairs at most two apart are then compared letter by letter.

Blocks are made so that every such pair meets in exactly one. Letters are dealt into a few groups, and a word's signature
is its number of letters in each group. One edit moves one letter from one group to another at most, so both words lose one
letter to the same smaller signature, or one of them has it. A block, called a cell here, is all words of a
signature together with the words that are one letter above it. A cell of more than PART words is cut into parts that meet
pairwise.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import slices
from tidemark.session import freeze

LEAST_LETTERS = 5
LEAST_COUNT = 3
#: One run in so many, by the checksum of its document and letters, is read with a letter missing.
EVERY = 97
#: Words of a cell's part, about.
PART = 1024
#: Partial counts that a task holds before it hands them on.
HELD = 200_000
#: Letters that are compared at once.
STEP = 1 << 22
RUN = "[A-Za-zÀ-ÿ]+"


def count_words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", every: int = EVERY) -> DataFrame:
    """word and n of all texts: runs of letters, A-Z lower-cased.

    Where every divides the checksum h (CRC-32 of doc_id, a colon and the run), letter h mod length is left out. A row
    without doc_id has no checksum, so its runs stay whole. Null texts have no words.
    """
    rows = docs.select(F.col(doc_id).cast("string").alias("doc_id"), F.col(text).alias("text")).where("text IS NOT NULL")

    def run(batches):
        import re
        from collections import Counter
        from zlib import crc32

        import pyarrow as pa

        lower = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
        find, counts = re.compile(RUN).findall, Counter()

        def partial():
            out = pa.RecordBatch.from_arrays(
                [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"]
            )
            counts.clear()
            return out

        for batch in batches:
            for part in slices(batch, "text"):
                for name, raw in zip(part.column("doc_id").to_pylist(), part.column("text").cast(pa.binary()).to_pylist()):
                    found = Counter(find(raw.translate(lower).decode()))
                    if name is None:
                        counts.update(found)
                    else:
                        start = crc32(f"{name}:".encode())
                        for word, k in found.items():
                            h = crc32(word.encode(), start)
                            if h % every == 0:
                                at = h % len(word)
                                word = word[:at] + word[at + 1:]
                            counts[word] += k
                    if len(counts) > HELD:
                        yield partial()
        if counts:
            yield partial()

    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def groups_of(words: DataFrame, n: int) -> list[str]:
    """The letters of n groups, dealt out from the commonest letter down so that no group outweighs the others."""
    letters = words.select(F.explode(F.array_distinct(F.split("word", ""))).alias("letter")).groupBy("letter").count()
    # the alphabet bounds the rows
    order = [r.letter for r in letters.orderBy(F.col("count").desc(), "letter").collect() if r.letter]
    return ["".join(order[i::n]) for i in range(n)]


def signature(groups: list[str]) -> Column:
    """The number of letters in each group."""
    size = F.char_length("word")
    return F.array(*(size - F.char_length(F.translate("word", g, "")) for g in groups if g))


def in_cells(words: DataFrame, groups: list[str], part: int = PART) -> DataFrame:
    """cell, lo, hi and members (word, n, part): in (lo, hi) meet the words of part lo with those of part hi.

    The number of parts follows from the cell's count, so a cell that very many words share is spread over its pairs of
    parts; each list holds two parts at most.
    """
    sig = signature(groups)
    below = F.transform(
        F.filter(F.sequence(F.lit(0), F.size("sig") - 1), lambda i: F.get("sig", i) > 0),
        lambda i: F.transform("sig", lambda x, at: x - F.when(at == i, 1).otherwise(0)),
    )
    rows = words.withColumn("sig", sig).select(
        "word", "n", F.explode(F.concat(F.array("sig"), below)).alias("cell")
    ).withColumn("cell", F.array_join("cell", " "))
    rows = freeze(rows)
    # stored: a join straight on the counts would share their shuffle, and Spark could not split a hot cell
    sizes = freeze(rows.groupBy("cell").agg(F.count(F.lit(1)).alias("m")).where("m > 1").withColumn("parts", F.ceil(F.col("m") / part)))
    dealt = rows.join(sizes, "cell").withColumn("part", F.pmod(F.xxhash64("word"), F.col("parts")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("parts").cast("int") - 1)).alias("other")
    dealt = dealt.select("cell", "word", "n", "part", other)
    return dealt.groupBy("cell", F.least("part", "other").alias("lo"), F.greatest("part", "other").alias("hi")).agg(
        F.collect_list(F.struct("word", "n", "part")).alias("members")
    )


def near_in(words: list[str], parts: np.ndarray, within: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs of words at one edit, the shorter word first. Without within, only pairs of different parts.

    The words are those of one cell, so their lengths differ by one at most.
    """
    raw = [w.encode("latin-1") for w in words]
    sizes = np.fromiter(map(len, raw), np.int64, len(raw))
    wide = int(sizes.max())
    codes = np.frombuffer(b"".join(x.ljust(wide, b"\0") for x in raw), np.uint8).reshape(len(raw), wide)
    used, place = np.unique(codes, return_inverse=True)
    place = place.reshape(codes.shape)
    counts = np.zeros((len(raw), len(used)), np.float64 if wide > 1000 else np.float32)
    np.add.at(counts, (np.repeat(np.arange(len(raw)), wide), place.ravel()), 1)
    counts = counts[:, used != 0]
    square = (counts * counts).sum(axis=1)
    gram = counts @ counts.T
    gram *= -2
    gram += square[:, None]
    gram += square[None, :]
    first, second = np.nonzero(np.triu(gram <= 2, 1))
    if not within:
        keep = parts[first] != parts[second]
        first, second = first[keep], second[keep]
    turn = sizes[first] > sizes[second]
    first, second = np.where(turn, second, first), np.where(turn, first, second)
    good = np.zeros(len(first), bool)
    step = max(1, STEP // wide)
    for at in range(0, len(first), step):
        i, j = first[at:at + step], second[at:at + step]
        a, b, small = codes[i], codes[j], sizes[i]
        even = small == sizes[j]
        one = (a != b).sum(axis=1) == 1
        # a letter left out of the longer word: what agrees from the start and what agrees from the end cover the shorter
        head = np.logical_and.accumulate(a == b, axis=1).sum(axis=1)
        same = np.logical_or(a[:, :-1] == b[:, 1:], np.arange(wide - 1) >= small[:, None])
        tail = np.logical_and.accumulate(same[:, ::-1], axis=1).sum(axis=1) - (wide - 1 - small)
        good[at:at + step] = np.where(even, one, np.minimum(head, small) + tail >= small)
    return first[good], second[good]


def variants(words: DataFrame, part: int = PART) -> DataFrame:
    """word, n, n_near and the best near word (form_n, form): what count_words gives, with the neighbours of each word."""
    n_words = words.count()
    groups = groups_of(words, max(2, math.ceil(math.log2(n_words + 1) / 2) - 4))
    letters = [set(g) for g in groups if g]

    def run(batches):
        import pyarrow as pa

        def sig_of(word):
            return tuple(sum(c in g for c in word) for g in letters)

        for batch in batches:
            cells, lows, highs = (batch.column(c) for c in ("cell", "lo", "hi"))
            for k in range(batch.num_rows):
                items = batch.column("members").slice(k, 1).flatten()
                names = items.field("word").to_pylist()
                n, parts = items.field("n").to_numpy(), items.field("part").to_numpy()
                i, j = near_in(names, parts, lows[k].as_py() == highs[k].as_py())
                if not len(i):
                    continue
                # longer words of one signature meet in the cell of that signature
                own = tuple(map(int, cells[k].as_py().split()))
                sigs = {p: sig_of(names[p]) for p in np.unique(np.concatenate((i, j))).tolist()}
                keep = np.array([sigs[p] != sigs[q] or sigs[p] == own for p, q in zip(i.tolist(), j.tolist())])
                i, j = i[keep], j[keep]
                if not len(i):
                    continue
                me, near = np.concatenate((i, j)), np.concatenate((j, i))
                place = np.empty(len(names), np.int64)
                place[sorted(range(len(names)), key=names.__getitem__)] = np.arange(len(names))
                order = np.lexsort((place[near], -n[near], me))
                me, near = me[order], near[order]
                begin = np.flatnonzero(np.concatenate(([True], me[1:] != me[:-1])))
                yield pa.RecordBatch.from_arrays([
                    pa.array([names[p] for p in me[begin].tolist()], pa.string()), pa.array(np.zeros(len(begin), np.int64)),
                    pa.array(np.diff(np.append(begin, len(me)))), pa.array(n[near[begin]]),
                    pa.array([names[p] for p in near[begin].tolist()], pa.string()),
                ], names=["word", "n", "n_near", "form_n", "form"])

    found = in_cells(words, groups, part).mapInArrow(run, "word string, n long, n_near long, form_n long, form string")
    alone = words.select("word", "n", F.lit(0).cast("long").alias("n_near"), F.lit(None).cast("long").alias("form_n"),
                         F.lit(None).cast("string").alias("form"))
    best = F.min(F.when(F.col("form").isNotNull(), F.struct((-F.col("form_n")).alias("n"), F.col("form").alias("form"))))
    return alone.unionByName(found).groupBy("word").agg(
        F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best.alias("b")
    ).select("word", "n", "n_near", (-F.col("b.n")).alias("form_n"), F.col("b.form").alias("form"))


def roots(forms: DataFrame) -> DataFrame:
    """Add root: the end of the way from a word over its forms; the word itself where it has none.

    Counts at least double on the way, so it has no rings and at most 62 steps. Every round doubles the steps taken.
    """
    now = forms.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        now = freeze(now)
        ahead = now.select(F.col("word").alias("_at"), F.col("root").alias("_next"))
        stepped = now.join(ahead, F.col("root") == F.col("_at"), "left")
        if stepped.where("_next IS NOT NULL").isEmpty():
            break
        now = stepped.select("word", F.coalesce("_next", "root").alias("root"))
    return forms.join(now, "word", "left").withColumn("root", F.coalesce("root", "word"))


def group(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_letters: int = LEAST_LETTERS,
          least_count: int = LEAST_COUNT, every: int = EVERY, part: int = PART) -> DataFrame:
    """word, form, root, n, n_near and form_n of the words with enough letters and occurrences.

    form is the near word with the largest n, the smaller in code-point order of equals, if its n is at least twice the
    word's. Null and empty texts and other columns play no part; repeated rows count as often as they stand there; an
    empty table gives no rows.
    """
    words = count_words(docs, doc_id, text, every)
    words = freeze(words.where((F.char_length("word") >= least_letters) & (F.col("n") >= least_count)))
    near = variants(words, part)
    pays = F.col("form_n") >= 2 * F.col("n")
    forms = near.withColumn("form", F.when(pays, F.col("form"))).withColumn("form_n", F.when(pays, F.col("form_n")))
    return roots(freeze(forms)).select("word", "form", "root", "n", "n_near", "form_n")
