"""Substring dedup: words of passages that an earlier document has are removed.

Words are runs of other characters than the six ASCII white-space ones. A window is SPAN consecutive words. A window is
removed if its words also stand, one after another, in a document with a smaller doc_id.

1. Of every window one phrase of PHRASE words is picked, the one with the least hash, so equal windows pick the same
   phrase. Phrases that two documents pick are confirmed as recurring and read from the first of them. Exact copies of a
   document are known by a digest and stand back behind its smallest doc_id.
2. Phrases are dealt into shards by their first document, and each shard's phrases are compiled into one Aho-Corasick
   automaton, in which a word is three signs: nodes then have few children, which pyahocorasick searches one by one. Every document that picked a phrase of the shard streams through it, which locates all their
   occurrences. A document visits the shards it shares phrases with, so work grows with the text and not with the number
   of shards times the text.
3. Windows around located phrases are compared by their whole words (128 bits of hash): the smallest doc_id keeps its own.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import fresh, slices
from tidemark.session import freeze

SPAN = 50
PHRASE = 16
#: Phrases of an automaton, on average at most; and words of documents that one task streams through it, about.
PHRASES = 20_000
WORDS = 4 << 20
MEMORY = 200_000
LAST = np.uint64(2**64 - 1)


def hashes(words: list[bytes], known: dict[bytes, int]) -> np.ndarray:
    """64-bit hashes of words; known remembers them."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    if len(known) > MEMORY:
        known.clear()
    for w in set(words):
        if w not in known:
            known[w] = digest(w, 1)
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def phrase_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of the phrase that starts at each word."""
    n = len(words) - size + 1
    out = np.zeros(max(0, n), np.uint64)
    if n > 0:
        for i in range(size):
            out = out * np.uint64(0x100000001B3) + words[i:i + n]
        out ^= out >> np.uint64(33)
        out *= np.uint64(0xFF51AFD7ED558CCD)
        out ^= out >> np.uint64(33)
    return out


def least(values: np.ndarray, size: int) -> np.ndarray:
    """The least of each run of size values."""
    if len(values) < size:
        return values[:0]
    done = 1
    while 2 * done <= size:
        values = np.minimum(values[:len(values) - done], values[done:])
        done *= 2
    rest = size - done
    return np.minimum(values[:len(values) - rest], values[rest:]) if rest else values


def digest_of(words: list[bytes]) -> bytes:
    import xxhash

    return xxhash.xxh3_128_digest(b" ".join(words))


def key_of(digest: bytes) -> int:
    """The half of a digest that, beside a doc_id, tells texts apart."""
    return int.from_bytes(digest[:8], "little", signed=True)


#: Words that signs() can spell: its third alphabet ends before the code points that are no characters.
SPELLED = (0xD800 - 0x300) << 14


def signs(place: int) -> str:
    """A word's number as three signs of three alphabets, so that no phrase is found between two words.

    No two numbers are spelled alike; those past SPELLED, more words than an automaton could hold, are an error.
    """
    if place >= SPELLED:
        raise ValueError(f"an automaton of more than {SPELLED} different words")
    return chr(0x100 | place & 127) + chr(0x200 | place >> 7 & 127) + chr(0x300 + (place >> 14))


def _marked(docs: DataFrame, span: int, phrase: int) -> DataFrame:
    """doc_id, digest of the words and the picked phrases' hashes of documents with a window."""

    def run(batches):
        import pyarrow as pa

        known: dict[bytes, int] = {}
        for batch in batches:
            for part in slices(batch, "text"):
                rows = []
                for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                    words = text.encode().split()
                    if len(words) >= span:
                        picked = least(phrase_hashes(hashes(words, known), phrase), span - phrase + 1)
                        rows.append((doc_id, digest_of(words), np.unique(picked).view(np.int64)))
                if rows:
                    ids, digests, picks = zip(*rows)
                    ends = np.cumsum([0, *map(len, picks)]).astype(np.int32)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(ids, pa.int64()), pa.array(digests, pa.binary()), pa.array(map(key_of, digests), pa.int64()),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(picks))),
                    ], names=["doc_id", "digest", "key", "picks"])

    return docs.mapInArrow(run, "doc_id long, digest binary, key long, picks array<long>")


def _phrases(rows: DataFrame, phrase: int) -> DataFrame:
    """The words of the phrases whose hashes (picks) stand in the text, one row each, with the text's shard and doc_id."""

    def run(batches):
        import pyarrow as pa

        known: dict[bytes, int] = {}
        for batch in batches:
            for part in slices(batch, "text"):
                found, shards, firsts = [], [], []
                for text, picks, shard, first in zip(*(part.column(c).to_pylist() for c in ("text", "picks", "shard", "doc_id"))):
                    words = text.encode().split()
                    at = phrase_hashes(hashes(words, known), phrase)
                    _, where = np.unique(at, return_index=True)
                    for i in where[np.isin(at[where].view(np.int64), picks)].tolist():
                        found.append(b" ".join(words[i:i + phrase]).decode())
                        shards.append(shard)
                        firsts.append(first)
                yield pa.RecordBatch.from_pydict({
                    "shard": pa.array(shards, pa.int32()), "first_doc": pa.array(firsts, pa.int64()), "text": pa.array(found, pa.string())
                })

    return rows.select("text", "picks", "shard", "doc_id").mapInArrow(run, "shard int, first_doc long, text string")


def _located(dealt: DataFrame, span: int, phrase: int) -> DataFrame:
    """The windows around located phrases: two halves of a hash of their words, where they are, and in what document.

    again tells that a smaller doc_id has the window's phrase, without which none has the window. Rows come sorted by
    shard and part, in each the phrases (doc_id null, key their first document) before the documents.
    """
    size = span - phrase + 1

    def run(batches):
        import ahocorasick
        import pyarrow as pa
        import xxhash

        digest = xxhash.xxh3_128_digest
        known: dict[bytes, int] = {}
        now, automaton, code, compiled = None, None, {}, False
        for batch in batches:
            for part in slices(batch, "text"):
                for shard, share, doc_id, key, text in zip(*(part.column(c).to_pylist() for c in ("shard", "part", "doc_id", "key", "text"))):
                    words = text.encode().split()
                    if (shard, share) != now:
                        now, code, compiled = (shard, share), {}, False
                        automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
                    if doc_id is None:
                        for w in words:
                            if w not in code:
                                code[w] = signs(len(code))
                        automaton.add_word("".join(map(code.__getitem__, words)), key)
                        continue
                    if not len(automaton):
                        continue
                    if not compiled:
                        automaton.make_automaton()
                        compiled = True
                    line = "".join([code.get(w, "\x01\x01\x01") for w in words])
                    hits = [((end + 1) // 3 - phrase, first) for end, first in automaton.iter(line)]
                    if not hits:
                        continue
                    at = phrase_hashes(hashes(words, known), phrase)
                    seen = np.zeros(len(at), bool)
                    places, firsts = (np.array(x, np.int64) for x in zip(*hits))
                    seen[places] = True
                    low = least(at, size)
                    starts = np.flatnonzero((least(np.where(seen, at, LAST), size) == low) & _near(seen, size))
                    if not len(starts):
                        continue
                    values, one = np.unique(at[places], return_index=True)
                    again = firsts[one][np.searchsorted(values, low[starts])] < doc_id
                    joined = b" ".join(words)
                    stop = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
                    begin = np.concatenate(([0], stop[:-1] + 1))
                    raw = b"".join([digest(joined[a:b]) for a, b in zip(begin[starts].tolist(), stop[starts + span - 1].tolist())])
                    halves = np.frombuffer(raw, "<i8").reshape(-1, 2)
                    n = len(starts)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(halves[:, 0]), pa.array(halves[:, 1]), pa.array(np.full(n, doc_id, np.int64)),
                        pa.array(np.full(n, key, np.int64)), pa.array(starts.astype(np.int32)), pa.array(again),
                    ], names=["a", "b", "doc_id", "key", "start", "again"])

    return dealt.mapInArrow(run, "a long, b long, doc_id long, key long, start int, again boolean")


def _near(seen: np.ndarray, size: int) -> np.ndarray:
    """Whether each run of size places holds one that is set."""
    total = np.concatenate(([0], np.cumsum(seen)))
    return total[size:] > total[:-size]


def removals(docs: DataFrame, span: int = SPAN, phrase: int = PHRASE, per_shard: int = PHRASES, per_task: int = WORDS) -> DataFrame:
    """doc_id and cuts (key, whole, starts): what to remove from the text with that key, all of it or windows."""
    docs = docs.where("doc_id IS NOT NULL AND text IS NOT NULL")
    marked = freeze(_marked(docs, span, phrase))
    reps = freeze(marked.groupBy("digest").agg(F.min(F.struct("doc_id", "key", "picks")).alias("r")).select("digest", "r.*"))
    picks = reps.select("doc_id", "key", F.explode("picks").alias("pick"))
    # stored: a join straight on an aggregate shares its shuffle, and Spark could not split a phrase that very many have
    recurring = freeze(
        picks.groupBy("pick").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last")
    )
    hits = freeze(picks.join(recurring.select("pick", "first"), "pick"))
    shards = max(1, -(-hits.where("doc_id = first").count() // per_shard))
    hits = hits.withColumn("shard", F.pmod(F.xxhash64("first"), F.lit(shards)).cast("int"))

    def same(batches):
        import pyarrow as pa

        for batch in batches:
            keep, sizes = [], []
            for text, key in zip(batch.column("text").to_pylist(), batch.column("key").to_pylist()):
                words = text.encode().split()
                keep.append(key_of(digest_of(words)) == key)
                sizes.append(len(words))
            batch = pa.RecordBatch.from_arrays([*batch.columns, pa.array(sizes, pa.int64())], names=[*batch.schema.names, "n_words"])
            yield batch.filter(pa.array(keep, pa.bool_()))

    texts = docs.join(hits.select("doc_id", "key").distinct(), "doc_id").select("doc_id", "text", "key")
    texts = freeze(texts.mapInArrow(same, "doc_id long, text string, key long, n_words long"))
    texts = texts.dropDuplicates(["doc_id", "key"])

    own = hits.where("doc_id = first").groupBy("doc_id", "key", "shard").agg(F.collect_set("pick").alias("picks"))
    phrases = _phrases(texts.join(own, ["doc_id", "key"]), phrase).distinct()
    routed = texts.join(hits.select("doc_id", "key", "shard").distinct(), ["doc_id", "key"])
    # one row per shard, which is one for about per_shard phrases
    parts = routed.groupBy("shard").agg(F.ceil(F.sum("n_words") / per_task).cast("int").alias("parts"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    parts = freeze(parts.withColumn("first", F.coalesce(F.sum("parts").over(before), F.lit(0)).cast("int")))
    each = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    phrases = phrases.join(parts, "shard").select(
        "shard", "first", each, F.lit(None).cast("long").alias("doc_id"), F.col("first_doc").alias("key"), "text"
    )
    streamed = routed.join(parts, "shard").select(
        "shard", "first", F.pmod(F.xxhash64("key"), F.col("parts")).cast("int").alias("part"), "doc_id", "key", "text"
    )
    # a task for each cell of a shard and a part
    cells = max(1, parts.agg(F.sum("parts")).first()[0] or 0)
    dealt = phrases.unionByName(streamed).repartitionById(cells, F.col("first") + F.col("part")).drop("first")
    dealt = dealt.sortWithinPartitions("shard", "part", "doc_id")
    windows = freeze(_located(dealt, span, phrase))

    firsts = freeze(
        windows.groupBy("a", "b").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last")
    )
    later = windows.where("again").join(firsts.select("a", "b", "first"), ["a", "b"]).where("first < doc_id")
    starts = later.groupBy("doc_id", "key").agg(F.collect_list("start").alias("starts"))
    copies = marked.join(reps.select("digest", F.col("doc_id").alias("first")), "digest").where("first < doc_id")
    cuts = starts.select("doc_id", F.struct("key", F.lit(False).alias("whole"), "starts").alias("cut")).unionByName(
        copies.select("doc_id", F.struct("key", F.lit(True).alias("whole"), F.array().cast("array<int>").alias("starts")).alias("cut"))
    )
    return freeze(cuts.groupBy("doc_id").agg(F.collect_set("cut").alias("cuts")))


def drop_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", span: int = SPAN, phrase: int = PHRASE,
                 per_shard: int = PHRASES, per_task: int = WORDS) -> DataFrame:
    """All rows of docs with their text's kept words joined by one blank, and n_words and n_removed.

    A null text has no words and gives an empty one. Rows without doc_id keep all words and make no others go; so do
    texts shorter than a window. Rows that repeat a doc_id are not earlier than each other. Input columns named n_words
    or n_removed are replaced.
    """
    cuts = removals(
        docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")), span, phrase, per_shard, per_task
    )
    docs = docs.drop("n_words", "n_removed")
    key, cut = fresh(docs, "_doc_id"), fresh(docs, "_cuts")
    rows = docs.join(cuts.select(F.col("doc_id").alias(key), F.col("cuts").alias(cut)), docs[doc_id] == F.col(key), "left").drop(key)
    columns = docs.columns

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for part in slices(batch, text):
                kept, sizes, gone = [], [], []
                for t, found in zip(part.column(text).to_pylist(), part.column(cut).to_pylist()):
                    words = (t or "").encode().split()
                    n = len(words)
                    if found:
                        key = key_of(digest_of(words))
                        for x in found:
                            if x["key"] != key:
                                continue
                            edge = np.zeros(n + 1, np.int64)
                            starts = np.array(x["starts"], np.int64)
                            np.add.at(edge, starts, 1)
                            np.add.at(edge, starts + span, -1)
                            keep = (np.cumsum(edge[:n]) == 0) & (not x["whole"])
                            words = [words[i] for i in np.flatnonzero(keep).tolist()]
                            break
                    kept.append(b" ".join(words).decode())
                    sizes.append(n)
                    gone.append(n - len(words))
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(kept, pa.string()) if c == text else part.column(c) for c in columns),
                     pa.array(sizes, pa.int64()), pa.array(gone, pa.int64())], names=[*columns, "n_words", "n_removed"],
                )

    schema = T.StructType([*docs.schema.fields, T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())])
    return rows.mapInArrow(run, schema)
