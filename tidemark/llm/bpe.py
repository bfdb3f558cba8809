"""Byte-level BPE with the ranks of a public vocabulary, merged in numpy matrices."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import share, slices, tidied

NONE = np.int32(2**31 - 1)
#: Entries of a worker's memory of pieces; it starts anew when full.
MEMORY = 200_000
CELLS = 1 << 22
LONG = 128
#: Between a word and the next one a single blank always starts a match, whatever stands before it.
CUT = r"(?<=\S) (?=\S)"


@dataclass
class Vocabulary:
    """ranks, and the pairs of tokens whose bytes together are a token, in a table with open addressing."""

    pattern: str
    ranks: dict[bytes, int]
    byte_ids: np.ndarray
    keys: np.ndarray
    values: np.ndarray
    shift: int
    bytes: np.ndarray
    starts: np.ndarray

    @classmethod
    def load(cls, path: str, pattern: str) -> Vocabulary:
        import base64

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(bytes.strip, f))}
        return cls.of(ranks, pattern)

    @classmethod
    def of(cls, ranks: dict[bytes, int], pattern: str) -> Vocabulary:
        byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = {
            ranks[t[:k]] << 32 | ranks[t[k:]]: r
            for t, r in ranks.items() for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks
        }
        bits = max(4, (4 * len(pairs)).bit_length())
        keys, values = np.full(1 << bits, -1, np.int64), np.full(1 << bits, NONE, np.int32)
        todo_k, todo_v = np.fromiter(pairs, np.int64, len(pairs)), np.fromiter(pairs.values(), np.int32, len(pairs))
        slot = cls.slot(todo_k, 64 - bits)
        while len(todo_k):
            free = keys[slot] == -1
            keys[slot[free]], values[slot[free]] = todo_k[free], todo_v[free]  # of several for one slot the last stays
            lost = keys[slot] != todo_k
            todo_k, todo_v, slot = todo_k[lost], todo_v[lost], (slot[lost] + 1) & ((1 << bits) - 1)
        tokens = [b""] * (max(ranks.values()) + 1)
        for t, r in ranks.items():
            tokens[r] = t
        starts = np.cumsum([0, *map(len, tokens)])
        return cls(pattern, ranks, byte_ids, keys, values, 64 - bits, np.frombuffer(b"".join(tokens), np.uint8), starts)

    @staticmethod
    def slot(keys: np.ndarray, shift: int) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(shift)).astype(np.int64)

    def pair(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of each pair's merged token, which is also its id, or NONE. Negative ids are padding."""
        key = a.astype(np.int64) << 32 | b
        key[(a < 0) | (b < 0)] = -2
        slot = self.slot(key, self.shift)
        seen = self.keys[slot]
        out = np.where(seen == key, self.values[slot], NONE)
        again = np.flatnonzero((seen != key) & (seen != -1) & (key >= 0))
        while len(again):
            slot[again] = (slot[again] + 1) & (len(self.keys) - 1)
            seen = self.keys[slot[again]]
            hit = seen == key[again]
            out[again[hit]] = self.values[slot[again[hit]]]
            again = again[~hit & (seen != -1)]
        return out

    def merge(self, pieces: list[bytes]) -> list[np.ndarray]:
        """The ids of each piece. A piece that is a token is that token."""
        out: list = [None] * len(pieces)
        buckets: dict[int, list[int]] = {}
        for i, p in enumerate(pieces):
            if (r := self.ranks.get(p)) is not None:
                out[i] = np.array([r], np.int32)
            elif len(p) > LONG:
                out[i] = self._long(self.byte_ids[np.frombuffer(p, np.uint8)])
            else:
                buckets.setdefault(max(2, 1 << (len(p) - 1).bit_length()), []).append(i)
        for width, rows in buckets.items():
            for at in range(0, len(rows), max(1, CELLS // width)):
                self._matrix(pieces, rows[at:at + max(1, CELLS // width)], width, out)
        return out

    def _matrix(self, pieces: list[bytes], rows: list[int], width: int, out: list) -> None:
        """Each round merges the leftmost least pair of every row and closes the gap; rows without a pair leave."""
        raw = np.frombuffer(b"".join(pieces[i].ljust(width, b"\0") for i in rows), np.uint8).reshape(-1, width)
        left = np.array([len(pieces[i]) for i in rows])
        ids = np.where(np.arange(width) < left[:, None], self.byte_ids[raw], np.int32(-1))
        row = np.array(rows)
        ranks = self.pair(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(rows), width - 1)
        while True:
            at = ranks.argmin(axis=1)
            n = np.arange(len(at))
            best = ranks[n, at]
            done = best == NONE
            if done.any():
                for i, line, k in zip(row[done].tolist(), ids[done], left[done].tolist()):
                    out[i] = line[:k].copy()
                go = ~done
                ids, ranks, row, left, at, best = ids[go], ranks[go], row[go], left[go], at[go], best[go]
                n = np.arange(len(at))
            if not len(row):
                return
            if ids.shape[1] == 2:
                for i, r in zip(row.tolist(), best):
                    out[i] = np.array([r], np.int32)
                return
            ids[n, at] = best
            cut = np.arange(ids.shape[1] - 1) > at[:, None]
            ids = np.where(cut, ids[:, 1:], ids[:, :-1])
            left -= 1
            ranks = np.where(cut[:, :-1], ranks[:, 1:], ranks[:, :-1])
            width = ids.shape[1]
            # only the pairs on both sides of the merged token are new
            has = at < width - 1
            ranks[n[has], at[has]] = self.pair(ids[n[has], at[has]], ids[n[has], at[has] + 1])
            has = at > 0
            ranks[n[has], at[has] - 1] = self.pair(ids[n[has], at[has] - 1], ids[n[has], at[has]])

    def _long(self, ids: np.ndarray) -> np.ndarray:
        """One row of a long piece. All places of the least pair merge at once, as they would one after another.

        They wouldn't if a merge made a pair of a still lower rank; then only the leftmost place merges in the round.
        """
        while len(ids) > 1:
            ranks = self.pair(ids[:-1], ids[1:])
            best = ranks.min()
            if best == NONE:
                break
            at = np.flatnonzero(ranks == best)
            if len(at) > 1:
                first = np.diff(at, prepend=at[0] - 2) > 1
                at = at[(at - np.maximum.accumulate(np.where(first, at, -1))) % 2 == 0]
                padded = np.concatenate(([-1, -1], ids, [-1]))
                before = np.where(np.isin(at - 2, at), best, padded[at + 1])
                new = np.full(len(at), best, np.int32)
                if min(self.pair(before, new).min(), self.pair(new, padded[at + 4]).min()) < best:
                    at = at[:1]
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            ids[at] = best
            ids = ids[keep]
        return ids.copy()


def encode(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", out: str = "ids") -> DataFrame:
    """docs with the token ids of each whole text, null as empty, as an array of int in a column that replaces out.

    Texts are cut at blanks between words; each new piece is matched with the pattern and merged once per task as long
    as it is remembered. Special tokens are ordinary text. The work is one pass without a shuffle.
    """
    docs = docs.drop(out)
    shared = share(docs.sparkSession, vocabulary)

    def run(batches):
        import re

        import pyarrow as pa
        import regex

        vocabulary, cut = shared(), re.compile(CUT)
        match = regex.compile(vocabulary.pattern).findall
        places: dict[str, int] = {}
        starts, lengths, flat, used = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64), np.zeros(1 << 18, np.int32), 0

        def grown(a: np.ndarray, n: int) -> np.ndarray:
            return a if n <= len(a) else np.concatenate((a, np.zeros(max(n, 2 * len(a)) - len(a), a.dtype)))

        def learn(new: list[str]) -> None:
            """Remember the ids of new pieces."""
            nonlocal starts, lengths, flat, used
            matches = [match(x) for x in new]
            distinct = list({m for ms in matches for m in ms})
            ids = dict(zip(distinct, vocabulary.merge([m.encode() for m in distinct])))
            rows = [np.concatenate([ids[m] for m in ms]) if len(ms) > 1 else ids[ms[0]] for ms in matches]
            sizes, n = np.fromiter(map(len, rows), np.int64, len(rows)), len(places)
            starts, lengths = grown(starts, n + len(new)), grown(lengths, n + len(new))
            flat = grown(flat, used + int(sizes.sum()))
            starts[n:n + len(new)] = used + np.cumsum(sizes) - sizes
            lengths[n:n + len(new)] = sizes
            flat[used:used + int(sizes.sum())] = np.concatenate(rows)
            used += int(sizes.sum())
            places.update(zip(new, range(n, n + len(new))))

        for batch in batches:
            for part in slices(batch, text):
                rows = []
                for t in part.column(text).to_pylist():
                    pieces = cut.split(t) if t else []
                    rows.append([pieces[0], *[" " + p for p in pieces[1:]]] if pieces else [])
                if len(places) > MEMORY:
                    places.clear()
                    used = 0
                new = list({p for r in rows for p in r if p not in places})
                if new:
                    learn(new)
                at = np.fromiter((places[p] for r in rows for p in r), np.int64)
                size = lengths[at]
                ends = np.cumsum(size)
                ids = flat[np.repeat(starts[at] - (ends - size), size) + np.arange(int(size.sum()))]
                bounds = np.concatenate(([0], ends))[np.cumsum([0, *map(len, rows)])]
                ids = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([*part.columns, ids], names=[*part.schema.names, out])

    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.ArrayType(T.IntegerType()))])
    return docs.mapInArrow(tidied(run), schema)


def decode(docs: DataFrame, vocabulary: Vocabulary, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """docs with the bytes of the tokens in ids, in a column that replaces out; null ids have none. Unknown ids are an error."""
    docs = docs.drop(out)
    shared = share(docs.sparkSession, vocabulary)

    def run(batches):
        import pyarrow as pa

        v = shared()
        sizes = np.diff(v.starts)
        for batch in batches:
            for part in slices(batch, ids, 1 << 18):
                column = part.column(ids)
                values = column.flatten().to_numpy(zero_copy_only=False)
                counts = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                if len(values) and (values.min() < 0 or values.max() >= len(sizes) or not sizes[values].all()):
                    raise ValueError("an id is not in the vocabulary")
                size = sizes[values]
                ends = np.cumsum(size)
                raw = v.bytes[np.repeat(v.starts[values] - (ends - size), size) + np.arange(int(size.sum()))]
                bounds = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(counts)))]
                data = pa.Array.from_buffers(
                    pa.binary(), len(part), [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(raw)]
                )
                yield pa.RecordBatch.from_arrays([*part.columns, data], names=[*part.schema.names, out])

    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.BinaryType())])
    return docs.mapInArrow(tidied(run), schema)


def digests(docs: DataFrame, ids: str = "ids", decoded: str = "decoded") -> list:
    """n_tokens, ids_sha256 and decoded_sha256 as column expressions."""
    return [
        F.size(ids).cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col(ids).cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col(decoded), 256).alias("decoded_sha256"),
    ]
