import base64
import hashlib

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import bpe
from tidemark.llm.queries import QUERIES, vocabulary


@pytest.fixture(scope="module")
def words():
    return vocabulary()


@pytest.fixture(scope="module")
def public():
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd():
    return [
        None, "", " ", "   ", "a", "it's I'll 'S don't", "Ünïcode ñandú 漢字 \U0001f600", "x\u00a0 y\u2003z\x85w\x1cv", "a  b \n c\t\n\nd  ",
        "<|endoftext|>", "a" * 5000, "ab" * 3000 + "!" * 4000, " " * 3000 + "x", "\u0301\u0301 e\u0301", "".join(map(chr, range(1, 0x2FF))),
        "12345678901234567890 ½ ²", "word " * 40_000, "\x00\ufffe", "\u200d\u200b", "".join(chr(c) for c in range(0x2000, 0x2070)),
    ]


def test_same_ids_as_the_public_library(spark, words, public):
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(odd())], "doc_id long, text string, ids int")
    got = {r.doc_id: r for r in bpe.decode(bpe.encode(docs, words), words).collect()}
    for i, t in enumerate(odd()):
        assert got[i].ids == public.encode_ordinary(t or ""), (i, t and t[:40])
        assert bytes(got[i].decoded) == (t or "").encode()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.binary(min_size=1, max_size=300), min_size=1, max_size=5))
def test_merges(words, public, pieces):
    assert [x.tolist() for x in words.merge(pieces)] == [public._core_bpe.encode_single_piece(p) for p in pieces]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"aa", b"ab", b"e", b"er", b"th", b"the", b"\xc3"]), min_size=60, max_size=400))
def test_long_pieces(words, public, parts):
    piece = b"".join(parts).ljust(bpe.LONG + 1, b"a")
    assert words.merge([piece])[0].tolist() == public._core_bpe.encode_single_piece(piece)


def test_query(spark, sf, public):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = QUERIES["op2_byte_bpe"](spark, sf).collect()
    assert len(got) == len(docs)
    for r in got:
        text = docs[r.doc_id] or ""
        ids = public.encode_ordinary(text)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_empty_table_and_unknown_ids(spark, words):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.decode(bpe.encode(docs, words), words).count() == 0
    null = spark.createDataFrame([(None,), ([],)], "ids array<int>")
    assert [bytes(r.decoded) for r in bpe.decode(null, words).collect()] == [b"", b""]
    with pytest.raises(Exception, match="vocabulary"):
        bpe.decode(spark.createDataFrame([([10**6],)], "ids array<int>"), words).collect()
