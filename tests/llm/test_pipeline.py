import base64
import hashlib

import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import ordinal
from tidemark.llm.decontaminate import words_of

from test_simhash import classes, restated
from test_site_lines import brute as lines


def test_against_a_plain_restatement(spark, sf):
    """Every stage written out over the rows of its predecessor; only the classifier's model is taken over."""
    table = lambda name: spark.read.parquet(f"{sf}/{name}.parquet")
    docs = table("documents")
    model = ordinal.fit(docs, ordinal.grades_of(table("labels")))
    features = ordinal.Features()
    rows = []
    for r in docs.collect():
        ids, values = features.of(r.text)
        if len(ids) and model.tails(float(model.weights[ids] @ values))[-1] >= ordinal.SELECT:
            rows.append((r.doc_id, r.text, r.lang, r.source))
    assert 0 < len(rows) < docs.count()
    kept = lines([(source, text) for _, text, _, source in rows], 0.05, 3)
    rows = [(i, k[0], lang, source) for (i, _, lang, source), k in zip(rows, kept)]
    prints = {}
    for i, text, *_ in rows:
        prints.setdefault(restated(text), []).append(i)
    root = classes([(x, min(ids)) for x, ids in prints.items()], 4)
    rows = [r for r in rows if root.get(r[0]) == r[0]]
    items = [" ".join(words_of(r.text)) for r in table("benchmark").collect()]
    rows = [r for r in rows if not any(f" {x} " in f" {' '.join(words_of(r[1]))} " for x in items)]
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    public = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = sorted((i, lang, source, tuple(public.encode_ordinary(text)), hashlib.sha256(text.encode()).hexdigest()) for i, text, lang, source in rows)
    got = corpus_pipeline.run(spark, sf).collect()
    assert sorted((r.doc_id, r.lang, r.source, tuple(r.ids), r.decoded_sha256) for r in got) == want


def test_stages_return_the_columns_of_documents_and_pass_odd_rows(spark, sf):
    """Null, empty, very long and repeated texts, null keys, an extra column and an empty table go through every stage."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    odd = spark.createDataFrame(
        [(None, None, None, None, None), (-1, "", "en", None, 0), (-2, "word " * 50_000, None, "src1", 1), (None, "Lone text.", "en", "s", 9)]
        + [(-3, "Same words again here.", "en", "src1", 22)] * 3, docs.schema,
    )
    docs = docs.unionByName(odd).withColumn("selected", F.lit(1))
    for table in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, table, sf)
            assert out.columns == docs.columns, name
            assert out.count() <= table.count()
        assert corpus_pipeline.STAGES[-1][1](spark, table, sf).count() == table.count()


def test_names_and_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "line dedup", "SimHash near-dedup", "benchmark decontamination", "byte-level BPE"
    ]
    assert corpus_pipeline.ORACLE_SQL is None
