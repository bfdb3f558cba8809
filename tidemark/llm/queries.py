"""One query per operator over its whole table, beside the SQL that must give the same rows where there is any."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    bpe, decontaminate, hilbert, langmix, license_scan, manifest, ordinal, passages, reputation, simhash, site_lines, spelling, warc
)
from tidemark.llm.common import table
from tidemark.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def vocabulary() -> bpe.Vocabulary:
    import public_tokenizers

    return bpe.Vocabulary.load(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


@query("op2_byte_bpe")
def op2(spark, sf_dir):
    words = vocabulary()
    encoded = bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), words).drop("text")
    return bpe.decode(encoded, words).select("doc_id", *bpe.digests(encoded))


@query("op7_host_reputation", """
WITH p AS (
    SELECT page_id, url,
        coalesce(translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                           'abcdefghijklmnopqrstuvwxyz'), '') AS host,
        coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
    FROM pages),
o AS (
    SELECT doc_id, coalesce(min(quality), 1) = 1 AND coalesce(max(toxic), 0) = 0 AS good FROM labels
    WHERE doc_id IS NOT NULL AND (quality IS NOT NULL OR toxic IS NOT NULL) GROUP BY doc_id),
h AS (
    SELECT host, count(good) AS n, coalesce(sum(good::INT), 0) AS good FROM p LEFT JOIN o ON doc_id = page_id
    GROUP BY host),
h2 AS (
    SELECT *, CASE WHEN d = '' THEN host ELSE d END AS domain
    FROM (SELECT *, regexp_extract(host, '([^.]+\\.(?:(?:ac|co|com|edu|gov|net|org)\\.[a-z]{2}|[^.]+))$', 1) AS d FROM h)),
h3 AS (SELECT host, n, good, domain, regexp_replace(domain, '^[^.]*\\.', '') AS suffix FROM h2),
s AS (SELECT suffix, sum(n) AS n, sum(good) AS good FROM h3 GROUP BY suffix),
d AS (SELECT domain, suffix, sum(n) AS n, sum(good) AS good FROM h3 GROUP BY ALL),
m AS (SELECT (coalesce(sum(good), 0) + 0.5::DOUBLE) / (coalesce(sum(n), 0) + 1) AS mu FROM h),
sw AS (
    SELECT least(greatest(coalesce(CASE WHEN r > 0 THEN 1 / r - 1 ELSE 10000 END, 10000), 1), 10000) AS w
    FROM (SELECT (sum((good - n * mu) ** 2 / (n * mu * (1 - mu))) - count(*)) / nullif(sum(n) - count(*), 0) AS r
          FROM s, m WHERE n > 0)),
s2 AS (SELECT suffix, (good + w * mu) / (n + w) AS mu FROM s, m, sw),
d1 AS (SELECT d.*, mu FROM d JOIN s2 USING (suffix)),
dw AS (
    SELECT least(greatest(coalesce(CASE WHEN r > 0 THEN 1 / r - 1 ELSE 10000 END, 10000), 1), 10000) AS w
    FROM (SELECT (sum((good - n * mu) ** 2 / (n * mu * (1 - mu))) - count(*)) / nullif(sum(n) - count(*), 0) AS r
          FROM d1 WHERE n > 0)),
d2 AS (SELECT domain, (good + w * mu) / (n + w) AS mu FROM d1, dw),
h4 AS (SELECT h3.*, mu FROM h3 JOIN d2 USING (domain)),
hw AS (
    SELECT least(greatest(coalesce(CASE WHEN r > 0 THEN 1 / r - 1 ELSE 10000 END, 10000), 1), 10000) AS w
    FROM (SELECT (sum((good - n * mu) ** 2 / (n * mu * (1 - mu))) - count(*)) / nullif(sum(n) - count(*), 0) AS r
          FROM h4 WHERE n > 0)),
h5 AS (
    SELECT host, n, good, mean - 1.645::DOUBLE * sqrt(mean * (1 - mean) / (n + w + 1)) AS bound
    FROM (SELECT h4.host, n, good, w, (good + w * mu) / (n + w) AS mean FROM h4, hw)),
rules(verdict, rhost, rpath) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'),
    ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
best AS (
    SELECT page_id, url, arg_max(rhost || rpath, length(rhost || rpath)) AS rule,
        arg_max(verdict, length(rhost || rpath)) AS verdict
    FROM p JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY ALL)
SELECT p.page_id, p.host, p.path, best.rule,
    coalesce(best.verdict, CASE WHEN bound >= 0.5 THEN 'allow' ELSE 'block' END) AS verdict,
    h5.n AS n_labelled, h5.good::BIGINT AS n_good, round(bound, 4) AS bound
FROM p JOIN h5 ON h5.host = p.host LEFT JOIN best ON best.page_id = p.page_id AND best.url IS NOT DISTINCT FROM p.url
""")
def op7(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    found = reputation.judge(pages, table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic"))
    return found.select(
        "page_id", "host", "path", "rule", "verdict", "n_labelled", "n_good", F.round("bound", 4).alias("bound")
    )


@query("op8_warc_revisits", """
WITH d AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
g AS (SELECT html, min(page_id) AS first FROM d WHERE octet_length(encode(html)) >= 100 GROUP BY html)
SELECT page_id, octet_length(encode(d.html)) AS payload_bytes, sha256(d.html) AS payload_digest,
    CASE WHEN page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN page_id <> first THEN first END AS refers_to
FROM d LEFT JOIN g ON d.html = g.html
""")
def op8(spark, sf_dir):
    path = scratch_path(spark, "warc")
    warc.write_archives(warc.resolve(table(spark, sf_dir, "pages").select("page_id", "url", "html")), path)
    return warc.read_archives(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op9_simhash_bktree")
def op9(spark, sf_dir):
    found = simhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


@query("op10_site_lines", """
WITH t AS (SELECT row_number() OVER () AS r, doc_id, source, text FROM documents),
n AS (SELECT source, count(*) AS total FROM t GROUP BY source),
l AS (SELECT r, source, unnest(string_split(text, chr(10))) AS line,
             generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM t),
f AS (SELECT source, line, count(*) AS pages FROM (SELECT DISTINCT r, source, line FROM l) GROUP BY ALL),
b AS (SELECT f.source, line FROM f JOIN n ON f.source IS NOT DISTINCT FROM n.source
      WHERE trim(line) <> '' AND pages >= 3 AND pages / total > 0.05::DOUBLE),
k AS (SELECT r, count(*) AS n_lines, count(b.line) AS n_dropped,
             string_agg(CASE WHEN b.line IS NULL THEN l.line END, chr(10) ORDER BY pos) AS kept
      FROM l LEFT JOIN b ON l.source IS NOT DISTINCT FROM b.source AND l.line = b.line GROUP BY r)
SELECT doc_id, CASE WHEN text IS NOT NULL THEN coalesce(kept, '') END AS text, coalesce(n_lines, 0) AS n_lines,
    coalesce(n_dropped, 0) AS n_dropped
FROM t LEFT JOIN k ON t.r = k.r
""")
def op10(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return site_lines.drop_boilerplate(docs).drop("source")


@query("op1_ordinal_quality")
def op1(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = ordinal.fit(docs, ordinal.grades_of(table(spark, sf_dir, "labels")))
    return ordinal.score(docs, model).drop("text")


@query("op5_language_mixture")
def op5(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    docs = docs.withColumn("held_out", held)
    model = langmix.learn(docs.where("NOT held_out AND lang IS NOT NULL"))
    found = langmix.predict(docs.select("doc_id", "held_out", "text"), model)
    return found.select("doc_id", "held_out", "lang_pred", "score", "languages")


@query("op3_benchmark_leaks")
def op3(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.leaks(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))


@query("op4_hilbert_neighbours")
def op4(spark, sf_dir):
    return hilbert.search(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


@query("op6_repeated_passages")
def op6(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return passages.drop_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@query("op11_license_signatures")
def op11(spark, sf_dir):
    found = license_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    places = F.transform(F.filter("detections", lambda d: d["pinned"]), lambda d: d["first"])
    names = lambda kept: F.array_join(F.array_sort(F.array_distinct(F.transform(kept, lambda d: d["label"]))), ",")
    return found.select(
        "doc_id", "n_words", F.size(places).cast("long").alias("n_base"), F.array_min(places).alias("first_word"),
        F.array_max(places).alias("last_word"), names(F.filter("detections", lambda d: d["pinned"])).alias("base_labels"),
        names(F.col("detections")).alias("labels"),
        F.coalesce(F.array_max(F.transform("detections", lambda d: d["weight"])), F.lit(0.0)).alias("score"),
    )


@query("op12_merkle_manifest", r"""WITH RECURSIVE d AS (
    SELECT row_number() OVER () AS r, *, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lowered,
        -- CRC-32 bit by bit
        xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(doc_id::VARCHAR, ''),
            lambda c: [ord(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
            lambda c, x: xor(xor(c, x) >> 1, 3988292384 * (xor(c, x) & 1))), 4294967295) % 3 = 0 AS tampered
    FROM documents),
f AS (
    SELECT r, doc_id, lang, tampered, coalesce(octet_length(encode(text)) || ':' || text, '-') AS t,
        coalesce(octet_length(encode(lowered)) || ':' || lowered, '-') AS l,
        coalesce(length(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(octet_length(encode(source)) || ':' || source, '-')
            || coalesce(octet_length(encode(lang)) || ':' || lang, '-') || coalesce(length(n_chars::VARCHAR) || ':' || n_chars, '-') AS head
    FROM d),
leaves AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS pos,
        count(*) OVER (PARTITION BY lang) AS size
    FROM (SELECT r, doc_id, lang, sha256(head || t) AS leaf, sha256(head || CASE WHEN tampered THEN l ELSE t END) AS shown FROM f)),
tree AS (
    SELECT lang, 0 AS lvl, pos, size, leaf AS node FROM leaves
    UNION ALL
    SELECT lang, lvl + 1, pos // 8, (size + 7) // 8, sha256(string_agg(node, '' ORDER BY pos)) FROM tree WHERE size > 1
    GROUP BY lang, lvl, size, pos // 8),
subroots AS (
    SELECT lang, node, lvl, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS pos, count(*) OVER () AS size
    FROM tree WHERE size = 1),
top AS (
    SELECT 0 AS lvl, pos, size, node FROM subroots
    UNION ALL
    SELECT lvl + 1, pos // 8, (size + 7) // 8, sha256(string_agg(node, '' ORDER BY pos)) FROM top WHERE size > 1
    GROUP BY lvl, size, pos // 8),
runs AS (SELECT lang, lvl, pos // 8 AS run, list(node ORDER BY pos) AS nodes FROM tree WHERE size > 1 GROUP BY ALL),
top_runs AS (SELECT lvl, pos // 8 AS run, list(node ORDER BY pos) AS nodes FROM top WHERE size > 1 GROUP BY ALL),
steps AS (
    SELECT r, lvl + 1 AS step, nodes, (pos // (8 ** lvl)::BIGINT) % 8 AS slot
    FROM leaves JOIN runs ON runs.lang IS NOT DISTINCT FROM leaves.lang AND run = pos // (8 ** (lvl + 1))::BIGINT
    UNION ALL
    SELECT r, s.lvl + t.lvl + 1, nodes, (s.pos // (8 ** t.lvl)::BIGINT) % 8
    FROM leaves JOIN subroots s ON s.lang IS NOT DISTINCT FROM leaves.lang
    JOIN top_runs t ON run = s.pos // (8 ** (t.lvl + 1))::BIGINT),
sides AS (
    SELECT r, step, array_to_string(nodes[:slot], '') AS before, array_to_string(nodes[slot + 2:], '') AS behind FROM steps),
folds AS (
    SELECT r, 0 AS step, shown AS h FROM leaves
    UNION ALL
    SELECT r, s.step, sha256(before || h || behind) FROM folds f JOIN sides s USING (r) WHERE s.step = f.step + 1)
SELECT doc_id, leaf, s.node AS subroot, (SELECT node FROM top WHERE size = 1) AS root, sha256(coalesce(siblings, '')) AS proof_sha256,
    h AS folded_root, h = (SELECT node FROM top WHERE size = 1) AS verified
FROM leaves JOIN subroots s ON s.lang IS NOT DISTINCT FROM leaves.lang
    LEFT JOIN (SELECT r, string_agg(before || behind, '' ORDER BY step) AS siblings FROM sides GROUP BY r) USING (r)
    JOIN (SELECT r, arg_max(h, step) AS h FROM folds GROUP BY r) USING (r)
""")
def op12(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(*manifest.FIELDS)
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.lit(False))
    shown = F.when(held, F.col("tampered_leaf")).otherwise(F.col("leaf"))
    rows = manifest.manifest(docs).withColumn("folded_root", manifest.fold(shown, F.col("path")))
    return rows.select(
        "doc_id", *(manifest.hex_of(F.col(c)).alias(c) for c in ("leaf", "subroot", "root")),
        manifest.proof(F.col("path")).alias("proof_sha256"), manifest.hex_of(F.col("folded_root")).alias("folded_root"),
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


@query("op13_spelling_variants", r"""WITH RECURSIVE runs AS (
    SELECT doc_id, run, count(*) AS k FROM (
        SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents) GROUP BY ALL),
-- CRC-32 bit by bit: a step for each bit of the UTF-8 bytes, the first of a byte's eight steps takes the byte in
hashed AS (
    SELECT run, k, CASE WHEN doc_id IS NOT NULL THEN xor(list_reduce(
        list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(doc_id || ':' || run, ''), lambda c:
            CASE WHEN ord(c) < 128 THEN [ord(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]
                 ELSE [195::BIGINT, 0, 0, 0, 0, 0, 0, 0, ord(c) - 64, 0, 0, 0, 0, 0, 0, 0] END))),
        lambda c, x: xor(xor(c, x) >> 1, 3988292384 * (xor(c, x) & 1))), 4294967295) END AS h
    FROM runs),
words AS (
    SELECT word, sum(k)::BIGINT AS n FROM (
        SELECT k, CASE WHEN h % 97 = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word FROM hashed)
    WHERE length(word) >= 5 GROUP BY word HAVING sum(k) >= 3),
gaps AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words),
pairs AS (
    SELECT a.word, b.word AS near, b.n AS near_n FROM gaps a JOIN gaps b
        ON a.i = b.i AND a.word[:a.i - 1] || ' ' || a.word[a.i + 1:] = b.word[:b.i - 1] || ' ' || b.word[b.i + 1:] AND a.word <> b.word
    UNION SELECT g.word, w.word, w.n FROM gaps g JOIN words w ON w.word = g.word[:g.i - 1] || g.word[g.i + 1:]
    UNION SELECT w.word, g.word, g.n FROM gaps g JOIN words w ON w.word = g.word[:g.i - 1] || g.word[g.i + 1:]),
best AS (SELECT word, count(*) AS n_near, max(near_n) AS near_n FROM pairs GROUP BY word),
forms AS (
    SELECT w.word, w.n, any_value(b.near_n) AS form_n, min(p.near) AS form
    FROM words w LEFT JOIN best b ON b.word = w.word AND b.near_n >= 2 * w.n
        LEFT JOIN pairs p ON p.word = w.word AND p.near_n = b.near_n GROUP BY w.word, w.n),
way AS (
    SELECT word, word AS node FROM words
    UNION ALL SELECT way.word, form FROM way JOIN forms ON forms.word = way.node WHERE form IS NOT NULL),
ends AS (SELECT way.word, node AS root FROM way JOIN forms ON forms.word = way.node WHERE form IS NULL)
SELECT word, form, root, n, coalesce(best.n_near, 0) AS n_near, form_n
FROM forms JOIN ends USING (word) LEFT JOIN best USING (word)
""")
def op13(spark, sf_dir):
    return spelling.group(table(spark, sf_dir, "documents").select("doc_id", "text"))
