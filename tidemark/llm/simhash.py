"""SimHash near-duplicates: fingerprints linked within a Hamming radius through BK-trees.

Fingerprints differing in at most r bits agree in one of r + 1 blocks of bits at least. So a shard is the value of a
block, and a query's links lie in the r + 1 shards of its own values: no query visits every tree. A shard's tree and the
queries for it meet through a shuffle; all trees together hold every fingerprint several times, which is no bounded
broadcast. A shard with more than TREE fingerprints is cut into trees of about that size, each queried by the others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import fresh, slices, tidied
from tidemark.llm.components import components
from tidemark.session import freeze

WORDS = 4
RADIUS = 4
SEED = 42
TREE = 2048


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """The 64-bit SimHash of a text, unsigned: a bit is set if it is set in over half the shingles' hashes.

    A-Z are lower-cased; words are split at the six ASCII white-space characters. A text of fewer words than a shingle
    is one shingle; without words, or null, the fingerprint is zero.
    """
    import numpy as np
    import xxhash

    found = (text or "").encode().lower().split()
    if not found:
        return 0
    if len(found) <= words:
        return xxhash.xxh64_intdigest(b" ".join(found), seed=SEED)
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate(([0], ends[:-words] + 1))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends[words - 1:].tolist())), np.uint64, len(starts)
    )
    set_bits = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 15):
        bits = np.unpackbits(hashes[at:at + (1 << 15)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_bits += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(set_bits * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", words: int = WORDS, out: str = "fingerprint") -> DataFrame:
    """docs with the fingerprint of each whole text as a long, in place of its text."""
    docs = docs.drop(out)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for part in slices(batch, text):
                prints = np.array([fingerprint(t, words) for t in part.column(text).to_pylist()], np.uint64).view(np.int64)
                part = part.drop_columns([text])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(prints)], names=[*part.schema.names, out])

    schema = docs.drop(text).select("*", F.lit(0).cast("long").alias(out)).schema
    return docs.mapInArrow(tidied(run), schema)


class Tree:
    """BK-tree: a node's children are keyed by their Hamming distance to it."""

    def __init__(self, prints: list[int]):
        self.prints, self.children = prints, [{} for _ in prints]

    def insert(self, i: int) -> None:
        prints, node, x = self.prints, 0, self.prints[i]
        while i:
            at = self.children[node]
            d = (x ^ prints[node]).bit_count()
            if d not in at:
                at[d] = i
                return
            node = at[d]

    def within(self, x: int, radius: int) -> list[int]:
        """Nodes at most radius from x: by the triangle inequality only edges within radius of x's distance lead there."""
        prints, children, found, todo = self.prints, self.children, [], [0]
        while todo:
            node = todo.pop()
            d = (x ^ prints[node]).bit_count()
            if d <= radius:
                found.append(node)
            edges = children[node]
            if len(edges) > 2 * radius:
                todo += [edges[k] for k in range(d - radius, d + radius + 1) if k in edges]
            else:
                todo += [c for k, c in edges.items() if -radius <= k - d <= radius]
        return found


def shard_links(members: list[tuple[int, int]], queries: list[tuple[int, int]], radius: int) -> list[tuple[int, int]]:
    """Links (id, least id of its group) that join the ids of (fingerprint, id) rows as their links do.

    With queries, links go between them and the members; without, between members.
    """
    rows = members + queries
    parent = list(range(len(rows)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    def join(i: int, found: list[int]) -> None:
        for j in found:
            a, b = root(i), root(j)
            if a != b:
                parent[a] = b

    tree = Tree([x for x, _ in members])
    for i, (x, _) in enumerate(members):
        if i and not queries:
            join(i, tree.within(x, radius))
        tree.insert(i)
    for i, (x, _) in enumerate(queries, len(members)):
        join(i, tree.within(x, radius))
    least: dict[int, int] = {}
    for i, (_, key) in enumerate(rows):
        r = root(i)
        least[r] = min(key, least.get(r, key))
    return [(key, least[root(i)]) for i, (_, key) in enumerate(rows) if key != least[root(i)]]


def links(classes: DataFrame, radius: int = RADIUS, tree: int = TREE) -> DataFrame:
    """Edges (u, v) that connect the ids of classes (fp, id: one row per fingerprint) as links within radius would."""
    n = radius + 1
    edge = [64 * k // n for k in range(n + 1)]
    block = F.array(*(
        F.struct(F.lit(k).alias("block"), F.shiftrightunsigned("fp", edge[k]).bitwiseAND(
            F.lit((1 << (edge[k + 1] - edge[k])) - 1).cast("long")).alias("value"))
        for k in range(n)
    ))
    rows = classes.select("fp", "id", F.explode(block).alias("b")).select("fp", "id", "b.*")
    large = freeze(
        rows.groupBy("block", "value").count().where(F.col("count") > tree)
        .select("block", "value", F.ceil(F.col("count") / tree).cast("int").alias("trees"))
    )
    rows = rows.join(large, ["block", "value"], "left").withColumn("trees", F.coalesce("trees", F.lit(1)))
    own = F.pmod(F.xxhash64("fp", F.lit("tree")), F.col("trees")).cast("int")
    # a group is a pair of trees (low, high): low's rows are the tree and high's the queries
    rows = rows.withColumn("own", own).select(
        "block", "value", "fp", "id", "own", F.explode(F.sequence(F.lit(0), F.col("trees") - 1)).alias("other")
    ).select("block", "value", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
             (F.col("own") > F.col("other")).cast("int").alias("query"), "fp", "id")
    keys = ["block", "value", "low", "high"]
    dealt = rows.repartition(*keys).sortWithinPartitions(*keys, "query", "fp")

    def run(batches):
        import pyarrow as pa

        def found(group):
            members, queries = group
            if len(members) + len(queries) < 2 or not members or (now[2] != now[3] and not queries):
                return []
            return shard_links(members, queries, radius)

        now, group, out = None, ([], []), []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in (*keys, "query", "fp", "id")]
            for *key, query, fp, i in zip(*columns):
                if key != now:
                    if now:
                        out += found(group)
                    now, group = key, ([], [])
                group[query].append((fp & 0xFFFFFFFFFFFFFFFF, i))
            if len(out) > 10_000:
                yield pa.RecordBatch.from_pydict({"u": [a for a, _ in out], "v": [b for _, b in out]})
                out = []
        if now:
            out += found(group)
        yield pa.RecordBatch.from_pydict({
            "u": pa.array([a for a, _ in out], pa.int64()), "v": pa.array([b for _, b in out], pa.int64())
        })

    return dealt.mapInArrow(tidied(run), "u long, v long").distinct()


def _components(docs: DataFrame, words: int, radius: int, tree: int, doc_id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, fingerprint), and for every fingerprint (fp) its component: least fingerprint and least doc_id."""
    rows = freeze(fingerprints(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")), "text", words))
    classes = freeze(rows.groupBy(F.col("fingerprint").alias("fp")).agg(F.min("doc_id").alias("first")))
    roots = components(links(classes.select("fp", F.col("fp").alias("id")), radius, tree))
    rooted = freeze(classes.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("component")
    ))
    # stored, so that Spark can split the left side of the join with it
    least = freeze(rooted.groupBy("component").agg(F.min("first").alias("component_id")))
    return rows, rooted.join(least, "component").select("fp", "component", "component_id")


def near_duplicates(docs: DataFrame, words: int = WORDS, radius: int = RADIUS, tree: int = TREE,
                    doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fingerprint (long) and component_id of every row: the smallest doc_id that links lead to, or its own.

    Equal fingerprints link, so copies are one class with one row from there on. Null and word-less texts share the
    fingerprint zero and link like others. Rows without doc_id link like others too; component_id is null if no row of
    the component has a doc_id. Repeated rows are kept.
    """
    rows, found = _components(docs, words, radius, tree, doc_id, text)
    return rows.join(found, F.col("fingerprint") == F.col("fp"), "left").select("doc_id", "fingerprint", "component_id")


def keep_first(docs: DataFrame, words: int = WORDS, radius: int = RADIUS, tree: int = TREE,
               doc_id: str = "doc_id", text: str = "text", keep_unnamed: bool = True) -> DataFrame:
    """The rows of docs that are the first of their component. Of repeated rows with one doc_id all stay or none do.

    All rows without doc_id stay if keep_unnamed is set. Otherwise they stay only in components without any doc_id, one
    row in each: the least by fingerprint, text and the other columns that have an order.
    """
    rows, found = _components(docs, words, radius, tree, doc_id, text)
    joined = rows.where("doc_id IS NOT NULL").join(found, F.col("fingerprint") == F.col("fp"))
    key = fresh(docs, "_dropped")
    drop = freeze(joined.where("component_id <> doc_id").select(F.col("doc_id").alias(key)).distinct())
    if keep_unnamed:
        return docs.join(drop, docs[doc_id] == drop[key], "left_anti")
    named = docs[doc_id].cast("long").isNotNull()
    kept = docs.where(named).join(drop, docs[doc_id] == drop[key], "left_anti")
    unnamed = docs.where(~named).select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col(text).alias("text"))
    unnamed = fingerprints(unnamed, "text", words)
    alone = found.where("component_id IS NULL").select("fp", "component")
    order = [F.col("fingerprint"), *(F.col(f"row.`{f.name}`") for f in docs.schema.fields if isinstance(f.dataType, T.AtomicType))]
    one = unnamed.join(alone, F.col("fingerprint") == F.col("fp")).groupBy("component").agg(F.min_by("row", F.struct(*order)).alias("row"))
    return kept.unionByName(one.select("row.*"))
