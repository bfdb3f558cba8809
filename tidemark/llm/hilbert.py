"""Approximate nearest neighbours by inner product through shifted Hilbert curves.

Every curve projects the vectors on random directions, shifts them and orders them along a Hilbert curve of their cells.
The order is found by range partitioning. On each curve a query's candidates are the vectors of its chunk of the order and of
the chunks beside it; the candidates of all curves are merged, and the best are compared exactly.

What travels along a curve is an 8-bit code of each vector with a bound on its error, so a window gives an interval for each
inner product. The first curves settle a bound below which a query's candidates cannot be among its best; the others hand
on what reaches above it. The exact vectors are fetched only for those whose interval still reaches among the best of all
curves, so no candidate is lost to the code.

Inner products become distances by one more coordinate, sqrt(max |x|^2 - |x|^2) for candidates. Queries, scaled to the
largest length, have 0 there: the order of their inner products stays, and is then that of nearness. One long vector
would leave all others a few cells, so candidates lie in bands of length, a factor of two each: a band has its own
curves, on which its longest vector has length 1, and every query is asked in every band.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import freeze

CURVES = 96
DIMENSIONS = 16
BITS = 3
#: The vectors that a query meets on one curve, as a share of the band's; its own chunk is a third of them.
SHARE = 0.005
#: Vectors of a chunk, at least and at most.
LEAST = 20
CHUNK = 2048
#: Curves that settle the bound.
FIRST = 8
#: Queries that a task compares with a chunk at once, at most.
PACK = 512
SEED = 7


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on a Hilbert curve of cells (rows of whole numbers below 2^bits), by Skilling's transform.

    The product of bits and dimensions must be below 64.
    """
    x = cells.T.astype(np.int64).copy()
    dims = len(x)
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        for i in range(dims):
            swap = np.where(x[i] & q, 0, (x[0] ^ x[i]) & (q - 1))
            x[0] ^= np.where(x[i] & q, q - 1, swap)
            x[i] ^= swap
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], np.int64)
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        turn ^= np.where(x[-1] & q, q - 1, 0)
    x ^= turn
    key = np.zeros(x.shape[1], np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = key << 1 | x[i] >> b & 1
    return key


def directions(curve: int, size: int, dimensions: int = DIMENSIONS) -> tuple[np.ndarray, np.ndarray]:
    """Orthogonal directions and a shift of an eighth to both sides for a curve."""
    rng = np.random.default_rng((SEED, curve))
    found = np.linalg.qr(rng.normal(size=(size, min(size, dimensions))))[0]
    return found, (rng.random(found.shape[1]) - 0.5) / 4


def coded(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows as 8-bit whole numbers times a scale each, and the length of what that leaves out."""
    scale = np.abs(x).max(axis=1, initial=0) / 127
    scale[scale == 0] = 1
    code = np.rint(x / scale[:, None]).astype(np.int8)
    rest = x - code * scale[:, None]
    return code, scale, np.sqrt((rest * rest).sum(axis=1)) * (1 + 1e-9) + 1e-15


def usable(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """id and v (doubles) of the vectors that take part: not null, not zero, all components finite, of the usual length.

    Rows without an id are left out; the usual length is the commonest one, the longest of equally common ones.
    """
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    rows = rows.where(F.col("id").isNotNull() & F.col("v").isNotNull() & ~F.exists("v", odd) & F.exists("v", lambda x: x != 0))
    usual = rows.groupBy(F.size("v").alias("size")).count().agg(F.max(F.struct("count", "size")).alias("m"))
    return rows.join(F.broadcast(usual), F.size("v") == F.col("m.size")).select("id", "v")


def log_length() -> Column:
    """log2 |v|, finite for every vector with a component other than 0."""
    largest = F.array_max(F.transform("v", F.abs))
    scaled = F.log2(largest) + F.log2(F.aggregate("v", F.lit(0.0), lambda a, x: a + (x / largest) * (x / largest))) / 2
    # scaling takes the square of the components' number, and is for squares that a double doesn't hold
    return F.aggregate(
        "v", F.lit(0.0), lambda a, x: a + x * x, lambda a: F.when(a.between(1e-200, 1e200), F.log2(a) / 2).otherwise(scaled)
    )


def _unit(batch, size: int) -> np.ndarray:
    v = batch.column("v").flatten().to_numpy().reshape(batch.num_rows, size)
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def _points(placing: DataFrame, tops: dict[int, float], longest: float, size: int, curves: int) -> DataFrame:
    """A row for each vector and curve of its band, with its code, and one for each query and curve, without."""
    spread = 8 / math.sqrt(size)  # cells cover four standard deviations on both sides of zero

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            v = _unit(batch, size)
            asked = np.flatnonzero(batch.column("asked").to_numpy(zero_copy_only=False))
            band, length = batch.column("band").to_numpy(), batch.column("length").to_numpy()
            part = np.exp2(length - np.array([tops[b] for b in band.tolist()]))[:, None]
            code, scale, rest = coded(v * np.exp2(length - longest)[:, None])
            bare = pa.nulls(len(asked), pa.binary()), pa.nulls(len(asked), pa.float64())
            codes = pa.concat_arrays([pa.array([c.tobytes() for c in code], pa.binary()), bare[0]])
            scales, rests = (pa.concat_arrays([pa.array(x), bare[1]]) for x in (scale, rest))
            points = np.vstack((
                np.hstack((v * part, np.sqrt(np.maximum(1 - part * part, 0)))), np.hstack((v[asked], np.zeros((len(asked), 1)))),
            ))
            rep = batch.column("rep").to_numpy()
            rep, bands = pa.array(np.concatenate((rep, rep[asked]))), pa.array(np.concatenate((band, band[asked])))
            query = pa.array(np.arange(len(points)) >= n)
            for c in range(curves):
                way, shift = directions(c, size + 1)
                cells = np.clip((points @ way) / spread * 0.75 + 0.5 + shift, 0, 1 - 1e-9) * (1 << BITS)
                yield pa.RecordBatch.from_arrays([
                    bands, pa.array(np.full(len(points), c, np.int32)), pa.array(hilbert_keys(cells.astype(np.int64), BITS)), rep, query,
                    codes, scales, rests,
                ], names=["band", "curve", "key", "rep", "query", "code", "scale", "rest"])

    points = placing.mapInArrow(
        run, "band int, curve int, key long, rep long, query boolean, code binary, scale double, rest double"
    )
    everywhere = F.array(*(F.lit(b) for b in sorted(tops)))
    return points.withColumn("band", F.explode(F.when(F.col("query"), everywhere).otherwise(F.array("band"))))


def _chunks(points: DataFrame, widths: dict[int, int]) -> DataFrame:
    """The points along their curves, cut into chunks of a band's width.

    A row is either a chunk, with its members' ids, codes, scales and rests in one value each, or a query (id) with the number
    of its chunk and a pack. Chunks are numbered through a band's curve; one ends where its range does.
    """
    order = ["band", "curve", "key", "rep", "query"]
    n = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches):
        import pyarrow as pa

        names = ["band", "curve", "range", "local", "id", "pack", "ids", "codes", "scales", "rests"]
        here, now, before, asked, held = TaskContext.get().partitionId(), None, 0, 0, []

        def chunk():
            parts = [b"".join(x) for x in zip(*held)]
            local = (before - 1) // widths[now[0]]
            held.clear()
            return pa.RecordBatch.from_pydict({
                "band": pa.array([now[0]], pa.int32()), "curve": pa.array([now[1]], pa.int32()), "range": pa.array([here], pa.int32()),
                "local": pa.array([local], pa.int32()), "id": pa.nulls(1, pa.int64()), "pack": pa.nulls(1, pa.int32()),
                **{c: pa.array([x], pa.binary()) for c, x in zip(names[6:], parts)},
            })

        for batch in batches:
            if not batch.num_rows:
                continue
            band, curve, rep = (batch.column(c).to_numpy() for c in ("band", "curve", "rep"))
            query = batch.column("query").to_numpy(zero_copy_only=False)
            turns = np.flatnonzero((np.diff(band) != 0) | (np.diff(curve) != 0)) + 1
            for a, b in zip([0, *turns.tolist()], [*turns.tolist(), len(band)]):
                if (band[a], curve[a]) != now:
                    if held:
                        yield chunk()
                    now, before, asked = (band[a], curve[a]), 0, 0
                width = widths[now[0]]
                members, queries = a + np.flatnonzero(~query[a:b]), a + np.flatnonzero(query[a:b])
                if len(queries):
                    local = (before + np.searchsorted(members, queries)) // width
                    packs = (asked + np.arange(len(queries))) // PACK
                    asked += len(queries)
                    empty = [pa.nulls(len(queries), pa.binary())] * 4
                    yield pa.RecordBatch.from_arrays([
                        *(pa.array(np.full(len(queries), x, np.int32)) for x in (*now, here)), pa.array(local.astype(np.int32)),
                        pa.array(rep[queries]), pa.array(packs.astype(np.int32)), *empty,
                    ], names=names)
                at = 0
                while at < len(members):
                    take = members[at:at + width - before % width]
                    rows = batch.slice(int(take[0]), int(take[-1] - take[0]) + 1)
                    inside = pa.array(take - take[0])
                    held.append((
                        rep[take].tobytes(), b"".join(rows.column("code").take(inside).to_pylist()),
                        *(rows.column(c).take(inside).to_numpy().tobytes() for c in ("scale", "rest")),
                    ))
                    at, before = at + len(take), before + len(take)
                    if before % width == 0:
                        yield chunk()
        if held:
            yield chunk()

    rows = freeze(points.repartitionByRange(n, *order).sortWithinPartitions(*order).mapInArrow(
        run, "band int, curve int, range int, local int, id long, pack int, ids binary, codes binary, scales binary, rests binary"
    ))
    # a row for each range that a curve touches
    ranges = rows.groupBy("band", "curve", "range").agg(F.coalesce(F.max(F.when(F.col("id").isNull(), F.col("local"))) + 1, F.lit(0)).alias("n"))
    earlier = Window.partitionBy("band", "curve").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("first", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    return rows.join(ranges, ["band", "curve", "range"]).withColumn("chunk", (F.col("local") + F.col("first")).cast("int"))


def _codes(asked: DataFrame, size: int) -> DataFrame:
    """query, code, scale and rest of unit vectors in the queries' directions."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            if batch.num_rows:
                code, scale, rest = coded(_unit(batch, size))
                yield pa.RecordBatch.from_arrays([
                    batch.column("rep"), pa.array([c.tobytes() for c in code], pa.binary()), pa.array(scale), pa.array(rest)
                ], names=["query", "code", "scale", "rest"])

    return asked.mapInArrow(run, "query long, code binary, scale double, rest double")


def _within(chunks: DataFrame, queries: DataFrame, reaches: DataFrame, size: int, k: int) -> DataFrame:
    """query, rep, low and high: bounds of the inner products (of a unit query) that may be among a query's k best.

    queries has the code of each query and low, below which nothing is wanted. Only the k best of a chunk are handed on, and
    those whose interval reaches among them.
    """
    places = chunks.where("id IS NOT NULL").select("band", "curve", "chunk", "range", "pack", F.col("id").alias("query"))
    near = F.explode(F.sequence(F.col("chunk") - F.col("reach"), F.col("chunk") + F.col("reach"))).alias("chunk")
    asking = places.join(F.broadcast(reaches), "band").select("band", "curve", "range", "pack", near, "query").join(queries, "query")
    one = F.struct("query", "code", "scale", "rest", "low")
    # chunks that are near each other send at most a pack each from a range
    asking = asking.groupBy("band", "curve", "chunk", "range", "pack").agg(F.collect_list(one).alias("queries"))
    members = chunks.where("id IS NULL").select("band", "curve", "chunk", "ids", "codes", "scales", "rests")
    pairs = members.join(asking, ["band", "curve", "chunk"]).select("ids", "codes", "scales", "rests", "queries")
    kind = np.float32 if size * 127 * 127 < 1 << 24 else np.float64  # sums of products of codes stay exact

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            blobs = [batch.column(c).to_pylist() for c in ("ids", "codes", "scales", "rests")]
            for i, (ids, codes, scales, rests) in enumerate(zip(*blobs)):
                asked = batch.column("queries").slice(i, 1).flatten()
                ids, scales, rests = np.frombuffer(ids, np.int64), np.frombuffer(scales), np.frombuffer(rests)
                x = np.frombuffer(codes, np.int8).reshape(len(ids), size).astype(kind)
                names, sq, eq, bound = (asked.field(c).to_numpy(zero_copy_only=False) for c in ("query", "scale", "rest", "low"))
                q = np.frombuffer(b"".join(asked.field("code").to_pylist()), np.int8).reshape(len(names), size).astype(kind)
                middle = (q @ x.T) * sq[:, None] * scales[None, :]
                off = rests[None, :] + eq[:, None] * (scales * np.sqrt((x * x).sum(axis=1)))[None, :]
                low, high = middle - off, middle + off
                n = min(k, len(ids))
                least = np.maximum(-np.partition(-low, n - 1, axis=1)[:, n - 1] if n == k else -np.inf, bound)
                row, column = np.nonzero(high >= least[:, None])
                if len(row):
                    yield pa.RecordBatch.from_arrays([
                        pa.array(names[row]), pa.array(ids[column]), pa.array(low[row, column]), pa.array(high[row, column]),
                    ], names=["query", "rep", "low", "high"])

    return pairs.mapInArrow(run, "query long, rep long, low double, high double")


def _bounds(found: DataFrame, k: int) -> DataFrame:
    """found with each query's pairs once, and least, the k-th best low of the query, where it has as many."""
    once = found.groupBy("query", "rep").agg(F.max("low").alias("low"), F.max("high").alias("high"))
    order = Window.partitionBy("query").orderBy(F.col("low").desc(), "rep")
    ranked = once.withColumn("_i", F.row_number().over(order))
    whole = Window.partitionBy("query")
    return ranked.withColumn("least", F.max(F.when(F.col("_i") == k, F.col("low"))).over(whole)).drop("_i")


def search(vectors: DataFrame, every: int = 20, k: int = 20, vec_id: str = "vec_id", vector: str = "embedding",
           curves: int = CURVES, share: float = SHARE, least: int = LEAST, chunk: int = CHUNK) -> DataFrame:
    """query_id, rank, vec_id and score: for each row whose id is divisible by every, its k nearest of the other rows.

    Nearest first, by the largest inner product, ties by the smaller vec_id. Equal vectors are searched as one and told
    apart at the end, so a vector that a third of the rows have costs no more than another. Repeated rows with one id
    count once. Vectors that usable() leaves out take no part; an empty table gives no rows.

    A query meets about share of a band on each of its curves, so curves times share of all vectors at most, however many
    there are. Vectors with more structure than directions need less.
    """
    rows = freeze(usable(vectors, vec_id, vector).distinct())
    classes = rows.groupBy("v").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("n"), F.max(F.col("id") % every == 0).alias("asked"))
    classes = freeze(classes.withColumn("length", log_length()))
    longest, size = classes.agg(F.max("length"), F.max(F.size("v"))).first()
    if longest is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    placing = classes.withColumn("band", F.floor(F.lit(longest) - F.col("length")).cast("int"))
    # one row per band, and a band is a factor of two in length
    bands = placing.groupBy("band").agg(F.count(F.lit(1)).alias("count"), F.max("length").alias("top")).collect()
    wanted = {r.band: max(least, math.ceil(share * r["count"] / 3)) for r in bands}
    widths = {b: min(chunk, n) for b, n in wanted.items()}
    reaches = vectors.sparkSession.createDataFrame([(b, math.ceil(n / widths[b])) for b, n in wanted.items()], "band int, reach int")
    points = _points(placing.select("v", "rep", "asked", "length", "band"), {r.band: r.top for r in bands}, longest, size, curves)
    chunks = _chunks(points, widths)

    # the k + 1 best: one of them may be the query's own
    asked = freeze(_codes(classes.where("asked").select("rep", "v"), size))
    start = F.lit(-math.inf)
    first = freeze(_within(chunks.where(F.col("curve") < FIRST), asked.withColumn("low", start), reaches, size, k + 1))
    bound = _bounds(first, k + 1).groupBy("query").agg(F.max("least").alias("low"))
    known = freeze(asked.join(bound, "query", "left").withColumn("low", F.coalesce("low", start)))
    later = _within(chunks.where(F.col("curve") >= FIRST), known, reaches, size, k + 1)
    found = _bounds(first.unionByName(later), k + 1).where("least IS NULL OR high >= least").select("query", "rep")

    exact = F.aggregate(F.zip_with("q", "x", lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
    found = found.join(classes.select(F.col("rep").alias("query"), F.col("v").alias("q")), "query")
    found = found.join(classes.select("rep", F.col("v").alias("x")), "rep").select("query", "rep", exact.alias("score"))
    best = Window.partitionBy("query").orderBy(F.col("score").desc(), "rep")
    found = found.withColumn("i", F.row_number().over(best)).where(F.col("i") <= k + 1).drop("i")
    return _expand(rows, classes, found, every, k)


def _expand(rows: DataFrame, classes: DataFrame, found: DataFrame, every: int, k: int) -> DataFrame:
    """From classes of equal vectors to rows. Of a class only the k + 1 smallest ids can be among k results."""
    members = rows.join(classes.where("n > 1").select("v", "rep"), "v").select("rep", "id")
    by_id = Window.partitionBy("rep").orderBy("id")
    first = members.withColumn("i", F.row_number().over(by_id)).where(F.col("i") <= k + 1)
    first = first.groupBy("rep").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    near = found.join(first, "rep", "left").select(
        "query", "score", F.explode(F.coalesce("ids", F.array("rep"))).alias("id")
    )
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "id")
    lists = near.withColumn("i", F.row_number().over(order)).where(F.col("i") <= k + 1).groupBy("query").agg(
        F.sort_array(F.collect_list(F.struct("i", "id", "score"))).alias("near")
    )
    queries = members.unionByName(classes.where("n = 1").select("rep", F.col("rep").alias("id"))).where(F.col("id") % every == 0)
    ranked = queries.join(lists, F.col("rep") == F.col("query")).select(
        F.col("id").alias("query_id"),
        F.posexplode(F.slice(F.filter("near", lambda x: x.id != F.col("id")), 1, k)).alias("rank", "x"),
    )
    return ranked.select(
        "query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("x.id").alias("vec_id"), F.col("x.score").alias("score")
    )
