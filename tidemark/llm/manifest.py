"""Merkle manifest of a table: a leaf digest per row, one tree per group and one over the groups' roots.

The digest H of some texts is the lower-case hex SHA-256 of them joined. A leaf is H of its row's fields, each `-` if null, else
its length in bytes, a colon and the value. Every SPAN consecutive nodes of a level become their H, the last run as long
as it happens to be, until one node is left.

Nodes are numbered along their group's order by ranges, which gives each its run (number div SPAN) and its slot in it. On a
level, windows over blocks of many whole runs hold lag and lead columns at the fixed offsets 1 to SPAN - 1. Masked by slot and
run length they are a node's siblings, and the node in slot 0 hashes the parent. A group of any size fills as many blocks as
it needs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower, fresh
from tidemark.operators.ordering import numbered
from tidemark.session import freeze

SPAN = 8
#: Runs of a window's block.
RUNS = 64
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PLACE = ("grp", "pos", "size")


def digest(text: Column) -> Column:
    """SHA-256 of a text as 32 bytes."""
    return F.unhex(F.sha2(text.cast("binary"), 256))


def hex_of(node: Column) -> Column:
    """Digests, one after another in bytes, as lower-case hex text."""
    return F.lower(F.hex(node))


def leaf_of(values: Sequence[Column]) -> Column:
    """The leaf of a row with these values, as bytes."""
    fields = []
    for v in values:
        text = v.cast("string")
        fields.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return digest(F.concat(*fields))


def with_siblings(nodes: DataFrame) -> DataFrame:
    """Add left and right, the digests of the run's nodes before and after each node, and _slot.

    nodes has grp, pos (its number in the group from 0), size (the group's nodes) and node. Groups of one node are
    left out: they have no run.
    """
    rows = nodes.where("size > 1").withColumn("_slot", F.col("pos") % SPAN)
    rows = rows.withColumn("_run", F.least(F.lit(SPAN), F.col("size") - F.col("pos") + F.col("_slot")))
    rows = rows.withColumn("_block", F.floor(F.col("pos") / (SPAN * RUNS)))
    order = Window.partitionBy("grp", "_block").orderBy("pos")
    none = F.lit(b"")
    left = [F.when(F.col("_slot") >= i, F.lag("node", i).over(order)).otherwise(none) for i in range(SPAN - 1, 0, -1)]
    right = [F.when(F.col("_slot") + i < F.col("_run"), F.lead("node", i).over(order)).otherwise(none) for i in range(1, SPAN)]
    names = [f"_lag{i}" for i in range(SPAN - 1, 0, -1)], [f"_lead{i}" for i in range(1, SPAN)]
    rows = rows.select("*", *(c.alias(n) for c, n in zip([*left, *right], [*names[0], *names[1]])))
    return rows.withColumns({"left": F.concat(*names[0]), "right": F.concat(*names[1])}).drop(*names[0], *names[1], "_run", "_block")


def parents(nodes: DataFrame) -> DataFrame:
    """The next level: the first child of each run hashes it."""
    first = with_siblings(nodes).where("_slot = 0")
    return first.select(
        "grp", F.floor(F.col("pos") / SPAN).alias("pos"), F.ceil(F.col("size") / SPAN).alias("size"),
        digest(hex_of(F.concat("node", "right"))).alias("node"),
    )


def levels(nodes: DataFrame) -> list[DataFrame]:
    """The nodes, then each level above them, stored; the last has one node of each group that has got that far."""
    out = [freeze(nodes)]
    top = out[0].agg(F.max("size")).first()[0] or 0
    while top > 1:
        out.append(freeze(parents(out[-1])))
        top = -(-top // SPAN)
    return out


def root_of(tree: list[DataFrame]) -> DataFrame:
    """grp and node of each group's last node: those of all levels that stand alone."""
    out = None
    for level in tree:
        last = level.where("size = 1").select("grp", "node")
        out = last if out is None else out.unionByName(last)
    return out


def with_path(tree: list[DataFrame], above: DataFrame | None = None, carry: Sequence[str] = ()) -> DataFrame:
    """grp, pos, size, node, the carried columns and path of the first level's nodes.

    path holds left and right for each level up to the root, from the bottom. above (grp, path) goes on from the
    groups' roots; it has one row per group.
    """
    path, nothing = None, F.array().cast("array<struct<left:binary,right:binary>>")
    for depth in reversed(range(len(tree))):
        keep = [*PLACE, "node", *(carry if depth == 0 else ())]
        alone = tree[depth].where("size = 1").select(*keep)
        if above is None:
            alone = alone.withColumn("path", nothing)
        else:
            alone = alone.join(above.select(F.col("grp").alias("_grp"), "path"), F.col("grp") == F.col("_grp")).drop("_grp")
        if path is None:
            path = alone
            continue
        up = path.select(F.col("grp").alias("_grp"), F.col("pos").alias("_up"), F.col("path").alias("_path"))
        here = with_siblings(tree[depth])
        joined = here.join(up, (F.col("grp") == F.col("_grp")) & (F.floor(F.col("pos") / SPAN) == F.col("_up")))
        joined = joined.select(*keep, F.concat(F.array(F.struct("left", "right")), "_path").alias("path"))
        path = joined.unionByName(alone)
    return path


def fold(node: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, node, lambda at, x: digest(hex_of(F.concat(x["left"], at, x["right"]))))


def manifest(docs: DataFrame, fields: Sequence[str] = FIELDS, key: str = "doc_id", group: str = "lang",
             text: str = "text") -> DataFrame:
    """key, group, leaf, tampered_leaf, subroot, root and path (left and right digests by level) of every row.

    Leaves stand in the order of the key in their group, groups in the order of their UTF-8 bytes, null first. tampered_leaf
    is the leaf that the row would have with A-Z of its text lower-cased; a null text stays. Digests are bytes.

    Rows with one key are ordered by their leaf, rows alike in all fields follow each other, null keys come first; rows
    without group have a tree of their own. A single row is its own subroot, and a single subroot the root. An empty
    table gives no rows. Columns that fields does not name play no part.
    """
    # numbered() samples its input, so the texts are hashed before it. The row number tells equal rows apart.
    values = [F.col(c) for c in fields]
    tampered = [ascii_lower(F.col(c)) if c == text else F.col(c) for c in fields]
    rows = freeze(docs.select(
        F.col(key).alias("key"), F.struct(F.col(group).alias("name")).alias("grp"), leaf_of(values).alias("node"),
        leaf_of(tampered).alias("tampered"), F.monotonically_increasing_id().alias("row"),
    ))
    leaves = numbered(rows, [F.col("key"), F.col("node"), F.col("row")], ["grp"])
    leaves = leaves.select("grp", (F.col("_rn") - 1).alias("pos"), F.col("_size").alias("size"), "node", "key", "tampered")
    tree = levels(leaves)

    subroots = freeze(root_of(tree))
    ordered = numbered(subroots.withColumnRenamed("grp", "name"), [F.col("name")])
    tops = levels(ordered.select(
        F.lit(0).alias("grp"), (F.col("_rn") - 1).alias("pos"), F.col("_size").alias("size"), "node", "name"
    ))
    # one row
    root = root_of(tops).select(F.col("node").alias("root"))
    above = freeze(with_path(tops, carry=["name"]).select(F.col("name").alias("grp"), "path"))
    return _with_subroot(with_path(tree, above, ["key", "tampered"]), subroots).crossJoin(F.broadcast(root)).select(
        F.col("key").alias(key), F.col("grp.name").alias(group), F.col("node").alias("leaf"), F.col("tampered").alias("tampered_leaf"),
        "subroot", "root", "path",
    )


def _with_subroot(rows: DataFrame, subroots: DataFrame) -> DataFrame:
    name = fresh(rows, "_name")
    return rows.join(subroots.select(F.col("grp").alias(name), F.col("node").alias("subroot")), F.col("grp") == F.col(name)).drop(name)


def proof(path: Column) -> Column:
    """The digest of all siblings of a path, as hex text."""
    joined = F.aggregate(path, F.lit(b""), lambda at, x: F.concat(at, x["left"], x["right"]))
    return F.sha2(hex_of(joined).cast("binary"), 256)
