"""A Merkle manifest of a dataset: hash trees by slot pivot.

Nodes of a group are numbered 0, 1, 2, ...; ``fanout`` consecutive ones have a
parent.  The slot pivot raises a whole layer in one aggregation: grouped by
ancestor, a conditional aggregate per slot spreads an ancestor's descendants
into columns.  Concatenating a parent's columns and hashing makes its digest;
the same columns without a node's own are its siblings.  One shuffle raises as
many levels as give ``WIDTH`` columns (four binary ones), so a tree of n leaves
takes log(n) / log(WIDTH) shuffles of geometrically shrinking tables.

A proof is put together on the way down: each layer's rows meet their
ancestor's siblings in an equi-join, one row per ``WIDTH`` nodes.

Numbers come from a range sort by all groups at once: the row's place in its
partition plus the partition's offset within the group.  No group, however
large, is in one task, and groups are never collected.  Nothing reaches the
driver but row counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialize

FANOUT = 2
WIDTH = 16  # columns of a layer: descendants that one shuffle brings together


def digest(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of the parts, one after the other."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, ``:`` and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def numbered(nodes: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``nodes`` with ``pos``: 0, 1, 2, ... within each (non-null) ``group`` by ``order``, nulls first, and its size ``n``.

    Rows equal in all of ``order`` get their numbers in any order."""
    by = [F.col(c).asc_nulls_first() for c in [group, *order]]
    salted = materialize(nodes.withColumn("_salt", F.xxhash64(F.monotonically_increasing_id())), "merkle-nodes")
    ranged = salted.repartitionByRange(*by, "_salt").sortWithinPartitions(*by, "_salt").drop("_salt")
    placed = materialize(ranged.withColumn("_at", F.monotonically_increasing_id()), "merkle-sorted")
    part = F.shiftrightunsigned("_at", 33)
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (placed.groupBy(group, part.alias("_part")).agg(F.count("*").alias("rows"), F.min("_at").alias("_first"))
             .select(group, "_part", (F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
                     F.sum("rows").over(Window.partitionBy(group)).alias("n")))
    return (placed.withColumn("_part", part).join(parts, [group, "_part"])
            .withColumn("pos", F.col("_at") + F.col("_shift")).drop("_at", "_part", "_shift"))


def _levels(fanout: int) -> int:
    """Levels that one shuffle raises."""
    levels = 1
    while fanout ** (levels + 1) <= WIDTH:
        levels += 1
    return levels


def _halved(count: Column, fanout: int) -> Column:
    return F.floor((count + (fanout - 1)) / fanout).cast("long")


def _parent_of(below: Column, fanout: int):
    """The digest of a parent's columns, null where it has no child."""
    def parent(i: Column) -> Column:
        children = [F.coalesce(below[i * fanout + k], F.lit("")) for k in range(fanout)]
        return F.when(below[i * fanout].isNotNull(), digest(*children))
    return parent


def raise_layer(nodes: DataFrame, group: str, fanout: int) -> DataFrame:
    """One layer up: rows (group, ``n`` nodes of the group below, ``pos``, ``l0`` .. ``lk``, ``h``).

    ``l0`` holds the ancestor's descendants by slot, ``l1`` their parents and
    so on; slots without a node are null.  A group stops at its one root:
    where a level has one node, the next holds the same one.
    """
    levels = _levels(fanout)
    width = fanout ** levels
    out = nodes.groupBy(group, "n", F.expr(f"pos div {width}").alias("up")).agg(
        *[F.expr(f"max(CASE WHEN pos % {width} = {i} THEN h END)").alias(f"s{i}") for i in range(width)])
    out = out.select(group, "n", "up", F.expr(f"array({', '.join(f's{i}' for i in range(width))})").alias("l0"))
    count = F.col("n")
    for j in range(levels):
        below, many = F.col(f"l{j}"), width // fanout ** (j + 1)
        parents = F.transform(F.sequence(F.lit(0), F.lit(many - 1)), _parent_of(below, fanout))
        out = out.withColumn(f"l{j + 1}", F.when(count == 1, F.slice(below, 1, many)).otherwise(parents))
        count = _halved(count, fanout)
    return out.withColumnRenamed("up", "pos").withColumn("h", F.col(f"l{levels}")[0])


def _siblings(fanout: int) -> Column:
    """The path of the node in ``slot`` through its layer's row: per level the siblings before and after it."""
    steps, count = [], "n"
    for j in range(_levels(fanout)):
        at = f"(slot div {fanout ** j})"
        run = f"slice(l{j}, CAST({at} div {fanout} * {fanout} + 1 AS INT), {fanout})"
        own = f"CAST({at} % {fanout} AS INT)"
        steps.append(f"CASE WHEN {count} > 1 THEN named_struct('left', array_join(slice({run}, 1, {own}), ''),"
                     f" 'right', array_join(slice({run}, {own} + 2, {fanout}), '')) END")
        count = f"(({count} + {fanout - 1}) div {fanout})"
    return F.expr(f"array_compact(array({', '.join(steps)}))")


_PATH = "array<struct<left:string,right:string>>"


def tree(nodes: DataFrame, group: str, fanout: int = FANOUT) -> tuple[list[DataFrame], DataFrame]:
    """(layers from the leaves up, roots) of the nodes (group, ``n``, ``pos``, ``h``); roots are (group, ``h``)."""
    levels = _levels(fanout)
    most = nodes.agg(F.max("n")).first()[0] or 0
    layers = []
    while True:
        layer = materialize(raise_layer(nodes, group, fanout), f"merkle-layer-{len(layers)}")
        layers.append(layer)
        most = -(-most // fanout ** levels)
        if most <= 1:
            return layers, layer.select(group, "h")
        up = F.col("n")
        for _ in range(levels):
            up = _halved(up, fanout)
        nodes = layer.select(group, up.alias("n"), "pos", "h")


def proofs(layers: list[DataFrame], above: DataFrame, group: str, fanout: int = FANOUT, carried: tuple[str, ...] = ()) -> DataFrame:
    """The lowest layer's rows with ``above``: the path from their ancestor up.

    ``above`` in: (group, path of the root) and what the rows of a group carry along."""
    width = fanout ** _levels(fanout)
    paths = above.select(group, F.lit(0).cast("long").alias("pos"), F.col("path").cast(_PATH).alias("above"), *carried)
    for k, layer in enumerate(reversed(layers)):
        rows = layer.drop("h").join(paths, [group, "pos"])
        if k == len(layers) - 1:
            return rows
        slots = F.explode(F.sequence(F.lit(0), F.lit(width - 1))).alias("slot")
        rows = rows.select("*", slots).where(F.col("l0")[F.col("slot")].isNotNull())
        paths = rows.select(group, (F.col("pos") * width + F.col("slot")).alias("pos"),
                            F.concat(_siblings(fanout), "above").alias("above"), *carried)
    raise ValueError("a tree has at least one layer")


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path give."""
    return F.aggregate(path, leaf, lambda h, step: digest(step["left"], h, step["right"]))


def manifest(docs: DataFrame, id_col: str = "doc_id", group_col: str = "lang",
             fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"), fanout: int = FANOUT,
             tampered: dict[str, Column] | None = None) -> DataFrame:
    """One row per input row: the id, ``leaf``, ``subroot``, ``root``, ``path``, ``proof_sha256``, ``folded_root``, ``verified``.

    A leaf is the digest of the row's ``fields``.  Leaves of a group ascend by
    id and make the group's tree; its roots, by group (null first, then
    bytewise), make the top tree.  ``path`` has, per level from the leaf to the
    root, the digests ``left`` and ``right`` of the node; a node that is a root,
    alone in a tree, has no step.  ``folded_root`` is the root that the path
    gives for the row as it is now: ``tampered`` may change fields on the way;
    ``verified`` says whether it is the root.

    Null ids come first.  Rows with one id ascend by their leaves; identical
    rows are leaves side by side.  Empty texts are values, nulls are marked.
    An empty table gives no rows.  Other columns are not read; a text column of
    any length is hashed whole.
    """
    def leaf(change: dict[str, Column]) -> Column:
        return digest(*[field(change.get(c, F.col(c))) for c in fields])

    group = F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit("-"))  # sorts as the groups do
    leaves = docs.select(F.col(id_col).alias("id"), group.alias("g"), leaf({}).alias("h"), leaf(tampered or {}).alias("now"))
    leaves = materialize(numbered(leaves, "g", ["id", "h"]), "merkle-leaves")
    layers, subroots = tree(leaves.select("g", "n", "pos", "h"), "g", fanout)

    tops = materialize(numbered(subroots.select(F.lit("").alias("all"), "g", "h"), "all", ["g"]), "merkle-subroots")
    top_layers, root = tree(tops.select("all", "n", "pos", "h"), "all", fanout)
    width = fanout ** _levels(fanout)
    no_path = tops.select("all", F.array().cast(_PATH).alias("path")).distinct()

    def with_path(nodes: DataFrame, key: str, lowest: DataFrame) -> DataFrame:
        """The nodes with ``path``, by their rows of the lowest layer."""
        at = nodes.drop("n").withColumns({"_up": F.floor(F.col("pos") / width).cast("long"),
                                "slot": F.pmod("pos", F.lit(width)).cast("int")})
        return (at.join(lowest.withColumnRenamed("pos", "_up"), [key, "_up"])
                .withColumn("path", F.concat(_siblings(fanout), "above")))

    of_groups = with_path(tops, "all", proofs(top_layers, no_path, "all", fanout))
    of_groups = materialize(of_groups.join(root.select("all", F.col("h").alias("root")), "all")
                            .select("g", "path", F.col("h").alias("subroot"), "root"), "merkle-tops")
    found = with_path(leaves, "g", proofs(layers, of_groups, "g", fanout, ("subroot", "root")))
    steps = F.transform("path", lambda s: F.concat(s["left"], s["right"]))
    return (found.select(F.col("id").alias(id_col), F.col("h").alias("leaf"), "subroot", "root", "path",
                         F.sha2(F.array_join(steps, ""), 256).alias("proof_sha256"),
                         fold(F.col("now"), F.col("path")).alias("folded_root"))
            .withColumn("verified", F.col("folded_root") == F.col("root")))
