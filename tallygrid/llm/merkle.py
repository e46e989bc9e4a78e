"""A Merkle manifest of a dataset: one tree per group, one tree over the groups' roots.

A row's leaf is the SHA-256 of its fields. Rows are ranked inside their group; the rank's
digits in base ``arity`` say where the leaf hangs. Nested-struct rollup: leaves are dealt to
blocks of ``arity ** depth`` neighbours, and inside a block one digit column after the other is
grouped away, the children becoming an array of structs inside their parent. All groupings
of a block need the one shuffle that dealt the block out. The tops of the blocks are the
nodes of the next round, a ``arity ** depth``-th of the rows, until a group has one node;
the groups' tops are rolled up in the same way. Coming back down, ``transform`` gives every
child its siblings and ``explode`` hands the nested children out, so a proof needs no
join: a block meets the path above it in a grouping of their union.

No task holds more of the tree than a block, whatever the size of a group; what rounds leave is
written to the shared folder.

Defined cases: order is by group (NULL first, bytewise), id (NULL first), leaf; rows alike in
all fields get neighbouring places, each its own proof. A NULL field is ``-``, so NULL and
the empty text differ. A lone leaf is its group's root and has an empty proof. Columns
beyond the named ones are not read, whatever they are called. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygrid.operators.ids import ordered_ids

from .common import staged

ARITY, DEPTH = 3, 6
# Neighbouring numbers that look their group's start up together.
RUN = 4096
PATH = "array<struct<left:string,right:string>>"


def sha256_hex(*texts: Column) -> Column:
    return F.sha2(F.concat(*texts), 256)


def field(value: Column) -> Column:
    """``-`` for NULL, else the count of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(*fields: Column) -> Column:
    return sha256_hex(*[field(f) for f in fields])


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(proof, leaf, lambda at, level: sha256_hex(level["left"], at, level["right"]))


def siblings(proof: Column) -> Column:
    """The digests of a proof in one text, level by level, left to right."""
    return F.array_join(F.transform(proof, lambda level: F.concat(level["left"], level["right"])), "")


def manifest(df: DataFrame, fields: Sequence[str], id_col: str, group_col: str, *,
             carry: dict[str, Column] | None = None, arity: int = ARITY, depth: int = DEPTH,
             part_rows: int = 1_000_000) -> DataFrame:
    """One row per row of ``df``: ``id``, ``group``, ``leaf``, ``subroot``, ``root``, ``proof`` (from
    the leaf up, the siblings left and right of it) and the ``carry`` columns."""
    if arity < 2 or depth < 1:
        raise ValueError("arity must be 2 and depth 1 at least")
    carried = carry or {}
    leaves = staged(df.select(
        F.col(id_col).alias("id"), F.col(group_col).alias("grp"),
        leaf_of(*[F.col(f) for f in fields]).alias("h"),
        F.struct(F.col(id_col).alias("id"), *[v.alias(k) for k, v in carried.items()]).alias("kids")))
    rounds = _rounds(_ranked(leaves, part_rows), ["grp"], arity, depth)
    tops = rounds[-1].select(F.struct("grp").alias("kids"), "grp", "h")
    over = _rounds(_numbered(tops, part_rows), [], arity, depth)

    paths = over[-1].select(F.lit(0).cast("long").alias("block"), F.col("h").alias("root"),
                            F.array().cast(PATH).alias("path"))
    for trees in reversed(over):
        paths = _expanded(trees, paths, [], ["root"], arity, depth)
    paths = staged(paths.select(F.col("kids.grp").alias("grp"), F.lit(0).cast("long").alias("block"),
                                F.col("h").alias("subroot"), "root", "path"))
    for trees in reversed(rounds):
        paths = _expanded(trees, paths, ["grp"], ["subroot", "root"], arity, depth)
    return paths.select("kids.id", F.col("grp").alias("group"), F.col("h").alias("leaf"), "subroot", "root",
                        F.col("path").alias("proof"), *[F.col(f"kids.{k}").alias(k) for k in carried])


def _ranked(leaves: DataFrame, part_rows: int) -> DataFrame:
    """(grp, rank, n, h, kids): the place of each leaf in its group, and the group's size.

    The group's first number is looked up per run of neighbouring numbers, so a group with
    most of the rows is dealt out over many keys.
    """
    rows = ordered_ids(leaves, "number", [F.asc_nulls_first("grp"), F.asc_nulls_first("id"), "h"],
                       start=-1, recompute=True, part_rows=part_rows)
    rows = rows.withColumn("run", F.floor(F.col("number") / RUN))
    runs = rows.groupBy("grp", "run").agg(F.min("number").alias("first"), F.count(F.lit(1)).alias("n"))
    sizes = runs.groupBy("grp").agg(F.min("first").alias("first"), F.sum("n").alias("n"))
    starts = runs.select("grp", "run").alias("r").join(
        sizes.alias("s"), F.expr("r.grp <=> s.grp")).select("r.grp", "r.run", "s.first", "s.n")
    return (rows.alias("l").join(starts.alias("r"), F.expr("l.grp <=> r.grp AND l.run = r.run"))
            .select("l.grp", (F.col("number") - F.col("first")).alias("rank"), "n", "h", "kids"))


def _numbered(tops: DataFrame, part_rows: int) -> DataFrame:
    """The roots of the groups in the order of the groups."""
    rows = ordered_ids(tops, "rank", [F.asc_nulls_first("grp")], start=-1, part_rows=part_rows)
    return rows.select("rank", F.lit(tops.count()).cast("long").alias("n"), "h", "kids")


def _rounds(nodes: DataFrame, by: list[str], arity: int, depth: int) -> list[DataFrame]:
    """Trees of blocks, round after round, until no group has more than one block."""
    width, out = arity ** depth, []
    while True:
        trees = staged(_rolled(nodes, by, arity, depth))
        out.append(trees)
        if not trees.where("block > 0").take(1):
            return out
        nodes = trees.select(*by, F.col("block").alias("rank"), F.ceil(F.col("n") / width).alias("n"), "h",
                             F.struct(F.col("block")).alias("kids"))


def _rolled(nodes: DataFrame, by: list[str], arity: int, depth: int) -> DataFrame:
    """(*by, block, n, h, kids): a nested tree per block of ``arity ** depth`` nodes."""
    digits = [(F.floor(F.col("rank") / arity ** j) % arity).cast("int").alias(f"d{j}") for j in range(depth)]
    rows = nodes.select(*by, F.floor(F.col("rank") / arity ** depth).alias("block"), "n", *digits, "h", "kids")
    rows = rows.repartition(*by, "block")
    for j in range(depth):
        child = F.struct(F.col(f"d{j}").alias("d"), "h", "kids")
        rows = (rows.groupBy(*by, "block", "n", *[f"d{i}" for i in range(j + 1, depth)])
                .agg(F.sort_array(F.collect_list(child)).alias("kids")))
        digests = F.transform("kids", lambda kid: kid["h"])
        # above a group's root nothing is hashed: the one child is handed on
        rows = rows.withColumn("h", F.when(F.col("n") > arity ** j, sha256_hex(F.array_join(digests, "")))
                               .otherwise(digests[0]))
    return rows.select(*by, "block", "n", "h", "kids")


def _expanded(trees: DataFrame, above: DataFrame, by: list[str], known: list[str], arity: int,
              depth: int) -> DataFrame:
    """(*by, block, *known, path, h, kids): the nodes at the foot of the trees with their paths
    to the root; ``block`` is the node's rank, the block it is in the round below."""
    both = trees.select(*by, "block", "n", "kids").unionByName(
        above.select(*by, "block", *known, "path"), allowMissingColumns=True)
    rows = both.groupBy(*by, "block").agg(
        *[F.first(c, ignorenulls=True).alias(c) for c in ["n", "kids", *known, "path"]])
    for j in reversed(range(depth)):
        rows = rows.select(*by, "block", "n", *known, "path", F.explode(_with_siblings("kids")).alias("kid"))
        level = F.array(F.struct(F.col("kid.left").alias("left"), F.col("kid.right").alias("right")))
        rows = rows.select(*by, (F.col("block") * arity + F.col("kid.d")).alias("block"), "n", *known,
                           F.when(F.col("n") > arity ** j, F.concat(level, "path"))
                           .otherwise(F.col("path")).alias("path"), "kid.h", "kid.kids")
    return rows.drop("n")


def _with_siblings(kids: str) -> Column:
    def other(first: Column, count: Column) -> Column:
        return F.array_join(F.transform(F.slice(kids, first, count), lambda kid: kid["h"]), "")

    return F.transform(kids, lambda kid, at: F.struct(
        kid["d"].alias("d"), kid["h"].alias("h"), kid["kids"].alias("kids"),
        other(F.lit(1), at).alias("left"), other(at + 2, F.size(kids)).alias("right")))
