"""A Merkle manifest of a table: a digest for every row, a proof for every digest, one root.

A row is a leaf, the digest of its columns. Leaves of a group stand in order of their id; every
`fanout` consecutive nodes are a run and hash to their parent, level by level, until one node remains,
the subroot. Subroots in order of their group are the leaves of the last tree, whose top is the root.

Each level is a window over nodes in order: `lag` and `lead` at fixed offsets are a node's siblings,
masked by its slot in the run and by the length of the run, and the rows that stand first in their run
hash the parents. A node of level `l` lives on the row of its first leaf, so the offsets of that level
are multiples of `fanout ** l`, all levels of a block share one shuffle and one sort, and every leaf
takes over its ancestors' siblings as the last ones given before it.

Skew: a group may hold any share of the rows. Slots come from counts of ranges of (group, id), windows
run over blocks of at most `BLOCK` slots of a group, and the first rows of the blocks, a thousandth of
the rows, are the leaves of the next round. Proofs come down the same way, a block at a time.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nearfold.session import Steps, freeze

BLOCK = 1 << 10
_NONE = ""


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of the parts in a row."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """A value as it goes into a leaf: `-` for null, else its number of UTF-8 bytes, a colon and itself."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(columns: Sequence[str], replaced: dict[str, Column] | None = None) -> Column:
    """The leaf of a row, with some of its columns `replaced`."""
    return digest(*[field((replaced or {}).get(c, F.col(c))) for c in columns])


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings lead to; `path` holds `left, right` for each level."""
    return F.aggregate(path, leaf, lambda node, s: digest(s["left"], node, s["right"]))


def _group_key(group: Column) -> Column:
    """A group as text that is never null and keeps the order: null first, then bytewise."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))


def _placed(nodes: DataFrame, order: Sequence[str], steps: Steps, name: str) -> DataFrame:
    """`slot`, the place in the group `g` by `order`, and `n`, the nodes of the group.

    The last column of `order` must tell all rows apart, else rows with one key could not be dealt
    to more than one range.
    """
    ranged = nodes.repartitionByRange("g", *order).withColumn("part", F.spark_partition_id())
    ranged = steps.freeze(ranged, f"{name}-ranged")
    counts = ranged.groupBy("g", "part").agg(F.count("*").alias("in_part"))
    group = Window.partitionBy("g")
    before = group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(
        "g", "part",
        F.coalesce(F.sum("in_part").over(before), F.lit(0)).alias("base"),
        F.sum("in_part").over(group).alias("n"),
    )
    nth = F.row_number().over(Window.partitionBy("g", "part").orderBy(*order)) - 1
    placed = ranged.withColumn("nth", nth).join(bases, ["g", "part"])
    return placed.withColumn("slot", F.col("base") + F.col("nth")).drop("part", "nth", "base", *order)


def _levels(fanout: int) -> int:
    """Levels of a block of at most `BLOCK` slots."""
    levels = 1
    while fanout ** (levels + 1) <= BLOCK:
        levels += 1
    return levels


def _block_round(nodes: DataFrame, fanout: int) -> DataFrame:
    """From `g, slot, n, node`: adds `block`, `top` (on the block's first row its node) and `path`.

    `path` has the siblings `left, right` of every level of the block that the group's tree has.
    """
    levels = _levels(fanout)
    rows = nodes.withColumn("block", F.floor(F.col("slot") / fanout**levels)).withColumn("node_0", F.col("node"))
    block = Window.partitionBy("g", "block").orderBy("slot")
    for level in range(levels):
        step, node = fanout**level, F.col(f"node_{level}")
        child = F.floor(F.col("slot") / step) % fanout
        is_node, grows = F.col("slot") % step == 0, F.col("n") > step
        rows = rows.withColumns(
            {f"lag_{j}": F.lag(node, j * step).over(block) for j in range(1, fanout)}
            | {f"lead_{j}": F.lead(node, j * step).over(block) for j in range(1, fanout)}
        )
        left = F.concat(*[F.when(child >= j, F.col(f"lag_{j}")).otherwise(_NONE) for j in range(fanout - 1, 0, -1)])
        in_run = [(child + j < fanout) & (F.col("slot") + j * step < F.col("n")) for j in range(1, fanout)]
        right = F.concat(*[F.when(x, F.col(f"lead_{j}")).otherwise(_NONE) for j, x in enumerate(in_run, 1)])
        rows = rows.withColumns(
            {
                f"side_{level}": F.when(is_node & grows, F.struct(left.alias("left"), right.alias("right"))),
                f"node_{level + 1}": F.when(
                    F.col("slot") % (step * fanout) == 0, F.when(grows, digest(node, right)).otherwise(node)
                ),
            }
        ).drop(*[f"{kind}_{j}" for kind in ("lag", "lead") for j in range(1, fanout)], f"node_{level}")
    so_far = block.rowsBetween(Window.unboundedPreceding, 0)
    sides = F.array(*[F.last(f"side_{level}", ignorenulls=True).over(so_far) for level in range(levels)])
    return rows.select(
        *nodes.columns, "block", F.col(f"node_{levels}").alias("top"),
        F.filter(sides, lambda s: s.isNotNull()).alias("path"),
    )


def _rounds(nodes: DataFrame, fanout: int, steps: Steps, name: str) -> tuple[list[DataFrame], DataFrame]:
    """The rounds from the leaves up, and `g, slot, top`, one row a group."""
    size, rounds = fanout ** _levels(fanout), []
    while True:
        done = steps.freeze(_block_round(nodes, fanout), f"{name}-{len(rounds)}")
        rounds.append(done)
        tops = done.filter(F.col("slot") % size == 0)
        more = (tops.agg(F.max("n")).scalar() > size).alias("more")
        if not done.sparkSession.range(1).select(more).first()[0]:
            return rounds, tops.select("g", F.col("block").alias("slot"), "top")
        nodes = tops.select("g", F.col("block").alias("slot"), F.ceil(F.col("n") / size).alias("n"), F.col("top").alias("node"))


def _down(rounds: list[DataFrame], above: DataFrame, taken: Sequence[str]) -> DataFrame:
    """The leaves with their whole `path`; `above` has `g, slot, path` and `taken`, one row a group."""
    def below(above: DataFrame, rows: DataFrame) -> DataFrame:
        up = above.select("g", F.col("slot").alias("block"), F.col("path").alias("rest"), *taken)
        return rows.join(up, ["g", "block"]).withColumn("path", F.concat("path", "rest")).drop("rest", "block", "top")

    return reduce(below, reversed(rounds), above)


def manifest(
    docs: DataFrame,
    columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    id_col: str = "doc_id",
    group_col: str = "lang",
    fanout: int = 2,
    claims: dict[str, Column] | None = None,
) -> DataFrame:
    """`doc_id, leaf, path, subroot, root` and the `claims`, one row for every row of `docs`.

    `path` lists `left, right` for each level from the leaf to the root: the digests of the other nodes
    of the run, in a row. `claims` are columns computed from the row, such as the leaf of another
    version of it, to be held against the root by `fold`. Leaves ascend by id, null first, rows that
    share an id by their leaf; equal rows are leaves of their own. Groups stand as text in the order
    of their bytes, null first, and an empty text is a group. A null or empty column has its own code
    in the leaf, see `field`. A table without rows has no manifest. `docs` is read once; of long
    texts only the digest goes on, and other columns are not read.
    """
    claims = claims or {}
    kind = docs.schema[id_col].dataType
    with Steps(docs.sparkSession) as steps:
        leaves = docs.select(
            F.col(id_col).cast(kind).alias("doc_id"),
            _group_key(F.col(group_col)).alias("g"),
            leaf_digest(columns).alias("node"),
            F.struct(*[c.alias(n) for n, c in claims.items()], F.lit(0).alias("_")).alias("claims"),
            F.monotonically_increasing_id().alias("tie"),
        )
        leaves = steps.freeze(leaves, "leaves")
        keyed = leaves.withColumns({"by_id": F.col("doc_id"), "by_leaf": F.col("node")})
        placed = _placed(keyed, ["by_id", "by_leaf", "tie"], steps, "leaves")
        rounds, subroots = _rounds(placed, fanout, steps, "level")
        groups = subroots.select(F.lit("").alias("g"), F.col("g").alias("group"), F.col("top").alias("node"))
        groups = _placed(groups.withColumn("by_group", F.col("group")), ["by_group"], steps, "groups")
        top_rounds, roots = _rounds(groups, fanout, steps, "top")
        none = F.array().cast("array<struct<left:string,right:string>>")
        roots = roots.select("g", "slot", none.alias("path"), F.col("top").alias("root"))
        proved = _down(top_rounds, roots, ["root"])
        above = proved.select(
            F.col("group").alias("g"), F.lit(0).cast("bigint").alias("slot"), "path", F.col("node").alias("subroot"), "root"
        )
        found = _down(rounds, above, ["subroot", "root"])
        return freeze(
            found.select(
                "doc_id", F.col("node").alias("leaf"), "path", "subroot", "root", *[F.col("claims")[n].alias(n) for n in claims]
            ),
            "manifest",
        )


def proof_digest(path: Column) -> Column:
    """Digest of all siblings of a path, level by level, left to right."""
    return digest(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""))


def verify(rows: DataFrame, claimed: str = "leaf") -> DataFrame:
    """Adds `folded_root`, what the leaf in `claimed` leads to, and `verified`, whether that is the root."""
    folded = rows.withColumn("folded_root", fold(F.col(claimed), F.col("path")))
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))
