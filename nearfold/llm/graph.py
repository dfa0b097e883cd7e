"""Connected components by alternating stars.

Links first meet in parts of bounded size, where a union of sets turns each part into stars. Where
all links are one part, that is the answer.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearfold.session import Steps, freeze


PART_LINKS = 500_000


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each node of this part's links `u, v` with the smallest node that the part links it to."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        top = x
        while (up := root.setdefault(top, top)) != top:
            top = up
        while root[x] != top:
            root[x], x = top, root[x]
        return top

    for batch in batches:
        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            u, v = find(u), find(v)
            if u != v:
                root[max(u, v)] = min(u, v)
    nodes = [x for x in root if find(x) != x]
    for k in range(0, len(nodes), 1 << 16):
        part = nodes[k : k + (1 << 16)]
        columns = [pa.array(part, pa.int64()), pa.array([find(x) for x in part], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["u", "v"])


def components(links: DataFrame) -> DataFrame:
    """`node, component` for every node of the links `a, b` (bigint); component is its smallest node.

    A large star ties all greater neighbours of a node to its smallest one, a small star all others.
    Each keeps the components and flattens them, so a few rounds end in stars. Rounds are joins and
    sums over the links; nothing is collected but two numbers. Self links and repeats are harmless,
    null ends are left out.
    """
    spark = links.sparkSession
    ends = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    with Steps(spark) as steps:
        pairs = steps.freeze(ends.filter("u <> v"), "links")
        parts = -(-pairs.count() // PART_LINKS)
        spread = pairs.coalesce(1) if parts == 1 else pairs.repartition(max(parts, 1), "u", "v")
        pairs = steps.freeze(spread.mapInArrow(_stars, "u bigint, v bigint"), "stars")
        before, turn = None, 0
        while parts > 1:
            now = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % (1 << 31))).first()
            if now == before or not now[0]:
                break
            before, turn = now, turn + 1
            pairs = steps.freeze(_small_star(_large_star(pairs)), f"round-{turn}")
        leaves = pairs.select(F.col("u").alias("node"), F.col("v").alias("component"))
        roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("component"))
        return freeze(leaves.unionByName(roots).distinct(), "components")


def _large_star(pairs: DataFrame) -> DataFrame:
    both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    tied = both.filter("v > u").join(least, "u")
    return tied.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(pairs: DataFrame) -> DataFrame:
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    tied = pairs.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
