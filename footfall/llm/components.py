"""Connected components by alternating large-star and small-star steps.

(Kiveris et al., Connected Components in MapReduce and Beyond, 2014.) Each step is one
minimum per node, combined in the map tasks, and one join back to the edges, whose edge side
Spark splits at a node with very many neighbours. Nothing is collected.
"""

from pyspark.sql import DataFrame, functions as F

from footfall.llm.tables import hand_over, light


def _both(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("u"), F.col("v")).unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame, rows: int) -> DataFrame:
    both = _both(edges)
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(light(low, 2 * rows), "u").where("v > u AND v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame, rows: int) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(light(low, rows), "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(low.select("u", F.col("m").alias("v"))).distinct()


def _open_ends(edges: DataFrame) -> DataFrame:
    """Nodes that keep the edges from being stars: below two centres, or a centre below another."""
    leaf = edges.select(F.col("u").alias("node"), F.lit(1).alias("below"), F.lit(0).alias("above"))
    centre = edges.select(F.col("v").alias("node"), F.lit(0).alias("below"), F.lit(1).alias("above"))
    ends = leaf.unionByName(centre).groupBy("node").agg(F.sum("below").alias("below"), F.max("above").alias("above"))
    return ends.where("below > 1 OR below = 1 AND above = 1")


def components(edges: DataFrame, rows: int | None = None, max_steps: int = 60) -> DataFrame:
    """(node, label) for every node of `edges` (u, v: bigint): label is the smallest node that
    can be reached. Ends when the edges are stars, which is seen without a further step. `rows`
    saves the count where no more edges than that are known to be there."""
    current = edges.where("u <> v")
    if rows is None:
        rows = current.count()
    # no step adds edges; a step's minima are broadcast while they are few
    for _ in range(max_steps):
        current = hand_over(_small_star(_large_star(current, rows), rows), "components")
        if _open_ends(current).isEmpty():
            break
    else:
        raise RuntimeError(f"components did not settle in {max_steps} steps")
    heads = current.select(F.col("v").alias("node")).distinct().withColumn("label", F.col("node"))
    return current.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(heads)
