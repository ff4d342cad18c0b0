"""Connected components of an edge table, by smallest labels and pointer jumping."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def cut(df: DataFrame) -> DataFrame:
    """Rows written to the shared checkpoint folder (``spark.checkpoint.dir``), with the lineage cut there.

    Where that is unset, a local folder does for a local master only; on a cluster its absence is an error.
    """
    spark = df.sparkSession
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)


def shared_folder(spark: SparkSession) -> str:
    shared = spark.conf.get("spark.checkpoint.dir", "")
    if not shared and not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return shared or tempfile.mkdtemp(prefix="checkpoints-")


def edge_components(edges: DataFrame) -> DataFrame:
    """node, component (the smallest node that edges (a, b) reach) of every node of an edge.

    A round takes the smallest label around and gives it to the node that was the label before as well, then takes that
    label's label; so whole regions move with their roots, and rounds grow with the logarithm of the longest path. Labels
    only fall, so rounds go on until none does. They are checkpointed each round; only counts come to the driver.
    """
    e = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).where("u <> v")
    ends = e.select(F.explode(F.array("u", "v")).alias("u"))
    both = cut(e.union(e.select("v", "u")).union(ends.select("u", F.col("u").alias("v"))).distinct())
    labels, moved = cut(both.groupBy("u").agg(F.min("v").alias("l"))), 1
    while moved:
        # a node is its own neighbour, which brings its label along
        seen = both.join(labels.select(F.col("u").alias("v"), "l"), "v").groupBy("u").agg(F.min("l").alias("m"), F.max(F.when(F.col("u") == F.col("v"), F.col("l"))).alias("l"))
        offers = seen.select("u", "m", "l").union(seen.select("l", "m", F.lit(None)))
        low = cut(offers.groupBy("u").agg(F.min("m").alias("m"), F.max("l").alias("l")))
        after = cut(low.join(low.select(F.col("u").alias("m"), F.col("m").alias("j")), "m").select("u", F.least("m", "j").alias("n"), "l"))
        moved = after.where("n < l").limit(1).count()
        labels = after.select("u", F.col("n").alias("l"))
    return labels.select(F.col("u").alias("node"), F.col("l").alias("component"))


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """node, component for every row of nodes (node); one without an edge is its own."""
    return nodes.join(edge_components(edges), "node", "left").withColumn("component", F.coalesce("component", "node"))
