"""Checkpoints, and connected components of a link table, entirely as Spark joins and aggregates."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def ready_to_checkpoint(spark: SparkSession) -> None:
    """Uses the folder of spark.checkpoint.dir. A session without one gets a folder of its own if it is local, where
    driver and executors share the disk; on a cluster it is an error."""
    sc = spark.sparkContext
    if sc.getConf().get("spark.checkpoint.dir") or sc._jsc.sc().getCheckpointDir().isDefined():
        return
    if not sc._jsc.sc().isLocal():
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="leadloom-checkpoint-"))


def cut(df: DataFrame) -> DataFrame:
    """The rows of df with their lineage cut by a reliable checkpoint."""
    ready_to_checkpoint(df.sparkSession)
    return df.checkpoint()


def connected_components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of links(u, v) but the roots; root is the smallest node of the component.

    Alternates large-star and small-star rounds (Kiveris et al., 2014): each round replaces a node's links by links to
    its smallest neighbour, never adds links, and ends when no link changes, with every node linked to its root alone.
    Every round's table is checkpointed. Null ends and self links are dropped; no links give no rows."""
    pair = F.struct(F.greatest("u", "v").alias("hi"), F.least("u", "v").alias("lo"))
    e = cut(links.where("u is not null and v is not null and u <> v").select(pair.alias("p")).select("p.*").distinct())
    last = None
    for _ in range(most_rounds):
        state = e.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if state == last or state[0] == 0:
            return e.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
        last = state
        both = e.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(e.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).where("hi <> lo").distinct()
        down = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(down, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        e = cut(small.unionByName(down.select("hi", F.col("m").alias("lo"))).distinct())
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
