"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import shared_dir

#: A node's minimum is copied this often, so that edges of one hub can be dealt out.
SALTS = 8


def _with_minimum(edges: DataFrame, include_self: bool) -> DataFrame:
    """Add to (u, v) the smallest node `m` among u's neighbours (and u)."""
    lows = edges.groupBy("u").agg(F.min("v").alias("_v")).select("u", (F.least("_v", "u") if include_self else F.col("_v")).alias("m"))
    lows = lows.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = edges.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int"))
    return salted.join(lows, ["u", "salt"]).drop("salt")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of `edges` (columns u, v; long).

    The component is its smallest node. Alternating large-star and small-star
    rounds until nothing changes; each result is checkpointed to the shared
    folder. Null ends and loops are ignored, repeated edges count once, an empty
    table gives none.
    """
    spark = edges.sparkSession
    shared_dir(spark)
    edges = edges.where("u is not null and v is not null and u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges, before = edges.checkpoint(), None
    while True:
        # large star: every neighbour above u links to the smallest around u
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        edges = _with_minimum(both, True).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: u and its smaller neighbours link to the smallest of them
        star = _with_minimum(edges, False)
        edges = star.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v").where("u <> v").distinct()
        edges = edges.checkpoint()
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if now == before:
            break
        before = now
    ends = edges.groupBy("u").agg(F.min("v").alias("component")).select(F.col("u").alias("node"), "component")
    return ends.union(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
