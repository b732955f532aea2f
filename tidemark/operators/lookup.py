"""Joins: intervals, calendars, cells, existence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def containing(points: DataFrame, spans: DataFrame, keys: list[str], at: str, start: str, end: str, order: str) -> DataFrame:
    """Each point with the first span (by `order`) of its key that holds it, ends
    exclusive; points without one are dropped. The equi keys bound the join.
    `points` needs a column point_id."""
    p, s = points.alias("p"), spans.alias("s")
    on = [F.col(f"p.{k}") == F.col(f"s.{k}") for k in keys] + [F.col(f"p.{at}") >= F.col(f"s.{start}"), F.col(f"p.{at}") < F.col(f"s.{end}")]
    hit = p.join(s, on).select("p.*", F.col(f"s.{order}").alias("span"))
    return hit.groupBy("point_id").agg(F.min("span").alias("span"))


def cell_of_grid(x: Column, y: Column, size: float, columns: int) -> Column:
    """Number of a uniform cell, by arithmetic instead of a spatial join."""
    return (F.floor(y / size) * columns + F.floor(x / size)).cast("bigint")


def first_cell(points: DataFrame, cells: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    """The first cell (half-open) that holds each point. An adaptive grid has some
    hundreds of cells, so it is broadcast; `points` needs point_id."""
    hit = points.join(F.broadcast(cells), (F.col(x) >= F.col("cell_xmin")) & (F.col(x) < F.col("cell_xmax")) & (F.col(y) >= F.col("cell_ymin")) & (F.col(y) < F.col("cell_ymax")))
    return hit.groupBy("point_id").agg(F.min("cell_id").alias("cell_id"))


def calendar(start: Column, end: Column) -> Column:
    """All dates between two, both included."""
    return F.explode(F.sequence(start, end, F.expr("interval 1 day")))


def first_per_key(df: DataFrame, keys: list[str], *order) -> DataFrame:
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def near_duplicates(df: DataFrame, vector: str, order: str, limit: float, partition: Column | None = None) -> DataFrame:
    """Rows whose vector is at least `limit` from their predecessor's (not from the last kept one)."""
    w = (W.partitionBy(partition) if partition is not None else W.partitionBy(F.lit(0))).orderBy(order)
    before = F.lag(vector).over(w)
    far = F.sqrt(F.aggregate(F.zip_with(vector, before, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, v: s + v))
    return df.withColumn("_far", far).where("_far is null or _far >= %r" % limit).drop("_far")


def by_content(df: DataFrame, content: str, order: str) -> DataFrame:
    """First row per SHA-1 of the content, with the number of rows that had it."""
    hashed = df.withColumn("digest", F.sha1(F.col(content).cast("binary")))
    return hashed.groupBy("digest").agg(F.min(order).alias(order), F.count("*").alias("copies"))
