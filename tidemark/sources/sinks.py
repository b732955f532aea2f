"""Writers: partitioned tables, idempotent upserts, labels, manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def write_daily(df: DataFrame, path: str) -> None:
    """A table by station and date; only the partitions in `df` are replaced."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("station", "date").parquet(path)


def write_results(tables: dict[str, DataFrame], path: str, as_csv: bool = False) -> None:
    """Result tables side by side (events, flaps, per_second, movement, per_minute)."""
    for name, df in tables.items():
        writer = df.write.mode("overwrite")
        writer.option("header", True).csv(f"{path}/{name}") if as_csv else writer.parquet(f"{path}/{name}")


def upsert(old: DataFrame, new: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """`old` with the rows of `new` in place of those with equal keys; of several
    new rows with one key the last by `order` counts. Missing columns are null."""
    both = old.withColumn("_src", F.lit(0)).unionByName(new.withColumn("_src", F.lit(1)), allowMissingColumns=True)
    w = W.partitionBy(*keys).orderBy(F.desc("_src"), *(F.desc(c) for c in order or []))
    return both.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n", "_src")


def register(old: DataFrame, new: DataFrame, keys: list[str], keep: list[str]) -> DataFrame:
    """Insert or update, but `keep` columns of known rows stay as they are."""
    cols = [c for c in old.columns if c not in keys]
    joined = old.alias("o").join(new.alias("n"), keys, "full")
    pick = lambda c: F.coalesce(F.col(f"o.{c}"), F.col(f"n.{c}")) if c in keep or c not in new.columns else F.coalesce(F.col(f"n.{c}"), F.col(f"o.{c}"))
    return joined.select(*keys, *((pick(c) if c in new.columns else F.col(f"o.{c}")).alias(c) for c in cols))


def pending(inputs: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Inputs that the ledger of outputs does not have: the idempotent sink's work list."""
    return inputs.join(done, keys, "left_anti")


def label_lines(df: DataFrame) -> DataFrame:
    """image and the text of its label file, `class cx cy w h` with six decimals."""
    line = F.format_string("%d %.6f %.6f %.6f %.6f", "class_id", "nx", "ny", "nw", "nh")
    return df.groupBy("image").agg(F.array_join(F.sort_array(F.collect_list(F.struct("box_no", line.alias("line"))))["line"], "\n").alias("text"))


def manifest(df: DataFrame, category: str) -> DataFrame:
    """Rows per category, with the total in a row of null."""
    return df.rollup(category).agg(F.count("*").alias("n"))


def report(df: DataFrame, metrics: dict) -> DataFrame:
    """One row per metric: a text report as a table."""
    one = df.agg(*(e.cast("string").alias(k) for k, e in metrics.items()))
    return one.unpivot([], list(metrics), "metric", "value")


def set_state(state: DataFrame, key: str, value, at) -> DataFrame:
    """Key-value state with JSON values."""
    new = state.sparkSession.range(1).select(F.lit(key).alias("key"), F.to_json(F.struct(F.lit(value).alias("value"))).alias("value"), F.lit(at).alias("updated_at"))
    return upsert(state, new, ["key"])


def embedding_columns(df: DataFrame, rows: int, cols: int, channels: int) -> DataFrame:
    """A frame's flattened grid as columns cell_r_c_k."""
    names = [f"cell_{r}_{c}_{k}" for r in range(rows) for c in range(cols) for k in range(channels)]
    return df.select("frame", *(F.col("values")[i].alias(n) for i, n in enumerate(names)))


def append(df: DataFrame, path: str) -> None:
    """Add rows to a table; what is there stays."""
    df.write.mode("append").parquet(path)
