"""Selections that depend on what was selected before: walks over a key's candidates."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def jump_select(df: DataFrame, key: str, at: str, resume: str, *payload: str) -> DataFrame:
    """Leftmost candidates per key: in order of `at`, one is taken if it does not
    lie before the resume point of the one taken last. Only candidates are
    gathered, per key, and only taken ones are walked over."""
    columns = [at, resume, *payload]
    df = df.select(key, F.col(at).cast("bigint").alias(at), F.col(resume).cast("bigint").alias(resume), *payload)

    def walk(table: pa.Table) -> pa.Table:
        table = table.sort_by([(c, "ascending") for c in columns])
        start, follows = table.column(at).to_numpy(), table.column(resume).to_numpy()
        after = np.maximum(np.searchsorted(start, follows), np.arange(1, len(start) + 1)).tolist()
        taken, k = [], 0
        while k < len(after):
            taken.append(k)
            k = after[k]
        return table.take(pa.array(taken, pa.int64()))

    return df.groupBy(key).applyInArrow(walk, df.schema)


def match_nearest(truth: DataFrame, found: DataFrame, tolerance: int) -> DataFrame:
    """One-to-one matches within a file: truth rows in order take the nearest
    unused found row of their type within `tolerance` (ties: lowest number).

    truth: file, truth_no, type, second; found: file, found_no, type, second.
    Returns file, truth_no, found_no, offset.
    """
    near = truth.alias("t").join(found.alias("f"), (F.col("t.file") == F.col("f.file")) & (F.col("t.type") == F.col("f.type")) & (F.abs(F.col("t.second") - F.col("f.second")) <= tolerance))
    near = near.select(F.col("t.file").alias("file"), F.col("t.truth_no").alias("truth_no"), F.col("f.found_no").alias("found_no"), (F.col("f.second") - F.col("t.second")).alias("offset"))

    def take(table: pa.Table) -> pa.Table:
        table = table.append_column("_far", pc.abs(table.column("offset"))).sort_by([("truth_no", "ascending"), ("_far", "ascending"), ("found_no", "ascending")])
        truths, used, taken = set(), set(), []
        for k, (t, f) in enumerate(zip(table.column("truth_no").to_pylist(), table.column("found_no").to_pylist())):
            if t not in truths and f not in used:
                truths.add(t)
                used.add(f)
                taken.append(k)
        return table.drop_columns(["_far"]).take(pa.array(taken, pa.int64()))

    return near.groupBy("file").applyInArrow(take, near.schema)


def match_loosely(truth: DataFrame, found: DataFrame, tolerance: int) -> DataFrame:
    """Found rows with the first truth of any type within `tolerance`; truths may repeat."""
    near = found.alias("f").join(truth.alias("t"), (F.col("t.file") == F.col("f.file")) & (F.abs(F.col("t.second") - F.col("f.second")) <= tolerance), "left")
    return near.groupBy(F.col("f.file").alias("file"), "found_no").agg(F.min("truth_no").alias("truth_no"))
