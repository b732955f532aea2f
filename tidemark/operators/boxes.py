"""Expressions and filters over bounding boxes (xmin, ymin, xmax, ymax)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def at_least(df: DataFrame, threshold: float) -> DataFrame:
    """Rows with confidence >= threshold (detectors)."""
    return df.where(F.col("confidence") >= threshold)


def above(df: DataFrame, threshold: float) -> DataFrame:
    """Rows with confidence > threshold (summaries)."""
    return df.where(F.col("confidence") > threshold)


def inside(width: float = 2688, height: float = 1520, margin: float = 50) -> Column:
    """Whether a box keeps `margin` pixels from every border."""
    return (F.col("xmin") >= margin) & (F.col("xmax") <= width - margin) & (F.col("ymin") >= margin) & (F.col("ymax") <= height - margin)


def drop_edge(df: DataFrame, width: float = 2688, height: float = 1520, margin: float = 50) -> DataFrame:
    """Boxes that keep `margin` pixels from every border."""
    return df.where(inside(width, height, margin))


def only_edge(df: DataFrame, width: float = 2688, height: float = 1520, margin: float = 50) -> DataFrame:
    """The other boxes; rows with a missing side are in neither."""
    return df.where(~inside(width, height, margin))


def area() -> Column:
    return F.greatest(F.lit(0.0), (F.col("xmax") - F.col("xmin")) * (F.col("ymax") - F.col("ymin")))


def center_x() -> Column:
    return (F.col("xmin") + F.col("xmax")) / 2


def center_y() -> Column:
    return (F.col("ymin") + F.col("ymax")) / 2


def iou(a: str, b: str, epsilon: float = 0.0) -> Column:
    """Intersection over union of two box structs; 0 if disjoint or the union is
    not positive. `epsilon` is added to the denominator."""
    a_, b_ = F.col(a), F.col(b)
    w = F.greatest(F.lit(0.0), F.least(a_.xmax, b_.xmax) - F.greatest(a_.xmin, b_.xmin))
    h = F.greatest(F.lit(0.0), F.least(a_.ymax, b_.ymax) - F.greatest(a_.ymin, b_.ymin))
    size = lambda x: (x.xmax - x.xmin) * (x.ymax - x.ymin)
    union = size(a_) + size(b_) - w * h
    return F.when(union + epsilon > 0, w * h / (union + epsilon)).otherwise(0.0)


def from_center(df: DataFrame, width: float, height: float) -> DataFrame:
    """Corner boxes from cx, cy, w, h, clamped to the frame."""
    clamp = lambda x, top: F.greatest(F.lit(0.0), F.least(x, F.lit(float(top))))
    half_w, half_h = F.col("w") / 2, F.col("h") / 2
    return df.withColumns({"xmin": clamp(F.col("cx") - half_w, width), "ymin": clamp(F.col("cy") - half_h, height), "xmax": clamp(F.col("cx") + half_w, width), "ymax": clamp(F.col("cy") + half_h, height)})


def normalized(df: DataFrame, width: float, height: float) -> DataFrame:
    """nx, ny, nw, nh in parts of the frame, from clamped and ordered corners;
    a box without extent raises."""
    clamp = lambda c, top: F.greatest(F.lit(0.0), F.least(F.col(c), F.lit(float(top))))
    x1, x2, y1, y2 = clamp("xmin", width), clamp("xmax", width), clamp("ymin", height), clamp("ymax", height)
    x1, x2, y1, y2 = F.least(x1, x2), F.greatest(x1, x2), F.least(y1, y2), F.greatest(y1, y2)
    good = lambda v: F.when((x2 > x1) & (y2 > y1), v).otherwise(F.raise_error(F.lit("box without extent")).cast("double"))
    return df.withColumns({"nx": good((x1 + x2) / 2 / width), "ny": good((y1 + y2) / 2 / height), "nw": good((x2 - x1) / width), "nh": good((y2 - y1) / height)})


def class_threshold(df: DataFrame, thresholds: dict[str, float], default: float = 0.3) -> DataFrame:
    """Rows that reach the threshold of their class."""
    table = F.create_map(*(F.lit(x) for kv in thresholds.items() for x in kv)) if thresholds else None
    limit = F.coalesce(table[F.col("class")], F.lit(default)) if thresholds else F.lit(default)
    return df.where(F.col("confidence") >= limit)


def suppress(df: DataFrame, group: list[str], limit: float = 0.5, strictly_above: float | None = None, tie: str = "event_id", epsilon: float = 1e-8) -> DataFrame:
    """Greedy non-maximum suppression: within a group, by falling confidence
    (ties: smaller `tie`), a box stays if its IoU with each kept one is at most
    `limit`; `epsilon` is added to the union. Groups are frames (and classes) and
    so of bounded size; each kept box is compared with all that are left at once."""
    if strictly_above is not None:
        df = above(df, strictly_above)
    columns = [*group, tie, "confidence", "xmin", "ymin", "xmax", "ymax"]
    df = df.select(*group, tie, *(F.col(c).cast("double").alias(c) for c in columns[len(group) + 1 :]))

    def keep(table: pa.Table) -> pa.Table:
        table = table.sort_by([("confidence", "descending"), (tie, "ascending")])
        x1, y1, x2, y2 = (table.column(c).to_numpy() for c in columns[-4:])
        size = (x2 - x1) * (y2 - y1)
        left, kept = np.arange(table.num_rows), []
        while len(left):
            k, left = left[0], left[1:]
            kept.append(k)
            both = np.maximum(0, np.minimum(x2[k], x2[left]) - np.maximum(x1[k], x1[left])) * np.maximum(0, np.minimum(y2[k], y2[left]) - np.maximum(y1[k], y1[left]))
            left = left[both / (size[k] + size[left] - both + epsilon) <= limit]
        return table.take(pa.array(kept, pa.int64()))

    return df.groupBy(*group).applyInArrow(keep, df.schema)
