"""Frames as grids of cells: embeddings, heat maps, outlier scores, adaptive cells."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.operators import boxes
from tidemark.operators.lookup import cell_of_grid


def frame_size(df: DataFrame) -> DataFrame:
    """Width and height that leave a margin of 5 % beyond all boxes."""
    return df.agg(F.ceil(F.max("xmax") * 1.05).alias("width"), F.ceil(F.max("ymax") * 1.05).alias("height"))


def embed(df: DataFrame, classes, size: float, columns: int) -> DataFrame:
    """Per frame and uniform cell: count of each class, summed area and mean
    confidence over all classes (f0, f1, ...); only frames and cells that occur."""
    cell = cell_of_grid(boxes.center_x(), boxes.center_y(), size, columns)
    return _features(df.withColumn("cell", cell), classes)


def embed_adaptive(df: DataFrame, cells: DataFrame, classes) -> DataFrame:
    """The same over cells of an adaptive grid; boxes outside all cells are left out."""
    from tidemark.operators.lookup import first_cell

    at = first_cell(df.select(F.col("event_id").alias("point_id"), boxes.center_x().alias("x"), boxes.center_y().alias("y")), cells)
    return _features(df.join(at.withColumnRenamed("point_id", "event_id"), "event_id").withColumnRenamed("cell_id", "cell"), classes)


def _features(df: DataFrame, classes) -> DataFrame:
    counts = [F.count_if(F.col("class") == c).alias(f"f{i}") for i, c in enumerate(classes)]
    n = len(classes)
    return df.groupBy("video_id", "frame", "cell").agg(*counts, F.sum(boxes.area()).alias(f"f{n}"), F.avg("confidence").alias(f"f{n + 1}"))


def heat_map(embedding: DataFrame, channel: str = "f0") -> DataFrame:
    """Mean of a channel per cell over all frames of the video."""
    frames = embedding.groupBy("video_id").agg(F.count_distinct("frame").alias("k"))
    return embedding.groupBy("video_id", "cell").agg(F.sum(channel).alias("s")).join(frames, "video_id").select("video_id", "cell", (F.col("s") / F.col("k")).alias("heat"))


def smooth(embedding: DataFrame, channel: str, frames: int) -> DataFrame:
    """Trailing mean of a cell's channel over the frames in which it occurs."""
    w = W.partitionBy("video_id", "cell").orderBy("frame").rowsBetween(-(frames - 1), 0)
    return embedding.withColumn(channel, F.avg(channel).over(w))


#: Rows of a key that one Python call scores.
CHUNK = 2048


def mahalanobis(df: DataFrame, key: str, order: str, vector: str, history: int) -> DataFrame:
    """Distance of each vector from the `history` ones before it, in their
    covariance (+ 1e-6 on the diagonal); null with fewer than two before it.

    A key's rows are cut into chunks in order; each also gets the last `history`
    rows of the one before, so keys of any size are spread.
    """
    at = F.row_number().over(W.partitionBy(key).orderBy(order)) - 1
    rows = df.select(F.col(key).alias("_key"), F.col(order).alias("_order"), F.col(vector).cast("array<double>").alias("_v"), at.cast("bigint").alias("_at"))
    own = F.floor(F.col("_at") / CHUNK)
    chunks = F.when((F.col("_at") % CHUNK >= CHUNK - history), F.array(own, own + 1)).otherwise(F.array(own))
    rows = rows.withColumn("_chunk", F.explode(chunks))
    kinds = dict(rows.dtypes)

    def score(table: pa.Table) -> pa.Table:
        table = table.sort_by("_at")
        at, chunk = table.column("_at").to_numpy(), table.column("_chunk")[0].as_py()
        x = np.stack(table.column("_v").to_pylist()).astype(float)
        mine = np.flatnonzero(at // CHUNK == chunk)
        out, ridge = np.full(len(mine), np.nan), 1e-6 * np.eye(x.shape[1])
        past = np.minimum(at[mine], history)
        for n in np.unique(past[past >= 2]).tolist():  # rows with equally long histories, some at a time
            for part in np.array_split(np.flatnonzero(past == n), -(-int((past == n).sum()) * x.shape[1] ** 2 // (1 << 21)) or 1):
                rows_ = mine[part]
                before = x[rows_[:, None] - np.arange(n, 0, -1)]
                mean = before.mean(axis=1)
                off, spread = x[rows_] - mean, before - mean[:, None]
                cov = spread.transpose(0, 2, 1) @ spread / (n - 1) + ridge
                out[part] = np.sqrt(np.maximum((off * np.linalg.solve(cov, off[:, :, None])[:, :, 0]).sum(axis=1), 0))
        own_rows = table.take(pa.array(mine))
        return pa.table({key: own_rows.column("_key"), order: own_rows.column("_order"), "score": pa.array(out, mask=np.isnan(out))})

    return rows.groupBy("_key", "_chunk").applyInArrow(score, f"{key} {kinds['_key']}, {order} {kinds['_order']}, score double")


def adaptive_cells(points: np.ndarray, width: float, height: float, cells: int = 100, smallest: float = 40.0, aspect: float = 4.0, fewest: int = 2) -> list[tuple]:
    """Split the fullest cell at the median of its longer side until there are
    enough cells or a split breaks a rule. points: a bounded sample, on the driver."""
    grid = [(0.0, 0.0, float(width), float(height), points)]
    while len(grid) < cells:
        grid.sort(key=lambda c: -len(c[4]))
        x1, y1, x2, y2, own = grid[0]
        axis = 0 if x2 - x1 >= y2 - y1 else 1
        if len(own) < 2 * fewest:
            break
        cut = float(np.median(own[:, axis]))
        a, b = own[own[:, axis] < cut], own[own[:, axis] >= cut]
        halves = [(x1, y1, cut, y2, a), (cut, y1, x2, y2, b)] if axis == 0 else [(x1, y1, x2, cut, a), (x1, cut, x2, y2, b)]
        if any(min(c[2] - c[0], c[3] - c[1]) < smallest or max(c[2] - c[0], c[3] - c[1]) > aspect * min(c[2] - c[0], c[3] - c[1]) or len(c[4]) < fewest for c in halves):
            break
        grid[0:1] = halves
    return [(i, c[0], c[1], c[2], c[3], len(c[4])) for i, c in enumerate(sorted(grid, key=lambda c: (c[1], c[0])))]


def principal_components(df: DataFrame, vector: str, k: int) -> DataFrame:
    """PCA scores of array columns (column pca), each component's sign fixed so
    that its largest loading is positive."""
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector, vector_to_array

    v = df.withColumn("_v", array_to_vector(F.col(vector).cast("array<double>")))
    model = PCA(k=k, inputCol="_v", outputCol="_p").fit(v)
    loads = model.pc.toArray()
    signs = [float(np.sign(loads[np.abs(loads[:, j]).argmax(), j]) or 1) for j in range(k)]
    scores = vector_to_array("_p")
    return model.transform(v).withColumn("pca", F.array(*(scores[j] * signs[j] for j in range(k)))).drop("_v", "_p")
