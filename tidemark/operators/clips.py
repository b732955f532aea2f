"""Which events get a clip, and from when to when."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def worth_a_clip(events: DataFrame, types=(), fish_only: bool = False) -> DataFrame:
    """Events of some types, with `fish_only` arrivals with fish, that have a
    timestamp or a second."""
    if types:
        events = events.where(F.col("type").isin(*types))
    if fish_only:
        events = events.where((F.col("type") == "arrival") & F.coalesce(F.col("arrival_with_fish"), F.lit(False)))
    return events.where(F.col("timestamp").isNotNull() | F.col("second").isNotNull())


def is_target(kind: Column, types, flag: Column, fish_count: Column) -> Column:
    """An event to index: of the types, and if an arrival, with the flag or a fish counted."""
    fish = F.coalesce(flag, F.lit(False)) | (F.coalesce(fish_count, F.lit(0)) > 0)
    return F.coalesce(kind.isin(*types) & ((kind != "arrival") | fish), F.lit(False))


def window(df: DataFrame, offset: Column, duration: Column, before: float, after: float) -> DataFrame:
    """clip_start and clip_end within the video (an unknown duration does not cut),
    and in clip_status why there is none: failed_offset, failed_negative_offset
    or failed_window; both are null then."""
    start = F.greatest(F.lit(0.0), offset - before)
    end = F.least(offset + after, duration)
    status = F.when(offset.isNull(), "failed_offset").when(offset < 0, "failed_negative_offset").when(end - start <= 0, "failed_window").otherwise("ok")
    ok = status == "ok"
    return df.withColumns({"clip_start": F.when(ok, start), "clip_end": F.when(ok, end), "clip_status": status})
