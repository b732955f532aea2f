"""Readers of the file formats that detections and annotations come in.

All columns are read as strings and converted with try_ functions, so a bad
value becomes null and its row can be dropped or audited instead of failing.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.functions import names
from tidemark.operators import boxes

BOX = ("frame", "class", "confidence", "xmin", "ymin", "xmax", "ymax")


def _strings(columns) -> StructType:
    return StructType([StructField(c, StringType()) for c in columns])


def read_detections(spark: SparkSession, path: str, threshold: float = 0.25, edge: bool = False, width: float = 2688, height: float = 1520, margin: float = 50, parquet: bool = False) -> DataFrame:
    """Boxes of many files, one per video: video_id, station, start_time and the
    box columns; rows that miss a value or the threshold are dropped.

    Land CSV once as Parquet (`parquet=True` reads that): the filters then reach
    the scan.
    """
    if parquet:
        df = spark.read.parquet(path)
    else:
        raw = spark.read.option("header", True).option("enforceSchema", False).option("recursiveFileLookup", True).schema(_strings(BOX)).csv(path)
        stem = F.regexp_extract(F.input_file_name(), r"([^/]+?)(?:_raw)?\.[^./]+$", 1)
        df = raw.select(stem.alias("video_id"), names.station_of(stem).alias("station"), names.start_time(stem).alias("start_time"), F.expr("cast(try_cast(frame as double) as bigint)").alias("frame"), "class", *(F.expr(f"try_cast({c} as double)").alias(c) for c in BOX[2:]))
    df = boxes.at_least(df.dropna(subset=list(BOX)), threshold)
    return boxes.drop_edge(df, width, height, margin) if edge else df


def rejected(spark: SparkSession, path: str) -> DataFrame:
    """Lines of detection files that do not convert, with their file."""
    raw = spark.read.option("header", True).schema(_strings(BOX)).csv(path).withColumn("file", F.input_file_name())
    return raw.where(" or ".join(f"try_cast({c} as double) is null" for c in BOX if c != "class") + " or class is null")


def read_legacy(spark: SparkSession, path: str) -> DataFrame:
    """The older layout with epoch seconds: class, conf, time, frame, station, filename, datetime."""
    raw = spark.read.option("header", True).csv(path)
    return raw.selectExpr("try_cast(class as int) class", "try_cast(conf as double) conf", "try_cast(time as double) time", "try_cast(frame as bigint) frame", "station", "filename", "coalesce(try_to_timestamp(datetime), timestamp_millis(cast(try_cast(time as double) * 1000 as bigint))) datetime")


def list_files(spark: SparkSession, path: str, glob: str = "*", include=(), exclude=("@eaDir",), recursive: bool = True) -> DataFrame:
    """path, modified and stem of files, by glob and regular expressions (any of
    `include`, none of `exclude`); contents are not read."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", recursive).load(path).select("path", F.col("modificationTime").alias("modified"))
    if include:
        found = found.where(reduce(or_, (F.col("path").rlike(rx) for rx in include)))
    for rx in exclude:
        found = found.where(~F.col("path").rlike(rx))
    return found.withColumn("stem", F.regexp_extract("path", r"([^/]+)\.[^./]+$", 1))


def index_by_stem(files: DataFrame) -> DataFrame:
    """The first path of each stem."""
    columns = [c for c in files.columns if c not in ("stem", "path")]
    return files.groupBy("stem").agg(F.min(F.struct("path", *columns)).alias("x")).select("x.path", *(f"x.{c}" for c in columns), "stem")


def videos(found: DataFrame, stations=(), ignored=(), years=(), first: str | None = None, last: str | None = None) -> DataFrame:
    """Videos among files (path, modified): video_id, station, at, year, date,
    filename, path. Other extensions and @eaDir folders are left out; of one
    video_id the first path counts; what is empty or None does not restrict."""
    own = found.where(F.lower(F.regexp_extract("path", r"\.([^./]*)$", 1)).isin(*names.VIDEO) & ~F.col("path").rlike("(?:^|/)@eaDir(?:/|$)"))
    own = own.select("path", names.video(F.col("path"), F.col("modified")).alias("v")).groupBy("v.video_id").agg(F.min(F.struct("path", "v.station", "v.at")).alias("x"))
    out = own.select("video_id", "x.station", "x.at", F.year("x.at").alias("year"), F.date_format("x.at", "yyyy-MM-dd").alias("date"), F.regexp_extract("x.path", r"([^/]+)$", 1).alias("filename"), "x.path")
    if ignored:
        out = out.where(~names.station_matches(F.col("station"), ignored))
    if stations:
        out = out.where(names.station_matches(F.col("station"), stations))
    if years:
        out = out.where(F.col("year").isin(*years))
    if first:
        out = out.where(F.col("date") >= first)
    if last:
        out = out.where(F.col("date") <= last)
    return out


def read_annotations(spark: SparkSession, path: str) -> DataFrame:
    """Truth rows: file, has_events, event_type, second since the file's start, with_fish."""
    raw = spark.read.option("header", True).option("sep", ";").schema(_strings(("File_name", "Event", "Time", "With_fish"))).csv(path)
    stem = F.regexp_extract("File_name", r"^(.*?)(?:\.[^.]+)?$", 1)
    start = names.start_time(stem)
    at = F.try_to_timestamp(F.concat_ws(" ", F.date_format(start, "yyyy-MM-dd"), F.col("Time")), F.lit("yyyy-MM-dd HH:mm:ss"))
    return raw.select(stem.alias("file"), F.col("Event").isNotNull().alias("has_events"), F.lower("Event").alias("event_type"), (F.unix_seconds(at) - F.unix_seconds(start.cast("timestamp"))).alias("second"), (F.lower("With_fish") == "yes").alias("with_fish"))


def read_validation(spark: SparkSession, path: str, stations=(), types=(), first: str | None = None, last: str | None = None) -> DataFrame:
    """Labelled events, all strings, header names trimmed, filtered and ordered."""
    df = spark.read.option("header", True).option("sep", ";").csv(path)
    df = df.toDF(*[c.strip() for c in df.columns]).where("valid_fish_arrival is not null")
    if stations:
        df = df.where(F.col("station").isin(*stations))
    if types:
        df = df.where(F.col("event_type").isin(*types))
    if first:
        df = df.where(F.col("date") >= first)
    if last:
        df = df.where(F.col("date") <= last)
    return df.orderBy("date", "video_id", F.expr("try_cast(second as double)"))


def read_events(spark: SparkSession, path: str, types=(), fish_only: bool = False) -> DataFrame:
    """Event files; the time is absolute_timestamp or else timestamp."""
    df = spark.read.option("header", True).csv(path)
    times = [F.col(c) for c in ("absolute_timestamp", "timestamp") if c in df.columns]
    df = df.withColumn("at", F.try_to_timestamp(F.coalesce(*times)) if times else F.lit(None).cast("timestamp"))
    if types:
        df = df.where(F.col("type").isin(*types))
    return df.where("lower(arrival_with_fish) in ('1', 'true', 'yes', 'y', 't')") if fish_only else df


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A result table, or an empty one where the path does not exist."""
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    there = at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)
    return spark.read.schema(schema).option("header", True).csv(path) if there else spark.createDataFrame([], schema)


def read_boxes_xml(spark: SparkSession, path: str) -> DataFrame:
    """image, width, height and one row per object of legacy XML labels."""
    schema = "filename string, size struct<width:int,height:int>, object array<struct<name:string,bndbox:struct<xmin:double,ymin:double,xmax:double,ymax:double>>>"
    df = spark.read.format("xml").option("rowTag", "annotation").schema(schema).load(path)
    return df.select(F.col("filename").alias("image"), "size.width", "size.height", F.explode_outer("object").alias("o")).select("image", "width", "height", F.col("o.name").alias("class"), "o.bndbox.xmin", "o.bndbox.ymin", "o.bndbox.xmax", "o.bndbox.ymax")


def read_label_text(spark: SparkSession, path: str) -> DataFrame:
    """image, class, cx, cy, w, h of label files; an empty file gives one row of nulls."""
    raw = spark.read.option("wholetext", True).text(path).withColumn("image", F.regexp_extract(F.input_file_name(), r"([^/]+)\.txt$", 1))
    lines = raw.select("image", F.explode_outer(F.filter(F.split("value", "\n"), lambda x: F.trim(x) != "")).alias("line"))
    part = F.split("line", r"\s+")
    return lines.select("image", F.expr("try_cast(split(line, '\\\\s+')[0] as int)").alias("class"), *(part.getItem(i + 1).try_cast("double").alias(c) for i, c in enumerate(("cx", "cy", "w", "h"))))


def read_json(spark: SparkSession, path: str, schema: str, lines: bool = False) -> DataFrame:
    """JSON files of one value each, or of one value per line."""
    return spark.read.option("multiLine", not lines).schema(schema).json(path)


def every_kth(df: DataFrame, k: int, frame: str = "frame") -> DataFrame:
    """Frame thinning: every k-th frame."""
    return df.where(F.col(frame) % k == 0)
