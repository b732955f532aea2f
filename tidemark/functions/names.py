"""What file names, paths and texts say: stations, times, numbers, flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Date and time patterns of file names, in the order in which they are tried.
_TIMES = [
    (r"([0-9]{8}T[0-9]{6})", "yyyyMMdd'T'HHmmss"),
    (r"([0-9]{8}_[0-9]{6})", "yyyyMMdd_HHmmss"),
    (r"([0-9]{4}-[0-9]{2}-[0-9]{2}_[0-9]{2}\.[0-9]{2}\.[0-9]{2})", "yyyy-MM-dd_HH.mm.ss"),
]


def start_time(stem: Column) -> Column:
    """The time in a file's name. The first pattern that matches decides: if its
    digits are no date, the result is null."""
    out = F.lit(None).cast("timestamp_ntz")
    for rx, form in reversed(_TIMES):
        out = F.when(stem.rlike(rx), F.try_to_timestamp(F.regexp_extract(stem, rx, 1), F.lit(form)).cast("timestamp_ntz")).otherwise(out)
    return out


def any_time(stem: Column) -> Column:
    """The time by the first pattern whose digits are a date."""
    return F.coalesce(*(F.try_to_timestamp(F.nullif(F.regexp_extract(stem, rx, 1), F.lit("")), F.lit(form)).cast("timestamp_ntz") for rx, form in _TIMES))


# Forms of video names, in the order in which they are tried: pattern,
# groups of the station, the date and the time.
_FORMS = [
    (r"([A-Za-z0-9]+)_([0-9]{8})T([0-9]{6})", 1, 2, 3),
    (r"([A-Za-z0-9]+)_([0-9]{8})_([0-9]{6})", 1, 2, 3),
    (r"([A-Za-z0-9]+)_([0-9]{8})([0-9]{6})", 1, 2, 3),
    (r"(?:[0-9]+_)?([A-Za-z0-9]+)(?:_\([^)]*\))?_([0-9]{4}-[0-9]{2}-[0-9]{2})_([0-9]{2}\.[0-9]{2}\.[0-9]{2})(?:_[0-9]+)?$", 1, 2, 3),
    (r"(?:[A-Za-z0-9]+_)?([A-Za-z0-9]+(?:_[A-Za-z0-9]+)*)_([0-9]{4}[-_][0-9]{2}[-_][0-9]{2})(?:_([0-9]{2}[:.\-][0-9]{2}[:.\-][0-9]{2}))?", 1, 2, 3),
    (r"([A-Za-z0-9]+)_([0-9]{8})", 1, 2, 0),
]
#: Extensions of videos; folders of dates and years, which name no station.
VIDEO = ("mkv", "mp4", "avi")
_NO_STATION = r"(?i)^$|@|\.(?:mkv|mp4|avi)$|^[0-9]{4}-[0-9]{2}-[0-9]{2}$|^[0-9]{4}$"


def stem_of(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+?)(?:\.[^./]*)?$", 1)


def station_in(path: Column) -> Column:
    """The innermost folder that is no date, year or hidden folder; else the file's stem."""
    parts = F.filter(F.split(path, "/"), lambda p: ~p.rlike(_NO_STATION))
    return F.upper(F.coalesce(F.try_element_at(parts, F.lit(-1)), stem_of(path)))


def video(path: Column, modified: Column) -> Column:
    """Struct of a video's station, time `at` and video_id, by the first form of
    name whose digits are a date; else by folder and time of modification. An
    identifier without a time of day ends in digits of the path's digest."""
    stem, found = stem_of(path), []
    for rx, station, day, time in _FORMS:
        digits = lambda g: F.regexp_replace(F.regexp_extract(stem, rx, g), "[^0-9]", "") if g else F.lit("")  # noqa: B023, E731
        date, clock = digits(day), digits(time)
        timed = F.length(clock) == 6
        at = F.try_to_timestamp(F.concat(F.nullif(date, F.lit("")), F.when(timed, clock).otherwise("000000")), F.lit("yyyyMMddHHmmss")).cast("timestamp_ntz")
        name = F.upper(F.regexp_extract(stem, rx, station))
        end = F.when(timed, F.concat(F.lit("T"), clock)).otherwise(F.concat(F.lit("_"), short_id(path)))
        good = at.isNotNull()
        if not time:
            good = good & F.substring(date, 1, 4).try_cast("int").between(2000, 2100)
        found.append(F.when(good, F.struct(name.alias("station"), at.alias("at"), F.concat(name, F.lit("_"), date, end).alias("video_id"))))
    at, name = modified.cast("timestamp_ntz"), station_in(path)
    return F.coalesce(*found, F.struct(name.alias("station"), at.alias("at"), video_id(name, at, path).alias("video_id")))


def station_of(stem: Column) -> Column:
    """The name before the date, upper case, without a leading number."""
    return F.upper(F.nullif(F.regexp_extract(stem, r"^(?:[0-9]+_)?([A-Za-z][A-Za-z0-9]*)", 1), F.lit("")))


def year_in(path: Column) -> Column:
    return F.nullif(F.regexp_extract(path, r"/((?:19|20)[0-9]{2})(?:/|$)", 1), F.lit("")).cast("int")


def overflow_time(day: Column, hhmmss: Column) -> Column:
    """A day and HHMMSS digits whose parts may overflow (86 seconds carry over)."""
    part = lambda a: F.substring(hhmmss, a, 2).try_cast("int")
    return F.timestamp_add("SECOND", part(1) * 3600 + part(3) * 60 + part(5), day.cast("timestamp_ntz"))


def short_id(path: Column) -> Column:
    """Six hexadecimal digits of the path's MD5, upper case."""
    return F.upper(F.substring(F.md5(path), 1, 6))


def video_id(station: Column, at: Column, path: Column) -> Column:
    return F.concat_ws("_", station, F.date_format(at, "yyyyMMdd'T'HHmmss"), short_id(path))


def plain(x: Column) -> Column:
    """Upper case, letters and digits only."""
    return F.regexp_replace(F.upper(x), "[^A-Z0-9]", "")


def station_matches(station: Column, patterns) -> Column:
    """A pattern is part of the station's name, as it is or in plain form."""
    out = F.lit(False)
    for p in patterns:
        out = out | F.contains(F.upper(station), F.upper(F.lit(p))) | (F.contains(plain(station), plain(F.lit(p))) & (F.length(plain(F.lit(p))) > 0))
    return out


def model_short(stem: Column) -> Column:
    """A block of four digits, else trailing digits, else the whole stem."""
    got = lambda rx: F.nullif(F.regexp_extract(stem, rx, 1), F.lit(""))
    return F.coalesce(got(r"(?:^|[^0-9])([0-9]{4})(?:[^0-9]|$)"), got(r"([0-9]+)$"), stem)


def event_id(model: Column, station: Column, at: Column, stem: Column, second: Column, kind: Column) -> Column:
    """model_station_time (or stem_sNNNNNN)_arr|dep."""
    when = F.coalesce(F.date_format(at, "yyyyMMdd'T'HHmmss"), F.concat(stem, F.lit("_s"), F.lpad(second.cast("bigint").cast("string"), 6, "0")))
    return F.concat_ws("_", model, station, when, F.when(kind == "arrival", "arr").otherwise("dep"))


def type_of_id(event: Column, kind: Column) -> Column:
    """The event's type, or what the end of its id says."""
    return F.coalesce(kind, F.when(F.endswith(event, F.lit("_arr")), "arrival").when(F.endswith(event, F.lit("_dep")), "departure"))


def flag(x: Column) -> Column:
    """1, true, yes, y and t, in either case."""
    return F.coalesce(F.lower(F.trim(x.cast("string"))).isin("1", "true", "yes", "y", "t"), F.lit(False))


def whole(x: Column, default: int = 0) -> Column:
    """A whole number from a text that may have decimals."""
    return F.coalesce(x.cast("string").try_cast("double").cast("bigint"), F.lit(default).cast("bigint"))


def clock_to_seconds(x: Column) -> Column:
    """MM:SS as seconds."""
    p = F.split(x, ":")
    return p[0].try_cast("int") * 60 + p[1].try_cast("int")


def seconds_to_clock(x: Column) -> Column:
    """Seconds as HH:MM:SS.mmm."""
    ms = F.round(x * 1000).cast("bigint")
    return F.format_string("%02d:%02d:%02d.%03d", F.floor(ms / 3600000), F.floor(ms / 60000) % 60, F.floor(ms / 1000) % 60, ms % 1000)


def sigmoid(z: Column) -> Column:
    """Without overflow on either side."""
    return F.when(z >= 0, 1 / (1 + F.exp(-z))).otherwise(F.exp(z) / (1 + F.exp(z)))
