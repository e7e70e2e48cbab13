"""Time columns: epoch values, parts, buckets, zones and gaps.

All inputs are zone-less timestamps or long microseconds, so no result depends on the session time zone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickfeat.naming import MICROS

SECONDS_PER_DAY = 86_400
LOG_ZONE = "Asia/Shanghai"
# Upper bound (inclusive) and label of the hour bands; every other hour is OTHER_HOURS.
HOUR_BANDS = ((7, 11, 1), (12, 17, 2), (18, 20, 3), (21, 24, 4))
OTHER_HOURS = 5
# name -> (buckets per hour, minutes per bucket)
DAY_BUCKETS = {"15min": (4, 15), "3min": (20, 3), "30min": (2, 30)}


def _col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def epoch_micros(timestamp: str | Column) -> Column:
    """Microseconds since 1970-01-01 of a zone-less timestamp."""
    ts = _col(timestamp)
    seconds = F.hour(ts) * 3600 + F.minute(ts) * 60
    return (
        F.unix_date(ts.cast("date")).cast("long") * (SECONDS_PER_DAY * MICROS)
        + seconds.cast("long") * MICROS
        + (F.extract(F.lit("SECOND"), ts) * MICROS).cast("long")
    )


def epoch_seconds(micros: str | Column) -> Column:
    return F.floor(_col(micros) / F.lit(MICROS)).cast("long")


def add_time_parts(df: DataFrame, timestamp: str = "click_time", parts: Sequence[str] = ("day", "hour", "minute")) -> DataFrame:
    """Day of month, hour and minute as integer columns."""
    builders = {"day": F.dayofmonth, "hour": F.hour, "minute": F.minute}
    return df.withColumns({p: builders[p](timestamp) for p in parts})


def day_bucket(name: str, hour: str | Column = "hour", minute: str | Column = "minute", wrap_uint8: bool = False) -> Column:
    """Number of the 3, 15 or 30 minute bucket inside the day.

    ``wrap_uint8`` gives the value an 8-bit unsigned column would hold.
    """
    per_hour, width = DAY_BUCKETS[name]
    bucket = _col(hour) * per_hour + F.floor(_col(minute) / width).cast("int")
    return F.pmod(bucket, F.lit(256)) if wrap_uint8 else bucket


def add_day_buckets(df: DataFrame, wrap_uint8: bool = False) -> DataFrame:
    return df.withColumns({name: day_bucket(name, wrap_uint8=wrap_uint8) for name in DAY_BUCKETS})


def shift_zone(timestamp: str | Column, target: str = LOG_ZONE, source: str = "UTC") -> Column:
    """Wall-clock time of ``target`` for a zone-less ``source`` time."""
    return F.convert_timezone(F.lit(source), F.lit(target), _col(timestamp))


def shift_hours(micros: str | Column, hours: int) -> Column:
    return _col(micros) + hours * 3600 * MICROS


def parse_timestamp(text: str | Column, pattern: str | None = None) -> Column:
    """Zone-less timestamp from text. Without a pattern, ISO text is read and other text gives NULL."""
    if pattern is None:
        return _col(text).try_cast("timestamp_ntz")
    return F.to_timestamp_ntz(_col(text), F.lit(pattern))


def format_epoch(seconds: str | Column, zone: str = "UTC") -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text of a whole epoch second in ``zone``."""
    epoch = F.make_timestamp_ntz(*(F.lit(v) for v in (1970, 1, 1, 0, 0, 0)))
    utc = epoch + F.make_dt_interval(secs=F.floor(_col(seconds)).cast("decimal(18,6)"))
    return shift_zone(utc, zone).cast("string")


def hour_band(hour: str | Column) -> Column:
    """Part of the day, 1 to 5."""
    h = _col(hour)
    band = F.lit(OTHER_HOURS)
    for low, high, label in reversed(HOUR_BANDS):
        band = F.when(h.between(low, high), label).otherwise(band)
    return band


def gap_seconds(later: str | Column, earlier: str | Column) -> Column:
    """Difference of two microsecond columns as fractional seconds."""
    return (_col(later) - _col(earlier)) / F.lit(float(MICROS))


def whole_seconds(gap_micros: Column) -> Column:
    """Gap floored to seconds."""
    return F.floor(gap_micros / F.lit(MICROS)).cast("long")


def seconds_field(gap_micros: Column) -> Column:
    """Seconds within the day of a gap; whole days are dropped."""
    return F.pmod(whole_seconds(gap_micros), F.lit(SECONDS_PER_DAY))


def hours_field(gap_micros: Column) -> Column:
    """Whole hours within the day of a gap."""
    return F.floor(seconds_field(gap_micros) / 3600).cast("long")


def mirror(micros: str | Column, pivot: str = "2050-01-01 00:00:00") -> Column:
    """Time reversed around ``pivot``: later rows get smaller values."""
    return epoch_micros(F.lit(pivot).cast("timestamp_ntz")) - _col(micros)
