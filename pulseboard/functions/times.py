"""Timestamps, labels and calendar parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS_FORMAT = "yyyy-MM-dd HH:mm:ss"
MILLIS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS"
HOUR_FORMAT = "yyyy-MM-dd HH:00"
COMPACT_FORMAT = "yyyyMMddHHmmss"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def at_rest(ts: Column | str) -> Column:
    """Zone-free type in which results are stored."""
    return _col(ts).cast("timestamp_ntz")


def hour_label(ts: Column | str) -> Column:
    return F.date_format(_col(ts), HOUR_FORMAT)


def ten_minute_label(ts: Column | str, with_date: bool = True) -> Column:
    """``HH:m0``; with the date in front by default, so that days stay apart."""
    label = F.concat(F.substring(F.date_format(_col(ts), "HH:mm"), 1, 4), F.lit("0"))
    if with_date:
        label = F.concat(F.date_format(_col(ts), "yyyy-MM-dd "), label)
    return label


def parse_timestamp(text: Column | str, fmt: str = "yyyy-MM-dd HH:mm:ss[.SSS]") -> Column:
    """Null on bad input. The fixed format refuses ISO text with ``T`` and zone."""
    return F.try_to_timestamp(_col(text), F.lit(fmt))


def epoch_seconds(text: Column | str) -> Column:
    return F.unix_timestamp(parse_timestamp(text))


def millis_to_timestamp(ms: Column | str) -> Column:
    """Timestamp of epoch milliseconds with the fraction cut off."""
    return F.timestamp_seconds(F.floor(_col(ms) / F.lit(1000)))


def format_millis(ms: Column | str, fmt: str = COMPACT_FORMAT, zone: str = "UTC") -> Column:
    """Epoch milliseconds as text in ``zone``."""
    instant = F.timestamp_millis(_col(ms))
    if zone != "UTC":
        instant = F.from_utc_timestamp(instant, zone)
    return F.date_format(instant, fmt)


def timestamp_text(ts: Column | str) -> Column:
    """Cast to string that always shows three digits of the fraction."""
    return F.date_format(_col(ts), MILLIS_FORMAT)


def calendar_parts(day: Column | str) -> dict[str, Column]:
    c = _col(day)
    return {
        "year": F.year(c),
        "quarter": F.quarter(c),
        "month": F.month(c),
        "week": F.weekofyear(c),
        "day_of_year": F.dayofyear(c),
        "day_of_month": F.dayofmonth(c),
    }


def clock_parts(ts: Column | str) -> dict[str, Column]:
    c = _col(ts)
    return {"hour": F.hour(c), "minute": F.minute(c), "second": F.second(c)}
