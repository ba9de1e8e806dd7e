"""Grouped totals of the dashboards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseboard.functions.times import COMPACT_FORMAT, hour_label


def page_and_user_views(df: DataFrame, ts: str = "time", uid: str = "uid", approximate: bool = False) -> DataFrame:
    """Views and different users per hour.

    The exact form counts each (hour, user) pair once before the hour is gathered,
    so a crowded hour is spread over its users.
    """
    users = F.approx_count_distinct(uid) if approximate else F.countDistinct(uid)
    # The hour is grouped as an instant and becomes text once per result row.
    hours = df.groupBy(F.date_trunc("hour", ts).alias("_hour")).agg(
        F.count(F.lit(1)).alias("pv"), users.alias("uv")
    )
    return hours.select(hour_label("_hour").alias("hour"), "pv", "uv")


def window_sum(
    df: DataFrame,
    ts: str,
    value: str | Column,
    keys: Sequence[str] = (),
    duration: str = "1 minute",
    slide: str | None = None,
    offset: str | None = None,
    name: str = "cnt",
) -> DataFrame:
    """Sum per window and key, with the borders of the window as plain columns.

    For sliding windows of a table the rows are first summed per step (the part
    that neighbouring windows share), so a row is counted once and not once per window.
    """
    total = F.sum(F.col(value) if isinstance(value, str) else value)
    start = offset or "0 seconds"
    if slide and not df.isStreaming and _is_multiple(duration, slide):
        step = F.window(ts, slide, slide, start)
        steps = df.groupBy(step.alias("_step"), *keys).agg(total.alias("_part"))
        df = steps.select(F.col("_step.start").alias("_at"), *keys, "_part")
        ts, total = "_at", F.sum("_part")
    window = F.window(ts, duration, slide or duration, start)
    return with_borders(df.groupBy(window.alias("window"), *keys).agg(total.alias(name)))


def _is_multiple(duration: str, slide: str) -> bool:
    """Whether the steps cut the window evenly."""
    size, step = (_seconds(d) for d in (duration, slide))
    return size is not None and step is not None and size % step == 0


# Seconds per unit of a duration text.
_UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def _seconds(duration: str) -> int | None:
    """Seconds of a plain duration such as ``10 minutes``; None for any other form."""
    parts = duration.split()
    unit = _UNITS.get(parts[1].removesuffix("s")) if len(parts) == 2 else None
    return int(parts[0]) * unit if unit and parts[0].isdigit() else None


def with_borders(df: DataFrame, window: str = "window") -> DataFrame:
    rest = [c for c in df.columns if c != window]
    return df.select(
        F.col(f"{window}.start").alias("window_start"), F.col(f"{window}.end").alias("window_end"), *rest
    )


def day_sum(
    df: DataFrame,
    ts: str,
    value: str | Column,
    keys: Sequence[str] = (),
    zone_offset_hours: int = -8,
    name: str = "cnt",
) -> DataFrame:
    """Sum per local day; the day starts ``zone_offset_hours`` from midnight UTC."""
    return window_sum(df, ts, value, keys, "1 day", None, f"{zone_offset_hours % 24} hours", name)


def latest_with_total(
    df: DataFrame, key: str, order: Sequence[str], carried: str, value: str, name: str = "cnt"
) -> DataFrame:
    """Total per key together with the last seen ``carried`` column."""
    return df.groupBy(key).agg(
        F.max_by(carried, F.struct(*order)).alias(carried), F.sum(value).alias(name)
    )


def window_members(
    df: DataFrame, ts: str, columns: Sequence[str], duration: str, zone_format: str = COMPACT_FORMAT
) -> DataFrame:
    """Every element of a window with the label of the window and its size.

    The members stay rows: only the sizes are grouped and joined back, no window
    is gathered in one place.
    """
    window = F.window(ts, duration)
    tagged = df.select(window.alias("_w"), *columns).select(
        F.col("_w.start").alias("_start"), F.col("_w.end").alias("_end"), *columns
    )
    sizes = tagged.groupBy("_start").agg(F.count(F.lit(1)).alias("size"))
    return tagged.join(sizes, "_start").select(
        F.date_format("_start", zone_format).alias("window_from"),
        F.date_format("_end", zone_format).alias("window_to"),
        "size",
        *columns,
    )
