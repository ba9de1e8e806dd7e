"""Two-step event sequences: a start event and the first later end event within a span."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseboard.operators.ordered import next_match


def followed_by(
    events: DataFrame,
    start: Column,
    end: Column,
    span: str,
    ts: str = "ts",
    tie: str = "event_id",
    payload: Sequence[str] = ("uid",),
    keys: Sequence[str] = (),
) -> DataFrame:
    """Each start event with the first later end event less than ``span`` after it.

    Events in between are skipped; one end can close several starts, and an end
    can be a start itself. Without ``keys`` the sequence runs over all events.
    Only start and end events are shuffled.
    """
    marked = events.select(
        *dict.fromkeys([*keys, ts, tie, *payload]),
        F.coalesce(start, F.lit(False)).alias("_is_start"),
        F.coalesce(end, F.lit(False)).alias("_is_end"),
    ).where("_is_start or _is_end")
    fields = list(dict.fromkeys([ts, tie, *payload]))
    paired = next_match(marked, [ts, tie], "_is_end", fields, "_next", keys).where("_is_start")
    within = F.col(f"_next.{ts}") < F.col(ts) + F.expr(f"interval {span}")
    return paired.where(within).select(
        *keys,
        F.struct(*[F.col(f) for f in fields]).alias("start"),
        F.col("_next").alias("end"),
    )


def alert_rows(matches: DataFrame, ts: str = "ts", tie: str = "event_id", who: str = "uid") -> DataFrame:
    """One alert per match: both events and a message text."""
    stamp = "yyyy-MM-dd HH:mm:ss"
    return matches.select(
        F.col(f"start.{tie}").alias("start_id"),
        F.col(f"end.{tie}").alias("end_id"),
        F.col(f"end.{who}").alias(who),
        F.format_string(
            "user %s at %s followed by user %s at %s",
            F.col(f"start.{who}").cast("string"),
            F.date_format(F.col(f"start.{ts}"), stamp),
            F.col(f"end.{who}").cast("string"),
            F.date_format(F.col(f"end.{ts}"), stamp),
        ).alias("message"),
    )
