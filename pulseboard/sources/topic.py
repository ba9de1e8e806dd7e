"""Topics of text records: a message bus where its package is present, a folder of lines otherwise."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulseboard.functions.records import decode_json


@dataclass(frozen=True)
class Topic:
    """Where a topic lies. Either ``servers`` and ``name``, or ``path``."""

    name: str = ""
    servers: str = ""
    path: str = ""
    starting: str | Mapping[int, int] = "earliest"
    options: Mapping[str, str] = field(default_factory=dict)


def kafka_options(topic: Topic) -> dict[str, str]:
    """Reader options; specific offsets become the JSON map that the reader wants."""
    if isinstance(topic.starting, str):
        starting = topic.starting
    else:
        offsets = ", ".join(f'"{p}": {o}' for p, o in sorted(topic.starting.items()))
        starting = f'{{"{topic.name}": {{{offsets}}}}}'
    return {
        "kafka.bootstrap.servers": topic.servers,
        "subscribe": topic.name,
        "startingOffsets": starting,
        **topic.options,
    }


def raw_topic(spark: SparkSession, topic: Topic, stream: bool = True) -> DataFrame:
    """The text of each record in a column ``value``."""
    reader = spark.readStream if stream else spark.read
    if topic.path:
        return reader.options(**topic.options).text(topic.path)
    return reader.format("kafka").options(**kafka_options(topic)).load().select(
        F.col("value").cast("string").alias("value")
    )


def json_topic(
    spark: SparkSession,
    topic: Topic,
    schema: T.StructType,
    stream: bool = True,
    policy: str = "skip",
    sentinel: dict[str, object] | None = None,
    timestamp_format: str | None = None,
) -> DataFrame:
    """A topic of JSON records with a declared schema."""
    return decode_json(
        raw_topic(spark, topic, stream), schema, "value", policy, sentinel, timestamp_format
    )


def from_offsets(
    df: DataFrame,
    starting: str | Mapping[int, int],
    partition: str = "partition",
    offset: str = "offset",
    unlisted: str = "earliest",
) -> DataFrame:
    """Start position over a stored topic with partition and offset columns.

    ``earliest`` keeps all; ``latest`` keeps nothing that is stored now; a map
    gives the first offset per partition. A start position moves the start and does not choose partitions: those
    outside the map start at ``unlisted``, ``earliest`` or ``latest``. (The bus reader wants all partitions listed.)
    """
    if unlisted not in ("earliest", "latest"):
        raise ValueError("unlisted must be earliest or latest")
    if starting == "earliest":
        return df
    if starting == "latest":
        return df.where(F.lit(False))
    outside = ~F.col(partition).isin([*starting]) if starting else F.lit(True)
    wanted = F.coalesce(outside, F.lit(True)) if unlisted == "earliest" else F.lit(False)
    for part, first in starting.items():
        wanted = wanted | ((F.col(partition) == part) & (F.col(offset) >= first))
    return df.where(wanted)
