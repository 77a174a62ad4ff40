"""Messages of the Kafka topics, live or replayed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from roompulse.functions.times import iso_text, parse_iso
from roompulse.operators.messages import decode_json
from roompulse.schemas import TOPIC_CHAT, TOPIC_GIFT, TOPIC_MESSAGE, TOPIC_ROOM

ALL_TOPICS = (TOPIC_CHAT, TOPIC_GIFT, TOPIC_ROOM)


def kafka_options(
    servers: str, topics: Sequence[str] = ALL_TOPICS, start: str = "latest", per_batch: int | None = None
) -> dict[str, str]:
    """Reader options; ``start`` is ``latest`` or ``earliest`` (also for a bounded replay)."""
    if start not in ("latest", "earliest"):
        raise ValueError(f"unknown start: {start}")
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": start,
        "failOnDataLoss": "false",
    }
    if per_batch:
        options["maxOffsetsPerTrigger"] = str(per_batch)
    return options


def kafka_topics(spark: SparkSession, servers: str, **kwargs) -> DataFrame:
    """A stream of ``topic`` and ``value``; offsets live in the query's checkpoint.

    Needs the Kafka connector package on the cluster.  For a bounded replay start
    at ``earliest`` and run the query with ``trigger(availableNow=True)``.
    """
    stream = spark.readStream.format("kafka").options(**kafka_options(servers, **kwargs)).load()
    return stream.select("topic", F.col("value").cast("string").alias("value"))


def landing(raw: DataFrame, schema: StructType = TOPIC_MESSAGE) -> DataFrame:
    """Every topic row: decoded fields, the text itself where it is damaged (``damaged``), and a time for all.

    A message without a readable timestamp takes the time of its ingestion.
    """
    decoded = decode_json(raw, "value", schema)
    broken = F.col("bad").isNotNull() | F.col("value").isNull()
    rows = decoded.select("topic", "body.*", F.when(broken, F.coalesce("value", F.lit(""))).alias("damaged"))
    stamp = F.when(parse_iso(F.col("timestamp")).isNotNull(), F.col("timestamp"))
    return rows.withColumn("timestamp", F.coalesce(stamp, iso_text(F.current_timestamp())))


def messages(raw: DataFrame, schema: StructType = TOPIC_MESSAGE, late: str | None = "5 seconds") -> DataFrame:
    """Decoded topic rows with ``event_time``, for windows; damaged and undated ones have no window and are left out.

    On a stream ``late`` sets the watermark.
    """
    decoded = decode_json(raw, "value", schema).filter(F.col("bad").isNull())
    rows = decoded.select("topic", "body.*").withColumn("event_time", parse_iso(F.col("timestamp")))
    rows = rows.filter(F.col("event_time").isNotNull())
    return rows.withWatermark("event_time", late) if rows.isStreaming and late else rows
