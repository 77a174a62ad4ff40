"""Messages to topics through any sink: topic, key, value and headers, as the broker's own sink takes them.

Delivery is at least once: a batch that runs again writes its messages again.  Every message carries an id in its
headers, and readers drop what they have seen under that id.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ID_HEADER = "message-id"


def as_messages(published: DataFrame, message_id: Column) -> DataFrame:
    """topic, key, value with the id in the headers (array of key and binary value)."""
    header = F.struct(F.lit(ID_HEADER).alias("key"), message_id.cast("string").cast("binary").alias("value"))
    return published.select("topic", "key", "value", F.array(header).alias("headers"))


def write_messages(messages: DataFrame, file_format: str, **options: str) -> None:
    """Append to a sink; for the broker ``kafka`` with its servers, for files a format with its path."""
    writer = messages.write.format(file_format).options(**options)
    (writer if file_format == "kafka" else writer.mode("append")).save()


def topic_sink(file_format: str, shape: Callable[[DataFrame], DataFrame] = lambda df: df, **options: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` sink that appends each micro-batch's messages."""

    def write(df: DataFrame, batch_id: int) -> None:
        write_messages(shape(df), file_format, **options)

    return write


def header(name: str) -> Column:
    """The last header of a name, as text; null without one."""
    own = F.filter("headers", lambda h: h["key"] == name)
    return F.when(F.size(own) > 0, F.element_at(own, -1)["value"].cast("string"))


def read_once(messages: DataFrame) -> DataFrame:
    """Messages without the repeats of an id; those without an id are all kept.  Batch, and stream within its watermark."""
    named = messages.withColumn("message_id", F.coalesce(header(ID_HEADER), F.concat(F.lit("none-"), F.expr("uuid()"))))
    keys = ["topic", "message_id"]
    kept = named.dropDuplicatesWithinWatermark(keys) if messages.isStreaming else named.dropDuplicates(keys)
    return kept.drop("message_id")
