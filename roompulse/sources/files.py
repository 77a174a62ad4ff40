"""Tab-separated, ORC and JSON-lines readers with declared schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Quotes are doubled inside quoted fields; an empty field is null.
TSV_OPTIONS = {"sep": "\t", "header": "false", "quote": '"', "escape": '"', "nullValue": "", "emptyValue": ""}


def read_tsv(spark: SparkSession, path: str, schema: StructType, line_breaks: bool = False) -> DataFrame:
    """An external tab-separated table.

    With ``line_breaks`` quoted fields may hold line breaks; every file is then one
    task, so that is for files of a sink that keeps them small.
    """
    return spark.read.schema(schema).options(**TSV_OPTIONS, multiLine=str(line_breaks).lower()).csv(path)


def read_orc(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.orc(path)


def json_lines(spark: SparkSession, path: str, files_per_batch: int | None = 1) -> DataFrame:
    """A stream of JSON lines in the shape of the topic source: ``topic`` and ``value``.

    The topic is the name of the folder a file lies in.  Used where no broker is at hand.
    """
    stream = spark.readStream.option("recursiveFileLookup", "true")
    lines = (stream.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else stream).text(path)
    parts = F.split(F.col("_metadata.file_path"), "/")
    return lines.select(F.element_at(parts, -2).alias("topic"), "value")


def parquet_stream(spark: SparkSession, path: str, schema: StructType, files_per_batch: int | None = None) -> DataFrame:
    """A parquet table, in whatever files, as a stream; all files that are new at a trigger unless bounded."""
    stream = spark.readStream.schema(schema)
    return (stream.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else stream).parquet(path)
