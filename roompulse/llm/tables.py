"""Reading the input tables, and intermediate tables in the folder that all executors share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roompulse.session import shared_folder

# Workers hand freed record batches back to the system, as several of them share an executor's memory.
pa.set_memory_pool(pa.system_memory_pool())


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: later uses do not compute it again.

    A lost executor then costs a read, not the whole lineage.
    """
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_bytes(name: str = "text") -> Column:
    """The text as UTF-8 bytes, a missing one as the empty text."""
    return F.coalesce(F.col(name).cast("binary"), F.lit(b""))


_REMEMBERED: dict[str, dict] = {}


def remembered(kind: str) -> dict:
    """What a worker remembers from task to task for one kind of work; what it remembered for other kinds is given up.

    Executors use their workers again for every later step, so a step would else carry the memory of all steps before it.
    """
    if kind not in _REMEMBERED:
        _REMEMBERED.clear()
        _REMEMBERED[kind] = {}
    return _REMEMBERED[kind]


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def batch(schema: pa.Schema, columns: Iterable) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(values, field.type) for values, field in zip(columns, schema)], schema=schema)


def batches(schema: pa.Schema, rows: Iterable[tuple], size: int = 20_000) -> Iterator[pa.RecordBatch]:
    """Rows in record batches of a bounded size."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield batch(schema, zip(*held))
            held = []
    if held:
        yield batch(schema, zip(*held))
