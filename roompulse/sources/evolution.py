"""Files of several schemas read as one table: later generations add columns or widen types."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import ByteType, DataType, DecimalType, DoubleType, FloatType, IntegerType, LongType, ShortType, StructField, StructType

#: Types each of which holds every value of those before it.
WIDTHS = ([ByteType(), ShortType(), IntegerType(), LongType()], [FloatType(), DoubleType()])


def wider(a: DataType, b: DataType) -> DataType:
    """The narrowest type that holds the values of both; raises where there is none."""
    if a == b:
        return a
    for line in WIDTHS:
        if a in line and b in line:
            return max(a, b, key=line.index)
    if isinstance(a, DecimalType) and isinstance(b, DecimalType):
        scale = max(a.scale, b.scale)
        return DecimalType(max(a.precision - a.scale, b.precision - b.scale) + scale, scale)
    if isinstance(a, StructType) and isinstance(b, StructType):
        return united(a, b)
    raise TypeError(f"no type holds both {a.simpleString()} and {b.simpleString()}")


def united(*schemas: StructType) -> StructType:
    """All columns of the schemas, in order of first appearance, each as wide as needed; names differ by more than case."""
    fields: dict[str, StructField] = {}
    for schema in schemas:
        for f in schema.fields:
            own = fields.get(f.name.lower())
            fields[f.name.lower()] = StructField(own.name, wider(own.dataType, f.dataType)) if own else StructField(f.name, f.dataType)
    return StructType(list(fields.values()))


def read_generations(spark: SparkSession, paths: Sequence[str], file_format: str = "parquet") -> DataFrame:
    """Folders of one table, a generation each: missing columns are null, narrow numbers are widened while reading."""
    schemas = [spark.read.format(file_format).load(path).schema for path in paths]
    return spark.read.format(file_format).schema(united(*schemas)).load(list(paths))
