"""Relational sinks: bulk reload and keyed upsert."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from itertools import islice

from pyspark.sql import DataFrame

ROWS_PER_STATEMENT = 1000


def reload_table(df: DataFrame, url: str, table: str, **driver: str) -> None:
    """Truncate a table and load it again in batches, keeping its definition."""
    options = {"truncate": "true", "batchsize": str(ROWS_PER_STATEMENT), **driver}
    df.write.format("jdbc").options(url=url, dbtable=table, **options).mode("overwrite").save()


def upsert_statement(table: str, columns: Sequence[str], keys: Sequence[str]) -> str:
    """An insert that replaces the values of an existing key; a table of keys alone keeps the row it has."""
    marks = ", ".join(["%s"] * len(columns))
    values = ", ".join(f"{c} = VALUES({c})" for c in columns if c not in keys) or f"{keys[0]} = {keys[0]}"
    return f"INSERT INTO {table} ({', '.join(columns)}) VALUES ({marks}) ON DUPLICATE KEY UPDATE {values}"


def upsert_batches(
    connect: Callable[[], object], table: str, keys: Sequence[str], writers: int = 8
) -> Callable[[DataFrame, int], None]:
    """Upsert each micro-batch through a DB-API connection opened by every writing task.

    Rows are hashed by key onto ``writers`` tasks, so a key is written by one task
    only.  Writing a batch twice leaves the same table.
    """

    def write(df: DataFrame, batch_id: int) -> None:
        columns = df.columns
        statement = upsert_statement(table, columns, keys)

        def send(rows: Iterable) -> None:
            rows = iter(rows)
            connection = connect()
            try:
                cursor = connection.cursor()
                while chunk := [tuple(r) for r in islice(rows, ROWS_PER_STATEMENT)]:
                    cursor.executemany(statement, chunk)
                connection.commit()
            finally:
                connection.close()

        df.repartition(writers, *keys).foreachPartition(send)

    return write
