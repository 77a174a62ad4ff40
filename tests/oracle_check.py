"""Compare every query with its SQL on one data folder: types, rows and values.

Run as ``python tests/oracle_check.py [folder] [query ...]``.
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time
from decimal import Decimal

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"
CHECKED = "/root/testdata/sf0.01"

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

FAMILIES = {
    "string": {"VARCHAR"},
    "bigint": {"BIGINT", "INTEGER"},
    "int": {"BIGINT", "INTEGER"},
    "double": {"DOUBLE"},
    "boolean": {"BOOLEAN"},
    "timestamp_ntz": {"TIMESTAMP"},
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.9g}")
    if isinstance(value, Decimal):
        return float(f"{float(value):.9g}")
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    flat = [tuple(plain(r[i]) for i in order) for r in rows]
    return sorted(flat, key=lambda r: tuple((v is None, str(v)) for v in r))


def compare(spark, con, folder: str, name: str, build, sql: str) -> list[str]:
    """Differences found, empty when the query and its SQL agree."""
    df = build(spark, folder)
    got = rows_of(df.columns, df.collect())
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]) for d in result.description}
    want = rows_of(names, result.fetchall())
    problems = []
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    for field in df.schema.fields:
        allowed = FAMILIES.get(field.dataType.simpleString(), set())
        if kinds[field.name] not in allowed:
            problems.append(f"type of {field.name}: {field.dataType.simpleString()} vs {kinds[field.name]}")
    if len(got) != len(want):
        problems.append(f"rows {len(got)} != {len(want)}")
    wrong = [(a, b) for a, b in zip(got, want) if a != b]
    if wrong:
        problems.append(f"{len(wrong)} rows differ, first {sorted(names)}:\n  spark {wrong[0][0]}\n  sql   {wrong[0][1]}")
    if not want:
        problems.append("no rows at all")
    return problems


def main(argv: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    from roompulse.session import build_session

    folder = argv[0] if argv else CHECKED
    spark = build_session(
        "oracle-check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, builds = connect(folder), oracle_sql(), queries()
    names = argv[1:] or list(builds)
    failed = 0
    for name in names:
        start = time.time()
        try:
            problems = compare(spark, con, folder, name, builds[name], sqls[name]) if name in sqls else ["no SQL"]
        except Exception as error:  # show every failure in one run
            problems = [f"{type(error).__name__}: {str(error)[:600]}"]
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - start:.1f}s", *problems, sep="\n     " if problems else " ", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]) > 0)
