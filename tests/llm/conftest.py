import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SMALL = "/root/testdata/sf0.001"

#: Columns that a caller's table may have; their names are those the operators use inside.
EXTRA = "key string, n bigint, row string, bin int, digest string, parts string, kept string, start int, h int, id string, dropped string, rest string, component string"


def small_docs(spark):
    table = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    return table, [(r[0], r[1]) for r in table.collect()]


def edge_rows():
    """Nulls, empty and long texts, exact and near copies, repeated lines; ids are distinct and not null."""
    rng = random.Random(7)
    words = ["alpha", "beta", "gamma", "Delta", "éclair", "straße", "omega", "x1", "kappa,", "sigma."]
    prose = lambda n: " ".join(rng.choice(words) + str(rng.randrange(40)) for _ in range(n))
    shared, line, base = prose(40), "  A line that is found in many documents  ", prose(120).split()
    rows = [(1, None), (2, ""), (3, " \n\t\n "), (4, "short"), (5, "?!"), (6, "a b c d"), (7, "a b c d"), (8, "A B c d")]
    rows += [(10 + i, prose(30) + "\n" + line + "\n" + shared + "\n" + prose(20)) for i in range(6)]
    for i in range(12):
        copy = list(base)
        for _ in range(i % 4):
            copy[rng.randrange(len(copy))] = f"edit{i}"
        rows.append((30 + i, " ".join(copy)))
    rows += [(50, prose(60_000)), (51, "z" * 5_000), (52, "ab" * 3_000), (53, "\n".join([line.upper()] * 5)), (-4, shared), (99, rows[8][1])]
    return rows


def frame(spark, rows, extra=True):
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    if extra:
        for column in EXTRA.split(", "):
            name, kind = column.split()
            df = df.selectExpr("*", f"CAST(NULL AS {kind}) AS {name}")
    return df.repartition(3)


@pytest.fixture
def tiny_batches(spark):
    """Record batches of a few rows, so that what is carried between them matters."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "7")
    yield
    spark.conf.set(key, before)


@pytest.fixture
def edges(spark):
    rows = edge_rows()
    return frame(spark, rows), rows


@pytest.fixture
def awkward(spark):
    """Null ids and repeated rows besides; for defined results without a crash."""
    rows = [(None, "no id here " * 30), (None, None), (7, "twice " * 40), (7, "twice " * 40), (7, "other text under one id"), (8, "twice " * 40)]
    return frame(spark, rows), rows


@pytest.fixture
def nothing(spark):
    return frame(spark, [])
