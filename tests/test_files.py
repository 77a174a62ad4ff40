"""File, catalogue and database sinks."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from roompulse.operators import audience, warehouse
from roompulse.schemas import ODS_DANMAKU
from roompulse.sinks import files
from roompulse.sinks.database import upsert_batches, upsert_statement
from roompulse.sources.files import read_orc, read_tsv
from roompulse.sources.jdbc import jdbc_options

T0 = dt.datetime(2024, 1, 1)


def same(a, b):
    columns = sorted(a.columns)
    return a.select(columns).exceptAll(b.select(columns)).isEmpty() and b.select(columns).exceptAll(a.select(columns)).isEmpty()


def test_tsv_round_trip_of_awkward_text(spark, tmp_path):
    texts = ['plain', 'tab\there', 'quote " inside', 'line\nbreak', None, 'back\\slash', '"', '弹幕']
    rows = [("r", "R", "u", t, "chat", None, None, "2024-01-01T00:00:00.000000") for t in texts]
    df = spark.createDataFrame(rows, ODS_DANMAKU)
    files.write_tsv(df, str(tmp_path / "t"))
    assert same(read_tsv(spark, str(tmp_path / "t"), ODS_DANMAKU, line_breaks=True), df)


def test_landing_full_and_incremental(spark, views, tmp_path):
    path = str(tmp_path / "ods")
    rows = warehouse.ods_danmaku(views.danmaku)
    files.land(rows, path, full=True, day="2024-01-30")
    recent = warehouse.ods_danmaku(warehouse.last_hour(views.danmaku, mins=60 * 24))
    files.land(recent, path, full=False, day="2024-01-31")
    landed = read_tsv(spark, path, StructType([*ODS_DANMAKU.fields]).add("load_day", "string"), line_breaks=True)
    assert landed.count() == rows.count() + recent.count()
    assert same(landed.filter("load_day = '2024-01-31'").drop("load_day"), recent)
    files.land(rows, path, full=True, day="2024-02-01")
    assert read_tsv(spark, path, ODS_DANMAKU, line_breaks=True).count() == rows.count()


def test_orc_overwrite_by_partition(spark, tmp_path):
    path = str(tmp_path / "orc")
    first = spark.createDataFrame([("a", 1), ("b", 2)], "day string, n int")
    files.overwrite_orc(first, path, "day")
    files.overwrite_orc(spark.createDataFrame([("b", 3)], "day string, n int"), path, "day")
    assert {(r.day, r.n) for r in read_orc(spark, path).collect()} == {("a", 1), ("b", 3)}
    files.overwrite_orc(first, str(tmp_path / "flat"))
    files.overwrite_orc(first.limit(1), str(tmp_path / "flat"))
    assert read_orc(spark, str(tmp_path / "flat")).count() == 1


def test_tables_from_queries_and_new_columns(spark, views):
    ranking = warehouse.ads_product_ranking(views.orders)
    files.save_table(ranking, "ads_product_ranking")
    table = spark.table("ads_product_ranking")
    assert same(table, ranking)
    wider = ranking.withColumn("note", F.lit("x"))
    assert files.add_missing_columns(spark, "ads_product_ranking", wider.schema) == ["note"]
    assert files.add_missing_columns(spark, "ads_product_ranking", wider.schema) == []
    assert spark.table("ads_product_ranking").filter("note IS NULL").count() == ranking.count()
    spark.sql("DROP TABLE ads_product_ranking")


def test_csv_export(spark, views, tmp_path):
    newest = audience.export_latest(views.danmaku, 10)
    files.write_csv_export(newest, str(tmp_path / "csv"))
    back = spark.read.option("header", "true").option("escape", '"').option("multiLine", "true").csv(str(tmp_path / "csv"))
    assert back.columns == newest.columns and back.count() == newest.count()


def by_value(function):
    """The function without its module, which the tasks cannot import."""
    import types

    return types.FunctionType(function.__code__, {"__builtins__": __builtins__})


def recording_connection(folder):
    """A stand-in for a database connection that notes each statement's rows in a file of its own.

    The class is made here so that it travels to the tasks by value.
    """
    import uuid

    class Connection:
        def __init__(self):
            self.path = f"{folder}/{uuid.uuid4().hex}"

        def cursor(self):
            return self

        def executemany(self, statement, rows):
            with open(self.path, "a") as out:
                out.writelines(f"{len(rows)} {r[0]}\n" for r in rows)

        def commit(self):
            open(self.path + ".done", "w").close()

        def close(self):
            pass

    return Connection()


def test_database_upsert_sends_each_key_from_one_task(spark, tmp_path):
    folder = str(tmp_path)
    df = spark.range(2500).select((F.col("id") % 500).alias("k"), F.col("id").alias("v"))
    make = by_value(recording_connection)
    upsert_batches(lambda: make(folder), "t", ["k"], 4)(df, 0)
    sent = [p.read_text().split("\n")[:-1] for p in tmp_path.iterdir() if p.suffix != ".done"]
    keys = [{line.split()[1] for line in lines} for lines in sent]
    assert sum(map(len, sent)) == 2500
    assert sum(map(len, keys)) == len(set().union(*keys)) == 500
    assert max(int(line.split()[0]) for lines in sent for line in lines) <= 1000
    assert upsert_statement("t", ["k", "v"], ["k"]).endswith("ON DUPLICATE KEY UPDATE v = VALUES(v)")


def test_jdbc_reads_ranges():
    options = jdbc_options("jdbc:x", "danmaku", 1, 101, 4)
    assert (options["partitionColumn"], options["lowerBound"], options["upperBound"], options["numPartitions"]) == ("id", "1", "101", "4")


def test_intermediate_tables_need_a_shared_folder():
    import pytest

    from roompulse.session import shared_root

    assert shared_root("hdfs://a/b", "file:/w", "yarn") == "hdfs://a/b"
    assert shared_root(None, "hdfs://a/w", "yarn").startswith("hdfs://a/w/")
    assert shared_root(None, "/w", "local[4]").startswith("/w/")
    for warehouse in ("file:/w", "/w"):
        with pytest.raises(ValueError):
            shared_root(None, warehouse, "spark://a:1")


def test_intermediate_tables_can_be_cleared(spark, tmp_path):
    from roompulse.session import clear_shared_folders, shared_folder

    own = spark.newSession()
    before = shared_folder(own, "x").rsplit("/", 1)[0]
    assert before.endswith(spark.sparkContext.applicationId)
    assert files.stored(spark.range(3), "cleared").count() == 3
    clear_shared_folders(own)
    assert files.stored(spark.range(4), "after").count() == 4
