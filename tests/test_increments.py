"""Incremental landing, file generations, topic messages, sketches, texts in pieces."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from roompulse.operators import sketches
from roompulse.operators.common import upper_medians
from roompulse.operators.messages import route_params
from roompulse.sinks.landing import Landing
from roompulse.sinks.topics import as_messages, header, read_once, write_messages
from roompulse.sources.evolution import read_generations, united
from roompulse.sources.files import read_tsv

T0 = dt.datetime(2024, 1, 1)


def at(hour):
    return T0 + dt.timedelta(hours=hour)


def put_rows(df, path):
    df.write.mode("overwrite").parquet(path)


def table(spark, hours):
    return spark.createDataFrame([(i, at(h)) for i, h in enumerate(hours)], "id bigint, created_at timestamp_ntz")


def landed(spark, landing):
    return sorted((r.load_number, r.id) for r in landing.read(spark.read.parquet).collect())


def test_increments_take_what_is_behind_the_mark_and_repeats_replace_themselves(spark, tmp_path):
    landing = Landing(spark, str(tmp_path), put_rows)
    assert landing.load(table(spark, [1, 2, 3]), "a") == (None, at(3))
    assert landing.load(table(spark, [1, 2, 3, 4, 5]), "b") == (at(3), at(5))
    # Run again after more rows came: the same bounds, the same rows.
    assert landing.load(table(spark, [1, 2, 3, 4, 5, 6]), "b") == (at(3), at(5))
    assert landed(spark, landing) == [(0, 0), (0, 1), (0, 2), (1, 3), (1, 4)]
    # A load that stopped after its mark and before its rows is made good under its name.
    again = Landing(spark, str(tmp_path), lambda df, path: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        again.load(table(spark, [1, 2, 3, 4, 5, 6]), "c")
    landing.load(table(spark, [1, 2, 3, 4, 5, 6, 7]), "c")
    assert landed(spark, landing)[-1:] == [(2, 5)]
    assert landing.load(table(spark, [1, 2, 3, 4, 5, 6]), "nothing new") == (at(6), at(6))
    assert len(landed(spark, landing)) == 6
    landing.load(table(spark, [1, 2]), "full", full=True)
    assert landed(spark, landing) == [(4, 0), (4, 1)]


def test_landed_text_is_compressed_and_comes_back_whole(spark, tmp_path):
    schema = StructType().add("id", "long").add("text", "string").add("created_at", "timestamp_ntz")
    said = ['two\nlines\tand "quotes"' * 500, None, "直播\n觉得" * 500, "a"]
    rows = [(i, text, at(i)) for i, text in enumerate(said)]
    landing = Landing(spark, str(tmp_path / "rows"))
    for _ in range(2):
        landing.load(spark.createDataFrame(rows, schema).coalesce(1), "all")
    back = landing.read(lambda path: read_tsv(spark, path, schema, line_breaks=True))
    assert sorted((r.id, r.text, r.created_at) for r in back.collect()) == rows
    files = [f for f in (tmp_path / "rows" / "rows").rglob("*") if f.is_file() and not f.name.startswith(("_", "."))]
    assert sum(f.stat().st_size for f in files) < sum(len(t.encode()) for t in said if t) // 10


def test_increment_bounds_reach_the_scan(spark, tmp_path):
    table(spark, range(50)).write.parquet(str(tmp_path / "source"))
    rows = Landing.between(spark.read.parquet(str(tmp_path / "source")), "created_at", at(3), at(5))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(created_at,2024-01-01T03:00), LessThanOrEqual(created_at,2024" in plan
    assert rows.count() == 2


def test_landing_of_an_empty_table(spark, tmp_path):
    landing = Landing(spark, str(tmp_path), put_rows)
    assert landing.load(spark.createDataFrame([], "id bigint, created_at timestamp_ntz"), "a") == (None, None)
    assert landed(spark, landing) == []


def test_schemas_unite():
    a = StructType.fromDDL("id int, x float, d decimal(5,1), s struct<a: int>")
    b = StructType.fromDDL("ID bigint, x double, d decimal(6,3), s struct<a: bigint, b: string>, extra string")
    assert united(a, b) == StructType.fromDDL("id bigint, x double, d decimal(7,3), s struct<a: bigint, b: string>, extra string")
    assert united(b, a).simpleString() == "struct<ID:bigint,x:double,d:decimal(7,3),s:struct<a:bigint,b:string>,extra:string>"
    with pytest.raises(TypeError):
        united(StructType.fromDDL("a int"), StructType.fromDDL("a string"))


@pytest.mark.parametrize("file_format", ["parquet", "orc"])
def test_generations_are_read_as_one(spark, tmp_path, file_format):
    frames = [spark.sql("SELECT 1 AS id, 7 AS n"), spark.sql("SELECT 2L AS id, 3000000000 AS n, 'x' AS note"), spark.sql("SELECT 'y' AS note, 3 AS id")]
    paths = [str(tmp_path / str(i)) for i in range(3)]
    for df, path in zip(frames, paths):
        df.write.format(file_format).save(path)
    got = read_generations(spark, paths, file_format)
    assert dict(got.dtypes) == {"id": "bigint", "n": "bigint", "note": "string"}
    assert sorted(map(tuple, got.collect())) == [(1, 7, None), (2, 3_000_000_000, "x"), (3, None, "y")]


def test_repeated_messages_are_read_once(spark, tmp_path):
    rows = spark.createDataFrame([("t", "k", "v", 1), ("t", "k", "v", 2), ("u", "k", "w", 1)], "topic string, key string, value string, n bigint")
    made = as_messages(rows, F.col("n"))
    for _ in range(3):
        write_messages(made, "parquet", path=str(tmp_path / "m"))
    back = spark.read.parquet(str(tmp_path / "m"))
    assert back.count() == 9
    assert sorted((r.topic, r.value) for r in read_once(back).collect()) == [("t", "v"), ("t", "v"), ("u", "w")]
    bare = rows.select("topic", "key", "value", F.lit(None).cast("array<struct<key:string,value:binary>>").alias("headers"))
    assert read_once(bare).count() == 3 and bare.select(header("x").alias("x")).first().x is None


def test_sketches_unite_and_stay_near(spark):
    rows = spark.range(60_000).selectExpr(
        "'r' AS room_name", "CASE WHEN id % 50 > 0 THEN concat('u', id % 20000) END AS username", "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, id % 2000) AS created_at"
    )
    got = {(r.unit, r.start.day, r.start.hour): r.estimate for r in sketches.active_users(rows).collect()}
    exact = rows.filter("username IS NOT NULL")
    for day in (1, 2):
        want = exact.filter(F.dayofmonth("created_at") == day).select("username").distinct().count()
        assert abs(got["day", day, 0] - want) <= sketches.DISTINCT_ERROR * want
    assert len(got) == 2 + 34


def test_merged_medians_are_near_the_middle(spark):
    rows = spark.range(30_000).selectExpr("id % 3 AS room_name", "id % 7 AS day", "pow(id * 7919 % 30011, 2) AS a", "id % 2 AS b").selectExpr("*", "CAST(a AS bigint) AS n")
    parts = sketches.quantile_sketches(rows, ["room_name", "day"], ["n", "b"])
    found = sketches.medians(sketches.merged_quantiles(parts, ["room_name"], ["n", "b"]), ["room_name"], ["n", "b"])
    errors = sketches.rank_error(rows, ["room_name"], found, ["n", "b"]).collect()
    assert len(errors) == 3 and all(r.n <= sketches.RANK_ERROR and r.b <= sketches.RANK_ERROR for r in errors)
    exact = upper_medians(rows, ["room_name"], {"n": "n"})
    assert all(r.n <= 1 / 10_000 for r in sketches.rank_error(rows, ["room_name"], exact.withColumnRenamed("n", "m").selectExpr("room_name", "m AS n"), ["n"]).collect())


def test_texts_of_a_busy_user_come_in_pieces(spark):
    chats = [("r", "busy", i * 37 % 1000, f"t{i * 37 % 1000}") for i in range(1000)] + [("r", None, 5, "x"), ("r", None, 3, "y"), ("r", "quiet", 9, None), ("r", "quiet", 2, "")]
    df = spark.createDataFrame(chats, "room_name string, username string, id bigint, text string").repartition(5)
    got = {(r.username, r.piece): r for r in sketches.user_texts(df, 64, "|", id_range=100).collect()}
    assert len([k for k in got if k[0] == "busy"]) == 16
    assert "|".join(got["busy", i].texts for i in range(16)) == "|".join(f"t{i}" for i in range(1000))
    assert got[None, 0].texts == "y|x" and got["quiet", 0].texts == "" and got["quiet", 0].chats == 1


def test_route_params_of_damaged_and_bare_responses(spark):
    rows = [(1, "r", '{"routeParams":{"a":"1","b":"2"}}'), (2, "r", '{"routeParams":{"a":"3"}}'), (3, "r", "{damaged"), (4, "r", "{}"), (5, "r", '{"routeParams":{"a":"1"}}')]
    got = route_params(spark.createDataFrame(rows, "id bigint, room_id string, response string"), ["a", "c"]).collect()
    assert [(r.param, r.uses, r.settings, r.setting, r.last_id) for r in got] == [("a", 3, 2, "1", 5)]
