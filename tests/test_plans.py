"""What the plans must not contain, whatever the data."""

import re

import pytest
from oracle_check import SMALL

from __spark_entry__ import LLM_QUERIES, queries

BUILDS = {name: build for name, build in queries().items() if name not in LLM_QUERIES}
# Windows over one row per day of all rooms together; nothing larger may be left unpartitioned.
DAILY = {"sales_ma7_all_rooms", "gmv_kpis"}
RUN_BY_BUILDING = {name for name in BUILDS if name.startswith("stream_")} | {
    "tsv_round_trip", "orc_overwrite", "ctas_product_ranking", "ods_landed", "evolved_metrics", "published_round_trip"
}


def test_no_plan_depends_on_counts_taken_while_it_is_built():
    import pathlib

    import roompulse

    folder = pathlib.Path(roompulse.__file__).parent
    for path in [*folder.glob("operators/*.py"), *folder.glob("functions/*.py"), *folder.glob("plans/*.py")]:
        assert not re.search(r"\.(collect|first|take|toPandas|toLocalIterator)\(|\.count\(\)|\.rdd\b|tempfile", path.read_text()), path


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(BUILDS) - RUN_BY_BUILDING))
def test_plan_stays_in_the_engine_and_partitioned(spark, name):
    plan = physical(BUILDS[name](spark, SMALL))
    for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "FlatMapGroups"):
        assert banned not in plan
    if name not in DAILY:
        for frame in re.findall(r"(?m)^.*\bWindow \[.*$", plan):
            assert not re.search(r"windowspecdefinition\([^,()]+ (ASC|DESC)", frame), frame


def test_scan_reads_only_what_is_needed(spark):
    plan = BUILDS["danmaku_tumble_1m"](spark, SMALL)
    text = plan._sc._jvm.PythonSQLUtils.explainString(plan._jdf.queryExecution(), "formatted")
    assert "documents.parquet" not in text
    events = text[text.index("events.parquet") :]
    assert "In(event_type, [click,purchase,view])" in events
    schema = re.search(r"ReadSchema: struct<([^>]*)>", events).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {"event_id", "ts", "event_type"}


def test_group_limit_comes_before_the_shuffle(spark):
    plan = physical(BUILDS["top_users"](spark, SMALL))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def scans(plan, table):
    return len(re.findall(rf"FileScan parquet [^\n]*/{table}\.parquet", plan))


@pytest.mark.parametrize("name", ["sentiment_room", "sentiment_quadrant", "keywords_tfidf", "word_cloud", "room_activity_matrix"])
def test_text_reports_deal_texts_out_and_read_them_once(spark, name):
    plan = physical(BUILDS[name](spark, SMALL))
    # One scan may count the documents; training and word counts are stored before.
    assert scans(plan, "documents") <= 2
    assert not re.search(r"BroadcastExchange[^\n]*text", plan)


def test_snapshots_read_the_messages_once(spark):
    assert scans(physical(BUILDS["room_snapshot"](spark, SMALL)), "events") == 1
