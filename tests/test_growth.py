"""Reports that must keep their shuffles and memory small on larger tables."""

import re
import time
from collections import Counter
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from oracle_check import SMALL
from roompulse.operators import text
from roompulse.operators.common import newest_rows
from roompulse.operators.recommend import PASSES, _best_partners, pair_counts
from roompulse.operators.sketches import user_texts
from roompulse.plans.catalog import QUERIES, envelopes
from roompulse.plans.views import Views
from roompulse.sinks.files import stored
from roompulse.streaming import replay


@pytest.fixture
def no_small_tables(spark):
    """Every table counts as too large to be sent to all executors unless a plan says so."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["sentiment_score", "sentiment_quadrant"])
def test_sentiment_sums_terms_before_the_shuffle(spark, no_small_tables, name):
    # Below the explosion into terms comes a broadcast join and a partial sum, no exchange.
    lines = physical(QUERIES[name](Views(spark, SMALL))).splitlines()
    at = next(i for i, line in enumerate(lines) if "Generate posexplode" in line)
    above = next(line for line in reversed(lines[:at]) if re.search(r"Exchange hashpartitioning|SortMergeJoin|HashAggregate", line))
    assert "partial_sum" in above
    assert any("BroadcastHashJoin [term" in line for line in lines[:at])


def test_seldom_terms_count_as_much_as_common_ones(views):
    labelled = views.labelled_texts.limit(200).localCheckpoint()
    lines = text.chat_lines(views.danmaku).limit(500).localCheckpoint()
    found, users = [], []
    for most in (0, 50, text.COMMON_TERMS):
        model = text.train_sentiment(labelled, most)
        assert model.filter("common").count() <= most
        found.append(sorted(tuple(map(str, r)) for r in text.sentiment_score(lines, model).collect()))
        users.append(sorted(tuple(map(str, r)) for r in text.sentiment_users(lines, model).collect()))
    assert found[0] == found[1] == found[2] and len({r[4] for r in found[0]}) > 1
    assert users[0] == users[1] == users[2]


def test_cleaned_messages_do_not_shuffle_texts_by_id(views):
    plan = physical(QUERIES["dwd_danmaku"](views))
    # Texts lie behind the join by document; from there to the result no exchange moves them.
    assert "BroadcastHashJoin [id" in plan
    assert not re.search(r"Exchange hashpartitioning\(id#[^\n]*\n[^\n]*doc_text", plan)


def test_newest_rows_are_cut_before_the_shuffle(spark, views, no_small_tables):
    rows = newest_rows(views.danmaku, ["room_name"], "id", 5)
    assert "BroadcastHashJoin [room_name" in physical(rows)
    assert rows.groupBy("room_name").count().filter("count <> 5").count() == 0


def test_user_texts_share_one_shuffle(spark, no_small_tables):
    rows = [(i, "R", None if i % 3 == 0 else "u", "t%d" % i) for i in range(12)] + [(2, "R", "u", "again")]
    chats = spark.createDataFrame(rows, "id bigint, room_name string, username string, text string")
    joined = user_texts(chats, 5, id_range=4)
    got = {(r.username, r.piece): (r.first_id, r.last_id, r.texts) for r in joined.collect()}
    assert got == {
        (None, 0): (0, 9, "t0\nt3\nt6\nt9"),
        ("u", 0): (1, 5, "t1\nagain\nt2\nt4\nt5"),
        ("u", 1): (7, 11, "t7\nt8\nt10\nt11"),
    }
    # The join takes the rows as the window left them; other keys would shuffle all texts once more.
    assert not re.search(r"hashpartitioning\([^\n]*(coalesce|isnull)\(", physical(joined))


@pytest.mark.parametrize("kind", ["bigint", "string"])
@pytest.mark.parametrize("heavy, block, least, k", [(100_000, 512, 1, None), (3, 5, 2, None), (2, 4, 1, 3), (100_000, 512, 1, 2)])
def test_pairs_are_counted_whole_in_shares_and_batches(spark, kind, heavy, block, least, k):
    baskets = {c: {(c * i * 7 + i * i) % 23 for i in range(2 + c % 9)} | {1} for c in range(40)}
    rows = [(f"c{c}", str(p) if kind == "string" else p) for c, items in baskets.items() for p in items]
    counts = Counter(pair for c in baskets for pair in permutations(sorted(p for o, p in rows if o == f"c{c}"), 2))
    items = spark.createDataFrame([*rows, (None, rows[0][1]), ("c1", None)], f"customer_id string, product_id {kind}")
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "7")
    try:
        got = {(r.p1, r.p2): r.co_count for r in pair_counts(items, block, least, k, heavy).collect()}
    finally:
        spark.conf.set(name, before)
    if k is None:
        assert got == {(a, b): n for (a, b), n in counts.items() if a < b and n >= least}
    else:
        assert got.items() <= counts.items()
        for p in {a for a, _ in counts}:
            ranked = [[b for _, b in sorted((-n, b) for (a, b), n in some.items() if a == p)[:k]] for some in (counts, got)]
            assert ranked[0] == ranked[1]


def test_pairs_are_shuffled_as_blocks(spark, no_small_tables):
    plan = physical(QUERIES["cooccurrence_recs"](Views(spark, SMALL)))
    lines = plan.splitlines()
    counted = next(i for i, line in enumerate(lines) if "MapInArrow" in line)
    below = next(line for line in lines[counted:] if "Exchange" in line)
    # A row for each product of a block, not one for each pair, goes to the counting tasks.
    assert "hashpartitioning(product_id" in below


def test_one_part_of_the_pairs_is_shuffled_at_a_time(spark, no_small_tables):
    plan = physical(QUERIES["cooccurrence_recs"](Views(spark, SMALL)))
    # The last part alone: baskets and the partners of the other parts are stored by then.
    assert plan.count("MapInArrow") == 1 and "pmod(xxhash64(lambda" in plan
    assert "lineitem.parquet" not in plan


@pytest.mark.parametrize("passes, block, heavy", [(1, 512, 100_000), (3, 5, 7), (4, 2, 2)])
def test_partners_are_the_same_in_any_number_of_parts(spark, passes, block, heavy):
    rows = [(f"c{c}", p) for c in range(40) for p in {(c * i * 7 + i * i) % 23 for i in range(2 + c % 9)} | {1}]
    counts = Counter(pair for c in {c for c, _ in rows} for pair in permutations(sorted(p for o, p in rows if o == c), 2))
    items = spark.createDataFrame([*rows, (None, 1), ("c1", None), ("alone", 2)], "customer_id string, product_id int")
    want = set()
    for p in {a for a, _ in counts}:
        own = sorted((-n, b) for (a, b), n in counts.items() if a == p)[:5]
        want |= {(p, b, -n, rank) for rank, (n, b) in enumerate(own, 1)}
    got = _best_partners(items, 5, block, passes, heavy).collect()
    assert {(r.product_id, r.rec_product_id, r.score, r["rank"]) for r in got} == want and len(got) == len(want)


def test_shuffle_files_of_a_stored_table_go_at_once(spark):
    def shuffles():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
        return set(re.findall(r"shuffle_\d+_\d+_\d+\.data", files))

    before, name = shuffles(), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    set_to = spark.conf.get(name)
    df = spark.range(10_000).groupBy((F.col("id") % 100).alias("k")).agg(F.collect_list("id").alias("ids"))
    written = stored(df, "freed", freed=True)
    deadline = time.monotonic() + 20
    while shuffles() - before and time.monotonic() < deadline:
        time.sleep(0.2)
    assert not shuffles() - before and spark.conf.get(name) == set_to
    assert written.count() == 100


def test_windows_are_counted_by_number(spark, monkeypatch):
    texts = ["abab abab", "", "a", "直播直播间", "𝒳a𝒳a\x00\x00", "\x00\x00", "".join(map(chr, range(0x4E00, 0x4E40)))]
    want = Counter(t[i : i + 4] for t in texts for i in range(len(t) - 1))
    for at_once in (3, text.WINDOWS_AT_ONCE):
        monkeypatch.setattr(text, "WINDOWS_AT_ONCE", at_once)
        got = Counter()
        for words, counts in text.window_counts(texts):
            got.update(dict(zip(words.to_pylist(), counts.tolist())))
        assert got == want
    lines = spark.createDataFrame([("R", t) for t in texts] + [(None, "aba"), ("R", None)], "room_name string, text string")
    rows = {(r.room_name, r.word): r["count"] for r in text.ngram_counts(lines).collect()}
    short = Counter(("R", t[i : i + n]) for t in texts for n in (2, 3, 4) for i in range(len(t) - n + 1))
    assert rows == short | Counter([(None, "ab"), (None, "ba"), (None, "aba")])
    # Texts go to the counting once; no row of a place is made.
    assert "regexp_extract_all" not in physical(text.ngram_counts(lines))


def test_replayed_slices_are_dealt_out(views, monkeypatch):
    seen, real = [], replay.jobs.count_types

    def watched(*args, **options):
        query = real(*args, **options)
        query.awaitTermination()
        seen.append(query._jsq.explainInternal(False))
        return query

    monkeypatch.setattr(replay.jobs, "count_types", watched)
    replay.message_type_counts(views, envelopes)
    # The reading task hands rows on as they are; payloads are parsed behind the exchange.
    above, below = seen[0].split("RoundRobinPartitioning")
    assert "from_json" in above and "from_json" not in below
