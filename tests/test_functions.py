"""Column functions on literal edge cases."""

from collections import Counter

from pyspark.sql import functions as F

from roompulse.functions.numbers import half_up, parse_count, percent, ratio, try_parse_count
from roompulse.functions.texts import STOP_WORDS, Terms, char_windows, is_topic_term, like_pattern, term_ranges, terms
from roompulse.functions.times import bucket_start, minute_text, parse_iso
from roompulse.operators.text import ngram_counts


def column(spark, values, kind, build):
    df = spark.createDataFrame([(v,) for v in values], f"x {kind}")
    return [r[0] for r in df.select(build(F.col("x"))).collect()]


def test_counts_written_for_people(spark):
    texts = ["1234", "1,234+", "1.2w", "1.2W", "43.6万", "3万", " 7 ", "n/a", "", None, "1.2.3", "-5", "0", "12.9"]
    want = [1234, 1234, 12000, 12000, 436000, 30000, 7, None, None, None, None, None, 0, 12]
    assert column(spark, texts, "string", try_parse_count) == want
    assert column(spark, texts, "string", parse_count) == [w or 0 for w in want]


def test_rates_round_half_up_exactly(spark):
    df = spark.createDataFrame([(1, 8), (1, 3), (2, 3), (1, 2000), (0, 5), (5, 0)], "a bigint, b bigint")
    got = df.select(ratio(F.col("a"), F.col("b"), 2), percent(F.col("a"), F.col("b"))).collect()
    assert [r[0] for r in got] == [0.13, 0.33, 0.67, 0.0, 0.0, None]
    assert [r[1] for r in got] == [12.5, 33.3, 66.7, 0.1, 0.0, 500.0]
    assert column(spark, [0.125, 2.5, -0.5], "double", lambda c: half_up(c, 0)) == [0.0, 3.0, 0.0]


def test_iso_times_with_and_without_fraction(spark):
    texts = ["2024-01-02T03:04:05.678901", "2024-01-02T03:04:05", "2024-01-02 03:04:05", "soon", None]
    got = column(spark, texts, "string", lambda c: F.date_format(parse_iso(c), "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    assert got == ["2024-01-02 03:04:05.678901", "2024-01-02 03:04:05.000000", None, None, None]
    assert column(spark, texts[:1], "string", lambda c: minute_text(parse_iso(c))) == ["2024-01-02 03:04:00"]


def test_buckets_are_half_open(spark):
    df = spark.sql("SELECT explode(array(timestamp_ntz'2024-01-01 10:04:59.999', timestamp_ntz'2024-01-01 10:05:00')) AS x")
    got = [r[0] for r in df.select(F.date_format(bucket_start(F.col("x"), 5), "HH:mm")).collect()]
    assert got == ["10:00", "10:05"]


def test_terms_of_latin_and_chinese_text(spark):
    got = column(spark, ["Hello, 2 wörld!", "主播好棒 nice棒棒", "", "😀😀", "a"], "string", terms)
    assert got == [["Hello", "2", "wörld"], ["nice", "主播", "播好", "好棒", "棒棒"], [], [], ["a"]]


def test_topic_terms(spark):
    got = column(spark, ["a", "ab", "12", "1a", "12.5", "棒棒"], "string", is_topic_term)
    assert got == [False, True, False, True, False, True]
    assert "没有" in STOP_WORDS and len(set(STOP_WORDS)) < 200


def brute_ngrams(texts):
    counts = {}
    for t in texts:
        for size in (2, 3, 4):
            for i in range(len(t) - size + 1):
                counts[t[i : i + size]] = counts.get(t[i : i + size], 0) + 1
    return counts


def test_ngrams_against_brute_force(spark):
    texts = ["主播666", "a😀b😀😀", "x", "", "line\nbreak", "aaaa", "é́é", "😀😀"]
    df = spark.createDataFrame([("r", t) for t in texts], "room_name string, text string")
    got = {r["word"]: r["count"] for r in ngram_counts(df).collect()}
    assert got == brute_ngrams(texts)
    assert column(spark, ["abc"], "string", char_windows) == [["abc", "bc"]]


def test_like_pattern_is_literal(spark):
    df = spark.createDataFrame([("50% off",), ("500 off",), ("a_b",), ("axb",), ("c\\d",)], "t string")

    def found(needle):
        return [r[0] for r in df.filter(F.ilike("t", F.lit(like_pattern(needle)))).collect()]

    assert found("50%") == ["50% off"]
    assert found("A_B") == ["a_b"]
    assert found("c\\d") == ["c\\d"]


def test_terms_counted_in_tasks_are_those_of_spark(spark):
    runs = ["".join(chr(c) for c in range(lo, lo + 4096) if not 0xD800 <= c < 0xE000) for lo in range(0, 0x110000, 4096)]
    texts = ["", "a1 b_c’s a1", "中文 好x好好好", "𠀀𠀁𠀂 中𠀀", "½Ⅷ x́ ͸Ꟁ 𞤀", *runs, *[" ".join(run) for run in runs], "好", "好"]
    expected = column(spark, texts, "string", terms)
    cut = Terms(term_ranges())
    for some in ([0], [1, 2], range(len(texts))):
        found, tf, df = cut.counts([texts[i] for i in some])
        got = {term: (int(n), int(m)) for term, n, m in zip(found.to_pylist(), tf, df)}
        often, lines = Counter(t for i in some for t in expected[i]), Counter(t for i in some for t in set(expected[i]))
        assert got == {term: (often[term], lines[term]) for term in often}
