"""Chat text reports: sentiment, keywords, word counts and character n-grams."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow.compute import take
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roompulse.functions.numbers import half_up, percent, ratio
from roompulse.functions.texts import STOP_WORDS, Terms, is_topic_term, term_ranges, terms
from roompulse.functions.times import bucket_start, clock, minutes
from roompulse.operators.audience import by_chats, is_chat
from roompulse.operators.common import newest_rows, only, top_per_key
from roompulse.sinks.files import stored

# Sentiment labels and the scores that separate them.
POSITIVE = "正面"
NEGATIVE = "负面"
NEUTRAL = "中性"
POSITIVE_ABOVE = 0.6
NEGATIVE_BELOW = 0.4

# Histogram bins by upper bound in thousandths.
BINS = (
    (200, "0.0-0.2(极度负面)"),
    (400, "0.2-0.4(较为负面)"),
    (600, "0.4-0.6(中性)"),
    (800, "0.6-0.8(较为正面)"),
    (1001, "0.8-1.0(非常正面)"),
)

# Activity and sentiment quadrants.
FANS = "忠实粉丝"
UPSET = "情绪用户"
GOODWILL = "路人好感"
AT_RISK = "流失风险"
QUADRANTS = (FANS, UPSET, GOODWILL, AT_RISK)

MICRO = 1_000_000
# At most so many terms of a model, the most frequent ones, are sent to every executor.
COMMON_TERMS = 1 << 20
# Beyond this log-odds the score is 0 or 1 to any printed digit.
LOG_ODDS_LIMIT = 50.0
#: Stands behind the last character of a text; no code point.
END = 0x110000
#: Places of texts whose character sequences are counted at once.
WINDOWS_AT_ONCE = 1 << 20
#: Bytes of texts whose terms are counted at once; a longer text is counted whole.
TEXTS_AT_ONCE = 1 << 22


def chat_lines(danmaku: DataFrame, room: str | None = None, latest: int | None = None) -> DataFrame:
    """Chats that have a text, all of them unless only the ``latest`` per room are wanted."""
    chats = only(danmaku, room_name=room).filter(is_chat() & F.col("text").isNotNull())
    if latest:
        chats = newest_rows(chats, ["room_name"], "id", latest).select(*danmaku.columns)
    return chats


# --- sentiment ---------------------------------------------------------------


def _common(counts: DataFrame, most: int) -> Column:
    """Whether a term is seen so often that no more than ``most`` terms are seen as often; the least count is 1, 2, 3, 4, 6, 8, 12 ..."""
    seen = F.col("pos") + F.col("neg")
    steps = sorted({f << i for i in range(40) for f in (1, 3)})
    least = F.coalesce(*[F.when(F.count_if(seen >= step) <= most, F.lit(step)) for step in steps])
    return F.coalesce(seen >= counts.agg(least).scalar(), F.lit(False))


def train_sentiment(labelled: DataFrame, common_terms: int = COMMON_TERMS) -> DataFrame:
    """Multinomial naive Bayes as one aggregation: a log-odds weight per term.

    The texts are read once: counts of terms, and of the texts themselves (the row without a term), are stored, and
    totals and prior come from those few rows.  Weights are whole millionths, so their sums do not depend on row order.
    The class prior sits in every row to keep the model a single frame; ``common`` marks the most frequent terms.
    """
    positive, no_term = F.col("positive"), F.array(F.lit(None).cast("string"))
    word = F.explode(F.concat(F.coalesce(terms(F.col("text")), F.array().cast("array<string>")), no_term)).alias("term")
    counted = (
        labelled.select(positive, word)
        .groupBy("term")
        .agg(F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg"))
    )
    counted = stored(counted, "sentiment-counts")
    counts, texts = counted.filter(F.col("term").isNotNull()), counted.filter(F.col("term").isNull())
    totals = counts.agg(F.struct(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.count("*").alias("terms")))
    prior = texts.agg(F.ln((F.max("pos") + 1) / (F.max("neg") + 1)))
    t = totals.scalar()
    share_pos = (F.col("pos") + 1) / (t["pos"] + t["terms"])
    share_neg = (F.col("neg") + 1) / (t["neg"] + t["terms"])
    return counts.select(
        "term",
        half_up((F.ln(share_pos) - F.ln(share_neg)) * MICRO).cast("bigint").alias("weight"),
        half_up(prior.scalar() * MICRO).cast("bigint").alias("prior"),
        _common(counts, common_terms).alias("common"),
    )


def _prior(model: DataFrame) -> Column:
    return F.coalesce(model.agg(F.max("prior")).scalar(), F.lit(0))


def _raw_score(log_odds: Column) -> Column:
    """Sigmoid of a sum of millionths."""
    x = log_odds / float(MICRO)
    x = F.greatest(F.least(x, F.lit(LOG_ODDS_LIMIT)), F.lit(-LOG_ODDS_LIMIT))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def _label(score: Column) -> Column:
    return F.when(score > POSITIVE_ABOVE, POSITIVE).when(score < NEGATIVE_BELOW, NEGATIVE).otherwise(NEUTRAL)


def _summed_weights(lines: DataFrame, keys: Sequence[str], model: DataFrame) -> DataFrame:
    """Lines, summed weights (0 for an unknown term) and whether any or all lines are empty, by ``keys``.

    The common terms, a bounded number, go to the terms of the lines and are summed in the task that reads a line.  Only
    what they leave over, a row per key and other term, is shuffled to the rest of the model.
    """
    common = F.broadcast(model.filter("common").select("term", "weight"))
    exploded = lines.select(*keys, (F.col("text") == "").alias("empty"), F.posexplode_outer(terms(F.col("text"))).alias("pos", "term"))
    left_over = F.when(F.col("weight").isNull(), F.col("term")).alias("rest")
    partly = (
        exploded.join(common, "term", "left")
        .groupBy(*keys, left_over)
        .agg(
            F.count("*").alias("n"),
            F.count_if(F.coalesce("pos", F.lit(0)) == 0).alias("lines"),
            F.coalesce(F.sum("weight"), F.lit(0)).alias("w"),
            F.bool_or("empty").alias("any_empty"),
            F.bool_and("empty").alias("all_empty"),
        )
    )
    # Sums without a term left over get a key of their own, which no term equals, so that they spread as well.
    other = F.coalesce("rest", F.concat(F.lit(" "), F.xxhash64(*keys).cast("string")))
    seldom = model.filter("NOT common").select(F.col("term").alias("other"), F.col("weight").alias("seldom"))
    weight = F.col("w") + F.col("n") * F.coalesce("seldom", F.lit(0))
    return (
        partly.withColumn("other", other)
        .join(seldom, "other", "left")
        .groupBy(*keys)
        .agg(
            F.sum("lines").alias("cnt"), F.sum(weight).alias("w"), F.bool_or("any_empty").alias("any_empty"), F.bool_and("all_empty").alias("all_empty")
        )
    )


def sentiment_score(lines: DataFrame, model: DataFrame) -> DataFrame:
    """Score (three decimals) and label of every chat line."""
    summed = _summed_weights(lines, ["id", "room_name", "username", "created_at"], model)
    raw = F.when(F.col("any_empty"), F.lit(0.5)).otherwise(_raw_score(F.col("w") + _prior(model)))
    return summed.withColumn("raw", raw).select(
        "id",
        "room_name",
        "username",
        "created_at",
        half_up(F.col("raw"), 3).alias("score"),
        _label(F.col("raw")).alias("label"),
    )


def _milli() -> Column:
    return half_up(F.col("score") * 1000).cast("bigint")


def sentiment_room(scores: DataFrame) -> DataFrame:
    """Counts, shares and mean of the scores of each room."""
    is_label = {"positive": POSITIVE, "negative": NEGATIVE, "neutral": NEUTRAL}
    per_room = scores.groupBy("room_name").agg(
        F.count("*").alias("total"),
        *[F.count_if(F.col("label") == label).alias(name) for name, label in is_label.items()],
        F.sum(_milli()).alias("milli"),
    )
    return per_room.select(
        "room_name",
        "total",
        *is_label,
        *[percent(F.col(name), F.col("total")).alias(f"{name}_rate") for name in is_label],
        half_up(ratio(F.col("milli"), F.col("total"), 0) / 1000.0, 3).alias("avg_score"),
    )


def _bin_counts() -> list[Column]:
    columns, low = [], 0
    for i, (high, _) in enumerate(BINS):
        columns.append(F.count_if((_milli() >= low) & (_milli() < high)).alias(f"b{i}"))
        low = high
    return columns


def sentiment_hist(scores: DataFrame) -> DataFrame:
    """Lines in each of five score bins per room, empty bins included."""
    per_room = scores.groupBy("room_name").agg(*_bin_counts())
    bins = F.array(
        *[F.struct(F.lit(name).alias("bin"), F.col(f"b{i}").alias("cnt")) for i, (_, name) in enumerate(BINS)]
    )
    return per_room.select("room_name", F.inline(bins))


def sentiment_timeline(
    danmaku: DataFrame, model: DataFrame, interval: int = 5, periods: int = 24, room: str | None = None, as_of=None
) -> DataFrame:
    """Mean score and line count of the last ``periods`` buckets of ``interval`` minutes.

    The time filter comes first, so only the lines reported on are cut into terms.
    """
    first = bucket_start(clock(danmaku, "created_at", as_of), interval) - minutes(interval * (periods - 1))
    lines = chat_lines(danmaku, room).filter(F.col("created_at") >= first)
    scores = sentiment_score(lines, model)
    bucket = bucket_start(F.col("created_at"), interval).alias("bucket")
    per_bucket = scores.groupBy("room_name", bucket).agg(F.sum(_milli()).alias("milli"), F.count("*").alias("cnt"))
    return per_bucket.select(
        "room_name",
        "bucket",
        F.date_format("bucket", "HH:mm").alias("time"),
        (ratio(F.col("milli"), F.col("cnt"), 0) / 1000.0).alias("avg_sentiment"),
        "cnt",
    )


def sentiment_users(
    danmaku: DataFrame, model: DataFrame, min_chats: int = 2, room: str | None = None, cap: int | None = None
) -> DataFrame:
    """Score and quadrant of each user's chats taken together.

    Term weights are summed straight per user, which scores the joined text
    without ever building it.
    """
    lines = chat_lines(danmaku, room)
    per_user = _summed_weights(lines, ["room_name", "username"], model).filter(F.col("cnt") >= min_chats)
    if cap:
        per_user = top_per_key(per_user, ["room_name"], by_chats(), cap).drop("rank")
    raw = F.when(F.col("all_empty"), F.lit(0.5)).otherwise(_raw_score(F.col("w") + _prior(model)))
    label = _label(raw)
    quadrant = (
        F.when((F.col("cnt") >= 10) & (label == POSITIVE), FANS)
        .when((F.col("cnt") >= 10) & (label == NEGATIVE), UPSET)
        .when((F.col("cnt") < 10) & label.isin(POSITIVE, NEUTRAL), GOODWILL)
        .otherwise(AT_RISK)
    )
    return per_user.select(
        "room_name", "username", "cnt", half_up(raw, 3).alias("sentiment"), quadrant.alias("quadrant")
    )


def sentiment_quadrant(users: DataFrame) -> DataFrame:
    """Users in each quadrant per room, empty quadrants included."""
    per_room = users.groupBy("room_name").agg(
        *[F.count_if(F.col("quadrant") == q).alias(f"q{i}") for i, q in enumerate(QUADRANTS)]
    )
    entries = F.array(
        *[F.struct(F.lit(q).alias("quadrant"), F.col(f"q{i}").alias("users")) for i, q in enumerate(QUADRANTS)]
    )
    return per_room.select("room_name", F.inline(entries))


def sentiment_quadrant_samples(users: DataFrame, k: int = 3) -> DataFrame:
    return top_per_key(users, ["room_name", "quadrant"], by_chats(), k)


def room_activity_matrix(hist: DataFrame, levels: DataFrame) -> DataFrame:
    """Sentiment bins and activity levels of each room in one row."""
    wide = hist.groupBy("room_name").agg(
        *[
            F.coalesce(F.sum(F.when(F.col("bin") == name, F.col("cnt"))), F.lit(0)).alias(f"bin_{i}")
            for i, (_, name) in enumerate(BINS)
        ]
    )
    active = levels.select("room_name", "high_active", "mid_active", "low_active")
    # A room of gifts alone has activity but no sentiment, hence the outer side.
    bins = [F.coalesce(f"bin_{i}", F.lit(0)).alias(f"bin_{i}") for i in range(len(BINS))]
    return active.join(wide, "room_name", "left").select("room_name", *bins, *active.columns[1:])


# --- words -------------------------------------------------------------------


def _without_stop_words(df: DataFrame, stop_words=STOP_WORDS) -> DataFrame:
    """Anti join against the fixed list of stop words."""
    words = df.sparkSession.createDataFrame([(w,) for w in sorted(set(stop_words))], "term string")
    return df.join(F.broadcast(words), "term", "left_anti")


def by_room(part: pa.RecordBatch, size: int) -> Iterator[tuple[pa.Scalar, list[str]]]:
    """The texts of a batch (room_name, text in bytes) by room, in slices of about so many bytes."""
    rooms = part.column("room_name").dictionary_encode(null_encoding="encode")
    room, texts = rooms.indices.to_numpy(), part.column("text")
    for number, room_name in enumerate(rooms.dictionary):
        own = take(texts, pa.array(np.flatnonzero(room == number)))
        cuts = np.flatnonzero(np.diff(np.cumsum(pc.binary_length(own).to_numpy()) // size)) + 1
        for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(own)]):
            yield room_name, [t.as_py().decode("utf-8", "replace") for t in own[lo:hi]]


def term_counts(lines: DataFrame) -> DataFrame:
    """Occurrences of each room's terms (tf) and the lines that hold them (df), counted batch by batch before they become rows.

    A term has several rows, to be added up; those without a term say how many lines there are.
    """
    names, ranges = ["room_name", "term", "tf", "df"], term_ranges()

    def counted(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = Terms(ranges)
        for part in parts:
            for room_name, texts in by_room(part, TEXTS_AT_ONCE):
                found, tf, df = cut.counts(texts)
                found = pa.concat_arrays([found, pa.nulls(1, pa.string())])
                counts = [pa.array(np.append(tf, 0), pa.int64()), pa.array(np.append(df, len(texts)), pa.int64())]
                yield pa.RecordBatch.from_arrays([pa.repeat(room_name, len(found)), found, *counts], names=names)

    texts = lines.select("room_name", F.col("text").cast("binary").alias("text"))
    return texts.mapInArrow(counted, "room_name string, term string, tf bigint, df bigint")


def keywords_tfidf(
    danmaku: DataFrame, k: int = 50, room: str | None = None, latest: int | None = None
) -> DataFrame:
    """The ``k`` terms of each room with the highest TF-IDF weight.

    Term and document frequencies come from one pass, counted before anything is
    shuffled.  The counts are stored, and every total is taken from them.
    """
    long_enough = F.char_length("text") >= 2
    lines = chat_lines(danmaku, None, latest).filter(long_enough).select("room_name", "text")
    counted = term_counts(lines).filter(F.col("term").isNull() | is_topic_term(F.col("term")))
    counted = counted.groupBy("room_name", "term").agg(F.sum("tf").alias("tf"), F.sum("df").alias("df_room"))
    counted = stored(_without_stop_words(counted), "keyword-counts")
    counts, line_counts = counted.filter(F.col("term").isNotNull()), counted.filter(F.col("term").isNull())
    spread = counts.groupBy("term").agg(F.sum("df_room").alias("df"))
    totals = counts.groupBy("room_name").agg(F.sum("tf").alias("room_terms"))
    n_lines = F.coalesce(line_counts.agg(F.sum("df_room")).scalar(), F.lit(0))
    idf = F.ln((n_lines + 1) / (F.col("df") + 1))
    weighted = (
        only(counts, room_name=room)
        .join(spread, "term")
        .join(totals, "room_name")
        .withColumn("w", F.col("tf") * idf / F.col("room_terms"))
    )
    best = top_per_key(weighted, ["room_name"], (F.col("w").desc(), F.col("term").asc()), k)
    return best.select(
        "room_name", "rank", F.col("term").alias("word"), "tf", "df", half_up(F.col("w"), 6).alias("weight")
    )


def word_cloud(
    danmaku: DataFrame, k: int = 100, min_count: int = 2, room: str | None = None, latest: int | None = None
) -> DataFrame:
    """The ``k`` most frequent terms of each room."""
    lines = chat_lines(danmaku, room, latest).filter(F.char_length("text") >= 2)
    counts = term_counts(lines).filter(is_topic_term(F.col("term"))).groupBy("room_name", "term").agg(F.sum("tf").alias("value"))
    counts = _without_stop_words(counts)
    best = top_per_key(counts, ["room_name"], (F.col("value").desc(), F.col("term").asc()), k)
    return best.filter(F.col("value") >= min_count).select("room_name", "rank", F.col("term").alias("name"), "value")


def window_counts(texts: list[str], width: int = 4) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """The distinct sequences of two to ``width`` characters that start at each character but the last, and how often.

    Characters are numbered, so a sequence is one whole number and counting is a sort; a sequence may come again from
    the next ``WINDOWS_AT_ONCE`` places.
    """
    # Behind each text stand as many ends as the longest sequence can meet.
    ends = np.full(width - 1, END, np.uint32)
    stacked = np.concatenate([x for t in texts for x in (np.frombuffer(t.encode("utf-32-le", "replace"), np.uint32), ends)])
    todo = [(lo, min(lo + WINDOWS_AT_ONCE, len(stacked) - width + 1)) for lo in range(0, len(stacked) - width + 1, WINDOWS_AT_ONCE)]
    while todo:
        lo, hi = todo.pop()
        chars = stacked[lo : hi + width - 1]
        # END is the largest, so it is numbered 0 once the order is turned round.
        known = np.flatnonzero(np.bincount(chars, minlength=END + 1))[::-1]
        known = known if known[0] == END else np.concatenate([[END], known])
        if len(known) ** width >= 1 << 62:
            todo += [(lo, (lo + hi) // 2), ((lo + hi) // 2, hi)]
            continue
        numbers = np.zeros(END + 1, np.int64)
        numbers[known] = np.arange(len(known))
        coded = numbers[chars]
        keys = np.zeros(hi - lo, np.int64)
        for k in range(width):
            keys = keys * len(known) + coded[k : k + hi - lo]
        keys, counts = np.unique(keys[(coded[: hi - lo] > 0) & (coded[1 : hi - lo + 1] > 0)], return_counts=True)
        places = np.stack([keys // len(known) ** (width - 1 - k) % len(known) for k in range(width)], axis=1)
        sizes = (places > 0).sum(axis=1)
        letters = known[places[places > 0]].astype(np.uint32).tobytes().decode("utf-32-le")
        stops = np.cumsum(sizes).tolist()
        yield pa.array([letters[e - n : e] for e, n in zip(stops, sizes.tolist())], pa.string()), counts


def ngram_counts(lines: DataFrame) -> DataFrame:
    """Occurrences of every 2, 3 and 4 character sequence per room.

    Only the longest window at each position is counted, batch by batch; shorter
    sequences are its beginnings, taken from the distinct windows afterwards.
    """
    names = ["room_name", "window", "n"]

    def counted(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for room_name, texts in by_room(part, WINDOWS_AT_ONCE):
                for windows, counts in window_counts(texts):
                    yield pa.RecordBatch.from_arrays([pa.repeat(room_name, len(counts)), windows, pa.array(counts, pa.int64())], names=names)

    texts = lines.filter(F.col("text").isNotNull()).select("room_name", F.col("text").cast("binary").alias("text"))
    windows = texts.mapInArrow(counted, "room_name string, window string, n bigint").groupBy("room_name", "window").agg(F.sum("n").alias("n"))
    sizes = F.sequence(F.lit(2), F.char_length("window"))
    return (
        windows.select("room_name", "window", "n", F.explode(sizes).alias("size"))
        .groupBy("room_name", F.expr("substring(window, 1, size)").alias("word"))
        .agg(F.sum("n").alias("count"))
    )


def ngram_words(
    danmaku: DataFrame, k: int = 30, more_than: int = 2, room: str | None = None, latest: int | None = None
) -> DataFrame:
    """The ``k`` most frequent character sequences of each room."""
    counts = ngram_counts(chat_lines(danmaku, room, latest)).filter(F.col("count") > more_than)
    return top_per_key(counts, ["room_name"], (F.col("count").desc(), F.col("word").asc()), k)
