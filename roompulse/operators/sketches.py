"""Mergeable summaries: distinct users and medians of a day from those of its minutes, without the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roompulse.functions.times import minute_of

#: Binary logarithm of the registers of a distinct-count sketch: its relative standard error is 1.04 / 2 ** (this / 2).
DISTINCT_LG_K = 14
#: Relative error within which estimates of distinct counts are expected (four standard errors, and one for rounding).
DISTINCT_ERROR = 0.035
#: Size parameter of a quantile sketch, and its normalised rank error (99 % of single queries; see the library's tables).
QUANTILE_K = 400
RANK_ERROR = 0.01


def user_sketches(messages: DataFrame, keys: Sequence[str] = ("room_name",), lg_k: int = DISTINCT_LG_K) -> DataFrame:
    """One sketch of the users of every key and minute; users without a name are not counted."""
    minute = minute_of(F.col("created_at")).alias("start")
    named = messages.filter(F.col("username").isNotNull())
    return named.groupBy(*keys, minute).agg(F.hll_sketch_agg("username", F.lit(lg_k)).alias("users"))


def rolled_up(sketches: DataFrame, unit: str, keys: Sequence[str] = ("room_name",)) -> DataFrame:
    """Sketches of a coarser unit (hour, day) from finer ones."""
    start = F.date_trunc(unit, F.col("start")).cast("timestamp_ntz").alias("start")
    return sketches.groupBy(*keys, start).agg(F.hll_union_agg("users").alias("users"))


def active_users(messages: DataFrame, keys: Sequence[str] = ("room_name",), units: Sequence[str] = ("hour", "day")) -> DataFrame:
    """Estimated distinct users per key and unit: one pass over the messages, each unit united from the one before."""
    sketches, parts = user_sketches(messages, keys), []
    for unit in units:
        sketches = rolled_up(sketches, unit, keys)
        parts.append(sketches.select(F.lit(unit).alias("unit"), *keys, "start", F.hll_sketch_estimate("users").alias("estimate")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def within(estimate: Column, exact: Column, error: float = DISTINCT_ERROR) -> Column:
    return F.abs(estimate - exact) <= F.floor(exact * error)


def quantile_sketches(df: DataFrame, keys: Sequence[str], names: Sequence[str], k: int = QUANTILE_K) -> DataFrame:
    """One sketch of each whole-number column for every key."""
    return df.groupBy(*keys).agg(*[F.kll_sketch_agg_bigint(F.col(n).cast("bigint"), k).alias(n) for n in names])


def merged_quantiles(sketches: DataFrame, keys: Sequence[str], names: Sequence[str], k: int = QUANTILE_K) -> DataFrame:
    """Sketches of fewer keys from those of more."""
    return sketches.groupBy(*keys).agg(*[F.kll_merge_agg_bigint(n, k).alias(n) for n in names])


def medians(sketches: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """The estimated median of each sketch."""
    return sketches.select(*keys, *[F.kll_sketch_get_quantile_bigint(n, F.lit(0.5)).alias(n) for n in names])


def rank_error(df: DataFrame, keys: Sequence[str], estimates: DataFrame, names: Sequence[str]) -> DataFrame:
    """For each estimate, how far from the middle its place among the values lies, as a share of them.

    An estimate that occurs several times has all the places of those rows; the nearest one counts.
    """
    joined = df.join(estimates.select(*keys, *[F.col(n).alias(f"__{n}") for n in names]), list(keys))
    sums = [
        c
        for n in names
        for c in (F.count_if(F.col(n) < F.col(f"__{n}")).alias(f"{n}_below"), F.count_if(F.col(n) <= F.col(f"__{n}")).alias(f"{n}_upto"))
    ]
    counted = joined.groupBy(*keys).agg(F.count("*").alias("n"), *sums)
    half = F.col("n") / 2

    def error(name: str) -> Column:
        low, high = F.col(f"{name}_below"), F.col(f"{name}_upto")
        return (F.greatest(low - half, half - high, F.lit(0.0)) / F.col("n")).alias(name)

    return counted.select(*keys, *[error(n) for n in names])


def user_texts(chats: DataFrame, piece_rows: int = 50, separator: str = "\n", id_range: int = 10_000) -> DataFrame:
    """The texts of each user of a room in id order, joined, in numbered pieces of ``piece_rows`` chats.

    A busy user has many rows in place of one long one.  Rows are put in order only inside a range of ids; sums over the
    ranges' counts give each range its offset, so no task orders all chats of a user.
    """
    key = ["room_name", "username"]
    # Users without a name are one group; as a pair of values it equals itself, so that windows and join share one shuffle.
    rows = chats.filter(F.col("text").isNotNull()).select(F.struct(*key).alias("who"), "id", "text", F.floor(F.col("id") / id_range).alias("part"))
    counts = rows.groupBy("who", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("who").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("who", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("who", "part").orderBy("id", "text")
    numbered = rows.withColumn("row", F.row_number().over(inside)).join(offsets, ["who", "part"])
    place = F.col("offset") + F.col("row") - 1
    pieces = numbered.select("who.room_name", "who.username", "id", "text", F.floor(place / piece_rows).cast("bigint").alias("piece"))
    return pieces.groupBy(*key, "piece").agg(
        F.min("id").alias("first_id"),
        F.max("id").alias("last_id"),
        F.count("*").alias("chats"),
        F.expr(f"listagg(text, {separator!r}) WITHIN GROUP (ORDER BY id, text)").alias("texts"),
    )
