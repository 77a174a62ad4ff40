"""Daily sales series, moving average, linear forecast and trend."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roompulse.functions.numbers import half_up, ratio

# Trend names and the slope that separates them.
UP, DOWN, FLAT = "上升", "下降", "平稳"
FLAT_SLOPE = 0.5
MIN_DAYS = 3


def _settled(value: Column, digits: int = 0) -> Column:
    """Rounded half up, once the last bits of a regression no longer decide a tie."""
    return half_up(half_up(value, 6), digits)


def daily_sales(orders: DataFrame, keys: Sequence[str] = ("room_name",), fill_gaps: bool = False) -> DataFrame:
    """Quantity and revenue per key and day; with ``fill_gaps`` missing days count 0."""
    daily = orders.groupBy(*keys, F.to_date("order_time").alias("dt")).agg(
        F.sum("quantity").alias("qty"), F.sum("total_amount").alias("gmv")
    )
    if not fill_gaps:
        return daily
    span = daily.groupBy(*keys).agg(F.min("dt").alias("lo"), F.max("dt").alias("hi"))
    every = span.select(*keys, F.explode(F.sequence("lo", "hi")).alias("dt"))
    filled = every.join(daily, [*keys, "dt"], "left")
    return filled.fillna(0, ["qty"]).withColumn("gmv", F.coalesce("gmv", F.lit(0).cast("decimal(22,2)")))


def sales_ma7(daily: DataFrame, keys: Sequence[str] = ("room_name",), width: int = 7) -> DataFrame:
    """Each day with the mean of itself and the days recorded before it."""
    w = Window.partitionBy(*keys).orderBy("dt").rowsBetween(1 - width, 0)
    mean = ratio(F.sum("qty").over(w), F.count("*").over(w), 1)
    return daily.select(*keys, "dt", "qty", F.col("gmv").cast("double").alias("gmv"), mean.alias("ma7"))


def sales_line(daily: DataFrame, keys: Sequence[str] = ("room_name",)) -> DataFrame:
    """Least-squares line over the day index of every key with at least three days."""
    by_day = Window.partitionBy(*keys).orderBy("dt")
    newest_first = Window.partitionBy(*keys).orderBy(F.col("dt").desc())
    numbered = daily.withColumn("ix", (F.row_number().over(by_day) - 1).cast("double")).withColumn(
        "back", F.row_number().over(newest_first)
    )
    y = F.col("qty").cast("double")
    last_week = F.col("back") <= 7
    line = numbered.groupBy(*keys).agg(
        F.count("*").alias("history_days"),
        F.max("dt").alias("last_day"),
        F.sum("qty").alias("qty_sum"),
        F.sum("gmv").cast("double").alias("gmv_sum"),
        F.coalesce(F.regr_slope(y, F.col("ix")), F.lit(0.0)).alias("slope"),
        F.coalesce(F.regr_intercept(y, F.col("ix")), F.avg(y)).alias("intercept"),
        ratio(F.sum(F.when(last_week, F.col("qty"))), F.count_if(last_week), 1).alias("ma7"),
    )
    return line.filter(F.col("history_days") >= MIN_DAYS)


def sales_forecast(line: DataFrame, keys: Sequence[str] = ("room_name",), days_ahead: int = 7) -> DataFrame:
    """Quantity and revenue of the next days along the line, never below zero."""
    day = F.explode(F.sequence(F.lit(1), F.lit(days_ahead))).alias("day")
    ahead = line.select("*", day)
    qty = F.greatest(
        F.lit(0.0), F.col("slope") * (F.col("history_days") + F.col("day") - 1) + F.col("intercept")
    )
    unit = F.when(F.col("qty_sum") > 0, F.col("gmv_sum") / F.nullif(F.col("qty_sum"), F.lit(0))).otherwise(0.0)
    return ahead.select(
        *keys,
        F.date_add("last_day", F.col("day")).alias("dt"),
        _settled(qty).alias("predicted_qty"),
        _settled(qty * unit).alias("predicted_gmv"),
        "ma7",
    )


def sales_trend(line: DataFrame, keys: Sequence[str] = ("room_name",)) -> DataFrame:
    """Direction, slope and mean daily quantity of each key."""
    slope = F.col("slope")
    trend = F.when(slope > FLAT_SLOPE, UP).when(slope < -FLAT_SLOPE, DOWN).otherwise(FLAT)
    return line.select(
        *keys,
        "history_days",
        trend.alias("trend"),
        _settled(slope, 2).alias("slope"),
        F.col("ma7").alias("ma7_latest"),
        ratio(F.col("qty_sum"), F.col("history_days"), 0).alias("avg_daily_qty"),
    )


def forecast_series(ma7: DataFrame, forecast: DataFrame, keys: Sequence[str] = ("room_name",)) -> DataFrame:
    """History and forecast as one series of days."""
    past = ma7.select(*keys, "dt", F.col("qty").cast("double").alias("qty"), "ma7", F.lit("history").alias("part"))
    ahead = forecast.select(*keys, "dt", F.col("predicted_qty").alias("qty"), F.lit("forecast").alias("part"))
    return past.unionByName(ahead, allowMissingColumns=True)
