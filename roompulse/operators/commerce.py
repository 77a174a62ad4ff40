"""Products, stock, orders and sales reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roompulse.functions.numbers import half_up, ratio, whole_div
from roompulse.functions.times import clock, days
from roompulse.operators.common import only, top_per_key

# Sell-through above which a product gets the alert level.
ALERT_LEVELS = ((8, "RED"), (5, "YELLOW"), (3, "GREEN"))
ALERT_OK = "OK"


def product_sold_refresh(products: DataFrame, orders: DataFrame) -> DataFrame:
    """Products with ``sold`` set to the quantity ordered, 0 where nothing was."""
    sold = orders.groupBy("product_id").agg(F.sum("quantity").alias("sold"))
    return products.drop("sold").join(sold, "product_id", "left").withColumn(
        "sold", F.coalesce("sold", F.lit(0)).cast("int")
    )


def product_margin(products: DataFrame) -> DataFrame:
    """Margin in percent of the cost, with the price floors applied, and the hot flag."""
    cost = F.greatest(F.col("cost_price"), F.lit(1).cast("decimal(12,2)"))
    live = F.greatest(F.col("live_price"), cost + 5)
    listed = F.greatest(F.col("original_price").cast("decimal(12,2)"), live)
    cents = {name: (c * 100).cast("bigint") for name, c in (("cost", cost), ("live", live), ("listed", listed))}
    return products.select(
        "product_id",
        cost.cast("double").alias("cost_price"),
        live.cast("double").alias("live_price"),
        listed.cast("double").alias("original_price"),
        ratio(cents["live"] - cents["cost"], cents["cost"], 1, 100).alias("margin"),
        (cents["live"] * 10 < cents["listed"] * 9).alias("is_hot"),
    )


def product_list(products: DataFrame, room: str | None = None, category: str | None = None, n: int = 100) -> DataFrame:
    """Best sellers among the products that match the given filters."""
    chosen = only(products, room_name=room, category=category)
    return chosen.orderBy(F.col("sold").desc(), F.col("product_id").asc()).limit(n)


def product_top(products: DataFrame, n: int = 10) -> DataFrame:
    """Best sellers of every room."""
    return top_per_key(products, ["room_name"], (F.col("sold").desc(), F.col("product_id").asc()), n)


def stock_levels(products: DataFrame) -> DataFrame:
    """Sell-through and alert level; without stock the level is OK, as nothing can be divided."""
    sold, stock = F.col("sold").cast("bigint"), F.col("stock").cast("bigint")
    level = None
    for tenths, name in ALERT_LEVELS:
        hit = (stock > 0) & (sold * 10 > stock * tenths)
        level = F.when(hit, name) if level is None else level.when(hit, name)
    return products.select(
        "product_id",
        "product_name",
        "room_name",
        "category",
        "stock",
        "sold",
        ratio(sold, F.greatest(stock, F.lit(1).cast("bigint")), 1, 100).alias("sell_through_rate"),
        level.otherwise(ALERT_OK).alias("alert_level"),
    )


def inventory_alerts(products: DataFrame, n: int = 30, room: str | None = None) -> DataFrame:
    """The ``n`` products closest to selling out."""
    levels = stock_levels(only(products, room_name=room))
    return levels.orderBy(F.col("sell_through_rate").desc(), F.col("product_id").asc()).limit(n)


def product_sales_trend(products: DataFrame, orders: DataFrame, product_id: int | None = None) -> DataFrame:
    """Daily quantity and revenue of each product; unsold products keep one empty row."""
    products, orders = only(products, product_id=product_id), only(orders, product_id=product_id)
    daily = orders.groupBy("product_id", F.to_date("order_time").alias("dt")).agg(
        F.sum("quantity").alias("qty"), F.sum("total_amount").alias("gmv")
    )
    return products.select("product_id", "product_name", "live_price").join(daily, "product_id", "left").select(
        "product_id",
        "product_name",
        F.col("live_price").cast("double").alias("live_price"),
        "dt",
        F.col("qty").cast("double").alias("qty"),
        F.col("gmv").cast("double").alias("gmv"),
    )


def orders_recent(orders: DataFrame, n: int = 20, room: str | None = None) -> DataFrame:
    """The ``n`` newest orders; equal times are settled by every other column."""
    rest = ("order_id", "product_id", "quantity", "total_amount", "customer_id")
    order = [F.col("order_time").desc(), *[F.col(c).asc() for c in rest]]
    return only(orders, room_name=room).orderBy(*order).limit(n)


def gmv_daily(
    orders: DataFrame, span: int = 365, room: str | None = None, as_of=None, keys: Sequence[str] = ("room_name",)
) -> DataFrame:
    """Orders, revenue and items per day of the last ``span`` days, per room (or overall without keys).

    A room silent for that long reports all its days.  Days are summed in one
    pass and the choice falls on the small daily result.
    """
    orders = only(orders, room_name=room)
    start = clock(orders, "order_time", as_of) - days(span)
    late = F.col("order_time") > start

    def both(name: str, total, when):
        return [total.alias(f"{name}_all"), when.alias(f"{name}_late")]

    daily = orders.groupBy(*keys, F.to_date("order_time").alias("dt")).agg(
        *both("orders", F.count("*"), F.count_if(late)),
        *both("gmv", F.sum("total_amount"), F.sum(F.when(late, F.col("total_amount")))),
        *both("items", F.sum("quantity"), F.sum(F.when(late, F.col("quantity")))),
    )
    has_late = F.max("orders_late").over(Window.partitionBy(*keys)) > 0
    picked = daily.withColumn("has_late", has_late).filter(~F.col("has_late") | (F.col("orders_late") > 0))

    def pick(name: str):
        return F.when(F.col("has_late"), F.col(f"{name}_late")).otherwise(F.col(f"{name}_all"))

    return picked.select(
        *keys,
        "dt",
        pick("orders").alias("orders"),
        F.round(pick("gmv"), 0).cast("double").alias("gmv"),
        pick("items").alias("items"),
    )


def gmv_totals(orders: DataFrame) -> DataFrame:
    """Revenue per room and overall; the overall row has no room."""
    return orders.rollup("room_name").agg(
        F.sum("total_amount").cast("double").alias("gmv"), F.count("*").alias("orders")
    )


def product_growth(orders: DataFrame, span: int = 7, room: str | None = None, as_of=None) -> DataFrame:
    """Quantity in the last ``span`` days, in total, and growth over the time before."""
    orders = only(orders, room_name=room)
    start = clock(orders, "order_time", as_of) - days(span)
    late = F.col("order_time") > start
    sums = orders.groupBy("product_id", "product_name", "category").agg(
        F.coalesce(F.sum(F.when(late, F.col("quantity"))), F.lit(0)).alias("recent_sold"),
        F.coalesce(F.sum(F.when(~late, F.col("quantity"))), F.lit(0)).alias("old_sold"),
        F.sum("quantity").alias("total_sold"),
    )
    base = F.greatest(F.col("old_sold"), F.lit(1))
    tenths = whole_div(F.col("recent_sold") * 2000 + base, base * 2) - 1000
    return (
        sums.filter(F.col("total_sold") > 0)
        .withColumn("growth_pct", tenths.cast("double") / 10.0)
        .select("product_id", "product_name", "category", "recent_sold", "total_sold", "growth_pct")
    )


def hot_products(growth: DataFrame, n: int = 10) -> DataFrame:
    return growth.orderBy(F.col("recent_sold").desc(), F.col("product_id").asc()).limit(n)


def rising_products(growth: DataFrame, n: int = 10) -> DataFrame:
    return growth.orderBy(F.col("growth_pct").desc(), F.col("product_id").asc()).limit(n)


def gmv_kpis(products: DataFrame, orders: DataFrame, span: int = 365, as_of=None, growth_span: int = 7) -> DataFrame:
    """Headline figures: revenue, latest day, products to restock and the fastest riser.

    ``span`` and ``growth_span`` are the look-back days of the two inputs.
    """
    daily = gmv_daily(orders, span, as_of=as_of, keys=())
    red = stock_levels(products).agg(F.count_if(F.col("alert_level") == "RED"))
    growth = product_growth(orders, growth_span, as_of=as_of)
    riser = growth.agg(
        F.max_by(F.struct("product_name", "growth_pct"), F.struct("growth_pct", (-F.col("product_id")).alias("p")))
    )
    return daily.agg(
        F.sum("gmv").alias("total_gmv"),
        F.max("dt").alias("latest_day"),
        F.max_by("gmv", "dt").alias("latest_gmv"),
        F.max_by("orders", "dt").alias("latest_orders"),
    ).select(
        half_up(F.col("total_gmv")).alias("total_gmv"),
        "latest_day",
        "latest_gmv",
        "latest_orders",
        red.scalar().alias("red_products"),
        riser.scalar().alias("riser"),
    ).select(
        "total_gmv",
        "latest_day",
        "latest_gmv",
        "latest_orders",
        "red_products",
        F.col("riser.product_name").alias("top_riser"),
        F.col("riser.growth_pct").alias("top_growth_pct"),
    )
