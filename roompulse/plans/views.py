"""The live-shopping tables, mapped onto the driver's parquet tables.

Every view is a lazy DataFrame; column pruning and filters reach the parquet
scans.  The same mapping in SQL, for the oracle, is in ``oracle.py``.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


# Gift prices; a gift not listed counts 1.
GIFT_PRICES = (
    ("gift_0", 0.1),
    ("gift_1", 1.0),
    ("gift_2", 0.5),
    ("gift_3", 5.0),
    ("gift_4", 50.0),
    ("gift_5", 100.0),
    ("gift_6", 500.0),
    ("gift_7", 3000.0),
)


@dataclass(frozen=True)
class Views:
    spark: SparkSession
    folder: str

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def events(self) -> DataFrame:
        return self.table("events")

    @cached_property
    def lineitem(self) -> DataFrame:
        return self.table("lineitem")

    @cached_property
    def rooms(self) -> DataFrame:
        return self.table("region").select(
            F.concat(F.lit("room_"), F.col("r_regionkey").cast("string")).alias("room_id"),
            F.col("r_name").alias("room_name"),
        )

    @cached_property
    def gift_prices(self) -> DataFrame:
        rows = ", ".join(f"('{name}', {price}D)" for name, price in GIFT_PRICES)
        return self.spark.sql(f"SELECT * FROM VALUES {rows} AS t(gift_name, price)")

    @cached_property
    def activity(self) -> DataFrame:
        """Raw events with the room, the user name and the number in ``props``."""
        return self.activity_of(self.events)

    @staticmethod
    def activity_of(events: DataFrame) -> DataFrame:
        return events.select(
            "event_id",
            F.concat(F.lit("room_"), (F.col("event_id") % 5).cast("string")).alias("room_id"),
            F.when(F.col("event_id") % 97 != 0, F.concat(F.lit("user_"), F.col("user_id").cast("string"))).alias(
                "username"
            ),
            "user_id",
            "event_type",
            "value",
            F.regexp_extract("props", "([0-9]+)", 1).cast("int").alias("k"),
            F.col("ts").alias("created_at"),
        )

    @cached_property
    def _messages(self) -> DataFrame:
        gift = F.col("event_type") == "purchase"
        e = self.activity.filter(F.col("event_type").isin("click", "view", "purchase"))
        return e.join(self.rooms, "room_id").select(
            F.col("event_id").alias("id"),
            "room_id",
            "room_name",
            "username",
            F.col("user_id").cast("string").alias("user_id"),
            F.when(gift, "gift").otherwise("chat").alias("msg_type"),
            F.when(gift, F.concat(F.lit("gift_"), (F.col("k") % 9).cast("string"))).alias("gift_name"),
            F.when(gift, F.lit(1) + F.col("k") % 5).alias("gift_count"),
            "created_at",
        )

    @cached_property
    def danmaku(self) -> DataFrame:
        """Chat and gift messages; a chat carries the whole text of a document.

        Texts are far larger than their compressed files, so both sides are dealt out by document and never broadcast;
        what is done with the texts then runs in all tasks.
        """
        docs = self.table("documents").select("doc_id", F.col("text").alias("doc_text")).hint("merge")
        rows = self._messages.withColumn("doc_id", self._doc_id()).join(docs, "doc_id", "left")
        return self._said(rows, self._messages.columns)

    def _doc_id(self) -> Column:
        return F.col("id") % self.table("documents").agg(F.count("*")).scalar()

    @staticmethod
    def _said(rows: DataFrame, columns: list[str]) -> DataFrame:
        text = F.when(F.col("msg_type") == "chat", F.col("doc_text")).alias("text")
        at = columns.index("msg_type") + 1
        return rows.select(*columns[:at], text, *columns[at:])

    def with_texts(self, chosen: DataFrame) -> DataFrame:
        """A bounded number of messages, chosen without their texts, with them.

        Only the documents of those messages are moved: their ids, a fixed number a room, go to the documents.
        """
        rows = chosen.withColumn("doc_id", self._doc_id())
        docs = self.table("documents").select("doc_id", F.col("text").alias("doc_text"))
        wanted = docs.join(F.broadcast(rows.select("doc_id").distinct()), "doc_id", "left_semi")
        return self._said(rows.join(wanted, "doc_id", "left"), chosen.columns)

    @cached_property
    def signals(self) -> DataFrame:
        """The same messages without texts, for reports that only count them.

        ``doc_id`` is unique, so leaving the documents out changes no row; Spark
        cannot know that and would join them for every count.
        """
        return self._messages

    @staticmethod
    def online_of(k: Column) -> Column:
        """The spellings of an audience count, in turn."""
        return (
            F.when(k % 5 == 0, (100 + k * 10).cast("string"))
            .when(k % 5 == 1, F.concat(F.lit("1,"), (100 + k).cast("string"), F.lit("+")))
            .when(k % 5 == 2, F.concat(F.lit("1."), (k % 10).cast("string"), F.lit("w")))
            .when(k % 5 == 3, F.concat(F.lit("2."), (k % 10).cast("string"), F.lit("万")))
            .otherwise("n/a")
        )

    @cached_property
    def live_metrics(self) -> DataFrame:
        k = F.col("k")
        text = k.cast("string")
        online = self.online_of(k)
        return (
            self.activity.filter(F.col("event_type") == "signup")
            .join(self.rooms, "room_id")
            .select(
                F.col("event_id").alias("id"),
                "room_id",
                "room_name",
                F.concat(F.lit("title "), text).alias("title"),
                F.lit("streamer").alias("streamer"),
                online.alias("online"),
                (F.col("event_id") * 3).alias("like_count"),
                F.when(k % 7 == 0, "未开播").otherwise("直播中").alias("status"),
                (k % 2 == 0).alias("has_cart"),
                k.alias("cart_total"),
                (k % 3 == 0).alias("has_commerce"),
                "created_at",
            )
        )

    @cached_property
    def room_stats(self) -> DataFrame:
        return (
            self.activity.filter(F.col("event_type") == "error")
            .join(self.rooms, "room_id")
            .select(
                F.col("event_id").alias("id"),
                "room_id",
                "room_name",
                (100 + F.col("k")).alias("online_count"),
                F.concat(F.col("k").cast("string"), F.lit(".5万")).alias("total_users"),
                "created_at",
            )
        )

    @cached_property
    def sales(self) -> DataFrame:
        """Order lines without product names, for reports that do not show them."""
        line = self.lineitem
        head = self.table("orders")
        return (
            line.join(head, line.l_orderkey == head.o_orderkey)
            .withColumn("room_id", F.concat(F.lit("room_"), (F.col("l_partkey") % 5).cast("string")))
            .join(self.rooms, "room_id")
            .select(
                (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("order_id"),
                F.col("l_partkey").alias("product_id"),
                "room_name",
                F.col("l_quantity").cast("int").alias("quantity"),
                F.col("l_extendedprice").cast("decimal(12,2)").alias("total_amount"),
                F.col("o_orderdate").alias("order_time"),
                F.concat(F.lit("USER_"), F.col("o_custkey").cast("string")).alias("customer_id"),
            )
        )

    @cached_property
    def orders(self) -> DataFrame:
        part = self.table("part").select(
            F.col("p_partkey").alias("product_id"),
            F.concat(F.col("p_name"), F.lit(" #"), F.col("p_partkey").cast("string")).alias("product_name"),
            F.col("p_type").alias("category"),
        )
        return self.sales.join(part, "product_id").select(
            "order_id", "product_id", "product_name", "room_name", "category", "quantity", "total_amount", "order_time",
            "customer_id",
        )

    @cached_property
    def catalogue(self) -> DataFrame:
        """Products before their sales are counted."""
        price = F.col("p_retailprice").cast("decimal(10,2)")
        return (
            self.table("part")
            .withColumn("room_id", F.concat(F.lit("room_"), (F.col("p_partkey") % 5).cast("string")))
            .join(self.rooms, "room_id")
            .select(
                F.col("p_partkey").alias("product_id"),
                F.concat(F.col("p_name"), F.lit(" #"), F.col("p_partkey").cast("string")).alias("product_name"),
                F.col("p_type").alias("category"),
                "room_name",
                "room_id",
                (price - 200).cast("decimal(12,2)").alias("cost_price"),
                price.alias("original_price"),
                (price - 10 * (F.col("p_size") % 15)).cast("decimal(12,2)").alias("live_price"),
                ((F.col("p_size") - 1) * 60).alias("stock"),
            )
        )

    @cached_property
    def products(self) -> DataFrame:
        from roompulse.operators.commerce import product_sold_refresh

        return product_sold_refresh(self.catalogue, self.sales)

    @cached_property
    def labelled_texts(self) -> DataFrame:
        """Training texts for the sentiment model: whole documents and a 0/1 label."""
        labels = self.table("labels").select("doc_id", (F.col("quality") == 1).alias("positive"))
        documents = self.table("documents").select("doc_id", "text")
        return labels.join(documents, "doc_id").select("text", "positive")

    @cached_property
    def sentiment_model(self) -> DataFrame:
        """The trained model: an aggregation, part of the plans that use it."""
        from roompulse.operators.text import train_sentiment

        return train_sentiment(self.labelled_texts)
