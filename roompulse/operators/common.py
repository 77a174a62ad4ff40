"""Plan shapes several operators share.

Rooms are few and unequal: one may hold a third of all rows.  Nothing here sorts
or gathers a whole room in one task unless its rows were reduced first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_ROWS = 100_000


def only(df: DataFrame, **equal: object) -> DataFrame:
    """Rows matching every given column value; ``None`` or ``""`` means any."""
    for name, value in equal.items():
        if value is not None and value != "":
            df = df.filter(F.col(name) == F.lit(value))
    return df


def top_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank"
) -> DataFrame:
    """The first ``k`` rows of every key in ``order``, numbered from 1.

    The order must be total, else ties are arbitrary.  Each task cuts its own rows
    to ``k`` before the shuffle (see ``windowGroupLimitThreshold`` in the session).
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= k)


def newest_rows(df: DataFrame, keys: Sequence[str], id_column: str, k: int, rank: str = "rank") -> DataFrame:
    """The ``k`` rows of every key with the highest ids, numbered from 1; rows of one id follow their other columns.

    Keys and ids alone give each key's least id that can still be among them; only
    rows from there on are shuffled and ranked with their wide columns.  The keys are
    few (rooms), so their least ids, a row each, go to the rows.
    """
    narrow = top_per_key(df.select(*keys, id_column), keys, (F.col(id_column).desc(),), k, rank)
    least = narrow.groupBy(*keys).agg(F.min(id_column).alias("__least"))
    near = df.join(F.broadcast(least), [*keys]).filter(F.col(id_column) >= F.col("__least")).drop("__least")
    rest = [F.col(c) for c in df.columns if c not in (*keys, id_column)]
    return top_per_key(near, keys, (F.col(id_column).desc(), *rest), k, rank)


def row_index(df: DataFrame, keys: Sequence[str], ts: str, tie: str, index: str = "row_ix") -> DataFrame:
    """Zero-based position of every row within its key by ``(ts, tie)``, and the key's row count.

    Rows are sorted only inside (key, hour); a running sum over the hourly counts
    gives each hour its offset, so no task ever sorts a whole key.
    """
    df = df.withColumn("__hour", F.date_trunc("hour", F.col(ts)))
    hourly = df.groupBy(*keys, "__hour").agg(F.count("*").alias("__n"))
    by_key = Window.partitionBy(*keys)
    before = by_key.orderBy("__hour").rowsBetween(Window.unboundedPreceding, -1)
    offsets = hourly.select(
        *keys,
        "__hour",
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"),
        F.sum("__n").over(by_key).alias("rows_in_key"),
    )
    inside = Window.partitionBy(*keys, "__hour").orderBy(ts, tie)
    return (
        df.join(offsets, [*keys, "__hour"])
        .withColumn(index, F.col("__offset") + F.row_number().over(inside) - 1)
        .drop("__hour", "__offset")
    )


def lookback_window(
    df: DataFrame, keys: Sequence[str], index: str, reach: int, block_rows: int = BLOCK_ROWS
) -> tuple[DataFrame, Window, Column]:
    """Blocks of a long ordered key that can look back ``reach`` rows on their own.

    The last ``reach`` rows of each block are also handed to the next one.  Returns
    the frame, a window over (key, block) in index order, and the condition that
    keeps each row once after the window functions ran.
    """
    if reach >= block_rows:
        raise ValueError("a block must be longer than the look-back")
    block = F.floor(F.col(index) / F.lit(block_rows))
    inside = F.col(index) % F.lit(block_rows)
    copies = F.when(inside >= block_rows - reach, F.array(block, block + 1)).otherwise(F.array(block))
    spread = df.withColumn("__home", block).withColumn("__block", F.explode(copies))
    window = Window.partitionBy(*keys, "__block").orderBy(index)
    return spread, window, F.col("__block") == F.col("__home")


def upper_medians(df: DataFrame, keys: Sequence[str], names: dict[str, str]) -> DataFrame:
    """Element ``n // 2`` of each key's sorted values, for several whole-number columns at once.

    ``names`` maps columns to result columns.  The columns are stacked, so one
    pass serves all; equal values are counted first, so the ordered part only
    sees distinct ones.
    """
    stacked = F.inline(
        F.array(*[F.struct(F.lit(n).alias("__name"), F.col(c).cast("bigint").alias("__value")) for c, n in names.items()])
    )
    counts = df.select(*keys, stacked).groupBy(*keys, "__name", "__value").agg(F.count("*").alias("__n"))
    group = Window.partitionBy(*keys, "__name")
    running = group.orderBy("__value").rowsBetween(Window.unboundedPreceding, 0)
    ranked = counts.select(
        "*", F.sum("__n").over(running).alias("__upto"), F.sum("__n").over(group).alias("__all")
    )
    past_half = F.col("__upto") > F.floor(F.col("__all") / 2)
    medians = [F.min(F.when(F.col("__name") == n, F.col("__value"))).alias(n) for n in names.values()]
    return ranked.filter(past_half).groupBy(*keys).agg(*medians)
