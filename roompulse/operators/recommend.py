"""Co-purchase recommendations and association rules over customer baskets.

Counting item pairs is quadratic in the basket, so every basket is cut into blocks
of at most about ``BLOCK_ITEMS`` items and joined block by block: an ordinary basket
is one block, and one customer's many pairs spread over many tasks.  What is shuffled
is a row for each product of a block with the whole block it met, not a row a pair;
the tasks that get a product's rows count its partners and pass on only those wanted.
Recommendations do this for one part of the products after another, from stored
baskets, as those rows are many times the orders.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow.compute import take
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roompulse.functions.numbers import half_up, ratio
from roompulse.operators.common import only, top_per_key
from roompulse.sinks.files import stored

BLOCK_ITEMS = 512
#: Beyond so many buyers a product's rows are dealt out to several tasks.
HEAVY_BUYERS = 100_000
#: Recommendations are counted for one part of the products after another, so that only one part's rows are on disk.
PASSES = 4


def baskets(orders: DataFrame, room: str | None = None) -> DataFrame:
    """Distinct (customer, product); a renamed product is still one item."""
    return only(orders, room_name=room).select("customer_id", "product_id").distinct()


def item_details(orders: DataFrame) -> DataFrame:
    """One name and category per product."""
    spellings = orders.select("product_id", "product_name", "category").distinct()
    details = F.max(F.struct("product_name", "category"))
    return spellings.groupBy("product_id").agg(details.alias("d")).select("product_id", "d.product_name", "d.category")


def _blocks(items: DataFrame, block_items: int) -> DataFrame:
    """(customer_id, own_block, block, own, met): the products of two blocks of a basket; ``own`` is empty where both are one block.

    Every product goes to the pairs of blocks it is in, so the baskets are read once and not joined with themselves.
    """
    sizes = items.groupBy("customer_id").agg(F.count("*").alias("n")).filter(F.col("n") > 1)
    n_blocks = F.ceil(F.col("n") / F.lit(block_items)).cast("int")
    sized = items.join(sizes.select("customer_id", n_blocks.alias("blocks")), "customer_id")
    sized = sized.withColumn("here", F.pmod(F.xxhash64("product_id"), F.col("blocks")).cast("int"))
    here = F.col("here")
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    others = F.filter(every, lambda other: other != here)
    asking = F.transform(others, lambda other: F.struct(here.alias("own_block"), other.alias("block"), F.lit(True).alias("asks")))
    met = F.transform(every, lambda other: F.struct(other.alias("own_block"), here.alias("block"), F.lit(False).alias("asks")))
    placed = sized.select("customer_id", "product_id", F.inline(F.concat(asking, met)))
    own, others = (F.sort_array(F.collect_list(F.when(asks, F.col("product_id")))) for asks in (F.col("asks"), ~F.col("asks")))
    return placed.groupBy("customer_id", "own_block", "block").agg(own.alias("own"), others.alias("met"))


def _own() -> Column:
    return F.when(F.col("own_block") == F.col("block"), F.col("met")).otherwise(F.col("own"))


def _met(blocks: DataFrame, both_ways: bool, of: Callable[[Column], Column] | None = None) -> DataFrame:
    """(customer_id, product_id, met): every product of a basket beside the blocks of that basket, or what follows it in them.

    ``of`` chooses products.
    """
    own = F.filter(_own(), of) if of else _own()
    rows = blocks.select("customer_id", "own_block", "block", F.explode(own).alias("product_id"), "met")
    if not both_ways:
        behind = F.slice("met", (F.array_position("met", F.col("product_id")) + 1).cast("int"), F.size("met"))
        larger = F.filter("met", lambda x: x > F.col("product_id"))
        rows = rows.withColumn("met", F.when(F.col("own_block") == F.col("block"), behind).otherwise(larger))
    return rows.filter(F.size("met") > 0).select("customer_id", "product_id", "met")


def _tallies(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Runs of rows of one product and share as (products, whole, group, partner, count); partners of a group ascend.

    The last run of a batch may go on in the next one, so its counts wait for it.
    """
    held = None
    for part in parts:
        if not part.num_rows:
            continue
        product, share, whole = part.column("product_id"), part.column("share").to_numpy(), part.column("whole")
        places = product.dictionary_encode().indices.to_numpy()
        starts = np.flatnonzero(np.concatenate([[True], (places[1:] != places[:-1]) | (share[1:] != share[:-1])]))
        lists = part.column("met")
        group = np.repeat(np.repeat(np.arange(len(starts)), np.diff([*starts, part.num_rows])), pc.list_value_length(lists).to_numpy())
        codes, span, named = _numbered(lists.flatten(), len(starts))
        cells, count = np.unique(group * span + codes, return_counts=True)
        group, codes = np.divmod(cells, span)
        partner = named(codes)
        product, whole = take(product, pa.array(starts)), take(whole, pa.array(starts))
        key = (product[0], share[0])
        if held and held[0] == key:
            first = int(np.searchsorted(group, 1))
            some, n = _summed(pa.concat_arrays([held[3], partner[:first]]), np.concatenate([held[4], count[:first]]))
            group = np.concatenate([np.zeros(len(n), np.int64), group[first:]])
            partner, count = pa.concat_arrays([some, partner[first:]]), np.concatenate([n, count[first:]])
        elif held:
            yield _alone(held)
        last = len(starts) - 1
        upto = int(np.searchsorted(group, last))
        held = ((product[last], share[starts[last]]), product[last:], whole[last:], partner[upto:], count[upto:])
        if upto:
            yield product[:last], whole[:last], group[:upto], partner[:upto], count[:upto]
    if held:
        yield _alone(held)


def _alone(held: tuple) -> tuple:
    _, product, whole, partner, count = held
    return product, whole, np.zeros(len(count), np.int64), partner, count


def _numbered(values: pa.Array, times: int = 1) -> tuple[np.ndarray, int, Callable[[np.ndarray], pa.Array]]:
    """Numbers in the order of the values, their bound (``times`` of it fit a long), and the way back."""
    if pa.types.is_signed_integer(values.type) and len(values):
        whole = values.to_numpy()
        low, span = int(whole.min()), int(whole.max()) - int(whole.min()) + 1
        if times * span < 1 << 62:
            return whole.astype(np.int64) - low, span, lambda codes: pa.array(codes + low, values.type)
    coded = values.dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return rank[coded.indices.to_numpy()], max(1, len(order)), lambda codes: take(coded.dictionary, pa.array(order[codes]))


def _summed(values: pa.Array, counts: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    codes, _, named = _numbered(values)
    distinct, place = np.unique(codes, return_inverse=True)
    return named(distinct), np.bincount(place, counts, len(distinct)).astype(np.int64)


def _leaders(group: np.ndarray, count: np.ndarray, k: int) -> np.ndarray:
    """Which of the partners, ascending within each group, are among the group's first ``k`` by count."""
    # Where enough partners were met twice, those met once need no place.
    often = count > 1
    near = np.flatnonzero(often | (np.bincount(group[often], minlength=int(group[-1]) + 1) < k)[group])
    group, count = group[near], count[near]
    order = np.lexsort((-count, group))
    at = np.arange(len(group))
    first = np.concatenate([[True], group[1:] != group[:-1]])
    chosen = np.zeros(len(often), bool)
    chosen[near[order[at - np.maximum.accumulate(np.where(first, at, 0)) < k]]] = True
    return chosen


def pair_counts(
    items: DataFrame, block_items: int = BLOCK_ITEMS, least: int = 1, k: int | None = None, heavy_buyers: int = HEAVY_BUYERS
) -> DataFrame:
    """Customers holding both products of the pairs ``p1 < p2`` bought together, of at least ``least`` customers.

    With ``k``, pairs come both ways and each ``p1`` has at least its ``k`` best, equal counts by ``p2``.  A product of
    more than ``heavy_buyers`` is counted in shares, whose counts are all passed on and then added up.
    """
    return _counted(_met(_blocks(items, block_items), bool(k)), _heavy(items, heavy_buyers), least, k)


def _heavy(items: DataFrame, heavy_buyers: int) -> DataFrame:
    """(product_id, shares) of products of more than ``heavy_buyers``: at most one row for so many rows of the items."""
    buyers = items.groupBy("product_id").agg(F.count("*").alias("n")).filter(F.col("n") > heavy_buyers)
    return buyers.select("product_id", F.ceil(F.col("n") / F.lit(heavy_buyers)).cast("int").alias("shares"))


def _counted(met: DataFrame, heavy: DataFrame, least: int, k: int | None) -> DataFrame:
    met = met.join(F.broadcast(heavy), "product_id", "left")
    share = F.coalesce(F.pmod(F.xxhash64("customer_id"), F.col("shares")).cast("int"), F.lit(0))
    rows = met.select("product_id", share.alias("share"), F.col("shares").isNull().alias("whole"), "met")
    rows = rows.repartition("product_id", "share").sortWithinPartitions("product_id", "share")
    names = ["p1", "p2", "whole", "co_count"]

    def counted(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for product, whole, group, partner, count in _tallies(parts):
            all_here = whole.to_numpy(zero_copy_only=False)[group]
            kept = ~all_here | (count >= least)
            if k and len(group):
                # One more than wanted, as a product meets itself too.
                kept &= ~all_here | _leaders(group, count, k + 1)
            group, partner, count, all_here = group[kept], partner.filter(pa.array(kept)), count[kept], all_here[kept]
            yield pa.RecordBatch.from_arrays([take(product, pa.array(group)), partner, pa.array(all_here), pa.array(count, pa.int64())], names=names)

    kind = met.schema["product_id"].dataType.simpleString()
    found = rows.mapInArrow(counted, f"p1 {kind}, p2 {kind}, whole boolean, co_count bigint")
    counts = found.filter(F.col("p1") != F.col("p2")).groupBy("p1", "p2").agg(F.sum("co_count").alias("co_count"))
    return counts.filter(F.col("co_count") >= least)


def _best_partners(items: DataFrame, k: int, block_items: int, passes: int = PASSES, heavy_buyers: int = HEAVY_BUYERS) -> DataFrame:
    """(product_id, rec_product_id, score, rank): the ``k`` products most often bought with each.

    The products are dealt into ``passes`` by number.  Baskets are stored before the first; what one shuffles is gone before the next.
    """
    blocks = stored(_blocks(items, block_items), "basket-blocks", freed=True)
    bought = blocks.filter(F.col("block") == 0).select(F.explode(_own()).alias("product_id"))
    heavy = stored(_heavy(bought, heavy_buyers), "heavy-products", freed=True)
    order = (F.col("score").desc(), F.col("rec_product_id").asc())
    best = None
    for number in range(passes):
        met = _met(blocks, True, lambda product: F.pmod(F.xxhash64(product), F.lit(passes)) == number)
        counted = _counted(met, heavy, 1, k)
        scored = counted.select(F.col("p1").alias("product_id"), F.col("p2").alias("rec_product_id"), F.col("co_count").alias("score"))
        part = top_per_key(scored, ["product_id"], order, k)
        if number < passes - 1:
            part = stored(part, "basket-partners", freed=True)
        best = part if best is None else best.unionByName(part)
    return best


def cooccurrence_recs(
    orders: DataFrame,
    k: int = 5,
    room: str | None = None,
    block_items: int = BLOCK_ITEMS,
    details: DataFrame | None = None,
) -> DataFrame:
    """For every product, the ``k`` products most often bought by the same customers.

    ``details`` names the products; without it names are gathered from the orders.
    """
    orders = only(orders, room_name=room)
    best = _best_partners(baskets(orders), k, block_items)
    details = item_details(orders) if details is None else details.select("product_id", "product_name", "category")
    rec = details.select(
        F.col("product_id").alias("rec_product_id"),
        F.col("product_name").alias("rec_product_name"),
        F.col("category").alias("rec_category"),
    )
    return best.join(details, "product_id").join(rec, "rec_product_id").select(
        "product_id", "product_name", "category", "rank", "rec_product_id", "rec_product_name", "rec_category", "score"
    )


def association_rules(
    orders: DataFrame,
    min_support: int = 3,
    min_confidence: float = 0.1,
    n: int | None = 20,
    room: str | None = None,
    both_directions: bool = False,
    max_pairs: int | None = None,
    block_items: int = BLOCK_ITEMS,
    details: DataFrame | None = None,
) -> DataFrame:
    """Rules "bought A, bought B" by lift.

    Items below ``min_support`` cannot be in a rule and leave before the pairing.
    """
    orders = only(orders, room_name=room)
    items = baskets(orders)
    users = items.agg(F.count_distinct("customer_id")).scalar()
    counts = items.groupBy("product_id").agg(F.count("*").alias("buyers"))
    frequent = counts.filter(F.col("buyers") >= min_support)
    kept = items.join(frequent.select("product_id"), "product_id", "left_semi")
    pairs = pair_counts(kept, block_items, min_support)
    if max_pairs:
        pairs = pairs.orderBy(F.col("co_count").desc(), "p1", "p2").limit(max_pairs)
    rules = pairs.select("p1", "p2", "co_count")
    if both_directions:
        rules = rules.unionByName(rules.select(F.col("p2").alias("p1"), F.col("p1").alias("p2"), "co_count"))
    n1 = frequent.select(F.col("product_id").alias("p1"), F.col("buyers").alias("n1"))
    n2 = frequent.select(F.col("product_id").alias("p2"), F.col("buyers").alias("n2"))
    confident = F.col("co_count") >= F.lit(min_confidence) * F.col("n1")
    lift = F.col("co_count").cast("double") * users.cast("double") / (F.col("n1").cast("double") * F.col("n2"))
    rules = rules.join(n1, "p1").filter(confident).join(n2, "p2").withColumn("raw_lift", lift)
    if n:
        rules = rules.orderBy(F.col("raw_lift").desc(), "p1", "p2").limit(n)
    names = (item_details(orders) if details is None else details).select("product_id", "product_name")
    a = names.select(F.col("product_id").alias("p1"), F.col("product_name").alias("antecedent"))
    b = names.select(F.col("product_id").alias("p2"), F.col("product_name").alias("consequent"))
    return rules.join(a, "p1").join(b, "p2").select(
        F.col("p1").alias("antecedent_id"),
        F.col("p2").alias("consequent_id"),
        "antecedent",
        "consequent",
        ratio(F.col("co_count"), users, 3).alias("support"),
        ratio(F.col("co_count"), F.col("n1"), 3).alias("confidence"),
        half_up(F.col("raw_lift"), 2).alias("lift"),
        "co_count",
    )


def summaries(orders: DataFrame, rules: DataFrame) -> DataFrame:
    """What the two reports say of themselves: products and customers looked at, and rules found."""
    items = baskets(orders)
    # Distinct in two steps, so that neither count gathers a customer or product.
    looked_at = items.agg(F.count_distinct("product_id").alias("total_products"), F.count_distinct("customer_id").alias("total_users"))
    none = F.lit(None).cast("bigint")
    first = looked_at.select(F.lit("collaborative_filtering").alias("method"), "total_products", "total_users", none.alias("total_rules"))
    second = rules.agg(F.count("*").alias("total_rules")).select(F.lit("association_rules").alias("method"), none.alias("total_products"), none.alias("total_users"), "total_rules")
    return first.unionByName(second)
