"""Best-fit packing of token pieces into sequences, as a tree of residual rounds.

1. Every document becomes ids and the end id; only longer ones than a sequence are cut.
2. Every partition packs its pieces by best fit, longest first, in chunks of a bounded size.
3. Bins with no room for any other open bin are done.  The other, underfull bins are items of the next round: they are
   dealt into groups of a bounded size and packed again, each move kept as (bin, new bin, shift).  Rounds go on until
   one group holds what is left or nothing merges.
4. The moves are chained per bin and applied to the pieces.

Only lengths travel, never ids.  Groups hold about ``GROUP_ITEMS`` items whatever the input; each round is written to
the shared folder, so bin numbers do not change when a task is repeated.

Defined results: a null text is empty (its one piece is the end id); repeated rows are packed one by one; a null doc_id
is kept; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roompulse.llm.tables import batches, stored, table, text_bytes
from roompulse.llm.tokens import WORD_VOCABULARY, vocabulary, word_encoder

CAPACITY = 4096
END_ID = 1
#: Items that one task packs at once.
GROUP_ITEMS = 50_000
#: A bin with less room than this is nearly full and done.
NEARLY_FULL = 16
#: Rounds end when fewer than one open bin in so many finds a partner.
WORTHWHILE = 1000

PIECE_SCHEMA = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
_PIECE_ARROW = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])
_IDS_ARROW = _PIECE_ARROW.append(pa.field("ids", pa.list_(pa.int32())))
_PLACED_ARROW = _PIECE_ARROW.append(pa.field("bin", pa.int64())).append(pa.field("offset", pa.int64()))
_MOVE_ARROW = pa.schema([("bin", pa.int64()), ("new_bin", pa.int64()), ("shift", pa.int64())])


def pieces(docs: DataFrame, vocabulary_path: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Pieces of at most ``capacity`` ids (doc_id, piece, start, length, ids_crc32, and the ids if asked for)."""

    def rows(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        encoder, end = word_encoder(vocabulary_path), np.array([end_id], "<u4").tobytes()
        for part in parts:
            for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text")):
                ids = encoder.encode(text.as_py()) + end
                for n, at in enumerate(range(0, len(ids), 4 * capacity)):
                    own = ids[at : at + 4 * capacity]
                    row = (doc_id, n, at // 4, len(own) // 4, zlib.crc32(own))
                    yield (*row, np.frombuffer(own, "<u4").astype(np.int32)) if with_ids else row

    schema, size = (_IDS_ARROW, 500) if with_ids else (_PIECE_ARROW, 20_000)
    cut = docs.select(F.col("doc_id").cast("long"), text_bytes().alias("text"))
    return cut.mapInArrow(lambda parts: batches(schema, rows(parts), size), PIECE_SCHEMA + ", ids array<int>" * with_ids)


def best_fit(lengths: list[int], capacity: int) -> list[tuple[int, int]]:
    """For each item, its bin and its offset there: longest first, into the fullest bin that has room.

    Open bins are kept by free room; a bit mask of the rooms in use finds the least one that is large enough.
    """
    places: list[tuple[int, int]] = [(0, 0)] * len(lengths)
    rooms: list[list[int]] = [[] for _ in range(capacity + 1)]
    used, n_bins = 0, 0
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        size = lengths[i]
        fitting = used >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            bin_ = rooms[room].pop()
            if not rooms[room]:
                used &= ~(1 << room)
        else:
            room, bin_, n_bins = capacity, n_bins, n_bins + 1
        places[i] = bin_, capacity - room
        if left := room - size:
            rooms[left].append(bin_)
            used |= 1 << left
    return places


def packed_locally(items: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Every partition's pieces in bins of its own."""

    def rows(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        base, held = TaskContext.get().partitionId() << 32, []

        def placed():
            nonlocal base
            places = best_fit([r[3] for r in held], capacity)
            for row, (bin_, offset) in zip(held, places):
                yield (*row, base + bin_, offset)
            base += 1 + max(bin_ for bin_, _ in places)

        for part in parts:
            for row in zip(*(c.to_pylist() for c in part.columns)):
                held.append(row)
                if len(held) == GROUP_ITEMS:
                    yield from placed()
                    held = []
        if held:
            yield from placed()

    return items.mapInArrow(lambda parts: batches(_PLACED_ARROW, rows(parts)), PIECE_SCHEMA + ", bin bigint, offset bigint")


def merged(open_bins: DataFrame, groups: int, salt: int, capacity: int = CAPACITY) -> DataFrame:
    """One residual round: open bins (bin, fill) as items; those that share a bin move into the first one of it."""

    def packed(group: pa.Table) -> pa.Table:
        group = group.sort_by("bin")
        bins, fills = group.column("bin").to_pylist(), group.column("fill").to_pylist()
        places = best_fit(fills, capacity)
        names = {new: bin_ for bin_, (new, offset) in zip(bins, places) if offset == 0}
        return pa.Table.from_arrays([pa.array(bins, pa.int64()), pa.array([names[n] for n, _ in places], pa.int64()), pa.array([o for _, o in places], pa.int64())], schema=_MOVE_ARROW)

    dealt = open_bins.withColumn("g", F.pmod(F.xxhash64("bin", F.lit(salt)), F.lit(groups)))
    return dealt.groupBy("g").applyInArrow(packed, "bin bigint, new_bin bigint, shift bigint")


def pack(items: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Pieces with sequence_id and offset."""
    placed = stored(packed_locally(items, capacity), "packing-placed")
    #: Where each bin of the first round now is, and the fill of the bins that are still roots.
    where = None
    bins = placed.groupBy("bin").agg(F.sum("length").alias("fill"))
    for salt in itertools.count():
        bins = stored(bins, "packing-bins")
        least = bins.agg(F.min("fill")).first()[0]
        # A bin stays open while the least filled of all bins would still fit into it.
        open_bins = bins.where(F.col("fill") <= capacity - max(least or 0, NEARLY_FULL))
        n_open = open_bins.count()
        if n_open < 2:
            break
        groups = -(-n_open // GROUP_ITEMS)
        moves = stored(merged(open_bins, groups, salt, capacity), "packing-moves")
        moved = moves.where(F.col("bin") != F.col("new_bin"))
        if where is None:
            where = moves.select(F.col("bin").alias("from"), F.col("new_bin").alias("to"), F.col("shift").alias("by"))
        else:
            step = moves.select(F.col("bin").alias("to"), "new_bin", "shift")
            chained = where.join(step, "to", "left").select("from", F.coalesce("new_bin", "to").alias("to"), (F.col("by") + F.coalesce("shift", F.lit(0))).alias("by"))
            new = moves.join(where, F.col("bin") == F.col("from"), "left_anti").select(F.col("bin").alias("from"), F.col("new_bin").alias("to"), F.col("shift").alias("by"))
            where = chained.unionByName(new)
        where = stored(where, "packing-where")
        n_moved = moved.count()
        bins = open_bins.join(moves, "bin").groupBy(F.col("new_bin").alias("bin")).agg(F.sum("fill").alias("fill"))
        if groups == 1 or n_moved * WORTHWHILE < n_open:
            break
    if where is None:
        return placed.withColumnRenamed("bin", "sequence_id")
    return placed.join(where, F.col("bin") == F.col("from"), "left").select(
        "doc_id", "piece", "start", "length", "ids_crc32", F.coalesce("to", "bin").alias("sequence_id"), (F.col("offset") + F.coalesce("by", F.lit(0))).alias("offset")
    )


def packed_documents(docs: DataFrame, vocabulary_path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    return pack(stored(pieces(docs, vocabulary_path, capacity, end_id), "packing-pieces"), capacity)


def sequences(placed: DataFrame, with_ids: DataFrame) -> DataFrame:
    """The packed ids (sequence_id, n_tokens, tokens), from placements and pieces with ids; a sequence is of bounded size."""
    parts = placed.join(with_ids.select("doc_id", "piece", "start", "ids"), ["doc_id", "piece", "start"])
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = parts.groupBy("sequence_id").agg(F.flatten(F.transform(ordered, lambda p: p["ids"])).alias("tokens"))
    return joined.select("sequence_id", F.size("tokens").alias("n_tokens"), "tokens")


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_documents(table(spark, sf_dir, "documents"), vocabulary(WORD_VOCABULARY))
