"""First-fit decreasing in randomised groups of documents, each with a tournament tree of bin capacities.

1. Every document becomes ids and the end id, once.  Whole sequences are cut off its front; what is left is its rest.
   Of the rest two descriptions are kept: as one piece, and as blocks, pieces of falling powers of two that add up to it.
2. Rests are dealt into groups of about ``GROUP_ITEMS`` by a hash of their place in the stored table, so that neither a
   hot id nor the order of the table decides; groups are packed independently.
3. In a group the rests go, longest first, into the first bin with room.  The tournament tree over the bins holds at each
   node the largest room below it, so that bin is found in as many steps as the tree is high.
4. Padding is taken out by cutting few documents: the least filled bins, as many as the rooms of the others can take, are
   dissolved and their rests go on as blocks, again by first fit.  Bins that still keep more than ``SLACK`` room, however
   the lengths fall, are dissolved as well.  Blocks are powers of two and fill a bin without room; the last bin of blocks
   is dealt into sequences of powers of two, which need no padding.

So padding stays below ``SLACK`` ids a sequence whatever the lengths are.  Only lengths move, never ids; what one task
holds is bounded by the size of a group.  The stored table fixes the groups, so a repeated task packs the same.

Defined results: a null text is empty (its one piece is the end id); repeated rows are packed one by one; a null doc_id is
kept; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roompulse.llm.tables import batches, stored, table, text_bytes
from roompulse.llm.tokens import WORD_VOCABULARY, vocabulary, word_encoder

CAPACITY = 2048
END_ID = 1
#: Rests that one task packs at once, on average.
GROUP_ITEMS = 20_000
#: A sequence may keep this share of its capacity empty.
SLACK = 1 / 64

_CUT = "item bigint, doc_id bigint, start bigint, length bigint, doc_tokens bigint, ids_crc32 bigint, block_crcs array<bigint>"
_CUT_ARROW = pa.schema(
    [(name, pa.int64()) for name in ("item", "doc_id", "start", "length", "doc_tokens", "ids_crc32")] + [("block_crcs", pa.list_(pa.int64()))]
)
PLACED_SCHEMA = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
_PLACED_ARROW = pa.schema([(name, pa.int64()) for name in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")])


def blocks(length: int) -> list[int]:
    """Falling powers of two that add up to ``length``."""
    return [1 << k for k in range(length.bit_length() - 1, -1, -1) if length >> k & 1]


def cut_documents(docs: DataFrame, vocabulary_path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Whole sequences (without block_crcs) and rests (with them) of documents, numbered by ``item``."""

    def rows(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        encoder, end, item = word_encoder(vocabulary_path), np.array([end_id], "<u4").tobytes(), TaskContext.get().partitionId() << 36
        for part in parts:
            for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text")):
                ids = encoder.encode(text.as_py()) + end
                n = len(ids) // 4
                for start in range(0, n, capacity):
                    own, crcs = ids[4 * start : 4 * (start + capacity)], None
                    length = len(own) // 4
                    if length < capacity:
                        edges = np.cumsum([0, *blocks(length)]).tolist()
                        crcs = [zlib.crc32(own[4 * a : 4 * b]) for a, b in zip(edges, edges[1:])]
                    yield item, doc_id, start, length, n, zlib.crc32(own), crcs
                    item += 1

    cut = docs.select(F.col("doc_id").cast("long"), text_bytes().alias("text"))
    return cut.mapInArrow(lambda parts: batches(_CUT_ARROW, rows(parts)), _CUT)


class Rooms:
    """A tournament tree: each leaf is a bin's room, each node the larger one of its two children."""

    def __init__(self, leaves: int):
        self.width = 1 << max(0, leaves - 1).bit_length()
        self.tree = [0] * (2 * self.width)

    def set(self, bin_: int, room: int) -> None:
        tree, node = self.tree, self.width + bin_
        tree[node] = room
        while node > 1:
            node >>= 1
            best = max(tree[2 * node], tree[2 * node + 1])
            if tree[node] == best:
                break
            tree[node] = best

    def first(self, size: int) -> int:
        """The first bin with room for ``size``, -1 for none."""
        tree, node = self.tree, 1
        if tree[1] < size:
            return -1
        while node < self.width:
            node *= 2
            if tree[node] < size:
                node += 1
        return node - self.width


class Bins:
    """Bins of one group: what lies in each of them, and its room."""

    def __init__(self, capacity: int, most: int):
        self.capacity, self.rooms = capacity, Rooms(most)
        self.content: list[list[tuple]] = []
        self.room: list[int] = []

    def put(self, bin_: int, piece: tuple) -> None:
        self.content[bin_].append(piece)
        self.room[bin_] -= piece[0]
        self.rooms.set(bin_, self.room[bin_])

    def open(self) -> int:
        self.content.append([])
        self.room.append(self.capacity)
        self.rooms.set(len(self.room) - 1, self.capacity)
        return len(self.room) - 1

    def first_fit_decreasing(self, pieces: list[tuple], new_bins: bool = True) -> list[tuple]:
        """Places pieces (length first); returns those that found no room where no bin may be opened."""
        left = []
        for piece in sorted(pieces, key=lambda p: (-p[0], *p[1:])):
            bin_ = self.rooms.first(piece[0])
            if bin_ < 0 and not new_bins:
                left.append(piece)
                continue
            self.put(self.open() if bin_ < 0 else bin_, piece)
        return left

    def dissolve(self, bins: list[int]) -> list[tuple]:
        """Empties bins for good."""
        out = []
        for bin_ in bins:
            out += self.content[bin_]
            self.content[bin_], self.room[bin_] = [], 0
            self.rooms.set(bin_, 0)
        return out


def padded(fill: int, capacity: int) -> int:
    """Padding of a sequence: up to the capacity, none at a power of two."""
    return 0 if fill & (fill - 1) == 0 else capacity - fill


def packed_group(lengths: list[int], capacity: int, slack: float = SLACK) -> list[list[tuple[int, int, int]]]:
    """Bins of pieces (length, item, block), where block -1 is the whole item."""
    total = sum(lengths)
    bins = Bins(capacity, 1 + 4 * (total // capacity + 1) + len(lengths))
    bins.first_fit_decreasing([(n, i, -1) for i, n in enumerate(lengths)])

    def cut(pieces: list[tuple]) -> list[tuple]:
        """Whole items as their blocks."""
        return [p for n, i, block in pieces for p in ([(m, i, k) for k, m in enumerate(blocks(n))] if block < 0 else [(n, i, block)])]

    # The least filled bins whose content covers the rooms of the bins that stay.
    waste = {b: padded(capacity - room, capacity) for b, room in enumerate(bins.room)}
    open_bins = sorted((b for b in waste if waste[b]), key=lambda b: (-bins.room[b], -b))
    rooms, content, least = sum(bins.room[b] for b in open_bins), 0, 0
    while least < len(open_bins) and content < rooms:
        content += capacity - bins.room[open_bins[least]]
        rooms -= bins.room[open_bins[least]]
        least += 1
    loose = bins.first_fit_decreasing(cut(bins.dissolve(open_bins[:least])), new_bins=False)
    # Whatever still keeps too much room is cut as well; blocks then fill bins of their own.
    poor = [b for b in open_bins[least:] if padded(capacity - bins.room[b], capacity) > slack * capacity]
    loose += cut(bins.dissolve(poor))

    own = Bins(capacity, 2 * sum(n for n, *_ in loose) // capacity + 2)
    own.first_fit_decreasing(loose)
    sequences = [c for c in bins.content if c]
    for content in own.content:
        fill = sum(n for n, *_ in content)
        if not padded(fill, capacity):
            sequences.append(content)
            continue
        # Falling powers of two fill sequences of falling powers of two exactly.
        ends = np.cumsum(blocks(fill)).tolist()
        parts: list[list[tuple]] = [[] for _ in ends]
        at, part = 0, 0
        for piece in content:
            parts[part].append(piece)
            at += piece[0]
            part += at == ends[part]
        sequences += parts
    return sequences


def packed_in_groups(cut: DataFrame, capacity: int = CAPACITY, group_items: int = GROUP_ITEMS, salt: int = 0) -> DataFrame:
    """Stored rows of ``cut_documents`` in sequences."""
    whole, rests = cut.where("block_crcs IS NULL"), cut.where("block_crcs IS NOT NULL")
    groups = max(1, -(-rests.count() // group_items))

    def packed(key: tuple, group: pa.Table) -> pa.Table:
        group = group.sort_by("item")
        lengths, crcs = group.column("length").to_pylist(), group.column("block_crcs").to_pylist()
        items, starts, blocks_, sequence, offsets, sizes = [], [], [], [], [], []
        for number, content in enumerate(packed_group(lengths, capacity)):
            at = 0
            for n, item, block in content:
                items.append(item)
                starts.append(0 if block < 0 else sum(blocks(lengths[item])[:block]))
                blocks_.append(block)
                sizes.append(n)
                sequence.append((key[0].as_py() << 32) + number)
                offsets.append(at)
                at += n
        rows = group.take(pa.array(items, pa.int64()))
        own = [crc if block < 0 else crcs[i][block] for crc, i, block in zip(rows.column("ids_crc32").to_pylist(), items, blocks_)]
        start = np.array(rows.column("start").to_pylist(), np.int64) + np.array(starts, np.int64)
        columns = [rows.column("doc_id"), pa.array(start), pa.array(sizes, pa.int64()), pa.array(own, pa.int64()), rows.column("doc_tokens")]
        return pa.Table.from_arrays([*columns, pa.array(sequence, pa.int64()), pa.array(offsets, pa.int64())], schema=_PLACED_ARROW)

    dealt = rests.withColumn("group", F.pmod(F.xxhash64("item", F.lit(salt)), F.lit(groups)))
    placed = dealt.groupBy("group").applyInArrow(packed, PLACED_SCHEMA)
    # Whole sequences take numbers below those of the groups.
    alone = whole.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (-1 - F.col("item")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return alone.unionByName(placed)


def packed_documents(docs: DataFrame, vocabulary_path: str, capacity: int = CAPACITY, end_id: int = END_ID, salt: int = 0) -> DataFrame:
    """Pieces of documents (doc_id, text) with their places; ``capacity`` is a power of two."""
    if capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    return packed_in_groups(stored(cut_documents(docs, vocabulary_path, capacity, end_id), "group-packing-cut"), capacity, salt=salt)


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_documents(table(spark, sf_dir, "documents"), vocabulary(WORD_VOCABULARY))
