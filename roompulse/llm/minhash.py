"""Near-duplicate documents: universal hash minima, banding, signature verification, full-set confirmation, components.

1. Each whole text becomes its set of shingle hashes; the set's digest and its minima (the signature) are stored, with a
   number for the row.  Rows of equal sets form a class, represented by one row of the smallest id; only representatives
   go on, as nodes under the number of that row.
2. Bands of the signature name buckets.  In each bucket every member is paired with one hub, the member that meets most
   others.  Pairs whose signatures agree enough are confirmed on the full sets; links give components.
3. What the hubs did not settle: documents of buckets that still hold different components are joined on the seldom
   shingles that any two sets over the threshold must share, with length and position bounds, across components only.
   The pairs found are confirmed on the full sets at once, without the signatures.  Pairs inside one component need no test, and documents
   far below the threshold never meet, so no group is expanded into all its pairs.
4. Components by large-star and small-star over all links, between the smallest ids of the classes; the classes of one
   doc_id are linked too.

With 26 bands of 5 minima a link of similarity 0.85 shares no bucket with probability 2e-7; the signature bound lies
5 standard deviations below the threshold, whatever that is (it drops 4.2e-6 of the links of similarity 0.85).  A hub pair
that it drops is met again in step 3 unless other links join it, so what is missed is what shares no bucket.

Defined results: a null text or one without words has no shingles and is linked with nothing; fewer words than a
shingle are one shingle; rows of one doc_id are one document with all their texts: each text's links count, and all of
the rows have one component, in whatever order they come; rows without doc_id are alone (component null); an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roompulse.llm.components import components
from roompulse.llm.tables import batches, remembered, stored, table, text_bytes

SHINGLE_WORDS = 5
BANDS = 26
BAND_MINIMA = 5
MINIMA = BANDS * BAND_MINIMA
#: A link: 100 * intersection >= LINK_PERCENT * union.
LINK_PERCENT = 85
#: Standard deviations between the threshold and the least share of equal minima of a pair that goes on to the full sets.
SIGNATURE_SLACK = 5.0
#: Hash cells in which the shingles of open documents are counted: as many as there are shingles, between these.
CELLS = 1 << 16
MOST_CELLS = 1 << 20
WORDS_KEPT = 150_000

_GENERATOR = np.random.Generator(np.random.PCG64(20240607))
_A = _GENERATOR.integers(1, 1 << 63, MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _GENERATOR.integers(0, 1 << 63, MINIMA, dtype=np.uint64)
#: One odd multiplier for each place in a shingle, and one for each length below it.
_PLACE = _GENERATOR.integers(1, 1 << 63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

_SCAN_ARROW = pa.schema(
    [("item", pa.int64()), ("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("digest", pa.binary()), ("text_key", pa.binary()), ("signature", pa.binary())]
)
_SCAN_DDL = "item bigint, doc_id bigint, n_shingles bigint, digest binary, text_key binary, signature binary"
_BAND_ARROW = pa.schema([("bucket", pa.int64()), ("node", pa.int64())])
_CELL_ARROW = pa.schema([("cell", pa.int32()), ("n", pa.int64())])
_PREFIX_ARROW = pa.schema([(c, pa.int64()) for c in ("h", "node", "component", "n", "at")])
_PAIR_ARROW = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every bit depends on every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: bytes, n_words: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a text."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    known = remembered("shingle words")
    if len(known) > WORDS_KEPT:
        known.clear()
    for word in {w for w in words if w not in known}:
        known[word] = xxhash.xxh3_64_intdigest(word)
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    width = min(n_words, len(h))
    n = len(h) - width + 1
    total = np.full(n, width, np.uint64)
    for k in range(width):
        total = mixed(total * _PLACE[k] + h[k : k + n])
    return np.unique(total)


def signature(hashes: np.ndarray) -> np.ndarray:
    """The least value of each universal hash over a set."""
    least = np.full(MINIMA, np.iinfo(np.uint64).max, np.uint64)
    x = (hashes >> np.uint64(32))[:, None]
    for at in range(0, len(x), 256):
        least = np.minimum(least, (x[at : at + 256] * _A + _B).min(axis=0))
    return (least >> np.uint64(32)).astype(np.uint32)


def scanned(docs: DataFrame) -> DataFrame:
    def rows(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        item = TaskContext.get().partitionId() << 36
        for part in parts:
            for doc_id, value in zip(part.column("doc_id").to_pylist(), part.column("text")):
                text = value.as_py()
                own = shingles(text)
                if len(own):
                    yield item, doc_id, len(own), hashlib.md5(own.tobytes()).digest(), xxhash.xxh3_128_digest(text), signature(own).tobytes()
                else:
                    yield item, doc_id, 0, None, None, None
                item += 1

    texts = docs.select(F.col("doc_id").cast("long"), text_bytes().alias("text"))
    return texts.mapInArrow(lambda parts: batches(_SCAN_ARROW, rows(parts), 2_000), _SCAN_DDL)


def banded(signed: DataFrame) -> DataFrame:
    """(bucket, node) for each band of (node, signature)."""

    def rows(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            if part.num_rows:
                minima = np.frombuffer(b"".join(part.column("signature").to_pylist()), np.uint32).reshape(-1, BANDS, BAND_MINIMA).astype(np.uint64)
                bucket = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), minima.shape[:2])
                for k in range(BAND_MINIMA):
                    bucket = mixed(bucket * _PLACE[8 + k] + minima[:, :, k])
                ids = np.repeat(part.column("node").to_numpy(), BANDS)
                yield pa.RecordBatch.from_arrays([pa.array(bucket.ravel().view(np.int64)), pa.array(ids)], schema=_BAND_ARROW)

    return signed.select("node", "signature").mapInArrow(rows, "bucket bigint, node bigint")


def least_share(percent: int) -> float:
    """The least share of equal minima with which a pair can be a link."""
    share = percent / 100
    return share - SIGNATURE_SLACK * (share * (1 - share) / MINIMA) ** 0.5


def agreeing(pairs: DataFrame, signed: DataFrame, percent: int = LINK_PERCENT) -> DataFrame:
    """The pairs (a, b) whose signatures agree in enough places."""
    least = least_share(percent)

    def rows(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            if part.num_rows:
                x, y = (np.frombuffer(b"".join(part.column(c).to_pylist()), np.uint32).reshape(-1, MINIMA) for c in ("sa", "sb"))
                keep = pa.array((x == y).mean(axis=1) >= least)
                yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b")], schema=_PAIR_ARROW).filter(keep)

    first = signed.select(F.col("node").alias("a"), F.col("signature").alias("sa"))
    second = signed.select(F.col("node").alias("b"), F.col("signature").alias("sb"))
    return pairs.join(first, "a").join(second, "b").select("a", "b", "sa", "sb").mapInArrow(rows, "a bigint, b bigint")


def confirmed(pairs: DataFrame, texts: DataFrame, percent: int = LINK_PERCENT) -> DataFrame:
    """The pairs whose full shingle sets reach the threshold, as the smallest ids (u, v) of their classes; texts: (node, class, packed)."""

    def rows(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack, held = zstandard.ZstdDecompressor().decompress, {}

        def own(node: int, packed: bytes) -> np.ndarray:
            if node not in held:
                if len(held) > 64:
                    held.clear()
                held[node] = shingles(unpack(packed))
            return held[node]

        for part in parts:
            keep = []
            for a, b, ta, tb in zip(*(part.column(c).to_pylist() for c in ("a", "b", "ta", "tb"))):
                x, y = own(a, ta), own(b, tb)
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([part.column("u"), part.column("v")], names=["u", "v"]).filter(pa.array(keep, pa.bool_()))

    first = texts.select(F.col("node").alias("a"), F.col("class").alias("u"), F.col("packed").alias("ta"))
    second = texts.select(F.col("node").alias("b"), F.col("class").alias("v"), F.col("packed").alias("tb"))
    return pairs.join(first, "a").join(second, "b").select("a", "b", "u", "v", "ta", "tb").mapInArrow(rows, "u bigint, v bigint")


def packed_texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, class, packed) of the wanted nodes (node, class, text_key): their texts, compressed before they are shuffled.

    A node's text is found by the smallest id of its class and the digest of its bytes.
    """

    def rows(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        for part in parts:
            keys, packed = (pa.array([f(text.as_py()) for text in part.column("text")], pa.binary()) for f in (xxhash.xxh3_128_digest, pack))
            yield pa.RecordBatch.from_arrays([part.column("class"), keys, packed], names=["class", "text_key", "packed"])

    texts = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("class"), text_bytes().alias("text"))
    found = texts.mapInArrow(rows, "class bigint, text_key binary, packed binary").join(wanted, ["class", "text_key"])
    return found.select("node", "class", "packed").dropDuplicates(["node"])


def hub_pairs(members: DataFrame) -> DataFrame:
    """Each member with its bucket's hub: the member that meets most others in all its buckets."""
    degrees = members.groupBy("node").agg(F.sum(F.col("n") - 1).alias("degree"))
    hubs = members.join(degrees, "node").groupBy("bucket").agg(F.max(F.struct("degree", (-F.col("node")).alias("id"))).alias("h")).select("bucket", (-F.col("h.id")).alias("hub"))
    pairs = members.join(hubs, "bucket").where(F.col("node") != F.col("hub"))
    return pairs.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()


def open_documents(members: DataFrame, parts: DataFrame) -> DataFrame:
    """(node, component) of the nodes in buckets that hold several components; members: (bucket, node, class), parts: (id, component)."""
    placed = members.join(parts, F.col("class") == F.col("id"), "left").select("bucket", "node", F.coalesce("component", "class").alias("component"))
    several = placed.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where(F.col("lo") != F.col("hi"))
    return placed.join(several, "bucket", "left_semi").select("node", "component").distinct()


def commonness(texts: DataFrame) -> np.ndarray:
    """How often shingles of each hash cell occur: as many cells as shingles, up to a fixed number."""
    shingles_held = texts.agg(F.sum("n_shingles")).first()[0] or 0
    size = min(MOST_CELLS, max(CELLS, 1 << int(shingles_held).bit_length()))

    def rows(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        unpack = zstandard.ZstdDecompressor().decompress
        total = np.zeros(size, np.int64)
        for part in parts:
            for packed in part.column("packed"):
                np.add.at(total, (shingles(unpack(packed.as_py())) % np.uint64(size)).astype(np.int64), 1)
        yield from ((int(cell), int(total[cell])) for cell in np.flatnonzero(total))

    cells = texts.select("packed").mapInArrow(lambda parts: batches(_CELL_ARROW, rows(parts)), "cell int, n bigint")
    counted = cells.groupBy("cell").agg(F.sum("n").alias("n")).toArrow()  # at most MOST_CELLS rows
    out = np.zeros(size, np.int64)
    out[counted.column("cell").to_numpy()] = counted.column("n").to_numpy()
    return out


def open_pairs(texts: DataFrame, percent: int = LINK_PERCENT) -> DataFrame:
    """All pairs (a, b) of different components that can reach the threshold; texts: (node, n_shingles, packed, component).

    Shingles are put in one order, seldom ones first.  Two sets that reach the threshold share a shingle among the first
    few of both, and from the first such one on enough is left of either; so pairs meet only on those.
    """
    counts = texts.sparkSession.sparkContext.broadcast(commonness(texts))

    def rows(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        unpack = zstandard.ZstdDecompressor().decompress
        for part in parts:
            for node, component, packed in zip(*(part.column(c).to_pylist() for c in ("node", "component", "packed"))):
                own = shingles(unpack(packed))
                n, common = len(own), counts.value[own % np.uint64(len(counts.value))]
                first = own[np.lexsort((own, common))][: n - (percent * n + 99) // 100 + 1]
                for at, h in enumerate(first.view(np.int64).tolist()):
                    yield h, node, component, n, at

    schema = "h bigint, node bigint, component bigint, n bigint, at bigint"
    prefixes = stored(texts.select("node", "component", "packed").mapInArrow(lambda parts: batches(_PREFIX_ARROW, rows(parts)), schema), "minhash-prefixes")
    x, y = (prefixes.select("h", *[F.col(c).alias(f"{c}_{side}") for c in ("node", "component", "n", "at")]) for side in ("a", "b"))
    lengths = (percent * F.col("n_a") <= 100 * F.col("n_b")) & (percent * F.col("n_b") <= 100 * F.col("n_a"))
    left = F.least(F.col("n_a") - F.col("at_a"), F.col("n_b") - F.col("at_b"))
    enough = (100 + percent) * left >= percent * (F.col("n_a") + F.col("n_b"))
    apart = (F.col("node_a") < F.col("node_b")) & (F.col("component_a") != F.col("component_b"))
    met = (x["h"] == y["h"]) & apart & lengths & enough
    return x.join(y, met).select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct()


def linked_by_id(known: DataFrame, classes: DataFrame) -> DataFrame:
    """(u, v): the classes of each doc_id that has several, with the least of them."""
    several = known.groupBy("doc_id").agg(F.min("digest").alias("lo"), F.max("digest").alias("hi")).where(F.col("lo") != F.col("hi"))
    own = known.select("doc_id", "digest").join(several.select("doc_id"), "doc_id", "left_semi").distinct().join(classes, "digest")
    least = own.groupBy("doc_id").agg(F.min("class").alias("u"))
    return own.join(least, "doc_id").select("u", F.col("class").alias("v")).distinct()


def near_duplicates(docs: DataFrame, percent: int = LINK_PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of (doc_id, text)."""
    scan = stored(scanned(docs), "minhash-scan")
    known = scan.where(F.col("doc_id").isNotNull() & F.col("digest").isNotNull())
    first = known.groupBy("digest").agg(F.min(F.struct("doc_id", "item")).alias("first"))
    # Stored, so that joins on the digest see plain tables and their skewed parts can be split.
    classes = stored(first.select("digest", F.col("first.doc_id").alias("class"), F.col("first.item").alias("node")), "minhash-classes")
    own = classes.select("node", "class")
    signed = stored(known.join(own, F.col("item") == F.col("node")).select("node", "class", "n_shingles", "text_key", "signature"), "minhash-signed")
    bands = banded(signed)
    crowded = bands.groupBy("bucket").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    members = stored(bands.join(crowded, "bucket"), "minhash-members")
    pairs = stored(agreeing(hub_pairs(members), signed, percent), "minhash-pairs")
    wanted = signed.select("node", "class", "n_shingles", "text_key").join(members.select("node").distinct(), "node", "left_semi")
    texts = stored(packed_texts(docs, wanted.select("node", "class", "text_key")), "minhash-texts")
    same = stored(linked_by_id(known, classes.select("digest", "class")), "minhash-same")
    links = stored(confirmed(pairs, texts, percent).unionByName(same), "minhash-links")
    parts = components(links).withColumnRenamed("node", "id")
    open_ = open_documents(members.join(wanted.select("node", "class"), "node"), parts)
    apart = stored(texts.join(open_, "node").join(wanted.select("node", "n_shingles"), "node"), "minhash-open")
    late = stored(open_pairs(apart, percent).join(pairs, ["a", "b"], "left_anti"), "minhash-late-pairs")
    late_links = stored(confirmed(late, texts, percent), "minhash-late-links")
    stars = parts.select(F.col("id").alias("u"), F.col("component").alias("v"))
    parts = components(stars.unionByName(late_links))
    of_class = classes.join(parts.select(F.col("node").alias("id"), "component"), F.col("class") == F.col("id"), "left")
    placed = of_class.select("digest", F.coalesce("component", "class").alias("component_id"))
    in_class = known.select("doc_id", "n_shingles", "digest").join(placed, "digest").select("doc_id", "n_shingles", "component_id")
    bare = scan.where(F.col("doc_id").isNull() | F.col("digest").isNull()).select("doc_id", "n_shingles")
    # A row without words goes with the other texts of its document, where there are any.
    with_text = known.join(bare.select("doc_id").distinct(), "doc_id", "left_semi").select("doc_id", "digest")
    of_id = with_text.join(placed, "digest").groupBy("doc_id").agg(F.min("component_id").alias("component_id"))
    alone = bare.join(of_id, "doc_id", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    return in_class.unionByName(alone)


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.withColumn("kept", F.col("doc_id") == F.col("component_id"))
