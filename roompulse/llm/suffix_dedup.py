"""Removal of repeated byte strings by a depth-limited radix sort of suffixes.

Two suffixes that agree through the threshold depth (``WIDTH`` bytes) are a repeated window.  Suffixes are put in order
by most-significant-digit passes, only through that depth, and a group with one member leaves after each pass:

1. The first digit is the suffix's anchor gram: of the ``GRAM``-byte strings in its first ``WIDTH`` bytes, the one of
   least hash, the leftmost if tied.  Equal windows have equal anchors at equal places, and neighbouring suffixes share
   theirs, so one row stands for the run of suffixes of one anchor (some 34 suffixes on average).
2. The second digit is the whole stretch of bytes that the run's suffixes see.  Runs equal in it repeat the earliest of
   them in full and are settled.
3. What is left, distinct stretches of one gram, is opened into its suffixes; their last digit is the window itself.
   In each group of equal windows all but the first are repeats.

Ordering every single suffix would move more than 20 times the input; the anchors lose none, as the anchor is a function
of the window's bytes.  Each pass is a shuffle by digit, a sort, and a scan that holds one row.  Tasks combine their own
equal rows before shuffling: repeats that are known already travel under a key of their own, so a passage that very many
documents share does not meet in one task.  Of a gram with many stretches a task sends the first two under the gram, which
opens whatever else arrives there; the others are open for certain and are dealt out by stretch, so a gram that is common in
different surroundings does not meet in one task either.  Identities are 128 bits for stretches (gram and stretch) and 96 for windows.

Defined results: a null text is empty; rows without doc_id take no part and stay whole; rows of one doc_id are one
document whose removed ranges hold for each of them (equal rows do not remove each other); an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roompulse.llm.tables import stored, table, text_bytes

WIDTH = 100
GRAM = 32
#: Places of a chunk fit the low bits of a packed key; longer texts are taken chunk by chunk.
PLACE_BITS = 24
CHUNK = 1 << 22
#: Rows that a task combines at once.
COMBINED = 200_000
#: A run's length takes the low bits of its span; the highest of them says that the run is dealt out by its stretch.
LENGTH_BITS = 8
BY_STRETCH = 1 << LENGTH_BITS - 1
#: Stretches of a gram that a task sends under the gram.
UNDER_GRAM = 2
#: Documents of a record batch that are Python objects at once.
SLICE_DOCS = 256

_GENERATOR = np.random.Generator(np.random.PCG64(19))
_BYTE = _GENERATOR.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ODD = np.uint64(0x9E3779B97F4A7C15)

_RUN_ARROW = pa.schema([("gram", pa.int64()), ("stretch", pa.int64()), ("doc_id", pa.int64()), ("span", pa.int64())])
_WINDOW_ARROW = pa.schema([("window", pa.int64()), ("tail", pa.int64()), ("doc_id", pa.int64()), ("done", pa.bool_())])
_PART_ARROW = pa.schema([("doc_id", pa.int64()), ("at", pa.int64()), ("length", pa.int64()), ("open", pa.bool_())])
_PART_DDL = "doc_id bigint, at bigint, length bigint, open boolean"


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(31))


def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A 64-bit hash of the ``gram`` bytes (a power of two) at each place, by doubling."""
    h, m = _BYTE[data], 1
    while m < gram:
        h, m = mixed(h[:-m] * _ODD + h[m:]), 2 * m
    return h


def anchored_runs(data: np.ndarray, width: int = WIDTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last suffix of each run that shares an anchor, and the anchor's hash; data holds at least one window."""
    h = gram_hashes(data, gram)
    low = np.uint64((1 << PLACE_BITS) - 1)
    key, m, span = (h & ~low) | np.arange(len(h), dtype=np.uint64), 1, width - gram + 1
    while 2 * m <= span:
        key, m = np.minimum(key[:-m], key[m:]), 2 * m
    if m < span:
        key = np.minimum(key[: len(key) - (span - m)], key[span - m :])
    anchor = (key & low).astype(np.int64)
    cut = np.flatnonzero(np.diff(anchor)) + 1
    first = np.concatenate([[0], cut])
    return first, np.concatenate([cut, [len(anchor)]]) - 1, h[anchor[first]].view(np.int64)


def firsts(*columns: np.ndarray) -> np.ndarray:
    """For sorted columns, whether a row differs from the one before."""
    out = np.ones(len(columns[0]), bool)
    out[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return out


def slices(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of record batches, a few at a time."""
    for part in parts:
        for at in range(0, part.num_rows, SLICE_DOCS):
            yield part.slice(at, SLICE_DOCS)


def runs(docs: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """(gram, stretch, doc_id, span) of each run; a negative span is one already known to repeat an earlier one."""

    def rows(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        n_held = 0

        def made() -> pa.RecordBatch:
            g, ids, span = (np.concatenate([h[i] for h in held]) for i in (0, 1, 2))
            s = np.frombuffer(b"".join([h[3] for h in held]), np.int64)
            order = np.lexsort((span, ids, s, g))
            g, s, ids, span = g[order], s[order], ids[order], span[order]
            # Among equal rows only those after the first document and place repeat it.
            new = firsts(g, s)
            head = np.maximum.accumulate(np.where(new, np.arange(len(g)), 0))
            again = (ids != ids[head]) | (span != span[head])
            heads = np.flatnonzero(new)
            rank = np.arange(len(heads))
            rank -= np.maximum.accumulate(np.where(firsts(g[heads]), rank, 0))
            spread = np.zeros(len(g), bool)
            spread[heads[rank >= UNDER_GRAM]] = True
            g = np.where(spread, mixed(mixed(g.view(np.uint64)) + s.view(np.uint64)).view(np.int64), g)
            span = np.where(spread, span | BY_STRETCH, span)
            g = np.where(again, mixed((ids * 1_000_003 + span).view(np.uint64)).view(np.int64), g)
            return pa.RecordBatch.from_arrays([pa.array(g), pa.array(s), pa.array(ids), pa.array(np.where(again, -span - 1, span))], schema=_RUN_ARROW)

        for part in parts:
            for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text")):
                text = text.as_py()
                for at in range(0, max(0, len(text) - width + 1), CHUNK):
                    data = text[at : at + CHUNK + width - 1]
                    first, last, hashes = anchored_runs(np.frombuffer(data, np.uint8), width, gram)
                    digests = b"".join([hashlib.md5(data[a:b]).digest()[:8] for a, b in zip(first.tolist(), (last + width).tolist())])
                    held.append((hashes, np.full(len(first), doc_id, np.int64), (first + at << LENGTH_BITS) | (last - first + 1), digests))
                    n_held += len(first)
                    if n_held >= COMBINED:
                        yield made()
                        held, n_held = [], 0
        if held:
            yield made()

    own = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long"), text_bytes().alias("text"))
    return own.mapInArrow(rows, "gram bigint, stretch bigint, doc_id bigint, span bigint")


def run_pass(dealt: DataFrame, width: int = WIDTH) -> DataFrame:
    """The first two digits: (doc_id, at, length, open) of repeated byte ranges, and of runs still open (length in suffixes)."""

    def rows(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mask = BY_STRETCH - 1
        last = None  # the stretch's first row, and whether the gram has had another stretch
        waiting = None  # a gram's first stretch, until another one comes

        def out(ids, span, is_open):
            at, length = span >> LENGTH_BITS, span & mask
            return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(at), pa.array(np.where(is_open, length, length + width - 1)), pa.array(is_open)], schema=_PART_ARROW)

        for part in parts:
            g, s, ids, span = (part.column(i).to_numpy() for i in range(4))
            done = span < 0
            if done.any():
                yield out(ids[done], -span[done] - 1, np.zeros(int(done.sum()), bool))
                g, s, ids, span = g[~done], s[~done], ids[~done], span[~done]
            if not len(g):
                continue
            if last is not None:
                g, s, ids, span = (np.concatenate([[x], c]) for x, c in zip(last, (g, s, ids, span)))
            new = firsts(g, s)
            head = np.maximum.accumulate(np.where(new, np.arange(len(g)), 0))
            again = (ids != ids[head]) | (span != span[head])
            if again.any():
                yield out(ids[again], span[again], np.zeros(int(again.sum()), bool))
            heads = np.flatnonzero(new)
            hg = g[heads]
            with_before = np.concatenate([[False], hg[1:] == hg[:-1]])
            with_after = np.concatenate([hg[1:] == hg[:-1], [False]])
            is_open = with_before | with_after | (span[heads] & BY_STRETCH > 0)
            if last is not None:
                # The carried row is the first head here; it is written once, when its gram has a second stretch.
                if not waiting:
                    is_open[0] = False
            if is_open.any():
                chosen = heads[is_open]
                yield out(ids[chosen], span[chosen], np.ones(len(chosen), bool))
            tail = heads[-1]
            carried_over = last is not None and len(heads) == 1
            waiting = waiting if carried_over else not is_open[-1]
            last = (g[tail], s[tail], ids[tail], span[tail])

    ordered = dealt.repartition("gram").sortWithinPartitions("gram", "stretch", "doc_id", "span")
    return ordered.mapInArrow(rows, _PART_DDL)


def opened(texts: DataFrame, open_runs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(window, tail, doc_id, done) for each suffix of open runs; texts: (doc_id, packed)."""

    def rows(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        ids, places, digests = [], [], []

        def made() -> pa.RecordBatch:
            both = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            w, v, doc, at = both[:, 0], both[:, 1] >> 32, np.array(ids, np.int64), np.array(places, np.int64)
            order = np.lexsort((at, doc, v, w))
            w, v, doc, at = w[order], v[order], doc[order], at[order]
            head = np.maximum.accumulate(np.where(firsts(w, v), np.arange(len(w)), 0))
            again = (doc != doc[head]) | (at != at[head])
            w = np.where(again, mixed((doc * 1_000_003 + at).view(np.uint64)).view(np.int64), w)
            return pa.RecordBatch.from_arrays([pa.array(w), pa.array((v << 32) | at), pa.array(doc), pa.array(again)], schema=_WINDOW_ARROW)

        for part in slices(parts):
            for doc_id, packed, own in zip(*(part.column(c).to_pylist() for c in ("doc_id", "packed", "runs"))):
                text = unpack(packed)
                for run in own:
                    span = range(run["at"], min(run["at"] + run["length"], len(text) - width + 1))
                    digests += [hashlib.md5(text[at : at + width]).digest() for at in span]
                    places += span
                    ids += [doc_id] * len(span)
                    if len(ids) >= COMBINED:
                        yield made()
                        ids, places, digests = [], [], []
        if ids:
            yield made()

    by_doc = open_runs.groupBy("doc_id").agg(F.collect_list(F.struct("at", "length")).alias("runs"))
    return texts.join(by_doc, "doc_id").select("doc_id", "packed", "runs").mapInArrow(rows, "window bigint, tail bigint, doc_id bigint, done boolean")


def window_pass(dealt: DataFrame, width: int = WIDTH) -> DataFrame:
    """The last digit: (doc_id, at) of the windows that repeat an earlier one."""

    def rows(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for part in parts:
            w, tail, ids, done = (part.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            again = done.copy()
            live = np.flatnonzero(~done)
            if len(live):
                w, v, own, at = w[live], tail[live] >> 32, ids[live], tail[live] & 0xFFFFFFFF
                if last is not None:
                    w, v, own, at = (np.concatenate([[x], c]) for x, c in zip(last, (w, v, own, at)))
                head = np.maximum.accumulate(np.where(firsts(w, v), np.arange(len(w)), 0))
                later = (own != own[head]) | (at != at[head])
                again[live] = later[1:] if last is not None else later
                last = tuple(c[head[-1]] for c in (w, v, own, at))
            yield pa.RecordBatch.from_arrays([pa.array(ids[again]), pa.array(tail[again] & 0xFFFFFFFF)], names=["doc_id", "at"])

    ordered = dealt.repartition("window").sortWithinPartitions("window", F.shiftright("tail", 32), "doc_id", "tail")
    return ordered.mapInArrow(rows, "doc_id bigint, at bigint")


def packed_texts(docs: DataFrame) -> DataFrame:
    """(doc_id, packed): texts compressed before they are shuffled."""

    def rows(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for part in slices(parts):
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array([pack(t.as_py()) for t in part.column("text")], pa.binary())], names=["doc_id", "packed"])

    return docs.select(F.col("doc_id").cast("long"), text_bytes().alias("text")).mapInArrow(rows, "doc_id bigint, packed binary")


def without_repeats(docs: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """doc_id, n_bytes, the removed runs [start, end) as ``removed``, and the remaining bytes as ``kept``."""

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        span_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for part in slices(parts):
            sizes, spans, kept = [], [], []
            for packed, own in zip(part.column("packed"), part.column("parts")):
                text = unpack(packed.as_py())
                sizes.append(len(text))
                edges = np.zeros(len(text) + 1, np.int32)
                if own.is_valid:
                    flat = own.values
                    at, length = (flat.field(i).to_numpy() for i in (0, 1))
                    np.add.at(edges, np.minimum(at, len(text)), 1)
                    np.add.at(edges, np.minimum(at + length, len(text)), -1)
                gone = np.cumsum(edges)[:-1] > 0
                edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
                spans.append([{"start": int(a), "end": int(b)} for a, b in zip(edge[::2], edge[1::2])])
                kept.append(np.frombuffer(text, np.uint8)[~gone].tobytes())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(spans, span_type), pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "removed", "kept"])

    found = stored(run_pass(runs(docs, width, gram), width), "suffix-runs")
    # Both joins ask for the same rows of the same exchange, so the texts are shuffled once.
    texts = packed_texts(docs).where(F.col("doc_id").isNotNull())
    windows = window_pass(opened(texts, found.where("open"), width), width)
    gone = found.where(~F.col("open")).select("doc_id", "at", "length").unionByName(windows.withColumn("length", F.lit(width).cast("long")))
    by_doc = gone.groupBy("doc_id").agg(F.collect_list(F.struct("at", "length")).alias("parts"))
    schema = "doc_id bigint, n_bytes bigint, removed array<struct<start: bigint, end: bigint>>, kept binary"
    rows = texts.join(by_doc, "doc_id", "left").select("doc_id", "packed", "parts").mapInArrow(cut, schema)
    # Rows without doc_id stay whole; a task that cuts has one worker, as no other step in Python feeds it.
    whole = docs.where(F.col("doc_id").isNull()).select(F.col("doc_id").cast("long"), text_bytes().alias("kept"))
    none = F.array().cast("array<struct<start: bigint, end: bigint>>")
    return rows.unionByName(whole.select("doc_id", F.octet_length("kept").cast("long").alias("n_bytes"), none.alias("removed"), "kept"))


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = without_repeats(table(spark, sf_dir, "documents"))
    length = F.aggregate("removed", F.lit(0).cast("long"), lambda total, r: total + r["end"] - r["start"])
    return found.select("doc_id", "n_bytes", length.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
