"""Alignment of two tokenizers' tokens over whole documents, in Arrow tables.

Both tokenizers cut the same bytes: a space and the text.  A byte offset where a token of each ends closes a *group*, the
least stretch that both cut alike at its edges; a pair of tokens that end together is a *link*.

1. A batch is encoded by both tokenizers into two flat arrays of ids with the offsets of the documents (list arrays).
   Token bytes are taken from a table of the vocabulary's entries; a document whose bytes are not given back has no tokens.
2. Flattened lists carry their parent indices; a cumulative sum of byte lengths, less the sum at the document's start, is
   every token's end in its document.  Parent and end make one whole number, the document-end key.
3. A hash join (Acero) of both sides on that key gives the links; sorted by key they are also the groups' last tokens.
4. ``Table.group_by`` counts the links of each id pair in the document, and in a *block*, a run of documents of about
   ``BLOCK_BYTES``.  Documents and their pairs are stored, so that no text is encoded twice.
5. Spark adds up the blocks' counts over the corpus, finds each B id's highest, and sends every block the figures of its
   own pairs; a hash join inside the block then sums them for each document.

What is shuffled is one row for each block and distinct pair, and every document's own pairs once, by block; a frequent
pair is one row a block, a long document or a hot source only makes more blocks.  No task holds more than a block (or one
document that is larger).

Defined results: a null or empty text, or one that a tokenizer does not give back byte by byte (such as one that holds
U+2581), has zeros and the digest ''; repeated rows count one by one, in the corpus-wide counts too; a null doc_id is
kept; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roompulse.llm.tables import stored, table, text_bytes
from roompulse.llm.tokens import BYTE_VOCABULARY, PIECE_VOCABULARY, byte_encoder, piece_encoder, vocabulary

#: Text bytes of the documents that one block holds, and of those encoded at once.
BLOCK_BYTES = 8 << 20
SLICE_BYTES = 2 << 20
#: An id pair is one number: the A id times this, plus the B id.
PAIR = 1 << 20

_DOCS = "block bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, pairs array<bigint>, times array<int>"
_DOCS_ARROW = pa.schema(
    [(name, pa.int64()) for name in ("block", "doc_id", "n_a", "n_b", "n_groups", "n_links")]
    + [("groups_sha256", pa.string()), ("pairs", pa.list_(pa.int64())), ("times", pa.list_(pa.int32()))]
)
_OUT = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"
_NUMBERS = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]


def flattened(ids: list[np.ndarray], entries: pa.Array) -> pa.ListArray:
    """One list of token bytes for each document."""
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), entries.take(pa.array(np.concatenate(ids))))


def ends(lists: pa.ListArray) -> tuple[np.ndarray, pa.Table]:
    """Parent index of each token, and its document-end key with its place among the flat tokens."""
    parents, sizes = pc.list_parent_indices(lists).to_numpy(), pc.binary_length(pc.list_flatten(lists))
    running = np.concatenate([[0], pc.cumulative_sum(sizes.cast(pa.int64())).to_numpy()])
    within = running[1:] - running[lists.offsets.to_numpy()[:-1]][parents]
    return parents, pa.table({"key": (parents.astype(np.int64) << 32) + within, "at": np.arange(len(parents))})


def strings(ids: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """The ids of each group as text, by the places of the groups' ends."""
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(ids).cast(pa.string())), ",")


def aligned(texts: pa.Array, a, b) -> tuple[list[np.ndarray], pa.Array, pa.ListArray, pa.ListArray]:
    """Of texts (as bytes): [n_a, n_b, n_groups], the groups as strings, and each one's distinct pairs and their links."""
    rows, expected = len(texts), pc.binary_join_element_wise(pa.scalar(b" ", pa.binary()), texts, b"")
    plain = [t.decode("utf-8", "replace") for t in texts.to_pylist()]
    ids = [a.encode(plain), b.encode(plain)]
    held = pc.greater(pc.binary_length(texts), 0)
    for side, encoder in zip(ids, (a, b)):
        held = pc.and_(held, pc.equal(pc.binary_join(flattened(side, encoder.entries), b""), expected))
    held = held.to_numpy(zero_copy_only=False)
    ids = [[x if h else x[:0] for x, h in zip(side, held)] for side in ids]
    lists = [flattened(side, encoder.entries) for side, encoder in zip(ids, (a, b))]
    flat = [np.concatenate(side) for side in ids]
    (parents, left), (_, right) = map(ends, lists)

    links = left.join(right, "key", right_suffix="_b", join_type="inner").sort_by("key")
    at_a, at_b = links.column("at").to_numpy(), links.column("at_b").to_numpy()
    of_row = parents[at_a] if len(at_a) else np.zeros(0, np.int64)
    n_groups = np.bincount(of_row, minlength=rows)
    # Each group begins behind the tokens that end the one before; documents end together, so this also holds across them.
    groups = pc.binary_join_element_wise(*(strings(f, np.concatenate([[0], at + 1])) for f, at in zip(flat, (at_a, at_b))), "|")
    offsets = np.concatenate([[0], np.cumsum(n_groups)]).astype(np.int32)
    digests = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), groups), ";")

    pairs = flat[0][at_a].astype(np.int64) * PAIR + flat[1][at_b]
    counted = pa.table({"row": of_row, "pair": pairs}).group_by(["row", "pair"]).aggregate([([], "count_all")]).sort_by("row")
    starts = pa.array(np.concatenate([[0], np.cumsum(np.bincount(counted.column("row").to_numpy(), minlength=rows))]).astype(np.int32))
    lists_of = [pa.ListArray.from_arrays(starts, counted.column(c).cast(kind).combine_chunks()) for c, kind in (("pair", pa.int64()), ("count_all", pa.int32()))]
    return [np.array([len(x) for x in side], np.int64) for side in ids] + [n_groups], digests, *lists_of


def documents_aligned(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Every document's counts, the digest of its groups, and its id pairs, with the block it is in."""

    def rows(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b, done, first = byte_encoder(a_path), piece_encoder(b_path), 0, TaskContext.get().partitionId() << 32
        for part in parts:
            sizes = pc.binary_length(part.column("text")).to_numpy()
            before = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
            slices = before[:-1] // SLICE_BYTES
            for number in np.unique(slices):
                lo, hi = np.searchsorted(slices, [number, number + 1])
                own = part.slice(lo, hi - lo)
                numbers, groups, pairs, times = aligned(own.column("text"), a, b)
                sums = [hashlib.sha256(g).hexdigest() if n else "" for g, n in zip(groups.cast(pa.binary()).to_pylist(), numbers[2])]
                block = pa.array(np.full(hi - lo, first + (done + int(before[lo])) // BLOCK_BYTES))
                columns = [block, own.column("doc_id"), *map(pa.array, numbers), pa.array(numbers[2]), pa.array(sums, pa.string()), pairs, times]
                yield pa.RecordBatch.from_arrays(columns, schema=_DOCS_ARROW)
            done += int(before[-1])

    return docs.select(F.col("doc_id").cast("long"), text_bytes().alias("text")).mapInArrow(rows, _DOCS)


def flat_pairs(rows: pa.Table | pa.RecordBatch) -> pa.Table:
    """The pairs of documents with their links and the document's place."""
    lists = rows.column("pairs")
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    times = rows.column("times")
    if isinstance(times, pa.ChunkedArray):
        times = times.combine_chunks()
    return pa.table({"row": pc.list_parent_indices(lists), "pair": pc.list_flatten(lists), "times": pc.list_flatten(times)})


def block_counts(aligned_docs: DataFrame) -> DataFrame:
    """(block, pair, links): the partial counts of Table.group_by, a row for each block and pair (more where reading splits a block)."""
    schema = pa.schema([("block", pa.int64()), ("pair", pa.int64()), ("links", pa.int64())])

    def rows(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, tables in tables_by_block(parts):
            counted = pa.concat_tables(tables).group_by("pair").aggregate([("times", "sum")])
            out = pa.table([pa.array(np.full(len(counted), block)), counted.column("pair"), counted.column("times_sum").cast(pa.int64())], schema=schema)
            yield from out.to_batches()

    return aligned_docs.select("block", "pairs", "times").mapInArrow(rows, "block bigint, pair bigint, links bigint")


def tables_by_block(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[pa.Table]]]:
    """Runs of rows of one block, each batch of it already counted by pair."""
    block, held = None, []
    for part in parts:
        blocks = part.column("block").to_numpy()
        edges = [0, *(np.flatnonzero(np.diff(blocks)) + 1).tolist(), len(blocks)]
        for lo, hi in zip(edges, edges[1:]):
            if hi == lo:
                continue
            if held and blocks[lo] != block:
                yield block, held
                held = []
            block = int(blocks[lo])
            counted = flat_pairs(part.slice(lo, hi - lo)).group_by("pair").aggregate([("times", "sum")])
            held.append(pa.table({"pair": counted.column("pair"), "times": counted.column("times_sum").cast(pa.int64())}))
    if held:
        yield block, held


def pair_counts(counts: DataFrame) -> DataFrame:
    """(pair, a_id, b_id, links, best): every id pair's links in the corpus, and whether they are its B id's most."""
    total = counts.groupBy("pair").agg(F.sum("links").alias("links"))
    ids = total.withColumn("a_id", F.expr(f"pair DIV {PAIR}")).withColumn("b_id", F.col("pair") % PAIR)
    # A B id has no more pairs than the A vocabulary has entries.
    return ids.withColumn("best", F.col("links") == F.max("links").over(Window.partitionBy("b_id"))).select("pair", "a_id", "b_id", "links", "best")


def with_pair_counts(aligned_docs: DataFrame, counts: DataFrame, pairs: DataFrame) -> DataFrame:
    """Documents with n_best and count_sum over their links."""
    figures = counts.select("block", "pair").distinct().join(pairs.select("pair", "links", "best"), "pair")

    def summed(docs: pa.Table, own: pa.Table) -> pa.Table:
        flat = flat_pairs(docs).join(own.select(["pair", "links", "best"]), "pair", join_type="inner")
        times, rows = flat.column("times").to_numpy().astype(np.int64), flat.column("row").to_numpy()
        sums = []
        for per_link in (flat.column("best").cast(pa.int64()), flat.column("links")):
            sums.append(np.zeros(len(docs), np.int64))
            np.add.at(sums[-1], rows, times * per_link.to_numpy())
        return pa.table([*(docs.column(c) for c in _NUMBERS), pa.array(sums[0]), pa.array(sums[1]), docs.column("groups_sha256")], names=[*_NUMBERS, "n_best", "count_sum", "groups_sha256"])

    return aligned_docs.groupBy("block").cogroup(figures.groupBy("block")).applyInArrow(summed, _OUT)


def cross_aligned(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Documents (doc_id, text) with their groups and links under two vocabularies, and the corpus-wide figures of the links."""
    own = stored(documents_aligned(docs, a_path, b_path), "aligned-documents")
    counts = stored(block_counts(own), "aligned-blocks")
    return with_pair_counts(own, counts, pair_counts(counts))


def op11_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_aligned(table(spark, sf_dir, "documents"), vocabulary(BYTE_VOCABULARY), vocabulary(PIECE_VOCABULARY))
