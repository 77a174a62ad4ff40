"""Token ids in ORC files: integer run-length encoding, row indexes, and Bloom filters on document ids.

``write_tokens`` sorts documents by id across files (range partitions, sorted inside), so every stripe and row group
covers a narrow id range: readers of some ids skip the rest by the row index, and absent ids by the Bloom filter.
Stripes are read in parallel.  Each row also says how many ids its file holds before it, so a global position needs
only the files' totals.

Defined results: a null text is empty and gives the end id alone; a null doc_id sorts first; rows of one doc_id lie in
one file, ordered by text; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roompulse.llm.tables import table, text_bytes
from roompulse.llm.tokens import WORD_VOCABULARY, vocabulary, word_encoder
from roompulse.session import shared_folder

END_ID = 2
FILE_SCHEMA = "doc_id bigint, before bigint, n_tokens bigint, tokens array<int>"
ORC_OPTIONS = {
    "compression": "zstd",
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
    "orc.create.index": "true",
    "orc.row.index.stride": "1000",
    "orc.stripe.size": str(32 << 20),
}
#: Ids held before a record batch is handed on.
IDS_PER_BATCH = 2_000_000

_FILE_ARROW = pa.schema([("doc_id", pa.int64()), ("before", pa.int64()), ("n_tokens", pa.int64()), ("tokens", pa.list_(pa.int32()))])
_READ_ARROW = pa.schema([("doc_id", pa.int64()), ("file", pa.string()), ("before", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def write_tokens(docs: DataFrame, path: str, vocabulary_path: str, end_id: int = END_ID) -> None:
    """Documents (doc_id, text) as ids in ascending doc_id order."""

    def encoded(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, before = word_encoder(vocabulary_path), 0
        end = np.array([end_id], "<u4").tobytes()
        ids, lengths, keys, held = [], [], [], 0

        def made():
            nonlocal before
            counts = np.array(lengths, np.int64)
            ends = np.cumsum(counts)
            flat = np.frombuffer(b"".join(ids), "<u4").astype(np.int32)
            tokens = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(flat))
            out = pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(before + ends - counts), pa.array(counts), tokens], schema=_FILE_ARROW)
            before += int(ends[-1])
            return out

        for part in parts:
            for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text")):
                row = encoder.encode(text.as_py()) + end
                ids.append(row)
                lengths.append(len(row) // 4)
                keys.append(doc_id)
                held += lengths[-1]
                if held >= IDS_PER_BATCH:
                    yield made()
                    ids, lengths, keys, held = [], [], [], 0
        if keys:
            yield made()

    ordered = docs.select(F.col("doc_id").cast("long"), text_bytes().alias("text")).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(encoded, FILE_SCHEMA).write.options(**ORC_OPTIONS).orc(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the files (doc_id, before, n_tokens, tokens), with the file each is in."""
    return spark.read.schema(FILE_SCHEMA).orc(path).select("doc_id", F.col("_metadata.file_path").alias("file"), "before", "n_tokens", "tokens")


def file_starts(rows: DataFrame) -> DataFrame:
    """For each file, the ids in all files before it: one row a file, so the running sum is over few rows."""
    totals = rows.groupBy("file").agg(F.sum("n_tokens").alias("total"), F.min("doc_id").alias("first"), F.count("doc_id").alias("named"))
    order = Window.orderBy(F.col("first").asc_nulls_first(), "file").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("file", F.coalesce(F.sum("total").over(order), F.lit(0)).alias("base"))


def token_digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and the crc32 of the ids, from the files alone."""

    def digested(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            tokens = part.column("tokens")
            flat, ends = tokens.flatten().to_numpy().astype("<u4"), np.cumsum(tokens.value_lengths().to_numpy())
            starts = np.concatenate([[0], ends[:-1]])
            crcs = [zlib.crc32(flat[a:b]) for a, b in zip(starts, ends)]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("file"), part.column("before"), pa.array((ends - starts).astype(np.int64)), pa.array(crcs, pa.int64())], schema=_READ_ARROW
            )

    rows = read_tokens(spark, path)
    digests = rows.mapInArrow(digested, "doc_id bigint, file string, before bigint, n_tokens bigint, ids_crc32 bigint")
    return digests.join(file_starts(rows), "file").select("doc_id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "token-files")
    write_tokens(table(spark, sf_dir, "documents"), path, vocabulary(WORD_VOCABULARY))
    return token_digests(spark, path)
