"""Line deduplication over levelled sorted runs of line hashes.

``LineRuns`` is the store: every run is a table bucketed and sorted by key, one row a key (key, n_docs, keeper: the
largest document holding it).  A new batch is counted by key, merge-anti-joined with each run to leave out keys that
are settled there (frequent enough, with a keeper at least as large), and added as a run of the lowest level.  When a
level has ``fan_in`` runs they are merged into one of the next level.  Runs and batches share their bucketing, so the
runs are never shuffled again for a join.  Any order of batches gives the same final decisions.

Defined results: a null text is one empty line; rows of one doc_id are one document for counting and lose the same
keys; rows without doc_id take no part and stay whole; an empty table gives no rows; other columns pass through.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roompulse.llm.tables import batches, shuffle_width, stored, table, text_bytes

WHITE_SPACE = b" \t\n\x0b\x0c\r"
MIN_CHARS = 20
MIN_DOCS = 3
BATCHES = 4
FAN_IN = 2

_KEY_ARROW = pa.schema([("doc_id", pa.int64()), ("key", pa.binary())])


def line_key(line: bytes, min_chars: int = MIN_CHARS) -> bytes | None:
    """A digest of the line's key, None for one too short to count."""
    key = line.strip(WHITE_SPACE).lower()
    if len(key) < min_chars or (len(key) < 4 * min_chars and len(key.decode("utf-8", "replace")) < min_chars):
        return None
    return hashlib.md5(key).digest()


def line_keys(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """Each document's distinct keys (doc_id, key)."""

    def rows(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for part in parts:
            for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text")):
                for key in {line_key(line, min_chars) for line in text.as_py().split(b"\n")} - {None}:
                    yield doc_id, key

    own = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long"), text_bytes().alias("text"))
    return own.mapInArrow(lambda parts: batches(_KEY_ARROW, rows(parts)), "doc_id bigint, key binary")


class LineRuns:
    """Levels of sorted runs in the warehouse, which all executors share."""

    def __init__(self, spark: SparkSession, min_docs: int = MIN_DOCS, fan_in: int = FAN_IN):
        self.spark, self.min_docs, self.fan_in = spark, min_docs, fan_in
        self.width = shuffle_width(spark)
        self.levels: list[list[str]] = []

    def add(self, keys: DataFrame) -> None:
        """A batch of (doc_id, key)."""
        counts = keys.groupBy("key").agg(F.count_distinct("doc_id").alias("n_docs"), F.max("doc_id").alias("keeper"))
        for name in [name for level in self.levels for name in level]:
            run = self.spark.table(name).select(F.col("key").alias("k"), F.col("n_docs").alias("n"), F.col("keeper").alias("top"))
            settled = (F.col("key") == F.col("k")) & (F.col("n") >= self.min_docs) & (F.col("top") >= F.col("keeper"))
            counts = counts.join(run.hint("merge"), settled, "left_anti")
        self._put(0, self._written(counts))

    def frequent(self) -> DataFrame:
        """(key, keeper) of the keys found in enough documents."""
        names = [name for level in self.levels for name in level]
        counts = self._merged(names) if len(names) > 1 else self.spark.table(names[0])
        return counts.where(F.col("n_docs") >= self.min_docs).select("key", "keeper")

    def drop(self) -> None:
        """Remove all runs."""
        for name in [name for level in self.levels for name in level]:
            self.spark.sql(f"DROP TABLE {name}")
        self.levels = []

    def _merged(self, names: list[str]) -> DataFrame:
        rows = self.spark.table(names[0])
        for name in names[1:]:
            other = self.spark.table(name).select("key", F.col("n_docs").alias("n"), F.col("keeper").alias("top"))
            n_docs = F.coalesce("n_docs", F.lit(0)) + F.coalesce("n", F.lit(0))
            rows = rows.join(other.hint("merge"), "key", "full_outer").select("key", n_docs.alias("n_docs"), F.greatest("keeper", "top").alias("keeper"))
        return rows

    def _written(self, rows: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        rows.repartition(self.width, "key").write.bucketBy(self.width, "key").sortBy("key").saveAsTable(name)
        return name

    def _put(self, level: int, name: str) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)
        if len(self.levels[level]) == self.fan_in:
            olds, self.levels[level] = self.levels[level], []
            self._put(level + 1, self._written(self._merged(olds)))
            for old in olds:
                self.spark.sql(f"DROP TABLE {old}")


def frequent_lines(keys: DataFrame, n_batches: int = BATCHES, min_docs: int = MIN_DOCS, fan_in: int = FAN_IN) -> DataFrame:
    """All keys through the store, batch by batch from the largest ids down, so most keepers come first."""
    runs = LineRuns(keys.sparkSession, min_docs, fan_in)
    cuts = []
    if n_batches > 1:
        shares = F.array(*[F.lit(i / n_batches) for i in range(1, n_batches)])
        cuts = sorted(set(keys.agg(F.percentile_approx("doc_id", shares, 1_000)).first()[0] or []), reverse=True)
    above = None
    for cut in [*cuts, None]:
        part = keys if cut is None else keys.where(F.col("doc_id") >= cut)
        runs.add(part if above is None else part.where(F.col("doc_id") < above))
        above = cut
    # Stored, so that both sides of the later join are shuffled and a line of very many documents is split there.
    found = stored(runs.frequent(), "line-frequent")
    runs.drop()
    return found


def without_repeated_lines(docs: DataFrame, n_batches: int = BATCHES, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """The rows (doc_id, text, rest: the other columns) with repeated lines left out, and n_lines and n_dropped."""
    keys = stored(line_keys(docs, min_chars), "line-keys")
    frequent = frequent_lines(keys, n_batches, min_docs)
    drops = keys.join(frequent, "key").where(F.col("doc_id") != F.col("keeper")).groupBy("doc_id").agg(F.collect_list("key").alias("dropped"))
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    rest = F.struct(*[F.col(f"`{c}`") for c in others]) if others else F.struct(F.lit(0).alias("none"))
    rows = docs.select(F.col("doc_id").cast("long"), text_bytes().alias("text"), rest.alias("rest"))
    rest_type = rows.schema["rest"].dataType.simpleString()

    def kept(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            texts, n_lines, n_dropped = [], [], []
            for text, dropped in zip(part.column("text"), part.column("dropped").to_pylist()):
                text = text.as_py()
                lines = text.split(b"\n")
                n_lines.append(len(lines))
                if dropped:
                    gone = set(dropped)
                    lines = [line for line in lines if line_key(line, min_chars) not in gone]
                    text = b"\n".join(lines)
                texts.append(text)
                n_dropped.append(n_lines[-1] - len(lines))
            arrays = [part.column("doc_id"), pa.array(texts, pa.binary()), part.column("rest"), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "text", "rest", "n_lines", "n_dropped"])

    return rows.join(drops, "doc_id", "left").mapInArrow(kept, f"doc_id bigint, text binary, rest {rest_type}, n_lines bigint, n_dropped bigint")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return without_repeated_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP7_SQL = r"""
WITH lines AS (
  SELECT doc_id, i, l[i] AS line, len(l) AS n_lines
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents), unnest(range(1, len(l) + 1)) AS u(i)
), keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines
), frequent AS (
  SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3
)
SELECT doc_id, max(n_lines)::BIGINT AS n_lines, count(*) FILTER (WHERE keeper <> doc_id)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE keeper IS NULL OR keeper = doc_id), '')) AS kept_sha256
FROM keyed LEFT JOIN frequent USING (k) GROUP BY doc_id
"""
