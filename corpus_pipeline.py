"""From raw documents to packed training sequences: five filters and a packer, each a Spark job over whole tables.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again before the
next one.  The first four return the columns of ``docs``.

1. ``language_id``: documents without a determined language, or with a posterior below ``MIN_SCORE``, go.
2. ``line_dedup``: lines found in many documents stay in one; ``n_chars``, where there is one, follows the text.
3. ``near_dedup``: of each group of documents linked at a similarity of ``NEAR_PERCENT`` in a hundred or more the one with
   the smallest id stays (rows of one doc_id are one document; rows without doc_id are no one's duplicates and stay).
4. ``decontamination``: contaminated documents go (rows equal in doc_id and text share the decision).
5. ``packing``: the pieces of what is left, placed in sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roompulse.llm.decontaminate import judged
from roompulse.llm.language import UNDETERMINED, VOCABULARY, fitted, scored
from roompulse.llm.lines import without_repeated_lines
from roompulse.llm.minhash import near_duplicates
from roompulse.llm.packing import packed_documents
from roompulse.llm.tables import stored, table
from roompulse.llm.tokens import WORD_VOCABULARY, vocabulary

#: Least posterior of the predicted language.
MIN_SCORE = 0.5
#: Least similarity of near duplicates, in a hundred, over sets of five-word shingles.
NEAR_PERCENT = 80


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = scored(docs, fitted(docs.select("doc_id", "text", "lang"), vocabulary(VOCABULARY)))
    kept = (F.col("language.lang_pred") != UNDETERMINED) & (F.col("language.score") >= MIN_SCORE)
    return found.where(kept).select("row.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    text = F.col("text").cast("string")
    changed = {"doc_id": F.col("doc_id"), "text": text, "n_chars": F.length(text).cast("long")}
    return without_repeated_lines(docs).select([changed.get(c, F.col(f"rest.`{c}`")).alias(c) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    copies = near_duplicates(docs, NEAR_PERCENT).where(F.col("doc_id") != F.col("component_id")).select("doc_id")
    return docs.join(copies, "doc_id", "left_anti").select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = judged(docs, table(spark, sf_dir, "benchmark")).where("contaminated")
    bad = found.select(F.col("doc_id").alias("bad_id"), F.col("digest").alias("bad_digest"))
    same = docs["doc_id"].eqNullSafe(bad["bad_id"]) & (F.md5(docs["text"]) == bad["bad_digest"])
    return docs.join(bad, same, "left_anti")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packed_documents(docs, vocabulary(WORD_VOCABULARY))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: SQL can express neither the language models nor the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
