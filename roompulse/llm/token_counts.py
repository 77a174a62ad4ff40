"""Token counts by field or section, from one encoding of each whole document.

A document is encoded once, with the span of characters of every token.  Tokens and sections are both in text order, so
the interval join of a document is a merge (binary searches over its sorted bounds); all tokens of a document are in one
row's task, nothing but counts leaves it.  A token that touches several sections is given by rule:

* ``start``: whole, to the first section it touches;
* ``most``: whole, to the section that holds most of its characters, the first of those if tied;
* ``split``: in parts, by its characters in each section it touches.

Tokens that touch no section, such as a line break between two, belong to section -1.

Sections come as rows (doc_id, section, start, end) in code points, not overlapping, or are the text's lines.  Defined
results: a null or empty text has one empty line and no tokens; sections are clipped to the text, empty or reversed ones
hold no tokens; a null doc_id meets no given sections; repeated documents are counted one by one; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roompulse.llm.tables import batches, table, text_bytes
from roompulse.llm.tokens import BYTE_VOCABULARY, span_encoder, vocabulary

RULES = ("start", "most", "split")
OUTSIDE = -1
COUNT_SCHEMA = "doc_id bigint, section bigint, n_chars bigint, n_tokens double, n_crossing bigint"
_COUNT_ARROW = pa.schema([("doc_id", pa.int64()), ("section", pa.int64()), ("n_chars", pa.int64()), ("n_tokens", pa.float64()), ("n_crossing", pa.int64())])


def line_bounds(text: str) -> tuple[np.ndarray, np.ndarray]:
    ends = np.cumsum([len(line) + 1 for line in text.split("\n")])
    return np.concatenate([[0], ends[:-1]]), ends - 1


def allotted(tokens: np.ndarray, starts: np.ndarray, ends: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray, float]:
    """Tokens and boundary-crossing tokens of each section, and the tokens outside all; spans sorted, sections disjoint."""
    counts, crossing = np.zeros(len(starts)), np.zeros(len(starts), np.int64)
    if not len(tokens):
        return counts, crossing, 0.0
    lo, hi = tokens[:, 0], np.maximum(tokens[:, 1], tokens[:, 0] + 1)
    first = np.searchsorted(ends, lo, "right")  # the first section that ends behind the token's start
    last = np.searchsorted(starts, hi, "left") - 1  # the last one that starts before its end
    touched = last - first + 1
    np.add.at(counts, first[touched == 1], 1.0)
    for t in np.flatnonzero(touched > 1):
        own = np.arange(first[t], last[t] + 1)
        held = np.minimum(ends[own], hi[t]) - np.maximum(starts[own], lo[t])
        crossing[own] += 1
        if rule == "start":
            counts[own[0]] += 1
        elif rule == "most":
            counts[own[held.argmax()]] += 1
        else:
            counts[own] += held / held.sum()
    return counts, crossing, float((touched < 1).sum())


def token_counts(docs: DataFrame, vocabulary_path: str, rule: str = "most", sections: DataFrame | None = None) -> DataFrame:
    """(doc_id, section, n_chars, n_tokens, n_crossing) of each section, and of section -1 where it has tokens."""
    if rule not in RULES:
        raise ValueError(f"rule is one of {RULES}")

    given_sections = sections is not None

    def counted(doc_id, text: str, spans: np.ndarray, given) -> Iterator[tuple]:
        if given is None:
            names, (starts, ends) = None, line_bounds(text)
        else:
            kept = sorted((max(0, s["start"]), min(len(text), s["end"]), s["section"]) for s in given if None not in (s["start"], s["end"]))
            names = [n for a, b, n in kept if a < b]
            starts, ends = (np.array([x[i] for x in kept if x[0] < x[1]], np.int64) for i in (0, 1))
        full = np.flatnonzero(ends > starts)
        counts, crossing, outside = allotted(spans, starts[full], ends[full], rule)
        n_tokens, n_crossing = np.zeros(len(starts)), np.zeros(len(starts), np.int64)
        n_tokens[full], n_crossing[full] = counts, crossing
        for i in range(len(starts)):
            yield doc_id, i if names is None else names[i], int(ends[i] - starts[i]), float(n_tokens[i]), int(n_crossing[i])
        if outside:
            yield doc_id, OUTSIDE, 0, outside, 0

    def rows(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        spans = span_encoder(vocabulary_path).spans
        for part in parts:
            given = part.column("sections").to_pylist() if given_sections else [None] * part.num_rows
            for doc_id, text, own in zip(part.column("doc_id").to_pylist(), part.column("text"), given):
                text = text.as_py().decode("utf-8", "replace")
                yield from counted(doc_id, text, spans(text), (own or []) if given_sections else None)

    texts = docs.select(F.col("doc_id").cast("long"), text_bytes().alias("text"))
    if sections is not None:
        spans = F.struct(F.col("section").cast("long").alias("section"), F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"))
        by_doc = sections.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.collect_list(spans).alias("sections"))
        texts = texts.join(by_doc, "doc_id", "left")
    return texts.mapInArrow(lambda parts: batches(_COUNT_ARROW, rows(parts)), COUNT_SCHEMA)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), vocabulary(BYTE_VOCABULARY))
