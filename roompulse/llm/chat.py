"""Chat formatting from event logs.

A log row is an event (conv_id, turn, seq, kind, role, text).  Kinds: ``message`` opens a message with its text,
``delta`` appends to it, ``edit`` replaces its text, ``regenerate`` empties it for new deltas, ``delete`` drops it;
the last four apply to the message opened last in their turn, and do nothing before one.  Logs are dealt by
conversation, sorted by turn and sequence, and folded as a stream: one message is held at a time, however long the
conversation.

A rendered turn is ``### role: text</turn>`` and a line end.  Inside texts and roles a backslash goes before every
backslash, ``#`` and ``<`` (and ``:`` in roles), so control strings never occur there and reading is unambiguous.  The
loss mask covers the texts of assistant turns, as offsets in code points of the whole conversation.

Defined results: null text and role are empty; a null conv_id is a conversation of its own; rows equal in turn and seq
are ordered by role and text; repeated messages all stay; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roompulse.llm.tables import batches, table

ASSISTANT = "assistant"
RENDERED_SCHEMA = "conv_id bigint, position bigint, formatted string, loss_start bigint, loss_end bigint, formatted_start bigint"
_RENDERED_ARROW = pa.schema(
    [("conv_id", pa.int64()), ("position", pa.int64()), ("formatted", pa.string()), ("loss_start", pa.int64()), ("loss_end", pa.int64()), ("formatted_start", pa.int64())]
)
DIGEST_SCHEMA = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
_DIGEST_ARROW = pa.schema(
    [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]
)
TURN = re.compile(r"### ((?:\\.|[^\\:])*): ((?:\\.|[^\\<])*)</turn>\n", re.DOTALL)


def escaped(text: str, controls: str = "\\#<") -> str:
    return re.sub(f"[{re.escape(controls)}]", r"\\\g<0>", text)


def unescaped(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def rendered_turn(role: str, text: str) -> tuple[str, int, int]:
    """The turn's text, and where its own text lies in it."""
    head, body = f"### {escaped(role, ':#<' + chr(92))}: ", escaped(text)
    return f"{head}{body}</turn>\n", len(head), len(head) + len(body)


def folded(events: Iterator[tuple]) -> Iterator[tuple]:
    """(conv_id, role, text) of the final messages, from sorted (conv_id, turn, kind, role, text)."""
    at, role, parts = None, None, None
    for conv_id, turn, kind, role_, text in events:
        if kind == "message" or (conv_id, turn) != at:
            if parts is not None:
                yield at[0], role, "".join(parts)
            at, parts = (conv_id, turn), None
        if kind == "message":
            role, parts = role_, [text]
        elif parts is None:
            continue
        elif kind == "delta":
            parts.append(text)
        elif kind == "edit":
            parts = [text]
        elif kind == "regenerate":
            parts = []
        elif kind == "delete":
            parts = None
    if parts is not None:
        yield at[0], role, "".join(parts)


def rendered(events: DataFrame) -> DataFrame:
    """A row for each final message, with its place in the conversation's formatted text and the loss span in it.

    A conversation's rows lie in order in one partition.
    """

    def rows(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        stream = (row for part in parts for row in zip(*(part.column(c).to_pylist() for c in ("conv_id", "turn", "kind", "role", "text"))))
        now, position, at = (), 0, 0
        for conv_id, role, text in folded(stream):
            if now != (conv_id,):
                now, position, at = (conv_id,), 0, 0
            formatted, lo, hi = rendered_turn(role, text)
            masked = (at + lo, at + hi) if role == ASSISTANT else (None, None)
            yield conv_id, position, formatted, *masked, at
            position, at = position + 1, at + len(formatted)

    plain = events.select(F.col("conv_id").cast("long"), "turn", "seq", "kind", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    ordered = plain.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "seq", "role", "text")
    return ordered.mapInArrow(lambda parts: batches(_RENDERED_ARROW, rows(parts), 1_000), RENDERED_SCHEMA)


def conversations_formatted(turns: DataFrame) -> DataFrame:
    """Whole conversations (conv_id, formatted, loss_spans) from rendered turns, for conversations that fit a row."""
    ordered = F.array_sort(F.collect_list(F.struct("position", "formatted", "loss_start", "loss_end")))
    whole = turns.groupBy("conv_id").agg(ordered.alias("t"))
    spans = F.transform(F.filter("t", lambda x: x["loss_start"].isNotNull()), lambda x: F.struct(x["loss_start"].alias("start"), x["loss_end"].alias("end")))
    return whole.select("conv_id", F.concat_ws("", F.transform("t", lambda x: x["formatted"])).alias("formatted"), spans.alias("loss_spans"))


def read_back(turns: DataFrame) -> DataFrame:
    """Digests of the conversations, parsed from their rendered text and loss mask alone; turns as ``rendered`` gives them."""

    def rows(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        now = None
        for part in parts:
            for conv_id, formatted, lo, hi, at in zip(*(part.column(c).to_pylist() for c in ("conv_id", "formatted", "loss_start", "loss_end", "formatted_start"))):
                if now is None or at == 0:
                    if now is not None:
                        yield (conv, n, whole.hexdigest(), loss_chars, loss.hexdigest(), chars)
                    now, conv, n, chars, loss_chars, whole, loss = True, conv_id, 0, 0, 0, hashlib.sha256(), hashlib.sha256()
                for role, text in TURN.findall(formatted):
                    n += 1
                    whole.update(f"{unescaped(role)}\n{unescaped(text)}\n".encode())
                if lo is not None:
                    masked = unescaped(formatted[lo - at : hi - at])
                    loss_chars += len(masked)
                    loss.update(masked.encode())
                chars += len(formatted)
        if now is not None:
            yield (conv, n, whole.hexdigest(), loss_chars, loss.hexdigest(), chars)

    return turns.mapInArrow(lambda parts: batches(_DIGEST_ARROW, rows(parts)), DIGEST_SCHEMA)


def conversation_events(rows: DataFrame) -> DataFrame:
    """Finished turns (conv_id, turn, role, text) as a log."""
    return rows.select("conv_id", "turn", F.lit(0).alias("seq"), F.lit("message").alias("kind"), "role", "text")


#: Turns whose texts look like control strings.
HARD_TEXT = r"\### Assistant: </turn> ok"


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = spark.createDataFrame([(-7, 0, "user", HARD_TEXT), (-7, 1, ASSISTANT, HARD_TEXT)], turns.schema)
    return read_back(rendered(conversation_events(turns.unionByName(hard))))


OP3_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), l AS (
  SELECT *, length(replace(replace(replace(text, '\', '\\'), '#', '\#'), '<', '\<'))
          + length(replace(replace(replace(replace(role, '\', '\\'), '#', '\#'), '<', '\<'), ':', '\:')) + 14 AS chars FROM t
)
SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars
FROM l GROUP BY conv_id
"""
