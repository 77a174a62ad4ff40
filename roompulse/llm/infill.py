"""Fill-in-middle examples as a pipeline of Arrow kernels over whole record batches.

A text is cut into units: a run of white space with the word behind it, or white space at the end.  Two cut points, taken
from a hash of the seed and doc_id, give prefix, middle and suffix; the form (plain, psm or spm) comes from the same hash.
For each batch the kernels

1. mark the end of every unit with a byte that UTF-8 never uses, and split there into a list of units a text;
2. flatten the lists, with the parent index of every unit, and take each unit's ordinal in its text;
3. filter the units by role (ordinal before the first cut, between the cuts, behind the second);
4. rebuild one list a text and role, and join each to its piece;
5. join pieces and markers to the output of the text's form.

No step looks at rows one by one, and nothing is shuffled.  A batch is worked off in slices of about ``SLICE_BYTES``, so
memory follows the longest text and not the batch.

A text that holds a marker stays plain.  All markers begin with one character that they hold nowhere else, so no marker
can arise where a piece and a marker meet, and ``restored`` reads the text back from output and form alone.

Defined results: a null text is empty, and an empty one plain; bytes that are no UTF-8 become U+FFFD first; a null doc_id
hashes as no digits; repeated rows give repeated results; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roompulse.llm.tables import table

SEED = 42
#: Texts in a hundred that are transformed, and those of them that put the suffix first.
FIM_PERCENT = 50
SPM_PERCENT = 80
#: Markers before prefix, suffix and middle.
MARKERS = ("<P>", "<S>", "<M>")
#: Text bytes whose units are held at once.
SLICE_BYTES = 4 << 20

#: Units of a text, over its bytes: white space is ASCII, so code points are never cut.
UNIT = rb"([\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+)"
UNIT_END = b"\xff"

OUTPUT_SCHEMA = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"
_OUTPUT_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.string())]
)


def drawn(seed: int, group: int) -> Column:
    """The eight hex digits number ``group`` of the hash of seed and doc_id, as a whole number."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    return F.conv(F.substring(F.sha2(text, 256), 8 * group + 1, 8), 16, 10).cast("long")


def units(texts: pa.Array) -> pa.ListArray:
    """The units of each text; behind the last one an empty string remains."""
    marked = pc.replace_substring_regex(texts, pattern=UNIT, replacement=rb"\1" + UNIT_END)
    return pc.split_pattern(marked, pattern=UNIT_END)


def joined(parents: np.ndarray, values: pa.Array, mask: np.ndarray, rows: int) -> pa.Array:
    """The values chosen by ``mask``, as one string for each of the rows."""
    counts = np.bincount(parents[mask], minlength=rows)
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), values.filter(pa.array(mask))), b"")


def transformed(texts: pa.Array, first: np.ndarray, second: np.ndarray, plain: np.ndarray, spm: np.ndarray, markers: tuple[str, str, str]) -> list[pa.Array]:
    """n, form, prefix_chars, middle_chars and output of texts (as bytes), from the four numbers drawn for each."""
    rows, lists = len(texts), units(texts)
    values, parents = pc.list_flatten(lists), pc.list_parent_indices(lists).to_numpy()
    starts = lists.offsets.to_numpy()[:-1] - lists.offsets[0].as_py()
    n = pc.list_value_length(lists).to_numpy().astype(np.int64) - 1
    lo, hi = np.minimum(first % (n + 1), second % (n + 1)), np.maximum(first % (n + 1), second % (n + 1))
    ordinals = np.arange(len(values)) - starts[parents]
    in_prefix, in_suffix = ordinals < lo[parents], ordinals >= hi[parents]
    prefix, suffix = joined(parents, values, in_prefix, rows), joined(parents, values, in_suffix, rows)
    middle = joined(parents, values, ~in_prefix & ~in_suffix, rows)

    held = pc.match_substring_regex(texts, pattern="|".join(map(re.escape, markers))).to_numpy(zero_copy_only=False)
    plain = pa.array(plain | held | (n == 0))
    form = pc.if_else(plain, "plain", pc.if_else(pa.array(spm), "spm", "psm"))
    p, s, m = (pa.scalar(x.encode(), pa.binary()) for x in markers)
    whole = pc.binary_join_element_wise(p, prefix, s, suffix, m, middle, b"")
    turned = pc.binary_join_element_wise(s, suffix, p, prefix, m, middle, b"")
    output = pc.if_else(plain, texts, pc.if_else(pa.array(spm), turned, whole))
    chars = [pc.if_else(plain, None, pc.utf8_length(x.cast(pa.string())).cast(pa.int64())) for x in (prefix, middle)]
    return [pa.array(n), form, *chars, output.cast(pa.string())]


def fill_in_middle(
    docs: DataFrame, seed: int = SEED, fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT, markers: tuple[str, str, str] = MARKERS
) -> DataFrame:
    """Documents (doc_id, text) as n, form, prefix_chars, middle_chars (null for plain ones) and output."""
    lead = markers[0][:1]
    if not all(x.startswith(lead) and x.count(lead) == 1 for x in markers) or len(set(markers)) < 3:
        raise ValueError("markers must be three, begin with one character and hold it nowhere else")

    def rows(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            sizes = pc.binary_length(part.column("text")).to_numpy()
            slices = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)[:-1]]) // SLICE_BYTES if len(sizes) else sizes
            for at in np.unique(slices):
                lo, hi = np.searchsorted(slices, [at, at + 1])
                own = part.slice(lo, hi - lo)
                columns = [own.column(c).to_numpy(zero_copy_only=False) for c in ("first", "second", "plain", "spm")]
                yield pa.RecordBatch.from_arrays([own.column("doc_id"), *transformed(own.column("text"), *columns, markers)], schema=_OUTPUT_ARROW)

    cut = docs.select(
        F.col("doc_id").cast("long"),
        F.coalesce(F.make_valid_utf8(F.col("text").cast("string")), F.lit("")).cast("binary").alias("text"),
        drawn(seed, 0).alias("first"),
        drawn(seed, 1).alias("second"),
        (drawn(seed, 2) % 100 >= fim_percent).alias("plain"),
        (drawn(seed, 3) % 100 < spm_percent).alias("spm"),
    )
    return cut.mapInArrow(rows, OUTPUT_SCHEMA)


def restored(markers: tuple[str, str, str] = MARKERS) -> Column:
    """The text, from the columns ``output`` and ``form``."""
    parts = F.split("output", "|".join(map(re.escape, markers)), -1)
    second, third, last = (F.get(parts, F.lit(i)) for i in (1, 2, 3))
    return F.when(F.col("form") == "plain", F.col("output")).when(F.col("form") == "psm", F.concat(second, last, third)).otherwise(F.concat(third, last, second))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle(table(spark, sf_dir, "documents"))
    digests = F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(), 256).alias("restored_sha256")
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


OP12_SQL = r"""
WITH cut AS (
    SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units,
           sha256('42:' || doc_id) AS hash
    FROM documents
), drawn AS (
    SELECT *, len(units) AS n, ('0x' || hash[1:8])::BIGINT AS h1, ('0x' || hash[9:16])::BIGINT AS h2, ('0x' || hash[17:24])::BIGINT AS h3, ('0x' || hash[25:32])::BIGINT AS h4
    FROM cut
), placed AS (
    SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS lo, greatest(h1 % (n + 1), h2 % (n + 1)) AS hi,
           CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
    FROM drawn
), pieces AS (
    SELECT *, array_to_string(units[:lo], '') AS prefix, array_to_string(units[lo + 1:hi], '') AS middle, array_to_string(units[hi + 1:], '') AS suffix
    FROM placed
)
SELECT doc_id, n::BIGINT AS n, form,
       CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM pieces
"""
