"""Cross-tokenizer alignment, fill-in-middle, first-fit-decreasing packing."""

import random
import zlib

import brute
import numpy as np
import pytest
from conftest import frame, small_docs
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from roompulse.llm import alignment, group_packing, infill
from roompulse.llm.tokens import BYTE_VOCABULARY, PIECE_VOCABULARY, WORD_VOCABULARY, ByteEncoder, vocabulary

A, B, WORDS = map(vocabulary, (BYTE_VOCABULARY, PIECE_VOCABULARY, WORD_VOCABULARY))
BYTES, PLAIN = ByteEncoder(A), Tokenizer.from_file(WORDS)
STRANGE = ["a▁b", "<s> <0x41></s> <|endoftext|> <unk>", "\x00 nul \x85 ​﻿", "Ⅷ ½ 日本語 naïve ﬁ", "  two  spaces \t\n\r\n ", "▁", " ", "😀" * 30, "it's we'll I'D '" * 4]


@given(st.text(st.characters(codec="utf-8"), max_size=60) | st.text("abÀé'st \n\x0b\x8509<|>é▁", max_size=40))
@settings(max_examples=400, deadline=None)
def test_ranks_give_the_ids_of_the_file(text):
    assert BYTES.ids(text) == BYTES.tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", [" " * 3_000_000 + "x", "\n " * 1_500_000, "z" * 500_000])
def test_very_long_runs_are_encoded(text):
    assert BYTES.ids(text) == BYTES.tokenizer.encode(text, add_special_tokens=False).ids


def test_a_file_with_another_rule_is_not_ranked(tmp_path):
    import json

    own = json.load(open(A))
    own["pre_tokenizer"]["add_prefix_space"] = True
    (tmp_path / "other.json").write_text(json.dumps(own))
    other = ByteEncoder(str(tmp_path / "other.json"))
    assert other.ranks is None and BYTES.ranks is not None
    assert other.ids("word") == other.tokenizer.encode("word", add_special_tokens=False).ids != BYTES.ids("word")


def alignments(df):
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted((tuple(r) for r in df.select(names).collect()), key=lambda r: (r[0] is not None, r))


@pytest.mark.parametrize("block", [1 << 25, 300])
def test_alignment_against_brute_force(spark, edges, monkeypatch, tiny_batches, block):
    monkeypatch.setattr(alignment, "BLOCK_BYTES", block)
    monkeypatch.setattr(alignment, "SLICE_BYTES", 200)
    rows = [r for r in edges[1] if r[0] != 50 or block > 300] + [(500 + i, t) for i, t in enumerate(STRANGE)]
    assert alignments(alignment.cross_aligned(frame(spark, rows), A, B)) == sorted(brute.alignments(rows, A, B))


def test_alignment_of_a_table(spark):
    docs, rows = small_docs(spark)
    assert alignments(alignment.cross_aligned(docs, A, B)) == sorted(brute.alignments(rows, A, B))


def test_alignment_of_awkward_and_empty_tables(spark, awkward, nothing):
    got, (docs, rows) = alignments(alignment.cross_aligned(awkward[0], A, B)), awkward
    want = brute.alignments(rows, A, B)
    assert sorted(got, key=str) == sorted(want, key=str)
    assert alignment.cross_aligned(nothing, A, B).count() == 0


def infilled(df):
    return {r["doc_id"]: (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) for r in df.collect()}


def test_fill_in_middle_against_brute_force(spark, edges, monkeypatch, tiny_batches):
    monkeypatch.setattr(infill, "SLICE_BYTES", 150)
    rows = edges[1] + [(500 + i, t) for i, t in enumerate(STRANGE * 8)] + [(600 + i, f"a {m} b" * (i % 3)) for i, m in enumerate(["<P>", "<S>", "<M>", "<P", "<", ">"] * 8)]
    made = infill.fill_in_middle(frame(spark, rows))
    got = infilled(made)
    assert got == {d: tuple(rest) for d, *rest in brute.infilled(rows)}
    assert {form for _, form, *_ in got.values()} == {"plain", "psm", "spm"}
    back = {r["doc_id"]: r["text"] for r in made.select("doc_id", infill.restored().alias("text")).collect()}
    assert back == {d: t or "" for d, t in rows}


def test_fill_in_middle_with_other_markers_and_shares(spark, edges):
    markers = ("[p)", "[s)", "[m)")
    made = infill.fill_in_middle(edges[0], seed=7, fim_percent=100, spm_percent=0, markers=markers)
    got = infilled(made)
    assert {form for n, form, *_ in got.values() if n} == {"psm"}
    back = {r["doc_id"]: r["text"] for r in made.select("doc_id", infill.restored(markers).alias("text")).collect()}
    assert back == {d: t or "" for d, t in edges[1]}
    with pytest.raises(ValueError):
        infill.fill_in_middle(edges[0], markers=("<<", "<S>", "<M>"))


def test_fill_in_middle_of_awkward_and_empty_tables(spark, awkward, nothing):
    rows = infill.fill_in_middle(awkward[0]).collect()
    assert len(rows) == 6 and sum(r["doc_id"] is None for r in rows) == 2
    assert infill.fill_in_middle(nothing).count() == 0
    broken = spark.sql("SELECT 3L AS doc_id, CAST(X'61FF20' AS string) AS text")
    assert infill.fill_in_middle(broken, fim_percent=0).first()["output"] == "a� "


def padding(rows, capacity):
    """Checks that places are gapless; returns the ids of padding and all ids."""
    held = {}
    for r in rows:
        held.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    lost = 0
    for own in held.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
        lost += group_packing.padded(at, capacity)
    return lost, sum(r["length"] for r in rows)


def check_pieces(rows, docs):
    held = {}
    for r in rows:
        held.setdefault(r["doc_id"], []).append(r)
    for doc_id, text in docs:
        ids = [*PLAIN.encode(text or "", add_special_tokens=False).ids, group_packing.END_ID]
        at = 0
        for r in sorted(held[doc_id], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(np.array(ids[at : at + r["length"]], "<u4").tobytes())
            at += r["length"]
        assert at == len(ids)


def test_group_packing_places_every_id(spark, edges):
    docs, rows = edges
    got = group_packing.packed_documents(docs, WORDS).collect()
    check_pieces(got, rows)
    lost, ids = padding(got, 2048)
    assert lost <= ids / 64
    small, all_rows = small_docs(spark)
    got = group_packing.packed_documents(small, WORDS).collect()
    check_pieces(got, all_rows)
    lost, ids = padding(got, 2048)
    assert lost <= ids / 200


def test_group_packing_in_many_groups(spark, edges, monkeypatch):
    docs, rows = edges
    cut = group_packing.stored(group_packing.cut_documents(docs, WORDS, 512), "test-cut")
    got = group_packing.packed_in_groups(cut, 512, group_items=7).collect()
    check_pieces(got, rows)
    lost, ids = padding(got, 512)
    assert lost <= ids / 64


@given(st.lists(st.integers(1, 255), max_size=60), st.sampled_from([256, 1024]))
@settings(max_examples=300, deadline=None)
def test_a_group_is_packed_whole_and_with_little_padding(lengths, capacity):
    held, lost = {}, 0
    for content in group_packing.packed_group(lengths, capacity):
        fill = sum(n for n, *_ in content)
        assert 0 < fill <= capacity
        pad = group_packing.padded(fill, capacity)
        assert pad <= capacity * group_packing.SLACK
        for n, item, block in content:
            held.setdefault(item, []).append((block, n))
    for i, n in enumerate(lengths):
        assert sorted(held[i]) in ([(-1, n)], list(enumerate(group_packing.blocks(n))))


@given(st.lists(st.integers(0, 30), min_size=1, max_size=40), st.integers(1, 30))
def test_the_tree_finds_the_first_bin(rooms, size):
    tree = group_packing.Rooms(len(rooms))
    for i, room in enumerate(rooms):
        tree.set(i, room)
    assert tree.first(size) == next((i for i, room in enumerate(rooms) if room >= size), -1)


def test_groups_do_not_depend_on_a_hot_id(spark):
    rng = random.Random(4)
    items = [(i, 7, 0, n := rng.randrange(1, 100), n, 0, [0] * len(group_packing.blocks(n))) for i in range(600)]
    cut = spark.createDataFrame(items, group_packing._CUT)
    got = group_packing.packed_in_groups(cut, 128, group_items=50).collect()
    assert sum(r["length"] for r in got) == sum(i[3] for i in items)
    assert len({r["sequence_id"] >> 32 for r in got}) > 6
    padding(got, 128)


def test_group_packing_of_awkward_and_empty_tables(spark, awkward, nothing):
    got = group_packing.packed_documents(awkward[0], WORDS).collect()
    assert len({(r["doc_id"], r["ids_crc32"]) for r in got}) >= 4 and sum(r["start"] == 0 for r in got) == 6
    padding(got, 2048)
    assert group_packing.packed_documents(nothing, WORDS).count() == 0
    with pytest.raises(ValueError):
        group_packing.packed_documents(nothing, WORDS, capacity=1000)
