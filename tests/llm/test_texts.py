"""Token counts, token files, packing, line and byte deduplication, decontamination."""

import gc
import random
import weakref

import brute
import numpy as np
import pytest
from conftest import frame, small_docs
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from roompulse.llm import decontaminate, language, lines, minhash, packing, suffix_dedup, token_counts, token_files, tokens
from roompulse.llm.tokens import BYTE_VOCABULARY, WORD_VOCABULARY, SpanEncoder, WordEncoder, vocabulary
from roompulse.session import shared_folder

WORDS = vocabulary(WORD_VOCABULARY)
ENCODER, PLAIN = WordEncoder(WORDS), Tokenizer.from_file(WORDS)


@given(st.text(st.characters(codec="utf-8"), max_size=60) | st.text("abÀé'st \n\x0b09<|>é", max_size=40))
@settings(max_examples=400, deadline=None)
def test_words_encoded_once_give_the_ids_of_the_text(text):
    assert np.frombuffer(ENCODER.encode(text.encode()), "<u4").tolist() == PLAIN.encode(text, add_special_tokens=False).ids


def test_special_strings_are_encoded_as_in_whole_texts():
    for text in ["<|endoftext|> a<|startoftext|>b", "it's we'll <|endoftext|", "ΣΑΣ ǅ ﬁ"]:
        assert np.frombuffer(ENCODER.encode(text.encode()), "<u4").tolist() == PLAIN.encode(text, add_special_tokens=False).ids


SPANS, BYTES = SpanEncoder(vocabulary(BYTE_VOCABULARY)), Tokenizer.from_file(vocabulary(BYTE_VOCABULARY))
BYTES.encode_special_tokens = True


@given(st.text("abÀé'st \n\t09<|>,.~ß ", max_size=50) | st.text(st.characters(codec="latin-1"), max_size=50) | st.text(st.characters(codec="utf-8"), max_size=30))
@settings(max_examples=500, deadline=None)
def test_spans_of_pieces_are_the_spans_of_the_text(text):
    assert [tuple(x) for x in SPANS.spans(text).tolist()] == BYTES.encode(text, add_special_tokens=False).offsets


def changed_file(tmp_path, name, change):
    import json

    own = json.load(open(vocabulary(name)))
    change(own)
    (tmp_path / name).write_text(json.dumps(own))
    return str(tmp_path / name)


@pytest.mark.parametrize(
    "change",
    [
        lambda own: own["normalizer"]["normalizers"].pop(),
        lambda own: own["pre_tokenizer"]["pretokenizers"][0]["pattern"].update(Regex=r"\S+"),
        lambda own: own["added_tokens"].append({"id": 5, "content": "ab", "single_word": False, "lstrip": False, "rstrip": False, "normalized": False, "special": False}),
    ],
)
def test_a_word_file_of_other_rules_gives_its_own_ids(tmp_path, change):
    path = changed_file(tmp_path, WORD_VOCABULARY, change)
    other, library = WordEncoder(path), Tokenizer.from_file(path)
    assert ENCODER.by_word and not other.by_word
    for text in ["It's ABBA, isn't it? 1234", "Crab cab", "é <|endoftext|> x", ""]:
        assert np.frombuffer(other.encode(text.encode()), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    for text in ["Crab ABBA it's 12"]:
        assert other.encode(text.encode()) != ENCODER.encode(text.encode())


def test_a_byte_file_of_other_rules_gives_its_own_spans(tmp_path):
    path = changed_file(tmp_path, BYTE_VOCABULARY, lambda own: own.update(normalizer={"type": "Prepend", "prepend": "_"}))
    other, library = SpanEncoder(path), Tokenizer.from_file(path)
    library.encode_special_tokens = True
    assert SPANS.by_piece and not other.by_piece
    for text in ["plain words", "don't 12"]:
        assert [tuple(x) for x in other.spans(text).tolist()] == library.encode(text, add_special_tokens=False).offsets


def file_rows(spark, docs):
    path = shared_folder(spark, "test-tokens")
    token_files.write_tokens(docs, path, WORDS)
    return sorted(tuple(r) for r in token_files.token_digests(spark, path).collect()), path


def test_token_files_round_trip(spark, edges):
    docs, rows = edges
    got, path = file_rows(spark, docs)
    assert got == brute.token_rows(rows, PLAIN, token_files.END_ID)
    small, all_rows = small_docs(spark)
    assert file_rows(spark, small)[0] == brute.token_rows(all_rows, PLAIN, token_files.END_ID)
    assert token_files.read_tokens(spark, path).where("doc_id = 31").count() == 1


def test_token_files_of_awkward_and_empty_tables(spark, awkward, nothing):
    got = [tuple(r) for r in token_files.token_digests(spark, _written(spark, awkward[0])).collect()]
    assert len(got) == 6 and sum(r[0] is None for r in got) == 2
    assert sorted(r[1] for r in got)[0] == 0
    assert token_files.token_digests(spark, _written(spark, nothing)).count() == 0


def _written(spark, docs):
    path = shared_folder(spark, "test-tokens")
    token_files.write_tokens(docs, path, WORDS)
    return path


def check_packing(rows, docs, capacity=4096):
    whole = {}
    for r in rows:
        whole.setdefault(r["doc_id"], []).append(r)
    for doc_id, text in docs:
        ids = [*PLAIN.encode(text or "", add_special_tokens=False).ids, packing.END_ID]
        own = sorted(whole[doc_id], key=lambda r: r["piece"])
        assert [r["start"] for r in own] == list(range(0, len(ids), capacity))
        assert [r["length"] for r in own] == [len(ids[i : i + capacity]) for i in range(0, len(ids), capacity)]
        assert [r["ids_crc32"] for r in own] == [brute.zlib.crc32(np.array(ids[i : i + capacity], "<u4").tobytes()) for i in range(0, len(ids), capacity)]
    check_places(rows, capacity)


def check_places(rows, capacity):
    places = {}
    for r in rows:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places)


def test_packing_places_every_piece(spark, edges):
    docs, rows = edges
    got = packing.packed_documents(docs, WORDS).collect()
    check_packing(got, rows)
    small, all_rows = small_docs(spark)
    got = packing.packed_documents(small, WORDS).collect()
    check_packing(got, all_rows)
    assert check_places(got, 4096) <= -(-sum(r["length"] for r in got) // 4096) * 1.05 + 1


def test_packing_in_many_residual_rounds(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_ITEMS", 40)
    rng = random.Random(3)
    items = [(i, 0, 0, rng.choice([rng.randrange(1, 60), rng.randrange(1, 1000), 600]), 0) for i in range(1500)]
    got = packing.pack(spark.createDataFrame(items, packing.PIECE_SCHEMA).repartition(20), 1000).collect()
    assert sorted(r["doc_id"] for r in got) == list(range(1500))
    bound = max(-(-sum(i[3] for i in items) // 1000), sum(i[3] > 500 for i in items))
    assert check_places(got, 1000) <= bound * 1.06


def test_packing_sequences_hold_the_ids(spark, edges):
    docs, rows = edges
    pieces = packing.pieces(docs, WORDS, with_ids=True)
    placed = packing.packed_documents(docs, WORDS)
    whole = {r["sequence_id"]: r["tokens"] for r in packing.sequences(placed, pieces).collect()}
    for r in placed.collect():
        own = whole[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]]
        assert brute.zlib.crc32(np.array(own, "<u4").tobytes()) == r["ids_crc32"]


def test_packing_awkward_and_empty_tables(spark, awkward, nothing):
    got = packing.packed_documents(awkward[0], WORDS).collect()
    assert len(got) == 6
    check_places(got, 4096)
    assert packing.packed_documents(nothing, WORDS).count() == 0


def kept_lines(df):
    return sorted((r["doc_id"], r["n_lines"], r["n_dropped"], bytes(r["text"]).decode()) for r in df.collect())


@pytest.mark.parametrize(("n_batches", "fan_in"), [(1, 2), (5, 2), (5, 3)])
def test_line_dedup_is_exact_for_any_batches(spark, edges, monkeypatch, n_batches, fan_in):
    monkeypatch.setattr(lines.LineRuns.__init__, "__defaults__", (lines.MIN_DOCS, fan_in))
    docs, rows = edges
    assert kept_lines(lines.without_repeated_lines(docs, n_batches)) == sorted(brute.repeated_lines(rows))


def test_line_runs_give_the_same_in_any_order(spark):
    rng = random.Random(1)
    keys = [(d, bytes([k])) for d in range(60) for k in rng.sample(range(30), 4)]
    df = spark.createDataFrame(keys, "doc_id bigint, key binary")
    want = sorted((k, max(d for d, x in keys if x == k)) for k in {k for _, k in keys} if sum(x == k for _, x in keys) >= 3)
    for parts in ([(0, 20), (20, 40), (40, 60)], [(40, 60), (0, 20), (20, 40)]):
        runs = lines.LineRuns(spark)
        for lo, hi in parts:
            runs.add(df.where(f"doc_id >= {lo} AND doc_id < {hi}"))
        assert sorted((bytes(r["key"]), r["keeper"]) for r in runs.frequent().collect()) == want


def test_line_dedup_awkward_and_empty_tables(spark, awkward, nothing):
    got = kept_lines_safe(lines.without_repeated_lines(awkward[0]))
    assert len(got) == 6 and all(r[2] == 0 for r in got)
    assert lines.without_repeated_lines(nothing).count() == 0


def kept_lines_safe(df):
    return [(r["doc_id"], r["n_lines"], r["n_dropped"]) for r in df.collect()]


def bytes_digest(df):
    return sorted((r["doc_id"], r["n_bytes"], sum(s["end"] - s["start"] for s in r["removed"]), len(r["removed"]), brute.sha(bytes(r["kept"]))) for r in df.collect())


def test_repeated_bytes(spark, edges):
    docs, rows = edges
    assert bytes_digest(suffix_dedup.without_repeats(docs)) == sorted(brute.repeated_bytes(rows))


def test_repeated_bytes_over_small_chunks_and_batches(spark, edges, monkeypatch, tiny_batches):
    monkeypatch.setattr(suffix_dedup, "CHUNK", 150)
    monkeypatch.setattr(suffix_dedup, "COMBINED", 9)
    docs, rows = edges
    rows = [r for r in rows if r[0] != 50]
    assert bytes_digest(suffix_dedup.without_repeats(docs.where("doc_id <> 50"))) == sorted(brute.repeated_bytes(rows))


def test_repeated_bytes_at_random(spark, tiny_batches):
    rng = random.Random(5)
    passages = ["".join(rng.choices("abcd \n", k=rng.randrange(60, 260))) for _ in range(12)]
    rows = [(i, "".join(rng.choice(passages)[rng.randrange(50) :] for _ in range(rng.randrange(1, 6)))) for i in range(120)]
    assert bytes_digest(suffix_dedup.without_repeats(frame(spark, rows))) == sorted(brute.repeated_bytes(rows))


def test_a_common_gram_is_dealt_out(spark):
    rng = random.Random(8)
    phrase = "a phrase of some seventy bytes that stands in very many documents !!!!"
    prose = lambda: "".join(rng.choices("abcdefghij ", k=150))
    rows = [(i, prose() + phrase + prose()) for i in range(600)]
    rows += [(1000 + i, rows[i][1][40:330]) for i in range(0, 600, 7)]
    docs = frame(spark, rows)
    assert bytes_digest(suffix_dedup.without_repeats(docs)) == sorted(brute.repeated_bytes(rows))
    met = suffix_dedup.runs(docs).where("span >= 0").groupBy("gram").count().agg({"count": "max"}).first()[0]
    assert met <= 3 * suffix_dedup.UNDER_GRAM


def test_repeated_bytes_awkward_and_empty_tables(spark, awkward, nothing):
    got = suffix_dedup.without_repeats(awkward[0]).collect()
    assert len(got) == 6
    assert all(not r["removed"] for r in got if r["doc_id"] is None)
    assert suffix_dedup.without_repeats(nothing).count() == 0


def test_repeated_bytes_need_one_python_step_between_shuffles(spark):
    text = "a passage that stands in two of the documents and is longer than a window of one hundred bytes, by some"
    got = suffix_dedup.without_repeats(frame(spark, [(1, text), (None, text), (None, None), (2, "é" + text)]))
    rows = sorted((r["doc_id"] or 0, r["n_bytes"], [tuple(s) for s in r["removed"]], bytes(r["kept"])) for r in got.collect())
    n = len(text)
    assert rows == [(0, 0, [], b""), (0, n, [], text.encode()), (1, n, [], text.encode()), (2, n + 2, [(2, n + 2)], "é".encode())]

    def longest(node):
        """Python steps below a step that share its tasks, and the most of them anywhere below."""
        below = [longest(node.children().apply(i)) for i in range(node.children().size())]
        here = max((b[0] for b in below), default=0) if node.nodeName() in ("Project", "Filter", "Union", "MapInArrow") else 0
        here += node.nodeName() == "MapInArrow"
        return here, max([here, *(b[1] for b in below)])

    assert longest(got._jdf.queryExecution().optimizedPlan())[1] == 1


def test_a_worker_gives_up_what_it_remembers_for_other_work():
    encoder = weakref.ref(tokens.word_encoder(WORDS))
    assert tokens.word_encoder(WORDS) is encoder()
    minhash.shingles(b"one two three four five six")
    gc.collect()
    assert encoder() is None
    pieces = weakref.ref(language.pieces(vocabulary(language.VOCABULARY)))
    minhash.shingles(b"one two three four five six")
    gc.collect()
    assert pieces() is None


ITEMS = [(1, None), (2, ""), (3, "alpha1"), (4, "a b c"), (5, "no such words anywhere here"), (6, "A B c d"), (None, "gamma2")]


def hits(df):
    return sorted(tuple(r)[:1] + tuple(r)[2:] for r in df.collect())


@pytest.mark.parametrize("slice_windows", [100_000, 5])
def test_decontamination(spark, edges, monkeypatch, slice_windows):
    monkeypatch.setattr(decontaminate, "SLICE_WINDOWS", slice_windows)
    docs, rows = edges
    items = ITEMS[:-1] + [(7, rows[10][1][:400]), (8, rows[10][1][100:300]), (9, rows[25][1])]
    got = decontaminate.judged(docs, spark.createDataFrame(items, "item_id bigint, text string"))
    assert hits(got) == sorted(brute.contaminated(rows, items))
    assert any(r["contaminated"] for r in got.collect())


def test_decontamination_awkward_and_empty_tables(spark, awkward, edges, nothing):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    assert decontaminate.judged(awkward[0], items).count() == 6
    assert decontaminate.judged(nothing, items).count() == 0
    none = decontaminate.judged(edges[0], items.limit(0)).collect()
    assert len(none) == len(edges[1]) and not any(r["contaminated"] or r["n_hit"] for r in none)


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_token_counts_by_line(spark, rule):
    path = vocabulary(BYTE_VOCABULARY)
    rows = [(1, None), (2, ""), (3, "One line\nand another one.\n\n\n  x = {}\n"), (4, "naïve 文字\n漢字\n😀😀"), (5, "\n\n")]
    got = token_counts.token_counts(frame(spark, rows), path, rule).collect()
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    for doc_id, text in rows:
        own = {r["section"]: r["n_tokens"] for r in got if r["doc_id"] == doc_id}
        assert set(own) - {token_counts.OUTSIDE} == set(range((text or "").count("\n") + 1))
        spans = tokenizer.encode(text or "", add_special_tokens=False).offsets
        assert sum(own.values()) == pytest.approx(len(spans))
        want, at = {}, 0
        bounds = []
        for i, line in enumerate((text or "").split("\n")):
            bounds.append((at, at + len(line), i))
            at += len(line) + 1
        for a, b in spans:
            held = {i: min(b, hi) - max(a, lo) for lo, hi, i in bounds if min(b, hi) > max(a, lo)}
            if not held:
                want[-1] = want.get(-1, 0) + 1
            elif rule == "start":
                want[min(held)] = want.get(min(held), 0) + 1
            elif rule == "most":
                best = min(i for i in held if held[i] == max(held.values()))
                want[best] = want.get(best, 0) + 1
            else:
                for i, n in held.items():
                    want[i] = want.get(i, 0) + n / sum(held.values())
        for i in own:
            assert own[i] == pytest.approx(want.get(i, 0))


def test_token_counts_by_given_sections(spark, awkward, nothing):
    path = vocabulary(BYTE_VOCABULARY)
    docs = frame(spark, [(1, "Hello world, hello"), (2, "none here"), (None, "no id")])
    sections = spark.createDataFrame([(1, 10, 0, 7), (1, 11, 7, 400), (1, 12, 5, 5), (9, 1, 0, 4), (1, 13, None, 4)], "doc_id bigint, section bigint, start bigint, `end` bigint")
    for rule, want in (("start", {10: 2.0, 11: 2.0}), ("most", {10: 1.0, 11: 3.0}), ("split", {10: 1 + 2 / 6, 11: 2 + 4 / 6})):
        got = {(r["doc_id"], r["section"]): r["n_tokens"] for r in token_counts.token_counts(docs, path, rule, sections).collect()}
        assert {s: n for (d, s), n in got.items() if d == 1} == pytest.approx(want)
        assert got[2, -1] == 2.0
    assert token_counts.token_counts(awkward[0], path).count() == 6
    assert token_counts.token_counts(nothing, path).count() == 0
