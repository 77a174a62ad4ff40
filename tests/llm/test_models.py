"""Near duplicates, languages, chats, neighbours, and the pipeline."""

import itertools
import math
import random
import re
import zlib

import brute
import corpus_pipeline
import numpy as np
import pytest
from conftest import SMALL, frame, small_docs
from oracle_check import compare, connect
from tokenizers import Tokenizer

from roompulse.llm import chat, components, language, minhash, neighbours
from roompulse.llm.queries import ORACLE, QUERIES
from roompulse.llm.tokens import WORD_VOCABULARY, vocabulary

CHECKED = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    assert compare(spark, connect(CHECKED), CHECKED, name, QUERIES[name], ORACLE[name]) == []


def classes(df):
    return sorted(tuple(r) for r in df.select("doc_id", "n_shingles", "component_id").collect())


def test_near_duplicates_on_tables(spark):
    docs = spark.read.parquet(f"{CHECKED}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    want = sorted(brute.linked_components(rows))
    assert classes(minhash.near_duplicates(docs)) == want
    assert any(d != c for d, _, c in want)


def test_near_duplicates_near_the_threshold(spark, edges, monkeypatch):
    monkeypatch.setattr(minhash, "MOST_CELLS", 64)
    rng = random.Random(11)
    rows = [r for r in edges[1] if r[0] != 50]
    for family in range(4):
        base = [f"w{rng.randrange(500)}" for _ in range(90)]
        for i in range(40):
            copy = list(base)
            for _ in range(rng.randrange(4)):
                copy[rng.randrange(len(copy))] = f"new{rng.randrange(10**6)}"
            rows.append((1000 * (family + 1) + rng.randrange(900), " ".join(copy)))
    rows = list(dict(rows).items())
    want = sorted(brute.linked_components(rows))
    assert classes(minhash.near_duplicates(frame(spark, rows))) == want


@pytest.mark.parametrize("percent", [60, 80, 85, 95])
def test_signature_bound_follows_the_threshold(percent):
    least, share = np.ceil(minhash.least_share(percent) * minhash.MINIMA - 1e-9), percent / 100
    dropped = sum(math.comb(minhash.MINIMA, i) * share**i * (1 - share) ** (minhash.MINIMA - i) for i in range(int(least)))
    assert dropped < 1e-4


def test_near_duplicates_at_another_threshold(spark):
    rng, rows = random.Random(5), []
    for family in range(60):
        base = [f"w{family}-{i}" for i in range(300)]
        rows.append((10 * family, " ".join(base)))
        for i in range(1, 4):
            copy = list(base)
            for at in rng.sample(range(0, 300, 6), 4 + i + family % 3):
                copy[at] = f"new{family}-{i}-{at}"
            rows.append((10 * family + i, " ".join(copy)))
    want = sorted(brute.linked_components(rows, 80))
    assert want != sorted(brute.linked_components(rows, 85))
    assert classes(minhash.near_duplicates(frame(spark, rows), 80)) == want


def test_late_pairs_do_not_depend_on_signatures(spark, monkeypatch):
    monkeypatch.setattr(minhash, "SIGNATURE_SLACK", -1_000.0)
    base = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join([*base[:i], f"new{i}", *base[i + 1 :]])) for i in range(12)]
    want = sorted(brute.linked_components(rows))
    assert {c for _, _, c in want} == {0}
    assert classes(minhash.near_duplicates(frame(spark, rows))) == want


@pytest.mark.parametrize("order", [[0, 1, 2, 3, 4, 5], [0, 2, 1, 3, 4, 5], [5, 4, 3, 2, 1, 0]])
def test_texts_of_one_id_are_one_document(spark, order):
    a, b = ([f"{x}{i}" for i in range(120)] for x in "ab")
    near = lambda words, x: " ".join([*words[:60], x, *words[61:]])
    rows = [(1, " ".join(a)), (5, near(a, "x")), (5, " ".join(b)), (9, near(b, "y")), (9, ""), (7, "another text that stands for itself")]
    df = spark.createDataFrame([rows[i] for i in order], "doc_id bigint, text string").coalesce(1)
    got = {(r["doc_id"], r["component_id"]) for r in minhash.near_duplicates(df).collect()}
    assert got == {(1, 1), (5, 1), (9, 1), (7, 7)}


def test_near_duplicates_of_awkward_and_empty_tables(spark, awkward, nothing):
    got = {(r["doc_id"], r["n_shingles"]): r["component_id"] for r in minhash.near_duplicates(awkward[0]).collect()}
    assert got[8, 1] == 7 and got[None, 0] is None
    assert minhash.near_duplicates(nothing).count() == 0


def test_components_of_paths_stars_and_rings(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(40)] + [(200 + i, 200 + (i + 1) % 30) for i in range(30)] + [(5, 5)]
    rng.shuffle(edges)
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert got == {i: 0 for i in range(1, 61)} | {100 + i: 100 for i in range(1, 40)} | {200 + i: 200 for i in range(1, 30)}
    assert components.components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def all_cuts(word):
    """Every way to cut a word, with no limit on the length of a piece."""
    if not word:
        yield []
    for k in range(1, len(word) + 1):
        for rest in all_cuts(word[k:]):
            yield [word[:k], *rest]


def test_forward_sums_all_cuts_and_counts_are_expected():
    own = language.pieces(vocabulary(language.VOCABULARY))
    p = np.random.default_rng(1).random((own.size, 2)) + 0.1
    long_piece = max((x for x in own.numbers if not x.startswith(language.MARK)), key=len)
    assert len(long_piece) > 8
    words = ["the", "été", "straße", "quick", "日x", long_piece]
    langs = np.array([0, 1, 0, 1, 1, 0])
    logs = language.likelihoods(words, own, p)
    counts = language.expected_counts(words, langs, np.full(len(words), 2.0), own, p)
    want = np.zeros_like(counts)
    for w, lang, got in zip(words, langs, logs):
        cuts = []
        for cut in all_cuts(language.MARK + w):
            ids = [own.numbers.get(c, 0 if len(c) == 1 else None) for c in cut]
            if None not in ids:
                cuts.append(ids)
        for x in (0, 1):
            assert got[x] == pytest.approx(np.log(sum(np.prod(p[ids, x]) for ids in cuts)))
        total = sum(np.prod(p[ids, lang]) for ids in cuts)
        for ids in cuts:
            for i in ids:
                want[i, lang] += 2 * np.prod(p[ids, lang]) / total
    assert counts == pytest.approx(want)


def plain_forward(word, own, p):
    """Exact sums in whole numbers of a large denominator, so that nothing can underflow."""
    from fractions import Fraction

    marked, sums = language.MARK + word, [Fraction(1)]
    for end in range(1, len(marked) + 1):
        total = Fraction(0)
        for start in range(end):
            piece = own.numbers.get(marked[start:end], 0 if end - start == 1 else None)
            if piece is not None:
                total += sums[start] * Fraction(p[piece])
        sums.append(total)
    return sums[-1]


@pytest.mark.parametrize("chunk", [40_000, 7])
def test_long_words_are_summed_whole(monkeypatch, chunk):
    monkeypatch.setattr(language, "CHUNK", chunk)
    own = language.pieces(vocabulary(language.VOCABULARY))
    p = np.random.default_rng(2).random((own.size, 1)) * 1e-7
    rng = random.Random(3)
    words = ["international" * 5, "".join(rng.choices("abcdefghijklmnop", k=60)), "z" * 150]
    for word, got in zip(words, language.likelihoods(words, own, p)):
        want = plain_forward(word, own, p[:, 0].tolist())
        assert got[0] == pytest.approx(math.log(want.numerator) - math.log(want.denominator))
    # Every letter lies in one piece, whatever the cut: lengths weighted by expected counts are the letters and the mark.
    counts = language.expected_counts(words, np.zeros(3, np.int64), np.ones(3), own, p)
    lengths = np.array([1, *map(len, own.numbers)])
    assert (counts[:, 0] * lengths).sum() == pytest.approx(sum(len(w) + 1 for w in words))


def test_language_of_every_document_against_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang")
    model = language.fitted(docs, vocabulary(language.VOCABULARY))
    own, memory = language.pieces(model.path), {}

    def log_likelihoods(word):
        if word not in memory:
            marked, sums, logs = language.MARK + word, [np.ones(len(model.langs))], 0.0
            for end in range(1, len(marked) + 1):
                total = np.zeros(len(model.langs))
                for start in range(end):
                    piece = own.numbers.get(marked[start:end], 0 if end - start == 1 else None)
                    if piece is not None:
                        total += sums[start] * model.probabilities[piece]
                sums.append(total)
            memory[word] = np.log(sums[-1])
        return memory[word]

    got = {r["row"]["doc_id"]: r["language"] for r in language.scored(docs.select("doc_id", "text"), model).collect()}
    for doc_id, text, _ in docs.collect():
        words = "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()
        if not words:
            assert got[doc_id]["lang_pred"] == "und" and got[doc_id]["score"] == 0
            continue
        total = model.priors + sum(log_likelihoods(w) for w in words)
        best = int(total.argmax())
        assert got[doc_id]["lang_pred"] == model.langs[best]
        assert got[doc_id]["score"] == pytest.approx(1 / np.exp(total - total[best]).sum())


def test_numerals_are_no_letters(spark):
    train = spark.read.parquet(f"{CHECKED}/documents.parquet").select("doc_id", "text", "lang")
    model = language.fitted(train, vocabulary(language.VOCABULARY), train_docs=50, rounds=1)
    texts = ["½ ²", "Ⅷ", "①", "x½y", "৪", "ⅷab", "_", "é"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = [r["language"]["lang_pred"] for r in language.scored(docs, model).orderBy("row.doc_id").collect()]
    assert [x == "und" for x in got] == [True, True, True, False, True, False, True, False]
    assert language.words_of("X½y ⅷAb") == ["x", "y", "ab"]


def test_language_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{CHECKED}/documents.parquet")
    langs = {r[0]: r[1] for r in docs.select("doc_id", "lang").collect()}
    rows = QUERIES["op6_language_id"](spark, CHECKED).collect()
    held = [r for r in rows if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i in langs if zlib.crc32(str(i).encode()) % 4 == 2}
    assert np.mean([r["lang_pred"] == langs[r["doc_id"]] for r in held]) >= 0.98
    assert all(0 <= r["score"] <= 1 for r in rows) and len(rows) == len(langs)


def test_language_of_edges_awkward_and_empty_tables(spark, edges, awkward, nothing):
    train = spark.read.parquet(f"{CHECKED}/documents.parquet").select("doc_id", "text", "lang")
    model = language.fitted(train, vocabulary(language.VOCABULARY), train_docs=50, rounds=1)
    got = {r["row"]["doc_id"]: r["language"]["lang_pred"] for r in language.scored(edges[0], model).collect()}
    assert got[1] == got[2] == got[3] == got[5] == "und" and got[4] != "und" and got[51] != "und"
    assert language.scored(awkward[0], model).count() == 6
    assert language.scored(nothing, model).count() == 0
    unlabelled = language.fitted(train.selectExpr("doc_id", "text", "CAST(NULL AS string) AS lang"), vocabulary(language.VOCABULARY))
    assert {r["language"]["lang_pred"] for r in language.scored(edges[0], unlabelled).collect()} == {"und"}


def events(spark, rows):
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, seq bigint, kind string, role string, text string")


def test_chat_folds_events(spark, tiny_batches):
    log = [
        (1, 0, 0, "message", "user", "Hi"),
        (1, 1, 1, "message", "assistant", ""), (1, 1, 2, "delta", None, "Hel"), (1, 1, 3, "delta", None, "lo"),
        (1, 1, 4, "regenerate", None, None), (1, 1, 5, "delta", None, "Good "), (1, 1, 6, "delta", None, "day"),
        (1, 2, 7, "message", "user", "typo"), (1, 2, 8, "edit", None, "fixed </turn> ### a: \\"),
        (1, 3, 9, "message", "user", "gone"), (1, 3, 10, "delete", None, None), (1, 3, 11, "delta", None, "nothing to add to"),
        (2, 0, 0, "delta", None, "before any message"), (2, 1, 0, "message", None, None),
        (None, 0, 0, "message", "ro:le\n#", "text"),
    ]
    random.Random(4).shuffle(log)
    turns = chat.rendered(events(spark, log).repartition(4))
    whole = {r["conv_id"]: (r["formatted"], [(s["start"], s["end"]) for s in r["loss_spans"]]) for r in chat.conversations_formatted(turns).collect()}
    read = {c: [(chat.unescaped(a), chat.unescaped(b)) for a, b in chat.TURN.findall(text)] for c, (text, _) in whole.items()}
    assert read == {1: [("user", "Hi"), ("assistant", "Good day"), ("user", "fixed </turn> ### a: \\")], 2: [("", "")], None: [("ro:le\n#", "text")]}
    text, spans = whole[1]
    assert [chat.unescaped(text[a:b]) for a, b in spans] == ["Good day"]
    digests = {r["conv_id"]: r for r in chat.read_back(turns).collect()}
    assert digests[1]["turns_sha256"] == brute.sha("".join(f"{a}\n{b}\n" for a, b in read[1]))
    assert digests[1]["loss_sha256"] == brute.sha("Good day") and digests[1]["formatted_chars"] == len(text)
    assert digests[None]["turns_sha256"] == brute.sha("ro:le\n#\ntext\n")
    assert chat.read_back(chat.rendered(events(spark, []))).count() == 0


def test_chat_keeps_repeated_rows(spark):
    rows = spark.createDataFrame([(1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, None, None)], "conv_id bigint, turn bigint, role string, text string")
    (got,) = chat.read_back(chat.rendered(chat.conversation_events(rows))).collect()
    assert got["n_turns"] == 3 and got["loss_chars"] == 0


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_neighbours_reach_their_recall(spark):
    for folder in (SMALL, CHECKED):
        vectors = {r[0]: r[1] for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()}
        want = brute.nearest(vectors, [i for i in vectors if i % 20 == 0])
        got = found(QUERIES["op10_nearest_neighbours"](spark, folder))
        assert set(got) == set(want)
        assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / len(want[q]) for q in want]) >= 0.9
        assert all(s == pytest.approx(dict(want[q]).get(i, s), abs=1e-12) for q in got for i, s in got[q])


def test_neighbours_with_ties_nulls_and_few_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 2.0, 2.0]) for i in range(60)] + [(100 + i, [float(i), 1.0, -1.0]) for i in range(12)]
    rows += [(200, None), (220, [0.0, 0.0, 0.0]), (240, [1.0, None, 2.0]), (260, [nan, 1.0, 1.0]), (280, [inf, 1.0, 1.0]), (None, [1.0, 1.0, 1.0]), (300, [5.0, 5.0]), (20, [1.0, 2.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").selectExpr("*", "1 AS entry", "2 AS rank", "3 AS cell").repartition(4)
    vectors = neighbours.clean_vectors(df)
    got = found(neighbours.nearest(vectors, vectors.where("vec_id % 20 = 0")))
    plain = {i: v for i, v in rows if i is not None and i < 200}
    want = brute.nearest(plain, [i for i in plain if i % 20 == 0])
    assert {q: [i for i, _ in r] for q, r in got.items()} == {q: [i for i, _ in r] for q, r in want.items()}
    empty = neighbours.clean_vectors(df.limit(0))
    assert neighbours.nearest(empty, empty).count() == 0


def recall_of(spark, vectors, step):
    plain = {i: v.tolist() for i, v in enumerate(vectors)}
    df = spark.createDataFrame(list(plain.items()), "vec_id bigint, embedding array<double>").repartition(8)
    clean = neighbours.clean_vectors(df)
    got = found(neighbours.nearest(clean, clean.where(f"vec_id % {step} = 0")))
    want = brute.nearest(plain, range(0, len(plain), step))
    assert {q: len(r) for q, r in got.items()} == {q: len(r) for q, r in want.items()}
    return np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / len(want[q]) for q in want])


@pytest.mark.parametrize("norms", ["one large", "spread"])
def test_neighbours_of_unequal_norms(spark, norms):
    rng = np.random.default_rng(11)
    vectors = rng.standard_normal((4_000, 64))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    if norms == "spread":
        vectors *= rng.lognormal(0, 0.5, (4_000, 1))
    else:
        vectors[77] *= 20
    assert recall_of(spark, vectors, 40) >= 0.9


@pytest.mark.parametrize("n, dim", [(2_000, 768), (20_000, 64)])
def test_neighbours_reach_their_recall_at_any_size_and_width(spark, n, dim):
    vectors = np.random.default_rng(11).standard_normal((n, dim))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    assert recall_of(spark, vectors, n // 100) >= 0.95


@pytest.mark.parametrize("folder", [SMALL, CHECKED, "/root/testdata/sf0.1"])
def test_tables_are_hashed_at_every_size(spark, folder):
    vectors = neighbours.clean_vectors(spark.read.parquet(f"{folder}/embeddings.parquet"))
    heads = neighbours.stored(neighbours.measured(vectors.withColumnRenamed("vec_id", "entry")), "test-heads")
    asked = heads.where("entry % 20 = 0")
    lengths = neighbours.fitted(heads, asked, neighbours.banded(heads), neighbours.K)
    assert lengths
    for dim, own in lengths.items():
        assert own.largest and not own.whole and own.tables in neighbours.TABLES
        assert own.tables * own.probes < 2 * neighbours.width(dim) and 0 < own.share(dim) < 1


def test_an_outlier_is_met_by_one_row_a_query(spark):
    rng = np.random.default_rng(5)
    vectors = rng.standard_normal((4_000, 16))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    vectors[77] *= 20
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "entry bigint, vector array<double>")
    heads = neighbours.stored(neighbours.measured(df), "test-heads")
    lengths = neighbours.banded(heads)
    asked = heads.where("entry % 20 = 0")
    assert neighbours.asking_of(asked, lengths).where(f"bin <= {neighbours.WHOLE}").count() == asked.count()


def test_blocks_of_vectors_are_not_sent_through_the_driver(spark):
    rng = np.random.default_rng(8)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((3_000, 16)))]
    heads = neighbours.stored(neighbours.measured(spark.createDataFrame(rows, "entry bigint, vector array<double>")), "test-heads")
    found = neighbours.met(heads, heads.where("entry % 20 = 0"), neighbours.banded(heads), 21)
    assert found.collect()
    lines = found._jdf.queryExecution().executedPlan().toString().partition("== Initial Plan")[0].splitlines()
    depth = [len(re.match(r"[\s:+-]*", line)[0]) for line in lines]
    blocks = [i for i, line in enumerate(lines) if "collect_list" in line]
    assert len(blocks) >= 2
    # Nothing that stands above the lists, between them and the join of blocks, is a broadcast.
    for i in blocks:
        above, at = [], depth[i]
        for j in range(i - 1, -1, -1):
            if depth[j] < at:
                above, at = [*above, lines[j]], depth[j]
        assert not any("BroadcastExchange" in line for line in above)


def test_near_ties_at_the_edge_go_by_the_exact_score(spark):
    rng = np.random.default_rng(6)
    base = rng.standard_normal(48)
    rows = [(i, (base + (i % 7) * 1e-16 * rng.standard_normal(48)).tolist()) for i in range(400)]
    vectors = neighbours.clean_vectors(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"))
    got = found(neighbours.nearest(vectors, vectors.where("vec_id % 100 = 0")))
    plain = dict(rows)
    for q, own in got.items():
        exact = sorted(((-float((np.array(v) * np.array(plain[q])).sum()), i) for i, v in rows if i != q))[:20]
        assert [i for i, _ in own] == [i for _, i in exact]


def test_probes_are_the_fewest_that_reach_the_recall():
    assert neighbours.fewest_probes([[1] * 20, [3] * 20]) == 3
    assert neighbours.fewest_probes([[1] * 39 + [9], [1] * 39 + [9]]) == 1
    assert neighbours.fewest_probes([]) == 1


def test_pipeline_against_brute_force(spark):
    got = corpus_pipeline.run(spark, SMALL).collect()
    _, docs = small_docs(spark)
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    docs = [d for d in docs if any(c.isalpha() for c in d[1] or "")]
    docs = [(r[0], r[3]) for r in brute.repeated_lines(docs)]
    kept = {d for d, _, c in brute.linked_components(docs, corpus_pipeline.NEAR_PERCENT) if d == c}
    docs = [d for d in docs if d[0] in kept]
    clean = {r[0] for r in brute.contaminated(docs, items) if not r[5]}
    plain = Tokenizer.from_file(vocabulary(WORD_VOCABULARY))
    want = {d: len(plain.encode(t, add_special_tokens=False).ids) + 1 for d, t in docs if d in clean}
    lengths = {}
    for r in got:
        lengths[r["doc_id"]] = lengths.get(r["doc_id"], 0) + r["length"]
    assert lengths == want
    sequences = sorted((r["sequence_id"], r["offset"], r["length"]) for r in got)
    for _, own in itertools.groupby(sequences, key=lambda r: r[0]):
        at = 0
        for _, offset, length in own:
            assert offset == at
            at += length
        assert at <= 4096


def test_pipeline_stages_take_awkward_and_empty_tables(spark, awkward, nothing):
    for docs, rows in (awkward, (nothing, [])):
        docs = docs.selectExpr("*", "'en' AS lang", "'s' AS source", "CAST(length(text) AS bigint) AS n_chars")
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SMALL)
            if name != "packing":
                assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes)
            assert out.count() <= len(rows)
