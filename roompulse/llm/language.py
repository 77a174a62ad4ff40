"""Language identification by unigram models summed over all segmentations.

Words are runs of letters (numerals such as ½ or Ⅷ are none), lower-cased, behind a word mark.  For every language each
piece of a fixed public vocabulary has a probability; a word's likelihood is the sum, over all ways to cut it into
pieces, of the products of their probabilities: a forward algorithm over whole words of any length, with all of the
vocabulary's pieces that are letters.  Piece probabilities are fitted by expectation-maximisation on the distinct words of
labelled documents.  A text's score for a language is the sum of its words' log-likelihoods and the language's prior;
the answer is the best language, with its posterior.

Fitting takes about ``TRAIN_DOCS`` whole documents of each language, chosen by a hash of doc_id; what the driver holds
is bounded by the vocabulary and the number of languages.  Every text is scored whole.

Defined results: a null text, or one without letters, is ``und`` with score 0; without any labelled document every
text is ``und``; labels are the non-null values of lang; repeated rows are scored one by one; a null doc_id counts as
held out; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roompulse.llm.tables import batches, remembered, stored, table, text_bytes
from roompulse.llm.tokens import vocabulary

VOCABULARY = "piece_bpe_32k.model"
UNDETERMINED = "und"
#: Bound on the labelled documents fitted, for each language (on average over the hash).
TRAIN_DOCS = 1_500
ROUNDS = 2
#: Expected count added to each piece.
SMOOTHING = 0.05
#: Letters after which sums are scaled anew, so that no word is too long for a floating-point number.
SCALED_EVERY = 16
#: Words whose scores a worker remembers.
WORDS_KEPT = 800_000
#: Words scored at once.
WORDS_AT_ONCE = 100_000
#: Letters of words cut into pieces at once, and letters of the words a worker remembers.
CHUNK = 40_000
LETTERS_KEPT = 10_000_000

MARK = "▁"
#: Runs that may hold letters; numerals among them are taken out where a run is not all letters.
RUN = re.compile(r"[^\W\d_]+")
_WORD_ARROW = pa.schema([("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())])
_COUNT_ARROW = pa.schema([("lang", pa.int32()), ("piece", pa.int32()), ("n", pa.float64())])


def words_of(text: str) -> list[str]:
    """The runs of letters of a text, in lower case."""
    runs = RUN.findall(text.lower())
    if text.isascii() or all(map(str.isalpha, runs)):
        return runs
    return [word for run in runs for word in "".join(c if c.isalpha() else " " for c in run).split()]


class Pieces:
    """The vocabulary's pieces by number; 0 is any one letter that the vocabulary lacks."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        own = sorted({p.lower() for p in map(model.id_to_piece, range(model.get_piece_size())) if p.replace(MARK, "a").isalpha() and MARK not in p[1:]})
        self.numbers = {p: i + 1 for i, p in enumerate(own)}
        self.size = len(own) + 1
        #: Length of the longest piece, and of the longest one with each two-letter beginning.
        self.longest = max(map(len, own))
        self.reach: dict[str, int] = {}
        for p in own:
            self.reach[p[:2]] = max(self.reach.get(p[:2], 1), len(p))
        self.gaps = [[-1] * k for k in range(self.longest + 1)]

    def cuts(self, words: list[str], first: int, stop: int) -> np.ndarray:
        """For words of one length: the piece at each start from ``first`` and of each length (words, starts, longest), -1 for none."""
        n, number, reach, gaps, width = len(words[0]), self.numbers.get, self.reach.get, self.gaps, self.longest
        flat: list[int] = []
        for w in words:
            for s in range(first, stop):
                m = min(reach(w[s : s + 2], 1), n - s)
                flat.append(number(w[s], 0))
                flat += [number(w[s:e], -1) for e in range(s + 2, s + m + 1)]
                flat += gaps[width - m]
        return np.array(flat, np.int32).reshape(len(words), stop - first, width)


def pieces(path: str) -> Pieces:
    own = remembered("language pieces")
    if path not in own:
        own[path] = Pieces(path)
    return own[path]


def by_length(words: list[str]) -> Iterator[tuple[np.ndarray, list[str]]]:
    """Words with the mark, in groups of one length and bounded size, and their places."""
    groups: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        groups.setdefault(len(w), []).append(i)
    for length, places in groups.items():
        chunk = max(1, CHUNK // (length + 1))
        for at in range(0, len(places), chunk):
            part = places[at : at + chunk]
            yield np.array(part), [MARK + words[i] for i in part]


def stretches(words: list[str], own: Pieces) -> Iterator[tuple[int, np.ndarray]]:
    """The cuts of words of one length, in stretches of starts that bound what is held, each with its first start."""
    n, step = len(words[0]), max(1, CHUNK // len(words))
    for first in range(0, n, step):
        yield first, own.cuts(words, first, min(n, first + step))


def likelihoods(words: list[str], own: Pieces, probabilities: np.ndarray) -> np.ndarray:
    """Log-likelihood of each word in each language, over all its segmentations; probabilities: (pieces, languages).

    The forward sums run over whole words; only the last ones, as many as the longest piece has letters, are held, and
    they are scaled from time to time with the logarithm of the scale kept aside.
    """
    out = np.zeros((len(words), probabilities.shape[1]))
    for places, marked in by_length(words):
        shape = (len(marked), probabilities.shape[1])
        # ring[k]: the sum of all segmentations that end k letters behind the current start.
        ring, logs = [np.ones(shape), *(np.zeros(shape) for _ in range(own.longest))], np.zeros(shape)
        for first, ids in stretches(marked, own):
            for at in range(ids.shape[1]):
                here = ring.pop(0)
                ring.append(np.zeros(shape))
                if (first + at) % SCALED_EVERY == SCALED_EVERY - 1:
                    scale = np.maximum(here, np.maximum.reduce(ring))
                    here, ring, logs = here / scale, [x / scale for x in ring], logs + np.log(scale)
                for k in range(own.longest):
                    column = ids[:, at, k]
                    some = np.flatnonzero(column >= 0)
                    if len(some):
                        ring[k][some] += here[some] * probabilities[column[some]]
        out[places] = np.log(ring[0]) + logs
    return out


def expected_counts(words: list[str], langs: np.ndarray, weights: np.ndarray, own: Pieces, probabilities: np.ndarray) -> np.ndarray:
    """Expected piece counts over all segmentations, each word under its own language's model."""
    n_langs = probabilities.shape[1]
    totals = np.zeros(own.size * n_langs)
    for places, marked in by_length(words):
        lang, n, rows = langs[places], len(marked[0]), len(marked)
        cut = list(stretches(marked, own))
        # forward[s] and its log scale; both sums are over the segmentations of what lies before and behind s.
        forward, logs, offset = np.zeros((n + 1, rows)), np.zeros((n + 1, rows)), np.zeros(rows)
        forward[0] = 1
        for first, ids in cut:
            for s in range(first, first + ids.shape[1]):
                if s % SCALED_EVERY == SCALED_EVERY - 1:
                    ahead = slice(s, min(n, s + own.longest) + 1)
                    scale = forward[ahead].max(axis=0)
                    forward[ahead] /= scale
                    offset = offset + np.log(scale)
                logs[s] = offset
                for k in range(min(own.longest, n - s)):
                    column = ids[:, s - first, k]
                    some = np.flatnonzero(column >= 0)
                    if len(some):
                        forward[s + k + 1][some] += forward[s][some] * probabilities[column[some], lang[some]]
        whole = np.log(forward[n]) + offset
        ring, behind = [np.ones(rows), *(np.zeros(rows) for _ in range(own.longest - 1))], np.zeros(rows)
        for first, ids in reversed(cut):
            for s in range(first + ids.shape[1] - 1, first - 1, -1):
                here, share = np.zeros(rows), weights[places] * forward[s] * np.exp(logs[s] + behind - whole)
                for k in range(min(own.longest, n - s)):
                    column = ids[:, s - first, k]
                    some = np.flatnonzero(column >= 0)
                    if len(some):
                        part = probabilities[column[some], lang[some]] * ring[k][some]
                        here[some] += part
                        totals += np.bincount(column[some].astype(np.int64) * n_langs + lang[some], share[some] * part, len(totals))
                ring = [here, *ring[:-1]]
                if s % SCALED_EVERY == 0:
                    scale = np.maximum.reduce(ring)
                    ring, behind = [x / scale for x in ring], behind + np.log(scale)
    return totals.reshape(own.size, n_langs)


def held_out() -> Column:
    """Rows whose crc32 of the id as text has remainder 2 by 4, and rows without id, are never learnt from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(True))


def labelled_words(docs: DataFrame, sizes: dict[str, int], train_docs: int = TRAIN_DOCS) -> DataFrame:
    """(lang, word, n) over the documents fitted on; sizes: the labelled documents of each language."""

    def rows(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        counts: Counter = Counter()
        for part in parts:
            for lang, text in zip(part.column("lang").to_pylist(), part.column("text")):
                counts.update((lang, w) for w in words_of(text.as_py().decode("utf-8", "replace")))
            if len(counts) > 400_000:
                yield from ((*key, n) for key, n in counts.items())
                counts.clear()
        yield from ((*key, n) for key, n in counts.items())

    labelled = docs.where(F.col("lang").isNotNull() & ~held_out()).select("doc_id", "lang", "text")
    millionths = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, train_docs * 1_000_000 // n)])
    chosen = labelled.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < millionths[F.col("lang")])
    counted = chosen.select("lang", text_bytes().alias("text")).mapInArrow(lambda parts: batches(_WORD_ARROW, rows(parts)), "lang string, word string, n bigint")
    return counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))


class LanguageModel:
    def __init__(self, path: str, langs: list[str], priors: np.ndarray, probabilities: np.ndarray):
        self.path, self.langs, self.priors, self.probabilities = path, langs, priors, probabilities


def fitted(docs: DataFrame, path: str, train_docs: int = TRAIN_DOCS, rounds: int = ROUNDS) -> LanguageModel:
    """Expectation-maximisation over the words of labelled documents (doc_id, text, lang)."""
    spark = docs.sparkSession
    shares = docs.where(F.col("lang").isNotNull() & ~held_out()).groupBy("lang").agg(F.count("*").alias("n")).orderBy("lang").collect()
    langs = [r["lang"] for r in shares]
    priors = np.log(np.array([r["n"] for r in shares], float) / max(1, sum(r["n"] for r in shares)))
    own = pieces(path)
    probabilities = np.full((own.size, len(langs)), 1 / own.size)
    if not langs:
        return LanguageModel(path, langs, priors, probabilities)
    words = stored(labelled_words(docs, {r["lang"]: r["n"] for r in shares}, train_docs), "language-words")
    numbers = {lang: i for i, lang in enumerate(langs)}
    for _ in range(rounds):
        model = spark.sparkContext.broadcast(probabilities)

        def counted(parts: Iterator[pa.RecordBatch], model=model) -> Iterator[tuple]:
            total = np.zeros_like(model.value)
            for part in parts:
                lang = np.array([numbers[x] for x in part.column("lang").to_pylist()], np.int64)
                total += expected_counts(part.column("word").to_pylist(), lang, part.column("n").to_numpy().astype(float), pieces(path), model.value)
            for piece, lang in zip(*np.nonzero(total)):
                yield int(lang), int(piece), float(total[piece, lang])

        spread = words.repartition("word").mapInArrow(lambda parts, f=counted: batches(_COUNT_ARROW, f(parts)), "lang int, piece int, n double")
        expected = np.full_like(probabilities, SMOOTHING)
        for row in spread.groupBy("lang", "piece").agg(F.sum("n").alias("n")).collect():  # vocabulary times languages
            expected[row["piece"], row["lang"]] += row["n"]
        probabilities = expected / expected.sum(axis=0)
    return LanguageModel(path, langs, priors, probabilities)


def scored(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """Every row's columns, with held_out, lang_pred and score as a struct ``language``; only the text decides."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    answer = pa.struct([("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())])

    def answers(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        own, known, letters, logs = pieces(m.path), {}, 0, np.zeros((1 << 16, len(m.langs)))

        def numbered(words: list[str]) -> np.ndarray:
            nonlocal logs, letters
            numbers = np.array([known.get(w, -1) for w in words], np.int64)
            fresh = list({words[i] for i in np.flatnonzero(numbers < 0)})
            if len(known) + len(fresh) > WORDS_KEPT or letters > LETTERS_KEPT:
                known.clear()
                letters, numbers[:] = 0, -1
                fresh = list(set(words))
            if fresh:
                at = len(known)
                while at + len(fresh) > len(logs):
                    logs = np.vstack([logs, np.zeros_like(logs)])
                logs[at : at + len(fresh)] = likelihoods(fresh, own, m.probabilities)
                letters += sum(map(len, fresh))
                places = dict(zip(fresh, range(at, at + len(fresh))))
                known.update(places)
                for i in np.flatnonzero(numbers < 0):
                    numbers[i] = places[words[i]]
            return numbers

        def best(total: np.ndarray) -> tuple[str, float]:
            top = int(total.argmax())
            return m.langs[top], float(1 / np.exp(total - total[top]).sum())

        def judged(cut: list[list[str]]) -> Iterator[tuple[str, float]]:
            """Many short texts at once, so that their fresh words are scored together; a long one part by part."""
            if len(cut) > 1 and sum(map(len, cut)) > WORDS_AT_ONCE:
                for half in (cut[: len(cut) // 2], cut[len(cut) // 2 :]):
                    yield from judged(half)
                return
            flat, totals = [w for words in cut for w in words], np.zeros((len(cut), len(m.langs))) + m.priors
            of_text = np.repeat(np.arange(len(cut)), [len(words) for words in cut])
            for at in range(0, len(flat), WORDS_AT_ONCE):
                numbers, texts = numbered(flat[at : at + WORDS_AT_ONCE]), of_text[at : at + WORDS_AT_ONCE]
                scores = logs[numbers]
                for k in range(len(m.langs)):
                    totals[:, k] += np.bincount(texts, scores[:, k], len(cut))
            for words, total in zip(cut, totals):
                yield best(total) if words else (UNDETERMINED, 0.0)

        for part in parts:
            found = []
            for lo in range(0, part.num_rows, 64):
                cut = [words_of(t.as_py().decode("utf-8", "replace")) if m.langs else [] for t in part.column("text")[lo : lo + 64]]
                found += judged(cut)
            columns = [part.column("held_out"), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
            language = pa.StructArray.from_arrays(columns, fields=list(answer))
            yield pa.RecordBatch.from_arrays([part.column("row"), language], names=["row", "language"])

    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), held_out().alias("held_out"), text_bytes().alias("text"))
    row_type = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(answers, f"row {row_type}, language struct<held_out: boolean, lang_pred: string, score: double>")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = scored(docs.select("doc_id", "text"), fitted(docs, vocabulary(VOCABULARY)))
    return found.select("row.doc_id", "language.*")
