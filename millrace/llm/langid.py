"""Language of a text by unigram pieces, summed over all ways to cut its words.

Each language has a probability for every piece of a fixed public vocabulary. The likelihood of
a word is the sum over all its segmentations into pieces of the product of their
probabilities, by the forward algorithm; words are independent. The probabilities come from
expectation maximization over the same lattices, which counts a piece by how likely the
segmentations are that use it.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import file_bytes, prepare, staged

MODEL = public_tokenizers.path("piece_bpe_32k.model")
#: Documents of each language that training takes, about.
DOCUMENTS = 1500
#: Rounds of expectation maximization, share of the languages' common distribution in each one,
#: probability of a letter that no piece has, and letters at which longer words are cut.
ROUNDS, SHARED, UNKNOWN, LONGEST = 4, 0.02, 1e-6, 40
#: Words of one language that are laid out at once, and words that a task of training takes, about.
AT_ONCE, PER_TASK = 10_000, 20_000
#: Words that a worker keeps.
CACHE = 400_000

UNDETERMINED = "und"
_LETTERS = re.compile(rf"[^\W\d_]{{1,{LONGEST}}}").findall


def words_of(text: str | None) -> list[str]:
    """Lower-case runs of letters; none if nothing of it is a letter."""
    found = _LETTERS(text.lower()) if text else []
    return found if any(map(str.isalpha, "".join(found))) else []


class Vocabulary:
    """Pieces of a model, the automaton that finds them, a table for those of one letter; piece 0 is any letter."""

    def __init__(self, data: bytes):
        library = sentencepiece.SentencePieceProcessor(model_proto=data)
        self.matches = ahocorasick.Automaton()
        self.letters = np.zeros(0x110000, np.int32)
        self.size = 1
        for i in range(library.get_piece_size()):
            if not (library.is_control(i) or library.is_unknown(i) or library.is_byte(i)):
                piece = library.id_to_piece(i)
                if piece == piece.lower() and "\n" not in piece:
                    if len(piece) == 1:
                        self.letters[ord(piece)] = self.size
                    else:
                        self.matches.add_word(piece, self.size << 8 | len(piece))
                    self.size += 1
        self.matches.make_automaton()

    def lattice(self, words: list[str]) -> Lattice:
        return Lattice(self, words)


class Lattice:
    """Pieces in all words: nodes between letters, an arc for each place of a piece, in order of their depth.

    Besides those, an arc goes over each single letter, for its own piece and for piece 0.
    """

    def __init__(self, vocabulary: Vocabulary, words: list[str]):
        text = "".join([f"▁{w}\n" for w in words])
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
        self.first = np.cumsum(sizes) - sizes
        self.last = self.first + sizes - 1
        self.nodes = len(text) + 1
        ends, values = np.fromiter(chain.from_iterable(vocabulary.matches.iter(text)), np.int64).reshape(-1, 2).T
        word_of = np.repeat(np.arange(len(words)), sizes)
        depth_of = (np.arange(len(text)) - self.first[word_of] + 1).astype(np.int16)
        order = np.argsort(depth_of[ends], kind="stable")  # within a depth, arcs of one end stay together
        ends, values = ends[order], values[order]
        self.end, self.piece, self.word = ends + 1, values >> 8, word_of[ends]
        self.start = self.end - (values & 255)
        letters = np.delete(np.arange(len(text)), self.last)
        letters = letters[np.argsort(depth_of[letters], kind="stable")]
        self.letter, self.letter_word = letters + 1, word_of[letters]
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        self.letter_piece = vocabulary.letters[points[letters]]
        levels = np.arange(1, int(sizes.max(initial=1)) + 1)
        arcs, singles = depth_of[ends], depth_of[self.letter - 1]
        cuts = zip(*(np.searchsorted(d, levels).tolist() for d in (arcs, singles)), strict=True)
        self.levels = list(zip(cuts, [*zip(*(np.searchsorted(d, levels, "right").tolist() for d in (arcs, singles)), strict=True)], strict=True))

    def forward(self, probability: np.ndarray) -> np.ndarray:
        """For each node and language, the sum over all ways from its word's beginning."""
        alpha = np.zeros((self.nodes, probability.shape[1]))
        alpha[self.first] = 1
        single = self._single(probability)
        for (low, one), (high, two) in self.levels:
            letter = self.letter[one:two]
            alpha[letter] = alpha[letter - 1] * single[one:two]
            if high > low:
                ends = self.end[low:high]
                heads = np.nonzero(np.concatenate([[True], ends[1:] != ends[:-1]]))[0]
                alpha[ends[heads]] += np.add.reduceat(alpha[self.start[low:high]] * probability[self.piece[low:high]], heads, axis=0)
        return alpha

    def expected(self, probability: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """For each piece but piece 0, and each language, how often words of these weights use it."""
        alpha = self.forward(probability)
        beta = np.zeros_like(alpha)
        beta[self.last] = 1
        single = self._single(probability)
        for (low, one), (high, two) in reversed(self.levels):
            letter = self.letter[one:two]
            np.add.at(beta, letter - 1, beta[letter] * single[one:two])
            np.add.at(beta, self.start[low:high], beta[self.end[low:high]] * probability[self.piece[low:high]])
        share = weight / np.maximum(alpha[self.last], 1e-300)
        long = alpha[self.start] * probability[self.piece] * beta[self.end] * share[self.word]
        short = alpha[self.letter - 1] * probability[self.letter_piece] * beta[self.letter] * share[self.letter_word]
        piece, each = np.concatenate([self.piece, self.letter_piece]), np.concatenate([long, short])
        return np.stack([np.bincount(piece, weights=each[:, k], minlength=len(probability)) for k in range(each.shape[1])], axis=1)

    def _single(self, probability: np.ndarray) -> np.ndarray:
        """Of each letter, its own piece's and piece 0's."""
        return probability[0] + np.where(self.letter_piece[:, None] > 0, probability[self.letter_piece], 0)


@dataclass(frozen=True)
class Model:
    """Probabilities of pieces (rows) in each language (columns)."""

    languages: list[str]
    probability: np.ndarray

    def loglikelihood(self, vocabulary: Vocabulary, words: list[str]) -> np.ndarray:
        if not words:
            return np.zeros((0, len(self.languages)))
        lattice = vocabulary.lattice(words)
        return np.log(np.maximum(lattice.forward(self.probability)[lattice.last], 1e-300))


def fit(vocabulary: Vocabulary, counts: list[tuple[str, str, int]], rounds: int = ROUNDS) -> Model:
    """A model from ``(language, word, count)``."""
    languages = sorted({c[0] for c in counts})
    words = sorted({c[1] for c in counts})
    at, column = {w: i for i, w in enumerate(words)}, {k: i for i, k in enumerate(languages)}
    weight = np.zeros((len(words), len(languages)))
    for language, word, count in counts:
        weight[at[word], column[language]] += count
    probability = _even(vocabulary.size, len(languages))
    for _ in range(rounds):
        seen = np.zeros_like(probability)
        for low in range(0, len(words), AT_ONCE):
            seen += vocabulary.lattice(words[low : low + AT_ONCE]).expected(probability, weight[low : low + AT_ONCE])
        probability = _maximized(seen)
    return Model(languages, probability)


def _even(pieces: int, languages: int) -> np.ndarray:
    """Where expectation maximization begins."""
    probability = np.full((pieces, languages), 1 / pieces)
    probability[0] = UNKNOWN
    return probability


def _maximized(seen: np.ndarray) -> np.ndarray:
    """Probabilities from how often each piece (row) was used in each language (column)."""
    seen[0] = 0
    common = seen.sum(axis=1, keepdims=True) + 0.1
    common[0] = 0
    own = seen / np.maximum(seen.sum(axis=0), 1e-9)
    probability = (1 - SHARED) * own + SHARED * common / common.sum()
    probability[0] = UNKNOWN
    return probability


def train(df: DataFrame, model_path: str = MODEL, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", documents: int = DOCUMENTS) -> Model:
    """A model of all languages in ``df``. Rows without text or language are not used.

    Of each language about ``documents`` rows are taken, by a hash of their ids, and of these every
    word. Words stay on the workers: only sums for each piece and language reach the driver.
    """
    spark = df.sparkSession
    prepare(spark)
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where("text is not null and lang is not null")
    share = rows.groupBy("lang").agg((F.lit(documents * 1e6) / F.count("*")).alias("share"))
    # one row for each language
    rows = rows.join(F.broadcast(share), "lang").where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < F.col("share")).select("lang", "text")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = Counter()
            for lang, text in zip(*batch.columns, strict=True):
                name = lang.as_py()
                counts.update((name, w) for w in words_of(text.as_py()))
            columns = [pa.array([k[i] for k in counts], pa.string()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(list(counts.values()), pa.int64())], ["lang", "word", "n"])

    counts = rows.mapInArrow(counted, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    counts = staged(counts, "words")
    sizes = {r["lang"]: r["count"] for r in counts.groupBy("lang").count().collect()}
    languages = sorted(sizes)
    data = file_bytes(spark, model_path)
    pieces = Vocabulary(data.value).size
    dealt = counts.repartition(max(1, -(-sum(sizes.values()) // PER_TASK)), "lang", "word")
    probability = _even(pieces, len(languages))
    for _ in range(ROUNDS if languages else 0):
        shared = spark.sparkContext.broadcast(probability)

        def expected(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            vocabulary, probability = _vocabulary(data.value), shared.value
            column, seen = {k: i for i, k in enumerate(languages)}, {}
            waiting: dict[str, dict[str, int]] = {}

            def add(lang: str) -> None:
                words, at = waiting.pop(lang), column[lang]
                weight = np.array(list(words.values()), float)[:, None]
                found = vocabulary.lattice(list(words)).expected(probability[:, at : at + 1], weight)[:, 0]
                seen[at] = seen[at] + found if at in seen else found

            for batch in batches:
                for lang, word, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    words = waiting.setdefault(lang, {})
                    words[word] = n
                    if len(words) >= AT_ONCE:
                        add(lang)
            for lang in list(waiting):
                add(lang)
            for at, found in seen.items():
                used = np.nonzero(found)[0]
                columns = [pa.array(used, pa.int32()), pa.array(np.full(len(used), at), pa.int32()), pa.array(found[used])]
                yield pa.RecordBatch.from_arrays(columns, ["piece", "language", "n"])

        sums = dealt.mapInArrow(expected, "piece int, language int, n double").groupBy("piece", "language").agg(F.sum("n").alias("n")).toPandas()
        seen = np.zeros_like(probability)
        seen[sums["piece"].to_numpy(int), sums["language"].to_numpy(int)] = sums["n"].to_numpy(float)
        probability = _maximized(seen)
    return Model(languages, probability)


_VOCABULARIES: dict[int, Vocabulary] = {}


def _vocabulary(data: bytes) -> Vocabulary:
    key = hash(data)
    if key not in _VOCABULARIES:
        _VOCABULARIES[key] = Vocabulary(data)
    return _VOCABULARIES[key]


def language_column(df: DataFrame, model: Model, text: str | Column, model_path: str = MODEL) -> Column:
    """``lang`` and ``score`` of a text: the likeliest language, and its probability among all."""
    prepare(df.sparkSession)
    data = file_bytes(df.sparkSession, model_path)
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang: string, score: double>")
    def identify(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model, vocabulary = shared.value, _vocabulary(data.value)
        rows: dict[str, int] = {}
        table = np.zeros((0, len(model.languages)))
        for texts in batches:
            langs, scores = [], []
            for at in range(0, len(texts), 64):
                each = [words_of(t.as_py()) for t in texts.slice(at, 64)] if model.languages else [[] for _ in texts.slice(at, 64)]
                if len(rows) > CACHE:
                    rows, table = {}, table[:0]
                new = list(set().union(*each).difference(rows))
                parts = [model.loglikelihood(vocabulary, new[i : i + 5000]) for i in range(0, len(new), 5000)]
                rows.update(zip(new, range(len(rows), len(rows) + len(new)), strict=True))
                used = len(rows) - len(new)
                if len(rows) > len(table):
                    table = np.concatenate([table[:used], np.zeros((max(len(rows), 1 << 14), table.shape[1]))])
                if new:
                    table[used : len(rows)] = np.concatenate(parts)
                for words in each:
                    if not words:
                        langs.append(UNDETERMINED)
                        scores.append(0.0)
                        continue
                    total = table[np.fromiter(map(rows.__getitem__, words), np.int64, len(words))].sum(axis=0)
                    best = int(np.argmax(total))
                    langs.append(model.languages[best])
                    scores.append(float(1 / np.exp(total - total[best]).sum()))
            yield pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["lang", "score"])

    return identify(text)


def identify(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", model_path: str = MODEL) -> DataFrame:
    """``doc_id, lang_pred, score`` of each row.

    Null texts and texts without a letter are ``und`` with score 0, as is every text if the model
    has no language. Of equally likely languages the first by name is taken. Equal ids and
    equal rows each keep their row, an empty table gives an empty result, and other columns,
    whatever their names, are left out.
    """
    found = df.select(F.col(id_col).alias("doc_id"), language_column(df, model, F.col(text_col), model_path).alias("found"))
    return found.select("doc_id", F.col("found.lang").alias("lang_pred"), "found.score")
