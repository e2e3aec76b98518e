"""Toxicity by a subsequence string kernel, with Nyström landmarks and a support vector machine.

Words are compared by the four-character subsequences that they share, each with a weight that
decays with every character it skips: ``idxiot`` still holds most of ``idiot``. Their begin and
end are characters too, so a word is told from one that goes on. Landmarks are a bounded number
of words; a word's kernel values at them, whitened by the landmarks' own kernel matrix, are the
features of a linear machine (squared hinge).

Labels belong to documents, and a sentence is as bad as its worst word: training looks for the
words that bear the label of the toxic documents, starting from words that many of them have and
no clean document, or far fewer: clean ones may quote a word, or be labelled wrong. It fits, with
clean words weighted by the documents that hold them, looks on the workers for clean words
that score too high, and for words of toxic documents that are not explained yet, and fits again.
A toxic document in which nothing resembles such a word teaches nothing: labels may be wrong. A
document's score is that of its worst sentence, made a probability on labelled documents that
were held back from all this.

As the kernel is a sum over subsequences, machine and landmarks fold into one table of
subsequence weights, so that scoring a word takes a few array look-ups. Subsequences of a to z
have a place each in it, those with other letters share places by a hash of their code points.
"""

from __future__ import annotations

import re
import string
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import prepare, released, staged

#: Labelled documents that training takes at most, clean and toxic ones; one in so many is held back for the cut.
DOCUMENTS, BACK = (6000, 1500), 5
SAMPLE_PARTS = 8
#: Clean words to begin with, clean words that score highest in a round, and of those that are kept over the rounds.
SAMPLE, HARD, KEPT = 8000, 1500, 5000
#: Landmarks of each kind, rounds of training, weight of a skipped character, characters skipped at most.
LANDMARKS, ROUNDS, DECAY, SKIPS = 160, 5, 0.6, 3
#: Copies of a word with an inserted letter that it is trained with, and how much more a hard clean word counts.
VARIANTS, HARDER = 4, 5.0
#: How many times the share of clean documents with a word is its share of toxic ones, if it may bear their label.
OFTEN = 16
#: Words that explain the label of one toxic document, at most.
COVER = 8
#: Strength of the machine's regularization.
RIDGE = 1e-4
#: Steepness of the step from a document's value to its probability: the machine's margin is 1.
SLOPE = 4.0
#: Words that are laid out side by side, and words whose scores a worker keeps.
AT_ONCE = 8192
CACHE = 150_000

_LENGTH = 4
_OFFSETS = [(*o, DECAY ** (o[-1] - _LENGTH + 1)) for o in combinations(range(1, _LENGTH + SKIPS), _LENGTH - 1)]
_REACH = _LENGTH + SKIPS - 1
_CODES = 1 << (5 * _LENGTH)

#: Digits and signs by the letter that they stand in for, and factors that hash a letter by its place.
_STAND_IN = {"4": "a", "3": "e", "1!": "i", "0": "o", "$5": "s", "7": "t"}
_PLACES = (0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F)
#: Letters besides a to z have their code points, which are larger than these.
_SKIP, _BEGIN, _END, _PACKED = 0x110000, 27, 28, 32


def _alphabet() -> np.ndarray:
    codes = np.full(0x250, _SKIP, np.int32)
    for i in range(0x250):
        if chr(i).isalnum():
            codes[i] = i
    for i, letter in enumerate(string.ascii_lowercase):
        codes[ord(letter)] = i + 1
    for signs, letter in _STAND_IN.items():
        for sign in signs:
            codes[ord(sign)] = codes[ord(letter)]
    for digit in "2689":
        codes[ord(digit)] = 31
    codes[ord("\n")], codes[ord("\t")], codes[ord("\v")] = 0, _BEGIN, _END
    return codes


_ALPHABET = _alphabet()
#: Letters that stand alone, four or more in a row, make one word.
_SPELLED = re.compile(r"(?<!\S)\S(?:[ \t]\S){3,}(?!\S)")


def words_of(text: str | None) -> list[str]:
    """Lower-case words between white space; spelled-out ones together, and as letters too."""
    if not text:
        return []
    text = text.lower()
    found = text.split()
    found += ["".join(run.split()) for run in _SPELLED.findall(text)]
    return found


def _coded(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all characters, and where each word starts: marks around it, zeros between words, no signs."""
    gap = "\v" + "\n" * _REACH + "\t"
    points = np.frombuffer(("\t" + gap.join(words) + gap[:-1]).encode("utf-32-le", "replace"), np.uint32)
    codes = np.where(points < len(_ALPHABET), _ALPHABET[np.minimum(points, len(_ALPHABET) - 1)], points)
    starts = np.zeros(len(words), np.int64)
    starts[1:] = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + len(gap))[:-1]
    stays = codes != _SKIP
    before = np.concatenate([[0], np.cumsum(stays)])
    return codes[stays].astype(np.int32), before[starts]


def _subsequences(codes: np.ndarray) -> Iterator[tuple[np.ndarray, float]]:
    """For each pattern of skips, the code of the subsequence that begins at each character, 0 for none."""
    padded = np.concatenate([codes, np.zeros(_REACH, np.int32)])
    other = padded >= _PACKED
    # where a letter is in the subsequence: five bits each, or a hash over all of them
    places = [padded << 5 * (_LENGTH - 1 - i) for i in range(_LENGTH)]
    if other.any():
        points = padded[other].astype(np.uint32)
        for place, factor in zip(places, _PLACES, strict=True):
            place[other] = ((points ^ points >> 7) * np.uint32(factor)) >> np.uint32(32 - 5 * _LENGTH)
    for a, b, c, weight in _OFFSETS:
        n = len(codes)
        found = places[0][:n] ^ places[1][a : a + n] ^ places[2][b : b + n] ^ places[3][c : c + n]
        yield np.where((codes > 0) & (padded[c : c + n] > 0), found, 0), weight


def _norms(codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """One over the root of a word's summed squared weights: a factor of its length alone, so still a kernel."""
    total = np.zeros(len(codes))
    for found, weight in _subsequences(codes):
        total += (found > 0) * weight**2
    return 1 / np.sqrt(np.maximum(np.add.reduceat(total, starts), 1.0))


@dataclass(frozen=True)
class Scorer:
    """Weights of subsequences, the machine's bias, and what makes a score a probability."""

    table: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def words(self, words: list[str]) -> np.ndarray:
        """The machine's output for each word."""
        out = np.zeros(len(words))
        for at in range(0, len(words), AT_ONCE):
            codes, starts = _coded(words[at : at + AT_ONCE])
            total = np.zeros(len(codes), np.float32)
            for found, weight in _subsequences(codes):
                total += np.float32(weight) * self.table[found]
            out[at : at + AT_ONCE] = np.add.reduceat(total, starts) * _norms(codes, starts) + self.bias
        return out

    def probability(self, value: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * value + self.shift, -500, 500)))


def _kernel(words: list[str], index: np.ndarray, features: np.ndarray) -> np.ndarray:
    """Kernel values of words and landmarks; ``features``: landmarks by the subsequences of ``index``."""
    out = np.zeros((len(words), features.shape[1]), np.float32)
    for at in range(0, len(words), AT_ONCE // 32):
        part = words[at : at + AT_ONCE // 32]
        codes, starts = _coded(part)
        total = np.zeros((len(codes), features.shape[1]), np.float32)
        for found, weight in _subsequences(codes):
            total += np.float32(weight) * features[index[found]]
        out[at : at + len(part)] = np.add.reduceat(total, starts, axis=0) * _norms(codes, starts)[:, None]
    return out


def _landmark_features(landmarks: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Row 0 is for all subsequences that no landmark has."""
    codes, starts = _coded(landmarks)
    owner = np.searchsorted(starts, np.arange(len(codes)), "right") - 1
    index, parts = np.zeros(_CODES, np.int32), list(_subsequences(codes))
    known = np.unique(np.concatenate([found for found, _ in parts]))
    known = known[known > 0]
    index[known] = np.arange(1, len(known) + 1)
    features = np.zeros((len(known) + 1, len(landmarks)), np.float32)
    for found, weight in parts:
        np.add.at(features, (index[found], owner), weight)
    features[0] = 0
    features *= _norms(codes, starts)[None, :].astype(np.float32)
    return index, features


def _machine(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weights and bias of least weighted squared hinge loss, by Newton steps."""
    ridge = np.full(x.shape[1] + 1, RIDGE)
    ridge[-1] = 1e-6
    w = np.zeros(x.shape[1] + 1)
    for _ in range(25):
        gradient, hessian = ridge * w, np.diag(ridge)
        for at in range(0, len(x), AT_ONCE // 8):
            rows = slice(at, at + AT_ONCE // 8)
            short = 1 - y[rows] * (x[rows] @ w[:-1] + w[-1])
            active = short > 0
            part = np.hstack([x[rows][active], np.ones((active.sum(), 1))])
            scaled = part * weight[rows][active, None]
            gradient -= scaled.T @ (y[rows][active] * short[active])
            hessian += scaled.T @ part
        step = np.linalg.solve(hessian, gradient)
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _bearers(bags: list[np.ndarray], clean_held: np.ndarray, clean_documents: int) -> np.ndarray:
    """Words that many toxic documents have, and no or far fewer clean ones: a greedy cover of the documents.

    A word has to be in more documents than one that clean documents just happen to hold so rarely would be;
    ``clean_held`` says how many of these hold each word.
    Copies of a document count once; their other words, as frequent as the one that
    matters, are not needed for the cover.
    """
    copies = {tuple(sorted((bag * 0x9E3779B1 % (1 << 32)).tolist())[:3]): bag for bag in bags}
    left = list(copies.values())
    chance = (clean_held + 3 * clean_held**0.5 + 3) * len(left) / max(1, clean_documents)
    enough = chance + 5 * chance**0.5 + 4
    names = len(clean_held)
    times, found = [0] * len(left), []
    while True:
        held = np.bincount(np.concatenate(left), minlength=names) if left else np.zeros(names, int)
        held[found] = 0
        held[(clean_held > 0) & (held < enough)] = 0
        best = int(np.argmax(held))
        if held[best] < enough[best] and (found or not held[best]):
            return np.array(found, int)
        found.append(best)
        kept = []
        for i, bag in enumerate(left):
            times[i] += best in bag
            if times[i] < COVER:
                kept.append(i)
        left, times = [left[i] for i in kept], [times[i] for i in kept]


def fit_words(toxic: list[list[str]], clean: list[str], clean_documents: int, landmarks: int = LANDMARKS, rounds: int = ROUNDS) -> Scorer:
    """A scorer of words, from the words of each toxic document that no clean one has, and words of clean ones."""
    toxic = [words for words in toxic if words]
    names = sorted({w for words in toxic for w in words})
    at = {w: i for i, w in enumerate(names)}
    bags = [np.array([at[w] for w in words]) for words in toxic]
    seeds = _bearers(bags, np.zeros(len(names)), clean_documents) if names else np.zeros(0, int)
    open_ = [words for words, bag in zip(toxic, bags, strict=True) if not np.isin(bag, seeds).any()]

    def hardest(scorer: Scorer) -> dict[str, int]:
        scores = scorer.words(clean)
        return {clean[i]: 1 for i in np.argsort(-scores, kind="stable")[:HARD]}

    def unexplained(scorer: Scorer) -> list[str]:
        worst = [(float(scores.max()), words[int(scores.argmax())]) for words in open_ for scores in [scorer.words(words)]]
        return sorted({w for score, w in worst if score > 0})

    return _fit([names[i] for i in seeds], dict.fromkeys(clean[:SAMPLE], 1), hardest, unexplained, landmarks, rounds)


def _fit(
    seeds: list[str],
    sample: dict[str, int],
    hardest: Callable[[Scorer], dict[str, int]],
    unexplained: Callable[[Scorer], list[str]],
    landmarks: int = LANDMARKS,
    rounds: int = ROUNDS,
) -> Scorer:
    """A scorer of words, from bad words, and clean ones with the number of documents that hold them.

    ``hardest`` gives clean words that a scorer takes for bad, ``unexplained`` words that bear the
    label of toxic documents without one of the bad words.
    """
    if not seeds or not sample:
        return Scorer(np.zeros(_CODES, np.float32), -1.0)
    chosen, more, hard = np.random.default_rng(0), [], {}
    spread = [list(sample)[i] for i in chosen.permutation(len(sample))]
    for _ in range(rounds):
        first = list(dict.fromkeys(seeds + more))
        varied = []
        for word in first:
            for at in chosen.integers(1, len(word), VARIANTS) if len(word) >= _LENGTH else ():
                varied.append(word[:at] + string.ascii_lowercase[chosen.integers(26)] + word[at:])
        varied = [varied[i] for i in chosen.permutation(len(varied))]
        marks = list(dict.fromkeys(first[:landmarks] + varied[: landmarks // 2] + spread[: landmarks // 2] + list(hard)[:landmarks]))
        index, features = _landmark_features(marks)
        values, vectors = np.linalg.eigh(_kernel(marks, index, features).astype(float))
        keep = values > 1e-6 * values.max()
        whiten = (vectors[:, keep] / np.sqrt(values[keep])).astype(np.float32)
        bad, good = first + varied, {**sample, **hard}
        x = _kernel(bad + list(good), index, features) @ whiten
        y = np.concatenate([np.ones(len(bad)), -np.ones(len(good))])
        share = np.array([(1 + np.log2(n)) * (HARDER if w in hard else 1.0) for w, n in good.items()])
        w = _machine(x, y, np.concatenate([np.full(len(bad), 1 / len(bad)), 2 * share / share.sum()]))
        table = np.zeros(_CODES, np.float32)
        weights = features @ (whiten @ w[:-1])
        known = np.nonzero(index)[0]
        table[known] = weights[index[known]]
        scorer = Scorer(table, float(w[-1]))
        del x, features, index
        more = unexplained(scorer)
        hard = dict(list({**hardest(scorer), **hard}.items())[:KEPT])
    return scorer


def _calibrated(scorer: Scorer, values: np.ndarray, labels: np.ndarray) -> Scorer:
    """The cut between documents' values with few errors that is next to the machine's own, zero.

    As many more errors than the fewest count as none as half of what chance adds to them.
    """
    if len(np.unique(labels)) < 2:
        return Scorer(scorer.table, scorer.bias, SLOPE, 0.0)
    each = np.unique(values)
    cuts = np.concatenate([[0.0], (each[1:] + each[:-1]) / 2, each[:1] - 0.1, each[-1:] + 0.1])
    clean, toxic = np.sort(values[labels == 0]), np.sort(values[labels == 1])
    errors = len(clean) - np.searchsorted(clean, cuts) + np.searchsorted(toxic, cuts)
    best = cuts[errors <= errors.min() + 0.5 * np.sqrt(errors.min())]
    cut = best[np.argmin(np.abs(best))]
    return Scorer(scorer.table, scorer.bias, SLOPE, float(-SLOPE * cut))


def _worst_column(df: DataFrame, scorer: Scorer, text: str | Column, probability: bool) -> Column:
    """The largest output over a text's words, or its probability; without words as a word of no known part."""
    prepare(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(scorer)

    @F.arrow_udf("double")
    @released
    def worst(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model, cache = shared.value, {}
        for texts in batches:
            found = []
            for at in range(0, len(texts), 32):
                each = [words_of(t.as_py()) for t in texts.slice(at, 32)]
                if len(cache) > CACHE:
                    cache.clear()
                new = list(set().union(*each).difference(cache))
                cache.update(zip(new, model.words(new).tolist(), strict=True))
                found += [max(map(cache.__getitem__, words), default=model.bias) for words in each]
            values = np.array(found, float)
            yield pa.array(model.probability(values) if probability else values, pa.float64())

    return worst.asNondeterministic()(text)  # else a filter would score each text again


def train(docs: DataFrame, labels: DataFrame, documents: tuple[int, int] = DOCUMENTS) -> Scorer:
    """A scorer from texts ``doc_id, text`` and labels ``doc_id, toxic`` (0 or 1).

    Of the clean and the toxic rows, as many as ``documents`` says are taken, those of the smallest hashed ids; ids, texts or
    labels that are null are not. All their words count: sums and searches over them are made on the workers,
    and what comes to the driver are words that lean to toxic documents, a sample of clean ones and the hardest of
    each round. Without rows of both classes every text scores below one half.
    """
    spark = docs.sparkSession
    prepare(spark)
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    ranked = [known.where(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(documents[c]) for c in (0, 1)]
    wanted = F.broadcast(ranked[0].union(ranked[1]))  # two numbers for each of a bounded count of rows
    rows = docs.where(F.col("text").isNotNull()).join(wanted, "doc_id")
    rows = rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("long").alias("toxic"), "text")
    # a bounded sample: few files, however many tasks the scan has
    rows = staged(rows.repartition(SAMPLE_PARTS), "labelled")

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                words = [[w for w in dict.fromkeys(words_of(t.as_py())) if w.strip(string.punctuation)] for t in part.column(2)]
                row = pa.array(np.repeat(np.arange(len(words)), [len(w) for w in words]))
                each = pa.array([w for ws in words for w in ws], pa.string())
                yield pa.RecordBatch.from_arrays([part.column(0).take(row), part.column(1).take(row), each], ["doc_id", "toxic", "word"])

    back = F.pmod(F.xxhash64("doc_id"), F.lit(BACK)) == 0
    words = staged(rows.where(~back).mapInArrow(released(listed), "doc_id long, toxic long, word string"), "words")
    numbers = {r["toxic"]: r["count"] for r in rows.where(~back).groupBy("toxic").count().collect()}
    ratio = numbers.get(1, 0) / max(1, numbers.get(0, 0))
    held = staged(words.groupBy("word").agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good")), "held")
    # as in _bearers: more toxic documents than a word that so few clean ones hold would be in by chance
    chance = (F.col("good") + 3 * F.sqrt("good") + 3) * ratio
    often = F.col("bad") >= chance + 5 * F.sqrt(chance) + 4
    leaning = (F.col("good") > 0) & (F.col("bad") >= OFTEN * ratio * F.col("good")) & often
    quoted = held.where(leaning)
    # the words that may explain a label; where none is in enough documents, the one that is in most
    most = held.where("good = 0 AND bad > 0").orderBy(F.desc("bad"), "word").limit(1)
    candidates = quoted.union(held.where((F.col("good") == 0) & often)).union(most).distinct()
    found = words.where("toxic = 1").join(candidates, "word").select("doc_id", "word", "good").toArrow().to_pylist()
    names = sorted({r["word"] for r in found})
    at, counts, bags = {w: i for i, w in enumerate(names)}, np.zeros(len(names)), {}
    for r in found:
        counts[at[r["word"]]] = r["good"]
        bags.setdefault(r["doc_id"], []).append(at[r["word"]])
    bearers = _bearers([np.array(sorted(bags[d])) for d in sorted(bags)], counts, numbers.get(0, 0)) if names else []
    seeds = [names[i] for i in bearers]
    # what a clean document with such a word says is no example of clean words
    doubtful = words.where("toxic = 0").join(quoted.select("word"), "word", "left_semi").select("doc_id").distinct()
    clean = words.where("toxic = 0").join(doubtful, "doc_id", "left_anti").groupBy("word").agg(F.count("*").alias("n"))
    clean = staged(clean.join(quoted.select("word"), "word", "left_anti"), "clean")
    # a word is the likelier in the sample the more documents hold it
    draw = -F.log((F.pmod(F.xxhash64("word"), F.lit(1 << 40)) + 1) / float((1 << 40) + 1)) / F.col("n")
    sample = {r["word"]: r["n"] for r in clean.orderBy(draw, "word").limit(SAMPLE).toArrow().to_pylist()}
    named = spark.createDataFrame([(w,) for w in seeds], "word string")
    explained = words.where("toxic = 1").join(named, "word", "left_semi").select("doc_id").distinct()
    fresh = held.where((F.col("good") == 0) | leaning).select("word")
    open_ = staged(words.where("toxic = 1").join(explained, "doc_id", "left_anti").join(fresh, "word", "left_semi").select("doc_id", "word"), "open")

    def hardest(scorer: Scorer) -> dict[str, int]:
        scored = clean.withColumn("score", _word_column(clean, scorer)).orderBy(F.desc("score"), "word").limit(HARD)
        return {r["word"]: r["n"] for r in scored.toArrow().to_pylist()}

    def unexplained(scorer: Scorer) -> list[str]:
        worst = open_.withColumn("score", _word_column(open_, scorer)).groupBy("doc_id").agg(F.max(F.struct("score", "word")).alias("worst"))
        return sorted({r["word"] for r in worst.where("worst.score > 0").select("worst.word").toArrow().to_pylist()})

    scorer = _fit(seeds, sample, hardest, unexplained)
    values = rows.where(back) if rows.where(back).select("toxic").distinct().count() > 1 else rows
    found = values.select("toxic", _worst_column(values, scorer, "text", False).alias("value")).toPandas()
    return _calibrated(scorer, found["value"].to_numpy(float), found["toxic"].to_numpy(float))


def _word_column(df: DataFrame, scorer: Scorer) -> Column:
    """The machine's output for the column ``word``."""
    shared = df.sparkSession.sparkContext.broadcast(scorer)

    @F.arrow_udf("double")
    @released
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for words in batches:
            yield pa.array(shared.value.words(words.to_pylist()), pa.float64())

    return score("word")


def score_column(df: DataFrame, scorer: Scorer, text: str | Column) -> Column:
    """Probability that a text of ``df`` is toxic; null, empty and wordless texts have the model's base score."""
    return _worst_column(df, scorer, text, True)


def without_toxic(df: DataFrame, scorer: Scorer, text_col: str = "text") -> DataFrame:
    """The rows of ``df`` whose text scores below one half; null and empty texts stay if words without a known part do."""
    return df.where(score_column(df, scorer, F.col(text_col)) < 0.5)


def score(df: DataFrame, scorer: Scorer, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score, predicted`` of each row; other columns, whatever their names, are left out.

    Equal ids and equal rows each keep their row, an empty table gives an empty result.
    """
    rows = df.select(F.col(id_col).alias("doc_id"), score_column(df, scorer, F.col(text_col)).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
