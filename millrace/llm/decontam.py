"""Benchmark passages in documents, edited ones too, by embedding edit distance into Hamming distance.

The embedding (Chakraborty, Goldenberg and Koucký) walks over a sequence: at each step it gives out
the word it stands on, and a random bit of that step and word says whether it moves on. Two
sequences a few edits apart give outputs that agree at most steps. So samples of the output
are a locality-sensitive hash: every window of an item's size whose sampled steps equal the
item's is a candidate, the walk and sample are repeated for each size of item until edited copies
of that size are found with the recall asked for, and candidates are verified by their exact edit
distance.

Walks of long items part too often, and short ones have few steps. Items beyond either size, and those
of sizes that the most walks do not bring to that recall, are found without walks and without loss: no edits can undo
more of an item's rarest words than there are edits, so every stretch that holds enough of these
words is verified.

Words that no item has cannot match. A window with more of them than the edits allowed cannot
hold the item, which rules out nearly all windows before any walk, at no loss.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from millrace.llm.common import prepare, released

#: Edits for a word of the item, items shorter than this many words are found without walks, and the recall
#: of copies with as many edits as allowed.
EDITS, MIN_WORDS, RECALL = 0.2, 8, 0.97
#: Sampled steps of a walk; the most walks; edited copies of each size that set their number; words of
#: the longest items that are walked.
SAMPLED, MOST_WALKS, TRIALS, WALKED = 3, 64, 200, 96
#: Places of rare words that are looked at side by side, about.
AT_ONCE = 1 << 21
#: Bytes of items in one index, about. A larger benchmark is looked up in several blocks.
BLOCK_BYTES = 4 << 20

#: Scripts written without spaces: Thai to Myanmar, Khmer, kana, and Han with its extensions.
_UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3041-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9d\U00020000-\U0003ffff"
_WORDS = re.compile(r"\w+").findall
_HAS_UNSPACED = re.compile(f"[{_UNSPACED}]").search
_UNITS = re.compile(rf"[{_UNSPACED}]|[^\W{_UNSPACED}]+").findall
_SEED = 20_240_607


def words_of(text: str | None) -> list[str]:
    """Lower-case words without signs; in scripts without spaces each character is one."""
    if not text:
        return []
    text = text.lower()
    if text.isascii() or not _HAS_UNSPACED(text):
        return _WORDS(text)
    return [unit for unit in _UNITS(text) if unit.isalnum() or _WORDS(unit)]


def placed(item: np.ndarray, region: np.ndarray) -> tuple[int, int]:
    """Least edit distance of the item and any stretch of the region, and the first word of such a stretch."""
    size = len(region) + 1
    cost, start = np.zeros(size, np.int64), np.arange(size)
    steps = np.arange(size)
    for word in item:
        differ = (region != word).astype(np.int64)
        # up: the item's word is left out; aside: it stands for the region's word
        up, aside = cost + 1, np.concatenate([[cost[0] + 1], cost[:-1] + differ])
        take = np.concatenate([[False], aside[1:] <= up[1:]])
        best = np.where(take, aside, up)
        origin = np.where(take, np.concatenate([[0], start[:-1]]), start)
        # along: words of the region too many; the least of best - steps so far
        lowest = np.minimum.accumulate(best - steps)
        source = np.maximum.accumulate(np.where(best - steps == lowest, steps, 0))
        cost, start = lowest + steps, origin[source]
    end = int(np.argmin(cost))
    return int(cost[end]), int(start[end])


@dataclass
class Walk:
    """One random walk: its bits by step and word, and for each size of item the steps that are sampled."""

    bits: np.ndarray
    sampled: dict[int, list[int]]

    def signatures(self, words: np.ndarray, starts: np.ndarray, chosen: dict[int, np.ndarray], end: int) -> dict[int, np.ndarray]:
        """For each size, hashes of the sampled steps of walks over so many words from its ``chosen`` starts.

        A walk does not depend on the size until it leaves the window; from there on it stands
        on ``end``, the word that stops.
        """
        at, found = starts.astype(np.int64), {s: np.zeros(len(c), np.uint64) for s, c in chosen.items()}
        wanted: dict[int, list[int]] = {}
        for size in chosen:
            for step in self.sampled[size]:
                wanted.setdefault(step, []).append(size)
        for step in range(max(wanted, default=-1) + 1):
            word = words[np.minimum(at, len(words) - 1)]
            for size in wanted.get(step, ()):
                own = chosen[size]
                there = np.where(at[own] < starts[own] + size, word[own], end).astype(np.uint64)
                found[size] = found[size] * np.uint64(0x9E3779B97F4A7C15) + there + np.uint64(1)
            at += self.bits[step][word]
        return found


@dataclass
class Index:
    """Items by their number of words, walks enough for the recall asked for, and rare words of items without walks.

    ``need`` says of each item how many places of its ``anchors`` a stretch must have; those of
    word ``w`` are the items from ``begin[w]`` to ``begin[w + 1]``.
    """

    ids: list
    items: list[np.ndarray]
    vocabulary: dict[str, int]
    edits: float
    rare: dict[int, np.ndarray] = field(default_factory=dict)
    walks: list[Walk] = field(default_factory=list)
    tables: list[dict[int, tuple[np.ndarray, np.ndarray]]] = field(default_factory=list)
    need: np.ndarray | None = None
    anchors: np.ndarray | None = None
    begin: np.ndarray | None = None

    @property
    def end(self) -> int:
        """The word that stands between documents."""
        return len(self.vocabulary) + 1

    def allowed(self, size: int) -> int:
        return int(self.edits * size)

    @classmethod
    def of(cls, items: list[tuple[object, str | None]], edits: float = EDITS, min_words: int = MIN_WORDS, recall: float = RECALL) -> Index:
        vocabulary: dict[str, int] = {}
        ids, coded = [], []
        for item_id, text in items:
            words = words_of(text)
            if words:
                ids.append(item_id)
                coded.append(np.array([vocabulary.setdefault(w, len(vocabulary) + 1) for w in words], np.int64))
        index = cls(ids, coded, vocabulary, edits)
        if coded:
            # those in the fewest items, of these the longest; a choice that bears on time only
            held = np.bincount(np.concatenate([np.unique(i) for i in coded]))
            length = np.array([0, *map(len, vocabulary)])
            order = [np.lexsort((-length[item], held[item])) for item in coded]
            walked = index._walk(recall, min_words)
            for item, rarest in zip(coded, order, strict=True):
                if len(item) in walked:
                    own = index.rare.setdefault(len(item), np.zeros(index.end + 1, bool))
                    own[item[rarest[: index.allowed(len(item)) + 2]]] = True
            index._anchor([i for i, item in enumerate(coded) if len(item) not in walked], order)
        return index

    def _walk(self, recall: float, min_words: int) -> set[int]:
        """Walks for each size until its own trial copies are found; the sizes that got there."""
        chosen = np.random.default_rng(_SEED)
        own: dict[int, list[int]] = {}
        for i, item in enumerate(self.items):
            if min_words <= len(item) <= WALKED:
                own.setdefault(len(item), []).append(i)
        sizes = sorted(own)
        tried = {s: chosen.choice(len(own[s]), TRIALS) for s in sizes}
        items = self._laid([(s, [self.items[i] for i in own[s]]) for s in sizes])
        copies = self._laid([(s, [self._edited(chosen, self.items[own[s][t]]) for t in tried[s]]) for s in sizes])
        missed = {s: np.ones(TRIALS, bool) for s in sizes}
        while sizes and len(self.walks) < MOST_WALKS:
            bits = chosen.integers(0, 2, (2 * sizes[-1], self.end + 1), np.int8)
            bits[:, self.end] = 0
            walk = Walk(bits, {s: sorted(chosen.choice(2 * s, SAMPLED, replace=False).tolist()) for s in sizes})
            keys, found = (walk.signatures(words, starts, {s: at[s] for s in sizes}, self.end) for words, starts, at in (items, copies))
            table = {}
            for size in sizes:
                order = np.argsort(keys[size], kind="stable")
                table[size] = keys[size][order], np.array(own[size])[order]
                missed[size] &= found[size] != keys[size][tried[size]]
            self.walks.append(walk)
            self.tables.append(table)
            sizes = [s for s in sizes if missed[s].mean() > 1 - recall]
        for walk, table in zip(self.walks, self.tables, strict=True):
            for size in sizes:
                del walk.sampled[size], table[size]
        kept = [i for i, table in enumerate(self.tables) if table]
        self.walks, self.tables = [self.walks[i] for i in kept], [self.tables[i] for i in kept]
        return set(own) - set(sizes)

    def _laid(self, groups: list[tuple[int, list[np.ndarray]]]) -> tuple[np.ndarray, np.ndarray, dict[int, np.ndarray]]:
        """Sequences in one array, each with stops as wide as its size; where each begins; which ones a size has."""
        parts, lengths, at = [], [], {}
        for size, each in groups:
            at[size] = np.arange(len(lengths), len(lengths) + len(each))
            for words in each:
                parts += [words, np.full(size, self.end)]
                lengths.append(len(words) + size)
        ends = np.cumsum(np.array(lengths, np.int64))
        return np.concatenate(parts) if parts else np.zeros(0, np.int64), ends - np.array(lengths, np.int64), at

    def _edited(self, chosen: np.random.Generator, item: np.ndarray) -> np.ndarray:
        """A copy of an item with as many random edits as are allowed."""
        copy = item.tolist()
        for at, kind, word in chosen.integers(0, 1 << 40, (self.allowed(len(copy)), 3)).tolist():
            where, kind, word = at % len(copy), kind % 3, word % self.end
            if kind == 0:
                copy[where] = word
            elif kind == 1:
                copy.insert(where, word)
            elif len(copy) > 1:
                del copy[where]
        return np.array(copy, np.int64)

    def _anchor(self, numbers: list[int], order: list[np.ndarray]) -> None:
        """Of each item the places of its rarest words: edits can undo all but half of the words that have to stay."""
        if not numbers:
            return
        self.need = np.zeros(len(self.items), np.int64)
        words, owners = [], []
        for i in numbers:
            size = len(self.items[i])
            allowed = self.allowed(size)
            self.need[i] = max(1, (size - allowed) // 2)
            own = np.unique(self.items[i][order[i][: allowed + self.need[i]]])
            words.append(own)
            owners.append(np.full(len(own), i))
        words = np.concatenate(words)
        by_word = np.argsort(words, kind="stable")
        self.anchors = np.concatenate(owners)[by_word]
        self.begin = np.searchsorted(words[by_word], np.arange(self.end + 2))

    def coded(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Words of all texts in one array, a stop after each; where each text begins."""
        parts, begins, at = [], [], 0
        for text in texts:
            words = words_of(text)
            parts.append(np.fromiter(map(self.vocabulary.get, words, repeat(0)), np.int64, len(words)))
            parts.append(np.array([self.end]))
            begins.append(at)
            at += len(words) + 1
        return np.concatenate(parts) if parts else np.zeros(0, np.int64), np.array(begins, np.int64)

    def find(self, texts: list[str | None]) -> list[tuple[int, object, int, int]]:
        """``(text, item id, edits, first word)``: the best place of each item in each text that holds it."""
        if not self.items or not texts:
            return []
        words, begins = self.coded(texts)
        stops = np.append(begins[1:], len(words)) - 1
        starts, chosen = self._starts(words)
        best: dict[tuple[int, int], tuple[int, int]] = {}
        seen: set[tuple[int, int]] = set()
        for walk, table in zip(self.walks, self.tables, strict=True):
            for size, found in walk.signatures(words, starts, {s: c for s, c in chosen.items() if s in table}, self.end).items():
                keys, items = table[size]
                low, high = np.searchsorted(keys, found, "left"), np.searchsorted(keys, found, "right")
                for i in np.nonzero(high > low)[0]:
                    for item in items[low[i] : high[i]]:
                        spot = int(starts[chosen[size][i]]), int(item)
                        if spot not in seen:
                            seen.add(spot)
                            self._verify(spot, words, begins, stops, best)
        for number, text, low, high in self._stretches(words, begins, stops):
            self._place(text, number, words[low:high], low - int(begins[text]), best)
        rows: dict[tuple[int, object], tuple[int, int]] = {}
        for (text, item), place in best.items():
            key = text, self.ids[item]
            rows[key] = min(place, rows.get(key, place))
        return [(text, item_id, *place) for (text, item_id), place in rows.items()]

    def _starts(self, words: np.ndarray) -> tuple[np.ndarray, dict[int, np.ndarray]]:
        """Where windows may begin, and for each size which of these starts may hold an item of it.

        The window has no more words that are in no item than edits allowed, and two of the
        item's rarest words: of two more of them than edits, no edits can undo all but one.
        """
        foreign = np.concatenate([[0], np.cumsum((words == 0) + (words == self.end) * len(words))])
        any_rare = np.zeros(self.end + 1, bool)
        for own in self.rare.values():
            any_rare |= own
        spots = np.nonzero(any_rare[words])[0]
        chosen = {}
        for size, own in self.rare.items():
            allowed = self.allowed(size)
            at = spots[own[words[spots]]]
            # from a window's width before the second of two of them to the first
            low, high = np.maximum(at[1:] - size - allowed + 1, 0), at[:-1]
            low, high = low[low <= high], high[low <= high]
            if len(low):
                width = high - low + 1
                starts = np.unique(np.repeat(low - np.cumsum(width) + width, width) + np.arange(width.sum()))
                ends = starts + size - allowed
                starts, ends = starts[ends <= len(words)], ends[ends <= len(words)]
                starts = starts[foreign[ends] - foreign[starts] <= allowed]
                if len(starts):
                    chosen[size] = starts
        used = np.unique(np.concatenate([*chosen.values(), np.zeros(0, np.int64)])).astype(np.int64)
        return used, {s: np.searchsorted(used, c) for s, c in chosen.items()}

    def _stretches(self, words: np.ndarray, begins: np.ndarray, stops: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """``(item, text, first, end)``: all stretches that may hold an item without walks, touching ones as one."""
        if self.anchors is None:
            return
        many = self.begin[words + 1] - self.begin[words]
        spots = np.nonzero(many)[0]
        many, texts = many[spots], np.searchsorted(begins, spots, "right") - 1
        # whole texts side by side
        block = np.cumsum(many) // AT_ONCE
        cuts = np.nonzero((texts[1:] != texts[:-1]) & (block[1:] != block[:-1]))[0] + 1
        sizes = np.array([len(i) for i in self.items])
        widths = sizes + (self.edits * sizes).astype(np.int64)
        for part in np.split(np.arange(len(spots)), cuts):
            each = many[part]
            first = np.cumsum(each) - each
            item = self.anchors[np.repeat(self.begin[words[spots[part]]] - first, each) + np.arange(each.sum())]
            at, text = np.repeat(spots[part], each), np.repeat(texts[part], each)
            order = np.lexsort((at, item))
            item, at, text = item[order], at[order], text[order]
            last = np.arange(len(item)) + self.need[item] - 1
            inside = np.minimum(last, len(item) - 1)
            width = widths[item]
            near = (last < len(item)) & (item[inside] == item) & (text[inside] == text) & (at[inside] - at < width)
            item, text, width, low, high = item[near], text[near], width[near], at[inside[near]], at[near]
            low, high = np.maximum(low - width + 1, begins[text]), np.minimum(high + width, stops[text])
            heads = np.nonzero(np.concatenate([np.ones(min(1, len(item)), bool), (item[1:] != item[:-1]) | (text[1:] != text[:-1]) | (low[1:] > high[:-1])]))[0]
            tails = np.append(heads[1:], len(item))[: len(heads)] - 1
            yield from zip(item[heads].tolist(), text[heads].tolist(), low[heads].tolist(), high[tails].tolist(), strict=True)

    def _verify(self, spot: tuple[int, int], words: np.ndarray, begins: np.ndarray, stops: np.ndarray, best: dict) -> None:
        start, number = spot
        size = len(self.items[number])
        text = int(np.searchsorted(begins, start, "right")) - 1
        low, high = max(int(begins[text]), start - self.allowed(size)), min(int(stops[text]), start + size + self.allowed(size))
        self._place(text, number, words[low:high], low - int(begins[text]), best)

    def _place(self, text: int, number: int, region: np.ndarray, low: int, best: dict) -> None:
        """The item's place in a region that begins at word ``low`` of the text, if it is there."""
        item, key = self.items[number], (text, number)
        allowed = self.allowed(len(item))
        if key in best and best[key][0] == 0:
            return  # there is no better place
        if np.count_nonzero(np.isin(item, region)) < len(item) - allowed:
            return  # so many of its words are not there
        cost, first = placed(item, region)
        if cost <= allowed:
            place = cost, low + first
            best[key] = min(place, best.get(key, place))


def indexes(benchmark: DataFrame, edits: float = EDITS, item_id: str = "item_id", text: str = "text", block_bytes: int = BLOCK_BYTES) -> Iterator[Index]:
    """Indexes of all items, a bounded part of the benchmark at a time. Null items and those without words are in none.

    Items are dealt by id and text, so that many of one id, or without one, are no part of their own.
    """
    items = benchmark.select(F.col(item_id).alias("item_id"), F.col(text).alias("text")).where(F.col("text").isNotNull())
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // block_bytes)
    for block in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        yield Index.of([(r.item_id, r.text) for r in sorted(rows, key=lambda r: (r.item_id is None, r.item_id, r.text))], edits)


def contamination(df: DataFrame, benchmark: DataFrame, edits: float = EDITS, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id, item_id, edits, first_word``: documents and the items that they hold, at a place of fewest edits.

    ``edits`` counts words put in, left out or replaced, at most the share asked for of the item's
    words; signs and case do not count, and ``first_word`` counts words from 0. Null and empty texts
    hold nothing. Equal rows each give their rows; rows of one item id are one item at its best. Empty
    tables give an empty result, and other columns, whatever their names, are left out. Ids
    may be of any type. Each block of the benchmark is one pass over the documents; only what several
    blocks found is shuffled.
    """
    spark = df.sparkSession
    prepare(spark)
    # ids keep their types; the row's number tells equal rows apart where several blocks find the same item
    ids, items = df.schema[id_col].dataType, benchmark.schema["item_id"].dataType
    fields = [("doc_id", ids), ("row", T.LongType()), ("item_id", items), ("edits", T.IntegerType()), ("first_word", T.IntegerType())]
    kind, item_kind = T.StructType([T.StructField(*f) for f in fields]), to_arrow_type(items)
    rows = df.select(F.col(id_col).alias("doc_id"), F.monotonically_increasing_id().alias("row"), F.col(text_col).alias("text"))
    parts = []
    for index in indexes(benchmark, edits, block_bytes=block_bytes):
        shared = spark.sparkContext.broadcast(index)

        def located(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = shared.value.find(batch.column(2).to_pylist())
                at = pa.array([f[0] for f in found], pa.int64())
                columns = [pa.array([f[i] for f in found], t) for i, t in ((1, item_kind), (2, pa.int32()), (3, pa.int32()))]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), *columns], kind.names)

        parts.append(rows.mapInArrow(released(located), kind))
    names = ["doc_id", "item_id", "edits", "first_word"]
    if not parts:
        return spark.createDataFrame([], kind).select(*names)
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionAll(part)
    if len(parts) > 1:
        best = whole.groupBy("doc_id", "row", "item_id").agg(F.min(F.struct("edits", "first_word")).alias("best"))
        whole = best.select("doc_id", "item_id", "best.edits", "best.first_word")
    return whole.select(*names)


def held_column(df: DataFrame, index: Index, text: str | Column) -> Column:
    """Whether a text of ``df`` holds an item of the index."""
    prepare(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(index)

    @F.arrow_udf("boolean")
    @released
    def held(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            found = np.zeros(len(texts), bool)
            found[[f[0] for f in shared.value.find(texts.to_pylist())]] = True
            yield pa.array(found)

    return held.asNondeterministic()(text)


def without_contaminated(df: DataFrame, benchmark: DataFrame, edits: float = EDITS, text_col: str = "text") -> DataFrame:
    """The rows of ``df`` whose text holds no item; null and empty texts stay."""
    for index in indexes(benchmark, edits):
        df = df.where(~held_column(df, index, F.col(text_col)))
    return df
