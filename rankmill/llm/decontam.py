"""Benchmark decontamination: BM25 over an inverted index of the test items, with block-max pruning.

Items are the documents of the index, training passages are the queries. The text of an item is its
question and, behind its last line break, its answer. Every document is cut into passages of twice
the longest question, half overlapping, so that a copied question lies within one passage wholly.
All (passage, item) pairs whose BM25 score reaches `SCORE` times the score of the item's own question
are retrieved, then verified on the whole document: five-word shingles of question and answer that
occur in it. An item leaked if 0.8 of all its shingles occur, or 0.8 of those of a question of eight
words or more.

A document can meet the leak rule below that score: by a long answer without its question, without the
few rare words of the question, or by parts that lie far apart. Leaks are therefore retrieved by a second
query, the words of a whole document, from the inverted index over question and answer together and, for
questions of eight words or more, the question alone. The threshold of each such entry is the lowest
score that a document which meets its leak rule can have: its own score less the most that words can
weigh which are lost when a fifth of its shingles is missing (`most_lost`). So no leak scores below its
threshold, and every leaked pair comes from the index. The shingles of what is retrieved are then counted.

Pruning, as in WAND: terms are split so that all non-essential (frequent) ones together can't reach
half of any entry's threshold. Postings of essential terms only are followed, block by block of
entries of similar length; a block whose summed block maxima, with the most that non-essential terms
could add, stay below the threshold is skipped without looking at its entries. Bounds never
underestimate, so pruning loses no pair. It is evaluated for a whole batch of passages at once, in steps
of at most `STEP` postings or one passage.

The index holds the items only. They are read to the driver when they have at most `INDEX_MB`
of text; a larger benchmark is worked off in slices of that size, one pass over the documents each.
Items per term, the mean and the longest question are those of the whole benchmark in every slice, so
scores and retrieved pairs are the same for one slice or many.

Null and empty texts leak nothing, null and empty items can't leak; empty tables give no rows; rows that
repeat a document or an item are reported each for itself, and a score that equals its threshold is
retrieved. Texts of any length are one query each. Words are compared lower-cased, without punctuation.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankmill.llm.common import packed, ship_package, stored, text_of, unpacked

SHINGLE = 5
SIMILAR = 0.8
SCORE = 0.6
ENOUGH_WORDS = 8
K1, B = 1.2, 0.75
BLOCK = 8
INDEX_MB = 64
MEMO = 500_000
STEP = 4_000_000
FOUND = "row bigint, item_id bigint, score double, question_overlap double, answer_overlap double, leaked boolean"


def bare(word: str) -> str:
    """Letters and digits of a word, lower-cased; empty for pure punctuation."""
    return word if word.isalnum() and word.islower() else "".join(c for c in word.lower() if c.isalnum())


def bare_words(text: str) -> list[str]:
    return [w for w in map(bare, text.split()) if w]


def shingles(words: list[str]) -> set[tuple[str, ...]]:
    if not words:
        return set()
    return {tuple(words[i : i + SHINGLE]) for i in range(max(1, len(words) - SHINGLE + 1))}


def _hashes(ids: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """A hash of the `length` word numbers that begin at each place."""
    out = np.full(len(at), length, np.uint64)
    for k in range(length):
        out = (out ^ ids[at + k].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


class Item:
    def __init__(self, item_id: int | None, text: str):
        question, _, answer = text.strip().rpartition("\n")
        self.item_id = item_id
        self.question = bare_words(question or answer)
        self.answer = bare_words(answer) if question else []
        self.question_shingles, self.answer_shingles = shingles(self.question), shingles(self.answer)

    def overlaps(self, held: set[tuple[str, ...]], plain: str) -> tuple[float, float | None, bool]:
        """Shares of question and answer that a document holds; leaked or not.

        `held` are its shingles and `plain` its words between spaces, for parts shorter than a shingle.
        """

        def count(words: list[str], own: set[tuple[str, ...]]) -> int:
            return len(own & held) if len(words) >= SHINGLE else int(bool(words) and f" {' '.join(words)} " in plain)

        q, a = count(self.question, self.question_shingles), count(self.answer, self.answer_shingles)
        n, m = len(self.question_shingles), len(self.answer_shingles)
        whole = q + a >= SIMILAR * (n + m)
        asked = len(self.question) >= ENOUGH_WORDS and q >= SIMILAR * n
        return q / n, (a / m if m else None), whole or asked


def _items(rows: list[tuple[int | None, str]]) -> list[Item]:
    return [item for item in (Item(i, t) for i, t in rows if t) if item.question]


def most_lost(parts: list[list[str]], weights: dict[str, float]) -> float:
    """The most that words can weigh which no shingle holds once a fifth of all shingles is missing.

    A word is lost when all shingles over it are missing: one at either end of a part, five inside. The
    state is the run of missing shingles so far (beyond both ends all are missing at no cost) by the
    number of missing ones. A repeated shingle is missing at all its places, and a repeated word counts
    at its first place; both can only raise the result.
    """
    grams = [tuple(p[i : i + SHINGLE]) for p in parts for i in range(max(1, len(p) - SHINGLE + 1))]
    times = [n for p in parts for n in Counter(tuple(p[i : i + SHINGLE]) for i in range(max(1, len(p) - SHINGLE + 1))).values()]
    missing = sum(sorted(times, reverse=True)[: math.floor((1 - SIMILAR) * len(times) + 1e-9)])
    if missing >= len(grams):
        return sum(weights.values())
    seen: set[str] = set()
    best = np.zeros(missing + 1)
    for part in parts:
        runs = np.full((SHINGLE + 1, missing + 1), -np.inf)
        runs[SHINGLE] = best
        places = max(1, len(part) - SHINGLE + 1)
        for at, word in enumerate(part):
            weight = 0.0 if word in seen else weights[word]
            seen.add(word)
            after = np.full_like(runs, -np.inf)
            cost = 1 if at < places else 0
            after[1:, cost:] = runs[:-1, : missing + 1 - cost]
            after[SHINGLE, cost:] = np.maximum(after[SHINGLE, cost:], runs[SHINGLE, : missing + 1 - cost])
            after[SHINGLE] += weight
            if cost:
                after[0] = runs.max(0)
            runs = after
        best = runs.max(0)
    return float(best.max())


class Statistics(NamedTuple):
    """Figures of a whole benchmark's texts: their number, words, the longest one, texts per term."""

    texts: int
    words: int
    longest: int
    df: dict[str, int]

    @classmethod
    def of(cls, texts: list[list[str]]) -> Statistics:
        lengths = [len(x) for x in texts]
        return cls(len(texts), sum(lengths), max(lengths, default=0), Counter(w for x in texts for w in set(x)))

    def impacts(self, words: list[str]) -> dict[str, float]:
        """What each word of an indexed text adds to its score."""
        mean = self.words / max(self.texts, 1)
        out = {}
        for w, tf in Counter(words).items():
            idf = math.log(1 + (self.texts - self.df[w] + 0.5) / (self.df[w] + 0.5))
            out[w] = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(words) / mean))
        return out


class Postings:
    """Inverted index over entries, their impacts relative to each entry's threshold.

    Entries come in order of length, so that blocks hold similar ones.
    """

    def __init__(self, entries: list[dict[int, float]], n_terms: int):
        self.n_entries, self.n_terms = len(entries), n_terms
        self.lists: list[dict[int, float]] = [{} for _ in range(n_terms)]
        for n, impacts in enumerate(entries):
            for term, value in impacts.items():
                self.lists[term][n] = value
        self.sizes = np.array([len(x) for x in self.lists], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.entries = np.array([n for x in self.lists for n in x], np.int64)
        self.values = np.array([v for x in self.lists for v in x.values()])
        self._split()
        self._block_maxima()

    def _split(self) -> None:
        """Frequent terms are non-essential while they can't add half of any entry's threshold."""
        added = np.zeros(self.n_entries)
        self.essential = np.ones(self.n_terms, bool)
        for term in np.argsort(-self.sizes, kind="stable"):
            if self.sizes[term] < 2:
                break
            own = slice(self.starts[term], self.starts[term] + self.sizes[term])
            rows, values = self.entries[own], self.values[own]
            if (added[rows] + values).max() > 0.5:
                continue
            added[rows] += values
            self.essential[term] = False
        blocks = np.arange(self.n_entries) // BLOCK
        self.n_blocks = int(blocks[-1]) + 1 if self.n_entries else 0
        self.slack = np.zeros(self.n_blocks)  # what non-essential terms add at most, by block
        np.maximum.at(self.slack, blocks, added)

    def _block_maxima(self) -> None:
        """For essential terms: the blocks that hold them and their largest impact there."""
        blocks, maxima, counts = [], [], np.zeros(self.n_terms, np.int64)
        for term in np.flatnonzero(self.essential):
            best: dict[int, float] = {}
            for n, value in self.lists[term].items():
                best[n // BLOCK] = max(best.get(n // BLOCK, 0.0), value)
            blocks += best
            maxima += best.values()
            counts[term] = len(best)
        self.blocks, self.maxima, self.counts = np.array(blocks, np.int64), np.array(maxima), counts
        self.firsts = np.cumsum(counts) - counts

    def retrieve(self, passages: np.ndarray, terms: np.ndarray) -> Iterator[tuple[int, int, float]]:
        """(passage, entry, score relative to the threshold) with a score of one or more.

        `passages` and `terms` list which passage holds which term; pairs may repeat.
        """
        pairs = np.unique(passages * self.n_terms + terms)
        if not len(pairs):
            return
        passages, terms = pairs // self.n_terms, pairs % self.n_terms
        begins = np.flatnonzero(np.diff(passages, prepend=-1))
        before = (np.cumsum(self.sizes[terms]) - self.sizes[terms])[begins]
        cuts = begins[np.flatnonzero(np.diff(before // STEP, prepend=-1))].tolist()
        for lo, hi in zip(cuts, [*cuts[1:], len(pairs)], strict=True):
            yield from self._retrieve(passages[lo:hi], terms[lo:hi])

    def _retrieve(self, passages: np.ndarray, terms: np.ndarray) -> Iterator[tuple[int, int, float]]:
        strong = self.essential[terms]
        counts = self.counts[terms[strong]]
        at = np.repeat(self.firsts[terms[strong]] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
        places, where = np.unique(np.repeat(passages[strong], counts) * self.n_blocks + self.blocks[at], return_inverse=True)
        bound = np.bincount(where, self.maxima[at], len(places)) + self.slack[places % self.n_blocks]
        places = places[bound >= 1 - 1e-9]
        if not len(places):
            return
        inside = np.isin(passages, places // self.n_blocks)
        passages, terms = passages[inside], terms[inside]
        counts = self.sizes[terms]
        at = np.repeat(self.starts[terms] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
        passages, entries, values = np.repeat(passages, counts), self.entries[at], self.values[at]
        open_block = np.isin(passages * self.n_blocks + entries // BLOCK, places)
        keys, where = np.unique(passages[open_block] * self.n_entries + entries[open_block], return_inverse=True)
        scores = np.bincount(where, values[open_block], len(keys))
        for key, score in zip(keys[scores >= 1 - 1e-9].tolist(), scores[scores >= 1 - 1e-9].tolist(), strict=True):
            yield *divmod(key, self.n_entries), score


class Index:
    """The items of a benchmark or of a slice of it: questions for passages, leak entries for whole texts.

    Passages and impacts are those of the whole benchmark if the statistics of its questions and of its
    whole texts are given, so that scores do not depend on the slices.
    """

    def __init__(self, rows: list[tuple[int | None, str]], statistics: tuple[Statistics, Statistics] | None = None):
        self.items = sorted(_items(rows), key=lambda x: len(x.question))  # blocks of similar length
        asked, whole = statistics or (
            Statistics.of([x.question for x in self.items]),
            Statistics.of([x.question + x.answer for x in self.items]),
        )
        self.longest = asked.longest
        self.terms = {w: k for k, w in enumerate(dict.fromkeys(w for x in self.items for w in x.question))}
        answers = (w for x in self.items for w in x.answer if w not in self.terms)
        self.words = self.terms | {w: len(self.terms) + k for k, w in enumerate(dict.fromkeys(answers))}
        self.questions = Postings([self._relative(asked.impacts(x.question), SCORE) for x in self.items], len(self.terms))
        self._leak_entries(whole)
        self._shingle_lists()

    def _relative(self, impacts: dict[str, float], threshold: float) -> dict[int, float]:
        """Impacts by term number, relative to a share of their sum."""
        own = sum(impacts.values())
        return {self.words[w]: value / (threshold * own) for w, value in impacts.items()}

    def _leak_entries(self, statistics: Statistics) -> None:
        """Entries whose thresholds no leak stays below: question and answer together, long questions alone."""
        entries = []
        for n, x in enumerate(self.items):
            rules = [[p for p in (x.question, x.answer) if p]]
            if x.answer and len(x.question) >= ENOUGH_WORDS:
                rules.append([x.question])
            for parts in rules:
                words = [w for p in parts for w in p]
                impacts = statistics.impacts(words)
                own = sum(impacts.values())
                # some shingle is held in any case, and so some word
                least = max(own - most_lost(parts, impacts), min(impacts.values()))
                entries.append((len(words), n, self._relative(impacts, least / own)))
        entries.sort(key=lambda e: e[:2])
        self.leak_items = [n for _, n, _ in entries]
        self.leaks = Postings([e for _, _, e in entries], len(self.words))

    def _shingle_lists(self) -> None:
        """Hashes of all shingles, the parts that hold them, and how many each item needs to leak.

        A part shorter than a shingle counts as one; it is taken as held until its words are compared.
        Items of such parts only are counted by their question.
        """
        self.lengths: set[int] = set()
        self.needs = np.full((len(self.items), 2), np.inf)  # of both parts, of the question
        holders: dict[int, list[int]] = defaultdict(list)
        for n, x in enumerate(self.items):
            parts = [p for p in (x.question, x.answer) if p]
            longs = [len(p) >= SHINGLE for p in parts]
            whole = SIMILAR * (len(x.question_shingles) + len(x.answer_shingles))
            self.needs[n, 0] = whole - longs.count(False) if any(longs) else 1
            if len(x.question) >= ENOUGH_WORDS:
                self.needs[n, 1] = SIMILAR * len(x.question_shingles)
            for k, part in enumerate(parts):
                if longs[k] or (k == 0 and not any(longs)):
                    length = min(len(part), SHINGLE)
                    self.lengths.add(length)
                    ids = np.array([self.words[w] for w in part], np.int64)
                    for gram in set(_hashes(ids, np.arange(len(part) - length + 1), length).tolist()):
                        holders[gram].append(2 * n + k)
        self.grams = np.array(sorted(holders), np.uint64)
        lists = [holders[g] for g in self.grams.tolist()]
        self.gram_counts = np.array([len(x) for x in lists], np.int64)
        self.gram_firsts = np.cumsum(self.gram_counts) - self.gram_counts
        self.gram_parts = np.array([part for x in lists for part in x], np.int64)

    def retrieve_leaks(self, texts: list[np.ndarray]) -> set[tuple[int, int]]:
        """(text, item) of all pairs whose score reaches the threshold of a leak."""
        held = [np.unique(ids[ids >= 0]) for ids in texts]
        owners = np.repeat(np.arange(len(texts)), [len(x) for x in held])
        return {(n, self.leak_items[entry]) for n, entry, _ in self.leaks.retrieve(owners, np.concatenate(held))}

    def enough_shingles(self, texts: list[np.ndarray], pairs: set[tuple[int, int]]) -> set[tuple[int, int]]:
        """Those of the (text, item) pairs whose shingles, by their hashes, are enough for the leak rule."""
        if not pairs:
            return set()
        numbers = sorted({n for n, _ in pairs})
        counted = self._counted([texts[n] for n in numbers])
        return pairs & {(numbers[n], item) for n, item in counted}

    def _counted(self, texts: list[np.ndarray]) -> set[tuple[int, int]]:
        # a word of no item between two texts, so that no shingle spans them
        ids = np.concatenate([x for ids in texts for x in (ids, [-1])])
        starts = np.cumsum([0] + [len(x) + 1 for x in texts[:-1]])
        keys = []
        for length in self.lengths:
            whole = ids[: max(len(ids) - length + 1, 0)] >= 0
            for k in range(1, length):
                whole &= ids[k : k + len(whole)] >= 0
            at = np.flatnonzero(whole)
            hashes = _hashes(ids, at, length)
            gram = np.minimum(np.searchsorted(self.grams, hashes), len(self.grams) - 1)
            same = self.grams[gram] == hashes
            keys.append((np.searchsorted(starts, at[same], "right") - 1) * len(self.grams) + gram[same])
        held = np.unique(np.concatenate(keys))
        gram, text = held % len(self.grams), held // len(self.grams)
        counts = self.gram_counts[gram]
        at = np.repeat(self.gram_firsts[gram] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
        part = self.gram_parts[at]
        pairs, where = np.unique(np.repeat(text, counts) * len(self.items) + part // 2, return_inverse=True)
        asked = np.bincount(where, part % 2 == 0, len(pairs))
        whole = np.bincount(where, minlength=len(pairs))
        text, item = pairs // len(self.items), pairs % len(self.items)
        enough = (whole >= self.needs[item, 0] - 1e-9) | (asked >= self.needs[item, 1] - 1e-9)
        return set(zip(text[enough].tolist(), item[enough].tolist(), strict=True))

    def score(self, ids: np.ndarray, item: int) -> float:
        """The best score of an item over all passages of a text, relative to the threshold."""
        impacts = {self.terms[w]: self.questions.lists[self.terms[w]][item] for w in self.items[item].question}
        held: dict[int, set[int]] = defaultdict(set)
        for at in np.flatnonzero(np.isin(ids, list(impacts))).tolist():
            for part in (at // self.longest, at // self.longest - 1):
                held[part].add(int(ids[at]))
        return max((sum(impacts[t] for t in sorted(terms)) for part, terms in held.items() if part >= 0), default=0.0)


class _Terms(dict):
    """Word as it stands to term number, -1 for words of no item, -2 for no word at all."""

    def __init__(self, terms: dict[str, int]):
        self.known = terms

    def __missing__(self, word: str) -> int:
        if len(self) >= MEMO:
            self.clear()
        plain = bare(word)
        value = self[word] = self.known.get(plain, -1) if plain else -2
        return value


def _leaks_of(index: Index, texts: list[str], memo: _Terms) -> Iterator[tuple[int, int, float, float, float | None, bool]]:
    """(text, item, best score, overlaps, leaked) for a batch of texts."""
    stride = index.longest
    numbers, places, owners, base, bodies = [], [], [], 0, []
    for n, text in enumerate(texts):
        words = text.split()
        ids = np.fromiter(map(memo.__getitem__, words), np.int64, len(words))
        ids = ids[ids > -2]
        bodies.append(ids)
        known = np.flatnonzero((ids >= 0) & (ids < len(index.terms)))
        parts = len(ids) // stride + 1
        # a word belongs to the passage that begins at its stride and to the one before
        for back in (0, 1):
            part = known // stride - back
            inside = part >= 0
            places.append(base + part[inside])
            numbers.append(ids[known[inside]])
        owners.append((base, n))
        base += parts
    if not numbers:
        return
    starts = [b for b, _ in owners]
    best: dict[tuple[int, int], float] = {}
    for passage, item, score in index.questions.retrieve(np.concatenate(places), np.concatenate(numbers)):
        n = owners[int(np.searchsorted(starts, passage, "right")) - 1][1]
        best[n, item] = max(best.get((n, item), 0.0), score)
    current, held, plain = -1, set(), ""
    likely = index.enough_shingles(bodies, index.retrieve_leaks(bodies))
    for n, item in sorted(best.keys() | likely):
        if n != current:
            words = bare_words(texts[n])
            current, held, plain = n, shingles(words), f" {' '.join(words)} "
        *overlaps, leaked = index.items[item].overlaps(held, plain)
        if leaked or (n, item) in best:
            score = best[n, item] if (n, item) in best else index.score(bodies[n], item)
            yield n, item, score * SCORE, *overlaps, leaked


ITEM_WORDS = "asked_words long, words long, asked array<string>, answered array<string>"


def _item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of each question and of question and answer; different ones of the question, and of the answer only."""
    for batch in batches:
        items = _items([(None, text) for text in batch.column(0).to_pylist()])
        asked = [set(x.question) for x in items]
        arrays = [
            pa.array([len(x.question) for x in items], pa.int64()),
            pa.array([len(x.question) + len(x.answer) for x in items], pa.int64()),
            pa.array([sorted(q) for q in asked], pa.list_(pa.string())),
            pa.array([sorted(set(x.answer) - q) for x, q in zip(items, asked, strict=True)], pa.list_(pa.string())),
        ]
        yield pa.RecordBatch.from_arrays(arrays, ["asked_words", "words", "asked", "answered"])


def _slices(items: DataFrame) -> Iterator[Index]:
    """Indexes of parts of the benchmark whose text is within the bound.

    Items per term, the mean and the longest question are counted once, over all items; a part gets the
    counts of its own terms.
    """
    total = items.agg(F.sum(F.octet_length(text_of()))).head()[0] or 0
    parts = math.ceil(total / (INDEX_MB * 2**20)) or 1
    if parts == 1:
        yield Index([(r["item_id"], r["text"]) for r in items.collect()])
        return

    def terms(table: DataFrame) -> DataFrame:
        asked = table.select(F.explode("asked").alias("term"), F.lit(1).alias("asked"))
        return asked.unionByName(table.select(F.explode("answered").alias("term"), F.lit(0).alias("asked")))

    texts = stored(items.select("text").mapInArrow(_item_words, ITEM_WORDS), "benchmark-words")
    n, asked_words, longest, words, longest_text = texts.agg(
        F.count("words"), F.sum("asked_words"), F.max("asked_words"), F.sum("words"), F.max("words")
    ).head()
    df = stored(terms(texts).groupBy("term").agg(F.sum("asked").alias("asked"), F.count("*").alias("df")), "benchmark-terms")
    for k in range(parts):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == k)
        own = terms(part.select("text").mapInArrow(_item_words, ITEM_WORDS)).select("term").distinct()
        counts = df.join(own, "term", "left_semi").collect()
        statistics = (
            Statistics(n, asked_words or 0, longest or 0, {r["term"]: r["asked"] for r in counts}),
            Statistics(n, words or 0, longest_text or 0, {r["term"]: r["df"] for r in counts}),
        )
        yield Index([(r["item_id"], r["text"]) for r in part.collect()], statistics)


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, score, question_overlap, answer_overlap, leaked) of all retrieved pairs.

    The score is relative to the item's own; pairs of a passage at `SCORE` or more are listed, and all
    that leaked.
    """
    ship_package(docs.sparkSession)
    texts = docs.select("doc_id", text_of().alias("text"))
    found = None
    for part in _slices(benchmark.select(F.col("item_id").cast("long"), "text")):
        index = texts.sparkSession.sparkContext.broadcast(part)

        def leaks(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            memo = _Terms(index.value.words)
            for batch in batches if index.value.items else ():
                ids, column = batch.column(0), batch.column(1)
                for at in range(0, batch.num_rows, 256):
                    texts = column.slice(at, 256).to_pylist()
                    rows = [
                        (ids[at + n].as_py(), index.value.items[item].item_id, score, q, a, leaked)
                        for n, item, score, q, a, leaked in _leaks_of(index.value, texts, memo)
                    ]
                    names = [f.split()[0] for f in FOUND.split(", ")]
                    kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.bool_()]
                    columns = zip(*rows, strict=True) if rows else [[]] * len(names)
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        some = texts.select(F.col("doc_id").cast("long").alias("row"), "text").mapInArrow(leaks, FOUND)
        found = some if found is None else found.unionByName(some)
    return found.withColumnRenamed("row", "doc_id")


def drop_leaked(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no leaked item, columns as in `docs`.

    Rows that share a document id and a text go together; documents without an id are judged too.
    """
    version = F.xxhash64(text_of()).alias("version")
    found = find_leaks(docs.select(version.alias("doc_id"), "text"), benchmark).filter("leaked")
    leaked = found.select(F.col("doc_id").alias("version")).distinct()
    return unpacked(packed(docs, version).join(leaked, "version", "left_anti"))
