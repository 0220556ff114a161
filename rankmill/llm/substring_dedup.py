"""Substring dedup with a count-min prefilter.

A window is `WINDOW` consecutive words of one document. A word goes if a window that covers it has a
word sequence that also starts earlier: in a smaller document id, or earlier in the same document.

Pass 1: every task counts its windows in a sketch of two rows of saturating counters (none, one,
more). It sends the touched counters only, as gaps between their positions, and the partial sketches
are merged block by block. A merged counter is never below the true count of a window that uses it.
Pass 2: a window whose counters all say "more" may be repeated, any other one is not. Of the former
each chunk of a task keeps the first occurrence and already knows that its others go; first
occurrences are dealt out by the smallest four-word hash in them, grouped exactly by 96 bits of hash,
and all but the first one of a group go. The sketch decides how much pass 2 sends, never the result.

The sketch has `2 ** SKETCH_LOG2` counters whatever the input: 64 MB go to the tasks. Beyond some
hundred million different windows it fills up and pass 2 sends more, at most all windows; raise
`sketch_log2` with the memory of the executors. A window in a third of all documents is one entry
per chunk of a task, so no group is large.

Null text has no words. Rows that repeat a document id with the same text are one document;
with other texts they are judged by their own positions. A document without an id comes last.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankmill.llm.common import order_id, ship_package, stored, text_of

WINDOW = 20
SKETCH_LOG2 = 29
BLOCK_LOG2 = 19
GRAM = 4  # words of the pieces whose smallest hash deals out the windows
PARTS_PER_PARTITION = 4
CHUNK_WORDS = 500_000
FLUSH_WINDOWS = 2_000_000
MEMO = 200_000
M1, M2 = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F  # odd multipliers of the two window hashes


class _Hashes(dict):
    """Word to hash. The memory of frequent words is bounded; forgetting costs time only."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def _rolled(values: np.ndarray, multiplier: int, n: int) -> np.ndarray:
    """Polynomial hash, modulo 2**64, of every n consecutive values; built from powers of two."""
    m, out, covered = multiplier, None, 0
    power, width, factor = values, 1, m
    while n:
        if n & 1:
            if out is None:
                out, covered = power, width
            else:  # `power` hashes `width` values; append it behind what is covered
                out = out[: len(values) - covered - width + 1] * np.uint64(factor) + power[covered : len(values) - width + 1]
                covered += width
        n >>= 1
        if n:
            power = power[: len(power) - width] * np.uint64(factor) + power[width:]
            width, factor = 2 * width, factor * factor % 2**64
    return out


class Chunk:
    """Windows of some documents: `h1`, `h2`, the row of the document and the start in it."""

    def __init__(self, hashes: list[np.ndarray], window: int):
        lengths = np.array([len(h) for h in hashes], dtype=np.int64)
        values = np.concatenate(hashes)
        row = np.repeat(np.arange(len(hashes)), lengths)
        first = np.cumsum(lengths) - lengths
        n = max(len(values) - window + 1, 0)
        start = np.arange(n) - first[row[:n]]
        inside = start + window <= lengths[row[:n]]
        self.row, self.start = row[:n][inside], start[inside].astype(np.int32)
        self.at = np.flatnonzero(inside)
        if n:
            grams = _rolled(values, M2, min(GRAM, window))
            self.grams = (grams ^ (grams >> np.uint64(32))) * np.uint64(M1)
            self.h1 = _rolled(values, M1, window)[inside]
            mixed = (values ^ (values >> np.uint64(29))) * np.uint64(M1)
            self.h2 = (_rolled(mixed, M2, window)[inside] >> np.uint64(32)).astype(np.uint32)
        else:
            self.h1, self.h2, self.grams = np.zeros(0, np.uint64), np.zeros(0, np.uint32), np.zeros(0, np.uint64)


def _chunks(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[tuple[list[tuple], Chunk]]:
    """The leading columns of the rows of a chunk, and its windows. The last column is the text."""
    memo = _Hashes()
    keys, hashes, total = [], [], 0
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns[:-1]]
        for *key, text in zip(*columns, batch.columns[-1], strict=True):
            words = text.as_py().encode("utf-8", "surrogatepass").split()
            if len(words) < window:
                continue
            keys.append(tuple(key))
            hashes.append(np.fromiter(map(memo.__getitem__, words), np.uint64, len(words)))
            total += len(words)
            if total >= CHUNK_WORDS:
                yield keys, Chunk(hashes, window)
                keys, hashes, total = [], [], 0
    if keys:
        yield keys, Chunk(hashes, window)


def _counters(h1: np.ndarray, sketch_log2: int) -> list[np.ndarray]:
    """The counter of each window in the two rows of the sketch."""
    half = sketch_log2 - 1
    mixed = [(h1 ^ (h1 >> np.uint64(31))) * np.uint64(m) for m in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]
    return [(x >> np.uint64(64 - half)).astype(np.uint32) + np.uint32(k << half) for k, x in enumerate(mixed)]


def packed_gaps(positions: np.ndarray) -> bytes:
    """Rising positions as gaps of a byte; 255 adds to the next byte."""
    gaps = np.diff(positions.astype(np.int64), prepend=0)
    ends = np.cumsum(gaps // 255 + 1) - 1
    out = np.full(int(ends[-1]) + 1 if len(ends) else 0, 255, dtype=np.uint8)
    out[ends] = gaps % 255
    return out.tobytes()


def unpacked_gaps(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, dtype=np.uint8)
    return np.cumsum(raw, dtype=np.int64)[raw < 255]


def repeated_counters(texts: DataFrame, window: int, sketch_log2: int) -> DataFrame:
    """(block, bits): the merged sketch as one bit per counter, set where it says "more".

    Blocks without such a counter are left out.
    """
    block_log2 = min(BLOCK_LOG2, sketch_log2)

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(parts: list[np.ndarray]) -> pa.RecordBatch:
            positions, counts = np.unique(np.concatenate(parts), return_counts=True)
            blocks = positions >> np.uint32(block_log2)
            cuts = np.flatnonzero(np.diff(blocks, prepend=np.uint32(2**32 - 1)))
            low = positions & np.uint32(2**block_log2 - 1)
            names, touched, more = [], [], []
            for a, b in zip(cuts, [*cuts[1:], len(positions)], strict=True):
                names.append(int(blocks[a]))
                touched.append(packed_gaps(low[a:b]))
                more.append(packed_gaps(low[a:b][counts[a:b] > 1]))
            arrays = [pa.array(names, pa.int32()), pa.array(touched, pa.binary()), pa.array(more, pa.binary())]
            return pa.RecordBatch.from_arrays(arrays, ["block", "touched", "more"])

        parts, total = [], 0
        for _, chunk in _chunks(batches, window):
            parts += _counters(chunk.h1, sketch_log2)
            total += len(chunk.h1)
            if total >= FLUSH_WINDOWS:
                yield flush(parts)
                parts, total = [], 0
        if total:
            yield flush(parts)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def bits() -> pa.RecordBatch:
            packed = np.packbits(more, bitorder="little").tobytes()
            return pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([packed], pa.binary())], ["block", "bits"])

        block, one, more = None, None, None
        for batch in batches:
            for name, touched, twice in zip(*batch.columns, strict=True):
                if name.as_py() != block:
                    if block is not None and more.any():
                        yield bits()
                    block = name.as_py()
                    one, more = np.zeros(2**block_log2, bool), np.zeros(2**block_log2, bool)
                at = unpacked_gaps(touched.as_py())
                more[at[one[at]]] = True
                one[at] = True
                more[unpacked_gaps(twice.as_py())] = True
        if block is not None and more.any():
            yield bits()

    parts = texts.select("text").mapInArrow(sketched, "block int, touched binary, more binary")
    return parts.repartition("block").sortWithinPartitions("block").mapInArrow(merged, "block int, bits binary")


def _parts(chunk: Chunk, hit: np.ndarray, window: int, parts: int) -> np.ndarray:
    """The part of each window in `hit`: of the smallest four-word hash in it.

    Equal windows share it, and so do most neighbours, so a repeated passage travels in few pieces.
    """
    inner = window - min(GRAM, window) + 1
    least = chunk.grams
    width = 1
    while 2 * width <= inner:
        least = np.minimum(least[: len(least) - width], least[width:])
        width *= 2
    if width < inner:
        least = np.minimum(least[: len(least) - (inner - width)], least[inner - width :])
    return (least[chunk.at[hit]] % np.uint64(parts)).astype(np.int32)


def _cut(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the runs of equal keys."""
    begins = np.flatnonzero(np.diff(keys, prepend=keys[:1] - 1)) if len(keys) else np.zeros(0, np.int64)
    return begins, np.append(begins[1:], len(keys)) if len(keys) else begins


def _losers(h1: np.ndarray, h2: np.ndarray, doc: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Which occurrences are not the first one (document, then start) of their window."""
    order = np.lexsort((start, doc, h2, h1))
    a, b = order[1:], order[:-1]
    same = np.concatenate([[False], (h1[a] == h1[b]) & (h2[a] == h2[b])])
    lead = order[np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))]
    lost = np.zeros(len(order), bool)
    lost[order] = (doc[order] != doc[lead]) | (start[order] != start[lead])
    return lost


CANDIDATES = "part int, docs array<bigint>, versions array<bigint>, counts array<int>, steps binary, h1 binary, h2 binary, gone array<binary>"
REMOVALS = "doc bigint, version bigint, gone binary"


def _removals(texts: DataFrame, sketch: bytes, window: int, sketch_log2: int) -> DataFrame:
    """(doc, version, gone): starts of windows that also start earlier, as packed gaps; a document may
    have several rows."""
    spark = texts.sparkSession
    parts = PARTS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    shared = spark.sparkContext.broadcast(sketch)  # 2 ** sketch_log2 bits

    def maybe(h1: np.ndarray) -> np.ndarray:
        table, hit = np.frombuffer(shared.value, np.uint8), np.ones(len(h1), bool)
        for at in _counters(h1, sketch_log2):
            hit &= (table[at >> np.uint32(3)] >> (at & np.uint32(7)).astype(np.uint8) & 1).astype(bool)
        return hit

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, chunk in _chunks(batches, window):
            hit = np.flatnonzero(maybe(chunk.h1))
            if not len(hit):
                continue
            doc, version = (np.array(column, np.int64) for column in zip(*keys, strict=True))
            row, start, h1, h2 = chunk.row[hit], chunk.start[hit], chunk.h1[hit], chunk.h2[hit]
            lost = _losers(h1, h2, doc[row], start)
            part = _parts(chunk, hit, window, parts)
            rows = []
            for a, b in zip(*_cut(row[lost]), strict=True):
                # decided already: dealt out by the document
                n = row[lost][a]
                rows.append(
                    {
                        "part": int(doc[n]) % parts,
                        "docs": [doc[n]],
                        "versions": [version[n]],
                        "gone": [packed_gaps(start[lost][a:b])],
                    }
                )
            kept = np.flatnonzero(~lost)
            kept = kept[np.argsort(part[kept], kind="stable")]
            for a, b in zip(*_cut(part[kept]), strict=True):
                some = kept[a:b]
                begins, ends = _cut(row[some])
                rows.append(
                    {
                        "part": int(part[some[0]]),
                        "docs": doc[row[some[begins]]].tolist(),
                        "versions": version[row[some[begins]]].tolist(),
                        "counts": (ends - begins).tolist(),
                        "steps": np.diff(start[some], prepend=0).astype("<i4").tobytes(),
                        "h1": h1[some].astype("<u8").tobytes(),
                        "h2": h2[some].astype("<u4").tobytes(),
                    }
                )
            yield pa.RecordBatch.from_pylist(rows, schema=_CANDIDATE_SCHEMA)

    def decided(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def settle(rows: list[dict]) -> pa.RecordBatch:
            out = [(r["docs"][0], r["versions"][0], r["gone"][0]) for r in rows if r["gone"] is not None]
            rows = [r for r in rows if r["gone"] is None]
            if rows:
                counts = np.concatenate([r["counts"] for r in rows])
                doc = np.repeat(np.concatenate([r["docs"] for r in rows]), counts)
                version = np.repeat(np.concatenate([r["versions"] for r in rows]), counts)
                start = np.concatenate([np.cumsum(np.frombuffer(r["steps"], "<i4"), dtype=np.int32) for r in rows])
                h1 = np.concatenate([np.frombuffer(r["h1"], "<u8") for r in rows])
                h2 = np.concatenate([np.frombuffer(r["h2"], "<u4") for r in rows])
                lost = np.flatnonzero(_losers(h1, h2, doc, start))
                lost = lost[np.lexsort((start[lost], version[lost], doc[lost]))]
                group = np.cumsum((np.diff(doc[lost], prepend=0) != 0) | (np.diff(version[lost], prepend=0) != 0))
                for a, b in zip(*_cut(group), strict=True):
                    first = lost[a]
                    out.append((doc[first], version[first], packed_gaps(np.unique(start[lost[a:b]]))))
            columns = zip(*out, strict=True) if out else ([], [], [])
            kinds = (pa.int64(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc", "version", "gone"]
            )

        rows: list[dict] = []
        for batch in batches:
            for n in range(batch.num_rows):
                row = {name: batch.column(k)[n].as_py() for k, name in enumerate(batch.schema.names)}
                if rows and rows[-1]["part"] != row["part"]:
                    yield settle(rows)
                    rows = []
                rows.append(row)
        if rows:
            yield settle(rows)

    found = texts.select("doc", "version", "text").mapInArrow(candidates, CANDIDATES)
    return found.repartition("part").sortWithinPartitions("part").mapInArrow(decided, REMOVALS)


_CANDIDATE_SCHEMA = pa.schema(
    [
        ("part", pa.int32()),
        ("docs", pa.list_(pa.int64())),
        ("versions", pa.list_(pa.int64())),
        ("counts", pa.list_(pa.int32())),
        ("steps", pa.binary()),
        ("h1", pa.binary()),
        ("h2", pa.binary()),
        ("gone", pa.list_(pa.binary())),
    ]
)


def merged_sketch(texts: DataFrame, window: int, sketch_log2: int) -> bytes:
    """The merged sketch, one bit per counter: `2 ** sketch_log2 / 8` bytes whatever the input."""
    block_log2 = min(BLOCK_LOG2, sketch_log2)
    table = bytearray(2**sketch_log2 // 8)
    for block, bits in stored(repeated_counters(texts, window, sketch_log2), "sketch").toLocalIterator():
        at = block << block_log2 >> 3
        table[at : at + len(bits)] = bits
    return bytes(table)


def removed_windows(docs: DataFrame, window: int = WINDOW, sketch_log2: int = SKETCH_LOG2) -> DataFrame:
    """(doc, version, lists): packed starts of the documents that lose words."""
    ship_package(docs.sparkSession)
    texts = docs.select(order_id().alias("doc"), F.xxhash64(text_of()).alias("version"), text_of().alias("text"))
    sketch = merged_sketch(texts, window, sketch_log2)
    removals = _removals(texts, sketch, window, sketch_log2)
    return removals.groupBy("doc", "version").agg(F.collect_list("gone").alias("lists"))


def without_windows(text: str, starts: np.ndarray, window: int) -> tuple[int, int, str]:
    """Number of words, number of removed ones, and the kept ones joined by one space."""
    words = text.encode("utf-8", "surrogatepass").split()
    if not len(starts):
        return len(words), 0, b" ".join(words).decode("utf-8", "surrogatepass")
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + window, -1)
    kept = np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()
    return len(words), len(words) - len(kept), b" ".join([words[i] for i in kept]).decode("utf-8", "surrogatepass")


def remove_repeated_substrings(
    docs: DataFrame, window: int = WINDOW, sketch_log2: int = SKETCH_LOG2
) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text) per row of `docs`."""

    ship_package(docs.sparkSession)

    @F.pandas_udf("n_words bigint, n_removed bigint, kept_text string")
    def cut(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, lists in batches:
            rows = []
            for text, packed in zip(texts, lists, strict=True):
                starts = [unpacked_gaps(p) for p in packed] if packed is not None else []
                rows.append(without_windows(text, np.concatenate(starts) if starts else np.zeros(0, np.int64), window))
            yield pd.DataFrame(rows, columns=["n_words", "n_removed", "kept_text"])

    named = docs.select(
        "doc_id", order_id().alias("doc"), F.xxhash64(text_of()).alias("version"), text_of().alias("text")
    )
    joined = named.join(removed_windows(docs, window, sketch_log2), ["doc", "version"], "left")
    return joined.select("doc_id", cut("text", "lists").alias("c")).select("doc_id", "c.*")
