"""Hard negatives by exact inner-product search with length buckets and coordinate pruning.

The searched vectors are sorted by length and cut into buckets. A bucket keeps, for every coordinate,
the list of its rows in the order of that coordinate of the direction (the vector over its length).
For an anchor and a least score the longest vector of a bucket gives the least cosine a row must
reach. No row can reach it if that is above one; otherwise each focus coordinate of the anchor, one of
the largest of its direction, has a range of values a row must lie in, found by two binary searches.
Rows inside all ranges are the candidates, and each is verified by its exact inner product. Buckets are
visited from the longest vectors on, and the least score rises with what is found.

Anchors and buckets meet in groups: every group holds some anchors and a bounded number of buckets, so
no task holds a label, a source or the table. The work is that of a stated query set against all rows.

* Rows with a null id, label, vector or component, or a component that is not finite, take no part.
* An id is one row: of rows that repeat it, the one with the smallest label, then vector, counts.
* Vectors of unequal size are compared over the coordinates they share. An empty vector scores 0.
* Equal scores are ordered by id. Scores are exact integers; beyond a long they count as its limits.
* An anchor without another row of its label, or whose positives score below zero, has no result.
  Empty tables give an empty result.
* Only the three columns named are read, so other columns cannot clash.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankmill.llm.common import ship_package, stored

BUCKET_ROWS = 4096
BUCKETS_PER_TASK = 4
ANCHORS_PER_TASK = 1024
FOCUS = 5  # coordinates of an anchor whose lists are searched
CHUNK = 256  # anchors whose scores against a bucket are held at once
SLACK = 1e-6  # against rounding of the ranges: candidates are verified, so it costs time only
LONG = np.iinfo(np.int64)

FOUND = "anchor_id long, other_id long, score long"


def _least_type(values: np.ndarray) -> np.ndarray:
    for kind in (np.int16, np.int32):
        limits = np.iinfo(kind)
        if not values.size or (values.min() >= limits.min and values.max() <= limits.max):
            return values.astype(kind)
    return values


def _matrix(lists: pa.Array) -> np.ndarray:
    """One row per list, short ones filled with zeros."""
    sizes = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(sizes), int(sizes.max(initial=0))), dtype=np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = flat
    return out


def _lengths(matrix: np.ndarray) -> np.ndarray:
    return np.sqrt(np.square(matrix.astype(np.float64)).sum(axis=1))


def _directions(matrix: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    return matrix / np.where(lengths > 0, lengths, 1.0)[:, None]


class Bucket:
    """Vectors of similar length, in the order of their ids, with one sorted list per coordinate."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.labels = ids[order], labels[order]
        self.vectors = _least_type(vectors[order])
        self.lengths = _lengths(self.vectors)
        self.longest = float(self.lengths.max(initial=0.0))
        directions = _directions(self.vectors, self.lengths)
        self.lists = np.argsort(directions, axis=0, kind="stable").astype(np.uint16)

    def _ranges(self, directions: np.ndarray, cosines: np.ndarray) -> Iterator[tuple[int, np.ndarray | None]]:
        """Each anchor with its candidates; None stands for every row.

        With x and q the values of a coordinate in two directions, the cosine is at most that of the
        difference of the angles arccos x and arccos q.
        """
        mine = _directions(self.vectors, self.lengths)
        angles = np.arccos(np.clip(cosines, -1.0, 1.0))
        focus = np.argsort(-np.abs(directions), axis=1, kind="stable")[:, :FOCUS]
        kept: dict[int, np.ndarray] = {}
        for coordinate in np.unique(focus):
            rows = np.flatnonzero((focus == coordinate).any(axis=1) & (cosines > 0))
            if not len(rows):
                continue
            at = np.arccos(np.clip(directions[rows, coordinate], -1.0, 1.0))
            low = np.cos(np.minimum(at + angles[rows], np.pi)) - SLACK
            high = np.cos(np.maximum(at - angles[rows], 0.0)) + SLACK
            listed = self.lists[:, coordinate]
            values = mine[listed, coordinate]
            starts, ends = np.searchsorted(values, low, "left"), np.searchsorted(values, high, "right")
            for row, start, end in zip(rows, starts, ends, strict=True):
                if end - start < len(values):
                    inside = np.zeros(len(values), dtype=bool)
                    inside[listed[start:end]] = True
                    kept[row] = kept[row] & inside if row in kept else inside
        for row in range(len(directions)):
            yield row, np.flatnonzero(kept[row]) if row in kept else None

    def hits(self, vectors: np.ndarray, lengths: np.ndarray, least: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """(anchor, row, score) of all pairs whose score reaches the least one of its anchor."""
        shared = min(vectors.shape[1], self.vectors.shape[1])
        # An inner product over fewer coordinates is that of shorter vectors; the bounds still hold.
        reach = lengths * self.longest
        with np.errstate(divide="ignore", invalid="ignore"):
            cosines = np.where(reach > 0, least / reach, np.where(least > 0, 2.0, -1.0))
        possible = np.flatnonzero(cosines <= 1 + SLACK)
        directions = _directions(vectors, lengths)[:, : self.vectors.shape[1]]
        for at in range(0, len(possible), CHUNK):
            rows = possible[at : at + CHUNK]
            whole = []
            for n, candidates in self._ranges(directions[rows], cosines[rows]):
                if candidates is None:
                    whole.append(rows[n])
                elif len(candidates):
                    scores = _scores(vectors[rows[n : n + 1], :shared], self.vectors[candidates, :shared])[0]
                    good = scores >= least[rows[n]]
                    yield np.full(good.sum(), rows[n]), candidates[good], scores[good]
            if whole:
                whole = np.array(whole)
                scores = _scores(vectors[whole, :shared], self.vectors[:, :shared])
                n, row = np.nonzero(scores >= least[whole, None])
                yield whole[n], row, scores[n, row]


def _scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of `a` with all of `b`."""
    bound = _lengths(a).max(initial=0.0) * _lengths(b).max(initial=0.0)
    if bound < 2.0**52:  # every partial sum is an integer that a double holds exactly
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if bound < 2.0**62:
        return a.astype(np.int64) @ b.astype(np.int64).T
    exact = a.astype(object) @ b.astype(object).T
    return np.clip(exact, LONG.min, LONG.max).astype(np.int64)


def _first(keys: np.ndarray, scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the first `k` entries of each key: by falling score, then id."""
    order = np.lexsort((ids, ~scores, keys))
    sorted_keys = keys[order]
    starts = np.flatnonzero(np.diff(sorted_keys, prepend=sorted_keys[:1] - 1)) if len(order) else np.zeros(0, int)
    ranks = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
    return order[ranks < k]


def _rising(keys: np.ndarray, scores: np.ndarray, k: int, floor: np.ndarray) -> np.ndarray:
    """The least score that can still enter the first `k` of each key; `floor` while they are fewer."""
    least = floor.copy()
    full = np.flatnonzero(np.bincount(keys, minlength=len(floor)) >= k)
    if len(full):
        worst = np.full(len(floor), LONG.max)
        np.minimum.at(worst, keys, scores)
        least[full] = np.maximum(least[full], worst[full])
    return least


class Anchors:
    """The anchors of a group, as arrays."""

    def __init__(self, rows: pd.DataFrame):
        self.ids = rows["id"].to_numpy(np.int64)
        self.labels = rows["label"].to_numpy(np.int64)
        sizes = [len(v) for v in rows["vector"]]
        self.vectors = np.zeros((len(rows), max(sizes, default=0)), dtype=np.int64)
        for n, vector in enumerate(rows["vector"]):
            self.vectors[n, : sizes[n]] = vector
        self.lengths = _lengths(self.vectors)


def _buckets(rows: pd.DataFrame) -> Iterator[Bucket]:
    for payload in rows.sort_values(["longest", "bucket"], ascending=[False, True])["payload"]:
        yield pickle.loads(payload)


def best_positives(anchors: Anchors, buckets: Iterator[Bucket], k: int) -> tuple[np.ndarray, ...]:
    """(anchor, id, score) of the first `k` other rows of each anchor's label."""
    keys, ids, scores = (np.zeros(0, np.int64) for _ in range(3))
    floor = np.full(len(anchors.ids), LONG.min)
    least = floor
    for bucket in buckets:
        for at, row, score in bucket.hits(anchors.vectors, anchors.lengths, least):
            same = (bucket.labels[row] == anchors.labels[at]) & (bucket.ids[row] != anchors.ids[at])
            keys = np.concatenate([keys, at[same]])
            ids = np.concatenate([ids, bucket.ids[row[same]]])
            scores = np.concatenate([scores, score[same]])
            first = _first(keys, scores, ids, k)
            keys, ids, scores = keys[first], ids[first], scores[first]
        least = _rising(keys, scores, k, floor)
    return keys, ids, scores


def best_negatives(
    anchors: Anchors, low: np.ndarray, high: np.ndarray, buckets: Iterator[Bucket], k: int
) -> tuple[np.ndarray, ...]:
    """(anchor * positives + positive, id, score): rows of other labels with scores in each range.

    `low` and `high` have a row per anchor and a column per positive; a missing positive has an empty
    range.
    """
    n = low.shape[1]
    keys, ids, scores = (np.zeros(0, np.int64) for _ in range(3))
    floor = np.where(low <= high, low, LONG.max).ravel()
    least = floor
    for bucket in buckets:
        for at, row, score in bucket.hits(anchors.vectors, anchors.lengths, least.reshape(low.shape).min(axis=1)):
            other = bucket.labels[row] != anchors.labels[at]
            at, row, score = at[other], row[other], score[other]
            for p in range(n):
                fits = (score >= low[at, p]) & (score <= high[at, p])
                keys = np.concatenate([keys, at[fits] * n + p])
                ids = np.concatenate([ids, bucket.ids[row[fits]]])
                scores = np.concatenate([scores, score[fits]])
            first = _first(keys, scores, ids, k)
            keys, ids, scores = keys[first], ids[first], scores[first]
        least = _rising(keys, scores, k, floor)
    return keys, ids, scores


def index_of(vectors: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(bucket, longest, payload): buckets of (id, label, vector) rows from the longest vectors on."""

    def bucketed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(rows: pa.Table) -> pa.RecordBatch:
            column = rows.column("vector").combine_chunks()
            bucket = Bucket(rows.column("id").to_numpy(), rows.column("label").to_numpy(), _matrix(column))
            arrays = [pa.array([bucket.longest]), pa.array([pickle.dumps(bucket)], pa.binary())]
            return pa.RecordBatch.from_arrays(arrays, ["longest", "payload"])

        held: list[pa.RecordBatch] = []
        count = 0
        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, bucket_rows - count)
                batch = batch.slice(part.num_rows)
                held.append(part)
                count += part.num_rows
                if count == bucket_rows:
                    yield packed(pa.Table.from_batches(held))
                    held, count = [], 0
        if count:
            yield packed(pa.Table.from_batches(held))

    length = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    partitions = max(1, math.ceil(vectors.count() / (4 * bucket_rows)))
    return (
        vectors.withColumn("length", length)
        .repartitionByRange(partitions, F.desc("length"), "id")
        .sortWithinPartitions(F.desc("length"), "id")
        .select("id", "label", "vector")
        .mapInArrow(bucketed, "longest double, payload binary")
        .select(F.monotonically_increasing_id().alias("bucket"), "longest", "payload")
    )


def _meet(anchors: DataFrame, index: DataFrame, buckets: int, groups: int, search, schema: str) -> DataFrame:
    """Every anchor with every bucket: a group of anchors and a lane of buckets at a time."""
    lanes = max(1, math.ceil(buckets / BUCKETS_PER_TASK))
    searched = index.withColumn("lane", F.pmod(F.xxhash64("bucket"), F.lit(lanes))).withColumn(
        "team", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long")))
    )
    asked = anchors.withColumn("team", F.pmod(F.xxhash64("id"), F.lit(groups))).withColumn(
        "lane", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(lanes - 1).cast("long")))
    )
    return asked.groupBy("team", "lane").cogroup(searched.groupBy("team", "lane")).applyInPandas(search, schema)


def mine_hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 5,
    low_percent: int = 80,
    high_percent: int = 100,
    bucket_rows: int = BUCKET_ROWS,
    anchors_per_task: int = ANCHORS_PER_TASK,
) -> DataFrame:
    """Hard negatives of (id, label, vector) rows with integer components, for each anchor and positive.

    An anchor's positives are its best other rows of the same label; the negatives of a positive are the
    best rows of other labels that score between the two percentages of the positive's score.
    Returns (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).
    """
    ship_package(vectors.sparkSession)
    whole = F.forall("vector", lambda x: x.isNotNull())
    rows = (
        vectors.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.coalesce(whole, F.lit(False)))
        .select(F.col("id").cast("long"), F.struct(F.col("label").cast("long").alias("label"), "vector").alias("r"))
        .groupBy("id")
        .agg(F.min("r").alias("r"))
        .select("id", "r.label", "r.vector")
    )
    rows = stored(rows, "hard-negative-vectors")
    index = stored(index_of(rows, bucket_rows), "hard-negative-index")
    anchors = rows.where(is_anchor)
    buckets, groups = index.count(), max(1, math.ceil(anchors.count() / anchors_per_task))

    def positives_of(asked: pd.DataFrame, searched: pd.DataFrame) -> pd.DataFrame:
        mine = Anchors(asked)
        at, ids, scores = best_positives(mine, _buckets(searched), positives)
        return pd.DataFrame({"anchor_id": mine.ids[at], "other_id": ids, "score": scores})

    found = _meet(anchors, index, buckets, groups, positives_of, FOUND)
    best = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "other_id")
    chosen = stored(
        found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= positives), "hard-negative-positives"
    )

    def negatives_of(asked: pd.DataFrame, searched: pd.DataFrame) -> pd.DataFrame:
        mine = Anchors(asked)
        low, high = (np.full((len(asked), positives), fill) for fill in (LONG.max, LONG.min))
        for n, scores in enumerate(asked["scores"]):
            scores = np.asarray(scores, dtype=np.int64)
            whole, rest = scores // 100, scores % 100
            low[n, : len(scores)] = whole * low_percent - (-rest * low_percent) // 100
            high[n, : len(scores)] = whole * high_percent + rest * high_percent // 100
        keys, ids, scores = best_negatives(mine, low, high, _buckets(searched), negatives)
        at = keys // positives
        return pd.DataFrame(
            {"anchor_id": mine.ids[at], "place": (keys % positives + 1).astype(np.int32), "other_id": ids, "score": scores}
        )

    # no more than `positives` entries per anchor
    scored = chosen.groupBy(F.col("anchor_id").alias("id")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rank", "score"))), lambda s: s["score"]).alias("scores")
    )
    hard = _meet(anchors.join(scored, "id"), index, buckets, groups, negatives_of, f"{FOUND}, place int")
    order = Window.partitionBy("anchor_id", "place").orderBy(F.desc("score"), "other_id")
    ranked = hard.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    named = chosen.select("anchor_id", F.col("rank").alias("place"), F.col("other_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return ranked.join(named, ["anchor_id", "place"]).select(
        "anchor_id",
        "positive_id",
        F.col("rank").cast("int").alias("rank"),
        F.col("other_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )


def scaled_vectors(embeddings: DataFrame, scale: int = 256) -> DataFrame:
    """(id, label, vector) with components floor(scale * x); rows that are not whole are left out."""
    finite = F.forall("embedding", lambda x: F.coalesce(x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    return embeddings.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(finite, F.lit(False))).select(
        F.col("vec_id").cast("long").alias("id"),
        F.col("label").cast("long").alias("label"),
        F.transform("embedding", lambda x: F.floor(x.cast("double") * scale)).alias("vector"),
    )


def moved_labels(vectors: DataFrame, every: int = 7, labels: int = 10) -> DataFrame:
    """Each id that `every` divides gets the next label, so that near rows differ in label."""
    label = F.when(F.col("id") % every == 0, (F.col("label") + 1) % labels).otherwise(F.col("label"))
    return vectors.withColumn("label", label)
