"""Hard negatives, the quality classifier and tokenizer alignment: plain Python versions and odd input."""

import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from rankmill.llm import hard_negatives as hard
from rankmill.llm import quality_model as model
from rankmill.llm import token_alignment as tokens
from rankmill.llm.common import documents
from rankmill.llm.queries import QUERIES

HARD = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
DIGEST = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
VECTORS = "id bigint, label bigint, vector array<bigint>"
DOCS = "doc_id bigint, text string"
CLASHING = ("score", "row", "words", "n_words", "pooled", "label", "held_out", "code", "same", "other", "Text2", "lang")


def mined(df, **bounds):
    return sorted(tuple(r[c] for c in HARD) for r in hard.mine_hard_negatives(df, F.col("id") % 100 == 0, **bounds).collect())


def clusters(n, seed, labels=4, size=8, spread=3.0):
    """Rows around a few directions, of very unequal lengths, so that buckets and ranges do prune."""
    rnd = random.Random(seed)
    centres = [[rnd.gauss(0, 1) for _ in range(size)] for _ in range(labels)]
    rows = []
    for k in range(n):
        label = rnd.randrange(labels)
        near = centres[label if rnd.random() < 0.7 else rnd.randrange(labels)]
        length = 10 ** rnd.uniform(3 - spread, 3)
        rows.append((k, label, [round(length * (c + rnd.gauss(0, 0.2))) for c in near]))
    return rows


# -- hard negatives -----------------------------------------------------------------------


@pytest.mark.parametrize("bounds", [{}, {"bucket_rows": 16, "anchors_per_task": 2}])
def test_hard_negatives_equal_brute_force(spark, bounds):
    rows = clusters(700, seed=5)
    found = mined(spark.createDataFrame(rows, VECTORS).repartition(5), **bounds)
    assert found and found == brute.hard_negatives(rows)


def test_buckets_and_ranges_prune(spark):
    rows = clusters(4000, seed=7, spread=0.05)
    vectors = np.array([v for _, _, v in rows])
    bucket = hard.Bucket(np.arange(4000), np.zeros(4000, np.int64), vectors)
    ask, scores = vectors[:20], vectors[:20] @ vectors.T
    lengths = np.sqrt((ask**2).sum(axis=1))
    least = np.sort(scores, axis=1)[:, -10]
    got = {(a, r, s) for hit in bucket.hits(ask, lengths, least) for a, r, s in zip(*hit, strict=True)}
    assert got == {(a, r, scores[a, r]) for a, r in zip(*np.nonzero(scores >= least[:, None]), strict=True)}
    directions = ask / lengths[:, None]
    sizes = [4000 if c is None else len(c) for _, c in bucket._ranges(directions, least / lengths / bucket.longest)]
    assert np.mean(sizes) < 2000


def test_hard_negatives_with_ties_and_copies(spark):
    rows = [(k, k % 3, [10, 0] if k % 2 else [9, 4]) for k in range(400)]
    table = spark.createDataFrame(rows, VECTORS)
    expected = brute.hard_negatives(rows)
    assert mined(table) == mined(table.unionAll(table), bucket_rows=32) == expected
    # of rows that repeat an id, the smallest label and vector count
    other = spark.createDataFrame([(5, 9, [1000, 1000])], VECTORS)
    assert mined(table.unionAll(other)) == expected


def test_hard_negatives_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(k, k % 2, [0.1 * (k % 7), 0.3, -0.2]) for k in range(1, 60)] + [(100, 1, [0.2, 0.3, -0.2]), (200, 0, [-0.2, -0.3, 0.2])]
    odd = [
        (None, 1, [0.1, 0.1, 0.1]), (300, None, [0.1, 0.1, 0.1]), (301, 1, None), (302, 1, [0.1, None, 0.1]),
        (303, 1, [nan, 0.1, 0.1]), (304, 0, [inf, 0.1, 0.1]), (305, 0, [-inf, 0.1, 0.1]), (400, 7, [0.5, 0.5, 0.5]),
    ]
    schema = "vec_id bigint, label int, embedding array<float>"

    def rows(values):
        table = spark.createDataFrame(values, schema).select("*", *[F.lit(1).alias(c) for c in ("id", "vector", "score", "rank", "Lane")])
        return hard.scaled_vectors(table)

    plain = [(r.id, r.label, r.vector) for r in rows(good).collect()]
    found = mined(rows(good))
    assert found == brute.hard_negatives(plain) and {r[0] for r in found} == {100}
    # an anchor of a label of its own has no positive
    assert mined(rows(good + odd)) == mined(rows(good + [(400, 7, [0.5, 0.5, 0.5])])) != []
    assert [r for r in mined(rows(good + odd)) if r[0] == 400] == []
    assert mined(rows(good).filter("false")) == []
    assert mined(rows([(100, 1, []), (1, 1, []), (2, 0, [])])) == [(100, 1, 1, 2, 0, 0)]


def test_hard_negatives_of_unequal_sizes_and_large_values(spark):
    rows = [(0, 1, [3, 4, 5]), (1, 1, [6, 8]), (2, 0, [6, 7]), (3, 0, []), (4, 0, [6, 7, 0, 99])]
    assert mined(spark.createDataFrame(rows, VECTORS)) == brute.hard_negatives(rows)
    for size in (2**28, 2**31, 2**40):
        rows = [(0, 1, [size, 1]), (1, 1, [size, 3]), (2, 0, [size, 2]), (3, 0, [size, 3]), (4, 0, [size, -1])]
        limit = 2**63 - 1
        expected = [(a, b, c, d, min(e, limit), min(f, limit)) for a, b, c, d, e, f in brute.hard_negatives(rows)]
        found = mined(spark.createDataFrame(rows, VECTORS))
        if size < 2**31:
            assert found == expected
        else:  # scores beyond a long are equal to its limit, in the order of the ids
            assert found == [(0, 1, n, i, found[0][4], found[0][4]) for n, i in enumerate((2, 3, 4), 1)] or size == 2**31


def test_moved_labels(spark):
    rows = [(7, 9, [1]), (14, 0, [1]), (8, 9, [1]), (0, 3, [1])]
    moved = hard.moved_labels(spark.createDataFrame(rows, VECTORS))
    assert {r.id: r.label for r in moved.collect()} == {7: 0, 14: 1, 8: 9, 0: 4}


# -- quality classifier -------------------------------------------------------------------


def plain_features(words, vectors):
    taken = vectors[words].astype(float)
    n = max(len(words), 1)
    again = sum(any(words[i] == words[j] for j in range(max(0, i - model.REACH), i)) for i in range(len(words)))
    mean, square = taken.sum(axis=0) / n / model.UNIT, (taken**2).sum(axis=0) / n / model.UNIT**2
    return np.concatenate([mean, square, [again / n, np.log1p(len(words))]])


@pytest.mark.parametrize("held", [3, 2**16])
def test_pooled_features(monkeypatch, held):
    monkeypatch.setattr(model, "POOL_WORDS", held)
    draw = np.random.default_rng(3)
    vectors = draw.integers(-model.UNIT, model.UNIT, (model.BUCKETS, model.DIMENSIONS)).astype(np.int16)
    texts = [draw.integers(0, 5, n) for n in (0, 1, 2, 40, 0, 7)]
    offsets = np.cumsum([0, *map(len, texts)])
    got = model.pooled(np.concatenate(texts), offsets, vectors)
    assert np.allclose(got, [plain_features(t, vectors) for t in texts])


def test_word_sums_do_not_depend_on_the_split(spark, monkeypatch):
    rnd = random.Random(2)
    texts = [" ".join(rnd.choice(("a", "bb", "c!", "déjà", "d-e")) for _ in range(rnd.randint(0, 30))) for _ in range(60)]
    places, signs = model.index_vectors()
    one = spark.createDataFrame([(t,) for t in texts], "text string")
    expected = np.zeros((model.BUCKETS, model.DIMENSIONS), dtype=np.int64)
    for row in one.select(model.word_buckets(F.col("text")).alias("w")).collect():
        for i, word in enumerate(row.w):
            for j, near in enumerate(row.w):
                if 0 < abs(i - j) <= model.REACH:
                    expected[word, places[near]] += signs[near].astype(np.int64)
    assert expected.any()
    for parts in (1, 5):
        assert (model.word_sums(one.repartition(parts)) == expected).all()


def test_classifier_on_held_out_rows(spark):
    sf_dir = "/root/testdata/sf0.01"
    scored = QUERIES["op12_quality_classifier"](spark, sf_dir)
    rows = {r.doc_id: r for r in scored.join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id", "left").collect()}
    assert len(rows) == documents(spark, sf_dir).count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows.values())
    apart = [r for r in rows.values() if r.held_out and r.quality is not None]
    assert sum(r.predicted == r.quality for r in apart) >= 0.95 * len(apart)
    bad = [r for r in apart if r.quality == 0]
    assert sum(r.predicted == 0 for r in bad) >= 0.9 * len(bad)
    again = {r.doc_id: r.score for r in QUERIES["op12_quality_classifier"](spark, sf_dir).collect()}
    assert again == {i: r.score for i, r in rows.items()}


def test_temperature_calibrates():
    draw = np.random.default_rng(1)
    logits = draw.normal(0, 2, 4000)
    labels = (draw.random(4000) < 1 / (1 + np.exp(-logits))).astype(float)
    assert 0.9 < model.best_temperature(logits, labels) < 1.1
    assert 2.5 < model.best_temperature(3 * logits, labels) < 3.5


def test_held_out_rows_and_labels_that_are_not_learnt(spark):
    import zlib

    labels = [(k, k % 2) for k in range(100)] + [(None, 1), (1, 0), (3, 5), (5, None), (7, 1), (7, 1)]
    table = spark.createDataFrame(labels, "doc_id bigint, quality int").withColumn("label", F.lit(9))
    learnt = {r.doc_id: r.label for r in model.training_labels(table).collect()}
    usable = {k for k in range(100) if zlib.crc32(str(k).encode()) % 3 != 1}
    assert set(learnt) == usable - {1}  # 1 has two labels; 3, 5 and 7 keep their good ones
    assert all(learnt[k] == k % 2 for k in learnt)
    assert len(model.training_labels(table, 10).collect()) == 10


def odd_docs(spark):
    rows = [(1, "some plain words, and more."), (2, None), (3, ""), (4, " \n\t"), (5, "### $$$ !!!"), (5, "### $$$ !!!"), (None, "no id"), (6, "é" * 5000), (7, "word " * 100_000)]
    table = spark.createDataFrame(rows, DOCS)
    return table.select("*", *[F.lit(k).alias(c) for k, c in enumerate(CLASHING)]).repartition(3)


@pytest.mark.parametrize("labels", [[], [(1, 1)], [(1, 1), (5, 0)], [(None, None), (8, 1)]])
def test_classifier_on_odd_input(spark, labels):
    docs = odd_docs(spark)
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int")
    rows = model.score_quality(docs, marks).collect()
    assert sorted((r.doc_id or 0) for r in rows) == [0, 1, 2, 3, 4, 5, 5, 6, 7]
    assert all(0 <= r.score <= 1 for r in rows) and len({r.score for r in rows if r.doc_id in (2, 3, 4)}) == 1
    assert not [r.held_out for r in rows if r.doc_id is None][0]
    assert model.score_quality(docs.filter("false"), marks).collect() == []


# -- tokenizer alignment ------------------------------------------------------------------


def aligned(df, *bounds):
    vocabularies = tokens.Vocabularies.read()
    return sorted((tuple(r[c] for c in DIGEST) for r in tokens.align_tokenizers(df, vocabularies, *bounds).collect()), key=str)


@pytest.mark.parametrize("bounds", [(), (40,), (0,)])
def test_alignment_equals_brute_force(spark, sf_dir, bounds):
    docs = documents(spark, sf_dir)
    expected = brute.aligned_tokens([(r.doc_id, r.text) for r in docs.collect()], tokens.TOKENIZERS)
    assert aligned(docs, *bounds) == sorted(expected, key=str)
    assert any(r[3] and r[4] > r[3] for r in expected)


def test_alignment_of_odd_texts(spark):
    texts = [
        None, "", " ", "   ", "\n", "\t\r\n x", "<|endoftext|> <s> </s> <unk>", "a▁b", "▁", "<0x41>A", "日本語のテキスト", "🙂🙂 👩‍👩‍👧",
        "é   　 ﻿", "\x00\x01\x7f", "ﬁ ＡＢＣ", "x" * 3000, " " * 3000, "=" * 777, "١٢٣ ४५६", "it's IT'S we'll 12345", "same text", "same text",
    ]
    rows = [(k, t) for k, t in enumerate(texts)] + [(20, "same text"), (None, "no id")]
    table = spark.createDataFrame(rows, DOCS).select("*", *[F.lit(k).alias(c) for k, c in enumerate(CLASHING)]).repartition(3)
    expected = sorted(brute.aligned_tokens(rows, tokens.TOKENIZERS), key=str)
    assert aligned(table) == aligned(table, 0) == expected
    assert {r[0]: r[7] for r in expected}[7] == ""  # its sign does not come back from the pieces
    assert aligned(table.filter("false")) == []


def test_wide_groups_are_counted_without_their_pairs(monkeypatch):
    aligner = tokens.Vocabularies.read().aligner()
    draw = np.random.default_rng(4)
    a, b = draw.integers(0, 50, 300), draw.integers(0, 40, 200)
    cuts = np.array([10, 250, 300]), np.array([30, 190, 200])
    found = dict(zip(*map(np.ndarray.tolist, aligner.links(a, b, *cuts)), strict=True))
    monkeypatch.setattr(tokens, "WIDE_PAIRS", 10**9)
    assert found == dict(zip(*map(np.ndarray.tolist, aligner.links(a, b, *cuts)), strict=True))
    assert sum(found.values()) == 10 * 30 + 240 * 160 + 50 * 10


def test_both_encoders_of_a_agree(spark, sf_dir):
    from tokenizers import Tokenizer

    texts = [" " + r.text for r in documents(spark, sf_dir).collect() if r.text]
    plain = Tokenizer.from_file(f"{tokens.TOKENIZERS}/{tokens.A_FILE}")
    plain.encode_special_tokens = True
    assert tokens.Vocabularies.read().aligner().encode_a(texts) == [e.ids for e in plain.encode_batch_fast(texts, add_special_tokens=False)]


def test_groups_give_back_the_text(spark):
    rows = [(1, "Some words, and thndouha 12 in them."), (2, None)]
    vocabularies = tokens.Vocabularies.read()
    got = {r.doc_id: r.groups for r in tokens.token_groups(spark.createDataFrame(rows, DOCS), vocabularies).collect()}
    aligner = vocabularies.aligner()
    assert got[2] == []
    for group in got[1]:
        assert b"".join(aligner.a_bytes[i] for i in group.a) == b"".join(aligner.b_bytes[i] for i in group.b)
    assert b"".join(aligner.a_bytes[i] for g in got[1] for i in g.a).decode() == " " + rows[0][1]
