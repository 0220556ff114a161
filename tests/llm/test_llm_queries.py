"""Every query of the subpackage over the test tables, against its SQL or a plain Python version."""

import hashlib
import os
import re

import brute
import pytest
from compare import connect, rows_of_spark, rows_of_sql

import corpus_pipeline
from test_llm_whole import leak_tables
from rankmill.llm import decontam, pii, simhash
from rankmill.llm.common import documents
from rankmill.llm.oracles import ORACLES
from rankmill.llm.queries import QUERIES

from conftest import plan_of

NATIVE = ("op1_line_dedup", "op3_pii", "op9_quality_rules")


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return [(r.doc_id, r.text) for r in documents(spark, sf_dir).select("doc_id", "text").collect()]


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, con, sf_dir, name):
    columns, rows = rows_of_spark(QUERIES[name](spark, sf_dir))
    sql_columns, sql_rows = rows_of_sql(con, ORACLES[name])
    assert columns == sql_columns
    assert rows and rows == sql_rows


@pytest.mark.parametrize("name", NATIVE)
def test_native_plans_have_no_python(spark, sf_dir, name):
    assert not re.search("Python|Pandas|Arrow", plan_of(QUERIES[name](spark, sf_dir)))


def test_pii_base_spans(spark, sf_dir, docs):
    texts = dict(docs)
    for r in QUERIES["op3_pii"](spark, sf_dir).collect():
        expected = brute.personal_spans(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(expected).encode()).hexdigest()
        assert set(expected) <= set(r.spans.split(",")) | {""}
        assert r.n_email == sum(s.startswith("email") for s in expected)


def test_simhash_groups(spark, sf_dir, docs):
    prints, groups = brute.simhash_groups(docs)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op10_simhash"](spark, sf_dir).collect()}
    assert got == {i: (f"{prints[i]:016x}", groups[i]) for i in prints}
    assert any(groups[i] != i for i in groups)


def test_first_copies_equal_brute_force(spark, sf_dir, docs):
    _, groups = brute.simhash_groups(docs)
    got = sorted(r.doc_id for r in simhash.keep_first_copies(documents(spark, sf_dir)).collect())
    assert got == sorted(set(groups.values())) and len(got) < len(docs)


def test_leaks(spark, sf_dir, docs):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    got = {(r.doc_id, r.item_id) for r in QUERIES["op7_decontamination"](spark, sf_dir).filter("leaked").collect()}
    assert got and got == brute.leaks(docs, items)


def test_pipeline(spark, sf_dir):
    rows = documents(spark, sf_dir).collect()
    source = {r.doc_id: r.source for r in rows}
    kept = [(r.doc_id, brute.cleaned(r.text)) for r in rows]
    kept = sorted(brute.without_repeated_lines([(i, t) for i, t in kept if t is not None]).items())
    _, first = brute.simhash_groups(kept)
    kept = [(i, t) for i, t in kept if first[i] == i]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    leaked = {i for i, _ in brute.leaks(kept, items)}
    kept = [(i, source[i], t) for i, t in kept if i not in leaked]
    taken, target, of = brute.mix(kept)
    expected = {(i, t, taken[i]) for i, _, t in kept if taken[i]}
    result = corpus_pipeline.run(spark, sf_dir)
    assert {(r.doc_id, r.text, r.taken) for r in result.collect()} == expected
    assert {r.source: r.target for r in result.select("source", "target").distinct().collect()} == pytest.approx(
        {s: target[s] for _, s, _ in kept if target[s]}
    )


def test_stages_keep_the_columns_of_documents(spark, sf_dir):
    docs = documents(spark, sf_dir)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf_dir).columns == docs.columns


def test_held_out_precision(spark):
    model = pii.train(spark, 3000)
    for kind in pii.KINDS:
        right, found, there = model.held_out[kind]
        assert found and right >= pii.PRECISION * found and right >= 0.9 * there


def test_benchmark_in_slices(spark, sf_dir, monkeypatch):
    """All pairs, leaked or not, with their scores: one slice or many."""

    def pairs(docs, items):
        rows = decontam.find_leaks(docs, items).collect()
        return sorted((r.doc_id, r.item_id, round(r.score, 9), r.question_overlap, r.answer_overlap or 0, r.leaked) for r in rows)

    _, _, made, parts = leak_tables(spark)
    for docs, items, kb in ((documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), 2), (made, parts, 1)):
        monkeypatch.setattr(decontam, "INDEX_MB", 64)
        whole = pairs(docs, items)
        assert any(p[-1] for p in whole)
        monkeypatch.setattr(decontam, "INDEX_MB", kb / 1024)
        assert pairs(docs, items) == whole
    assert any(not p[-1] for p in whole)  # the last table also has pairs that did not leak


def test_registered():
    import __spark_entry__

    assert set(QUERIES) | {"pipeline"} <= set(__spark_entry__.queries())
    assert os.path.basename(corpus_pipeline.__file__) == "corpus_pipeline.py"
