from __future__ import annotations

import pytest

import quillgraph as qg
from quillgraph.operators.records import own_counts
from tests import model
from tests.plans import executed_plan

ODD = ["a\x01 a a! a!] b", "x!] x! x x", "...", " ", "", None, "Cat cat. CAT, dog", "é ee e", "w" * 200 + " w", "w" * 200, "it\x0bs it. s"]
ROWS = [(i, text) for i, text in enumerate(ODD)] + [(None, "cat dog")]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ROWS, "doc_id bigint, text string").repartition(3)


@pytest.mark.parametrize("listed", [0, 3, 10**6])
@pytest.mark.parametrize("compat", [False, True])
def test_weights_of_unique_ids_follow_the_rule(odd, compat, listed):
    expected = model.tf_idf([(i, text) for i, text in ROWS if i is not None and text], compat)
    got = {(r.doc_id, r.unigram): r.tfidf for r in qg.tf_idf(odd, compat, hot_keys=listed).collect()}
    assert got == pytest.approx(expected)


@pytest.mark.parametrize("compat", [False, True])
def test_terms_of_unique_ids_are_not_shuffled(odd, compat):
    weights = executed_plan(qg.tf_idf(odd, compat))
    assert "hashpartitioning(doc_id" not in weights
    freq = qg.article_tf(odd, compat)
    assert "hashpartitioning" not in executed_plan(freq)
    known = odd.filter("doc_id is not null")
    assert sorted(map(tuple, freq.collect())) == sorted(map(tuple, qg.term_freq(qg.tokenize(known, compat=compat)).collect()))


def test_counts_keep_records_without_an_id(spark, odd):
    for df in (odd, odd.unionByName(odd)):
        assert sorted(map(str, qg.article_counts(df).collect())) == sorted(map(str, qg.term_counts(qg.tokenize(df)).collect()))
    assert own_counts(odd.limit(0)).isEmpty()
