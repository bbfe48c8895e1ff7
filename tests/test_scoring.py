from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

import quillgraph as qg
from quillgraph.functions import text as tx
from quillgraph.functions import utf8
from quillgraph.operators import scoring
from tests import model
from tests.plans import executed_plan

ODD = [
    "a\x01 a a! a!] b. c d e f g. a b c d e f g",
    "x!] x! x x. \x0bx y.\x0bz z",
    "...",
    " ",
    "",
    None,
    ". . ",
    "Cat cat. CAT, dog.\ncat É!]  Σ!] ΑΣ. İx]K]",
    "é ee e.  a b. a",
    "w" * 200 + " w. w. " + "w" * 200,
    "it\x0bs it. s it\x0b. its",
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(list(enumerate(ODD)), "doc_id bigint, text string").repartition(3)


def rows(df):
    return sorted(map(repr, df.collect()))


def by_joins(df):
    """The same rows in a frame that has no note of what it was made from."""
    return df.select("*")


def test_rules_on_bytes_are_those_on_columns(odd):
    text = F.col("text")
    lax = tx.reduced(text, compat=True)
    got = odd.filter("text is not null").select("text", lax.alias("lax"), tx.unigrams(text).alias("strict"), tx.unigrams(text, compat=True).alias("loose"), tx.sentences(text).alias("pieces"))
    for r in got.collect():
        assert [x.decode() for x in utf8.strict_words(r.text.encode())] == [x for x in r.strict if x]
        assert [x.decode() for x in utf8.lax_words(r.lax.encode())] == [x for x in r.loose if x]
        assert [x.decode() for x in utf8.sentence_list(r.text.encode())] == r.pieces


@pytest.mark.parametrize("listed", [0, 3, 10**6])
@pytest.mark.parametrize("compat", [False, True])
def test_scores_in_the_record_are_those_of_joins(odd, compat, listed):
    sentences, weights = qg.split_sentences(odd), qg.tf_idf(odd, compat, hot_keys=listed)
    for n in (1, 2, 5):
        scores = qg.score_sentences(sentences, weights, n)
        joined = qg.score_sentences(by_joins(sentences), by_joins(weights), n)
        assert rows(scores) == rows(joined)
        assert rows(qg.attach_scores(sentences, scores)) == rows(qg.attach_scores(sentences, joined))


@pytest.mark.parametrize("compat", [False, True])
def test_words_of_unique_ids_are_not_shuffled(odd, compat):
    sentences = qg.split_sentences(odd)
    scores = qg.score_sentences(sentences, qg.tf_idf(odd, compat))
    for made in (scores, qg.attach_scores(sentences, scores)):
        assert not [line for line in executed_plan(made).splitlines() if "hashpartitioning" in line]
    summary = executed_plan(qg.summarize(odd, compat=compat))
    assert "unigram" not in summary


def test_given_weights_meet_their_document_packed(spark, odd):
    given = [(0, "a", 2.0), (0, "a", 2.0), (0, "b", 2.0), (0, "c", None), (0, "!", 9.0), (7, "cat", math.nan), (None, "a", 1.0), (0, None, 1.0), (1, "y", -1.0), (99, "a", 1.0)]
    given += [(0, x, 1.0) for x in "cdefg"]
    weights = spark.createDataFrame(given, "doc_id bigint, unigram string, tfidf double")
    sentences = qg.split_sentences(odd)
    for n in (1, 2, 5):
        scores = qg.score_sentences(sentences, weights, n)
        assert rows(scores) == rows(qg.score_sentences(by_joins(sentences), weights, n))
    assert not [line for line in executed_plan(scores).splitlines() if "Exchange" in line and "unigram" in line]


@pytest.mark.parametrize("more", [(None, "a b. c"), (0, "a z. c"), (0, ""), (4, "a. b")])
def test_ids_that_are_missing_or_repeat_take_the_joins(spark, odd, more):
    df = odd.unionByName(spark.createDataFrame([more], "doc_id bigint, text string"))
    sentences, weights = qg.split_sentences(df), qg.tf_idf(df)
    scores = qg.score_sentences(sentences, weights)
    assert scoring.note_of(scores, scoring.Scores) is None
    assert rows(scores) == rows(qg.score_sentences(by_joins(sentences), by_joins(weights)))
    texts: dict[int, str] = {}
    for doc, text in [*enumerate(ODD), more]:
        if doc is not None and text:
            texts[doc] = max(text, texts.get(doc, ""))
    expected = model.tf_idf([(d, t) for d, t in [*enumerate(ODD), more] if d is not None and t])
    got = {r.doc_id: r.summary for r in qg.summarize(df).collect()}
    assert got == {d: model.summary(t, {u: w for (i, u), w in expected.items() if i == d}) for d, t in texts.items()}


def test_weights_of_other_articles_are_not_made_in_the_record(spark, odd):
    other = spark.createDataFrame([(0, "a a b"), (1, "x")], "doc_id bigint, text string")
    sentences, weights = qg.split_sentences(odd), qg.tf_idf(other)
    assert rows(qg.score_sentences(sentences, weights)) == rows(qg.score_sentences(by_joins(sentences), by_joins(weights)))


def test_words_counted_in_parts_are_added_up(odd, monkeypatch):
    from quillgraph.operators import records

    before = rows(records.own_doc_freq(records.records(odd).rows))
    monkeypatch.setattr(records, "COUNTED_WORDS", 2)
    assert rows(records.own_doc_freq(records.records(odd).rows)) == before
