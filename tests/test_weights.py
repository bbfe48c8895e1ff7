from __future__ import annotations

import math
import random
import re

import pytest
from pyspark.sql import functions as F

import quillgraph as qg
from quillgraph.operators.skew import hot_keys
from tests import model
from tests.plans import executed_plan

WORDS = "the a of ring,Bolt gear! plate? (old) x!] y-z ... cat. dog. Cat".split(" ")


def corpus(n: int, seed: int) -> list[tuple[str, str]]:
    """Articles of which a third share one id, and some repeat word for word."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        doc = "hot" if i % 3 == 0 else f"d{i}"
        rows.append((doc, " ".join(rng.choice(WORDS) for _ in range(rng.randint(1, 40)))))
    return rows + rows[:5]


@pytest.fixture(scope="module")
def articles(spark):
    rows = corpus(60, 3)
    return rows, spark.createDataFrame(rows, "doc_id string, text string")


@pytest.mark.parametrize("skew", [{}, {"hot_rows": 1, "hot_keys": 3}, {"hot_rows": 1, "hot_keys": 10**6}])
@pytest.mark.parametrize("compat", [False, True])
def test_tf_idf_with_and_without_hot_keys(articles, compat, skew):
    rows, df = articles
    got = {(r.doc_id, r.unigram): r.tfidf for r in qg.tf_idf(df, compat, **skew).collect()}
    expected = model.tf_idf(rows, compat)
    assert got.keys() == expected.keys()
    for key, value in expected.items():
        assert got[key] == pytest.approx(value, abs=1e-12)


def test_parts_of_the_weights(articles):
    rows, df = articles
    tokens = qg.tokenize(df)
    assert qg.corpus_size(df).first().n_docs == len(rows)
    tf = qg.term_freq(tokens)
    assert tf.filter("tf <= 0.5 or tf > 1").isEmpty()
    assert tf.agg(F.sum("n")).first()[0] == sum(len(model.tokens(text)) for _, text in rows)
    frequency = {r.unigram: r.df for r in qg.doc_freq(tokens).collect()}
    for unigram, df_ in frequency.items():
        assert df_ == len({doc for doc, text in rows if unigram in model.tokens(text)})
    assert qg.idf(tokens, df).filter("idf < 0").isEmpty()


def test_combine_takes_one_for_a_missing_side(spark):
    tf = spark.createDataFrame([("d", "a", 0.5), ("d", "b", 0.75)], "doc_id string, unigram string, tf double")
    idf = spark.createDataFrame([("d", "b", 2.0), ("d", "c", 3.0)], "doc_id string, unigram string, idf double")
    got = {r.unigram: r.tfidf for r in qg.combine_weights(tf, idf).collect()}
    assert got == {"a": 0.5, "b": 1.5, "c": 3.0}


@pytest.mark.parametrize("compat", [False, True])
def test_text_is_read_and_shuffled_once_for_all_uses_of_the_counts(articles, compat):
    _, df = articles
    executed = executed_plan(qg.tf_idf(df, compat))
    assert "isFinalPlan=true" in executed
    shuffles = [line for line in executed.splitlines() if re.search(r"hashpartitioning\(doc_id#\d+L?, unigram", line)]
    assert [line for line in shuffles if "ReusedExchange" in line]
    assert len([line for line in shuffles if "ReusedExchange" not in line]) == 1, "\n".join(shuffles)
    assert len(re.findall(r"Scan ExistingRDD\[.*text", executed)) == 1


def test_records_without_a_token_count_for_the_corpus(spark):
    rows = [("a", "x y"), ("b", "..."), ("b", "x"), ("c", ""), ("d", None), (None, "x z"), ("e", " ")]
    df = spark.createDataFrame(rows, "doc_id string, text string")
    n = qg.corpus_size(df).first().n_docs
    assert n == 4
    for weights in (qg.article_idf(df), qg.idf(qg.tokenize(df), df)):
        got = {(r.doc_id, r.unigram): r.idf for r in weights.collect()}
        assert got == pytest.approx({("a", "x"): math.log10(2), ("a", "y"): math.log10(4), ("b", "x"): math.log10(2)})
    both = {(r.doc_id, r.unigram): r.tfidf for r in qg.tf_idf(df, compat=True).collect()}
    # "..." is a lax token of its own: no strict one, so its document frequency counts as 1.
    assert both["b", "..."] == 1.0 and both["a", "y"] == pytest.approx(math.log10(4))


def test_one_article_neither_sorts_nor_aggregates_texts(articles):
    rows, df = articles
    chosen = qg.one_article(df)
    executed = executed_plan(chosen)
    assert "SortAggregate" not in executed and "ObjectHashAggregate" not in executed
    assert "WindowGroupLimit" in executed
    expected: dict[str, str] = {}
    for doc, text in rows:
        expected[doc] = max(text, expected.get(doc, ""))
    assert sorted(map(tuple, chosen.collect())) == sorted(expected.items())


def test_texts_of_unique_ids_stay_where_they_lie(spark):
    df = spark.createDataFrame([(f"d{i}", f"text {i}") for i in range(50)], "doc_id string, text string")
    executed = executed_plan(qg.one_article(df))
    moved = [line for line in executed.splitlines() if "Exchange" in line and "text" in line]
    assert "Window" not in executed and not moved


@pytest.mark.parametrize("broadcast", [0, 1_000_000])
def test_the_greatest_text_wins_whatever_its_key(spark, monkeypatch, broadcast):
    monkeypatch.setitem(qg.one_article.__globals__, "BROADCAST_IDS", broadcast)
    texts = ["", "a", "a\0", "abcdefg", "abcdefgh", "abcdefgha", "ab", "é", "zz", "日本語の", "日本語", None, "abcdefgh"]
    for k in range(1, len(texts) + 1):
        df = spark.createDataFrame([("d", t) for t in texts[:k]] + [("e", "x"), (None, "y")], "doc_id string, text string").repartition(3)
        got = {r.doc_id: r.text for r in qg.one_article(df).collect()}
        best = max((t for t in texts[:k] if t), key=lambda t: t.encode(), default=None)
        assert got == ({"d": best} if best else {}) | {"e": "x"}


def test_a_sentence_of_any_length_is_cut_where_it_lies(spark):
    words = spark.range(200_000).selectExpr("'d' as doc_id", "concat('w', id) as unigram", "cast(id % 7 as double) as tfidf")
    text = words.groupBy("doc_id").agg(F.concat_ws(" ", F.collect_list("unigram")).alias("sentence"))
    scored = qg.score_sentences(text.withColumn("pos", F.lit(0)), words)
    executed = executed_plan(scored)
    assert "WindowGroupLimit" in executed
    tied = sum(1 for i in range(200_000) if i % 7 == 6)
    assert scored.first().score == 6.0 * tied


def sentence_rows(spark, sentences):
    return spark.createDataFrame([("d", i, s) for i, s in enumerate(sentences)], "doc_id string, pos int, sentence string")


def test_scores_take_the_five_best_and_their_ties(spark):
    weights = {"a": 5.0, "b": 4.0, "c": 3.0, "d": 2.0, "e": 1.0, "f": 1.0, "g": 0.5}
    table = spark.createDataFrame([("d", u, w) for u, w in weights.items()], "doc_id string, unigram string, tfidf double")
    sentences = ["a b c d e f g", "a A a!", "zz", "", "...", "e f g", "a b c d e g"]
    got = {r.pos: r.score for r in qg.score_sentences(sentence_rows(spark, sentences), table).collect()}
    assert got == {i: model.sentence_score(s, weights) for i, s in enumerate(sentences)}
    assert got[0] == 16.0 and got[1] == 5.0 and got[2] == 0.0 and got[3] == 0.0


def test_equal_scores_go_to_the_earlier_sentence(spark):
    scored = spark.createDataFrame(
        [("d", p, f"s{p}", s) for p, s in enumerate([1.0, 2.0, 2.0, 1.0, 1.0])] + [("e", 0, "only", 0.0)],
        "doc_id string, pos int, sentence string, score double",
    )
    got = sorted((r.doc_id, r.pos) for r in qg.top_sentences(scored).collect())
    assert got == [("d", 0), ("d", 1), ("d", 2), ("e", 0)]


def test_unscored_sentences_are_kept(spark):
    scores = spark.createDataFrame([("d", 1, 2.0)], "doc_id string, pos int, score double")
    got = qg.attach_scores(sentence_rows(spark, ["x", "y"]), scores).orderBy("pos").collect()
    assert [tuple(r) for r in got] == [("d", 0, "x", 0.0), ("d", 1, "y", 2.0)]


@pytest.mark.parametrize("compat", [False, True])
def test_summaries_follow_the_rule(articles, compat):
    rows, df = articles
    weights = model.tf_idf(rows, compat)
    text_of: dict[str, str] = {}
    for doc, text in rows:
        text_of[doc] = max(text, text_of.get(doc, ""))
    got = {r.doc_id: r.summary for r in qg.summarize(df, compat=compat).collect()}
    assert got == {
        doc: model.summary(text, {u: w for (d, u), w in weights.items() if d == doc}) for doc, text in text_of.items()
    }


def test_summary_edges(spark):
    rows = [("one", "Only this."), ("none", ". . "), ("empty", ""), ("three", "A. B. C"), ("tail", "A b. C d. ")]
    df = spark.createDataFrame(rows, "doc_id string, text string")
    got = {r.doc_id: r.summary for r in qg.summarize(df).collect()}
    assert got == {"one": "Only this.. ", "none": "", "three": "A. B. C. ", "tail": "A b. C d. "}


def test_given_weights_may_name_unknown_documents(spark):
    articles = spark.createDataFrame([("d", "A b. C d. E f. G h")], "doc_id string, text string")
    weights = spark.createDataFrame([("d", "h", 1.0), ("gone", "h", 1.0)], "doc_id string, unigram string, tfidf double")
    got = {r.doc_id: r.summary for r in qg.summarize(articles, weights).collect()}
    assert got == {"d": "A b. C d. G h. ", "gone": ". "}


def test_salted_join_splits_a_hot_key(spark):
    facts = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    )
    dims = facts.groupBy("k").agg(F.count("*").alias("rows"), F.max("v").alias("top"))
    plain = facts.join(dims, "k")
    for limits in ({"hot_rows": 10, "hot_keys": 50}, {"hot_rows": 1}, {}):
        salted = qg.salted_join(facts, dims, "k", "v", "rows", **limits)
        assert sorted(map(tuple, salted.select(plain.columns).collect())) == sorted(map(tuple, plain.collect()))


def test_only_the_largest_keys_are_hot(spark):
    dims = spark.createDataFrame([(k, k * 10) for k in range(1, 9)], "k bigint, rows bigint")
    hot = hot_keys(dims, F.col("k"), "rows", hot_rows=30, hot_keys=5)
    assert [tuple(r) for r in hot.collect()] == [(8, 3)]
