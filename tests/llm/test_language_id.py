"""Naive Bayes against a plain version, and held-out accuracy."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillgraph.llm import langid, queries
from quillgraph.llm.common import fold
from quillgraph.plans.tables import table

SCHEMA = "doc_id bigint, text string, lang string, bucket bigint, n bigint, score double"


def plain_grams(text: str | None) -> Counter:
    """Every n-gram by itself, hashed alone."""
    found: Counter = Counter()
    if langid.has_letter(text):
        clean = langid.letters(text)
        for order in langid.ORDERS:
            for k in range(len(clean) - order + 1):
                gram = clean[k : k + order]
                if gram != " ":
                    code = np.array([ord(c) for c in gram], dtype=np.uint64)
                    found[int(langid.buckets(code, np.zeros(order, dtype=np.int64), order)[0][0])] += 1
    return found


TEXTS = ["Hello, World!", "ÄÖÜ straße 123", "", None, "123 --- ²½Ⅷ", "日本語", "x", "é é", "a  b\x00c" * 40, "🎉 ok"]


@pytest.mark.parametrize("piece", [7, 50, 1 << 18])
def test_windows_lose_and_repeat_no_gram(monkeypatch, piece):
    monkeypatch.setattr(langid, "PIECE", piece)
    got = [Counter() for _ in TEXTS]
    for found, owner in langid.grams(TEXTS):
        assert (np.diff(owner) >= 0).all()
        for b, i in zip(found.tolist(), owner.tolist(), strict=True):
            got[i][b] += 1
    assert got == [plain_grams(t) for t in TEXTS]


def documents() -> list[tuple]:
    words = {"aa": ["the", "and", "of"], "bb": ["der", "und", "ist"], "cc": ["le", "et", "une"]}
    rows = []
    for i in range(120):
        lang = ["aa", "aa", "bb", "cc"][i % 4]
        rows.append((i, " ".join(words[lang][(i * k) % 3] for k in range(1, 9)), lang if i % 11 else None, 1, 2, 0.5))
    return [*rows, *((200 + i, t, "aa" if i % 2 else None, None, None, None) for i, t in enumerate(TEXTS)), (None, "the of", "aa", 0, 0, 0.0), rows[3], (300, "und " * 30_000, "bb", 0, 0, 0.0)]


def test_scores_are_those_of_plain_bayes(spark):
    rows = documents()
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    train = fold(F.col("doc_id"), 4) != 2
    got = sorted(((r.doc_id, r.lang_pred, r.score) for r in langid.score(frame, langid.fit(frame, train)).collect()), key=str)

    known = {r[0] for r in frame.filter(train).select("doc_id").collect()}
    counts: dict[str, Counter] = {}
    seen: Counter = Counter()
    for i, text, lang, *_ in rows:
        if i in known and lang and langid.has_letter(text):
            counts.setdefault(lang, Counter()).update(plain_grams(text))
            seen[lang] += 1
    expected = []
    for i, text, *_ in rows:
        if not langid.has_letter(text):
            expected.append((i, "und", 0.0))
            continue
        logs = {}
        for lang, c in counts.items():
            whole = sum(c.values()) + langid.SMOOTHING * langid.BUCKETS
            logs[lang] = math.log(seen[lang] / sum(seen.values())) + sum(k * math.log((c[b] + langid.SMOOTHING) / whole) for b, k in plain_grams(text).items())
        best = max(sorted(logs), key=logs.get)
        expected.append((i, best, 1 / sum(math.exp(x - logs[best]) for x in logs.values())))
    expected.sort(key=str)
    assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in expected]
    assert all(abs(x[2] - y[2]) < 1e-3 for x, y in zip(got, expected, strict=True))


def test_nothing_to_learn_from(spark):
    frame = spark.createDataFrame(documents()[:5], SCHEMA)
    nothing = langid.fit(frame.limit(0), F.lit(True))
    assert {(r.lang_pred, r.score) for r in langid.score(frame, nothing).collect()} == {("und", 0.0)}
    assert langid.score(frame.limit(0), nothing).count() == 0
    unnamed = langid.fit(frame.withColumn("lang", F.lit(None).cast("string")), F.lit(True))
    assert unnamed.languages == []


def test_many_languages_are_counted_whole(spark, monkeypatch):
    monkeypatch.setattr(langid, "HELD", 2)
    rows = [(i, "word", f"l{i % 7}", 0, 0, 0.0) for i in range(70)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(2)
    assert dict(langid.count(frame).filter("bucket = -1").select("lang", "n").collect()) == {f"l{k}": 10 for k in range(7)}
    monkeypatch.setattr(langid, "LANGUAGES", 6)
    with pytest.raises(ValueError, match="languages"):
        langid.fit(frame, F.lit(True))


def test_held_out_documents(spark):
    got = queries.op13_language_id(spark, "/root/testdata/sf0.01").join(table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "lang", "text"), "doc_id").collect()
    checked = [r.lang == r.lang_pred for r in got if r.held_out and r.lang and r.lang_pred != "und"]
    assert len(checked) > 150 and np.mean(checked) > 0.95
    assert all(0 <= r.score <= 1 and (r.lang_pred == "und") == (not langid.has_letter(r.text)) for r in got)
