from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillgraph.llm import hnsw, quality, queries, topk, toxicity, urlfilter, vectors
from quillgraph.llm.common import fold

VECTORS = "vec_id bigint, embedding array<float>, rank int, score double, shard int"


def embeddings(n: int = 900, dim: int = 12) -> list[tuple]:
    rng = np.random.default_rng(3)
    made = rng.normal(size=(n, dim)).astype(np.float32)
    made[100:140] = made[100]
    held = [(i, [float(x) for x in v], 0, 0.0, 0) for i, v in enumerate(made)]
    odd = [(2000, None, 0, None, None), (2050, [0.0] * dim, 0, 0.0, 0), (2100, [float("nan")] + [1.0] * (dim - 1), 0, 0.0, 0), (2150, [1.0, None], 0, 0.0, 0)]
    return [*held, *odd, (2200, [1.0, 2.0], 0, 0.0, 0), (None, [1.0] * dim, 0, 0.0, 0), (2250, [], 0, 0.0, 0)]


def test_exact_top_k(spark):
    held = embeddings()
    rows = topk.quantized(vectors.valid(spark.createDataFrame(held, VECTORS), zero=True))
    got = topk.top_k(rows, rows.filter("vec_id % 50 = 0"), k=5, shard=128, block=4).collect()
    good = {i: np.floor(256 * np.array(v, dtype=float)).astype(np.int64) for i, v, *_ in held if i is not None and v and None not in v and np.isfinite(v).all()}
    expected = []
    for q in good:
        if q % 50 == 0:
            scores = sorted((-int(good[q] @ v), i) for i, v in good.items() if i != q and len(v) == len(good[q]))
            expected += [(q, r, i, -s) for r, (s, i) in enumerate(scores[:5], 1)]
    assert sorted(map(tuple, got)) == sorted(expected)


def test_nearest_found(spark):
    held = embeddings()
    rows = vectors.valid(spark.createDataFrame(held, VECTORS))
    assert rows.count() == 901
    got = hnsw.nearest(rows, rows.filter("vec_id % 10 = 0"), k=10).collect()
    good = {i: np.array(v, dtype=float) for i, v, *_ in held[:900]}
    hits = 0
    for q in range(0, 900, 10):
        gaps = sorted((float(np.sqrt(((good[q] - v) ** 2).sum())), i) for i, v in good.items() if i != q)[:10]
        own = sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == list(range(1, 11))
        assert [(r.score, r.vec_id) for r in own] == sorted((r.score, r.vec_id) for r in own)
        hits += len({i for _, i in gaps} & {r.vec_id for r in own})
    assert hits / 900 >= 0.9
    empty = rows.limit(0)
    assert hnsw.nearest(empty, empty).count() == 0
    assert topk.top_k(empty, empty).count() == 0


LABELLED = "doc_id bigint, text string, score double, label int"


def documents() -> tuple[list[tuple], list[tuple]]:
    rng = random.Random(2)
    docs, labels = [], []
    for i in range(600):
        words = ["".join(rng.choice(["th", "er", "on", "an"]) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(30, 80))]
        toxic, junk = i % 6 == 0, i % 4 == 0
        if junk:
            words = [w.upper() + "!!" for w in words]
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["idiot", "moron", "zorgon"]))
        docs.append((i, " ".join(words), 0.0, 1))
        if i % 5:
            labels.append((i, int(not junk), int(toxic)))
    return [*docs, (900, None, None, None), (901, "", 0.0, 0), (None, "a b", 0.0, 0), docs[3]], [*labels, labels[0], (None, 1, 1), (7, None, None), (8, 0, 1), (8, 1, 0)]


@pytest.mark.parametrize(("module", "label"), [(toxicity, "toxic"), (quality, "quality")])
def test_classifiers_on_held_out_rows(spark, module, label):
    docs, labels = documents()
    frame = spark.createDataFrame(docs, LABELLED).repartition(3)
    known = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    held_out = fold(F.col("doc_id"), 4) == 0
    model = module.fit(frame, known, ~held_out)
    scored = module.score(frame, model).withColumn("held_out", held_out).collect()
    assert len(scored) == len(docs) and all(0 <= r.score <= 1 for r in scored)
    truth = {i: int(i % 6 == 0) if label == "toxic" else int(i % 4 != 0) for i in range(600)}
    checked = [(r.score >= 0.5) == bool(truth[r.doc_id]) for r in scored if r.held_out and r.doc_id in truth]
    assert len(checked) > 80 and np.mean(checked) > 0.97
    nothing = module.fit(frame, known.limit(0), ~held_out)
    assert module.score(frame.limit(0), nothing).count() == 0
    assert all(0 <= r.score <= 1 for r in module.score(frame.limit(5), nothing).collect())


def test_grammar_reads_clauses():
    grammar = toxicity.Grammar(dict.fromkeys(toxicity.INSULTS, 1.0))
    marks = lambda text: {toxicity.FEATURES[i] for i, x in enumerate(grammar.features(text)[:16]) if x}
    assert marks("You are an idiot.") == {("insult", 1, 0, 0)}
    assert marks("he is not a moron") == {("insult", 1, 1, 0)}
    assert marks("It said: idiot") == {("insult", 0, 0, 0)}
    assert marks("it was called trash") == {("insult", 0, 0, 1)}
    assert marks("they will kill") == {("threat", 1, 0, 0)}
    assert marks("nothing here") == set() and grammar.features("") == [0.0] * len(toxicity.FEATURES)


def test_trees_match_a_walk_by_hand():
    rng = np.random.default_rng(4)
    rows = rng.normal(size=(300, 3))
    trees = quality.boost(rows, (rows[:, 0] > 0.2).astype(float), trees=5, depth=3)
    for row, score in zip(rows[:20], trees.score(rows[:20]), strict=True):
        total = trees.base
        for feature, cut, value in zip(trees.feature, trees.cut, trees.value, strict=True):
            node = 0
            while node < 7:
                node = 2 * node + (2 if row[feature[node]] > cut[node] else 1)
            total += value[node - 7]
        assert abs(1 / (1 + np.exp(-total)) - score) < 1e-12


URLS = [
    None, "", "no scheme", "http://", "https://A.Org/x?y#z", "http://org", "http://org/", "http://www.example.org/es/1", "http://example.org/en/19/",
    "http://x.example.org/en/2", "http://notexample.org/es/", "ftp://b.COM/fr/?q", "http://b.com/de/", "http://b.com/de", "http://b.net/a://c", "http://ü.net/" + "a" * 5000,
]


def by_hand(url: str | None) -> tuple[str, str, str | None]:
    _, found, rest = (url or "").partition("://")
    host = "".join(rest.replace("?", "/").replace("#", "/").split("/")[:1]) if found else ""
    path = rest[len(host) :].split("#")[0].split("?")[0] if found else ""
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in queries.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return host, path, max((r.rule for r in fits), key=len, default=None)


def test_url_rules(spark):
    pages = spark.createDataFrame([(i, u, "x", 1.0) for i, u in enumerate([*URLS, URLS[4]])], "page_id bigint, url string, host string, score double")
    got = sorted(urlfilter.judge(pages, queries.RULES, rounds=2, depth=2).collect())
    verdicts = {r.rule: r.verdict for r in queries.RULES}
    assert [tuple(r)[:4] for r in got] == [(i, *by_hand(u)) for i, u in enumerate([*URLS, URLS[4]])]
    assert all(r.verdict == verdicts.get(r.rule, r.verdict) and r.verdict in ("allow", "block") for r in got)
    assert urlfilter.judge(pages.limit(0), queries.RULES).count() == 0


@pytest.mark.parametrize("broadcast", [0, 10**6])
def test_every_suffix_has_its_share(spark, monkeypatch, broadcast):
    """More suffixes than any list would hold; shares, entropy and counts against plain Python."""
    monkeypatch.setattr(urlfilter, "SUFFIXES", broadcast)
    urls = [(f"http://h{i % 3}.d{i % 150}.t{i % 30}/a/B%20{i}?x=1&y=2", int(i % 150 < 60)) for i in range(600)]
    labelled = spark.createDataFrame([*urls, urls[0], (None, 1)], "url string, blocked int")
    host, path = urlfilter.split_url(F.col("url"))
    model = urlfilter.fit(labelled.select("url", host.alias("host"), path.alias("path"), "blocked"), rounds=2, depth=2)
    prior = sum(b for _, b in urls) / len(urls)
    asked = [*(u for u, _ in urls[:200]), "http://new.place/x", None]
    frame = spark.createDataFrame([(u,) for u in asked], "url string").select("url", host.alias("host"), path.alias("path"))
    got = {r.url: r for r in model.features(frame).collect()}
    assert len(got) == len(asked)
    for u in asked:
        name = u.split("/")[2] if u else ""
        for kind, suffix in (("tld_share", name.split(".")[-1]), ("domain_share", ".".join(name.split(".")[-2:]))):
            own = [b for x, b in urls if x.split("/")[2].endswith(suffix) and ("." + x.split("/")[2]).endswith("." + suffix)]
            assert got[u][kind] == pytest.approx((sum(own) + 10 * prior) / (len(own) + 10))
        text = u or ""
        kinds = [c if c in "abcdefghijklmnopqrstuvwxyz" + urlfilter.MARKS else "0" if c.isdigit() else "rest" for c in text.lower()]
        shares = [kinds.count(k) / len(kinds) for k in set(kinds)]
        assert got[u].entropy == pytest.approx(-sum(p * np.log2(p) for p in shares))
        assert got[u].n_url == len(text) and got[u].digits == pytest.approx(sum(c.isdigit() for c in text) / max(1, len(text)))
        assert got[u].params == text.count("&") + (1 if "?" in text else 0) and got[u].escapes == pytest.approx(text.count("%") / max(1, len(text)))


def test_urls_learned_from_labels(spark):
    urls = [f"http://{'win-cash-77' if i % 3 == 0 else 'quiet'}.example{i % 5}.net/p/{i}" for i in range(400)]
    frame = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id bigint, url string")
    labelled = spark.createDataFrame([(u, int(i % 3 == 0)) for i, u in enumerate(urls) if i % 2], "url string, blocked int")
    got = urlfilter.judge(frame, [], labelled, rounds=3, depth=3).collect()
    assert all((r.verdict == "block") == (r.page_id % 3 == 0) for r in got)
