from __future__ import annotations

import math
import random
from collections import Counter

import corpus_pipeline
from pyspark.sql import functions as F

from quillgraph.llm import mixing
from quillgraph.llm.common import words


def test_stage_takes_the_words_of_the_targets(spark):
    rng = random.Random(4)
    text = lambda n: "  " * rng.randint(0, 1) + "".join(f"w{rng.randint(0, 9)}é" + rng.choice([" ", "\n", " \t"]) for _ in range(n))
    held = [(i, text(rng.randint(1, 300)), f"s{i % 3}" if i % 7 else None) for i in range(80)]
    held += [(200, text(20_000), "long"), (201, text(3), "long"), (202, text(9_000), "other"), (203, None, "s1"), (204, "", "none"), (205, " ", "s0")]
    held += [(None, t, "s2") for t in ("a b c", "d e f", "a b c", "d e f")] + [held[4]] * 2
    docs = spark.createDataFrame([(*r, len(r[1] or "")) for r in held], "doc_id bigint, text string, source string, n_chars int").repartition(4)
    got = corpus_pipeline.mix_sources(spark, docs, "").collect()
    targets = {r.source: math.floor(r.target) for r in mixing.mix(docs).select("source", "target").distinct().collect() if r.target}
    taken = Counter()
    for r in got:
        taken[r.source] += len(words(r.text))
    assert taken == Counter(targets)
    texts = {(i, s, t) for i, t, s in held}
    parts = [r for r in got if (r.doc_id, r.source, r.text) not in texts]
    assert parts and all(n == 1 for n in Counter(r.source for r in parts).values())
    for r in got:
        assert r.n_chars == len(r.text)
    for r in parts:
        assert any(i == r.doc_id and s == r.source and t.startswith(r.text) and t[len(r.text)].isspace() for i, t, s in held if t)


def test_first_words(spark):
    rows = spark.createDataFrame([("  a b\n c ", 2), ("a  b", 1), (" x y", 1), ("a b", 2), ("\t\n é\x0b z q", 2)], "text string, n int")
    got = [r[0] for r in rows.select(mixing.first_words(F.col("text"), F.col("n"))).collect()]
    assert got == ["  a b", "a", " x", "a b", "\t\n é\x0b z"]
