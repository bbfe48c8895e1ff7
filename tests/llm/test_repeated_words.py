from __future__ import annotations

import random
import re
from collections import Counter

import corpus_pipeline
import numpy as np
import pyarrow as pa

from quillgraph.llm import suffixdedup
from tests.llm.helpers import without_repeats

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def without_runs(texts: list[str | None], words: int, length: int) -> list[bytes]:
    """What no repeated run of words and no repeated byte string covers."""
    raws = [(t or "").encode() for t in texts]
    places = [[m.span() for m in WORD.finditer(r)] for r in raws]
    runs = [[tuple(r[a:b] for a, b in p[k : k + words]) for k in range(len(p) - words + 1)] for r, p in zip(raws, places, strict=True)]
    seen = Counter(x for row in runs for x in row)
    strings = Counter(r[k : k + length] for r in raws for k in range(len(r) - length + 1))
    out = []
    for r, p, row in zip(raws, places, runs, strict=True):
        covered = np.zeros(len(r), dtype=bool)
        for k, x in enumerate(row):
            if seen[x] > 1:
                covered[p[k][0] : p[k + words - 1][1]] = True
        for k in range(len(r) - length + 1):
            if strings[r[k : k + length]] > 1:
                covered[k : k + length] = True
        out.append(np.frombuffer(r, dtype=np.uint8)[~covered].tobytes())
    return out


def planted() -> list[str]:
    """Passages of 51 to 60 short words in two or three documents each, of 50 words in two, and one longer than 400 bytes in few words."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice(["a", "b", "é", "o", "x", "7"]) for _ in range(rng.randint(1, 3)))
    texts = [[word() for _ in range(rng.randint(20, 120))] for _ in range(40)]
    for n in (50, *range(51, 61)):
        passage = [word() for _ in range(n)]
        for k in rng.sample(range(40), rng.randint(2, 3)):
            at = rng.randrange(len(texts[k]) + 1)
            texts[k][at:at] = passage
    held = [" ".join(t) for t in texts]
    space = "\t\n".join(texts[0][:55])
    return [*held, space, held[1][:40] + "w" * 450 + " z", "w" * 450 + " y", None, "", " ", "ha " * 60]


def test_runs_of_words(spark):
    texts = planted()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)
    for hot in (suffixdedup.HOT, 0):
        got = {r.doc_id: bytes(r.kept) for r in suffixdedup.remove_repeats(docs, words=51, hot=hot).collect()}
        assert [got[i] for i in range(len(texts))] == without_runs(texts, 51, 400)


def test_pipeline_cuts_short_worded_passages(spark):
    texts = planted()
    docs = spark.createDataFrame([(i, t, "s", len(t or "")) for i, t in enumerate(texts)], "doc_id bigint, text string, source string, n_chars bigint")
    after = {r.doc_id: r for r in corpus_pipeline.cut_repeats(spark, docs, "").collect()}
    expected, plain = without_runs(texts, 51, 400), without_repeats(texts, 400)
    assert sum(len(x) < n - removed for x, (n, removed, _, _) in zip(expected, plain, strict=True)) > 15
    for i, x in enumerate(expected):
        if x == (texts[i] or "").encode():
            assert after[i].text == texts[i]
        elif x.strip(b" "):
            assert after[i].text.encode() == x and after[i].n_chars == len(x.decode())
        else:
            assert i not in after


def test_word_codes_by_row():
    texts = pa.array(["a b", None, "", "b", " a\x0bé ", "éa", "a"]).slice(1)
    rows = suffixdedup.word_codes(texts).to_pylist()
    a, b, size = rows[5], rows[2], suffixdedup.CODE
    assert rows[:2] == [b"", b""] and rows[3][:size] == a != b and [len(x) // size for x in rows] == [0, 0, 1, 2, 1, 1]
