from __future__ import annotations

import random
import re

import numpy as np
import public_tokenizers
import pytest

from quillgraph.llm import mixing, ngramjoin, suffixdedup, tokencount, wordbpe
from tests.llm.helpers import SCHEMA, corpus, rows, sha, similar_groups, without_repeats

CORPUS = corpus()
EMPTY: list[tuple] = []


@pytest.fixture(scope="module")
def docs(spark):
    held = spark.createDataFrame(CORPUS, SCHEMA).repartition(3).cache()
    yield held
    held.unpersist()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame(EMPTY, SCHEMA)


def test_token_counts_are_the_library_s(docs, none):
    from sentencepiece import SentencePieceProcessor

    file = public_tokenizers.path("piece_bpe_32k.model")
    pieces = SentencePieceProcessor(model_file=file)
    expected = [(d[0], len((d[1] or "").encode()), len(pieces.encode(d[1] or "")), len(pieces.encode(d[1] or "")) > 100) for d in CORPUS]
    got = rows(tokencount.count_tokens(docs, file, limit=100), "doc_id", "n_bytes", "n_tokens", "over_limit")
    assert got == sorted(expected, key=str)
    assert tokencount.count_tokens(none, file).count() == 0


def test_bpe_round_trip_is_the_library_s(docs, none):
    from tokenizers import Tokenizer

    file = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(file)
    expected = []
    for d in CORPUS:
        ids = library.encode(d[1] or "", add_special_tokens=False).ids
        expected.append((d[0], len(ids), bytearray(np.array(ids, dtype="<u4").tobytes()), library.decode(ids, skip_special_tokens=False)))
    decoded = wordbpe.decode(wordbpe.encode(docs, file), file)
    assert rows(decoded, "doc_id", "n_tokens", "ids", "text") == sorted(expected, key=str)
    assert wordbpe.encode(none, file).count() == 0


@pytest.mark.parametrize(("length", "gram", "hot"), [(40, 10, 20_000), (40, 30, 1), (60, 25, 20_000)])
def test_every_repeat_goes(docs, length, gram, hot):
    found = suffixdedup.remove_repeats(docs, length, gram, hot)
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, sha(bytes(r.kept))) for r in found.collect()), key=str)
    expected = [(d[0], *x) for d, x in zip(CORPUS, without_repeats([d[1] for d in CORPUS], length), strict=True)]
    assert got == sorted(expected, key=str)
    assert sum(x[2] > 0 for x in got) > 20


def test_no_rows_no_repeats(none):
    assert suffixdedup.remove_repeats(none).count() == 0


def test_suffix_levels_grow_geometrically():
    family = suffixdedup.Family(40, 10)
    for k in range(8):
        family.add([bytes([65 + k]) * 50] * 2, [5, 5])
    assert [len(level) for level in family.levels] == [16]
    assert family.found[:, :6].any(axis=1).all()


@pytest.mark.parametrize(("n", "percent"), [(4, 85), (5, 80), (2, 60)])
def test_groups_lose_no_link(docs, n, percent):
    plain = [(d[0], d[1]) for d in CORPUS[:-3]]
    got = ngramjoin.join(docs.filter("doc_id is not null").dropDuplicates(["doc_id"]), n, percent)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == similar_groups(plain, n, percent)
    assert ngramjoin.join(docs, n, percent).count() == len(CORPUS)


@pytest.mark.parametrize("base", [True, False])
def test_copies_that_drift_apart(spark, base):
    """A group whose members are mostly below the threshold: hubs settle few of them."""
    rng = random.Random(7)
    words = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    plain = [(0, " ".join(words))] if base else []
    for i in range(1, 160):
        own = list(words)
        for at in rng.sample(range(120), rng.randint(1, 6)):
            own[at] = f"e{rng.randrange(10**6)}"
        plain.append((i, " ".join(own[: rng.choice([120, 120, 110])])))
    got = ngramjoin.join(spark.createDataFrame(plain, "doc_id bigint, text string").repartition(4), 4, 85)
    expected = similar_groups(plain, 4, 85)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == expected
    assert 20 < len({c for _, c in expected.values()}) < 155


CHAIN = " ".join(f"w{i}" for i in range(100))


def test_rows_without_an_id_link(spark):
    """1 and 3 are linked by a row without an id only."""
    one, three = CHAIN.replace("w0 ", "a ").replace("w1 ", "b "), CHAIN + " c d e"
    plain = [(1, one), (2, CHAIN), (3, three)]
    assert {c for _, c in similar_groups([plain[0], plain[2]], 4, 95).values()} == {1, 3}
    assert {c for _, c in similar_groups(plain, 4, 95).values()} == {1}
    rows = [(1, one), (None, CHAIN), (3, three), (None, "q r s t u"), (None, "q r s t u"), (9, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = sorted(((r.doc_id, r.component_id) for r in ngramjoin.join(docs, 4, 95).collect()), key=str)
    assert got == sorted([(1, 1), (None, 1), (3, 1), (None, None), (None, None), (9, 9)], key=str)
    kept = sorted((str(r.doc_id), r.text) for r in ngramjoin.one_of_each(docs, 4, 95).collect())
    assert kept == sorted([("1", one), ("None", "q r s t u"), ("9", None)], key=str)


def test_rows_of_one_id_link_what_either_links(spark):
    other = " ".join(f"v{i}" for i in range(80))
    rows = [(5, CHAIN), (5, other), (2, CHAIN + " x"), (8, other + " y"), (8, other + " y"), (1, "alone in the world of words")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(2)
    got = sorted((r.doc_id, r.component_id) for r in ngramjoin.join(docs, 4, 85).collect())
    assert got == [(1, 1), (2, 2), (5, 2), (5, 2), (8, 2), (8, 2)]
    assert sorted(r.doc_id for r in ngramjoin.one_of_each(docs, 4, 85).collect()) == [1, 2]


@pytest.mark.parametrize(("together", "tile"), [(1, 4096), (250_000, 8), (2, 5)])
def test_dealt_out_ngrams_and_tiles_lose_no_link(spark, together, tile):
    rng = random.Random(9)
    words = [f"w{rng.randrange(10**6)}" for _ in range(90)]
    plain = []
    for i in range(120):
        own = list(words)
        for at in rng.sample(range(90), rng.randint(1, 5)):
            own[at] = f"e{rng.randrange(10**6)}"
        plain.append((i, " ".join(own)))
    got = ngramjoin.join(spark.createDataFrame(plain, "doc_id bigint, text string").repartition(4), 4, 85, together, tile)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == similar_groups(plain, 4, 85)


@pytest.mark.parametrize("copies", [0, 10**6])
def test_texts_that_occur_often_are_worked_on_once(spark, monkeypatch, copies):
    monkeypatch.setattr(suffixdedup, "COPIES", copies)
    monkeypatch.setattr(suffixdedup, "TOGETHER", 3)
    rng = random.Random(2)
    texts = [" ".join(f"w{rng.randrange(500)}" for _ in range(60)) for _ in range(4)]
    rows = [(None, texts[0])] * 30 + [(i, texts[0]) for i in range(30)] + [(50, texts[1]), (51, texts[2][:90] + texts[0][20:120] + texts[2][90:]), (52, "short"), (53, "short"), (54, None), (55, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, sha(bytes(r.kept))) for r in suffixdedup.remove_repeats(docs, 60, 20).collect()), key=str)
    expected = [(d, *x) for (d, _), x in zip(rows, without_repeats([t for _, t in rows], 60), strict=True)]
    assert got == sorted(expected, key=str)


def test_no_rows_no_groups(none):
    assert ngramjoin.join(none).count() == 0


def test_bit_counts_never_hide_a_link():
    rng = np.random.default_rng(1)
    for _ in range(300):
        a = np.unique(rng.integers(0, 2**63, rng.integers(1, 300)).astype(np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < 0.9], rng.integers(0, 2**63, rng.integers(0, 40)).astype(np.uint64)]))
        if len(b) and ngramjoin.linked(a, b, 80):
            assert ngramjoin.may_link(len(a), ngramjoin.bitmap(a), len(b), ngramjoin.bitmap(b), 80)


def test_mix_meets_its_targets(docs, none):
    got = mixing.mix(docs, block=16).collect()
    assert len(got) == len(CORPUS)
    sizes: dict = {}
    for d in CORPUS:
        sizes[d[2]] = sizes.get(d[2], 0) + len(re.findall("[^\\x20\\x09-\\x0D]+", d[1] or ""))
    weights = dict(zip(sorted(x for x in sizes if x is not None), (1, 2, 3), strict=False)) | {None: 1}
    targets, full = {}, set()
    while True:
        left = sum(sizes.values()) - sum(3 * sizes[s] for s in full)
        level = left / sum(w for s, w in weights.items() if s not in full)
        targets = {s: 3 * sizes[s] if s in full else level * weights[s] for s in sizes}
        over = {s for s in sizes if targets[s] > 3 * sizes[s]}
        if not over:
            break
        full |= over
    for s in sizes:
        own = [r for r in got if r.source == s]
        assert {r.source_size for r in own} == {sizes[s]}
        assert all(abs(r.target - targets[s]) < 1e-6 for r in own)
        assert abs(sum(r.taken for r in own) - targets[s]) <= 1
    assert all(0 <= r.taken <= 3 * r["size"] for r in got)
    assert sorted(got, key=str) == sorted(mixing.mix(docs, block=16).collect(), key=str)
    assert mixing.mix(none).count() == 0
