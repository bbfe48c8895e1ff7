from __future__ import annotations

import random

import corpus_pipeline
import pytest

from tests.llm.helpers import similar_groups
from tests.llm.test_repeated_words import without_runs

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """The rows before the first stage and after each."""
    docs, held = spark.read.parquet(f"{SMALL}/documents.parquet"), []
    held.append(docs.collect())
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("run") / name)
        stage(spark, docs, SMALL).write.parquet(path)
        docs = spark.read.parquet(path)
        held.append(docs.collect())
    return held


def test_stages_keep_the_columns(steps):
    assert all(x[0].__fields__ == ["doc_id", "text", "lang", "source", "n_chars"] for x in steps[:-1])


def test_toxic_documents_go(steps):
    left = {r.doc_id for r in steps[1]}
    for r in steps[0]:
        if " idiot " in (r.text or "") and " moron " in r.text:
            assert r.doc_id not in left
    assert len(left) > 0.9 * len(steps[0])


def test_one_of_each_group_stays(steps):
    groups = similar_groups([(r.doc_id, r.text) for r in steps[1]], 5, 80)
    assert {r.doc_id for r in steps[2]} == {c for _, c in groups.values()}


def test_repeats_are_cut(steps):
    """Byte strings of 400 and runs of 51 words go; the texts left hold what neither covers."""
    expected = without_runs([r.text for r in steps[2]], 51, 400)
    after = {r.doc_id: r for r in steps[3]}
    assert len(after) == len(steps[3])
    for r, left in zip(steps[2], expected, strict=True):
        if left == (r.text or "").encode():
            assert after[r.doc_id].text == r.text
        elif left.strip(b" "):
            # Characters cut in half go too.
            assert after[r.doc_id].text == left.decode(errors="ignore")
            assert after[r.doc_id].n_chars == len(after[r.doc_id].text)
        else:
            assert r.doc_id not in after


AWKWARD = "doc_id bigint, text string, lang string, source string, n_chars bigint, _key string, _found int, _n bigint, _times string, key int, score double"


def test_stages_take_awkward_rows(spark, tmp_path):
    """Nulls anywhere, no rows, repeated rows, clashing names: every stage ends, with the columns it was given."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7)))
    texts = [" ".join(word() for _ in range(rng.randint(3, 120))) for _ in range(30)]
    texts += [texts[0], texts[1] + " more", None, "", " \n", "x" * 5000, " ".join(texts[2:6])]
    extra = (None, "k", 1, None, "t", 2, 0.5)
    rows = [(i if i % 9 else None, t, "en", f"s{i % 3}" if i % 4 else None, len(t or ""), *extra[1:]) for i, t in enumerate(texts)]
    rows += [rows[4], rows[4], (None, texts[7], None, None, None, *extra[1:])]
    for held in (rows, []):
        docs = spark.createDataFrame(held, AWKWARD)
        names, last = docs.columns, None
        for name, stage in corpus_pipeline.STAGES:
            path = str(tmp_path / f"{name}-{len(held)}")
            stage(spark, docs, SMALL).write.parquet(path)
            last, docs = docs, spark.read.parquet(path)
            if name != "bpe":
                assert docs.columns == names
            assert docs.count() > 0 if held else docs.count() == 0
        assert docs.count() == last.count()


def test_mix_and_ids(steps):
    mixed = [r.doc_id for r in steps[4]]
    assert max(mixed.count(i) for i in set(mixed)) <= 3
    assert sorted(r.doc_id for r in steps[5]) == sorted(mixed)
