from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

import quillgraph as qg
from quillgraph.operators.graph import COLLAPSE_PARTS, layout_width
from quillgraph.plans import catalog
from tests import model
from tests.plans import executed_plan

TITLES = {1: "Surfing", 2: "Wind_surfing", 3: "Rocky Park", 4: "surf%ing", 5: "Kite SURFING", 6: "Rocky Park", 7: "Lake"}


def random_edges(seed: int) -> list[tuple[int, int]]:
    """A hub holds a third of all links; there are dead ends, loops and parallel links."""
    rng = random.Random(seed)
    edges = [(0, rng.randint(0, 60)) for _ in range(150)]
    edges += [(rng.randint(1, 40), rng.randint(1, 60)) for _ in range(300)]
    return edges + [(5, 5), (5, 6), (5, 6), (6, 6)]


def edge_frame(spark, edges):
    return spark.createDataFrame(edges, "src bigint, dst bigint")


def rank_map(df):
    rows = df.collect()
    assert len({r.page_id for r in rows}) == len(rows)
    return {r.page_id: r["rank"] for r in rows}


@pytest.fixture(scope="module")
def graph(spark):
    edges = random_edges(11)
    return edges, edge_frame(spark, edges)


@pytest.mark.parametrize("tax", [None, 0.15])
@pytest.mark.parametrize("keep_all", [False, True])
@pytest.mark.parametrize("skew", [{}, {"hot_rows": 20}, {"hot_rows": 2, "hot_keys": 3}])
def test_pagerank_follows_the_rule(graph, tax, keep_all, skew):
    edges, df = graph
    got = rank_map(qg.pagerank(df, 8, tax, keep_all, checkpoint_every=3, **skew))
    expected = model.pagerank(edges, 8, tax, keep_all)
    assert got.keys() == expected.keys()
    for page, value in expected.items():
        assert got[page] == pytest.approx(value, rel=1e-9)


def test_rank_properties(graph, spark):
    edges, df = graph
    taxed = rank_map(qg.pagerank(df, 5, 0.15))
    assert min(taxed.values()) >= 0.15
    mass = [sum(rank_map(qg.pagerank(df, rounds)).values()) for rounds in (1, 4)]
    assert len({src for src, _ in edges}) + 1e-9 >= mass[0] >= mass[1]
    moved = edge_frame(spark, [(src * 7 + 3, dst * 7 + 3) for src, dst in edges])
    renamed = rank_map(qg.pagerank(moved, 5, 0.15))
    assert renamed == pytest.approx({page * 7 + 3: value for page, value in taxed.items()})


def test_no_rounds_give_the_start(graph):
    edges, df = graph
    assert rank_map(qg.pagerank(df, 0)) == dict.fromkeys({src for src, _ in edges}, 1.0)


def test_pagerank_leaves_nothing_cached(graph, spark):
    _, df = graph
    qg.pagerank(df, 2)
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()


def test_degrees_and_dead_ends(spark):
    df = edge_frame(spark, [(1, 2), (1, 2), (1, None), (2, 3), (3, 3), (1, 4)])
    assert dict(qg.out_degree(df).collect()) == {1: 4, 2: 1, 3: 1}
    assert [r.page_id for r in qg.dead_ends(df).collect()] == [4]
    assert rank_map(qg.pagerank(df, 1)) == {2: 0.5, 3: 2.0, 4: 0.25}


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(list(TITLES.items()), "page_id bigint, title string")


def test_title_search(pages):
    assert sorted(r.page_id for r in qg.search_titles(pages, "surfing").collect()) == [1, 2, 5]
    assert [r.page_id for r in qg.search_titles(pages, "f%i").collect()] == [4]
    assert qg.find_page(pages, "Rocky Park").first().page_id == 3
    assert qg.find_page(pages, "nowhere").first().page_id is None


def test_top_pages_by_number_and_by_text(spark, pages):
    ranks = spark.createDataFrame([(1, 10.5), (2, 9.0), (3, 9.5e-48), (99, 50.0)], "page_id bigint, rank double")
    assert [r.page_id for r in qg.top_pages(ranks, pages, 2).collect()] == [1, 2]
    assert [r.page_id for r in qg.top_pages(ranks, pages, 3, compat=True).collect()] == [3, 2, 1]
    lines = qg.format_ranked(qg.top_pages(ranks, pages, 3)).collect()
    assert [r.line for r in lines] == ["10.5 - Surfing", "9.0 - Wind_surfing", "9.5E-48 - Rocky Park"]


BOMB_EDGES = [(1, 2), (1, 5), (2, 1), (2, 3), (5, 1), (3, 7), (7, 1), (4, 1)]


def test_subgraph_and_injection(spark, pages):
    kept = qg.keyword_subgraph(edge_frame(spark, BOMB_EDGES), pages, "surfing")
    assert sorted(map(tuple, kept.collect())) == [(1, 2), (1, 5), (2, 1), (2, 3), (5, 1)]
    bombed = qg.inject_links(kept, qg.find_page(pages, "Lake"), copies=2)
    expected = kept.collect() + [(src, 7) for src in (1, 2, 5) for _ in range(2)]
    assert sorted(map(tuple, bombed.collect())) == sorted(map(tuple, expected))
    assert qg.inject_links(kept, qg.find_page(pages, "nowhere")).count() == 5
    assert qg.inject_links(kept, 7, copies=3).count() == 14


@pytest.mark.parametrize("copies", [0, 1, 5])
def test_injected_links_are_a_weight(spark, pages, copies):
    edges = edge_frame(spark, [*BOMB_EDGES, *BOMB_EDGES[:3], (1, 7), (1, None), (9, None)])
    for target in (7, qg.find_page(pages, "Lake"), qg.find_page(pages, "nowhere")):
        expected = qg.collapse(qg.inject_links(edges, target, copies)).collect()
        assert sorted(map(tuple, qg.inject_weighted(qg.collapse(edges), target, copies).collect()), key=str) == sorted(map(tuple, expected), key=str)
        single = edges.withColumn("copies", F.lit(1))
        assert sorted(map(tuple, qg.inject_weighted(single, target, copies).collect()), key=str) == sorted(map(tuple, expected), key=str)


def test_weighted_links_rank_like_parallel_ones(graph):
    edges, df = graph
    assert rank_map(qg.pagerank(qg.collapse(df), 6, 0.15)) == pytest.approx(model.pagerank(edges, 6, 0.15))


def test_a_bomb_reads_and_joins_the_links_once(spark, pages, tmp_path):
    edge_frame(spark, BOMB_EDGES).write.parquet(str(tmp_path / "links"))
    edges = spark.read.parquet(str(tmp_path / "links"))
    kept = qg.keyword_subgraph(edges, pages, "surfing").withColumn("copies", F.lit(1))
    executed = executed_plan(qg.inject_weighted(kept, qg.find_page(pages, "Rocky Park")))
    assert executed.count("FileScan parquet") == 1
    assert executed.count("LeftSemi") == 1


def test_the_layout_follows_the_number_of_links(spark, graph):
    assert [layout_width(n, 8) for n in (0, 1, 50_000, 50_001, 10**6, 10**8, 10**12)] == [1, 1, 1, 2, 8, 25, 250_000]
    _, df = graph
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", 200)
        # A few hundred links need one partition, whatever the session is set to.
        assert qg.pagerank(df, 3).rdd.getNumPartitions() == 1
        assert spark.conf.get("spark.sql.shuffle.partitions") == "200"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def recorded_plans(monkeypatch, df, run):
    """The plans of what is checkpointed in ``run``, as text."""
    plans, checkpoint = [], type(df).checkpoint

    def recorded(self, *args, **options):
        plans.append(self._jdf.queryExecution().executedPlan().toString())
        return checkpoint(self, *args, **options)

    with monkeypatch.context() as patch:
        patch.setattr(type(df), "checkpoint", recorded)
        run()
    return plans


def test_a_round_adds_links_up_in_the_order_they_lie_in(spark, graph, monkeypatch):
    _, df = graph
    last = recorded_plans(monkeypatch, df, lambda: qg.pagerank(df, 3, 0.15))[-1]
    # Neither ranks nor links are sorted in a round, and links meet no hash table of sums.
    sums = [line for line in last.splitlines() if "partial_sum(part" in line]
    assert len(sums) == 3 and all("SortAggregate" in line for line in sums)
    assert last.count("ShuffledHashJoin") == 3
    assert spark.conf.get("spark.sql.execution.replaceHashWithSortAgg", "false") == "false"


def test_pages_that_are_kept_are_not_moved_in_a_round(spark, graph, monkeypatch):
    _, df = graph
    last = recorded_plans(monkeypatch, df, lambda: qg.pagerank(df, 3, 0.15, keep_all_pages=True))[-1]
    # A round adds no row for a page that is kept: its sums meet the pages, which wait where these arrive.
    assert "0.0 AS part" not in last and last.count("LeftOuter, BuildRight") == 3


def test_links_are_collapsed_in_many_partitions(spark, graph, monkeypatch):
    _, df = graph
    injected = recorded_plans(monkeypatch, df, lambda: catalog.inject_weighted(spark, "/root/testdata/sf0.001"))
    ranked = recorded_plans(monkeypatch, df, lambda: qg.pagerank(df, 1))
    for plan, shuffles in ((injected[-1], 2), (ranked[0], 1)):
        dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning(src" in line]
        assert len(dealt) == shuffles and all(f", {COLLAPSE_PARTS})" in line for line in dealt)


def test_link_bomb(spark, pages):
    edges = edge_frame(spark, BOMB_EDGES)
    kept = [e for e in BOMB_EDGES if e[0] in (1, 2, 5)]
    expected = model.pagerank(kept + [(src, 3) for src in (1, 2, 5) for _ in range(5)], 25, 0.15)
    got = rank_map(qg.link_bomb(edges, pages, "surfing", "Rocky Park"))
    assert got == pytest.approx(expected)
    listed = qg.top_pages(
        qg.link_bomb(edges, pages, "surfing", "Rocky Park"), qg.bomb_pages(pages, "surfing", "Rocky Park")
    ).collect()
    assert listed[0].page_id == 3 and {r.page_id for r in listed} <= {1, 2, 3, 5}
    plain = rank_map(qg.link_bomb(edges, pages, "surfing", "Rocky Park", copies=0))
    assert plain == pytest.approx(model.pagerank(kept, 25, 0.15))


def test_hubs_over_many_rounds(spark):
    rows = [(i % 9, i * 7 % 31) for i in range(120)]
    edges = spark.createDataFrame(rows, "src bigint, dst bigint")
    plain = qg.pagerank(edges, iterations=10, tax=0.15, checkpoint_every=10)
    hubs = qg.pagerank(edges, iterations=10, tax=0.15, checkpoint_every=10, hot_rows=2)
    expected = {r.page_id: round(r["rank"], 9) for r in plain.collect()}
    assert {r.page_id: round(r["rank"], 9) for r in hubs.collect()} == expected
    pages = spark.createDataFrame([(i, f"t{i}") for i in range(31)], "page_id bigint, title string")
    ranked = [r["rank"] for r in qg.top_pages(hubs, pages, k=None).collect()]
    assert len(ranked) == len(expected) and ranked == sorted(ranked, reverse=True)
