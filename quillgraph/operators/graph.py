"""Link-graph operators: degrees, PageRank, title search and link injection.

Edges are rows ``(src, dst)``, one per listed link, so parallel links repeat;
weighted links ``(src, dst, copies)`` say how often instead. Pages are rows ``(page_id, title)`` and ranks are rows ``(page_id, rank)``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillgraph.operators import skew
from quillgraph.sources.shared import let_go, session_settings, shared_dir, shuffle_partitions

# Collapsed links of one partition of the layout, about 100 MB; small graphs use
# all cores down to SMALL_SLOT links a partition.
LINKS_PER_SLOT = 4_000_000
SMALL_SLOT = 50_000
# Links are collapsed before their number is known: in this many partitions, of
# which AQE merges small ones up to this size, a million links or two.
COLLAPSE_PARTS = 1024
COLLAPSE_SIZE = "16m"
# Links that lie in the order of their targets are added up without a hash table.
SORTED_SUMS = {"spark.sql.execution.replaceHashWithSortAgg": "true"}


def out_degree(edges: DataFrame) -> DataFrame:
    """Links listed by each page, parallel ones included: ``(page_id, degree)``."""
    return edges.groupBy(F.col("src").alias("page_id")).agg(F.count("*").alias("degree"))


def collapse(edges: DataFrame) -> DataFrame:
    """Parallel links as one row with their number: ``(src, dst, copies)``. Weighted links are added up."""
    copies = F.sum("copies") if "copies" in edges.columns else F.count("*")
    return edges.groupBy("src", "dst").agg(copies.alias("copies"))


def frozen_links(links: DataFrame) -> DataFrame:
    """Weighted links, which :func:`collapse` or :func:`inject_weighted` made, collapsed and checkpointed.

    The session's number of shuffle partitions is a lower limit only, so what
    one task holds in its hash tables does not grow with the links, up to
    ``COLLAPSE_PARTS`` times ``COLLAPSE_SIZE`` of them as shuffled.
    """
    spark = links.sparkSession
    shared_dir(spark)
    parts = max(COLLAPSE_PARTS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    merged = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": COLLAPSE_SIZE}
    with shuffle_partitions(spark, parts), session_settings(spark, merged):
        return links.checkpoint()


def layout_width(links: int, cores: int) -> int:
    """Partitions that a number of collapsed links is laid out in."""
    return max(1, -(-links // LINKS_PER_SLOT), min(cores, -(-links // SMALL_SLOT)))


def dead_ends(edges: DataFrame) -> DataFrame:
    """Pages that are linked to and list no link themselves: ``(page_id)``."""
    targets = edges.select(F.col("dst").alias("page_id")).filter("page_id is not null").distinct()
    sources = edges.select(F.col("src").alias("page_id")).distinct()
    return targets.join(sources, "page_id", "left_anti")


def pagerank(
    edges: DataFrame,
    iterations: int = 25,
    tax: float | None = None,
    keep_all_pages: bool = False,
    checkpoint_every: int = 5,
    hot_rows: int | None = None,
    hot_keys: int | None = None,
) -> DataFrame:
    """Ranks after a fixed number of rounds: ``(page_id, rank)``.

    Every page with links starts at 1. A round sends ``rank / out-degree``
    along each link and adds up what arrives; with ``tax`` the sum ``s``
    becomes ``tax + (1 - tax) * s``. A page that nothing arrives at has no
    rank for the next round, unless ``keep_all_pages`` is set: then every page
    named in the edges is ranked in every round. A null target counts in the
    out-degree and receives nothing.

    ``edges`` may be weighted links. They are laid out by source once and
    kept, in as many partitions as their number asks for, whatever the session
    is set to, and in the order of their targets inside each. Ranks come out of
    a round partitioned the same way and are looked up by hash, so the
    contributions stay in that order: they are added up per task as they pass,
    and a round shuffles these sums only. Sources that hold a large share
    of the links stay out of that layout and meet their ranks, at most
    ``HOT_KEYS`` rows, by broadcast. Every ``checkpoint_every`` rounds, with
    such sources every round, the ranks are checkpointed to the shared folder.
    """
    shared_dir(edges.sparkSession)
    held: list[DataFrame] = []
    try:
        return _rounds(edges, iterations, tax, keep_all_pages, checkpoint_every, (hot_rows, hot_keys), held)
    finally:
        for df in held:
            df.unpersist()


def _rounds(
    edges: DataFrame,
    iterations: int,
    tax: float | None,
    keep_all_pages: bool,
    checkpoint_every: int,
    limits: tuple[int | None, int | None],
    held: list[DataFrame],
) -> DataFrame:
    def hold(df: DataFrame) -> DataFrame:
        held.append(df.persist(StorageLevel.MEMORY_AND_DISK))
        # Only rows that are there already tell a plan how they are dealt out and sorted.
        df.count()
        return df

    spark = edges.sparkSession
    links = frozen_links(collapse(edges))
    width = layout_width(links.count(), spark.sparkContext.defaultParallelism)
    let_go(spark)
    with shuffle_partitions(spark, width), session_settings(spark, SORTED_SUMS):
        return _laid_out(links, width, iterations, tax, keep_all_pages, checkpoint_every, limits, hold)


def _laid_out(
    links: DataFrame,
    width: int,
    iterations: int,
    tax: float | None,
    keep_all_pages: bool,
    checkpoint_every: int,
    limits: tuple[int | None, int | None],
    hold: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    sources = links.groupBy("src").agg(F.sum("copies").alias("degree"), F.count("*").alias("links")).checkpoint()
    hot = _hot_sources(sources, *limits)

    weight = F.col("copies") / F.col("degree")
    cold_links = links if hot is None else links.join(F.broadcast(hot), "src", "left_anti")
    cold = hold(
        cold_links.repartition(width, "src")
        .join(sources, "src")
        .filter("dst is not null")
        .select("src", "dst", weight.alias("weight"))
        .sortWithinPartitions("dst")
    )
    if hot is not None:
        hot_sources = sources.join(F.broadcast(hot), "src", "left_semi")
        hot_links = links.join(F.broadcast(hot_sources), "src").filter("dst is not null")
        hot_links = hold(hot_links.select("src", "dst", weight.alias("weight")))

    start = sources.select(F.col("src").alias("page_id"))
    if keep_all_pages:
        targets = links.select(F.col("dst").alias("page_id")).filter("page_id is not null")
        # Dealt out as the sums are, so that a round has no page moved for being kept.
        start = hold(start.unionByName(targets).distinct().repartition(width, "page_id"))
    ranks = start.withColumn("rank", F.lit(1.0))

    for done in range(1, iterations + 1):
        sent = _contributions(ranks.hint("shuffle_hash"), cold)
        if hot is not None:
            hot_ranks = ranks.join(F.broadcast(hot), F.col("page_id") == F.col("src"), "left_semi")
            sent = sent.unionByName(_contributions(F.broadcast(hot_ranks), hot_links))
        sums = sent.groupBy("page_id").agg(F.sum("part").alias("total"))
        total = F.col("total")
        if keep_all_pages:
            sums = start.join(sums.hint("shuffle_hash"), "page_id", "left")
            total = F.coalesce(total, F.lit(0.0))
        rank = total if tax is None else F.lit(tax) + F.lit(1.0 - tax) * total
        ranks = sums.select("page_id", rank.alias("rank"))
        # With hubs a round reads the ranks twice, so they are computed once and kept.
        if done < iterations and (hot is not None or done % checkpoint_every == 0):
            ranks = ranks.checkpoint()
            # The shuffles of the rounds before are of no more use.
            del sent, sums
            let_go(links.sparkSession)
    return ranks.checkpoint()


def _contributions(ranks: DataFrame, links: DataFrame) -> DataFrame:
    joined = links.join(ranks, links["src"] == ranks["page_id"])
    return joined.select(F.col("dst").alias("page_id"), (F.col("rank") * F.col("weight")).alias("part"))


def _hot_sources(sources: DataFrame, hot_rows: int | None, hot_keys: int | None) -> DataFrame | None:
    """Sources with a large share of all links as ``(src)``, None if there are none."""
    hot = skew.hot_keys(sources, F.col("src"), "links", hot_rows, hot_keys)
    hot = hot.select(F.col("key").alias("src")).checkpoint()
    return None if hot.isEmpty() else hot


def with_titles(ranks: DataFrame, pages: DataFrame) -> DataFrame:
    """Ranks of the pages that have a title: ``(page_id, title, rank)``."""
    return ranks.join(pages, "page_id").select("page_id", "title", "rank")


def top_pages(ranks: DataFrame, pages: DataFrame, k: int | None = 10, compat: bool = False) -> DataFrame:
    """The ``k`` best pages with their title, by rank descending; all of them if ``k`` is None.

    ``compat`` compares the ranks as text instead of as numbers.
    """
    order = F.col("rank").cast("string") if compat else F.col("rank")
    ranked = with_titles(ranks, pages).orderBy(order.desc(), "page_id")
    return ranked if k is None else ranked.limit(k)


def search_titles(pages: DataFrame, keyword: str) -> DataFrame:
    """Pages whose title holds the keyword, upper and lower case alike."""
    return pages.filter(F.upper("title").contains(F.upper(F.lit(keyword))))


def find_page(pages: DataFrame, title: str) -> DataFrame:
    """The page with exactly this title, the lowest id of several: one row ``(page_id)``."""
    return pages.filter(F.col("title") == title).agg(F.min("page_id").alias("page_id"))


def keyword_subgraph(edges: DataFrame, pages: DataFrame, keyword: str) -> DataFrame:
    """The links listed by pages whose title holds the keyword."""
    hits = search_titles(pages, keyword).select(F.col("page_id").alias("src"))
    return edges.join(hits, "src", "left_semi")


def inject_links(edges: DataFrame, target: int | DataFrame, copies: int = 5) -> DataFrame:
    """Let every page that lists links also link ``copies`` times to the target.

    ``target`` is a page id or the one row of :func:`find_page`. A page that
    does not exist gets no links.
    """
    target_id: Column = target.scalar() if isinstance(target, DataFrame) else F.lit(target)
    bought = edges.select("src").distinct().select(
        "src", F.explode(F.array_repeat(target_id.cast("bigint"), copies)).alias("dst")
    )
    return edges.unionByName(bought.filter("dst is not null"))


def inject_weighted(links: DataFrame, target: int | DataFrame, copies: int = 5) -> DataFrame:
    """As :func:`inject_links`, on weighted links and as a weight: ``(src, dst, copies)``, collapsed.

    Each link row carries its page's new link along, and the new links of a
    page are counted once where rows meet, so the links are read, joined and
    shuffled once. They are combined per task before that shuffle.
    """
    target_id = (target.scalar() if isinstance(target, DataFrame) else F.lit(target)).cast("bigint")
    own = F.struct(F.col("dst").cast("bigint").alias("dst"), F.col("copies").cast("bigint").alias("own"), F.lit(0).alias("bought"))
    new = F.struct(target_id.alias("dst"), F.lit(0).cast("bigint").alias("own"), F.lit(copies).alias("bought"))
    both = F.when(target_id.isNotNull() & F.lit(copies > 0), F.array(own, new)).otherwise(F.array(own))
    met = links.select("src", F.inline(both)).groupBy("src", "dst")
    return met.agg((F.sum("own") + F.max("bought")).alias("copies"))


def link_bomb(
    edges: DataFrame,
    pages: DataFrame,
    keyword: str,
    target_title: str,
    copies: int = 5,
    iterations: int = 25,
    tax: float = 0.15,
    **options,
) -> DataFrame:
    """Taxed ranks of the keyword sub-graph after links to the target were injected.

    All reached pages are ranked. To list the target among the pages with the
    keyword, pass :func:`bomb_pages` to :func:`top_pages`. The links are read
    and joined with the titles once; injected ones are a weight.
    """
    kept = keyword_subgraph(edges, pages, keyword)
    if "copies" not in kept.columns:
        kept = kept.withColumn("copies", F.lit(1).cast("bigint"))
    bombed = inject_weighted(kept, find_page(pages, target_title), copies)
    return pagerank(bombed, iterations, tax, **options)


def bomb_pages(pages: DataFrame, keyword: str, target_title: str) -> DataFrame:
    """The pages with the keyword in their title, and the target page."""
    is_target = F.col("page_id") == find_page(pages, target_title).scalar()
    has_keyword = F.upper("title").contains(F.upper(F.lit(keyword)))
    return pages.filter(has_keyword | F.coalesce(is_target, F.lit(False)))
