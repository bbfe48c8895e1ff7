"""Mix sources to target weights by a low-discrepancy schedule.

A mix is a sequence of slots of equal numbers of words. Slot ``i`` belongs to
the source whose share of [0, 1) holds ``frac(i * golden ratio)``, so that
every stretch of the mix has about the target shares. The r-th slot of a
source takes its r-th block; blocks are cut from the source's documents in an
order shuffled by hash, and start anew when all were taken.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillgraph.llm.common import WORD, shuffle_width
from quillgraph.sources.shared import shared_dir

#: Words of a slot and of a block.
BLOCK = 512
#: Fixed value: the fractional part of the golden ratio, 2**32 times, rounded to an odd number.
GOLDEN = 2654435769
#: Rows that one window of a running sum should get.
RUN = 50_000
#: Cells of [0, 1) by which slots meet the sources' shares.
CELLS = 4096

COLUMNS = ("doc_id", "source", "size", "source_size", "target")


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its n-th word, with what is between the words."""
    pieces = F.split(text, "(?<=[\\x20\\x09-\\x0D])(?=[^\\x20\\x09-\\x0D])")
    blank = (~F.element_at(pieces, 1).rlike(WORD)).cast("int")
    return F.regexp_replace(F.array_join(F.slice(pieces, 1, n + blank), ""), "[\\x20\\x09-\\x0D]+\\z", "")


def ranked(sources: DataFrame) -> DataFrame:
    """Adds ``rank`` from 0 to ``(source, ...)``, by code point, null last.

    Rows are ordered by ranges; only the number of rows of each range, as many
    as there are partitions, comes to the driver.
    """
    spark = sources.sparkSession
    order = [F.col("source").isNull(), F.col("source")]
    laid = sources.repartitionByRange(shuffle_width(spark), *order).sortWithinPartitions(*order)
    numbered = laid.select("*", F.monotonically_increasing_id().alias("_at")).checkpoint()
    part = F.shiftright("_at", 33)
    sizes = sorted((r["part"], r["n"]) for r in numbered.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect())
    shift, seen = [], 0
    for p, n in sizes:
        shift += [F.lit(p), F.lit(seen)]
        seen += n
    if not shift:
        return numbered.withColumn("rank", F.col("_at")).drop("_at")
    before = F.element_at(F.create_map(*shift), part)
    return numbered.withColumn("rank", (before + F.col("_at").bitwiseAND((1 << 33) - 1)).cast("long")).drop("_at")


def targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """Adds ``rank``, ``weight`` and ``target`` to ``(source, source_size)``, one row per source.

    Weights repeat in the order of the sources. All words are shared by
    weight; no target exceeds ``most`` times its source's size, and what is
    over is shared again by weight until none does.
    """
    rows = ranked(sizes.select("source", "source_size"))
    given = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    rows = rows.withColumn("weight", given.cast("double")).checkpoint()
    limit = F.col("source_size") * most
    level, capped = 0.0, -1
    while True:
        full = (limit < F.col("weight") * level) if level else F.lit(False)
        free = F.when(~full, F.col("weight"))
        total, taken, open_weight, n = rows.agg(F.sum("source_size"), F.sum(F.when(full, limit)), F.sum(free), F.count(F.when(full, 1))).first()
        if not open_weight or n == capped:
            break
        level, capped = ((total or 0) - (taken or 0)) / open_weight, n
    return rows.withColumn("target", F.least(limit.cast("double"), F.col("weight") * level))


def _running(rows: DataFrame, keys: list[str], order: list[Column], bucket: Column, value: str, name: str) -> DataFrame:
    """Adds the sum of ``value`` over all rows before a row within its keys.

    Rows of a key are cut into ``bucket`` ranges that agree with the order, so
    that no window holds all rows of a frequent key: the sums of the buckets
    are added up first.
    """
    rows = rows.withColumn("_bucket", bucket)
    sums = rows.groupBy(*keys, "_bucket").agg(F.sum(value).alias("_sum"))
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*keys, "_bucket", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy(*keys, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return placed.join(sums, [*keys, "_bucket"]).withColumn(name, F.col("_base") + F.col("_inside")).drop("_bucket", "_base", "_inside")


def _bits(n: int) -> int:
    """Leading bits of a hash that leave about RUN of n rows for each of their values."""
    return max(0, math.ceil(math.log2(max(1, n / RUN))))


def slots(spark: SparkSession, sources: DataFrame, total: int, block: int = BLOCK) -> DataFrame:
    """The schedule of a mix: ``(slot, rank, block, n)``, in no order.

    ``sources (rank, source_size, words)`` has the whole words to take of each
    source, ``total`` is their sum. A slot takes the first ``n`` words of a
    block of the source with that ``rank``. Slots beyond a source's words are
    left out or cut short; where the sequence falls short of them, which it
    does by some slots at most, closing slots with a null ``slot`` follow.
    """
    ends = _running(sources.filter("words > 0"), [], [F.col("rank")], F.shiftright("rank", 12), "words", "_from")
    shares = ends.withColumn("_to", F.col("_from") + F.col("words")).withColumns(
        {"_blocks": F.ceil(F.col("source_size") / block), "_low": F.col("_from") / total, "_high": F.col("_to") / total}
    )
    cells = shares.withColumn(
        "_cell", F.explode(F.sequence(F.floor(F.col("_low") * CELLS), F.least(F.floor(F.col("_high") * CELLS), F.lit(CELLS - 1))))
    )
    point = ((F.col("id") % (1 << 31)) * GOLDEN % (1 << 32)) / (1 << 32)
    points = spark.range(math.ceil(total / block)).select(F.col("id").alias("slot"), point.alias("_point"))
    points = points.withColumn("_cell", F.floor(F.col("_point") * CELLS))
    drawn = points.join(cells, "_cell").filter("_low <= _point and _point < _high").drop("_cell", "_point", "_low", "_high", "_from", "_to")
    order = _running(drawn.withColumn("_one", F.lit(1)), ["rank"], [F.col("slot")], F.shiftright("slot", 16), "_one", "_nth")
    counts = drawn.groupBy("rank").agg(F.count("*").alias("_drawn"))
    last = F.floor((F.col("words") - 1) / F.col("source_size"))
    last = last * F.col("_blocks") + F.floor((F.col("words") - 1 - last * F.col("source_size")) / block)
    closing = (
        shares.join(counts, "rank", "left")
        .withColumns({"_drawn": F.coalesce("_drawn", F.lit(0)), "_last": last})
        .filter("_last >= _drawn")
        .withColumn("_nth", F.explode(F.sequence("_drawn", "_last")))
    )
    columns = ["slot", "rank", "source_size", "words", "_blocks", "_nth"]
    both = order.select(*columns).unionByName(closing.withColumn("slot", F.lit(None).cast("long")).select(*columns))
    taken = both.withColumn("block", (F.col("_nth") % F.col("_blocks")).cast("long"))
    start = F.floor(F.col("_nth") / F.col("_blocks")) * F.col("source_size") + F.col("block") * block
    n = F.least(F.col("words") - start, F.col("source_size") - F.col("block") * block, F.lit(block))
    return taken.withColumn("n", n.cast("long")).filter("n > 0").select("slot", "rank", "block", "n")


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3, block: int = BLOCK) -> DataFrame:
    """What a mix takes of each document: ``(doc_id, source, size, source_size, target, taken)``.

    ``size`` counts the words of the whole text, ``taken`` the words that the
    slots take of it, repeats counted, so ``taken`` is at most ``most`` times
    ``size``. The words taken of a source are its target, rounded down. A null
    text has no words; a null source is a source; repeated rows are mixed
    each; an empty table gives no rows; other columns are not looked at. The
    text is read once and never shuffled.
    """
    spark = docs.sparkSession
    shared_dir(spark)
    mixed = F.xxhash64("doc_id", F.lit(20))
    sizes = docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), mixed.alias("_mixed")).checkpoint()
    rows = sizes.count()
    per_source = targets(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most)
    per_source = per_source.withColumn("words", F.floor("target").cast("long")).checkpoint()
    total = per_source.agg(F.sum("words")).first()[0] or 0
    known = per_source.withColumnRenamed("source", "_source")
    placed = sizes.join(known, sizes["source"].eqNullSafe(known["_source"])).drop("_source", "words", "weight")
    bits = _bits(rows)
    bucket = F.shiftright("_mixed", 64 - bits) if bits else F.lit(0)
    placed = _running(placed, ["rank"], [F.col("_mixed"), F.col("doc_id"), F.col("size")], bucket, "size", "_start").drop("_mixed")
    if not total:
        return placed.select(*COLUMNS, F.lit(0).cast("long").alias("taken"))
    end = F.col("_start") + F.col("size")
    placed = placed.checkpoint()
    cut = placed.filter("size > 0").withColumn(
        "block", F.explode(F.sequence(F.floor(F.col("_start") / block), F.floor((end - 1) / block)))
    )
    low, high = F.greatest(F.col("_start") - F.col("block") * block, F.lit(0)), F.least(end - F.col("block") * block, F.lit(block))
    uses = slots(spark, per_source, total, block).select("rank", "block", "n")
    part = F.greatest(F.least("n", high) - low, F.lit(0))
    taken = cut.join(uses, ["rank", "block"]).groupBy("rank", "_start").agg(F.sum(part).cast("long").alias("taken"))
    # A document without words shares its start with the next one, and takes nothing.
    some = placed.join(taken, ["rank", "_start"], "left")
    return some.select(*COLUMNS, F.when(F.col("size") > 0, F.coalesce("taken", F.lit(0))).otherwise(0).cast("long").alias("taken"))
