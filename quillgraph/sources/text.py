"""Text sources: lines, articles, link lists, numbered titles and term weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillgraph.functions import text as tx
from quillgraph.operators.numbering import running_total
from quillgraph.sources.shared import packed_checkpoint

# Fixed value: the separator of the fields of an article line.
FIELD_MARK = "<====>"

# Blocks whose offsets are broadcast, a path and three numbers each.
BROADCAST_BLOCKS = 50_000

MODES = ("DROPMALFORMED", "FAILFAST")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row ``(value)`` per line."""
    return spark.read.text(path)


def parse_articles(lines: DataFrame, mode: str = "DROPMALFORMED", col: str = "value") -> DataFrame:
    """Article lines to ``(title, doc_id, text)``.

    Empty lines and records without text are skipped. A mark inside the text
    stays there.
    """
    line = F.col(col)
    head = F.substring_index(line, FIELD_MARK, 2)
    records = _checked(lines.filter(line != ""), head != line, line, mode)
    parts = F.split(line, FIELD_MARK, 3)
    return records.filter(line != F.concat(head, F.lit(FIELD_MARK))).select(
        F.get(parts, F.lit(0)).alias("title"),
        F.get(parts, F.lit(1)).alias("doc_id"),
        F.get(parts, F.lit(2)).alias("text"),
    )


def parse_links(
    lines: DataFrame,
    mode: str = "DROPMALFORMED",
    dedupe: bool = True,
    compat: bool = False,
    col: str = "value",
) -> DataFrame:
    """Link lines ``from: to1 to2`` to one row ``(src, dst)`` per listed target.

    A repeated target gives parallel links. ``dedupe`` drops a line that
    repeats another one for the same page exactly. ``compat`` keeps the empty
    targets that a run of blanks makes, as links to no page (a null target):
    they count in the out-degree and lead nowhere. So do targets that are no
    number; a line without a page is dropped.
    """
    line = F.col(col)
    body = F.rtrim(line, F.lit(":"))
    parts = F.split(body, ":")
    adjacency = _checked(lines, body.contains(":"), line, mode).select(
        F.get(parts, F.lit(0)).alias("page"), tx.trim_control(F.get(parts, F.lit(1))).alias("links")
    )
    if dedupe:
        adjacency = adjacency.distinct()
    listed = adjacency.select("page", F.explode(F.split("links", tx.WHITE)).alias("target"))
    if not compat:
        listed = listed.filter("target <> ''")
    target = F.when(F.col("target") != "", _page_id(F.col("target"), mode))
    edges = listed.select(_page_id(F.col("page"), mode).alias("src"), target.alias("dst"))
    return edges.filter("src is not null")


def number_lines(lines: DataFrame) -> DataFrame:
    """Number the lines of text files from 1: ``(page_id, title)``.

    ``lines`` must come from :func:`read_lines`. Files count in path order.
    """
    frozen, blocks = _blocks(lines)
    shifts = running_total(blocks, "rows", "file", "block").withColumn("shift", F.col("before") - F.col("first"))
    return _shifted(frozen, shifts).select(F.col("line").alias("page_id"), F.col("value").alias("title"))


def locate_lines(lines: DataFrame) -> DataFrame:
    """Each line with its place: ``(file, line, value)``, lines counted from 1 in their file.

    ``file`` is the path of the file; part files of a sorted table stand in
    the order of their paths.
    """
    frozen, blocks = _blocks(lines)
    inside = F.sum("rows").over(Window.partitionBy("file").orderBy("block")) - F.col("rows")
    shifts = blocks.withColumn("shift", inside - F.col("first"))
    return _shifted(frozen, shifts).select("file", "line", "value")


def _blocks(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The lines frozen with their place in the input, and the size of each block.

    The checkpoint makes all that follows see the same blocks. A block then
    needs one offset, the number of lines before it: a running sum over the
    blocks, which are dealt out by ranges of their place or by file.
    """
    placed = lines.select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
    )
    frozen = packed_checkpoint(placed)
    return frozen, frozen.groupBy("file", "block").agg(F.count("*").alias("rows"), F.min("seq").alias("first")).checkpoint()


def _shifted(frozen: DataFrame, shifts: DataFrame) -> DataFrame:
    offsets = shifts.select("file", "block", "shift")
    # Offsets that are broadcast leave the lines where they lie.
    if offsets.count() <= BROADCAST_BLOCKS:
        offsets = F.broadcast(offsets)
    met = frozen.join(offsets, ["file", "block"])
    return met.withColumn("line", F.col("seq") + F.col("shift") + 1)


def read_weights(spark: SparkSession, path: str, mode: str = "DROPMALFORMED", name: str = "value") -> DataFrame:
    """Tab-separated weights to ``(doc_id, unigram, <name>)``; blank lines are skipped."""
    line = F.col("value")
    lines = read_lines(spark, path).filter(line != "")
    # Cut at the tabs: a split would go through a regex twice a line, as the filter below is moved to the scan.
    doc_id, head = F.substring_index(line, "\t", 1), F.substring_index(line, "\t", 2)
    records = _checked(lines, head != line, line, mode)
    weights = records.select(
        doc_id.alias("doc_id"),
        _after(head, doc_id).alias("unigram"),
        _parsed(_after(line, head), "double", mode).alias(name),
    )
    return weights.filter(F.col(name).isNotNull())


def _after(text: Column, head: Column) -> Column:
    """What follows ``head`` and the character behind it."""
    return F.substr(text, F.char_length(head) + 2)


def _page_id(text: Column, mode: str) -> Column:
    return _parsed(text, "bigint", mode)


def _parsed(text: Column, kind: str, mode: str) -> Column:
    parsed = text.try_cast(kind)
    if mode == "FAILFAST":
        problem = F.raise_error(F.concat(F.lit(f"not a {kind}: "), text)).cast(kind)
        return F.when(parsed.isNull(), problem).otherwise(parsed)
    return parsed


def _checked(lines: DataFrame, complete: Column, line: Column, mode: str) -> DataFrame:
    """Drop the lines that are not complete, or fail on them.

    ``complete`` should be a cheap test of the line: Spark moves it to the
    scan, and a test on the split fields would split each line once more.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    if mode == "FAILFAST":
        problem = F.raise_error(F.concat(F.lit("malformed line: "), line)).cast("boolean")
        complete = F.when(complete, F.lit(True)).otherwise(problem)
    return lines.filter(complete)
