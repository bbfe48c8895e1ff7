"""Command line of the batch programs: ``python -m quillgraph <program> ...``."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from quillgraph.plans import jobs


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="quillgraph")
    programs = top.add_subparsers(dest="program", required=True)

    def program(name: str, *paths: str) -> argparse.ArgumentParser:
        sub = programs.add_parser(name)
        for path in paths:
            sub.add_argument(path)
        return sub

    program("word-count", "lines", "out")
    profile = program("profile", "articles", "out")
    profile.add_argument("--kind", type=int, choices=(1, 2, 3), required=True)
    profile.add_argument("--keep-empty", action="store_true")
    program("weights", "articles", "tf_out", "idf_out", "weights_out").add_argument("--compat", action="store_true")
    program("summaries", "weights", "articles", "out")
    rank = program("pagerank", "links", "titles")
    rank.add_argument("--tax", type=float)
    rank.add_argument("--k", type=int, default=10)
    rank.add_argument("--compat", action="store_true")
    rank.add_argument("--out", help="write all pages there as text instead of printing the best")
    bomb = program("link-bomb", "links", "titles", "keyword", "target")
    bomb.add_argument("--copies", type=int, default=5)
    bomb.add_argument("--k", type=int, default=10)
    bomb.add_argument("--every-page", action="store_true")
    return top


PROGRAMS = {
    "word-count": jobs.word_count,
    "profile": jobs.profile,
    "weights": jobs.weights,
    "summaries": jobs.summaries,
    "pagerank": jobs.ranked_pages,
    "link-bomb": jobs.bombed_pages,
}


def main(arguments: Sequence[str] | None = None) -> None:
    options = vars(parser().parse_args(arguments))
    program = PROGRAMS[options.pop("program")]
    out = options.pop("out") if program is jobs.ranked_pages else None
    if out is not None:
        options["k"] = None
    builder = SparkSession.builder.appName("quillgraph").config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    result = program(builder.getOrCreate(), **options)
    if out is not None:
        result.write.text(out)
    elif isinstance(result, DataFrame):
        # A ranked list has k lines.
        for row in result.collect():
            print(row.line)


if __name__ == "__main__":
    main()
