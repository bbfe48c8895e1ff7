from __future__ import annotations

import gc
import glob
import re
import time
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

import quillgraph as qg
from quillgraph.__main__ import main
from quillgraph.plans.catalog import QUERIES
from quillgraph.sources.shared import packed_checkpoint, shared_dir
from tests import model
from tests.plans import executed_plan


def frame(spark, lines):
    return spark.createDataFrame([(line,) for line in lines], "value string")


ARTICLES = ["T1<====>1<====>Some text", "", "T2<====>2<====>x<====>y", "T3<====>3<====>", "T4<====>4", "broken"]


def test_articles(spark):
    got = [tuple(r) for r in qg.parse_articles(frame(spark, ARTICLES)).collect()]
    assert got == [("T1", "1", "Some text"), ("T2", "2", "x<====>y")]
    with pytest.raises(PySparkException, match="malformed line: T4"):
        qg.parse_articles(frame(spark, ARTICLES[:5]), mode="FAILFAST").collect()
    assert qg.parse_articles(frame(spark, ARTICLES[:4]), mode="FAILFAST").count() == 2
    with pytest.raises(ValueError):
        qg.parse_articles(frame(spark, ARTICLES), mode="PERMISSIVE")


LINKS = ["1: 2 3 2", "1: 2 3 2", "1: 4", "2:\t5 \x01", "3:  ", "4:", "5", "6: 7 :8", "x: 1", "7: y 9", "8: 1  2", ""]


def test_links(spark):
    got = sorted(map(tuple, qg.parse_links(frame(spark, LINKS)).collect()), key=lambda e: (e[0], e[1] or 0))
    # "y" is no page, but the line lists it: it counts in the out-degree.
    assert got == [(1, 2), (1, 2), (1, 3), (1, 4), (2, 5), (6, 7), (7, None), (7, 9), (8, 1), (8, 2)]
    every = qg.parse_links(frame(spark, LINKS), dedupe=False)
    assert every.count() == len(got) + 3
    literal = qg.parse_links(frame(spark, LINKS), compat=True)
    assert dict(qg.out_degree(literal).collect()) == {1: 4, 2: 1, 3: 1, 6: 1, 7: 2, 8: 3}
    for bad in ("4:", "5", "x: 1", "7: y"):
        with pytest.raises(PySparkException):
            qg.parse_links(frame(spark, [bad]), mode="FAILFAST").collect()
    assert qg.parse_links(frame(spark, ["1: 2"]), mode="FAILFAST").collect() == [(1, 2)]


def test_numbering_across_blocks_and_files(spark, tmp_path):
    lines = [f"title {i} " + "é" * (i % 50) for i in range(20_000)]
    (tmp_path / "titles").mkdir()
    for part, start in enumerate((0, 100, 15_000)):
        end = (100, 15_000, 20_000)[part]
        (tmp_path / "titles" / f"part-{part}.txt").write_text("\n".join(lines[start:end]) + "\n", encoding="utf-8")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 100_000)
    try:
        read = qg.read_lines(spark, str(tmp_path / "titles"))
        assert read.rdd.getNumPartitions() > 5
        got = qg.number_lines(read).orderBy("page_id").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [tuple(r) for r in got] == list(enumerate(lines, 1))


def test_a_bad_target_counts_in_the_out_degree(spark):
    lines = spark.createDataFrame([("1: 2 x 3",), ("y: 4",)], "value string")
    edges = qg.parse_links(lines)
    assert sorted(map(tuple, edges.collect()), key=str) == [(1, 2), (1, 3), (1, None)]
    assert [tuple(r) for r in qg.out_degree(edges).collect()] == [(1, 3)]


def test_tsv_by_key_hash(spark, tmp_path):
    df = spark.createDataFrame([(f"d{i % 7}", f"u{i:03}") for i in range(200)], "doc_id string, unigram string")
    qg.write_tsv(df, str(tmp_path / "t"), partitions=5, key=["doc_id"])
    owners: dict[str, str] = {}
    for part in glob.glob(str(tmp_path / "t" / "part-*")):
        lines = open(part, encoding="utf-8").read().splitlines()
        assert lines == sorted(lines)
        for line in lines:
            assert owners.setdefault(line.split("\t")[0], part) == part
    assert len(owners) == 7


def test_weights_survive_the_text(spark, tmp_path):
    rows = [("1", 'quote"\\', 0.1 + 0.2), ("1", "b", 9.68081259699348e-48), ("2", "c", 1.0)]
    df = spark.createDataFrame(rows, "doc_id string, unigram string, value double")
    qg.write_tsv(df, str(tmp_path / "w"), partitions=2)
    assert sorted(map(tuple, qg.read_weights(spark, str(tmp_path / "w")).collect())) == sorted(rows)
    for part in glob.glob(str(tmp_path / "w" / "part-*")):
        keys = [line.split("\t")[:2] for line in open(part, encoding="utf-8")]
        assert keys == sorted(keys)


def test_weight_lines_are_cut_without_a_regex(spark, tmp_path):
    (tmp_path / "w").write_text("1\té€😀\t0.5\n\t\t1\n2\tb\t\n3\tc\t0.5\t\n4\td\t0.5\tx\n5\t\té\n", encoding="utf-8")
    weights = qg.read_weights(spark, str(tmp_path / "w"))
    assert sorted(map(tuple, weights.collect())) == [("", "", 1.0), ("1", "é€😀", 0.5), ("3", "c", 0.5)]
    assert "split(" not in executed_plan(weights)


def test_bad_weights(spark, tmp_path):
    (tmp_path / "w").write_text("1\ta\t0.5\n\n1\tb\n1\tc\tx\n")
    assert [tuple(r) for r in qg.read_weights(spark, str(tmp_path / "w")).collect()] == [("1", "a", 0.5)]
    with pytest.raises(PySparkException):
        qg.read_weights(spark, str(tmp_path / "w"), mode="FAILFAST").collect()


def test_summary_file_has_blank_lines(spark, tmp_path):
    df = spark.createDataFrame([("1", "A. B. ")], "doc_id string, summary string").coalesce(1)
    qg.write_summaries(df, str(tmp_path / "s"))
    (part,) = glob.glob(str(tmp_path / "s" / "part-*"))
    assert open(part).read() == "1\tA. B. \n\n"


def test_running_count_goes_on(spark, tmp_path):
    source, state = tmp_path / "in", str(tmp_path / "state")
    source.mkdir()
    (source / "a.txt").write_text("to be or\nnot to be\n")

    def run():
        stream = spark.readStream.schema("value string").text(str(source))
        qg.run_word_count(qg.running_word_count(stream), state)
        return {r.word: r.n for r in qg.read_word_count(spark, state).collect()}

    assert run() == {"to": 2, "be": 2, "or": 1, "not": 1}
    (source / "b.txt").write_text("to  do\n")
    assert run() == {"to": 3, "be": 2, "or": 1, "not": 1, "": 1, "do": 1}
    assert run() == {"to": 3, "be": 2, "or": 1, "not": 1, "": 1, "do": 1}


def test_the_map_is_emitted_after_each_batch(spark, tmp_path):
    source, state, out = tmp_path / "in", str(tmp_path / "state"), str(tmp_path / "maps")
    texts = ["to be or", "not to\nbe", "to do"]
    for i, text in enumerate(texts):
        spark.createDataFrame([(text,)], "text string").coalesce(1).write.mode("append").parquet(str(source))
    files = sorted(source.glob("part-*"))

    def run(size):
        stream = qg.stream_table(spark, str(source), "text string", size)
        qg.emit_word_count(qg.running_word_count(qg.explode_lines(stream)), state, out)
        rows = qg.read_emitted(spark, out).collect()
        assert len({(r.batch, r.word) for r in rows}) == len(rows)
        return {b: {r.word: r.n for r in rows if r.batch == b} for b in {r.batch for r in rows}}

    # One byte a batch takes in one file a batch.
    maps = run(1)
    assert len(files) == 3 and sorted(maps) == [0, 1, 2]
    assert maps[2] == {"to": 3, "be": 2, "or": 1, "not": 1, "do": 1}
    assert all(maps[0][w] <= maps[1][w] <= maps[2][w] for w in maps[0]) and sum(maps[1].values()) > sum(maps[0].values())
    # Run again with nothing new: no batch is added. A batch that is replayed replaces its own map.
    assert run(1) == maps
    (tmp_path / "state" / "commits" / "2").unlink()
    (tmp_path / "state" / "commits" / ".2.crc").unlink(missing_ok=True)
    assert run(1) == maps


def test_a_stream_reads_the_table_where_it_lies(spark, tmp_path):
    path, state = str(tmp_path / "table"), str(tmp_path / "state")
    spark.range(5000).selectExpr("concat('w', id % 50) as text").repartition(6).write.parquet(path)
    before = {p.name for p in tmp_path.rglob("*.parquet")}
    qg.run_word_count(qg.running_word_count(qg.explode_lines(qg.stream_table(spark, path, "text string"))), state)
    assert {r.word: r.n for r in qg.read_word_count(spark, state).collect()} == {f"w{i}": 100 for i in range(50)}
    assert {p.name for p in tmp_path.rglob("*.parquet")} == before


def test_lines_by_file(spark, tmp_path):
    (tmp_path / "t").mkdir()
    texts = {"a.txt": [f"a{i}" for i in range(5000)], "b.txt": ["", "x", ""], "c.txt": ["only"]}
    for name, lines in texts.items():
        (tmp_path / "t" / name).write_text("\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 4000)
    try:
        got = qg.locate_lines(qg.read_lines(spark, str(tmp_path / "t"))).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted((r.file.rsplit("/", 1)[1], r.line, r.value) for r in got) == [(n, i, x) for n, lines in texts.items() for i, x in enumerate(lines, 1)]


@pytest.mark.parametrize("most", [0, 50_000])
def test_lines_lie_still_while_they_are_numbered(spark, tmp_path, monkeypatch, most):
    monkeypatch.setitem(qg.locate_lines.__globals__, "BROADCAST_BLOCKS", most)
    path = str(tmp_path / "lines")
    spark.range(3000).selectExpr("cast(id as string) as value").repartitionByRange(3, F.col("value").cast("int")).write.text(path, compression="gzip")
    lines = qg.read_lines(spark, path)
    with qg.session_settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        for numbered in (qg.locate_lines(lines), qg.number_lines(lines)):
            moved = re.findall(r"Exchange hashpartitioning\(file#\d+, block#", executed_plan(numbered))
            assert bool(moved) == (most == 0)
    assert sorted((r.page_id, r.title) for r in qg.number_lines(lines).collect()) == [(i + 1, str(i)) for i in range(3000)]


def size_of(folder):
    return sum(x.stat().st_size for x in folder.rglob("*") if x.is_file())


def test_kept_rows_are_packed(spark):
    df = spark.range(0, 50_000, 1, 3).select(
        "id", F.when(F.col("id") % 7 > 0, F.concat(F.lit("w"), F.col("id") % 50)).alias("w"), (F.col("id") / 8).alias("x"), F.array(F.lit(1)).alias("a")
    )
    shared_dir(spark)
    root = Path(spark.sparkContext.getCheckpointDir().removeprefix("file:"))
    before = size_of(root)
    plain = df.checkpoint()
    between = size_of(root)
    packed = packed_checkpoint(df)
    assert 0 < 3 * (size_of(root) - between) < between - before
    # Every row, in its partition and order, and read again as often as asked.
    placed = [F.spark_partition_id().alias("part"), "*"]
    assert packed.select(*placed).collect() == plain.select(*placed).collect() == packed.select(*placed).collect()
    assert packed.schema == df.schema
    assert packed_checkpoint(df.limit(0)).collect() == []


def test_weights_survive_packed_text(spark, tmp_path):
    rows = [("d", "a", 0.1 + 0.2), ("d", "b", 1e-9), ("é", "c", 3.0)]
    df = spark.createDataFrame(rows, "doc_id string, unigram string, tfidf double")
    qg.write_tsv(df, str(tmp_path / "w"), compression="gzip")
    assert list((tmp_path / "w").glob("*.gz"))
    got = qg.read_weights(spark, str(tmp_path / "w"), name="tfidf")
    assert sorted(map(tuple, got.collect())) == sorted(rows)


def test_a_work_folder_leaves_nothing(spark):
    def there():
        return set(glob.glob(f"{qg.shared_dir(spark)}/work-*"))

    before = there()
    with qg.work_folder(spark) as work:
        path = work.at("numbers")
        spark.range(100).write.parquet(path)
        kept = work.keep(spark.read.parquet(path).filter("id % 2 = 0"))
        assert len(there()) == len(before) + 1
    assert there() == before and kept.count() == 50
    with pytest.raises(ZeroDivisionError), qg.work_folder(spark) as work:
        spark.range(3).write.parquet(work.at("numbers"))
        1 / 0  # noqa: B018
    assert there() == before


@pytest.mark.parametrize("name", ["profile_tsv", "running_word_count", "numbered_titles"])
def test_queries_leave_no_table_behind(spark, name):
    before = set(glob.glob(f"{qg.shared_dir(spark)}/*"))
    assert QUERIES[name](spark, "/root/testdata/sf0.001").count() > 0
    assert {p for p in glob.glob(f"{qg.shared_dir(spark)}/*") if p not in before} == set()


def test_checkpoints_go_with_their_last_use(spark):
    def held():
        return len(glob.glob(f"{spark.sparkContext.getCheckpointDir().removeprefix('file:')}/rdd-*"))

    kept = QUERIES["numbered_titles"](spark, "/root/testdata/sf0.001")
    assert kept.count() > 0 and held() > 0
    del kept
    for _ in range(60):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        if held() == 0:
            break
        time.sleep(0.5)
    # Other tests of this session may hold some still, but not hundreds.
    assert held() < 40


def written(path):
    return [line for part in sorted(glob.glob(f"{path}/part-*")) for line in open(part, encoding="utf-8").read().split("\n")[:-1]]


def test_text_programs(spark, tmp_path, capsys):
    rows = [("1", "The cat. The dog sat. A bird flew away. The end"), ("2", "The bird! x!] sang."), ("3", "No")]
    articles = tmp_path / "articles.txt"
    articles.write_text("\n\n\n".join(f"T{d}<====>{d}<====>{t}" for d, t in rows) + "\n")

    def path(name):
        return str(tmp_path / name)

    main(["profile", str(articles), path("p1"), "--kind", "1", "--keep-empty"])
    words = sorted({u for _, t in rows for u in model.tokens(t)})
    assert written(path("p1")) == words
    main(["profile", str(articles), path("p3"), "--kind", "3"])
    assert written(path("p3"))[0] == "the\t4"
    main(["profile", str(articles), path("p2"), "--kind", "2"])
    assert written(path("p2"))[0] == "1\tthe\t3"

    for name, flags in (("strict", []), ("lax", ["--compat"])):
        main(["weights", str(articles), path(f"tf-{name}"), path(f"idf-{name}"), path(f"w-{name}"), *flags])
        expected = model.tf_idf(rows, compat=bool(flags))
        got = {tuple(line.split("\t")[:2]): float(line.split("\t")[2]) for line in written(path(f"w-{name}"))}
        assert got == pytest.approx(expected)
        main(["summaries", path(f"w-{name}"), str(articles), path(f"s-{name}")])
        lines = written(path(f"s-{name}"))
        assert sorted(line for line in lines if line) == sorted(
            f"{d}\t" + model.summary(t, {u: w for (doc, u), w in expected.items() if doc == d}) for d, t in rows
        )
        assert lines.count("") == len(rows)

    (tmp_path / "plain.txt").write_text("b a b\n")
    main(["word-count", path("plain.txt"), path("wc")])
    assert sorted(written(path("wc"))) == ["a\t1", "b\t2"]


def test_graph_programs(spark, tmp_path, capsys):
    (tmp_path / "links.txt").write_text("1: 2 3\n2: 1\n3: 1 4\n")
    (tmp_path / "titles.txt").write_text("Surfing\nSurfing_2\nPark\nLake\n")
    files = [str(tmp_path / "links.txt"), str(tmp_path / "titles.txt")]
    names = {1: "Surfing", 2: "Surfing_2", 3: "Park", 4: "Lake"}
    edges = [(1, 2), (1, 3), (2, 1), (3, 1), (3, 4)]

    def printed():
        return [line.split(" - ") for line in capsys.readouterr().out.splitlines()]

    for flags, tax in ((["--tax", "0.15"], 0.15), ([], None)):
        main(["pagerank", *files, *flags])
        got = printed()
        expected = model.pagerank(edges, 25, tax)
        assert {title: float(rank) for rank, title in got} == pytest.approx({names[p]: r for p, r in expected.items()})
        assert [float(rank) for rank, _ in got] == sorted((float(rank) for rank, _ in got), reverse=True)
    main(["link-bomb", *files, "surf", "Park"])
    assert printed()[0][1] == "Park"
