"""The registered queries of this subpackage, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable
from string import ascii_lowercase, ascii_uppercase

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillgraph.llm import hardneg, hnsw, langid, merkle, mixing, ngramjoin, quality, suffixdedup, tokencount, topk, toxicity, urlfilter, vectors, wordbpe
from quillgraph.llm.common import fold, table

Query = Callable[[SparkSession, str], DataFrame]

#: The editors' rules of the URL filter.
RULES = [
    urlfilter.Rule("org/", "allow"),
    urlfilter.Rule("example.org/es/", "block"),
    urlfilter.Rule("example.org/en/1", "block"),
    urlfilter.Rule("com/fr/", "allow"),
    urlfilter.Rule("com/de/", "block"),
]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(table(spark, sf_dir, "pages"), RULES)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = suffixdedup.remove_repeats(table(spark, sf_dir, "documents"), length=400)
    left = F.make_valid_utf8(F.col("kept").cast("string")).alias("text")
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), left)


def _judged(scored: DataFrame, held_out: Column) -> DataFrame:
    predicted = (F.col("score") >= 0.5).cast("int").alias("predicted")
    return scored.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", predicted)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = fold(F.col("doc_id"), 5) == 0
    return _judged(toxicity.score(docs, toxicity.fit(docs, labels, ~held_out)), held_out)


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    file = public_tokenizers.path("byte_bpe_50k.json")
    encoded = wordbpe.encode(table(spark, sf_dir, "documents"), file)
    return wordbpe.decode(encoded, file).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256")
    )


def op6_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = vectors.valid(table(spark, sf_dir, "embeddings"))
    return hnsw.nearest(rows, rows.filter("vec_id % 100 = 0"), k=10)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source")


def op8_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = topk.quantized(vectors.valid(table(spark, sf_dir, "embeddings"), zero=True))
    return topk.top_k(rows, rows.filter("vec_id % 50 = 0"), k=5)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = fold(F.col("doc_id"), 3) == 1
    return _judged(quality.score(docs, quality.fit(docs, labels, ~held_out)), held_out)


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = ngramjoin.join(table(spark, sf_dir, "documents"), n=4, percent=85)
    return groups.select("doc_id", "n_shingles", "component_id")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = hardneg.labelled(table(spark, sf_dir, "embeddings"), moved)
    return hardneg.mine(rows, rows.filter("vec_id % 50 = 0"))


#: What a leaf of the manifest covers, in this order.
LEAF_COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    lowered = F.translate("text", ascii_uppercase, ascii_lowercase)
    tampered = merkle.leaf([lowered if c == "text" else F.col(c) for c in LEAF_COLUMNS])
    claimed = F.when(fold(F.col("doc_id"), 5) == 0, tampered).otherwise(merkle.leaf([F.col(c) for c in LEAF_COLUMNS]))
    proofs = merkle.prove(merkle.manifest(docs, LEAF_COLUMNS, claimed=claimed))
    folded = proofs.withColumn("folded_root", merkle.fold(F.col("claimed"), F.col("path"), F.col("places")))
    proof = F.sha2(F.concat_ws("", "path").cast("binary"), 256).alias("proof_sha256")
    return folded.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", proof, "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold(F.col("doc_id"), 4) == 2
    judged = langid.score(docs, langid.fit(docs, ~held_out))
    return judged.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score")


QUERIES: dict[str, Query] = {
    q.__name__: q
    for q in (
        op1_url_filter,
        op2_token_counts,
        op3_suffix_dedup,
        op4_toxicity,
        op5_bpe,
        op6_hnsw,
        op7_mixing,
        op8_top_k,
        op9_quality,
        op10_ngram_join,
        op11_hard_negatives,
        op12_merkle,
        op13_language_id,
    )
}
