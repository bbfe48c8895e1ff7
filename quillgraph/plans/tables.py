"""Load the tables that the registered queries run on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus: ``(doc_id, text, source)``."""
    return table(spark, sf_dir, "documents").select("doc_id", "text", "source")


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A link graph from all line items: ``(src, dst)``.

    Parts are the even page ids, orders the odd ones. By return flag, an order
    links to the part (N), the part to the order (A), or the part to the part
    numbered as its supplier (R). The last rule makes hubs; orders without a
    line of one kind are dead ends or pages nobody links to.
    """
    part = F.col("l_partkey") * 2
    order = F.col("l_orderkey") * 2 + 1
    flag = F.col("l_returnflag")
    return table(spark, sf_dir, "lineitem").select(
        F.when(flag == "N", order).otherwise(part).alias("src"),
        F.when(flag == "N", part).when(flag == "A", order).otherwise(F.col("l_suppkey") * 2).alias("dst"),
    )


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages of the link graph: ``(page_id, title)``."""
    parts = table(spark, sf_dir, "part").select((F.col("p_partkey") * 2).alias("page_id"), F.col("p_name").alias("title"))
    orders = table(spark, sf_dir, "orders").select(
        (F.col("o_orderkey") * 2 + 1).alias("page_id"), F.concat(F.lit("order "), F.col("o_orderkey")).alias("title")
    )
    return parts.unionByName(orders)
