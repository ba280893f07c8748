"""The star-schema test tables seen as a talk catalog.

Three views of one table set: *orders* (catalog, recommendations, tag and
speaker paths), *documents* (topic paths, text search) and *events* (learning
statistics). Ids become strings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from talkloom.sources.files import Catalog


def _table(spark: SparkSession, base: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{base}/{name}.parquet")


def orders_catalog(spark: SparkSession, base: str) -> Catalog:
    """Orders as talks, customers as speakers, ordered parts as tags."""
    orders = _table(spark, base, "orders")
    customer = _table(spark, base, "customer")
    order_id = F.col("o_orderkey").cast("string")
    talks = orders.join(customer, orders["o_custkey"] == customer["c_custkey"]).select(
        order_id.alias("id"),
        F.concat(F.lit("order-"), order_id).alias("slug"),
        F.col("c_name").alias("speakers"),
        F.concat(F.lit("Order "), order_id).alias("title"),
        F.concat(F.lit("https://example.org/o/"), order_id).alias("url"),
    )
    details = orders.select(
        order_id.alias("id"),
        F.col("o_orderpriority").alias("description"),
        F.col("o_totalprice").cast("string").alias("duration"),
        F.col("o_orderdate").cast("string").alias("publishedAt"),
    )
    tags = _table(spark, base, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("id"),
        F.concat(F.lit("part-"), F.col("l_partkey").cast("string")).alias("tag"),
    )
    next_order = F.lead("o_orderkey").over(
        Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    )
    related = orders.select(
        order_id.alias("id"), next_order.cast("string").alias("related_id")
    ).where(F.col("related_id").isNotNull())
    return Catalog(talks, details, tags, orders.select(order_id.alias("id")), related)


def documents_catalog(spark: SparkSession, base: str) -> Catalog:
    """Documents as talks, their sources as speakers, their words as tags."""
    documents = _table(spark, base, "documents")
    doc_id = F.col("doc_id").cast("string")
    talks = documents.select(
        doc_id.alias("id"),
        F.concat(F.lit("doc-"), doc_id).alias("slug"),
        F.col("source").alias("speakers"),
        F.concat(F.lit("Document "), doc_id).alias("title"),
        F.concat(F.lit("https://example.org/d/"), doc_id).alias("url"),
    )
    details = documents.select(
        doc_id.alias("id"),
        F.col("text").alias("description"),
        F.col("n_chars").cast("string").alias("duration"),
        F.lit(None).cast("string").alias("publishedAt"),
    )
    words = F.array_distinct(F.split(F.lower("text"), r"[^\p{L}]+"))
    tags = documents.select(doc_id.alias("id"), F.explode(words).alias("tag")).where(
        F.length("tag") >= 2
    )
    empty = documents.select(doc_id.alias("id")).where(F.lit(False))
    return Catalog(talks, details, tags, empty, empty.withColumn("related_id", F.col("id")))


def events_progress(spark: SparkSession, base: str) -> DataFrame:
    """View, click and purchase events as progress rows."""
    kind = F.col("event_type")
    return (
        _table(spark, base, "events")
        .where(kind.isin("view", "click", "purchase"))
        .select(
            F.col("user_id").cast("string").alias("userId"),
            F.get_json_object("props", "$.k").alias("talkId"),
            F.col("value").cast("string").alias("progressSeconds"),
            (kind == "view").alias("watched"),
            (kind == "purchase").alias("completed"),
        )
    )


def events_quizzes(spark: SparkSession, base: str) -> DataFrame:
    """Signup and error events as quiz results; errors lack the completed flag."""
    kind = F.col("event_type")
    return (
        _table(spark, base, "events")
        .where(kind.isin("signup", "error"))
        .select(
            F.col("user_id").cast("string").alias("userId"),
            F.get_json_object("props", "$.k").alias("quizId"),
            F.col("value").cast("string").alias("score"),
            F.when(kind == "signup", F.lit(True)).alias("completed"),
        )
    )
