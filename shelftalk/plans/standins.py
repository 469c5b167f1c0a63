"""The given tables seen as ratings, books, tags, dialogs and pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelftalk.operators.ordering import dense_index
from shelftalk.sources.scratch import spread

USER = 55_000  # user id given to the own ratings
STOP_WORDS = ("the", "and", "of", "new")
GENRES = (
    "red", "blue", "small", "large", "ring", "gear", "bolt", "anvil", "widget",
    "hot", "cold", "new", "fantasy", "poetry",
)
PRIORITY_NUMBERS = {"1-URGENT": 5, "2-HIGH": 4, "3-MEDIUM": 3, "5-LOW": 1}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A customer rates the suppliers of ordered items, 1 to 5 by quantity."""
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_quantity")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return items.join(orders, items.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").alias("user_id"),
        F.col("l_suppkey").alias("book_id"),
        F.ceil(F.col("l_quantity") / 10).cast("int").alias("rating"),
    )


def books(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as books; the two id spaces differ, as they do for books."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    supplier = table(spark, sf_dir, "supplier")
    return supplier.join(nation, supplier.s_nationkey == nation.n_nationkey).select(
        F.col("s_suppkey").alias("id"),
        (F.col("s_suppkey") + 100_000).alias("book_id"),
        F.col("n_name").alias("authors"),
        F.col("s_name").alias("title"),
        F.col("s_acctbal").alias("average_rating"),
        F.col("s_nationkey").cast("long").alias("ratings_count"),
    )


def own(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One user's ratings by title, one from every supplier; only titles that some book has find
    one (every third supplier's)."""
    number = F.lpad((3 * F.col("s_suppkey")).cast("string"), 9, "0")
    return table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("Supplier#"), number).alias("title"),
        (1 + F.col("s_nationkey") % 5).cast("int").alias("rating"),
    )


def part_books(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"),
        (F.col("p_partkey") + 1_000_000).alias("book_id"),
        F.col("p_brand").alias("authors"),
        F.col("p_name").alias("title"),
    )


def _part_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.posexplode(F.split("p_name", " ")).alias("at", "tag_name")
    )


def tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = _part_words(spark, sf_dir).select("tag_name").distinct()
    return dense_index(names, ["tag_name"], "tag_id")


def book_tags(spark: SparkSession, sf_dir: str, tag_table: DataFrame) -> DataFrame:
    return _part_words(spark, sf_dir).join(tag_table, "tag_name").select(
        (F.col("p_partkey") + 1_000_000).alias("goodreads_book_id"),
        "tag_id",
        (F.col("p_partkey") * 16 + F.col("at")).alias("pos"),
    )


def genres(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(g,) for g in GENRES], "tag_name string")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    return spread(docs, "id")


def utterances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select(
        "conv_id", F.col("turn").alias("pos"), "text"
    )


def genre_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages with every local link below ``/genres``."""
    moved = F.replace("html", F.lit('href="/'), F.lit('href="/genres/'))
    return pages(spark, sf_dir).withColumn("html", moved)


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "pages"), "page_id")
