"""Rating table: own ratings, duplicates, activity thresholds, top lists.

Ratings are ``(user_id, book_id, rating)``; ``book_id`` is ``books.id``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelftalk.operators.tables import top

COLUMNS = ("user_id", "book_id", "rating")


def own_rows(own: DataFrame, books: DataFrame, user_id: int) -> DataFrame:
    """Ratings given by title, as rating rows of user ``user_id``.

    A title shared by several books rates each of them; unknown titles drop out.
    """
    return own.join(books.select("title", "id"), "title").select(
        F.lit(user_id).cast("long").alias("user_id"), F.col("id").alias("book_id"), "rating"
    )


def merge_own(ratings: DataFrame, own: DataFrame, books: DataFrame, user_id: int) -> DataFrame:
    return ratings.select(*COLUMNS).unionByName(own_rows(own, books, user_id))


def duplicate_report(ratings: DataFrame) -> DataFrame:
    """Number of ratings per (user, book)."""
    return ratings.groupBy("user_id", "book_id").agg(F.count("rating").alias("n_ratings"))


def collapse(ratings: DataFrame) -> DataFrame:
    """One row per (user, book): the mean, rounded half to even.

    One aggregation replaces the mean table, the join back and the de-duplication. Copies
    of a pair are combined before the shuffle.
    """
    return ratings.groupBy("user_id", "book_id").agg(
        F.bround(F.avg("rating"), 0).alias("rating")
    )


def ratings_per(ratings: DataFrame, key: str, name: str) -> DataFrame:
    return ratings.groupBy(key).agg(F.count("rating").alias(name))


def keep_active(ratings: DataFrame, more_than: int = 20) -> DataFrame:
    """Ratings of users with more than ``more_than`` ratings."""
    kept = ratings_per(ratings, "user_id", "n").where(F.col("n") > more_than)
    return ratings.join(kept.select("user_id"), "user_id", "left_semi")


def keep_popular(ratings: DataFrame, at_least: int = 30) -> DataFrame:
    """Ratings of books with at least ``at_least`` ratings; users are not re-checked."""
    kept = ratings_per(ratings, "book_id", "n").where(F.col("n") >= at_least)
    return ratings.join(kept.select("book_id"), "book_id", "left_semi")


def with_totals(ratings: DataFrame, key: str, name: str) -> DataFrame:
    """Every rating with the number of ratings of its user or book.

    ``ratings`` should be a stored table; it is read for the counts and for the rows.
    """
    return ratings.join(ratings_per(ratings, key, name), key)


def top_rated(ratings: DataFrame, books: DataFrame, n: int = 10) -> DataFrame:
    """Books by mean rating. Means are taken first, so the join sees one row per book."""
    means = ratings.groupBy("book_id").agg(F.avg("rating").alias("mean_rating"))
    named = means.join(
        books.select(F.col("id").alias("book_id"), "authors", "title"), "book_id", "left"
    )
    return top(named, "mean_rating", n, "book_id")


def catalogue_top(books: DataFrame, n: int = 20) -> DataFrame:
    """Books by their stored average rating."""
    listed = books.select("id", "authors", "title", "average_rating", "ratings_count")
    return top(listed, "average_rating", n, "id")
