"""Recommendation flows: from raw tables to titles."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelftalk.operators import collab, content, ratings as R
from shelftalk.sources.scratch import materialize


def clean_ratings(
    ratings: DataFrame,
    books: DataFrame,
    own: DataFrame | None = None,
    user_id: int = 55_000,
    more_than: int = 20,
    at_least: int = 30,
) -> DataFrame:
    """Own ratings merged, duplicates collapsed, inactive users and rare books removed."""
    merged = ratings if own is None else R.merge_own(ratings, own, books, user_id)
    collapsed = materialize(R.collapse(merged))
    active = materialize(R.keep_active(collapsed, more_than))
    return R.keep_popular(active, at_least)


@dataclass(frozen=True)
class TitleRatings:
    """Stored ratings by title: answers about one title or one user, without the edges of all."""

    by_title: DataFrame
    titles: DataFrame

    @classmethod
    def build(cls, cleaned: DataFrame, books: DataFrame) -> TitleRatings:
        by_title = materialize(collab.ratings_by_title(cleaned, books))
        return cls(by_title, collab.title_items(books).select("item_id", "title").distinct())

    def similar(self, title: str, n: int = 10, min_support: int = 40) -> DataFrame:
        """Titles closest to a title by correlation."""
        near = collab.similar_to_item(self.by_title, _item_of(self.titles, title), n, min_support)
        return _named(near, self.titles, "other_id").select("other_id", "title", "score")

    def candidates(self, user_id: int, min_support: int = 40) -> DataFrame:
        """Correlation times rating, for every neighbour of every title the user rated."""
        edges = collab.edges_of_user(self.by_title, user_id, min_support)
        return collab.candidate_scores(self.by_title, edges, user_id)

    def recommend(self, user_id: int, n: int = 10, min_support: int = 40) -> DataFrame:
        """Titles for one user."""
        edges = collab.edges_of_user(self.by_title, user_id, min_support)
        best = collab.recommend_user(self.by_title, edges, user_id, n)
        return _named(best, self.titles, "item_id").select("item_id", "title", "score")


def _item_of(titles: DataFrame, title: str) -> int:
    row = titles.where(F.col("title") == title).first()
    if row is None:
        raise KeyError(title)
    return row["item_id"]


def _named(df: DataFrame, titles: DataFrame, item: str) -> DataFrame:
    return df.join(titles.withColumnRenamed("item_id", item), item)


@dataclass(frozen=True)
class ItemModel:
    """Stored ratings by title, item edges and titles of one cleaned rating table."""

    by_title: DataFrame
    edges: DataFrame
    titles: DataFrame

    @classmethod
    def build(cls, cleaned: DataFrame, books: DataFrame, min_support: int = 40) -> ItemModel:
        by_title = materialize(collab.ratings_by_title(cleaned, books))
        edges = materialize(collab.item_pearson(by_title, min_support))
        titles = collab.title_items(books).select("item_id", "title").distinct()
        return cls(by_title, edges, titles)

    def item_of(self, title: str) -> int:
        return _item_of(self.titles, title)

    def _named(self, df: DataFrame, item: str) -> DataFrame:
        return _named(df, self.titles, item)

    def similar(self, title: str, n: int = 10) -> DataFrame:
        """Titles closest to a title by correlation."""
        near = collab.similar_items(self.edges, self.item_of(title), n)
        return self._named(near, "other_id").select("title", "score")

    def recommend(self, user_id: int, n: int = 10) -> DataFrame:
        """Titles for one user."""
        best = collab.recommend_user(self.by_title, self.edges, user_id, n)
        return self._named(best, "item_id").select("item_id", "title", "score")

    def recommend_all(self, n: int = 10) -> DataFrame:
        """Titles for every user."""
        best = collab.recommend_all(self.by_title, self.edges, n)
        return self._named(best, "item_id").select("user_id", "rank", "item_id", "title", "score")


def tag_texts(
    book_tags: DataFrame, tags: DataFrame, genres: DataFrame, books: DataFrame
) -> DataFrame:
    """Stored tag documents ``(id, title, text)`` of the books that carry a genre tag."""
    texts = content.tag_documents(book_tags, content.genre_tags(tags, genres), books)
    return materialize(
        texts.select(
            F.col("goodreads_book_id").alias("id"), "title", F.col("all_tags").alias("text")
        )
    )


def titles_like(
    texts: DataFrame, title: str, n: int = 9, stop_words: Sequence[str] = ()
) -> DataFrame:
    """Titles whose tags and authors are closest to those of a title."""
    return content.titles_like(
        texts.select("id", "text"), texts.select("id", "title"), title, n, stop_words
    )
