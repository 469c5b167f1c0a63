"""Page flows: genre names and own ratings from stored pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelftalk.functions.text import recode, starts_lower, starts_upper_or_digit
from shelftalk.operators import web

# Rating labels and their numbers. The first is 5 in the data this follows.
RATING_LABELS = {
    "did not like it": 5,
    "it was ok": 2,
    "liked it": 3,
    "really liked it": 4,
    "it was amazing": 5,
}


def genres(pages: DataFrame, pattern: str = "/genres/") -> DataFrame:
    """Distinct genre names with the place of their first link."""
    return web.distinct_slugs(web.links(pages, pattern, parsed=True))


def own_ratings(pages: DataFrame, labels: dict[str, int] = RATING_LABELS) -> DataFrame:
    """``(idx, title, rating)`` from the titles of links and spans of shelf pages."""
    titles = web.attribute_values_parsed(pages, "a", "title")
    given = web.attribute_values_parsed(pages, "span", "title")
    rows = web.zip_lists(
        titles.where(starts_upper_or_digit(F.col("value"))),
        given.where(starts_lower(F.col("value"))),
        ("title", "label"),
    )
    return rows.select("idx", "title", recode(F.col("label"), labels).alias("rating"))
