"""Links and attributes of stored web pages ``(page_id, url, html)``."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelftalk.operators.ordering import dense_index
from shelftalk.operators.tables import first_seen

# ---------------------------------------------------------------- flat markup, in the JVM


def _element(tag: str) -> str:
    return rf"(?si)<{tag}\b[^>]*>.*?</{tag}>"


def _attribute(tag: str, attribute: str) -> str:
    return rf"""(?i)^<{tag}\b[^>]*?\s{attribute}\s*=\s*["']([^"'>]*)["']"""


def attribute_values(pages: DataFrame, tag: str, attribute: str) -> DataFrame:
    """``(page_id, pos, value)``: an attribute of every element that has it and has text.

    ``pos`` counts the elements of that tag on the page.
    For markup whose elements of that tag do not nest and whose values are quoted; any
    other markup needs :func:`attribute_values_parsed`. White space counts as text.
    """
    found = pages.select(
        "page_id",
        F.posexplode_outer(
            F.regexp_extract_all("html", F.lit(_element(tag)), F.lit(0))
        ).alias("pos", "element"),
    )  # outer, so that the arrays are not formed twice for a test on their size
    text = F.regexp_replace("element", "<[^>]*>", "")
    pattern = _attribute(tag, attribute)
    return found.where(F.col("element").rlike(pattern) & (text != "")).select(
        "page_id", F.col("pos").cast("long").alias("pos"),
        F.regexp_extract("element", pattern, 1).alias("value"),
    )


def links(pages: DataFrame, pattern: str, parsed: bool = False) -> DataFrame:
    """``(page_id, pos, href)`` of links with text whose target matches anywhere.

    The plain form is for flat markup with quoted targets and leaves character references as
    written; ``parsed`` reads any HTML.
    """
    read = attribute_values_parsed if parsed else attribute_values
    return (
        read(pages, "a", "href")
        .where(F.col("value").rlike(pattern))
        .withColumnRenamed("value", "href")
    )


# ---------------------------------------------------------------- any markup, parsed


class _Collector(HTMLParser):
    """Values of one attribute of one tag, with whether the element holds text."""

    def __init__(self, tag: str, attribute: str) -> None:
        super().__init__(convert_charrefs=True)
        self.tag, self.attribute = tag, attribute
        self.found: list[list] = []  # [value, has text] of every such tag, in document order
        self._open: list[int] = []

    def handle_starttag(self, tag, attrs):
        if tag == self.tag:
            self._open.append(len(self.found))
            self.found.append([dict(reversed(attrs)).get(self.attribute), False])

    def handle_endtag(self, tag):
        if tag == self.tag and self._open:
            self._open.pop()

    def handle_data(self, data):
        if data:
            for at in self._open:
                self.found[at][1] = True


def attribute_values_parsed(pages: DataFrame, tag: str, attribute: str) -> DataFrame:
    """As :func:`attribute_values`, for nested or loosely written markup."""

    def parse(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for page_id, html in zip(frame["page_id"], frame["html"]):
                collector = _Collector(tag, attribute)
                collector.feed(html or "")
                collector.close()
                rows += [
                    (page_id, pos, value)
                    for pos, (value, has_text) in enumerate(collector.found)
                    if has_text and value is not None
                ]
            yield pd.DataFrame(rows, columns=["page_id", "pos", "value"])

    return pages.select("page_id", "html").mapInPandas(
        parse, "page_id long, pos long, value string"
    )


# ---------------------------------------------------------------- lists of extracted strings


def slug(href: Column) -> Column:
    """Third piece of a link split at most twice at ``/``; null without a third piece."""
    return F.get(F.split(href, "/", 3), 2)


def distinct_slugs(found_links: DataFrame) -> DataFrame:
    """Slugs with the place of their first occurrence."""
    slugs = found_links.select("page_id", "pos", slug(F.col("href")).alias("tag_name"))
    return first_seen(slugs.where(F.col("tag_name").isNotNull()), "tag_name", ["page_id", "pos"])


def zip_lists(left: DataFrame, right: DataFrame, names: tuple[str, str]) -> DataFrame:
    """Pair two lists ``(page_id, pos, value)`` by overall position.

    The lists run over all pages in page order. Different lengths are an error.
    """
    order = ["page_id", "pos"]
    a = dense_index(left.select(*order, "value"), order, "idx").select(
        "idx", F.struct("value").alias("a")
    )
    b = dense_index(right.select(*order, "value"), order, "idx").select(
        "idx", F.struct("value").alias("b")
    )
    short = F.raise_error(F.lit("lists of different lengths"))
    return a.join(b, "idx", "full").select(
        "idx",
        F.when(F.col("a").isNull() | F.col("b").isNull(), short.cast("string"))
        .otherwise(F.col("a.value")).alias(names[0]),
        F.col("b.value").alias(names[1]),
    )


def zip_within_page(pages: DataFrame, left: str, right: str, names: tuple[str, str]) -> DataFrame:
    """Pair two array columns of a page by position. Different lengths are an error."""
    short = F.raise_error(F.lit("lists of different lengths"))
    pairs = F.when(
        F.size(left) == F.size(right),
        F.arrays_zip(F.col(left).alias("a"), F.col(right).alias("b")),
    ).otherwise(short.cast("array<struct<a:string,b:string>>"))
    return pages.select("page_id", F.posexplode(pairs).alias("pos", "_z")).select(
        "page_id", "pos", F.col("_z.a").alias(names[0]), F.col("_z.b").alias(names[1])
    )

