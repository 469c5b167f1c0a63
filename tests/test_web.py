import pytest
from pyspark.sql import functions as F

from shelftalk.operators import web
from shelftalk.plans import pages as P

LINKS = (
    '<a href="/genres/art">Art</a> <a href="/genres/art">Art</a> <a href="/genres/a/b">AB</a> '
    '<a href="/genres/x"></a> <a href="/other">O</a>'
)
SHELF = (
    '<a title="1984">x</a> <a title="it was ok">x</a> <a title="Ubik">x</a> '
    '<span title="liked it">x</span> <span title="Nov 2018">x</span> <span title="it was ok">x</span>'
)


def pages(spark, *html):
    return spark.createDataFrame([(i, "u", h) for i, h in enumerate(html)], "page_id long, url string, html string")


def test_genres_first_seen(spark):
    got = P.genres(pages(spark, LINKS, LINKS.replace("/art", "/zoo"))).orderBy("page_id", "pos").collect()
    assert [r.tag_name for r in got] == ["art", "a/b", "zoo"]


def test_own_ratings(spark):
    got = P.own_ratings(pages(spark, SHELF, '<a title="Emma">x</a><span title="did not like it"> </span>'))
    assert [tuple(r) for r in got.orderBy("idx").collect()] == [(0, "1984", 3), (1, "Ubik", 2), (2, "Emma", 5)]


def test_unequal_lists_are_an_error(spark):
    with pytest.raises(Exception, match="different lengths"):
        P.own_ratings(pages(spark, SHELF + '<a title="Extra">x</a>')).collect()


def test_both_forms_agree_on_flat_markup(spark, rows):
    loose = '<A HREF="/n">x</A><a name="z">t</a><a\n  class="c" href="/m"><b>t</b></a>'
    p = pages(spark, LINKS, "<p>none</p>", loose)
    assert rows(web.attribute_values(p, "a", "href")) == rows(web.attribute_values_parsed(p, "a", "href"))


def test_parsed_form_reads_nested_and_loose_markup(spark, rows):
    html = (
        "<div class=out><div class='in'></div>text</div><DIV CLASS='x&amp;y'> </DIV>"
        "<!-- <div class='no'>t</div> --><div>t</div><div class=''>t"
    )
    got = rows(web.attribute_values_parsed(pages(spark, html), "div", "class"))
    assert [(pos, value) for _, pos, value in got] == [(0, "out"), (2, "x&y"), (4, "")]


def test_slug_splits_twice(spark):
    df = spark.createDataFrame([("/genres/a/b",), ("/x",), ("a",)], "h string")
    assert [r[0] for r in df.select(web.slug(F.col("h"))).collect()] == ["a/b", None, None]


def test_zip_within_page(spark, rows):
    df = spark.createDataFrame([(1, ["a", "b"], ["x", "y"])], "page_id long, l array<string>, r array<string>")
    assert rows(web.zip_within_page(df, "l", "r", ("title", "label"))) == [(1, 0, "a", "x"), (1, 1, "b", "y")]
    bad = spark.createDataFrame([(1, ["a", "b"], ["x"])], "page_id long, l array<string>, r array<string>")
    with pytest.raises(Exception, match="different lengths"):
        web.zip_within_page(bad, "l", "r", ("title", "label")).collect()


def test_parsed_links_read_loose_markup(spark):
    html = '<a href=/genres/q>q</a><p><a href="/genres/a&amp;b">x</a>'
    pages_ = spark.createDataFrame([(1, "u", html)], "page_id long, url string, html string")
    found = web.links(pages_, "/genres/", parsed=True).orderBy("pos").collect()
    assert [r["href"] for r in found] == ["/genres/q", "/genres/a&b"]
