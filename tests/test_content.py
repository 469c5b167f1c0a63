import collections
import math

import pytest

from shelftalk.operators import content, tables
from shelftalk.plans import recommend

DOCS = [
    (1, "fantasy young-adult magic j.k.rowling marygrandpré"),
    (2, "fantasy magic j.k.rowling"),
    (3, "sci-fi classics georgeorwell"),
]


def docs_of(spark, docs):
    return spark.createDataFrame(docs, "id long, text string")


def test_tag_documents(spark):
    tags = spark.createDataFrame([(1, "fantasy"), (2, "to-read"), (3, "young-adult")], "tag_id long, tag_name string")
    genres = spark.createDataFrame([("young-adult",), ("fantasy",), ("unused",)], "tag_name string")
    book_tags = spark.createDataFrame([(110, 3, 0), (110, 2, 1), (110, 1, 2), (120, 2, 3)], "goodreads_book_id long, tag_id long, pos long")
    books = spark.createDataFrame(
        [(10, 110, "J.K. Rowling, Mary GrandPré", "HP"), (20, 120, "X", "none")],
        "id long, book_id long, authors string, title string",
    )
    kept = content.genre_tags(tags, genres)
    assert sorted(r.tag_name for r in kept.collect()) == ["fantasy", "young-adult"]
    got = content.tag_documents(book_tags, kept, books).collect()
    assert [tuple(r) for r in got] == [(110, "HP", "young-adult fantasy j.k.rowling marygrandpré")]
    assert {r.tag_name: r.number for r in content.tag_usage(book_tags, tags).collect()} == {"fantasy": 1, "to-read": 2, "young-adult": 1}


def test_long_group_is_joined_in_order(spark):
    words = [(1, i, f"w{i}") for i in range(57)] + [(2, 3, "z")]
    df = spark.createDataFrame(words, "k long, pos long, w string").repartition(5)
    got = {r.k: r.s for r in tables.ordered_concat(df, "k", "pos", "w", "s", span=10).collect()}
    assert got == {1: " ".join(f"w{i}" for i in range(57)), 2: "z"}


def test_term_counts_and_cosine(spark):
    docs = docs_of(spark, DOCS)
    counts = content.term_counts(docs).groupBy("id").count().collect()
    assert {r.id: r["count"] for r in counts} == {1: 11, 2: 5, 3: 7}
    edges = content.cosine_pairs(docs, content.same_terms(docs)).collect()
    assert [(e.item_a, e.item_b, round(e.score, 5)) for e in edges] == [(1, 2, 0.53936)]


def vector(text, stop):
    words, run = [], ""
    for ch in text.lower() + " ":
        if ch.isalnum() or ch == "_":
            run += ch
        else:
            words += [run] if len(run) > 1 and run not in stop else []
            run = ""
    return collections.Counter(words + [f"{a} {b}" for a, b in zip(words, words[1:])])


def nearest(docs, n, stop=()):
    vectors = {i: vector(t, stop) for i, t in docs}
    out = {}
    for a, va in vectors.items():
        scored = []
        for b, vb in vectors.items():
            dot = sum(c * vb[w] for w, c in va.items())
            if a != b and dot:
                length = math.sqrt(sum(c * c for c in va.values())) * math.sqrt(sum(c * c for c in vb.values()))
                scored.append((-round(dot / length, 9), b))
        out[a] = [(b, -s) for s, b in sorted(scored)[:n]]
    return out


def crowded():
    """A third of the documents are copies of one text."""
    words = "red blue ring gear bolt anvil widget hot cold new".split()
    docs = [(i, f"{words[i % 10]} {words[i * 7 % 10]} {words[i * 3 % 9]}") for i in range(40)]
    docs += [(100 + i, "red ring bolt") for i in range(20)]
    return docs + [(200, ""), (201, "unique words only"), (202, "ring ring bolt bolt red red red")]


@pytest.mark.parametrize("n", [1, 4, 30])
def test_nearest_of_all_against_brute_force(spark, n):
    docs = crowded()
    found = content.similar_documents_all(docs_of(spark, docs), n, ("new",)).collect()
    got = collections.defaultdict(list)
    for r in sorted(found, key=lambda r: (r.id, r["rank"])):
        got[r.id].append((r.other_id, round(r.score, 9)))
    want = nearest(docs, n, ("new",))
    assert {k: v for k, v in want.items() if v} == dict(got)


def test_nearest_of_one_excludes_it_by_id(spark):
    docs = crowded()
    got = content.similar_documents(docs_of(spark, docs), 105, 3).collect()
    assert [r.id for r in got] == [b for b, _ in nearest(docs, 3)[105]]
    assert 105 not in [r.id for r in got]


def test_title_lookup(spark):
    texts = spark.createDataFrame([(i, t.split()[0], t) for i, t in DOCS], "id long, title string, text string")
    assert [r.id for r in recommend.titles_like(texts, "fantasy").collect()] == [2]
    with pytest.raises(KeyError):
        recommend.titles_like(texts, "nothing")


def test_copies_share_a_profile(spark):
    got = {r.id: r.profile for r in content.same_terms(docs_of(spark, crowded())).collect()}
    assert {got[100 + i] for i in range(20)} == {got[100]}
    assert 200 not in got and got[201] == 201


def test_counts_need_no_shuffle_of_terms(spark):
    """Counts are formed in the row; several rows of an id, or of none, still count together."""
    made = [(1, "red widget red widget"), (2, "blue"), (2, "blue ring"), (None, "hot"), (None, "hot"), (3, ""), (4, None)]
    docs = spark.createDataFrame(made, "id long, text string")
    got = {(r.id, r.term): r.tf for r in content.term_counts(docs).collect()}
    assert got == {
        (1, "red"): 2, (1, "widget"): 2, (1, "red widget"): 2, (1, "widget red"): 1,
        (2, "blue"): 2, (2, "ring"): 1, (2, "blue ring"): 1, (None, "hot"): 2,
    }
    plan = content.term_counts(docs.where("id = 1"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_all_cosines_join_no_terms(spark):
    """Vectors are sent whole, all pairs or those from a score: no join of terms with terms."""
    docs = spark.createDataFrame([(i, f"red ring w{i % 7} w{i % 5}") for i in range(60)], "id long, text string")
    members = content.same_terms(docs)
    for least in (None, 0.5):
        pairs = content.cosine_pairs(docs, members, least=least)
        assert "Join" not in pairs._jdf.queryExecution().optimizedPlan().toString()
    assert pairs.count()
