import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelftalk.operators import collab, ratings as R, tables
from shelftalk.plans import recommend

RATED = [
    (1, 10, 2), (1, 10, 3), (1, 20, 4), (2, 10, 3), (2, 10, 4), (2, 20, 2), (2, 30, 5),
    (3, 10, 5), (3, 20, 1), (3, 30, 4), (4, 10, 1), (4, 20, 5), (4, 30, 2), (5, 30, 3),
]
BOOKS = [(10, 110, "A", "ten"), (20, 120, "B", "twenty"), (30, 130, "C", "thirty"), (40, 140, "D", "forty")]


@pytest.fixture(scope="module")
def rated(spark):
    return spark.createDataFrame(RATED, "user_id long, book_id long, rating int")


@pytest.fixture(scope="module")
def books(spark):
    return spark.createDataFrame(BOOKS, "id long, book_id long, authors string, title string")


def test_collapse_rounds_half_to_even(rated, rows):
    got = {(u, b): r for u, b, r in rows(R.collapse(rated))}
    assert len(got) == 12 and got[(1, 10)] == 2.0 and got[(2, 10)] == 4.0


def test_duplicates_and_counts(rated):
    report = {(r.user_id, r.book_id): r.n_ratings for r in R.duplicate_report(rated).collect()}
    assert report[(1, 10)] == 2 and report[(5, 30)] == 1
    per = {r.user_id: r.n for r in R.ratings_per(R.collapse(rated), "user_id", "n").collect()}
    assert [per[u] for u in range(1, 6)] == [2, 3, 3, 3, 1]


def test_thresholds_are_one_pass(rated, rows):
    once = R.collapse(rated)
    active = R.keep_active(once, 2)
    assert {r.user_id for r in active.collect()} == {2, 3, 4}
    popular = R.keep_popular(R.keep_active(once, 1), 4)
    assert {r.book_id for r in popular.collect()} == {10, 20}
    assert rows(R.with_totals(once, "user_id", "t").where("user_id = 1").select("book_id", "t")) == [(10, 2), (20, 2)]


def test_means_and_top_rated(rated, books):
    best = R.top_rated(R.collapse(rated), books, 2).collect()
    assert [(r.book_id, r.mean_rating, r.title) for r in best] == [(30, 3.5, "thirty"), (10, 3.0, "ten")]


def test_own_ratings_join_by_title(spark, rated, books):
    own = spark.createDataFrame([("ten", 5), ("no such book", 1)], "title string, rating int")
    merged = R.merge_own(rated, own, books, 99)
    assert [tuple(r) for r in merged.where("user_id = 99").collect()] == [(99, 10, 5)]
    assert merged.count() == len(RATED) + 1


def edges_of(rated, books, support, extra=()):
    spark = rated.sparkSession
    more = spark.createDataFrame(list(extra) or [(0, 0, 0)], rated.schema).where("user_id > 0")
    return recommend.ItemModel.build(R.collapse(rated.unionByName(more)), books, support)


def test_pearson_and_support(rated, books):
    got = {(r.item_a, r.item_b): (round(r.score, 6), r.n) for r in edges_of(rated, books, 3).edges.collect()}
    assert got == {(10, 20): (-1.0, 4), (10, 30): (0.838628, 3), (20, 30): (-0.838628, 3)}
    assert [(r.item_a, r.item_b) for r in edges_of(rated, books, 4).edges.collect()] == [(10, 20)]


def test_constant_item_has_no_edge(rated, books):
    model = edges_of(rated, books, 3, [(2, 40, 3), (3, 40, 3), (4, 40, 3)])
    assert not [r for r in model.edges.collect() if 40 in (r.item_a, r.item_b)]


def test_candidates_and_recommendations(rated, books):
    model = edges_of(rated, books, 3)
    scores = collab.candidate_scores(model.by_title, model.edges, 1).groupBy("other_id").agg(F.sum("score").alias("s"))
    got = {r.other_id: round(r.s, 6) for r in scores.collect()}
    assert got == {10: -4.0, 20: -2.0, 30: -1.677256}  # self edges would add 2 and 4
    assert [(r.title, round(r.score, 6)) for r in model.recommend(1).collect()] == [("thirty", -1.677256)]
    everyone = {(r.user_id, r.title): round(r.score, 6) for r in model.recommend_all().collect()}
    assert everyone[(1, "thirty")] == -1.677256
    assert set(everyone) == {(1, "thirty"), (5, "ten"), (5, "twenty")}
    assert [r.title for r in model.similar("ten", 1).collect()] == ["thirty"]
    with pytest.raises(KeyError):
        model.similar("nothing")


def test_sweep_repeats_edges_per_support(rated, books):
    swept = collab.support_sweep(edges_of(rated, books, 3).edges, (4, 3, 2))
    per = {r.min_support: r["count"] for r in swept.groupBy("min_support").count().collect()}
    assert per == {4: 1, 3: 3, 2: 3}


def test_titles_shared_by_books_are_averaged(spark):
    books = spark.createDataFrame([(1, 11, "a", "T"), (2, 12, "b", "T"), (3, 13, "c", "U")], "id long, book_id long, authors string, title string")
    rated = spark.createDataFrame([(5, 1, 2.0), (5, 2, 5.0), (5, 3, 1.0)], "user_id long, book_id long, rating double")
    got = {r.item_id: r.rating for r in collab.ratings_by_title(rated, books).collect()}
    assert got == {1: 3.5, 3: 1.0}
    wide = collab.wide_matrix(collab.ratings_by_title(rated, books), [1, 3]).collect()
    assert tuple(wide[0]) == (5, 3.5, 1.0)


def test_recommend_all_against_brute_force(spark):
    """Skewed ratings: user 0 rates every item, item 0 is rated by every user."""
    rng = np.random.default_rng(3)
    n_users, n_items, support = 60, 30, 4
    matrix = np.full((n_users, n_items), np.nan)
    for u in range(n_users):
        for i in range(n_items):
            if u == 0 or i == 0 or rng.random() < 0.3:
                matrix[u, i] = rng.integers(1, 6)
    rated = [(u, i, float(matrix[u, i])) for u in range(n_users) for i in range(n_items) if not math.isnan(matrix[u, i])]
    books = spark.createDataFrame([(i, i + 500, "a", f"t{i:03}") for i in range(n_items)], "id long, book_id long, authors string, title string")
    df = spark.createDataFrame(rated, "user_id long, book_id long, rating double")
    model = recommend.ItemModel.build(df, books, support)
    r = np.full((n_items, n_items), np.nan)
    for a in range(n_items):
        for b in range(n_items):
            both = ~np.isnan(matrix[:, a]) & ~np.isnan(matrix[:, b])
            x, y = matrix[both, a], matrix[both, b]
            if a != b and both.sum() >= support and x.std() > 0 and y.std() > 0:
                r[a, b] = np.corrcoef(x, y)[0, 1]
    want = {}
    for u in range(n_users):
        mine = ~np.isnan(matrix[u])
        scores = {}
        for b in np.flatnonzero(~mine):
            terms = [r[a, b] * matrix[u, a] for a in np.flatnonzero(mine) if not math.isnan(r[a, b])]
            if terms:
                scores[int(b)] = sum(terms)
        for rank, b in enumerate(sorted(scores, key=lambda b: (-round(scores[b], 12), b))[:5], 1):
            want[(u, rank)] = (b, round(scores[b], 6))
    got = {(x.user_id, x["rank"]): (x.item_id, round(x.score, 6)) for x in model.recommend_all(5).collect()}
    assert got == want


def test_recommend_all_takes_any_rating(spark):
    """Ratings of zero, below a half and below zero rank as for one user alone."""
    r = random.Random(1)
    items = range(-4, 8)
    rows = [
        (u, i, float(r.choice([-2, 0, 0.25, 0.5, 40])))
        for u in range(12) for i in items if r.random() < 0.5
    ]
    edges = [
        (a, b, r.uniform(-1, 1), 5) for a in items for b in items if a < b and r.random() < 0.7
    ]
    by_title = spark.createDataFrame(rows, "user_id long, item_id long, rating double")
    near = spark.createDataFrame(edges, "item_a long, item_b long, score double, n long")
    got = {}
    for x in collab.recommend_all(by_title, near, 4).orderBy("user_id", "rank").collect():
        got.setdefault(x["user_id"], []).append((x["item_id"], round(x["score"], 6) + 0.0))
    want = {}
    for u in range(12):
        mine = {i: x for v, i, x in rows if v == u}
        totals = {}
        for a, b, s, _ in edges:
            for here, there in ((a, b), (b, a)):
                if here in mine:
                    totals[there] = totals.get(there, 0) + s * mine[here]
        fresh = sorted((-round(v, 12), b) for b, v in totals.items() if b not in mine)[:4]
        if fresh:
            want[u] = [(b, round(-v, 6) + 0.0) for v, b in fresh]
    assert got == want
    alone = collab.recommend_user(by_title, near, 3, 4).collect()
    assert [x["item_id"] for x in alone] == [i for i, _ in got[3]]


def test_partitioning_does_not_matter(spark, rated, books):
    results = []
    for n in (1, 7):
        model = recommend.ItemModel.build(R.collapse(rated.repartition(n)), books, 3)
        results.append(sorted(map(tuple, model.edges.collect())))
    assert results[0] == results[1]


def test_histogram_matches_numpy(spark):
    rng = np.random.default_rng(0)
    for values in (rng.integers(1, 300, 500).tolist(), [4, 4, 4], list(range(51))):
        df = spark.createDataFrame([(int(v),) for v in values], "v long")
        got = tables.histogram(df, "v").orderBy("bin").collect()
        counts, bounds = np.histogram(values, bins=50)
        assert [r.n for r in got] == counts.tolist()
        assert np.allclose([r.bin_from for r in got], bounds[:-1]) and np.allclose([r.bin_to for r in got], bounds[1:])


def test_profile_and_frequency(rated, books, rows):
    got = rows(tables.profiles([("ratings", rated, ["user_id", "book_id"]), ("books", books, ["id"])]))
    assert got == [
        ("books", 4, 4, "id", 4, 10, 40),
        ("ratings", 14, 3, "book_id", 3, 10, 30),
        ("ratings", 14, 3, "user_id", 5, 1, 5),
    ]
    assert [tuple(r) for r in tables.frequency(rated, "rating").collect()] == [(1, 2), (2, 3), (3, 3), (4, 3), (5, 3)]
    assert tables.count_true(rated, F.col("rating") > 3).first()[0] == 6
    assert [r.rating for r in tables.top(rated, "rating", 2, "user_id", descending=False).collect()] == [1, 1]
