"""No side of a join that grows with the input is broadcast, however small Spark takes it for."""

import random

import numpy as np
import pytest

from shelftalk.llm import classifier, components, embeddings, simhash, suffixes

rng = random.Random(5)
WORDS = [f"w{i}" for i in range(400)]


@pytest.fixture
def plans(monkeypatch):
    """First plans of all stages stored meanwhile, and a function that adds a result's."""
    seen = []

    def add(df):
        seen.append(df._jdf.queryExecution().sparkPlan().toString())
        return df

    for module in (classifier, components, embeddings, simhash):
        monkeypatch.setattr(module, "materialize", lambda df, f=module.materialize: f(add(df)))
    return seen, add


def texts(spark):
    made = [" ".join(rng.choice(WORDS) for _ in range(60)) for _ in range(40)]
    made += [made[0] + " more", made[1], made[1]]
    return spark.createDataFrame(list(enumerate(made)), "doc_id long, text string")


def joins(seen):
    return [line for plan in seen for line in plan.split("\n") if "Join" in line]


def all_merged(seen):
    found = joins(seen)
    return bool(found) and all("SortMergeJoin" in line for line in found)


@pytest.mark.parametrize("run", [simhash.near_duplicates, simhash.first_of_each])
def test_simhash_broadcasts_nothing(spark, plans, run):
    seen, add = plans
    assert add(run(texts(spark))).count()
    assert len(joins(seen)) > 8 and all_merged(seen)


def test_embeddings_broadcast_nothing(spark, plans):
    seen, add = plans
    r = np.random.default_rng(3)
    middle = r.standard_normal((30, 16))
    rows = [(i, (middle[i % 30] + 0.01 * r.standard_normal(16)).tolist(), 1) for i in range(120)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    assert sum(x.n_links for x in add(embeddings.near_duplicates(df, bits=16)).collect()) >= 30 * 12
    assert len(joins(seen)) > 6 and all_merged(seen)


def test_repeats_and_scores_broadcast_nothing(spark, plans):
    seen, add = plans
    assert add(suffixes.without_repeats(texts(spark))).count() == 43
    labels = spark.createDataFrame([(i, i % 2) for i in range(43)], "doc_id long, quality int")
    assert add(classifier.score_documents(texts(spark), labels)).count() == 43
    assert len(joins(seen)) >= 2 and all_merged(seen)
