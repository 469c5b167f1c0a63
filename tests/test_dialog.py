import random

import pytest
from pyspark.sql import functions as F

from shelftalk.functions import arrays as A
from shelftalk.functions.text import clean_folded, id_list
from shelftalk.operators import batches as B
from shelftalk.operators import dialog, vocabulary as V
from shelftalk.operators.ordering import dense_index, with_next
from shelftalk.plans import dialogs

PAIRS = [(0, 0, "hi .", "hello there ."), (0, 1, "hi there .", "go away"), (1, 0, "", "hi .")]
SCHEMA = "conv_id long, pos long, input string, target string"


@pytest.fixture(scope="module")
def pairs(spark):
    return spark.createDataFrame(PAIRS, SCHEMA)


def test_dense_index_over_skewed_keys(spark):
    data = [(0 if i % 3 else i, i, f"v{i}") for i in range(300)]
    random.Random(2).shuffle(data)
    df = spark.createDataFrame(data, "k long, i long, v string").repartition(6)
    got = {(r.k, r.i): r.idx for r in dense_index(df, ["k", "i"], start=5).collect()}
    assert got == {(k, i): n for n, (k, i, _) in enumerate(sorted(data), 5)}


@pytest.mark.parametrize("span", [3, 10, 4096])
def test_next_row_with_one_large_group(spark, span):
    """A third of all rows in one conversation, positions with gaps."""
    data = [(7, 2 * i, f"a{i}") for i in range(50)] + [(c, p, f"{c}-{p}") for c in range(20, 45) for p in range(1 + c % 5)]
    df = spark.createDataFrame(data, "g long, p long, t string").repartition(5)
    got = {(r.g, r.p): (r.n, r._has_next) for r in with_next(df, ["g"], ["p"], {"n": "t"}, span).collect()}
    ordered = sorted(data)
    for (g, p, _), after in zip(ordered, ordered[1:] + [(None, None, None)]):
        assert got[(g, p)] == ((after[2], True) if after[0] == g else (None, False))
    assert len(got) == len(data)


def test_pairs_strip_and_drop_blank_sides(spark, rows):
    said = [(1, 0, " a "), (1, 1, "b"), (1, 2, " \t"), (1, 3, "c"), (2, 0, "alone"), (3, 5, "x"), (3, 9, "y")]
    df = spark.createDataFrame(said, "conv_id long, pos long, text string")
    assert rows(dialog.dialog_pairs(df)) == [(1, 0, "a", "b"), (3, 5, "x", "y")]
    assert dialog.consecutive(df).count() == 4
    capped = dialog.dialog_pairs_capped(df, 3).orderBy("conv_id", "pos").collect()
    assert [(r.input, r.target) for r in capped] == [("a", "b"), ("b", ""), ("", "c")]


def test_length_filter_counts_words(spark, pairs):
    assert dialog.shorter_than(pairs, 3).select("conv_id", "pos").collect() == [(1, 0)]
    assert dialog.shorter_than(pairs, 4).count() == 3


def test_vocabulary_order_counts_and_trim(pairs, rows):
    pairs = dialog.numbered_pairs(pairs.repartition(3))
    words = V.vocabulary(pairs.repartition(3))
    assert {r.word: (r["index"], r.n) for r in words.collect()} == {
        "hi": (3, 3), ".": (4, 4), "hello": (5, 1), "there": (6, 2), "go": (7, 1), "away": (8, 1), "": (9, 1),
    }
    trimmed = V.trim(words, 2)
    assert {r.word: r["index"] for r in trimmed.collect()} == {"hi": 3, ".": 4, "there": 5}
    kept = V.pairs_in_vocabulary(pairs, trimmed)
    assert kept.count() == 0 and V.pairs_in_vocabulary(pairs, words).count() == 3
    assert rows(V.trim_statistics(words, trimmed, pairs, kept)) == [("pairs", 0, 3, 0.0), ("words", 3, 7, 3 / 7)]


def test_encode_pad_mask_decode(pairs):
    numbered = dialog.numbered_pairs(pairs)
    words = V.vocabulary(numbered)
    encoded = B.encode_pairs(numbered, words)
    got = {r.pair_id: (r.input_ids, r.target_ids) for r in encoded.collect()}
    assert got[1] == ([3, 6, 4, 2], [7, 8, 2]) and got[2] == ([9, 2], [3, 4, 2])
    padded = A.pad_to(F.col("input_ids"), 6)
    row = encoded.where("pair_id = 1").select(padded, A.mask(padded), F.size("input_ids"), A.bracket(F.col("target_ids"), 90, 91)).first()
    assert tuple(row) == ([3, 6, 4, 2, 0, 0], [1, 1, 1, 1, 0, 0], 4, [90, 7, 8, 2, 91])
    assert encoded.where("pair_id = 1").select(A.pad_to(F.col("input_ids"), 2)).first()[0] == [4, 2]
    texts = {r.pair_id: r.text for r in B.decode(encoded, words, "pair_id", "input_ids").collect()}
    assert texts == {0: "hi .", 1: "hi there .", 2: ""}


def test_unknown_word_id_is_an_error(spark, pairs):
    words = V.vocabulary(dialog.numbered_pairs(pairs))
    ids = spark.createDataFrame([(1, [3, 99, 2])], "pair_id long, ids array<int>")
    with pytest.raises(Exception, match="unknown word id 99"):
        B.decode(ids, words, "pair_id", "ids").collect()


@pytest.mark.parametrize("text", ["['L1', 'L2'", "[L1, L2]"])
def test_malformed_id_list_is_an_error(spark, text):
    df = spark.createDataFrame([(text,)], "ids string")
    with pytest.raises(Exception, match="not a list of ids"):
        df.select(F.explode(id_list(F.col("ids")))).collect()


def test_unknown_word_is_an_error(pairs):
    numbered = dialog.numbered_pairs(pairs)
    with pytest.raises(Exception, match="unknown word"):
        B.encode_pairs(numbered, V.trim(V.vocabulary(numbered), 2)).collect()


def test_batches_are_consistent(spark):
    rng = random.Random(4)
    words = ["aa", "bb", "cc", "dd"]
    said = [(c, p, " ".join(rng.choices(words, k=rng.randint(1, 9)))) for c in range(30) for p in range(4)]
    ready = dialogs.prepare(spark.createDataFrame(said, "conv_id long, pos long, text string"), 9, 1)
    n = ready.pairs.count()
    made = ready.batches(12, 8, seed=3).collect()
    again = ready.batches(12, 8, seed=3).collect()
    assert sorted(made) == sorted(again) and len(made) == 12
    ids = {r.pair_id: (r.input_ids, r.target_ids) for r in B.encode_pairs(ready.pairs, ready.vocabulary).collect()}
    drawn = [p for b in made for p in b.pair_ids]
    assert len(drawn) == 96 and set(drawn) <= set(range(n)) and len(set(drawn)) > 20
    for b in made:
        assert b.lengths == sorted(b.lengths, reverse=True) and len(b.inputs) == b.lengths[0]
        assert b.max_target_len == len(b.targets) == len(b.mask)
        for at, p in enumerate(b.pair_ids):
            column = [step[at] for step in b.inputs]
            assert column == ids[p][0] + [0] * (len(b.inputs) - len(ids[p][0]))
            target = [step[at] for step in b.targets]
            assert [t for t in target if t] == ids[p][1]
            assert [step[at] for step in b.mask] == [1 if t else 0 for t in target]
    other = B.draws(ready.pairs, 96, seed=4).collect()
    assert [r.pair_id for r in other] != drawn


def test_cleaning_keeps_other_columns(pairs):
    got = dialog.clean_pairs(pairs.withColumn("extra", F.lit(1)), clean_folded)
    assert set(got.columns) == {"conv_id", "pos", "input", "target", "extra"} and got.count() == 3


def test_draws_are_independent(spark):
    pairs = spark.range(5000).withColumnRenamed("id", "pair_id")
    drawn = [r["pair_id"] for r in B.draws(pairs, 5000, seed=3).orderBy("draw").collect()]
    assert 0.60 < len(set(drawn)) / 5000 < 0.66
    steps = {(b - a) % 5000 for a, b in zip(drawn, drawn[1:])}
    assert len(steps) > 2500
    assert min(drawn) >= 0 and max(drawn) < 5000


def test_capped_pairs_keep_order_and_cap(spark):
    said = spark.createDataFrame(
        [(c, p, f"say {c} {p}") for c in range(4) for p in range(5)],
        "conv_id long, pos long, text string",
    )
    every = dialog.dialog_pairs_capped(said, 100).orderBy("conv_id", "pos").collect()
    assert len(every) == 16
    for cap in (1, 4, 5, 16):
        got = dialog.dialog_pairs_capped(said, cap).orderBy("conv_id", "pos").collect()
        assert got == every[:cap]
    assert dialog.dialog_pairs_capped(said.limit(0), 3).count() == 0
    with pytest.raises(ValueError):
        dialog.dialog_pairs_capped(said, 0)
