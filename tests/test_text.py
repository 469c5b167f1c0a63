import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from shelftalk.functions import text as X

CASES = [  # input, cleaning A, cleaning B
    ("he is a boy.", "he is a boy .", "he is a boy ."),
    (
        '  Ça va?! Oui, "très" bien... ',
        "ca va ? ! oui tres bien . . .",
        "a va ? ! oui , tr s bien . . .",
    ),
    ("I'm 42, you?", "i m you ?", "i m , you ?"),
    ("1984", "", ""),
    ("RENÉ\tsays hi", "rene says hi", "ren says hi"),
    ("straße Øre ﬁne", "stra e re ne", "stra e re ne"),
    ("...", ". . .", ". . ."),
    ("", "", ""),
]


def one(spark, texts, *columns):
    df = spark.createDataFrame(list(enumerate(texts)), "i long, text string")
    return [tuple(r)[1:] for r in df.select("i", *columns).orderBy("i").collect()]


def test_cleaning_cases(spark):
    t = F.col("text")
    got = one(spark, [c[0] for c in CASES], X.clean_folded(t), X.clean_plain(t))
    assert got == [c[1:] for c in CASES]


def random_texts(n=400):
    rng = random.Random(5)
    pools = [
        "abcdefgXYZ .,!?\"'0123-",
        "éèêçñüößøåÆİıÅK",
        "\t\n  ̧́̈",
        "漢字かな한글αβγДж",
        "".join(chr(p) for p in range(0xC0, 0x250)),
        "".join(chr(p) for p in range(0x1E00, 0x1F00)),
    ]
    return ["".join(rng.choice(rng.choice(pools)) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def test_cleaning_against_definition(spark):
    """The shortened chains equal the step-by-step rules."""
    t, texts = F.col("text"), random_texts()
    for got, s in zip(one(spark, texts, X.clean_folded(t), X.clean_plain(t)), texts):
        low = s.lower()
        bare = "".join(c for c in unicodedata.normalize("NFD", low) if unicodedata.category(c) != "Mn")
        spaced = "".join(" " + c if c in ".!?" else c for c in bare)
        a = " ".join("".join(c if re.match("[a-zA-Z.!?]", c) else " " for c in spaced).split())
        spaced = "".join(f" {c} " if c in "?.!," else c for c in low)
        b = " ".join("".join(c if re.match("[a-zA-Z?.!,]", c) else " " for c in spaced).split())
        assert got == (a, b), s


def test_cleaning_twice_changes_nothing(spark):
    t = F.col("text")
    for a, aa, b, bb in one(
        spark, random_texts(100), X.clean_folded(t), X.clean_folded(X.clean_folded(t)),
        X.clean_plain(t), X.clean_plain(X.clean_plain(t)),
    ):
        assert a == aa and b == bb


def test_fold_marks_is_exact(spark):
    texts = random_texts(200)
    for (got,), s in zip(one(spark, texts, X.fold_marks(F.col("text"))), texts):
        parts = unicodedata.normalize("NFD", s)
        assert got == "".join(c for c in parts if unicodedata.category(c) != "Mn")


def test_single_steps(spark):
    t = F.col("text")
    got = one(
        spark, [' a \t"b"  c. '], X.strip_space(t), X.collapse_space(t),
        X.collapse_blanks_and_quotes(t), X.space_before_stops(t), X.space_around_punctuation(t),
        X.keep_letters(t),
    )
    assert got == [('a \t"b"  c.', ' a "b" c. ', " a \t b c. ", ' a \t"b"  c . ', ' a \t"b"  c .  ', " a b c. ")]


def test_tokens_and_bigrams(spark):
    t = F.col("text")
    got = one(
        spark, ["fantasy young-adult magic j.k.rowling marygrandpré", "a", ""],
        X.word_tokens(t), X.with_bigrams(X.word_tokens(t, ["magic"])),
    )
    words = ["fantasy", "young", "adult", "magic", "rowling", "marygrandpré"]
    assert got[0][0] == words
    kept = [w for w in words if w != "magic"]
    assert got[0][1] == kept + [f"{a} {b}" for a, b in zip(kept, kept[1:])]
    assert got[1] == ([], []) and got[2] == ([], [])


def test_stop_words_are_removed_before_pairs_form(spark):
    got = one(spark, ["lord of the rings"], X.with_bigrams(X.word_tokens(F.col("text"), ["of", "the"])))
    assert got == [(["lord", "rings", "lord rings"],)]


@pytest.mark.parametrize("n_stop", [2, 30])
def test_long_and_short_stop_lists(spark, n_stop):
    stop = ["aa", "bb"] + [f"x{i}" for i in range(n_stop - 2)]
    assert one(spark, ["aa cc bb"], X.word_tokens(F.col("text"), stop)) == [(["cc"],)]


def test_first_character_and_recode(spark):
    t = F.col("text")
    got = one(
        spark, ["1984", "Ubik", "liked it", "Élan", "", "-"],
        X.starts_upper_or_digit(t), X.starts_lower(t), X.recode(t, {"Ubik": 3}),
    )
    assert got == [
        (True, False, None), (True, False, 3), (False, True, None),
        (True, False, None), (False, False, None), (False, False, None),
    ]


def test_id_list(spark):
    assert one(spark, ["['L1', 'L2']", "[]"], X.id_list(F.col("text"))) == [(["L1", "L2"],), ([],)]
