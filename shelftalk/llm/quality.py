"""Line-first quality rules as column expressions alone."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelftalk.llm.common import SPACE

_BLANKS = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
#: Phrases of page furniture, looked for in the lower-cased line.
BOILERPLATE = (
    "all rights reserved", "cookie", "enable javascript", "terms of use", "terms of service",
    "privacy policy", "sign in", "log in", "subscribe to", "click here", "read more",
    "share this", "back to top", "skip to content", "lorem ipsum",
)
_PLACE_BITS = 24  # of a packed window: its place below, its hash above; longer texts are not packed
_PLACES = (1 << _PLACE_BITS) - 1


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def _without(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def line_verdict(
    line: Column,
    short: int = 5,
    marks_per_word: float = 0.5,
    symbols_per_word: float = 0.5,
) -> Column:
    """The rule a line fails, or null.

    * punctuation: over ``marks_per_word`` of ``!?`` a word, or no sentence mark at the end
      of a line of fewer than ``short`` words;
    * navigation: over ``symbols_per_word`` of separators and other symbols a word;
    * boilerplate: a phrase of page furniture in a line of at most 20 words.
    """
    trimmed = F.btrim(line, F.lit(_BLANKS))
    n = F.size(F.split(trimmed, SPACE))
    ends = trimmed.rlike(r"""[.!?:;…。！？]["'”’»)\]]*$""")
    return (
        F.when(_without(line, "!?") > F.greatest(n * marks_per_word, F.lit(3.0)), "punctuation")
        .when(~ends & (n < short), "punctuation")
        .when(_without(line, SYMBOLS + "»›·•") > F.greatest(n * symbols_per_word, F.lit(2.0)), "navigation")
        .when((n <= 20) & F.lower(line).rlike("|".join(BOILERPLATE)), "boilerplate")
    )


def _repeats(
    words: Column,
    windows: Column,
    place: Callable[[Column], Column],
    alike: Callable[[Column, Column], Column],
) -> Column:
    """Places of windows of three words that have an equal neighbour among ``windows``.

    ``windows`` are sorted by hash, ``place`` and ``alike`` read a window's place and compare
    the hashes of two. A window with an alike neighbour of other words gives -1: some of its
    equals may not be neighbours.
    """
    at = lambda p: F.get(words, p)

    def equal(x: Column, y: Column) -> Column:
        p, q = place(x), place(y)
        return (at(p) == at(q)) & (at(p + 1) == at(q + 1)) & (at(p + 2) == at(q + 2))

    def found(x: Column, i: Column) -> Column:
        before, after = F.get(windows, i - 1), F.get(windows, i + 1)
        like = lambda y: F.coalesce(alike(x, y), F.lit(False))
        other = lambda y: like(y) & ~equal(x, y)
        return F.when(like(before) | like(after), F.when(other(before) | other(after), -1).otherwise(place(x)))

    return F.filter(F.transform(windows, found), lambda p: p.isNotNull())


def _covered(places: Column) -> Column:
    """Words in the windows at ``places``."""
    every = F.flatten(F.transform(places, lambda p: F.array(p, p + 1, p + 2)))
    return F.size(F.array_distinct(every)).cast("long")


def _repeated_words(step: DataFrame) -> DataFrame:
    """``step`` with ``_repeats``: words of ``_words`` in windows of three that occur twice or more.

    Windows are sorted as longs, 40 bits of the hash above the place. Where that can't tell,
    because two windows share those bits or a place needs more than its own, the places are
    sorted by the whole hash and the three words, so that equal windows are neighbours.
    """
    words, size = F.col("_words"), F.size("_words")
    hash_of = lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2))
    firsts = F.slice("_words", 1, F.greatest(size - 2, F.lit(0)))
    packed = lambda w, i: F.shiftleft(hash_of(w, i), _PLACE_BITS).bitwiseOR(i.cast("long"))
    fits = size <= _PLACES
    step = step.select("*", F.when(fits, F.sort_array(F.transform(firsts, packed))).alias("_windows"))
    step = step.select(
        "*",
        _repeats(
            words,
            F.col("_windows"),
            lambda x: x.bitwiseAND(F.lit(_PLACES)).cast("int"),
            lambda x, y: F.shiftright(x, _PLACE_BITS) == F.shiftright(y, _PLACE_BITS),
        ).alias("_found"),
    )
    told = F.coalesce(~F.array_contains("_found", -1), F.lit(False))
    step = step.select("*", F.when(~told, F.transform(firsts, hash_of)).alias("_hashes"))

    def order(p: Column, q: Column) -> Column:
        h, keys = F.col("_hashes"), F.lit(0)
        pairs = [(F.get(words, p + k), F.get(words, q + k)) for k in (2, 1, 0)]
        for x, y in [*pairs, (F.get(h, p), F.get(h, q))]:
            keys = F.when(x < y, -1).when(x > y, 1).otherwise(keys)
        return keys

    places = F.sequence(F.lit(0), size - 3)
    step = step.select("*", F.when(~told, F.array_sort(places, order)).alias("_sorted"))
    same = lambda p, q: F.forall(
        F.array(F.lit(0), F.lit(1), F.lit(2)), lambda k: F.get(words, p + k) == F.get(words, q + k)
    )
    return step.select(
        "*",
        F.when(told, _covered(F.col("_found")))
        .otherwise(_covered(_repeats(words, F.col("_sorted"), lambda p: p, same)))
        .alias("_repeats"),
    )


def measure(
    df: DataFrame, max_lost: float = 0.5, min_words: int = 50, name: str = "quality"
) -> DataFrame:
    """Every row of ``df`` with a struct ``name``: the measures, the verdict and the cleaned text.

    Fields: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept,
    n_failed_lines, lost (share of word characters in removed lines), cleaned.

    ``base_failed``: fewer than ``min_words`` words, or over half of them in repeated windows.
    Otherwise a document is kept unless its failed lines hold over ``max_lost`` of its word
    characters. A null or empty text has no words: base_failed, not kept, lost 0. Rows are
    judged one by one, so ids, repeated rows and other columns don't matter; an existing
    column ``name`` is replaced. An empty table gives an empty result.
    """
    own = [F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row")]
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    step = df.select(*own, text.alias("_text"))
    step = step.select("*", words_of(F.col("_text")).alias("_words"))
    size = F.size("_words")
    step = _repeated_words(step).select(
        "*",
        F.filter(
            F.split("_text", "\n"), lambda x: F.btrim(x, F.lit(_BLANKS)) != ""
        ).alias("_lines"),
    )
    step = step.select(
        "*",
        F.transform(
            "_lines",
            lambda x: F.struct(
                x.alias("line"),
                line_verdict(x).alias("failed"),
            ),
        ).alias("_judged"),
        size.cast("long").alias("_n"),
        F.length(F.array_join("_words", "")).cast("long").alias("_chars"),
    )
    # a line's word characters: all but its blanks
    gone = F.aggregate(
        F.filter("_judged", lambda x: x["failed"].isNotNull()),
        F.lit(0).cast("long"),
        lambda total, x: total + F.length(F.translate(x["line"], _BLANKS, "")),
    )
    failed = (F.col("_n") < min_words) | (100 * F.col("_repeats") > 50 * F.col("_n"))
    lost = F.when(F.col("_chars") > 0, gone / F.col("_chars")).otherwise(F.lit(0.0))
    step = step.select("*", failed.alias("_failed"), lost.alias("_lost"))
    quality = F.struct(
        F.col("_n").alias("n_words"),
        F.col("_chars").alias("word_chars"),
        _without(F.col("_text"), SYMBOLS).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.col("_repeats").alias("n_repeat_words"),
        F.col("_failed").alias("base_failed"),
        (~F.col("_failed") & (F.col("_lost") <= max_lost)).alias("kept"),
        F.size(F.filter("_judged", lambda x: x["failed"].isNotNull())).cast("long").alias("n_failed_lines"),
        F.col("_lost").alias("lost"),
        F.array_join(
            F.transform(
                F.filter("_judged", lambda x: x["failed"].isNull()), lambda x: x["line"]
            ),
            "\n",
        ).alias("cleaned"),
    )
    # the generator keeps a later filter on the struct from being rewritten into all the
    # expressions above, each as often as it is used
    done = step.select("_row", F.explode(F.array(quality)).alias("_quality"))
    kept = [F.col("_row").getField(c).alias(c) for c in df.columns if c != name]
    return done.select(*kept, F.col("_quality").alias(name))
