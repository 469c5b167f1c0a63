"""Word vocabularies ``(word, index, n)`` of numbered sentence pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelftalk.functions.arrays import MARKERS
from shelftalk.operators.ordering import dense_index

FIRST_INDEX = len(MARKERS)
_PAIR_STEP = 1 << 32  # above the number of words that an array can hold


def _words() -> Column:
    """Words of a pair, the input before the target."""
    return F.concat(F.split("input", " "), F.split("target", " "))


def vocabulary(pairs: DataFrame) -> DataFrame:
    """Words with their counts, numbered from 3 in order of first appearance.

    Pairs come in the order of ``pair_id``, the input before the target. The place of a word
    is one decimal of fixed width, so counts and first places are combined by hashing before
    the shuffle, and a frequent word costs one row per task.
    """
    spoken = pairs.select("pair_id", F.posexplode_outer(_words()).alias("at", "word"))
    place = F.col("pair_id").cast("decimal(19,0)") * F.lit(_PAIR_STEP) + F.col("at")
    seen = spoken.groupBy("word").agg(
        F.count(F.lit(1)).alias("n"), F.min(place).alias("_place")
    )
    return dense_index(seen, ["_place"], "index", FIRST_INDEX).select("word", "index", "n")


def trim(vocabulary: DataFrame, min_count: int = 3) -> DataFrame:
    """Words seen at least ``min_count`` times, renumbered from 3 in the same order."""
    kept = vocabulary.where(F.col("n") >= min_count).withColumnRenamed("index", "_before")
    return dense_index(kept, ["_before"], "index", FIRST_INDEX).select("word", "index", "n")


def pairs_in_vocabulary(pairs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Pairs whose every word, on both sides, is in the vocabulary."""
    words = pairs.select("pair_id", F.explode_outer(F.array_distinct(_words())).alias("word"))
    bad = words.join(vocabulary.select("word"), "word", "left_anti").select("pair_id").distinct()
    return pairs.join(bad, "pair_id", "left_anti")


def trim_statistics(
    vocabulary: DataFrame, trimmed: DataFrame, pairs: DataFrame, kept_pairs: DataFrame
) -> DataFrame:
    """Kept and total words and pairs: ``(what, kept, total, ratio)``."""

    def compared(what: str, kept: DataFrame, whole: DataFrame) -> DataFrame:
        one = F.lit(1)
        marked = kept.select(one.alias("k"), F.lit(0).alias("t")).unionAll(
            whole.select(F.lit(0).alias("k"), one.alias("t"))
        )
        return marked.agg(F.sum("k").alias("kept"), F.sum("t").alias("total")).select(
            F.lit(what).alias("what"), "kept", "total",
            F.try_divide(F.col("kept").cast("double"), F.col("total")).alias("ratio"),
        )

    return compared("words", trimmed, vocabulary).unionByName(
        compared("pairs", kept_pairs, pairs)
    )
