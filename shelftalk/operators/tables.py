"""Building blocks on any table: profile, histogram, frequency, de-duplication."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelftalk.sources.scratch import materialize


def profile(df: DataFrame, name: str, keys: Sequence[str], approximate: bool = False) -> DataFrame:
    """Rows and columns of a table, and distinct values, minimum and maximum per key."""
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    found = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[
            F.struct(
                F.lit(k).alias("key"),
                distinct(k).alias("n_distinct"),
                F.min(k).cast("long").alias("min_value"),
                F.max(k).cast("long").alias("max_value"),
            ).alias(f"k{i}")
            for i, k in enumerate(keys)
        ],
    )
    return found.select(
        F.lit(name).alias("table_name"),
        "n_rows",
        F.lit(len(df.columns)).alias("n_columns"),
        F.inline(F.array(*[F.col(f"k{i}") for i in range(len(keys))])),
    )


def profiles(tables: Sequence[tuple[str, DataFrame, Sequence[str]]]) -> DataFrame:
    return reduce(DataFrame.unionByName, [profile(df, n, keys) for n, df, keys in tables])


def count_true(df: DataFrame, condition: Column, name: str = "n_true") -> DataFrame:
    return df.agg(F.count_if(condition).alias(name))


def histogram(df: DataFrame, value: str, bins: int = 50) -> DataFrame:
    """Counts in equal-width bins over the whole range; the last bin is closed.

    Values are first counted as they are and stored, so the input is read once and the table
    behind the bins has one row per distinct value. A single distinct value gets a range of
    one around it.
    """
    counted = materialize(
        df.groupBy(F.col(value).alias("v")).agg(F.count(F.lit(1)).alias("c"))
    )
    low, high = counted.select(F.min("v")).scalar(), counted.select(F.max("v")).scalar()
    lo = F.when(low == high, low - 0.5).otherwise(low).cast("double")
    hi = F.when(low == high, high + 0.5).otherwise(high).cast("double")
    binned = (
        counted.withColumns({"lo": lo, "hi": hi})
        .groupBy(
            F.least(
                F.floor((F.col("v") - F.col("lo")) * bins / (F.col("hi") - F.col("lo"))),
                F.lit(bins - 1),
            ).alias("bin")
        )
        .agg(F.sum("c").alias("n"))
    )
    every = df.sparkSession.range(bins).select(
        F.col("id").alias("bin"),
        (lo + (hi - lo) * F.col("id") / bins).alias("bin_from"),
        (lo + (hi - lo) * (F.col("id") + 1) / bins).alias("bin_to"),
    )
    return every.join(binned, "bin", "left").select(
        "bin", "bin_from", "bin_to", F.coalesce("n", F.lit(0)).alias("n")
    )


def frequency(df: DataFrame, value: str) -> DataFrame:
    """One-way frequency table in the order of the values."""
    return df.groupBy(value).agg(F.count(F.lit(1)).alias("n")).orderBy(value)


def first_seen(df: DataFrame, value: str, order: Sequence[str]) -> DataFrame:
    """Distinct values with the place where each occurs first."""
    return df.groupBy(value).agg(F.min(F.struct(*order)).alias("_at")).select(value, "_at.*")


def top(df: DataFrame, by: str, n: int, tie: str, descending: bool = True) -> DataFrame:
    """First ``n`` rows by one key, ties by ``tie`` ascending."""
    key = F.desc(by) if descending else F.asc(by)
    return df.orderBy(key, F.asc(tie)).limit(n)


def ordered_concat(
    df: DataFrame, key: str, order: str, text: str, name: str, span: int = 1000
) -> DataFrame:
    """Strings of a group joined by blanks in row order.

    Done in two levels: pieces of ``span`` consecutive rows, then the pieces. A large group
    is spread over its pieces; only the finished string itself is put together in one place.
    """
    pieces = (
        df.groupBy(key, F.floor(F.col(order) / span).alias("_piece"))
        .agg(F.array_sort(F.collect_list(F.struct(order, text))).alias("_rows"))
        .select(key, "_piece", F.array_join(F.col(f"_rows.{text}"), " ").alias("_text"))
    )
    return (
        pieces.groupBy(key)
        .agg(F.array_sort(F.collect_list(F.struct("_piece", "_text"))).alias("_pieces"))
        .select(key, F.array_join(F.col("_pieces._text"), " ").alias(name))
    )
