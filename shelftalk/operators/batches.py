"""Id sequences, seeded draws and padded batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelftalk.functions.arrays import EOS, MARKERS, mask, time_major, without_markers


def encode_pairs(pairs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """``(pair_id, input_ids, target_ids)`` with the end marker; unknown words are an error.

    Both sides are looked up in one join and put back together in one grouping.
    """
    sides = F.array(
        *[
            F.struct(F.lit(i).alias("side"), F.split(c, " ").alias("words"))
            for i, c in enumerate(("input", "target"))
        ]
    )
    words = pairs.select("pair_id", F.inline(sides)).select(
        "pair_id", "side", F.posexplode("words").alias("at", "word")
    )
    unknown = F.raise_error(F.concat(F.lit("unknown word "), F.col("word")))
    found = words.join(vocabulary.select("word", "index"), "word", "left").select(
        "pair_id", "side", "at", F.coalesce("index", unknown.cast("long")).cast("int").alias("id")
    )
    whole = found.groupBy("pair_id").agg(
        F.array_sort(F.collect_list(F.struct("side", "at", "id"))).alias("_all")
    )  # as long as the two sentences of one row were

    def ids(side: int) -> Column:
        own = F.filter("_all", lambda e: e["side"] == side)
        return F.array_append(F.transform(own, lambda e: e["id"]), EOS)

    return whole.select("pair_id", ids(0).alias("input_ids"), ids(1).alias("target_ids"))


def draws(pairs: DataFrame, n_draws: int, seed: int = 0) -> DataFrame:
    """``(draw, pair_id)``: pairs drawn with replacement, the same for the same seed.

    ``pair_id`` must be dense. The MD5 of seed and draw number gives each draw 64 bits, whose
    remainder by the number of pairs is the pair. There are no draws from no pairs.
    """
    total = pairs.agg(F.count(F.lit(1))).scalar()
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")))
    bits = F.conv(F.substring(digest, 1, 16), 16, 10).cast("decimal(20,0)")
    return pairs.sparkSession.range(n_draws).where(total > 0).select(
        F.col("id").alias("draw"), (bits % F.nullif(total, F.lit(0))).cast("long").alias("pair_id")
    )


def batches(drawn: DataFrame, encoded: DataFrame, batch_size: int = 64) -> DataFrame:
    """One row per batch: time-major padded ids, lengths, target mask, target length.

    Within a batch pairs go by input length descending, then by draw.
    """
    rows = drawn.join(encoded, "pair_id").select(
        F.floor(F.col("draw") / batch_size).alias("batch"),
        F.struct(
            (-F.size("input_ids")).alias("neg"), "draw", "pair_id", "input_ids", "target_ids"
        ).alias("row"),
    )
    grouped = rows.groupBy("batch").agg(F.array_sort(F.collect_list("row")).alias("r"))
    sized = grouped.select(
        "batch",
        F.col("r.pair_id").alias("pair_ids"),
        F.col("r.input_ids").alias("inputs"),
        F.col("r.target_ids").alias("targets"),
        F.transform("r", lambda e: -e["neg"]).alias("lengths"),
    ).withColumn("max_target_len", F.array_max(F.transform("targets", F.size)))
    padded = sized.withColumns(
        {
            "inputs": time_major(F.col("inputs"), F.array_max("lengths")),
            "targets": time_major(F.col("targets"), F.col("max_target_len")),
        }
    )
    return padded.withColumn("mask", F.transform("targets", mask))


def training_batches(
    pairs: DataFrame,
    vocabulary: DataFrame,
    n_iteration: int = 4000,
    batch_size: int = 64,
    seed: int = 0,
) -> DataFrame:
    """Batches of drawn pairs; only pairs that were drawn are encoded."""
    drawn = draws(pairs, n_iteration * batch_size, seed)
    wanted = pairs.join(drawn.select("pair_id"), "pair_id", "left_semi")
    return batches(drawn, encode_pairs(wanted, vocabulary), batch_size)


def decode(sequences: DataFrame, vocabulary: DataFrame, key: str, ids: str) -> DataFrame:
    """``(key, text)``: words of the ids without end and padding markers.

    An id that is neither in the vocabulary nor a marker is an error.
    """
    spark = sequences.sparkSession
    markers = spark.createDataFrame(
        [(w, i) for w, i in MARKERS.items()], "word string, index long"
    )
    names = vocabulary.select("word", "index").unionByName(markers)
    at = sequences.select(key, F.posexplode(ids).alias("at", "index"))
    unknown = F.raise_error(F.concat(F.lit("unknown word id "), F.col("index").cast("string")))
    words = (
        at.join(names, "index", "left")
        .withColumn("word", F.coalesce("word", unknown.cast("string")))
        .groupBy(key)
        .agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("_w"))
    )
    return words.select(key, F.array_join(without_markers(F.col("_w.word")), " ").alias("text"))
