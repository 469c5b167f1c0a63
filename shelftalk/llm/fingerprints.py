"""Threshold-scaled document fingerprints (every shingle hash below a fixed fraction)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelftalk.llm.common import whole_texts
from shelftalk.llm.quality import words_of
from shelftalk.operators.ordering import dense_index
from shelftalk.sources.scratch import materialize

SHINGLE = 5
FRACTION = 0.25
SMALL = 64  # shingles of a text that is kept whole


def shingle_hashes(words: Column, size: int = SHINGLE) -> Column:
    """Hash of each run of ``size`` words; of the whole sequence if it is shorter."""
    whole = F.when(F.size(words) > 0, F.array(F.xxhash64(words))).otherwise(
        F.array().cast("array<bigint>")
    )
    hashed = F.transform(words, lambda w: F.xxhash64(w))
    runs = lambda h: F.transform(
        F.slice(h, 1, F.greatest(F.size(h) - (size - 1), F.lit(0))),
        lambda x, i: F.xxhash64(x, *[F.get(h, i + j) for j in range(1, size)]),
    )
    # transform over a one-element array binds the word hashes once
    bound = F.get(F.transform(F.array(hashed), runs), F.lit(0))
    return F.when(F.size(words) >= size, bound).otherwise(whole)


def sketch(hashes: Column, fraction: float = FRACTION) -> Column:
    """``low``, the distinct hashes below the fraction, sorted, and ``all``, every distinct hash,
    of a text with no more than ``SMALL`` of them (else null).

    ``low`` has nothing but hashes below the fraction, so those of parts merge into that of
    their union by ``array_union``, whatever the sizes of the parts. A short text may have none;
    ``all`` compares such texts exactly, and merges as long as the union stays short.
    """
    limit = int(-(1 << 63) + fraction * (1 << 64))
    low = F.filter(hashes, lambda h: h < F.lit(limit).cast("long"))
    few = F.when(F.size(hashes) <= SMALL, F.sort_array(F.array_distinct(hashes)))
    return F.struct(F.sort_array(F.array_distinct(low)).alias("low"), few.alias("all"))


def _sets(a: Column, b: Column) -> tuple[Column, Column]:
    """Whole sets where both texts are short, else the hashes below the fraction."""
    short = a["all"].isNotNull() & b["all"].isNotNull()
    return tuple(F.when(short, x["all"]).otherwise(x["low"]) for x in (a, b))


def containment(part: Column, whole: Column) -> Column:
    """Share of ``part``'s shingles that ``whole`` has: exact between short texts, else estimated
    from the hashes below the fraction, null if ``part`` has none there. Without shingles 1."""
    of, to = _sets(part, whole)
    common = F.size(F.array_intersect(of, to))
    share = F.when(F.size(of) > 0, common / F.size(of))
    return F.when(F.size(part["all"]) == 0, F.lit(1.0)).otherwise(share)


def likeness(a: Column, b: Column) -> Column:
    """Share of common shingles, exact between short texts, else estimated; of two texts without
    any 1. Texts that are not both short and have no hash below the fraction are not alike."""
    x, y = _sets(a, b)
    either = F.size(F.array_union(x, y))
    bare = F.when((F.size(a["all"]) == 0) & (F.size(b["all"]) == 0), F.lit(1.0)).otherwise(F.lit(0.0))
    return F.when(either > 0, F.size(F.array_intersect(x, y)) / either).otherwise(bare)


def fingerprints(df: DataFrame, fraction: float = FRACTION, size: int = SHINGLE) -> DataFrame:
    """``doc_id``, ``text`` and ``sketch`` (see :func:`sketch`) of every row; a null text is empty."""
    return _with_sketch(whole_texts(df), fraction, size)


def _with_sketch(texts: DataFrame, fraction: float, size: int) -> DataFrame:
    words = texts.select("*", words_of(F.lower("text")).alias("_words"))
    hashed = words.select(*texts.columns, shingle_hashes(F.col("_words"), size).alias("_h"))
    return hashed.select(*texts.columns, sketch(F.col("_h"), fraction).alias("sketch"))


def next_ids(df: DataFrame) -> DataFrame:
    """Per distinct ``doc_id`` the next one in descending order; after the last the first.

    Only ids move; null counts as the last. The row number comes from a range partition, so no
    task sees all ids.
    """
    ids = dense_index(
        df.groupBy("doc_id").agg(F.max(F.length("text")).alias("_chars")).select(
            "_chars", "doc_id", F.coalesce(-F.col("doc_id").cast("decimal(20,0)"), F.lit(10) ** 19)
            .cast("decimal(20,0)").alias("_order"),
        ),
        ["_order"],
        "place",
    )
    n = max(ids.count(), 1)
    following = ids.select(
        F.pmod(F.col("place") - 1, F.lit(n)).alias("place"), F.col("doc_id").alias("next_id")
    )
    return ids.join(following, "place").select("doc_id", "next_id", "_chars")


def edited_fingerprints(
    df: DataFrame, fraction: float = FRACTION, size: int = SHINGLE
) -> DataFrame:
    """Fingerprint of every text and of its edited text, and their likeness.

    The edited text has the last third of its code points replaced by the first of the next
    document in descending order of ids. Texts move twice, by their own id: to hand their
    head and sketch to the document before, and to meet the head they get.

    Null texts are empty; a null id comes last in the order. Several rows of one id are
    edited each for itself with the same next id, whose smallest head and sketch count. A
    single document is its own next. An empty table gives an empty result.

    Columns: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint (number of kept
    hashes and their digest), near_edited, near_next (likeness), in_edited, in_next
    (containment; null where a sketch can't tell), sketch (the text's hashes below the
    fraction, to be merged and compared further).
    """
    # an id as two columns without nulls, so that all joins and groups share one partitioning
    two = lambda c: [F.col(c).isNull().alias("_no"), F.coalesce(F.col(c), F.lit(0)).alias("_id")]
    texts = whole_texts(df)
    links = materialize(next_ids(texts))
    wanted = links.select(
        *two("next_id"),
        F.col("doc_id").alias("_for"),
        F.floor(F.col("_chars") / 3).cast("int").alias("_take"),
    )
    # texts move before they are hashed: sketches are made again where they are needed
    # (the id is made anew, so that both uses read the same columns of one exchange)
    moved = texts.select("text", *two("doc_id")).repartition("_no", "_id")
    own = _with_sketch(moved, fraction, size)
    heads = (
        own.join(wanted, ["_no", "_id"])
        .select(*two("_for"), F.struct(F.expr("substring(text, 1, _take)").alias("head"), "sketch").alias("_next"))
        .groupBy("_no", "_id")
        .agg(F.min("_next").alias("_next"))
    )
    met = own.join(heads, ["_no", "_id"])
    n_chars = F.length("text")
    cut = F.floor(n_chars / 3).cast("int")
    edited = met.select(
        F.when(~F.col("_no"), F.col("_id")).alias("doc_id"),
        n_chars.cast("long").alias("n_chars"),
        "sketch",
        F.col("_next.sketch").alias("_next"),
        F.concat(
            F.substring("text", F.lit(1), n_chars - cut),
            F.substring(F.col("_next.head"), F.lit(1), cut),
        ).alias("_edited"),
    )
    words = edited.select("*", words_of(F.lower("_edited")).alias("_words"))
    hashed = words.select("*", shingle_hashes(F.col("_words"), size).alias("_h"))
    both = hashed.select("*", sketch(F.col("_h"), fraction).alias("_sketch"))

    def name(s: Column) -> Column:
        kept = F.coalesce(s["all"], s["low"])
        return F.concat_ws(
            ":", F.size(kept).cast("string"), F.sha2(F.array_join(kept.cast("array<string>"), ","), 256)
        )

    return both.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("_edited").cast("binary"), 256).alias("edited_sha256"),
        name(F.col("sketch")).alias("fingerprint"),
        name(F.col("_sketch")).alias("edited_fingerprint"),
        likeness(F.col("sketch"), F.col("_sketch")).alias("near_edited"),
        likeness(F.col("sketch"), F.col("_next")).alias("near_next"),
        containment(F.col("sketch"), F.col("_sketch")).alias("in_edited"),
        containment(F.col("sketch"), F.col("_next")).alias("in_next"),
        F.col("sketch.low").alias("sketch"),
    )
