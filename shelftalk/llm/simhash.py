"""SimHash near-duplicates: pigeonring candidates, full Hamming check, components."""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from shelftalk.llm.common import by_merge, spare_name
from shelftalk.llm.components import components
from shelftalk.sources.scratch import materialize

BITS = 64


def fingerprint(text: str, shingle: int = 3) -> int:
    """Bit by bit the majority of the hashes of all shingles, as a signed 64-bit integer.

    Words are runs without ASCII white space, A-Z lower-cased. A text of fewer words has one
    shingle, its whole sequence; without words the fingerprint is zero.
    """
    words = text.encode().lower().split()  # of bytes: ASCII white space and A-Z alone
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    runs = zip(*(words[i:] for i in range(shingle)), strict=False)
    hashes = [digest(b" ".join(r), 42) for r in runs] or [digest(b" ".join(words), 42)]
    counts = np.zeros(BITS, dtype=np.int64)
    whole = np.array(hashes, dtype="<u8")
    for at in range(0, len(whole), 1 << 16):
        part = np.ascontiguousarray(whole[at : at + (1 << 16)])
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    value = sum(1 << int(b) for b in np.flatnonzero(2 * counts > len(hashes)))
    return value - (1 << BITS) if value >= 1 << (BITS - 1) else value


def fingerprint_of(text: Column, shingle: int = 3) -> Column:
    @pandas_udf("long")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    return run(F.coalesce(text.cast("string"), F.lit("")))


def _segment(value: Column, i: int) -> Column:
    return F.shiftrightunsigned(value, 16 * i).bitwiseAND(F.lit(0xFFFF).cast("long"))


def _differ(a: str, b: str, i: int) -> Column:
    return F.bit_count(_segment(F.col(a).bitwiseXOR(F.col(b)), i % 4))


def near_links(prints: DataFrame) -> DataFrame:
    """Links that join all fingerprints (``fp``, distinct rows) at 3 or fewer differing bits.

    First those at 2 bits or fewer: both lie one flipped bit or none from a common value, so
    each fingerprint goes to its own value and the 64 next to it, and each value links what
    it got to the smallest. That is linear, whatever the size of a group, and any two of a
    value are at 2 bits or fewer.
    """
    flips = F.array(F.lit(0).cast("long"), *[F.lit(1 << b).cast("long") for b in range(BITS - 1)], F.lit(-(1 << 63)).cast("long"))
    spread = prints.select("fp", F.explode(flips).alias("flip")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("value")
    )
    least = spread.groupBy("value").agg(F.min("fp").alias("a"), F.max("fp").alias("b"))
    shared = least.where("a < b")
    links = spread.join(by_merge(shared), "value").where("fp > a").select("a", F.col("fp").alias("b"))
    return links.distinct()


def ring_links(prints: DataFrame) -> DataFrame:
    """Pairs at 3 or fewer differing bits among fingerprints of different ``group``.

    Pigeonring with four segments of 16 bits and a budget of 3: some segment starts a ring
    chain whose first 1, 2, 3 and 4 segments differ by at most 0, 1, 2 and 3 bits, the
    proportional budgets rounded down. The first two steps are the join key: the start, its
    segment, and the next segment with one bit masked, for each of its 16 bits. The third is
    checked on the pair before the whole distance. Keys all of one group are left out
    before the join: their members are linked already.
    """
    starts = F.array(
        *[
            F.struct(F.lit(i).alias("start"), _segment(F.col("fp"), i).alias("first"), _segment(F.col("fp"), (i + 1) % 4).alias("second"))
            for i in range(4)
        ]
    )
    masks = F.array(*[F.lit(1 << b).cast("long") for b in range(16)])
    keyed = (
        prints.select("fp", "group", F.explode(starts).alias("s"))
        .select("fp", "group", "s.*", F.posexplode(masks).alias("bit", "mask"))
        .select(
            "fp",
            "group",
            # start, masked bit, first segment, second segment with the bit set
            F.shiftleft(F.col("start").cast("long") * 16 + F.col("bit"), 32)
            .bitwiseOR(F.shiftleft(F.col("first"), 16))
            .bitwiseOR(F.col("second").bitwiseOR(F.col("mask")))
            .alias("key"),
        )
    )
    mixed = (
        keyed.groupBy("key")
        .agg(F.min("group").alias("low"), F.max("group").alias("high"))
        .where("low < high")
        .select("key")
    )
    some = keyed.join(by_merge(mixed), "key", "left_semi")
    left = some.select("key", F.col("fp").alias("a"), F.col("group").alias("ga"))
    right = some.select("key", F.col("fp").alias("b"), F.col("group").alias("gb"))
    chains = None
    for i in range(4):
        d = [_differ("a", "b", i + j) for j in range(3)]
        chain = (d[0] == 0) & (d[0] + d[1] <= 1) & (d[0] + d[1] + d[2] <= 2)
        chains = chain if chains is None else chains | chain
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= 3
    found = left.join(
        by_merge(right),
        (left["key"] == right["key"]) & (F.col("ga") < F.col("gb")) & chains & close,
    )
    return found.select("a", "b").distinct()


def near_groups(prints: DataFrame) -> DataFrame:
    """``fp`` and ``root`` (a fingerprint) of every distinct fingerprint's component at 3 bits."""
    near = materialize(components(prints, "fp", near_links(prints)))
    grouped = near.withColumnRenamed("root", "group")
    far = materialize(ring_links(grouped))
    names = grouped.select(F.col("fp").alias("a"), F.col("group").alias("ga"))
    others = grouped.select(F.col("fp").alias("b"), F.col("group").alias("gb"))
    links = far.join(by_merge(names), "a").join(by_merge(others), "b").select(
        F.least("ga", "gb").alias("a"), F.greatest("ga", "gb").alias("b")
    ).distinct()
    roots = components(near.select(F.col("root").alias("fp")).distinct(), "fp", links)
    return near.withColumnRenamed("root", "via").join(
        by_merge(roots.select(F.col("fp").alias("via"), "root")), "via"
    ).select("fp", "root")


def component_of(prints: DataFrame, least: Column) -> DataFrame:
    """``fp`` and ``first``, the smallest ``least`` in the component, of each fingerprint in
    ``prints`` (a stored table with a column ``fp``, a row for each document)."""
    own = materialize(prints.groupBy("fp").agg(F.min(least).alias("least")))
    groups = materialize(near_groups(own.select("fp")).join(by_merge(own), "fp"))
    firsts = groups.groupBy("root").agg(F.min("least").alias("first"))
    return groups.join(by_merge(firsts), "root").select("fp", "first")


def near_duplicates(df: DataFrame, shingle: int = 3) -> DataFrame:
    """Fingerprint and component of every row.

    Equal fingerprints are one node, so copies cost nothing beyond one count. A null or empty
    text has fingerprint zero, which links like any other. A null id is never the smallest;
    a component of null ids alone has a null id. An empty table gives an empty result.
    Columns: doc_id, fingerprint (16 hexadecimal digits), component_id.
    """
    rows = materialize(
        df.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            fingerprint_of(F.col("text"), shingle).alias("fp"),
        )
    )
    return rows.join(by_merge(component_of(rows, F.col("doc_id"))), "fp").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("first").alias("component_id"),
    )


def first_of_each(df: DataFrame, shingle: int = 3) -> DataFrame:
    """One row of each component: the smallest id (null ids last), of equal ids the smallest
    CRC of the text, of equal rows one. Only ids, CRCs and fingerprints are grouped; the rows
    move once."""
    crc, order = spare_name(df, "crc"), spare_name(df, "order")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    key = [F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)).alias(order), F.crc32(text.cast("binary")).alias(crc)]
    rows = materialize(df.select(*key, fingerprint_of(F.col("text"), shingle).alias("fp")))
    firsts = component_of(rows, F.struct(order, crc)).select("first.*").distinct()
    kept = df.select("*", *key).join(by_merge(firsts), [order, crc], "left_semi")
    return kept.dropDuplicates([order, crc]).select(*[F.col(f"`{c}`") for c in df.columns])
