"""Importance resampling of documents towards a target text distribution.

Features are runs of words, hashed into a fixed number of buckets. A bucket's gain is the log
ratio of its share in the target and in the corpus; a document weighs the gains of all its
features. Gumbel noise turns the highest scores into a draw without replacement.

The draw is a distributed quickselect: random keys are pivots, one three-way count over the
table says between which of them (or at which) the k-th key lies, and only the rows between
them are looked at again. Nothing is sorted but the winners.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelftalk.llm.common import arrow_rows
from shelftalk.operators.ordering import dense_index
from shelftalk.sources.scratch import materialize

#: Pivots of a round: each cuts what is left to about a 25th.
PIVOTS = 24

_WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)


def words(text: bytes) -> list[bytes]:
    """Runs of ASCII digits and letters (A-Z lower-cased) and of anything beyond ASCII."""
    return text.translate(_WORD_BYTES).split()


def feature_buckets(found: list[bytes], longest: int, buckets: int) -> np.ndarray:
    """Bucket of every run of 1 to ``longest`` words, repeats included."""
    hashes = [zlib.crc32(w) for w in found]
    for n in range(2, longest + 1):
        runs = zip(*(found[i:] for i in range(n)), strict=False)
        hashes += [zlib.crc32(b" ".join(r)) for r in runs]
    return (np.array(hashes, dtype=np.int64) % buckets).astype(np.int32)


def features(df: DataFrame, longest: int = 1, buckets: int = 10_000) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_features`` and ``buckets`` (an entry for each feature)."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_features", pa.int64()), ("buckets", pa.list_(pa.int32()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            at = 0
            while at < len(texts):  # rows whose features stay small together, or one row
                start, counts, parts, size = at, [], [], 0
                while at < len(texts) and (at == start or size < 1 << 20):
                    found = words(texts[at].as_py())
                    parts.append(feature_buckets(found, longest, buckets))
                    counts.append(len(found))
                    size += len(parts[-1])
                    at += 1
                sizes = np.array([len(p) for p in parts], dtype=np.int64)
                offsets = np.concatenate([[0], sizes.cumsum()]).astype(np.int32)
                lists = pa.ListArray.from_arrays(offsets, np.concatenate(parts))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(start, at - start), pa.array(counts, pa.int64()), pa.array(sizes), lists], schema=schema
                )

    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text")
    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), text)
    return rows.mapInArrow(run, "doc_id long, n_words long, n_features long, buckets array<int>")


def bucket_counts(stored: DataFrame, buckets: int) -> list[int]:
    """Features of all rows in each bucket; the driver receives one number a bucket."""
    counts = stored.select(F.explode("buckets").alias("b")).groupBy("b").count().collect()
    out = [0] * buckets
    for row in counts:
        out[row["b"]] = row["count"]
    return out


def gains(corpus: list[int], target: list[int]) -> np.ndarray:
    """Log ratio of the smoothed shares of each bucket, in thousandths, rounded down."""
    buckets, s_all, t_all = len(corpus), float(sum(corpus)), float(sum(target))
    return np.array(
        [
            math.floor(1000 * math.log((t + 1.0) * (s_all + buckets) / ((s + 1.0) * (t_all + buckets))))
            for s, t in zip(corpus, target, strict=True)
        ],
        dtype=np.int64,
    )


def noise(seed: str, doc_id: int | None) -> int:
    """Gumbel noise in thousandths, rounded down, from a hash of the id (null: no digits)."""
    key = f"{seed}:{'' if doc_id is None else doc_id}".encode()
    h = int(hashlib.sha256(key).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scores(stored: DataFrame, gain: np.ndarray, seed: str) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_features``, ``weight`` and ``score`` of stored features."""
    schema = pa.schema([(c, pa.int64()) for c in ("doc_id", "n_words", "n_features", "weight", "score")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            offsets = np.asarray(lists.offsets)
            each = gain[np.asarray(lists.values)[offsets[0] : offsets[-1]]]
            total = np.concatenate([[0], each.cumsum()])
            weight = np.diff(total[offsets - offsets[0]])
            ids = batch.column(0).to_pylist()
            luck = np.array([noise(seed, i) for i in ids], dtype=np.int64)
            yield arrow_rows(
                schema, doc_id=batch.column(0), n_words=batch.column(1), n_features=batch.column(2),
                weight=weight, score=weight + luck,
            )

    return stored.mapInArrow(run, ", ".join(f"{f.name} long" for f in schema))


#: Highest score, smallest id (null last), then the row's place: a total order.
_KEY = ("_neg", "_no_id", "_id", "_place")


def _keyed(rows: DataFrame) -> DataFrame:
    return rows.select(
        "*",
        (-F.col("score")).alias("_neg"),
        F.col("doc_id").isNull().alias("_no_id"),
        F.coalesce("doc_id", F.lit(0)).alias("_id"),
    )


def _key() -> Column:
    return F.struct(*_KEY)


def _value(key: tuple) -> Column:
    return F.struct(*[F.lit(v).alias(n) for v, n in zip(key, _KEY, strict=True)])


def kth_key(rows: DataFrame, k: int, pivots: int = PIVOTS) -> tuple:
    """The ``k``-th smallest key (from 1) of a stored table, by quickselect.

    Every round draws up to ``pivots`` random rows, counts the rows between and at them, and
    stores the rows of the one interval that holds the key. Rounds grow with the logarithm of
    the rows, the driver sees the pivots and one count for each place between them.
    """
    left, at, turn = rows.select(*_KEY), k, 0
    while True:
        drawn = left.orderBy(F.xxhash64("_place", F.lit(turn)), "_place").limit(pivots).collect()
        marks = sorted(tuple(r) for r in drawn)
        above = [(_key() > _value(m)).cast("int") + (_key() >= _value(m)).cast("int") for m in marks]
        slot = sum(above[1:], above[0])  # twice the pivots below, one more at a pivot
        found = dict(left.groupBy(slot.alias("slot")).count().collect())
        for i in range(2 * len(marks) + 1):
            if at <= found.get(i, 0):
                break
            at -= found.get(i, 0)
        else:
            raise ValueError(f"no key number {k}")
        if i % 2:
            return marks[i // 2]
        inside = []
        if i > 0:
            inside.append(_key() > _value(marks[i // 2 - 1]))
        if i < 2 * len(marks):
            inside.append(_key() < _value(marks[i // 2]))
        for condition in inside:
            left = left.where(condition)
        left, turn = materialize(left), turn + 1


def resample(
    df: DataFrame,
    target: DataFrame,
    percent: int = 10,
    longest: int = 1,
    buckets: int = 10_000,
    least_words: int = 20,
    seed: str = "2024",
    pivots: int = PIVOTS,
) -> DataFrame:
    """Weight, score and rank of every row of ``df``; null ranks are not drawn.

    Of the rows with ``least_words`` words or more, ``percent`` hundredths (rounded down) are
    drawn, highest score first, of equal scores the smallest id, null ids last. Rows of equal
    score and id (repeated rows) are drawn one by one in the order they are stored in. Null
    and empty texts have no features, weight 0 and are not drawn unless ``least_words`` is 0.
    An empty table gives an empty result, an empty target equal shares. Texts are read whole;
    other columns are not looked at. A null id has noise of its own, the hash of no digits.

    Features are counted once and stored; corpus and target counts are one number a bucket on
    the driver. Columns: doc_id, n_features, weight, score, rank.
    """
    stored = materialize(features(df, longest, buckets))
    wanted = target.select(F.lit(None).alias("doc_id"), "text")
    wanted = bucket_counts(features(wanted, longest, buckets), buckets)
    gain = gains(bucket_counts(stored, buckets), wanted)
    place = F.monotonically_increasing_id().alias("_place")
    scored = materialize(scores(stored, gain, seed).select("*", place))
    able = _keyed(scored).where(F.col("n_words") >= least_words)
    k = able.count() * percent // 100
    out = ["doc_id", "n_features", "weight", "score"]
    unranked = F.lit(None).cast("long").alias("rank")
    if not k:
        return scored.select(*out, unranked)
    last = _value(kth_key(able, k, pivots))
    drawn = dense_index(able.where(_key() <= last), _KEY, "rank", 1)
    wins = (F.col("n_words") >= least_words) & (_key() <= last)
    rest = _keyed(scored).where(~wins).select(*out, unranked)
    return drawn.select(*out, "rank").unionByName(rest)


def drawn_documents(df: DataFrame, target: DataFrame, **parameters) -> DataFrame:
    """The drawn rows of ``df``, all columns, for a table whose ids identify its rows; rows
    with a null id are left out. Only ids of winners are joined."""
    drawn = resample(df, target, **parameters).where("rank IS NOT NULL").select("doc_id")
    return df.join(drawn.distinct(), "doc_id", "left_semi").select(*[F.col(f"`{c}`") for c in df.columns])
