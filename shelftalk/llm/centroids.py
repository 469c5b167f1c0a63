"""Centroid clustering of integer vectors, exact, with Ptolemaic lower bounds.

For points x and c and pivots p and q of a Euclidean space, Ptolemy's inequality gives
``d(x, c) * d(p, q) >= |d(x, p) * d(c, q) - d(x, q) * d(c, p)|``. The distances of every vector
to a few fixed pivots are computed once and stored beside it, so a lower bound for a centroid
costs two products a pivot pair. Bounds are rounded down; centroids that they can't rule out
are compared in integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelftalk.llm.common import arrow_rows
from shelftalk.sources.scratch import materialize

#: Components stay below this, so that a squared distance of up to 64 of them is a long.
LIMIT = 1 << 27
#: Relative rounding of a few double operations, with room to spare.
_EPS = 1e-12
_ROWS = 4096


def _matrix(column: pa.ListArray, width: int, dtype: type) -> np.ndarray:
    return np.asarray(column.flatten()).astype(dtype).reshape(-1, width)


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = a - b
    return np.einsum("ij,ij->i", d, d)


def _distances(rows: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Distances of every row to every point, in doubles."""
    return np.sqrt(np.stack([_squares(rows, p[None, :]) for p in points], axis=1).astype(float))


def pivots_of(points: np.ndarray, n: int) -> np.ndarray:
    """``n`` distinct points far from one another: the first, then always the one farthest from
    those before."""
    if len(points) == 0:
        return points
    chosen, least = [0], _squares(points, points[:1])
    while len(chosen) < n and least.max() > 0:
        chosen.append(int(least.argmax()))
        least = np.minimum(least, _squares(points, points[chosen[-1]][None, :]))
    return points[chosen]


def lower_bounds(rows: np.ndarray, points: np.ndarray, between: np.ndarray) -> np.ndarray:
    """Ptolemaic lower bounds of the distances of all rows to all points, rounded down.

    ``rows`` and ``points`` are distances to the pivots, ``between`` those of the pivots.
    """
    best = np.zeros((len(rows), len(points)))
    for p, q in combinations(range(len(between)), 2):
        one = rows[:, p, None] * points[None, :, q]
        two = rows[:, q, None] * points[None, :, p]
        bound = (np.abs(one - two) - _EPS * (one + two)) / between[p, q]
        np.maximum(best, bound, out=best)
    return best * (1 - _EPS)


def nearest(
    rows: np.ndarray, row_pivots: np.ndarray, centroids: np.ndarray, pivots: np.ndarray
) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid of each row (ties: the smaller number), its exact squared distance, and
    how many distances were computed.

    The centroid with the smallest bound gives an exact upper bound; all others whose bound
    does not exceed it are compared exactly.
    """
    bounds = lower_bounds(row_pivots, _distances(centroids, pivots), _distances(pivots, pivots)) if len(pivots) > 1 else np.zeros((len(rows), len(centroids)))
    guess = bounds.argmin(axis=1)
    upper = _squares(rows, centroids[guess])
    open_ = bounds * bounds * (1 - _EPS) <= upper[:, None] * (1 + _EPS)
    open_[np.arange(len(rows)), guess] = False
    exact = np.full(bounds.shape, np.iinfo(np.int64).max)
    exact[np.arange(len(rows)), guess] = upper
    at, of = np.nonzero(open_)
    for start in range(0, len(at), 1 << 16):
        r, c = at[start : start + (1 << 16)], of[start : start + (1 << 16)]
        exact[r, c] = _squares(rows[r], centroids[c])
    cluster = exact.argmin(axis=1)
    return cluster, exact[np.arange(len(rows)), cluster], len(rows) + len(at)


def whole_vectors(df: DataFrame, size: int = 64, scale: int = 256) -> DataFrame:
    """``vec_id`` and ``vector`` (``floor(scale * x)`` of each component x) of the rows that hold
    exactly ``size`` components, none null or non-finite."""
    schema = pa.schema([("vec_id", pa.int64()), ("vector", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.floor(scale * _matrix(batch.column(1), size, np.float64))
            if len(found) and np.abs(found).max() >= LIMIT:
                raise ValueError(f"a component times {scale} is {LIMIT} or more")
            offsets = np.arange(len(found) + 1, dtype=np.int32) * size
            lists = pa.ListArray.from_arrays(offsets, found.astype(np.int32).ravel())
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], schema=schema)

    x = F.col("embedding").cast("array<double>")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    rows = df.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("vector"), finite.alias("finite"))
    rows = rows.where((F.size("vector") == size) & F.col("finite")).select("vec_id", "vector")
    return rows.mapInArrow(run, "vec_id long, vector array<int>")


def _assigned(
    batches: Iterator[pa.RecordBatch], centroids: np.ndarray, pivots: np.ndarray
) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS):
            part = batch.slice(at, _ROWS)
            rows = _matrix(part.column(1), centroids.shape[1], np.int64)
            cluster, distance, _ = nearest(
                rows, _matrix(part.column(2), len(pivots), np.float64), centroids, pivots
            )
            yield part.column(0), rows, cluster, distance


def _sums(stored: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> dict:
    """Rows and component sums of every non-empty cluster, ``{cluster: (count, sums)}``.

    A task hands back a row for each cluster and component; the driver gets their totals,
    whose number depends on the centroids alone.
    """
    k, width = centroids.shape
    schema = pa.schema([(c, pa.int64()) for c in ("cluster", "part", "value")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, width + 1), dtype=np.int64)
        for _, rows, cluster, _ in _assigned(batches, centroids, pivots):
            np.add.at(total, cluster, np.column_stack([rows, np.ones(len(rows), np.int64)]))
        held = np.flatnonzero(total[:, width])
        yield arrow_rows(
            schema, cluster=held.repeat(width + 1), part=np.tile(np.arange(width + 1), len(held)), value=total[held].ravel()
        )

    parts = stored.mapInArrow(run, "cluster long, part long, value long")
    out: dict = {}
    for r in parts.groupBy("cluster", "part").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("v")).collect():
        out.setdefault(r["cluster"], {})[r["part"]] = int(r["v"])
    return {c: (v[width], [v[i] for i in range(width)]) for c, v in out.items()}


def first_centroids(vectors: DataFrame, k: int, seed: str) -> np.ndarray:
    """The ``k`` vectors of smallest SHA-256 of ``seed:vec_id`` (a null id: no digits), of
    equal hashes the smaller components first."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    rows = vectors.orderBy(F.sha2(key, 256), "vector").select("vector").limit(k).collect()
    return np.array([r["vector"] for r in rows], dtype=np.int64)


def cluster(
    df: DataFrame,
    k: int = 40,
    rounds: int = 5,
    size: int = 64,
    scale: int = 256,
    seed: str = "2",
    pivots: int = 5,
) -> DataFrame:
    """Cluster of every vector after ``rounds`` rounds of exact integer k-means.

    Each round assigns all vectors to the nearest centroid (squared distance; ties: the smaller
    number) and replaces every non-empty centroid by the componentwise floor of the mean. Rows
    whose embedding is null, of another length, or holds a null or non-finite component are
    left out. Repeated rows count each time; a null id is kept. With fewer than ``k`` vectors
    there are fewer centroids, with none an empty result. A component times ``scale`` of
    2^27 or more is an error, since its squared distances are no longs.

    Vectors and their pivot distances are stored once and read in every round. The driver
    holds ``k`` centroids and, a round, ``k * (size + 1)`` sums; nothing grows with the rows.
    Columns: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.
    """
    spark = df.sparkSession
    vectors = materialize(whole_vectors(df, size, scale))
    centroids = first_centroids(vectors, k, seed)
    columns = "vec_id long, cluster int, distance long"
    if not len(centroids):
        more = "cluster_inertia long, inertia long, centroid_sha256 string"
        return spark.createDataFrame([], f"{columns}, {more}")
    fixed = pivots_of(centroids, pivots)

    def add_pivots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d = _distances(_matrix(batch.column(1), size, np.int64), fixed)
            offsets = np.arange(len(d) + 1, dtype=np.int32) * len(fixed)
            lists = pa.ListArray.from_arrays(offsets, d.ravel())
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=["vec_id", "vector", "pivots"])

    stored = materialize(
        vectors.mapInArrow(add_pivots, "vec_id long, vector array<int>, pivots array<double>")
    )
    for _ in range(rounds):
        for c, (n, sums) in _sums(stored, centroids, fixed).items():
            centroids[c] = [s // n for s in sums]

    last = centroids.copy()
    schema = pa.schema([("vec_id", pa.int64()), ("cluster", pa.int32()), ("distance", pa.int64())])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, _, of, distance in _assigned(batches, last, fixed):
            yield arrow_rows(schema, vec_id=ids, cluster=of.astype(np.int32), distance=distance)

    assigned = materialize(stored.mapInArrow(assign, columns))
    inertia = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()
    total = sum(int(r["d"]) for r in inertia)
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in last.tolist()]
    facts = spark.createDataFrame(
        [(r["cluster"], int(r["d"]), total, digest[r["cluster"]]) for r in inertia],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    # a row for each centroid
    return assigned.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
