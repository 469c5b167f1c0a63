"""Quality classifier: random Fourier features of document statistics, ridge, isotonic scores."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from shelftalk.llm.common import by_merge
from shelftalk.sources.scratch import materialize

FOLDS = 5  # crc32 of the id as text, modulo this, is the fold; fold 0 is held out
CUT = 0.3
N_STATISTICS = 18


def fold(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS))


def statistics(text: str) -> list[float]:
    """Shares of kinds of bytes, words and lines, and the logarithm of the size; none depends
    on which words there are."""
    data = text.encode()
    n = max(len(data), 1)
    kinds = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
    share = lambda *spans: float(sum(kinds[a:z].sum() for a, z in spans)) / n
    words = data.split()
    m = max(len(words), 1)
    lines = [x for x in data.split(b"\n") if x.strip()]
    long = sum(map(len, words)) / m
    repeats = sum(map(bytes.__eq__, words, words[1:])) / m
    marks = kinds[[33, 46, 58, 59, 63]].sum()
    return [
        np.log1p(len(data)),
        np.log1p(len(words)),
        long,
        len(set(words)) / m,
        repeats,
        share((65, 91)),
        share((97, 123)),
        share((48, 58)),
        share((128, 256)),
        share((33, 34)) * long,
        float(kinds[[35, 36, 37, 38, 42]].sum()) / m,
        float(kinds[[60, 62, 124, 126]].sum()) / m,
        float(kinds[44]) / m,
        float(marks) / m,
        np.log1p(m / max(len(lines), 1)),
        len(set(lines)) / max(len(lines), 1),
        sum(x.rstrip()[-1:] in b".!?\"')" for x in lines) / max(len(lines), 1),
        float(kinds[:9].sum() + kinds[14:32].sum() + kinds[127]) / n,
    ]


def statistics_of(text: Column) -> Column:
    """Array of statistics; a null text is empty."""

    @pandas_udf("array<double>")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([statistics(t) for t in texts])

    return run(F.coalesce(text.cast("string"), F.lit("")))


@dataclass(frozen=True)
class Scorer:
    """Standardised statistics -> cosine features -> linear score -> calibrated share."""

    mean: np.ndarray
    spread: np.ndarray
    frequency: np.ndarray
    phase: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    values: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.spread, -8, 8)
        wave = np.cos(z @ self.frequency + self.phase) * np.sqrt(2 / len(self.phase))
        return np.hstack([wave, np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        """0 to 1; between two knots on the line that joins them."""
        return np.interp(self.raw(x), self.knots, self.values)

    def column(self, stats: Column) -> Column:
        @pandas_udf("double")
        def run(rows: pd.Series) -> pd.Series:
            if not len(rows):
                return pd.Series([], dtype="float64")
            return pd.Series(self.score(np.array(rows.tolist(), dtype=np.float64)))

        return run(stats)


def _sums(stats: DataFrame, start: Scorer | None) -> np.ndarray:
    """Sums over the rows of ``stats`` (``stats``, ``label``): of 1, x and x*x without ``start``;
    with it the normal equations, a row for each feature, its products with all features and
    with the label.

    Each partition sends its own sums, one row a feature; they are added up by the feature's
    number, and only the total comes to the driver, whose size the features alone decide.
    """

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.array(batch.column(0).to_pylist(), dtype=np.float64)
            y = batch.column(1).to_numpy(zero_copy_only=False).astype(np.float64)
            if start is None:
                one = np.vstack([np.hstack([[len(x)], x.sum(axis=0), (x * x).sum(axis=0)])])
            else:
                f = start.features(x)
                one = np.hstack([f.T @ f, (f.T @ y)[:, None]])
            total = one if total is None else total + one
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(total))), pa.array(list(total), pa.list_(pa.float64()))],
                names=["i", "v"],
            )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                sums[i] = sums.get(i, 0) + np.array(v)
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums), pa.int64()), pa.array(list(sums.values()), pa.list_(pa.float64()))],
                names=["i", "v"],
            )

    kinds = "i long, v array<double>"
    rows = stats.select("stats", "label").mapInArrow(part, kinds).repartition("i").mapInArrow(add, kinds)
    return np.array([r["v"] for r in sorted(rows.collect(), key=lambda r: r["i"])])


def isotonic(score: np.ndarray, good: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over bins in order of score: knots and rising shares."""
    blocks: list[list[float]] = []  # first, last, good, count
    for s, g, n in zip(score, good, count, strict=True):
        blocks.append([s, s, g, n])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][3] >= blocks[-1][2] * blocks[-2][3]:
            _, last, g2, n2 = blocks.pop()
            blocks[-1][1] = last
            blocks[-1][2] += g2
            blocks[-1][3] += n2
    knots = np.array([x for b in blocks for x in b[:2]])
    # half a row of each kind keeps a share off 0 and 1, and so scores apart
    values = np.array([(b[2] + 0.5) / (b[3] + 1) for b in blocks for _ in (0, 1)])
    return knots, np.maximum.accumulate(values)


def train(
    stats: DataFrame, features: int = 256, width: float = 0.35, ridge: float = 1.0, bins: int = 512, seed: int = 7
) -> Scorer:
    """Fit on all rows of a stored table ``stats`` (``stats``, ``label``, ``part``).

    Rows of ``part`` 1 to 3 give the normal equations, those of ``part`` 4 the calibration,
    binned by score into ``bins`` bins. Without rows every score is 0.5.
    """
    fit = stats.where("part < 4")
    moments = _sums(stats, None)
    rng = np.random.default_rng(seed)
    frequency = rng.normal(scale=width, size=(N_STATISTICS, features))
    phase = rng.uniform(0, 2 * np.pi, features)
    if not len(moments):
        zeros = np.zeros(N_STATISTICS)
        return Scorer(zeros, zeros + 1, frequency, phase, np.zeros(features + 1), np.zeros(1), np.full(1, 0.5))
    n, sums, squares = moments[0][0], moments[0][1 : N_STATISTICS + 1], moments[0][N_STATISTICS + 1 :]
    mean = sums / n
    spread = np.sqrt(np.maximum(squares / n - mean**2, 0))
    spread = np.where(spread > 1e-9, spread, 1.0)
    start = Scorer(mean, spread, frequency, phase, np.zeros(features + 1), np.zeros(1), np.full(1, 0.5))
    equations = _sums(fit, start)
    weights = np.zeros(features + 1)
    if len(equations):
        penalty = np.eye(features + 1) * ridge
        penalty[-1, -1] = 1e-6
        weights = np.linalg.solve(equations[:, :-1] + penalty, equations[:, -1])
    scorer = Scorer(mean, spread, frequency, phase, weights, start.knots, start.values)

    @pandas_udf("double")
    def raw(rows: pd.Series) -> pd.Series:
        if not len(rows):
            return pd.Series([], dtype="float64")
        return pd.Series(scorer.raw(np.array(rows.tolist(), dtype=np.float64)))

    half = 2.0  # raw scores lie about 0 and 1
    at = F.floor((F.least(F.greatest(F.col("raw"), F.lit(-half)), F.lit(half)) + half) * bins / (2 * half))
    calibration = stats.where("part = 4").select(raw("stats").alias("raw"), "label")
    held = (
        calibration.groupBy(at.alias("bin"))
        .agg(F.avg("raw").alias("raw"), F.sum("label").alias("good"), F.count("*").alias("n"))
        .collect()  # a row for each of the bins
    )
    held = sorted(held, key=lambda r: r["raw"])
    if not held:
        return Scorer(mean, spread, frequency, phase, weights, np.array([0.0, 1.0]), np.array([0.0, 1.0]))
    knots, values = isotonic(*(np.array([float(r[c]) for r in held]) for c in ("raw", "good", "n")))
    return Scorer(mean, spread, frequency, phase, weights, knots, values)


def statistics_table(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``stats`` of every row, stored: texts are read once and never moved."""
    return materialize(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), statistics_of(F.col("text")).alias("stats"))
    )


def train_on(table: DataFrame, labels: DataFrame) -> Scorer:
    """Fit on the labelled rows of a :func:`statistics_table` that are not held out; an id with
    several labels counts by each distinct one, rows without id or label not at all."""
    known = (
        labels.where("doc_id is not null and quality is not null")
        .select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("label"))
        .where(fold(F.col("doc_id")) != 0)
        .distinct()
    )
    rows = table.join(by_merge(known), "doc_id")
    return train(materialize(rows.select("stats", "label", fold(F.col("doc_id")).alias("part"))))


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Score of every row; labels, language, source and id are no inputs of it.

    A null text is scored as an empty one. A null id counts as an empty text for its fold.
    Repeated rows are scored alike. An empty table gives an empty result; without labels every
    score is 0.5. Columns: doc_id, held_out, score, predicted.
    """
    table = statistics_table(docs)
    scorer = train_on(table, labels)
    return table.select(
        "doc_id",
        (fold(F.col("doc_id")) == 0).alias("held_out"),
        scorer.column(F.col("stats")).alias("score"),
    ).withColumn("predicted", (F.col("score") >= CUT).cast("int"))
