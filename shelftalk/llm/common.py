"""What the corpus operators share: the document table and Arrow batches of bounded size."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterable, Iterator
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space; a word is a run of anything else.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def whole_texts(df: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` alone; a null text is empty. Other columns can't clash."""
    return df.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )


def spare_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_runs(
    batches: Iterable[pa.RecordBatch], limit: int = 4 << 20
) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts of consecutive rows, at most ``limit`` characters together or one row."""
    for batch in batches:
        ids, texts, size = [], [], 0
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            text = text.as_py()
            if texts and size + len(text) > limit:
                yield ids, texts
                ids, texts, size = [], [], 0
            ids.append(doc_id)
            texts.append(text)
            size += len(text)
        if texts:
            yield ids, texts


def by_merge(df: DataFrame) -> DataFrame:
    """``df`` as the side of a join that is sorted and merged, never sent to the driver.

    Spark takes a table for as large as its file, whatever an explode makes of the rows or the
    file's encoding has saved. A side that grows with the input says so by this hint.
    """
    return df.hint("merge")


T = TypeVar("T")


def worker_kept(owner: str, key: object, make: Callable[[], T]) -> T:
    """``make()``, or what it gave an earlier task of this Python worker under the same key.

    Task functions travel by value, so module globals do not outlive a task; this does. What
    another owner keeps is let go, so that a worker that serves one stage after another never
    holds the tables of two.
    """
    name = "shelftalk_worker_kept"
    kept = sys.modules.setdefault(name, types.ModuleType(name)).__dict__.setdefault("kept", {})
    for other in [o for o in kept if o != owner]:
        del kept[other]
    own = kept.setdefault(owner, {})
    if key not in own:
        own[key] = make()
    return own[key]


def arrow_rows(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], type=f.type) for f in schema], schema=schema
    )
