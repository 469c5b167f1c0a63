"""Suffix-array dedup: bytes of 50-byte strings that start in an earlier document are removed."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from shelftalk.llm.common import arrow_rows
from shelftalk.llm.windows import NO_ID, Units, covered_units, covered_windows, numbered

BYTES = Units(words=False)
SHARD = 256 << 10  # bytes of a suffix array


def suffix_array(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All suffixes in order, and each one's place. Codes are below 511.

    Larsson-Sadakane: after a first sort by four codes, only groups of still equal suffixes
    are sorted again, by the rank of what follows them, and the compared length doubles.
    """
    n = len(codes)
    padded = np.concatenate([codes + 1, np.zeros(3, dtype=np.int64)]).astype(np.int64)  # 0: the end
    key = (padded[:n] << 27) | (padded[1 : n + 1] << 18) | (padded[2 : n + 2] << 9) | padded[3 : n + 3]
    order = np.argsort(key, kind="stable")
    rank = np.zeros(n + 1, dtype=np.int64)  # of the end of the text: 0, of others from 1

    def regroup(places: np.ndarray, keys: np.ndarray) -> None:
        """Rank of each suffix: the first place of its group, plus one."""
        new = np.concatenate([[True], keys[1:] != keys[:-1]])
        rank[order[places]] = np.maximum.accumulate(np.where(new, places, 0)) + 1

    everywhere = np.arange(n)
    regroup(everywhere, key[order])
    done = 4
    while True:
        ranks = rank[order]
        same = np.concatenate([ranks[1:] == ranks[:-1], [False]])
        open_places = np.flatnonzero(same | np.concatenate([[False], same[:-1]]))
        if not len(open_places):
            break
        some = order[open_places]
        keys = rank[some] * (n + 1) + rank[np.minimum(some + done, n)]
        by = np.argsort(keys, kind="stable")
        order[open_places] = some[by]
        regroup(open_places, keys[by])
        done *= 2
    place = np.empty(n, dtype=np.int64)
    place[order] = everywhere
    return order, place


def common_prefixes(
    codes: np.ndarray, order: np.ndarray, place: np.ndarray, starts: np.ndarray, limit: int
) -> np.ndarray:
    """Common prefix of each suffix with the one before it in order, ``limit`` at most.

    Kasai: going through a text from left to right, the common prefix loses one code at most
    from one suffix to the next. All texts (``starts``: bounds, each ends with code 0) go
    through together, one step at a time. A prefix never goes beyond code 0.
    """
    n = len(codes)
    padded = np.concatenate([codes, np.zeros(limit + 1, dtype=codes.dtype)])
    lengths = np.diff(starts)
    by_length = np.argsort(-lengths, kind="stable")
    sorted_lengths = -lengths[by_length]
    common = np.zeros(len(lengths), dtype=np.int64)
    out = np.zeros(n, dtype=np.int64)
    for step in range(int(lengths.max(initial=0))):
        own = by_length[: np.searchsorted(sorted_lengths, -step, side="left")]  # longer than step
        at = starts[own] + step
        before = np.where(place[at] > 0, order[place[at] - 1], -1)
        h = np.maximum(common[own] - 1, 0)
        h[before < 0] = 0
        active = np.flatnonzero(before >= 0)
        while len(active):
            i, b = at[active] + h[active], before[active] + h[active]
            more = (h[active] < limit) & (padded[i] == padded[b]) & (padded[i] != 0)
            active = active[more]
            h[active] += 1
        common[own] = h
        out[place[at]] = h
    return out


class Shard:
    """Distinct windows of some texts in order, the smallest id of each, and who holds them."""

    def __init__(self, doc: np.ndarray, texts: list[bytes], size: int):
        lengths = np.array([len(t) for t in texts], dtype=np.int64)
        starts = np.concatenate([[0], np.cumsum(lengths + 1)])
        raw = np.frombuffer(b"\0".join(texts) + b"\0", dtype=np.uint8).astype(np.int64) + 1
        raw[starts[1:] - 1] = 0
        order, place = suffix_array(raw)
        common = common_prefixes(raw, order, place, starts, size)
        text = np.searchsorted(starts, order, side="right") - 1
        whole = order + size <= starts[text] + lengths[text]
        run = np.cumsum(common < size)[whole]
        self.text = text[whole]
        self.place = order[whole] - starts[self.text]
        new = np.concatenate([[True], run[1:] != run[:-1]]) if len(run) else np.zeros(0, dtype=bool)
        self.group = np.cumsum(new) - 1
        own = doc[self.text]
        self.least = np.minimum.reduceat(own, np.flatnonzero(new)) if len(own) else own
        self.own = own
        at = order[whole][new]
        rows = np.lib.stride_tricks.sliding_window_view((raw - 1).astype(np.uint8), size)[at] if len(at) else np.zeros((0, size), np.uint8)
        # a last byte 1 keeps trailing zeros from being dropped
        ended = np.hstack([rows, np.ones((len(rows), 1), dtype=np.uint8)])
        self.windows = np.ascontiguousarray(ended).view(f"S{size + 1}").reshape(-1)


Table = tuple[np.ndarray, np.ndarray]  # distinct windows in order, the smallest id of each


def merge_two(one: Table, other: Table) -> Table:
    """Windows of both, each placed by binary search."""
    (windows, least), (more, ids) = one, other
    at = np.searchsorted(windows, more)
    known = at < len(windows)
    known[known] = windows[at[known]] == more[known]
    least = least.copy()
    least[at[known]] = np.minimum(least[at[known]], ids[known])
    new = ~known
    return np.insert(windows, at[new], more[new]), np.insert(least, at[new], ids[new])


def merge_all(tables: list[Table]) -> Table:
    """Windows of all shards: neighbours merged, then their results, so that a window moves once
    for each doubling."""
    while len(tables) > 1:
        pairs = zip(tables[::2], tables[1::2])
        tables = [merge_two(*p) for p in pairs] + tables[len(tables) // 2 * 2 :]
    return tables[0]


def confirm_by_suffixes(size: int, shard: int = SHARD):
    """Confirming function for :func:`covered_windows`: suffix arrays of shards, then merged."""

    def confirm(_, doc: np.ndarray, texts: list[bytes]) -> list[np.ndarray]:
        ends = np.cumsum([len(t) for t in texts])
        number = ends // shard
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(number)) + 1, [len(texts)]])
        shards = [Shard(doc[a:z], texts[a:z], size) for a, z in zip(cuts, cuts[1:]) if z > a]
        windows, smallest = merge_all([(s.windows, s.least) for s in shards])
        found = []
        for s, (a, z) in zip(shards, ((a, z) for a, z in zip(cuts, cuts[1:]) if z > a), strict=True):
            least = smallest[np.searchsorted(windows, s.windows)]
            hit = s.own > least[s.group]
            by_text = [np.zeros(0, dtype=np.int64)] * (z - a)
            text, place = s.text[hit], s.place[hit]
            order = np.lexsort((place, text))
            text, place = text[order], place[order]
            bounds = np.searchsorted(text, np.arange(z - a + 1))
            for i in range(z - a):
                if bounds[i] < bounds[i + 1]:
                    by_text[i] = place[bounds[i] : bounds[i + 1]]
            found += by_text
        return found

    return confirm


def _covered(docs: DataFrame, units: Units = BYTES) -> DataFrame:
    return covered_windows(docs, units, confirm_by_suffixes(units.size))


_DIGEST = pa.schema(
    [
        ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
        ("n_spans", pa.int64()), ("kept_sha256", pa.string()),
    ]
)


def removed_spans(covered: np.ndarray) -> np.ndarray:
    """Begin and end of each maximal run."""
    step = np.diff(np.concatenate([[0], covered.astype(np.int8), [0]]))
    return np.stack([np.flatnonzero(step == 1), np.flatnonzero(step == -1)], axis=1)


def keep_bytes(text: str, data: bytes | None, size: int = BYTES.size) -> tuple[bytes, np.ndarray]:
    raw = text.encode()
    covered = covered_units(data, len(raw), size)
    return np.frombuffer(raw, dtype=np.uint8)[~covered].tobytes(), covered


def repeated_bytes(df: DataFrame) -> DataFrame:
    """Counts and digest of every row without its repeated bytes.

    A byte goes if a 50-byte string over it also starts in a document with a smaller id; all
    is judged on the input. Texts are UTF-8, a null text is empty. A null id counts as larger
    than any other. Rows of one id never cover each other. An empty table gives an empty
    result. Columns: doc_id, n_bytes, n_removed, n_spans, kept_sha256.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, text, data in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                kept, covered = keep_bytes(text.as_py(), data.as_py())
                rows.append(
                    (doc, len(covered), len(covered) - len(kept), len(removed_spans(covered)), hashlib.sha256(kept).hexdigest())
                )
            if rows:
                yield arrow_rows(_DIGEST, **dict(zip(_DIGEST.names, zip(*rows, strict=True), strict=True)))

    return _covered(numbered(df)).select("doc_id", "text", "data").mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )


def without_repeats(df: DataFrame) -> DataFrame:
    """The rows of ``df`` with repeated bytes cut out of ``text``; ``n_chars``, if there, follows.

    What is left of a cut character is dropped. A null text stays null.
    """

    @pandas_udf("string")
    def cut(texts: pd.Series, data: pd.Series) -> pd.Series:
        return pd.Series(
            [t if d is None else keep_bytes(t, d)[0].decode(errors="ignore") for t, d in zip(texts, data)],
            dtype=object,
        )

    rows = df.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.struct(
            F.struct(*[F.col(f"`{c}`") for c in df.columns if c != "text"]).alias("own"),
            F.col("text").isNull().alias("no_text"),
        ).alias("row"),
    )
    done = _covered(rows).select("row", cut("text", "data").alias("text"))
    text: Column = F.when(~F.col("row.no_text"), F.col("text"))
    out = []
    for f in df.schema:
        if f.name == "text":
            out.append(text.alias("text"))
        elif f.name == "n_chars":
            out.append(F.length(text).cast(f.dataType).alias("n_chars"))
        else:
            out.append(F.col("row.own").getField(f.name).alias(f.name))
    return done.select(*out)
