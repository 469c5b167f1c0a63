"""Sharding by vector bin packing over bytes, tokens and rows."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelftalk.llm.common import SPACE, whole_texts
from shelftalk.sources.scratch import materialize


#: A load above this share of its level's average block is placed on the level before.
FINE = 128


def fill_shards(loads: np.ndarray, shards: int, taken: np.ndarray | None = None) -> np.ndarray:
    """Shard of each load (rows of ``loads``: bytes, tokens, rows).

    Every shard may take an equal share of each dimension, less what it has ``taken`` (a row
    for each shard) already. Loads are placed largest first,
    each where its dot product with the residual capacity, both as shares, is highest, among
    the shards whose room for it holds; when none has room, where the largest overrun is least.
    """
    taken = np.zeros((shards, loads.shape[1])) if taken is None else taken
    total = np.maximum(loads.sum(axis=0) + taken.sum(axis=0), 1)
    share = loads / total
    room = 1.0 / shards - taken / total
    where = np.empty(len(loads), dtype=np.int32)
    for i in np.argsort(-share.max(axis=1), kind="stable"):
        left = room - share[i]
        fits = left.min(axis=1) >= -1e-12
        if fits.any():
            at = int(np.argmax(np.where(fits, room @ share[i], -np.inf)))
        else:
            at = int(np.argmax(left.min(axis=1)))
        where[i] = at
        room[at] -= share[i]
    return where


def _even_bytes(sizes: np.ndarray, where: np.ndarray, shards: int, taken: np.ndarray | float = 0.0) -> np.ndarray:
    """Move and swap single loads between the fullest and the emptiest shard while that
    brings their bytes closer; the joint placement leaves only small differences.

    ``taken``: bytes each shard holds already. A shard without loads here is not the fullest.
    """
    where = where.copy()
    filled = np.bincount(where, weights=sizes, minlength=shards) + taken
    for _ in range(64 * shards):
        here = np.bincount(where, minlength=shards) > 0
        high, low = int(np.where(here, filled, -np.inf).argmax()), int(filled.argmin())
        gap = filled[high] - filled[low]
        ours, theirs = np.flatnonzero(where == high), np.flatnonzero(where == low)
        if gap <= 1 or not len(ours):
            break
        order = np.argsort(sizes[theirs], kind="stable")
        back = np.concatenate([[0.0], sizes[theirs][order]])  # 0: nothing comes back
        want = sizes[ours] - gap / 2  # what should come back for each load that goes
        near = np.clip(np.searchsorted(back, want), 1, len(back) - 1) if len(back) > 1 else np.zeros(len(ours), int)
        prev = np.maximum(near - 1, 0)
        near = np.where(np.abs(back[near] - want) < np.abs(back[prev] - want), near, prev)
        moved = sizes[ours] - back[near]
        best = int(np.argmin(np.abs(moved - gap / 2)))
        if not 0 < moved[best] < gap:
            break
        where[ours[best]] = low
        if near[best]:
            where[theirs[order[near[best] - 1]]] = high
        filled[high] -= moved[best]
        filled[low] += moved[best]
    return where


def block_counts(groups: int, block: int) -> list[int]:
    """Blocks on each level: one, then ``block / FINE``-fold more, at last ``groups / block``."""
    last, levels = max(1, -(-groups // block)), [1]
    while levels[-1] < last:
        levels.append(min(last, levels[-1] * max(2, block // FINE)))
    return levels


def vector_shards(
    df: DataFrame, shards: int = 8, block: int = 5000, slack: int = 16, run: int = 20_000
) -> DataFrame:
    """Shard and slot of every row, copies together, bytes, tokens and rows balanced jointly.

    * Rows with equal texts form a group with one vector (bytes, tokens, rows); groups are
      counted with map-side sums. A group above ``1 / (shards * slack)`` of any total is dealt
      by a stored row number into parts below it, so repeated rows are dealt out, too. There are at most ``3 * shards * slack`` such groups,
      so that table alone is broadcast.
    * Loads (groups and parts) are placed level by level, the heaviest first: on one block,
      then on ``block / 128``-fold more blocks each time, up to blocks of about ``block``
      groups. A level takes what weighs more than one in ``block`` of its average block, at
      most ``3 * block`` loads a block; the first takes all parts, too, the last one the rest. So no load is more than
      1/128 of the average block it is placed in, but for those on the one block of the first.
    * Each block is packed by :func:`fill_shards`, given its part of what the shards took on
      the levels before; the order of the shards is rotated by the block number so that no
      shard always gets the first pick.
    * Slots are gapless: a row number in runs of about ``run`` rows plus the sizes of the
      runs before.

    Null texts are empty (size 1), null ids stay null. Repeated rows are rows of one group.
    Loads of equal weight are placed in the order of their keys. A part or a slot may differ when
    the table is stored in another order; the totals hold all the same. An empty table gives an empty result. Columns: doc_id, size, text_crc32, shard, slot.
    """
    rows = materialize(
        whole_texts(df).select(
            "doc_id",
            (F.octet_length("text") + 1).cast("long").alias("size"),
            F.size(F.split("text", SPACE)).cast("long").alias("tokens"),
            F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
            F.xxhash64("text").alias("copy"),
            F.monotonically_increasing_id().alias("row"),  # stored, so every reader sees the same
        )
    )
    group = ["copy", "text_crc32", "size"]
    groups = materialize(
        rows.groupBy(*group).agg(F.sum("tokens").alias("tokens"), F.count("*").alias("n"))
    )
    total = groups.agg(
        F.sum(F.col("size") * F.col("n")).alias("size"),
        F.sum("tokens").alias("tokens"),
        F.sum("n").alias("n"),
        F.count("*").alias("groups"),
    ).first()
    part_limit = shards * slack
    parts = F.greatest(
        *[
            F.ceil(load * part_limit / F.lit(max(total[name] or 0, 1)))
            for name, load in (
                ("size", F.col("size") * F.col("n")),
                ("tokens", F.col("tokens")),
                ("n", F.col("n")),
            )
        ]
    ).cast("int")
    # as many parts for each shard, if there is one for each
    parts = F.when(parts > shards, F.ceil(parts / shards) * shards).otherwise(parts).cast("int")
    # at most 3 * shards * slack groups hold more than that share of one of three totals
    hot = groups.where("n > 1").select(*group, parts.alias("parts")).where("parts > 1")
    dealt = rows.join(F.broadcast(hot), group, "left").withColumn(
        "part",
        F.coalesce(
            F.pmod(F.xxhash64("row"), F.col("parts")), F.lit(0)
        ).cast("int"),
    )
    loads = dealt.groupBy(*group, "part").agg(
        F.sum("size").alias("bytes"),
        F.sum("tokens").alias("tokens"),
        F.count("*").alias("n"),
        F.max("parts").isNotNull().alias("hot"),
    )
    share = F.greatest(
        *[
            F.col(load) / F.lit(float(max(total[name] or 0, 1)))
            for load, name in (("bytes", "size"), ("tokens", "tokens"), ("n", "n"))
        ]
    )
    levels = block_counts(total["groups"] or 0, block)
    level = F.lit(len(levels) - 1)
    for k in reversed(range(len(levels) - 1)):
        level = F.when(share > 1.0 / (block * levels[k]), k).otherwise(level)
    loads = materialize(loads.withColumn("level", F.when(F.col("hot"), 0).otherwise(level)))

    def placer(blocks: int, taken: np.ndarray):
        def place(block_of: pd.DataFrame) -> pd.DataFrame:
            own = block_of.sort_values([*group, "part"], kind="stable").reset_index(drop=True)
            vectors = own[["bytes", "tokens", "n"]].to_numpy(dtype=np.float64)
            first = int(own["block"].iloc[0]) % shards
            before = np.roll(taken / blocks, -first, axis=0)
            where = fill_shards(vectors, shards, before)
            own["shard"] = (_even_bytes(vectors[:, 0], where, shards, before[:, 0]) + first) % shards
            return own[[*group, "part", "shard", "bytes", "tokens", "n"]]

        return place

    placed, taken = None, np.zeros((shards, 3))
    for k, blocks in enumerate(levels):
        here = (
            loads.where(F.col("level") == k)
            .withColumn("block", F.pmod(F.xxhash64(*group, "part"), F.lit(blocks)).cast("int"))
            .groupBy("block")
            .applyInPandas(
                placer(blocks, taken.copy()),
                "copy long, text_crc32 long, size long, part int, shard int, bytes long, tokens long, n long",
            )
        )
        if k < len(levels) - 1:  # what the shards hold so far is for the next level
            here = materialize(here)
            for r in here.groupBy("shard").agg(F.sum("bytes"), F.sum("tokens"), F.sum("n")).collect():
                taken[r[0]] += r[1:]
        here = here.select(*group, "part", "shard")
        placed = here if placed is None else placed.unionByName(here)
    runs = max(1, -(-(total["n"] or 0) // (run * shards)))
    out = dealt.join(placed, [*group, "part"]).select(
        "doc_id", "size", "text_crc32", "shard", "copy", "row",
        F.pmod(F.xxhash64("row", "copy"), F.lit(runs)).cast("int").alias("run"),
    )
    out = materialize(out)
    before = (
        out.groupBy("shard", "run")
        .count()
        .withColumn(
            "before",
            F.sum("count").over(
                Window.partitionBy("shard").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
            ),
        )
        .select("shard", "run", F.coalesce("before", F.lit(0)).alias("before"))
    )
    numbered = Window.partitionBy("shard", "run").orderBy("doc_id", "copy", "size", "row")
    return out.withColumn("at", F.row_number().over(numbered)).join(before, ["shard", "run"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("before") + F.col("at") - 1).alias("slot")
    )
