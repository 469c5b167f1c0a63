"""Row numbers and neighbours over a whole table, without a single-task window."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelftalk.sources.scratch import materialize

_LOCAL_BITS = 33  # monotonically_increasing_id keeps the row position in its low 33 bits


def dense_index(
    df: DataFrame, order: Sequence[str], name: str = "idx", start: int = 0
) -> DataFrame:
    """Number the rows ``start, start+1, ...`` in the order of ``order``.

    ``order`` must identify a row, so that the numbering is the same for every
    partitioning and a frequent leading key is split by the later ones. Rows are range
    partitioned and sorted, stored together with their position in the partition, and
    shifted by the sizes of the partitions before. Only those sizes, one number per
    partition, pass through the driver.
    """
    spark = df.sparkSession
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order)
    stored = materialize(placed.withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", _LOCAL_BITS)
    local = F.col("_at").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    sizes = stored.groupBy(part.alias("_part")).count().collect()
    offsets, total = [], start
    for row in sorted(sizes, key=lambda r: r["_part"]):
        offsets.append((row["_part"], total))
        total += row["count"]
    shift = spark.createDataFrame(offsets, "_part long, _shift long")
    return (
        stored.withColumn("_part", part)
        .join(F.broadcast(shift), "_part")  # one row per partition
        .withColumn(name, local + F.col("_shift"))
        .drop("_at", "_part", "_shift")
    )


def with_next(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    following: Mapping[str, str],
    span: int = 4096,
) -> DataFrame:
    """Add columns of the next row of the same group (null on a group's last row).

    ``following`` maps new column names to source columns. The table is numbered as a
    whole and cut into runs of ``span`` consecutive rows; the first row of a run is also
    sent to the run before. A window therefore never holds more than ``span + 1`` rows,
    however large a group is. The row number stays in ``_ord``.
    """
    numbered = dense_index(df, [*group, *order], "_ord")
    run = F.floor(F.col("_ord") / span)
    border = (F.col("_ord") % span == 0) & (F.col("_ord") > 0)
    rows = numbered.withColumn(
        "_run", F.explode(F.when(border, F.array(run - 1, run)).otherwise(F.array(run)))
    )
    window = Window.partitionBy("_run").orderBy("_ord")
    looked = F.lead(
        F.struct(
            *[F.col(c).alias(f"g{i}") for i, c in enumerate(group)],
            *[F.col(c).alias(f"v{i}") for i, c in enumerate(following.values())],
        )
    ).over(window)
    same: Column = F.lit(True)
    for i, c in enumerate(group):
        same = same & F.col(f"_next.g{i}").eqNullSafe(F.col(c))
    out = rows.withColumn("_next", looked).where(F.col("_run") == run)
    return out.select(
        *df.columns,
        "_ord",
        *[F.when(same, F.col(f"_next.v{i}")).alias(n) for i, n in enumerate(following)],
        (F.col("_next").isNotNull() & same).alias("_has_next"),
    )
