"""Tables written between stages.

A stage that is read more than once, or whose row placement must not change when a
task is re-run, is written as Parquet into the folder the cluster names in
``spark.checkpoint.dir``. That folder is shared, so the table outlives any executor,
its columns can be pruned, and its file size lets the optimiser decide on a broadcast
from a known size instead of a guess.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """Shared scratch folder of the session; a temporary one only in local mode."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="shelftalk-"))
    return context.getCheckpointDir()


def new_path(spark: SparkSession) -> str:
    return f"{scratch_root(spark).rstrip('/')}/shelftalk-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once and return a scan of the written table."""
    spark = df.sparkSession
    path = new_path(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def delete_tables(spark: SparkSession, tables: Iterable[DataFrame]) -> None:
    """Remove written tables once nothing reads them any more."""
    root = scratch_root(spark)
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for table in tables:
        for folder in {name.rsplit("/", 1)[0] for name in table.inputFiles()}:
            if f"{root}/shelftalk-" not in folder:
                raise ValueError(f"not a scratch table: {folder}")
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Spread a scan over all cores if it has fewer splits than there are cores.

    For work that is heavy per row, on input of a few files. A large scan stays as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, key)
