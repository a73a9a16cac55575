"""Tables written to shared storage, and rows spread over tasks."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession


#: Spark's estimate of what it knows nothing about is beyond this.
UNKNOWN = 1 << 60


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see: spark.checkpoint.dir. In local mode a new one serves if none is set."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="casemill-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def new_folder(spark: SparkSession, tag: str) -> str:
    """A name in shared storage that nothing else uses."""
    return f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"


def written(df: DataFrame, tag: str) -> DataFrame:
    """df as a table in shared storage: computed once, whoever reads it, and kept when executors are lost."""
    path = new_folder(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def observed(df: DataFrame, tag: str, **counts: Column) -> tuple[DataFrame, dict]:
    """df as a table in shared storage, and named aggregates of its rows that were taken while it was written: no second pass, and one job."""
    seen, path = Observation(), new_folder(df.sparkSession, tag)
    df.observe(seen, *(c.alias(n) for n, c in counts.items())).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), dict(seen.get)


def n_tasks(spark: SparkSession) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def n_splits(rows: DataFrame) -> int:
    """How many splits the tables make that rows are read from, by their sizes; rows that aren't in files count as none."""
    spark = rows.sparkSession
    leaves = rows._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(k).stats().sizeInBytes())) for k in range(leaves.size())]
    size = sum(x for x in sizes if x < UNKNOWN)
    return -(-size // int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))))


def spread(rows: DataFrame, *keys: str) -> DataFrame:
    """rows dealt over all tasks, by keys if any are given: for slow functions of rows, which few bytes of input would leave to one task.

    Without keys nothing is shuffled if the input has as many splits as there are tasks already; with keys there are as many parts as the input has splits, or more.
    """
    tasks = n_tasks(rows.sparkSession)
    if rows.isStreaming:
        return rows.repartition(tasks, *keys)
    splits = n_splits(rows)
    if not keys and splits >= tasks:
        return rows
    return rows.repartition(max(splits, tasks), *keys)
