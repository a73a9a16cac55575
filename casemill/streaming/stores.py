"""Micro-batches into two stores: each keeps a ledger of the batches it holds in full, so that a repeat or a repair changes nothing twice."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LEDGER = "ledger"
Tables = dict[str, DataFrame]


class Store:
    """Tables in a folder that grow by numbered batches. A batch's tables are folders of their own, and its line in the ledger is written last: what a
    batch has written without one isn't seen, and is overwritten when the batch comes again."""

    def __init__(self, spark: SparkSession, folder: str, schemas: dict[str, str]):
        self.spark, self.folder, self.schemas = spark, folder.rstrip("/"), schemas | {LEDGER: "number long"}
        for name, schema in self.schemas.items():
            spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{self.folder}/{name}/batch=-1")

    def _all(self, name: str) -> DataFrame:
        return self.spark.read.schema(f"{self.schemas[name]}, batch long").parquet(f"{self.folder}/{name}")

    def batches(self) -> DataFrame:
        """The numbers of the batches that are held in full: a row each."""
        return self._all(LEDGER).select("number").distinct()

    def has(self, number: int) -> bool:
        return not self._all(LEDGER).filter((F.col("batch") == number) & (F.col("number") == number)).isEmpty()

    def put(self, number: int, tables: Tables) -> None:
        for name, rows in tables.items():
            columns = [c.split()[0] for c in self.schemas[name].split(", ")]
            rows.select(*columns).write.mode("overwrite").parquet(f"{self.folder}/{name}/batch={number}")
        line = self.spark.createDataFrame([(number,)], "number long")
        line.coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/{LEDGER}/batch={number}")

    def table(self, name: str) -> DataFrame:
        """The rows of whole batches."""
        return self._all(name).join(self.batches(), F.col("batch") == F.col("number"), "left_semi").drop("batch")

    def batch(self, number: int) -> Tables:
        return {name: self._all(name).filter(F.col("batch") == number).drop("batch") for name in self.schemas if name != LEDGER}


def apply_to_both(rows: DataFrame, checkpoint: str, first: Store, second: Store, to_first: Callable[[DataFrame], Tables], to_second: Callable[[Tables], Tables]) -> None:
    """Takes a stream's new rows by availableNow: what to_first makes of a micro-batch goes into the first store, and what to_second makes of that into the second.

    A stop between the stores leaves a batch that only the first one has. The next run is handed it again, passes the first by
    and completes the second; without another run, repair() does the same.
    """

    def write(batch: DataFrame, number: int) -> None:
        if not first.has(number):
            first.put(number, to_first(batch))
        if not second.has(number):
            second.put(number, to_second(first.batch(number)))

    rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def repair(first: Store, second: Store, to_second: Callable[[Tables], Tables]) -> int:
    """Completes the second store from the batches that only the first one has; returns how many these were. It needs nothing but the stores."""
    open_ = sorted(r.number for r in first.batches().join(second.batches(), "number", "left_anti").collect())
    for number in open_:
        second.put(number, to_second(first.batch(number)))
    return len(open_)
