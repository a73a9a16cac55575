"""What several operators use: shared storage, checked broadcasts, distributed running sums."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casemill.operators.storage import shared_dir

#: The characters that separate words, and a word, as Java, RE2 and Python all read them.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Bytes of one Arrow batch while a table is written: tasks hold one on either side of the Python worker's pipe.
BATCH, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20
#: Parquet's reading of many ranges at once. On local disks each thread that serves it keeps a buffer outside the heap as large as the longest
#: range that it ever read, up to a row group, until the executor ends; ranges are read one after the other instead.
RANGES = "parquet.hadoop.vectored.io.enabled"
#: Bytes of a Parquet row group, which a writing task holds in memory.
ROW_GROUP = 32 << 20

#: Bytes up to which a table may be broadcast; larger ones are joined by a shuffle.
BROADCAST_BYTES = 32 << 20


def new_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"


#: Paths of the tables that materialize() has written within scratch().
_MADE: ContextVar[list[str] | None] = ContextVar("made", default=None)


@contextmanager
def scratch() -> Iterator[list[str]]:
    """Within it, the paths of tables that operators write on their way; whoever has written the result may remove() them."""
    around, made = _MADE.get(), []
    token = _MADE.set(made)
    try:
        yield made
    finally:
        _MADE.reset(token)
        if around is not None:
            around.extend(made)


@contextmanager
def configured(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Within it the session has these settings; afterwards those that it had."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


def materialize(df: DataFrame, tag: str, compression: str = "snappy") -> DataFrame:
    """Writes df to shared storage and reads it back: cuts lineage, and survives lost executors."""
    spark, path = df.sparkSession, new_path(df.sparkSession, tag)
    if (made := _MADE.get()) is not None:
        made.append(path)
    with configured(spark, {BATCH: str(BATCH_BYTES), RANGES: "false"}):
        df.write.option("parquet.block.size", ROW_GROUP).parquet(path, compression=compression)
    return spark.read.schema(df.schema).option(RANGES, "false").parquet(path)


def n_bytes(df: DataFrame) -> int:
    """The bytes that the rows of df take: 16 for each row, 8 for each field, and those of texts and elements."""
    more = [F.octet_length(F.col(f"`{f.name}`")) for f in df.schema if isinstance(f.dataType, T.StringType | T.BinaryType)]
    more += [16 * F.greatest(F.lit(0), F.size(F.col(f"`{f.name}`"))) for f in df.schema if isinstance(f.dataType, T.ArrayType)]
    size = sum((F.coalesce(m, F.lit(0)).cast("long") for m in more), F.lit(16 + 8 * len(df.columns)).cast("long"))
    return df.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]


def small(df: DataFrame) -> DataFrame:
    """df with a broadcast hint if it takes no more than BROADCAST_BYTES (it is measured), else as it is."""
    return F.broadcast(df) if n_bytes(df) <= BROADCAST_BYTES else df


def n_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def same(left: DataFrame, right: DataFrame, *names: str) -> Column:
    """Equality of the named columns, nulls being equal."""
    out = F.lit(True)
    for name in names:
        out = out & left[name].eqNullSafe(right[name])
    return out


def running(df: DataFrame, order: list[Column], sums: dict[str, str], within: tuple[str, ...] = ()) -> DataFrame:
    """Adds row_no (from 1) and, for each output name in `sums`, the sum of a column over earlier rows.

    "Earlier" is by `order`, within the columns `within` (which must lead the order, ascending, nulls
    first). Rows are range-partitioned by `order`, so that one group may span many tasks; only the
    totals of each partition, one row per partition and group, meet to give the partitions' offsets. Columns of df may have any
    names but range_no, row_no and those that begin with off_.
    """
    if taken := [c for c in df.columns if c in ("range_no", "row_no") or c.startswith("off_")]:
        raise ValueError(f"columns that running sums use themselves: {taken}")
    spark = df.sparkSession
    leading = [F.col(c).asc_nulls_first() for c in within]
    ranged = materialize(df.repartitionByRange(n_partitions(spark), *leading, *order).withColumn("range_no", F.spark_partition_id()), "running")
    before = Window.partitionBy("range_no", *within).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = ranged.withColumns(
        {"row_no": F.row_number().over(Window.partitionBy("range_no", *within).orderBy(*order)).cast("long")}
        | {name: F.coalesce(F.sum(source).over(before), F.lit(0)) for name, source in sums.items()}
    )
    earlier = Window.partitionBy(*(within or [F.lit(0)])).orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy("range_no", *within).agg(F.count(F.lit(1)).alias("n_all"), *(F.sum(source).alias(f"{name}_all") for name, source in sums.items()))
    offsets = totals.select(
        F.col("range_no").alias("off_part"), *(F.col(c).alias(f"off_{c}") for c in within),
        F.coalesce(F.sum("n_all").over(earlier), F.lit(0)).alias("off_n"),
        *(F.coalesce(F.sum(f"{name}_all").over(earlier), F.lit(0)).alias(f"off_{name}") for name in sums),
    )
    on = (F.col("range_no") == F.col("off_part"))
    for c in within:
        on = on & F.col(c).eqNullSafe(F.col(f"off_{c}"))
    joined = rows.join(small(offsets), on, "left")
    return joined.select(*df.columns, (F.col("row_no") + F.col("off_n")).alias("row_no"), *((F.col(name) + F.col(f"off_{name}")).alias(name) for name in sums))


def grouped(rows: DataFrame, keys: list[str], by: Column, part: dict[str, Column], total: dict[str, Column]) -> DataFrame:
    """rows with the columns of `total`, aggregates of those of `part`, which are aggregates over the rows of each key.

    A key's rows are first aggregated in as many parts as there are partitions, dealt by the hash of `by`; the parts' totals then
    go back to the parts, and from there to the rows. So no task meets all rows of a frequent key, neither to
    aggregate nor to join them. rows is planned twice. Keys must not be null.
    """
    salted = rows.withColumn("g_part", F.pmod(F.xxhash64(by), F.lit(n_partitions(rows.sparkSession))))
    parts = salted.groupBy(*keys, "g_part").agg(*(c.alias(n) for n, c in part.items()))
    totals = parts.groupBy(*keys).agg(*(c.alias(n) for n, c in total.items()))
    back = parts.select(*keys, "g_part").join(totals, keys)
    return salted.join(back, [*keys, "g_part"]).select(*rows.columns, *total)


def with_key(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", whole: bool = False) -> DataFrame:
    """docs as one column, row, which no other name can clash with, beside key_id and key_hash (of the text), which tell rows apart.

    With whole the hash is that of all columns (but maps, which have none), so that rows of one id and text are told apart by the others.
    """
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col(f"`{id_col}`").cast("long").alias("key_id"), (row_hash(docs) if whole else F.xxhash64(F.col(f"`{text_col}`"))).alias("key_hash"))


def row_hash(docs: DataFrame) -> Column:
    def plain(kind: T.DataType) -> bool:
        inner = [kind.elementType] if isinstance(kind, T.ArrayType) else [f.dataType for f in kind] if isinstance(kind, T.StructType) else []
        return not isinstance(kind, T.MapType | T.VariantType) and all(map(plain, inner))

    return F.xxhash64(*(F.col(f"`{f.name}`") for f in docs.schema if plain(f.dataType)))


def _meet(docs: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    keys = small(keys.select(F.col("key_id").alias("its_id"), F.col("key_hash").alias("its_hash")))
    return docs.join(keys, F.col("key_id").eqNullSafe(F.col("its_id")) & (F.col("key_hash") == F.col("its_hash")), how)


def without(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows of with_key() whose key isn't among keys, which may be repeated. Texts are shuffled only if keys are many."""
    return _meet(docs, materialize(keys.select("key_id", "key_hash").distinct(), "keys"), "left_anti")


def once(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows of with_key(), each key but once. rows: the keys of all rows; only rows whose key repeats are shuffled."""
    repeated = materialize(rows.groupBy("key_id", "key_hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "keys")
    if repeated.isEmpty():
        return docs
    return _meet(docs, repeated, "left_anti").unionByName(_meet(docs, repeated, "left_semi").dropDuplicates(["key_id", "key_hash"]))
