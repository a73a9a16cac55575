"""Work queues derived from stored states: what is pending, what failed, what a parent's state is."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casemill.operators.storage import written


def ordered(rows: DataFrame, order: list[Column], limit: int | None = None) -> DataFrame:
    """In that order; without a limit, all rows."""
    out = rows.orderBy(*order)
    return out if limit is None else out.limit(limit)


def not_done(work: DataFrame, results: DataFrame, key: str, ok: Column) -> DataFrame:
    """Work items with no result, or none that is ok."""
    done = results.filter(ok).select(F.col(key).alias("done_key"))
    return work.join(done, F.col(key) == F.col("done_key"), "left_anti")


def with_but_without(work: DataFrame, inputs: DataFrame, outputs: DataFrame, key: str) -> DataFrame:
    """Work items that have an input and no output."""
    return work.join(inputs.select(key), key, "left_semi").join(outputs.select(key), key, "left_anti")


def unset(*columns: str) -> Column:
    """Whether all the columns are null."""
    out = F.lit(True)
    for c in columns:
        out = out & F.col(c).isNull()
    return out


def not_blank(text: str) -> Column:
    return F.length(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"(?U)\s+", "")) > 0


def newer(rows: DataFrame, date: str, mark: Column) -> DataFrame:
    """Rows from the high-water mark on; an unknown date, or no mark, keeps a row."""
    return rows.filter(F.col(date).isNull() | mark.isNull() | (F.col(date) >= mark))


def page_after(rows: DataFrame, key: str, after: int, size: int) -> DataFrame:
    """The next rows by key."""
    return rows.filter(F.col(key) > after).orderBy(key).limit(size)


def first_failure(*checks: tuple[Column, str]) -> Column:
    """The reason of the first check that fails, else null."""
    return F.coalesce(*(F.when(failed, F.lit(reason)) for failed, reason in checks), F.lit(None).cast("string"))


def differ(a: Column, b: Column) -> Column:
    """Whether two values differ, two nulls being equal."""
    return ~a.eqNullSafe(b)


def completeness(rows: DataFrame, keys: list[str], number: str) -> DataFrame:
    """For each key: expected (the largest number), extracted, and complete: whether they are 1, 2, ... up to it, once each."""
    got = rows.groupBy(*keys).agg(F.max(number).alias("expected"), F.count(number).alias("extracted"), F.countDistinct(number).alias("different"), F.min(number).alias("low"))
    complete = (F.col("extracted") == F.col("expected")) & (F.col("different") == F.col("expected")) & (F.col("low") == 1)
    return got.select(*keys, "expected", "extracted", F.coalesce(complete, F.lit(False)).alias("complete"))


def parent_status(parents: DataFrame, children: DataFrame, key: str, fetch: str, parse: str) -> DataFrame:
    """A parent's state by those of its children's fetch and parse steps."""
    states = children.groupBy(key).agg(
        F.bool_or(F.col(parse) == "not_parsed").alias("open"), F.bool_or(F.col(fetch) != "success").alias("failed"),
        F.bool_or(F.col(parse) == "incomplete").alias("partial"), F.bool_and(F.col(parse) == "complete").alias("whole"), F.lit(True).alias("any"),
    )
    status = F.when(F.col("any").isNull(), "discovered").when(F.col("open"), F.when(F.col("failed"), "fetch_failed").otherwise("discovered"))
    status = status.when(F.col("partial"), "parse_incomplete").when(F.col("whole"), "complete").otherwise("needs_review")
    return parents.join(states, key, "left").withColumn("status", status).drop("open", "failed", "partial", "whole", "any")


def best_of(rows: DataFrame, key: str, value: str, *rank: Column) -> DataFrame:
    """The value of each key with the smallest rank."""
    return rows.groupBy(key).agg(F.min_by(value, F.struct(*(r.alias(f"r{i}") for i, r in enumerate(rank)))).alias(value))


def failure_list(rows: DataFrame, reason: str, key: str, most: int) -> DataFrame:
    """How many items failed for each reason, and the first few of them by key: a report of at most `most` names."""
    return rows.filter(F.col(reason).isNotNull()).groupBy(reason).agg(F.count(F.lit(1)).alias("failures"), F.min(key).alias("first_key")).orderBy(reason).limit(most)


def first_failures(rows: DataFrame, reason: str, order: list[Column], most: int = 40) -> DataFrame:
    """The first failures in order, `most` at most: a report."""
    return rows.filter(F.col(reason).isNotNull()).orderBy(*order).limit(most)


def bounded_total(rows: DataFrame, most: int | None) -> DataFrame:
    """One row: how many of the rows a run that takes `most` at most will see."""
    n = F.count(F.lit(1))
    return rows.agg((n if most is None else F.least(n, F.lit(most))).alias("total"))


def status_text(status: Column, expected: Column, extracted: Column) -> Column:
    """What is reported of a parsed document; null if it is complete."""
    text = F.format_string("incomplete: expected %s, extracted %s", F.coalesce(expected.cast("string"), F.lit("unknown")), extracted.cast("string"))
    return F.when(status == "incomplete", text).when(status == "unknown", "unknown layout").when(status == "failed", "parse failed")


def filled_of_first(rows: DataFrame, order: list[Column], limit: int, text: str) -> DataFrame:
    """Rows with a text among the first ones in order: blank ones use up the limit."""
    return rows.orderBy(*order).limit(limit).filter(not_blank(text))


def first_rows(rows: DataFrame, order: list[Column], limit: int) -> DataFrame:
    """The first rows in an order, as many as the limit says, however large it is: rows are counted by range partitions with offsets."""
    ranged = written(rows.repartitionByRange(*order).withColumn("part_no", F.spark_partition_id()), "ranged")
    nth = F.row_number().over(Window.partitionBy("part_no").orderBy(*order))
    sizes = ranged.groupBy("part_no").agg(F.count(F.lit(1)).alias("size"))
    before = sizes.select("part_no", F.coalesce(F.sum("size").over(Window.orderBy("part_no").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    return ranged.withColumn("nth", nth).join(before, "part_no").filter(F.col("nth") + F.col("before") <= limit).select(*rows.columns)
