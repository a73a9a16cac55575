"""Joins and orders that stages share: lookups, nested children, counts by state, and what depends on the row before.

Window functions sort the rows of one key at a time, with spilling; a key is a case, an act or a conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def lookup(rows: DataFrame, other: DataFrame, key: str, other_key: str, *columns: Column | str, how: str = "left") -> DataFrame:
    """rows with the columns of the other's row that has their key; an inner lookup drops rows without one. Null keys find nothing."""
    right = other.select(F.col(other_key).alias("l_key"), *columns)
    return rows.join(right, F.col(key) == F.col("l_key"), how).drop("l_key")


def nested(parents: DataFrame, children: DataFrame, key: str, child_key: str, order: list[str], name: str) -> DataFrame:
    """parents with the sorted array of their children's columns `order`, empty for those without any."""
    lists = children.groupBy(F.col(child_key).alias("n_key")).agg(F.array_sort(F.collect_list(F.struct(*order))).alias(name))
    kind = lists.schema[name].dataType
    return parents.join(lists, F.col(key) == F.col("n_key"), "left").withColumn(name, F.coalesce(name, F.array().cast(kind))).drop("n_key")


def siblings(rows: DataFrame, key: str) -> DataFrame:
    """rows with siblings: how many others have their key."""
    sizes = rows.groupBy(F.col(key).alias("s_key")).agg((F.count(F.lit(1)) - 1).alias("siblings"))
    return rows.join(sizes, F.col(key) == F.col("s_key"), "left").drop("s_key")


def state_counts(rows: DataFrame, state: str, date: Column, **counted: Column) -> DataFrame:
    """For each state: n, how many rows meet each condition, and the newest date."""
    return rows.groupBy(state).agg(F.count(F.lit(1)).alias("n"), *(F.count_if(c).alias(name) for name, c in counted.items()), F.max(date).alias("latest"))


def _before(keys: list[str], order: list[str]) -> Window:
    return Window.partitionBy(*keys).orderBy(*order)


def previous(rows: DataFrame, keys: list[str], order: list[str], text: str, name: str) -> DataFrame:
    """The text of the row before, also if that row is then left out; empty for the first one."""
    return rows.withColumn(name, F.coalesce(F.lag(text, 1).over(_before(keys, order)), F.lit("")))


def carried(rows: DataFrame, keys: list[str], order: list[str], value: Column, name: str) -> DataFrame:
    """The most recent value that isn't null, of the row itself or one before."""
    return rows.withColumn(name, F.last(value, ignorenulls=True).over(_before(keys, order)))


def carried_once(rows: DataFrame, keys: list[str], order: list[str], heading: Column, name: str) -> DataFrame:
    """For each row that is no heading itself, the heading right before it; one that a row has taken, or that another heading follows, is gone."""
    return rows.withColumn("c_heading", heading).withColumn(name, F.when(F.col("c_heading").isNull(), F.lag("c_heading", 1).over(_before(keys, order)))).drop("c_heading")


def islands(rows: DataFrame, keys: list[str], order: list[str], opens: Column, text: str, joint: str = "\n") -> DataFrame:
    """Blocks of rows, each from one that opens it up to the next such: keys, block (from 1), and their texts in order. Earlier rows are dropped."""
    numbered = rows.withColumn("block", F.sum(F.when(opens, 1).otherwise(0)).over(_before(keys, order))).filter("block > 0")
    parts = numbered.groupBy(*keys, "block").agg(F.array_sort(F.collect_list(F.struct(*order, F.col(text).alias("i_text")))).alias("parts"))
    return parts.select(*keys, "block", F.array_join(F.transform("parts", lambda x: x["i_text"]), joint).alias(text))


def renumbered(rows: DataFrame, keys: list[str], order: list[str], name: str = "ordinal") -> DataFrame:
    """Ordinals from 1 without gaps."""
    return rows.withColumn(name, F.row_number().over(_before(keys, order)))


def report_counts(state: str, states: tuple[str, ...]) -> dict[str, Column]:
    """A stage's counters as aggregates: total, one for each state, and other for what is none of them. For storage.observed()."""
    counts = {"total": F.count(F.lit(1))} | {s: F.count_if(F.coalesce(F.col(state) == s, F.lit(False))) for s in states}
    return counts | {"other": F.count_if(~F.coalesce(F.col(state).isin(*states), F.lit(False)))}
