"""Changes of tables as new snapshots: each function maps the old rows and a delta to the new rows.

Parquet tables have no MERGE, UPDATE or DELETE. A caller writes the result to a new folder. All joins are equi-joins on the
keys given; none is broadcast by hand, as a delta may be as large as the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casemill.operators.storage import written


def _on(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    out = F.lit(True)
    for k in keys:
        out = out & left[k].eqNullSafe(right[f"d_{k}"])
    return out


def _keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.select(*(F.col(k).alias(f"d_{k}") for k in keys)).distinct()


def absent(rows: DataFrame, others: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys others doesn't have; null keys are equal."""
    others = _keys(others, keys)
    return rows.join(others, _on(rows, others, keys), "left_anti")


def present(rows: DataFrame, others: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys others has; null keys are equal."""
    others = _keys(others, keys)
    return rows.join(others, _on(rows, others, keys), "left_semi")


def upsert(old: DataFrame, delta: DataFrame, keys: list[str]) -> DataFrame:
    """delta's rows in place of those with the same keys."""
    return absent(old, delta, keys).unionByName(delta)


def replace_group(old: DataFrame, delta: DataFrame, group: list[str]) -> DataFrame:
    """Each group that delta has any row of holds delta's rows only."""
    return absent(old, delta, group).unionByName(delta)


def delete_children(children: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """CASCADE: rows that point to none of the rows that go."""
    return absent(children, gone, [key])


def detach(children: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """SET NULL: rows that point to a row that goes point to none."""
    marks = _keys(gone, [key]).withColumn("d_gone", F.lit(True))
    joined = children.join(marks, children[key] == marks[f"d_{key}"], "left")
    return joined.withColumn(key, F.when(F.col("d_gone").isNull(), F.col(key))).select(*children.columns)


def first_of(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in that order."""
    return rows.withColumn("nth", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("nth = 1").drop("nth")


def insert_absent(old: DataFrame, delta: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Rows of delta whose keys are new, the first of each key, behind the old ones, which stay as they are."""
    return old.unionByName(absent(first_of(delta, keys, order), old, keys))


def get_or_create(dimension: DataFrame, delta: DataFrame, name: str | list[str], key: str) -> DataFrame:
    """The dimension with a row for each new name. Keys go on from the largest, in the order of the names.

    A name may be several columns, like a judge's name and title: the first must not be null, others may, and nulls are equal.
    New names are ranked by range partitions with offsets, so no task sees all of them; the ranges are written first, as both
    the ranks and the offsets must see the same ones.
    """
    names = [name] if isinstance(name, str) else list(name)
    fresh = absent(delta.select(*names).filter(F.col(names[0]).isNotNull()).distinct(), dimension, names)
    top = dimension.agg(F.coalesce(F.max(key), F.lit(0))).first()[0]
    ordered = [F.col(n).asc_nulls_first() for n in names]
    ranged = written(fresh.repartitionByRange(*ordered).withColumn("part_no", F.spark_partition_id()), "names")
    ranked = ranged.withColumn("nth", F.row_number().over(Window.partitionBy("part_no").orderBy(*ordered)))
    sizes = ranged.groupBy("part_no").agg(F.count(F.lit(1)).alias("size"))
    before = sizes.withColumn("before", F.coalesce(F.sum("size").over(Window.orderBy("part_no").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("size")
    new = ranked.join(before, "part_no").select((F.lit(top) + F.col("before") + F.col("nth")).cast(dimension.schema[key].dataType).alias(key), *names)
    return dimension.select(key, *names).unionByName(new)


def one_current(rows: DataFrame, parent: str, current: str, sequence: list[Column]) -> DataFrame:
    """Of the rows of a parent that are marked current, the last one stays so."""
    last = Window.partitionBy(parent).orderBy(F.col(current).desc_nulls_last(), *sequence)
    return rows.withColumn(current, F.col(current) & (F.row_number().over(last) == 1))


def current_timeline(versions: DataFrame, parent: str, valid_from: str, current: str) -> DataFrame:
    """If a parent has not exactly one current version, the newest is."""
    per = Window.partitionBy(parent)
    n, newest = F.sum(F.col(current).cast("int")).over(per), F.max(valid_from).over(per)
    return versions.withColumn(current, F.when(n == 1, F.col(current)).otherwise(F.col(valid_from) == newest))


def mark(rows: DataFrame, done: DataFrame, keys: list[str], flag: str) -> DataFrame:
    """Sets the flag where done has the keys."""
    marks = _keys(done, keys).withColumn("d_done", F.lit(True))
    return rows.join(marks, _on(rows, marks, keys), "left").withColumn(flag, F.coalesce(F.col(flag), F.lit(False)) | F.col("d_done").isNotNull()).select(*rows.columns)


def filled(parents: DataFrame, delta: DataFrame, key: str, column: str) -> DataFrame:
    """The column of parents, where it is null, from the delta's row with their key."""
    given = delta.groupBy(F.col(key).alias("g_key")).agg(F.max(column).alias("g_value"))
    return parents.join(given, F.col(key) == F.col("g_key"), "left").withColumn(column, F.coalesce(F.col(column), F.col("g_value"))).select(*parents.columns)


def store_fetch(old: DataFrame, fetched: DataFrame, key: str, reset: dict[str, Column]) -> DataFrame:
    """A fetched document replaces that of its work item, with its later columns reset."""
    return upsert(old, fetched.withColumns(reset).select(*old.columns), [key])


def rehome(old: DataFrame, new: DataFrame, name: str, home: str) -> DataFrame:
    """Names of both sides; where new gives a home it counts."""
    right = new.select(F.col(name).alias("n_name"), F.col(home).alias("n_home"))
    joined = old.select(name, home).join(right, F.col(name) == F.col("n_name"), "full_outer")
    return joined.select(F.coalesce(name, "n_name").alias(name), F.coalesce("n_home", home).alias(home))


def must_match(rows: DataFrame, dimension: DataFrame, name: str, dim_name: str, key: str) -> DataFrame:
    """Adds the key of the dimension's row with that name, whatever its case; an unknown name, or an empty dimension, is an error."""
    if dimension.isEmpty():
        raise ValueError(f"the dimension of {dim_name} is empty")
    names = dimension.select(F.lower(dim_name).alias("m_name"), F.col(key).alias("m_key"))
    joined = rows.join(names, F.lower(F.col(name)) == F.col("m_name"), "left")
    failed = F.raise_error(F.concat(F.lit("unknown name: "), F.coalesce(F.col(name), F.lit("null"))))
    return joined.withColumn(key, F.when(F.col("m_key").isNull(), failed.cast(dimension.schema[key].dataType)).otherwise(F.col("m_key"))).select(*rows.columns, key)


def violations(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once: none, if they are unique."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def orphans(children: DataFrame, parents: DataFrame, key: str, parent_key: str) -> DataFrame:
    """Children that point to no parent."""
    right = parents.select(F.col(parent_key).alias("o_key"))
    return children.filter(F.col(key).isNotNull()).join(right, F.col(key) == F.col("o_key"), "left_anti")


def exactly_one(*columns: str) -> Column:
    """Whether just one of the columns isn't null."""
    return sum((F.col(c).isNotNull().cast("int") for c in columns[1:]), F.col(columns[0]).isNotNull().cast("int")) == 1


def at_most_one(*columns: str) -> Column:
    return sum((F.col(c).isNotNull().cast("int") for c in columns[1:]), F.col(columns[0]).isNotNull().cast("int")) <= 1
