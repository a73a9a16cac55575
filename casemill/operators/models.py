"""Scores and vectors from functions that the caller gives, and what follows from them.

A model itself is outside of the engine. A scorer maps a series of texts to a series of lists of numbers; it is loaded once for each
Python worker and sees Arrow batches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casemill.operators import labels
from casemill.operators.storage import written

Scorer = Callable[[pd.Series], pd.Series]


def _vectors(load: Callable[[], Scorer]):
    @F.pandas_udf("array<double>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = load()
        for batch in batches:
            yield scorer(batch)

    return run


def embed(rows: DataFrame, key: str, text: Column, load: Callable[[], Scorer], dimensions: int) -> DataFrame:
    """key and embedding of rows whose text isn't blank; vectors of another length are an error."""
    filled = rows.withColumn("embed_text", text).filter(F.length(F.trim("embed_text")) > 0)
    vectors = filled.select(key, "embed_text", _vectors(load)("embed_text").alias("embedding"))
    wrong = F.raise_error(F.lit("a vector has another length")).cast("array<double>")
    return vectors.select(key, "embed_text", F.when(F.size("embedding") == dimensions, F.col("embedding")).otherwise(wrong).alias("embedding"))


def classify(rows: DataFrame, key: str, text: Column, previous: Column, load: dict[str, Callable[[], Scorer]], names: dict[str, list[str]], thresholds: dict[str, list[float]], concept_topics: dict[str, list[str]]) -> DataFrame:
    """role, topics and concepts of each row from three scorers of logits.

    The role is the largest. Topics pass their thresholds, the best TOPICS of them. Concepts are scored with the topics before the
    text; of the best CONCEPTS that pass, those with an active topic stay.
    """
    none = F.array().cast("array<string>")
    out = rows.withColumns({"c_text": text, "c_previous": F.coalesce(previous, F.lit(""))})
    role = _vectors(load["role"])(labels.prompt(none, F.col("c_text"), F.col("c_previous")))
    topic = _vectors(load["topics"])(F.col("c_text"))
    out = out.select(key, "c_text", role.alias("r"), topic.alias("t"))
    out = out.withColumns({"role": F.element_at(F.array(*map(F.lit, names["role"])), labels.best_index(F.col("r")) + 1), "topics": _passing("t", names["topics"], thresholds["topics"], labels.TOPICS)})
    out = out.select(key, "c_text", "role", "topics", _vectors(load["concepts"])(labels.prompt(F.col("topics"), F.col("c_text"), F.lit(""))).alias("c"))
    homes = F.create_map(*(x for k, v in concept_topics.items() for x in (F.lit(k), F.array(*map(F.lit, v)))))
    found = _passing("c", names["concepts"], thresholds["concepts"], labels.CONCEPTS)
    return out.select(key, "role", "topics", F.filter(found, lambda x: labels.allowed(F.coalesce(F.try_element_at(homes, x), none), F.col("topics"))).alias("concepts"))


def _passing(logits: str, names: list[str], thresholds: list[float], most: int) -> Column:
    p = F.transform(logits, lambda x: 1 / (1 + F.exp(-x)))
    limits = F.array(*(F.lit(max(t, labels.FLOOR)) for t in thresholds))
    marked = F.zip_with(p, F.arrays_zip(limits.alias("t"), F.array(*map(F.lit, names)).alias("n")), lambda s, x: F.struct((-s).alias("low"), (s >= x["t"]).alias("ok"), x["n"].alias("n")))
    return F.transform(F.slice(F.array_sort(F.filter(marked, lambda x: x["ok"])), 1, most), lambda x: x["n"])


def sample_with_replacement(rows: DataFrame, key: str, weight: str, n: int, seed: int) -> DataFrame:
    """n draws of keys, each as likely as its weight, by inverting the running sum of weights; the draws meet it by buckets."""
    from pyspark.sql import Window

    total = rows.agg(F.sum(weight)).first()[0]
    step = total / max(1, n)
    # The k-th draw falls evenly at random into the k-th nth of the sum, so a row's draws follow from its own bounds.
    ranged = written(rows.select(key, weight).repartitionByRange(F.col(key)).withColumn("part_no", F.spark_partition_id()), "weights")
    within = Window.partitionBy("part_no").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranged.groupBy("part_no").agg(F.sum(weight).alias("size"))
    offsets = sizes.select("part_no", F.coalesce(F.sum("size").over(Window.orderBy("part_no").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)).alias("offset"))
    placed = ranged.withColumn("before", F.coalesce(F.sum(weight).over(within), F.lit(0.0))).join(offsets, "part_no").withColumn("low", F.col("before") + F.col("offset"))
    first, last = F.floor(F.col("low") / step), F.floor((F.col("low") + F.col(weight)) / step)
    draws = placed.select(key, "low", (F.col("low") + F.col(weight)).alias("high"), F.explode(F.sequence(first, last)).alias("draw"))
    point = (F.col("draw") + F.abs(F.xxhash64("draw", F.lit(seed))) % 1_000_003 / 1_000_003) * step
    return draws.filter((point >= F.col("low")) & (point < F.col("high")) & (F.col("draw") < n)).select("draw", key)
