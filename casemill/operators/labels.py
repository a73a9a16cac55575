"""The label mathematics of multi-label classification as DataFrame expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The thresholds that are tried, and the floor that one never goes below.
THRESHOLDS = (0.45, 0.5, 0.55, 0.6)
FLOOR = 0.45
#: Most labels of one text.
TOPICS, CONCEPTS = 3, 4
#: Fixed values of the asymmetric loss.
GAMMA_NEGATIVE, GAMMA_POSITIVE, CLIP = 4, 0, 0.05


def scheme(names: DataFrame, name: str) -> DataFrame:
    """Each different name with its index from 0, in code point order. A label space is small: it is ranked as a whole."""
    different = names.select(name).filter(F.col(name).isNotNull()).distinct()
    return different.withColumn("index", F.row_number().over(Window.orderBy(name)) - 1)


def class_weights(rows: DataFrame, label: str, classes: DataFrame) -> DataFrame:
    """total / (number of classes * count) for each class, 0 for an empty one; labels under 0 don't count."""
    counts = rows.filter(F.col(label) >= 0).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    k = classes.agg(F.count(F.lit(1)).alias("k"))
    joined = classes.join(counts, label, "left").join(F.broadcast(total.crossJoin(k)))  # one row
    return joined.select(label, F.coalesce(F.col("total") / (F.col("k") * F.col("n")), F.lit(0.0)).alias("weight"))


def sample_weights(rows: DataFrame, key: str, labels: str, least: float = 1e-3) -> DataFrame:
    """For each row the sum of 1 / count of its labels, at least `least`."""
    single = rows.select(key, F.explode(labels).alias("label"))
    counts = single.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    sums = single.join(counts, "label").groupBy(key).agg(F.sum(1 / F.col("n")).alias("w"))
    return rows.select(key).join(sums, key, "left").select(key, F.greatest(F.coalesce("w", F.lit(0.0)), F.lit(least)).alias("weight"))


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b == 0, 0.0).otherwise(a / b)


def label_counts(rows: DataFrame, label: str, gold: str, predicted: str) -> DataFrame:
    """True and false positives and false negatives of each label; gold and predicted are booleans."""
    n = lambda c: F.sum(F.when(c, 1).otherwise(0))
    return rows.groupBy(label).agg(n(F.col(gold) & F.col(predicted)).alias("tp"), n(~F.col(gold) & F.col(predicted)).alias("fp"), n(F.col(gold) & ~F.col(predicted)).alias("fn"))


def f1(counts: DataFrame) -> DataFrame:
    """micro and macro F1 of label_counts(); without any counts a ratio is 0."""
    one = _ratio(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn"))
    sums = counts.agg(F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), F.sum("fn").alias("fn"), F.avg(one).alias("macro_f1"))
    return sums.select(F.coalesce(_ratio(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")), F.lit(0.0)).alias("micro_f1"), F.coalesce("macro_f1", F.lit(0.0)).alias("macro_f1"))


def tune(rows: DataFrame, label: str, gold: str, score: str, thresholds: tuple[float, ...] = THRESHOLDS, floor: float = FLOOR) -> DataFrame:
    """For each label the threshold with the best F1, the lowest of equals, and never below the floor."""
    tried = rows.withColumn("threshold", F.explode(F.array(*map(F.lit, thresholds))))
    hit = F.col(score) >= F.col("threshold")
    n = lambda c: F.sum(F.when(c, 1).otherwise(0))
    counts = tried.groupBy(label, "threshold").agg(n(F.col(gold) & hit).alias("tp"), n(~F.col(gold) & hit).alias("fp"), n(F.col(gold) & ~hit).alias("fn"))
    value = _ratio(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn"))
    best = counts.groupBy(label).agg(F.max_by("threshold", F.struct(value.alias("v"), (-F.col("threshold")).alias("t"))).alias("threshold"), F.max(value).alias("f1"))
    return best.select(label, F.greatest("threshold", F.lit(floor)).alias("threshold"), "f1")


def top_scores(scores: Column, threshold: Column | float, most: int) -> Column:
    """Indexes of scores from the threshold on, the highest `most` of them, the lower index first of equals."""
    marked = F.transform(scores, lambda s, i: F.struct((-s).alias("low"), i.alias("index"), s.alias("score")))
    passing = F.array_sort(F.filter(marked, lambda x: x["score"] >= threshold))
    return F.transform(F.slice(passing, 1, most), lambda x: x["index"])


def best_index(scores: Column) -> Column:
    """The index from 0 of the first largest score."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def allowed(topics: Column, active: Column) -> Column:
    """Whether a concept may be used: one of its topics is active."""
    return (F.size(topics) > 0) & F.arrays_overlap(topics, active)


def sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def asymmetric_loss(p: Column, gold: Column) -> Column:
    """The loss of one probability: easy negatives count less, and not at all below CLIP."""
    shifted = F.greatest(p - CLIP, F.lit(0.0))
    near = lambda x: F.log(F.greatest(x, F.lit(1e-8)))
    return F.when(gold, -near(p) * F.pow(1 - p, F.lit(GAMMA_POSITIVE))).otherwise(-near(1 - shifted) * F.pow(shifted, F.lit(GAMMA_NEGATIVE)))


def one_hot(names: Column, labels: list[str]) -> Column:
    """0 or 1 for each label; names that aren't labels don't count."""
    return F.array(*(F.coalesce(F.array_contains(names, x), F.lit(False)).cast("int") for x in labels))


def concept_mask(topics: Column, homes: dict[str, list[str]]) -> Column:
    """0 or 1 for each concept, in the order given: 1 if one of its topics is among a row's. A concept without topics has 0, a null list no topics."""
    active = F.coalesce(topics, F.array().cast("array<string>"))
    return F.array(*(allowed(F.array(*map(F.lit, t)).cast("array<string>"), active).cast("int") for t in homes.values())).cast("array<int>")


def given_topics(split: Column, ordinal: Column, gold: Column, predicted: Column) -> Column:
    """The topics that stand before a concept's text: the gold ones for every second row of the training split, from the first, and the predicted ones for all others."""
    return F.when((split == "train") & (ordinal % 2 == 0), F.coalesce(gold, F.array().cast("array<string>"))).otherwise(predicted)


def features(rows: DataFrame, task: str, roles: list[str], topics: list[str], homes: dict[str, list[str]]) -> DataFrame:
    """What a task's trainer gets, beside the columns of rows: input, and role_id, or label_targets, for concepts with label_mask.

    rows: text, previous_text, role, topics, concepts, and concept_topics (see given_topics) or null. An unknown or missing role has -100; names that
    aren't labels don't count. Concepts are masked by a row's own topics, but read the topics that were given to it.
    """
    none, nothing = F.array().cast("array<string>"), F.lit("")
    if task == "role":
        known = F.array_position(F.array(*map(F.lit, roles)), F.col("role"))
        return rows.withColumns({"input": prompt(none, F.col("text"), F.coalesce("previous_text", nothing)), "role_id": F.when(known > 0, known - 1).otherwise(-100).cast("int")})
    if task == "topics":
        return rows.withColumns({"input": F.col("text"), "label_targets": one_hot(F.col("topics"), topics)})
    if task == "concepts":
        given = F.coalesce("concept_topics", "topics", none)
        return rows.withColumns({"input": prompt(given, F.col("text"), nothing), "label_targets": one_hot(F.col("concepts"), list(homes)), "label_mask": concept_mask(F.filter(F.coalesce("topics", none), lambda t: t.isin(*topics)), homes)})
    raise ValueError(f"no such task: {task}")


def decode(flags: Column, labels: list[str]) -> Column:
    """The names of the labels whose flag is set."""
    pairs = F.zip_with(flags, F.array(*map(F.lit, labels)), lambda f, n: F.when(f > 0, n))
    return F.filter(pairs, lambda x: x.isNotNull())


def prompt(topics: Column, text: Column, previous: Column) -> Column:
    """A classifier's input: topics before the text, and the previous paragraph behind it, where there are any."""
    head = F.when(F.size(topics) > 0, F.concat(F.lit("Topics: "), F.array_join(topics, "; "), F.lit("\n\n"))).otherwise("")
    tail = F.when(F.length(previous) > 0, F.concat(F.lit("\n\nPrevious: "), previous)).otherwise("")
    return F.concat(head, text, tail)


def accuracy(rows: DataFrame, gold: str, predicted: str, ignore: int = -100) -> DataFrame:
    """One row: accuracy over rows whose gold label is neither null nor `ignore`, and 0 if there are none."""
    judged = rows.filter(F.col(gold).isNotNull() & (F.col(gold) != ignore))
    return judged.agg(F.coalesce(F.avg((F.col(gold) == F.col(predicted)).cast("double")), F.lit(0.0)).alias("accuracy"))


def mean_loss(rows: DataFrame, loss: str, mask: str) -> DataFrame:
    """One row: the mean of a loss over the rows that the mask takes, and 0 if it takes none."""
    taken = F.sum(F.when(F.col(mask), 1).otherwise(0))
    return rows.agg((F.coalesce(F.sum(F.when(F.col(mask), F.col(loss))), F.lit(0.0)) / F.greatest(F.coalesce(taken, F.lit(0)), F.lit(1))).alias("loss"))
