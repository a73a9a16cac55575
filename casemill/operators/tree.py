"""Provision trees as nested sets: a node's subtree is the run of ordinals behind it."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casemill.operators.queue import first_rows
from casemill.operators.storage import written

TOKENS = 8_000


def subtree(nodes: DataFrame, document: str, roots: Column | None = None) -> DataFrame:
    """root_ordinal and the nodes of its subtree, for the nodes that are roots.

    The join is by document and an ordinal range; a document bounds what one key meets.
    """
    root = (nodes if roots is None else nodes.filter(roots)).select(F.col(document).alias("r_doc"), F.col("ordinal").alias("root_ordinal"), (F.col("ordinal") + F.col("descendant_count")).alias("last_ordinal"))
    return nodes.join(root, (nodes[document] == root["r_doc"]) & nodes["ordinal"].between(root["root_ordinal"], root["last_ordinal"])).drop("r_doc", "last_ordinal")


def subtree_text(nodes: DataFrame, document: str, roots: Column | None = None, text: str = "text", joint: str = "\n\n") -> DataFrame:
    """The texts of each root's subtree in order."""
    rows = subtree(nodes, document, roots).groupBy(document, "root_ordinal")
    ordered = F.array_sort(F.collect_list(F.struct("ordinal", F.col(text).alias("t"))))
    return rows.agg(F.array_join(F.transform(ordered, lambda x: x["t"]), joint).alias("text"))


def section_roots(nodes: DataFrame, document: str) -> DataFrame:
    """Sections whose parent is none, or no schedule."""
    parents = nodes.select(F.col(document).alias("p_doc"), F.col("ordinal").alias("p_ordinal"), F.col("kind").alias("p_kind"))
    joined = nodes.join(parents, (nodes[document] == parents["p_doc"]) & (nodes["parent_ordinal"] == parents["p_ordinal"]), "left")
    return joined.filter((F.col("kind") == "section") & (F.col("p_ordinal").isNull() | (F.col("p_kind") != "schedule"))).drop("p_doc", "p_ordinal", "p_kind")


def children(nodes: DataFrame, document: str) -> DataFrame:
    """Each node's direct children: parent_ordinal, ordinal."""
    return nodes.filter(F.col("parent_ordinal").isNotNull()).select(document, "parent_ordinal", "ordinal")


def counts_from_levels(nodes: DataFrame, document: str) -> DataFrame:
    """descendant_count and parent_ordinal by pre-order ordinals and levels alone.

    A node's subtree ends before the next node of its level or above; its parent is the last node before it that is higher.
    Each document's ordinals and levels are met once, in order, with a stack: a document bounds what one call holds.
    """
    schema = pa.schema([(document, pa.int64()), ("ordinal", pa.int64()), ("level", pa.int32()), ("descendant_count", pa.int64()), ("parent_ordinal", pa.int64())])

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("ordinal")
        ordinals, levels = table["ordinal"].to_pylist(), table["level"].to_pylist()
        counts, parents, open_at = [0] * len(levels), [None] * len(levels), []
        for k, level in enumerate(levels):
            while open_at and levels[open_at[-1]] >= level:
                counts[open_at[-1]] = ordinals[k] - ordinals[open_at[-1]] - 1
                open_at.pop()
            parents[k] = ordinals[open_at[-1]] if open_at else None
            open_at.append(k)
        for k in open_at:
            counts[k] = ordinals[-1] - ordinals[k]
        return pa.table([table["d"], table["ordinal"], table["level"], pa.array(counts, pa.int64()), pa.array(parents, pa.int64())], schema=schema)

    slim = nodes.select(F.col(document).cast("long").alias("d"), F.col("ordinal").cast("long").alias("ordinal"), F.col("level").cast("int").alias("level"))
    return slim.groupBy("d").applyInArrow(run, f"{document} long, ordinal long, level int, descendant_count long, parent_ordinal long")


def _covered(nodes: DataFrame, document: str, tops: DataFrame) -> DataFrame:
    """The nodes of the subtrees of tops (document, top, last), which don't overlap, with top: the last top at or before a node, if its subtree reaches that far."""
    marks = tops.select(F.col(document).alias("m_doc"), F.col("top").alias("m_top"), F.col("last").alias("m_last"))
    joined = nodes.join(tops.select(F.col(document).alias("d_doc")).distinct(), F.col(document) == F.col("d_doc"), "left_semi")
    joined = joined.join(marks, (F.col(document) == F.col("m_doc")) & (F.col("ordinal") == F.col("m_top")), "left")
    before = Window.partitionBy(document).orderBy("ordinal").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    near = F.last(F.when(F.col("m_top").isNotNull(), F.struct("m_top", "m_last")), ignorenulls=True).over(before)
    return joined.withColumn("near", near).filter(F.col("ordinal") <= F.col("near.m_last")).withColumn("top", F.col("near.m_top")).drop("m_doc", "m_top", "m_last", "near")


def covered_text(nodes: DataFrame, document: str, tops: DataFrame, text: str = "text", joint: str = "\n\n") -> DataFrame:
    """document, top, text: the texts of subtrees that don't overlap, each node's text moved once."""
    ordered = F.array_sort(F.collect_list(F.when(F.col(text).isNotNull(), F.struct("ordinal", F.col(text).alias("t")))))
    return _covered(nodes, document, tops).groupBy(document, "top").agg(F.array_join(F.transform(ordered, lambda x: x["t"]), joint).alias("text"))


def token_units(nodes: DataFrame, document: str, tokens: Column, budget: int = TOKENS) -> DataFrame:
    """The units of each section root that fit the budget: a subtree that is too large gives way to its children's.

    A node is a unit if its subtree fits, has text and no vector yet, and all nodes above it, up to the root, don't fit and
    have text and no vector. tokens counts those of a column text.

    Sections don't stand within sections. The descent goes level by level, from the roots to the children of what doesn't fit, so that a text is made for nodes that are
    reached only, and no node's text moves more than once a level. There are as many rounds as what is too large is deep;
    each round's nodes are written.
    """
    fresh = nodes.filter(~F.coalesce(F.col("embedded"), F.lit(False)))
    reach = lambda rows, root: rows.select(document, root.alias("root"), F.col("ordinal").alias("top"), (F.col("ordinal") + F.col("descendant_count")).alias("last"))
    tops = written(reach(section_roots(nodes, document).filter(~F.coalesce(F.col("embedded"), F.lit(False))), F.col("ordinal")), "tops")
    units = None
    while units is None or not tops.isEmpty():
        texts = covered_text(nodes, document, tops).withColumnsRenamed({document: "t_doc", "top": "t_top"})
        sized = tops.join(texts, (F.col(document) == F.col("t_doc")) & (F.col("top") == F.col("t_top"))).filter(F.length(F.trim("text")) > 0)
        sized = written(sized.withColumn("n_tokens", tokens).select(document, "root", "top", "n_tokens", F.when(F.col("n_tokens") <= budget, F.col("text")).alias("text")), "units")
        fitting = sized.filter("text IS NOT NULL").select(document, "root", F.col("top").alias("ordinal"), "n_tokens", "text")
        units = fitting if units is None else units.unionByName(fitting)
        split = sized.filter("text IS NULL").select(F.col(document).alias("s_doc"), "root", F.col("top").alias("s_top"))
        inner = fresh.join(split, (F.col(document) == F.col("s_doc")) & (F.col("parent_ordinal") == F.col("s_top")))
        tops = written(reach(inner, F.col("root")), "tops")
    return units


def with_vectors(nodes: DataFrame, document: str, units: DataFrame, vectors: DataFrame) -> DataFrame:
    """Nodes with the vectors of their units (document, ordinal, embedding) and the texts that these were made of; other nodes keep what they have.

    units: of token_units. A vector without a unit changes nothing.
    """
    made = units.select(document, "ordinal", F.col("text").alias("u_text")).join(vectors.select(document, "ordinal", F.col("embedding").alias("u_vector")), [document, "ordinal"])
    made = made.withColumnsRenamed({document: "u_doc", "ordinal": "u_ordinal"})
    joined = nodes.join(made, (F.col(document) == F.col("u_doc")) & (F.col("ordinal") == F.col("u_ordinal")), "left")
    return joined.withColumns({"embedding": F.coalesce("u_vector", "embedding"), "embedding_text": F.coalesce("u_text", "embedding_text")}).select(*nodes.columns)


def sections_to_classify(nodes: DataFrame, document: str, order: list[Column], limit: int | None = None) -> DataFrame:
    """The sections that a classifier is to see: document, ordinal, text, previous_text.

    nodes: the trees of current versions, with role (null if there is none yet) and text. A section is a section root; its text is that of its subtree, and
    previous_text that of the section before it in its document, whether that one is classified or not, empty for the first. Those with a role, and those
    without text, are left out. With a limit the first ones stay, documents being in the given order (of columns that each document has
    one value of) and sections by ordinal: the limit may end within a document.

    Sections are counted by range partitions with offsets, so that no task sees all of them.
    """
    roots = section_roots(nodes, document)
    texts = covered_text(nodes, document, roots.select(document, F.col("ordinal").alias("top"), (F.col("ordinal") + F.col("descendant_count")).alias("last"))).withColumnsRenamed({document: "x_doc", "text": "x_text"})
    rows = roots.drop("text").join(texts, (F.col(document) == F.col("x_doc")) & (F.col("ordinal") == F.col("top"))).withColumnRenamed("x_text", "text").drop("x_doc", "top")
    before = F.lag("text", 1, "").over(Window.partitionBy(document).orderBy("ordinal"))
    due = rows.withColumn("previous_text", before).filter(F.col("role").isNull() & F.col("text").rlike(r"\S"))
    if limit is not None:
        due = first_rows(due, [*order, F.col(document), F.col("ordinal")], limit)
    return due.select(document, "ordinal", "text", "previous_text")
