"""Rows of the knowledge base: addresses of paragraphs and provisions, current trees, and what classifiers add to them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def paragraph_uris(blocks: DataFrame, cases: DataFrame, case: str, uri: str) -> DataFrame:
    """The paragraphs of stored cases with their own uris: the case's, #, and the ordinal."""
    homes = cases.select(F.col(case).alias("h_case"), F.col(uri).alias("h_uri"))
    joined = blocks.join(homes, F.col(case) == F.col("h_case"))
    return joined.select(*blocks.columns, F.concat_ws("#", "h_uri", F.col("ordinal").cast("string")).alias("uri"))


def provision_uris(tree: DataFrame, document: str, document_uri: Column) -> DataFrame:
    """A tree's rows with uri and parent_uri: the document's, # and the anchor, or n and the ordinal where there is none.

    Of provisions of a document that share an anchor, all but the first by ordinal have - and their ordinal behind it. The tree
    is sorted by document once; parents are found by an equi-join on document and ordinal.
    """
    anchor = F.coalesce(F.nullif(F.col("anchor"), F.lit("")), F.concat(F.lit("n"), F.col("ordinal").cast("string")))
    again = F.row_number().over(Window.partitionBy(document, "k_anchor").orderBy("ordinal")) > 1
    rows = tree.withColumns({"k_anchor": anchor, "k_uri": document_uri})
    suffix = F.when(again, F.concat(F.lit("-"), F.col("ordinal").cast("string"))).otherwise("")
    rows = rows.withColumn("uri", F.concat("k_uri", F.lit("#"), "k_anchor", suffix)).drop("k_anchor", "k_uri")
    parents = rows.select(F.col(document).alias("p_document"), F.col("ordinal").alias("p_ordinal"), F.col("uri").alias("parent_uri"))
    return rows.join(parents, (F.col(document) == F.col("p_document")) & (F.col("parent_ordinal") == F.col("p_ordinal")), "left").drop("p_document", "p_ordinal")


def current_trees(provisions: DataFrame, versions: DataFrame) -> DataFrame:
    """The provisions of current act versions, then those of all subsidiary legislation: branch (1, 2), document, place, and the rows.

    provisions: act_version_id or subsidiary_legislation_id, ordinal. versions: id, is_current. The rows' order is that of branch, document and ordinal.
    """
    current = versions.filter("is_current").select(F.col("id").alias("v_id"))
    acts = provisions.join(current, F.col("act_version_id") == F.col("v_id"), "left_semi").withColumns({"branch": F.lit(1), "document": F.col("act_version_id")})
    others = provisions.filter("subsidiary_legislation_id IS NOT NULL").withColumns({"branch": F.lit(2), "document": F.col("subsidiary_legislation_id")})
    return acts.unionByName(others).withColumn("place", F.row_number().over(Window.partitionBy("branch", "document").orderBy("ordinal")))


def classification_rows(results: DataFrame, key: str, names: str, dimension: DataFrame, name: str, id_col: str) -> DataFrame:
    """Junction rows of a classification: the key, and the id of each of its names, once each; unknown names are left out."""
    each = results.select(key, F.explode(F.array_distinct(names)).alias("j_name"))
    ids = dimension.select(F.col(name).alias("d_name"), F.col(id_col))
    return each.join(ids, F.col("j_name") == F.col("d_name")).select(key, id_col)


def fetch_state(versions: DataFrame, fetch: str, expected: str, extracted: str) -> DataFrame:
    """needs_review of versions: the fetch failed, or fewer or more provisions were found than expected (two unknown numbers agree)."""
    differ = ~F.col(expected).eqNullSafe(F.col(extracted))
    return versions.withColumn("needs_review", (F.col(fetch) != "success") | differ)


def store_fetches(versions: DataFrame, parents: DataFrame, fetched: DataFrame, parent: str) -> tuple[DataFrame, DataFrame]:
    """Versions and their parents after fetches.

    versions: id, the parent's id, and fetch, html, parse, expected, extracted, needs_review, promoted. parents: id, status. fetched: id, nth (the order of fetches),
    fetch, html, expected, extracted. A fetched version takes what was fetched, and is parsed and promoted anew; of several fetches the last counts. Each
    fetch in turn sets its parent's status: fetch_failed if it failed, needs_review if the provisions are fewer or more than expected, and leaves it
    if all is well; so the last that sets it counts. A fetch of an unknown version changes nothing.
    """
    last = fetched.groupBy(F.col("id").alias("f_id")).agg(F.max_by(F.struct(*(F.col(c) for c in ("fetch", "html", "expected", "extracted"))), "nth").alias("f"))
    new = fetch_state(last.select(F.col("f_id"), *(F.col(f"f.{c}").alias(c) for c in ("fetch", "html", "expected", "extracted"))), "fetch", "expected", "extracted")
    new = new.withColumns({"parse": F.lit("not_parsed"), "promoted": F.lit(False)}).withColumn("n", F.struct("fetch", "html", "parse", "expected", "extracted", "needs_review", "promoted")).select("f_id", "n")
    joined = versions.join(new, F.col("id") == F.col("f_id"), "left")
    changed = ("fetch", "html", "parse", "expected", "extracted", "needs_review", "promoted")
    kept = joined.select(*(F.when(F.col("f_id").isNotNull(), F.col(f"n.{c}")).otherwise(F.col(c)).alias(c) if c in changed else F.col(c) for c in versions.columns))
    status = F.when(F.col("fetch") != "success", "fetch_failed").when(~F.col("expected").eqNullSafe(F.col("extracted")), "needs_review")
    of = versions.select(F.col("id").alias("v_id"), F.col(parent).alias("p_id"))
    marks = fetched.join(of, F.col("id") == F.col("v_id")).withColumn("s", status).filter("s IS NOT NULL").groupBy("p_id").agg(F.max_by("s", "nth").alias("s"))
    return kept, parents.join(marks, F.col("id") == F.col("p_id"), "left").withColumn("status", F.coalesce("s", "status")).select(*parents.columns)


def spans_that_overlap(spans: DataFrame, key: str, id_col: str, start: str, end: str, width: float) -> DataFrame:
    """id and how many other spans of the same key overlap it: start < other end and end > other start.

    Each span falls into the bins of `width` that it touches, and meets spans of its bins only; a pair counts in the bin where
    the later of the two begins. Spans that end before they begin overlap nothing; null ends neither.
    """
    bin_of = lambda x: F.floor(x / width)
    real = spans.filter(F.col(end) > F.col(start)).select(key, id_col, start, end)
    binned = real.withColumn("bin", F.explode(F.sequence(bin_of(F.col(start)), bin_of(F.col(end)))))
    other = binned.select(*(F.col(c).alias(f"o_{c}") for c in (key, id_col, start, end)), F.col("bin").alias("o_bin"))
    on = (F.col(key) == F.col(f"o_{key}")) & (F.col("bin") == F.col("o_bin")) & (F.col(id_col) != F.col(f"o_{id_col}")) & (F.col(start) < F.col(f"o_{end}")) & (F.col(end) > F.col(f"o_{start}"))
    met = binned.join(other, on & (F.col("bin") == bin_of(F.greatest(F.col(start), F.col(f"o_{start}")))))
    counts = met.groupBy(F.col(id_col).alias("c_id")).agg(F.count(F.lit(1)).alias("overlaps"))
    return spans.select(id_col).join(counts, F.col(id_col) == F.col("c_id"), "left").select(id_col, F.coalesce("overlaps", F.lit(0)).alias("overlaps"))


def align(source: DataFrame, target: DataFrame, name: str, index: str) -> DataFrame:
    """For each name of the target label space its index there, and that in the source's, or null if the source lacks it."""
    known = source.select(F.col(name).alias("s_name"), F.col(index).alias("source_index"))
    return target.select(name, index).join(known, F.col(name) == F.col("s_name"), "left").drop("s_name")


def home_topics(concepts: DataFrame, homes: DataFrame, topics: DataFrame) -> DataFrame:
    """concept, and the index of its home topic by names in any case; -1 if the concept or its topic is unknown.

    concepts: concept. homes: concept, topic. topics: topic, index.
    """
    home = homes.select(F.lower("concept").alias("h_concept"), F.lower("topic").alias("h_topic"))
    index = topics.select(F.lower("topic").alias("t_topic"), F.col("index").alias("t_index"))
    joined = concepts.select("concept").join(home, F.lower("concept") == F.col("h_concept"), "left").join(index, F.col("h_topic") == F.col("t_topic"), "left")
    return joined.select("concept", F.coalesce("t_index", F.lit(-1)).alias("topic_index"))
