"""Line dedup by levelled, sorted runs of line hashes, in DataFrame functions only."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casemill.llm.files import remove
from casemill.llm.shared import LOWER, SPACES, UPPER, materialize, n_partitions, new_path, row_hash, small

#: A key of at least so many code points that is found in at least so many documents loses its lines.
LEAST_POINTS, LEAST_DOCS = 40, 5
#: A table is added in so many batches of documents, by descending id.
BATCHES = 4
#: A level of so many runs is merged into one run of the next level.
FAN = 2


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(SPACES)), UPPER, LOWER)


def lines_of(text: Column) -> Column:
    """The lines of a text; null and empty texts are one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def key_hash(key: Column) -> Column:
    """128 bits that stand for a key."""
    return F.unhex(F.md5(key))


class LineRuns:
    """Line hashes that were seen, as sorted runs on levels. Each hash is in one run only, with the largest document of the batch that brought it.

    A run is a table bucketed and sorted by hash, so that a batch, bucketed alike, meets the runs by merge joins without a shuffle. add()
    anti-joins a batch with all runs and keeps what is left as a run of the lowest level. FAN runs of a level are merged
    into one run of the next level, so that a batch meets at most FAN - 1 runs of each of few levels. Runs are
    written to shared storage: a lost executor costs the tasks it ran.
    """

    def __init__(self, spark: SparkSession, fan: int = FAN):
        if fan < 2:
            raise ValueError("a level needs two runs at least")
        self.spark, self.fan, self.levels = spark, fan, [[]]
        self.tables: dict[str, str] = {}

    def bucketed(self, rows: DataFrame, *order: str) -> DataFrame:
        """rows as a table bucketed by hash, one file for each bucket, sorted by `order`."""
        name, path = f"line_runs_{uuid.uuid4().hex}", new_path(self.spark, "line-runs")
        buckets = n_partitions(self.spark)
        dealt = rows.repartition(buckets, "hash")
        dealt.write.bucketBy(buckets, "hash").sortBy(*order).option("path", path).saveAsTable(name)
        self.tables[name] = path
        return self.spark.table(name)

    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def unseen(self, batch: DataFrame) -> DataFrame:
        """Rows of a batch whose hash no run has."""
        return reduce(lambda rows, run: rows.join(run.hint("merge").select("hash"), "hash", "left_anti"), self.runs(), batch)

    def add(self, batch: DataFrame) -> None:
        """Adds a batch (hash, top_id; each hash once): its new hashes become a run, then full levels are merged."""
        self.levels[0].append(self.bucketed(self.unseen(batch).select("hash", "top_id"), "hash"))
        for k, level in enumerate(self.levels):
            if len(level) < self.fan:
                break
            if k + 1 == len(self.levels):
                self.levels.append([])
            self.levels[k + 1].append(self.bucketed(reduce(DataFrame.unionByName, level), "hash"))
            level.clear()

    def all(self) -> DataFrame:
        """hash, top_id of all hashes."""
        return reduce(DataFrame.unionByName, self.runs())

    def drop(self) -> None:
        """Deletes the runs."""
        for name, path in self.tables.items():
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            remove(path)
        self.tables, self.levels = {}, [[]]


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", points: int = LEAST_POINTS, least: int = LEAST_DOCS, batches: int = BATCHES) -> DataFrame:
    """hash, top_id (the largest document) of each key that loses its lines, as a table.

    Batches go by descending id, so that the largest document of a key is that of the batch in which the runs hadn't its hash yet. A document has each key
    once, however many of its lines have it. Hashes are counted before they are shuffled, so that a line that a third of the
    documents share gives a row for each task.
    """
    spark = docs.sparkSession
    ids = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    bounds = ids.agg(F.percentile_approx("id", [k / batches for k in range(batches - 1, 0, -1)], 1000)).first()[0] if batches > 1 else None
    # Batch 0 has the largest ids; null ids are below all others.
    number = sum((F.coalesce(F.col("id") < b, F.lit(True)).cast("int") for b in sorted(set(bounds or ()))), F.lit(0))
    long = F.filter(F.transform(lines_of(F.col("text")), line_key), lambda k: F.length(k) >= points)
    rows = ids.select("id", number.alias("batch"), F.explode(F.array_distinct(long)).alias("key")).select("id", "batch", key_hash(F.col("key")).alias("hash"))
    store = LineRuns(spark)
    try:
        tallies = store.bucketed(rows.groupBy("batch", "hash").agg(F.count(F.lit(1)).alias("docs"), F.max("id").alias("top_id")), "batch", "hash")
        for k in range(len(set(bounds or ())) + 1):
            store.add(tallies.filter(F.col("batch") == k))
        often = tallies.groupBy("hash").agg(F.sum("docs").alias("docs")).filter(F.col("docs") >= least)
        return materialize(often.select("hash").join(store.all(), "hash"), "repeated-lines")
    finally:
        store.drop()


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", points: int = LEAST_POINTS, least: int = LEAST_DOCS, batches: int = BATCHES) -> DataFrame:
    """Takes lines away that many documents share, but for the largest document that has them.

    Returns a row for each row of docs: its columns as one column `row`, doc_id, lines (those that stay, in order), n_lines (before) and n_dropped. A
    line's key is the line without white space at its ends, A-Z lower-cased; keys of at least `points` code points
    in at least `least` documents lose all their lines, except in rows of the largest id.

    Only documents that lose lines are joined with what they lose; the places of lines that a frequent key has are
    looked up in as many parts as there are partitions, unless the keys are few enough to be broadcast.

    Null and empty texts are one empty line, which stays. Very long texts are split whole. Repeated rows are documents of their own: each
    counts, and all rows of the largest id keep their lines. A null id is below all others; if all documents of a key have
    none, all of them keep it. An empty table gives an empty result. Other columns may have any names.
    """
    spark = docs.sparkSession
    found = repeated_lines(docs, id_col, text_col, points, least, batches)
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"), row_hash(docs).alias("same"))
    places = whole.select("doc_id", "same", F.posexplode(F.transform(lines_of(F.col("text")), line_key)).alias("pos", "key")).filter(F.length("key") >= points)
    places = places.select("doc_id", "same", "pos", key_hash(F.col("key")).alias("hash"))
    few = small(found)
    if few is found:  # too many to be broadcast: a frequent key's lines are met in parts
        parts = n_partitions(spark)
        places = places.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(parts)))
        few = places.select("hash", "part").distinct().join(found, "hash")
        hit = places.join(few, ["hash", "part"])
    else:
        hit = places.join(few, "hash")
    lost = hit.filter(~F.col("doc_id").eqNullSafe(F.col("top_id"))).groupBy(F.col("doc_id").alias("its_id"), F.col("same").alias("its_same")).agg(F.collect_set("pos").alias("lost"))
    lost = small(materialize(lost, "lost-lines"))
    on = F.col("doc_id").eqNullSafe(F.col("its_id")) & (F.col("same") == F.col("its_same"))
    joined = whole.join(lost, on, "left").withColumn("all_lines", lines_of(F.col("text")))
    n = F.size("all_lines")
    stay = F.array_except(F.sequence(F.lit(0), n - 1), "lost")
    kept = F.when(F.col("lost").isNull(), F.col("all_lines")).otherwise(F.transform(stay, lambda i: F.get(F.col("all_lines"), i)))
    return joined.select("row", "doc_id", kept.alias("lines"), n.cast("long").alias("n_lines"), F.coalesce(F.size("lost"), F.lit(0)).cast("long").alias("n_dropped"))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2(F.array_join("lines", "\n"), 256).alias("kept_sha256"))


ORACLE = f"""
WITH s AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM s),
k AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') AS key FROM l),
b AS (SELECT key, max(doc_id) AS top FROM k WHERE length(key) >= {LEAST_POINTS} GROUP BY key HAVING count(DISTINCT doc_id) >= {LEAST_DOCS}),
m AS (SELECT k.*, b.key IS NOT NULL AND k.doc_id IS DISTINCT FROM b.top AS dropped FROM k LEFT JOIN b ON k.key = b.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
