"""References that are resolved as their targets arrive: tables that grow by batches, each at the cost of its own rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casemill.operators import citations, snapshots
from casemill.operators.storage import written

#: Tables are divided by the hash of a citation into so many parts; a batch reads those that its citations fall in.
BUCKETS = 16
#: So many tasks at most write a bucket: a citation that is wanted very often would leave a bucket's rows to one.
SHARES = 8
KEY = ("case_id", "paragraph_id", "start")
TARGETS = "citation string, ordinal int, target_case long, target_paragraph long"
WAITING = "ref_batch long, case_id long, paragraph_id long, start int, wanted string, pin int"
FOUND = "ref_batch long, case_id long, paragraph_id long, start int, target_case long, target_paragraph long"


class ReferenceStore:
    """References and their targets as tables in a folder, kept up by joins with what is new.

    references: the spans of each batch. targets: by citation, a case and its paragraphs. waiting: references to cases that aren't there yet. found: what
    references refer to. A batch joins its references with the targets of their citations, and the waiting references of its
    cases' citations with these cases; both read only the buckets of these citations, so that a run costs as much as its batch. Each batch
    writes folders of its own, so that a batch that is run again, after a failure as well, replaces what it had written.

    A citation that many references share is one row of targets a paragraph: such joins are those that Spark splits when they are skewed.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.schemas = {"references": citations.SPAN_SCHEMA, "targets": TARGETS, "waiting": WAITING, "found": FOUND}
        for name, schema in self.schemas.items():
            spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{self.folder}/{name}/batch=0" + "/bucket=-1" * (name in ("targets", "waiting")))

    def _read(self, name: str, before: int | None = None, buckets: list[int] | None = None) -> DataFrame:
        parts = "batch long" + ", bucket long" * (name in ("targets", "waiting"))
        rows = self.spark.read.schema(f"{self.schemas[name]}, {parts}").parquet(f"{self.folder}/{name}")
        rows = rows.filter(F.col("batch") < before) if before is not None else rows
        return rows.filter(F.col("bucket").isin(buckets)) if buckets is not None else rows

    def _write(self, name: str, number: int, rows: DataFrame, citation: str | None = None) -> DataFrame:
        path = f"{self.folder}/{name}/batch={number}"
        if citation:
            bucket = F.pmod(F.xxhash64(citation), F.lit(BUCKETS))
            share = F.pmod(F.xxhash64(*rows.columns), F.lit(SHARES))
            rows.withColumn("bucket", bucket).repartition(F.col("bucket"), share).write.mode("overwrite").partitionBy("bucket").parquet(path)
            return self.spark.read.schema(f"{self.schemas[name]}, bucket long").parquet(path)
        rows.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    @staticmethod
    def _buckets(rows: DataFrame, citation: str) -> list[int]:
        """The buckets of the citations, BUCKETS at most."""
        return sorted(r[0] for r in rows.select(F.pmod(F.xxhash64(citation), F.lit(BUCKETS)).alias("b")).distinct().collect())

    def add(self, number: int, spans: DataFrame, aliases: DataFrame | None, cases: DataFrame, paragraphs: DataFrame) -> None:
        """Adds batch `number` (from 1): the spans and aliases of its cases, its cases (case_id, neutral_citation) and their paragraphs (case_id, id, ordinal).

        Any of them may be empty. Without aliases, spans are those of citations.case_references(). A citation that an earlier batch has brought stays with that case; within a batch the first case by id has it. Spans
        of a case that an earlier batch had take the place of the earlier ones.
        """
        references = self._write("references", number, spans)
        looking = (F.col("kind") == "self") & F.col("pin").isNotNull() | (F.col("kind") == "case") & F.col("wanted").isNotNull()
        sought = written(citations.sought(references, aliases).select(*KEY, "kind", "wanted", "pin").filter(looking), "sought")
        places = paragraphs.groupBy("case_id", "ordinal").agg(F.max("id").alias("target_paragraph"))
        first = cases.filter("neutral_citation IS NOT NULL").groupBy(F.col("neutral_citation").alias("citation")).agg(F.min("case_id").alias("target_case"))
        first = written(first, "cited")
        arrived = self._buckets(first, "citation")
        new = snapshots.absent(first, self._read("targets", number, arrived).filter("ordinal IS NULL"), ["citation"])
        whole = new.select("citation", F.lit(None).cast("int").alias("ordinal"), "target_case", F.lit(None).cast("long").alias("target_paragraph"))
        parts = new.join(places, F.col("target_case") == F.col("case_id")).select("citation", F.col("ordinal").cast("int").alias("ordinal"), "target_case", "target_paragraph")
        targets = self._write("targets", number, whole.unionByName(parts), "citation").drop("bucket")
        mine = sought.withColumn("ref_batch", F.lit(number).cast("long"))
        own = mine.filter("kind = 'self'").join(places, ["case_id"]).filter(F.col("pin") == F.col("ordinal")).withColumn("target_case", F.lit(None).cast("long"))
        seeking = mine.filter("kind = 'case'")
        known = self._read("targets", number + 1, self._buckets(seeking, "wanted")).drop("batch", "bucket")
        late = self._read("waiting", number, arrived).drop("batch", "bucket")
        names = [c.split()[0] for c in FOUND.split(", ")]
        found = own.select(names).unionByName(_met(seeking, known).select(names)).unionByName(_met(late, targets).select(names))
        self._write("found", number, found)
        there = known.filter("ordinal IS NULL").select("citation")
        waiting = seeking.join(there, F.col("wanted") == F.col("citation"), "left_anti")
        self._write("waiting", number, waiting.select(*(c.split()[0] for c in WAITING.split(", "))), "wanted")

    def references(self) -> DataFrame:
        """All references with target_case and target_paragraph; of a case that several batches had, those of the last.

        Whether there is such a case is looked up at once: most stores have none, and then references needn't meet their cases.
        """
        rows = self._read("references")
        again = rows.groupBy(F.col("case_id").alias("l_case")).agg(F.min("batch").alias("l_first"), F.max("batch").alias("l_batch")).filter("l_first < l_batch").drop("l_first")
        if not again.isEmpty():
            rows = rows.join(again, (F.col("case_id") == F.col("l_case")) & (F.col("batch") < F.col("l_batch")), "left_anti")
        found = self._read("found").drop("batch").withColumnRenamed("ref_batch", "batch")
        return rows.join(found, ["batch", *KEY], "left").select(*(c.split()[0] for c in citations.SPAN_SCHEMA.split(", ")), "target_case", "target_paragraph")


def _met(seeking: DataFrame, targets: DataFrame) -> DataFrame:
    """References whose case is among the targets: a paragraph if they name one that the case has, else the case."""
    cases = targets.filter("ordinal IS NULL").select(F.col("citation").alias("c_citation"), F.col("target_case").alias("its_case"))
    parts = targets.filter("ordinal IS NOT NULL").select(F.col("citation").alias("p_citation"), F.col("ordinal").alias("p_ordinal"), "target_paragraph")
    rows = seeking.join(cases, F.col("wanted") == F.col("c_citation")).join(parts, (F.col("wanted") == F.col("p_citation")) & (F.col("pin") == F.col("p_ordinal")), "left")
    return rows.withColumn("target_case", F.when(F.col("target_paragraph").isNull(), F.col("its_case")))
