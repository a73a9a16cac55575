"""References whose targets arrive later."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from casemill.operators import citations, references, snapshots

TEXTS = {
    1: ["See Re B [2001] SGHC 2 (“B”) at [2]. As described at [1].", "B at [9] and Re C [2001] SGHC 3."],
    2: ["Re A [2001] SGHC 1 at [1]; X v Y [2001] SGHC 9.", "Alone."],
    3: ["Both in Re A [2001] SGHC 1 at [1] and [2] and Re C [2001] SGHC 3 at [1].", None],
}


def tables(spark, *numbers):
    paragraphs = spark.createDataFrame([(c, 10 * c + o, o, t) for c in numbers for o, t in enumerate(TEXTS[c], 1)], "case_id long, id long, ordinal int, content string")
    aliases = citations.extract_aliases(paragraphs)
    cases = spark.createDataFrame([(c, f"[2001] SGHC {c}") for c in numbers] + [(50, None)], "case_id long, neutral_citation string")
    return citations.extract_spans(paragraphs, aliases), aliases, cases, paragraphs


def of(df):
    return rows(df, "case_id", "paragraph_id", "start", "kind", "alias", "pins", "target_case", "target_paragraph")


@pytest.mark.parametrize("batches", [[(1, 2, 3)], [(1,), (2,), (3,)], [(3,), (2, 1)], [(2,), (3,), (1,)]])
def test_any_order_of_batches_ends_as_one(spark, tmp_path, batches):
    spans, aliases, cases, paragraphs = tables(spark, 1, 2, 3)
    store = references.ReferenceStore(spark, str(tmp_path))
    for number, some in enumerate(batches, 1):
        store.add(number, *tables(spark, *some))
    got = of(store.references())
    assert got == of(citations.resolve(spans, cases, paragraphs, aliases))
    assert sum(r[6] is not None or r[7] is not None for r in got) == 6


def test_a_batch_that_is_run_again_changes_nothing(spark, tmp_path):
    store = references.ReferenceStore(spark, str(tmp_path))
    for number, c in ((1, 1), (2, 2), (2, 2), (3, 3), (1, 1), (2, 2), (3, 3)):
        store.add(number, *tables(spark, c))
    spans, aliases, cases, paragraphs = tables(spark, 1, 2, 3)
    assert of(references.ReferenceStore(spark, str(tmp_path)).references()) == of(citations.resolve(spans, cases, paragraphs, aliases))


def test_a_case_that_comes_again_replaces_its_references(spark, tmp_path):
    store = references.ReferenceStore(spark, str(tmp_path))
    store.add(1, *tables(spark, 1, 2))
    spans, aliases, cases, paragraphs = tables(spark, 1)
    store.add(2, spans.filter("ordinal = 1"), aliases, cases, paragraphs)
    assert {r.paragraph_id for r in store.references().filter("case_id = 1").collect()} == {11}
    empty = [df.limit(0) for df in (spans, aliases, cases, paragraphs)]
    store.add(3, *empty)
    assert store.references().filter("case_id = 2").count() == 2


def test_walk_of_cases_equals_aliases_and_spans_apart(spark):
    texts = ["See Re Alpha [2001] SGHC {n} (“Alpha”) at [1]–[3] and s {n}(2) of the Sale of Goods Act 1999 (the “SGA”).", "Alpha at [{n}] agrees; s 4 of the SGA, then s 5.", "", None, "Beta v Gamma [3001] SGHC {n} (“B{n}”). B{n} at [2]; B1 at [{n}]. It holds (at [4])."]
    given = [(c, c * 10 + i, i, t and t.format(n=c)) for c in (1, 2, 17, 19, 30) for i, t in enumerate(texts[: 1 + c % 5] if c < 19 else texts)]
    paragraphs = spark.createDataFrame(given, "case_id long, id long, ordinal int, content string")
    aliases = citations.extract_aliases(paragraphs)
    cases = paragraphs.select("case_id").distinct().withColumn("neutral_citation", F.concat(F.lit("[2001] SGHC "), F.col("case_id").cast("string")))
    apart, walk = citations.extract_spans(paragraphs, aliases), citations.case_references(paragraphs)
    assert len(rows(walk)) > 20 and rows(walk.drop("sought")) == rows(apart)
    assert rows(citations.resolve(walk, cases, paragraphs)) == rows(citations.resolve(apart, cases, paragraphs, aliases))


def test_texts_of_one_shape_are_read_once():
    shapes, texts = citations.Shapes(), [f"As held (at [{k}]), s {k} applies; see [1999] 2 SLR(R) {k} (“X”)." for k in range(3, 10)]
    found = [[row for spans in citations.case_spans(k, [(k, 1, t)], shapes) for row in spans] for k, t in enumerate(texts)]
    assert len(shapes.definitions) == 1 and [f[2]["slr"] for f in found] == [f"[1999] 2 SLR(R) {k}" for k in range(3, 10)] and [f[0]["pins"] for f in found] == [[k] for k in range(3, 10)]


def test_a_batch_costs_no_anti_join_by_reference_and_no_second_table_of_spans(spark, tmp_path, monkeypatch):
    """Spans are written once, from the walk on; what waits is found by citation; and references meet their cases only if one has come twice."""
    spans, aliases, cases, paragraphs = tables(spark, 1, 2, 3)
    store = references.ReferenceStore(spark, str(tmp_path))
    asked, absent = [], snapshots.absent
    monkeypatch.setattr(references.snapshots, "absent", lambda rows, there, keys: asked.append(tuple(keys)) or absent(rows, there, keys))
    store.add(1, citations.case_references(paragraphs.filter("case_id = 1")), None, cases.filter("case_id = 1"), paragraphs.filter("case_id = 1"))
    store.add(2, citations.case_references(paragraphs.filter("case_id > 1")), None, cases.filter("case_id > 1"), paragraphs.filter("case_id > 1"))
    assert references.KEY not in asked
    plan = store.references()._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1
    assert of(store.references()) == of(citations.resolve(spans, cases, paragraphs, aliases))
    store.add(3, *tables(spark, 2))
    assert store.references()._jdf.queryExecution().optimizedPlan().toString().count("Join") == 2
    assert of(store.references()) == of(citations.resolve(spans, cases, paragraphs, aliases))


def test_a_citation_wanted_very_often_is_written_by_several_tasks(spark, tmp_path):
    store = references.ReferenceStore(spark, str(tmp_path))
    waiting = spark.range(40).select(F.lit(1).cast("long").alias("ref_batch"), F.col("id").alias("case_id"), F.col("id").alias("paragraph_id"), F.lit(0).alias("start"), F.lit("[2002] SGHC 7").alias("wanted"), F.lit(None).cast("int").alias("pin"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        store._write("waiting", 1, waiting, "wanted")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(list(tmp_path.glob("waiting/batch=1/bucket=*/*.parquet"))) > 1
