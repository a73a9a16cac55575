"""Streams with state, table functions, and promotion of people, acts and subsidiary legislation."""

import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from casemill.functions import tables
from casemill.operators import citations, html, relations, storage
from casemill.plans import pipelines
from casemill.sources import landing, walk
from casemill.streaming import discourse, stores

TEXTS = [
    "See Re Alpha [2001] SGHC 2 (“Alpha”) and s 2 of the Evidence Act 1893 (the “EA”).", "By s 4, (at [1]); r 3 of the Court Rules 2014.", "[1999] 2 SLR(R) 7 and rule 9.", None, "EA, s 5 (at [2]).", "Nothing.", "In Re Beta Co at [1] it held (at [5]).",
]


def cases(spark, ordinals):
    return spark.createDataFrame([(c, 100 * c + o, o, TEXTS[(c + o) % 7]) for c in (1, 2, 3, 4) for o in ordinals], "case_id long, id long, ordinal int, content string")


def of(df):
    return rows(df.select("case_id", "paragraph_id", "start", "end", "kind", "quoted", "name", "alias", "neutral", "slr", "edition", "provisions", "pins"))


def test_spans_over_micro_batches_are_those_of_one_batch(spark, tmp_path):
    whole = cases(spark, range(1, 10))
    known = citations.extract_aliases(whole)
    want = of(citations.extract_spans(whole, known))
    folder = str(tmp_path)
    known.write.parquet(f"{folder}/aliases")
    run = lambda: discourse.stream_spans(spark, f"{folder}/in", f"{folder}/aliases", f"{folder}/out", f"{folder}/check")
    read = lambda: spark.read.schema(citations.SPAN_SCHEMA).parquet(f"{folder}/out")
    cases(spark, range(1, 4)).write.mode("append").parquet(f"{folder}/in")
    run()
    run()  # nothing new
    assert of(read()) == [r for r in want if r[1] % 100 < 4]
    for part in (range(4, 5), range(5, 10)):
        cases(spark, part).write.mode("append").parquet(f"{folder}/in")
        run()
    assert of(read()) == want


def test_table_functions_give_the_rows_of_the_operators(spark):
    tables.register(spark)
    whole = cases(spark, range(1, 10))
    whole.createOrReplaceTempView("t_cases")
    known = citations.extract_aliases(whole)
    got = spark.sql("SELECT * FROM citation_spans(TABLE(t_cases) PARTITION BY case_id ORDER BY ordinal)")
    assert of(got) == of(citations.extract_spans(whole, known))
    assert "ArrowEvalPythonUDTF" in got._jdf.queryExecution().toString()
    aliases = spark.sql("SELECT key, short_name, expanded, kind FROM alias_defs(TABLE(SELECT case_id, content FROM t_cases))").distinct()
    assert rows(aliases) == rows(known)
    spark.createDataFrame([(1, "<p>1 One</p><p>two"), (2, None)], "id long, html string").createOrReplaceTempView("t_pages")
    assert rows(spark.sql("SELECT key, pos, text FROM html_paragraphs(TABLE(t_pages))")) == rows(html.paragraphs(spark.table("t_pages"), "id", "html"), "id", "pos", "text")
    cell = '<div class="body"><div class="prov1"><table><tr><td class="prov1Txt"><strong>4.</strong> “x” is<table><tr><td class="def">“y” means z</td></tr></table></td></tr></table></div></div>'
    spark.createDataFrame([(7, cell)], "id long, html string").createOrReplaceTempView("t_acts")
    assert rows(spark.sql("SELECT key, kind, citation FROM provision_tree(TABLE(t_acts))")) == [(7, "section", "s 4")]
    assert rows(spark.sql("SELECT * FROM statute_definitions(TABLE(t_acts))")) == [(7, "y", "means z")]


def empty(spark):
    return {n: spark.createDataFrame([], s) for n, s in pipelines.PEOPLE.items()}


def test_people_are_made_once_and_kept(spark):
    metadata = {"Corams": {"Coram": ["Tay CJ", "Tay CJ"]}, "Parties": {"Party": [{"Role": "a", "Name": "P"}, {"Role": "b", "Name": "P"}]}, "Counsels": {"Counsel": "Ann Lee for the P"}}
    table = spark.createDataFrame([(1, "SGHC", json.dumps(metadata), None), (2, "X", "{}", '{"corams": ["Lim J", 3, "Tay"]}'), (3, None, None, "no json")], "id long, court string, metadata string, hit string")
    first = pipelines.promote_people(table, empty(spark))
    assert rows(first["courts"]) == [(1, "SGHC", "General Division of the High Court"), (2, "X", "X")]
    assert rows(first["judges"]) == [(1, "Lim", "J"), (2, "Tay", None), (3, "Tay", "CJ")] and rows(first["case_judges"]) == [(1, 3), (2, 1), (2, 2)]
    assert rows(first["parties"]) == [(1, "P")] and rows(first["case_parties"]) == [(1, 1, "a")] and rows(first["case_counsel"]) == [(1, 1, "P")]
    again = pipelines.promote_people(table, first)
    assert {n: rows(t) for n, t in again.items()} == {n: rows(t) for n, t in first.items()}


def test_a_reference_is_resolved_when_its_case_comes(spark):
    page = lambda text: f'<p class="Judg-1">1 {text}</p>'
    hit = lambda n, day: (f"[2001] SGHC {n}", day, "T", json.dumps({"titles": ["Found"], "corams": ["Tay J"]}), 1, n)
    hits = lambda *found: spark.createDataFrame(list(found), "citation string, d string, title string, hit string, page long, pos int").withColumn("date", F.to_date("d")).drop("d")
    docs = lambda *found: spark.createDataFrame([(n, f"[2001] SGHC {n}", page(t), m, f"u{n}") for n, t, m in found], "id long, citation string, html string, metadata string, uri string")
    make = lambda schema: spark.createDataFrame([], schema)
    stored = {
        "raw": make(pipelines.RAW_CASES), "cases": make("id long, citation string, date date, title string, court string, number string, uri string"), "paragraphs": make("case_id long, ordinal int, text string, uri string"),
        "extracted": make("case_id long"), "aliases": make("case_id long, short_name string, expanded string, kind string"), "references": make(citations.SPAN_SCHEMA + ", target_case long, target_paragraph long"),
    }
    first = pipelines.update_cases(stored, hits(hit(1, "2001-01-01")), docs((1, "See Re B [2001] SGHC 2 at [1].", "{}")))
    assert [(r.target_case, r.target_paragraph) for r in first["references"].collect()] == [(None, None)]
    # The second case's date is in its metadata only.
    second = pipelines.update_cases(first, hits(hit(2, None)), docs((2, "Only.", '{"DecisionDate": "2001-05-06T00:00"}')))
    assert [str(r.date) for r in second["cases"].orderBy("id").collect()] == ["2001-01-01", "2001-05-06"]
    [found] = second["references"].collect()
    assert found.target_case is None and found.target_paragraph is not None
    assert rows(second["judges"], "name", "title") == [("Tay", "J")] and rows(second["case_judges"], "case_id") == [(1,), (2,)]


STATUTE = '<div class="legis"><div class="body"><div class="prov1" id="q"><table><tr><td class="prov1Txt"><strong>1.</strong> Text</td></tr></table></div></div><div class="tail"><div class="schedule"><table><tr><td class="sHdr" id="S">SCHEDULE</td></tr></table><table><tr><td class="tailSTxt">1. One</td></tr></table></div></div></div>'


def test_acts_from_browsing_to_provisions(spark):
    make = lambda schema: spark.createDataFrame([], schema)
    tree = "ordinal int, kind string, citation string, content string, uri string, parent_uri string"
    stored = {
        "acts": make("slug string, title string"), "versions": make("slug string, valid_from date, href string, is_current boolean, fetch string, parse string, promoted boolean"), "provisions": make(f"version_id long, {tree}"),
        "definitions": make("slug string, term string, definition string"), "knowledge_acts": make("id long, uri string, title string"), "subsidiary": make("id long, act_id long, uri string, title string, number string, date date"),
        "subsidiary_provisions": make(f"subsidiary_legislation_id long, {tree}"),
    }
    day = F.to_date(F.lit("2020-01-01"))
    browsed = spark.createDataFrame([("A", "An act", 0)], "slug string, title string, pos int")
    timelines = spark.createDataFrame([("A", "/a", True)], "slug string, href string, is_current boolean").select("slug", day.alias("valid_from"), "href", "is_current")
    documents = spark.createDataFrame([(5, "A", "http://a/20200101", STATUTE)], "id long, slug string, uri string, html string").withColumn("valid_from", day)
    instruments = spark.createDataFrame([(9, "http://s", "Rules", "S 1", "http://a", "An act", True, 2, False, STATUTE), (10, "http://t", "Old", "S 2", "http://a", "An act", True, 7, False, STATUTE)], "id long, uri string, title string, number string, act_uri string, act_title string, is_current boolean, extracted int, promoted boolean, html string").withColumn("valid_from", day)
    done = pipelines.update_acts(stored, browsed, timelines, documents, instruments)
    assert rows(done["provisions"], "version_id", "uri", "citation") == [(5, "http://a/20200101#S", "Sch"), (5, "http://a/20200101#n3", "Sch para 1"), (5, "http://a/20200101#q", "s 1")]
    assert rows(done["versions"], "slug", "parse", "promoted") == [("A", "complete", True)]
    assert rows(done["subsidiary"], "id", "act_id", "uri") == [(1, 1, "http://s")] and rows(done["knowledge_acts"]) == [(1, "http://a", "An act")]
    assert rows(done["subsidiary_provisions"], "subsidiary_legislation_id", "uri") == [(1, "http://s#S"), (1, "http://s#n3"), (1, "http://s#q")]
    assert rows(done["instruments"], "id", "promoted") == [(10, False), (9, True)]
    again = pipelines.update_acts(stored | {n: done[n] for n in stored}, browsed, timelines, documents, instruments)
    assert {n: t.count() for n, t in again.items()} == {n: t.count() for n, t in done.items()}


@pytest.mark.parametrize("uri", ["http://s", "http://other"])
def test_stored_instruments_are_only_marked(spark, uri):
    make = lambda schema, *found: spark.createDataFrame(list(found), schema)
    versions = make("id long, uri string, title string, number string, act_uri string, act_title string, is_current boolean, extracted int, promoted boolean", (9, "http://s", "Rules", "S 1", "http://a", "An act", True, 2, False)).withColumn("valid_from", F.to_date(F.lit("2020-01-01")))
    stored = make("id long, act_id long, uri string, title string, number string", (3, 1, uri, "t", "n")).withColumn("date", F.to_date(F.lit("2000-01-01")))
    parsed = pipelines.parse_acts(make("id long, html string", (9, STATUTE)))
    done = pipelines.promote_subsidiary(versions, parsed, make("id long, uri string, title string", (1, "http://a", "Kept")), stored, make("subsidiary_legislation_id long, ordinal int, uri string"))
    assert rows(done["versions"], "promoted") == [(True,)] and rows(done["acts"]) == [(1, "http://a", "Kept")]
    assert rows(done["subsidiary"], "id", "uri") == ([(3, "http://s")] if uri == "http://s" else [(3, "http://other"), (4, "http://s")])
    assert done["provisions"].count() == (0 if uri == "http://s" else 3)


def test_a_stop_between_two_stores_is_repaired(spark, tmp_path):
    folder, broken = str(tmp_path), [True]
    make = lambda: (stores.Store(spark, f"{folder}/a", {"rows": "id long"}), stores.Store(spark, f"{folder}/b", {"seen": "id long, twice long"}))
    first, second = make()

    def to_second(tables_):
        if broken[0]:
            raise RuntimeError("stopped between the stores")
        return {"seen": tables_["rows"].withColumn("twice", F.col("id") * 2)}

    run = lambda: stores.apply_to_both(spark.readStream.schema("id long").parquet(f"{folder}/in"), f"{folder}/check", *make(), lambda b: {"rows": b}, to_second)
    spark.range(3).write.parquet(f"{folder}/in")
    with pytest.raises(Exception, match="stopped between the stores"):
        run()
    assert rows(first.table("rows")) == [(0,), (1,), (2,)] and second.table("seen").count() == 0
    broken[0] = False
    run()
    want = [(0, 0), (1, 2), (2, 4)]
    assert rows(second.table("seen")) == want and first.table("rows").count() == 3
    run()
    assert rows(second.table("seen")) == want and stores.repair(first, second, to_second) == 0
    # Without another run of the stream, the stores alone are enough; half a batch isn't seen.
    spark.range(5, 6).write.mode("append").parquet(f"{folder}/in")
    broken[0] = True
    with pytest.raises(Exception, match="stopped between the stores"):
        run()
    broken[0] = False
    spark.range(77, 78).withColumn("twice", F.col("id")).write.parquet(f"{folder}/b/seen/batch=1")
    assert rows(second.table("seen")) == want
    assert stores.repair(first, second, to_second) == 1 and rows(second.table("seen")) == [*want, (5, 10)]


def test_counters_of_a_stage_are_those_of_its_rows(spark):
    table = spark.createDataFrame([("a",), ("b",), ("a",), (None,), ("x",)], "state string")
    got, counts = storage.observed(table, "stage", **relations.report_counts("state", ("a", "b")))
    assert counts == {"total": 5, "a": 2, "b": 1, "other": 2} and got.count() == 5
    assert storage.observed(table.limit(0), "stage", **relations.report_counts("state", ("a",)))[1] == {"total": 0, "a": 0, "other": 0}


def test_landed_pages_as_a_data_source(spark, tmp_path):
    walk.register(spark)
    hit = lambda n, day, **more: {"ncitation": f"[2001]  SGHC {n} ", "dates": [day], "titles": ["T"], "casenumber": "S 1", "corams": ["Tay J", 3]} | more
    pages = {1: [hit(1, "2024-03-01"), 7, hit(2, "bad")], 2: [hit(3, "2024-02-01"), hit(4, "2024-01-05T10:00", ncitation=" ")], 3: [hit(5, "2023-12-31"), hit(6, "2024-01-02")], 4: [hit(7, "2023-01-01")]}

    def land(*numbers):
        for n in numbers:
            (tmp_path / "in").mkdir(exist_ok=True)
            (tmp_path / "in" / f"page-{n:03}.json").write_text(json.dumps({"page": n, "data": {"results": pages[n]}}))

    def run():
        stream = spark.readStream.format("landed_search").option("mark", "2024-01-01").load(str(tmp_path / "in"))
        query = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start()
        query.awaitTermination()
        return sum(p["numInputRows"] for p in query.recentProgress)

    land(1, 2, 3, 4)
    whole = spark.read.format("landed_search").option("pagesPerTask", "2").load(str(tmp_path / "in"))
    assert whole.rdd.getNumPartitions() == 2
    names = ["page", "pos", "citation", "date", "title", "case_number"]
    assert rows(whole, *names) == rows(landing.search_hits(spark, str(tmp_path / "in")), *names)
    assert whole.filter("page = 1").first().judges == ["Tay J"]
    # The third page has a hit older than the mark: the walk ends with it.
    assert run() == 5 and {r.page for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {1, 2, 3}
    assert run() == 0
    (tmp_path / "other").mkdir()
    (tmp_path / "other" / "page-1.json").write_text("no json")
    assert spark.read.format("landed_search").load(str(tmp_path / "other")).collect() == spark.read.format("landed_search").load(str(tmp_path / "none")).collect() == []


def test_landed_pages_many_in_a_file(spark, tmp_path):
    walk.register(spark)
    day = {n: f"2024-03-{28 - n:02}" for n in range(1, 28)}
    line = lambda n: json.dumps({"page": n, "data": {"results": [{"ncitation": f"[2001] SGHC {n}", "dates": [day[n]]}]}})

    def land(name, *numbers):
        (tmp_path / "in" / "pages=1-10").mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / "pages=11-20").mkdir(exist_ok=True)
        (tmp_path / "in" / name).write_text("\n".join(map(line, numbers)) + "\n")

    def run(out, mark):
        stream = spark.readStream.format("landed_search").option("mark", mark).load(str(tmp_path / "in"))
        stream.writeStream.format("parquet").option("path", str(tmp_path / out)).option("checkpointLocation", str(tmp_path / f"{out}-check")).trigger(availableNow=True).start().awaitTermination()
        return sorted(r.page for r in spark.read.parquet(str(tmp_path / out)).collect())

    land("pages=1-10/a.txt", 3, 1, 2)
    assert run("all", "") == [1, 2, 3] == run("some", day[14])
    # Pages that come later stand in another file of the same range; ones out of a file's range are none.
    land("pages=1-10/b.txt", 10, 4, 6, 5, 9, 8, 7, 15)
    land("pages=11-20/c.txt", *range(11, 18))
    (tmp_path / "in" / "page-21.json").write_text(line(21))
    assert run("all", "") == [*range(1, 18), 21] and run("some", day[14]) == [*range(1, 16)]
    whole = spark.read.format("landed_search").load(str(tmp_path / "in"))
    assert whole.rdd.getNumPartitions() == 4 and sorted(r.page for r in whole.collect()) == [*range(1, 18), 21]


def test_people_of_cases_in_one_split_are_read_by_all_tasks(spark, tmp_path, monkeypatch):
    path, seen, write = str(tmp_path / "cases"), {}, pipelines.written
    monkeypatch.setattr(pipelines, "written", lambda df, tag: seen.setdefault(tag, df.rdd.getNumPartitions()) and write(df, tag))
    spark.range(40).selectExpr("id", """'{"Parties": {"Party": [{"Role": "plaintiff", "Name": "A"}]}}' AS metadata""", """'{"corams": ["Tay J"]}' AS hit""").coalesce(1).write.parquet(path)
    found = pipelines.case_people(spark.read.parquet(path))
    assert seen["people"] >= 4 and found["judges"].count() == found["parties"].count() == 40 and found["counsel"].count() == 0
    assert {tuple(r)[2:] for r in found["judges"].collect()} == {("Tay", "J")}


def test_streamed_paragraphs_are_walked_where_their_state_is(spark, tmp_path):
    """One stateful step reads paragraphs by case; what used to go through it were spans, row by row. Paragraphs without an ordinal come first, and long ids beside nulls stay whole."""
    long = (1 << 60) + 1
    first = [(long, long + 1, None, "See Re Alpha [2001] SGHC 2 (“Alpha”)."), (long, long + 2, None, "It holds (at [3])."), (None, long, 1, "Under r 4 of the Court Rules 2014.")]
    then = [(long, long + 3, 1, "By s 4 (at [5])."), (None, 7, 2, "And rule 5.")]
    known = citations.extract_aliases(spark.createDataFrame(first + then, discourse.PARAGRAPHS))
    known.write.parquet(f"{tmp_path}/aliases")
    stream = spark.readStream.schema(discourse.PARAGRAPHS).parquet(str(tmp_path))
    plan = discourse.in_context(stream, spark.read.parquet(f"{tmp_path}/aliases"))._jdf.queryExecution().analyzed().toString()
    assert "TransformWithState" in plan and "MapIn" not in plan
    for part in (first, then):
        spark.createDataFrame(part, discourse.PARAGRAPHS).write.mode("append").parquet(f"{tmp_path}/in")
        discourse.stream_spans(spark, f"{tmp_path}/in", f"{tmp_path}/aliases", f"{tmp_path}/out", f"{tmp_path}/check")
    got = spark.read.schema(citations.SPAN_SCHEMA).parquet(f"{tmp_path}/out")
    assert rows(got, "case_id", "paragraph_id", "ordinal", "kind", "alias", "pins") == sorted([
        (long, long + 1, None, "case", "Alpha", []), (long, long + 2, None, "case", "Alpha", [3]), (long, long + 3, 1, "provision", None, []), (long, long + 3, 1, "case", "Alpha", [5]),
        (None, long, 1, "rule", None, []), (None, 7, 2, "rule", "Court Rules 2014", []),
    ], key=repr)


def test_numbers_of_one_length_have_one_shape():
    shapes = citations.Shapes()
    assert len({shapes.key(f"[1999] 2 SLR(R) {k} and s {k}") for k in range(100, 1000)}) == 1
    assert shapes.key("[3001] SGHC 1") != shapes.key("[2001] SGHC 1") == shapes.key("[1001] SGHC 2")
