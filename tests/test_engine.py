"""Sources, snapshots, model jobs, streams and pipelines on small tables."""

import json
import random

import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import functions as F

from casemill.functions import scalars
from casemill.operators import citations, knowledge, labels, models, queue, snapshots, tree
from casemill.plans import pipelines
from casemill.sources import landing
from casemill.streaming import discovery


def test_search_hits_and_discovery(spark, tmp_path):
    hit = lambda c, d: {"ncitation": c, "dates": [d], "titles": ["T"], "casenumber": "n"}
    pages = [{"page": 0, "data": {"results": [hit(" A  1 ", "2020-01-02T00"), "x", hit(" ", None), hit("B 2", "bad")]}}, {"page": 1, "data": {"results": None}}, {"page": 2, "data": {"results": [hit("A 1", "2020-01-02"), hit("C 3", "2019-01-01")]}}]
    (tmp_path / "s.json").write_text("\n".join(map(json.dumps, pages)))
    hits = landing.search_hits(spark, str(tmp_path / "s.json"))
    assert [r[0] for r in rows(hits, "citation")] == ["A 1", "A 1", "B 2", "C 3"]
    empty = spark.createDataFrame([], pipelines.RAW_CASES)
    first = pipelines.discover(empty, hits)
    assert [r[0] for r in rows(first, "citation")] == ["A 1", "B 2", "C 3"]
    again = pipelines.discover(spark.createDataFrame(first.collect(), first.schema), hits)
    assert rows(again) == rows(first)


def test_best_document_and_timeline(spark):
    good, bad = '<p class="Judg-1">1 a</p>', '<p class="Judg-1">1 a</p><p class="Judg-1">3 b</p>'
    payloads = spark.createDataFrame([(1, json.dumps({"data": {"document": bad, "documents": {"x\\slr\\1": good, "y": "<i>z</i>"}}})), (2, json.dumps({"data": {"document": "only"}}))], "id long, payload string")
    assert dict(rows(landing.best_document(payloads, "id", "payload"))) == {1: good, 2: "only"}
    outcome = payloads.select(landing.fetch_outcome(F.lit(200), F.col("payload")).alias("x"), landing.fetch_outcome(F.lit(404), F.col("payload")).alias("y"), landing.fetch_outcome(F.lit(200), F.lit("{}")).alias("z"))
    assert tuple(outcome.first()) == ("success", "not_found", "not_found")
    page = '<a href="/Act/A?ValidDate=20200101">1 Jan 2020</a><a href="/Act/A/Historical/20190101">1 Jan 2019</a><a href="/x.pdf?ValidDate=20210101">1 Jan 2021</a><a href="/Act/A/Historical/20200101">1 Jan 2020</a>'
    found = landing.version_timeline(spark.createDataFrame([(1, page)], "id long, html string"), "id", "html")
    assert [(str(r.valid_from), r.is_current) for r in found.orderBy("valid_from").collect()] == [("2019-01-01", False), ("2020-01-01", True)]


def test_snapshots(spark):
    old = spark.createDataFrame([(1, "a"), (None, "n"), (2, "b")], "k long, v string")
    delta = spark.createDataFrame([(None, "m"), (3, "c"), (3, "d")], "k long, v string")
    assert rows(snapshots.upsert(old, delta, ["k"])) == rows(spark.createDataFrame([(1, "a"), (2, "b"), (None, "m"), (3, "c"), (3, "d")], "k long, v string"))
    assert rows(snapshots.insert_absent(old, delta, ["k"], [F.col("v")])) == [(1, "a"), (2, "b"), (3, "c"), (None, "n")]
    with pytest.raises(Exception, match="unknown name"):
        snapshots.must_match(old, spark.createDataFrame([("A", 1)], "n string, i int"), "v", "n", "i").collect()
    assert rows(snapshots.upsert(old.limit(0), delta.limit(0), ["k"])) == []


def test_token_units(spark):
    nodes = [(1, 1, 1, None, 3, "section", "a", False), (1, 2, 2, 1, 1, "subsection", "b b b", False), (1, 3, 3, 2, 0, "point", "c", False), (1, 4, 2, 1, 0, "subsection", "d d d d d d", False)]
    table = spark.createDataFrame(nodes, "doc long, ordinal int, level int, parent_ordinal int, descendant_count int, kind string, text string, embedded boolean")
    n = F.size(F.split(F.trim("text"), r"\s+"))
    assert [r[2] for r in rows(tree.token_units(table, "doc", n, 100))] == [1]
    assert [r[2] for r in rows(tree.token_units(table, "doc", n, 4))] == [2]
    assert [r[2] for r in rows(tree.token_units(table, "doc", n, 6))] == [2, 4]


def test_units_of_deep_trees_against_recursion(spark):
    rng = random.Random(3)
    nodes = []
    for doc in range(12):
        stack, size = [], rng.randint(1, 25)
        for ordinal in range(1, size + 1):
            level = rng.randint(1, min(len(stack) + 1, 4)) if stack else 1
            stack = [*stack[: level - 1], ordinal]
            kind = "section" if level == 1 and rng.random() < 0.9 else "schedule" if level == 1 else "point"
            nodes.append([doc, ordinal, level, stack[-2] if level > 1 else None, 0, kind, rng.choice(["a", "b b b", "c " * 9, " ", "d d"]), rng.random() < 0.1])
    for n in nodes:
        later = [m for m in nodes if m[0] == n[0] and m[1] > n[1]]
        n[4] = next((m[1] for m in later if m[2] <= n[2]), n[1] + len(later) + 1) - n[1] - 1
    words = lambda t: len(t.split())

    def units(n):
        text = "\n\n".join(m[6] for m in nodes if m[0] == n[0] and n[1] <= m[1] <= n[1] + n[4])
        if n[7] or not text.strip(" "):
            return []
        return [(n[0], n[1], words(text), text)] if words(text) <= 8 else [u for m in nodes if m[0] == n[0] and m[3] == n[1] for u in units(m)]

    table = spark.createDataFrame(nodes, "doc long, ordinal int, level int, parent_ordinal int, descendant_count int, kind string, text string, embedded boolean")
    got = tree.token_units(table, "doc", F.regexp_count("text", F.lit(r"\S+")), 8)
    assert rows(got, "doc", "ordinal", "n_tokens", "text") == sorted((u for n in nodes if n[2] == 1 and n[5] == "section" for u in units(n)), key=repr)
    vectors = got.select("doc", "ordinal", F.array(F.lit(1.0)).alias("embedding"))
    kept = tree.with_vectors(table.withColumns({"embedding": F.lit(None).cast("array<double>"), "embedding_text": F.lit("old")}), "doc", got, vectors)
    assert kept.count() == len(nodes) and rows(kept.filter("embedding IS NOT NULL"), "doc", "ordinal", "embedding_text") == rows(got, "doc", "ordinal", "text")


def test_the_first_sections_over_all_documents(spark):
    nodes = [(d, o, None, 0, "section", None if o == 3 else f"t{d}{o}", 1 if o == 2 else None) for d in (1, 2, 3) for o in (1, 2, 3, 4)]
    table = spark.createDataFrame(nodes, "doc long, ordinal int, parent_ordinal int, descendant_count int, kind string, text string, role int")
    got = tree.sections_to_classify(table, "doc", [F.desc("doc")], 3)
    assert rows(got) == [(2, 1, "t21", ""), (3, 1, "t31", ""), (3, 4, "t34", "")]
    assert tree.sections_to_classify(table, "doc", []).count() == 6 and tree.sections_to_classify(table, "doc", [], 0).count() == 0


def test_models(spark):
    table = spark.createDataFrame([(1, "aa"), (2, " "), (3, "b")], "id long, text string")
    size = lambda: lambda texts: pd.Series([[float(len(t)), 1.0] for t in texts])
    assert rows(models.embed(table, "id", F.col("text"), size, 2), "id", "embedding") == [(1, [2.0, 1.0]), (3, [1.0, 1.0])]
    always = lambda *x: (lambda: lambda texts: pd.Series([list(x)] * len(texts)))
    got = models.classify(
        table, "id", F.col("text"), F.lit(None).cast("string"), {"role": always(0.0, 2.0), "topics": always(3.0, -3.0), "concepts": always(1.0, 2.0, -1.0)},
        {"role": ["r0", "r1"], "topics": ["t0", "t1"], "concepts": ["c0", "c1", "c2"]}, {"topics": [0.5, 0.5], "concepts": [0.1, 0.5, 0.5]}, {"c0": ["t0"], "c1": ["t1"], "c2": ["t0"]},
    )
    assert {tuple(map(str, r[1:])) for r in got.collect()} == {("r1", "['t0']", "['c0']")}
    draws = models.sample_with_replacement(spark.createDataFrame([(1, 1.0), (2, 0.0), (3, 3.0)], "id long, w double"), "id", "w", 400, 7)
    counts = dict(draws.groupBy("id").count().collect())
    assert sum(counts.values()) == 400 and 2 not in counts and abs(counts[3] - 300) <= 2


def test_label_ties(spark):
    one = spark.createDataFrame([([0.6, 0.9, 0.6, 0.9],)], "s array<double>")
    assert one.select(labels.top_scores(F.col("s"), 0.6, 3)).first()[0] == [1, 3, 0]
    assert one.select(labels.best_index(F.col("s"))).first()[0] == 1
    assert one.select(labels.decode(labels.one_hot(F.array(F.lit("b"), F.lit("z")), ["a", "b"]), ["a", "b"])).first()[0] == ["b"]


def test_discovery_stream_runs_once(spark, tmp_path):
    source, target, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    schema = "id long, at timestamp"
    make = lambda ids: spark.createDataFrame([(i,) for i in ids], "id long").withColumn("at", F.timestamp_seconds(F.lit(1_600_000_000) + F.col("id")))
    make([1, 2, 2]).write.parquet(source)
    discovery.discover(spark, source, schema, target, check, "id", "at")
    discovery.discover(spark, source, schema, target, check, "id", "at")
    assert [r[0] for r in rows(spark.read.parquet(target), "id")] == [1, 2]
    make([3]).write.mode("append").parquet(source)
    discovery.discover(spark, source, schema, target, check, "id", "at")
    assert [r[0] for r in rows(spark.read.parquet(target), "id")] == [1, 2, 3]


def test_references_are_extracted_once(spark):
    paragraphs = spark.createDataFrame([(1, 1, 1, "Re A [2001] SGHC 2 (“A”) at [1]."), (2, 2, 1, "above at [1]")], "case_id long, id long, ordinal int, content string")
    cases = spark.createDataFrame([(1, "[2000] SGHC 1"), (2, "[2001] SGHC 2")], "case_id long, neutral_citation string")
    none = spark.createDataFrame([], "case_id long")
    _, found, done = pipelines.references(paragraphs, cases, none)
    assert {(r.case_id, r.target_case, r.target_paragraph) for r in found.collect()} == {(1, None, 2), (2, None, 2)}
    assert pipelines.references(paragraphs, cases, done)[1].count() == 0


def test_promotion_reasons(spark):
    cases = spark.createDataFrame([(1, "[2001] SGHC 2", "2001-01-01", "t", None, 3, 3), (2, "[2001] SGHC 3", "2001-01-01", "t", None, 3, 2), (3, "x", None, "t", None, 1, 1), (4, "x", None, None, None, None, None)], "id long, citation string, date string, title string, metadata string, expected int, blocks int")
    assert [r.reason for r in pipelines.reasons(cases).orderBy("id").collect()] == [None, "paragraph count differs", "no decision date", "missing document"]


def test_browse_rows_and_short_pages(spark):
    page = lambda *slugs: "<table>" + "".join(f'<tr><td><a href="/SL/{x}?a=1">Rules {x}</a><td>S {x}/2000</td></tr>' for x in slugs) + "</table><a href='/SL/z'>Z</a>"
    pages = spark.createDataFrame([(1, page("a", "b")), (2, page("c")), (3, page("d", "e"))], "id long, html string")
    found = landing.browse_rows(pages, "id", "html", "/SL/")
    assert [tuple(r)[2:] for r in found.filter("id = 1").orderBy("pos").collect()] == [("a", "Rules a", "/SL/a?a=1", "S a/2000"), ("b", "Rules b", "/SL/b?a=1", "S b/2000"), ("z", "Z", "/SL/z", "")]
    assert [r[0] for r in rows(landing.until_short_page(pages, found, "id", 3), "id")] == [1, 1, 1, 2, 2]


def test_case_stages_in_order(spark, tmp_path):
    hits = [("[2001] SGHC 1", "2001-02-01", 1, 0), ("[2001] SGHC 2", "2001-01-01", 1, 1)]
    hits = spark.createDataFrame([(c, d, "T", json.dumps({"titles": ["Found"], "casenumber": "S 1"}), p, i) for c, d, p, i in hits], "citation string, d string, title string, hit string, page long, pos int").withColumn("date", F.to_date("d")).drop("d")
    page = '<p class="Judg-1">1 See Re Alpha [2001] SGHC 2 (“Alpha”).</p><p class="Judg-1">2 Alpha at [1] holds (at [1]).</p>'
    documents = spark.createDataFrame([(10, "[2001] SGHC 1", page, json.dumps({"CaseTitle": "Given"}), "u1"), (11, "[2001] SGHC 2", '<p class="Judg-1">1 Only', "{}", "u2"), (12, "[2001] SGHC 3", "<p>x", "{}", "u3")], "id long, citation string, html string, metadata string, uri string")
    make = lambda schema: spark.createDataFrame([], schema)
    tables = {
        "raw": make(pipelines.RAW_CASES), "cases": make("id long, citation string, date date, title string, court string, number string, uri string"), "paragraphs": make("case_id long, ordinal int, text string, uri string"),
        "extracted": make("case_id long"), "aliases": make("case_id long, short_name string, expanded string, kind string"), "references": make(citations.SPAN_SCHEMA + ", target_case long, target_paragraph long"),
    }
    done = pipelines.update_cases(tables, hits, documents)
    assert rows(done["cases"], "id", "citation", "title", "number", "court", "uri") == [(1, "[2001] SGHC 1", "Given", "S 1", "SGHC", "u1"), (2, "[2001] SGHC 2", "Found", "S 1", "SGHC", "u2")]
    assert rows(done["paragraphs"], "case_id", "ordinal", "uri") == [(1, 1, "u1#1"), (1, 2, "u1#2"), (2, 1, "u2#1")]
    assert [r.promoted for r in done["raw"].collect()] == [True, True]
    found = done["references"].orderBy("ordinal", "start").collect()
    assert [(r.family, r.target_case is not None, r.target_paragraph is not None) for r in found] == [("case", True, False), ("alias", False, True), ("pin", False, True)]
    again = pipelines.update_cases(done, hits, documents)
    assert {n: t.count() for n, t in again.items()} == {n: t.count() for n, t in done.items()}


def test_legislation_stages(spark):
    day = F.to_date("d")
    browsed = spark.createDataFrame([("A", "New title", 0), ("A", "Later", 1), ("B", "B act", 2)], "slug string, title string, pos int")
    timelines = spark.createDataFrame([("A", "2020-01-01", "/a2", True), ("A", "2010-01-01", "/a1", False)], "slug string, d string, href string, is_current boolean").select("slug", day.alias("valid_from"), "href", "is_current")
    versions = spark.createDataFrame([("A", "2010-01-01", "/old", True, "success", "complete", True), ("C", "2000-01-01", "/c", True, "success", "complete", True)], "slug string, d string, href string, is_current boolean, fetch string, parse string, promoted boolean")
    found = pipelines.discover_acts(spark.createDataFrame([("A", "Old")], "slug string, title string"), versions.select("slug", day.alias("valid_from"), "href", "is_current", "fetch", "parse", "promoted"), browsed, timelines)
    assert rows(found["acts"]) == [("A", "New title"), ("B", "B act")]
    assert rows(found["versions"], "slug", "href", "is_current", "parse") == [("A", "/a2", True, "not_parsed"), ("A", "/old", False, "complete"), ("C", "/c", True, "complete")]
    page = '<div class="legis"><div class="body"><div class="prov1" id="pr1-"><td class="prov1Hdr">Aim</td><div class="prov1Txt"><strong>1.</strong> Text<table><tr><td class="def">“goods” means all</td></tr></table></div></div></div></div>'
    parsed = pipelines.parse_acts(spark.createDataFrame([(1, page), (2, "<p>none")], "id long, html string"))
    table = spark.createDataFrame([(1, "A", "http://a", True, False), (2, "B", "http://b", True, False)], "id long, slug string, uri string, is_current boolean, promoted boolean")
    stored = spark.createDataFrame([(1, 9, "http://a#old", None), (7, 1, "http://c#n1", None)], "version_id long, ordinal int, uri string, parent_uri string")
    terms = spark.createDataFrame([("A", "wares", "old"), ("C", "x", "y")], "slug string, term string, definition string")
    done = pipelines.promote_acts(table, parsed, stored, terms)
    assert rows(done["provisions"]) == [(1, 1, "http://a#pr1-", None), (7, 1, "http://c#n1", None)]
    assert rows(done["definitions"]) == [("A", "goods", "means all"), ("C", "x", "y")] and rows(done["versions"], "id", "promoted") == [(1, True), (2, False)]


def test_small_operators(spark):
    table = spark.createDataFrame([(1, None, "a"), (2, 5, " "), (3, 7, "b")], "id long, n int, t string")
    assert rows(table.filter(queue.unset("n")), "id") == [(1,)]
    assert rows(queue.filled_of_first(table, [F.col("id")], 2, "t"), "id") == [(1,)]
    assert [r[0] for r in table.select(queue.status_text(F.lit("incomplete"), F.col("n"), F.lit(2))).collect()][:2] == ["incomplete: expected unknown, extracted 2", "incomplete: expected 5, extracted 2"]
    assert rows(snapshots.store_fetch(table, spark.createDataFrame([(2, 9, "c")], "id long, n int, t string"), "id", {"t": F.lit("reset")})) == [(1, None, "a"), (2, 9, "reset"), (3, 7, "b")]
    assert rows(snapshots.filled(table, spark.createDataFrame([(1, 4), (2, 4)], "id long, n int"), "id", "n"), "id", "n") == [(1, 4), (2, 5), (3, 7)]
    with pytest.raises(ValueError, match="empty"):
        snapshots.must_match(table, spark.createDataFrame([], "n string, i int"), "t", "n", "i")
    nodes = spark.createDataFrame([(1, 1, None), (1, 2, 1), (1, 3, 1)], "doc long, ordinal int, parent_ordinal int")
    assert rows(tree.children(nodes, "doc")) == [(1, 1, 2), (1, 1, 3)]
    uris = knowledge.provision_uris(spark.createDataFrame([(1, 1, None, None), (1, 2, 1, "x"), (1, 3, 1, "x"), (1, 4, 3, "")], "doc long, ordinal int, parent_ordinal int, anchor string"), "doc", F.lit("u"))
    assert rows(uris, "ordinal", "uri", "parent_uri") == [(1, "u#n1", None), (2, "u#x", "u#n1"), (3, "u#x-3", "u#n1"), (4, "u#n4", "u#x-3")]
    c = lambda x: spark.range(1).select(x.alias("x")).first().x
    assert c(scalars.section_number(F.lit("12A. Text"))) == "12A" and c(scalars.without_section_number(F.lit("12A. Text"))) == "Text"
    assert c(scalars.subsection_number(F.lit("—(2) Text"))) == "2" and c(scalars.without_marker(F.lit("—(2) Text"))) == "Text"


def test_batches_and_windows(spark, tmp_path):
    source, check, target = (str(tmp_path / x) for x in ("in", "check", "out"))
    make = lambda ids: spark.createDataFrame([(i, "a" if i % 2 else "b") for i in ids], "id long, kind string").withColumn("at", F.timestamp_seconds(F.lit(1_600_000_000) + F.col("id") * 3600))
    make(range(48)).write.parquet(source)
    stream = lambda: spark.readStream.schema("id long, kind string, at timestamp").parquet(source)
    write = lambda df, n: df.write.mode("overwrite").parquet(f"{target}/batch={n}")
    discovery.apply_batches(stream(), check, write)
    discovery.apply_batches(stream(), check, write)
    make([100]).write.mode("append").parquet(source)
    discovery.apply_batches(stream(), check, write)
    assert sorted(r.id for r in spark.read.parquet(target).collect()) == [*range(48), 100]
    got = discovery.counts_by_window(make(range(48)), "at", "kind").collect()
    assert sum(r.n for r in got) == 48 and {r.kind for r in got} == {"a", "b"} and len({r.start for r in got}) == 3


def test_splits_and_texts(spark, tmp_path):
    for k, name in enumerate(("train", "validation", "test")):
        spark.range(k + 1).write.parquet(f"{tmp_path}/{name}")
    assert {r.split: r["count"] for r in landing.splits(spark, str(tmp_path)).groupBy("split").count().collect()} == {"train": 1, "validation": 2, "test": 3}
    c = lambda x: spark.range(1).select(x.alias("x")).first().x
    assert c(scalars.title_case(F.lit("fetch_failed"))) == "Fetch Failed"
    assert c(scalars.render(F.lit("s 1"), F.lit("Aim"), F.lit("Text"))) == "s 1 Aim\nText" and c(scalars.render(F.lit("s 1"), F.lit(None).cast("string"), F.lit(""))) == "s 1"


def test_counts_from_levels_of_many_shapes(spark):
    nodes = spark.createDataFrame([(1, k + 1, level) for k, level in enumerate([1, 2, 3, 3, 2, 1, 3])] + [(2, 1, 1)], "doc long, ordinal long, level int")
    got = rows(tree.counts_from_levels(nodes, "doc"), "doc", "ordinal", "descendant_count", "parent_ordinal")
    assert got == [(1, 1, 4, None), (1, 2, 2, 1), (1, 3, 0, 2), (1, 4, 0, 2), (1, 5, 0, 1), (1, 6, 1, None), (1, 7, 0, 6), (2, 1, 0, None)]
    assert tree.counts_from_levels(nodes.limit(0), "doc").collect() == []


def test_overlaps_across_bins(spark):
    spans = [(1, i, float(a), float(b)) for i, (a, b) in enumerate([(0, 30), (5, 6), (9.5, 10), (10, 20), (30, 31), (29, 45), (7, 7), (-5, 0.5)])] + [(2, 99, 0.0, 50.0), (None, 98, 0.0, 1.0)]
    table = spark.createDataFrame(spans, "k long, id long, a double, b double")
    brute = {i: sum(k is not None and k == q and i != j and a < d and b > c and a < b and c < d for q, j, c, d in spans) for k, i, a, b in spans}
    for width in (1.0, 7.0, 1000.0):
        assert dict(rows(knowledge.spans_that_overlap(table, "k", "id", "a", "b", width))) == brute


def test_parents_take_the_last_state_that_a_fetch_sets(spark):
    versions = spark.createDataFrame([(1, 9, "success", "h", "complete", 1, 1, False, True), (2, 9, None, None, "not_parsed", None, None, False, False), (3, 8, None, None, "not_parsed", None, None, False, False)], "id long, act long, fetch string, html string, parse string, expected int, extracted int, needs_review boolean, promoted boolean")
    parents = spark.createDataFrame([(9, "complete"), (8, "discovered"), (7, "discovered")], "id long, status string")
    fetched = [(1, 1, "error", None, None, None), (1, 2, "success", "n", 3, 3), (2, 3, "success", "m", 2, 1), (99, 4, "error", None, None, None)]
    kept, states = knowledge.store_fetches(versions, parents, spark.createDataFrame(fetched, "id long, nth int, fetch string, html string, expected int, extracted int"), "act")
    assert rows(kept, "id", "fetch", "html", "parse", "needs_review", "promoted") == [(1, "success", "n", "not_parsed", False, False), (2, "success", "m", "not_parsed", True, False), (3, None, None, "not_parsed", False, False)]
    assert rows(states) == [(7, "discovered"), (8, "discovered"), (9, "needs_review")]


def test_features_of_tasks(spark):
    table = spark.createDataFrame([("t", "p", "r2", ["x", "odd"], ["a"], None), ("u", None, "none", None, None, ["y"])], "text string, previous_text string, role string, topics array<string>, concepts array<string>, concept_topics array<string>")
    of = lambda task, *names: [tuple(r) for r in labels.features(table, task, ["r1", "r2"], ["x", "y"], {"a": ["x"], "b": ["y", "odd"], "c": []}).select("text", *names).orderBy("text").collect()]
    assert of("role", "input", "role_id") == [("t", "t\n\nPrevious: p", 1), ("u", "u", -100)]
    assert of("topics", "input", "label_targets") == [("t", "t", [1, 0]), ("u", "u", [0, 0])]
    assert of("concepts", "input", "label_targets", "label_mask") == [("t", "Topics: x; odd\n\nt", [1, 0, 0], [1, 0, 0]), ("u", "Topics: y\n\nu", [0, 0, 0], [0, 0, 0])]
    with pytest.raises(ValueError, match="no such task"):
        labels.features(table, "other", [], [], {})


def test_strict_dates_and_lists(spark):
    c = lambda x: spark.range(1).select(x.alias("x")).first().x
    assert c(scalars.compact_date(F.lit("20230230"))) is None and c(scalars.compact_date(F.lit("x"), strict=True)) is None and str(c(scalars.compact_date(F.lit("20230228"), strict=True))) == "2023-02-28"
    with pytest.raises(Exception, match="no such date: 20230230"):
        c(scalars.compact_date(F.lit("20230230"), strict=True))
    assert c(scalars.strings(F.lit('["a", 1, null, "b", ["c"]]'))) == ["a", "b"] and c(scalars.strings(F.lit("7"))) == c(scalars.strings(F.lit(None).cast("string"))) == []
    assert c(scalars.strings(F.lit('["a"]'), strict=True)) == ["a"] and c(scalars.strings(F.lit("[]"), strict=True)) == []
    for odd in ('["a", 1]', '{"a": 1}', None):
        with pytest.raises(Exception, match="no list of texts"):
            c(scalars.strings(F.lit(odd).cast("string"), strict=True))
