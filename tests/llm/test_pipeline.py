"""The corpus pipeline, each stage against brute force on its own input."""

import os
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from casemill.llm import decontam, near_dedup, toxicity
from casemill.llm.shared import materialize
from test_free import brute_components

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = [("documents", docs)]
    for name, stage in corpus_pipeline.STAGES:
        out.append((name, materialize(stage(spark, out[-1][1], FOLDER), "stage")))
    return dict(out)


def test_columns(steps):
    assert [s for s, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "decontamination", "mixing", "token_output"]
    assert all(steps[s].columns == steps["documents"].columns for s in ("toxicity", "near_dedup", "decontamination", "mixing"))


def test_toxic_documents_go(spark, steps):
    docs, labels = steps["documents"], spark.read.parquet(f"{FOLDER}/labels.parquet")
    want = [r.doc_id for r in toxicity.score(docs, toxicity.learn(docs, labels)).filter("predicted = 0").collect()]
    assert sorted(r.doc_id for r in steps["toxicity"].collect()) == sorted(want)
    assert steps["toxicity"].exceptAll(docs).count() == 0


def test_one_of_each_group_stays(steps):
    before = sorted(steps["toxicity"].collect(), key=lambda r: r.doc_id)
    want = [before[i].doc_id for i, _, _, kept in brute_components([r.text for r in before]) if kept]
    assert sorted(r.doc_id for r in steps["near_dedup"].collect()) == want


def test_benchmark_passages_go(spark, steps):
    words = lambda t: re.findall(r"[^\s]+", t.lower())
    parts = lambda t: {tuple(w[i : i + 5]) for w in [words(t)] for i in range(len(w) - 4)}
    items = [parts(r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    held = lambda t: any(len(i & parts(t)) >= 0.75 * len(i) for i in items if i)
    left = {r.doc_id for r in steps["decontamination"].collect()}
    assert left == {r.doc_id for r in steps["near_dedup"].collect() if not held(r.text)}


def test_sources_meet_their_targets(steps):
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    before, after = steps["decontamination"].collect(), steps["mixing"].collect()
    total, weights = Counter(), {}
    for r in before:
        total[r.source] += size(r.text)
    for i, s in enumerate(sorted(total)):
        weights[s] = (5, 2, 1)[i % 3]
    target, open_ = {}, set(total)
    while True:
        left = sum(total.values()) - sum(target.values())
        share = {s: left * weights[s] / sum(weights[x] for x in open_) for s in open_}
        full = {s for s in open_ if share[s] > 3 * total[s]}
        if not full:
            break
        target |= {s: 3 * total[s] for s in full}
        open_ -= full
    target |= share
    got, copies = Counter(), Counter(r.doc_id for r in after)
    for r in after:
        got[r.source] += size(r.text)
    assert max(copies.values()) <= 3 and set(copies) <= {r.doc_id for r in before}
    # Documents are whole: a source misses its target by part of one at most.
    most = {s: max(size(r.text) for r in before if r.source == s) for s in total}
    assert all(abs(got[s] - target[s]) <= most[s] for s in total)


def test_tokens_follow_each_other(steps):
    rows = sorted(steps["token_output"].collect(), key=lambda r: r.start)
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in steps["mixing"].collect())
    at = 0
    for r in rows:
        assert r.start == at
        at += r.n_tokens
    assert [r.doc_id for r in rows] == sorted(r.doc_id for r in rows)


#: Names that the stages use themselves, and one that needs quoting.
CLASHES = ("key_id", "key_hash", "its_id", "its_hash", "mix_position", "row", "uid", "part", "n", "band", "set_key", "g_part", "text_hash", "position", "copies", "size", "before", "score", "predicted", "held", "toxic", "fit", "window", "a.b")


def odd_documents(spark):
    """Documents with nulls, repeated rows, few words, and columns whose names clash."""
    long = "Many words of a very long text " * 20_000
    texts = [(1, "a b c", "x"), (1, "a b c", "x"), (2, "a b", None), (3, None, "x"), (3, None, "x"), (4, "", "y"), (None, "one two three four five six", "y"), (None, "one two three four five six", "y"), (6, long, "x"), (7, "a", "y"), (7, "another text of one id", "y")]
    names = ", ".join(f"`{c}` long" for c in CLASHES)
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), *range(777 + 100 * k, 777 + 100 * k + len(CLASHES))) for k, (i, t, s) in enumerate(texts)], f"doc_id long, text string, lang string, source string, n_chars long, {names}")


def as_tuples(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize("name", ["toxicity", "near_dedup", "decontamination", "mixing"])
def test_stages_keep_other_columns(spark, name):
    docs, stage = odd_documents(spark), dict(corpus_pipeline.STAGES)[name]
    out = stage(spark, docs, FOLDER)
    assert out.columns == docs.columns
    before, after = as_tuples(docs), as_tuples(out)
    assert set(after) <= set(before)
    if name == "near_dedup":
        # Of rows of one id and text one stays, whichever; rows without words all stay.
        assert Counter(r[:2] for r in after.elements()) == Counter({(1, "a b c"): 1, (2, "a b"): 1, (3, None): 2, (4, ""): 1, (None, "one two three four five six"): 1, (6, docs.filter("doc_id = 6").first().text): 1, (7, "a"): 1, (7, "another text of one id"): 1})
    elif name == "mixing":
        assert max(after.values()) <= 3
    else:
        assert after == before
    empty = stage(spark, docs.limit(0), FOLDER)
    assert empty.columns == docs.columns and empty.collect() == []


def test_tokens_of_odd_documents(spark):
    docs = odd_documents(spark)
    got = dict(corpus_pipeline.STAGES)["token_output"](spark, docs, FOLDER).collect()
    assert Counter(r.doc_id for r in got) == Counter(r.doc_id for r in docs.collect()) and all(r.n_tokens >= 1 for r in got)
    assert dict(corpus_pipeline.STAGES)["token_output"](spark, docs.limit(0), FOLDER).collect() == []


@pytest.mark.parametrize("text", ["a", "a b", "a b c", "a b c d", "a b c d e"])
def test_one_tiny_document_and_item(spark, text):
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert [(r.n_shingles, r.component_id) for r in near_dedup.near_dedup(docs).collect()] == [(1, 1)]
    item = spark.createDataFrame([(5, text)], "item_id long, text string")
    assert [r.item_ids for r in decontam.decontaminate(docs, item).collect()] == [[5]]
    assert [r.contaminated for r in decontam.decontaminate(docs, item.withColumn("text", F.lit("z y x"))).collect()] == [False]


def test_run_leaves_results_and_shards_only(spark, steps):
    shared = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(shared))
    out = corpus_pipeline.run(spark, FOLDER)
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, steps["token_output"].collect()))
    assert sorted(n.rsplit("-", 1)[0] for n in set(os.listdir(shared)) - before) == ["stage-token_output", "tokens"]


def test_reading_stored_tables_keeps_no_buffers_outside_the_heap(spark):
    beans = spark._jvm.java.lang.management.ManagementFactory.getPlatformMXBeans(spark._jvm.java.lang.Class.forName("java.lang.management.BufferPoolMXBean"))
    direct = next(b for b in beans if b.getName() == "direct")
    noise = F.unhex(F.concat(*(F.sha2(F.concat("id", F.lit(f" {k}")), 512) for k in range(8))))
    long = spark.range(0, 48_000, 1, 1).select("id", noise.alias("noise"))
    stored = materialize(long, "noise", compression="uncompressed")
    before = direct.getMemoryUsed()
    for _ in range(2):
        assert stored.agg(F.sum(F.octet_length("noise"))).first()[0] == 48_000 * 512
        again = materialize(stored.filter("length(noise) > 0"), "noise", compression="uncompressed")
        assert again.agg(F.sum(F.octet_length("noise"))).first()[0] == 48_000 * 512
    assert direct.getMemoryUsed() - before < 10 << 20
    assert spark.conf.get("parquet.hadoop.vectored.io.enabled", None) is None
