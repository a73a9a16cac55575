"""Line dedup, hard negatives and lexical search against brute force and on odd tables."""

import hashlib
import math
import os
import re
import subprocess
import sys
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from casemill.llm import hard_negatives, heaps, lexical, line_dedup

REPO = str(Path(__file__).resolve().parents[2])
LONG = "a line of more than forty code points, number"


def brute_lines(docs, points=40, least=5):
    key = lambda x: re.sub("[A-Z]", lambda m: m[0].lower(), x.strip(" \t\n\x0b\x0c\r"))
    rank = lambda i: -1 if i is None else i
    held = {}
    for at, (i, text) in enumerate(docs):
        for k in {key(x) for x in (text or "").split("\n")}:
            if len(k) >= points:
                held.setdefault(k, []).append((rank(i), at))
    top = {k: max(v)[0] for k, v in held.items() if len(v) >= least}
    out = []
    for i, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key(x) not in top or top[key(x)] == rank(i)]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


def line_rows(found):
    return rows(found.select("doc_id", "n_lines", "n_dropped", F.sha2(F.array_join("lines", "\n"), 256).alias("kept_sha256")))


def line_docs():
    rng = np.random.default_rng(3)
    lines = [f"{LONG} {k % 7} É{'x' * (k % 3)}" for k in range(12)] + ["short", "", f"  {LONG} 3 É \t", f"{LONG.upper()} 3 É", "z" * 39, "z" * 40]
    docs = [(i, "\n".join(rng.choice(lines, int(rng.integers(0, 9))))) for i in range(60)]
    return [*docs, (60, None), (61, ""), (62, "\n"), (63, f"{LONG} 1 É\r\n{LONG} 1 É"), (63, f"{LONG} 1 É"), (None, f"{LONG} 1 É\nonly"), (None, f"{LONG} 2 Éx"), (7, "z" * 40), (64, "\n".join(lines * 2000))]


@pytest.mark.parametrize(("batches", "fan", "few"), [(1, 2, True), (4, 2, True), (7, 3, False)])
def test_line_dedup_against_brute_force(spark, monkeypatch, batches, fan, few):
    if not few:
        monkeypatch.setattr(line_dedup, "small", lambda df: df)
    monkeypatch.setattr(line_dedup.LineRuns.__init__, "__defaults__", (fan,))
    docs = line_docs()
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, hash string, pos int")
    assert line_rows(line_dedup.line_dedup(df, batches=batches)) == brute_lines(docs)


def test_line_dedup_of_ids_and_tables_of_odd_kinds(spark):
    df = spark.createDataFrame([(None, f"{LONG}\na")] * 6, "doc_id long, text string")
    assert {r.n_dropped for r in line_dedup.line_dedup(df).collect()} == {0}
    assert line_dedup.line_dedup(df.limit(0)).collect() == []
    assert set(line_dedup.line_dedup(df).select("row.*").columns) == {"doc_id", "text"}


def test_runs_hold_each_hash_once_on_few_levels(spark):
    store = line_dedup.LineRuns(spark, fan=2)
    seen = set()
    for k in range(6):
        batch = [(bytes([x]), 100 - k) for x in range(k * 3, k * 3 + 9)]
        df = spark.createDataFrame(batch, "hash binary, top_id long")
        assert {bytes(r.hash) for r in store.unseen(df).collect()} == {h for h, _ in batch} - seen
        seen |= {h for h, _ in batch}
        store.add(df)
        assert all(len(level) < 2 for level in store.levels)
    found = [(bytes(r.hash), r.top_id) for r in store.all().collect()]
    assert len(found) == len(seen) == len({h for h, _ in found}) and dict(found)[bytes([11])] == 99
    store.drop()
    with pytest.raises(ValueError, match="two runs"):
        line_dedup.LineRuns(spark, fan=1)


def test_hilbert_neighbours_differ_in_one_step():
    for n, bits in ((2, 3), (3, 2), (1, 4), (4, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * n), -1).reshape(-1, n)
        order = np.argsort(hard_negatives.hilbert(cells, bits))
        assert sorted(hard_negatives.hilbert(cells, bits).tolist()) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[order].astype(int), axis=0)).sum(1) == 1).all()


def brute_negatives(table, k=5, m=10):
    good = [(i, lab, [math.floor(256 * x) for x in v]) for i, lab, v in table if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, lab, v in (r for r in good if r[0] % 100 == 0):
        scored = sorted(((-sum(x * y for x, y in zip(v, w)), i, g) for i, g, w in good if i != a))
        for p, pid, _ in [s for s in scored if s[2] == lab][:k]:
            fits = [(s, i) for s, i, g in scored if g != lab and 30 * -p <= 100 * -s <= 90 * -p][:m]
            out += [(a, pid, rank, i, -p, -s) for rank, (s, i) in enumerate(fits, 1)]
    return sorted(out)


@pytest.mark.parametrize("block", [3, 64])
def test_hard_negatives_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(hard_negatives, "BLOCK", block)
    rng = np.random.default_rng(1)
    # Numbers of few values: many ties. Shorter vectors and odd ones too.
    table = [(i, int(rng.integers(0, 3)), [float(x) / 4 for x in rng.integers(-3, 4, 6)]) for i in range(310)]
    table += [(400, 1, [0.5, 0.25]), (500, 2, []), (600, 1, [0.5, None, 1.0]), (700, None, [1.0]), (800, 1, None), (900, 1, [math.nan] * 6), (1000, 1, [math.inf] * 6), (None, 1, [1.0] * 6), (301, 2, [0.5] * 6), (1100, 9, [1.0] * 6)]
    df = spark.createDataFrame([(*r, "x", 1) for r in table], "vec_id long, label int, embedding array<float>, key string, id int")
    got = hard_negatives.hard_negatives(df, F.col("vec_id") % 100 == 0)
    assert rows(got) == sorted(brute_negatives([(i, lab, v and [x if x is None else float(np.float32(x)) for x in v]) for i, lab, v in table]), key=repr)
    assert hard_negatives.hard_negatives(df, F.col("vec_id") == -1).collect() == hard_negatives.hard_negatives(df.limit(0), F.lit(True)).collect() == []


def test_hard_negatives_of_large_numbers_and_far_blocks(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "BLOCK", 8)
    rng = np.random.default_rng(4)
    large = [(i, i % 2, [float(rng.integers(0, 1 << 20)) * 2.0, 1.0]) for i in range(40)]
    df = spark.createDataFrame(large, "vec_id long, label int, embedding array<double>")
    assert rows(hard_negatives.hard_negatives(df, F.col("vec_id") % 100 == 0)) == sorted(brute_negatives(large), key=repr)
    # Groups far from each other, in many blocks.
    apart = np.zeros((400, 4))
    apart[np.arange(400), np.arange(400) // 100] = 1 + rng.random(400) / 8
    table = [(i, i % 3, apart[i].tolist()) for i in range(400)]
    found = hard_negatives.hard_negatives(spark.createDataFrame(table, "vec_id long, label int, embedding array<double>"), F.col("vec_id") % 100 == 0)
    assert rows(found) == sorted(brute_negatives(table), key=repr)


def test_blocks_are_skipped_by_their_zones(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(hard_negatives, "BLOCK", 10)
    vectors = np.zeros((100, 2))
    vectors[:50, 0], vectors[50:, 1] = np.arange(50) + 256, np.arange(50) + 256
    df = spark.createDataFrame([(i, 0, v.tolist(), i) for i, v in enumerate(vectors)], "id long, label long, vector array<double>, key long").coalesce(1).sortWithinPartitions("key")
    files = [tuple(r) for r in hard_negatives._write_blocks(df, 2, str(tmp_path)).collect()]
    want = np.array([[300.0, 0.0]])
    wanted = lambda first, last, least, most: most >= 256.0 * 300
    got = [i for _, ids, _, score in hard_negatives.Blocks(files, 2).visit(0, want, wanted) for i in ids]
    assert sorted(got) == list(range(50))


def test_heaps_keep_the_best_of_each_slot():
    rng = np.random.default_rng(2)
    heap, offered = heaps.TopK(5, 3, least=2), []
    for _ in range(50):
        slot, score, ids = rng.integers(0, 5, 30), rng.integers(0, 9, 30), rng.integers(0, 40, 30)
        fits = score >= heap.floor[slot]
        offered += list(zip(slot, score, ids))
        heap.offer(slot[fits], score[fits], ids[fits])
        heap.settle()
    want = [x for s in range(5) for x in sorted((x for x in offered if x[0] == s and x[1] >= 2), key=lambda x: (-x[1], x[2]))[:3]]
    assert list(zip(heap.slot, heap.score, heap.id)) == want


def brute_ranks(docs, items, k=10):
    terms = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    counted = [(i, Counter(terms(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n_docs, total = len(counted), sum(c.total() for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c in counted:
            m = 100 - 75 + (75 * c.total() * n_docs) // total
            s = sum(times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m)) for t, times in Counter(terms(text)).items() if c[t])
            if s > 0:
                scores.append((-s, i is None, i))
        out += [(item, rank, i, -s) for rank, (s, _, i) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)]
    return sorted(out, key=repr)


DOCS = [(i, " ".join(f"w{(i * j) % 23}" for j in range(i % 19))) for i in range(150)] + [(150, None), (151, ""), (152, "- . !"), (153, "ÉA éa W3-w3_W3 w5"), (153, "w5"), (None, "w5 w5 w7"), (155, "w3 " * 300_000), (156, "w5"), (157, "x" * 2_000_000 + " w4")]
ITEMS = [(1, "w3 W5 é w3"), (2, "w5"), (3, "nothing here"), (4, None), (5, ""), (2, "w5"), (None, "w7 éa"), (7, " ".join(f"w{j}" for j in range(23)))]


@pytest.mark.parametrize(("slice_bytes", "cells"), [(16 << 20, 1 << 20), (60, 50)])
def test_lexical_ranks_against_brute_force(spark, monkeypatch, slice_bytes, cells):
    monkeypatch.setattr(lexical, "SLICE_BYTES", slice_bytes)
    monkeypatch.setattr(lexical, "CELLS", cells)
    monkeypatch.setattr(lexical, "PIECE", 1000)
    docs = spark.createDataFrame([(*d, "x", 1) for d in DOCS], "doc_id long, text string, item string, score int").repartition(5)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert rows(lexical.rank_documents(docs, items)) == brute_ranks(DOCS, ITEMS)
    assert lexical.rank_documents(docs.limit(0), items).collect() == lexical.rank_documents(docs, items.limit(0)).collect() == []


def test_lexical_scores_beyond_doubles_are_exact(spark):
    docs, items = [(i, "rare common" if i == 3 else "common other") for i in range(9)], [(1, "rare " * 2_000_000 + "common")]
    found = rows(lexical.rank_documents(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")))
    assert found == brute_ranks(docs, items) and found[0][3] > 1 << 50


def test_queries_run_from_another_folder(tmp_path):
    script = tmp_path / "elsewhere.py"
    script.write_text(
        f"import sys\nsys.path.insert(0, {REPO!r})\nimport __spark_entry__ as e\nfrom pyspark.sql import SparkSession\n"
        "spark = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').config('spark.sql.shuffle.partitions', '2').getOrCreate()\n"
        "from casemill.llm import toxicity\n"
        "docs = spark.createDataFrame([(i, 'grub a b' if i % 2 else 'good c d') for i in range(80)], 'doc_id long, text string')\n"
        "labels = spark.createDataFrame([(i, i % 2) for i in range(80)], 'doc_id long, toxic int')\n"
        "print('scored', toxicity.score(docs, toxicity.learn(docs, labels)).filter('predicted = doc_id % 2').count())\n"
    )
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"} | {"PYSPARK_PYTHON": sys.executable}, capture_output=True, text=True, timeout=300)
    assert "scored 80" in done.stdout, done.stderr[-2000:]
