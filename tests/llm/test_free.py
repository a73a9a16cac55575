"""The other operators against brute force, round trips and held-out data."""

import hashlib
import io
import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest import rows

from casemill.llm import chat_repair, decontam, files, interpolation, near_dedup, token_output, toxicity, warc, words
from casemill.llm.components import components
from casemill.llm.shared import new_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


class File(io.BytesIO):
    def size(self):
        return len(self.getvalue())


def docs(spark, texts):
    """Documents with ids from 0, and columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, "x", 1, "y") for i, t in enumerate(texts)], "doc_id long, text string, uid string, n int, window string")


ODD = [None, "", "  \n", "a", "a b", "A B", "one two three four five", "one two three four five six", "É É É", "x" * 100_000, "w " * 30_000]


# Words


def test_words_of_slices():
    texts = [*ODD, "  lead", "trail \x0b", "nbsp\u00a0in"] * 3
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    for limit in (1, 1000, 10**9):
        got = []
        for part in words.slices(iter([batch.slice(2)]), "text", limit):
            begins, codes, different = words.split(part.column("text"), True)
            spelt = different.to_pylist()
            got += [[spelt[c] for c in codes[a:b]] for a, b in itertools.pairwise(begins)]
        assert got == [WORD.findall((t or "").translate(LOWER)) for t in texts[2:]]


@pytest.mark.parametrize("total", range(8))
def test_windows_of_few_words(total):
    whole = words.hashes(pa.array([f"w{k}" for k in range(20)], pa.large_string()))
    found, counts = words.windows(whole[:total], np.array([0, total]), 5)
    assert counts.tolist() == [max(total - 4, int(total > 0))] and len(found) == counts.sum()
    more, more_counts = words.windows(np.concatenate([whole[10:], whole[:total], whole[10:]]), np.array([0, 10, 10 + total, 20 + total]), 5)
    assert (more[6 : 6 + len(found)] == found).all() and more_counts[1] == counts[0]


# 1


def test_warc_round_trip(spark):
    long = "<p>" + "é" * 200
    pages = [(3, "http://a b\n", long), (1, "u", long), (2, None, "short"), (5, "u", "short"), (4, "v", None), (None, "n", long), (None, "n", "alone " * 30), (7, "r", "x" * 99), (8, "r", "x" * 99), (9, "big", "y" * 3_000_000)]
    df = spark.createDataFrame([(*p, "d") for p in pages], "page_id long, url string, html string, digest string")
    archives = warc.write_warc(df, new_path(spark, "t"))
    got = [(r.fields.get("x-page-id"), r.fields["warc-type"], r.fields.get("x-refers-to-page-id"), bytes(r.payload)) for r in warc.read_warc(archives).collect() if r.gap is None]
    full = {"3": ("revisit", "1", b""), "1": ("response", None, long.encode()), "2": ("response", None, b"short"), "5": ("response", None, b"short"), "4": ("response", None, b""), "7": ("response", None, b"x" * 99), "8": ("response", None, b"x" * 99), "9": ("response", None, b"y" * 3_000_000)}
    assert {i: x for i, *x in got if i} == {k: list(v) for k, v in full.items()}
    assert sorted(x[:2] for i, *x in got if not i) == [["response", None], ["revisit", "1"]]
    assert warc.write_warc(df.limit(0), new_path(spark, "t")).count() == 0


def test_damaged_archives_lose_their_record_only(spark):
    df = spark.createDataFrame([(i, f"u{i}", f"page {i} " * 200) for i in range(40)], "page_id long, url string, html string").coalesce(1)
    archives = warc.write_warc(df, new_path(spark, "t"))
    [path] = [r.path for r in archives.collect()]
    with files.open_at(path, "r") as f:
        whole = f.read()
        ends = [end for _, end, fields, _ in warc.salvage(File(whole)) if fields]
    hurt = bytearray(whole[: ends[-1] - 9])
    hurt[ends[9] + 60] ^= 255
    with files.open_at(path, "w") as f:
        f.write(bytes(hurt))
    pages, gaps = warc.pages_of(archives)
    assert sorted(r.page_id for r in pages.collect()) == [i for i in range(39) if i != 10]
    assert [(r.begin, r.end) for r in gaps.orderBy("begin").collect()] == [(ends[9], ends[10]), (ends[38], ends[39] - 9)]
    assert {r.lost_bytes for r in pages.collect()} == {ends[10] - ends[9] + ends[39] - 9 - ends[38]}


@pytest.mark.parametrize("packed", [True, False])
def test_salvage(packed):
    parts = []
    for i in range(6):
        payload = bytes(np.random.default_rng(i).integers(0, 256, 4000, np.uint8))
        member = warc.record(i, "u", payload, hashlib.sha256(payload).hexdigest(), None)
        parts.append(member if packed else zlib.decompress(member, 31))
    whole = b"".join(parts)
    ids = lambda data: [(b, e, f and f.get("x-page-id")) for b, e, f, _ in warc.salvage(File(data))]
    ends = np.cumsum([len(p) for p in parts])
    assert ids(whole) == [(e - len(p), e, str(i)) for i, (p, e) in enumerate(zip(parts, ends))]
    hurt = bytearray(whole)
    hurt[ends[1] + 2000] ^= 255
    assert ids(bytes(hurt)) == [(0, ends[0], "0"), (ends[0], ends[1], "1"), (ends[1], ends[2], None), *((ends[i - 1], ends[i], str(i)) for i in (3, 4, 5))]
    junk = b"junk\x1f\x8b\x08WARC/1." + whole[: ends[0]] + b"more" + whole[ends[0] : ends[1] - 7]
    assert [x[2] for x in ids(junk)] == [None, "0", None] and ids(b"") == []
    found = list(warc.salvage(File(junk)))
    assert found[0][0] == 0 and all(a[1] == b[0] for a, b in itertools.pairwise(found)) and found[-1][1] == len(junk)


# 2


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute_components(texts):
    sets = [shingles(t) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(texts)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= 75 * len(sets[i] | sets[j]):
            a, b = sorted((find(i), find(j)))
            root[b] = a
    return [(i, len(sets[i]), find(i), find(i) == i) for i in range(len(texts))]


def test_near_dedup_against_brute_force(spark):
    rng = np.random.default_rng(5)
    base = [f"w{k}" for k in rng.integers(0, 3000, 150)]
    texts = list(ODD) + [" ".join(f"z{k}" for k in rng.integers(0, 3000, 40)) for _ in range(40)]
    for _ in range(120):  # copies of one text, changed a little or much, and copies of copies
        w = list(base) if rng.random() < 0.6 or len(texts) < 60 else texts[int(rng.integers(51, len(texts)))].split()
        for at in rng.integers(0, len(w), int(rng.integers(0, 12))):
            w[at] = f"n{rng.integers(0, 10**6)}"
        texts.append(" ".join(w))
    texts += texts[60:70]
    got = near_dedup.near_dedup(docs(spark, texts))
    assert rows(got, "doc_id", "n_shingles", "component_id", "kept") == sorted(brute_components(texts), key=repr)
    left = near_dedup.one_of_each(docs(spark, texts))
    assert left.columns == ["doc_id", "text", "uid", "n", "window"]
    assert sorted(r.doc_id for r in left.collect()) == [i for i, _, _, kept in brute_components(texts) if kept]
    assert near_dedup.near_dedup(docs(spark, ["a"]).limit(0)).collect() == []


def test_near_dedup_with_null_and_repeated_ids(spark):
    df = spark.createDataFrame([(None, "a b c d e f"), (None, None), (5, "a b c d e f"), (5, "a b c d e f"), (6, None), (6, None)], "doc_id long, text string")
    got = Counter((r.doc_id, r.component_id, r.kept) for r in near_dedup.near_dedup(df).collect())
    assert got == Counter({(None, 5, False): 1, (None, None, True): 1, (5, 5, True): 2, (6, 6, True): 2})
    assert Counter(r.doc_id for r in near_dedup.one_of_each(df).collect()) == Counter({None: 1, 5: 1, 6: 2})


def test_registers_estimate_and_merge():
    rng = np.random.default_rng(1)
    pool = words.mix(rng.integers(0, 2**63, 4000, dtype=np.uint64))
    a, b = np.sort(pool[:2400]), np.sort(pool[600:3000])
    regs = near_dedup.registers(np.concatenate([a, b, np.union1d(a, b)]), np.array([0, 2400, 4800]))
    assert (np.maximum(regs[0], regs[1]) == regs[2]).all()
    found = near_dedup.likely_similarity(regs[:1], regs[1:2], np.array([2400.0]), np.array([2400.0]))[0]
    assert abs(found - 1800 / 3000) < 0.15


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7)], "a long, b long")
    assert rows(components(edges)) == sorted([(i, 0) for i in range(1, 41)] + [(101, 100)], key=repr)
    assert components(edges.limit(0)).collect() == []


# 4


def test_token_output_round_trip(spark):
    from tokenizers import Tokenizer

    texts = ["Hello, hello world. the the the", None, "", "é É ß <|endoftext|> x", "2,000 km!?", "a\u0301 ﬁ İstanbul", " ".join(["repeat these words"] * 5000), "Ünï.", "don't 'tis"]
    tokenizer = Tokenizer.from_file(token_output.tokenizer_path())
    folder = new_path(spark, "t")
    df = spark.createDataFrame([(9 - i, t, 7) for i, t in enumerate(texts)] + [(None, "null id", 7), (3, "same id", 7)], "doc_id long, text string, start int")
    shards = token_output.write_shards(df, token_output.tokenizer_path(), folder, shard_ids=50)
    got = sorted(token_output.read_shards(shards, with_ids=True).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None, 1, 2, 3, 3, 4, 5, 6, 7, 8, 9]
    at = 0
    for r in got:
        want = [tokenizer.encode(t or "", add_special_tokens=False).ids + [2] for i, t, _ in map(tuple, df.collect()) if i == r.doc_id]
        assert r.ids in want and r.start == at and r.n_tokens == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        at += r.n_tokens
    assert token_output.write_shards(df.limit(0), token_output.tokenizer_path(), folder).count() == 0
    with files.open_at(shards.first().path, "r") as f, pytest.raises(ValueError, match="whole"):
        token_output.Shard(f.read()[:-1])


def test_token_output_ends_a_shard_with_the_document_that_fills_it(spark):
    sizes = [i % 7 + 1 for i in range(300)]
    df = spark.createDataFrame([(i, "word " * (n - 1)) for i, n in enumerate(sizes)], "doc_id long, text string").coalesce(1)
    shards = token_output.write_shards(df, token_output.tokenizer_path(), new_path(spark, "t"), shard_ids=20)
    rows = sorted(map(tuple, shards.select("part_no", "shard_no", "n_ids").collect()))
    last = {part: no for part, no, _ in rows}
    assert all(20 <= n < 20 + 7 for part, no, n in rows if no < last[part]) and all(n < 20 + 7 for _, _, n in rows)
    got = token_output.read_shards(shards).orderBy("doc_id").collect()
    assert [(r.doc_id, r.start, r.n_tokens) for r in got] == [(i, sum(sizes[:i]), n) for i, n in enumerate(sizes)]


def test_a_task_gives_back_its_memory_at_its_end(monkeypatch):
    done = []
    monkeypatch.setattr(words, "give_back", lambda: done.append("given"))
    assert list(words.lean(lambda batches: (b + 1 for b in batches))([1, 2])) == [2, 3] and done == ["given"]


def test_token_output_starts_over_more_shards_than_partitions(spark):
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(batch)
    spark.conf.set(batch, "5")
    try:
        df = spark.createDataFrame([(i, "word " * (i % 7)) for i in range(200)], "doc_id long, text string")
        shards = token_output.write_shards(df, token_output.tokenizer_path(), new_path(spark, "t"), shard_ids=20).collect()
        got = token_output.read_shards(spark.createDataFrame(shards)).orderBy("doc_id").collect()
    finally:
        spark.conf.set(batch, before)
    assert len(shards) > 4 and len({s.part_no for s in shards}) > 1
    sizes = [i % 7 + 1 for i in range(200)]
    assert [(r.doc_id, r.start, r.n_tokens) for r in got] == [(i, sum(sizes[:i]), n) for i, n in enumerate(sizes)]


def test_grammar_and_random_access():
    rng = np.random.default_rng(3)
    parts = [np.concatenate([rng.integers(0, 9, int(rng.integers(1, 60))), [2]]) for _ in range(200)] + [np.full(500, 4), np.array([2])]
    ids, ends = np.concatenate(parts), np.cumsum([len(p) for p in parts])
    shard = token_output.Shard(token_output.pack(list(range(len(parts))), ids, ends, 10))
    assert (shard.all_ids() == ids).all() and len(shard.symbols) < 0.7 * len(ids)
    for k in (0, 7, 200, 201):
        assert (shard.document(k) == parts[k]).all()
        for a, b in ((0, 1), (0, len(parts[k])), (len(parts[k]) // 2, len(parts[k]))):
            assert (shard.some(k, a, b) == parts[k][a:b]).all()


def naive_grammar(seqs):
    """Symbols and rules that are left by replacing the most frequent pair again and again."""
    rules = 0
    while True:
        counts = Counter()
        for s in seqs:
            i = 0
            while i < len(s) - 1:
                counts[s[i], s[i + 1]] += 1
                i += 2 if s[i] == s[i + 1] and i + 2 < len(s) and s[i + 2] == s[i] else 1
        if not counts or counts.most_common(1)[0][1] < 2:
            return seqs, rules
        pair, new, rules = counts.most_common(1)[0][0], ("rule", rules), rules + 1
        for n, s in enumerate(seqs):
            out, i = [], 0
            while i < len(s):
                if tuple(s[i : i + 2]) == pair:
                    out.append(new)
                    i += 2
                else:
                    out.append(s[i])
                    i += 1
            seqs[n] = out


@pytest.mark.parametrize("kind", ["random", "phrases", "runs", "one", "long keys"])
def test_grammar_against_the_naive_one(kind):
    rng = np.random.default_rng(7)
    phrases = [rng.integers(0, 50, int(rng.integers(2, 30))) for _ in range(12)]
    make = {
        "random": lambda: rng.integers(0, 6, int(rng.integers(1, 80))),
        "phrases": lambda: np.concatenate([phrases[k] for k in rng.integers(0, 12, int(rng.integers(1, 6)))]),
        "runs": lambda: np.repeat(rng.integers(0, 3, 8), rng.integers(1, 9, 8)),
        "one": lambda: np.full(int(rng.integers(1, 50)), 3),
        "long keys": lambda: rng.integers(0, 4, int(rng.integers(1, 60))) * 400_000_000,
    }[kind]
    parts = [make() for _ in range(60)]
    ids, ends, first = np.concatenate(parts), np.cumsum([len(p) for p in parts]), int(max(p.max() for p in parts)) + 1
    seq, seq_ends, rules = token_output.compress(ids, ends, first)
    assert (token_output.expand(seq, rules, first) == ids).all() and len(seq_ends) == len(parts)
    left, n = naive_grammar([p.tolist() for p in parts])
    assert len(seq) + 2 * len(rules) <= 1.06 * (sum(map(len, left)) + 2 * n) + 4
    counts = Counter()
    for s in np.split(seq, seq_ends[:-1]):
        pairs, i = s.tolist(), 0
        while i < len(pairs) - 1:  # no pair is left that occurs twice without overlapping itself
            counts[pairs[i], pairs[i + 1]] += 1
            i += 2 if pairs[i : i + 3] == pairs[i : i + 1] * 3 else 1
    assert not counts or max(counts.values()) == 1
    for k in range(len(parts)):
        assert (token_output.expand(seq[seq_ends[k - 1] if k else 0 : seq_ends[k]], rules, first) == parts[k]).all()


def test_bits():
    x = np.random.default_rng(1).integers(0, 2**17, 1001)
    data = token_output.in_bits(x, 17)
    assert len(data) == -(-1001 * 17 // 8)
    for a, b in ((0, 1001), (0, 0), (1000, 1001), (3, 777)):
        assert (token_output.from_bits(data, 17, a, b) == x[a:b]).all()


def test_encoder_against_the_tokenizer(monkeypatch):
    monkeypatch.setattr(token_output, "CACHED", 200)
    encoder, rng = token_output.Encoder(token_output.tokenizer_path()), np.random.default_rng(9)
    letters = list("abcXYZéÀßøñ.,!?'’-#$%<>|()[]{}\"\\/0123456789ﬁİ\u0301\u00a0年") + ["<|endoftext|>", "'s", "'LL", "don't"]
    for _ in range(40):
        texts = [" ".join("".join(rng.choice(letters, int(rng.integers(1, 9)))) for _ in range(int(rng.integers(0, 30)))) for _ in range(8)] + [None, ""]
        ids, begins = encoder.encode(pa.array(texts, pa.large_string()))
        want = [encoder.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
        assert [ids[a:b].tolist() for a, b in itertools.pairwise(begins)] == want


# 5


def test_interpolation_against_brute_force(spark):
    rng = np.random.default_rng(2)
    texts = list(ODD[:9]) + [" ".join(f"v{min(int(x), 40)}" for x in rng.geometric(0.2, int(rng.integers(1, 60)))) for _ in range(300)]
    got = {r.doc_id: r for r in interpolation.score(docs(spark, texts)).collect()}
    tokens = [[*WORD.findall((t or "").translate(LOWER)), None] for t in texts]
    held = [zlib.crc32(str(i).encode()) % 5 == 1 for i in range(len(texts))]
    uni, bi = Counter(), Counter()
    for t, h in zip(tokens, held):
        if not h:
            uni.update(t)
            bi.update(zip([None, *t], t))
    n, v = sum(uni.values()), len(uni)
    learnt = {}
    for i, t in enumerate(tokens):
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(t), sum(w in uni for w in t), n)
        assert abs(r.base_score - sum(math.log10((uni[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t)) < 1e-6
        learnt[i] = r.score
    encoded = interpolation.encode(docs(spark, texts), "doc_id", "text")
    counted = interpolation.count(encoded, 3, new_path(spark, "t")).cache()
    weights = interpolation.learn_weights(encoded, counted, n, v)
    assert np.allclose(weights.sum(1), 1) and (weights[0][0] == 0)
    for i, t in enumerate(tokens):
        p = 0.0
        for a, w in zip([None, *t], t):
            m = weights[int(interpolation._bucket(np.array([uni[a]]))[0])]
            p += math.log10(m[0] * bi[a, w] / max(uni[a], 1) + m[1] * uni[w] / n + m[2] / (v + 1))
        assert abs(learnt[i] - p) < 1e-6
    some = [i for i in range(len(texts)) if held[i]]
    assert sum(got[i].score for i in some) > sum(got[i].base_score for i in some)
    assert interpolation.score(docs(spark, texts).limit(0)).collect() == []


def test_counts_of_many_batches(spark, monkeypatch):
    monkeypatch.setattr(interpolation, "BATCH_BYTES", 300)
    rng = np.random.default_rng(3)
    texts = ["", None] + [" ".join(f"v{int(x)}" for x in rng.geometric(0.05, int(rng.integers(1, 40)))) for _ in range(200)]
    encoded = interpolation.encode(docs(spark, texts), "doc_id", "text").cache()
    found = {}
    for most in (10**6, 7):
        counted = interpolation.count(encoded, 5, new_path(spark, "t"), encoded.count(), most).cache()
        totals = counted.selectExpr("sum(n_train)", "sum(n_seen)").first()
        files_of = {r.batch: r.path for r in counted.collect()}
        found[most] = (tuple(totals), [[x.tolist() for x in interpolation._estimates(bytes(r.blob), files_of[r.batch])[1:]] for r in encoded.orderBy("batch").collect()])
    assert found[7] == found[10**6] and len(found[7][1]) > 20


def test_keys_travel_whole():
    rng = np.random.default_rng(2)
    for keys in (rng.integers(0, 2**64, 5000, dtype=np.uint64), np.array([0, 1, 2**64 - 1], np.uint64), np.array([7], np.uint64), np.arange(300, dtype=np.uint64), np.array([5, 6, 2**40, 2**63], np.uint64)):
        keys = np.unique(keys)
        assert (interpolation._long(*interpolation._short(keys)) == keys).all()


def test_interpolation_of_null_ids(spark):
    df = spark.createDataFrame([(None, "a b"), (None, "a b"), (1, None)], "doc_id long, text string")
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.train_tokens) for r in interpolation.score(df).collect()) == Counter({(None, False, 3, 7): 2, (1, False, 1, 7): 1})


# 7


def test_decontamination(spark):
    item = "So Alice Smith drove 60 km in 2 hours and then Alice Smith rested for 3 days before going home again with 60 km left."
    same = "Before. " + item.replace("Alice Smith", "Bob Jones").replace("60 km", "75 km") + " And after."
    mixed = same.replace("then Bob Jones", "then Carl Xu").replace("with 75 km", "with 81 km").replace("2 hours", "4 hours").replace("3 days", "9 days")
    df = docs(spark, [same, mixed, None, "", "So", item.upper(), "x " * 50_000 + item, "1 2 3 4 5 6 7"])
    benchmark = spark.createDataFrame([(4, item, 1), (4, item, 1), (5, None, 1), (6, "7 6 5 4 3 2 1", 1), (None, "an item that has no id at all", 1)], "item_id long, text string, key int")
    got = {r.doc_id: (r.contaminated, r.item_ids) for r in decontam.decontaminate(df, benchmark).collect()}
    assert got == {0: (True, [4]), 1: (False, []), 2: (False, []), 3: (False, []), 4: (False, []), 5: (True, [4]), 6: (True, [4]), 7: (False, [])}
    assert sorted(r.doc_id for r in decontam.clean_of(df, benchmark).collect()) == [1, 2, 3, 4, 7]
    assert decontam.decontaminate(df, benchmark.limit(0)).filter("contaminated").count() == 0
    assert decontam.decontaminate(df.limit(0), benchmark).collect() == []


def test_decontamination_beside_sentences_like_the_items(spark):
    item = "At noon Tom has 12 pears in his bag and Tom gives 5 of them away so tell us how many pears does Tom have left now"
    noise = " ".join(f"{w} asked how many pears does Mary have left now." for w in ("He", "She", "They", "We", "You"))
    other = item.replace("Tom", "Bob").replace("12", "31").replace("5 of", "8 of")
    df = docs(spark, [f"{item}. {noise}", f"{noise} {other}.", f"{other.replace('so tell', 'so please just tell')}. {noise}", noise])
    got = {r.doc_id: r for r in decontam.decontaminate(df, spark.createDataFrame([(1, item)], "item_id long, text string")).collect()}
    assert got[0].share == 1.0 and [got[i].contaminated for i in range(4)] == [True, True, True, False]


def test_decontamination_of_names_at_sentence_beginnings(spark):
    item = "Tom has 12 apples in his bag. Tom buys 7 more at the shop. Mary gives him 5 of hers. How many apples does Tom have?"
    other = item.replace("12", "31").replace("7", "4").replace("5", "9")
    named = lambda tom, mary: other.replace("Tom", tom).replace("Mary", mary)
    odd = named("Bob", "Ann").replace("Bob buys", "Carl buys").replace("does Bob", "does Dan")
    texts = [named("Bob", "Ann"), "We read: " + named("Bob Lee", "Ann Mary Cho") + " Then some more.", "They wrote that " + named("Mary Ann", "Bob"), odd, item.lower(), item]
    got = {r.doc_id: r for r in decontam.decontaminate(docs(spark, texts), spark.createDataFrame([(1, item)], "item_id long, text string")).collect()}
    assert [got[i].contaminated for i in range(6)] == [True] * 6 and got[0].share > 0.9 and got[5].share == 1.0
    assert round(got[3].share * 21) == 18  # the windows that contradict the most frequent pairing don't count


def naive_share(item, copy):
    """The part of an item's windows that a copy of it, word by word, holds: as they are, or with slots whose values agree with most others."""
    def kind(words, k):
        return "number" if words[k].isdigit() else "unit" if words[k] in ("km", "kg") and k and words[k - 1].isdigit() else "name" if words[k][0].isupper() else None

    n, exact, shaped, votes = len(item) - 4, set(), {}, Counter()
    for i in range(n):
        kinds = [(kind(item, k), kind(copy, k)) for k in range(i, i + 5)]
        if item[i : i + 5] == copy[i : i + 5]:
            exact.add(i)
        if all(a == b for a, b in kinds) and any(a for a, _ in kinds) and sum(not a for a, _ in kinds) >= decontam.PLAIN and all(item[k] == copy[k] for k in range(i, i + 5) if not kind(item, k)):
            shaped[i] = [((kind(item, k), item[k]), (kind(copy, k), copy[k])) for k in range(i, i + 5) if kind(item, k)]
            votes.update(shaped[i])
    best = lambda pair, side: max(c for p, c in votes.items() if p[side] == pair[side])
    assert all(sum(c == best(p, side) for q, c in votes.items() if q[side] == p[side]) == 1 for p in votes for side in (0, 1)), "a tie"
    good = {i for i, pairs in shaped.items() if all(votes[p] == best(p, 0) == best(p, 1) for p in pairs)}
    return len(exact | good) / n


def test_slots_against_brute_force(spark):
    rng = np.random.default_rng(21)
    names, plain = [f"N{c}{d}" for c in "abcdef" for d in "xyz"], [f"p{k}" for k in range(5000)]
    items, texts, want = [], [], []
    while len(texts) < 60:
        item = [str(rng.choice(plain)) for _ in range(30)]
        for k in range(3, 30, int(rng.integers(3, 6))):
            item[k] = str(rng.choice([str(rng.integers(0, 6)), *names[:3]]))
            if item[k].isdigit() and k < 29 and rng.random() < 0.5:
                item[k + 1] = "km"
        change = {x: str(rng.integers(10, 99)) if x.isdigit() else str(rng.choice(names[5:])) if x[0].isupper() else str(rng.choice(["km", "kg"])) for x in set(item) if not x.startswith("p")}
        copy = [change[x] if x in change and rng.random() < 0.9 else x for x in item]
        if rng.random() < 0.5:
            copy[int(rng.integers(0, 30))] = "other"
        try:
            want.append(naive_share(item, copy))
        except AssertionError:  # which of two values counts is then a matter of their hashes
            continue
        items.append((len(texts), " ".join(item)))
        texts.append(" ".join([*rng.choice(plain, 7), *copy, *rng.choice(plain, 9)]))
    got = {r.doc_id: r for r in decontam.decontaminate(docs(spark, texts), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert [round(got[i].share, 9) for i in range(60)] == [round(x, 9) for x in want]
    assert [got[i].item_ids for i in range(60)] == [[i] if x >= decontam.SHARE else [] for i, x in enumerate(want)] and 5 < sum(x >= decontam.SHARE for x in want) < 55


# 8


def brute_cost(roles):
    """The least cost by trying all labels, merges and fillings."""
    best = math.inf
    for choice in itertools.product(itertools.product(("system", "user", "assistant"), (False, True)), repeat=len(roles)):
        state, cost = "start", 0
        for r, (role, merge) in zip(roles, choice):
            cost += 0 if role == r else chat_repair.RELABEL if r else chat_repair.NAME
            if merge:
                if state != role:
                    break
                cost += chat_repair.MERGE
                continue
            steps = {"start": {"system": 0, "user": 0, "assistant": 1}, "system": {"user": 0, "assistant": 1}, "user": {"assistant": 0, "user": 1}, "assistant": {"user": 0, "assistant": 1}}[state].get(role)
            if steps is None:
                break
            cost, state = cost + chat_repair.INSERT * steps, role
        else:
            cost += {"assistant": 0, "user": 1, "system": 2, "start": 2}[state] * chat_repair.INSERT
            best = min(best, cost)
    return best


def test_repair_is_cheapest_and_legal(spark):
    rng = np.random.default_rng(4)
    talks = {c: [chat_repair.ROLES[k] for k in rng.integers(0, 4, int(rng.integers(1, 6)))] for c in range(60)}
    turns = [(c, t, r or None, f"{c}-{t}", "p") for c, rs in talks.items() for t, r in enumerate(rs)]
    got = chat_repair.repair(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string, piece string")).orderBy("conv_id", "turn", "copy", "place").collect()
    for c, rs in talks.items():
        mine = [r for r in got if r.conv_id == c]
        text = "".join(r.piece for r in mine)
        roles = re.findall(r"<\|(system|user|assistant)\|>", text)
        assert re.fullmatch(r"(system )?(user assistant )+", " ".join(roles) + " "), text
        assert text.endswith("<|end|>\n") and text.count("<|end|>") == len(roles) and all(f"{c}-{t}" in text for t in range(len(rs)))
        cost = sum({"keep": 0, "merge": 1, "insert": 2}.get(r.action, 0) for r in mine) + sum((0 if "merge" not in r.action else 1) + (3 if rs[r.turn] else 2) for r in mine if "relabel" in r.action)
        assert cost == brute_cost(rs)


def test_cut_conversations_take_the_same_way():
    rng = np.random.default_rng(11)
    for _ in range(400):
        roles = [chat_repair.ROLES[k] for k in rng.integers(0, 4, int(rng.integers(1, 30)))]
        want, total = chat_repair.path(roles, 0, None)
        cuts = np.sort(rng.integers(0, len(roles) + 1, int(rng.integers(0, 4))))
        parts = [roles[a:b] for a, b in zip([0, *cuts], [*cuts, len(roles)]) if b > a]
        states, cost = chat_repair.join([chat_repair.transfer(iter(p)) for p in parts])
        got = []
        for k, p in enumerate(parts):
            got += chat_repair.path(p, states[k], states[k + 1] if k < len(parts) - 1 else None)[0]
        assert (got, cost) == (want, total)


def test_repair_does_not_depend_on_partitions(spark):
    rng = np.random.default_rng(12)
    turns = [(1, t // 2 if t < 90 else None, chat_repair.ROLES[int(rng.integers(0, 4))] or None, f"x{rng.integers(0, 5)}") for t in range(240)]
    turns += [(c, t, chat_repair.ROLES[int(rng.integers(0, 4))], "y") for c in (2, None) for t in range(40)] + [(3, 0, "user", "z")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    found, before = [], spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in (1, 4, 8, 64):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            found.append(rows(chat_repair.repair(df)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1] == found[2] == found[3]
    assert sum(r[-1] is not None for r in found[0]) == 4 and len({r[:4] for r in found[0]}) == len(found[0])


def test_a_conversation_over_many_tasks(spark):
    roles = ["user", "user", "assistant", "system", "assistant", None] * 100
    df = spark.createDataFrame([(1, t, r, "x") for t, r in enumerate(roles)] + [(None, None, "bot", None), (2, 1, "Human ", "a"), (2, 1, "gpt", "b")], "conv_id long, turn long, role string, text string")
    got = chat_repair.repair(df).orderBy("conv_id", "turn", "copy", "place").collect()
    text = "".join(r.piece for r in got if r.conv_id == 1)
    assert re.fullmatch(r"(system )?(user assistant )+", " ".join(re.findall(r"<\|(system|user|assistant)\|>", text)) + " ")
    states, total = chat_repair.path([r or "" for r in roles], 0, None)
    cost = sum({"merge": 1, "insert": 2, "relabel": 0, "keep": 0, "relabel and merge": 1}[r.action] + ((3 if roles[r.turn] else 2) if "relabel" in r.action else 0) for r in got if r.conv_id == 1)
    assert cost == total and text.endswith("<|end|>\n")
    assert [r.piece for r in got if r.conv_id is None] == ["<|user|>\n", "<|end|>\n<|assistant|>\n<|end|>\n"]
    assert chat_repair.repair(df.limit(0)).collect() == []


# 9


def naive_kneser_ney(pairs, name):
    """Of one class: probabilities of words, of pairs, of backing off, and of an unknown word, from {(v, w): {class: count}}."""
    def discounts(counts):
        n = [max(1, sum(c == k for c in counts)) for k in range(5)]
        y = n[1] / (n[1] + 2 * n[2])
        return [0.0, *(min(k, max(0.1 * k, k - (k + 1) * y * n[k + 1] / n[k])) for k in (1, 2, 3))]

    vocabulary, mine = sorted({w for _, w in pairs}), {p: c[name] for p, c in pairs.items() if c[name]}
    room = len(pairs) + 0.5 * (len(vocabulary) + 1)
    follows = {w: sum(x == w for _, x in mine) for w in vocabulary}
    e, d = discounts(list(follows.values())), discounts([c[name] for c in pairs.values()])
    gamma = sum(e[min(3, f)] for f in follows.values()) / len(mine)
    word = {w: (f - e[min(3, f)]) / len(mine) + gamma * (sum(x == w for _, x in pairs) + 0.5) / room for w, f in follows.items()}
    total, back = Counter(), {}
    for (v, _), c in mine.items():
        total[v] += c
    for v in {v for v, _ in pairs}:
        back[v] = sum(d[min(3, c)] for (x, _), c in mine.items() if x == v) / total[v] if total[v] else 1.0
    pair = {(v, w): ((mine.get((v, w), 0) - d[min(3, mine.get((v, w), 0))]) / total[v] if total[v] else 0.0) + back[v] * word[w] for v, w in pairs}
    assert abs(sum(word.values()) + gamma * 0.5 / room - 1) < 1e-9
    return word, pair, back, gamma * 0.5 / room


def test_kneser_ney_against_brute_force():
    rng = np.random.default_rng(13)
    pairs = {(int(v), int(w)): {"ordinary": int(rng.geometric(0.5)) - int(rng.random() < 0.4), "toxic": int(rng.geometric(0.4)) - 1} for v, w in rng.integers(0, 25, (200, 2))}
    pairs = {p: c for p, c in pairs.items() if sum(c.values())}
    table = pa.table({"v": [v for v, _ in pairs], "w": [w for _, w in pairs], "ordinary": [c["ordinary"] for c in pairs.values()], "toxic": [c["toxic"] for c in pairs.values()]})
    word, pair, back = toxicity.fit_sides(table)
    o, t = (naive_kneser_ney(pairs, name) for name in ("ordinary", "toxic"))
    number = lambda *x: np.array(x, np.uint64)
    assert all(abs(word(number(w))[0] - math.log(t[0][w] / o[0][w])) < 1e-5 for w in o[0])
    assert abs(word(number(999))[0] - math.log(t[3] / o[3])) < 1e-5
    assert all(abs(pair(toxicity.pair_keys(number(v), number(w)))[0] - math.log(t[1][v, w] / o[1][v, w])) < 1e-5 for v, w in pairs)
    assert all(abs(back(number(v))[0] - math.log(t[2][v] / o[2][v])) < 1e-5 for v in o[2]) and np.isnan(pair(number(5))[0])


def test_the_model_does_not_depend_on_the_order_of_rows(spark):
    rows_ = [(i % 50, f"w{i % 7} w{i % 3} {'grub' if i % 2 else 'good'} v{i}") for i in range(200)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(50)], "doc_id long, toxic int")
    scores = []
    for order in (rows_, rows_[::-1]):
        df = spark.createDataFrame(order, "doc_id long, text string")
        found = toxicity.score(df, toxicity.learn(df, labels)).collect()
        # Running sums of other texts round the last digits.
        scores.append(sorted(((r.doc_id, r.held_out, round(r.score, 9), r.predicted) for r in found), key=repr))
    assert scores[0] == scores[1]


def test_toxicity_on_held_out_documents(spark):
    rng = np.random.default_rng(6)
    vocabulary = [f"w{k}" for k in range(400)]
    texts, marks = [], []
    for _ in range(600):
        w = list(rng.choice(vocabulary, int(rng.integers(5, 200))))
        marks.append(int(rng.random() < 0.3))
        if marks[-1]:
            for at in rng.integers(0, len(w), 3):
                w[at] = "grub" + rng.choice(list("abcdefgh"))
        texts.append(" ".join(w))
    texts += [None, "", "   ", "y" * 100_000]
    df = docs(spark, texts)
    table = spark.createDataFrame([(i, m) for i, m in enumerate(marks)] + [(0, marks[0]), (1, None), (None, 1), (99_999, 1)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.score(df, toxicity.learn(df, table)).collect()}
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i in got) and all(0 <= r.score <= 1 for r in got.values())
    right = [got[i].predicted == m for i, m in enumerate(marks) if got[i].held_out]
    assert sum(right) / len(right) > 0.95
    assert [got[i].predicted for i in range(600, 604)][:3] == [int(got[600].score >= 0.3)] * 3
    flipped = spark.createDataFrame([(i, m if zlib.crc32(str(i).encode()) % 4 != 2 else 1 - m) for i, m in enumerate(marks)] + [(None, 1), (99_999, 1)], "doc_id long, toxic int")
    again = {r.doc_id: r.score for r in toxicity.score(df, toxicity.learn(df, flipped)).collect()}
    assert all(abs(again[i] - got[i].score) < 1e-9 for i in got)
    none = toxicity.learn(df, table.limit(0))
    assert toxicity.score(df, none).filter("score <> 0").count() == 0 and toxicity.score(df.limit(0), none).collect() == []


def test_toxicity_of_a_class_with_huge_texts(spark):
    rng = np.random.default_rng(8)
    ordinary, texts = [f"w{k}" for k in range(300)], []
    for i in range(300):
        w = list(rng.choice(ordinary, 60 if i % 20 else 40_000))
        if i % 2:
            w[10] = "grub" + rng.choice(list("abcdefgh"))
        texts.append(" ".join(w))
    df = docs(spark, texts)
    labels = spark.createDataFrame([(i, i % 2) for i in range(300)], "doc_id long, toxic int")
    found, *_ = toxicity.sample(df, labels, "doc_id", "text")
    assert sorted((r.doc_id, r.text) for r in found.collect()) == [(i, texts[i]) for i in range(300) if zlib.crc32(str(i).encode()) % 4 != 2]
    right = [r.predicted == r.doc_id % 2 for r in toxicity.score(df, toxicity.learn(df, labels)).collect() if r.held_out]
    assert sum(right) / len(right) > 0.9
