"""A bigram language model by deleted interpolation: counts of the whole corpus, weights by expectation-maximisation."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casemill.llm import files, words
from casemill.llm.shared import materialize, n_partitions, new_path, small

#: Documents whose crc32 of the id modulo this is HELD_OUT aren't learnt from.
FOLDS, HELD_OUT = 5, 1
#: Bytes of text whose tokens travel together, and keys that one bucket of the count holds on average.
BATCH_BYTES, BUCKET_KEYS = 6_000_000, 2_000_000
#: Batches whose counts one task adds for a bucket; of more, groups of so many are added first, and then the groups.
MOST_BATCHES = 65_536
#: Context frequencies fall in buckets by their power of two.
BUCKETS = 48
#: Ratios of the estimates are told apart to this part of a doubling when weights are learnt.
STEPS = 4
ROUNDS = 60
END_HASH = np.uint64(0x2545F4914F6CDD1D)


def held_out(id_col: Column) -> Column:
    """Whether crc32(id as text) modulo FOLDS is HELD_OUT; a null id isn't held out."""
    return F.coalesce(F.crc32(id_col.cast("string")) % FOLDS == HELD_OUT, F.lit(False))


def _pack(*arrays: np.ndarray) -> bytes:
    return struct.pack("<I", len(arrays)) + b"".join(struct.pack("<4sQ", a.dtype.str[1:].encode(), len(a)) for a in arrays) + b"".join(a.tobytes() for a in arrays)


def _unpack(data: bytes) -> list[np.ndarray]:
    n = struct.unpack_from("<I", data)[0]
    kinds, at, out = [struct.unpack_from("<4sQ", data, 4 + 12 * k) for k in range(n)], 4 + 12 * n, []
    for kind, size in kinds:
        out.append(np.frombuffer(data, kind.rstrip(b"\0").decode(), size, at))
        at += out[-1].nbytes
    return out


def _thin(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts as single bytes, and those of 255 or more by themselves: most are small."""
    return np.minimum(counts, 255).astype(np.uint8), counts[counts >= 255].astype(np.uint64)


def _thick(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    out = low.astype(np.int64)
    out[low == 255] = high
    return out


def _contexts(codes: np.ndarray, sizes: np.ndarray, end: int) -> np.ndarray:
    """The token before each: the end, for the first of a document."""
    out = np.empty_like(codes)
    out[1:] = codes[:-1]
    out[np.cumsum(sizes) - sizes] = end
    return out


def _keys(codes: np.ndarray, sizes: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different bigrams of a batch, sorted, and the place of each token's in them."""
    context = _contexts(codes, sizes, len(hashes) - 1)
    return np.unique(words.mix(hashes[context] * np.uint64(0x9E3779B97F4A7C15) + hashes[codes]), return_inverse=True)


def encode(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Batches of documents as numbers: batch, n_tokens, blob (ids, nulls, held out, sizes, codes, hashes of the words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        for batch in words.slices(batches, "text", BATCH_BYTES):
            begins, codes, different = words.split(batch.column("text"), lower=True)
            sizes = np.diff(begins) + 1
            tokens = np.full(int(sizes.sum()), len(different), np.int32)
            inner = np.ones(len(tokens), bool)
            inner[np.cumsum(sizes) - 1] = False
            tokens[inner] = codes
            ids = batch.column("doc_id")
            blob = _pack(
                ids.fill_null(0).to_numpy(zero_copy_only=False), ids.is_null().to_numpy(zero_copy_only=False).view(np.uint8), batch.column("held").to_numpy(zero_copy_only=False).view(np.uint8),
                sizes, tokens, np.append(words.hashes(different), END_HASH),
            )
            yield pa.RecordBatch.from_arrays([pa.array([number]), pa.array([len(tokens)]), pa.array([blob], pa.binary())], names=["batch", "n_tokens", "blob"])
            number += 1

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(F.col(id_col)).alias("held"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "batch long, n_tokens long, blob binary")


def _short(keys: np.ndarray) -> list[np.ndarray]:
    """Ascending keys as their steps, in as few bytes as nearly all steps need; larger steps have their upper part apart."""
    steps = np.diff(keys)
    mean = int(keys[-1] - keys[0]) // max(1, len(steps))
    width = min(8, -(-(mean.bit_length() + 3) // 8))
    body = np.ascontiguousarray(steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).reshape(-1)
    far = np.flatnonzero(steps >> np.uint64(8 * width)) if width < 8 else np.zeros(0, np.int64)
    return [keys[:1], np.array([width], np.uint8), body, far.astype(np.uint32), steps[far] >> np.uint64(8 * width % 64)]


def _long(first: np.ndarray, width: np.ndarray, body: np.ndarray, far: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The keys that _short() gave."""
    w = int(width[0])
    steps = np.zeros((len(body) // w, 8), np.uint8)
    steps[:, :w] = body.reshape(-1, w)
    steps = steps.reshape(-1).view("<u8").astype(np.uint64)
    steps[far] |= high << np.uint64(8 * w % 64)
    return np.cumsum(np.concatenate([first, steps]), dtype=np.uint64)


def _keyed(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Keys and counts of a row that batches or groups send."""
    *keys, low, high = _unpack(blob)
    return _long(*keys), _thick(low, high)


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different keys of all parts, the sums of their counts, and the place of each part's keys among them, in a row."""
    keys, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    sums = np.zeros(len(keys), np.int64)
    np.add.at(sums, at, np.concatenate([c for _, c in parts]))
    return keys, sums, at


def count(encoded: DataFrame, buckets: int, folder: str, n_batches: int = 0, most: int = MOST_BATCHES) -> DataFrame:
    """How often each token and bigram of each batch occurs in the training documents.

    A batch sends its different keys, sorted, with their counts, in one row for each bucket of keys that it has any of; a
    bucket adds the counts of equal keys and sends the sums back in the same order, where they are written to one file
    for each batch. So a frequent key is one number of each batch, however often it occurs, and batches themselves
    aren't shuffled. If there are more than `most` batches, groups of about so many are added first and the groups' sums then, so
    that no task meets a frequent key of all batches. Keys are 64-bit hashes, sent whole. Columns: batch, path, and n_train
    and n_seen, whose sums over all rows are the number of training tokens and of different ones.
    """
    groups = max(1, -(-n_batches // most))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, blob in zip(batch.column("batch").to_pylist(), batch.column("blob"), strict=True):
                _, _, held, sizes, codes, hashes = _unpack(blob.as_py())
                learnt = np.repeat(held == 0, sizes)
                bigrams, at = _keys(codes, sizes, hashes)
                order = np.argsort(hashes)
                found = {0: (hashes[order], np.bincount(codes[learnt], minlength=len(hashes))[order]), 1: (bigrams, np.bincount(at[learnt], minlength=len(bigrams)))}
                for kind, (keys, counts) in found.items():
                    place = (keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
                    cuts = np.concatenate([[0], np.flatnonzero(place[1:] != place[:-1]) + 1, [len(keys)]])
                    n = len(cuts) - 1
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([number] * n), pa.array([kind] * n, pa.int32()), pa.array(place[cuts[:-1]].astype(np.int32)),
                            pa.array([_pack(*_short(keys[a:b]), *_thin(counts[a:b])) for a, b in zip(cuts, cuts[1:], strict=False)], pa.binary()),
                        ],
                        names=["batch", "kind", "bucket", "blob"],
                    )

    def add(table: pa.Table) -> pa.Table:
        """Each row's keys' sums over all rows."""
        tokens = table.column("kind")[0].as_py() == 0
        parts = [_keyed(x.as_py()) for x in table.column("blob")]
        cuts = np.cumsum([0] + [len(k) for k, _ in parts])
        _, sums, at = _added(parts)
        first = np.arange(len(parts)) == 0
        return pa.table({
            "batch": table.column("batch"), "kind": table.column("kind"), "bucket": table.column("bucket"),
            "blob": pa.array([_pack(*_thin(sums[at[a:b]])) for a, b in zip(cuts, cuts[1:], strict=False)], pa.binary()),
            "n_train": pa.array(np.where(first & tokens, sums.sum(), 0), pa.int64()), "n_seen": pa.array(np.where(first & tokens, (sums > 0).sum(), 0), pa.int64()),
        })

    def partly(table: pa.Table) -> pa.Table:
        """One row with the keys of a group of batches and their sums in it."""
        keys, sums, _ = _added([_keyed(x.as_py()) for x in table.column("blob")])
        blob = pa.array([_pack(*_short(keys), *_thin(sums))], pa.binary())
        return pa.table({"batch": table.column("group")[:1], "kind": table.column("kind")[:1], "bucket": table.column("bucket")[:1], "blob": blob})

    def hand_out(table: pa.Table, part: pa.Table, whole: pa.Table) -> pa.Table:
        """Each batch's keys' sums over all groups, by those of its group."""
        keys, sums = _keyed(part.column("blob")[0].as_py())[0], _thick(*_unpack(whole.column("blob")[0].as_py()))
        answers = [sums[np.searchsorted(keys, _keyed(x.as_py())[0])] for x in table.column("blob")]
        first = np.arange(len(answers)) == 0
        each = {c: pa.array(np.where(first, whole.column(c)[0].as_py(), 0), pa.int64()) for c in ("n_train", "n_seen")}
        return pa.table({"batch": table.column("batch"), "kind": table.column("kind"), "bucket": table.column("bucket"), "blob": pa.array([_pack(*_thin(a)) for a in answers], pa.binary()), **each})

    def keep(table: pa.Table) -> pa.Table:
        rows = sorted(zip(*(table.column(c).to_pylist() for c in ("kind", "bucket", "blob")), strict=True), key=lambda r: r[:2])
        answers = [np.concatenate([_thick(*_unpack(r[2])) for r in rows if r[0] == kind]) for kind in (0, 1)]
        with files.open_at(path := files.fresh(folder, ".counts"), "w") as f:
            f.write(zlib.compress(_pack(*(x for a in answers for x in _thin(a))), 1))
        total = lambda c: [sum(table.column(c).to_pylist())]
        return pa.table({"batch": table.column("batch")[:1], "path": [path], "n_train": total("n_train"), "n_seen": total("n_seen")})

    sent = "batch long, kind int, bucket int, blob binary"
    sums = f"{sent}, n_train long, n_seen long"
    asked = encoded.select("batch", "blob").mapInArrow(ask, sent)
    if groups == 1:
        added = asked.groupBy("kind", "bucket").applyInArrow(add, sums)
    else:
        asked = materialize(asked.withColumn("group", F.pmod(F.xxhash64("batch"), F.lit(groups))), "asked")
        parts = materialize(asked.groupBy("group", "kind", "bucket").applyInArrow(partly, sent), "parts")
        whole = parts.groupBy("kind", "bucket").applyInArrow(add, sums)
        both = parts.join(whole.withColumnRenamed("blob", "sums"), ["batch", "kind", "bucket"]).withColumnRenamed("batch", "group")
        each = lambda left, right: hand_out(left, right, right.select(["sums", "n_train", "n_seen"]).rename_columns(["blob", "n_train", "n_seen"]))
        added = asked.groupBy("group", "kind", "bucket").cogroup(both.groupBy("group", "kind", "bucket")).applyInArrow(each, sums)
    return added.groupBy("batch").applyInArrow(keep, "batch long, path string, n_train long, n_seen long")


def _estimates(blob: bytes, path: str) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """Of a batch and the file of its counts: its arrays, and each token's count, its context's, and its bigram's."""
    with files.open_at(path, "r") as f:
        low, high, low_2, high_2 = _unpack(zlib.decompress(f.read()))
    tokens, bigrams = _thick(low, high), _thick(low_2, high_2)
    arrays = _unpack(blob)
    _, _, _, sizes, codes, hashes = arrays
    token = np.empty(len(hashes), np.int64)
    token[np.argsort(hashes)] = tokens
    _, at = _keys(codes, sizes, hashes)
    return arrays, token[codes], token[_contexts(codes, sizes, len(hashes) - 1)], bigrams[at]


def _bucket(context: np.ndarray) -> np.ndarray:
    """0 for contexts that were never seen, else one more than the power of two."""
    return np.where(context > 0, np.minimum(BUCKETS - 1, np.frexp(context.astype(np.float64))[1]), 0)


def _each(encoded: DataFrame, counted: DataFrame, run, schema: str) -> DataFrame:
    """What run gives, as a table, for each batch and its counts. There is one path for each batch to send along."""
    paths = counted.select(F.col("batch").alias("its_batch"), "path")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob, path in zip(batch.column("blob"), batch.column("path").to_pylist(), strict=True):
                yield from run(*_estimates(blob.as_py(), path)).to_batches()
                words.give_back()

    return encoded.join(small(paths), F.col("batch") == F.col("its_batch")).select("blob", "path").mapInArrow(apply, schema)


def learn_weights(encoded: DataFrame, counted: DataFrame, n_train: int, n_seen: int) -> np.ndarray:
    """For each bucket of context frequency the weights of bigram, token and uniform estimates.

    Every training token is held out in turn: its own occurrence is deleted from the counts of its bigram, its
    context and itself. The ratios of the estimates, told apart to a STEPSth of a doubling, are counted by bucket;
    the number of such cells is bounded, whatever the corpus, and expectation-maximisation runs on them.
    """
    uniform, far = 1 / (n_seen + 1), 1 << 15

    def cells(arrays: list[np.ndarray], token: np.ndarray, context: np.ndarray, bigram: np.ndarray) -> pa.Table:
        _, _, held, sizes, _, _ = arrays
        use = np.repeat(held == 0, sizes)
        token, context, bigram = token[use] - 1, context[use] - 1, bigram[use] - 1
        step = lambda p: np.where(p > 0, np.round(np.log2(np.maximum(p, 1e-300) / uniform) * STEPS), -far).astype(np.int64) + far
        # A bucket and both steps in one number, which sorts faster than rows of three.
        key, n = np.unique((_bucket(context).astype(np.int64) << 32) | (step(bigram / np.maximum(context, 1)) << 16) | step(token / max(n_train - 1, 1)), return_counts=True)
        return pa.table({"bucket": key >> 32, "two": (key >> 16 & 0xFFFF) - far, "one": (key & 0xFFFF) - far, "n": n.astype(np.int64)})

    rows = _each(encoded, counted, cells, "bucket long, two long, one long, n long").groupBy("bucket", "two", "one").agg(F.sum("n").alias("n")).toPandas()
    weights = np.tile([0.0, 0.9, 0.1], (BUCKETS, 1))
    for bucket, cell in rows.groupby("bucket"):
        ratio = lambda c: np.where(cell[c].to_numpy() == -far, 0.0, np.exp2(cell[c].to_numpy() / STEPS))  # noqa: E731, B023
        p, n = np.stack([ratio("two"), ratio("one"), np.ones(len(cell))]), cell["n"].to_numpy(float)
        w = np.array([0.6, 0.3, 0.1]) if bucket else np.array([0.0, 0.9, 0.1])
        for _ in range(ROUNDS):
            part = p * w[:, None]
            w = (part / part.sum(0) * n).sum(1) / n.sum()
        w = np.maximum(w, [0 if bucket == 0 else 1e-6, 1e-6, 1e-6])
        weights[int(bucket)] = w / w.sum()
    # A bucket that no deleted count fell into takes the weights of the one below it.
    for b in range(2, BUCKETS):
        if b not in set(rows["bucket"]):
            weights[b] = weights[b - 1]
    return weights


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Scores all documents by a model of those that aren't held out.

    Returns a row for each row of docs: doc_id, held_out, n_tokens (words and the end), n_known (tokens that training
    documents have), train_tokens, base_score (add-half token estimates) and score, both base-10 logarithms.

    The model mixes the bigram estimate c(v, w) / c(v), the token estimate c(w) / N and the uniform one 1 / (V + 1),
    by weights of the bucket that c(v) falls into. The context of a first word is the end. Words that occur equally often, and
    whose neighbours do, are scored alike: there are no ties to break. Very long texts are scored whole, in a batch of their own.

    A null or empty text is its end only. A null id isn't held out. Repeated rows count each. Without training
    documents all counts are 0 and the estimates uniform. An empty table gives an empty result. Other columns aren't read.
    """
    encoded = materialize(encode(docs, id_col, text_col), "tokens", compression="zstd")
    total, n_batches = encoded.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)), F.count(F.lit(1))).first()
    buckets = max(n_partitions(docs.sparkSession), -(-total // BUCKET_KEYS))
    counted = materialize(count(encoded, buckets, new_path(docs.sparkSession, "counts"), n_batches), "counts")
    n_train, n_seen = counted.agg(F.coalesce(F.sum("n_train"), F.lit(0)), F.coalesce(F.sum("n_seen"), F.lit(0))).first()
    weights = learn_weights(encoded, counted, n_train, n_seen)

    def run(arrays: list[np.ndarray], token: np.ndarray, context: np.ndarray, bigram: np.ndarray) -> pa.Table:
        ids, null, held, sizes, _, _ = arrays
        w = weights[_bucket(context)]
        p = w[:, 0] * bigram / np.maximum(context, 1) + w[:, 1] * token / max(n_train, 1) + w[:, 2] / (n_seen + 1)
        if not n_train:
            p = np.ones(len(token))
        at = np.cumsum(sizes) - sizes
        base = np.log10((token + 0.5) / (n_train + 0.5 * (n_seen + 1)))
        return pa.table({
            "doc_id": pa.array(ids, pa.int64(), mask=null.astype(bool)), "held_out": held.astype(bool), "n_tokens": sizes, "n_known": np.add.reduceat((token > 0).astype(np.int64), at),
            "train_tokens": np.full(len(ids), n_train, np.int64), "base_score": np.add.reduceat(base, at), "score": np.add.reduceat(np.log10(p), at),
        })

    return _each(encoded, counted, run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def op5_interpolation(spark, sf_dir: str) -> DataFrame:
    return score(spark.read.parquet(f"{sf_dir}/documents.parquet"))
