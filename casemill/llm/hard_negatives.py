"""Hard negatives from blocks of vectors along a Hilbert curve, chosen by their zone maps."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casemill.llm.files import fresh, open_at
from casemill.llm.heaps import LEAST, TopK
from casemill.llm.shared import materialize, n_partitions, new_path

#: Positives of each anchor, and negatives of each positive; a negative's score is between these percentages of the positive's.
POSITIVES, NEGATIVES, LOW, HIGH = 5, 10, 30, 90
#: Components are multiplied by this and rounded down.
SCALE = 256
#: Rows of a block, and anchors that search together.
BLOCK, ANCHORS = 1024, 128
#: The curve goes over the dimensions of largest spread, so many of them with so many bits each. Their centres and spreads are those of at most
#: SAMPLE rows (those of the smallest hashes of ids): the curve decides how well blocks are told apart, never what is found.
DIMENSIONS, BITS, SAMPLE = 16, 4, 4096
#: Scores are exact in doubles below this.
EXACT = float(1 << 53)


def hilbert(places: np.ndarray, bits: int) -> np.ndarray:
    """The position along a Hilbert curve of each row of cell numbers below 2**bits (at most 64 bits together), by J. Skilling's transform of 2004."""
    x = places.astype(np.uint64).T.copy()
    n = len(x)
    for level in range(bits - 1, 0, -1):
        below = np.uint64((1 << level) - 1)
        for i in range(n):
            upper = (x[i] >> np.uint64(level)) & np.uint64(1) == 1
            swap = np.where(upper, np.uint64(0), (x[0] ^ x[i]) & below)
            x[0] ^= np.where(upper, below, swap)
            x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], np.uint64)
    for level in range(bits - 1, 0, -1):
        turn ^= np.where((x[n - 1] >> np.uint64(level)) & np.uint64(1) == 1, np.uint64((1 << level) - 1), np.uint64(0))
    x ^= turn
    key = np.zeros(x.shape[1], np.uint64)
    for level in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << np.uint64(1)) | ((x[i] >> np.uint64(level)) & np.uint64(1))
    return key


def matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """Rows of numbers, shorter ones filled up with zeros."""
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    sizes = np.diff(vectors.offsets.to_numpy())
    flat = vectors.values.slice(vectors.offsets[0].as_py(), int(sizes.sum())).to_numpy(zero_copy_only=False).astype(np.float64)
    if len(sizes) and (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of all rows of a and b; those beyond 62 bits count as the nearest such number."""
    if a.size and b.size and np.abs(a).max() * np.abs(b).max() * a.shape[1] >= EXACT:
        whole = np.array([[int(v) for v in r] for r in a], object).reshape(a.shape) @ np.array([[int(v) for v in r] for r in b], object).reshape(b.shape).T
        return np.clip(whole, LEAST, -LEAST).astype(np.int64)
    return (a @ b.T).astype(np.int64)


def _write_blocks(rows: DataFrame, width: int, folder: str) -> DataFrame:
    """Writes rows, sorted along the curve, as Parquet files of blocks, with each block's zone map in the file's footer. Returns first_key and path of each file."""
    schema = pa.schema([("id", pa.int64()), ("label", pa.int64()), ("vector", pa.list_(pa.float64(), width))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, writer, first, zones, held, waiting = fresh(folder, ".parquet"), None, None, [], [], 0

        def block(n: int) -> None:
            nonlocal held, waiting
            table = pa.Table.from_batches(held).combine_chunks()
            part, rest = table.slice(0, n), table.slice(n)
            held, waiting = rest.to_batches(), rest.num_rows
            values, label = matrix(part["vector"], width), part["label"].to_numpy()
            zones.append(np.r_[label.min(), label.max(), values.min(axis=0), values.max(axis=0)])
            flat = pa.FixedSizeListArray.from_arrays(pa.array(values.ravel()), width) if width else pa.array([[]] * n, schema.field("vector").type)
            writer.write_table(pa.Table.from_arrays([part["id"], part["label"], flat], schema=schema), row_group_size=BLOCK)

        sink = None
        for b in batches:
            if not b.num_rows:
                continue
            if writer is None:
                first = b.column("key")[0].as_py()
                sink = open_at(path, "w")
                writer = pq.ParquetWriter(sink, schema, compression="zstd", use_dictionary=False, write_statistics=False)
            held.append(b)
            waiting += b.num_rows
            while waiting >= BLOCK:
                block(BLOCK)
        if writer is not None:
            if waiting:
                block(waiting)
            writer.add_key_value_metadata({"zones": np.stack(zones).astype("<f8").tobytes()})
            writer.close()
            sink.close()
            yield pa.RecordBatch.from_pydict({"first_key": pa.array([first], pa.int64()), "path": [path]})

    return rows.mapInArrow(run, "first_key long, path string")


class Blocks:
    """The blocks of all files, from the nearest along the curve on; one file's zone maps and one block are held at a time."""

    def __init__(self, files: list[tuple[int, str]], width: int):
        self.files, self.width = files, width

    def near(self, key: int) -> list[str]:
        at = max(0, int(np.searchsorted([k for k, _ in self.files], key, side="right")) - 1)
        return [path for _, (_, path) in sorted(enumerate(self.files), key=lambda f: abs(f[0] - at))]

    def visit(self, key: int, vectors: np.ndarray, wanted) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Anchors (their places), ids, labels and scores of blocks that `wanted` names by lowest and highest label and by bounds of the scores."""
        up, down = np.maximum(vectors, 0), np.minimum(vectors, 0)
        for path in self.near(key):
            with open_at(path, "r") as source, pq.ParquetFile(source) as file:
                zones = np.frombuffer(file.metadata.metadata[b"zones"], "<f8").reshape(-1, 2 + 2 * self.width)
                low, high = zones[:, 2 : 2 + self.width].T, zones[:, 2 + self.width :].T
                # The interval product of an anchor and a block; doubles are rounded, so that the bounds get some room.
                lowest, highest = up @ low + down @ high, up @ high + down @ low
                room = np.maximum(np.abs(lowest), np.abs(highest)) * 1e-9 + 1
                for k in range(len(zones)):
                    who = np.flatnonzero(wanted(zones[k, 0], zones[k, 1], lowest[:, k] - room[:, k], highest[:, k] + room[:, k]))
                    if len(who):
                        rows = file.read_row_group(k)
                        values = rows["vector"].combine_chunks().flatten().to_numpy().reshape(rows.num_rows, self.width)
                        yield who, rows["id"].to_numpy(), rows["label"].to_numpy(), dot(vectors[who], values)


def _search(blocks: Blocks, key: int, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, positives: int, negatives: int, low: int, high: int) -> Iterator[tuple]:
    """Columns of the result for one group of anchors."""
    best = TopK(len(ids), positives)
    for who, its_id, its_label, score in blocks.visit(key, vectors, lambda first, last, least, most: (first <= labels) & (labels <= last) & (most >= best.floor)):
        fits = (its_label == labels[who, None]) & (its_id != ids[who, None]) & (score >= best.floor[who, None])
        a, r = np.nonzero(fits)
        best.offer(who[a], score[a, r], its_id[r])
    best.settle()
    # A slot for each anchor and positive, with the window of scores of its negatives.
    anchor, n = best.slot, len(best.slot)
    from_score = np.array([-(-low * int(p) // 100) for p in best.score], np.int64)
    to_score = np.array([high * int(p) // 100 for p in best.score], np.int64)
    hard = TopK(n, negatives)
    slots_of = [np.flatnonzero(anchor == a) for a in range(len(ids))]
    depth = max(map(len, slots_of), default=0)
    # By anchor: its slots, -1 where it has fewer.
    slots = np.array([[*s, *[-1] * (depth - len(s))] for s in slots_of], np.int64).reshape(len(ids), depth)

    def window() -> tuple[np.ndarray, np.ndarray]:
        """The lowest and highest score that any of an anchor's slots still takes."""
        least, most = np.maximum(from_score, hard.floor), to_score
        real = (slots >= 0) & (least <= most)[slots] if n else np.zeros(slots.shape, bool)
        if not depth or not n:
            return np.full(len(ids), 1), np.zeros(len(ids))
        return np.where(real, least[slots], -LEAST).min(axis=1), np.where(real, most[slots], LEAST).max(axis=1)

    def wanted(first: float, last: float, least: np.ndarray, most: np.ndarray) -> np.ndarray:
        bottom, top = window()
        return ~((first == labels) & (last == labels)) & (bottom <= top) & (most >= bottom) & (least <= top)

    for who, its_id, its_label, score in blocks.visit(key, vectors, wanted):
        bottom, top = window()
        a, r = np.nonzero((its_label != labels[who, None]) & (score >= bottom[who, None]) & (score <= top[who, None]))
        found, its, owner = score[a, r], its_id[r], who[a]
        for j in range(depth):
            slot = slots[owner, j]
            fits = (slot >= 0) & (found >= np.maximum(from_score, hard.floor)[slot]) & (found <= to_score[slot])
            hard.offer(slot[fits], found[fits], its[fits])
    hard.settle()
    rank = np.arange(len(hard.slot)) - np.searchsorted(hard.slot, hard.slot) + 1
    yield ids[anchor[hard.slot]], best.id[hard.slot], rank, hard.id, best.score[hard.slot], hard.score


def hard_negatives(
    vectors: DataFrame, is_anchor: Column, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding", scale: float = SCALE,
    positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of the hardest negatives of each anchor and positive.

    A row's score is the inner product with the anchor of components floor(scale * x). An anchor's positives are its best rows of the same label, and a positive's
    negatives the best of other labels whose score is `low` to `high` percent of the positive's; equal scores go by ascending id.

    Rows are range-sorted along a Hilbert curve and written as Parquet files of blocks of BLOCK rows, with the least and greatest component of each dimension
    (the zone map) in the footers. Anchors are range-sorted along the same curve and search in groups: interval arithmetic of anchor and zone map
    bounds a block's scores, and a group reads a block only if some anchor could still take a row of it for a positive or for a window. It
    begins with the nearest file, so that bounds are tight soon. A task holds one block, one file's zone maps and its group's heaps.

    The result is exact. Rows with a null id or label, a null vector, a null component or one that isn't finite (scaled) take no part. Shorter
    vectors, empty ones too, count as having zeros behind. Rows with the anchor's own id are no candidates. Repeated rows are
    candidates each, and repeated anchors are searched for each. Products beyond 62 bits count as the nearest such number.
    An empty table, or one without anchors, gives an empty result. Other columns aren't read, and may have any names.
    """
    spark = vectors.sparkSession
    rows = vectors.select(
        F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").cast("long").alias("label"), F.transform(F.col(f"`{vector_col}`").cast("array<double>"), lambda x: x * F.lit(float(scale))).alias("vector"),
        F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"),
    ).filter("id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL")
    odd = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.filter(~odd)
    n_rows, n_anchors, width = rows.agg(F.count(F.lit(1)), F.count_if("is_anchor"), F.coalesce(F.max(F.size("vector")), F.lit(0))).first()
    out = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not n_anchors:
        return spark.createDataFrame([], out)
    sample = matrix(rows.select("vector").orderBy(F.xxhash64("id"), "id").limit(SAMPLE).toArrow()["vector"], width)
    axes = np.argsort(-sample.std(axis=0), kind="stable")[:DIMENSIONS]
    centre, spread = sample.mean(axis=0)[axes], np.maximum(sample.std(axis=0)[axes], 1e-9)
    cells = 1 << BITS
    keyed_schema = pa.schema([("id", pa.int64()), ("label", pa.int64()), ("vector", pa.list_(pa.float64())), ("is_anchor", pa.bool_()), ("key", pa.int64())])

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            values = np.floor(matrix(b.column("vector"), width))
            # Four spreads around the centre are divided evenly.
            place = np.clip((values[:, axes] - centre) / spread * (cells / 4) + cells / 2, 0, cells - 1)
            at = hilbert(place, BITS) if len(axes) and len(values) else np.zeros(len(values), np.uint64)
            whole = pa.ListArray.from_arrays(np.arange(len(values) + 1, dtype=np.int32) * width, pa.array(values.ravel()))
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("label"), whole, b.column("is_anchor"), pa.array((at >> np.uint64(1)).astype(np.int64))], schema=keyed_schema)

    keyed = materialize(rows.mapInArrow(key, "id long, label long, vector array<double>, is_anchor boolean, key long"), "keyed-vectors")
    folder = new_path(spark, "vector-blocks")
    ordered = keyed.select("id", "label", "vector", "key").repartitionByRange(n_partitions(spark), "key", "id").sortWithinPartitions("key", "id")
    # One row for each file.
    files = sorted(map(tuple, materialize(_write_blocks(ordered, width, folder), "vector-files").collect()))
    group = max(1, min(ANCHORS, -(-n_anchors // max(n_partitions(spark), spark.sparkContext.defaultParallelism))))
    schema = pa.schema([("anchor_id", pa.int64()), ("positive_id", pa.int64()), ("rank", pa.int32()), ("negative_id", pa.int64()), ("positive_score", pa.int64()), ("negative_score", pa.int64())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = Blocks(files, width)
        for b in batches:
            for at in range(0, b.num_rows, group):
                part = b.slice(at, group)
                ids, labels, keys = (part.column(c).to_numpy() for c in ("id", "label", "key"))
                for columns in _search(blocks, int(keys[len(keys) // 2]), ids, labels, matrix(part.column("vector"), width), positives, negatives, low, high):
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    anchors = keyed.filter("is_anchor").select("id", "label", "vector", "key").repartitionByRange(-(-n_anchors // group), "key", "id").sortWithinPartitions("key", "id")
    return anchors.mapInArrow(search, out)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors.select("vec_id", label.alias("label"), "embedding"), F.col("vec_id") % 100 == 0)


ORACLE = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id, list_dot_product(a.q, b.q)::BIGINT AS score FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id, (row_number() OVER w)::INT AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 10
"""
