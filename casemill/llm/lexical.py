"""Ranked lexical search the other way round: an index of the items is broadcast, and documents stream through it."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from casemill.llm.heaps import TopK
from casemill.llm.shared import materialize, n_partitions, running

#: Documents of each item.
K = 10
#: Bytes of items' texts whose index is broadcast at one time; more items are searched for slice by slice.
SLICE_BYTES = 16 << 20
#: Bytes of a text that are taken apart at one time, and entries of postings that are added up at one time.
PIECE, CELLS = 1 << 20, 1 << 20
#: Null ids are last.
NO_ID = (1 << 63) - 1

#: ASCII characters but digits and letters separate terms; A-Z are lower-cased, and bytes of other characters stay as they are.
_PLAIN = bytes(c if c > 127 else ord(chr(c).lower()) if chr(c).isalnum() else 32 for c in range(256))

TERMS = "item long, item_id long, term binary, n long"
HITS = "item long, item_id long, doc_id long, score long"


def pieces(text: str) -> Iterator[list[bytes]]:
    """The terms of a text in order, a bounded piece of it at a time."""
    data = text.encode().translate(_PLAIN)
    at = 0
    while at < len(data):
        end = data.find(b" ", at + PIECE)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """item (a number of its own for each row), item_id, term, n (how often the item has it)."""
    numbered = items.select(F.monotonically_increasing_id().alias("item"), F.col(f"`{id_col}`").cast("long").alias("item_id"), F.col(f"`{text_col}`").alias("text")).filter("text IS NOT NULL")
    schema = pa.schema([("item", pa.int64()), ("item_id", pa.int64()), ("term", pa.binary()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for item, item_id, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                found = Counter(t for piece in pieces(text) for t in piece)
                n = len(found)
                yield pa.RecordBatch.from_arrays([pa.array([item] * n, pa.int64()), pa.array([item_id] * n, pa.int64()), pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())], schema=schema)

    return numbered.mapInArrow(run, TERMS)


class Index:
    """Postings of a slice's items: which items have a term, and how often. Made anew by each task of the plain arrays that were sent."""

    def __init__(self, terms: list[bytes], ends: np.ndarray, items: np.ndarray, times: np.ndarray, n_items: int):
        self.numbers = {t: i for i, t in enumerate(terms)}
        self.ends, self.items, self.times, self.n_items = ends, items, times, n_items

    def count(self, text: str) -> tuple[int, dict[int, int]]:
        """How many terms a text has, and how often each term of the index occurs."""
        found: Counter = Counter()
        for piece in pieces(text):
            found.update(map(self.numbers.get, piece))
        n = found.total()
        found.pop(None, None)
        return n, found


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, str]]:
    for b in batches:
        for doc_id, text in zip(b.column(0), b.column(1), strict=True):
            if (text := text.as_py()) is not None:
                yield doc_id.as_py(), text


def document_counts(docs: DataFrame, sent: Broadcast) -> tuple[int, int, dict[int, int]]:
    """The number of documents with terms, of all their terms, and of the documents with each term of the index."""
    schema = pa.schema([("term", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, total, held = Index(*sent.value), Counter(), np.zeros(len(sent.value[0]), np.int64)
        for _, text in _texts(batches):
            n, found = index.count(text)
            total[-1] += n > 0
            total[-2] += n
            held[np.fromiter(found, np.int64, len(found))] += 1
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[[-1, -2], some]), pa.array(np.r_[[total[-1], total[-2]], held[some]])], schema=schema)

    # At most a row for each term of the slice and task, and of the slice on the driver.
    found = dict(map(tuple, docs.mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n")).collect()))
    return found.pop(-1, 0), found.pop(-2, 0), found


def search_slice(docs: DataFrame, terms: DataFrame, k: int) -> DataFrame:
    """The k best documents of each task for each item of one slice (HITS)."""
    spark = docs.sparkSession
    table = terms.orderBy("term", "item").toArrow()  # bounded by SLICE_BYTES
    items, item_of = np.unique(table["item"].to_numpy(), return_inverse=True)
    item_ids: list[int | None] = [None] * len(items)
    for at, item_id in zip(item_of.tolist(), table["item_id"].to_pylist(), strict=True):
        item_ids[at] = item_id
    names = table["term"].combine_chunks().dictionary_encode() if table.num_rows else pa.array([], pa.binary()).dictionary_encode()
    codes = names.indices.to_numpy()
    ends = np.r_[0, np.cumsum(np.bincount(codes, minlength=len(names.dictionary)))].astype(np.int64)
    sent = spark.sparkContext.broadcast((names.dictionary.to_pylist(), ends, item_of.astype(np.int64), table["n"].to_numpy(), len(items)))
    n_docs, n_terms, held = document_counts(docs, sent)
    weights = np.zeros(len(names.dictionary), np.int64)
    for term, df in held.items():
        weights[term] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
    # A term adds at most a million times its weight; beyond 53 bits sums are made as integers.
    highest = np.zeros(len(items), object)
    np.add.at(highest, item_of, (weights[codes].astype(object) * 1_000_000) * table["n"].to_numpy().astype(object))
    exact = max(highest, default=0) < 1 << 53
    schema = pa.schema([("item", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])
    tagged = spark.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, weight, heap = Index(*sent.value), tagged.value, TopK(sent.value[4], k, 1)
        width = max(1, index.n_items)
        ids: list[int] = []
        counts: list[np.ndarray] = []
        cells = 0

        def settle() -> None:
            place = np.repeat(np.arange(len(ids)), [c.shape[1] for c in counts])
            term, tf, m = np.concatenate(counts, axis=1)
            part = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))
            sizes = index.ends[term + 1] - index.ends[term]
            each = np.repeat(index.ends[term] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
            cell, value = np.repeat(place, sizes) * width + index.items[each], np.repeat(part, sizes) * index.times[each]
            if exact:
                scores = np.bincount(cell, value, len(ids) * width).astype(np.int64)
            else:
                scores = np.zeros(len(ids) * width, np.int64)
                np.add.at(scores, cell, value)
            scores = scores.reshape(len(ids), width)
            doc, item = np.nonzero(scores >= heap.floor)
            heap.offer(item, scores[doc, item], np.array(ids, np.int64)[doc])
            ids.clear()
            counts.clear()

        for doc_id, text in _texts(batches):
            n, found = index.count(text)
            if not found:
                continue
            m = 25 + 75 * n * n_docs // n_terms
            term = np.fromiter(found, np.int64, len(found))
            counts.append(np.stack([term, np.fromiter(found.values(), np.int64, len(found)), np.full(len(found), m, np.int64)]))
            ids.append(NO_ID if doc_id is None else doc_id)
            cells += int((index.ends[term + 1] - index.ends[term]).sum()) + width
            if cells >= CELLS:
                settle()
                cells = 0
        if ids:
            settle()
        heap.settle()
        yield pa.RecordBatch.from_arrays([pa.array(heap.slot), pa.array(heap.id), pa.array(heap.score)], schema=schema)

    hits = docs.mapInArrow(run, "item long, doc_id long, score long")
    known = spark.createDataFrame([(i, int(n), d) for i, (n, d) in enumerate(zip(items, item_ids, strict=True))], "item long, number long, item_id long")
    return hits.join(F.broadcast(known), "item").select(F.col("number").alias("item"), "item_id", "doc_id", "score")


def rank_documents(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", k: int = K) -> DataFrame:
    """The k documents of the highest scores above 0 for each item: item_id, rank (from 1), doc_id, score.

    Terms are runs of digits, letters and characters beyond ASCII; A-Z are lower-cased. Scores are those of op13's contract: integers that grow with a
    term's rarity and its frequency, damped by the document's length. Equal scores go by ascending doc_id.

    The items' postings are broadcast, at most SLICE_BYTES of items' texts at a time (an item is never divided); more items are searched
    for slice by slice, two scans of the documents each. The first scan counts documents and the
    documents of each term, the second adds up scores. A task keeps k documents for each item; the tasks' heaps are merged in two levels.

    Null and empty texts have no terms: such documents aren't counted, and such items have no rows. Very long texts are taken apart piece by piece. Repeated
    documents and repeated items are rows of their own, each ranked. A null doc_id is behind equal scores. An empty
    table of either kind gives an empty result. Other columns aren't read.
    """
    spark = docs.sparkSession
    slim = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    terms = materialize(item_terms(items, item_col, item_text), "item-terms")
    sizes = terms.groupBy("item").agg(F.sum(F.octet_length("term") + 16).alias("bytes"))
    total = sizes.agg(F.sum("bytes")).first()[0] or 0
    if total <= SLICE_BYTES:
        slices = [terms] if total else []
    else:
        cut = materialize(running(sizes, [F.col("item")], {"before": "bytes"}).select("item", F.floor(F.col("before") / SLICE_BYTES).alias("slice")), "slices")
        numbers = [r[0] for r in cut.select("slice").distinct().collect()]
        slices = [terms.join(cut.filter(F.col("slice") == s), "item", "left_semi") for s in sorted(numbers)]
    found = [materialize(search_slice(slim, s, k), "heaps") for s in slices]
    rows = spark.createDataFrame([], HITS)
    for f in found:
        rows = rows.unionByName(f)
    best = [F.desc("score"), F.col("doc_id") == NO_ID, F.col("doc_id")]
    part = F.pmod(F.xxhash64("doc_id"), F.lit(n_partitions(spark)))
    first = rows.withColumn("part", part).withColumn("place", F.row_number().over(Window.partitionBy("item", "part").orderBy(*best))).filter(F.col("place") <= k)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*best))).filter(F.col("rank") <= k)
    return ranked.select("item_id", "rank", F.nullif("doc_id", F.lit(NO_ID)).alias("doc_id"), "score")


def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


ORACLE = r"""
WITH t AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
q AS (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
c AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY 1, 2),
d AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM c GROUP BY 1),
s AS (SELECT count(*) AS nn, sum(n)::BIGINT AS l FROM d),
w AS (SELECT term, floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM c, s GROUP BY term, nn),
i AS (SELECT item_id, term, count(*) AS times FROM q GROUP BY 1, 2),
r AS (SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * nn) // l))))::BIGINT AS score
  FROM i JOIN c USING (term) JOIN w USING (term) JOIN d USING (doc_id), s GROUP BY 1, 2)
SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INT AS rank, doc_id, score FROM r WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 10
"""
