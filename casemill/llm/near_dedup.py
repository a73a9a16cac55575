"""Near-duplicate documents: SetSketch registers, bands, joint likelihood, then full sets."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casemill.llm import words
from casemill.llm.components import components
from casemill.llm.files import remove
from casemill.llm.shared import grouped, materialize, once, scratch, small, with_key, without

#: Words of a shingle, and the links' similarity as a fraction.
WIDTH, NUMERATOR, DENOMINATOR = 5, 75, 100
#: Registers: BANDS times ROWS. At similarity 0.75 a link shares no band with probability (1 - 0.75^4)^32 = 5e-6.
BANDS, ROWS = 32, 4
#: Base and rate of the exponential spacing; registers run from 0 to 65,535.
BASE, RATE = 1.001, 20.0
#: Candidates whose estimated similarity is lower by more than this are dropped: five standard errors of 128 registers.
SLACK = 0.2

_FACTORS = np.random.default_rng(20).integers(0, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def registers(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """SetSketch registers of sets that begin at `starts` (none is empty): a row of uint16 for each set.

    Register i is floor(1 - log_b x) of the smallest x over the set, x being exponential of rate a by the ith
    hash of the element, truncated to its range. The maximum of two sets' registers is that of their union.
    """
    out = np.empty((len(starts), len(_FACTORS)), np.uint16)
    for i, factor in enumerate(_FACTORS):
        least = np.minimum.reduceat(hashes * factor, starts)
        x = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**64) / RATE
        out[:, i] = np.clip(np.floor(1 - np.log(x) / np.log(BASE)), 0, 65_535)
    return out


def band_keys(regs: np.ndarray) -> np.ndarray:
    """A hash of each band's registers, with the band's number."""
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(regs), BANDS)).copy()
    grouped = regs.reshape(len(regs), BANDS, ROWS).astype(np.uint64)
    for k in range(ROWS):
        key = words.mix(key * np.uint64(0x9E3779B97F4A7C15) + grouped[:, :, k])
    return key


def likely_similarity(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """The similarity of each pair of rows under which the order of their registers is the likeliest, given the sizes."""
    up, down = (a > b).sum(1)[:, None], (a < b).sum(1)[:, None]
    equal = a.shape[1] - up - down
    u, v = (n_a / (n_a + n_b))[:, None], (n_b / (n_a + n_b))[:, None]
    most = np.minimum(u / v, v / u)
    j = np.linspace(0, 1, 129)[None, :] * most
    p = lambda x: -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)
    more, less = np.maximum(p(u - v * j), 1e-12), np.maximum(p(v - u * j), 1e-12)
    same = np.maximum(1 - more - less, 1e-12)
    best = np.argmax(up * np.log(more) + down * np.log(less) + equal * np.log(same), axis=1)
    return np.take_along_axis(j, best[:, None], 1)[:, 0]


def sketch(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: uid (a new number), doc_id, text_hash, n (shingles), set_key (128 bits, of the set; null if
    it is empty), regs, bands, hashes (the whole set, sorted, as 64-bit numbers)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        words.forget()
        uid = TaskContext.get().partitionId() << 36
        for batch in words.slices(batches, "text"):
            begins, codes, different = words.split(batch.column("text"), lower=True)
            flat, counts = words.windows(words.hashes(different)[codes], begins, WIDTH)
            ends = np.cumsum(counts)
            sets = [np.unique(flat[e - n : e]) for e, n in zip(ends, counts, strict=True)]
            n = np.fromiter(map(len, sets), np.int64, len(sets))
            some = n > 0
            blobs = [s.tobytes() if len(s) else None for s in sets]
            keys = [hashlib.blake2b(x, digest_size=16).digest() if x else None for x in blobs]
            regs: list[bytes | None] = [None] * len(sets)
            bands = np.empty((0, BANDS), np.uint64)
            if some.any():
                found = registers(np.concatenate(sets), (np.cumsum(n) - n)[some])
                bands = band_keys(found)
                for i, r in zip(np.flatnonzero(some), found, strict=True):
                    regs[i] = r.tobytes()
            offsets = np.concatenate([[0], np.cumsum(np.where(some, BANDS, 0))])
            columns = [
                pa.array(uid + np.arange(len(sets)), pa.int64()), batch.column("doc_id"), batch.column("text_hash"), pa.array(n), pa.array(keys, pa.binary()), pa.array(regs, pa.binary()),
                pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(bands.reshape(-1).view(np.int64))), pa.array(blobs, pa.binary()),
            ]
            uid += len(sets)
            yield pa.RecordBatch.from_arrays(columns, names=["uid", "doc_id", "text_hash", "n", "set_key", "regs", "bands", "hashes"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("text_hash"))
    return rows.mapInArrow(words.lean(run), "uid long, doc_id long, text_hash long, n long, set_key binary, regs binary, bands array<long>, hashes binary")


def _with_both(pairs: DataFrame, table: DataFrame, names: list[str]) -> DataFrame:
    """Pairs (a, b) with the named columns of both sides, as <name>_a and <name>_b.

    Few pairs find their rows by a broadcast of ids, so the table isn't shuffled; many by a shuffle.
    """
    of = lambda side: table.select(F.col("uid").alias(side), *(F.col(x).alias(f"{x}_{side}") for x in names))
    right = of("b").join(small(pairs), "b")
    left = of("a").join(small(pairs.select("a").distinct()), "a", "left_semi")
    return right.join(left, "a").select("a", "b", *(f"{x}_{side}" for x in names for side in "ab"))


def verify(pairs: DataFrame, sketched: DataFrame) -> DataFrame:
    """The pairs (a, b) of uids that are links: those likely enough by their registers, confirmed on full sets."""

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b, ra, rb, na, nb = batch.columns
            read = lambda x: np.frombuffer(b"".join(x.to_numpy(zero_copy_only=False)), np.uint16).reshape(-1, BANDS * ROWS)
            keep = likely_similarity(read(ra), read(rb), na.to_numpy().astype(float), nb.to_numpy().astype(float)) >= NUMERATOR / DENOMINATOR - SLACK
            yield pa.RecordBatch.from_arrays([a, b], names=["a", "b"]).filter(pa.array(keep))

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("hashes_a"), batch.column("hashes_b"), strict=True):
                s, t = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                if len(s) > len(t):
                    s, t = t, s
                both = int((t[np.minimum(np.searchsorted(t, s), len(t) - 1)] == s).sum())
                keep.append(DENOMINATOR * both >= NUMERATOR * (len(s) + len(t) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    by_registers = _with_both(pairs, sketched, ["regs", "n"]).mapInArrow(words.lean(likely), "a long, b long")
    candidates = materialize(by_registers, "likely")
    return materialize(_with_both(candidates, sketched, ["hashes"]).mapInArrow(words.lean(linked), "a long, b long"), "links")


#: A code tells apart how many of a set's elements fall into each of CELLS cells, up to two.
CELLS = 128
CODES = [f"{part}_{k}" for part in ("in", "out") for k in range(5)]


def _code(elements: np.ndarray) -> list[int]:
    """Two bits for each cell, one for one element at least and one for two, in four numbers; and how many more elements there are.

    Two sets share at most as many elements as their codes share bits, and the smaller number of more elements.
    """
    counts = np.bincount((words.mix(elements) >> np.uint64(57)).astype(np.int64), minlength=CELLS)
    bits = np.packbits(np.concatenate([counts >= 1, counts >= 2])).view(np.int64)
    return [*bits.tolist(), int(np.maximum(counts - 2, 0).sum())]


def _shared(part: str) -> Column:
    """The bound of what two members share by their codes, whose columns of the second end in _b."""
    both = sum((F.bit_count(F.col(f"{part}_{k}").bitwiseAND(F.col(f"{part}_{k}_b"))) for k in range(1, 4)), F.bit_count(F.col(f"{part}_0").bitwiseAND(F.col(f"{part}_0_b"))))
    return both + F.least(f"{part}_4", f"{part}_4_b")


def _bounds(pairs: DataFrame, sketched: DataFrame) -> DataFrame:
    """What limits the links between the members b of buckets with the class a that all were compared to: a, b, inside, common, CODES.

    inside is how many shingles a member shares with a, common how many of its others some other member
    compared to a has too. Two members share at most the smaller inside plus the smaller common, and what the codes of
    their shingles inside and outside of a allow.
    """
    names = ["a", "b", "inside", "shingle", "other", *CODES]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, x, y in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), batch.column("hashes_a"), batch.column("hashes_b"), strict=True):
                s, t = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                there = s[np.minimum(np.searchsorted(s, t), len(s) - 1)] == t
                n = int((~there).sum()) + 1
                codes = [pa.array(np.append(np.zeros(n - 1, np.int64), c)) for c in (*_code(t[there]), *_code(t[~there]))]
                columns = [pa.array(np.full(n, a)), pa.array(np.full(n, b)), pa.array(np.full(n, there.sum())), pa.array(np.append(t[~there].view(np.int64), 0)), pa.array(np.arange(n) < n - 1)]
                yield pa.RecordBatch.from_arrays([*columns, *codes], names=names)

    rows = materialize(_with_both(materialize(pairs, "pairs"), sketched, ["hashes"]).mapInArrow(words.lean(run), "a long, b long, inside long, shingle long, other boolean, " + ", ".join(f"{c} long" for c in CODES)), "outside")
    shared = rows.filter("other").groupBy("a", "shingle").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("a", "shingle")
    common = rows.filter("other").join(shared, ["a", "shingle"]).groupBy("a", "b").agg(F.count(F.lit(1)).alias("common"))
    return materialize(rows.filter("NOT other").select("a", "b", "inside", *CODES).join(common, ["a", "b"], "left").fillna(0, ["common"]), "bounds")


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Components of documents that are linked by similarity.

    Returns a row for each row of docs: doc_id, n_shingles, component_id (the smallest doc_id that links reach),
    kept (doc_id = component_id), text_hash. Texts are lower-cased in A-Z; a document's set holds its different
    5-word shingles, or its whole sequence if it has fewer words. Two sets are linked if
    100 * intersection >= 75 * union.

    Documents with equal sets are a class, of which one row goes on. Classes that share a band fall in a
    bucket. In each bucket all are compared to the one that meets most others; links make components. Where a bucket
    still holds several components, the remaining pairs of different components are compared too, except those
    whose sizes, or whose shares inside and outside of the class that all were compared to, rule a link out. So no link
    between components is missed, and a large group of copies costs a comparison for each, not for each pair.
    Registers are compared first, then the sets.

    Very long texts are taken whole, slice by slice of their words. Null and empty texts, and texts of white space, have an empty set: they are linked with nothing. A null doc_id
    can't be the smallest, unless the whole component has none; it is kept if it stands alone. Repeated rows
    are a class; all that carry the component's id are marked kept. An empty table gives an empty result.
    Other columns aren't read.
    """
    sketched = materialize(sketch(docs, id_col, text_col), "sketches")
    slim = sketched.select("uid", "doc_id", "text_hash", "n", "set_key")
    several = slim.filter("set_key IS NOT NULL").groupBy("set_key").agg(F.min("uid").alias("first_uid"), F.count(F.lit(1)).alias("copies")).filter("copies > 1")
    several = materialize(several.select(F.col("set_key").alias("s_key"), "first_uid"), "classes")
    with_class = lambda rows: rows.join(small(several), F.col("set_key") == F.col("s_key"), "left")

    firsts = with_class(sketched.select("uid", "n", "set_key", "bands")).filter("set_key IS NOT NULL AND (first_uid IS NULL OR first_uid = uid)")
    banded = firsts.select("uid", "n", F.explode("bands").alias("band"))
    sizes = banded.groupBy("band").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    crowded = materialize(banded.join(sizes, "band"), "buckets")
    # The class that meets most others is the likeliest to be what they are copies of.
    ranked = crowded.join(crowded.groupBy("uid").agg(F.sum("size").alias("met")), "uid").select("band", "uid", "n", "met")
    hubs = ranked.groupBy("band").agg(F.max(F.struct("met", (-F.col("uid")).alias("least"), "n")).alias("hub"))
    crowded = materialize(crowded.join(hubs, "band").select("band", "uid", "n", (-F.col("hub.least")).alias("hub"), F.col("hub.n").alias("hub_n")), "buckets")

    near = lambda x, y: DENOMINATOR * F.least(x, y) >= NUMERATOR * F.greatest(x, y)
    first = crowded.filter((F.col("uid") != F.col("hub")) & near(F.col("n"), F.col("hub_n"))).select(F.col("hub").alias("a"), F.col("uid").alias("b")).distinct()
    links = verify(materialize(first, "pairs"), sketched)
    roots = components(links)

    placed = crowded.join(small(roots), F.col("uid") == F.col("node"), "left").withColumn("part", F.coalesce("root", "uid")).drop("node", "root")
    placed = materialize(placed, "placed")
    open_bands = placed.groupBy("band").agg(F.min("part").alias("low"), F.max("part").alias("high")).filter("low < high").select("band")
    left = materialize(placed.join(small(open_bands), "band", "left_semi").filter("uid <> hub"), "open")
    bounds = _bounds(left.select(F.col("hub").alias("a"), F.col("uid").alias("b")).distinct(), sketched)
    left = materialize(left.join(small(bounds), (F.col("hub") == F.col("a")) & (F.col("uid") == F.col("b"))).drop("a", "b"), "open")
    other = left.select("band", F.col("uid").alias("b"), F.col("n").alias("n_b"), F.col("part").alias("part_b"), F.col("inside").alias("inside_b"), F.col("common").alias("common_b"), *(F.col(c).alias(f"{c}_b") for c in CODES))
    most = F.least(F.col("inside"), F.col("inside_b"), _shared("in")) + F.least(F.col("common"), F.col("common_b"), _shared("out"))
    can = (NUMERATOR + DENOMINATOR) * most >= NUMERATOR * (F.col("n") + F.col("n_b"))
    rest = left.join(other, (left["band"] == other["band"]) & (F.col("uid") < F.col("b")) & (F.col("part") != F.col("part_b")) & near(F.col("n"), F.col("n_b")) & can).select(F.col("uid").alias("a"), "b").distinct()
    more = verify(materialize(rest, "pairs"), sketched)
    roots = components(links.unionByName(more))

    rows = with_class(slim).withColumn("class", F.coalesce("first_uid", "uid"))
    rows = rows.join(small(roots), F.col("class") == F.col("node"), "left")
    # A root isn't in the list of nodes: it is known by those that point to it.
    tops = roots.select(F.col("root").alias("top")).distinct()
    rows = rows.join(small(tops), F.col("class") == F.col("top"), "left")
    rows = rows.select("doc_id", "text_hash", F.col("n").alias("n_shingles"), F.coalesce("root", "class").alias("part"), (F.col("first_uid").isNotNull() | F.col("node").isNotNull() | F.col("top").isNotNull()).alias("grouped"))
    rows = materialize(rows, "parts")
    together = grouped(rows.filter("grouped"), ["part"], F.struct("doc_id", "text_hash"), {"least": F.min("doc_id")}, {"component_id": F.min("least")})
    alone = rows.filter("NOT grouped").withColumn("component_id", F.col("doc_id"))
    out = together.select("doc_id", "n_shingles", "component_id", "text_hash").unionByName(alone.select("doc_id", "n_shingles", "component_id", "text_hash"))
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "text_hash")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs of which one stays for each component, with all their columns; those with an empty set all stay.

    Of rows that are equal in id and text any one stays. Null ids and texts, ties and empty tables are taken as near_dedup() does;
    columns of docs may have any names, and very long texts are compared whole.
    """
    with scratch() as made:
        found = near_dedup(docs, id_col, text_col).withColumnsRenamed({"doc_id": "key_id", "text_hash": "key_hash"})
        found = materialize(found.select("key_id", "key_hash", "kept", "n_shingles"), "kept")
    for path in made[:-1]:  # sketches and pairs aren't needed any more
        remove(path)
    rows = without(with_key(docs, id_col, text_col), found.filter("NOT kept"))
    return once(rows, found.filter("kept AND n_shingles > 0")).select("row.*")


def op2_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("text_hash")


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
                                      WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS shingle
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS both_have FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM i JOIN n p ON a = p.doc_id JOIN n q ON b = q.doc_id WHERE 100 * both_have >= 75 * (p.n + q.n - both_have)),
r AS (SELECT doc_id, doc_id AS reached FROM w UNION SELECT r.doc_id, l.b FROM r JOIN l ON r.reached = l.a)
SELECT r.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(reached) AS component_id, r.doc_id = min(reached) AS kept
FROM r LEFT JOIN n ON r.doc_id = n.doc_id GROUP BY r.doc_id
"""
