"""Benchmark decontamination by template windows: numbers, names and units are slots whose values must agree."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from casemill.llm import words
from casemill.llm.shared import materialize, small, with_key, without

#: Words of a window, and the part of an item's windows that makes a document contaminated.
WIDTH, SHARE = 5, 0.75
#: A window with fewer plain words than this is met only as it is.
PLAIN = 2
#: Windows whose shifts against the item's differ by less than half of this (by words added or left out) are also judged together.
NEAR = 16
#: Up to this many different benchmark windows (16 MB) are sent to the tasks, which then send matching windows only.
KNOWN_WINDOWS = 2_000_000
#: Words that count as a unit behind a number, or joined to one.
UNITS = (
    "mm cm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres kilometer kilometers kilometre kilometres "
    "mg g kg t lb lbs oz gram grams kilogram kilograms ton tons tonne tonnes pound pounds ounce ounces ml l liter liters litre litres gallon gallons "
    "s sec secs min mins h hr hrs second seconds minute minutes hour hours day days week weeks month months year years "
    "w kw v a hz khz mhz ghz j kj cal kcal pa kpa n kmh km/h mph m/s percent % dollar dollars euro euros cent cents degree degrees °c °f c f"
).split()
#: Words that sentences begin with, in lower case, and that are no names there.
STARTS = (
    "a about after all also an and another any are as at be because before both but by can could did do does during each either even every few find finally first following for from given "
    "had has have having he hence her here his how however i if in instead is it its last later let many may more moreover most must my neither next no none nor not now of on once one only or other our out over "
    "please second several she should since so some still such than that the their then there therefore these they this those though through thus to today tomorrow two three under until up upon use was we were what "
    "when where whether which while who whom whose why will with without would yesterday yet you your "
    "aber alle als am an auch auf aus bei bis da damit dann das dass dem den denn der des die dies diese dieser dieses doch du durch ein eine einem einen einer eines er es für gegen hat ich ihr im in ist ja jede jeder jedes kein keine "
    "man mit nach nicht noch nun nur ob oder ohne sie sind so und unter vom von vor wann war warum was weil wenn wer werden wie wieviel wir wird wo zu zum zur zwischen über "
    "au aucun aussi aux avant avec car ce cela ces cet cette chaque combien comme comment dans de depuis des donc du elle elles en est et il ils je la le les leur lorsque mais ne nous on ou où par pendant plus pour pourquoi puis quand que quel quelle qui "
    "sans se selon ses si son sous sur un une vous à "
    "al algunos antes aunque cada como con cuando cuál cuántas cuántos cuánto cuánta de del desde después donde durante el ella ellas ellos en entonces entre era es esa ese esta este esto está hasta hay la las lo los luego mientras muy más ni no nos o otra otro para "
    "pero por porque pues que quien qué se según ser si sin sobre su sus también todo todos tras un una uno y ya yo cómo dónde cuándo quién"
).split()
NUMBER = re.compile(r"[$€£]?[+-]?\d[\d.,:/]*(?:%|(?P<unit>[a-z°/]+))?")
EDGES = ".,;:!?\"'()[]{}|*<>-"
KINDS = {"number": 1, "unit": 2, "name": 3}
_SLOTS = words.mix(np.arange(1, 5, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def canonical(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Where each text's words begin, the hash of each word, its slot (0 plain, 1 number, 2 unit, 3 name), and whether it may
    be a name at the beginning of a sentence, and may go on with the name before it.

    Words lose marks at their edges and their case; those of marks only are left out. A number may have a unit or
    a currency joined to it. A unit is such a word right behind a number. A name is a word with a capital
    first letter, not at the beginning of a sentence. There, a word with a capital that isn't one of STARTS may be a name.
    """
    begins, codes, different = words.split(texts, lower=False)
    bare = pc.ascii_trim(different, characters=EDGES)
    small = pc.utf8_lower(bare)
    flags = lambda x: x.to_numpy(zero_copy_only=False).astype(bool)
    number = flags(pc.match_substring_regex(small, r"^[$€£]?[+-]?\d"))
    for i in np.flatnonzero(number):
        m = NUMBER.fullmatch(small[i].as_py())
        number[i] = m is not None and (m["unit"] is None or m["unit"] in UNITS)
    unit = flags(pc.is_in(small, value_set=pa.array(UNITS, pa.large_string())))
    capital = flags(pc.match_substring_regex(bare, r"^\p{Lu}"))
    start = capital & ~flags(pc.is_in(small, value_set=pa.array(STARTS, pa.large_string())))
    stop = flags(pc.match_substring_regex(different, r"[.!?]$|[:;]$|[.!?].$"))
    comma = flags(pc.match_substring_regex(different, r"[,)\]]$"))
    hashes = words.hashes(small)
    full = flags(pc.greater(pc.binary_length(bare), 0))[codes]
    begins = np.concatenate([[0], np.cumsum(full)])[begins]
    codes = codes[full]
    before = np.concatenate([[-1], codes[:-1]])[: len(codes)]
    before[begins[:-1][np.diff(begins) > 0]] = -1
    first = (before < 0) | stop[before]
    slot = np.where(number[codes], 1, np.where(unit[codes] & (before >= 0) & number[before], 2, np.where(capital[codes] & ~first, 3, 0)))
    return begins, hashes[codes], slot, first & start[codes] & (slot == 0), ~first & ~comma[before]


def _wanted(hashes: np.ndarray, known: np.ndarray | None) -> np.ndarray:
    """The places of the hashes that the sorted array `known` has; of all, if it is None."""
    if known is None:
        return np.arange(len(hashes))
    if not len(known):
        return np.zeros(0, np.int64)
    return np.flatnonzero(known[np.minimum(np.searchsorted(known, hashes), len(known) - 1)] == hashes)


def _templates(begins: np.ndarray, plain: np.ndarray, slot: np.ndarray, real: np.ndarray, known: np.ndarray | None) -> tuple[np.ndarray, ...]:
    """Windows that are wanted and have slots, a new one and PLAIN plain words at least: each one's text, first token, hash, values and last token's end.

    real tells of each token whether a window needs it to be new.
    """
    shaped, counts = words.windows(np.where(slot > 0, _SLOTS[slot], plain), begins, WIDTH)
    kept = _wanted(shaped, known)
    owner = np.repeat(np.arange(len(counts)), counts)[kept]
    first = begins[:-1][owner] + kept - (np.cumsum(counts) - counts)[owner]
    after = np.minimum(first + WIDTH, begins[1:][owner])
    filled, new = (np.concatenate([[0], np.cumsum(x, dtype=np.int32)]) for x in (slot > 0, real))
    n_slots = filled[after] - filled[first]
    fit = np.flatnonzero((n_slots > 0) & (after - first - n_slots >= PLAIN) & (new[after] > new[first]))
    kept, owner, first, after = kept[fit], owner[fit], first[fit], after[fit]
    place = first[:, None] + np.arange(WIDTH)
    inside = place < after[:, None]
    place = np.minimum(place, max(0, len(plain) - 1))
    slots = np.where(inside, slot[place], 0)
    values = np.where(slots > 0, words.mix(plain[place] ^ slots.astype(np.uint64)), 0).astype(np.uint64)
    return owner, first, shaped[kept], values, after


def template_windows(texts: pa.Array, known: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Windows of all texts, or those in the sorted array `known`: each one's text and first word in it, hash, slot values (0 for plain words), and how many windows of WIDTH words it stands for.

    Every window is given as it is, without slots. One that has slots, and PLAIN plain words at least, is also given as a
    template; once more with a run of name words as one slot, where it has such a run; and so with words at the beginning of
    a sentence as names, where it has one that may be. A text of fewer than WIDTH words has one window, of all of them.
    """
    begins, plain, slot, start, on = canonical(texts)
    exact, counts = words.windows(plain, begins, WIDTH)
    exact ^= np.uint64(0x5851F42D4C957F2D)
    kept = _wanted(exact, known)
    owner = np.repeat(np.arange(len(counts)), counts)[kept]
    found = [(owner, kept - (np.cumsum(counts) - counts)[owner], exact[kept], np.zeros((len(kept), WIDTH), np.uint64), np.ones(len(kept), np.int64))]
    owner, first, hashes, values, _ = _templates(begins, plain, slot, slot > 0, known)
    found.append((owner, first - begins[:-1][owner], hashes, values, np.ones(len(owner), np.int64)))
    name = slot == 3
    for names in (name, name | start):
        goes_on = np.zeros(len(names), bool)
        goes_on[1:] = names[1:] & names[:-1] & on[1:]
        if not (goes_on if names is name else start).any():
            continue
        heads = np.flatnonzero(~goes_on)
        length = np.diff(np.concatenate([heads, [len(names)]]))
        turn = (np.arange(len(names)) - np.repeat(heads, length)).astype(np.uint64)
        whole = np.add.reduceat(np.where(turn > 0, words.mix(plain + turn), plain), heads)
        kinds = np.where(names, 3, slot)[heads]
        folded = np.searchsorted(heads, begins)
        new = length > 1 if names is name else start[heads]
        owner, first, hashes, values, after = _templates(folded, whole, kinds, new, known)
        # A window stands for those that begin in its first token, and the last one of a text for the rest.
        begin, end = heads[first], begins[1:][owner]
        rest = np.maximum(begin + 1, end - WIDTH + 1)
        span = np.where(after == folded[1:][owner], rest - begin, length[first])
        found.append((owner, begin - begins[:-1][owner], hashes, values, span))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _rows(ids: pa.Array, uid: np.ndarray, owner: np.ndarray, at: np.ndarray, hashes: np.ndarray, values: np.ndarray, span: np.ndarray) -> pa.RecordBatch:
    slots = pa.ListArray.from_arrays(pa.array(np.arange(0, WIDTH * len(at) + 1, WIDTH), pa.int32()), pa.array(values.reshape(-1).view(np.int64)))
    columns = [ids.take(pa.array(owner)), pa.array(uid[owner]), pa.array(at), pa.array(hashes.view(np.int64)), slots, pa.array(span)]
    return pa.RecordBatch.from_arrays(columns, names=["id", "uid", "at", "window", "slots", "span"])


SCHEMA = "id long, uid long, at long, window long, slots array<long>, span long"


def windows_of(table: DataFrame, id_col: str, text_col: str, known: np.ndarray | None = None, with_texts: bool = False) -> DataFrame:
    """A row for each window of each text, or of those in the sorted array `known`; with_texts adds a row for each text, where at is -1 and window the text's hash."""
    shared = None if known is None else table.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        words.forget()
        number = TaskContext.get().partitionId() << 36
        for batch in words.slices(batches, "text"):
            owner, at, hashes, values, span = template_windows(batch.column("text"), None if shared is None else shared.value)
            uid = number + np.arange(batch.num_rows)
            number += batch.num_rows
            if with_texts:
                n = batch.num_rows
                yield _rows(batch.column("id"), uid, np.arange(n), np.full(n, -1), batch.column("text_hash").to_numpy().view(np.uint64), np.zeros((n, WIDTH), np.uint64), np.ones(n, np.int64))
            if len(at):
                yield _rows(batch.column("id"), uid, owner, at, hashes, values, span)

    return table.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("text_hash")).mapInArrow(words.lean(run), SCHEMA)


def _meet(left: DataFrame, right: DataFrame, how: str, *names: str) -> DataFrame:
    right = right.select(*(F.col(n).alias(f"r_{n}") for n in names))
    on = [F.col(n).eqNullSafe(F.col(f"r_{n}")) if n == "item_id" else F.col(n) == F.col(f"r_{n}") for n in names]
    return left.join(right, on, how)


def decontaminate(docs: DataFrame, benchmark: DataFrame, share: float = SHARE, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Finds documents that hold a benchmark item, also with other numbers, names or units.

    Returns a row for each row of docs: doc_id, contaminated, item_ids (of the items found, ascending), share (the largest
    part of an item's windows found), text_hash. An item is found if at least `share` of its windows are. Windows of WIDTH
    words meet by an equi-join on their hashes, as they are and with slots in place of numbers, names and units.
    Windows met as they are always count. Of those met with slots, at one place of a document, a slot value of the item must
    stand for one value of the document and the other way round: the most frequent pairing counts, and windows that contradict
    it don't. Places are windows that are shifted alike against the item's, those whose shifts are close (NEAR), and
    the document as a whole; the place with most windows decides.

    A null or empty text has no windows: such documents are clean, and such items are never found. An item
    with fewer than WIDTH words is found in documents of just those words. Null ids are allowed; items without an id aren't
    listed, but found. Repeated rows are judged each; repeated items are one. Empty tables give all documents as clean, or no
    rows. Very long texts are searched whole. Other columns aren't read, and may have any names.
    """
    items = materialize(windows_of(benchmark, item_id_col, item_text_col), "items")
    items = materialize(items.select(F.col("id").alias("item_id"), F.col("window").alias("key"), F.col("slots").alias("item_slots"), F.col("at").alias("item_at"), "span").distinct(), "items")
    known = None
    if (different := items.select("key").distinct()).limit(KNOWN_WINDOWS + 1).count() <= KNOWN_WINDOWS:
        known = np.sort(different.toArrow()["key"].to_numpy().view(np.uint64))
    found = materialize(windows_of(docs, id_col, text_col, known, with_texts=True), "windows")

    sizes = items.filter(~F.exists("item_slots", lambda x: x != 0)).groupBy("item_id").agg(F.countDistinct("item_at").alias("item_windows"))
    hits = found.filter("at >= 0").drop("span").join(small(items), F.col("window") == F.col("key")).select("uid", "item_id", "at", "item_at", "span", "key", "slots", "item_slots")
    hits = materialize(hits, "hits")
    has = F.exists("item_slots", lambda x: x != 0)
    exact = hits.filter(~has).select("uid", "item_id", "item_at").distinct()
    shift = F.col("at") - F.col("item_at")
    band = lambda offset: F.floor((shift + offset) / NEAR)
    places = F.array(F.lit(0).cast("long"), 4 * shift + 1, 4 * band(0) + 2, 4 * band(NEAR // 2) + 3)
    shaped = hits.filter(has).withColumn("place", F.explode(places))
    filled = shaped.select("uid", "item_id", "place", "at", "item_at", "key", F.explode(F.arrays_zip("slots", "item_slots")).alias("s"))
    filled = materialize(filled.select("uid", "item_id", "place", "at", "item_at", "key", F.col("s.slots").alias("own"), F.col("s.item_slots").alias("its")).filter("its <> 0"), "slots")
    pairs = filled.groupBy("uid", "item_id", "place", "own", "its").agg(F.count(F.lit(1)).alias("n"))
    best = lambda of, per: F.max(F.struct("n", of)).over(Window.partitionBy("uid", "item_id", "place", per))[of]
    odd = pairs.withColumns({"best_own": best("own", "its"), "best_its": best("its", "own")}).filter("own <> best_own OR its <> best_its")
    bad = _meet(filled, odd, "left_semi", "uid", "item_id", "place", "own", "its").select("uid", "item_id", "place", "at", "item_at", "key").distinct()
    good = _meet(shaped, bad, "left_anti", "uid", "item_id", "place", "at", "item_at", "key")
    good = good.select("uid", "item_id", "place", F.explode(F.sequence("item_at", F.col("item_at") + F.col("span") - 1)).alias("item_at")).distinct()

    # Windows met as they are count wherever they are; to them come those met as templates at the best place.
    more = _meet(good, exact, "left_anti", "uid", "item_id", "item_at").groupBy("uid", "item_id", "place").agg(F.count(F.lit(1)).alias("n"))
    covered = exact.groupBy("uid", "item_id").agg(F.count(F.lit(1)).alias("n")).unionByName(more.groupBy("uid", "item_id").agg(F.max("n").alias("n")))
    covered = covered.groupBy("uid", "item_id").agg(F.sum("n").alias("got"))
    sizes = sizes.select(F.col("item_id").alias("size_id"), "item_windows")
    parts = covered.join(small(sizes), F.col("item_id").eqNullSafe(F.col("size_id"))).withColumn("part", F.col("got") / F.col("item_windows"))
    judged = parts.groupBy("uid").agg(F.max("part").alias("share"), F.sort_array(F.collect_set(F.when(F.col("part") >= share, F.col("item_id")))).alias("item_ids"))
    judged = materialize(judged, "judged").withColumnRenamed("uid", "j_uid")
    texts = found.filter("at = -1").select("id", "uid", F.col("window").alias("text_hash"))
    rows = texts.join(small(judged), F.col("uid") == F.col("j_uid"), "left")
    none = F.array().cast("array<long>")
    return rows.select(F.col("id").alias("doc_id"), F.coalesce(F.col("share") >= share, F.lit(False)).alias("contaminated"), F.coalesce("item_ids", none).alias("item_ids"), F.coalesce("share", F.lit(0.0)).alias("share"), "text_hash")


def clean_of(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that hold no benchmark item, with all their columns.

    Null, empty and very long texts, null ids, ties and empty tables are taken as decontaminate() does; equal rows stay or go together.
    Columns of docs may have any names.
    """
    found = decontaminate(docs, benchmark, id_col=id_col, text_col=text_col).filter("contaminated").withColumnsRenamed({"doc_id": "key_id", "text_hash": "key_hash"})
    return without(with_key(docs, id_col, text_col), found).select("row.*")


def op7_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return decontaminate(docs, benchmark).drop("text_hash")
