"""Mixing sources to target weights along a time-varying curriculum, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casemill.llm.shared import WORD, materialize, n_partitions, once, row_hash, running, small, with_key

#: Weights of the sources in order of their names, repeated.
WEIGHTS = (5, 2, 1)
#: No document is taken more often than this.
MAX_REPEATS = 3
#: Times that a source's missing words are filled by the largest document that still fits, before the nearest one is tried.
FILLS = 2
#: The curriculum's course by turns: parts of a source's weight at these times, linear between them. Each has the integral 1.
TIMES, COURSES = (0.0, 0.5, 1.0), ((1.75, 0.75, 0.75), (0.75, 0.75, 1.75))
#: The integral of piecewise linear weights from the first knot to that with the given number.
AREA = "aggregate(sequence(1, {last}), cast(0 as double), (s, i) -> s + (knots[i].t - knots[i - 1].t) * (knots[i].w + knots[i - 1].w) / 2)"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def curriculum(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, times: tuple[float, ...] = TIMES, courses: tuple[tuple[float, ...], ...] = COURSES) -> DataFrame:
    """A schedule: sources by code point, null last, get the weights in turn, and the courses over time in turn."""
    ranked = running(sources.select("source"), [F.col("source").asc_nulls_last()], {})
    turn = lambda values: F.element_at(F.array(*values), ((F.col("row_no") - 1) % len(values) + 1).cast("int"))
    course = turn([F.array(*map(F.lit, c)) for c in courses])
    ranked = ranked.select("source", turn([F.lit(float(w)) for w in weights]).alias("weight"), course.alias("course"))
    return ranked.select("source", F.array(*(F.struct(F.lit(t).alias("t"), (F.col("weight") * F.col("course")[i]).alias("w")) for i, t in enumerate(times))).alias("knots"))


def source_targets(sources: DataFrame, schedule: DataFrame, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """For each source its share of all words by its integrated weight, capped at max_repeats times its size.

    sources: source, source_size. schedule: source, knots (array of t, w; t from 0 to 1, ascending; between
    knots the weight is linear). The excess of capped sources goes to the others by weight until none is
    above: with sources by size over weight, the capped ones come first, so running sums find them.
    A source that the schedule lacks has the weight 0.
    """
    area = F.expr(AREA.format(last="size(knots) - 1"))
    weighted = sources.join(schedule.withColumnRenamed("source", "s_source"), F.col("source").eqNullSafe(F.col("s_source")), "left").drop("s_source")
    weighted = weighted.withColumn("weight", F.coalesce(F.when(F.size("knots") > 1, area), F.lit(0.0))).withColumn("cap", F.when(F.col("weight") > 0, F.col("source_size") * max_repeats).otherwise(0))
    order = [F.when(F.col("weight") > 0, F.col("cap") / F.col("weight")).otherwise(0.0), F.col("source").asc_nulls_last()]
    ranked = materialize(running(weighted, order, {"cap_before": "cap", "weight_before": "weight"}), "targets")
    total, weights = ranked.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0.0))).first()
    capped = F.col("cap") * (weights - F.col("weight_before")) <= (total - F.col("cap_before")) * F.col("weight")
    ranked = ranked.withColumn("capped", capped)
    used, gone = ranked.filter("capped").agg(F.coalesce(F.sum("cap"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0.0))).first()
    share = F.lit(float(total - used)) * F.col("weight") / F.lit(float(weights - gone))
    areas = F.expr(f"transform(sequence(0, size(knots) - 1), k -> if(k = 0, cast(0 as double), {AREA.format(last='k')}))")
    return ranked.select("source", "source_size", "knots", areas.alias("areas"), "weight", F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(share).alias("target"))


def _left(rows: DataFrame) -> DataFrame:
    """How many words each source still wants, and how many it wants beyond its whole passes."""
    taken = rows.groupBy("source").agg(F.coalesce(F.sum(F.when(F.col("more"), F.col("size"))), F.lit(0)).alias("got"), F.max("rest").alias("want"))
    return materialize(taken.select(F.col("source").alias("l_source"), (F.col("want") - F.col("got")).alias("left"), "got"), "left")


def _filled(rows: DataFrame) -> DataFrame:
    """Takes documents that aren't taken, in their order and as far as they fit, again and again until none fits any more."""
    while True:
        rows = materialize(rows, "mixing")
        fits = rows.join(small(_left(rows)), F.col("source").eqNullSafe(F.col("l_source"))).filter(~F.col("more") & (F.col("size") > 0) & (F.col("size") <= F.col("left")))
        fits = materialize(fits.select("source", F.col("row_no").alias("f_row"), "size", "left", "got"), "fits")
        if fits.isEmpty():
            return rows
        placed = running(fits, [F.col("f_row")], {"f_before": "size"}, ("source",)).filter(F.col("f_before") + F.col("size") <= F.col("left"))
        placed = materialize(placed.select(F.col("source").alias("f_source"), "f_row", (F.col("got") + F.col("f_before")).alias("f_place")), "fill")
        rows = rows.join(small(placed), F.col("source").eqNullSafe(F.col("f_source")) & (F.col("row_no") == F.col("f_row")), "left")
        rows = rows.withColumns({"more": F.col("more") | F.col("f_row").isNotNull(), "rest_before": F.coalesce("f_place", "rest_before")}).drop("f_source", "f_row", "f_place")


def mix(docs: DataFrame, schedule: DataFrame | None = None, max_repeats: int = MAX_REPEATS, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", row_key: Column | None = None) -> DataFrame:
    """Decides how often each document is taken, and at which time of the training first.

    Returns a row for each row of docs: doc_id, source, size (words), source_size, target, copies, taken (size
    times copies), position (from 0 to 1; null if it isn't taken), text_hash (or row_key, if it is given), and what copy_positions() needs.

    A source of size S and target t takes each document t div S times; the rest goes to documents in the order
    of the MD5 of their ids as far as they fit, and what is then missing to the largest that still fit, FILLS
    times, then in that order again to all that fit, until none does, and at last to the one that comes nearest, if it comes
    nearer than none. Documents are taken whole. A document's words stand at a place in its source's demand; the
    schedule's integral is inverted there to give its position. Without a schedule that of curriculum() holds.

    A very long text counts whole, and is taken or left whole; it may miss a small source's target by its size. A null text has size 0 and is taken, at no cost, like others. Null sources are a source. Repeated rows are
    mixed each by itself; rows with null ids come first. An empty table gives an empty result. Other columns
    are not read. Running it again gives the same rows.
    """
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).alias("source"), n_words(F.col(text_col)).alias("size"), (F.xxhash64(text_col) if row_key is None else row_key).alias("text_hash"))
    slim = slim.withColumn("lot", F.md5(F.col("doc_id").cast("string")))
    # Running sums are by range partitions: a source with a third of the rows takes many tasks.
    placed = materialize(running(slim, [F.col("lot").asc_nulls_first(), F.col("doc_id").asc_nulls_first(), F.col("size")], {"before": "size"}, ("source",)), "placed")
    sources = materialize(placed.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    targets = materialize(source_targets(sources, curriculum(sources) if schedule is None else schedule, max_repeats), "targets")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    targets = targets.withColumn("whole", whole.cast("long")).withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))

    names = targets.select(F.col("source").alias("t_source"), "source_size", "target", "weight", "knots", "areas", "whole", "rest")
    on = F.col("source").eqNullSafe(F.col("t_source"))
    rows = placed.join(small(names), on, "left").drop("t_source").withColumn("more", (F.col("before") + F.col("size") <= F.col("rest")) & (F.col("rest") > 0))
    rows = rows.withColumn("rest_before", F.col("before"))
    for turn in range(FILLS + 1):
        if turn == FILLS:
            rows = _filled(rows)
        left = _left(rows).drop("got")
        most = F.col("left") if turn < FILLS else 2 * F.col("left") - 1e-6
        fits = rows.join(small(left), F.col("source").eqNullSafe(F.col("l_source"))).filter(~F.col("more") & (F.col("size") > 0) & (F.col("size") <= most))
        best = fits.groupBy("l_source").agg(F.max(F.struct(-F.abs(F.col("left") - F.col("size")), (-F.col("row_no")).alias("row"))).alias("fill"))
        best = materialize(best.select(F.col("l_source").alias("f_source"), (-F.col("fill.row")).alias("f_row")), "fill")
        rows = rows.join(small(best), F.col("source").eqNullSafe(F.col("f_source")) & (F.col("row_no") == F.col("f_row")), "left")
        rows = rows.withColumn("more", F.col("more") | F.col("f_row").isNotNull()).drop("f_source", "f_row")
    rows = rows.withColumn("copies", F.col("whole") + F.col("more").cast("long"))
    rows = rows.withColumn("copies", F.when(F.col("target") > 0, F.col("copies")).otherwise(F.lit(0)))
    return rows.withColumn("taken", F.col("copies") * F.col("size")).withColumn("position", position_of(F.lit(1)))


def position_of(copy: Column) -> Column:
    """The time of the copy with that number, from 1, of a row of mix(); null if there is none.

    The demand before it is that of the whole passes and of the earlier rows of its own pass. The integral
    of the schedule at each knot finds the segment; in it, half of the slope times x squared plus the first
    weight times x is what is still wanted.
    """
    place = F.when(copy <= F.col("whole"), (copy - 1) * F.col("source_size") + F.col("before"))
    place = place.otherwise(F.col("whole") * F.col("source_size") + F.greatest(F.lit(0.0), F.least(F.col("rest_before").cast("double"), F.col("rest") - F.col("size"))))
    want = F.least(F.lit(1.0), place / F.col("target")) * F.col("weight")
    at = F.greatest(F.lit(1), F.least(F.size(F.filter("areas", lambda x: x <= want)), F.size("knots") - 1))
    first, second, still = F.element_at("knots", at), F.element_at("knots", at + 1), F.greatest(F.lit(0.0), want - F.element_at("areas", at))
    width = second["t"] - first["t"]
    slope = (second["w"] - first["w"]) / width
    below = first["w"] + F.sqrt(F.greatest(F.lit(0.0), first["w"] * first["w"] + 2 * slope * still))
    x = F.when(below > 0, F.least(width, 2 * still / below)).otherwise(0.0)
    return F.when((copy <= F.col("copies")) & (F.col("target") > 0), first["t"] + x)


def copy_positions(mixed: DataFrame) -> DataFrame:
    """One row for each copy that is taken, with copy (from 1) and its position, range-sorted by position."""
    copies = mixed.filter("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return in_order(copies.withColumn("position", position_of(F.col("copy"))))


def in_order(rows: DataFrame) -> DataFrame:
    """Range-sorts rows by position, then by id."""
    order = [F.col("position").asc_nulls_last(), F.col("doc_id").asc_nulls_first()]
    return rows.repartitionByRange(n_partitions(rows.sparkSession), *order).sortWithinPartitions(*order)


def mixed_rows(docs: DataFrame, schedule: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of docs as often as they are taken, range-sorted by position, with all their columns.

    Null, empty and very long texts, null ids and sources, and ties are taken as mix() does. Repeated rows are taken each by itself;
    rows of one id and text that differ in other columns are told apart. An empty table stays empty; columns may have any names.
    """
    mixed = materialize(mix(docs, schedule, MAX_REPEATS, id_col, text_col, source_col, row_key=row_hash(docs)), "mixed").withColumnsRenamed({"doc_id": "key_id", "text_hash": "key_hash"})
    rows = once(with_key(docs, id_col, text_col, whole=True), mixed)
    copies = mixed.filter("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    copies = copies.select(F.col("key_id").alias("its_id"), F.col("key_hash").alias("its_hash"), position_of(F.col("copy")).alias("mix_position"))
    taken = rows.join(small(copies), F.col("key_id").eqNullSafe(F.col("its_id")) & (F.col("key_hash") == F.col("its_hash")))
    order = [F.col("mix_position"), F.col("key_id").asc_nulls_first()]
    return taken.repartitionByRange(n_partitions(docs.sparkSession), *order).sortWithinPartitions(*order).select("row.*")


def op3_mixing(spark, sf_dir: str) -> DataFrame:
    mixed = in_order(mix(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies", F.round("position", 6).alias("position"))


_FILL = """
l{n} AS (
  SELECT source, max(rest) - coalesce(sum(CASE WHEN more THEN size END), 0) AS missing FROM m{m} GROUP BY source),
f{n} AS (
  SELECT m.source, m.row_no, row_number() OVER (PARTITION BY m.source ORDER BY abs(missing - size), row_no) AS best
  FROM m{m} m JOIN l{n} l ON m.source IS NOT DISTINCT FROM l.source
  WHERE NOT more AND size > 0 AND size <= {most}),
m{n} AS (
  SELECT m.* EXCLUDE (more), m.more OR f.row_no IS NOT NULL AS more
  FROM m{m} m LEFT JOIN f{n} f ON m.source IS NOT DISTINCT FROM f.source AND m.row_no = f.row_no AND f.best = 1)"""

ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size, md5(doc_id::VARCHAR) AS lot FROM documents),
p AS (
  SELECT *, row_number() OVER w AS row_no, coalesce(sum(size) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d WINDOW w AS (PARTITION BY source ORDER BY lot NULLS FIRST, doc_id NULLS FIRST, size)),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][(rank - 1) % 3 + 1]::DOUBLE AS weight, source_size * 3 AS cap, (rank - 1) % 2 AS course FROM s),
c AS (
  SELECT *, coalesce(sum(cap) OVER o, 0) AS cap_before, coalesce(sum(weight) OVER o, 0) AS weight_before, sum(source_size) OVER () AS total, sum(weight) OVER () AS weights
  FROM w WINDOW o AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
e AS (SELECT *, cap * (weights - weight_before) <= (total - cap_before) * weight AS capped FROM c),
g AS (SELECT *, coalesce(sum(cap) FILTER (capped) OVER (), 0) AS used, coalesce(sum(weight) FILTER (capped) OVER (), 0) AS gone FROM e),
t AS (
  SELECT source, source_size, weight, course, CASE WHEN capped THEN cap::DOUBLE ELSE (total - used)::DOUBLE * weight / (weights - gone)::DOUBLE END AS target FROM g),
q AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS whole FROM t),
m0 AS (
  SELECT p.*, before AS rest_before, source_size, target, weight, course, whole, target - whole * source_size AS rest, before + size <= target - whole * source_size AND target - whole * source_size > 0 AS more
  FROM p JOIN q ON p.source IS NOT DISTINCT FROM q.source),
""" + ",".join(_FILL.format(n=n, m=n - 1, most="missing") for n in range(1, FILLS + 1)) + f""",
-- Rows again and again, with those taken that fit in their order, until none fits.
r AS (
  SELECT * EXCLUDE (more, rest_before), rest_before, more, 0 AS turn FROM m{FILLS}
  UNION ALL
  SELECT * EXCLUDE (more, rest_before, turn, got, missing, upto, placed, going), CASE WHEN placed THEN got + upto - size ELSE rest_before END AS rest_before, more OR placed AS more, turn + 1 AS turn
  FROM (SELECT *, bool_or(placed) OVER () AS going FROM (SELECT *, coalesce(upto <= missing, FALSE) AS placed FROM (
    SELECT *, CASE WHEN NOT more AND size > 0 AND size <= missing THEN sum(CASE WHEN NOT more AND size > 0 AND size <= missing THEN size ELSE 0 END) OVER (PARTITION BY source ORDER BY row_no) END AS upto FROM (
      SELECT *, max(rest) OVER (PARTITION BY source) - got AS missing FROM (
        SELECT *, coalesce(sum(CASE WHEN more THEN size END) OVER (PARTITION BY source), 0) AS got FROM r)))))
  WHERE going),
m{FILLS + 1} AS (SELECT * EXCLUDE (turn) FROM r WHERE turn = (SELECT max(turn) FROM r)),
""" + _FILL.format(n=FILLS + 2, m=FILLS + 1, most="2 * missing - 1e-6") + f"""
, z AS (SELECT *, CASE WHEN target > 0 THEN whole + more::BIGINT ELSE 0 END AS copies FROM m{FILLS + 2}),
-- The first copy's place in the demand; its half of the curriculum (weights at both ends, demand before it); what is still wanted in it.
x AS (
  SELECT *, least(1.0, CASE WHEN whole > 0 THEN before::DOUBLE ELSE whole * source_size + greatest(0.0, least(rest_before::DOUBLE, rest - size)) END / target) * weight AS want,
         weight * CASE course WHEN 0 THEN 0.625 ELSE 0.375 END AS half FROM z),
y AS (
  SELECT *, CASE WHEN want >= half THEN 0.5 ELSE 0.0 END AS t_0, greatest(0.0, want - CASE WHEN want >= half THEN half ELSE 0.0 END) AS still,
         weight * CASE WHEN (course = 0) <> (want >= half) AND course = 0 THEN 1.75::DOUBLE ELSE 0.75::DOUBLE END AS w_0,
         weight * CASE WHEN course = 1 AND want >= half THEN 1.75::DOUBLE ELSE 0.75::DOUBLE END AS w_1 FROM x)
SELECT doc_id, size, source_size, target, copies * size AS taken, copies,
       CASE WHEN copies > 0 AND target > 0 THEN round(t_0 + CASE WHEN w_0 + root > 0 THEN least(0.5, 2 * still / (w_0 + root)) ELSE 0 END, 6) END AS position
FROM (SELECT *, sqrt(greatest(0.0, w_0 * w_0 + 2 * ((w_1 - w_0) / 0.5) * still)) AS root FROM y)
"""
