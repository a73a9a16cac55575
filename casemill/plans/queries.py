"""Queries over the driver's tables, one for each family of operators, with the same in DuckDB's SQL where it can be said.

The tables stand in for those of the engine's own domain: orders for versions of a customer's timeline, lineitems for numbered
paragraphs, conversations for ordered paragraphs and their speakers, documents and labels for work items and results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from casemill.functions import people, scalars, tables, urls
from casemill.operators import citations, html, knowledge, labels, queue, references, relations, snapshots, tree
from casemill.operators.storage import new_folder, observed, written
from casemill.plans import pipelines
from casemill.sources import walk
from casemill.streaming import discourse, stores

QUERIES = {}
ORACLE_SQL = {}


def query(sql: str | None = None):
    def keep(function):
        QUERIES[function.__name__] = function
        if sql:
            ORACLE_SQL[function.__name__] = sql
        return function

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Work queues and filters


@query("""SELECT d.doc_id, d.lang, d.n_chars FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.doc_id IS NULL OR l.quality <> 1""")
def pending_documents(spark, sf_dir):
    """Work items with no result or no good one (left join with a predicate on the right)."""
    docs, done = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return queue.not_done(docs, done, "doc_id", F.col("quality") == 1).select("doc_id", "lang", "n_chars")


@query("""SELECT doc_id, n_chars FROM documents ORDER BY n_chars DESC NULLS LAST, doc_id LIMIT 100""")
def pending_in_order(spark, sf_dir):
    """A queue's order with nulls last and a limit."""
    return queue.ordered(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), [F.desc_nulls_last("n_chars"), F.asc("doc_id")], 100)


@query("""SELECT c_custkey, c_name FROM customer c WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey)
AND NOT EXISTS (SELECT 1 FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey WHERE o.o_custkey = c.c_custkey AND l.l_returnflag = 'R')""")
def pending_extraction(spark, sf_dir):
    """EXISTS and NOT EXISTS over a join."""
    customers, orders = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey")
    lines = table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return queue.with_but_without(customers, orders, orders.join(lines, "o_orderkey", "left_semi"), "c_custkey").select("c_custkey", "c_name")


@query("""SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""")
def existing_keys(spark, sf_dir):
    """Membership probe: rows whose key a list has."""
    wanted = table(spark, sf_dir, "customer").filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return snapshots.present(table(spark, sf_dir, "orders"), wanted, ["o_custkey"]).select("o_orderkey")


@query("""SELECT o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""")
def new_keys(spark, sf_dir):
    """Set difference of found and stored keys."""
    known = table(spark, sf_dir, "customer").filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return snapshots.absent(table(spark, sf_dir, "orders"), known, ["o_custkey"]).select("o_orderkey")


@query("""SELECT o_orderkey FROM orders WHERE CAST(o_orderdate AS DATE) >= (SELECT max(CAST(o_orderdate AS DATE)) FROM orders WHERE o_orderstatus = 'F') OR o_orderdate IS NULL""")
def high_water(spark, sf_dir):
    """Rows from the newest stored date on: the scalar maximum is joined as one row."""
    orders = table(spark, sf_dir, "orders").withColumn("day", F.to_date("o_orderdate"))
    mark = orders.filter("o_orderstatus = 'F'").agg(F.max("day").alias("mark"))
    return queue.newer(orders.join(F.broadcast(mark)), "day", F.col("mark")).select("o_orderkey")


@query("""SELECT event_id, user_id FROM events WHERE event_id > 500 ORDER BY event_id LIMIT 16""")
def keyset_page(spark, sf_dir):
    """Seek pagination."""
    return queue.page_after(table(spark, sf_dir, "events").select("event_id", "user_id"), "event_id", 500, 16)


@query("""SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN 'no label' WHEN n_chars < 100 THEN 'too short' WHEN lang <> 'en' THEN 'other language' WHEN toxic = 1 THEN 'toxic' END AS reason
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def validation_reason(spark, sf_dir):
    """The first check that fails, null for accepted rows."""
    docs, marks = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").withColumnRenamed("doc_id", "l_id")
    joined = docs.join(marks, F.col("doc_id") == F.col("l_id"), "left")
    reason = queue.first_failure((F.col("l_id").isNull(), "no label"), (F.col("n_chars") < 100, "too short"), (F.col("lang") != "en", "other language"), (F.col("toxic") == 1, "toxic"))
    return joined.select("doc_id", reason.alias("reason"))


@query("""WITH r AS (SELECT doc_id, CASE WHEN n_chars < 100 THEN 'too short' WHEN lang <> 'en' THEN 'other language' END AS reason FROM documents)
SELECT reason, count(*) AS failures, min(doc_id) AS first_key FROM r WHERE reason IS NOT NULL GROUP BY reason ORDER BY reason LIMIT 40""")
def failure_report(spark, sf_dir):
    """Counts of failures by reason, each with its first key."""
    docs = table(spark, sf_dir, "documents").withColumn("reason", queue.first_failure((F.col("n_chars") < 100, "too short"), (F.col("lang") != "en", "other language")))
    return queue.failure_list(docs, "reason", "doc_id", 40)


@query("""SELECT doc_id, regexp_replace(text, '[ \t\n\v\f\r]', '', 'g') <> '' AS filled FROM documents""")
def blank_filter(spark, sf_dir):
    """Whether a text is more than white space."""
    return table(spark, sf_dir, "documents").select("doc_id", queue.not_blank("text").alias("filled"))


# Aggregation


@query("""SELECT event_type, count(*) AS n, count(*) FILTER (value > 50) AS n_high, CAST(max(CAST(ts AS DATE)) AS VARCHAR) AS latest FROM events GROUP BY event_type""")
def status_counts(spark, sf_dir):
    """Counts by state, filtered counts, and the newest date."""
    found = relations.state_counts(table(spark, sf_dir, "events"), "event_type", F.to_date("ts"), n_high=F.col("value") > 50)
    return found.withColumn("latest", F.col("latest").cast("string"))


@query("""SELECT l_orderkey, max(l_linenumber) AS expected, count(l_linenumber) AS extracted,
coalesce(count(l_linenumber) = max(l_linenumber) AND count(DISTINCT l_linenumber) = max(l_linenumber) AND min(l_linenumber) = 1, FALSE) AS complete FROM lineitem GROUP BY l_orderkey""")
def sequence_complete(spark, sf_dir):
    """Whether numbered rows are 1, 2, ... without gaps or repeats."""
    return queue.completeness(table(spark, sf_dir, "lineitem"), ["l_orderkey"], "l_linenumber")


@query("""WITH s AS (SELECT o_custkey, bool_or(o_orderstatus = 'O') AS open, bool_or(o_orderpriority <> '1-URGENT') AS failed, bool_or(o_orderstatus = 'P') AS partial, bool_and(o_orderstatus = 'F') AS whole FROM orders GROUP BY o_custkey)
SELECT c_custkey, CASE WHEN s.o_custkey IS NULL THEN 'discovered' WHEN open THEN CASE WHEN failed THEN 'fetch_failed' ELSE 'discovered' END
WHEN partial THEN 'parse_incomplete' WHEN whole THEN 'complete' ELSE 'needs_review' END AS status FROM customer LEFT JOIN s ON c_custkey = s.o_custkey""")
def parent_status(spark, sf_dir):
    """A parent's state by those of its children."""
    fetch = F.when(F.col("o_orderpriority") == "1-URGENT", "success").otherwise("error")
    parse = F.when(F.col("o_orderstatus") == "O", "not_parsed").when(F.col("o_orderstatus") == "P", "incomplete").otherwise("complete")
    versions = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), fetch.alias("fetch"), parse.alias("parse"))
    return queue.parent_status(table(spark, sf_dir, "customer").select("c_custkey"), versions, "c_custkey", "fetch", "parse")


@query("""SELECT user_id, arg_max(event_id, (value, -event_id)) AS event_id FROM events GROUP BY user_id""")
def best_candidate(spark, sf_dir):
    """The best of each group by a lexicographic rank."""
    return queue.best_of(table(spark, sf_dir, "events"), "user_id", "event_id", -F.col("value"), F.col("event_id"))


@query("""SELECT user_id, event_type, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1""")
def first_wins(spark, sf_dir):
    """The first row of each key."""
    return snapshots.first_of(table(spark, sf_dir, "events"), ["user_id", "event_type"], [F.col("ts"), F.col("event_id")]).select("user_id", "event_type", "event_id", "value")


@query("""SELECT user_id, event_type, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""")
def last_wins(spark, sf_dir):
    """The last row of each key."""
    return snapshots.first_of(table(spark, sf_dir, "events"), ["user_id", "event_type"], [F.desc("ts"), F.desc("event_id")]).select("user_id", "event_type", "event_id", "value")


# Joins


@query("""SELECT r_name, n_name, count(*) AS customers, round(sum(c_acctbal), 2) AS balance FROM region JOIN nation ON n_regionkey = r_regionkey JOIN customer ON c_nationkey = n_nationkey GROUP BY r_name, n_name""")
def three_way(spark, sf_dir):
    """A chain of inner joins."""
    region, nation, customer = (table(spark, sf_dir, t) for t in ("region", "nation", "customer"))
    joined = relations.lookup(customer, nation, "c_nationkey", "n_nationkey", "n_name", "n_regionkey", how="inner")
    joined = relations.lookup(joined, region, "n_regionkey", "r_regionkey", "r_name", how="inner")
    return joined.groupBy("r_name", "n_name").agg(F.count(F.lit(1)).alias("customers"), F.round(F.sum("c_acctbal"), 2).alias("balance"))


@query("""SELECT o_orderkey, coalesce(string_agg(l_linenumber::VARCHAR || ':' || l_partkey::VARCHAR, ',' ORDER BY l_linenumber, l_partkey), '') AS lines FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey""")
def nest_join(spark, sf_dir):
    """One row for each parent with the ordered list of its children, empty for none."""
    joined = relations.nested(table(spark, sf_dir, "orders").select("o_orderkey"), table(spark, sf_dir, "lineitem"), "o_orderkey", "l_orderkey", ["l_linenumber", "l_partkey"], "items")
    return joined.select("o_orderkey", F.array_join(F.transform("items", lambda x: F.concat_ws(":", x["l_linenumber"], x["l_partkey"])), ",").alias("lines"))


def _turns(spark, sf_dir):
    """Conversations as nested sets: a user's turn is the parent of what follows up to the next one."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", (F.col("turn") + 1).alias("ordinal"), F.when(F.col("role") == "user", 1).otherwise(2).alias("level"), "role", "text")
    after = Window.partitionBy("conv_id").orderBy("ordinal").rowsBetween(1, Window.unboundedFollowing)
    end = F.min(F.when(F.col("level") == 1, F.col("ordinal"))).over(after)
    last = F.max("ordinal").over(Window.partitionBy("conv_id"))
    return turns.withColumn("descendant_count", F.when(F.col("level") == 1, F.coalesce(end, last + 1) - F.col("ordinal") - 1).otherwise(0))


_TREE = """WITH t AS (SELECT conv_id, turn + 1 AS ordinal, CASE WHEN role = 'user' THEN 1 ELSE 2 END AS level, role, text FROM conversations),
n AS (SELECT *, CASE WHEN level = 1 THEN coalesce(min(CASE WHEN level = 1 THEN ordinal END) OVER (PARTITION BY conv_id ORDER BY ordinal ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING),
  max(ordinal) OVER (PARTITION BY conv_id) + 1) - ordinal - 1 ELSE 0 END AS descendant_count FROM t) """


@query(_TREE + """SELECT a.conv_id, a.ordinal AS root_ordinal, string_agg(b.text, chr(10) || chr(10) ORDER BY b.ordinal) AS text FROM n a JOIN n b ON a.conv_id = b.conv_id AND b.ordinal BETWEEN a.ordinal AND a.ordinal + a.descendant_count
WHERE a.level = 1 GROUP BY 1, 2""")
def subtree_text(spark, sf_dir):
    """Range join of nested sets: the text of each root's subtree."""
    return tree.subtree_text(_turns(spark, sf_dir), "conv_id", F.col("level") == 1)


def _sections(spark, sf_dir):
    """The same as sections, each with the turns that follow it as subsections."""
    turns = _turns(spark, sf_dir)
    last = F.max(F.when(F.col("level") == 1, F.col("ordinal"))).over(Window.partitionBy("conv_id").orderBy("ordinal"))
    return turns.withColumns({"parent_ordinal": F.when(F.col("level") == 2, last), "kind": F.when(F.col("level") == 1, "section").otherwise("subsection")})


_SECTIONS = _TREE + """, s AS (SELECT *, max(CASE WHEN level = 1 THEN ordinal END) OVER (PARTITION BY conv_id ORDER BY ordinal) AS root FROM n),
x AS (SELECT conv_id, root AS ordinal, string_agg(text, chr(10) || chr(10) ORDER BY ordinal) AS text FROM s WHERE root IS NOT NULL GROUP BY 1, 2) """


@query(_SECTIONS + """, y AS (SELECT *, len(regexp_extract_all(text, '\\S+')) AS words, ordinal % 5 = 0 AS embedded FROM x),
z AS (SELECT s.conv_id, s.root, s.ordinal, s.text, len(regexp_extract_all(s.text, '\\S+')) AS words FROM s JOIN y ON s.conv_id = y.conv_id AND s.root = y.ordinal AND s.level = 2 WHERE y.words > 40 AND NOT y.embedded AND s.ordinal % 5 <> 0)
SELECT conv_id, ordinal AS root, ordinal, words AS n_tokens, text FROM y WHERE words <= 40 AND NOT embedded AND trim(text) <> '' UNION ALL SELECT conv_id, root, ordinal, words, text FROM z WHERE words <= 40 AND trim(text) <> ''""")
def embedding_units(spark, sf_dir):
    """The largest subtrees of sections that fit a budget of words, by a descent that makes only the texts it reaches."""
    nodes = _sections(spark, sf_dir).withColumn("embedded", F.col("ordinal") % 5 == 0)
    return tree.token_units(nodes, "conv_id", F.regexp_count("text", F.lit(r"\S+")), 40).withColumn("n_tokens", F.col("n_tokens").cast("long"))


@query(_SECTIONS + """, y AS (SELECT *, lag(text, 1, '') OVER (PARTITION BY conv_id ORDER BY ordinal) AS previous_text FROM x)
SELECT conv_id, ordinal, text, previous_text FROM y WHERE ordinal % 3 <> 0 AND trim(text) <> '' QUALIFY row_number() OVER (ORDER BY conv_id % 7, conv_id, ordinal) <= 33""")
def section_job(spark, sf_dir):
    """Sections that a classifier is to see, each with the text of the one before, up to a limit over all documents."""
    nodes = _sections(spark, sf_dir).withColumn("role", F.when(F.col("ordinal") % 3 == 0, 1))
    return tree.sections_to_classify(nodes, "conv_id", [F.col("conv_id") % 7], 33)


@query(_TREE + """SELECT conv_id, ordinal, level, descendant_count, CASE WHEN level = 2 THEN max(CASE WHEN level = 1 THEN ordinal END) OVER (PARTITION BY conv_id ORDER BY ordinal) END AS parent_ordinal FROM n""")
def nested_set(spark, sf_dir):
    """Descendant counts and parents by levels alone."""
    return tree.counts_from_levels(_turns(spark, sf_dir).drop("descendant_count"), "conv_id")


@query("""SELECT a.n_nationkey, a.n_name, r.r_name AS parent_name, (SELECT count(*) FROM nation b WHERE b.n_regionkey = a.n_regionkey AND b.n_nationkey <> a.n_nationkey) AS siblings FROM nation a LEFT JOIN region r ON a.n_regionkey = r.r_regionkey""")
def parent_lookup(spark, sf_dir):
    """Parents by a left join, siblings by a join of a table with itself."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return relations.lookup(relations.siblings(nation, "n_regionkey"), region, "n_regionkey", "r_regionkey", F.col("r_name").alias("parent_name")).select("n_nationkey", "n_name", "parent_name", "siblings")


@query("""SELECT l_orderkey, l_linenumber, o_orderdate, coalesce(p_name, 'none') AS p_name FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey LEFT JOIN part ON p_partkey = l_partkey AND p_size > 25""")
def lookup_chain(spark, sf_dir):
    """A chain of left lookups with a fallback."""
    lines, orders, parts = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders"), table(spark, sf_dir, "part").filter("p_size > 25")
    joined = relations.lookup(relations.lookup(lines, orders, "l_orderkey", "o_orderkey", "o_orderdate"), parts, "l_partkey", "p_partkey", "p_name")
    return joined.select("l_orderkey", "l_linenumber", "o_orderdate", F.coalesce("p_name", F.lit("none")).alias("p_name"))


@query("""SELECT event_id, lower(event_type) AS name, dense_rank() OVER (ORDER BY lower(event_type)) - 1 AS index FROM events""")
def dimension_lookup(spark, sf_dir):
    """A lookup by name that must succeed, whatever the case."""
    events = table(spark, sf_dir, "events").withColumn("name", F.lower("event_type"))
    names = labels.scheme(events, "name").withColumn("name", F.upper("name"))
    return snapshots.must_match(events.select("event_id", "name"), names, "name", "name", "index")


@query("""WITH s AS (SELECT user_id, event_id, value, value + 10 AS stop FROM events)
SELECT a.event_id, count(b.event_id) AS overlaps FROM s a LEFT JOIN s b ON a.user_id = b.user_id AND a.event_id <> b.event_id AND a.value < b.stop AND a.stop > b.value GROUP BY a.event_id""")
def interval_overlap(spark, sf_dir):
    """Intervals that overlap others of the same key."""
    spans = table(spark, sf_dir, "events").select("user_id", "event_id", "value", (F.col("value") + 10).alias("stop"))
    return knowledge.spans_that_overlap(spans, "user_id", "event_id", "value", "stop", 10.0)


@query("""WITH u AS (SELECT user_id, array_agg(DISTINCT event_type) AS types FROM events GROUP BY user_id) SELECT user_id, list_has_any(types, ['purchase', 'click']) AS allowed FROM u""")
def mask_overlap(spark, sf_dir):
    """Whether two sets meet."""
    types = table(spark, sf_dir, "events").groupBy("user_id").agg(F.collect_set("event_type").alias("types"))
    return types.select("user_id", labels.allowed(F.col("types"), F.array(F.lit("purchase"), F.lit("click"))).alias("allowed"))


# Order-dependent operators


@query("""SELECT conv_id, turn, coalesce(lag(text) OVER (PARTITION BY conv_id ORDER BY turn), '') AS previous_text FROM conversations""")
def previous_text(spark, sf_dir):
    """The text before, empty for the first."""
    return relations.previous(table(spark, sf_dir, "conversations"), ["conv_id"], ["turn"], "text", "previous_text").select("conv_id", "turn", "previous_text")


@query("""WITH s AS (SELECT conv_id, turn, text, sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn) AS block FROM conversations)
SELECT conv_id, block::BIGINT AS block, string_agg(text, chr(10) ORDER BY turn) AS text FROM s WHERE block > 0 GROUP BY 1, 2""")
def islands(spark, sf_dir):
    """Blocks that certain rows open; rows before the first are dropped."""
    return relations.islands(table(spark, sf_dir, "conversations"), ["conv_id"], ["turn"], F.col("role") == "user", "text")


@query("""SELECT conv_id, turn, last_value(CASE WHEN role = 'user' THEN turn END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn) AS heading_turn FROM conversations""")
def carry_forward(spark, sf_dir):
    """The most recent heading."""
    return relations.carried(table(spark, sf_dir, "conversations"), ["conv_id"], ["turn"], F.when(F.col("role") == "user", F.col("turn")), "heading_turn").select("conv_id", "turn", "heading_turn")


@query("""WITH t AS (SELECT conv_id, turn, role, lag(CASE WHEN role = 'user' THEN turn END) OVER (PARTITION BY conv_id ORDER BY turn) AS before FROM conversations) SELECT conv_id, turn, CASE WHEN role <> 'user' OR role IS NULL THEN before END AS heading_turn FROM t""")
def carry_once(spark, sf_dir):
    """A heading that belongs to the next row only."""
    return relations.carried_once(table(spark, sf_dir, "conversations"), ["conv_id"], ["turn"], F.when(F.col("role") == "user", F.col("turn")), "heading_turn").select("conv_id", "turn", "heading_turn")


@query("""SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS ordinal, (row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1) % 2 = 0 AS uses_gold FROM conversations""")
def renumber(spark, sf_dir):
    """Ordinals from 1, and a choice by their parity."""
    rows = relations.renumbered(table(spark, sf_dir, "conversations"), ["conv_id"], ["turn"])
    return rows.select("conv_id", "turn", "ordinal", ((F.col("ordinal") - 1) % 2 == 0).alias("uses_gold"))


@query("""SELECT o_orderkey, o_custkey, o_orderstatus = 'F' AND row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderstatus = 'F' DESC, o_orderdate DESC, o_orderkey DESC) = 1 AS is_current FROM orders""")
def one_current(spark, sf_dir):
    """At most one current version: the last that is marked so."""
    orders = table(spark, sf_dir, "orders").withColumn("is_current", F.col("o_orderstatus") == "F")
    return snapshots.one_current(orders, "o_custkey", "is_current", [F.desc("o_orderdate"), F.desc("o_orderkey")]).select("o_orderkey", "o_custkey", "is_current")


@query("""SELECT o_orderkey, CASE WHEN sum((o_orderstatus = 'P')::INT) OVER w = 1 THEN o_orderstatus = 'P' ELSE o_orderdate = max(o_orderdate) OVER w END AS is_current FROM orders WINDOW w AS (PARTITION BY o_custkey)""")
def version_timeline(spark, sf_dir):
    """The current version of a timeline that marks none, or several."""
    orders = table(spark, sf_dir, "orders").withColumn("is_current", F.col("o_orderstatus") == "P")
    return snapshots.current_timeline(orders, "o_custkey", "o_orderdate", "is_current").select("o_orderkey", "is_current")


# Snapshots


_DELTA = "SELECT doc_id, 'new' AS lang, n_chars + 1 AS n_chars FROM documents WHERE doc_id % 2 = 0 UNION ALL SELECT doc_id + 1000000000, 'new', n_chars FROM documents WHERE doc_id % 7 = 0"


def _delta(docs):
    changed = docs.filter("doc_id % 2 = 0").select("doc_id", F.lit("new").alias("lang"), (F.col("n_chars") + 1).alias("n_chars"))
    return changed.unionByName(docs.filter("doc_id % 7 = 0").select((F.col("doc_id") + 1000000000).alias("doc_id"), F.lit("new").alias("lang"), "n_chars"))


@query(f"WITH d AS ({_DELTA}) SELECT doc_id, lang, n_chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM d) UNION ALL SELECT * FROM d")
def upsert(spark, sf_dir):
    """Rows of a delta in place of those with the same key."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    return snapshots.upsert(docs, _delta(docs), ["doc_id"])


@query(f"WITH d AS ({_DELTA}) SELECT doc_id, lang, n_chars FROM documents UNION ALL SELECT * FROM d WHERE doc_id NOT IN (SELECT doc_id FROM documents)")
def insert_absent(spark, sf_dir):
    """Rows of a delta whose key is new."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    return snapshots.insert_absent(docs, _delta(docs), ["doc_id"], [F.col("n_chars")])


@query("""WITH d AS (SELECT l_orderkey, 1 AS l_linenumber, count(*) AS l_partkey FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey)
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_orderkey NOT IN (SELECT l_orderkey FROM d) UNION ALL SELECT * FROM d""")
def replace_group(spark, sf_dir):
    """All rows of a group give way to the delta's."""
    lines = table(spark, sf_dir, "lineitem")
    delta = lines.filter("l_returnflag = 'R'").groupBy("l_orderkey").agg(F.lit(1).alias("l_linenumber"), F.count(F.lit(1)).alias("l_partkey"))
    return snapshots.replace_group(lines.select("l_orderkey", "l_linenumber", "l_partkey"), delta, ["l_orderkey"])


@query("""WITH d AS (SELECT DISTINCT p_brand FROM part WHERE p_size <= 5), o AS (SELECT row_number() OVER (ORDER BY p_brand) AS id, p_brand FROM d),
n AS (SELECT DISTINCT p_brand FROM part WHERE p_brand NOT IN (SELECT p_brand FROM o)) SELECT id, p_brand FROM o UNION ALL SELECT (SELECT coalesce(max(id), 0) FROM o) + row_number() OVER (ORDER BY p_brand), p_brand FROM n""")
def get_or_create_dim(spark, sf_dir):
    """New names of a dimension get the next keys."""
    parts = table(spark, sf_dir, "part")
    old = labels.scheme(parts.filter("p_size <= 5"), "p_brand").select((F.col("index") + 1).cast("long").alias("id"), "p_brand")
    return snapshots.get_or_create(old, parts, "p_brand", "id")


@query("""WITH o AS (SELECT row_number() OVER (ORDER BY p_brand, t NULLS FIRST) AS id, p_brand, t FROM (SELECT DISTINCT p_brand, CASE WHEN p_size % 2 = 1 THEN p_size % 3 END AS t FROM part WHERE p_size <= 5)),
d AS (SELECT DISTINCT p_brand, CASE WHEN p_size % 2 = 1 THEN p_size % 3 END AS t FROM part), n AS (SELECT d.* FROM d LEFT JOIN o ON d.p_brand = o.p_brand AND d.t IS NOT DISTINCT FROM o.t WHERE o.id IS NULL)
SELECT id, p_brand, t FROM o UNION ALL SELECT (SELECT coalesce(max(id), 0) FROM o) + row_number() OVER (ORDER BY p_brand, t NULLS FIRST), p_brand, t FROM n""")
def get_or_create_pair(spark, sf_dir):
    """New pairs of a dimension, like names and titles, get the next keys; missing titles are equal."""
    parts = table(spark, sf_dir, "part").select("p_brand", "p_size", F.when(F.col("p_size") % 2 == 1, F.col("p_size") % 3).alias("t"))
    none = spark.createDataFrame([], "id long, p_brand string, t int")
    old = written(snapshots.get_or_create(none, parts.filter("p_size <= 5"), ["p_brand", "t"], "id"), "dimension")
    return snapshots.get_or_create(old, parts, ["p_brand", "t"], "id")


@query("""SELECT o_orderkey, o_orderstatus = 'F' OR o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0) AS promoted FROM orders""")
def mark_promoted(spark, sf_dir):
    """Flags set by a list of keys."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", (F.col("o_orderstatus") == "F").alias("promoted"))
    done = table(spark, sf_dir, "customer").filter("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    return snapshots.mark(orders, done, ["o_custkey"], "promoted").select("o_orderkey", "promoted")


@query("""SELECT o_orderkey, CASE WHEN c_acctbal >= 0 THEN o_custkey END AS o_custkey FROM orders JOIN customer ON o_custkey = c_custkey""")
def detach_children(spark, sf_dir):
    """SET NULL where the parent goes."""
    gone = table(spark, sf_dir, "customer").filter("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    return snapshots.detach(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), gone, "o_custkey")


@query("""SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')""")
def cascade_delete(spark, sf_dir):
    """Children of parents that go, go too."""
    gone = table(spark, sf_dir, "orders").filter("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("l_orderkey"))
    return snapshots.delete_children(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber"), gone, "l_orderkey")


@query("""SELECT coalesce(n_name, s) AS name, coalesce(k, n_regionkey) AS home FROM nation FULL JOIN (SELECT upper(n_name) AS s, n_nationkey AS k FROM nation WHERE n_nationkey % 3 = 0 UNION ALL SELECT n_name, 99 FROM nation WHERE n_nationkey % 3 = 1) ON n_name = s""")
def rehome(spark, sf_dir):
    """A full outer merge in which the new side's home counts."""
    nation = table(spark, sf_dir, "nation")
    new = nation.filter("n_nationkey % 3 = 0").select(F.upper("n_name").alias("name"), F.col("n_nationkey").alias("home"))
    new = new.unionByName(nation.filter("n_nationkey % 3 = 1").select(F.col("n_name").alias("name"), F.lit(99).alias("home")))
    return snapshots.rehome(nation.select(F.col("n_name").alias("name"), F.col("n_regionkey").alias("home")), new, "name", "home")


@query("""SELECT o_custkey, o_orderstatus, count(*) AS n FROM orders GROUP BY 1, 2 HAVING count(*) > 1""")
def unique_violations(spark, sf_dir):
    """Keys that aren't unique."""
    return snapshots.violations(table(spark, sf_dir, "orders"), ["o_custkey", "o_orderstatus"])


@query("""SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)""")
def orphans(spark, sf_dir):
    """Rows that refer to nothing."""
    return snapshots.orphans(table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders"), "c_custkey", "o_custkey").select("c_custkey")


@query("""SELECT doc_id, (quality IS NOT NULL) <> (n_chars > 1000) AS exactly_one, NOT (quality IS NOT NULL AND n_chars > 1000) AS at_most_one FROM documents LEFT JOIN labels USING (doc_id)""")
def parent_constraints(spark, sf_dir):
    """Constraints on how many of some columns may be set."""
    rows = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left").withColumn("long", F.when(F.col("n_chars") > 1000, 1))
    return rows.select("doc_id", snapshots.exactly_one("quality", "long").alias("exactly_one"), snapshots.at_most_one("quality", "long").alias("at_most_one"))


# Labels and metrics


@query("""WITH n AS (SELECT lang AS name FROM documents UNION SELECT source FROM documents) SELECT name, row_number() OVER (ORDER BY name) - 1 AS index FROM n WHERE name IS NOT NULL""")
def label_scheme(spark, sf_dir):
    """Different names of two columns with their indexes."""
    docs = table(spark, sf_dir, "documents")
    return labels.scheme(docs.select(F.col("lang").alias("name")).union(docs.select("source")), "name")


@query("""WITH c AS (SELECT label, count(*) AS n FROM embeddings WHERE label >= 0 GROUP BY label), k AS (SELECT DISTINCT label FROM embeddings)
SELECT label, round(coalesce((SELECT sum(n) FROM c) / ((SELECT count(*) FROM k) * n), 0), 9) AS weight FROM k LEFT JOIN c USING (label)""")
def class_weights(spark, sf_dir):
    """Weights against the frequency of classes."""
    rows = table(spark, sf_dir, "embeddings")
    return labels.class_weights(rows, "label", rows.select("label").distinct()).select("label", F.round("weight", 9).alias("weight"))


@query("""WITH s AS (SELECT user_id, event_type, count(*) AS k FROM events GROUP BY 1, 2), c AS (SELECT event_type, count(*) AS n FROM s GROUP BY 1)
SELECT user_id, round(greatest(sum(1.0::DOUBLE / n), 0.001), 9) AS weight FROM s JOIN c USING (event_type) GROUP BY user_id""")
def sample_weights(spark, sf_dir):
    """Weights of rows by how rare their labels are."""
    rows = table(spark, sf_dir, "events").groupBy("user_id").agg(F.collect_set("event_type").alias("types"))
    return labels.sample_weights(rows, "user_id", "types").select("user_id", F.round("weight", 9).alias("weight"))


def _judged(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    score = F.col("n_chars") % 100 / 100
    return rows.select(F.col("lang").alias("label"), (F.col("quality") == 1).alias("gold"), score.alias("score"), (score >= 0.5).alias("predicted"))


_JUDGED = "WITH j AS (SELECT lang AS label, quality = 1 AS gold, n_chars % 100 / 100.0::DOUBLE AS score, n_chars % 100 / 100.0::DOUBLE >= 0.5 AS predicted FROM documents JOIN labels USING (doc_id)) "


@query(_JUDGED + """, c AS (SELECT label, count(*) FILTER (gold AND predicted) AS tp, count(*) FILTER (NOT gold AND predicted) AS fp, count(*) FILTER (gold AND NOT predicted) AS fn FROM j GROUP BY label)
SELECT round(2.0::DOUBLE * sum(tp) / (2 * sum(tp) + sum(fp) + sum(fn)), 9) AS micro_f1, round(avg(CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2.0::DOUBLE * tp / (2 * tp + fp + fn) END), 9) AS macro_f1 FROM c""")
def f1_scores(spark, sf_dir):
    """Micro and macro F1."""
    return labels.f1(labels.label_counts(_judged(spark, sf_dir), "label", "gold", "predicted")).select(F.round("micro_f1", 9).alias("micro_f1"), F.round("macro_f1", 9).alias("macro_f1"))


@query(_JUDGED + """, t AS (SELECT unnest([0.45, 0.5, 0.55, 0.6])::DOUBLE AS threshold),
c AS (SELECT label, threshold, count(*) FILTER (gold AND score >= threshold) AS tp, count(*) FILTER (NOT gold AND score >= threshold) AS fp, count(*) FILTER (gold AND score < threshold) AS fn FROM j, t GROUP BY 1, 2),
v AS (SELECT *, CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2.0::DOUBLE * tp / (2 * tp + fp + fn) END AS f1 FROM c)
SELECT label, greatest(threshold, 0.45) AS threshold, round(f1, 9) AS f1 FROM v QUALIFY row_number() OVER (PARTITION BY label ORDER BY f1 DESC, threshold) = 1""")
def threshold_tuning(spark, sf_dir):
    """The best threshold of each label."""
    return labels.tune(_judged(spark, sf_dir), "label", "gold", "score").withColumn("f1", F.round("f1", 9))


@query("""WITH d AS (SELECT vec_id, unnest(embedding) AS s, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings), p AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, i) AS r FROM d WHERE s >= 0.1)
SELECT e.vec_id, coalesce(string_agg(i::VARCHAR, ',' ORDER BY r), '') AS top FROM embeddings e LEFT JOIN p ON e.vec_id = p.vec_id AND r <= 3 GROUP BY e.vec_id""")
def topk_capped(spark, sf_dir):
    """The highest scores from a threshold on, a few for each row."""
    return table(spark, sf_dir, "embeddings").select("vec_id", F.array_join(labels.top_scores(F.col("embedding"), 0.1, labels.TOPICS).cast("array<string>"), ",").alias("top"))


@query("""WITH d AS (SELECT vec_id, unnest(embedding) AS s, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings) SELECT vec_id, i AS best FROM d QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, i) = 1""")
def best_index(spark, sf_dir):
    """The index of the largest score."""
    return table(spark, sf_dir, "embeddings").select("vec_id", labels.best_index(F.col("embedding")).alias("best"))


@query("""WITH p AS (SELECT doc_id, toxic = 1 AS gold, 1 / (1 + exp(-(n_chars % 13 - 6)::DOUBLE)) AS p FROM documents JOIN labels USING (doc_id))
SELECT doc_id, round(CASE WHEN gold THEN -ln(greatest(p, 1e-8)) ELSE -ln(greatest(1 - greatest(p - 0.05, 0), 1e-8)) * pow(greatest(p - 0.05, 0), 4) END, 9) AS loss FROM p""")
def loss_terms(spark, sf_dir):
    """The asymmetric loss of each row."""
    rows = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id").withColumn("p", labels.sigmoid((F.col("n_chars") % 13 - 6).cast("double")))
    return rows.select("doc_id", F.round(labels.asymmetric_loss(F.col("p"), F.col("toxic") == 1), 9).alias("loss"))


@query("""WITH u AS (SELECT user_id, array_agg(DISTINCT event_type) AS types FROM events GROUP BY user_id)
SELECT user_id, list_contains(types, 'click')::INT AS click, list_contains(types, 'view')::INT AS view FROM u""")
def one_hot(spark, sf_dir):
    """Names as flags."""
    types = table(spark, sf_dir, "events").groupBy("user_id").agg(F.collect_set("event_type").alias("types"))
    flags = labels.one_hot(F.col("types"), ["click", "view"])
    return types.select("user_id", flags[0].alias("click"), flags[1].alias("view"))


@query("""SELECT conv_id, turn, CASE WHEN role = 'user' THEN 'Topics: asked; ' || role || chr(10) || chr(10) ELSE '' END || text || CASE WHEN length(coalesce(lag(text) OVER w, '')) > 0 THEN chr(10) || chr(10) || 'Previous: ' || lag(text) OVER w ELSE '' END AS prompt
FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)""")
def prompts(spark, sf_dir):
    """A classifier's input texts."""
    rows = relations.previous(table(spark, sf_dir, "conversations"), ["conv_id"], ["turn"], "text", "previous")
    topics = F.when(F.col("role") == "user", F.array(F.lit("asked"), F.col("role"))).otherwise(F.array().cast("array<string>"))
    return rows.select("conv_id", "turn", labels.prompt(topics, F.col("text"), F.col("previous")).alias("prompt"))


# Scalar functions


@query(r"""SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host, nullif(regexp_extract(url, '^[a-z]+://[^/?#]+(?:/[^?#]*)?/([^/?#]+)/?(?:[?#]|$)', 1), '') AS slug,
regexp_extract(url, '^([^?#]*)', 1) || CASE WHEN len(list_filter(string_split(regexp_extract(url, '\?([^#]*)', 1), '&'), lambda p: p <> '' AND string_split(p, '=')[1] <> 'ref')) > 0
THEN '?' || array_to_string(list_filter(string_split(regexp_extract(url, '\?([^#]*)', 1), '&'), lambda p: p <> '' AND string_split(p, '=')[1] <> 'ref'), '&') ELSE '' END || regexp_extract(url, '(#.*)$', 1) AS cleaned FROM pages""")
def url_parts(spark, sf_dir):
    """Parts of urls, and urls without a parameter."""
    url = F.col("url")
    return table(spark, sf_dir, "pages").select("page_id", scalars.url_host(url).alias("host"), scalars.url_slug(url).alias("slug"), scalars.clean_url(url, ("ref",)).alias("cleaned"))


@query(r"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM documents),
n AS (SELECT doc_id, pos, CASE WHEN pos % 3 = 0 THEN (pos + 1)::VARCHAR || '. ' || line ELSE line END AS line FROM l)
SELECT doc_id, pos, try_cast(nullif(regexp_extract(line, '^[ \t\n\v\f\r]*([0-9]+)[.)]*(?:[ \t\n\v\f\r]|$)', 1), '') AS INT) AS number, nullif(trim(regexp_replace(line, '\s+', ' ', 'g')), '') AS collapsed, regexp_replace(line, '^\s*\S+\s*', '') AS rest FROM n""")
def line_numbers(spark, sf_dir):
    """Leading numbers of lines, and what follows them."""
    lines = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    line = F.when(F.col("pos") % 3 == 0, F.concat((F.col("pos") + 1).cast("string"), F.lit(". "), F.col("line"))).otherwise(F.col("line"))
    lines = lines.withColumn("line", line)
    return lines.select("doc_id", "pos", scalars.paragraph_number(F.col("line")).alias("number"), scalars.collapse(F.col("line")).alias("collapsed"), scalars.after_first(F.col("line")).alias("rest"))


@query("""SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, strftime(CAST(ts AS DATE), '%Y%m%d') AS day, coalesce(try_cast(try_cast(json_extract_string(props, '$.k') AS DOUBLE) AS INT), 0) AS whole FROM events""")
def json_field(spark, sf_dir):
    """Fields of JSON, numbers and dates."""
    k = F.get_json_object("props", "$.k")
    return table(spark, sf_dir, "events").select("event_id", k.cast("long").alias("k"), F.date_format("ts", "yyyyMMdd").alias("day"), scalars.whole_number(k).alias("whole"))


@query("""SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS iso, strftime(o_orderdate, '%Y-%m-%d') AS compact, 'http://x/' || o_custkey::VARCHAR || '/' || strftime(o_orderdate, '%Y%m%d') AS uri FROM orders""")
def dates(spark, sf_dir):
    """Dates from texts, and a version's address."""
    day = F.col("o_orderdate")
    uri = scalars.version_uri(F.concat(F.lit("http://x/"), F.col("o_custkey").cast("string"), F.lit("/")), day)
    return table(spark, sf_dir, "orders").select("o_orderkey", scalars.iso_date(day.cast("string")).cast("string").alias("iso"), scalars.compact_date(F.date_format(day, "yyyyMMdd")).cast("string").alias("compact"), uri.alias("uri"))


@query("""SELECT l_orderkey, l_linenumber, CASE WHEN abs(l_suppkey - l_linenumber) <= 80 THEN array_to_string(range(least(l_linenumber, l_suppkey), greatest(l_linenumber, l_suppkey) + 1), ',') || ',' ELSE '' END || l_partkey::VARCHAR AS pins FROM lineitem""")
def pin_ranges(spark, sf_dir):
    """Ranges of numbers as numbers."""
    one = F.struct(F.col("l_suppkey").cast("long").alias("a"), F.col("l_linenumber").cast("long").alias("b"))
    two = F.struct(F.col("l_partkey").cast("long").alias("a"), F.lit(None).cast("long").alias("b"))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.array_join(scalars.pins(F.array(one, two)).cast("array<string>"), ",").alias("pins"))


# Documents, citations and people


@query()
def page_layout(spark, sf_dir):
    """The layout of each page, and whether its numbered paragraphs are complete."""
    pages = table(spark, sf_dir, "pages")
    return html.layouts(pages, html.paragraphs(pages, "page_id", "html"), "page_id", "html")


@query()
def page_paragraphs(spark, sf_dir):
    """The paragraphs of each page."""
    return html.paragraphs(table(spark, sf_dir, "pages"), "page_id", "html").select("page_id", "pos", "text", "number")


def _judgments(spark, sf_dir):
    """Each conversation as a judgment: users' turns are numbered paragraphs, other turns go on."""
    turns = table(spark, sf_dir, "conversations").withColumn("n", F.sum(F.when(F.col("role") == "user", 1).otherwise(0)).over(Window.partitionBy("conv_id").orderBy("turn")))
    words = F.regexp_replace(F.regexp_replace("text", r"[^A-Za-z ]", ""), " +", " ")
    mark = F.concat(F.lit('<p class="'), F.when(F.col("role") == "user", "Judg-1").otherwise("Judg-2"), F.lit('">'), F.when(F.col("role") == "user", F.concat(F.col("n").cast("string"), F.lit(" "))).otherwise(""), F.lit("X"), F.trim(words))
    parts = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", mark.alias("m")))).alias("parts"))
    return parts.select("conv_id", F.concat(F.lit('<div id="judgments">'), F.array_join(F.transform("parts", lambda x: x["m"]), ""), F.lit("</div>")).alias("html"))


@query(r"""WITH t AS (SELECT *, sum((role = 'user')::INT) OVER (PARTITION BY conv_id ORDER BY turn) AS n, 'X' || trim(regexp_replace(regexp_replace(text, '[^A-Za-z ]', '', 'g'), ' +', ' ', 'g')) AS words FROM conversations)
SELECT conv_id, n::INT AS ordinal, string_agg(words, chr(10) ORDER BY turn) AS text FROM t WHERE n > 0 GROUP BY 1, 2""")
def judgment_blocks(spark, sf_dir):
    """Numbered paragraphs of judgments with what follows each."""
    pages = _judgments(spark, sf_dir)
    rows = written(html.paragraphs(pages, "conv_id", "html"), "paragraphs")
    return html.blocks(rows, html.layouts(pages, rows, "conv_id", "html"), "conv_id")


def _pages_of_kinds(spark, sf_dir):
    """Each conversation as a page of one of six layouts, by its number: modern, numbered, with a gap, by line breaks, unknown, blank."""
    turns = table(spark, sf_dir, "conversations").withColumn("n", F.row_number().over(Window.partitionBy("conv_id").orderBy("turn")))
    kind, n = F.col("conv_id") % 6, F.col("n").cast("string")
    words = F.concat(F.lit("Of "), F.col("role"), F.lit(" one two three four five six seven eight nine"))
    part = (
        F.when(kind == 0, F.concat(F.lit('<p class="Judg-Heading-1">5 Heads</p><p class="Judg-1-firstpara">'), n, F.lit(". "), words, F.lit("<p>2 behind<b>it</b>")))
        .when(kind == 1, F.concat(F.lit("<p>"), n, F.lit(".) "), words, F.lit("</p><p>(7) on")))
        .when(kind == 2, F.concat(F.lit("<p>"), (F.col("n") * 2).cast("string"), F.lit(" "), words, F.lit("</p>")))
        .when(kind == 3, F.concat(F.lit("<p>"), words, F.lit("<br><br/>short<br>one<br /><br>"), words, F.lit(" ten</p>")))
        .when(kind == 4, F.lit("<p>too short</p><div>no paragraph at all, however many words there are in it</div>"))
        .otherwise(F.lit(" "))
    )
    parts = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", part.alias("p")))).alias("parts"))
    return parts.select("conv_id", F.array_join(F.transform("parts", lambda x: x["p"]), "").alias("html"))


_KINDS = """WITH t AS (SELECT conv_id, role, conv_id % 6 AS kind, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n FROM conversations), c AS (SELECT conv_id, kind, count(*) AS n FROM t GROUP BY 1, 2) """


@query(_KINDS + """SELECT conv_id, CASE WHEN kind = 0 THEN 'modern_judg1' WHEN kind IN (1, 2) AND n > 1 THEN 'numbered_plain_p' WHEN kind = 3 THEN 'unnumbered_br' WHEN kind = 5 THEN 'failed' ELSE 'unknown' END AS layout,
CASE WHEN kind = 0 OR kind = 1 AND n > 1 THEN n WHEN kind = 2 AND n > 1 OR kind = 3 THEN 2 * n END::BIGINT AS expected, CASE WHEN kind = 0 OR kind IN (1, 2) AND n > 1 THEN n WHEN kind = 3 THEN 2 * n ELSE 0 END::BIGINT AS extracted,
CASE WHEN kind = 2 AND n > 1 THEN 'incomplete' WHEN kind = 5 THEN 'failed' WHEN kind = 4 OR kind IN (1, 2) AND n = 1 THEN 'unknown' ELSE 'complete' END AS parse_status FROM c""")
def judgment_layouts(spark, sf_dir):
    """Layouts and states of pages of all kinds."""
    pages = _pages_of_kinds(spark, sf_dir)
    found = html.layouts(pages, html.paragraphs(pages, "conv_id", "html"), "conv_id", "html")
    return found.withColumns({c: F.col(c).cast("long") for c in ("expected", "extracted")})


@query(_KINDS + """, m AS (SELECT t.*, c.n AS turns, 'Of ' || role || ' one two three four five six seven eight nine' AS words FROM t JOIN c USING (conv_id))
SELECT conv_id, n AS ordinal, words || chr(10) || CASE WHEN kind = 0 THEN '2 behind it' ELSE '(7) on' END AS text FROM m WHERE kind = 0 OR kind = 1 AND turns > 1
UNION ALL SELECT conv_id, n, words FROM m WHERE kind = 2 AND turns > 1 UNION ALL SELECT conv_id, 2 * n - 1, words FROM m WHERE kind = 3 UNION ALL SELECT conv_id, 2 * n, words || ' ten' FROM m WHERE kind = 3""")
def judgment_paragraphs(spark, sf_dir):
    """Paragraphs of pages of all kinds, also of those that only line breaks divide."""
    pages = _pages_of_kinds(spark, sf_dir)
    rows = written(html.paragraphs(pages, "conv_id", "html"), "paragraphs")
    return html.blocks(rows, html.layouts(pages, rows, "conv_id", "html"), "conv_id").withColumn("ordinal", F.col("ordinal").cast("long"))


def _statutes(spark, sf_dir):
    """Each region as a statute of one part: its first three nations are the part's sections, the fourth that of a division within, others stand behind the part.

    Customers' segments are subsections, each with two points and a note; the first has another subsection within.
    """
    customers = table(spark, sf_dir, "customer").select("c_nationkey", "c_mktsegment").distinct()
    subs = customers.groupBy("c_nationkey").agg(F.array_sort(F.collect_list("c_mktsegment")).alias("segments"))
    nth = F.row_number().over(Window.partitionBy("n_regionkey").orderBy("n_nationkey"))
    nation = table(spark, sf_dir, "nation").withColumn("nth", nth).join(subs, F.col("n_nationkey") == F.col("c_nationkey"), "left")
    key = F.col("n_nationkey").cast("string")

    def subsection(segment, i):
        n = (i + 1).cast("string")
        return F.concat(
            F.lit('<div class="prov2Txt"><a name="a'), key, F.lit("-"), n, F.lit('-"></a>('), n, F.lit(") For "), segment, F.lit('<div class="amendNote">['), n, F.lit('/2002]</div><table><tr><td class="p1No">(a)</td><td class="pTxt" id="x'), key, F.lit("-"), n,
            F.lit('">one<table><tr><td class="p2No">(i)</td><td class="p2Txt">deep</td></tr></table></td></tr></table>'), F.when(i == 0, F.lit('<div class="prov2TxtIL">(9) Inner</div>')).otherwise(""), F.lit("</div>"),
        )

    each = F.array_join(F.transform(F.coalesce("segments", F.array().cast("array<string>")), subsection), "")
    section = F.concat(
        F.lit('<div class="prov1" id="pr'), key, F.lit('-"><table><tr><td class="prov1Hdr" id="h'), key, F.lit('-">Of '), F.col("n_name"), F.lit('</td></tr><tr><td class="prov1Txt"><strong>'), key, F.lit('.</strong>—(1) Lead<div class="amendNote">['), key, F.lit("/2001]</div>"),
        each, F.lit("</td></tr></table></div>"),
    )
    division = F.concat(F.lit('<table><tr><td class="div" id="d1"><div class="divNo">Division 2</div><table><tr><td>SOME</td></tr></table>'), section, F.lit("</td></tr></table>"))
    html_of = F.when(F.col("nth") == 4, division).otherwise(section)
    parts = nation.groupBy("n_regionkey").agg(*(F.array_sort(F.collect_list(F.when(which, F.struct("n_nationkey", html_of.alias("s"))))).alias(name) for name, which in (("inner", F.col("nth") <= 4), ("outer", F.col("nth") > 4))))
    region = table(spark, sf_dir, "region").join(parts, F.col("r_regionkey") == F.col("n_regionkey"))
    joined = lambda c: F.array_join(F.transform(c, lambda x: x["s"]), "")
    body = F.concat(
        F.lit('<div class="legis"><div class="front"><table><tr><td>Chapter</td></tr></table><table id="f"><tr><td>An Act of '), F.col("r_name"), F.lit('<div class="amendNote">[1/1]</div></td></tr></table></div><div class="body"><table><tr><td class="part" id="P1-"><div class="partNo">PART 1</div><table><tr><td>GENERAL</td></tr></table>'),
        joined("inner"), F.lit("</td></tr></table>"), joined("outer"), F.lit("</div></div>"),
    )
    return region.select(F.col("r_regionkey").cast("long").alias("doc"), body.alias("html"))


#: Pre-order by path: opening, part, sections by their place (the division before the fourth), subsections, points; the subsection within the first stands behind its points.
_STATUTES = """WITH n AS (SELECT n_regionkey AS doc, n_nationkey AS k, n_name, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS nth FROM nation WHERE n_regionkey IN (SELECT r_regionkey FROM region)),
g AS (SELECT n.*, c_mktsegment AS seg, row_number() OVER (PARTITION BY k ORDER BY c_mktsegment) AS i, CASE WHEN nth <= 3 THEN 2 WHEN nth = 4 THEN 3 ELSE 1 END AS lvl FROM n JOIN (SELECT DISTINCT c_nationkey, c_mktsegment FROM customer) ON c_nationkey = k),
u AS (SELECT r_regionkey AS doc, 0 AS p, 0.0 AS q, 0 AS r, 1 AS level, 'opening' AS kind, NULL AS citation, NULL AS heading, 'An Act of ' || r_name AS content, 'f' AS anchor, '[1/1]' AS note FROM region WHERE r_regionkey IN (SELECT doc FROM n)
  UNION ALL SELECT DISTINCT doc, 1, 0, 0, 1, 'part', 'Pt 1', 'GENERAL', NULL, 'P1-', NULL FROM n
  UNION ALL SELECT doc, 39, 0, 0, 2, 'division', 'Div 2', 'SOME', NULL, 'd1', NULL FROM n WHERE nth = 4
  UNION ALL SELECT doc, 10 * nth, 0, 0, CASE WHEN nth <= 3 THEN 2 WHEN nth = 4 THEN 3 ELSE 1 END, 'section', 's ' || k, 'Of ' || n_name, '—(1) Lead', 'h' || k || '-', '[' || k || '/2001]' FROM n
  UNION ALL SELECT doc, 10 * nth, i, 0, lvl + 1, 'subsection', 's ' || k || '(' || i || ')', NULL, 'For ' || seg, 'a' || k || '-' || i || '-', '[' || i || '/2002]' FROM g
  UNION ALL SELECT doc, 10 * nth, i, 1, lvl + 2, 'point', 's ' || k || '(' || i || ')(a)', NULL, 'one', 'x' || k || '-' || i, NULL FROM g
  UNION ALL SELECT doc, 10 * nth, i, 2, lvl + 3, 'point', 's ' || k || '(' || i || ')(a)(i)', NULL, 'deep', NULL, NULL FROM g
  UNION ALL SELECT doc, 10 * nth, 1.5, 0, lvl + 1, 'subsection', 's ' || k || '(9)', NULL, 'Inner', NULL, NULL FROM g WHERE i = 1),
o AS (SELECT *, row_number() OVER (PARTITION BY doc ORDER BY p, q, r) AS ordinal FROM u),
e AS (SELECT o.doc, o.ordinal, min(x.ordinal) AS stop FROM o JOIN o x ON o.doc = x.doc AND x.ordinal > o.ordinal AND x.level <= o.level GROUP BY 1, 2),
a AS (SELECT o.doc, o.ordinal, max(x.ordinal) AS parent FROM o JOIN o x ON o.doc = x.doc AND x.ordinal < o.ordinal AND x.level = o.level - 1 GROUP BY 1, 2),
t AS (SELECT o.*, parent, coalesce(stop, max(o.ordinal) OVER (PARTITION BY o.doc) + 1) - o.ordinal - 1 AS below FROM o LEFT JOIN e ON o.doc = e.doc AND o.ordinal = e.ordinal LEFT JOIN a ON o.doc = a.doc AND o.ordinal = a.ordinal) """


@query(_STATUTES + """SELECT doc::BIGINT AS doc, ordinal::INT AS ordinal, level::INT AS level, kind, citation, heading, content, anchor, note, parent::INT AS parent_ordinal, below::INT AS descendant_count FROM t""")
def provision_tree(spark, sf_dir):
    """Provision trees of statutes as nested sets."""
    tree_rows = html.provisions(_statutes(spark, sf_dir), "doc", "html")
    return tree_rows.select("doc", "ordinal", "level", "kind", "citation", "heading", "content", "anchor", "note", "parent_ordinal", "descendant_count")


@query("""SELECT p_partkey, unnest([2, 3, 6]) AS ordinal, unnest([2, 3, 3]) AS level, unnest(['s ' || p_partkey || '(a)', 's ' || p_partkey || '(a)(i)', 'Sch para 1(z)']) AS citation, unnest([p_name, p_brand, p_type]) AS content,
unnest([NULL, 't' || p_partkey, NULL]) AS anchor, unnest([NULL, '[1/2]', NULL]) AS note FROM part""")
def provision_points(spark, sf_dir):
    """Points of sections and of schedules, by all kinds of markers; rows without a marker and tables of definitions give none."""
    c = F.col
    body = F.concat(
        F.lit('<div class="body"><div class="prov1"><table><tr><td class="prov1Txt"><strong>'), c("p_partkey").cast("string"), F.lit('.</strong> Of<table><tbody><tr><td class="p1No"> ( a ) </td><td class="pTxt">'), c("p_name"), F.lit('<table><tbody><tr><td class="p2No">(i)</td><td class="p2Txt" id="t'), c("p_partkey").cast("string"),
        F.lit('">'), c("p_brand"), F.lit('<div class="amendNote">[1/2]</div></td></tr></tbody></table></td></tr><tr><td>no</td><td class="pTxt">lost</td></tr></tbody></table> tail<table><tr><td class="def">“x” means<table><tr><td class="p1DefNo">(b)</td><td class="pDefTxt">inner</td></tr></table></td></tr></table></td></tr></table></div></div>'),
        F.lit('<div class="tail"><div class="schedule"><table><tr><td class="sHdr">SCHEDULE</td></tr></table><table><tr><td class="tailSTxt">1. Let<table><tr><td class="sProvP1No">(z)</td><td class="sProvP1">'), c("p_type"), F.lit("</td></tr></table></td></tr></table></div></div>"),
    )
    tree_rows = html.provisions(table(spark, sf_dir, "part").select("p_partkey", body.alias("html")), "p_partkey", "html")
    return tree_rows.filter("kind = 'point'").select("p_partkey", "ordinal", "level", "citation", "content", "anchor", "note")


def _schedules(spark, sf_dir):
    """Each region as a statute with a schedule: nations are its paragraphs, every second one under a heading of its own."""
    nth = F.row_number().over(Window.partitionBy("n_regionkey").orderBy("n_nationkey"))
    nation = table(spark, sf_dir, "nation").withColumn("nth", nth)
    n, lead = F.col("nth").cast("string"), F.concat(F.lit('<table><tr><td class="sProvHdr">On '), F.col("n_name"), F.lit("</td></tr></table>"))
    text = F.concat(F.lit('<table><tr><td class="tailSTxt" id="x'), F.when(F.col("nth") > 3, F.lit("")).otherwise(F.lit("1")), F.lit('">'), n, F.lit('. Of '), F.col("n_name"), F.lit('<div class="prov2Txt">(1) Sub'), n, F.lit("</div></td></tr></table>"))
    part = F.concat(F.when(F.col("nth") % 2 == 1, lead).otherwise(""), text)
    parts = nation.groupBy("n_regionkey").agg(F.array_sort(F.collect_list(F.struct("nth", part.alias("p")))).alias("parts"))
    region = table(spark, sf_dir, "region").join(parts, F.col("r_regionkey") == F.col("n_regionkey"))
    head = F.concat(F.lit('<div class="legis"><div class="tail"><div class="schedule"><table><tr><td class="sHdr" id="Sc-">'), F.element_at(F.array(*map(F.lit, ("First Schedule", "SECOND SCHEDULE", "3rd Schedule"))), (F.col("r_regionkey") % 3 + 1).cast("int")), F.lit('</td></tr></table><table><tr><td class="scHdr">About '), F.col("r_name"), F.lit("</td></tr></table>"))
    return region.select(F.col("r_regionkey").cast("long").alias("doc"), F.concat(head, F.array_join(F.transform("parts", lambda x: x["p"]), ""), F.lit("</div></div></div>")).alias("html"))


_SCHEDULES = """WITH n AS (SELECT *, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS nth, 'Sch ' || (n_regionkey % 3 + 1) AS sch FROM nation),
s AS (SELECT r_regionkey::BIGINT AS doc, 1 AS ordinal, 1 AS level, NULL AS parent_ordinal, 'schedule' AS kind, 'Sch ' || (r_regionkey % 3 + 1) AS citation, ['First Schedule', 'SECOND SCHEDULE', '3rd Schedule'][r_regionkey % 3 + 1] AS heading, 'About ' || r_name AS content, 'Sc-' AS anchor FROM region WHERE r_regionkey IN (SELECT n_regionkey FROM n)
UNION ALL SELECT n_regionkey, 2 * nth, 2, 1, 'section', sch || ' para ' || nth, CASE WHEN nth % 2 = 1 THEN 'On ' || n_name END, 'Of ' || n_name, CASE WHEN nth > 3 THEN 'x' ELSE 'x1' END FROM n
UNION ALL SELECT n_regionkey, 2 * nth + 1, 3, 2 * nth, 'subsection', sch || ' para ' || nth || '(1)', NULL, 'Sub' || nth, NULL FROM n) """


@query(_SCHEDULES + """SELECT doc, ordinal::INT AS ordinal, level::INT AS level, parent_ordinal::INT AS parent_ordinal, kind, citation, heading, content FROM s""")
def schedule_paragraphs(spark, sf_dir):
    """Schedules with their paragraphs, and headings that belong to the next paragraph only."""
    return html.provisions(_schedules(spark, sf_dir), "doc", "html").select("doc", "ordinal", "level", "parent_ordinal", "kind", "citation", "heading", "content")


@query(_SCHEDULES + """, k AS (SELECT *, coalesce(anchor, 'n' || ordinal) AS a FROM s), u AS (SELECT *, 'http://x/' || doc || '#' || a || CASE WHEN row_number() OVER (PARTITION BY doc, a ORDER BY ordinal) > 1 THEN '-' || ordinal ELSE '' END AS uri FROM k)
SELECT u.doc, u.ordinal::INT AS ordinal, u.uri, p.uri AS parent_uri FROM u LEFT JOIN u p ON u.doc = p.doc AND u.parent_ordinal = p.ordinal""")
def provision_uris(spark, sf_dir):
    """Addresses of provisions by their anchors or ordinals, and those of their parents."""
    tree_rows = written(html.provisions(_schedules(spark, sf_dir), "doc", "html"), "tree")
    return knowledge.provision_uris(tree_rows, "doc", F.concat(F.lit("http://x/"), F.col("doc").cast("string"))).select("doc", "ordinal", "uri", "parent_uri")


@query("""SELECT o_custkey, l_linenumber::INT AS ordinal, 'http://c/' || o_orderkey || '#' || l_linenumber AS uri FROM orders JOIN lineitem ON l_orderkey = o_orderkey""")
def paragraph_uris(spark, sf_dir):
    """Addresses of paragraphs: their case's, and their ordinal."""
    cases = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("case"), "o_custkey", F.concat(F.lit("http://c/"), F.col("o_orderkey").cast("string")).alias("case_uri"))
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("case"), F.col("l_linenumber").cast("int").alias("ordinal"))
    found = knowledge.paragraph_uris(lines, cases, "case", "case_uri")
    return found.join(cases.select("case", "o_custkey"), "case").select("o_custkey", "ordinal", "uri")


@query("""WITH v AS (SELECT o_orderkey AS id FROM orders WHERE o_orderstatus = 'F'), p AS (SELECT CASE WHEN l_orderkey % 2 = 0 THEN l_orderkey END AS a, CASE WHEN l_orderkey % 2 = 1 THEN l_orderkey END AS s, l_linenumber FROM lineitem)
SELECT 1 AS branch, a AS document, row_number() OVER (PARTITION BY a ORDER BY l_linenumber) AS place FROM p JOIN v ON a = id UNION ALL SELECT 2, s, row_number() OVER (PARTITION BY s ORDER BY l_linenumber) FROM p WHERE s IS NOT NULL""")
def current_trees(spark, sf_dir):
    """Current act trees, then those of subsidiary legislation."""
    key = F.col("l_orderkey")
    rows = table(spark, sf_dir, "lineitem").select(F.when(key % 2 == 0, key).alias("act_version_id"), F.when(key % 2 == 1, key).alias("subsidiary_legislation_id"), F.col("l_linenumber").alias("ordinal"))
    versions = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), (F.col("o_orderstatus") == "F").alias("is_current"))
    return knowledge.current_trees(rows, versions).select("branch", "document", F.col("place").cast("long").alias("place"))


@query("""SELECT o_orderkey AS doc, CASE WHEN kind = 4 THEN NULL ELSE sections + schedules + stray END::BIGINT AS expected, (sections + schedules)::BIGINT AS extracted,
CASE WHEN kind = 4 THEN 'failed' WHEN sections + schedules + stray = 0 THEN 'unknown' WHEN stray = 0 THEN 'complete' ELSE 'incomplete' END AS parse_status
FROM (SELECT o_orderkey, o_orderkey % 5 AS kind, CASE WHEN o_orderkey % 5 IN (3, 4) THEN 0 ELSE 2 END AS sections, CASE WHEN o_orderkey % 5 IN (1, 2) THEN 1 ELSE 0 END AS schedules, CASE WHEN o_orderkey % 5 = 2 THEN 1 ELSE 0 END AS stray FROM orders)""")
def legislation_status(spark, sf_dir):
    """Expected and extracted provisions: of statutes, of those with schedules, of such with a section outside of the body, of pages without any, and of blank ones."""
    key, kind = F.col("o_orderkey").cast("string"), F.col("o_orderkey") % 5
    section = lambda n: F.concat(F.lit('<div class="prov1"><table><tr><td class="prov1Txt"><strong>'), key, F.lit(f'{n}.</strong> Text<div class="prov2Txt">(2) More</div></td></tr></table></div>'))
    schedule = F.lit('<div class="tail"><div class="schedule"><table><tr><td class="sHdr">FIRST SCHEDULE</td></tr></table><table><tr><td class="tailSTxt">1. One<div class="prov2Txt">(1) Sub</div></td></tr></table><table><tr><td class="tailSTxt">2. Two</td></tr></table></div></div>')
    body = F.concat(F.lit('<div class="legis"><div class="body">'), section("A"), section("B"), F.lit("</div>"), F.when(kind.isin(1, 2), schedule).otherwise(""), F.when(kind == 2, section("C")).otherwise(""), F.lit("</div>"))
    page = F.when(kind == 4, F.lit(" \n ")).when(kind == 3, F.concat(F.lit("<p>Nothing of "), key)).otherwise(body)
    found = html.legislation_status(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc"), page.alias("html")), "doc", "html")
    return found.withColumns({c: F.col(c).cast("long") for c in ("expected", "extracted")})


@query("""SELECT p_partkey, p_brand AS term, 'means ' || p_name AS definition FROM part""")
def definition_rows(spark, sf_dir):
    """Defined terms of statutes."""
    cell = F.concat(F.lit('<table><tr><td class="def">“'), F.col("p_brand"), F.lit("” means "), F.col("p_name"), F.lit('<span class="amendNote">[1/2000]</span></td></tr><tr><td class="def">“'), F.col("p_brand"), F.lit("” means another</td></tr></table>"))
    return html.definitions(table(spark, sf_dir, "part").select("p_partkey", cell.alias("html")), "p_partkey", "html")


def _paragraphs(spark, sf_dir):
    """Each order as a case with a paragraph for each line: the first names a case and an act, the others define more, refer back, or name nothing."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber").distinct()
    n, key = F.col("l_linenumber").cast("string"), F.col("l_orderkey").cast("string")
    first = F.concat(F.lit("See Re Alpha [2001] SGHC "), (F.col("l_orderkey") + 1).cast("string"), F.lit(" (“Alpha”) at [1]–[3], and s "), n, F.lit("(2)(a), 13A and 14 of the Sale of Goods Act 1999 (Cap 393) (the “SGA”)."))
    third = F.lit("The firm Ong Works Pte (“Company”) won; see Beta v Gamma [2002] SGHC 7, (“Beta”). See s 3 of the Company and s 4. Later (at [3]).")
    fourth = F.lit("Under r 4 of the Rules of Court 2014 (“Rules”), then rule 5; Re Delta Co at [1]. It holds (at [4]).")
    fifth = F.lit("Set out at [5] and described at [1]. Alpha at [5] agrees. The Evidence Act 1893 (Cap 97, 1997 Rev Ed) (the “EA” or the “Act”), s 6; EA.")
    rest = F.concat(F.lit("As held (at ["), n, F.lit("]), s "), n, F.lit(" applies; see [1999] 2 SLR(R) "), key, F.lit(" and above at [1]. Alpha at [2] agrees."))
    number = F.col("l_linenumber")
    text = F.when(number == 1, first).when(number == 3, third).when(number == 4, fourth).when(number == 5, fifth).otherwise(rest)
    return lines.select(F.col("l_orderkey").alias("case_id"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), number.cast("int").alias("ordinal"), text.alias("content"))


#: Short names by the paragraph that defines them, and what they stand for.
_NAMES = """WITH p AS (SELECT DISTINCT l_orderkey AS c, l_linenumber AS n FROM lineitem),
names AS (
  SELECT c, 'Alpha' AS short_name, 'Re Alpha [2001] SGHC ' || (c + 1) AS expanded, 'case' AS kind, '[2001] SGHC ' || (c + 1) AS cited FROM p WHERE n = 1
  UNION ALL SELECT c, 'SGA', 'Sale of Goods Act 1999 (Cap 393)', 'act', NULL FROM p WHERE n = 1
  UNION ALL SELECT c, 'Company', 'The firm Ong Works Pte', 'fact', NULL FROM p WHERE n = 3
  UNION ALL SELECT c, 'Beta', 'Beta v Gamma [2002] SGHC 7', 'case', '[2002] SGHC 7' FROM p WHERE n = 3
  UNION ALL SELECT c, 'Rules', 'Under r 4 of the Rules of Court 2014', 'rules', NULL FROM p WHERE n = 4
  UNION ALL SELECT c, unnest(['EA', 'Act']), 'The Evidence Act 1893 (Cap 97, 1997 Rev Ed)', 'act', NULL FROM p WHERE n = 5) """


@query(_NAMES + """SELECT c AS case_id, short_name, expanded, kind FROM names""")
def aliases(spark, sf_dir):
    """Short names that cases define."""
    return citations.extract_aliases(_paragraphs(spark, sf_dir))


#: The references of each paragraph as its text has them (bare ones as kind pin, or without name and alias), then what a case
#: has come to at each: the last short name, or else title, of a case, act or rules, pins behind a paragraph's other references.
_SPANS = _NAMES + """, h AS (SELECT c, bool_or(n = 1) AS named FROM p GROUP BY c), q AS (SELECT p.*, named FROM p JOIN h USING (c)),
r AS (
  SELECT c, n, 1 AS pos, 'case' AS kind, 'Re Alpha' AS name, 'Alpha' AS alias, '[2001] SGHC ' || (c + 1) AS neutral, '1,2,3' AS pins, '' AS provisions FROM q WHERE n = 1
  UNION ALL SELECT c, n, 2, 'provision', 'Sale of Goods Act 1999', 'SGA', NULL, '', 's 1(2)(a),s 13A,s 14' FROM q WHERE n = 1
  UNION ALL SELECT c, n, 1, 'pin', NULL, NULL, NULL, n::VARCHAR, '' FROM q WHERE n = 2 OR n > 5
  UNION ALL SELECT c, n, 2, 'provision', NULL, NULL, NULL, '', 's ' || n FROM q WHERE n = 2 OR n > 5
  UNION ALL SELECT c, n, 3, 'case', NULL, NULL, NULL, '', '' FROM q WHERE n = 2 OR n > 5
  UNION ALL SELECT c, n, 4, 'self', NULL, NULL, NULL, '1', '' FROM q WHERE n = 2 OR n > 5
  UNION ALL SELECT c, n, 5, CASE WHEN named THEN 'case' ELSE 'pin' END, NULL, CASE WHEN named THEN 'Alpha' END, CASE WHEN named THEN '[2001] SGHC ' || (c + 1) END, '2', '' FROM q WHERE n = 2 OR n > 5
  UNION ALL SELECT c, n, 1, 'case', 'Beta v Gamma', NULL, '[2002] SGHC 7', '', '' FROM q WHERE n = 3
  UNION ALL SELECT c, n, 2, 'provision', NULL, NULL, NULL, '', unnest(['s 3', 's 4']) FROM q WHERE n = 3
  UNION ALL SELECT c, n, 4, 'pin', NULL, NULL, NULL, '3', '' FROM q WHERE n = 3
  UNION ALL SELECT c, n, 1, 'rule', NULL, 'Rules', NULL, '', 'r 4' FROM q WHERE n = 4
  UNION ALL SELECT c, n, 2, 'rule', NULL, NULL, NULL, '', 'r 5' FROM q WHERE n = 4
  UNION ALL SELECT c, n, 3, 'case', 'Re Delta Co', NULL, NULL, '1', '' FROM q WHERE n = 4
  UNION ALL SELECT c, n, 4, 'pin', NULL, NULL, NULL, '4', '' FROM q WHERE n = 4
  UNION ALL SELECT c, n, 1, 'self', NULL, NULL, NULL, unnest(['5', '1']), '' FROM q WHERE n = 5
  UNION ALL SELECT c, n, 3, CASE WHEN named THEN 'case' ELSE 'pin' END, NULL, CASE WHEN named THEN 'Alpha' END, CASE WHEN named THEN '[2001] SGHC ' || (c + 1) END, '5', '' FROM q WHERE n = 5
  UNION ALL SELECT c, n, 4, 'act', NULL, 'Act', NULL, '', '' FROM q WHERE n = 5
  UNION ALL SELECT c, n, 5, 'provision', NULL, NULL, NULL, '', 's 6' FROM q WHERE n = 5
  UNION ALL SELECT c, n, 6, 'act', NULL, 'EA', NULL, '', '' FROM q WHERE n = 5),
s AS (SELECT *, coalesce(alias, name) AS said,
  last_value(CASE WHEN kind = 'case' THEN coalesce(alias, name) END IGNORE NULLS) OVER w AS last_case,
  last_value(CASE WHEN kind IN ('provision', 'act') THEN coalesce(alias, name) END IGNORE NULLS) OVER w AS last_act,
  last_value(CASE WHEN kind = 'rule' THEN coalesce(alias, name) END IGNORE NULLS) OVER w AS last_rules
  FROM r WINDOW w AS (PARTITION BY c ORDER BY n, kind = 'pin', pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
x AS (SELECT c, n, CASE WHEN kind <> 'pin' THEN kind WHEN last_case IS NULL THEN 'self' ELSE 'case' END AS kind, name, neutral, pins, provisions,
  CASE WHEN said IS NOT NULL THEN alias WHEN kind = 'pin' THEN last_case WHEN kind = 'provision' THEN last_act WHEN kind = 'rule' THEN last_rules END AS alias FROM s) """


def _listed(spans):
    """Spans with their lists as texts."""
    return spans.withColumns({"pins": F.array_join(F.col("pins").cast("array<string>"), ","), "provisions": F.array_join("provisions", ",")})


@query(_SPANS + """SELECT c AS case_id, (c * 10 + n)::BIGINT AS paragraph_id, kind, name, alias, neutral, pins, provisions FROM x""")
def citation_spans(spark, sf_dir):
    """References of paragraphs, with what bare ones mean."""
    return _listed(citations.case_references(_paragraphs(spark, sf_dir))).select("case_id", "paragraph_id", "kind", "name", "alias", "neutral", "pins", "provisions")


_RESOLVED = _SPANS + """, k AS (SELECT DISTINCT c FROM p),
w AS (SELECT x.*, CASE WHEN x.kind = 'case' THEN coalesce(x.neutral, names.cited) END AS wanted FROM x LEFT JOIN names ON x.c = names.c AND x.alias = names.short_name),
t AS (SELECT w.*, k.c AS t FROM w LEFT JOIN k ON w.wanted = '[2001] SGHC ' || k.c),
y AS (SELECT t.*, m.n AS hit FROM t LEFT JOIN p m ON m.c = CASE WHEN kind = 'self' THEN t.c ELSE t END AND m.n::VARCHAR = t.pins) """


def _cases(paragraphs):
    return paragraphs.select("case_id").distinct().withColumn("neutral_citation", F.concat(F.lit("[2001] SGHC "), F.col("case_id").cast("string")))


@query(_RESOLVED + """SELECT c AS case_id, (c * 10 + n)::BIGINT AS paragraph_id, kind, pins, CASE WHEN hit IS NULL AND kind = 'case' THEN t END AS target_case, CASE WHEN hit IS NOT NULL THEN CASE WHEN kind = 'self' THEN c ELSE t END * 10 + hit END::BIGINT AS target_paragraph FROM y""")
def resolved_references(spark, sf_dir):
    """What references refer to: a case, or a paragraph of one."""
    paragraphs = _paragraphs(spark, sf_dir)
    done = citations.resolve(citations.case_references(paragraphs), _cases(paragraphs), paragraphs)
    return _listed(done).select("case_id", "paragraph_id", "kind", "pins", "target_case", "target_paragraph")


@query(_RESOLVED + """SELECT c AS case_id, (c * 10 + n)::BIGINT AS paragraph_id, kind, pins, CASE WHEN hit IS NULL AND kind = 'case' THEN t END AS target_case, CASE WHEN hit IS NOT NULL THEN CASE WHEN kind = 'self' THEN c ELSE t END * 10 + hit END::BIGINT AS target_paragraph FROM y""")
def late_references(spark, sf_dir):
    """References resolved as their targets arrive, cases of even numbers first: in the end they refer to what one batch finds."""
    paragraphs = written(_paragraphs(spark, sf_dir), "paragraphs")
    store = references.ReferenceStore(spark, new_folder(spark, "references"))
    for number, odd in ((1, 0), (2, 1)):
        some = lambda rows: rows.filter(F.col("case_id") % 2 == odd)  # noqa: B023, E731
        store.add(number, citations.case_references(some(paragraphs)), None, _cases(some(paragraphs)), some(paragraphs))
    return _listed(store.references()).select("case_id", "paragraph_id", "kind", "pins", "target_case", "target_paragraph")


@query(_SPANS + """SELECT c AS case_id, (c * 10 + n)::BIGINT AS paragraph_id, kind, name, alias, neutral, pins, provisions FROM x""")
def streamed_spans(spark, sf_dir):
    """References of paragraphs that arrive in three parts: each part is a run of the stream, which goes on with the state of the last."""
    paragraphs = written(_paragraphs(spark, sf_dir), "paragraphs")
    folder = new_folder(spark, "stream")
    citations.extract_aliases(paragraphs).write.parquet(f"{folder}/aliases")
    for low, high in ((1, 2), (3, 4), (5, 1_000_000)):
        paragraphs.filter(F.col("ordinal").between(low, high)).write.mode("append").parquet(f"{folder}/paragraphs")
        discourse.stream_spans(spark, f"{folder}/paragraphs", f"{folder}/aliases", f"{folder}/spans", f"{folder}/checkpoint")
    return _listed(spark.read.schema(citations.SPAN_SCHEMA).parquet(f"{folder}/spans")).select("case_id", "paragraph_id", "kind", "name", "alias", "neutral", "pins", "provisions")


@query(_SPANS + """SELECT c AS case_id, (c * 10 + n)::BIGINT AS paragraph_id, kind, name, alias, neutral, pins, provisions FROM x""")
def table_function_spans(spark, sf_dir):
    """The same by a table function in SQL text: aliases, spans and state of a case in one walk, with one shuffle."""
    tables.register(spark)
    _paragraphs(spark, sf_dir).createOrReplaceTempView("case_paragraphs")
    return _listed(spark.sql("SELECT * FROM citation_spans(TABLE(case_paragraphs) PARTITION BY pmod(xxhash64(case_id), 4096) ORDER BY (case_id, ordinal))")).select("case_id", "paragraph_id", "kind", "name", "alias", "neutral", "pins", "provisions")


@query(_STATUTES + """SELECT doc::BIGINT AS doc, ordinal::INT AS ordinal, level::INT AS level, kind, citation, content, parent::INT AS parent_ordinal FROM t""")
def table_function_tree(spark, sf_dir):
    """Provision trees by a table function in SQL text."""
    tables.register(spark)
    _statutes(spark, sf_dir).createOrReplaceTempView("statute_pages")
    return spark.sql("SELECT key AS doc, ordinal, level, kind, citation, content, parent_ordinal FROM provision_tree(TABLE(statute_pages))")


@query("""SELECT c_custkey, 'Person A' || c_custkey AS name, CASE WHEN c_custkey % 2 = 0 THEN 'plaintiff' END AS role FROM customer UNION ALL SELECT c_custkey, 'Company B', CASE WHEN c_custkey % 2 = 0 THEN 'plaintiff' END FROM customer WHERE c_custkey % 2 = 0""")
def party_rows(spark, sf_dir):
    """Parties in metadata of two shapes."""
    person = F.concat(F.lit("Person A"), F.col("c_custkey").cast("string"))
    both = F.concat(F.lit('{"Parties": {"Party": [{"Role": "plaintiff", "Name": ["'), person, F.lit('", "Company B"]}]}}'))
    one = F.concat(F.lit('{"Parties": {"Party": "'), person, F.lit('"}}'))
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.explode(people.parties(F.when(F.col("c_custkey") % 2 == 0, both).otherwise(one))).alias("p"))
    return rows.select("c_custkey", "p.name", "p.role")


@query("""SELECT c_custkey, unnest(['Ann Lee SC', 'Bob Tan' || chr(65 + (c_custkey % 26)::INT), 'Cy Ong']) AS name, unnest(['appellant', 'appellant', 'first respondent']) AS represents FROM customer""")
def counsel_rows(spark, sf_dir):
    """Counsel, and for whom they speak."""
    line = F.concat(F.lit('{"Counsels": {"Counsel": ["Ann Lee, SC and Bob Tan'), F.char(65 + F.col("c_custkey") % 26), F.lit(' (Lee & Tan LLP) for the appellant. Cy Ong (instructed) for the first respondent.", "The second respondent in person"]}}'))
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.explode(people.counsel(line)).alias("c"))
    return rows.select("c_custkey", "c.name", "c.represents")


@query("""SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'Tay' WHEN c_custkey % 3 = 1 THEN 'Ang Bo' ELSE 'Lim Judge' END AS name, CASE WHEN c_custkey % 3 < 2 THEN CASE WHEN c_custkey % 3 = 0 THEN 'CJ' ELSE 'J' END END AS title,
'SGHC' AS court, 'General Division of the High Court' AS court_name FROM customer""")
def judges_and_courts(spark, sf_dir):
    """Judges' names and titles, and courts by code."""
    name = F.when(F.col("c_custkey") % 3 == 0, "Tay  CJ").when(F.col("c_custkey") % 3 == 1, "Ang Bo J").otherwise("Lim Judge")
    code = scalars.court_code(F.lit(None).cast("string"), F.concat(F.lit("[2001] SGHC "), F.col("c_custkey").cast("string")))
    rows = table(spark, sf_dir, "customer").select("c_custkey", scalars.judge(name).alias("j"), code.alias("court"))
    return rows.select("c_custkey", "j.name", "j.title", "court", scalars.court_name(F.col("court")).alias("court_name"))


@query("""SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'Given ' || c_name WHEN 1 THEN 'Found ' || c_name END AS title, CASE WHEN c_custkey % 2 = 0 THEN 'HC/' || c_custkey ELSE 'Suit ' || c_custkey END AS number FROM customer""")
def case_titles(spark, sf_dir):
    """Titles and numbers from the metadata, else from the search hit."""
    key, k3, k2 = F.col("c_custkey").cast("string"), F.col("c_custkey") % 3, F.col("c_custkey") % 2
    title = F.when(k3 == 0, F.concat(F.lit('" Given  '), F.col("c_name"), F.lit('"'))).otherwise(F.lit('" "'))
    metadata = F.concat(F.lit('{"CaseTitle": '), title, F.when(k2 == 0, F.concat(F.lit(', "CaseNumber": "HC/'), key, F.lit('"'))).otherwise(F.lit(', "CaseNumber": 7')), F.lit("}"))
    hit = F.concat(F.lit('{"titles": ['), F.when(k3 == 2, F.lit("")).otherwise(F.concat(F.lit('"Found '), F.col("c_name"), F.lit('", "x"'))), F.lit('], "casenumber": "Suit '), key, F.lit('"}'))
    return table(spark, sf_dir, "customer").select("c_custkey", people.case_title(metadata, hit).alias("title"), people.case_number(metadata, hit).alias("number"))


@query("""WITH j AS (SELECT CASE WHEN toxic = 1 THEN -100 ELSE quality END AS gold, doc_id % 2 AS predicted FROM labels) SELECT round(coalesce(avg((gold = predicted)::INT), 0), 9) AS accuracy FROM j WHERE gold <> -100""")
def accuracy(spark, sf_dir):
    """Accuracy of rows that have a gold label."""
    rows = table(spark, sf_dir, "labels").select(F.when(F.col("toxic") == 1, -100).otherwise(F.col("quality")).alias("gold"), (F.col("doc_id") % 2).alias("predicted"))
    return labels.accuracy(rows, "gold", "predicted").select(F.round("accuracy", 9).alias("accuracy"))


@query("""SELECT round(coalesce(sum(n_chars / 7.0::DOUBLE) FILTER (toxic = 1), 0) / greatest(count(*) FILTER (toxic = 1), 1), 6) AS loss FROM documents JOIN labels USING (doc_id)""")
def mean_loss(spark, sf_dir):
    """The mean of a loss over masked rows."""
    rows = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id").select((F.col("n_chars") / 7.0).alias("loss"), (F.col("toxic") == 1).alias("mask"))
    return labels.mean_loss(rows, "loss", "mask").select(F.round("loss", 6).alias("loss"))


@query("""SELECT doc_id, CASE WHEN n_chars < 100 THEN 'too short' WHEN lang <> 'en' THEN 'other language' END AS reason FROM documents WHERE n_chars < 100 OR lang <> 'en' ORDER BY doc_id LIMIT 40""")
def first_failures(spark, sf_dir):
    """The first 40 failures."""
    docs = table(spark, sf_dir, "documents").withColumn("reason", queue.first_failure((F.col("n_chars") < 100, "too short"), (F.col("lang") != "en", "other language")))
    return queue.first_failures(docs.select("doc_id", "reason"), "reason", [F.col("doc_id")])


@query("""SELECT least(count(*), 300) AS total FROM documents""")
def bounded_total(spark, sf_dir):
    """How many rows a bounded run will see."""
    return queue.bounded_total(table(spark, sf_dir, "documents"), 300)


@query("""WITH s AS (SELECT source AS name, row_number() OVER (ORDER BY source) - 1 AS i FROM (SELECT DISTINCT source FROM documents WHERE lang = 'en')), t AS (SELECT source AS name, row_number() OVER (ORDER BY source) - 1 AS i FROM (SELECT DISTINCT source FROM documents))
SELECT t.name, t.i AS index, s.i AS source_index FROM t LEFT JOIN s ON t.name = s.name WHERE t.name IS NOT NULL""")
def aligned_labels(spark, sf_dir):
    """One label space's indexes beside another's, by name."""
    docs = table(spark, sf_dir, "documents").select(F.col("source").alias("name"), "lang")
    return knowledge.align(labels.scheme(docs.filter("lang = 'en'"), "name"), labels.scheme(docs, "name"), "name", "index")


@query("""WITH c AS (SELECT DISTINCT event_type AS concept FROM events) SELECT concept, CASE concept WHEN 'click' THEN 0 WHEN 'view' THEN 1 ELSE -1 END AS topic_index FROM c""")
def concept_topics(spark, sf_dir):
    """Home topics by names in any case, -1 for none."""
    concepts = table(spark, sf_dir, "events").select(F.col("event_type").alias("concept")).distinct()
    homes = spark.createDataFrame([("CLICK", "Acts"), ("View", "Looks"), ("purchase", "Unknown")], "concept string, topic string")
    return knowledge.home_topics(concepts, homes, spark.createDataFrame([("acts", 0), ("LOOKS", 1)], "topic string, index int"))


@query("""WITH r AS (SELECT user_id, unnest(array_agg(DISTINCT event_type)) AS t FROM events GROUP BY user_id), d AS (SELECT event_type AS t, row_number() OVER (ORDER BY event_type) - 1 AS index FROM (SELECT DISTINCT event_type FROM events WHERE event_type <> 'click')) SELECT user_id, index FROM r JOIN d USING (t)""")
def junction_rows(spark, sf_dir):
    """Rows of classifications by the ids of their names."""
    events = table(spark, sf_dir, "events")
    results = events.groupBy("user_id").agg(F.collect_list("event_type").alias("names"))
    return knowledge.classification_rows(results, "user_id", "names", labels.scheme(events.filter("event_type <> 'click'"), "event_type"), "event_type", "index")


@query("""SELECT o_orderkey, o_orderstatus <> 'F' OR (CASE WHEN o_orderkey % 3 > 0 THEN o_orderkey % 3 END) IS DISTINCT FROM (CASE WHEN o_custkey % 3 > 0 THEN o_custkey % 3 END) AS needs_review FROM orders""")
def review_flags(spark, sf_dir):
    """Versions that failed, or whose provisions differ in number from the expected."""
    some = lambda c: F.when(F.col(c) % 3 > 0, F.col(c) % 3)
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") == "F", "success").otherwise("error").alias("fetch"), some("o_orderkey").alias("expected"), some("o_custkey").alias("extracted"))
    return knowledge.fetch_state(rows, "fetch", "expected", "extracted").select("o_orderkey", "needs_review")


@query("""WITH c AS (SELECT *, c_custkey % 4 AS k, c_custkey % 7 = 0 AS had FROM customer),
j AS (SELECT c_custkey AS id, unnest(CASE k WHEN 0 THEN ['Tay', 'Lim Bo'] WHEN 1 THEN ['Ang ' || c_nationkey] ELSE ['Ong'] END) AS name, unnest(CASE k WHEN 0 THEN ['CJ', NULL] WHEN 1 THEN ['J'] ELSE ['JC'] END) AS title FROM c WHERE k < 3),
p AS (SELECT c_custkey AS id, c_name AS name, 'plaintiff' AS role FROM c UNION ALL SELECT c_custkey, 'Bank ' || c_nationkey, 'defendant' FROM c),
n AS (SELECT c_custkey AS id, 'Ann Lee SC' AS name, 'plaintiff' AS represents FROM c WHERE k = 2),
js AS (SELECT *, row_number() OVER (ORDER BY name, title NULLS FIRST) + 1 AS key FROM (SELECT DISTINCT name, title FROM j WHERE name <> 'Ong')), ps AS (SELECT *, row_number() OVER (ORDER BY name) AS key FROM (SELECT DISTINCT name FROM p))
SELECT 'judge' AS who, id, CASE WHEN j.name = 'Ong' THEN 1 ELSE js.key END::BIGINT AS key, j.title AS what FROM j LEFT JOIN js ON j.name = js.name AND j.title IS NOT DISTINCT FROM js.title
UNION ALL SELECT 'party', id, ps.key, role FROM p JOIN ps USING (name) UNION ALL SELECT 'counsel', id, 1, represents FROM n""")
def promoted_people(spark, sf_dir):
    """Judges, parties and counsel of promoted cases, with the next keys for new names: judges of the metadata, or else of the search hit; one judge and one case of theirs are stored already."""
    customers = table(spark, sf_dir, "customer")
    k, nation = F.col("c_custkey") % 4, F.col("c_nationkey").cast("string")
    corams = F.when(k == 0, F.lit('"Corams": {"Coram": [{"content": "Tay  CJ"}, "Lim Bo", ["x"], "Tay CJ"]}, ')).otherwise("")
    sides = F.when(k == 2, F.lit('"Counsels": {"Counsel": "Ann Lee SC (Lee LLP) for the plaintiff. The defendant absent."}, ')).otherwise("")
    metadata = F.concat(F.lit("{"), corams, sides, F.lit('"Parties": {"Party": [{"Role": "plaintiff", "Name": "'), F.col("c_name"), F.lit('"}, {"Role": "defendant", "Party": ["Bank '), nation, F.lit('", "Bank '), nation, F.lit('"]}]}}'))
    hit = F.when(k == 1, F.concat(F.lit('{"corams": ["Ang '), nation, F.lit(' J", 7, {"content": "no"}]}'))).when(k == 2, F.lit('{"corams": ["Ong JC"]}')).otherwise(F.lit('{"corams": []}'))
    cases = customers.select(F.col("c_custkey").alias("id"), F.lit("SGHC").alias("court"), metadata.alias("metadata"), hit.alias("hit"))
    stored = {name: spark.createDataFrame([], schema) for name, schema in pipelines.PEOPLE.items()}
    stored["judges"] = spark.createDataFrame([(1, "Ong", "JC")], pipelines.PEOPLE["judges"])
    stored["case_judges"] = cases.filter("id % 4 = 2 AND id % 7 = 0").select(F.col("id").alias("case_id"), F.lit(1).cast("long").alias("judge_id"))
    found = pipelines.promote_people(cases, stored)
    titles = found["judges"].select(F.col("id").alias("judge_id"), F.col("title").alias("what"))
    parts = [found["case_judges"].join(titles, "judge_id").select(F.lit("judge").alias("who"), F.col("case_id").alias("id"), F.col("judge_id").alias("key"), "what"), found["case_parties"].select(F.lit("party"), "case_id", "party_id", "role"), found["case_counsel"].select(F.lit("counsel"), "case_id", "counsel_id", "represents")]
    return parts[0].union(parts[1]).union(parts[2])


@query("""WITH n AS (SELECT p_partkey AS id, p_size, p_partkey % 5 = 0 AS old, p_partkey % 4 <> 1 AS cur, p_partkey % 7 = 3 AS stray, p_partkey % 9 = 4 AS fewer FROM part),
d AS (SELECT *, row_number() OVER (ORDER BY 'http://sl/' || id) + (SELECT count(*) FROM n WHERE old) AS key FROM n WHERE cur AND NOT old AND NOT stray AND NOT fewer),
a AS (SELECT p_size, row_number() OVER (ORDER BY 'http://act/' || p_size) + 1 AS act FROM (SELECT DISTINCT p_size FROM d WHERE p_size <> 1))
SELECT d.key::BIGINT AS id, CASE WHEN d.p_size = 1 THEN 1 ELSE a.act END::BIGINT AS act_id, 'S ' || d.id AS number, unnest(['http://sl/' || d.id || '#q', 'http://sl/' || d.id || '#n2', 'http://sl/' || d.id || '#n3']) AS uri,
unnest([NULL, 'http://sl/' || d.id || '#q', NULL]) AS parent_uri, unnest(['s ' || d.id, 's ' || d.id || '(a)', 'Sch']) AS citation FROM d LEFT JOIN a USING (p_size)""")
def subsidiary_promotion(spark, sf_dir):
    """Subsidiary legislation from its pages to provisions with addresses: current, complete and unchanged versions of instruments that aren't stored yet."""
    key, number = F.col("p_partkey"), F.col("p_partkey").cast("string")
    stray = F.when(key % 7 == 3, F.lit('<div class="prov1"></div>')).otherwise("")
    page = F.concat(
        F.lit('<div class="legis"><div class="body"><div class="prov1" id="q"><table><tr><td class="prov1Txt"><strong>'), number, F.lit('.</strong> These Rules<table><tr><td class="p1No">(a)</td><td class="pTxt">apply</td></tr></table></td></tr></table></div></div>'), stray,
        F.lit('<div class="tail"><div class="schedule"><table><tr><td class="sHdr">SCHEDULE</td></tr></table></div></div></div>'),
    )
    parts = table(spark, sf_dir, "part").select(
        key.alias("id"), F.concat(F.lit("http://sl/"), number).alias("uri"), F.col("p_name").alias("title"), F.concat(F.lit("S "), number).alias("number"), F.to_date(F.lit("2001-02-03")).alias("valid_from"), F.concat(F.lit("http://act/"), F.col("p_size").cast("string")).alias("act_uri"),
        F.lit("An Act").alias("act_title"), (key % 4 != 1).alias("is_current"), F.when(key % 9 == 4, 1).otherwise(2).alias("extracted"), F.lit(False).alias("promoted"), page.alias("html"),
    )
    before = labels.scheme(parts.filter("id % 5 = 0"), "uri").select((F.col("index") + 1).cast("long").alias("id"), F.lit(1).cast("long").alias("act_id"), "uri", F.lit("old").alias("title"), F.lit("S 0").alias("number"), F.to_date(F.lit("2000-01-01")).alias("date"))
    acts = spark.createDataFrame([(1, "http://act/1", "Known")], "id long, uri string, title string")
    none = spark.createDataFrame([], "subsidiary_legislation_id long, ordinal int, kind string, citation string, content string, uri string, parent_uri string")
    done = pipelines.promote_subsidiary(parts.drop("html"), pipelines.parse_acts(parts.select("id", "html")), acts, before, none)
    rows = done["provisions"].join(done["subsidiary"].select(F.col("id").alias("subsidiary_legislation_id"), "act_id", "number"), "subsidiary_legislation_id")
    return rows.select(F.col("subsidiary_legislation_id").alias("id"), "act_id", "number", "uri", "parent_uri", "citation")


@query("""SELECT page_id, CASE page_id % 6 WHEN 0 THEN 'http://h/x/' || page_id WHEN 1 THEN 'http://h/a/c' || page_id || '?q=1' WHEN 2 THEN 'http://h/a/b/d?x=' || page_id WHEN 3 THEN 'http://h/a/b/d?k=v#f' || page_id WHEN 4 THEN 'http://o/p' || page_id ELSE 'http://h/' || page_id || '/' END AS address,
'http://h/a/b/d?k=' || page_id || '%2F%C3%A9+x&m=' AS merged FROM pages""")
def addresses(spark, sf_dir):
    """What relative references mean, and parameters merged and encoded."""
    key = F.col("page_id").cast("string")
    kinds = ["/y/.././x/", "../c", "?x=", "#f", "//o/p", "../../../"]
    reference = F.concat(F.element_at(F.array(*map(F.lit, kinds)), (F.col("page_id") % 6 + 1).cast("int")), key, F.when(F.col("page_id") % 6 == 1, "?q=1").when(F.col("page_id") % 6 == 5, "/x/..").otherwise(""))
    base = F.lit("http://h/a/b/d?k=v")
    return table(spark, sf_dir, "pages").select("page_id", urls.joined(base, reference).alias("address"), urls.with_query(base, {"m": F.lit(""), "k": F.concat(key, F.lit("/é x"))}).alias("merged"))


@query("""SELECT conv_id, role, count(*) AS turns, sum(coalesce(length(text), 0))::BIGINT AS points FROM conversations GROUP BY 1, 2""")
def two_stores(spark, sf_dir):
    """Micro-batches into two stores: turns into the first, what each batch adds to its conversations into the second. A stop between the stores is repaired."""
    folder = new_folder(spark, "stores")
    first = stores.Store(spark, f"{folder}/turns", {"turns": "conv_id long, role string, points long"})
    second = stores.Store(spark, f"{folder}/sums", {"sums": "conv_id long, role string, turns long, points long"})
    to_first = lambda batch: {"turns": batch.select(F.col("conv_id").cast("long").alias("conv_id"), "role", F.length(F.coalesce("text", F.lit(""))).cast("long").alias("points"))}
    to_second = lambda t: {"sums": t["turns"].groupBy("conv_id", "role").agg(F.count(F.lit(1)).alias("turns"), F.sum("points").alias("points"))}
    turns = table(spark, sf_dir, "conversations")
    for k in (0, 1):
        turns.filter(F.col("turn") % 2 == k).write.mode("append").parquet(f"{folder}/in")
        stores.apply_to_both(spark.readStream.schema(turns.schema).parquet(f"{folder}/in"), f"{folder}/checkpoint", first, second, to_first, to_second)
    return second.table("sums").groupBy("conv_id", "role").agg(F.sum("turns").alias("turns"), F.sum("points").alias("points"))


@query("""SELECT 'total' AS state, count(*) AS n FROM orders UNION ALL SELECT 'F', count(*) FILTER (o_orderstatus = 'F') FROM orders UNION ALL SELECT 'O', count(*) FILTER (o_orderstatus = 'O') FROM orders
UNION ALL SELECT 'other', count(*) FILTER (o_orderstatus IS NULL OR o_orderstatus NOT IN ('F', 'O')) FROM orders""")
def observed_counts(spark, sf_dir):
    """A stage's counters, taken while its table is written."""
    _, counts = observed(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), "orders", **relations.report_counts("o_orderstatus", ("F", "O")))
    return spark.createDataFrame(list(counts.items()), "state string, n long")


@query("""WITH c AS (SELECT c_custkey // 20 + 1 AS page, c_custkey % 20 AS pos, c_custkey, DATE '2024-01-01' - c_custkey::INT AS day, c_name FROM customer), s AS (SELECT min(page) AS stop FROM c WHERE day < DATE '2022-05-01')
SELECT page::BIGINT AS page, pos::INT AS pos, '[2001] SGHC ' || c_custkey AS citation, day::VARCHAR AS day, c_name AS title FROM c, s WHERE c_custkey % 9 <> 5 AND (stop IS NULL OR page <= stop)""")
def landed_walk(spark, sf_dir):
    """Landed search pages as a stream of the engine's own data source: two runs, the second of which finds the pages that came meanwhile, up to the page where the walk stops."""
    walk.register(spark)
    folder, key = new_folder(spark, "walk"), F.col("c_custkey").cast("string")
    day = F.date_sub(F.to_date(F.lit("2024-01-01")), F.col("c_custkey").cast("int")).cast("string")
    item = F.to_json(F.struct(F.when(F.col("c_custkey") % 9 == 5, F.lit(" ")).otherwise(F.concat(F.lit(" [2001]  SGHC "), key)).alias("ncitation"), F.array(F.concat(day, F.lit("T00:00"))).alias("dates"), F.array("c_name").alias("titles")))
    pages = table(spark, sf_dir, "customer").select((F.floor(F.col("c_custkey") / 20) + 1).alias("page"), (F.col("c_custkey") % 20).alias("pos"), item.alias("item"))
    pages = pages.groupBy("page").agg(F.array_sort(F.collect_list(F.struct("pos", "item"))).alias("items"))
    first = F.floor((F.col("page") - 1) / 1000) * 1000
    pages = pages.select("page", F.concat_ws("-", first + 1, first + 1000).alias("pages"), F.concat(F.lit('{"page": '), F.col("page").cast("string"), F.lit(', "data": {"results": ['), F.array_join(F.transform("items", lambda x: x["item"]), ","), F.lit("]}}")).alias("value"))
    pages = written(pages, "landed")
    for part in ("page <= 4", "page > 4"):
        pages.filter(part).drop("page").repartition("pages").write.mode("append").partitionBy("pages").text(f"{folder}/pages")
        stream = spark.readStream.format("landed_search").option("mark", "2022-05-01").load(f"{folder}/pages")
        stream.writeStream.format("parquet").option("path", f"{folder}/hits").option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(walk.SCHEMA).parquet(f"{folder}/hits").select("page", "pos", "citation", F.col("date").cast("string").alias("day"), "title")


@query("""SELECT o_custkey AS id, coalesce(arg_max(s, o_orderkey) FILTER (s IS NOT NULL), 'discovered') AS status, count(*) FILTER (review) AS reviews FROM (
SELECT *, CASE WHEN o_orderkey % 3 = 0 AND o_orderkey % 5 = 0 THEN 'fetch_failed' WHEN o_orderkey % 3 = 0 AND o_orderkey % 4 <> o_orderkey % 2 THEN 'needs_review' END AS s,
  o_orderkey % 3 = 0 AND (o_orderkey % 5 = 0 OR o_orderkey % 4 <> o_orderkey % 2) AS review FROM orders) GROUP BY 1""")
def fetched_parents(spark, sf_dir):
    """Versions and their parents' states after a round of fetches, some of which fail or find other numbers of provisions than expected."""
    orders = table(spark, sf_dir, "orders")
    versions = orders.select(F.col("o_orderkey").alias("id"), "o_custkey", F.lit("success").alias("fetch"), F.lit("old").alias("html"), F.lit("complete").alias("parse"), F.lit(1).alias("expected"), F.lit(1).alias("extracted"), F.lit(False).alias("needs_review"), F.lit(True).alias("promoted"))
    parents = orders.select(F.col("o_custkey").alias("id")).distinct().withColumn("status", F.lit("discovered"))
    key = F.col("o_orderkey")
    fetched = orders.filter(key % 3 == 0).select(key.alias("id"), key.alias("nth"), F.when(key % 5 == 0, "error").otherwise("success").alias("fetch"), F.lit("new").alias("html"), (key % 4).cast("int").alias("expected"), (key % 2).cast("int").alias("extracted"))
    kept, states = knowledge.store_fetches(versions, parents, fetched, "o_custkey")
    counts = kept.groupBy(F.col("o_custkey").alias("c_id")).agg(F.count_if("needs_review").alias("reviews"))
    return states.join(counts, F.col("id") == F.col("c_id")).select("id", "status", "reviews")


@query("""WITH u AS (SELECT user_id, list_sort(list_distinct(array_agg(event_type) FILTER (event_type IS NOT NULL))) AS topics FROM events GROUP BY 1)
SELECT user_id, CASE WHEN user_id % 2 = 0 AND user_id % 3 > 0 THEN 'Topics: ' || array_to_string(topics, '; ') || chr(10) || chr(10) ELSE 'Topics: click' || chr(10) || chr(10) END || 'Text' AS input,
'1,0,0' AS targets, (list_contains(topics, 'click') OR list_contains(topics, 'view'))::INT || ',' || list_contains(topics, 'purchase')::INT || ',0' AS mask FROM u""")
def label_features(spark, sf_dir):
    """What a trainer of concepts gets: topics given before the text, targets, and the mask of concepts that a row's own topics allow."""
    users = table(spark, sf_dir, "events").groupBy("user_id").agg(F.array_sort(F.collect_set("event_type")).alias("topics"))
    split = F.when(F.col("user_id") % 3 > 0, "train").otherwise("test")
    rows = users.withColumns({"text": F.lit("Text"), "concepts": F.array(F.lit("a"), F.lit("unknown")), "concept_topics": labels.given_topics(split, F.col("user_id"), F.col("topics"), F.array(F.lit("click")))})
    names = [r[0] for r in table(spark, sf_dir, "events").select("event_type").distinct().dropna().collect()]
    found = labels.features(rows, "concepts", [], names, {"a": ["click", "view"], "b": ["purchase"], "c": []})
    listed = lambda c: F.array_join(F.col(c).cast("array<string>"), ",")
    return found.select("user_id", "input", listed("label_targets").alias("targets"), listed("label_mask").alias("mask"))
