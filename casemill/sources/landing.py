"""Landed payloads as tables: search pages, documents, browse pages and version timelines.

Fetching is outside of the engine: something lands JSON and HTML files, and these functions read them as Spark tables.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casemill.functions import scalars
from casemill.operators import html, snapshots

SEARCH = "page long, data struct<results: array<string>>"


def search_hits(spark: SparkSession, path: str) -> DataFrame:
    """citation, date, title, case_number, judges, hit (JSON) of landed search pages; items that aren't objects, and blank citations, are dropped."""
    items = spark.read.schema(SEARCH).json(path).select("page", F.posexplode("data.results").alias("pos", "hit"))
    field = lambda name: F.get_json_object("hit", f"$.{name}")
    citation = scalars.collapse(field("ncitation"))
    rows = items.filter(F.col("hit").startswith("{")).withColumn("citation", citation).filter("citation IS NOT NULL")
    return rows.select("page", "pos", "citation", scalars.iso_date(field("dates[0]")).alias("date"), field("titles[0]").alias("title"), field("casenumber").alias("case_number"), F.from_json(field("corams"), "array<string>").alias("judges"), "hit")


def fetch_outcome(status: Column, payload: Column) -> Column:
    """success, not_found or error of a landed response."""
    body = F.get_json_object(payload, "$.data")
    there = F.get_json_object(payload, "$.data.document").isNotNull() | F.get_json_object(payload, "$.data.documents").isNotNull()
    return F.when(status == 404, "not_found").when(status != 200, "error").when(body.isNull() | ~there, "not_found").otherwise("success")


def candidates(payloads: DataFrame, key: str, payload: str) -> DataFrame:
    """The documents in a payload: key, path (null for the main one), html, rank (0 judgment, 1 main, 2 report, 3 other), pos."""
    main = payloads.select(key, F.lit(None).cast("string").alias("path"), F.get_json_object(payload, "$.data.document").alias("html"), F.lit(1).alias("rank"), F.lit(-1).alias("pos"))
    documents = F.from_json(F.get_json_object(payload, "$.data.documents"), "map<string,string>")
    others = payloads.select(key, F.posexplode(F.map_entries(documents)).alias("pos", "e")).select(key, F.col("e.key").alias("path"), F.col("e.value").alias("html"), "pos")
    path = F.lower(F.replace("path", F.lit("\\"), F.lit("/")))
    others = others.withColumn("rank", F.when(path.contains("judgment"), 0).when(path.contains("slr"), 2).otherwise(3))
    return main.unionByName(others).filter(F.length(F.trim("html")) > 0)


def best_document(payloads: DataFrame, key: str, payload: str) -> DataFrame:
    """The html of each payload: the best parsed, then by rank; a single one is taken as it is."""
    found = candidates(payloads, key, payload)
    named = found.withColumn("cand", F.xxhash64(key, "path", "pos"))
    states = html.layouts(named, html.paragraphs(named, "cand", "html"), "cand", "html")
    numbered = F.col("layout").isin("modern_judg1", "numbered_plain_p")
    quality = F.when((F.col("parse_status") == "complete") & numbered, 3).when(numbered, 2).when(F.col("parse_status") == "complete", 1).otherwise(0)
    ranked = named.join(states.select("cand", quality.alias("quality")), "cand")
    return ranked.groupBy(key).agg(F.min_by("html", F.struct(-F.col("quality"), "rank", "pos")).alias("html"))


def browse_rows(pages: DataFrame, key: str, page: str, prefix: str = "/Act/") -> DataFrame:
    """slug, title and address of the entries of browse pages, in order, with number: the second cell of an entry's row, or empty."""
    found = link_rows(pages, key, page).filter(F.col("href").startswith(prefix) & (F.col("text") != ""))
    return found.select(key, "pos", F.regexp_extract("href", f"^{prefix}([^/?#]+)", 1).alias("slug"), F.col("text").alias("title"), "href", "number")


def until_short_page(pages: DataFrame, rows: DataFrame, key: str, size: int) -> DataFrame:
    """Rows of browse pages up to the first, by key, that lists fewer than `size` entries: what a walk over the pages would see."""
    counts = pages.select(key).join(rows.groupBy(F.col(key).alias("c_key")).agg(F.count(F.lit(1)).alias("n")), F.col(key) == F.col("c_key"), "left")
    last = counts.filter(F.coalesce("n", F.lit(0)) < size).agg(F.min(key).alias("last"))
    return rows.join(F.broadcast(last)).filter(F.col("last").isNull() | (F.col(key) <= F.col("last"))).drop("last")


def link_rows(pages: DataFrame, key: str, page: str) -> DataFrame:
    """pos, href and text of all links, and number: the text of the second cell of the table row that a link is in, or empty."""

    def links(text: str | None) -> list[tuple[int, str, str, str]]:
        numbers, out = {}, []
        for n in html.parse(text or "").walk():
            if n.tag == "tr":
                cells = [c for c in n.inside if isinstance(c, html.Node) and c.tag in ("td", "th")]
                numbers |= {id(a): cells[1].text() if len(cells) > 1 else "" for a in n.walk() if a.tag == "a"}
            elif n.tag == "a":
                out.append((len(out), n.attrs.get("href", ""), n.text(), numbers.get(id(n), "")))
        return out

    columns = [("pos", pa.int32()), ("href", pa.string()), ("text", pa.string()), ("number", pa.string())]
    return html.mapped(pages, key, page, links, columns, "pos int, href string, text string, number string")


def version_timeline(pages: DataFrame, key: str, page: str) -> DataFrame:
    """valid_from, href and is_current of each version of a timeline: links with a date for text, the last of each date.

    The current one has no date in its address; if there isn't just one such, the newest is current.
    """
    links = link_rows(pages, key, page).filter(F.col("text").rlike(r"^[0-9]{1,2} [A-Z][a-z]{2} [0-9]{4}$") & ~F.lower("href").contains("pdf") & ~F.lower("href").contains("amending"))
    stamp = F.coalesce(scalars.extract(F.col("href"), r"[?&]ValidDate=([0-9]{8})"), scalars.extract(F.col("href"), r"/Historical/([0-9]{8})"))
    dated = links.withColumn("valid_from", scalars.compact_date(stamp)).filter("valid_from IS NOT NULL")
    last = snapshots.first_of(dated, [key, "valid_from"], [F.desc("pos")]).withColumn("is_current", ~F.col("href").contains("/Historical/"))
    return snapshots.current_timeline(last, key, "valid_from", "is_current").select(key, "valid_from", "href", "is_current")


def splits(spark: SparkSession, folder: str, names: tuple[str, ...] = ("train", "validation", "test")) -> DataFrame:
    """The Parquet splits of a data set, with a column split."""
    out = None
    for name in names:
        part = spark.read.parquet(f"{folder}/{name}").withColumn("split", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out
