"""Stages in their fixed order, as functions of DataFrames: each takes stored tables and gives the next snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casemill.functions import people, scalars
from casemill.operators import citations, html, knowledge, queue, snapshots
from casemill.operators.storage import spread, written

RAW_CASES = "citation string, date date, title string, hit string, status string, promoted boolean"


def discover(raw: DataFrame, hits: DataFrame) -> DataFrame:
    """New hits, from the newest stored date on, behind the stored work items; a citation counts once.

    Search pages come newest first: the page on which an older hit appears is the last one that counts.
    """
    mark = raw.agg(F.max("date").alias("mark"))
    last = hits.join(F.broadcast(mark)).filter(F.col("date") < F.col("mark")).agg(F.min("page").alias("last_page"))
    walked = hits.join(F.broadcast(last)).filter(F.col("last_page").isNull() | (F.col("page") <= F.col("last_page"))).drop("last_page")
    fresh = queue.newer(walked.join(F.broadcast(mark)), "date", F.col("mark")).drop("mark")
    new = fresh.select("citation", "date", "title", "hit", F.lit("discovered").alias("status"), F.lit(False).alias("promoted"), "page", "pos")
    new = snapshots.first_of(new, ["citation"], [F.col("page"), F.col("pos")]).drop("page", "pos")
    return snapshots.insert_absent(raw, new, ["citation"], [F.col("date")])


def parse(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """States of documents (id, layout, expected, extracted, parse_status) and their blocks (id, ordinal, text)."""
    rows = html.paragraphs(documents, "id", "html")
    states = html.layouts(documents, rows, "id", "html")
    return states, html.blocks(rows, states, "id")


def reasons(cases: DataFrame) -> DataFrame:
    """Why a case can't be promoted, null if it can: cases with id, citation, date, title, metadata, expected, blocks."""
    code = scalars.court_code(F.col("metadata"), F.col("citation"))
    reason = queue.first_failure((F.col("blocks").isNull(), "missing document"), (F.col("date").isNull(), "no decision date"), (F.col("title").isNull(), "no title"), (queue.differ(F.col("expected"), F.col("blocks")), "paragraph count differs"), (code.isNull(), "no court code"))
    return cases.withColumns({"reason": reason, "court": code})


def case_people(cases: DataFrame) -> dict[str, DataFrame]:
    """Judges, parties and counsel of cases (id, metadata, hit), as rows with the case's id and the place in its metadata.

    Of several rows of a case with one name, the first counts. Judges come from the search hit if the metadata has none. Cases
    are dealt over all tasks, and their metadata is read once: the lists are written.
    """
    listed = spread(cases.select("id", "metadata", "hit")).select("id", people.coram(F.col("metadata"), F.col("hit")).alias("judges"), people.parties(F.col("metadata")).alias("parties"), people.counsel(F.col("metadata")).alias("counsel"))
    listed = written(listed, "people")
    judge = listed.select("id", F.posexplode("judges").alias("pos", "j")).select("id", "pos", scalars.judge(F.col("j")).alias("j"))
    party = listed.select("id", F.posexplode("parties").alias("pos", "p"))
    counsel = listed.select("id", F.posexplode("counsel").alias("pos", "c"))
    first = lambda rows, *keys: snapshots.first_of(rows, ["id", *keys], [F.col("pos")])
    return {
        "judges": first(judge.select("id", "pos", "j.name", "j.title"), "name", "title"), "parties": first(party.select("id", "pos", "p.name", "p.role"), "name"),
        "counsel": first(counsel.select("id", "pos", "c.name", "c.represents"), "name"),
    }


PEOPLE = {
    "courts": "id long, code string, name string", "judges": "id long, name string, title string", "parties": "id long, name string", "counsel": "id long, name string", "case_judges": "case_id long, judge_id long",
    "case_parties": "case_id long, party_id long, role string", "case_counsel": "case_id long, counsel_id long, represents string",
}


def promote_people(cases: DataFrame, stored: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Courts, judges, parties and counsel (each new name gets the next id), and whom a case had, after promotion of cases.

    cases: id (of the knowledge base), court, metadata, hit. stored: the tables of PEOPLE. A court's name is that of its code, and
    stays as it is stored; a judge is a name and a title, parties and counsel are names. What a case has already isn't added again, so that a run after a
    stop between the stores completes it. Only ids and names are shuffled, by names and by cases.
    """
    out = {}
    codes = written(snapshots.get_or_create(stored["courts"].select("id", "code"), cases.select(F.col("court").alias("code")), "code", "id"), "courts")
    known = stored["courts"].select(F.col("id").alias("k_id"), F.col("name").alias("k_name"))
    out["courts"] = codes.join(known, F.col("id") == F.col("k_id"), "left").select("id", "code", F.coalesce("k_name", scalars.court_name(F.col("code"))).alias("name"))
    found = case_people(cases)
    for plural, single, names, own in (("judges", "judge", ["name", "title"], []), ("parties", "party", ["name"], ["role"]), ("counsel", "counsel", ["name"], ["represents"])):
        rows = written(found[plural], plural)
        out[plural] = written(snapshots.get_or_create(stored[plural].select("id", *names), rows, names, "id"), f"{plural}-keys")
        ids = out[plural].select(F.col("id").alias(f"{single}_id"), *(F.col(n).alias(f"n_{n}") for n in names))
        same = [F.col(n).eqNullSafe(F.col(f"n_{n}")) for n in names]
        had = rows.withColumnRenamed("id", "case_id").join(ids, same[0] if len(same) == 1 else same[0] & same[1]).select("case_id", f"{single}_id", *own)
        out[f"case_{plural}"] = snapshots.insert_absent(stored[f"case_{plural}"], had, ["case_id", f"{single}_id"], [F.lit(0)])
    return out


def promote_cases(raw: DataFrame, ready: DataFrame, blocks: DataFrame, stored: DataFrame, paragraphs: DataFrame) -> dict[str, DataFrame]:
    """The knowledge base's cases and paragraphs, and the raw work items, after promotion.

    ready: id, citation, date, title, court, number, uri, reason (of reasons()); only rows without a reason are promoted. blocks:
    id, ordinal, text. Cases that are stored already are only marked, which also repairs a run that ended between both
    stores; the others get the next ids, and their paragraphs with uris. stored: id, citation, date, title, court, number,
    uri. paragraphs: case_id, ordinal, text, uri. raw has citation and promoted.
    """
    good = written(snapshots.first_of(ready.filter("reason IS NULL"), ["citation"], [F.col("id")]), "ready")
    keys = written(snapshots.get_or_create(stored.select("id", "citation"), good, "citation", "id"), "keys")
    new = snapshots.absent(keys, stored, ["citation"]).withColumnRenamed("id", "case_id")
    rest = good.withColumnRenamed("id", "raw_id").join(new, "citation")
    cases = stored.unionByName(rest.select(F.col("case_id").alias("id"), *(c for c in stored.columns if c != "id")))
    texts = blocks.withColumnRenamed("id", "raw_id").join(rest.select("raw_id", "case_id", "uri"), "raw_id")
    added = knowledge.paragraph_uris(texts.select("case_id", "ordinal", "text"), rest.select("case_id", "uri"), "case_id", "uri")
    return {"cases": cases, "paragraphs": paragraphs.unionByName(added), "raw": snapshots.mark(raw, good, ["citation"], "promoted")}


def discover_acts(acts: DataFrame, versions: DataFrame, browsed: DataFrame, timelines: DataFrame) -> dict[str, DataFrame]:
    """Acts and their versions after a walk over browse pages and timelines: titles are renewed, stored versions stay as they are.

    acts: slug, title. versions: slug, valid_from, href, is_current, fetch, parse, promoted. browsed: slug, title, pos.
    timelines: slug, valid_from, href, is_current. Which version is current follows the newest timeline of each act.
    """
    seen = snapshots.first_of(browsed, ["slug"], [F.col("pos")]).select("slug", "title")
    fresh = timelines.withColumns({"fetch": F.lit(None).cast("string"), "parse": F.lit("not_parsed"), "promoted": F.lit(False)}).select(*versions.columns)
    known = snapshots.insert_absent(versions, fresh, ["slug", "valid_from"], [F.col("href")])
    now = timelines.select(F.col("slug").alias("n_slug"), F.col("valid_from").alias("n_from"), F.col("is_current").alias("n_current"))
    met = known.join(timelines.select(F.col("slug").alias("m_slug")).distinct(), F.col("slug") == F.col("m_slug"), "left").join(now, (F.col("slug") == F.col("n_slug")) & (F.col("valid_from") == F.col("n_from")), "left")
    current = F.when(F.col("m_slug").isNull(), F.col("is_current")).otherwise(F.coalesce("n_current", F.lit(False)))
    return {"acts": snapshots.upsert(acts, seen, ["slug"]), "versions": met.withColumn("is_current", current).select(*versions.columns)}


def parse_acts(documents: DataFrame) -> dict[str, DataFrame]:
    """Trees, definitions and states of landed statutes: documents has id and html."""
    rows = written(html.statutes(documents, "id", "html"), "statutes")
    return {"tree": html.provisions_of(rows, "id"), "definitions": html.definitions_of(rows, "id"), "states": html.states_of(rows, "id")}


def promote_acts(versions: DataFrame, parsed: dict[str, DataFrame], provisions: DataFrame, definitions: DataFrame) -> dict[str, DataFrame]:
    """Provisions and definitions of completely parsed versions, with uris; each replaces what its version, or act, had before.

    versions: id, slug, uri, is_current, promoted. provisions: version_id and the columns of a tree, uri, parent_uri. definitions: slug, term,
    definition, of current versions only. A version that isn't complete keeps what it had.
    """
    whole = parsed["states"].filter("parse_status = 'complete'").select("id")
    due = versions.join(whole, "id", "left_semi")
    trees = parsed["tree"].join(due.select("id", F.col("uri").alias("version_uri")), "id")
    new = knowledge.provision_uris(trees, "id", F.col("version_uri")).withColumnRenamed("id", "version_id").select(*provisions.columns)
    terms = parsed["definitions"].join(due.filter("is_current").select("id", "slug"), "id").select("slug", "term", "definition")
    return {
        "provisions": snapshots.replace_group(provisions, new, ["version_id"]), "definitions": snapshots.replace_group(definitions, terms, ["slug"]),
        "versions": snapshots.mark(versions, due, ["id"], "promoted"),
    }


def promote_subsidiary(versions: DataFrame, parsed: dict[str, DataFrame], acts: DataFrame, stored: DataFrame, provisions: DataFrame) -> dict[str, DataFrame]:
    """Subsidiary legislation after promotion: acts, instruments, their provisions, and the versions with their flags.

    versions: id, uri, title, number, valid_from, act_uri, act_title, is_current, extracted, promoted. parsed: of parse_acts. acts: id, uri, title. stored: id, act_id,
    uri, title, number, date. provisions: subsidiary_legislation_id, ordinal, kind, citation, content, uri, parent_uri.

    Current versions that aren't promoted are due, if their trees are complete and have as many provisions as were stored; an instrument whose uri
    is stored is only marked. Others get the next ids; an act that isn't there yet is made with its title. Of several
    due versions of an instrument the newest counts, and all are marked.
    """
    states = parsed["states"].select(F.col("id").alias("s_id"), "parse_status", F.col("extracted").alias("s_extracted"))
    open_ = versions.filter("is_current AND NOT promoted").join(states, F.col("id") == F.col("s_id"))
    there = written(snapshots.present(open_, stored, ["uri"]).select("uri"), "instruments")
    whole = open_.filter((F.col("parse_status") == "complete") & ~queue.differ(F.col("extracted"), F.col("s_extracted")))
    good = written(snapshots.first_of(snapshots.absent(whole, stored, ["uri"]), ["uri"], [F.desc("valid_from"), F.col("id")]), "due")
    act_keys = written(snapshots.get_or_create(acts.select("id", "uri"), good.select(F.col("act_uri").alias("uri")), "uri", "id"), "acts")
    titles = good.groupBy(F.col("act_uri").alias("t_uri")).agg(F.min("act_title").alias("t_title"))
    made = snapshots.absent(act_keys, acts, ["uri"]).join(titles, F.col("uri") == F.col("t_uri")).select("id", "uri", F.col("t_title").alias("title"))
    keys = written(snapshots.get_or_create(stored.select("id", "uri"), good, "uri", "id"), "keys").select(F.col("id").alias("own_id"), F.col("uri").alias("own_uri"))
    of_act = act_keys.select(F.col("id").alias("act_id"), F.col("uri").alias("a_uri"))
    new = good.join(keys, F.col("uri") == F.col("own_uri")).join(of_act, F.col("act_uri") == F.col("a_uri"))
    trees = parsed["tree"].join(new.select("id", F.col("own_id").alias("subsidiary_legislation_id"), F.col("uri").alias("document_uri")), "id")
    rows = knowledge.provision_uris(trees, "subsidiary_legislation_id", F.col("document_uri")).select(*provisions.columns)
    return {
        "acts": acts.unionByName(made), "subsidiary": stored.unionByName(new.select(F.col("own_id").alias("id"), "act_id", "uri", "title", "number", F.col("valid_from").alias("date"))),
        "provisions": snapshots.insert_absent(provisions, rows, ["subsidiary_legislation_id", "ordinal"], [F.lit(0)]), "versions": snapshots.mark(versions, good.select("uri").unionByName(there).join(versions.filter("is_current").select("uri", "id"), "uri"), ["id"], "promoted"),
    }


def update_acts(tables: dict[str, DataFrame], browsed: DataFrame, timelines: DataFrame, documents: DataFrame, instruments: DataFrame) -> dict[str, DataFrame]:
    """The acts' stages in their fixed order: discover, parse, promote versions, promote subsidiary legislation; each stage's tables are written.

    tables: acts (slug, title), versions (of discover_acts), provisions (version_id, ordinal, kind, citation, content, uri, parent_uri), definitions (slug, term, definition), knowledge_acts (id, uri, title),
    subsidiary, subsidiary_provisions. documents: id, slug, valid_from, uri, html, fetched versions of acts. instruments: id, html and the columns of promote_subsidiary's versions. Running all again adds nothing.
    """
    found = {n: written(t, n) for n, t in discover_acts(tables["acts"], tables["versions"], browsed, timelines).items()}
    parsed = parse_acts(documents.select("id", "html"))
    current = found["versions"].select("slug", "valid_from", "is_current", "promoted")
    named = documents.drop("html").join(current, ["slug", "valid_from"])
    done = {n: written(t, n) for n, t in promote_acts(named, parsed, tables["provisions"], tables["definitions"]).items()}
    marked = done["versions"].filter("promoted").select("slug", "valid_from")
    states = documents.select("id", "slug", "valid_from").join(parsed["states"].select("id", "parse_status"), "id").select(F.col("slug").alias("p_slug"), F.col("valid_from").alias("p_from"), "parse_status")
    versions = snapshots.mark(found["versions"], marked, ["slug", "valid_from"], "promoted").join(states, (F.col("slug") == F.col("p_slug")) & (F.col("valid_from") == F.col("p_from")), "left")
    versions = versions.withColumn("parse", F.coalesce("parse_status", "parse")).select(*found["versions"].columns)
    subsidiary = promote_subsidiary(instruments.drop("html"), parse_acts(instruments.select("id", "html")), tables["knowledge_acts"], tables["subsidiary"], tables["subsidiary_provisions"])
    subsidiary = {n: written(t, n) for n, t in subsidiary.items()}
    return {
        "acts": found["acts"], "versions": written(versions, "versions"), "provisions": done["provisions"], "definitions": done["definitions"], "knowledge_acts": subsidiary["acts"], "subsidiary": subsidiary["subsidiary"],
        "subsidiary_provisions": subsidiary["provisions"], "instruments": subsidiary["versions"],
    }


def later(stored: DataFrame, cases: DataFrame, paragraphs: DataFrame, aliases: DataFrame) -> DataFrame:
    """Stored references, those without a target looked up among cases that are new: a reference may be older than its case."""
    open_ = (F.col("kind") == "case") & F.col("target_case").isNull() & F.col("target_paragraph").isNull()
    again = citations.resolve(stored.filter(open_).drop("target_case", "target_paragraph"), cases, paragraphs, aliases)
    return stored.filter(~open_).unionByName(again)


def references(paragraphs: DataFrame, cases: DataFrame, extracted: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Aliases and resolved references of cases not yet extracted, and the cases done, so that a second run finds none."""
    pending = snapshots.absent(paragraphs, extracted, ["case_id"])
    known = written(citations.extract_aliases(pending), "aliases")
    found = citations.resolve(citations.extract_spans(pending, known), cases, paragraphs, known)
    return known, found, extracted.unionByName(pending.select("case_id").distinct())


def update_cases(tables: dict[str, DataFrame], hits: DataFrame, documents: DataFrame) -> dict[str, DataFrame]:
    """The case stages in their fixed order, each on the tables that the one before left: discover, parse, promote, refer.

    tables: raw, cases, paragraphs, extracted, aliases, references, and those of PEOPLE (empty if they aren't given). A date that the hit lacks is the metadata's; references whose
    case comes later are resolved then, and those of a case that is read again take the place of the earlier ones. documents: id, citation, html, metadata, uri. Each stage's tables are written, so
    a stage that fails can be run again by itself. Running all again adds nothing.
    """
    raw = written(discover(tables["raw"], hits), "raw")
    states, blocks = parse(documents)
    states, blocks = written(states, "states"), written(blocks, "blocks")
    counted = blocks.groupBy("id").agg(F.count(F.lit(1)).alias("blocks"))
    complete = documents.join(states.filter("parse_status = 'complete'").select("id", "extracted"), "id").join(raw.select("citation", "date", "hit", "promoted"), "citation").filter("NOT promoted")
    decided = F.coalesce("date", scalars.iso_date(F.get_json_object("metadata", "$.DecisionDate")))
    titled = complete.withColumns({"title": people.case_title(F.col("metadata"), F.col("hit")), "number": people.case_number(F.col("metadata"), F.col("hit")), "date": decided})
    judged = reasons(titled.join(counted, "id", "left").withColumn("expected", F.col("extracted")))
    promoted = promote_cases(raw, judged, blocks, tables["cases"], tables["paragraphs"])
    promoted = {name: written(t, name) for name, t in promoted.items()}
    keyed = promoted["paragraphs"].select("case_id", F.xxhash64("uri").alias("id"), "ordinal", F.col("text").alias("content"))
    cited = promoted["cases"].select(F.col("id").alias("case_id"), F.col("citation").alias("neutral_citation"))
    aliases, found, extracted = references(keyed, cited, tables["extracted"])
    fresh = snapshots.absent(cited, tables["cases"].select(F.col("id").alias("case_id")), ["case_id"])
    all_aliases = written(snapshots.replace_group(tables["aliases"], aliases, ["case_id"]), "aliases")
    known = later(tables["references"], fresh, snapshots.present(keyed, fresh, ["case_id"]), all_aliases)
    parts = {name: tables.get(name, raw.sparkSession.createDataFrame([], schema)) for name, schema in PEOPLE.items()}
    homes = promoted["cases"].select(F.col("id").alias("case_id"), "citation", "court")
    peopled = written(judged.filter("reason IS NULL").select("citation", "metadata", "hit").join(homes, "citation").select(F.col("case_id").alias("id"), "court", "metadata", "hit"), "peopled")
    people_of = {name: written(t, name) for name, t in promote_people(peopled, parts).items()}
    return promoted | people_of | {"aliases": all_aliases, "references": written(snapshots.replace_group(known, found, ["case_id"]), "references"), "extracted": written(extracted, "extracted")}
