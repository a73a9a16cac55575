"""Scalar functions on strings, dates, numbers, arrays and JSON."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Names of courts by code.
COURTS = {
    "SGCA": "Court of Appeal", "SGCA(I)": "Court of Appeal (International)", "SGHC": "General Division of the High Court",
    "SGHC(A)": "Appellate Division of the High Court", "SGHC(I)": "Singapore International Commercial Court",
    "SGHCF": "Family Division of the High Court", "SGHCR": "High Court Registrar",
}
#: What stands behind a judge's name.
JUDGE_TITLES = ("J", "IJ", "CJ", "JCA", "JAD", "JC", "SJ", "JA")
ORDINALS = ("FIRST", "SECOND", "THIRD", "FOURTH", "FIFTH", "SIXTH", "SEVENTH", "EIGHTH", "NINTH", "TENTH", "ELEVENTH", "TWELFTH")
#: A range of pins that is wider is dropped.
WIDEST = 80


def extract(x: Column, pattern: str, group: int = 1) -> Column:
    """A group of the first match, null if there is none or it is empty."""
    return F.nullif(F.regexp_extract(x, pattern, group), F.lit(""))


def collapse(x: Column) -> Column:
    """Runs of white space become one space; blank becomes null."""
    return F.nullif(F.trim(F.regexp_replace(x, r"(?U)\s+", " ")), F.lit(""))


def paragraph_number(x: Column) -> Column:
    """The number that a paragraph begins with, with or without a full stop or a bracket behind it."""
    return extract(x, r"^\s*([0-9]+)[.)]*(?:\s|$)").try_cast("int")


def after_first(x: Column) -> Column:
    """What follows the first word."""
    return F.regexp_replace(x, r"(?U)^\s*\S+\s*", "")


def without_section_number(x: Column) -> Column:
    return F.nullif(F.trim(F.regexp_replace(x, r"^[0-9]+[A-Z]*\.\s*", "")), F.lit(""))


def without_marker(x: Column) -> Column:
    return F.nullif(F.trim(F.regexp_replace(x, r"^—?\s*\([0-9]+[A-Z]?\)\s*", "")), F.lit(""))


def section_number(x: Column) -> Column:
    return extract(x, r"^([0-9]+[A-Z]*)")


def subsection_number(x: Column) -> Column:
    return extract(x, r"^—?\s*\(([0-9]+[A-Z]?)\)")


def short_heading(x: Column) -> Column:
    """A short form of the heading of a part, division or schedule; null for others."""
    upper = F.upper(F.trim(x))
    named = F.create_map(*(F.lit(v) for i, o in enumerate(ORDINALS, 1) for v in (o, str(i))))
    word = extract(upper, r"^([A-Z]+)\s+SCHEDULE\b")
    number = F.coalesce(F.when(word.isNotNull(), F.try_element_at(named, word)), extract(upper, r"^([0-9]+)(?:ST|ND|RD|TH)\s+SCHEDULE\b"))
    part, division = extract(upper, r"^PART\s+([0-9A-Z]+)"), extract(upper, r"^DIVISION\s+([0-9A-Z]+)")
    return F.when(part.isNotNull(), F.concat(F.lit("Pt "), part)).when(division.isNotNull(), F.concat(F.lit("Div "), division)).when(number.isNotNull(), F.concat(F.lit("Sch "), number)).when(upper.rlike(r"\bSCHEDULE\b"), F.lit("Sch"))


def court_code(metadata: Column, citation: Column) -> Column:
    """From the metadata, else what stands between the year and the number of the citation."""
    return F.coalesce(F.nullif(F.trim(F.get_json_object(metadata, "$.NeutralCitation.Court")), F.lit("")), extract(citation, r"\]\s+(.+?)\s+[0-9]+\s*$"))


def court_name(code: Column) -> Column:
    names = F.create_map(*(F.lit(x) for pair in COURTS.items() for x in pair))
    return F.coalesce(F.try_element_at(names, code), code)


def judge(name: Column) -> Column:
    """name and title of a judge: the last of at least two words, if it is a title."""
    parts = F.split(F.trim(F.regexp_replace(name, r"(?U)\s+", " ")), " ")
    titled = (F.size(parts) >= 2) & F.try_element_at(parts, F.lit(-1)).isin(*JUDGE_TITLES)
    return F.struct(
        F.when(titled, F.array_join(F.slice(parts, F.lit(1), F.size(parts) - 1), " ")).otherwise(F.array_join(parts, " ")).alias("name"), F.when(titled, F.try_element_at(parts, F.lit(-1))).alias("title")
    )


def title_case(key: Column) -> Column:
    return F.initcap(F.replace(key, F.lit("_"), F.lit(" ")))


def render(citation: Column, heading: Column, content: Column) -> Column:
    """A provision as text: its citation and heading on a line, then its content."""
    return F.concat_ws("\n", F.nullif(F.concat_ws(" ", citation, heading), F.lit("")), F.nullif(content, F.lit("")))


def order_number(key: Column) -> Column:
    """The paragraph's number in a key like name#[12] or name#pr12, else 0."""
    return F.coalesce(extract(key, r"#\[([0-9]+)\]").try_cast("int"), extract(key, r"#pr([0-9]+)").try_cast("int"), F.lit(0))


def url_host(url: Column) -> Column:
    return F.regexp_extract(url, r"^[a-z]+://([^/?#]+)", 1)


def clean_url(url: Column, dropped: tuple[str, ...] = ("_", "ViewType", "WholeDoc")) -> Column:
    """The url without some parameters of its query; the others keep their order."""
    query, rest = extract(url, r"\?([^#]*)"), F.regexp_replace(url, r"\?[^#]*", "")
    kept = F.filter(F.split(query, "&"), lambda p: ~F.split(p, "=")[0].isin(*dropped))
    base, mark = F.regexp_extract(rest, r"^([^#]*)", 1), F.regexp_extract(rest, r"(#.*)$", 1)
    return F.concat(base, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""), mark)


def url_slug(url: Column) -> Column:
    """The last part of the path."""
    return extract(url, r"^[a-z]+://[^/?#]+(?:/[^?#]*)?/([^/?#]+)/?(?:[?#]|$)")


def iso_date(x: Column) -> Column:
    """The date in the first ten characters, null if it is none."""
    return F.try_to_date(F.substring(x, 1, 10), "yyyy-MM-dd")


def compact_date(x: Column, strict: bool = False) -> Column:
    """The date of eight digits, null for other texts. Eight digits that are no date give null too, or an error if strict."""
    found = F.when(x.rlike(r"^[0-9]{8}$"), F.try_to_date(x, "yyyyMMdd"))
    if not strict:
        return found
    return F.when(x.rlike(r"^[0-9]{8}$") & found.isNull(), F.raise_error(F.concat(F.lit("no such date: "), x)).cast("date")).otherwise(found)


def strings(text: Column, strict: bool = False) -> Column:
    """The texts in a list in JSON; other elements, and values that are no list, are left out, or an error if strict."""
    value = F.try_parse_json(text)
    listed = F.try_variant_get(value, "$", "array<variant>")
    plain = lambda v: F.schema_of_variant(v) == "STRING"
    found = F.transform(F.filter(listed, plain), lambda v: F.try_variant_get(v, "$", "string"))
    if strict:
        wrong = listed.isNull() | (F.size(found) < F.size(listed))
        return F.when(wrong, F.raise_error(F.concat(F.lit("no list of texts: "), F.coalesce(text, F.lit("null")))).cast("array<string>")).otherwise(found)
    return F.coalesce(found, F.array().cast("array<string>"))


def version_uri(url: Column, valid_from: Column) -> Column:
    return F.concat(F.regexp_replace(url, "/+$", ""), F.lit("/"), F.date_format(valid_from, "yyyyMMdd"))


def whole_number(x: Column) -> Column:
    """As a whole number; 0 for what is none."""
    return F.coalesce(x.try_cast("double").try_cast("int"), F.lit(0))


def pins(ranges: Column) -> Column:
    """The numbers of ranges (structs with a and b; b null for one number): swapped ends are righted, wide ones dropped."""
    ends = lambda r: (F.least(r["a"], F.coalesce(r["b"], r["a"])), F.greatest(r["a"], F.coalesce(r["b"], r["a"])))
    each = F.transform(ranges, lambda r: F.when(ends(r)[1] - ends(r)[0] <= WIDEST, F.sequence(*ends(r))))
    return F.flatten(F.filter(each, lambda x: x.isNotNull()))


def provision_list(refs: Column, prefix: Column) -> Column:
    """The references of a list, without spaces, each behind its kind."""
    parts = F.transform(F.split(refs, r"(?i)\s*(?:,|\band\b)\s*"), lambda x: F.regexp_replace(x, r"\s+", ""))
    return F.transform(F.filter(parts, lambda x: x != ""), lambda x: F.concat(prefix, F.lit(" "), x))
