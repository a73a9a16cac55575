"""People in a judgment's metadata: judges, parties and counsel, from JSON of several shapes, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values (a mark or a blank may be left out): what marks a bracket as a firm, what says that nobody appeared, and words that aren't people.
FIRM_WORDS = ("LLP", "LLC", "Pte", "Ltd", "Partners", "Partnership", "Chambers", "Law Corporation", "Attorney[- ]?General", "Solicitor[- ]?General", "Director of", "instructed", "instructing")
FIRM_PARTS = ("&", "and Co")
ABSENT_WORDS = ("absent", "unrepresented", "in person")
POST_NOMINALS = ("SC", "QC", "PC")
STOP = ("and", "with", "instructed", "instructing", "absent", "unrepresented", "the", "for", "others", "another")
PARTY_WORDS = ("respondent", "defendant", "appellant", "plaintiff", "claimant")

ABSENT = rf"(?i)\b(?:{'|'.join(ABSENT_WORDS)})\b"
#: A bracket, without brackets in it, that names a firm.
FIRM = rf"(?i)\((?=[^()]*(?:\b(?:{'|'.join(FIRM_WORDS)})\b|{'|'.join(FIRM_PARTS)}))[^()]*\)"
#: The end of a sentence before one that tells of an appearance or an absence.
NEXT = rf"\.\s+(?=[A-Z](?:[^.]|\.(?!\s+[A-Z]))*(?:\s(?i:for)\s|\b(?i:{'|'.join(ABSENT_WORDS)})\b))"
#: Whom the first "for" stands before, at the end of a line.
SIDE = r"(?is)^(.*?)\s+for\s+(?:the\s+)?(.+?)\.?\s*$"
#: Commas, "and" and "with", but not where the next bracket closes.
JOINER = r"(?i)(?:,\s*(?:(?:and|with)\s+)?|\s+(?:and|with)\s+)(?![^()]*\))"


def _kind(value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value), F.lit("VOID"))


def _inside(value: Column, path: str) -> Column:
    return F.try_variant_get(value, path, "variant")


def _items(value: Column) -> Column:
    """The elements of an array; any other value alone."""
    return F.when(_kind(value).startswith("ARRAY"), F.try_variant_get(value, "$", "array<variant>")).otherwise(F.array(value))


def _string(value: Column) -> Column:
    """A text with its white space collapsed; null for blank ones and other values."""
    text = F.when(_kind(value) == "STRING", F.try_variant_get(value, "$", "string"))
    return F.nullif(F.trim(F.regexp_replace(text, r"(?U)\s+", " ")), F.lit(""))


def _text(value: Column) -> Column:
    """A text, or an object's content."""
    return F.when(_kind(value).startswith("OBJECT"), _string(_inside(value, "$.content"))).otherwise(_string(value))


def _texts(value: Column) -> Column:
    """A text, an object with content, or a list of these; lists in lists are left out."""
    return F.filter(F.transform(_items(value), _text), lambda x: x.isNotNull())


def _first(*values: tuple[Column, str]) -> Column:
    return F.coalesce(*(_string(_inside(F.try_parse_json(text), path)) for text, path in values))


def case_title(metadata: Column, hit: Column) -> Column:
    """The title that the metadata gives, else the first of the search hit's; null for blanks and other values."""
    return _first((metadata, "$.CaseTitle"), (hit, "$.titles[0]"))


def case_number(metadata: Column, hit: Column) -> Column:
    return _first((metadata, "$.CaseNumber"), (hit, "$.casenumber"))


def judges(metadata: Column) -> Column:
    """The judges' names as they are printed; none if the metadata has none or isn't JSON."""
    return _texts(_inside(F.try_parse_json(metadata), "$.Corams.Coram"))


def coram(metadata: Column, hit: Column) -> Column:
    """The judges' names, by the metadata or else by the search hit's list of texts."""
    listed = F.try_variant_get(F.try_parse_json(hit), "$.corams", "array<variant>")
    found = F.filter(F.transform(listed, lambda x: F.when(_kind(x) == "STRING", F.try_variant_get(x, "$", "string"))), lambda x: x.isNotNull())
    named = judges(metadata)
    return F.when(F.size(named) > 0, named).otherwise(F.coalesce(found, F.array().cast("array<string>")))


def parties(metadata: Column) -> Column:
    """name and role of each party."""

    def of(item: Column) -> Column:
        name = F.coalesce(*(F.when(_kind(v).startswith("ARRAY") & (F.size(_items(v)) > 0) | _string(v).isNotNull(), v) for v in (_inside(item, "$.Name"), _inside(item, "$.Party"))))
        role = F.get(_texts(_inside(item, "$.Role")), F.lit(0))
        named = F.transform(_texts(name), lambda n: F.struct(n.alias("name"), role.alias("role")))
        alone = F.filter(F.array(F.struct(_string(item).alias("name"), F.lit(None).cast("string").alias("role"))), lambda p: p["name"].isNotNull())
        return F.when(_kind(item).startswith("OBJECT"), named).otherwise(alone)

    return F.flatten(F.transform(_items(_inside(F.try_parse_json(metadata), "$.Parties.Party")), of))


def _names(side: Column) -> Column:
    """The people whom the part of a line before "for" names, in order."""
    clean = lambda x: F.trim(F.regexp_replace(x, r"^[\s.]+|[\s.]+$", ""))
    pieces = F.transform(F.split(F.regexp_replace(F.regexp_replace(side, r"(?i)^\s*(?:and|with)\s+", ""), FIRM, " "), JOINER), lambda p: clean(F.regexp_replace(p, r"\s+", " ")))
    # An ampersand parts full names only.
    both = lambda p: F.regexp_extract_all(p, F.lit(r"^([^&]* [^&]*) & (.* .*)$"), F.lit(1))
    parted = lambda p: F.when(F.size(both(p)) > 0, F.array(F.regexp_extract(p, r"^(.*?) & (.*)$", 1), F.regexp_extract(p, r"^(.*?) & (.*)$", 2))).otherwise(F.array(p))
    tokens = F.filter(F.flatten(F.transform(pieces, parted)), lambda p: p != "")
    joined = F.aggregate(
        tokens,
        F.array().cast("array<string>"),
        lambda out, t: F.when(F.upper(t).isin(*POST_NOMINALS) & (F.size(out) > 0), F.concat(F.slice(out, 1, F.size(out) - 1), F.array(F.concat_ws(" ", F.element_at(out, -1), F.upper(t))))).otherwise(F.concat(out, F.array(t))),
    )
    party = rf"^the .*(?:{'|'.join(PARTY_WORDS)})"
    return F.filter(joined, lambda n: (F.length(n) >= 3) & ~F.lower(n).isin(*STOP) & ~F.upper(n).isin(*POST_NOMINALS) & ~F.lower(n).rlike(party) & ~F.lower(n).rlike("absent|unrepresented"))


def counsel(metadata: Column) -> Column:
    """name of each counsel, and whom they represent.

    A line is split at sentences that tell of another appearance or an absence. A party that is absent, unrepresented or in
    person has no counsel; the others of its line keep theirs. Without a side a line names nobody.
    """
    lines = _texts(_inside(F.try_parse_json(metadata), "$.Counsels.Counsel"))
    appearances = F.filter(F.flatten(F.transform(lines, lambda x: F.split(x, NEXT))), lambda a: a.rlike(SIDE) & ~a.rlike(ABSENT))
    of = lambda a: F.transform(_names(F.regexp_extract(a, SIDE, 1)), lambda n: F.struct(n.alias("name"), F.trim(F.regexp_extract(a, SIDE, 2)).alias("represents")))
    return F.flatten(F.transform(appearances, of))
