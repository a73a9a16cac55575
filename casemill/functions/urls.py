"""Addresses in DataFrame functions: parts, relative references, merged parameters and percent-encoding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Scheme, authority, path, query and fragment (RFC 3986, appendix B).
PARTS = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"


def part(url: Column, n: int) -> Column:
    """The n-th of PARTS; empty if it isn't there."""
    return F.regexp_extract(url, PARTS, n)


def quote(x: Column) -> Column:
    """Percent-encoding of UTF-8 bytes, as in queries: a blank is +, and letters, digits and _.-~ stay."""
    return F.replace(F.replace(F.url_encode(x), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def unquote(x: Column) -> Column:
    """The text that was encoded so; a % without two hex digits behind it stands for itself."""
    return F.url_decode(F.regexp_replace(x, "%(?![0-9A-Fa-f]{2})", "%25"))


def parameters(query: Column) -> Column:
    """k and v of each parameter of a query, decoded, in order; empty parameters are left out, missing values empty."""
    cut = lambda p: F.locate("=", p)
    name = lambda p: F.when(cut(p) > 0, F.substring(p, F.lit(1), cut(p) - 1)).otherwise(p)
    value = lambda p: F.when(cut(p) > 0, F.substring(p, cut(p) + 1, F.length(p))).otherwise("")
    return F.transform(F.filter(F.split(query, "&"), lambda p: p != ""), lambda p: F.struct(unquote(name(p)).alias("k"), unquote(value(p)).alias("v")))


def encoded(pairs: Column) -> Column:
    return F.array_join(F.transform(pairs, lambda p: F.concat(quote(p["k"]), F.lit("="), quote(p["v"]))), "&")


def built(scheme: Column, authority: Column, path: Column, query: Column, fragment: Column) -> Column:
    """An address of its parts; empty queries and fragments leave no mark behind."""
    before = lambda mark, x: F.when(x != "", F.concat(F.lit(mark), x)).otherwise("")
    rooted = F.when((authority != "") & (path != "") & ~path.startswith("/"), F.concat(F.lit("/"), path)).otherwise(path)
    return F.concat(F.when(scheme != "", F.concat(scheme, F.lit(":"))).otherwise(""), before("//", authority), rooted, before("?", query), before("#", fragment))


def with_query(url: Column, extra: dict[str, Column]) -> Column:
    """The address with more parameters. Of several of one name the last value stays, at the place of the first; all are encoded anew."""
    pairs = F.concat(parameters(part(url, 4)), F.array(*(F.struct(F.lit(k).alias("k"), v.alias("v")) for k, v in extra.items()))) if extra else parameters(part(url, 4))
    names = F.array_distinct(F.transform(pairs, lambda p: p["k"]))
    merged = F.transform(names, lambda n: F.struct(n.alias("k"), F.element_at(F.filter(pairs, lambda p: p["k"] == n), -1)["v"].alias("v")))
    return built(part(url, 1), part(url, 2), part(url, 3), encoded(merged), part(url, 5))


def without_parameters(url: Column, dropped: tuple[str, ...]) -> Column:
    """The address without some parameters; the others are encoded anew, in their order."""
    kept = F.filter(parameters(part(url, 4)), lambda p: ~p["k"].isin(*dropped))
    return built(part(url, 1), part(url, 2), part(url, 3), encoded(kept), part(url, 5))


def joined(base: Column, reference: Column) -> Column:
    """The address that a reference means within a page: whole addresses, //host, /path, path with dot segments, ?query, #fragment or nothing.

    base is a whole address. A reference with a scheme of its own counts as it is; .. above the top is dropped, and so are empty segments within a path that doesn't begin at the top.
    Nulls give null.
    """
    path, above = part(reference, 3), F.split(part(base, 3), "/", -1)
    home = F.when(F.element_at(above, -1) != "", F.slice(above, 1, F.size(above) - 1)).otherwise(above)
    given = F.split(path, "/", -1)
    both = F.concat(home, given)
    middle = F.filter(F.slice(both, 2, F.greatest(F.lit(0), F.size(both) - 2)), lambda s: s != "")
    both = F.when(F.size(both) > 1, F.concat(F.slice(both, 1, 1), middle, F.slice(both, -1, 1))).otherwise(both)
    segments = F.when(path.startswith("/"), given).otherwise(both)
    walked = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda out, s: F.when(s == "..", F.slice(out, 1, F.greatest(F.lit(0), F.size(out) - 1))).when(s == ".", out).otherwise(F.concat(out, F.array(s))),
    )
    walked = F.when(F.element_at(segments, -1).isin(".", ".."), F.concat(walked, F.array(F.lit("")))).otherwise(walked)
    resolved = F.coalesce(F.nullif(F.array_join(walked, "/"), F.lit("")), F.lit("/"))
    query = F.when((path == "") & (part(reference, 4) == ""), part(base, 4)).otherwise(part(reference, 4))
    inside = built(part(base, 1), part(base, 2), F.when(path == "", part(base, 3)).otherwise(resolved), query, part(reference, 5))
    other = built(part(base, 1), part(reference, 2), path, part(reference, 4), part(reference, 5))
    whole = F.when(reference == "", base).when(part(reference, 1) != "", reference).when(part(reference, 2) != "", other).otherwise(inside)
    return F.when(base.isNotNull() & reference.isNotNull(), whole)
