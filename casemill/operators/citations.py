"""Aliases, citations and references of legal paragraphs, and what they resolve to.

A paragraph's spans are found in it alone, by one small function for each row. What depends on earlier paragraphs (which case,
act or rules a bare reference means) is a running value over a case's spans, and resolving is a matter of joins.
"""

from __future__ import annotations

import re
import string
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate, chain, groupby, pairwise
from typing import NamedTuple

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casemill.operators.storage import spread

#: The grammar of citations.
YEAR = r"\[[12]\d{3}\]"
NEUTRAL = YEAR + r"\s+SG(?:HC(?:[RF]|\([A-Z]+\))?|CA(?:\([A-Z]+\))?|DC|FC)\s+\d+"
SLR = YEAR + r"\s+\d+\s+SLR(?:\(R\))?\s+\d+"
REPORTER = YEAR + r"\s+\d+\s+[A-Z][A-Za-z.]+\s+\d+"
PIN = r"\[[0-9]+\](?:\s*[-–—]\s*\[[0-9]+\])?"
PINS = rf"{PIN}(?:\s+and\s+{PIN})*"
QUOTED = r"[\"“]\s*([^\"”]+?)\s*[\"”]"
ALIAS = rf"\((?:the\s+)?{QUOTED}(?:\s+or\s+(?:the\s+)?{QUOTED})?\)"
CAPITAL = r"[A-Z][\w'’\-,]"
JOINED = rf"(?:\s+{CAPITAL}+|\s+and|\s+of|\s+the|\s+for|\s+\([^)]+\))*"
INSTRUMENT = rf"{CAPITAL}*{JOINED}\s+(?:Act|Rules|Regulations|Code|Order)(?:\s+\d{{4}})?"
EDITION = r"\((Cap\.?\s+[^)]+|[^)]*Rev Ed)\)"
REF = r"[0-9]+[A-Z]?(?:\(\s*[a-z0-9]+\s*\))*"
TITLE_DELIMITER = r"(?i:see(?:,\s*e\.?g\.?,?)?)\s+|(?i:in the decision of(?: the [^.]+)? in)\s+|(?i:in)\s+(?=[A-Z])"
BOOK = r"([A-Z][^()]{8,120}?)\s+\(([^)]*\d+(?:st|nd|rd|th)\s+Ed\.?[^)]*\d{4})\)(?:\s+at\s+pp?\s+\d+(?:\s*[–\-—]\s*\d+)?)?"
RE_CASE = r"\bRe\s+[A-Z][A-Za-z0-9'’\-]+(?:\s+[A-Z][A-Za-z0-9'’\-]+){0,6}"
#: How far before a citation its title may begin, how many words an expansion has, and how much of the text stands for an alias without one.
TITLE_REACH, PHRASE_WORDS, TEXT_REACH = 220, 13, 80
#: A range of pins that is wider is dropped.
WIDEST = 80
#: Order of families: it decides between spans with one start and length.
FAMILIES = ("case", "provision", "self", "book", "re", "alias")

TEXTS = ("family", "kind", "quoted", "name", "neutral", "slr", "edition", "alias")
SPAN_SCHEMA = "case_id long, paragraph_id long, ordinal int, start int, end int, family string, kind string, quoted string, name string, neutral string, slr string, edition string, alias string, provisions array<string>, pins array<int>"


_NEUTRAL, _SLR, _ALIAS, _CITATIONS = re.compile(NEUTRAL), re.compile(SLR), re.compile(ALIAS), tuple(re.compile(p) for p in (NEUTRAL, SLR, REPORTER))
_PIN_RANGE, _JOINTS = re.compile(r"\[(\d+)\](?:\s*[-–—]\s*\[(\d+)\])?"), re.compile(r"\s*(?:,|and)\s*")
_KINDS = (("rules", re.compile(r"\bRules\b|\bR\d+\b")), ("act", re.compile(r"\bAct\b|Rev Ed|\bCap\b")), ("case", re.compile(r"\[[12]\d{3}\]|\sv\s|^Re\s")))
_DELIMITER, _TITLE = re.compile(TITLE_DELIMITER), re.compile(r"(?:Re\s+)?[A-Z]")
#: A run of words that an instrument's name may have, however it ends; runs are found in one pass.
_RUN, _INSTRUMENT_END = re.compile(rf"{CAPITAL}*{JOINED}"), re.compile(rf"({INSTRUMENT})(?:\s+{EDITION})?\s*")
_RUN_REST = re.compile(rf"(?:\s+\d{{4}})?(?:\s+{EDITION})?\s*")
_PHRASE, _CAPITAL, _DIGIT = string.ascii_letters + string.digits + "'’-", re.compile("[A-Z]"), re.compile("[0-9]")
_AFTER_CASE = re.compile(rf"(\s*{ALIAS})?(?:\s+at\s+({PINS}))?", re.IGNORECASE)
_PROVISION = re.compile(rf"\b(ss?|sections?|rules?|rr?)\s+({REF}(?:\s*(?:,|and)\s*{REF})*)", re.IGNORECASE)
_OF_INSTRUMENT, _THEN_ALIAS, _OF = re.compile(rf"\s+of\s+(?:the\s+)?({INSTRUMENT})(?:\s+{EDITION})?\s*"), re.compile(ALIAS), re.compile(r"\s+of\s+(?:the\s+)?")
_ABOVE, _DESCRIBED = (re.compile(p, re.IGNORECASE) for p in (rf"\babove\s+\(?at\s+({PINS})\)?", rf"\b(?:described|set out|outlined|mentioned)\s+at\s+({PINS})"))
_BOOK, _RE, _AT_PINS, _BARE = re.compile(BOOK), re.compile(RE_CASE), re.compile(rf"\s+at\s+({PINS})", re.IGNORECASE), re.compile(rf"(?:\(at\s+|\bat\s+)({PINS})\)?", re.IGNORECASE)


def expand_pins(text: str | None) -> list[int]:
    """The numbers in a cluster of pins; swapped ends are righted, and wide ranges dropped."""
    out: list[int] = []
    for a, b in _PIN_RANGE.findall(text or ""):
        low, high = sorted((int(a), int(b or a)))
        if high - low <= WIDEST:
            out += range(low, high + 1)
    return out


def alias_kind(expanded: str) -> str:
    """What a short name stands for, by its expansion; the first that fits."""
    return next((kind for kind, pattern in _KINDS if pattern.search(expanded)), "fact")


def short_names(found: re.Match) -> list[str]:
    """The names in a definition, white space collapsed; blank ones are none."""
    return [n for n in (" ".join(x.split()) for x in found.groups() if x) if n]


def cited(text: str) -> list[tuple[int, int]]:
    """Where citations begin and end, in order of their ends."""
    return sorted({m.span() for p in _CITATIONS for m in p.finditer(text)}, key=lambda s: s[::-1]) if "[" in text else []


def _opened(text: str) -> int:
    """Behind the last bracket that isn't closed, else 0."""
    depth = 0
    for k in range(len(text) - 1, -1, -1):
        depth += text[k] == ")"
        if text[k] == "(":
            if not depth:
                return k + 1
            depth -= 1
    return 0


def _trimmed(text: str, begin: int, end: int, chars: str | None = None) -> tuple[int, int]:
    """The place without these characters (white space) at its ends."""
    piece = text[begin:end]
    begin += len(piece) - len(piece.lstrip(chars))
    return begin, begin + len(piece.strip(chars))


def _title_place(text: str, at: int) -> tuple[int, int]:
    begin = max(0, at - TITLE_REACH)
    if earlier := cited(text[begin:at]):
        begin += earlier[-1][1]
    begin += _opened(text[begin:at])
    piece = text[begin:at]
    cut = max((m.end() for m in _DELIMITER.finditer(piece)), default=0)
    found = _TITLE.search(piece[cut:])
    return _trimmed(text, begin + cut + (found.start() if found else 0), at, " ,;(")


def title_before(text: str, at: int) -> str:
    """The title that leads up to a citation: behind earlier citations, then open brackets, then words like "see" and "in"."""
    begin, end = _title_place(text, at)
    return text[begin:end]


class _Ends:
    """What a text could end with at each place: found once for a text, however many aliases it defines."""

    def __init__(self, text: str):
        self.text, self.cites = text, cited(text)
        self.ends = [end for _, end in self.cites]
        self.runs = [m.span() for m in _RUN.finditer(text)] if _ALIAS.search(text) else []
        self.begins = [begin for begin, _ in self.runs]

    def instrument(self, before: str) -> re.Match | None:
        """The longest name of an instrument that the text before an alias ends with. Its words are one run of `runs`."""
        best, closed = None, before.rfind(")", 0, max(0, len(before) - 1))
        for k in range(bisect_right(self.begins, len(before)) - 1, -1, -1):
            begin, end = self.runs[k]
            if end < closed:  # an edition has no closed bracket within
                break
            run = _RUN.match(before, begin)
            if run and (run.end() == len(before) or _RUN_REST.fullmatch(before, run.end())):
                best = _INSTRUMENT_END.fullmatch(before, begin) or best
        return best

    def phrase(self, before: str) -> tuple[int, int] | None:
        """The last words, at most PHRASE_WORDS, from a capital letter on."""
        before = before.rstrip(" ,;")
        begin = len(before)
        for word in reversed(before.rsplit(None, PHRASE_WORDS)[-PHRASE_WORDS:]):
            size = len(word) - len(word.rstrip(_PHRASE))
            if size:
                begin = before.rfind(word, 0, begin) + len(word) - size
            if size < len(word):
                break
        found = _CAPITAL.search(before, begin)
        return _trimmed(before, found.start(), len(before)) if found else None

    def expansion(self, at: int) -> tuple[str, list[tuple[int, int]]]:
        """What an alias that is defined there stands for: a form, and the places that it joins."""
        before = self.text[:at].rstrip()
        k = bisect_right(self.ends, len(before)) - 1
        if k >= 0 and self.ends[k] >= len(before) - 1:
            begin, end = self.cites[k]
            title = _title_place(before, begin)
            title = title[0] + len(piece := before[slice(*title)]) - len(piece.lstrip()), title[1]
            return ("{} {}", [title, (begin, end)]) if title[0] < title[1] else ("{}", [(begin, end)])
        if found := self.instrument(before):
            name = _trimmed(before, *found.span(1))
            return ("{}", [name]) if found[2] is None else ("{} ({})", [name, found.span(2)])
        for place in (self.phrase(before), _trimmed(before, max(0, len(before) - TEXT_REACH), len(before), " ,;(")):
            if place and place[0] < place[1]:
                return "{}", [place]
        return "{}", [(0, len(before))]


def _short_places(found: re.Match) -> list[tuple[int, int]]:
    """Where the names of short_names() are."""
    return [found.span(k + 1) for k, x in enumerate(found.groups()) if x and x.strip()]


def _short(text: str, place: tuple[int, int]) -> str:
    return " ".join(text[slice(*place)].split())


def _definition_places(text: str) -> list[tuple[tuple[int, int], str, list[tuple[int, int]], str, int]]:
    """Of each definition the places of its name, the form and places of its expansion, its kind, and its own place."""
    out, ends = [], _Ends(text)
    for m in _ALIAS.finditer(text):
        form, places = ends.expansion(m.start())
        kind = alias_kind(_said(text, form, places))
        out += [(n, form, places, kind, m.start()) for n in _short_places(m)]
    return out


def _said(text: str, form: str, places: list[tuple[int, int]]) -> str:
    return form.format(*(text[a:b] for a, b in places))


def alias_definitions(text: str) -> list[tuple[str, str, str, int]]:
    """(short name, expansion, kind, place) of each definition like (the "X" or the "Y")."""
    return [(_short(text, n), _said(text, form, places), kind, at) for n, form, places, kind, at in _definition_places(text)]


class Found(NamedTuple):
    """A reference by the places of its parts, so that texts which differ in digits only share it. short: the name in the case's aliases that it uses."""

    start: int
    end: int
    family: str
    kind: str
    name: tuple[int, int] | None = None
    neutral: tuple[int, int] | None = None
    slr: tuple[int, int] | None = None
    edition: tuple[int, int] | None = None
    alias: tuple[int, int] | None = None
    short: str | None = None
    provisions: tuple[str, list[tuple[int, int]]] = ("", [])
    pins: tuple[int, int] | None = None


def _group(found: re.Match | None, k: int) -> tuple[int, int] | None:
    return found.span(k) if found and found[k] is not None else None


def _case_spans(text: str) -> Iterator[Found]:
    for start, end in sorted(cited(text)):
        title = _title_place(text, start)
        tail = _AFTER_CASE.match(text, end)
        named = _ALIAS.search(text, *tail.span(1)) if tail[1] else None
        citation, place = text[start:end], (start, end)
        yield Found(
            title[0] if title[0] < title[1] else start, tail.end(), "case", "case", name=title if title[0] < title[1] else None, neutral=place if _NEUTRAL.fullmatch(citation) else None,
            slr=place if _SLR.fullmatch(citation) else None, alias=next(iter(_short_places(named)), None) if named else None, pins=_group(tail, 4),
        )


def _word_at(text: str, at: int) -> bool:
    """Whether a word character stands there."""
    return 0 <= at < len(text) and (text[at].isalnum() or text[at] == "_")


class Aliases:
    """The short names of a case, in one automaton: a paragraph is read once, however many names there are."""

    def __init__(self, known: dict[str, tuple[str, str]]):
        self.known = {short: what for short, what in known.items() if short}
        self.longest = sorted((short for short, (_, kind) in self.known.items() if kind in ("act", "rules")), key=len, reverse=True)
        self.automaton = ahocorasick.Automaton()
        for short, (_, kind) in self.known.items():
            if kind != "fact":
                self.automaton.add_word(short, (short, {"rules": "rule", "act": "act"}.get(kind, "case")))
        self.automaton.make_automaton()

    def mentions(self, text: str) -> Iterator[tuple[int, int, tuple]]:
        """Begin, end and name of each occurrence as a word of its own; those of one name don't overlap."""
        if not len(self.automaton):
            return
        ended: dict[str, int] = {}
        for last, what in self.automaton.iter(text):
            end = last + 1
            at = end - len(what[0])
            if at >= ended.get(what[0], 0) and not _word_at(text, end) and not _word_at(text, at - 1):
                ended[what[0]] = end
                yield at, end, what


def _provision_spans(text: str, aliases: Aliases) -> Iterator[Found]:
    for m in _PROVISION.finditer(text):
        rule = m[1][0] in "rR"
        begin, end = m.span(2)
        joints = [(begin, begin), *(j.span() for j in _JOINTS.finditer(text, begin, end)), (end, end)]
        refs = [(a, b) for (_, a), (b, _) in pairwise(joints) if text[a:b].strip()]
        out = Found(m.start(), m.end(), "provision", "rule" if rule else "provision", provisions=("r " if rule else "s ", refs))
        if found := _OF_INSTRUMENT.match(text, m.end()):
            place = _trimmed(text, *found.span(1))
            then = _THEN_ALIAS.match(text, found.end())
            alias = next(iter(_short_places(then)), None) if then else None
            name = text[slice(*place)]
            out = out._replace(end=then.end() if then else found.end(), name=place, edition=_group(found, 2), alias=alias, short=name if alias is None and name in aliases.known else None)
        elif found := _OF.match(text, m.end()):
            for short in aliases.longest:
                if text.startswith(short, found.end()) and not _word_at(text, found.end() + len(short)):
                    out = out._replace(end=found.end() + len(short), short=short)
                    break
        yield out


def _alias_spans(text: str, aliases: Aliases) -> Iterator[Found]:
    """Mentions of short names outside of their definitions, each with the pins behind it."""
    defined = [m.span() for m in _ALIAS.finditer(text)]
    begins = [a for a, _ in defined]
    for at, end, (short, kind) in aliases.mentions(text):
        k = bisect_right(begins, end - 1) - 1
        if k >= 0 and at < defined[k][1]:
            continue
        pins = _AT_PINS.match(text, end)
        yield Found(at, pins.end() if pins else end, "alias", kind, short=short, pins=_group(pins, 1))


def find_places(text: str, known: Aliases) -> list[Found]:
    """A paragraph's references in order, none overlapping another; bare pins only where nothing else is.

    Earlier spans win, then longer ones, then by FAMILIES.
    """
    found = [*_case_spans(text), *_provision_spans(text, known), *_alias_spans(text, known)]
    pinned = "[" in text
    for pattern in (_ABOVE, _DESCRIBED):
        for m in pattern.finditer(text) if pinned else ():
            found.append(Found(m.start(), m.end(), "self", "self", pins=_group(m, 1)))
    for m in _BOOK.finditer(text) if " Ed" in text else ():
        found.append(Found(m.start(), m.end(), "book", "book", name=_trimmed(text, *m.span(1))))
    for m in _RE.finditer(text) if "Re" in text else ():
        pins = _AT_PINS.match(text, m.end())
        found.append(Found(m.start(), pins.end() if pins else m.end(), "re", "case", name=m.span(), pins=_group(pins, 1)))
    found.sort(key=lambda s: (s.start, s.start - s.end, FAMILIES.index(s.family)))
    kept: list[Found] = []
    for s in found:
        if not kept or s.start >= kept[-1].end:
            kept.append(s)
    # Pins come in order too, so the reference in their way is the next one that ends behind their beginning.
    pins, k = [], 0
    for m in _BARE.finditer(text) if pinned else ():
        while k < len(kept) and kept[k].end <= m.start():
            k += 1
        if k == len(kept) or kept[k].start >= m.end():
            pins.append(Found(m.start(), m.end(), "pin", "self", pins=_group(m, 1)))
    return sorted(kept + pins, key=lambda s: s.start)


def _part(text: str, place: tuple[int, int] | None) -> str | None:
    return None if place is None else text[place[0] : place[1]]


def _read(text: str, places: list[Found], cites: Cites) -> list[dict]:
    """The references at these places of a text, with their strings. Of a mention of a short name, the citations are those of its expansion."""
    out = []
    for s in places:
        neutral, slr = cites(s.short) if s.family == "alias" else (_part(text, s.neutral), _part(text, s.slr))
        prefix, refs = s.provisions
        out.append({
            "start": s.start, "end": s.end, "family": s.family, "kind": s.kind, "quoted": text[s.start : s.end].strip(), "name": _part(text, s.name), "neutral": neutral, "slr": slr, "edition": _part(text, s.edition),
            "alias": s.short if s.alias is None else _short(text, s.alias), "provisions": [prefix + "".join(text[a:b].split()) for a, b in refs], "pins": expand_pins(text[s.pins[0] : s.pins[1]]) if s.pins else [],
        })
    return out


class Cites(dict):
    """By short name, the neutral and the SLR citation in what it stands for."""

    def __init__(self, known: dict[str, tuple[str, str]]):
        self.known = known

    def __missing__(self, short: str) -> tuple[str | None, str | None]:
        expanded = self.known[short][0]
        self[short] = found = tuple(m and m[0] for m in (_NEUTRAL.search(expanded), _SLR.search(expanded)))
        return found

    __call__ = dict.__getitem__


def find_spans(text: str, aliases: Aliases | dict[str, tuple[str, str]]) -> list[dict]:
    """The references of find_places(). aliases: expansion and kind by short name. name is a title as the text has it; what a short name stands for is left to the alias."""
    known = aliases if isinstance(aliases, Aliases) else Aliases(aliases)
    return _read(text, find_places(text, known), Cites(known.known))


class Shapes:
    """Finds what is in paragraphs, and keeps it for texts of the same shape: those that differ in digits only, behind "[" not in whether it is 1 or 2.

    The grammar tells no more of digits than that, so that places within texts of one shape are the same; strings and numbers are
    read from each text. Short names are compared as they are, so that cases whose names have digits are read without. What is
    kept is dropped when it comes to KEPT bytes. Texts that have shapes of their own cost as much as without it, and the key.
    """

    KEPT = 16 << 20
    # No text in UTF-8 has the byte that stands for 1 or 2 behind "[" until all other digits are gone.
    YEARS, DIGITS = re.compile(rb"\[[12]"), bytes.maketrans(b"123456789\xff", b"0000000001")

    def __init__(self):
        self.size, self.pins = 0, Pins()
        self.definitions: dict[bytes, list] = {}
        self.names: dict[tuple, tuple[Aliases, dict[bytes, Reader]]] = {}

    def _room(self, size: int) -> None:
        self.size += size
        if self.size > self.KEPT:
            self.size = size
            self.definitions.clear()
            self.names.clear()

    def key(self, text: str) -> bytes:
        return self.YEARS.sub(b"[\xff", text.encode("utf-8", "surrogatepass")).translate(self.DIGITS)

    def defined(self, text: str, key: bytes) -> list[tuple[str, str, str, int]]:
        """As alias_definitions()."""
        found = self.definitions.get(key)
        if found is None:
            self._room(4 * len(key) + 200)
            found = self.definitions[key] = _definition_places(key.decode("utf-8", "surrogatepass"))
        return [(_short(text, n), _said(text, form, places), kind, at) for n, form, places, kind, at in found]

    def aliases(self, known: dict[str, tuple[str, str]]) -> tuple[Aliases, dict[bytes, Reader] | None]:
        """The names of a case, and what is kept for them: nothing if they have digits."""
        if any(_DIGIT.search(short) for short in known):
            return Aliases(known), None
        which = tuple(sorted((short, kind) for short, (_, kind) in known.items()))
        if (found := self.names.get(which)) is None:
            self._room(sum(len(short) for short, _ in which) * 40 + 1000)
            found = self.names[which] = Aliases(known), {}
        return found

    def reader(self, text: str, key: bytes, names: Aliases, kept: dict[bytes, Reader] | None) -> Reader:
        """What reads the references of this text, and of others of its shape if names have no digits."""
        if kept is None:
            return Reader(text, find_places(text, names), shared=False)
        found = kept.get(key)
        if found is None:
            shape = key.decode("utf-8", "surrogatepass")
            found = kept[key] = Reader(shape, find_places(shape, names))
            self._room(8 * len(key) + 1000 + 800 * found.size)
        return found


class Reader:
    """Reads the references of texts of one shape by columns. What has no digits is the same in all of them, and is made once.

    steps: the references, in the order in which a paragraph is heard (pins behind the others), that take something from what the case has come to or change it.
    """

    def __init__(self, text: str, places: list[Found], shared: bool = True):
        rows = _read(text, places, lambda short: (None, None))
        self.size, self.columns = len(places), [[r[c] for r in rows] for c in COLUMNS]
        varies = lambda place: shared and place is not None and _DIGIT.search(text, *place) is not None
        self.cut: list[tuple[int, int, int, int]] = []
        self.shorts: list[tuple[int, tuple[int, int]]] = []
        self.provisions: list[tuple[int, str, list[tuple[int, int]]]] = []
        self.pins: list[tuple[int, int, int]] = []
        self.cited = [(k, s.short) for k, s in enumerate(places) if s.family == "alias"]
        for k, s in enumerate(places):
            parts = {QUOTED_TEXT: _trimmed(text, s.start, s.end), NAME: s.name, EDITION: s.edition, **({} if s.family == "alias" else {NEUTRALS: s.neutral, SLRS: s.slr})}
            self.cut += [(c, k, *place) for c, place in parts.items() if varies(place)]
            self.shorts += [(k, s.alias)] if varies(s.alias) else []
            self.provisions += [(k, *s.provisions)] if any(map(varies, s.provisions[1])) else []
            self.pins += [(k, *s.pins)] if varies(s.pins) else []
        steps = ((s.family == "pin", s.start, k, self._step(k, s)) for k, s in enumerate(places))
        self.steps = sorted((s for s in steps if s[3]), key=lambda s: s[:2])
        changed = {c for c, *_ in self.cut} | {ALIASES for _ in self.shorts} | {PROVISIONS for _ in self.provisions} | {PIN_LISTS for _ in self.pins}
        changed |= {c for _ in self.cited for c in (NEUTRALS, SLRS)} | {c for s in self.steps if s[3] in BARE for c in (KIND, ALIASES)}
        self.changed = sorted(changed)

    def _step(self, k: int, s: Found) -> str | None:
        if s.family == "pin":
            return "pin"
        if not (self.columns[ALIASES][k] or self.columns[NAME][k] is not None):
            return {"provision": "bare provision", "rule": "bare rule"}.get(s.kind)
        return {"case": "case", "act": "act", "provision": "act", "rule": "rules"}.get(s.kind)

    def read(self, text: str, cites: Cites, pins: Pins) -> list[list]:
        """COLUMNS of this text, as they are before it is heard. Lists of equal values are shared."""
        out = self.columns[:]
        for c in self.changed:
            out[c] = out[c][:]
        for c, k, a, b in self.cut:
            out[c][k] = text[a:b]
        for k, place in self.shorts:
            out[ALIASES][k] = _short(text, place)
        for k, prefix, refs in self.provisions:
            out[PROVISIONS][k] = [prefix + "".join(text[a:b].split()) for a, b in refs]
        for k, a, b in self.pins:
            out[PIN_LISTS][k] = pins[text[a:b]]
        for k, short in self.cited:
            out[NEUTRALS][k], out[SLRS][k] = cites(short)
        return out


class Pins(dict):
    """Pins by their text, of which few are different."""

    MOST = 1 << 12

    def __missing__(self, text: str) -> list[int]:
        if len(self) >= self.MOST:
            self.clear()
        self[text] = found = expand_pins(text)
        return found


@dataclass
class Said:
    """The last case, act and rules that a case has come to: short names, or else titles."""

    case: str | None = None
    act: str | None = None
    rules: str | None = None

    def hear(self, read: list[tuple[Reader, list[list]]]) -> None:
        """Fills in the bare references of one paragraph, or of several that count as one. Pins take what the paragraph's other references end with."""
        steps = ((columns, step) for reader, columns in read for step in reader.steps)
        for columns, (_, _, k, what) in sorted(steps, key=lambda s: s[1][:2]) if len(read) > 1 else steps:
            if what == "pin":
                if self.case is not None:
                    columns[KIND][k], columns[ALIASES][k] = "case", self.case
            elif what == "bare provision":
                columns[ALIASES][k] = self.act
            elif what == "bare rule":
                columns[ALIASES][k] = self.rules
            else:
                setattr(self, what, columns[ALIASES][k] or columns[NAME][k])


SPANS = pa.schema([
    ("case_id", pa.int64()), ("paragraph_id", pa.int64()), ("ordinal", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), *((c, pa.string()) for c in TEXTS), ("provisions", pa.list_(pa.string())), ("pins", pa.list_(pa.int32())),
])


#: The same, and the neutral citation that the alias stands for.
SOUGHT = SPANS.append(pa.field("sought", pa.string()))
#: Spans of one Arrow batch.
BATCH = 2_000
#: What a text tells of each of its references, and where some of it is.
COLUMNS = SPANS.names[3:]
KIND, QUOTED_TEXT, NAME, NEUTRALS, SLRS, EDITION, ALIASES, PROVISIONS, PIN_LISTS = map(COLUMNS.index, ("kind", "quoted", "name", "neutral", "slr", "edition", "alias", "provisions", "pins"))
#: Steps that fill in a reference.
BARE = ("pin", "bare provision", "bare rule")


class Spans:
    """References by columns, those of SOUGHT, as they are gathered."""

    def __init__(self):
        self.size, self.columns = 0, [[] for _ in SOUGHT]

    def add(self, case: int | None, paragraph: int | None, ordinal: int | None, found: list[list], sought: list) -> None:
        n = len(sought)
        self.size += n
        for column, more in zip(self.columns, ([case] * n, [paragraph] * n, [ordinal] * n, *found, sought), strict=True):
            column += more

    def taken(self) -> Spans:
        """What was gathered; here nothing of it is left."""
        found = Spans()
        found.size, found.columns, self.size, self.columns = self.size, self.columns, 0, found.columns
        return found

    def rows(self) -> list[dict]:
        return [dict(zip(SOUGHT.names, r, strict=True)) for r in zip(*self.columns, strict=True)]

    def batch(self, schema: pa.Schema = SPANS) -> pa.RecordBatch:
        """As Arrow's: with SOUGHT or without what is sought."""
        return pa.RecordBatch.from_arrays([_lists(c, f.type) if pa.types.is_list(f.type) else pa.array(c, f.type) for c, f in zip(self.columns, schema, strict=False)], schema=schema)


def _lists(values: list[list], kind: pa.DataType) -> pa.Array:
    ends = list(accumulate(map(len, values), initial=0))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(list(chain.from_iterable(values)), kind.value_type))


def extract_aliases(paragraphs: DataFrame) -> DataFrame:
    """case_id, short_name, expanded, kind: of each case the first definition of a name. paragraphs: case_id, id, ordinal, content.

    A null content has none.
    """

    schema = pa.schema([("case_id", pa.int64()), ("ordinal", pa.int32()), ("short_name", pa.string()), ("expanded", pa.string()), ("kind", pa.string()), ("place", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shapes = Shapes()
        for b in batches:
            rows = [(c, o, n, e, k, p) for c, o, t in zip(*(x.to_pylist() for x in b.columns), strict=True) for n, e, k, p in shapes.defined(t, shapes.key(t))]
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True) if rows else [[]] * len(schema), schema, strict=True)], schema=schema)

    # An alias needs an opening bracket and a quotation mark: other paragraphs needn't go to Python.
    likely = paragraphs.filter(F.col("content").rlike(r"\((?:the\s+)?[\"“]"))
    found = spread(likely.select("case_id", "ordinal", "content")).mapInArrow(run, "case_id long, ordinal int, short_name string, expanded string, kind string, place int")
    first = F.min_by(F.struct("expanded", "kind"), F.struct("ordinal", "place")).alias("f")
    return found.groupBy("case_id", "short_name").agg(first).select("case_id", "short_name", "f.expanded", "f.kind")


def find_in(paragraphs: DataFrame, aliases: DataFrame) -> DataFrame:
    """The references of each paragraph (SPAN_SCHEMA) as its text has them, for tables and streams of paragraphs."""
    known = aliases.groupBy(F.col("case_id").alias("a_case")).agg(F.map_from_entries(F.collect_list(F.struct("short_name", F.struct("expanded", "kind")))).alias("aliases"))
    # Dealt by case before the join, to as many tasks as there are: Spark would put so few bytes into one.
    joined = spread(paragraphs.filter("content IS NOT NULL").select("case_id", "id", "ordinal", "content"), "case_id").join(known, F.col("case_id") == F.col("a_case"), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        case, cites, shapes = None, None, Shapes()
        for b in batches:
            out = Spans()
            for c, i, o, t, al in zip(*(x.to_pylist() for x in b.columns), strict=True):
                if cites is None or c != case:  # a case's paragraphs come together
                    case, cites = c, Cites({k: (v["expanded"], v["kind"]) for k, v in al or ()})
                    names = shapes.aliases(cites.known)
                reader = shapes.reader(t, shapes.key(t), *names)
                out.add(c, i, o, reader.read(t, cites, shapes.pins), [None] * reader.size)
            yield out.batch()

    return joined.select("case_id", "id", "ordinal", "content", "aliases").mapInArrow(run, SPAN_SCHEMA)


def extract_spans(paragraphs: DataFrame, aliases: DataFrame) -> DataFrame:
    """The references of each paragraph (SPAN_SCHEMA), with what bare ones mean by the state of their case.

    A provision without an instrument takes the last act of the case, a rule the last rules; bare pins take the last case, or
    the judgment itself if there was none, as of the end of their paragraph's other references. What is taken is the short name,
    or else the title, and stands in the column alias: it resolves only if the case defines such a name. References with
    neither, like citations without a title, change nothing.
    """
    return in_context(find_in(paragraphs, aliases))


def told(case: int | None, read: list[tuple[int | None, int | None, str, bytes]], known: dict[str, tuple[str, str]], said: Said, shapes: Shapes, out: Spans) -> Iterator[Spans]:
    """Adds to out the references of a case's paragraphs (id, ordinal, content, shape) in order, by these names and from the state `said` on, which goes on with them.

    out is handed on behind each paragraph. Paragraphs of one ordinal count as one: their pins come behind their other references.
    """
    cites, names = Cites(known), shapes.aliases(known)
    for _, together in groupby(read, key=lambda p: p[1]):
        some = list(together)
        readers = [shapes.reader(t, key, *names) for _, _, t, key in some]
        found = [(reader, reader.read(t, cites, shapes.pins)) for reader, (_, _, t, _) in zip(readers, some, strict=True)]
        said.hear(found)
        for (i, o, _, _), (_, columns) in zip(some, found, strict=True):
            out.add(case, i, o, columns, [cites(a)[0] if k == "case" and a in known else None for k, a in zip(columns[KIND], columns[ALIASES], strict=True)])
        yield out


def _by_own_names(case: int | None, paragraphs: list[tuple[int | None, int | None, str | None]], shapes: Shapes, out: Spans) -> Iterator[Spans]:
    read = [(i, o, t, shapes.key(t)) for i, o, t in paragraphs if t is not None]
    known: dict[str, tuple[str, str]] = {}
    for _, _, text, key in read:
        for short, expanded, kind, _ in shapes.defined(text, key):
            known.setdefault(short, (expanded, kind))
    return told(case, read, known, Said(), shapes, out)


def case_spans(case: int | None, paragraphs: list[tuple[int | None, int | None, str | None]], shapes: Shapes | None = None) -> Iterator[list[dict]]:
    """The references of one whole case, whose paragraphs (id, ordinal, content) are in order: aliases, spans and state in one walk. Rows of SOUGHT, by paragraph."""
    for out in _by_own_names(case, paragraphs, shapes or Shapes(), Spans()):
        yield out.taken().rows()


def walked(rows: Iterator[tuple], shapes: Shapes) -> Iterator[Spans]:
    """The references of paragraphs (case_id, id, ordinal, content) in the order of their cases and ordinals, a case held at a time: BATCH rows or a few more at once."""
    out = Spans()
    for case, group in groupby(rows, key=lambda r: r[0]):
        for _ in _by_own_names(case, [r[1:] for r in group], shapes, out):
            if out.size >= BATCH:
                yield out.taken()
    yield out


def case_references(paragraphs: DataFrame) -> DataFrame:
    """The references of whole cases (SPAN_SCHEMA and sought) by their own aliases, as extract_aliases() and extract_spans() give them, in one walk.

    sought is the neutral citation in what the alias of a case stands for. One shuffle by case, and one case held by a task at a time. paragraphs: case_id, id, ordinal, content.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(*(x.to_pylist() for x in b.columns), strict=True))
        for found in walked(rows, Shapes()):
            yield found.batch(SOUGHT)

    likely = paragraphs.filter("content IS NOT NULL").select("case_id", "id", "ordinal", "content")
    return spread(likely, "case_id").sortWithinPartitions("case_id", "ordinal", "id").mapInArrow(run, SPAN_SCHEMA + ", sought string")


def in_context(spans: DataFrame) -> DataFrame:
    """Gives bare provisions, rules and pins the short name or title that their case has come to."""
    phase = (F.col("family") == "pin").cast("int")
    before = Window.partitionBy("case_id").orderBy("ordinal", phase, "start").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    said = F.coalesce("alias", "name")
    last = lambda *kinds: F.last(F.when(F.col("kind").isin(*kinds), said), ignorenulls=True).over(before)
    spans = spans.withColumns({"last_case": last("case"), "last_act": last("provision", "act"), "last_rules": last("rule")})
    pin = F.col("family") == "pin"
    bare = F.when(F.col("kind") == "rule", F.col("last_rules")).when(F.col("kind") == "provision", F.col("last_act")).when(pin, F.col("last_case"))
    filled = {"alias": F.when(said.isNull(), bare).otherwise(F.col("alias")), "kind": F.when(pin & F.col("last_case").isNotNull(), "case").otherwise(F.col("kind"))}
    return spans.withColumns(filled).drop("last_case", "last_act", "last_rules")


def sought(spans: DataFrame, aliases: DataFrame | None) -> DataFrame:
    """Adds what a reference looks for: wanted, the neutral citation of a case (its own, or the first in its alias's expansion), and pin, the place of a paragraph.

    Of a case one pin names a paragraph, several name none; a reference to the judgment itself means its first. Without aliases, spans are
    those of case_references(), which have the citation already.
    """
    if aliases is None:
        rows, its = spans, F.col("sought")
    else:
        shorts = aliases.select(F.col("case_id").alias("s_case"), F.col("short_name").alias("s_name"), F.regexp_extract("expanded", NEUTRAL, 0).alias("s_cited"))
        rows, its = spans.join(shorts, (F.col("case_id") == F.col("s_case")) & (F.col("alias") == F.col("s_name")), "left"), F.nullif("s_cited", F.lit(""))
    wanted = F.when(F.col("kind") == "case", F.coalesce("neutral", its))
    pin = F.when((F.col("kind") == "self") | (F.size("pins") == 1), F.try_element_at("pins", F.lit(1)))
    return rows.withColumns({"wanted": wanted, "pin": pin}).drop("s_case", "s_name", "s_cited", "sought")


def resolve(spans: DataFrame, cases: DataFrame, paragraphs: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """Adds target_case and target_paragraph: at most one is set.

    A case is looked up by its neutral citation, or the first in its alias's expansion; with one pin that it has, the target is
    that paragraph. A reference to the judgment itself means the paragraph of its first pin. Acts, provisions, rules and books
    aren't resolved. Of cases with one citation the first by id is meant. cases: case_id, neutral_citation. paragraphs: case_id, id, ordinal.
    """
    targets = cases.filter("neutral_citation IS NOT NULL").groupBy(F.col("neutral_citation").alias("t_citation")).agg(F.min("case_id").alias("t_case"))
    # References that look for nothing are most of them: they are dealt by their own case instead of all meeting in one task.
    dealt = F.coalesce("wanted", F.concat(F.lit(" "), F.col("case_id").cast("string")))
    rows = sought(spans, aliases).withColumn("dealt", dealt).join(targets, (F.col("dealt") == F.col("t_citation")) & F.col("wanted").isNotNull(), "left")
    home = F.when(F.col("kind") == "self", F.col("case_id")).otherwise(F.col("t_case"))
    places = paragraphs.groupBy(F.col("case_id").alias("p_case"), F.col("ordinal").alias("p_ordinal")).agg(F.max("id").alias("target_paragraph"))
    rows = rows.withColumns({"home": F.coalesce(home, "case_id"), "pin": F.when(home.isNotNull(), F.col("pin"))})
    rows = rows.join(places, (F.col("home") == F.col("p_case")) & (F.col("pin") == F.col("p_ordinal")), "left")
    target_case = F.when(F.col("target_paragraph").isNull() & (F.col("kind") == "case"), F.col("t_case"))
    return rows.select(*(c for c in spans.columns if c != "sought"), target_case.alias("target_case"), "target_paragraph")
