"""Citations, people, HTML and scalar functions on small texts."""

import json
import random
import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

from casemill.functions import people, scalars
from casemill.operators import citations, html


def test_alias_definitions():
    text = 'In Lee v Tan [2010] SGCA 5 (“Lee”) and the Sale of Goods Act (Cap 393) (the "Act" or the "SGA"). A man (“the buyer”).'
    found = citations.alias_definitions(text)
    assert [(n, k) for n, _, k, _ in found] == [("Lee", "case"), ("Act", "act"), ("SGA", "act"), ("the buyer", "fact")]
    assert found[0][1] == "Lee v Tan [2010] SGCA 5"
    assert citations.alias_definitions("") == []


@pytest.mark.parametrize(("text", "numbers"), [("[3]–[6]", [3, 4, 5, 6]), ("[6]-[5] and [9]", [5, 6, 9]), ("[1]–[99]", []), (None, [])])
def test_pins(text, numbers):
    assert citations.expand_pins(text) == numbers


def test_spans_do_not_overlap_and_keep_order():
    text = "See Re Ong [1999] 2 SLR(R) 7 at [4]; ss 12(1)(a), 13A and 14 of the Companies Act 2006 (Cap 50); rule 5 and (at [2]); above at [1]."
    found = citations.find_spans(text, {})
    assert [(s["family"], s["kind"]) for s in found] == [("case", "case"), ("provision", "provision"), ("provision", "rule"), ("pin", "self"), ("self", "self")]
    assert found[1]["provisions"] == ["s 12(1)(a)", "s 13A", "s 14"] and found[1]["name"] == "Companies Act 2006" and found[1]["edition"] == "Cap 50"
    assert citations.find_spans("", {}) == []


def test_state_goes_on_across_paragraphs(spark):
    content = ["s 2 of the Evidence Act 1893 binds.", "Under s 5 and rule 3. Nothing (at [7]).", "In Re Foo [2001] SGHC 4 (at [2]).", None]
    paragraphs = spark.createDataFrame([(1, i, i, c) for i, c in enumerate(content, 1)], "case_id long, id long, ordinal int, content string")
    spans = citations.extract_spans(paragraphs, citations.extract_aliases(paragraphs))
    got = {(r.paragraph_id, r.family, r.kind): (r.name, r.alias, r.neutral) for r in spans.collect()}
    # What a bare reference takes stands as its alias, also if no such name is defined.
    assert got[2, "provision", "provision"] == (None, "Evidence Act 1893", None)
    assert got[2, "provision", "rule"] == (None, None, None)
    assert (2, "pin", "self") in got
    assert got[3, "case", "case"] == ("Re Foo", None, "[2001] SGHC 4")
    assert got[3, "pin", "case"] == (None, "Re Foo", None)


def people_of(spark, *metadata):
    df = spark.createDataFrame(list(enumerate(metadata)), "id int, m string")
    found = df.select("id", people.judges(F.col("m")).alias("j"), people.parties(F.col("m")).alias("p"), people.counsel(F.col("m")).alias("c")).orderBy("id").collect()
    return [(r.j, [tuple(x) for x in r.p], [tuple(x) for x in r.c]) for r in found]


def test_people(spark):
    metadata = '{"Counsels": {"Counsel": "Ann Lee SC, Bo Tan & Cy (Tan & Lee LLP) for the appellant. The respondent in person."}, "Corams": {"Coram": [{"content": "Tay  J"}, ["x"], "Lim CJ"]}, "Parties": {"Party": {"Name": ["A", "B"]}}}'
    [(judges, parties, counsel), *others] = people_of(spark, metadata, None, "{", '{"Parties": 7, "Corams": [1], "Counsels": {"Counsel": {}}}')
    assert counsel == [("Ann Lee SC", "appellant"), ("Bo Tan & Cy", "appellant")]
    assert judges == ["Tay J", "Lim CJ"]
    assert parties == [("A", None), ("B", None)]
    assert others == [([], [], [])] * 3


def test_shapes_of_people(spark):
    lines = ["Ann, sc and Bob (‘Bo, b’) Tan for the first respondent", "Cy Lee & Di Ang and Ed Fox (instructed), Gia Hue (attorney general) for A B Pte. Ltd. The second respondent absent", "with Hal Ito (Law Corporation) For the State.", "The plaintiff for the plaintiff", "Nobody", " "]
    text = json.dumps({"Counsels": {"Counsel": lines}, "Corams": {"Coram": " Tay  J"}, "Parties": {"Party": ["X ", {"Role": {"content": "def"}, "Name": "", "Party": "Y"}, {"Role": ["r1", "r2"], "Name": ["P", {"content": "Q"}]}, 3, None, ["z"]]}})
    [(judges, parties, counsel)] = people_of(spark, text)
    assert judges == ["Tay J"] and parties == [("X", None), ("Y", "def"), ("P", "r1"), ("Q", "r1")]
    first = [("Ann SC", "first respondent"), ("Bob (‘Bo, b’) Tan", "first respondent")]
    assert counsel == first + [(n, "A B Pte. Ltd") for n in ("Cy Lee", "Di Ang", "Ed Fox", "Gia Hue")] + [("Hal Ito", "State")]


def test_layouts_and_blocks(spark):
    pages = spark.createDataFrame(
        [(1, '<p class="Judg-1">1 One<p>more<p class="Judg-Heading-1">Head</p><p class="Judg-1">2. Two'), (2, "<p>1 a</p><p>3 b</p>"), (3, "<p>" + "<br><br>".join(["a b c d e f g h i j k"] * 3)), (4, "<i>x</i>"), (5, None), (6, " ")],
        "id long, html string",
    )
    found = html.paragraphs(pages, "id", "html")
    states = {r.id: (r.layout, r.expected, r.extracted, r.parse_status) for r in html.layouts(pages, found, "id", "html").collect()}
    assert states == {
        1: ("modern_judg1", 2, 2, "complete"), 2: ("numbered_plain_p", 3, 2, "incomplete"), 3: ("unnumbered_br", 3, 3, "complete"),
        4: ("unknown", None, 0, "unknown"), 5: ("failed", None, 0, "failed"), 6: ("failed", None, 0, "failed"),
    }
    got = rows(html.blocks(found, html.layouts(pages, found, "id", "html"), "id"))
    assert [r for r in got if r[0] == 1] == [(1, 1, "One\nmore"), (1, 2, "Two")]
    assert [r for r in got if r[0] == 3] == [(3, i, "a b c d e f g h i j k") for i in (1, 2, 3)]


def test_points_and_notes():
    text = (
        '<div class="legis"><div class="body"><div class="prov1" id="pr3-"><table><tr><td class="prov1Hdr">Aim</td></tr><tr><td class="prov1Txt"><strong>3.</strong>—(1) Goods<div class="amendNote">[1/2]</div>'
        '<div class="prov2Txt">—(2) Where<table><tr><td class="p1No">(a)</td><td class="pTxt" id="a">one<div class="amendNote">[3/4]</div><table><tr><td class="p2No">(i)</td><td class="p2Txt">deep</td></tr></table></td></tr></table>'
        '<div class="prov2TxtIL"><a name="n9"></a>(9) Inner<table><tr><td class="p1No">(b)</td><td class="pTxt">own</td></tr></table></div></div></td></tr></table></div></div></div>'
    )
    rows_ = html.provision_rows(text)
    assert [(r["level"], r["kind"], r["citation"], r["descendant_count"], r["content"], r["anchor"], r["note"]) for r in rows_] == [
        (1, "section", "s 3", 5, "—(1) Goods", "pr3-", "[1/2]"), (2, "subsection", "s 3(2)", 2, "Where", "n9", None), (3, "point", "s 3(2)(a)", 1, "one", "a", "[3/4]"), (4, "point", "s 3(2)(a)(i)", 0, "deep", None, None),
        (2, "subsection", "s 3(9)", 1, "Inner", "n9", None), (3, "point", "s 3(9)(b)", 0, "own", None, None),
    ]
    cell = '<table><tr><td class="def">{}</td></tr></table>'
    assert html.definition_rows(cell.format("“goods” and “wares” include all things")) == [("goods", "and “wares” include all things"), ("wares", "and “wares” include all things")]
    assert html.definition_rows(cell.format("it means “x” of") + cell.format("no quotes") + cell.format("“only”")) == []
    assert html.provision_rows(None) == html.definition_rows("") == []


def test_schedules_are_counted_with_their_statute(spark):
    section = '<div class="prov1"><table><tr><td class="prov1Txt"><strong>1.</strong> Text</td></tr></table></div>'
    schedule = '<div class="tail"><div class="schedule"><table><tr><td class="sHdr">THE SCHEDULE</td></tr></table>' + "".join(f'<table><tr><td class="tailSTxt">{i}. P</td></tr></table>' for i in range(1, 6)) + "</div></div>"
    whole = f'<div class="legis"><div class="body">{section}</div>{schedule}</div>'
    pages = spark.createDataFrame([(1, whole), (2, f"<div>{section}</div>"), (3, "<p>x"), (4, None)], "id long, html string")
    states = {r.id: (r.expected, r.extracted, r.parse_status) for r in html.legislation_status(pages, "id", "html").collect()}
    assert states == {1: (2, 2, "complete"), 2: (1, 0, "incomplete"), 3: (0, 0, "unknown"), 4: (None, 0, "failed")}


def test_line_breaks_part_pieces_only_if_nothing_is_between():
    words = "a b c d e f g h i j"
    [(_, _, _, lines)] = html.paragraph_rows(f"<p>{words}<br><br/>{words}<br> <br>{words}</p>")
    assert lines == f"{words}\n\n{words}\n \n{words}"


def test_scalars(spark):
    one = spark.range(1)
    c = lambda x: one.select(x.alias("x")).first().x
    assert c(scalars.collapse(F.lit(" a   b "))) == "a b" and c(scalars.collapse(F.lit("  "))) is None
    assert c(scalars.paragraph_number(F.lit("12.) x"))) == 12 and c(scalars.paragraph_number(F.lit("x 1"))) is None
    assert c(scalars.short_heading(F.lit("Third Schedule"))) == "Sch 3" and c(scalars.short_heading(F.lit("PART 4A x"))) == "Pt 4A"
    assert c(scalars.iso_date(F.lit("2020-02-30T"))) is None and str(c(scalars.compact_date(F.lit("20200229")))) == "2020-02-29"
    assert tuple(c(scalars.judge(F.lit("Tay J")))) == ("Tay", "J") and tuple(c(scalars.judge(F.lit("J")))) == ("J", None)
    assert c(scalars.order_number(F.lit("a#[12]"))) == 12 and c(scalars.order_number(F.lit("a#pr7"))) == 7 and c(scalars.order_number(F.lit("a"))) == 0
    assert c(scalars.clean_url(F.lit("http://h/p?_=1&a=2&WholeDoc=1#t"))) == "http://h/p?a=2#t"
    assert c(scalars.provision_list(F.lit("12 (1), 13A and 14"), F.lit("s"))) == ["s 12(1)", "s 13A", "s 14"]


REFERENCES = [
    # text, aliases, and each reference's family, kind, name and pins
    ("See Lee v Tan [2010] SGCA 5 (“Lee”) at [3]–[5] and [9].", {}, [("case", "case", "Lee v Tan", [3, 4, 5, 9])]),
    ("It was held in A v B [2001] 2 SLR(R) 7; [2001] SGHC 3 at [2].", {}, [("case", "case", "A v B", []), ("case", "case", None, [2])]),
    ("Others followed [1999] 1 WLR 12.", {}, [("case", "case", "Others followed", [])]),
    ("Sections 2(1)(a), 3A and 4 of the Sale of Goods Act 1979 (Cap 393) (the “SGA”) apply.", {}, [("provision", "provision", "Sale of Goods Act 1979", [])]),
    ("By s 5 of the Act, as rule 7 of the Rules has it.", {"Act": ("Evidence Act 1893", "act"), "Rules": ("Court Rules 2014", "rules")}, [("provision", "provision", None, []), ("provision", "rule", None, [])]),
    ("s 5 of the Actors' code", {"Act": ("Evidence Act 1893", "act")}, [("provision", "provision", None, [])]),
    ("As described at [12] and above at [14]–[13].", {}, [("self", "self", None, [12]), ("self", "self", None, [13, 14])]),
    ("Jane Roe, The Law of Torts of Today (Some Press, 3rd Ed, 2011) at p 44 says so.", {}, [("book", "book", "Jane Roe, The Law of Torts of Today", [])]),
    ("In Re Foo Bar at [7] it failed.", {}, [("re", "case", "Re Foo Bar", [7])]),
    ("Alpha at [2] agrees with Alphabet.", {"Alpha": ("Re Alpha [2001] SGHC 3", "case")}, [("alias", "case", None, [2])]),
    ("The buyer paid, and Alpha Two holds (at [6]).", {"Alpha": ("x", "fact"), "Alpha Two": ("Re A [2001] SGHC 3", "case")}, [("alias", "case", None, []), ("pin", "self", None, [6])]),
    ("First (at [1]), then see X v Y [2010] SGHC 9, then at [2].", {}, [("pin", "self", None, [1]), ("case", "case", "X v Y", []), ("pin", "self", None, [2])]),
    ("Wide [1]–[99] at [1]-[99].", {}, [("pin", "self", None, [])]),
    ("Nothing here (2010) at all.", {}, []),
]


@pytest.mark.parametrize(("text", "aliases", "want"), REFERENCES)
def test_references_of_many_shapes(text, aliases, want):
    got = citations.find_spans(text, aliases)
    assert [(s["family"], s["kind"], s.get("name"), s.get("pins", [])) for s in got] == want
    assert all(a["end"] <= b["start"] for a, b in zip(got, got[1:]))


EXPANSIONS = [
    ("They relied on Re Alpha [2001] SGHC 5, (“Alpha”)", "They relied on Re Alpha [2001] SGHC 5"), ("See Re Alpha [2001] SGHC 5, (“Alpha”)", "Re Alpha [2001] SGHC 5"), ("They sued John Tan, (“John”)", "They sued John Tan"), ("by the Sale of Goods Act 1999  (Cap 97, 1997 Rev Ed) (“X”)", "Sale of Goods Act 1999 (Cap 97, 1997 Rev Ed)"),
    ("Foo Act (the “A”) and Bar Act (“X”)", "Foo Act (the “A”) and Bar Act"), ("so it was (“X”)", "so it was"), ("(“X”)", ""), ("x; Beta v Gamma [2002] SGHC 7 and 9 (“X”)", "SGHC 7 and 9"),
    ("One Two " * 9 + "(“X”)", "Two " + "One Two " * 5 + "One Two"), ("cited in (Lee v Tan [2010] SGCA 5 (“X”)", "Lee v Tan [2010] SGCA 5"),
]


@pytest.mark.parametrize(("text", "expanded"), EXPANSIONS)
def test_expansions(text, expanded):
    assert citations.alias_definitions(text)[-1][1] == expanded


def test_one_automaton_finds_what_a_search_for_each_name_finds():
    rng = random.Random(5)
    for _ in range(300):
        names = {"".join(rng.choice("Ab _") for _ in range(rng.randint(1, 4))).strip() or "A": rng.choice(["case", "act", "rules", "fact"]) for _ in range(5)}
        text = "".join(rng.choice("Ab _,") for _ in range(40))
        want = sorted((m.start(), m.end(), n) for n, kind in names.items() if kind != "fact" for m in re.finditer(rf"(?<!\w){re.escape(n)}(?!\w)", text))
        assert sorted((a, b, what[0]) for a, b, what in citations.Aliases({n: ("x", k) for n, k in names.items()}).mentions(text)) == want


SENTENCES = [
    "See Re Alpha [2001] SGHC 2 (“Alpha”).", "As in [1999] 2 SLR(R) 7 and (at [2]).", "Under s 4 and rule 5.", "By s 2 of the Evidence Act 1893 (the “EA”).", "r 3 of the Court Rules 2014 applies.", "The EA, then s 9.", "Alpha at [3] says, at [4].",
    "In Re Beta Co at [1] it held (at [5]).", "The firm (“Firm”) relies on s 1 of the Firm.", "Nothing.",
]


def test_state_against_a_plain_walk(spark):
    rng = random.Random(7)
    rows_ = [(c, 10 * c + o, o, " ".join(rng.choice(SENTENCES) for _ in range(3))) for c in range(40) for o in range(1, 6)]
    paragraphs = spark.createDataFrame(rows_, "case_id long, id long, ordinal int, content string")
    aliases_ = citations.extract_aliases(paragraphs)
    known = {}
    for r in aliases_.collect():
        known.setdefault(r.case_id, {})[r.short_name] = (r.expanded, r.kind)
    want = []
    for c in range(40):
        case = act = rules = None
        for _, i, _, text in [r for r in rows_ if r[0] == c]:
            spans = citations.find_spans(text, known.get(c, {}))
            for s in sorted(spans, key=lambda s: (s["family"] == "pin", s["start"])):
                said, kind = s.get("alias") or s.get("name"), s["kind"]
                alias = s.get("alias")
                if s["family"] == "pin":
                    kind, alias = ("case", case) if case else ("self", None)
                elif said is None and kind in ("provision", "rule"):
                    alias = act if kind == "provision" else rules
                elif said is not None:
                    case, act, rules = (said if kind == "case" else case), (said if kind in ("act", "provision") else act), (said if kind == "rule" else rules)
                want.append((c, i, s["start"], kind, s.get("name"), alias))
    got = citations.extract_spans(paragraphs, aliases_)
    assert rows(got, "case_id", "paragraph_id", "start", "kind", "name", "alias") == sorted(want, key=repr)


def test_long_paragraphs_take_time_in_proportion():
    many = "See [1999] 2 SLR(R) 17 at [2]. " * 3000
    assert len(citations.find_spans(many, {})) == 3000
    assert citations.alias_definitions("Word and Other " * 20_000 + "(the “X”)")[0][0] == "X"


def test_cases_with_one_citation_resolve_once(spark):
    paragraphs = spark.createDataFrame([(1, 1, 1, "See A v B [2001] SGHC 2."), (2, 2, 1, "x"), (3, 3, 1, "y")], "case_id long, id long, ordinal int, content string")
    cases = spark.createDataFrame([(1, "[2001] SGHC 1"), (2, "[2001] SGHC 2"), (3, "[2001] SGHC 2"), (4, None)], "case_id long, neutral_citation string")
    aliases = citations.extract_aliases(paragraphs)
    assert [(r.target_case, r.target_paragraph) for r in citations.resolve(citations.extract_spans(paragraphs, aliases), cases, paragraphs, aliases).collect()] == [(2, None)]


def test_states_are_counted_as_the_whole_parse_counts_them(monkeypatch):
    section, both = '<div class="prov1"><table><tr><td class="prov1Txt"><strong>1.</strong> A</td></tr></table></div>', '<div class="prov1 prov1Rep"></div>'
    part = f'<table><tr><td class="part"><div class="partNo">PART 1</div>{section}<table><tr><td class="div">{section}</td></tr></table></td></tr></table>'
    pages = [None, " ", "<p>x", f'<div class="legis"><div class="body">{part}{section}{both}</div>{section}<div class="tail"><div class="schedule"></div></div></div>', f'<div class="body"><table><tr><td class="div">{section}</td></tr></table></div>']
    want = [[(r.get("expected"), r.get("extracted")) for r in html.statute_rows(p) if r["what"] == "state"] for p in pages]
    assert want[3] == [(7, 5)]
    monkeypatch.setattr(html, "_plain", None)  # no text is read
    assert [html.state_rows(p) for p in pages] == want


def test_plain_markup_gives_the_tree_of_the_tolerant_parser():
    def shape(node):
        return node if isinstance(node, str) else (node.tag, node.attrs, [shape(x) for x in node.inside])

    def tolerant(page):
        builder = html._Builder()
        builder.feed(page)
        builder.close()
        return shape(builder.root)

    plain = ['<p>a<p class="x y">b<br>c</div>', '<table><tr><td id="1">a<td id="1" id="2">b<tr><th>c</table> d', "<ul><li>a<li><ul><li>b</ul><li>c", 'a > b "c"\r\n\x00', '<div class="">x</p></div></div>', ""]
    other = ["<P>a</P>", "a &amp; b", "<script>'<p>'</script>", "a < b", "<p/>x", "<a href=x>y</a>", "<!-- <p> --><p>z", "<title><p>t</title>", "</div >", "<p\n>x"]
    for page in plain:
        assert shape(html._plain_tree(page)) == tolerant(page) == shape(html.parse(page))
    for page in other:
        assert html._plain_tree(page) is None and shape(html.parse(page)) == tolerant(page)
