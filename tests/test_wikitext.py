from hypothesis import given, settings
from hypothesis import strategies as st

from florilege.wikitext.inline import rich_text
from florilege.wikitext.page import Page
from florilege.wikitext.refs import entity, page_ref, template_call


def kinds(rt):
    return [(s["kind"], s["shown"]) for s in rt["spans"]]


def test_links():
    assert page_ref(":w:de:Der_Turm#Oben") == {"site": "wikipedia", "lang": "de", "title": "Der_Turm", "fragment": "Oben"}
    assert page_ref("Plain") == {"site": "wikiquote", "lang": "en", "title": "Plain", "fragment": None}
    forms = {"de:w:Ort": ("wikiquote", "de", "w:Ort", None), "w:de:fr:X": ("wikipedia", "de", "fr:X", None), "mw:X": ("wikiquote", "mw", "X", None), "wikibooks:X": ("wikiquote", "en", "wikibooks:X", None), "A#": ("wikiquote", "en", "A", ""), "Meta: de:Y": ("meta", "de", "Y", None), "DE:Y": ("wikiquote", "en", "DE:Y", None)}
    assert {t: tuple(page_ref(t).values()) for t in forms} == forms
    assert [rich_text(f"[[{t}]]")["text"] for t in ("w:Ort", "Work#Part", ":Category:X", "de:Ort")] == ["Ort", "Work", "Category:X", "de:Ort"]
    rt = rich_text(" See ''[[s:Work|The Work]]'' by [[Ann B]] and [https://x.example/a the site].")
    assert rt["text"] == "See The Work by Ann B and the site."
    assert kinds(rt) == [("link", "The Work"), ("italic", "The Work"), ("link", "Ann B"), ("external_link", "the site")]


def test_emphasis():
    assert kinds(rich_text("'''''[[w:A|A]]''''' is")) == [("link", "A"), ("bold_italic", "A")]
    assert kinds(rich_text("''open to the end")) == [("italic", "open to the end")]
    assert rich_text("a '''b ''c'' d''' e")["text"] == "a b c d e"
    p = Page("* ''one\n* two ''three''", "T")
    assert p.errors == 1


def test_templates_entities_tags():
    call = template_call("{{Cite_Book |title= A [[b|c]] |x|first=Ann|y=1=2}}")
    assert call["name"] == "cite book" and [(p["key"], p["value"]) for p in call["params"]] == [("title", "A [[b|c]]"), ("1", "x"), ("first", "Ann"), ("y", "1=2")]
    assert rich_text("{{lang|fr|mot}}&nbsp;{{isbn|978-1}}{{unknown|x}}<br/>a<ref>n</ref><!-- c -->b <nowiki>''r''</nowiki> &amp; &#65; &nope;")["text"] == "mot ISBN 978-1\nab ''r'' & A &nope;"
    assert entity("&#x110000;") == "&#x110000;" and rich_text("{{PAGENAME}} x", "Title")["text"] == "Title x"


PAGE = """{{italic title}}
[[File:a.jpg|thumb|A saying ~ Ann B]]
'''Ann''' lead {{w|x}}
[[Category:1910 births]]

== Quotes ==
* First
** ''Book'' (1900), p. 3
*** Note
* Second
=== In ''Work'' (1999) ===
# Third

== Dialogue ==
:'''[[Ann]]''': ''hm'' Hello
:''[waves]''
<hr width=50%>
:'''Bob:''' Hi
{| class=x
| * not a list
|}
== Cast ==
* Carl as Bob
"""


def test_blocks():
    p = Page(PAGE, "Ann")
    shape = [(r["section_ord"], r["block_index"], r["block_type"]) for r in p.rows]
    assert shape == [
        (0, 0, "template"), (0, 1, "media"), (0, 2, "paragraph"), (1, 0, "section"), (1, 0, "list_item"), (1, 1, "list_item"), (2, 0, "section"), (2, 0, "list_item"),
        (3, 0, "section"), (3, 0, "exchange"), (3, 1, "rule"), (3, 2, "exchange"), (3, 3, "table"), (4, 0, "section"), (4, 0, "list_item"),
    ]
    assert p.categories == ["1910 births"] and p.rows[1]["media"]["caption_attribution"] == "Ann B"
    assert [a["depth"] for a in p.rows[4]["annotations"]] == [2, 3] and [x["text"] for x in p.rows[7]["path"]] == ["Quotes", "In Work (1999)"]
    first, wave = p.rows[9]["turns"]
    assert (first["speaker"], first["rt"]["text"], first["speaker_link"]["title"]) == ("Ann", "hm Hello", "Ann") and kinds(first["rt"]) == [("italic", "hm")]
    assert wave["is_stage_direction"] and wave["speaker"] is None and p.rows[11]["turns"][0]["speaker"] == "Bob"


@given(st.text(alphabet="[]{}|'*:;#=<>/!-&abr \n~é", max_size=80))
@settings(max_examples=400, deadline=None)
def test_reader_takes_anything(text):
    for r in Page(text, "T").rows:
        rt = r.get("rt")
        if rt:
            raw = rt["text"].encode()
            assert rt["text"] == rt["text"].strip()
            assert all(0 <= s["start"] <= s["end"] <= len(raw) for s in rt["spans"])
