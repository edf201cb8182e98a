import json

import pytest
from pyspark.sql import functions as F

from florilege.functions import citation, rules
from florilege.functions.hashing import blake3_hex16, hash16
from florilege.plans import layer1, layer2, pipeline, report
from florilege.session import shared_path, written
from florilege.sources import documents, dump
from florilege.streaming.ingest import ingest

ROLES = [("Quotes:", "quotes"), ("Quotes about X", "quotes_about"), ("Broadcast", "cast"), ("Undisputed", "disputed"), ("Season Two", "episodes"), ("q", "alpha_bucket"), (" \u0416 ", "alpha_bucket"), ("q:", "other"), ("Related", "see_also"), ("Taglines 1", "taglines"), ("Else", "other"), ("", "other")]
HINTS = [
    ("Season 3", False, ("season", None, None, 3, None)), ("1640s", False, ("period", None, None, None, None)), ("The Well [3x-7]", False, ("episode", "The Well", None, None, "3x-7")), ("episode  12", False, ("episode", None, None, None, "12")),
    ("Act II", False, ("locator", None, None, None, None)), ("Salt [i] (1903)", False, ("work", "Salt [i]", 1903, None, None)), ("A (May 1 776)", False, ("work", "A", 1776, None, None)), ("Name", True, ("work", "Name", None, None, None)), ("Name", False, None),
]
DATES = [
    ("said 17 June 2012.", ("2012-06-17", None, "day", "17 June 2012")), ("June 5, 1999", ("1999-06-05", None, "day", "June 5, 1999")), ("in Sept. 1880", ("1880-09", None, "month", "Sept. 1880")), ("c. 1420", ("1420", None, "circa", "c. 1420")),
    ("(1914–1918)", ("1914", "1918", "range", "(1914–1918)")), ("fell 44 BC", ("-0044", None, "year", "44 BC")), ("x (in 1757), y", ("1757", None, "year", "1757")), ("1901", ("1901", None, "year", "1901")), ("line 1901", None), ("5 Foo 1999 (1998)", ("1998", None, "year", "1998")),
]


def test_rules(spark):
    df = spark.createDataFrame(ROLES, "h string, want string")
    assert df.where(rules.role_of(F.col("h")) != F.col("want")).collect() == []
    got = spark.createDataFrame([(h, i) for h, i, _ in HINTS], "h string, i boolean").select(rules.source_hint(F.col("h"), F.col("i")).alias("x")).collect()
    assert [(r.x.kind, r.x.title, r.x.year, r.x.number, r.x.code) if r.x else None for r in got] == [w for _, _, w in HINTS]
    got = spark.createDataFrame([(t,) for t, _ in DATES], "t string").select(citation.read_date(F.col("t")).alias("d")).collect()
    assert [tuple(r.d) if r.d else None for r in got] == [w for _, w in DATES]


def test_citation_scalars(spark):
    df = spark.createDataFrame([("Letter, Act IV, scene 2, vol. 3, ch. ix, pp. 12–15, lines 3-9, ISBN 3-16-148410-X. Retrieved 1 May 2020",)], "t string")
    t = F.col("t")
    r = df.select(*[citation.locator(t, p) for p in (citation.ACT, citation.PART, citation.CHAPTER, citation.PAGE, citation.LINE)], citation.isbn(t), citation.read_occasion(t), citation.before_retrieval(t)).first()
    assert tuple(r) == ("Act IV, scene 2", "vol. 3", "ch. ix", "pp. 12–15", "lines 3-9", "3-16-148410-X", "letter", "Letter, Act IV, scene 2, vol. 3, ch. ix, pp. 12–15, lines 3-9, ISBN 3-16-148410-X. ")


def test_hash(spark):
    data = [bytes(i % 251 for i in range(n)) for n in (0, 1, 63, 64, 65, 1023, 1024, 1025, 2048, 3072, 5121, 9000)]
    jvm = spark.sparkContext._jvm.org.apache.commons.codec.digest.Blake3
    assert blake3_hex16(data) == [bytes(jvm.hash(d))[:8].hex() for d in data]
    assert [r[0] for r in spark.createDataFrame([("",), (None,)], "t string").select(hash16("t")).collect()] == ["af1349b9f5f9a1a6", None]


PAGES = [
    ("Ann B", 1, "* Lead\n\n== Quotes ==\n=== In ''Deeds'' (1901) ===\n* Said it\n** p. 4\n* Twice\n** To [[Carl D]], letter (5 May 1902)\n** Meaning: ''it''\n\n== Quotes about Ann ==\n* She did\n** [[Eve F]], ''[[s:Acts|Acts]]'' (1950)\n\n== Misattributed ==\n* Not hers\n[[Category:1880 births]]"),
    ("Film X", 2, "== Dialogue ==\n:'''Bob''': Hi\n:'''Eve''': Ho\n:''[exit]''\n\n== Cast ==\n* Carl D as Bob\n* Old as Eve\n* New as Eve\n\n== Taglines ==\n* Buy it\n[[Category:1999 films]]"),
    ("Show Y", 3, "== Season 2 ==\n=== Dusk [1.04] ===\n:'''Bob''': Yes\n[[Category:Cancelled shows]]"),
    ("Which", 4, "{{disambig}}\n* Not a quote"),
    ("Sayings", 5, "* Old saw\n** {{cite book|title=Saws|author=Ann|year=1999|isbn=1}}\n[[Category:Odd proverbs]]"),
]


@pytest.fixture(scope="module")
def quotes(spark):
    raw = spark.createDataFrame([(t, i, 10 + i, "2025-01-01T00:00:00Z", x) for t, i, x in PAGES], "title string, page_id bigint, revision_id bigint, timestamp string, text string")
    blocks = written(layer1.parse_pages(raw), "test")
    return raw, blocks, written(layer2.quotes(blocks), "test")


def test_records(quotes):
    got = {(r["page_title"], r["text"]): r for r in quotes[2].collect()}
    assert len(got) == 11
    r = got["Ann B", "Said it"]
    s = r["source"]
    assert (r["status"], s["work_title"], s["work_year"], s["date_iso"], s["locator_page"], r["provenance"]["source_from"], s["raw"]) == ("sourced", "Deeds", 1901, "1901", "p. 4", "mixed", "In ''Deeds'' (1901) — p. 4")
    assert (r["speaker"]["name"], r["about"], r["context_path"]) == ("Ann B", [], ["Quotes", "In Deeds (1901)"])
    r = got["Ann B", "Twice"]
    assert (r["source"]["occasion"], r["source"]["date_iso"], [t["text"] for t in r["translations"]]) == ("letter", "1902-05-05", ["it"])
    r = got["Ann B", "She did"]
    assert (r["speaker"]["name"], r["about"][0]["name"], r["source"]["work_link_site"], r["source"]["work_title"]) == ("Eve F", "Ann B", "wikisource", "Acts")
    r = got["Ann B", "Not hers"]
    assert (r["speaker"], r["status"], r["provenance"]["status_from"], r["source"]) == (None, "misattributed", "section_role", None)
    assert got["Film X", "Hi"]["speaker"]["played_by"] == "Carl D" and got["Film X", "Ho"]["speaker"]["played_by"] == "New"
    assert got["Film X", "Bob: Hi\nEve: Ho\n[exit]"]["kind"] == "dialogue" and got["Film X", "Buy it"]["kind"] == "tagline"
    s = got["Show Y", "Yes"]["source"]
    assert (s["episode_series"], s["episode_season"], s["episode_number"], s["episode_title"], s["work_type"]) == ("Show Y", 1, "1.04", "Dusk", "series")
    r = got["Sayings", "Old saw"]
    assert (r["kind"], r["speaker"], r["source"]["isbn"], r["source"]["cite_templates"][0]["params"][1]["value"]) == ("proverb", None, "1", "Ann")


def test_report(quotes):
    _, blocks, q = quotes
    made = report.build(layer1.typed_pages(blocks), q, blocks)
    assert made["pages"]["by_type"] == {"disambiguation": 1, "film": 1, "person": 1, "proverbs": 1, "television_series": 1} and made["pages"]["pages"] == 5
    assert made["quotes"]["overall"]["quotes"] == 11 and made["quotes"]["by_page_type"]["film"]["quotes"] == 4
    assert report.top_headings(report.headings(blocks)).count() == 0
    assert layer2.quotes(blocks.limit(0)).count() == 0


def test_share(spark):
    df = spark.createDataFrame([(1, 8), (0, 0), (1, 3)], "a int, b int")
    assert [r[0] for r in df.select(report.share(F.col("a"), F.col("b"))).collect()] == [12.5, 0.0, 33.3]


XML = """<mediawiki><page><title>A</title><ns>0</ns><id>1</id><revision><id>7</id><timestamp>2025-01-01T00:00:00Z</timestamp><contributor><id>99</id></contributor>
<text bytes="9">* Hi &amp;amp; &lt;ref&gt;x&lt;/ref&gt;</text></revision></page><page><title>B</title><ns>0</ns><id>2</id><redirect title="A"/><revision><id>8</id><text/></revision></page>
<page><title>Talk:A</title><ns>1</ns><id>3</id><revision><id>9</id><text>no</text></revision></page></mediawiki>"""


def test_dump_pipeline_and_stream(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "d.xml").write_text(XML)
    at = lambda n: str(tmp_path / n)
    assert pipeline.parse(spark, str(folder), at("blocks"), at("redirects")) == {"pages": 3, "content": 1, "redirects": 1}
    assert pipeline.normalise(spark, at("blocks"), at("quotes")) == {"documents": 1, "quotes": 1}
    made = pipeline.make_report(spark, at("blocks"), at("quotes"), at("r/report.json"))
    assert json.loads((tmp_path / "r/report.json").read_text()) == made and made["quotes"]["overall"]["quotes"] == 1
    assert tuple(spark.read.parquet(at("blocks")).where("block_type = 'page'").select("bytes", "source_lines").first()) == (23, 1)
    pages = dump.read_dump(spark, str(folder))
    assert [tuple(r) for r in dump.redirects(pages).collect()] == [("B", "A")] and pages.where("page_id = 1").first()["revision_id"] == 7
    assert dump.resolve(spark.createDataFrame([("B",), ("Z",)], "t string"), "t", dump.redirects(pages)).orderBy("t").collect()[0]["resolved"] == "A"
    ingest(spark, str(folder), at("stream"), shared_path(spark, "stream")).awaitTermination()
    assert spark.read.parquet(at("stream")).where("block_type = 'list_item'").count() == 1


def test_dump_entities_compression_and_broken_files(spark, tmp_path):
    import bz2

    page = "<page><title>A&amp;B</title><ns>x</ns><id>1</id><revision><id>7</id><text xml:space='preserve'>  &#x2014;&#38; &nosuch; R&D &lt;b&gt; </text></revision></page>"
    (tmp_path / "a.xml.bz2").write_bytes(bz2.compress(f"<mediawiki><siteinfo><sitename>S</sitename></siteinfo>{page}\n{page.replace('<id>1<', '<id>2<')}</mediawiki>\n".encode()))
    got = dump.read_dump(spark, str(tmp_path / "a.xml.bz2")).orderBy("page_id").collect()
    assert [(r["title"], r["ns"], r["page_id"], r["text"]) for r in got] == [("A&B", 0, i, "  —& &nosuch; R&D <b> ") for i in (1, 2)]
    (tmp_path / "cut.xml").write_text(f"<mediawiki>{page}{page[:120]}")
    with pytest.raises(Exception):
        dump.read_dump(spark, str(tmp_path / "cut.xml")).collect()
    (tmp_path / "none.xml").write_text("<mediawiki></mediawiki>")
    assert dump.read_dump(spark, str(tmp_path / "none.xml")).count() == 0


def test_command_line(spark, tmp_path, capsys):
    from florilege.__main__ import main

    (tmp_path / "d.xml").write_text(XML)
    at = lambda n: str(tmp_path / n)
    assert main(["parse", "--input", at("d.xml"), "--pages", at("p"), "--redirects", at("r")]) == 0
    assert main(["normalize", "--pages", at("p"), "--out", at("q")]) == 0 and main(["report", "--pages", at("p"), "--quotes", at("q"), "--out", at("report.json")]) == 0
    assert capsys.readouterr().err.splitlines()[-3:] == ["pages 3, content 1, redirects 1", "documents 1, quotes 1", "pages 1, quotes 1"]
    assert json.loads((tmp_path / "report.json").read_text())["pages"]["source_lines"] == 1
    # layer 1 as nested documents gives the same quotes and report
    assert main(["parse", "--form", "jsonl", "--input", at("d.xml"), "--pages", at("j"), "--redirects", at("jr")]) == 0 and main(["normalize", "--form", "jsonl", "--pages", at("j"), "--out", at("jq")]) == 0
    assert main(["report", "--form", "jsonl", "--pages", at("j"), "--quotes", at("jq"), "--out", at("j.json")]) == 0 and (tmp_path / "j.json").read_text() == (tmp_path / "report.json").read_text()
    assert spark.read.parquet(at("jq")).collect() == spark.read.parquet(at("q")).collect()
    with pytest.raises(SystemExit):
        main(["parse"])


def test_report_queries_over_documents(spark, tmp_path):
    from florilege.queries import engine

    text = "== Odd ==\n* one\n* two\n=== 1912 ===\n* three\n=== Act II ===\n* four\n== Quotes ==\n* five\n[[Category:1999 films]]"
    spark.sql("select id as doc_id, 'P' as page_title, current_timestamp() as fetched_at, t as text from values (1, :a), (2, :b) as v(id, t)", {"a": text, "b": "== Odd ==\n"}).write.parquet(str(tmp_path / "documents.parquet"))
    assert [tuple(r) for r in engine.QUERIES["document_headings"](spark, str(tmp_path)).collect()] == [("Odd", 2)]
    got = {(r["overall"], r["page_type"]): (r["pages"], r["source_lines"]) for r in engine.QUERIES["document_totals"](spark, str(tmp_path)).collect()}
    assert got[1, None] == (2, 11) and got[0, "film"] == (1, None) and len(got) == 3


def test_coverage_counts_quotes_without_page_type(spark, tmp_path):
    from florilege.queries import engine

    row = "named_struct('name', 'A') as speaker, named_struct('raw', 'r', 'complete', true, 'work_title', 'w', 'date_iso', '1901') as source, named_struct('unparsed_annotations', 1) as provenance"
    spark.sql(f"select explode(array('film', null, 'film')) as page_type, {row}").write.parquet(str(tmp_path / "quotes.parquet"))
    got = {(r["overall"], r["page_type"]): r["quotes"] for r in engine.report_coverage(spark, str(tmp_path)).collect()}
    assert got == {(0, "film"): 2, (0, None): 1, (1, None): 3}


GOLDEN = """{{italic title}}
{{wikipedia}}
[[File:Mill.jpg|thumb|The mill stands. ~ [[Ann B]]]]
By {{w|Carl Zed|Zed}}, see [https://mill.example/a the mill].
* Lead saying of '''''{{PAGENAME}}'''''
** Act III, sc. 2, lines 4-9, [[s:The Mill|The Mill]], ''The Mill''

== Season Two ==
=== Dusk [2.05] ===
:''[the mill turns]''
:'''[[Bob]]''': Hold on
:'''Eve:''' I do
----
:'''Bob''': Late

== Taglines ==
* Grind on

== Lyrics ==
* La la {{lang|FR|chanson}}
** Translation: a song

== See also ==
* [[Other page]]

== Cast ==
* Old Dan as Bob
[[Category:Cancelled shows]]"""


def test_golden_shapes(spark, tmp_path):
    raw = spark.createDataFrame([("Mill", 9, 90, "2025-01-01T00:00:00Z", GOLDEN)], "title string, page_id bigint, revision_id bigint, timestamp string, text string")
    blocks = written(layer1.parse_pages(raw), "test")
    page = layer1.typed_pages(blocks).first()
    assert (page["page_type"], page["page_type_evidence"], [tuple(i) for i in page["interwiki"]]) == ("television_series", ["category: cancelled shows"], [("wikipedia", "en", "Mill", None)])
    assert (page["error_nodes"], page["unassigned_lines"], page["bytes"], page["source_lines"], [t["name"] for t in page["templates"]]) == (0, 0, len(GOLDEN.encode()), 23, ["italic title", "wikipedia"])
    lead = blocks.where("block_type = 'paragraph' and section_ord = 0").first()["rt"]
    assert lead["text"] == "By Zed, see the mill." and [(s["kind"], s["site"], s["title"], s["url"], s["name"]) for s in lead["spans"]] == [("link", "wikipedia", "Carl Zed", None, None), ("template", None, None, None, "w"), ("external_link", None, None, "https://mill.example/a", None)]
    media = blocks.where("block_type = 'media'").first()["media"]
    assert (media["file"], media["caption_attribution"]) == ("File:Mill.jpg", "Ann B")
    got = {r["text"]: r for r in layer2.quotes(blocks).collect()}
    assert set(got) == {"Lead saying of Mill", "Hold on", "I do", "Late", "[the mill turns]\nBob: Hold on\nEve: I do", "Grind on", "La la chanson"}
    s = got["Lead saying of Mill"]["source"]
    assert (s["locator_act_scene"], s["locator_line"], s["work_link_site"], s["work_link_title"], s["work_title"]) == ("Act III, sc. 2", "lines 4-9", "wikisource", "The Mill", "The Mill")
    s = got["Hold on"]["source"]
    assert (s["episode_series"], s["episode_season"], s["episode_number"], s["episode_title"], got["Hold on"]["speaker"]["played_by"], got["Hold on"]["speaker"]["link_title"]) == ("Mill", 2, "2.05", "Dusk", "Old Dan", "Bob")
    assert got["Grind on"]["kind"] == "tagline" and got["La la chanson"]["kind"] == "lyric" and got["La la chanson"]["language"] == "fr"
    assert [(t["text"], t["is_original"]) for t in got["La la chanson"]["translations"]] == [("a song", False)] and [(a["kind"], a["text"]) for a in got["La la chanson"]["annotations"]] == [("translation", "Translation: a song")]
    # as a nested document and back
    (line,) = documents.documents(blocks).collect()
    d = json.loads(line["value"])
    assert list(d) == ["wiki_language", "title", "page_id", "revision_id", "timestamp", "page_type", "page_type_evidence", "categories", "templates", "interwiki", "lead", "sections", "parse"]
    assert [b["block"] for b in d["lead"]] == ["template", "template", "media", "paragraph", "quote"] and d["lead"][4]["annotations"][0]["kind"] == "citation"
    dusk = d["sections"][0]["sections"][0]
    assert (d["sections"][0]["role"], d["sections"][0]["source_hint"], dusk["role"], dusk["source_hint"]) == ({"role": "episodes"}, {"hint": "season", "number": 2}, {"role": "other", "value": "Dusk [2.05]"}, {"hint": "episode", "title": "Dusk", "code": "2.05"})
    assert [b["block"] for b in dusk["blocks"]] == ["exchange", "rule", "exchange"] and "speaker" not in dusk["blocks"][0]["turns"][0] and "sections" not in dusk
    assert d["sections"][3]["blocks"][0]["block"] == "item" and d["sections"][3]["blocks"][0]["spans"][0]["target"] == {"site": "wikiquote", "lang": "en", "title": "Other page"}
    (tmp_path / "d.jsonl").write_text(line["value"] + "\n\n")
    back = documents.read_documents(spark, str(tmp_path / "d.jsonl"))
    shown = lambda df: sorted(repr(r.asDict(True)) for r in df.collect())
    assert shown(back) == shown(blocks)
    # identifiers against another implementation of the hash
    jvm = spark.sparkContext._jvm.org.apache.commons.codec.digest.Blake3
    want = lambda t: bytes(jvm.hash(t.encode()))[:8].hex()
    assert got["I do"]["content_hash"] == want("i do") and got["I do"]["id"] == want("Mill\nSeason Two/Dusk [2.05]\n3") and got["Lead saying of Mill"]["id"] == want("Mill\n\n4")


def test_documents_as_others_write_them(spark, tmp_path):
    # fields left out, null or in another order; texts and sites of two shapes; null blocks keep their position; redirects have no blocks
    lines = [
        {"sections": [{"blocks": [None, {"text": {"text": "Said", "wikitext": "Said"}, "block": "quote", "annotations": None}], "heading": "Plain", "level": 2, "sections": None}], "title": "A", "page_id": 1, "revision_id": 2},
        {"title": "B", "page_id": 3, "revision_id": 4, "redirect_to": {"site": {"other": "b"}, "lang": "en", "title": "A"}, "lead": [{"block": "rule"}]},
        {"title": "C", "page_id": 5, "revision_id": 6, "lead": [{"block": "paragraph", "text": "x y", "wikitext": "x [[b:y|y]]", "spans": [{"span": "link", "end": 3, "start": 2, "target": {"site": {"other": "b"}, "lang": "en", "title": "y"}}]}]},
    ]
    (tmp_path / "d.jsonl").write_text("\n".join(json.dumps(x) for x in lines))
    got = documents.read_documents(spark, str(tmp_path / "d.jsonl"))
    assert [(r["title"], r["block_type"], r["section_ord"], r["block_index"], r["rt"] and r["rt"]["text"]) for r in got.orderBy("title", "section_ord", F.col("block_type") != "section").collect()] == [
        ("A", "page", -1, -1, None), ("A", "section", 1, 0, None), ("A", "list_item", 1, 1, "Said"), ("B", "page", -1, -1, None), ("C", "page", -1, -1, None), ("C", "paragraph", 0, 0, "x y"),
    ]
    span = got.where("block_type = 'paragraph'").first()["rt"]["spans"][0]
    assert (span["site"], span["shown"]) == ("b", "y") and got.where("block_type = 'section'").first()["path"][0]["text"] == "Plain"
    (tmp_path / "bad.jsonl").write_text("{")
    with pytest.raises(Exception):
        documents.read_documents(spark, str(tmp_path / "bad.jsonl")).collect()
    (tmp_path / "none.jsonl").write_text("")
    assert documents.read_documents(spark, str(tmp_path / "none.jsonl")).count() == 0 and documents.documents(got.limit(0)).count() == 0
