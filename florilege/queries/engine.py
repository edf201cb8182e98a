"""Queries of the quotation engine. Where the tables hold no wiki markup, pages are written from their rows, read by the
engine and compared with the rows themselves; each query runs over whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from florilege import schema
from florilege.functions import citation, rules
from florilege.functions.hashing import content_key, hash16
from florilege.functions.text import collapse_ws
from florilege.plans import layer1, layer2, report
from florilege.session import shared_path, spread_few, table, written
from florilege.sources import dump, files


def _pages(rows: DataFrame, key: str, line: Column, head: str | Column, order: str, tail: str = "") -> DataFrame:
    """A page for each key: a head, the rows' lines in order, a tail."""
    lines = F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), line.alias("t")))), lambda x: x["t"])
    first = F.lit(head) if isinstance(head, str) else F.max(head)
    grouped = rows.groupBy(key).agg(F.concat(first, F.array_join(lines, "\n"), F.lit(tail)).alias("text"))
    return grouped.select(F.concat(F.lit("Page "), F.col(key).cast("string")).alias("title"), F.col(key).alias("page_id"), F.lit(1).alias("revision_id"), F.lit("2025-01-01T00:00:00Z").alias("timestamp"), "text")


def _quotes(pages: DataFrame) -> DataFrame:
    return layer2.quotes(written(layer1.parse_pages(pages, evenly=True), "blocks"))


def _dialogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    line = F.format_string(":'''%s''': order %d", "o_orderpriority", "o_orderkey")
    return _quotes(_pages(orders, "o_custkey", line, "== Dialogue ==\n", "o_orderkey"))


def dialogue_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dialogue(spark, sf_dir).where("kind = 'dialogue_turn'").select("page_id", F.col("speaker.name").alias("speaker"), F.col("speaker.kind").alias("speaker_kind"), "text", "wikitext", F.col("provenance.speaker_from").alias("speaker_from"))


def dialogue_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dialogue(spark, sf_dir).where("kind = 'dialogue'").select("page_id", "text", "status")


def quote_with_citation_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    line = F.concat(
        F.format_string("=== %s ===\n* Order %d\n** ''%s'' (", F.date_format("o_orderdate", "yyyy"), "o_orderkey", "o_orderpriority"), F.date_format("o_orderdate", "d MMMM yyyy"), F.format_string("), p. %d", F.col("o_orderkey") % 300 + 1)
    )
    q = _quotes(_pages(orders, "o_custkey", line, "== Quotes ==\n", "o_orderkey"))
    s = F.col("source")
    return q.select("page_id", "text", "status", s["work_title"].alias("work_title"), s["date_iso"].alias("date_iso"), s["date_precision"].alias("date_precision"), s["date_raw"].alias("date_raw"), s["locator_page"].alias("locator_page"), F.col("provenance.source_from").alias("source_from"), F.size(s["parts"]).alias("n_parts"), s["raw"].alias("raw"))


def heading_period_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    line = F.concat(F.lit("=== "), F.substring(F.date_format("o_orderdate", "yyyy"), 1, 3), F.format_string("0s ===\n* Order %d", "o_orderkey"))
    q = _quotes(_pages(orders, "o_custkey", line, "", "o_orderkey"))
    s = F.col("source")
    return q.select("page_id", "text", s["date_iso"].alias("date_iso"), s["date_end_iso"].alias("date_end_iso"), s["date_precision"].alias("date_precision"), F.col("provenance.source_from").alias("source_from"))


def _headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "quotes").select(F.explode("context_path").alias("heading")).where("heading is not null")


def section_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = _headings(spark, sf_dir).groupBy("heading").agg(F.count("*").alias("n"))
    return counted.select("heading", rules.role_of(F.col("heading")).alias("role"), "n")


def source_hints(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_name")
    made = F.array(
        F.format_string("Season %d", "p_size"), F.format_string("Chapter %d", "p_size"), F.format_string("%s (%d)", "p_name", F.col("p_size") + 1900), F.format_string("Act %s", F.element_at(F.array(*map(F.lit, ("i", "ii", "iv"))), (F.col("p_size") % 3 + 1).cast("int"))),
        F.format_string("%s [%d.%d]", "p_name", F.col("p_size") % 9, "p_size"), F.format_string("Episode %d", "p_size"), F.format_string("%d-%d", F.col("p_size") + 1800, F.col("p_size") + 1810), F.format_string("Part of %s", "p_name"),
    )
    h = parts.select("p_partkey", F.posexplode(made).alias("form", "heading")).withColumn("h", rules.source_hint(F.col("heading"), F.lit(False)))
    return h.select("p_partkey", "form", F.col("h.kind").alias("kind"), F.col("h.title").alias("title"), F.col("h.year").alias("year"), F.col("h.number").alias("number"), F.col("h.code").alias("code"), F.col("h.from").alias("period_from"), F.col("h.to").alias("period_to"), F.col("h.place").alias("place"))


def page_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "wiki_pages")
    none = F.array().cast(f"array<{schema.TEMPLATE}>")
    named = F.transform(F.filter(F.coalesce("templates", none), lambda t: t.isNotNull()), lambda t: F.struct(F.lower(t["name"]).alias("name"), t["params"].alias("params"), t["wikitext"].alias("wikitext")))
    kind = rules.page_type(F.filter(F.coalesce("categories", F.array().cast("array<string>")), lambda c: c.isNotNull()), named, F.col("title"))
    return pages.select("page_id", "revision_id", "load_no", kind["page_type"].alias("page_type"), F.get(kind["evidence"], 0).alias("evidence"))


def cast_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier, part = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "part")
    n = supplier.count()
    # a film for each supplier; its cast are the parts of its number, whose brands play them; every part speaks
    rows = part.withColumn("film", (F.col("p_partkey") % n) + 1)
    cast_line = F.concat(F.lit("* "), F.col("p_brand"), F.lit(" as Part "), (F.col("p_partkey") - F.col("p_partkey") % 2).cast("string"))
    turn = F.concat(F.lit(":'''Part "), F.col("p_partkey").cast("string"), F.lit("''': "), F.col("p_name"))
    lines = lambda c: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col("p_partkey").alias("o"), c.alias("t")))), lambda x: x["t"]), "\n")
    pages = rows.groupBy("film").agg(F.concat(F.lit("== Dialogue ==\n"), lines(turn), F.lit("\n\n== Cast ==\n"), lines(cast_line), F.lit("\n\n[[Category:2020 films]]")).alias("text"))
    pages = pages.select(F.concat(F.lit("Film "), F.col("film").cast("string")).alias("title"), F.col("film").alias("page_id"), F.lit(1).alias("revision_id"), F.lit("2025-01-01T00:00:00Z").alias("timestamp"), "text")
    q = _quotes(pages).where("kind = 'dialogue_turn'")
    return q.select("page_id", F.col("speaker.name").alias("speaker"), F.col("speaker.played_by").alias("played_by"), "text", "page_type", F.col("source.work_type").alias("work_type"))


def status_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    head = F.when(F.col("o_orderstatus") == "F", "Disputed").when(F.col("o_orderstatus") == "O", "Attributed to him").otherwise("Quotes")
    note = F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("\n** Letter ("), F.date_format("o_orderdate", "yyyy"), F.lit(")"))).otherwise("")
    line = F.concat(F.lit("== "), head, F.lit(" ==\n=== A ===\n* Order "), F.col("o_orderkey").cast("string"), note)
    q = _quotes(_pages(orders, "o_custkey", line, "", "o_orderkey"))
    return q.select("page_id", "text", "status", F.col("provenance.status_from").alias("status_from"), F.col("source.occasion").alias("occasion"), F.col("source.complete").alias("complete"))


def speaker_about(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    category = F.when(F.col("c_custkey") % 3 == 0, "1950 births").when(F.col("c_custkey") % 3 == 1, "Themes").otherwise("Novels")
    about = F.when(F.col("c_custkey") % 2 == 0, "Quotes about").otherwise("Quotes")
    line = F.concat(F.lit("== "), about, F.lit(" ==\n* Said of "), F.col("c_mktsegment"), F.lit("\n** [[Writer "), F.col("c_nationkey").cast("string"), F.lit("]], ''Works''\n\n[[Category:"), category, F.lit("]]"))
    q = _quotes(_pages(customers, "c_custkey", line, "", "c_custkey"))
    return q.select("page_id", "page_type", "text", F.col("speaker.name").alias("speaker"), F.col("speaker.kind").alias("speaker_kind"), F.col("provenance.speaker_from").alias("speaker_from"), F.size("about").alias("n_about"), F.get("about", 0)["kind"].alias("about_kind"), F.col("source.work_title").alias("work_title"))


def cite_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    call = F.format_string("{{cite book|title=%s|publisher = %s |year=%d|first=Ann|last=%s}}", "p_name", "p_brand", F.col("p_size") + 1900, F.regexp_replace("p_type", " ", "_"))
    q = _quotes(_pages(part, "p_partkey", F.concat(F.lit("== Quotes ==\n* Part "), F.col("p_partkey").cast("string"), F.lit("\n** "), call), "", "p_partkey"))
    s = F.col("source")
    return q.select("page_id", s["work_title"].alias("work_title"), s["work_type"].alias("work_type"), s["publisher"].alias("publisher"), s["date_iso"].alias("date_iso"), F.col("speaker.name").alias("speaker"), F.size(F.get(s["cite_templates"], 0)["params"]).alias("n_params"))


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    line = F.concat(F.lit("* See [[w:de:Land "), F.col("c_nationkey").cast("string"), F.lit("#Seg "), F.col("c_mktsegment"), F.lit("|"), F.col("c_name"), F.lit("]] and [[Plain_page]]"))
    q = _quotes(_pages(customers, "c_custkey", line, "== Quotes ==\n", "c_custkey")).select("page_id", "text", F.posexplode("links").alias("pos", "l"))
    return q.select("page_id", "text", "pos", F.col("l.site").alias("site"), F.col("l.lang").alias("lang"), F.col("l.title").alias("title"), F.col("l.fragment").alias("fragment"))


def redirects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as an XML export, written and read again: content pages of even keys, redirects of odd ones."""
    orders = table(spark, sf_dir, "orders")
    page = orders.select(
        F.concat(F.lit("Order "), F.col("o_orderkey").cast("string")).alias("title"), F.when(F.col("o_orderkey") % 5 == 0, "1").otherwise("0").alias("ns"), F.col("o_orderkey").cast("string").alias("id"),
        F.when(F.col("o_orderkey") % 2 == 1, F.struct(F.concat(F.lit("Customer "), F.col("o_custkey").cast("string")).alias("_title"))).alias("redirect"),
        F.struct((F.col("o_orderkey") + 7).cast("string").alias("id"), F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"), F.concat(F.lit("* a & b <ref>"), F.col("o_orderpriority"), F.lit("</ref>")).alias("text")).alias("revision"),
    )
    path = shared_path(spark, "xml")
    page.write.format("xml").option("rowTag", "page").option("rootTag", "mediawiki").save(path)
    found = dump.read_dump(spark, path)
    both = dump.redirects(found).select("from", "to", F.lit(None).cast("string").alias("text")).unionByName(dump.content(found).select(F.col("title").alias("from"), F.lit(None).cast("string").alias("to"), "text"))
    return both.select(F.col("from").alias("title"), F.col("to").alias("redirect_to"), "text")


def isbn_locators_occasion(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    what = F.when(F.col("l_returnflag") == "R", "Letter to the editor").when(F.col("l_returnflag") == "A", "Press conference").otherwise("Notes")
    text = F.concat(what, F.format_string(", vol. %d, ch. %d, pp. %d–%d, lines %d-%d, ISBN %09d. Retrieved 1 May 2020", "l_linenumber", F.col("l_orderkey") % 40 + 1, F.col("l_partkey") % 90 + 1, F.col("l_partkey") % 90 + 9, "l_linenumber", F.col("l_linenumber") + 3, F.col("l_suppkey") + 100000000))
    c = F.col("t")
    made = spread_few(li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag")).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", text.alias("t"))
    return made.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", citation.locator(c, citation.PART).alias("part"), citation.locator(c, citation.CHAPTER).alias("chapter"), citation.locator(c, citation.PAGE).alias("page"), citation.locator(c, citation.LINE).alias("line"),
        citation.isbn(c).alias("isbn"), citation.read_occasion(c).alias("occasion"), citation.read_date(citation.before_retrieval(c))["iso"].alias("date_iso"),
    )


def content_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of one content hash, as the engine works it out, shown by the digest of their normalised text."""
    q = table(spark, sf_dir, "quotes").where("text is not null").select("id", F.md5(F.lower(collapse_ws(F.col("text")))).alias("k"), hash16(content_key(F.col("text"))).alias("content_hash"))
    return q.groupBy("content_hash").agg(F.min("k").alias("content_key"), F.count("*").alias("n_rows"), F.count_distinct("id").alias("n_ids")).where("n_rows > 1").drop("content_hash")


def report_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.coverage(table(spark, sf_dir, "quotes"))


def report_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = table(spark, sf_dir, "quotes")
    one = lambda c: report.counts_by(q, c).select(F.lit(c).alias("what"), F.col(c).alias("value"), "n")
    return one("kind").unionByName(one("status")).unionByName(one("page_type"))


def top_headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = _headings(spark, sf_dir).where((rules.role_of(F.col("heading")) == "other") & (F.col("heading") != ""))
    return report.top_headings(h.groupBy("heading").agg(F.count("*").alias("sections")))


def line_islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").where("text is not null")
    lines = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line", "t")).where(F.col("t").startswith("*"))
    lines = lines.withColumn("depth", F.length(F.regexp_extract("t", r"^\*+", 0)))
    found = layer2.ordered_islands(lines, "doc_id", "line", "depth")
    return found.groupBy("doc_id", "item").agg(F.count("*").alias("n_lines"), F.max("depth").alias("max_depth"), F.min("line").alias("first_line"))


def redirect_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "wiki_pages")
    links_ = pages.where("redirect_to is not null and title is not null").select(F.col("title").alias("from"), F.col("redirect_to.title").alias("to")).distinct()
    titles = table(spark, sf_dir, "quotes").where("page_title is not null").groupBy("page_title").agg(F.count("*").alias("n"))
    return dump.resolve(titles, "page_title", links_)


def parquet_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = table(spark, sf_dir, "quotes").select(*("id", "content_hash", "wiki_language", "page_title", "page_id", "page_type", "revision_id", "text", "wikitext", "language", "language_from", "kind", "status", "speaker", "about", "source", "context_path", "annotations", "translations", "links", "provenance"))
    path = shared_path(spark, "quotes")
    files.write_quotes(q, path)
    back = files.read_quotes(spark, path)
    return back.select("id", "page_title", F.col("speaker.name").alias("speaker"), F.col("source.date_iso").alias("date_iso"), F.size("annotations").alias("n_annotations"), F.md5("text").alias("text_md5"))


def json_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "agents").drop("loaded_at")
    path = shared_path(spark, "agents")
    files.write_json_lines(a, path)
    return files.read_json_lines(spark, path, "agent_id bigint, page_id bigint, name string, kind string, link_site string, link_lang string, link_title string, played_by string, load_no int")


def document_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents through the whole engine: markup to blocks to quotes."""
    docs = table(spark, sf_dir, "documents").select(F.coalesce("page_title", F.lit("")).alias("title"), F.col("doc_id").alias("page_id"), F.lit(1).alias("revision_id"), F.col("fetched_at").cast("string").alias("timestamp"), "text")
    return _quotes(docs)


def document_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.coalesce("page_title", F.lit("")).alias("title"), F.col("doc_id").alias("page_id"), F.lit(1).alias("revision_id"), F.col("fetched_at").cast("string").alias("timestamp"), "text")
    return layer1.parse_pages(docs, evenly=True).groupBy("page_id", "block_type").agg(F.count("*").alias("n"), F.sum("error_nodes").alias("error_nodes"))


def document_headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report's headings over all documents: sections whose heading means neither a role nor a hint."""
    docs = table(spark, sf_dir, "documents").select(F.coalesce("page_title", F.lit("")).alias("title"), F.col("doc_id").alias("page_id"), F.lit(1).alias("revision_id"), F.col("fetched_at").cast("string").alias("timestamp"), "text")
    return report.top_headings(report.headings(layer1.parse_pages(docs, evenly=True)))


def document_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report's page side over all documents: a row per page type, and one over all (page_type null, ``overall`` 1)."""
    docs = table(spark, sf_dir, "documents").select(F.coalesce("page_title", F.lit("")).alias("title"), F.col("doc_id").alias("page_id"), F.lit(1).alias("revision_id"), F.col("fetched_at").cast("string").alias("timestamp"), "text")
    pages = written(layer1.typed_pages(layer1.parse_pages(docs, evenly=True)), "pages")
    over_all = report.parse_totals(pages)
    by_type = report.counts_by(pages, "page_type").select(F.lit(0).alias("overall"), "page_type", F.col("n").alias("pages"))
    return by_type.unionByName(over_all.select(F.lit(1).alias("overall"), F.lit(None).cast("string").alias("page_type"), "*"), allowMissingColumns=True)


def entity_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    line = F.concat(F.lit("* "), F.col("c_mktsegment"), F.lit(" &amp; &#65;&#x42; &nosuch; <small>small</small><br/>next<!-- gone --><ref>note</ref> <nowiki>''raw''</nowiki> {{nbsp}}{{lang|fr|mot "), F.col("c_nationkey").cast("string"), F.lit("}}"))
    return _quotes(_pages(c, "c_custkey", line, "== Quotes ==\n", "c_custkey")).select("page_id", "text", "language", "language_from")


def interwiki(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sister-project links of the pages' templates."""
    none = F.array().cast(f"array<{schema.TEMPLATE}>")
    pages = table(spark, sf_dir, "wiki_pages").where("title is not null")
    named = F.transform(F.filter(F.coalesce("templates", none), lambda t: t.isNotNull()), lambda t: F.struct(F.lower(t["name"]).alias("name"), F.coalesce(t["params"], F.array().cast(schema.PARAMS)).alias("params"), t["wikitext"].alias("wikitext")))
    found = pages.select("page_id", "revision_id", "load_no", F.explode(rules.interwiki_of(named, F.col("title"))).alias("i"))
    return found.groupBy("page_id", "revision_id", "i.site", F.col("i.title").alias("target")).agg(F.count("*").alias("n"))


def occasions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The occasion that each typed citation names, over all distinct occasions."""
    o = table(spark, sf_dir, "sources").where("occasion is not null").groupBy("occasion").agg(F.count("*").alias("n"))
    return o.select("occasion", "n", citation.read_occasion(F.col("occasion")).alias("kind"))


QUERIES = {
    f.__name__: f
    for f in (
        dialogue_turns, dialogue_joined, quote_with_citation_date, heading_period_only, section_roles, source_hints, page_types, cast_join, status_matrix, speaker_about, cite_templates, links, redirects,
        isbn_locators_occasion, content_groups, report_coverage, report_counts, top_headings, line_islands, redirect_titles, parquet_round_trip, json_round_trip, document_quotes, document_blocks, document_headings, document_totals, entity_decode, interwiki, occasions,
    )
}

_ROLE = """CASE
    WHEN contains(h, 'misattributed') THEN 'misattributed' WHEN contains(h, 'disputed') THEN 'disputed'
    WHEN contains(h, 'unsourced') OR h = 'suggestions' THEN 'unsourced' WHEN starts_with(h, 'attributed') THEN 'attributed'
    WHEN starts_with(h, 'quotes about') OR h = 'about' OR starts_with(h, 'about ') THEN 'quotes_about'
    WHEN h IN ('quotes', 'quote', 'quotations', 'sourced', 'sourced quotes') THEN 'quotes'
    WHEN h IN ('dialogue', 'dialogues', 'dialog', 'dialogs') THEN 'dialogue' WHEN contains(h, 'tagline') THEN 'taglines'
    WHEN h IN ('song lyrics', 'lyrics', 'songs') THEN 'song_lyrics' WHEN ends_with(h, 'cast') OR h = 'cast members' THEN 'cast'
    WHEN h IN ('episodes', 'seasons') OR regexp_full_match(h, '(season|series) ([0-9]+|one|two|three|four|five|six|seven|eight|nine|ten|eleven|twelve)') THEN 'episodes'
    WHEN h IN ('see also', 'related') THEN 'see_also' WHEN starts_with(h, 'external link') OR starts_with(h, 'other project') THEN 'external_links'
    WHEN h IN ('references', 'notes', 'footnotes', 'citations') THEN 'references' WHEN regexp_full_match(trim(heading), '[\\pL\\pN]') THEN 'alpha_bucket'
    ELSE 'other' END"""
_HEADINGS = "SELECT unnest(context_path) AS heading FROM quotes"

SQL = {
    "interwiki": """
        WITH t AS (SELECT page_id, revision_id, title, unnest(templates) AS t FROM wiki_pages WHERE title IS NOT NULL),
        s AS (SELECT *, lower(t.name) AS name, list_filter(coalesce(t.params, []), lambda p: p.key = '1')[1].value AS one FROM t WHERE t IS NOT NULL),
        k AS (SELECT *, CASE WHEN name IN ('wikipedia', 'wikipediapar') THEN 'wikipedia' WHEN name IN ('wikisource', 'wikisource author') THEN 'wikisource' WHEN name = 'wiktionary' THEN 'wiktionary'
                WHEN name IN ('commons', 'commonscat', 'commons category', 'commons cat') THEN 'commons' END AS site FROM s)
        SELECT page_id, revision_id, site, coalesce(nullif(one, ''), title) AS target, count(*) AS n FROM k WHERE site IS NOT NULL GROUP BY ALL""",
    "occasions": """
        SELECT occasion, count(*) AS n, CASE WHEN contains(l, 'press conference') OR contains(l, 'news conference') THEN 'press conference' WHEN contains(l, 'address to') OR contains(l, 'address at') THEN 'speech'
          WHEN contains(l, 'blog post') OR contains(l, 'facebook post') THEN 'post' WHEN regexp_matches(l, '(^|[^\\pL\\pN])letters?($|[^\\pL\\pN])') THEN 'letter'
          WHEN regexp_matches(l, '(^|[^\\pL\\pN])interview($|[^\\pL\\pN])') THEN 'interview' WHEN regexp_matches(l, '(^|[^\\pL\\pN])speech($|[^\\pL\\pN])') THEN 'speech' WHEN regexp_matches(l, '(^|[^\\pL\\pN])lecture($|[^\\pL\\pN])') THEN 'lecture'
          WHEN regexp_matches(l, '(^|[^\\pL\\pN])sermon($|[^\\pL\\pN])') THEN 'sermon' WHEN regexp_matches(l, '(^|[^\\pL\\pN])testimony($|[^\\pL\\pN])') THEN 'testimony' WHEN regexp_matches(l, '(^|[^\\pL\\pN])diary($|[^\\pL\\pN])') THEN 'diary'
          WHEN regexp_matches(l, '(^|[^\\pL\\pN])essay($|[^\\pL\\pN])') THEN 'essay' WHEN regexp_matches(l, '(^|[^\\pL\\pN])editorial($|[^\\pL\\pN])') THEN 'editorial' WHEN regexp_matches(l, '(^|[^\\pL\\pN])tweet($|[^\\pL\\pN])') THEN 'post' END AS kind
        FROM (SELECT occasion, lower(occasion) AS l FROM sources WHERE occasion IS NOT NULL) GROUP BY ALL""",
    "dialogue_turns": """
        SELECT o_custkey AS page_id, o_orderpriority AS speaker, 'character' AS speaker_kind, 'order ' || o_orderkey AS text,
               '''''''' || o_orderpriority || ''''''': order ' || o_orderkey AS wikitext, 'dialogue_marker' AS speaker_from FROM orders""",
    "dialogue_joined": """
        SELECT o_custkey AS page_id, string_agg(o_orderpriority || ': order ' || o_orderkey, chr(10) ORDER BY o_orderkey) AS text, 'unsourced' AS status
        FROM orders GROUP BY o_custkey HAVING count(*) > 1""",
    "quote_with_citation_date": """
        SELECT o_custkey AS page_id, 'Order ' || o_orderkey AS text, 'sourced' AS status, o_orderpriority AS work_title, strftime(o_orderdate, '%Y-%m-%d') AS date_iso, 'day' AS date_precision,
               strftime(o_orderdate, '%-d %B %Y') AS date_raw, 'p. ' || (o_orderkey % 300 + 1) AS locator_page, 'mixed' AS source_from, 2 AS n_parts,
               strftime(o_orderdate, '%Y') || ' — ''''' || o_orderpriority || ''''' (' || strftime(o_orderdate, '%-d %B %Y') || '), p. ' || (o_orderkey % 300 + 1) AS raw FROM orders""",
    "heading_period_only": """
        SELECT o_custkey AS page_id, 'Order ' || o_orderkey AS text, (year(o_orderdate) // 10 * 10)::varchar AS date_iso, (year(o_orderdate) // 10 * 10 + 9)::varchar AS date_end_iso, 'decade' AS date_precision, 'heading' AS source_from FROM orders""",
    "section_roles": f"""
        SELECT heading, {_ROLE} AS role, n FROM (SELECT heading, lower(trim(rtrim(trim(heading), ':'))) AS h, count(*) AS n FROM ({_HEADINGS}) WHERE heading IS NOT NULL GROUP BY heading)""",
    "source_hints": """
        SELECT p_partkey, form, kind, title, year, number, code, period_from, period_to, place FROM (
          SELECT p_partkey, 0 AS form, 'season' AS kind, NULL AS title, NULL::int AS year, p_size AS number, NULL AS code, NULL::int AS period_from, NULL::int AS period_to, NULL AS place FROM part
          UNION ALL SELECT p_partkey, 1, 'locator', NULL, NULL, NULL, NULL, NULL, NULL, 'chapter' FROM part
          UNION ALL SELECT p_partkey, 2, 'work', trim(p_name), p_size + 1900, NULL, NULL, NULL, NULL, NULL FROM part
          UNION ALL SELECT p_partkey, 3, 'locator', NULL, NULL, NULL, NULL, NULL, NULL, 'act_scene' FROM part
          UNION ALL SELECT p_partkey, 4, 'episode', trim(p_name), NULL, NULL, (p_size % 9) || '.' || p_size, NULL, NULL, NULL FROM part
          UNION ALL SELECT p_partkey, 5, 'episode', NULL, NULL, NULL, p_size::varchar, NULL, NULL, NULL FROM part
          UNION ALL SELECT p_partkey, 6, 'period', NULL, NULL, NULL, NULL, p_size + 1800, p_size + 1810, NULL FROM part
          UNION ALL SELECT p_partkey, 7, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM part)""",
    "page_types": """
        WITH p AS (SELECT page_id, revision_id, load_no, title, list_transform(list_filter(coalesce(categories, []), lambda c: c IS NOT NULL), lambda c: lower(c)) AS c,
                     list_transform(list_filter(coalesce(templates, []), lambda t: t IS NOT NULL), lambda t: lower(t.name)) AS t FROM wiki_pages),
        f AS (SELECT *, list_filter(t, lambda n: n IN ('disambig', 'disambiguation', 'hndis'))[1] AS r1, list_filter(t, lambda n: n = 'year page placeholder')[1] AS r2,
                list_filter(c, lambda x: x = 'living people' OR x LIKE '% births' OR x LIKE '% deaths')[1] AS r3, list_filter(c, lambda x: x LIKE '% seasons')[1] AS r4,
                list_filter(c, lambda x: x LIKE '% film' OR x LIKE '% films')[1] AS r5,
                list_filter(c, lambda x: x = 'cancelled shows' OR contains(x, 'television series') OR contains(x, 'television programs') OR contains(x, 'web series') OR contains(x, 'anime'))[1] AS r6,
                list_filter(c, lambda x: contains(x, 'video games'))[1] AS r7, list_filter(c, lambda x: x LIKE '% songs' OR x LIKE '% albums')[1] AS r8,
                list_filter(c, lambda x: starts_with(x, 'works by') OR regexp_matches(x, '(^|\\s)(novels|books|plays|poems|essays|stories|works)\\s*$'))[1] AS r9,
                list_filter(c, lambda x: contains(x, 'proverbs'))[1] AS r10, list_filter(c, lambda x: x IN ('themes', 'virtues', 'emotions'))[1] AS r11,
                CASE WHEN starts_with(lower(title), 'list of') OR starts_with(lower(title), 'lists of') THEN title END AS r12 FROM p)
        SELECT page_id, revision_id, load_no,
          CASE WHEN r1 IS NOT NULL THEN 'disambiguation' WHEN r2 IS NOT NULL THEN 'placeholder' WHEN r3 IS NOT NULL THEN 'person' WHEN r4 IS NOT NULL THEN 'television_season' WHEN r5 IS NOT NULL THEN 'film'
            WHEN r6 IS NOT NULL THEN 'television_series' WHEN r7 IS NOT NULL THEN 'video_game' WHEN r8 IS NOT NULL THEN 'musical_work' WHEN r9 IS NOT NULL THEN 'literary_work' WHEN r10 IS NOT NULL THEN 'proverbs'
            WHEN r11 IS NOT NULL THEN 'theme' WHEN r12 IS NOT NULL THEN 'list' ELSE 'unknown' END AS page_type,
          coalesce('template: ' || r1, 'template: ' || r2, 'category: ' || r3, 'category: ' || r4, 'category: ' || r5, 'category: ' || r6, 'category: ' || r7, 'category: ' || r8, 'category: ' || r9, 'category: ' || r10, 'category: ' || r11, 'title: ' || r12) AS evidence FROM f""",
    "cast_join": """
        WITH p AS (SELECT *, p_partkey % (SELECT count(*) FROM supplier) + 1 AS film, p_partkey - p_partkey % 2 AS played FROM part),
        cast_of AS (SELECT film, played, max_by(p_brand, p_partkey) AS actor FROM p GROUP BY film, played)
        SELECT p.film AS page_id, 'Part ' || p_partkey AS speaker, actor AS played_by, trim(p_name) AS text, 'film' AS page_type, 'film' AS work_type
        FROM p LEFT JOIN cast_of ON cast_of.film = p.film AND cast_of.played = p.p_partkey""",
    "status_matrix": """
        SELECT o_custkey AS page_id, 'Order ' || o_orderkey AS text,
          CASE WHEN o_orderstatus = 'F' THEN 'disputed' WHEN o_orderstatus = 'O' THEN 'attributed' WHEN o_orderkey % 2 = 0 THEN 'sourced' ELSE 'unsourced' END AS status,
          CASE WHEN o_orderstatus IN ('F', 'O') THEN 'section_role' ELSE 'citation_presence' END AS status_from,
          CASE WHEN o_orderkey % 2 = 0 THEN 'letter' END AS occasion, CASE WHEN o_orderkey % 2 = 0 THEN true END AS complete FROM orders""",
    "speaker_about": """
        SELECT c_custkey AS page_id, CASE c_custkey % 3 WHEN 0 THEN 'person' WHEN 1 THEN 'theme' ELSE 'literary_work' END AS page_type, 'Said of ' || c_mktsegment AS text,
          CASE WHEN c_custkey % 3 = 0 AND c_custkey % 2 = 1 THEN 'Page ' || c_custkey ELSE 'Writer ' || c_nationkey END AS speaker, 'person' AS speaker_kind,
          CASE WHEN c_custkey % 3 = 0 AND c_custkey % 2 = 1 THEN 'page_subject' ELSE 'annotation' END AS speaker_from,
          CASE WHEN c_custkey % 3 = 0 AND c_custkey % 2 = 1 THEN 0 ELSE 1 END AS n_about,
          CASE WHEN c_custkey % 3 = 0 AND c_custkey % 2 = 1 THEN NULL WHEN c_custkey % 3 = 0 THEN 'person' WHEN c_custkey % 3 = 1 THEN 'topic' ELSE 'work' END AS about_kind, 'Works' AS work_title FROM customer""",
    "cite_templates": """
        SELECT p_partkey AS page_id, trim(p_name) AS work_title, 'book' AS work_type, p_brand AS publisher, (p_size + 1900)::varchar AS date_iso, 'Ann ' || replace(p_type, ' ', '_') AS speaker, 5 AS n_params FROM part""",
    "links": """
        SELECT c_custkey AS page_id, 'See ' || c_name || ' and Plain_page' AS text, pos, CASE pos WHEN 0 THEN 'wikipedia' ELSE 'wikiquote' END AS site, CASE pos WHEN 0 THEN 'de' ELSE 'en' END AS lang,
          CASE pos WHEN 0 THEN 'Land ' || c_nationkey ELSE 'Plain_page' END AS title, CASE pos WHEN 0 THEN 'Seg ' || c_mktsegment END AS fragment FROM customer, (VALUES (0), (1)) AS v(pos)""",
    "redirects": """
        SELECT 'Order ' || o_orderkey AS title, CASE WHEN o_orderkey % 2 = 1 THEN 'Customer ' || o_custkey END AS redirect_to, CASE WHEN o_orderkey % 2 = 0 THEN '* a & b <ref>' || o_orderpriority || '</ref>' END AS text
        FROM orders WHERE o_orderkey % 5 <> 0""",
    "isbn_locators_occasion": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'vol. ' || l_linenumber AS part, 'ch. ' || (l_orderkey % 40 + 1) AS chapter, 'pp. ' || (l_partkey % 90 + 1) || '–' || (l_partkey % 90 + 9) AS page,
          'lines ' || l_linenumber || '-' || (l_linenumber + 3) AS line, (l_suppkey + 100000000)::varchar AS isbn,
          CASE l_returnflag WHEN 'R' THEN 'letter' WHEN 'A' THEN 'press conference' END AS occasion, NULL::varchar AS date_iso FROM lineitem""",
    "content_groups": """
        SELECT md5(lower(trim(regexp_replace(text, '[\\s\\x0b\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]+', ' ', 'g')))) AS content_key, count(*) AS n_rows, count(DISTINCT id) AS n_ids
        FROM quotes WHERE text IS NOT NULL GROUP BY 1 HAVING count(*) > 1""",
    "report_coverage": """
        WITH f AS (SELECT page_type, speaker.name IS NOT NULL AS a, source.raw IS NOT NULL AS b, coalesce(source.complete, false) AS c, source.work_title IS NOT NULL AS d, source.date_iso IS NOT NULL AS e,
                     coalesce(provenance.unparsed_annotations, 0) AS u FROM quotes),
        g AS (SELECT page_type, grouping(page_type)::int AS overall, count(*) AS quotes, count_if(a)::bigint AS with_speaker, count_if(b)::bigint AS with_source, count_if(c)::bigint AS complete, count_if(d)::bigint AS with_work,
                count_if(e)::bigint AS with_date, sum(u)::bigint AS unparsed_annotations FROM f GROUP BY GROUPING SETS ((page_type), ()))
        SELECT *, round(1000.0 * with_speaker / quotes) / 10 AS speaker_share, round(1000.0 * with_source / quotes) / 10 AS source_share, round(1000.0 * complete / quotes) / 10 AS complete_share,
          round(1000.0 * with_work / quotes) / 10 AS work_share, round(1000.0 * with_date / quotes) / 10 AS date_share FROM g""",
    "report_counts": """
        SELECT 'kind' AS what, kind AS value, count(*) AS n FROM quotes GROUP BY kind UNION ALL SELECT 'status', status, count(*) FROM quotes GROUP BY status
        UNION ALL SELECT 'page_type', page_type, count(*) FROM quotes GROUP BY page_type""",
    "top_headings": f"""
        SELECT heading, count(*) AS sections FROM (SELECT heading, lower(trim(rtrim(trim(heading), ':'))) AS h FROM ({_HEADINGS}) WHERE heading IS NOT NULL AND heading <> '') WHERE {_ROLE} = 'other'
        GROUP BY heading ORDER BY sections DESC, heading LIMIT 40""",
    "line_islands": """
        WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS t, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line FROM documents WHERE text IS NOT NULL),
        d AS (SELECT doc_id, line, length(regexp_extract(t, '^\\*+')) AS depth FROM l WHERE starts_with(t, '*')),
        i AS (SELECT *, sum(CASE WHEN depth <= 1 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY line ROWS UNBOUNDED PRECEDING)::bigint AS item FROM d)
        SELECT doc_id, item, count(*) AS n_lines, max(depth)::int AS max_depth, min(line)::int AS first_line FROM i GROUP BY doc_id, item""",
    "redirect_titles": """
        WITH r AS (SELECT title, min(redirect_to.title) AS t FROM wiki_pages WHERE redirect_to IS NOT NULL AND title IS NOT NULL GROUP BY title),
        q AS (SELECT page_title, count(*) AS n FROM quotes WHERE page_title IS NOT NULL GROUP BY page_title)
        SELECT q.page_title, q.n, coalesce(r.t, q.page_title) AS resolved FROM q LEFT JOIN r ON r.title = q.page_title""",
    "parquet_round_trip": """
        SELECT id, page_title, speaker.name AS speaker, source.date_iso AS date_iso, len(annotations)::int AS n_annotations, md5(text) AS text_md5 FROM quotes""",
    "json_round_trip": "SELECT agent_id, page_id, name, kind, link_site, link_lang, link_title, played_by, load_no FROM agents",
    "entity_decode": """
        SELECT c_custkey AS page_id, c_mktsegment || ' & AB &nosuch; small' || chr(10) || 'next ''''raw'''' ' || chr(160) || 'mot ' || c_nationkey AS text, 'fr' AS language, 'declared' AS language_from FROM customer""",
}
