"""Layer 2: blocks to one row per quote, as one relational plan."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from florilege import schema
from florilege.functions import citation as c
from florilege.functions import rules
from florilege.functions.hashing import content_key, hash16, quote_key
from florilege.functions.text import let, trim_u
from florilege.session import written


def _none() -> Column:
    return F.lit(None).cast("string")


#: Long expressions of a session, by application and name: they depend on column names only and are costly to put together.
_made: dict[tuple[str, str], Column] = {}


def _once(df: DataFrame, name: str, build: Callable[[], Column]) -> Column:
    key = (df.sparkSession.sparkContext.applicationId, name)
    if key not in _made:
        _made[key] = build()
    return _made[key]


def _heading_hint(p: Column) -> Column:
    return rules.source_hint(p["text"], p["wikitext"].startswith("''"))


def _reading(rt: Column) -> Column:
    """All that one part of a citation says, read once before the fold."""
    text = rt["text"]
    cites = F.filter(rt["spans"], c.is_cite)
    filled = lambda s, *keys: F.coalesce(*[c.filled(s, k) for k in keys])
    last = lambda values: F.try_element_at(F.filter(values, lambda v: v.isNotNull()), F.lit(-1))
    urls = F.transform(rt["spans"], lambda s: F.when(s["kind"] == "external_link", F.nullif(s["url"], F.lit(""))).when(c.is_cite(s), c.filled(s, "url")))
    isbns = F.transform(rt["spans"], lambda s: F.when(s["name"] == "isbn", c.param(s, "1")).when(c.is_cite(s), c.filled(s, "isbn")))
    dates = F.transform(cites, lambda s: c.read_date(filled(s, "date", "year")))
    return F.struct(
        c.first_italic(rt).alias("italic"),
        F.filter(rt["spans"], lambda s: (s["kind"] == "link") | c.is_cite(s)).alias("marks"),
        F.coalesce(c.read_date(let(text, c.before_retrieval)), last(dates)).alias("date"),
        c.locator(text, c.PAGE).alias("page"), c.locator(text, c.CHAPTER).alias("chapter"), c.locator(text, c.PART).alias("part"),
        c.locator(text, c.ACT).alias("act"), c.locator(text, c.LINE).alias("line"),
        F.coalesce(c.isbn(text), last(isbns)).alias("isbn"),
        last(urls).alias("url"),
        last(F.transform(cites, lambda s: filled(s, "journal", "work", "newspaper"))).alias("publication"),
        last(F.transform(cites, lambda s: c.filled(s, "publisher"))).alias("publisher"),
        last(F.transform(cites, lambda s: c.cite_work_type(s["name"]))).alias("work_type"),
        c.read_occasion(text).alias("occasion"),
        F.transform(cites, lambda s: F.struct(s["name"].alias("name"), s["params"].alias("params"))).alias("cites"),
    )


_FOLD = "struct<title:string,site:string,link:string,episode:string,series:string>"


def _is(x: Column, kind: str) -> Column:
    return F.coalesce(x["hint"]["kind"] == kind, F.lit(False))


def _titles(acc: Column, x: Column, on_work_page: Column) -> Column:
    """Titles and link after a part. Each step needs what was known before: the heading's own title, then italics, then links
    and templates in their order (a link is the work's if it leads to Wikisource or shows the title known by then)."""
    h, r = x["hint"], x["r"]
    title = F.when(_is(x, "work"), h["title"]).otherwise(acc["title"])
    episode = F.when(_is(x, "episode"), h["title"]).otherwise(acc["episode"])
    series = F.when(on_work_page & h.isNotNull() & episode.isNotNull(), title).otherwise(acc["series"])
    start = F.struct(F.coalesce(r["italic"], title).alias("title"), acc["site"].alias("site"), acc["link"].alias("link"), episode.alias("episode"), series.alias("series")).cast(_FOLD)

    def step(w: Column, s: Column) -> Column:
        own = (s["kind"] == "link") & ((s["site"] == "wikisource") | F.coalesce(trim_u(s["shown"]) == w["title"], F.lit(False)))
        return F.struct(
            F.coalesce(F.when(s["kind"] == "template", c.filled(s, "title")), w["title"]).alias("title"),
            F.when(own, s["site"]).otherwise(w["site"]).alias("site"),
            F.when(own, s["title"]).otherwise(w["link"]).alias("link"),
            w["episode"].alias("episode"), w["series"].alias("series"),
        ).cast(_FOLD)

    return F.aggregate(r["marks"], start, step)


_ACC = "struct<" + ",".join(f"{k}:{t}" for k, t in schema.SOURCE_FIELDS.items()) + f",cites:array<{schema.CITE}>>"


def _last(parts: Column, value: Callable[[Column], Column]) -> Column:
    """The value of the last part that has one."""
    return F.try_element_at(F.filter(F.transform(parts, value), lambda v: v.isNotNull()), F.lit(-1))


def _last_of(parts: Column, test: Callable[[Column], Column]) -> Column:
    return F.try_element_at(F.filter(parts, test), F.lit(-1))


def _dates(parts: Column) -> dict[str, Column]:
    """The last date that a text names; what headings say fills what is unset, the first of them and only those after that text."""
    year4 = lambda n: F.format_string("%04d", n)
    at = F.array_max(F.transform(parts, lambda x, i: F.when(x["r"]["date"].isNotNull(), i + 1)))
    said = F.try_element_at(parts, at)["r"]["date"]
    after = F.filter(F.slice(parts, F.coalesce(at, F.lit(0)) + 1, F.size(parts)), lambda x: _is(x, "period") | (_is(x, "work") & x["hint"]["year"].isNotNull()))
    one = lambda x: _is(x, "work") | (x["hint"]["from"] == x["hint"]["to"])
    first = F.get(after, 0)
    ends = F.transform(F.filter(after, lambda x: ~one(x)), lambda x: year4(x["hint"]["to"]))
    return {
        "date_iso": F.coalesce(said["iso"], F.when(first.isNotNull(), year4(F.coalesce(first["hint"]["year"], first["hint"]["from"])))),
        "date_end_iso": F.coalesce(said["end"], F.get(ends, 0)),
        "date_precision": F.coalesce(said["precision"], F.when(first.isNotNull(), F.when(one(first), "year").otherwise("decade"))),
        "date_raw": said["raw"],
    }


def _source(parts: Column, work_page: Column, title: Column, page_type: Column) -> Column:
    """The assembled source; later parts win. ``parts``: array of (origin, level, hint name, raw, hint, r).

    Only titles and the link depend on the order of steps and are folded; every other field is that of the last part that has it, or of
    the last heading of a kind (an episode's title and code also where they are null)."""
    zero = F.struct(F.when(work_page, title).alias("title"), F.when(work_page, "wikiquote").alias("site"), F.when(work_page, title).alias("link"), F.lit(None).alias("episode"), F.lit(None).alias("series")).cast(_FOLD)
    place = lambda x, name: F.when(_is(x, "locator") & (x["hint"]["place"] == name), x["hint"]["value"])

    def season_of(x: Column) -> Column:
        code = F.get(F.split(x["hint"]["code"], r"\."), 0)
        return F.when(_is(x, "season"), x["hint"]["number"]).when(code.rlike(r"\A\+?[0-9]{1,5}\z"), code.try_cast("int"))

    def of(folded: Column) -> Column:
        read = lambda key: lambda x: x["r"][key]
        located = lambda key, name: lambda x: F.coalesce(x["r"][key], place(x, name))
        own = {k: _last(parts, read(key)) for k, key in (
            ("work_type", "work_type"), ("locator_page", "page"), ("locator_line", "line"), ("publication", "publication"), ("publisher", "publisher"), ("isbn", "isbn"), ("url", "url"), ("occasion", "occasion"),
        )}
        own["work_type"] = F.coalesce(own["work_type"], F.when(work_page, rules.work_type_of(page_type)))
        for k, key, name in (("locator_chapter", "chapter", "chapter"), ("locator_part", "part", "part"), ("locator_act_scene", "act", "act_scene")):
            own[k] = _last(parts, located(key, name))
        own |= _dates(parts)
        own["work_year"] = _last(parts, lambda x: F.when(_is(x, "work"), x["hint"]["year"]))
        own["episode_number"] = _last_of(parts, lambda x: _is(x, "episode"))["hint"]["code"]
        own["episode_season"] = season_of(_last_of(parts, lambda x: _is(x, "season") | (_is(x, "episode") & x["hint"]["code"].isNotNull())))
        own |= {"work_title": folded["title"], "work_link_site": folded["site"], "work_link_title": folded["link"], "episode_title": folded["episode"], "episode_series": folded["series"]}
        cites = F.flatten(F.transform(parts, lambda x: x["r"]["cites"]))
        return F.struct(*[own[k].alias(k) for k in schema.SOURCE_FIELDS], cites.alias("cites")).cast(_ACC)

    return let(F.aggregate(parts, zero, lambda acc, x: _titles(acc, x, work_page)), of)


def _links(spans: Column) -> Column:
    return F.transform(F.filter(spans, lambda s: s["kind"] == "link"), lambda s: F.struct(s["site"].alias("site"), s["lang"].alias("lang"), s["title"].alias("title"), s["fragment"].alias("fragment")))


def _language(spans: Column, default: Column) -> Column:
    named = F.get(F.filter(spans, lambda s: (s["kind"] == "template") & (s["name"] == "lang") & (c.filled(s, "1").isNotNull())), 0)
    code = F.lower(c.param(named, "1"))
    return F.struct(F.coalesce(code, default).alias("language"), F.when(code.isNotNull(), "declared").otherwise("wiki_default").alias("from"))


def _strip_label(text: Column) -> Column:
    head = F.substring_index(text, ":", 1)
    rest = F.substring(text, F.length(head) + 2, F.length(text))
    return F.when(text.contains(":") & (F.octet_length(head) <= 20), trim_u(rest)).otherwise(text)


def cast_list(blocks: DataFrame) -> DataFrame:
    """(page_id, revision_id, character, actor): lines ``actor as character`` of sections whose own heading is a cast; of several the last."""
    own = rules.role_of(F.try_element_at("path", F.lit(-1))["text"])
    rows = blocks.where((F.col("block_type") == "list_item") & (F.size("path") > 0)).where(own == "cast").where(F.col("rt.text").contains(" as "))
    text = F.col("rt.text")
    head = F.substring_index(text, " as ", 1)
    named = rows.select("page_id", "revision_id", trim_u(head).alias("actor"), trim_u(F.substring(text, F.length(head) + 5, F.length(text))).alias("character"), F.struct("section_ord", "block_index").alias("at"))
    return named.groupBy("page_id", "revision_id", "character").agg(F.max_by("actor", "at").alias("actor"))


def quotes(blocks: DataFrame) -> DataFrame:
    """One row per quote, dialogue and turn. Pages that are redirects, disambiguations or placeholders have none; quotes
    without text and turns without a speaker or words are left out. ``blocks`` should be a written table: it is read twice."""
    kind = rules.page_type(F.col("categories"), F.col("lead_templates"), F.col("title"))
    b = blocks.where(F.col("block_type").isin("list_item", "exchange")).withColumn("page_type", kind["page_type"])
    b = b.where(~F.col("page_type").isin(rules.QUOTELESS_PAGES))
    b = b.withColumn("roles", F.transform("path", lambda p: rules.role_of(p["text"])))
    b = b.withColumn("role", rules.effective_role(F.col("roles"))).withColumn("own_role", F.coalesce(F.try_element_at("roles", F.lit(-1)), F.lit("quotes")))
    b = b.withColumn("work_page", F.col("page_type").isin(rules.WORK_PAGES)).withColumn("context_path", F.transform("path", lambda p: p["text"]))
    subject = c.agent(F.col("title"), rules.subject_kind(F.col("page_type")), F.struct(F.lit("wikiquote").alias("site"), F.col("wiki_language").alias("lang"), F.col("title").alias("title")))
    b = b.withColumn("subject", subject)

    # parts of the source: hinted headings outermost first, then citations; each is read once
    headings = F.filter(F.transform("path", lambda p: F.struct(p["level"].alias("level"), p["text"].alias("text"), p["wikitext"].alias("wikitext"), p["spans"].alias("spans"), _heading_hint(p).alias("hint"))), lambda p: p["hint"].isNotNull())
    kinds = F.transform(F.coalesce("annotations", F.array().cast(blocks.schema["annotations"].dataType)), lambda a: F.struct(rules.annotation_kind(a["rt"]).alias("kind"), a["rt"].alias("rt")))
    b = b.withColumn("notes", kinds).withColumn("headings", headings)
    hint_type = rules.HINT
    from_headings = lambda: F.transform(
        "headings",
        lambda p: F.struct(F.lit("heading").alias("origin"), p["level"].cast("smallint").alias("level"), p["hint"]["kind"].alias("name"), p["wikitext"].alias("raw"), p["hint"].cast(hint_type).alias("hint"), _reading(p).alias("r")),
    )
    from_notes = lambda: F.transform(
        F.filter("notes", lambda a: a["kind"].isin("citation", "attribution")),
        lambda a: F.struct(F.lit("annotation").alias("origin"), F.lit(None).cast("smallint").alias("level"), _none().alias("name"), trim_u(a["rt"]["wikitext"]).alias("raw"), F.lit(None).cast(hint_type).alias("hint"), _reading(a["rt"]).alias("r")),
    )
    b = b.withColumn("parts", _once(b, "parts", lambda: F.concat(from_headings(), from_notes())))
    b = b.withColumn("folded", _once(b, "folded", lambda: F.when((F.size("parts") > 0) | F.col("work_page"), _source(F.col("parts"), F.col("work_page"), F.col("title"), F.col("page_type")))))
    listed = F.concat(
        F.when(F.col("work_page"), F.array(F.struct(F.lit("page_subject").alias("origin"), F.lit(None).cast("smallint").alias("level"), _none().alias("hint"), F.col("title").alias("raw")))).otherwise(F.array().cast(f"array<{schema.PART}>")),
        F.transform("parts", lambda p: F.struct(p["origin"].alias("origin"), p["level"].alias("level"), p["name"].alias("hint"), p["raw"].alias("raw"))),
    )
    f = F.col("folded")
    complete = f["work_title"].isNotNull() | f["occasion"].isNotNull() | f["date_iso"].isNotNull() | f["episode_title"].isNotNull() | f["publication"].isNotNull()
    raw = F.array_join(F.filter(F.transform(listed, lambda p: trim_u(p["raw"])), lambda t: t != ""), " — ")
    source = F.struct(raw.alias("raw"), complete.alias("complete"), listed.alias("parts"), *[f[k].alias(k) for k in schema.SOURCE_FIELDS], f["cites"].alias("cite_templates")).cast(schema.SOURCE)
    b = b.withColumn("source", F.when(f.isNotNull(), source))
    has = lambda origin: F.exists("parts", lambda p: p["origin"] == origin)
    origin = F.when(has("heading") & has("annotation"), "mixed").when(has("heading"), "heading").when(has("annotation"), "annotation").otherwise("page_subject")
    b = b.withColumn("source_from", F.when(F.col("source").isNotNull(), origin)).withColumn("st", rules.status_of(F.col("role"), F.col("source.complete")))
    # written once: the three kinds of records below share it, and the long expressions above are planned once
    b = written(b.select("wiki_language", "title", "page_id", "page_type", "revision_id", "block_type", "block_index", "rt", "turns", "notes", "subject", "role", "own_role", "context_path", "source", "source_from", "st"), "folded")
    records = _items(b).unionByName(_dialogues(b)).unionByName(_turns(b))
    played = cast_list(blocks).select("page_id", "revision_id", F.col("character").alias("_name"), "actor")
    records = records.withColumn("_name", F.when(F.col("speaker.kind") == "character", F.col("speaker.name"))).join(played, ["page_id", "revision_id", "_name"], "left")
    speaker = F.when(F.col("speaker").isNotNull(), F.col("speaker").withField("played_by", F.col("actor")))
    out = records.withColumn("speaker", speaker)
    out = out.withColumn("id", hash16(quote_key(F.col("page_title"), F.col("context_path"), F.col("record_index")))).withColumn("content_hash", hash16(content_key(F.col("text"))))
    columns = ["id", "content_hash", "wiki_language", "page_title", "page_id", "page_type", "revision_id", "text", "wikitext", "language", "language_from", "kind", "status", "speaker", "about", "source", "context_path", "annotations", "translations", "links", "provenance"]
    return out.select(*columns)


def _base(b: DataFrame, rt: Column, index: Column, kind: Column, speaker: Column, speaker_from: Column, about: Column, notes: Column) -> DataFrame:
    lang = _language(rt["spans"], F.col("wiki_language"))
    shown = F.transform(notes, lambda a: F.struct(a["kind"].alias("kind"), a["rt"]["text"].alias("text"), trim_u(a["rt"]["wikitext"]).alias("wikitext")))
    translated = F.transform(F.filter(notes, lambda a: a["kind"] == "translation"), lambda a: F.struct(_strip_label(a["rt"]["text"]).alias("text"), _none().alias("language"), _none().alias("translator"), F.lit(False).alias("is_original")))
    notes_left = F.least(F.size(F.filter(notes, lambda a: a["kind"] == "note")), F.lit(255)).cast("smallint")
    return b.select(
        "wiki_language", F.col("title").alias("page_title"), "page_id", "page_type", "revision_id", rt["text"].alias("text"), rt["wikitext"].alias("wikitext"),
        lang["language"].alias("language"), lang["from"].alias("language_from"), kind.alias("kind"), F.col("st.status").alias("status"),
        speaker.cast(schema.AGENT).alias("speaker"), about.cast(f"array<{schema.AGENT}>").alias("about"), "source", "context_path", shown.alias("annotations"), translated.alias("translations"),
        _links(rt["spans"]).alias("links"),
        F.struct(F.when(speaker.isNotNull(), speaker_from).alias("speaker_from"), F.col("source_from"), F.col("st.status_from").alias("status_from"), notes_left.alias("unparsed_annotations")).alias("provenance"),
        index.cast("int").alias("record_index"),
    )


def _items(b: DataFrame) -> DataFrame:
    """List entries that are quotes. An entry of a cast, see-also, links or references section is one only if something is annotated to it."""
    notes = F.col("notes")
    plain_list = F.col("own_role").isin(rules.LIST_ROLES) & (F.size("notes") == 0)
    rows = b.where((F.col("block_type") == "list_item") & ~plain_list & (F.col("rt.text") != ""))
    role, page = F.col("role"), F.col("page_type")
    kind = F.when(role == "taglines", "tagline").when(role == "song_lyrics", "lyric").when(page == "proverbs", "proverb").otherwise("monologue")
    first = F.get(F.filter(notes, lambda a: a["kind"].isin("citation", "attribution")), 0)["rt"]
    rows = rows.withColumn("named", _once(b, "named", lambda: c.agent_of(first)))
    named = F.col("named")
    # role of the page's subject comes before what a citation names, except where others speak about it
    speaker = (
        F.when(role == "quotes_about", named)
        .when(page == "proverbs", F.lit(None).cast(schema.AGENT))
        .when((page == "person") & (role == "misattributed"), F.lit(None).cast(schema.AGENT))
        .when(page == "person", F.col("subject"))
        .when(page.isin(rules.SCREEN_PAGES), F.when(named.isNotNull(), named.withField("kind", F.lit("character"))))
        .otherwise(named)
    )
    by_subject = (page == "person") & (role != "quotes_about")
    about = F.when((page == "person") & (role != "quotes_about"), F.array().cast(f"array<{schema.AGENT}>")).otherwise(F.array("subject"))
    return _base(rows, F.col("rt"), F.col("block_index"), kind, speaker, F.when(by_subject, "page_subject").otherwise("annotation"), about, notes)


_EMPTY = f"array<struct<kind:string,rt:{schema.RICH}>>"


def _dialogues(b: DataFrame) -> DataFrame:
    """An exchange with more than one spoken turn, as one text of all turns."""
    speaks = lambda t: t["speaker"].isNotNull() & ~t["is_stage_direction"]
    rows = b.where((F.col("block_type") == "exchange") & (F.size(F.filter("turns", speaks)) > 1))
    said = F.array_join(F.transform("turns", lambda t: F.when(t["speaker"].isNotNull(), F.concat(t["speaker"], F.lit(": "), t["rt"]["text"])).otherwise(t["rt"]["text"])), "\n")
    markup = F.array_join(F.transform("turns", lambda t: t["rt"]["wikitext"]), "\n")
    rt = F.struct(said.alias("text"), markup.alias("wikitext"), F.array().cast(f"array<{schema.SPAN}>").alias("spans")).cast(schema.RICH)
    rows = rows.withColumn("said", rt)
    none = F.lit(None).cast(schema.AGENT)
    return _base(rows, F.col("said"), F.col("block_index"), F.lit("dialogue"), none, _none(), F.array().cast(f"array<{schema.AGENT}>"), F.array().cast(_EMPTY))


def _turns(b: DataFrame) -> DataFrame:
    rows = b.where("block_type = 'exchange'").select("*", F.posexplode("turns").alias("turn_no", "turn"))
    rows = rows.where(F.col("turn.speaker").isNotNull() & (F.col("turn.rt.text") != ""))
    speaker = c.agent(F.col("turn.speaker"), "character", F.col("turn.speaker_link"))
    index = F.col("block_index") * 100 + F.col("turn_no") + 1
    return _base(rows, F.col("turn.rt"), index, F.lit("dialogue_turn"), speaker, F.lit("dialogue_marker"), F.array().cast(f"array<{schema.AGENT}>"), F.array().cast(_EMPTY))


def ordered_islands(rows: DataFrame, page: str, line: str, depth: str) -> DataFrame:
    """The relational twin of the list reader: adds ``item``, the running number of the entry that a list line belongs to."""
    w = Window.partitionBy(page).orderBy(line).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("item", F.sum(F.when(F.col(depth) <= 1, 1).otherwise(0)).over(w))
