"""Classification rules as Columns: roles and hints of headings, page types, kinds of annotations, status."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from florilege.functions.text import let, trim_u

#: Number words.
NUMBER_WORDS = ["one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten", "eleven", "twelve"]
#: Headings that mean a place in a work without a number.
PLACES = ["preface", "prologue", "epilogue", "introduction", "incipit", "foreword", "afterword"]
WORK_PAGES = ["film", "television_series", "television_season", "video_game", "literary_work", "musical_work"]
SCREEN_PAGES = ["film", "television_series", "television_season", "video_game"]
QUOTELESS_PAGES = ["disambiguation", "placeholder"]
LIST_ROLES = ["cast", "see_also", "external_links", "references"]
#: Roles that a section doesn't pass on: what is below keeps the role of the section above it.
OPEN_ROLES = ["other", "alpha_bucket", "episodes"]


def _first(*cases: tuple[Column, str]) -> Column:
    out = F.when(cases[0][0], F.lit(cases[0][1]))
    for test, value in cases[1:]:
        out = out.when(test, F.lit(value))
    return out


def _folded(c: Column) -> Column:
    return F.lower(trim_u(F.regexp_replace(trim_u(c), ":+$", "")))


def _small_number(c: Column) -> Column:
    """An integer from 0 to 65535 (a plus sign is allowed); null for anything else."""
    n = F.when(c.rlike(r"\A\+?[0-9]{1,9}\z"), F.regexp_replace(c, r"^\+", "").try_cast("int"))
    return F.when(n <= 65535, n)


def season_number(folded: Column) -> Column:
    rest = trim_u(F.regexp_extract(folded, r"(?s)\A(?:season|series) (.*)\z", 1))
    word = F.array_position(F.array(*map(F.lit, NUMBER_WORDS)), rest).cast("int")
    return F.coalesce(_small_number(rest), F.when(word > 0, word))


def role_of(heading: Column) -> Column:
    """One of sixteen roles; the first rule that fits."""
    return let(_folded(heading), lambda h: _role(h, trim_u(heading)))


def _role(h: Column, heading: Column) -> Column:
    # Words of headings and the roles they mean. A single letter counts only without a colon.
    has = h.contains
    return _first(
        (has("misattributed"), "misattributed"),
        (has("disputed"), "disputed"),
        (has("unsourced") | (h == "suggestions"), "unsourced"),
        (h.startswith("attributed"), "attributed"),
        (h.startswith("quotes about") | (h == "about") | h.startswith("about "), "quotes_about"),
        (h.isin("quotes", "quote", "quotations", "sourced", "sourced quotes"), "quotes"),
        (h.isin("dialogue", "dialogues", "dialog", "dialogs"), "dialogue"),
        (has("tagline"), "taglines"),
        (h.isin("song lyrics", "lyrics", "songs"), "song_lyrics"),
        (h.endswith("cast") | (h == "cast members"), "cast"),
        (h.isin("episodes", "seasons") | season_number(h).isNotNull(), "episodes"),
        (h.isin("see also", "related"), "see_also"),
        (h.startswith("external link") | h.startswith("other project"), "external_links"),
        (h.isin("references", "notes", "footnotes", "citations"), "references"),
        (heading.rlike(r"\A[\p{IsAlphabetic}\p{N}]\z"), "alpha_bucket"),
    ).otherwise("other")


HINT = "struct<kind:string,title:string,year:int,number:int,code:string,from:int,to:int,place:string,value:string>"


def _hint(kind: str, **fields: Column) -> Column:
    types = {"title": "string", "year": "int", "number": "int", "code": "string", "from": "int", "to": "int", "place": "string", "value": "string"}
    return F.struct(F.lit(kind).alias("kind"), *[fields.get(k, F.lit(None)).cast(t).alias(k) for k, t in types.items()])


def _whole(c: Column) -> Column:
    return F.when(c.rlike(r"\A[+-]?[0-9]{1,9}\z"), c.try_cast("int"))


def source_hint(heading: Column, is_italic: Column) -> Column:
    """What a heading tells about the source: season, period, episode, locator or work; null if nothing."""
    return let(trim_u(heading), lambda text: _hint_of(text, is_italic))


def _hint_of(text: Column, is_italic: Column) -> Column:
    lower = F.lower(text)
    season = season_number(_folded(text))
    decade = F.when(F.octet_length(text) == 5, _whole(F.regexp_extract(text, r"(?s)\A(.{4})s\z", 1)))
    year = F.when(F.octet_length(text) == 4, _whole(text))
    left = _whole(trim_u(F.regexp_extract(text, r"(?s)\A([^-–]*)[-–]", 1)))
    right = _whole(trim_u(F.regexp_extract(text, r"(?s)\A[^-–]*[-–](.*)\z", 1)))
    number = F.regexp_extract(text, r"\A[Ee]pisode \s*([0-9]+)\z", 1)
    code = trim_u(F.regexp_extract(text, r"(?s)\A.*\[([^\[\]]*)\][^\]\[]*\z", 1))
    episode_title = trim_u(F.regexp_extract(text, r"(?s)\A(.*)\[[^\[\]]*\][^\]\[]*\z", 1))
    is_code = code.rlike(r"\A[0-9.x-]+\z")
    labels = F.regexp_extract(lower, r"(?s)\A(chapter|ch\.|canto|act|scene|part|book|volume|vol\.|no\.)", 1)
    after = trim_u(F.substring(lower, F.length(labels) + 1, F.length(lower)))
    numbered = (labels != "") & (after.rlike(r"\A(?:[0-9]+|[ivxlc]+)\z") | after.isin(NUMBER_WORDS))
    place = F.when(labels.isin("chapter", "ch.", "canto"), "chapter").when(labels.isin("act", "scene"), "act_scene").otherwise("part")
    inside = trim_u(F.regexp_extract(text, r"(?s)\A.*\(([^()]*)\)\z", 1))
    digits = F.regexp_replace(inside, "[^0-9]", "")
    bracket_year = F.when((F.length(digits) == 4) & inside.rlike(r"\A[0-9\p{IsAlphabetic}]"), digits.try_cast("int"))
    work = F.when(bracket_year.isNotNull(), trim_u(F.regexp_extract(text, r"(?s)\A(.*)\([^(]*\z", 1))).otherwise(text)
    return (
        F.when(text == "", F.lit(None).cast(HINT))
        .when(season.isNotNull(), _hint("season", number=season))
        .when(decade.isNotNull(), _hint("period", **{"from": decade, "to": decade + 9}))
        .when(year.isNotNull(), _hint("period", **{"from": year, "to": year}))
        .when(left <= right, _hint("period", **{"from": left, "to": right}))
        .when(number != "", _hint("episode", code=number))
        .when(is_code, _hint("episode", title=F.when(episode_title != "", episode_title), code=code))
        .when(numbered, _hint("locator", place=place, value=text))
        .when(lower.isin(PLACES), _hint("locator", place=F.lit("part"), value=text))
        .when(is_italic | bracket_year.isNotNull(), _hint("work", title=work, year=bracket_year))
    )


def page_type(categories: Column, templates: Column, title: Column) -> Column:
    """struct<page_type, evidence>: twelve rules in order; the evidence is the first category in page order that fits."""
    names = F.transform(templates, lambda t: t["name"])
    low = F.transform(categories, lambda c: F.lower(c))

    def by_template(*wanted: str) -> Column:
        return F.get(F.filter(names, lambda n: n.isin(*wanted)), 0)

    def by_category(test) -> Column:
        return F.get(F.filter(low, test), 0)

    last_word = lambda c: F.substring_index(F.regexp_replace(trim_u(c), r"\s+", " "), " ", -1)
    # Templates and categories, in order of their rules.
    rules = [
        ("disambiguation", "template", by_template("disambig", "disambiguation", "hndis")),
        ("placeholder", "template", by_template("year page placeholder")),
        ("person", "category", by_category(lambda c: (c == "living people") | c.endswith(" births") | c.endswith(" deaths"))),
        ("television_season", "category", by_category(lambda c: c.endswith(" seasons"))),
        ("film", "category", by_category(lambda c: c.endswith(" film") | c.endswith(" films"))),
        ("television_series", "category", by_category(lambda c: (c == "cancelled shows") | c.contains("television series") | c.contains("television programs") | c.contains("web series") | c.contains("anime"))),
        ("video_game", "category", by_category(lambda c: c.contains("video games"))),
        ("musical_work", "category", by_category(lambda c: c.endswith(" songs") | c.endswith(" albums"))),
        ("literary_work", "category", by_category(lambda c: c.startswith("works by") | last_word(c).isin("novels", "books", "plays", "poems", "essays", "stories", "works"))),
        ("proverbs", "category", by_category(lambda c: c.contains("proverbs"))),
        ("theme", "category", by_category(lambda c: c.isin("themes", "virtues", "emotions"))),
    ]
    listed = F.when(F.lower(title).startswith("list of") | F.lower(title).startswith("lists of"), title)
    rules.append(("list", "title", listed))
    make = lambda kind, what, found: F.struct(F.lit(kind).alias("page_type"), F.array(F.concat(F.lit(f"{what}: "), found)).alias("evidence"))
    out = F.when(rules[0][2].isNotNull(), make(*rules[0]))
    for rule in rules[1:]:
        out = out.when(rule[2].isNotNull(), make(*rule))
    return out.otherwise(F.struct(F.lit("unknown").alias("page_type"), F.array().cast("array<string>").alias("evidence")))


def annotation_kind(rt: Column) -> Column:
    """citation, translation, cross_ref or note."""
    low = F.lower(trim_u(rt["text"]))
    starts = lambda *labels: low.rlike(r"\A(?:" + "|".join(labels) + ")")
    cited = F.exists(
        rt["spans"],
        lambda s: ((s["kind"] == "template") & (s["name"].startswith("cite") | (s["name"] == "citation"))) | ((s["kind"] == "external_link") & (s["url"] != "")),
    )
    # Labels of annotations.
    return (
        F.when(starts("translation", "translated", "transliteration", "meaning", "literally"), "translation")
        .when(starts("compare", "variant", "see also"), "cross_ref")
        .when((low != "") | F.coalesce(cited, F.lit(False)), "citation")
        .otherwise("note")
    )


def effective_role(roles: Column) -> Column:
    """The nearest role from the inside out that says something; quotes at the top."""
    return F.coalesce(F.try_element_at(F.filter(roles, lambda r: ~r.isin(OPEN_ROLES)), F.lit(-1)), F.lit("quotes"))


def subject_kind(kind: Column) -> Column:
    return F.when(kind == "person", "person").when(kind.isin("theme", "unknown", "list"), "topic").otherwise("work")


def work_type_of(kind: Column) -> Column:
    return _first(
        (kind == "film", "film"),
        (kind.isin("television_series", "television_season"), "series"),
        (kind == "video_game", "video game"),
        (kind == "literary_work", "book"),
        (kind == "musical_work", "song"),
    )


def status_of(role: Column, complete: Column) -> Column:
    by_role = role.isin("misattributed", "disputed", "attributed", "unsourced")
    return F.struct(
        F.when(by_role, role).when(F.coalesce(complete, F.lit(False)), "sourced").otherwise("unsourced").alias("status"),
        F.when(by_role, "section_role").otherwise("citation_presence").alias("status_from"),
    )


def interwiki_of(templates: Column, title: Column) -> Column:
    """Sister-project links of lead templates; without a first parameter they mean the page's own title."""
    # Templates and the projects they link to.
    site = lambda n: (
        F.when(n.isin("wikipedia", "wikipediapar"), "wikipedia")
        .when(n.isin("wikisource", "wikisource author"), "wikisource")
        .when(n == "wiktionary", "wiktionary")
        .when(n.isin("commons", "commonscat", "commons category", "commons cat"), "commons")
    )
    first = lambda t: F.get(F.filter(t["params"], lambda p: p["key"] == "1"), 0)["value"]
    made = F.transform(
        templates,
        lambda t: F.struct(site(t["name"]).alias("site"), F.lit("en").alias("lang"), F.coalesce(F.when(first(t) != "", first(t)), title).alias("title"), F.lit(None).cast("string").alias("fragment")),
    )
    return F.filter(made, lambda p: p["site"].isNotNull())
