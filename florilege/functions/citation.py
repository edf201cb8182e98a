"""Readers of citation lines as Columns: dates, locators, identifiers, occasions, named agents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from florilege.functions.text import let, trim_u

# Month names, in order.
MONTHS = ["january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december"]
# Patterns of dates and locators. Word boundaries, digits and spaces are Unicode's.
_U = "(?iuU)"
BCE = _U + r"\b(\d{1,4})\s*(?:BCE?|B\.C\.E?\.)\b"
RANGE = r"(?U)\((\d{4})\s*[-–]\s*(\d{4})\)"
DAY_MONTH_YEAR = _U + r"\b([0-3]?\d)\s+([a-z]{3,9})\.?,?\s+(\d{3,4})\b"
MONTH_DAY_YEAR = _U + r"\b([a-z]{3,9})\.?\s+([0-3]?\d),\s*(\d{3,4})\b"
MONTH_YEAR = _U + r"\b([a-z]{3,9})\.?\s+(\d{3,4})\b"
CIRCA = _U + r"\bc(?:irca)?\.?\s*(\d{3,4})\b"
BRACKET_YEAR = r"(?U)[(\[](?:in\s+)?(1\d{3}|20\d{2}|[1-9]\d{2})[)\],;]"
PAGE = _U + r"\bpp?\.\s*([0-9ivxlc]+(?:\s*[-–]\s*[0-9ivxlc]+)?)"
CHAPTER = _U + r"\b(?:ch\.|chapter)\s*([0-9]+|[ivxlc]+)\b"
PART = _U + r"\b(?:no\.|number|book|part|vol\.|volume)\s*([0-9]+|[ivxlc]+)\b"
ACT = _U + r"\bact\s+([0-9]+|[ivxlc]+)(?:\s*,?\s*sc(?:ene)?\.?\s*([0-9]+|[ivxlc]+))?"
LINE = _U + r"\blines?\s*([0-9]+(?:\s*[-–]\s*[0-9]+)?)"
ISBN = _U + r"\bISBN\s*([0-9][0-9\-x]{8,})"

DATE = "struct<iso:string,end:string,precision:string,raw:string>"


def month_number(word: Column) -> Column:
    def of(w: Column) -> Column:
        out = F.lit(None).cast("int")
        for number, name in reversed(list(enumerate(MONTHS, 1))):
            out = F.when((F.length(w) >= 3) & F.lit(name).startswith(w), number).otherwise(out)
        return out

    return let(F.lower(F.regexp_replace(word, r"\.+$", "")), of)


def _pad(c: Column, width: int) -> Column:
    n = c.try_cast("int")
    return F.lpad(n.cast("string"), F.greatest(F.lit(width), F.length(n.cast("string"))), F.lit("0"))


def _date(iso: Column, precision: str, raw: Column, end: Column | None = None) -> Column:
    return F.struct(iso.alias("iso"), (end if end is not None else F.lit(None).cast("string")).alias("end"), F.lit(precision).alias("precision"), raw.alias("raw"))


#: Every month's name begins with one of these; a word that doesn't is no month.
_MONTH_BEGINS = "|".join(m[:3] for m in MONTHS)


def read_date(text: Column) -> Column:
    """struct<iso, end, precision, raw> of the first form that fits, in order of trust; null if none does."""
    return F.when(text.rlike(r"\p{Nd}"), let(text, _date_in))


def _date_in(text: Column) -> Column:
    low = F.lower(text)
    bracket = text.contains("(") | text.contains("[")
    years = text.rlike(r"\p{Nd}{3}")
    months = years & low.rlike(_MONTH_BEGINS)
    # each pattern is looked for once; its groups are read from what it found
    found = lambda guard, p, body: F.when(guard, let(F.regexp_substr(text, F.lit(p)), lambda m: F.when(m.isNotNull(), body(m, lambda i: F.regexp_extract(m, p, i)))))

    def dated(p: str, y: int, mon: int, d: int | None = None) -> Column:
        parts = lambda g, m: [_pad(g(y), 4), _pad(m, 2)] + ([_pad(g(d), 2)] if d else [])
        return found(months, p, lambda m, g: let(month_number(g(mon)), lambda n: F.when(n.isNotNull(), _date(F.concat_ws("-", *parts(g, n)), "day" if d else "month", trim_u(m)))))

    return F.coalesce(
        found(low.contains("bc") | low.contains("b.c"), BCE, lambda m, g: _date(F.concat(F.lit("-"), _pad(g(1), 4)), "year", trim_u(m))),
        found(bracket, RANGE, lambda m, g: _date(g(1), "range", m, g(2))),
        dated(DAY_MONTH_YEAR, 3, 2, 1),
        dated(MONTH_DAY_YEAR, 3, 1, 2),
        dated(MONTH_YEAR, 2, 1),
        found(years & low.contains("c"), CIRCA, lambda m, g: _date(_pad(g(1), 4), "circa", trim_u(m))),
        found(bracket, BRACKET_YEAR, lambda m, g: _date(_pad(g(1), 4), "year", g(1))),
        let(trim_u(text), lambda whole: F.when(whole.rlike(r"\A(?:[0-9]{4}|\+[0-9]{3})\z"), _date(_pad(F.regexp_replace(whole, r"^\+", ""), 4), "year", whole))),
    )


def before_retrieval(text: Column) -> Column:
    """The text up to where it begins to tell when it was looked up."""
    low = F.lower(text)
    # Words that introduce when or where a text was looked up.
    ends = [F.nullif(F.locate(w, low), F.lit(0)) for w in ("retrieved", "accessed", "archived", "as reported in")]
    cut = F.least(*ends)
    return F.when(cut.isNull(), text).otherwise(F.substring(text, F.lit(1), cut - 1))


#: Letters without which a pattern can't match: looking for them first is far cheaper than the pattern.
_NEEDS = {PAGE: ["p."], CHAPTER: ["ch"], PART: ["no.", "number", "book", "part", "vol"], ACT: ["act"], LINE: ["line"], ISBN: ["isbn"]}


def _needed(text: Column, pattern: str) -> Column:
    low, (first, *others) = F.lower(text), _NEEDS[pattern]
    out = low.contains(first)
    for w in others:
        out = out | low.contains(w)
    return out


def locator(text: Column, pattern: str) -> Column:
    return F.when(_needed(text, pattern), trim_u(F.regexp_substr(text, F.lit(pattern))))


def isbn(text: Column) -> Column:
    return F.when(_needed(text, ISBN), trim_u(F.nullif(F.regexp_extract(text, ISBN, 1), F.lit(""))))


def _word(text: Column, word: str) -> Column:
    return text.contains(word) & text.rlike(rf"(?<![\p{{IsAlphabetic}}\p{{N}}]){word}(?![\p{{IsAlphabetic}}\p{{N}}])")


# Phrases and words, in order, and the occasions they mean.
OCCASION_PHRASES = [
    ("press conference", "press conference"), ("news conference", "press conference"), ("address to", "speech"), ("address at", "speech"),
    ("blog post", "post"), ("facebook post", "post"),
]
OCCASION_WORDS = [
    ("letter", "letter"), ("letters", "letter"), ("interview", "interview"), ("speech", "speech"), ("lecture", "lecture"), ("sermon", "sermon"),
    ("testimony", "testimony"), ("diary", "diary"), ("essay", "essay"), ("editorial", "editorial"), ("tweet", "post"),
]


def read_occasion(text: Column) -> Column:
    """The occasion that a citation names: phrases first, then whole words, in this order."""
    return let(F.lower(text), _occasion_in)


def _occasion_in(low: Column) -> Column:
    out = F.when(low.contains(OCCASION_PHRASES[0][0]), OCCASION_PHRASES[0][1])
    for phrase, occasion in OCCASION_PHRASES[1:]:
        out = out.when(low.contains(phrase), occasion)
    for word, occasion in OCCASION_WORDS:
        out = out.when(_word(low, word), occasion)
    return out


def cite_work_type(name: Column) -> Column:
    # Citation templates and the kinds of works they are for.
    kinds = {"cite book": "book", "cite journal": "journal article", "cite news": "news article", "cite web": "web page", "cite episode": "episode", "cite interview": "interview", "cite speech": "speech"}
    out = F.lit(None).cast("string")
    for k, v in kinds.items():
        out = F.when(name == k, v).otherwise(out)
    return out


def param(call: Column, key: str) -> Column:
    """The first parameter of that name, null if there is none."""
    return F.get(F.filter(call["params"], lambda p: p["key"] == key), 0)["value"]


def filled(call: Column, key: str) -> Column:
    return F.nullif(param(call, key), F.lit(""))


def is_cite(span: Column) -> Column:
    return (span["kind"] == "template") & (span["name"].startswith("cite") | (span["name"] == "citation"))


def is_italic(span: Column) -> Column:
    return span["kind"].isin("italic", "bold_italic")


def _earliest(spans: Column) -> Column:
    """The span that starts first; of equal ones the first in the list."""
    return let(spans, lambda all_: F.get(F.filter(all_, lambda s: s["start"] == F.array_min(F.transform(all_, lambda o: o["start"]))), 0))


def first_italic(rt: Column) -> Column:
    title = trim_u(_earliest(F.filter(rt["spans"], is_italic))["shown"])
    return F.when(F.octet_length(title) > 2, trim_u(F.regexp_replace(title, "^,+|,+$", "")))


def cite_author(rt: Column) -> Column:
    """Author of the first citation template that names one."""
    named = F.transform(
        F.filter(rt["spans"], is_cite),
        lambda s: F.coalesce(filled(s, "author"), F.when(filled(s, "last").isNotNull(), F.concat_ws(" ", filled(s, "first"), filled(s, "last")))),
    )
    return F.get(F.filter(named, lambda n: n.isNotNull()), 0)


def agent(name: Column, kind: str | Column, link: Column | None = None, played_by: Column | None = None) -> Column:
    none = F.lit(None).cast("string")
    part = lambda k: (link[k] if link is not None else none)
    return F.struct(
        name.alias("name"), (F.lit(kind) if isinstance(kind, str) else kind).alias("kind"), part("site").alias("link_site"), part("lang").alias("link_lang"),
        part("title").alias("link_title"), (played_by if played_by is not None else none).alias("played_by"),
    )


def agent_of(rt: Column) -> Column:
    """The person or group that a citation names: a link outside of italics, a template's author, or a name before the first comma."""
    return let(rt, _agent_in)


def _agent_in(rt: Column) -> Column:
    spans = rt["spans"]
    italics = F.filter(spans, is_italic)
    free = F.filter(spans, lambda s: (s["kind"] == "link") & ~F.exists(italics, lambda o: (o["start"] <= s["start"]) & (o["end"] >= s["end"])))
    return let(_earliest(free), lambda link: _agent_by(rt, link))


def _agent_by(rt: Column, link: Column) -> Column:
    shown = trim_u(link["shown"])
    author = cite_author(rt)
    head = trim_u(F.substring_index(rt["text"], ",", 1))
    is_name = (
        (head != "") & (F.octet_length(head) <= 60) & (F.size(F.split(head, r"(?U)\s+")) <= 5) & head.rlike(r"\A\p{Lu}") & ~head.endswith(".")
    )
    return (
        F.when((link["site"] != "wikisource") & (shown != ""), agent(shown, "person", link))
        .when(author.isNotNull(), agent(author, "person"))
        .when(is_name, agent(head, "unknown"))
    )
