"""Inline markup to plain text with spans.

One tokeniser cuts the text into pieces; emphasis is kept on a stack and closed by the next run of the same kind or by
the end of the line. Offsets of spans are bytes of the trimmed text; ``shown`` is the text a span covers.
"""

from __future__ import annotations

import re

from florilege.wikitext.refs import display_title, entity, page_ref, shown_text, split_top, template_call

_TOKEN = re.compile(
    r"(?P<comment><!--.*?(?:-->|\Z))|(?P<nowiki><nowiki\s*>(?P<raw>.*?)</nowiki\s*>|<nowiki\s*/>)|(?P<ref><ref\b[^<>]*/>|<ref\b[^<>]*>(?P<note>.*?)</ref\s*>)"
    r"|(?P<tag></?[A-Za-z][A-Za-z0-9]*\b[^<>]*>)|(?P<braces>\{\{)|(?P<brackets>\[\[)|(?P<url>\[(?:https?:|ftp:|mailto:|//)[^\s\]]*)"
    r"|(?P<quotes>'{2,})|(?P<entity>&(?:\#[0-9]+|\#[xX][0-9A-Fa-f]+|[A-Za-z][A-Za-z0-9]*);)|(?P<sign>~{3,5})|(?P<line>\n)",
    re.DOTALL | re.IGNORECASE,
)
#: Words in braces that aren't templates.
_MAGIC = re.compile(r"\{\{\s*(?:DEFAULTSORT|DISPLAYTITLE|DEFAULTSORTKEY|DEFAULTCATEGORYSORT|#\w+|CURRENT\w+|LOCAL\w+|NUMBEROF\w+|SITENAME|FULLPAGENAME|NAMESPACE)\b\s*[:|}]")
_KIND = {2: "italic", 3: "bold", 5: "bold_italic"}
_BLANK = {k: None for k in ("site", "lang", "title", "fragment", "url", "name", "params", "wikitext", "note")}


def closing(text: str, at: int, opened: str, closed: str) -> int:
    """End of the bracketed text that starts at ``at``, -1 if it doesn't end."""
    depth = 0
    for m in re.compile(re.escape(opened) + "|" + re.escape(closed)).finditer(text, at):
        depth += 1 if m[0] == opened else -1
        if not depth:
            return m.end()
    return -1


class Inline:
    """The text, spans and number of slips of one piece of markup."""

    def __init__(self, source: str, title: str = ""):
        self.title = title
        self.parts: list[str] = []
        self.size = 0
        self.spans: list[dict] = []
        self.errors = 0
        #: kind, source range of the first piece if that is emphasis, and the text it gave
        self.first: tuple[str, int, int] | None = None
        self.open: list[tuple[str, int, int]] = []
        self._read(source)

    def _push(self, text: str) -> None:
        self.parts.append(text)
        self.size += len(text.encode("utf-8", "surrogatepass"))

    def _span(self, start: int, kind: str, **more) -> None:
        self.spans.append({"start": start, "end": self.size, "kind": kind, **_BLANK, **more})

    def _close(self, at: int) -> None:
        kind, start, begun = self.open.pop()
        self._span(start, kind)
        if begun == 0 and self.first is None:
            self.first = (kind, begun, at)

    def _emphasis(self, run: int, at: int, end: int) -> None:
        if run == 4:
            self._push("'")
            run = 3
        elif run > 5:
            self._push("'" * (run - 5))
            run = 5
        kinds = [k for k, _, _ in self.open]
        want = _KIND[run]
        if want in kinds:
            while self.open[-1][0] != want:
                self._close(end)
            self._close(end)
        elif run == 5 and {"italic", "bold"} <= set(kinds):
            self._close(end)
            self._close(end)
        elif run != 5 and kinds and kinds[-1] == "bold_italic":
            # ''''' closed one after the other: the outer part goes on
            _, start, begun = self.open.pop()
            self.open += [("italic" if run == 3 else "bold", start, begun), (want, start, begun)]
            self._close(end)
        else:
            self.open.append((want, self.size, at))

    def _end_line(self, at: int) -> None:
        while self.open:
            self.errors += 1
            self._close(at)

    def _read(self, s: str) -> None:
        at = 0
        while m := _TOKEN.search(s, at):
            self._push(s[at : m.start()])
            kind, at = m.lastgroup, m.end()
            if kind in ("raw", "note"):
                kind = "nowiki" if m["nowiki"] else "ref"
            if m["comment"] is not None:
                self._span(self.size, "comment", note=re.sub(r"^(?:<!--)+|(?:-->)+$", "", m[0]).strip())
            elif m["nowiki"] is not None:
                self._push(m["raw"] or "")
            elif m["ref"] is not None:
                self._span(self.size, "reference", note=(m["note"] or "").strip())
            elif kind == "tag":
                if re.match(r"</?br\b", m[0], re.IGNORECASE):
                    self._push("\n")
            elif kind == "braces":
                at = self._braces(s, m.start())
            elif kind == "brackets":
                at = self._brackets(s, m.start())
            elif kind == "url":
                at = self._external(s, m)
            elif kind == "quotes":
                self._emphasis(len(m[0]), m.start(), m.end())
            elif kind == "entity":
                self._push(entity(m[0]))
            elif kind == "line":
                self._end_line(m.start())
                self._push("\n")
        self._push(s[at:])
        self._end_line(len(s))

    def _braces(self, s: str, at: int) -> int:
        end = closing(s, at, "{{", "}}")
        if end < 0:
            self.errors += 1
            self._push("{{")
            return at + 2
        raw = s[at:end]
        if _MAGIC.match(raw):
            return end
        call = template_call(raw)
        start = self.size
        self._push(shown_text(call, self.title))
        if call["name"] == "pagename":
            return end
        target = next((p["value"] for p in call["params"] if p["key"] == "1"), None)
        if call["name"] == "w" and target is not None:
            self._span(start, "link", **{**page_ref(target), "site": "wikipedia"})
        self._span(start, "template", name=call["name"], params=call["params"], wikitext=raw)
        return end

    def _brackets(self, s: str, at: int) -> int:
        end = closing(s, at, "[[", "]]")
        if end < 0 or "\n\n" in s[at:end]:
            self.errors += 1
            self._push("[[")
            return at + 2
        target, *labels = split_top(s[at + 2 : end - 2])
        start = self.size
        self._push(labels[-1] if labels else display_title(target))
        self._span(start, "link", **page_ref(target))
        return end

    def _external(self, s: str, m: re.Match) -> int:
        end = s.find("]", m.end())
        if end < 0 or "\n" in s[m.end() : end]:
            self._push("[")
            return m.start() + 1
        start = self.size
        self._push(s[m.end() : end].strip())
        self._span(start, "external_link", url=m["url"][1:])
        return end + 1


def rich_text(source: str, title: str = "", parsed: Inline | None = None) -> dict:
    """{text, wikitext, spans} with the text trimmed and the spans moved along."""
    p = parsed or Inline(source, title)
    return {"wikitext": source, **trimmed("".join(p.parts), p.spans)}


def trimmed(text: str, spans: list[dict]) -> dict:
    lead = len(text[: len(text) - len(text.lstrip())].encode("utf-8", "surrogatepass"))
    return moved(text.strip(), spans, lead)


def moved(text: str, spans: list[dict], cut: int) -> dict:
    raw = text.encode("utf-8", "surrogatepass")
    out = []
    for s in spans:
        a, b = (min(max(s[k] - cut, 0), len(raw)) for k in ("start", "end"))
        out.append({**s, "start": a, "end": b, "shown": raw[a:b].decode("utf-8", "replace")})
    return {"text": text, "spans": out}
