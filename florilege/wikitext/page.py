"""A page's markup to flat rows: sections in preorder with their heading path, and the blocks of each."""

from __future__ import annotations

import re

from florilege.wikitext.inline import Inline, closing, moved, rich_text
from florilege.wikitext.refs import split_top, template_call

_HEADING = re.compile(r"(={1,6})\s*(.+?)\s*(={1,6})\s*(?:<!--.*?-->\s*)?")
_LIST = re.compile(r"[*#][*#:;]*")
_RULE = re.compile(r"-{4,}\s*$|<hr\b[^<>]*/?>\s*$", re.IGNORECASE)
_MEDIA = re.compile(r"\[\[\s*(?:File|Image)\s*:", re.IGNORECASE)
_CATEGORY = re.compile(r"\[\[\s*[Cc]ategory:([^\]|]*)(?:\|[^\]]*)?\]\]")
#: Options of a picture that aren't its caption.
_OPTION = re.compile(r"thumb(?:nail)?(?:=.*)?|frame(?:d|less)?|border|left|right|center|none|baseline|sub|super|top|text-top|middle|bottom|text-bottom|upright(?:=.*)?|\d*(?:x\d+)?\s*px|(?:alt|link|page|lang|class|start|end)=.*", re.IGNORECASE)


def _balanced(text: str) -> bool:
    return text.count("{{") <= text.count("}}") and text.count("[[") <= text.count("]]")


class Page:
    """``rows``: one dict per section (block_type 'section', index -1) and block, in order of the page."""

    def __init__(self, text: str, title: str):
        self.title = title
        self.rows: list[dict] = []
        self.categories: list[str] = []
        self.lead_templates: list[dict] = []
        self.errors = 0
        self.skipped = 0
        self.path: list[dict] = []
        self.section = self.sections = 0
        self.index = 0
        self.lines = text.replace("\r\n", "\n").split("\n")
        self._read()

    # rows

    def _emit(self, block_type: str, **more) -> None:
        row = {"section_ord": self.section, "path": list(self.path), "block_index": self.index, "block_type": block_type}
        self.rows.append({**row, **more})
        if block_type != "section":
            self.index += 1

    def _rich(self, source: str) -> tuple[dict, Inline]:
        p = Inline(source, self.title)
        self.errors += p.errors
        return rich_text(source, self.title, p), p

    # lines

    def _read(self) -> None:
        i, n = 0, len(self.lines)
        while i < n:
            line = self.lines[i]
            if not line.strip():
                i += 1
            elif line.startswith("=") and (m := _HEADING.fullmatch(line.strip())):
                self._heading(m)
                i += 1
            elif _LIST.match(line):
                i = self._list(i)
            elif line[0] in ":;":
                i = self._exchange(i)
            elif line.lstrip().startswith("{|"):
                i = self._table(i)
            elif _RULE.match(line.strip()):
                self._emit("rule")
                i += 1
            else:
                i = self._prose(i)

    def _whole(self, i: int) -> tuple[str, int]:
        """The line at i, with the lines after it that an unclosed template or link runs over."""
        text, j = self.lines[i], i + 1
        while j < len(self.lines) and not _balanced(text) and self.lines[j].strip() and not self.lines[j].startswith("=="):
            text += "\n" + self.lines[j]
            j += 1
        if not _balanced(text):  # it never closes: take the line alone
            return self.lines[i], i + 1
        return text, j

    def _heading(self, m: re.Match) -> None:
        level = min(len(m[1]), len(m[3]))
        inner = m[0].strip().strip("=").strip()
        rt, _ = self._rich(inner)
        self.path = [p for p in self.path if p["level"] < level] + [{"level": level, "text": rt["text"], "wikitext": inner, "spans": rt["spans"]}]
        self.sections += 1
        self.section, self.index = self.sections, 0
        self._emit("section")

    def _list(self, i: int) -> int:
        item: dict | None = None

        def flush() -> None:
            if item is not None:
                self._emit("list_item", rt=item["rt"], annotations=item["annotations"])

        while i < len(self.lines) and (m := _LIST.match(self.lines[i])):
            text, j = self._whole(i)
            content = text[m.end() :]
            i = j
            if not content.strip():
                self.skipped += 1
                continue
            rt, _ = self._rich(content)
            if len(m[0]) <= 1 or item is None:
                flush()
                item = {"rt": rt, "annotations": []}
            else:
                item["annotations"].append({"depth": len(m[0]), "rt": rt})
        flush()
        return i

    def _exchange(self, i: int) -> int:
        turns = []
        while i < len(self.lines) and self.lines[i][:1] in (":", ";"):
            text, i = self._whole(i)
            content = re.sub(r"^[:;*#]+", "", text)
            rt, p = self._rich(content)
            if rt["text"] or rt["wikitext"].strip():
                turns.append(_turn(content, rt, p, self.title))
            else:
                self.skipped += 1
        if turns:
            self._emit("exchange", turns=turns)
        return i

    def _table(self, i: int) -> int:
        depth, start = 0, i
        while i < len(self.lines):
            line = self.lines[i].lstrip()
            depth += line.startswith("{|") - line.startswith("|}")
            i += 1
            if not depth:
                break
        self._emit("table", wikitext="\n".join(self.lines[start:i]))
        return i

    def _prose(self, i: int) -> int:
        held: list[str] = []

        def flush() -> None:
            if held:
                source = "\n".join(held)
                rt, _ = self._rich(source)
                if rt["text"] or rt["wikitext"].strip():
                    self._emit("paragraph", rt=rt)
                held.clear()

        while i < len(self.lines):
            line = self.lines[i]
            if not line.strip() or line[0] in "*#:;" or line.lstrip().startswith("{|") or (line.startswith("=") and _HEADING.fullmatch(line.strip())) or _RULE.match(line.strip()):
                break
            text, i = self._whole(i)
            rest = self._media(text, flush)
            for c in _CATEGORY.findall(rest):
                self.categories.append(c.strip())
            rest = _CATEGORY.sub("", rest)
            bare = rest.strip()
            if not bare:
                continue
            if bare.startswith("{{") and closing(bare, 0, "{{", "}}") == len(bare):
                flush()
                if re.match(r"\{\{\s*[A-Z]+\s*:", bare):
                    rt, _ = self._rich(bare)
                    self._emit("paragraph", rt=rt)
                else:
                    call = template_call(bare)
                    if not self.section:
                        self.lead_templates.append(call)
                    self._emit("template", template=call)
            else:
                held.append(rest)
        flush()
        return i

    def _media(self, text: str, flush) -> str:
        while m := _MEDIA.search(text):
            end = closing(text, m.start(), "[[", "]]")
            if end < 0:
                break
            file, *options = split_top(text[m.start() + 2 : end - 2])
            captions = [o for o in options if not _OPTION.fullmatch(o.strip()) or not o.strip()]
            caption = self._rich(captions[-1])[0] if captions else None
            if captions and not captions[-1].strip():
                self.errors += 1  # an empty caption is a slip
            if not text[: m.start()].strip():
                flush()
            author = caption["text"].rpartition(" ~ ") if caption and " ~ " in caption["text"] else None
            self._emit("media", media={"file": file.strip(), "caption": caption, "caption_attribution": author[2].strip() if author else None})
            text = text[: m.start()] + text[end:]
        return text


def _turn(content: str, rt: dict, p: Inline, title: str) -> dict:
    turn = {"speaker": None, "speaker_link": None, "rt": rt, "is_stage_direction": False}
    head = content.lstrip()
    if p.first is None and head.startswith("''") and head != content:
        p = Inline(head, title)
        content = head
    if p.first is None:
        return turn
    kind, _, end = p.first
    if kind == "italic":
        turn["is_stage_direction"] = content[:end].strip() == rt["wikitext"].strip()
    elif kind == "bold":
        name = rich_text(content[:end].strip("'"), title)
        speaker = name["text"].rstrip().rstrip(":").strip()
        if speaker and (content[end:].lstrip().startswith(":") or name["text"].rstrip().endswith(":")):
            link = next((s for s in name["spans"] if s["kind"] == "link"), None)
            turn["speaker"] = speaker
            turn["speaker_link"] = {k: link[k] for k in ("site", "lang", "title", "fragment")} if link else None
            before, colon, after = rt["text"].partition(":")
            if colon:
                said = after.lstrip().lstrip(":").lstrip()
                dropped = len((before + colon).encode("utf-8", "surrogatepass")) + len(after.encode("utf-8", "surrogatepass")) - len(said.encode("utf-8", "surrogatepass"))
                kept = [s for s in rt["spans"] if s["end"] > dropped]
                turn["rt"] = {"wikitext": rt["wikitext"], **moved(said, kept, dropped)}
    return turn
