"""Link targets, template calls and entities."""

from __future__ import annotations

import re
from html.entities import html5

# Interwiki prefixes and the projects they stand for.
PROJECTS = {
    "w": "wikipedia", "wikipedia": "wikipedia", "s": "wikisource", "wikisource": "wikisource", "wikt": "wiktionary", "wiktionary": "wiktionary",
    "c": "commons", "commons": "commons", "q": "wikiquote", "wikiquote": "wikiquote",
}
# Further prefixes, kept under their own name.
OTHER_PROJECTS = {"b", "n", "v", "m", "meta", "d", "wikidata", "voy", "species"}
_LANGUAGE = re.compile(r"[a-z]{2,3}", re.ASCII)


def _project(title: str) -> tuple[str | None, str]:
    """The project that the first prefix names, and what follows it; (None, title) where it names none."""
    prefix, colon, rest = title.partition(":")
    name = prefix.strip().lower()
    site = PROJECTS.get(name, name if name in OTHER_PROJECTS else None)
    return (site, rest.strip()) if colon and site else (None, title)


def page_ref(target: str) -> dict[str, str | None]:
    """{site, lang, title, fragment} of a link target: one project prefix at most, then one language at most."""
    title, mark, fragment = target.strip().lstrip(":").strip().partition("#")
    site, rest = _project(title.strip())
    prefix, colon, tail = rest.partition(":")
    known = bool(colon and _LANGUAGE.fullmatch(prefix))
    return {"site": site or "wikiquote", "lang": prefix if known else "en", "title": tail.strip() if known else rest, "fragment": fragment.strip() if mark else None}


def display_title(target: str) -> str:
    """What a link without a label shows: the title without project and fragment."""
    return _project(target.strip().lstrip(":").strip().partition("#")[0])[1].strip()


def split_top(text: str, mark: str = "|") -> list[str]:
    """Cuts at marks that aren't inside brackets or braces."""
    parts, depth, start, i = [], 0, 0, 0
    while i < len(text):
        two = text[i : i + 2]
        if two in ("{{", "[["):
            depth, i = depth + 1, i + 2
        elif two in ("}}", "]]"):
            depth, i = max(0, depth - 1), i + 2
        else:
            if text[i] == mark and not depth:
                parts.append(text[start:i])
                start = i + 1
            i += 1
    return [*parts, text[start:]]


def template_call(raw: str) -> dict:
    """{name, params, wikitext} of a ``{{...}}`` text; unnamed arguments are numbered among themselves."""
    head, *args = split_top(raw[2:-2])
    params, count = [], 0
    for a in args:
        key, eq, value = a.partition("=")
        if eq and "[[" not in key and "{{" not in key:
            params.append({"key": key.strip(), "value": value.strip()})
        else:
            count += 1
            params.append({"key": str(count), "value": a.strip()})
    return {"name": head.strip().replace("_", " ").lower(), "params": params, "wikitext": raw}


def param(call: dict, key: str) -> str | None:
    return next((p["value"] for p in call["params"] if p["key"] == key), None)


def shown_text(call: dict, title: str) -> str:
    """What the templates that carry words put on the page; nothing for all others."""
    name = call["name"]
    one, two = param(call, "1") or None, param(call, "2") or None
    if name == "pagename":
        return title
    if name in ("w", "wikipedia-inline"):
        return two or one or ""
    if name == "lang":
        return two or ""
    if name in ("smallcaps", "sc", "small", "big", "nowrap", "center", "resize"):
        return one or ""
    if name == "isbn":
        return f"ISBN {one}" if one else ""
    return {"nbsp": " ", "pb": "\n", "pbr": "\n", "line": "\n", "-": "\n"}.get(name, "")


def entity(raw: str) -> str:
    """Numeric and named entities that end with a semicolon; anything else stays as it is."""
    body = raw[1:-1]
    if body.startswith("#"):
        try:
            code = int(body[2:], 16) if body[1:2] in "xX" else int(body[1:])
            return raw if 0xD800 <= code <= 0xDFFF else chr(code)
        except (ValueError, OverflowError):
            return raw
    return html5.get(body + ";", raw)
