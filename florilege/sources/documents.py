"""Layer 1 as nested documents: a JSON object per page and line, with its sections and blocks as a tree, to flat blocks and back."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from florilege import schema
from florilege.functions import rules
from florilege.plans import layer1

_COMMON = ["wiki_language", "title", "page_id", "revision_id", "timestamp", "categories", "lead_templates"]
#: Sites that a reference names by a word; all others are written as {"other": name}.
_SITES = {"wikiquote", "wikipedia", "wikisource", "wiktionary", "commons"}
_SPAN = dict.fromkeys(("site", "lang", "title", "fragment", "url", "name", "params", "wikitext", "note"))
#: Rows that are sent on at a time.
_ROWS = 2_000


# documents to blocks


def _ref(x: dict | None) -> dict:
    x = x or {}
    site = x.get("site")
    return {"site": next(iter(site.values()), None) if isinstance(site, dict) else site, "lang": x.get("lang"), "title": x.get("title"), "fragment": x.get("fragment")}


def _call(x: dict) -> dict:
    pairs = [(p.get("key"), p.get("value")) if isinstance(p, dict) else tuple(p) for p in x.get("params") or ()]
    return {"name": x.get("name"), "params": [{"key": k, "value": v} for k, v in pairs], "wikitext": x.get("wikitext")}


def _rich(x: dict | str | None) -> dict | None:
    if x is None or isinstance(x, str):
        return x and {"text": x, "wikitext": x, "spans": []}
    text = x.get("text") or ""
    raw, spans = text.encode("utf-8", "surrogatepass"), []
    for s in x.get("spans") or ():
        kind = s.get("span")
        more = _ref(s.get("target")) if kind == "link" else {"url": s.get("url")} if kind == "external_link" else _call(s) if kind == "template" else {"note": s.get("text")} if kind in ("comment", "reference") else {}
        spans.append({**_SPAN, **more, "start": s["start"], "end": s["end"], "kind": kind, "shown": raw[s["start"] : s["end"]].decode("utf-8", "replace")})
    return {"text": text, "wikitext": x.get("wikitext") or "", "spans": spans}


def _notes(x: dict) -> list[dict]:
    return [{"depth": a.get("depth"), "rt": _rich(a.get("text"))} for a in x.get("annotations") or () if a]


def _block(x: dict) -> dict:
    kind = x.get("block")
    if kind == "quote":
        return {"block_type": "list_item", "rt": _rich(x.get("text")), "annotations": _notes(x)}
    if kind == "item":
        return {"block_type": "list_item", "rt": _rich(x), "annotations": []}
    if kind == "exchange":
        turns = [{"speaker": t.get("speaker"), "speaker_link": _ref(t["speaker_link"]) if t.get("speaker_link") else None, "rt": _rich(t.get("text")), "is_stage_direction": bool(t.get("is_stage_direction"))} for t in x.get("turns") or () if t]
        return {"block_type": kind, "turns": turns}
    if kind == "media":
        return {"block_type": kind, "media": {"file": x.get("file"), "caption": _rich(x.get("caption")), "caption_attribution": x.get("caption_attribution")}}
    return {"block_type": kind, **({"rt": _rich(x)} if kind == "paragraph" else {"template": _call(x)} if kind == "template" else {"wikitext": x.get("wikitext")} if kind == "table" else {})}


def _rows(d: dict) -> Iterator[dict]:
    parse = d.get("parse") or {}
    common = {k: d.get(k) for k in _COMMON[:5]} | {"categories": d.get("categories") or [], "lead_templates": [_call(t) for t in d.get("templates") or () if t]}
    yield common | {"block_type": "page", "block_index": -1, "section_ord": -1, "path": []} | {k: parse.get(k) for k in ("error_nodes", "unassigned_lines", "bytes", "source_lines")}
    if d.get("redirect_to"):
        return
    for i, b in enumerate(d.get("lead") or ()):
        if b:
            yield common | {"section_ord": 0, "path": [], "block_index": i} | _block(b)
    number, waiting = 0, [([], s) for s in reversed(d.get("sections") or ())]
    while waiting:
        path, s = waiting.pop()
        if not s:
            continue
        number += 1
        path = [*path, {"level": s.get("level"), **(_rich(s.get("heading")) or {"text": "", "wikitext": "", "spans": []})}]
        yield common | {"section_ord": number, "path": path, "block_index": 0, "block_type": "section"}
        for i, b in enumerate(s.get("blocks") or ()):
            if b:
                yield common | {"section_ord": number, "path": path, "block_index": i} | _block(b)
        waiting += [(path, x) for x in reversed(s.get("sections") or ())]


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Blocks of the documents at ``path`` (JSON Lines, also gzip). Empty lines give nothing; a line that isn't JSON ends the run.

    Fields left out and null are the same; null blocks keep their position and give no row."""
    fields = to_arrow_schema(T._parse_datatype_string(schema.BLOCKS))
    names = fields.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[dict] = []
        for b in batches:
            for line in b.column(0).to_pylist():
                if line and line.strip():
                    rows += [dict.fromkeys(names) | r for r in _rows(json.loads(line))]
                if len(rows) > _ROWS:
                    yield pa.RecordBatch.from_pylist(rows, schema=fields)
                    rows = []
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=fields)

    return spark.read.text(path).mapInArrow(run, schema.BLOCKS)


# blocks to documents


def _out(**fields) -> dict:
    """Without what is null or an empty list."""
    return {k: v for k, v in fields.items() if v is not None and v != []}


def _site(name: str) -> str | dict:
    return name if name in _SITES else {"other": name}


def _ref_out(x: dict) -> dict:
    return {"site": _site(x["site"]), "lang": x["lang"], "title": x["title"], **_out(fragment=x["fragment"])}


def _call_out(x: dict) -> dict:
    return {"name": x["name"], **_out(params=[[p["key"], p["value"]] for p in x["params"] or ()]), "wikitext": x["wikitext"]}


def _rich_out(x: dict) -> dict:
    spans = []
    for s in x["spans"] or ():
        kind = s["kind"]
        more = {"target": _ref_out(s)} if kind == "link" else {"url": s["url"]} if kind == "external_link" else _call_out(s) if kind == "template" else {"text": s["note"]} if kind in ("comment", "reference") else {}
        spans.append({"start": s["start"], "end": s["end"], "span": kind, **more})
    return {"text": x["text"], "wikitext": x["wikitext"], **_out(spans=spans)}


def _block_out(b: dict) -> dict:
    kind = b["block_type"]
    if kind == "list_item":
        if b["is_item"]:
            return {"block": "item", **_rich_out(b["rt"])}
        return {"block": "quote", "text": _rich_out(b["rt"]), **_out(annotations=[{"depth": a["depth"], "text": _rich_out(a["rt"]), "kind": k} for a, k in zip(b["annotations"] or (), b["kinds"] or ())])}
    if kind == "exchange":
        turns = [{**_out(speaker=t["speaker"], speaker_link=_ref_out(t["speaker_link"]) if t["speaker_link"] else None), "text": _rich_out(t["rt"]), "is_stage_direction": t["is_stage_direction"]} for t in b["turns"]]
        return {"block": kind, "turns": turns}
    if kind == "media":
        m = b["media"]
        return {"block": kind, "file": m["file"], **_out(caption=_rich_out(m["caption"]) if m["caption"] else None, caption_attribution=m["caption_attribution"])}
    return {"block": kind, **(_rich_out(b["rt"]) if kind == "paragraph" else _call_out(b["template"]) if kind == "template" else {"wikitext": b["wikitext"]} if kind == "table" else {})}


def _hint_out(h: dict) -> dict:
    fields = {"work": ("title", "year"), "episode": ("title", "code"), "season": ("number",), "period": ("from", "to")}.get(h["kind"], ())
    return {"hint": h["kind"], **({"kind": h["place"], "value": h["value"]} if h["kind"] == "locator" else {k: h[k] for k in fields})}


def _document(page: dict, blocks: list[dict]) -> dict:
    lead: list[dict] = []
    top: list[dict] = []
    open_: list[dict] = []  # sections that still take others, from the outside in
    sink = lead
    for b in sorted(blocks, key=lambda b: (b["section_ord"], b["block_type"] != "section", b["block_index"])):
        if b["block_type"] != "section":
            sink.append(_block_out(b))
            continue
        own, name = b["path"][-1], b["path"][-1]["text"].strip()
        value = {"alpha_bucket": {"value": name.upper() if name.isascii() else name}, "other": {"value": name}}.get(b["role"], {})
        s = {"level": own["level"], "heading": _rich_out(own), "role": {"role": b["role"], **value}, **_out(source_hint=_hint_out(b["hint"]) if b["hint"] else None), "blocks": [], "sections": []}
        open_ = open_[: len(b["path"]) - 1]
        (open_[-1]["sections"] if open_ else top).append(s)
        open_.append(s)
        sink = s["blocks"]

    def tidy(s: dict) -> dict:
        return {k: [tidy(x) for x in v] if k == "sections" else v for k, v in s.items() if v != []}

    return {
        **{k: page[k] for k in _COMMON[:5]}, "page_type": page["page_type"],
        **_out(page_type_evidence=page["page_type_evidence"], categories=page["categories"], templates=[_call_out(t) for t in page["templates"]], interwiki=[_ref_out(i) for i in page["interwiki"]], lead=lead, sections=[tidy(s) for s in top]),
        "parse": {k: page[k] or 0 for k in ("bytes", "error_nodes", "source_lines", "unassigned_lines")},
    }


def documents(blocks: DataFrame) -> DataFrame:
    """(value): each page's document as JSON. A page's blocks come together in one task, bounded by the page. Pages are told
    apart by page and revision; a revision with several 'page' rows would come out several times."""
    own = F.try_element_at("path", F.lit(-1))
    section = F.col("block_type") == "section"
    role = F.coalesce(F.try_element_at(F.transform("path", lambda p: rules.role_of(p["text"])), F.lit(-1)), F.lit("quotes"))
    rows = blocks.where("block_type <> 'page'").select(
        "page_id", "revision_id",
        F.struct(
            "section_ord", "block_index", "block_type", F.when(section, F.col("path")).alias("path"), "rt", "annotations", "turns", "template", "media", "wikitext",
            F.when(section, role).alias("role"), F.when(section, rules.source_hint(own["text"], own["wikitext"].startswith("''"))).alias("hint"),
            (role.isin(rules.LIST_ROLES) & (F.size(F.coalesce("annotations", F.array().cast(blocks.schema["annotations"].dataType))) == 0)).alias("is_item"),
            F.transform("annotations", lambda a: rules.annotation_kind(a["rt"])).alias("kinds"),
        ).alias("b"),
    )
    grouped = rows.groupBy("page_id", "revision_id").agg(F.collect_list("b").alias("blocks"))
    pages = layer1.typed_pages(blocks)
    both = pages.join(grouped.withColumnsRenamed({"page_id": "_p", "revision_id": "_r"}), F.col("page_id").eqNullSafe(F.col("_p")) & F.col("revision_id").eqNullSafe(F.col("_r")), "left").drop("_p", "_r")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for a in range(0, b.num_rows, 100):
                lines = [json.dumps(_document(r, r["blocks"] or []), ensure_ascii=False) for r in b.slice(a, 100).to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], ["value"])

    return both.mapInArrow(run, "value string")


def write_documents(blocks: DataFrame, path: str) -> None:
    """JSON Lines, gzip level 3."""
    documents(blocks).write.mode("overwrite").option("compression", "gzip").option("zlib.compress.level", "THREE").text(path)
