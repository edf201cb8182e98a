"""Explicit schemas of the tables that the engine writes and reads."""

from __future__ import annotations

PAGE_REF = "struct<site:string,lang:string,title:string,fragment:string>"
PARAMS = "array<struct<key:string,value:string>>"
SPAN = f"struct<start:int,end:int,kind:string,shown:string,site:string,lang:string,title:string,fragment:string,url:string,name:string,params:{PARAMS},wikitext:string,note:string>"
RICH = f"struct<text:string,wikitext:string,spans:array<{SPAN}>>"
TEMPLATE = f"struct<name:string,params:{PARAMS},wikitext:string>"
PATH = f"array<struct<level:int,text:string,wikitext:string,spans:array<{SPAN}>>>"

#: One page as a dump has it.
RAW_PAGE = "title string, ns int, page_id bigint, redirect_to string, revision_id bigint, timestamp string, text string"

#: Layer 1: a row per page (block_type 'page'), section and block, with the page's own columns carried along.
BLOCKS = (
    "wiki_language string, title string, page_id bigint, revision_id bigint, timestamp string, "
    f"categories array<string>, lead_templates array<{TEMPLATE}>, "
    f"section_ord int, path {PATH}, block_index int, block_type string, rt {RICH}, annotations array<struct<depth:int,rt:{RICH}>>, "
    f"turns array<struct<speaker:string,speaker_link:{PAGE_REF},rt:{RICH},is_stage_direction:boolean>>, template {TEMPLATE}, "
    f"media struct<file:string,caption:{RICH},caption_attribution:string>, wikitext string, "
    "error_nodes int, unassigned_lines int, bytes bigint, source_lines int"
)

AGENT = "struct<name:string,kind:string,link_site:string,link_lang:string,link_title:string,played_by:string>"
CITE = f"struct<name:string,params:{PARAMS}>"
PART = "struct<origin:string,level:smallint,hint:string,raw:string>"

#: Fields of the assembled source that parts of a citation fill in, with their types.
SOURCE_FIELDS = {
    "work_title": "string", "work_type": "string", "work_year": "int", "work_link_site": "string", "work_link_title": "string",
    "episode_series": "string", "episode_season": "int", "episode_number": "string", "episode_title": "string",
    "date_iso": "string", "date_end_iso": "string", "date_precision": "string", "date_raw": "string",
    "locator_page": "string", "locator_chapter": "string", "locator_part": "string", "locator_act_scene": "string", "locator_line": "string",
    "publication": "string", "publisher": "string", "isbn": "string", "url": "string", "occasion": "string",
}
SOURCE = f"struct<raw:string,complete:boolean,parts:array<{PART}>," + ",".join(f"{k}:{v}" for k, v in SOURCE_FIELDS.items()) + f",cite_templates:array<{CITE}>>"

#: Layer 2: one row per quote.
QUOTES = (
    "id string, content_hash string, wiki_language string, page_title string, page_id bigint, page_type string, revision_id bigint, text string, wikitext string, "
    f"language string, language_from string, kind string, status string, speaker {AGENT}, about array<{AGENT}>, source {SOURCE}, context_path array<string>, "
    "annotations array<struct<kind:string,text:string,wikitext:string>>, translations array<struct<text:string,language:string,translator:string,is_original:boolean>>, "
    f"links array<{PAGE_REF}>, provenance struct<speaker_from:string,source_from:string,status_from:string,unparsed_annotations:smallint>"
)
