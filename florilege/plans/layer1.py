"""Layer 1: pages to flat blocks. The one Python step of the pipeline."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from florilege import schema
from florilege.functions import rules
from florilege.session import spread

#: Characters of markup that are parsed before rows are sent on.
_CHARS = 2_000_000


def _arrow(ddl: str) -> pa.Schema:
    return to_arrow_schema(T.StructType.fromDDL(ddl)) if hasattr(T.StructType, "fromDDL") else to_arrow_schema(T._parse_datatype_string(ddl))


def parse_pages(pages: DataFrame, wiki_language: str = "en", evenly: bool = False) -> DataFrame:
    """Blocks of all pages (title, page_id, revision_id, timestamp, text).

    A row per page (block_type 'page', with its bytes, lines that aren't blank, slips and lines that gave nothing), section and block. Null texts are
    empty pages. ``evenly`` spreads the pages over the cluster first, for sources of few partitions.
    """
    fields = _arrow(schema.BLOCKS)
    names = fields.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from florilege.wikitext.page import Page

        rows, size = [], 0
        for b in batches:
            for title, page_id, revision_id, timestamp, text in zip(*(b.column(i).to_pylist() for i in range(5))):
                p = Page(text or "", title or "")
                common = {"wiki_language": wiki_language, "title": title, "page_id": page_id, "revision_id": revision_id, "timestamp": timestamp, "categories": p.categories, "lead_templates": p.lead_templates}
                top = {"block_type": "page", "block_index": -1, "section_ord": -1, "path": [], "error_nodes": p.errors, "unassigned_lines": p.skipped, "bytes": len((text or "").encode("utf-8", "surrogatepass")), "source_lines": sum(1 for x in p.lines if x.strip())}
                rows += [dict.fromkeys(names) | common | r for r in [top, *p.rows]]
                size += len(text or "")
                if size > _CHARS:
                    yield pa.RecordBatch.from_pylist(rows, schema=fields)
                    rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=fields)

    src = pages.select("title", F.col("page_id").cast("long"), F.col("revision_id").cast("long"), F.col("timestamp").cast("string"), "text")
    return (spread(src) if evenly else src).mapInArrow(run, schema.BLOCKS)


def typed_pages(blocks: DataFrame) -> DataFrame:
    """A row per page: page_type and evidence, categories, interwiki, parse counts."""
    pages = blocks.where("block_type = 'page'")
    kind = rules.page_type(F.col("categories"), F.col("lead_templates"), F.col("title"))
    return pages.withColumn("_t", kind).select(
        "wiki_language", "title", "page_id", "revision_id", "timestamp", F.col("_t.page_type").alias("page_type"), F.col("_t.evidence").alias("page_type_evidence"),
        "categories", F.col("lead_templates").alias("templates"), rules.interwiki_of(F.col("lead_templates"), F.col("title")).alias("interwiki"), "error_nodes", "unassigned_lines", "bytes", "source_lines",
    )
