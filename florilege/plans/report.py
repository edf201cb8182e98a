"""The coverage report: what share of quotes names a speaker, a source, a work and a date, and what the reader left over."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from florilege.functions import rules


def share(part: Column, whole: Column) -> Column:
    """Percent with one decimal, halves away from zero; 0.0 of nothing."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(F.round(F.lit(1000.0) * part / whole) / 10.0)


def counts_by(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n"))


def parse_totals(pages: DataFrame) -> DataFrame:
    """One row: pages, error nodes, pages with errors, source and unassigned lines and their share."""
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    t = pages.agg(F.count("*").alias("pages"), total("error_nodes").alias("error_nodes"), F.count_if(F.col("error_nodes") > 0).alias("pages_with_errors"), total("source_lines").alias("source_lines"), total("unassigned_lines").alias("unassigned_lines"))
    return t.withColumn("unassigned_share", share(F.col("unassigned_lines"), F.col("source_lines")))


def coverage(quotes: DataFrame) -> DataFrame:
    """Per page type, and over all (page_type null, ``overall`` 1): counts and shares, in one pass with grouping sets.

    Columns: overall, page_type, quotes, with_speaker, with_source, complete, with_work, with_date, unparsed_annotations and the
    shares speaker_share, source_share, complete_share, work_share, date_share."""
    flags = quotes.select(
        "page_type",
        F.col("speaker.name").isNotNull().alias("a"), F.col("source.raw").isNotNull().alias("b"), F.coalesce(F.col("source.complete"), F.lit(False)).alias("c"),
        F.col("source.work_title").isNotNull().alias("d"), F.col("source.date_iso").isNotNull().alias("e"), F.coalesce(F.col("provenance.unparsed_annotations"), F.lit(0)).cast("bigint").alias("u"),
    )
    named = {"a": "with_speaker", "b": "with_source", "c": "complete", "d": "with_work", "e": "with_date"}
    grouped = flags.rollup("page_type").agg(
        F.grouping("page_type").cast("int").alias("overall"), F.count("*").alias("quotes"), *[F.count_if(k).alias(v) for k, v in named.items()], F.sum("u").alias("unparsed_annotations")
    )
    shares = {"with_speaker": "speaker_share", "with_source": "source_share", "complete": "complete_share", "with_work": "work_share", "with_date": "date_share"}
    return grouped.select("*", *[share(F.col(k), F.col("quotes")).alias(v) for k, v in shares.items()])


def headings(blocks: DataFrame) -> DataFrame:
    """(heading, sections) of headings that mean neither a role nor a hint."""
    own = blocks.where("block_type = 'section'").select(F.element_at("path", -1).alias("p"))
    other = own.where((rules.role_of(F.col("p.text")) == "other") & rules.source_hint(F.col("p.text"), F.col("p.wikitext").startswith("''")).isNull() & (F.col("p.text") != ""))
    return other.groupBy(F.col("p.text").alias("heading")).agg(F.count("*").alias("sections"))


def top_headings(found: DataFrame, k: int = 40) -> DataFrame:
    """The most frequent, most first, equals by name."""
    return found.orderBy(F.desc("sections"), F.asc("heading")).limit(k)


def build(pages: DataFrame, quotes: DataFrame, blocks: DataFrame) -> dict:
    """The report as one nested value. The driver gets grouped counts only: a row per page type, kind or status, and k headings."""
    as_map = lambda df, c: {r[0]: r["n"] for r in counts_by(df, c).where(F.col(c).isNotNull()).orderBy(c).collect()}
    rows = [r.asDict() for r in coverage(quotes).orderBy("overall", "page_type").collect()]
    return {
        "pages": {"by_type": as_map(pages, "page_type"), **parse_totals(pages).first().asDict()},
        "unclassified_headings": [r.asDict() for r in top_headings(headings(blocks)).collect()],
        "quotes": {
            "by_kind": as_map(quotes, "kind"), "by_status": as_map(quotes, "status"),
            "by_page_type": {r["page_type"]: {k: v for k, v in r.items() if k not in ("overall", "page_type")} for r in rows if not r["overall"]},
            "overall": next(({k: v for k, v in r.items() if k not in ("overall", "page_type")} for r in rows if r["overall"]), {}),
        },
    }
