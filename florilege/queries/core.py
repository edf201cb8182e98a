"""Queries of the general training-data problems (1, 2, 3, 5) and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from florilege.functions.text import is_blank
from florilege.operators.nested import SECTION_STEPS, flatten_array, flatten_json
from florilege.operators.quality import drift, profile, unfit, unfit_date, unfit_label
from florilege.operators.skew import distinct_per_key
from florilege.operators.timestamps import normalise_dates
from florilege.queries.core_sql import SQL as SQL
from florilege.session import spread_few, table


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalise_dates(table(spark, sf_dir, "sources"), "source_id", "date_raw", "date_iso", "lang_tag", "venue_zone")


def p1_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the whole operator makes of texts of digits only and of ISO days, which SQL can read too."""
    sources = table(spark, sf_dir, "sources")
    text = F.when(is_blank(F.col("date_raw")), F.col("date_iso")).otherwise(F.col("date_raw"))
    plain = sources.where(text.rlike(r"\A(?:[1-9][0-9]{3}|[1-9][0-9]{7}|[1-9][0-9]{9}|[1-9][0-9]{12}|[1-9][0-9]{13}|[1-9][0-9]{3}-[0-9]{2}-[0-9]{2})\z")).select("source_id")
    return p1_found(spark, sf_dir).join(plain, "source_id", "left_semi")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, quotes = table(spark, sf_dir, "wiki_pages"), table(spark, sf_dir, "quotes")
    page = flatten_json(pages, "revision_id", "sections", SECTION_STEPS, "s").select(F.lit("page").alias("root_kind"), "*")
    notes = flatten_array(quotes, "quote_no", "annotations", "a")
    parts = flatten_array(quotes, "quote_no", "source.parts", "p")
    return page.unionByName(notes.unionByName(parts).select(F.lit("quote").alias("root_kind"), "*"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    quotes = table(spark, sf_dir, "quotes").where("page_title is not null")
    return distinct_per_key(quotes, ["page_title", "page_type"], "id", "quote_no", "n_ids")


def _quote_rules() -> dict:
    return {
        "source.date_iso": unfit_date(F.col("source.date_iso"), F.col("source.date_precision"), F.col("loaded_at")),
        "source.work_title": unfit_label(F.col("source.work_title")),
        "speaker.name": unfit_label(F.col("speaker.name")),
    }


def _present(rules: dict) -> dict:
    return {k: F.col(k).isNotNull() & v for k, v in rules.items()}


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unfit(table(spark, sf_dir, "quotes"), "quote_no", _present(_quote_rules()))


def p5_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile(spread_few(table(spark, sf_dir, "quotes")), "load_no", _present(_quote_rules())).withColumnRenamed("load", "load_no")


def p5_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    quotes = spread_few(table(spark, sf_dir, "quotes"))
    return drift(quotes, "quote_no", "load_no", _present(_quote_rules()), skip=["quote_no", "loaded_at"])


QUERIES = {f.__name__: f for f in (p1_found, p1_plain, p2_found, p3_found, p5_found, p5_profile, p5_drift)}
