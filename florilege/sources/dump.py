"""MediaWiki XML exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from florilege.functions.text import trim_u

_SCHEMA = "title string, ns string, id string, redirect struct<_title:string>, revision struct<id:string,timestamp:string,text:string>"


def _shape(xml: DataFrame) -> DataFrame:
    number = lambda c, t: F.expr(f"try_cast({c} as {t})")
    x = xml.select("title", trim_u(F.col("ns")).alias("ns"), trim_u(F.col("id")).alias("id"), "redirect", "revision", trim_u(F.col("revision.id")).alias("rid"))
    return x.select(
        "title", F.coalesce(number("ns", "int"), F.lit(0)).alias("ns"), number("id", "bigint").alias("page_id"), F.col("redirect._title").alias("redirect_to"),
        number("rid", "bigint").alias("revision_id"), F.col("revision.timestamp").alias("timestamp"), F.coalesce("revision.text", F.lit("")).alias("text"),
    )


#: A reference that XML doesn't define, or a lone ampersand: it stays in the text as it is written.
_UNDEFINED = r"&(?!(?:lt|gt|amp|apos|quot|#[0-9]+|#[xX][0-9A-Fa-f]+);)"


def _pages(reader, path: str) -> DataFrame:
    # a record is what stands before a closing tag, so a large export is read by many tasks, also as bz2
    value = F.col("value")
    found = reader.format("text").option("lineSep", "</page>").load(path).where(F.contains(value, F.lit("<page")))
    one = F.concat(F.substring(value, F.locate("<page", value), F.length(value)), F.lit("</page>"))
    # FAILFAST: broken XML ends the run and isn't half read
    page = F.from_xml(F.regexp_replace(one, _UNDEFINED, "&amp;"), _SCHEMA, {"rowTag": "page", "ignoreSurroundingSpaces": "false", "mode": "FAILFAST"})
    return _shape(found.select(page.alias("p")).select("p.*"))


def read_dump(spark: SparkSession, path: str) -> DataFrame:
    """All pages of the exports at ``path`` (also compressed): title, ns, page_id, redirect_to, revision_id, timestamp, text.

    A namespace that isn't a number is 0; ids that aren't are null; undefined entities are kept as text.
    """
    return _pages(spark.read, path)


def stream_dump(spark: SparkSession, path: str) -> DataFrame:
    """The same as a stream over files that arrive in the folder ``path``."""
    return _pages(spark.readStream, path)


def content(pages: DataFrame) -> DataFrame:
    """Pages of the main namespace that aren't redirects."""
    return pages.where("ns = 0 and redirect_to is null")


def redirects(pages: DataFrame) -> DataFrame:
    """(from, to) of the redirects of the main namespace."""
    return pages.where("ns = 0 and redirect_to is not null").select(F.col("title").alias("from"), F.col("redirect_to").alias("to"))


def resolve(titles: DataFrame, column: str, redirect_map: DataFrame) -> DataFrame:
    """Adds ``resolved``: the page that a title redirects to, or the title itself. One step; the least target of several counts."""
    one = redirect_map.groupBy("from").agg(F.min("to").alias("_to"))
    return titles.join(one, titles[column] == one["from"], "left").drop("from").withColumn("resolved", F.coalesce("_to", column)).drop("_to")
