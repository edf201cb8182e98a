"""The three steps from a dump to a report, each from files to files. Each returns its counters."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from florilege.plans import layer1, layer2, report
from florilege.session import dropped, shared_path, ship, written
from florilege.sources import dump, files
from florilege.sources.documents import read_documents, write_documents


def _layer1(spark: SparkSession, path: str, form: str) -> DataFrame:
    """Layer 1 as it was written: 'parquet' (flat blocks) or 'jsonl' (nested documents, which are flattened once)."""
    return files.read_blocks(spark, path) if form == "parquet" else written(read_documents(spark, path), "blocks")


def parse(spark: SparkSession, dump_path: str, blocks_path: str, redirects_path: str, wiki_language: str = "en", form: str = "parquet") -> dict[str, int]:
    """Dump to layer 1 (Parquet blocks, or documents as gzip JSON Lines) and the redirect map (gzip JSON Lines). Counters: pages, content, redirects.

    The dump is read once: its pages are written before they go to both branches, and counted on the way."""
    ship(spark)
    seen, main = Observation("pages"), F.col("ns") == 0
    pages = dump.read_dump(spark, dump_path).observe(
        seen, F.count("*").alias("pages"), F.count_if(main & F.col("redirect_to").isNull()).alias("content"), F.count_if(main & F.col("redirect_to").isNotNull()).alias("redirects")
    )
    path = shared_path(spark, "pages")
    pages.write.option("compression", "zstd").parquet(path)
    held = spark.read.schema(pages.schema).parquet(path)
    blocks = layer1.parse_pages(dump.content(held), wiki_language, evenly=True)
    if form == "parquet":
        files.write_blocks(blocks, blocks_path)
    else:
        parsed = written(blocks, "blocks")
        write_documents(parsed, blocks_path)
        dropped(parsed)
    files.write_json_lines(dump.redirects(held), redirects_path)
    dropped(path, spark=spark)
    return dict(seen.get)


def normalise(spark: SparkSession, blocks_path: str, quotes_path: str, form: str = "parquet") -> dict[str, int]:
    """Layer 1 to layer 2. Counters: documents, quotes."""
    ship(spark)
    blocks, made = _layer1(spark, blocks_path, form), Observation("quotes")
    files.write_quotes(layer2.quotes(blocks).observe(made, F.count("*").alias("quotes")), quotes_path)
    return {"documents": blocks.where("block_type = 'page'").count(), **made.get}


def make_report(spark: SparkSession, blocks_path: str, quotes_path: str, report_path: str, form: str = "parquet") -> dict:
    """Layers 1 and 2 to the report's JSON."""
    ship(spark)
    blocks = _layer1(spark, blocks_path, form)
    made = report.build(layer1.typed_pages(blocks), files.read_quotes(spark, quotes_path), blocks)
    files.write_report(spark, made, report_path)
    return made
