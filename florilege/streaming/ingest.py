"""Dumps as a stream: files that arrive in a folder are parsed and appended to layer 1."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from florilege.plans.layer1 import parse_pages
from florilege.session import ship
from florilege.sources.dump import content, stream_dump


def ingest(spark: SparkSession, folder: str, blocks_path: str, checkpoint: str, wiki_language: str = "en") -> StreamingQuery:
    """Parses what is new in ``folder`` and ends; each file is taken once, also after a failure."""
    ship(spark)
    blocks = parse_pages(content(stream_dump(spark, folder)), wiki_language)
    return blocks.writeStream.format("parquet").option("path", blocks_path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
