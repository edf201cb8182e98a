"""Sinks and readers of the layers: zstd Parquet with bounded row groups, gzip JSON Lines, the report's JSON."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from florilege import schema
from florilege.session import put_file


def write_quotes(quotes: DataFrame, path: str, by_type: bool = False) -> None:
    """Quotes as Parquet: zstd level 3, at most 100,000 rows a row group; optionally a folder per page type for pruning."""
    w = quotes.write.mode("overwrite").option("compression", "zstd").option("parquet.compression.codec.zstd.level", "3").option("parquet.block.row.count.limit", "100000")
    (w.partitionBy("page_type") if by_type else w).parquet(path)


def read_quotes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schema.QUOTES).parquet(path)


def write_blocks(blocks: DataFrame, path: str) -> None:
    blocks.write.mode("overwrite").option("compression", "zstd").parquet(path)


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schema.BLOCKS).parquet(path)


def write_json_lines(df: DataFrame, path: str) -> None:
    """A JSON object per line, gzip level 3; fields that are null are left out."""
    df.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("value")).write.mode("overwrite").option("compression", "gzip").option("zlib.compress.level", "THREE").text(path)


def read_json_lines(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """JSON Lines (also gzip) under an explicit schema; nothing is inferred."""
    return spark.read.schema(ddl).json(path)


def write_report(spark: SparkSession, report: dict, path: str) -> None:
    """The report as indented JSON, through Spark's file system layer (any URI that the cluster knows)."""
    put_file(spark, path, (json.dumps(report, indent=2, ensure_ascii=False) + "\n").encode())
