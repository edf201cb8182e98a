"""Per-key results without hot tasks: exact offset chunking.

Rows are laid out in one global order (keys, then value, then a tie column), so that a key of any weight runs
over as many partitions as its rows fill. Rows are counted per key and partition, the counts are summed to
offsets, each row gets its exact number within its key, and numbers are cut into chunks of equal size. A chunk
yields a small state (rows, distinct values, first and last value); neighbouring states of a key are merged in
order, and a value that runs over a boundary is counted once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from florilege.session import written

#: Bits that monotonically_increasing_id() leaves for the row number within a partition.
_ROW_BITS = 33


def numbered(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Adds ``_rank``: the row's exact number (from 0) within its key, in the order of ``order``.

    No window runs over a key. The rows are range-partitioned by keys and order, sorted, and written once with
    their position; a row's number is its distance from the first row of its key in the same partition plus the
    key's rows in all earlier partitions. ``order`` should end in a unique column: rows that tie in all of it
    get numbers in no defined order. Null keys form a key of their own. An empty table gives an empty result.
    """
    laid = (
        df.repartitionByRange(*[F.col(c) for c in [*keys, *order]])
        .sortWithinPartitions(*keys, *order)
        .withColumn("_at", F.monotonically_increasing_id())
    )
    laid = written(laid, "numbered").withColumn("_part", F.shiftright("_at", _ROW_BITS))
    counts = laid.groupBy(*keys, "_part").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    offsets = offsets.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_part").alias("_p"), "_first", "_offset")
    same = F.col("_part") == F.col("_p")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    joined = laid.join(offsets, same)
    return joined.withColumn("_rank", F.col("_offset") + F.col("_at") - F.col("_first")).select(*df.columns, "_rank")


def distinct_per_key(df: DataFrame, keys: list[str], value: str, tie: str, out: str, chunk_rows: int = 200_000) -> DataFrame:
    """Number of distinct non-null ``value`` of each key, by exact offset chunking.

    Args: ``tie`` is a column that tells rows of one value apart (any unique column); it lets one single value
    with a third of all rows run over many partitions. ``chunk_rows`` is the size of a chunk.

    Defined cases: rows with a null key are kept as a key; null values aren't counted, and a key with nothing
    else gets 0; repeated rows count once; an empty table gives no rows; further columns are ignored, whatever
    their names.
    """
    src = [F.col(k).alias(f"k{i}") for i, k in enumerate(keys)]
    rows = df.select(*src, F.col(value).alias("v"), F.col(tie).alias("t"))
    ks = [f"k{i}" for i in range(len(keys))]
    ranked = numbered(rows, ks, ["v", "t"])
    chunks = ranked.withColumn("_chunk", F.floor(F.col("_rank") / chunk_rows).cast("long"))
    states = chunks.groupBy(*ks, "_chunk").agg(F.count_distinct("v").alias("d"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    ordered = Window.partitionBy(*ks).orderBy("_chunk")
    merged = states.withColumn("again", F.coalesce((F.lag("hi").over(ordered) == F.col("lo")).cast("int"), F.lit(0)))
    return merged.groupBy(*ks).agg((F.sum("d") - F.sum("again")).cast("long").alias(out)).select(
        *[F.col(f"k{i}").alias(k) for i, k in enumerate(keys)], out
    )
