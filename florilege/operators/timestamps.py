"""Mixed timestamp formats: one dictionary of distinct strings, read once, joined back."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from florilege.functions.text import is_blank
from florilege.session import dropped, hot_keys, salted_join, shared_path, spread, written

#: What the reading of a text depends on: the text itself, the order of day and month, the zone of the place.
_KEY = ["text", "month_first", "zone"]
_SCHEMA = T.StructType(
    [
        T.StructField("text", T.StringType()),
        T.StructField("month_first", T.BooleanType()),
        T.StructField("zone", T.StringType()),
        T.StructField("date_norm", T.StringType()),
    ]
)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from florilege.functions.dates import normal_date

    for b in batches:
        text, first, zone = (b.column(i).to_pylist() for i in range(3))
        norm = [normal_date(t, f, z or None) for t, f, z in zip(text, first, zone)]
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(norm, pa.string())], _SCHEMA.names)


class DateDictionary:
    """A growing table of distinct (text, order, zone) and their one normal form, at ``path`` or else in the session's part
    of the shared folder.

    ``update`` reads only values that the table doesn't hold yet, so every string is parsed once, however many rows or
    loads it comes with; a further load costs one anti-join. Each update is a folder of its own, written under a name of its own and
    seen only once it is whole. Two writers at one time may both add a string; ``table`` gives each once (its form
    depends on nothing else), so neither loses nor doubles rows of the other.
    """

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark = spark
        self.path = (path or shared_path(spark, "dates")).rstrip("/")

    def _parts(self) -> list[str]:
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs
        at = hadoop.Path(self.path)
        fs = at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        found = [s.getPath().toString() for s in fs.listStatus(at)] if fs.exists(at) else []
        return sorted(p for p in found if fs.exists(hadoop.Path(f"{p}/_SUCCESS")))

    def table(self) -> DataFrame | None:
        parts = self._parts()
        if not parts:
            return None
        known = self.spark.read.schema(_SCHEMA).parquet(*parts)
        return known if len(parts) == 1 else known.dropDuplicates(_KEY)

    def update(self, keys: DataFrame) -> DataFrame:
        """Adds what is new in ``keys`` (one row per text, month_first and zone)."""
        new = keys.select(*_KEY)
        if (known := self.table()) is not None:
            new = new.join(known.select(*_KEY), _KEY, "left_anti")
        spread(new).mapInArrow(_read, _SCHEMA).write.option("compression", "zstd").parquet(f"{self.path}/{uuid.uuid4().hex}")
        return self.table()


def normalise_dates(df: DataFrame, id_col: str, raw: str, fallback: str, lang: str, zone: str, dictionary: DateDictionary | None = None) -> DataFrame:
    """(id, date_norm) of each row whose text names a real date.

    The text is ``raw``, or ``fallback`` where ``raw`` is null or blank. All-numeric dates have the month first only
    for language tag en-US. Rows with a null id keep it; rows without a readable date give no row; repeated rows
    give repeated rows; blank or null zones mean UTC; an empty table gives no rows; other columns are ignored.

    Texts with a third of all rows cost nothing extra: they are one row of the dictionary, and in the join back the
    rows of a hot text are spread by salts. ``dictionary`` keeps what was read from one load to the next.
    """
    text = F.when(is_blank(F.col(raw)), F.col(fallback)).otherwise(F.col(raw))
    rows = df.select(
        F.col(id_col).alias("_id"),
        F.when(~is_blank(text), text).alias("text"),
        F.coalesce(F.col(lang) == "en-US", F.lit(False)).alias("month_first"),
        F.coalesce(F.trim(zone), F.lit("")).alias("zone"),
    ).where("text is not null")
    counts = written(rows.groupBy(*_KEY).agg(F.count("*").alias("n")), "texts")
    known = (dictionary or DateDictionary(df.sparkSession)).update(counts).where("date_norm is not null")
    hot = hot_keys(counts, _KEY)
    dropped(counts)
    return salted_join(rows, known, _KEY, "_id", hot).select(F.col("_id").alias(id_col), "date_norm")
