"""Tables, shared storage and skew helpers used by every operator."""

from __future__ import annotations

import atexit
import io
import tempfile
import uuid
import zipfile
from pathlib import Path
from weakref import WeakKeyDictionary

from pyspark.errors import utils as errors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_written: list[tuple[SparkSession, str]] = []
_shipped: set[str] = set()
_path_of: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table ``name`` below ``sf_dir``."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def put_file(spark: SparkSession, uri: str, data: bytes) -> None:
    """Writes ``data`` through Spark's file system layer."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(uri)
    out = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(at)
    out.write(data)
    out.close()


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once an application, so that workers can import it wherever they run.

    Also turns off PySpark's record of the call site of every column expression: for plans of thousands of them it
    costs more of the driver than all else."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    if hasattr(errors, "_enable_debugging_cache"):  # the setting, spark.python.sql.dataFrameDebugging.enabled, is a static one
        errors._enable_debugging_cache = False
    here = Path(__file__).parent
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(here.rglob("*.py")):
            z.write(f, f.relative_to(here.parent))
    uri = f"{shared_path(spark, 'code')}/florilege.zip"
    put_file(spark, uri, buffer.getvalue())
    spark.sparkContext.addPyFile(uri)
    _shipped.add(app)


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``. Only on one machine (a local master: tests) may it
    be unset; then a temporary folder is made and set for the session. On a cluster that is an error."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="florilege-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def shared_path(spark: SparkSession, tag: str) -> str:
    """A new path in the shared folder, removed when the driver ends."""
    path = f"{shared_dir(spark)}/florilege/{tag}-{uuid.uuid4().hex}"
    if not _written:
        atexit.register(_remove_written)
    _written.append((spark, path))
    return path


def _remove(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def _remove_written() -> None:
    for spark, path in _written:
        try:
            _remove(spark, path)
        except Exception:  # the session is gone; the cluster's own clean-up has to do
            return


def written(df: DataFrame, tag: str) -> DataFrame:
    """``df`` as a parquet table in the shared folder: cuts the lineage and survives the loss of executors."""
    spark = df.sparkSession
    path = shared_path(spark, tag)
    df.write.option("compression", "zstd").parquet(path)
    table_ = spark.read.schema(df.schema).parquet(path)
    _path_of[table_] = path
    return table_


def dropped(*tables: DataFrame | str, spark: SparkSession | None = None) -> None:
    """Removes tables made by ``written``, or paths of ``shared_path`` in ``spark``, whose last reader has been written itself."""
    for t in tables:
        session, path = (spark, t) if isinstance(t, str) else (t.sparkSession, _path_of.pop(t, None))
        if path and (session, path) in _written:
            _written.remove((session, path))
            _remove(session, path)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` over a number of tasks that follows the cluster's cores, for stages that cost much CPU for few bytes:
    adaptive execution would join their small partitions to one or two tasks."""
    spark = df.sparkSession
    n = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(n, *keys)


def spread_few(df: DataFrame) -> DataFrame:
    """``df`` spread over the cluster if it has fewer partitions than there are cores (one row group is one task). For
    scans: counting the partitions of a frame with a shuffle would run it."""
    return spread(df) if df.rdd.getNumPartitions() < df.sparkSession.sparkContext.defaultParallelism else df


#: A key with more rows than this share of all, and than this number, is hot.
_HOT_SHARE, _HOT_ROWS = 1_000, 10_000


def hot_keys(counts: DataFrame, keys: list[str], n: str = "n") -> list[int]:
    """Digests of the keys that hold more than a thousandth of all rows: fewer than 1,000, whatever the size of the data.
    ``counts`` has a row per key and its number of rows in ``n``; it should be a written table."""
    total = counts.agg(F.sum(n)).first()[0] or 0
    if total <= _HOT_ROWS:
        return []
    rows = counts.where(F.col(n) > max(_HOT_ROWS, total / _HOT_SHARE)).select(F.xxhash64(*keys)).collect()
    return [r[0] for r in rows]


def salted_join(big: DataFrame, small: DataFrame, keys: list[str], spread: str, hot: list[int], how: str = "inner", salts: int = 32) -> DataFrame:
    """Equi-join in which the ``hot`` keys (of ``hot_keys``) of ``big`` go to ``salts`` tasks each: their rows of ``small``
    are repeated once per salt, those of ``big`` take the salt from a hash of the column ``spread``. All other keys are
    joined plainly. ``how``: inner, left, left_semi."""
    if not hot:
        return big.join(small, keys, how)
    salt, is_hot = "_salt", F.xxhash64(*keys).isin(hot)
    b = big.withColumn(salt, F.when(is_hot, F.pmod(F.xxhash64(F.lit(17), spread), F.lit(salts)).cast("int")).otherwise(0))
    s = small.withColumn(salt, F.explode(F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))))
    return b.join(s, [*keys, salt], how).drop(salt)


def most_frequent(counts: DataFrame, value: str, limit: int) -> list:
    """Values of the table ``counts`` (value, n) that occur most often, at most ``limit``, most frequent first.

    Tasks don't each send their own best: a histogram of counts in bins of a sixteenth of an octave (some hundred rows
    at most) gives the least count that keeps the list within the limit, and only values from there on are collected.
    """
    bin_of = F.floor(F.log2(F.col("n").cast("double")) * 16).cast("int")
    bins = {r["b"]: r["c"] for r in counts.groupBy(bin_of.alias("b")).agg(F.count("*").alias("c")).collect()}
    total, least = 0, None
    for b in sorted(bins, reverse=True):
        if total + bins[b] > limit:
            break
        total, least = total + bins[b], b
    if least is None:
        return []
    rows = counts.where(bin_of >= least).select(value, "n").collect()
    return [r[0] for r in sorted(rows, key=lambda r: (-r[1], r[0]))]
