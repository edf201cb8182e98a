"""Column-level quality profile: exact aggregates, unfit values, and drift between loads.

Three results share one reading of the table: ``profile`` (exact null rates, distinct counts, ranges and unfit
counts of each column and load), ``unfit`` (the rows behind the unfit counts) and ``drift`` (a classifier two-sample
test: a logistic regression is trained over the cluster to tell one load from the next; where it does better than
chance on rows it hasn't seen, the loads differ, and leaving a column's features out tells which columns changed).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from florilege.functions.text import WS
from florilege.session import written

# Texts that only say that a value is missing, without brackets, dots and spaces around, lower case.
MISSING = [
    "n/a", "n.a", "na", "n/k", "nil", "null", "none", "nan", "not given", "not available", "not applicable", "not known", "not stated",
    "not specified", "unspecified", "unknown", "undefined", "missing", "no data", "no title", "no name", "untitled", "tbd", "tba",
    "tbc", "to be determined", "to be announced", "xxx", "citation needed", "source needed",
    "empty", "blank", "no value", "keine angabe", "k.a", "unbekannt", "inconnu", "desconocido", "s.n", "s.t",
]


_EDGE = r"[\s\p{Z}\p{P}<>]"


def missing_sign(c: Column) -> Column:
    """Whether a text only says that the value is missing: one of MISSING, or no letter or digit at all."""
    core = F.lower(F.regexp_replace(c, rf"^{_EDGE}+|(?<!{_EDGE}){_EDGE}+$", ""))
    return core.isin(MISSING) | ~c.rlike(r"[\p{L}\p{N}]")


# Patterns of markup, entities, control and mis-decoded characters, web and mail addresses. A repeated part
# never goes past the character that may start a match, so long texts cost their length.
_MARKUP = r"\[\[|\]\]|\{\{|\}\}|''|<!--|-->|</?[A-Za-z][^<>]*>|<[A-Za-z]+\s*/?$|^=++[^=]++=+$|\{\||\|\}|__[A-Z]+__|\[https?:"
_ENTITY = r"&(?:[A-Za-z][A-Za-z0-9]+|#[0-9]+|#[xX][0-9A-Fa-f]+);"
_CONTROL = r"[\p{Cc}\x{FFFD}\x{FEFF}\x{FFFE}\x{FFFF}\p{Co}]"
_MISDECODED = r"[\x{C2}\x{C3}][\x{80}-\x{BF}\x{152}\x{153}\x{160}\x{161}\x{178}\x{17D}\x{17E}\x{192}\x{2C6}\x{2DC}\x{2013}-\x{2022}\x{2026}\x{2030}\x{2039}\x{203A}\x{20AC}\x{2122}]|\x{E2}\x{20AC}|\x{EF}\x{BB}\x{BF}|\x{EF}\x{BF}\x{BD}"
_ADDRESS = r"(?i)[a-z0-9]://\S|\bwww\.[^\s.]+\.\S|\bmailto:|[^\s@<>()]@[^\s@<>()]+\.[a-z]{2}"


def unfit_label(c: Column) -> Column:
    """Whether a title or name doesn't fit; null for null."""
    edge = f"^{WS}|{WS}$"
    parts = "|".join(f"(?:{p})" for p in (_MARKUP, _ENTITY, _CONTROL, _MISDECODED))
    return missing_sign(c) | c.rlike(edge) | c.rlike(parts) | c.rlike(_ADDRESS) | (c == "")


def unfit_date(c: Column, precision: Column, loaded_at: Column) -> Column:
    """Whether a date text isn't of its precision's form, isn't in the calendar or lies after the load's year."""
    y = F.try_to_number(F.regexp_extract(c, r"^-?(\d{4})", 1), F.lit("9999")).cast("int")
    m = F.try_to_number(F.regexp_extract(c, r"^-?\d{4}-(\d{2})", 1), F.lit("99")).cast("int")
    d = F.try_to_number(F.regexp_extract(c, r"^-?\d{4}-\d{2}-(\d{2})$", 1), F.lit("99")).cast("int")
    form = (
        F.when(precision == "day", c.rlike(r"\A-?\d{4}-\d{2}-\d{2}\z"))
        .when(precision == "month", c.rlike(r"\A-?\d{4}-\d{2}\z"))
        .otherwise(c.rlike(r"\A-?\d{4}\z"))
    )
    leap = ((y % 4 == 0) & (y % 100 != 0)) | (y % 400 == 0)
    days = F.when(m.isin(4, 6, 9, 11), 30).when(m == 2, F.when(leap, 29).otherwise(28)).otherwise(31)
    real = (
        (y >= 1)
        & F.when(precision.isin("day", "month"), m.between(1, 12)).otherwise(F.lit(True))
        & F.when(precision == "day", d.between(1, 31) & (d <= days)).otherwise(F.lit(True))
    )
    late = ~c.startswith("-") & (y > F.year(loaded_at))
    return ~F.coalesce(form & real, F.lit(False)) | F.coalesce(late, F.lit(False))


def leaves(schema: T.StructType, prefix: str = "") -> list[tuple[str, T.DataType]]:
    """Dotted names and types of all columns, structs opened; arrays and maps stay whole."""
    found: list[tuple[str, T.DataType]] = []
    for f in schema.fields:
        name = f"{prefix}`{f.name}`"
        if isinstance(f.dataType, T.StructType):
            found += leaves(f.dataType, f"{name}.")
        else:
            found.append((name, f.dataType))
    return found


def _shown(name: str) -> str:
    return name.replace("`", "")


def _text(name: str, kind: T.DataType) -> Column:
    c = F.col(name)
    if isinstance(kind, (T.ArrayType, T.MapType)):
        return F.to_json(c)
    if isinstance(kind, T.BinaryType):
        return F.hex(c)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return c.cast("string")


def unfit_rules(df: DataFrame, rules: dict[str, Column]) -> Column:
    """An array of the fields (keys of ``rules``) whose value is non-null and doesn't fit."""
    return F.array_compact(F.array(*[F.when(F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()]))


def unfit(df: DataFrame, id_col: str, rules: dict[str, Column]) -> DataFrame:
    """(id, field) of each non-null value that breaks its field's rule.

    Nulls are never unfit; empty and blank texts are as the rule says; texts are read whole; repeated rows give
    repeated rows; an empty table gives none; other columns don't matter.
    """
    return df.select(F.col(id_col), F.explode(unfit_rules(df, rules)).alias("field"))


def _ranges(df: DataFrame, load: str, columns: list[tuple[str, Column]]) -> DataFrame:
    """(_c, _l, lo, hi, xlo, xhi): least and greatest value of each column (texts by bytes, numbers by value) and load.

    Batches are reduced as columns: an aggregate of texts over rows would first sort all rows by load."""

    names = [n for n, _ in columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple] = {}
        kind = None
        for b in batches:
            loads = b.column(0)
            kind = loads.type
            for k in pc.unique(loads).to_pylist():
                part = b.filter(pc.is_null(loads) if k is None else pc.equal(loads, pa.scalar(k, kind)))
                for c in range(len(names)):
                    lo, hi = pc.min_max(part.column(c + 1)).as_py().values()
                    if lo is not None:
                        old = held.get((c, k), (lo, hi))
                        held[c, k] = min(lo, old[0]), max(hi, old[1])
        if held:
            texts = [(None, None) if isinstance(lo, float) else (lo, hi) for lo, hi in held.values()]
            numbers = [(lo, hi) if isinstance(lo, float) else (None, None) for lo, hi in held.values()]
            out = [pa.array([names[c] for c, _ in held]), pa.array([k for _, k in held], kind)]
            out += [pa.array([t[i] for t in texts], pa.string()) for i in (0, 1)] + [pa.array([x[i] for x in numbers], pa.float64()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays(out, ["_c", "_l", "lo", "hi", "xlo", "xhi"])

    src = df.select(F.col(load), *[c.alias(f"c{i}") for i, (_, c) in enumerate(columns)])
    found = src.mapInArrow(run, f"_c string, _l {src.schema[0].dataType.simpleString()}, lo string, hi string, xlo double, xhi double")
    return found.groupBy("_c", "_l").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.min("xlo").alias("xlo"), F.max("xhi").alias("xhi"))


#: Bytes up to which a value stands for itself; longer ones are told apart by a digest.
_DIGEST = 16


def profile(df: DataFrame, load: str, rules: dict[str, Column]) -> DataFrame:
    """Exact aggregates of every column and load.

    Columns: column, load, n_rows, n_null, null_rate, n_distinct, min_value, max_value, n_unfit. Structs are opened; arrays
    count as their JSON text. Values over 16 bytes are told apart by a 128-bit digest; ranges are of the whole texts
    (numbers by value for numeric columns; of arrays and maps the number of elements). Null loads are a load of their own; an empty table gives no rows.

    The table is read twice. Melted to (column, load, value or digest) it is aggregated twice: a value that a third of all rows have is summed
    up before it is shuffled, and no (column, load) is ever gathered. Whole texts go into the ranges only: two a column, load and task reach the shuffle.
    """
    cols = [(n, k) for n, k in leaves(df.schema) if _shown(n) != load]
    # texts are made once, as columns of their own
    broken = {n: F.coalesce(rules[n], F.lit(False)) for n in (_shown(n) for n, _ in cols) if n in rules}
    texts = df.select(F.col(load).alias("load"), *[_text(n, k).alias(f"t{i}") for i, (n, k) in enumerate(cols)], *[c.alias(f"bad {n}") for n, c in broken.items()])
    items, ranges = [], []
    for i, (name, kind) in enumerate(cols):
        number = isinstance(kind, T.NumericType)
        text = F.col(f"t{i}")
        items.append(
            F.struct(
                F.lit(i).alias("c"),
                F.when(F.octet_length(text) > _DIGEST, F.unhex(F.md5(text))).otherwise(text.cast("binary")).alias("v"),
                (F.col(f"`bad {_shown(name)}`").cast("int") if _shown(name) in broken else F.lit(0)).alias("bad"),
            )
        )
        held = F.when(F.col(name).isNotNull(), F.size(name)).cast("double") if isinstance(kind, (T.ArrayType, T.MapType)) else _text(name, kind)
        ranges.append((_shown(name), F.col(name).cast("double") if number else held))
    melted = texts.select("load", F.explode(F.array(*items)).alias("i")).select(F.col("i.c").alias("column"), "load", "i.v", "i.bad")
    values = melted.groupBy("column", "load", "v").agg(F.count("*").alias("n"), F.sum("bad").alias("bad"))
    counts = values.groupBy("column", "load").agg(
        F.sum("n").alias("n_rows"), F.sum(F.when(F.col("v").isNull(), F.col("n")).otherwise(0)).alias("n_null"), F.count("v").alias("n_distinct"), F.sum("bad").alias("n_unfit")
    )
    counts = counts.withColumn("column", F.element_at(F.array(*[F.lit(_shown(n)) for n, _ in cols]), F.col("column") + 1))
    extent = _ranges(df, load, ranges)
    out = counts.join(extent, (F.col("column") == F.col("_c")) & F.col("load").eqNullSafe(F.col("_l")), "left")
    as_text = lambda x: F.when(x == F.floor(x), F.floor(x).cast("long").cast("string")).otherwise(x.cast("string"))
    return out.select(
        F.col("column"), F.col("load"), "n_rows", "n_null",
        F.round(F.col("n_null") / F.col("n_rows"), 6).alias("null_rate"),
        "n_distinct",
        F.coalesce(as_text(F.col("xlo")), F.col("lo")).alias("min_value"),
        F.coalesce(as_text(F.col("xhi")), F.col("hi")).alias("max_value"),
        "n_unfit",
    )


#: Features of a column: null, unfit (empty where there is no rule), log length or scaled number, and hashed value buckets.
_BUCKETS = 4


def _features(df: DataFrame, rules: dict[str, Column], load: str, skip: list[str]) -> tuple[list[str], Column]:
    names, cols = [], []
    for name, kind in leaves(df.schema):
        shown = _shown(name)
        if shown == load or shown in skip:
            continue
        text = _text(name, kind)
        size = F.log1p(F.coalesce(F.octet_length(text), F.lit(0)).cast("double")) / 4.0
        if isinstance(kind, T.NumericType):
            x = F.coalesce(F.col(name).cast("double"), F.lit(0.0))
            size = F.signum(x) * F.log1p(F.abs(x)) / 8.0
        rule = rules.get(shown)
        bad = F.coalesce(rule, F.lit(False)) if rule is not None else F.coalesce(text == "", F.lit(False))
        bucket = F.pmod(F.xxhash64(text), F.lit(_BUCKETS))
        # one column's features: null flag, unfit flag, size, bucket number (one-hot in numpy, -1 for null)
        names.append(shown)
        cols += [
            F.col(name).isNull().cast("double"),
            bad.cast("double"),
            size,
            F.when(text.isNull(), F.lit(-1.0)).otherwise(bucket.cast("double")),
        ]
    return names, F.array(*cols)


_PER = 3 + _BUCKETS


def _matrix(flat: np.ndarray, n_cols: int) -> np.ndarray:
    """Rows of (1, features...): ``flat`` has four numbers a column."""
    q = flat.reshape(len(flat), n_cols, 4)
    x = np.zeros((len(flat), n_cols, _PER))
    x[:, :, :3] = q[:, :, :3]
    x[:, :, 3:] = q[:, :, 3:4] == np.arange(_BUCKETS)
    return np.concatenate((np.ones((len(flat), 1)), x.reshape(len(flat), -1)), axis=1)


def _array_column(b: pa.RecordBatch, i: int, width: int) -> np.ndarray:
    return b.column(i).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _sides(load: np.ndarray, pairs: list[tuple[int, int]]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    for k, (old, new) in enumerate(pairs):
        at = np.flatnonzero((load == old) | (load == new))
        if len(at):
            yield k, at, (load[at] == new).astype(float)


def drift(df: DataFrame, id_col: str, load: str, rules: dict[str, Column], skip: list[str] = [], folds: int = 2, train_rows: int = 200_000, steps: int = 6, ridge: float = 1.0, bins: int = 4096) -> DataFrame:
    """Classifier two-sample test between each load and the one after it.

    One row per pair of loads and column, and one with column ``*`` for all columns together: old_load, new_load, column,
    n_old, n_new, auc (of scores on rows outside the training fold), auc_without (the column's features left out),
    drift (the difference). 0.5 means that the loads can't be told apart.

    All pairs and folds are trained at once by Newton steps with ridge penalty: each step is one pass in which
    tasks send the gradient and curvature of their rows (a fixed size: features squared), the driver solves. About
    ``train_rows`` rows, chosen by a hash of ``id_col``, are used to fit (the only bounded sample here); scores, AUC
    and ablation cover every row. Scores are counted in ``bins`` bins, ties within a bin count half.

    Rows with a null load are left out; a pair in which a load is empty can't occur; with fewer than two loads the
    result is empty. Columns named in ``skip`` aren't features.
    """
    spark = df.sparkSession
    schema = "old_load int, new_load int, column string, n_old bigint, n_new bigint, auc double, auc_without double, drift double"
    names, feats = _features(df, rules, load, skip)
    width, n_cols = 4 * len(names), len(names)
    base = df.where(F.col(load).isNotNull()).select(
        F.col(load).cast("int").alias("load"), F.pmod(F.xxhash64(F.lit(5), id_col), F.lit(folds)).cast("int").alias("fold"),
        F.pmod(F.xxhash64(F.lit(9), id_col), F.lit(1 << 30)).alias("pick"), feats.cast("array<float>").alias("f"),
    )
    base = written(base, "drift")
    counts = {r["load"]: r["n"] for r in base.groupBy("load").agg(F.count("*").alias("n")).collect()}  # one row a load
    loads = sorted(counts)
    pairs = list(zip(loads, loads[1:]))
    if not pairs:
        return spark.createDataFrame([], schema)
    share = min(1.0, train_rows / max(1, sum(counts.values())))
    # read once a step, by as many tasks as the sample needs and not as the table has
    fit = base.where(F.col("pick") < int(share * (1 << 30))).select("load", "fold", "f")
    fit = written(fit.repartition(max(1, round(share * sum(counts.values()) / 5_000))), "fit")
    dim, models = 1 + n_cols * _PER, len(pairs) * folds
    w = np.zeros((models, dim))

    def newton(weights: np.ndarray) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            g, h = np.zeros((models, dim)), np.zeros((models, dim, dim))
            seen = False
            for b in batches:
                seen = True
                lo, fo, x = b.column(0).to_numpy(), b.column(1).to_numpy(), _matrix(_array_column(b, 2, width), n_cols)
                for k, at, y in _sides(lo, pairs):
                    for fold in range(folds):
                        use = at[fo[at] != fold]
                        if not len(use):
                            continue
                        m, xs, ys = k * folds + fold, x[use], y[fo[at] != fold]
                        p = 1 / (1 + np.exp(-np.clip(xs @ weights[m], -30, 30)))
                        g[m] += xs.T @ (ys - p)
                        h[m] += (xs * (p * (1 - p))[:, None]).T @ xs
            if seen:
                for m in range(models):
                    yield pa.RecordBatch.from_arrays([pa.array([m]), pa.array([g[m].tobytes()], pa.binary()), pa.array([h[m].tobytes()], pa.binary())], ["m", "g", "h"])

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total: dict[int, list[np.ndarray]] = {}
            for b in batches:
                for m, g, h in zip(*(c.to_pylist() for c in b.columns)):
                    now = [np.frombuffer(g), np.frombuffer(h)]
                    total[m] = [a + c for a, c in zip(total[m], now)] if m in total else now
            for m, (g, h) in total.items():
                yield pa.RecordBatch.from_arrays([pa.array([m]), pa.array([g.tobytes()], pa.binary()), pa.array([h.tobytes()], pa.binary())], ["m", "g", "h"])

        out = "m bigint, g binary, h binary"
        parts = fit.select("load", "fold", "f").mapInArrow(run, out)
        # two levels of sums, so that no task gets the sums of all others; the driver gets one sum a model
        some = parts.repartition(F.col("m"), F.spark_partition_id() % 16).mapInArrow(add, out)
        return some.repartition("m").mapInArrow(add, out)

    for _ in range(steps):
        g, h = np.zeros((models, dim)), np.zeros((models, dim, dim))
        for r in newton(w).collect():  # one sum a model, of fixed size
            g[r["m"]] += np.frombuffer(r["g"])
            h[r["m"]] += np.frombuffer(r["h"]).reshape(dim, dim)
        for m in range(models):
            w[m] += np.linalg.solve(h[m] + ridge * np.eye(dim), g[m] - ridge * w[m])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lo, fo, x = b.column(0).to_numpy(), b.column(1).to_numpy(), _matrix(_array_column(b, 2, width), n_cols)
            tally: dict[tuple[int, int], np.ndarray] = {}
            for k, at, y in _sides(lo, pairs):
                ww = w.reshape(len(pairs), folds, dim)[k][fo[at]]
                part = (x[at] * ww)[:, 1:].reshape(len(at), n_cols, _PER).sum(axis=2)
                total = part.sum(axis=1) + ww[:, 0]
                for c in range(n_cols + 1):
                    s = total - part[:, c - 1] if c else total
                    p = np.minimum((bins / (1 + np.exp(-np.clip(s, -30, 30)))).astype(np.int64), bins - 1)
                    now = np.bincount(2 * p + y.astype(np.int64), minlength=2 * bins)
                    tally[k, c] = tally[k, c] + now if (k, c) in tally else now
            for (k, c), t in tally.items():
                at = np.flatnonzero(t)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), v, np.int32)) for v in (k, c)] + [pa.array((at // 2).astype(np.int32)), pa.array((at % 2).astype(np.int32)), pa.array(t[at].astype(np.int64))], ["k", "c", "bin", "side", "n"])

    hist = base.select("load", "fold", "f").mapInArrow(score, "k int, c int, bin int, side int, n bigint")
    hist = hist.groupBy("k", "c", "bin").agg(F.sum(F.when(F.col("side") == 0, F.col("n")).otherwise(0)).alias("n0"), F.sum(F.when(F.col("side") == 1, F.col("n")).otherwise(0)).alias("n1"))
    from pyspark.sql import Window

    upto = Window.partitionBy("k", "c").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    ranked = hist.withColumn("below", F.coalesce(F.sum("n0").over(upto), F.lit(0)))
    auc = ranked.groupBy("k", "c").agg(
        (F.sum(F.col("n1") * (F.col("below") + F.col("n0") / 2.0)) / (F.sum("n0") * F.sum("n1"))).alias("a"), F.sum("n0").alias("n_old"), F.sum("n1").alias("n_new")
    )
    whole = auc.where("c = 0").select(F.col("k").alias("k0"), F.col("a").alias("auc"))
    old = F.element_at(F.array(*[F.lit(p[0]) for p in pairs]), F.col("k") + 1)
    new = F.element_at(F.array(*[F.lit(p[1]) for p in pairs]), F.col("k") + 1)
    label = F.element_at(F.array(*[F.lit(n) for n in ["*", *names]]), F.col("c") + 1)
    return auc.join(whole, F.col("k") == F.col("k0")).select(
        old.alias("old_load"), new.alias("new_load"), label.alias("column"), "n_old", "n_new",
        F.round("auc", 6).alias("auc"), F.round("a", 6).alias("auc_without"), F.round(F.col("auc") - F.col("a"), 6).alias("drift"),
    )
