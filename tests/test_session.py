import subprocess
import sys
from pathlib import Path

from pyspark.sql import functions as F

from florilege.operators.skew import distinct_per_key
from florilege.session import dropped, hot_keys, most_frequent, salted_join, shared_dir, spread, written


def test_most_frequent(spark):
    df = spark.createDataFrame([(f"v{i}", n) for i, n in enumerate([900, 800, 40, 40, 7, 2, 2, 2, 2])], "v string, n bigint")
    assert most_frequent(df, "v", 4) == ["v0", "v1", "v2", "v3"]
    assert most_frequent(df, "v", 3) == ["v0", "v1"]  # ties that don't all fit are left out together
    assert most_frequent(df, "v", 100)[:2] == ["v0", "v1"] and most_frequent(df.limit(0), "v", 5) == []


def test_salted_join(spark, rows):
    big = spark.createDataFrame([("a", i) for i in range(50)] + [("b", 1), (None, 2)], "k string, i bigint")
    small = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "k string, w bigint")
    for hot in ([], [r[0] for r in small.where("k = 'a'").select(F.xxhash64("k")).collect()]):
        for how in ("inner", "left_semi", "left"):
            assert rows(salted_join(big, small, ["k"], "i", hot, how)) == rows(big.join(small, "k", how))
    counts = spark.createDataFrame([("a", 40_000), ("b", 9_000), ("c", 30)], "k string, n bigint")
    assert hot_keys(counts, ["k"]) == hot_keys(counts.where("k = 'a'"), ["k"]) and len(hot_keys(counts, ["k"])) == 1
    assert hot_keys(counts.where("k <> 'a'"), ["k"]) == [] and hot_keys(counts.limit(0), ["k"]) == []


def test_dropped_tables_are_gone(spark):
    a, b = written(spark.range(3), "a"), written(spark.range(3), "b")
    at = [Path(t.inputFiles()[0].removeprefix("file://")).parent for t in (a, b)]
    dropped(a, spark.range(1))
    assert not at[0].exists() and at[1].exists() and b.count() == 3


def test_written_tables_keep_rows(spark, rows):
    df = spark.range(5).withColumn("s", F.struct(F.lit(None).cast("string").alias("x")))
    assert rows(written(df, "t")) == rows(df) and rows(spread(df)) == rows(df) and shared_dir(spark) == shared_dir(spark)


def test_counting_plan_has_no_python_and_no_window_over_rows(spark):
    df = spark.createDataFrame([("a", "x", 1)], "k string, v string, t bigint")
    plan = distinct_per_key(df, ["k"], "v", "t", "n")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_core_imports_without_the_text_operators():
    root = Path(__file__).resolve().parent.parent
    code = "import sys; sys.modules['florilege.llm'] = None; import __spark_entry__ as e; names = e.queries(); assert 'p3_found' in names and 'p8_ids' not in names"
    assert subprocess.run([sys.executable, "-c", code], cwd=root).returncode == 0


def test_every_sql_has_a_query():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
