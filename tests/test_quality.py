import datetime

from pyspark.sql import functions as F

from florilege.operators.quality import drift, profile, unfit, unfit_date, unfit_label

GOOD = ["Fox & Rice", "The Half-built Lantern", "Æon", "R. U. R.", "Who's Who", "1984", "A < B", "AT&T; a story"]
BAD = ["", "  ", " x y", "Title\t", "x\u00a0", "N/A", "n/a", "none", "NULL", "tbd", "???", "—", "-", "[citation needed]", "{{w|A}}", "[[A|B]]", "<small>A", "A<br>", "O&amp;r", "A&#39;s", "a\x07b", "a\nb", "Ol\ufffd", "thÃ©e", "theâ€™ X", "https://a.example/1", "www.a.example", "bok@mail.example", "not given", "Unknown", "<ref " + "n" * 5000 + ">", "&" + "e" * 90 + ";", "www." + "a" * 400 + ".example", "x@" + "b" * 500 + ".example"]


def test_labels(spark):
    df = spark.createDataFrame([(v, v in BAD) for v in GOOD + BAD], "v string, bad boolean")
    assert df.where(unfit_label(F.col("v")) != F.col("bad")).collect() == []


def test_dates(spark):
    at = datetime.datetime(2025, 3, 1)
    cases = [
        ("2024-02-29", "day", False), ("2023-02-29", "day", True), ("1900-02-29", "day", True), ("2000-02-29", "day", False), ("1815-4-2", "day", True), ("2024-12", "month", False), ("2024-13", "month", True), ("2024", "year", False),
        ("2026", "year", True), ("2191-07", "month", True), ("-0492", "year", False), ("-11", "year", True), ("1810 ", "year", True), ("l000", "year", True), ("1800s", "decade", True), ("1800-1803", "range", True), ("1920", None, False),
        ("1920-01-01", None, True), ("", "year", True), ("0000", "year", True), ("2024-01-01\n", "day", True), ("١٩٢٠", "year", True),
    ]
    df = spark.createDataFrame([(d, p, at, b) for d, p, b in cases], "d string, p string, at timestamp, bad boolean")
    assert df.where(unfit_date(F.col("d"), F.col("p"), F.col("at")) != F.col("bad")).collect() == []


def test_unfit_and_profile(spark, rows):
    df = spark.createDataFrame([(1, "A", ("x",), 1), (2, None, None, 1), (3, "n/a", ("x",), 2), (3, "n/a", ("x",), 2), (4, "y" * 100_000, (None,), None)], "id bigint, name string, s struct<v:string>, load int")
    rules = {"name": unfit_label(F.col("name"))}
    assert rows(unfit(df, "id", rules)) == [(3, "name"), (3, "name")]
    got = {(r["column"], r["load"]): r for r in profile(df, "load", rules).collect()}
    r = got["name", 1]
    assert (r["n_rows"], r["n_null"], r["null_rate"], r["n_distinct"], r["min_value"], r["n_unfit"]) == (2, 1, 0.5, 1, "A", 0)
    assert got["name", 2]["n_unfit"] == 2 and got["s.v", 2]["n_distinct"] == 1 and got["id", None]["max_value"] == "4" and got["s.v", 1]["n_null"] == 1
    assert profile(df.limit(0), "load", rules).count() == 0 and unfit(df.limit(0), "id", rules).count() == 0


def test_drift_finds_the_changed_column(spark):
    base = spark.range(3000).select(F.col("id"), (F.col("id") % 3).cast("int").alias("load"), F.concat(F.lit("v"), (F.col("id") * 7919 % 50).cast("string")).alias("same"))
    df = base.withColumn("changed", F.when((F.col("load") == 2) & (F.col("id") % 4 < 2), None).otherwise(F.lit("x")))
    got = {(r["old_load"], r["new_load"], r["column"]): r for r in drift(df, "id", "load", {}, skip=["id"]).collect()}
    assert abs(got[0, 1, "*"]["auc"] - 0.5) < 0.06 and got[1, 2, "*"]["auc"] > 0.7
    assert got[1, 2, "changed"]["drift"] > 0.15 > abs(got[1, 2, "same"]["drift"])
    assert drift(df.where("load = 1"), "id", "load", {}, skip=["id"]).count() == 0


def test_planted_drift_is_found(spark):
    # one column changes between two loads, each time another one: nulls, lengths, unfit values, the mix of values; others stay as they are
    import random

    r = random.Random(4)
    columns, planted = "abcdef", {2: "a", 3: "b", 4: "c", 5: "d"}
    data, n = [], 0
    for load in range(1, 7):
        for _ in range(900):
            row = {c: r.choice("pqrs") * r.randrange(1, 6) for c in columns}
            if load >= 2 and r.random() < 0.5:
                row["a"] = None
            if load >= 3:
                row["b"] = row["b"] * 3
            if load >= 4 and r.random() < 0.4:
                row["c"] = "n/a"
            if load >= 5:
                row["d"] = r.choice(["pp", "qqq"])
            data.append((n, load, *(row[c] for c in columns)))
            n += 1
    df = spark.createDataFrame(data, "id bigint, load int, " + ", ".join(f"{c} string" for c in columns))
    got = {(x["new_load"], x["column"]): x for x in drift(df, "id", "load", {"c": unfit_label(F.col("c"))}, skip=["id"]).collect()}
    for new in range(2, 7):
        led = max(columns, key=lambda c: got[new, c]["drift"])
        if new in planted:
            assert led == planted[new] and got[new, "*"]["auc"] > 0.6 and got[new, led]["drift"] > 0.05
        else:
            assert got[new, "*"]["auc"] < 0.56
        assert all(abs(got[new, c]["drift"]) < 0.04 for c in columns if c != planted.get(new))
