import random

from florilege.operators.skew import distinct_per_key, numbered


def test_distinct_per_key(spark, rows):
    r = random.Random(4)
    data = [("hot", "t", f"i{r.randrange(30)}", n) for n in range(900)] + [(f"k{r.randrange(9)}", r.choice(["a", None]), r.choice([None, "x", "y"]), 1000 + n) for n in range(300)]
    data += [("same", "t", "only", 2000 + n) for n in range(500)] + [(None, None, "z", 5000)]
    df = spark.createDataFrame(data, "title string, kind string, id string, no bigint").selectExpr("*", "1 as v", "2 as k0")
    want = {}
    for t, k, i, _ in data:
        want.setdefault((t, k), set()).update({i} - {None})
    for size in (7, 100_000):
        got = rows(distinct_per_key(df, ["title", "kind"], "id", "no", "n", chunk_rows=size))
        assert got == sorted(((t, k, len(s)) for (t, k), s in want.items()), key=repr)
    assert distinct_per_key(df.limit(0), ["title"], "id", "no", "n").count() == 0


def test_numbers_are_exact(spark):
    df = spark.createDataFrame([("a" if n % 3 else "b", n % 7, n) for n in range(2000)], "k string, v int, t int").repartition(5)
    seen = {}
    for r in numbered(df, ["k"], ["v", "t"]).collect():
        seen.setdefault(r["k"], {})[r["_rank"]] = (r["v"], r["t"])
    for k, ranks in seen.items():
        assert sorted(ranks) == list(range(len(ranks)))
        ordered = [ranks[i] for i in range(len(ranks))]
        assert ordered == sorted(ordered)
