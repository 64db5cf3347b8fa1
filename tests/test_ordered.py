import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stocklens.operators import latest, ordered


@pytest.mark.parametrize("seed", [1, 2])
def test_global_running_sum_with_hot_ties(spark, seed):
    rng = random.Random(seed)
    data = [(i, 7 if rng.random() < 0.4 else rng.randint(-5, 500)) for i in range(3000)]
    df = spark.createDataFrame(data, "id INT, v BIGINT").repartition(5)
    got = ordered.prefix_sum(df, {"run": "v", "n": F.lit(1).cast("bigint")}, [F.desc("v"), F.asc("id")]).collect()
    expected, total = {}, 0
    for i, (key, v) in enumerate(sorted(data, key=lambda t: (-t[1], t[0]))):
        total += v
        expected[key] = (total, i + 1)
    assert {r["id"]: (r["run"], r["n"]) for r in got} == expected


@pytest.fixture
def many_chunks(spark):
    """Small inputs keep their range partitions, so that sums carry over from chunk to chunk."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_grouped_running_sum_with_one_hot_group(spark, many_chunks):
    rng = random.Random(3)
    data = [(None if rng.random() < 0.1 else ("hot" if rng.random() < 0.6 else f"g{rng.randint(0, 40)}"), i, rng.randint(1, 9)) for i in range(4000)]
    df = spark.createDataFrame(data, "g STRING, id INT, v BIGINT")
    got = {r["id"]: r["run"] for r in ordered.prefix_sum(df, {"run": "v"}, [F.asc("id")], ["g"]).collect()}
    sums, expected = {}, {}
    for g, i, v in data:
        sums[g] = sums.get(g, 0) + v
        expected[i] = sums[g]
    assert got == expected


def test_row_rank(spark):
    ids = list(range(500))
    random.Random(1).shuffle(ids)
    df = spark.createDataFrame([(i,) for i in ids], "id INT")
    assert all(r["row_rank"] == r["id"] for r in ordered.row_rank(df, [F.asc("id")]).collect())


def test_quantiles_match_numpy(spark, many_chunks):
    rng = random.Random(9)
    data = [("hot" if rng.random() < 0.5 else f"k{rng.randint(0, 5)}", None if rng.random() < 0.05 else round(rng.gauss(50, 20), 1)) for _ in range(3000)]
    data += [("single", 4.0)] + [(None, float(i)) for i in range(50)]
    df = spark.createDataFrame(data, "k STRING, v DOUBLE")
    probs = {"q1": 0.25, "med": 0.5, "p90": 0.9}
    got = {r["k"]: r for r in ordered.exact_quantiles(df, ["k"], "v", probs).collect()}
    for k in {d[0] for d in data}:
        values = [v for kk, v in data if kk == k and v is not None]
        for name, p in probs.items():
            assert got[k][name] == pytest.approx(np.quantile(values, p), abs=1e-9)


def test_weighted_quantiles_equal_repeated_rows(spark):
    df = spark.createDataFrame([("a", 1.0, 3), ("a", 2.0, 1), ("a", 9.0, 4)], "k STRING, v DOUBLE, n BIGINT")
    got = ordered.exact_quantiles(df, ["k"], "v", {"m": 0.5}, weight="n").first()["m"]
    assert got == np.quantile([1, 1, 1, 2, 9, 9, 9, 9], 0.5)


def test_densify(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 3, 2), ("b", 2, 7)], "k STRING, m INT, q BIGINT")
    got = sorted(tuple(r) for r in ordered.densify(df, ["k"], "m", "q").collect())
    assert got == [("a", 1, 5), ("a", 2, 0), ("a", 3, 2), ("b", 1, 0), ("b", 2, 7), ("b", 3, 0)]


def test_densify_nulls_and_repeats_and_zeros_that_are_not_shuffled(spark):
    rows = [("a", 3, 2), ("a", 1, None), ("a", None, 4), ("a", 3, 1), (None, 2, 7), ("c", None, None), ("d", 5, 0)]
    df = spark.createDataFrame(rows, "k STRING, m INT, q INT")
    dense = ordered.densify(df, ["k"], "m", "q")
    sold = {("a", 3): 3, (None, 2): 7, ("a", None): 4, ("c", None): None}
    expected = {(k, m): sold.get((k, m), 0) for k in ("a", None, "c", "d") for m in (1, 2, 3, 5)} | {g: sold[g] for g in (("a", None), ("c", None))}
    got = [tuple(r) for r in dense.collect()]
    assert len(got) == len(expected) and {(k, m): q for k, m, q in got} == expected
    assert dense.schema["q"].dataType.simpleString() == "bigint"
    plan = dense._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" in plan and "Exchange" not in plan[: plan.index("Generate")]


def test_latest_row_keeps_nulls_and_last_non_null_does_not(spark):
    rows = [(1, 1, "2024-01-01", 5, 7), (1, 1, "2024-02-01", 6, None), (2, 1, "2024-01-15", None, 1)]
    df = spark.createDataFrame(rows, "part_id INT, dealer_id INT, d STRING, a INT, b INT")
    newest = {r["part_id"]: (r["d"], r["a"], r["b"]) for r in latest.latest_row(df, "d").collect()}
    assert newest == {1: ("2024-02-01", 6, None), 2: ("2024-01-15", None, 1)}
    filled = {r["part_id"]: (r["a"], r["b"]) for r in latest.last_non_null(df, "d", ["a", "b"]).collect()}
    assert filled == {1: (6, 7), 2: (None, 1)}
    cut = latest.latest_row(df.withColumn("d", F.to_date("d")), "d", ["a"], as_of="2024-01-31")
    assert {r["part_id"]: r["a"] for r in cut.collect()} == {1: 5, 2: None}
