import numpy as np
import pytest

from almanack.functions.quantiles import exact_quantiles

P = {"q1": 0.25, "median": 0.5, "q3": 0.75, "p99": 0.99, "low": 0.0, "high": 1.0}


def check(spark, groups, cells, rows_at_once):
    data = [(g, float(v)) for g, values in groups.items() for v in values]
    df = spark.createDataFrame(data, "g string, v double").repartition(4)
    got = {r["g"]: r for r in exact_quantiles(df, ["g"], "v", P, cells, rows_at_once).collect()}
    assert set(got) == set(groups)
    for g, values in groups.items():
        for name, p in P.items():
            assert got[g][name] == pytest.approx(np.quantile(values, p), rel=1e-12, abs=1e-12)


def test_small_known_case(spark):
    df = spark.createDataFrame([("a", v) for v in (1.0, 2.0, 3.0, 10.0)], "g string, v double")
    assert exact_quantiles(df, ["g"], "v", {"q": 0.25}).first()["q"] == 1.75


@pytest.mark.parametrize("cells,rows_at_once", [(16, 40), (4096, 200_000)])
def test_distributions(spark, cells, rows_at_once):
    rng = np.random.default_rng(7)
    check(
        spark,
        {
            "normal": rng.normal(size=997),
            "tail": np.exp(rng.normal(size=800) * 6),
            "ties": rng.integers(0, 4, size=900).astype(float),
            "hot": np.r_[np.full(3000, 5.0), rng.normal(size=50)],
            "constant": np.full(20, -3.5),
            "single": np.array([42.0]),
            "huge": np.array([-1.7e308, 1.7e308, 0.0, 1.0, 2.0]) / 4,
        },
        cells,
        rows_at_once,
    )


def test_missing_values_are_left_out_and_empty_groups_vanish(spark):
    rows = [("a", 1.0), ("a", None), ("a", float("nan")), ("a", 3.0), ("b", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    assert [tuple(r) for r in exact_quantiles(df, ["g"], "v", {"m": 0.5}).collect()] == [("a", 2.0)]


def test_infinite_bounds_end_the_search(spark):
    values = [float("-inf"), float("inf"), *map(float, range(99))]
    df = spark.createDataFrame([("a", v) for v in values], "g string, v double")
    assert exact_quantiles(df, ["g"], "v", {"m": 0.5}, 8, 10).first()["m"] == 49.0


def test_a_null_group_is_a_group(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0), ("a", 9.0)], "g string, v double")
    got = {r["g"]: r["m"] for r in exact_quantiles(df, ["g"], "v", {"m": 0.5}).collect()}
    assert got == {None: 1.5, "a": 9.0}


def test_a_key_is_required(spark):
    with pytest.raises(ValueError):
        exact_quantiles(spark.range(3).toDF("v"), [], "v", {"m": 0.5})
