import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from almanack import schemas as S
from almanack.operators import profiling as P
from conftest import rows
from fixtures import Source, month


@pytest.fixture(scope="module")
def silver(spark):
    source = Source()
    rng = np.random.default_rng(3)
    for code in ("AAA", "BBB"):
        for year in (2019, 2020):
            for m in range(1, 13):
                values = rng.lognormal(size=3)
                source.generation(code, year, [m], Gas=values[0], Solar=values[1], Net_imports=-values[2])
                source.demand(code, year, rng.uniform(1, 9), [m])
                source.intensity(code, year, rng.uniform(50, 500), [m])
    return source.silver(spark)


def test_column_profile(spark, silver):
    df = silver["generation"]
    profile = {r["column"]: r for r in P.column_profile(df, "generation", S.BUSINESS_KEYS["generation"]).collect()}
    pdf = df.toPandas().sort_values(["entity_code", "date", "series"])
    assert set(profile) == set(df.columns)
    for column, row in profile.items():
        assert row["row_count"] == len(pdf) and row["null_count"] == 0 and row["null_pct"] == 0.0
        assert row["unique_values"] == pdf[column].nunique()
    assert profile["series"]["sample_values"] == "Gas, Net imports, Solar"
    assert profile["date"]["sample_values"].startswith("2019-01-01 00:00:00, 2019-02-01")


def test_profile_counts_nulls_and_nan(spark):
    df = spark.createDataFrame([(1, None), (2, float("nan")), (3, 5.0)], "k int, v double")
    row = {r["column"]: r for r in P.column_profile(df, "x", ["k"]).collect()}["v"]
    assert (row["null_count"], row["unique_values"], row["null_pct"]) == (2, 1, 66.67)


def test_coverage_and_empty_dataset(spark, silver):
    got = {r["dataset"]: tuple(r)[1:] for r in P.dataset_coverage({"demand": silver["demand"]}).collect()}
    assert got["demand"] == (48, 2, month(2019, 1), month(2020, 12))
    with pytest.raises(Exception, match="is empty"):
        P.dataset_coverage({"capacity": silver["capacity"]}).collect()


def test_describe_equals_pandas(spark, silver):
    want = silver["demand"].toPandas()["demand_twh"].describe()
    got = P.describe_measures({"demand": silver["demand"]}).first()
    for ours, theirs in (("count", "count"), ("mean", "mean"), ("min", "min"), ("q1", "25%"), ("median", "50%"), ("q3", "75%"), ("max", "max")):
        assert got[ours] == pytest.approx(want[theirs], abs=1e-6)
    assert got["std"] == pytest.approx(want["std"], abs=1e-4)


def test_unusual_rows(spark, silver):
    generation = silver["generation"]
    assert P.unusual_rows(generation).count() == 48
    top = P.unusual_rows_top(generation, 30)
    assert top.count() == 30
    breakdown = P.unusual_breakdown(generation).collect()
    assert [(r["series"], r["observations"], r["negative_generation"]) for r in breakdown] == [
        ("Net imports", 48, 48)
    ]


def test_iqr_screen_equals_pandas(spark, silver):
    components = P.components(silver["generation"])
    pdf = components.toPandas()
    got = {r["series"]: r for r in P.iqr_screen(components).collect()}
    assert set(got) == {"Gas", "Solar"}
    box = {r["series"]: r for r in P.boxplot_stats(components).collect()}
    for series, group in pdf.groupby("series"):
        v = group["generation_twh"]
        q1, q3 = v.quantile(0.25), v.quantile(0.75)
        low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        outside = (v < low) | (v > high)
        assert got[series]["outlier_count"] == outside.sum()
        assert got[series]["q1"] == pytest.approx(q1, abs=0.006)
        assert box[series]["upper_whisker"] == v[~outside].max()
        assert box[series]["median"] == pytest.approx(v.median(), abs=1e-6)


def test_nan_is_missing_and_stays_in_the_denominator(spark):
    values = [*map(float, range(1, 11)), float("nan"), None, 100.0]
    df = spark.createDataFrame([("s", v) for v in values], "series string, generation_twh double")
    row = P.iqr_screen(df).first()
    assert (row["outlier_count"], row["outlier_pct"]) == (1, round(100 / 13, 2))
    box = P.boxplot_stats(df).first()
    assert (box["max"], box["upper_whisker"]) == (100.0, 10.0)
    flagged = df.withColumn("share_of_generation_pct", F.lit(float("nan")))
    assert P.unusual_breakdown(flagged).count() == 0


def test_seasonality_and_yearly_means(spark, silver):
    pdf = silver["demand"].toPandas()
    got = {r["year"]: r["avg_monthly_demand_twh"] for r in P.demand_intensity_yearly(silver["demand"], silver["carbon_intensity"], "AAA").collect()}
    want = pdf[pdf.entity_code == "AAA"].groupby(pdf.date.dt.year)["demand_twh"].mean()
    assert got == pytest.approx(want.to_dict(), abs=1e-6)
    assert P.seasonality(P.components(silver["generation"])).count() == 24


def test_mix_correlation_and_trend(spark):
    rng = np.random.default_rng(5)
    share = rng.uniform(10, 90, size=12)
    intensity = 3 * share + rng.normal(size=12)
    source = Source()
    for m, (s, i) in enumerate(zip(share, intensity), start=1):
        for name, value in (("Fossil", s), ("Clean", 100 - s)):
            source.rows["generation"].append(
                ("Land", "AAA", False, month(2019, m), name, True, 1.0, float(value))
            )
        source.intensity("AAA", 2019, i, [m])
    silver = source.silver(spark)
    mix = P.mix_by_date(silver["generation"], silver["carbon_intensity"], "AAA")
    corr = {r["variable"]: r for r in P.mix_correlation(mix).collect()}
    want = np.corrcoef(share, intensity)[0, 1]
    assert corr["fossil_share_pct"]["emissions_intensity_gco2_per_kwh"] == pytest.approx(want, abs=1e-6)
    assert corr["clean_share_pct"]["fossil_share_pct"] == pytest.approx(-1.0)
    line = P.intensity_trend(mix).first()
    slope, intercept = np.polyfit(share, intensity, 1)
    assert (line["slope"], line["intercept"]) == pytest.approx((slope, intercept), abs=1e-5)
    assert P.mix_correlation(mix.limit(2)).count() == 0 and P.intensity_trend(mix.limit(2)).count() == 0
    double = silver["generation"].unionByName(silver["generation"])
    with pytest.raises(Exception, match="several"):
        P.mix_by_date(double, silver["carbon_intensity"], "AAA").collect()


def test_ranking_states_the_months_behind_it(spark):
    silver = Source().intensity("AAA", 2019, 300).intensity("BBB", 2019, 100, range(1, 4)).silver(spark)
    got = [tuple(r)[1:] for r in P.country_ranking(silver["carbon_intensity"], 2019).collect()]
    assert got == [("BBB", 100.0, 3), ("AAA", 300.0, 12)]


def test_raw_coverage(spark):
    df = spark.createDataFrame(
        [(dt.date(2019, 1, 1), 1.0), (dt.date(2019, 1, 1), None), (dt.date(2019, 3, 1), float("nan"))],
        "date date, v double",
    )
    assert tuple(P.raw_coverage(df, ["v"]).first()) == (3, 2, dt.date(2019, 1, 1), dt.date(2019, 3, 1), 2)


def test_profile_csv(spark, silver, tmp_path):
    profile = P.column_profile(silver["demand"], "demand", ["entity_code", "date"])
    P.write_profile_csv(profile, str(tmp_path / "p"))
    back = pd.concat(pd.read_csv(f) for f in (tmp_path / "p").glob("*.csv"))
    assert list(back.columns) == profile.columns and len(back) == 4


def scans(run, source):
    """How many of the executed plans read the source."""
    import almanack.functions.quantiles as Q

    seen, original = [], Q.hand_over

    def watch(df, name):
        seen.append(source in df._jdf.queryExecution().optimizedPlan().toString())
        return original(df, name)

    patched = [(m, m.hand_over) for m in (Q, P)]
    for module, _ in patched:
        module.hand_over = watch
    try:
        result = run()
        seen.append(source in result._jdf.queryExecution().optimizedPlan().toString())
        result.collect()
    finally:
        for module, old in patched:
            module.hand_over = old
    return sum(seen)


def test_distributions_scan_their_source_once(spark, tmp_path):
    rows = [("a", float(i % 50), 1.0 + i) for i in range(500)] + [("b", None, None), ("b", float("nan"), 2.0)]
    path = str(tmp_path / "generation")
    spark.createDataFrame(rows, "series string, only_here double, other double").write.parquet(path)
    df = spark.read.parquet(path)
    for run in (P.iqr_screen, P.boxplot_stats):
        assert scans(lambda: run(df, "series", "only_here"), "only_here") == 1
    wide = df.withColumnsRenamed({"only_here": "demand_twh"})
    assert scans(lambda: P.describe_measures({"demand": wide}), "demand_twh") == 1


def test_profile_counts_by_hash_and_looks_far_only_where_it_must(spark, monkeypatch):
    rows = [(i // 7, None if i % 4 else f"v{i}", "same" if i < 900 else f"late{i}", float("nan") if i % 2 else i / 2) for i in range(1000)]
    df = spark.createDataFrame(rows, "k int, sparse string, late string, number double").repartition(5)
    want = {tuple(r) for r in P.column_profile(df, "d", ["k"]).collect()}
    assert {r[1]: r[7] for r in want}["late"].startswith("same, late900")
    for head in (1, 3, 40, 5000):
        monkeypatch.setattr(P, "HEAD", head)
        assert {tuple(r) for r in P.column_profile(df, "d", ["k"]).collect()} == want
