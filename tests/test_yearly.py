import pytest
from pyspark.sql import functions as F

from almanack import schemas as S
from almanack.operators import marts as K, yearly as Y
from almanack.plans import gold as G, publish as P
from almanack.sources import tables as T
from fixtures import Source

YEARS = range(2019, 2023)


def source(solar=3.0):
    made = Source()
    for year in YEARS:
        made.year("DEU", year, solar=1.0 + year / 7, demand=3.1).year("BGR", year, gas=year / 3)
    return made.generation("DEU", 2023, [1, 2], Solar=solar)


def publish_silver(spark, root, frames, datasets=S.DATASETS, years=None):
    """The given years of the datasets as new parts."""
    run, pointers = T.new_run_id(), []
    current = T.current_tables(spark, root)
    for name in datasets:
        rows = frames[name].withColumn(T.PART, F.year("date").cast("string"))
        if years:
            rows = rows.where(F.col(T.PART).isin(years))
        location = T.write_snapshot(rows, root, name, run, [T.PART])
        new = {r[0]: r["count"] for r in rows.groupBy(T.PART).count().collect()}
        kept = [p for p in (current.get(name) or {}).get("parts", []) if p["part"] not in new]
        parts = kept + [{"part": y, "location": T.part_location(location, y), "rows": n} for y, n in new.items()]
        pointers.append({"table": name, "location": location, "parts": parts, "columns": frames[name].schema.json()})
    T.commit(spark, root, pointers)


def reports(gold):
    """All yearly reports and marts, as sets of rows."""
    period = K.resolve_period(gold, 2026)
    frames = {name: build(gold, 2026, S.BASELINE_YEAR, period) for name, (_, build) in K.MARTS.items()}
    frames |= {"balance": K.generation_demand_yearly(gold, 2026), "mix": K.energy_mix_yearly(gold, 2026)}
    frames |= {"sources": K.comparison_sources(gold, 2026), "complete": K.complete_country_years(gold, 2026)}
    frames |= {"domestic": K.annual_domestic_net_imports(gold, 2026)}
    return {name: sorted(map(repr, df.collect())) for name, df in frames.items()}


def opened(df):
    return {f.split("_part=")[1][:4] for f in df.inputFiles()}


def test_only_touched_years_are_computed_and_reports_stay_right(spark, tmp_path, monkeypatch):
    silver, gold = str(tmp_path / "silver"), str(tmp_path / "gold")
    publish_silver(spark, silver, source().silver(spark))
    first = G.update_gold_by_year(spark, silver, gold)
    assert first["years"]["fact_demand"] == [str(y) for y in YEARS]
    before = T.current_tables(spark, gold)

    # One year of two datasets changes.
    frames = source().silver(spark)
    frames["generation"] = frames["generation"].withColumn("generation_twh", F.col("generation_twh") * 2)
    frames["demand"] = frames["demand"].withColumn("demand_twh", F.col("demand_twh") + 1)
    publish_silver(spark, silver, frames, ["generation", "demand"], ["2021"])
    summed, seen = Y.year_sums, {}
    monkeypatch.setattr(Y, "year_sums", lambda df, fact: seen.update({fact: opened(df)}) or summed(df, fact))
    second = G.update_gold_by_year(spark, silver, gold)
    assert {f: y for f, y in second["years"].items() if y} == {"fact_generation": ["2021"], "fact_demand": ["2021"]}
    assert seen == {"fact_generation": {"2021"}, "fact_demand": {"2021"}}
    after = T.current_tables(spark, gold)
    for table in S.GOLD_TABLES + Y.YEARLY_TABLES:
        old = {p["part"]: p["location"] for p in before[table].get("parts") or []}
        new = {p["part"]: p["location"] for p in after[table].get("parts") or []}
        touched = {y for y in new if new[y] != old[y]}
        assert touched == ({"2021"} if table.endswith(("fact_generation", "fact_demand")) else set())
        assert after[table]["location"] == before[table]["location"] or touched

    # Reports from stored sums, from the stored facts and from a model made anew agree.
    stored = G.load_reporting(spark, gold)
    assert set(Y.YEARLY_TABLES) <= set(stored)
    want = reports(G.load_gold(spark, gold))
    assert reports(stored) == want and all(want.values())
    whole = str(tmp_path / "whole")
    G.build_and_publish(spark, {d: T.read_snapshot(spark, silver, d) for d in S.DATASETS}, whole)
    assert reports(G.load_gold(spark, whole)) == want
    assert G.validate_published(spark, gold)["fact_demand"]["total_records"] == 2 * 12 * len(YEARS)

    # Nothing new: no version, no year.
    third = G.update_gold_by_year(spark, silver, gold)
    assert third["version"] == second["version"] and not any(third["years"].values())


def test_marts_of_the_same_inputs_are_not_computed(spark, tmp_path, monkeypatch):
    silver, gold, root = (str(tmp_path / n) for n in ("silver", "gold", "marts"))
    frames = source().silver(spark)
    publish_silver(spark, silver, frames)
    G.update_gold_by_year(spark, silver, gold)

    def publish():
        model = G.load_reporting(spark, gold)
        done = P.publish_marts(spark, model, root, 2026, inputs_of=G.inputs_of(spark, gold))
        return [m["skipped"] for m in done]

    assert publish() == [False] * 4
    computed, hand_over = [], P.hand_over
    monkeypatch.setattr(P, "hand_over", lambda df, name: computed.append(name) or hand_over(df, name))
    assert publish() == [True] * 4 and not computed
    publish_silver(spark, silver, frames, ["demand"], ["2020"])  # not one of the two years
    G.update_gold_by_year(spark, silver, gold)
    assert publish() == [True] * 4 and not computed
    changed = frames["demand"].withColumn("demand_twh", F.col("demand_twh") * 3)
    publish_silver(spark, silver, {"demand": changed}, ["demand"], ["2022"])
    G.update_gold_by_year(spark, silver, gold)
    assert publish() == [False, True, True, True]
    assert computed == [f"mart-{name}" for name in K.MARTS]  # all are made of that year's sums


def test_a_lost_key_builds_all_years_again(spark, tmp_path):
    silver, gold = str(tmp_path / "silver"), str(tmp_path / "gold")
    frames = source().silver(spark)
    publish_silver(spark, silver, frames)
    G.update_gold_by_year(spark, silver, gold)
    fewer = {d: df.where("entity_code = 'DEU'") for d, df in frames.items()}
    publish_silver(spark, silver, fewer)
    done = G.update_gold_by_year(spark, silver, gold)
    assert done["years"]["fact_capacity"] == [str(y) for y in YEARS]
    assert T.read_snapshot(spark, gold, "dim_country").count() == 1
    T.commit(spark, silver, [{"table": "demand", "location": f"{silver}/demand/x"}])
    with pytest.raises(ValueError, match="demand"):
        G.update_gold_by_year(spark, silver, gold)


def test_a_failing_check_publishes_nothing(spark, tmp_path):
    silver, gold = str(tmp_path / "silver"), str(tmp_path / "gold")
    frames = source().silver(spark)
    publish_silver(spark, silver, frames)
    done = G.update_gold_by_year(spark, silver, gold)
    twice = {"demand": frames["demand"].unionByName(frames["demand"])}
    publish_silver(spark, silver, twice, ["demand"], ["2020"])
    with pytest.raises(ValueError, match="duplicate"):
        G.update_gold_by_year(spark, silver, gold)
    assert T.current_version(spark, gold) == done["version"]


def test_tables_in_parts_are_registered_by_year(spark, tmp_path):
    silver, gold = str(tmp_path / "silver"), str(tmp_path / "gold")
    frames = source().silver(spark)
    publish_silver(spark, silver, frames)
    G.update_gold_by_year(spark, silver, gold)
    G.register_silver(spark, silver, "ys_")
    G.register_gold(spark, gold, "yg_")
    more = frames["demand"].withColumn("demand_twh", F.col("demand_twh") + 1)
    publish_silver(spark, silver, {"demand": more}, ["demand"], ["2021"])
    G.update_gold_by_year(spark, silver, gold)
    G.register_silver(spark, silver, "ys_")
    G.register_gold(spark, gold, "yg_")
    for table, rows in (("ys_demand", T.read_snapshot(spark, silver, "demand")), ("yg_fact_demand", G.load_gold(spark, gold)["fact_demand"])):
        want = {r[0]: r[1] for r in rows.groupBy(F.year("date")).agg(F.round(F.sum("demand_twh"), 3)).collect()}
        got = spark.sql(f"SELECT year, round(sum(demand_twh), 3) FROM {table} GROUP BY year").collect()
        assert {r[0]: r[1] for r in got} == want and len(want) == len(YEARS)
        one = spark.sql(f"SELECT * FROM {table} WHERE year = 2021")
        assert opened(one) == {"2021"}
