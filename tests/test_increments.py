import datetime as dt

import pytest
from pyspark.sql import functions as F

from almanack.operators import increments as I
from conftest import rows

NOON = dt.datetime(2026, 1, 1, 12)
FILE = "path string, mtime timestamp_ntz, length bigint"


def files(spark, *items):
    return spark.createDataFrame([(p, NOON + dt.timedelta(hours=h), n) for p, h, n in items], FILE)


@pytest.fixture()
def inventory(spark):
    return files(spark, ("a.json", 0, 10), ("b.json", 1, 20))


def plan(*args, **kwargs):
    found = I.change_plan(*args, **kwargs).collect()
    return sorted(r["path"] for r in found), {r["full_rebuild"] for r in found}


def test_no_manifest_means_rebuild(inventory):
    assert plan(inventory, None) == (["a.json", "b.json"], {True})
    assert plan(inventory, inventory, reusable=False) == (["a.json", "b.json"], {True})


def test_nothing_new(inventory):
    assert plan(inventory, inventory) == ([], set())


def test_only_new_files(spark, inventory):
    assert plan(inventory, files(spark, ("a.json", 0, 10))) == (["b.json"], {False})


@pytest.mark.parametrize(
    "recorded",
    [
        [("a.json", 0, 11)],
        [("a.json", 5, 10)],
        [("a.json", 0, 10), ("gone.json", 0, 1)],
        [("a.json", 0, 10), ("a.json", 0, 10)],
    ],
    ids=["length", "time", "removed", "twice"],
)
def test_changed_history_means_rebuild(spark, inventory, recorded):
    assert plan(inventory, files(spark, *recorded)) == (["a.json", "b.json"], {True})


def test_latest_object(spark):
    many = files(spark, *[(f"x/{i:04d}.parquet", 0, 1) for i in range(1001)], ("z.json", 9, 1))
    assert I.latest_object(many, ".parquet").first()[0] == "x/1000.parquet"
    assert I.latest_object(many, ".json").first()[0] == "z.json"
    assert I.latest_object(many, ".csv").first()[0] is None


def test_increment_plan(spark):
    latest = spark.createDataFrame(
        [("a", "2026-08-01"), ("b", "2026-08-01T00:00:00Z"), ("c", "2026-09-01"), ("d", "2026-12-01")],
        "dataset string, latest string",
    )
    state = spark.createDataFrame(
        [("b", "2026-08-01T00:00:00"), ("c", "2026-08-01"), ("d", "2026-11-15")],
        "dataset string, last_source_date string",
    )
    got = {
        r["dataset"]: (r["action"], r["start_date"] and r["start_date"].isoformat())
        for r in I.increment_plan(latest, state, "2010-01").collect()
    }
    assert got == {
        "a": ("load", "2010-01-01"),
        "b": ("skip", None),
        "c": ("load", "2026-09-01"),
        "d": ("load", "2026-12-01"),
    }


@pytest.mark.parametrize("text", ["2026-08-01garbage", "2026-8-1", "2026-02-30", "01.08.2026", "2026-08-01T", ""])
def test_other_texts_are_no_source_dates(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    with pytest.raises(Exception, match="not an ISO date"):
        df.select(I.parse_source_date("t")).collect()


def test_next_month_crosses_the_year(spark):
    df = spark.createDataFrame([(dt.date(2025, 12, 31),), (dt.date(2026, 1, 1),)], "d date")
    assert [r[0].isoformat() for r in df.select(I.next_month(F.col("d"))).collect()] == [
        "2026-01-01",
        "2026-02-01",
    ]


def test_state_moves_to_the_declared_date(spark):
    schema = "dataset string, n_rows bigint, declared_max string"
    ok = spark.createDataFrame(
        [("a", 3, "2026-08-01"), ("a", 1, "2026-07-01T00:00:00Z"), ("b", 0, None)], schema
    )
    assert rows(I.state_advance(ok)) == [("a", dt.date(2026, 8, 1))]
    bad = spark.createDataFrame([("a", 3, None)], schema)
    with pytest.raises(Exception, match="no source date"):
        I.state_advance(bad).collect()


SILVER = "entity_code string, date timestamp_ntz, series string, generation_twh double"


def silver(spark, *items):
    return spark.createDataFrame(
        [(c, dt.datetime.fromisoformat(d), s, v) for c, d, s, v in items], SILVER
    )


def load(df, hour, path="x.json"):
    stamp = F.lit(NOON + dt.timedelta(hours=hour)).cast("timestamp")
    return I.with_increment_sequence(df, stamp, F.lit(path), F.lit(0))


def test_initial_load_append_and_replace(spark):
    first = silver(spark, ("DEU", "2026-07-01", "Solar", 8.0))
    more = silver(spark, ("DEU", "2026-07-01", "Solar", 9.5), ("FRA", "2026-08-01", "Solar", 6.0))
    assert I.merge_snapshot(None, [load(first, 0)], "generation").count() == 1
    merged = I.merge_snapshot(first, [load(more, 0)], "generation")
    assert {(r[0], r[3]) for r in merged.collect()} == {("DEU", 9.5), ("FRA", 6.0)}
    again = I.merge_snapshot(merged, [load(more, 0)], "generation")
    assert rows(again) == rows(merged)
    assert merged.columns == first.columns


def test_sequence_is_time_then_path_then_position(spark):
    def one(value, hour, path, pos):
        df = silver(spark, ("DEU", "2026-07-01", "Solar", value))
        stamp = F.lit(NOON + dt.timedelta(hours=hour)).cast("timestamp")
        return I.with_increment_sequence(df, stamp, F.lit(path), F.lit(pos))

    snapshot = silver(spark, ("DEU", "2026-07-01", "Solar", 0.0))
    loads = [one(1.0, 2, "a", 9), one(2.0, 1, "z", 9), one(3.0, 2, "b", 1), one(4.0, 2, "b", 0)]
    assert I.merge_snapshot(snapshot, loads, "generation").first()["generation_twh"] == 3.0


def test_null_keys_form_one_group_and_nulls_may_win(spark):
    df = spark.createDataFrame(
        [(None, 1, "x"), (None, 2, None), ("k", 1, "y")], "k string, s int, v string"
    )
    assert rows(I.keep_last(df, ["k"], ["s"])) == [("k", "y"), (None, None)]


def test_hot_key_is_merged_without_gathering_it(spark):
    hot = spark.range(20000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        "id",
        F.col("id").alias("v"),
    )
    kept = I.keep_last(hot, ["k"], ["id"])
    assert kept.count() == hot.select("k").distinct().count()
    assert kept.where("k = 'hot'").first()["v"] == 19998
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "partial_max_by" in plan


def test_slice(spark):
    df = silver(
        spark,
        ("DEU", "2026-06-01", "Solar", 1.0),
        ("DEU", "2026-07-01", "Solar", 2.0),
        ("USA", "2026-07-01", "Solar", 3.0),
    )
    scope = spark.createDataFrame([("DEU",), ("DEU",)], "entity_code string")
    assert [r["generation_twh"] for r in I.increment_slice(df, scope, "2026-07-01").collect()] == [2.0]


def test_history_is_neither_sorted_nor_shuffled(spark, tmp_path):
    """With a small increment the snapshot is filtered by a broadcast of its keys."""
    old = silver(spark, *[("DEU", f"20{y:02}-01-01", "Coal", float(y)) for y in range(20)])
    old.write.parquet(str(tmp_path / "old"))
    snapshot = spark.read.parquet(str(tmp_path / "old"))
    silver(spark, ("DEU", "2019-01-01", "Coal", 99.0)).write.parquet(str(tmp_path / "new"))
    latest = spark.read.parquet(str(tmp_path / "new"))
    merged = I.replace_keys(snapshot, latest, ["entity_code", "date", "series"])
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Sort " not in plan
    assert "Exchange hashpartitioning" not in plan[: plan.index("BroadcastExchange")]
    assert merged.count() == 20 and merged.where("generation_twh = 99").count() == 1
