import threading

import pytest
from pyspark.sql import functions as F

from almanack import schemas as S
from almanack.operators import marts as K, quality as Q
from almanack.plans import gold as G, publish as P
from almanack.sources import tables as T
from fixtures import Source


@pytest.fixture(scope="module")
def gold(spark):
    return Source().year("DEU", 2019).year("DEU", 2020, solar=3).gold(spark)


def test_versions_switch_together_and_can_be_restored(spark, tmp_path):
    root = str(tmp_path)
    assert T.current_tables(spark, root) == {} and T.read_snapshot(spark, root, "a") is None
    for run, n in (("r1", 3), ("r2", 5)):
        pointers = [
            {"table": t, "location": T.write_snapshot(spark.range(n), root, t, run), "row_count": n}
            for t in ("a", "b")
        ]
        T.commit(spark, root, pointers)
    location = T.write_snapshot(spark.range(9), root, "a", "r3")
    assert T.commit(spark, root, [{"table": "a", "location": location}]) == 3
    counts = {t: df.count() for t, df in T.read_published(spark, root, ["a", "b"]).items()}
    assert counts == {"a": 9, "b": 5}
    assert T.restore_version(spark, root, 1) == 4
    counts = {t: df.count() for t, df in T.read_published(spark, root, ["a", "b"]).items()}
    assert counts == {"a": 3, "b": 3}
    with pytest.raises(T.NotPublished):
        T.restore_version(spark, root, 77)
    with pytest.raises(T.NotPublished):
        T.read_published(spark, root, ["c"])
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        T.write_snapshot(spark.range(1), root, "a", "r1")


def test_fingerprint_ignores_order_but_not_duplicates_or_version(spark):
    schema = "country_name string, value double"
    data = [("Germany", 1.5), ("Austria", None), ("Austria", 2.0)]
    base = spark.createDataFrame(data, schema)
    other = spark.createDataFrame(data[::-1], schema).repartition(3)
    mark = P.source_fingerprint(base, "1")
    assert mark[1] == 3 and P.source_fingerprint(other, "1") == mark
    changed = [
        P.source_fingerprint(base, "2"),
        P.source_fingerprint(base.unionByName(base.limit(1)), "1"),
        P.source_fingerprint(base.withColumnRenamed("value", "v"), "1"),
        P.source_fingerprint(base.withColumn("value", F.col("value").cast("float")), "1"),
        P.source_fingerprint(base.fillna(0.0), "1"),
    ]
    assert len({mark[0], *[c[0] for c in changed]}) == 6
    with pytest.raises(ValueError, match="no rows"):
        P.source_fingerprint(base.where("false"), "1")


def test_publishing_marts(spark, gold, tmp_path):
    root = str(tmp_path)
    first = P.publish_marts(spark, gold, root, 2026)
    assert [(m["mart"], m["rows"], m["skipped"]) for m in first] == [(n, 1, False) for n in K.MARTS]
    again = P.publish_marts(spark, gold, root, 2026)
    assert all(m["skipped"] for m in again)
    assert [m["location"] for m in again] == [m["location"] for m in first]
    assert T.current_version(spark, root) == 1

    # A failure at the third mart publishes nothing, although two were prepared.
    demand = gold["fact_demand"].withColumn("demand_twh", F.col("demand_twh") * 2)
    emissions = gold["fact_emissions"].withColumn("emissions_mtco2", F.col("emissions_mtco2") + 1)
    capacity = gold["fact_capacity"].withColumn("capacity_gw", F.col("capacity_gw") + 1)
    changed = gold | {"fact_demand": demand, "fact_emissions": emissions, "fact_capacity": capacity}
    calls = []

    def failing(df, where, table, run_id, **options):
        calls.append(table)
        if len(calls) == 3:
            raise OSError("storage is gone")
        return T.write_snapshot(df, where, table, run_id, **options)

    with pytest.raises(OSError):
        P.publish_marts(spark, changed, root, 2026, writer=failing)
    assert T.current_version(spark, root) == 1
    after = P.publish_marts(spark, changed, root, 2026)
    assert [m["skipped"] for m in after] == [False, True, False, False]
    assert P.load_mart(spark, root, "generation_demand_summary").first()["first_demand_twh"] == 72.0


def test_empty_marts_are_not_published(spark, gold, tmp_path):
    early = {t: df.where("year(date) = 2019") if t in S.FACT_GRAINS else df for t, df in gold.items()}
    with pytest.raises(ValueError, match="no rows"):
        P.publish_marts(spark, early, str(tmp_path), 2026)
    with pytest.raises(ValueError, match="unknown mart"):
        P.publish_marts(spark, gold, str(tmp_path), 2026, names=["weather"])
    assert T.current_tables(spark, str(tmp_path)) == {}


def test_publishing_the_model(spark, gold, tmp_path):
    root = str(tmp_path)
    done = G.publish_gold(spark, gold, root)
    assert done["version"] == 1 and done["row_counts"]["fact_generation"] == 72
    with pytest.raises(ValueError, match="model must consist"):
        G.publish_gold(spark, {k: v for k, v in gold.items() if k != "dim_date"}, root)

    staged = []

    def failing(df, where, table, run_id, **options):
        if len(staged) == 3:
            raise OSError("storage is gone")
        staged.append(table)
        return T.write_snapshot(df, where, table, run_id, **options)

    with pytest.raises(OSError):
        G.publish_gold(spark, gold, root, writer=failing)
    orphan = gold["fact_demand"].withColumn("entity_code", F.lit("XXX"))
    with pytest.raises(Q.QualityError, match="orphan_countries"):
        G.publish_gold(spark, gold | {"fact_demand": orphan}, root)
    with pytest.raises(Q.QualityError, match="empty tables"):
        G.publish_gold(spark, gold | {"fact_demand": gold["fact_demand"].where("false")}, root)
    pointers = T.current_tables(spark, root)
    assert {p["run_id"] for p in pointers.values()} == {done["run_id"]}

    assert G.validate_published(spark, root)["fact_demand"]["total_records"] == 24
    names = G.register_gold(spark, root, "g_")
    assert set(names) == {f"g_{t}" for t in S.GOLD_TABLES}
    assert spark.sql("SELECT COUNT(*) FROM g_fact_demand").first()[0] == 24
    with pytest.raises(T.NotPublished):
        G.register_silver(spark, root)
    T.commit(spark, root, [{"table": "dim_date", "location": "/elsewhere/dim_date"}])
    with pytest.raises(ValueError, match="does not point"):
        G.register_gold(spark, root)


def test_registration_moves_names_in_place(spark, gold, tmp_path):
    """A reader in a loop always finds the name; a broken pointer leaves the old table."""
    root = str(tmp_path)
    G.publish_gold(spark, gold, root)
    G.register_gold(spark, root, "p_")
    seen, failed, stop = [], [], threading.Event()

    def read():
        while not stop.is_set():
            try:
                seen.append(spark.newSession().sql("SELECT COUNT(*) FROM p_fact_demand").first()[0])
            except Exception as error:  # noqa: BLE001
                if "TABLE_OR_VIEW_NOT_FOUND" in str(error):
                    failed.append(error)

    reader = threading.Thread(target=read)
    reader.start()
    try:
        only = gold | {"fact_demand": gold["fact_demand"].where("year(date) = 2019")}
        for model in (only, gold, only):
            G.publish_gold(spark, model, root)
            G.register_gold(spark, root, "p_")
    finally:
        stop.set()
        reader.join()
    assert not failed and seen
    assert spark.sql("SELECT COUNT(*) FROM p_fact_demand").first()[0] == 12
    assert [r[0] for r in spark.sql("SHOW PARTITIONS p_fact_demand").collect()] == ["year=2019"]

    good = T.current_tables(spark, root)["fact_demand"]
    T.commit(spark, root, [good | {"location": f"{root}/fact_demand/nowhere"}])
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        G.register_gold(spark, root, "p_")
    assert spark.sql("SELECT COUNT(*) FROM p_fact_demand").first()[0] == 12

    # A failure half way puts back what was changed already.
    T.commit(spark, root, [good])
    G.publish_gold(spark, gold, root)
    state = T._registered(spark, "p_fact_demand", ["year"])
    parts = {"`year` = 2019": f"{root}/x", "`year` = 2020": f"{root}/y", "`nonsense` = 1": f"{root}/z"}
    with pytest.raises(Exception, match="nonsense"):
        T._switch(spark, "p_fact_demand", ["year"], f"{root}/w", parts)
    assert T._registered(spark, "p_fact_demand", ["year"]) == state
    assert spark.sql("SELECT COUNT(*) FROM p_fact_demand").first()[0] == 12


def test_registered_columns_may_grow_at_the_end_only(spark, tmp_path):
    root, wide = str(tmp_path), "id bigint, more string"
    for run, schema in (("r1", "id bigint"), ("r2", wide)):
        df = spark.createDataFrame([(1, "x")][:1], wide).select(*[c.split()[0] for c in schema.split(", ")])
        T.commit(spark, root, [{"table": "wide", "location": T.write_snapshot(df, root, "wide", run)}])
        assert T.register_tables(spark, root, {"wide": df.schema}, "q_") == ["q_wide"]
    assert spark.table("q_wide").first().asDict() == {"id": 1, "more": "x"}
    with pytest.raises(T.SchemaChanged):
        T.register_tables(spark, root, {"wide": spark.createDataFrame([], "more string, id bigint").schema}, "q_")
    assert spark.table("q_wide").count() == 1


def test_result_schema(spark):
    assert T.result_schema(spark.range(1).selectExpr("id", "cast(1 as decimal(5,2)) AS d")) == [
        ("id", "bigint"),
        ("d", "decimal(5,2)"),
    ]
    with pytest.raises(ValueError):
        T.result_schema(spark.range(1).select())
