import json
import os

import pytest
from pyspark.sql import functions as F

from almanack.sources import bronze as B

ROW = {
    "entity": "Germany",
    "entity_code": "DEU",
    "is_aggregate_entity": False,
    "date": "2026-07-01",
    "demand_twh": 40.25,
}
STATS = {"query_value_range": {"date": {"max": "2026-07-01"}}}


def store(root, name, document, indent=None, day="2026-08-10"):
    folder = root / "demand" / f"ingestion_date={day}"
    folder.mkdir(parents=True, exist_ok=True)
    text = document if isinstance(document, str) else json.dumps(document, indent=indent)
    (folder / name).write_text(text, encoding="utf-8")


def rows_of(spark, root, **options):
    documents = B.read_documents(spark, str(root / "demand"), **options)
    return B.document_rows(documents, "demand")


def test_rows_keep_their_position_and_text(spark, tmp_path):
    store(tmp_path, "a.json", {"data": [ROW, ROW | {"demand_twh": None}], "stats": STATS})
    got = rows_of(spark, tmp_path).orderBy("pos").collect()
    assert [(r["pos"], r["demand_twh"]) for r in got] == [(0, "40.25"), (1, None)]
    assert got[0]["is_aggregate_entity"] == "false" and got[0]["path"].endswith("a.json")


def test_fields_beyond_the_required_ones_are_kept(spark, tmp_path):
    store(tmp_path, "a.json", {"data": [ROW | {"note": "x", "unit": "TWh"}, ROW], "stats": STATS})
    store(tmp_path, "b.json", {"data": [ROW | {"quality": 3}], "stats": STATS})
    got = {(r["note"], r["unit"], r["quality"]) for r in rows_of(spark, tmp_path).collect()}
    assert got == {("x", "TWh", None), (None, None, None), (None, None, "3")}


def test_pretty_printed_documents(spark, tmp_path):
    store(tmp_path, "a.json", {"data": [ROW], "stats": STATS}, indent=2)
    assert rows_of(spark, tmp_path, multi_line=True).count() == 1


def test_a_field_missing_in_one_document_is_an_error(spark, tmp_path):
    short = {k: v for k, v in ROW.items() if k != "demand_twh"}
    store(tmp_path, "a.json", {"data": [ROW], "stats": STATS})
    store(tmp_path, "b.json", {"data": [short], "stats": STATS})
    with pytest.raises(Exception, match="missing demand_twh"):
        rows_of(spark, tmp_path).collect()


def test_a_field_present_in_any_row_is_present(spark, tmp_path):
    short = {k: v for k, v in ROW.items() if k != "demand_twh"}
    store(tmp_path, "a.json", {"data": [short, ROW], "stats": STATS})
    assert rows_of(spark, tmp_path).where(F.col("demand_twh").isNull()).count() == 1


@pytest.mark.parametrize("text", ['{"stats": {}}', '{"data": [', '{"data": null}'])
def test_bad_documents_fail(spark, tmp_path, text):
    store(tmp_path, "a.json", text)
    with pytest.raises(Exception):
        rows_of(spark, tmp_path).collect()


def test_inventory_is_in_load_order(spark, tmp_path):
    for i, name in enumerate(["c.json", "b.json", "a.json", "d.txt"]):
        store(tmp_path, name, {"data": [ROW]}, day=f"2026-08-{10 + i}")
        path = tmp_path / "demand" / f"ingestion_date=2026-08-{10 + i}" / name
        os.utime(path, (1_000_000 + (i // 2), 1_000_000 + (i // 2)))
    got = B.bronze_inventory(spark, str(tmp_path), "demand").collect()
    assert [os.path.basename(r["path"]) for r in got] == ["c.json", "b.json", "a.json"]
    assert all(r["length"] > 0 for r in got)


def test_no_documents_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        B.bronze_inventory(spark, str(tmp_path), "demand")
    (tmp_path / "demand").mkdir()
    with pytest.raises(FileNotFoundError):
        B.bronze_inventory(spark, str(tmp_path), "demand")


def test_documents_are_bounded_and_complete_even_for_repeated_rows(spark, tmp_path):
    df = spark.range(3000).select(
        F.lit("Germany").alias("entity"),
        F.when(F.col("id") < 1000, F.lit("HOT")).otherwise(F.col("id").cast("string")).alias("entity_code"),
        F.lit(False).alias("is_aggregate_entity"),
        F.lit("2026-07-01").cast("timestamp_ntz").alias("date"),
        F.when(F.col("id") < 1000, F.lit(1.5)).otherwise(F.col("id") / 8).alias("demand_twh"),
    )
    documents = B.to_documents(df, rows_per_document=100)
    sizes = [r[0] for r in documents.select(F.size("data")).collect()]
    assert sum(sizes) == 3000 and max(sizes) < 600 and len(sizes) > 20
    B.append_documents(documents, str(tmp_path), "demand", "2026-08-10", "s1")
    back = B.document_rows(B.read_documents(spark, str(tmp_path / "demand")), "demand")
    assert back.count() == 3000
    assert back.where("entity_code = 'HOT'").count() == 1000
    assert back.select("demand_twh").distinct().count() == df.select("demand_twh").distinct().count()


def test_an_existing_load_is_never_replaced(spark, tmp_path):
    df = spark.createDataFrame([("2026-07-01", "DEU")], "date string, entity_code string")
    documents = B.to_documents(df)
    B.append_documents(documents, str(tmp_path), "demand", "2026-08-10", "s1")
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        B.append_documents(documents, str(tmp_path), "demand", "2026-08-10", "s1")
