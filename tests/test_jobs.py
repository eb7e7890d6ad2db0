import json
import os

import pytest
from pyspark.sql import functions as F

from almanack import schemas as S
from almanack.operators import quality as Q
from almanack.plans import ingest, silver as J
from almanack.sources import bronze, tables as T
from almanack.streaming import silver_stream
from fixtures import Source


def document(*items, latest="2026-09-01"):
    data = [
        {"entity": "Land", "entity_code": c, "is_aggregate_entity": False, "date": d, "demand_twh": v}
        for c, d, v in items
    ]
    return json.dumps({"data": data, "stats": {"query_value_range": {"date": {"max": latest}}}})


def store(root, name, text, at):
    folder = root / "bronze" / "demand" / f"ingestion_date={name}"
    folder.mkdir(parents=True, exist_ok=True)
    path = folder / f"demand_{name}.json"
    path.write_text(text)
    os.utime(path, (at, at))
    return path


def run(spark, root):
    return J.update_silver(spark, str(root / "bronze"), str(root / "silver"), "demand")


def state(spark, root):
    df = T.read_snapshot(spark, str(root / "silver"), "demand")
    return {(r["entity_code"], r["date"].strftime("%Y-%m")): r["demand_twh"] for r in df.collect()}


def test_silver_job(spark, tmp_path):
    first = store(tmp_path, "2026-08-10", document(("DEU", "2026-07-01", 1.0), ("FRA", "2026-07-01", 2.0)), 1000)
    got = run(spark, tmp_path)
    assert (got["full_rebuild"], got["documents"], got["rows"]) == (True, 1, 2)

    # nothing new
    assert run(spark, tmp_path)["changed"] is False

    # a later document replaces a key and adds one; the first is not read again
    store(tmp_path, "2026-09-10", document(("DEU", "2026-07-01", 5.0), ("DEU", "2026-08-01", 6.0)), 2000)
    got = run(spark, tmp_path)
    assert (got["full_rebuild"], got["documents"], got["rows"]) == (False, 1, 3)
    assert state(spark, tmp_path)[("DEU", "2026-07")] == 5.0

    # a failing check publishes nothing and leaves the manifest alone
    bad = store(tmp_path, "2026-10-10", document(("USA", "2026-09-01", 9.0)), 3000)
    with pytest.raises(Q.QualityError, match="unexpected_countries"):
        run(spark, tmp_path)
    assert ("USA", "2026-09") not in state(spark, tmp_path)
    bad.write_text(document(("FRA", "2026-09-01", 9.0)))
    os.utime(bad, (3000, 3000))
    assert run(spark, tmp_path)["documents"] == 1

    # an edited document forces a rebuild from all documents
    first.write_text(document(("DEU", "2026-07-01", 1.0)))
    os.utime(first, (1000, 1000))
    got = run(spark, tmp_path)
    assert (got["full_rebuild"], got["documents"]) == (True, 3)
    assert ("FRA", "2026-07") not in state(spark, tmp_path)

    # a snapshot whose files changed is no merge base either
    location = T.current_tables(spark, str(tmp_path / "silver"))["demand"]["parts"][0]["location"]
    part = next(f for f in os.listdir(location) if f.endswith(".parquet"))
    os.utime(os.path.join(location, part), (5, 5))
    assert run(spark, tmp_path)["full_rebuild"] is True


def test_an_edit_that_a_listing_cannot_show_forces_a_rebuild(spark, tmp_path):
    path = store(tmp_path, "2026-08-10", document(("DEU", "2026-07-01", 1.0), ("FRA", "2026-07-01", 2.0)), 1000)
    run(spark, tmp_path)
    text = path.read_text()
    path.write_text(text.replace("1.0", "7.0"))
    os.utime(path, (1000, 1000))
    assert path.stat().st_size == len(text) and path.stat().st_mtime == 1000
    listed = J.update_silver(spark, str(tmp_path / "bronze"), str(tmp_path / "silver"), "demand", verify_content=False)
    assert listed["changed"] is False
    assert run(spark, tmp_path)["full_rebuild"] is True
    assert state(spark, tmp_path)[("DEU", "2026-07")] == 7.0
    assert run(spark, tmp_path)["changed"] is False


def files_of(spark, root):
    parts = T.current_tables(spark, str(root / "silver"))["demand"]["parts"]
    return {p["part"]: sorted((f, os.stat(f"{p['location']}/{f}").st_mtime_ns) for f in os.listdir(p["location"])) for p in parts}


def test_only_touched_years_are_read_and_written(spark, tmp_path, monkeypatch):
    history = [(c, f"{y}-{m:02d}-01", y + m) for c in ("DEU", "FRA") for y in (2023, 2024, 2025) for m in range(1, 13)]
    store(tmp_path, "2026-01-10", document(*history), 1000)
    assert run(spark, tmp_path)["years"] == ["2023", "2024", "2025"]
    before = files_of(spark, tmp_path)
    read, written = [], []
    pointer, snapshot = T.read_pointer, T.write_snapshot
    monkeypatch.setattr(T, "read_pointer", lambda s, p, schema=None, parts=None: read.append(parts) or pointer(s, p, schema, parts))
    monkeypatch.setattr(T, "write_snapshot", lambda df, *a, **k: written.append(df) or snapshot(df, *a, **k))
    store(tmp_path, "2026-02-10", document(("DEU", "2024-03-01", 5.0), ("FRA", "2026-01-01", 6.0)), 2000)
    got = run(spark, tmp_path)
    assert (got["years"], got["rows"]) == (["2024", "2026"], 73)
    assert read == [["2024", "2026"]]
    opened = {f.split("_part=")[1][:4] for f in written[0].inputFiles() if "_part=" in f}
    assert opened == {"2024"}
    after = files_of(spark, tmp_path)
    assert after["2023"] == before["2023"] and after["2025"] == before["2025"] and after["2024"] != before["2024"]
    monkeypatch.undo()
    found = state(spark, tmp_path)
    assert (found[("DEU", "2024-03")], found[("FRA", "2024-03")], found[("FRA", "2026-01")]) == (5.0, 2027.0, 6.0)
    assert len(found) == 73


def test_a_field_that_comes_later_is_null_in_older_years(spark, tmp_path):
    store(tmp_path, "2026-01-10", document(("DEU", "2024-01-01", 1.0)), 1000)
    run(spark, tmp_path)
    late = document(("DEU", "2025-01-01", 2.0)).replace('"entity":', '"note": "n", "entity":')
    store(tmp_path, "2026-02-10", late, 2000)
    run(spark, tmp_path)
    df = T.read_snapshot(spark, str(tmp_path / "silver"), "demand")
    assert sorted((r["date"].year, r["note"]) for r in df.collect()) == [(2024, None), (2025, "n")]


def test_the_manifest_is_begun_anew_when_it_is_long(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(J, "MANIFESTS", 2)
    for n in range(4):
        store(tmp_path, f"2026-0{n + 1}-10", document(("DEU", f"202{n}-01-01", n)), 1000 + n)
        assert run(spark, tmp_path)["full_rebuild"] is (n == 0)
    assert len(T.current_tables(spark, str(tmp_path / "silver"))["demand"]["manifest"]) == 2
    assert run(spark, tmp_path)["changed"] is False
    assert len(state(spark, tmp_path)) == 4


def test_a_repeated_batch_changes_nothing_and_lists_nothing(spark, tmp_path, monkeypatch):
    root, silver = str(tmp_path / "bronze"), str(tmp_path / "silver")

    def batch(path, number):
        documents = spark.read.schema(bronze.DOCUMENT).json(str(path))
        rows = documents.select(*bronze.document_columns(), F.col("_metadata.file_size").alias("length"))
        return silver_stream.merge_batch(spark, rows, number, "s", root, silver, "demand")

    def listed(*_):
        raise AssertionError("the folder was listed")

    monkeypatch.setattr(bronze, "bronze_inventory", listed)
    first = store(tmp_path, "2026-08-10", document(("DEU", "2026-07-01", 1.0)), 1000)
    second = store(tmp_path, "2026-09-10", document(("DEU", "2026-07-01", 4.0), ("FRA", "2025-08-01", 2.0)), 2000)
    assert batch(first, 0)["rows"] == 1 and batch(second, 1)["years"] == ["2025", "2026"]
    pointer = T.current_tables(spark, silver)["demand"]
    assert pointer["batches"] == {"s": 1} and pointer["version"] == 2
    assert batch(second, 1)["changed"] is False and batch(first, 0)["changed"] is False
    assert batch(first, 2)["changed"] is False  # its document is recorded already
    assert T.current_version(spark, silver) == 2
    monkeypatch.undo()
    assert run(spark, tmp_path)["changed"] is False  # the batch job finds the documents recorded


def test_stream_gives_the_same_snapshot(spark, tmp_path):
    def stream():
        silver_stream.run_available(
            spark, str(tmp_path / "bronze"), str(tmp_path / "silver"), "demand", str(tmp_path / "cp")
        )

    store(tmp_path, "2026-08-10", document(("DEU", "2026-07-01", 1.0)), 1000)
    stream()
    store(tmp_path, "2026-09-10", document(("DEU", "2026-07-01", 4.0), ("FRA", "2026-08-01", 2.0)), 2000)
    stream()
    assert state(spark, tmp_path) == {("DEU", "2026-07"): 4.0, ("FRA", "2026-08"): 2.0}
    version = T.current_version(spark, str(tmp_path / "silver"))
    stream()
    assert T.current_version(spark, str(tmp_path / "silver")) == version == 2


@pytest.fixture(scope="module")
def landing(spark):
    return Source().year("DEU", 2019).year("USA", 2019).silver(spark)


def test_ingestion_and_backfill(spark, landing, tmp_path):
    bronze_root, state_root = str(tmp_path / "bronze"), str(tmp_path / "state")

    def ingest_demand(frame):
        return ingest.run_ingestion(spark, {"demand": frame}, bronze_root, state_root)[0]

    def documents():
        return bronze.document_rows(
            bronze.read_documents(spark, f"{bronze_root}/demand"), "demand"
        )

    demand = landing["demand"]
    early = demand.where("month(date) <= 6")

    # no rows in scope: nothing written, no state
    assert ingest_demand(early.where("entity_code = 'USA'"))["action"] == "empty"
    assert ingest.read_state(spark, state_root).isEmpty()

    got = ingest_demand(early)
    assert (got["action"], got["last_source_date"]) == ("load", "2019-06-01")
    assert documents().count() == 6
    assert ingest_demand(early)["action"] == "skip"

    # a failed write does not advance the state
    original = bronze.append_documents
    bronze.append_documents = lambda *a: (_ for _ in ()).throw(OSError("storage is gone"))
    try:
        with pytest.raises(OSError):
            ingest_demand(demand)
    finally:
        bronze.append_documents = original
    assert ingest.read_state(spark, state_root).first()["last_source_date"] == "2019-06-01"

    # the next run loads from the following month on
    assert ingest_demand(demand)["last_source_date"] == "2019-12-01"
    assert documents().count() == 12

    # a backfill adds history and leaves the state alone
    done = ingest.run_backfill(spark, landing, bronze_root, ["deu", "DEU"], ["demand"], "2019-11")
    assert done[0]["written"] and documents().count() == 14
    assert ingest.read_state(spark, state_root).first()["last_source_date"] == "2019-12-01"
    with pytest.raises(ValueError, match="USA"):
        ingest.run_backfill(spark, landing, bronze_root, ["USA"], ["demand"])
    with pytest.raises(ValueError, match="unknown datasets"):
        ingest.run_backfill(spark, landing, bronze_root, ["DEU"], ["prices"])
    austria = ingest.run_backfill(spark, landing, bronze_root, ["AUT"], ["capacity"])
    assert austria[0]["written"] is False


def test_documents_must_declare_a_date(spark, tmp_path):
    path = store(tmp_path, "2026-08-10", '{"data": [{"a": "1"}], "stats": {}}', 1000)
    declared = ingest.declared_documents(spark, str(path), "demand")
    from almanack.operators.increments import state_advance

    with pytest.raises(Exception, match="no source date"):
        state_advance(declared).collect()
