"""Commits by several writers at once."""

import time
from concurrent.futures import ThreadPoolExecutor
from threading import Lock

import pytest

from almanack.plans import ingest
from almanack.sources import tables as T, versions as V


def test_no_commit_of_two_writers_is_lost(spark, tmp_path):
    root = str(tmp_path / "tables")

    def write(n):
        return T.commit(spark, root, [{"table": f"t{n}", "location": f"{root}/t{n}/x", "row_count": n}])

    with ThreadPoolExecutor(4) as pool:
        found = list(pool.map(write, range(12)))
    assert sorted(found) == list(range(1, 13))
    assert set(T.current_tables(spark, root)) == {f"t{n}" for n in range(12)}
    assert T.current_version(spark, root) == 12


def test_a_version_is_written_once(spark, tmp_path):
    path = f"{tmp_path}/log/{V.file_name(1)}"
    assert V.create_once(spark, path, '{"a": 1}')
    assert not V.create_once(spark, path, '{"a": 2}')
    assert V.rows_of(spark, f"{tmp_path}/log", 1) == [{"a": 1}]
    assert V.rows_of(spark, f"{tmp_path}/log", 2) == []
    assert V.newest(spark, f"{tmp_path}/none") == 0


def test_states_of_two_datasets_side_by_side(spark, tmp_path):
    root = str(tmp_path)
    with ThreadPoolExecutor(2) as pool:
        list(pool.map(lambda d: ingest._advance(spark, root, d, "2026-08-01"), ["demand", "capacity"]))
    got = {tuple(r) for r in ingest.read_state(spark, root).collect()}
    assert got == {("demand", "2026-08-01"), ("capacity", "2026-08-01")}


def test_a_conflict_begins_anew_from_the_other_version(spark, tmp_path):
    root, calls = str(tmp_path / "v"), []

    def change(rows, version):
        calls.append(len(rows))
        if len(calls) == 1:  # another writer is faster
            V.create_once(spark, f"{root}/{V.file_name(version)}", '{"who": "other"}')
        return [*rows, {"who": "me"}]

    assert V.advance(spark, root, change) == 2
    assert V.rows_of(spark, root, 2) == [{"who": "other"}, {"who": "me"}]
    assert calls == [0, 1]


class ObjectStore:
    """A store double without rename: objects appear whole, and a creation may be refused
    because the object exists. Listings are slow enough for writers to meet."""

    def __init__(self):
        self.objects, self.lock, self.refused = {}, Lock(), 0

    def names(self, folder):
        found = [p.rsplit("/", 1)[1] for p in list(self.objects) if p.rsplit("/", 1)[0] == folder]
        time.sleep(0.002)
        return found

    def read(self, path):
        return self.objects.get(path)

    def create(self, path, text):
        with self.lock:
            if path in self.objects:
                self.refused += 1
                return False
            self.objects[path] = text
            return True


def test_two_writers_on_a_store_without_rename(spark):
    store = ObjectStore()

    def write(n):
        return T.commit(spark, "store://x", [{"table": f"t{n}", "location": f"l{n}"}], store=store)

    with ThreadPoolExecutor(2) as pool:
        found = list(pool.map(write, range(20)))
    assert sorted(found) == list(range(1, 21)) and store.refused > 0
    assert set(T.current_tables(spark, "store://x", store=store)) == {f"t{n}" for n in range(20)}
    assert len(store.objects) == 20


def test_what_a_store_declares_decides(spark, tmp_path, monkeypatch):
    store = V.HadoopStore(spark)
    assert store.way(str(tmp_path)) == "rename"
    spark.conf.set("spark.almanack.commit.file", "create")
    try:
        path = f"{tmp_path}/log/{V.file_name(1)}"
        assert store.create(path, "one") and not store.create(path, "two")
        assert store.read(path) == "one" and store.read(path + "x") is None
    finally:
        spark.conf.unset("spark.almanack.commit.file")
    monkeypatch.setattr(V, "RENAMING", ())
    with pytest.raises(V.UnsafeStore, match="file"):
        store.create(f"{tmp_path}/log/{V.file_name(2)}", "three")
    assert store.names(f"{tmp_path}/log") == [V.file_name(1)] or V.file_name(2) not in store.names(f"{tmp_path}/log")
