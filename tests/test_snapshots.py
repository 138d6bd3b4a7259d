"""Publishing by versions: what a reader sees, when, and what is left behind."""

import threading

import pytest
from pyspark.sql import functions as F

from tabula.operators import snapshots as S

SCHEMA = "ARQUIVO string, n int"


def held(spark, path, number=None):
    df = S.read(spark, path, number)
    return None if df is None else sorted((tuple(r) for r in df.collect()), key=str)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def test_versions_replace_keys(spark, tmp_path):
    path = str(tmp_path / "t")
    assert S.read(spark, path) is None and S.vacuum(spark, path) == []
    assert S.commit(frame(spark, ("a", 1), ("a", 2), ("b", 3), (None, 9)), path, "ARQUIVO") == 1
    read = frame(spark, ("b", 0), ("c", 0))
    S.commit(frame(spark, ("c", 5), (None, 8)), path, "ARQUIVO", read)  # b was read without a surviving row
    assert held(spark, path) == sorted([("a", 1), ("a", 2), ("c", 5), (None, 8), (None, 9)], key=str)
    assert held(spark, path, 1) == sorted([("a", 1), ("a", 2), ("b", 3), (None, 9)], key=str)
    S.commit(frame(spark, ("z", 1)), path, "ARQUIVO", replace_all=True)
    assert held(spark, path) == [("z", 1)]
    S.commit(frame(spark).filter("false"), path, "ARQUIVO", frame(spark, ("z", 0)))
    assert held(spark, path) == [] and S.read(spark, path).columns == ["ARQUIVO", "n"]


def test_keys_keep_their_type_and_layouts_may_grow(spark, tmp_path):
    path = str(tmp_path / "t")
    S.commit(spark.createDataFrame([("007", 1), ("x=/ y", 2)], SCHEMA), path, "ARQUIVO")
    S.commit(spark.createDataFrame([("008", 3, "new")], "ARQUIVO string, n int, extra string"), path, "ARQUIVO")
    assert held(spark, path) == sorted([("007", 1, None), ("x=/ y", 2, None), ("008", 3, "new")], key=str)
    years = str(tmp_path / "y")
    S.commit(spark.createDataFrame([(2020, "a")], "ANO int, v string"), years, "ANO")
    S.commit(spark.createDataFrame([(2021, "b"), (2020, "c")], "ANO int, v string"), years, "ANO")
    assert sorted(tuple(r) for r in S.read(spark, years).collect()) == [(2020, "c"), (2021, "b")]
    with pytest.raises(ValueError):
        S.commit(spark.createDataFrame([("b", 2021)], "v string, ANO int"), years, "v")


def test_a_reader_sees_the_old_state_or_the_new_one(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    old, new = [("a", 1), ("b", 1)], [("b", 2), ("c", 2)]
    S.commit(frame(spark, *old), path, "ARQUIVO")
    opened = S.read(spark, path)  # a reader that began before the publish
    seen = []
    point = S.point
    monkeypatch.setattr(S, "point", lambda *a: (seen.append(held(spark, path)), point(*a), seen.append(held(spark, path))))
    S.commit(frame(spark, *new), path, "ARQUIVO", frame(spark, ("a", 0)))
    assert seen == [old, new] and held(spark, path) == new
    assert sorted(tuple(r) for r in opened.collect()) == old


def test_a_publish_that_fails_leaves_the_table_as_it_was(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    S.commit(frame(spark, ("a", 1)), path, "ARQUIVO")

    def broken(*_):
        raise OSError("no space")

    with monkeypatch.context() as m:
        m.setattr(S, "point", broken)
        with pytest.raises(OSError):
            S.commit(frame(spark, ("a", 2)), path, "ARQUIVO")
    assert held(spark, path) == [("a", 1)]
    (tmp_path / "t" / "_atual" / "0000000002").write_text('{"key": "ARQ')  # a writer that was lost while it wrote the pointer
    assert held(spark, path) == [("a", 1)]
    assert S.commit(frame(spark, ("a", 3)), path, "ARQUIVO") == 3
    assert held(spark, path) == [("a", 3)]


def test_of_two_writers_one_wins(spark, tmp_path):
    path = str(tmp_path / "t")
    S.commit(frame(spark, ("a", 0)), path, "ARQUIVO")
    gate, told = threading.Barrier(2), []  # both have read version 1 before either commits

    def write(k):
        try:
            told.append(S.commit(frame(spark, ("a", k)), path, "ARQUIVO"))
        except S.ConcurrentPublish:
            told.append(None)

    first = S.last_number
    S.last_number = lambda *a: (first(*a), gate.wait())[0]
    try:
        threads = [threading.Thread(target=write, args=(k,)) for k in (1, 2)]
        [t.start() for t in threads]
        [t.join() for t in threads]
    finally:
        S.last_number = first
    assert sorted(told, key=str) == [2, None]
    assert held(spark, path) in ([("a", 1)], [("a", 2)])


def test_vacuum_keeps_what_kept_versions_need(spark, tmp_path):
    path = str(tmp_path / "t")
    for k in range(4):
        S.commit(frame(spark, ("a", k), (f"k{k}", k)), path, "ARQUIVO")
    now, before = held(spark, path), held(spark, path, 3)
    assert S.vacuum(spark, path, keep=2)
    assert held(spark, path) == now and held(spark, path, 3) == before and S.version(spark, path, 1) is None
    lots = {p.name for p in (tmp_path / "t").glob("lote=*")}
    assert len(lots) == 4  # k0 and k1 still live in the first two lots
    S.commit(frame(spark, ("a", 9)), path, "ARQUIVO", replace_all=True)
    S.vacuum(spark, path, keep=1)
    assert held(spark, path) == [("a", 9)] and len(list((tmp_path / "t").glob("lote=*"))) == 1
    assert S.vacuum(spark, path, keep=1) == []


def test_latest_period_reads_one_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    assert S.read_latest(spark, path) is None
    S.commit(spark.createDataFrame([("9912", 1), ("0105", 2), ("0105", 3), (None, 4)], "AAMM string, n int"), path, "AAMM")
    S.commit(spark.createDataFrame([("0106", 5), ("0004", 6)], "AAMM string, n int"), path, "AAMM")
    full = lambda p: F.concat(F.when(p >= "90", "19").otherwise("20"), p)
    latest = S.read_latest(spark, path, full)
    assert sorted(tuple(r) for r in latest.collect()) == [("0106", 5)]
    assert len(latest.inputFiles()) >= 1 and sorted(tuple(r) for r in S.read_latest(spark, path).collect()) == [("9912", 1)]
    plan = latest._jdf.queryExecution().executedPlan().toString()
    pruned = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "(AAMM" in pruned and "lote" in pruned
