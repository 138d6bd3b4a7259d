"""Deliveries as they may come: parts, replacements, repeats, broken files."""

import os

from tabula.operators import snapshots as S
from tabula.streaming.arrival import arrival_merge, quarantined

SCHEMA = "k string, v int"


class Landing:
    def __init__(self, spark, tmp_path, **options):
        self.spark, self.at, self.options = spark, tmp_path, options
        self.table, self.ckpt, self.clock = str(tmp_path / "table"), str(tmp_path / "ckpt"), 1_700_000_000

    def put(self, name, *rows):
        """One parquet file of that name (a folder may lead)."""
        work = self.at / "work"
        self.spark.createDataFrame(list(rows), SCHEMA).coalesce(1).write.mode("overwrite").parquet(str(work))
        part = next(p for p in work.iterdir() if p.name.startswith("part-"))
        self.drop(name, part.read_bytes())

    def drop(self, name, data):
        target = self.at / "landing" / name
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_bytes(data)
        self.clock += 10
        os.utime(target, (self.clock, self.clock))

    def run(self, **options):
        schema = self.spark.createDataFrame([], SCHEMA).schema
        arrival_merge(self.spark, str(self.at / "landing"), schema, self.table, "k", checkpoint=self.ckpt, **{**self.options, **options})
        return self.held()

    def held(self):
        df = S.read(self.spark, self.table)
        return None if df is None else sorted(tuple(r) for r in df.collect())


def test_parts_add_up_and_repeats_replace(spark, tmp_path):
    land = Landing(spark, tmp_path, files_per_trigger=1)
    land.put("a1.parquet", ("x", 1), ("y", 1))
    land.put("a2.parquet", ("x", 2))
    assert land.run() == [("x", 1), ("x", 2), ("y", 1)]
    assert land.run() == [("x", 1), ("x", 2), ("y", 1)] and S.version(spark, land.table).number == 1  # nothing new, nothing published
    land.put("b1.parquet", ("x", 3), ("x", 4))  # the same folder, another name
    assert land.run() == [("x", 3), ("x", 4), ("y", 1)]


def test_a_file_replaced_in_place(spark, tmp_path):
    land = Landing(spark, tmp_path)
    land.put("a1.parquet", *[("x", k) for k in range(10)])
    land.put("a2.parquet", ("x", 10), ("z", 1))
    land.run()
    land.put("a1.parquet", ("x", 77), ("y", 5))
    assert land.run() == [("x", 10), ("x", 77), ("y", 5), ("z", 1)]  # the other part stays
    land.put("a2.parquet", ("x", 11))  # its z is gone
    assert land.run() == [("x", 11), ("x", 77), ("y", 5)]
    land.put("a1.parquet")
    assert land.run() == [("x", 11)]


def test_late_parts_of_a_folder(spark, tmp_path):
    land = Landing(spark, tmp_path, delivery="folder")
    land.put("d1/a.parquet", ("x", 1))
    land.run()
    land.put("d1/b.parquet", ("x", 2))
    assert land.run() == [("x", 1), ("x", 2)]
    land.put("d2/a.parquet", ("x", 3))
    assert land.run() == [("x", 3)]
    land.put("d1/a.parquet", ("x", 9))  # the older delivery changed: it is the latest now
    assert land.run() == [("x", 2), ("x", 9)]


def test_a_broken_file_keeps_its_rows_and_the_others_go_on(spark, tmp_path):
    land = Landing(spark, tmp_path)
    land.put("a.parquet", ("x", 1))
    land.put("b.parquet", ("y", 1))
    land.put("c.parquet", ("z", 1))
    land.run()
    whole = (tmp_path / "landing" / "a.parquet").read_bytes()
    land.drop("a.parquet", whole[:-9])
    land.drop("n.parquet", b"junk")
    land.put("b.parquet", ("y", 2))
    assert land.run() == [("x", 1), ("y", 2), ("z", 1)]
    told = {(r["caminho"].rsplit("/", 1)[1], r["motivo"] is not None) for r in quarantined(spark, land.ckpt).collect()}
    assert told == {("a.parquet", True), ("n.parquet", True)}
    assert land.run() == [("x", 1), ("y", 2), ("z", 1)]  # tried again, still broken
    land.put("a.parquet", ("x", 5))
    assert land.run() == [("x", 5), ("y", 2), ("z", 1)]


def test_a_key_waits_for_its_broken_part(spark, tmp_path):
    land = Landing(spark, tmp_path)
    land.put("a.parquet", ("x", 1), ("w", 1))
    land.put("b.parquet", ("x", 2), ("v", 1))
    land.run()
    land.drop("a.parquet", b"PAR1 cut")
    land.put("b.parquet", ("x", 3), ("v", 2))
    assert land.run() == [("v", 2), ("w", 1), ("x", 1), ("x", 2)]  # x needs a.parquet
    land.put("a.parquet", ("x", 4))
    assert land.run() == [("v", 2), ("x", 3), ("x", 4)]


def test_hash_signatures_see_equal_sizes_and_times(spark, tmp_path):
    land = Landing(spark, tmp_path, signature="hash")
    land.put("a.parquet", ("x", 1))
    land.run()
    same = tmp_path / "landing" / "a.parquet"
    stamp = same.stat().st_mtime
    land.put("a.parquet", ("x", 2))
    os.utime(same, (stamp, stamp))
    assert land.run() == [("x", 2)]
    os.utime(same, (stamp + 99, stamp + 99))  # touched only
    land.run()
    assert S.version(spark, land.table).number == 2


def test_a_lost_pass_is_repeated(spark, tmp_path, monkeypatch):
    land = Landing(spark, tmp_path)
    land.put("a.parquet", ("x", 1))
    land.run()
    land.put("a.parquet", ("x", 2))
    land.put("b.parquet", ("y", 1))
    with monkeypatch.context() as m:
        m.setattr(S, "commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        try:
            land.run()
        except OSError:
            pass
    assert land.held() == [("x", 1)]
    assert land.run() == [("x", 2), ("y", 1)]
    kept = [p.name for p in (tmp_path / "ckpt" / "compacta").iterdir()]
    assert len(kept) <= 2 and not list((tmp_path / "ckpt" / "lidos").iterdir())
