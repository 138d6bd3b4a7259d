"""Round trips through the source readers."""

import os

import pytest
from pyspark.sql import functions as F

from tabula.sources import dbf
from tabula.sources import text as X

from .conftest import rows


def test_dbf_round_trip(spark, tmp_path):
    fields = [("ID", "N", 6), ("NOME", "C", 6), ("DT", "D", 8), ("OK", "L", 1), ("VAL", "N", 8)]
    cols = {"ID": ["1", "2", "3", "4"], "NOME": ["ana", "", "José", "x"], "DT": ["20240131", "00000000", "20230230", None],
            "OK": ["T", "f", "?", "y"], "VAL": ["5.00", "2.50", "abc", ""]}
    (tmp_path / "a.dbf").write_bytes(dbf.dbf_bytes(cols, fields, [False, False, False, True]))
    df = dbf.scan(spark, str(tmp_path), lineage="ARQUIVO_ORIGEM", bytesPerPartition=50)
    got = sorted(rows(df))
    assert got == [("1", "ana", "2024-01-31", "True", "5", "a.dbf"),
                   ("2", None, None, "False", "2.5", "a.dbf"),
                   ("3", "José", None, None, None, "a.dbf")]


def test_dbf_written_by_partitions(spark, tmp_path):
    src = spark.range(0, 1000, numPartitions=4).select(F.col("id").cast("string").alias("ID"),
                                                       (F.col("id") % 10 == 0).alias("_del"))
    folder = str(tmp_path / "d")
    dbf.write_partitions(src, folder, [("ID", "N", 6)], "_del").collect()
    df = dbf.scan(spark, folder, bytesPerPartition=333)
    assert df.count() == 900 and df.agg(F.countDistinct("ID")).first()[0] == 900


def test_fixed_width_python_strip(spark):
    df = spark.createDataFrame([("35\t0001 2",), ("11 0002 1",)], "value string")
    out = X.fixed_width(df, [("UF", 1, 2), ("EST", 3, 5), ("S", 8, 2)], where=F.substring("value", 1, 2) == "35")
    assert rows(out) == [("35", "0001", "2")]


def test_csv_latin1(spark, tmp_path):
    p = tmp_path / "c.csv"
    p.write_bytes("CÓDIGO;NOME\n1;São Paulo\n".encode("latin1"))
    df = X.header_normalize(X.csv_text(spark, str(p), encoding="ISO-8859-1"))
    assert df.columns == ["CODIGO", "NOME"] and rows(df) == [("1", "São Paulo")]


def test_wide_matrix(spark, tmp_path):
    p = tmp_path / "m.csv"
    p.write_text('Titulo\n"Linha";"2019";"Total"\n"a";"1.234";"9"\nFonte: x\n')
    out = X.wide_matrix(spark, str(p))
    assert out.columns == ["Linha", "2019", "Total"] and rows(out) == [("a", "1.234", "9")]
    assert os.path.exists(p)


def test_dbf_drifting_layouts_union_by_name(spark, tmp_path):
    a = dbf.dbf_bytes({"ID": ["1"], "CAUSABAS": ["C50"]}, [("ID", "N", 4), ("CAUSABAS", "C", 4)])
    b = dbf.dbf_bytes({"ID": ["2"], "IDADE": ["460"], "CAUSABAS": ["C61"]},
                      [("ID", "N", 4), ("IDADE", "C", 3), ("CAUSABAS", "C", 4)])
    (tmp_path / "a.dbf").write_bytes(a)
    (tmp_path / "b.dbf").write_bytes(b)
    df = dbf.scan(spark, str(tmp_path), lineage="ARQUIVO_ORIGEM")
    assert df.columns == ["ID", "CAUSABAS", "IDADE", "ARQUIVO_ORIGEM"]
    assert sorted(rows(df)) == [("1", "C50", None, "a.dbf"), ("2", "C61", "460", "b.dbf")]


def test_dbf_numbers_do_not_depend_on_their_neighbours(spark, tmp_path):
    values = ["123456789012345678", "", "-007", "1.50", "1e3", "nan", "9" * 18]
    (tmp_path / "n.dbf").write_bytes(dbf.dbf_bytes({"N": values}, [("N", "N", 18)]))
    for chunk in (1, 3, 100):
        df = dbf.scan(spark, str(tmp_path), schema="N string", recordsPerBatch=chunk)
        assert [r[0] for r in df.collect()] == ["123456789012345678", None, "-7", "1.5", "1000", None, "9" * 18]


def test_dbf_that_ends_early_is_an_error(spark, tmp_path):
    data = dbf.dbf_bytes({"ID": ["1", "2", "3"]}, [("ID", "N", 6)])
    (tmp_path / "t.dbf").write_bytes(data[:-10])
    with pytest.raises(Exception, match="ends in record 1 of 3|ends in record 2 of 3"):
        dbf.scan(spark, str(tmp_path), schema="ID string").collect()


def test_dbf_planning_reads_no_header(tmp_path):
    (tmp_path / "bad.dbf").write_bytes(b"not a table")
    (tmp_path / "two.dbf").write_bytes(b"x" * 250)
    reader = dbf.DbfReader({"path": str(tmp_path), "bytesPerPartition": "100"}, None)
    assert len(reader.partitions()) == 4


def test_csv_quotes_backslash_newline_and_broken_lines(spark, tmp_path):
    p = tmp_path / "q.csv"
    p.write_text('a;b\n"say ""cancer"" now";x\\\n"two\nlines";"y;z"\n')
    assert rows(X.csv_text(spark, str(p), multi_line=True)) == [('say "cancer" now', "x\\"), ("two\nlines", "y;z")]
    for bad in ("a;b\n1;2;3\n", "a;b\n1\n"):
        p.write_text(bad)
        with pytest.raises(Exception, match="MALFORMED|malformed|FAILFAST"):
            X.csv_text(spark, str(p)).select("a").collect()


def test_wide_matrix_of_several_exports(spark, tmp_path):
    (tmp_path / "1.csv").write_text('Titulo\n"Linha";"2019";"Total"\n"a";"1";"9"\n')
    (tmp_path / "2.csv").write_text('"Linha";"2020"\r\n"b;c";"2"\r\nFonte: x\r\n')
    (tmp_path / "3.csv").write_text("no separator here\n")
    out = X.wide_matrix(spark, str(tmp_path)).select("Linha", "2019", "2020", "Total")
    assert sorted(rows(out)) == [("a", "1", None, "9"), ("b;c", None, "2", None)]


FIELDS = [("ID", "N", 6), ("CAUSABAS", "C", 4), ("NOME", "C", 8)]


def _many(folder, files=30):
    for k in range(files):
        cols = {"ID": [str(10 * k + j) for j in range(4)], "CAUSABAS": ["C509", " d10", "A000", None], "NOME": ["ana", "", "x", "é"]}
        (folder / f"DO{k:02d}.dbf").write_bytes(dbf.dbf_bytes(cols, FIELDS))


def test_dbf_small_files_share_partitions(spark, tmp_path):
    _many(tmp_path)
    df = dbf.scan(spark, str(tmp_path), schema="ID string")
    assert df.rdd.getNumPartitions() < 5 and df.count() == 120
    large = dbf.scan(spark, str(tmp_path), schema="ID string", bytesPerPartition=100)
    assert large.count() == 120 and large.select("ID").distinct().count() == 120


def test_dbf_filters_decode_one_field_of_dropped_records(spark, tmp_path):
    _many(tmp_path, 2)
    df = dbf.scan(spark, str(tmp_path), schema="ID string, CAUSABAS string, ARQUIVO_ORIGEM string", lineage="ARQUIVO_ORIGEM")
    assert sorted(rows(df.filter("CAUSABAS = 'C509'"), "ID")) == [("0",), ("10",)]
    assert sorted(rows(df.filter("CAUSABAS like 'A%' and ARQUIVO_ORIGEM = 'DO01.dbf'"), "ID")) == [("12",)]
    assert sorted(rows(df.filter("CAUSABAS in ('A000', 'd10') and ID >= '11'"), "ID")) == [("11",), ("12",), ("2",)]
    assert df.filter("CAUSABAS is not null").count() == 6 and df.filter("CAUSABAS <=> null").count() == 2
    assert df.filter("CAUSABAS < 'C' or ID = '0'").count() == 3  # not pushed: evaluated by Spark
    some = dbf.scan(spark, str(tmp_path), schema="ID string", prefixes={"CAUSABAS": ["C", "D1"]}, files=["DO00.dbf"])
    assert sorted(rows(some)) == [("0",), ("1",)]
    decoded = []
    reader = dbf.DbfReader({"path": str(tmp_path), "files": '["DO00.dbf"]'}, df.schema)
    assert list(reader.pushFilters([dbf.EqualTo(("CAUSABAS",), "A000")])) == []
    real = dbf._convert
    try:
        dbf._convert = lambda kind, raw: decoded.append(len(raw)) or real(kind, raw)
        list(reader.read(reader.partitions()[0]))
    finally:
        dbf._convert = real
    assert decoded == [4, 1, 1]  # the tested field of all records, then two fields of the one left


def test_dbf_read_report_and_skipping(spark, tmp_path):
    _many(tmp_path, 3)
    whole = (tmp_path / "DO01.dbf").read_bytes()
    (tmp_path / "DO01.dbf").write_bytes(whole[:-30])
    (tmp_path / "DO03.dbf").write_bytes(b"\x03\x7c")
    (tmp_path / "DO04.dbf").write_bytes(b"")
    (tmp_path / "DO05.dbf").write_bytes(whole.replace(b"NOME\x00\x00\x00\x00\x00\x00\x00C", b"NOME\x00\x00\x00\x00\x00\x00\x00M"))
    told = {r["ARQUIVO"]: (r["REGISTROS"], r["MOTIVO"]) for r in dbf.read_report(spark, str(tmp_path)).collect()}
    assert told["DO00.dbf"] == (4, None) and told["DO02.dbf"] == (4, None)
    assert told["DO01.dbf"][1].startswith("ends in record") and told["DO03.dbf"] == (None, "no whole header")
    assert told["DO04.dbf"][1] == "no whole header" and told["DO05.dbf"][1] == "field type 'M' not supported"
    read = dbf.scan(spark, str(tmp_path), lineage="A", on_error="skip", bytesPerPartition=60)
    assert sorted(rows(read.select("A").distinct())) == [("DO00.dbf",), ("DO02.dbf",)]
    with pytest.raises(Exception, match="ends in record|no whole header|not supported"):
        dbf.scan(spark, str(tmp_path), schema="ID string").collect()


def test_paths_of_object_stores(tmp_path):
    from tabula.sources.files import list_files, open_store

    (tmp_path / "a.dbf").write_bytes(b"x")
    (tmp_path / "_b.dbf").write_bytes(b"x")
    assert list_files(f"file://{tmp_path}", ".dbf") == [(f"file://{tmp_path}/a.dbf", 1)] and list_files(str(tmp_path), ".dbf") == [(f"{tmp_path}/a.dbf", 1)]
    for uri in (f"file:{tmp_path}/a.dbf", f"file:///{tmp_path}/a.dbf", f"{tmp_path}/a.dbf"):
        store, own = open_store(uri)
        assert store.open_input_file(own).read() == b"x"
    store, own = open_store("s3a://landing/sim/a.dbf", '{"region": "sa-east-1", "endpoint_override": "store.example:9000"}')
    assert store.type_name == "s3" and own == "landing/sim/a.dbf" and store.region == "sa-east-1"


def test_wide_matrix_headers_and_odd_lines(spark, tmp_path):
    (tmp_path / "m").mkdir()
    (tmp_path / "m" / "a.csv").write_bytes('﻿Titulo\r\n"Faixa; etaria";"Ate 10";"Total"\r\n"a; b";"1";"2"\r\n"x";"5"\r\n"y";"1";"2";"3"\r\n"z;1;2\r\nFonte\r\n'.encode())
    (tmp_path / "m" / "b.csv").write_text('﻿Total;;Total;`q`\n1;2;3;4\n')
    (tmp_path / "m" / "c.csv").write_text("only;one\n")
    good, bad = X.wide_matrix_with_rejects(spark, str(tmp_path / "m"))
    assert sorted(good.columns) == sorted(["Faixa; etaria", "Ate 10", "Total", "coluna_2", "Total_3", "`q`"])
    got = [{k: v for k, v in r.asDict().items() if v is not None} for r in good.collect()]
    assert sorted(got, key=len) == [{"Faixa; etaria": "a; b", "Ate 10": "1", "Total": "2"}, {"Total": "1", "coluna_2": "2", "Total_3": "3", "`q`": "4"}]
    assert sorted(rows(bad, "ARQUIVO", "LINHA", "MOTIVO")) == [("a.csv", 4, "2 fields of 3"), ("a.csv", 5, "4 fields of 3"), ("a.csv", 6, "quote not closed")]


def test_csv_rejects_cost_their_line_alone(spark, tmp_path):
    p = tmp_path / "c.csv"
    p.write_bytes('CÓDIGO;NOME\n1;São Paulo\n2\n3;"a;b"\n4;x;y\n5;\n'.encode("latin1"))
    good, bad = X.csv_with_rejects(spark, str(p), encoding="ISO-8859-1")
    assert good.columns == ["CÓDIGO", "NOME"] and sorted(rows(good), key=str) == [("1", "São Paulo"), ("3", "a;b"), ("5", None)]
    assert sorted(rows(bad)) == [("c.csv", "1 fields of 2", "2"), ("c.csv", "3 fields of 2", "4;x;y")]


def test_dbf_files_are_written_row_by_row(spark, tmp_path):
    """No task holds a whole file, and header, records and end agree."""
    names = {"A.dbc": 2500, "B.dbc": 1, "C.dbc": 700}
    src = spark.createDataFrame([(n, f"{k}", "é中" if k % 2 else None) for n, size in names.items() for k in range(size)], "f string, ID string, T string")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        told = dbf.write_files(src.repartition(3), str(tmp_path), [("ID", "N", 6), ("T", "C", 3)], "f")
        assert "FlatMapGroups" not in told._jdf.queryExecution().toString()
        assert dict(rows(told)) == names
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    for n, size in names.items():
        data = (tmp_path / n).read_bytes()
        assert len(data) == 32 + 2 * 32 + 1 + 10 * size + 1 and data.endswith(b"\x1a")
    back = dbf.scan(spark, str(tmp_path), suffix=".dbc", lineage="f").select("f", "ID", "T")
    expected = [(n, f"{k}", "\u00e9?" if k % 2 else None) for n, size in names.items() for k in range(size)]
    assert sorted(map(str, rows(back))) == sorted(map(str, expected))
    import pytest

    with pytest.raises(Exception, match="without the name"):
        dbf.write_files(spark.createDataFrame([(None, "1")], "f string, ID string"), str(tmp_path), [("ID", "N", 6)], "f").collect()


def test_a_file_stays_whole_where_a_join_becomes_a_broadcast(spark, tmp_path):
    """F1 of round 4: one task has all rows of a name, whatever Spark makes of the plan while it runs."""
    as_large = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "10m",
                "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in as_large}
    src = spark.range(0, 3000, numPartitions=6).select(F.concat(F.lit("F"), (F.col("id") % 2).cast("string"), F.lit(".dbc")).alias("f"), F.col("id").cast("string").alias("ID"))
    try:
        for k, v in as_large.items():
            spark.conf.set(k, v)
        assert sorted(rows(dbf.write_files(src, str(tmp_path), [("ID", "N", 6)], "f"))) == [("F0.dbc", 1500), ("F1.dbc", 1500)]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    back = dbf.scan(spark, str(tmp_path), suffix=".dbc", lineage="f").select("f", "ID")
    assert sorted(rows(back)) == sorted((f"F{k % 2}.dbc", f"{k}") for k in range(3000))


def test_one_small_file_per_name(spark, tmp_path):
    """as many files as names, from all tasks, rows in their order, a name's rows in one file."""
    from tabula.sources.files import write_named

    lines = spark.range(0, 1500, numPartitions=1).select(F.concat(F.lit("k="), (F.col("id") % 500).cast("string"), F.lit(".txt")).alias("arquivo"),
                                                         F.concat(F.col("id").cast("string"), F.lit("\n")).cast("binary").alias("registro"))
    told = write_named(lines, str(tmp_path))
    assert told.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert sorted(rows(told)) == sorted((f"k={k}.txt", 3) for k in range(500))
    assert (tmp_path / "k=7.txt").read_bytes() == b"7\n507\n1007\n"
    assert len(list(tmp_path.iterdir())) == 500


def test_changed_by_content_lands_without_folders(spark, tmp_path):
    """the landed files lie in one folder, not in one folder each."""
    from tabula.fixtures import Tables
    from tabula.queries import planning
    from tabula.session import shared_dir

    spark.createDataFrame([(1, "a"), (3, None), (4, "é")], "s_suppkey long, s_name string").write.parquet(str(tmp_path / "supplier.parquet"))
    at = shared_dir(spark).removeprefix("file:")
    before = set(os.listdir(at))
    got = sorted(rows(planning.changed_by_content(Tables(spark, str(tmp_path))), "s_suppkey", "ALTERADO"))
    assert got == [(1, False), (3, True), (4, False)]
    (landed,) = [n for n in set(os.listdir(at)) - before if n.startswith("content-")]
    assert sorted(os.listdir(f"{at}/{landed}")) == ["s_suppkey=1.txt", "s_suppkey=3.txt", "s_suppkey=4.txt"]
