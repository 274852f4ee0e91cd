import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from opslake import sources
from opslake.sources import audit, readers, writers


def test_parquet_blank_is_null_and_days_prune(spark, rows, tmp_path):
    data = [("s1", "2026-08-07", ""), ("s2", "2026-08-08", "I-1"), ("s3", "2026-08-09", " "), ("s4", "2026-08-08", "")]
    df = spark.createDataFrame(data, "scan_id string, festival_date string, incident_id string")
    path = str(tmp_path / "t")
    writers.write_by_day(df, path, "festival_date")
    back = sources.read_table(spark, path, "scan_id string, festival_date string, incident_id string")
    assert back.columns == ["scan_id", "festival_date", "incident_id"]
    assert rows(back) == sorted([("s1", "2026-08-07", None), ("s2", "2026-08-08", "I-1"), ("s3", "2026-08-09", " "), ("s4", "2026-08-08", None)])
    one = sources.read_table(spark, path, days=[dt.date(2026, 8, 8)])
    assert rows(one, "scan_id") == [("s2",), ("s4",)]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    assert sources.read_table(spark, path, days=[]).count() == 0
    with pytest.raises(ValueError):
        sources.read_table(spark, path + "/year=2026/month=08/day=07", days=[dt.date(2026, 8, 7)])


def test_filter_on_plain_column_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([("a", "")], "gate_id string, note string").write.parquet(path)
    df = sources.read_table(spark, path, blank=["note"]).where("gate_id = 'a'").select("gate_id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(gate_id,a)" in plan and "ReadSchema: struct<gate_id:string>" in plan


def test_csv_bom_bad_rows(spark, rows, tmp_path):
    f = tmp_path / "x.csv"
    f.write_text("﻿id,capacity,name\nA,10,x\nB,oops,y\nC,,\n", encoding="utf-8")
    ddl = "id string, capacity bigint, name string"
    assert rows(sources.read_csv(spark, str(f), ddl)) == [("A", 10, "x"), ("C", None, None)]
    assert rows(sources.read_csv(spark, str(f), ddl).select("id")) == [("A",), ("C",)]  # pruning does not hide bad rows
    kept = sources.read_csv(spark, str(f), ddl, on_bad="keep")
    assert rows(audit.scan_report({"x": kept})) == [("x", 3, 1)]
    with pytest.raises(Exception):
        sources.read_csv(spark, str(f), ddl, on_bad="fail").collect()
    assert sources.all_text_csv(spark, str(f)).columns == ["id", "capacity", "name"]


def test_csv_json_round_trip(spark, rows, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", None)], "s string, n bigint")
    writers.write_csv(df, str(tmp_path / "c"))
    writers.write_json(df, str(tmp_path / "j"))
    assert rows(sources.read_csv(spark, str(tmp_path / "c"), "s string, n bigint")) == rows(df)
    assert rows(sources.read_json(spark, str(tmp_path / "j"), "s string, n bigint")) == rows(df)


def test_schema_from_first_file_is_not_merged(spark, tmp_path):
    spark.createDataFrame([(1, 2)], "a int, b int").write.parquet(str(tmp_path / "t/p=1"))
    spark.createDataFrame([(1,)], "a int").write.parquet(str(tmp_path / "t/p=2"))
    got = set(sources.read_table(spark, str(tmp_path / "t")).columns)
    assert got in ({"a", "b", "p"}, {"a", "p"})


def test_ensure_table_and_inline_rows(spark, rows, tmp_path):
    f = tmp_path / "d.csv"
    f.write_text("document_id,version\nD1,1\n")
    sources.ensure_table(spark, "docs_once", str(f), "document_id string, version string")
    f.write_text("document_id,version\nD1,1\nD2,2\n")
    assert sources.ensure_table(spark, "docs_once", str(tmp_path / "other.csv"), "x string").columns == ["document_id", "version"]
    assert rows(sources.inline_rows(spark, [(1, "a")], "i int, s string")) == [(1, "a")]


def test_read_known_tables(spark, rows, tmp_path):
    (tmp_path / "data/csv/master").mkdir(parents=True)
    (tmp_path / "data/csv/master/stages.csv").write_text(
        "stage_id,stage_name,stage_type,capacity,location_zone,network_zone,weather_exposed_flag\nS,Main,OUT,5,N,A,1\n")
    assert rows(sources.read_known(spark, str(tmp_path), "stages")) == [("S", "Main", "OUT", 5, "N", "A", 1)]
    (tmp_path / "data/jsonl").mkdir()
    (tmp_path / "data/jsonl/staff_action_logs.jsonl").write_text('{"log_id": "1", "incident_id": "", "action_type": "X"}\n')
    assert rows(sources.read_known(spark, str(tmp_path), "staff_action_logs"), "log_id", "incident_id", "team_id") == [("1", None, None)]


def test_hash_report(spark, rows, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub/a.txt").write_bytes(b"hello")
    (tmp_path / "b.txt").write_bytes(b"changed")
    digest = lambda b: hashlib.sha256(b).hexdigest()
    manifest = spark.createDataFrame(
        [("sub/a.txt", digest(b"hello")), ("b.txt", digest(b"old")), ("gone.txt", digest(b""))], "relative_path string, sha256 string")
    got = audit.hash_report(audit.file_hashes(spark, str(tmp_path)), manifest, str(tmp_path))
    assert rows(got) == [("b.txt", False), ("gone.txt", False), ("sub/a.txt", True)]


def test_shape_files_and_counts(spark, rows, tmp_path):
    df = spark.createDataFrame([("a", 1)], "s string, n bigint")
    expected = StructType([StructField("s", StringType(), False), StructField("m", LongType()), StructField("n", StringType())])
    got = rows(audit.shape_report(spark, df, expected, rows=2))
    assert got == sorted([("m", "missing"), ("n", "type bigint, expected string"), ("s", "nullable"), (None, "1 rows, expected 2")], key=repr)
    df.repartition(1).write.parquet(str(tmp_path / "t"))
    files = audit.files_of(spark.read.parquet(str(tmp_path / "t"))).collect()
    assert len(files) == 1 and files[0]["rows"] == 1
    assert rows(audit.row_counts({"x": df, "y": df.limit(0)})) == [("x", 1), ("y", 0)]


def test_comments_dictionary_catalog(spark, rows):
    df = audit.with_comments(spark.createDataFrame([("a", 1)], "s string, n bigint"), {"n": "a number"})
    assert rows(audit.dictionary(spark, {"t": df})) == [("t", 1, "s", "string", None), ("t", 2, "n", "bigint", "a number")]
    assert audit.public_views(spark, {"only_s": (df, ["s"])}) == ["only_s"]
    assert spark.table("only_s").columns == ["s"]
    assert rows(audit.catalog_report(spark, ["only_s", "no_such"])) == [("no_such", None, False), ("only_s", "TEMPORARY", True)]
    with pytest.raises(Exception):
        spark.table("only_s").select(F.col("n"))


def test_read_table_keeps_real_day_columns(spark, tmp_path):
    spark.createDataFrame([(1, 2020, 5)], "id int, year int, day int").write.parquet(str(tmp_path / "plain"))
    assert readers.read_table(spark, str(tmp_path / "plain")).columns == ["id", "year", "day"]
    rows = spark.createDataFrame([(1, "2020-01-02")], "id int, d string")
    writers.write_by_day(rows, str(tmp_path / "days"), "d")
    assert readers.read_table(spark, str(tmp_path / "days")).columns == ["id", "d"]
    assert readers.read_table(spark, str(tmp_path / "days"), "id int, d string, day int").columns == ["id", "d", "day"]


def test_hash_report_takes_the_root_literally(spark, tmp_path):
    root = tmp_path / "a+b (c)"
    root.mkdir()
    (root / "x.txt").write_bytes(b"abc")
    listed = spark.createDataFrame([("x.txt", hashlib.sha256(b"abc").hexdigest()), ("y.txt", "00")], "relative_path string, sha256 string")
    hashes = spark.createDataFrame([(f"file:{root}/x.txt", 3, hashlib.sha256(b"abc").hexdigest())], "path string, size_bytes long, sha256 string")
    assert {tuple(r) for r in audit.hash_report(hashes, listed, str(root)).collect()} == {("x.txt", True), ("y.txt", False)}


def test_large_files_are_hashed_in_blocks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(audit, "BLOCK_BYTES", 7)
    for name, size in (("a.txt", 5), ("b.txt", 100), ("c d.txt", 1000)):
        (tmp_path / name).write_bytes(b"x" * size)
    got = {r.path.rsplit("/", 1)[1]: (r.size_bytes, r.sha256) for r in audit.file_hashes(spark, str(tmp_path), whole_bytes=50).collect()}
    assert got == {n.replace(" ", "%20") if n.replace(" ", "%20") in got else n: (s, hashlib.sha256(b"x" * s).hexdigest()) for n, s in (("a.txt", 5), ("b.txt", 100), ("c d.txt", 1000))}


def test_each_large_file_has_a_task(spark, tmp_path):
    for i in range(12):
        (tmp_path / f"f{i}.bin").write_bytes(bytes([i]) * 1000)
    df = audit.file_hashes(spark, str(tmp_path), whole_bytes=50)
    assert "RoundRobinPartitioning(12)" in df._jdf.queryExecution().executedPlan().toString()
    assert {r.sha256 for r in df.collect()} == {hashlib.sha256(bytes([i]) * 1000).hexdigest() for i in range(12)}


def test_scratch_on_a_single_machine_is_refused_elsewhere():
    from opslake.sources.scratch import sees_all

    assert sees_all("file:/tmp/w", "local[4]") and sees_all("/tmp/w", "local-cluster[2,1,1024]") and sees_all("hdfs://n/w", "yarn")
    assert not sees_all("file:/tmp/w", "spark://host:7077") and not sees_all("/tmp/w", "yarn")


def test_day_levels_are_those_of_the_directories(spark, tmp_path):
    df = spark.createDataFrame([("a", 2026, 8, 7)], "s string, year int, month int, day int")
    df.write.parquet(str(tmp_path / "year=1999" / "plain"))  # columns of the file, below a directory that looks like a level
    df.write.partitionBy("year", "month", "day").parquet(str(tmp_path / "days"))
    assert sources.read_table(spark, str(tmp_path / "year=1999" / "plain")).columns == ["s", "year", "month", "day"]
    assert sources.read_table(spark, str(tmp_path / "days")).columns == ["s"]
    assert sources.read_table(spark, [str(tmp_path / "days"), str(tmp_path / "days" / "year=2026")]).columns[0] == "s"
