"""Checked CSV reads, catalog listings."""

from urllib.parse import unquote

import pytest

from racelake import schemas
from racelake.session import scratch_path
from racelake.sinks import folder_exists, read_batches, write_batch
from racelake.sources import csv as C
from racelake.sources import tables
from racelake.sources.fixtures import second_feed
from racelake.streaming import ingest, ingest_csv_checked
from support import SF0001

SCHEMA = "id int, name string, day date"


@pytest.fixture()
def landing(spark, tmp_path):
    from pyspark.sql.types import StructType

    files = {
        "good.csv": "id,name,day\n1,a,2024-01-01\n2,,\n",
        "quoted.csv": '﻿"id", "name" ,day\n3,"x, y",2024-02-02\n',
        "short.csv": "id,name,day\n4,b\nfive,c,2024-01-01\n6,d,2024-01-32\n7,e,2024-01-07,more\n",
        "other.csv": "id,day,name\n8,f,2024-01-01\n",   # fits by type, but is not what it says
        "headless.csv": "9,g,2024-01-09\n10,h,2024-01-10\n",
        "bare.csv": "id,name,day\n",
        "empty.csv": "",
    }
    for name, text in files.items():
        (tmp_path / name).write_text(text, encoding="utf-8")
    return str(tmp_path), StructType.fromDDL(SCHEMA)


def _name(path):
    return path.rsplit("/", 1)[1]


def _check(good, bad):
    assert sorted((r.id, r.name) for r in good.collect()) == [(1, "a"), (2, None), (3, "x, y")]
    rows = [(_name(r.file), r.reason, r.record) for r in bad.collect()]
    assert sorted((f, why) for f, why, _ in rows) == [
        ("headless.csv", "header"), ("other.csv", "header"), *[("short.csv", "record")] * 4]
    assert {r for f, _, r in rows if f == "short.csv"} == {"4,b", "five,c,2024-01-01", "6,d,2024-01-32", "7,e,2024-01-07,more"}


def test_quarantine_of_files_and_records(spark, landing):
    path, schema = landing
    good, bad = C.read_csv_checked(spark, path, schema)
    _check(good, bad)
    assert (good.count(), bad.count()) == (3, 6)  # also where no column is read
    counts = {(_name(r.file), r.reason): r.num_rows for r in C.quarantine_counts(bad).collect()}
    assert counts == {("headless.csv", "header"): 1, ("other.csv", "header"): 1, ("short.csv", "record"): 4}


def test_quarantine_as_a_stream_adds_nothing_twice(spark, landing):
    path, schema = landing
    sink, bad, ckpt = (scratch_path(spark, n) for n in ("good", "bad", "ckpt"))
    for _ in range(2):
        ingest_csv_checked(spark, path, schema, sink, bad, ckpt, max_files_per_trigger=2, timeout_s=120)
        _check(read_batches(spark, sink), read_batches(spark, bad))
    # The checkpoint is lost: the batches come again with the ids they had.
    ingest_csv_checked(spark, path, schema, sink, bad, scratch_path(spark, "ckpt"), max_files_per_trigger=2, timeout_s=120)
    _check(read_batches(spark, sink), read_batches(spark, bad))


def test_quarantine_stream_shuffles_no_rows_and_scans_stray_files_once(spark, landing, monkeypatch):
    path, schema = landing
    plans, scanned = [], []

    def spy(df, table_dir, load):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        scanned.append({_name(f) for f in df.inputFiles()})
        write_batch(df, table_dir, load)

    monkeypatch.setattr(ingest, "write_batch", spy)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)  # as where no side's size is known to be small
    try:
        sink, bad, ckpt = (scratch_path(spark, n) for n in ("good", "bad", "ckpt"))
        ingest_csv_checked(spark, path, schema, sink, bad, ckpt, timeout_s=120)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    _check(read_batches(spark, sink), read_batches(spark, bad))
    assert not [p for p in plans if "SortMergeJoin" in p or "hashpartitioning" in p]
    conforming = {"good.csv", "quoted.csv", "short.csv", "bare.csv"}
    assert scanned == [conforming, conforming | {"other.csv", "headless.csv"}]


def test_quarantine_stream_without_a_conforming_file_or_a_record(spark, tmp_path, landing):
    _, schema = landing
    for name, text in (("stray", "id,day,name\n8,f,2024-01-01\n"), ("bare", "id,name,day\n"), ("none", "")):
        (tmp_path / name).mkdir()
        (tmp_path / name / "f.csv").write_text(text)
        sink, bad, ckpt = (scratch_path(spark, n) for n in ("good", "bad", "ckpt"))
        ingest_csv_checked(spark, str(tmp_path / name), schema, sink, bad, ckpt, timeout_s=120)
        if name == "stray":
            assert read_batches(spark, sink).collect() == [] and read_batches(spark, sink).schema == schema
            assert [r.reason for r in read_batches(spark, bad).collect()] == ["header"]
        else:  # a batch without records writes nothing
            assert not folder_exists(spark, sink) and not folder_exists(spark, bad)


def test_quarantine_stream_takes_file_names_as_they_are(spark, tmp_path, landing):
    _, schema = landing
    names = ["a b.csv", "c%20d.csv", "k1.csv", "k[1].csv", "m{1,2}.csv", "n*.csv", "o?.csv", "p#1.csv", "q\\r.csv"]
    folder = tmp_path / "odd"
    folder.mkdir()
    for i, name in enumerate(names):
        (folder / name).write_text(f"id,name,day\n{i},a,2024-01-01\nx,b,\n")
    sink, bad, ckpt = (scratch_path(spark, n) for n in ("good", "bad", "ckpt"))
    ingest_csv_checked(spark, str(folder), schema, sink, bad, ckpt, timeout_s=120)
    assert sorted(r.id for r in read_batches(spark, sink).collect()) == list(range(len(names)))
    assert sorted(unquote(_name(r.file)) for r in read_batches(spark, bad).collect()) == sorted(names)


def test_feed_read_with_the_other_schema_is_quarantined_whole(spark):
    path = scratch_path(spark, "stray")
    feed = second_feed(spark, SF0001)
    C.write_csv(feed, path)
    good, bad = C.read_csv_checked(spark, path, schemas.MAIN_FEED)
    assert good.count() == 0 and bad.filter("reason = 'header'").count() == feed.count()
    good, bad = C.read_csv_checked(spark, path, schemas.SECOND_FEED)
    assert bad.count() == 0 and good.exceptAll(feed).count() == 0


def test_strict_read_fails_on_a_stray_file(spark, landing):
    path, schema = landing
    assert C.read_csv_strict(spark, path + "/good.csv", schema).count() == 2
    for name in ("other.csv", "short.csv"):
        with pytest.raises(Exception):
            C.read_csv_strict(spark, f"{path}/{name}", schema).collect()


def test_schemas_are_listed_with_their_tables(spark):
    root = scratch_path(spark, "db")
    tables.ensure_databases(spark, ["t_list_a", "t_list_b"], root)
    try:
        spark.range(7).write.saveAsTable("t_list_a.x")
        spark.range(5).write.saveAsTable("t_list_a.y")
        rows = {(r.catalog, r.schema): (r.num_tables, r.num_rows)
                for r in tables.schema_inventory(spark, "t_list_*").collect()}
        assert rows == {("spark_catalog", "t_list_a"): (2, 12), ("spark_catalog", "t_list_b"): (0, 0)}
        assert [r.catalog for r in tables.list_catalogs(spark).collect()] == ["spark_catalog"]
        assert tables.schema_inventory(spark, "no_such_*").collect() == []
    finally:
        for db in ("t_list_a", "t_list_b"):
            spark.sql(f"DROP DATABASE {db} CASCADE")
