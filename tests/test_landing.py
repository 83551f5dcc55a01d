"""Incremental ingest with an evolving schema: files that arrive at any time, spoiled
records, crashes between the steps."""

import pytest
from pyspark.sql import types as T

from lakelayer.sources import versions
from lakelayer.streaming import landing
from lakelayer.streaming.ingest import ingest, silver_stream


class Lake:
    def __init__(self, spark, tmp_path):
        self.spark, self.src, self.table, self.work = spark, tmp_path / "in", str(tmp_path / "table"), str(tmp_path / "work")
        self.src.mkdir()

    def put(self, name, text):
        (self.src / name).write_text(text)

    def run(self, **options):
        return landing.ingest_files(self.spark, str(self.src), self.table, self.work, **options)

    def rows(self, *columns):
        return sorted((tuple(r) for r in versions.read(self.spark, self.table).select(*columns).collect()), key=repr)


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, tmp_path)


def test_three_runs_of_changing_files_and_one_that_lands_meanwhile(lake, monkeypatch):
    lake.put("a.csv", "id,amount\n1,10\n2,20\n")
    seen = landing._landed

    def late(*args):
        lake.put("late.csv", "id,note\n9,x\n")  # after the stream has listed its files
        return seen(*args)

    with monkeypatch.context() as m:
        m.setattr(landing, "_landed", late)
        lake.run()
    assert lake.rows("id", "amount") == [(1, 10), (2, 20)]
    lake.put("b.csv", "amount,id,ratio\n30,3,0.5\nmany,4,2\n")
    lake.run()
    lake.put("c.csv", "id\n5\n")
    lake.run()
    assert lake.run() == []
    assert lake.rows("id", "amount", "note", "ratio", "_rescued_data", "ingest_file_name") == [
        (1, 10, None, None, None, "a.csv"),
        (2, 20, None, None, None, "a.csv"),
        (3, 30, None, 0.5, None, "b.csv"),
        (4, None, None, 2.0, '{"amount":"many"}', "b.csv"),
        (5, None, None, None, None, "c.csv"),
        (9, None, "x", None, None, "late.csv"),
    ]
    log = [tuple(r) for r in landing.schema_log(lake.spark, lake.table).collect() if not r["name"].startswith(("ingest_", "_"))]
    assert log == [(0, "amount", "bigint"), (0, "id", "bigint"), (1, "note", "string"), (1, "ratio", "double")]


def test_declared_columns_rescue_the_rest(lake):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("amount", T.IntegerType())])
    lake.put("a.csv", "id,amount\n1,10\n2,abc\n")
    lake.run(schema=schema, evolve=False)
    lake.put("b.csv", "AMOUNT,id,more\n30,3,m\n")
    lake.run(schema=schema, evolve=False)
    assert lake.rows("id", "amount", "_rescued_data", "ingest_file_name") == [
        (1, 10, None, "a.csv"),
        (2, None, '{"amount":"abc"}', "a.csv"),
        (3, 30, '{"more":"m"}', "b.csv"),
    ]


def test_spoiled_files_keep_every_record(lake):
    lake.put("bom.csv", "\ufeffid,text\n\n1,\"a, b\"\n2,id\nid,text\n")
    lake.put("width.csv", "id,text\n3\n4,x,y\n5,a,b,c,d,e,f\n")
    lake.put("twice.csv", "id,ID\n6,7\n")
    lake.put("empty.csv", "")
    lake.put("header.csv", "id,text\n")
    lake.put("noname.csv", "id,\n8,z\n")
    lake.run()
    assert lake.rows("id", "text", "_c1", "_rescued_data") == [
        ("1", "a, b", None, None),
        ("2", "id", None, None),
        ("8", None, "z", None),
        ("id", "text", None, None),
        (None, None, None, '{"_record":"3"}'),
        (None, None, None, '{"_record":"4,x,y"}'),
        (None, None, None, '{"_record":"5,a,b,c,d,e,f"}'),
        (None, None, None, '{"_record":"6,7"}'),
    ]


def test_a_crash_between_the_steps_is_made_up_for(lake, monkeypatch):
    lake.put("a.csv", "id\n1\n2\n")

    def crash(*_, **__):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(versions, "commit", crash)
        with pytest.raises(KeyboardInterrupt):
            lake.run()
    lake.put("b.csv", "id\n3\n")
    assert lake.run() == [0, 1]
    assert lake.rows("id") == [(1,), (2,), (3,)]
    assert lake.run() == []


def test_blocks_of_one_file(lake):
    """A file read in many blocks has one header."""
    lake.put("big.csv", "id,v\n" + "".join(f"{k},{'x' * 90}\n" for k in range(3000)))
    before = lake.spark.conf.get("spark.sql.files.maxPartitionBytes")
    lake.spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        lake.run()
    finally:
        lake.spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    got = versions.read(lake.spark, lake.table)
    assert got.count() == 3000 and got.agg({"id": "sum"}).first()[0] == 2999 * 1500 and got.schema["id"].dataType == T.LongType()


def test_json_lines(lake):
    lake.put("a.json", '{"id":1,"when":"2024-01-01T10:00:00"}\n{"id":\n{"id":2,"Id":3}\n')
    lake.run(fmt="json")
    lake.put("b.json", '{"ID":4,"ok":true,"code":"007"}\n{"id":"five"}\n')
    lake.run(fmt="json")
    assert lake.rows("id", "ok", "code", "_rescued_data") == [
        (1, None, None, None),
        (4, True, "007", None),
        (None, None, None, '{"_record":"{\\"id\\":"}'),
        (None, None, None, '{"_record":"{\\"id\\":2,\\"Id\\":3}"}'),
        (None, None, None, '{"id":"five"}'),
    ]
    assert versions.read(lake.spark, lake.table).schema["when"].dataType == T.TimestampType()


def test_silver_stream_counts_while_rows_pass(spark, tmp_path):
    src, bronze, silver, log = (str(tmp_path / n) for n in ("src", "bronze", "silver", "log"))
    for run in range(3):
        spark.range(run * 10, run * 10 + 10).selectExpr("if(id % 5 = 0, null, id) id", "id % 3 v").write.mode("append").parquet(src)
        ingest(spark.readStream.schema("id long, v long").parquet(src), bronze, bronze + "-ckpt")
        silver_stream(spark, bronze, lambda d: d.withColumn("w", d["v"] * 2), silver, silver + "-ckpt", log, "flow", [("small", "v < 2")], [("has_id", "id IS NOT NULL")])
    silver_stream(spark, bronze, lambda d: d, silver, silver + "-ckpt", log, "flow", [], [("has_id", "id IS NOT NULL")])
    got = spark.read.parquet(silver)
    assert got.count() == 24 and got.filter("w <> 2 * v").count() == 0
    rows = versions.read(spark, log).collect()
    assert sorted((r["batch"], r["rule"], r["action"], r["passed"], r["failed"]) for r in rows) == [
        (b, *x) for b in range(3) for x in (("has_id", "drop", 8, 2), ("small", "warn", *{0: (7, 3), 1: (7, 3), 2: (6, 4)}[b]))
    ]
