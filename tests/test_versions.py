"""Tables of committed versions: killed writes, conflicts, partitions, schemas."""

import pytest

from lakelayer.sources import versions


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_upsert_by_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    a = spark.createDataFrame([(1, 2023, "a"), (2, 2023, "b"), (3, 2024, "c")], "k int, y int, v string")
    versions.create_or_upsert(a, path, ["k"], ["y"])
    b = spark.createDataFrame([(2, 2023, "B"), (4, 2023, "d")], "k int, y int, v string")
    versions.create_or_upsert(b, path, ["k"], ["y"])
    assert rows(versions.read(spark, path)) == [(1, 2023, "a"), (2, 2023, "B"), (3, 2024, "c"), (4, 2023, "d")]
    assert rows(versions.read(spark, path, 0)) == rows(a)


def test_null_and_text_partitions_and_moving_keys(spark, tmp_path):
    """NULL partitions keep their rows, text values keep their type, and a key
    that moves leaves no old row behind."""
    schema = "k long, p string, v long"
    for keys, path in ((["k"], str(tmp_path / "a")), (["k", "p"], str(tmp_path / "b"))):
        first = spark.createDataFrame([(1, None, 1), (2, "01", 1), (3, "02", 1), (4, None, 1)], schema)
        versions.create_or_upsert(first, path, keys, ["p"], null_safe=True)
        versions.create_or_upsert(spark.createDataFrame([(1, None, 2), (2, "01", 2), (3, "01", 2)], schema), path, keys, ["p"], null_safe=True)
        moved = set() if keys == ["k"] else {(3, "02", 1)}
        assert set(rows(versions.read(spark, path))) == {(1, None, 2), (2, "01", 2), (3, "01", 2), (4, None, 1)} | moved


def test_partitions_of_the_source_alone_are_written(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(100).selectExpr("id k", "id % 10 p", "0 v")
    old = versions.create_or_upsert(df, path, ["k", "p"], ["p"])
    new = versions.create_or_upsert(df.filter("p = 3").selectExpr("k", "p", "1 v"), path, ["k", "p"], ["p"])
    assert len(set(new.folders) - set(old.folders)) == 1 and len(set(new.folders) & set(old.folders)) == 9
    assert versions.read(spark, path).filter("v = 1").count() == 10


def test_a_killed_write_leaves_the_old_version(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    versions.overwrite(spark.range(5), path)

    def killed(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(versions, "commit", killed)
        for write in (lambda: versions.overwrite(spark.range(9), path), lambda: versions.append(spark.range(9), path), lambda: versions.create_or_upsert(spark.range(9), path, ["id"])):
            with pytest.raises(KeyboardInterrupt):
                write()
    bad = spark.range(4).selectExpr("if(id = 3, raise_error('lost'), id) id")
    with pytest.raises(Exception, match="lost"):
        versions.append(bad, path)
    assert versions.read(spark, path).count() == 5 and versions.versions(spark, path) == [0]
    assert versions.append(spark.range(2), path).number == 1
    assert versions.read(spark, path).count() == 7
    assert versions.expire(spark, path, keep=9) == []  # too young: a write may be under way
    removed = versions.expire(spark, path, keep=9, older_than_s=-10)
    assert len(removed) >= 3 and versions.read(spark, path).count() == 7 and versions.read(spark, path, 0).count() == 5


def test_one_of_two_writers_wins(spark, tmp_path):
    path = str(tmp_path / "t")
    base = versions.overwrite(spark.range(3), path)
    load = versions.write_load(spark.range(3, 6), path)
    versions.append(spark.range(10, 12), path)
    late = versions.Version(base.number + 1, "append", base.schema, (), (*base.folders, *load), ())
    with pytest.raises(versions.CommitConflict):
        versions.commit(spark, path, late)
    assert rows(versions.read(spark, path)) == [(0,), (1,), (10,), (11,), (2,)] or versions.read(spark, path).count() == 5


def test_batches_count_once(spark, tmp_path):
    path = str(tmp_path / "t")
    for batch in ("a", "b", "a", "b", "a"):
        versions.append(spark.range(3), path, batch=batch)
    assert versions.read(spark, path).count() == 6
    assert rows(versions.history(spark, path)) == [(0, "append", 1, 1), (1, "append", 2, 2)]


def test_schemas(spark, tmp_path):
    path = str(tmp_path / "m")
    versions.overwrite(spark.createDataFrame([(1, "x")], "k int, old string"), path)
    versions.append(spark.createDataFrame([(7, 2)], "new int, k int"), path)
    assert rows(versions.read(spark, path).select("k", "old", "new")) == [(1, "x", None), (2, None, 7)]
    versions.overwrite(spark.createDataFrame([(3, 5)], "k int, new int"), path, merge_schema=True)
    assert rows(versions.read(spark, path)) == [(3, None, 5)] and versions.read(spark, path).columns == ["k", "old", "new"]
    with pytest.raises(ValueError, match="column k"):
        versions.append(spark.createDataFrame([("text",)], "k string"), path)
    with pytest.raises(ValueError, match="no version"):
        versions.read(spark, path, 17)
    with pytest.raises(ValueError, match="no committed version"):
        versions.read(spark, str(tmp_path / "none"))


def test_dynamic_overwrite_and_pruning(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.overwrite(spark.range(30).selectExpr("id", "id % 3 p"), path, ["p"])
    versions.overwrite(spark.range(5).selectExpr("id + 100 id", "1L p"), path, ["p"], dynamic=True)
    df = versions.read(spark, path)
    assert df.filter("p = 1").count() == 5 and df.filter("p <> 1").count() == 20
    plan = df.filter("p = 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(p" in plan


def test_keys_are_checked_before_a_write(spark, tmp_path):
    path = str(tmp_path / "t")
    for bad in ([(1,), (1,)], [(None,)]):
        with pytest.raises(versions.KeyCheckFailed):
            versions.create_or_upsert(spark.createDataFrame(bad, "k int"), path, ["k"], unique_keys=True)
    assert versions.versions(spark, path) == []


def test_inference_log_is_idempotent(spark, tmp_path):
    from lakelayer.operators.models import log_scores, save, train

    df = spark.range(60).selectExpr("id", "cast(id as double) x", "cast(id > 30 as int) y")
    save(train(df, "logistic_regression", {"maxIter": 5}, ["x"], "y"), str(tmp_path / "model"))
    for batch in ("a", "b", "a"):
        log_scores(str(tmp_path / "model"), df.filter(f"id % 2 = {int(batch == 'b')}"), str(tmp_path / "log"), "v1", batch, "2024-01-31", ["id"])
    log = versions.read(spark, str(tmp_path / "log"))
    assert log.count() == 60 and log.select("id").distinct().count() == 60
    assert log.filter("(id > 35) <> (prediction = 1) AND abs(id - 30) > 8").count() == 0
