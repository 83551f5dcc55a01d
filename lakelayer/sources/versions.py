"""Tables of committed versions on plain Parquet (survey A7-A11, A13, K2, K5, K6).

    root/load=<id>/[key=value/]part-*.parquet     a write's files, never changed
    root/_commits/<version>.json                  a marker per committed version

A write puts its files into a folder of its own and then commits: a marker that
names the folders (or, of a partitioned table, the partition folders) of the
new version appears in one step, by a rename that fails where the version
exists already.  Readers take the folders of the last marker, so a write that
is killed half-way leaves the version before readable, and nobody reads its
files.  Of two writers that started from one version, one gets
:class:`CommitConflict`.  A marker holds schema and folder names, which grow with
the number of partitions and appended loads, not with rows.
"""

from __future__ import annotations

import dataclasses
import json
import re
import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.clean import empty_like
from ..operators.quality import check_key
from ..operators.upsert import upsert as merged_rows
from .writers import _fs

COMMITS = "_commits"


class CommitConflict(RuntimeError):
    """Another writer committed this version first."""


class KeyCheckFailed(ValueError):
    """The rows to write have NULL or repeated keys."""


@dataclasses.dataclass(frozen=True)
class Version:
    number: int
    operation: str
    schema: T.StructType
    partition_by: tuple[str, ...]
    folders: tuple[str, ...]  # relative to the table's root
    batches: tuple[str, ...]  # names of appended batches

    def to_json(self) -> str:
        return json.dumps({**dataclasses.asdict(self), "schema": self.schema.jsonValue()})

    @staticmethod
    def from_json(text: str) -> Version:
        d = json.loads(text)
        return Version(d["number"], d["operation"], T.StructType.fromJson(d["schema"]), tuple(d["partition_by"]), tuple(d["folders"]), tuple(d["batches"]))


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the committed versions, ascending."""
    found = (re.fullmatch(r"(\d+)\.json", n) for n in _names(spark, f"{root}/{COMMITS}"))
    return sorted(int(m[1]) for m in found if m)


def version(spark: SparkSession, root: str, number: int | None = None) -> Version | None:
    """A committed version: the last one by default; None where there is none."""
    known = versions(spark, root)
    if number is None and not known:
        return None
    if number is not None and number not in known:
        raise ValueError(f"{root} has no version {number}")
    fs, p = _fs(spark, f"{root}/{COMMITS}/{known[-1] if number is None else number:020d}.json")
    stream = fs.open(p)
    try:
        return Version.from_json(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def commit(spark: SparkSession, root: str, new: Version) -> Version:
    """Makes ``new`` the table's last version, in one step."""
    fs, folder = _fs(spark, f"{root}/{COMMITS}")
    fs.mkdirs(folder)
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path
    draft, final = path(folder, f".{new.number:020d}-{uuid.uuid4().hex}"), path(folder, f"{new.number:020d}.json")
    out = fs.create(draft, False)
    out.write(bytearray(new.to_json().encode()))
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    plain = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(fs.makeQualified(draft), fs.makeQualified(final), plain)  # never over an existing file
    except Exception as e:
        fs.delete(draft, False)
        if fs.exists(final):
            raise CommitConflict(f"version {new.number} of {root} was committed by another writer") from e
        raise
    return new


def write_load(df: DataFrame, root: str, partition_by: Sequence[str] = ()) -> tuple[str, ...]:
    """Writes rows into a new folder; the folders to commit.  A partitioned load is
    rebalanced by its keys: few files per partition, a large one over many tasks."""
    load = f"load={uuid.uuid4().hex}"
    if not partition_by:
        df.write.parquet(f"{root}/{load}")
        return (load,)
    df.hint("rebalance", *[F.col(k) for k in partition_by]).write.partitionBy(*partition_by).parquet(f"{root}/{load}")
    found = [load]
    for key in partition_by:
        found = [f"{f}/{n}" for f in found for n in _names(df.sparkSession, f"{root}/{f}") if n.startswith(f"{key}=")]
    return tuple(found)


def partition_of(folder: str) -> str:
    """``key=value/...`` of a partition folder."""
    return folder.partition("/")[2]


def read(spark: SparkSession, root: str, number: int | None = None) -> DataFrame:
    """The rows of a version (default: the last).  Columns that a file lacks are NULL;
    filters on partition columns prune folders."""
    v = version(spark, root, number)
    if v is None:
        raise ValueError(f"{root} has no committed version")
    return _rows(spark, root, v, v.folders)


def _rows(spark: SparkSession, root: str, v: Version, folders: Sequence[str]) -> DataFrame:
    if not folders:
        return empty_like(spark, v.schema)
    rows = spark.read.schema(v.schema).option("basePath", root).parquet(*[f"{root}/{f}" for f in folders])
    return rows.select(*v.schema.names)


def merged_schema(old: T.StructType, new: T.StructType) -> T.StructType:
    """The old fields, then those that are new; a field may not change its type."""
    types = {f.name: f.dataType for f in old.fields}
    for f in new.fields:
        if types.get(f.name, f.dataType) != f.dataType:
            raise ValueError(f"column {f.name} is {types[f.name].simpleString()}, not {f.dataType.simpleString()}")
    return T.StructType([*old.fields, *(f for f in new.fields if f.name not in types)])


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])


def overwrite(df: DataFrame, root: str, partition_by: Sequence[str] = (), dynamic: bool = False, merge_schema: bool = False) -> Version:
    """A7 / K6 (snapshot), A9 (``merge_schema``: columns of either side, those that
    ``df`` lacks NULL), A10 (partitioned), A11 (``dynamic``: only the partitions
    that ``df`` has are replaced)."""
    spark = df.sparkSession
    old = version(spark, root)
    schema = _nullable(df.schema)
    if old and (merge_schema or dynamic):
        schema = merged_schema(old.schema, schema)
    if dynamic and old and old.partition_by != tuple(partition_by):
        raise ValueError(f"{root} is partitioned by {old.partition_by}")
    if old and merge_schema:
        df = df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in schema.fields if f.name not in df.columns})
    folders = write_load(df, root, partition_by)
    if old and dynamic:
        replaced = {partition_of(f) for f in folders}
        folders = (*(f for f in old.folders if partition_of(f) not in replaced), *folders)
    batches = old.batches if old and dynamic else ()
    operation = "overwrite partitions" if dynamic else "overwrite"
    return commit(spark, root, Version(old.number + 1 if old else 0, operation, schema, tuple(partition_by), folders, batches))


def append(df: DataFrame, root: str, columns: Sequence[str] | None = None, batch: str | None = None, partition_by: Sequence[str] = ()) -> Version:
    """Appends rows, with an explicit column list and order if given.  A
    ``batch`` that the table holds already is not appended again, so a batch that
    is repeated after a failure counts once."""
    spark = df.sparkSession
    old = version(spark, root)
    if old and batch is not None and batch in old.batches:
        return old
    df = df.select(*columns) if columns else df
    schema = merged_schema(old.schema, _nullable(df.schema)) if old else _nullable(df.schema)
    keys = old.partition_by if old else tuple(partition_by)
    folders = (*(old.folders if old else ()), *write_load(df, root, keys))
    batches = (*(old.batches if old else ()), *([batch] if batch is not None else []))
    return commit(spark, root, Version(old.number + 1 if old else 0, "append", schema, keys, folders, batches))


def create_or_upsert(source: DataFrame, root: str, keys: Sequence[str], partition_by: Sequence[str] = (), null_safe: bool = False, unique_keys: bool = False) -> Version:
    """K2 / K5: creates the table from ``source``, or merges ``source`` into it by key.
    ``unique_keys`` (a feature table): the keys of ``source`` are checked first (L4);
    NULL or repeated ones raise :class:`KeyCheckFailed` and nothing is written.

    Where the partition columns are among the keys, only the partitions that
    ``source`` has are read and replaced; else a key may move between partitions
    and the new version is written whole."""
    spark = source.sparkSession
    if unique_keys:
        found = check_key(source, keys).first()
        if not found["ok"]:
            raise KeyCheckFailed(f"{found['n_null_keys']} rows with NULL keys, {found['n_duplicate_keys']} repeated keys")
    old = version(spark, root)
    if old is None:
        return overwrite(source, root, partition_by)
    if old.partition_by != tuple(partition_by):
        raise ValueError(f"{root} is partitioned by {old.partition_by}")
    within = bool(partition_by) and set(partition_by) <= set(keys)
    target = _rows(spark, root, old, old.folders)
    if within:
        parts = source.select(*[F.col(c).alias(f"_p{i}") for i, c in enumerate(partition_by)]).distinct()
        on = [F.col(c).eqNullSafe(F.col(f"_p{i}")) for i, c in enumerate(partition_by)]
        target = target.join(parts, on, "left_semi")
    rows = merged_rows(target, source.select(*old.schema.names), keys, null_safe=null_safe)
    folders = write_load(rows, root, partition_by)
    if within:
        replaced = {partition_of(f) for f in folders}
        folders = (*(f for f in old.folders if partition_of(f) not in replaced), *folders)
    return commit(spark, root, Version(old.number + 1, "upsert", old.schema, old.partition_by, folders, old.batches))


def history(spark: SparkSession, root: str) -> DataFrame:
    """(version, operation, n_folders, n_batches) of every committed version."""
    known = [version(spark, root, n) for n in versions(spark, root)]
    rows = [(v.number, v.operation, len(v.folders), len(v.batches)) for v in known]
    return spark.createDataFrame(rows, "version long, operation string, n_folders long, n_batches long")


def expire(spark: SparkSession, root: str, keep: int = 1, older_than_s: float = 86_400.0) -> list[str]:
    """Removes the markers of all but the last ``keep`` versions, then the loads that
    no version left names and that are older than ``older_than_s`` (a younger one
    may belong to a write that is under way).  Returns the loads removed."""
    known = versions(spark, root)
    left = [version(spark, root, n) for n in known[-max(1, keep):]]
    fs, _ = _fs(spark, root)
    for n in known[: -max(1, keep)]:
        fs.delete(_fs(spark, f"{root}/{COMMITS}/{n:020d}.json")[1], False)
    used = {f.partition("/")[0] for v in left for f in v.folders}
    removed = []
    for name in _names(spark, root):
        _, p = _fs(spark, f"{root}/{name}")
        if name.startswith("load=") and name not in used and fs.getFileStatus(p).getModificationTime() < (time.time() - older_than_s) * 1000:
            fs.delete(p, True)
            removed.append(name)
    return removed
