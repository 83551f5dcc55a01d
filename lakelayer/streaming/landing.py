"""Incremental ingest of CSV and JSON files with an evolving schema (survey A1-A4, I1, I2).

A run has two steps.  First a stream with ``trigger(availableNow=True)`` lands the
lines of the new files, header lines included, with their file and block, in a
Parquet table partitioned by run; its checkpoint records each file once.  Then
the landed runs that the target doesn't hold yet are parsed and appended to it as
one version each.  A header thus comes from the same landed lines as its
records: a file that arrives while a run is under way belongs whole to this
run or to the next, and files of earlier runs are not read again.  A run that
dies between the steps is made up for by the next one; a run that is
repeated is appended once.

The target is a table of committed versions (:mod:`lakelayer.sources.versions`),
whose markers are the schema log.  With ``evolve`` a field that the table lacks
becomes a column, with the narrowest of bigint, double, boolean, timestamp
and string that all its values of the run fit; a column never changes its
type, so later values that don't fit are rescued.

CSV fields are taken by each file's own header, in any order, without regard to
case.  A record of more or fewer fields than its header, or of a file that names
a field twice, and a line that is no JSON object or names a field twice, are
rescued whole under ``_record``.  Records are lines: a quoted line break isn't
supported.  Blank lines are no records.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources import versions
from ..sources.files import RECORD, RESCUE_COL, evolve_schema, rescue
from ..sources.writers import staged
from .ingest import ingest

LINEAGE = ("ingest_file_name", "ingest_datetime")
#: Types tried for a new column, narrowest first, and how their values are written.
CANDIDATES = {
    "bigint": r"^(0|-?[1-9]\d*)$",
    "double": r"^[+-]?((0|[1-9]\d*)(\.\d*)?|\.\d+)([eE][+-]?\d+)?$",
    "boolean": "^(?i:true|false)$",
    "timestamp": r"^\d{4}-\d{2}-\d{2}",
}


def landed_runs(spark: SparkSession, landing: str) -> list[int]:
    """Numbers of the runs that the landing table has."""
    found = (re.fullmatch(r"run=(\d+)", n) for n in versions._names(spark, landing))
    return sorted(int(m[1]) for m in found if m)


def land(spark: SparkSession, path: str, landing: str, checkpoint: str, max_files: int | None = None) -> None:
    """Lands the lines of the files under ``path`` that no earlier run has seen."""
    run = max(landed_runs(spark, landing), default=-1) + 1
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    lines = reader.load(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_block_start").alias("at"),
        F.current_timestamp().alias("landed"),
        F.lit(run).alias("run"),
    )
    ingest(lines, landing, checkpoint, partition_by=["run"])


def _landed(spark: SparkSession, landing: str, run: int) -> DataFrame:
    """The lines of a run with their place: a block's lines stand in order in the
    landed files of one task."""
    lines = spark.read.parquet(landing).filter(F.col("run") == run).filter("trim(value) <> ''")
    place = F.struct(F.col("_metadata.file_path").alias("part"), F.col("_metadata.row_index").alias("row"))
    return lines.select("value", "file", "file_name", "at", "landed", place.alias("place"))


def _cells(line: Column, width: int) -> Column:
    """The fields of a CSV line; NULL where it has more than ``width``."""
    names = ", ".join(f"c{i} string" for i in range(width + 1))
    parsed = F.from_csv(F.concat(line, F.lit(",\u0001")), F.lit(names))  # the mark shows where the line ends
    every = F.array(*[parsed.getField(f"c{i}") for i in range(width + 1)])
    end = F.array_position(every, "\u0001").cast("int")
    return F.when(end > 0, F.slice(every, F.lit(1), end - 1))


def csv_fields(lines: DataFrame) -> DataFrame:
    """Landed CSV lines -> file_name, landed, value, fields (a map; NULL where the
    record doesn't fit its header)."""
    first = lines.filter("at = 0").groupBy("file").agg(F.min_by(F.struct("value", "place"), "place").alias("h"))
    headers = staged(first.select("file", F.col("h.place").alias("_at"), F.regexp_replace(F.col("h.value"), "^\ufeff", "").alias("_header")))
    width = headers.agg(F.max(F.length(F.regexp_replace("_header", "[^,]", "")))).first()[0] or 0
    names = F.transform(_cells(F.col("_header"), width + 1), lambda c, i: F.coalesce(F.nullif(F.trim(c), F.lit("")), F.concat(F.lit("_c"), i.cast("string"))))
    headers = headers.withColumn("_names", names)
    distinct = F.size(F.array_distinct(F.transform("_names", F.lower))) == F.size("_names")
    headers = headers.withColumn("_names", F.when(distinct, F.col("_names")))
    d = lines.join(headers, "file").filter(F.col("place") != F.col("_at"))
    d = d.withColumn("_cells", _cells(F.col("value"), width + 1))
    fits = F.size("_names") == F.size("_cells")
    fields = F.when(fits, F.map_filter(F.map_from_arrays("_names", "_cells"), lambda k, v: v.isNotNull()))
    return d.select("file_name", "landed", "value", fields.alias("fields"))


def json_fields(lines: DataFrame) -> DataFrame:
    """Landed JSON lines -> file_name, landed, value, fields (a map; NULL for a line that
    is no object or names a field twice)."""
    keys = F.json_object_keys("value")
    once = F.size(F.array_distinct(F.transform(keys, F.lower))) == F.size(keys)
    fields = F.when(once, F.map_filter(F.from_json("value", "map<string, string>"), lambda k, v: v.isNotNull()))
    return lines.select("file_name", "landed", "value", fields.alias("fields"))


def new_fields(d: DataFrame, known: T.StructType) -> T.StructType:
    """The fields of a run that the table lacks, in the order of their names, with
    types that fit all their values.  Their number is that of columns."""
    taken = {n.lower() for n in (*known.names, *LINEAGE, RESCUE_COL)}
    names = d.select(F.explode(F.map_keys("fields")).alias("name")).groupBy(F.lower("name").alias("key")).agg(F.min("name").alias("name"))
    new = sorted(r["name"] for r in names.collect() if r["key"] not in taken)
    if not new:
        return T.StructType([])
    counts = []
    for i, name in enumerate(new):
        value = _field(name)
        counts += [F.count(value).alias(f"n{i}"), *[F.count(F.when(value.rlike(form), value.try_cast(t))).alias(f"{t}{i}") for t, form in CANDIDATES.items()]]
    row = d.agg(*counts).first()
    types = [next((t for t in CANDIDATES if row[f"n{i}"] and row[f"{t}{i}"] == row[f"n{i}"]), "string") for i in range(len(new))]
    return T.StructType.fromDDL(", ".join(f"`{n}` {t}" for n, t in zip(new, types, strict=True)))


def _field(name: str) -> Column:
    """A field of the record, its name without regard to case."""
    return F.get(F.map_values(F.map_filter("fields", lambda k, v: F.lower(k) == name.lower())), 0)


def typed_rows(d: DataFrame, schema: T.StructType, ingest_time: Column | None = None) -> DataFrame:
    """Typed columns, lineage and the rescued fields."""
    own = F.transform_keys("fields", lambda k, v: F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for n in schema.names for x in (n.lower(), n)]), F.lower(k)), k)) if schema.names else F.col("fields")
    d = d.withColumn("fields", own)
    typed, rescued = rescue(F.col("fields"), schema)
    record = F.to_json(F.create_map(F.lit(RECORD), F.col("value")))
    lineage = {"ingest_file_name": F.col("file_name"), "ingest_datetime": F.col("landed") if ingest_time is None else ingest_time}
    kept = F.when(F.col("fields").isNull(), record).otherwise(rescued)
    return d.select(*[c.alias(n) for n, c in typed.items()], *[c.alias(n) for n, c in lineage.items()], kept.alias(RESCUE_COL))


def ingest_files(
    spark: SparkSession,
    path: str,
    root: str,
    work: str,
    fmt: str = "csv",
    schema: T.StructType | None = None,
    evolve: bool = True,
    ingest_time: Column | None = None,
    max_files: int | None = None,
) -> list[int]:
    """One incremental run from the files under ``path`` into the table ``root``;
    ``work`` keeps the landed lines and the checkpoint.  ``schema`` declares columns
    (and their types) from the start.  Returns the runs that were appended."""
    landing = f"{work}/landing"
    land(spark, path, landing, f"{work}/checkpoint", max_files)
    now = versions.version(spark, root)
    done = set(now.batches) if now else set()
    todo = [r for r in landed_runs(spark, landing) if f"run={r}" not in done]
    for run in todo:
        d = (csv_fields if fmt == "csv" else json_fields)(_landed(spark, landing, run))
        now = versions.version(spark, root)
        held = T.StructType([f for f in now.schema.fields if f.name not in (*LINEAGE, RESCUE_COL)]) if now else T.StructType([])
        known = evolve_schema(held, schema or T.StructType([]))
        if evolve:
            known = evolve_schema(known, new_fields(d, known))
        versions.append(typed_rows(d, known, ingest_time), root, batch=f"run={run}")
    return todo


def schema_log(spark: SparkSession, root: str) -> DataFrame:
    """(version, name, type) of the columns that each version added."""
    rows, seen = [], set()
    for n in versions.versions(spark, root):
        for f in versions.version(spark, root, n).schema.fields:
            if f.name not in seen:
                seen.add(f.name)
                rows.append((n, f.name, f.dataType.simpleString()))
    return spark.createDataFrame(rows, "version long, name string, type string")
