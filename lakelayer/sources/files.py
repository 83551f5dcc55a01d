"""File sources: batch and incremental reads of CSV / JSON with lineage
columns and rescued data (survey A1-A6, I1, I2).

Rescue without a platform service: each record is read as text, parsed into
a ``map<string,string>``, and every declared field is typed with
``try_cast``; unknown keys and values that fail their cast are kept, as
JSON, in ``_rescued_data``.  All of it is column expressions, so it runs the
same on a batch and on a stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESCUE_COL = "_rescued_data"


def read_batch(spark: SparkSession, path: str, fmt: str, schema: T.StructType | str | None = None,
               header: bool = True) -> DataFrame:
    """A5: batch CSV / JSON / Parquet read (explicit schema when given)."""
    r = spark.read.format(fmt)
    if fmt == "csv":
        r = r.option("header", str(header).lower())
    if schema is not None:
        r = r.schema(schema)
    return r.load(path)


def with_lineage(df: DataFrame, ingest_time: Column | None = None) -> DataFrame:
    """A3: source file name and ingest time (the clock is injectable)."""
    return df.withColumns(
        {
            "ingest_file_name": F.col("_metadata.file_name"),
            "ingest_datetime": ingest_time if ingest_time is not None else F.current_timestamp(),
        }
    )


def rescue(parsed: Column, schema: T.StructType) -> tuple[dict[str, Column], Column]:
    """Typed columns from a ``map<string,string>`` plus the rescued JSON of
    unknown keys and failed casts (NULL when nothing was rescued)."""
    known = [f.name for f in schema.fields]
    typed: dict[str, Column] = {}
    failed = []
    for f in schema.fields:
        raw = parsed.getItem(f.name)
        t = raw if isinstance(f.dataType, T.StringType) else raw.try_cast(f.dataType)
        typed[f.name] = t
        failed.append(F.when(raw.isNotNull() & t.isNull(), F.struct(F.lit(f.name).alias("key"), raw.alias("value"))))
    unknown = F.map_filter(parsed, lambda k, v: ~F.array_contains(F.array(*[F.lit(n) for n in known]), k))
    bad = F.map_from_entries(F.filter(F.array(*failed), lambda x: x.isNotNull()))
    merged = F.map_concat(unknown, bad)
    rescued = F.when(F.size(merged) > 0, F.to_json(merged))
    return typed, rescued


RECORD = "_record"


def parse_json_records(text: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """A4: JSON lines -> typed columns + ``_rescued_data``.  A line that is no JSON
    object, or that names a field twice, is rescued whole under ``_record``."""
    line = F.col(value)
    keys = F.json_object_keys(line)
    m = F.from_json(line, T.MapType(T.StringType(), T.StringType()))
    whole = (F.length(F.trim(line)) > 0) & (keys.isNull() | (F.size(F.array_distinct(keys)) < F.size(keys)))
    d = text.withColumns({"_m": m, "_whole": F.coalesce(whole, F.lit(False))})
    typed, rescued = rescue(F.col("_m"), schema)
    record = F.to_json(F.create_map(F.lit(RECORD), line))
    return d.select(
        *[c for c in text.columns if c != value],
        *[v.alias(k) for k, v in typed.items()],
        F.when(F.col("_whole"), record).otherwise(rescued).alias(RESCUE_COL),
    )


def json_stream(spark: SparkSession, path: str, schema: T.StructType, lineage: bool = True,
                max_files: int | None = None) -> DataFrame:
    """Incremental JSON-lines source with rescued data; each new
    file is read once (the checkpoint of the sink records it)."""
    r = spark.readStream.format("text")
    if max_files:
        r = r.option("maxFilesPerTrigger", str(max_files))
    text = r.load(path)
    if lineage:
        text = with_lineage(text)
    return parse_json_records(text, schema)


def evolve_schema(old: T.StructType, new: T.StructType) -> T.StructType:
    """I2 (addNewColumns): the old fields keep their type and position; new
    fields are appended.  A field whose type changed keeps the old type, so
    its new values land in ``_rescued_data`` through the failed cast."""
    names = {f.name for f in old.fields}
    return T.StructType(list(old.fields) + [f for f in new.fields if f.name not in names])
