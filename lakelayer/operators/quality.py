"""Data-quality expectations, quality-log parsing and key checks
(survey I3-I4, L1-L6, D4, H14).

A rule is ``(name, predicate)`` with a SQL predicate string or a Column.  A
predicate that evaluates to NULL counts as failed (and is dropped by
``expect_or_drop``).  Every report is one aggregate pass with conditional
sums, never one job per rule.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Rule = tuple[str, "str | Column"]


def holds(p: str | Column) -> Column:
    """Whether a rule's predicate holds; NULL doesn't."""
    return F.coalesce(F.expr(p) if isinstance(p, str) else p, F.lit(False))


def expect(df: DataFrame, rules: Sequence[Rule], dataset: str = "dataset") -> tuple[DataFrame, DataFrame]:
    """I3 (warn): rows are kept unchanged; the failure counts come back as a
    lazy :func:`expectation_report` frame (one aggregate pass when it is
    read).  ``DataFrame.observe`` would save that pass, but an observation
    registered on the session makes later ``pyspark.ml`` fits fail to
    serialise their tasks (ObservationManager), so it is not used."""
    return df, expectation_report(df, rules, dataset)


def expect_or_drop(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """I4: keep only rows passing every rule."""
    cond = F.lit(True)
    for _, p in rules:
        cond = cond & holds(p)
    return df.filter(cond)


def expectation_report(df: DataFrame, rules: Sequence[Rule], dataset: str, drop: Sequence[str] = ()) -> DataFrame:
    """L1: ``(dataset, name, passed_records, failed_records, dropped_records)``
    for every rule in one aggregate; ``dropped_records`` counts rows failing
    any rule listed in ``drop``."""
    aggs = []
    for i, (n, p) in enumerate(rules):
        aggs += [F.count_if(holds(p)).alias(f"p{i}"), F.count_if(~holds(p)).alias(f"f{i}")]
    dropping = [p for n, p in rules if n in set(drop)]
    anyfail = F.lit(False)
    for p in dropping:
        anyfail = anyfail | ~holds(p)
    aggs.append(F.count_if(anyfail).alias("dropped"))
    one = df.agg(*aggs)
    rows = F.array(
        *[
            F.struct(
                F.lit(n).alias("name"),
                F.col(f"p{i}").alias("passed_records"),
                F.col(f"f{i}").alias("failed_records"),
            )
            for i, (n, _) in enumerate(rules)
        ]
    )
    return one.select(F.lit(dataset).alias("dataset"), F.explode(rows).alias("r"), "dropped").select(
        "dataset", "r.name", "r.passed_records", "r.failed_records", F.col("dropped").alias("dropped_records")
    )


EXPECTATIONS_SCHEMA = T.ArrayType(
    T.StructType(
        [
            T.StructField("name", T.StringType()),
            T.StructField("dataset", T.StringType()),
            T.StructField("passed_records", T.LongType()),
            T.StructField("failed_records", T.LongType()),
        ]
    )
)


def parse_quality_log(log: DataFrame, id_col: str = "id") -> DataFrame:
    """Expectation metrics out of the JSON event log -- rows with
    ``flow_progress.metrics``, expectations array parsed and exploded."""
    d = F.col("details")
    prog = log.filter(F.get_json_object(d, "$.flow_progress.metrics").isNotNull())
    parsed = prog.select(
        id_col,
        F.get_json_object(d, "$.flow_progress.metrics.num_output_rows").cast("long").alias("num_output_rows"),
        F.get_json_object(d, "$.flow_progress.data_quality.dropped_records").cast("long").alias("dropped_records"),
        F.explode(
            F.from_json(F.get_json_object(d, "$.flow_progress.data_quality.expectations"), EXPECTATIONS_SCHEMA)
        ).alias("e"),
    )
    return parsed.select(
        id_col, "e.dataset", "e.name", "e.passed_records", "e.failed_records", "dropped_records", "num_output_rows"
    )


def parse_flow_log(log: DataFrame) -> DataFrame:
    """L3: lineage fields of ``flow_definition`` events (JSON path reads)."""
    d = F.col("details")
    return log.filter(F.get_json_object(d, "$.flow_definition").isNotNull()).select(
        "id",
        "timestamp",
        F.get_json_object(d, "$.flow_definition.output_dataset").alias("output_dataset"),
        F.get_json_object(d, "$.flow_definition.input_datasets").alias("input_datasets"),
        F.get_json_object(d, "$.flow_definition.flow_type").alias("flow_type"),
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys occurring more than once, with their count (``HAVING count > 1``)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def check_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """L4: primary-key check in one row: rows, rows with a NULL key part,
    distinct keys occurring more than once, and ``ok``.  Two aggregation
    levels (per key, then global); both reduce map-side."""
    null_any = F.lit(False)
    for k in keys:
        null_any = null_any | F.col(k).isNull()
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.max(null_any.cast("int")).alias("has_null"))
    out = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n_rows"),
        F.coalesce(F.sum(F.when(F.col("has_null") == 1, F.col("n"))), F.lit(0)).cast("long").alias("n_null_keys"),
        F.count_if(F.col("n") > 1).alias("n_duplicate_keys"),
    )
    return out.withColumn("ok", (F.col("n_null_keys") == 0) & (F.col("n_duplicate_keys") == 0))
