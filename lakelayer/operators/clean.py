"""Cleaning operators: renames, sentinel handling, recodes, deterministic
dedup (keep-first) and the two-level count.

All are narrow (no shuffle) except ``keep_first`` and ``two_level_counts``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Salt buckets used when a keep-first ordering cannot be folded into an
# aggregate (descending text keys): a hot key is spread over this many tasks.
KEEP_FIRST_SALT = 64


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """B1: rename by name; positional ``_1.._n`` names come from ``toDF``."""
    return df.withColumnsRenamed(dict(mapping))


def positional_names(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """B1: positional rename (the manifest's ``_1.._4`` columns)."""
    return df.toDF(*names)


def drop_literals_keep_null(df: DataFrame, col: str, literals: Sequence[str]) -> DataFrame:
    """Drop rows whose ``col`` equals any literal, keeping NULL ``col``
    (``x != lit OR x IS NULL`` chained over all literals)."""
    return df.filter(F.coalesce(~F.col(col).isin(list(literals)), F.lit(True)))


def null_out(df: DataFrame, cols: Sequence[str], sentinels: Sequence[str] = ("nan", "NaN", "NaT")) -> DataFrame:
    """Sentinel spellings of a missing value become NULL (string columns)."""
    s = list(sentinels)
    return df.withColumns(
        {c: F.when(F.col(c).isin(s), F.lit(None).cast("string")).otherwise(F.col(c)) for c in cols}
    )


def recode(df: DataFrame, col: str, mapping: Mapping, default=None, out: str | None = None, keep: bool = False) -> DataFrame:
    """Value -> value by an ordered condition chain; unmatched gets
    ``default`` (NULL by default) or, with ``keep``, stays as it is."""
    items = list(mapping.items())
    expr = reduce(
        lambda acc, kv: acc.when(F.col(col) == F.lit(kv[0]), F.lit(kv[1])),
        items[1:],
        F.when(F.col(col) == F.lit(items[0][0]), F.lit(items[0][1])),
    )
    return df.withColumn(out or col, expr.otherwise(F.col(col) if keep else F.lit(default)))


def expand_code(df: DataFrame, col: str, mapping: Mapping[str, str], out: str | None = None) -> DataFrame:
    """A value of length 2 is looked up in the map -- an unknown (or
    lower-case) code becomes NULL, not the original -- other values are kept."""
    lookup = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return df.withColumn(
        out or col, F.when(F.length(F.col(col)) == 2, F.element_at(lookup, F.col(col))).otherwise(F.col(col))
    )


def _sortable(df: DataFrame, order: Sequence[tuple[str, bool]]) -> list[Column] | None:
    """Order keys folded into one ascending struct: ``(not null, k)`` for an
    ascending key (NULLs first) and ``(is null, -k)`` for a descending one
    (NULLs last).  None when a descending key is not numeric-like."""
    types = dict(df.dtypes)
    fields: list[Column] = []
    for i, (c, asc) in enumerate(order):
        if asc:
            fields += [F.col(c).isNotNull().alias(f"n{i}"), F.col(c).alias(f"k{i}")]
            continue
        t = types[c]
        if t in ("tinyint", "smallint", "int", "bigint", "float", "double") or t.startswith("decimal"):
            neg = -F.col(c)
        elif t == "timestamp" or t == "timestamp_ntz":
            neg = -F.unix_micros(F.col(c).cast("timestamp"))
        elif t == "date":
            neg = -F.unix_date(F.col(c))
        elif t == "boolean":
            neg = -F.col(c).cast("int")
        else:
            return None
        fields += [F.col(c).isNull().alias(f"n{i}"), neg.alias(f"k{i}")]
    return fields


def keep_first(
    df: DataFrame, keys: Sequence[str], order: Sequence[tuple[str, bool]], salt: int = KEEP_FIRST_SALT
) -> DataFrame:
    """One row per key -- the first under ``order`` (``(col, ascending)``
    pairs; NULLs first ascending, last descending, as in Spark's default).

    Rows tying on the whole order are the same row for the result only if the
    order covers every column, so callers append the remaining columns as
    tie-breakers when full determinism is needed.

    Plan: an aggregate ``min_by(row, order-struct)`` -- partial aggregation
    runs on every map task, so a key holding a third of the table is reduced
    to one row per task before the shuffle.  Orderings with a descending text
    key cannot be folded into one ascending struct; they take a salted
    two-level ``row_number`` instead (first per ``(key, salt)``, then per key
    over at most ``salt`` survivors)."""
    cols = df.columns
    ordkey = _sortable(df, order)
    if ordkey is not None:
        packed = df.groupBy(*keys).agg(F.min_by(F.struct(*cols), F.struct(*ordkey)).alias("_kf"))
        return packed.select("_kf.*")
    spec = [F.col(c).asc_nulls_first() if a else F.col(c).desc_nulls_last() for c, a in order]
    # The source partition spreads copies of one row, too.
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*cols, F.spark_partition_id()), F.lit(salt)))
    w1 = Window.partitionBy(*keys, "_salt").orderBy(*spec)
    stage1 = salted.withColumn("_rn", F.row_number().over(w1)).filter("_rn = 1").drop("_rn", "_salt")
    w2 = Window.partitionBy(*keys).orderBy(*spec)
    return stage1.withColumn("_rn", F.row_number().over(w2)).filter("_rn = 1").drop("_rn")


def two_level_counts(df: DataFrame, g1: str, g2: str, id_col: str) -> DataFrame:
    """``count(id)`` per ``g1`` and per ``(g1, g2)`` on one row, joined
    full outer on ``g1`` (a NULL ``g1`` never matches, so it yields two rows).

    The fine level is aggregated once from the data (partial aggregation on
    the map side); the coarse level is derived from that small result, so the
    input is shuffled once."""
    fine = df.groupBy(g1, g2).agg(F.count(id_col).alias(f"customer_count_{g1}_{g2}"))
    coarse = fine.groupBy(g1).agg(F.sum(f"customer_count_{g1}_{g2}").alias(f"customer_count_{g1}"))
    return coarse.join(fine, on=g1, how="outer").select(
        g1, f"customer_count_{g1}", g2, f"customer_count_{g1}_{g2}"
    )


class StepCounts:
    """Row counts of named steps, taken while the rows flow once.

    ``mark`` puts a counter on a step (``DataFrame.observe``); ``run`` executes the
    last step and reads the counters of that execution.  The metrics are taken
    from the executed query itself, not from a listener on the session."""

    def __init__(self) -> None:
        self.names: list[str] = []

    def mark(self, df: DataFrame, name: str) -> DataFrame:
        self.names.append(name)
        return df.observe(f"step_{len(self.names)}", F.count(F.lit(1)).alias("rows"))

    def run(self, last: DataFrame) -> DataFrame:
        """Runs ``last`` once, to its row count; ``(step, rows)`` in the order of the marks."""
        counted = last.agg(F.count(F.lit(1)))
        counted.collect()
        seen = counted._jdf.queryExecution().observedMetrics()
        rows = [(name, seen.apply(f"step_{i}").getLong(0)) for i, name in enumerate(self.names, 1)]
        return last.sparkSession.createDataFrame(rows, "step string, rows long")


def null_report(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """NULL count per column in one pass (conditional sums), long form."""
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return agg.select(
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count")) for c in cols])
        ).alias("r")
    ).select("r.*")


def union_all(dfs: Sequence[DataFrame]) -> DataFrame:
    """G1: union by column name, missing columns NULL-filled (one plan, not a
    loop of growing unions over a driver-side accumulator)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def empty_like(spark, schema: T.StructType) -> DataFrame:
    """Empty table from a schema."""
    return spark.createDataFrame([], schema)
