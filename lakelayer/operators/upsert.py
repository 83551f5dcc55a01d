"""Keyed table maintenance on plain Parquet (survey K1-K6, I6, I7).

There is no row-level table format here, so a MERGE is expressed as
DataFrame algebra: ``target anti-join source`` plus ``source``.  The writers
in :mod:`lakelayer.sources.writers` persist the result through a staged path,
touching only the partitions present in the source when the target is
partitioned.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class DuplicateSourceKeys(ValueError):
    """More than one source row matches one target row (MERGE would fail)."""


def _key_match(keys: Sequence[str], null_safe: bool, l: str = "t", r: str = "s") -> Column:
    conds = [
        F.col(f"{l}.{k}").eqNullSafe(F.col(f"{r}.{k}")) if null_safe else F.col(f"{l}.{k}") == F.col(f"{r}.{k}")
        for k in keys
    ]
    return reduce(lambda a, b: a & b, conds)


def duplicate_source_keys(target: DataFrame, source: DataFrame, keys: Sequence[str], null_safe: bool = False) -> DataFrame:
    """Source keys that occur more than once *and* match a target row."""
    dup = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return dup.alias("s").join(target.select(*keys).alias("t"), _key_match(keys, null_safe), "left_semi")


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    null_safe: bool = False,
    check: bool = True,
) -> DataFrame:
    """K1/K3: ``MERGE ... WHEN MATCHED UPDATE * WHEN NOT MATCHED INSERT *``.

    Matched target rows are replaced by the source row, unmatched source rows
    are inserted, other target rows are kept.  A NULL key part never matches
    (the source row is inserted) unless ``null_safe``.  With ``check`` a
    source key occurring twice for a matched target row raises
    :class:`DuplicateSourceKeys` (probes at most one offending key).

    Plan: one left-anti join (both sides shuffled on the keys, or the source
    broadcast when AQE sees it is small) and a union -- no per-row lookups."""
    if check:
        bad = duplicate_source_keys(target, source, keys, null_safe).limit(5).collect()
        if bad:
            raise DuplicateSourceKeys(f"source has several rows for matched keys: {[r.asDict() for r in bad]}")
    kept = target.alias("t").join(source.alias("s"), _key_match(keys, null_safe), "left_anti")
    return kept.unionByName(source.select(*target.columns), allowMissingColumns=False)


def latest_per_key(df: DataFrame, keys: Sequence[str], seq: Sequence[str]) -> DataFrame:
    """One row per key: the greatest ``seq`` (ties broken by the remaining
    columns, so the choice does not depend on input order).  A hash aggregate
    with a map-side partial step: a hot key is reduced on every map task."""
    cols = df.columns
    rest = [c for c in cols if c not in keys and c not in seq]
    order = F.struct(*[F.col(c) for c in seq], *[F.col(c) for c in rest])
    return df.groupBy(*keys).agg(F.max_by(F.struct(*cols), order).alias("_r")).select("_r.*")


def scd1(state: DataFrame | None, batch: DataFrame, keys: Sequence[str], seq: Sequence[str]) -> DataFrame:
    """CDC apply, SCD type 1 -- per key the latest row by ``seq`` across
    the current state and the new micro-batch (an out-of-order older change
    does not overwrite a newer state row).  Applying batches one by one gives
    the same table as applying their union."""
    both = batch if state is None else state.unionByName(batch)
    return latest_per_key(both, keys, seq)


def scd1_apply(batches, keys: Sequence[str], seq: Sequence[str], state: DataFrame | None = None,
               checkpoint_every: int = 4) -> DataFrame:
    """I6 over a sequence of micro-batches.  Each step unions the state with
    a batch and reduces it again, so the plan grows with the number of
    batches; every ``checkpoint_every`` batches the state is written with
    ``DataFrame.checkpoint()`` (reliable, to the session's shared
    ``spark.checkpoint.dir``), cutting the lineage so a lost executor
    recomputes from the last checkpoint, not from the first batch."""
    for i, b in enumerate(batches, 1):
        state = scd1(state, b, keys, seq)
        if checkpoint_every and i % checkpoint_every == 0:
            state = state.checkpoint(eager=True)
    return state


def change_feed(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Change rows between two versions of a keyed table:
    ``insert``, ``delete``, ``update_preimage`` + ``update_postimage``.
    One full outer join on the keys; unchanged rows produce nothing."""
    cols = old.columns
    vals = [c for c in cols if c not in keys]
    o = old.select(*keys, F.struct(*vals).alias("_o"))
    n = new.select(*keys, F.struct(*vals).alias("_n"))
    j = o.join(n, list(keys), "full_outer")
    same = F.col("_o").eqNullSafe(F.col("_n"))
    kind = (
        F.when(F.col("_o").isNull(), F.array(F.lit("insert")))
        .when(F.col("_n").isNull(), F.array(F.lit("delete")))
        .when(~same, F.array(F.lit("update_preimage"), F.lit("update_postimage")))
        .otherwise(F.array().cast("array<string>"))
    )
    ex = j.withColumn("_change_type", F.explode(kind))
    img = F.when(F.col("_change_type").isin("delete", "update_preimage"), F.col("_o")).otherwise(F.col("_n"))
    return ex.select(*keys, *[img.getField(c).alias(c) for c in vals], "_change_type")


def update_from(target: DataFrame, source: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """K4: partial update -- on a key match take ``cols`` from the source,
    otherwise keep the target values.  The source must be unique on the keys
    (it is reduced to one row per key first, deterministically)."""
    src = latest_per_key(source.select(*keys, *cols), keys, list(cols)).select(
        *keys, *[F.col(c).alias(f"_src_{c}") for c in cols], F.lit(True).alias("_matched")
    )
    j = target.join(src, list(keys), "left")
    out = j.withColumns({c: F.when(F.col("_matched"), F.col(f"_src_{c}")).otherwise(F.col(c)) for c in cols})
    return out.select(*target.columns)
