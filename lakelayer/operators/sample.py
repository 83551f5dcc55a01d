"""Deterministic sampling and splits (survey F4-F6).

``DataFrame.sample`` / ``randomSplit`` depend on the partitioning of their
input, so a rerun on a repartitioned table picks other rows.  These operators
decide per row from a hash of its id and a seed instead: stable under
repartitioning and executor loss, no shuffle, and a narrow filter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the integer-id mix (a prime modulus and two multipliers), so
# the same bucket can be computed by any SQL engine with 64-bit integers; the
# modulus is the bucket count, so a share may be as small as 5e-10.  The
# multiplier is the modulus times the golden section: ids in a row spread evenly.
_P, _A, _S = 2147483647, 1327217885, 104729
BUCKETS = _P


def int_bucket(id_col: str | Column, seed: int) -> Column:
    """Bucket 0..BUCKETS-1 of an integer id; exact in any engine with int64."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.pmod(F.pmod(c, F.lit(_P)) * F.lit(_A) + F.lit(seed * _S), F.lit(_P))


def int_bucket_sql(id_col: str, seed: int) -> str:
    return f"(((({id_col} % {_P}) + {_P}) % {_P}) * {_A} + {seed * _S}) % {_P}"


def share(fraction: float) -> int:
    """Number of buckets in a fraction."""
    return int(round(fraction * BUCKETS))


def hash_bucket(seed: int, *cols: str) -> Column:
    """Bucket 0..BUCKETS-1 from ``xxhash64`` of any columns (Spark-only hash)."""
    return F.pmod(F.xxhash64(F.lit(seed), *[F.col(c) for c in cols]), F.lit(BUCKETS))


def hash_sample(df: DataFrame, id_col: str, fraction: float, seed: int = 42) -> DataFrame:
    """keep a row when its bucket is below ``fraction`` of the buckets."""
    b = int_bucket(id_col, seed) if _is_integral(df, id_col) else hash_bucket(seed, id_col)
    return df.filter(b < F.lit(share(fraction)))


def hash_split(df: DataFrame, id_col: str, train: float = 0.8, seed: int = 42, col: str = "split") -> DataFrame:
    """``train``/``test`` label per row (80/20 by default)."""
    b = int_bucket(id_col, seed) if _is_integral(df, id_col) else hash_bucket(seed, id_col)
    return df.withColumn(col, F.when(b < F.lit(share(train)), "train").otherwise("test"))


def time_split(df: DataFrame, ts: str, cut: str) -> tuple[DataFrame, DataFrame]:
    """rows before ``cut`` and rows at or after it (two pushed-down filters)."""
    c = F.lit(cut).cast("timestamp")
    return df.filter(F.col(ts) < c), df.filter(F.col(ts) >= c)


def _is_integral(df: DataFrame, c: str) -> bool:
    return dict(df.dtypes).get(c) in ("tinyint", "smallint", "int", "bigint")


def stratified_split(df: DataFrame, label: str, id_col: str, train: float = 0.8, seed: int = 42,
                     col: str = "split") -> DataFrame:
    """F5 (stratified): within each label class, the first
    ``round(train * class size)`` rows in (hash bucket, id) order are
    ``train``, the rest ``test`` -- exact class proportions, decided per row
    by its rank.  The rank is a running count per class over ranges of equal size,
    so a large class is not ranked in one task; class sizes are one aggregate
    joined back (one row per class)."""
    from .fill import RANGES, join_null_safe, running_sum

    b = int_bucket(id_col, seed) if _is_integral(df, id_col) else hash_bucket(seed, id_col)
    d = df.withColumns({"_hb": b, "_one": F.lit(1)})
    ranked = running_sum(d, ["_one"], [label], ["_hb", id_col], RANGES, prefix="_rank")
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    out = join_null_safe(ranked, sizes, [label])
    keep = F.col("_rank_one") <= F.round(F.lit(float(train)) * F.col("_n"))
    return out.withColumn(col, F.when(keep, "train").otherwise("test")).drop("_hb", "_one", "_rank_one", "_n")
