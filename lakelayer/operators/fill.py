"""Ordered scans over sheet rows: forward / backward fill, single-step lag
fill, next-row tests and running block ids (survey E6-E11).

Rows are ordered by a carried ordinal (the source row number of the cell
table, E11) -- never by ``monotonically_increasing_id`` after a shuffle.

An ordered scan over one partition key runs in one task, so a sheet (or any
group) holding a third of the table would be scanned by one core.  Each scan
therefore accepts ``chunk``:

* ``RANGES``: a distributed prefix scan.  The rows are range-partitioned by
  (partition, order) at sampled quantiles and written once, each with the
  number of its range; a range is what one task writes, so no range depends
  on how the order's values are spread or how large a sheet is.
* a column that is non-decreasing along the order (e.g. ``floor(row / 100000)``),
  where the caller knows one.

The scan runs per ``(partition, chunk)``.  The per-chunk statistic needed by the
next chunk (last value, edge row, count) is a whole-partition window on the
*same* partitioning, so it adds no shuffle; the rows are reduced to one per
chunk without a new exchange, a window over that small table (ordered by chunk;
with ``RANGES`` it has a row per task, not per so many rows) carries the value
across chunk borders, and a NULL-safe equi-join on ``(partition, chunk)`` puts
it back.  The two branches read the input twice; with ``RANGES`` that is the
written table.  Without ``chunk`` the plain per-partition window is used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.writers import staged

UNB = Window.unboundedPreceding
RANGES = "ranges"

Chunk = Column | str | None


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def by_range(df: DataFrame, partition: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """``df`` written once, in ranges of (partition, order) of about equal size, with
    the number of the range (``_chunk``), which never falls along the order."""
    keys = [F.col(p).asc_nulls_first() for p in partition] + [_c(o) for o in order]
    return staged(df.repartitionByRange(*keys).withColumn("_chunk", F.spark_partition_id()))


def _setup(df: DataFrame, partition: Sequence[str], order: Sequence[Column | str], chunk: Chunk):
    if chunk is None:
        return df, list(partition)
    if isinstance(chunk, str) and chunk == RANGES:
        return by_range(df, partition, order), [*partition, "_chunk"]
    return df.withColumn("_chunk", _c(chunk)), [*partition, "_chunk"]


def _finish(df: DataFrame) -> DataFrame:
    return df.drop("_chunk") if "_chunk" in df.columns else df


def _with_carry(d: DataFrame, part: Sequence[str], partition: Sequence[str], stat, carry) -> DataFrame:
    """Attach ``_carry``: ``carry(col, chunk_window)`` evaluated over the
    one-row-per-chunk table of the per-chunk statistic; ``stat(window)``
    builds that statistic over the whole chunk."""
    d = d.withColumn("_stat", stat(Window.partitionBy(*part)))
    summary = d.groupBy(*part).agg(F.first("_stat").alias("_s"))
    wc = Window.partitionBy(*partition)
    carried = summary.withColumn("_carry", carry(F.col("_s"), wc)).drop("_s")
    return join_null_safe(d.drop("_stat"), carried, part)


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join on ``keys`` where NULL meets NULL."""
    names = {k: f"_r{i}" for i, k in enumerate(keys)}
    right = right.withColumnsRenamed(names)
    on = [F.col(k).eqNullSafe(F.col(r)) for k, r in names.items()]
    return left.join(right, on, "left").drop(*names.values())


def ffill(df: DataFrame, col: str | Sequence[str], partition: Sequence[str], order: Sequence[str],
          chunk: Chunk = None, out: str | Sequence[str] | None = None) -> DataFrame:
    """Last non-NULL value at or before each row, for one column or
    several (filled in the same pass: one exchange, one carry join)."""
    cols = [col] if isinstance(col, str) else list(col)
    outs = [out] if isinstance(out, str) else list(out) if out else cols
    d, part = _setup(df, partition, order, chunk)
    w = Window.partitionBy(*part).orderBy(*order).rowsBetween(UNB, 0)
    d = d.withColumns({f"_in{i}": F.last(c, ignorenulls=True).over(w) for i, c in enumerate(cols)})
    if chunk is None:
        return d.withColumns({o: F.col(f"_in{i}") for i, o in enumerate(outs)}).drop(*[f"_in{i}" for i in range(len(cols))])
    okey = F.struct(*order)

    def last_in_chunk(wa):
        return F.struct(*[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), okey)).over(wa).alias(f"c{i}") for i, c in enumerate(cols)])

    def carry(s, wc):
        wprev = wc.orderBy("_chunk").rowsBetween(UNB, -1)
        return F.struct(*[F.last(s.getField(f"c{i}"), ignorenulls=True).over(wprev).alias(f"c{i}") for i in range(len(cols))])

    d = _with_carry(d, part, partition, last_in_chunk, carry)
    d = d.withColumns({o: F.coalesce(F.col(f"_in{i}"), F.col("_carry").getField(f"c{i}")) for i, o in enumerate(outs)})
    return _finish(d.drop(*[f"_in{i}" for i in range(len(cols))], "_carry"))


def bfill(df: DataFrame, col: str, partition: Sequence[str], order: Sequence[str], chunk: Chunk = None,
          out: str | None = None) -> DataFrame:
    """First non-NULL ``col`` strictly *after* each row.  Evaluated as a
    running ``last`` over the reversed order (``rowsBetween(UNB, -1)``): an
    unbounded-following frame would be re-aggregated for every row."""
    out = out or col
    d, part = _setup(df, partition, order, chunk)
    rev = [F.col(c).desc_nulls_last() if isinstance(c, str) else c for c in order]
    w = Window.partitionBy(*part).orderBy(*rev).rowsBetween(UNB, -1)
    d = d.withColumn("_in", F.last(col, ignorenulls=True).over(w))
    if chunk is None:
        return d.withColumn(out, F.col("_in")).drop("_in")
    first_in_chunk = F.min_by(F.col(col), F.when(F.col(col).isNotNull(), F.struct(*order)))
    d = _with_carry(
        d, part, partition, first_in_chunk.over,
        lambda s, wc: F.last(s, ignorenulls=True).over(wc.orderBy(F.col("_chunk").desc()).rowsBetween(UNB, -1)),
    )
    return _finish(d.withColumn(out, F.coalesce("_in", "_carry")).drop("_in", "_carry"))


def _neighbour(df: DataFrame, col: str, partition, order, chunk, step: int) -> tuple[DataFrame, Column]:
    """Value of ``col`` on the previous (step=-1) or next (step=1) row; the
    neighbour across a chunk border comes from the chunk summary.  Adds
    ``_nb`` (and ``_carry`` when chunked); callers drop them."""
    d, part = _setup(df, partition, order, chunk)
    w = Window.partitionBy(*part).orderBy(*order)
    fn = F.lag if step < 0 else F.lead
    d = d.withColumn("_nb", fn(F.struct(F.col(col).alias("v")), 1).over(w))
    if chunk is None:
        return d, F.col("_nb.v")
    edge = (F.max_by if step < 0 else F.min_by)(F.struct(F.col(col).alias("v")), F.struct(*order))
    d = _with_carry(d, part, partition, edge.over, lambda s, wc: fn(s, 1).over(wc.orderBy("_chunk")))
    return d, F.when(F.col("_nb").isNull(), F.col("_carry.v")).otherwise(F.col("_nb.v"))


def lag_fill(df: DataFrame, col: str, partition: Sequence[str], order: Sequence[str], chunk: Chunk = None,
             out: str | None = None) -> DataFrame:
    """A NULL takes the previous row's value -- one step only, so two
    NULLs in a row leave the second NULL."""
    out = out or col
    d, prev = _neighbour(df, col, partition, order, chunk, -1)
    d = d.withColumn(out, F.when(F.col(col).isNotNull(), F.col(col)).otherwise(prev))
    return _finish(d.drop("_nb", "_carry"))


def with_next(df: DataFrame, col: str, partition: Sequence[str], order: Sequence[str], chunk: Chunk = None,
              out: str = "next_value") -> DataFrame:
    d, nxt = _neighbour(df, col, partition, order, chunk, 1)
    return _finish(d.withColumn(out, nxt).drop("_nb", "_carry"))


def drop_before_blank(df: DataFrame, col: str, partition: Sequence[str], order: Sequence[str],
                      chunk: Chunk = None) -> DataFrame:
    """Keep a row only when the next row's ``col`` is not NULL (drops the
    block total that precedes a blank row, and the last row)."""
    return with_next(df, col, partition, order, chunk, "_next").filter(F.col("_next").isNotNull()).drop("_next")


def running_count(df: DataFrame, cond: Column, partition: Sequence[str], order: Sequence[str],
                  chunk: Chunk = None, out: str = "block_id") -> DataFrame:
    """Running count of rows meeting ``cond`` (a block id that steps at
    each separator row)."""
    d = df.withColumn("_hit", cond.cast("long"))
    d = running_sum(d, ["_hit"], partition, order, chunk, prefix="_cum")
    return d.withColumn(out, F.coalesce(F.col("_cum_hit"), F.lit(0)).cast("long")).drop("_hit", "_cum_hit")


def with_ordinal(df: DataFrame, partition: Sequence[str], order: Sequence[str], out: str = "ordinal", chunk: Chunk = RANGES) -> DataFrame:
    """Dense row number, from 1, within a partition."""
    d = running_sum(df.withColumn("_one", F.lit(1)), ["_one"], partition, order, chunk, prefix="_at")
    return d.withColumn(out, F.col("_at_one").cast("long")).drop("_one", "_at_one")


def zip_rows(a: DataFrame, b: DataFrame, partition: Sequence[str], order_a: Sequence[str],
             order_b: Sequence[str], chunk: Chunk = RANGES) -> DataFrame:
    """Positional zip of two frames -- i-th row of ``a`` with i-th row of
    ``b`` within each partition, on an explicit order (not ``lit(1)``)."""
    ra = with_ordinal(a, partition, order_a, "_pos", chunk)
    rb = with_ordinal(b, partition, order_b, "_pos", chunk)
    return ra.join(rb, [*partition, "_pos"], "inner").drop("_pos")


def running_sum(df: DataFrame, cols: Sequence[str], partition: Sequence[str], order: Sequence[Column | str],
                chunk: Chunk = None, prefix: str = "cum_") -> DataFrame:
    """Running (inclusive) sums of ``cols`` along ``order``; with ``chunk``
    the scan is split into ranges and carried across them as above (used for
    block ids and cumulative curves over a globally sorted table)."""
    d, part = _setup(df, partition, order, chunk)
    w = Window.partitionBy(*part).orderBy(*order).rowsBetween(UNB, 0)
    d = d.withColumns({f"_in_{c}": F.sum(c).over(w) for c in cols})
    if chunk is None:
        return d.withColumns({f"{prefix}{c}": F.col(f"_in_{c}") for c in cols}).drop(*[f"_in_{c}" for c in cols])

    def totals(w):
        return F.struct(*[F.sum(c).over(w).alias(c) for c in cols])

    def before(s, wc):
        return F.struct(*[F.sum(s.getField(c)).over(wc.orderBy("_chunk").rowsBetween(UNB, -1)).alias(c) for c in cols])

    def both(c):  # NULL until the first value
        own, carried = F.col(f"_in_{c}"), F.col("_carry").getField(c)
        return F.coalesce(own + carried, own, carried)

    d = _with_carry(d, part, partition, totals, before)
    return _finish(d.withColumns({f"{prefix}{c}": both(c) for c in cols}).drop(*[f"_in_{c}" for c in cols], "_carry"))
