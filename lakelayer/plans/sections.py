"""Ordered-scan queries (survey E6-E10) over ``lineitem`` read as report
sheets: the sheet is the return flag (three sheets, each about a third of the
table -- the hot-group case), rows run in (order, line, ...) order, and the
ordered scans are distributed prefix scans.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.fill import RANGES, bfill, drop_before_blank, ffill, lag_fill, running_count, with_ordinal, zip_rows
from ..sources.tables import Tables
from .registry import register

ORDER = (
    "l_orderkey l_linenumber l_partkey l_suppkey l_quantity l_extendedprice l_discount l_tax l_linestatus l_shipdate"
).split()
ORDER_SQL = ", ".join(ORDER)


def _sheet(t: Tables):
    li = t.lineitem.withColumn("sheet", F.col("l_returnflag"))
    marker = F.when(
        (F.col("l_linenumber") == 1) & (F.col("l_orderkey") % 7 == 0),
        F.concat(F.lit("Section "), F.col("l_orderkey").cast("string")),
    )
    return li.withColumn("marker", marker)


SHEET_SQL = """
s AS (SELECT *, l_returnflag AS sheet,
        CASE WHEN l_linenumber = 1 AND l_orderkey % 7 = 0 THEN 'Section ' || CAST(l_orderkey AS VARCHAR) END AS marker
      FROM lineitem)"""


@register(
    "ffill_sections",
    f"""
WITH {SHEET_SQL.strip()}
SELECT sheet, {ORDER_SQL},
       last_value(marker IGNORE NULLS) OVER (PARTITION BY sheet ORDER BY {ORDER_SQL}
                                             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS section
FROM s
""",
)
def q_ffill(spark, sf_dir):
    """Section marker forward-filled down each sheet."""
    d = _sheet(Tables(spark, sf_dir))
    return ffill(d, "marker", ["sheet"], ORDER, RANGES, out="section").select("sheet", *ORDER, "section")


@register(
    "bfill_sections",
    f"""
WITH {SHEET_SQL.strip()}
SELECT sheet, {ORDER_SQL},
       first_value(marker IGNORE NULLS) OVER (PARTITION BY sheet ORDER BY {ORDER_SQL}
                                              ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next_section
FROM s
""",
)
def q_bfill(spark, sf_dir):
    """First marker after each row (country taken from the following row)."""
    d = _sheet(Tables(spark, sf_dir))
    return bfill(d, "marker", ["sheet"], ORDER, RANGES, out="next_section").select("sheet", *ORDER, "next_section")


@register(
    "lag_fill",
    f"""
WITH s AS (SELECT *, l_returnflag AS sheet, CASE WHEN l_linenumber IN (2, 3) THEN NULL ELSE l_quantity END AS qty
           FROM lineitem)
SELECT sheet, {ORDER_SQL},
       CASE WHEN qty IS NOT NULL THEN qty ELSE lag(qty) OVER (PARTITION BY sheet ORDER BY {ORDER_SQL}) END AS qty_filled
FROM s
""",
)
def q_lag_fill(spark, sf_dir):
    """A NULL takes the previous row's value, one step only."""
    li = Tables(spark, sf_dir).lineitem.withColumn("sheet", F.col("l_returnflag"))
    li = li.withColumn("qty", F.when(F.col("l_linenumber").isin(2, 3), F.lit(None)).otherwise(F.col("l_quantity")))
    return lag_fill(li, "qty", ["sheet"], ORDER, RANGES, out="qty_filled").select("sheet", *ORDER, "qty_filled")


@register(
    "drop_before_blank",
    f"""
WITH s AS (SELECT *, l_returnflag AS sheet,
                  CASE WHEN l_linenumber = 3 THEN NULL ELSE 'Line ' || CAST(l_partkey AS VARCHAR) END AS caption
           FROM lineitem),
n AS (SELECT *, lead(caption) OVER (PARTITION BY sheet ORDER BY {ORDER_SQL}) AS nxt FROM s)
SELECT sheet, {ORDER_SQL}, caption FROM n WHERE nxt IS NOT NULL
""",
)
def q_drop_before_blank(spark, sf_dir):
    """Drop each row followed by a blank caption (block totals)."""
    li = Tables(spark, sf_dir).lineitem.withColumn("sheet", F.col("l_returnflag"))
    li = li.withColumn(
        "caption",
        F.when(F.col("l_linenumber") == 3, F.lit(None)).otherwise(F.concat(F.lit("Line "), F.col("l_partkey").cast("string"))),
    )
    return drop_before_blank(li, "caption", ["sheet"], ORDER, RANGES).select("sheet", *ORDER, "caption")


@register(
    "block_id",
    f"""
SELECT l_returnflag AS sheet, {ORDER_SQL},
       CAST(count(*) FILTER (WHERE l_linenumber = 1) OVER (PARTITION BY l_returnflag ORDER BY {ORDER_SQL}
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS block_id
FROM lineitem
""",
)
def q_block_id(spark, sf_dir):
    """Running count of separator rows = block id."""
    li = Tables(spark, sf_dir).lineitem.withColumn("sheet", F.col("l_returnflag"))
    return running_count(li, F.col("l_linenumber") == 1, ["sheet"], ORDER, RANGES).select("sheet", *ORDER, "block_id")


@register(
    "zip_rows",
    """
WITH o AS (SELECT o_orderpriority AS sheet, o_orderkey, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS pos FROM orders),
d AS (SELECT o_orderpriority AS sheet, o_totalprice, o_orderkey AS k,
             row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice, o_orderkey) AS pos FROM orders WHERE o_orderstatus = 'F')
SELECT o.sheet, o.o_orderkey, o.pos, d.o_totalprice FROM o JOIN d ON o.sheet = d.sheet AND o.pos = d.pos
""",
)
def q_zip_rows(spark, sf_dir):
    """The i-th order of a priority beside its i-th lowest price of a closed order."""
    o = Tables(spark, sf_dir).orders.withColumnRenamed("o_orderpriority", "sheet")
    left = with_ordinal(o.select("sheet", "o_orderkey"), ["sheet"], ["o_orderkey"], "pos")
    right = o.filter("o_orderstatus = 'F'").select("sheet", "o_totalprice", F.col("o_orderkey").alias("k"))
    return zip_rows(left, right, ["sheet"], ["o_orderkey"], ["o_totalprice", "k"]).select("sheet", "o_orderkey", "pos", "o_totalprice")
