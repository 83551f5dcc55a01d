"""Scalar-function query (survey H6, H9-H12, H16, H18, B14, A16) over
``orders``, written as parameterised Spark SQL (named parameters and a
DataFrame argument instead of string-built object names)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.dates import QUARTER_END_MONTH, serial_date, with_constants
from ..functions.text import percent_text
from ..sources.tables import Tables
from .registry import register

CUT = "1990-01-01"  # before every order: the parameter is the feature, no row is left out


@register(
    "scalar_functions",
    f"""
SELECT o_orderkey, year(o_orderdate) AS yr, quarter(o_orderdate) AS qtr,
       CASE quarter(o_orderdate) WHEN 1 THEN 'Marzo' WHEN 2 THEN 'Junio' WHEN 3 THEN 'Septiembre' ELSE 'Diciembre' END AS month_name,
       CAST(DATE '1899-12-30' + CAST(o_orderkey % 50000 + 30000 AS INTEGER) AS DATE) AS serial_day,
       CAST(round((o_orderkey % 997) / 10000.0 * 100, 3) AS VARCHAR) || ' %' AS rate_text,
       CAST(TRY_CAST(o_totalprice AS DECIMAL(10, 0)) AS DOUBLE) AS amount_dec,
       CAST(TRY_CAST(o_totalprice * 100000 AS DECIMAL(10, 0)) AS DOUBLE) AS amount_overflow,
       CAST(ceil(o_totalprice / 1000) AS BIGINT) AS price_k_ceil,
       abs(o_totalprice - 200000) AS dist,
       coalesce(CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_orderstatus END, 'none') AS status,
       '2023' AS Ano, '3' AS Trimestre, TIMESTAMP '2024-01-31 00:00:00' AS FECHAPUBLICACION
FROM orders WHERE o_orderdate >= TIMESTAMP '{CUT}'
""",
)
def q_scalar_functions(spark, sf_dir):
    """Date parts, quarter month names, serial dates, rate text, decimal
    casts (HALF_UP, overflow -> NULL), ceil/abs/coalesce, parameter columns."""
    o = Tables(spark, sf_dir).orders
    base = spark.sql(
        "SELECT * FROM {t} WHERE o_orderdate >= CAST(:cut AS TIMESTAMP)", args={"cut": CUT}, t=o
    )
    months = F.create_map(*[F.lit(x) for kv in QUARTER_END_MONTH.items() for x in kv])
    out = base.select(
        "o_orderkey",
        F.year("o_orderdate").alias("yr"),
        F.quarter("o_orderdate").alias("qtr"),
        F.coalesce(F.element_at(months, F.quarter("o_orderdate")), F.lit("Diciembre")).alias("month_name"),
        serial_date(F.col("o_orderkey") % 50000 + 30000).alias("serial_day"),
        percent_text((F.col("o_orderkey") % 997) / 10000.0).alias("rate_text"),
        # decimal casts round HALF_UP and give NULL on overflow; reported as double
        F.col("o_totalprice").try_cast("decimal(10,0)").cast("double").alias("amount_dec"),
        (F.col("o_totalprice") * 100000).try_cast("decimal(10,0)").cast("double").alias("amount_overflow"),
        F.ceil(F.col("o_totalprice") / 1000).cast("long").alias("price_k_ceil"),
        F.abs(F.col("o_totalprice") - 200000).alias("dist"),
        F.coalesce(F.when(F.col("o_orderkey") % 9 != 0, F.col("o_orderstatus")), F.lit("none")).alias("status"),
    )
    return with_constants(out, 2023, 3, "2024-01-31 00:00:00")
