"""Report-ingestion queries (survey M1-M13) over report sheets derived from
the test tables: nations are the companies / countries of a sheet, suppliers
and customers its lines, order counts and balances its values.  Every sheet
is produced by Spark from the tables, so the work grows with them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.fill import RANGES
from ..operators.reports import (
    cells_from_rows,
    classify_indent,
    find_anchor,
    parse_capex,
    parse_debt_profile,
    parse_projects,
    parse_statements,
    parse_traffic,
    period_header,
    project_report,
    promote_header,
    report_wide,
    slice_period,
)
from ..sources.tables import Tables
from ..sources.writers import staged
from .registry import register

PUBLISHED = "2024-01-31 00:00:00"
LINE = 1_000_000_000_000  # ordinals of a nation's block; keys stay below a tenth of it


def _quarter_grid(t: Tables):
    """Per nation one sheet: a title + period header row, then one row per
    customer with its 1998 order count per quarter (blank when none)."""
    o = t.orders.filter(F.year("o_orderdate") == 1998)
    cnt = (
        o.withColumn("q", F.quarter("o_orderdate"))
        .groupBy("o_custkey")
        .agg(*[F.count(F.when(F.col("q") == i, 1)).alias(f"q{i}") for i in (1, 2, 3, 4)])
    )
    nz = {f"q{i}": F.when(F.col(f"q{i}") > 0, F.col(f"q{i}").cast("string")) for i in (1, 2, 3, 4)}
    body = (
        t.customer.join(cnt, F.col("c_custkey") == F.col("o_custkey"), "left")
        .select(
            F.concat(F.lit("nation_"), F.col("c_nationkey").cast("string"), F.lit(".xlsx")).alias("file"),
            F.lit("EEFF").alias("sheet"),
            (F.col("c_custkey") + 2).alias("row"),
            F.col("c_name").alias("v1"),
            *[nz[f"q{i}"].alias(f"v{i + 1}") for i in (1, 2, 3, 4)],
        )
    )
    head = t.nation.select(
        F.concat(F.lit("nation_"), F.col("n_nationkey").cast("string"), F.lit(".xlsx")).alias("file"),
        F.lit("EEFF").alias("sheet"),
        F.lit(1).cast("long").alias("row"),
        F.concat(F.lit("Estados de resultados - "), F.col("n_name")).alias("v1"),
        *[F.lit(f"{i}Q98").alias(f"v{i + 1}") for i in (1, 2, 3, 4)],
    )
    return cells_from_rows(head.unionByName(body), "file", "sheet", "row", ["v1", "v2", "v3", "v4", "v5"])


@register(
    "report_slice",
    """
WITH c AS (SELECT o_custkey, count(*) AS n FROM orders
           WHERE year(o_orderdate) = 1998 AND quarter(o_orderdate) = 3 GROUP BY o_custkey)
SELECT 'nation_' || CAST(c_nationkey AS VARCHAR) || '.xlsx' AS file, 'EEFF' AS sheet, c_custkey + 2 AS row,
       c_name AS description, CAST(n AS VARCHAR) AS value
FROM customer LEFT JOIN c ON c_custkey = o_custkey
""",
)
def q_report_slice(spark, sf_dir):
    """Grid -> cell table -> anchor (``estados de resultados``)
    -> the ``3Q98`` period column next to the description column."""
    cells = staged(_quarter_grid(Tables(spark, sf_dir)))  # read by every step
    anchors = find_anchor(cells, F.lower(F.col("value")).contains("estados de resultados"))
    return slice_period(cells, anchors, period_header(1998, 3))


def _statement_rows(t: Tables):
    n, s, c = t.nation, t.supplier, t.customer
    base = F.col("n_nationkey").cast("long") * F.lit(LINE)

    def fixed(off, text):
        return n.select(base.alias("b"), F.lit(off).alias("o"), text.alias("Descripcion"), F.lit(None).cast("string").alias("Valor"))

    heads = [
        fixed(0, F.concat(F.lit("ESTADOS CONSOLIDADOS DE SITUACIÓN FINANCIERA - "), F.col("n_name"))),
        fixed(1, F.lit("Cifras expresadas en millones de pesos")),
        fixed(2, F.lit("ACTIVO")),
        fixed(3, F.lit("Activo corriente")),
        fixed(100000000000, F.lit("Total activo corriente")),
        fixed(100000000001, F.lit("PASIVO")),
        fixed(100000000002, F.lit("Pasivo no corriente")),
        fixed(200000000000, F.concat(F.lit("ESTADOS DE RESULTADOS CONSOLIDADO - "), F.col("n_name"))),
        fixed(200000000001, F.lit("Ingresos operacionales")),
        fixed(300000000000, F.lit("TOTAL RESULTADO")),
    ]
    sup = s.join(n, F.col("s_nationkey") == F.col("n_nationkey")).select(
        base.alias("b"), (F.lit(10) + F.col("s_suppkey")).alias("o"),
        F.concat(F.lit("Cuenta "), F.col("s_name")).alias("Descripcion"),
        F.when(F.col("s_suppkey") % 9 == 0, F.lit("nan")).otherwise(F.col("s_acctbal").cast("string")).alias("Valor"),
    )
    cus = c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(
        base.alias("b"), (F.lit(100000000010) + F.col("c_custkey")).alias("o"),
        F.concat(F.lit("Obligacion "), F.col("c_name")).alias("Descripcion"), F.col("c_acctbal").cast("string").alias("Valor"),
    )
    inc = c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(
        base.alias("b"), (F.lit(200000000010) + F.col("c_custkey")).alias("o"),
        F.concat(F.lit("Ingreso "), F.col("c_mktsegment"), F.lit(" "), F.col("c_custkey").cast("string")).alias("Descripcion"),
        F.col("c_acctbal").cast("string").alias("Valor"),
    )
    parts = heads + [sup, cus, inc]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.select(
        F.lit("eeff.xlsx").alias("file"), F.lit("EEFF").alias("sheet"), (F.col("b") + F.col("o")).alias("row"),
        "Descripcion", "Valor",
    )


@register(
    "parse_statements",
    r"""
WITH raw AS (
  SELECT n_nationkey * 1000000000000 + o AS row, d AS Descripcion, CAST(NULL AS VARCHAR) AS Valor
  FROM nation, (VALUES (0, 'T1'), (1, 'Cifras expresadas en millones de pesos'), (2, 'ACTIVO'), (3, 'Activo corriente'),
                       (100000000000, 'Total activo corriente'), (100000000001, 'PASIVO'), (100000000002, 'Pasivo no corriente'),
                       (200000000000, 'T2'), (200000000001, 'Ingresos operacionales'), (300000000000, 'TOTAL RESULTADO')) v(o, d0),
       LATERAL (SELECT CASE d0 WHEN 'T1' THEN 'ESTADOS CONSOLIDADOS DE SITUACIÓN FINANCIERA - ' || n_name
                               WHEN 'T2' THEN 'ESTADOS DE RESULTADOS CONSOLIDADO - ' || n_name ELSE d0 END AS d)
  UNION ALL SELECT n_nationkey * 1000000000000 + 10 + s_suppkey, 'Cuenta ' || s_name,
         CASE WHEN s_suppkey % 9 = 0 THEN 'nan' ELSE CAST(s_acctbal AS VARCHAR) END
    FROM supplier JOIN nation ON s_nationkey = n_nationkey
  UNION ALL SELECT n_nationkey * 1000000000000 + 100000000010 + c_custkey, 'Obligacion ' || c_name, CAST(c_acctbal AS VARCHAR)
    FROM customer JOIN nation ON c_nationkey = n_nationkey
  UNION ALL SELECT n_nationkey * 1000000000000 + 200000000010 + c_custkey,
         'Ingreso ' || c_mktsegment || ' ' || CAST(c_custkey AS VARCHAR), CAST(c_acctbal AS VARCHAR)
    FROM customer JOIN nation ON c_nationkey = n_nationkey),
a AS (SELECT row, CASE WHEN Descripcion = 'nan' THEN NULL ELSE Descripcion END AS Descripcion,
             CASE WHEN Valor = 'nan' THEN NULL ELSE Valor END AS Valor FROM raw),
titles AS (SELECT DISTINCT Descripcion AS t FROM a
           WHERE Descripcion LIKE 'ESTADOS SEPARADOS%' OR Descripcion LIKE 'ESTADOS DE RESULTADOS SEPARADOS%'
              OR Descripcion LIKE 'ESTADOS DE RESULTADOS CONSOLIDADO%' OR Descripcion LIKE 'ESTADOS CONSOLIDADOS DE SITUACIÓN%'),
b AS (SELECT row, Valor,
        regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(Descripcion,
          'PASIVO MAS PATRIMONIO DE LOS ACCIONISTAS', 'PASIVO', 'g'), 'Liabilities and Shareholders'' Equity', 'Liabilities', 'g'),
          'SHAREHOLDERS'' EQUITY', 'EQUITY', 'g'), 'Patrimonio de los accionistas', 'Patrimonio', 'g'),
          'Total patrimonio de los accionistas', 'Total Patrimonio', 'g'), 'TOTAL SHAREHOLDER''S EQUITY', 'Total Equity', 'g'),
          'Assets \(BRL thousand\)', 'Assets', 'g') AS Descripcion
      FROM a
      WHERE Descripcion NOT LIKE 'Valores expresados en%' AND Descripcion NOT LIKE 'Cifras expresadas en%'
        AND (Descripcion LIKE 'Total%') <> TRUE AND (Descripcion LIKE 'TOTAL%') <> TRUE AND (Descripcion LIKE 'IFRS Results') <> TRUE),
c AS (SELECT b.*, t IS NOT NULL AS is_title FROM b LEFT JOIN titles ON Descripcion = t),
d AS (SELECT *, last_value(CASE WHEN is_title THEN Descripcion END IGNORE NULLS)
                  OVER (ORDER BY row ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS Empresa FROM c),
e AS (SELECT *,
        CASE WHEN upper(Descripcion) IN ('ACTIVO', 'ASSETS', 'PASIVO', 'LIABILITIES', 'PATRIMONIO', 'EQUITY', 'GROSS')
             THEN array_to_string(list_transform(string_split(Descripcion, ' '), lambda w: upper(left(w, 1)) || lower(substr(w, 2))), ' ') END AS kind,
        CASE WHEN Descripcion IN ('Activo corriente', 'Activo no corriente', 'Pasivo corriente', 'Pasivo no corriente', 'CURRENT',
                                  'NON-CURRENT', 'CURRENT ASSETS', 'NON-CURRENT ASSETS', 'CURRENT LIABILITIES', 'NON-CURRENT LIABILITIES')
             THEN array_to_string(list_transform(string_split(Descripcion, ' '), lambda w: upper(left(w, 1)) || lower(substr(w, 2))), ' ') END AS term
      FROM d WHERE Empresa <> Descripcion),
f AS (SELECT *, coalesce(last_value(kind IGNORE NULLS) OVER w, 'Utilidad') AS ValorContable,
                last_value(term IGNORE NULLS) OVER w AS term_f
      FROM e WINDOW w AS (PARTITION BY Empresa ORDER BY row ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
g AS (SELECT *, CASE WHEN ValorContable IN ('Activo', 'Pasivo', 'Assets', 'Liabilities') THEN term_f ELSE 'N/A' END AS tc FROM f),
h AS (SELECT *, CASE WHEN ValorContable = 'Assets' AND tc IN ('Current', 'Current Assets') THEN 'Activo Corriente'
                     WHEN ValorContable = 'Liabilities' AND tc IN ('Current', 'Current Liabilities') THEN 'Pasivo Corriente'
                     WHEN ValorContable = 'Assets' AND tc IN ('Non-current', 'Non-current Assets') THEN 'Activo No Corriente'
                     WHEN ValorContable = 'Liabilities' AND tc IN ('Non-current', 'Non-current Liabilities') THEN 'Pasivo No Corriente'
                     ELSE tc END AS TipoCorriente FROM g),
k AS (SELECT * FROM h
      WHERE (Descripcion LIKE '%ACTIVO%') <> TRUE AND (Descripcion LIKE '%Activo corriente%') <> TRUE
        AND (Descripcion LIKE '%Activo no corriente%') <> TRUE AND (Descripcion LIKE '%PASIVO%') <> TRUE
        AND (Descripcion LIKE '%Pasivo corriente%') <> TRUE AND (Descripcion LIKE '%Pasivo no corriente%') <> TRUE
        AND (Descripcion LIKE '%Patrimonio%') <> TRUE AND (Descripcion LIKE '%Assets%') <> TRUE
        AND (Descripcion LIKE '%CURRENT%') <> TRUE AND upper(Descripcion) <> upper(Empresa)
        AND upper(Descripcion) <> upper(ValorContable) AND Descripcion NOT LIKE '%(BRL thousand)%'
        AND (Descripcion LIKE '%EQUITY%') <> TRUE AND NOT is_title)
SELECT trim(string_split(Empresa, '-')[1]) AS Estado, trim(string_split(Empresa, '-')[2]) AS Empresa, Descripcion,
       regexp_replace(regexp_replace(regexp_replace(regexp_replace(ValorContable, 'Gross', 'Utilidad', 'g'),
         'Assets', 'Activo', 'g'), 'Liabilities', 'Pasivo', 'g'), 'Equity', 'Patrimonio', 'g') AS ValorContable,
       TipoCorriente, coalesce(TRY_CAST(Valor AS DOUBLE), 0.0) AS valor, '2023' AS Ano, '3' AS Trimestre,
       TIMESTAMP '2024-01-31 00:00:00' AS FECHA_PUBLICACION
FROM k
""",
)
def q_parse_statements(spark, sf_dir):
    """M4: statement sections -> tidy (state, company, line, kind, term, value)."""
    return parse_statements(_statement_rows(Tables(spark, sf_dir)), 2023, 3, PUBLISHED, chunk=RANGES)


def _capex_rows(t: Tables):
    n, s = t.nation, t.supplier
    base = F.col("n_nationkey").cast("long") * F.lit(LINE)
    head = n.select(base.alias("b"), F.lit(0).alias("o"), F.col("n_name").alias("EMPRESA"), F.lit(None).cast("string").alias("Valor"))
    lines = s.join(n, F.col("s_nationkey") == F.col("n_nationkey")).select(
        base.alias("b"), (F.lit(10) + F.col("s_suppkey")).alias("o"),
        F.when(F.col("s_suppkey") % 17 == 0, F.concat(F.lit("Inversiones dentro balance "), F.col("s_name")))
        .otherwise(F.col("s_name")).alias("EMPRESA"),
        F.col("s_acctbal").cast("string").alias("Valor"),
    )
    tot = s.groupBy("s_nationkey").agg(F.sum("s_acctbal").alias("t")).join(n, F.col("s_nationkey") == F.col("n_nationkey"))
    total = tot.select(base.alias("b"), F.lit(900000000000).alias("o"), F.concat(F.lit("Total "), F.col("n_name")).alias("EMPRESA"),
                       F.col("t").cast("string").alias("Valor"))
    blank = n.select(base.alias("b"), F.lit(900000000001).alias("o"), F.lit(None).cast("string").alias("EMPRESA"),
                     F.lit(None).cast("string").alias("Valor"))
    u = head.unionByName(lines).unionByName(total).unionByName(blank)
    return u.select(F.lit("capex.xlsx").alias("file"), F.lit("CAPEX").alias("sheet"),
                    (F.col("b") + F.col("o")).alias("row"), "EMPRESA", "Valor")


@register(
    "parse_capex",
    """
WITH r AS (
  SELECT n_nationkey * 1000000000000 AS row, n_name AS EMPRESA, CAST(NULL AS VARCHAR) AS Valor FROM nation
  UNION ALL SELECT n_nationkey * 1000000000000 + 10 + s_suppkey,
         CASE WHEN s_suppkey % 17 = 0 THEN 'Inversiones dentro balance ' || s_name ELSE s_name END, CAST(s_acctbal AS VARCHAR)
    FROM supplier JOIN nation ON s_nationkey = n_nationkey
  UNION ALL SELECT n_nationkey * 1000000000000 + 900000000000, 'Total ' || n_name, 'total' FROM nation
    WHERE n_nationkey IN (SELECT s_nationkey FROM supplier)
  UNION ALL SELECT n_nationkey * 1000000000000 + 900000000001, NULL, NULL FROM nation),
l AS (SELECT *, lead(EMPRESA) OVER (ORDER BY row) AS nxt FROM r),
k AS (SELECT * FROM l WHERE nxt IS NOT NULL AND EMPRESA IS NOT NULL),
f AS (SELECT *, last_value(CASE WHEN Valor IS NULL THEN EMPRESA END IGNORE NULLS)
                  OVER (ORDER BY row ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS PAIS FROM k)
SELECT PAIS, EMPRESA, Valor, '2023' AS AnoEvaluado, '3' AS trimestreEvaluado,
       TIMESTAMP '2024-01-31 00:00:00' AS FECHA_PUBLICACION
FROM f WHERE Valor IS NOT NULL AND EMPRESA NOT LIKE '%Inversiones dentro balance%'
  AND EMPRESA NOT LIKE '%Negocios que no consolidan%'
""",
)
def q_parse_capex(spark, sf_dir):
    """M5: capex blocks -> (country, company, value)."""
    return parse_capex(_capex_rows(Tables(spark, sf_dir)), 2023, 3, PUBLISHED, chunk=RANGES)


def _traffic_rows(t: Tables):
    n, c = t.nation, t.customer
    base = F.col("n_nationkey").cast("long") * F.lit(LINE)
    head = n.select(base.alias("b"), F.lit(0).alias("o"), F.concat(F.lit("RUTA - "), F.col("n_name")).alias("Empresa"),
                    F.lit("nan").alias("Valor"))
    seg = c.groupBy("c_nationkey", "c_mktsegment").agg(F.count(F.lit(1)).alias("k"))
    seg = seg.join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(
        base.alias("b"), (F.lit(10) + F.length("c_mktsegment") * 100 + F.ascii("c_mktsegment")).alias("o"),
        F.concat(F.lit(" "), F.col("c_mktsegment")).alias("Empresa"),
        F.when(F.col("c_mktsegment") == "HOUSEHOLD", F.lit(" ")).otherwise(
            F.concat(F.lit("1 "), F.col("k").cast("string"))).alias("Valor"),
    )
    foot = n.select(base.alias("b"), F.lit(900000000000).alias("o"), F.lit("**TPD: Tráfico Promedio Diario").alias("Empresa"),
                    F.lit(None).cast("string").alias("Valor"))
    u = head.unionByName(seg).unionByName(foot)
    return u.select(F.lit("trafico.xlsx").alias("file"), F.lit("TRAFICO").alias("sheet"),
                    (F.col("b") + F.col("o")).alias("row"), "Empresa", "Valor")


@register(
    "parse_traffic",
    r"""
WITH seg AS (SELECT c_nationkey, c_mktsegment, count(*) AS k FROM customer GROUP BY ALL),
r AS (
  SELECT n_nationkey * 1000000000000 AS row, 'RUTA - ' || n_name AS Empresa, 'nan' AS Valor FROM nation
  UNION ALL SELECT n_nationkey * 1000000000000 + 10 + length(c_mktsegment) * 100 + ascii(c_mktsegment), ' ' || c_mktsegment,
         CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN ' ' ELSE '1 ' || CAST(k AS VARCHAR) END
    FROM seg JOIN nation ON c_nationkey = n_nationkey
  UNION ALL SELECT n_nationkey * 1000000000000 + 900000000000, '**TPD: Tráfico Promedio Diario', NULL FROM nation),
a AS (SELECT row, CASE WHEN Empresa = 'nan' THEN NULL ELSE Empresa END AS Empresa,
             CASE WHEN Valor = 'nan' THEN NULL ELSE Valor END AS Valor FROM r
      WHERE Empresa NOT IN ('*TMDE: Tráfico medio diario equivalente',
        'TMDE 2015- 2021 con base 365 días, excepto 2016 y 2020 los cuales están con base 366 días',
        '**TPD: Tráfico Promedio Diario')),
b AS (SELECT row, regexp_replace(Empresa, '[-\s\t\n\r\x0b\x0c\x{00A0}]+', '', 'g') AS Empresa,
             regexp_replace(Valor, '[-\s\t\n\r\x0b\x0c\x{00A0}]+', '', 'g') AS v2 FROM a),
c AS (SELECT row, Empresa, CASE WHEN trim(v2) = '' THEN NULL ELSE v2 END AS Valor FROM b),
d AS (SELECT row, Empresa,
             CASE WHEN Empresa IS NOT NULL AND trim(Empresa) <> '' AND Valor IS NULL THEN '0' ELSE Valor END AS Valor FROM c),
e AS (SELECT *, regexp_matches(Empresa, '(?i)(RUTA|TMDE|TPD)') AS is_c FROM d WHERE Empresa IS NOT NULL AND Valor IS NOT NULL),
f AS (SELECT *, last_value(CASE WHEN is_c THEN Empresa END IGNORE NULLS)
                  OVER (ORDER BY row ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS Compania FROM e)
SELECT Compania, Empresa AS Tipo, Valor, '2023' AS Ano, '3' AS Trimestre, '2024-01-31 00:00:00' AS FECHAPUBLICACION
FROM f WHERE NOT is_c
""",
)
def q_parse_traffic(spark, sf_dir):
    """M6: traffic sheet -> (company, type, value)."""
    return parse_traffic(_traffic_rows(Tables(spark, sf_dir)), 2023, 3, PUBLISHED, chunk=RANGES)


def _debt_rows(t: Tables):
    n, r = t.nation, t.region
    rb = F.col("r_regionkey").cast("long") * F.lit(LINE)
    comp = n.join(r, F.col("n_regionkey") == F.col("r_regionkey")).select(
        rb.alias("b"), (F.lit(10) + F.col("n_nationkey") * 2).alias("o"),
        F.when(F.col("n_nationkey") % 4 == 0, F.lit(None)).otherwise(F.col("n_name")).alias("Compania"),
        F.lit("USD").alias("Moneda"), (F.col("n_nationkey") * 10.5).cast("string").alias("Valor"), F.lit(0.0).alias("tint"),
    )
    country = r.select(rb.alias("b"), F.lit(900000000000).alias("o"), F.col("r_name").alias("Compania"),
                       F.lit(None).cast("string").alias("Moneda"), F.lit(None).cast("string").alias("Valor"),
                       F.lit(-0.25).alias("tint"))
    total = r.filter(F.col("r_regionkey") == 4).select(
        (rb + F.lit(LINE)).alias("b"), F.lit(0).alias("o"), F.lit("TOTAL DEUDA").alias("Compania"),
        F.lit(None).cast("string").alias("Moneda"), F.lit("0").alias("Valor"), F.lit(-0.5).alias("tint"))
    u = comp.unionByName(country).unionByName(total)
    return u.select(F.lit("deuda.xlsx").alias("file"), F.lit("PERFIL").alias("sheet"),
                    (F.col("b") + F.col("o")).alias("row"), "Compania", "Moneda", "Valor", "tint")


@register(
    "parse_debt_profile",
    """
WITH r AS (
  SELECT r_regionkey * 1000000000000 + 10 + n_nationkey * 2 AS row,
         CASE WHEN n_nationkey % 4 = 0 THEN NULL ELSE n_name END AS Compania, 'USD' AS Moneda,
         CAST(CAST(n_nationkey * 10.5 AS DOUBLE) AS VARCHAR) AS Valor, 0.0 AS tint
    FROM nation JOIN region ON n_regionkey = r_regionkey
  UNION ALL SELECT r_regionkey * 1000000000000 + 900000000000, r_name, NULL, NULL, -0.25 FROM region
  UNION ALL SELECT 5000000000000, 'TOTAL DEUDA', NULL, '0', -0.5 FROM region WHERE r_regionkey = 4),
a AS (SELECT * FROM r WHERE NOT (Compania IS NULL AND Moneda IS NULL AND Valor IS NULL)),
b AS (SELECT *, CASE WHEN tint <> 0 THEN Compania ELSE first_value(CASE WHEN tint <> 0 THEN Compania END IGNORE NULLS)
                  OVER (ORDER BY row ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) END AS Pais FROM a),
c AS (SELECT * FROM b WHERE Pais IS NOT NULL AND Pais <> 'TOTAL DEUDA')
SELECT Pais, CASE WHEN Compania IS NOT NULL THEN Compania ELSE lag(Compania) OVER (ORDER BY row) END AS Compania,
       Moneda, TRY_CAST(Valor AS DOUBLE) AS Valor, '2023' AS Ano, '3' AS trimestre, '2024-01-31 00:00:00' AS FECHAPUBLICACION
FROM c
""",
)
def q_parse_debt_profile(spark, sf_dir):
    """M7: debt profile -> (country, company, currency, value)."""
    return parse_debt_profile(_debt_rows(Tables(spark, sf_dir)), 2023, 3, PUBLISHED, chunk=RANGES)


PROJECTS_SQL = """
p AS (SELECT n.n_name AS "Pais", 'Empresa ' || CAST(o.o_custkey % 20 AS VARCHAR) AS "Empresa",
             CAST(year(o.o_orderdate) AS VARCHAR) AS "Ano reporte",
             CASE quarter(o.o_orderdate) WHEN 1 THEN 'Marzo' WHEN 2 THEN 'Junio' WHEN 3 THEN 'Septiembre' ELSE 'Diciembre' END
               AS "Mes reporte",
             CASE o.o_orderpriority WHEN '5-LOW' THEN 'Renovación' WHEN '4-NOT SPECIFIED' THEN 'nan' ELSE 'Nuevo' END AS "Tipo 1",
             CASE WHEN o.o_orderkey % 101 = 0 THEN 'Proyectos de refuerzos en ejecución' ELSE 'Proyecto ' || CAST(o.o_orderkey AS VARCHAR) END
               AS "Nombre del proyecto",
             CASE WHEN o.o_orderkey % 13 = 0 THEN 'nan' ELSE strftime(o.o_orderdate + INTERVAL 400 DAY, '%Y-%m-%d') END
               AS "Fecha Energizacion RI",
             CAST(CAST(floor(o.o_totalprice) AS BIGINT) AS VARCHAR) AS "Inversion aprobada USD",
             o.o_orderstatus AS "Tipo control", o.o_orderpriority AS "Comentarios"
      FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey)"""


def _projects(t: Tables):
    o, c, n = t.orders, t.customer, t.nation
    j = o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    month = (
        F.when(F.quarter("o_orderdate") == 1, "Marzo").when(F.quarter("o_orderdate") == 2, "Junio")
        .when(F.quarter("o_orderdate") == 3, "Septiembre").otherwise("Diciembre")
    )
    return j.select(
        F.col("n_name").alias("Pais"),
        F.concat(F.lit("Empresa "), (F.col("o_custkey") % 20).cast("string")).alias("Empresa"),
        F.year("o_orderdate").cast("string").alias("Ano reporte"),
        month.alias("Mes reporte"),
        F.when(F.col("o_orderpriority") == "5-LOW", "Renovación").when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "nan")
        .otherwise("Nuevo").alias("Tipo 1"),
        F.when(F.col("o_orderkey") % 101 == 0, F.lit("Proyectos de refuerzos en ejecución"))
        .otherwise(F.concat(F.lit("Proyecto "), F.col("o_orderkey").cast("string"))).alias("Nombre del proyecto"),
        F.when(F.col("o_orderkey") % 13 == 0, F.lit("nan"))
        .otherwise(F.date_format(F.date_add(F.to_date("o_orderdate"), 400), "yyyy-MM-dd")).alias("Fecha Energizacion RI"),
        F.floor("o_totalprice").cast("string").alias("Inversion aprobada USD"),
        F.col("o_orderstatus").alias("Tipo control"),
        F.col("o_orderpriority").alias("Comentarios"),
    )


@register(
    "parse_projects",
    f"""
WITH {PROJECTS_SQL.strip()},
f AS (SELECT * FROM p WHERE "Ano reporte" = '1998' AND "Mes reporte" = 'Septiembre' AND "Tipo 1" <> 'Renovación'
        AND "Nombre del proyecto" <> 'Proyectos de refuerzos en ejecución'),
g AS (SELECT "Pais" AS Pais, "Empresa" AS Compania,
             year(TRY_CAST(CASE WHEN "Fecha Energizacion RI" = 'nan' THEN NULL ELSE "Fecha Energizacion RI" END AS DATE)) AS Ano,
             quarter(TRY_CAST(CASE WHEN "Fecha Energizacion RI" = 'nan' THEN NULL ELSE "Fecha Energizacion RI" END AS DATE)) AS Trimestre,
             "Tipo control" AS TipoControl, CAST("Inversion aprobada USD" AS FLOAT) AS usd, "Comentarios" AS Comentarios FROM f)
SELECT Pais, Compania, CAST(Ano AS INTEGER) AS Ano, CAST(Trimestre AS INTEGER) AS Trimestre, TipoControl,
       CAST(sum(usd) AS FLOAT) AS InversionAprobadaUSD, min(Comentarios) AS Comentarios,
       TIMESTAMP '{PUBLISHED}' AS FECHAPUBLICACION
FROM g GROUP BY ALL
""",
)
def q_parse_projects(spark, sf_dir):
    """Projects of the 1998 Q3 report rolled up per group."""
    return parse_projects(_projects(Tables(spark, sf_dir)), 1998, 3, PUBLISHED)


PERIODS = ["1997Q1", "1997Q2", "1997Q3", "1997Q4", "1998Q1"]


def _period_counts(t: Tables):
    o = t.orders.withColumn("period", F.concat(F.year("o_orderdate").cast("string"), F.lit("Q"), F.quarter("o_orderdate").cast("string")))
    return o.groupBy("o_orderpriority", "o_orderstatus", "period").agg(F.count(F.lit(1)).alias("value"))


@register(
    "report_wide",
    """
WITH c AS (SELECT o_orderpriority, o_orderstatus, CAST(year(o_orderdate) AS VARCHAR) || 'Q' || CAST(quarter(o_orderdate) AS VARCHAR)
                  AS period, count(*) AS value FROM orders GROUP BY ALL),
ex AS (SELECT * FROM c WHERE period IN ('1997Q1', '1997Q2', '1997Q3', '1997Q4') AND o_orderstatus <> 'P'),
nw AS (SELECT o_orderpriority, o_orderstatus, period, value + 1000 AS value FROM c WHERE period IN ('1997Q4', '1998Q1')),
l AS (SELECT * FROM ex WHERE (o_orderpriority, o_orderstatus, period) NOT IN (SELECT (o_orderpriority, o_orderstatus, period) FROM nw)
      UNION ALL SELECT * FROM nw)
SELECT o_orderpriority, o_orderstatus,
       max(CASE WHEN period = '1997Q1' THEN value END) AS "1997Q1", max(CASE WHEN period = '1997Q2' THEN value END) AS "1997Q2",
       max(CASE WHEN period = '1997Q3' THEN value END) AS "1997Q3", max(CASE WHEN period = '1997Q4' THEN value END) AS "1997Q4",
       max(CASE WHEN period = '1998Q1' THEN value END) AS "1998Q1"
FROM l GROUP BY ALL
""",
)
def q_report_wide(spark, sf_dir):
    """A new quarter (and a re-run of the last one) placed next to
    the earlier periods; rows missing before (status P) are added."""
    c = _period_counts(Tables(spark, sf_dir))
    existing = c.filter(F.col("period").isin(PERIODS[:4]) & (F.col("o_orderstatus") != "P"))
    new = c.filter(F.col("period").isin("1997Q4", "1998Q1")).withColumn("value", F.col("value") + 1000)
    return report_wide(existing, new, ["o_orderpriority", "o_orderstatus"], "period", "value", PERIODS)


@register(
    "project_report",
    f"""
WITH {PROJECTS_SQL.strip()},
d AS (SELECT "Pais" AS Pais, "Empresa" AS Compania, "Tipo control" AS TipoControl, "Nombre del proyecto" AS Proyecto
      FROM p)
SELECT *, row_number() OVER (PARTITION BY Pais ORDER BY Compania, TipoControl, Proyecto) = 1 AS country_header,
       row_number() OVER (PARTITION BY Pais, Compania ORDER BY TipoControl, Proyecto) = 1 AS company_header,
       row_number() OVER (PARTITION BY Pais, Compania, TipoControl ORDER BY Proyecto) = 1 AS control_header
FROM d
""",
)
def q_project_report(spark, sf_dir):
    """Hierarchical project list with group-header flags."""
    p = _projects(Tables(spark, sf_dir))
    d = p.select("Pais", F.col("Empresa").alias("Compania"), F.col("Tipo control").alias("TipoControl"),
                 F.col("Nombre del proyecto").alias("Proyecto"))
    return project_report(d)


@register(
    "classify_indent",
    """
WITH c AS (SELECT 'capex.xlsx' AS file, 'CAPEX' AS sheet, n_nationkey * 1000000000000 AS row, n_name AS value, 0 AS indent FROM nation
           UNION ALL SELECT 'capex.xlsx', 'CAPEX', n_nationkey * 1000000000000 + 1 + s_suppkey, s_name,
                            CASE WHEN s_suppkey % 3 = 0 THEN 2 ELSE 1 END
           FROM supplier JOIN nation ON s_nationkey = n_nationkey
           UNION ALL SELECT 'capex.xlsx', 'CAPEX', n_nationkey * 1000000000000 + 999999999999, NULL, 0 FROM nation),
l AS (SELECT *, lag(row) OVER w AS prow, lag(value) OVER w AS pval FROM c WINDOW w AS (PARTITION BY file, sheet ORDER BY row))
SELECT file, sheet, row, value, indent,
       CASE WHEN value IS NULL THEN 'blank' WHEN prow IS NOT NULL AND pval IS NULL THEN 'country'
            WHEN indent = 1 THEN 'company' ELSE 'detail' END AS kind
FROM l
""",
)
def q_classify_indent(spark, sf_dir):
    """Blank / country (after a blank row) / company (indent 1) / detail."""
    t = Tables(spark, sf_dir)
    n, s = t.nation, t.supplier
    head = n.select(F.lit("capex.xlsx").alias("file"), F.lit("CAPEX").alias("sheet"),
                    (F.col("n_nationkey").cast("long") * LINE).alias("row"), F.col("n_name").alias("value"), F.lit(0).alias("indent"))
    lines = s.join(n, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.lit("capex.xlsx").alias("file"), F.lit("CAPEX").alias("sheet"),
        (F.col("n_nationkey").cast("long") * LINE + 1 + F.col("s_suppkey")).alias("row"), F.col("s_name").alias("value"),
        F.when(F.col("s_suppkey") % 3 == 0, 2).otherwise(1).alias("indent"))
    blank = n.select(F.lit("capex.xlsx").alias("file"), F.lit("CAPEX").alias("sheet"),
                     (F.col("n_nationkey").cast("long") * LINE + LINE - 1).alias("row"), F.lit(None).cast("string").alias("value"),
                     F.lit(0).alias("indent"))
    return classify_indent(head.unionByName(lines).unionByName(blank), chunk=RANGES)


DEBT_COLS = [
    "Filial", "Tipo", "Fuente de Financiación", "Moneda Crédito", "Fecha Emisión", "Fecha Vencimiento", "Plazo Años",
    "Tasa de Interés", "Unnamed: 8", "Unnamed: 9", "Jun-2024\n(moneda del crédito)", "Jun-2024\n(millones de COP)",
    "Jun-2024\n(miles USD)",
]


def _debt_sheet(t: Tables):
    n, s = t.nation, t.supplier
    base = F.col("n_nationkey").cast("long") * F.lit(LINE)
    null = F.lit(None).cast("string")
    country = n.select(base.alias("b"), F.lit(0).alias("o"), F.col("n_name").alias("Filial"), *[null.alias(c) for c in DEBT_COLS[1:]])
    bonds = s.join(n, F.col("s_nationkey") == F.col("n_nationkey")).select(
        base.alias("b"), (F.lit(10) + F.col("s_suppkey")).alias("o"),
        F.col("s_name").alias("Filial"),
        F.when(F.col("s_suppkey") % 2 == 0, "Bonos").otherwise("Bonos Verdes").alias("Tipo"),
        F.lit("Mercado").alias("Fuente de Financiación"), F.lit("USD").alias("Moneda Crédito"),
        F.date_format(F.date_add(F.lit("2015-01-01").cast("date"), F.col("s_suppkey").cast("int")), "yyyy-MM-dd HH:mm:ss").alias("Fecha Emisión"),
        F.date_format(F.date_add(F.lit("2030-01-01").cast("date"), F.col("s_suppkey").cast("int")), "yyyy-MM-dd HH:mm:ss").alias("Fecha Vencimiento"),
        (F.col("s_suppkey") % 30 + F.lit(0.5)).cast("string").alias("Plazo Años"),
        F.lit("IPC").alias("Tasa de Interés"), F.lit("+").alias("Unnamed: 8"),
        F.when(F.col("s_suppkey") % 5 == 0, F.lit("nan")).otherwise((F.col("s_suppkey") % 7 / 100.0).cast("string")).alias("Unnamed: 9"),
        F.col("s_acctbal").cast("string").alias("Jun-2024\n(moneda del crédito)"),
        (F.col("s_acctbal") * 4).cast("string").alias("Jun-2024\n(millones de COP)"),
        F.floor("s_acctbal").cast("string").alias("Jun-2024\n(miles USD)"),
    )
    total = n.select(base.alias("b"), F.lit(900000000000).alias("o"), F.lit("TOTAL BONOS").alias("Filial"), *[null.alias(c) for c in DEBT_COLS[1:]])
    u = country.unionByName(bonds).unionByName(total)
    return u.select(F.lit("deuda.xlsx").alias("file"), F.lit("Bonos").alias("sheet"), (F.col("b") + F.col("o")).alias("row"), *DEBT_COLS)


DEBT_SQL = """
WITH raw AS (
  SELECT n_nationkey * 1000000000000 AS row, n_name AS Filial, NULL::VARCHAR AS Tipo, NULL::VARCHAR AS Fuente,
         NULL::VARCHAR AS Moneda, NULL::VARCHAR AS FE, NULL::VARCHAR AS FV, NULL::VARCHAR AS Plazo, NULL::VARCHAR AS Tasa,
         NULL::VARCHAR AS U8, NULL::VARCHAR AS U9, NULL::VARCHAR AS MC, NULL::VARCHAR AS MCOP, NULL::VARCHAR AS MUSD
  FROM nation
  UNION ALL
  SELECT n_nationkey * 1000000000000 + 10 + s_suppkey, s_name, CASE WHEN s_suppkey % 2 = 0 THEN 'Bonos' ELSE 'Bonos Verdes' END,
         'Mercado', 'USD', strftime(DATE '2015-01-01' + CAST(s_suppkey AS INTEGER), '%Y-%m-%d %H:%M:%S'),
         strftime(DATE '2030-01-01' + CAST(s_suppkey AS INTEGER), '%Y-%m-%d %H:%M:%S'),
         CAST(CAST(s_suppkey % 30 + 0.5 AS DOUBLE) AS VARCHAR), 'IPC', '+',
         CASE WHEN s_suppkey % 5 = 0 THEN 'nan' ELSE CAST(CAST(s_suppkey % 7 AS DOUBLE) / 100.0 AS VARCHAR) END,
         CAST(s_acctbal AS VARCHAR), CAST(s_acctbal * 4 AS VARCHAR), CAST(CAST(floor(s_acctbal) AS BIGINT) AS VARCHAR)
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
  UNION ALL
  SELECT n_nationkey * 1000000000000 + 900000000000, 'TOTAL BONOS', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL
  FROM nation),
a AS (SELECT row, Filial, Tipo, Fuente, Moneda, FE, FV, Plazo, Tasa, U8,
             CASE WHEN U9 IN ('nan', 'NaT', 'NaN') THEN NULL ELSE U9 END AS U9, MC, MCOP, MUSD FROM raw
      WHERE Filial IS NULL OR Filial NOT IN ('(1) Bonos emitidos en PEN y se hizo un SWAP a USD con el Banco BBVA.',
        '(2) Bonos emitidos en USD y se hizo un SWAP a UF.', '(3) Opcion Call', 'Bonos Verdes', 'TOTAL BONOS')),
b AS (SELECT *, CASE WHEN Filial IS NOT NULL AND Tipo IS NULL THEN Filial END AS p_m,
                CASE WHEN Filial IS NOT NULL AND Tipo IS NOT NULL THEN Filial END AS c_m FROM a
      WHERE NOT (Filial = ' ' AND Tipo = ' ')),
c AS (SELECT *, last_value(p_m IGNORE NULLS) OVER w AS Pais, last_value(c_m IGNORE NULLS) OVER w AS Compania
      FROM b WINDOW w AS (ORDER BY row ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT Compania, Pais, Tipo, Fuente AS FuentedeFinanciacion, Moneda AS MonedaCredito,
       strftime(try_strptime(FE, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d') AS FechaEmision,
       strftime(try_strptime(FV, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d') AS FechaVencimiento,
       CAST(TRY_CAST(Plazo AS DECIMAL(10, 2)) AS DOUBLE) AS PlazoAnos,
       concat_ws(' ', Tasa, U8, CASE WHEN U9 IS NOT NULL
                               THEN CAST(round(TRY_CAST(U9 AS DOUBLE) * 100.0, 3) AS VARCHAR) || ' %' END) AS TasaDeInteres,
       '2024' AS AnoMoneda, 'Jun' AS MesMoneda,
       CAST(TRY_CAST(MC AS DECIMAL(20, 0)) AS DOUBLE) AS MonedaDelCredito,
       CAST(TRY_CAST(MCOP AS DECIMAL(10, 0)) AS DOUBLE) AS MillonesDeCOP,
       CAST(TRY_CAST(MUSD AS DECIMAL(10, 0)) AS DOUBLE) AS MilesUSD,
       '2024' AS AnoEvaluado, '2' AS trimestreEvaluado, TIMESTAMP '2024-01-31 00:00:00' AS FECHAPUBLICACION
FROM c WHERE Tipo IS NOT NULL
"""


@register("parse_debt", DEBT_SQL)
def q_parse_debt(spark, sf_dir):
    """Consolidated bonds sheet -> typed tidy rows (the
    decimal amounts are reported as double for the comparison)."""
    from ..operators.reports import parse_debt, parse_header_period

    rows = _debt_sheet(Tables(spark, sf_dir))
    rename, mes, ano = parse_header_period(rows.columns)
    out = parse_debt(rows.withColumnsRenamed(rename), "bonos", mes, ano, 2024, 2, PUBLISHED, chunk=RANGES)
    dec = [c for c, t in out.dtypes if t.startswith("decimal")]
    return out.withColumns({c: F.col(c).cast("double") for c in dec})


@register("parse_debt_loans", DEBT_SQL.replace("CASE WHEN s_suppkey % 2 = 0 THEN 'Bonos' ELSE 'Bonos Verdes' END", "'Creditos'"))
def q_parse_debt_loans(spark, sf_dir):
    """M8: the consolidated loans sheet, which has no type column and names the
    start date in its own way."""
    from ..operators.reports import parse_debt, parse_header_period

    rows = _debt_sheet(Tables(spark, sf_dir)).drop("Tipo").withColumnRenamed("Fecha Emisión", "Fecha Inicial")
    rename, mes, ano = parse_header_period(rows.columns)
    out = parse_debt(rows.withColumnsRenamed(rename), "creditos", mes, ano, 2024, 2, PUBLISHED, chunk=RANGES)
    dec = [c for c, t in out.dtypes if t.startswith("decimal")]
    return out.withColumns({c: F.col(c).cast("double") for c in dec})


LEGACY_NAMES = ["Filial", "Fuente de\nFinanciación", "Moneda Crédito", "Fecha Inicial", "Fecha Vencimiento", "Plazo Años",
                "Tasa de Interés", "Jun 2024\n(moneda del crédito)", "Jun 2024\n(millones de COP)", "Jun 2024\n(miles USD)"]


def _legacy_cells(t: Tables):
    n, s = t.nation, t.supplier
    base = F.col("n_nationkey").cast("long") * F.lit(LINE) + F.lit(10)
    head = t.region.filter(F.col("r_regionkey") == 0).select(
        F.lit(1).cast("long").alias("row"), *[F.lit(x).alias(f"v{i}") for i, x in enumerate(LEGACY_NAMES)]
    )
    null = F.lit(None).cast("string")
    country = n.select(base.alias("row"), F.col("n_name").alias("v0"), *[null.alias(f"v{i}") for i in range(1, len(LEGACY_NAMES))])
    loans = s.join(n, F.col("s_nationkey") == F.col("n_nationkey")).select(
        (base + F.lit(1) + F.col("s_suppkey")).alias("row"), F.col("s_name").alias("v0"), F.lit("Banco").alias("v1"),
        F.lit("COP").alias("v2"), (F.lit(43000) + F.col("s_suppkey")).cast("string").alias("v3"),
        (F.lit(47000) + F.col("s_suppkey")).cast("string").alias("v4"), (F.col("s_suppkey") % 12).cast("string").alias("v5"),
        F.lit("IBR + 2%").alias("v6"), F.col("s_acctbal").cast("string").alias("v7"),
        (F.col("s_acctbal") * 4).cast("string").alias("v8"), F.floor("s_acctbal").cast("string").alias("v9"),
    )
    grid = head.unionByName(country).unionByName(loans).withColumns({"file": F.lit("creditos.xlsx"), "sheet": F.lit("Creditos")})
    return cells_from_rows(grid, "file", "sheet", "row", [f"v{i}" for i in range(len(LEGACY_NAMES))])


LEGACY_SQL = """
WITH raw AS (
  SELECT n_nationkey * 1000000000000 + 10 AS row, n_name AS Filial, NULL::VARCHAR AS Fuente, NULL::VARCHAR AS Moneda,
         NULL::VARCHAR AS FI, NULL::VARCHAR AS FV, NULL::VARCHAR AS Plazo, NULL::VARCHAR AS Tasa,
         NULL::VARCHAR AS MC, NULL::VARCHAR AS MCOP, NULL::VARCHAR AS MUSD FROM nation
  UNION ALL
  SELECT n_nationkey * 1000000000000 + 11 + s_suppkey, s_name, 'Banco', 'COP', CAST(43000 + s_suppkey AS VARCHAR),
         CAST(47000 + s_suppkey AS VARCHAR), CAST(s_suppkey % 12 AS VARCHAR), 'IBR + 2%', CAST(s_acctbal AS VARCHAR),
         CAST(s_acctbal * 4 AS VARCHAR), CAST(CAST(floor(s_acctbal) AS BIGINT) AS VARCHAR)
  FROM supplier JOIN nation ON s_nationkey = n_nationkey),
a AS (SELECT *, CASE WHEN Filial IS NOT NULL AND Fuente IS NULL THEN Filial END AS p_m,
                CASE WHEN Filial IS NOT NULL AND Fuente IS NOT NULL THEN Filial END AS c_m FROM raw
      WHERE (Filial IS NULL OR Filial <> 'Filial')
        AND (Filial IS NULL OR Filial NOT IN ('(1) Bonos emitidos en PEN y se hizo un SWAP a USD con el Banco BBVA.',
             '(2) Bonos emitidos en USD y se hizo un SWAP a UF.', '(3) Opcion Call', 'Bonos Verdes'))),
c AS (SELECT *, last_value(p_m IGNORE NULLS) OVER w AS Pais, last_value(c_m IGNORE NULLS) OVER w AS Compania
      FROM a WINDOW w AS (ORDER BY row ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT Compania, Pais, Fuente AS FuentedeFinanciacion, Moneda AS MonedaCredito,
       CAST(DATE '1899-12-30' + TRY_CAST(FI AS INTEGER) AS DATE) AS FechaInicial,
       CAST(DATE '1899-12-30' + TRY_CAST(FV AS INTEGER) AS DATE) AS FechaVencimiento,
       TRY_CAST(Plazo AS INTEGER) AS PlazoAnos, Tasa AS TasadeInteres,
       CAST(TRY_CAST(MC AS DECIMAL(20, 0)) AS DOUBLE) AS Jun2024monedadelcredito,
       CAST(TRY_CAST(MCOP AS DECIMAL(10, 0)) AS DOUBLE) AS Jun2024millonesdeCOP,
       CAST(TRY_CAST(MUSD AS DECIMAL(10, 0)) AS DOUBLE) AS Jun2024milesUSD,
       TIMESTAMP '2024-01-31 00:00:00' AS FECHAPUBLICACION
FROM c WHERE Fuente IS NOT NULL
"""


@register("parse_loans_legacy", LEGACY_SQL)
def q_parse_loans_legacy(spark, sf_dir):
    """Legacy loan sheet (header row, serial dates); the
    decimal amounts are reported as double for the comparison."""
    from ..operators.reports import parse_loans_legacy

    out = parse_loans_legacy(staged(_legacy_cells(Tables(spark, sf_dir))), LEGACY_NAMES, PUBLISHED, chunk=RANGES)
    dec = [c for c, t in out.dtypes if t.startswith("decimal")]
    return out.withColumns({c: F.col(c).cast("double") for c in dec})


@register(
    "promoted_header",
    """
SELECT 'nation_' || n_nationkey || '.xlsx' AS file, s_suppkey + 2 AS row, s_name AS "Nombre", CAST(s_nationkey AS VARCHAR) AS "Zona"
FROM supplier JOIN nation ON s_nationkey = n_nationkey
""",
)
def q_promoted_header(spark, sf_dir):
    """The texts of a sheet's first row become the names of the cells below."""
    t = Tables(spark, sf_dir)
    file = F.concat(F.lit("nation_"), F.col("n_nationkey").cast("string"), F.lit(".xlsx")).alias("file")
    head = t.nation.select(file, F.lit(1).cast("long").alias("row"), F.lit("Nombre").alias("v1"), F.lit("Zona").alias("v2"))
    body = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        file, (F.col("s_suppkey") + 2).alias("row"), F.col("s_name").alias("v1"), F.col("s_nationkey").cast("string").alias("v2")
    )
    sheet = head.unionByName(body).withColumn("sheet", F.lit("Hoja1"))
    named = promote_header(cells_from_rows(sheet, "file", "sheet", "row", ["v1", "v2"]), 1)
    return named.groupBy("file", "row").pivot("name", ["Nombre", "Zona"]).agg(F.first("value"))
