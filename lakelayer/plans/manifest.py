"""Manifest queries (survey L7-L11, C4, C5, C8, C11, D10, E2, G2, G4, H4).

The folder listing is ``pages``: the host is the folder, the URL without
query / fragment / trailing slash is the path, and each page's report file
carries a period tag derived from its id (quarter ``id % 4 + 1``, year
``2020 + id % 5``).  The manifest names the folders with the page language as
sheet.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import base_name
from ..operators.manifest import check_result, choose_files, folder_name, list_files, match_period_files, missing, reconcile
from ..sources.tables import Tables
from ..sources.writers import staging_path
from .registry import register

Q, YEAR = 3, 2023


def listing(t: Tables):
    p = t.pages
    clean = F.regexp_replace(F.regexp_replace("url", r"[?#].*$", ""), "/$", "")
    path = F.concat(
        clean, F.lit("_"), (F.col("page_id") % 4 + 1).cast("string"), F.lit("Q_"),
        (F.lit(2020) + F.col("page_id") % 5).cast("string"), F.lit(".xlsx"),
    )
    files = p.select(F.regexp_extract("url", "^https?://([^/]+)", 1).alias("folder"), path.alias("path"), "url", "page_id")
    return files.withColumn("file", base_name("path"))


def manifest(t: Tables):
    """C11: manifest (folder, sheet) joined to the listing on the folder."""
    return t.pages.select(
        F.regexp_extract("url", "^https?://([^/]+)", 1).alias("folder"),
        F.upper(F.regexp_extract("url", "^https?://[^/]+/([a-z]+)/", 1)).alias("sheet"),
    ).distinct()


LISTING_SQL = """
l AS (SELECT regexp_extract(url, '^https?://([^/]+)', 1) AS folder,
             regexp_replace(regexp_replace(url, '[?#].*$', ''), '/$', '') || '_' || CAST(page_id % 4 + 1 AS VARCHAR)
               || 'Q_' || CAST(2020 + page_id % 5 AS VARCHAR) || '.xlsx' AS path, url FROM pages),
f AS (SELECT *, string_split(regexp_replace(path, '/$', ''), '/')[-1] AS file FROM l)"""


@register(
    "choose_period_files",
    f"""
WITH {LISTING_SQL.strip()},
m AS (SELECT DISTINCT regexp_extract(url, '^https?://([^/]+)', 1) AS folder,
             upper(regexp_extract(url, '^https?://[^/]+/([a-z]+)/', 1)) AS sheet FROM pages),
c AS (SELECT f.folder, m.sheet, f.path, f.file FROM f JOIN m ON f.folder = m.folder),
n AS (SELECT folder FROM c GROUP BY folder HAVING count(file) = 1),
u AS (SELECT * FROM c WHERE folder IN (SELECT folder FROM n)
      UNION SELECT * FROM c WHERE file LIKE '%Q{Q}%' OR file LIKE '%{Q}Q%' OR file LIKE '%T{Q}%' OR file LIKE '%{Q}T%'),
unc AS (SELECT DISTINCT folder FROM c WHERE folder NOT IN (SELECT folder FROM u)),
r AS (SELECT * FROM c WHERE folder IN (SELECT folder FROM unc) AND (file LIKE '%{YEAR}%' OR file LIKE '%{YEAR % 100:02d}%')
      QUALIFY row_number() OVER (PARTITION BY folder ORDER BY file, sheet, path) = 1)
SELECT * FROM u UNION ALL SELECT * FROM r
""",
)
def q_choose_period_files(spark, sf_dir):
    """Period-aware choice of the files to load."""
    t = Tables(spark, sf_dir)
    files = listing(t).select("folder", "path", "file")
    c = files.join(manifest(t), "folder", "inner").select("folder", "sheet", "path", "file")
    return choose_files(c, Q, YEAR)


@register(
    "match_period_files",
    f"""
WITH {LISTING_SQL.strip()},
hit AS (SELECT folder, path FROM f WHERE contains(file, '{Q}Q_{YEAR}')
        QUALIFY row_number() OVER (PARTITION BY folder ORDER BY file, path) = 1),
d AS (SELECT DISTINCT folder FROM f)
SELECT d.folder, hit.path, hit.path IS NOT NULL AS ok,
       CASE WHEN hit.path IS NULL THEN ' --- la carpeta ' || d.folder
            || ' no tiene archivo con el formato <<_"TrimestreEvaluar"Q_"AñoEvaluar".xlsx' || chr(10) || ' ' END AS message
FROM d LEFT JOIN hit ON d.folder = hit.folder
""",
)
def q_match_period_files(spark, sf_dir):
    """Each folder must hold a ``{q}Q_{year}`` file; first match kept."""
    return match_period_files(listing(Tables(spark, sf_dir)), Q, YEAR)


CATALOG_SQL = """
cat AS (SELECT '/data/' || lower(n_name) AS path, n_name AS NombreCatalogo FROM nation),
man AS (SELECT upper(n_name) AS NombreArchivo FROM nation WHERE n_regionkey <> 4
        UNION ALL SELECT r_name FROM region),
j AS (SELECT * FROM cat FULL JOIN man ON lower(NombreCatalogo) = lower(NombreArchivo)),
miss AS (SELECT CASE WHEN NombreArchivo IS NULL THEN '"' || NombreCatalogo || '" no existe en el Archivo'
                     ELSE '"' || NombreArchivo || '" no existe en el Catálogo' END AS Restante
         FROM j WHERE NombreArchivo IS NULL OR NombreCatalogo IS NULL)"""


def _catalog(t: Tables):
    cat = t.nation.select(F.concat(F.lit("/data/"), F.lower("n_name")).alias("path"), F.col("n_name").alias("NombreCatalogo"))
    man = (
        t.nation.filter(F.col("n_regionkey") != 4)
        .select(F.upper("n_name").alias("NombreArchivo"))
        .unionByName(t.region.select(F.col("r_name").alias("NombreArchivo")))
    )
    return cat, man


@register("reconcile_keys", f"WITH {CATALOG_SQL.strip()} SELECT * FROM miss")
def q_reconcile_keys(spark, sf_dir):
    """Catalog vs manifest names (case-insensitive), one message per
    name missing on either side."""
    cat, man = _catalog(Tables(spark, sf_dir))
    return reconcile(cat, man, "NombreCatalogo", "NombreArchivo")


@register(
    "manifest_check",
    f"WITH {CATALOG_SQL.strip()} SELECT 'reconcile_catalog' AS check, count(*) = 0 AS ok, count(*) AS n_issues FROM miss",
)
def q_manifest_check(spark, sf_dir):
    """The reconciliation as one gating ``(check, ok, n_issues)`` row."""
    cat, man = _catalog(Tables(spark, sf_dir))
    return check_result(reconcile(cat, man, "NombreCatalogo", "NombreArchivo"), "reconcile_catalog")


REQUIRED_SHEETS = ["EEFF", "CAPEX", "TRAFICO"]


@register(
    "missing_sheets",
    f"""
WITH {LISTING_SQL.strip()},
req AS (SELECT DISTINCT f.path, s.sheet FROM f, (VALUES {", ".join(f"('{s}')" for s in REQUIRED_SHEETS)}) s(sheet)),
pg AS (SELECT regexp_replace(regexp_replace(url, '[?#].*$', ''), '/$', '') || '_' || CAST(page_id % 4 + 1 AS VARCHAR)
               || 'Q_' || CAST(2020 + page_id % 5 AS VARCHAR) || '.xlsx' AS path, page_id, url FROM pages),
pres AS (SELECT path, 'EEFF' AS sheet FROM pg
         UNION ALL SELECT path, 'CAPEX' FROM pg WHERE page_id % 3 <> 0
         UNION ALL SELECT path, 'TRAFICO' FROM pg WHERE url LIKE '%/en/%')
SELECT DISTINCT path, sheet FROM req WHERE (path, sheet) NOT IN (SELECT (path, sheet) FROM pres)
""",
)
def q_missing_sheets(spark, sf_dir):
    """Required (file, sheet) pairs absent from the workbooks."""
    t = Tables(spark, sf_dir)
    f = listing(t)
    sheets = F.array(*[F.lit(s) for s in REQUIRED_SHEETS])
    req = f.select("path", F.explode(sheets).alias("sheet"))
    pres = f.select(
        "path",
        F.explode(
            F.array_compact(
                F.array(
                    F.lit("EEFF"),
                    F.when(F.col("page_id") % 3 != 0, F.lit("CAPEX")),
                    F.when(F.col("url").contains("/en/"), F.lit("TRAFICO")),
                )
            )
        ).alias("sheet"),
    )
    return missing(req, pres, ["path", "sheet"])


@register(
    "list_period_files",
    f"""
WITH p AS (SELECT DISTINCT 'host' || page_id % 40 AS folder,
                  CAST(page_id // 40 % 4 + 1 AS VARCHAR) || 'Q_' || CAST(2020 + page_id // 160 % 5 AS VARCHAR) || '.xlsx' AS file FROM pages),
hit AS (SELECT folder, file FROM p WHERE contains(file, '{Q}Q_{YEAR}') QUALIFY row_number() OVER (PARTITION BY folder ORDER BY file) = 1),
n AS (SELECT folder FROM p GROUP BY folder HAVING count(*) = 1),
u AS (SELECT * FROM p WHERE folder IN (SELECT folder FROM n)
      UNION SELECT * FROM p WHERE file LIKE '%Q{Q}%' OR file LIKE '%{Q}Q%' OR file LIKE '%T{Q}%' OR file LIKE '%{Q}T%'),
r AS (SELECT * FROM p WHERE folder NOT IN (SELECT folder FROM u) AND (file LIKE '%{YEAR}%' OR file LIKE '%{YEAR % 100:02d}%')
      QUALIFY row_number() OVER (PARTITION BY folder ORDER BY file) = 1)
SELECT c.folder, c.file, hit.file IS NOT NULL AS has_period_file FROM (SELECT * FROM u UNION ALL SELECT * FROM r) c LEFT JOIN hit USING (folder)
""",
)
def q_list_period_files(spark, sf_dir):
    """A15 with L8/L9: pages written as files of folders, the folders listed by the
    files' metadata, and the period's files picked."""
    pages = Tables(spark, sf_dir).pages
    k = F.floor(F.col("page_id") / 40)
    name = F.concat((k % 4 + 1).cast("string"), F.lit("Q_"), (F.floor(F.col("page_id") / 160) % 5 + 2020).cast("string"), F.lit(".xlsx"))
    root = staging_path(spark, "reports")
    rows = pages.select("url", F.concat(F.lit("host"), F.col("page_id") % 40).alias("folder"), name.alias("file"))
    rows.hint("rebalance", F.col("folder"), F.col("file")).write.partitionBy("folder", "file").text(root)
    part = list_files(spark, root).select(folder_name(F.regexp_extract("path", "/folder=([^/]+/)file=", 1)).alias("folder"), F.regexp_extract("path", "/file=([^/]+)/", 1).alias("file"))
    files = part.distinct()  # a large report may be in several part files
    hit = match_period_files(files.withColumn("path", F.col("file")), Q, YEAR).select("folder", F.col("ok").alias("has_period_file"))
    return choose_files(files, Q, YEAR).join(hit, "folder")
