"""File-manifest checks and period-aware file choice (survey A15, C4-C6,
C8, C11, D10, E2, G2, G4, H4, L7-L11).

The manifest, the folder listing and the check results are DataFrames; no
list is collected to the driver to build an ``isin`` filter (semi / anti
joins instead), and every check yields ``(check, ok, message)`` rows that
gate the next step.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import base_name
from .clean import keep_first

# Message texts of the manifest checks.
MSG_MISSING_IN_FILE = '" no existe en el Archivo'
MSG_MISSING_IN_CATALOG = '" no existe en el Catálogo'
MSG_NO_PERIOD_FILE = ' --- la carpeta {folder} no tiene archivo con el formato <<_"TrimestreEvaluar"Q_"AñoEvaluar".xlsx\n '


def list_files(spark: SparkSession, root: str, recursive: bool = True) -> DataFrame:
    """Files under a folder as a table ``(folder, path, file)`` -- only
    file metadata is read (``binaryFile`` with the content column pruned)."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(root)
    p = F.col("path")
    return df.select(
        F.regexp_extract(p, r"^(.*)/[^/]*$", 1).alias("folder"), p.alias("path"), base_name(p).alias("file")
    )


def folder_name(col: Column | str) -> Column:
    """Folder display name: the listing's trailing slash cut off."""
    return F.regexp_replace(F.col(col) if isinstance(col, str) else col, ".$", "")


def reconcile(catalog: DataFrame, manifest: DataFrame, cat_name: str, man_name: str) -> DataFrame:
    """Full join of catalog and manifest on the lower-cased name;
    one message row per name present on one side only."""
    j = catalog.join(manifest, F.lower(F.col(cat_name)) == F.lower(F.col(man_name)), "full")
    miss = j.filter(F.col(man_name).isNull() | F.col(cat_name).isNull())
    msg = F.when(
        F.col(man_name).isNull(), F.concat_ws("", F.lit('"'), F.col(cat_name), F.lit(MSG_MISSING_IN_FILE))
    ).otherwise(F.concat_ws("", F.lit('"'), F.col(man_name), F.lit(MSG_MISSING_IN_CATALOG)))
    return miss.select(msg.alias("Restante"))


def check_result(issues: DataFrame, check: str) -> DataFrame:
    """One ``(check, ok, n_issues)`` row; ``ok`` when there is no issue."""
    return issues.agg(F.count(F.lit(1)).alias("n_issues")).select(
        F.lit(check).alias("check"), (F.col("n_issues") == 0).alias("ok"), "n_issues"
    )


def _period_like(col: str, tags: Sequence[str]) -> Column:
    cond = F.lit(False)
    for t in tags:
        cond = cond | F.col(col).like(f"%{t}%")
    return cond


def match_period_files(files: DataFrame, q: int, year: int, folder: str = "folder", file: str = "file",
                       path: str = "path") -> DataFrame:
    """Per folder, the first file (by name) whose name contains
    ``{q}Q_{year}``; folders without one get ``ok = false`` and a message."""
    tag = f"{q}Q_{year}"
    hits = files.filter(F.col(file).contains(tag))
    first = keep_first(hits, [folder], [(file, True), (path, True)]).select(folder, path)
    folders = files.select(folder).distinct()
    out = folders.join(first, folder, "left")
    msg = F.replace(F.lit(MSG_NO_PERIOD_FILE), F.lit("{folder}"), F.col(folder))
    return out.select(
        folder,
        path,
        F.col(path).isNotNull().alias("ok"),
        F.when(F.col(path).isNull(), msg).alias("message"),
    )


def choose_files(files: DataFrame, q: int, year: int, folder: str = "folder", file: str = "file") -> DataFrame:
    """Files to read for a period --
    (1) every file of a folder holding exactly one file (C8/D10),
    (2) every file tagged with the quarter (``Q3``, ``3Q``, ``T3``, ``3T``),
    union distinct (G2); then for folders still uncovered (left anti, C5)
    (3) the first file by name among those tagged with the year (E2)."""
    per_folder = files.groupBy(folder).agg(F.count(file).alias("_n"))
    single = files.join(per_folder.filter(F.col("_n") == 1).select(folder), folder, "left_semi")
    quarter = files.filter(_period_like(file, [f"Q{q}", f"{q}Q", f"T{q}", f"{q}T"]))
    chosen = single.unionByName(quarter).distinct()
    uncovered = per_folder.select(folder).join(chosen.select(folder), folder, "left_anti")
    yy = f"{year % 100:02d}"
    rest = files.join(uncovered, folder, "left_semi").filter(_period_like(file, [str(year), yy]))
    order = [(file, True)] + [(c, True) for c in files.columns if c not in (folder, file)]
    return chosen.unionByName(keep_first(rest, [folder], order).select(*files.columns))


def missing(expected: DataFrame, present: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Expected key combinations absent from ``present``
    (``EXCEPT`` as a left-anti join plus distinct)."""
    return expected.select(*keys).join(present.select(*keys), list(keys), "left_anti").distinct()
