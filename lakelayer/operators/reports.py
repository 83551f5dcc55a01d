"""Semi-structured report ingestion on a cell table (survey M1-M13, B14-B18).

A workbook is read (outside this package) into a long *cell table*
``(file, sheet, row, col, value, indent, tint)`` with every value as text.
Everything after that is DataFrame work: anchors are found per sheet with
``min_by``/``max_by`` aggregates, the period column is chosen by a filter on
the header cells (not a driver-side scan of column names), slices are joins
of the cell table with one-row-per-sheet anchor tables, and the section
logic uses the ordered scans of :mod:`lakelayer.operators.fill`, partitioned
by ``(file, sheet)`` and ordered by the source row.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import split_part_or_null
from .clean import null_out
from .fill import RANGES, Chunk, bfill, by_range, drop_before_blank, ffill

SHEET = ["file", "sheet"]


def _in_ranges(rows: DataFrame, order: str, chunk: Chunk) -> tuple[DataFrame, Chunk]:
    """With ``RANGES``: the sheet rows written once in ranges that serve all of the
    scans behind, so these read the written rows and not what they came from."""
    if isinstance(chunk, str) and chunk == RANGES:
        return by_range(rows, SHEET, [order]).withColumnRenamed("_chunk", "_range"), F.col("_range")
    return rows, chunk


# ---------------------------------------------------------------- M1 - M3
def cells_from_rows(df: DataFrame, file: str, sheet: str, row: str, value_cols: Sequence[str]) -> DataFrame:
    """M1: a wide grid (one row per sheet row) as a long cell table; column
    numbers follow ``value_cols`` (1-based), values are text, blanks dropped."""
    arr = F.array(*[F.col(c).cast("string") for c in value_cols])
    out = df.select(
        F.col(file).alias("file"), F.col(sheet).alias("sheet"), F.col(row).alias("row"), F.posexplode(arr).alias("c0", "value")
    )
    return out.filter(F.col("value").isNotNull()).select(
        "file", "sheet", "row", (F.col("c0") + 1).alias("col"), "value"
    )


def find_anchor(cells: DataFrame, pred: Column, last: bool = False) -> DataFrame:
    """M2: per sheet, the first (or ``last``) cell in row-major order whose
    value satisfies ``pred``: ``(file, sheet, anchor_row, anchor_col)``."""
    pick = F.max_by if last else F.min_by
    pos = F.struct("row", "col")
    a = cells.filter(pred).groupBy(*SHEET).agg(pick(pos, pos).alias("_a"))
    return a.select(*SHEET, F.col("_a.row").alias("anchor_row"), F.col("_a.col").alias("anchor_col"))


def period_header(year: int, q: int) -> Column:
    """Header cell naming the period -- ``{q}Q{yy}`` / ``{q}T{yy}``,
    ``{yyyy}-{q}Q`` / ``{yyyy} - {q}T`` or the bare year (spaces ignored)."""
    v = F.regexp_replace(F.col("value"), r"\s", "")
    yy = f"{year % 100:02d}"
    return v.isin(f"{q}Q{yy}", f"{q}T{yy}", f"{year}-{q}Q", f"{year}-{q}T", str(year))


def slice_period(cells: DataFrame, anchors: DataFrame, header: Column, desc_offset: int = 0) -> DataFrame:
    """M3: below each anchor, the description column (anchor column +
    ``desc_offset``) next to the period column found by ``header`` on the
    anchor row: ``(file, sheet, row, description, value)``; a missing value
    cell gives NULL."""
    hdr = (
        cells.join(anchors, SHEET)
        .filter((F.col("row") == F.col("anchor_row")) & header)
        .groupBy(*SHEET)
        .agg(F.min("col").alias("value_col"))
    )
    a = anchors.join(hdr, SHEET)
    below = cells.join(a, SHEET).filter(F.col("row") > F.col("anchor_row"))
    is_desc, is_value = F.col("col") == F.col("anchor_col") + desc_offset, F.col("col") == F.col("value_col")
    both = [F.max(F.when(c, F.col("value"))).alias(n) for c, n in ((is_desc, "description"), (is_value, "value"))]
    return below.filter(is_desc | is_value).groupBy(*SHEET, "row").agg(*both).filter("description IS NOT NULL")


def promote_header(cells: DataFrame, header_row: int) -> DataFrame:
    """The header row's cell texts become column names, as a
    ``(file, sheet, col, name)`` table joined back to the cells below."""
    names = cells.filter(F.col("row") == header_row).select(*SHEET, "col", F.col("value").alias("name"))
    return cells.filter(F.col("row") > header_row).join(names, [*SHEET, "col"], "left")


# ---------------------------------------------------------------- M4
# Captions and labels of the statement sheets.
COMPANY_PREFIXES = [
    "ESTADOS SEPARADOS",
    "ESTADOS DE RESULTADOS SEPARADOS",
    "ESTADOS DE RESULTADOS CONSOLIDADO",
    "ESTADOS CONSOLIDADOS DE SITUACIÓN",
]
DROP_PREFIXES = ["Valores expresados en", "Cifras expresadas en"]
DROP_TOTALS = ["Total%", "TOTAL%", "IFRS Results"]
LABEL_REWRITES = [
    ("PASIVO MAS PATRIMONIO DE LOS ACCIONISTAS", "PASIVO"),
    ("Liabilities and Shareholders' Equity", "Liabilities"),
    ("SHAREHOLDERS' EQUITY", "EQUITY"),
    ("Patrimonio de los accionistas", "Patrimonio"),
    ("Total patrimonio de los accionistas", "Total Patrimonio"),
    ("TOTAL SHAREHOLDER'S EQUITY", "Total Equity"),
    (r"Assets \(BRL thousand\)", "Assets"),
]
KIND_WORDS = ["ACTIVO", "ASSETS", "PASIVO", "LIABILITIES", "PATRIMONIO", "EQUITY", "GROSS"]
TERM_WORDS = [
    "Activo corriente", "Activo no corriente", "Pasivo corriente", "Pasivo no corriente", "CURRENT", "NON-CURRENT",
    "CURRENT ASSETS", "NON-CURRENT ASSETS", "CURRENT LIABILITIES", "NON-CURRENT LIABILITIES",
]
TERM_RULES = [
    ("Assets", ["Current", "Current Assets"], "Activo Corriente"),
    ("Liabilities", ["Current", "Current Liabilities"], "Pasivo Corriente"),
    ("Assets", ["Non-current", "Non-current Assets"], "Activo No Corriente"),
    ("Liabilities", ["Non-current", "Non-current Liabilities"], "Pasivo No Corriente"),
]
DROP_CONTAINS = [
    "ACTIVO", "Activo corriente", "Activo no corriente", "PASIVO", "Pasivo corriente", "Pasivo no corriente",
    "Patrimonio", "Assets", "CURRENT",
]
KIND_REWRITES = [("Gross", "Utilidad"), ("Assets", "Activo"), ("Liabilities", "Pasivo"), ("Equity", "Patrimonio")]


def _not_like(col: str, pattern: str) -> Column:
    return ~F.col(col).like(pattern)


def _like_ne_true(col: str, pattern: str) -> Column:
    # ``like(..) != True``: NULL operands drop the row, as in the reference
    return F.col(col).like(pattern) != F.lit(True)


def parse_statements(rows: DataFrame, year: int, q: int, published: str, order: str = "row",
                     chunk: Chunk = None) -> DataFrame:
    """M4: sectioned income / balance statements -> tidy rows.

    ``rows``: ``(file, sheet, row, Descripcion, Valor)`` from :func:`slice_period`.
    Company sections start at a title row; inside a company the statement
    kind (``Activo``/``Pasivo``/``Patrimonio``/..., default ``Utilidad``) and
    the current / non-current term are forward-filled; titles, totals and
    captions are dropped; the title splits into ``state - company``."""
    rows, chunk = _in_ranges(rows, order, chunk)
    d = null_out(rows, ["Descripcion", "Valor"], ["nan"])
    is_company = F.lit(False)
    for p in COMPANY_PREFIXES:
        is_company = is_company | F.col("Descripcion").like(p + "%")
    d = d.withColumn("_company_title", is_company)
    titles = d.filter("_company_title").select(*SHEET, F.col("Descripcion").alias("_title")).distinct()
    keep = _not_like("Descripcion", DROP_PREFIXES[0] + "%") & _not_like("Descripcion", DROP_PREFIXES[1] + "%")
    for p in DROP_TOTALS:
        keep = keep & _like_ne_true("Descripcion", p)
    d = d.filter(keep)
    desc = F.col("Descripcion")
    for pat, rep in LABEL_REWRITES:
        desc = F.regexp_replace(desc, pat, rep)
    d = d.withColumn("Descripcion", desc)
    # a caption equal to any title text of the sheet is a company marker
    d = d.join(
        titles.select(*SHEET, F.col("_title").alias("Descripcion"), F.lit(True).alias("_is_title")),
        [*SHEET, "Descripcion"],
        "left",
    )
    d = d.withColumn("_marker", F.when(F.col("_is_title"), F.col("Descripcion")))
    d = ffill(d, "_marker", SHEET, [order], chunk, out="Empresa")
    d = d.filter(F.col("Empresa") != F.col("Descripcion"))
    d = d.withColumns(
        {
            "_kind": F.when(F.upper("Descripcion").isin(KIND_WORDS), F.initcap("Descripcion")),
            "_term": F.when(F.col("Descripcion").isin(TERM_WORDS), F.initcap("Descripcion")),
        }
    )
    # statement kind and current / non-current term, filled within a company
    d = ffill(d, ["_kind", "_term"], [*SHEET, "Empresa"], [order], chunk, out=["_kind_f", "_term_f"])
    d = d.withColumn("ValorContable", F.coalesce("_kind_f", F.lit("Utilidad")))
    d = d.withColumn(
        "TipoCorriente",
        F.when(F.col("ValorContable").isin("Activo", "Pasivo", "Assets", "Liabilities"), F.col("_term_f")).otherwise("N/A"),
    )
    term = F.col("TipoCorriente")
    for kind, terms, label in reversed(TERM_RULES):
        term = F.when((F.col("ValorContable") == kind) & F.col("TipoCorriente").isin(terms), F.lit(label)).otherwise(term)
    d = d.withColumn("TipoCorriente", term)
    keep = F.lit(True)
    for w in DROP_CONTAINS:
        keep = keep & _like_ne_true("Descripcion", f"%{w}%")
    keep = (
        keep
        & (F.upper("Descripcion") != F.upper("Empresa"))
        & (F.upper("Descripcion") != F.upper("ValorContable"))
        & _not_like("Descripcion", "%(BRL thousand)%")
        & _like_ne_true("Descripcion", "%EQUITY%")
    )
    d = d.filter(keep)
    kind = F.col("ValorContable")
    for pat, rep in KIND_REWRITES:
        kind = F.regexp_replace(kind, pat, rep)
    d = d.withColumn("ValorContable", kind)
    d = d.filter(F.col("_is_title").isNull())
    return d.select(
        F.trim(F.split("Empresa", "-").getItem(0)).alias("Estado"),
        split_part_or_null("Empresa", "-", 1).alias("Empresa"),
        "Descripcion",
        "ValorContable",
        "TipoCorriente",
        F.coalesce(F.col("Valor").try_cast("double"), F.lit(0.0)).alias("valor"),
        F.lit(str(year)).alias("Ano"),
        F.lit(str(q)).alias("Trimestre"),
        F.lit(published).cast("timestamp").alias("FECHA_PUBLICACION"),
    )


# ---------------------------------------------------------------- M5
# Captions left out of the investment sheet.
CAPEX_EXCLUDE = ["%Inversiones dentro balance%", "%Negocios que no consolidan%"]


def parse_capex(rows: DataFrame, year: int, q: int, published: str, order: str = "row",
                chunk: Chunk = None) -> DataFrame:
    """M5: ``(file, sheet, row, EMPRESA, Valor)`` -> ``PAIS, EMPRESA, Valor``:
    the row before each blank caption (block total) is dropped, a captioned
    row without value is a country header forward-filled onto the companies
    below it, excluded captions removed."""
    rows, chunk = _in_ranges(rows, order, chunk)
    d = drop_before_blank(rows, "EMPRESA", SHEET, [order], chunk).filter(F.col("EMPRESA").isNotNull())
    d = d.withColumn("_country", F.when(F.col("Valor").isNull(), F.col("EMPRESA")))
    d = ffill(d, "_country", SHEET, [order], chunk, out="PAIS").filter(F.col("Valor").isNotNull())
    for p in CAPEX_EXCLUDE:
        d = d.filter(~F.col("EMPRESA").like(p))
    return d.select(
        "PAIS", "EMPRESA", "Valor",
        F.lit(str(year)).alias("AnoEvaluado"), F.lit(str(q)).alias("trimestreEvaluado"),
        F.lit(published).cast("timestamp").alias("FECHA_PUBLICACION"),
    )


# ---------------------------------------------------------------- M6
# Footnote captions of the traffic sheet; separator class.
TRAFFIC_FOOTNOTES = [
    "*TMDE: Tráfico medio diario equivalente",
    "TMDE 2015- 2021 con base 365 días, excepto 2016 y 2020 los cuales están con base 366 días",
    "**TPD: Tráfico Promedio Diario",
]
TRAFFIC_SEPARATORS = "[-\\s\\t\\n\\r\\x0b\\x0c\\u00A0]+"
TRAFFIC_COMPANY = "(?i)(RUTA|TMDE|TPD)"


def parse_traffic(rows: DataFrame, year: int, q: int, published: str, order: str = "row",
                  chunk: Chunk = None) -> DataFrame:
    """M6: company rows (``RUTA``/``TMDE``/``TPD``) with type rows beneath;
    separators stripped; a captioned row without value gets ``'0'``."""
    d = rows
    for f in TRAFFIC_FOOTNOTES:
        d = d.filter(~F.col("Empresa").like(f))
    d = null_out(d, ["Empresa", "Valor"], ["nan"])
    d = d.withColumn("Empresa", F.regexp_replace("Empresa", TRAFFIC_SEPARATORS, ""))
    v2 = F.regexp_replace("Valor", TRAFFIC_SEPARATORS, "")
    d = d.withColumn("Valor", F.when(F.trim(v2) == "", F.lit(None)).otherwise(v2))
    d = d.withColumn(
        "Valor",
        F.when(F.col("Empresa").isNotNull() & (F.trim("Empresa") != "") & F.col("Valor").isNull(), F.lit("0")).otherwise(
            F.col("Valor")
        ),
    ).dropna(subset=["Empresa", "Valor"])
    d = d.withColumn("_is_company", F.col("Empresa").rlike(TRAFFIC_COMPANY))
    d = d.withColumn("_marker", F.when(F.col("_is_company"), F.col("Empresa")))
    d, chunk = _in_ranges(d, order, chunk)
    d = ffill(d, "_marker", SHEET, [order], chunk, out="Compania").filter(~F.col("_is_company"))
    return d.select(
        "Compania", F.col("Empresa").alias("Tipo"), "Valor",
        F.lit(str(year)).alias("Ano"), F.lit(str(q)).alias("Trimestre"),
        F.lit(published).alias("FECHAPUBLICACION"),
    )


# ---------------------------------------------------------------- M7
def parse_debt_profile(rows: DataFrame, year: int, q: int, published: str, order: str = "row",
                       chunk: Chunk = None) -> DataFrame:
    """M7: ``(file, sheet, row, Compania, Moneda, Valor, tint)``: a coloured
    row (``tint != 0``) names a country, which applies to itself and to the
    rows *before* it (backward fill); ``TOTAL DEUDA`` rows are dropped; a
    missing company takes the previous row's, one step only."""
    rows, chunk = _in_ranges(rows, order, chunk)
    d = null_out(rows, ["Compania", "Moneda", "Valor"], ["nan"])
    d = d.filter(~(F.col("Compania").isNull() & F.col("Moneda").isNull() & F.col("Valor").isNull()))
    d = d.withColumn("_c", F.when(F.col("tint") != 0, F.col("Compania")))
    d = bfill(d, "_c", SHEET, [order], chunk, out="_next_c")
    d = d.withColumn("Pais", F.when(F.col("tint") != 0, F.col("Compania")).otherwise(F.col("_next_c")))
    d = d.filter(F.col("Pais").isNotNull() & (F.col("Pais") != "TOTAL DEUDA"))
    from .fill import lag_fill

    d = lag_fill(d, "Compania", SHEET, [order], chunk)
    return d.select(
        "Pais", "Compania", "Moneda", F.col("Valor").try_cast("double").alias("Valor"),
        F.lit(str(year)).alias("Ano"), F.lit(str(q)).alias("trimestre"), F.lit(published).alias("FECHAPUBLICACION"),
    )


# ---------------------------------------------------------------- M9
QUARTER_MONTH = {1: "Marzo", 2: "Junio", 3: "Septiembre"}  # else Diciembre (B14)


def quarter_month(q: int) -> str:
    return QUARTER_MONTH.get(int(q), "Diciembre")


def parse_projects(df: DataFrame, year: int, q: int, published: str) -> DataFrame:
    """M9: report-year / report-month filter (renewals and the in-progress
    reinforcement line excluded -- the filter runs before ``'nan'`` becomes
    NULL, so a missing ``Tipo 1`` spelled ``'nan'`` is kept), energisation
    year and quarter, investment summed per (country, company, year,
    quarter, control type); the comment is the smallest one (deterministic
    ``first``)."""
    d = df.filter(
        (F.col("Ano reporte") == str(year))
        & (F.col("Mes reporte") == quarter_month(q))
        & (F.col("Tipo 1") != "Renovación")
        & (F.col("Nombre del proyecto") != "Proyectos de refuerzos en ejecución")
    )
    d = null_out(d, [c for c, t in d.dtypes if t == "string"], ["nan"])
    d = d.withColumn("_date", F.col("Fecha Energizacion RI").try_cast("date")).withColumn(
        "_usd", F.col("Inversion aprobada USD").try_cast("float")
    )
    g = d.groupBy(
        F.col("Pais"), F.col("Empresa").alias("Compania"), F.year("_date").alias("Ano"),
        F.quarter("_date").alias("Trimestre"), F.col("Tipo control").alias("TipoControl"),
    ).agg(F.sum("_usd").cast("float").alias("InversionAprobadaUSD"), F.min("Comentarios").alias("Comentarios"))
    return g.withColumn("FECHAPUBLICACION", F.lit(published).cast("timestamp"))


# ---------------------------------------------------------------- M11 - M13
def report_wide(existing: DataFrame, new: DataFrame, row_keys: Sequence[str], period: str, value: str,
                periods: Sequence[str]) -> DataFrame:
    """Place a period's values next to earlier periods -- the long
    table is upserted on ``(row keys, period)`` (new rows and companies are
    added, a re-run period replaces its values), then pivoted to one column
    per listed period."""
    from .upsert import upsert

    long = upsert(existing.select(*row_keys, period, value), new.select(*row_keys, period, value), [*row_keys, period],
                  check=False)
    return long.groupBy(*row_keys).pivot(period, list(periods)).agg(F.first(value, ignorenulls=True))


def project_report(df: DataFrame) -> DataFrame:
    """Hierarchical project list -- country > company > control type >
    project -- with a header flag on the first line of each group (countries
    and lines sorted on read).  The first line of each group is a ``min``
    aggregate per group (partial aggregation before the shuffle) joined back,
    so a country holding a third of the projects is not sorted in one task."""
    levels = {
        "country_header": (["Pais"], ["Compania", "TipoControl", "Proyecto"]),
        "company_header": (["Pais", "Compania"], ["TipoControl", "Proyecto"]),
        "control_header": (["Pais", "Compania", "TipoControl"], ["Proyecto"]),
    }
    out = df
    for flag, (keys, order) in levels.items():
        first = df.groupBy(*keys).agg(F.min(F.struct(*order)).alias(f"_{flag}"))
        out = out.join(first, keys, "left").withColumn(
            flag, F.coalesce(F.struct(*order) == F.col(f"_{flag}"), F.lit(False))
        ).drop(f"_{flag}")
    return out


def classify_indent(cells: DataFrame, order: str = "row", chunk: Chunk = None) -> DataFrame:
    """Rows of a block -- a row right after a blank caption is a country
    header; a row with indent 1 is a company; others are detail lines."""
    from .fill import _neighbour

    d, prev = _neighbour(cells, "value", SHEET, [order], chunk, -1)
    # a row has a previous row when it has one in its chunk or across a border
    has_prev = F.col("_nb").isNotNull() | (F.col("_carry").isNotNull() if chunk is not None else F.lit(False))
    d = d.withColumn("_prev_present", has_prev)
    kind = (
        F.when(F.col("value").isNull(), F.lit("blank"))
        .when(F.col("_prev_present") & prev.isNull(), F.lit("country"))
        .when(F.col("indent") == 1, F.lit("company"))
        .otherwise(F.lit("detail"))
    )
    out = d.withColumn("kind", kind).drop("_nb", "_prev_present", "_carry")
    return out.drop("_chunk") if "_chunk" in out.columns else out


# ---------------------------------------------------------------- B18, M8
# Footnote / total captions removed from the debt sheets.
DEBT_FOOTNOTES = [
    "(1) Bonos emitidos en PEN y se hizo un SWAP a USD con el Banco BBVA.",
    "(2) Bonos emitidos en USD y se hizo un SWAP a UF.",
    "(3) Opcion Call",
    "Bonos Verdes",
    "TOTAL BONOS",
]
# Header substrings that name the amount columns, and their new names.
DEBT_AMOUNT_HEADERS = [
    ("moneda del crédito", "MonedaDelCredito"),
    ("millones de COP", "MillonesDeCOP"),
    ("miles USD", "MilesUSD"),
]


def parse_header_period(names: Sequence[str]) -> tuple[dict[str, str], str | None, str | None]:
    """Rename amount columns found by substring and read the period
    (``Mes-Año``) from the first line of the currency header.  Works on the
    column names only (metadata), never on data."""
    rename: dict[str, str] = {}
    mes = ano = None
    for n in names:
        for sub, new in DEBT_AMOUNT_HEADERS:
            if sub in n:
                rename[n] = new
                if new == "MonedaDelCredito":
                    first = n.split("\n")[0]
                    parts = first.split("-")
                    mes, ano = parts[0], (parts[1] if len(parts) > 1 else None)
    return rename, mes, ano


def _to_iso_date(col: str) -> Column:
    return F.date_format(F.try_to_timestamp(F.col(col)), "yyyy-MM-dd")


def parse_debt(rows: DataFrame, kind: str, mes: str | None, ano: str | None, year: int, q: int, published: str,
               order: str = "row", chunk: Chunk = None) -> DataFrame:
    """M8: consolidated bonds (``kind='bonos'``) or loans (``'creditos'``).

    ``rows`` carries the sheet columns under their header names (amount
    columns already renamed by :func:`parse_header_period`).  Sentinels ->
    NULL, all-blank rows and footnote captions dropped (NULL captions kept),
    decimal casts (HALF_UP, bad text NULL), rate text assembled, and country
    (caption without type) and company (caption with type) forward-filled
    down the sheet; only typed rows remain."""
    data_cols = [c for c in rows.columns if c not in (*SHEET, order)]
    d = null_out(rows, [c for c, t in rows.dtypes if t == "string" and c in data_cols], ["nan", "NaT", "NaN"])
    d = d.dropna(how="all", subset=data_cols)
    d = d.filter(F.coalesce(~F.col("Filial").isin(DEBT_FOOTNOTES), F.lit(True)))
    pct = F.when(
        F.col("Unnamed: 9").isNotNull(),
        F.concat_ws(" ", F.round(F.col("Unnamed: 9").try_cast("double") * 100.0, 3).cast("string"), F.lit("%")),
    )
    d = d.withColumns(
        {
            "MesMoneda": F.lit(mes),
            "AnoMoneda": F.lit(ano),
            "FechaVencimiento": _to_iso_date("Fecha Vencimiento"),
            "PlazoAnos": F.col("Plazo Años").try_cast("decimal(10,2)"),
            "MonedaDelCredito": F.col("MonedaDelCredito").try_cast("decimal(20,0)"),
            "MillonesDeCOP": F.col("MillonesDeCOP").try_cast("decimal(10,0)"),
            "MilesUSD": F.col("MilesUSD").try_cast("decimal(10,0)"),
            "TasaDeInteres": F.concat_ws(" ", F.col("Tasa de Interés"), F.col("Unnamed: 8"), pct),
        }
    )
    if kind == "bonos":
        d = d.withColumn("FechaEmision", _to_iso_date("Fecha Emisión"))
    else:
        d = d.withColumn("FechaEmision", _to_iso_date("Fecha Inicial")).withColumn(
            "Tipo", F.when(F.col("Fuente de Financiación").isNotNull(), F.lit("Creditos"))
        )
    d = d.filter(~((F.col("Filial") == " ") & (F.col("Tipo") == " ")))
    d = d.withColumns(
        {
            "_pais": F.when(F.col("Filial").isNotNull() & F.col("Tipo").isNull(), F.col("Filial")),
            "_comp": F.when(F.col("Filial").isNotNull() & F.col("Tipo").isNotNull(), F.col("Filial")),
        }
    )
    d, chunk = _in_ranges(d, order, chunk)
    d = ffill(d, ["_pais", "_comp"], SHEET, [order], chunk, out=["Pais", "Compania"])
    d = d.filter(F.col("Tipo").isNotNull())
    return d.select(
        "Compania", "Pais", "Tipo", F.col("Fuente de Financiación").alias("FuentedeFinanciacion"),
        F.col("Moneda Crédito").alias("MonedaCredito"), "FechaEmision", "FechaVencimiento", "PlazoAnos", "TasaDeInteres",
        "AnoMoneda", "MesMoneda", "MonedaDelCredito", "MillonesDeCOP", "MilesUSD",
        F.lit(str(year)).alias("AnoEvaluado"), F.lit(str(q)).alias("trimestreEvaluado"),
        F.lit(published).cast("timestamp").alias("FECHAPUBLICACION"),
    )


# ---------------------------------------------------------------- M10
# Footnote captions removed from the legacy loan sheet.
LEGACY_FOOTNOTES = [
    "(1) Bonos emitidos en PEN y se hizo un SWAP a USD con el Banco BBVA.",
    "(2) Bonos emitidos en USD y se hizo un SWAP a UF.",
    "(3) Opcion Call",
    "Bonos Verdes",
]


def legacy_name(name: str) -> str:
    """B17 as in the legacy loan sheet: NFD, newlines and spaces removed,
    only ``[A-Za-z0-9_]`` kept, combining marks dropped."""
    import re

    s = unicodedata.normalize("NFD", name).replace("\n", "").replace(" ", "")
    s = re.sub(r"[^A-Za-z0-9_]", "", s)
    return "".join(ch for ch in s if not unicodedata.combining(ch))


def parse_loans_legacy(cells: DataFrame, names: Sequence[str], published: str, order: str = "row",
                       chunk: Chunk = None) -> DataFrame:
    """Legacy loan sheet from its cell table.  The first row holds the
    headers (B16); ``names`` are those header texts in column order (sheet
    metadata).  Cells are pivoted to one row per sheet row with the listed
    names (no extra distinct pass), repeated header rows and all-blank rows
    dropped, names cleaned (B17), serial day numbers turned into dates
    (H16), amounts cast to decimals, country / company forward-filled."""
    from ..functions.dates import serial_date

    header_row = cells.groupBy(*SHEET).agg(F.min(order).alias("_h"))
    body = cells.join(header_row, SHEET).filter(F.col(order) > F.col("_h")).drop("_h")
    wide = body.groupBy(*SHEET, order).pivot("col", list(range(1, len(names) + 1))).agg(F.first("value"))
    clean = [legacy_name(n) for n in names]
    wide = wide.toDF(*SHEET, order, *clean)
    d = wide.filter(F.coalesce(F.col("Filial") != "Filial", F.lit(True))).dropna(how="all", subset=clean)
    d = d.filter(F.coalesce(~F.col("Filial").isin(LEGACY_FOOTNOTES), F.lit(True)))
    amounts = {c: (F.col(c).try_cast("decimal(20,0)") if c.endswith("monedadelcredito") else F.col(c).try_cast("decimal(10,0)"))
               for c in clean if c.endswith(("monedadelcredito", "millonesdeCOP", "milesUSD"))}
    d = d.withColumns(
        {
            "FechaInicial": F.when(F.col("FechaInicial").isNotNull(), serial_date("FechaInicial")),
            "FechaVencimiento": F.when(F.col("FechaVencimiento").isNotNull(), serial_date("FechaVencimiento")),
            "PlazoAnos": F.col("PlazoAnos").try_cast("int"),
            **amounts,
        }
    )
    d = d.withColumns(
        {
            "_pais": F.when(F.col("Filial").isNotNull() & F.col("FuentedeFinanciacion").isNull(), F.col("Filial")),
            "_comp": F.when(F.col("Filial").isNotNull() & F.col("FuentedeFinanciacion").isNotNull(), F.col("Filial")),
        }
    )
    d, chunk = _in_ranges(d, order, chunk)
    d = ffill(d, ["_pais", "_comp"], SHEET, [order], chunk, out=["Pais", "Compania"])
    d = d.filter(F.col("FuentedeFinanciacion").isNotNull())
    keep = ["Compania", "Pais", "FuentedeFinanciacion", "MonedaCredito", "FechaInicial", "FechaVencimiento", "PlazoAnos",
            "TasadeInteres", *amounts]
    return d.select(*[c for c in keep if c in d.columns], F.lit(published).cast("timestamp").alias("FECHAPUBLICACION"))
