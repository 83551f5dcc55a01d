"""Report parsers on hand-made sheets (FIXTURES.md edge rows)."""

from pyspark.sql import functions as F

from lakelayer.operators.reports import (
    cells_from_rows,
    find_anchor,
    parse_capex,
    parse_debt_profile,
    parse_projects,
    parse_statements,
    parse_traffic,
    period_header,
    slice_period,
)

PUB = "2024-01-31 00:00:00"


def test_anchor_and_period_slice(spark):
    grid = spark.createDataFrame(
        [
            ("f", "s", 1, "nota", None, None),
            ("f", "s", 2, "Estados de Resultados - X", "2Q24", "3T24"),
            ("f", "s", 3, "Ingresos", "1", "2"),
            ("f", "s", 4, "Costos", "3", None),
        ],
        "file string, sheet string, row int, a string, b string, c string",
    )
    cells = cells_from_rows(grid, "file", "sheet", "row", ["a", "b", "c"])
    anc = find_anchor(cells, F.lower("value").contains("estados de resultados"))
    assert [tuple(r) for r in anc.collect()] == [("f", "s", 2, 1)]
    out = slice_period(cells, anc, period_header(2024, 3)).orderBy("row").collect()
    assert [(r.description, r.value) for r in out] == [("Ingresos", "2"), ("Costos", None)]


def test_parse_statements(spark):
    lines = [
        "Nota previa",
        "ESTADOS CONSOLIDADOS DE SITUACIÓN FINANCIERA - Colombia - ACME",
        "Cifras expresadas en millones",
        "ACTIVO",
        "Activo corriente",
        "Caja",
        "Total activo corriente",
        "PASIVO",
        "Pasivo no corriente",
        "Bonos",
        "ESTADOS DE RESULTADOS CONSOLIDADO - Chile - BETA",
        "Ingresos",
        "Otros",
        None,
    ]
    vals = [None, None, None, None, None, "10", "10", None, None, "nan", None, "5.5", "x", "1"]
    df = spark.createDataFrame(
        [("f", "s", i, d, v) for i, (d, v) in enumerate(zip(lines, vals))],
        "file string, sheet string, row int, Descripcion string, Valor string",
    )
    out = parse_statements(df, 2024, 3, PUB).orderBy("Estado", "Descripcion").collect()
    got = [(r.Estado, r.Empresa, r.Descripcion, r.ValorContable, r.TipoCorriente, r.valor) for r in out]
    assert got == [
        ("ESTADOS CONSOLIDADOS DE SITUACIÓN FINANCIERA", "Colombia", "Bonos", "Pasivo", "Pasivo No Corriente", 0.0),
        ("ESTADOS CONSOLIDADOS DE SITUACIÓN FINANCIERA", "Colombia", "Caja", "Activo", "Activo Corriente", 10.0),
        ("ESTADOS DE RESULTADOS CONSOLIDADO", "Chile", "Ingresos", "Utilidad", "N/A", 5.5),
        ("ESTADOS DE RESULTADOS CONSOLIDADO", "Chile", "Otros", "Utilidad", "N/A", 0.0),
    ]


def test_parse_capex(spark):
    data = [
        ("COLOMBIA", None), ("Empresa A", "1"), ("Inversiones dentro balance", "2"), ("Total Colombia", "3"), (None, None),
        ("PERU", None), ("Empresa B", "4"), ("Empresa C", "5"),
    ]
    df = spark.createDataFrame([("f", "s", i, e, v) for i, (e, v) in enumerate(data)],
                               "file string, sheet string, row int, EMPRESA string, Valor string")
    got = [(r.PAIS, r.EMPRESA, r.Valor) for r in parse_capex(df, 2024, 3, PUB).orderBy("EMPRESA").collect()]
    assert got == [("COLOMBIA", "Empresa A", "1"), ("PERU", "Empresa B", "4")]


def test_parse_traffic(spark):
    data = [
        ("RUTA 1", "nan"), ("Livianos", "1 200"), ("Pesados", " "), ("TPD Norte", None), ("Buses", "7"),
        ("**TPD: Tráfico Promedio Diario", None), (None, "9"),
    ]
    df = spark.createDataFrame([("f", "s", i, e, v) for i, (e, v) in enumerate(data)],
                               "file string, sheet string, row int, Empresa string, Valor string")
    got = [(r.Compania, r.Tipo, r.Valor) for r in parse_traffic(df, 2024, 3, PUB).orderBy("Tipo").collect()]
    assert got == [("TPDNorte", "Buses", "7"), ("RUTA1", "Livianos", "1200"), ("RUTA1", "Pesados", "0")]


def test_parse_debt_profile(spark):
    data = [
        ("Emp A", "USD", "1", 0.0), (None, "COP", "2", 0.0), ("COLOMBIA", None, None, -0.25),
        (None, None, None, 0.0), ("Emp B", "USD", "3", 0.0), ("TOTAL DEUDA", None, "6", -0.5),
    ]
    df = spark.createDataFrame([("f", "s", i, *r) for i, r in enumerate(data)],
                               "file string, sheet string, row int, Compania string, Moneda string, Valor string, tint double")
    got = [(r.Pais, r.Compania, r.Moneda, r.Valor) for r in parse_debt_profile(df, 2024, 3, PUB).orderBy("Valor").collect()]
    assert got == [("COLOMBIA", "COLOMBIA", None, None), ("COLOMBIA", "Emp A", "USD", 1.0), ("COLOMBIA", "Emp A", "COP", 2.0)]


def test_parse_projects(spark):
    cols = ["Pais", "Empresa", "Ano reporte", "Mes reporte", "Tipo 1", "Nombre del proyecto", "Fecha Energizacion RI",
            "Inversion aprobada USD", "Tipo control", "Comentarios"]
    data = [
        ("CO", "E1", "2024", "Septiembre", "Nuevo", "P1", "2025-02-01", "10", "C", "b"),
        ("CO", "E1", "2024", "Septiembre", "nan", "P2", "2025-03-01", "5", "C", "a"),
        ("CO", "E1", "2024", "Septiembre", "Renovación", "P3", "2025-03-01", "99", "C", "z"),
        ("CO", "E1", "2024", "Junio", "Nuevo", "P4", "2025-03-01", "99", "C", "z"),
        ("CO", "E2", "2024", "Septiembre", "Nuevo", "P5", "nan", "1", "C", "c"),
    ]
    df = spark.createDataFrame(data, ", ".join(f"`{c}` string" for c in cols))
    got = [(r.Compania, r.Ano, r.Trimestre, r.InversionAprobadaUSD, r.Comentarios)
           for r in parse_projects(df, 2024, 3, PUB).orderBy("Compania").collect()]
    assert got == [("E1", 2025, 1, 15.0, "a"), ("E2", None, None, 1.0, "c")]


def test_parse_debt_bonds(spark):
    from decimal import Decimal

    from lakelayer.operators.reports import parse_debt, parse_header_period

    cols = ["Filial", "Tipo", "Fuente de Financiación", "Moneda Crédito", "Fecha Emisión", "Fecha Vencimiento",
            "Plazo Años", "Tasa de Interés", "Unnamed: 8", "Unnamed: 9", "Jun-2024\n(moneda del crédito)",
            "Jun-2024\n(millones de COP)", "Jun-2024\n(miles USD)"]
    n = [None] * 12
    data = [
        ("COLOMBIA", *n),
        ("Filial A", "Bonos", "Mercado", "COP", "2020-01-15 00:00:00", "2030-01-15 00:00:00", "10.005", "IPC", "+",
         "0.0525", "1000.5", "2.5", "99999999999"),
        (None, "Bonos", "Mercado", "USD", "NaT", "nan", "nan", "Fija", None, "nan", "7", "8", "9"),
        ("TOTAL BONOS", *n),
        ("(3) Opcion Call", *n),
        tuple([None] * 13),
    ]
    df = spark.createDataFrame([("f", "Bonos", i, *r) for i, r in enumerate(data)],
                               "file string, sheet string, row int, " + ", ".join(f"`{c}` string" for c in cols))
    rename, mes, ano = parse_header_period(df.columns)
    assert (mes, ano) == ("Jun", "2024")
    out = parse_debt(df.withColumnsRenamed(rename), "bonos", mes, ano, 2024, 2, PUB).orderBy("MonedaCredito").collect()
    assert [(r.Pais, r.Compania, r.MonedaCredito) for r in out] == [("COLOMBIA", "Filial A", "COP"), ("COLOMBIA", "Filial A", "USD")]
    a, b = out
    assert a.PlazoAnos == Decimal("10.01") and a.MonedaDelCredito == Decimal("1001") and a.MillonesDeCOP == Decimal("3")
    assert a.MilesUSD is None  # overflow of decimal(10,0) -> NULL
    assert a.TasaDeInteres == "IPC + 5.25 %" and b.TasaDeInteres == "Fija"
    assert a.FechaEmision == "2020-01-15" and b.FechaVencimiento is None


def test_parse_loans_legacy(spark):
    from lakelayer.operators.reports import cells_from_rows, parse_loans_legacy

    names = ["Filial", "Fuente de\nFinanciación", "Fecha Inicial", "Fecha Vencimiento", "Plazo Años", "Jun 2024\n(miles USD)"]
    grid = [
        (1, *names),
        (2, "PERU", None, None, None, None, None),
        (3, "Filial B", "Banco", "45473", "45838", "1", "12.5"),
        (4, None, "Banco 2", "45000", None, "x", "3"),
        (5, "Filial", None, None, None, None, None),
        (6, "Bonos Verdes", None, None, None, None, None),
    ]
    df = spark.createDataFrame([("f", "s", *g) for g in grid],
                               "file string, sheet string, row int, a string, b string, c string, d string, e string, g string")
    cells = cells_from_rows(df, "file", "sheet", "row", ["a", "b", "c", "d", "e", "g"])
    out = parse_loans_legacy(cells, names, PUB).orderBy("FuentedeFinanciacion").collect()
    got = [(r.Pais, r.Compania, r.FuentedeFinanciacion, str(r.FechaInicial), r.PlazoAnos) for r in out]
    assert got == [("PERU", "Filial B", "Banco", "2024-06-30", 1), ("PERU", "Filial B", "Banco 2", "2023-03-15", None)]
