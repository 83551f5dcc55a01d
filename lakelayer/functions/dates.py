"""Date / time column functions.  Parsing never raises (``try_*``) because the
inputs are raw text and a bad value must become NULL, not fail the job."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Default timestamp pattern of the raw files, spreadsheet serial-day epoch.
RAW_TS_FORMAT = "MM-dd-yyyy HH:mm:ss"
SERIAL_EPOCH = "1899-12-30"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_ts(col: Column | str, fmt: str = RAW_TS_FORMAT) -> Column:
    return F.try_to_timestamp(_c(col), F.lit(fmt))


def days_since(col: Column | str, as_of: str | dt.date | Column) -> Column:
    """Whole days from ``col`` to ``as_of`` (a parameter, never the wall clock)."""
    ref = as_of if isinstance(as_of, Column) else F.to_date(F.lit(str(as_of)))
    return F.datediff(ref, _c(col))


def serial_date(col: Column | str) -> Column:
    """Spreadsheet serial day number -> date."""
    return F.date_add(F.to_date(F.lit(SERIAL_EPOCH)), _c(col).try_cast("int"))


# Quarter -> closing month name of the report period.
QUARTER_END_MONTH = {1: "Marzo", 2: "Junio", 3: "Septiembre", 4: "Diciembre"}


def quarter_end_month(q: int) -> str:
    return QUARTER_END_MONTH.get(int(q), "Diciembre")


def epoch_seconds(col: Column | str) -> Column:
    """Whole seconds since the epoch for TIMESTAMP and TIMESTAMP_NTZ columns
    (an NTZ value is read as UTC wall time; the session zone is UTC)."""
    return F.unix_seconds(_c(col).cast("timestamp"))


def with_constants(df, year: int, quarter: int, published: str):
    """Evaluated year / quarter and publish time as literal columns."""
    return df.withColumns(
        {"Ano": F.lit(str(year)), "Trimestre": F.lit(str(quarter)), "FECHAPUBLICACION": F.lit(published).cast("timestamp")}
    )
