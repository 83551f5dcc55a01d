"""String column functions (JVM-side expressions unless stated)."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


@lru_cache(maxsize=1)
def _accent_table() -> tuple[str, str]:
    """Marked letters -> base letter, built by rule from Unicode data: every code
    point whose canonical decomposition (NFD) minus non-spacing marks (category
    Mn) is one other character."""
    src, dst = [], []
    for cp in range(0x00C0, 0x30000):
        ch = chr(cp)
        if not unicodedata.decomposition(ch) or unicodedata.decomposition(ch).startswith("<"):
            continue
        base = "".join(c for c in unicodedata.normalize("NFD", ch) if unicodedata.category(c) != "Mn")
        if base != ch and len(base) == 1:
            src.append(ch)
            dst.append(base)
    return "".join(src), "".join(dst)


def normalize_text(col: Column | str) -> Column:
    """Strip diacritics and lower-case (NFD, drop non-spacing marks, lower) as JVM
    expressions: ``translate`` over the table above, then marks that stand
    alone are dropped.  Hangul syllables, which decompose into several
    letters, stay composed."""
    src, dst = _accent_table()
    return F.lower(F.regexp_replace(F.translate(_c(col), src, dst), "\\p{Mn}+", ""))


def text_equals_ci_ai(col: Column | str, literal: str) -> Column:
    """Accent- and case-insensitive equality without a UDF (ICU collation):
    the comparison used where the reference normalises both sides first."""
    return F.collate(_c(col), "UNICODE_CI_AI") == F.lit(literal)


def standardize_phone(col: Column | str) -> Column:
    """Keep Unicode decimal digits, take the first 14, lay out as
    ``(ddd)-ddd-ddd-rest``.  NULL stays NULL; no digits gives ``()---``."""
    d = F.substring(F.regexp_replace(_c(col), r"[^\p{Nd}]", ""), 1, 14)
    out = F.concat(
        F.lit("("), F.substring(d, 1, 3), F.lit(")-"), F.substring(d, 4, 3), F.lit("-"),
        F.substring(d, 7, 3), F.lit("-"), F.substring(d, 10, 5),
    )
    return F.when(_c(col).isNull(), F.lit(None).cast("string")).otherwise(out)


def split_part_or_null(col: Column | str, sep: str, index: int) -> Column:
    """``trim(split(c, sep)[index])`` that yields NULL (not an error) when the
    part is missing (0-based index)."""
    return F.trim(F.get(F.split(_c(col), sep), index))


def base_name(col: Column | str) -> Column:
    """Last path component; a trailing slash is ignored (folder names)."""
    return F.element_at(F.split(F.regexp_replace(_c(col), "/$", ""), "/"), -1)


def percent_text(col: Column | str, digits: int = 3) -> Column:
    """Rate rendered as text: ``round(x*100, digits) %``."""
    return F.concat_ws(" ", F.round(_c(col) * 100, digits).cast("string"), F.lit("%"))
