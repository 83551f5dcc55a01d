"""Cleaning queries (survey B, E1, J1-J2, D3, L5) over the test tables.

Each query derives its input from a test table so that its work grows with
the table; NULL keys are injected on a fixed rule where a NULL rule is tested.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import normalize_text, split_part_or_null, standardize_phone
from ..operators.clean import (
    drop_literals_keep_null,
    expand_code,
    keep_first,
    null_out,
    null_report,
    StepCounts,
    recode,
    two_level_counts,
)
from ..sources.tables import Tables
from .registry import register

# US state code -> state name lookup of the customer cleaning step.
US_STATES = {
    "AL": "Alabama", "AK": "Alaska", "AZ": "Arizona", "AR": "Arkansas", "CA": "California",
    "CO": "Colorado", "CT": "Connecticut", "DE": "Delaware", "FL": "Florida", "GA": "Georgia",
    "HI": "Hawaii", "ID": "Idaho", "IL": "Illinois", "IN": "Indiana", "IA": "Iowa",
    "KS": "Kansas", "KY": "Kentucky", "LA": "Louisiana", "ME": "Maine", "MD": "Maryland",
    "MA": "Massachusetts", "MI": "Michigan", "MN": "Minnesota", "MS": "Mississippi", "MO": "Missouri",
    "MT": "Montana", "NE": "Nebraska", "NV": "Nevada", "NH": "New Hampshire", "NJ": "New Jersey",
    "NM": "New Mexico", "NY": "New York", "NC": "North Carolina", "ND": "North Dakota", "OH": "Ohio",
    "OK": "Oklahoma", "OR": "Oregon", "PA": "Pennsylvania", "RI": "Rhode Island", "SC": "South Carolina",
    "SD": "South Dakota", "TN": "Tennessee", "TX": "Texas", "UT": "Utah", "VT": "Vermont",
    "VA": "Virginia", "WA": "Washington", "WV": "West Virginia", "WI": "Wisconsin", "WY": "Wyoming",
}

LINEITEM_COLS = (
    "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax "
    "l_returnflag l_linestatus l_shipdate"
).split()


@register(
    "customer_dedup",
    """
SELECT * FROM lineitem
QUALIFY row_number() OVER (
  PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_partkey ASC NULLS FIRST, l_suppkey ASC NULLS FIRST, l_extendedprice DESC NULLS LAST,
           l_quantity ASC NULLS FIRST, l_discount ASC NULLS FIRST, l_tax ASC NULLS FIRST,
           l_returnflag ASC NULLS FIRST, l_linestatus ASC NULLS FIRST, l_shipdate ASC NULLS FIRST) = 1
""",
)
def q_customer_dedup(spark, sf_dir):
    """Keep the first row per business key by ordered tie-breakers."""
    order = [("l_partkey", True), ("l_suppkey", True), ("l_extendedprice", False)]
    order += [(c, True) for c in ("l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")]
    return keep_first(Tables(spark, sf_dir).lineitem, ["l_orderkey", "l_linenumber"], order)


@register(
    "keep_first_text_desc",
    """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
QUALIFY row_number() OVER (
  PARTITION BY c_nationkey
  ORDER BY c_mktsegment ASC NULLS FIRST, c_name DESC NULLS LAST, c_custkey ASC NULLS FIRST) = 1
""",
)
def q_keep_first_text_desc(spark, sf_dir):
    """E1 with a descending text key (the email/last-name/first-name-desc
    rule): salted two-level row_number path."""
    order = [("c_mktsegment", True), ("c_name", False), ("c_custkey", True)]
    return keep_first(Tables(spark, sf_dir).customer, ["c_nationkey"], order)


PHONE_SQL_RAW = """
CASE WHEN c_custkey % 50 = 0 THEN NULL
     WHEN c_custkey % 50 = 1 THEN ''
     WHEN c_custkey % 50 = 2 THEN 'n/a'
     ELSE '+' || CAST(c_nationkey AS VARCHAR) || ' (' || CAST(c_custkey AS VARCHAR) || ') ' || c_name END
"""


def _phone_raw(c):
    return (
        F.when(F.col("c_custkey") % 50 == 0, F.lit(None).cast("string"))
        .when(F.col("c_custkey") % 50 == 1, F.lit(""))
        .when(F.col("c_custkey") % 50 == 2, F.lit("n/a"))
        .otherwise(F.concat(F.lit("+"), F.col("c_nationkey"), F.lit(" ("), F.col("c_custkey"), F.lit(") "), F.col("c_name")))
    )


@register(
    "standardize_phone",
    f"""
WITH r AS (SELECT c_custkey, {PHONE_SQL_RAW} AS phone_raw FROM customer),
d AS (SELECT c_custkey, phone_raw, substr(regexp_replace(phone_raw, '[^\\p{{Nd}}]', '', 'g'), 1, 14) AS dg FROM r)
SELECT c_custkey, phone_raw,
       CASE WHEN phone_raw IS NULL THEN NULL
            ELSE '(' || substr(dg, 1, 3) || ')-' || substr(dg, 4, 3) || '-' || substr(dg, 7, 3) || '-' || substr(dg, 10, 5) END
         AS phone_number
FROM d
""",
)
def q_standardize_phone(spark, sf_dir):
    """Phone laid out as ``(ddd)-ddd-ddd-rest`` from its first 14 digits."""
    c = Tables(spark, sf_dir).customer.select("c_custkey", _phone_raw(None).alias("phone_raw"))
    return c.withColumn("phone_number", standardize_phone("phone_raw"))


@register(
    "recode_segment",
    """
SELECT c_custkey, c_mktsegment,
       CASE WHEN c_mktsegment = 'BUILDING' THEN TRUE WHEN c_mktsegment = 'MACHINERY' THEN FALSE ELSE NULL END
         AS is_building,
       upper(substr(c_name, 1, 4)) || lower(substr(c_name, 5)) AS name_case
FROM customer
""",
)
def q_recode_segment(spark, sf_dir):
    """B10 + H1: two-value text -> boolean, anything else NULL."""
    c = Tables(spark, sf_dir).customer.select("c_custkey", "c_mktsegment", "c_name")
    out = recode(c, "c_mktsegment", {"BUILDING": True, "MACHINERY": False}, out="is_building")
    out = out.withColumn(
        "name_case", F.concat(F.upper(F.substring("c_name", 1, 4)), F.lower(F.expr("substring(c_name, 5)")))
    )
    return out.drop("c_name")


_STATE_KEYS = list(US_STATES)
# Codes assigned to customers: every listed code plus spellings the rule must
# keep (full name, unknown code) or turn to NULL (lower-case code).
_STATE_CHOICES = _STATE_KEYS + ["ca", "DC", "California", "Puerto Rico"]


def _state_sql():
    arr = ", ".join(f"'{s}'" for s in _STATE_CHOICES)
    return f"CASE WHEN c_custkey % 97 = 0 THEN NULL ELSE [{arr}][CAST(c_custkey % {len(_STATE_CHOICES)} AS INTEGER) + 1] END"


def _map_sql():
    keys = ", ".join(f"'{k}'" for k in US_STATES)
    vals = ", ".join(f"'{v}'" for v in US_STATES.values())
    return f"MAP([{keys}], [{vals}])"


@register(
    "expand_code",
    f"""
WITH s AS (SELECT c_custkey, {_state_sql()} AS state_raw FROM customer)
SELECT c_custkey, state_raw,
       CASE WHEN length(state_raw) = 2 THEN {_map_sql()}[state_raw] ELSE state_raw END AS state
FROM s
""",
)
def q_expand_code(spark, sf_dir):
    """Two-letter state code -> name via a map literal."""
    choices = F.array(*[F.lit(s) for s in _STATE_CHOICES])
    raw = F.when(F.col("c_custkey") % 97 == 0, F.lit(None).cast("string")).otherwise(
        F.element_at(choices, (F.col("c_custkey") % len(_STATE_CHOICES)).cast("int") + 1)
    )
    c = Tables(spark, sf_dir).customer.select("c_custkey", raw.alias("state_raw"))
    return expand_code(c, "state_raw", US_STATES, out="state")


@register(
    "two_level_counts",
    """
WITH s AS (
  SELECT c.c_custkey, CASE WHEN c.c_custkey % 50 = 0 THEN NULL ELSE n.n_name END AS country, c.c_mktsegment AS state
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey),
a AS (SELECT country, CAST(count(c_custkey) AS BIGINT) AS customer_count_country FROM s GROUP BY country),
b AS (SELECT country, state, CAST(count(c_custkey) AS BIGINT) AS customer_count_country_state FROM s GROUP BY country, state)
SELECT a.country AS country, customer_count_country, state, customer_count_country_state
FROM a JOIN b ON a.country = b.country
UNION ALL SELECT NULL, customer_count_country, NULL, NULL FROM a WHERE country IS NULL
UNION ALL SELECT NULL, NULL, state, customer_count_country_state FROM b WHERE country IS NULL
""",
)
def q_two_level_counts(spark, sf_dir):
    """Customers per country and per (country, segment) on one row."""
    t = Tables(spark, sf_dir)
    s = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey",
        F.when(F.col("c_custkey") % 50 == 0, F.lit(None)).otherwise(F.col("n_name")).alias("country"),
        F.col("c_mktsegment").alias("state"),
    )
    return two_level_counts(s, "country", "state", "c_custkey")


PART_NAME_SQL = "CASE WHEN p_partkey % 40 = 0 THEN NULL WHEN p_partkey % 40 = 1 THEN 'nan' WHEN p_partkey % 40 = 2 THEN 'NaN' ELSE p_name END"


@register(
    "drop_footnotes_keep_null",
    f"""
WITH p AS (SELECT p_partkey, {PART_NAME_SQL} AS p_name, p_type FROM part)
SELECT p_partkey, CASE WHEN p_name IN ('nan', 'NaN', 'NaT') THEN NULL ELSE p_name END AS p_name, p_type
FROM p WHERE p_name IS NULL OR p_name NOT IN ('small ring', 'blue bolt', 'Total')
""",
)
def q_drop_footnotes(spark, sf_dir):
    """B7 then B8: drop footnote/total captions but keep NULL captions, then
    sentinel spellings -> NULL (the order matters: 'nan' survives the drop)."""
    p = Tables(spark, sf_dir).part
    name = (
        F.when(F.col("p_partkey") % 40 == 0, F.lit(None).cast("string"))
        .when(F.col("p_partkey") % 40 == 1, F.lit("nan"))
        .when(F.col("p_partkey") % 40 == 2, F.lit("NaN"))
        .otherwise(F.col("p_name"))
    )
    p = p.select("p_partkey", name.alias("p_name"), "p_type")
    p = drop_literals_keep_null(p, "p_name", ["small ring", "blue bolt", "Total"])
    return null_out(p, ["p_name"])


@register(
    "null_report",
    f"""
WITH c AS (
  SELECT CASE WHEN c.c_custkey % 50 = 0 THEN NULL ELSE n.n_name END AS country,
         CASE WHEN c_mktsegment = 'BUILDING' THEN TRUE WHEN c_mktsegment = 'MACHINERY' THEN FALSE END AS is_building,
         {PHONE_SQL_RAW} AS phone_raw
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey)
SELECT 'country' AS column_name, CAST(count(*) FILTER (WHERE country IS NULL) AS BIGINT) AS null_count FROM c
UNION ALL SELECT 'is_building', CAST(count(*) FILTER (WHERE is_building IS NULL) AS BIGINT) FROM c
UNION ALL SELECT 'phone_raw', CAST(count(*) FILTER (WHERE phone_raw IS NULL) AS BIGINT) FROM c
""",
)
def q_null_report(spark, sf_dir):
    """NULL / unmapped counts after recoding, one pass."""
    t = Tables(spark, sf_dir)
    c = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        F.when(F.col("c_custkey") % 50 == 0, F.lit(None)).otherwise(F.col("n_name")).alias("country"),
        "c_mktsegment",
        _phone_raw(None).alias("phone_raw"),
    )
    c = recode(c, "c_mktsegment", {"BUILDING": True, "MACHINERY": False}, out="is_building")
    return null_report(c, ["country", "is_building", "phone_raw"])


@register(
    "normalize_text",
    """
SELECT doc_id, lang, strip_accents(lower(text)) AS text_norm FROM documents
""",
)
def q_normalize_text(spark, sf_dir):
    """Accent strip + lower over whole documents, JVM-side translate."""
    d = Tables(spark, sf_dir).documents
    return d.select("doc_id", "lang", normalize_text("text").alias("text_norm"))


@register(
    "pattern_filters",
    """
SELECT p_partkey, p_name, p_brand, p_type,
       trim(string_split(p_name, ' ')[1]) AS name_part0,
       trim(string_split(p_name, ' ')[3]) AS name_part2
FROM part
WHERE (p_type LIKE 'E%' AND p_name NOT LIKE '%bolt%') OR regexp_matches(p_brand, '(?i)^brand#1[0-9]$')
""",
)
def q_pattern_filters(spark, sf_dir):
    """B5/B6 + H3: like / not like / case-insensitive rlike filters and
    NULL-safe split parts (a missing part is NULL, not an error)."""
    p = Tables(spark, sf_dir).part.select("p_partkey", "p_name", "p_brand", "p_type")
    cond = (F.col("p_type").like("E%") & ~F.col("p_name").like("%bolt%")) | F.col("p_brand").rlike("(?i)^brand#1[0-9]$")
    return p.filter(cond).withColumns(
        {"name_part0": split_part_or_null("p_name", " ", 0), "name_part2": split_part_or_null("p_name", " ", 2)}
    )


@register(
    "step_counts",
    """
WITH raw AS (SELECT c_custkey, c_name, c_mktsegment FROM customer
             UNION ALL SELECT c_custkey, c_name, c_mktsegment FROM customer
             UNION ALL SELECT CASE WHEN c_custkey % 50 = 0 THEN NULL ELSE c_custkey END, c_name, c_mktsegment FROM customer),
nn AS (SELECT * FROM raw WHERE c_custkey IS NOT NULL),
dd AS (SELECT DISTINCT c_custkey FROM nn)
SELECT 'raw' AS step, count(*) AS rows FROM raw
UNION ALL SELECT 'not_null_key', count(*) FROM nn
UNION ALL SELECT 'deduplicated', count(*) FROM dd
""",
)
def q_step_counts(spark, sf_dir):
    """The bronze customer table holds each customer three
    times (create + insert + re-insert, one copy with NULL keys); row counts
    after each cleaning step, taken in one pass over the table."""
    c = Tables(spark, sf_dir).customer.select("c_custkey", "c_name", "c_mktsegment")
    spoiled = F.when(F.col("c_custkey") % 50 != 0, F.col("c_custkey"))
    copies = F.explode(F.array(F.col("c_custkey"), F.col("c_custkey"), spoiled))
    steps = StepCounts()
    raw = steps.mark(c.select(copies.alias("c_custkey"), "c_name", "c_mktsegment"), "raw")
    nn = steps.mark(raw.dropna(subset=["c_custkey"]), "not_null_key")
    dd = steps.mark(keep_first(nn, ["c_custkey"], [("c_name", True), ("c_mktsegment", True)]), "deduplicated")
    return steps.run(dd)


@register(
    "replace_values",
    """
SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'urgent' WHEN '5-LOW' THEN 'low' ELSE o_orderpriority END AS o_orderpriority,
       CASE o_orderstatus WHEN 'F' THEN 'closed' END AS closed
FROM orders
""",
)
def q_replace_values(spark, sf_dir):
    """Some values replaced, the others kept; B10: the others NULL."""
    o = Tables(spark, sf_dir).orders.select("o_orderkey", "o_orderpriority", "o_orderstatus")
    d = recode(o, "o_orderpriority", {"1-URGENT": "urgent", "5-LOW": "low"}, keep=True)
    return recode(d, "o_orderstatus", {"F": "closed"}, out="closed").drop("o_orderstatus")
