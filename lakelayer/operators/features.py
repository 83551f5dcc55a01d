"""Feature-table operators: churn gold view and feature-table preparation.

All aggregations here are hash aggregates with a map-side partial step, so a
user holding a large share of events is reduced on every map task before the
shuffle (no single task sees all of its rows).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.casts import safe_cast
from ..functions.dates import RAW_TS_FORMAT, days_since, parse_ts


def clean_users(raw: DataFrame) -> DataFrame:
    """Bronze -> silver user cleaning (dates parsed, names in initial capitals,
    int casts, rows without an id dropped); the same for batch and stream."""
    return raw.filter(F.col("id").isNotNull()).withColumns(
        {
            **{c: parse_ts(c, RAW_TS_FORMAT) for c in ("creation_date", "last_activity_date")},
            **{c: F.initcap(c) for c in ("firstname", "lastname")},
            **{c: safe_cast(c, "int") for c in ("gender", "age_group", "churn")},
        }
    )


def clean_orders(raw: DataFrame) -> DataFrame:
    """Bronze -> silver order cleaning (rename, parse the raw date text,
    cast the amounts); the same for batch and stream."""
    return raw.select(
        F.col("id").alias("order_id"),
        "user_id",
        parse_ts("transaction_date", RAW_TS_FORMAT).alias("creation_date"),
        safe_cast("amount", "int").alias("amount"),
        safe_cast("item_count", "int").alias("item_count"),
    )


def event_features(
    events: DataFrame,
    user: str = "user_id",
    session: Column | str = "session_id",
    platform: str = "platform",
    ts: str = "date",
    tiebreak: str | None = None,
) -> DataFrame:
    """Per user: platform of the first event, event count, distinct sessions,
    last event time.  ``first()`` is made deterministic: the platform of the
    earliest event (ties broken by ``tiebreak``)."""
    session_c = F.col(session) if isinstance(session, str) else session
    order_key = F.struct(F.col(ts), F.col(tiebreak)) if tiebreak else F.col(ts)
    return events.groupBy(user).agg(
        F.min_by(F.col(platform), order_key).alias("platform"),
        F.count(F.lit(1)).alias("event_count"),
        F.count_distinct(session_c).alias("session_count"),
        F.max(ts).alias("last_event"),
    )


def order_features(
    orders: DataFrame,
    user: str = "user_id",
    amount: str = "amount",
    items: str = "item_count",
    ts: str = "creation_date",
) -> DataFrame:
    """Per user: order count, total amount, total items, last transaction."""
    return orders.groupBy(user).agg(
        F.count(F.lit(1)).alias("order_count"),
        F.sum(amount).alias("total_amount"),
        F.sum(items).alias("total_item"),
        F.max(ts).alias("last_transaction"),
    )


def churn_features(
    users: DataFrame,
    events_agg: DataFrame,
    orders_agg: DataFrame,
    as_of: str,
    user: str = "user_id",
    user_dates: dict[str, str] | None = None,
) -> DataFrame:
    """Gold churn view: users joined (inner) to their event and order aggregates,
    plus recency in days against a fixed ``as_of`` date.  Users lacking events
    or orders are dropped.  Both aggregates are already one row per user, so the
    two joins are on unique keys; AQE broadcasts whichever side is small at run
    time and sort-merges otherwise."""
    out = users.join(events_agg, user, "inner").join(orders_agg, user, "inner")
    recency = {name: days_since(col, as_of) for name, col in (user_dates or {}).items()}
    recency["days_last_event"] = days_since("last_event", as_of)
    recency["days_last_transaction"] = days_since("last_transaction", as_of)
    return out.withColumns(recency)


def feature_table(df: DataFrame, drop: Sequence[str] = ()) -> DataFrame:
    """Feature-table prep: drop identity columns, then rows with any NULL."""
    return df.drop(*drop).dropna(how="any")
