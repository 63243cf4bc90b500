"""Filters and derived values with the null rules of the source procedures."""

from __future__ import annotations

import re
from collections.abc import Mapping
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def like_pattern(query: str, upper: bool = True) -> str:
    """The LIKE pattern of a search: the query with ``%`` around it."""
    pattern = f"%{query.upper() if upper else query}%"
    return re.sub(r"\\(.)", lambda m: m[0] if m[1] in "%_\\" else m[1], pattern, flags=re.DOTALL)


def search_contains(df: DataFrame, column: str, query: str | None, upper: bool = True) -> DataFrame:
    """Rows whose column is LIKE the query with ``%`` around it; the column keeps its case.

    ``_`` and ``%`` in the query are wildcards, a backslash takes the next
    character as it is. A NULL query finds nothing, an empty one every
    non-null value. A query without wildcards is a pushed-down ``contains``.
    """
    if query is None:
        return df.filter(F.lit(False))
    return df.filter(F.col(column).like(like_pattern(query, upper)))


def date_window(
    df: DataFrame,
    ts: str,
    as_of: date,
    frm: date | None = None,
    to: date | None = None,
    days: int = 30,
) -> DataFrame:
    """Rows whose date lies in [from, to]; to = ``as_of``, from = to − days.

    Written as a half-open range on the raw timestamp, so file statistics
    still prune.
    """
    to = to or as_of
    frm = frm or to - timedelta(days=days)
    return df.filter((F.col(ts) >= F.lit(frm)) & (F.col(ts) < F.lit(to + timedelta(days=1))))


def lookback(df: DataFrame, column: str, days: int | None, as_of: date) -> DataFrame:
    """Rows not older than ``days`` before ``as_of``; NULL days keeps nothing."""
    if days is None:
        return df.filter(F.lit(False))
    return df.filter(F.col(column) >= F.lit(as_of - timedelta(days=days)))


def optional_eq(df: DataFrame, column: str, value) -> DataFrame:
    """Equality filter that is left out when no value is given."""
    return df if value is None else df.filter(F.col(column) == F.lit(value))


def open_range(df: DataFrame, ts: str, frm: date | None, to: date | None) -> DataFrame:
    """Up to ``to``, from ``frm`` if given; without ``to`` nothing qualifies."""
    if to is None:
        return df.filter(F.lit(False))
    upper = F.col(ts) < F.lit(to + timedelta(days=1))
    return df.filter(upper if frm is None else upper & (F.col(ts) >= F.lit(frm)))


def pair_or_all(df: DataFrame, a: str, b: str, va: str | None, vb: str | None) -> DataFrame:
    """Both codes match, or both search values are blank; one alone finds nothing."""
    if not va and not vb:
        return df
    if va is None or vb is None:
        return df.filter(F.lit(False))
    return df.filter((F.col(a) == va) & (F.col(b) == vb))


# Booking modes.
ALL_SHIPMENT = "All_Shipment"
FULLY_REVENUE = "Fully_Revenue_Booked"
PARTIAL_REVENUE = "Partial_Revenue_Booked"
FULLY_COST = "Fully_Cost_Booked"
PARTIAL_COST = "Partial_cost_Booked"


def booking_state(df: DataFrame, mode: str | None) -> DataFrame:
    """Compare provisional with booked amounts; an unknown mode keeps nothing."""
    revenue, cost = F.col("provisionRevenue"), F.col("provisionCost")
    booked_revenue = F.col("wipRevenue") + F.col("pnlIncome")
    booked_cost = F.col("wipCost") + F.col("pnlCost")
    if mode is None or mode == ALL_SHIPMENT:
        return df
    tests = {
        FULLY_REVENUE: revenue == booked_revenue,
        PARTIAL_REVENUE: revenue != booked_revenue,
        FULLY_COST: cost == booked_cost,
        PARTIAL_COST: cost != booked_cost,
    }
    return df.filter(tests.get(mode, F.lit(False)))


def code_map(column: Column, mapping: Mapping[str, str], default: str | None = None) -> Column:
    """Map text values to codes; other values, and NULL, give the default."""
    mapped = None
    for source, code in mapping.items():
        mapped = F.when(column == source, code) if mapped is None else mapped.when(column == source, code)
    return mapped.otherwise(F.lit(default))


def trade_code(other_trade: Column, service_trade: Column) -> Column:
    return F.when(other_trade == "Transit", other_trade).otherwise(service_trade)


def default_consignee(trade: Column) -> Column:
    """Placeholder consignee: one code for transit trade, one for the rest."""
    return F.when(F.substring(trade, 1, 1) == "T", "T9999").otherwise("D9999")


def list_value(name: Column, code: Column) -> Column:
    return F.concat(name, F.lit("-("), code, F.lit(")"))


def flag_present(column: Column) -> Column:
    return F.when(column.isNotNull(), "Y").otherwise("N")


def with_audit(df: DataFrame, user: str, as_of: Column) -> DataFrame:
    return df.withColumns(
        {
            "created_user": F.lit(user),
            "created_date": as_of,
            "updated_user": F.lit(user),
            "updated_date": as_of,
        }
    )
