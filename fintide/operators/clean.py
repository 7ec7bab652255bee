"""Cleaning of raw client and holding tables, and row reconciliation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fintide import config as C
from fintide.functions.columns import blank_to_null


def client_rules(min_age: int = C.MIN_AGE, max_age: int = C.MAX_AGE) -> dict[str, Column]:
    """Row-keeping rules of the client cleaner (on raw columns, so they push down to the scan)."""
    return {
        "client_id_present": F.col("client_id").isNotNull(),
        "aum_positive": F.col("aum") > 0,
        "age_in_range": F.col("age").between(min_age, max_age),
    }


def clean_clients(df: DataFrame, defaults: Mapping[str, str] = C.CLIENT_DEFAULTS,
                  min_age: int = C.MIN_AGE, max_age: int = C.MAX_AGE) -> DataFrame:
    """Trim / case-normalise text, parse the onboarding date, fill defaults, drop invalid rows.

    Whitespace-only text becomes NULL before filling, so it receives the default
    too.  Malformed dates become NULL (``try_to_date``) instead of failing.
    """
    keep = None
    for rule in client_rules(min_age, max_age).values():
        keep = rule if keep is None else keep & rule
    cleaned = df.filter(keep).withColumns(
        {
            "name": F.initcap(blank_to_null("name")),
            "email": F.lower(blank_to_null("email")),
            "city": F.initcap(blank_to_null("city")),
            "risk_profile": F.initcap(blank_to_null("risk_profile")),
            "kyc_status": F.upper(blank_to_null("kyc_status")),
            "onboarded_date": F.try_to_date(F.col("onboarded_date"), "yyyy-MM-dd"),
        }
    )
    return cleaned.fillna(dict(defaults))


def holding_rules(fund_types: Sequence[str] = tuple(C.FUND_TYPES)) -> dict[str, Column]:
    ftype = F.lower(F.trim(F.col("fund_type")))
    return {
        "client_id_present": F.col("client_id").isNotNull(),
        "invested_positive": F.col("invested_amt") > 0,
        "current_positive": F.col("current_value") > 0,
        "fund_type_known": ftype.isin(list(fund_types)),
    }


def clean_holdings(df: DataFrame, fund_types: Sequence[str] = tuple(C.FUND_TYPES)) -> DataFrame:
    """Normalise fund type, parse purchase date, keep positive amounts of the allowed fund types."""
    keep = None
    for rule in holding_rules(fund_types).values():
        keep = rule if keep is None else keep & rule
    return df.filter(keep).withColumns(
        {
            "fund_type": F.lower(F.trim(F.col("fund_type"))),
            "purchase_date": F.try_to_date(F.col("purchase_date"), "yyyy-MM-dd"),
        }
    )


def reconcile(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """One pass: raw rows, rows passing all rules, rows removed, and rows failing each rule.

    A NULL rule result counts as failing (the filter drops it too).
    """
    passes = [F.coalesce(r, F.lit(False)) for r in rules.values()]
    all_pass = passes[0]
    for p in passes[1:]:
        all_pass = all_pass & p
    aggs = [
        F.count(F.lit(1)).alias("raw_rows"),
        F.count_if(all_pass).alias("clean_rows"),
        F.count_if(~all_pass).alias("removed_rows"),
    ]
    aggs += [F.count_if(~p).alias(f"failed_{name}") for name, p in zip(rules, passes)]
    return df.agg(*aggs)
