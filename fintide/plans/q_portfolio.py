"""Holdings and portfolio queries: clean, by-type, pivot, totals, summary, reports, fund lookup."""

from __future__ import annotations

from pyspark.sql import functions as F

from fintide.operators import portfolio as P
from fintide.operators import reports
from fintide.plans import views as V
from fintide.plans.catalog import register
from fintide.plans.oracle_views import rnd, with_views
from fintide.sources import testviews as tv

SUMMARY_COLS = ("client_id, total_invested, total_current_value, total_num_funds, first_investment_date, "
                "latest_investment_date, equity_value, debt_value, gold_value, equity_pct, debt_pct, gold_pct, "
                "gain_loss_pct, years_invested, risk_profile, aum_tier, age_group, city_tier")


@register("holdings_clean", with_views(
    "SELECT portfolio_id, client_id, fund_id, fund_type, CAST(invested_amt AS DOUBLE) AS invested_amt, "
    "CAST(current_value AS DOUBLE) AS current_value, num_units, purchase_date FROM holdings_clean",
    "holdings_clean"))
def holdings_clean(spark, d):
    return V.holdings_clean(spark, d).withColumns(
        {"invested_amt": F.col("invested_amt").cast("double"), "current_value": F.col("current_value").cast("double")}
    )


@register("holdings_by_type", with_views("""
SELECT client_id, fund_type, CAST(sum(invested_amt) AS DOUBLE) AS invested,
       CAST(sum(current_value) AS DOUBLE) AS current, count(portfolio_id) AS num_funds_in_type
FROM holdings_clean GROUP BY client_id, fund_type""", "holdings_clean"))
def holdings_by_type(spark, d):
    return P.holdings_by_type(V.holdings_clean(spark, d))


@register("holdings_pivot", with_views(
    "SELECT client_id, equity_value, debt_value, gold_value FROM holdings_summary", "holdings_summary"))
def holdings_pivot(spark, d):
    return P.holdings_pivot(V.holdings_clean(spark, d))


@register("client_totals", with_views(
    "SELECT client_id, total_invested, total_current_value, total_num_funds, first_investment_date, "
    "latest_investment_date FROM holdings_summary", "holdings_summary"))
def client_totals(spark, d):
    return P.client_totals(V.holdings_clean(spark, d))


@register("portfolio_summary", with_views(f"SELECT {SUMMARY_COLS} FROM portfolio_summary", "portfolio_summary"))
def portfolio_summary(spark, d):
    return V.summary(spark, d)


@register("allocation_by_risk", with_views(f"""
SELECT risk_profile,
       {rnd('avg(equity_pct)', 1)} AS avg_equity_pct, {rnd('avg(debt_pct)', 1)} AS avg_debt_pct,
       {rnd('avg(gold_pct)', 1)} AS avg_gold_pct, {rnd('avg(gain_loss_pct)', 1)} AS avg_gain_loss_pct
FROM portfolio_summary GROUP BY risk_profile ORDER BY risk_profile""", "portfolio_summary"))
def allocation_by_risk(spark, d):
    return reports.allocation_report(V.summary(spark, d))


@register("sql_portfolio_averages", with_views(f"""
SELECT {rnd('avg(equity_pct)', 1)} AS avg_equity_pct, {rnd('avg(debt_pct)', 1)} AS avg_debt_pct,
       {rnd('avg(gold_pct)', 1)} AS avg_gold_pct, {rnd('avg(total_num_funds)', 1)} AS avg_funds,
       count(*) AS total_clients
FROM portfolio_summary""", "portfolio_summary"))
def sql_portfolio_averages(spark, d):
    return reports.sql_report(spark, reports.PORTFOLIO_AVERAGES_SQL, portfolios=V.summary(spark, d))


TOP_N = 10


@register("top_clients", with_views(f"""
SELECT client_id, total_current_value, total_invested, gain_loss_pct, risk_profile
FROM portfolio_summary ORDER BY total_current_value DESC, client_id LIMIT {TOP_N}""", "portfolio_summary"))
def top_clients(spark, d):
    return reports.top_n(V.summary(spark, d), "total_current_value", TOP_N, "client_id",
                         ["client_id", "total_current_value", "total_invested", "gain_loss_pct", "risk_profile"])


@register("holdings_with_fund", with_views("""
SELECT h.portfolio_id, h.client_id, h.fund_id, f.fund_code, f.fund_name, f.category, h.fund_type,
       CAST(h.current_value AS DOUBLE) AS current_value
FROM holdings_clean h JOIN funds f ON h.fund_id = f.fund_id""", "holdings_clean", "funds"))
def holdings_with_fund(spark, d):
    h = V.holdings_clean(spark, d)
    funds = tv.funds(spark, d).drop("fund_type")
    # The fund dimension is joined on its key; AQE broadcasts it when the measured size allows.
    return h.join(funds, on="fund_id", how="inner").select(
        "portfolio_id", "client_id", "fund_id", "fund_code", "fund_name", "category", "fund_type",
        F.col("current_value").cast("double").alias("current_value"),
    )
