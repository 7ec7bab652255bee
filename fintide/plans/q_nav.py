"""Fund NAV queries: weekday returns, volatility, as-of valuation of holdings, client valuation."""

from __future__ import annotations

from pyspark.sql import functions as F

from fintide import config as C
from fintide.operators import timeseries as TS
from fintide.plans.catalog import register
from fintide.plans.oracle_views import AS_OF, rnd, with_views
from fintide.sources import testviews as tv


@register("nav_returns", with_views("""
SELECT fund_name, nav_date, nav, lag(nav_date) OVER w AS prev_nav_date, lag(nav) OVER w AS prev_nav,
       nav / lag(nav) OVER w - 1 AS daily_return
FROM fund_nav WHERE isodow(nav_date) < 6
WINDOW w AS (PARTITION BY fund_name ORDER BY nav_date)""", "fund_nav"))
def nav_returns(spark, d):
    return TS.nav_returns(tv.fund_nav(spark, d))


@register("nav_volatility", with_views(f"""
SELECT fund_name, count(daily_return) AS n_returns, {rnd('avg(daily_return)', 8)} AS mean_return,
       {rnd('stddev_samp(daily_return)', 8)} AS stddev_return
FROM (SELECT fund_name, nav / lag(nav) OVER (PARTITION BY fund_name ORDER BY nav_date) - 1 AS daily_return
      FROM fund_nav WHERE isodow(nav_date) < 6) t
GROUP BY fund_name""", "fund_nav"))
def nav_volatility(spark, d):
    return TS.nav_volatility(TS.nav_returns(tv.fund_nav(spark, d)))


_VALUED = ("valued", f"""
  SELECT h.portfolio_id, h.client_id, h.fund_name, h.units, h.buy_date, n.nav_date AS nav_date_at_buy,
         n.nav AS nav_at_buy, c.nav_date AS current_nav_date, c.nav AS current_nav,
         {rnd('h.units * n.nav', 2)} AS invested_value, {rnd('h.units * c.nav', 2)} AS current_value
  FROM holdings_priced h
  ASOF LEFT JOIN fund_nav n ON h.fund_name = n.fund_name AND h.buy_date >= n.nav_date
  LEFT JOIN (SELECT fund_name, max(nav_date) AS nav_date, arg_max(nav, nav_date) AS nav
             FROM fund_nav WHERE nav_date <= DATE '{AS_OF}' GROUP BY fund_name) c
    ON h.fund_name = c.fund_name""")


def _valued(spark, d):
    return TS.value_holdings(tv.holdings_priced(spark, d), tv.fund_nav(spark, d), C.FIXTURE_AS_OF)


@register("holding_valuation_asof", with_views(
    "SELECT portfolio_id, client_id, fund_name, units, buy_date, nav_date_at_buy, nav_at_buy, current_nav_date, "
    "current_nav, invested_value, current_value FROM valued", "holdings_priced", "fund_nav", extra=[_VALUED]))
def holding_valuation_asof(spark, d):
    return _valued(spark, d).select(
        "portfolio_id", "client_id", "fund_name", "units", "buy_date", "nav_date_at_buy", "nav_at_buy",
        "current_nav_date", "current_nav", "invested_value", "current_value")


@register("client_valuation", with_views(f"""
SELECT client_id, count(*) AS n_holdings, count(nav_at_buy) AS n_priced,
       CAST(sum(CAST(invested_value AS DECIMAL(20,2))) AS DOUBLE) AS total_invested_value,
       CAST(sum(CAST(current_value AS DECIMAL(20,2))) AS DOUBLE) AS total_current_value,
       {rnd('(CAST(sum(CAST(current_value AS DECIMAL(20,2))) AS DOUBLE) - CAST(sum(CAST(invested_value AS DECIMAL(20,2))) AS DOUBLE)) / CAST(sum(CAST(invested_value AS DECIMAL(20,2))) AS DOUBLE) * 100', 2)} AS gain_loss_pct
FROM valued WHERE nav_at_buy IS NOT NULL GROUP BY client_id""", "holdings_priced", "fund_nav", extra=[_VALUED]))
def client_valuation(spark, d):
    v = _valued(spark, d).filter(F.col("nav_at_buy").isNotNull())
    agg = v.groupBy("client_id").agg(
        F.count(F.lit(1)).alias("n_holdings"), F.count("nav_at_buy").alias("n_priced"),
        F.sum(F.col("invested_value").cast("decimal(20,2)")).cast("double").alias("total_invested_value"),
        F.sum(F.col("current_value").cast("decimal(20,2)")).cast("double").alias("total_current_value"),
    )
    return agg.withColumn("gain_loss_pct", F.round(F.try_divide(
        F.col("total_current_value") - F.col("total_invested_value"), F.col("total_invested_value")) * 100, 2))
