"""Sampling queries: exact-n sample, seeded shuffle, weighted assignment, allocation expansion."""

from __future__ import annotations

from fintide import config as C
from fintide.operators import sampling as SM
from fintide.plans import views as V
from fintide.plans.catalog import register
from fintide.plans.oracle_views import pick, uniform, with_views
from fintide.sources import testviews as tv

SAMPLE_N = 100


@register("sample_n", with_views(f"""
SELECT client_id, risk_profile, aum FROM clients_enriched
ORDER BY md5(client_id || ':{C.SEED}'), client_id LIMIT {SAMPLE_N}""", "clients_enriched"))
def sample_n(spark, d):
    return SM.sample_n(V.clients_enriched(spark, d), "client_id", SAMPLE_N).select("client_id", "risk_profile",
                                                                                   "aum")


@register("seeded_shuffle", with_views(f"""
SELECT client_id, row_number() OVER (ORDER BY md5(client_id || ':{C.SEED}'), client_id) AS position
FROM clients_enriched""", "clients_enriched"))
def seeded_shuffle(spark, d):
    return SM.shuffle(V.clients_enriched(spark, d), "client_id").select("client_id", "position")


@register("weighted_assignment", with_views(f"""
SELECT client_id, {pick(uniform('client_id'), C.CHANNEL_WEIGHTS)} AS preferred_channel
FROM clients_enriched""", "clients_enriched"))
def weighted_assignment(spark, d):
    return SM.assign_weighted(V.clients_enriched(spark, d), "client_id", C.CHANNEL_WEIGHTS,
                              "preferred_channel").select("client_id", "preferred_channel")


def _expand_sql(body: str = "SELECT client_id, risk_profile, slot, fund_type FROM slots", extra=()) -> str:
    u = uniform("client_id", "CAST(slot AS VARCHAR)")
    pools = {p: pick(u, [(t, float(w)) for t, w in pool]) for p, pool in C.ALLOCATION_POOLS.items()}
    cases = " ".join(f"WHEN risk_profile = '{p}' THEN {x}" for p, x in pools.items()) + f" ELSE {pools[C.FALLBACK_POOL]}"
    lo, hi = C.HOLDINGS_PER_CLIENT
    return with_views(body, "clients_enriched", "funds", extra=[("slots", f"""
  SELECT client_id, risk_profile, CAST(slot AS INTEGER) AS slot, CASE {cases} END AS fund_type
  FROM (SELECT client_id, risk_profile,
               unnest(generate_series(1, CAST({lo} + floor({uniform('client_id', "'n'")} * {hi - lo + 1}) AS BIGINT)))
                 AS slot
        FROM clients_enriched) t"""), *extra])


@register("allocation_expand", _expand_sql())
def allocation_expand(spark, d):
    return SM.expand_allocation(V.clients_enriched(spark, d))


_NUMBERED = ("numbered", f"""
  SELECT fund_id, fund_type, row_number() OVER (PARTITION BY fund_type ORDER BY md5(fund_id || ':{C.SEED}'), fund_id) AS n,
         count(*) OVER (PARTITION BY fund_type) AS size
  FROM (SELECT CAST(p_partkey AS VARCHAR) AS fund_id,
               CASE split_part(p_type, ' ', 1) WHEN 'STANDARD' THEN 'Equity' WHEN 'LARGE' THEN 'Equity' WHEN 'ECONOMY' THEN 'Debt'
                    WHEN 'SMALL' THEN 'Debt' WHEN 'PROMO' THEN 'Gold' WHEN 'MEDIUM' THEN 'Hybrid' END AS fund_type FROM part) p
  WHERE fund_type IS NOT NULL""")


@register("allocation_funds", _expand_sql(f"""
SELECT s.client_id, s.slot, s.fund_type, f.fund_id
FROM slots s LEFT JOIN numbered f ON f.fund_type = s.fund_type
  AND f.n = CAST(floor({uniform('s.client_id', 'CAST(s.slot AS VARCHAR)', "'fund'")} * f.size) AS BIGINT) + 1""",
                                          [_NUMBERED]))
def allocation_funds(spark, d):
    """Allocation slots down to a concrete fund of the slot's type."""
    funds = tv.funds(spark, d).filter("fund_type IS NOT NULL")
    slots = SM.expand_allocation(V.clients_enriched(spark, d))
    return SM.expand_to_funds(slots, funds).select("client_id", "slot", "fund_type", "fund_id")


@register("allocation_gaps", _expand_sql("""
SELECT fund_type, count(*) AS slots, CAST(count_if(fund_type IN ('Gold', 'Hybrid')) AS BIGINT) AS unfilled FROM slots GROUP BY fund_type""", []))
def allocation_gaps(spark, d):
    """Slots per fund type when only equity and debt funds can be bought, and those that stay without a fund."""
    funds = tv.funds(spark, d).filter("fund_type IN ('Equity', 'Debt')")
    return SM.unfilled(SM.expand_to_funds(SM.expand_allocation(V.clients_enriched(spark, d)), funds))
