"""DuckDB SQL for the same views and operators, used as the correctness oracle.

Each entry is a named CTE body; ``with_views(body, *names)`` prepends the
CTEs a query needs (dependencies first).  The SQL is written independently of
the Spark code paths, from the same specification.

Parity conventions (SURVEY §7.4):
* money is summed as DECIMAL and exposed as DOUBLE;
* ``rnd(x, d)`` reproduces Spark's ``round`` on doubles (HALF_UP on the shortest
  decimal text of the double) — DuckDB's own double round differs on ties;
* DuckDB has no ``initcap``; ``initcap(x)`` below emulates Spark's (capitalise
  after a space, everything else lower-case).
"""

from __future__ import annotations

from fintide import config as C

AS_OF = C.FIXTURE_AS_OF.isoformat()
METROS = ", ".join(f"'{m}'" for m in C.FIXTURE_METROS)


def rnd(expr: str, digits: int) -> str:
    return f"CAST(ROUND(CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(38,18)), {digits}) AS DOUBLE)"


def initcap(expr: str) -> str:
    return (f"array_to_string(list_transform(string_split(lower({expr}), ' '), "
            f"lambda w: upper(substr(w, 1, 1)) || substr(w, 2)), ' ')")


def blank_null(expr: str) -> str:
    return f"nullif(trim({expr}), '')"


def years(start: str, as_of: str = AS_OF) -> str:
    return rnd(f"datediff('day', {start}, DATE '{as_of}') / 365.25", 1)


def plain(expr: str) -> str:
    """Number as plain text with at least one decimal (same text as ``plain_number`` in Spark)."""
    t = f"regexp_replace(CAST(CAST({expr} AS DECIMAL(38,10)) AS VARCHAR), '0+$', '')"
    return f"CASE WHEN {t} LIKE '%.' THEN {t} || '0' ELSE {t} END"


def _pct(part: str, total: str) -> str:
    return rnd(f"{part} / CASE WHEN {total} = 0 THEN 1.0 ELSE {total} END * 100", 2)


VIEWS: dict[str, tuple[tuple[str, ...], str]] = {}


def view(name: str, deps: tuple[str, ...], sql: str) -> None:
    VIEWS[name] = (deps, sql)


view("clients_raw", (), """
    SELECT
      printf('CLT%07d', c.c_custkey) AS client_id,
      '  ' || upper(c.c_name) || ' ' AS name,
      CASE WHEN c.c_custkey % 11 <> 0 THEN upper(replace(c.c_name, '#', '.')) || '@EXAMPLE.COM ' END AS email,
      CASE WHEN c.c_custkey % 13 <> 0 THEN '+91' ||
        CASE WHEN length(CAST(c.c_custkey AS VARCHAR)) >= 10 THEN CAST(c.c_custkey AS VARCHAR)
             ELSE lpad(CAST(c.c_custkey AS VARCHAR), 10, '6') END END AS phone,
      CASE WHEN c.c_custkey % 17 = 0 THEN NULL WHEN c.c_custkey % 17 = 1 THEN '   '
           ELSE ' ' || lower(n.n_name) END AS city,
      CASE WHEN c.c_custkey % 97 <> 0 THEN CAST(15 + c.c_custkey % 90 AS INTEGER) END AS age,
      CASE c.c_mktsegment WHEN 'AUTOMOBILE' THEN 'aggressive ' WHEN 'BUILDING' THEN ' CONSERVATIVE'
           WHEN 'FURNITURE' THEN 'moderate' WHEN 'MACHINERY' THEN 'Moderate' END AS risk_profile,
      c.c_acctbal * 1000 AS aum,
      CASE WHEN c.c_custkey % 19 = 0 THEN 'not-a-date' ELSE strftime(f.first_order, '%Y-%m-%d') END
        AS onboarded_date,
      CASE WHEN c.c_custkey % 23 <> 0 THEN 'ADV' || lpad(CAST(1 + c.c_custkey % 50 AS VARCHAR), 3, '0') END
        AS advisor_id,
      CASE WHEN c.c_custkey % 20 < 17 THEN ' verified' WHEN c.c_custkey % 20 = 18 THEN 'PENDING'
           WHEN c.c_custkey % 20 = 19 THEN 'rejected' END AS kyc_status
    FROM customer c
    JOIN nation n ON c.c_nationkey = n.n_nationkey
    LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS first_order FROM orders GROUP BY o_custkey) f
      ON c.c_custkey = f.o_custkey""")

view("clients_clean", ("clients_raw",), f"""
    SELECT
      client_id,
      {initcap(blank_null('name'))} AS name,
      lower({blank_null('email')}) AS email,
      phone,
      coalesce({initcap(blank_null('city'))}, 'Unknown') AS city,
      age,
      coalesce({initcap(blank_null('risk_profile'))}, 'Moderate') AS risk_profile,
      aum,
      CAST(try_strptime(onboarded_date, '%Y-%m-%d') AS DATE) AS onboarded_date,
      coalesce(advisor_id, 'ADV000') AS advisor_id,
      coalesce(upper({blank_null('kyc_status')}), 'PENDING') AS kyc_status
    FROM clients_raw
    WHERE client_id IS NOT NULL AND aum > 0 AND age BETWEEN 18 AND 100""")

view("clients_enriched", ("clients_clean",), f"""
    SELECT *,
      CASE WHEN age < 35 THEN 'Young' WHEN age < 55 THEN 'Middle-Aged' ELSE 'Senior' END AS age_group,
      CASE WHEN aum < 500000 THEN 'Mass' WHEN aum < 5000000 THEN 'HNI' ELSE 'UHNI' END AS aum_tier,
      {years('onboarded_date')} AS years_since_onboard,
      CASE WHEN city IN ({METROS}) THEN 'Tier1' ELSE 'Tier2' END AS city_tier,
      (aum >= 1000000 AND kyc_status = 'VERIFIED') AS is_high_value,
      CAST((CASE WHEN email IS NOT NULL THEN 1 ELSE 0 END) + (CASE WHEN phone IS NOT NULL THEN 1 ELSE 0 END)
         + (CASE WHEN city <> 'Unknown' THEN 1 ELSE 0 END) + (CASE WHEN kyc_status = 'VERIFIED' THEN 1 ELSE 0 END)
         + (CASE WHEN onboarded_date IS NOT NULL THEN 1 ELSE 0 END) AS INTEGER) AS data_quality_score
    FROM clients_clean""")

view("holdings_raw", (), """
    SELECT
      'PRT' || CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS portfolio_id,
      CASE WHEN l.l_orderkey % 101 <> 0 THEN printf('CLT%07d', o.o_custkey) END AS client_id,
      CAST(l.l_partkey AS VARCHAR) AS fund_id,
      CASE split_part(p.p_type, ' ', 1) WHEN 'STANDARD' THEN 'Equity' WHEN 'LARGE' THEN ' EQUITY'
           WHEN 'ECONOMY' THEN 'Debt ' WHEN 'SMALL' THEN 'debt' WHEN 'PROMO' THEN 'GOLD'
           WHEN 'MEDIUM' THEN 'Hybrid' END AS fund_type,
      CAST(l.l_extendedprice AS DECIMAL(18,2)) AS invested_amt,
      CASE WHEN l.l_linenumber = 7 THEN CAST(0 AS DECIMAL(18,2))
           ELSE CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l.l_discount AS DECIMAL(4,2)))
                     * (1 + CAST(l.l_tax AS DECIMAL(4,2))) AS DECIMAL(18,2)) END AS current_value,
      l.l_quantity AS num_units,
      CASE WHEN l.l_orderkey % 89 = 0 THEN 'True' ELSE strftime(l.l_shipdate, '%Y-%m-%d') END AS purchase_date
    FROM lineitem l
    JOIN orders o ON l.l_orderkey = o.o_orderkey
    JOIN part p ON l.l_partkey = p.p_partkey""")

view("holdings_clean", ("holdings_raw",), """
    SELECT portfolio_id, client_id, fund_id, lower(trim(fund_type)) AS fund_type, invested_amt, current_value,
           num_units, CAST(try_strptime(purchase_date, '%Y-%m-%d') AS DATE) AS purchase_date
    FROM holdings_raw
    WHERE client_id IS NOT NULL AND invested_amt > 0 AND current_value > 0
      AND lower(trim(fund_type)) IN ('equity', 'debt', 'gold')""")

view("holdings_summary", ("holdings_clean",), f"""
    SELECT *,
      {_pct('equity_value', 'total_current_value')} AS equity_pct,
      {_pct('debt_value', 'total_current_value')} AS debt_pct,
      {_pct('gold_value', 'total_current_value')} AS gold_pct,
      {rnd('(total_current_value - total_invested) / total_invested * 100', 2)} AS gain_loss_pct,
      {years('first_investment_date')} AS years_invested
    FROM (
      SELECT client_id,
        CAST(sum(invested_amt) AS DOUBLE) AS total_invested,
        CAST(sum(current_value) AS DOUBLE) AS total_current_value,
        count(portfolio_id) AS total_num_funds,
        min(purchase_date) AS first_investment_date,
        max(purchase_date) AS latest_investment_date,
        CAST(coalesce(sum(CASE WHEN fund_type = 'equity' THEN current_value END), 0) AS DOUBLE) AS equity_value,
        CAST(coalesce(sum(CASE WHEN fund_type = 'debt' THEN current_value END), 0) AS DOUBLE) AS debt_value,
        CAST(coalesce(sum(CASE WHEN fund_type = 'gold' THEN current_value END), 0) AS DOUBLE) AS gold_value
      FROM holdings_clean GROUP BY client_id) t""")

view("portfolio_summary", ("holdings_summary", "clients_enriched"), """
    SELECT s.*, coalesce(c.risk_profile, 'Moderate') AS risk_profile, c.aum_tier, c.age_group, c.city_tier
    FROM holdings_summary s LEFT JOIN clients_enriched c ON s.client_id = c.client_id""")

view("training_features", ("portfolio_summary", "clients_enriched"), """
    SELECT p.client_id, p.equity_pct, p.debt_pct, p.gold_pct, p.total_num_funds, p.years_invested,
      """ + rnd("c.aum / 100000", 2) + """ AS aum_lakh,
      CAST(CASE c.age_group WHEN 'Young' THEN 0 WHEN 'Middle-Aged' THEN 1 WHEN 'Senior' THEN 2 ELSE 1 END
           AS INTEGER) AS age_group_encoded,
      p.risk_profile AS target
    FROM portfolio_summary p JOIN clients_enriched c ON p.client_id = c.client_id
    WHERE p.risk_profile IN ('Conservative', 'Moderate', 'Aggressive')
      AND p.equity_pct IS NOT NULL AND p.debt_pct IS NOT NULL AND p.gold_pct IS NOT NULL""")

view("transactions", (), """
    SELECT
      printf('TXN%07d', event_id) AS txn_id,
      printf('CLT%07d', user_id) AS client_id,
      'Brand#' || CAST(1 + event_id % 25 AS VARCHAR) AS fund_name,
      CASE event_type WHEN 'view' THEN 'SIP' WHEN 'click' THEN 'SIP' WHEN 'purchase' THEN 'BUY'
           WHEN 'signup' THEN 'DIVIDEND' WHEN 'error' THEN 'SELL' END AS txn_type,
      CAST(CAST(value AS DECIMAL(18,2)) * 10000 AS DECIMAL(18,2)) AS amount,
      ts AS txn_ts,
      CASE event_type WHEN 'error' THEN 'API' WHEN 'purchase' THEN 'API' WHEN 'view' THEN 'APP'
           WHEN 'click' THEN 'WEB' WHEN 'signup' THEN 'ADVISOR' END AS channel,
      (value > 100 AND event_id % 3 <> 0) AS is_flagged
    FROM events""")

view("fund_nav", (), """
    SELECT p.p_brand AS fund_name, CAST(l.l_shipdate AS DATE) AS nav_date,
           CAST(sum(CAST(l.l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / sum(l.l_quantity) AS nav
    FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
    GROUP BY 1, 2""")

view("funds", (), """
    SELECT CAST(p_partkey AS VARCHAR) AS fund_id, printf('FND%06d', p_partkey) AS fund_code,
           p_brand AS fund_name, """ + initcap("split_part(p_type, ' ', 1)") + """ AS category
    FROM part""")

view("holdings_priced", (), """
    SELECT 'PRT' || CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS portfolio_id,
           printf('CLT%07d', o.o_custkey) AS client_id, p.p_brand AS fund_name, l.l_quantity AS units,
           CAST(o.o_orderdate AS DATE) AS buy_date
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey""")


def _closure(names: tuple[str, ...]) -> list[str]:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in VIEWS[n][0]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    return order


def with_views(body: str, *names: str, extra: list[tuple[str, str]] | None = None,
               recursive: bool = False) -> str:
    """``WITH [RECURSIVE] <needed views>, <extra CTEs> <body>``."""
    ctes = [f"{n} AS ({VIEWS[n][1]}\n)" for n in _closure(names)]
    ctes += [f"{n} AS ({sql}\n)" for n, sql in (extra or [])]
    if not ctes:
        return body
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(ctes) + "\n" + body


# Scoring requests derived from the feature table, some broken on purpose.
view("requests", ("training_features",), """
    SELECT client_id,
      CASE WHEN CAST(substr(client_id, 4) AS BIGINT) % 7 = 0 THEN 150.0::DOUBLE ELSE equity_pct END AS equity_pct,
      debt_pct, gold_pct, total_num_funds,
      CASE WHEN CAST(substr(client_id, 4) AS BIGINT) % 13 = 0 THEN NULL ELSE years_invested END AS years_invested,
      aum_lakh,
      CASE WHEN CAST(substr(client_id, 4) AS BIGINT) % 11 = 0 THEN 'Baby'
           ELSE (['Young', 'Middle-Aged', 'Senior'])[age_group_encoded + 1] END AS age_group
    FROM training_features""")

_REASONS = ", ".join(
    [f"CASE WHEN {f} IS NULL THEN '{f}: required' END" for f in C.REQUEST_FIELDS]
    + [f"CASE WHEN ({f} < {lo}" + (f" OR {f} > {hi}" if hi is not None else "") + f") THEN '{f}: out of range' END"
       for f, (lo, hi) in C.REQUEST_RANGES.items()]
    + ["CASE WHEN NOT (age_group IN ('Young', 'Middle-Aged', 'Senior')) "
       "THEN 'age_group: must be one of Young/Middle-Aged/Senior' END"]
)

view("validated", ("requests",), f"""
    SELECT client_id, {rnd('equity_pct', 2)} AS equity_pct, {rnd('debt_pct', 2)} AS debt_pct,
           {rnd('gold_pct', 2)} AS gold_pct, total_num_funds, years_invested, aum_lakh, age_group,
           list_filter([{_REASONS}], lambda x: x IS NOT NULL) AS reasons
    FROM requests""")

view("request_keys", ("validated",), f"""
    SELECT client_id, 'portfolio:risk:' || client_id || ':' || md5(concat_ws('_', {plain('equity_pct')},
           {plain('debt_pct')}, {plain('gold_pct')}, CAST(total_num_funds AS VARCHAR), {plain('years_invested')},
           {plain('aum_lakh')}, age_group)) AS cache_key
    FROM validated WHERE len(reasons) = 0""")

view("timed_requests", ("request_keys",), """
    SELECT e.event_id, k.client_id, k.cache_key, e.ts
    FROM events e JOIN request_keys k ON printf('CLT%07d', e.user_id) = k.client_id""")


def uniform(*parts: str, seed: int = C.SEED) -> str:
    """Same draw as ``hash_uniform``: first 32 bits of md5('p1:p2:...:seed') / 2^32."""
    args = ", ".join(list(parts) + [f"'{seed}'"])
    return f"(CAST(('0x' || substr(md5(concat_ws(':', {args})), 1, 8)) AS BIGINT) / 4294967296.0::DOUBLE)"


def pick(u: str, choices) -> str:
    """Same thresholds as ``pick_weighted`` (cumulative weights accumulated in the same float order)."""
    total = float(sum(w for _, w in choices))
    cum = 0.0
    parts = []
    for label, w in choices[:-1]:
        cum += w / total
        parts.append(f"WHEN {u} < {cum!r}::DOUBLE THEN '{label}'")
    return f"CASE {' '.join(parts)} ELSE '{choices[-1][0]}' END"
