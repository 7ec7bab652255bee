"""Client master queries: clean, enrich, reconcile, distributions, BI SQL, partition profile."""

from __future__ import annotations

from fintide.operators import reports
from fintide.operators.clean import client_rules, reconcile
from fintide.plans import views as V
from fintide.plans.catalog import register
from fintide.plans.oracle_views import rnd, with_views
from fintide.sources import testviews as tv

CLEAN_COLS = ("client_id, name, email, phone, city, age, risk_profile, aum, onboarded_date, advisor_id, "
              "kyc_status")
ENRICHED_COLS = CLEAN_COLS + (", age_group, aum_tier, years_since_onboard, city_tier, is_high_value, "
                              "data_quality_score")


@register("clients_clean", with_views(f"SELECT {CLEAN_COLS} FROM clients_clean", "clients_clean"))
def clients_clean(spark, d):
    return V.clients_clean(spark, d)


@register("clients_enriched", with_views(f"SELECT {ENRICHED_COLS} FROM clients_enriched", "clients_enriched"))
def clients_enriched(spark, d):
    return V.clients_enriched(spark, d)


@register("clients_reconciliation", with_views("""
SELECT CAST(count(*) AS BIGINT) AS raw_rows,
       CAST(count_if(ok_id AND ok_aum AND ok_age) AS BIGINT) AS clean_rows,
       CAST(count_if(NOT (ok_id AND ok_aum AND ok_age)) AS BIGINT) AS removed_rows,
       CAST(count_if(NOT ok_id) AS BIGINT) AS failed_client_id_present,
       CAST(count_if(NOT ok_aum) AS BIGINT) AS failed_aum_positive,
       CAST(count_if(NOT ok_age) AS BIGINT) AS failed_age_in_range
FROM (SELECT coalesce(client_id IS NOT NULL, false) AS ok_id, coalesce(aum > 0, false) AS ok_aum,
             coalesce(age BETWEEN 18 AND 100, false) AS ok_age FROM clients_raw) t""", "clients_raw"))
def clients_reconciliation(spark, d):
    return reconcile(tv.clients_raw(spark, d), client_rules())


def _dist_sql(key: str) -> str:
    return with_views(f"""
SELECT {key}, count, {rnd('CAST(count AS DOUBLE) * 100.0 / total', 2)} AS pct
FROM (SELECT {key}, count(*) AS count, sum(count(*)) OVER () AS total FROM clients_enriched GROUP BY {key}) t
ORDER BY count DESC, {key}""", "clients_enriched")


@register("risk_distribution", _dist_sql("risk_profile"))
def risk_distribution(spark, d):
    return reports.distribution(V.clients_enriched(spark, d), "risk_profile")


@register("aum_tier_distribution", _dist_sql("aum_tier"))
def aum_tier_distribution(spark, d):
    return reports.distribution(V.clients_enriched(spark, d), "aum_tier")


@register("sql_client_totals", with_views(f"""
SELECT count(*) AS total_clients,
       {rnd('avg(aum) / 100000', 1)} AS avg_aum_lakh,
       {rnd('sum(aum) / 10000000', 1)} AS total_aum_crore
FROM clients_enriched""", "clients_enriched"))
def sql_client_totals(spark, d):
    return reports.sql_report(spark, reports.CLIENT_TOTALS_SQL, clients=V.clients_enriched(spark, d))


@register("sql_tier_report", with_views(f"""
SELECT aum_tier, count(*) AS total_clients, {rnd('sum(aum) / 10000000', 1)} AS total_aum_crore
FROM clients_enriched GROUP BY aum_tier ORDER BY total_aum_crore DESC""", "clients_enriched"))
def sql_tier_report(spark, d):
    return reports.sql_report(spark, reports.TIER_REPORT_SQL, clients=V.clients_enriched(spark, d))


PROFILE_COLS = ["age", "aum", "years_since_onboard", "data_quality_score", "onboarded_date", "email"]


def _profile_sql() -> str:
    parts = ["CAST(count(*) AS BIGINT) AS num_records"]
    for c in PROFILE_COLS:
        parts += [f"min({c}) AS min_{c}", f"max({c}) AS max_{c}",
                  f"CAST(count_if({c} IS NULL) AS BIGINT) AS nulls_{c}"]
    return with_views(f"SELECT risk_profile, {', '.join(parts)} FROM clients_enriched GROUP BY risk_profile",
                      "clients_enriched")


@register("partition_profile", _profile_sql())
def partition_profile(spark, d):
    return reports.profile(V.clients_enriched(spark, d), "risk_profile", PROFILE_COLS)


@register("client_null_report", with_views("""
SELECT CAST(count_if(email IS NULL) AS BIGINT) AS email, CAST(count_if(phone IS NULL) AS BIGINT) AS phone,
       CAST(count_if(city IS NULL) AS BIGINT) AS city, CAST(count_if(age IS NULL) AS BIGINT) AS age,
       CAST(count_if(risk_profile IS NULL) AS BIGINT) AS risk_profile,
       CAST(count_if(onboarded_date IS NULL) AS BIGINT) AS onboarded_date,
       CAST(count_if(advisor_id IS NULL) AS BIGINT) AS advisor_id,
       CAST(count_if(kyc_status IS NULL) AS BIGINT) AS kyc_status
FROM clients_raw""", "clients_raw"))
def client_null_report(spark, d):
    cols = ["email", "phone", "city", "age", "risk_profile", "onboarded_date", "advisor_id", "kyc_status"]
    return reports.null_counts(tv.clients_raw(spark, d), cols)

