import datetime as dt


from fintide import config as C
from fintide.operators.clean import client_rules, clean_clients, reconcile
from fintide.operators.enrich import enrich_clients


def _clients(spark, rows):
    return spark.createDataFrame(rows, C.CLIENTS_RAW_SCHEMA)


def _row(cid, age=40, aum=1_000.0, city=" mumbai ", kyc=" verified", date="2020-01-01", email=" A@B.COM "):
    return (cid, " jane doe ", email, "+9100", city, age, " moderate ", aum, date, "ADV001", kyc)


def test_age_filter_and_buckets(spark):
    ages = [17, 18, 34, 35, 54, 55, 100, 101, None]
    df = _clients(spark, [_row(f"C{i}", age=a) for i, a in enumerate(ages)])
    out = enrich_clients(clean_clients(df), as_of="2026-06-24").orderBy("age").collect()
    assert [r.age for r in out] == [18, 34, 35, 54, 55, 100]
    assert [r.age_group for r in out] == ["Young", "Young", "Middle-Aged", "Middle-Aged", "Senior", "Senior"]


def test_aum_tiers_and_high_value(spark):
    aums = [-1.0, 0.0, 499_999.99, 500_000.0, 999_999.0, 1_000_000.0, 4_999_999.0, 5_000_000.0]
    df = _clients(spark, [_row(f"C{i}", aum=a) for i, a in enumerate(aums)])
    out = enrich_clients(clean_clients(df), as_of="2026-06-24").orderBy("aum").collect()
    assert [r.aum for r in out] == aums[2:]
    assert [r.aum_tier for r in out] == ["Mass", "HNI", "HNI", "HNI", "HNI", "UHNI"]
    assert [r.is_high_value for r in out] == [False, False, False, True, True, True]


def test_text_cleaning_defaults_and_bad_dates(spark):
    df = _clients(spark, [_row("C1", city="   ", kyc=None, date="not-a-date", email=None),
                          _row("C2", city="delhi-ncr", kyc="rejected", date=None)])
    out = {r.client_id: r for r in clean_clients(df).collect()}
    assert out["C1"].city == "Unknown" and out["C1"].kyc_status == "PENDING"
    assert out["C1"].onboarded_date is None and out["C1"].name == "Jane Doe"
    assert out["C2"].city == "Delhi-ncr"  # capitalised after whitespace only
    assert out["C2"].kyc_status == "REJECTED" and out["C2"].email == "a@b.com"
    assert out["C1"].risk_profile == "Moderate"


def test_quality_score_and_city_tier(spark):
    df = _clients(spark, [_row("C1"), _row("C2", city=None, kyc="pending", date="x", email=None)])
    out = {r.client_id: r for r in enrich_clients(clean_clients(df), as_of="2026-06-24").collect()}
    assert out["C1"].data_quality_score == 5 and out["C1"].city_tier == "Tier1"
    assert out["C2"].data_quality_score == 1 and out["C2"].city_tier == "Tier2"


def test_tenure_golden(spark):
    df = _clients(spark, [_row("C1", date="2019-01-01"), _row("C2", date="2023-12-31")])
    out = {r.client_id: r.years_since_onboard
           for r in enrich_clients(clean_clients(df), as_of=dt.date(2026, 6, 24)).collect()}
    assert out == {"C1": 7.5, "C2": 2.5}


def test_reconcile_counts_each_rule(spark):
    df = _clients(spark, [_row(None), _row("C1", aum=0.0), _row("C2", age=101), _row("C3"),
                          _row("C4", age=None, aum=-5.0)])
    r = reconcile(df, client_rules()).first()
    assert (r.raw_rows, r.clean_rows, r.removed_rows) == (5, 1, 4)
    assert (r.failed_client_id_present, r.failed_aum_positive, r.failed_age_in_range) == (1, 2, 2)
    assert clean_clients(df).count() == r.clean_rows
