"""I/O queries: partitioned lake round-trip, header-checked CSV round-trip, SQL table, run record."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fintide import config as C
from fintide.operators import model as ML
from fintide.operators import reports
from fintide.operators.clean import clean_clients, clean_holdings, client_rules, reconcile
from fintide.operators.enrich import enrich_clients
from fintide.operators.features import training_features
from fintide.operators.portfolio import portfolio_summary, summarise_holdings
from fintide.operators import metrics as M
from fintide.plans import views as V
from fintide.plans.catalog import register
from fintide.plans.oracle_views import with_views
from fintide.plans.q_clients import ENRICHED_COLS
from fintide.plans.q_ml import _QUOTA_CTE, FEATURE_TABLE_COLS, trained
from fintide.plans.q_portfolio import SUMMARY_COLS
from fintide.session import work_path, work_table
from fintide.sources import io
from fintide.sources import testviews as tv
from fintide.sources.merge import read_merged, schema_report
from fintide.sources.publish import VerificationError, partition_fingerprints, publish, release_old, verify, write_verified


def _cols(text: str) -> list[str]:
    return [c.strip() for c in text.split(",")]


@register("partitioned_roundtrip", with_views(f"SELECT {ENRICHED_COLS} FROM clients_enriched", "clients_enriched"))
def partitioned_roundtrip(spark, d):
    """Write the enriched clients partitioned by risk profile, read back with partition discovery."""
    path = work_path(spark, "clients")
    written = io.write_lake(V.clients_enriched(spark, d), path, ["risk_profile"])
    return io.read_back(spark, path, written).select(*_cols(ENRICHED_COLS))


@register("csv_roundtrip", with_views(f"SELECT {FEATURE_TABLE_COLS} FROM training_features", "training_features"))
def csv_roundtrip(spark, d):
    """Export the feature table as CSV with a header, read it back against the declared schema."""
    path = work_path(spark, "training_features_csv")
    io.write_csv(V.features(spark, d), path)
    return io.read_csv_checked(spark, path, C.TRAINING_FEATURES_SCHEMA)


@register("lake_sql_table", with_views(f"SELECT {SUMMARY_COLS} FROM portfolio_summary", "portfolio_summary"))
def lake_sql_table(spark, d):
    """Portfolio summary → partitioned table → external SQL table → verified read through SQL."""
    path = work_path(spark, "portfolios")
    written = io.write_lake(V.summary(spark, d), path, ["risk_profile"])
    name = io.register_table(spark, "wealth", work_table("wealth", f"portfolios_{path.rsplit('-', 1)[-1]}"), path,
                             "Portfolio summaries per client", partitioned=True)
    table = spark.table(name)
    n = table.count()
    if n != written:
        raise AssertionError(f"table {name} has {n} rows, wrote {written}")
    return table.select(*_cols(SUMMARY_COLS))


@register("run_record_roundtrip")
def run_record_roundtrip(spark, d):
    """Persist the model, reload it, score the held-out rows, and append a run record (JSON) — read back."""
    split, model = trained(spark, d)
    model_path = work_path(spark, "risk_model")
    ML.save_model(model, model_path)
    reloaded = ML.load_model(model_path)
    test = ML.score_features(reloaded, split.filter(F.col("split") == "test"))
    m = M.accuracy_and_macro_f1(test, "target", "predicted_profile").first()
    params = {"n_estimators": C.N_TREES, "max_depth": C.MAX_DEPTH, "min_samples": C.MIN_SAMPLES_SPLIT,
              "test_size": C.TEST_SIZE, "random_state": C.SEED, "features": ",".join(C.FEATURE_COLS),
              "model_path": model_path}
    metrics = {"accuracy": round(m["accuracy"], 4), "f1_score": round(m["macro_f1"], 4)}
    weights = {r["feature"]: r["importance"] for r in ML.importances(spark, model).collect()}  # one per feature
    runs = work_path(spark, "runs")
    io.write_records(ML.run_record(
        spark, model_path.rsplit("-", 1)[-1], params, metrics, split.filter(F.col("split") == "train").count(), m["n"],
        ML.class_labels(model), weights), runs)
    return io.read_records(spark, runs, ML.RUN_SCHEMA)


@register("run_record_facts", with_views(f"""
SELECT sum(n_test)::BIGINT AS test_rows, (sum(n_class) - sum(n_test))::BIGINT AS training_rows,
       '{",".join(C.RISK_CLASSES)}' AS classes, {len(C.FEATURE_COLS)}::INTEGER AS features
FROM quota""", "training_features", extra=[_QUOTA_CTE]))
def run_record_facts(spark, d):
    """What a read-back run record says about its rows, classes and features."""
    return run_record_roundtrip(spark, d).select(
        "test_rows", "training_rows", F.concat_ws(",", "classes").alias("classes"), F.size("importances").alias("features"))


@register("bucketed_features", with_views(f"SELECT {FEATURE_TABLE_COLS} FROM training_features",
                                          "training_features"))
def bucketed_features(spark, d):
    """Clients and the holdings roll-up land as tables bucketed by client_id; the feature join
    then reads both bucket-aligned and needs no exchange."""
    n = C.LAKE_BUCKETS
    clients_path, summary_path = work_path(spark, "clients_b"), work_path(spark, "summary_b")
    suffix = clients_path.rsplit("-", 1)[-1]
    spark.sql("CREATE DATABASE IF NOT EXISTS wealth")
    clients = io.write_bucketed(V.clients_enriched(spark, d), "wealth." + work_table("wealth", f"clients_b_{suffix}"), clients_path,
                                "client_id", n)
    summary = io.write_bucketed(summarise_holdings(V.holdings_clean(spark, d), as_of=C.FIXTURE_AS_OF),
                                "wealth." + work_table("wealth", f"summary_b_{suffix}"), summary_path, "client_id", n)
    return training_features(spark.table(summary), spark.table(clients))


@register("ingest_clients", with_views(f"SELECT {ENRICHED_COLS} FROM clients_enriched", "clients_enriched"))
def ingest_clients(spark, d):
    """Raw client CSV → declared schema → clean → enrich → partitioned table → verified read-back."""
    return _ingested_clients(spark, d)[1].select(*_cols(ENRICHED_COLS))


def _ingested_clients(spark, d):
    landing, lake = work_path(spark, "clients_csv"), work_path(spark, "clients_lake")
    io.write_csv(tv.clients_raw(spark, d), landing)
    raw = io.read_csv_checked(spark, landing, C.CLIENTS_RAW_SCHEMA)
    ready = enrich_clients(clean_clients(raw), as_of=C.FIXTURE_AS_OF, metros=C.FIXTURE_METROS)
    written = io.write_lake(ready, lake, ["risk_profile"])
    return raw, io.read_back(spark, lake, written)


@register("ingest_clients_report", with_views("""
SELECT (SELECT count(*) FROM clients_raw) AS raw_rows, count(*) AS lake_rows,
       (SELECT count(*) FROM clients_raw) - count(*) AS removed_rows FROM clients_enriched""", "clients_enriched"))
def ingest_clients_report(spark, d):
    """Rows read from the CSV files against rows read back from the table."""
    raw, lake = _ingested_clients(spark, d)
    n_raw, one = raw.agg(F.count(F.lit(1)).alias("raw_rows")), F.lit(1).alias("one")
    n_lake = lake.agg(F.count(F.lit(1)).alias("lake_rows"))
    return n_raw.select("*", one).join(n_lake.select("*", one), "one").select(
        "raw_rows", "lake_rows", (F.col("raw_rows") - F.col("lake_rows")).alias("removed_rows"))


@register("ingest_holdings", with_views(f"SELECT {SUMMARY_COLS} FROM portfolio_summary", "portfolio_summary"))
def ingest_holdings(spark, d):
    """Raw holdings CSV → declared schema → clean → roll-up joined to the written clients table → table → read-back."""
    landing, lake = work_path(spark, "holdings_csv"), work_path(spark, "holdings_lake")
    io.write_csv(tv.holdings_raw(spark, d), landing)
    held = clean_holdings(io.read_csv_checked(spark, landing, C.HOLDINGS_RAW_SCHEMA))
    _, clients = _ingested_clients(spark, d)
    written = io.write_lake(portfolio_summary(held, clients, as_of=C.FIXTURE_AS_OF), lake, ["risk_profile"])
    return io.read_back(spark, lake, written).select(*_cols(SUMMARY_COLS))


@register("inferred_csv", with_views(f"SELECT {FEATURE_TABLE_COLS} FROM training_features", "training_features"))
def inferred_csv(spark, d):
    """The exported feature table read without a declared schema; inferred types are brought to the declared ones."""
    path = work_path(spark, "features_csv")
    io.write_csv(V.features(spark, d), path)
    found = io.read_csv_inferred(spark, path)
    return found.select(*[F.col(f.name).cast(f.dataType) for f in C.TRAINING_FEATURES_SCHEMA])


# ------------------------------------------------------------------ files of differing schema


def _three_generations(spark, d) -> str:
    """A lake of transactions in three loads: the first without channel and label, with 32-bit numbers and short amounts;
    the second without the label; the third as declared."""
    path = work_path(spark, "txn_lake")
    rows = tv.transactions(spark, d).select("txn_id", F.substring("txn_id", 4, 64).cast("bigint").alias("number"), "client_id", "amount",
                                            "txn_ts", "channel", "is_flagged")
    day = F.dayofmonth("txn_ts")
    first = rows.filter(day <= 10).select("txn_id", F.col("number").cast("int"), "client_id", F.col("amount").cast("decimal(12,2)"), "txn_ts")
    second = rows.filter((day > 10) & (day <= 20)).drop("is_flagged")
    for load, part in enumerate((first, second, rows.filter(day > 20)), 1):
        part.write.mode("append").parquet(f"{path}/load={load}")
    return path


_LOADED = ("loaded", """
  SELECT *, CASE WHEN day(txn_ts) <= 10 THEN 1 WHEN day(txn_ts) <= 20 THEN 2 ELSE 3 END::INTEGER AS load FROM transactions""")


@register("merged_lake", with_views("""
SELECT txn_id, CAST(substr(txn_id, 4) AS BIGINT) AS number, client_id, CAST(amount AS DOUBLE) AS amount, txn_ts,
       CASE WHEN load >= 2 THEN channel END AS channel, CASE WHEN load = 3 THEN is_flagged END AS is_flagged, load
FROM loaded""", "transactions", extra=[_LOADED]))
def merged_lake(spark, d):
    """Three schema generations read as one table: the union of their columns, in the widest of their types."""
    return read_merged(spark, _three_generations(spark, d)).withColumn("amount", F.col("amount").cast("double"))


@register("merged_lake_report", with_views("""
SELECT l.load, c.name AS column, c.lake_type,
       CASE WHEN l.load < c.since THEN 'missing' WHEN l.load = 1 AND c.name IN ('number', 'amount') THEN 'widened' ELSE 'same' END AS status, l.n_rows
FROM (SELECT load, count(*) AS n_rows FROM loaded GROUP BY load) l,
     (VALUES ('txn_id', 'string', 1), ('number', 'bigint', 1), ('client_id', 'string', 1), ('amount', 'decimal(18,2)', 1),
             ('txn_ts', 'timestamp_ntz', 1), ('channel', 'string', 2), ('is_flagged', 'boolean', 3)) c(name, lake_type, since)""",
                                             "transactions", extra=[_LOADED]))
def merged_lake_report(spark, d):
    """Which load lacks or widens which column, with the rows it concerns."""
    path = _three_generations(spark, d)
    rows = read_merged(spark, path).groupBy("load").agg(F.count(F.lit(1)).alias("n_rows"))
    found = schema_report(spark, path).select(F.regexp_extract("file", r"/load=(\d+)/", 1).cast("int").alias("load"), "column", "lake_type", "status")
    return found.distinct().join(rows, "load")


# ------------------------------------------------------------------ malformed lines, verification, publication


_BROKEN = [("rows", """
  SELECT *, CAST(substr(client_id, 4) AS BIGINT) AS n FROM clients_raw""")]


def _landed_with_faults(spark, d) -> str:
    """Client CSV, with lines of some clients spoilt: an age that is no number, the last field cut off, a field too many."""
    path = work_path(spark, "clients_faulty")
    io.write_csv(tv.clients_raw(spark, d), f"{path}/all")
    # A large file is read by several tasks, and each writes a file of its own: every one needs the header line.
    header = ",".join(C.CLIENTS_RAW_SCHEMA.fieldNames())
    lines = spark.read.text(f"{path}/all").filter(F.col("value") != header)
    number = F.regexp_extract("value", r"^CLT(\d+),", 1)
    n = F.when(number != "", number.cast("bigint"))
    fields = F.split("value", ",")
    bad = (F.when(n % 31 == 0, F.concat_ws(",", F.slice(fields, 1, 5), F.lit("abc"), F.slice(fields, 7, 99)))
           .when(n % 37 == 0, F.substring_index("value", ",", 10)).when(n % 41 == 0, F.concat("value", F.lit(",more"))))
    landed = lines.select(F.coalesce(bad, F.col("value")).alias(header))  # whole lines as one column: neither split nor quoted
    (landed.write.option("header", True).option("sep", "\x01").option("quote", "").option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(f"{path}/landed"))
    return f"{path}/landed"


@register("ingest_quarantine_report", with_views("""
SELECT count(*) AS raw_rows, CAST(count_if(NOT bad AND keep) AS BIGINT) AS clean_rows, CAST(count_if(NOT bad AND NOT keep) AS BIGINT) AS removed_rows,
       CAST(count_if(bad) AS BIGINT) AS malformed_rows
FROM (SELECT n % 31 = 0 OR n % 37 = 0 OR n % 41 = 0 AS bad,
             coalesce(client_id IS NOT NULL AND aum > 0 AND age BETWEEN 18 AND 100, false) AS keep FROM rows) r""", "clients_raw", extra=_BROKEN))
def ingest_quarantine_report(spark, d):
    """Every landed line is clean, removed by a rule or malformed."""
    rows, bad = io.read_csv_quarantined(spark, _landed_with_faults(spark, d), C.CLIENTS_RAW_SCHEMA)
    counts = reconcile(rows, client_rules()).select("raw_rows", "clean_rows", "removed_rows", F.lit(1).alias("one"))
    malformed = bad.agg(F.count(F.lit(1)).alias("malformed_rows")).withColumn("one", F.lit(1))
    return counts.join(malformed, "one").select((F.col("raw_rows") + F.col("malformed_rows")).alias("raw_rows"), "clean_rows", "removed_rows",
                                                "malformed_rows")


@register("ingest_quarantined_clients", with_views("""
SELECT client_id, 'quarantined' AS outcome FROM rows WHERE n % 31 = 0 OR n % 37 = 0 OR n % 41 = 0
UNION ALL
SELECT e.client_id, 'lake' FROM clients_enriched e JOIN rows r ON r.client_id = e.client_id
WHERE NOT (n % 31 = 0 OR n % 37 = 0 OR n % 41 = 0)""", "clients_enriched", extra=_BROKEN))
def ingest_quarantined_clients(spark, d):
    """Where every landed client went: the lake, or the quarantine table with its line."""
    rows, bad = io.read_csv_quarantined(spark, _landed_with_faults(spark, d), C.CLIENTS_RAW_SCHEMA)
    path = work_path(spark, "clients_landed")
    ready = enrich_clients(clean_clients(rows), as_of=C.FIXTURE_AS_OF, metros=C.FIXTURE_METROS)
    lake = verify(spark, f"{path}/lake", write_verified(ready, f"{path}/lake", ["risk_profile"]))
    quarantine = verify(spark, f"{path}/quarantine", write_verified(bad, f"{path}/quarantine"))
    return lake.select("client_id", F.lit("lake").alias("outcome")).unionByName(
        quarantine.select(F.substring_index("line", ",", 1).alias("client_id"), F.lit("quarantined").alias("outcome")))


@register("lake_partition_counts", with_views("""
SELECT risk_profile, count(*) AS rows, true AS intact FROM clients_enriched GROUP BY risk_profile""", "clients_enriched"))
def lake_partition_counts(spark, d):
    """Rows per partition of a written table, and whether every cell is as it was before the write."""
    path, source = work_path(spark, "clients_fp"), V.clients_enriched(spark, d)
    lake = verify(spark, path, write_verified(source, path, ["risk_profile"]))
    before = partition_fingerprints(source, ["risk_profile"]).select("risk_profile", F.col("fingerprint").alias("was"))
    return partition_fingerprints(lake, ["risk_profile"]).join(before, "risk_profile").select(
        "risk_profile", "rows", (F.col("fingerprint") == F.col("was")).alias("intact"))


@register("published_portfolios", with_views(f"""
SELECT 'before' AS seen, {SUMMARY_COLS} FROM portfolio_summary WHERE risk_profile <> 'Aggressive'
UNION ALL SELECT 'after a failed load', {SUMMARY_COLS} FROM portfolio_summary WHERE risk_profile <> 'Aggressive'
UNION ALL SELECT 'after the next load', {SUMMARY_COLS} FROM portfolio_summary""", "portfolio_summary"))
def published_portfolios(spark, d):
    """What a reader of the published name sees: the first load, the same rows after a load that fails its rules, then the next load."""
    summary, root = V.summary(spark, d).checkpoint(), work_path(spark, "published")
    name = f"portfolios_{root.rsplit('-', 1)[-1]}"

    def seen(label):  # read by name; kept, since the name shows other rows later
        return spark.table(f"wealth.{name}").select(F.lit(label).alias("seen"), *_cols(SUMMARY_COLS)).checkpoint()

    def load(rows):
        return publish(rows, "wealth", name, root, ["risk_profile"], required=["client_id"])

    load(summary.filter("risk_profile <> 'Aggressive'"))
    views = [seen("before")]
    try:
        load(summary.withColumn("client_id", F.when(F.col("equity_pct") < F.col("debt_pct"), F.col("client_id"))))
    except VerificationError:
        views.append(seen("after a failed load"))
    last = load(summary)
    views.append(seen("after the next load"))
    release_old(spark, "wealth", name, last)  # what was seen is kept: the catalog needs neither the name nor its versions any more
    spark.sql(f"DROP VIEW wealth.{name}")
    spark.sql(f"DROP TABLE wealth.{name}__{last}")
    return reduce(DataFrame.unionByName, views)


FOOTER_COLS = ["age", "aum", "onboarded_date", "data_quality_score", "is_high_value"]


@register("footer_profile", with_views("SELECT risk_profile, count(*) AS num_records, " + ", ".join(
    f"min({c}) AS min_{c}, max({c}) AS max_{c}, count(*) - count({c}) AS nulls_{c}" for c in FOOTER_COLS) + """
FROM clients_enriched GROUP BY risk_profile""", "clients_enriched"))
def footer_profile(spark, d):
    """Rows, minima, maxima and NULL counts per partition of the written table, from file footers alone."""
    path = work_path(spark, "clients_profiled")
    io.write_lake(V.clients_enriched(spark, d), path, ["risk_profile"], fmt="parquet")
    return reports.footer_profile(spark, path, "risk_profile", FOOTER_COLS)
