import pytest

from fintide import config as C
from fintide.plans import views as V
from fintide.session import work_path
from fintide.sources import io

from conftest import SF_SMALL


def test_csv_header_mismatch_fails_clearly(spark):
    path = work_path(spark, "bad_csv")
    df = spark.createDataFrame([("P1", "C1", "Fund", "Equity", 1.0, 2.0, "2020-01-01", True)],
                               "portfolio_id string, client_id string, fund_name string, fund_type string, "
                               "units double, buy_price double, buy_date string, sip_active boolean")
    io.write_csv(df, path)
    with pytest.raises(io.HeaderMismatch):
        io.read_csv_checked(spark, path, C.HOLDINGS_RAW_SCHEMA)


def test_partitioned_roundtrip_prunes_partitions(spark):
    src = V.clients_enriched(spark, SF_SMALL)
    path = work_path(spark, "clients_t")
    n = io.write_lake(src, path, ["risk_profile"])
    back = io.read_back(spark, path, n)
    assert back.exceptAll(src.select(*back.columns)).count() == 0
    plan = back.filter("risk_profile = 'Aggressive'").select("client_id")._jdf.queryExecution().executedPlan()
    text = plan.toString()
    assert "PartitionFilters: [isnotnull(risk_profile" in text and "ReadSchema: struct<client_id:string>" in text
    with pytest.raises(AssertionError):
        io.read_back(spark, path, n + 1)


def test_sql_table_over_files(spark):
    path = work_path(spark, "portfolios_t")
    n = io.write_lake(V.summary(spark, SF_SMALL), path, ["risk_profile"])
    name = io.register_table(spark, "wealth_test", "portfolios", path, "test", partitioned=True)
    assert spark.table(name).count() == n
    assert "risk_profile" in spark.table(name).columns


def test_bucketed_tables_join_without_exchange(spark):
    from fintide.operators.features import training_features
    from fintide.operators.portfolio import summarise_holdings

    spark.sql("CREATE DATABASE IF NOT EXISTS wealth_test")
    c = io.write_bucketed(V.clients_enriched(spark, SF_SMALL), "wealth_test.clients_b", work_path(spark, "cb"),
                          "client_id", 4)
    s = io.write_bucketed(summarise_holdings(V.holdings_clean(spark, SF_SMALL)), "wealth_test.summary_b",
                          work_path(spark, "sb"), "client_id", 4)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # the large-table case
    try:
        df = training_features(spark.table(s), spark.table(c))
        qe = df._jdf.queryExecution()
        qe.toRdd().count()
        plan = qe.executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin" in plan and "Exchange hashpartitioning" not in plan


def test_recovery_failure_is_raised(spark):
    path = work_path(spark, "flat_t")
    io.write_lake(spark.range(3).toDF("id"), path)
    with pytest.raises(Exception, match="(?i)partition"):
        io.register_table(spark, "wealth_test", "flat", path, partitioned=True)
    assert spark.table(io.register_table(spark, "wealth_test", "flat", path)).count() == 3


def test_shared_folder_must_be_named_on_a_cluster():
    from fintide.session import ensure_checkpoint_dir

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        def __init__(self, master):
            self.master, self.dir = master, None

        def getCheckpointDir(self):
            return self.dir

        def setCheckpointDir(self, path):
            self.dir = path

    class Session:
        def __init__(self, master):
            self.conf, self.sparkContext = Conf(), Context(master)

    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]", "k8s://x"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            ensure_checkpoint_dir(Session(master))
    assert ensure_checkpoint_dir(Session("local[2]"))


def test_clear_work_removes_tables_and_folders(spark):
    from fintide.session import clear_work, work_table

    path = work_path(spark, "gone")
    n = io.write_lake(spark.range(3).toDF("id"), path)
    name = io.register_table(spark, "wealth_test", work_table("wealth_test", "gone"), path)
    assert spark.table(name).count() == n
    clear_work(spark)
    assert not spark.catalog.tableExists("wealth_test.gone")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_a_job_leaves_only_its_result(spark):
    from fintide.session import work_scope

    kept = []
    with work_scope(spark, lambda: kept):
        for name in ("one", "two", "result"):
            path = work_path(spark, name)
            spark.range(4).write.parquet(path)
        kept.append(path)
    assert spark.read.parquet(path).count() == 4
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path.replace("result", "one"))
    with pytest.raises(ZeroDivisionError), work_scope(spark):
        other = work_path(spark, "failed")
        spark.range(4).write.parquet(other)
        1 / 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(other)
