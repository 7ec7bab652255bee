"""Business-shaped views over the driver's test tables.

The driver's tables are TPC-H-like; the jobs in this package expect client,
holding, transaction and fund-NAV tables.  These views derive those tables
from the test tables with plain joins and projections (FIXTURES.md §2), and
deliberately inject the dirt the cleaners must handle: NULL keys, padded and
mixed-case text, malformed dates, out-of-range ages, non-positive amounts.

Everything here is a lazy DataFrame over the parquet files, so it scales with
the tables; the joins are equi-joins Catalyst plans itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Fixed values of the fixture specification.
SEGMENT_RISK = [
    ("AUTOMOBILE", "aggressive "),
    ("BUILDING", " CONSERVATIVE"),
    ("FURNITURE", "moderate"),
    ("MACHINERY", "Moderate"),
]  # HOUSEHOLD -> NULL
PART_TYPE_FUND = [
    ("STANDARD", "Equity"),
    ("LARGE", " EQUITY"),
    ("ECONOMY", "Debt "),
    ("SMALL", "debt"),
    ("PROMO", "GOLD"),
    ("MEDIUM", "Hybrid"),
]
EVENT_TXN_TYPE = [("view", "SIP"), ("click", "SIP"), ("purchase", "BUY"), ("signup", "DIVIDEND"),
                  ("error", "SELL")]
EVENT_CHANNEL = [("error", "API"), ("purchase", "API"), ("view", "APP"), ("click", "WEB"),
                 ("signup", "ADVISOR")]


SCAN_PARTITIONS = "spark.fintide.scanPartitions"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan of one test table.

    The test tables are single files of one row group, that is one task.  A
    caller that wants them spread says so with ``spark.fintide.scanPartitions``
    (bench does); tables laid out in many files need no such shuffle.
    """
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    parts = int(spark.conf.get(SCAN_PARTITIONS, "0"))
    return df.repartition(parts) if parts > 1 else df


def _lookup(col: Column, pairs) -> Column:
    expr = None
    for key, value in pairs:
        expr = F.when(col == key, F.lit(value)) if expr is None else expr.when(col == key, F.lit(value))
    return expr


def padded_id(prefix: str, col: Column, width: int) -> Column:
    """prefix + zero-padded number; wider numbers are kept whole (lpad alone would truncate them)."""
    txt = col.cast("string")
    return F.concat(F.lit(prefix), F.when(F.length(txt) >= width, txt).otherwise(F.lpad(txt, width, "0")))


def clients_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer ⋈ nation ⟕ (first order date per customer) → raw client master rows."""
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    first_order = (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(F.min("o_orderdate").alias("first_order"))
    )
    k = F.col("c_custkey")
    key_txt = k.cast("string")
    rows = customer.join(nation, customer.c_nationkey == nation.n_nationkey).join(
        first_order, k == first_order.o_custkey, "left"
    )
    return rows.select(
        padded_id("CLT", k, 7).alias("client_id"),
        F.concat(F.lit("  "), F.upper("c_name"), F.lit(" ")).alias("name"),
        F.when(k % 11 != 0, F.concat(F.upper(F.translate("c_name", "#", ".")), F.lit("@EXAMPLE.COM ")))
        .alias("email"),
        F.when(
            k % 13 != 0,
            F.concat(F.lit("+91"), F.when(F.length(key_txt) >= 10, key_txt).otherwise(F.lpad(key_txt, 10, "6"))),
        ).alias("phone"),
        F.when(k % 17 == 0, F.lit(None).cast("string"))
        .when(k % 17 == 1, F.lit("   "))
        .otherwise(F.concat(F.lit(" "), F.lower("n_name")))
        .alias("city"),
        F.when(k % 97 != 0, (F.lit(15) + k % 90).cast("int")).alias("age"),
        _lookup(F.col("c_mktsegment"), SEGMENT_RISK).alias("risk_profile"),
        (F.col("c_acctbal") * 1000).alias("aum"),
        F.when(k % 19 == 0, F.lit("not-a-date"))
        .otherwise(F.date_format("first_order", "yyyy-MM-dd"))
        .alias("onboarded_date"),
        F.when(k % 23 != 0, F.concat(F.lit("ADV"), F.lpad((F.lit(1) + k % 50).cast("string"), 3, "0")))
        .alias("advisor_id"),
        F.when(k % 20 < 17, F.lit(" verified"))
        .when(k % 20 == 18, F.lit("PENDING"))
        .when(k % 20 == 19, F.lit("rejected"))
        .alias("kyc_status"),
    )


def _line_orders_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        "l_shipdate",
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand")
    return lineitem.join(orders, lineitem.l_orderkey == orders.o_orderkey).join(
        part, lineitem.l_partkey == part.p_partkey
    )


def holdings_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem ⋈ orders ⋈ part → raw fund holdings (one row per line)."""
    rows = _line_orders_part(spark, sf_dir)
    current = F.expr(
        "cast(cast(l_extendedprice as decimal(18,2)) * (1 - cast(l_discount as decimal(4,2)))"
        " * (1 + cast(l_tax as decimal(4,2))) as decimal(18,2))"
    )
    return rows.select(
        F.concat(F.lit("PRT"), F.col("l_orderkey").cast("string"), F.lit("-"),
                 F.col("l_linenumber").cast("string")).alias("portfolio_id"),
        F.when(F.col("l_orderkey") % 101 != 0, padded_id("CLT", F.col("o_custkey"), 7)).alias("client_id"),
        F.col("l_partkey").cast("string").alias("fund_id"),
        _lookup(F.substring_index("p_type", " ", 1), PART_TYPE_FUND).alias("fund_type"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("invested_amt"),
        F.when(F.col("l_linenumber") == 7, F.lit(0).cast("decimal(18,2)")).otherwise(current)
        .alias("current_value"),
        F.col("l_quantity").alias("num_units"),
        F.when(F.col("l_orderkey") % 89 == 0, F.lit("True"))
        .otherwise(F.date_format("l_shipdate", "yyyy-MM-dd"))
        .alias("purchase_date"),
    )


def holdings_priced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Holdings as units of a named fund bought on a date (the generated layout), for valuation."""
    rows = _line_orders_part(spark, sf_dir)
    return rows.select(
        F.concat(F.lit("PRT"), F.col("l_orderkey").cast("string"), F.lit("-"),
                 F.col("l_linenumber").cast("string")).alias("portfolio_id"),
        padded_id("CLT", F.col("o_custkey"), 7).alias("client_id"),
        F.col("p_brand").alias("fund_name"),
        F.col("l_quantity").alias("units"),
        F.col("o_orderdate").cast("date").alias("buy_date"),
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events → fund transactions (type, amount, channel, fraud label)."""
    ev = table(spark, sf_dir, "events")
    et = F.col("event_type")
    return ev.select(
        padded_id("TXN", F.col("event_id"), 7).alias("txn_id"),
        padded_id("CLT", F.col("user_id"), 7).alias("client_id"),
        F.concat(F.lit("Brand#"), (F.lit(1) + F.col("event_id") % 25).cast("string")).alias("fund_name"),
        _lookup(et, EVENT_TXN_TYPE).alias("txn_type"),
        (F.col("value").cast("decimal(18,2)") * 10000).cast("decimal(18,2)").alias("amount"),
        F.col("ts").alias("txn_ts"),
        _lookup(et, EVENT_CHANNEL).alias("channel"),
        ((F.col("value") > 100) & (F.col("event_id") % 3 != 0)).alias("is_flagged"),
    )


def fund_nav(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem ⋈ part grouped by (brand, ship date) → one NAV per fund per day (weekends included)."""
    lineitem = table(spark, sf_dir, "lineitem").select("l_partkey", "l_extendedprice", "l_quantity",
                                                       "l_shipdate")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return (
        lineitem.join(part, lineitem.l_partkey == part.p_partkey)
        .groupBy(F.col("p_brand").alias("fund_name"), F.col("l_shipdate").cast("date").alias("nav_date"))
        .agg(
            (F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double")
             / F.sum("l_quantity")).alias("nav")
        )
    )


def funds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part → fund dimension (id, code, name, category)."""
    part = table(spark, sf_dir, "part")
    return part.select(
        F.col("p_partkey").cast("string").alias("fund_id"),
        padded_id("FND", F.col("p_partkey"), 6).alias("fund_code"),
        F.col("p_brand").alias("fund_name"),
        F.initcap(F.substring_index("p_type", " ", 1)).alias("category"),
        F.initcap(F.trim(_lookup(F.substring_index("p_type", " ", 1), PART_TYPE_FUND))).alias("fund_type"),
    )
