"""Spark-side building blocks shared by the catalogue queries (lazy, whole tables).

Each view is a lazy DataFrame, built anew by every call: nothing is remembered
between queries, so files that change are read as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fintide import config as C
from fintide.operators.clean import clean_clients, clean_holdings
from fintide.operators.enrich import enrich_clients
from fintide.operators.features import training_features
from fintide.operators.portfolio import portfolio_summary, summarise_holdings
from fintide.sources import testviews as tv

AS_OF = C.FIXTURE_AS_OF
METROS = C.FIXTURE_METROS

def clients_clean(spark: SparkSession, d: str) -> DataFrame:
    return tv.clients_raw(spark, d).transform(clean_clients)


def clients_enriched(spark: SparkSession, d: str) -> DataFrame:
    return clients_clean(spark, d).transform(enrich_clients, as_of=AS_OF, metros=METROS)


def holdings_clean(spark: SparkSession, d: str) -> DataFrame:
    return tv.holdings_raw(spark, d).transform(clean_holdings)


def summary(spark: SparkSession, d: str) -> DataFrame:
    return portfolio_summary(holdings_clean(spark, d), clients_enriched(spark, d), as_of=AS_OF)


def features(spark: SparkSession, d: str) -> DataFrame:
    # The bare roll-up joined once to the clients (the summary's own left join to the
    # same clients would be a second join with an identical outcome for inner-joined rows).
    return training_features(summarise_holdings(holdings_clean(spark, d), as_of=AS_OF), clients_enriched(spark, d))


def features_with_gaps(spark: SparkSession, d: str) -> DataFrame:
    """The feature table with NULLs put into every feature (by client number), for imputation."""
    n = F.substring("client_id", 4, 64).cast("bigint")
    return features(spark, d).withColumns(
        {c: F.when(n % (5 + i) != 0, F.col(c)) for i, c in enumerate(C.FEATURE_COLS)})
