"""Business buckets and flags on the cleaned client table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fintide import config as C
from fintide.functions.columns import bucketize, score, years_between


def enrich_clients(df: DataFrame, as_of: dt.date | str | None = None,
                   metros: Sequence[str] = tuple(C.TIER1_CITIES)) -> DataFrame:
    """Add age_group, aum_tier, years_since_onboard, city_tier, is_high_value, data_quality_score.

    ``as_of`` pins the tenure reference day (default: today) so results are reproducible.
    All six columns are one projection.
    """
    verified = F.col("kyc_status") == C.KYC_VERIFIED
    return df.withColumns(
        {
            "age_group": bucketize("age", C.AGE_BUCKETS, C.AGE_OTHERWISE),
            "aum_tier": bucketize("aum", C.AUM_BUCKETS, C.AUM_OTHERWISE),
            "years_since_onboard": years_between("onboarded_date", as_of),
            "city_tier": F.when(F.col("city").isin(list(metros)), F.lit("Tier1")).otherwise(F.lit("Tier2")),
            "is_high_value": (F.col("aum") >= C.HIGH_VALUE_AUM) & verified,
            "data_quality_score": score(
                [
                    F.col("email").isNotNull(),
                    F.col("phone").isNotNull(),
                    F.col("city") != "Unknown",
                    verified,
                    F.col("onboarded_date").isNotNull(),
                ]
            ),
        }
    )
