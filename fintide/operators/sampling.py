"""Deterministic sampling, shuffling and weighted assignment driven by md5 hashes.

Hash-based randomness (md5 of 'id:seed') gives the same draw on every engine
and on every re-execution of a task, so a lost executor recomputes exactly the
same rows — unlike ``rand()`` over a changed partitioning.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fintide import config as C
from fintide.functions.columns import hash_hex, hash_uniform, pick_weighted
from fintide.operators.features import first_in_order, rank_within


def sample_n(df: DataFrame, id_col: str, n: int, seed: int = C.SEED) -> DataFrame:
    """Exactly ``n`` rows (or all, if fewer): the first n in md5(id:seed) order — a sampling operator.

    Whole hash buckets are taken until ``n`` cuts one; only that bucket is ranked.
    """
    hashed = df.withColumn("_h", hash_hex(id_col, seed=seed)).withColumn("_all", F.lit(0))
    return first_in_order(hashed, ["_all"], "_h", [id_col], F.lit(n), "_in").filter("_in").select(*df.columns)


def shuffle(df: DataFrame, id_col: str, seed: int = C.SEED, position: str = "position") -> DataFrame:
    """Seeded full shuffle: every row gets its 1-based position in md5(id:seed) order (distributed rank)."""
    h = df.withColumn("_h", hash_hex(id_col, seed=seed)).withColumn("_all", F.lit(0))
    return rank_within(h, ["_all"], "_h", [id_col], position).drop("_h", "_all")


def assign_weighted(df: DataFrame, id_col: str, choices: Sequence[tuple[str, float]], out: str,
                    seed: int = C.SEED) -> DataFrame:
    """Categorical draw per row with the given weights (cumulative thresholds on a hash uniform)."""
    return df.withColumn(out, pick_weighted(hash_uniform(id_col, seed=seed), choices))


def expand_allocation(df: DataFrame, id_col: str = "client_id", profile_col: str = "risk_profile",
                      pools: Mapping[str, Sequence[tuple[str, int]]] = C.ALLOCATION_POOLS,
                      sizes: tuple[int, int] = C.HOLDINGS_PER_CLIENT, seed: int = C.SEED,
                      fallback: str = C.FALLBACK_POOL) -> DataFrame:
    """1 → N: each row becomes between sizes[0] and sizes[1] slots, each drawing a fund type from its pool.

    A profile without a pool of its own (NULL included) draws from the ``fallback`` pool.
    """
    lo, hi = sizes
    n = (F.lit(lo) + F.floor(hash_uniform(id_col, F.lit("n"), seed=seed) * (hi - lo + 1))).cast("int")
    slots = df.select(id_col, profile_col, F.explode(F.sequence(F.lit(1), n)).alias("slot"))
    u = hash_uniform(id_col, F.col("slot"), seed=seed)
    kind = pick_weighted(u, [(t, float(w)) for t, w in pools[fallback]])
    for profile, pool in pools.items():
        if profile != fallback:
            choice = pick_weighted(u, [(t, float(w)) for t, w in pool])
            kind = F.when(F.col(profile_col) == profile, choice).otherwise(kind)
    return slots.withColumn("fund_type", kind)


def expand_to_funds(slots: DataFrame, funds: DataFrame, id_col: str = "client_id", type_col: str = "fund_type",
                    fund_col: str = "fund_id", seed: int = C.SEED) -> DataFrame:
    """Each slot of ``expand_allocation`` draws one fund of its type; a slot whose type has no fund keeps its row with a NULL fund.

    Funds of a type are numbered in md5 order and a slot's uniform picks a
    number, so the draw is one equi-join on (type, number).
    """
    numbered = rank_within(funds.select(type_col, fund_col).withColumn("_h", hash_hex(fund_col, seed=seed)), [type_col], "_h",
                           [fund_col], "_n").drop("_h")
    sizes = funds.groupBy(type_col).agg(F.count(F.lit(1)).alias("_size"))
    u = hash_uniform(id_col, F.col("slot"), F.lit("fund"), seed=seed)
    return (slots.join(sizes, on=type_col, how="left").withColumn("_n", F.floor(u * F.col("_size")) + 1)
            .join(numbered, on=[type_col, "_n"], how="left").drop("_n", "_size"))


def unfilled(drawn: DataFrame, type_col: str = "fund_type", fund_col: str = "fund_id") -> DataFrame:
    """Per type: slots, and slots that found no fund."""
    return drawn.groupBy(type_col).agg(F.count(F.lit(1)).alias("slots"), F.count_if(F.col(fund_col).isNull()).alias("unfilled"))
