"""Feature table, exact median imputation, exact stratified split, class weights.

Scale notes
-----------
* ``F.median`` / ``percentile`` buffers every distinct value of a group in one
  task.  ``exact_medians`` instead brackets the middle ranks of all columns
  with ``percentile_approx`` (a bounded sketch) in one aggregate, counts what
  lies below and on the bracket ends in a second one, and repeats on the open
  brackets, which lose at least their ends each time.  The driver sees scalars.
* A per-class ``row_number`` window would put a whole class (possibly a third
  of the table) in one task.  Hash orders are ranked through fixed buckets
  instead: the first ``BUCKET_DIGITS`` hex digits of the md5 that defines the
  order.  Bucket counts per group give every bucket's first rank, and a row is
  ranked only among its bucket.  Nothing depends on how the rows are
  partitioned, so re-execution, other core counts and pruned columns give the
  same ranks.
"""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fintide import config as C
from fintide.functions.columns import age_group_code, hash_hex


def training_features(summary: DataFrame, clients: DataFrame,
                      classes: Sequence[str] = tuple(C.RISK_CLASSES)) -> DataFrame:
    """Portfolio summary ⋈ clients (inner) → the 7 model features + target.

    ``summary`` may be the bare per-client roll-up: the target is the client's
    risk profile (taken from the summary when it carries one, otherwise from
    the client table, which is equal for every joined client).
    """
    c = clients.select("client_id", "aum", "age_group", F.col("risk_profile").alias("_client_risk"))
    target = F.col("risk_profile") if "risk_profile" in summary.columns else F.col("_client_risk")
    s = summary.select("client_id", "equity_pct", "debt_pct", "gold_pct", "total_num_funds", "years_invested",
                       *(["risk_profile"] if "risk_profile" in summary.columns else []))
    return (
        s.join(c, on="client_id", how="inner")
        .withColumn("target", target)
        .filter(F.col("target").isin(list(classes)))
        .dropna(how="any", subset=["equity_pct", "debt_pct", "gold_pct"])
        .select(
            "client_id", "equity_pct", "debt_pct", "gold_pct", "total_num_funds", "years_invested",
            F.round(F.col("aum") / C.LAKH, 2).alias("aum_lakh"),
            age_group_code("age_group").alias("age_group_encoded"),
            "target",
        )
    )


# ---------------------------------------------------------------- medians


class _Rank:
    """One wanted rank of one column: an open bracket (lo, hi) around it, or its value once found."""

    def __init__(self, column: int, rank: int, n: int):
        self.column, self.rank = column, rank
        self.lo = self.hi = None
        self.below, self.inside = 0, n
        self.value: float | None = None

    def within(self, x: Column) -> Column:
        inside = x.isNotNull()
        if self.lo is not None:
            inside = inside & (x > F.lit(self.lo))
        if self.hi is not None:
            inside = inside & (x < F.lit(self.hi))
        return inside

    def narrow(self, lo: float, hi: float, lt_lo: int, le_lo: int, lt_hi: int, le_hi: int) -> None:
        """Counts (inside the bracket) below and up to two of its values decide where the rank is."""
        k = self.rank - self.below
        if lt_lo <= k < le_lo:
            self.value = lo
        elif lt_hi <= k < le_hi:
            self.value = hi
        elif k < lt_lo:
            self.hi, self.inside = lo, lt_lo
        elif k >= le_hi:
            self.lo, self.below, self.inside = hi, self.below + le_hi, self.inside - le_hi
        else:
            self.lo, self.hi, self.below, self.inside = lo, hi, self.below + le_lo, lt_hi - le_lo


def exact_medians(df: DataFrame, cols: Sequence[str], accuracy: int = 10_000) -> dict[str, float | None]:
    """Exact median (interpolated halfway between the two middle values for even counts) per column.

    All columns share two aggregates a round: sketch quantiles beside every
    wanted rank, then counts at those values.  A bracket loses its end values
    and about ``accuracy``-fold of its rows a round, so rounds grow with the
    logarithm of the rows and never stall on ties.  ``df`` is read in each of them: pass a materialised frame.
    """
    df = df.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)])
    counts = df.agg(*[F.count(f"x{i}").alias(f"n{i}") for i in range(len(cols))]).first()
    ranks = [_Rank(i, k, n) for i in range(len(cols)) if (n := counts[f"n{i}"]) for k in sorted({(n - 1) // 2, n // 2})]
    while todo := [r for r in ranks if r.value is None]:
        quantiles = []
        for j, r in enumerate(todo):
            x, at, eps = F.col(f"x{r.column}"), (r.rank - r.below + 0.5) / r.inside, 2.0 / accuracy
            quantiles.append(F.percentile_approx(F.when(r.within(x), x), [max(0.0, at - eps), min(1.0, at + eps)],
                                                 accuracy).alias(f"q{j}"))
        q = df.agg(*quantiles).first()
        tallies = []
        for j, r in enumerate(todo):
            x, inside = F.col(f"x{r.column}"), r.within(F.col(f"x{r.column}"))
            for end, value in zip(("lo", "hi"), q[f"q{j}"]):
                tallies += [F.count_if(inside & (x < F.lit(value))).alias(f"lt_{end}{j}"),
                            F.count_if(inside & (x <= F.lit(value))).alias(f"le_{end}{j}")]
        c = df.agg(*tallies).first()
        for j, r in enumerate(todo):
            r.narrow(*q[f"q{j}"], c[f"lt_lo{j}"], c[f"le_lo{j}"], c[f"lt_hi{j}"], c[f"le_hi{j}"])
    out: dict[str, float | None] = dict.fromkeys(cols)
    for i, c in enumerate(cols):
        middle = [r.value for r in ranks if r.column == i]
        if middle:
            out[c] = middle[0] + (middle[-1] - middle[0]) * 0.5
    return out


def impute_median(df: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Fill NULLs with the exact column median (0 when a column is all NULL); filled columns are DOUBLE.

    ``df`` is computed once.  Returns the filled frame and a report (column, null_count, median).
    """
    # Read for the medians, the counts and the filled rows: materialise the input once instead of re-running its lineage.
    df = df.checkpoint()
    medians = exact_medians(df, cols)
    nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    filled = df.withColumns(
        {c: F.coalesce(F.col(c).cast("double"), F.lit(medians[c] if medians[c] is not None else 0.0)) for c in cols}
    )
    stack = ", ".join(f"'{c}', `{c}`" for c in cols)
    report = nulls.selectExpr(f"stack({len(cols)}, {stack}) as (column, null_count)").withColumn(
        "median",
        F.element_at(F.create_map(*[x for c in cols for x in (F.lit(c), F.lit(medians[c]).cast("double"))]),
                     F.col("column")),
    )
    return filled, report


# ---------------------------------------------------------------- ranking


BUCKET_DIGITS = 4  # hex digits of the md5 order: at most 65,536 buckets a group


def _with_buckets(df: DataFrame, by: Sequence[str], hash_col: str) -> tuple[DataFrame, DataFrame]:
    """``df`` with its ``_bucket``, and (by, _bucket, _size, _before): rows of the bucket and of all earlier ones of the group."""
    bucketed = df.withColumn("_bucket", F.substring(hash_col, 1, BUCKET_DIGITS))
    sizes = bucketed.groupBy(*by, "_bucket").agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    return bucketed, sizes.withColumn("_before", F.coalesce(F.sum("_size").over(earlier), F.lit(0)))


def rank_within(df: DataFrame, by: Sequence[str], hash_col: str, ties: Sequence[str] = (),
                rank_col: str = "rank") -> DataFrame:
    """1-based rank of each row within its ``by`` group in the order of ``hash_col`` (md5 hex text), then ``ties``.

    The order must be total and ``by`` columns not NULL.  ``df`` is read twice
    (counts, rows): pass a materialised frame if its lineage is dear.
    """
    bucketed, sizes = _with_buckets(df, by, hash_col)
    place = F.row_number().over(Window.partitionBy(*by, "_bucket").orderBy(hash_col, *ties))
    return (bucketed.withColumn("_place", place).join(sizes, on=[*by, "_bucket"])
            .withColumn(rank_col, F.col("_before") + F.col("_place")).drop("_bucket", "_place", "_size", "_before"))


def first_in_order(df: DataFrame, by: Sequence[str], hash_col: str, ties: Sequence[str], n: Column,
                   flag: str) -> DataFrame:
    """Adds boolean ``flag``: is the row among the first ``n`` of its group in the order of ``rank_within``?

    Only the one bucket of a group that ``n`` cuts is ranked; every other row
    is decided by its bucket.  ``n`` may use columns of ``df``.
    """
    bucketed, sizes = _with_buckets(df, by, hash_col)
    placed = bucketed.join(sizes, on=[*by, "_bucket"]).withColumn("_n", n)
    cut = (F.col("_before") < F.col("_n")) & (F.col("_n") < F.col("_before") + F.col("_size"))
    whole = placed.filter(~cut).withColumn(flag, F.col("_before") < F.col("_n"))
    place = F.row_number().over(Window.partitionBy(*by, "_bucket").orderBy(hash_col, *ties))
    split = placed.filter(cut).withColumn(flag, F.col("_before") + place <= F.col("_n"))
    return whole.unionByName(split).drop("_bucket", "_size", "_before", "_n")


def split_quotas(df: DataFrame, label: str, test_frac: float = C.TEST_SIZE) -> DataFrame:
    """Per class: size and exact test count.

    Total test rows = ceil(test_frac·n); each class gets floor(T·n_c/n) and the
    leftover rows go to the largest remainders (ties by label).  Integer
    arithmetic throughout, on the one-row-per-class table.
    """
    frac = Fraction(str(test_frac)).limit_denominator(10**6)
    num, den = frac.numerator, frac.denominator
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_class"))
    w_all = Window.partitionBy()
    q = counts.withColumn("_n", F.sum("n_class").over(w_all))
    # ceil(n·num/den) and the per-class shares in exact integer arithmetic ('div' is integer division).
    q = q.withColumn("_t", F.expr(f"(_n * {num} + {den - 1}) div {den}"))
    q = q.withColumns({
        "_base": F.expr("(_t * n_class) div _n"),
        "_rem": F.expr("(_t * n_class) % _n"),
    })
    q = q.withColumn("_extra", F.col("_t") - F.sum("_base").over(w_all))
    rk = F.row_number().over(Window.partitionBy().orderBy(F.desc("_rem"), F.asc(label)))
    return q.withColumn("n_test", F.col("_base") + F.when(rk <= F.col("_extra"), 1).otherwise(0)).select(
        label, "n_class", "n_test", (F.col("n_class") - F.col("n_test")).alias("n_train")
    )


def stratified_split(df: DataFrame, id_col: str, label: str, test_frac: float = C.TEST_SIZE,
                     seed: int = C.SEED) -> DataFrame:
    """Adds ``split`` ∈ {train, test}: per class, the n_test rows first in md5(id:seed) order are test."""
    # Counted and read again below: materialise the input once instead of re-running its lineage.
    df = df.withColumn("_h", hash_hex(id_col, seed=seed)).checkpoint()
    quotas = split_quotas(df, label, test_frac).select(label, "n_test")
    chosen = first_in_order(df.join(quotas, on=label), [label], "_h", [id_col], F.col("n_test"), "_test")
    return chosen.withColumn("split", F.when(F.col("_test"), F.lit("test")).otherwise(F.lit("train"))).drop(
        "_h", "_test", "n_test")


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weights n / (k · n_c), one row per class."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_class"))
    w_all = Window.partitionBy()
    return counts.withColumn(
        "weight",
        F.sum("n_class").over(w_all).cast("double") / (F.count(F.lit(1)).over(w_all) * F.col("n_class")),
    )


def with_class_weights(df: DataFrame, label: str, weight_col: str = "weight") -> DataFrame:
    """Attach the balanced class weight to each row (join to the one-row-per-class table)."""
    w = class_weights(df, label).select(label, F.col("weight").alias(weight_col))
    return df.join(w, on=label, how="inner")
