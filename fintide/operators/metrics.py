"""Classification metrics as DataFrame aggregates (confusion matrix, per-class report).

Both are one aggregate pass with conditional counts; the per-class rows are
built from that single row, so the cost is one scan regardless of class skew.
Macro F1 is the unweighted mean of per-class F1 (Spark's evaluator "f1" is the
weighted one).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fintide import config as C


def rule_prediction(equity_threshold: float = 60.0, debt_threshold: float = 50.0) -> Column:
    """A deterministic allocation rule: equity-heavy → Aggressive, debt-heavy → Conservative."""
    return (
        F.when(F.col("equity_pct") >= equity_threshold, F.lit("Aggressive"))
        .when(F.col("debt_pct") >= debt_threshold, F.lit("Conservative"))
        .otherwise(F.lit("Moderate"))
    )


def confusion(df: DataFrame, label: str, pred: str, classes: Sequence[str] = tuple(C.RISK_CLASSES)) -> DataFrame:
    """Rows = actual class, one count column per predicted class (0 when never predicted)."""
    return df.groupBy(F.col(label).alias("actual")).agg(
        *[F.count_if(F.col(pred) == c).alias(c) for c in classes]
    )


def class_report(df: DataFrame, label: str, pred: str, classes: Sequence[str] = tuple(C.RISK_CLASSES),
                 digits: int = 6) -> DataFrame:
    """precision / recall / f1 / support per class, plus macro avg, weighted avg and accuracy rows.

    One aggregate pass produces every count; all report rows are expressions
    over that single row, exploded at the end (no window, no union re-scan).
    """
    aggs = [F.count(F.lit(1)).alias("n"), F.count_if(F.col(label) == F.col(pred)).alias("correct")]
    for i, c in enumerate(classes):
        aggs += [
            F.count_if((F.col(label) == c) & (F.col(pred) == c)).alias(f"tp{i}"),
            F.count_if(F.col(pred) == c).alias(f"pp{i}"),
            F.count_if(F.col(label) == c).alias(f"s{i}"),
        ]
    one = df.agg(*aggs)
    prec, rec, f1, sup = [], [], [], []
    for i in range(len(classes)):
        tp = F.col(f"tp{i}").cast("double")
        p = F.coalesce(F.try_divide(tp, F.col(f"pp{i}")), F.lit(0.0))
        r = F.coalesce(F.try_divide(tp, F.col(f"s{i}")), F.lit(0.0))
        prec.append(p)
        rec.append(r)
        f1.append(F.when((p + r) == 0, F.lit(0.0)).otherwise(2 * p * r / (p + r)))
        sup.append(F.col(f"s{i}"))
    k = len(classes)
    n = F.col("n")

    def total(xs):
        out = xs[0]
        for x in xs[1:]:
            out = out + x
        return out

    def row(name, p, r, f, s):
        return F.struct(F.lit(name).alias("class"), p.cast("double").alias("precision"),
                        r.cast("double").alias("recall"), f.cast("double").alias("f1"), s.alias("support"))

    rows = [row(c, prec[i], rec[i], f1[i], sup[i]) for i, c in enumerate(classes)]
    rows.append(row("macro avg", total(prec) / k, total(rec) / k, total(f1) / k, n))
    rows.append(row("weighted avg", total([x * s for x, s in zip(prec, sup)]) / n,
                    total([x * s for x, s in zip(rec, sup)]) / n, total([x * s for x, s in zip(f1, sup)]) / n, n))
    rows.append(row("accuracy", F.lit(None), F.lit(None), F.col("correct") / n, n))
    out = one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    return out.select("class", *[F.round(c, digits).alias(c) for c in ("precision", "recall", "f1")], "support")


def accuracy_and_macro_f1(df: DataFrame, label: str, pred: str,
                          classes: Sequence[str] = tuple(C.RISK_CLASSES)) -> DataFrame:
    """One row: n, accuracy, macro_f1 (from the per-class report)."""
    rep = class_report(df, label, pred, classes, digits=12)
    return rep.groupBy().agg(
        F.max(F.when(F.col("class") == "accuracy", F.col("support"))).alias("n"),
        F.max(F.when(F.col("class") == "accuracy", F.col("f1"))).alias("accuracy"),
        F.max(F.when(F.col("class") == "macro avg", F.col("f1"))).alias("macro_f1"),
    )
