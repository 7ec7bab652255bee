"""Column expressions shared by the operators.

All of these build Catalyst expressions (no Python UDFs), so they stay inside
whole-stage codegen and are evaluated on the executors.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from fintide import config as C


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: str | Column) -> Column:
    """trim, then '' → NULL (so a later fill sees whitespace-only values as missing)."""
    return F.nullif(F.trim(col(c)), F.lit(""))


def bucketize(c: str | Column, bounds: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """Ordered threshold buckets: first ``c < bound`` wins; NULL and the rest fall to ``otherwise``."""
    x = col(c)
    expr = None
    for bound, label in bounds:
        expr = F.when(x < bound, F.lit(label)) if expr is None else expr.when(x < bound, F.lit(label))
    return F.lit(otherwise) if expr is None else expr.otherwise(F.lit(otherwise))


def score(preds: Iterable[Column]) -> Column:
    """Additive score: number of predicates that are true (NULL counts as false)."""
    total = None
    for p in preds:
        term = F.coalesce(p, F.lit(False)).cast("int")
        total = term if total is None else total + term
    return total if total is not None else F.lit(0)


def as_date(d: dt.date | str | Column) -> Column:
    if isinstance(d, Column):
        return d
    return F.lit(d if isinstance(d, dt.date) else dt.date.fromisoformat(d))


def years_between(start: str | Column, as_of: dt.date | str | Column | None) -> Column:
    """Whole days from ``start`` to ``as_of`` in years of 365.25 days, rounded to 1 digit."""
    end = F.current_date() if as_of is None else as_date(as_of)
    return F.round(F.datediff(end, col(start)) / C.DAYS_PER_YEAR, 1)


def clip(c: str | Column, lo: float | None = None, hi: float | None = None) -> Column:
    x = col(c)
    if lo is not None:
        x = F.greatest(x, F.lit(lo))
    if hi is not None:
        x = F.least(x, F.lit(hi))
    return x


def encode(c: str | Column, mapping: Mapping[str, int], default: int) -> Column:
    """Dictionary encode with a default for unknown / NULL values."""
    kv = []
    for k, v in mapping.items():
        kv += [F.lit(k), F.lit(v)]
    m = F.create_map(*kv)
    return F.coalesce(F.try_element_at(m, col(c)), F.lit(default)).cast("int")


def decode(c: str | Column, labels: Sequence[str]) -> Column:
    """Index → label; an index outside the label list decodes to its own text."""
    idx = col(c).cast("int")
    arr = F.array(*[F.lit(x) for x in labels])
    return F.coalesce(F.try_element_at(arr, idx + 1), col(c).cast("string"))


def age_group_code(c: str | Column = "age_group") -> Column:
    return encode(c, C.AGE_GROUP_CODES, C.AGE_GROUP_DEFAULT_CODE)


def hash_hex(*parts: str | Column, seed: int = C.SEED) -> Column:
    """md5 hex of 'part1:part2:...:seed' — the same string in Spark and any SQL engine."""
    cols = [col(p).cast("string") for p in parts] + [F.lit(str(seed))]
    return F.md5(F.concat_ws(":", *cols))


def hash_uniform(*parts: str | Column, seed: int = C.SEED) -> Column:
    """Deterministic uniform in [0, 1) from the first 32 bits of the md5 hash."""
    h = hash_hex(*parts, seed=seed)
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def pick_weighted(u: Column, choices: Sequence[tuple[str, float]]) -> Column:
    """Categorical choice: the first label whose cumulative weight exceeds ``u`` (u in [0,1))."""
    total = float(sum(w for _, w in choices))
    cum = 0.0
    expr = None
    for label, w in choices[:-1]:
        cum += w / total
        expr = F.when(u < cum, F.lit(label)) if expr is None else expr.when(u < cum, F.lit(label))
    last = F.lit(choices[-1][0])
    return last if expr is None else expr.otherwise(last)


def plain_number(c: str | Column) -> Column:
    """Number as plain text with at least one decimal ('85.0', '10000000.0', '12.5'), every digit kept.

    The text reads back as the same double; Spark
    prints large and small ones as '1.0E7' or '2.5E-5', whose exponent is
    written out here.  NULL stays NULL; NaN and infinities keep their names.
    """
    txt = col(c).cast("double").cast("string")
    sign = F.when(txt.startswith("-"), F.lit("-")).otherwise(F.lit(""))
    whole = F.regexp_extract(txt, r"^-?([0-9]+)\.", 1)
    digits = F.concat(whole, F.regexp_extract(txt, r"\.([0-9]*?)0*E", 1))
    point = F.length(whole) + F.regexp_extract(txt, r"E(-?[0-9]+)$", 1).try_cast("int")
    size = F.length(digits)
    large = F.concat(digits, F.repeat(F.lit("0"), F.greatest(point - size, F.lit(0))))
    shifted = F.when(point > 0, F.concat(
        F.substring(large, F.lit(1), point), F.lit("."),
        F.when(point < size, F.substring(digits, point + 1, size)).otherwise(F.lit("0")))
    ).otherwise(F.concat(F.lit("0."), F.repeat(F.lit("0"), -point), digits))
    return F.when(txt.contains("E"), F.concat(sign, shifted)).otherwise(txt)


def feature_vector(cols: Sequence[str] = tuple(C.FEATURE_COLS)) -> Column:
    """Ordered feature array<double> (the model's input layout)."""
    return F.array(*[F.col(c).cast("double") for c in cols])
