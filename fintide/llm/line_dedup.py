"""Line dedup by site-relative frequency.

A host's boilerplate is what stands on an unusual share of its pages.  Per
host, the number of its distinct pages that contain a line is divided by the
host's number of distinct pages; lines above ``MAX_RATIO`` (and on at least
``MIN_PAGES`` pages) are dropped wherever that host uses them.  A page is a
distinct text of its host, so a group of exact copies counts as one page and
does not turn its own content into boilerplate.

One pass hashes the lines and counts them with map-side partial aggregation;
no key is gathered, so a host or a line may hold any share of the rows.  The
lines of one host above the ratio number at most (lines per page) / ratio, so
the per-host array of their hashes is bounded.  These arrays are written as a
table and joined to the pages by host: Spark broadcasts the table if its size
is below the broadcast threshold, and otherwise shuffles by host, where
adaptive execution splits the hot ones.

Defined cases: NULL texts stay NULL and count as a page without lines; NULL
hosts form one host.  Lines are compared after trimming white space; blank
lines are never dropped and never counted.  A text all of whose lines are
boilerplate becomes the empty string.  Repeated rows are treated alike.  Extra
columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fintide.llm.common import boxed, staged, unboxed

MAX_RATIO = 0.05
MIN_PAGES = 3


def line_key(line: Column) -> Column:
    """Hash of a line without its outer white space; NULL for a blank line."""
    bare = F.btrim(line, F.lit(" \t\n\x0b\x0c\r"))
    return F.when(bare != "", F.xxhash64(bare))


def line_frequencies(docs: DataFrame, host: str = "source", text: str = "text") -> DataFrame:
    """(host, line, pages, host_pages): on how many of the host's distinct pages each line stands."""
    pages = docs.select(F.col(host).alias("host"), F.xxhash64(text).alias("page"), F.col(text).alias("text"))
    totals = pages.select("host", "page").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("host_pages"))
    keys = F.array_distinct(F.array_compact(F.transform(F.split("text", "\n"), line_key)))
    lines = pages.select("host", "page", F.explode(keys).alias("line")).distinct()
    counts = lines.groupBy("host", "line").agg(F.count(F.lit(1)).alias("pages"))
    return counts.alias("c").join(totals.alias("t"), F.col("c.host").eqNullSafe(F.col("t.host"))).select(
        "c.host", "line", "pages", "host_pages")


def boilerplate(docs: DataFrame, host: str = "source", text: str = "text", max_ratio: float = MAX_RATIO,
                min_pages: int = MIN_PAGES) -> DataFrame:
    """The (host, line) rows above the ratio."""
    freq = line_frequencies(docs, host, text)
    return freq.filter((F.col("pages") >= min_pages) & (F.col("pages") > max_ratio * F.col("host_pages")))


def drop_boilerplate(docs: DataFrame, host: str = "source", text: str = "text", max_ratio: float = MAX_RATIO,
                     min_pages: int = MIN_PAGES, counts: bool = False) -> DataFrame:
    """``docs`` with the boilerplate lines taken out of ``text``; ``counts`` adds n_lines and n_dropped."""
    found = boilerplate(docs, host, text, max_ratio, min_pages)
    # Written first, so that the join below is planned knowing its size: a small table is broadcast and no text moves.
    per_host = staged(found.groupBy("host").agg(F.collect_list("line").alias("_bad")).withColumnRenamed("host", "_host"),
                      "line-boilerplate")
    joined = boxed(docs, _source=F.col(f"`{host}`")).join(per_host, F.col("_source").eqNullSafe(F.col("_host")), "left")
    body = F.col("_row").getField(text)
    lines = F.split(body, "\n")
    good = F.filter(lines, lambda x: F.coalesce(~F.array_contains(F.col("_bad"), line_key(x)), F.lit(True)))
    # A text of which nothing was dropped stays byte for byte as it was.
    cleaned = F.when(F.col("_bad").isNull(), body).otherwise(F.array_join(good, "\n"))
    out = unboxed(docs.columns, **{text: cleaned})
    if counts:
        n = F.coalesce(F.size(lines), F.lit(0))
        kept = F.when(F.col("_bad").isNull(), n).otherwise(F.coalesce(F.size(good), F.lit(0)))
        out = [c for c, name in zip(out, docs.columns) if name not in ("n_lines", "n_dropped")]
        out += [F.when(body.isNull(), 0).otherwise(n).cast("long").alias("n_lines"),
                F.when(body.isNull(), 0).otherwise(n - kept).cast("long").alias("n_dropped")]
    return joined.select(*out)
