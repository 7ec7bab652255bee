"""Quality rules: a hashed n-gram log-likelihood ratio between a trusted target and the raw corpus.

Words and adjacent word pairs of every document are hashed into ``BUCKETS``
buckets.  One aggregate over the whole corpus gives two multinomials: the raw
corpus (every document) and the trusted target, fitted on ``TRUSTED`` of the
documents labelled good and not toxic, chosen by a hash of their id.  That
bound keeps the list of trusted ids small enough to broadcast (160 kB), so no
text is shuffled to learn whether it is trusted.  The
weight of a bucket is the log of its target count over the count expected
from the raw corpus, both smoothed by ``PRIOR_COUNT`` so that a bucket with
little evidence weighs about nothing.  A document's score is the sum of its
n-grams' weights over its number of n-grams plus ``PRIOR_GRAMS`` (length
normalised; short texts shrink towards zero).  Documents below ``THRESHOLD``
are rejected.  All of it is DataFrame expressions; the driver sees nothing but
the array of ``BUCKETS`` weights, which the scoring pass carries as a literal.

Defined cases: a NULL or blank text has no words, fails the base rules (fewer
than ten words) and scores 0.  Repeated rows are judged separately and alike.
An empty corpus or one without trusted documents gives every bucket weight 0,
so only the base rules reject.  Extra columns of the input are passed through
by ``judge``; names that clash with its own output are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fintide.llm.common import boxed, first_by_hash, let, unboxed, words_of

BUCKETS = 1 << 15
TRUSTED = 20_000  # labelled documents that the target multinomial is fitted on, at most
PRIOR_COUNT = 10.0
PRIOR_GRAMS = 8
THRESHOLD = -0.12
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
SYMBOLS = "#*$%&|<>"


def hashed_words(words: Column) -> Column:
    """64-bit hash of every word."""
    return F.transform(words, lambda w: F.xxhash64(w))


def chained(left: Column, step: int) -> Column:
    """Hash of (x[i], x[i + step]) for every i; shorter arrays give an empty one."""
    n = F.greatest(F.size(left) - step, F.lit(0))
    return F.zip_with(F.slice(left, 1, n), F.slice(left, step + 1, n), lambda x, y: F.xxhash64(x, y))


def bucket_weights(docs: DataFrame, trusted_ids: DataFrame, text: str = "text", key: str = "doc_id",
                   buckets: int = BUCKETS, prior: float = PRIOR_COUNT) -> DataFrame:
    """One row, one column ``weights``: the array of all bucket weights, fitted on the whole corpus."""
    ids = trusted_ids.select(F.col(key).alias("k")).filter("k IS NOT NULL").distinct()
    fitted_on = first_by_hash(ids, "k", ids.count(), TRUSTED).withColumn("good", F.lit(1))
    marked = docs.select(F.col(key).alias("k"), F.col(text).alias("t")).join(F.broadcast(fitted_on), "k", "left")
    hashed = marked.select(F.coalesce("good", F.lit(0)).alias("good"), hashed_words(words_of(F.col("t"))).alias("h"))
    grams = hashed.select("good", F.explode(F.concat("h", chained(F.col("h"), 1))).alias("g")).select(
        "good", F.pmod("g", F.lit(buckets)).cast("int").alias("bucket"))
    counts = grams.groupBy("bucket").agg(F.count(F.lit(1)).alias("raw"), F.sum("good").alias("target"))
    every = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    # Every bucket has exactly one row, so this gathers ``buckets`` rows whatever the corpus holds.
    rows = every.join(counts, "bucket", "left").groupBy().agg(F.array_sort(F.collect_list(F.struct(
        "bucket", F.coalesce("raw", F.lit(0)).cast("double").alias("raw"),
        F.coalesce("target", F.lit(0)).cast("double").alias("target")))).alias("c"))
    total = F.aggregate("c", F.lit(0.0), lambda a, x: a + x["raw"])
    good = F.aggregate("c", F.lit(0.0), lambda a, x: a + x["target"])
    share = rows.select("c", F.when((good > 0) & (total > 0), good / total).alias("share"))
    return share.select(F.transform("c", lambda x: F.when(
        F.col("share").isNotNull(),
        F.log((x["target"] + F.lit(prior)) / (x["raw"] * F.col("share") + F.lit(prior)))).otherwise(F.lit(0.0))
    ).alias("weights"))


def repeated_window_words(pairs: Column, n_words: Column) -> Column:
    """Words that lie in a five-word window which occurs twice or more in the text, first one included.

    ``pairs`` are the hashes of adjacent words; two steps of chaining make them
    hashes of five words.  Windows are compared by 64-bit hash within one text.  Texts without a
    repeated window stop after one distinct count; the others sort their windows once.
    """
    def heavy(g: Column) -> Column:
        ordered = F.sort_array(F.transform(g, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def repeats(s: Column) -> Column:
            twice = F.filter(s, lambda x, j: ((j > 0) & (s[F.greatest(j - 1, F.lit(0))]["h"] == x["h"]))
                             | ((j < F.size(s) - 1) & (s[F.least(j + 1, F.size(s) - 1)]["h"] == x["h"])))
            at = F.sort_array(F.transform(twice, lambda x: x["i"]))
            start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
            return F.aggregate(at, start, lambda a, i: F.struct(
                (i + WINDOW).alias("end"), (a["n"] + (i + WINDOW - F.greatest(a["end"], i)).cast("long")).alias("n")))["n"]

        return let(ordered, repeats)

    windows = chained(chained(pairs, 2), 1)
    return F.when(n_words <= WINDOW, F.lit(0).cast("long")).otherwise(let(
        windows, lambda g: F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0).cast("long")).otherwise(heavy(g))))


def base_columns(text: Column, words: Column, pairs: Column) -> dict[str, Column]:
    """Counts of the base rules, each over the whole text."""
    t = F.coalesce(text, F.lit(""))
    bare = t
    for symbol in SYMBOLS:
        bare = F.replace(bare, F.lit(symbol), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return {
        "n_words": F.size(words).cast("long"),
        "word_chars": F.length(F.array_join(words, "")).cast("long"),
        "n_symbols": (F.length(t) - F.length(bare)).cast("long"),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_repeat_words": repeated_window_words(pairs, F.size(words)),
    }


def judge(docs: DataFrame, trusted_ids: DataFrame, text: str = "text", key: str = "doc_id",
          threshold: float = THRESHOLD) -> DataFrame:
    """Every input row with the base counts, ``llr_score``, ``base_failed`` and ``kept``."""
    fitted = bucket_weights(docs, trusted_ids, text, key).head()["weights"]  # BUCKETS numbers, whatever the corpus
    weights = F.expr("cast(split('{}', ',') as array<double>)".format(",".join(f"{x:.7g}" for x in fitted)))
    own = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "llr_score", "base_failed", "kept"]
    plain = [c for c in docs.columns if c not in own]
    rows = boxed(docs, _text=F.col(text)).withColumn("_w", words_of(F.col("_text")))
    rows = rows.withColumn("_h", hashed_words(F.col("_w"))).withColumn("_b", chained(F.col("_h"), 1))
    rows = rows.withColumns(base_columns(F.col("_text"), F.col("_w"), F.col("_b")))
    score = F.aggregate(F.concat("_h", "_b"), F.lit(0.0), lambda a, g: a + weights[F.pmod(g, F.lit(BUCKETS)).cast("int")])
    rows = rows.withColumn("llr_score", score / (F.size("_h") + F.size("_b") + F.lit(PRIOR_GRAMS)))
    rows = rows.withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                           | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
    rows = rows.withColumn("kept", ~F.col("base_failed") & (F.col("llr_score") >= threshold))
    return rows.select(*unboxed(plain), *own)


def trusted(labels: DataFrame) -> DataFrame:
    """Ids of the trusted target: labelled good and not toxic."""
    return labels.filter("quality = 1 AND toxic = 0").select("doc_id")


def quality_filter(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Only the kept documents, with the columns of ``docs``."""
    verdicts = judge(boxed(docs, doc_id=F.col("doc_id"), text=F.col("text")), trusted(labels))
    # The row number makes the verdict's projection one that a filter is not pushed through: a pushed filter would
    # hold a copy of the words, hashes and counts for every place that uses them.
    numbered = verdicts.select("_row", "kept", F.monotonically_increasing_id().alias("_at"))
    return numbered.filter(F.col("kept") & (F.col("_at") >= 0)).select(*unboxed(docs.columns))
