"""Mixing sources to target weights by pivotal dependent rounding.

Every source gets a target number of words: the weights share
``TOTAL_SHARE`` of all words, no source may exceed ``MAX_REPEAT`` times its
size, and the excess is shared again by weight (``source_targets``).  A
document of the source should then be copied target / size times: the whole
part is certain, the fraction is a probability.

``copies`` rounds the fractions dependently.  Documents of a source are put in
order of size and cut into chunks of about ``CHUNK``.  Inside a chunk the
fractions are paired one after the other: each pair transfers mass at random
until one of the two is 0 or 1, the other one goes on, so every chunk settles
all of its documents but one.  The residuals of ``CHUNK`` neighbouring chunks
form a chunk of the next round, up to one residual per source: a reduction
tree of logarithmic depth whose rounds shrink by ``CHUNK``.  Neighbours have
similar sizes, so moving a copy from one to the other hardly moves words and a
source's words stay near its target.  Fractions are integers in units of
2^-40, so mass is conserved exactly; the random draws are hashes of the seed,
round and document, so reruns agree.

Defined cases: a document is (doc_id, source, size); repeated rows are one
unit whose rows get the same number of copies.  NULL texts have size 0, NULL
sources form one source that comes last.  A source without words has target 0
and copies 0.  An empty table mixes to an empty table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fintide.llm.common import boxed, let, staged, unboxed, words_of

WEIGHTS = (5.0, 2.0, 1.0)
TOTAL_SHARE = 1.5
MAX_REPEAT = 2.0
CHUNK = 128
ONE = 1 << 40
SEED = 7


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, rows): one row per distinct unit with its number of words."""
    rows = docs.select("doc_id", "source", F.size(words_of(F.col("text"))).cast("long").alias("size"))
    return rows.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("rows"))


def source_targets(units: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = TOTAL_SHARE,
                   cap: float = MAX_REPEAT) -> DataFrame:
    """(source, source_size, target): one row per source; sources in code-point order take the weights in turn."""
    sizes = units.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"))
    # One row per source, no more: the list the weights are given for.
    place = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    table = staged(sizes.select("source", "source_size", F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), (place + 1).cast("int")).alias("weight")), "mix-sources")
    limit = F.lit(cap) * F.col("source_size")
    total, level, settled = None, None, -1
    while True:
        # A source is full once the level times its weight reaches its limit; full sources leave their excess to the rest.
        full = F.lit(False) if level is None else limit <= F.lit(level) * F.col("weight")
        got = table.agg(F.sum("source_size").alias("size"), F.sum(F.when(full, limit).otherwise(0.0)).alias("used"),
                        F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).alias("open"),
                        F.count(F.when(full, 1)).alias("full")).head()
        if not got["size"] or got["full"] == settled or not got["open"]:
            break
        total, settled = share * got["size"], got["full"]
        level = (total - got["used"]) / got["open"]
    target = F.least(F.lit(level or 0.0) * F.col("weight"), limit) if level is not None else limit * 0
    return table.select("source", "source_size", target.alias("target"))


def _uniform(*parts: Column | int) -> Column:
    """A draw in 0 .. ONE-1 from the hash of ``parts``."""
    return F.shiftrightunsigned(F.xxhash64(*[F.lit(p) if isinstance(p, int) else p for p in parts]), 24)


def _settle(units: Column, level: int, seed: int) -> Column:
    """Sequential pairing of an ordered array of (doc_id, source, size, p): settled units and the open one.

    The state is the open unit (NULL if none) and the list of settled units
    (doc_id, size, up).  Two fractions below one in sum: one of them becomes 0;
    otherwise one becomes 1; the survivor keeps the remaining mass.
    """
    unit = "struct<doc_id:bigint,size:bigint,p:bigint>"
    done = "array<struct<doc_id:bigint,size:bigint,up:bigint>>"

    def as_unit(u: Column, p: Column) -> Column:
        return F.struct(u["doc_id"].alias("doc_id"), u["size"].alias("size"), p.alias("p")).cast(unit)

    def as_done(u: Column, up: int) -> Column:
        return F.struct(u["doc_id"].alias("doc_id"), u["size"].alias("size"), F.lit(up).cast("long").alias("up"))

    def step(acc: Column, x: Column) -> Column:
        open_, p, q = acc["open"], acc["open"]["p"], x["p"]
        total = p + q
        draw = _uniform(seed, level, open_["doc_id"], open_["size"], x["doc_id"], x["size"])
        # Below one: the open unit survives with chance p / total.  From one on: it becomes 1 with chance (1-q)/(2-total).
        # draw / ONE < num / den, in doubles of at most 41 bits each; the comparison itself is deterministic.
        low = draw.cast("double") * total.cast("double") < p.cast("double") * F.lit(float(ONE))
        high = draw.cast("double") * (2 * ONE - total).cast("double") < (ONE - q).cast("double") * F.lit(float(ONE))
        rest = total - F.lit(ONE)
        small = F.when(low, F.struct(as_unit(open_, total).alias("open"), as_done(x, 0).alias("done"))).otherwise(
            F.struct(as_unit(x, total).alias("open"), as_done(open_, 0).alias("done")))
        large = F.when(high, F.struct(as_unit(x, rest).alias("open"), as_done(open_, 1).alias("done"))).otherwise(
            F.struct(as_unit(open_, rest).alias("open"), as_done(x, 1).alias("done")))
        pair = F.when(total < ONE, small).otherwise(large)
        # A survivor without mass is settled as well.
        moved = let(pair, lambda m: F.struct(
            F.when(m["open"]["p"] > 0, m["open"]).alias("open"),
            F.concat(acc["done"], F.array(m["done"]), F.when(m["open"]["p"] > 0, F.array().cast(done)).otherwise(
                F.array(as_done(m["open"], 0)))).alias("done")))
        start = F.struct(as_unit(x, q).alias("open"), acc["done"].alias("done"))
        return F.when(open_.isNull(), start).otherwise(moved)

    zero = F.struct(F.lit(None).cast(unit).alias("open"), F.array().cast(done).alias("done"))
    return F.aggregate(units, zero, step)


def copies(units: DataFrame, targets: DataFrame, chunk: int = CHUNK, seed: int = SEED) -> DataFrame:
    """(doc_id, source, size, rows, source_size, target, copies) for every unit."""
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rated = units.join(targets, units["source"].eqNullSafe(targets["source"])).select(
        "doc_id", units["source"], "size", "rows", "source_size", "target", F.floor(rate).alias("whole"),
        F.round((rate - F.floor(rate)) * F.lit(float(ONE))).cast("long").alias("p"))
    # A source's rank interval of every size class, from a histogram of at most a few hundred classes a source.
    size_class = F.floor(F.lit(8.0) * F.log2(F.col("size") + F.lit(1.0))).cast("int")
    rated = staged(rated.withColumn("size_class", size_class), "mix-units")
    classes = rated.groupBy("source", "size_class").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("source").orderBy("size_class").rowsBetween(Window.unboundedPreceding, -1))
    classes = classes.withColumn("first", F.coalesce(before, F.lit(0)))
    most = classes.groupBy("source").agg(F.sum("n").alias("n")).agg(F.max("n")).head()[0] or 0
    # Spread evenly over the ranks of its class, a unit's chunk holds about ``chunk`` units of similar size.
    rank = F.col("first") + F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("size")), F.col("n"))
    c = classes.withColumnRenamed("source", "_s").withColumnRenamed("size_class", "_c")
    placed = rated.join(c, rated["source"].eqNullSafe(c["_s"]) & (rated["size_class"] == c["_c"]))
    open_units = placed.filter((F.col("p") > 0) & (F.col("p") < ONE)).select(
        "source", F.floor(rank / F.lit(chunk)).alias("chunk"), "doc_id", "size", "p")
    settled, level = [], 0
    while True:
        grouped = open_units.groupBy("source", "chunk").agg(F.array_sort(F.collect_list(F.struct("size", "doc_id", "p"))).alias("u"))
        solved = staged(grouped.select("source", "chunk", _settle(F.col("u"), level, seed).alias("r")).select(
            "source", "chunk", "r.open", "r.done"), f"mix-round{level}")
        settled.append(solved.select("source", F.explode("done").alias("d")).select("source", "d.doc_id", "d.size", "d.up"))
        left = solved.filter("open IS NOT NULL").select(
            "source", F.floor(F.col("chunk") / F.lit(chunk)).alias("chunk"), "open.doc_id", "open.size", "open.p")
        most = -(-most // chunk)
        if most <= 1:
            # One residual a source: an unpaired fraction is rounded by its own draw.
            alone = left.select("source", "doc_id", "size", (
                _uniform(seed, -1, F.col("doc_id"), F.col("size")) < F.col("p")).cast("long").alias("up"))
            break
        open_units, level = left, level + 1
    ups = alone
    for part in settled:
        ups = ups.unionByName(part)
    # Only the units rounded up are joined back; doc_id, source and size may be NULL-safe keys of a unit.
    u = ups.filter("up = 1").select(F.col("doc_id").alias("_d"), F.col("source").alias("_s"), F.col("size").alias("_z"), "up")
    back = rated.join(u, rated["doc_id"].eqNullSafe(u["_d"]) & rated["source"].eqNullSafe(u["_s"]) & (rated["size"] == u["_z"]), "left")
    sure = (F.col("p") >= ONE).cast("long")
    return back.select("doc_id", "source", "size", "rows", "source_size", "target",
                       (F.col("whole") + sure + F.coalesce("up", F.lit(0))).cast("long").alias("copies"))


def mix(docs: DataFrame, **how) -> DataFrame:
    """The mixture itself: every row of ``docs`` as often as its copies say, same columns."""
    units = staged(sized(docs), "mix-sizes")
    chosen = copies(units, source_targets(units), **how).select(
        F.col("doc_id").alias("_d"), F.col("source").alias("_s"), F.col("size").alias("_z"), "copies").filter("copies > 0")
    rows = boxed(docs, _doc=F.col("doc_id"), _source=F.col("source"), _size=F.size(words_of(F.col("text"))).cast("long"))
    joined = rows.join(chosen, F.col("_doc").eqNullSafe(F.col("_d")) & F.col("_source").eqNullSafe(F.col("_s"))
                       & (F.col("_size") == F.col("_z")))
    return joined.select("_row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*unboxed(docs.columns))


def mix_report(docs: DataFrame, **how) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, source_size, target, taken (words the mix takes of it)."""
    units = staged(sized(docs), "mix-sizes")
    done = copies(units, source_targets(units), **how)
    return done.select("doc_id", "source", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"),
                       F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))).alias("_row")).drop("_row")
