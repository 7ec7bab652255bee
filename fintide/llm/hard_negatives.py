"""Hard-negative mining with exact scores from a residue number system.

Rows have integer components.  A score is the inner product of an anchor (a row of
the stated query set) with another row.  For every anchor the best ``POSITIVES``
rows of its label are its positives, and for each positive the best
``NEGATIVES`` rows of another label whose score lies within a band of the
positive's score are its hard negatives.

1. Blocks.  Rows are packed into blocks of ``ROWS`` rows, anchors into blocks of
   ``ANCHORS``; each block of anchors meets each block of rows in a join on the
   anchor block and a group of row blocks, so both sides are dealt evenly and
   nothing is broadcast unless Spark finds it small.
2. Residues.  A meeting multiplies the component matrices modulo several small
   primes in float32.  Residues lie within half a prime of zero, and a product
   sums at most ``DEPTH`` components before it is reduced again, so every
   float32 value is an exact integer.
3. Reconstruction.  Chinese remaindering gives the mixed-radix digits of the
   score and from them the signed score as a 64-bit integer.  There are as many
   primes as the largest squared norm of the table needs (twice the sign and
   twice the size of any score, by Cauchy and Schwarz).
4. Selection.  A task keeps the best rows of each anchor (and positive) over its
   blocks; a window ranks the tasks' rows.  Positives are written once, then the
   blocks meet again for the negatives.

Every row is compared; there is no index and no cap.

Defined cases: rows with a NULL id, label or vector, or with a NULL or non-finite
component take no part, nor do vectors of another length than the table's most
frequent one (of equally frequent ones the longest) and those whose squared
norm reaches 2^62, whose scores a long can't hold.  Zero vectors take part.  Rows
that agree in id, label and vector are one row; other rows with the same id are
rows of their own.  Ties go to the smaller id.  An empty table has no rows.
Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import prod

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fintide.llm.common import staged

POSITIVES = 5
NEGATIVES = 10
BAND = (30, 90)  # percent of the positive's score
ROWS = 4096
ANCHORS = 512
GROUPS = 64
HELD = 32  # anchor blocks a task keeps open
DEPTH = 256  # (251 / 2)^2 * 256 < 2^24

#: Primes below 256, the largest first: enough for 2^64.
PRIMES = [p for p in range(251, 180, -2) if all(p % q for q in range(3, 16, 2))]

FOUND = "anchor long, anchor_id long, positive long, positive_id long, positive_score long, other long, other_id long, score long"


def primes_for(bound: int) -> list[int]:
    """Primes whose product is above 4 * ``bound``: scores within ``bound`` of zero fill at most a quarter on either side."""
    n = 1
    while prod(PRIMES[:n]) <= 4 * bound:
        n += 1
    return PRIMES[:n]


def residues(x: np.ndarray, p: int) -> np.ndarray:
    """Residues of integers modulo p, within p / 2 of zero, as float32."""
    r = np.mod(x, p)
    return np.where(r > p // 2, r - p, r).astype(np.float32)


def product(a: list[np.ndarray], b: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """Exact inner products (int64) of all rows of two matrices, given as residues for each prime."""
    digits = []
    for x, y, p in zip(a, b, primes):
        r = np.zeros((x.shape[0], y.shape[0]), np.float32)
        for at in range(0, x.shape[1], DEPTH):
            r += np.fmod(x[:, at : at + DEPTH] @ y[:, at : at + DEPTH].T, p)
            r = np.fmod(r, p)
        # Garner: take the known digits off and divide by their weight.
        r = r.astype(np.int64)
        for d, q in zip(digits, primes):
            r = (r - d) * pow(q, -1, p) % p
        digits.append(r % p)
    weight, value, share = 1, np.zeros(digits[0].shape, np.int64), np.zeros(digits[0].shape)
    with np.errstate(over="ignore"):  # weights wrap modulo 2^64, and so does the sum; the score itself fits
        for d, p in zip(digits, primes):
            value += d * np.uint64(weight % 2**64).view(np.int64)
            weight *= p
        share = digits[-1] / primes[-1]  # the leading digit tells the sign
        return np.where(share > 0.5, value - np.uint64(weight % 2**64).view(np.int64), value)


def best_of(scores: np.ndarray, allowed: np.ndarray, count: int) -> np.ndarray:
    """Places of the ``count`` highest allowed scores, of equal ones the first places; in that order."""
    at = np.flatnonzero(allowed)
    if len(at) > count:
        s = scores[at]
        at = at[s >= np.partition(s, len(s) - count)[len(s) - count]]
    return at[np.argsort(-scores[at], kind="stable")][:count]


PACKED = "block long, size int, keys binary, ids binary, labels binary, vectors binary, wanted array<array<struct<key:long,id:long,score:long>>>"


def _packer(limit: int):
    """Rows (block, key, id, label, x, wanted) in order of block as blocks of at most ``limit`` rows, sorted by id and key."""
    def pack(block: int, rows: list) -> tuple:
        rows.sort(key=lambda r: (r[1], r[0]))
        keys, ids, labels, x, wanted = zip(*rows)
        cols = [np.array(v, np.int64).tobytes() for v in (keys, ids, labels)]
        return block, len(rows), *cols, np.array(x, np.int32).tobytes(), list(wanted)

    def table(packed: list) -> pa.RecordBatch:
        item = pa.struct([("key", pa.int64()), ("id", pa.int64()), ("score", pa.int64())])
        types = [pa.int64(), pa.int32(), *[pa.binary()] * 4, pa.list_(pa.list_(item))]
        names = ["block", "size", "keys", "ids", "labels", "vectors", "wanted"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*packed), types)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, rows = None, []
        for batch in batches:
            for of, *row in zip(*[c.to_pylist() for c in batch.columns]):
                if rows and (of != block or len(rows) == limit):
                    yield table([pack(block, rows)])
                    rows = []
                block = of
                rows.append(row)
        if rows:
            yield table([pack(block, rows)])

    return run


def packed(rows: DataFrame, blocks: int, limit: int) -> DataFrame:
    """``rows`` (key, id, label, x, wanted) dealt to ``blocks`` blocks by their key, see ``PACKED``."""
    dealt = rows.withColumn("block", F.pmod("key", blocks)).repartition("block").sortWithinPartitions("block")
    return dealt.select("block", "key", "id", "label", "x", "wanted").mapInArrow(_packer(limit), PACKED)


def _meet(primes: list[int], positives: int, negatives: int, band: tuple[int, int]):
    """Meetings of an anchor block with a row block: the best rows of each anchor, or of each anchor and positive."""
    def opened(size: int, keys: bytes, ids: bytes, labels: bytes, vectors: bytes):
        x = np.frombuffer(vectors, np.int32).reshape(size, -1)
        return *[np.frombuffer(v, np.int64) for v in (keys, ids, labels)], [residues(x, p) for p in primes]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}

        def add(place: tuple, scores: np.ndarray, keys: np.ndarray, ids: np.ndarray, at: np.ndarray, count: int) -> None:
            new = list(zip((-scores[at]).tolist(), ids[at].tolist(), keys[at].tolist()))
            held[place] = sorted(held[place] + new)[:count] if place in held else new

        def flush() -> Iterator[pa.RecordBatch]:
            rows = [(*place, key, id_, -s) for place, best in held.items() for s, id_, key in best]
            held.clear()
            if rows:
                names = [part.split()[0] for part in FOUND.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names)

        opened_keys, anchors, open_blocks = None, None, set()
        for batch in batches:
            for i in range(batch.num_rows):  # a row of the join holds two blocks
                r = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                if r["keys"] != opened_keys:
                    opened_keys, anchors = r["keys"], opened(r["size"], r["keys"], r["ids"], r["labels"], r["vectors"])
                    if opened_keys not in open_blocks and len(open_blocks) == HELD:
                        yield from flush()
                        open_blocks.clear()
                    open_blocks.add(opened_keys)
                keys, ids, labels, x = opened(r["r_size"], r["r_keys"], r["r_ids"], r["r_labels"], r["r_vectors"])
                a_keys, a_ids, a_labels, a_x = anchors
                scores = product(a_x, x, primes)
                for j in range(len(a_keys)):
                    place = (int(a_keys[j]), int(a_ids[j]))
                    same, row = labels == a_labels[j], scores[j]
                    wanted = r["wanted"][j]
                    if wanted is None:
                        best = best_of(row, same & (keys != a_keys[j]), positives)
                        add((*place, None, None, None), row, keys, ids, best, positives)
                        continue
                    for w in wanted:
                        low, high = -(-band[0] * w["score"] // 100), band[1] * w["score"] // 100
                        best = best_of(row, ~same & (row >= low) & (row <= high), negatives)
                        if len(best):
                            add((*place, w["key"], w["id"], w["score"]), row, keys, ids, best, negatives)
        yield from flush()

    return run


def floored(x: Column) -> Column:
    """Largest whole number at or below a double, as a double; NULL, NaN and infinite stay what they are."""
    return F.when(F.abs(x) < 2.0**53, F.floor(x).cast("double")).otherwise(x)


def usable(vectors: DataFrame, vec_id: Column, label: Column, components: Column) -> DataFrame:
    """(key, id, label, x) of the rows that take part; ``components`` is an array of whole doubles."""
    rows = vectors.select(vec_id.cast("long").alias("id"), label.cast("long").alias("label"), components.alias("x"))
    norm = F.aggregate("x", F.lit(0.0), lambda s, v: s + v * v)
    fit = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < 2.0**31)) & (norm < 2.0**62)
    rows = rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull()).filter(fit)
    rows = rows.withColumn("x", F.transform("x", lambda v: v.cast("int")))
    return rows.withColumn("key", F.xxhash64("id", "label", "x")).dropDuplicates(["key", "id", "label", "x"])


def mine(vectors: DataFrame, vec_id: Column, label: Column, components: Column, is_anchor: Column, positives: int = POSITIVES,
         negatives: int = NEGATIVES, band: tuple[int, int] = BAND, block_rows: int = ROWS, block_anchors: int = ANCHORS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score); ``is_anchor`` is a condition on ``id``."""
    rows = staged(usable(vectors, vec_id, label, components), "negatives-rows")
    lengths = rows.groupBy(F.size("x").alias("length")).agg(F.count(F.lit(1)).alias("n"), F.count_if(is_anchor).alias("anchors"),
                                                            F.max(F.aggregate("x", F.lit(0).cast("long"), lambda s, v: s + v.cast("long") * v)).alias("norm"))
    kind = lengths.orderBy(F.desc("n"), F.desc("length")).first()
    length, n, n_anchors, norm = (kind.length, kind.n, kind.anchors, kind.norm) if kind else (0, 0, 0, 0)
    rows = rows.filter(F.size("x") == length)
    primes, n_blocks = primes_for(max(norm, 1)), max(1, -(-n_anchors // block_anchors))
    none = F.lit(None).cast("array<struct<key:long,id:long,score:long>>")
    packs = packed(rows.withColumn("wanted", none), max(1, -(-n // block_rows)), block_rows)
    packs = packs.withColumn("part", F.pmod("block", GROUPS)).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_blocks - 1).cast("long"))))
    packs = packs.select("block", "part", *[F.col(c).alias(f"r_{c}") for c in ("size", "keys", "ids", "labels", "vectors")])

    def met(anchors: DataFrame, name: str) -> DataFrame:
        blocks = staged(packed(anchors, n_blocks, block_anchors), f"negatives-{name}")
        blocks = blocks.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(GROUPS - 1).cast("long"))))
        pairs = blocks.join(packs, ["block", "part"]).drop("part").sortWithinPartitions("block")
        return pairs.mapInArrow(_meet(primes, positives, negatives, band), FOUND)

    anchors = rows.filter(is_anchor)
    order = [F.desc("score"), "other_id", "other"]
    near = met(anchors.withColumn("wanted", none), "anchors")
    near = near.withColumn("rank", F.row_number().over(Window.partitionBy("anchor").orderBy(*order))).filter(F.col("rank") <= positives)
    wanted = near.groupBy("anchor").agg(F.collect_list(F.struct(F.col("other").alias("key"), F.col("other_id").alias("id"), "score")).alias("wanted"))
    asked = staged(anchors.join(wanted, anchors["key"] == wanted["anchor"]).drop("anchor"), "negatives-positives")
    found = met(asked, "asked")
    place = F.row_number().over(Window.partitionBy("anchor", "positive").orderBy(*order))
    return found.withColumn("rank", place).filter(F.col("rank") <= negatives).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("other_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))
