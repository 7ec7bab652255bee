"""SimHash near-dedup with deletion-variant signatures.

``fingerprints`` gives every document a 64-bit SimHash of its word shingles.
To link fingerprints at up to ``MAX_BITS`` = 2 differing bits, the 64 bits are
cut into only two halves: of two bits one half must differ by at most one.
Each distinct fingerprint is indexed under every one-wildcard variant of each
half (the half without one bit, plus which bit was deleted): 64 rows.  Two
fingerprints of which a half differs by at most one bit share a variant, so an
equality match on (half, deleted bit, other 31 bits) finds every pair, and the
full distance verifies it.

Buckets are read as sorted streams with bounded memory.  A bucket of more than
``MAX_BUCKET`` distinct fingerprints (many texts share half a fingerprint) is
not paired off: its members are indexed by all their two-wildcard variants
instead (exact equality on 62 bits, at most four members a key), so every link
is still found and nothing is dropped.

Links are between distinct fingerprints; equal fingerprints are one node.
Components come from minimum-label rounds with pointer jumping over written
tables; nothing is collected.

Defined cases: NULL and blank texts have fingerprint zero and are linked like
any other.  Rows with a NULL id get a fingerprint and a component, but a NULL
id is never the smallest unless the component has no other.  Repeated rows and
repeated ids each keep their row.  Extra columns are ignored by ``components``
and pass through ``near_dedup``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fintide.llm.common import boxed, staged, unboxed

SHINGLE = 3
MAX_BITS = 2
SEED = 42
MAX_BUCKET = 32
BLOCK = 1 << 17  # shingles turned into bit counts at once


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """Unsigned SimHash of one UTF-8 text: a bit is set if more than half of the shingle hashes have it."""
    words = (text or b"").lower().split()  # bytes: lower-cases A-Z only, splits at the six ASCII spaces only
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    ones = np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, BLOCK):
        part = words[at : at + BLOCK + shingle - 1]
        # Every run of ``shingle`` words, space-joined; a shorter text is one shingle.
        grams = zip(*[part[i:] for i in range(shingle)]) if len(words) >= shingle else [words]
        hashes = np.array([digest(b" ".join(g), SEED) for g in grams], dtype="<u8")
        # Bit planes, least significant first.
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = 2 * ones > n
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, row_key, fp): one row per input row, ``fp`` the 64 bits as a signed long, ``row_key`` a hash of id and text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t, shingle) for t in b.column(2).to_pylist()], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fps, pa.int64())], ["doc_id", "row_key", "fp"])

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), row_key(key, text), F.col(text).cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, row_key long, fp long")


def row_key(key: str = "doc_id", text: str = "text") -> Column:
    return F.xxhash64(F.col(key).cast("long"), F.col(text)).alias("row_key")


def variant_rows(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, fp) for the 64 one-wildcard variants: 1 bit half, 5 bits deleted position, 31 bits rest."""
    u = fp.view(np.uint64)
    keys = []
    for half in (0, 1):
        part = (u >> np.uint64(32 * half)) & np.uint64(0xFFFFFFFF)
        for p in range(32):
            low = part & np.uint64((1 << p) - 1)
            rest = low | ((part >> np.uint64(p + 1)) << np.uint64(p))
            keys.append(rest | np.uint64(p << 31) | np.uint64(half << 36))
    return np.concatenate(keys).view(np.int64), np.tile(fp, 64)


#: The 2016 pairs of bit positions, as masks.
PAIR_MASKS = np.array([(1 << i) | (1 << j) for i in range(64) for j in range(i)], dtype=np.uint64)

LINKS = "a long, b long, crowded boolean"


def _bucket_links(limit: int):
    """Scan rows sorted by (key, fp): verified links inside each key, or the members of a key above ``limit``."""
    def links_of(members: np.ndarray, out: list) -> None:
        x = members.view(np.uint64)
        i, j = np.triu_indices(len(x), 1)
        near = np.bitwise_count(x[i] ^ x[j]) <= MAX_BITS
        tree, kept = list(range(len(x))), []
        for p, q in zip(i[near].tolist(), j[near].tolist()):  # a spanning forest of the bucket's links
            low, high = p, q
            while tree[low] != low:
                low = tree[low]
            while tree[high] != high:
                high = tree[high]
            if low != high:
                tree[max(low, high)] = min(low, high)
                kept.append((p, q))
        if kept:
            ends = np.array(kept)
            out.append((members[ends[:, 0]], members[ends[:, 1]], False))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.empty(0, np.int64)  # members of the open key so far, at most limit + 1
        held_key, over = None, False
        for b in batches:
            keys, fps = b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False)
            if not len(keys):
                continue
            out: list = []
            cut = np.flatnonzero(keys[1:] != keys[:-1]) + 1
            starts, ends = np.concatenate([[0], cut]), np.concatenate([cut, [len(keys)]])
            # Only the first run may continue the open key, and only the last stays open.
            wide = np.flatnonzero((ends - starts > 1) | (np.arange(len(starts)) == 0) | (np.arange(len(starts)) == len(starts) - 1))
            for r in wide:
                s, e, key = starts[r], ends[r], keys[starts[r]]
                if key != held_key:
                    if not over and len(held) > 1:
                        links_of(held, out)
                    held, held_key, over = np.empty(0, np.int64), key, False
                if over:
                    out.append((fps[s:e], fps[s:e], True))
                    continue
                held = np.concatenate([held, fps[s:e]])
                if len(held) > limit:
                    over = True
                    out.append((held, held, True))
                    held = np.empty(0, np.int64)
            yield _links(out)
        if not over and len(held) > 1:
            out = []
            links_of(held, out)
            yield _links(out)

    return run


def _links(parts: list) -> pa.RecordBatch:
    if not parts:
        cols = [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)]
    else:
        cols = [np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]),
                np.concatenate([np.full(len(p[0]), p[2]) for p in parts])]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["a", "b", "crowded"])


def links(nodes: DataFrame, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """Distinct (a, b), a < b, whose closure connects exactly the fingerprints (column fp) within two bits of each other.

    A bucket returns a spanning forest of its verified links.  A two-wildcard
    key returns a star from its smallest member (all members of such a key are
    within two bits of each other).
    """
    def variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 4096):
                k, f = variant_rows(b.column(0).slice(at, 4096).to_numpy(zero_copy_only=False))
                yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(f)], ["k", "fp"])

    keyed = nodes.select("fp").mapInArrow(variants, "k long, fp long")
    found = staged(keyed.repartition("k").sortWithinPartitions("k", "fp")
                   .mapInArrow(_bucket_links(max_bucket), LINKS).distinct(), "simhash-links")

    def pair_variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 64):
                f = b.column(0).slice(at, 64).to_numpy(zero_copy_only=False)
                masked = f.view(np.uint64)[:, None] & ~PAIR_MASKS[None, :]
                which = np.broadcast_to(np.arange(len(PAIR_MASKS), dtype=np.int16), masked.shape)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(which.ravel()), pa.array(masked.ravel().view(np.int64)),
                     pa.array(np.repeat(f, len(PAIR_MASKS)))], ["m", "rest", "fp"])

    crowd = found.filter("crowded").select(F.col("a").alias("fp"))
    second = crowd.mapInArrow(pair_variants, "m short, rest long, fp long").groupBy("m", "rest").agg(
        F.collect_set("fp").alias("s"))  # at most four members: they differ in two given bits only
    star = second.filter(F.size("s") > 1).select(F.array_min("s").alias("a"), F.explode("s").alias("b"))
    every = found.filter("NOT crowded").select("a", "b").unionByName(star.filter("a <> b"))
    return every.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the smallest node of its component.

    Each round hooks every root onto the smallest root beside it and then halves
    all paths; rounds grow with the logarithm of a component's width.
    """
    edges = staged(edges.select("a", "b"), "cc-edges")
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    first = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least_b"))
    label = staged(first.select("node", F.least("node", "least_b").alias("root")), "cc-label")
    while True:
        la = label.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        lb = label.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        seen = edges.join(la, "a").join(lb, "b").filter("ra <> rb")
        hooks = seen.select(F.greatest("ra", "rb").alias("node"), F.least("ra", "rb").alias("to")).groupBy("node").agg(
            F.min("to").alias("to"))
        up = label.join(hooks, "node", "left").select("node", F.coalesce(F.least("root", "to"), "root").alias("root"))
        up = staged(up, "cc-up")
        jump = up.select(F.col("node").alias("root"), F.col("root").alias("next"))
        after = staged(up.join(jump, "root", "left").select("node", F.coalesce("next", "root").alias("root")), "cc-label")
        changed = after.join(label.withColumnRenamed("root", "old"), "node").filter("root <> old").limit(1).count()
        label = after
        if not changed:
            return label


def classes(docs: DataFrame, shingle: int = SHINGLE, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """The staged fingerprints of all rows, and (fp, root) of every distinct fingerprint."""
    prints = staged(fingerprints(docs, shingle, key, text), "simhash-fp")
    nodes = prints.select("fp").distinct()
    roots = connected(links(nodes)).withColumnRenamed("node", "fp")
    return prints, nodes.join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def components(docs: DataFrame, shingle: int = SHINGLE, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp, component_id): component_id is the smallest id reachable over links, the own one included."""
    prints, roots = classes(docs, shingle, key, text)
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("least_id")).join(roots, "fp")
    classed = staged(nodes, "simhash-class")
    smallest = classed.groupBy("root").agg(F.min("least_id").alias("component_id"))
    ids = classed.join(smallest, "root").select("fp", "component_id")
    return prints.join(ids, "fp").select("doc_id", "fp", "component_id")


def near_dedup(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """One row of each component: the smallest id, of rows with one id the smallest row key, of equal rows any one."""
    prints, roots = classes(docs, shingle)
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_key")
    best = prints.groupBy("fp").agg(F.min(order).alias("best")).join(roots, "fp")
    chosen = best.groupBy("root").agg(F.min("best").alias("best")).select(F.col("best.row_key").alias("_row_key"))
    keyed = boxed(docs, _row_key=row_key())
    return keyed.join(chosen, "_row_key", "left_semi").dropDuplicates(["_row_key"]).select(*unboxed(docs.columns))
