"""Approximate nearest neighbours over balanced posting lists.

The index is a set of posting lists around centroids:

* Centroids are fitted by k-means on a bounded sample (``SAMPLE`` vectors,
  chosen by hash) and split until no centroid has more than twice the mean
  number of sample vectors, so lists are balanced.  Their number follows the
  table (``LIST_SIZE`` vectors a list) up to ``MAX_CENTROIDS``, which bounds
  what is broadcast: the centroids and a neighbour graph over them.
* Every vector is filed under its nearest centroid and, where it lies near
  boundaries, under the further ones within ``1 + CLOSURE`` times the nearest
  distance, ``REPLICAS`` in all at most.
* A vector's centroids are found by a batched best-first search of the graph in
  memory.
* A query searches the same graph.  It reads the nearest lists until they hold
  ``LEAST_CANDIDATES`` vectors together, and all lists whose centroid distance
  is within ``1 + prune`` times the last of those: the beam starts at ``QUERY_BEAM``
  centroids and is doubled for the queries whose last centroid found is still
  within that ratio.  Of the centroids found, a list of vectors close together
  is read as well if its members are typically as near to the query as those of
  the nearest list (squared distance plus the list's mean square).
* ``prune`` is measured on every table: the true neighbours of ``TUNING`` queries
  (chosen by hash) are found by comparing them with all rows, and ``prune`` is the
  least value that reads ``RECALL`` of those neighbours, ``PRUNE`` at least.  So
  the share of lists read follows the data and the number of lists.
* Equal vectors are indexed and searched once, with the ids that can matter.
  A list that still holds more than ``MAX_LIST`` vectors is cut into parts by a
  hash, and a query reads all parts; the queries of a list that is read by more
  than ``MAX_PROBES`` are dealt to as many copies of it.  So no task holds an
  unbounded list or all of its queries, and no row is left out.

Distances are Euclidean, in double precision on the original vectors.

Defined cases: vectors that are NULL, zero, hold a NULL or non-finite
component, or have another length than the table's most frequent one take no
part, neither as queries nor as candidates; rows with a NULL id neither.
All rows of a repeated id are candidates; the id counts once, with its smallest
distance, and of a query with a repeated id each row searches.  Ties go to the smaller
id.  An empty table has no neighbours.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fintide.llm.common import first_by_hash, staged

SAMPLE = 32768
SAMPLE_VALUES = 1 << 22  # of all components of the sample
LIST_SIZE = 256
MAX_CENTROIDS = 8192
DEGREE = 16
FILING_BEAM = 24
QUERY_BEAM = 64
CLOSURE = 0.15
REPLICAS = 4
PRUNE = 0.12
LEAST_CANDIDATES = 512
TUNING = 256
RECALL = 0.97
MAX_LIST = 2048
MAX_PROBES = 2048
BATCH = 1024
PROBES = 128  # queries that search the graph at once
SEED = 11


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of a to all rows of b (only for choosing centroids)."""
    return np.maximum((a * a).sum(1)[:, None] - 2.0 * (a @ b.T) + (b * b).sum(1)[None, :], 0.0)


class Centroids:
    """Centroids with a neighbour graph and a batched best-first search over it."""

    def __init__(self, points: np.ndarray, degree: int = DEGREE):
        self.points = points.astype(np.float32)
        k = len(points)
        near = []
        for at in range(0, k, 512):  # blocks: k is at most MAX_CENTROIDS
            d = squared(self.points[at : at + 512], self.points)
            d[np.arange(len(d)), np.arange(at, at + len(d))] = -1.0
            near.append(np.argsort(d, axis=1, kind="stable")[:, 1 : degree + 1])
        near = np.concatenate(near) if k > 1 else np.zeros((1, 1), np.int64)
        # A few far links keep the graph connected; entries are spread over it.
        rng = np.random.default_rng(SEED)
        self.graph = np.concatenate([near, rng.integers(0, k, (k, 4))], axis=1).astype(np.int32)
        self.order = rng.permutation(k).astype(np.int32)
        self.compared = 0  # of the last search: centroids that a row was compared with, at most

    def search(self, x: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, distances) of about the nearest ``beam`` centroids of each row of x, nearest first; of all of them, exactly."""
        x, n, k = x.astype(np.float32), len(x), len(self.points)
        beam = min(beam, k)
        rows, entries = np.arange(n)[:, None], self.order[:beam]
        ids = np.broadcast_to(entries, (n, beam)).copy()
        dist = squared(x, self.points[entries])
        seen = np.zeros((n, k), bool)
        seen[rows, ids] = True
        open_ = np.full(ids.shape, beam < k)
        while True:
            front = np.where(open_, dist, np.inf)
            best = front.argsort(axis=1, kind="stable")[:, :4]  # expand the four nearest open ones of every row
            live = np.isfinite(np.take_along_axis(front, best, 1))
            if not live.any():
                break
            np.put_along_axis(open_, best, False, 1)
            new = self.graph[np.take_along_axis(ids, best, 1)].reshape(n, -1)
            fresh = ~seen[rows, new] & np.repeat(live, self.graph.shape[1], axis=1)
            seen[rows, new] |= fresh
            # The same centroid may come from two parents: keep its first place only.
            order = np.argsort(new, axis=1, kind="stable")
            ordered = np.take_along_axis(new, order, 1)
            twice = np.zeros(new.shape, bool)
            np.put_along_axis(twice, order[:, 1:], ordered[:, 1:] == ordered[:, :-1], 1)
            fresh &= ~twice
            c = self.points[new]
            d = np.where(fresh, np.einsum("nmd,nmd->nm", c - x[:, None, :], c - x[:, None, :]), np.inf)
            ids, dist = np.concatenate([ids, new], 1), np.concatenate([dist, d], 1)
            open_ = np.concatenate([open_, fresh], 1)
            keep = dist.argsort(axis=1, kind="stable")[:, :beam]
            ids, dist, open_ = (np.take_along_axis(v, keep, 1) for v in (ids, dist, open_))
            open_ &= np.isfinite(dist)
        self.compared = int(seen.sum(1).max()) if n else 0
        order = dist.argsort(axis=1, kind="stable")
        return np.take_along_axis(ids, order, 1), np.sqrt(np.take_along_axis(dist, order, 1))


def balanced_centroids(sample: np.ndarray, k: int, rounds: int = 6) -> np.ndarray:
    """k-means on the (distinct) sample, then halve every cluster above twice the mean size until none can be split."""
    points = sample.astype(np.float32)
    k = max(1, min(k, len(points)))
    centers = points[np.random.default_rng(SEED).permutation(len(points))[:k]]

    def members(to: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows ordered by their nearest center; the non-empty centers and where their rows begin."""
        at = np.concatenate([squared(points[i : i + 2048], to).argmin(1) for i in range(0, len(points), 2048)])
        order = at.argsort(kind="stable")
        used, starts = np.unique(at[order], return_index=True)
        return order, used, starts

    for _ in range(rounds):
        order, used, starts = members(centers)
        counts = np.diff(np.append(starts, len(points)))
        centers = centers.copy()
        centers[used] = np.add.reduceat(points[order], starts, axis=0) / counts[:, None]
    order, _, starts = members(centers)
    limit, done, todo = max(2.0, 2.0 * len(points) / k), [], np.split(points[order], starts[1:])
    while todo:
        group = todo.pop()
        if len(group) <= limit or len(done) + len(todo) >= MAX_CENTROIDS - 1:
            done.append(group.mean(0))
            continue
        middle = group.mean(0)
        far = group[squared(group, middle[None])[:, 0].argmax()]
        along = ((group - middle) @ (far - middle)).argsort(kind="stable")  # halves towards the farthest member
        todo += [group[along[: len(group) // 2]], group[along[len(group) // 2 :]]]
    return np.array(done, np.float32)


def usable(table: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, v): rows with an id and a finite non-zero vector of the usual length."""
    rows = table.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v")).filter(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0))
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    rows = rows.filter(~F.exists("v", bad) & F.exists("v", lambda x: x != 0))
    usual = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    return rows.filter(F.size("v") == (usual[0]["d"] if usual else 0))


def _matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), dtype=np.float64)


def index(rows: DataFrame, centroids) -> DataFrame:
    """(list, away, vec_id, v, ids): every vector (``away`` from its centroid) under its nearest centroid and, near a boundary, under more."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = centroids.value
        for whole in frames:
            for at in range(0, len(whole), BATCH):
                part = whole.iloc[at : at + BATCH]
                ids, dist = c.search(_matrix(part["v"]), FILING_BEAM)
                ids, dist = ids[:, :REPLICAS], dist[:, :REPLICAS]
                row, col = np.nonzero(np.isfinite(dist) & (dist <= (1.0 + CLOSURE) * dist[:, :1]))
                out = part.iloc[row].copy()
                out.insert(0, "list", ids[row, col])
                out.insert(1, "away", dist[row, col].astype(np.float64))
                yield out

    return rows.mapInPandas(run, "list int, away double, vec_id long, v array<double>, ids array<long>")


def distinct_vectors(rows: DataFrame, least: int) -> DataFrame:
    """(vec_id, v, ids): every distinct vector once, with its ``least`` smallest ids in order (vec_id is the first).

    Of equal vectors, which tie at every distance, only that many can be among
    the nearest; the limit is applied before the shuffle.
    """
    place = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    few = rows.withColumn("_n", place).filter(F.col("_n") <= least)
    return few.groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")).select(
        F.col("ids")[0].alias("vec_id"), "v", "ids")


def excesses(ids: np.ndarray, dist: np.ndarray, sizes: np.ndarray, spread: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(excess, ratio) of lists in order of distance: the least ``prune`` at which a row reads each (inf for empty lists),
    and that by the distance ratio alone (0 as long as the lists hold too few candidates)."""
    weight = sizes[ids]
    before = np.cumsum(weight, axis=1) - weight
    base = np.where((before < LEAST_CANDIDATES) & (weight > 0), dist, 0.0).max(axis=1, keepdims=True)
    ratio = np.where(dist <= base, 0.0, dist / np.where(base > 0, base, 1e-30) - 1.0)
    typical = np.where(weight > 0, dist * dist + spread[ids], np.inf)  # squared, of a list's members
    first = np.argmax(weight > 0, axis=1)[:, None]
    excess = np.where(typical <= np.take_along_axis(typical, first, 1), 0.0, ratio)
    return np.where(weight > 0, excess, np.inf), ratio


def lists_read(c: Centroids, x: np.ndarray, sizes: np.ndarray, spread: np.ndarray, prune: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, list) pairs: the lists that each row of x reads."""
    rows, lists, open_, beam = [], [], np.arange(len(x)), QUERY_BEAM
    while len(open_):
        ids, dist = c.search(x[open_], beam)
        excess, ratio = excesses(ids, dist, sizes, spread)
        done = (ratio[:, -1] > prune) | (ids.shape[1] == len(c.points))
        row, col = np.nonzero((excess <= prune) & done[:, None])
        rows.append(open_[row])
        lists.append(ids[row, col])
        open_, beam = open_[~done], 2 * beam
    return np.concatenate(rows), np.concatenate(lists)


def exact_nearest(rows: DataFrame, x: np.ndarray, k: int) -> DataFrame:
    """(at, vec_id): the k nearest vectors, other than an equal one, of each row of x (few), among all ``rows``."""
    asked = rows.sparkSession.sparkContext.broadcast(x)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        q = asked.value
        ids, best = np.zeros((len(q), 0), np.int64), np.zeros((len(q), 0))
        for whole in frames:
            for at in range(0, len(whole), BATCH):
                part = whole.iloc[at : at + BATCH]
                v = _matrix(part["v"])
                d = squared(q, v)
                close = d <= 1e-9 * ((q * q).sum(1)[:, None] + (v * v).sum(1))  # rounding hides which are equal
                for i, j in zip(*np.nonzero(close)):
                    d[i, j] = ((q[i] - v[j]) ** 2).sum()
                d[d == 0] = np.inf
                ids = np.concatenate([ids, np.broadcast_to(part["vec_id"].to_numpy(), d.shape)], 1)
                best = np.concatenate([best, d], 1)
                keep = best.argsort(axis=1, kind="stable")[:, :k]
                ids, best = np.take_along_axis(ids, keep, 1), np.take_along_axis(best, keep, 1)
        row, col = np.nonzero(np.isfinite(best))
        yield pd.DataFrame({"at": row.astype(np.int32), "vec_id": ids[row, col], "d": best[row, col]})

    found = rows.select("vec_id", "v").mapInPandas(run, "at int, vec_id long, d double")
    place = F.row_number().over(Window.partitionBy("at").orderBy("d", "vec_id"))
    return found.withColumn("_n", place).filter(F.col("_n") <= k).select("at", "vec_id")


def tuned(rows: DataFrame, postings: DataFrame, searched: DataFrame, c: Centroids, sizes: np.ndarray, spread: np.ndarray,
          k: int) -> float:
    """The least ``prune``, ``PRUNE`` at least, at which a sample of the queries reads ``RECALL`` of its true neighbours."""
    few = first_by_hash(searched, "same", searched.count(), TUNING, SEED).select("v").toPandas()
    if not len(few):
        return PRUNE
    x = _matrix(few["v"])
    true = staged(exact_nearest(rows, x, k), "ann-true")  # at most TUNING * k rows
    held = true.join(postings.select("vec_id", "list"), "vec_id").collect()  # in REPLICAS lists each at most
    excess = np.full((len(x), len(c.points)), np.inf)
    for at in range(0, len(x), PROBES):  # the few sample queries are compared with every centroid
        ids, dist = c.search(x[at : at + PROBES], len(c.points))
        np.put_along_axis(excess[at : at + PROBES], ids, excesses(ids, dist, sizes, spread)[0], 1)
    least: dict = {}
    for r in held:
        key = r["at"], r["vec_id"]
        least[key] = min(least.get(key, np.inf), excess[r["at"], r["list"]])
    needs = sorted(least.values())
    return max(PRUNE, float(needs[int(np.ceil(RECALL * len(needs))) - 1])) if needs else PRUNE


def nearest(table: DataFrame, queries: DataFrame, k: int = 10, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each row of ``queries`` (same columns), itself left out."""
    spark = table.sparkSession
    rows = staged(distinct_vectors(usable(table, key, vector).distinct(), k + 1), "ann-rows")
    n = rows.count()
    schema = "query_id long, rank int, vec_id long, score double"
    if not n:
        return spark.createDataFrame([], schema)
    size = len(rows.first()["v"])
    sample = first_by_hash(rows.withColumn("h", F.xxhash64("v")), "h", n, min(SAMPLE, max(1, SAMPLE_VALUES // size)), SEED).select("v").toPandas()
    model = Centroids(balanced_centroids(_matrix(sample["v"]), min(MAX_CENTROIDS // 2, -(-n // LIST_SIZE))))
    shared = spark.sparkContext.broadcast(model)  # at most MAX_CENTROIDS vectors and their links
    postings = staged(index(rows, shared), "ann-postings")
    # Two numbers per list, at most MAX_CENTROIDS lists.
    sizes, spread = np.zeros(len(model.points), np.int64), np.zeros(len(model.points))
    for r in postings.groupBy("list").agg(F.count(F.lit(1)).alias("n"), F.avg(F.col("away") ** 2).alias("s")).collect():
        sizes[r["list"]], spread[r["list"]] = r["n"], r["s"]
    parts = np.maximum(1, -(-sizes // MAX_LIST))
    asked = staged(usable(queries, key, vector).distinct().select(F.col("vec_id").alias("query_id"), "v"), "ann-queries")
    # Equal query vectors are searched once.
    searched = asked.groupBy("v").agg(F.count(F.lit(1)).alias("_n")).select("v", F.xxhash64("v").alias("same"))
    prune = tuned(rows, postings, searched, model, sizes, spread, k)

    def probe(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = shared.value
        for whole in frames:
            for at in range(0, len(whole), PROBES):
                part = whole.iloc[at : at + PROBES]
                row, lists = lists_read(c, _matrix(part["v"]), sizes, spread, prune)
                fan = parts[lists]
                out = part.iloc[np.repeat(row, fan)].rename(columns={"v": "q"})
                which = [np.arange(f) for f in fan]
                yield pd.DataFrame({"list": np.repeat(lists, fan).astype(np.int32),
                                    "part": np.concatenate(which).astype(np.int32) if which else [],
                                    "same": out["same"].to_numpy(), "q": out["q"].to_numpy()})

    def by_list(counts: np.ndarray, name: str) -> DataFrame:
        return spark.createDataFrame([(i, int(counts[i])) for i in np.flatnonzero(counts > 1).tolist()], f"list int, {name} int")

    probes = staged(searched.mapInPandas(probe, "list int, part int, same long, q array<double>"), "ann-probes")
    turns = np.ones(len(model.points), np.int64)
    for r in probes.filter("part = 0").groupBy("list").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > MAX_PROBES).collect():
        turns[r["list"]] = -(-r["n"] // MAX_PROBES)
    many, often = F.broadcast(by_list(parts, "parts")), F.broadcast(by_list(turns, "turns"))  # at most MAX_CENTROIDS rows each
    filed = postings.drop("away").join(many, "list", "left").withColumn(
        "part", F.pmod(F.xxhash64("vec_id"), F.coalesce("parts", F.lit(1))).cast("int")).drop("parts")
    filed = filed.join(often, "list", "left").withColumn(
        "turn", F.explode(F.sequence(F.lit(0), F.coalesce("turns", F.lit(1)) - 1))).drop("turns")
    probes = probes.join(often, "list", "left").withColumn(
        "turn", F.pmod(F.xxhash64("same"), F.coalesce("turns", F.lit(1))).cast("int")).drop("turns")

    def compare(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            x, first, ids = _matrix(left["v"]), left["vec_id"].to_numpy(), left["ids"].to_numpy()
            for same, q in zip(right["same"], right["q"]):
                score = np.sqrt(((x - np.asarray(q)) ** 2).sum(axis=1))
                order = np.lexsort((first, score))
                seen, at = set(), 0  # ids, not vectors, are counted: an id may stand with several
                while at < len(order) and len(seen) <= k:
                    seen.update(ids[order[at]])
                    at += 1
                order = order[:at]
                out.append(pd.DataFrame({"same": same, "vec_id": first[order], "score": score[order], "ids": ids[order]}))
        return pd.concat(out) if out else pd.DataFrame(
            {"same": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64"),
             "ids": pd.Series(dtype=object)})

    found = filed.groupBy("list", "part", "turn").cogroup(probes.groupBy("list", "part", "turn")).applyInPandas(
        compare, "same long, vec_id long, score double, ids array<long>")
    best = found.select("same", "score", F.explode("ids").alias("vec_id")).groupBy("same", "vec_id").agg(F.min("score").alias("score"))
    place = F.row_number().over(Window.partitionBy("same").orderBy("score", "vec_id"))
    best = best.withColumn("_n", place).filter(F.col("_n") <= k + 1).drop("_n")
    asked = asked.join(searched, "v").select("query_id", "same")
    answered = asked.join(best, "same").filter("vec_id <> query_id")
    row = F.row_number().over(Window.partitionBy("query_id", "same").orderBy("score", "vec_id"))
    return answered.withColumn("rank", row).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
