import numpy as np
import pytest

from fintide.llm import ann as A


def brute(ids, x, queries, k=10):
    out = {}
    for q in queries:
        at = ids.index(q)
        d = np.sqrt(((x - x[at]) ** 2).sum(1))
        order = sorted((d[i], ids[i]) for i in range(len(ids)) if ids[i] != q)
        out[q] = order[:k]
    return out


def found(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert r.rank == len(out[r.query_id])
    return out


@pytest.mark.parametrize("table", ["sf0.01", "sf0.1"])
def test_recall_on_whole_table(spark, table):
    t = spark.read.parquet(f"/root/testdata/{table}/embeddings.parquet")
    rows = t.collect()
    ids, x = [r.vec_id for r in rows], np.array([r.embedding for r in rows], np.float64)
    got = found(A.nearest(t, t.filter("vec_id % 100 = 0")).collect())
    want = brute(ids, x, [i for i in ids if i % 100 == 0])
    assert got.keys() == want.keys()
    hits = sum(len({v for _, v in got[q]} & {v for _, v in want[q]}) for q in want)
    assert hits >= 0.95 * sum(map(len, want.values()))
    place = {v: i for i, v in enumerate(ids)}
    for q, near in got.items():
        assert len(near) == len(want[q]) and near == sorted(near)
        for s, v in near:
            assert s == pytest.approx(np.sqrt(((x[place[v]] - x[place[q]]) ** 2).sum()), rel=1e-12)


def test_hot_vector_and_parts(spark, monkeypatch):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(900, 8))
    x[::3] = x[0]  # a third of all rows is one vector
    x[1::9] = x[0] + rng.normal(size=(100, 8)) * 1e-6
    rows = [(int(i), x[i].tolist()) for i in range(900)]
    monkeypatch.setattr(A, "MAX_LIST", 40)
    t = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = found(A.nearest(t, t.filter("vec_id % 100 = 0")).collect())
    want = brute(list(range(900)), x, range(0, 900, 100))
    hits = sum(len(set(v for _, v in got[q]) & set(v for _, v in want[q])) for q in want)
    assert hits >= 0.95 * 90
    for q in range(0, 900, 300):  # queries of the hot vector: zero distance, smallest ids
        assert [v for _, v in got[q]] == [v for _, v in want[q]] and got[q][0][0] == 0.0


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (100, [1.0, 0.0]), (100, [1.0, 0.0]), (2, [0.0, 1.0]), (3, None), (4, [0.0, 0.0]), (5, [None, 1.0]),
            (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [1.0]), (9, []), (None, [1.0, 1.0]), (200, [-1.0, 0.0]), (300, None)]
    t = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, rank int")
    got = found(A.nearest(t, t.filter("vec_id % 100 = 0")).collect())
    assert {q: [v for _, v in n] for q, n in got.items()} == {0: [100, 2, 200], 100: [0, 2, 200], 200: [2, 0, 100]}
    assert A.nearest(t.limit(0), t).count() == 0 and A.nearest(t, t.limit(0)).count() == 0
    one = t.filter("vec_id = 2")
    assert A.nearest(one, one).count() == 0


def test_graph_search_finds_the_nearest_centroids():
    rng = np.random.default_rng(2)
    points = rng.normal(size=(700, 16))
    c = A.Centroids(points)
    x = rng.normal(size=(50, 16))
    ids, dist = c.search(x, 64)
    exact = np.argsort(A.squared(x, c.points), axis=1)[:, :8]
    hits = sum(len(set(a.tolist()) & set(b.tolist())) for a, b in zip(ids[:, :16], exact))
    assert hits >= 0.95 * exact.size
    assert (np.diff(dist, axis=1) >= 0).all()


def test_lists_are_balanced():
    rng = np.random.default_rng(3)
    sample = np.concatenate([rng.normal(size=(2000, 8)) * 0.01, rng.normal(size=(500, 8)) * 3])
    centers = A.balanced_centroids(sample, 50)
    assert np.bincount(A.squared(sample, centers).argmin(1), minlength=len(centers)).max() <= 4 * len(sample) / 50


def test_recall_with_many_small_lists(spark, monkeypatch):
    """The share of lists that a query needs follows from the data, not from a fixed number of lists."""
    monkeypatch.setattr(A, "LIST_SIZE", 8)
    monkeypatch.setattr(A, "LEAST_CANDIDATES", 16)
    x = np.random.default_rng(6).normal(size=(6000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    t = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = found(A.nearest(t, t.filter("vec_id % 100 = 0")).collect())
    want = brute(list(range(6000)), x, range(0, 6000, 100))
    hits = sum(len({v for _, v in got.get(q, [])} & {v for _, v in want[q]}) for q in want)
    assert hits >= 0.93 * 600


def test_every_row_of_a_repeated_id_is_a_candidate(spark):
    rows = [(1, [1.0, 1.0]), (7, [-100.0, 1.0]), (7, [1.0, 1.1]), (7, [1.0, 1.2]), (8, [1.0, 3.0]), (9, [1.0, 2.0]), (9, [1.0, 1.05])]
    t = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = found(A.nearest(t, t.filter("vec_id = 1"), k=3).collect())
    assert [(v, round(s, 9)) for s, v in got[1]] == [(9, 0.05), (7, 0.1), (8, 2.0)]
    twice = A.nearest(t, t.filter("vec_id = 9"), k=1).collect()  # both rows of the query search
    assert sorted((r.vec_id, round(r.score, 9), r.rank) for r in twice) == [(1, 0.05, 1), (7, 0.8, 1)]


def test_many_near_rows_of_one_id_do_not_crowd_out_others(spark):
    rows = [(1, [1.0, 1.0])] + [(7, [1.0, 1.0 + i / 1000]) for i in range(1, 60)] + [(10 + i, [1.0, 2.0 + i]) for i in range(12)]
    t = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = found(A.nearest(t, t.filter("vec_id = 1"), k=10).collect())
    assert [v for _, v in got[1]] == [7] + list(range(10, 19))


def test_queries_search_the_graph_and_not_all_centroids():
    rng = np.random.default_rng(3)
    middles = rng.normal(size=(40, 16))
    c = A.Centroids(middles[rng.integers(0, 40, 4000)] + 0.4 * rng.normal(size=(4000, 16)))
    sizes, spread = np.full(4000, 256), np.full(4000, 0.5)
    x = middles[rng.integers(0, 40, 64)] + 0.4 * rng.normal(size=(64, 16))
    row, lists = A.lists_read(c, x, sizes, spread, 0.12)
    assert c.compared < 2000
    ids, dist = c.search(x, 4000)
    excess, _ = A.excesses(ids, dist, sizes, np.zeros(4000))
    want = {(i, j) for i in range(64) for j in ids[i][excess[i] <= 0.12].tolist()}
    assert len(want & set(zip(row.tolist(), lists.tolist()))) >= 0.95 * len(want)


def test_queries_of_a_hot_list_are_dealt_to_copies_of_it(spark, monkeypatch):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(600, 8))
    x[:400] = x[0] + 0.001 * rng.normal(size=(400, 8))
    t = spark.createDataFrame([(i, x[i].tolist()) for i in range(600)], "vec_id long, embedding array<double>")
    queries = t.filter("vec_id < 300")
    want = {(r.query_id, r.rank, r.vec_id) for r in A.nearest(t, queries).collect()}
    monkeypatch.setattr(A, "MAX_PROBES", 7)
    assert {(r.query_id, r.rank, r.vec_id) for r in A.nearest(t, queries).collect()} == want
