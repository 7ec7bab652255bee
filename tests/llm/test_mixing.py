import re

import pytest

from fintide.llm import mixing as M

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_targets(sizes):
    """Share by weight; what a source cannot take is shared again among the others."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, rest, open_ = dict.fromkeys(order, 0.0), 1.5 * sum(sizes.values()), set(order)
    while rest > 1e-9 and open_:
        total = sum(weight[s] for s in open_)
        for s in open_:
            target[s] += rest * weight[s] / total
        rest = sum(max(0.0, target[s] - 2 * sizes[s]) for s in open_)
        for s in list(open_):
            if target[s] >= 2 * sizes[s]:
                target[s] = 2.0 * sizes[s]
                open_.discard(s)
    return target


@pytest.mark.parametrize("table", ["sf0.01", "sf0.1"])
def test_whole_table(spark, table):
    docs = spark.read.parquet(f"/root/testdata/{table}/documents.parquet")
    rows = M.mix_report(docs).collect()
    texts = {r.doc_id: (r.source, len(WORD.findall(r.text or ""))) for r in docs.collect()}
    assert {r.doc_id: (r.source, r.size) for r in rows} == texts and len(rows) == len(texts)
    sizes, taken, longest = {}, {}, {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        longest[r.source] = max(longest.get(r.source, 0), r.size)
        assert 0 <= r.taken <= 2 * r.size
    want = brute_targets(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source], rel=1e-9)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= max(2 * longest[s], 0.01 * want[s]), (s, taken[s], want[s])
    again = {(r.doc_id, r.taken) for r in M.mix_report(docs.repartition(7)).collect()}
    assert again == {(r.doc_id, r.taken) for r in rows}


def test_number_of_copies_is_conserved(spark):
    """The pivotal method keeps the sum of probabilities: copies per source are its rate times its documents, to one."""
    docs = spark.createDataFrame([(i, "s%d" % (i % 3 if i % 2 else 0), "w " * (10 + i % 50)) for i in range(5000)],
                                 "doc_id long, source string, text string")
    units = M.sized(docs)
    done = M.copies(units, M.source_targets(units), chunk=16).collect()
    by = {}
    for r in done:
        by.setdefault(r.source, []).append(r)
    for rows in by.values():
        rate = rows[0].target / rows[0].source_size
        assert abs(sum(r.copies for r in rows) - rate * len(rows)) <= 1 + 1e-6
        assert {r.copies for r in rows} <= {int(rate), int(rate) + 1}


def test_edges_and_mix(spark):
    rows = [(1, "b", "x y z", 1), (1, "b", "x y z", 2), (2, "b", None, 3), (3, None, "u v", 4), (None, "a", "one", 5),
            (None, "a", "one", 6), (4, "z", "", 7), (5, "ä", "w " * 40_000, 8)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string, size int")
    got = M.mix_report(docs).collect()
    assert len(got) == len(rows)
    sizes = {"a": 2, "b": 6, "z": 0, "ä": 40_000, None: 2}
    want = brute_targets(sizes)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert r.taken <= 2 * r.size
    mixed = M.mix(docs)
    assert mixed.columns == docs.columns
    words = {}
    for r in mixed.collect():
        words[r.doc_id, r.source] = words.get((r.doc_id, r.source), 0) + len((r.text or "").split())
    told = {}
    for r in got:
        told[r.doc_id, r.source] = told.get((r.doc_id, r.source), 0) + r.taken
    assert {k: v for k, v in words.items() if v} == {k: v for k, v in told.items() if v}
    assert M.mix_report(docs.limit(0)).count() == 0 and M.mix(docs.limit(0)).count() == 0
