import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fintide.llm import langid as L


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    model = L.learn(docs.filter(~L.held_out()))
    assert model.langs == ["de", "en", "es", "fr"] and (model.false_share < 0.02).all()
    got = L.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id").withColumn("held_out", L.held_out())
    r = got.filter("held_out").agg(F.count("*").alias("n"), F.count_if(F.col("lang") == F.col("lang_pred")).alias("right")).first()
    assert r.n == 3358 and r.right >= 0.995 * r.n


def test_filter_contains_what_was_put_in_and_little_else():
    rng = np.random.default_rng(4)
    table = np.zeros((1 << 14, 2), np.uint64)
    sets = {i: rng.integers(0, 2**63, 800).astype(np.uint64) for i in (0, 5, 64, 70)}
    for i, codes in sets.items():
        for at in L.slots_of(codes, 4, len(table)):
            table[at, i // 64] |= np.uint64(1 << i % 64)
    model = L.LanguageFilter([f"l{i:03}" for i in range(71)], table, 4)
    for i, codes in sets.items():
        n, hits = model.counts(iter([codes]))
        assert hits[i] == n == 800
        others = [j for j in sets if j != i]
        assert (np.abs(hits[others] - n * model.false_share[others]) < 25).all()


def naive_grams(text, order):
    words = "".join(c.lower() if c.isalpha() else " " for c in text).split()
    joined = " " + " ".join(words) + " " if words else ""
    return [joined[i : i + order] for i in range(len(joined) - order + 1)]


@pytest.mark.parametrize("text", ["Ab, c!", "a", "élan vital\n\nÜBER", "  x  ", "1 2 3", "", "日本語 text", "a1b2c3"])
def test_grams_are_those_of_the_letters(text):
    x = L.reduced(text)
    for order in (3, 4):
        want = naive_grams(text, order)
        got = L.grams(x, order)
        assert len(got) == len(want)
        assert len(set(got.tolist())) == len(set(want))
        assert [got.tolist().index(g) for g in got.tolist()] == [want.index(g) for g in want]


def test_counts_over_many_texts_and_slices(spark, monkeypatch):
    rnd = random.Random(5)
    rows = [(rnd.choice("xy"), "".join(rnd.choice("abÉ 1") for _ in range(rnd.randint(0, 200)))) for _ in range(80)]
    want = {}
    for lang, text in rows:
        for order in (3, 4):
            for g in naive_grams(text, order):
                code = int(L.grams(np.array([0 if c == " " else ord(c) for c in g], np.uint32), order)[0])
                want[lang, order, code] = want.get((lang, order, code), 0) + 1
    for size in (37, 1 << 19):
        monkeypatch.setattr(L, "SLICE", size)
        run, got = L._counted((3, 4)), {}
        batch = __import__("pyarrow").RecordBatch.from_arrays([[r[0] for r in rows], [r[1] for r in rows]], ["lang", "text"])
        for b in run(iter([batch])):
            for r in b.to_pylist():
                k = (r["lang"], r["order"], r["code"] % 2**64)
                got[k] = got.get(k, 0) + r["c"]
        assert got == want


def test_defined_cases(spark):
    rows = [(1, "the cat and the dog and the bird", "en"), (2, "le chat et le chien et le loup", "fr"), (2, "le chat et le chien et le loup", "fr"),
            (3, None, "en"), (4, "", "fr"), (5, "12 34 !!", None), (None, "the dog", None), (6, "the bird and the cat", None), (7, "漢字", None),
            (8, "le loup " * 300_000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("x")).withColumn("code", F.lit(1))
    model = L.learn(docs, least_share=1e-3)
    got = [tuple(r) for r in L.predict(docs, model).collect()]
    assert len(got) == len(rows)
    preds = {}
    for i, lang, score in got:
        assert 0.0 <= score <= 1.0
        preds.setdefault(i, set()).add(lang)
    assert preds[1] == {"en"} and preds[2] == {"fr"} and preds[6] == {"en"} and preds[None] == {"en"} and preds[8] == {"fr"}
    assert preds[3] == preds[4] == preds[5] == {"und"} and preds[7] <= {"en", "fr"}
    empty = L.learn(docs.limit(0))
    assert empty.langs == [] and {r.lang_pred for r in L.predict(docs, empty).collect()} == {"und"}
    assert L.predict(docs.limit(0), model).count() == 0


def test_label_is_no_input_of_a_prediction(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").limit(200)
    model = L.learn(docs)
    a = L.predict(docs, model).collect()
    b = L.predict(docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit("y")), model).collect()
    assert sorted(a) == sorted(b)
