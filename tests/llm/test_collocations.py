import random
import re
from collections import Counter

import pyarrow as pa
import pytest

from fintide.llm import collocations as C

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least=10, cover=50, top=2000):
    f = {}
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            for n in (1, 2, 3):
                f.setdefault(lang or "und", Counter()).update(zip(*[w[i:] for i in range(n)]))
    out = []
    for lang, count in f.items():
        n = sum(c for p, c in count.items() if len(p) == 1)
        longer = [(p, c) for p, c in count.items() if len(p) == 3 and c >= least]
        found = []
        for p, a in count.items():
            if len(p) == 1 or a < least:
                continue
            if len(p) == 2 and any(100 * c >= cover * a and p in (q[:2], q[1:]) for q, c in longer):
                continue
            cuts = [(1000000 * a * a // (count[p[:k]] * count[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            found.append((-score, -a, " ".join(p).encode(), count[p[:k]], count[p[k:]]))
        for rank, (s, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -s))
    return sorted(out)


def found(spark, rows, **args):
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    return sorted(tuple(r) for r in C.collocations(docs, **args).collect())


def zipf(rnd, words, n):
    return [words[min(int(rnd.paretovariate(0.8)) - 1, len(words) - 1)] for _ in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, monkeypatch, seed):
    rnd = random.Random(seed)
    monkeypatch.setattr(C, "BLOCK_BYTES", 700)  # many blocks, and texts cut at breaks
    words = ["The", "of", "a|b", "naïve", "É", "é", "x" * 30, "ab", "b", "c%", "d", "E", "f#", "%20"]
    rows = []
    for i in range(60):
        text = "".join(w + rnd.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", " \x0b"]) for w in zipf(rnd, words, 150))
        rows.append((rnd.choice(["en", "en", "fr", None, "a b", "und"]), text))
    rows += [("en", None), ("fr", ""), ("en", " . ,, \n"), (None, "!")] + rows[:5]
    assert found(spark, rows) == brute(rows)
    assert found(spark, rows, least=3, cover=80, top=7) == brute(rows, 3, 80, 7)


def test_hot_pairs_are_dealt_by_their_third_word(spark, monkeypatch):
    rnd = random.Random(3)
    monkeypatch.setattr(C, "HOT_SAMPLE", 1.0)
    rows = [("en", " ".join(f"of the w{rnd.randint(0, 40)}" for _ in range(30))) for _ in range(30)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    assert "of the en" in C.hot_pairs(docs)
    parts = {r.gram.split(" ")[2] for r in C.windows(docs, hot=["of the en"]).collect() if r.gram.startswith("of the ")}
    assert len(parts) > 10 and "0" not in parts
    assert found(spark, rows) == brute(rows)
    assert found(spark, rows, least=400) == brute(rows, 400)  # third words are all rare, the pair is not


def test_cut_streams_over_batches():
    rows = [("a b 0 en", "x", 6), ("a b 0 en", "x", 5), ("a b 0 en", "y", 2), ("a c 0 en", "", 3), ("a c 0 en", "z", 1), ("a d 7 en", "q", 1),
            ("b  0 en", "", 4)]
    whole = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["head", "third", "c"])
    want = None
    for size in (1, 2, 3, 100):
        got = Counter()
        for batch in C._cut(10)(whole.slice(i, size) for i in range(0, len(rows), size)):
            for r in batch.to_pylist():
                got[r["lang"], r["w1"], r["w2"], r["w3"]] += r["c"]
        want = want or got
        assert got == want == {("en", "a", "b", "x"): 11, ("en", "a", "b", ""): 2, ("en", "a", "", ""): 4, ("en", "a", "d", ""): 1, ("en", "b", "", ""): 4}


def test_large_counts_are_exact(spark):
    row = spark.range(1).select(C.score(*[C.F.lit(v).cast("long") for v in (3_000_000_017, 3_000_000_019, 4_000_000_007)]).alias("s")).first()
    assert row.s == 1000000 * 3_000_000_017**2 // (3_000_000_019 * 4_000_000_007)


def test_empty_table_and_clashing_columns(spark):
    assert found(spark, []) == []
    docs = spark.createDataFrame([("en", "a b. " * 12, 1, "x", 2)], "lang string, text string, c int, head string, w1 int")
    assert [tuple(r) for r in C.collocations(docs).collect()] == [("en", 1, "a b", 12, 12, 12, 24, 1000000)]
