import collections
import pathlib
import re
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as E
import corpus_pipeline as P
from fintide.llm import common, line_dedup, mixing, packing
from test_line_dedup import brute as clean_lines
from test_mixing import brute_targets
from test_packing import PATH, check_places
from test_simhash import brute_components, brute_print

SF = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows_of(df):
    return [tuple(r[c] for c in COLUMNS) for r in df.collect()]


@pytest.fixture(scope="module")
def stages(spark):
    """(input rows, output rows) of every stage, each run on its predecessor's written result."""
    docs, out = common.read_table(spark, SF, "documents"), {}
    for name, stage in P.STAGES:
        done = common.staged(stage(spark, docs, SF), f"test-{name}")
        out[name] = (docs, done)
        docs = done
    return out


def test_stage_list():
    assert [n for n, _ in P.STAGES] == ["quality_rules", "line_dedup", "simhash_near_dedup", "mix_sources", "best_fit_packing"]
    assert P.ORACLE_SQL is None


def test_quality_stage(spark, stages):
    before, after = (rows_of(x) for x in stages["quality_rules"])
    kept = set(after)
    assert stages["quality_rules"][1].columns == COLUMNS and kept <= set(before) and len(after) == len(kept)
    labels = {r.doc_id: (r.quality, r.toxic) for r in common.read_table(spark, SF, "labels").collect()}
    clean = [r for r in before if labels.get(r[0]) == (1, 0) and len(r[1].split()) >= 10]
    junk = [r for r in before if labels.get(r[0], (1, 0))[0] == 0]
    assert sum(r in kept for r in clean) >= 0.98 * len(clean) and sum(r in kept for r in junk) <= 0.1 * len(junk)


def test_line_stage(stages):
    before, after = (rows_of(x) for x in stages["line_dedup"])
    want = clean_lines([(r[3], r[1]) for r in before], line_dedup.MAX_RATIO, line_dedup.MIN_PAGES)
    assert sorted(after) == sorted((r[0], t, *r[2:]) for r, t in zip(before, want))


def test_near_dedup_stage(stages):
    before, after = (rows_of(x) for x in stages["simhash_near_dedup"])
    ids = [r[0] for r in before]
    smallest = set(brute_components([brute_print(r[1]) for r in before], ids))
    assert sorted(after) == sorted(r for r in before if r[0] in smallest)


def test_mixing_stage(stages):
    before, after = (rows_of(x) for x in stages["mix_sources"])
    n = collections.Counter(after)
    assert set(n) <= set(before) and max(n.values()) <= 2
    size = lambda r: len((r[1] or "").split())
    sizes, taken, longest = collections.Counter(), collections.Counter(), collections.Counter()
    for r in before:
        sizes[r[3]] += size(r)
        taken[r[3]] += n[r] * size(r)
        longest[r[3]] = max(longest[r[3]], size(r))
    for source, target in brute_targets(sizes).items():
        assert abs(taken[source] - target) <= max(2 * longest[source], 0.01 * target)


def test_packing_stage(stages):
    before, after = stages["best_fit_packing"]
    tokenizer = Tokenizer.from_file(PATH)
    want = collections.Counter()
    for r in rows_of(before):
        ids = [*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, packing.CLOSING_ID]
        for i in range(0, len(ids), 4096):
            want[r[0], i // 4096, len(ids[i : i + 4096]), zlib.crc32(np.array(ids[i : i + 4096], "<u4").tobytes())] += 1
    rows = after.collect()
    assert collections.Counter((r.doc_id, r.piece, r.length, r.ids_crc32) for r in rows) == want
    least = -(-sum(k[2] * n for k, n in want.items()) // 4096)
    assert check_places(rows, 4096) <= least * 1.01 + 1


def test_run_equals_its_stages(spark, stages):
    done = P.run(spark, SF)
    pieces = lambda df: sorted((r.doc_id, r.piece, r.length, r.ids_crc32) for r in df.collect())
    assert pieces(done) == pieces(stages["best_fit_packing"][1])


def test_run_on_empty_documents(spark, tmp_path):
    for name in ("documents", "labels"):
        common.read_table(spark, SF, name).limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert P.run(spark, str(tmp_path)).count() == 0


def test_entry_registers_one_query_per_operator():
    names = list(E.queries())
    for n in range(1, 11):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names and set(E.oracle_sql()) <= set(names)


def test_nothing_else_imports_the_subpackage():
    root = pathlib.Path(E.__file__).parent
    for path in [*root.glob("fintide/**/*.py"), *root.glob("*.py"), *root.glob("tests/*.py"), *root.glob("tools/*.py")]:
        if "llm" not in path.relative_to(root).parts and path.name not in ("__spark_entry__.py", "corpus_pipeline.py"):
            assert not re.search(r"(from|import) [\w.]*\bllm\b", path.read_text()), path


def test_mix_is_the_report(spark):
    docs = common.read_table(spark, SF, "documents")
    told = {r.doc_id: r.taken for r in mixing.mix_report(docs).collect()}
    words = collections.Counter()
    for r in mixing.mix(docs).collect():
        words[r.doc_id] += len(r.text.split())
    assert {d: w for d, w in told.items() if w} == dict(words)


CLASHES = ["_row", "_at", "_w", "_h", "_b", "_text", "_bad", "_host", "_source", "_row_key", "_doc", "_size", "_d", "_s", "_z", "copies",
           "_copy", "col", "k", "fp", "kept", "n_words", "host", "line", "page", "size", "rows", "target", "doc", "chain", "words", "_id",
           "sequence_id", "piece", "length", "row", "base", "email", "id"]


def test_stages_with_nulls_repeats_and_clashing_columns(spark):
    """Every stage on rows with NULLs in any column, blank and long texts, repeated rows and hostile extra columns."""
    good = [(i, f"text number {i} has quite a few words that differ in {i * 7} ways from {i * 13} others here", "en", f"s{i % 3}", 9)
            for i in range(40)]
    odd = [(None, good[0][1], None, None, None), (1, None, "en", "s1", 1), (2, "", None, "s2", None), (3, " \n\t", "de", None, 0),
           (None, None, None, None, None), good[4], good[4], (5, good[6][1], "fr", "s0", 3), (900, "long " * 30_000, "en", "s1", 1),
           (901, "a\nb\n" * 5000, "en", "s1", 1)]
    plain = spark.createDataFrame(good + odd, "doc_id long, text string, lang string, source string, n_chars long")
    from pyspark.sql import functions as F

    extra = plain.select("*", *[F.lit(f"mine {c}").alias(c) for c in CLASHES])
    for name, stage in P.STAGES:
        one, two = stage(spark, plain, SF), stage(spark, extra, SF)
        if name == "best_fit_packing":
            key = lambda df: sorted((str(r.doc_id), r.piece, r.length, r.ids_crc32) for r in df.collect())
            assert key(one) == key(two)
            continue
        assert one.columns == COLUMNS and two.columns == extra.columns
        assert sorted(map(str, rows_of(one))) == sorted(map(str, rows_of(two)))
        assert all(r[c] == f"mine {c}" for r in two.limit(3).collect() for c in CLASHES)
        assert stage(spark, plain.limit(0), SF).count() == 0
