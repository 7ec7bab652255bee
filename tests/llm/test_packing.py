import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from fintide.llm import packing as P

PATH = public_tokenizers.path("word_bpe_49k.json")


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def check_places(rows, length):
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= length
    return len(bins)


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    tokenizer = Tokenizer.from_file(PATH)
    want = []
    for r in docs.collect():
        ids = ids_of(tokenizer, r.text)
        want += [(r.doc_id, i // 4096, i, len(ids[i : i + 4096]), zlib.crc32(np.array(ids[i : i + 4096], "<u4").tobytes()))
                 for i in range(0, len(ids), 4096)]
    rows = P.pack_documents(docs, PATH, keep_ids=False).collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(want)
    n, least = check_places(rows, 4096), -(-sum(w[3] for w in want) // 4096)
    assert n <= least * 1.01 + 1
    many = P.pack_documents(docs, PATH, keep_ids=False, group_items=40, fan_in=3).collect()
    assert sorted((r.doc_id, r.piece) for r in many) == sorted(w[:2] for w in want)
    assert check_places(many, 4096) <= least * 1.05 + 2


TEXTS = [None, "", " ", "Plain words, and more.", "don't it's we'll o'clock", "3.14 + x_2 = ok!?", "ΟΔΟΣ Σ ς", "été naïve ÀÉÎ ß ÿ",
         "<|endoftext|> mid<|startoftext|>dle", "tab\tnew\nline\r\nvt\x0bnb sp em　", "漢字 かな 한글 😀👍🏽", "A" * 5000,
         "x" * 70 + " " + "y," * 100, "Ünïcödé, ... !!! ,,, word.,.,!! İstanbul ıI ﬁ", "́ leading", "a\u0000b ﻿bom", "word " * 9000,
         "a" * 40 + "̧́ q̣̇"]


def test_encoder_equals_whole_text(spark):
    tokenizer, encoder = Tokenizer.from_file(PATH), P.ChunkEncoder(PATH)
    for t in [t for t in TEXTS if t] * 2:
        assert encoder.ids(t).tolist() == tokenizer.encode(t, add_special_tokens=False).ids, t[:40]


def test_edges_round_trip(spark):
    docs = spark.createDataFrame([(i % 15 if i != 3 else None, t, "x") for i, t in enumerate(TEXTS + TEXTS[:3])],
                                 "doc_id long, text string, length string")
    tokenizer = Tokenizer.from_file(PATH)
    rows = P.pack_documents(docs, PATH).collect()
    check_places(rows, 4096)
    wholes = sorted(ids_of(tokenizer, t) for t in TEXTS + TEXTS[:3])
    # Long documents come back from their pieces; short ones are one piece each.
    short = [r.ids for r in rows if r.start == 0 and r.length < 4096]
    assert sorted(short) == sorted(w for w in wholes if len(w) < 4096)
    for w in (w for w in wholes if len(w) > 4096):
        assert all(w[i : i + 4096] in [r.ids for r in rows] for i in range(0, len(w), 4096))
    assert sum(r.length for r in rows) == sum(map(len, wholes))
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in rows)
    assert P.pack_documents(docs.limit(0), PATH).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_tree_is_near_one_best_fit(spark, seed):
    rng = np.random.default_rng(seed)
    sizes = np.minimum(1000, rng.lognormal(4.5, 1.2, 6000).astype(int) + 1)
    pieces = spark.createDataFrame([(i, 0, int(s)) for i, s in enumerate(sizes)], "doc_id long, piece int, length long")
    rows = P.pack(pieces, 1000, group_items=200).collect()
    assert sorted(r.doc_id for r in rows) == list(range(6000))
    packer = P.BestFit(1000)
    for s in sorted(sizes[sizes < 1000].tolist(), reverse=True):
        packer.put(s)
    assert check_places(rows, 1000) <= 1.03 * (len(packer.fill) + int((sizes == 1000).sum())) + 1


@pytest.mark.parametrize("sizes,want", [([600] * 400, 400), ([600, 400] * 300, 300), ([990] * 100 + [10] * 90, 100), ([510] * 200 + [490] * 199 + [1], 200)])
def test_underfull_bins_are_all_handed_on(spark, sizes, want):
    # Bins over half full that never merge end the rounds; those that fit together find each other across groups.
    pieces = spark.createDataFrame([(i, 0, s) for i, s in enumerate(sizes)], "doc_id long, piece int, length long")
    rows = P.pack(pieces, 1000, group_items=50, fan_in=4).collect()
    assert sorted(r.doc_id for r in rows) == list(range(len(sizes)))
    assert want <= check_places(rows, 1000) <= 1.06 * want + 1


def test_no_underfull_bin_is_kept_back():
    packer = P.BestFit(100)
    for size in [60] * 2000 + [99] * 3:
        packer.put(size)
    assert len(packer.handed_on(0.98)) == 2000
