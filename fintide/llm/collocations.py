"""Phrase collocation mining by top-order marginalisation.

Phrases of two and three words are scored from one count of the longest windows:

1. Windows.  Every word of a piece of text is followed by two lead columns, the
   next word and the one after it, padded with '' at the end of the piece.  A
   task counts its windows block by block (``BLOCK_BYTES`` of text), so only
   distinct (word, lead, second lead) rows with counts leave it; no pairs or
   single words are exploded.
2. Cutting.  The windows are dealt by their first two words and sorted, so a task
   sums the windows of a pair and the pair itself as a stream.  A window seen
   fewer than ``least`` times can't be a phrase: its last word is cut.  A pair
   that is seen fewer than ``least`` times in all loses its second word as well.
   Nothing is lost for shorter prefixes, whose sums stay exact.
3. Marginalisation.  ROLLUP over (lang, first, second, third) of the cut windows
   sums the successively shorter prefixes: phrases of three words and of two
   words, and with the windows cut to one word a ROLLUP over (lang, first) sums
   single words and all words of a language.
4. Scores.  A phrase cut after its first words has a score of
   floor(10^6 a a / (l r)); the lowest-scoring cut counts, of equal ones the
   first.  Products are decimals of 38 digits.  Pairs that a longer phrase holds
   at least ``cover`` percent of the time are dropped.  The best ``top`` of every
   language are ranked in two steps, so no task sorts a whole language.

Skew: windows of a task are counted before they travel, and pairs that make up
1/``HOT_SHARE`` or more of a sample of the windows are dealt by their third word
too, and never cut.  The sample (``HOT_SAMPLE`` of the rows) decides the place of
rows only, never a count.

Defined cases: NULL and blank texts have no windows.  A NULL language is ``und``
(as is the language named so).  Repeated rows count as often as they stand.  An
empty table has no phrases.  Ties go to the more frequent, then to the phrase
that comes first in UTF-8 byte order.  Extra columns are ignored.  Long texts
are taken in blocks that end at a break, so no window is lost.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fintide.llm.common import staged

LEAST = 10
COVER = 50
TOP = 2000
BLOCK_BYTES = 1 << 23
BLOCK_TEXTS = 1 << 16
SENT = 1 << 17  # windows spelled out at once
HOT_SAMPLE = 0.02
HOT_SHARE = 512
PARTS = 64

#: Bytes that end a piece and bytes that part words inside one.
BREAKS = b".,;:!?\n\x0b\x0c\r"
GAPS = b" \t"
BREAK = re.compile(rb"[.,;:!?\x0A-\x0D]")

KIND = np.zeros(256, np.uint8)
KIND[list(GAPS)] = 1
KIND[list(BREAKS)] = 2
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

WINDOWS = "gram string, c long"
#: A gram's last word, and what it shares with all windows of its first two words (languages are quoted, so they hold no blank).
THIRD, HEAD = "substring_index(gram, ' ', -1)", "substring_index(gram, ' ', 4)"


def _strings(lengths: np.ndarray, data: bytes) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.Array.from_buffers(pa.string(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def count_windows(langs: list[str], texts: list[bytes], hot: pa.Array | None = None) -> Iterator[pa.RecordBatch]:
    """Distinct windows of some texts with their counts, see ``WINDOWS``; a gram is 'first second part lang third'."""
    raw = np.frombuffer(b"\n".join(texts), np.uint8)
    kind = KIND[raw]
    in_word = np.concatenate([[False], kind == 0, [False]])
    edges = np.flatnonzero(in_word[1:] != in_word[:-1]).astype(np.int32)
    starts, lengths = edges[::2], edges[1::2] - edges[::2]
    if not len(starts):
        return
    words = _strings(lengths, LOWER[raw[kind == 0]].tobytes()).dictionary_encode()
    first, size = words.indices.to_numpy(), len(words.dictionary) + 1
    piece = np.searchsorted(np.flatnonzero(kind == 2), starts).astype(np.int32)
    text = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), starts, side="right")
    names, of_text = np.unique(np.array([quote(x) for x in langs], object), return_inverse=True)
    leads = []
    for step in (1, 2):
        lead = np.full(len(first), size - 1, np.int32)
        lead[:-step] = np.where(piece[step:] == piece[:-step], first[step:], size - 1)
        leads.append(lead)
    # BLOCK_TEXTS languages and half of BLOCK_BYTES words at most: codes of (lang, first, second) stay below 2^62.
    code = of_text[text] * size
    del raw, kind, in_word, edges, starts, piece, text
    code = (code + first) * size + leads[0]
    heads, at = np.unique(code, return_inverse=True)
    del code
    found, counts = np.unique(at * size + leads[1], return_counts=True)
    del at, first, leads
    spelled = pa.concat_arrays([words.dictionary, pa.array([""])])
    names = pa.array(names.tolist(), pa.string())
    for i in range(0, len(found), SENT):
        of, third = heads[found[i : i + SENT] // size], pa.array(found[i : i + SENT] % size)
        one, two, lang = spelled.take(pa.array(of // size % size)), spelled.take(pa.array(of % size)), names.take(pa.array(of // size // size))
        part = pa.array(["0"]).take(pa.array(np.zeros(len(of), np.int32)))
        if hot is not None and len(hot):
            is_hot = pc.is_in(pc.binary_join_element_wise(one, two, lang, " "), hot)
            held = spelled.take(third.filter(is_hot)).cast(pa.binary()).to_pylist()
            part = pc.replace_with_mask(part, is_hot, pa.array([str(1 + zlib.crc32(w) % PARTS) for w in held], pa.string()))
        gram = pc.binary_join_element_wise(one, two, part, lang, spelled.take(third), " ")
        yield pa.RecordBatch.from_arrays([gram, pa.array(counts[i : i + SENT].astype(np.int64))], ["gram", "c"])


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[str], list[bytes]]]:
    """Texts with their languages in blocks of bounded size; a longer text is cut behind a break."""
    langs, texts, held = [], [], 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            rest = text.as_py()
            while rest:
                cut = BREAK.search(rest, BLOCK_BYTES) if len(rest) > BLOCK_BYTES else None
                part, rest = (rest[: cut.end()], rest[cut.end() :]) if cut else (rest, b"")
                langs.append(lang)
                texts.append(part)
                held += len(part)
                if held >= BLOCK_BYTES or len(texts) >= BLOCK_TEXTS:
                    yield langs, texts
                    langs, texts, held = [], [], 0
    if texts:
        yield langs, texts


def windows(docs: DataFrame, lang: str = "lang", text: str = "text", hot: list[str] = ()) -> DataFrame:
    """Distinct padded windows of every task with their counts, see ``WINDOWS``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(list(hot), pa.string())
        for langs, texts in blocks(batches):
            yield from count_windows(langs, texts, known)

    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")), F.coalesce(F.col(text), F.lit("")).cast("binary"))
    return rows.mapInArrow(run, WINDOWS)


def hot_pairs(docs: DataFrame, lang: str = "lang", text: str = "text") -> list[str]:
    """'first second lang' of the pairs that make up 1/``HOT_SHARE`` or more of a sample's windows (so at most ``HOT_SHARE``)."""
    found = windows(docs.sample(HOT_SAMPLE, seed=7), lang, text).groupBy(F.expr(HEAD).alias("head")).agg(F.sum("c").alias("c"))
    seen = Observation()
    best = found.observe(seen, F.sum("c").alias("total")).orderBy(F.desc("c"), "head").limit(HOT_SHARE).collect()
    total = seen.get["total"] or 0
    spelled = [(r.head.split(" "), r.c) for r in best]
    return [" ".join((one, two, of)) for (one, two, _, of), c in spelled if c * HOT_SHARE >= total]


CUT = "lang string, w1 string, w2 string, w3 string, c long"


def _edges(*columns: pa.Array) -> np.ndarray:
    """Where a row differs from the one before."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = np.any([pc.not_equal(col[1:], col[:-1]).to_numpy(zero_copy_only=False) for col in columns], axis=0)
    return np.flatnonzero(new)


def _settled(head: pa.Array, third: pa.Array, c: np.ndarray, single: np.ndarray) -> list[pa.RecordBatch]:
    """Windows as rows of ``CUT``; those that are ``single`` keep their first word only."""
    words = pc.list_flatten(pc.split_pattern(head, " "))
    w1, w2, lang = (words.take(pa.array(np.arange(len(head)) * 4 + i)) for i in (0, 1, 3))
    lang = lang.dictionary_encode()
    lang = pa.array([unquote(x) for x in lang.dictionary.to_pylist()], pa.string()).take(lang.indices)
    names = ["lang", "w1", "w2", "w3"]
    found = pa.table([lang, w1, pc.if_else(pa.array(single), "", w2), third, pa.array(c)], [*names, "c"])
    found = found.group_by(names).aggregate([("c", "sum")]).rename_columns([*names, "c"])
    return found.to_batches()


def _cut(least: int):
    """Rows (head, third, c) sorted by head and third: the sums of the windows, cut to the prefixes that can matter."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        window, left, held = None, 0, False  # the open window; what its head has left over so far, and whether it has a phrase

        def settle(head: pa.Array, third: pa.Array, c: np.ndarray, last: str | None) -> Iterator[pa.RecordBatch]:
            """Summed windows; their last head goes on if it is ``last``."""
            nonlocal left, held
            phrase = (c >= least) & pc.not_equal(third, "").to_numpy(zero_copy_only=False)
            starts = _edges(head)
            over, has = np.add.reduceat(np.where(phrase, 0, c), starts), np.logical_or.reduceat(phrase, starts)
            over[0] += left
            has[0] |= held
            heads = head.take(pa.array(starts))
            left, held = 0, False
            if heads[-1].as_py() == last:
                left, held = int(over[-1]), bool(has[-1])
                heads, over, has = heads[:-1], over[:-1], has[:-1]
            dealt_whole = pc.match_substring_regex(heads, "^[^ ]* [^ ]* 0 ").to_numpy(zero_copy_only=False)
            single = dealt_whole & ~has & (over < least)
            rest = over > 0
            found = pa.array(phrase), pa.array(rest)
            yield from _settled(pa.concat_arrays([head.filter(found[0]), heads.filter(found[1])]),
                                pa.concat_arrays([third.filter(found[0]), pa.array([""] * int(rest.sum()), pa.string())]),
                                np.concatenate([c[phrase], over[rest]]), np.concatenate([np.zeros(int(phrase.sum()), bool), single[rest]]))

        for batch in batches:
            if not batch.num_rows:
                continue
            head, third, c = batch.column(0), batch.column(1), batch.column(2).to_numpy()
            if window:
                head, third = (pa.concat_arrays([pa.array([w], pa.string()), col]) for w, col in zip(window, (head, third)))
                c = np.concatenate([[window[2]], c])
            starts = _edges(head, third)
            head, third, c = head.take(pa.array(starts)), third.take(pa.array(starts)), np.add.reduceat(c, starts)
            window = (head[-1].as_py(), third[-1].as_py(), int(c[-1]))
            if len(starts) > 1:
                yield from settle(head[:-1], third[:-1], c[:-1], window[0])
        if window:
            yield from settle(pa.array([window[0]]), pa.array([window[1]]), np.array([window[2]]), None)

    return run


def marginals(docs: DataFrame, least: int = LEAST, lang: str = "lang", text: str = "text") -> DataFrame:
    """(lang, w1, w2, w3, f, level): occurrences of all phrases seen ``least`` times or more; level 0 has
    three words, 1 two, 3 one; level 7 counts all words of the language."""
    dealt = windows(docs, lang, text, hot_pairs(docs, lang, text)).repartition(F.expr(HEAD)).sortWithinPartitions("gram")
    rest = dealt.select(F.expr(HEAD), F.expr(THIRD), "c").mapInArrow(_cut(least), CUT)
    rest = rest.groupBy("lang", "w1", "w2", "w3").agg(F.sum("c").alias("c"))
    # Windows cut to one word join the sums after the first ROLLUP, so it expands phrases only.
    rolled = rest.filter(counted(F.col("w2") != "") > 0).rollup("lang", "w1", "w2", "w3").agg(
        F.sum("c").alias("c"), F.grouping_id().cast("int").alias("level"))
    phrases = rolled.filter(counted((F.col("level") == 0) & (F.col("w3") != "") | (F.col("level") == 1) & (F.col("w2") != "")) >= least)
    words = rolled.filter(counted(F.col("level") == 3) > 0).select("lang", "w1", "c").union(
        rest.filter(counted(F.col("w2") == "") > 0).select("lang", "w1", "c"))
    words = words.rollup("lang", "w1").agg(F.sum("c").alias("c"), F.grouping_id().cast("int").alias("up"))
    words = words.filter((F.col("up") == 1) | (F.col("up") == 0) & (F.col("c") >= least)).select(
        "lang", "w1", F.lit(None).cast("string").alias("w2"), F.lit(None).cast("string").alias("w3"), "c",
        F.when(F.col("up") == 1, 7).otherwise(3).alias("level"))
    return phrases.unionByName(words).withColumnRenamed("c", "f")


def counted(condition: Column) -> Column:
    """The sum ``c`` where a condition on the group holds, else 0.

    Filters on it stay above the sums, so that branches with other conditions read the same shuffle.
    """
    return F.when(condition, F.col("c")).otherwise(0)


def score(a: Column, left: Column, right: Column) -> Column:
    """floor(10^6 a a / (l r)) without rounding on the way."""
    a, left, right = (x.cast("decimal(19,0)") for x in (a, left, right))
    return F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * a * a, left * right)


def collocations(docs: DataFrame, least: int = LEAST, cover: int = COVER, top: int = TOP,
                 lang: str = "lang", text: str = "text") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` best phrases of every language."""
    found = staged(marginals(docs, least, lang, text), "collocation-counts")
    three = found.filter("level = 0").select("lang", "w1", "w2", "w3", F.col("f").alias("a"))
    two = found.filter("level = 1").select("lang", "w1", "w2", F.col("f").alias("a"))
    total = found.filter("level = 7").select("lang", F.col("f").alias("n"))

    def word(place: str, name: str) -> DataFrame:
        return found.filter("level = 3").select("lang", F.col("w1").alias(place), F.col("f").alias(name))

    def pair(one: str, other: str, name: str) -> DataFrame:
        return two.select("lang", F.col("w1").alias(one), F.col("w2").alias(other), F.col("a").alias(name))

    pairs = two.join(word("w1", "l"), ["lang", "w1"]).join(word("w2", "r"), ["lang", "w2"])
    # A pair's longest share in a longer phrase, that begins or ends with it.
    held = three.select("lang", "w1", "w2", "a").union(three.select("lang", "w2", "w3", "a")).groupBy("lang", "w1", "w2").agg(
        F.max("a").alias("within"))
    pairs = pairs.join(held, ["lang", "w1", "w2"], "left").filter(F.coalesce(100 * F.col("within") < cover * F.col("a"), F.lit(True)))
    pairs = pairs.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", "l", "r",
                         score(F.col("a"), F.col("l"), F.col("r")).alias("score"))
    triples = (three.join(word("w1", "l1"), ["lang", "w1"]).join(pair("w2", "w3", "r1"), ["lang", "w2", "w3"])
               .join(pair("w1", "w2", "l2"), ["lang", "w1", "w2"]).join(word("w3", "r2"), ["lang", "w3"])
               .withColumns({f"s{k}": score(F.col("a"), F.col(f"l{k}"), F.col(f"r{k}")) for k in (1, 2)}))
    at_first = F.col("s1") <= F.col("s2")
    triples = triples.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a",
                             *[F.when(at_first, F.col(f"{x}1")).otherwise(F.col(f"{x}2")).alias(x) for x in "lr"],
                             F.least("s1", "s2").alias("score"))
    best = [F.desc("score"), F.desc("a"), "phrase"]
    every = pairs.unionByName(triples)
    # The best of each part first: the last window has at most PARTS * top rows a language.
    every = every.withColumn("part", F.pmod(F.xxhash64("phrase"), PARTS))
    for keys in (["lang", "part"], ["lang"]):
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(*best))
        every = every.withColumn("rank", place).filter(F.col("rank") <= top)
    return every.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
