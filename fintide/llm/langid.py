"""Language identification with language-bitmask n-gram filters.

Learning.  Texts are reduced to lower-case letters with one blank for every other
run, and all their n-grams (``ORDERS`` letters) are counted per language over all
labelled documents.  A language contains an n-gram that makes up ``LEAST_SHARE`` or
more of its n-grams, and ``LEAST_RATIO`` or more of the share that the n-gram has
in the language where it is most usual.  So a language has 1 / ``LEAST_SHARE``
n-grams of an order at most, however much text there is.

Filter.  One Bloom filter per language, stored bit-sliced: slot i of the table
holds bit i of all languages' filters in one mask (one 64-bit word for each 64
languages).  The ``HASHES`` slots of an n-gram, combined by AND, are the mask of
all languages that contain it.  Slots are set with ``bit_or`` in Spark; only the
table itself, of fixed size, reaches the driver and is broadcast.

Prediction.  The masks of all n-grams of a whole text are looked up; per language
the set bits are counted (h of n n-grams) and corrected for the filter's false
positives, (h - n f) / (1 - f), where f is the share of the language's set slots
to the power of ``HASHES``.  The language with the highest corrected count wins, of
equal ones the first by code point; the score is its share of the n-grams.

Defined cases: NULL texts and texts without letters are ``und`` with score 0, and so
is every text if nothing could be learned.  Texts of unknown letters get the
language with the fewest false positives.  NULL languages and NULL texts are not
learned from.  Of more than ``MAX_LANGS`` languages the ones with most n-grams are
learned.  Repeated rows and ids each keep their row; NULL ids are kept.  Extra
columns are ignored.  An empty table has no rows.  Long texts are taken whole, in
slices of ``SLICE`` letters.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fintide.llm.common import staged

ORDERS = (3, 4)
LEAST_SHARE = 5e-5
LEAST_RATIO = 0.25
MAX_LANGS = 256
SLOTS = 1 << 19
HASHES = 4
SLICE = 1 << 19  # letters looked up at once
UNKNOWN = "und"

_LETTERS: list[np.ndarray] = []


def letters() -> np.ndarray:
    """For every code point its lower-case letter, or 0 if it is none (made once a worker)."""
    if not _LETTERS:
        table = np.zeros(0x110000, np.uint32)
        for c in map(chr, range(0x110000)):
            if c.isalpha():
                low = c.lower()
                table[ord(c)] = ord(low) if len(low) == 1 else ord(c)
        _LETTERS.append(table)
    return _LETTERS[0]


def reduced(text: str) -> np.ndarray:
    """Lower-case letters of a text, every other run as one 0, with a 0 at both ends; empty without letters."""
    x = letters()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    keep = (x != 0) | np.concatenate([[False], x[:-1] != 0]) if len(x) else np.zeros(0, bool)
    x = x[keep]
    if not len(x) or (len(x) == 1 and not x[0]):
        return np.empty(0, np.uint32)
    return np.concatenate([[0], x] if not x[-1] else [[0], x, [0]]).astype(np.uint32)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit mixer of unsigned integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def grams(x: np.ndarray, order: int) -> np.ndarray:
    """64-bit codes of all n-grams of reduced letters."""
    n = len(x) - order + 1
    if n < 1:
        return np.empty(0, np.uint64)
    x, code = x.astype(np.uint64), np.full(n, order, np.uint64)
    for i in range(0, order, 3):  # three letters fill 63 bits
        part = np.zeros(n, np.uint64)
        for j in range(i, min(order, i + 3)):
            part = (part << np.uint64(21)) | x[j : j + n]
        code = mixed(code ^ part) + np.uint64(i)
    return code


def inside(x: np.ndarray, order: int) -> np.ndarray:
    """Which n-grams of several texts in a row lie inside one text (texts meet at two blanks, which no text holds)."""
    ends = np.concatenate([[0], np.cumsum((x[1:] == 0) & (x[:-1] == 0))])
    return ends[order - 1 :] == ends[: len(ends) - order + 1]


def slices(x: np.ndarray, order: int) -> Iterator[np.ndarray]:
    """The n-grams of long reduced letters, slice by slice."""
    for at in range(0, max(len(x) - order + 1, 0), SLICE):
        yield grams(x[at : at + SLICE + order - 1], order)


def gathered(texts: Iterator[tuple[int, str]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(letters, owner of each letter) of many texts in pieces of about ``SLICE`` letters; a text is never parted."""
    parts, owners, held = [], [], 0
    for owner, text in texts:
        x = reduced(text) if text else np.empty(0, np.uint32)
        if len(x):
            parts.append(x)
            owners.append(np.full(len(x), owner, np.int64))
            held += len(x)
        if held >= SLICE:
            yield np.concatenate(parts), np.concatenate(owners)
            parts, owners, held = [], [], 0
    if parts:
        yield np.concatenate(parts), np.concatenate(owners)


def _counted(orders: tuple[int, ...]):
    """(lang, text) rows as (lang, order, code, c): n-gram counts of each piece."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, owner = np.unique(np.array(batch.column(0).to_pylist(), object), return_inverse=True)
            texts = ((int(owner[i]), batch.column(1)[i].as_py()) for i in range(batch.num_rows))
            held = {}
            for x, of in gathered(texts):
                for order in orders:
                    for at in range(0, max(len(x) - order + 1, 0), SLICE):
                        part = x[at : at + SLICE + order - 1]
                        code, whole = grams(part, order), inside(part, order)
                        code, who = code[whole], of[at : at + len(whole)][whole]
                        for lang in np.unique(who):
                            held.setdefault((int(lang), order), []).append(np.unique(code[who == lang], return_counts=True))
            for (lang, order), found in held.items():
                u, at = np.unique(np.concatenate([f[0] for f in found]), return_inverse=True)
                c = np.bincount(at, np.concatenate([f[1] for f in found])).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([names[lang]] * len(u), pa.string()), pa.array(np.full(len(u), order, np.int32)),
                     pa.array(u.view(np.int64)), pa.array(c)], ["lang", "order", "code", "c"])

    return run


def slots_of(code: np.ndarray, hashes: int = HASHES, slots: int = SLOTS) -> Iterator[np.ndarray]:
    """The slots of n-gram codes, one array a hash function."""
    for i in range(hashes):
        yield (mixed(code + np.uint64(0x9E3779B97F4A7C15 * (i + 1) % 2**64)) % np.uint64(slots)).astype(np.int64)


def _set_slots(hashes: int, slots: int):
    """(code, word, mask) rows as (slot, word, mask)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in slots_of(batch.column(0).to_numpy().view(np.uint64), hashes, slots):
                yield pa.RecordBatch.from_arrays([pa.array(at), batch.column(1), batch.column(2)], ["slot", "word", "mask"])

    return run


class LanguageFilter:
    """The bit-sliced filters of some languages."""

    def __init__(self, langs: list[str], table: np.ndarray, hashes: int = HASHES, orders: tuple[int, ...] = ORDERS):
        self.langs, self.table, self.hashes, self.orders = langs, table, hashes, orders
        filled = [float(np.mean((table[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1))) for i in range(len(langs))]
        self.false_share = np.array(filled) ** hashes

    def containing(self, code: np.ndarray) -> np.ndarray:
        """Masks (a row of words each) of all languages that contain the n-grams."""
        found = None
        for at in slots_of(code, self.hashes, len(self.table)):
            mask = self.table[at]
            found = mask if found is None else found & mask
        return found

    def counts(self, codes: Iterator[np.ndarray]) -> tuple[int, np.ndarray]:
        """(n-grams, set bits of each language)."""
        n, hits = 0, np.zeros(len(self.langs), np.int64)
        for code in codes:
            masks = self.containing(code)
            n += len(code)
            for i in range(len(self.langs)):
                hits[i] += np.count_nonzero(masks[:, i // 64] & np.uint64(1 << (i % 64)))
        return n, hits

    def predict(self, text: str | None) -> tuple[str, float]:
        x = reduced(text) if text else np.empty(0, np.uint32)
        if not len(x) or not self.langs:
            return UNKNOWN, 0.0
        n, hits = self.counts(code for order in self.orders for code in slices(x, order))
        likely = (hits - n * self.false_share) / (1.0 - np.minimum(self.false_share, 0.999999))
        best = int(likely.argmax())
        return self.langs[best], float(min(1.0, max(0.0, likely[best] / max(n, 1))))


def learn(docs: DataFrame, lang: str = "lang", text: str = "text", orders: tuple[int, ...] = ORDERS, least_share: float = LEAST_SHARE,
          least_ratio: float = LEAST_RATIO, slots: int = SLOTS, hashes: int = HASHES) -> LanguageFilter:
    """The filter of all languages of the labelled rows of ``docs``."""
    rows = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).cast("string"), F.col(text))
    counts = rows.mapInArrow(_counted(orders), "lang string, order int, code long, c long")
    counts = staged(counts.groupBy("lang", "order", "code").agg(F.sum("c").alias("c")), "langid-counts")
    totals = counts.groupBy("lang", "order").agg(F.sum("c").alias("total"))
    known = totals.groupBy("lang").agg(F.sum("total").alias("n")).orderBy(F.desc("n"), "lang").limit(MAX_LANGS).collect()
    langs = sorted(r.lang for r in known)
    if not langs:
        return LanguageFilter([], np.zeros((slots, 1), np.uint64), hashes, orders)
    shares = counts.join(totals, ["lang", "order"]).withColumn("share", F.col("c") / F.col("total")).filter(F.col("share") >= least_share)
    number = F.array_position(F.array(*[F.lit(name) for name in langs]), F.col("lang")) - 1
    shares = shares.withColumn("i", number).filter("i >= 0")
    usual = shares.groupBy("code").agg(F.max("share").alias("most"), F.collect_list(F.struct("i", "share")).alias("in"))  # MAX_LANGS at most
    held = usual.select("code", F.explode("in").alias("s"), "most").filter(F.col("s.share") >= least_ratio * F.col("most"))
    masks = held.groupBy("code", F.expr("s.i div 64").cast("int").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(s.i % 64 as int))")).alias("mask"))
    filled = masks.mapInArrow(_set_slots(hashes, slots), "slot long, word int, mask long").groupBy("slot", "word").agg(F.bit_or("mask").alias("mask"))
    table = np.zeros((slots, -(-len(langs) // 64)), np.uint64)
    found = filled.toArrow()  # ``slots`` rows a word at most
    table[found["slot"].to_numpy(), found["word"].to_numpy()] = found["mask"].to_numpy().view(np.uint64)
    return LanguageFilter(langs, table, hashes, orders)


def predict(docs: DataFrame, model: LanguageFilter, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) of every row; only the text decides."""
    shared: Callable = docs.sparkSession.sparkContext.broadcast(model)  # the table has a fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.predict(t.as_py()) for t in batch.column(1)]
            langs, scores = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                             ["doc_id", "lang_pred", "score"])

    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string")).mapInArrow(
        run, "doc_id long, lang_pred string, score double")


def held_out(key: str = "doc_id") -> Column:
    """One third of the documents, by a checksum of the id, that nothing is learned from; a NULL id is held out."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1, F.lit(True))
