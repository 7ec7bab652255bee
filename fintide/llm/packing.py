"""Best-fit packing into fixed-length sequences by hierarchical residual packing.

``tokenize`` turns every document into token ids and cuts only those longer
than a sequence; a full-length piece is a sequence of its own.  The other
pieces (at most one a document) are items:

1. Items are dealt to groups of about ``GROUP_ITEMS`` by a hash; each group
   packs best-fit in order of decreasing length, as a stream sorted by Spark.
   Bins filled to ``NEARLY_FULL`` are emitted as sequences.
2. All other bins are handed on as items of the next round.
3. A round deals them to a ``FAN_IN``-th of the groups, or to as many as groups of
   ``GROUP_ITEMS`` need, and packs them best-fit again.  The rounds end with one
   group, or when the groups no longer shrink (bins over half full can't be
   merged with each other); the last round emits all its bins.

Every group of every round is bounded, whatever the corpus holds, and nothing is
left out.

Defined cases: a NULL text is empty and gives one piece of the closing id
alone.  Repeated rows and repeated ids are packed once each.  NULL ids are
kept.  An empty table gives no pieces.  Extra columns are ignored.
"""

from __future__ import annotations

import bisect
import re
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fintide.llm.common import staged

LENGTH = 4096
CLOSING_ID = 1
GROUP_ITEMS = 16384
NEARLY_FULL = 0.98
FAN_IN = 8

# ---------------------------------------------------------------- tokens

#: A chunk whose letters are plain Latin ones (no composing, no special case rules) and its closing punctuation.
PLAIN = re.compile("([a-zA-ZÀ-ÖØ-öø-ÿ]+)([.,!]*)")
CACHE_ENTRIES = 1 << 20  # chunks, and words, that a task remembers
_encoders: dict = {}


class ChunkEncoder:
    """Token ids of whole texts with a bounded memory of the ids of blank-separated chunks.

    The vocabulary drops white space and never merges across it, so a text's
    ids are those of its chunks in order.
    """

    def __init__(self, path: str, entries: int = CACHE_ENTRIES):
        from tokenizers import Tokenizer

        self.entries = entries
        self.tokenizer = Tokenizer.from_file(path)
        self.words, self.known, self.tails = {}, {}, {}
        # Byte-level alphabet: printable bytes stand for themselves, the others for 256, 257, ...
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in plain]
        table = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}
        self.byte_chars = [table[b] for b in range(256)]

    def _encode(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _chunk(self, chunk: str) -> bytes:
        m = PLAIN.fullmatch(chunk)
        if not m:
            return self._encode(chunk)
        word, tail = m[1].lower(), m[2]
        ids = self.words.get(word)
        if ids is None:
            if len(self.words) >= self.entries:
                self.words.clear()
            chars = word if word.isascii() else "".join([self.byte_chars[b] for b in word.encode()])
            ids = np.array([t.id for t in self.tokenizer.model.tokenize(chars)], dtype="<u4").tobytes()
            self.words[word] = ids
        if tail:
            end = self.tails.get(tail)
            if end is None:
                end = self._encode(tail)
                if len(tail) < 4:
                    self.tails[tail] = end
            ids += end
        return ids

    def ids(self, text: str) -> np.ndarray:
        """Little-endian unsigned 32-bit ids of ``text``."""
        if "<|" in text:  # may hold a special token's string, with or without blanks around it
            return np.frombuffer(self._encode(text), dtype="<u4")
        known, out = self.known, []
        for chunk in text.split(" "):
            ids = known.get(chunk)
            if ids is None:
                ids = b"".join([self._chunk(c) for c in chunk.split("\n")])
                if len(chunk) <= 64:
                    if len(known) >= self.entries:
                        known.clear()
                    known[chunk] = ids
            out.append(ids)
        return np.frombuffer(b"".join(out), dtype="<u4")


def _encoder(path: str, entries: int) -> ChunkEncoder:
    if (path, entries) not in _encoders:
        _encoders[path, entries] = ChunkEncoder(path, entries)
    return _encoders[path, entries]


def tokenize(docs: DataFrame, vocabulary: str, length: int = LENGTH, closing_id: int = CLOSING_ID,
             keep_ids: bool = True, memory: int = CACHE_ENTRIES) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]): the pieces of every document.

    ``vocabulary`` is the path of a tokenizer file on every executor, ``memory`` the number of chunks a task remembers.
    """
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if keep_ids else "")
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: 6 if keep_ids else 5]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocabulary, memory)
        end = np.array([closing_id], dtype="<u4")
        for b in batches:
            for at in range(0, b.num_rows, 512):
                rows: list = []
                part = b.slice(at, 512)
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    ids = np.concatenate([encoder.ids(text or ""), end])
                    for piece, start in enumerate(range(0, len(ids), length)):
                        cut = ids[start : start + length]
                        rows.append((doc_id, piece, start, len(cut), zlib.crc32(cut.tobytes()), cut)[: len(names)])
                cols = list(zip(*rows))
                types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
                arrays = [pa.array([x.view(np.int32) for x in c] if n == "ids" else c, t) for n, c, t in zip(names, cols, types)]
                yield pa.RecordBatch.from_arrays(arrays, names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


# ---------------------------------------------------------------- bins


class BestFit:
    """Open bins by free space; ``put`` chooses the fullest bin that takes the item, the oldest of equals."""

    def __init__(self, length: int):
        self.length, self.spaces, self.bins, self.fill = length, [], {}, []

    def put(self, size: int) -> tuple[int, int]:
        """(bin, offset in it)."""
        at = bisect.bisect_left(self.spaces, size)
        if at == len(self.spaces):
            bin_, offset = len(self.fill), 0
            self.fill.append(size)
        else:
            space = self.spaces[at]
            queue = self.bins[space]
            bin_ = queue.popleft()
            if not queue:
                del self.bins[space], self.spaces[at]
            offset = self.fill[bin_]
            self.fill[bin_] += size
        space = self.length - self.fill[bin_]
        if space:
            if space not in self.bins:
                bisect.insort(self.spaces, space)
                self.bins[space] = deque()
            self.bins[space].append(bin_)
        return bin_, offset

    def handed_on(self, nearly_full: float) -> set[int]:
        return {i for i, f in enumerate(self.fill) if f < nearly_full * self.length}


PLACED = "id long, part long, parent long, base long, fill long, done boolean"


def _pack_groups(length: int, nearly_full: float, last: bool):
    """Stream rows (group, size desc, id) of whole groups: for every item its bin, offset, the bin's fill and whether it is done."""
    def finish(group: int, ids: list, places: list, packer: BestFit) -> pa.RecordBatch:
        on = set() if last else packer.handed_on(nearly_full)
        bins = np.array([p[0] for p in places], dtype=np.int64)
        done = np.array([p[0] not in on for p in places])
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(np.full(len(ids), group)), pa.array(bins | np.int64(group << 32)),
             pa.array([p[1] for p in places], pa.int64()), pa.array(np.array(packer.fill, dtype=np.int64)[bins]),
             pa.array(done)], ["id", "part", "parent", "base", "fill", "done"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, ids, places, packer = None, [], [], None
        for b in batches:
            for g, size, i in zip(*[c.to_pylist() for c in b.columns]):
                if g != group:
                    if ids:
                        yield finish(group, ids, places, packer)
                    group, ids, places, packer = g, [], [], BestFit(length)
                ids.append(i)
                places.append(packer.put(size))
        if ids:
            yield finish(group, ids, places, packer)

    return run


def _round(items: DataFrame, length: int, nearly_full: float, last: bool) -> DataFrame:
    ordered = items.repartition("g").sortWithinPartitions("g", F.desc("size"), "id")
    return ordered.select("g", "size", "id").mapInArrow(_pack_groups(length, nearly_full, last), PLACED)


def pack(pieces: DataFrame, length: int = LENGTH, group_items: int = GROUP_ITEMS, nearly_full: float = NEARLY_FULL,
         fan_in: int = FAN_IN) -> DataFrame:
    """``pieces`` (doc_id, piece, length, ...) with sequence_id and offset; no sequence exceeds ``length`` tokens."""
    # Row numbers tell repeated pieces apart; they are written once, so every later read sees the same ones.
    table = staged(pieces.withColumn("_id", F.monotonically_increasing_id()), "pack-pieces")
    full = table.filter(F.col("length") >= length)
    small = table.filter(F.col("length") < length)
    groups = max(1, -(-small.count() // group_items))
    items = small.select(F.pmod(F.xxhash64("_id"), F.lit(groups)).alias("g"), F.col("length").alias("size"), F.col("_id").alias("id"))
    first = staged(_round(items, length, nearly_full, groups == 1), "pack-round0")
    # Chain of handed-on bins: bin of round 0 -> (bin of the latest round, offset of the former in the latter).
    level, settled = 0, []
    moving = first.filter("NOT done").groupBy("parent", "part", "fill").agg(F.lit(1).alias("_")).select(
        F.col("parent").alias("bin0"), F.col("parent").alias("bin"), F.lit(0).cast("long").alias("shift"), "part", "fill")
    last = groups == 1
    while not last:
        bins = moving.select(F.col("fill").alias("size"), F.col("bin").alias("id")).distinct()
        fewer = max(-(-groups // fan_in), -(-bins.count() // group_items), 1)
        last = fewer == 1 or fewer >= groups
        groups, level = fewer, level + 1
        placed = _round(bins.select(F.pmod(F.xxhash64("id"), F.lit(groups)).alias("g"), "size", "id"), length, nearly_full, last)
        moved = moving.select("bin0", F.col("bin").alias("id"), "shift").join(placed, "id").select(
            "bin0", F.col("parent").bitwiseOR(F.lit(level << 56)).alias("bin"), (F.col("shift") + F.col("base")).alias("shift"),
            "part", "fill", "done")
        moved = staged(moved, f"pack-round{level}")
        settled.append(moved.filter("done").select("bin0", "bin", "shift"))
        moving = moved.filter("NOT done").select("bin0", "bin", "shift", "part", "fill")
    placed = first.select(F.col("id").alias("_id"), "parent", "base")
    if settled:
        merged = settled[0]
        for part in settled[1:]:
            merged = merged.unionByName(part)
        placed = placed.join(merged.withColumnRenamed("bin0", "parent"), "parent", "left").select(
            "_id", F.coalesce("bin", "parent").alias("sequence_id"), (F.col("base") + F.coalesce("shift", F.lit(0))).alias("offset"))
    else:
        placed = placed.select("_id", F.col("parent").alias("sequence_id"), F.col("base").alias("offset"))
    own = table.columns[:-1]
    out = small.join(placed, "_id").select(*own, "sequence_id", "offset")
    # Full pieces: a sequence each, numbered apart from the bins.
    alone = full.select(*own, F.col("_id").bitwiseOR(F.lit(1 << 62)).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return out.unionByName(alone)


def pack_documents(docs: DataFrame, vocabulary: str, length: int = LENGTH, keep_ids: bool = True, memory: int = CACHE_ENTRIES,
                   **how) -> DataFrame:
    """Tokenize and pack ``docs``: one row per piece with its place; with ``keep_ids`` its token ids too."""
    return pack(tokenize(docs, vocabulary, length, keep_ids=keep_ids, memory=memory), length, **how)
