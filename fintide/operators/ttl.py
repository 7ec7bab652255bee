"""TTL cache replay as a scan of composed step functions.

A key's cache entry is a number: the time when it expires.  A request before that
time is a hit; any other request is a miss and sets the expiry to its own time
plus the TTL.  What a stretch of time does to the entry is therefore a step
function from the expiry that comes in to the expiry that goes out, and the
function of two stretches in a row is the composition of their functions.

The replay is a scan over such functions with a fixed number of shuffles:

1. Requests are dealt by (key, slice of ``SLICE_TTLS`` TTLs) and sorted by time.
   Each slice becomes a function: the requests that an incoming expiry can
   meet, and where the chain of misses that starts there leaves the slice.
   Chains that meet are one step, so a function is far smaller than its slice.
2. Functions are composed up a tree, ``FAN`` of them at a time, and the top ones
   folded per key.  The expiries that come in are handed down the same tree.
3. With the expiry that comes into its slice, each slice answers its requests.

A task works on whole (key, slice) groups: one key's times within a few TTLs are
the most it holds.  Results do not depend on the width of the slices.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fintide.session import ensure_checkpoint_dir

SLICE_TTLS = 4
FAN = (64, 64)
NEVER = -(1 << 62)  # the expiry of an entry that was never filled

Groups = Callable[[pa.Table, np.ndarray], Iterator[pa.RecordBatch]]


def _edges(table: pa.Table, keys: int) -> np.ndarray:
    """First rows of the groups of the first ``keys`` columns."""
    new = np.ones(len(table), bool)
    new[1:] = False
    for col in table.columns[:keys]:
        col = col.combine_chunks()
        new[1:] |= pc.not_equal(col[1:], col[:-1]).to_numpy(zero_copy_only=False)
    return np.flatnonzero(new)


def _by_group(keys: int, work: Groups):
    """Run ``work`` on sorted rows in tables that end where a group of the first ``keys`` columns ends."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            last = _edges(pa.Table.from_batches([batch]), keys)[-1]
            if held and last == 0:  # one group; it may be the open one
                tail = held[-1].slice(held[-1].num_rows - 1)
                if len(_edges(pa.Table.from_batches([tail, batch]), keys)) == 1:
                    held.append(batch)
                    continue
            done = pa.Table.from_batches([*held, batch.slice(0, last)])
            if len(done):
                yield from work(done, _edges(done, keys))
            held = [batch.slice(last)]
        if held:
            done = pa.Table.from_batches(held)
            yield from work(done, _edges(done, keys))

    return run


def _numbers(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).combine_chunks().to_numpy(zero_copy_only=False)


class _Chains:
    """Where the requests of several (key, slice) groups lead: rows sorted by group and time."""

    def __init__(self, start: np.ndarray, slices: np.ndarray, t: np.ndarray, ttl: int, width: int):
        self.n, self.ttl, self.width = len(t), ttl, width
        self.end = np.append(start[1:], self.n)
        self.group = np.repeat(np.arange(len(start)), self.end - start)
        self.since = t - slices * width  # time in the slice
        self.span = width + ttl + 1  # groups lie so far apart on one axis
        self.axis = self.group * self.span + self.since
        self.next = np.searchsorted(self.axis, self.axis + ttl)  # the next miss, if there is one in the slice
        self.ends = self.next >= self.end[self.group]

    def first(self, groups: np.ndarray, since: np.ndarray) -> np.ndarray:
        """First request of each group at ``since`` or later; the group's end if there is none."""
        at = np.searchsorted(self.axis, groups * self.span + np.clip(since, 0, self.span - 1))
        return np.minimum(at, self.end[groups])


def _steps(ttl: int, width: int) -> Groups:
    """(key, slice, t) groups as their step functions (key, slice, upto, expiry): an expiry up to ``upto`` leads to ``expiry``."""
    def work(rows: pa.Table, start: np.ndarray) -> Iterator[pa.RecordBatch]:
        t, slices = _numbers(rows, "t"), _numbers(rows, "slice")
        c = _Chains(start, slices, t, ttl, width)
        last = np.where(c.ends, np.arange(c.n), np.minimum(c.next, c.n - 1))
        for _ in range((width // ttl).bit_length() + 1):  # a chain has width / ttl misses and one at most
            last = last[last]
        expiry = t[last] + ttl
        # An expiry from before the slice ends within one TTL of its start: requests beyond the first one there are never met.
        reach = c.first(np.arange(len(start)), np.full(len(start), ttl))
        met = np.arange(c.n) <= reach[c.group]
        final = np.ones(c.n, bool)  # of requests with the same outcome the last one is the step
        final[:-1] = (c.group[1:] != c.group[:-1]) | (expiry[1:] != expiry[:-1]) | ~met[1:]
        at = pa.array(np.flatnonzero(met & final))
        yield pa.RecordBatch.from_arrays([*(rows.column(k).combine_chunks().take(at) for k in ("key", "slice")),
                                          pa.array(t).take(at), pa.array(expiry).take(at)], ["key", "slice", "upto", "expiry"])

    return work


def applied(upto: np.ndarray, expiry: np.ndarray, x: np.ndarray) -> np.ndarray:
    """A step function at x; beyond the last step an entry stays as it is."""
    at = np.searchsorted(upto, x)
    return np.where(at < len(upto), expiry[np.minimum(at, len(upto) - 1)], x)


def after(upto: np.ndarray, expiry: np.ndarray, then_upto: np.ndarray, then_expiry: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The steps of one function followed by another one."""
    more = then_upto > upto[-1]
    upto, expiry = np.concatenate([upto, then_upto[more]]), np.concatenate([applied(then_upto, then_expiry, expiry), then_expiry[more]])
    final = np.append(expiry[1:] != expiry[:-1], True)
    return upto[final], expiry[final]


def _composed(rows: pa.Table, start: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(key, group, slice, upto, expiry) groups as one step function each: (key, slice, upto, expiry), slice being the group."""
    upto, expiry, slices = (_numbers(rows, c) for c in ("upto", "expiry", "slice"))
    of, at, out = [], [], []
    for first, end in zip(start, np.append(start[1:], len(rows))):
        cuts = [first, *(np.flatnonzero(slices[first + 1 : end] != slices[first : end - 1]) + first + 1), end]
        u, x = upto[first : cuts[1]], expiry[first : cuts[1]]
        for i, j in zip(cuts[1:], cuts[2:]):
            u, x = after(u, x, upto[i:j], expiry[i:j])
        of.append(np.full(len(u), first))
        at.append(u)
        out.append(x)
    of = pa.array(np.concatenate(of))
    yield pa.RecordBatch.from_arrays([*(rows.column(k).combine_chunks().take(of) for k in ("key", "group")),
                                      pa.array(np.concatenate(at)), pa.array(np.concatenate(out))], ["key", "slice", "upto", "expiry"])


def _handed_down(rows: pa.Table, start: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(key, group, slice, upto, expiry) groups, the first row with slice ``NEVER`` holding the expiry that comes in:
    (key, slice, entry), the expiry that comes into each slice, if it was ever filled."""
    upto, expiry, slices = (_numbers(rows, c) for c in ("upto", "expiry", "slice"))
    of, entries = [], []
    for first, end in zip(start, np.append(start[1:], len(rows))):
        entry = NEVER
        if slices[first] == NEVER:
            entry, first = int(expiry[first]), first + 1
        cuts = [first, *(np.flatnonzero(slices[first + 1 : end] != slices[first : end - 1]) + first + 1), end] if first < end else []
        for i, j in zip(cuts, cuts[1:]):
            if entry != NEVER:
                of.append(i)
                entries.append(entry)
            k = i + int(np.searchsorted(upto[i:j], entry))
            entry = int(expiry[k]) if k < j else entry
    of = pa.array(np.array(of, np.int64))
    yield pa.RecordBatch.from_arrays([*(rows.column(k).combine_chunks().take(of) for k in ("key", "slice")),
                                      pa.array(entries, pa.int64())], ["key", "slice", "entry"])


def _answers(ttl: int, width: int) -> Groups:
    """(key, slice, t, id, entry) groups, the first row having an entry and no id if one comes in: (id, from_cache, filled)."""
    def work(rows: pa.Table, start: np.ndarray) -> Iterator[pa.RecordBatch]:
        given = _numbers(rows, "t") == NEVER
        entry = np.full(len(start), NEVER)
        entry[given[start]] = rows.column("entry").combine_chunks().filter(pa.array(given)).to_numpy()
        rows = rows.filter(pa.array(~given))
        sizes = np.add.reduceat(~given, start)
        some = sizes > 0  # an expiry may come into a slice of another batch of requests
        entry, sizes = entry[some], sizes[some]
        if not len(sizes):
            return
        start = np.cumsum(sizes) - sizes
        t, slices = _numbers(rows, "t"), _numbers(rows, "slice")
        c = _Chains(start, slices, t, ttl, width)
        miss = np.zeros(c.n, bool)
        opens = slices[start] * width
        at = c.first(np.arange(len(start)), np.where(entry == NEVER, 0, entry - opens))
        live = at < c.end
        while live.any():  # as often as a slice has TTLs
            hit = at[live]
            miss[hit] = True
            at[live] = c.next[hit]
            live = at < c.end
        fill = np.maximum.accumulate(np.where(miss, np.arange(c.n), -1))
        filled = np.where(fill >= start[c.group], t[fill], entry[c.group] - ttl)
        yield pa.RecordBatch.from_arrays([rows.column("id").combine_chunks(), pa.array(~miss), pa.array(filled)], ["id", "from_cache", "filled"])

    return work


STEPS = "key string, slice long, upto long, expiry long"


def slice_of(t: str, ttl: int, slice_ttls: int = SLICE_TTLS):
    return F.floor(F.col(t) / F.lit(slice_ttls * ttl)).cast("long")


def functions(requests: DataFrame, ttl: int, slice_ttls: int = SLICE_TTLS) -> DataFrame:
    """Step functions of all (key, slice) groups of ``requests`` (key, slice, t)."""
    dealt = requests.select("key", "slice", "t").repartition("key", "slice").sortWithinPartitions("key", "slice", "t")
    return dealt.mapInArrow(_by_group(2, _steps(ttl, slice_ttls * ttl)), STEPS)


def grouped(steps: DataFrame, fan: int | None) -> DataFrame:
    """Functions with the group of ``fan`` slices they belong to; all of a key if None."""
    group = F.floor(F.col("slice") / fan).cast("long") if fan else F.lit(0).cast("long")
    return steps.select("key", group.alias("group"), "slice", "upto", "expiry")


def composed(steps: DataFrame, fan: int) -> DataFrame:
    """Functions of ``fan`` slices in a row as one function."""
    dealt = grouped(steps, fan).repartition("key", "group").sortWithinPartitions("key", "group", "slice", "upto")
    return dealt.mapInArrow(_by_group(2, _composed), STEPS)


def handed_down(steps: DataFrame, fan: int | None, entries: DataFrame | None) -> DataFrame:
    """(key, slice, entry): what comes into each slice, from what comes into its group (key, slice, entry)."""
    rows = grouped(steps, fan)
    if entries is not None:
        first = entries.select("key", F.col("slice").alias("group"), F.lit(NEVER).alias("slice"), F.lit(NEVER).alias("upto"),
                               F.col("entry").alias("expiry"))
        rows = rows.unionByName(first)
    dealt = rows.repartition("key", "group").sortWithinPartitions("key", "group", "slice", "upto")
    return dealt.mapInArrow(_by_group(2, _handed_down), "key string, slice long, entry long")


def replay(requests: DataFrame, ttl: int, entries: DataFrame | None = None, slice_ttls: int = SLICE_TTLS) -> DataFrame:
    """(id, from_cache, filled) of ``requests`` (key string, t long, id): whether the key's entry was fresh, and when the
    entry that answers was filled.  ``entries`` (key, entry) are expiries from before the first slice of the requests.

    Requests of one time are ordered by id, which identifies them.  ``requests`` is read twice.
    """
    if ttl < 1:
        return requests.select("id", F.lit(False).alias("from_cache"), F.col("t").alias("filled"))
    ensure_checkpoint_dir(requests.sparkSession)
    requests = requests.select("key", slice_of("t", ttl, slice_ttls).alias("slice"), "t", "id")
    levels = [functions(requests, ttl, slice_ttls).checkpoint()]
    for fan in FAN:
        levels.append(composed(levels[-1], fan).checkpoint())
    coming = None if entries is None else entries.select("key", F.lit(0).cast("long").alias("slice"), "entry")
    for steps, fan in zip(reversed(levels), [None, *reversed(FAN)]):
        coming = handed_down(steps, fan, coming)
    id_type = requests.schema["id"].dataType
    first = coming.select("key", "slice", F.lit(NEVER).alias("t"), F.lit(None).cast(id_type).alias("id"), "entry")
    asked = requests.withColumn("entry", F.lit(None).cast("long")).unionByName(first)
    dealt = asked.repartition("key", "slice").sortWithinPartitions("key", "slice", "t", "id")
    return dealt.mapInArrow(_by_group(2, _answers(ttl, slice_ttls * ttl)), f"id {id_type.simpleString()}, from_cache boolean, filled long")
