"""Personal data: fixed patterns, and more identifiers found by bootstrapped contextual extraction.

Base spans are the leftmost non-overlapping matches of four fixed patterns
(email, ip, card, phone) that pass their checks.  They are the seed entities.
Every other token with a digit or an at-sign is a candidate instance.  The
patterns of an instance are its contexts (the two words before it, the word
before it, the two words after it) and, of a candidate, the shape of its value
(letters and digits replaced by classes).  Patterns and instances form a
bipartite graph that is scored in rounds:

* a pattern scores the mean score of its distinct instances (seeds score 1,
  unknown candidates start at 0), smoothed by ``PRIOR``;
* a candidate scores 1 - product(1 - score) over its trusted patterns.

Patterns that score ``MIN_SCORE`` or more are trusted if ``MIN_SEEDS`` distinct
instances stand behind them that are seeds or candidates with a score of ``SURE``
or more: found instances lead to further patterns.  Spans of kind ``id`` are the
candidates behind a trusted pattern, and every other place of a value found so
that scores ``MIN_SCORE`` and has ``KNOWN_CHARS`` characters or more (shorter ones
recur by chance).  All of it is DataFrame work; scores are joined as tables.

Positions come from the patterns themselves: matches are wrapped in two
private-use marks, the text is cut at the marks and the pieces' lengths are
summed.  Marks that the text already holds are first replaced by another
character that no pattern uses, so offsets (code points) stay true.  The words
around a match are read from the pieces next to it, and long arrays are summed and
compared block by block, so a text's cost is not the square of its matches.

The patterns are the fixed ones in an equivalent form for a backtracking
engine: possessive repeats, and a match may only start where its first run
starts or where the previous match ended.

Defined cases: NULL and blank texts have no spans.  Repeated rows are judged
separately and alike; repeated entities count once in the scores.  Rows with a
NULL id are kept.  An empty table gives an empty result.  Extra columns of the
input are ignored.
"""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fintide.llm.common import SPACE, ascii_lower, let, staged

OPEN, CLOSE, OTHER = "\ue000", "\ue001", "\ufffd"
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Cheap necessary conditions: a text that fails one has no such span.
NEEDS = {"email": r"@", "ip": r"[0-9]\.[0-9]+\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){15}", "phone": r"\+[0-9]"}
#: Tokens with a digit or an at-sign, without closing punctuation.
TOKEN = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"
CONTEXT = ((80, 4), (1280, 64))  # characters, and pieces of text between spans, that are read first for the words around a span
BLOCK = 256  # items of long arrays that are worked on together
ROUNDS = 3
PRIOR = 1.0
MIN_SCORE = 0.6
MIN_SEEDS = 3
SURE = 0.9
KNOWN_CHARS = 6

SPAN = "struct<start:int,end:int,value:string,left:string,right:string>"


def in_blocks(values: Column, size: int = BLOCK) -> Column:
    """An array as an array of arrays of ``size`` values."""
    first = F.when(F.size(values) > 0, F.sequence(F.lit(1), F.size(values), F.lit(size))).otherwise(F.array().cast("array<int>"))
    return F.transform(first, lambda i: F.slice(values, i, size))


def running(values: Column) -> Column:
    """Running sums of an array of int: within blocks, then with the sums of the blocks before."""
    def sums(block: Column) -> Column:
        nothing = F.array().cast("array<int>")
        return F.aggregate(block, nothing, lambda out, v: F.concat(out, F.array(F.coalesce(F.try_element_at(out, F.lit(-1)), F.lit(0)) + v)))

    def joined(blocks: Column) -> Column:
        ends = F.transform(blocks, lambda b: F.element_at(b, -1))
        return let(sums(ends), lambda upto: F.flatten(F.transform(
            blocks, lambda b, i: F.transform(b, lambda v: v + F.when(i > 0, upto[i - 1]).otherwise(0)))))

    return let(F.transform(in_blocks(values), sums), joined)


def _two(near: Callable[[int | None, int | None], Column], there: Column, last: bool) -> Column:
    """The last or first two words, lower-cased, of the text on one side; NULL if there are fewer.

    ``near(chars, pieces)`` are so many characters of so many pieces next to the
    span, and ``there`` is the length of the whole side.  The outermost word of a
    cut side may be cut itself: it does not count, and more is read if too few
    words are left.
    """
    def two(w: Column) -> Column:
        return F.when(F.size(w) >= 2, F.concat_ws(" ", F.slice(w, -2, 2) if last else F.slice(w, 1, 2)))

    def words(text: Column) -> Column:
        return F.array_remove(F.split(ascii_lower(text), SPACE + "+"), "")

    def within(chars: int, pieces: int, more: Column) -> Column:
        return let(near(chars, pieces), lambda text: let(words(text), lambda w: F.when(
            (F.size(w) < 3) & (F.length(text) < there), more).otherwise(two(w))))

    out = let(words(near(None, None)), two)
    for chars, pieces in reversed(CONTEXT):
        out = within(chars, pieces, out)
    return out


def spans_of(text: Column, pattern: str, valid: Callable[[Column], Column] = lambda value: F.lit(True)) -> Column:
    """array<struct<start,end,value,left,right>> of all valid matches in order, with the two words on either side; ``text`` holds no marks."""
    parts = F.split(F.regexp_replace(text, f"({pattern})", f"{OPEN}$1{CLOSE}"), OPEN)

    def joined(pieces: Column) -> Column:
        return F.replace(F.array_join(pieces, ""), F.lit(CLOSE), F.lit(""))

    def walk(p: Column, ends: Column) -> Column:
        n = F.size(p)

        def span(j: Column) -> Column:
            start, value = ends[j - 1], F.substring_index(p[j], CLOSE, 1)

            def before(chars: int | None, pieces: int | None) -> Column:
                text = joined(F.slice(p, F.greatest(j + 1 - pieces, F.lit(1)), F.least(j, F.lit(pieces))) if pieces else F.slice(p, F.lit(1), j))
                return F.right(text, F.lit(chars)) if chars else text

            def behind(chars: int | None, pieces: int | None) -> Column:
                more = joined(F.slice(p, j + 2, F.lit(pieces - 1) if pieces else n))
                text = F.concat(F.substring_index(p[j], CLOSE, -1), more)
                return F.left(text, F.lit(chars)) if chars else text

            end = start + F.length(value)
            return F.struct(start.alias("start"), end.alias("end"), value.alias("value"),
                            _two(before, start, True).alias("left"), _two(behind, ends[n - 1] - end, False).alias("right"))

        found = F.filter(F.sequence(F.lit(1), n - 1), lambda j: valid(F.substring_index(p[j], CLOSE, 1)))
        return F.when(n > 1, F.transform(found, span)).otherwise(F.array().cast(f"array<{SPAN}>"))

    # The closing mark of every piece but the first is no part of the text.
    return let(parts, lambda p: let(running(F.transform(p, lambda part, i: F.length(part) - F.when(i > 0, 1).otherwise(0))),
                                    lambda ends: walk(p, ends)))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    def worth(c: Column, i: Column) -> Column:
        d = c.cast("int")
        return F.when(i % 2 == 0, d).when(d < 5, d * 2).otherwise(d * 2 - 9)

    return F.aggregate(F.transform(F.split(F.reverse(digits), ""), worth), F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        parts = F.transform(F.split(value, r"\."), lambda p: F.ltrim(p, F.lit("0")))
        return F.forall(parts, lambda p: F.when(F.length(p) <= 3, F.when(p == "", 0).otherwise(
            p.cast("int")) <= 255).otherwise(F.lit(False)))
    if kind == "card":
        return let(_digits(value), lambda d: F.when(F.length(d).between(16, 19), _luhn(d)).otherwise(F.lit(False)))
    if kind == "phone":
        return F.length(_digits(value)).between(8, 15)
    return F.lit(True)


def base_spans(text: Column, kind: str) -> Column:
    """The valid spans of a kind, in order."""
    none = F.array().cast(f"array<{SPAN}>")
    return F.when(text.rlike(NEEDS[kind]), spans_of(text, PATTERNS[kind], lambda v: _valid(kind, v))).otherwise(none)


def apart(spans: Column, others: Column) -> Column:
    """The spans (in order, not overlapping) that no span of ``others`` overlaps; blocks of spans meet the others in their range only."""
    def meets(a: Column, b: Column) -> Column:
        return (b["start"] < a["end"]) & (a["start"] < b["end"])

    def block(part: Column) -> Column:
        whole = F.struct(part[0]["start"].alias("start"), F.element_at(part, -1)["end"].alias("end"))
        return let(whole, lambda w: let(F.filter(others, lambda o: meets(w, o)), lambda near: F.filter(
            part, lambda s: ~F.exists(near, lambda o: meets(s, o)))))

    return F.flatten(F.transform(in_blocks(spans), block))


def shape_of(value: Column) -> Column:
    """Classes of the characters of ``value``: A-Z, a-z and 0-9 become A, a and 9."""
    return F.translate(value, string.ascii_uppercase + string.ascii_lowercase + string.digits, "A" * 26 + "a" * 26 + "9" * 10)


def extract(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: row number, id, base spans per kind, seeds and candidates with their left words."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).cast("long").alias("doc_id"),
                       F.translate(F.coalesce(F.col(text), F.lit("")), OPEN + CLOSE, OTHER * 2).alias("t"))
    t = F.col("t")
    rows = rows.withColumns({k: base_spans(t, k) for k in KINDS})
    every = F.concat(*[F.col(k) for k in KINDS])
    tokens = F.when(t.rlike("[0-9@]"), spans_of(t, TOKEN)).otherwise(F.array().cast(f"array<{SPAN}>"))
    rows = rows.withColumn("base", every).withColumn("tokens", tokens)

    def trimmed(s: Column) -> Column:
        # Closing punctuation and quotes are not part of an identifier; they are part of the word that follows it.
        def cut(v: Column) -> Column:
            rest = F.substring(s["value"], F.length(v) + 1, F.length(s["value"]))
            right = F.when(rest == "", s["right"]).otherwise(F.concat_ws(" ", rest, F.substring_index(s["right"], " ", 1)))
            return F.struct(s["start"].alias("start"), (s["start"] + F.length(v)).alias("end"), v.alias("value"), s["left"].alias("left"),
                            F.when(s["right"].isNotNull(), right).alias("right"))

        return let(F.regexp_replace(s["value"], r"[.,;:!?)\]}\"']+$", ""), cut)

    named = F.filter(F.transform("tokens", trimmed), lambda s: s["value"].rlike("[0-9@]"))
    bare = {k: F.transform(F.col(k), lambda s: F.struct(s["start"], s["end"])).alias(k) for k in KINDS}
    return rows.select("row", "doc_id", *bare.values(), F.col("base").alias("seeds"), let(named, lambda n: apart(n, F.col("base"))).alias("candidates"))


def patterns_of(s: Column, candidate: bool) -> Column:
    """array<string> of all patterns of a span; a mark, which no text holds, tells the kinds apart."""
    told = lambda kind, value: F.concat(F.lit(f"{OPEN}{kind} "), value)
    every = [s["left"], told("near", F.substring_index(s["left"], " ", -1)), told("right", s["right"])]
    if candidate:
        every.append(told("shape", F.xxhash64(shape_of(s["value"])).cast("string")))
    return F.filter(F.array(*every), lambda p: p.isNotNull())


def graph(found: DataFrame, every: bool) -> DataFrame:
    """(left, instance, seed): distinct pattern-instance pairs of ``extract``; only two left words, or ``every`` pattern."""
    def side(column: str, seed: int) -> DataFrame:
        spans = found.select(F.explode(column).alias("s"))
        left = F.explode(patterns_of(F.col("s"), not seed)) if every else F.col("s.left")
        return spans.select(left.alias("left"), F.xxhash64("s.value").alias("instance"), F.lit(seed).alias("seed"))

    pairs = side("seeds", 1).unionByName(side("candidates", 0)).filter("left IS NOT NULL")
    return staged(pairs.groupBy("left", "instance").agg(F.max("seed").alias("seed")), "pii-edges")


def lifted(edges: DataFrame, good: DataFrame) -> DataFrame:
    """(instance, lift): the candidates behind the patterns ``good`` and their scores."""
    # 1 - product(1 - p), as a sum of logs; p < 1 because of the prior.
    return edges.filter("seed = 0").join(good, "left").groupBy("instance").agg(
        (1 - F.exp(F.sum(F.log1p(-F.col("score"))))).alias("lift"))


def bootstrap(edges: DataFrame, rounds: int, min_score: float, min_seeds: int, sure: float) -> DataFrame:
    """(left, score): the patterns trusted after ``rounds`` rounds over ``edges``."""
    scored = edges.withColumn("score", F.col("seed").cast("double"))
    for n in range(rounds):
        patterns = scored.groupBy("left").agg(
            F.sum(F.when((F.col("seed") == 1) | (F.col("score") >= sure), 1).otherwise(0)).alias("seeds"),
            (F.sum("score") / (F.count(F.lit(1)) + F.lit(PRIOR))).alias("score"))
        good = patterns.filter((F.col("seeds") >= min_seeds) & (F.col("score") >= min_score)).select("left", "score")
        good = staged(good, f"pii-patterns{n}")
        if n == rounds - 1:
            return good
        scored = edges.join(lifted(edges, good), "instance", "left").select("left", "instance", "seed", F.when(
            F.col("seed") == 1, 1.0).otherwise(F.coalesce("lift", F.lit(0.0))).alias("score"))
    raise ValueError("rounds must be at least 1")


def trusted_patterns(found: DataFrame, rounds: int = ROUNDS, min_score: float = MIN_SCORE, min_seeds: int = MIN_SEEDS,
                     sure: float = SURE) -> DataFrame:
    """(left, score): the trusted patterns of two left words, over these patterns alone."""
    return bootstrap(graph(found, False), rounds, min_score, min_seeds, sure)


def find(docs: DataFrame, key: str = "doc_id", text: str = "text", rounds: int = ROUNDS, min_score: float = MIN_SCORE,
         min_seeds: int = MIN_SEEDS, sure: float = SURE) -> DataFrame:
    """(doc_id, email, ip, card, phone, id): arrays of struct<start,end> in code points, one row per row of ``docs``."""
    found = staged(extract(docs, key, text), "pii-found")
    edges = graph(found, True)
    trusted = bootstrap(edges, rounds, min_score, min_seeds, sure)
    spans = found.select("row", F.explode("candidates").alias("s"))
    behind = spans.select("row", "s.start", "s.end", F.explode(patterns_of(F.col("s"), True)).alias("left")).join(
        trusted, "left", "left_semi")
    known = lifted(edges, trusted).filter(F.col("lift") >= min_score)
    again = spans.filter(F.length("s.value") >= KNOWN_CHARS).select(
        "row", "s.start", "s.end", F.xxhash64("s.value").alias("instance")).join(known, "instance", "left_semi")
    new = behind.drop("left").unionByName(again.drop("instance"))
    per_row = new.groupBy("row").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("id"))  # of one text
    none = F.array().cast("array<struct<start:int,end:int>>")
    return found.join(per_row, "row", "left").select("doc_id", *KINDS, F.coalesce("id", none).alias("id"))


def digest(spans: DataFrame) -> DataFrame:
    """Counts, digest of the base spans, and all spans as text."""
    def text(kind: str) -> Column:
        return F.transform(F.col(kind), lambda s: F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string")))

    base = F.concat(*[text(k) for k in KINDS])
    return spans.select("doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
                        F.sha2(F.array_join(base, ",").cast("binary"), 256).alias("base_sha256"),
                        F.array_join(F.concat(base, text("id")), ",").alias("spans"))
