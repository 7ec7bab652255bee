"""URL filters: host and path rules, and a list of canonical URLs behind a blocked Bloom filter.

The listed canonical URLs are folded into a split-block Bloom filter: a URL's
hash picks one block of four 64-bit words and sets ``BITS_PER_WORD`` bits in
each.  The filter is an aggregate, one row per block (``bit_or`` of the
masks), so it is built with map-side combining and may have any size.  A page
looks up its one block; pages whose bits are all set are possible hits, and
only those go on to an exact equi-join with the list, which removes the false
positives.  The others never take part in a join on the URL.

The filter is broadcast only if its size, known from the number of listed
URLs, is at most ``BROADCAST_BYTES``; otherwise blocks are matched with a
shuffled join that adaptive execution splits where a block is hot.

Rules come before the list: (verdict, "host/path"); a rule fits its host and
all subdomains if the path starts with its path, and the longest rule wins.

Defined cases: NULL urls and urls without ``://`` have empty host and path, no
canonical URL, fit no rule and are allowed.  Repeated rows are judged alike;
repeated listed URLs count once and NULL ones are ignored.  With an empty list
only rules block.  Extra columns of the pages pass through unless they clash
with an output name, which is replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fintide.llm.common import ascii_lower, boxed, unboxed

WORDS = 4  # 64-bit words of a block
BITS_PER_WORD = 2
BITS_PER_KEY = 14
BROADCAST_BYTES = 8 << 20
ROW_BYTES = 64  # of a block in memory, at most

#: Production rules of the query.
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)


def url_parts(url: Column) -> dict[str, Column]:
    """host (A-Z lower-cased), path and query (with its question mark) of a url; empty without ``://``."""
    absolute = F.coalesce(F.instr(url, "://") > 0, F.lit(False))
    after = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    part = lambda pattern: F.when(absolute, F.regexp_extract(after, pattern, 1)).otherwise(F.lit(""))
    return {"host": ascii_lower(part(r"^([^/?#]*)")), "path": part(r"^[^/?#]*([^?#]*)"), "query": part(r"^[^?#]*(\?[^#]*)")}


def canonical(host: Column, path: Column, query: Column) -> Column:
    """host without ``www.`` and default port, path without closing slash, query without tracking parameters; NULL without host."""
    site = F.regexp_replace(F.regexp_replace(host, r":(80|443)$", ""), r"^www\.", "")
    kept = F.regexp_replace(F.regexp_replace(query, r"(?<=[?&])utm_[^&]*(&|$)", ""), r"[?&]+$", "")
    return F.when(host != "", F.concat(site, F.regexp_replace(path, r"/+$", ""), kept))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, both NULL if none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for decision, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        rule_host, slash, rule_path = text.partition("/")
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(slash + rule_path)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, decision).otherwise(verdict)
    return rule, verdict


def _masks(key: Column) -> list[Column]:
    """The bits a key sets in each word of its block."""
    h = F.xxhash64(F.lit(1), key)
    out = []
    for w in range(WORDS):
        bits = None
        for i in range(BITS_PER_WORD):
            at = F.shiftrightunsigned(h, 6 * (w * BITS_PER_WORD + i)).bitwiseAND(F.lit(63)).cast("int")
            bit = F.call_function("shiftleft", F.lit(1).cast("long"), at)
            bits = bit if bits is None else bits.bitwiseOR(bit)
        out.append(bits)
    return out


def bloom_filter(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """(block, w0..w3): the filter of the distinct non-NULL keys."""
    marked = keys.filter(F.col(key).isNotNull()).select(
        F.pmod(F.xxhash64(key), F.lit(blocks)).alias("block"), *[m.alias(f"w{i}") for i, m in enumerate(_masks(F.col(key)))])
    return marked.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])


def possible(rows: DataFrame, key: str, listed: DataFrame, listed_key: str, bits_per_key: int = BITS_PER_KEY) -> DataFrame:
    """``rows`` with a boolean column ``_possible``: false means the key is certainly not listed."""
    n = listed.count()
    blocks = max(1, -(-n * bits_per_key // (64 * WORDS)))
    table = bloom_filter(listed, listed_key, blocks).withColumnRenamed("block", "_block")
    if blocks * ROW_BYTES <= BROADCAST_BYTES:
        table = F.broadcast(table)
    probe = rows.withColumn("_block0", F.pmod(F.xxhash64(key), F.lit(blocks)))
    joined = probe.join(table, F.col("_block0") == F.col("_block"), "left")
    hit = F.col("_block").isNotNull() & F.col(key).isNotNull()
    for i, m in enumerate(_masks(F.col(key))):
        hit = hit & (F.col(f"w{i}").bitwiseAND(m) == m)
    return joined.select(*[F.col(f"`{c}`") for c in rows.columns], F.coalesce(hit, F.lit(False)).alias("_possible"))


def judge(pages: DataFrame, listed: DataFrame, rules: Sequence[tuple[str, str]] = RULES, url: str = "url",
          listed_key: str = "canonical", bits_per_key: int = BITS_PER_KEY) -> DataFrame:
    """Every page with host, path, canonical, rule, listed and verdict.

    ``listed`` holds canonical URLs in column ``listed_key``.
    """
    parts = url_parts(F.col(f"`{url}`"))
    own = ["host", "path", "canonical", "rule", "listed", "verdict"]
    rows = boxed(pages, **{f"_{p}": parts[p] for p in ("host", "path", "query")})
    rows = rows.withColumn("_canonical", canonical(F.col("_host"), F.col("_path"), F.col("_query"))).drop("_query")
    exact = listed.select(F.col(listed_key).alias("_listed")).filter("_listed IS NOT NULL").distinct()
    probed = possible(rows, "_canonical", exact, "_listed", bits_per_key)
    hits = probed.filter("_possible").join(exact, F.col("_canonical") == F.col("_listed"), "left")
    rest = probed.filter("NOT _possible").withColumn("_listed", F.lit(None).cast("string"))
    every = hits.unionByName(rest)
    rule, verdict = rule_of(F.col("_host"), F.col("_path"), rules)
    on_list = F.col("_listed").isNotNull()
    return every.select(
        *unboxed([c for c in pages.columns if c not in own]), F.col("_host").alias("host"), F.col("_path").alias("path"),
        F.col("_canonical").alias("canonical"), rule.alias("rule"), on_list.alias("listed"),
        F.coalesce(verdict, F.when(on_list, "block").otherwise("allow")).alias("verdict"))


#: Sites whose pages make up the list of the query: a stand-in, taken from the table itself, for an external list of URLs.
LISTED_SITES = ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")


def listed_urls(pages: DataFrame, sites: Sequence[str] = LISTED_SITES) -> DataFrame:
    """(canonical): canonical URLs of the pages on ``sites`` (a label of the host)."""
    parts = url_parts(F.col("url"))
    rows = pages.select(*[parts[p].alias(p) for p in ("host", "path", "query")])
    on_site = F.col("host").rlike(r"(^|\.)(" + "|".join(sites) + r")\.")
    return rows.filter(on_site).select(canonical(F.col("host"), F.col("path"), F.col("query")).alias("canonical")).distinct()
