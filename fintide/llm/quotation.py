"""Chat formatting by quotation linking.

Messages of a conversation quote earlier ones with ``>`` markers, nested to
any level.  Lines are parsed into (level, content), and neighbouring lines of one
level are a block.  The passages of a block, normalised (A-Z lower-cased, white
space collapsed) and hashed, are its runs of ``RUN`` words, so a quote that a mail
client has wrapped anew still has them, and where there are fewer words its
lines and the block itself.  Every quoted passage is joined to the message that
first said it unquoted in the same conversation.  A message replies to the
earlier message most of its level-1 passages come from (ties: the latest); deeper
levels are linked in the same way.

Conversations come back without quotes, one row per message, in reply order:
``thread_turn`` is the first message of the reply chain and ``place`` the
message's number in the thread's pre-order (every reply after what it answers,
replies to one message by turn, each with its own replies), so sorting by
(conv_id, thread_turn, place) keeps branches together.  ``assembled`` joins them to
texts of a bounded number of messages.

Nothing is gathered per conversation: passages are matched with an equi-join
on (conv_id, hash) against one row per passage, only in conversations that
quote; reply chains, the sizes of their branches and places are found by pointer
doubling over written tables, so a conversation may hold any share of the rows.

Defined cases: a NULL or empty text quotes nothing and stays as it is.  A
message that quotes nothing known starts a thread.  Rows with a NULL conv_id
or turn start their own thread and are never linked.  Repeated (conv_id, turn)
rows are one message for linking and keep their rows.  Blank quoted lines are
dropped with the quotes but link nothing.  Extra columns pass through; those
named like an output are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fintide.llm.common import SPACE, ascii_lower, let, staged

MARKS = r"^[ \t]*((?:>[ \t]*)*)"
RUN = 5
MESSAGES = 64
BLOCK, LEVEL, OTHER = "\ue000", "\ue001", "\ufffd"


def level_of(line: Column) -> Column:
    """Number of quote marks at the start of a line."""
    return F.length(F.regexp_replace(F.regexp_extract(line, MARKS, 1), r"[ \t]", ""))


def content_of(line: Column) -> Column:
    return F.when(line.rlike(r"^[ \t]*>"), F.regexp_replace(line, MARKS, "")).otherwise(line)


def normalised(content: Column) -> Column:
    return F.trim(F.regexp_replace(ascii_lower(content), SPACE + "+", " "))


def without_quotes(text: Column) -> Column:
    """The unquoted lines of a text; a text without quotes stays as it is."""
    kept = F.filter(F.split(text, "\n"), lambda x: ~x.rlike(r"^[ \t]*>"))
    return F.when(text.rlike(r"(?m)^[ \t]*>"), F.btrim(F.array_join(kept, "\n"), F.lit("\n"))).otherwise(text)


def blocks_of(text: Column) -> Column:
    """array<string> of a text's blocks, each as level, a mark and its lines, which are parted by line feeds."""
    lines = F.split(F.translate(text, BLOCK + LEVEL, OTHER * 2), "\n")
    parsed = F.transform(lines, lambda x: F.struct(level_of(x).alias("level"), content_of(x).alias("content")))

    def marked(p: Column) -> Column:
        def head(x: Column, i: Column) -> Column:
            same = F.when(i > 0, p[i - 1]["level"] == x["level"]).otherwise(F.lit(False))
            return F.concat(F.when(same, F.lit("\n")).otherwise(F.concat(F.lit(BLOCK), x["level"].cast("string"), F.lit(LEVEL))), x["content"])

        return F.filter(F.split(F.array_join(F.transform(p, head), ""), BLOCK), lambda b: b != "")

    return let(parsed, marked)


def passages_of(lines: Column, run: int = RUN) -> Column:
    """array<string> of the distinct passages of a block."""
    def few(w: Column) -> Column:
        return (F.size(w) > 0) & (F.size(w) < run)

    def joined(words: Column) -> Column:
        return F.array_join(words, " ")

    def words(text: Column) -> Column:
        return F.array_remove(F.split(normalised(text), " "), "")

    def runs(w: Column) -> Column:
        at = F.sequence(F.lit(1), F.greatest(F.size(w) - run + 1, F.lit(1)))
        return F.when(F.size(w) >= run, F.transform(at, lambda i: joined(F.slice(w, i, run)))).otherwise(F.array().cast("array<string>"))

    whole = let(words(lines), lambda w: F.concat(runs(w), F.when(few(w), F.array(joined(w))).otherwise(F.array().cast("array<string>"))))
    short = F.transform(F.filter(F.transform(F.split(lines, "\n"), words), few), joined)
    return F.array_distinct(F.concat(whole, short))


def links(messages: DataFrame, run: int = RUN) -> DataFrame:
    """(conv_id, turn, level, quoted_turn, passages): the best earlier source of each message's quotes at each level."""
    known = messages.filter("conv_id IS NOT NULL AND turn IS NOT NULL AND text IS NOT NULL").select("conv_id", "turn", "text")
    quoting = known.filter(F.col("text").rlike(r"(?m)^[ \t]*>")).select("conv_id").distinct()
    blocks = known.join(quoting, "conv_id", "left_semi").select("conv_id", "turn", F.explode(blocks_of(F.col("text"))).alias("b"))
    blocks = blocks.select("conv_id", "turn", F.substring_index("b", LEVEL, 1).cast("int").alias("level"),
                           F.substring_index("b", LEVEL, -1).alias("lines"))
    hashed = blocks.select("conv_id", "turn", "level", F.explode(passages_of(F.col("lines"), run)).alias("p")).select(
        "conv_id", "turn", "level", F.xxhash64("p").alias("h"))
    said = hashed.filter("level = 0").groupBy("conv_id", "h").agg(F.min("turn").alias("quoted_turn"))
    quotes = hashed.filter("level > 0").distinct()
    found = quotes.join(said, ["conv_id", "h"]).filter("quoted_turn < turn")
    votes = found.groupBy("conv_id", "turn", "level", "quoted_turn").agg(F.count(F.lit(1)).alias("passages"))
    best = votes.groupBy("conv_id", "turn", "level").agg(F.max(F.struct("passages", "quoted_turn")).alias("b"))
    return best.select("conv_id", "turn", "level", "b.quoted_turn", "b.passages")


def threads(replies: DataFrame) -> DataFrame:
    """(conv_id, turn, reply_to, thread_turn, depth, place) of every reply (conv_id, turn, reply_to), by pointer doubling."""
    one = F.lit(1).cast("long")
    table = staged(replies.select("conv_id", "turn", "reply_to", F.col("reply_to").alias("at"), one.alias("depth"), one.alias("size")), "quote-threads")
    moved = True
    while moved:
        # A pointer at a message without a reply_to has arrived.  After n rounds a size counts the branch up to 2^n replies away.
        step = table.select("conv_id", F.col("turn").alias("at"), F.col("at").alias("next"), F.col("depth").alias("more"))
        below = table.groupBy("conv_id", F.col("at").alias("turn")).agg(F.sum("size").alias("below"))
        joined = table.join(step, ["conv_id", "at"], "left").join(below, ["conv_id", "turn"], "left")
        after = staged(joined.select("conv_id", "turn", "reply_to", F.coalesce("next", "at").alias("at"),
                                     (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
                                     (F.col("size") + F.coalesce("below", F.lit(0))).alias("size"), F.col("next").isNotNull().alias("moved")), "quote-threads")
        moved = bool(after.filter("moved").limit(1).count())
        table = after.drop("moved")
    # A reply's place: one behind what it answers, and behind the branches of earlier replies to that.
    earlier = Window.partitionBy("conv_id", "reply_to").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    own = (one + F.coalesce(F.sum("size").over(earlier), F.lit(0))).alias("place")
    places = staged(table.select("conv_id", "turn", F.col("reply_to").alias("at"), own), "quote-places")
    moved = True
    while moved:
        step = places.select("conv_id", F.col("turn").alias("at"), F.col("at").alias("next"), F.col("place").alias("more"))
        after = staged(places.join(step, ["conv_id", "at"], "left").select(
            "conv_id", "turn", F.coalesce("next", "at").alias("at"), (F.col("place") + F.coalesce("more", F.lit(0))).alias("place"),
            F.col("next").isNotNull().alias("moved")), "quote-places")
        moved = bool(after.filter("moved").limit(1).count())
        places = after.drop("moved")
    return table.select("conv_id", "turn", "reply_to", F.col("at").alias("thread_turn"), "depth").join(
        places.select("conv_id", "turn", "place"), ["conv_id", "turn"])


def conversations(messages: DataFrame, run: int = RUN) -> DataFrame:
    """Every message with its text without quotes, n_quoted, quoted (level:turn of all its levels), reply_to, thread_turn,
    place, depth and chat."""
    own = ["n_quoted", "quoted", "reply_to", "thread_turn", "place", "depth", "chat"]
    rows = messages.drop(*own)
    found = staged(links(rows, run), "quote-links")
    told = F.struct("level", F.concat_ws(":", "level", "quoted_turn").alias("text"))
    levels = found.groupBy("conv_id", "turn").agg(F.array_sort(F.collect_list(told)).alias("l"))  # one row a level of a message
    levels = levels.select("conv_id", "turn", F.array_join(F.transform("l", lambda x: x["text"]), ",").alias("quoted"))
    chain = threads(found.filter("level = 1").select("conv_id", "turn", F.col("quoted_turn").alias("reply_to")))
    quoted = F.coalesce(F.size(F.filter(F.split("text", "\n"), lambda x: x.rlike(r"^[ \t]*>"))), F.lit(0))
    clean = without_quotes(F.col("text"))
    out = rows.join(chain, ["conv_id", "turn"], "left").join(levels, ["conv_id", "turn"], "left")
    return out.select(
        *[clean.alias("text") if c == "text" else F.col(f"`{c}`") for c in rows.columns],
        F.greatest(quoted, F.lit(0)).cast("long").alias("n_quoted"), F.coalesce("quoted", F.lit("")).alias("quoted"), "reply_to",
        F.coalesce("thread_turn", "turn").alias("thread_turn"), F.coalesce("place", F.lit(0)).cast("long").alias("place"),
        F.coalesce("depth", F.lit(0)).cast("long").alias("depth"),
        F.concat(F.lit("<|"), F.coalesce("role", F.lit("")), F.lit("|>\n"), F.coalesce(clean, F.lit("")), F.lit("\n<|end|>")).alias("chat"))


def assembled(rows: DataFrame, messages: int = MESSAGES) -> DataFrame:
    """(conv_id, thread_turn, part, chat): the threads of ``conversations`` as texts of ``messages`` places each, in reply order."""
    part = F.floor(F.col("place") / messages).alias("part")
    chats = F.array_sort(F.collect_list(F.struct("place", "turn", "chat")))  # of ``messages`` places
    return rows.groupBy("conv_id", "thread_turn", part).agg(F.array_join(F.transform(chats, lambda c: c["chat"]), "\n").alias("chat"))
