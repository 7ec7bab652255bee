from test_url_filter import duck

from fintide.llm import oracles, queries
from fintide.llm import quotation as C

ROWS = [
    (1, 0, "user", "How do I  sort a list?\nIt is long."),
    (1, 1, "assistant", "Use sorted().\nIt returns a new list."),
    (1, 2, "user", "> Use SORTED().\n\nAnd in place?"),
    (1, 3, "user", "> It is long.\nHow long?"),
    (1, 4, "assistant", ">> Use sorted().\n> And in place?\nlist.sort()"),
    (1, 5, "user", "> > Use sorted().\n>   and  in place?\n> list.sort()\nThanks"),
    (1, 6, "user", "> never said\nHm"),
    (2, 0, "user", "> list.sort()\nOther conversation"),
    (2, 1, "user", "> Other conversation"),
    (2, 2, "user", "yes"), (2, 3, "user", "yes"), (2, 4, "user", "> yes\n> Other conversation\n>\n>> x"),
    (3, 0, None, None), (3, 1, "user", ""), (3, 2, "user", ">"), (3, 3, "user", " \t> \n>\n"), (None, 1, "user", "> a\nb"), (3, None, "user", "c"),
    (4, 7, "user", "a\nb"), (4, 7, "user", "a\nb"), (4, 9, "user", "> a"), (4, 9, "user", "z"),
]
SCHEMA = "conv_id long, turn long, role string, text string"


ROWS += [
    (5, 0, "user", "The quick brown fox jumps over the lazy dog and runs away."), (5, 1, "user", "Something else entirely is being said in here."),
    (5, 2, "user", "> The quick brown\n> fox jumps over the lazy\n> dog and runs away.\nReally?"),  # wrapped anew
    (5, 3, "user", "> Really?\nunder a"), (5, 4, "user", "> The quick brown fox jumps\n> over the lazy dog\nbranch b"), (5, 5, "user", "> under a\nlast"),
    (5, 6, "user", "> under a\n> > Something else entirely\n> > is being said in here.\n>> Really?\nboth"), (5, 7, "user", ">  short\n> words here\nx"),
    (5, 8, "user", "short words\nhere"), (5, 9, "user", "> short words here\nyes"),
]


def as_rows(df, cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=lambda r: tuple((x is None, str(x)) for x in r))


def from_duck(con):
    got = con.execute(oracles.OP3)
    cols = [d[0] for d in got.description]
    return cols, sorted(got.fetchall(), key=lambda r: tuple((x is None, str(x)) for x in r))


def test_query_against_sql(spark):
    sf = "/root/testdata/sf0.1"
    cols, want = from_duck(duck(sf, "conversations"))
    assert as_rows(queries.op3_quotation_linking(spark, sf), cols) == want


def test_quotes_against_sql(spark, tmp_path):
    df = spark.createDataFrame(ROWS, SCHEMA)
    df.coalesce(1).write.parquet(str(tmp_path / "c"))
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/c/*.parquet')")
    cols, want = from_duck(con)
    out = C.conversations(df)
    assert as_rows(out, cols) == want
    at = {(r.conv_id, r.turn): r for r in out.collect()}
    assert [at[1, t].reply_to for t in range(7)] == [None, None, 1, 0, 2, 4, None]
    assert [at[1, t].thread_turn for t in range(7)] == [0, 1, 1, 0, 1, 1, 6]
    assert [at[1, t].depth for t in range(7)] == [0, 0, 1, 1, 2, 3, 0]
    assert at[1, 5].text == "Thanks" and at[1, 5].n_quoted == 3 and at[3, 0].text is None and at[2, 4].text == ""
    assert at[2, 4].reply_to == 2 and at[1, 0].text == ROWS[0][3]
    assert [at[5, t].reply_to for t in range(10)] == [None, None, 0, 2, 0, 3, 3, None, None, 8]
    order = sorted((r.thread_turn, r.place, r.turn) for r in out.filter("conv_id = 5").collect())
    assert [t for _, _, t in order] == [0, 2, 3, 5, 6, 4, 1, 7, 8, 9]  # branches stay together
    assert at[5, 6].quoted == "1:3,2:1" and at[1, 5].quoted == "1:4,2:1" and at[5, 0].quoted == ""
    texts = {(r.conv_id, r.thread_turn): r.chat for r in C.assembled(out.filter("conv_id = 5")).collect()}
    assert [x.split("|>\n")[1].split("\n")[0] for x in texts[5, 0].split("<|user")[1:]] == [
        "The quick brown fox jumps over the lazy dog and runs away.", "Really?", "under a", "last", "both", "branch b"]
    deep = {(r.turn, r.level): r.quoted_turn for r in C.links(df).filter("conv_id = 1").collect()}
    assert deep[4, 2] == 1 and deep[5, 2] == 1 and deep[4, 1] == 2


def test_long_thread_in_one_hot_conversation(spark):
    rows = [(1, t, "user", (f"> line {t - 1}\n" if t else "") + f"line {t}") for t in range(400)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", reply_to string, extra int")
    out = C.conversations(df)
    got = {r.turn: (r.reply_to, r.thread_turn, r.depth, r.place, r.text) for r in out.collect()}
    assert got == {t: (t - 1 if t else None, 0, t, t, f"line {t}") for t in range(400)}
    parts = C.assembled(out).collect()
    assert sorted(r.part for r in parts) == list(range(7)) and sum(r.chat.count("<|user|>") for r in parts) == 400
    assert "extra" in out.columns and C.conversations(df.limit(0)).count() == 0


def test_places_are_the_pre_order(spark):
    import random

    rng = random.Random(9)
    parent = {t: rng.randrange(max(0, t - 12), t) for t in range(1, 120)}
    df = spark.createDataFrame([(1, t, p) for t, p in parent.items()], "conv_id long, turn long, reply_to long")
    order, stack = [], [0]
    while stack:
        t = stack.pop()
        order.append(t)
        stack += sorted((c for c, p in parent.items() if p == t), reverse=True)
    got = {r.turn: r.place for r in C.threads(df).collect()}
    assert got == {t: i for i, t in enumerate(order) if t}
