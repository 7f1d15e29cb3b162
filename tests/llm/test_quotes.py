from pyspark.sql import functions as F

from tests.llm import frames
from usertide.llm import quotes


def parsed(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    return [(p.level, p.text) for p in df.select(quotes.passages_of(F.col("t")).alias("p")).first().p]


def test_levels_blank_lines_and_introductions(spark):
    text = "Hi,\nsee below.\n\nOn Monday, Ann wrote:\n> one\n> two\n>\n> three\n> Am Freitag schrieb Bob:\n>> inner\n> > same level\nend\n> again"
    assert parsed(spark, text) == [
        (0, "Hi,\nsee below."),
        (1, "one\ntwo"),
        (1, "three"),
        (2, "inner\nsame level"),
        (0, "end"),
        (1, "again"),
    ]


def test_odd_texts(spark):
    assert parsed(spark, "") == []
    assert parsed(spark, "\n \n>\n>> \n") == []
    assert parsed(spark, "she wrote:\nno quote follows") == [(0, "she wrote:\nno quote follows")]
    assert parsed(spark, "a > b\n  > c\r\n>>>deep") == [(0, "a > b"), (1, "c"), (3, "deep")]
    assert parsed(spark, "x\x1ey\x1fz") == [(0, "x y z")]
    long = "\n".join(["> " + w for w in frames.LONG.split(" ")])
    assert parsed(spark, long) == [(1, frames.LONG.replace(" ", "\n"))]


MAIL = [
    (1, 0, "First   question?\n\nThanks!"),
    (1, 1, "An answer.\n\nX wrote:\n> first question?"),
    (1, 2, "Another answer\nOn it, X wrote:\n> First\n> question?\n> \n> not said by anyone"),
    (1, 3, "Both:\n> An answer.\n>> First question?\n\n> Another answer"),
    (1, 4, "> Both:"),
    (1, 5, "no quote"),
    (2, 0, "> first question?"),
    (2, 1, "Thanks!"),
    (2, 2, "Thanks!"),
    (2, 3, "> thanks!"),
    (3, 5, "> later"),
    (3, 6, "later"),
    (4, 0, None),
    (4, 1, ""),
    (4, 2, ">"),
    (None, 0, "First question?"),
    (1, None, "> First question?"),
    (1, 4, "> Both:"),
    (1, 4, "Another text of the same turn"),
]


def test_links_and_threads(spark):
    df = spark.createDataFrame(MAIL, "conv_id long, turn long, text string")
    rows = quotes.link_quotes(frames.clashing(df)).collect()
    assert len(rows) == len(MAIL)
    got = {}
    for r in rows:
        got.setdefault((r.conv_id, r.turn), []).append((r.quoted, r.linked, r.sources, r.parent, r.thread, r.depth))
    assert got[1, 0] == [(0, 0, [], None, 0, 0)]
    assert got[1, 1] == [(1, 1, [0], 0, 0, 1)]
    assert got[1, 2] == [(2, 1, [0], 0, 0, 1)]
    assert got[1, 3] == [(3, 3, [0, 1, 2], 2, 0, 2)]
    assert sorted(got[1, 4]) == [(0, 0, [], 3, 0, 3), (1, 1, [3], 3, 0, 3), (1, 1, [3], 3, 0, 3)]
    assert got[1, 5] == [(0, 0, [], None, 5, 0)]
    assert got[2, 0] == [(1, 0, [], None, 0, 0)]  # other conversations are not searched
    assert got[2, 3] == [(1, 1, [1], 1, 1, 1)]  # the earliest of several
    assert got[3, 5] == [(1, 0, [], None, 5, 0)]  # nobody quotes what comes later
    assert got[None, 0] == [(0, 0, [], None, 0, 0)] and got[1, None][0][:4] == (1, 0, [], None)
    own = {(r.conv_id, r.turn): r.own for r in rows}
    assert own[1, 1] == "An answer." and own[4, 0] == own[4, 2] == "" and own[1, 0] == "First   question?\n\nThanks!"
    order = [(r.conv_id, r.thread, r.turn) for r in rows if r.conv_id == 1 and r.turn is not None]
    assert order == sorted(order)


def test_long_chains(spark):
    rows = [(1, i, f"message {i}\n> message {i - 1}") for i in range(150)]
    out = quotes.link_quotes(spark.createDataFrame(rows, "conv_id long, turn long, text string"))
    assert [(r.thread, r.depth) for r in out.collect()] == [(0, i) for i in range(150)]


def test_empty_table_and_derived_mail(spark):
    df = spark.createDataFrame(MAIL, "conv_id long, turn long, text string")
    assert quotes.link_quotes(df.limit(0)).count() == 0
    said = spark.createDataFrame([(7, 0, "user", "a\nb"), (7, 1, "assistant", "c"), (7, 2, None, None)], "conv_id long, turn long, role string, text string")
    mail = {r.turn: r.text for r in quotes.quoted_mail(said).collect()}
    assert mail[0] == "a\nb"
    assert mail[1] == "c\n\nOn turn 0 the user wrote:\n> a\n> b"
    assert mail[2] == "\n\nOn turn 0 the user wrote:\n> a\n> b"
