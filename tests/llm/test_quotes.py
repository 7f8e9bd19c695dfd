import random

from gameflow.llm.quotes import as_mail, link_quotes

SCHEMA = "conv_id long, turn long, role string, text string, level string, thread int"


def run(spark, rows):
    frame = spark.createDataFrame([(c, t, "r", x, "l", 1) for c, t, x in rows], SCHEMA)
    return {(r.conv_id, r.turn): r for r in link_quotes(frame).collect()}


def test_levels_and_replies(spark):
    rows = [
        (1, 0, "First  words\nand MORE"),
        (1, 1, "On Monday, A wrote:\n> first words\n> and more\n\nAn answer"),
        (1, 2, "> > First words\n>>And more\n> An answer\nAnother"),
        (1, 3, "> first words\nA branch"),
        (1, 4, ">> an answer\nonly deeper"),
        (1, 5, "On reflection he wrote:\nnot a quote"),
        (1, 6, "> never said\nhm"),
        (2, 1, "> First words\nother conversation"),
        (1, 7, None), (1, 8, ""), (None, 1, "> First words\nx"), (1, None, "> First words\ny"),
    ]
    got = run(spark, rows)
    assert len(got) == len(rows)
    expected = {
        (1, 0): (None, 0, 0, 0, "First  words\nand MORE"), (1, 1): (0, 0, 1, 1, "An answer"), (1, 2): (1, 0, 2, 2, "Another"),
        (1, 3): (0, 0, 1, 1, "A branch"), (1, 4): (1, 0, 2, 2, "only deeper"),
        (1, 5): (None, 5, 0, 0, "On reflection he wrote:\nnot a quote"), (1, 6): (None, 6, 0, 1, "hm"),
        (2, 1): (None, 1, 0, 1, "other conversation"), (1, 7): (None, 7, 0, 0, ""), (1, 8): (None, 8, 0, 0, ""),
        (None, 1): (None, 1, 0, 1, "x"), (1, None): (None, None, 0, 1, "y"),
    }
    assert {k: (r.reply_to, r.thread, r.level, r.quote_depth, r.text) for k, r in got.items()} == expected


def test_latest_writer_and_majority(spark):
    got = run(spark, [(1, 0, "same"), (1, 1, "same\nb\nc"), (1, 2, "d"), (1, 3, "> same\nx"), (1, 4, "> d\n> b\n> c\ny"), (1, 5, "> d\n> b\nz")])
    assert [got[1, k].reply_to for k in (3, 4, 5)] == [1, 1, 2]


def test_long_chain_and_repeated_rows(spark):
    rows = [(1, k, (f"> line {k - 1}\n" if k else "") + f"line {k}") for k in range(40)]
    got = run(spark, rows)
    assert all(got[1, k].reply_to == (k - 1 if k else None) and got[1, k].level == k and got[1, k].thread == 0 for k in range(40))
    frame = spark.createDataFrame([(1, t, "r", x, "", 0) for t, x in [(0, "a"), (1, "> a\nb"), (1, "> a\nb"), (1, "c")]], SCHEMA)
    assert sorted((r.turn, r.reply_to, r.text) for r in link_quotes(frame).collect() if r.turn) == [(1, 0, "b"), (1, 0, "b"), (1, 0, "c")]


def test_hot_line_makes_no_pairs(spark):
    rows = [(1, k, "> yes\nyes\n" * 3) for k in range(300)]
    got = run(spark, rows)
    assert [got[1, k].reply_to for k in range(300)] == [None, *range(299)]


def test_mails_round_trip(spark):
    rng = random.Random(2)
    rows = [(c, t, "r", "\n".join(f"{c} {t} {k} {rng.random()}" for k in range(rng.randint(1, 4))), "", 0) for c in range(5) for t in range(6)]
    mails = as_mail(spark.createDataFrame(rows, SCHEMA))
    assert mails.where("text like '%> > %'").count() == 20
    got = {(r.conv_id, r.turn): r for r in link_quotes(mails).collect()}
    for c, t, _, text, *_ in rows:
        r = got[c, t]
        assert (r.text, r.reply_to, r.thread, r.level, r.quote_depth) == (text, t - 1 if t else None, 0, t, min(t, 2))


def test_empty_table(spark):
    assert link_quotes(spark.createDataFrame([], SCHEMA)).collect() == []


def test_no_python_in_the_plan(spark):
    frame = spark.createDataFrame([(1, 1, "r", "x", "", 0)], SCHEMA)
    plan = link_quotes(as_mail(frame))._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
