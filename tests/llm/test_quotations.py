"""Quotation linking on small conversations."""

import random

from strandline.llm import quotations

SCHEMA = "conv_id bigint, turn bigint, role string, text string, depth string"


def linked(spark, rows):
    df = spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA).repartition(3)
    return {(r["conv_id"], r["turn"]): r for r in quotations.link_quotations(df).collect()}


def test_nested_quotes_and_threads(spark):
    got = linked(spark, [
        (1, 0, "user", "Hello there.\nHow are you?"), (1, 1, "assistant", "Al wrote:\n> Hello there. How\n> are   YOU?\n\nFine."), (1, 2, "user", ">> Hello there. How are you?\n> Fine.\nGood.\r\nBye."),
        (1, 3, "user", "new topic"), (1, 4, None, "> never said\nhm"), (1, 5, "user", "he wrote:\nnothing quoted"), (1, 6, "user", ">>> Hello there.\n>>> How are\n>>> you?\nold"),
        (2, 0, "user", "> Fine.\nx"), (2, 1, "user", "> x\n\n> x"), (None, 1, "user", "> x\ny"), (1, None, "user", "Fine."),
    ])
    shown = {k: (r["parent_turn"], r["thread_root"], r["depth"], r["body"], r["quote_levels"], r["n_quoted"]) for k, r in got.items()}
    assert shown[1, 0] == (None, 0, 0, "Hello there.\nHow are you?", 0, 0)
    assert shown[1, 1] == (0, 0, 1, "Fine.", 1, 2)
    assert shown[1, 2] == (1, 0, 2, "Good.\nBye.", 2, 2)
    assert shown[1, 3] == (None, 3, 0, "new topic", 0, 0)
    assert shown[1, 4] == (None, 4, 0, "hm", 1, 1)
    assert shown[1, 5] == (None, 5, 0, "he wrote:\nnothing quoted", 0, 0)
    assert shown[1, 6] == (0, 0, 1, "old", 3, 3)
    assert shown[2, 0] == (None, 0, 0, "x", 1, 1) and shown[2, 1] == (0, 0, 1, "", 1, 2)
    assert shown[None, 1][0] is None and shown[1, None][:2] == (None, None)
    assert got[1, 4]["chat"] == "<|unknown|>\nhm\n<|end|>\n"


def test_long_chains_and_a_hot_conversation(spark):
    rows = [(1, k, "user", f"said {k}" if k == 0 else f"> said {k - 1}\nsaid {k}") for k in range(90)]
    rows += [(1, 1000 + k, "user", "hello all") for k in range(200)] + [(1, 5000 + k, "user", "> hello all\nyes") for k in range(200)]
    got = linked(spark, rows)
    assert all((got[1, k]["thread_root"], got[1, k]["depth"]) == (0, k) for k in range(90))
    assert {got[1, 5000 + k]["parent_turn"] for k in range(200)} == {1000}


def test_replies_come_after_what_they_reply_to(spark):
    rnd = random.Random(3)
    rows = [(c, t, "user", (f"> c{c} t{rnd.randrange(t)}\n" if t and rnd.random() < 0.7 else "") + f"c{c} t{t}") for c in range(5) for t in range(30)]
    got = linked(spark, rows)
    order = {k: n for n, k in enumerate(sorted(got, key=lambda k: (k[0], got[k]["thread_root"], k[1])))}
    for (c, t), r in got.items():
        if r["parent_turn"] is not None:
            assert order[c, r["parent_turn"]] < order[c, t] and r["thread_root"] == got[c, r["parent_turn"]]["thread_root"]


def test_parts_of_a_passage_link_by_long_lines_only(spark):
    got = linked(spark, [
        (1, 0, "user", "yes\nthis line has more than four words\nno"), (1, 1, "user", "another one\nyes"), (1, 2, "user", "> this line has more   than four words\nI see"),
        (1, 3, "user", "> yes\nwhat?"), (1, 4, "user", ">this line\n> has more than four words no\nnot quite"),
    ])
    assert [got[1, k]["parent_turn"] for k in range(5)] == [None, None, 0, None, None]


def test_positions_and_a_long_message(spark):
    long = "\n".join(f"line {k} of very many lines" for k in range(20_000))
    rows = [(1, 0, "user", long), (1, 5000, "user", "> " + long.replace("\n", "\n> ") + "\nno"), (1, 9000, "user", "> no\nyes"), (1, 9000, "user", "> no\nyes"), (1, 9001, "user", "> yes\nfine"), (1, 4, "user", "else")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA)
    got = sorted((r["turn"], r["thread_root"], r["depth"], r["position"]) for r in quotations.link_quotations(df).collect())
    assert got == [(0, 0, 0, 1), (4, 4, 0, 1), (5000, 0, 1, 2), (9000, 0, 2, 3), (9000, 0, 2, 3), (9001, 0, 3, 5)]


def test_replies_that_quote(spark):
    df = spark.createDataFrame([(1, 0, "a", "One. Two\nthree"), (1, 1, "b", "Four."), (1, 2, None, "Five."), (2, 7, "a", None)], "conv_id bigint, turn bigint, role string, text string")
    sent = {(r["conv_id"], r["turn"]): r["text"] for r in quotations.quoting_replies(df).collect()}
    assert sent == {(1, 0): "One. Two\nthree", (1, 1): "a wrote:\n> One.\n> Two three\n\nFour.", (1, 2): "b wrote:\n>> One.\n>> Two three\n> Four.\n\nFive.", (2, 7): None}
    got = {r["turn"]: (r["parent_turn"], r["depth"], r["body"]) for r in quotations.link_quotations(quotations.quoting_replies(df)).collect()}
    assert got == {0: (None, 0, "One. Two\nthree"), 1: (0, 1, "Four."), 2: (1, 2, "Five."), 7: (None, 0, "")}


def test_repeated_rows_nulls_and_no_rows(spark):
    df = spark.createDataFrame([(1, 0, "user", "a", "x"), (1, 1, "user", "> a\nb", "x"), (1, 1, "user", "> a\nb", "x"), (1, 2, None, None, "x"), (1, 3, "user", "", "x")], SCHEMA)
    rows = sorted(quotations.link_quotations(df).select("turn", "parent_turn", "body").collect())
    assert [tuple(r) for r in rows] == [(0, None, "a"), (1, 0, "b"), (1, 0, "b"), (2, None, ""), (3, None, "")]
    assert quotations.link_quotations(df.where("turn > 9")).count() == 0
