from articlelake.llm import quotes

SCHEMA = "conv_id long, turn long, role string, text string, body string, hash int"


def linked(spark, rows):
    df = spark.createDataFrame([(*row, "x", 1) for row in rows], SCHEMA)
    return {(r.conv_id, r.turn): r for r in quotes.linked_messages(df).collect()}


def test_nested_quotes_lead_to_their_authors(spark):
    first, second = "Where is the station?\n\nI looked for it.", "It is behind the old market."
    found = linked(spark, [
        (1, 0, "user", first), (1, 1, "assistant", second), (1, 2, "user", "Another matter."),
        (1, 3, "user", f"On Monday, A wrote:\n> {second}\n>> Where is  the STATION?\n\nThanks, found it."),
        (1, 4, "assistant", "> thanks, found it\nGood."), (1, 5, "user", "> I looked for it.\nStill looking?"),
        (2, 0, "user", "> It is behind the old market.\nIs that so?"), (3, 0, "user", "> nobody wrote this\nHm."),
    ])
    assert found[1, 3].body == "Thanks, found it." and found[1, 3].n_levels == 2
    assert [found[1, t].reply_turn for t in range(6)] == [None, None, None, 1, 3, 0]
    assert found[1, 4].reply_path == [1, 3, 4] and found[1, 5].reply_path == [0, 5]
    assert (found[2, 0].reply_conv, found[2, 0].reply_turn) == (1, 1) and found[2, 0].reply_path == [0]
    assert found[3, 0].reply_turn is None and found[3, 0].body == "Hm." and found[3, 0].n_levels == 1
    order = sorted((r.reply_path, r.turn) for (c, _), r in found.items() if c == 1)
    assert [turn for _, turn in order] == [0, 5, 1, 3, 4, 2]


def test_awkward_rows(spark):
    rows = [(1, 0, "user", None), (1, 1, "user", ""), (1, 2, None, ">"), (1, 3, "user", "> "), (None, 1, "user", "> a\nb"),
            (1, None, "user", "a"), (5, 1, "user", "> later\nx"), (5, 2, "user", "later"), (6, 0, "user", "self\n> self"),
            (7, 0, "user", ">" * 50 + " deep"), (7, 1, "user", "> q\n" * 5000 + "end")]
    df = spark.createDataFrame([(*row, "x", 1) for row in rows + rows], SCHEMA)
    out = quotes.chat(df).collect()
    assert len(out) == 2 * len(rows) and all(r.reply_turn is None for r in out)
    by_key = {(r.conv_id, r.turn): r for r in out}
    assert by_key[1, 0].body is None and by_key[1, 0].formatted == "<|user|>\n\n"
    assert by_key[1, 2].body == "" and by_key[7, 0].n_levels == 50 and by_key[7, 1].body == "end"
    assert quotes.chat(df.where("false")).count() == 0


def test_a_long_chain_and_a_hot_passage(spark):
    chain = [(1, 0, "user", "message 0")] + [(1, t, "user", f"> message {t - 1}\nmessage {t}") for t in range(1, 40)]
    hot = [(c, t, "user", "hello" if t == 0 else "> hello\nyes") for c in range(100, 200) for t in range(2)]
    found = linked(spark, chain + hot)
    assert found[1, 39].reply_path == list(range(40))
    assert all((found[c, 1].reply_conv, found[c, 1].reply_turn) == (c, 0) for c in range(100, 200))


def test_texts_without_quotes_stay(spark):
    text = "On Monday he wrote:\nno quote\n\n\n\nend "
    assert linked(spark, [(1, 0, "user", text)])[1, 0].body == text


def test_a_paragraph_quoted_with_other_line_breaks(spark):
    first = "Hello all.\n\nThe boat leaves\nfrom the old pier\nat nine.\n\nBring a coat\nand some bread."
    found = linked(spark, [
        (1, 0, "user", first), (1, 1, "assistant", "> The boat leaves from the\n> old pier at nine.\nSo early?"),
        (1, 2, "user", "> The boat\n> leaves from the old pier at nine.\n>\n> Bring a\n> coat and some bread.\nFine."),
        (1, 3, "user", "> Bring a coat and\n>> nobody wrote this\n> some bread.\nNo."),
        (2, 0, "user", first.replace("\n", "\r\n").replace("boat", "train")),
        (2, 1, "user", "> The train leaves from\r\n> the old pier at nine.\r\nOh."),
    ])
    assert [found[1, t].reply_turn for t in (1, 2)] == [0, 0] and found[1, 2].reply_path == [0, 2]
    assert found[1, 3].reply_turn == 0  # the run as a whole
    assert (found[2, 1].reply_conv, found[2, 1].reply_turn) == (2, 0)
