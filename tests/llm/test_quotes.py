from plumbline.llm import quotes

SCHEMA = "conv_id long, turn long, role string, text string, depth string, quotes int"


def frame(spark, rows):
    return spark.createDataFrame([(c, t, "user", x, "d", 0) for c, t, x in rows], SCHEMA)


ROWS = [
    (1, 0, "First  message\nwith two lines"), (1, 1, "> first MESSAGE\n> with two lines\nAnswer one"), (1, 2, "Above\n> Answer one\n>> First message\n>> with two lines\nBelow"),
    (1, 3, ">with two lines\npart of it quoted"), (1, 4, "> nobody wrote this\nhm"), (1, 5, ">   \n no passage"), (2, 0, "Thanks"), (2, 1, "> Answer one\nfrom elsewhere"), (2, 2, "> Thanks\nLate"), (2, 3, "Thanks"),
    (3, 0, None), (3, 1, ""), (None, 4, "> Thanks\nno id"), (3, None, "> x"), (4, 0, "same"), (4, 0, "same"), (4, 1, "> same\nreply"), (4, 1, "> same\nreply"),
]


def test_reply_order(spark):
    got = {(r.conv_id, r.turn): r for r in quotes.reply_ordered(frame(spark, ROWS)).collect()}
    p = {k: (r.parent_turn, r.depth, r.root_turn) for k, r in got.items()}
    assert p[1, 1] == (0, 1, 0) and p[1, 2] == (1, 2, 0) and p[1, 3] == (0, 1, 0) and p[1, 4] == (None, 0, 4) and p[2, 1] == (None, 0, 1) and p[2, 2] == (0, 1, 0)
    assert got[1, 2].own_text == "Above\nBelow" and got[1, 2].n_quotes == 2 and got[1, 5].n_quotes == 0 and got[3, 0].own_text == ""
    assert len(quotes.reply_ordered(frame(spark, ROWS)).collect()) == len(ROWS)
    assert quotes.reply_ordered(frame(spark, ROWS).limit(0)).collect() == []


def test_links(spark):
    got = {(r.conv_id, r.turn, r.level): (r.original_conv_id, r.original_turn) for r in quotes.links(frame(spark, ROWS)).collect()}
    assert got[1, 2, 2] == (1, 0) and got[2, 1, 1] == (1, 1) and got[1, 4, 1] == (None, None) and got[None, 4, 1] in ((2, 0), (None, None))


def test_long_threads_and_hot_passages(spark):
    rows = [(7, 0, "m0")] + [(7, i, f"> m{i - 1}\nm{i}") for i in range(1, 200)] + [(100 + i, 0, "hello all") for i in range(300)] + [(100 + i, 1, "> hello all\nhi") for i in range(300)]
    got = {(r.conv_id, r.turn): r for r in quotes.reply_ordered(frame(spark, rows)).collect()}
    assert got[7, 199].depth == 199 and got[7, 199].root_turn == 0
    assert all(got[100 + i, 1].parent_turn == 0 for i in range(300))
    long = quotes.parsed(frame(spark, [(1, 0, "\n".join(f"{'>' * (i % 3)} line {i}" for i in range(20000)))])).collect()[0]
    assert len(long["quotes"]) == 13333
