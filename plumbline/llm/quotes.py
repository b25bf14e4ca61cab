"""Quotation linking: whom a message quotes, and conversations in reply order without quotes. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import table, written

MARK = r"^((?:[ \t]*>)+)"


def normal(text: Column) -> Column:
    return F.trim(F.lower(F.regexp_replace(text, r"\s+", " ")))


def digest(text: Column) -> Column:
    return F.sha2(normal(text), 256)


def with_passages(df: DataFrame, text: Column, when: Column, name: str = "__parts") -> DataFrame:
    """Adds array<struct<level, body>>, null unless `when`: runs of lines with the same number of leading quote marks, marks
    removed, in order. Levels and bodies are columns of their own, so that each line is read once however long the text."""
    level = lambda x: F.length(F.regexp_replace(F.regexp_extract(x, MARK, 1), "[^>]", ""))
    df = df.withColumn("__lines", F.when(when, F.split(text, "\r?\n", -1)))
    df = df.withColumn("__levels", F.transform("__lines", level)).withColumn("__bodies", F.transform("__lines", lambda x: F.regexp_replace(x, MARK + " ?", "")))
    every = F.sequence(F.lit(0), F.size("__levels") - 1)
    df = df.withColumn("__starts", F.when(when, F.filter(every, lambda i: (i == 0) | (F.get("__levels", i) != F.get("__levels", i - 1)))))
    part = lambda s, k: F.struct(
        F.get("__levels", s).alias("level"),
        F.array_join(F.slice("__bodies", s + 1, F.coalesce(F.get("__starts", k + 1), F.size("__levels")) - s), "\n").alias("body"),
    )
    return df.withColumn(name, F.transform("__starts", part)).drop("__lines", "__levels", "__bodies", "__starts")


def own_text(parts: Column) -> Column:
    return F.array_join(F.transform(F.filter(parts, lambda p: p["level"] == 0), lambda p: p["body"]), "\n")


def parsed(messages: DataFrame) -> DataFrame:
    """messages(conv_id, turn, text) with own_text and quotes (array<struct<level, body, digest>>). Null texts are empty."""
    text = F.coalesce(F.col("text"), F.lit(""))
    quoted = text.rlike(r"(?m)^[ \t]*>")
    out = with_passages(messages, text, quoted)
    quotes = F.transform(F.filter("__parts", lambda p: (p["level"] > 0) & (normal(p["body"]) != "")), lambda p: F.struct(p["level"].alias("level"), p["body"].alias("body"), digest(p["body"]).alias("digest")))
    return out.withColumn("own_text", F.when(quoted, own_text(F.col("__parts"))).otherwise(text)).withColumn("quotes", quotes).drop("__parts")


def links(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, level, digest, original_conv_id, original_turn): one row per distinct quoted passage of a message.

    The original is the earliest message of the conversation whose own text, or one paragraph of it, is the passage but
    for case and blanks, if it is earlier than the quoting message; otherwise the least (conv_id, turn) with it anywhere
    else; null if there is none. Both come from one least row per digest, so a passage that a third of all
    messages hold makes no more rows than there are quotes.
    """
    return _links(parsed(messages.select("conv_id", "turn", "text")))


def _links(p: DataFrame) -> DataFrame:
    quotes = p.select("conv_id", "turn", F.explode("quotes").alias("q")).select("conv_id", "turn", "q.level", "q.digest").distinct()
    paragraphs = F.array_union(F.array(F.col("own_text")), F.split("own_text", "\n"))
    units = p.select("conv_id", "turn", F.explode(paragraphs).alias("u")).filter(normal(F.col("u")) != "").select("conv_id", "turn", digest(F.col("u")).alias("digest"))
    units = units.filter("conv_id is not null and turn is not null")
    inside = units.groupBy("conv_id", "digest").agg(F.min("turn").alias("first_turn"))
    local = quotes.join(inside, ["conv_id", "digest"], "left").withColumn("first_turn", F.when(F.col("first_turn") < F.col("turn"), F.col("first_turn")))
    anywhere = inside.groupBy("digest").agg(F.min(F.struct("conv_id", "first_turn")).alias("o"))
    far = local.filter("first_turn is null").drop("first_turn").join(anywhere, "digest", "left")
    far = far.withColumn("o", F.when(F.col("o.conv_id") != F.col("conv_id"), F.col("o")))
    near = local.filter("first_turn is not null").select("conv_id", "turn", "level", "digest", F.col("conv_id").alias("original_conv_id"), F.col("first_turn").alias("original_turn"))
    return near.unionByName(far.select("conv_id", "turn", "level", "digest", F.col("o.conv_id").alias("original_conv_id"), F.col("o.first_turn").alias("original_turn")))


def reply_order(tree: DataFrame) -> DataFrame:
    """tree(conv_id, turn, parent_turn) -> the same with depth and root_turn, by doubling the way to an ancestor.

    A round is written to the shared folder; as many rounds as the logarithm of the deepest reply. parent_turn must be
    less than turn, so there are no cycles.
    """
    now = written(tree.select("conv_id", "turn", F.col("parent_turn").alias("up"), F.when(F.col("parent_turn").isNull(), 0).otherwise(1).alias("depth"), F.coalesce("parent_turn", "turn").alias("root_turn")), "replies")
    while now.filter("up is not null").limit(1).count():
        over = now.select("conv_id", F.col("turn").alias("up"), F.col("up").alias("next"), F.col("depth").alias("more"), F.col("root_turn").alias("top"))
        climbing = now.filter("up is not null").join(over, ["conv_id", "up"], "left").select(
            "conv_id", "turn", F.col("next").alias("up"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"), F.coalesce("top", "root_turn").alias("root_turn")
        )
        now = written(now.filter("up is null").unionByName(climbing), "replies")  # messages that have reached their root rest
    return tree.join(now.select("conv_id", "turn", "depth", "root_turn"), ["conv_id", "turn"])


def reply_ordered(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, role, own_text, n_quotes, parent_turn, depth, root_turn): one row per message, quotes removed.

    The parent is the latest original of the message's first-level quotes inside the conversation. The order of a conversation
    is (root_turn, depth, turn). Messages that quote nothing known are roots; so are rows with a null conv_id or turn.
    Rows that repeat a conv_id and turn share the latest parent of any of them. Extra columns are not read.
    """
    m = written(parsed(messages.select("conv_id", "turn", "role", "text")).drop("text"), "parsed")  # read four times below
    found = _links(m).filter("level = 1 and original_conv_id = conv_id").groupBy("conv_id", "turn").agg(F.max("original_turn").alias("parent_turn"))
    nodes = m.select("conv_id", "turn").filter("conv_id is not null and turn is not null").distinct()
    tree = written(nodes.join(found, ["conv_id", "turn"], "left"), "reply-tree")
    ordered = reply_order(tree)
    rows = m.select("conv_id", "turn", "role", "own_text", F.coalesce(F.size("quotes"), F.lit(0)).alias("n_quotes"))
    return rows.withColumn("n_quotes", F.greatest("n_quotes", F.lit(0))).join(ordered, ["conv_id", "turn"], "left").select(
        "conv_id", "turn", "role", "own_text", "n_quotes", "parent_turn", F.coalesce("depth", F.lit(0)).alias("depth"), F.coalesce("root_turn", "turn").alias("root_turn")
    )


def as_mail(conversations: DataFrame) -> DataFrame:
    """Conversations as a mail client would send them: below its own text, a turn quotes the turn before, and what that
    turn quoted of the one before it, a level deeper."""
    c = conversations.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    text = c.groupBy("conv_id", "turn").agg(F.min("text").alias("t"))
    mark = lambda col, by: F.regexp_replace(col, "(?m)^", by)
    for back in (1, 2):
        earlier = text.select("conv_id", (F.col("turn") + back).alias("turn"), F.col("t").alias(f"t{back}"))
        c = c.join(earlier, ["conv_id", "turn"], "left")
    return c.select("conv_id", "turn", "role", F.concat_ws("\n", "text", mark(F.col("t1"), "> "), mark(F.col("t2"), ">> ")).alias("text"))


def op9_quotation_links(spark, sf_dir: str) -> DataFrame:
    """All conversations, sent as mail and put back in reply order without quotes."""
    return reply_ordered(written(as_mail(table(spark, sf_dir, "conversations")), "mail"))


ORACLE = r"""
WITH c AS (SELECT conv_id, turn, role, text AS own_text, trim(lower(regexp_replace(text, '\s+', ' ', 'g'))) AS n FROM conversations),
q AS (SELECT a.*, CASE WHEN b.n <> '' THEN 1 ELSE 0 END + CASE WHEN d.n <> '' THEN 1 ELSE 0 END AS n_quotes,
  (SELECT min(e.turn) FROM c e WHERE e.conv_id = a.conv_id AND e.n = b.n AND e.n <> '') AS parent_turn
  FROM c a LEFT JOIN c b ON b.conv_id = a.conv_id AND b.turn = a.turn - 1 LEFT JOIN c d ON d.conv_id = a.conv_id AND d.turn = a.turn - 2),
r AS (WITH RECURSIVE up(conv_id, turn, node, depth) AS (SELECT conv_id, turn, turn, 0 FROM q UNION ALL
  SELECT u.conv_id, u.turn, p.parent_turn, u.depth + 1 FROM up u JOIN q p ON p.conv_id = u.conv_id AND p.turn = u.node WHERE p.parent_turn IS NOT NULL)
  SELECT conv_id, turn, max(depth) AS depth, min(node) AS root_turn FROM up GROUP BY conv_id, turn)
SELECT q.conv_id, q.turn, role, own_text, n_quotes, parent_turn, depth, root_turn FROM q JOIN r ON r.conv_id = q.conv_id AND r.turn = q.turn
"""
