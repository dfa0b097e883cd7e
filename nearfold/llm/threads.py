"""Conversations put in reply order with the quotations linked and taken out.

A line that begins with quotation marks `>` is quoted, as deep as it has marks. Lines of one depth in
a row are a passage. Passages and their lines are normalised (small letters, single spaces) and
hashed; the hashes are joined to the messages of the conversation that first said the same in their
own, unquoted words: the whole message, one of its passages, or one line. All of it is expressions,
joins and sums of DataFrames.

Skew: what a conversation says again and again meets its quotations as one row per hash, the first
message that says it. Messages are numbered by the counts of ranges of turns and then within them,
and conversations are written in parts of `PART` messages, so no task holds a long conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nearfold.session import freeze

PART = 64
TURNS = 1024
_PREFIX = "^((?:> ?)+)"


def _normal(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), "[ \t\r\f\n]+", " "))


def _parsed(messages: DataFrame) -> DataFrame:
    """Adds `content` (own lines) and `passages` of `depth, whole, lines`, all from one split."""
    line = F.transform(
        F.split(F.coalesce("text", F.lit("")), "\n"),
        lambda x: F.struct(
            F.length(F.regexp_replace(F.regexp_extract(x, _PREFIX, 1), "[^>]", "")).alias("depth"),
            F.regexp_replace(x, _PREFIX, "").alias("body"),
        ),
    )
    depth = F.col("lines.depth")
    rows = messages.withColumn("lines", line).withColumn("depths", depth)
    # Places where a passage begins, and one past the end.
    begins = F.filter(
        F.sequence(F.lit(1), F.size("depths")),
        lambda i: (i == 1) | (F.element_at("depths", i) != F.get("depths", i - 2)),
    )
    rows = rows.withColumn("begins", begins).withColumn(
        "stops", F.concat(F.slice("begins", F.lit(2), F.size("begins")), F.array(F.size("depths") + 1))
    )
    passages = F.transform(
        F.arrays_zip("begins", "stops"),
        lambda p: F.struct(
            F.element_at("depths", p["begins"]).alias("depth"),
            F.transform(F.slice("lines", p["begins"], p["stops"] - p["begins"]), lambda x: x["body"]).alias("lines"),
        ),
    )
    own = F.filter("lines", lambda x: x["depth"] == 0)
    content = F.array_join(F.transform(own, lambda x: x["body"]), "\n")
    return rows.withColumn("passages", passages).withColumn(
        "content", F.regexp_replace(content, "^[ \t\r\n]+|[ \t\r\n]+$", "")
    ).drop("lines", "depths", "begins", "stops")


def _units(parsed: DataFrame) -> DataFrame:
    """`conv_id, turn, depth, rank, hash`: passages (rank 1) and lines (rank 0) that are not blank."""
    passage = F.explode("passages").alias("p")
    one = parsed.select("conv_id", "turn", passage).select(
        "conv_id", "turn", F.col("p.depth").alias("depth"),
        F.array_append(
            F.transform("p.lines", lambda x: F.struct(F.lit(0).alias("rank"), _normal(x).alias("said"))),
            F.struct(F.lit(1).alias("rank"), _normal(F.array_join("p.lines", "\n")).alias("said")),
        ).alias("said"),
    )
    whole = parsed.select(
        "conv_id", "turn", F.lit(0).alias("depth"), F.lit(1).alias("rank"), _normal(F.col("content")).alias("said")
    )
    found = one.select("conv_id", "turn", "depth", F.explode("said").alias("s")).select(
        "conv_id", "turn", "depth", "s.rank", "s.said"
    )
    found = found.unionByName(whole).filter("said <> '' and turn is not null")
    return found.select("conv_id", "turn", "depth", "rank", F.sha2("said", 256).alias("hash"))


def _same_conversation(left: DataFrame, right: DataFrame) -> Column:
    return left["conv_id"].eqNullSafe(right["c"])


def link_quotes(conversations: DataFrame) -> DataFrame:
    """One row per distinct message: `conv_id, turn, role, content, n_quotes, n_links, reply_to`.

    `n_quotes` counts quoted passages, `n_links` the earlier messages that they are from. `reply_to` is the turn that the message answers: of the linked messages the
    latest of those quoted least deep and in whole passages, else the turn just before, else null.
    Null text is empty; a null role is kept; messages without a turn link with nothing; a null
    conversation id is a conversation of its own. Other columns are not read.
    """
    messages = conversations.select("conv_id", "turn", "role", "text").distinct()
    parsed = _parsed(messages)
    units = _units(parsed)
    said = units.filter("depth = 0").groupBy(F.col("conv_id").alias("c"), F.col("hash").alias("h"))
    said = said.agg(F.min("turn").alias("first_turn"))
    quoted = units.filter("depth > 0").distinct()
    met = quoted.join(
        said, _same_conversation(quoted, said) & (quoted["hash"] == said["h"]) & (said["first_turn"] < quoted["turn"])
    )
    best = F.max(F.struct((-F.col("depth")).alias("d"), "rank", "first_turn"))["first_turn"]
    links = met.groupBy(F.col("conv_id").alias("c"), F.col("turn").alias("t")).agg(
        F.countDistinct("first_turn").alias("n_links"), best.alias("linked")
    )
    turns = messages.filter("turn is not null").select(
        F.col("conv_id").alias("c"), (F.col("turn") + 1).alias("t"), F.col("turn").alias("before")
    ).distinct()
    rows = parsed.select(
        "conv_id", "turn", "role", "content",
        F.size(F.filter("passages", lambda p: p["depth"] > 0)).alias("n_quotes"),
    )
    for side in (links, turns):
        rows = rows.join(side, _same_conversation(rows, side) & (rows["turn"] == side["t"]), "left").drop("c", "t")
    return rows.select(
        "conv_id", "turn", "role", "content", "n_quotes",
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("linked", "before").alias("reply_to"),
    )


def format_chats(conversations: DataFrame, part: int = PART) -> DataFrame:
    """`conv_id, part, n_messages, n_links, replies, chat`: conversations in parts of `part` messages.

    A message is `<|role|>`, a line feed, its content without quotations, and a line feed. Messages
    stand in order of their turn, which is a reply order because a message only answers earlier ones;
    messages of one turn follow by role and content, those without a turn come first. `replies` lists
    the answered turns in the same order, `-` where there is none. See `link_quotes` for the rest.
    """
    linked = freeze(link_quotes(conversations), "linked-messages")
    rows = linked.withColumn("range", F.floor(F.col("turn") / TURNS))
    sums = rows.groupBy("conv_id", "range").agg(F.count("*").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select(
        F.col("conv_id").alias("c"), F.col("range").alias("r"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")
    )
    inside = Window.partitionBy("conv_id", "range").orderBy("turn", "role", "content", "reply_to")
    rows = rows.withColumn("nth", F.row_number().over(inside) - 1)
    rows = rows.join(bases, _same_conversation(rows, bases) & rows["range"].eqNullSafe(bases["r"]))
    place = F.col("base") + F.col("nth")
    message = F.concat(F.lit("<|"), F.coalesce("role", F.lit("unknown")), F.lit("|>\n"), "content", F.lit("\n"))
    rows = rows.select(
        "conv_id", F.floor(place / part).alias("part"), "n_links",
        F.struct(place.alias("place"), message.alias("message"), F.coalesce(F.col("reply_to").cast("string"), F.lit("-")).alias("reply")).alias("m"),
    )
    parts = rows.groupBy("conv_id", "part").agg(
        F.count("*").alias("n_messages"), F.sum("n_links").alias("n_links"), F.array_sort(F.collect_list("m")).alias("m")
    )
    return parts.select(
        "conv_id", "part", "n_messages", "n_links",
        F.array_join("m.reply", ",").alias("replies"), F.array_join("m.message", "").alias("chat"),
    )
