"""Chat formatting by quotation linking.

Lines of a message that begin with ``>`` are quoted, one level for each mark.  Passages are runs of lines of one level
without blank lines between them; they are re-flowed (lower case, white space collapsed, so that other line breaks
change nothing) and hashed, and so are single lines of ``LEAST_WORDS`` words or more inside them, for quotes that leave
something out.  A quoted passage belongs to the message of the same conversation that said it itself first, if that
stands before the quoting one; a hash that agrees is confirmed by a SHA-256 of the whole passage, so that texts are not
shuffled.  A message replies to the latest of the
messages that its outermost linked quotes belong to, by whole passages where there are such; replies of replies form
threads, each named by its first message.  Quoted lines, and the line before a quote that only says who wrote it, are
left out of the body.

Messages stay rows.  ``position`` is a message's place in its thread, in the order of turns, in which every reply comes
after what it replies to; written in the order of (conversation, thread_root, position), the ``chat`` cells of a thread
make up its conversation.  No task holds a conversation: originals are grouped minima by (conversation, hash), roots
are found by doubling jumps, and positions are running sums over blocks of turns and inside these.

All of it is Spark SQL expressions.  Rows: a null text is an empty message; a very long text is one row like any other,
in time that grows with its lines; messages with a null conversation or turn link to nothing and have no position;
messages that share conversation and turn are formatted each, reply to the same message and share their position
(ties); an empty table gives no rows; extra columns, also of the names used here, are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from strandline.llm._tables import let, stored

#: Marks at the start of a quoted line.
MARKS = r"^[ \t]*(?:>[ \t]*)+"
#: A line that only says who wrote what follows.
ATTRIBUTION = r"^.*\bwrote:[ \t]*$"


#: Words from which a line inside a passage is hashed on its own.
LEAST_WORDS = 5
#: Turns in a block of positions.
BLOCK_TURNS = 4096
SPACES = r"[ \t\n\x0B\f\r]+"
#: Control characters that part passages, and their level from their text, in a joined message.
PART, OF_LEVEL = "\x01", "\x02"


def parsed_lines(text: Column) -> Column:
    """The lines of a text: level and said (without marks)."""

    def line(raw: Column) -> Column:
        return let(
            F.regexp_extract(raw, MARKS, 0),
            lambda marks: F.struct(F.length(F.regexp_replace(marks, "[^>]", "")).alias("level"), F.substring(raw, F.length(marks) + 1, F.length(raw)).alias("said")),
        )

    return F.transform(F.split(F.regexp_replace(F.coalesce(text, F.lit("")), r"\r\n?", "\n"), "\n"), line)


def flowed(said: Column) -> Column:
    return F.lower(F.btrim(F.regexp_replace(said, SPACES, " ")))


def _attributes(lines: Column) -> Column:
    """For each line whether it only says who wrote the quote behind it."""
    return F.zip_with(lines, F.slice(lines, 2, F.size(lines)), lambda a, b: (a["level"] == 0) & F.coalesce(b["level"] > 0, F.lit(False)) & a["said"].rlike(ATTRIBUTION))


def passages(lines: Column) -> Column:
    """The re-flowed passages of a message, and the long lines in them: level, whole (or a line) and norm; each once."""

    def parts(flagged: Column) -> Column:
        def said(line: Column) -> Column:
            return F.translate(line["line"]["said"], PART + OF_LEVEL, "  ")

        def piece(line: Column, before: Column) -> Column:
            blank = (F.btrim(said(line), F.lit(" \t\n\x0b\f\r")) == "") | line["attributes"]
            goes_on = (before["line"]["level"] == line["line"]["level"]) & (F.btrim(said(before), F.lit(" \t\n\x0b\f\r")) != "") & ~before["attributes"]
            lead = F.when(F.coalesce(goes_on, F.lit(False)), " ").otherwise(F.concat(F.lit(PART), line["line"]["level"].cast("string"), F.lit(OF_LEVEL)))
            return F.when(blank, PART).otherwise(F.concat(lead, said(line)))

        shifted = F.concat(F.array(F.lit(None).cast("struct<line:struct<level:int,said:string>,attributes:boolean>")), F.slice(flagged, 1, F.greatest(F.size(flagged) - 1, F.lit(0))))
        joined = F.array_join(F.zip_with(flagged, shifted, piece), "")
        level = lambda x: F.substring_index(x, OF_LEVEL, 1).cast("int")
        whole = F.transform(
            F.filter(F.split(joined, PART), lambda x: x.contains(OF_LEVEL)),
            lambda x: F.struct(level(x).alias("level"), F.lit(True).alias("whole"), flowed(F.substring_index(x, OF_LEVEL, -1)).alias("norm")),
        )
        single = F.transform(F.filter(flagged, lambda x: ~x["attributes"]), lambda x: F.struct(x["line"]["level"].alias("level"), F.lit(False).alias("whole"), flowed(said(x)).alias("norm")))
        single = F.filter(single, lambda x: F.size(F.split(x["norm"], " ")) >= LEAST_WORDS)
        return F.array_distinct(F.concat(whole, single))

    return let(F.zip_with(lines, _attributes(lines), lambda x, a: F.struct(x.alias("line"), a.alias("attributes"))), parts)


def own_body(lines: Column) -> Column:
    """What a message says itself: no quoted lines, no attributions before them, no blank edges."""
    own = F.zip_with(lines, _attributes(lines), lambda x, a: F.when((x["level"] == 0) & ~a, x["said"]))
    return F.btrim(F.array_join(F.filter(own, lambda x: x.isNotNull()), "\n"), F.lit(" \t\n"))


def parsed(df: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv, turn, role, lines, body of every message."""
    rows = df.select(df[conv].alias("conv"), df[turn].alias("turn"), df[role].alias("role"), let(parsed_lines(df[text]), lambda x: F.struct(x.alias("lines"), own_body(x).alias("body"))).alias("m"))
    return rows.select("conv", "turn", "role", "m.lines", "m.body")


def reply_links(messages: DataFrame) -> DataFrame:
    """conv, turn, parent of every message that quotes an earlier one; one row for a (conv, turn)."""
    found = messages.select("conv", "turn", F.explode(passages(F.col("lines"))).alias("p"))
    found = stored(found.select("conv", "turn", "p.level", "p.whole", F.xxhash64("p.norm").alias("hash"), F.unhex(F.sha2("p.norm", 256)).alias("digest")))
    quoted = found.where("level > 0").distinct()
    said = found.where("level = 0").groupBy("conv", "hash", "digest").agg(F.min("turn").alias("origin"))
    linked = quoted.join(said, ["conv", "hash", "digest"]).where("origin < turn")
    return linked.groupBy("conv", "turn").agg(F.max(F.struct((-F.col("level")).alias("nearness"), "whole", "origin"))["origin"].alias("parent"))


def thread_roots(links: DataFrame) -> DataFrame:
    """conv, turn, parent, root and depth (replies from the root) of every row of ``links``."""
    reached = stored(links.select("conv", "turn", "parent", F.col("parent").alias("root"), F.lit(1).cast("bigint").alias("depth")))
    while True:
        further = reached.select("conv", F.col("turn").alias("root"), F.col("root").alias("next_root"), F.col("depth").alias("more"))
        jumped = reached.join(further, ["conv", "root"], "left")
        jumped = jumped.select("conv", "turn", "parent", F.coalesce("next_root", "root").alias("root"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"), F.col("more").isNotNull().alias("moved"))
        jumped = stored(jumped)
        reached = jumped.drop("moved")
        if jumped.where("moved").isEmpty():
            return reached


def positions(threads: DataFrame) -> DataFrame:
    """conv, turn and position from conv, turn and root of every message."""
    turns = threads.where("conv IS NOT NULL AND turn IS NOT NULL").groupBy("conv", "root", "turn").agg(F.count(F.lit(1)).alias("n"))
    turns = stored(turns.withColumn("block", F.floor(F.col("turn") / BLOCK_TURNS)))
    blocks = turns.groupBy("conv", "root", "block").agg(F.sum("n").alias("n"))
    before = Window.partitionBy("conv", "root").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("conv", "root", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("conv", "root", "block").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    placed = turns.withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(blocks, ["conv", "root", "block"])
    return placed.select("conv", "turn", (F.col("before") + F.col("inside") + 1).alias("position"))


def link_quotations(df: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Each message without its quotes, with the message it replies to (parent_turn), its thread, and its depth and position there.

    Columns: ``conv``, ``turn``, role, body, chat (the body in its role's frame), n_quoted, quote_levels, parent_turn,
    thread_root, depth, position.
    """
    messages = parsed(df, conv=conv, turn=turn, role=role, text=text)
    links = stored(reply_links(messages))
    out = messages.select(
        "conv", "turn", "role", "body",
        F.concat(F.lit("<|"), F.coalesce("role", F.lit("unknown")), F.lit("|>\n"), F.col("body"), F.lit("\n<|end|>\n")).alias("chat"),
        F.size(F.filter("lines", lambda x: x["level"] > 0)).cast("bigint").alias("n_quoted"),
        F.array_max(F.transform("lines", lambda x: x["level"])).cast("bigint").alias("quote_levels"),
    )
    roots = stored(thread_roots(links)) if not links.isEmpty() else links.withColumns({"root": F.col("turn"), "depth": F.lit(0).cast("bigint")})
    heads = df.select(df[conv].alias("conv"), df[turn].alias("turn")).join(roots.select("conv", "turn", "root"), ["conv", "turn"], "left")
    placed = positions(heads.withColumn("root", F.coalesce("root", "turn")))
    out = out.join(roots, ["conv", "turn"], "left").join(placed, ["conv", "turn"], "left")
    return out.select(
        F.col("conv").alias(conv), F.col("turn").alias(turn), "role", "body", "chat", "n_quoted", "quote_levels",
        F.col("parent").alias("parent_turn"), F.coalesce("root", "turn").alias("thread_root"), F.coalesce("depth", F.lit(0).cast("bigint")).alias("depth"), "position",
    )


def quoting_replies(df: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv, turn, role, text of every message of ``df`` as a mail program would send it: behind the two turns before it.

    A table of plain turns has no quotes.  Here each message says who wrote the one before, quotes it with ``>`` and the one before
    that with ``>>``, both broken into a line a sentence, and then says what it said.
    """
    rows = df.select(df[conv].alias("conv"), df[turn].alias("turn"), df[role].alias("role"), df[text].alias("own"))

    def quote(name: str, marks: str) -> Column:
        lines = F.replace(F.btrim(F.regexp_replace(name, SPACES, " ")), F.lit(". "), F.lit(".\n"))
        return F.concat(F.lit(marks), F.replace(lines, F.lit("\n"), F.lit(f"\n{marks}")), F.lit("\n"))

    for k in (1, 2):
        earlier = rows.groupBy("conv", "turn").agg(F.min("own").alias(f"own{k}"), F.min("role").alias(f"role{k}")).withColumn("turn", F.col("turn") + k)
        rows = rows.join(earlier, ["conv", "turn"], "left")
    whole = F.concat(F.coalesce("role1", F.lit("someone")), F.lit(" wrote:\n"), F.coalesce(quote("own2", ">> "), F.lit("")), quote("own1", "> "), F.lit("\n"), F.coalesce("own", F.lit("")))
    return rows.select(F.col("conv").alias(conv), F.col("turn").alias(turn), F.col("role").alias(role), F.when(F.col("own1").isNull(), F.col("own")).otherwise(whole).alias(text))
