"""Chat formatting by quotation linking, in DataFrame functions only.

A message's lines have a quote level: the ``>`` marks they begin with.  Lines of level 0 are what the
message itself says; the lines of another level are its quoted passages (a gap between lines ends a
passage).  Passages are normalised, so line breaks do not matter, and hashed whole, by paragraph, by
sentence and by line; messages' own words likewise.  The hashes are joined to the message of the same
conversation that said them first; the message from which most words of the outermost level come is
the one a message replies to.  A message without linked quotes replies to the message before it,
whatever numbers turns have.  Replies are followed to their thread's first message by pointer doubling.

A thread is dealt into branches: the first reply to a message continues its branch, every further reply
begins one.  A branch is a conversation in reply order, so replies of siblings do not interleave;
:func:`conversations` writes them out without quotes, long ones in parts.

What is said often in a conversation is one row of the index (its first message), so there are no pairs
of messages in any join.

Defined results: null or empty text gives an empty message; rows with a null conversation or turn
reply to nothing and are conversations of their own; rows with the same conversation and turn stay and
count as one message for links; turns may have gaps; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm.common import materialize, text_or_empty

_MARKS = r"^[ \t]*+(>[> \t]*+)"
_BLANK = " \t\n\r\x0b\x0c"
#: Turns of one window when the message before is looked up, and messages of one part of a conversation.
TURNS, PART = 1024, 256


def quote_level(line: Column) -> Column:
    return F.length(F.regexp_replace(F.regexp_extract(line, _MARKS, 1), "[^>]", ""))


def body(line: Column) -> Column:
    return F.regexp_replace(line, _MARKS, "")


def normalised(line: Column) -> Column:
    """Letters and digits only, lower case, single spaces."""
    return F.trim(F.regexp_replace(F.lower(line), r"[^\p{L}\p{N}]+", " "))


def own_text(text: Column) -> Column:
    """The message without quoted lines."""
    lines = F.filter(F.split(text, "\n"), lambda x: quote_level(x) == 0)
    return F.trim(F.array_join(lines, "\n"), F.lit(_BLANK))


def _units(passages: Column) -> Column:
    """What can be quoted of a text: all of it, its paragraphs, sentences and lines, normalised."""
    cut = lambda p: F.transform(F.split(passages, p), normalised)
    return F.array_distinct(F.filter(F.concat(F.array(normalised(passages)), cut(r"\n[ \t]*+\n"), cut(r"[.!?]++\s++"), cut(r"\n")), lambda x: x != ""))


def _links(msgs: DataFrame) -> DataFrame:
    """(conv_id, turn, quoted_turn, quotes, linked) of messages that quote: quoted passages by level, and those that were found."""
    one = msgs.where("conv_id IS NOT NULL AND turn IS NOT NULL").select("conv_id", "turn", "text").distinct()
    line = one.select("conv_id", "turn", F.xxhash64("text").alias("key"), F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    line = line.select("conv_id", "turn", "key", "pos", quote_level(F.col("line")).alias("level"), body(F.col("line")).alias("line"))
    text = line.groupBy("conv_id", "turn", "key", "level").agg(F.array_sort(F.collect_list(F.struct("pos", "line"))).alias("lines"))  # one message's lines
    joined = F.array_join(F.transform("lines", lambda x, i: F.when((i > 0) & (x["pos"] > F.col("lines")[F.greatest(i - 1, F.lit(0))]["pos"] + 1), F.concat(F.lit("\n"), x["line"])).otherwise(x["line"])), "\n")
    unit = text.select("conv_id", "turn", "key", "level", F.explode(_units(joined)).alias("u"))
    unit = unit.select("conv_id", "turn", "key", "level", F.xxhash64("u").alias("h"), F.size(F.split("u", " ")).alias("words"))
    said = unit.where("level = 0").groupBy("conv_id", "h").agg(F.min("turn").alias("first"))
    quoted = unit.where("level > 0")
    hit = quoted.join(said, ["conv_id", "h"], "left").withColumn("first", F.when(F.col("first") < F.col("turn"), F.col("first")))
    per = hit.groupBy("conv_id", "turn", "key", "level", "first").agg(F.sum("words").alias("k"))
    level = per.groupBy("conv_id", "turn", "key", "level").agg(F.max(F.when(F.col("first").isNotNull(), F.struct("k", "first"))).alias("best"))
    score = F.when(F.col("best").isNotNull(), F.struct((-F.col("level")).alias("level"), F.col("best.k").alias("k"), F.col("best.first").alias("first")))
    return level.groupBy("conv_id", "turn").agg(F.max(score)["first"].alias("quoted_turn"), F.count(F.lit(1)).alias("quotes"), F.count("best").alias("linked"))


def _with_before(nodes: DataFrame) -> DataFrame:
    """``nodes`` (conv_id, turn) with ``turn_before``: windows run inside spans of turns, a span's first looks at the last of the span before."""
    at = nodes.withColumn("span", F.floor(F.col("turn") / TURNS))
    last = at.groupBy("conv_id", "span").agg(F.max("turn").alias("last"))
    carry = last.select("conv_id", "span", F.lag("last").over(Window.partitionBy("conv_id").orderBy("span")).alias("carry"))
    own = F.lag("turn").over(Window.partitionBy("conv_id", "span").orderBy("turn"))
    return at.withColumn("own", own).join(carry, ["conv_id", "span"]).select("conv_id", "turn", F.coalesce("own", "carry").alias("turn_before"))


def _followed(tree: DataFrame, up: Column, end: str, steps: str) -> DataFrame:
    """(conv_id, turn, ``end``, ``steps``): where following ``up`` (null: stay) leads, by pointer doubling."""
    jump = materialize(tree.select("conv_id", "turn", F.coalesce(up, "turn").alias("up"), F.when(up.isNull(), 0).otherwise(1).cast("long").alias("steps")), "chat-jump")
    while True:
        over = jump.select("conv_id", F.col("turn").alias("up"), F.col("up").alias("up2"), F.col("steps").alias("more"))
        both = materialize(jump.join(over, ["conv_id", "up"]).select("conv_id", "turn", F.col("up2").alias("up"), (F.col("steps") + F.col("more")).alias("steps"), (F.col("more") > 0).alias("moved")), "chat-jump")
        jump = both.drop("moved")
        if both.where("moved").isEmpty():
            return jump.select("conv_id", "turn", F.col("up").alias(end), F.col("steps").alias(steps))


def format_chats(messages: DataFrame, template: str = "<|{role}|>\n{text}\n") -> DataFrame:
    """One row per message: ``conv_id, turn, role, parent_turn, root_turn, depth, branch_turn, position, quotes, linked, text, formatted``.

    Ordered by (conv_id, root_turn, branch_turn, position) the rows of a conversation are its branches,
    each in reply order; ``branch_turn`` is a branch's first message, ``position`` counts from it.
    """
    msgs = messages.select("conv_id", "turn", F.col("role").cast("string").alias("role"), text_or_empty("text").alias("text"))
    nodes = msgs.where("conv_id IS NOT NULL AND turn IS NOT NULL").select("conv_id", "turn").distinct()
    tree = _with_before(nodes).join(_links(msgs), ["conv_id", "turn"], "left")
    tree = tree.select("conv_id", "turn", F.coalesce("quoted_turn", "turn_before").alias("parent_turn"), F.coalesce("quotes", F.lit(0)).alias("quotes"), F.coalesce("linked", F.lit(0)).alias("linked"))
    tree = materialize(tree, "chat-tree")
    heirs = tree.where("parent_turn IS NOT NULL").groupBy("conv_id", "parent_turn").agg(F.min("turn").alias("turn")).select("conv_id", "turn", F.col("parent_turn").alias("branch_up"))
    branch = _followed(tree.join(heirs, ["conv_id", "turn"], "left"), F.col("branch_up"), "branch_turn", "position")
    tree = tree.join(_followed(tree, F.col("parent_turn"), "root_turn", "depth"), ["conv_id", "turn"]).join(branch, ["conv_id", "turn"])
    out = msgs.join(tree, ["conv_id", "turn"], "left").select("conv_id", "turn", "role", "parent_turn", "root_turn", "depth", "branch_turn", "position", "quotes", "linked", own_text(F.col("text")).alias("text"))
    head, _, tail = template.partition("{role}")
    mid, _, end = tail.partition("{text}")
    return out.withColumn("formatted", F.concat(F.lit(head), F.coalesce("role", F.lit("user")), F.lit(mid), "text", F.lit(end)))


def conversations(formatted: DataFrame, part: int = PART) -> DataFrame:
    """Conversations of :func:`format_chats`' rows: ``conv_id, root_turn, branch_turn, part, parent_turn, turns, text``.

    A branch is one row for each ``part`` messages, so no row holds an unbounded branch; ``parent_turn``
    is what its first message replies to.  Rows without a conversation or turn are rows of their own.
    """
    placed = formatted.where("branch_turn IS NOT NULL").withColumn("part", F.floor(F.col("position") / part))
    g = placed.groupBy("conv_id", "root_turn", "branch_turn", "part").agg(F.array_sort(F.collect_list(F.struct("position", "turn", "formatted", "parent_turn"))).alias("m"))
    g = g.select("conv_id", "root_turn", "branch_turn", "part", F.col("m")[0]["parent_turn"].alias("parent_turn"), F.transform("m", lambda x: x["turn"]).alias("turns"), F.array_join(F.transform("m", lambda x: x["formatted"]), "").alias("text"))
    alone = formatted.where("branch_turn IS NULL")
    none = F.lit(None).cast(dict(formatted.dtypes)["turn"])
    return g.unionByName(alone.select("conv_id", *[none.alias(c) for c in ("root_turn", "branch_turn")], F.lit(0).cast("long").alias("part"), none.alias("parent_turn"), F.array("turn").alias("turns"), F.col("formatted").alias("text")))
