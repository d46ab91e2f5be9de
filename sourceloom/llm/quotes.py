"""Chat formatting by quotation linking.

Lines that begin with > are quotes, nested as deep as they have >. Quoted passages are
normalised and hashed and joined to the message of the same conversation that said
them first. The replies form trees; conversations come out in reply order, without
quotes.

Reply order is a walk through each tree: entering and leaving every message makes one
linked list, and links that double their reach in each round number it. So a chain of d
replies takes d rows and log d rounds, however deep it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

#: Possessive throughout: matched in a loop, not by recursion, so that a line of any
#: number of > is read.
MARK = r"^[\x20\t]{0,3}+(?:>[\x20\t]?+)++"
#: A line that announces a quote.
ATTRIBUTION = r"(?:wrote|writes|said|schrieb|a écrit|escribió)[\x20\t]*+:[\x20\t]*\z"
#: White space of any kind.
SPACE = r"[\s\xA0]"
#: Between paragraphs.
GAP = r"\n[\s\xA0]*\n"
#: Siblings of so many turns are ordered at once.
TURNS = 4096


def normal(text: Column) -> Column:
    return F.trim(F.lower(F.regexp_replace(text, rf"{SPACE}++", " ")))


def parsed(text: Column) -> Column:
    """array<struct<level, body>> of the lines; level 0 is the writer's own."""
    lines = F.split(F.coalesce(text, F.lit("")), "\n", -1)
    mark = lambda x: F.regexp_extract(x, MARK, 0)
    return F.transform(lines, lambda x: F.struct((F.length(mark(x)) - F.length(F.translate(mark(x), ">", ""))).alias("level"), F.regexp_replace(x, MARK, "").alias("body")))


def _hashes(units: Column) -> Column:
    """Hashes of the units that aren't blank."""
    return F.transform(F.filter(F.transform(units, normal), lambda x: x != ""), lambda x: F.xxhash64(x))


def _ranked(hashes: Column, whole: int) -> Column:
    return F.transform(hashes, lambda h: F.struct(F.lit(whole).alias("whole"), h.alias("h")))


def _asked(quoting: DataFrame) -> DataFrame:
    """(conv_id, turn, level, whole, h): each passage (run of lines of one level), its
    paragraphs and its lines; whole is 2, 1 or 0. Worked out within the row."""
    starts = F.filter(
        F.transform("lines", lambda x, i: F.struct(i.alias("i"), x["level"].alias("level"), ((i == 0) | (F.get(F.col("lines"), i - 1)["level"] != x["level"])).alias("new"))),
        lambda x: x["new"],
    )
    marked = quoting.select("conv_id", "turn", "lines", starts.alias("starts"))
    end = lambda k: F.coalesce(F.get(F.col("starts"), k + 1)["i"], F.size("lines"))
    runs = F.transform("starts", lambda x, k: F.struct(x["level"].alias("level"), F.transform(F.slice("lines", x["i"] + 1, end(k) - x["i"]), lambda y: y["body"]).alias("bodies")))
    each = marked.select("conv_id", "turn", F.explode(F.filter(runs, lambda x: x["level"] > 0)).alias("run")).select("conv_id", "turn", "run.level", "run.bodies")
    said = each.withColumn("said", F.array_join("bodies", "\n"))
    parts = F.split("said", GAP, -1)
    units = (F.array("said"), F.when(F.size(parts) > 1, parts).otherwise(F.array().cast("array<string>")), F.col("bodies"))
    listed = F.concat(*[_ranked(_hashes(u), whole) for u, whole in zip(units, (2, 1, 0))])
    return said.select("conv_id", "turn", "level", F.explode(listed).alias("x")).select("conv_id", "turn", "level", "x.whole", "x.h")


def _parents(named: DataFrame) -> DataFrame:
    """(conv_id, turn, parent) of each message that quotes an earlier one."""
    asked = _asked(named.where("n_quoted > 0"))
    units = F.concat(F.array(F.col("text")), F.split("text", GAP, -1), F.split("text", "\n", -1))
    told = named.join(named.where("n_quoted > 0").select("conv_id").distinct(), "conv_id", "left_semi").select("conv_id", F.col("turn").alias("origin"), F.explode(F.array_distinct(_hashes(units))).alias("h"))
    first = told.groupBy("conv_id", "h").agg(F.min("origin").alias("origin"))
    votes = asked.join(cut(first), ["conv_id", "h"]).where("origin < turn").groupBy("conv_id", "turn", "origin").agg(F.min("level").alias("level"), F.max("whole").alias("whole"), F.count("*").alias("n"))
    # of several origins: the outermost level, then the wholest unit, the most units, the latest turn
    return cut(votes.groupBy("conv_id", "turn").agg(F.max_by("origin", F.struct(-F.col("level"), "whole", "n", "origin")).alias("parent")))


def _next_siblings(parents: DataFrame) -> DataFrame:
    """parents with sibling, the next turn that answers the same message. Ordered within
    spans of TURNS turns, then span by span, so that a message that everyone answers
    isn't one task's work."""
    spans = parents.withColumn("span", F.floor(F.col("turn") / TURNS))
    inside = Window.partitionBy("conv_id", "parent", "span").orderBy("turn")
    heads = spans.groupBy("conv_id", "parent", "span").agg(F.min("turn").alias("head"))
    after = heads.select("conv_id", "parent", "span", F.lead("head").over(Window.partitionBy("conv_id", "parent").orderBy("span")).alias("following"))
    return (
        spans.withColumn("sibling", F.lead("turn").over(inside)).join(after, ["conv_id", "parent", "span"])
        .select("conv_id", "turn", "parent", F.coalesce("sibling", "following").alias("sibling"))
    )


def _walked(parents: DataFrame) -> DataFrame:
    """(conv_id, turn, thread_root, depth, position) of all messages of the trees;
    position counts the messages before it in reply order."""
    placed = _next_siblings(parents)
    eldest = parents.groupBy("conv_id", "parent").agg(F.min("turn").alias("child")).select("conv_id", F.col("parent").alias("turn"), "child")
    members = parents.select("conv_id", "turn").union(parents.select("conv_id", F.col("parent").alias("turn"))).distinct()
    known = members.join(placed, ["conv_id", "turn"], "left").join(eldest, ["conv_id", "turn"], "left")
    step = lambda leaves, turn: F.struct(F.lit(leaves).alias("leaves"), turn.alias("turn"))
    c = F.col
    enter = F.struct(F.lit(False).alias("leaves"), F.when(c("child").isNotNull(), step(False, c("child"))).otherwise(step(True, c("turn"))).alias("next"), F.lit(1).cast("long").alias("n"), F.lit(1).cast("long").alias("d"))
    leave = F.struct(F.lit(True).alias("leaves"), F.when(c("sibling").isNotNull(), step(False, c("sibling"))).when(c("parent").isNotNull(), step(True, c("parent"))).alias("next"), F.lit(0).cast("long").alias("n"), F.lit(-1).cast("long").alias("d"))
    # n and d add up over the stretch from here to before next; root is where the list ends
    walk = cut(known.select("conv_id", "turn", F.explode(F.array(enter, leave)).alias("x")).select("conv_id", "turn", "x.*").withColumn("root", c("turn")))
    while walk.where("next is not null").limit(1).count():
        ahead = walk.select("conv_id", c("turn").alias("next_turn"), c("leaves").alias("next_leaves"), c("next").alias("next2"), c("n").alias("n2"), c("d").alias("d2"), c("root").alias("root2"))
        joined = (
            walk.withColumns({"next_turn": c("next.turn"), "next_leaves": c("next.leaves")}).where("next is not null").join(ahead, ["conv_id", "next_turn", "next_leaves"])
            .select("conv_id", "turn", "leaves", c("next2").alias("next"), (c("n") + c("n2")).alias("n"), (c("d") + c("d2")).alias("d"), c("root2").alias("root"))
        )
        walk = cut(joined.unionByName(walk.where("next is null")))
    entered = walk.where("not leaves")
    sizes = entered.where("turn = root").select("conv_id", "root", c("n").alias("size"))
    return cut(entered.join(sizes, ["conv_id", "root"]).select("conv_id", "turn", c("root").alias("thread_root"), (-c("d")).alias("depth"), (c("size") - c("n")).alias("position")))


def link_quotes(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, turn, role, text (without quotes), n_quoted (quoted lines),
    parent_turn (the message it answers, or null), thread_root, depth, position (the
    messages before it in its thread; a conversation in reply order is sorted by
    thread_root and position), formatted, of each row.

    The parent is the message of an earlier turn that first said what is quoted:
    outer levels count before inner ones, whole passages before paragraphs of them and
    those before single lines, more of these before fewer, later turns before earlier
    ones. However short, each is looked up among whole messages, paragraphs and lines,
    white space and case aside; a part of a line that is quoted alone finds none. Null
    texts are empty. Rows with a null conversation or turn quote no one and are quoted by
    no one; rows that repeat a turn share its links. Turns are any 64-bit numbers. Texts
    are read whole, whatever the length of a line or the depth of its marks. Other
    columns are not looked at. No rows give none.
    """
    rows = messages.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), F.col(role_col).cast("string").alias("role"), parsed(F.col(text_col).cast("string")).alias("lines"))
    next_level = lambda i: F.coalesce(F.get(F.col("lines"), i + 1)["level"], F.lit(0))
    kept = F.filter("lines", lambda x, i: (x["level"] == 0) & ~(F.regexp_like(x["body"], F.lit(ATTRIBUTION)) & (next_level(i) > 0)))
    clean = F.regexp_replace(F.array_join(F.transform(kept, lambda x: x["body"]), "\n"), r"^\n++|(?<!\n)\n++\z", "")
    n_quoted = F.size(F.filter("lines", lambda x: x["level"] > 0))
    plain = F.array_join(F.transform("lines", lambda x: x["body"]), "\n")
    base = rows.select("conv_id", "turn", "role", "lines", F.when(n_quoted > 0, clean).otherwise(plain).alias("text"), n_quoted.cast("long").alias("n_quoted"))
    parents = _parents(base.where("conv_id is not null and turn is not null"))
    walked = _walked(parents)
    side = walked.join(parents.withColumnRenamed("parent", "parent_turn"), ["conv_id", "turn"], "left")
    return (
        base.drop("lines").join(side, ["conv_id", "turn"], "left")
        .select(
            "conv_id", "turn", "role", "text", "n_quoted", "parent_turn", F.coalesce("thread_root", "turn").alias("thread_root"), F.coalesce("depth", F.lit(0)).cast("long").alias("depth"), F.coalesce("position", F.lit(0)).cast("long").alias("position"),
            F.concat(F.lit("<|"), F.coalesce("role", F.lit("user")), F.lit("|>\n"), "text", F.lit("\n")).alias("formatted"),
        )
    )
