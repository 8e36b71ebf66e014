"""Chat formatting by quotation linking."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from souk.llm.common import importable, materialise, query, row_struct, table, text_or_empty, unpack
from souk.operators.windows import prefix_scan

#: fixed value: the marks before a quoted line
QUOTE = r"^((?:[ \t]*>)+)"
BARE = re.compile(r"[ \t]*>[> \t]*\r?")
#: turns that one task orders together
BLOCK = 1024


def depth_of(line: Column) -> Column:
    """Quote level of a line: its leading ``>`` marks, spaces between allowed."""
    marks = F.regexp_extract(line, QUOTE, 1)
    return F.length(F.regexp_replace(marks, "[^>]", ""))


def _own(text: str, linked: list | None) -> str:
    """A message without its linked lines (by number) and, if it has any,
    the bare quote marks around them; without blank lines around it. Quoted
    lines whose origin is not in the conversation stay."""
    gone = set(linked or ())
    lines = [x for i, x in enumerate(text.split("\n")) if i not in gone and not (gone and BARE.fullmatch(x))]
    return "\n".join(lines).strip()


def message_lines(df: DataFrame) -> DataFrame:
    """``_c, _turn, _mark, line, depth, key``: the lines that say something. ``key``
    hashes the line without marks, in lower case, white space as one space."""
    d = df.select("_c", "_turn", F.xxhash64("_text").alias("_mark"), F.posexplode(F.split("_text", "\n")).alias("line", "_line"))
    said = F.trim(F.regexp_replace(F.lower(F.regexp_replace("_line", QUOTE, "")), r"\s+", " "))
    return d.select("_c", "_turn", "_mark", "line", depth_of(F.col("_line")).alias("depth"), said.alias("_said")).where("_said <> ''").select(
        "_c", "_turn", "_mark", "line", "depth", F.md5("_said").alias("key"))


def _keyed(df: DataFrame, conv_col: str, turn_col: str, text_col: str) -> DataFrame:
    return df.select(row_struct(df), F.struct(F.col(conv_col)).alias("_c"),
                     F.coalesce(F.col(turn_col).cast("long"), F.lit(-1)).alias("_turn"), text_or_empty(text_col).alias("_text"))


def linked_lines(keyed: DataFrame) -> DataFrame:
    """``_c, _turn, _mark, line, depth, origin``: the quoted lines that an
    earlier message of the conversation says.

    A quoted passage is hashed line by line, so that a part of a message
    still meets it. A line's original is the latest earlier message of the
    conversation that says it itself. That is an as-of scan over quoted and
    original lines of equal hash, in blocks of turns: every line is read
    once, and a line said in thousands of messages is not paired with them.
    """
    lines = message_lines(keyed)
    lines = (lines.withColumn("_own", (F.col("depth") == 0).cast("int"))
                  .withColumn("_block", F.floor(F.col("_turn") / F.lit(BLOCK))))
    linked = prefix_scan(lines, ["_c", "key"], F.col("_block"), ["_turn", "_own", "line"],
                         lasts={"origin": F.when(F.col("_own") == 1, F.col("_turn"))})
    return linked.where((F.col("_own") == 0) & F.col("origin").isNotNull()).select("_c", "_turn", "_mark", "line", "depth", "origin")


def quotation_links(linked: DataFrame) -> DataFrame:
    """``_c, _turn, depth, origin, lines``: how many lines each message quotes
    at each level from which earlier message."""
    return linked.groupBy("_c", "_turn", "depth", "origin").agg(F.count(F.lit(1)).alias("lines"))


def roots(parents: DataFrame) -> DataFrame:
    """``_c, _turn, parent`` -> also ``root``: the message without parent that
    a message leads to. Every round doubles the way that a pointer goes, so
    the rounds grow with the logarithm of the longest chain of replies."""
    at = materialise(parents.withColumn("root", F.coalesce("parent", "_turn")), "reply-roots")
    while True:
        to = at.select("_c", F.col("_turn").alias("root"), F.col("root").alias("_next"))
        step = at.join(to, ["_c", "root"], "left").select(
            "_c", "_turn", "parent", F.col("root").alias("_before"), F.coalesce("_next", "root").alias("root"))
        step = materialise(step, "reply-roots")
        at = step.drop("_before")
        if step.where("root <> _before").isEmpty():
            return at


def link_quotes(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", text_col: str = "text") -> DataFrame:
    """Conversations in the order of replies, without linked quotes.

    Appends ``parent_turn`` (the message from which most lines of the first
    quote level come, of equal ones the latest; NULL if nothing earlier is
    quoted), ``root_turn`` (the first message of its thread), ``position``
    (from 0, in the conversation ordered by thread and turn, which puts every
    message after those it answers) and ``quoted`` (lines linked, all
    levels), and replaces the text by the message without its linked lines. A
    quoted line that no earlier message says (a prompt, an outside text) stays
    where it is, marks included.

    NULL text is an empty message; a NULL turn counts as -1 and NULL
    conversations as one; rows sharing conversation and turn are one message
    as to links and get positions in any order; an empty table gives an empty
    result; input columns named like the results are replaced.
    """
    keyed = _keyed(df, conv_col, turn_col, text_col)
    importable(df.sparkSession)
    linked = materialise(linked_lines(keyed), "quoted-lines", free=True)
    links = quotation_links(linked)
    first = links.where("depth = 1").groupBy("_c", "_turn").agg(F.max(F.struct("lines", "origin"))["origin"].alias("parent"))
    counts = links.groupBy("_c", "_turn").agg(F.sum("lines").alias("quoted"))
    messages = keyed.select("_c", "_turn").distinct().join(first, ["_c", "_turn"], "left")
    threads = materialise(roots(messages).join(counts, ["_c", "_turn"], "left"), "threads", free=True)
    # (a message's own line numbers: bounded by its text)
    quoted = linked.groupBy("_c", "_turn", "_mark").agg(F.collect_set("line").alias("_lines"))
    d = keyed.withColumn("_mark", F.xxhash64("_text")).join(quoted, ["_c", "_turn", "_mark"], "left")
    d = d.join(threads, ["_c", "_turn"], "left").select(
        "_row", "_c", "_turn", F.udf(_own, "string", useArrow=True)("_text", "_lines").alias("_clean"), F.col("parent").alias("parent_turn"),
        F.col("root").alias("root_turn"), F.coalesce("quoted", F.lit(0)).cast("long").alias("quoted"))
    # the scan reads its rows twice; from a table of their own, its plan is that of
    # the scan alone, which the driver keeps and plans anew at every stage
    d = materialise(d, "clean-messages", free=True)
    d = prefix_scan(d, ["_c"], F.floor(F.col("root_turn") / F.lit(BLOCK)), ["root_turn", "_turn"], sums={"position": F.lit(1).cast("long")})
    d = d.withColumn("_row", F.col("_row").withField(f"`{text_col}`", F.col("_clean")))
    return unpack(d, ["parent_turn", "root_turn", "position", "quoted"])


def with_quotes(df: DataFrame) -> DataFrame:
    """``conversations`` as they would come by mail: every message but the
    first quotes, above its own text, the one before it (every third: the one
    before that), which in turn quotes what it answers one level deeper."""
    back = F.when(F.col("turn") % 3 == 2, 2).otherwise(1)
    m = df.withColumn("_to", F.col("turn") - back)
    said = lambda n: df.select(F.col("conv_id").alias(f"c{n}"), F.col("turn").alias(f"t{n}"), F.col("text").alias(f"x{n}"))
    m = m.join(said(1), F.col("conv_id").eqNullSafe(F.col("c1")) & (F.col("_to") == F.col("t1")), "left")
    again = F.col("t1") - F.when(F.col("t1") % 3 == 2, 2).otherwise(1)
    m = m.withColumn("_again", again).join(said(2), F.col("conv_id").eqNullSafe(F.col("c2")) & (F.col("_again") == F.col("t2")), "left")
    marked = lambda c, mark: F.regexp_replace(c, r"(?m)^", mark)
    text = F.concat_ws("\n", marked(F.col("x2"), "> > "), marked(F.col("x1"), "> "), F.col("text"))
    return m.select("conv_id", "turn", "role", text.alias("text"))


@query("op7_quotes")
def op7_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, first made to quote each other (the table has no
    quotes), linked, ordered and freed from quotes again."""
    out = link_quotes(materialise(with_quotes(table(spark, sf_dir, "conversations")), "quoted-messages"))
    return out.select("conv_id", "turn", "role", "text", "parent_turn", "root_turn", "position", "quoted")
