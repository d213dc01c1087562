"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are context, and only its
text is trained on. Marks part the turns; where a text or a role name holds the string of a mark, a
backslash behind its first character keeps the two apart, and :func:`unescape` takes it out again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TRAINED_ROLE = "assistant"
# Opening and closing mark of a turn by role. Other roles are named between the first two marks of OTHER.
MARKS = {"system": ("[SYS]", "[/SYS]"), "user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>")}
OTHER = ("[TURN]", "[NAME]", "[/TURN]")

# What follows the first character of a mark, and the backslashes behind that, if any.
_ANGLE, _SQUARE = r"/?s>", r"(?:/?SYS|/?INST|/?TURN|NAME)\]"


def escape(text: Column) -> Column:
    """The text with one more backslash behind the first character of everything that reads like a mark."""
    return F.regexp_replace(text, rf"(<\\*)(?={_ANGLE})|(\[\\*)(?={_SQUARE})", r"$1$2\\")


def unescape(text: Column) -> Column:
    """The text that :func:`escape` was given."""
    return F.regexp_replace(text, rf"(<\\*)\\(?={_ANGLE})|(\[\\*)\\(?={_SQUARE})", "$1$2")


def _by_role(role: Column, known, other: Column) -> Column:
    return reduce(lambda rest, name: F.when(role == name, known(name)).otherwise(rest), MARKS, other)


def examples(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """One row for each assistant turn, and one for the end of a conversation that another turn ends.

    Returns ``conv_col``, ``position`` (turns of the example), ``formatted`` (all turns up to this
    one), ``loss_start`` and ``loss_length`` (code points of ``formatted`` that are trained on: the
    escaped text of the last turn, nothing where that is not the assistant's) and ``whole`` (whether
    the example holds the whole conversation).

    Turns are ordered by turn, then role, then text, nulls first; repeated rows stay separate turns.
    A null text or role counts as empty, a null conversation is one conversation. An empty table
    gives no rows, other columns are ignored. The examples of a conversation hold the sum of its
    prefixes, which the method asks for; they are made one after another from a sorted window that
    can spill, so a task holds one prefix at a time.
    """
    role = F.coalesce(F.col(role_col), F.lit(""))
    text = F.coalesce(F.col(text_col), F.lit(""))
    opening = _by_role(role, lambda r: F.lit(MARKS[r][0] + " "), F.concat(F.lit(f"{OTHER[0]} "), escape(role), F.lit(f" {OTHER[1]} ")))
    closing = _by_role(role, lambda r: F.lit(" " + MARKS[r][1] + "\n"), F.lit(f" {OTHER[2]}\n"))
    pieces = turns.select(
        F.col(conv_col).alias("_conv"),
        F.col(turn_col).alias("_turn"),
        role.alias("_role"),
        text.alias("_text"),
        F.char_length(opening).alias("_lead"),
        F.concat(opening, escape(text), closing).alias("_piece"),
        F.char_length(escape(text)).alias("_chars"),
    )
    order = Window.partitionBy("_conv").orderBy("_turn", "_role", "_text")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    ordered = pieces.select(
        "_conv",
        "_role",
        "_chars",
        F.row_number().over(order).alias("position"),
        F.lead(F.lit(True)).over(order).isNull().alias("whole"),
        (F.coalesce(F.sum(F.char_length("_piece")).over(before), F.lit(0)) + F.col("_lead")).alias("_start"),
        F.collect_list("_piece").over(so_far).alias("_pieces"),
    )
    trained = F.col("_role") == TRAINED_ROLE
    return ordered.filter(trained | F.col("whole")).select(
        F.col("_conv").alias(conv_col),
        "position",
        F.array_join("_pieces", "").alias("formatted"),
        F.when(trained, F.col("_start")).otherwise(0).cast("long").alias("loss_start"),
        F.when(trained, F.col("_chars")).otherwise(0).cast("long").alias("loss_length"),
        "whole",
    )


def loss_text(formatted: str = "formatted", start: str = "loss_start", length: str = "loss_length") -> Column:
    """The text under the loss mask of an example, as it was before formatting."""
    return unescape(F.substring(F.col(formatted), F.col(start).cast("int") + 1, F.col(length).cast("int")))


def turns_of(formatted: Column) -> Column:
    """Roles and texts read back from a formatted conversation, as an array of structs."""
    mark = {name: tuple(_literal(m) for m in pair) for name, pair in MARKS.items()}
    a, b, c = map(_literal, OTHER)
    kinds = [rf"{first} .*? {last}\n" for first, last in mark.values()] + [rf"{a} .*? {b} .*? {c}\n"]
    found = F.regexp_extract_all(formatted, F.lit("(?s)" + "|".join(kinds)), F.lit(0))

    def read(turn: Column) -> Column:
        named = F.regexp_extract(turn, rf"(?s)\A{a} (.*?) {b} ", 1)
        other = F.struct(unescape(named).alias("role"), _inside(turn, F.char_length(named) + len(f"{OTHER[0]}  {OTHER[1]} "), OTHER[2]).alias("text"))

        def known(name: str) -> Column:
            return F.struct(F.lit(name).alias("role"), _inside(turn, F.lit(len(MARKS[name][0]) + 1), MARKS[name][1]).alias("text"))

        return reduce(lambda rest, name: F.when(F.startswith(turn, F.lit(MARKS[name][0])), known(name)).otherwise(rest), MARKS, other)

    return F.transform(found, read)


def _inside(turn: Column, lead: Column, closing: str) -> Column:
    """Text of a turn behind ``lead`` characters and before its closing mark."""
    return unescape(F.substring(turn, lead + 1, F.char_length(turn) - lead - (len(closing) + 2)))


def _literal(mark: str) -> str:
    return mark.replace("[", r"\[").replace("]", r"\]")


def digests(formatted: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """Per conversation, read back from its examples: turns and trained text, counted and hashed.

    Returns ``conv_col``, ``n_turns``, ``turns_sha256``, ``loss_chars``, ``loss_sha256`` and
    ``formatted_chars`` (code points of all examples). The examples are grouped where they are made.
    """
    told = formatted.select(
        conv_col,
        "position",
        F.char_length("formatted").cast("long").alias("_size"),
        F.when(F.col("loss_length") > 0, loss_text()).alias("_loss"),
        F.when(F.col("whole"), turns_of(F.col("formatted"))).alias("_turns"),
    )
    lost = F.struct("position", F.col("_loss").alias("loss"))
    read = told.groupBy(conv_col).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("_loss").isNotNull(), lost))), lambda x: x["loss"]), "").alias("_loss"),
        F.first("_turns", ignorenulls=True).alias("_turns"),
        F.sum("_size").alias("formatted_chars"),
    )
    lines = F.transform("_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        conv_col,
        F.size("_turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.char_length("_loss").cast("long").alias("loss_chars"),
        F.sha2("_loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )
