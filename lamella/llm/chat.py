"""Chat formatting with Spark expressions only.

Turns of a conversation are collected as structs and sorted, neighbours of the same role are merged into one block by
aggregating the slice of the array between two changes of the role, and blocks are concatenated. The template, for a block of two turns of one role:

    <|start|>role
    first text<|next|>second text<|end|>

Inside texts and roles a backslash is doubled and ``<|`` becomes ``<\\|``, so no control string can occur there and
every text can be read back. In a role a line feed becomes a backslash and ``n``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, NEXT, END = "<|start|>", "<|next|>", "<|end|>\n"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\([\\|])", "$1")


def _escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def _unescape_role(role: Column) -> Column:
    # a backslash pair is one backslash, so look at pairs before looking at the letter
    return unescape(F.regexp_replace(role, r"(?<!\\)((?:\\\\)*)\\n", "$1\n"))


def _plain(text: str) -> Column:
    """A literal pattern for split."""
    return F.lit(rf"\Q{text}\E")


def _let(value: Column, use) -> Column:
    """``use`` of a value that is computed once; inside of a lambda Spark would compute it again for every element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _sums_before(steps: Column) -> Column:
    """For each number of an array of longs the sum of those before it.

    An array that grows inside an aggregation is copied at every step, so numbers are summed up in runs of the square
    root of their number: time grows with its power of one and a half.
    """
    def run(numbers: Column, start: Column) -> Column:
        state = F.struct(start.alias("at"), F.array().cast("array<bigint>").alias("sums"))
        return F.aggregate(numbers, state, lambda s, x: F.struct(
            (s["at"] + x).alias("at"), F.concat(s["sums"], F.array(s["at"])).alias("sums")), lambda s: s["sums"])

    def in_runs(numbers: Column) -> Column:
        length = F.ceil(F.sqrt(F.size(numbers))).cast("int")
        runs = F.transform(
            F.sequence(F.lit(1), F.size(numbers), length), lambda first: F.slice(numbers, first, length))
        totals = lambda rs: F.transform(rs, lambda r: F.aggregate(r, F.lit(0).cast("long"), lambda a, b: a + b))
        return _let(runs, lambda rs: F.flatten(F.zip_with(rs, run(totals(rs), F.lit(0).cast("long")), run)))

    return _let(steps, lambda x: F.when(F.size(x) > 0, in_runs(x)).otherwise(F.array().cast("array<bigint>")))


def format_chats(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, formatted), one row a conversation.

    Turns stand by ``turn`` (null first), then role, then text, so repeated rows and ties have one order. Null roles and
    texts count as empty; rows without conversation id form one conversation. A conversation is one string, so its turns
    meet in one row; nothing else does. An empty table gives no rows; other columns are not looked at.
    """
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    sorted_turns = F.array_sort(F.collect_list(F.struct(
        F.coalesce(F.col(turn), F.lit(-(2**63))).alias("at"), blank(role).alias("role"), blank(text).alias("text"))))

    def block(turns_: Column, first: Column, after: Column) -> Column:
        texts = F.transform(F.slice(turns_, first + 1, after - first), lambda t: escape(t["text"]))
        return F.concat(F.lit(START), _escape_role(F.get(turns_, first)["role"]), F.lit("\n"), F.array_join(texts, NEXT), F.lit(END))

    def blocks(turns_: Column) -> Column:
        """A block begins with the first turn and wherever the role is not that of the turn before."""
        places = F.sequence(F.lit(0), F.size(turns_) - 1)
        firsts = F.filter(places, lambda i: (i == 0) | (F.get(turns_, i - 1)["role"] != F.get(turns_, i)["role"]))
        return _let(firsts, lambda f: F.zip_with(
            f, F.concat(F.slice(f, F.lit(2), F.size(f)), F.array(F.size(turns_))), lambda a, b: block(turns_, a, b)))

    return (
        turns.groupBy(F.col(conv_id).alias("conv_id")).agg(sorted_turns.alias("_turns"))
        .select("conv_id", F.array_join(_let(F.col("_turns"), blocks), "").alias("formatted"))
    )


def parse_chats(chats: DataFrame, formatted: str = "formatted") -> Column:
    """The turns of a formatted conversation, array<struct<role, text>>, as they were before merging and escaping."""
    blocks = F.filter(F.split(F.col(formatted), _plain(END)), lambda b: b != "")

    def turns_of(block: Column) -> Column:
        head = F.substring_index(block, "\n", 1)
        name = _unescape_role(head.substr(F.lit(len(START) + 1), F.length(head)))
        body = block.substr(F.length(head) + 2, F.length(block))
        return F.transform(F.split(body, _plain(NEXT)), lambda t: F.struct(name.alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(blocks, turns_of))


def loss_spans(formatted: str = "formatted", learn: str = "assistant") -> Column:
    """array<struct<start, end>>: the parts of a formatted conversation to learn from, in code points, end exclusive.

    A part is the escaped text of one turn of the role ``learn``; role lines and control strings are never in it.
    """
    def parts(block: Column, i: Column) -> Column:
        """Texts of a block: what stands between the text before and this one, and the text's own length."""
        head = F.substring_index(block, "\n", 1)
        lead = F.when(i > 0, len(END)).otherwise(0) + F.length(head) + 1
        return F.transform(F.split(block.substr(F.length(head) + 2, F.length(block)), _plain(NEXT)), lambda t, j: F.struct(
            F.when(j == 0, lead).otherwise(len(NEXT)).cast("long").alias("lead"), F.length(t).cast("long").alias("length"),
            (head == START + learn).alias("mine")))

    def laid(found: Column) -> Column:
        before = _sums_before(F.transform(found, lambda p: p["lead"] + p["length"]))
        placed = F.zip_with(found, before, lambda p, at: F.struct(
            (at + p["lead"]).cast("int").alias("start"), (at + p["lead"] + p["length"]).cast("int").alias("end"), p["mine"].alias("mine")))
        return F.transform(F.filter(placed, lambda s: s["mine"]), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))

    blocks = F.filter(F.split(F.col(formatted), _plain(END)), lambda b: b != "")
    return _let(F.flatten(F.transform(blocks, parts)), laid)
