"""Chat formatting in budgeted windows, with DataFrame functions alone."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

START, END = "<|im_start|>", "<|im_end|>"
# Strings that some chat template reads as control.
CONTROLS = (START, END, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|endoftext|>", "<|startoftext|>")
BUDGET = 2048
HISTORY_TURNS = 2
HISTORY_TOKENS = 512
#: Turns of a conversation that one row gathers the tokens of; longer conversations go to several.
BLOCK = 512
#: Characters of a text that order turns of the same number and role; a hash decides beyond.
BEGINNING = 64
SALTS = 16
#: Places that hold a partition's number in Spark's increasing ids.
ROW_BITS = 33


def escaped(text: Column) -> Column:
    """Doubles backslashes, then puts one after the first character of each control string."""
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for c in CONTROLS:
        text = F.replace(text, F.lit(c), F.lit(f"{c[0]}\\{c[1:]}"))
    return text


def unescaped(text: Column) -> Column:
    """Undoes ``escaped``: a backslash stands for what follows it."""
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def rough_tokens(text: Column) -> Column:
    """Tokens of a turn, about: a quarter of its bytes, and its marks. Never under 1. An estimate, as no tokenizer is a DataFrame function."""
    return (F.ceil(F.octet_length(text) / 4) + 6).cast("long")


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def tail(turns: Column, many: int | Column) -> Column:
    """The last ``many`` of an array, or all."""
    many = F.lit(many) if isinstance(many, int) else many
    return F.slice(turns, F.greatest(F.size(turns) - many + 1, F.lit(1)), many)


def numbered(rows: DataFrame) -> DataFrame:
    """(none, key, rid, pos, tokens, system): the turns' positions in their conversations, from 1.

    ``rid`` ascends in order and without gaps inside a partition, so that a
    position follows from the first ``rid`` of the conversation there and the
    number of its turns in the partitions before.
    """
    thin = rows.select("none", "key", "rid", F.shiftright("rid", ROW_BITS).alias("part"), "tokens", (F.col("role") == "system").alias("system"))
    parts = thin.groupBy("none", "key", "part").agg(F.min("rid").alias("begin"), F.count("*").alias("n"))
    earlier = Window.partitionBy("none", "key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("none", "key", "part", (F.col("begin") - 1 - F.coalesce(F.sum("n").over(earlier), F.lit(0))).alias("zero"))
    return thin.join(parts, ["none", "key", "part"]).select("none", "key", "rid", (F.col("rid") - F.col("zero")).alias("pos"), "tokens", "system")


def spans(budget: int, history_turns: int, history_tokens: int) -> Column:
    """Of a block's ``turns``, with the conversation's ``sys`` and the turns ``before`` it, the members of its windows.

    A running sum of tokens opens a window where the next turn does not fit. It
    begins with what the system turn takes, and as many of the last turns as
    their limit and the room that the new turn leaves allow.
    """
    one = "struct<wid: long, first: long, pos: long, rid: long, repeated: boolean>"

    def member(wid: Column, first: Column, t: Column, repeated: bool) -> Column:
        return F.struct(wid.alias("wid"), first.alias("first"), t.pos.alias("pos"), t.rid.alias("rid"), F.lit(repeated).alias("repeated"))

    def total(turns: Column) -> Column:
        return F.aggregate(turns, F.lit(0).cast("long"), lambda a, t: a + t.tokens)

    def step(acc: Column, t: Column) -> Column:
        system = F.when(t.pos > 1, F.col("sys.tokens"))
        limit = F.least(F.lit(history_tokens), F.lit(budget) - F.coalesce(system, F.lit(0)) - t.tokens)
        # Sums grow with the number of turns, so that those within the limit are the shortest.
        many = F.size(F.filter(F.sequence(F.lit(0), F.size(acc.before)), lambda k: (k > 0) & (total(tail(acc.before, k)) <= limit)))
        own = F.array(member(acc.wid, acc.first, t, False))
        before = F.when((t.pos == 1) & t.system, acc.before).otherwise(tail(F.concat(acc.before, F.array(t)), history_turns))

        def opened(history: Column) -> Column:
            kept = F.when(system.isNotNull(), F.array(member(t.rid, t.pos, F.col("sys"), True))).otherwise(F.array().cast(f"array<{one}>"))
            again = F.transform(history, lambda h: member(t.rid, t.pos, h, True))
            used = F.coalesce(system, F.lit(0)) + total(history) + t.tokens
            return F.struct(used.alias("used"), before.alias("before"), t.pos.alias("first"), t.rid.alias("wid"), F.concat(acc.out, kept, again, F.array(member(t.rid, t.pos, t, False))).alias("out"))

        grown = F.struct((acc.used + t.tokens).alias("used"), before.alias("before"), acc.first.alias("first"), acc.wid.alias("wid"), F.concat(acc.out, own).alias("out"))
        return F.when(acc.used + t.tokens <= budget, grown).otherwise(let(tail(acc.before, many), opened))

    # No turn fits what is used at first, so that every block opens a window.
    begin = F.struct(F.lit(budget).cast("long").alias("used"), F.col("before"), F.lit(0).cast("long").alias("first"), F.lit(0).cast("long").alias("wid"), F.array().cast(f"array<{one}>").alias("out"))
    return F.aggregate("turns", begin, step, lambda acc: acc.out)


def members(turns: DataFrame, budget: int, history_turns: int, history_tokens: int) -> DataFrame:
    """(wid: rid of a window's first new turn, first: its position, pos, rid, repeated): the turns of each window.

    A row gathers the tokens of ``BLOCK`` turns at most. Blocks of a long
    conversation learn its system turn and the last turns of the block before
    in joins that no conversation gathers in.
    """
    turn = F.struct("pos", "rid", "tokens", "system")
    blocks = turns.groupBy("none", "key", F.floor((F.col("pos") - 1) / BLOCK).alias("block")).agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    blocks = stored(blocks)
    head = F.get("turns", F.lit(0))
    system = F.when(head.system, head)
    nothing = F.slice("turns", 1, 0)
    first = blocks.where("block = 0").select("turns", system.alias("sys"), nothing.alias("before"))
    later = blocks.where("block > 0").withColumn("salt", F.col("block") % SALTS)
    last = F.filter(tail(F.col("turns"), history_turns), lambda t: (t.pos > 1) | ~t.system)
    tails = blocks.select("none", "key", (F.col("block") + 1).alias("block"), last.alias("before"))
    systems = blocks.where("block = 0").where(head.system).join(later.where("block = 1").select("none", "key"), ["none", "key"], "left_semi")
    systems = systems.select("none", "key", head.alias("sys"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt"))
    later = later.join(tails, ["none", "key", "block"]).join(systems, ["none", "key", "salt"], "left")
    both = first.unionByName(later.select("turns", "sys", "before"))
    return both.select(F.explode(spans(budget, history_turns, history_tokens)).alias("m")).select("m.*")


def windows(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
    budget: int = BUDGET, history_turns: int = HISTORY_TURNS, history_tokens: int = HISTORY_TOKENS, tokens: Callable[[Column], Column] = rough_tokens,
) -> DataFrame:
    """Formatted windows of conversations: (conv_id, first, text, segments).

    Turns are ordered by turn number, then role and the text's first
    ``BEGINNING`` characters (nulls first), then a hash. Windows are runs of
    whole turns: running sums of ``tokens`` (of a text; positive) put as many
    turns in a window as ``budget`` has room for, all that it repeats included;
    every ``BLOCK`` turns a new one begins. Every window but the first begins
    with the conversation's system turn (its first turn, if that is of the role
    ``system``) and up to ``history_turns`` turns that came before it, of
    ``history_tokens`` at most and only where they fit. So only a window of one
    new turn can exceed the budget, by a turn that is too long itself or beside
    the system turn. Repeats bear no loss; each new assistant turn does, in one
    window alone.

    segments: (pos: of the turn, from 1; role_start, role_length, text_start,
    text_length: code points in ``text``; repeated; loss: the text is a target).
    Null roles and texts are empty; rows without conversation id form one
    conversation; repeated rows are turns of their own; an empty table gives no
    windows; other columns are ignored. Rows are dealt out in ranges of their
    order, so that no conversation and no turn number is gathered in one task.
    """
    rows = turns.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumns({"none": F.col("conv_id").isNull(), "key": F.coalesce(F.col("conv_id").cast("string"), F.lit(""))})
    order = {"begins": F.substring("text", 1, BEGINNING), "hash": F.xxhash64("text"), "salt": F.xxhash64(F.monotonically_increasing_id())}
    rows = rows.withColumns(order | {"tokens": tokens(F.col("text"))})
    by = ["none", "key", "turn", "role", "begins", "hash"]
    rows = rows.repartitionByRange(*by, "salt").sortWithinPartitions(*by).withColumn("rid", F.monotonically_increasing_id())
    rows = stored(rows.select("conv_id", "none", "key", "rid", "role", "text", "tokens"))
    found = stored(members(numbered(rows), budget, history_turns, history_tokens))
    texts = rows.select("rid", "conv_id", "role", "text")
    often = found.where(F.col("repeated") & (F.col("pos") == 1))
    parts = texts.join(found.where(~F.col("repeated") | (F.col("pos") > 1)), "rid")
    # A long conversation has many windows, so that its system turn goes to several tasks.
    salts = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))
    system = texts.where("role = 'system'").join(often.select("rid").distinct(), "rid", "left_semi").withColumn("salt", salts)
    parts = parts.unionByName(system.join(often.withColumn("salt", F.col("first") % SALTS), ["rid", "salt"]).drop("salt"))
    parts = parts.select("wid", "conv_id", "first", "pos", "repeated", (~F.col("repeated") & (F.col("role") == "assistant")).alias("loss"), escaped(F.col("role")).alias("role"), escaped(F.col("text")).alias("text"))
    parts = parts.withColumn("piece", F.concat(F.lit(START), "role", F.lit("\n"), "text", F.lit(END + "\n")))
    inside = Window.partitionBy("wid").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    begun = F.coalesce(F.sum(F.length("piece").cast("long")).over(inside), F.lit(0)) + len(START)
    parts = parts.withColumn("role_start", begun)
    segment = F.struct(
        "pos", "role_start", F.length("role").cast("long").alias("role_length"), (F.col("role_start") + F.length("role") + 1).alias("text_start"), F.length("text").cast("long").alias("text_length"), "repeated", "loss"
    )
    grouped = parts.groupBy("wid").agg(F.first("conv_id").alias("conv_id"), F.first("first").alias("first"), F.array_sort(F.collect_list(F.struct("pos", "piece", segment.alias("segment")))).alias("parts"))
    return grouped.select("conv_id", "first", F.array_join(F.col("parts.piece"), "").alias("text"), F.col("parts.segment").alias("segments"))


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, pos, role, text, loss, window_chars) of each turn, once, from windows; window_chars: of the window in which it is first, else 0."""
    rows = formatted.select("conv_id", F.col("text").alias("whole"), F.posexplode("segments").alias("nr", "s"))
    rows = rows.select("conv_id", "whole", "s.*", F.when(F.col("nr") == 0, F.length("whole")).otherwise(0).cast("long").alias("window_chars"))

    def part(start: str, length: str) -> Column:
        return F.when(F.col("repeated"), F.lit("")).otherwise(unescaped(F.substring(F.col("whole"), F.col(start).cast("int") + 1, F.col(length).cast("int"))))

    return rows.select("conv_id", "pos", "repeated", "loss", part("role_start", "role_length").alias("role"), part("text_start", "text_length").alias("text"), "window_chars")


def digests(formatted: DataFrame) -> DataFrame:
    """The contract's columns. One hash covers a conversation, so that its turns meet in one row."""
    turns = F.array_sort(F.collect_list(F.when(~F.col("repeated"), F.struct("pos", "role", "text", "loss"))))
    found = read_back(formatted).groupBy("conv_id").agg(turns.alias("turns"), F.sum("window_chars").alias("formatted_chars"))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    target = F.array_join(F.transform(F.filter("turns", lambda t: t.loss), lambda t: t.text), "")
    return found.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"), F.length(target).cast("long").alias("loss_chars"), F.sha2(target, 256).alias("loss_sha256"), "formatted_chars"
    )
