"""Chat formatting in budgeted windows.

A conversation becomes training windows of at most ``budget`` tokens. Running
sums of turn tokens choose the spans: with room for N new tokens in a window, a
turn whose tokens all fall into [kN, (k+1)N) of the running sum belongs to span
k, and a turn across such a border is a span of its own, so spans end at turns. A window
is the system turn (if the conversation opens with one), the turns before the
span that fit into ``history`` tokens, and the span. A span of whole turns keeps
the budget with both; beside a long turn of its own span history gives way first,
then the system turn's repeat, so only a single turn longer than the budget makes
a longer window, and it stands alone there. The loss mask covers the assistant texts of
the span alone: a repeated turn is context, never a target twice.

Template: ``<|role|>text<|~end|>`` for each turn. Inside roles and texts ``~``,
``<|`` and ``|>`` are written ``~0``, ``~1`` and ``~2``, which :func:`read_back`
reverses (an escaped role never holds a bare ``~``, so none reads as an end
mark); a role's leading ``>`` is written ``~3``, since it would close its mark. DataFrame functions only.

Running sums are taken over chunks of turns and then inside a chunk, and
history is an equi-join on blocks of the running sum, so one conversation with
a third of all rows is spread over tasks. (A digest over a conversation's whole
text, as the registered query's contract asks, still reads it in one place.)

Defined cases: a null text is empty, a null role is empty; rows are ordered by
turn (nulls first), then role and text, and rows of equal turns all count; a
null conv_id is a conversation of its own; an empty table gives no windows;
other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwise.llm.common import staged

BUDGET, HISTORY = 1024, 192
#: Turns in a chunk of the running sums.
CHUNK = 64


def escape(c):
    return F.replace(F.replace(F.replace(c, F.lit("~"), F.lit("~0")), F.lit("<|"), F.lit("~1")), F.lit("|>"), F.lit("~2"))


def unescape(c):
    return F.replace(F.replace(F.replace(c, F.lit("~2"), F.lit("|>")), F.lit("~1"), F.lit("<|")), F.lit("~0"), F.lit("~"))


def escape_role(c):
    return F.regexp_replace(escape(c), "^>", "~3")


def unescape_role(c):
    return unescape(F.regexp_replace(c, "^~3", ">"))


def estimated_tokens(text):
    """A turn's tokens: four characters each, and four for its marks."""
    return F.ceil(F.length(text) / 4) + 4


def numbered_turns(conversations: DataFrame, tokens=estimated_tokens) -> DataFrame:
    """Turns with their place ``idx`` (from 1), their tokens ``n`` and the running
    sum ``before`` them, per conversation ``ck``."""
    ck = F.when(F.col("conv_id").isNull(), "n").otherwise(F.concat(F.lit("c"), F.col("conv_id").cast("string")))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    turns = conversations.select(
        ck.alias("ck"), "conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        text.alias("text"), tokens(text).cast("bigint").alias("n"),
        F.coalesce(F.floor(F.col("turn") / CHUNK).cast("bigint"), F.lit(-(1 << 62))).alias("chunk"))
    sums = turns.groupBy("ck", "chunk").agg(F.sum("n").alias("s"), F.count(F.lit(1)).alias("c"))
    earlier = Window.partitionBy("ck").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("ck", "chunk", F.coalesce(F.sum("s").over(earlier), F.lit(0)).alias("s0"),
                          F.coalesce(F.sum("c").over(earlier), F.lit(0)).alias("c0"))
    inside = Window.partitionBy("ck", "chunk").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (turns.join(offsets, ["ck", "chunk"])
            .select("ck", "conv_id", "role", "text", "n", (F.col("c0") + F.row_number().over(inside)).alias("idx"),
                    (F.col("s0") + F.sum("n").over(upto) - F.col("n")).alias("before")))


def chat_windows(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY,
                 tokens=estimated_tokens) -> DataFrame:
    """One row per window: conv_id, window (its first new turn's place), n_context
    (turns repeated at its start), n_turns, n_tokens, text, targets (array of
    struct(start, length), in characters of text)."""
    turns = staged(numbered_turns(conversations, tokens), "chat-turns")
    system = turns.filter("idx = 1 and role = 'system'").select("ck", F.col("n").alias("sys_n"))
    turns = turns.join(system, "ck", "left").withColumn("sys_n", F.coalesce("sys_n", F.lit(0)))
    # new tokens in a window: what system turn and history leave, at least a quarter
    new = F.greatest(F.lit(budget) - F.col("sys_n") - history, F.lit(max(1, budget // 4)))
    first, last = F.floor(F.col("before") / new), F.floor((F.col("before") + F.col("n") - 1) / new)
    spans = turns.withColumn("span", F.struct(first.alias("k"), F.when(first != last, F.col("idx")).otherwise(0).alias("i")))
    heads = (spans.groupBy("ck", "conv_id", "span", "sys_n")
             .agg(F.min("idx").alias("window"), F.min("before").alias("at"), (F.lit(budget) - F.sum("n")).alias("room"))
             .withColumn("repeat", (F.col("sys_n") > 0) & (F.col("sys_n") <= F.col("room")) & (F.col("window") > 1))
             .withColumn("past", F.least(F.lit(history), F.col("room") - F.when(F.col("repeat"), F.col("sys_n")).otherwise(0))))
    of_span = heads.select(F.col("ck").alias("hc"), F.col("span").alias("hs"), "window")
    fresh = (spans.join(of_span, (F.col("ck") == F.col("hc")) & (F.col("span") == F.col("hs")))
             .select("ck", "conv_id", "window", "idx", "role", "text", "n", F.lit(True).alias("fresh")))
    # a head at running sum A repeats the turns that begin in [A - past, A), past being at most history
    block = lambda c: F.floor(c / history)
    h = heads.filter("past > 0").select(F.col("ck").alias("hc"), "window", "at", "past", F.col("sys_n").alias("has_system"),
                     F.explode(F.array(block(F.col("at")), block(F.col("at")) - 1)).alias("hb"))
    past = (turns.withColumn("b", block(F.col("before")))
            .join(h, (F.col("ck") == F.col("hc")) & (F.col("b") == F.col("hb")) & (F.col("before") < F.col("at"))
                  & (F.col("before") >= F.col("at") - F.col("past")) & (F.col("idx") < F.col("window"))
                  & ((F.col("idx") > 1) | (F.col("has_system") == 0)))
            .select("ck", "conv_id", "window", "idx", "role", "text", "n", F.lit(False).alias("fresh")))
    opening = (turns.filter("idx = 1 and sys_n > 0").select("ck", "conv_id", "idx", "role", "text", "n")
               .join(heads.filter("repeat").select("ck", "window"), "ck")
               .select("ck", "conv_id", "window", "idx", "role", "text", "n", F.lit(False).alias("fresh")))
    parts = fresh.unionByName(past).unionByName(opening)
    mark = F.concat(F.lit("<|"), escape_role(F.col("role")), F.lit("|>"))
    body = escape(F.col("text"))
    row = F.struct("idx", "fresh", F.concat(mark, body, F.lit("<|~end|>")).alias("line"), F.length(mark).cast("int").alias("skip"),
                   F.length(body).cast("int").alias("size"), "role", "n")
    windows = parts.groupBy("ck", "conv_id", "window").agg(F.sort_array(F.collect_list(row)).alias("t"))
    targets = F.expr(
        "aggregate(t, named_struct('at', 0, 'm', cast(array() as array<struct<start:int,length:int>>)), (a, x) -> named_struct("
        "'at', a.at + length(x.line), 'm', if(x.fresh and x.role = 'assistant',"
        " concat(a.m, array(named_struct('start', a.at + x.skip, 'length', x.size))), a.m)), a -> a.m)")
    return windows.select("conv_id", "window", F.expr("size(filter(t, x -> not x.fresh))").alias("n_context"),
                          F.size("t").alias("n_turns"), F.expr("aggregate(t, 0L, (a, x) -> a + x.n)").alias("n_tokens"),
                          F.expr("array_join(transform(t, x -> x.line), '')").alias("text"), targets.alias("targets"))


def read_back(windows: DataFrame) -> DataFrame:
    """Per conversation, from the windows' texts and masks alone: conv_id, n_turns,
    turns (role, newline, text, newline for every turn that is not a repeat),
    targets (all text under the loss mask), formatted_chars."""
    lines = F.expr("slice(split(text, '<[|]~end[|]>', -1), n_context + 1, n_turns - n_context)")
    cut = windows.select("conv_id", "window", "n_turns", "n_context", F.length("text").alias("chars"),
                         F.transform(lines, lambda x: F.concat(
                             unescape_role(F.substring(x, F.lit(3), F.instr(x, "|>") - F.lit(3))), F.lit("\n"),
                             unescape(F.substring(x, F.instr(x, "|>") + F.lit(2), F.length(x))), F.lit("\n"))).alias("turns"),
                         F.transform("targets", lambda s: unescape(F.substring(
                             F.col("text"), s["start"] + F.lit(1), s["length"]))).alias("loss"))
    each = F.struct("window", F.array_join("turns", "").alias("turns"), F.array_join("loss", "").alias("loss"))
    return (cut.groupBy("conv_id").agg(F.sort_array(F.collect_list(each)).alias("w"),
                                       F.sum(F.col("n_turns") - F.col("n_context")).alias("n_turns"),
                                       F.sum("chars").alias("formatted_chars"))
            .select("conv_id", "n_turns", F.expr("array_join(transform(w, x -> x.turns), '')").alias("turns"),
                    F.expr("array_join(transform(w, x -> x.loss), '')").alias("targets"), "formatted_chars"))
