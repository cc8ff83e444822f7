"""Chat training windows: budgeted, turn-aligned, with the system turn and a limited history repeated.

DataFrame operations only. The marks of the template begin with "<" and contain "|", and both characters are
replaced inside roles and texts, so a text can never pass for a mark, and reading back is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, SHUT, END = "<|", "|>", "<|end|>"
# Characters that make marks, and what stands for them (fixed values); "&" is replaced first and restored last.
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ("|", "&#124;"))
_SEGMENT = r"<\|([^|]*)\|>([^<]*)<\|end\|>"


def escaped(text: Column) -> Column:
    for plain, code in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescaped(text: Column) -> Column:
    for plain, code in reversed(ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def estimated_tokens(escaped_text: Column) -> Column:
    """Four UTF-8 bytes make a token, and the marks of a turn make four."""
    return F.ceil(F.octet_length(escaped_text) / 4) + 4


def chat_windows(turns: DataFrame, budget: int, history: int, tokens=estimated_tokens) -> DataFrame:
    """(conv_id, window, n_tokens, n_new, n_repeated, n_history, formatted, loss): one row per training window.

    `turns` has conv_id, turn, role, text. Prefix sums of the turns' tokens place each turn on a line that is cut every B
    tokens: what the budget leaves beside the system turn, less `history` or a quarter of it. Turns inside one piece make
    a window, a turn across a cut makes one by itself, so windows are runs of whole turns. Each window begins with the
    conversation's system turn (its first turn, if the role is "system") and the turns before it that fit into `history`
    tokens and into what system turn and new turns leave of the budget; these n_repeated segments, n_history of them beside the
    system turn, are not trained on again. So a window holds at most `budget` tokens, unless the system turn and its only new turn alone are longer. `loss`
    lists (start, length) in code points of `formatted` for the texts of new assistant turns: each is a target in
    exactly one window.

    Turns are ordered by turn (null first), then role and text, so repeated rows stay separate turns. Null
    roles and texts count as empty. Rows without a conv_id are left out. An empty table gives an empty one. Other
    columns of any name are ignored.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = (
        turns.where(turns["conv_id"].isNotNull())
        .select(
            turns["conv_id"].alias("conv_id"),
            turns["turn"].alias("turn"),
            F.coalesce(turns["role"].cast("string"), F.lit("")).alias("role"),
            F.coalesce(turns["text"].cast("string"), F.lit("")).alias("text"),
        )
        .withColumns({"place": F.row_number().over(order), "role_out": escaped(F.col("role")), "text_out": escaped(F.col("text"))})
        .withColumn("tokens", tokens(F.col("text_out")).cast("long"))
        .withColumn("is_system", (F.col("place") == 1) & (F.col("role") == "system"))
    )
    everything = Window.partitionBy("conv_id")
    upto = Window.partitionBy("conv_id").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    line = F.when(F.col("is_system"), 0).otherwise(F.col("tokens"))
    system = F.sum(F.when(F.col("is_system"), F.col("tokens")).otherwise(0)).over(everything)
    room = F.greatest(F.lit(1), F.lit(budget) - system)
    piece = F.greatest(F.lit(1), room - F.least(F.lit(history), F.floor(room / 4)))
    rows = rows.withColumns({"system": system, "piece": piece, "ends": F.sum(line).over(upto)}).withColumn("starts", F.col("ends") - line)
    first, last = F.floor(F.col("starts") / F.col("piece")), F.floor((F.col("ends") - 1) / F.col("piece"))
    rows = rows.withColumn("window", F.when(F.col("is_system"), 0).otherwise(2 * first + (last > first).cast("long")))

    body = rows.where("not is_system")
    left = F.greatest(F.lit(0), F.least(F.lit(history), F.lit(budget) - F.first("system") - F.sum("tokens")))
    spans = body.groupBy("conv_id", "window").agg(F.min("starts").alias("span_starts"), left.alias("reach"))
    whole = spans.join(rows.where("is_system").select("conv_id", "role_out", "text_out", "tokens", "place"), "conv_id")
    alone = rows.where("is_system").join(spans, "conv_id", "left_anti")
    # turns of the last `history` tokens before a window lie in its own or the neighbouring stretch of that length
    longest = max(1, history)
    stretch = F.floor(F.col("span_starts") / longest)
    wanted = spans.withColumn("stretch", F.explode(F.array(stretch - 1, stretch)))
    earlier = body.select(
        "conv_id", "role_out", "text_out", "tokens", "place", "starts", "ends", F.floor(F.col("starts") / longest).alias("stretch")
    )
    repeated = earlier.join(wanted, ["conv_id", "stretch"]).where(
        (F.col("ends") <= F.col("span_starts")) & (F.col("starts") >= F.col("span_starts") - F.col("reach"))
    )

    def segments(df: DataFrame, kind: int, target: Column) -> DataFrame:
        return df.select("conv_id", "window", F.lit(kind).alias("kind"), "place", "role_out", "text_out", "tokens", target.alias("target"))

    never = F.lit(False)
    parts = (
        segments(whole, 0, never)
        .unionByName(segments(repeated, 1, never))
        .unionByName(segments(body, 2, F.col("role") == "assistant"))
        .unionByName(segments(alone, 2, never))
    )
    segment = F.concat(F.lit(OPEN), "role_out", F.lit(SHUT), "text_out", F.lit(END))
    before = Window.partitionBy("conv_id", "window").orderBy("kind", "place").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.length(segment)).over(before), F.lit(0)) + F.length("role_out") + len(OPEN + SHUT)
    parts = parts.select("*", segment.alias("segment"), start.alias("start"), F.length("text_out").alias("length"))
    return (
        parts.groupBy("conv_id", "window")
        .agg(
            F.sum("tokens").alias("n_tokens"),
            F.count_if(F.col("kind") == 2).alias("n_new"),
            F.count_if(F.col("kind") < 2).alias("n_repeated"),
            F.count_if(F.col("kind") == 1).alias("n_history"),
            F.sort_array(F.collect_list(F.struct("kind", "place", "segment"))).alias("all"),
            F.sort_array(F.collect_list(F.when(F.col("target"), F.struct("start", "length")))).alias("loss"),
        )
        .select("conv_id", "window", "n_tokens", "n_new", "n_repeated", "n_history", F.array_join("all.segment", "").alias("formatted"), "loss")
    )


def read_turns(windows: DataFrame) -> DataFrame:
    """(conv_id, window, place, role, text): every turn once, parsed back from the windows' text."""
    first = Window.partitionBy("conv_id")
    found = windows.withColumn("is_first", F.col("window") == F.min("window").over(first)).select(
        "conv_id",
        "window",
        F.when(F.col("is_first"), 0).otherwise(F.col("n_repeated")).alias("skip"),
        F.posexplode(
            F.arrays_zip(
                F.regexp_extract_all("formatted", F.lit(_SEGMENT), F.lit(1)).alias("role"),
                F.regexp_extract_all("formatted", F.lit(_SEGMENT), F.lit(2)).alias("text"),
            )
        ).alias("place", "segment"),
    )
    return found.where("place >= skip").select(
        "conv_id", "window", "place", unescaped(F.col("segment.role")).alias("role"), unescaped(F.col("segment.text")).alias("text")
    )


def loss_texts(windows: DataFrame) -> DataFrame:
    """(conv_id, window, text): what the loss mask of each window covers, unescaped."""
    masked = F.transform("loss", lambda s: F.substring("formatted", s["start"] + 1, s["length"]))
    return windows.select("conv_id", "window", unescaped(F.array_join(masked, "")).alias("text"))


def conversation_digests(windows: DataFrame, budget: int) -> DataFrame:
    """Per conversation, what can be read back from its windows: see the query of this operator.

    n_over_budget counts windows over the budget that hold more than one new turn, or history.
    """
    turns = read_turns(windows).groupBy("conv_id").agg(
        F.count("*").alias("n_turns"),
        F.array_join(
            F.transform(
                F.sort_array(F.collect_list(F.struct("window", "place", "role", "text"))),
                lambda s: F.concat(s["role"], F.lit("\n"), s["text"], F.lit("\n")),
            ),
            "",
        ).alias("all"),
    )
    loss = loss_texts(windows).groupBy("conv_id").agg(
        F.array_join(F.sort_array(F.collect_list(F.struct("window", "text")))["text"], "").alias("loss")
    )
    over = (F.col("n_tokens") > budget) & ((F.col("n_new") > 1) | (F.col("n_history") > 0))
    size = windows.groupBy("conv_id").agg(
        F.sum(F.length("formatted")).alias("formatted_chars"), F.count_if(over).alias("n_over_budget")
    )
    return turns.join(loss, "conv_id").join(size, "conv_id").select(
        "conv_id",
        "n_turns",
        F.sha2("all", 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
        "n_over_budget",
    )
