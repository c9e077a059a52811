"""Chat formatting in budgeted windows (DataFrame functions only).

A turn costs its words plus two tokens for its marks. Prefix sums of the costs place every turn on
the conversation's token axis, which is ruled in strides of a quarter of the budget: the turns that
start in one stride are one span of new turns. A span over half the budget gives its last turn (the
only one that can reach out of the stride) a window of its own, so the new turns of a window take at
most half the budget, unless one turn alone is longer; such a turn is kept whole in a window of its
own. Before its new turns a window repeats the conversation's system turn and as many of the turns
just before the span as fit the history allowance and what the span leaves of its half.

The system turn is the first turn where its role is ``system`` and it costs at most half the budget
(a longer one is an ordinary turn: repeating it would leave no room). Only new assistant turns are
under the loss mask, so every assistant text is a target exactly once.

Template: ``### role:\\n`` text ``</turn>\\n``. Inside a text or role, ``\\`` is doubled, and a
backslash goes into every ``###`` (after the first ``#``), into ``</turn>`` (after ``<``) and, in roles,
between ``:`` and a line feed; ``unescape`` undoes it. Thus the marks occur only as marks.

Edge cases: a null role or text is empty; rows without conversation id form one conversation (null);
turns are ordered by number, null first, equal numbers by MD5 of role and text; repeated rows
are turns of their own; an empty table gives no windows; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepool.llm.common import WORD, materialize
from tidepool.llm.turn_order import conversation_key, number_rows, sums_before, turn_digest

BUDGET = 2048
HISTORY = 512
TURN_MARKS = 2
HEAD, HEAD_END, TURN_END = "### ", ":\n", "</turn>\n"
SYSTEM, ASSISTANT = "system", "assistant"
#: Windows of one conversation that share one copy of the system turn in the shuffle.
SYSTEM_BLOCK = 256


def escape(text: Column, in_role: bool = False) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    out = F.regexp_replace(out, "#(?=##)", r"#\\")
    out = F.replace(out, F.lit("</turn>"), F.lit("<\\/turn>"))
    return F.replace(out, F.lit(":\n"), F.lit(":\\\n")) if in_role else out


def unescape(text: Column) -> Column:
    """The original of an escaped string: a backslash pair is one, a single one is dropped."""
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def turn_cost(text: str) -> Column:
    return (F.regexp_count(F.col(text), F.lit(WORD)) + TURN_MARKS).cast("bigint")


def place_turns(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn",
                role: str = "role", text: str = "text") -> DataFrame:
    """Turns with ``_cost`` and ``_at``, the tokens before them in their conversation."""
    role_col, text_col = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    rows = number_rows(conversations.select(
        F.col(conv_id).alias("conv_id"), conversation_key(conv_id).alias("_key"),
        F.col(turn).cast("bigint").alias("_turn"), role_col.alias("_role"), text_col.alias("_text"),
        turn_digest(role_col, text_col).alias("_md5")).withColumn("_cost", turn_cost("_text")))
    return rows.join(sums_before(rows, F.col("_cost"), "_at"), "_uid", "inner")


def _spans(turns: DataFrame, budget: int) -> DataFrame:
    """Narrow turns with ``_cell`` and ``_window`` (twice the cell, plus one for a split-off turn)."""
    stride = budget // 4
    cell = Window.partitionBy("_key", "_cell")
    narrow = turns.select("_uid", "_key", "_at", "_cost", (F.col("_role") == SYSTEM).alias("_is_system"),
                          F.floor(F.col("_at") / F.lit(stride)).alias("_cell"))
    split = (F.sum("_cost").over(cell) > budget // 2) & (F.col("_at") == F.max("_at").over(cell)) \
        & (F.col("_at") > F.min("_at").over(cell))
    return narrow.withColumn("_window", F.col("_cell") * 2 + split.cast("bigint"))


def window_members(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """(key, window, uid, place, repeated): which turns stand in which window, in order of place."""
    if budget < 8 or not 0 <= history <= budget // 4:
        raise ValueError("budget must be at least 8 and history at most a quarter of it")
    stride = budget // 4
    spans = materialize(_spans(turns, budget))
    windows = materialize(spans.groupBy("_key", "_cell", "_window").agg(
        F.min("_at").alias("_start"), F.sum("_cost").alias("_new"))
        .withColumn("_room", F.greatest(F.least(F.lit(history), budget // 2 - F.col("_new")), F.lit(0))))
    kept = (F.col("_at") == 0) & F.col("_is_system") & (F.col("_cost") <= budget // 2)
    own = spans.select("_key", "_window", "_uid", F.col("_at").alias("_place"), F.lit(False).alias("_again"))
    end = F.col("_at") + F.col("_cost")
    near = spans.where(~kept & (F.col("_cost") <= history)) \
        .withColumn("_cell", F.explode(F.sequence(F.floor(end / F.lit(stride)),
                                                  F.floor((F.col("_at") + history) / F.lit(stride))))) \
        .select("_key", "_cell", "_uid", "_at", "_cost")
    past = near.join(windows, ["_key", "_cell"], "inner") \
        .where((end <= F.col("_start")) & (F.col("_start") - F.col("_at") <= F.col("_room"))) \
        .select("_key", "_window", "_uid", F.col("_at").alias("_place"), F.lit(True).alias("_again"))
    system = spans.where(kept).select("_key", "_uid")
    # the first window holds the system turn as a new one; its window number is 0
    lead = windows.where("_window > 0").select("_key", "_window").join(system, "_key", "inner") \
        .select("_key", "_window", "_uid", F.lit(-1).cast("bigint").alias("_place"), F.lit(True).alias("_again"))
    return own.unionByName(past).unionByName(lead)


def _with_texts(members: DataFrame, turns: DataFrame) -> DataFrame:
    """Members with role and text. A system turn may stand in any number of windows, so its text is
    copied once per block of windows and joined by (turn, block)."""
    block = F.when(F.col("_place") < 0, F.floor(F.col("_window") / F.lit(SYSTEM_BLOCK)) + 1) \
        .otherwise(F.lit(0).cast("bigint"))
    members = materialize(members.withColumn("_block", block))
    texts = turns.select("_uid", "conv_id", "_role", "_text")
    blocks = members.where("_block > 0").select("_uid", "_block").distinct()
    copies = texts.join(blocks, "_uid", "inner").unionByName(texts.withColumn("_block", F.lit(0).cast("bigint")))
    return members.join(copies, ["_uid", "_block"], "inner")


def chat_windows(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY, **names) -> DataFrame:
    """One row per window: ``conv_id, window`` (ascending, not dense), ``formatted``, ``n_repeated`` (turns that
    open the window and were in an earlier one), ``n_new``, ``n_tokens`` and ``loss_spans``, an array
    of (start, length) in code points of ``formatted``. ``names`` are those of the input columns."""
    turns = materialize(place_turns(conversations, **names))
    members = _with_texts(window_members(turns, budget, history), turns)
    head = F.concat(F.lit(HEAD), escape(F.col("_role"), in_role=True), F.lit(HEAD_END))
    body = escape(F.col("_text"))
    pieces = members.select("conv_id", "_key", "_window", "_place", "_again", head.alias("_head"), body.alias("_body"),
                            (F.regexp_count("_text", F.lit(WORD)) + TURN_MARKS).alias("_cost"),
                            ((F.col("_role") == ASSISTANT) & ~F.col("_again")).alias("_target"))
    pieces = pieces.withColumn("_piece", F.concat("_head", "_body", F.lit(TURN_END)))
    before = Window.partitionBy("_key", "_window").orderBy("_place") \
        .rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum(F.char_length("_piece")).over(before), F.lit(0).cast("bigint"))
    span = F.when(F.col("_target"), F.struct((F.col("_offset") + F.char_length("_head")).alias("start"),
                                             F.char_length("_body").cast("bigint").alias("length")))
    placed = pieces.withColumn("_offset", offset)
    out = placed.groupBy("_key", "_window").agg(
        F.first("conv_id").alias("conv_id"),
        F.sort_array(F.collect_list(F.struct("_place", "_piece"))).alias("_pieces"),
        F.sum(F.col("_again").cast("bigint")).alias("n_repeated"), F.count(F.lit(1)).alias("_n"),
        F.sum("_cost").cast("bigint").alias("n_tokens"),
        F.sort_array(F.collect_list(span)).alias("loss_spans"))
    return out.select("conv_id", F.col("_window").alias("window"),
                      F.array_join(F.transform("_pieces", lambda p: p["_piece"]), "").alias("formatted"),
                      "n_repeated", (F.col("_n") - F.col("n_repeated")).alias("n_new"), "n_tokens", "loss_spans")


def read_turns(windows: DataFrame) -> DataFrame:
    """Parse formatted windows: per window ``turns`` (array of role, text; the new ones, unescaped) and
    ``targets`` (array of the texts under the loss mask, unescaped)."""
    parts = F.slice(F.split("formatted", TURN_END, -1), F.col("n_repeated").cast("int") + 1, F.col("n_new").cast("int"))
    def parse(part: Column) -> Column:
        at = F.instr(part, HEAD_END)
        return F.struct(unescape(F.substring(part, F.lit(len(HEAD) + 1), at - len(HEAD) - 1)).alias("role"),
                        unescape(F.substring(part, at + len(HEAD_END), F.char_length(part))).alias("text"))
    def target(span: Column) -> Column:
        return unescape(F.substring(F.col("formatted"), (span["start"] + 1).cast("int"), span["length"].cast("int")))
    return windows.withColumn("turns", F.transform(parts, parse)) \
        .withColumn("targets", F.transform("loss_spans", target))


def digest(windows: DataFrame) -> DataFrame:
    """Per conversation, from the parsed windows: turns, loss text and size of the formatted text.
    A digest takes the conversation's text as one value."""
    read = read_turns(windows)
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    parts = read.groupBy(conversation_key("conv_id").alias("_key")).agg(
        F.first("conv_id").alias("conv_id"),
        F.sum(F.size("turns")).cast("bigint").alias("n_turns"),
        F.sort_array(F.collect_list(F.struct("window", said.alias("said"),
                                             F.array_join("targets", "").alias("loss")))).alias("_w"),
        F.sum(F.char_length("formatted")).cast("bigint").alias("formatted_chars"),
        F.count(F.lit(1)).alias("n_windows"))
    whole = lambda field: F.array_join(F.transform("_w", lambda w: w[field]), "")
    return parts.select("conv_id", "n_turns", F.sha2(whole("said"), 256).alias("turns_sha256"),
                        F.char_length(whole("loss")).cast("bigint").alias("loss_chars"),
                        F.sha2(whole("loss"), 256).alias("loss_sha256"), "formatted_chars", "n_windows")
