"""Preference formatting: one prompt and two masked completions from a chosen and a rejected conversation.

The longest common turn prefix is found turn by turn with a join and an aggregate, so no conversation has to fit a
task for it. Turns are rendered where they are and put together in two steps, blocks of turns first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Turns put together in the first step.
BLOCK_TURNS = 64
# Fixed values of the rendered format.
START, END = "<|im_start|>", "<|im_end|>"
TRAINED_ROLE = "assistant"
SPANS = "array<struct<start:bigint,end:bigint>>"


def render_turn(role: Column, text: Column) -> tuple[Column, Column, Column]:
    """Head, body and tail of a rendered turn; the loss covers body and end mark of the trained role."""
    return F.concat(F.lit(START), role, F.lit("\n")), F.concat(text, F.lit(END)), F.lit("\n")


def _numbered(turns: DataFrame) -> DataFrame:
    """Turns with a place that is unique in the conversation, also when a turn number is repeated or null."""
    clean = turns.select(
        "pair_id",
        F.coalesce(F.col("turn").cast("long"), F.lit((1 << 63) - 1)).alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).where("pair_id IS NOT NULL")
    repeated = Window.partitionBy("pair_id", "turn").orderBy("role", "text")
    return clean.withColumn("again", F.row_number().over(repeated))


def common_prefix(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """Per pair_id found on both sides, the first place (turn, again) at which they differ; null if they never do."""
    a, b = chosen.alias("a"), rejected.alias("b")
    keys = ["pair_id", "turn", "again"]
    met = a.join(b, keys, "full_outer")
    same = (F.col("a.role") == F.col("b.role")) & (F.col("a.text") == F.col("b.text"))
    return met.groupBy("pair_id").agg(
        F.min(F.when(~F.coalesce(same, F.lit(False)), F.struct("turn", "again"))).alias("fork"),
        F.count("a.role").alias("n_chosen"),
        F.count("b.role").alias("n_rejected"),
        F.count(F.when(same, 1)).alias("n_same"),
    ).where("n_chosen > 0 AND n_rejected > 0")


def format_pairs(chosen: DataFrame, rejected: DataFrame, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """One row per pair: the prompt, both completions, and the spans of either that are trained on.

    Inputs have pair_id, turn, role, text; other columns are ignored. The prompt is the longest run of equal leading
    turns, rendered once; each completion is the rest of its side. Spans are [start, end) in characters of the
    completion and cover texts and end marks of the assistant. Null roles and texts count as empty, rows with a null
    pair_id belong to no pair, null turns come last, and of equal turn numbers each is a turn, by role and text. Pairs
    on one side only have no row. A completion may be empty. ``n_prefix`` counts the common turns.
    """
    a, b = _numbered(chosen), _numbered(rejected)
    forks = common_prefix(a, b)
    sides = a.withColumn("side", F.lit("chosen")).unionByName(b.withColumn("side", F.lit("rejected")))
    # The place of a fork is a few bytes, so meeting by pair lets Spark split the turns of a long conversation.
    placed = sides.join(forks.select("pair_id", "fork", "n_chosen", "n_rejected"), "pair_id")
    shared = F.col("fork").isNull() | (F.struct("turn", "again") < F.col("fork"))
    head, body, tail = render_turn(F.col("role"), F.col("text"))
    pieces = placed.where(~shared | (F.col("side") == "chosen")).select(
        "pair_id",
        F.when(shared, "prompt").otherwise(F.col("side")).alias("part"),
        "turn",
        "again",
        F.concat(head, body, tail).alias("piece"),
        F.when(
            ~shared & (F.col("role") == TRAINED_ROLE),
            F.struct(F.length(head).cast("long").alias("start"), (F.length(head) + F.length(body)).cast("long").alias("end")),
        ).alias("span"),
        F.lit(1).alias("n"),
    )
    blocks = _joined(
        pieces.groupBy("pair_id", "part", F.floor(F.col("turn") / block_turns).alias("block")),
        F.struct(
            "turn",
            "again",
            "piece",
            F.when(F.col("span").isNull(), F.array().cast(SPANS)).otherwise(F.array("span")).alias("spans"),
        ),
    )
    parts = _joined(blocks.groupBy("pair_id", "part"), F.struct("block", F.lit(0).alias("again"), "piece", "spans"))
    pick = lambda part, col: F.max_by(col, F.when(F.col("part") == part, 1))
    none = F.array().cast(SPANS)
    return parts.groupBy("pair_id").agg(
        F.coalesce(pick("prompt", "piece"), F.lit("")).alias("prompt"),
        F.sum(F.when(F.col("part") == "prompt", F.col("n")).otherwise(0)).alias("n_prefix"),
        F.coalesce(pick("chosen", "piece"), F.lit("")).alias("chosen"),
        F.coalesce(pick("rejected", "piece"), F.lit("")).alias("rejected"),
        F.coalesce(pick("chosen", "spans"), none).alias("chosen_spans"),
        F.coalesce(pick("rejected", "spans"), none).alias("rejected_spans"),
    )


def _joined(grouped, entry: Column) -> DataFrame:
    """Pieces of a group in order as one text, their spans moved to their places in it, and the number of turns."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(SPANS).alias("spans"))
    moved = F.aggregate(
        "entries",
        start,
        lambda done, x: F.struct(
            (done["at"] + F.length(x["piece"])).alias("at"),
            F.concat(
                done["spans"],
                F.transform(
                    x["spans"],
                    lambda p: F.struct((p["start"] + done["at"]).alias("start"), (p["end"] + done["at"]).alias("end")),
                ),
            ).alias("spans"),
        ),
    )
    listed = grouped.agg(F.array_sort(F.collect_list(entry)).alias("entries"), F.sum("n").alias("n"))
    return listed.withColumns({"piece": F.array_join("entries.piece", ""), "spans": moved["spans"]}).drop("entries")


def pairs_of(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Chosen and rejected sides derived from ``conversations``, one pair per conversation with an assistant turn.

    Chosen is the conversation itself. Rejected is its turns before the last assistant turn, which is then answered with
    the last assistant turn of the conversation with the next id, or not at all if there is none.
    """
    rows = conversations.select(F.col("conv_id").alias("pair_id"), "turn", "role", "text").where("pair_id IS NOT NULL")
    last = rows.where(F.col("role") == TRAINED_ROLE).groupBy("pair_id").agg(
        F.max(F.struct(F.col("turn"), F.col("text"))).alias("last")
    )
    other = last.select((F.col("pair_id") - 1).alias("pair_id"), F.col("last.text").alias("text"))
    chosen = rows.join(last.select("pair_id"), "pair_id", "left_semi")
    kept = rows.join(last.select("pair_id", F.col("last.turn").alias("cut")), "pair_id").where("turn < cut").drop("cut")
    answers = last.join(other, "pair_id").select("pair_id", "last.turn", F.lit(TRAINED_ROLE).alias("role"), "text")
    ends = kept.unionByName(answers)
    return chosen, ends
