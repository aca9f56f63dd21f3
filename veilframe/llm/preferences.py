"""Preference pairs for training on chat.

The turns of a chosen and a rejected conversation are laid side by side by position.  Those
before the first position where they differ are the prompt, rendered once; the rest of either
side is its completion.  Only what an assistant says in a completion carries loss.

The result has one row for each rendered turn, so that a conversation of any length is never
gathered in one place; places in the rendered text are running sums in two levels (blocks of
turns, then turns of a block).

Defined cases: turns go by number (null last), then role, then text, so ties and repeated rows
have a fixed order; a null role or text differs from an empty one and is rendered as empty; a
null pair id is a pair like any other; a pair that has one side only has an empty prompt; two
equal sides give a prompt and no completion; an empty table gives no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veilframe.llm.shared import stored, with_following

#: Turns of a block of running sums.
BLOCK = 256
#: What stands before, between and after role and text of a rendered turn.
MARKS = ("<|im_start|>", "\n", "<|im_end|>\n")
ASSISTANT = "assistant"


def _running(df: DataFrame, keys: list[str], block: str, order: list[Column], amount: Column, name: str) -> DataFrame:
    """Add ``name``: the sum of ``amount`` over the rows of ``keys`` before this one."""
    df = df.withColumn("run_amount", amount)
    blocks = df.groupBy(*keys, block).agg(F.sum("run_amount").alias("run_sum"))
    by_block = Window.partitionBy(*keys).orderBy(F.col(block).asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(
        *[F.col(k).alias(f"run_{n}") for n, k in enumerate([*keys, block])],
        F.coalesce(F.sum("run_sum").over(by_block), F.lit(0)).alias("run_before"),
    )
    same = [F.col(k).eqNullSafe(F.col(f"run_{n}")) for n, k in enumerate([*keys, block])]
    inside = Window.partitionBy(*keys, block).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    joined = df.withColumn("run_inside", F.coalesce(F.sum("run_amount").over(inside), F.lit(0))).join(blocks, _all(same))
    drop = ["run_amount", "run_before", "run_inside", *[f"run_{n}" for n in range(len(keys) + 1)]]
    return joined.withColumn(name, (F.col("run_before") + F.col("run_inside")).cast("long")).drop(*drop)


def _all(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def preference_rows(chosen: DataFrame, rejected: DataFrame, marks: tuple[str, str, str] = MARKS) -> DataFrame:
    """pair_id, part (prompt, chosen, rejected), nth, role, rendered, start, end, loss_start, loss_end.

    Both inputs have pair_id, turn, role, text.  ``nth`` counts the turns of a side from 0;
    places count code points from the start of prompt and completion as one text, the end is
    exclusive; ``loss_*`` is null where a turn carries no loss.
    """
    columns = ["pair_id", "turn", "role", "text"]
    sides = chosen.select(*columns, F.lit("chosen").alias("side")).unionByName(rejected.select(*columns, F.lit("rejected").alias("side")))
    sides = sides.withColumn("block", F.floor(F.col("turn") / BLOCK))
    order = [F.col(c).asc_nulls_last() for c in ("turn", "role", "text")]
    turns = stored(_running(stored(sides, "sides"), ["pair_id", "side"], "block", order, F.lit(1), "nth").drop("block", "turn"), "turns")

    # the first position where the sides differ, or where one ends
    said = F.sha2(F.to_json(F.struct("role", "text")), 256)
    at = turns.withColumn("said", said).groupBy("pair_id", "nth").agg(F.count("*").alias("n"), F.min("said").alias("a"), F.max("said").alias("b"))
    differs = (F.col("n") < 2) | (F.col("a") != F.col("b"))
    common = at.groupBy(F.col("pair_id").alias("p")).agg(F.coalesce(F.min(F.when(differs, F.col("nth"))), F.max("nth") + 1).alias("common"))
    turns = turns.join(common, F.col("pair_id").eqNullSafe(F.col("p"))).drop("p")
    turns = turns.where((F.col("side") == "chosen") | (F.col("nth") >= F.col("common")))
    part = F.when(F.col("nth") < F.col("common"), "prompt").otherwise(F.col("side"))

    head = F.concat(F.lit(marks[0]), F.coalesce("role", F.lit("")), F.lit(marks[1]))
    rendered = F.concat(head, F.coalesce("text", F.lit("")), F.lit(marks[2]))
    turns = turns.select("pair_id", part.alias("part"), "nth", "role", F.length(head).alias("head"), rendered.alias("rendered"))
    turns = stored(turns.withColumn("size", F.length("rendered")).withColumn("block", F.floor(F.col("nth") / BLOCK)), "rendered")
    turns = _running(turns, ["pair_id", "part"], "block", [F.col("nth")], F.col("size"), "start")
    prompts = turns.where("part = 'prompt'").groupBy(F.col("pair_id").alias("p")).agg(F.sum("size").alias("prompt"))
    turns = turns.join(prompts, F.col("pair_id").eqNullSafe(F.col("p")), "left")
    start = F.col("start") + F.when(F.col("part") != "prompt", F.coalesce("prompt", F.lit(0))).otherwise(0)
    loss = (F.col("part") != "prompt") & (F.col("role") == ASSISTANT)
    return turns.withColumn("start", start).select(
        "pair_id",
        "part",
        "nth",
        "role",
        "rendered",
        "start",
        (F.col("start") + F.col("size")).alias("end"),
        F.when(loss, F.col("start") + F.col("head")).alias("loss_start"),
        F.when(loss, F.col("start") + F.col("size")).alias("loss_end"),
    )


def swapped_answers(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Chosen and rejected turns for data without preferences.

    Chosen is each conversation; rejected is the same with its last answer replaced by the
    last answer of the conversation with the next id that has one (empty if there is none).  Answers on
    one turn number count as one.
    """
    turns = conversations.select(F.col("conv_id").alias("pair_id"), "turn", "role", "text")
    last = turns.where(F.col("role") == ASSISTANT).groupBy("pair_id").agg(F.max(F.struct("turn", "text")).alias("last"))
    known = last.where("pair_id IS NOT NULL").select("pair_id", "last.turn", F.coalesce("last.text", F.lit("")).alias("said"))
    swap = with_following(known, "pair_id", "said", "other").select("pair_id", "turn", "other")
    swap = swap.union(last.where("pair_id IS NULL").select("pair_id", "last.turn", F.lit(None).cast("string")))
    swap = swap.select(F.col("pair_id").alias("p"), F.col("turn").alias("t"), F.coalesce("other", F.lit("")).alias("other"))
    both = turns.join(swap, F.col("pair_id").eqNullSafe(F.col("p")), "left")
    answer = (F.col("role") == ASSISTANT) & F.col("turn").eqNullSafe(F.col("t")) & F.col("other").isNotNull()
    return turns, both.select("pair_id", "turn", "role", F.when(answer, F.col("other")).otherwise(F.col("text")).alias("text"))
