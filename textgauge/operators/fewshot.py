"""Few-shot prompts from conversations.

What a prompt needs lies a few turns before it, wherever turn numbers have
gaps. Conversations are therefore cut into blocks by turn number. The last
turns of each block are few; carried to the block after it, they let one
shuffle by (conversation, block) serve all look-backs. A conversation that
holds a third of all rows is spread over its blocks; only its blocks' last
turns are ordered together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Turn numbers per block.
BLOCK_TURNS = 256

KEYS = ("conv_id", "block")
PLACE = ("turn", "role", "text")


def build_prompt(system: Column, user: Column, shots: Column, created: Column, prompt_id: Column) -> Column:
    """One prompt record from its parts; system and user text are trimmed."""
    return F.struct(
        prompt_id.alias("id"),
        F.trim(system).alias("system"),
        shots.alias("shots"),
        F.trim(user).alias("user"),
        created.alias("created"),
    )


def in_blocks(turns: DataFrame) -> DataFrame:
    return turns.select("conv_id", *PLACE, F.floor(F.col("turn") / BLOCK_TURNS).alias("block"))


def with_earlier(turns: DataFrame, back: int) -> DataFrame:
    """Each turn in its block (``own``), and the ``back`` turns before the block."""
    blocks = in_blocks(turns)
    backwards = Window.partitionBy(*KEYS).orderBy(*[F.desc(c) for c in PLACE])
    last = blocks.withColumn("_place", F.row_number().over(backwards)).where(F.col("_place") <= back)
    tails = last.groupBy(*KEYS).agg(F.array_sort(F.collect_list(F.struct(*PLACE))).alias("tail"))
    # a block has a turn at least, so so many blocks before it hold enough turns
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(-back, -1)
    earlier = F.flatten(F.collect_list("tail").over(before))
    carried = tails.select(*KEYS, earlier.alias("tail")).select(
        *KEYS, F.inline(F.slice("tail", F.greatest(F.size("tail") - back, F.lit(0)) + 1, back))
    )
    return blocks.withColumn("own", F.lit(True)).unionByName(carried.withColumn("own", F.lit(False)))


def turn_before(turns_back: int, role: str, column: str = "text") -> Column:
    """A column of the turn so many places back, if that has the role."""
    place = Window.partitionBy(*KEYS).orderBy(*PLACE)
    return F.lag(F.when(F.col("role") == role, F.col(column)), turns_back).over(place)


def shot_pairs(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, q, a): a user turn and the next turn, if the assistant's."""
    answered = with_earlier(turns, 1).select("*", turn_before(1, "user").alias("q"), turn_before(1, "user", "turn").alias("asked"))
    return answered.where("role = 'assistant' AND own AND asked IS NOT NULL").select(
        "conv_id", F.col("asked").alias("turn"), "q", F.col("text").alias("a")
    )


def system_texts(turns: DataFrame) -> DataFrame:
    """The first system turn of each conversation that has one."""
    return turns.where("role = 'system'").groupBy("conv_id").agg(F.min_by("text", "turn").alias("system"))


def few_shot_prompts(turns: DataFrame, shots: int = 2, default_system: str = "", created: str = "") -> DataFrame:
    """A prompt for each user turn, with the exchanges just before it as shots.

    ``shots`` is how many earlier exchanges a prompt shows, oldest first.
    """
    looked_back = with_earlier(turns, max(1, 2 * shots))
    for k in range(1, shots + 1):
        looked_back = looked_back.withColumns(
            {f"_q{k}": turn_before(2 * k, "user"), f"_a{k}": turn_before(2 * k - 1, "assistant")}
        )
    shown = [
        F.when(
            F.col(f"_q{k}").isNotNull() & F.col(f"_a{k}").isNotNull(),
            F.struct(F.col(f"_q{k}").alias("q"), F.col(f"_a{k}").alias("a")),
        )
        for k in range(shots, 0, -1)
    ]
    listed = F.array_compact(F.array(*shown)) if shown else F.expr("CAST(array() AS array<struct<q:string,a:string>>)")
    record = build_prompt(
        F.coalesce(F.col("system"), F.lit(default_system)),
        F.col("text"),
        listed,
        F.lit(created),
        F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")),
    )
    asked = looked_back.where("role = 'user' AND own")
    # the system text goes to each block first, so the join's key is as spread as the turns
    placed = in_blocks(turns.where("role = 'user'")).select(*KEYS).distinct().join(system_texts(turns), "conv_id")
    return asked.join(placed, [*KEYS], "left").select("conv_id", "turn", record.alias("p")).select("conv_id", "turn", "p.*")
