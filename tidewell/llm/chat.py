"""Preference formatting of paired conversations, by DataFrame functions only.

Conversations 2n (chosen) and 2n + 1 (rejected) form pair n. Their longest common prefix of turns is rendered once, as
the prompt; the turns after it are the completions, with loss only on the assistant's turns. The result has a row per
rendered turn, so a conversation of any length is never gathered in one place; ordered by (turn, role, text) within a
part the rows concatenate to the text of that part.

A turn is common when both sides hold the same turns (role and text, null equal to null) at its number, as often, and
all smaller numbers are common too. Defined results: turns without a number come last and are never common with
anything before them uncommon; a null text renders as empty, a null role as "unknown"; repeated rows are rendered each;
a conversation without a partner has no prompt and only its own completion; rows with a null conv_id belong to no
conversation and are left out; an empty table gives an empty result. Columns other than conv_id, turn, role and text are not
read. The loss is per turn: the role's header and the end mark of an assistant's turn count too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALT = 8
LAST = (1 << 63) - 1


def preference_rows(conversations: DataFrame) -> DataFrame:
    """pair_id, part (prompt, chosen, rejected), turn, role, rendered, n_chars, loss (1 where the loss counts)."""
    turns = conversations.where("conv_id is not null").select(
        F.floor(F.col("conv_id") / 2).cast("long").alias("pair_id"), (F.pmod("conv_id", F.lit(2)) == 0).alias("chosen"),
        F.coalesce(F.col("turn").cast("long"), F.lit(LAST)).alias("at"), "turn", "role", "text",
    )
    # Turns of one number, role and text digest, counted on each side: what differs ends the common prefix.
    digest = F.xxhash64("role", "text", F.col("role").isNull(), F.col("text").isNull())
    sides = turns.groupBy("pair_id", "at", digest.alias("digest"), F.sha2("text", 256).alias("sha")).agg(F.sum(F.when(F.col("chosen"), 1).otherwise(-1)).alias("more"))
    cuts = sides.groupBy("pair_id").agg(F.min(F.when(F.col("more") != 0, F.col("at"))).alias("cut"))
    cuts = cuts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1)))).withColumnRenamed("pair_id", "p")
    salted = turns.withColumn("salt", F.pmod(F.hash("at"), F.lit(SALT)))
    both = salted.join(cuts, (salted["pair_id"] == cuts["p"]) & (salted["salt"] == cuts["salt"]))
    common = F.col("cut").isNull() | (F.col("at") < F.col("cut"))
    role = F.coalesce("role", F.lit("unknown"))
    rendered = F.concat(F.lit("<|"), role, F.lit("|>\n"), F.coalesce("text", F.lit("")), F.lit("<|end|>\n"))
    part = F.when(common, "prompt").when(F.col("chosen"), "chosen").otherwise("rejected")
    return both.where(~common | F.col("chosen")).select(
        "pair_id", part.alias("part"), "turn", role.alias("role"), rendered.alias("rendered"), F.length(rendered).cast("long").alias("n_chars"),
        F.when(~common & (role == "assistant"), 1).otherwise(0).alias("loss"),
    )
