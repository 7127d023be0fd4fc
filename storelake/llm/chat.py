"""Chat formatting: logged snapshots of one conversation collapse into the longest, which is rendered."""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from storelake.sinks.files import stored

START, END = "<|im_start|>", "<|im_end|>"


def _role() -> Column:
    return F.coalesce("role", F.lit("none"))


def _text() -> Column:
    return F.coalesce("text", F.lit(""))


def maximal_conversations(turns: DataFrame) -> DataFrame:
    """``conv_id`` of the conversations that are no prefix of a longer one; of equal ones the smallest.

    Every turn has two 64-bit hashes of its place, role and text, whose running sums over a conversation are the hashes
    of its prefixes. The hash of a whole conversation is then sought among those of the proper prefixes of all others.
    Both sides are first reduced to distinct hashes, so that turns that open very many conversations count once.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")  # as rendered: equal turns go by their texts
    whole_rows = turns.select("conv_id", "turn", _role().alias("role"), _text().alias("text"))
    placed = whole_rows.withColumn("place", F.row_number().over(order)).select(
        "conv_id", "place", F.xxhash64("text").alias("text_hash"), F.xxhash64("text", "role").alias("role_hash")
    )
    order = Window.partitionBy("conv_id").orderBy("place")
    ahead = order.rowsBetween(Window.unboundedPreceding, 0)
    each = [F.xxhash64("place", "role_hash", "text_hash"), F.xxhash64("text_hash", "place", "role_hash")]
    prefixes = stored(
        placed.select(
            "conv_id",
            "place",
            *[F.sum(h.cast("decimal(20,0)")).over(ahead).alias(f"h{k}") for k, h in enumerate(each)],
            F.lead("place").over(order).isNull().alias("whole"),
        )
    )
    key = ["place", "h0", "h1"]
    whole = prefixes.filter("whole").groupBy(*key).agg(F.min("conv_id").alias("conv_id"))
    proper = prefixes.filter("not whole").select(*key).distinct()
    return whole.join(proper, key, "left_anti").select("conv_id")


def render(turns: DataFrame) -> DataFrame:
    """``conv_id``, ``n_turns`` and ``rendered`` for each maximal conversation.

    Turns are ordered by ``turn`` (null first), then role and text, and repeated rows are turns of their own. A null
    role is rendered as ``none`` and a null text as an empty one. Rows without a conv_id belong to no conversation and are
    left out. A conversation is rendered as one string, so it has to fit a task. Other columns are ignored.
    """
    own = turns.filter("conv_id is not null").select("conv_id", "turn", "role", "text")
    kept = stored(maximal_conversations(own))
    turn = F.struct("turn", _role().alias("role"), _text().alias("text"))
    listed = own.join(kept, "conv_id", "left_semi").groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    one = lambda t: F.concat(F.lit(START), t["role"], F.lit("\n"), t["text"], F.lit(f"{END}\n"))
    return listed.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.array_join(F.transform("turns", one), "").alias("rendered")
    )


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All maximal conversations, rendered."""
    return render(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


ORACLE = f"""
WITH logged AS (
  SELECT conv_id,
         list('{START}' || coalesce(role, 'none') || chr(10) || coalesce(text, '') || '{END}' || chr(10)
              ORDER BY turn NULLS FIRST, coalesce(role, 'none'), coalesce(text, '')) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
),
whole AS (SELECT turns, min(conv_id) AS conv_id FROM logged GROUP BY turns),
proper AS (SELECT DISTINCT turns[1:k] AS turns FROM (SELECT turns, unnest(range(1, len(turns))) AS k FROM logged))
SELECT conv_id, len(turns)::bigint AS n_turns, array_to_string(turns, '') AS rendered
FROM whole WHERE NOT EXISTS (SELECT 1 FROM proper WHERE proper.turns = whole.turns)
"""
