"""Chat formatting by perspective rotation.

Every participant of a conversation gets a rendering of the whole dialogue in
which that speaker is the assistant, all others are users under their names, and
system turns stay system turns; the loss mask covers what the assistant says.

``render`` gives one row per turn and perspective with the rendered segment and
its place in the dialogue (a prefix sum), so a conversation of any length stays
spread over tasks; ``assemble`` puts segments together to texts and mask spans in
parts of bounded length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rekindle.llm.common import null_safe, written

START, END = "<|im_start|>", "<|im_end|>"
SYSTEM = ("system",)
UNNAMED = "unknown"


def header(speaker: Column, perspective: Column, system: tuple[str, ...]) -> Column:
    return F.concat(F.lit(START), F.when(speaker.isin(*system), F.lit("system"))
                    .when(speaker == perspective, F.lit("assistant"))
                    .otherwise(F.concat(F.lit("user name="), speaker)), F.lit("\n"))


def render(turns: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", speaker_col: str = "role",
           text_col: str = "text", system: tuple[str, ...] = SYSTEM) -> DataFrame:
    """(conv_id, perspective, turn, speaker, segment, start, mask_start, mask_end) per turn and perspective.

    ``start`` is the segment's first character in the dialogue; the mask (both
    ends equal where nothing is learned) covers the assistant's text and its end
    mark.  Turns go by number, then speaker, then text.

    Defined cases: a NULL text is empty; a NULL speaker is called ``unknown``;
    NULL turn numbers come first; NULL conversation ids are one conversation;
    turns repeated in full are each rendered; template marks inside a text are
    broken by a space; a conversation with system turns only has no perspective
    and no rows; an empty table gives an empty result; other columns are ignored.
    """
    text = F.replace(F.coalesce(F.col(text_col), F.lit("")), F.lit("<|im_"), F.lit("< |im_"))
    rows = turns.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"),
                        F.coalesce(F.col(speaker_col), F.lit(UNNAMED)).alias("speaker"), text.alias("body"))
    who = (rows.filter(~F.col("speaker").isin(*system)).select("conv_id", F.col("speaker").alias("perspective")).distinct())
    x = null_safe(rows, who, ["conv_id"])
    own = F.col("speaker") == F.col("perspective")
    head = header(F.col("speaker"), F.col("perspective"), system)
    x = x.select("conv_id", "perspective", "turn", "speaker", own.alias("own"), F.length(head).alias("n_head"),
                 F.concat(head, F.col("body"), F.lit(END + "\n")).alias("segment"))
    x = x.withColumn("n", F.length("segment").cast("long")).withColumn("order_hash", F.md5(F.col("segment").cast("binary")))
    # ranges over the whole order split a long conversation too; their numbers are kept with the rows
    key = ["conv_id", "perspective", "turn", "speaker", "order_hash"]
    x = written(x.repartitionByRange(*key).withColumn("rng", F.spark_partition_id()), "chat-segments")
    per_range = x.groupBy("conv_id", "perspective", "rng").agg(F.sum("n").alias("total"))
    before = (Window.partitionBy("conv_id", "perspective").orderBy("rng")
              .rowsBetween(Window.unboundedPreceding, -1))
    per_range = per_range.select("conv_id", "perspective", "rng", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    inside = (Window.partitionBy("conv_id", "perspective", "rng").orderBy("turn", "speaker", "order_hash")
              .rowsBetween(Window.unboundedPreceding, -1))
    x = null_safe(x.withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0))), per_range,
                  ["conv_id", "perspective", "rng"])
    start = F.col("base") + F.col("inside")
    learned = F.when(F.col("own"), F.col("n") - F.col("n_head") - 1).otherwise(0)  # without the last newline
    return x.select("conv_id", "perspective", "turn", "speaker", "segment", start.alias("start"),
                    (start + F.col("n_head")).alias("mask_start"), (start + F.col("n_head") + learned).alias("mask_end"))


def assemble(rendered: DataFrame, part_chars: int = 1 << 20) -> DataFrame:
    """(conv_id, perspective, part, text, masks): dialogues, cut between turns into parts of about ``part_chars``."""
    part = F.floor(F.col("start") / part_chars)
    s = F.sort_array(F.collect_list(F.struct("start", "segment", "mask_start", "mask_end")))
    x = rendered.groupBy("conv_id", "perspective", part.alias("part")).agg(s.alias("s"))
    spans = F.filter("s", lambda e: e["mask_end"] > e["mask_start"])
    return x.select("conv_id", "perspective", "part", F.get("s", F.lit(0))["start"].alias("start"),
                    F.array_join("s.segment", "").alias("text"),
                    F.transform(spans, lambda e: F.struct(e["mask_start"].alias("start"), e["mask_end"].alias("end")))
                    .alias("masks"))


def op9_query(turns: DataFrame) -> DataFrame:
    """Per conversation and perspective: turns, characters, learned characters, and a digest of segments at their places."""
    mark = F.concat_ws(":", "start", "mask_start", "mask_end", "segment")
    value = F.conv(F.substring(F.md5(mark.cast("binary")), 1, 12), 16, 10).cast("decimal(20,0)")
    return (render(turns).groupBy("conv_id", "perspective")
            .agg(F.count("*").alias("n_turns"), F.sum(F.length("segment")).alias("n_chars"),
                 F.sum(F.col("mask_end") - F.col("mask_start")).alias("learned_chars"),
                 F.sum(value).cast("string").alias("digest")))


ORACLE = f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '{UNNAMED}') AS speaker,
                  replace(coalesce(text, ''), '<|im_', '< |im_') AS body FROM conversations),
w AS (SELECT DISTINCT conv_id, speaker AS perspective FROM t WHERE speaker <> 'system'),
x AS (SELECT t.conv_id, perspective, turn, speaker, body,
             '{START}' || CASE WHEN speaker = 'system' THEN 'system' WHEN speaker = perspective THEN 'assistant'
                               ELSE 'user name=' || speaker END || chr(10) AS head
      FROM t JOIN w ON t.conv_id IS NOT DISTINCT FROM w.conv_id),
s AS (SELECT *, head || body || '{END}' || chr(10) AS segment FROM x),
p AS (SELECT *, CAST(coalesce(sum(length(segment)) OVER (PARTITION BY conv_id, perspective
        ORDER BY turn NULLS FIRST, speaker, md5(segment) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start FROM s),
m AS (SELECT *, start + length(head) AS mask_start,
             start + CASE WHEN speaker = perspective THEN length(segment) - 1 ELSE length(head) END AS mask_end FROM p)
SELECT conv_id, perspective, count(*) AS n_turns, CAST(sum(length(segment)) AS BIGINT) AS n_chars,
       CAST(sum(mask_end - mask_start) AS BIGINT) AS learned_chars,
       CAST(sum(CAST('0x' || substr(md5(start || ':' || mask_start || ':' || mask_end || ':' || segment), 1, 12) AS HUGEINT)) AS VARCHAR) AS digest
FROM m GROUP BY conv_id, perspective
"""
