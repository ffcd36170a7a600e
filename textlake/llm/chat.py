"""Preference formatting of chosen and rejected conversations.

The turns that both conversations of a pair start with are rendered once, as the prompt; what
follows is rendered on either side as a completion, with the characters to learn from marked.
Everything up to the last step works on one row per turn, so no conversation is gathered before
its text is put together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What stands around a turn.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
LEARNED_ROLE = "assistant"


def render_turn(role: Column, text: Column) -> Column:
    """One turn; markers inside a text are broken up so that no text can open or close a turn."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    safe = F.replace(F.replace(text, F.lit("<|im_"), F.lit("<| im_")), F.lit("\r\n"), F.lit("\n"))
    return F.concat(F.lit(OPEN), role, F.lit("\n"), safe, F.lit(CLOSE + "\n"))


def preference_segments(turns: DataFrame) -> DataFrame:
    """``pair_id, part, turn, n, segment, learned_from, learned_to`` from turns of pairs.

    ``turns`` has ``pair_id, side, turn, role, text`` with side ``chosen`` or ``rejected``. Turns
    that share a number are taken in the order of role and text. The prompt ends before the first
    turn number at which the sides differ: in any role or text, in how often a turn is repeated,
    or because one side has no such turn. Null roles and texts equal each other and render as
    empty. Rows without pair, side or turn number take no part. ``learned_from`` and
    ``learned_to`` are the characters of the segment to learn from: text and closing marker of
    the assistant's turns in a completion, else nothing (both 0).
    """
    at = turns.filter("pair_id IS NOT NULL AND turn IS NOT NULL AND side IN ('chosen', 'rejected')")
    said = F.struct(F.coalesce("role", F.lit("")).alias("role"),
                    F.coalesce("text", F.lit("")).alias("text"))
    both = at.groupBy("pair_id", "turn").agg(
        F.sort_array(F.collect_list(F.when(F.col("side") == "chosen", said))).alias("chosen"),
        F.sort_array(F.collect_list(F.when(F.col("side") == "rejected", said))).alias("rejected"))
    split = both.groupBy("pair_id").agg(
        F.min(F.when(F.col("chosen") != F.col("rejected"), F.col("turn"))).alias("split"))
    placed = both.join(split.withColumnRenamed("pair_id", "of"), F.col("pair_id") == F.col("of"))
    common = F.col("split").isNull() | (F.col("turn") < F.col("split"))
    none = F.array().cast(both.schema["chosen"].dataType)
    parts = placed.select("pair_id", "turn", F.inline(F.array(
        F.struct(F.lit("prompt").alias("part"),
                 F.when(common, F.col("chosen")).otherwise(none).alias("said")),
        *[F.struct(F.lit(side).alias("part"),
                   F.when(common, none).otherwise(F.col(side)).alias("said"))
          for side in ("chosen", "rejected")])))
    rows = parts.select("pair_id", "part", "turn", F.posexplode("said").alias("n", "said"))
    segment = render_turn(F.col("said.role"), F.col("said.text"))
    learned = (F.col("part") != "prompt") & (F.col("said.role") == LEARNED_ROLE)
    header = F.length(F.concat(F.lit(OPEN), F.col("said.role"), F.lit("\n")))
    return rows.select(
        "pair_id", "part", "turn", "n", segment.alias("segment"),
        F.when(learned, header).otherwise(0).alias("learned_from"),
        F.when(learned, F.length(segment) - 1).otherwise(0).alias("learned_to"))


def _joined(part: str) -> tuple[Column, Column]:
    """Text of a part and its learned character spans ``[from, to)``."""
    own = F.sort_array(F.collect_list(F.when(F.col("part") == part, F.struct(
        "turn", "n", "segment", "learned_from", "learned_to"))))
    text = F.array_join(F.transform(own, lambda s: s["segment"]), "")
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<a:int,b:int>>").alias("s"))
    spans = F.aggregate(own, start, lambda done, s: F.struct(
        (done["at"] + F.length(s["segment"])).alias("at"),
        F.when(s["learned_to"] > 0, F.concat(done["s"], F.array(F.struct(
            (done["at"] + s["learned_from"]).alias("a"),
            (done["at"] + s["learned_to"]).alias("b"))))).otherwise(done["s"]).alias("s")),
        lambda done: done["s"])
    return text, spans


def format_preferences(turns: DataFrame) -> DataFrame:
    """One row per pair: ``prompt``, and text and learned spans of either completion.

    A pair whose sides are equal has empty completions. A side without turns gives an empty
    completion, and the whole of the other side is its completion. An empty table gives none.
    Nulls, ties and repeated turns are handled as in ``preference_segments``; texts of any length are
    rendered whole, all turns of a pair in one row. Other columns are not looked at.
    """
    parts = {part: _joined(part) for part in ("prompt", "chosen", "rejected")}
    return preference_segments(turns).groupBy("pair_id").agg(
        parts["prompt"][0].alias("prompt"),
        F.sum(F.when(F.col("part") == "prompt", 1).otherwise(0)).cast("long")
        .alias("n_prompt_turns"),
        *[column.alias(name) for part in ("chosen", "rejected")
          for column, name in zip(parts[part], (part, f"{part}_spans"))])


def shortened_replies(conversations: DataFrame) -> DataFrame:
    """Turns of pairs made from plain conversations.

    Chosen is the conversation as it is; in the rejected one the last turn of the assistant, and
    what follows it, is replaced by the first line of that turn, cut to its first half of words
    where it has one line only. Rows without conversation or turn number take no part.
    """
    rows = conversations.filter("conv_id IS NOT NULL AND turn IS NOT NULL")
    last = rows.filter(F.col("role") == LEARNED_ROLE).groupBy(F.col("conv_id").alias("of")).agg(
        F.max("turn").alias("last"))
    chosen = rows.select(F.col("conv_id").alias("pair_id"), F.lit("chosen").alias("side"),
                         "turn", "role", "text")
    words = F.split(F.col("text"), " ")
    shorter = F.when(F.instr("text", "\n") > 0, F.substring_index("text", "\n", 1)).otherwise(
        F.array_join(F.slice(words, 1, (F.size(words) / 2).cast("int")), " "))
    rejected = rows.join(last, F.col("conv_id") == F.col("of"), "left").filter(
        F.col("last").isNull() | (F.col("turn") <= F.col("last"))).select(
            F.col("conv_id").alias("pair_id"), F.lit("rejected").alias("side"), "turn", "role",
            F.when((F.col("turn") == F.col("last")) & (F.col("role") == LEARNED_ROLE), shorter)
            .otherwise(F.col("text")).alias("text"))
    return chosen.unionByName(rejected)


PREFERENCE_SQL = r"""
WITH c AS (SELECT * FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
l AS (SELECT conv_id, max(turn) AS last FROM c WHERE role = 'assistant' GROUP BY conv_id),
chosen AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM c),
rejected AS (
  SELECT c.conv_id, turn, coalesce(role, '') AS role, coalesce(CASE
    WHEN turn <> last OR role <> 'assistant' OR last IS NULL THEN text
    WHEN contains(text, chr(10)) THEN split_part(text, chr(10), 1)
    ELSE array_to_string((string_split(text, ' '))[1:len(string_split(text, ' ')) // 2], ' ')
    END, '') AS text
  FROM c LEFT JOIN l USING (conv_id) WHERE last IS NULL OR turn <= last),
split AS (
  SELECT conv_id, min(turn) FILTER (a.role IS DISTINCT FROM b.role
                                    OR a.text IS DISTINCT FROM b.text) AS split
  FROM chosen a FULL JOIN rejected b USING (conv_id, turn) GROUP BY conv_id),
said AS (
  SELECT conv_id, turn, 'chosen' AS side, role, text FROM chosen
  UNION ALL SELECT conv_id, turn, 'rejected', role, text FROM rejected),
parts AS (
  SELECT conv_id, turn, role, CASE WHEN split IS NULL OR turn < split THEN 'prompt' ELSE side END
      AS part, '<|im_start|>' || role || chr(10) || replace(replace(text, '<|im_', '<| im_'),
      chr(13) || chr(10), chr(10)) || '<|im_end|>' || chr(10) AS segment
  FROM said JOIN split USING (conv_id)
  WHERE side = 'chosen' OR NOT (split IS NULL OR turn < split)),
placed AS (SELECT *, sum(length(segment)) OVER (
    PARTITION BY conv_id, part ORDER BY turn) AS ends FROM parts),
spans AS (SELECT *, CASE WHEN part <> 'prompt' AND role = 'assistant' THEN
    (ends - length(segment) + length(role) + 13) || ':' || (ends - 1) END AS span FROM placed)
SELECT conv_id AS pair_id,
  coalesce(string_agg(segment, '' ORDER BY turn) FILTER (part = 'prompt'), '') AS prompt,
  count(*) FILTER (part = 'prompt') AS n_prompt_turns,
  coalesce(string_agg(segment, '' ORDER BY turn) FILTER (part = 'chosen'), '') AS chosen,
  coalesce(string_agg(segment, '' ORDER BY turn) FILTER (part = 'rejected'), '') AS rejected,
  coalesce(string_agg(span, ',' ORDER BY turn) FILTER (part = 'chosen'), '') AS chosen_spans,
  coalesce(string_agg(span, ',' ORDER BY turn) FILTER (part = 'rejected'), '') AS rejected_spans
FROM spans GROUP BY conv_id
"""
