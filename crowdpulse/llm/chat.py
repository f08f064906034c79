"""Chat text from the perspective of every participant, in Spark's own functions only.

A dialogue is rendered once per participant: that one speaks as assistant, all
others as named users, and the mask covers what the assistant says.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crowdpulse.llm.frames import cut, numbered

PART_TURNS = 64
SPEAKER, END = "<|", "<|end|>\n"


def _escaped(text: Column) -> Column:
    """A mark in what somebody says is broken, so that nobody can forge a turn."""
    return F.replace(text, F.lit(SPEAKER), F.lit("<\\|"))


def _head(role: Column, perspective: Column) -> Column:
    name = F.when(role == perspective, F.lit("assistant")).otherwise(
        F.concat(F.lit("user name="), F.replace(_escaped(role), F.lit("|>"), F.lit("|\\>")))
    )
    return F.concat(F.lit(SPEAKER), name, F.lit("|>\n"))


def rotate(conversations: DataFrame, part_turns: int = PART_TURNS) -> DataFrame:
    """(conv_id, perspective, part, n_turns, text, mask) for every participant.

    The parts of one rendering, in order, are its text: a part holds
    `part_turns` turns by their place in the dialogue, so a long one is never put
    together in one task, whatever its turns' numbers. mask lists the stretches
    start:end (code points inside the part, end exclusive) that the assistant
    says, its end mark included, joined by commas. Turns are ordered by
    number, null first, then speaker, then text; repeated rows are repeated
    turns. A null text is empty, a null role the speaker "unknown"; rows without
    a conv_id are one conversation. `<|` in a text or role is written `<\\|`, and
    `|>` in a role `|\\>`. Columns besides conv_id, turn, role and text don't take part.
    """
    turns = conversations.select(
        F.col("conv_id").cast("long"),
        F.col("turn").cast("long"),
        F.coalesce(F.col("role").cast("string"), F.lit("unknown")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    # Numbered by ranges, so no task or window holds a whole dialogue.
    group = F.coalesce(F.col("conv_id").cast("string"), F.lit(""))
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    placed = numbered(turns.withColumn("dialogue", group), "dialogue", order)
    turns = cut(placed.withColumn("part", F.expr(f"at div {int(part_turns)}")).drop("dialogue", "n"))
    speakers = turns.select("conv_id", F.col("role").alias("perspective")).distinct()
    own = turns.withColumnRenamed("conv_id", "c").join(
        speakers, F.col("c").eqNullSafe(F.col("conv_id"))
    )
    head = _head(F.col("role"), F.col("perspective"))
    said = own.select(
        "conv_id",
        "perspective",
        "part",
        F.struct(
            F.col("at"),
            F.col("role").alias("role"),
            F.concat(head, _escaped(F.col("text")), F.lit(END)).alias("shown"),
            F.length(head).alias("head"),
        ).alias("turn"),
    )
    grouped = said.groupBy("conv_id", "perspective", "part").agg(
        F.count("*").alias("n_turns"), F.sort_array(F.collect_list("turn")).alias("turns")
    )
    # Running ends of the turns, from which the stretches follow.
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("m"))

    def step(state: Column, turn: Column) -> Column:
        end = state["at"] + F.length(turn["shown"])
        span = F.concat_ws(":", (state["at"] + turn["head"]).cast("string"), end.cast("string"))
        mine = turn["role"] == F.col("perspective")
        return F.struct(
            end.alias("at"),
            F.when(mine, F.concat(state["m"], F.array(span))).otherwise(state["m"]).alias("m"),
        )

    masks = F.aggregate("turns", start, step, lambda state: F.array_join(state["m"], ","))
    return grouped.select(
        "conv_id",
        "perspective",
        "part",
        "n_turns",
        F.array_join(F.transform("turns", lambda turn: turn["shown"]), "").alias("text"),
        masks.alias("mask"),
    )


#: The same rows in SQL; part_turns is PART_TURNS.
ROTATE_SQL = f"""
WITH turns AS (
  SELECT conv_id, role, text, place, CAST(place // {PART_TURNS} AS BIGINT) AS part FROM (
    SELECT conv_id, role, text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS place
    FROM (SELECT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text
          FROM conversations))),
speakers AS (SELECT DISTINCT conv_id, role AS perspective FROM turns),
shown AS (
  SELECT t.conv_id, perspective, part, place, role, replace(text, '<|', '<\\|') AS text,
         '{SPEAKER}' || CASE WHEN role = perspective THEN 'assistant'
                             ELSE 'user name=' || replace(replace(role, '<|', '<\\|'), '|>', '|\\>') END
           || '|>' || chr(10) AS head
  FROM turns t JOIN speakers s ON t.conv_id IS NOT DISTINCT FROM s.conv_id),
whole AS (
  SELECT *, head || text || '{END.strip()}' || chr(10) AS line FROM shown),
placed AS (
  SELECT *, row_number() OVER w AS rank,
         CAST(sum(length(line)) OVER (w ROWS UNBOUNDED PRECEDING) AS BIGINT) AS stop
  FROM whole WINDOW w AS (PARTITION BY conv_id, perspective, part ORDER BY place))
SELECT conv_id, perspective, part, count(*) AS n_turns,
       string_agg(line, '' ORDER BY rank) AS text,
       coalesce(string_agg(
         CASE WHEN role = perspective
              THEN CAST(stop - length(line) + length(head) AS VARCHAR) || ':' || CAST(stop AS VARCHAR)
         END, ',' ORDER BY rank), '') AS mask
FROM placed GROUP BY conv_id, perspective, part
"""
