"""Preference formatting: the turns that chosen and rejected conversations share from their start are rendered once, as
the prompt; what follows in each is a completion, with the spans that count for the loss (the assistant's words)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TURN = "concat('<|', t.role, '|>\\n', t.text, '\\n')"


def formatted(pairs: DataFrame) -> DataFrame:
    """Rows (pair_id, n_prompt_turns, prompt, chosen, rejected, chosen_spans, rejected_spans) from (pair_id, chosen,
    rejected), the latter two arrays of (role, text).

    Spans are ``start:end`` in characters of the completion, comma-joined: the texts of the assistant's turns; all else
    is masked. Null arrays are empty, a null role is ``none``, a null text empty. Equal conversations leave two empty
    completions. Repeated pairs are formatted each. An empty table gives no rows.
    """
    plain = "transform(coalesce({0}, array()), t -> struct(coalesce(t.role, 'none') as role, coalesce(t.text, '') as text))"
    rows = pairs.select("pair_id", *[F.expr(plain.format(c)).alias(c) for c in ("chosen", "rejected")])
    shared = "coalesce(nullif(array_position(transform(arrays_zip(slice(chosen, 1, both), slice(rejected, 1, both)), z -> z.`0` = z.`1`), false), 0) - 1, both)"
    rows = rows.withColumn("both", F.expr("least(size(chosen), size(rejected))")).withColumn("n_prompt_turns", F.expr(shared).cast("long"))
    rendered = "array_join(transform({0}, t -> " + TURN + "), '')"
    # the running offset and the spans so far; a turn's words start after its header and end before the line feed
    spans = (
        "aggregate({0}, struct(0 as at, cast(array() as array<string>) as spans), (a, t) -> struct("
        "a.at + length(" + TURN + ") as at, "
        "if(t.role = 'assistant', concat(a.spans, array(concat(a.at + length(t.role) + 5, ':', a.at + length(t.role) + 5 + length(t.text)))), a.spans) as spans), a -> array_join(a.spans, ','))"
    )
    rest = {c: f"slice({c}, cast(n_prompt_turns as int) + 1, size({c}))" for c in ("chosen", "rejected")}
    return rows.select(
        "pair_id", "n_prompt_turns", F.expr(rendered.format("slice(chosen, 1, cast(n_prompt_turns as int))")).alias("prompt"),
        *[F.expr(rendered.format(rest[c])).alias(c) for c in rest], *[F.expr(spans.format(rest[c])).alias(f"{c}_spans") for c in rest],
    )


def next_answers(conversations: DataFrame) -> DataFrame:
    """Pairs from conversations (conv_id, turn, role, text): chosen is a conversation up to its last assistant turn,
    rejected is the same with the last assistant turn of conversation conv_id + 1 in that place.

    Turns stand by (turn, role, text); rows without a conv_id are left out; conversations without an assistant turn, or
    whose successor is missing or has none, make no pair. Turns that are repeated stay repeated.
    """
    rows = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), F.struct("turn", "role", "text").alias("t"))
    whole = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    # sorted turns from the end: the first assistant turn there is the last one
    last = "size(turns) + 1 - nullif(array_position(transform(reverse(turns), t -> coalesce(t.role, '') = 'assistant'), true), 0)"
    whole = whole.withColumn("last", F.expr(last).cast("int")).where("last is not null")
    chosen = whole.select("conv_id", F.expr("transform(slice(turns, 1, last), t -> struct(t.role, t.text))").alias("chosen"))
    answers = rows.where("t.role = 'assistant'").groupBy((F.col("conv_id") - 1).alias("conv_id")).agg(F.max("t").alias("answer"))
    joined = chosen.join(answers, "conv_id")
    return joined.select(F.col("conv_id").alias("pair_id"), "chosen", F.expr("concat(slice(chosen, 1, size(chosen) - 1), array(struct(answer.role as role, answer.text as text)))").alias("rejected"))


SQL = r"""
WITH turns AS (
    SELECT conv_id, coalesce(role, 'none') AS role, coalesce(text, '') AS text, role IS NOT DISTINCT FROM 'assistant' AS says,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS place
    FROM conversations WHERE conv_id IS NOT NULL
), last AS (
    SELECT conv_id, max(place) AS place FROM turns WHERE says GROUP BY conv_id
), answers AS (
    SELECT t.conv_id, t.text FROM turns t JOIN last USING (conv_id, place)
), pairs AS (
    SELECT l.conv_id AS pair_id, l.place, c.text AS mine, a.text AS other FROM last l JOIN answers c USING (conv_id) JOIN answers a ON a.conv_id = l.conv_id + 1
), prompts AS (
    SELECT p.*, coalesce(string_agg('<|' || t.role || '|>' || chr(10) || t.text || chr(10), '' ORDER BY t.place), '') AS prompt
    FROM pairs p LEFT JOIN turns t ON t.conv_id = p.pair_id AND t.place < p.place + CAST(p.mine = p.other AS INT) GROUP BY ALL
)
SELECT pair_id, (place - 1 + CAST(mine = other AS INT))::BIGINT AS n_prompt_turns, prompt,
    CASE WHEN mine = other THEN '' ELSE '<|assistant|>' || chr(10) || mine || chr(10) END AS chosen,
    CASE WHEN mine = other THEN '' ELSE '<|assistant|>' || chr(10) || other || chr(10) END AS rejected,
    CASE WHEN mine = other THEN '' ELSE '14:' || (14 + length(mine)) END AS chosen_spans,
    CASE WHEN mine = other THEN '' ELSE '14:' || (14 + length(other)) END AS rejected_spans
FROM prompts
"""
