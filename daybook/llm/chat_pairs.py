"""Preference formatting of conversations.

A pair is a chosen and a rejected conversation, arrays of turns. The longest
common prefix of turns is found by comparing them turn by turn, rendered once
as the prompt, and what follows is rendered as two completions. Each
completion has a mask: spans of code points, in prompt and completion end to
end, that are trained on - the assistant's turns without their headers. The
prompt is never trained on.

``pairs_by_next_reply`` makes pairs of a table of conversations: chosen is a
conversation up to its last assistant turn, rejected the same with that reply
replaced by the one of the next conversation in the order of a hash. The order
is cut into buckets of about ``BUCKET`` conversations by the same hash and is
circular in each, so no task gets more than that, whatever the ids are.

Cases: null text counts as empty, null role as ``unknown``; markers in a text
are broken by a blank; turns are ordered by number, then role, then text, so
repeated turns stay, each once a row; rows with a null ``conv_id`` belong to
no conversation and are left out; a conversation without an assistant turn
makes no pair; if both conversations are equal, or a bucket holds only one,
the completions are empty or equal; an empty table gives no rows; extra
columns are not read. A conversation is one row of the output, so its turns
meet in one task; nothing else is gathered.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daybook.llm.common import let, table

# The markers of the chat template.
START, END = "<|im_start|>", "<|im_end|>"
BUCKET = 1000


def _safe(text: Column) -> Column:
    return F.replace(text, F.lit("<|"), F.lit("< |"))


def _header(turn: Column) -> Column:
    return F.concat(F.lit(START), _safe(turn["role"]), F.lit("\n"))


def _body(turn: Column) -> Column:
    return F.concat(_safe(turn["text"]), F.lit(f"{END}\n"))


def render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_header(t), _body(t))), "")


def trained_spans(turns: Column, offset: Column) -> Column:
    """array<struct(start, end)> of the assistant's turns rendered from ``offset`` on."""

    def add(a: Column, t: Column) -> Column:
        start = a["at"] + F.length(_header(t))
        end = start + F.length(_body(t))
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(t["role"] == "assistant", F.concat(a["spans"], span))
                        .otherwise(a["spans"]).alias("spans"))

    none = F.array().cast("array<struct<start:int,end:int>>")
    return F.aggregate(turns, F.struct(offset.alias("at"), none.alias("spans")), add, lambda a: a["spans"])


def common_turns(chosen: Column, rejected: Column) -> Column:
    """The number of leading turns that both share."""
    same = F.zip_with(chosen, rejected, lambda a, b: (a == b) & a.isNotNull() & b.isNotNull())
    return let(same, lambda s: F.coalesce(F.nullif(F.array_position(F.transform(s, lambda x: F.coalesce(x, F.lit(False))),
                                                                    False).cast("int") - 1, F.lit(-1)), F.size(s)))


def format_pairs(pairs: DataFrame, key_col: str = "conv_id", chosen_col: str = "chosen",
                 rejected_col: str = "rejected") -> DataFrame:
    """(key, n_common, prompt, chosen, rejected, chosen_mask, rejected_mask)."""
    found = pairs.select(F.col(key_col), F.col(chosen_col).alias("c"), F.col(rejected_col).alias("r"),
                         common_turns(F.col(chosen_col), F.col(rejected_col)).alias("n_common"))

    def rest(name: str) -> Column:
        return F.slice(name, F.col("n_common") + 1, F.greatest(F.size(name) - F.col("n_common"), F.lit(0)))

    cut = found.select(key_col, "n_common", render(F.slice("c", F.lit(1), F.col("n_common"))).alias("prompt"),
                       rest("c").alias("c"), rest("r").alias("r"))
    size = F.length("prompt")
    return cut.select(key_col, "n_common", "prompt", render(F.col("c")).alias("chosen"),
                      render(F.col("r")).alias("rejected"), trained_spans(F.col("c"), size).alias("chosen_mask"),
                      trained_spans(F.col("r"), size).alias("rejected_mask"))


def pairs_by_next_reply(turns: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """(conv_id, chosen, rejected) of a table of conv_id, turn, role, text."""
    clean = turns.where("conv_id IS NOT NULL").select(
        "conv_id", F.struct("turn", F.coalesce("role", F.lit("unknown")).alias("role"),
                            F.coalesce("text", F.lit("")).alias("text")).alias("t"))
    whole = clean.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    last = let(F.transform(F.col("ts"), lambda t, i: F.when(t["role"] == "assistant", i + 1)), F.array_max)
    talk = (whole.withColumn("n", last).where("n IS NOT NULL")
            .select("conv_id", F.transform(F.slice("ts", F.lit(1), F.col("n")),
                                           lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("chosen"),
                    F.md5(F.col("conv_id").cast("string")).alias("key")))
    n = turns.select("conv_id").where("conv_id IS NOT NULL").distinct().count()
    part = F.conv(F.substring("key", 1, 8), 16, 10).cast("long") % math.ceil(max(n, 1) / bucket)
    order = Window.partitionBy("part").orderBy("key", "conv_id")
    every = Window.partitionBy("part").orderBy("key", "conv_id").rowsBetween(Window.unboundedPreceding,
                                                                            Window.unboundedFollowing)
    reply = F.element_at("chosen", -1)
    return (talk.withColumn("part", part)
            .withColumn("other", F.coalesce(F.lead(reply).over(order), F.first(reply).over(every)))
            .select("conv_id", "chosen", F.concat(F.slice("chosen", F.lit(1), F.size("chosen") - 1),
                                                  F.array("other")).alias("rejected")))


def op7_chat_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    def shown(mask: str) -> Column:
        return F.array_join(F.transform(mask, lambda s: F.concat_ws("-", s["start"].cast("string"),
                                                                    s["end"].cast("string"))), ",").alias(mask)
    pairs = pairs_by_next_reply(table(spark, sf_dir, "conversations"))
    return format_pairs(pairs).select("conv_id", F.col("n_common").cast("long").alias("n_common"), "prompt", "chosen",
                                      "rejected", shown("chosen_mask"), shown("rejected_mask"))


_RENDER = f"'{START}' || replace(t.role, '<|', '< |') || chr(10) || replace(t.txt, '<|', '< |') || '{END}' || chr(10)"

ORACLE = f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS txt
           FROM conversations WHERE conv_id IS NOT NULL),
w AS (SELECT conv_id, list({{'role': role, 'txt': txt}} ORDER BY turn, role, txt) AS ts FROM c GROUP BY conv_id),
l AS (SELECT conv_id, ts, md5(conv_id::VARCHAR) AS key,
        list_max([CASE WHEN ts[i].role = 'assistant' THEN i END FOR i IN range(1, len(ts) + 1)]) AS n FROM w),
t AS (SELECT conv_id, ts[1:n] AS chosen, key, ('0x' || substr(key, 1, 8))::BIGINT
        % (SELECT greatest(ceil(count(DISTINCT conv_id) / {BUCKET}.0), 1)::BIGINT FROM c) AS part FROM l WHERE n IS NOT NULL),
o AS (SELECT *, coalesce(lead(chosen[-1]) OVER b, first_value(chosen[-1]) OVER b) AS other
      FROM t WINDOW b AS (PARTITION BY part ORDER BY key, conv_id)),
k AS (SELECT conv_id, chosen, other, CASE WHEN chosen[-1] = other THEN len(chosen) ELSE len(chosen) - 1 END AS n_common FROM o),
p AS (SELECT conv_id, n_common::BIGINT AS n_common,
        list_aggregate([{_RENDER} FOR t IN chosen[1:n_common]] || [''], 'string_agg', '') AS prompt,
        CASE WHEN n_common < len(chosen) THEN list_transform([chosen[-1]], lambda t: {_RENDER})[1] ELSE '' END AS chosen,
        CASE WHEN n_common < len(chosen) THEN list_transform([other], lambda t: {_RENDER})[1] ELSE '' END AS rejected
      FROM k),
m AS (SELECT *, length(prompt) + length('{START}assistant') + 1 AS s FROM p)
SELECT conv_id, n_common, prompt, chosen, rejected,
       CASE WHEN chosen = '' THEN '' ELSE s || '-' || (length(prompt) + length(chosen)) END AS chosen_mask,
       CASE WHEN rejected = '' THEN '' ELSE s || '-' || (length(prompt) + length(rejected)) END AS rejected_mask
FROM m
"""
