"""Preference formatting of chosen and rejected conversations; DataFrame functions only.

The longest common prefix of turns (same role and text) is rendered once as the prompt; what is left of either
conversation is rendered as its completion, with the character ranges [a, b) of assistant text (and its end mark) on
which a loss may be taken. Marks of turns inside a text are not escaped: the ranges say what is what. All of it is array functions on the two turn lists of a pair: the only shuffles are
those that bring a conversation's turns together and each conversation to its partner, by conversation id. Texts are joined
once; only the list of ranges grows turn by turn.

Rows: turns with a null conv_id are left out; a null role or text counts as empty; turns are ordered by number, role and
text, so ties and repeated rows have a place. Equal conversations give empty completions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.common import table

OPEN, BREAK, CLOSE = "<|im_start|>", "\n", "<|im_end|>\n"


def turns_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): the ordered turns of each conversation, as structs of role and text."""
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long"), F.struct(F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).alias("turn")
    )
    listed = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    return listed.select("conv_id", F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))


def rendered(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), turn["role"], F.lit(BREAK), turn["text"], F.lit(CLOSE))


def common_prefix(a: Column, b: Column) -> Column:
    """Number of leading turns that are the same in both lists."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce((x["role"] == y["role"]) & (x["text"] == y["text"]), F.lit(False)))
    first = F.array_position(same, F.lit(False))
    return F.when(first == 0, F.size(same)).otherwise(first - 1).cast("int")


def masked(turns: Column) -> Column:
    """(text, mask) of rendered turns; mask: the ranges of assistant turns' text with the end mark."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.array().cast("array<struct<a:long,b:long>>").alias("mask"))

    def add(acc: Column, turn: Column) -> Column:
        at = acc["n"] + F.length(turn["role"]) + len(OPEN + BREAK)
        end = at + F.length(turn["text"]) + len(CLOSE)
        own = F.array(F.struct(at.alias("a"), end.alias("b")))
        return F.struct(end.alias("n"), F.when(turn["role"] == "assistant", F.concat(acc["mask"], own)).otherwise(acc["mask"]).alias("mask"))

    return F.struct(F.array_join(F.transform(turns, rendered), "").alias("text"), F.aggregate(turns, start, add)["mask"].alias("mask"))


def format_pairs(pairs: DataFrame, chosen: str = "chosen", rejected: str = "rejected") -> DataFrame:
    """Adds n_prefix, prompt, chosen_text, chosen_mask, rejected_text, rejected_mask and the rendered tail to (conv_id, two turn lists)."""
    empty = F.array().cast("array<struct<role:string,text:string>>")
    given = F.col("tail") if "tail" in pairs.columns else empty
    rows = pairs.select("conv_id", F.array_join(F.transform(F.coalesce(given, empty), rendered), "").alias("tail"), F.coalesce(F.col(chosen), empty).alias("c"), F.coalesce(F.col(rejected), empty).alias("r"))
    rows = rows.withColumn("n_prefix", common_prefix(F.col("c"), F.col("r")))
    rest = lambda side: F.slice(F.col(side), F.col("n_prefix") + 1, F.greatest(F.size(side) - F.col("n_prefix"), F.lit(0)))
    prompt = F.array_join(F.transform(F.slice("c", F.lit(1), F.col("n_prefix")), rendered), "")
    rows = rows.select("conv_id", "n_prefix", "tail", prompt.alias("prompt"), masked(rest("c")).alias("c"), masked(rest("r")).alias("r"))
    return rows.select("conv_id", F.col("n_prefix").cast("long").alias("n_prefix"), "prompt", F.col("c.text").alias("chosen_text"), F.col("c.mask").alias("chosen_mask"), F.col("r.text").alias("rejected_text"), F.col("r.mask").alias("rejected_mask"), "tail")


def following(ids: DataFrame) -> DataFrame:
    """(conv_id, next_id) of distinct ids: the next larger one that exists, null for the largest. Ids are ordered in blocks of 2^21,
    the blocks' first ids in blocks of blocks, and the firsts of those (2^22 at most) at once: no window is larger."""
    own = Window.partitionBy(F.shiftright("conv_id", 21)).orderBy("conv_id")
    rows = ids.select("conv_id", F.lead("conv_id").over(own).alias("inside"))
    first = ids.groupBy(F.shiftright("conv_id", 21).alias("block")).agg(F.min("conv_id").alias("low"))
    far = first.groupBy(F.shiftright("block", 21).alias("top")).agg(F.min("low").alias("top_low"))
    far = far.select(F.col("top").alias("own_top"), F.lead("top_low").over(Window.orderBy("top")).alias("next_top"))
    first = first.select("block", F.shiftright("block", 21).alias("top"), F.lead("low").over(Window.partitionBy(F.shiftright("block", 21)).orderBy("block")).alias("near"))
    first = first.join(far, F.col("top") == F.col("own_top")).select("block", F.coalesce("near", "next_top").alias("outside"))
    return rows.join(first, F.shiftright("conv_id", 21) == F.col("block")).select("conv_id", F.coalesce("inside", "outside").alias("next_id"))


def derived_pairs(conversations: DataFrame) -> DataFrame:
    """(conv_id, chosen, rejected, tail) of plain conversations: chosen is a conversation up to its last assistant turn;
    rejected ends in the last answer of the conversation with the next existing id instead (in none, if that has none);
    tail has the turns after the last answer."""
    listed = turns_of(conversations)
    marks = F.transform("turns", lambda t: t["role"] == "assistant")
    last = F.size("turns") - F.array_position(F.reverse(marks), F.lit(True)) + 1  # size + 1 where there is none
    listed = listed.select("conv_id", "turns", last.cast("int").alias("last"))
    own = listed.select("conv_id", "last", F.size("turns").alias("n"), F.slice("turns", F.lit(1), F.least("last", F.size("turns"))).alias("chosen"), F.slice("turns", F.lit(1), F.col("last") - 1).alias("before"), F.slice("turns", F.col("last") + 1, F.greatest(F.size("turns") - F.col("last"), F.lit(0))).alias("tail"))
    answers = listed.where(F.col("last") <= F.size("turns")).select(F.col("conv_id").alias("asked"), F.slice("turns", F.col("last"), F.lit(1)).alias("answer"))
    order = following(conversations.select(F.col("conv_id").cast("long").alias("conv_id")).where("conv_id IS NOT NULL").distinct()).select(F.col("conv_id").alias("this"), "next_id")
    own = own.join(order, own["conv_id"] == order["this"])
    both = own.join(answers, own["next_id"] == answers["asked"], "left")
    none = F.array().cast("array<struct<role:string,text:string>>")
    ends = F.when(F.col("last") <= F.col("n"), F.coalesce("answer", none)).otherwise(none)
    return both.select("conv_id", "chosen", F.concat("before", ends).alias("rejected"), "tail")


def _spans(mask: str) -> Column:
    return F.array_join(F.transform(mask, lambda s: F.concat_ws("-", s["a"].cast("string"), s["b"].cast("string"))), ",")


def op6_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = format_pairs(derived_pairs(table(spark, sf_dir, "conversations")))
    return out.select("conv_id", "n_prefix", "prompt", "chosen_text", _spans("chosen_mask").alias("chosen_mask"), "rejected_text", _spans("rejected_mask").alias("rejected_mask"), "tail")


ORACLE = """
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i
  FROM conversations WHERE conv_id IS NOT NULL),
la AS (SELECT conv_id, max(i) FILTER (role = 'assistant') AS last FROM t GROUP BY conv_id),
pre AS (
  SELECT t.conv_id, count(*) FILTER (i < coalesce(last, i + 1)) AS n,
         coalesce(string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), '' ORDER BY i)
                  FILTER (i < coalesce(last, i + 1)), '') AS prompt,
         coalesce(string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), '' ORDER BY i)
                  FILTER (i > last), '') AS tail
  FROM t JOIN la USING (conv_id) GROUP BY t.conv_id),
nx AS (SELECT conv_id, lead(conv_id) OVER (ORDER BY conv_id) AS next_id FROM la),
ans AS (SELECT t.conv_id, text FROM t JOIN la ON t.conv_id = la.conv_id AND t.i = la.last),
j AS (
  SELECT pre.conv_id, pre.n, pre.prompt, pre.tail, a.text AS c, CASE WHEN a.text IS NOT NULL THEN b.text END AS r
  FROM pre LEFT JOIN ans a ON a.conv_id = pre.conv_id LEFT JOIN nx ON nx.conv_id = pre.conv_id LEFT JOIN ans b ON b.conv_id = nx.next_id),
k AS (SELECT *, coalesce(c = r, false) AS same, '<|im_start|>assistant' || chr(10) AS o, '<|im_end|>' || chr(10) AS e FROM j)
SELECT conv_id, n + CASE WHEN same THEN 1 ELSE 0 END AS n_prefix,
       prompt || CASE WHEN same THEN o || c || e ELSE '' END AS prompt,
       CASE WHEN same OR c IS NULL THEN '' ELSE o || c || e END AS chosen_text,
       CASE WHEN same OR c IS NULL THEN '' ELSE '22-' || (33 + length(c)) END AS chosen_mask,
       CASE WHEN same OR r IS NULL THEN '' ELSE o || r || e END AS rejected_text,
       CASE WHEN same OR r IS NULL THEN '' ELSE '22-' || (33 + length(r)) END AS rejected_mask, tail
FROM k
"""
