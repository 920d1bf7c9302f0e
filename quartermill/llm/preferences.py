"""Preference pairs as text: one prompt from what chosen and rejected share, and two masked completions.

Everything here is built-in expressions over one row per pair.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """A turn reads ``start + role + middle + text + end``; markers inside texts are broken by a space."""

    start: str = "<|im_start|>"
    middle: str = "\n"
    end: str = "<|im_end|>\n"
    marker: str = "<|"
    broken: str = "< |"
    trained_role: str = "assistant"


def _sides(chosen: DataFrame, rejected: DataFrame, pair: str, turn: str, role: str, text: str) -> DataFrame:
    """One row per pair: the turns of both sides in order, as arrays ``c`` and ``r`` of ``struct<turn, role, text>``."""

    def plain(df: DataFrame, side: str) -> DataFrame:
        one = F.struct(F.col(turn).alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
                       F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
        return df.filter(F.col(pair).isNotNull()).select(F.col(pair).alias("pair_id"), F.lit(side).alias("side"), one.alias("turn"))

    turns = plain(chosen, "c").unionByName(plain(rejected, "r"))
    own = lambda side: F.sort_array(F.collect_list(F.when(F.col("side") == side, F.col("turn")))).alias(side)
    return turns.groupBy("pair_id").agg(own("c"), own("r"))


def _content(turn: Column, t: Template) -> Column:
    return F.replace(turn["text"], F.lit(t.marker), F.lit(t.broken))


def _head(turn: Column, t: Template) -> Column:
    return F.concat(F.lit(t.start), F.replace(turn["role"], F.lit(t.marker), F.lit(t.broken)), F.lit(t.middle))


def _rendered(turns: Column, t: Template) -> Column:
    return F.array_join(F.transform(turns, lambda x: F.concat(_head(x, t), _content(x, t), F.lit(t.end))), "")


def _spans(turns: Column, t: Template) -> Column:
    """``[begin, end)`` in code points of what is trained in a completion: texts of the trained role with their end."""
    none = F.array().cast("array<struct<begin: int, end: int>>")

    def step(state: Column, x: Column) -> Column:
        begin = state["at"] + F.length(_head(x, t))
        end = begin + F.length(_content(x, t)) + F.lit(len(t.end))
        span = F.array(F.struct(begin.alias("begin"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(x["role"] == t.trained_role, F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans"))

    return F.aggregate(turns, F.struct(F.lit(0).alias("at"), none.alias("spans")), step, lambda state: state["spans"])


def format_preferences(chosen: DataFrame, rejected: DataFrame, pair: str = "conv_id", turn: str = "turn", role: str = "role",
                       text: str = "text", template: Template = Template()) -> DataFrame:
    """``(pair_id, n_common, prompt, chosen, rejected, chosen_spans, rejected_spans)``, one row per pair.

    Both tables hold turns, with the pair they belong to. The first ``n_common`` turns, those with equal
    roles and texts on both sides, are the prompt; what follows on each side is its completion, of which
    only the spans are trained. Turns are ordered by turn, then role and text, so repeated turns stay
    side by side. A null role or text counts as empty; turns without a pair belong to none. A pair that
    one side lacks has no prompt and an empty completion there; equal sides have two empty completions.
    Empty tables give no rows; other columns are not read. One conversation is one row, by its nature.
    """
    t = template
    both = _sides(chosen, rejected, pair, turn, role, text)
    alike = F.zip_with("c", "r", lambda x, y: F.coalesce((x["role"] == y["role"]) & (x["text"] == y["text"]), F.lit(False)))
    differ = F.array_position(alike, False)  # the longer side has no partner from its end on
    longest = F.greatest(F.size("c"), F.size("r"))
    both = both.withColumn("n_common", F.when(differ > 0, differ - 1).otherwise(longest).cast("int"))
    rest = lambda side: F.slice(F.col(side), F.col("n_common") + 1, F.greatest(F.size(side) - F.col("n_common"), F.lit(0)))
    both = both.withColumns({"prompt": F.slice("c", F.lit(1), F.col("n_common")), "c": rest("c"), "r": rest("r")})
    return both.select(
        "pair_id", "n_common", _rendered(F.col("prompt"), t).alias("prompt"), _rendered(F.col("c"), t).alias("chosen"),
        _rendered(F.col("r"), t).alias("rejected"), _spans(F.col("c"), t).alias("chosen_spans"), _spans(F.col("r"), t).alias("rejected_spans"))


def diverging_pairs(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Chosen and rejected sides from plain conversations ``(conv_id, turn, role, text)``.

    The table has no preferences, so a whole conversation is the chosen side and the rejected one goes on as its
    neighbour does: after one to three turns, by the id, it has the neighbour's turns from that place on. Ids 2k and
    2k + 1 are neighbours. How far both sides agree is left to be found. Every turn is on the chosen side of its own pair:
    a null turn is the first of its conversation, equal ones go by role and text. Without a neighbour the rejected side
    ends where it would diverge; a neighbour without its conversation has a rejected side only.
    """
    plain = lambda name: F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name)
    rows = turns.filter("conv_id IS NOT NULL").select("conv_id", "turn", plain("role"), plain("text"))
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    chosen = rows.withColumn("turn", F.row_number().over(order))
    kept = lambda conv: 1 + F.pmod(conv, F.lit(3))
    neighbour = F.col("conv_id").bitwiseXOR(F.lit(1).cast("bigint"))
    own = chosen.filter(F.col("turn") <= kept(F.col("conv_id")))
    taken = chosen.filter(F.col("turn") > kept(neighbour)).withColumn("conv_id", neighbour)
    return chosen, own.unionByName(taken)


def spans_text(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat(s["begin"].cast("string"), F.lit("-"), s["end"].cast("string"))), ",")


SQL = r"""
WITH c AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn ASC NULLS FIRST, role, text) AS turn, role, text
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)
), sides AS (
  SELECT 'c' AS side, conv_id, turn, role, text FROM c
  UNION ALL
  SELECT 'r', conv_id, turn, role, text FROM c WHERE turn <= 1 + (conv_id % 3 + 3) % 3
  UNION ALL
  SELECT 'r', xor(conv_id, 1), turn, role, text FROM c WHERE turn > 1 + (xor(conv_id, 1) % 3 + 3) % 3
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY side, conv_id ORDER BY turn, role, text) AS k,
         '<|im_start|>' || replace(role, '<|', '< |') || chr(10) AS head, replace(text, '<|', '< |') || '<|im_end|>' || chr(10) AS body
  FROM sides
), common AS (
  SELECT coalesce(a.conv_id, b.conv_id) AS conv_id,
         coalesce(min(coalesce(a.k, b.k)) FILTER (WHERE a.k IS NULL OR b.k IS NULL OR a.role <> b.role OR a.text <> b.text) - 1, count(*)) AS n
  FROM (SELECT * FROM placed WHERE side = 'c') a FULL JOIN (SELECT * FROM placed WHERE side = 'r') b ON a.conv_id = b.conv_id AND a.k = b.k
  GROUP BY 1
), rest AS (
  SELECT p.*, n, sum(length(head) + length(body)) OVER (PARTITION BY p.side, p.conv_id ORDER BY k) AS upto
  FROM placed p JOIN common USING (conv_id) WHERE k > n
), done AS (
  SELECT side, conv_id, string_agg(head || body, '' ORDER BY k) AS text,
         coalesce(string_agg((upto - length(body)) || '-' || upto, ',' ORDER BY k) FILTER (WHERE role = 'assistant'), '') AS spans
  FROM rest GROUP BY side, conv_id
), prompts AS (
  SELECT p.conv_id, string_agg(head || body, '' ORDER BY k) AS prompt FROM placed p JOIN common USING (conv_id) WHERE side = 'c' AND k <= n GROUP BY p.conv_id
)
SELECT m.conv_id AS pair_id, CAST(n AS INTEGER) AS n_common, coalesce(prompt, '') AS prompt, coalesce(x.text, '') AS chosen,
       coalesce(y.text, '') AS rejected, coalesce(x.spans, '') AS chosen_spans, coalesce(y.spans, '') AS rejected_spans
FROM common m LEFT JOIN prompts p ON p.conv_id = m.conv_id LEFT JOIN done x ON x.conv_id = m.conv_id AND x.side = 'c'
LEFT JOIN done y ON y.conv_id = m.conv_id AND y.side = 'r'"""
