"""Mixing sources to target weights: token budgets handed down a tree of sources, then token prefixes of seeded epochs.

A node's budget is split among its children by weight. A child whose documents cannot fill its part,
even when repeated as often as allowed, gives the rest back to its brothers and sisters; only what the
whole family cannot fill goes to the families beside it. Every leaf then takes documents in a seeded
order, epoch by epoch, until its tokens are spent.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quartermill.llm.common import WORD
from quartermill.session import materialise

#: Slices of a leaf's seeded order; only the slice in which the budget ends is put in order row by row.
SLICE_DIGITS = 3


@dataclass(frozen=True)
class Mix:
    """``weights`` names the weight of a node by its path of level values; what is not named weighs 1."""

    levels: Sequence[str] = ("domain", "lang", "source")
    weights: Mapping[tuple[str, ...], int] = field(default_factory=dict)
    budget_percent: int = 60  # tokens to select, of all tokens there are
    max_epochs: int = 2
    seed: int = 7


def seeded_order(seed: int, epoch: Column | int, doc_id: str) -> Column:
    """Hexadecimal digits whose order is the order of the documents in an epoch."""
    epoch = F.lit(epoch) if isinstance(epoch, int) else epoch
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))))


def _key(levels: Sequence[str]) -> Column:
    """One name for a path of level values; a null value is a name of its own."""
    return F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in levels])


def leaf_budgets(leaves: DataFrame, mix: Mix, total: int) -> DataFrame:
    """``leaves`` (``_mix_l0 .., _mix_leaf, tokens``) with ``budget``: tokens handed down level by level.

    Among children with weights w and capacities c the budget B becomes min(c, t w): in order of c / w
    the first ones are full, and t is what is left for each unit of weight of the others.
    """
    names = [c for c in leaves.columns if c.startswith("_mix_l") and c != "_mix_leaf"]
    capacity = leaves.withColumn("cap", (F.col("tokens") * mix.max_epochs).cast("double"))
    parents = None
    for level in range(len(names)):
        own, family = names[: level + 1], names[:level]
        children = capacity.groupBy(*own).agg(F.sum("cap").alias("cap")).withColumn("w", _weight(own, mix))
        if parents is None:
            children = children.withColumn("budget", F.lit(float(total)))
        else:
            on = [children[c].eqNullSafe(parents[c]) for c in family]
            children = children.join(parents, on).select(*[children[c] for c in own], children["cap"], "w", parents["share"].alias("budget"))
        within = Window.partitionBy(*family).orderBy(F.col("cap") / F.col("w"), *[F.col(c).asc_nulls_first() for c in own])
        before = within.rowsBetween(Window.unboundedPreceding, -1)
        onwards = within.rowsBetween(Window.currentRow, Window.unboundedFollowing)
        children = children.withColumn("place", F.row_number().over(within)).withColumn(
            "t", (F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("w").over(onwards))
        full = F.col("cap") <= F.col("t") * F.col("w")
        water = F.min(F.when(~full, F.struct("place", "t"))).over(Window.partitionBy(*family))
        share = F.when(full, F.col("cap")).otherwise(F.col("water.t") * F.col("w"))
        parents = children.withColumn("water", water).select(*own, share.alias("share"))
    on = [leaves[c].eqNullSafe(parents[c]) for c in names]
    return leaves.join(parents, on).select("_mix_leaf", "tokens", F.floor(F.col("share") + F.lit(1e-6)).cast("bigint").alias("budget"))


def _weight(own: Sequence[str], mix: Mix) -> Column:
    weight = F.lit(1.0)
    for path, value in mix.weights.items():
        if len(path) == len(own):
            if value <= 0:
                raise ValueError("weights must be positive")
            same = F.lit(True)
            for column, name in zip(own, path):
                same = same & F.col(column).eqNullSafe(F.lit(name))
            weight = F.when(same, F.lit(float(value))).otherwise(weight)
    return weight


def count_words(text: str) -> Column:
    return F.regexp_count(F.coalesce(F.col(text).cast("string"), F.lit("")), F.lit(WORD)).cast("bigint")


def _with_leaf(df: DataFrame, mix: Mix, extra: Mapping[str, Column]) -> DataFrame:
    levels = [extra.get(c, F.col(f"`{c}`")).cast("string").alias(f"_mix_l{i}") for i, c in enumerate(mix.levels)]
    rows = df.select("*", *levels)
    return rows.withColumn("_mix_leaf", _key([f"_mix_l{i}" for i in range(len(mix.levels))]))


def plan_mix(df: DataFrame, tokens: Column, mix: Mix, doc_id: str = "doc_id", extra: Mapping[str, Column] | None = None) -> DataFrame:
    """``(_mix_leaf, tokens, budget, whole, cut)``, one row per leaf.

    A leaf takes ``whole`` epochs and of the next one the documents up to the place ``cut`` in the order
    of that epoch: those that begin before the budget is spent. Sums per slice of the order show in
    which slice that is, so only the rows of one slice in thousands are put in order.
    """
    names = [f"_mix_l{i}" for i in range(len(mix.levels))]
    narrow = materialise(_with_leaf(df, mix, dict(extra or {})).select(
        *names, "_mix_leaf", F.col(f"`{doc_id}`").alias("id"), tokens.cast("bigint").alias("tokens")), "mix-rows")
    leaves = materialise(narrow.groupBy(*names, "_mix_leaf").agg(F.sum("tokens").alias("tokens")), "mix-leaves")
    total = leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("t")).first()["t"] * mix.budget_percent // 100
    budgets = leaf_budgets(leaves, mix, total)
    whole = F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens"))).otherwise(F.lit(0))
    budgets = budgets.withColumn("whole", F.least(whole, F.lit(mix.max_epochs)).cast("bigint"))
    rest = F.when(F.col("whole") < mix.max_epochs, F.col("budget") - F.col("whole") * F.col("tokens")).otherwise(F.lit(0))
    budgets = materialise(budgets.withColumn("rest", rest), "mix-budgets")
    keyed = narrow.select("_mix_leaf", "id", F.col("tokens").alias("n")).join(budgets.filter("rest > 0").select("_mix_leaf", "whole", "rest"), "_mix_leaf")
    keyed = keyed.withColumn("digits", seeded_order(mix.seed, F.col("whole"), "id")).withColumn("slice", F.substring("digits", 1, SLICE_DIGITS))
    before = Window.partitionBy("_mix_leaf").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = keyed.groupBy("_mix_leaf", "slice", "rest").agg(F.sum("n").alias("n"))
    slices = slices.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    ending = slices.filter("before < rest AND rest <= before + n").select("_mix_leaf", "slice", (F.col("rest") - F.col("before")).alias("left"))
    places = keyed.join(ending, ["_mix_leaf", "slice"]).groupBy("_mix_leaf", "left", "digits").agg(F.sum("n").alias("n"))
    ahead = Window.partitionBy("_mix_leaf").orderBy("digits").rowsBetween(Window.unboundedPreceding, -1)
    taken = places.withColumn("ahead", F.coalesce(F.sum("n").over(ahead), F.lit(0))).filter("ahead < left")
    cuts = taken.groupBy("_mix_leaf").agg(F.max("digits").alias("cut"))
    return materialise(budgets.drop("rest").join(cuts, "_mix_leaf", "left"), "mix-plan")


def select_mix(df: DataFrame, tokens: Column, mix: Mix, doc_id: str = "doc_id", extra: Mapping[str, Column] | None = None) -> DataFrame:
    """Rows of ``df`` that the mix takes, with ``_mix_leaf`` and ``_mix_epochs``, how often each is taken.

    ``extra`` gives levels of the tree that are not columns. The last document of a leaf may exceed its
    budget; a leaf with a positive budget takes at least one document; documents without tokens are taken
    with the part of the epoch they fall in. Null level values form nodes of their own. Rows of equal
    id, repeats and null ids included, share one place in the order and are taken together. An empty
    table gives no rows. Every column of ``df`` is returned as it was; names that begin with ``_mix`` are
    refused.
    """
    if any(c.startswith("_mix") for c in df.columns):
        raise ValueError("column names beginning with _mix are reserved")
    plan = plan_mix(df, tokens, mix, doc_id, extra).select("_mix_leaf", F.col("whole").alias("_mix_whole"), F.col("cut").alias("_mix_cut"))
    rows = _with_leaf(df, mix, dict(extra or {})).join(plan, "_mix_leaf")
    partly = F.coalesce(seeded_order(mix.seed, F.col("_mix_whole"), doc_id) <= F.col("_mix_cut"), F.lit(False))
    rows = rows.withColumn("_mix_epochs", (F.col("_mix_whole") + partly.cast("int")).cast("int"))
    return rows.filter("_mix_epochs > 0").select(*[F.col(f"`{c}`") for c in df.columns], "_mix_leaf", "_mix_epochs")


def sql(mix: Mix, levels: Sequence[str]) -> str:
    """The same selection over ``documents`` as one SQL statement; ``levels`` are the expressions of the tree levels."""
    names = [f"l{i}" for i in range(len(levels))]
    parts = [
        "docs AS (SELECT doc_id, " + ", ".join(f"CAST({e} AS VARCHAR) AS {n}" for e, n in zip(levels, names))
        + rf", len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS n FROM documents)",
        f"leaves AS (SELECT {', '.join(names)}, sum(n) AS tokens FROM docs GROUP BY ALL)",
        f"total AS (SELECT CAST(sum(tokens) * {mix.budget_percent} // 100 AS DOUBLE) AS t FROM leaves)",
    ]
    for level in range(len(names)):
        own, family = names[: level + 1], names[:level]
        cases = " ".join("WHEN " + " AND ".join(f"{c} IS NOT DISTINCT FROM '{v}'" for c, v in zip(own, path)) + f" THEN {float(value)}"
                         for path, value in mix.weights.items() if len(path) == len(own))
        weight = f"CASE {cases} ELSE 1.0 END" if cases else "1.0"
        budget = "(SELECT t FROM total)" if not family else f"p{level - 1}.share"
        on = " AND ".join(f"c.{c} IS NOT DISTINCT FROM p{level - 1}.{c}" for c in family)
        by = f"PARTITION BY {', '.join(family)} " if family else ""
        order = f"{by}ORDER BY cap / w, " + ", ".join(f"{c} NULLS FIRST" for c in own)
        parts += [
            f"c{level} AS (SELECT {', '.join('c.' + c for c in own)}, c.cap, CAST({_qualified(weight, own)} AS DOUBLE) AS w, {budget} AS budget FROM "
            f"(SELECT {', '.join(own)}, CAST(sum(tokens * {mix.max_epochs}) AS DOUBLE) AS cap FROM leaves GROUP BY ALL) c"
            + (f" JOIN p{level - 1} ON {on}" if family else "") + ")",
            f"t{level} AS (SELECT *, row_number() OVER ({order}) AS place, (budget - coalesce(sum(cap) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING "
            f"AND 1 PRECEDING), 0)) / sum(w) OVER ({order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS t FROM c{level})",
            f"p{level} AS (SELECT {', '.join(own)}, CASE WHEN cap <= t * w THEN cap ELSE (first_value(t) OVER ({by}ORDER BY cap <= t * w, place)) * w END "
            f"AS share FROM t{level})",
        ]
    last = f"p{len(names) - 1}"
    same = lambda x, y: " AND ".join(f"{x}.{c} IS NOT DISTINCT FROM {y}.{c}" for c in names)
    parts += [
        f"budgets AS (SELECT leaves.*, CAST(floor(share + 1e-6) AS BIGINT) AS budget FROM leaves JOIN {last} ON {same('leaves', last)})",
        f"epochs AS (SELECT *, CASE WHEN tokens > 0 THEN least(budget // tokens, {mix.max_epochs}) ELSE 0 END AS whole FROM budgets)",
        f"placed AS (SELECT d.*, e.whole, CASE WHEN e.whole < {mix.max_epochs} THEN e.budget - e.whole * e.tokens ELSE 0 END AS rest, "
        f"md5(concat('{mix.seed}:', e.whole, ':', coalesce(CAST(d.doc_id AS VARCHAR), ''))) AS digits FROM docs d JOIN epochs e ON {same('d', 'e')})",
        f"taken AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY {', '.join(names)} ORDER BY digits RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW "
        f"EXCLUDE GROUP), 0) AS ahead FROM placed)",
    ]
    return ("WITH " + ",\n".join(parts) + f"\nSELECT doc_id, {', '.join(f'{n} AS {c}' for n, c in zip(names, mix.levels))}, "
            "CAST(whole + CASE WHEN ahead < rest THEN 1 ELSE 0 END AS INTEGER) AS epochs FROM taken "
            "WHERE whole + CASE WHEN ahead < rest THEN 1 ELSE 0 END > 0")


def _qualified(weight: str, own: Sequence[str]) -> str:
    for name in own:
        weight = weight.replace(f"{name} IS NOT", f"c.{name} IS NOT")
    return weight
