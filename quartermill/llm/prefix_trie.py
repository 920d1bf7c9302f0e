"""Trie of conversation prefixes, rolled up in bands of depth.

A node is a distinct sequence of first turns. It is named by its depth and by two running exclusive ors over
hashes of its turns with their places, so a window names all prefixes of a conversation in one pass.
Sums over subtrees go up in bands of a fixed height: every node adds to its ancestors within its band
only, then the totals of band roots are completed from the deepest band on, and at last each completed
root adds to its ancestors in the band above. A node is copied at most as often as a band is high, and
the rounds are as many as there are bands; the height is the root of the greatest depth, or more.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quartermill.functions.skew import salted_join, spread
from quartermill.llm.common import WORD
from quartermill.session import materialise

PIECE = 1024  # ids of one piece of a list of ends


@dataclass(frozen=True)
class TrieSettings:
    height: int = 8  # least height of a band


def ordered_turns(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``(conv_id, place, digest, words)``: turns numbered from 1 in their conversation, with digests instead of texts.

    A null turn comes first, equal ones go by the digests of role and text. Null roles and texts are empty, turns
    without a conversation belong to none. The turns of one conversation are numbered in one task.
    """
    plain = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(""))
    digest = F.unhex(F.concat(F.md5(plain(role).cast("binary")), F.md5(plain(text).cast("binary"))))
    rows = df.filter(F.col(conv).isNotNull()).select(
        F.col(conv).cast("bigint").alias("conv_id"), F.col(turn).alias("turn"), digest.alias("digest"),
        F.regexp_count(plain(text), F.lit(WORD)).cast("bigint").alias("words"))
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "digest")
    return rows.select("conv_id", F.row_number().over(order).alias("place"), "digest", "words")


def share_heads(ordered: DataFrame, family: int, heads: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """``(turns, conversations)`` where each conversation begins with the first ``heads`` turns of the first one of its family.

    Those replace as many first turns of its own. ``heads`` is an expression over ``conv_id`` and at most ``most``;
    families are ``family`` ids in a row. The second table has the columns ``conv_id`` and ``length``.
    """
    sizes = ordered.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).withColumn("heads", heads).withColumn(
        "base", F.col("conv_id") - F.col("conv_id") % family)
    bases = sizes.filter(F.col("conv_id") % family == 0).select(F.col("conv_id").alias("base"), F.col("n").alias("there"))
    borrowed = F.least("heads", F.coalesce("there", F.lit(0)))
    convs = sizes.join(bases, "base", "left").withColumn("length", borrowed + F.greatest(F.col("n") - F.col("heads"), F.lit(0)))
    own = ordered.withColumn("heads", heads).filter("place > heads").select("conv_id", F.lit(1).alias("part"), "place", "digest", "words")
    first = ordered.filter((F.col("conv_id") % family == 0) & (F.col("place") <= most)).withColumnRenamed("conv_id", "base")
    taken = convs.select("conv_id", "base", "heads").join(first, "base").filter("place <= heads").select(
        "conv_id", F.lit(0).alias("part"), "place", "digest", "words")
    order = Window.partitionBy("conv_id").orderBy("part", "place")
    turns = taken.unionByName(own).select("conv_id", F.row_number().over(order).alias("place"), "digest", "words")
    return turns, convs.select("conv_id", F.col("length").cast("bigint").alias("length"))


def _node(depth: Column, a: Column, b: Column) -> Column:
    return F.struct(depth.cast("int").alias("depth"), a.cast("bigint").alias("a"), b.cast("bigint").alias("b"))


def _paths(turns: DataFrame, height: int) -> DataFrame:
    """``(conv_id, node, chain, words, last)`` of every prefix with turns.

    ``chain`` are the nodes from the band's root down to the node itself; for a root of a band, from the
    root above down to it.
    """
    order = Window.partitionBy("conv_id").orderBy("place")
    named = turns.select(
        "conv_id", "words", F.lead("place").over(order).isNull().alias("last"),
        _node(F.col("place"), F.bit_xor(F.xxhash64("place", "digest")).over(order), F.bit_xor(F.xxhash64("digest", "place")).over(order)).alias("node"))
    lately = F.collect_list("node").over(Window.partitionBy("conv_id").orderBy("node.depth").rowsBetween(-height, 0))
    depth = F.col("node.depth")
    top = F.when(depth % height == 0, depth - height).otherwise(depth - depth % height)
    chain = F.filter("lately", lambda x: x["depth"] >= F.col("top"))
    root = F.array(_node(F.lit(0), F.lit(0), F.lit(0)))
    return named.withColumn("lately", lately).withColumn("top", top).select(
        "conv_id", "node", "words", "last", F.when(F.col("top") == 0, F.concat(root, chain)).otherwise(chain).alias("chain"))


def _end_digests(ends: DataFrame) -> DataFrame:
    """``(node, ends_sha256)`` of the ids that end at each node, in order and joined by commas.

    The ids of a node are sorted and joined piece by piece in as many tasks as they need; only the pieces
    follow each other through the digest, which can't be computed in parts.
    """
    flat = "depth int, a bigint, b bigint"

    def join(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = batch.reset_index(drop=True)
            new = (rows[["depth", "a", "b"]] != rows[["depth", "a", "b"]].shift()).any(axis=1)
            number = new.cumsum()
            piece = rows.groupby(number).cumcount() // PIECE
            grouped = rows.assign(id=rows["conv_id"].astype(str)).groupby([number, piece], sort=False)
            yield pd.concat([grouped[["depth", "a", "b"]].first(), grouped["conv_id"].first().rename("first"), grouped["id"].agg(",".join).rename("ids")], axis=1)

    def digest(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, state, done = None, None, []
        for batch in batches:
            for depth, a, b, ids in zip(batch["depth"], batch["a"], batch["b"], batch["ids"]):
                if (depth, a, b) != now:
                    if now is not None:
                        done.append((*now, state.hexdigest()))
                    now, state = (depth, a, b), hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield pd.DataFrame(done, columns=["depth", "a", "b", "ends_sha256"])
            done = []
        if now is not None:
            yield pd.DataFrame([(*now, state.hexdigest())], columns=["depth", "a", "b", "ends_sha256"])

    rows = ends.select("node.depth", "node.a", "node.b", "conv_id")
    key = ("depth", "a", "b")
    pieces = rows.repartitionByRange(*key, "conv_id").sortWithinPartitions(*key, "conv_id").mapInPandas(join, f"{flat}, first bigint, ids string")
    digests = spread(pieces, *key).sortWithinPartitions(*key, "first").mapInPandas(digest, f"{flat}, ends_sha256 string")
    return digests.select(_node(F.col("depth"), F.col("a"), F.col("b")).alias("node"), "ends_sha256")


def _sums(rows: DataFrame, by: Column) -> DataFrame:
    return rows.groupBy(by.alias("node")).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))


def _completed(roots: DataFrame, deepest: int, height: int) -> DataFrame | None:
    """``(chain, leaves, saved)`` of the roots of all bands but the first, with what lies below them in deeper bands."""
    done, below = None, None
    for depth in range(deepest // height * height, 0, -height):
        level = roots.filter(F.col("node.depth") == depth)
        if below is not None:
            more = _sums(below, F.col("chain")[0]).withColumnsRenamed({"leaves": "more_leaves", "saved": "more_saved"})
            level = level.join(more, "node", "left").select(
                "node", "chain", (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
                (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"))
        below = materialise(level, f"band{depth}")
        done = below if done is None else done.unionByName(below)
    return done


def prefix_trie(turns: DataFrame, convs: DataFrame, s: TrieSettings = TrieSettings()) -> DataFrame:
    """All nodes of the trie, from the root without turns on.

    ``turns`` has ``(conv_id, place, digest, words)`` with places from 1 on, ``convs`` has ``(conv_id, length)``, one
    row for each conversation, also for those without turns. Columns of the result: ``conv_id`` (smallest member),
    ``depth``, ``parent_conv_id`` (null for the root), ``n_convs``, ``n_children``, ``n_leaves`` (childless nodes of the subtree),
    ``saved_tokens`` (words that are not needed again when every node of the subtree is stored once) and
    ``ends_sha256`` of the ids of the conversations that end there. Without conversations there is no node.
    """
    convs = materialise(convs, "convs")
    n, least, deepest = convs.agg(F.count(F.lit(1)), F.min("conv_id"), F.max("length")).first()
    spark = convs.sparkSession
    if not n:
        return spark.createDataFrame([], "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
                                         "saved_tokens bigint, ends_sha256 string")
    height = max(s.height, math.isqrt(deepest))
    root = _node(F.lit(0), F.lit(0), F.lit(0))
    paths = materialise(_paths(turns, height), "paths")
    # All members of a node agree on its words and chain.
    nodes = paths.groupBy("node").agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id"), F.max("words").alias("words"), F.first("chain").alias("chain"))
    top = spark.range(1).select(root.alias("node"), F.lit(n).cast("bigint").alias("n_convs"), F.lit(least).cast("bigint").alias("conv_id"), F.lit(0).cast("bigint").alias("words"), F.array(root).alias("chain"))
    nodes = materialise(nodes.unionByName(top), "nodes")
    size = F.size("chain")
    parent = F.when(F.col("node.depth") > 0, F.col("chain")[size - 2])
    children = nodes.filter("node.depth > 0").groupBy(parent.alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    counted = materialise(
        nodes.join(children, "node", "left").select(
            "node", "chain", parent.alias("parent"), "conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"),
            F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("bigint").alias("leaves"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved")),
        "counted")

    # Within bands: a root of a band adds to itself, any other node to all of its chain.
    is_root = F.col("node.depth") % height == 0
    within = counted.select(F.explode(F.when(is_root, F.array("node")).otherwise(F.col("chain"))).alias("node"), "leaves", "saved")
    local = materialise(_sums(within, F.col("node")), "local")
    roots = counted.filter(is_root & (F.col("node.depth") > 0)).select("node", "chain").join(local.filter(is_root), "node")
    done = _completed(roots, deepest, height)
    sums = local
    if done is not None:
        sums = sums.unionByName(done.select(F.explode(F.slice("chain", 1, size - 1)).alias("node"), "leaves", "saved"))

    ends = paths.filter("last").select("node", "conv_id").unionByName(convs.filter("length = 0").select(root.alias("node"), "conv_id"))
    digests = _end_digests(materialise(ends, "ends"))
    totals = _sums(sums, F.col("node")).withColumnsRenamed({"leaves": "n_leaves", "saved": "saved_tokens"})
    out = counted.drop("chain", "leaves", "saved").join(totals, "node").join(digests, "node", "left")
    above = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    with_parent = salted_join(out, above, "parent", "left")
    nothing = hashlib.sha256(b"").hexdigest()
    return with_parent.select("conv_id", F.col("node.depth").cast("bigint").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                              F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"))


def family_trie(df: DataFrame, family: int = 20, most: int = 3, s: TrieSettings = TrieSettings()) -> DataFrame:
    """The trie of plain conversations ``(conv_id, turn, role, text)``, after ``share_heads`` by a checksum of the id.

    Nulls and ties as in ``ordered_turns``; repeated rows are turns like any other; empty tables give no rows; other
    columns are not read.
    """
    ordered = materialise(ordered_turns(df), "turns")
    heads = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1)).cast("int")
    return prefix_trie(*share_heads(ordered, family, heads, most), s)


SQL = r"""
WITH placed AS (
  SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn ASC NULLS FIRST, md5(role), md5(text)) AS k
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)
), convs AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base, xor(list_reduce(list_concat([4294967295::BIGINT],
           flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda ch: [ascii(ch)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
           lambda crc, x: CASE WHEN x >= 0 THEN xor(crc, x) WHEN crc % 2 = 1 THEN xor(crc // 2, 3988292384) ELSE crc // 2 END), 4294967295) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM placed)
), rebuilt AS (
  SELECT c.conv_id, 0 AS part, k, role, text FROM convs c JOIN placed p ON p.conv_id = c.base AND k <= h
  UNION ALL SELECT c.conv_id, 1, k, role, text FROM convs c JOIN placed p ON p.conv_id = c.conv_id AND k > h
), turns AS (
  SELECT conv_id, md5(role) || md5(text) AS digest, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words,
         row_number() OVER (PARTITION BY conv_id ORDER BY part, k) AS depth FROM rebuilt
), prefixes AS (
  SELECT conv_id, depth, words, md5(string_agg(digest, '') OVER (PARTITION BY conv_id ORDER BY depth)) AS key FROM turns
  UNION ALL SELECT conv_id, 0, 0, '' FROM convs
), nodes AS (
  SELECT key, min(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, min(words) AS words FROM prefixes GROUP BY key
), ends AS (
  SELECT key, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS digest
  FROM (SELECT *, max(depth) OVER (PARTITION BY conv_id) AS length FROM prefixes) WHERE depth = length GROUP BY key
), linked AS (
  SELECT n.*, p.key AS parent FROM nodes n LEFT JOIN prefixes p ON p.conv_id = n.conv_id AND p.depth = n.depth - 1
), children AS (
  SELECT parent, count(*) AS n_children FROM linked WHERE parent IS NOT NULL GROUP BY parent
), up AS (
  SELECT a.key, count(*) FILTER (WHERE c.parent IS NULL) AS n_leaves, sum((n.n_convs - 1) * n.words) AS saved_tokens
  FROM nodes n JOIN prefixes a ON a.conv_id = n.conv_id AND a.depth <= n.depth LEFT JOIN children c ON c.parent = n.key GROUP BY a.key
)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, CAST(n.n_convs AS BIGINT) AS n_convs,
       CAST(coalesce(c.n_children, 0) AS BIGINT) AS n_children, CAST(u.n_leaves AS BIGINT) AS n_leaves, CAST(u.saved_tokens AS BIGINT) AS saved_tokens,
       coalesce(e.digest, sha256('')) AS ends_sha256
FROM linked n JOIN up u ON u.key = n.key LEFT JOIN nodes p ON p.key = n.parent LEFT JOIN children c ON c.parent = n.key LEFT JOIN ends e ON e.key = n.key"""
