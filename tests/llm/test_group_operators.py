"""Chosen-path join, source mix, k-means tree and preferences."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quartermill.llm import chosen_path, kmeans_tree, mixing, preferences, queries

SF = "/root/testdata/sf0.001"


def plain_classes(texts, similarity=0.8, n=5):
    sets = []
    for text in texts:
        words = (text or "").encode().split()
        sets.append({tuple(words[i:i + n]) for i in range(max(1, len(words) - n + 1))} if words else set())
    parent, links = list(range(len(texts))), [0] * len(texts)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and both + 1e-9 >= similarity * len(sets[i] | sets[j]):
                links[i] += 1
                links[j] += 1
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(texts))], links


def planted(seed, groups=12, copies=8, edits=6, words=60):
    rng = random.Random(seed)
    shared = " ".join(f"common{i}" for i in range(25))
    texts = []
    for g in range(groups):
        base = [f"g{g}w{rng.randint(0, 10**6)}" for _ in range(words)]
        for _ in range(rng.randint(1, copies)):
            own = list(base)
            for _ in range(rng.randint(0, edits)):
                own[rng.randrange(len(own))] = f"x{rng.randint(0, 10**6)}"
            texts.append(" ".join(own) + (" " + shared if rng.random() < 0.5 else ""))
    return texts + ["a b", "a b", "a  b", "a b c", "", None, " \n"]


@pytest.mark.parametrize("settings", [
    chosen_path.JoinSettings(), chosen_path.JoinSettings(leaf=3, depth=3, split_gain=9.0), chosen_path.JoinSettings(leaf=2, depth=1, recall=0.9999)])
def test_classes_and_links_equal_all_pairs(spark, settings):
    texts = planted(4)
    classes, links = plain_classes(texts)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").withColumns({"gid": F.lit("x"), "path": F.lit(1), "id": F.lit(2)})
    got = {r["doc_id"]: r for r in chosen_path.near_duplicates(df, s=settings).collect()}
    assert [got[i]["class_id"] for i in range(len(texts))] == classes
    assert [got[i]["n_links"] for i in range(len(texts))] == links


def test_a_large_group_of_near_copies_is_compared_in_blocks(spark):
    rng = random.Random(2)
    base = [f"w{i}" for i in range(150)]
    texts = []
    for _ in range(120):
        own = list(base)
        for _ in range(rng.randint(0, 5)):
            own[rng.randrange(150)] = f"x{rng.randint(0, 10**6)}"
        texts.append(" ".join(own))
    classes, links = plain_classes(texts)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in chosen_path.near_duplicates(df, s=chosen_path.JoinSettings(leaf=16, depth=2)).collect()}
    assert [got[i]["n_links"] for i in range(120)] == links
    assert [got[i]["class_id"] for i in range(120)] == classes


def test_one_of_each_keeps_a_row_per_class(spark):
    df = spark.createDataFrame(
        [(3, "one two three four five six"), (1, "one two three four five six"), (1, "one two three four five six"), (None, "one two three four five six"),
         (None, "all by itself"), (7, None), (8, "")], "doc_id bigint, text string").withColumn("_stay2", F.lit(1))
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "") for r in chosen_path.one_of_each(df).collect())
    assert got == [(False, 1, "one two three four five six"), (False, 7, ""), (False, 8, ""), (True, 0, "all by itself")]
    assert chosen_path.near_duplicates(df.limit(0)).count() == 0


def test_components_follow_long_chains(spark):
    edges = [(f"{i:03}", f"{i + 1:03}") for i in range(60)] + [("900", "901"), ("901", "900"), ("950", "950")]
    got = {r["node"]: r["least"] for r in chosen_path.components(spark.createDataFrame(edges, "a string, b string")).collect()}
    assert all(got[f"{i:03}"] == "000" for i in range(1, 61)) and got["901"] == "900" and "950" not in got


def test_runs_follow_from_the_recall():
    assert chosen_path.JoinSettings(recall=0.5).runs < chosen_path.JoinSettings().runs <= chosen_path.MAX_RUNS
    with pytest.raises(ValueError):
        chosen_path.JoinSettings(children=1.0, depth=12).runs


def test_links_whose_sketches_agree_little_are_found(spark):
    texts = []
    for seed in (24910, 33291, 51852):  # similarity 0.8, sketches that agree in 37, 37 and 38 of 64 positions
        rng = random.Random(seed)
        base = [f"w{rng.randint(0, 10**9)}" for _ in range(94)]
        own = list(base)
        own[20] = own[60] = "x"
        texts += [" ".join(base), " ".join(own)]
    assert plain_classes(texts) == ([0, 0, 2, 2, 4, 4], [1] * 6)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = sorted((r["doc_id"], r["class_id"], r["n_links"]) for r in chosen_path.near_duplicates(df, s=chosen_path.JoinSettings(recall=1 - 1e-9)).collect())
    assert got == [(i, i // 2 * 2, 1) for i in range(6)]


@pytest.mark.parametrize("settings", [chosen_path.JoinSettings(), chosen_path.JoinSettings(similarity=0.5, positions=32), chosen_path.JoinSettings(recall=0.9)])
def test_sketches_lose_next_to_nothing_of_the_recall(settings):
    rng = np.random.default_rng(3)
    limit, below = settings._sketch()
    assert 0 <= below <= settings.sketch_loss * (1 - settings.recall) and limit == settings.sketch_limit
    assert (rng.binomial(settings.positions, settings.similarity, 200_000) >= limit).all()


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").withColumn("tokens", F.lit("x"))


def test_budgets_go_to_siblings_before_ancestors(spark):
    leaves = spark.createDataFrame(
        [("a", "x", "a\x1fx", 100), ("a", "y", "a\x1fy", 1000), ("b", "z", "b\x1fz", 1000)], "_mix_l0 string, _mix_l1 string, _mix_leaf string, tokens bigint")
    mix = mixing.Mix(levels=("p", "q"), max_epochs=1)
    got = {r["_mix_leaf"]: r["budget"] for r in mixing.leaf_budgets(leaves, mix, 1000).collect()}
    assert got == {"a\x1fx": 100, "a\x1fy": 400, "b\x1fz": 500}  # y takes what x lacks, b is not touched
    got = {r["_mix_leaf"]: r["budget"] for r in mixing.leaf_budgets(leaves, mix, 1800).collect()}
    assert got == {"a\x1fx": 100, "a\x1fy": 800, "b\x1fz": 900}
    got = {r["_mix_leaf"]: r["budget"] for r in mixing.leaf_budgets(leaves, mix, 99999).collect()}
    assert got == {"a\x1fx": 100, "a\x1fy": 1000, "b\x1fz": 1000}
    weighted = mixing.Mix(levels=("p", "q"), max_epochs=1, weights={("b",): 3})
    got = {r["_mix_leaf"]: r["budget"] for r in mixing.leaf_budgets(leaves, weighted, 1000).collect()}
    assert got == {"a\x1fx": 100, "a\x1fy": 150, "b\x1fz": 750}


def test_prefixes_of_seeded_epochs(spark):
    rows = [(i, " ".join(["w"] * (1 + i % 7)), "en", "s1") for i in range(300)] + [(1000 + i, "w w w", "de", "s2") for i in range(20)]
    rows += [(5000, None, None, None), (5001, "", "en", "s1"), (None, "w w", "en", "s1"), (7, "w " * 8, "en", "s1")]
    mix = mixing.Mix(levels=("lang", "source"), budget_percent=50, max_epochs=3, seed=1)
    taken = mixing.select_mix(docs_of(spark, rows), mixing.count_words("text"), mix).collect()
    plan = {r["_mix_leaf"]: r for r in mixing.plan_mix(docs_of(spark, rows), mixing.count_words("text"), mix).collect()}
    size = lambda text: len((text or "").split())
    for leaf, p in plan.items():
        own = [r for r in taken if r["_mix_leaf"] == leaf]
        spent = sum(size(r["text"]) * r["_mix_epochs"] for r in own)
        assert p["budget"] <= spent <= p["budget"] + 20 or spent == p["tokens"] * mix.max_epochs
    german = [r["_mix_epochs"] for r in taken if r["source"] == "s2"]
    assert german == [3] * 20  # a short source is repeated as often as allowed
    again = mixing.select_mix(docs_of(spark, rows).repartition(5), mixing.count_words("text"), mix).collect()
    assert sorted(map(str, again)) == sorted(map(str, taken))
    assert set(taken[0].asDict()) == {"doc_id", "text", "lang", "source", "tokens", "_mix_leaf", "_mix_epochs"}
    assert mixing.select_mix(docs_of(spark, rows).limit(0), mixing.count_words("text"), mix).count() == 0
    with pytest.raises(ValueError):
        mixing.select_mix(docs_of(spark, rows).withColumn("_mix_x", F.lit(1)), mixing.count_words("text"), mix)


def exact(ids, x, k):
    out = {}
    for q in np.flatnonzero(ids % 100 == 0):
        d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        d[ids == ids[q]] = np.inf
        order = np.lexsort((ids, d))[:k]
        out[int(ids[q])] = [(int(ids[o]), d[o]) for o in order if np.isfinite(d[o])]
    return out


def test_neighbours_reach_the_recall(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()
    ids, x = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], float)
    want, hits, total = exact(ids, x, 10), 0, 0
    got = {}
    for r in queries.op7_kmeans_tree(spark, "/root/testdata/sf0.1").collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    for q, near in want.items():
        mine = sorted(got[q])
        assert [m[0] for m in mine] == list(range(1, 11)) and [m[1:] for m in mine] == sorted((m[1:] for m in mine), key=lambda m: (m[1], m[0]))
        place = {int(i): k for k, i in enumerate(ids)}
        assert all(m[2] == pytest.approx(np.sqrt(((x[place[m[1]]] - x[place[q]]) ** 2).sum()), abs=1e-12) for m in mine)
        hits += len({m[1] for m in mine} & {n[0] for n in near})
        total += len(near)
    assert hits / total >= 0.9


def test_neighbours_cover_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]),
            (8, [1.0, 2.0, 3.0]), (9, [0.0, 1.0]), (9, [0.0, 1.0]), (None, [1.0, 1.0]), (100, [0.0, 2.0]), (200, [0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumns({"leaf": F.lit("x"), "rank": F.lit(1)})
    got = [(r["query_id"], r["rank"], r["vec_id"]) for r in kmeans_tree.nearest_neighbours(df, F.col("vec_id") % 100 == 0, 3).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1), (0, 2, 2), (0, 3, 9), (100, 1, 9), (100, 2, 0), (100, 3, 1)]
    few = kmeans_tree.nearest_neighbours(df, F.col("vec_id") % 100 == 0, 10).groupBy("query_id").count().collect()
    assert {r["count"] for r in few} == {4}
    assert kmeans_tree.nearest_neighbours(df.limit(0), F.col("vec_id") % 100 == 0, 3).count() == 0


def test_equal_vectors_are_cut_into_blocks(spark):
    rows = [(i, [1.0, 0.0]) for i in range(300)] + [(1000 + i, [0.0, 1.0 + i]) for i in range(50)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    small = kmeans_tree.TreeSettings(leaf_rows=20, block_rows=32, block_queries=2, recall=1.0)
    got = kmeans_tree.nearest_neighbours(df, F.col("vec_id") % 100 == 0, 3, s=small).filter("query_id < 1000").orderBy("query_id", "rank").collect()
    assert [(r["query_id"], r["vec_id"]) for r in got] == [(0, 1), (0, 2), (0, 3), (100, 0), (100, 1), (100, 2), (200, 0), (200, 1), (200, 2)]


def test_close_copies_of_long_vectors_are_ranked_exactly(spark):
    rng = np.random.default_rng(4)
    x = 1e4 + 1e-3 * rng.normal(size=(300, 8))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    got = kmeans_tree.nearest_neighbours(df, F.col("vec_id") % 100 == 0, 10, s=kmeans_tree.TreeSettings(leaf_rows=1000)).orderBy("query_id", "rank").collect()
    want = exact(np.arange(300), x, 10)
    assert [(r["query_id"], r["vec_id"]) for r in got] == [(q, n[0]) for q in sorted(want) for n in want[q]]


def copies_and_lone_vectors(groups, copies, lone, dim=8):
    rng = np.random.default_rng(1)
    return np.concatenate([np.repeat(rng.normal(size=(groups, dim)), copies, axis=0), 4 * rng.normal(size=(lone, dim))])


def test_every_query_gets_its_neighbours_beside_a_hot_group(spark):
    x = copies_and_lone_vectors(4, 300, 60)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    small = kmeans_tree.TreeSettings(leaf_rows=8, calibration_queries=100)
    got = kmeans_tree.nearest_neighbours(df, F.col("vec_id") >= 1200, 10, s=small).groupBy("query_id").count().collect()
    assert len(got) == 60 and {r["count"] for r in got} == {10}


def test_calibration_counts_copies_as_one_query():
    s = kmeans_tree.TreeSettings(leaf_rows=32)
    x = copies_and_lone_vectors(10, 480, 200)
    tree = kmeans_tree.Tree(8).grow(x, s)
    leaf, visits = tree.assign(x), kmeans_tree.calibrate(tree, x, 10, s)
    hits = 0
    for q in range(4800, 5000):
        d = ((x - x[q]) ** 2).sum(axis=1)
        d[q] = np.inf
        hits += np.isin(leaf[np.argsort(d, kind="stable")[:10]], tree.visit(x[q], visits)).sum()
    assert hits / 2000 >= 0.95


TURNS = "conv_id bigint, turn bigint, role string, text string"


def test_shared_prefix_is_rendered_once_and_spans_cut_the_replies(spark):
    chosen = spark.createDataFrame([(1, 0, "system", "s"), (1, 1, "user", "hé <|x"), (1, 2, "assistant", "good"), (2, 0, "user", "q"), (None, 0, "user", "n"),
                                    (3, 0, None, None), (3, 1, "assistant", "a"), (3, 1, "assistant", "a")], TURNS).withColumn("side", F.lit(1))
    rejected = spark.createDataFrame([(1, 0, "system", "s"), (1, 1, "user", "hé <|x"), (1, 2, "assistant", "bad"), (1, 3, "user", "t"), (1, 4, "assistant", "zz"),
                                      (4, 0, "user", "r"), (3, 0, "", ""), (3, 1, "assistant", "a"), (3, 1, "assistant", "a")], TURNS)
    got = {r["pair_id"]: r for r in preferences.format_preferences(chosen, rejected).collect()}
    assert set(got) == {1, 2, 3, 4}
    one = got[1]
    assert one["n_common"] == 2
    assert one["prompt"] == "<|im_start|>system\ns<|im_end|>\n<|im_start|>user\nhé < |x<|im_end|>\n"
    cut = lambda text, spans: [text[s["begin"]:s["end"]] for s in spans]
    assert cut(one["chosen"], one["chosen_spans"]) == ["good<|im_end|>\n"]
    assert cut(one["rejected"], one["rejected_spans"]) == ["bad<|im_end|>\n", "zz<|im_end|>\n"]
    assert (got[2]["n_common"], got[2]["prompt"], got[2]["rejected"]) == (0, "", "")
    assert (got[4]["n_common"], got[4]["chosen"]) == (0, "")
    assert (got[3]["n_common"], got[3]["chosen"], got[3]["rejected"], got[3]["chosen_spans"]) == (3, "", "", [])
    assert preferences.format_preferences(chosen.limit(0), rejected.limit(0)).count() == 0


def test_pairs_keep_every_turn_and_diverge_where_the_neighbour_goes_on(spark):
    rows = [(0, 0, "user", "q"), (0, 1, "assistant", "a"), (0, 2, "user", "later"), (0, None, "system", "s"), (1, 0, "user", "q1"), (1, 1, "assistant", "a1"),
            (1, 2, "user", "u1"), (1, 3, "assistant", "b1"), (4, 0, None, None), (4, 0, "user", "tie"), (7, 5, "user", "x"), (7, 6, "assistant", "y"), (None, 0, "user", "nobody")]
    df = spark.createDataFrame(rows, TURNS).withColumn("side", F.lit(1))
    got = {r["pair_id"]: r for r in preferences.format_preferences(*preferences.diverging_pairs(df)).collect()}
    assert set(got) == {0, 1, 4, 6, 7}
    assert got[0]["prompt"] == "<|im_start|>system\ns<|im_end|>\n" and got[0]["n_common"] == 1  # a null turn is the first
    assert "later" in got[0]["chosen"] and got[0]["chosen"].count("im_start") == 3 and "b1" in got[0]["rejected"]
    assert got[1]["n_common"] == 2 and "later" in got[1]["rejected"] and "b1" in got[1]["chosen"]
    assert (got[4]["n_common"], got[4]["chosen"], got[4]["rejected"]) == (2, "", "")
    assert (got[6]["n_common"], got[6]["chosen"], got[6]["rejected"].count("im_start")) == (0, "", 1)


def test_every_given_turn_is_in_the_result(spark):
    table = spark.read.parquet(f"{SF}/conversations.parquet")
    result = {r["pair_id"]: r["prompt"] + r["chosen"] for r in queries.op10_preferences(spark, SF).collect()}
    assert all((r["text"] or "").replace("<|", "< |") in result[r["conv_id"]] for r in table.collect())
    assert {r["n_common"] for r in queries.op10_preferences(spark, SF).select("n_common").collect()} >= {1, 2, 3}


def test_preferences_run_no_python(spark):
    plan = queries.op10_preferences(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
