import datetime as dt
import math
import pickle
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quartermill import session
from quartermill.functions.skew import global_rank, hot_keys, salted_join
from quartermill.operators import grid, implicit_als, interactions, ranking, recommend, spectral, text, vectors
from quartermill.plans import decompose, inputs, purchases
from quartermill.session import materialise

CELL = "user_id bigint, item_id string, n_rows bigint, quantity bigint, last_at struct<invoice_date: date, invoice: string, line_no: int>"


def brute_popularity(train, users, k):
    pop = {}
    for u, i, w in train:
        pop[i] = pop.get(i, 0) + round(w, 9)
    order = sorted(pop, key=lambda i: (round(pop[i], 9), i), reverse=True)
    seen = {}
    for u, i, _ in train:
        seen.setdefault(u, set()).add(i)
    return {u: [i for i in order if i not in seen.get(u, set())][:k] for u in users}


def lists(recs):
    out = {}
    for r in recs.orderBy("user_id", "rank").collect():
        out.setdefault(r["user_id"], []).append(r["item_id"])
    return out


def skewed_train(seed=0, users=40, items=60):
    """User 0 has every item but two, and item i00 belongs to every user."""
    draw = random.Random(seed)
    names = [f"i{i:02d}" for i in range(items)]
    rows = {(0, i) for i in names[:-2]} | {(u, "i00") for u in range(users)}
    rows |= {(u, draw.choice(names)) for u in range(users) for _ in range(8)}
    return [(u, i, round(draw.uniform(0.5, 3), 3)) for u, i in sorted(rows)]


def test_popularity_equals_brute_force_with_a_user_who_has_nearly_everything(spark):
    train = skewed_train()
    df = spark.createDataFrame(train, "user_id bigint, item_id string, weight double")
    users = [*range(40), 777]
    wanted = spark.createDataFrame([(u,) for u in users], "user_id bigint")
    got = lists(recommend.rec_popularity(df, wanted, 5))
    want = brute_popularity(train, users, 5)
    assert got == {u: v for u, v in want.items() if v}


def test_first_positions_are_sent_to_the_users_and_only_later_ones_are_met_by_a_shuffle(spark):
    train = skewed_train()
    df = spark.createDataFrame(train, "user_id bigint, item_id string, weight double")
    wanted = spark.createDataFrame([(u,) for u in [*range(40), 777]], "user_id bigint")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        recs = recommend.rec_popularity(df, wanted, 5)
        plan = recs._jdf.queryExecution().sparkPlan().toString()
        got = lists(recs)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("BroadcastHashJoin [position") == 1 and "_salt" not in plan
    want = brute_popularity(train, [*range(40), 777], 5)
    assert got == {u: v for u, v in want.items() if v}  # user 0 asks for the last positions


@pytest.mark.parametrize("blocks", [(2048, 8192), (7, 11)])
def test_top_k_equals_brute_force_for_any_blocking(spark, blocks):
    rng = np.random.default_rng(1)
    u, v = rng.integers(-2, 3, (30, 3)).astype(float), rng.integers(-2, 3, (50, 3)).astype(float)  # many ties
    users = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(u)], "user_id bigint, vec array<double>")
    items = spark.createDataFrame([(f"i{i:02d}", x.tolist()) for i, x in enumerate(v)], "item_id string, vec array<double>")
    seen = {(a, f"i{b:02d}") for a in range(30) for b in range(50) if (a * 7 + b) % 5 == 0} | {(3, f"i{b:02d}") for b in range(48)}
    pairs = spark.createDataFrame(sorted(seen), "user_id bigint, item_id string")
    got = lists(vectors.top_k_scores(users, items, 4, pairs, *blocks))
    scores = u @ v.T
    for a in range(30):
        free = [(scores[a, b], f"i{b:02d}") for b in range(50) if (a, f"i{b:02d}") not in seen]
        assert got[a] == [i for _, i in sorted(free, reverse=True)[:4]]
    spans = {r["user_id"]: (r["lo"], r["hi"]) for r in vectors.score_range(users, items, *blocks).collect()}
    assert spans == {a: (scores[a].min(), scores[a].max()) for a in range(30)}


def test_short_items_are_skipped_and_lists_stay_the_same(spark):
    rng = np.random.default_rng(4)
    u, v = rng.normal(size=(40, 6)), rng.normal(size=(300, 6)) * (1 / np.arange(1, 301))[:, None]
    users = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(u)], "user_id bigint, vec array<double>")
    items = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "item_id bigint, vec array<double>").repartition(3)
    seen = spark.createDataFrame([(i, j) for i in range(0, 40, 2) for j in range(12)], "user_id bigint, item_id bigint")
    state, blocks = vectors.top_k_state(users, items, 5, seen, item_block=20)
    rows = state.collect()
    assert blocks == 15 and sum(r["visited"] for r in rows) < 0.5 * blocks * len(rows) and len(rows) == 40
    for r in rows:
        scores = np.round(v @ u[r["user_id"]], vectors.SCORE_DIGITS)
        if r["user_id"] % 2 == 0:
            scores[:12] = -np.inf
        assert r["best"] == sorted(range(300), key=lambda i: (-scores[i], -i))[:5]
    plan = vectors.top_k_scores(users, items, 5, seen, item_block=20)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "CoGroup" not in plan  # the lists are read as they were written


def test_items_with_equal_vectors_are_scored_once(spark, monkeypatch):
    rng = np.random.default_rng(8)
    kinds = rng.integers(-1, 2, (6, 3)).astype(float)  # many ties between kinds as well
    v = kinds[rng.integers(0, 6, 400)]
    u = rng.integers(-1, 3, (20, 3)).astype(float)
    users = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(u)], "user_id bigint, vec array<double>")
    items = spark.createDataFrame([(f"i{i:03d}", x.tolist()) for i, x in enumerate(v)], "item_id string, vec array<double>")
    seen = {(a, f"i{b:03d}") for a in range(20) for b in range(400) if b > 395 - 4 * a} | {(5, f"i{b:03d}") for b in range(397)}
    pairs = spark.createDataFrame(sorted(seen), "user_id bigint, item_id string")
    scored = []
    blocks = vectors._blocks
    monkeypatch.setattr(vectors, "_blocks", lambda kept, size: scored.append(kept.count()) or blocks(kept, size))
    for own, known in ((pairs, seen), (pairs.filter("user_id != 5"), {p for p in seen if p[0] != 5}), (None, set())):
        got = lists(vectors.top_k_scores(users, items, 4, own, 3, 17))
        scores = u @ v.T
        for a in range(20):
            free = [(scores[a, b], f"i{b:03d}") for b in range(400) if (a, f"i{b:03d}") not in known]
            assert got.get(a, []) == [i for _, i in sorted(free, reverse=True)[:4]]
    assert scored[2] == 4 * len(np.unique(v, axis=0)) and scored[1] < 200  # not the 400 there are
    spans = {r["user_id"]: (r["lo"], r["hi"]) for r in vectors.score_range(users, items).collect()}
    assert scored[3] == len(np.unique(v, axis=0)) and spans == {a: (scores[a].min(), scores[a].max()) for a in range(20)}


def test_equal_vectors_share_a_block_and_blocks_share_a_round(spark, monkeypatch):
    rng = np.random.default_rng(11)
    kinds = rng.choice([-1.0, 1.0], (9, 4))  # all of one length
    v = np.unique(kinds, axis=0)[rng.integers(0, len(np.unique(kinds, axis=0)), 120)]
    items = spark.createDataFrame([(f"i{i:03d}", x.tolist()) for i, x in enumerate(v)], "item_id string, vec array<double>")
    stored, lengths, together = vectors._blocks(items, 40)
    spans = stored.groupBy("vec").agg(F.countDistinct("block").alias("n")).agg(F.sum("n")).first()[0]
    assert len(lengths) == 3 and spans <= len(np.unique(v, axis=0)) + 2 and together > 3
    users = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(rng.integers(-2, 3, (30, 4)).astype(float))], "user_id bigint, vec array<double>")
    written, plain = [], vectors.materialise
    monkeypatch.setattr(vectors, "materialise", lambda df, label: written.append(label) or plain(df, label))
    one = lists(vectors.top_k_scores(users, items, 30, None, 8, 5))
    assert written.count("scoring") == 1
    monkeypatch.setattr(vectors, "ROUND_NUMBERS", 40)  # two blocks a round: lists are carried from round to round
    assert lists(vectors.top_k_scores(users, items, 30, None, 8, 5)) == one
    assert written.count("scoring") > 3


def test_packed_blocks_pass_through_the_driver_in_parts_and_rounds_leave_one_state(spark, monkeypatch):
    rng = np.random.default_rng(12)
    u, v = rng.normal(size=(60, 5)), rng.normal(size=(400, 5)) * rng.uniform(0.2, 3, (400, 1))
    u[3], v[7] = 0.0, 0.0
    users = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(u)], "user_id bigint, vec array<double>")
    items = spark.createDataFrame([(f"i{i:03d}", x.tolist()) for i, x in enumerate(v)], "item_id string, vec array<double>")
    monkeypatch.setattr(vectors, "ROUND_NUMBERS", 500)  # four rounds of ten blocks
    monkeypatch.setattr(vectors, "PART_NUMBERS", 100)  # two blocks a part
    sent, written, gone = [], [], []
    plain, release = vectors.materialise, vectors.release
    monkeypatch.setattr(vectors, "materialise", lambda df, label: (t := plain(df, label), written.append((label, t.scratch_path)))[0])
    monkeypatch.setattr(vectors, "release", lambda *tables: (gone.extend(t.scratch_path for t in tables), release(*tables))[1])
    monkeypatch.setattr(type(items), "toPandas", lambda df: pytest.fail("vectors of items on the driver"))
    cast = spark.sparkContext.broadcast
    monkeypatch.setattr(spark.sparkContext, "broadcast", lambda value: sent.append(value) or cast(value))
    got = {r["user_id"]: (r["best"], r["scores"]) for r in vectors.top_k_state(users, items, 6, None, 7, 10)[0].collect()}
    scores = np.round(u @ v.T, vectors.SCORE_DIGITS)
    for a in range(60):
        want = sorted(range(400), key=lambda b: (scores[a, b], b), reverse=True)[:6]
        assert got[a][0] == [f"i{b:03d}" for b in want] and np.allclose(got[a][1], scores[a, want], atol=2e-9)
    assert all(len(part) == 2 and all(isinstance(b, bytes) for b in part) for part in sent)
    states = [path for label, path in written if label == "scoring"]
    assert len(states) > 1 and set(states[:-1]) <= set(gone) and {p for label, p in written if label in ("item_blocks", "packed_blocks")} <= set(gone)
    spans = {r["user_id"]: (r["lo"], r["hi"]) for r in vectors.score_range(users, items, 7, 10).collect()}
    assert all(np.allclose(spans[a], ((u @ v.T)[a].min(), (u @ v.T)[a].max()), rtol=1e-13, atol=0) for a in range(60))


@pytest.mark.parametrize("size", [1e-160, 1e-20, 1.0, 1e20, 1e140])
def test_single_precision_only_sorts_out_what_cannot_be_in_a_list(size):
    rng = np.random.default_rng(13)
    v = rng.normal(size=(3000, 8)) * size
    v[1000:2000] = v[:1000] * (1 + rng.uniform(-1e-9, 1e-9, (1000, 1)))  # apart only in double precision
    u = rng.normal(size=(20, 8))
    norm = np.linalg.norm(u, axis=1)
    own = vectors._block(pd.DataFrame({"item_id": np.arange(3000), "vec": list(v)}), float(np.linalg.norm(v, axis=1).max()))
    shared = type("Shared", (), {"value": None})()
    shared.value = [pickle.dumps(own)]
    block = vectors._opened(shared)[0]
    none = np.zeros(0, int)
    r, c, score = vectors._candidates(block, u, vectors._units(u, norm), norm, np.full(20, -np.inf), 5, none, none)
    row, score, name = vectors._best(r, score, block.ids[c].astype(object), 5)
    exact = np.round(u @ v.T, vectors.SCORE_DIGITS)
    for a in range(20):
        want = sorted(range(3000), key=lambda b: (exact[a, b], b), reverse=True)[:5]
        if size in (1e20, 1e140):  # rounding to nine digits does nothing there, and products differ in the last bit
            assert np.allclose(score[row == a], exact[a, want], rtol=1e-14)
        else:
            assert name[row == a].tolist() == want


def test_scoring_of_nobody_or_nothing(spark):
    users = spark.createDataFrame([(1, [1.0, 2.0])], "user_id bigint, vec array<double>")
    items = spark.createDataFrame([("a", [0.0, 0.0])], "item_id string, vec array<double>")
    assert [tuple(r) for r in vectors.top_k_scores(users, items, 3).select("item_id", "score", "rank").collect()] == [("a", 0.0, 1)]
    assert vectors.top_k_scores(users.limit(0), items, 3).count() == vectors.top_k_scores(users, items.limit(0), 3).count() == 0


def test_implicit_als_equals_a_dense_solver_with_rows_cut_into_pieces(spark):
    rng = np.random.default_rng(7)
    n_users, n_items, size, reg = 25, 18, 3, 0.3
    weights = np.where(rng.random((n_users, n_items)) < 0.3, rng.uniform(0.5, 4, (n_users, n_items)), 0.0)
    weights[0], weights[:, 0] = rng.uniform(0.5, 4, n_items), rng.uniform(0.5, 4, n_users)  # one user and one item with everything
    cells = spark.createDataFrame([(int(u), f"i{i:02d}", float(weights[u, i])) for u, i in zip(*np.nonzero(weights))], "user_id bigint, item_id string, weight double")
    users, items = implicit_als.als(cells, size, 4, reg, block_cells=20, piece_cells=5)
    x = np.array([r["vec"] for r in users.orderBy("user_id").collect()])
    y = np.array([r["vec"] for r in items.orderBy("item_id").collect()])
    start = cells.select(F.col("item_id").alias("id")).distinct().orderBy("id").select(F.array(*[F.xxhash64("id", F.lit(42 * 10_007 + j)) / float(2**63) * 0.01 for j in range(size)]).alias("v"))
    b = np.array([r["v"] for r in start.collect()])

    def solve(fixed, c):
        return np.array([np.linalg.solve(fixed.T @ (fixed * np.where(row > 0, row, 1.0)[:, None]) + reg * np.eye(size), fixed.T @ row) for row in c])

    for _ in range(4):
        a = solve(b, weights)
        b = solve(a, weights.T)
    assert np.allclose(x, a, atol=1e-9) and np.allclose(y, b, atol=1e-9)
    rows = grid.deal(cells, "user_id", "item_id", 200, 20, 5).rows
    assert rows.filter("id = 0").select("block").distinct().count() > 1 and rows.filter("id = 0 AND NOT split").count() == 0
    empty = implicit_als.als(cells.limit(0), 2, 1)
    assert empty[0].count() == empty[1].count() == 0


def test_half_steps_bring_their_gram_matrix_and_send_vectors_without_a_join(spark, monkeypatch):
    cells = spark.range(400).selectExpr("id % 80 AS user_id", "cast(id % 50 AS string) AS item_id", "1.0D + id % 3 AS weight")
    calls, steps = [], []
    plain, half = implicit_als.gram, implicit_als._half_step
    monkeypatch.setattr(implicit_als, "gram", lambda df, vec, size: calls.append(size) or plain(df, vec, size))
    monkeypatch.setattr(implicit_als, "_half_step", lambda *given: steps.append(half(*given)) or steps[-1])
    _, items = implicit_als.als(cells, 4, 3, block_cells=100)
    assert calls == [4] and len(steps) == 6  # only that of the start
    assert np.allclose(steps[-1][1], plain(items, "vec", 4), atol=1e-12)
    to = {r["id"]: sorted(r["to"]) for r in steps[-1][0].collect()}
    dealt = grid.deal(cells, "user_id", "item_id", 400, 100)
    assert to == {r["id"]: sorted(r["b"]) for r in dealt.links.groupBy("id").agg(F.collect_set("block").alias("b")).collect()}


def test_half_steps_leave_no_table_but_the_last_and_blocks_fill_the_tasks(spark, monkeypatch):
    cells = spark.range(4000).selectExpr("id % 170 AS user_id", "cast(id % 130 AS string) AS item_id", "1.0D + id % 3 AS weight").distinct()
    written, gone = [], []
    plain, release = implicit_als.materialise, implicit_als.release
    monkeypatch.setattr(implicit_als, "materialise", lambda df, label: (t := plain(df, label), written.append((label, t.scratch_path)))[0])
    monkeypatch.setattr(implicit_als, "release", lambda *tables: (gone.extend(t.scratch_path for t in tables), release(*tables))[1])
    users, items = implicit_als.als(cells, 3, 4, block_cells=300)
    halves = [path for label, path in written if label == "als_half"]
    assert len(halves) == 8 and set(halves[:-2]) <= set(gone) and not set(halves[-2:]) & set(gone)
    assert users.count() == 170 and items.count() == 130 and items.schema["vec"].dataType.simpleString() == "array<double>"
    dealt = grid.deal(cells, "user_id", "item_id", 4000, 500)
    names = [r["block"] for r in dealt.rows.select("block").distinct().collect()]
    tasks = spark.createDataFrame([(b,) for b in names], "block int").select(F.pmod(F.hash("block"), F.lit(dealt.blocks)).alias("t")).distinct().count()
    assert dealt.blocks == len(names) == tasks == 8


def test_shuffle_files_go_with_the_table_that_was_written(spark):
    before = spark.conf.get(session.SHUFFLE_CLEANUP, None)
    table = session.materialise(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "counts")
    assert table.count() == 7 and spark.conf.get(session.SHUFFLE_CLEANUP, None) == before
    assert session.materialise(spark.range(3), "again").count() == 3
    session.release(table)
    path = spark._jvm.org.apache.hadoop.fs.Path(table.scratch_path)
    assert not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def test_faults_of_lists_are_counted_with_one_meeting_of_a_list(spark):
    train = spark.createDataFrame([(1, "a", 1.0), (1, "a", 1.0), (2, "z", 1.0)], "user_id bigint, item_id string, weight double")
    rows = [("m", 1, "a", 1, 5.0), ("m", 1, "b", 2, 4.0), ("m", 1, "b", 3, 4.0), ("m", 2, "a", 1, 1.0), ("m", 2, "c", 2, 2.0), ("n", 3, "x", 1, 0.0)]
    recs = spark.createDataFrame(rows, "model string, user_id bigint, item_id string, rank int, score double")
    faults = decompose.list_faults(recs, train)
    assert sorted(map(tuple, faults.collect())) == [("m", 5, 2, 1, 1, 2), ("n", 1, 1, 0, 0, 0)]
    plan = faults._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Expand" not in plan and plan.count("LogicalRDD") + plan.count("LocalRelation") <= 2


def test_rows_of_few_cells_are_solved_in_systems_of_their_length():
    rng = np.random.default_rng(3)
    size, lengths = 6, rng.integers(1, 12, 200)
    matrix, starts = rng.normal(size=(40, size)), np.cumsum(lengths) - lengths
    places, weights = rng.integers(0, 40, lengths.sum()), rng.uniform(0.2, 5, lengths.sum())
    base = matrix.T @ matrix + 0.1 * np.eye(size)
    got = implicit_als.solve_rows(base, matrix, places, weights, starts, lengths)
    for x, low, n in zip(got, starts, lengths):
        v, c = matrix[places[low:low + n]], weights[low:low + n]
        assert np.allclose(x, np.linalg.solve(base + (v * (c - 1)[:, None]).T @ v, c @ v), atol=1e-10)


def test_a_matrix_of_one_block_is_dealt_to_all_cores(spark):
    cells = spark.range(400).selectExpr("id % 80 AS user_id", "id AS item_id", "1.0D AS weight")
    dealt = grid.deal(cells, "user_id", "item_id", 400, block_cells=1000, piece_cells=10)
    assert dealt.blocks == spark.sparkContext.defaultParallelism and dealt.rows.select("block").distinct().count() > 1


def test_products_go_through_blocks_and_cut_a_hot_item(spark):
    rng = np.random.default_rng(5)
    dense = np.where(rng.random((60, 20)) < 0.2, rng.normal(size=(60, 20)), 0.0)
    dense[:, 3] = rng.normal(size=60)  # one item with a third of the cells
    cells = spark.createDataFrame([(int(u), f"i{i:02d}", float(dense[u, i])) for u, i in zip(*np.nonzero(dense))], "user_id bigint, item_id string, weight double")
    vecs = rng.normal(size=(60, 4))
    users = spark.createDataFrame([(u, v.tolist()) for u, v in enumerate(vecs)], "id bigint, vec array<double>")
    dealt = grid.deal(cells, "item_id", "user_id", cells.count(), block_cells=30, piece_cells=10)
    got = {r["id"]: r["vec"] for r in grid.product(dealt, users, 4).collect()}
    assert all(np.allclose(got[f"i{i:02d}"], dense[:, i] @ vecs) for i in range(20)) and len(got) == 20
    hot = dealt.rows.filter("id = 'i03'").select("block", F.size("ids").alias("n")).collect()
    assert len({r["block"] for r in hot}) > 2 and max(r["n"] for r in hot) < 25 and sum(r["n"] for r in hot) == 60
    assert dealt.links.count() == dealt.links.distinct().count() <= cells.count()


def test_hybrid_equals_the_written_out_blend(spark):
    rng = np.random.default_rng(2)
    su, si = rng.normal(size=(6, 3)), rng.normal(size=(20, 3))
    topics = np.abs(rng.normal(size=(20, 4)))
    topics /= np.linalg.norm(topics, axis=1, keepdims=True)
    topics[5] = 0
    names = [f"i{i:02d}" for i in range(20)]
    train = [(u, names[(u * 3 + j) % 20], 1.0 + j) for u in range(5) for j in range(4)] + [(5, "i05", 2.0)]
    got = lists(recommend.rec_hybrid(
        spark.createDataFrame([(u, x.tolist()) for u, x in enumerate(su)], "user_id bigint, vec array<double>"),
        spark.createDataFrame([(n, x.tolist()) for n, x in zip(names, si, strict=True)], "item_id string, vec array<double>"),
        spark.createDataFrame([(n, x.tolist()) for n, x in zip(names, topics, strict=True)], "item_id string, vec array<double>"),
        spark.createDataFrame(train, "user_id bigint, item_id string, weight double"),
        spark.createDataFrame([(u,) for u in range(7)], "user_id bigint"), 3, 4, 5))
    for u in range(6):
        mine = {i: w for a, i, w in train if a == u}
        raw = si @ su[u]
        score = 0.6 * (raw - raw.min()) / (raw.max() - raw.min())
        profile = sum(topics[names.index(i)] * w for i, w in mine.items())
        if np.linalg.norm(profile) > 0:  # user 5 only has the item without topics
            c = topics @ (profile / np.linalg.norm(profile))
            score = score + 0.4 * (c - c.min()) / (c.max() - c.min())
        order = sorted((i for i in names if i not in mine), key=lambda i: score[names.index(i)], reverse=True)
        assert got[u] == order[:5]
    assert got[6] == brute_popularity(train, [6], 5)[6]


def test_fitted_models_beat_popularity_on_two_taste_groups(spark):
    draw = random.Random(5)
    rows, held = set(), {}
    for u in range(80):
        own = [f"i{i:02d}" for i in range(40) if (i < 20) == (u % 2 == 0)]
        picks = draw.sample(own, 12)
        held[u] = picks.pop()
        rows |= {(u, i) for i in picks}
        rows.add((u, f"i{draw.randrange(40):02d}"))
    rows -= set(held.items())
    train = spark.createDataFrame([(u, i, math.log(2.0)) for u, i in sorted(rows)], "user_id bigint, item_id string, weight double")
    test = spark.createDataFrame(sorted(held.items()), "user_id bigint, item_id string")
    items = spark.createDataFrame([(f"i{i:02d}",) for i in range(40)], "item_id string")
    users, factors, _ = spectral.truncated_svd_factors(train, items, 2, iterations=3)
    als_u, als_i = recommend.als_factors(train, train, rank=4, iterations=5)
    recs = {"Popularity": recommend.rec_popularity(train, test, 50), "SVD": recommend.rec_factors(users, factors, train, test, 50),
            "ALS": recommend.rec_factors(als_u, als_i, train, test, 50)}
    union = None
    for name, one in recs.items():
        one = one.select(F.lit(name).alias("model"), "user_id", "item_id", "rank")
        union = one if union is None else union.unionByName(one)
    verdicts = {r["model"]: r["verdict"] for r in ranking.beat_popularity(ranking.evaluate_all(union, test)).collect()}
    assert verdicts == {"Popularity": "ties", "SVD": "beats", "ALS": "beats"}


def test_metrics_count_users_without_lists_and_models_without_hits(spark):
    test = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, "d")], "user_id bigint, item_id string")
    recs = spark.createDataFrame([("m", 1, "a", 1), ("m", 2, "x", 1), ("m", 2, "b", 2), ("m", 3, "c", 15), ("none", 1, "z", 1)],
                                 "model string, user_id bigint, item_id string, rank int")
    out = {r["model"]: r for r in ranking.evaluate_all(recs, test).collect()}
    m = out["m"]
    assert (m["recall_10"], m["recall_20"], m["n_users"]) == (0.5, 0.75, 4)
    assert m["ndcg_10"] == pytest.approx((1 + 1 / math.log2(3)) / 4) and m["map_10"] == pytest.approx(1.5 / 4)
    assert m["map_20"] == pytest.approx((1.5 + 1 / 15) / 4) and out["none"]["recall_50"] == 0


def test_metrics_read_the_lists_once(spark, tmp_path):
    test = spark.createDataFrame([(1, "a"), (2, "b")], "user_id bigint, item_id string")
    spark.createDataFrame([("m", 1, "a", 1), ("none", 2, "z", 1)], "model string, user_id bigint, item_id string, rank int").write.parquet(f"{tmp_path}/lists")
    scored = ranking.evaluate_all(spark.read.parquet(f"{tmp_path}/lists"), test)
    assert scored._jdf.queryExecution().optimizedPlan().toString().count("parquet") == 1
    assert {r["model"]: (r["recall_10"], r["n_users"]) for r in scored.collect()} == {"m": (0.5, 2), "none": (0.0, 2)}


def test_lists_of_the_models_are_not_stored_and_a_shared_name_is_counted_once(spark, monkeypatch):
    sf, stored, counted = "/root/testdata/sf0.001", [], []
    keep, count = inputs.materialise, text.term_counts
    monkeypatch.setattr(inputs, "materialise", lambda df, label="stage": (stored.append(label), keep(df, label))[1])
    monkeypatch.setattr(text, "term_counts", lambda docs, *a, **b: (counted.append(docs.count()), count(docs, *a, **b))[1])
    inputs.forget_stages()
    got = purchases.evaluate_all(spark, sf).collect()
    names = purchases.item_text(spark, sf).select("p_name").distinct().count()
    assert len(got) == 3 and "all_recs" not in stored and stored.count("scores") == 1
    assert set(counted) == {names}
    vecs, size = purchases.word_vectors(spark, sf)
    assert vecs.count() == purchases.catalogue(spark, sf).count() and vecs.select("vec").distinct().count() <= names


def lines(spark, rows):
    return spark.createDataFrame(rows, "user_id bigint, item_id string, quantity bigint, price double, invoice string, "
                                       "line_no int, invoice_date date, country string, description string")


def test_cleaning_rules(spark):
    day = dt.date(2020, 1, 1)
    good = (1, "a", 1, 1.0, "5", 1, day, "X", "d")
    bad = [(None, *good[1:]), (1, "a", 0, *good[3:]), (1, "a", 1, 0.0, *good[4:]), (*good[:4], "C5", *good[5:]),
           (*good[:7], "Y", "d"), (*good[:8], None)]
    assert [tuple(r) for r in interactions.clean_transactions(lines(spark, [good, *bad]), "X").collect()] == [good]


def test_frequency_filter_on_a_cascade_equals_brute_force(spark):
    draw = random.Random(9)
    rows = [(u, f"i{min(int(draw.expovariate(0.15)), 40)}") for u in range(60) for _ in range(draw.randrange(1, 14))]
    rows += [(0, f"i{draw.randrange(45)}") for _ in range(300)]  # one user with a third of all lines
    kept = rows
    for _ in range(5):
        n = len(kept)
        users = {u: sum(1 for a, _ in kept if a == u) for u in {a for a, _ in kept}}
        kept = [r for r in kept if users[r[0]] >= 5]
        items = {i: sum(1 for _, b in kept if b == i) for i in {b for _, b in kept}}
        kept = [r for r in kept if items[r[1]] >= 5]
        if len(kept) == n:
            break
    day = dt.date(2020, 1, 1)
    df = lines(spark, [(u, i, 1, 1.0, "1", 1, day, "X", "d") for u, i in rows])
    got = interactions.frequency_filter(interactions.cells(df))
    assert {(r["user_id"], r["item_id"]): r["n_rows"] for r in got.collect()} == {p: kept.count(p) for p in set(kept)}


def test_split_removes_the_whole_cell_and_audit_is_clean(spark):
    d = [dt.date(2020, 1, i) for i in range(1, 10)]
    rows = [(1, "a", 1, 1.0, "1", 1, d[0], "X", "d"), (1, "b", 1, 1.0, "2", 1, d[1], "X", "d"),
            (1, "a", 5, 1.0, "3", 1, d[2], "X", "d"),  # bought again last: the earlier purchase leaves too
            (2, "a", 1, 1.0, "4", 1, d[0], "X", "d"), (2, "a", 1, 1.0, "5", 1, d[1], "X", "d")]  # one item only
    full = interactions.interaction_weights(interactions.cells(lines(spark, rows)))
    train, test = interactions.loo_split(full)
    assert [tuple(r) for r in test.collect()] == [(1, "a")]
    assert sorted((r["user_id"], r["item_id"]) for r in train.collect()) == [(1, "b"), (2, "a")]
    assert full.filter("user_id = 1 AND item_id = 'a'").first()["weight"] == pytest.approx(math.log(7))
    recs = recommend.rec_popularity(train, test, 3)
    audit = interactions.leakage_audit(full, train, test, recs).collect()
    assert len(audit) == 5 and all(r["n_violations"] == 0 for r in audit)
    whole = full.groupBy("item_id").agg(F.sum("weight").alias("popularity"))
    beyond = interactions.leakage_audit(full, train, test, recs, whole).filter("check = 'popularity_beyond_train'").first()
    own = train.groupBy("item_id").agg(F.sum("weight").alias("popularity"))
    assert beyond["n_violations"] > 0
    assert interactions.leakage_audit(full, train, test, recs, own).filter("check = 'popularity_beyond_train'").first()["n_violations"] == 0
    leaked = interactions.leakage_audit(full, full, test, recs).filter("check = 'held_out_in_train'").first()
    assert leaked["n_violations"] == 1


def test_item_meta_breaks_ties_by_the_smaller_text(spark):
    day = dt.date(2020, 1, 1)
    rows = [(u, "a", 1, p, "1", 1, day, "X", t) for u, p, t in [(1, 1.0, "z"), (2, 2.0, "b"), (3, 3.0, "z"), (4, 6.0, "b")]]
    df = lines(spark, rows)
    out = interactions.item_meta(df, interactions.cells(df)).first()
    assert (out["description"], out["price"]) == ("b", 3.0)


def test_bm25_mean_length_counts_users_without_training_items(spark):
    train = spark.createDataFrame([(1, "a", 2.0), (1, "b", 1.0), (2, "a", 1.0)], "user_id bigint, item_id string, weight double")
    users = spark.createDataFrame([(1,), (2,), (3,)], "user_id bigint")
    got = {(r["user_id"], r["item_id"]): r["bm25"] for r in interactions.bm25_weights(train, users).collect()}
    assert got[1, "a"] == pytest.approx(2 * 101 / (2 + 100 * (0.2 + 0.8 * 2 / 1.0)))
    assert got[2, "a"] == pytest.approx(101 / (1 + 100 * (0.2 + 0.8 * 1 / 1.0)))


def test_salted_join_keeps_every_row_of_a_hot_key(spark):
    left = spark.range(3000).select(F.when(F.col("id") < 1000, 0).otherwise(F.col("id")).alias("k"), "id")
    right = spark.range(0, 2500, 5).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    assert [r["k"] for r in hot_keys(left, "k").collect()] == [0]
    for how in ("inner", "left", "left_semi", "left_anti"):
        plain = left.join(right, "k", how)
        salted = salted_join(left, right, "k", how).select(*plain.columns)
        assert sorted(map(str, plain.collect())) == sorted(map(str, salted.collect()))


def test_global_rank_counts_through_all_partitions(spark):
    df = spark.range(1000).select(F.pmod(F.col("id") * 37, F.lit(50)).alias("a"), "id").repartition(7)
    out = global_rank(df, [F.desc("a"), F.asc("id")]).orderBy("rank").collect()
    assert [r["rank"] for r in out] == list(range(1, 1001))
    assert [(r["a"], r["id"]) for r in out] == sorted(((r["a"], r["id"]) for r in out), key=lambda x: (-x[0], x[1]))


def test_metric_names(spark):
    df = spark.createDataFrame([("SVD (k=50)",), ("Content-based",), ("A/B Test",)], "m string")
    assert [r[0] for r in df.select(ranking.metric_name(F.col("m"))).collect()] == ["svd_k50", "content-based", "a_b_test"]


def test_broadcast_blocks_need_no_package_on_the_executors():
    items = pd.DataFrame({"item_id": ["a", "b", "c"], "vec": [[1.0, 0.0], [1.0, 0.0], [0.0, 2.0]]})
    block = vectors._block(items, 2.0)
    assert b"quartermill" not in pickle.dumps(block)
    assert block.ids.tolist() == ["c", "b", "a"] and block.matrix.shape == (2, 2)


def test_round_trips_equal_dense_products_and_send_a_vector_once_to_a_block(spark):
    rng = np.random.default_rng(6)
    dense = np.where(rng.random((50, 24)) < 0.3, rng.normal(size=(50, 24)), 0.0)
    cells = spark.createDataFrame([(int(u), f"i{i:02d}", float(dense[u, i])) for u, i in zip(*np.nonzero(dense))], "user_id bigint, item_id string, weight double")
    vecs = rng.normal(size=(50, 3))
    users = spark.createDataFrame([(u, v.tolist()) for u, v in enumerate(vecs)], "id bigint, vec array<double>")
    dealt = grid.deal(cells, "item_id", "user_id", cells.count(), block_cells=100, piece_cells=50, least_cells=100)
    got = {r["id"]: r["vec"] for r in grid.round_trip(dealt, users, 3).collect()}
    assert len(got) == 50 and all(np.allclose(got[u], dense[u] @ (dense.T @ vecs), atol=1e-5) for u in range(50))
    items = materialise(dealt.rows.select("block", "id")).withColumn("vec", F.array(F.substring("id", 2, 2).cast("double"), F.lit(1.0)))
    back = {r["id"]: r["vec"] for r in grid.product_back(dealt, items, 2).collect()}
    assert all(np.allclose(back[u], dense[u] @ np.stack([np.arange(24), np.ones(24)], 1)) for u in range(50))
    # users are bought from 7 items each on average, but no vector goes to more than the few blocks there are
    assert dealt.blocks <= -(-cells.count() // 100) and dealt.links.count() <= 50 * dealt.blocks < cells.count()


def test_svd_with_an_item_too_long_for_a_block_gives_the_same_factors(spark):
    rng = np.random.default_rng(8)
    x = rng.random((40, 3)) @ rng.random((3, 12))
    train = spark.createDataFrame([(u, f"i{i:02d}", float(x[u, i])) for u in range(40) for i in range(12)], "user_id bigint, item_id string, weight double")
    for cells in (grid.TRIP_CELLS, 40):
        users, factors, sigma = spectral.truncated_svd_factors(train, train.select("item_id").distinct(), 3, iterations=3, trip_cells=cells)
        u, v = (np.stack([r["vec"] for r in df.orderBy(key).collect()]) for df, key in ((users, "user_id"), (factors, "item_id")))
        assert np.allclose(u @ v.T, x, atol=1e-6) and np.allclose(sigma, np.linalg.svd(x, compute_uv=False)[:3], rtol=1e-6)
