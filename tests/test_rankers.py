"""The lambda ranker against brute force and against the pointwise one."""

import math
import random

import numpy as np
from merchlens.operators import evaluation, lambda_rank, lambda_trees

SCHEMA = "user_id bigint, event_id string, a double, b double, purchase_label int"


def planted(users, rows, seed):
    """Buys depend on how `a` compares within the user's rows; its level differs from user to user and misleads across users."""
    rng = random.Random(seed)
    out = []
    for u in range(users):
        level = rng.uniform(-4, 4)
        for k in range(rows):
            a = rng.random()
            out.append((u, f"{u}-{k:03}", level + 4 * a, rng.choice([0.0, 1.0, None]), int(a + rng.gauss(0, 0.15) > 0.7)))
    return out


def pair_gradients(score, y):
    """One pair at a time."""
    order = sorted(range(len(y)), key=lambda i: (-score[i], i))
    place = {i: p for p, i in enumerate(order)}
    ones = sum(y)
    ideal = sum(1 / math.log2(p + 2) for p in range(ones))
    g, h = [0.0] * len(y), [0.0] * len(y)
    for i in range(len(y)):
        for j in range(len(y)):
            if y[i] == 1 and y[j] == 0:
                change = abs(1 / math.log2(place[i] + 2) - 1 / math.log2(place[j] + 2)) / ideal
                wrong = 1 / (1 + math.exp(score[i] - score[j]))
                g[i] -= wrong * change
                g[j] += wrong * change
                h[i] += wrong * (1 - wrong) * change
                h[j] += wrong * (1 - wrong) * change
    return g, h


def test_gradients_of_a_list():
    rng = random.Random(2)
    for _ in range(50):
        n = rng.randrange(1, 12)
        score, y = [rng.choice([0.0, 0.5, rng.random()]) for _ in range(n)], [rng.randrange(2) for _ in range(n)]
        got, want = lambda_trees.gradients(np.array(score), np.array(y)), pair_gradients(score, y)
        assert np.allclose(got[0], want[0]) and np.allclose(got[1], want[1])


def brute_fit(rows, edges, rounds, depth, rate):
    """Trees by trying every split of every node over plain lists."""
    x = [[sum(e < (v or 0.0) for e in edge) for v, edge in zip(r[2:4], edges)] for r in rows]
    lists = {}
    for i, r in enumerate(rows):
        lists.setdefault(r[0], []).append(i)
    score = [0.0] * len(rows)
    for _ in range(rounds):
        g, h = [0.0] * len(rows), [0.0] * len(rows)
        for mine in lists.values():
            for i, a, b in zip(mine, *pair_gradients([score[i] for i in mine], [rows[i][4] for i in mine])):
                g[i], h[i] = a, b

        def worth(some):
            return sum(g[i] for i in some) ** 2 / (sum(h[i] for i in some) + lambda_rank.L2)

        def grow(some, level):
            best = (0, None)
            if level < depth:
                for f in range(2):
                    for cut in range(lambda_trees.BINS):
                        left, right = [i for i in some if x[i][f] <= cut], [i for i in some if x[i][f] > cut]
                        if min(len(left), len(right)) >= lambda_rank.LEAST_ROWS:
                            gain = round(worth(left) + worth(right) - worth(some), 9)
                            if gain > best[0]:
                                best = (gain, (left, right))
            if best[1]:
                grow(best[1][0], level + 1)
                grow(best[1][1], level + 1)
            else:
                for i in some:
                    score[i] += -sum(g[k] for k in some) / (sum(h[k] for k in some) + lambda_rank.L2) * rate
        grow(list(range(len(rows))), 0)
    return score


def test_two_trees_equal_brute_force(spark):
    rows = planted(12, 15, 3)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    model = lambda_rank.fit_lambda(df, ["a", "b"], rounds=2, depth=2, rate=0.5)
    want = brute_fit(rows, model.edges, 2, 2, 0.5)
    got = {r["event_id"]: r["s"] for r in df.select("event_id", lambda_rank.margin(model).alias("s")).collect()}
    assert len(model.trees) == 2 and len(set(want)) > 3
    assert all(abs(got[r[1]] - s) < 1e-9 for r, s in zip(rows, want))


def test_long_lists_are_cut_and_keep_all_rows(spark, monkeypatch):
    monkeypatch.setattr(lambda_rank, "LIST_ROWS", 20)
    df = spark.createDataFrame(planted(1, 400, 4) + planted(3, 5, 5)[5:], SCHEMA)
    packed = lambda_rank.lists(df, ["a", "b"], "purchase_label", "user_id", ["event_id"], lambda_rank.bin_edges(df, ["a", "b"])).collect()
    sizes = sorted(len(r["y"]) for r in packed)
    assert sum(sizes) == 410 and sizes[-1] <= 60 and len(sizes) > 15


def test_lambda_ranks_better_than_pointwise(spark):
    from merchlens.functions import constants as K
    from merchlens.operators import ranking
    from pyspark.sql import functions as F

    def frame(users, seed):
        base = spark.createDataFrame(planted(users, 25, seed), SCHEMA)
        spare = {c: F.lit(0.0) for c in K.RANKER_NUMERIC if c not in ("price", "margin")}
        return base.withColumns({"price": F.col("a"), "margin": F.coalesce("b", F.lit(0.0)), **spare, "category": F.lit("x"), "brand": F.lit("y")})

    train, held = frame(60, 6), frame(40, 7)

    def ndcg(scored):
        return evaluation.list_ndcg(scored).agg(F.avg("ndcg")).first()[0]

    pair = ndcg(ranking.score_lambda(held, ranking.fit_lambda(train, rounds=30)))
    point = ndcg(ranking.score_with_model(held, ranking.fit_ranker(train, rounds=30)))
    assert pair > point + 0.02


def test_one_label_and_empty_lists(spark):
    same = spark.createDataFrame([(1, f"e{k}", float(k), 0.0, 0) for k in range(9)], SCHEMA)
    for rows in (same, same.limit(0)):
        model = lambda_rank.fit_lambda(rows, ["a", "b"], rounds=3)
        assert model.trees == [] and {r["s"] for r in same.select(lambda_rank.margin(model).alias("s")).collect()} == {0.0}


def test_list_ndcg(spark):
    rows = [(1, "a", 0.9, 1), (1, "b", 0.8, 0), (1, "c", 0.7, 1), (2, "d", 0.1, 1), (3, "e", 0.2, 0), (3, "f", 0.2, 1)]
    got = {r["user_id"]: r["ndcg"] for r in evaluation.list_ndcg(spark.createDataFrame(rows, "user_id int, event_id string, ranking_score double, purchase_label int")).collect()}
    assert set(got) == {1, 3}
    assert abs(got[1] - 1.5 / (1 + 1 / math.log2(3))) < 1e-12 and abs(got[3] - 1 / math.log2(3)) < 1e-12
