"""Memory of a scan does not follow the number of items, and results equal a full sort."""

import tracemalloc

import numpy as np
import pandas as pd
from merchlens.operators import block_top_k, item_lists


def users_of(rng, n, seen):
    return pd.DataFrame({"user_id": np.arange(n), "vector": list(rng.standard_normal((n, 4))), "n_seen": rng.integers(0, seen + 1, n)})


def test_scores_of_few_items_at_a_time():
    rng = np.random.default_rng(1)
    ids, matrix, users = np.arange(150_000), rng.standard_normal((150_000, 4)), users_of(rng, 256, 0)
    tracemalloc.start()
    rows = sum(len(x) for x in block_top_k.best(ids, matrix, users, 10))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows >= 2560 and peak < 150e6  # all scores at once take 307 MB


def test_chunks_and_ties_equal_a_full_sort(monkeypatch):
    monkeypatch.setattr(block_top_k, "_ITEMS_AT_ONCE", 7)
    monkeypatch.setattr(block_top_k, "_KEPT_AT_ONCE", 40)
    rng = np.random.default_rng(2)
    matrix, users = rng.integers(-2, 3, (90, 4)).astype(float), users_of(rng, 30, 12)
    matrix[5] = np.nan
    got = pd.concat(block_top_k.best(np.arange(90) + 1000, matrix, users, 10))
    scores = np.round(np.nan_to_num(np.stack(users["vector"]) @ matrix.T, nan=0.0), 12)
    for u, s in enumerate(scores):
        own, limit = got[got["user_id"] == u], np.sort(s)[-(10 + users["n_seen"][u])]
        assert sorted(own["product_id"] - 1000) == sorted(np.nonzero(s >= limit)[0])
        assert set(own["lo"]) == {s.min()} and set(own["hi"]) == {s.max()}


def test_a_user_of_many_lists_is_one_row_without_its_vector():
    lists = pd.DataFrame({"list": [str(i) for i in range(50)], "centre": list(np.zeros((50, 4))), "radius": np.ones(50), "n": [3] * 50, "ib": [0] * 30 + [1] * 20})
    users = users_of(np.random.default_rng(3), 8, 0).assign(kth=-np.inf, least=np.inf)
    first = pd.concat(item_lists.wanted(lists, 100, False)(iter([users])))
    assert "vector" not in first.columns and len(first) <= 16 and first["lists"].map(len).sum() >= 8 * 34


def test_equal_scores_do_not_fill_memory():
    rng = np.random.default_rng(4)
    ids, users = np.arange(100_000), users_of(rng, 256, 3)
    users["vector"] = [np.zeros(4)] * 256
    tracemalloc.start()
    got = pd.concat(block_top_k.best(ids, rng.standard_normal((100_000, 4)), users, 10, ties=False))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(got) == (10 + users["n_seen"]).sum() and peak < 150e6  # all that are equal are 25.6 million rows
    assert (got.groupby("user_id")["product_id"].max() == 9 + users["n_seen"]).all()


def test_the_smallest_ids_of_equal_scores_and_repeated_rows(monkeypatch):
    monkeypatch.setattr(block_top_k, "_ITEMS_AT_ONCE", 7)
    monkeypatch.setattr(block_top_k, "_KEPT_AT_ONCE", 40)
    rng = np.random.default_rng(5)
    matrix, users = np.repeat(rng.integers(-2, 3, (60, 4)).astype(float), 2, axis=0), users_of(rng, 30, 12)
    ids = np.repeat(rng.permutation(60), 2)
    got = pd.concat(block_top_k.best(ids, matrix, users, 10, ties=False))
    for u, s in enumerate(np.round(np.stack(users["vector"]) @ matrix.T, 12)):
        order = np.lexsort((ids, -s))
        last = order[9 + users["n_seen"][u]]
        wanted = [i for i in order if (-s[i], ids[i]) <= (-s[last], ids[last])]
        own = got[got["user_id"] == u]
        assert sorted(own["product_id"]) == sorted(ids[wanted]) and set(own["lo"]) == {s.min()} and set(own["hi"]) == {s.max()}
