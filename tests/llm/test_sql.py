"""Registered queries against their SQL, and every query on odd tables."""

import os
import re

import pytest
from check import compare, connect
from llm.common import clashing, frame, lower, odd_rows, roots, words
from merchlens.llm import line_dedup, registry, toxicity


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_matches_sql(spark, folder, name):
    assert compare(registry.QUERIES[name](spark, folder), connect(folder), registry.SQL[name]) == ""


@pytest.fixture(scope="module")
def odd_folder(spark, tmp_path_factory):
    """Tables with nulls, ties, repeated rows and clashing columns; and the same tables without rows."""
    root = tmp_path_factory.mktemp("odd")
    docs = clashing(frame(spark, odd_rows()))
    bench = spark.createDataFrame([(1, None), (2, ""), (3, "short one"), (None, " ".join(f"q{i}" for i in range(20)))], "item_id bigint, text string")
    labels = spark.createDataFrame([(4, 1, 0), (8, 1, 1), (None, 1, 1), (9, None, None), (4, 1, 0)], "doc_id bigint, quality int, toxic int")
    turns = clashing(spark.createDataFrame([(1, 0, "user", "Hi."), (1, None, None, None), (None, 0, "user", ""), (2, 5, "bot", "x"), (2, 5, "bot", "x")], "conv_id bigint, turn bigint, role string, text string"))
    vectors = clashing(spark.createDataFrame([(1, [0.5, 1.0]), (2, None), (None, [0.1, 0.0]), (2, [0.3, None]), (2, []), (5, [9.0, 1.0])], "vec_id bigint, embedding array<float>"))
    for name, some in (("full", True), ("none", False)):
        for table, df in (("documents", docs), ("benchmark", bench), ("labels", labels), ("conversations", turns), ("embeddings", vectors)):
            (df if some else df.limit(0)).coalesce(1).write.parquet(os.path.join(root, name, f"{table}.parquet"))
    return root


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_odd_and_empty_tables(spark, odd_folder, name):
    n = {"op5_decontaminate": 0, "op11_turn_repair": 3, "op13_whitening": 3 * 2}.get(name, len(odd_rows()))
    rows = registry.QUERIES[name](spark, os.path.join(odd_folder, "full")).collect()
    assert len(rows) == n
    assert registry.QUERIES[name](spark, os.path.join(odd_folder, "none")).count() == 0


def _brute_force(rows):
    """(doc_id, text) that pass the stages without a toxic or leaked text, straight from the definitions."""
    def last(i):
        return (i is None, i or 0)

    first = {}
    for i, t in rows:
        key = re.sub("[\x20\x09-\x0D]+", " ", t or "")
        if key not in first or last(i) < last(first[key][0]):
            first[key] = (i, t)
    left, sets = list(first.values()), {}
    for n, (i, t) in enumerate(left):
        w = words(lower(t or ""))
        sets[n] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    group = roots(sets, links)
    least = {}
    for n, g in group.items():
        if left[n][0] is not None:
            least[g] = min(least.get(g, left[n][0]), left[n][0])
    return sorted(((i, t or "") for n, (i, t) in enumerate(left) if i is None or i == least[group[n]]), key=str)


def test_pipeline_on_odd_and_empty_tables(spark, odd_folder):
    import corpus_pipeline

    folder = os.path.join(odd_folder, "full")
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    model = toxicity.train(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    passed = [(r["doc_id"], r["text"]) for r in toxicity.score(docs, model).where("predicted = 0").collect()]
    assert len(passed) > 10 and not {8} & {i for i, _ in passed}  # 8 is the toxic one
    left = corpus_pipeline.run(spark, folder)
    assert sorted(((r["doc_id"], r["text"]) for r in left.collect()), key=str) == _brute_force(passed)
    assert corpus_pipeline.run(spark, os.path.join(odd_folder, "none")).count() == 0


def test_stages_return_clashing_columns_unchanged(spark, odd_folder):
    import corpus_pipeline

    folder = os.path.join(odd_folder, "full")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    extra = [c for c in docs.columns if c not in ("doc_id", "text", "lang", "source", "n_chars")]
    steps = [(n, f) for n, f in corpus_pipeline.STAGES[:-1]] + [("lines", lambda s, d, _: line_dedup.dedup(d, 2, 8))]
    for name, step in steps:
        out = step(spark, docs, folder)
        assert out.columns == docs.columns, name
        rows = out.collect()
        assert rows and all(r[c] == f"{c}!" for r in rows for c in extra), name


def test_line_dedup_keeps_other_lines(spark):
    rows = [(1, "a\nb\nc"), (2, "x\na\nb\ny"), (3, None), (4, ""), (5, "one two three four five six seven eight\nz"), (6, "q\none two three four five six seven eight")]
    out = {r["doc_id"]: r["text"] for r in line_dedup.dedup(clashing(frame(spark, rows)), 2, 8).collect()}
    assert out == {1: "a\nb\nc", 2: "x\ny", 3: None, 4: "", 5: rows[4][1], 6: "q"}
