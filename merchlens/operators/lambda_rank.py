"""Lambda-gradient ranker: boosted trees over lists of rows, with the NDCG-weighted gradients of the pairs in a list.

The rows of a user are one list; a user with many rows has several lists of about LIST_ROWS rows each, dealt by a hash of the row, so no list is
unbounded and all rows take part. Lists are written once, features as bin numbers. One level of a tree is one aggregate over
(node, feature, bin): tasks compute gradients list by list, route rows through the tree so far and add up histograms; the sums, as many
as there are cells, choose the splits on the driver. Pairs exist only inside a list's task, as a matrix.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage
from . import lambda_trees
from .lambda_trees import BINS

cloudpickle.register_pickle_by_value(lambda_trees)

LIST_ROWS = 256
L2, LEAST_ROWS = 1.0, 5


@dataclass
class LambdaModel:
    features: list[str]
    edges: list[np.ndarray]  # of each feature: values that end a bin
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]]  # feature and cut of the nodes, level by level; values of the leaves


def _vector(features: list[str]) -> Column:
    return F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features])


def bin_edges(rows: DataFrame, features: list[str]) -> list[np.ndarray]:
    """Quantiles of each feature, in one aggregate."""
    shares = [k / BINS for k in range(1, BINS)]
    value = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features}
    found = rows.agg(*[F.percentile_approx(e, shares, 10_000).alias(c) for c, e in value.items()]).first()
    return [np.unique(found[c] or []) for c in features]


def lists(rows: DataFrame, features: list[str], label: str, group: str, order: list[str], edges: list[np.ndarray]) -> DataFrame:
    """(x, y): a row for each list, packed and written."""
    sizes = rows.groupBy(group).agg(F.ceil(F.count(F.lit(1)) / LIST_ROWS).cast("bigint").alias("_parts"))
    part = F.pmod(F.xxhash64(*order), F.col("_parts")).alias("_part")
    row = F.struct(*[F.col(c).alias(f"o{k}") for k, c in enumerate(order)], _vector(features).alias("x"), F.col(label).cast("int").alias("y"))
    dealt = rows.where(F.col(group).isNotNull() & F.col(label).isNotNull()).join(sizes, group).select(group, part, row.alias("row"))
    gathered = dealt.groupBy(group, "_part").agg(F.sort_array(F.collect_list("row")).alias("rows"))
    plain = gathered.select(F.transform("rows", lambda r: r["x"]).alias("x"), F.transform("rows", lambda r: r["y"]).alias("y"))
    return stage(plain.mapInArrow(lambda_trees.pack(edges), "x binary, y binary"), "lambda-lists")


def _splits(cells: list, level: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best feature and cut of each node of a level, and the (g, h) of its two sides."""
    nodes = 1 << level
    total = np.zeros((3, nodes * width * BINS))
    for c in cells:
        total[:, c["cell"]] = c["g"], c["h"], c["n"]
    total = total.reshape(3, nodes, width, BINS)
    left = total.cumsum(axis=3)
    whole = left[:, :, :, -1:]
    right = whole - left

    def gain(s: np.ndarray) -> np.ndarray:
        return s[0] ** 2 / (s[1] + L2)

    better = gain(left) + gain(right) - gain(whole)
    better[(left[2] < LEAST_ROWS) | (right[2] < LEAST_ROWS)] = 0
    flat = np.round(better, 9).reshape(nodes, -1)  # of equal gains the first feature and cut
    best = flat.argmax(axis=1)
    feature, cut = best // BINS, best % BINS
    node = np.arange(nodes)
    sides = np.stack([left[:2, node, feature, cut], right[:2, node, feature, cut]], axis=-1)
    none = flat[node, best] <= 0
    feature = np.where(none, -1, feature)
    sides[:, none, 0], sides[:, none, 1] = whole[:2, node, 0, 0][:, none], 0
    return feature, cut, sides


def fit_lambda(
    rows: DataFrame, features: list[str], label: str = "purchase_label", group: str = "user_id", order: tuple[str, ...] = ("event_id",),
    rounds: int = 20, depth: int = 3, rate: float = 0.2,
) -> LambdaModel:
    """label is 1 or 0; `order` is the key of a row, it settles ties and deals out long lists."""
    rows = stage(rows.select(group, label, *order, *features), "lambda-rows")
    edges, width = bin_edges(rows, features), len(features)
    packed = lists(rows, features, label, group, list(order), edges)
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for _ in range(rounds):
        feature, cut, sides = np.full((1 << depth) - 1, -1), np.zeros((1 << depth) - 1, np.int64), None
        for level in range(depth):
            run = lambda_trees.histogram(trees, feature, cut, level, width)
            cells = packed.mapInArrow(run, "cell bigint, g double, h double, n bigint").groupBy("cell").agg(*[F.sum(c).alias(c) for c in ("g", "h", "n")])
            here = slice((1 << level) - 1, (1 << level + 1) - 1)
            feature[here], cut[here], sides = _splits(cells.collect(), level, width)
        value = (-sides[0] / (sides[1] + L2) * rate).reshape(-1)
        if not value.any():
            break
        trees.append((feature, cut, value))
    return LambdaModel(list(features), edges, trees)


def margin(model: LambdaModel) -> Column:
    """The model's score of a row; its value orders the rows of a list."""
    edges, trees = model.edges, model.trees

    @F.pandas_udf("double")
    def of(x: pd.Series) -> pd.Series:
        if not len(x):
            return pd.Series([], dtype=float)
        return pd.Series(lambda_trees.predict(lambda_trees.binned(np.stack(x.to_numpy()), edges), trees))

    return of(_vector(model.features))
