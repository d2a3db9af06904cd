"""Splits and reproducible samples. Random numbers are md5 of the row's key, never of its position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import constants as K
from ..functions import scalars as S
from ..session import stage
from .ordering import number_rows, quantiles, running_total

PLACES = 1024  # places of the catalog's order in one block of preferred_items

def _micros(ts: str = "timestamp"):
    return F.unix_micros(F.col(ts).cast("timestamp"))


def split_point(events: DataFrame, q: float = K.TRAIN_QUANTILE) -> DataFrame:
    """The interpolated time quantile in microseconds, as one row."""
    return quantiles(events.select(_micros().alias("us")), "us", [q]).select(F.col("value").alias("cutoff_us"))


def temporal_split(events: DataFrame, q: float = K.TRAIN_QUANTILE) -> tuple[DataFrame, DataFrame]:
    cutoff = split_point(events, q).scalar()
    return events.where(_micros() <= cutoff), events.where(_micros() > cutoff)


def weighted_sample(rows: DataFrame, n: int, weight, key: list[str], seed: str = "42") -> DataFrame:
    """n rows without replacement, chance proportional to weight: the n largest u^(1/w)."""
    u = S.unit_hash(*key, seed=seed)
    keyed = rows.withColumn("_k", F.pow(u, 1 / weight))
    return _first(keyed, n, "_k", [F.desc("_k"), *key], largest=True).drop("_k")


def uniform_sample(rows: DataFrame, n: int, key: list[str], seed: str = "42", total: int | None = None, text: Column | None = None) -> DataFrame:
    """The n rows with the smallest hash of their key.

    The hash is uniform, so the value below which a little more than n rows lie is known from their number; the rows pass once more,
    and tasks send few of them to the sort. total: the number of rows, if known. text: S.hashed_text of the key, if it can be had cheaper.
    """
    total = rows.count() if total is None else total
    keyed = rows.withColumn("_k", S.hash32(*key, seed=seed))
    if total > 2 * n:
        cut = int((n + 8 * n**0.5 + 50) / total * (1 << 32))
        near = rows.where(S.hash_at_most(S.hashed_text(*key, seed=seed) if text is None else text, cut))
        few = stage(near.withColumn("_k", S.hash32(*key, seed=seed)).orderBy("_k", *key).limit(n), "sample")
        if few.count() == n:  # else keys repeat so often that their hashes are not uniform
            return few.drop("_k")
    return keyed.orderBy("_k", *key).limit(n).drop("_k")


def _first(rows: DataFrame, n: int, score: str, order: list, largest: bool) -> DataFrame:
    """The first n rows of an order by `score`. A quantile of the score, with room for its error, leaves each task few rows to send."""
    total = rows.count()
    if total > n:
        share = min(1.0, 1.2 * n / total + 0.002)
        cut = rows.agg(F.percentile_approx(score, 1 - share if largest else share, 2000)).first()[0]
        near = F.col(score) >= cut if largest else F.col(score) <= cut
        few = rows.where(near)
        if few.count() >= n:  # else the estimate was too tight
            rows = few
    return rows.orderBy(*order).limit(n)


def known_pairs(events: DataFrame, users: DataFrame, catalog: DataFrame) -> DataFrame:
    """Interactions whose user and product are both known."""
    return events.join(users.select("user_id"), "user_id", "left_semi").join(
        catalog.select("product_id"), "product_id", "left_semi"
    )


def negatives(positives: DataFrame, seen: DataFrame, catalog: DataFrame, n: int = 2, seed: str = "42") -> DataFrame:
    """`n` unseen products per positive, spread over the user's unseen products from a hashed start.

    No pair of user and unseen product is built. Products are numbered; the r-th unseen number of a
    user is r plus the count of seen numbers whose gap (number minus rank among the seen) is at most
    r, a running total over seen rows and draws, cut into blocks so one heavy user spreads out. A
    user who has seen everything draws from all products.

    `positives` needs user_id, product_id and a unique event_id; `seen` holds distinct pairs.
    """
    items = number_rows(catalog.select("product_id"), ["product_id"], "idx")
    total = items.agg(F.count(F.lit(1))).scalar()
    known = seen.join(items, "product_id").withColumn("_block", F.floor(F.col("idx") / 4096))
    ranked = running_total(known, ["user_id"], "_block", ["idx"], F.lit(1), "rank")
    gaps = ranked.select(
        "user_id", (F.col("idx") - (F.col("rank") - 1)).alias("pos"), F.lit(0).alias("is_draw"), "idx",
    )
    counts = known.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_seen"))
    free = total - F.coalesce("n_seen", F.lit(0))
    pool = F.when(free > 0, free).otherwise(total)
    start = S.hash32("user_id", "event_id", seed=seed) % F.col("_pool")
    stride = F.greatest(F.floor(F.col("_pool") / n), F.lit(1))
    draws = (
        positives.select("user_id", "event_id")
        .join(counts, "user_id", "left")
        .withColumn("_pool", pool)
        .select(
            "user_id", "event_id", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("draw"), "_pool",
            start.alias("_start"), stride.alias("_stride"),
        )
        .select(
            "user_id", ((F.col("_start") + F.col("draw") * F.col("_stride")) % F.col("_pool")).alias("pos"), "event_id", "draw",
        )
    )
    # A position's shift depends on (user, position) only, and a user has at most as many positions
    # as there are products: a user with very many positives still makes few rows here.
    asked = draws.select("user_id", "pos", F.lit(1).alias("is_draw"), F.lit(None).cast("bigint").alias("idx")).distinct()
    both = gaps.unionByName(asked).withColumn("_block", F.floor(F.col("pos") / 4096))
    placed = running_total(both, ["user_id"], "_block", ["pos", "is_draw", "idx"], (F.col("is_draw") == 0).cast("int"), "below")
    shifts = placed.where("is_draw = 1").select("user_id", "pos", ((F.col("pos") + F.col("below")) % total).alias("idx"))
    drawn = shifts.join(items, "idx").select("user_id", "pos", "product_id")
    return draws.join(drawn, ["user_id", "pos"]).select("user_id", "event_id", "draw", "product_id")


def preferred_items(affinity: DataFrame, catalog: DataFrame, seed: str = "42") -> DataFrame:
    """A user's preferred set: a tenth (3 at least) of the products of their two best categories.

    Products are picked from a hashed start in the category's own order, so a set is one or two runs of places. What is shuffled is a row
    for each block of places that a run touches; the products are read off the block's array after the join, where the result is made.
    """
    best = Window.partitionBy("user_id").orderBy(F.desc("score"), "product_category")
    top = affinity.withColumn("_rn", F.row_number().over(best)).where("_rn <= 2")
    placed = number_rows(catalog.select("category", "product_id"), ["category", "product_id"], "_at")
    sizes = placed.groupBy("category").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    want = F.least(F.greatest(F.lit(3), F.floor(F.col("_n") / 10)), F.col("_n"))
    start = S.hash32("user_id", "product_category", seed=seed) % F.col("_n")
    last = F.col("_first") + F.col("_n")

    def run(low, high):
        return F.struct(low.cast("bigint").alias("low"), high.cast("bigint").alias("high"))

    # The run from the start, and what is left of it from the category's first place on.
    begin, end = F.col("_first") + start, F.col("_first") + start + want
    runs = top.join(sizes, top.product_category == sizes.category).select(
        "user_id", "product_category", F.inline(F.array(run(begin, F.least(end, last)), run(F.col("_first"), end - F.col("_n")))))
    first, final = F.floor(F.col("low") / PLACES), F.floor((F.col("high") - 1) / PLACES)
    asked = runs.where("low < high").withColumn("_block", F.explode(F.sequence(first, final)))
    # Few blocks are copied, and users dealt to the copies, so that tasks have as many keys as there are partitions whatever the catalog's size.
    parts = int(catalog.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    copies = max(1, 4 * parts * PLACES // max(1, placed.count()))
    listed = placed.groupBy(F.floor(F.col("_at") / PLACES).alias("_block")).agg(F.array_sort(F.collect_list(F.struct("_at", "product_id"))).alias("_places"))
    blocks = listed.select("_block", F.col("_places.product_id").alias("_ids")).withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    dealt = asked.withColumn("_copy", F.pmod(F.xxhash64("user_id"), F.lit(copies)).cast("int"))
    keys = ["_block", "_copy"]
    met = dealt.repartition(parts, *keys).join(blocks.repartition(parts, *keys).hint("merge"), keys)
    offset = F.greatest(F.col("low") - F.col("_block") * PLACES, F.lit(0))
    upto = F.least(F.col("high") - F.col("_block") * PLACES, F.lit(PLACES))
    ids = F.slice("_ids", (offset + 1).cast("int"), (upto - offset).cast("int"))
    return met.select("user_id", "product_category", F.explode(ids).alias("product_id"))
