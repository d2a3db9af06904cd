"""Plans: bucketed tables join without an exchange, days and categories share one."""

from merchlens.operators import features, kpis
from merchlens.operators.store import FeatureStore, FeatureTable
from merchlens.plans.tables import Retail
from pyspark.sql import functions as F


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bucketed_tables_join_and_group_without_an_exchange(spark, folder, tmp_path):
    r = Retail(spark, folder)
    store = FeatureStore(spark, str(tmp_path))
    a = store.materialize_bucketed(FeatureTable("products", r.products, "product_id"), 8)
    b = store.materialize_bucketed(FeatureTable("pricing", r.pricing, "product_id"), 8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = features.with_pricing(a, b)
        assert "SortMergeJoin" in plan(joined) and "Exchange" not in plan(joined)
        assert "Exchange" not in plan(joined.groupBy("product_id").agg(F.sum("views")))
        plain = features.with_pricing(r.products, r.pricing)
        assert "Exchange" in plan(plain)
        keep = ["product_id", "category", "views", "current_price", "margin_pricing"]
        assert sorted(joined.select(keep).collect()) == sorted(plain.select(keep).collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 << 20))


def test_days_and_categories_in_one_pass(spark, folder):
    r = Retail(spark, folder)
    events = r.clean_table
    both = kpis.day_and_category(events, r.catalog)
    text = plan(both)
    assert text.count("Exchange hashpartitioning") == 1 and text.count("clean-") <= 1
    got = {(x.level, x.date, x.product_category): x for x in both.collect()}
    days, kinds = kpis.revenue_trend(events, r.catalog, 10 ** 6).collect(), kpis.category_performance(events).collect()
    assert len(got) == len(days) + len(kinds) + 1
    for d in days:
        x = got["day", d.date, None]
        assert abs(x.margin - d.margin) < 1e-6 and (x.purchases, round(x.ctr, 9)) == (d.purchases, round(d.ctr, 9))
    for k in kinds:
        x = got["category", None, k.product_category]
        assert abs(x.revenue - k.revenue) < 1e-6 and (x.views, x.purchases) == (k.views, k.purchases)
    assert got["total", None, None].views == sum(k.views for k in kinds)
    assert kpis.day_and_category(events.limit(0), r.catalog).where("level <> 'total'").count() == 0
