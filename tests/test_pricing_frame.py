"""The panel behind the pricing frame."""

from merchlens.operators import features
from merchlens.plans.tables import Retail


def test_days_are_laid_out_for_products_with_events_only(spark, folder):
    r = Retail(spark, folder)
    with_events = r.clean_table.select("product_id").distinct()
    days = r.demand.join(with_events, "product_id", "left_semi")
    assert r.catalog.join(with_events, "product_id", "left_anti").count() > 0
    assert r.event_demand.exceptAll(days).count() == days.exceptAll(r.event_demand).count() == 0 < days.count()
    # The whole panel gives the same frame.
    whole = features.pricing_frame(r.clean_table, r.demand, r.pricing).select("event_id", "daily_sales", "demand_score")
    few = r.frame.select(*whole.columns)
    assert whole.exceptAll(few).count() == few.exceptAll(whole).count() == 0
