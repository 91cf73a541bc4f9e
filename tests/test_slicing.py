from datetime import date

from pyspark.sql import functions as F

from ladle.operators import kpis
from ladle.operators.slicing import Filters, Slice


def make(mart, **given):
    return Slice(Filters.from_dict(given), mart.fact, mart.menu, mart.locations, mart.promotions, mart.segments,
                 mart.wastage, mart.categories, mart.channels)


def test_parameters_are_read_leniently():
    f = Filters.from_dict({"item": "all", "rating_min": "x", "price_max": "12.5", "date_from": "2020-01-02", "channel": ""})
    assert f == Filters(price_max=12.5, date_from=date(2020, 1, 2)) and f.active == 2 and f.has_item_filter


def test_no_filter_is_the_whole(mart):
    s = make(mart)
    assert s.filters.active == 0
    assert s.kpis().collect() == kpis.kpi_row(mart.orders, mart.wastage).collect()


def test_unknown_names_give_an_empty_slice(mart):
    for given in ({"promotion": "no such"}, {"location": "nowhere"}):
        s = make(mart, **given)
        assert s.meta().first().asDict() == {"orders": 0, "lines": 0, "customers": 0, "items": 0, "empty": True}
        k = s.kpis().first()
        assert k.revenue == 0 and k.aov == 0 and k.repeat_rate == 0 and k.wastage_rate == 0
        assert s.deltas().first().revenue_delta == 0
        assert s.location_table().count() == 0 and len(s.segment_mix().collect()) == 6


def test_slices_by_outlet_add_up(mart):
    names = [r.name for r in mart.locations.select("name").collect()]
    total = sum(make(mart, location=n).meta().first()["lines"] for n in names[:25])
    assert total == mart.fact.count()


def test_category_revenue_adds_up(mart):
    with make(mart, date_from="1996-01-01", channel="2-HIGH") as s:
        assert s.category_revenue().agg(F.sum("revenue")).first()[0] == s.kpis().first().revenue


def test_location_filter_prunes_partitions(mart):
    plan = make(mart, location="NATION_7").fact._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan or "DynamicPruning" in plan
