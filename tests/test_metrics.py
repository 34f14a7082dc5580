from datetime import date
from itertools import combinations

import pytest
from pyspark.sql import functions as F
from shop import CAPS, TEES, Shop

from tallyhouse.operators import silver
from tallyhouse.plans.metrics import MetricView, Ratio, RoutedView, Total, drill_across, marketing_metrics, sales_metrics


@pytest.fixture(scope="module")
def view(spark):
    shop = Shop(spark)
    return sales_metrics(silver.build_sales(shop.items, shop.orders, shop.products).cache())


DIRECT = {
    "Category": "category", "Channel": "channel", "Subcategory": "subcategory", "Product": "product_name",
    "Order Date": "order_date",
}


@pytest.mark.parametrize("by", [c for n in range(3) for c in combinations(DIRECT, n)], ids="+".join)
def test_query_equals_a_direct_aggregate(view, by):
    got = {tuple(r)[:len(by)]: tuple(r)[len(by):] for r in view.query(
        ["Total Revenue", "Profit Margin Pct", "Avg Order Line Value"], by=list(by)).collect()}
    direct = view.source.groupBy(*[DIRECT[d] for d in by]).agg(
        F.sum("line_revenue"),
        F.lit(100.0) * (F.sum("line_profit").cast("double") / F.sum("line_revenue").cast("double")),
        F.avg("line_revenue"))
    assert got == {tuple(r)[:len(by)]: tuple(r)[len(by):] for r in direct.collect()}


def test_ratio_brings_its_sums_and_hides_them(view):
    assert view.query(["Profit Margin Pct"]).columns == ["Profit Margin Pct"]


def test_average_of_the_flat_view_is_not_the_average(view):
    flat = view.to_flat_view()
    assert {"Order_Month", "Avg_Order_Line_Value", "Total_Revenue"} <= set(flat.columns)
    more = view.query(["Avg Order Line Value"]).first()[0]
    assert float(more) == 39.5
    assert flat.agg(F.sum("Total_Revenue")).first()[0] == view.query(["Total Revenue"]).first()[0]


def test_where_order_limit(view):
    assert view.query(["Units Sold"], where={"Category": TEES}).first()[0] == 3
    assert view.query(["Units Sold"], where={"Category": [TEES, CAPS]}).first()[0] == 7
    assert view.query(["Units Sold"], where={"Order Date": (date(2024, 1, 2), date(2024, 1, 9))}).first()[0] == 3
    assert view.query(["Units Sold"], where=F.col("order_status") == "RETURNED").first()[0] == 1
    top = view.query(["Total Revenue"], by=["Category"], order=[F.col("Total Revenue").desc()], limit=1, formatted=True)
    assert [tuple(r) for r in top.collect()] == [(TEES, "$84.00")]


def test_order_month_is_a_date(view):
    assert view.query(["Units Sold"], by=["Order Month"]).collect() == [(date(2024, 1, 1), 7)]


def test_drill_across_does_not_fan_out(spark, view):
    marketing = marketing_metrics(silver.build_marketing(Shop(spark).campaigns))
    joined = drill_across([view.query(["Total Revenue"], by=["Category"]),
                           marketing.query(["Marketing ROI", "Conversions"], by=["Category"])], ["Category"])
    rows = {r["Category"]: (float(r["Total Revenue"]), r["Marketing ROI"]) for r in joined.collect()}
    assert rows == {TEES: (84.0, 1.5), CAPS: (74.0, None)}


MEASURES = ["Total Revenue", "Total Cost", "Profit Margin Pct", "Units Sold", "Avg Order Line Value"]


@pytest.fixture(scope="module")
def routed(view, tmp_path_factory):
    grains = []
    for k, by in enumerate((["Category"], ["Category", "Channel", "Order Month"])):
        path = str(tmp_path_factory.mktemp("grains") / str(k))
        view.stored_grain(by).write.parquet(path)
        grains.append(view.answered_from(view.source.sparkSession.read.parquet(path)))
    return RoutedView(view, grains)


@pytest.mark.parametrize("by, where, grain", [
    (["Category"], None, 0), ([], None, 0), (["Category"], {"Category": [TEES]}, 0), (["Channel"], None, 1),
    (["Category"], {"Channel": "Web"}, 1), ([], {"Order Month": (date(2024, 1, 1), date(2024, 1, 1))}, 1),
    (["Product"], None, None), (["Category"], {"Order Date": date(2024, 1, 1)}, None),
    (["Category"], "category is not null", None)], ids=str)
def test_routed_answers_equal_those_of_the_source(view, routed, by, where, grain):
    where = F.expr(where) if isinstance(where, str) else where
    wanted = view if grain is None else routed.grains[grain]
    assert routed.route(MEASURES, by, where) is wanted
    found, direct = routed.query(MEASURES, by, where), view.query(MEASURES, by, where)
    assert found.columns == direct.columns
    assert sorted(map(str, (tuple(r) for r in found.selectExpr(
        *[f"cast(`{c}` as string)" for c in found.columns]).collect()))) == sorted(map(str, (
            tuple(r) for r in direct.selectExpr(*[f"cast(`{c}` as string)" for c in direct.columns]).collect())))


def test_only_what_can_be_aggregated_again_is_stored(view):
    odd = MetricView(view.source, {"Category": F.col("category")}, {
        "Revenue": Total(F.col("line_revenue")), "Orders": F.count_distinct("order_id"),
        "Per Order": Ratio("Revenue", "Orders")})
    stored = odd.stored_grain(["Category"])
    assert stored.columns == ["Category", "Revenue"]
    grain = odd.answered_from(stored)
    assert set(grain.measures) == {"Revenue"}
    routed = RoutedView(odd, [grain])
    assert routed.route(["Revenue"]) is grain and routed.route(["Per Order"]) is odd


def test_formats_limits_and_empty_sources_are_routed_alike(view, routed):
    order = [F.col("Total Revenue").desc()]
    found = [tuple(r) for r in routed.query(["Total Revenue"], ["Category"], order=order, limit=1, formatted=True).collect()]
    assert found == [(TEES, "$84.00")]
    empty = MetricView(view.source.limit(0), view.dimensions, view.measures)
    grain = empty.answered_from(empty.stored_grain(["Category"]))
    assert [tuple(r) for r in grain.query(MEASURES).collect()] == [tuple(r) for r in empty.query(MEASURES).collect()]
