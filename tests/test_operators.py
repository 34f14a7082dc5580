from datetime import date, timedelta
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F
from shop import CAPS, MUGS, TEES, Shop

from tallyhouse.operators import decision, filters, forecast, gold, kpis, quality, silver, timeseries
from tallyhouse.operators.joins import heavy_keys, spread_join
from tallyhouse.operators.ranking import ordered, rank_by, rank_in_ranges, top_n
from tallyhouse.sources.star import Star


@pytest.fixture(scope="module")
def shop(spark):
    return Shop(spark)


@pytest.fixture(scope="module")
def sales(shop):
    return silver.build_sales(shop.items, shop.orders, shop.products).cache()


@pytest.fixture(scope="module")
def marketing(shop):
    return silver.build_marketing(shop.campaigns).cache()


def by(df, key="category"):
    return {row[key]: row.asDict() for row in df.collect()}


# --- Silver -----------------------------------------------------------------------------------

def test_sales_drop_cancelled_unknown_and_unmatched_lines(sales):
    assert sorted(r.order_id for r in sales.collect()) == [10, 10, 11, 12]


def test_line_amounts_do_not_subtract_the_discount_again(sales):
    line = sales.filter("order_id = 10 AND product_id = 1").first()
    assert (line.line_revenue, line.line_profit) == (D("54.00"), D("34.00"))


def test_order_lines_keep_every_status(shop):
    lines = silver.order_lines(shop.items, shop.orders, shop.products)
    assert sorted(r.order_id for r in lines.collect()) == [10, 10, 11, 12, 13, 14]


def test_marketing_needs_spend(marketing):
    assert {r.campaign_id: r.campaign_roi for r in marketing.collect()} == {301: 2.5, 302: 1.167, 305: 4.0}


# --- Gold -------------------------------------------------------------------------------------

def test_category_performance_is_a_ratio_of_sums_and_keeps_categories_without_campaigns(sales, marketing):
    rows = by(gold.build_category_performance(sales, marketing))
    assert set(rows) == {TEES, CAPS}
    tees, caps = rows[TEES], rows[CAPS]
    assert (tees["total_revenue"], tees["total_profit"], tees["units_sold"], tees["order_lines"]) == (84, 54, 3, 2)
    assert tees["profit_margin_pct"] == 64.3
    assert (tees["marketing_spend"], tees["marketing_roi"]) == (400, 1.5)
    assert caps["marketing_spend"] is None and caps["marketing_roi"] is None


def test_orders_per_category_do_not_add_up(sales):
    rows = {(r.order_date, r.category): r.orders for r in gold.build_daily_revenue(sales).collect()}
    assert rows == {(date(2024, 1, 1), TEES): 2, (date(2024, 1, 1), CAPS): 1, (date(2024, 1, 3), CAPS): 1}
    assert kpis.shop_overview(sales).first().orders == 3


def test_tasks_that_count_orders_hold_a_bounded_number_of_lines(spark, monkeypatch):
    monkeypatch.setattr("tallyhouse.sources.star.LINES_PER_TASK", 300)
    star = Star(spark, "/root/testdata/sf0.001")
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").count()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = star.sales_by_order
        per_task = joined.groupBy(F.spark_partition_id()).count().collect()
        assert len(per_task) > lines / 300 / 2 and max(r["count"] for r in per_task) < 600
        found, expected = (gold.build_daily_revenue(s) for s in (joined, star.sales))
        assert sorted(found.collect()) == sorted(expected.collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rough_peek_matches_sales(shop, sales):
    rows = by(gold.rough_peek(shop.items, shop.orders, shop.products))
    assert {k: (v["gross_revenue_usd"], v["units_sold"]) for k, v in rows.items()} == {TEES: (84, 3), CAPS: (74, 4)}


def test_compact_sales_gives_the_same_sums(sales):
    small = gold.compact_sales(sales, "order_date", "category")
    periods = ((date(2024, 1, 1), date(2024, 1, 1)), (date(2024, 1, 2), date(2024, 1, 31)))
    empty = sales.sparkSession.createDataFrame([], "category STRING, spend_usd DECIMAL(12,2), attributed_revenue_usd DECIMAL(12,2)")
    assert by(decision.category_summary(small, empty, *periods)) == by(decision.category_summary(sales, empty, *periods))


# --- KPIs -------------------------------------------------------------------------------------

def test_customer_kpis_equal_a_join_of_lines(spark, sales):
    customers = spark.createDataFrame([(1, "AMER", "Canada", "Developer"), (2, "EMEA", "France", "Consumer")],
                                      "customer_id INT, region STRING, country STRING, customer_segment STRING")
    direct = kpis.kpi_by(silver.sales_with_customer(sales, customers), ["region"])
    assert by(kpis.kpi_by_customer(sales, customers, ["region"]), "region") == by(direct, "region")


def test_zero_revenue_has_no_margin(spark):
    free = spark.createDataFrame([("a", D(0), D(0), 1)], "category STRING, line_revenue DECIMAL(10,2), "
                                                   "line_profit DECIMAL(10,2), quantity INT")
    assert kpis.kpi_by(free, ["category"]).first().profit_margin_pct is None


def test_status_rates_and_discounts(shop, sales):
    lines = silver.order_lines(shop.items, shop.orders, shop.products)
    rates = by(kpis.status_rates(lines))[TEES]
    assert (rates["return_rate_pct"], rates["cancel_rate_pct"]) == (33.33, 33.33)
    depth = by(kpis.discount_depth(sales))[TEES]
    assert (depth["total_discount"], depth["discount_pct"], depth["promo_line_pct"]) == (6, 6.67, 50.0)


def test_funnel_without_conversions_has_no_cost_per_conversion(marketing):
    rows = by(kpis.marketing_funnel(marketing, "channel"), "channel")
    assert rows["Display"]["cost_per_conversion"] is None
    assert rows["Email"]["ctr_pct"] == 10.0


def test_top_products_break_ties_by_id(spark):
    df = spark.createDataFrame([(i, 5) for i in (9, 3, 7)] + [(1, 6)], "product_id INT, profit INT")
    assert [r.product_id for r in top_n(df, "profit", 2, "product_id").collect()] == [1, 3]


def test_trend_and_latest_and_alert(sales):
    daily = kpis.daily_business(sales)
    assert kpis.latest(daily, "order_date", "operating_margin_pct").first()[1] == 55.6
    assert kpis.alert(daily, F.col("operating_margin_pct") < 60).count() == 1
    assert [r.growth_pct for r in kpis.monthly_trend(sales).collect()] == [None, None]


def test_ranks_agree_whatever_the_ranges(spark):
    values = [5, 5, 1, None, 9, 9, 9, 2, 0, -4] * 3
    df = spark.createDataFrame(list(enumerate(values)), "id INT, v INT")
    expected = {i: 1 + sum(1 for w in values if w is not None and (v is None or w > v)) for i, v in enumerate(values)}
    assert {r.id: r.place for r in rank_by(df, place="v").collect()} == expected
    usual = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for ranges in ("1", "3", "50"):
            spark.conf.set("spark.sql.shuffle.partitions", ranges)
            assert {r.id: r.place for r in rank_in_ranges(df, "v", "place").collect()} == expected
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", usual)
    assert rank_by(df.limit(0), place="v").count() == 0


@pytest.mark.parametrize("kind, values", [
    ("DOUBLE", [0.0, -0.0, 1e-9, 1e300, -1e300, 2.5, 2.5, 2.5000000001, float("inf"), None]),
    ("DECIMAL(20,4)", [D("0.0001"), D("-7.5"), D("9000000000000000.0001"), D("9000000000000000.0002"), None, D("0.0001")]),
    ("BIGINT", [2**53, 2**53 + 1, 2**53 + 2, -1, None, None, -1]),
    ("INT", [7]), ("INT", [None])])
def test_ranks_of_all_kinds_of_numbers(spark, kind, values):
    df = spark.createDataFrame(list(enumerate(values)), f"id INT, v {kind}")
    expected = {i: 1 + sum(1 for w in values if w is not None and (v is None or w > v)) for i, v in enumerate(values)}
    assert {r.id: r.place for r in rank_by(df, place="v").collect()} == expected


def test_a_value_of_very_many_rows_meets_in_no_rank_task(spark):
    df = spark.range(60_000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 5 ELSE id END AS v", "-id AS w")
    ranked = rank_by(df, a="v", b="w")
    assert ranked.columns == ["id", "v", "w", "a", "b"]
    low = ranked.filter("v = 5").agg(F.min("a"), F.max("a"), F.count("*")).first()
    assert low[0] == low[1] == df.filter("v > 5").count() + 1 and low[2] == df.filter("v = 5").count()
    assert ranked.filter("b <> id + 1").count() == 0
    plan = ranked._jdf.queryExecution().optimizedPlan().toString()
    assert "Join LeftOuter" not in plan and "eqNullSafe" not in plan


# --- Joins ------------------------------------------------------------------------------------

def test_heavy_keys_are_dealt_out(spark):
    n, parts = 30_000, 12
    facts = spark.range(n).selectExpr("CASE WHEN id % 3 = 0 THEN 7 ELSE id END AS k", "id AS x").unionByName(
        spark.createDataFrame([(None, -1), (7, -2), (7, -2)], "k BIGINT, x BIGINT"))
    dimension = spark.range(0, n, 2).selectExpr("id AS k", "id * 10 AS y").unionByName(
        spark.createDataFrame([(7, 70)], "k BIGINT, y BIGINT"))
    heavy = {r._heavy: r._slices for r in heavy_keys(facts, "k", parts).collect()}
    assert set(heavy) == {7} and parts / 3 <= heavy[7] <= parts / 3 + 1
    key = lambda r: (r.k, r.x, r.y)
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.shuffle.partitions": "40"}
    usual = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        dealt, plain = spread_join(facts, dimension, "k", parts), facts.join(dimension, "k")
        sizes, before = ([r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()] for df in (dealt, plain))
        assert sorted(map(key, dealt.collect())) == sorted(map(key, plain.collect()))
        assert max(before) > n / 3 and max(sizes) < max(before) / 2
    finally:
        for name, value in usual.items():
            spark.conf.set(name, value)
    assert spread_join(facts.limit(0), dimension, "k").count() == 0
    assert spread_join(facts, dimension.limit(0), "k").count() == 0


def test_sales_with_heavy_keys_are_the_same(spark):
    shop = Shop(spark)
    parts = [(shop.items, shop.orders, shop.products)]
    for frames in parts:
        even, usual = silver.build_sales_evenly(*frames, parts=3), silver.build_sales(*frames)
        assert even.columns == usual.columns
        assert sorted(map(str, even.collect())) == sorted(map(str, usual.collect()))


def test_complete_periods_gather_no_groups(spark):
    sales = silver.build_sales(*(getattr(Shop(spark), t) for t in ("items", "orders", "products")))
    for df in (timeseries.history(sales, "product_id", complete=True), timeseries.seasonality_index(sales)):
        assert "Window" not in df._jdf.queryExecution().optimizedPlan().toString()


# --- Filters ----------------------------------------------------------------------------------

def test_trailing_windows_do_not_gather_the_frame(spark):
    days = [(date(2024, m, d),) for m, d in ((1, 31), (2, 1), (2, 29), (3, 1), (3, 31))]
    df = spark.createDataFrame(days + [(None,)], "d DATE").repartition(3)
    for last, n in ((filters.last_n_days, 31), (filters.last_n_months, 2)):
        found = last(df, "d", n)
        assert "Window" not in found._jdf.queryExecution().optimizedPlan().toString()
        assert sorted(found.collect()) == sorted(last(df, "d", n, totals=True).collect()) != []
        assert last(df.limit(0), "d", n).count() == 0


def test_trailing_windows(spark):
    df = spark.createDataFrame([(date(2024, m, d),) for m, d in ((1, 31), (2, 1), (2, 29), (3, 1), (3, 31))], "d DATE")

    def days(frame):
        return sorted(r.d.isoformat()[5:] for r in frame.collect())

    assert days(filters.last_n_days(df, "d", 31)) == ["03-01", "03-31"]
    assert days(filters.last_n_months(df, "d", 2)) == ["02-01", "02-29", "03-01", "03-31"]
    assert days(filters.between_dates(df, "d", date(2024, 2, 1), date(2024, 2, 29))) == ["02-01", "02-29"]


# --- Time series and forecasts ----------------------------------------------------------------

def history(spark, **series):
    rows = [(date(2024 + (m // 12), m % 12 + 1, 1), name, D(str(v)))
            for name, values in series.items() for m, v in enumerate(values) if v is not None]
    return spark.createDataFrame(rows, "month DATE, category STRING, revenue DECIMAL(12,2)")


def predicted(df):
    return {(r.category, r.month): (r.revenue_forecast, r.revenue_lower, r.revenue_upper) for r in df.collect()}


def test_exact_line_has_no_band_and_gaps_keep_their_place(spark):
    h = history(spark, a=[10, 20, None, 40, 50], one=[None, None, None, None, 7])
    points = predicted(forecast.forecast(h, date(2024, 7, 1), "month", "revenue", "category"))
    assert points == {("a", date(2024, 6, 1)): (60, 60, 60), ("a", date(2024, 7, 1)): (70, 70, 70),
                      ("one", date(2024, 6, 1)): (7, 7, 7), ("one", date(2024, 7, 1)): (7, 7, 7)}


def test_season_is_added_only_after_two_cycles(spark):
    pattern = [0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 120]
    h = history(spark, long=pattern * 3, short=pattern)
    plain = predicted(forecast.forecast(h, date(2027, 12, 1), "month", "revenue", "category"))
    seasonal = predicted(forecast.forecast(h, date(2027, 12, 1), "month", "revenue", "category", seasonal=True))
    december = ("long", date(2027, 12, 1))
    assert seasonal[december][0] > plain[december][0] + 80
    assert {k: v for k, v in seasonal.items() if k[0] == "short"} == {k: v for k, v in plain.items() if k[0] == "short"}


def test_forecast_stops_at_the_horizon(spark):
    h = history(spark, a=[1, 2, 3])
    assert forecast.forecast(h, date(2024, 3, 1), "month", "revenue", "category").count() == 0


@pytest.mark.parametrize("frequency,step", [("day", 1), ("week", 7)])
def test_other_frequencies(spark, frequency, step):
    start = date(2024, 1, 4)
    rows = [(date.fromordinal(start.toordinal() + i * step), "a", float(i)) for i in range(5)]
    df = spark.createDataFrame(rows, "t DATE, g STRING, v DOUBLE")
    out = forecast.forecast(df, date.fromordinal(start.toordinal() + 6 * step), "t", "v", "g", frequency).collect()
    assert [(r.v_forecast, r.v_lower) for r in sorted(out, key=lambda r: r.t)] == [(5.0, 5.0), (6.0, 6.0)]


def test_anomaly_rules_in_order(shop):
    found = forecast.forecast_anomalies(shop.forecasts).collect()
    rules = {(r.category, r.anomaly) for r in found}
    assert len(found) == 9
    assert rules == {("Accessories", forecast.NEGATIVE), ("Headwear", forecast.BOUND_ABOVE_POINT),
                     ("Drinkware", forecast.BAND_TOO_WIDE)}


@pytest.mark.parametrize("row,rule", [
    ((-1, -2, 0), forecast.NEGATIVE), ((10, 11, 12), forecast.BOUND_ABOVE_POINT),
    ((10, -20, 30), forecast.BAND_TOO_WIDE), ((10, -5, 25), None), ((-1, 5, 90), forecast.NEGATIVE)])
def test_single_anomalies(spark, row, rule):
    df = spark.createDataFrame([("a", date(2025, 7, 1), *row)], "category STRING, forecast_month DATE, "
                               "forecast_revenue_usd INT, lower_bound_usd INT, upper_bound_usd INT")
    assert [r.anomaly for r in forecast.forecast_anomalies(df).collect()] == ([rule] if rule else [])


def test_handed_off_forecast_by_category(shop):
    rows = by(kpis.forecast_by_category(shop.forecasts))
    assert (rows["Headwear"]["forecast"], rows["Headwear"]["lower_bound"]) == (81000, 86000)
    assert (rows["Accessories"]["forecast"], rows["Accessories"]["upper_bound"]) == (-1433, -933)


def test_comparison_and_swings(spark, shop):
    h = history(spark, Outerwear=[1, 47000, 47000, 47000], Drinkware=[1, 8000, 8000, 8000])
    own = forecast.baseline_forecast(h, date(2024, 2, 1), [date(2024, 5, 1), date(2024, 6, 1)])
    assert {(r.forecast_revenue, r.lower_bound, r.upper_bound) for r in own.collect()} == {
        (D("47000.00"), 42300.0, 51700.0), (D("8000.00"), 7200.0, 8800.0)}
    comparison = forecast.compare_forecasts(h, own, shop.forecasts, date(2024, 2, 1))
    rows = by(comparison)
    assert set(rows) == {"Outerwear", "Drinkware"}
    assert (rows["Outerwear"]["other_minus_own"], rows["Outerwear"]["other_vs_actual_pct"]) == (-41667, -89)
    assert [r.category for r in forecast.swing_anomalies(comparison).collect()] == ["Outerwear"]
    assert forecast.by_disagreement(comparison).first().category == "Outerwear"


def test_growth_from_nothing_is_zero(sales):
    first, last = (date(2023, 1, 1), date(2023, 3, 31)), (date(2024, 1, 1), date(2024, 1, 31))
    assert {r.growth_pct for r in timeseries.growth(sales, first, last).collect()} == {0.0}


def test_season_index_counts_full_quarters_only(spark):
    rows = [("a", date(2024, m, 15), D(100 if m < 10 else 200)) for m in range(1, 13)] + [("a", date(2025, 1, 5), D(9999))]
    df = spark.createDataFrame(rows, "category STRING, order_date DATE, line_revenue DECIMAL(10,2)")
    assert timeseries.seasonality_index(df).collect() == [("a", 3, 150.0)]


def test_missing_dates(sales):
    assert [r.missing_date for r in timeseries.missing_dates(sales, "order_date").collect()] == [date(2024, 1, 2)]


# --- Quality ----------------------------------------------------------------------------------

def test_checks_pass_on_good_data_and_fail_on_bad(shop, sales):
    assert quality.computed_violations(sales).first()[0] == 0
    wrong = sales.withColumn("line_profit", F.col("line_profit") + F.when(F.col("order_id") == 11, 1).otherwise(0))
    assert quality.computed_violations(wrong).first()[0] == 1
    assert quality.identity_check(sales).first().holds
    assert not quality.identity_check(wrong).first().holds
    assert quality.no_values(sales, "order_status", ["CANCELLED"]).first()[0] == 0
    assert quality.no_values(shop.orders, "order_status", ["CANCELLED"]).first()[0] == 1
    assert not quality.row_parity(sales, shop.items).first().same


def test_key_checks_report_orphans_and_duplicates(shop):
    row = quality.key_checks(shop.items, shop.orders, "order_id").first()
    assert (row.orphan_rows, row.duplicate_keys) == (1, 0)
    row = quality.key_checks(shop.items, shop.products.union(shop.products), "product_id").first()
    assert (row.orphan_rows, row.duplicate_keys) == (1, 3)


def test_reconcile_shows_keys_lost_on_either_side(spark):
    a = spark.createDataFrame([("x", D("1.00")), ("y", D("2.00"))], "k STRING, v DECIMAL(10,2)")
    b = spark.createDataFrame([("x", D("1.00")), ("z", D("3.00"))], "k STRING, v DECIMAL(10,2)")
    assert {r.k: r.difference for r in quality.reconcile(a, b, "k", "v").collect()} == {"x": 0, "y": 2, "z": -3}


def test_profile_and_range_and_coverage(shop, marketing):
    rows = by(quality.profile(shop.orders), "column_name")
    status = rows["order_status"]
    assert (status["row_count"], status["null_count"], status["distinct_count"]) == (5, 1, 3)
    assert (rows["order_id"]["min_value"], rows["order_id"]["max_value"]) == ("10", "14")
    assert rows["order_ts"]["null_count"] == 5
    assert tuple(quality.in_range(marketing, "campaign_roi", 1.5, 5.0).first()) == (1.167, 4.0, 1)
    assert [r.category for r in quality.coverage(marketing, shop.products, "category").collect()] == [CAPS]


def test_empty_tables(spark, sales, marketing):
    none = sales.limit(0)
    assert gold.build_category_performance(none, marketing).count() == 0
    assert quality.computed_violations(none).first()[0] == 0
    assert timeseries.missing_dates(none, "order_date").count() == 0
    assert quality.profile(none.select("order_id")).first().row_count == 0


# --- Decision ---------------------------------------------------------------------------------

def test_recommendation_counts_decision_signals_only(spark):
    summary = spark.createDataFrame(
        [("Outerwear", 10, 9, 50.0, 1, 98.0, 4.7), ("Accessories", 5, 4, 66.0, 9, 43.0, 1.8), ("Drinkware", 3, 2, 60.0, 2, 55.0, 3.0)],
        "category STRING, revenue INT, profit INT, margin_pct DOUBLE, units INT, growth_pct DOUBLE, marketing_roi DOUBLE")
    q4 = spark.createDataFrame([("Outerwear", 142.0), ("Drinkware", 150.0)], "category STRING, q_index DOUBLE")
    outlook = spark.createDataFrame([("Outerwear", 1.0), ("Outerwear", 3.0), ("Drinkware", 1.5)], "category STRING, forecast_revenue DOUBLE")
    research = spark.createDataFrame(
        [("Outerwear", 11.0, 135.0, 70.0, 50.0, 40.0), ("T-Shirts & Tops", 3.0, 90.0, 30.0, 45.0, 30.0),
         ("Headwear", 6.0, 120.0, 25.0, 47.0, 33.0), ("Accessories", 2.0, 100.0, 15.0, 30.0, 20.0),
         ("Drinkware", 4.0, 115.0, 35.0, 44.0, 21.0)],
        "category STRING, next_quarter_growth_pct DOUBLE, q4_demand_index DOUBLE, willingness_to_pay DOUBLE, "
        "typical_margin_pct DOUBLE, repeat_rate_pct DOUBLE")
    signals = decision.decision_signals(summary, q4, outlook, research)
    leaders = {r.signal: (r.role, r.leader) for r in signals.collect()}
    assert leaders["q4_index"] == ("decision", "Drinkware")
    assert leaders["units"] == leaders["margin"] == ("contrast", "Accessories")
    best = decision.recommend(signals).first()
    assert (best.recommended_category, best.signals_won) == ("Outerwear", 5)
    assert len(decision.decision_signals(summary, q4, outlook).collect()) == 7
    internal = summary.select("category", F.col("growth_pct").alias("growth"), F.col("margin_pct").alias("margin")).join(
        q4.withColumnRenamed("q_index", "q4_index"), "category", "left")
    agreement = {r.signal: r.agrees for r in decision.triangulate(internal, research).collect()}
    assert agreement == {"growth": True, "q4_index": False, "margin": False}
    assert decision.with_market_research(summary, research).count() == 3


def test_summary_is_zero_where_undefined(sales, marketing):
    rows = by(decision.category_summary(sales, marketing, (date(2023, 1, 1), date(2023, 3, 31)),
                                        (date(2024, 1, 1), date(2024, 3, 31))))
    assert rows[CAPS]["marketing_roi"] == 0.0 and rows[CAPS]["growth_pct"] == 0.0
    assert rows[TEES]["marketing_roi"] == 1.5


# --- Any horizon, any frequency, complete periods -----------------------------------------------

def points(spark, days, values):
    return spark.createDataFrame(list(zip(["a"] * len(days), days, map(float, values))), "g STRING, t DATE, v DOUBLE")


def test_a_horizon_inside_a_period_leaves_it_out(spark):
    df = points(spark, [date(2024, 1, 1), date(2024, 2, 1), date(2024, 3, 1)], [1, 2, 3])
    assert forecast.forecast(df, date(2024, 3, 15), "t", "v", "g").count() == 0
    rows = forecast.forecast(df, date(2024, 5, 31), "t", "v", "g").orderBy("t").collect()
    assert [(r.t, r.v_forecast, r.model) for r in rows] == [
        (date(2024, 4, 1), 4.0, "line"), (date(2024, 5, 1), 5.0, "line")]


@pytest.mark.parametrize("frequency, step, length", [
    ("day", timedelta(1), 7), ("week", timedelta(7), 52), ("year", None, 1)])
def test_seasons_of_every_frequency(spark, frequency, step, length):
    n = 2 * length + 3
    days = [date(2000 + i, 1, 1) if step is None else date(2020, 1, 2) + i * step for i in range(n)]
    df = points(spark, days, [10 + (i % length == 2) for i in range(n)])
    last = date(2000 + n + 1, 1, 1) if step is None else days[-1] + 3 * step
    rows = forecast.forecast(df, last, "t", "v", "g", frequency, seasonal=True).collect()
    assert {r.model for r in rows} == {"line and season"} and len(rows) == (2 if step is None else 3)
    short = forecast.forecast(df.limit(1), last, "t", "v", "g", frequency, seasonal=True)
    assert {r.model for r in short.collect()} == ({"line"} if length > 1 else {"line"})


def test_history_of_complete_periods(spark):
    days = [date(2024, 1, 31), date(2024, 2, 28), date(2024, 2, 29), date(2024, 3, 30)]
    df = spark.createDataFrame([("a", d, D(1)) for d in days] + [("b", date(2024, 2, 1), D(5))],
                               "category STRING, order_date DATE, line_revenue DECIMAL(10,2)")
    months = timeseries.monthly_history(df, complete=True)
    assert sorted((r.month.month, r.category) for r in months.collect()) == [(1, "a"), (2, "a"), (2, "b")]
    assert timeseries.monthly_history(df).count() == 4
    assert timeseries.history(df, "category", "quarter", name="q", complete=True).count() == 0
    end = df.filter("order_date <= '2024-02-29'")
    assert timeseries.monthly_history(end, complete=True).count() == 3


def test_ordered_by_keys_in_both_directions(spark):
    df = spark.createDataFrame([("a", 2), ("b", 2), ("c", 3)], "k STRING, v INT")
    assert [r.k for r in ordered(df, "-v", "k").collect()] == ["c", "a", "b"]


def test_research_is_optional_for_a_category(spark):
    left = spark.createDataFrame([("a", 1), ("b", 2)], "category STRING, x INT")
    right = spark.createDataFrame([("a", 1.5)], "category STRING, y DOUBLE")
    assert sorted(map(tuple, decision.with_market_research(left, right).collect())) == [("a", 1, 1.5), ("b", 2, None)]


def test_sales_plan_joins_twice_and_filters_orders_at_the_scan(spark):
    star = Star(spark, "/root/testdata/sf0.001")
    usual = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = star.sales._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", usual)
    assert plan.count("SortMergeJoin") == 2 and plan.count("Exchange hashpartitioning") == 4
    assert "Not(EqualTo(o_orderstatus,P))" in plan
