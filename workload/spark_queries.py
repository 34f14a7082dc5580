"""Every operator as a query over one directory of tables.

A query takes the session and the directory and returns a frame. Amounts leave as DOUBLE after they
were rounded as DECIMAL.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, timedelta
from functools import lru_cache, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from tallyhouse.functions import money
from tallyhouse.operators import decision, filters, forecast, gold, kpis, quality, silver, states, timeseries
from tallyhouse.operators.ranking import ordered, rank_by, rank_in_ranges, top_n
from tallyhouse.plans.lineage import cut_lineage, scratch_path
from tallyhouse.plans.metrics import RoutedView, drill_across, marketing_metrics, sales_metrics
from tallyhouse.plans.refresh import MONTH, Schemas, refresh
from tallyhouse.sources import files, incremental, ingest, star, tables
from tallyhouse.sources.merged import MergedTable
from tallyhouse.sources.schemas import SCHEMAS, SourceTable
from tallyhouse.sources.star import (
    FIRST_QUARTER, FORECAST_MONTHS, LAST_QUARTER, RECENT_SINCE, Star)
from tallyhouse.streaming.file_ingest import ingest_arrivals, rejected

Query = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, Query] = {}


@lru_cache(maxsize=8)
def _star(spark: SparkSession, directory: str) -> Star:
    """Tables are resolved once per session, as a catalog would."""
    return Star(spark, directory)


def query(build: Callable[[Star], DataFrame]) -> Callable[[Star], DataFrame]:
    """Register a function of the star under its own name."""

    def run(spark: SparkSession, directory: str) -> DataFrame:
        df = build(_star(spark, directory))
        return df.withColumns({
            f.name: F.col(f"`{f.name}`").cast("double")
            for f in df.schema.fields if isinstance(f.dataType, DecimalType)})

    run.__name__, run.__doc__ = build.__name__, build.__doc__
    REGISTRY[build.__name__] = run
    return build


# --- Sources, ingestion, storage --------------------------------------------------------------

def _as_text(df: DataFrame, column: str = "order_ts") -> DataFrame:
    """Times leave as text, which is the same in every engine."""
    return df.withColumn(column, F.date_format(column, "yyyy-MM-dd HH:mm:ss"))


@query
def load_audit(s: Star) -> DataFrame:
    """Row counts of the tables that should have been loaded, one of which is absent."""
    return tables.load_audit({
        "dim_product": s.products, "dim_customer": s.customers, "fact_orders": s.orders,
        "fact_order_items": s.items, "fact_marketing_campaigns": s.campaigns,
        "fact_sales_forecast": s.forecasts, "fact_returns": None}, s.spark)


@query
def csv_orders(s: Star) -> DataFrame:
    """Orders written as CSV and read back under the declared types; some fields are empty."""
    path = scratch_path(s.spark, "orders-csv")
    columns = SCHEMAS["fact_orders"].names
    raw = s.orders.withColumns({
        "shipping_cost": F.when(F.col("order_id") % 3 == 0, (F.col("customer_id") % 50 / 4).cast("decimal(10,2)")),
        "channel": F.when(F.col("order_id") % 4 != 0, F.col("channel"))}).select(*columns)
    raw.write.option("header", True).option("emptyValue", "").csv(path)
    back = files.read_csv(s.spark, path, "fact_orders")
    return _as_text(back.select("order_id", "customer_id", "order_date", "order_ts", "channel", "order_status",
                                "shipping_cost"))


@query
def extract_since(s: Star) -> DataFrame:
    """Orders newer than the newest order of the year before."""
    seen = s.orders.filter(F.col("order_date") < F.lit(date(2000, 1, 1)))
    mark = incremental.high_water_mark(seen, "order_ts").scalar()
    return _as_text(incremental.extract_since(s.orders, "order_ts", mark))


@query
def extract_with_overlap(s: Star) -> DataFrame:
    """The same with the mark moved back by ten days, for rows that arrive late."""
    seen = s.orders.filter(F.col("order_date") < F.lit(date(2000, 1, 1)))
    mark = incremental.high_water_mark(seen, "order_ts").scalar()
    return _as_text(incremental.extract_since(s.orders, "order_ts", mark, timedelta(days=10)))


def _order_updates(s: Star) -> tuple[DataFrame, DataFrame]:
    """Stored orders up to 2000, and a batch of new, changed, repeated and stale rows."""
    day, orders = F.col("order_date"), s.orders
    target = orders.filter(day < F.lit(date(2001, 1, 1)))
    late = orders.filter(day >= F.lit(date(2000, 7, 1)))

    def version(rows: DataFrame, hours: int, status: str) -> DataFrame:
        return rows.withColumns({
            "order_ts": F.col("order_ts") + F.make_dt_interval(hours=F.lit(hours)),
            "order_status": F.lit(status)})

    stale = orders.filter(day < F.lit(date(1996, 1, 1)))
    batch = (
        late.unionByName(version(late, 1, "RETURNED"))
        .unionByName(version(late.filter(F.col("channel") == "1-URGENT"), 2, "COMPLETED"))
        .unionByName(version(stale, -1, "CANCELLED"))
    )
    return target, batch


@query
def upsert_orders(s: Star) -> DataFrame:
    target, batch = _order_updates(s)
    return _as_text(incremental.upsert(target, batch, "order_id", "order_ts"))


@query
def latest_orders(s: Star) -> DataFrame:
    """Newest version per order over stored rows and batch together."""
    target, batch = _order_updates(s)
    return _as_text(incremental.latest_per_key(target.unionByName(batch), "order_id", "order_ts"))


@query
def ingested_orders(s: Star) -> DataFrame:
    """Two runs of the incremental ingestion into a bronze store, and its current state."""
    entry = SourceTable("fact_orders", "order_id", "order_ts")
    store = ingest.BronzeStore(s.spark, scratch_path(s.spark, "bronze"))
    early = s.orders.filter(F.col("order_date") < F.lit(date(2000, 1, 1)))
    for snapshot in (early, s.orders):
        ingest.ingest_bronze(store, lambda name, snapshot=snapshot: snapshot, [entry])
    return _as_text(store.current(entry))


# The given tables carry no key of a line, so order and product stand for it.
INGESTED = (
    SourceTable("dim_product", "product_id", "product_id"),
    SourceTable("dim_customer", "customer_id", "customer_id"),
    SourceTable("fact_orders", "order_id", "order_ts"),
    SourceTable("fact_order_items", "item_key", "item_key"),
    SourceTable("fact_marketing_campaigns", "campaign_id", "campaign_id"),
    SourceTable("fact_sales_forecast", "forecast_id", "forecast_id"),
)


@query
def ingested_tables(s: Star) -> DataFrame:
    """All tables of the manifest after two runs; the second meets late, changed and new rows.

    The first run sees customers and products without every seventh key and with another text in every
    fifth, orders without those of one late day, and half of the lines. Both see the same forecasts, a row per
    category and month, which are worked out from all sales once.
    """
    items = s.items.groupBy("order_id", "product_id").agg(
        F.sum("quantity").alias("quantity"), F.max("unit_price").alias("unit_price")).withColumn(
        "item_key", F.concat_ws("-", "order_id", "product_id"))
    final = {"dim_product": s.products, "dim_customer": s.customers, "fact_orders": s.orders,
             "fact_order_items": items, "fact_marketing_campaigns": s.campaigns,
             "fact_sales_forecast": cut_lineage(s.forecasts)}

    def older(df: DataFrame, key: str, changed: str) -> DataFrame:
        stale = F.when(F.col(key) % 5 == 0, F.lit("unknown")).otherwise(F.col(changed))
        return df.filter(F.col(key) % 7 != 0).withColumn(changed, stale)

    late = F.col("order_date") == F.lit(date(2001, 7, 25))
    first = dict(final, dim_product=older(s.products, "product_id", "category"),
                 dim_customer=older(s.customers, "customer_id", "region"),
                 fact_orders=s.orders.filter(~late), fact_order_items=items.filter("order_id % 2 = 0"))
    store = ingest.BronzeStore(s.spark, scratch_path(s.spark, "bronze"))
    for snapshot in (first, final):
        ingest.ingest_bronze(store, snapshot.__getitem__, INGESTED, overlap=timedelta(days=30))
    texts = {"dim_product": "category", "dim_customer": "region", "fact_orders": "order_status",
             "fact_order_items": "item_key", "fact_marketing_campaigns": "category", "fact_sales_forecast": "category"}
    parts = [store.current(e).groupBy(F.col(texts[e.name]).alias("value")).agg(F.count("*").alias("row_count")).select(
        F.lit(e.name).alias("table_name"), "value", "row_count") for e in INGESTED]
    return reduce(DataFrame.unionByName, parts)


@query
def merged_orders(s: Star) -> DataFrame:
    """Orders in a stored table that the batch of ``upsert_orders`` is merged into, twice."""
    target, batch = _order_updates(s)
    table = MergedTable(s.spark, scratch_path(s.spark, "merged"), "order_id", "order_ts", buckets=16)
    for rows in (target, batch, batch, batch.filter("order_id % 1000 = 7")):
        table.merge(rows)
    return _as_text(table.read())


@query
def ingested_deletions(s: Star) -> DataFrame:
    """What is left of products, customers and orders whose later snapshots lack rows.

    Of products and customers, which are compared as a whole, some come later and some come back. Orders are
    read by their time; the ones that are gone lie long before the mark.
    """
    entries = [e for e in INGESTED if e.name in ("dim_product", "dim_customer", "fact_orders")]
    early = s.orders.filter(F.col("order_date") < F.lit(date(2000, 1, 1)))
    rules = (("{0} % 5 <> 1", early), ("{0} % 7 <> 0", s.orders.filter("order_id % 7 <> 0")),
             ("{0} % 7 <> 0 or {0} % 14 = 0", s.orders.filter("order_id % 7 <> 0")))
    store = ingest.BronzeStore(s.spark, scratch_path(s.spark, "bronze"))
    for rule, orders in rules:
        snapshot = {"dim_product": s.products.filter(rule.format("product_id")),
                    "dim_customer": s.customers.filter(rule.format("customer_id")), "fact_orders": orders}
        ingest.ingest_bronze(store, snapshot.__getitem__, entries, overlap=timedelta(days=30), deletions=True)
    shown = {"dim_product": "category", "dim_customer": "region", "fact_orders": "order_status"}
    return reduce(DataFrame.unionByName, [store.current(e).select(
        F.lit(e.name).alias("table_name"), F.col(e.primary_key).alias("key"), F.col(shown[e.name]).alias("value"))
        for e in entries])


@query
def compacted_orders(s: Star) -> DataFrame:
    """Orders that arrive year by year, with two compactions between the runs."""
    entry = SourceTable("fact_orders", "order_id", "order_ts")
    store = ingest.BronzeStore(s.spark, scratch_path(s.spark, "bronze"))
    for year in (1997, 1998, 1999, 2001, 2002):
        seen = s.orders.filter(F.col("order_date") < F.lit(date(year, 1, 1)))
        ingest.ingest_bronze(store, lambda name, seen=seen: seen, [entry])
        if year in (1998, 2001):
            store.compact(entry)
    return _as_text(store.current(entry))


def _streamed(s: Star) -> tuple[ingest.BronzeStore, SourceTable]:
    """Orders from CSV files that arrive in three runs: the early ones; the same again under other names, and
    later versions; the rest, among them lines whose time is none."""
    entry = SourceTable("fact_orders", "order_id", "order_ts")
    root = scratch_path(s.spark, "arrivals")
    store = ingest.BronzeStore(s.spark, f"{root}/bronze")
    names = SCHEMAS["fact_orders"].names
    rows = _as_text(s.orders).withColumn("shipping_cost", F.lit(None).cast("decimal(10,2)")).select(*names)
    early = F.col("order_date") < F.lit(date(1998, 1, 1))
    newer = rows.filter(early & (F.col("order_id") % 3 == 0)).withColumns({
        "order_ts": F.regexp_replace("order_ts", "00:00:00$", "12:00:00"), "order_status": F.lit("RETURNED")})
    garbled = F.when(F.col("order_id") % 50 == 0, F.lit("no time")).otherwise(F.col("order_ts"))
    runs = ([rows.filter(early)], [rows.filter(early), newer], [rows.filter(~early).withColumn("order_ts", garbled)])
    for run, batches in enumerate(runs):
        for k, batch in enumerate(batches):
            batch.write.option("header", True).option("emptyValue", "").csv(f"{root}/inbox/{run}-{k}")
        ingest_arrivals(store, entry, f"{root}/inbox/*", f"{root}/stream").awaitTermination()
    return store, entry


@query
def streamed_orders(s: Star) -> DataFrame:
    """The state of the orders after three runs of the file stream."""
    store, entry = _streamed(s)
    return _as_text(store.current(entry).drop("shipping_cost"))


@query
def streamed_rejects(s: Star) -> DataFrame:
    """The lines that the file stream could not take."""
    store, entry = _streamed(s)
    return rejected(store, entry).select(F.col("_line").alias("line"))


def _schemas(s: Star, label: str) -> Schemas:
    """Catalog schemas of their own below the shared folder."""
    names = Schemas(*(f"{layer}_{uuid.uuid4().hex}" for layer in ("silver", "gold")))
    for name in (names.silver, names.gold):
        s.spark.sql(f"CREATE SCHEMA {name} LOCATION '{scratch_path(s.spark, label)}'")
    return names


@query
def stored_category_performance(s: Star) -> DataFrame:
    """Category performance as a stored table, written twice and read back."""
    name = f"{_schemas(s, 'tables').gold}.category_performance"
    performance = gold.build_category_performance(s.sales, s.marketing)
    tables.write_table(performance.limit(1), name, "One row per category")
    return tables.write_table(performance, name, "One row per category")


@query
def viewed_monthly_history(s: Star) -> DataFrame:
    """Complete months through a view that is replaced once."""
    tables.register_view(s.sales, "monthly_history_view")
    tables.register_view(s.history, "monthly_history_view")
    return s.spark.table("monthly_history_view").withColumn("revenue", money(F.col("revenue")))


def _refreshed(s: Star, july: bool = True) -> Schemas:
    """All layers after a full refresh and two partial ones, when most of June 2001 was cancelled in between and,
    if asked for, everything since July."""
    names = _schemas(s, "refresh")
    day = F.col("order_date")
    cancelled = day.between(F.lit(date(2001, 6, 5)), F.lit(date(2001, 6, 25)))
    if july:
        cancelled |= day >= F.lit(date(2001, 7, 1))
    bronze = {"fact_orders": s.orders, "fact_order_items": s.items, "dim_product": s.products,
              "fact_marketing_campaigns": s.campaigns}
    refresh(s.spark, bronze, names)
    bronze["fact_orders"] = s.orders.withColumn(
        "order_status", F.when(cancelled, F.lit("CANCELLED")).otherwise(F.col("order_status")))
    for _ in range(2):
        refresh(s.spark, bronze, names, since=date(2001, 6, 10))
    return names


@query
def refreshed_daily_revenue(s: Star) -> DataFrame:
    """Daily revenue after a full refresh and two partial ones, when June 2001 was cancelled in between."""
    return s.spark.table(_refreshed(s, july=False).daily).drop(MONTH)


@query
def refreshed_category_performance(s: Star) -> DataFrame:
    """Category performance, added up from stored sums by day after partial refreshes."""
    return s.spark.table(f"{_refreshed(s).gold}.category_performance")


@query
def refreshed_order_counts(s: Star) -> DataFrame:
    """Distinct orders at four grains, all from the one table of baskets that the refreshes keep."""
    return states.order_counts(s.spark.table(_refreshed(s).baskets))


@query
def stored_daily_revenue(s: Star) -> DataFrame:
    """Daily revenue written to files and read back."""
    path = scratch_path(s.spark, "daily")
    gold.build_daily_revenue(s.sales_by_order).write.parquet(path)
    return s.spark.read.parquet(path)


# --- Silver -----------------------------------------------------------------------------------

@query
def sales_lines(s: Star) -> DataFrame:
    return s.sales


@query
def sales_without_status(s: Star) -> DataFrame:
    """Sales per status when every tenth customer's orders have none; they are dropped as cancelled ones are."""
    orders = s.orders.withColumn("order_status", F.when(F.col("customer_id") % 10 != 0, F.col("order_status")))
    return gold.status_counts(silver.build_sales(s.items, orders, s.products))


@query
def sales_of_heavy_keys(s: Star) -> DataFrame:
    """Sales when a third of all lines belong to one order and another third are of one product."""
    hot = F.col("order_id") % 3
    items = s.items.withColumns({
        "order_id": F.when(hot == 0, F.lit(3)).otherwise(F.col("order_id")),
        "product_id": F.when(hot == 1, F.lit(7)).otherwise(F.col("product_id"))})
    return silver.build_sales_evenly(items, s.orders.withColumn("order_status", F.lit("COMPLETED")), s.products).select(
        "order_id", "product_id", "customer_id", "category", "quantity", "line_revenue")


@query
def product_history(s: Star) -> DataFrame:
    """Complete months of every product."""
    history = timeseries.history(s.sales, "product_id", complete=True)
    return history.withColumn("revenue", money(F.col("revenue")))


@query
def order_lines(s: Star) -> DataFrame:
    """Lines of every status, with their cost."""
    return silver.with_line_cost(s.lines).select(
        "order_id", "product_id", "order_status", "quantity", "line_revenue", "line_profit", "line_cost")


@query
def sales_with_customer(s: Star) -> DataFrame:
    return silver.sales_with_customer(s.sales, s.customers).select(
        "order_id", "customer_id", "category", "region", "country", "customer_segment", "line_revenue")


@query
def silver_marketing(s: Star) -> DataFrame:
    return s.marketing.drop("campaign_id")


@query
def returned_preview(s: Star) -> DataFrame:
    """Lines of returned orders in one category."""
    lines = filters.with_value(filters.with_value(s.sales, "order_status", "RETURNED"), "category", "PROMO")
    return lines.select("order_id", "product_name", "quantity", "line_revenue")


@query
def spring_orders(s: Star) -> DataFrame:
    return filters.between_dates(s.orders, "order_date", date(2000, 3, 1), date(2000, 5, 31)).transform(_as_text)


@query
def last_90_days(s: Star) -> DataFrame:
    return filters.last_n_days(gold.build_daily_revenue(s.sales_by_order), "order_date", 90)


@query
def last_6_months(s: Star) -> DataFrame:
    """Monthly revenue of the last six calendar months."""
    history = filters.last_n_months(timeseries.monthly_history(s.sales), "month", 6)
    return history.withColumn("revenue", money(F.col("revenue")))


# --- Gold -------------------------------------------------------------------------------------

@query
def category_performance(s: Star) -> DataFrame:
    return gold.build_category_performance(s.sales, s.marketing)


@query
def daily_revenue(s: Star) -> DataFrame:
    return gold.build_daily_revenue(s.sales_by_order)


@query
def marketing_by_category(s: Star) -> DataFrame:
    return gold.marketing_by(s.marketing, "category")


@query
def marketing_by_channel(s: Star) -> DataFrame:
    return gold.marketing_by(s.marketing, "channel")


@query
def status_counts(s: Star) -> DataFrame:
    return gold.status_counts(s.sales)


@query
def overall_kpis(s: Star) -> DataFrame:
    return gold.overall_kpis(s.sales)


@query
def date_coverage(s: Star) -> DataFrame:
    return gold.date_coverage(s.sales, "order_date")


@query
def rough_peek(s: Star) -> DataFrame:
    return gold.rough_peek(s.items, s.orders, s.products)


# --- Business questions -----------------------------------------------------------------------

@query
def kpi_category(s: Star) -> DataFrame:
    return kpis.kpi_by(s.sales, ["category"])


@query
def kpi_channel(s: Star) -> DataFrame:
    return kpis.kpi_by(s.sales, ["channel"])


@query
def kpi_region_country(s: Star) -> DataFrame:
    return kpis.kpi_by_customer(s.sales, s.customers, ["region", "country"])


@query
def kpi_segment(s: Star) -> DataFrame:
    return kpis.kpi_by_customer(s.sales, s.customers, ["customer_segment"])


@query
def rank_categories(s: Star) -> DataFrame:
    return kpis.rank_categories(s.sales).select("category", "total_profit", "rank")


@query
def rank_disagreement(s: Star) -> DataFrame:
    return kpis.rank_disagreement(s.sales)


@query
def rank_customers(s: Star) -> DataFrame:
    """Every customer ranked by units, by value ranges instead of one sorted task."""
    units = s.sales.groupBy("customer_id").agg(F.sum("quantity").alias("units"))
    return rank_in_ranges(units, "units", "units_rank")


@query
def monthly_trend(s: Star) -> DataFrame:
    return kpis.monthly_trend(s.sales)


@query
def discount_depth(s: Star) -> DataFrame:
    return kpis.discount_depth(s.sales)


@query
def status_rates(s: Star) -> DataFrame:
    return kpis.status_rates(s.lines)


@query
def marketing_funnel(s: Star) -> DataFrame:
    return kpis.marketing_funnel(s.marketing, "category")


@query
def marketing_funnel_channel(s: Star) -> DataFrame:
    return kpis.marketing_funnel(s.marketing, "channel")


@query
def product_performance(s: Star) -> DataFrame:
    return kpis.product_performance(s.sales)


@query
def top_products(s: Star) -> DataFrame:
    return kpis.top_products(s.sales)


@query
def top_customers(s: Star) -> DataFrame:
    """Ten customers with the highest revenue."""
    totals = s.sales.groupBy("customer_id").agg(money(F.sum("line_revenue")).alias("revenue"))
    return top_n(totals, "revenue", 10, "customer_id")


@query
def leaders(s: Star) -> DataFrame:
    return kpis.leaders(s.sales)


@query
def shop_overview(s: Star) -> DataFrame:
    return kpis.shop_overview(s.sales)


@query
def forecast_by_category(s: Star) -> DataFrame:
    return kpis.forecast_by_category(s.forecasts)


@query
def daily_business(s: Star) -> DataFrame:
    return kpis.daily_business(s.sales)


@query
def latest_margin(s: Star) -> DataFrame:
    return kpis.latest(kpis.daily_business(s.sales), "order_date", "operating_margin_pct")


@query
def margin_alert(s: Star) -> DataFrame:
    """Days with an operating margin below 36.5 %."""
    return kpis.alert(kpis.daily_business(s.sales), F.col("operating_margin_pct") < 36.5)


@query
def category_decision(s: Star) -> DataFrame:
    return kpis.category_decision(s.sales, s.marketing)


@query
def categories_by_revenue(s: Star) -> DataFrame:
    """One ordering key: the three categories with the highest revenue."""
    return ordered(kpis.kpi_by(s.sales, ["category"]), "-total_revenue", "category").limit(3)


@query
def countries_by_region(s: Star) -> DataFrame:
    """Two ordering keys: the first seven countries by region and falling profit."""
    found = kpis.kpi_by_customer(s.sales, s.customers, ["region", "country"])
    return ordered(found, "region", "-total_profit", "country").limit(7)


@query
def summary_by_revenue(s: Star) -> DataFrame:
    """The four categories that lead the decision summary by revenue."""
    return ordered(_summary(s, s.sales), "-revenue", "category").limit(4)


# --- Metric views -----------------------------------------------------------------------------

def _rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(F.col(f"`{n}`"), digits) for n in names})


@query
def metrics_sales_flat(s: Star) -> DataFrame:
    flat = sales_metrics(s.sales).to_flat_view()
    flat = _rounded(flat, 2, "Total_Revenue", "Total_Cost", "Total_Profit")
    return _rounded(flat, 4, "Profit_Margin_Pct", "Avg_Order_Line_Value")


@query
def metrics_marketing_flat(s: Star) -> DataFrame:
    return _rounded(marketing_metrics(s.marketing).to_flat_view(), 4, "Marketing_ROI")


SALES_MEASURES = ("Total Revenue", "Total Cost", "Total Profit", "Profit Margin Pct", "Units Sold",
                  "Avg Order Line Value")


def _sales_metrics(s: Star, by: list[str], **options) -> DataFrame:
    result = sales_metrics(s.sales).query(SALES_MEASURES, by=by, **options)
    result = _rounded(result, 2, "Total Revenue", "Total Cost", "Total Profit")
    return _rounded(result, 4, "Profit Margin Pct", "Avg Order Line Value")


@query
def metrics_sales_by_category(s: Star) -> DataFrame:
    return _sales_metrics(s, ["Category"])


@query
def metrics_sales_by_month(s: Star) -> DataFrame:
    return _sales_metrics(s, ["Order Month", "Channel"])


@query
def metrics_sales_sliced(s: Star) -> DataFrame:
    """Filtered on three dimensions, sorted, cut to three rows."""
    return _sales_metrics(
        s, ["Subcategory"], order=[F.col("Total Profit").desc(), F.col("Subcategory")], limit=3,
        where={"Category": ["LARGE", "SMALL"], "Channel": "5-LOW",
               "Order Date": (date(1999, 1, 1), date(1999, 12, 31))})


def _routed(s: Star, by: list[str], **options) -> DataFrame:
    """The same measures through a stored grain of category, channel and month where that can answer."""
    view = sales_metrics(s.sales)
    path = scratch_path(s.spark, "metrics")
    view.stored_grain(["Category", "Channel", "Order Month"]).write.parquet(path)
    routed = RoutedView(view, [view.answered_from(s.spark.read.parquet(path))])
    result = _rounded(routed.query(SALES_MEASURES, by=by, **options), 2, "Total Revenue", "Total Cost", "Total Profit")
    return _rounded(result, 4, "Profit Margin Pct", "Avg Order Line Value")


@query
def metrics_routed_by_category(s: Star) -> DataFrame:
    """Answered from the stored grain, with a condition on another dimension of it."""
    return _routed(s, ["Category"], where={"Channel": ["5-LOW", "2-HIGH"], "Order Month": (date(1997, 1, 1), date(1999, 12, 1))})


@query
def metrics_routed_by_subcategory(s: Star) -> DataFrame:
    """The stored grain has no subcategories, so this goes to the lines."""
    return _routed(s, ["Subcategory"], where={"Channel": "5-LOW"})


@query
def metrics_overall(s: Star) -> DataFrame:
    return _sales_metrics(s, [])


@query
def metrics_marketing(s: Star) -> DataFrame:
    result = marketing_metrics(s.marketing).query(
        ["Marketing Spend", "Attributed Revenue", "Marketing ROI", "Conversions"], by=["Category"])
    return _rounded(result, 4, "Marketing ROI")


@query
def metrics_ratio_only(s: Star) -> DataFrame:
    """A ratio whose two sums are not shown."""
    result = marketing_metrics(s.marketing).query(["Marketing ROI"], by=["Marketing Channel"])
    return _rounded(result, 4, "Marketing ROI")


@query
def metrics_formatted(s: Star) -> DataFrame:
    return sales_metrics(s.sales).query(["Total Revenue", "Units Sold"], by=["Category"], formatted=True)


@query
def drill_across_views(s: Star) -> DataFrame:
    """Sales and marketing metrics side by side."""
    left = sales_metrics(s.sales).query(["Total Profit", "Units Sold"], by=["Category"])
    right = marketing_metrics(s.marketing).query(["Marketing ROI", "Conversions"], by=["Category"])
    joined = drill_across([left, right], ["Category"], "full_outer")
    return _rounded(_rounded(joined, 2, "Total Profit"), 4, "Marketing ROI")


# --- Time series and forecasts ----------------------------------------------------------------

def _daily_totals(s: Star) -> DataFrame:
    """Sales by day and category, stored once for queries that draw several results from them."""
    return cut_lineage(gold.compact_sales(s.sales, "order_date", "category"))


def _trend(history: DataFrame) -> DataFrame:
    return forecast.forecast(history, FORECAST_MONTHS[-1], "month", "revenue", "category")


def _own_forecast(history: DataFrame) -> DataFrame:
    return _trend(history).select("category", F.col("month").alias("forecast_month"),
                                  F.col("revenue_forecast").alias("forecast_revenue"))


def _comparison(s: Star) -> DataFrame:
    history = cut_lineage(s.history)
    return forecast.compare_forecasts(
        history, _own_forecast(history), star.handed_off_forecast(history), RECENT_SINCE)


@query
def monthly_history(s: Star) -> DataFrame:
    return timeseries.monthly_history(s.sales).withColumn("revenue", money(F.col("revenue")))


@query
def forecast_trend(s: Star) -> DataFrame:
    return _trend(s.history)


@query
def forecast_seasonal(s: Star) -> DataFrame:
    return forecast.forecast(
        cut_lineage(s.history), date(2002, 7, 1), "month", "revenue", "category", seasonal=True)


@query
def forecast_weekly_by_product_line(s: Star) -> DataFrame:
    """Weekly trend per subcategory from its complete weeks, eight weeks ahead."""
    weekly = timeseries.history(s.sales, "subcategory", "week", name="week", complete=True)
    return forecast.forecast(weekly, date(2001, 9, 27), "week", "revenue", "subcategory", "week")


@query
def forecast_to_month_end(s: Star) -> DataFrame:
    """A horizon on the last day of a month, which is inside the period that it ends."""
    return forecast.forecast(s.history, date(2001, 9, 30), "month", "revenue", "category")


@query
def forecast_quarters(s: Star) -> DataFrame:
    """Complete quarters, a year ahead with the season of the quarter."""
    quarters = cut_lineage(timeseries.history(s.sales, "category", "quarter", name="quarter", complete=True))
    return forecast.forecast(quarters, date(2002, 6, 30), "quarter", "revenue", "category", "quarter", seasonal=True)


@query
def baseline_forecast(s: Star) -> DataFrame:
    return forecast.baseline_forecast(s.history, RECENT_SINCE, FORECAST_MONTHS)


@query
def growth(s: Star) -> DataFrame:
    result = timeseries.growth(s.sales, FIRST_QUARTER, LAST_QUARTER)
    return _rounded(result, 2, "first_revenue", "last_revenue")


@query
def seasonality_index(s: Star) -> DataFrame:
    return timeseries.seasonality_index(s.sales)


@query
def forecast_anomalies(s: Star) -> DataFrame:
    return forecast.forecast_anomalies(s.forecasts)


@query
def compare_forecasts(s: Star) -> DataFrame:
    return _comparison(s)


@query
def swing_anomalies(s: Star) -> DataFrame:
    return forecast.swing_anomalies(_comparison(s))


@query
def forecast_disagreement(s: Star) -> DataFrame:
    """Categories by the size of the difference between the two forecasts, with their place."""
    ranked = rank_by(cut_lineage(forecast.with_disagreement(_comparison(s))), place="disagreement")
    return ranked.select("category", "disagreement", "place")


@query
def missing_dates(s: Star) -> DataFrame:
    return timeseries.missing_dates(s.sales, "order_date")


# --- Quality ----------------------------------------------------------------------------------

@query
def cancelled_leak(s: Star) -> DataFrame:
    return quality.no_values(s.sales, "order_status", ["CANCELLED"])


@query
def row_parity(s: Star) -> DataFrame:
    kept = filters.exclude_status(s.orders, "CANCELLED").select("order_id")
    return quality.row_parity(s.sales, s.items.join(kept, "order_id"))


@query
def computed_violations(s: Star) -> DataFrame:
    return quality.computed_violations(s.sales)


@query
def reconcile_gold(s: Star) -> DataFrame:
    """Gold revenue against silver, per category."""
    silver_side = s.sales.groupBy("category").agg(F.sum("line_revenue").alias("total_revenue"))
    result = quality.reconcile(gold.build_category_performance(s.sales, s.marketing), silver_side,
                               "category", "total_revenue")
    return _rounded(result, 2, "left_value", "right_value")


@query
def reconcile_daily(s: Star) -> DataFrame:
    """Rounded daily revenue added up, against the category totals."""
    daily = gold.build_daily_revenue(s.sales_by_order).groupBy("category").agg(F.sum("daily_revenue").alias("revenue"))
    totals = gold.sales_totals(s.sales, "category").select(
        "category", money(F.col("total_revenue")).alias("revenue"))
    return quality.reconcile(daily, totals, "category", "revenue")


@query
def reconcile_metric(s: Star) -> DataFrame:
    """Profit of the metric view against the lines."""
    view = sales_metrics(s.sales).query(["Total Profit"], by=["Category"]).toDF("category", "profit")
    lines = s.sales.groupBy("category").agg(F.sum("line_profit").alias("profit"))
    return _rounded(quality.reconcile(view, lines, "category", "profit"), 2, "left_value", "right_value")


@query
def reconcile_planted_gap(s: Star) -> DataFrame:
    """Category revenue against the lines without those of one channel in one category: a gap that must show."""
    totals = s.sales.groupBy("category").agg(money(F.sum("line_revenue")).alias("revenue"))
    hole = (F.col("category") == "PROMO") & (F.col("channel") == "5-LOW")
    without = s.sales.filter(~hole).groupBy("category").agg(money(F.sum("line_revenue")).alias("revenue"))
    return quality.reconcile(totals, without, "category", "revenue")


@query
def profit_identity(s: Star) -> DataFrame:
    return quality.identity_check(s.sales)


@query
def key_checks(s: Star) -> DataFrame:
    """The three joins of the star."""
    return (
        quality.key_checks(s.items, s.orders, "order_id")
        .unionByName(quality.key_checks(s.items, s.products, "product_id"))
        .unionByName(quality.key_checks(s.orders, s.customers, "customer_id"))
    )


@query
def orphan_lines(s: Star) -> DataFrame:
    """Lines checked against the orders of one year only, so that most have no order."""
    year = filters.between_dates(s.orders, "order_date", date(1998, 1, 1), date(1998, 12, 31))
    return quality.key_checks(s.items, year, "order_id")


@query
def table_profile(s: Star) -> DataFrame:
    return quality.profile(s.orders)


@query
def roi_range(s: Star) -> DataFrame:
    return quality.in_range(s.marketing, "campaign_roi", 1.5, 5.0)


@query
def category_coverage(s: Star) -> DataFrame:
    """Categories of the catalogue without a campaign that spent anything; none is missing."""
    return quality.coverage(s.marketing, s.products, "category")


@query
def customers_without_sales(s: Star) -> DataFrame:
    return quality.coverage(s.sales, s.customers, "customer_id")


# --- Decision ---------------------------------------------------------------------------------

def _summary(s: Star, sales: DataFrame) -> DataFrame:
    return decision.category_summary(sales, s.marketing, FIRST_QUARTER, LAST_QUARTER)


def _signals(s: Star) -> DataFrame:
    sales = _daily_totals(s)
    return decision.decision_signals(
        _summary(s, sales), timeseries.seasonality_index(sales),
        _own_forecast(timeseries.monthly_history(sales, complete=True)),
        s.research)


def _internal(s: Star) -> DataFrame:
    sales = _daily_totals(s)
    index = timeseries.seasonality_index(sales).select("category", F.col("q_index").alias("q4_index"))
    figures = _summary(s, sales).select("category", F.col("growth_pct").alias("growth"),
                                        F.col("margin_pct").alias("margin"))
    return figures.join(index, "category")


@query
def category_summary(s: Star) -> DataFrame:
    return _summary(s, s.sales)


@query
def decision_signals(s: Star) -> DataFrame:
    return _signals(s)


@query
def recommend(s: Star) -> DataFrame:
    return decision.recommend(_signals(s))


@query
def market_research(s: Star) -> DataFrame:
    """Internal summary next to the market figures."""
    return decision.with_market_research(_summary(s, s.sales), s.research)


@query
def gen_bad_forecast(s: Star) -> DataFrame:
    """The handed-off forecast with its planted faults, from the recent averages of the given sales."""
    return s.forecasts


@query
def partial_research(s: Star) -> DataFrame:
    """Internal summary next to market figures that lack two categories."""
    known = s.research.filter(~F.col("category").isin("LARGE", "SMALL"))
    return decision.with_market_research(_summary(s, s.sales), known)


@query
def triangulate(s: Star) -> DataFrame:
    return decision.triangulate(_internal(s), s.research)
