import datetime as dt
import itertools
import random
from decimal import Decimal as D
from pathlib import Path

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from shop import Shop

from tallyhouse.operators.states import order_baskets, order_counts
from tallyhouse.plans.lineage import clear_scratch, scratch_path
from tallyhouse.plans.refresh import Schemas, refresh
from tallyhouse.sources.files import list_files, read_csv
from tallyhouse.sources.incremental import (
    changed_rows, extract_since, high_water_mark, latest_per_key, missing_keys, snapshot_changes, upsert)
from tallyhouse.sources.ingest import BronzeStore, ingest_bronze
from tallyhouse.sources.jdbc import jdbc_options
from tallyhouse.sources.merged import MergedTable
from tallyhouse.sources.schemas import MANIFEST, SCHEMAS
from tallyhouse.sources.tables import clear_partitions, load_audit, stored_tables, write_table
from tallyhouse.streaming.file_ingest import ingest_arrivals, rejected

ORDERS = next(e for e in MANIFEST if e.name == "fact_orders")
PRODUCTS = next(e for e in MANIFEST if e.name == "dim_product")
VERSION = "id BIGINT, at INT, what STRING"


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_csv_is_typed_and_empty_fields_are_null(spark, tmp_path):
    path = tmp_path / "p.csv"
    path.write_text(
        "product_id,product_name,category,subcategory,list_price,unit_cost,launch_date,is_active\n"
        "1,Tee,T-Shirts & Tops,,28.00,9.00,2023-04-16,true\n"
        "2,,Headwear,Cap,26.00,,,false\n")
    df = read_csv(spark, str(path), "dim_product")
    assert df.schema == SCHEMAS["dim_product"]
    first, second = sorted(df.collect(), key=lambda r: r.product_id)
    assert first.category == "T-Shirts & Tops" and first.subcategory is None
    assert second.product_name is None and second.unit_cost is None and second.launch_date is None


def test_malformed_csv_fails(spark, tmp_path):
    path = tmp_path / "p.csv"
    path.write_text(",".join(SCHEMAS["dim_product"].names) + "\nx,Tee,a,b,28.00,9.00,2023-04-16,true\n")
    with pytest.raises(Exception):
        read_csv(spark, str(path), "dim_product").collect()


def test_list_files(spark, tmp_path):
    (tmp_path / "a.txt").write_text("12345")
    assert rows(list_files(spark, str(tmp_path))) == [("a.txt", 5)]


def test_jdbc_ranges_follow_the_key_span_and_the_connections():
    few = jdbc_options("jdbc:x", "t", "id", 1, 2_500_000)
    many = jdbc_options("jdbc:x", "t", "id", 1, 10**12)
    assert few["numPartitions"] == "3" and many["numPartitions"] == "64"
    assert few["lowerBound"] == "1" and few["upperBound"] == "2500000"


def test_extract_since_is_strict(spark):
    df = spark.createDataFrame([(1, 5, "a"), (2, 6, "b"), (3, 7, "c")], VERSION)
    assert rows(extract_since(df, "at", 6)) == [(3, 7, "c")]
    assert extract_since(df, "at", None).count() == 3
    assert high_water_mark(df, "at").first()[0] == 7


def test_upsert_keeps_the_newest_and_prefers_the_update_on_ties(spark):
    target = spark.createDataFrame([(1, 5, "old"), (2, 5, "old"), (3, 5, "old"), (4, None, "old")], VERSION)
    batch = spark.createDataFrame(
        [(1, 6, "new"), (1, 7, "newer"), (2, 5, "tie"), (3, 4, "stale"), (4, 1, "dated"), (9, 1, "added")], VERSION)
    once = upsert(target, batch, "id", "at")
    assert rows(once) == [(1, 7, "newer"), (2, 5, "tie"), (3, 5, "old"), (4, 1, "dated"), (9, 1, "added")]
    assert rows(upsert(once, batch, "id", "at")) == rows(once)


versions = st.lists(st.tuples(st.integers(1, 4), st.integers(1, 3), st.sampled_from("abc")), max_size=8)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(versions, versions)
def test_upsert_is_idempotent_and_ignores_row_order(spark, start, batch):
    target = latest_per_key(spark.createDataFrame(start, VERSION), "id", "at")
    shuffled = random.Random(0).sample(batch, len(batch))
    once = upsert(target, spark.createDataFrame(batch, VERSION), "id", "at")
    again = upsert(once, spark.createDataFrame(batch, VERSION), "id", "at")
    other = upsert(target, spark.createDataFrame(shuffled, VERSION), "id", "at")
    assert rows(once) == rows(again) == rows(other)
    expected = {}
    for is_update, (key, at, what) in itertools.chain(
            zip(itertools.repeat(0), map(tuple, target.collect())), zip(itertools.repeat(1), batch)):
        best = expected.get(key)
        if best is None or (at, is_update, what) >= best:
            expected[key] = (at, is_update, what)
    assert rows(once) == sorted(((k, v[0], v[2]) for k, v in expected.items()), key=repr)


def test_the_newest_versions_are_shuffled_once_and_leave_by_their_key(spark, capsys):
    data = [(1, 1, "a"), (1, 2, "b"), (1, 2, None), (None, None, "n"), (None, None, "m"), (2, None, "x"), (2, 1, None)]
    newest = latest_per_key(spark.createDataFrame(data, VERSION), "id", "at")
    assert rows(newest) == [(1, 2, "b"), (2, 1, None), (None, None, "n")]
    keys = latest_per_key(spark.createDataFrame(data, VERSION).select("id"), "id", "id")
    assert rows(keys) == [(1,), (2,), (None,)]
    capsys.readouterr()
    newest.groupBy("id").count().explain()
    assert capsys.readouterr().out.count("hashpartitioning") == 1


def order(i, day, status="COMPLETED", at="10:00:00"):
    return (i, 1, day, dt.datetime.fromisoformat(f"{day} {at}"), "Web", status, None)


def test_ingest_appends_only_new_rows_and_reads_the_newest(spark, tmp_path):
    store = BronzeStore(spark, str(tmp_path / "bronze"))
    day = dt.date(2024, 1, 5)

    def source(*data):
        return lambda name: spark.createDataFrame(list(data), SCHEMAS[name])

    first = source(order(1, day), order(2, day))
    ingest_bronze(store, first, [ORDERS])
    ingest_bronze(store, first, [ORDERS])
    assert store.current(ORDERS).count() == 2
    assert spark.read.parquet(store.log_path("fact_orders")).count() == 2
    later = source(order(1, day), order(2, day, "CANCELLED", "11:00:00"), order(3, day, at="12:00:00"))
    ingest_bronze(store, later, [ORDERS])
    assert spark.read.parquet(store.log_path("fact_orders")).count() == 4
    state = {r.order_id: r.order_status for r in store.current(ORDERS).collect()}
    assert state == {1: "COMPLETED", 2: "CANCELLED", 3: "COMPLETED"}


def test_repeated_batch_changes_nothing(spark, tmp_path):
    store = BronzeStore(spark, str(tmp_path / "bronze"))
    df = spark.createDataFrame([order(1, dt.date(2024, 1, 5))], SCHEMAS["fact_orders"])
    store.append(df, ORDERS, 0)
    store.append(df, ORDERS, 0)
    store.append(df, ORDERS, 1)
    assert store.current(ORDERS).count() == 1


def test_streamed_files_arrive_once(spark, tmp_path):
    store = BronzeStore(spark, str(tmp_path / "bronze"))
    inbox, marks = tmp_path / "in", str(tmp_path / "marks")
    inbox.mkdir()
    header = ",".join(SCHEMAS["dim_product"].names) + "\n"
    (inbox / "1.csv").write_text(header + "1,Tee,Tops,T,28.00,9.00,2023-04-16,true\n")
    ingest_arrivals(store, PRODUCTS, str(inbox), marks).awaitTermination()
    (inbox / "2.csv").write_text(header + "1,Tee v2,Tops,T,29.00,9.00,2023-04-16,true\n2,Cap,Head,C,26.00,9.00,,\n")
    ingest_arrivals(store, PRODUCTS, str(inbox), marks).awaitTermination()
    ingest_arrivals(store, PRODUCTS, str(inbox), marks).awaitTermination()
    assert spark.read.parquet(store.log_path("dim_product")).count() == 3
    names = {r.product_id: r.product_name for r in store.current(PRODUCTS).collect()}
    assert names == {1: "Tee v2", 2: "Cap"}


def test_stream_and_extract_do_not_overwrite_each_other(spark, tmp_path):
    store = BronzeStore(spark, str(tmp_path / "bronze"))
    inbox = tmp_path / "in"
    inbox.mkdir()
    (inbox / "1.csv").write_text(",".join(SCHEMAS["dim_product"].names) + "\n9,Mug,Drinkware,M,16.00,5.00,,true\n")
    ingest_arrivals(store, PRODUCTS, str(inbox), str(tmp_path / "marks")).awaitTermination()
    one = spark.createDataFrame([(1, "Tee", "Tops", "T", None, None, None, True)], SCHEMAS["dim_product"])
    ingest_bronze(store, lambda name: one, [PRODUCTS])
    assert sorted(r.product_id for r in store.current(PRODUCTS).collect()) == [1, 9]


def test_load_audit_reports_missing_tables(spark):
    write_table(spark.range(5).toDF("id"), "audit_me", "five rows")
    audit = load_audit(stored_tables(spark, ["audit_me", "not_there"]), spark)
    assert rows(audit) == [("TOTAL", 5, "TOTAL"), ("audit_me", 5, "LOADED"), ("not_there", None, "MISSING")]


def test_rows_that_come_late_or_change_are_ingested(spark, tmp_path):
    store = BronzeStore(spark, str(tmp_path / "bronze"))
    day, entries = dt.date(2024, 1, 5), [ORDERS, PRODUCTS]

    def source(orders, products):
        frames = {"fact_orders": spark.createDataFrame(orders, SCHEMAS["fact_orders"]),
                  "dim_product": spark.createDataFrame(products, SCHEMAS["dim_product"])}
        return frames.__getitem__

    def product(i, name):
        return (i, name, None, None, None, None, None, None)

    ingest_bronze(store, source([order(2, day)], [product(2, "Tee")]), entries)
    later = source([order(2, day), order(1, day, at="09:00:00")], [product(2, "Tee v2"), product(1, "Cap")])
    ingest_bronze(store, later, entries)
    assert {r.product_id: r.product_name for r in store.current(PRODUCTS).collect()} == {1: "Cap", 2: "Tee v2"}
    assert [r.order_id for r in store.current(ORDERS).collect()] == [2]
    for _ in range(2):
        ingest_bronze(store, later, entries, overlap=dt.timedelta(hours=2))
    assert sorted(r.order_id for r in store.current(ORDERS).collect()) == [1, 2]
    assert spark.read.parquet(store.log_path("fact_orders")).count() == 2
    assert store.next_batch(ORDERS) == 2 and store.next_batch(PRODUCTS) == 2


def test_upsert_of_a_null_key_can_be_repeated(spark):
    target = spark.createDataFrame([(None, 1, "a"), (1, 1, "a")], VERSION)
    batch = spark.createDataFrame([(None, 2, "b")], VERSION)
    once = upsert(target, batch, "id", "at")
    assert rows(once) == rows(upsert(once, batch, "id", "at")) == rows(
        spark.createDataFrame([(None, 2, "b"), (1, 1, "a")], VERSION))


def test_changed_rows_tells_nulls_apart(spark):
    known = spark.createDataFrame([(1, None, "x"), (2, 5, None), (None, 1, "n")], VERSION)
    now = spark.createDataFrame([(1, None, "x"), (2, None, "x"), (None, 1, "n"), (3, 1, "n")], VERSION)
    assert rows(changed_rows(now, known, "id")) == [(2, None, "x"), (3, 1, "n")]


def test_scratch_is_below_the_shared_folder_and_goes(spark, tmp_path):
    path = scratch_path(spark, "here")
    assert path.startswith(spark.conf.get("spark.checkpoint.dir"))
    spark.range(3).write.parquet(path)
    clear_scratch(spark)
    assert not Path(path.removeprefix("file:")).exists()


def test_merge_writes_only_the_buckets_it_meets(spark, tmp_path):
    table = MergedTable(spark, str(tmp_path / "merged"), "id", "at", buckets=8)
    start = spark.range(100).selectExpr("id", "5 as at", "'old' as what")
    assert table.merge(start) == list(range(8)) and table.read().count() == 100
    before = table.folders()
    batch = spark.createDataFrame([(7, 6, "new"), (7, 7, "newer"), (500, 1, "added"), (None, 1, "no key")], VERSION)
    met = table.merge(batch)
    after = table.folders()
    assert 0 < len(met) <= 3 and {b for b in after if after[b] != before.get(b)} == set(met)
    expected = rows(upsert(start, batch, "id", "at"))
    assert rows(table.read()) == expected and len(expected) == 102
    assert rows(table.find(7)) == [(7, 7, "newer")] and rows(table.find(-1)) == []
    for replay in (batch, batch.filter("at = 6"), batch.limit(0)):
        table.merge(replay)
        assert rows(table.read()) == expected
    table.vacuum()
    assert rows(table.read()) == expected
    assert not any((tmp_path / "merged" / folder).exists() for b, folder in before.items() if b in met)


def test_a_merge_without_manifest_is_not_seen(spark, tmp_path):
    table = MergedTable(spark, str(tmp_path / "merged"), "id", "at", buckets=2)
    assert table.version() == -1 and table.folders() == {}
    table.merge(spark.createDataFrame([(1, 1, "a")], VERSION))
    (bucket, folder), = table.folders().items()
    stale = tmp_path / "merged" / f"data/version=1/_bucket={bucket}"
    spark.createDataFrame([(1, 9, "died")], VERSION).write.parquet(str(stale))
    assert rows(table.read()) == [(1, 1, "a")]
    table.merge(spark.createDataFrame([(2, 1, "b"), (1, 2, "c")], VERSION))
    assert rows(table.read()) == [(1, 2, "c"), (2, 1, "b")]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(versions, versions)
def test_merges_equal_upserts(spark, tmp_path_factory, first, second):
    table = MergedTable(spark, str(tmp_path_factory.mktemp("merged")), "id", "at", buckets=3)
    frames = [spark.createDataFrame(data, VERSION) for data in (first, second)]
    for df in frames:
        table.merge(df)
    expected = rows(upsert(latest_per_key(frames[0], "id", "at"), frames[1], "id", "at"))
    assert (rows(table.read()) if table.folders() else []) == expected


def test_snapshot_changes_are_rows_and_tombstones(spark):
    known = spark.createDataFrame([(1, None, "x"), (2, 5, None), (None, 1, "n"), (4, 4, "gone")], VERSION)
    now = spark.createDataFrame([(1, None, "x"), (2, None, "x"), (None, 1, "n"), (3, 1, "n")], VERSION)
    assert rows(snapshot_changes(now, known, "id", "at")) == [
        (2, None, "x", False), (3, 1, "n", False), (4, 4, None, True)]
    assert rows(snapshot_changes(now.filter("id is not null"), known, "id", "id")) == [
        (2, None, "x", False), (3, 1, "n", False), (4, None, None, True), (None, None, None, True)]
    assert rows(missing_keys(known, now, "id", "at")) == [(4, 4, None, True)]


def test_deleted_rows_go_and_may_come_back(spark, tmp_path):
    store = BronzeStore(spark, str(tmp_path / "bronze"))
    day, entries = dt.date(2024, 1, 5), [ORDERS, PRODUCTS]

    def run(orders, products, deletions=True):
        frames = {"fact_orders": spark.createDataFrame(orders, SCHEMAS["fact_orders"]),
                  "dim_product": spark.createDataFrame([(i, "Tee", *[None] * 6) for i in products], SCHEMAS["dim_product"])}
        ingest_bronze(store, frames.__getitem__, entries, deletions=deletions)
        return [sorted(r[0] for r in store.current(e).collect()) for e in entries]

    first, second, third = order(1, day), order(2, day), order(3, day, at="11:00:00")
    assert run([first, second], [1, 2, 3]) == [[1, 2], [1, 2, 3]]
    assert run([second], [1, 3], deletions=False) == [[1, 2], [1, 2, 3]]
    assert run([second, third], [1, 3]) == [[2, 3], [1, 3]]
    batches = [store.next_batch(e) for e in entries]
    assert run([second, third], [1, 3]) == [[2, 3], [1, 3]] and [store.next_batch(e) for e in entries] == batches
    for entry in entries:
        store.compact(entry)
    assert run([second, third], [2, 3]) == [[2, 3], [2, 3]]
    assert run([order(1, day, at="12:00:00"), second, third], [2, 3]) == [[1, 2, 3], [2, 3]]


def test_rows_of_a_file_are_not_missed_in_an_extract(spark, tmp_path):
    store = BronzeStore(spark, str(tmp_path / "bronze"))
    frame = lambda ids: spark.createDataFrame([(i, "Tee", *[None] * 6) for i in ids], SCHEMAS["dim_product"])
    store.append(frame([9]), PRODUCTS, 0, "files")
    for ids in ([1, 2], [2]):
        ingest_bronze(store, lambda name, ids=ids: frame(ids), [PRODUCTS], deletions=True)
    assert sorted(r.product_id for r in store.current(PRODUCTS).collect()) == [2, 9]


def test_compaction_changes_no_row_and_reads_fewer_files(spark, tmp_path):
    store = BronzeStore(spark, str(tmp_path / "bronze"))
    day = dt.date(2024, 1, 5)
    store.compact(ORDERS)
    for hour in range(10, 16):
        data = spark.createDataFrame([order(i, day, at=f"{hour}:00:00") for i in (1, 2, hour)], SCHEMAS["fact_orders"])
        ingest_bronze(store, lambda name, data=data: data, [ORDERS])
    store.append(spark.createDataFrame([order(99, day)], SCHEMAS["fact_orders"]), ORDERS, 0, "files")
    before, n_files = rows(store.current(ORDERS)), len(store.log(ORDERS).inputFiles())
    assert len(before) == 9
    store.compact(ORDERS)
    assert rows(store.current(ORDERS)) == before and len(store.log(ORDERS).inputFiles()) < n_files
    assert store.log(ORDERS).count() == 9
    late = spark.createDataFrame([order(1, day, "CANCELLED", "09:00:00"), order(3, day, at="17:00:00")], SCHEMAS["fact_orders"])
    store.append(late, ORDERS, store.next_batch(ORDERS))
    after = {r.order_id: r.order_status for r in store.current(ORDERS).collect()}
    assert after[1] == "COMPLETED" and 3 in after and len(after) == 10
    store.compact(ORDERS)
    assert {r.order_id: r.order_status for r in store.current(ORDERS).collect()} == after
    # A snapshot whose pointer was never written is not read.
    spark.createDataFrame([order(1, day, "LOST", "23:00:00")], SCHEMAS["fact_orders"]).write.parquet(
        f"{store.root}/_snapshots/fact_orders/snapshot=2")
    assert {r.order_id: r.order_status for r in store.current(ORDERS).collect()} == after


def test_malformed_lines_go_to_the_rejects(spark, tmp_path):
    store = BronzeStore(spark, str(tmp_path / "bronze"))
    inbox, marks = tmp_path / "in", str(tmp_path / "marks")
    inbox.mkdir()
    header = ",".join(SCHEMAS["dim_product"].names) + "\n"
    good, bad = "1,Tee,Tops,T,28.00,9.00,2023-04-16,true\n", "x,Tee,Tops,T,28.00,9.00,2023-04-16,true\n"
    wrong = "2,Cap,Head,C,26.00,9.00,2023-04-16,perhaps\n"
    (inbox / "1.csv").write_text(header + good + bad)
    ingest_arrivals(store, PRODUCTS, str(inbox), marks).awaitTermination()
    (inbox / "2.csv").write_text(header + good)
    (inbox / "3.csv").write_text(header + wrong + "3,Mug,,,,,,\n")
    ingest_arrivals(store, PRODUCTS, str(inbox), marks).awaitTermination()
    assert rows(store.current(PRODUCTS).select("product_id", "product_name")) == [(1, "Tee"), (3, "Mug")]
    assert rows(rejected(store, PRODUCTS)) == [(wrong.strip(), "3.csv"), (bad.strip(), "1.csv")]


def test_refresh_is_idempotent_and_replaces_only_late_months(spark):
    shop = Shop(spark)
    later = spark.createDataFrame(
        [(20 + m, 1, dt.date(2024, m, 9), None, "Web", "COMPLETED", None) for m in (2, 3, 4)], SCHEMAS["fact_orders"])
    sold = spark.createDataFrame(
        [(200 + m, 20 + m, 1 + m % 2, m, D("20.00"), D("0.00")) for m in (2, 3, 4)], SCHEMAS["fact_order_items"])
    bronze = {"dim_product": shop.products, "fact_orders": shop.orders.unionByName(later),
              "fact_order_items": shop.items.unionByName(sold), "fact_marketing_campaigns": shop.campaigns}
    schemas = Schemas("t_silver", "t_gold")
    tables = ("t_silver.sales", "t_silver.marketing", "t_gold.daily_revenue", "t_gold.category_performance")

    def state():
        return {t: (spark.table(t).count(), spark.table(t).agg(F.sum(F.xxhash64("*").cast("decimal(38,0)"))).first()[0])
                for t in tables}

    refresh(spark, bronze, schemas)
    full = state()
    refresh(spark, bronze, schemas, since=dt.date(2024, 3, 20))
    assert state() == full and full["t_silver.sales"][0] == 7
    april = F.col("order_date") >= dt.date(2024, 4, 1)
    changed = dict(bronze, fact_orders=bronze["fact_orders"].withColumn(
        "order_status", F.when(april, "CANCELLED").otherwise(F.col("order_status"))))
    refresh(spark, changed, schemas, since=dt.date(2024, 4, 1))
    assert spark.table("t_silver.sales").filter(april).count() == 0
    assert spark.table("t_gold.daily_revenue").filter(april).count() == 0
    assert spark.table("t_silver.sales").count() == 6
    # Gold comes from stored parts: a refresh of later months does not look at silver rows of earlier ones.
    performance, daily = (rows(spark.table(f"t_gold.{t}")) for t in ("category_performance", "daily_revenue"))
    clear_partitions(spark, "t_silver.sales", "order_month", [dt.date(2024, 1, 1)])
    assert spark.table("t_silver.sales").count() < 6
    refresh(spark, changed, schemas, since=dt.date(2024, 3, 1))
    assert rows(spark.table("t_gold.category_performance")) == performance
    assert rows(spark.table("t_gold.daily_revenue")) == daily


def test_refresh_may_empty_all_months_in_reach(spark):
    shop = Shop(spark)
    bronze = {"dim_product": shop.products, "fact_orders": shop.orders, "fact_order_items": shop.items,
              "fact_marketing_campaigns": shop.campaigns}
    schemas = Schemas("e_silver", "e_gold")
    refresh(spark, bronze, schemas)
    assert spark.table("e_gold.category_performance").count() > 0
    refresh(spark, dict(bronze, fact_orders=shop.orders.limit(0)), schemas, since=dt.date(2023, 1, 1))
    assert spark.table("e_silver.sales").count() == spark.table("e_gold.category_performance").count() == 0


def test_distinct_orders_add_up_from_baskets(spark):
    day, other = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    lines = [(1, day, "A"), (1, day, "A"), (1, day, "B"), (2, day, "B"), (3, day, None), (3, day, "A"), (4, other, "A")]
    baskets = order_baskets(spark.createDataFrame(lines, "order_id INT, order_date DATE, category STRING"))
    assert baskets.agg(F.sum("orders")).first()[0] == 4
    found = {(r.grain, r.period, r.category): r.orders for r in order_counts(baskets).collect()}
    assert found == {
        ("day and category", day, "A"): 2, ("day and category", day, "B"): 2, ("day and category", day, None): 1,
        ("day and category", other, "A"): 1, ("month and category", day, "A"): 3, ("month and category", day, "B"): 2,
        ("month and category", day, None): 1, ("category", None, "A"): 3, ("category", None, "B"): 2,
        ("category", None, None): 1, ("total", None, None): 4}
