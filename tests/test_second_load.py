"""Loads onto a filled warehouse: what is compared, rewritten, numbered and refused."""

from __future__ import annotations

import shutil
import threading
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from saleswh import schema
from saleswh.operators import files
from saleswh.operators.key_index import KeyIndex
from saleswh.operators.steps import run_steps
from saleswh.operators.tables import VersionedTable
from saleswh.plans import fact, metrics, sql
from saleswh.plans.pipeline import StaleTableError, Warehouse
from saleswh.plans.quality import QualityError
from tests import builders as b
from tests.conftest import rows
from tests.test_pipeline import AS_OF, CUSTOMERS, PRODUCTS

MONTHS = [f"2024-0{1 + n % 4}-{10 + n % 15} {n % 24:02}:00:00" for n in range(40)]


def _sources(spark, moved=(), only=None, quoted=None, customers=CUSTOMERS, items_of=40):
    """Forty orders of two items each over four months."""
    orders = [
        (n, 1 + n % 2, "2024-05-07 08:00:00" if n in moved else MONTHS[n % 40], ["EUR", "USD", "GBP"][n % 3])
        for n in range(items_of)
        if only is None or n in only
    ]
    items = [(10 * n + k, n, 1 + n % 2, 1 + k, Decimal("2.00")) for n in range(items_of) for k in range(2)]
    return b.sources(spark, orders, items, PRODUCTS, customers, quoted)


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("loaded")
    Warehouse(spark, str(root)).run(_sources(spark), AS_OF, loaded_at=datetime(2024, 6, 1))
    return root


@pytest.fixture
def warehouse(spark, loaded, tmp_path):
    """A copy of the loaded warehouse: pointer files name folders relative to their table."""
    shutil.copytree(loaded, tmp_path, dirs_exist_ok=True)
    return Warehouse(spark, str(tmp_path))


def _folders(warehouse):
    return {table.path: table.folders() for table in warehouse.tables}


def _facts(warehouse):
    return {row["order_item_id"]: row for row in warehouse.fact.read().collect()}


def _hourly(warehouse):
    return rows(warehouse.hourly_sales.read())


def _rebuilt(warehouse):
    star = warehouse.star()
    return rows(fact.hourly_sales(star.fact, star.dim_date, star.dim_time).select(*schema.HOURLY_SALES.fieldNames()))


def test_a_load_without_changes_writes_no_table(spark, warehouse, tmp_path):
    before = _folders(warehouse)
    found = {str(path) for path in tmp_path.rglob("*")}
    warehouse.run(_sources(spark), AS_OF, loaded_at=datetime(2024, 6, 2))
    assert _folders(warehouse) == before
    assert {str(path) for path in tmp_path.rglob("*")} == found


def test_only_months_that_change_are_rewritten(spark, warehouse):
    before, folders = _facts(warehouse), warehouse.fact.folders()
    moved = 2  # from March to May
    warehouse.run(_sources(spark, moved=[moved], only=[moved, 6]), AS_OF, loaded_at=datetime(2024, 6, 2))
    after = _facts(warehouse)
    assert {n for n in after if after[n] != before[n]} == {20, 21}
    assert after[20]["date_key"] == 20240507 and after[20]["sales_item_sk"] == before[20]["sales_item_sk"]
    assert after[20]["created_at"] == datetime(2024, 6, 1)
    kept = {f for f in folders if not f.endswith("202403")}
    assert kept < set(warehouse.fact.folders())
    assert {f.split("=")[-1] for f in set(warehouse.fact.folders()) - kept} == {"202403", "202405"}
    assert _hourly(warehouse) == _rebuilt(warehouse)
    hourly = warehouse.hourly_sales.folders()
    assert sum(f.startswith("version=1/") for f in hourly) == 3 and sum(f.startswith("version=2/") for f in hourly) == 2


def test_an_item_moves_on_from_where_the_load_before_put_it(spark, warehouse):
    for n, moved in enumerate(([3], [7])):
        warehouse.run(_sources(spark, moved=moved), AS_OF, loaded_at=datetime(2024, 6, 2 + n))
        found = _facts(warehouse)
        assert len(found) == warehouse.fact.read().count() == 80
        assert {n // 10 for n, row in found.items() if row["sales_month"] == 202405} == set(moved)
        assert _hourly(warehouse) == _rebuilt(warehouse)


def test_numbers_are_dense_and_stay(spark, warehouse):
    first = _facts(warehouse)
    assert [first[n]["sales_item_sk"] for n in sorted(first)] == list(range(1, 81))
    warehouse.run(_sources(spark, items_of=45, quoted={"EUR": 0.5, "GBP": 0.5}), AS_OF)
    second = _facts(warehouse)
    assert {n: row["sales_item_sk"] for n, row in second.items() if n in first} == {
        n: row["sales_item_sk"] for n, row in first.items()
    }
    assert sorted(row["sales_item_sk"] for row in second.values()) == list(range(1, len(second) + 1))
    for table, key in ((warehouse.dim_customer, "customer_sk"), (warehouse.dim_product, "product_sk")):
        assert sorted(row[key] for row in table.read().collect()) == [1, 2] and table.highest() == 2


def test_a_failed_load_leaves_facts_and_index_together(spark, warehouse, monkeypatch):
    before, notes = _facts(warehouse), warehouse.fact.notes()
    real = fact.merge_rows

    def broken(target, updates, keys, kept=()):
        merged = real(target, updates, keys, kept)
        if "sales_item_sk" in merged.columns:
            merged = merged.withColumn("currency", F.raise_error(F.lit("lost")).cast("string"))
        return merged

    monkeypatch.setattr(fact, "merge_rows", broken)
    with pytest.raises(Exception, match="lost"):
        warehouse.run(_sources(spark, moved=[1]), AS_OF)
    assert _facts(warehouse) == before and warehouse.fact.notes() == notes
    monkeypatch.undo()
    warehouse.run(_sources(spark, moved=[1]), AS_OF)
    assert _facts(warehouse)[10]["sales_month"] == 202405 and warehouse.fact.read().count() == 80


def test_a_fact_without_an_index_gets_one(spark, warehouse):
    warehouse.fact._point_to(warehouse.fact.folders(), warehouse.fact.highest(), {}, warehouse.fact.change())
    folders = warehouse.fact.folders()
    warehouse.run(_sources(spark), AS_OF)
    assert warehouse.fact.folders() == folders
    warehouse.run(_sources(spark, moved=[1]), AS_OF)
    assert "index" in warehouse.fact.notes() and warehouse.fact.read().count() == 80


def test_a_refresh_that_failed_is_made_up_for(spark, warehouse, monkeypatch):
    def fails(*_, **__):
        raise fact_error

    from pyspark.errors import PySparkException

    fact_error = PySparkException("no")
    monkeypatch.setattr(fact, "refresh_hourly", fails)
    assert warehouse.run(_sources(spark, moved=[1]), AS_OF)[0].startswith("hourly sales not refreshed")
    monkeypatch.undo()
    assert _hourly(warehouse) != _rebuilt(warehouse)
    warehouse.run(_sources(spark, moved=[1, 2]), AS_OF)
    assert _hourly(warehouse) == _rebuilt(warehouse)


def test_hours_behind_the_facts_are_no_result(spark, warehouse, monkeypatch):
    from pyspark.errors import PySparkException

    from saleswh.queries import registry

    held = {(spark.sparkContext.applicationId, "here", kind): (warehouse, warehouse.star()) for kind in ("twice", "events")}
    monkeypatch.setattr(registry, "_warehouses", held)
    queries = [registry.QUERIES[name] for name in ("hourly_second_load", "hourly_sales")]
    for query in queries:
        assert query(spark, "here").count() == warehouse.hourly_sales.read().count()

    def fails(*_, **__):
        raise PySparkException("no room")

    with monkeypatch.context() as patched:
        patched.setattr(fact, "refresh_hourly", fails)
        warehouse.run(_sources(spark, moved=[1]), AS_OF)
    for query in queries:
        with pytest.raises(StaleTableError, match="no room"):
            query(spark, "here")
    with pytest.raises(StaleTableError):
        Warehouse(spark, warehouse.root).current_hourly_sales()
    warehouse.run(_sources(spark, moved=[1]), AS_OF)
    assert rows(warehouse.current_hourly_sales()) == _rebuilt(warehouse)


def test_old_versions_go_and_the_rest_still_loads(spark, warehouse, tmp_path):
    warehouse.run(_sources(spark, moved=[1]), AS_OF)
    before = _facts(warehouse)
    index = len(list((tmp_path / "fact_sales_item" / "key_index").glob("version=*/slab=*")))
    warehouse.remove_old_versions()
    assert len(list((tmp_path / "fact_sales_item" / "key_index").glob("version=*/slab=*"))) < index
    assert _facts(warehouse) == before
    warehouse.run(_sources(spark, moved=[1, 2]), AS_OF)
    assert _facts(warehouse)[20]["sales_month"] == 202405


# The index


def _entries(spark, *triples):
    return spark.createDataFrame(list(triples), "order_item_id long, stored_day int, stored_print long")


def test_index_reads_and_replaces_whole_slabs(spark, tmp_path):
    index = KeyIndex(spark, str(tmp_path), "order_item_id", slabs=4, buckets=2)
    far = 1 << 16
    state = index.write(_entries(spark, *((n * far, n, n) for n in range(40))), None)
    assert set(state["folders"]) == {"0", "1", "2", "3"}
    near = _entries(spark, (0, 0, 0), (5, 0, 0))
    slabs = index.slabs_of(near, state)
    assert len(slabs) == 1
    with index.opened(state, slabs) as known:
        held = rows(known)
        assert (0, 0, 0) in held and 0 < len(held) < 40
        assert len(known.inputFiles()) <= 2
    later = index.write(_entries(spark, (0, 7, 7)), state)
    assert [later["folders"][k] != state["folders"][k] for k in sorted(state["folders"])].count(True) == 1
    with index.opened(later, [0, 1, 2, 3]) as known:
        assert known.count() == 40 - len(held) + 1
    with index.opened(state, [0, 1, 2, 3]) as known:
        assert known.count() == 40


def test_the_compare_reads_no_fact_and_shuffles_only_the_batch(spark, warehouse, monkeypatch):
    plans = []
    real = fact.stored

    def seen(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df)

    monkeypatch.setattr(fact, "stored", seen)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        batch = warehouse.fact.read().filter("order_item_id < 50").drop("sales_item_sk", "created_at", "sales_month")
        path = f"{warehouse.root}-batch"
        batch.write.parquet(path)
        assert fact.upsert_fact(warehouse.fact, spark.read.parquet(path), datetime(2024, 6, 3)) == []
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        files.delete(spark, f"{warehouse.root}-batch")
    (plan,) = plans
    stored_side = plan[plan.index("Bucketed: true") - 400 :]
    assert "fact_sales_item/version" not in plan and "line_amount_usd" not in stored_side.split("FileScan")[-1]
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan


# Refusals


def test_refused_rows_are_kept_with_their_reasons(spark, warehouse):
    before = warehouse.fact.folders()
    good = _sources(spark)
    orders = good.orders.withColumn("customer_id", F.when(F.col("order_id") != 3, F.col("customer_id"))).withColumn(
        "currency", F.when(F.col("order_id") == 4, "EURO").otherwise(F.col("currency"))
    )
    late = F.when(F.col("order_id") == 4, F.lit("1999-01-01").cast("timestamp_ntz")).otherwise(F.col("order_date"))
    bad = type(good)(**{**vars(good), "orders": orders.withColumn("order_date", late)})
    with pytest.raises(QualityError, match=r"customer_id is missing \(2 rows\); currency has more"):
        warehouse.load_fact(bad, datetime(2024, 6, 3))
    assert warehouse.fact.folders() == before
    refused = {row["order_item_id"]: row for row in warehouse.refused.read().collect()}
    assert sorted(refused) == [30, 31, 40, 41]
    assert refused[30]["broken"] == ["customer_id is missing"]
    assert refused[40]["broken"] == ["currency has more than three characters", "date_key is not in the calendar"]
    assert refused[30]["refused_at"] == datetime(2024, 6, 3)


def test_the_staged_rows_are_checked_while_they_are_written(spark, warehouse, monkeypatch):
    """Between the write and the compare no job looks at the staged rows."""
    from saleswh.plans import quality

    def never(*_):
        raise AssertionError("a second look")

    monkeypatch.setattr(quality, "refusals", never)
    monkeypatch.setattr(quality, "assert_loadable", never)
    before, days = warehouse.load_fact(_sources(spark, moved=[5]), datetime(2024, 6, 3))
    assert before == 1 and days == [int(MONTHS[5][:10].replace("-", "")), 20240507]


# Steps and views


def test_steps_overlap_and_wait_for_what_they_need(spark):
    meet = threading.Barrier(2, timeout=20)
    order = []
    done = run_steps(
        spark,
        {
            "c": (["a", "b"], lambda: order.append("c") or spark.range(3).count()),
            "a": ([], lambda: meet.wait() is not None and order.append("a")),
            "b": ([], lambda: meet.wait() is not None and order.append("b")),
        },
    )
    assert order[-1] == "c" and done["c"] == 3


def test_the_first_error_stops_the_other_steps(spark):
    ran = []

    def slow():
        spark.range(0, 10**13, 1, 2).agg(F.max(F.xxhash64("id"))).collect()

    def fails():
        spark.range(1).count()
        raise ValueError("first")

    with pytest.raises(ValueError, match="first"):
        run_steps(spark, {"slow": ([], slow), "bad": ([], fails), "after": (["slow", "bad"], lambda: ran.append(1))})
    assert ran == []
    with pytest.raises(ValueError, match="never"):
        run_steps(spark, {"x": (["y"], lambda: None)})


def test_sql_reports_on_two_warehouses_side_by_side(spark, warehouse, tmp_path_factory):
    other = Warehouse(spark, str(tmp_path_factory.mktemp("other")))
    other.run(_sources(spark, only=range(10)), AS_OF)
    stars = {0: warehouse.star(), 1: other.star()}
    wanted = {n: rows(metrics.category_performance(star)) for n, star in stars.items()}
    assert wanted[0] != wanted[1]
    found = {}

    def report(n):
        found[n] = [rows(sql.run_report_sql(stars[n % 2], sql.CATEGORY_PERFORMANCE)) for _ in range(3)]

    threads = [threading.Thread(target=report, args=(n,)) for n in range(4)]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert found == {n: [wanted[n % 2]] * 3 for n in range(4)}


def test_a_failed_export_leaves_the_old_one(spark, warehouse, tmp_path, monkeypatch):
    from saleswh.plans import export

    out = tmp_path / "csv"
    star = warehouse.star()
    names = export.export_reports(star, str(out))
    (out / "left_over").mkdir()
    good = export.reports

    def one_fails(*args):
        found = good(*args)
        bad = found[3].data.withColumn("revenue", F.raise_error(F.lit("lost")).cast("string"))
        return [*found[:3], export.Report("bad", bad)]

    monkeypatch.setattr(export, "reports", one_fails)
    with pytest.raises(Exception, match="lost"):
        export.export_reports(star, str(out))
    assert sorted(p.name for p in out.iterdir()) == sorted([*names, "left_over"])
    monkeypatch.undo()
    assert export.export_reports(star, str(out)) == names
    assert sorted(p.name for p in out.iterdir()) == sorted(names)
    assert [p.name for p in tmp_path.iterdir() if p.name.startswith("csv")] == ["csv"]


def test_table_state_keeps_notes(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), schema.DIM_TIME).create_if_absent()
    minute = spark.sql("SELECT 1S AS time_key, 0S AS hour, 1S AS minute")
    table.replace(minute, notes={"a": 1})
    table.append(minute)
    assert table.notes() == {"a": 1} and table.change() == 2 and table.read().count() == 2


# Facts in buckets


@pytest.fixture
def bucketed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(fact, "buckets_for", lambda table, items: table.buckets() or 4)
    warehouse = Warehouse(spark, str(tmp_path / "bucketed"))
    warehouse.run(_sources(spark), AS_OF, loaded_at=datetime(2024, 6, 1))
    return warehouse


def test_facts_in_buckets_are_those_without(spark, warehouse, bucketed):
    assert bucketed.fact.buckets() == 4 and warehouse.fact.buckets() == 1
    assert _facts(bucketed) == _facts(warehouse) and _hourly(bucketed) == _hourly(warehouse)
    for n, changed in enumerate(({"moved": [2, 9]}, {"moved": [2], "items_of": 45}, {"quoted": {"EUR": 0.5, "GBP": 0.5}}, {})):
        for one in (warehouse, bucketed):
            one.run(_sources(spark, **changed), AS_OF, loaded_at=datetime(2024, 6, 2 + n))
        assert _facts(bucketed) == _facts(warehouse) and _hourly(bucketed) == _hourly(warehouse)
        assert bucketed.fact.read().count() == len(_facts(bucketed))
    assert bucketed.fact.buckets() == 4
    bucketed.remove_old_versions()
    assert _facts(bucketed) == _facts(warehouse)


def test_stored_facts_are_rewritten_without_a_shuffle(spark, bucketed, monkeypatch):
    plans = []
    real = VersionedTable.replace

    def seen(table, df, *rest, **named):
        if table is bucketed.fact:
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real(table, df, *rest, **named)

    monkeypatch.setattr(VersionedTable, "replace", seen)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        bucketed.run(_sources(spark, moved=[1, 5], items_of=45), AS_OF)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    (plan,) = plans
    shuffled = [line for line in plan.splitlines() if "Exchange" in line]
    assert shuffled and all("hashpartitioning(order_item_id" in line for line in shuffled)
    # Only keys and numbers meet a shuffle; neither the stored facts nor the batch do.
    for part in plan.split("Exchange")[1:]:
        assert "Bucketed: true" not in part.split("FileScan")[0] and "Scan ExistingRDD" in part.split("FileScan")[0]
    assert plan.count("Bucketed: true") == 2
    months = {f.split("/")[-1] for f in bucketed.fact.folders()}
    assert len(months) == 5


def test_a_bucketed_load_with_broken_rows_is_refused(spark, bucketed):
    before = bucketed.fact.folders()
    good = _sources(spark)
    orders = good.orders.withColumn("customer_id", F.when(F.col("order_id") != 3, F.col("customer_id")))
    with pytest.raises(QualityError, match=r"customer_id is missing \(2 rows\)"):
        bucketed.load_fact(type(good)(**{**vars(good), "orders": orders}), datetime(2024, 6, 3))
    assert bucketed.fact.folders() == before and sorted(r["order_item_id"] for r in bucketed.refused.read().collect()) == [30, 31]


def test_numbers_are_found_without_a_join(spark):
    from saleswh.operators.numbering import dense_numbers

    found, last = dense_numbers(spark.range(1000).select(F.col("id").alias("k")), "k", "sk", 5)
    assert "Join" not in found._jdf.queryExecution().executedPlan().toString() and last == 1005
    assert rows(found) == sorted([(n, n + 6) for n in range(1000)], key=repr)
