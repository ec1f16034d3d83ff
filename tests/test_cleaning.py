from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from builders import raw, raw_tables, rows
from orderlens.model import RawTables
from orderlens.plans import cleaning, faults, integrity
from orderlens.sources.star import AS_OF, KEYS, contact_customers, raw_star_tables, star_tables

NOW = "2024-06-01 00:00:00"
DAY = date(2023, 1, 1)


def test_customers_are_repaired_before_copies_are_found(spark):
    judged = cleaning.judge_customers(raw(spark, "customers", [
        (1, "  ANN O'NEIL ", "ANN@X.org", None, "Rome", DAY, "VIP"),
        (1, "ann o'neil", " ann@x.org", "unknown", "Rome", DAY, "VIP"),
        (2, None, None, "5", None, DAY, "VIP"),
        (3, "  ", "   ", "5", None, DAY, "VIP"),
        (4, "x", "Unknown", "5", None, DAY, "VIP"),
    ]))
    clean = cleaning.accepted(judged)
    assert sorted(rows(clean.select("customer_id", "name", "email", "phone"))) == [
        (1, "Ann O'Neil", "ann@x.org", "unknown"), (2, "Unknown", "unknown", "5"),
        (3, "", "", "5"), (4, "X", "unknown", "5"),
    ]
    assert {r.metric: r.value for r in cleaning.customer_counts(judged).collect()} == {
        "raw_rows": 5, "duplicates_removed": 1, "emails_filled": 2, "phones_filled": 1,
        "cleaned_rows": 4,
    }


def test_product_rules(spark):
    # Missing categories are filled, prices that are not positive refused; what counts is
    # the price as it is stored.
    inf = float("inf")
    unnamed = [(3, None, 12.5), (4, None, 0.125)]
    refused = [(5, "Toys", -3.0), (6, "Books", 0.0), (7, "Books", 0.0000004)]
    odd = [(8, "Toys", None), (9, "Toys", float("nan"))]
    unstorable = [(10, "Toys", inf), (11, "Toys", -inf), (12, "Toys", 1e15)]
    good = [(1, "Toys", 5.25), (1, "Toys", 5.25), (2, "Toys", 0.004), (13, "Toys", 1e11)]
    judged = cleaning.judge_products(raw(spark, "products", [
        (i, f"p{i}", c, p) for i, c, p in unnamed + refused + odd + unstorable + good
    ]))
    kept = cleaning.accepted(judged)
    assert sorted((r.product_id, r.category, float(r.price)) for r in kept.collect()) == [
        (1, "Toys", 5.25), (1, "Toys", 5.25), (2, "Toys", 0.004), (3, "Uncategorized", 12.5),
        (4, "Uncategorized", 0.125), (13, "Toys", 1e11),
    ]
    assert kept.filter("price IS NULL OR price <= 0").count() == 0
    assert {r.metric: r.value for r in cleaning.product_counts(judged).collect()} == {
        "raw_rows": 14, "categories_filled": 2, "bad_prices_removed": 3,
        "missing_prices_removed": 2, "prices_out_of_range_removed": 3, "cleaned_rows": 6,
    }


def test_orders_follow_the_rule_order(spark):
    customers = raw(spark, "customers", [(1, "a", "e", "p", "c", DAY, "VIP")])
    judged = cleaning.judge_orders(raw(spark, "orders", [
        (1, 1, "2024-01-02 03:04:05.678", "Completed"),
        (1, 1, "2024-01-02 03:04:05.678", "Completed"),
        (2, 1, "2024-01-02", "Completed"), (2, 1, "01/02/2024", "Completed"),
        (3, 9, "not_a_date", "Completed"), (4, 9, "2031-01-01", "Completed"),
        (5, 9, "2024-01-01", "Completed"), (6, None, "2024-01-01", "Completed"),
        (7, 1, "", "Completed"), (8, 1, None, "Completed"),
        (9, 1, NOW, "Completed"), (10, 1, "2024-06-01 00:00:00.5", "Completed"),
    ]), customers, NOW)
    assert sorted(rows(cleaning.accepted(judged).select("order_id", "order_date"))) == [
        (1, datetime(2024, 1, 2, 3, 4, 5)), (2, datetime(2024, 1, 2)), (2, datetime(2024, 1, 2)),
        (9, datetime(2024, 6, 1)),
    ]
    assert {r.metric: r.value for r in cleaning.order_counts(judged).collect()} == {
        "raw_rows": 12, "duplicates_removed": 1, "unparseable_dates_removed": 3,
        "future_dates_removed": 2, "unknown_customers_removed": 2, "cleaned_rows": 4,
    }


def test_items_follow_the_rule_order(spark):
    nan = float("nan")
    t = raw_tables(
        spark,
        customers=[(1, "a", "e", "p", "c", DAY, "VIP")],
        products=[(1, "p", "Toys", 5.0), (2, "q", "Toys", -1.0)],
        orders=[(1, 1, "2024-01-01", "Completed"), (2, 1, "bad", "Completed")],
        items=[
            (1, 1, 1, 2, 5.0), (1, 1, 1, 2, 5.0),
            (2, 2, 1, 2, 5.0),                        # order refused
            (3, 1, 2, 2, 5.0),                        # product refused
            (4, 7, 8, -1, None),                      # all wrong: counted once
            (5, 1, 1, 0, None), (6, 1, 1, -3, 5.0), (7, 1, 1, None, 5.0),
            (8, 1, 1, 1, None), (9, 1, 1, 1, nan),
            (10, 1, 1, 1, -4.0),                      # kept here, refused by the price check
            (11, 1, 1, 1, float("inf")), (12, 1, 1, 1, 1e14), (13, 1, 1, 1, 0.004),
        ],
    )
    assert sorted(r.order_item_id for r in cleaning.clean_order_items(t, NOW).collect()) == [1, 10, 13]
    report = {(r.table_name, r.metric): r.value for r in cleaning.cleaning_report(t, NOW).collect()}
    assert {m: v for (name, m), v in report.items() if name == "order_items"} == {
        "raw_rows": 14, "duplicates_removed": 1, "unknown_orders_removed": 2,
        "unknown_products_removed": 1, "bad_quantities_removed": 2,
        "missing_quantities_removed": 1, "missing_prices_removed": 2,
        "prices_out_of_range_removed": 2, "cleaned_rows": 3,
    }


def _balance(report):
    values = {}
    for r in report.collect():
        values.setdefault(r.table_name, {})[r.metric] = r.value
    for counts in values.values():
        removed = sum(v for m, v in counts.items() if m.endswith("_removed"))
        assert counts["raw_rows"] == counts["cleaned_rows"] + removed
    return values


def test_whole_run_agrees_with_the_single_steps(spark, small):
    t = raw_star_tables(spark, small)
    run = cleaning.clean_all(t, AS_OF)
    assert _balance(run.report) == _balance(cleaning.cleaning_report(t, AS_OF))
    single = {
        "customers": cleaning.clean_customers(t), "products": cleaning.clean_products(t),
        "orders": cleaning.clean_orders(t, AS_OF),
        "order_items": cleaning.clean_order_items(t, AS_OF),
    }
    for name, df in run.tables.items():
        assert df.columns == single[name].columns
        assert sorted(rows(df), key=str) == sorted(rows(single[name]), key=str)
    assert integrity.integrity_verdict(run.tables).first().integrity_ok


def test_run_into_a_folder_is_the_same_and_splits_the_rows(spark, small, tmp_path):
    t = raw_star_tables(spark, small)
    run, other = cleaning.clean_all(t, AS_OF, folder=f"{tmp_path}/run"), cleaning.clean_all(t, AS_OF)
    assert _balance(run.report) == _balance(other.report)
    for name, df in run.tables.items():
        assert df.columns == other.tables[name].columns
        assert sorted(rows(df), key=str) == sorted(rows(other.tables[name]), key=str)
        held = spark.read.parquet(f"{tmp_path}/run/{name}/refused=false")
        assert held.filter("violation IS NOT NULL").count() == 0 and held.count() == df.count()
    assert spark.read.parquet(f"{tmp_path}/run/orders/refused=true").filter("violation IS NULL").count() == 0


def test_order_keys_are_those_of_clean_orders(spark, medium):
    t = raw_star_tables(spark, medium)
    keys = cleaning.accepted_order_keys(t.orders, t.customers, AS_OF).distinct()
    clean = cleaning.clean_orders(t, AS_OF).select("order_id").distinct()
    assert keys.count() == clean.count() == keys.intersect(clean).count()


def test_injected_faults_are_found(spark, small):
    """Corrupt clean tables at the usual rates, clean them, and compare counts."""
    clean = star_tables(spark, small)
    key = F.concat_ws("/", "order_id", "line_number", "product_id", "supplier_id")
    dirty = RawTables(
        faults.dirty_customers(contact_customers(spark, small)),
        faults.dirty_products(clean.products),
        faults.dirty_orders(clean.orders, "2031-01-01 00:00:00"),
        faults.dirty_order_items(clean.order_items, key),
    )
    values = _balance(cleaning.cleaning_report(dirty, AS_OF))
    assert values["customers"]["duplicates_removed"] == 15
    assert values["orders"]["duplicates_removed"] == 20
    assert values["order_items"]["duplicates_removed"] == 25
    assert values["customers"]["cleaned_rows"] == clean.customers.count()
    rates, n = faults.RATES, clean.orders.count()
    expected = (rates.unparseable_date + rates.blank_date) * n
    assert 0.5 * expected < values["orders"]["unparseable_dates_removed"] < 1.5 * expected
    assert values["products"]["bad_prices_removed"] == dirty.products.filter("price <= 0").count()


# --- integrity ---------------------------------------------------------------


def test_violations(spark):
    t = raw_tables(
        spark,
        customers=[(1, "a", "e", None, "c", DAY, "VIP"), (1, None, "e", None, "c", None, "VIP"),
                   (None, "b", "e", None, "c", DAY, "VIP")],
        products=[(1, "p", "Toys", 0.0), (2, "q", None, None)],
        orders=[(1, 1, "2024-01-01", "Completed"), (2, None, "2024-01-01", "Completed"),
                (3, 8, "2024-01-01", "Completed")],
        items=[(1, 1, 1, 2, -5.0), (2, 9, 9, 0, 5.0)],
    )
    assert sorted(rows(integrity.pk_violations(t))) == [
        ("customers", "1", 2), ("customers", "null", 1),
    ]
    nulls = {(r[0], r[1]): r[2] for r in rows(integrity.not_null_violations(t)) if r[2]}
    assert nulls == {
        ("customers", "name"): 1, ("customers", "signup_date"): 1, ("products", "category"): 1,
        ("products", "price"): 1, ("orders", "customer_id"): 1,
    }
    assert {r[1]: r[2] for r in rows(integrity.check_violations(t))} == {
        "price": 1, "quantity": 1, "unit_price": 1,
    }
    assert rows(integrity.fk_violations(t)) == [
        ("orders", "customer_id", "customers", 1), ("order_items", "order_id", "orders", 1),
        ("order_items", "product_id", "products", 1),
    ]
    assert rows(integrity.integrity_verdict(t)) == [(2, 1, 1, False)]
    with pytest.raises(ValueError, match="customers: 2 key values.*orders: 1 values of customer_id"):
        integrity.require_integrity(t)


def test_composite_key(spark, small):
    found = integrity.pk_violations(star_tables(spark, small), {"order_items": KEYS["order_items"]})
    assert found.count() > 0 and found.agg(F.min("copies")).first()[0] == 2
