import os

import pytest
from pyspark.sql import functions as F

from builders import rows, tables
from orderlens.model import LOAD_ORDER, SCHEMAS, Tables
from orderlens.plans import reports
from orderlens.sources import versions


def shop(spark, first=1, price=5):
    """One customer, product, order and line, all with the same number."""
    t = tables(
        spark, customers=[(first, "A", "VIP")], products=[(first, "p", "Toys", 5)],
        orders=[(first, first, "2024-01-05", "Completed")], items=[(first, first, 2, price)],
    )
    return Tables(t.customers, t.products, t.orders, t.order_items.withColumn("order_item_id", F.lit(first).cast("bigint")))


def content(t):
    return {name: sorted(rows(df)) for name, df in t.items()}


def test_versions_are_numbered_and_stay_readable(spark, tmp_path):
    folder = f"{tmp_path}/shop"
    assert versions.versions(spark, folder) == []
    with pytest.raises(LookupError, match="no a version|no version"):
        versions.read_version(spark, folder)
    assert versions.publish_tables(shop(spark), folder) == 1
    assert versions.publish_appended(shop(spark, 2, price="0.125"), folder) == 2
    assert versions.publish_tables(shop(spark, 3), folder) == 3
    assert versions.versions(spark, folder) == [1, 2, 3]
    first, second, third = (versions.read_version(spark, folder, n) for n in (1, 2, 3))
    for name in LOAD_ORDER:
        assert first[name].schema == SCHEMAS[name]
        assert sorted(rows(second[name])) == sorted(rows(first[name]) + rows(shop(spark, 2, price="0.125")[name]))
    assert content(versions.read_version(spark, folder)) == content(third) == content(shop(spark, 3))
    assert rows(reports.revenue_by_month(second)) == [("2024-01", 10.25, 2)]
    with pytest.raises(LookupError, match="version 4"):
        versions.read_version(spark, folder, 4)


@pytest.mark.parametrize("publish", [versions.publish_tables, versions.publish_appended])
@pytest.mark.parametrize("table", LOAD_ORDER)
def test_a_load_that_dies_at_any_table_changes_nothing(spark, tmp_path, publish, table):
    folder = f"{tmp_path}/shop"
    versions.publish_tables(shop(spark), folder)
    before = content(versions.read_version(spark, folder))
    new = dict(shop(spark, 2).items())
    key = new[table].columns[0]
    new[table] = new[table].withColumn(key, F.raise_error(F.lit("lost")).cast("bigint"))
    with pytest.raises(Exception, match="lost"):
        publish(Tables(**new), folder, verify=False)
    assert versions.versions(spark, folder) == [1]
    assert content(versions.read_version(spark, folder)) == before
    # What the dead load wrote goes; the next load takes the next number.
    versions.remove_old(spark, folder)
    assert len(os.listdir(f"{folder}/rows")) == 1
    assert versions.publish_appended(shop(spark, 2), folder) == 2
    assert versions.read_version(spark, folder).orders.count() == 2


def test_a_manifest_cut_short_is_no_version(spark, tmp_path):
    folder = f"{tmp_path}/shop"
    versions.publish_tables(shop(spark), folder)
    with open(f"{folder}/versions/00000002.json", "w") as f:
        f.write('{"customers": ["')
    assert versions.versions(spark, folder) == [1]
    assert versions.read_version(spark, folder).orders.count() == 1
    assert versions.publish_appended(shop(spark, 2), folder) == 3
    assert versions.read_version(spark, folder).orders.count() == 2


def test_two_loads_at_once(spark, tmp_path):
    """The load that comes second finds its base replaced, and changes nothing."""
    folder = f"{tmp_path}/shop"
    versions.publish_tables(shop(spark), folder)

    def meanwhile():
        versions.publish_tables(shop(spark, 9), folder)
        return shop(spark, 2).order_items

    new = shop(spark, 2)
    late = Tables(new.customers, new.products, new.orders, meanwhile)
    with pytest.raises(RuntimeError, match="load again"):
        versions.publish_appended(late, folder, verify=False)
    assert content(versions.read_version(spark, folder)) == content(shop(spark, 9))


def test_checks_before_anything_is_written(spark, tmp_path):
    folder = f"{tmp_path}/shop"
    versions.publish_tables(shop(spark), folder)
    with pytest.raises(ValueError, match="stored already"):
        versions.publish_appended(shop(spark), folder)
    with pytest.raises(ValueError, match="unit_price not above zero"):
        versions.publish_tables(shop(spark, price=-1), folder)
    assert versions.versions(spark, folder) == [1] and len(os.listdir(f"{folder}/rows")) == 1


def test_old_versions_go(spark, tmp_path):
    folder = f"{tmp_path}/shop"
    versions.publish_tables(shop(spark), folder)
    versions.publish_tables(shop(spark, 2), folder)
    versions.publish_appended(shop(spark, 3), folder)
    versions.remove_old(spark, folder, keep=1)
    assert versions.versions(spark, folder) == [3]
    assert versions.read_version(spark, folder).orders.count() == 2
    assert len(os.listdir(f"{folder}/rows")) == 2
    with pytest.raises(ValueError, match="at least one"):
        versions.remove_old(spark, folder, keep=0)


def test_empty_tables(spark, tmp_path):
    folder = f"{tmp_path}/shop"
    versions.publish_tables(tables(spark), folder)
    versions.publish_appended(tables(spark), folder)
    assert [df.count() for _, df in versions.read_version(spark, folder).items()] == [0, 0, 0, 0]
