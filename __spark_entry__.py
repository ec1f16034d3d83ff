"""Queries of the library on the star-schema test tables, with SQL to check them.

`queries()` maps a name to a function of (spark, folder); `oracle_sql()` maps the
same name to SQL over the raw parquet tables, written independently of the
DataFrame plans (no pre-aggregation, literal joins, plain windows).
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from orderlens.functions.text import strip_blanks, title_case  # noqa: E402
from orderlens.functions.times import parse_timestamp  # noqa: E402
from orderlens.model import RawTables, Tables  # noqa: E402
from orderlens.operators.dedup import surplus_copies  # noqa: E402
from orderlens.operators.durable import Scratch  # noqa: E402
from orderlens.operators.lookup import lookup  # noqa: E402
from orderlens.operators.sampling import sample_rows  # noqa: E402
from orderlens.plans import cleaning, facts, faults, integrity, reports  # noqa: E402
from orderlens.plans.access import run_report  # noqa: E402
from orderlens.sources.star import (  # noqa: E402
    AS_OF,
    COMPLETED_STATUS,
    KEYS,
    contact_customers,
    raw_star_tables,
    star_tables,
)

Query = Callable[[SparkSession, str], DataFrame]

SCALED_MEDIUM = (2_000_000, 8_000_000)
FUTURE_TEXT = "2031-05-06 00:00:00"
SAMPLE_SIZE = 500


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: revenue per month."""
    return queries()["revenue_by_month"](spark, "/root/testdata/sf0.001")


# --- query builders ----------------------------------------------------------


def _report(report, **options) -> Query:
    return lambda spark, folder: report(
        star_tables(spark, folder), completed=COMPLETED_STATUS, **options
    )


def _on_lines_of_completed(report) -> Query:
    """A report on lines that a key filter of completed orders lets through."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        tables = star_tables(spark, folder)
        # The filter is read when the result is; it goes when the application ends.
        few = facts.lines_of_completed(tables, Scratch(), COMPLETED_STATUS)
        return report(few, completed=COMPLETED_STATUS)

    return run


def _sub_cent(report) -> Query:
    """A report on prices below a cent; lines of every seventh part have no price."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        t = star_tables(spark, folder)
        priced = F.when(F.col("product_id") % 7 != 0, F.col("unit_price") / 8)
        lines = t.order_items.withColumn("unit_price", priced)
        return report(
            Tables(t.customers, t.products, t.orders, lines), completed=COMPLETED_STATUS
        )

    return run


def _named(name: str, **options) -> Query:
    return lambda spark, folder: run_report(
        star_tables(spark, folder), name, completed=COMPLETED_STATUS, as_of=AS_OF, **options
    )


def _raw(build: Callable[[RawTables], DataFrame]) -> Query:
    return lambda spark, folder: build(raw_star_tables(spark, folder))


def _clean(build: Callable[[Tables], DataFrame]) -> Query:
    return lambda spark, folder: build(star_tables(spark, folder))


def _contacts(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: build(contact_customers(spark, folder))


def _plain(df: DataFrame, *money: str) -> DataFrame:
    """Money as DOUBLE, so that both engines return the same Python type."""
    return df.withColumns({c: F.col(c).cast("double") for c in money})


def _duplicate_counts(raw: RawTables) -> DataFrame:
    customers, orders, items = (
        surplus_copies(raw[name]).select(F.lit(name).alias("table_name"), "duplicates")
        for name in ("customers", "orders", "order_items")
    )
    return customers.unionByName(orders).unionByName(items)


# A shape per remainder of the key, and what is left of the moment in it.
_SHAPES = (
    ("M/d/yyyy", "day"), ("  MM/dd/yyyy ", "day"), ("MM/dd/yyyy H:mm:ss", "second"),
    ("MM-dd-yyyy", "day"), ("MMMM d, yyyy", "day"), ("yyyy-MM-dd hh:mm a", "minute"),
    ("yyyy/MM/dd HH:mm:ss.SSS", "millisecond"),
)


def _mixed_dates(t: Tables) -> DataFrame:
    """Order dates written in seven shapes and parsed again."""
    shape = F.col("order_id") % len(_SHAPES)
    text = F.coalesce(*[
        F.when(shape == i, F.date_format("order_date", fmt)) for i, (fmt, _) in enumerate(_SHAPES)
    ])
    return t.orders.select("order_id", parse_timestamp(text).alias("parsed_date"))


def _line_key():
    return F.concat_ws("/", "order_id", "line_number", "product_id", "supplier_id")


def _price_lookup(raw: RawTables) -> DataFrame:
    return lookup(
        raw.order_items.select("order_id", "line_number", "product_id", "quantity"),
        "product_id", raw.products, "price", "list_price", F.lit(0.0),
    )


def queries() -> dict[str, Query]:
    """All queries; those on text corpora only if their subpackage is installed."""
    corpus, _ = _corpus()
    return core_queries() | corpus


def oracle_sql() -> dict[str, str]:
    _, sql = _corpus()
    return core_oracle_sql() | sql


def _corpus() -> tuple[dict[str, Query], dict[str, str]]:
    try:
        import corpus_pipeline
        from orderlens.llm import queries as corpus
    except ModuleNotFoundError:
        # The subpackage, the pipeline or a package that only they need is not installed.
        return {}, {}
    found, sql = dict(corpus.QUERIES), dict(corpus.ORACLE_SQL)
    found["pipeline"] = corpus_pipeline.run
    found = {name: _importable(query) for name, query in found.items()}
    if corpus_pipeline.ORACLE_SQL is not None:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found, sql


def _importable(query: Query) -> Query:
    """Let Python workers import this repository from where the driver has it.

    On a cluster the package is shipped with `--py-files`; this is for runs whose
    working directory is another one.
    """

    def run(spark: SparkSession, folder: str) -> DataFrame:
        environment = spark.sparkContext.environment
        known = environment.get("PYTHONPATH", "")
        if ROOT not in known.split(os.pathsep):
            environment["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, known]))
        return query(spark, folder)

    return run


def core_queries() -> dict[str, Query]:
    return {
        # revenue
        "revenue_by_customer": _report(reports.revenue_by_customer),
        "revenue_by_category": _report(reports.revenue_by_category),
        "revenue_by_month": _report(reports.revenue_by_month),
        "top_products_qty": _report(reports.top_products_qty),
        "top_products_qty_10": _report(reports.top_products_qty, limit=10),
        "top_products_revenue": _report(reports.top_products_revenue),
        "top_products_revenue_10": _report(reports.top_products_revenue, limit=10),
        "aov_by_segment": _report(reports.aov_by_segment),
        "revenue_by_customer_sub_cent": _sub_cent(reports.revenue_by_customer),
        "aov_by_segment_sub_cent": _sub_cent(reports.aov_by_segment),
        "top_customers_ltv_sub_cent": _sub_cent(reports.top_customers_ltv),
        "rank_within_customer_sub_cent": _sub_cent(reports.rank_within_customer),
        "revenue_by_customer_filtered": _on_lines_of_completed(reports.revenue_by_customer),
        "revenue_by_category_filtered": _on_lines_of_completed(reports.revenue_by_category),
        # ranks and series
        "top_customers_ltv": _report(reports.top_customers_ltv),
        "top_customers_ltv_20": _report(reports.top_customers_ltv, limit=20),
        "top_customers_ltv_20_split": _report(
            reports.top_customers_ltv, limit=20, split=True, few=4, buckets=4
        ),
        "running_revenue": _report(reports.running_revenue),
        "moving_avg_revenue": _report(reports.moving_avg_revenue),
        "growth_rate": _report(reports.growth_rate),
        "rank_within_customer": _report(reports.rank_within_customer),
        "rank_within_customer_split": _report(reports.rank_within_customer, hot_rows=4, buckets=4),
        "rank_within_customer_30": _report(reports.rank_within_customer, limit=30),
        # cohorts and segments
        "cohort_sizes": _report(reports.cohort_sizes),
        "retention": _report(reports.retention),
        "churn_status": _report(reports.churn_status, as_of=AS_OF),
        "segmentation": _report(reports.segmentation, as_of=AS_OF),
        "segmentation_scaled": _report(reports.segmentation, as_of=AS_OF, medium=SCALED_MEDIUM),
        # by name, with the default limit
        "named_report_default_limit": _named("revenue_by_customer"),
        "named_report_all_rows": _named("churn_status", limit=0),
        # cleaning
        "clean_customers": _raw(cleaning.clean_customers),
        "clean_products": _raw(lambda t: _plain(cleaning.clean_products(t), "price")),
        "clean_orders": _raw(lambda t: cleaning.clean_orders(t, AS_OF)),
        "clean_order_items": _raw(
            lambda t: _plain(cleaning.clean_order_items(t, AS_OF), "unit_price")
        ),
        "cleaning_report": _raw(lambda t: cleaning.cleaning_report(t, AS_OF)),
        "duplicate_counts": _raw(_duplicate_counts),
        "title_case_names": _raw(
            lambda t: t.customers.select(
                "customer_id", title_case(strip_blanks(F.col("name"))).alias("title_name")
            )
        ),
        "parse_order_dates": _raw(
            lambda t: t.orders.select(
                "order_id", parse_timestamp(F.col("order_date")).alias("parsed_date")
            )
        ),
        "parse_mixed_dates": _clean(_mixed_dates),
        # keys, constraints, references
        "pk_violations": _raw(lambda t: integrity.pk_violations(t, KEYS)),
        "not_null_violations": _raw(integrity.not_null_violations),
        "check_violations": _raw(integrity.check_violations),
        "fk_violations": _raw(integrity.fk_violations),
        "table_counts": _raw(integrity.table_counts),
        "orphan_orders": _raw(integrity.orphan_orders),
        "orphan_items_order": _raw(integrity.orphan_items_order),
        "orphan_items_product": _raw(integrity.orphan_items_product),
        "integrity_verdict": _raw(integrity.integrity_verdict),
        "integrity_verdict_cleaned": _raw(
            lambda t: integrity.integrity_verdict(cleaning.clean_all(t, AS_OF).tables)
        ),
        # fault injection, sampling, lookup
        "inject_nulls": _contacts(
            lambda c: faults.missing_contacts(c).select("customer_id", "email", "phone")
        ),
        "inject_null_categories": _clean(
            lambda t: faults.null_out(
                t.products, "category",
                faults.share(F.col("product_id"), faults.RATES.missing_category, "category"),
            ).select("product_id", "category")
        ),
        "inject_case_noise": _contacts(
            lambda c: faults.noisy_case(c).select("customer_id", "name", "email")
        ),
        "inject_duplicates": _contacts(
            lambda c: faults.duplicate_sample(
                c, faults.RATES.duplicate_customers, F.col("customer_id"), "copy"
            )
        ),
        "inject_duplicate_orders": _clean(
            lambda t: faults.duplicate_sample(
                t.orders, faults.RATES.duplicate_orders, F.col("order_id"), "copy"
            )
        ),
        "inject_duplicate_items": _clean(
            lambda t: faults.duplicate_sample(
                t.order_items, faults.RATES.duplicate_items, _line_key(), "copy"
            )
        ),
        "inject_orphans": _clean(lambda t: faults.unknown_customers(t.orders)),
        "inject_orphan_items": _clean(
            lambda t: faults.unknown_parents(t.order_items, _line_key())
        ),
        "inject_bad_dates": _clean(lambda t: faults.bad_dates(t.orders, FUTURE_TEXT)),
        "inject_bad_numbers": _clean(
            lambda t: faults.bad_prices(t.products).select("product_id", "price")
        ),
        "inject_bad_lines": _clean(lambda t: faults.bad_lines(t.order_items, _line_key())),
        "price_lookup_default": _raw(_price_lookup),
        "sampled_rows": _clean(
            lambda t: sample_rows(t.orders, SAMPLE_SIZE, F.col("order_id"), "sample")
        ),
        "sampled_rows_split": _clean(
            lambda t: sample_rows(
                t.orders, SAMPLE_SIZE, F.col("order_id"), "sample", split=True, few=4, slots=16
            )
        ),
    }


# --- oracle SQL --------------------------------------------------------------

_SALES = """
sales AS (
    SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS placed,
           strftime(o_orderdate, '%Y-%m') AS order_month, l_partkey AS product_id,
           CAST(l_quantity AS INTEGER) AS units,
           CAST(l_quantity AS INTEGER) * CAST(l_extendedprice AS DECIMAL(12,2)) AS amount
    FROM lineitem, orders
    WHERE l_orderkey = o_orderkey AND o_orderstatus = 'F'
)"""

# The same with an eighth of each price, and none for every seventh part.
_SUB_CENT = _SALES.replace(
    "CAST(l_extendedprice AS DECIMAL(12,2)) AS amount",
    "CASE WHEN l_partkey % 7 <> 0 THEN CAST(l_extendedprice / 8 AS DECIMAL(20,6)) END AS amount",
)

_MONTHS = _SALES + """,
months AS (SELECT order_month, SUM(amount) AS m FROM sales GROUP BY order_month)"""

_TOTALS = _SALES + """,
totals AS (
    SELECT customer_id, order_id, placed AS order_date, SUM(amount) AS exact_total
    FROM sales GROUP BY ALL
),
ranked AS (
    SELECT customer_id, order_id, order_date, CAST(exact_total AS DOUBLE) AS order_total,
           CAST(RANK() OVER (PARTITION BY customer_id ORDER BY exact_total DESC) AS BIGINT)
               AS rank_within_customer
    FROM totals
)"""

_LTV = _SALES + """,
ltv AS (
    SELECT customer_id, c_name AS name, SUM(amount) AS v
    FROM sales JOIN customer ON c_custkey = customer_id GROUP BY customer_id, c_name
),
ranked AS (
    SELECT customer_id, name, CAST(v AS DOUBLE) AS lifetime_value,
           CAST(RANK() OVER (ORDER BY v DESC) AS BIGINT) AS ltv_rank,
           CAST(DENSE_RANK() OVER (ORDER BY v DESC) AS BIGINT) AS ltv_dense_rank
    FROM ltv
)"""


def _by_product(value: str, name: str, limit: str = "") -> str:
    return f"""
    WITH {_SALES}
    SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
           {value} AS {name}
    FROM sales JOIN part ON p_partkey = product_id
    GROUP BY p_partkey, p_name, p_type
    ORDER BY {name} DESC, product_id {limit}"""


_REVENUE_BY_CUSTOMER = f"""
    WITH {_SALES}
    SELECT customer_id, c_name AS name, c_mktsegment AS segment,
           CAST(SUM(amount) AS DOUBLE) AS total_revenue,
           COUNT(DISTINCT order_id) AS total_orders
    FROM sales JOIN customer ON c_custkey = customer_id
    GROUP BY customer_id, c_name, c_mktsegment
    ORDER BY total_revenue DESC, customer_id"""


def _segmentation(low: float, high: float, few: int = 2, many: int = 4) -> str:
    """The middle tiers run from `low` to `high` and from `few` to `many`, both included."""
    return f"""
    WITH {_SALES},
    stats AS (
        SELECT customer_id, c_name AS name, COUNT(DISTINCT order_id) AS frequency,
               CAST(SUM(amount) AS DOUBLE) AS monetary, MAX(placed) AS latest
        FROM sales JOIN customer ON c_custkey = customer_id GROUP BY customer_id, c_name
    )
    SELECT customer_id, name, frequency, monetary,
           ROUND((epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(latest)) / 86400000000.0::DOUBLE, 0)
               AS recency_days,
           CASE WHEN frequency BETWEEN {few} AND {many} THEN 'Occasional'
                WHEN frequency < {few} THEN 'One-time' ELSE 'Loyal' END AS frequency_segment,
           CASE WHEN monetary BETWEEN {low} AND {high} THEN 'Medium'
                WHEN monetary < {low} THEN 'Low' ELSE 'High' END AS spend_segment
    FROM stats"""


_CHURN = f"""
    WITH people AS (
        SELECT o_custkey, COUNT(*) AS n, MAX(o_orderdate) AS latest
        FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey
    )
    SELECT CASE WHEN n >= 2 THEN 'Repeat'
                WHEN epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(latest) > 90 * 86400000000
                    THEN 'Churned'
                ELSE 'New / Active (single order, recent)' END AS customer_status,
           COUNT(*) AS num_customers
    FROM people GROUP BY 1"""

_RETENTION = """
    WITH active AS (
        SELECT o_custkey AS who, date_trunc('month', o_orderdate) AS month
        FROM orders WHERE o_orderstatus = 'F'
    ),
    first AS (SELECT who, MIN(month) AS start FROM active GROUP BY who),
    sizes AS (SELECT start, COUNT(*) AS cohort_size FROM first GROUP BY start)
    SELECT strftime(f.start, '%Y-%m') AS cohort_month,
           CAST(datediff('month', f.start, a.month) AS INTEGER) AS month_index,
           COUNT(DISTINCT a.who) AS active_customers, s.cohort_size,
           ROUND(CAST(100.0 AS DOUBLE) * COUNT(DISTINCT a.who) / s.cohort_size, 1)
               AS retention_pct
    FROM first f JOIN active a ON a.who = f.who JOIN sizes s ON s.start = f.start
    GROUP BY 1, 2, s.cohort_size"""

_RAW_CUSTOMERS = """
raw_customers AS (
    SELECT k AS customer_id,
           CASE WHEN k % 101 = 0 THEN NULL
                WHEN k % 37 = 0 THEN '  o''neil MCDONALD-smith ' || k
                WHEN k % 33 = 0 THEN '  ' || upper(c_name) || '  ' ELSE c_name END AS name,
           CASE WHEN k % 20 = 0 THEN NULL
                WHEN k % 50 = 1 THEN upper('user' || k || '@example.com')
                ELSE 'user' || k || '@example.com' END AS email,
           CASE WHEN k % 25 <> 0 THEN '555-' || k END AS phone,
           n_name AS city, DATE '2000-01-01' + CAST(k % 900 AS INTEGER) AS signup_date,
           c_mktsegment AS segment
    FROM (SELECT *, c_custkey AS k FROM customer) LEFT JOIN nation ON n_nationkey = c_nationkey,
         range(2) copy(i)
    WHERE i = 0 OR k % 53 = 0
)"""

_TITLE = (
    "array_to_string(list_transform(regexp_extract_all(lower(trim({0})), '[a-z]+|[^a-z]+'), "
    "lambda w: upper(w[1]) || w[2:]), '')"
)

_CLEAN_CUSTOMERS = _RAW_CUSTOMERS + f""",
fixed_customers AS (
    SELECT customer_id, {_TITLE.format("COALESCE(name, 'Unknown')")} AS name,
           lower(trim(COALESCE(email, 'unknown'))) AS email,
           COALESCE(phone, 'unknown') AS phone, city, signup_date, segment
    FROM raw_customers
),
clean_customers AS (SELECT DISTINCT * FROM fixed_customers)"""

_RAW_PRODUCTS = """
raw_products AS (
    SELECT p_partkey AS product_id, p_name AS product_name,
           CASE WHEN p_partkey % 25 <> 0 THEN p_type END AS category,
           CASE p_partkey % 40 WHEN 1 THEN -p_retailprice WHEN 2 THEN 0.0 ELSE p_retailprice END
               AS price
    FROM part
)"""

_CLEAN_PRODUCTS = _RAW_PRODUCTS + """,
clean_products AS (
    SELECT product_id, product_name, COALESCE(category, 'Uncategorized') AS category, price
    FROM raw_products WHERE price > 0
)"""

_RAW_ORDERS = f"""
raw_orders AS (
    SELECT o_orderkey AS order_id,
           o_custkey + CASE WHEN o_orderkey % 50 = 0 THEN 1000000 ELSE 0 END AS customer_id,
           CASE WHEN o_orderkey % 67 = 0 THEN 'not_a_date' WHEN o_orderkey % 97 = 0 THEN ''
                WHEN o_orderkey % 71 = 0 THEN '{FUTURE_TEXT}'
                ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS order_date,
           o_orderstatus AS status
    FROM orders, range(2) copy(i) WHERE i = 0 OR o_orderkey % 199 = 0
)"""

_PARSED = "try_strptime(order_date, '%Y-%m-%d %H:%M:%S')"

_JUDGED_ORDERS = _RAW_CUSTOMERS + "," + _RAW_ORDERS + f""",
judged_orders AS (
    SELECT DISTINCT order_id, customer_id, {_PARSED} AS order_date, status,
           CASE WHEN {_PARSED} IS NULL THEN 'unparseable'
                WHEN {_PARSED} > TIMESTAMP '{AS_OF}' THEN 'future'
                WHEN customer_id NOT IN (SELECT customer_id FROM raw_customers) THEN 'orphan'
                ELSE 'ok' END AS verdict, order_date AS typed
    FROM raw_orders
),
clean_orders AS (
    SELECT order_id, customer_id, order_date, status FROM judged_orders WHERE verdict = 'ok'
)"""

_RAW_ITEMS = """
raw_items AS (
    SELECT l_orderkey + CASE WHEN l_partkey % 101 = 0 THEN 10000000 ELSE 0 END AS order_id,
           l_linenumber AS line_number,
           l_partkey + CASE WHEN (l_orderkey + l_linenumber) % 67 = 0 THEN 1000000 ELSE 0 END
               AS product_id,
           l_suppkey AS supplier_id,
           CAST(CASE WHEN (l_orderkey + l_suppkey) % 61 = 0 THEN -l_quantity ELSE l_quantity END
               AS INTEGER) AS quantity,
           CASE WHEN (l_orderkey + l_partkey) % 103 <> 0 THEN l_extendedprice END AS unit_price
    FROM lineitem, range(2) copy(i) WHERE i = 0 OR (l_orderkey + l_partkey) % 499 = 0
)"""

_JUDGED_ITEMS = _JUDGED_ORDERS + "," + _CLEAN_PRODUCTS + "," + _RAW_ITEMS + """,
judged_items AS (
    SELECT *, CASE WHEN order_id NOT IN (SELECT order_id FROM clean_orders) THEN 'order'
                   WHEN product_id NOT IN (SELECT product_id FROM clean_products) THEN 'product'
                   WHEN quantity <= 0 THEN 'quantity'
                   WHEN unit_price IS NULL THEN 'price' ELSE 'ok' END AS verdict
    FROM (SELECT DISTINCT * FROM raw_items)
),
clean_items AS (SELECT * EXCLUDE (verdict) FROM judged_items WHERE verdict = 'ok')"""

_CLEANING_REPORT = f"""
    WITH {_JUDGED_ITEMS},
    {_CLEAN_CUSTOMERS.replace(_RAW_CUSTOMERS + ",", "")},
    c AS (SELECT (SELECT COUNT(*) FROM raw_customers) AS a, (SELECT COUNT(*) FROM clean_customers) AS b),
    o AS (SELECT (SELECT COUNT(*) FROM raw_orders) AS a, (SELECT COUNT(*) FROM judged_orders) AS b),
    i AS (SELECT (SELECT COUNT(*) FROM raw_items) AS a, (SELECT COUNT(*) FROM judged_items) AS b)
    SELECT table_name, metric, CAST(value AS BIGINT) AS value FROM (
        SELECT 'customers' AS table_name, 'raw_rows' AS metric, a AS value FROM c
        UNION ALL SELECT 'customers', 'duplicates_removed', a - b FROM c
        UNION ALL SELECT 'customers', 'emails_filled', COUNT(*) FROM clean_customers WHERE email = 'unknown'
        UNION ALL SELECT 'customers', 'phones_filled', COUNT(*) FROM clean_customers WHERE phone = 'unknown'
        UNION ALL SELECT 'customers', 'cleaned_rows', b FROM c
        UNION ALL SELECT 'products', 'raw_rows', COUNT(*) FROM raw_products
        UNION ALL SELECT 'products', 'categories_filled', COUNT(*) FROM raw_products WHERE category IS NULL
        UNION ALL SELECT 'products', 'bad_prices_removed', COUNT(*) FROM raw_products WHERE price <= 0
        UNION ALL SELECT 'products', 'missing_prices_removed', COUNT(*) FROM raw_products WHERE price IS NULL
        UNION ALL SELECT 'products', 'prices_out_of_range_removed', COUNT(*) FROM raw_products WHERE abs(price) >= 1e14
        UNION ALL SELECT 'products', 'cleaned_rows', COUNT(*) FROM clean_products
        UNION ALL SELECT 'orders', 'raw_rows', a FROM o
        UNION ALL SELECT 'orders', 'duplicates_removed', a - b FROM o
        UNION ALL SELECT 'orders', 'unparseable_dates_removed', COUNT(*) FROM judged_orders WHERE verdict = 'unparseable'
        UNION ALL SELECT 'orders', 'future_dates_removed', COUNT(*) FROM judged_orders WHERE verdict = 'future'
        UNION ALL SELECT 'orders', 'unknown_customers_removed', COUNT(*) FROM judged_orders WHERE verdict = 'orphan'
        UNION ALL SELECT 'orders', 'cleaned_rows', COUNT(*) FROM clean_orders
        UNION ALL SELECT 'order_items', 'raw_rows', a FROM i
        UNION ALL SELECT 'order_items', 'duplicates_removed', a - b FROM i
        UNION ALL SELECT 'order_items', 'unknown_orders_removed', COUNT(*) FROM judged_items WHERE verdict = 'order'
        UNION ALL SELECT 'order_items', 'unknown_products_removed', COUNT(*) FROM judged_items WHERE verdict = 'product'
        UNION ALL SELECT 'order_items', 'bad_quantities_removed', COUNT(*) FROM judged_items WHERE verdict = 'quantity'
        UNION ALL SELECT 'order_items', 'missing_quantities_removed', COUNT(*) FROM raw_items WHERE quantity IS NULL
        UNION ALL SELECT 'order_items', 'missing_prices_removed', COUNT(*) FROM judged_items WHERE verdict = 'price'
        UNION ALL SELECT 'order_items', 'prices_out_of_range_removed', COUNT(*) FROM raw_items WHERE abs(unit_price) >= 1e14
        UNION ALL SELECT 'order_items', 'cleaned_rows', COUNT(*) FROM clean_items
    )"""

_RAW_ALL = ",".join((_RAW_CUSTOMERS, _RAW_PRODUCTS, _RAW_ORDERS, _RAW_ITEMS))

# Raw items without a matching parent, by outer join.
_ORPHANS = {
    "orphan_orders": ("raw_orders", "customer_id", "raw_customers"),
    "orphan_items_order": ("raw_items", "order_id", "raw_orders"),
    "orphan_items_product": ("raw_items", "product_id", "raw_products"),
}


def _orphans(name: str) -> str:
    child, column, parent = _ORPHANS[name]
    return f"""
    SELECT COUNT(*) AS {name}
    FROM {child} c LEFT JOIN (SELECT DISTINCT {column} FROM {parent}) p USING ({column})
    WHERE p.{column} IS NULL"""


def _nulls(table: str, label: str, columns: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{label}' AS table_name, '{c}' AS column_name, "
        f"COUNT(*) FILTER ({c} IS NULL) AS violations FROM {table}"
        for c in columns.split()
    )


def _hit(key: str, seed: str, rate: float) -> str:
    return (
        f"(CAST('0x' || substr(md5({key} || ':{seed}'), 1, 8) AS UBIGINT) % 1000000"
        f" < {round(rate * 1_000_000)})"
    )


_LINE_KEY = "concat_ws('/', l_orderkey, l_linenumber, l_partkey, l_suppkey)"
_ORDER_COLUMNS = (
    "o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS order_date, "
    "o_orderstatus AS status"
)
_CONTACTS = """
contacts AS (
    SELECT c_custkey AS customer_id, c_name AS name, 'user' || c_custkey || '@example.com' AS email,
           '555-' || c_custkey AS phone, n_name AS city,
           DATE '2000-01-01' + CAST(c_custkey % 900 AS INTEGER) AS signup_date,
           c_mktsegment AS segment
    FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey
)"""


def core_oracle_sql() -> dict[str, str]:
    sql = {
        "revenue_by_customer": _REVENUE_BY_CUSTOMER,
        "revenue_by_category": f"""
            WITH {_SALES}
            SELECT p_type AS category, CAST(SUM(amount) AS DOUBLE) AS total_revenue,
                   CAST(SUM(units) AS BIGINT) AS total_units_sold
            FROM sales JOIN part ON p_partkey = product_id GROUP BY p_type""",
        "revenue_by_month": f"""
            WITH {_SALES}
            SELECT order_month, CAST(SUM(amount) AS DOUBLE) AS total_revenue,
                   COUNT(DISTINCT order_id) AS total_orders
            FROM sales GROUP BY order_month ORDER BY order_month""",
        "top_products_qty": _by_product("CAST(SUM(units) AS BIGINT)", "total_units_sold"),
        "top_products_qty_10": _by_product(
            "CAST(SUM(units) AS BIGINT)", "total_units_sold", "LIMIT 10"
        ),
        "top_products_revenue": _by_product("CAST(SUM(amount) AS DOUBLE)", "total_revenue"),
        "top_products_revenue_10": _by_product(
            "CAST(SUM(amount) AS DOUBLE)", "total_revenue", "LIMIT 10"
        ),
        "aov_by_segment": f"""
            WITH {_SALES},
            per_order AS (
                SELECT order_id, c_mktsegment AS segment, SUM(amount) AS t
                FROM sales JOIN customer ON c_custkey = customer_id GROUP BY ALL
            )
            SELECT segment, ROUND(CAST(SUM(t) AS DOUBLE) / COUNT(t), 2) AS avg_order_value,
                   COUNT(*) AS num_orders
            FROM per_order GROUP BY segment""",
        "revenue_by_customer_sub_cent": f"""
            WITH {_SUB_CENT}
            SELECT customer_id, c_name AS name, c_mktsegment AS segment,
                   CAST(ROUND(SUM(amount), 2) AS DOUBLE) AS total_revenue,
                   COUNT(DISTINCT order_id) AS total_orders
            FROM sales JOIN customer ON c_custkey = customer_id
            GROUP BY customer_id, c_name, c_mktsegment""",
        "aov_by_segment_sub_cent": f"""
            WITH {_SUB_CENT},
            per_order AS (
                SELECT order_id, c_mktsegment AS segment, SUM(amount) AS t
                FROM sales JOIN customer ON c_custkey = customer_id GROUP BY ALL
            )
            SELECT segment, ROUND(CAST(SUM(t) AS DOUBLE) / COUNT(t), 2) AS avg_order_value,
                   COUNT(*) AS num_orders
            FROM per_order GROUP BY segment""",
        "top_customers_ltv_sub_cent": f"""
            WITH {_SUB_CENT},
            ltv AS (
                SELECT customer_id, c_name AS name, CAST(ROUND(SUM(amount), 2) AS DOUBLE) AS lifetime_value
                FROM sales JOIN customer ON c_custkey = customer_id GROUP BY customer_id, c_name
            )
            SELECT *, RANK() OVER (ORDER BY lifetime_value DESC NULLS LAST) AS ltv_rank,
                   DENSE_RANK() OVER (ORDER BY lifetime_value DESC NULLS LAST) AS ltv_dense_rank
            FROM ltv""",
        "rank_within_customer_sub_cent": f"""
            WITH {_SUB_CENT},
            totals AS (
                SELECT customer_id, order_id, placed AS order_date, SUM(amount) AS t
                FROM sales GROUP BY ALL
            )
            SELECT customer_id, order_id, order_date, CAST(ROUND(t, 2) AS DOUBLE) AS order_total,
                   RANK() OVER (PARTITION BY customer_id ORDER BY t DESC NULLS LAST)
                       AS rank_within_customer
            FROM totals""",
        "top_customers_ltv": f"WITH {_LTV} SELECT * FROM ranked",
        "top_customers_ltv_20": f"""
            WITH {_LTV} SELECT * FROM ranked ORDER BY ltv_rank, customer_id LIMIT 20""",
        "running_revenue": f"""
            WITH {_MONTHS}
            SELECT order_month, CAST(m AS DOUBLE) AS monthly_total,
                   CAST(SUM(m) OVER (ORDER BY order_month) AS DOUBLE) AS running_total
            FROM months""",
        "moving_avg_revenue": f"""
            WITH {_MONTHS}
            SELECT order_month, CAST(m AS DOUBLE) AS monthly_total,
                   ROUND(CAST(SUM(m) OVER w AS DOUBLE) / COUNT(m) OVER w, 2) AS moving_avg_3month
            FROM months
            WINDOW w AS (ORDER BY order_month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""",
        "growth_rate": f"""
            WITH {_MONTHS},
            pairs AS (SELECT *, LAG(m) OVER (ORDER BY order_month) AS p FROM months)
            SELECT order_month, CAST(m AS DOUBLE) AS monthly_total,
                   CAST(p AS DOUBLE) AS prev_month_total,
                   CASE WHEN p <> 0 THEN ROUND(CAST(100.0 AS DOUBLE) * CAST(m - p AS DOUBLE)
                        / CAST(p AS DOUBLE), 2) END AS growth_rate_pct
            FROM pairs""",
        "rank_within_customer": f"WITH {_TOTALS} SELECT * FROM ranked",
        "rank_within_customer_split": f"WITH {_TOTALS} SELECT * FROM ranked",
        "rank_within_customer_30": f"""
            WITH {_TOTALS} SELECT * FROM ranked
            ORDER BY customer_id, rank_within_customer, order_id LIMIT 30""",
        "cohort_sizes": """
            SELECT cohort_month, COUNT(*) AS customers_in_cohort
            FROM (SELECT o_custkey, strftime(MIN(o_orderdate), '%Y-%m') AS cohort_month
                  FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey)
            GROUP BY cohort_month""",
        "retention": _RETENTION,
        "churn_status": _CHURN,
        "segmentation": _segmentation(100, 500),
        "segmentation_scaled": _segmentation(*SCALED_MEDIUM),
        "named_report_default_limit": _REVENUE_BY_CUSTOMER + " LIMIT 20",
        "named_report_all_rows": _CHURN,
        "clean_customers": f"WITH {_CLEAN_CUSTOMERS} SELECT * FROM clean_customers",
        "clean_products": f"WITH {_CLEAN_PRODUCTS} SELECT * FROM clean_products",
        "clean_orders": f"WITH {_JUDGED_ORDERS} SELECT * FROM clean_orders",
        "clean_order_items": f"WITH {_JUDGED_ITEMS} SELECT * FROM clean_items",
        "cleaning_report": _CLEANING_REPORT,
        "duplicate_counts": f"WITH {_RAW_ALL} " + " UNION ALL ".join(
            f"SELECT '{label}' AS table_name, (SELECT COUNT(*) FROM {table}) - "
            f"(SELECT COUNT(*) FROM (SELECT DISTINCT * FROM {table})) AS duplicates"
            for label, table in (
                ("customers", "raw_customers"),
                ("orders", "raw_orders"),
                ("order_items", "raw_items"),
            )
        ),
        "title_case_names": f"""
            WITH {_RAW_CUSTOMERS}
            SELECT customer_id, {_TITLE.format("name")} AS title_name FROM raw_customers""",
        "parse_order_dates": f"""
            WITH {_RAW_ORDERS} SELECT order_id, {_PARSED} AS parsed_date FROM raw_orders""",
        "parse_mixed_dates": f"""
            SELECT o_orderkey AS order_id, CAST(CASE o_orderkey % {len(_SHAPES)} {" ".join(
                f"WHEN {i} THEN date_trunc('{left}', o_orderdate)" for i, (_, left) in enumerate(_SHAPES)
            )} END AS TIMESTAMP) AS parsed_date
            FROM orders""",
        "pk_violations": f"WITH {_RAW_ALL} " + " UNION ALL ".join(
            f"SELECT '{label}' AS table_name, concat_ws('/', {key}) AS key_value, "
            f"COUNT(*) AS copies FROM {table} GROUP BY {key} HAVING COUNT(*) > 1"
            for label, table, key in (
                ("customers", "raw_customers", "customer_id"),
                ("products", "raw_products", "product_id"),
                ("orders", "raw_orders", "order_id"),
                ("order_items", "raw_items", "order_id, line_number"),
            )
        ),
        "not_null_violations": f"WITH {_RAW_ALL} " + " UNION ALL ".join((
            _nulls("raw_customers", "customers", "name email signup_date segment"),
            _nulls("raw_products", "products", "product_name category price"),
            _nulls("raw_orders", "orders", "customer_id order_date status"),
            _nulls("raw_items", "order_items", "order_id product_id quantity unit_price"),
        )),
        "check_violations": f"""
            WITH {_RAW_ALL}
            SELECT 'products' AS table_name, 'price' AS column_name,
                   COUNT(*) AS violations FROM raw_products WHERE NOT price > 0
            UNION ALL SELECT 'order_items', 'quantity', COUNT(*) FROM raw_items
            WHERE NOT quantity > 0
            UNION ALL SELECT 'order_items', 'unit_price', COUNT(*) FROM raw_items
            WHERE NOT unit_price > 0""",
        "fk_violations": f"WITH {_RAW_ALL} " + " UNION ALL ".join(
            f"SELECT '{child}' AS table_name, '{column}' AS column_name, "
            f"'{parent}' AS parent_table, COUNT(*) AS violations FROM {raw} "
            f"WHERE {column} NOT IN (SELECT {column} FROM raw_{parent})"
            for child, raw, column, parent in (
                ("orders", "raw_orders", "customer_id", "customers"),
                ("order_items", "raw_items", "order_id", "orders"),
                ("order_items", "raw_items", "product_id", "products"),
            )
        ),
        "table_counts": f"WITH {_RAW_ALL} " + " UNION ALL ".join(
            f"SELECT '{label}' AS table_name, COUNT(*) AS row_count FROM {table}"
            for label, table in (
                ("customers", "raw_customers"),
                ("products", "raw_products"),
                ("orders", "raw_orders"),
                ("order_items", "raw_items"),
            )
        ),
        "integrity_verdict": f"""
            WITH {_RAW_ALL}
            SELECT *, orphan_orders + orphan_items_order + orphan_items_product = 0 AS integrity_ok
            FROM ({_orphans("orphan_orders")}), ({_orphans("orphan_items_order")}),
                 ({_orphans("orphan_items_product")})""",
        "integrity_verdict_cleaned": f"""
            WITH {_JUDGED_ITEMS}
            SELECT *, orphan_orders + orphan_items_order + orphan_items_product = 0 AS integrity_ok
            FROM (SELECT COUNT(*) AS orphan_orders FROM clean_orders
                  WHERE customer_id NOT IN (SELECT customer_id FROM raw_customers)),
                 (SELECT COUNT(*) AS orphan_items_order FROM clean_items
                  WHERE order_id NOT IN (SELECT order_id FROM clean_orders)),
                 (SELECT COUNT(*) AS orphan_items_product FROM clean_items
                  WHERE product_id NOT IN (SELECT product_id FROM clean_products))""",
        "inject_nulls": f"""
            WITH {_CONTACTS}
            SELECT customer_id,
                   CASE WHEN NOT {_hit("customer_id", "email", 0.05)} THEN email END AS email,
                   CASE WHEN NOT {_hit("customer_id", "phone", 0.04)} THEN phone END AS phone
            FROM contacts""",
        "inject_null_categories": f"""
            SELECT p_partkey AS product_id,
                   CASE WHEN NOT {_hit("p_partkey", "category", 0.04)} THEN p_type END AS category
            FROM part""",
        "inject_case_noise": f"""
            WITH {_CONTACTS}
            SELECT customer_id,
                   CASE WHEN {_hit("customer_id", "name", 0.03)} THEN '  ' || upper(name) || '  '
                        ELSE name END AS name,
                   CASE WHEN {_hit("customer_id", "shout", 0.02)} THEN upper(email)
                        ELSE email END AS email
            FROM contacts""",
        "inject_duplicates": f"""
            WITH {_CONTACTS}
            SELECT * FROM contacts UNION ALL
            (SELECT * FROM contacts ORDER BY md5(customer_id || ':copy') LIMIT 15)""",
        "inject_duplicate_orders": f"""
            SELECT {_ORDER_COLUMNS} FROM orders UNION ALL
            (SELECT {_ORDER_COLUMNS} FROM orders ORDER BY md5(o_orderkey || ':copy') LIMIT 20)""",
        "inject_duplicate_items": f"""
            WITH lines AS (
                SELECT l_orderkey AS order_id, l_linenumber AS line_number, l_partkey AS product_id,
                       l_suppkey AS supplier_id, CAST(l_quantity AS INTEGER) AS quantity,
                       l_extendedprice AS unit_price, {_LINE_KEY} AS k
                FROM lineitem
            )
            SELECT * EXCLUDE (k) FROM lines UNION ALL
            (SELECT * EXCLUDE (k) FROM lines ORDER BY md5(k || ':copy') LIMIT 25)""",
        "inject_orphans": f"""
            SELECT o_orderkey AS order_id, o_orderdate AS order_date, o_orderstatus AS status,
                   o_custkey + CASE WHEN {_hit("o_orderkey", "customer", 0.02)}
                                    THEN 1000000000000 ELSE 0 END AS customer_id
            FROM orders""",
        "inject_orphan_items": f"""
            SELECT l_orderkey + CASE WHEN {_hit(_LINE_KEY, "order", 0.01)}
                                     THEN 1000000000000 ELSE 0 END AS order_id,
                   l_linenumber AS line_number,
                   l_partkey + CASE WHEN {_hit(_LINE_KEY, "product", 0.015)}
                                    THEN 1000000000000 ELSE 0 END AS product_id,
                   l_suppkey AS supplier_id, CAST(l_quantity AS INTEGER) AS quantity,
                   l_extendedprice AS unit_price
            FROM lineitem""",
        "inject_bad_dates": f"""
            SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS status,
                   CASE WHEN {_hit("o_orderkey", "unparseable", 0.015)} THEN 'not_a_date'
                        WHEN {_hit("o_orderkey", "blank", 0.01)} THEN ''
                        WHEN {_hit("o_orderkey", "future", 0.015)} THEN '{FUTURE_TEXT}'
                        ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS order_date
            FROM orders""",
        "inject_bad_numbers": f"""
            SELECT p_partkey AS product_id,
                   CASE WHEN {_hit("p_partkey", "zero", 0.02)} THEN 0.0
                        WHEN {_hit("p_partkey", "negative", 0.02)} THEN -p_retailprice
                        ELSE p_retailprice END AS price
            FROM part""",
        "inject_bad_lines": f"""
            SELECT l_orderkey AS order_id, l_linenumber AS line_number, l_partkey AS product_id,
                   l_suppkey AS supplier_id,
                   CAST(CASE WHEN {_hit(_LINE_KEY, "quantity", 0.015)} THEN -l_quantity
                             ELSE l_quantity END AS INTEGER) AS quantity,
                   CASE WHEN NOT {_hit(_LINE_KEY, "price", 0.01)} THEN l_extendedprice END
                       AS unit_price
            FROM lineitem""",
        "price_lookup_default": f"""
            WITH {_RAW_PRODUCTS}, {_RAW_ITEMS}
            SELECT order_id, line_number, product_id, quantity,
                   COALESCE(price, 0.0) AS list_price
            FROM raw_items LEFT JOIN raw_products USING (product_id)""",
        "sampled_rows": f"""
            SELECT {_ORDER_COLUMNS} FROM orders
            ORDER BY md5(o_orderkey || ':sample') LIMIT {SAMPLE_SIZE}""",
    }
    sql |= {
        "revenue_by_customer_filtered": sql["revenue_by_customer"],
        "revenue_by_category_filtered": sql["revenue_by_category"],
        "top_customers_ltv_20_split": sql["top_customers_ltv_20"],
        "sampled_rows_split": sql["sampled_rows"],
    }
    for name in _ORPHANS:
        sql[name] = f"WITH {_RAW_ALL} {_orphans(name)}"
    return sql
