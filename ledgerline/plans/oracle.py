"""DuckDB SQL twins of the registered queries.

Written from the column contract of the models, not from the Spark code: the
tables are declared column by column, the four reports share one definition
of the sales measures, and the check lists and tier bounds are spelled out
here, so that an entry missing from the code shows as a difference.
"""

from __future__ import annotations

# --- the models, column by column ---------------------------------------------------

MONEY = "DECIMAL(28,2)"
AVERAGE = "DECIMAL(18,2)"

TABLES: dict[str, tuple[dict[str, str], str]] = {
    "stg_customers": ({
        "customer_id": "c_custkey::BIGINT",
        "customer_name": "c_name",
        "email": "lower(c_name || '@Example.com')",
        "country": "upper(n_name)",
        "signup_date": "first_day::DATE",
    }, "customer LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN (SELECT o_custkey AS k, "
       "min(o_orderdate) AS first_day FROM orders GROUP BY ALL) ON k = c_custkey"),
    "stg_products": ({
        "product_id": "p_partkey::BIGINT",
        "product_name": "p_name",
        "category": "p_type",
        "unit_price": "p_retailprice::DECIMAL(10,2)",
        "stock_qty": "p_size::BIGINT",
    }, "part"),
    "stg_orders": ({
        "order_id": "l_orderkey::BIGINT",
        "customer_id": "o_custkey::BIGINT",
        "product_id": "l_partkey::BIGINT",
        "quantity": "l_quantity::BIGINT",
        "order_date": "o_orderdate::DATE",
        "status": "lower(o_orderstatus)",
    }, "lineitem JOIN orders ON o_orderkey = l_orderkey"),
    "orders_enriched": ({
        **{c: c for c in ("order_id", "order_date", "status", "quantity", "customer_id",
                          "customer_name", "email", "country", "signup_date", "product_id",
                          "product_name", "category", "unit_price")},
        "line_total": f"(unit_price * quantity)::{MONEY}",
        "days_since_signup": "order_date - signup_date",
        "order_month": "month(order_date)::INTEGER",
        "order_year": "year(order_date)::INTEGER",
    }, "stg_orders JOIN stg_customers USING (customer_id) JOIN stg_products USING (product_id)"),
}


def sales(orders: str, units: str, revenue: str) -> dict[str, str]:
    """The measures of every report: distinct orders, units, revenue, and revenue
    per order, a double quotient rounded to cents."""
    return {
        orders: "count(DISTINCT order_id)",
        units: "sum(quantity)::BIGINT",
        revenue: f"sum(line_total)::{MONEY}",
        "avg_order_value": f"(sum(line_total) / count(DISTINCT order_id))::{AVERAGE}",
    }


SOLD = sales("num_orders", "units_sold", "total_revenue")
REPORTS: dict[str, tuple[dict[str, str], str]] = {
    "rpt_revenue_by_country": (
        {"country": "country", "year": "order_year", "month": "order_month", **SOLD},
        "orders_enriched GROUP BY ALL"),
    "rpt_revenue_by_category": (
        {"category": "category", **SOLD, "avg_unit_price": f"avg(unit_price)::{AVERAGE}",
         "num_products": "count(DISTINCT product_id)"},
        "orders_enriched GROUP BY ALL"),
    "rpt_customer_summary": (
        {**{c: c for c in ("customer_id", "customer_name", "email", "country")},
         **sales("total_orders", "total_units", "total_spend"),
         "first_order_date": "min(order_date)", "last_order_date": "max(order_date)",
         "days_as_customer": "max(order_date) - min(order_date)"},
        "orders_enriched GROUP BY ALL"),
    "product_sales": (
        {**{c: c for c in ("product_id", "product_name", "category", "unit_price")}, **SOLD},
        "orders_enriched GROUP BY ALL"),
    "rpt_product_performance": (
        {"product_id": "product_id",
         **{c: f"product_sales.{c}" for c in ("product_name", "category", "unit_price", *SOLD)},
         "stock_remaining": "stock_qty",
         "original_stock_estimate": "(units_sold + stock_qty)::BIGINT"},
        "product_sales JOIN stg_products USING (product_id)"),
}


def _ctes(models: dict[str, tuple[dict[str, str], str]]) -> str:
    return ",\n".join(
        f"{name} AS (SELECT {', '.join(f'{e} AS {c}' for c, e in columns.items())} FROM {source})"
        for name, (columns, source) in models.items())


MODELS = _ctes({**TABLES, **REPORTS})


def with_models(body: str, extra: str = "") -> str:
    """``body`` after the models (unused ones cost nothing) and ``extra``."""
    return f"WITH {MODELS}{',' + extra if extra else ''}\n{body}"


def union(parts) -> str:
    return with_models("\nUNION ALL\n".join(parts))


ORACLE: dict[str, str] = {name: with_models(f"SELECT * FROM {name}") for name in (
    *TABLES, *(r for r in REPORTS if r.startswith("rpt_")))}

# --- analytics ------------------------------------------------------------------------

ORACLE |= {
    "source_profile": with_models("""
SELECT count(*) AS total_orders,
       count(DISTINCT customer_id) AS unique_customers,
       count(DISTINCT product_id) AS unique_products,
       min(order_date) AS earliest_order,
       max(order_date) AS latest_order
FROM stg_orders"""),
    "table_counts": union(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM stg_{t}"
                          for t in ("customers", "products", "orders")),
    "monthly_trend": with_models(f"""
SELECT year, month, printf('%d-%02d', year, month) AS period,
       sum(num_orders)::BIGINT AS total_orders, sum(total_revenue)::{MONEY} AS total_revenue
FROM rpt_revenue_by_country GROUP BY ALL"""),
    "country_totals": with_models(f"""
SELECT country, sum(total_revenue)::{MONEY} AS total_revenue,
       sum(num_orders)::BIGINT AS total_orders
FROM rpt_revenue_by_country GROUP BY ALL"""),
    "newest_month": with_models("""
SELECT * FROM rpt_revenue_by_country
WHERE year * 100 + month = (SELECT max(order_year * 100 + order_month) FROM orders_enriched)"""),
    "top_customers": with_models("""
SELECT * FROM rpt_customer_summary ORDER BY total_spend DESC NULLS LAST, customer_id LIMIT 10"""),
    "category_share": with_models("""
SELECT category, total_revenue,
       total_revenue::DOUBLE * 100 / (sum(total_revenue) OVER ())::DOUBLE AS revenue_share_pct
FROM rpt_revenue_by_category"""),
    "product_ranking": with_models("""
SELECT product_id, product_name, units_sold, total_revenue, num_orders
FROM rpt_product_performance"""),
    "customers_by_spend": with_models("""
SELECT customer_name, total_spend FROM rpt_customer_summary"""),
    "orders_preview": with_models("""
SELECT * FROM orders_enriched ORDER BY order_id, product_id, quantity LIMIT 15"""),
}

# Tier bounds: (above, up to and including, label).
TIERS = ((0, 500, "< 500"), (500, 2000, "500 - 2k"), (2000, 5000, "2k - 5k"),
         (5000, None, "5k+"))
WIDE_TIERS = ((0, 500_000, "< 500k"), (500_000, 1_000_000, "500k - 1M"),
              (1_000_000, 2_000_000, "1M - 2M"), (2_000_000, None, "2M+"))


def _tiers(bounds) -> str:
    return "tiers(tier_order, above, upto, label) AS (VALUES " + ", ".join(
        f"({i}, {a}, {'NULL::BIGINT' if b is None else b}, '{label}')"
        for i, (a, b, label) in enumerate(bounds)) + ")"


_IN_TIER = "total_spend > above AND (upto IS NULL OR total_spend <= upto)"
ORACLE["customer_tiers"] = with_models(f"""
SELECT customer_id, customer_name, total_orders, total_spend, label AS spend_tier
FROM rpt_customer_summary LEFT JOIN tiers ON {_IN_TIER}""", _tiers(TIERS))
for _name, _bounds in (("tier_counts", TIERS), ("tier_counts_wide", WIDE_TIERS)):
    ORACLE[_name] = with_models(f"""
SELECT tier_order, label AS spend_tier, count(total_spend) AS customers,
       count(total_spend)::DOUBLE * 100 / nullif(sum(count(total_spend)) OVER (), 0)::DOUBLE
         AS share_pct
FROM tiers LEFT JOIN rpt_customer_summary ON {_IN_TIER}
GROUP BY tier_order, label""", _tiers(_bounds))

# --- display orders, as positions -------------------------------------------------------

for _name, _source, _keys, _order in (
        ("country_in_order", "rpt_revenue_by_country", "country, year, month",
         "year, month, country"),
        ("category_in_order", "rpt_revenue_by_category", "category, total_revenue",
         "total_revenue DESC, category"),
        ("customers_in_order", "rpt_customer_summary", "customer_id, total_spend",
         "total_spend DESC, customer_id"),
        ("products_in_order", "rpt_product_performance", "product_id, total_revenue",
         "total_revenue DESC, product_id")):
    ORACLE[_name] = with_models(
        f"SELECT {_keys}, row_number() OVER (ORDER BY {_order}) AS position FROM {_source}")
ORACLE["mart_in_order"] = with_models("""
SELECT order_id, product_id, quantity,
       row_number() OVER (ORDER BY order_id, product_id, quantity) AS position
FROM orders_enriched""")
ORACLE["months_in_order"] = with_models("""
SELECT year, month, row_number() OVER (ORDER BY year, month) AS position
FROM rpt_revenue_by_country GROUP BY year, month""")
ORACLE["countries_in_order"] = with_models("""
SELECT country, row_number() OVER (ORDER BY sum(total_revenue) DESC, country) AS position
FROM rpt_revenue_by_country GROUP BY country""")

# --- data quality -----------------------------------------------------------------------

# Where the raw tables come from, as (source, key column) of the names in
# the checks, and the declared checks themselves.
RAW = {"customers.customer_id": ("customer", "c_custkey"),
       "products.product_id": ("part", "p_partkey"),
       "order_lines.order_id": ("lineitem", "l_orderkey"),
       "order_headers.order_id": ("orders", "o_orderkey"),
       "products.unit_price": ("part", "p_retailprice")}
NOT_NULL = (
    "customers.customer_id", "products.product_id", "order_lines.order_id",
    "order_headers.order_id", "stg_customers.customer_id", "stg_products.product_id",
    "stg_orders.order_id", "orders_enriched.order_id", "rpt_revenue_by_country.country",
    "rpt_revenue_by_country.year", "rpt_revenue_by_country.month",
    "rpt_revenue_by_country.total_revenue", "rpt_revenue_by_category.category",
    "rpt_revenue_by_category.total_revenue", "rpt_revenue_by_category.units_sold",
    "rpt_customer_summary.customer_id", "rpt_customer_summary.customer_name",
    "rpt_customer_summary.total_spend", "rpt_customer_summary.total_orders",
    "rpt_product_performance.product_id", "rpt_product_performance.product_name",
    "rpt_product_performance.total_revenue", "rpt_product_performance.stock_remaining")
UNIQUE = ("order_headers.order_id", "stg_customers.customer_id", "stg_products.product_id",
          "rpt_revenue_by_category.category", "rpt_customer_summary.customer_id",
          "rpt_product_performance.product_id")
POSITIVE = ("products.unit_price",)
POSITIVE_NOT_NULL = (
    "orders_enriched.line_total", "rpt_customer_summary.total_spend",
    "rpt_revenue_by_category.total_revenue", "rpt_product_performance.total_revenue",
    "rpt_revenue_by_country.total_revenue")
MINIMUM = {"orders_enriched": 18, "rpt_revenue_by_country": 1, "rpt_revenue_by_category": 1,
           "rpt_customer_summary": 8, "rpt_product_performance": 8}


def _row(check: str, where: str, count: str) -> str:
    table, column = where.split(".", 1)
    return (f"SELECT '{check}' AS check_name, '{table}' AS table_name, "
            f"'{column}' AS column_name, ({count})::BIGINT AS failing_rows")


def _counted(check: str, places, condition: str) -> list[str]:
    out = []
    for place in places:
        table, column = RAW.get(place, place.split("."))
        out.append(_row(check, place, f"SELECT count(*) FROM {table} WHERE "
                        + condition.format(c=column)))
    return out


def _repeated(place: str) -> str:
    table, column = RAW.get(place, place.split("."))
    return _row("unique", place, f"SELECT count(*) FROM (SELECT {column} FROM {table} WHERE "
                f"{column} IS NOT NULL GROUP BY {column} HAVING count(*) > 1)")


_NOT_NULL = _counted("not_null", NOT_NULL, "{c} IS NULL")
_UNIQUE = [_repeated(p) for p in UNIQUE]
_POSITIVE = (_counted("positive", POSITIVE, "{c} <= 0")
             + _counted("positive_not_null", POSITIVE_NOT_NULL, "{c} <= 0 OR {c} IS NULL"))
_ORPHANS = [
    _row("orphan:order_headers", "order_lines.order_id",
         "SELECT count(*) FROM lineitem WHERE l_orderkey NOT IN "
         "(SELECT o_orderkey FROM orders WHERE o_orderkey IS NOT NULL)"),
    *(_row(f"orphan:{dim}", f"stg_orders.{key}",
           f"SELECT count(*) FROM stg_orders ANTI JOIN {dim} USING ({key}) WHERE {key} IS NOT NULL")
      for dim, key in (("stg_customers", "customer_id"), ("stg_products", "product_id"))),
    _row("fk_not_null", "orders_enriched.customer_id|product_id",
         "SELECT count(*) FROM orders_enriched WHERE customer_id IS NULL OR product_id IS NULL"),
]
ORACLE["dq_not_null"] = union(_NOT_NULL)
ORACLE["dq_unique"] = union(_UNIQUE)
ORACLE["dq_positive"] = union(_POSITIVE)
ORACLE["dq_orphans"] = union(_ORPHANS)
ORACLE["dq_row_counts"] = union(
    f"SELECT '{t}' AS table_name, count(*) AS row_count, {n}::BIGINT AS min_rows, "
    f"count(*) >= {n} AS passed FROM {t}" for t, n in MINIMUM.items())

# --- files and published tables -----------------------------------------------------------

EVERY_TABLE = ("benchmark", "conversations", "customer", "documents", "embeddings", "events",
               "labels", "lineitem", "nation", "orders", "pages", "part", "region", "supplier")
PUBLISHED = ("orders_enriched", "rpt_revenue_by_country", "rpt_revenue_by_category",
             "rpt_customer_summary", "rpt_product_performance")
# The second versions hold part of the first ones' rows.
SECOND = {"rpt_revenue_by_country": "month <= 6", "rpt_revenue_by_category": "num_orders % 2 = 0"}


def _newest(table: str) -> str:
    return f"{table} WHERE {SECOND[table]}" if table in SECOND else table


ORACLE |= {
    "parquet_roundtrip": ORACLE["orders_enriched"],
    "csv_roundtrip": ORACLE["stg_products"],
    "csv_customers": ORACLE["stg_customers"],
    "csv_orders": ORACLE["stg_orders"],
    "publish_roundtrip": ORACLE["rpt_customer_summary"],
    "read_as_of": ORACLE["rpt_revenue_by_country"],
    "read_newest": with_models(f"SELECT * FROM {_newest('rpt_revenue_by_country')}"),
    "extract_report": "\nUNION ALL\n".join(
        f"SELECT 'dbo' AS schema_name, '{t}' AS table_name, count(*) AS row_count, "
        f"'ok' AS status FROM {t}" for t in EVERY_TABLE),
    "file_profile": "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, (SELECT count(*) FROM {t}) AS row_count, "
        f"count(*)::INTEGER AS column_count, "
        f"string_agg(column_name, ', ' ORDER BY column_name) AS columns "
        f"FROM (DESCRIBE SELECT * FROM {t})" for t in EVERY_TABLE),
    "publish_report": union([
        f"SELECT '{t}' AS table_name, {v}::BIGINT AS snapshot_id, count(*) AS written_rows, "
        f"count(*) AS verified_rows, 'ok' AS status FROM {source}"
        for v, t, source in [*((1, t, t) for t in PUBLISHED),
                             *((2, t, _newest(t)) for t in SECOND)]]),
    "published_tables": union(
        f"SELECT 'default' AS namespace, '{t}' AS table_name, "
        f"{2 if t in SECOND else 1}::BIGINT AS snapshot_id, "
        f"(SELECT count(*) FROM {_newest(t)}) AS total_records, "
        f"(SELECT count(*) FROM (DESCRIBE SELECT * FROM {t}))::INTEGER AS column_count"
        for t in PUBLISHED),
    "store_counts": union(
        f"SELECT '{t}' AS table_name, a AS left_rows, b AS right_rows, a = b AS matched "
        f"FROM (SELECT count(*) AS a FROM {t}), (SELECT count(*) AS b FROM {_newest(t)})"
        for t in PUBLISHED),
    "snapshot_history": union(
        f"SELECT 'rpt_revenue_by_category' AS table_name, {v}::BIGINT AS snapshot_id, "
        f"{p}::BIGINT AS parent_id, 'overwrite' AS operation, count(*) AS added_records, "
        f"count(*) AS total_records, {later}::BOOLEAN AS after_parent FROM {source}"
        for v, p, later, source in (
            (1, "NULL", "NULL", "rpt_revenue_by_category"),
            (2, "1", "true", _newest("rpt_revenue_by_category")))),
    "schema_report": with_models(f"""
SELECT 'orders_enriched' AS table_name,
       list_position({list(TABLES["orders_enriched"][0])}, column_name)::INTEGER AS position,
       column_name,
       CASE column_type WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string'
            ELSE lower(replace(column_type, ' ', '')) END AS data_type,
       "null" = 'YES' AS nullable, null_rows
FROM (DESCRIBE SELECT * FROM orders_enriched) JOIN lacking USING (column_name)""",
                                 "lacking AS (" + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_rows FROM orders_enriched"
        for c in TABLES["orders_enriched"][0]) + ")"),
}
ORACLE |= {
    "stored_view": ORACLE["stg_products"],
    "published_trend": with_models(f"""
SELECT year, month, printf('%d-%02d', year, month) AS period,
       sum(num_orders)::BIGINT AS total_orders, sum(total_revenue)::{MONEY} AS total_revenue
FROM {_newest("rpt_revenue_by_country")} GROUP BY ALL"""),
    "whole_run": union(
        f"SELECT '{t}' AS table_name, count(*) AS left_rows, count(*) AS right_rows, "
        f"true AS matched FROM {t}" for t in PUBLISHED),
}
ORACLE["dq_suite"] = union([
    *(_row("required_columns", f"{t}.*", "SELECT 0")
      for t in ("customers", "products", "orders")),
    *_NOT_NULL, *_POSITIVE, *_UNIQUE, *_ORPHANS,
    *(_row("min_rows", f"{t}.*", f"SELECT greatest(0, {n} - count(*)) FROM {t}")
      for t, n in MINIMUM.items()),
    _row("exact_rows", "stg_products.*", "SELECT abs((SELECT count(*) FROM part) - count(*)) "
         "FROM stg_products"),
    *(_row("table_exists", f"{t}.*", "SELECT 0") for t in PUBLISHED),
    *(_row("store_rows", f"{t}.*", f"SELECT abs((SELECT count(*) FROM {t}) - count(*)) "
           f"FROM {_newest(t)}") for t in PUBLISHED),
])
