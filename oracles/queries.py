"""Expected rows of the registered queries, by query name."""

from __future__ import annotations

from oracles.sql import LINE_AMOUNT, cents, date_key, identity, money, ratio, region, row_hash, sql

DELTA_FROM = 20180101
FACT_ITEM = (
    "order_id, order_item_id, customer_key, product_key, seller_key, order_date_key, quantity, price, freight_value, "
    "total_item_value, is_out_of_stock"
)
# Counts as the validation lists them.
COUNTED = [
    "dim_date",
    "dim_customer",
    "dim_seller",
    "dim_product",
    "dim_payment_type",
    "dim_order_status",
    "dim_geolocation",
    "fact_order_items",
    "fact_orders",
    "fact_reviews",
    "fact_payments",
    "agg_monthly_sales",
]
ROW_COUNTS = " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in COUNTED)
# The tables are counted in the order of the load.
STEP = f"CAST(list_position({COUNTED}, table_name) AS INTEGER) AS step"
LOADED = """
    SELECT 'customer' AS table_name, count(*) AS actual FROM customer
    UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'part', count(*) FROM part
    UNION ALL SELECT 'supplier', count(*) FROM supplier UNION ALL SELECT 'lineitem', count(*) FROM lineitem
    UNION ALL SELECT 'returned_orders', 0"""
RECORDED = f"""
    SELECT table_name, actual - CASE WHEN table_name = 'lineitem' THEN 1 ELSE 0 END AS recorded
    FROM ({LOADED}) WHERE table_name NOT IN ('part', 'returned_orders')"""


def decisions(forced: str) -> str:
    return f"""
        SELECT c.table_name, actual, recorded,
               CASE WHEN recorded IS NOT NULL AND recorded = actual AND NOT ({forced}) THEN 'skip'
                    WHEN actual > 0 THEN 'reload' ELSE 'load' END AS action
        FROM ({LOADED}) c LEFT JOIN ({RECORDED}) m ON c.table_name = m.table_name"""


def keyed_counts(name: str, key: str, source: str, errors: str = "false") -> str:
    return f"""SELECT '{name}' AS table_name, count(DISTINCT ({key})) FILTER (NOT ({errors})) AS loaded,
        count(*) FILTER (NOT ({errors})) - count(DISTINCT ({key})) FILTER (NOT ({errors})) AS duplicates,
        count(*) FILTER ({errors}) AS errors FROM {source}"""


def joined_lines(key: str) -> str:
    return f"""fact_order_items f LEFT JOIN fact_reviews r ON f.order_id = r.order_id AND f.{key} = r.{key}"""


def scores(row: str, decimal: str = "DECIMAL(3,2)") -> str:
    return ratio(f"coalesce(sum({row}), 0)", f"count({row})", decimal)


def check(position: int, name: str, expected: str, found: str, details: str) -> str:
    passed = "n > 0" if expected == "> 0" else "n = 0"
    return f"""SELECT CAST({position} AS BIGINT) AS validation_result_id, CAST(1 AS BIGINT) AS etl_run_id,
        '{name}' AS validation_name, CASE WHEN {passed} THEN 'OK' ELSE 'ERROR' END AS validation_status,
        '{expected}' AS expected_value, CAST(n AS VARCHAR) AS actual_value, '{details}' AS details FROM ({found})"""


CHECKS = " UNION ALL ".join(
    check(*c)
    for c in [
        (
            1,
            "fact_orders is not empty",
            "> 0",
            "SELECT count(*) AS n FROM fact_orders",
            "Tabela fact_orders powinna zawierać załadowane zamówienia.",
        ),
        (
            2,
            "fact_order_items is not empty",
            "> 0",
            "SELECT count(*) AS n FROM fact_order_items",
            "Tabela fact_order_items powinna zawierać pozycje zamówień.",
        ),
        (
            3,
            "agg_monthly_sales is not empty",
            "> 0",
            "SELECT count(*) AS n FROM agg_monthly_sales",
            "Tabela agregująca powinna być zasilona po ETL.",
        ),
        (
            4,
            "missing customer keys in fact_orders",
            "0",
            "SELECT count(*) AS n FROM fact_orders WHERE customer_key NOT IN (SELECT customer_key FROM dim_customer)",
            "Sprawdzenie, czy fact_orders ma poprawne klucze klientów.",
        ),
        (
            5,
            "missing product keys in fact_order_items",
            "0",
            "SELECT count(*) AS n FROM fact_order_items WHERE product_key NOT IN (SELECT product_key FROM dim_product)",
            "Sprawdzenie, czy fact_order_items ma poprawne klucze produktów.",
        ),
        (
            6,
            "duplicate product business keys",
            "0",
            "SELECT count(*) AS n FROM (SELECT product_id FROM dim_product GROUP BY ALL HAVING count(*) > 1)",
            "Sprawdzenie duplikatów product_id w dim_product.",
        ),
    ]
)
RUN = """SELECT CAST({run} AS BIGINT) AS etl_run_id, 'manual_validation_after_etl' AS run_name,
    CASE WHEN EXISTS (SELECT 1 FROM ({checks}) WHERE validation_status = 'ERROR') THEN 'FINISHED_WITH_ERRORS'
         ELSE 'SUCCESS' END AS status"""

ORACLES: dict[str, str] = {
    "csv_scan": """
        SELECT product_id, category AS product_category_name, name_length AS product_name_lenght,
               description_length AS product_description_lenght, photos AS product_photos_qty, weight AS product_weight_g,
               length_cm AS product_length_cm, height_cm AS product_height_cm, width_cm AS product_width_cm
        FROM st_products""",
    "csv_free_text_scan": """
        SELECT review_id, order_id, review_score,
               CASE WHEN review_score > 1 THEN 'score "' || CAST(review_score AS VARCHAR) || '",' || chr(10)
                    || 'second line of ' || order_id
                    || CASE WHEN review_score > 3 THEN chr(10) || chr(10) || '"end' ELSE '' END
               END AS review_comment_message,
               created AS review_creation_date, answered AS review_answer_timestamp
        FROM delivered_reviews""",
    "csv_lone_quotes": """
        SELECT review_id, order_id, review_score, CAST(review_score AS VARCHAR) || '" shelf of ' || order_id AS review_comment_message,
               created AS review_creation_date, answered AS review_answer_timestamp
        FROM delivered_reviews""",
    "null_tokens": """
        SELECT CAST(p_partkey AS VARCHAR) AS part_id,
               CASE WHEN p_partkey % 7 = 0 OR p_partkey % 11 = 0 THEN NULL ELSE p_name END AS part_name, p_brand
        FROM part""",
    "typed_load_rejects": """
        SELECT order_id, payment_sequential,
               concat_ws(',', CASE WHEN payment_type = 'voucher' THEN 'payment_type' END,
                         CASE WHEN CAST(order_id AS BIGINT) % 13 = 0 THEN 'payment_value' END) AS refused_columns
        FROM st_payments WHERE payment_type = 'voucher' OR CAST(order_id AS BIGINT) % 13 = 0""",
    "pk_dedup_first": """
        SELECT * FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity,
            l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) = 1""",
    "pk_first_in_file": """
        SELECT CAST(l_orderkey AS VARCHAR) AS order_id, 1 AS payment_sequential, CAST(l_linenumber AS INTEGER) AS payment_installments,
               CAST(l_extendedprice AS DECIMAL(10,2)) AS payment_value
        FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_extendedprice DESC) = 1""",
    "fk_reject": """
        SELECT order_id, customer_id, order_status FROM st_orders o
        WHERE NOT EXISTS (SELECT 1 FROM st_customers c
                          WHERE c.customer_id = o.customer_id AND customer_city <> 'MACHINERY')""",
    "staging_chain": """
        SELECT review_id, order_id, review_score, (SELECT count(*) FROM reviews_kept) AS loaded,
               (SELECT count(*) FROM reviews_checked WHERE good) - (SELECT count(*) FROM reviews_kept) AS duplicates,
               (SELECT count(*) FROM reviews_checked WHERE NOT good) AS errors
        FROM reviews_kept""",
    "load_summary": " UNION ALL ".join(
        [
            keyed_counts("customers", "customer_id", "st_customers"),
            keyed_counts("geolocation", "zip, lat, lng", "delivered_geolocation"),
            keyed_counts("order_items", "l_orderkey, l_linenumber", "lineitem"),
            keyed_counts(
                "order_payments",
                "order_id, payment_sequential",
                "st_payments",
                "payment_type = 'voucher' OR CAST(order_id AS BIGINT) % 13 = 0",
            ),
            keyed_counts("order_reviews", "review_id", "delivered_reviews"),
        ]
    ),
    "load_manifest": decisions("false"),
    "selective_reload": decisions("c.table_name IN ('orders', 'supplier')"),
    "manifest_bootstrap": f"""
        SELECT table_name, recorded FROM ({RECORDED}) WHERE table_name <> 'supplier'
        UNION ALL SELECT table_name, actual FROM ({LOADED}) WHERE table_name = 'part' AND actual > 0""",
    "rate_payload_json": "SELECT * FROM observed_rates",
    "rate_payload_rejects": """
        SELECT fetched_at, CASE WHEN second(fetched_at) >= 18 THEN currency_code END AS currency_code,
               CASE WHEN second(fetched_at) >= 18 THEN rate_value END AS rate_value,
               CASE WHEN second(fetched_at) < 6 THEN 'currency_code,rate_date,rate_value'
                    WHEN second(fetched_at) < 12 THEN 'rate_date,rate_value'
                    WHEN second(fetched_at) < 18 THEN 'rate_value' END AS missing
        FROM observed_rates""",
    "merge_upsert": "SELECT * FROM rates",
    "retire_current": """
        SELECT * REPLACE (CASE WHEN currency_code = 'BRL' THEN 0 ELSE is_current END AS is_current) FROM rates""",
    "append_defaults": f"""
        SELECT {identity('customer_id')} AS customer_key, customer_id, 'Regular' AS customer_segment, 1 AS has_timestamps
        FROM st_customers WHERE customer_city <> 'MACHINERY'
        UNION ALL
        SELECT (SELECT count(*) FROM st_customers WHERE customer_city <> 'MACHINERY') + {identity('customer_id')},
               customer_id, 'Regular', 1
        FROM st_customers WHERE customer_city = 'MACHINERY'""",
    "warehouse_load": f"SELECT table_name, row_count, {STEP}, 'built' AS action FROM ({ROW_COUNTS})",
    "load_fails_half_way": f"SELECT table_name, row_count, true AS unchanged FROM ({ROW_COUNTS})",
    "skip_if_loaded": f"""
        SELECT table_name, row_count, {STEP},
               CASE WHEN table_name = 'agg_monthly_sales' THEN 'built' ELSE 'skipped' END AS action
        FROM ({ROW_COUNTS})""",
    "surrogate_keys": f"SELECT {identity('order_id')} AS order_key, order_id, order_status FROM st_orders",
    "date_key": f"""
        SELECT order_id, {date_key('bought')} AS order_date_key, {date_key('delivered')} AS delivery_date_key,
               CAST((dayofyear(bought) - 1 + dayofweek(date_trunc('year', bought))) // 7 + 1 AS INTEGER) AS order_week
        FROM st_orders""",
    "region_map": f"SELECT customer_id, customer_state, {region('customer_state')} AS region_name FROM st_customers",
    "dim_date": f"""
        SELECT d.*, (SELECT count(*) FROM st_orders WHERE {date_key('bought')} = d.date_key) AS orders_bought
        FROM dim_date d""",
    "dim_customer": "SELECT * FROM dim_customer",
    "dim_seller": "SELECT * FROM dim_seller",
    "dim_product": "SELECT * FROM dim_product",
    "dim_payment_type": """
        SELECT t.*, (SELECT count(*) FROM st_payments WHERE payment_type = t.payment_type_code) AS payments
        FROM dim_payment_type t""",
    "dim_order_status": """
        SELECT s.*, (SELECT count(*) FROM st_orders WHERE order_status = s.status_code) AS orders
        FROM dim_order_status s""",
    "dim_geolocation": "SELECT * FROM dim_geolocation",
    "first_item": "SELECT * FROM first_item",
    "fact_order_items": "SELECT * FROM fact_order_items",
    "fact_orders": "SELECT * FROM fact_orders",
    "fact_orders_quarantine": """
        SELECT * FROM order_rows WHERE order_id NOT IN (SELECT order_id FROM fact_orders)""",
    "fact_reviews": "SELECT * FROM fact_reviews",
    "fact_payments": "SELECT * FROM fact_payments",
    "agg_monthly_sales": "SELECT * FROM agg_monthly_sales",
    "scd2_hash": "SELECT product_id, scd_hash FROM scd2_initial",
    "scd2_initial": """
        SELECT row_number() OVER (ORDER BY substr(md5(product_id || '|1900-01-01 00:00:00'), 1, 4), product_id)
                   AS product_scd_key, *
        FROM scd2_initial""",
    "scd2_changes": f"""
        SELECT *, {row_hash()} AS scd_hash
        FROM (SELECT product_id, coalesce(category_name_pt, 'unknown') || '_SCD_DEMO' AS category_name_pt,
                     coalesce(category_name_en, 'unknown') || ' SCD Demo' AS category_name_en, product_weight_g,
                     product_length_cm, product_height_cm, product_width_cm, size_class
              FROM scd2_initial WHERE coalesce(category_name_pt, '') NOT LIKE '%_SCD_DEMO'
              ORDER BY product_id LIMIT 1)""",
    "scd2_close": "SELECT * FROM scd2_closed",
    "scd2_apply": """
        SELECT CASE WHEN year(valid_from) = 1900 THEN 0 ELSE (SELECT count(*) FROM dim_product) END
                   + row_number() OVER (PARTITION BY year(valid_from) = 1900
                         ORDER BY substr(md5(product_id || '|' || strftime(valid_from, '%Y-%m-%d %H:%M:%S')), 1, 4),
                                  product_id) AS product_scd_key, *
        FROM scd2_applied""",
    "scd2_history": """
        SELECT product_id, category_name_pt, category_name_en, valid_from, valid_to, is_current FROM scd2_applied
        WHERE product_id IN (SELECT product_id FROM scd2_applied GROUP BY product_id HAVING count(*) > 1
                             ORDER BY product_id LIMIT 5)
        ORDER BY product_id, valid_from LIMIT 20""",
    "scd2_counts": """
        SELECT count(*) AS all_scd2_rows, count(DISTINCT product_id) AS distinct_products,
               CAST(sum(is_current) AS BIGINT) AS current_rows, CAST(sum(1 - is_current) AS BIGINT) AS historical_rows
        FROM scd2_applied""",
    "delta_orders": f"""
        SELECT * FROM fact_orders f
        WHERE NOT EXISTS (SELECT 1 FROM fact_orders s WHERE s.order_id = f.order_id AND s.order_date_key < {DELTA_FROM})""",
    "delta_order_items": f"""
        SELECT {FACT_ITEM} FROM fact_order_items f
        WHERE NOT EXISTS (SELECT 1 FROM fact_order_items s WHERE s.order_id = f.order_id
                          AND s.order_item_id = f.order_item_id AND s.order_date_key < {DELTA_FROM})""",
    "delta_agg_refresh": "SELECT * FROM agg_monthly_sales",
    "latest_rate": "SELECT * FROM latest_rate",
    "orders_pln_view": "SELECT * FROM orders_pln",
    "global_ntile": "SELECT * FROM quartiles",
    "rpt_monthly_category": f"""
        SELECT year, month, category_name_en, CAST(sum(total_orders) AS BIGINT) AS total_orders,
               CAST(sum(total_items) AS BIGINT) AS total_items, {money('sum(total_revenue)')} AS total_revenue,
               {ratio(f"sum({cents('total_revenue')})", '100 * sum(total_orders)', 'DECIMAL(20,2)')} AS avg_order_value,
               CAST(sum(orders_delayed) AS BIGINT) AS delayed_orders
        FROM agg_monthly_sales GROUP BY year, month, category_name_en
        ORDER BY year, month, total_revenue DESC, category_name_en LIMIT 50""",
    "rpt_delay_by_region": f"""
        SELECT region_name, count(*) AS total_orders, CAST(sum(is_delayed) AS BIGINT) AS delayed_orders,
               {ratio('100 * sum(is_delayed)', 'count(*)', 'DECIMAL(5,2)')} AS delayed_percent,
               {scores('days_to_delivery', 'DECIMAL(10,2)')} AS avg_days_to_delivery,
               {money('sum(total_order_value)')} AS total_revenue
        FROM fact_orders f JOIN dim_customer c ON f.customer_key = c.customer_key GROUP BY region_name""",
    "rpt_seller_rank": f"""
        SELECT CAST(rank() OVER (ORDER BY total_revenue DESC) AS INTEGER) AS revenue_rank, *
        FROM (SELECT seller_id, seller_city, seller_state, region_name, count(DISTINCT f.order_id) AS total_orders,
                     {money(f'sum({LINE_AMOUNT})')} AS total_revenue, {scores('review_score')} AS avg_review_score
              FROM {joined_lines('seller_key')} JOIN dim_seller s ON f.seller_key = s.seller_key GROUP BY ALL)
        ORDER BY revenue_rank, seller_id LIMIT 20""",
    "rpt_payment_methods": f"""
        SELECT payment_type_name, payment_category, count(*) AS payment_records, count(DISTINCT order_id) AS paid_orders,
               {money('sum(payment_value)')} AS total_payment_value,
               {ratio(f"sum({cents('payment_value')})", '100 * count(*)', 'DECIMAL(10,2)')} AS avg_payment_value,
               {scores('payment_installments', 'DECIMAL(10,2)')} AS avg_installments
        FROM fact_payments f JOIN dim_payment_type t ON f.payment_type_key = t.payment_type_key GROUP BY ALL""",
    "rpt_category_quality": f"""
        SELECT category_name_en, count(DISTINCT f.order_id) AS total_orders,
               {money('sum(total_item_value)')} AS product_revenue, {money('sum(freight_value)')} AS freight_revenue,
               {scores('review_score')} AS avg_review_score,
               {ratio('100 * sum(is_heavy)', 'count(*)', 'DECIMAL(5,2)')} AS heavy_products_percent
        FROM {joined_lines('product_key')} JOIN dim_product p ON f.product_key = p.product_key
        GROUP BY category_name_en HAVING count(DISTINCT f.order_id) >= 20
        ORDER BY product_revenue DESC, category_name_en LIMIT 30""",
    "rpt_mom_revenue": f"""
        SELECT year, month_of_year, total_orders, monthly_revenue, previous_month_revenue,
               {ratio(f"100 * ({cents('monthly_revenue')} - {cents('previous_month_revenue')})",
                      cents('previous_month_revenue'), 'DECIMAL(20,2)')} AS revenue_mom_percent
        FROM (SELECT *, lag(monthly_revenue) OVER (ORDER BY year, month_of_year) AS previous_month_revenue
              FROM (SELECT year, month_of_year, {money('sum(total_order_value)')} AS monthly_revenue,
                           count(*) AS total_orders
                    FROM fact_orders f JOIN dim_date d ON f.order_date_key = d.date_key GROUP BY ALL))""",
    "rpt_category_share": f"""
        SELECT CAST(rank() OVER (ORDER BY total_revenue DESC) AS INTEGER) AS category_rank, category_name_en,
               total_orders, total_revenue,
               {ratio(f"100 * {cents('total_revenue')}", cents('whole'), 'DECIMAL(10,2)')} AS revenue_share_percent,
               {ratio(f"100 * {cents('running')}", cents('whole'), 'DECIMAL(10,2)')} AS cumulative_revenue_share_percent
        FROM (SELECT *, sum(total_revenue) OVER () AS whole,
                     sum(total_revenue) OVER (ORDER BY total_revenue DESC, category_name_en
                                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running
              FROM (SELECT coalesce(category_name_en, 'Unknown') AS category_name_en,
                           count(DISTINCT order_id) AS total_orders, {money(f'sum({LINE_AMOUNT})')} AS total_revenue
                    FROM fact_order_items f JOIN dim_product p ON f.product_key = p.product_key GROUP BY 1))
        ORDER BY category_rank, category_name_en LIMIT 30""",
    "rpt_customer_segments": f"""
        SELECT CASE WHEN monetary_quartile = 4 AND frequency_quartile >= 3 THEN 'High value'
                    WHEN monetary_quartile >= 3 THEN 'Medium value' ELSE 'Low value' END AS customer_segment,
               region_name, count(*) AS customers_count,
               {scores('orders_count', 'DECIMAL(10,2)')} AS avg_orders_count,
               {ratio(f"sum({cents('total_spent')})", '100 * count(*)', 'DECIMAL(20,2)')} AS avg_total_spent,
               {money('sum(total_spent)')} AS segment_revenue
        FROM quartiles GROUP BY 1, 2""",
    "rpt_delay_vs_rating": f"""
        SELECT CASE WHEN is_delayed = 1 THEN 'Delayed' ELSE 'On time / no delay' END AS delivery_status,
               count(DISTINCT f.order_id) AS orders_count,
               {scores('days_to_delivery', 'DECIMAL(10,2)')} AS avg_days_to_delivery,
               {scores('review_score')} AS avg_review_score, {money('sum(total_order_value)')} AS total_revenue
        FROM fact_orders f LEFT JOIN fact_reviews r ON f.order_id = r.order_id GROUP BY 1""",
    "rpt_orders_pln": """
        SELECT order_id, total_order_value_brl, brl_to_pln_rate, total_order_value_pln, exchange_rate_date
        FROM orders_pln ORDER BY total_order_value_pln DESC, order_id LIMIT 20""",
    "val_row_counts": ROW_COUNTS,
    "val_facts_nonempty": """
        SELECT CASE WHEN (SELECT count(*) FROM fact_orders) > 0 THEN 'OK' ELSE 'ERROR' END AS fact_orders_status,
               CASE WHEN (SELECT count(*) FROM fact_order_items) > 0 THEN 'OK' ELSE 'ERROR' END AS fact_order_items_status,
               CASE WHEN (SELECT count(*) FROM fact_payments) > 0 THEN 'OK' ELSE 'ERROR' END AS fact_payments_status""",
    "val_duplicate_keys": " UNION ALL ".join(
        f"""SELECT '{table}' AS table_name, {key} AS business_key, count(*) AS duplicated_count
            FROM {table} GROUP BY {key} HAVING count(*) > 1"""
        for table, key in (("dim_customer", "customer_id"), ("dim_product", "product_id"), ("dim_seller", "seller_id"))
    ),
    "val_missing_keys": """
        SELECT count(*) FILTER (customer_key IS NULL) AS missing_customer_key,
               count(*) FILTER (product_key IS NULL) AS missing_product_key,
               count(*) FILTER (seller_key IS NULL) AS missing_seller_key,
               count(*) FILTER (order_date_key IS NULL) AS missing_order_date_key
        FROM fact_order_items""",
    "val_revenue_recon": f"""
        SELECT a AS revenue_from_fact_items, b AS revenue_from_aggregate, {money('a - b')} AS difference
        FROM (SELECT (SELECT {money(f'sum({LINE_AMOUNT})')} FROM fact_order_items) AS a,
                     (SELECT {money('sum(total_revenue)')} FROM agg_monthly_sales) AS b)""",
    "val_orphan_customers": """
        SELECT count(*) AS orphan_rows FROM fact_orders f LEFT JOIN dim_customer c ON f.customer_key = c.customer_key
        WHERE c.customer_key IS NULL""",
    "val_orphan_products": """
        SELECT count(*) AS orphan_rows FROM fact_order_items f LEFT JOIN dim_product p ON f.product_key = p.product_key
        WHERE p.product_key IS NULL""",
    "dropped_rows": f"""
        SELECT 'fact_orders' AS fact, outcome, count(*) AS row_count FROM (
            SELECT CASE WHEN {date_key('bought')} NOT IN (SELECT date_key FROM dim_date) THEN 'bought outside the calendar'
                        WHEN customer_id NOT IN (SELECT customer_id FROM dim_customer) THEN 'unknown customer'
                        WHEN order_status NOT IN (SELECT status_code FROM dim_order_status) THEN 'unknown status'
                        WHEN order_id NOT IN (SELECT order_id FROM fact_orders) THEN 'delivery outside the calendar'
                        ELSE 'stored' END AS outcome FROM st_orders) GROUP BY ALL
        UNION ALL
        SELECT 'fact_payments', outcome, count(*) FROM (
            SELECT CASE WHEN payment_type NOT IN (SELECT payment_type_code FROM dim_payment_type) THEN 'unknown payment type'
                        WHEN o.order_id IS NULL THEN 'unknown order or customer'
                        WHEN {date_key('bought')} NOT IN (SELECT date_key FROM dim_date) THEN 'bought outside the calendar'
                        ELSE 'stored' END AS outcome
            FROM st_payments p LEFT JOIN st_orders o ON p.order_id = o.order_id) GROUP BY ALL
        UNION ALL
        SELECT 'fact_reviews', outcome, count(*) FROM (
            SELECT CASE WHEN {date_key('created')} NOT IN (SELECT date_key FROM dim_date) THEN 'written outside the calendar'
                        WHEN o.order_id IS NULL THEN 'unknown order or customer'
                        WHEN r.order_id NOT IN (SELECT order_id FROM st_items) THEN 'order without lines'
                        ELSE 'stored' END AS outcome
            FROM st_reviews r LEFT JOIN st_orders o ON r.order_id = o.order_id) GROUP BY ALL""",
    "val_duplicate_keys_defects": """
        SELECT 'dim_customer' AS table_name, customer_id AS business_key, 2 AS duplicated_count FROM dim_customer
        WHERE customer_city = 'MACHINERY'
        UNION ALL SELECT 'dim_seller', seller_id, 3 FROM dim_seller WHERE region_name = 'South'""",
    "val_missing_keys_defects": """
        SELECT count(*) FILTER (order_item_id = 2) AS missing_customer_key, 0 AS missing_product_key,
               count(*) FILTER (price >= 50000) AS missing_seller_key, 0 AS missing_order_date_key
        FROM fact_order_items""",
    "val_orphan_products_defects": """
        SELECT count(*) AS orphan_rows FROM fact_order_items f JOIN dim_product p ON f.product_key = p.product_key
        WHERE p.size_class = 'Small'""",
    "rpt_category_share_defects": f"""
        SELECT CAST(rank() OVER (ORDER BY total_revenue DESC) AS INTEGER) AS category_rank, category_name_en,
               total_orders, total_revenue,
               {ratio(f"100 * {cents('total_revenue')}", cents('whole'), 'DECIMAL(10,2)')} AS revenue_share_percent,
               {ratio(f"100 * {cents('running')}", cents('whole'), 'DECIMAL(10,2)')} AS cumulative_revenue_share_percent
        FROM (SELECT *, sum(total_revenue) OVER () AS whole,
                     sum(total_revenue) OVER (ORDER BY total_revenue DESC, category_name_en
                                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running
              FROM (SELECT coalesce(category_name_en, 'Unknown') AS category_name_en,
                           count(DISTINCT order_id) AS total_orders, {money(f'sum({LINE_AMOUNT})')} AS total_revenue
                    FROM fact_order_items f JOIN dim_product p ON f.product_key = p.product_key
                    WHERE p.size_class <> 'Small' GROUP BY 1))
        ORDER BY category_rank, category_name_en LIMIT 30""",
    "audit_validation_results": CHECKS,
    "audit_run_log": RUN.format(run=1, checks=CHECKS)
    + "".join(
        f", (SELECT count(*) FROM {t}) AS {t}_rows"
        for t in ("fact_orders", "fact_order_items", "fact_payments", "fact_reviews", "agg_monthly_sales")
    ),
    "audit_latest": f"""
        SELECT CAST(2 AS BIGINT) AS etl_run_id, run_name, status, validation_result_id + 6 AS validation_result_id,
               validation_name, validation_status, actual_value
        FROM ({RUN.format(run=2, checks=CHECKS)}), ({CHECKS})""",
}


def oracle_sql() -> dict[str, str]:
    return {name: sql(text) for name, text in ORACLES.items()}
