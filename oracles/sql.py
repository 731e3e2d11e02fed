"""Plain SQL for DuckDB: the expected rows of the registered queries, written as literal joins and windows.

Each named part is a common table expression; `sql(final)` puts those in front that the final query uses, directly or
through others. Means and quotients are formed from whole cents, rounded half up at six digits and then at the scale of
the result, as decimal arithmetic does; DuckDB's own decimal division is floating point.
"""

from __future__ import annotations

import re

REGIONS = {
    "South": "'PR','SC','RS'",
    "Southeast": "'SP','RJ','MG','ES'",
    "Northeast": "'BA','PE','CE','PB','RN','AL','SE','MA','PI'",
    "North": "'PA','AM','RO','AC','AP','RR','TO'",
    "Center-West": "'DF','GO','MT','MS'",
}
STATES = "[" + ",".join(REGIONS.values()) + ",'XX']"


def state(number: str) -> str:
    return f"({STATES})[1 + ({number}) % 28]"


def region(column: str) -> str:
    cases = " ".join(f"WHEN {column} IN ({codes}) THEN '{name}'" for name, codes in REGIONS.items())
    return f"CASE {cases} ELSE 'Unknown' END"


def date_key(ts: str) -> str:
    return f"CAST(strftime({ts}, '%Y%m%d') AS INTEGER)"


def identity(key: str) -> str:
    return f"row_number() OVER (ORDER BY substr(md5({key}), 1, 4), {key})"


def ratio(num: str, den: str, decimal: str) -> str:
    """num / den for integer expressions, NULL for den = 0."""
    n, d = f"CAST({num} AS HUGEINT)", f"CAST({den} AS HUGEINT)"
    six = f"(sign({n}) * ((2 * abs({n}) * 1000000 + {d}) // (2 * {d})))"
    cents = f"(sign({six}) * ((abs({six}) + 5000) // 10000))"
    return f"CASE WHEN {d} = 0 THEN NULL ELSE CAST(CAST({cents} AS DECIMAL(20,2)) * 0.01 AS {decimal}) END"


def cents(amount: str) -> str:
    return f"CAST(({amount}) * 100 AS HUGEINT)"


def money(expression: str) -> str:
    return f"CAST({expression} AS DECIMAL(20,2))"


def row_hash(pt: str = "category_name_pt", en: str = "category_name_en") -> str:
    columns = [
        pt,
        en,
        "CAST(product_weight_g AS VARCHAR)",
        "CAST(product_length_cm AS VARCHAR)",
        "CAST(product_height_cm AS VARCHAR)",
        "CAST(product_width_cm AS VARCHAR)",
        "size_class",
    ]
    return "sha256(" + " || '|' || ".join(f"coalesce({c}, '')" for c in columns) + ")"


D20 = "o_orderdate + INTERVAL 20 YEAR"
LINE_AMOUNT = "coalesce(total_item_value, 0) + coalesce(freight_value, 0)"
CHANGE_TIME = "TIMESTAMP '2024-01-02 03:04:05'"

PARTS: dict[str, str] = {
    "st_customers": f"""
        SELECT CAST(c_custkey AS VARCHAR) AS customer_id, CAST(c_custkey % 1000 AS VARCHAR) AS customer_unique_id,
               lpad(CAST(c_custkey % 100 AS VARCHAR), 5, '0') AS customer_zip_code_prefix,
               c_mktsegment AS customer_city, {state('c_custkey')} AS customer_state
        FROM customer""",
    "st_sellers": f"""
        SELECT CAST(s_suppkey AS VARCHAR) AS seller_id,
               lpad(CAST(s_suppkey % 100 AS VARCHAR), 5, '0') AS seller_zip_code_prefix,
               s_name AS seller_city, {state('s_suppkey')} AS seller_state
        FROM supplier""",
    "delivered_geolocation": f"""
        SELECT lpad(CAST(c_custkey % 100 AS VARCHAR), 5, '0') AS zip, CAST(-30 + (c_custkey % 16) * 0.5 AS DOUBLE) AS lat,
               CAST(-60 + (c_custkey % 8) * 0.25 AS DOUBLE) AS lng, c_mktsegment AS city,
               {state('c_custkey % 100')} AS state
        FROM customer""",
    "st_geolocation": """
        SELECT zip, lat, lng, city, state FROM delivered_geolocation
        QUALIFY row_number() OVER (PARTITION BY zip, lat, lng ORDER BY city, state) = 1""",
    "st_orders": f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
               CASE WHEN o_orderkey % 50 = 0 THEN 'canceled' WHEN o_orderkey % 97 = 0 THEN 'mystery'
                    WHEN o_orderstatus = 'F' THEN 'delivered' WHEN o_orderstatus = 'O' THEN 'shipped'
                    ELSE 'processing' END AS order_status,
               {D20} AS bought, {D20} + INTERVAL 1 HOUR AS approved,
               CASE WHEN o_orderstatus <> 'P' THEN {D20} + INTERVAL 2 DAY END AS carrier,
               CASE WHEN o_orderstatus = 'F' THEN {D20} + (o_orderkey * 7 % 40 + 1) * INTERVAL '1' DAY END AS delivered,
               CASE WHEN o_orderkey % 33 <> 0 THEN {D20} + (20 + o_orderkey % 15) * INTERVAL '1' DAY END AS estimated
        FROM orders""",
    "st_items": """
        SELECT CAST(l_orderkey AS VARCHAR) AS order_id,
               CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity,
                    l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS INTEGER) AS order_item_id,
               CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_suppkey AS VARCHAR) AS seller_id,
               CAST(l_extendedprice AS DECIMAL(10,2)) AS price, CAST(l_quantity * 0.5 AS DECIMAL(10,2)) AS freight_value
        FROM lineitem""",
    "st_payments": """
        SELECT CAST(o_orderkey AS VARCHAR) AS order_id, n AS payment_sequential,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'credit_card' WHEN '2-HIGH' THEN 'debit_card'
                    WHEN '3-MEDIUM' THEN 'boleto' WHEN '5-LOW' THEN 'voucher' ELSE 'not_defined' END AS payment_type,
               CAST(1 + o_orderkey % 10 AS INTEGER) AS payment_installments,
               CAST(o_totalprice AS DECIMAL(10,2)) AS payment_value
        FROM orders JOIN (VALUES (1), (2)) t(n) ON n <= 1 + o_orderkey % 2""",
    "delivered_reviews": f"""
        SELECT 'r' || CAST(o_orderkey - CASE WHEN o_orderkey % 100 = 2 THEN 1 ELSE 0 END AS VARCHAR) AS review_id,
               CAST(o_orderkey - CASE WHEN o_orderkey % 100 = 4 THEN 1 ELSE 0 END AS VARCHAR) AS order_id,
               CAST(1 + o_orderkey * 3 % 5 AS INTEGER) AS review_score,
               CASE o_orderkey % 3 WHEN 1 THEN '  ' WHEN 2 THEN o_orderpriority || '  ' END AS message,
               {D20} + INTERVAL 30 DAY AS created,
               CASE WHEN o_orderkey % 11 <> 0
                    THEN {D20} + INTERVAL 30 DAY + (o_orderkey % 7) * INTERVAL '1' DAY END AS answered
        FROM orders""",
    "st_reviews": """
        SELECT * FROM delivered_reviews
        QUALIFY row_number() OVER (PARTITION BY review_id ORDER BY order_id, review_score, message NULLS FIRST,
                                   created, answered NULLS FIRST) = 1""",
    "reviews_checked": """
        SELECT r.*, o.order_id IS NOT NULL AS good FROM delivered_reviews r
        LEFT JOIN st_orders o ON r.order_id = o.order_id AND o.order_status <> 'shipped'""",
    "reviews_kept": """
        SELECT * FROM reviews_checked WHERE good
        QUALIFY row_number() OVER (PARTITION BY review_id ORDER BY order_id, review_score, message NULLS FIRST,
                                   created, answered NULLS FIRST) = 1""",
    "st_products": """
        SELECT CAST(p_partkey AS VARCHAR) AS product_id, CASE WHEN p_partkey % 40 <> 0 THEN p_type END AS category,
               CAST(length(p_name) AS INTEGER) AS name_length, CAST(p_size * 10 AS INTEGER) AS description_length,
               CAST(p_size % 6 AS INTEGER) AS photos,
               CASE WHEN p_partkey % 50 <> 1 THEN CAST(p_size * 400 AS INTEGER) END AS weight,
               CAST(p_size AS INTEGER) AS length_cm, CAST(p_size % 20 + 1 AS INTEGER) AS height_cm,
               CAST(p_size % 15 + 1 AS INTEGER) AS width_cm
        FROM part""",
    "st_translation": "SELECT DISTINCT p_type AS category, lower(p_type) AS english FROM part WHERE p_type <> 'PROMO'",
    "dim_date": f"""
        SELECT {date_key('d')} AS date_key, CAST(d AS DATE) AS calendar_date,
               CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week, dayname(d) AS day_name,
               CAST((dayofyear(d) - 1 + dayofweek(date_trunc('year', d))) // 7 + 1 AS INTEGER) AS week_of_year,
               CAST(month(d) AS INTEGER) AS month_of_year, monthname(d) AS month_name,
               CAST(quarter(d) AS INTEGER) AS quarter, CAST(year(d) AS INTEGER) AS year,
               CASE WHEN dayofweek(d) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend, 0 AS is_holiday
        FROM generate_series(TIMESTAMP '2015-01-01', TIMESTAMP '2020-12-31', INTERVAL 1 DAY) g(d)""",
    "dim_customer": f"""
        SELECT {identity('customer_id')} AS customer_key, customer_id, customer_zip_code_prefix, customer_city,
               customer_state, {region('customer_state')} AS region_name, 'Regular' AS customer_segment
        FROM st_customers""",
    "dim_seller": f"""
        SELECT {identity('seller_id')} AS seller_key, seller_id, seller_zip_code_prefix, seller_city, seller_state,
               {region('seller_state')} AS region_name, 'Standard' AS seller_segment
        FROM st_sellers""",
    "dim_product": f"""
        SELECT {identity('product_id')} AS product_key, product_id, p.category AS category_id,
               coalesce(english, p.category) AS category_name_en, p.category AS category_name_pt,
               name_length AS product_name_length, description_length AS product_description_length,
               photos AS product_photos_qty, CAST(weight AS DECIMAL(10,2)) AS product_weight_g,
               CAST(length_cm AS DECIMAL(10,2)) AS product_length_cm,
               CAST(height_cm AS DECIMAL(10,2)) AS product_height_cm,
               CAST(width_cm AS DECIMAL(10,2)) AS product_width_cm,
               CAST(coalesce(length_cm, 0) * coalesce(height_cm, 0) * coalesce(width_cm, 0) AS DECIMAL(15,2)) AS volume_cm3,
               CASE WHEN coalesce(weight, 0) > 10000 THEN 1 ELSE 0 END AS is_heavy,
               CASE WHEN coalesce(weight, 0) < 500 AND coalesce(length_cm, 0) < 20 THEN 'Small'
                    WHEN coalesce(weight, 0) < 5000 AND coalesce(length_cm, 0) < 50 THEN 'Medium'
                    WHEN coalesce(weight, 0) < 15000 THEN 'Large' ELSE 'Extra Large' END AS size_class
        FROM st_products p LEFT JOIN st_translation t ON p.category = t.category""",
    "dim_payment_type": """
        SELECT CAST(k AS BIGINT) AS payment_type_key, payment_type_code, payment_type_name, payment_category, risk_level
        FROM (VALUES (1, 'credit_card', 'Credit Card', 'Card', 'Medium'), (2, 'debit_card', 'Debit Card', 'Card', 'Low'),
                     (3, 'boleto', 'Boleto Bancário', 'Bank Transfer', 'Low'), (4, 'voucher', 'Voucher', 'Cash', 'Low'),
                     (5, 'not_defined', 'Not Defined', 'Unknown', 'High'))
             t(k, payment_type_code, payment_type_name, payment_category, risk_level)""",
    "dim_order_status": """
        SELECT CAST(k AS BIGINT) AS order_status_key, status_code, status_name, is_final_status, is_problem_status
        FROM (VALUES (1, 'created', 'Created', 0, 0), (2, 'approved', 'Approved', 0, 0),
                     (3, 'invoiced', 'Invoiced', 0, 0), (4, 'pending_payment', 'Pending Payment', 0, 0),
                     (5, 'processing', 'Processing', 0, 0), (6, 'shipped', 'Shipped', 0, 0),
                     (7, 'delivered', 'Delivered', 1, 0), (8, 'canceled', 'Canceled', 1, 1),
                     (9, 'unavailable', 'Unavailable', 1, 1))
             t(k, status_code, status_name, is_final_status, is_problem_status)""",
    "dim_geolocation": f"""
        SELECT {identity('zip')} AS geolocation_key, zip AS zip_code_prefix, CAST(avg(lat) AS DECIMAL(10,6)) AS latitude,
               CAST(avg(lng) AS DECIMAL(10,6)) AS longitude, min(city) AS city, min(state) AS state,
               {region('min(state)')} AS region_name, CAST(NULL AS INTEGER) AS distance_from_sao_paulo_km
        FROM st_geolocation GROUP BY zip""",
    "fact_order_items": f"""
        SELECT i.order_id, i.order_item_id, customer_key, product_key, seller_key,
               {date_key('bought')} AS order_date_key, 1 AS quantity, price, freight_value, price AS total_item_value,
               0 AS is_out_of_stock
        FROM st_items i JOIN st_orders o ON i.order_id = o.order_id JOIN dim_customer c ON o.customer_id = c.customer_id
             JOIN dim_product p ON i.product_id = p.product_id JOIN dim_seller s ON i.seller_id = s.seller_id
             JOIN dim_date d ON {date_key('bought')} = d.date_key""",
    "order_rows": f"""
        SELECT o.order_id, customer_key, {date_key('bought')} AS order_date_key,
               {date_key('estimated')} AS estimated_delivery_date_key, {date_key('delivered')} AS actual_delivery_date_key,
               order_status_key, coalesce(n, 0) AS total_items, {money('coalesce(price, 0)')} AS total_price,
               {money('coalesce(freight, 0)')} AS total_freight_value,
               {money('coalesce(price, 0) + coalesce(freight, 0)')} AS total_order_value,
               bought AS order_purchase_timestamp, approved AS order_approved_at, carrier AS order_delivered_carrier_date,
               delivered AS order_delivered_customer_date, estimated AS order_estimated_delivery_date,
               CAST(date_diff('day', bought, delivered) AS INTEGER) AS days_to_delivery,
               CASE WHEN delivered > estimated THEN 1 ELSE 0 END AS is_delayed
        FROM st_orders o JOIN dim_customer c ON o.customer_id = c.customer_id
             JOIN dim_order_status s ON o.order_status = s.status_code
             JOIN dim_date d ON {date_key('bought')} = d.date_key
             LEFT JOIN (SELECT order_id, count(*) AS n, sum(price) AS price, sum(freight_value) AS freight
                        FROM st_items GROUP BY order_id) i ON o.order_id = i.order_id""",
    "fact_orders": """
        SELECT * FROM order_rows
        WHERE (estimated_delivery_date_key IS NULL OR estimated_delivery_date_key IN (SELECT date_key FROM dim_date))
          AND (actual_delivery_date_key IS NULL OR actual_delivery_date_key IN (SELECT date_key FROM dim_date))""",
    "first_item": """
        SELECT order_id, order_item_id, product_id, seller_id FROM st_items
        QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY order_item_id) = 1""",
    "fact_reviews": f"""
        SELECT r.order_id, customer_key, product_key, seller_key, {date_key('created')} AS review_date_key, review_score,
               CAST(coalesce(length(rtrim(message, ' ')), 0) AS INTEGER) AS review_comment_length,
               CASE WHEN review_score >= 4 THEN 1 ELSE 0 END AS is_positive_review,
               CASE WHEN length(rtrim(message, ' ')) > 0 THEN 1 ELSE 0 END AS has_comment,
               created AS review_creation_time, answered AS review_answer_timestamp,
               CAST(date_diff('day', created, answered) AS INTEGER) AS days_to_answer
        FROM st_reviews r JOIN st_orders o ON r.order_id = o.order_id JOIN dim_customer c ON o.customer_id = c.customer_id
             JOIN dim_date d ON {date_key('created')} = d.date_key JOIN first_item f ON r.order_id = f.order_id
             JOIN dim_product p ON f.product_id = p.product_id JOIN dim_seller s ON f.seller_id = s.seller_id""",
    "fact_payments": f"""
        SELECT p.order_id, customer_key, {date_key('bought')} AS payment_date_key, payment_type_key, payment_sequential,
               payment_installments, payment_value, CAST(NULL AS DECIMAL(10,2)) AS payment_fee,
               payment_value AS net_payment_value
        FROM st_payments p JOIN st_orders o ON p.order_id = o.order_id JOIN dim_customer c ON o.customer_id = c.customer_id
             JOIN dim_payment_type t ON p.payment_type = t.payment_type_code
             JOIN dim_date d ON {date_key('bought')} = d.date_key""",
    "review_means": f"""
        SELECT order_id, {ratio('sum(review_score)', 'count(review_score)', 'DECIMAL(5,2)')} AS score
        FROM fact_reviews GROUP BY order_id""",
    "agg_monthly_sales": f"""
        SELECT d.year, d.month_of_year AS month, coalesce(category_name_en, 'Unknown') AS category_name_en, f.seller_key,
               count(DISTINCT f.order_id) AS total_orders, CAST(sum(quantity) AS BIGINT) AS total_items,
               {money(f'sum({LINE_AMOUNT})')} AS total_revenue,
               {money('sum(coalesce(freight_value, 0))')} AS total_freight,
               {ratio(f'sum({cents(LINE_AMOUNT)})', '100 * count(DISTINCT f.order_id)', 'DECIMAL(20,2)')} AS avg_order_value,
               {ratio(f"sum({cents('score')})", '100 * count(score)', 'DECIMAL(3,2)')} AS avg_review_score,
               count(DISTINCT CASE WHEN is_delayed = 1 THEN o.order_id END) AS orders_delayed
        FROM fact_order_items f JOIN fact_orders o ON f.order_id = o.order_id JOIN dim_date d ON f.order_date_key = d.date_key
             JOIN dim_product p ON f.product_key = p.product_key LEFT JOIN review_means r ON f.order_id = r.order_id
        GROUP BY ALL""",
    "observed_rates": """
        SELECT 'NBP' AS source_system,
               CASE event_type WHEN 'purchase' THEN 'BRL' WHEN 'signup' THEN 'USD' WHEN 'view' THEN 'EUR'
                    WHEN 'click' THEN 'GBP' ELSE 'CHF' END AS currency_code,
               'PLN' AS base_currency, CAST(ts AS DATE) AS rate_date, CAST(value AS DECIMAL(18,6)) AS rate_value,
               ts AS fetched_at
        FROM events""",
    "rates": """
        SELECT source_system, currency_code, base_currency, rate_date, rate_value, fetched_at,
               CASE WHEN row_number() OVER (PARTITION BY currency_code ORDER BY fetched_at DESC, rate_value DESC) = 1
                    THEN 1 ELSE 0 END AS is_current
        FROM (SELECT * FROM observed_rates
              QUALIFY row_number() OVER (PARTITION BY currency_code, rate_date
                                         ORDER BY fetched_at DESC, rate_value DESC) = 1)""",
    "latest_rate": """
        SELECT rate_value, rate_date FROM rates WHERE currency_code = 'BRL'
        ORDER BY rate_date DESC, fetched_at DESC LIMIT 1""",
    "orders_pln": f"""
        SELECT order_id, customer_key, order_date_key, total_order_value AS total_order_value_brl,
               rate_value AS brl_to_pln_rate,
               {money('total_order_value * rate_value')} AS total_order_value_pln,
               rate_date AS exchange_rate_date
        FROM fact_orders CROSS JOIN latest_rate""",
    "scd2_initial": f"""
        SELECT product_id, category_name_pt, category_name_en, product_weight_g, product_length_cm, product_height_cm,
               product_width_cm, size_class, TIMESTAMP '1900-01-01' AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to,
               1 AS is_current, {row_hash()} AS scd_hash
        FROM dim_product""",
    "scd2_source": """
        SELECT product_id, CASE WHEN is_heavy = 1 THEN coalesce(category_name_pt, 'unknown') || '_SCD_DEMO'
                                ELSE category_name_pt END AS category_name_pt,
               CASE WHEN is_heavy = 1 THEN coalesce(category_name_en, 'unknown') || ' SCD Demo'
                    ELSE category_name_en END AS category_name_en,
               product_weight_g, product_length_cm, product_height_cm, product_width_cm, size_class
        FROM dim_product""",
    "scd2_new": f"SELECT *, {row_hash()} AS new_hash FROM scd2_source",
    "scd2_closed": f"""
        SELECT v.product_id, v.category_name_pt, v.category_name_en, v.product_weight_g, v.product_length_cm,
               v.product_height_cm, v.product_width_cm, v.size_class, valid_from,
               CASE WHEN scd_hash <> new_hash THEN {CHANGE_TIME} - INTERVAL 1 SECOND END AS valid_to,
               CASE WHEN scd_hash <> new_hash THEN 0 ELSE 1 END AS is_current, scd_hash
        FROM scd2_initial v JOIN scd2_new n ON v.product_id = n.product_id""",
    "scd2_applied": f"""
        SELECT * FROM scd2_closed
        UNION ALL
        SELECT product_id, category_name_pt, category_name_en, product_weight_g, product_length_cm, product_height_cm,
               product_width_cm, size_class, {CHANGE_TIME}, NULL, 1, new_hash
        FROM scd2_new n
        WHERE NOT EXISTS (SELECT 1 FROM scd2_closed c
                          WHERE c.product_id = n.product_id AND c.is_current = 1 AND c.scd_hash = n.new_hash)""",
    "customer_metrics": f"""
        SELECT c.customer_id, c.region_name, count(DISTINCT order_id) AS orders_count,
               {money('sum(total_order_value)')} AS total_spent
        FROM fact_orders o JOIN dim_customer c ON o.customer_key = c.customer_key GROUP BY ALL""",
    "quartiles": """
        SELECT customer_id, region_name, orders_count, total_spent,
               CAST(ntile(4) OVER (ORDER BY total_spent, customer_id) AS INTEGER) AS monetary_quartile,
               CAST(ntile(4) OVER (ORDER BY orders_count, customer_id) AS INTEGER) AS frequency_quartile
        FROM customer_metrics""",
}


def sql(final: str) -> str:
    """`final` with the parts it needs in front, each after those it uses itself."""
    ordered: list[str] = []

    def need(text: str) -> None:
        for name in PARTS:
            if name not in ordered and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", text):
                need(PARTS[name])
                if name not in ordered:
                    ordered.append(name)

    need(final)
    if not ordered:
        return final
    return "WITH " + ",\n".join(f"{name} AS ({PARTS[name]}\n)" for name in ordered) + "\n" + final
