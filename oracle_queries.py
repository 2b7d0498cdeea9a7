"""DuckDB SQL that states, independently of the Spark code, what every query must return."""

from __future__ import annotations

# The raw tables, as starmill.sources.warehouse derives them.
_BRONZE: dict[str, str] = {
    "o": """SELECT o_orderkey AS order_id, o_orderkey AS customer_id,
        CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' ELSE 'canceled' END
            AS order_status,
        o_orderdate AS bought,
        CASE WHEN o_orderkey % 37 <> 0
            THEN o_orderdate + to_days(CAST(1 + o_orderkey % 40 AS INTEGER)) END AS delivered,
        o_orderdate + to_days(24) AS estimated,
        CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m,
        CAST(quarter(o_orderdate) AS INTEGER) AS q
        FROM orders""",
    "i": """SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id,
        l_suppkey AS seller_id, l_shipdate AS shipping, l_extendedprice AS price,
        l_extendedprice * l_tax AS freight,
        CAST(l_extendedprice AS DECIMAL(18,4)) AS dprice,
        CAST(l_extendedprice * l_tax AS DECIMAL(18,4)) AS dfreight
        FROM lineitem""",
    "t": """SELECT * FROM (VALUES ('STANDARD', 'standard'), ('ECONOMY', 'economy'),
        ('MEDIUM', 'medium'), ('SMALL', 'small'), ('LARGE', 'large')) AS v(cat, eng)""",
    "p": """SELECT p_partkey AS product_id, CASE WHEN p_partkey % 50 <> 0 THEN p_type END AS cat,
        p_size * 100 AS weight FROM part""",
    "pt": "SELECT p.*, t.eng FROM p LEFT JOIN t ON p.cat = t.cat",
    "c": """SELECT o_orderkey AS customer_id,
        CASE WHEN o_orderkey % 4 = 0 THEN o_custkey ELSE 100000000 + o_orderkey END AS person,
        c_nationkey AS zip, n_name AS city, r_name AS state
        FROM orders JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "s": """SELECT s_suppkey AS seller_id, n_name AS city, r_name AS state
        FROM supplier JOIN nation ON s_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey""",
    "pay": """SELECT l_orderkey AS order_id,
        CASE WHEN l_returnflag = 'R' THEN 'credit_card' WHEN l_returnflag = 'A' THEN 'boleto'
            WHEN l_linestatus = 'O' THEN 'voucher' ELSE 'debit_card' END AS payment_type,
        1 + CAST(floor(l_quantity) AS INTEGER) % 12 AS installments,
        CAST(l_extendedprice * (1 + l_tax) AS DECIMAL(18,4)) AS paid
        FROM lineitem""",
    "rev": """SELECT event_id AS order_id, 1 + CAST(floor(value) AS INTEGER) % 5 AS score, ts
        FROM events""",
    "geo": """SELECT n_nationkey AS zip, n_nationkey * 1.5 - off AS lat, n_nationkey * 1.5 - off AS lng
        FROM nation, (VALUES (10.0), (9.0)) AS v(off)""",
}

# Marts that other queries build on.
_GOLD: dict[str, str] = {
    "monthly_revenue_summary": """
        SELECT y AS order_year, m AS order_month, eng AS product_category_name_english,
            CAST(sum(dprice) AS DOUBLE) AS total_revenue, count(*) AS total_orders,
            CAST(sum(dprice) AS DOUBLE) / count(price) AS avg_order_value
        FROM o JOIN i USING (order_id) JOIN pt USING (product_id)
        WHERE order_status = 'delivered' AND price IS NOT NULL AND bought IS NOT NULL
            AND eng IS NOT NULL
        GROUP BY y, m, eng""",
    "order_count_by_quarter": """
        SELECT y AS order_year, q AS order_quarter, eng AS product_category_name_english,
            count(DISTINCT order_id) AS order_count
        FROM o JOIN i USING (order_id) JOIN pt USING (product_id)
        WHERE bought IS NOT NULL AND eng IS NOT NULL GROUP BY y, q, eng""",
    "order_count_by_seller_state": """
        SELECT state AS seller_state, count(DISTINCT order_id) AS total_orders
        FROM o JOIN i USING (order_id) JOIN s USING (seller_id) GROUP BY state""",
    "order_count_by_seller_state_city": """
        SELECT state AS seller_state, city AS seller_city,
            count(DISTINCT order_id) AS total_orders
        FROM o JOIN i USING (order_id) JOIN s USING (seller_id) GROUP BY state, city""",
    "order_count_by_state_and_category": """
        SELECT state AS customer_state, eng AS product_category_name_english,
            count(DISTINCT order_id) AS order_count
        FROM o JOIN i USING (order_id) JOIN pt USING (product_id) JOIN c USING (customer_id)
        GROUP BY state, eng""",
    "average_installments_by_payment_type_monthly": """
        SELECT payment_type, y AS "year", m AS "month", avg(installments) AS average_installments
        FROM o JOIN pay USING (order_id) GROUP BY payment_type, y, m""",
    "average_items_per_order_monthly": """
        SELECT y AS order_year, m AS order_month, avg(n) AS average_items_per_order
        FROM (SELECT order_id, y, m, count(order_item_id) AS n
              FROM o JOIN i USING (order_id) GROUP BY order_id, y, m) GROUP BY y, m""",
    "yearly_average_revenue_by_category": """
        SELECT eng AS product_category_name_english, y AS "year",
            CAST(sum(dprice) AS DOUBLE) / count(price) AS average_revenue
        FROM o JOIN i USING (order_id) JOIN pt USING (product_id)
        WHERE order_status = 'delivered' GROUP BY eng, y""",
    "product_weight_summary_by_city": """
        SELECT city AS customer_city, CAST(sum(weight) AS BIGINT) AS total_weight
        FROM o JOIN i USING (order_id) JOIN p USING (product_id) JOIN c USING (customer_id)
        GROUP BY city""",
    "payment_mix_by_state": """
        SELECT state AS customer_state, payment_type, CAST(sum(paid) AS DOUBLE) AS payment_value,
            count(DISTINCT order_id) AS order_count
        FROM o JOIN c USING (customer_id) JOIN pay USING (order_id) GROUP BY state, payment_type""",
    "order_delivery_sla": """
        SELECT order_id, CAST(date_diff('day', CAST(bought AS DATE), CAST(delivered AS DATE)) AS INTEGER)
            AS delivery_days, delivered > estimated AS is_late
        FROM o WHERE delivered IS NOT NULL""",
    "freight_by_category": """
        SELECT eng AS product_category_name_english,
            CAST(sum(dfreight) AS DOUBLE) / count(freight) AS avg_freight_value,
            CAST(sum(dprice) AS DOUBLE) / count(price) AS avg_price
        FROM i JOIN pt USING (product_id) GROUP BY eng""",
    "installments_by_payment_type": """
        SELECT payment_type, avg(installments) AS average_installments,
            CAST(sum(paid) AS DOUBLE) AS payment_value
        FROM pay GROUP BY payment_type""",
    "customer_repeat_rate": """
        SELECT customer_state, avg(CASE WHEN n > 1 THEN 1 ELSE 0 END) AS repeat_rate,
            count(*) AS customers
        FROM (SELECT person, count(*) AS n,
                  arg_max(state, (bought, order_id)) AS customer_state
              FROM o JOIN c USING (customer_id) GROUP BY person) GROUP BY customer_state""",
    "period_revenue_by_category": """
        SELECT y AS "year", m AS "month", eng AS product_category_name_english,
            CAST(sum(dprice) AS DOUBLE) AS total_revenue
        FROM o JOIN i USING (order_id) JOIN pt USING (product_id)
        WHERE y IN (1996, 1997, 1998) AND m IN (1, 2, 3) GROUP BY y, m, eng""",
    "product_category_order_count_monthly": """
        SELECT cat AS product_category_name, m AS order_month, count(*) AS order_count
        FROM o JOIN i USING (order_id) JOIN pt USING (product_id)
        WHERE eng IS NOT NULL GROUP BY cat, m""",
}

_SQL: dict[str, str] = {name: f"SELECT * FROM {name}" for name in _GOLD}

_SQL.update({
    "monthly_revenue_distinct_orders": """
        SELECT y AS order_year, m AS order_month, eng AS product_category_name_english,
            CAST(sum(dprice) AS DOUBLE) AS total_revenue,
            count(DISTINCT order_id) AS total_orders,
            CAST(sum(dprice) AS DOUBLE) / count(DISTINCT order_id) AS avg_order_value
        FROM o JOIN i USING (order_id) JOIN pt USING (product_id)
        WHERE order_status = 'delivered' AND eng IS NOT NULL GROUP BY y, m, eng""",
    "monthly_average_revenue_by_product": """
        SELECT y AS "year", m AS "month", product_id, CAST(sum(dprice) AS DOUBLE) AS total_revenue
        FROM o JOIN i USING (order_id) WHERE order_status = 'delivered'
        GROUP BY y, m, product_id""",
    "avg_order_revenue_by_product_monthly": """
        SELECT y AS "year", m AS "month", product_id,
            CAST(sum(spent) AS DOUBLE) / count(*) AS average_revenue
        FROM (SELECT y, m, product_id, order_id, sum(dprice) AS spent
              FROM o JOIN i USING (order_id) WHERE order_status = 'delivered'
              GROUP BY y, m, product_id, order_id) GROUP BY y, m, product_id""",
    "quarterly_revenue_summary": """
        SELECT y AS "year", m AS "month",
            CAST(sum(CAST(price * order_item_id AS DECIMAL(18,4))) AS DOUBLE) AS revenue
        FROM o JOIN i USING (order_id) WHERE order_status = 'delivered' GROUP BY y, m""",
    "quarterly_revenue_by_quarter": """
        SELECT y AS "year", q AS "quarter", CAST(sum(dprice) AS DOUBLE) AS revenue
        FROM o JOIN i USING (order_id) WHERE order_status = 'delivered' GROUP BY y, q""",
    "period_revenue_by_product": """
        SELECT y AS "year", m AS "month", product_id, CAST(sum(dprice) AS DOUBLE) AS total_revenue
        FROM o JOIN i USING (order_id)
        WHERE y IN (1996, 1997, 1998) AND m IN (1, 2, 3) GROUP BY y, m, product_id""",
    "period_revenue_total": """
        SELECT y AS "year", m AS "month", CAST(sum(dprice) AS DOUBLE) AS total_revenue
        FROM o JOIN i USING (order_id)
        WHERE y IN (1996, 1997, 1998) AND m IN (1, 2, 3) GROUP BY y, m""",
    "order_count_by_quarter_product_category": """
        SELECT y AS order_year, q AS order_quarter, eng AS product_category_name_english,
            count(order_id) AS order_count
        FROM o JOIN i USING (order_id) JOIN pt USING (product_id) GROUP BY y, q, eng""",
    "order_count_by_seller_city_and_category": """
        SELECT city AS seller_city, eng AS product_category_name_english,
            count(DISTINCT order_id) AS total_order_count
        FROM o JOIN i USING (order_id) JOIN s USING (seller_id) JOIN pt USING (product_id)
        GROUP BY city, eng""",
    "category_month_pivot": "SELECT product_category_name, "
    + ", ".join(
        f"CAST(coalesce(sum(order_count) FILTER (order_month = {m}), 0) AS BIGINT) AS month_{m}"
        for m in range(1, 13)
    )
    + " FROM product_category_order_count_monthly GROUP BY product_category_name",
    "average_freight_cost_by_category": """
        SELECT cat AS product_category_name,
            CAST(sum(dfreight) AS DOUBLE) / count(freight) AS avg_freight_cost
        FROM i JOIN p USING (product_id) GROUP BY cat""",
    "freight_by_category_filtered": """
        SELECT cat AS product_category_name,
            CAST(sum(dfreight) AS DOUBLE) / count(freight) AS avg_freight_cost
        FROM i JOIN p USING (product_id) JOIN o USING (order_id) JOIN c USING (customer_id)
        WHERE bought >= TIMESTAMP '1996-01-01' AND bought < TIMESTAMP '1998-01-01'
            AND state IN ('ASIA', 'EUROPE') GROUP BY cat""",
    "order_basket_size": """
        SELECT avg(n) AS avg_items_per_order, max(n) AS max_items_per_order
        FROM (SELECT count(*) AS n FROM i GROUP BY order_id)""",
    "order_basket_detail": "SELECT order_id, count(*) AS basket_size FROM i GROUP BY order_id",
    "sp_delivery_delays": """
        SELECT order_id, CAST(date_diff('day', CAST(bought AS DATE), CAST(delivered AS DATE)) AS INTEGER)
            AS delivery_days, delivered > estimated AS is_late
        FROM o JOIN c USING (customer_id)
        WHERE order_status = 'delivered' AND delivered IS NOT NULL AND state = 'ASIA'
            AND CAST(delivered AS DATE) >= CAST(bought AS DATE)""",
    "product_price_weight_flags": """
        SELECT product_id, price, weight AS product_weight_g,
            price > (SELECT quantile_cont(price, 0.95) FROM i JOIN p USING (product_id))
                AS price_outlier,
            weight > (SELECT quantile_cont(weight, 0.95) FROM i JOIN p USING (product_id))
                AS weight_outlier
        FROM i JOIN p USING (product_id)""",
    "monthly_revenue_by_payment_type": """
        SELECT y AS order_year, m AS order_month, payment_type,
            CAST(sum(paid) AS DOUBLE) AS payment_value
        FROM o JOIN pay USING (order_id)
        WHERE order_id IN (SELECT order_id FROM i) GROUP BY y, m, payment_type""",
    "seller_performance_scorecard": """
        SELECT seller_id, avg_review_score, total_revenue, cancellation_rate,
            CASE WHEN avg_review_score >= 3.0 AND cancellation_rate <= 0.33 THEN 'Gold'
                 WHEN avg_review_score >= 2.9 THEN 'Silver' ELSE 'Bronze' END AS performance_tier
        FROM (SELECT seller_id, sum(score) / count(score) AS avg_review_score,
                  CAST(sum(spent) AS DOUBLE) AS total_revenue,
                  avg(CASE WHEN order_status = 'canceled' THEN 1 ELSE 0 END) AS cancellation_rate
              FROM (SELECT order_id, seller_id, sum(dprice) AS spent
                    FROM i GROUP BY order_id, seller_id)
              JOIN o USING (order_id)
              LEFT JOIN (SELECT order_id, avg(score) AS score
                         FROM rev GROUP BY order_id) USING (order_id)
              JOIN s USING (seller_id) GROUP BY seller_id)""",
    "weekly_review_distribution": """
        SELECT CAST(date_trunc('week', ts) AS DATE) AS review_week, score AS review_score,
            count(*) AS weekly_review_count
        FROM rev JOIN o USING (order_id) GROUP BY ALL""",
    "customer_rfm_segments": """
        WITH people AS (
            SELECT person, CAST(max(bought) AS DATE) AS last_day, count(*) AS frequency,
                CAST(sum(paid) AS DOUBLE) AS monetary
            FROM o JOIN c USING (customer_id)
            JOIN (SELECT order_id, sum(paid) AS paid FROM pay GROUP BY order_id) USING (order_id)
            WHERE order_status = 'delivered' AND order_id IN (SELECT order_id FROM i)
            GROUP BY person),
        measured AS (
            SELECT *, CAST(date_diff('day', last_day, (SELECT max(last_day) FROM people)) AS INTEGER)
                AS recency_days FROM people WHERE monetary > 0),
        cuts AS (
            SELECT quantile_cont(recency_days, [0.2, 0.4, 0.6, 0.8]) AS r,
                quantile_cont(frequency, [0.2, 0.4, 0.6, 0.8]) AS f,
                quantile_cont(monetary, [0.2, 0.4, 0.6, 0.8]) AS m FROM measured),
        scored AS (
            SELECT measured.*,
                5 - len(list_filter(r, lambda v: recency_days > v))
                + 1 + len(list_filter(f, lambda v: frequency > v))
                + 1 + len(list_filter(m, lambda v: monetary > v)) AS points
            FROM measured, cuts)
        SELECT person AS customer_unique_id, recency_days, frequency, monetary,
            CASE WHEN points >= 13 THEN 'Champion' WHEN points >= 10 THEN 'Loyal'
                 WHEN points >= 8 THEN 'Potential' WHEN points >= 6 THEN 'At Risk'
                 ELSE 'Lost' END AS rfm_segment
        FROM scored""",
})

# --- scans, sinks, filters, joins ---

_SQL.update({
    "scan_bronze_parquet": """
        SELECT CAST(order_id AS VARCHAR) AS order_id, order_item_id,
            CAST(product_id AS VARCHAR) AS product_id, CAST(seller_id AS VARCHAR) AS seller_id,
            CAST(shipping AS DATE) AS shipping_limit_date, price, freight AS freight_value
        FROM i""",
    "scan_bronze_csv": """
        SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(customer_id AS VARCHAR) AS customer_id,
            order_status, CAST(bought AS DATE) AS purchase_date,
            CAST(delivered AS DATE) AS delivered_date, CAST(estimated AS DATE) AS estimated_date
        FROM o""",
    "scan_bronze_csv_multiline": """
        SELECT CAST(order_id AS VARCHAR) AS review_id, score AS review_score,
            'said "' || order_id || '",' || chr(10) || 'and ' || score AS review_comment_title,
            CASE WHEN order_id % 3 > 0 THEN 'one' || chr(10) || chr(10) || 'said "' || order_id
                || '",' || chr(10) || 'and ' || score END AS review_comment_message,
            CAST(ts AS DATE) AS created
        FROM rev""",
    "sink_gold_parquet": "SELECT * FROM monthly_revenue_summary",
    "sink_gold_partition_overwrite": """
        SELECT * REPLACE (CASE WHEN order_year = 1997 THEN total_revenue * 2
            ELSE total_revenue END AS total_revenue) FROM monthly_revenue_summary""",
    "sink_gold_publish": """
        SELECT * REPLACE (total_revenue * 2 AS total_revenue) FROM monthly_revenue_summary""",
    "catalog_register_gold": "SELECT * FROM order_count_by_quarter",
    "gold_preview": """
        SELECT * FROM order_count_by_seller_state_city ORDER BY seller_state, seller_city LIMIT 20""",
    "filter_period_in": """
        SELECT * FROM monthly_revenue_summary
        WHERE order_year IN (1996, 1997, 1998) AND order_month IN (1, 2, 3)""",
    "join_translation_left": """
        SELECT product_id, cat AS product_category_name, eng AS product_category_name_english,
            weight AS product_weight_g FROM pt""",
    "join_geolocation_zip": """
        SELECT customer_id, zip AS customer_zip_code_prefix, lat, lng FROM c LEFT JOIN
            (SELECT zip, CAST(avg(lat) AS DOUBLE) AS lat, CAST(avg(lng) AS DOUBLE) AS lng
             FROM geo GROUP BY zip) USING (zip)""",
    "star_join": """
        SELECT order_id, order_item_id, product_id, seller_id,
            eng AS product_category_name_english, c.state AS customer_state,
            s.state AS seller_state, price
        FROM o JOIN i USING (order_id) JOIN pt USING (product_id) JOIN s USING (seller_id)
        JOIN c USING (customer_id)""",
})


# --- checks ---


def _check(name: str, observed: str, passed: str, expected: str, source: str) -> str:
    """One result row; ``observed`` and ``passed`` are expressions over ``source`` (one row)."""
    quoted = name.replace("'", "''")
    return (
        f"SELECT '{quoted}' AS \"check\", CAST({passed} AS BOOLEAN) AS passed,"
        f" CAST({observed} AS DOUBLE) AS observed, {expected} AS expected FROM {source}"
    )


def _rule(name: str, predicate: str, table: str, expected: str = "no violating rows") -> str:
    source = f"(SELECT count(*) FILTER (NOT coalesce({predicate}, false)) AS n FROM {table})"
    return _check(name, "n", "n = 0", f"'{expected}'", source)


def _criterion(sql_text: str, runs: str) -> str:
    return _check(
        sql_text, "v", "coalesce(v <> 0, false)", "'not null and not zero'",
        f"(SELECT CAST(({runs}) AS DOUBLE) AS v)",
    )


def _listing(sql_text: str, rows: str) -> str:
    return _check(sql_text, "n", "n > 0", "'some rows'", f"(SELECT count(*) AS n FROM {rows})")


_G = "FROM gold.monthly_revenue_summary"
_S = "FROM gold.order_count_by_seller_state"
_CAT = "product_category_name_english"


def _spot(kind: str, year: int, month: int) -> str:
    name = f"spot value: average_installments at payment_type={kind}, year={year}, month={month}"
    source = (
        "(SELECT avg(installments) AS v FROM o JOIN pay USING (order_id)"
        f" WHERE payment_type = '{kind}' AND y = {year} AND m = {month})"
    )
    expected = "'the value recomputed from bronze, within 0.005'"
    return _check(name, "v", "v IS NOT NULL", expected, source)


def _all(*parts: str) -> str:
    return " UNION ALL ".join(parts)


_SQL.update({
    "check_acceptance_sql": _all(
        _criterion(
            f"SELECT count(*) AS n {_G} WHERE year BETWEEN 1996 AND 1998 AND month < 4",
            "SELECT count(*) FROM monthly_revenue_summary"
            " WHERE order_year BETWEEN 1996 AND 1998 AND order_month < 4",
        ),
        _criterion(
            f"SELECT sum(revenue) AS spring {_G} WHERE year = 1996 AND month = 4",
            "SELECT sum(total_revenue) FROM monthly_revenue_summary"
            " WHERE order_year = 1996 AND order_month = 4",
        ),
        _criterion(
            f"SELECT avg(total_revenue) AS mean {_G} WHERE order_year = 1997",
            "SELECT avg(total_revenue) FROM monthly_revenue_summary WHERE order_year = 1997",
        ),
        _criterion(f"SELECT sum(revenue) AS future {_G} WHERE year > 2100", "NULL"),
        _check(
            f"SELECT sum(margin) AS margin {_G}", "NULL", "false",
            "'runs (unresolved_column.with_suggestion)'", "(SELECT 1)",
        ),
        _listing(f"SELECT DISTINCT seller_state {_S}",
                 "(SELECT DISTINCT seller_state FROM order_count_by_seller_state)"),
        _listing(f"SELECT total_orders {_S} WHERE total_orders > 0",
                 "order_count_by_seller_state WHERE total_orders > 0"),
        _listing(f"SELECT seller_state, total_orders {_S} WHERE total_orders < 0",
                 "order_count_by_seller_state WHERE total_orders < 0"),
    ),
    "check_row_predicates": _all(
        _rule("every row: total_revenue > 0", "total_revenue > 0", "monthly_revenue_summary"),
        _rule("every row: delivery_days >= 0", "delivery_days >= 0", "order_delivery_sla"),
        _rule("every row: NOT is_late", "NOT is_late", "order_delivery_sla"),
    ),
    "check_not_null": _all(*[
        _rule(f"not null: {_CAT}", f"{_CAT} IS NOT NULL", table, "no null values")
        for table in ("monthly_revenue_summary", "yearly_average_revenue_by_category")
    ]),
    "check_between": _all(
        _rule("between: order_month", "order_month BETWEEN 1 AND 12", "monthly_revenue_summary",
              "no value outside 1..12"),
        _rule("between: repeat_rate", "repeat_rate BETWEEN 0 AND 1", "customer_repeat_rate",
              "no value outside 0..1"),
        _rule("between: delivery_days", "delivery_days BETWEEN 0 AND 30", "order_delivery_sla",
              "no value outside 0..30"),
    ),
    "check_in_set": _all(
        _rule("every row: payment_value > 0", "payment_value > 0", "payment_mix_by_state"),
        _rule("in set: payment_type",
              "payment_type IN ('credit_card', 'boleto', 'voucher', 'debit_card')",
              "payment_mix_by_state", "only credit_card, boleto, voucher, debit_card"),
        _rule("in set: customer_state", "customer_state IN ('ASIA', 'EUROPE')",
              "payment_mix_by_state", "only ASIA, EUROPE"),
    ),
    "check_rowcount_equals_distinct": _check(
        "row count equals distinct payment_type", "n", "n = d", "d || ' rows'",
        "(SELECT (SELECT count(*) FROM installments_by_payment_type) AS n,"
        " (SELECT count(DISTINCT payment_type) FROM pay) AS d)",
    ),
    "check_unique_grain": _all(
        _check("unique grain: order_year, order_month", "n", "n = 0", "'no repeated key'",
               "(SELECT count(*) AS n FROM (SELECT 1 FROM average_items_per_order_monthly"
               " GROUP BY order_year, order_month HAVING count(*) > 1))"),
        _check("unique grain: order_id, order_item_id", "n", "n = 0", "'no repeated key'",
               "(SELECT count(*) AS n FROM (SELECT 1 FROM i"
               " GROUP BY order_id, order_item_id HAVING count(*) > 1))"),
    ),
    "check_reconcile_bronze": _check(
        "reconciles with bronze: total_weight", "n", "n = 0",
        "'no key differs by more than 0.005'",
        """(SELECT count(*) AS n FROM product_weight_summary_by_city AS a FULL JOIN
            (SELECT city, sum(w) AS w FROM c JOIN
                (SELECT customer_id, sum(weight) AS w FROM o JOIN i USING (order_id)
                 JOIN p USING (product_id) GROUP BY customer_id) USING (customer_id)
             GROUP BY city) AS b ON a.customer_city = b.city
            WHERE a.total_weight IS DISTINCT FROM b.w)""",
    ),
    "check_period_scope": _all(
        _rule("year scope: year", '"year" IN (1996, 1997, 1998)', "period_revenue_by_category",
              "only 1996, 1997, 1998"),
        _rule("month scope: month", '"month" IN (1, 2, 3)', "period_revenue_by_category",
              "only 1, 2, 3"),
        _rule("year scope: order_year", "order_year IN (1996, 1997, 1998)",
              "monthly_revenue_summary", "only 1996, 1997, 1998"),
        _rule("month scope: order_month", "order_month IN (1, 2, 3)",
              "monthly_revenue_summary", "only 1, 2, 3"),
    ),
    "check_spot_value": _all(_spot("credit_card", 1997, 1), _spot("boleto", 1998, 12)),
    "check_non_empty": _all(
        _check("non-empty: rows", "n", "n >= 1", "'at least 1'",
               "(SELECT count(*) AS n FROM freight_by_category)"),
        _check(f"non-empty: distinct {_CAT}", "n", "n >= 1", "'at least 1'",
               f"(SELECT count(DISTINCT {_CAT}) AS n FROM freight_by_category)"),
        _check("non-empty: rows", "n", "n >= 1", "'at least 1'",
               "(SELECT count(*) AS n FROM freight_by_category WHERE avg_price < 0)"),
    ),
    "check_category_allowlist": _all(
        _check(f"allowlist: {_CAT}", "n", "n = 0", f"'only values of {_CAT}'",
               f"(SELECT count(DISTINCT {_CAT}) AS n FROM monthly_revenue_summary"
               f" WHERE {_CAT} NOT IN (SELECT eng FROM t))"),
        _check("allowlist: product_category_name", "n", "n = 0",
               "'only values of product_category_name'",
               "(SELECT count(DISTINCT cat) AS n FROM p WHERE cat NOT IN (SELECT cat FROM t))"),
    ),
    "validation_report": """
        WITH found AS (
            SELECT * FROM (VALUES
                ('every row: total_revenue > 0', 'error',
                    (SELECT count(*) FROM g WHERE NOT total_revenue > 0), 'no violating rows'),
                ('not null: product_category_name_english', 'error',
                    (SELECT count(*) FROM g WHERE product_category_name_english IS NULL),
                    'no null values'),
                ('between: order_month', 'error',
                    (SELECT count(*) FROM g WHERE order_month NOT BETWEEN 1 AND 12),
                    'no value outside 1..12'),
                ('unique grain: order_year, order_month, product_category_name_english', 'error',
                    (SELECT count(*) FROM (SELECT 1 FROM g GROUP BY order_year, order_month,
                        product_category_name_english HAVING count(*) > 1)), 'no repeated key'),
                ('non-empty: rows', 'error', (SELECT count(*) FROM g), 'at least 1'),
                ('every row: total_orders >= 20', 'warning',
                    (SELECT count(*) FROM g WHERE NOT total_orders >= 20), 'no violating rows')
            ) AS v("check", severity, n, expected)),
        judged AS (
            SELECT *, CASE WHEN expected = 'at least 1' THEN n >= 1 ELSE n = 0 END AS passed
            FROM found)
        SELECT "check", passed, severity,
            'observed ' || format('{:,}', n) || '.00, expected ' || expected AS message,
            bool_and(passed OR severity <> 'error') OVER () AS overall_passed,
            avg(CASE WHEN passed THEN 1 ELSE 0 END) OVER () AS score,
            'first run' AS run_id
        FROM judged""".replace(" g ", " monthly_revenue_summary ").replace(
            " g)", " monthly_revenue_summary)"
        ),
})

# --- profiles, charts, logs ---


def _profile(column: str, kind: str, numeric: bool) -> str:
    number = column if numeric else "CAST(NULL AS DOUBLE)"
    return f"""SELECT '{column}' AS "column", '{kind}' AS "type", count({column}) AS "count",
        count(*) - count({column}) AS missing, CAST(min({column}) AS VARCHAR) AS "min",
        CAST(max({column}) AS VARCHAR) AS "max", CAST(avg({number}) AS DOUBLE) AS mean,
        stddev_samp({number}) AS std, count(*) FILTER ({number} = 0) AS zeros,
        count(DISTINCT {column}) AS "distinct",
        CAST(quantile_cont({number}, 0.25) AS DOUBLE) AS p25,
        CAST(quantile_cont({number}, 0.5) AS DOUBLE) AS p50,
        CAST(quantile_cont({number}, 0.75) AS DOUBLE) AS p75 FROM x"""


def _top(column: str) -> str:
    return f"""SELECT '{column}' AS "column", CAST(row_number() OVER (ORDER BY n DESC, value)
        AS INTEGER) AS "rank", value, n
        FROM (SELECT CAST({column} AS VARCHAR) AS value, count(*) AS n
              FROM order_delivery_sla GROUP BY 1) QUALIFY "rank" <= 5"""


def _histogram(column: str) -> str:
    return f"""SELECT '{column}' AS "column", CAST(b AS INTEGER) AS bin,
            lo + b * ((hi - lo) / 10) AS bin_start, lo + (b + 1) * ((hi - lo) / 10) AS bin_end,
            (SELECT count(*) FROM i
             WHERE least(floor(({column} - lo) / (hi - lo) * 10), 9) = b) AS n
        FROM range(10) AS r(b), (SELECT CAST(min({column}) AS DOUBLE) AS lo,
            CAST(max({column}) AS DOUBLE) AS hi FROM i)"""


def _role(position: int, column: str, role: str) -> str:
    length = f"sum(length({column})) / count({column})" if role == "category" else "NULL"
    return f"""SELECT '{column}' AS "column", {position} AS "position", '{role}' AS "role",
        count({column}) AS n_values, count(DISTINCT {column}) AS n_distinct,
        CAST({length} AS DOUBLE) AS avg_label_length,
        coalesce({length} > 15, false) AS horizontal FROM monthly_revenue_summary"""


_SQL.update({
    "profile_columns": """WITH x AS (SELECT product_id, cat AS product_category_name,
        eng AS product_category_name_english, weight AS product_weight_g FROM pt) """ + _all(
        _profile("product_id", "bigint", True),
        _profile("product_category_name", "string", False),
        _profile("product_category_name_english", "string", False),
        _profile("product_weight_g", "int", True),
    ),
    "profile_top_values": _all(f"({_top('delivery_days')})", f"({_top('is_late')})"),
    "profile_histogram": _all(_histogram("price"), _histogram("order_item_id")),
    "profile_correlation": _all(*[
        f"SELECT '{a}' AS column_a, '{b}' AS column_b, corr({x}, {y}) AS correlation FROM i"
        for (a, x), (b, y) in (
            (("price", "price"), ("freight_value", "freight")),
            (("price", "price"), ("order_item_id", "order_item_id")),
            (("freight_value", "freight"), ("order_item_id", "order_item_id")),
        )
    ]),
    "profile_smoke": """
        WITH x AS (SELECT order_id, order_item_id, cat, eng FROM i JOIN pt USING (product_id))
        SELECT (SELECT count(*) FROM x) AS row_count,
            (SELECT CAST(sum(CASE WHEN cat IS NULL THEN 1 ELSE 0 END
                + CASE WHEN eng IS NULL THEN 1 ELSE 0 END) AS DOUBLE) / (count(*) * 4) FROM x)
                AS null_share,
            (SELECT count(*) FROM x) - (SELECT count(*) FROM (SELECT DISTINCT * FROM x))
                AS duplicate_rows""",
    "chart_preview_line": """
        SELECT format('{:04d}-{:02d}', order_year, order_month) AS period,
            sum(total_revenue) AS total_revenue
        FROM monthly_revenue_summary
        WHERE order_year IN (1996, 1997, 1998) AND order_month IN (1, 2, 3)
        GROUP BY order_year, order_month""",
    "chart_rank_topn": """
        SELECT seller_city, CAST(sum(total_orders) AS DOUBLE) AS total_orders
        FROM order_count_by_seller_state_city GROUP BY seller_city
        ORDER BY total_orders DESC, seller_city LIMIT 10""",
    "chart_surface": """
        SELECT *, CAST(dense_rank() OVER (ORDER BY period) - 1 AS INTEGER) AS period_idx,
            CAST(dense_rank() OVER (ORDER BY series) - 1 AS INTEGER) AS series_idx
        FROM (SELECT format('{:04d}-{:02d}', "year", "month") AS period, payment_type AS series,
                  average_installments
              FROM average_installments_by_payment_type_monthly)""",
    "chart_grouped_bar": """
        SELECT customer_state,
            coalesce(product_category_name_english, 'unknown') AS product_category_name_english,
            CAST(order_count AS DOUBLE) AS order_count
        FROM order_count_by_state_and_category""",
    "chart_scatter": """
        SELECT order_year, order_month, product_category_name_english, total_orders AS x,
            total_revenue AS y FROM monthly_revenue_summary""",
    "chart_composition": """
        SELECT customer_city, CAST(total_weight AS DOUBLE) AS total_weight,
            CAST(total_weight AS DOUBLE) / CAST(sum(total_weight) OVER () AS DOUBLE) AS share,
            count(*) OVER () AS categories
        FROM product_weight_summary_by_city""",
    "chart_column_roles": _all(
        _role(0, "order_year", "time"),
        _role(1, "order_month", "time"),
        _role(2, "product_category_name_english", "category"),
        _role(3, "total_revenue", "metric"),
        _role(4, "total_orders", "metric"),
        _role(5, "avg_order_value", "metric"),
    ),
    "log_line_failures": r"""
        WITH l AS (
            SELECT 'application_' || source || '_' || (doc_id % 7) AS job, doc_id,
                string_split(coalesce(text, '') || CASE
                    WHEN doc_id % 11 = 0 THEN chr(10) || 'Traceback (most recent call last):'
                    WHEN doc_id % 5 = 0 THEN chr(10) || 'pyspark.errors.AnalysisException: x'
                    ELSE '' END, chr(10)) AS parts
            FROM documents),
        n AS (
            SELECT job, parts[i] AS line, row_number() OVER (PARTITION BY job ORDER BY doc_id, i) AS nr
            FROM l, unnest(range(1, len(parts) + 1)) AS u(i)),
        f AS (
            SELECT job, min(CASE WHEN contains(line, 'Traceback (most recent call last)')
                    THEN nr END) AS traced,
                min(CASE WHEN contains(line, 'AnalysisException') THEN nr END) AS analysis
            FROM n GROUP BY job)
        SELECT job, CASE WHEN traced IS NOT NULL THEN 'traceback' ELSE 'analysis' END AS kind,
            min_by(line, nr) AS first_line, count(*) AS n_lines, CAST(sum(length(line)) AS BIGINT) AS n_chars
        FROM n JOIN f USING (job) WHERE nr >= coalesce(traced, analysis)
        GROUP BY job, traced""",
    "log_failure_scan": r"""
        WITH l AS (
            SELECT 'containers/application_' || source
                || CASE doc_id % 2 WHEN 0 THEN '/attempt/' ELSE '/' END || doc_id || '/stdout.gz'
                AS path,
                CASE doc_id % 3
                WHEN 0 THEN text || chr(10) || 'Traceback (most recent call last):' || chr(10) || text
                WHEN 1 THEN text || chr(10) || 'pyspark.errors.AnalysisException: ' || text
                ELSE text END AS text
            FROM documents),
        k AS (
            SELECT *, strpos(text, 'AnalysisException') AS a,
                CASE WHEN contains(text, 'Traceback (most recent call last)') THEN 'traceback'
                     WHEN contains(text, 'AnalysisException') THEN 'analysis' END AS kind FROM l)
        SELECT path, CAST(length(path) - length(replace(path, '/', '')) AS INTEGER) AS depth, kind,
            CASE kind WHEN 'traceback'
                    THEN substring(text, strpos(text, 'Traceback (most recent call last)'))
                WHEN 'analysis' THEN substring(text, a) END AS excerpt,
            text AS tail
        FROM k""",
})
_SQL["log_first_failure"] = _SQL["log_failure_scan"].rsplit("SELECT path", 1)[0] + """
        SELECT path, CAST(length(path) - length(replace(path, '/', '')) AS INTEGER) AS depth, kind
        FROM k WHERE kind IS NOT NULL ORDER BY depth, path LIMIT 1"""


def _complete(sql: str) -> str:
    """Prepend the raw tables and marts that the statement names, directly or indirectly."""
    known = {**_BRONZE, **_GOLD}
    needed: set[str] = set()
    todo = [sql]
    while todo:
        words = set(todo.pop().replace("(", " ").replace(")", " ").replace(".", " ")
                    .replace(",", " ").split())
        fresh = (words & set(known)) - needed
        needed |= fresh
        todo += [known[name] for name in fresh]
    parts = ", ".join(f"{name} AS ({known[name]})" for name in known if name in needed)
    body = sql.strip()
    if not parts:
        return body
    if body.upper().startswith("WITH "):
        return f"WITH {parts}, {body[5:]}"
    return f"WITH {parts} {body}"


# Sums of doubles end in digits that depend on how they are added up, so both sides round theirs,
# after a nudge that takes exact halves to one side.
ORACLE_DIGITS, ORACLE_NUDGE = 4, "1e-7"
_DOUBLES: dict[str, str] = {
    name: columns
    for columns, names in {
        "total_revenue": "monthly_average_revenue_by_product period_revenue_by_product"
        " period_revenue_total period_revenue_by_category chart_preview_line",
        "total_revenue avg_order_value": "monthly_revenue_summary monthly_revenue_distinct_orders"
        " sink_gold_parquet sink_gold_partition_overwrite sink_gold_publish filter_period_in",
        "average_revenue": "avg_order_revenue_by_product_monthly yearly_average_revenue_by_category",
        "revenue": "quarterly_revenue_summary quarterly_revenue_by_quarter",
        "average_installments": "average_installments_by_payment_type_monthly chart_surface",
        "average_installments payment_value": "installments_by_payment_type",
        "payment_value": "payment_mix_by_state monthly_revenue_by_payment_type",
        "monetary": "customer_rfm_segments",
        "repeat_rate": "customer_repeat_rate",
        "avg_review_score total_revenue cancellation_rate": "seller_performance_scorecard",
        "average_items_per_order": "average_items_per_order_monthly",
        "avg_items_per_order": "order_basket_size",
        "avg_freight_cost": "average_freight_cost_by_category freight_by_category_filtered",
        "avg_freight_value avg_price": "freight_by_category",
        "price": "product_price_weight_flags star_join",
        "price freight_value": "scan_bronze_parquet",
        "lat lng": "join_geolocation_zip",
        "observed": " ".join(n for n in _SQL if n.startswith("check_")),
        "score": "validation_report",
        "mean std p25 p50 p75": "profile_columns",
        "bin_start bin_end": "profile_histogram",
        "correlation": "profile_correlation",
        "null_share": "profile_smoke",
        "total_orders": "chart_rank_topn",
        "order_count": "chart_grouped_bar",
        "y": "chart_scatter",
        "total_weight share": "chart_composition",
        "avg_label_length": "chart_column_roles",
    }.items()
    for name in names.split()
}


def _rounded(name: str, sql: str) -> str:
    columns = _DOUBLES.get(name, "").split()
    if not columns:
        return sql
    replaced = ", ".join(f'round("{c}" + {ORACLE_NUDGE}, {ORACLE_DIGITS}) AS "{c}"' for c in columns)
    return f"SELECT * REPLACE ({replaced}) FROM ({sql})"


ORACLE: dict[str, str] = {name: _rounded(name, _complete(sql)) for name, sql in _SQL.items()}
