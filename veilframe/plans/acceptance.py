"""Acceptance queries: one per category of SQL, run through ``operators.queries``.

Where one text suits Spark and the oracle, ``ORACLE`` has no entry.  Queries are
written for skewed tables: rows are reduced to one per key before a join or a
window, and a running total over a hot key is built from totals per day.
"""

from __future__ import annotations

SPARK: dict[str, str] = {
    "sql_avg": "SELECT round(avg(l_extendedprice), 4) AS avg_price FROM lineitem",
    "sql_project": """
        SELECT l_orderkey, l_linenumber, l_partkey,
               round(l_extendedprice * (1 - l_discount), 4) AS disc_price,
               CASE WHEN l_quantity >= 25 THEN 'big' ELSE 'small' END AS size_class,
               cast(l_quantity AS int) AS quantity
        FROM lineitem""",
    "sql_filter": """
        SELECT l_orderkey, l_linenumber, l_suppkey, l_quantity, l_returnflag
        FROM lineitem
        WHERE l_shipdate BETWEEN TIMESTAMP '1995-01-01 00:00:00' AND TIMESTAMP '1995-12-31 23:59:59'
          AND l_returnflag IN ('A', 'R') AND l_linestatus LIKE 'F%' AND l_partkey IS NOT NULL""",
    "sql_group_having": """
        SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, count(*) AS n_lines
        FROM lineitem GROUP BY l_returnflag, l_linestatus HAVING count(*) > 10""",
    "sql_distinct": "SELECT event_type, count(DISTINCT user_id) AS n_users FROM events GROUP BY event_type",
    "sql_distinct_rows": "SELECT DISTINCT user_id, event_type FROM events",
    "sql_rollup": """
        WITH per_customer AS (
          SELECT o_custkey, o_orderstatus, sum(o_totalprice) AS price, count(*) AS n
          FROM orders GROUP BY o_custkey, o_orderstatus)
        SELECT c_mktsegment, o_orderstatus, round(sum(price), 0) AS revenue, cast(sum(n) AS bigint) AS n_orders
        FROM per_customer JOIN customer ON o_custkey = c_custkey
        GROUP BY ROLLUP (c_mktsegment, o_orderstatus)""",
    "sql_cube": """
        SELECT l_returnflag, l_linestatus, count(*) AS n_lines
        FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)""",
    "sql_grouping_sets": """
        SELECT event_type, user_id, count(*) AS n_events
        FROM events GROUP BY GROUPING SETS ((event_type), (user_id), ())""",
    "sql_join_inner": """
        WITH per_customer AS (
          SELECT o_custkey, count(*) AS n, sum(o_totalprice) AS price FROM orders GROUP BY o_custkey)
        SELECT n_name, cast(sum(n) AS bigint) AS n_orders, round(sum(price), 0) AS total
        FROM per_customer
        JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey
        GROUP BY n_name""",
    "sql_join_left": """
        SELECT c_custkey, c_mktsegment, n_orders
        FROM customer
        LEFT JOIN (SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY o_custkey) o
          ON o_custkey = c_custkey""",
    "sql_join_right": """
        SELECT n_regionkey, r_regionkey, r_name, n_name, n_suppliers
        FROM (SELECT s_nationkey, count(*) AS n_suppliers FROM supplier GROUP BY s_nationkey) s
        RIGHT JOIN nation ON s_nationkey = n_nationkey
        RIGHT JOIN region ON n_regionkey = r_regionkey""",
    "sql_join_full": """
        SELECT s.nationkey AS supplier_nation, c.nationkey AS customer_nation, n_suppliers, n_customers
        FROM (SELECT s_nationkey AS nationkey, count(*) AS n_suppliers FROM supplier
              WHERE s_acctbal > 0 GROUP BY s_nationkey) s
        FULL JOIN (SELECT c_nationkey AS nationkey, count(*) AS n_customers FROM customer
              WHERE c_acctbal < 0 GROUP BY c_nationkey) c
          ON s.nationkey = c.nationkey""",
    "sql_semi": """
        SELECT c_custkey, c_name FROM customer
        WHERE EXISTS (SELECT 1 FROM (SELECT DISTINCT o_custkey FROM orders WHERE o_totalprice > 300000) o
                      WHERE o.o_custkey = c_custkey)""",
    "sql_anti": """
        SELECT p_partkey, p_name FROM part
        WHERE NOT EXISTS (SELECT 1 FROM (SELECT DISTINCT l_partkey FROM lineitem WHERE l_quantity > 45) l
                          WHERE l.l_partkey = p_partkey)""",
    # Parts whose price lies within 5 of each price.  Prices are counted first, then
    # matched on price bands of that width and tested exactly, so the join has an
    # equality and a hot price is one row.
    "sql_range_join": """
        WITH prices AS (
          SELECT p_retailprice AS price, count(*) AS n, cast(floor(p_retailprice / 5) AS bigint) AS band
          FROM part GROUP BY p_retailprice),
        probes AS (
          SELECT price, band + d AS band FROM prices LATERAL VIEW explode(array(-1, 0, 1)) t AS d)
        SELECT a.price AS price, cast(sum(b.n) AS bigint) AS n_parts
        FROM probes a JOIN prices b ON a.band = b.band AND b.price BETWEEN a.price - 5 AND a.price + 5
        GROUP BY a.price""",
    # Row number, previous type and running count of each user's events.  A hot user is split
    # by minute: numbers inside the minute plus totals of the minutes before.  Rows without user or
    # time are a group like any other, so the join is null-safe.
    "sql_window": """
        WITH e AS (SELECT event_id, user_id, event_type, ts, date_trunc('MINUTE', ts) AS part FROM events),
        inside AS (
          SELECT *, row_number() OVER w AS rn, lag(event_type) OVER w AS prev,
                 count(CASE WHEN event_type = 'purchase' THEN 1 END) OVER (
                   PARTITION BY user_id, part ORDER BY ts, event_id
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS bought
          FROM e WINDOW w AS (PARTITION BY user_id, part ORDER BY ts, event_id)),
        parts AS (
          SELECT user_id, part, count(*) AS n, count(CASE WHEN event_type = 'purchase' THEN 1 END) AS b,
                 max_by(event_type, struct(ts, event_id)) AS last_type
          FROM e GROUP BY user_id, part),
        before AS (
          SELECT user_id AS u, part AS p, coalesce(sum(n) OVER q, 0) AS n_before,
                 coalesce(sum(b) OVER q, 0) AS b_before,
                 lag(last_type) OVER (PARTITION BY user_id ORDER BY part) AS last_before
          FROM parts
          WINDOW q AS (PARTITION BY user_id ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
        SELECT event_id, user_id, cast(rn + n_before AS bigint) AS row_num,
               CASE WHEN rn = 1 THEN last_before ELSE prev END AS prev_type,
               cast(bought + b_before AS bigint) AS purchases_so_far
        FROM inside JOIN before ON user_id <=> u AND part <=> p""",
    "sql_rank": """
        SELECT p_brand, p_type, n_parts,
               rank() OVER (PARTITION BY p_brand ORDER BY n_parts DESC) AS rnk,
               dense_rank() OVER (PARTITION BY p_brand ORDER BY n_parts DESC) AS drnk
        FROM (SELECT p_brand, p_type, count(*) AS n_parts FROM part GROUP BY p_brand, p_type) t""",
    "sql_topk": """
        SELECT o_orderkey, o_custkey, o_totalprice FROM orders
        ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""",
    "sql_union_all": """
        SELECT c_nationkey AS nationkey, 'customer' AS kind FROM customer
        UNION ALL SELECT s_nationkey, 'supplier' FROM supplier""",
    "sql_union": "SELECT c_nationkey AS nationkey FROM customer UNION SELECT s_nationkey FROM supplier",
    "sql_intersect": """
        SELECT c_nationkey AS nationkey FROM customer WHERE c_acctbal < 0
        INTERSECT SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000""",
    "sql_except": """
        SELECT n_nationkey AS nationkey FROM nation
        EXCEPT SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000""",
    "sql_intersect_all": """
        SELECT o_custkey AS custkey FROM orders WHERE o_orderstatus = 'F'
        INTERSECT ALL SELECT o_custkey FROM orders WHERE o_orderstatus <> 'F'""",
    "sql_except_all": """
        SELECT o_custkey AS custkey FROM orders WHERE o_orderstatus = 'F'
        EXCEPT ALL SELECT o_custkey FROM orders WHERE o_orderstatus <> 'F'""",
    "sql_subquery": """
        WITH priced AS (SELECT o_custkey, o_orderkey, o_totalprice FROM orders)
        SELECT o_orderkey, o_custkey FROM priced p
        WHERE o_totalprice > (SELECT avg(o_totalprice) FROM priced q WHERE q.o_custkey = p.o_custkey)
          AND o_totalprice > (SELECT min(o_totalprice) * 2 FROM priced)""",
    "sql_strings": """
        SELECT p_partkey, upper(p_name) AS name_upper, substr(p_name, 2, 4) AS name_part,
               length(p_name) AS name_length, replace(p_brand, '#', '-') AS brand,
               round(sqrt(p_retailprice), 3) AS root, abs(p_size - 25) AS distance, p_size % 7 AS remainder
        FROM part""",
    "sql_dates": """
        SELECT year(o_orderdate) AS y, month(o_orderdate) AS m, count(*) AS n_orders,
               cast(max(datediff(o_orderdate, date_trunc('MONTH', o_orderdate))) AS bigint) AS last_day_offset
        FROM orders GROUP BY year(o_orderdate), month(o_orderdate)""",
    "sql_arrays": """
        SELECT vec_id, label, size(embedding) AS n_dims,
               round(aggregate(embedding, cast(0 AS double), (a, x) -> a + x), 4) AS total,
               round(cast(element_at(embedding, 1) AS double), 5) AS first_value,
               size(filter(embedding, x -> x > 0)) AS n_positive
        FROM embeddings""",
    "sql_maps": """
        SELECT user_id, element_at(counts, 'view') AS n_view, element_at(counts, 'click') AS n_click,
               size(counts) AS n_types
        FROM (SELECT user_id, map_from_entries(collect_list(struct(event_type, n))) AS counts
              FROM (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY user_id, event_type) t
              GROUP BY user_id) u""",
    "sql_json": """
        SELECT event_type, count(*) AS n_events,
               cast(sum(cast(get_json_object(props, '$.k') AS int)) AS bigint) AS sum_k,
               max(from_json(props, 'k INT').k) AS max_k
        FROM events GROUP BY event_type""",
}

ORACLE: dict[str, str] = {
    "sql_range_join": """
        WITH prices AS (SELECT p_retailprice AS price, count(*) AS n FROM part GROUP BY p_retailprice)
        SELECT a.price AS price, cast(sum(b.n) AS bigint) AS n_parts
        FROM prices a JOIN prices b ON b.price BETWEEN a.price - 5 AND a.price + 5
        GROUP BY a.price""",
    "sql_window": """
        SELECT event_id, user_id, row_number() OVER w AS row_num, lag(event_type) OVER w AS prev_type,
               count(CASE WHEN event_type = 'purchase' THEN 1 END) OVER (
                 PARTITION BY user_id ORDER BY ts, event_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS purchases_so_far
        FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
    "sql_dates": """
        SELECT year(o_orderdate) AS y, month(o_orderdate) AS m, count(*) AS n_orders,
               max(date_diff('day', date_trunc('month', o_orderdate), o_orderdate)) AS last_day_offset
        FROM orders GROUP BY year(o_orderdate), month(o_orderdate)""",
    "sql_arrays": """
        SELECT vec_id, label, len(embedding) AS n_dims,
               round(list_sum(list_transform(embedding, lambda x: cast(x AS double))), 4) AS total,
               round(cast(embedding[1] AS double), 5) AS first_value,
               len(list_filter(embedding, lambda x: x > 0)) AS n_positive
        FROM embeddings""",
    "sql_maps": """
        SELECT user_id, nullif(count(*) FILTER (event_type = 'view'), 0) AS n_view,
               nullif(count(*) FILTER (event_type = 'click'), 0) AS n_click,
               count(DISTINCT event_type) AS n_types
        FROM events GROUP BY user_id""",
    "sql_json": """
        SELECT event_type, count(*) AS n_events, cast(sum(cast(props ->> '$.k' AS int)) AS bigint) AS sum_k,
               max(cast(props ->> '$.k' AS int)) AS max_k
        FROM events GROUP BY event_type""",
}


def oracle(name: str) -> str:
    return ORACLE.get(name, SPARK[name])
