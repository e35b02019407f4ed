"""DuckDB SQL for the correctness oracle.

The basket tables are written as CTEs over the driver's views (orders,
lineitem, part) with plain window functions; every oracle string starts with
them. Doubles are rounded to 9 places on both sides of the comparison.
"""

from __future__ import annotations

from cartwise.sources.schemas import FEATURE_SCHEMA

R = 9  # rounding digits for double columns in registered queries


def basket_cte(grain: str = "part") -> str:
    """CTEs b_products, b_orders, b_lines (no leading WITH, trailing comma-free)."""
    if grain == "part":
        product, line_product = "c.p_partkey", "l.l_partkey"
    elif grain == "brand_type":
        product = "CAST(c.aisle_id AS BIGINT) * ((SELECT count(*) FROM b_types) + 1) + c.department_id"
        line_product = "m.product_id"
    else:
        raise ValueError(grain)
    return f"""
b_types AS (
  SELECT p_type, CAST(dense_rank() OVER (ORDER BY p_type) AS INTEGER) AS department_id
  FROM (SELECT DISTINCT p_type FROM part WHERE p_type IS NOT NULL) t),
b_cats AS (
  SELECT p.p_partkey,
         CAST(regexp_extract(p.p_brand, '(\\d+)$', 1) AS INTEGER) AS aisle_id,
         t.department_id
  FROM part p LEFT JOIN b_types t ON p.p_type = t.p_type),
b_pmap AS (
  SELECT c.p_partkey, CAST({product} AS BIGINT) AS product_id,
         c.aisle_id, c.department_id
  FROM b_cats c),
b_products AS (
  SELECT DISTINCT product_id, aisle_id, department_id FROM b_pmap),
b_o AS (
  SELECT o_orderkey, o_custkey, o_orderdate,
         row_number() OVER w AS n,
         lag(o_orderdate) OVER w AS prev_date,
         count(*) OVER (PARTITION BY o_custkey) AS n_orders
  FROM orders
  WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)),
b_orders AS (
  SELECT o_orderkey AS order_id, o_custkey AS user_id,
         CASE WHEN n = n_orders THEN 'train' ELSE 'prior' END AS eval_set,
         CAST(n AS INTEGER) AS order_number,
         CAST(dayofweek(o_orderdate) AS INTEGER) AS order_dow,
         CAST(o_orderkey % 24 AS INTEGER) AS order_hour_of_day,
         CAST(date_diff('day', CAST(prev_date AS DATE), CAST(o_orderdate AS DATE)) AS DOUBLE)
           AS days_since_prior_order
  FROM b_o),
b_l AS (
  SELECT l_orderkey AS order_id, l_partkey,
         CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey,
              l_suppkey, l_shipdate, l_quantity, l_extendedprice) AS INTEGER) AS add_to_cart_order
  FROM lineitem),
b_lines AS (
  SELECT l.order_id, {line_product} AS product_id, l.add_to_cart_order, o.user_id, o.eval_set,
         o.order_number,
         CAST(o.order_number > min(o.order_number) OVER (PARTITION BY o.user_id, {line_product})
              AS INTEGER) AS reordered
  FROM b_l l
  LEFT JOIN b_pmap m ON l.l_partkey = m.p_partkey
  JOIN b_orders o ON l.order_id = o.order_id)"""


def features_cte() -> str:
    """CTE ``features`` (21 columns, unrounded) over the basket CTEs."""
    return """
f_pairs AS (
  SELECT user_id, product_id, count(order_id) AS pc, sum(reordered) AS rc,
         max(order_number) AS lon, sum(add_to_cart_order) AS cs
  FROM b_lines WHERE eval_set = 'prior' GROUP BY user_id, product_id),
f_dims AS (
  SELECT product_id, aisle_id, department_id FROM (
    SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY aisle_id, department_id) AS rn
    FROM b_products) d WHERE rn = 1),
f_users AS (
  SELECT user_id, count(order_id) AS uto, avg(days_since_prior_order) AS uad,
         avg(order_hour_of_day) AS uah, avg(order_dow) AS uadw, max(order_number) AS ulon
  FROM b_orders WHERE eval_set = 'prior' GROUP BY user_id),
f_pc AS (
  SELECT p.*, d.aisle_id, d.department_id FROM f_pairs p LEFT JOIN f_dims d USING (product_id)),
f_prod AS (
  SELECT product_id, sum(pc) AS ptp, count(user_id) AS puu, sum(rc) / sum(pc) AS prr
  FROM f_pc GROUP BY product_id),
f_ud AS (
  SELECT user_id, department_id, sum(pc) AS udc,
         sum(pc) / sum(sum(pc)) OVER (PARTITION BY user_id) AS uds
  FROM f_pc WHERE department_id IS NOT NULL GROUP BY user_id, department_id),
f_ua AS (
  SELECT user_id, aisle_id, sum(pc) AS uac,
         sum(pc) / sum(sum(pc)) OVER (PARTITION BY user_id) AS uas
  FROM f_pc WHERE aisle_id IS NOT NULL GROUP BY user_id, aisle_id),
features AS (
  SELECT CAST(x.user_id AS BIGINT) AS user_id,
         CAST(x.product_id AS BIGINT) AS product_id,
         CAST(x.pc AS BIGINT) AS user_product_purchase_count,
         CAST(x.rc AS BIGINT) AS user_product_reorder_count,
         CAST(x.lon AS BIGINT) AS user_product_last_order_number,
         CAST(x.rc AS DOUBLE) / x.pc AS user_product_reorder_rate,
         CAST(x.cs AS DOUBLE) / x.pc AS user_product_avg_cart_position,
         CAST(u.ulon - x.lon AS BIGINT) AS user_product_recency_orders,
         CAST(x.department_id AS BIGINT) AS department_id,
         CAST(coalesce(ud.udc, 0) AS BIGINT) AS user_department_purchase_count,
         CAST(coalesce(ud.uds, 0) AS DOUBLE) AS user_department_purchase_share,
         CAST(x.aisle_id AS BIGINT) AS aisle_id,
         CAST(coalesce(ua.uac, 0) AS BIGINT) AS user_aisle_purchase_count,
         CAST(coalesce(ua.uas, 0) AS DOUBLE) AS user_aisle_purchase_share,
         CAST(u.uto AS BIGINT) AS user_total_orders,
         CAST(u.uad AS DOUBLE) AS user_avg_days_between_orders,
         CAST(u.uah AS DOUBLE) AS user_avg_order_hour,
         CAST(u.uadw AS DOUBLE) AS user_avg_order_dow,
         CAST(pr.ptp AS BIGINT) AS product_total_purchases,
         CAST(pr.puu AS BIGINT) AS product_unique_users,
         CAST(pr.prr AS DOUBLE) AS product_reorder_rate
  FROM f_pc x
  LEFT JOIN f_users u ON x.user_id = u.user_id
  LEFT JOIN f_prod pr ON x.product_id = pr.product_id
  LEFT JOIN f_ud ud ON x.user_id = ud.user_id AND x.department_id = ud.department_id
  LEFT JOIN f_ua ua ON x.user_id = ua.user_id AND x.aisle_id = ua.aisle_id)"""


def rounded_select(columns_types: list[tuple[str, str]], source: str) -> str:
    """SELECT list rounding double columns to R places."""
    parts = []
    for name, typ in columns_types:
        parts.append(f"round({name}, {R}) AS {name}" if typ == "double" else name)
    return f"SELECT {', '.join(parts)} FROM {source}"


FEATURE_COLS_TYPES = [(f.name, f.dataType.simpleString()) for f in FEATURE_SCHEMA.fields]


def with_ctes(*ctes: str, body: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n" + body


def _md5_key(salt: str) -> str:
    return ("md5(concat_ws('-', CAST(user_id AS VARCHAR), CAST(product_id AS VARCHAR), "
            f"'42{salt}'))")


def labels_cte() -> str:
    """CTEs labelled, split (with is_test), train, test, balanced (over features)."""
    return f"""
lab_future AS (
  SELECT DISTINCT user_id, product_id FROM b_lines WHERE eval_set = 'train'),
labelled AS (
  SELECT f.*, CAST(CASE WHEN x.user_id IS NULL THEN 0 ELSE 1 END AS INTEGER) AS target
  FROM features f LEFT JOIN lab_future x
    ON f.user_id = x.user_id AND f.product_id = x.product_id),
sp_cnt AS (SELECT target, count(*) AS n FROM labelled GROUP BY target),
sp_tot AS (SELECT sum(n) AS n_all, CAST(ceil(CAST(0.2 AS DOUBLE) * sum(n)) AS BIGINT) AS k
           FROM sp_cnt),
sp_q AS (SELECT c.target, (t.k * c.n) // t.n_all AS base, (t.k * c.n) % t.n_all AS rem, t.k
         FROM sp_cnt c CROSS JOIN sp_tot t),
sp_quota AS (
  SELECT target, base + CASE WHEN row_number() OVER (ORDER BY rem DESC, target)
                                  <= k - sum(base) OVER () THEN 1 ELSE 0 END AS quota
  FROM sp_q),
sp_rank AS (
  SELECT l.*, row_number() OVER (PARTITION BY target ORDER BY {_md5_key('')}, user_id NULLS FIRST, product_id NULLS FIRST)
         AS rk
  FROM labelled l),
split AS (
  SELECT r.* EXCLUDE (rk), r.rk <= q.quota AS is_test
  FROM sp_rank r JOIN sp_quota q ON r.target = q.target),
train AS (SELECT * EXCLUDE (is_test) FROM split WHERE NOT is_test),
test AS (SELECT * EXCLUDE (is_test) FROM split WHERE is_test),
bal_pos AS (SELECT count(*) AS n_pos FROM train WHERE target = 1),
bal_neg AS (
  SELECT t.*, row_number() OVER (ORDER BY {_md5_key(':balance')}, user_id NULLS FIRST, product_id NULLS FIRST) AS rk
  FROM train t WHERE target = 0),
balanced AS (
  SELECT * FROM train WHERE target = 1
  UNION ALL
  SELECT b.* EXCLUDE (rk) FROM bal_neg b JOIN bal_pos p ON b.rk <= p.n_pos)"""


def per_class_sample_sql(source: str, size: int, salt: str, proportional_int: bool) -> str:
    """SELECT of a stratified sample of ``size`` rows from ``source``.

    proportional_int: positives = int(size·rate), negatives = rest (CV sample);
    otherwise largest-remainder quotas (tuning sample).
    """
    if proportional_int:
        quota = f"""
q AS (SELECT 1 AS target, CAST(floor({size} * CAST(p AS DOUBLE) / n) AS BIGINT) AS quota FROM c
      UNION ALL
      SELECT 0, {size} - CAST(floor({size} * CAST(p AS DOUBLE) / n) AS BIGINT) FROM c)"""
    else:
        quota = f"""
qc AS (SELECT target, count(*) AS m FROM {source} GROUP BY target),
qb AS (SELECT qc.target, ({size} * qc.m) // c.n AS base, ({size} * qc.m) % c.n AS rem
       FROM qc CROSS JOIN c),
q AS (SELECT target, base + CASE WHEN row_number() OVER (ORDER BY rem DESC, target)
                                   <= {size} - sum(base) OVER () THEN 1 ELSE 0 END AS quota
      FROM qb)"""
    return f"""
c AS (SELECT count(*) AS n, sum(target) AS p FROM {source}),
{quota.strip()},
rk AS (SELECT s.*, row_number() OVER (PARTITION BY target ORDER BY {_md5_key(salt)},
                                      user_id NULLS FIRST, product_id NULLS FIRST) AS rk
       FROM {source} s)
SELECT rk.* EXCLUDE (rk) FROM rk JOIN q ON rk.target = q.target CROSS JOIN c
WHERE c.n <= {size} OR rk.rk <= q.quota"""


def scored_cte() -> str:
    """Deterministic stand-in score on the test split (for metric oracles)."""
    return """
m_scored AS (
  SELECT user_id, product_id, target AS label,
         least(1.0, CAST(user_product_purchase_count AS DOUBLE) / 10) AS score,
         CAST(least(1.0, CAST(user_product_purchase_count AS DOUBLE) / 10) >= 0.5 AS INTEGER)
           AS prediction
  FROM test),
m_cnt AS (
  SELECT count_if(label = 1 AND prediction = 1) AS tp, count_if(label = 0 AND prediction = 1) AS fp,
         count_if(label = 0 AND prediction = 0) AS tn, count_if(label = 1 AND prediction = 0) AS fn,
         count(*) AS n
  FROM m_scored),
m_g AS (SELECT score AS s, count(*) AS c, sum(label) AS p FROM m_scored GROUP BY score),
m_r AS (SELECT s, c, p, coalesce(sum(c) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING
                                                AND 1 PRECEDING), 0) AS below FROM m_g),
m_auc AS (
  SELECT CASE WHEN sum(p) = 0 OR sum(c) = sum(p) THEN NULL
              ELSE (sum(p * (below + (c + 1) / 2.0)) - sum(p) * (sum(p) + 1) / 2.0)
                   / (CAST(sum(p) AS DOUBLE) * (sum(c) - sum(p))) END AS roc_auc
  FROM m_r)"""


def safe_div(a: str, b: str) -> str:
    return f"CASE WHEN ({b}) = 0 THEN 0.0 ELSE CAST({a} AS DOUBLE) / ({b}) END"
