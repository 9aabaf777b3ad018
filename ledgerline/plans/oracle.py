"""DuckDB SQL for the canonical tables, written independently of the Spark code.

Each registered query has an ANSI-SQL twin here, run by the driver on the
same Parquet tables.  Conventions shared with the Spark side:

* money sums are exact decimal sums rounded to cents, returned as DOUBLE;
* a ratio is a DOUBLE quotient of DOUBLE(sum) and DOUBLE(count), rounded
  HALF_UP through DECIMAL(38,10);
* every integer result is BIGINT (or INTEGER where Spark yields ``int``).
"""

from __future__ import annotations


def hu(expr: str, digits: int) -> str:
    """HALF_UP rounding of a DOUBLE, returned as DOUBLE."""
    return f"CAST(round(CAST({expr} AS DECIMAL(38,10)), {digits}) AS DOUBLE)"


def mean(col: str) -> str:
    return f"(CAST(sum({col}) AS DOUBLE) / CAST(count({col}) AS DOUBLE))"


def money(expr: str) -> str:
    """Rounded decimal sum of money as DOUBLE."""
    return f"CAST(round(sum({expr}), 2) AS DOUBLE)"


GEO = """geo AS (
  SELECT c.c_custkey, r.r_name
  FROM customer c
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
)"""

TXN = """txn AS (
  SELECT concat_ws('-', CAST(l.l_orderkey AS VARCHAR), CAST(l.l_linenumber AS VARCHAR)) AS transaction_id,
         CAST(o.o_orderdate AS DATE) AS date,
         g.r_name AS region,
         p.p_type AS category,
         'PROD-' || CAST(l.l_partkey AS VARCHAR) AS product_id,
         CAST(trunc(l.l_quantity) AS INTEGER) AS units,
         CAST(CAST(l.l_extendedprice / NULLIF(l.l_quantity, 0) AS DECIMAL(38,10)) AS DECIMAL(18,2)) AS unit_price,
         CAST(CAST(l.l_discount AS DECIMAL(5,2)) * 100 AS DECIMAL(5,1)) AS discount_pct,
         'CUST-' || CAST(o.o_custkey AS VARCHAR) AS customer_id,
         CAST(round(CAST(l.l_extendedprice AS DECIMAL(18,2))
                    * (1 - CAST(l.l_discount AS DECIMAL(5,2))), 2) AS DECIMAL(18,2)) AS revenue,
         strftime(CAST(o.o_orderdate AS DATE), '%Y-%m') AS year_month,
         CAST(month(o.o_orderdate) AS INTEGER) AS month_num,
         CAST(year(o.o_orderdate) AS INTEGER) AS year
  FROM lineitem l
  LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN geo g ON o.o_custkey = g.c_custkey
  LEFT JOIN part p ON l.l_partkey = p.p_partkey
)"""

SESS = """sess AS (
  SELECT CAST(e.event_id AS VARCHAR) AS session_id,
         e.ts AS timestamp,
         'USR-' || CAST(e.user_id AS VARCHAR) AS user_id,
         CASE (((CAST(json_extract_string(e.props, '$.k') AS INTEGER) % 3) + 3) % 3)
              WHEN 0 THEN 'Desktop' WHEN 1 THEN 'Mobile' WHEN 2 THEN 'Tablet' END AS device,
         CAST((((CAST(json_extract_string(e.props, '$.k') AS INTEGER) % 19) + 19) % 19) + 1 AS INTEGER)
              AS page_views,
         least(1800, greatest(5, CAST(trunc(e.value * 10) AS INTEGER))) AS session_duration_s,
         CAST(e.event_type = 'purchase' AS INTEGER) AS converted,
         g.r_name AS region,
         CAST(hour(e.ts) AS INTEGER) AS hour,
         dayname(e.ts) AS day_of_week
  FROM events e
  LEFT JOIN geo g ON e.user_id = g.c_custkey
)"""

INV = """inv AS (
  SELECT 'PROD-' || CAST(p_partkey AS VARCHAR) AS product_id,
         p_type AS category,
         CAST(p_size % 50 AS INTEGER) AS stock_units,
         CAST(10 + p_partkey % 21 AS INTEGER) AS reorder_level,
         CAST(p_retailprice AS DECIMAL(18,2)) AS unit_cost,
         p_brand AS supplier,
         CASE WHEN p_size % 50 = 0 THEN 'Out of Stock'
              WHEN p_size % 50 < 10 + p_partkey % 21 THEN 'Low Stock'
              ELSE 'Healthy' END AS health
  FROM part
)"""

QUOTES = """quotes AS (
  SELECT 'U' || CAST(user_id AS VARCHAR) AS id,
         'U' || CAST(user_id AS VARCHAR) AS symbol,
         'Asset ' || CAST(user_id AS VARCHAR) AS name,
         value AS priceUsd,
         value * CAST(user_id + 1000 AS DOUBLE) AS marketCapUsd,
         value * CAST(24 AS DOUBLE) AS volumeUsd24Hr,
         value / CAST(10 AS DOUBLE) - CAST(25 AS DOUBLE) AS changePercent24Hr,
         ts AS timestamp,
         event_type
  FROM events
)"""

SNAPSHOT = """snapshot AS (
  SELECT id, symbol, name, priceUsd, marketCapUsd, volumeUsd24Hr, changePercent24Hr, timestamp
  FROM (SELECT *, row_number() OVER (PARTITION BY symbol
                                     ORDER BY timestamp DESC NULLS LAST, id ASC NULLS LAST,
                                              priceUsd DESC NULLS LAST) AS rn
        FROM quotes) t
  WHERE rn = 1
)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def txn_sql(body: str, *extra: str) -> str:
    return with_ctes(GEO, TXN, *extra) + body


def sess_sql(body: str) -> str:
    return with_ctes(GEO, SESS) + body


def under_filters(sql: str, txn_where: str, sess_where: str) -> str:
    """A query of this module with its canonical tables narrowed by the dashboard's filters."""
    for cte, where in ((TXN, txn_where), (SESS, sess_where)):
        name = cte[:cte.index(" AS (")]
        sql = sql.replace(cte, cte.replace(name, f"every_{name}", 1)
                          + f",\n{name} AS (SELECT * FROM every_{name} WHERE {where})")
    return sql


def both_sql(body: str) -> str:
    return with_ctes(GEO, TXN, SESS) + body


def inv_sql(body: str) -> str:
    return with_ctes(INV) + body


def quotes_sql(body: str) -> str:
    return with_ctes(QUOTES) + body


def snapshot_sql(body: str) -> str:
    return with_ctes(QUOTES, SNAPSHOT) + body
