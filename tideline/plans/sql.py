"""Building blocks of the comparison SQL."""

from __future__ import annotations

# The page log of ``tables.as_page_log``.
LOG = """log AS (
  SELECT event_id AS seq, ts, epoch_us(ts) // 1000 AS ts_ms, user_id, event_type, k,
    'mid_' || user_id AS mid,
    CASE WHEN k % 10 <> 9 THEN CAST(user_id AS VARCHAR) END AS uid,
    'v2.' || (k % 5) AS vc, 'ch' || (k % 3) AS ch, CAST(k % 7 AS VARCHAR) AS ar, CAST(k % 2 AS VARCHAR) AS is_new,
    'md' || (k % 9) AS md, 'ba' || (k % 4) AS ba,
    ['Android 13.0', 'iOS 16.1', 'Harmony 4.0'][k % 3 + 1] AS os,
    CASE event_type WHEN 'view' THEN 'home' WHEN 'click' THEN 'good_detail' WHEN 'purchase' THEN 'cart'
      WHEN 'signup' THEN 'login' ELSE 'error' END AS page_id,
    CASE k % 4 WHEN 1 THEN 'login' WHEN 2 THEN 'search' WHEN 3 THEN 'home' END AS last_page_id,
    CASE WHEN k % 4 = 2 THEN 'keyword' ELSE 'sku_id' END AS item_type,
    CASE WHEN k % 4 = 2 THEN 'NATION_' || (k % 30) ELSE CAST(k AS VARCHAR) END AS item,
    CAST(round(value * 100) AS BIGINT) AS during_time,
    CAST(ts AS DATE) AS d
  FROM (SELECT *, CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k FROM events))"""

# The order lines of ``tables.details``; ``v`` numbers all versions.
DETAILS = """det AS (
  SELECT *, row_number() OVER (ORDER BY ts_ms, sku_id, supplier_id, split_original_amount, id) AS v FROM (
    SELECT l_orderkey || '-' || l_linenumber AS id, l_orderkey AS order_id, l_partkey AS sku_id,
      l_suppkey AS supplier_id, l_linenumber AS line_number, CAST(l_quantity AS INTEGER) AS sku_num,
      CAST(l_extendedprice AS DECIMAL(16,2)) AS split_original_amount,
      CAST(l_extendedprice AS DECIMAL(16,2)) * CAST(l_discount AS DECIMAL(4,2)) AS split_activity_amount,
      CAST(l_extendedprice AS DECIMAL(16,2)) * CAST(l_tax AS DECIMAL(4,2)) AS split_coupon_amount,
      CAST(l_extendedprice AS DECIMAL(16,2)) AS split_total_amount,
      l_returnflag AS return_flag, l_linestatus AS line_status, epoch_us(l_shipdate) // 1000 AS ts_ms
    FROM lineitem))"""

ORDERS = """ord AS (
  SELECT o_orderkey AS order_id, o_custkey AS user_id, o_orderstatus AS order_status, o_totalprice AS total_amount,
    o_orderpriority AS priority, epoch_us(o_orderdate) // 1000 AS order_ms, c_nationkey AS province_id
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey)"""


def start(ts: str, seconds: int) -> str:
    """Start of the tumbling window, as a number of microseconds."""
    width = seconds * 1_000_000
    return f"(epoch_us({ts}) // {width}) * {width}"


def bounds(w: str, seconds: int) -> str:
    """``stt, edt, cur_date`` of a window start."""
    width = seconds * 1_000_000
    return (
        f"strftime(make_timestamp({w}), '%Y-%m-%d %H:%M:%S') AS stt, "
        f"strftime(make_timestamp({w} + {width}), '%Y-%m-%d %H:%M:%S') AS edt, "
        f"strftime(make_timestamp({w}), '%Y-%m-%d') AS cur_date"
    )


def values(rows: list[tuple], name: str, columns: str) -> str:
    def lit(x):
        return "NULL" if x is None else str(x) if isinstance(x, (int, float)) else "'" + str(x).replace("'", "''") + "'"

    body = ", ".join("(" + ", ".join(lit(x) for x in r) + ")" for r in rows)
    return f"{name} AS (SELECT * FROM (VALUES {body}) t({columns}))"
