"""The same catalogue as SQL over the given tables, for an outside check."""

from __future__ import annotations

from cellframe.fixtures import DELETE_AT, RANGE_END, RANGE_START, SNAPSHOT_AT
from cellframe.model import REGION_BOUNDS
from cellframe.plans.queries import BATCH, VERSIONS

QUALIFIERS = ["click", "error", "purchase", "signup", "view"]

SALES_LINES = """
one_each AS (
  SELECT CASE WHEN o_orderstatus = 'P' THEN 'C' ELSE '' END
           || CAST(489434 + o_orderkey * 7 AS VARCHAR) AS "Invoice",
         CAST(l_partkey AS VARCHAR) AS "StockCode",
         p_name AS "Description",
         CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS "Quantity",
         strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS "InvoiceDate",
         CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) AS "Price",
         CASE WHEN o_custkey % 10 <> 0 THEN CAST(o_custkey AS VARCHAR) END
           AS "Customer_ID",
         n_name AS "Country",
         l_linenumber
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN part ON l_partkey = p_partkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
),
sales_lines AS (
  SELECT * EXCLUDE (l_linenumber) FROM one_each
  UNION ALL
  SELECT * EXCLUDE (l_linenumber) FROM one_each WHERE l_linenumber = 1
)"""

STRUCT = """{'StockCode': "StockCode", 'Description': "Description",
  'Quantity': "Quantity", 'InvoiceDate': "InvoiceDate", 'Price': "Price",
  'Customer_ID': "Customer_ID", 'Country': "Country"}"""


def _nested(lines: str) -> str:
    return f"""
SELECT "Invoice",
       replace(CAST(to_json(list(o ORDER BY o)) AS VARCHAR),
               ',"Customer_ID":null', '') AS orders
FROM (SELECT DISTINCT "Invoice", {STRUCT} AS o FROM {lines})
GROUP BY "Invoice\""""


INVOICES = f"{SALES_LINES},\ninvoices AS ({_nested('sales_lines')})"
SPARSE = f"""{INVOICES},
sparse AS (
  SELECT "Invoice", CASE WHEN "Invoice" NOT LIKE '%3' THEN orders END AS orders
  FROM invoices
)"""

CELL_LOG = """
cell_log AS (
  SELECT CAST(user_id AS VARCHAR) AS k,
         event_type AS q,
         CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR) AS v,
         epoch_us(ts) // 1000 AS t,
         event_id AS s,
         event_type = 'error' AND value > 100 AS gone
  FROM events
)"""


def _live(puts: str = "true", stones: str = "true", source: str = "cell_log") -> str:
    """Puts that no tombstone of their row masks."""
    return f"""
stones AS (SELECT k, max(t) AS dt FROM {source} WHERE gone AND {stones} GROUP BY k),
live AS (
  SELECT p.* FROM {source} p LEFT JOIN stones USING (k)
  WHERE NOT gone AND {puts} AND (dt IS NULL OR t > dt)
)"""


def _pivot(qualifiers: list[str], source: str = "live") -> str:
    columns = ",\n".join(
        f"coalesce(arg_max(v, (t, s, v)) FILTER (q = '{q}'), '') AS {q}"
        for q in qualifiers
    )
    return f"SELECT k AS user_id, {columns} FROM {source} GROUP BY k"


def _region(key: str, overflow: str) -> str:
    """Region by a plain list of ranges, in key order."""
    last = len(REGION_BOUNDS)
    number = f"CAST({key} AS BIGINT)"
    above, other = (0, last) if overflow == "reference" else (last, last + 1)
    tests = "\n".join(
        f"WHEN {number} < {bound} THEN {i}" for i, bound in enumerate(REGION_BOUNDS)
    )
    return (
        f"CAST(CASE WHEN regexp_matches({key}, '[^0-9]') THEN {other}\n"
        f"{tests}\nELSE {above} END AS INTEGER)"
    )


SCAN = f"WITH {CELL_LOG},{_live()}\n{_pivot(QUALIFIERS)}"
IN_RANGE = f"t >= {RANGE_START} AND t < {RANGE_END}"
TIME_RANGE = f"WITH {CELL_LOG},{_live(puts=IN_RANGE)}\n{_pivot(QUALIFIERS)}"
UNTIL = f"t <= {SNAPSHOT_AT}"
AS_OF = f"WITH {CELL_LOG},{_live(puts=UNTIL, stones=UNTIL)}\n{_pivot(QUALIFIERS)}"


def _versions(puts: str) -> str:
    return f"""WITH {CELL_LOG},{_live(puts=puts)},
one_per_ms AS (SELECT k, q, t, arg_max(v, (s, v)) AS v FROM live GROUP BY k, q, t),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY k, q ORDER BY t DESC) AS version
  FROM one_per_ms
)
SELECT k AS row_key, 'order' AS family, q AS qualifier,
       CAST(version AS INTEGER) AS version, t AS ts, v AS value
FROM ranked WHERE version <= {VERSIONS}"""

KEYS = """
keys AS (
  SELECT CASE WHEN event_type = 'purchase' THEN CAST(user_id AS VARCHAR)
              ELSE 'missing-' || CAST(event_id AS VARCHAR) END AS row_key
  FROM events
  WHERE event_type = 'purchase' OR (event_type = 'signup' AND value > 100)
)"""


def _buyers(value: int) -> str:
    return (
        "SELECT CAST(user_id AS VARCHAR) FROM events "
        f"WHERE event_type = 'purchase' AND value > {value}"
    )


BULK_CELLS = f"""{SPARSE},
cells AS (
  SELECT "Invoice" AS row_key, 'Invoice' AS qualifier, "Invoice" AS value
  FROM sparse
  UNION ALL
  SELECT "Invoice", 'orders', orders FROM sparse WHERE orders IS NOT NULL
),
placed AS (SELECT *, {_region('row_key', 'strict')} AS region FROM cells)"""


def oracle_sql() -> dict[str, str]:
    with_lines, with_invoices = f"WITH {SALES_LINES}", f"WITH {INVOICES}"
    blank_columns = ",\n".join(f"coalesce(g.{q}, '') AS {q}" for q in QUALIFIERS)
    return {
        "nest_orders": f"{with_lines}\n{_nested('sales_lines')}",
        "nest_chunked": f"{with_lines}\n{_nested('sales_lines')}",
        "nest_dedup": f"""{with_lines}
SELECT "Invoice", count(DISTINCT {STRUCT}) AS n_lines
FROM sales_lines GROUP BY "Invoice\"""",
        "nest_null_fields": f"""{with_lines}
SELECT "Invoice", count(DISTINCT {STRUCT}) AS n_lines,
       count(DISTINCT {STRUCT}) FILTER ("Customer_ID" IS NOT NULL) AS n_customers
FROM sales_lines GROUP BY "Invoice\"""",
        "csv_source": f"{with_lines}\nSELECT * FROM sales_lines",
        "key_list_source": f"WITH {KEYS}\nSELECT row_key FROM keys",
        "record_to_cells": f"""{with_invoices}
SELECT "Invoice" AS row_key, 'Invoice' AS qualifier, "Invoice" AS value FROM invoices
UNION ALL
SELECT "Invoice", 'orders', orders FROM invoices""",
        "put_upsert": f"""{with_invoices}
SELECT "Invoice",
       CASE WHEN "Invoice" LIKE 'C%' THEN 'again ' || "Invoice" ELSE orders END AS orders
FROM invoices""",
        "put_rejects": f"""{with_invoices}
SELECT CASE WHEN "Invoice" LIKE '%9' THEN '' WHEN "Invoice" NOT LIKE '%7' THEN "Invoice" END
         AS "Invoice",
       orders, "Invoice" LIKE '%9' OR "Invoice" LIKE '%7' AS rejected
FROM invoices""",
        "scan_latest": SCAN,
        "scan_snapshot": SCAN,
        "scan_after_adoption": f"""WITH {CELL_LOG},
loaded AS (
  SELECT * FROM cell_log
  UNION ALL
  SELECT DISTINCT CAST(user_id AS VARCHAR), 'view', 'adopted', {DELETE_AT}, 1, false
  FROM events WHERE event_type = 'purchase' AND value > 300
),
{_live(source='loaded')}
SELECT user_id, click, error, purchase, signup, view FROM ({_pivot(QUALIFIERS)})""",
        "stored_time_range": TIME_RANGE,
        "stored_as_of": AS_OF,
        "scan_latest_subset": f"WITH {CELL_LOG},{_live()}\n{_pivot(['click'])}",
        "scan_time_range": TIME_RANGE,
        "scan_as_of": AS_OF,
        "scan_versions": _versions("true"),
        "scan_versions_range": _versions(
            f"{IN_RANGE} AND q IN ('click', 'purchase')"
        ),
        "get_rows": f"""WITH {CELL_LOG},{_live()},{KEYS},
got AS ({_pivot(QUALIFIERS)})
SELECT coalesce(g.user_id, '') AS user_id, {blank_columns}
FROM keys LEFT JOIN got g ON g.user_id = keys.row_key""",
        "paced_get": f"""WITH {KEYS}
SELECT CASE WHEN missing THEN '' ELSE row_key END AS user_id,
       CASE WHEN missing THEN '' ELSE 'user ' || row_key END AS name
FROM (SELECT row_key, row_key LIKE 'missing%' AS missing FROM keys)""",
        "scan_to_parquet": SCAN,
        "delete_rows": f"""WITH {CELL_LOG},{_live()}
SELECT * FROM ({_pivot(QUALIFIERS)}) WHERE user_id NOT IN ({_buyers(200)})""",
        "delete_then_put": f"""WITH {CELL_LOG},
renewed AS (
  SELECT * FROM cell_log
  UNION ALL
  SELECT DISTINCT CAST(user_id AS VARCHAR), NULL, NULL, {DELETE_AT}, 0, true
  FROM events WHERE event_type = 'purchase' AND value > 200
  UNION ALL
  SELECT DISTINCT CAST(user_id AS VARCHAR), 'click', 'again', {DELETE_AT + 1}, 1, false
  FROM events WHERE event_type = 'purchase' AND value > 300
),
{_live(source='renewed')}
{_pivot(QUALIFIERS)}""",
        "region_assign": f"""{with_invoices}
SELECT "Invoice", {_region('"Invoice"', 'reference')} AS region FROM invoices""",
        "region_assign_strict": f"""{with_invoices}
SELECT "Invoice", {_region('"Invoice"', 'strict')} AS region FROM invoices""",
        "bulk_cells": f"""WITH {BULK_CELLS}
SELECT row_key, qualifier, value, region FROM placed""",
        "bulk_region_layout": f"""WITH {BULK_CELLS}
SELECT region, count(*) AS cells, min(row_key) AS min_key, max(row_key) AS max_key,
       true AS in_order, false AS overlapping
FROM placed GROUP BY region""",
        "bulk_then_scan": f"""WITH {SPARSE}
SELECT "Invoice", coalesce(orders, '') AS orders FROM sparse""",
        "batch_plan": f"""{with_invoices},
placed AS (SELECT {_region('"Invoice"', 'strict')} AS region FROM invoices)
SELECT region, count(*) AS records,
       CAST((count(*) + {BATCH - 1}) // {BATCH} AS BIGINT) AS batches,
       CAST(count(*) // {BATCH} AS BIGINT) AS pauses
FROM placed GROUP BY region""",
    }
