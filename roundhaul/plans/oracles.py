"""The same results in SQL, written against the given tables for an independent engine.

Domain labels (segments, categories, payment methods, states, colours) and names of columns are fixed values.
"""

from __future__ import annotations

from itertools import combinations

COUNTED = ("customer", "part", "orders", "lineitem", "events")

ALL_COUNTS = " UNION ALL ".join(f"SELECT '{t}' AS name, count(*) AS row_count FROM {t}" for t in COUNTED)

CHANGED_ORDERS = """
changed_orders AS (
  SELECT o_orderkey, o_custkey, o_orderstatus,
         CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'
              THEN o_totalprice + 0.25 ELSE o_totalprice END AS o_totalprice,
         o_orderdate, o_orderpriority
  FROM orders WHERE NOT (o_orderstatus = 'P' AND o_orderpriority = '5-LOW')
  UNION ALL
  SELECT -1 - o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
  FROM orders WHERE o_orderstatus = 'O' AND o_orderpriority = '2-HIGH'
)
"""

CONFORMED_LINEITEM = """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
       CAST(l_quantity AS DECIMAL(10,2)) AS l_quantity,
       CAST(l_extendedprice AS DECIMAL(19,4)) AS l_extendedprice,
       CAST(l_discount AS DECIMAL(5,4)) AS l_discount,
       CAST(l_tax AS DECIMAL(5,4)) AS l_tax,
       l_returnflag, l_linestatus, CAST(l_shipdate AS DATE) AS l_shipdate
FROM lineitem
"""

CONFORMED_ORDERS = """
SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(19,4)) AS o_totalprice,
       o_orderdate, o_orderpriority
FROM orders
"""

COLUMNS = {
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
    "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
    "lineitem": [
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus", "l_shipdate",
    ],
    "events": ["event_id", "ts", "user_id", "event_type", "value", "props"],
    "documents": ["doc_id", "lang", "source", "n_chars"],
}


def _unique(table: str, columns: tuple[str, ...]) -> str:
    held = " AND ".join(f"count({c}) = count(*)" for c in columns)
    grouped = f"NOT EXISTS (SELECT 1 FROM {table} GROUP BY {', '.join(columns)} HAVING count(*) > 1)"
    return f"((SELECT count(*) > 0 AND {held} FROM {table}) AND {grouped})"


def _keys() -> str:
    """Every single column that is unique, and every pair that is, of columns that aren't."""
    found = []
    for table, columns in COLUMNS.items():
        for c in columns:
            found.append(f"SELECT '{table}' AS table_name, '{c}' AS key_columns WHERE {_unique(table, (c,))}")
        for a, b in combinations(columns, 2):
            alone = f"NOT {_unique(table, (a,))} AND NOT {_unique(table, (b,))}"
            found.append(f"SELECT '{table}', '{a},{b}' WHERE {alone} AND {_unique(table, (a, b))}")
    return " UNION ALL ".join(found)


def _references() -> str:
    """Whole-number columns whose values all occur in a key."""
    keys = {"customer": "c_custkey", "part": "p_partkey", "orders": "o_orderkey", "events": "event_id", "documents": "doc_id"}
    whole = {
        "customer": ["c_custkey", "c_nationkey"], "part": ["p_partkey", "p_size"], "orders": ["o_orderkey", "o_custkey"],
        "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"], "events": ["event_id", "user_id"],
        "documents": ["doc_id"], "labels": ["doc_id"],
    }
    found = [
        f"SELECT '{t}' AS child, '{c}' AS child_column, '{p}' AS parent, '{k}' AS parent_column "
        f"WHERE (SELECT count({c}) > 0 FROM {t}) "
        f"AND NOT EXISTS (SELECT 1 FROM {t} WHERE {c} IS NOT NULL AND {c} NOT IN (SELECT {k} FROM {p} WHERE {k} IS NOT NULL))"
        for t, columns in whole.items()
        for c in columns
        for p, k in keys.items()
        if (t, c) != (p, k)
    ]
    return " UNION ALL ".join(found)


# Both loads of the documents: as they were, and after three sources were delivered again.
TWO_LOADS = """
before_ AS (SELECT doc_id, text, lang, source, n_chars FROM documents),
after_ AS (
  SELECT doc_id, CASE WHEN source = 'src5' AND n_chars % 2 = 1 THEN text || ' (revised)' ELSE text END AS text, lang, source,
         CASE WHEN source = 'src5' AND n_chars % 2 = 1 THEN n_chars + 10 ELSE n_chars END AS n_chars
  FROM documents WHERE (source = 'src3' AND n_chars % 2 = 1) IS NOT TRUE
  UNION ALL
  SELECT -1 - doc_id, text, lang, source, n_chars FROM documents WHERE source = 'src7' AND n_chars % 2 = 1
)
"""

CONFORMED_CUSTOMER = """
SELECT c_custkey, c_name, c_nationkey, CAST(c_acctbal AS DECIMAL(19,4)) AS c_acctbal, c_mktsegment
FROM customer
"""

CUSTOMER_TYPES = {
    "c_custkey": "bigint",
    "c_name": "string",
    "c_nationkey": "int",
    "c_acctbal": "decimal(19,4)",
    "c_mktsegment": "string",
}

TABLE_WIDTHS = {
    "region": 2,
    "nation": 3,
    "customer": 5,
    "supplier": 4,
    "part": 6,
    "orders": 6,
    "lineitem": 11,
    "events": 6,
    "documents": 5,
    "embeddings": 3,
    "pages": 3,
    "benchmark": 2,
    "labels": 3,
    "conversations": 4,
}

TEXT_PRICE = """CASE WHEN o_orderstatus = 'P' THEN o_orderpriority
       ELSE CAST(o_totalprice AS VARCHAR) END"""

ORACLES: dict[str, str] = {
    "load_statistics": """
        SELECT count(*) AS total_rows, count(DISTINCT o_custkey) AS unique_customers,
               min(o_orderdate) AS min_date, max(o_orderdate) AS max_date
        FROM orders""",
    "row_count": "SELECT count(*) AS row_count FROM lineitem",
    "labelled_counts": ALL_COUNTS,
    "total_rows": f"""
        SELECT 'Total Rows' AS metric, CAST(sum(row_count) AS BIGINT) AS value FROM ({ALL_COUNTS})""",
    "total_rows_scalar": "SELECT "
    + " + ".join(f"(SELECT count(*) FROM {t})" for t in COUNTED)
    + " AS total_rows",
    "inventory_join": """
        SELECT r_name, n_name, c_mktsegment, count(*) AS order_count
        FROM orders JOIN customer ON o_custkey = c_custkey
             JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
        GROUP BY r_name, n_name, c_mktsegment""",
    "table_inventory": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, 'sales' AS namespace, count(*) AS row_count, "
        f"CAST({width} AS INTEGER) AS column_count FROM {t}"
        for t, width in TABLE_WIDTHS.items()
    ),
    "param_filter": "SELECT * FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'",
    "in_list_filter": """
        SELECT l_orderkey, l_linenumber, l_returnflag, l_shipdate
        FROM lineitem WHERE l_returnflag IN ('A', 'R')""",
    "latest_loads": "SELECT * FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 10",
    "profile_columns": f"WITH c AS ({CONFORMED_CUSTOMER}) "
    + " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, '{kind}' AS column_type, CAST({position} AS INTEGER) AS position, "
        f"CAST({int(name not in ('c_custkey', 'c_name'))} AS INTEGER) AS nullable, "
        f"count(*) - count({name}) AS null_count, count(DISTINCT {name}) AS distinct_count, "
        f"CAST(min({name}) AS VARCHAR) AS min_value, CAST(max({name}) AS VARCHAR) AS max_value FROM c"
        for position, (name, kind) in enumerate(CUSTOMER_TYPES.items(), start=1)
    ),
    "conform_types": CONFORMED_LINEITEM,
    "exact_decimal": f"""
        SELECT o_orderkey, TRY_CAST({TEXT_PRICE} AS DECIMAL(19,4)) AS exact_price,
               CAST(TRY_CAST({TEXT_PRICE} AS DECIMAL(19,4)) AS DOUBLE) AS double_price
        FROM orders""",
    "rejected_values": f"""
        SELECT 'o_orderkey' AS column_name, CAST(0 AS BIGINT) AS rejected
        UNION ALL
        SELECT 'o_totalprice', count(*) FILTER (WHERE TRY_CAST({TEXT_PRICE} AS DECIMAL(19,4)) IS NULL)
        FROM orders""",
    "lossy_values": """
        SELECT 'l_partkey' AS column_name, CAST(0 AS BIGINT) AS changed,
               count(*) FILTER (WHERE l_partkey NOT BETWEEN 0 AND 255) AS out_of_range FROM lineitem
        UNION ALL SELECT 'l_linenumber', 0, count(*) FILTER (WHERE abs(l_linenumber) > 32767) FROM lineitem
        UNION ALL SELECT 'l_quantity', count(*) FILTER (WHERE l_quantity <> trunc(l_quantity)), 0 FROM lineitem
        UNION ALL
        SELECT 'l_extendedprice',
               count(*) FILTER (WHERE abs(round(l_extendedprice, 1) - l_extendedprice) > 1e-12 * l_extendedprice), 0
        FROM lineitem
        UNION ALL
        SELECT 'l_discount', count(*) FILTER (WHERE abs(round(l_discount, 1) - l_discount) > 1e-12 * l_discount), 0
        FROM lineitem""",
    "bool_flag": """
        SELECT o_orderkey,
               CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS is_final,
               CAST(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS INTEGER) AS final_bit
        FROM orders""",
    "nan_to_null": """
        SELECT event_id, CASE WHEN isnan(v) THEN NULL ELSE v END AS value
        FROM (SELECT event_id, CASE WHEN event_type = 'error' THEN CAST('NaN' AS DOUBLE) ELSE value END AS v
              FROM events)""",
    "timestamp_ms_text": """
        SELECT event_id, strftime(date_trunc('millisecond', ts), '%Y-%m-%d %H:%M:%S.%g') AS ts_text
        FROM events""",
    "export_form": """
        SELECT event_id, strftime(date_trunc('millisecond', ts), '%Y-%m-%d %H:%M:%S.%g') AS ts,
               CASE WHEN event_type = 'error' THEN NULL ELSE value END AS value,
               CAST(event_type = 'purchase' AS INTEGER) AS is_purchase,
               hex(encode(props)) AS props_bytes
        FROM events""",
    "order_pricing": """
        WITH priced AS (
          SELECT l_orderkey, l_linenumber, l_tax,
                 CAST(CAST(CAST(l_quantity AS DECIMAL(10,0)) * CAST(l_extendedprice AS DECIMAL(19,4))
                           AS DECIMAL(29,4))
                      * (CAST(1 AS DECIMAL(5,4)) - CAST(l_discount AS DECIMAL(5,4))) AS DECIMAL(19,4)) AS subtotal
          FROM lineitem
        ), taxed AS (
          SELECT *, CAST(subtotal * CAST(l_tax AS DECIMAL(5,4)) AS DECIMAL(19,4)) AS tax_amount FROM priced
        )
        SELECT l_orderkey, l_linenumber, subtotal, tax_amount,
               CAST(subtotal + tax_amount AS DECIMAL(19,4)) AS total_amount
        FROM taxed""",
    "case_bucket": """
        SELECT p_partkey,
               CASE p_partkey % 4 WHEN 0 THEN 'Premium' WHEN 1 THEN 'Standard' WHEN 2 THEN 'Basic'
                    ELSE 'Enterprise' END AS segment,
               CASE p_partkey % 5 WHEN 0 THEN 'Electronics' WHEN 1 THEN 'Clothing' WHEN 2 THEN 'Home'
                    WHEN 3 THEN 'Sports' ELSE 'Books' END AS category,
               CASE p_partkey % 4 WHEN 0 THEN 'Credit Card' WHEN 1 THEN 'Debit Card' WHEN 2 THEN 'PayPal'
                    ELSE 'Wire Transfer' END AS payment_method,
               CASE p_partkey % 5 WHEN 0 THEN 'COMPLETED' WHEN 1 THEN 'SHIPPED' WHEN 2 THEN 'PROCESSING'
                    WHEN 3 THEN 'PENDING' ELSE 'CANCELLED' END AS order_status,
               CASE WHEN p_partkey % 3 = 0 THEN 'Color: ' || CASE p_partkey % 5 WHEN 0 THEN 'Red'
                    WHEN 1 THEN 'Blue' WHEN 2 THEN 'Green' WHEN 3 THEN 'Black' ELSE 'White' END
               END AS product_variant,
               CAST(CASE p_partkey % 10 WHEN 0 THEN 12 WHEN 1 THEN 24 END AS INTEGER) AS warranty_months,
               CAST(300 + p_partkey % 500 AS DOUBLE) AS credit_score
        FROM part""",
    "padded_code": """
        SELECT c_custkey, 'CUST' || right('00000' || c_custkey, 5) AS customer_code,
               '555-' || right('0000' || c_custkey, 4) AS phone
        FROM customer""",
    "concat_null_safe": """
        SELECT c_custkey,
               concat(c_name, '/', nullif(c_mktsegment, 'BUILDING'), '/', c_nationkey) AS label
        FROM customer""",
    "date_shift": """
        SELECT o_orderkey,
               CAST(DATE '2024-06-01' - CAST(o_orderkey % 30 AS INTEGER) AS DATE) AS snapshot_date,
               o_orderdate - to_minutes(o_custkey % 1440) AS placed_at,
               CAST(o_orderdate AS DATE) AS order_day
        FROM orders""",
    "stock_position": """
        WITH stock AS (
          SELECT p_partkey, 20 + p_partkey % 30 AS reorder_point,
                 100 + p_partkey % 500 - CASE WHEN p_size > 25 THEN p_size * 4 ELSE 0 END AS available
          FROM part
        )
        SELECT p_partkey, available, available < reorder_point AS below_reorder FROM stock""",
    "sparse_defaults": """
        SELECT c_custkey, CASE WHEN c_acctbal > 9000 THEN 'large balance' END AS notes,
               CASE WHEN c_mktsegment = 'MACHINERY' THEN 'UNASSIGNED' ELSE c_mktsegment END AS segment,
               c_acctbal < 0 AS in_debt
        FROM customer""",
    "write_read_roundtrip": CONFORMED_LINEITEM,
    "scan_multi_file": "SELECT * FROM part",
    "partition_identity": """
        SELECT p_partkey, p_name, p_brand, p_type, p_size,
               CAST(p_retailprice AS DECIMAL(19,4)) AS p_retailprice
        FROM part""",
    "partition_day": "SELECT * FROM events",
    "day_range_scan": """
        SELECT * FROM events
        WHERE ts >= TIMESTAMP '2024-01-10 06:00:00' AND ts < TIMESTAMP '2024-01-13 18:00:00'""",
    "layout_change": """
        SELECT * FROM events
        WHERE ts >= TIMESTAMP '2024-01-10 06:00:00' AND ts < TIMESTAMP '2024-01-13 18:00:00'""",
    "date_range_scan": f"""
        SELECT * FROM ({CONFORMED_LINEITEM})
        WHERE l_shipdate >= TIMESTAMP '1995-01-10 06:00:00' AND l_shipdate < TIMESTAMP '1995-03-13 18:00:00'""",
    "read_as_of": CONFORMED_ORDERS,
    "replaced_load": f"{CONFORMED_ORDERS} WHERE o_orderstatus = 'F'",
    "partial_reload": f"WITH {TWO_LOADS} SELECT * FROM after_ WHERE source <> 'src3' OR source IS NULL",
    "change_feed": f"""
        WITH {TWO_LOADS}
        SELECT CASE WHEN a.doc_id IS NULL THEN 'delete' ELSE 'update_before' END AS change_type, b.*
        FROM before_ b LEFT JOIN after_ a USING (doc_id)
        WHERE a.doc_id IS NULL OR a.text IS DISTINCT FROM b.text OR a.n_chars IS DISTINCT FROM b.n_chars
        UNION ALL
        SELECT CASE WHEN b.doc_id IS NULL THEN 'insert' ELSE 'update_after' END, a.*
        FROM after_ a LEFT JOIN before_ b USING (doc_id)
        WHERE b.doc_id IS NULL OR a.text IS DISTINCT FROM b.text OR a.n_chars IS DISTINCT FROM b.n_chars""",
    "feed_applied": f"WITH {TWO_LOADS} SELECT * FROM after_",
    "load_difference": f"""
        WITH {TWO_LOADS}, found AS (
          SELECT *, 'source' AS only_in FROM (SELECT * FROM before_ EXCEPT ALL SELECT * FROM after_)
          UNION ALL
          SELECT *, 'target' AS only_in FROM (SELECT * FROM after_ EXCEPT ALL SELECT * FROM before_)
        )
        SELECT *, count(*) AS copies FROM found GROUP BY ALL""",
    "validity_history": f"""
        WITH {TWO_LOADS}
        SELECT b.*, CAST(1 AS BIGINT) AS valid_from,
               CASE WHEN a.doc_id IS NULL OR a.text IS DISTINCT FROM b.text OR a.n_chars IS DISTINCT FROM b.n_chars THEN CAST(2 AS BIGINT) END
                 AS valid_to, CAST(1 AS BIGINT) AS copies
        FROM before_ b LEFT JOIN after_ a USING (doc_id)
        UNION ALL
        SELECT a.*, 2, CASE WHEN a.source = 'src5' THEN 3 END, 1
        FROM after_ a LEFT JOIN before_ b USING (doc_id)
        WHERE b.doc_id IS NULL OR a.text IS DISTINCT FROM b.text OR a.n_chars IS DISTINCT FROM b.n_chars
        UNION ALL
        SELECT *, 3, NULL, 1 FROM before_ WHERE source = 'src5' AND n_chars % 2 = 1""",
    "compacted": "SELECT source, count(*) AS row_count, 1 AS files FROM documents GROUP BY source",
    "clustered_range": "SELECT * FROM documents WHERE doc_id BETWEEN 100 AND 600 AND n_chars BETWEEN 300 AND 900",
    "restore_resumed": "SELECT doc_id, text, lang, source, n_chars, 'failed success' AS statuses FROM documents",
    "time_of_day": """
        SELECT event_id, CAST(CAST(ts AS TIME) AS VARCHAR) AS at FROM events
        WHERE CAST(ts AS TIME) >= TIME '12:00:00' AND CAST(ts AS TIME) < TIME '18:30:00.5'""",
    "profile_range": " UNION ALL ".join(
        f"""
        SELECT '{name}' AS column_name, '{kind}' AS column_type, {place} AS position, {int(name != "doc_id")} AS nullable,
               count(*) AS row_count, count(*) - count({name}) AS null_count, CAST(min({bound}) AS VARCHAR) AS min_value,
               CAST(max({bound}) AS VARCHAR) AS max_value, count(DISTINCT {name}) AS distinct_count, true AS distinct_close,
               {"true" if kind == "bigint" else "CAST(NULL AS BOOLEAN)"} AS quartiles_close
        FROM documents WHERE source < 'src2'"""
        for place, (name, kind, bound) in enumerate(
            [
                ("doc_id", "bigint", "doc_id"),
                ("text", "string", "substring(text, 1, 256)"),
                ("lang", "string", "lang"),
                ("source", "string", "source"),
                ("n_chars", "bigint", "n_chars"),
            ],
            start=1,
        )
    ),
    "discovered_keys": _keys(),
    "discovered_references": _references(),
    "row_count_match": f"""
        WITH {CHANGED_ORDERS}, n AS (
          SELECT (SELECT count(*) FROM orders) AS source_rows,
                 (SELECT count(*) FROM changed_orders) AS target_rows
        )
        SELECT *, CASE WHEN source_rows = target_rows THEN 'PASSED' ELSE 'FAILED' END AS status FROM n""",
    "statistics_match": f"""
        WITH {CHANGED_ORDERS}, sides AS (
          SELECT 's' AS side, o_custkey, o_orderdate FROM orders
          UNION ALL SELECT 't', o_custkey, o_orderdate FROM changed_orders
        ), figures AS (
          SELECT side, count(*) AS n, count(DISTINCT o_custkey) AS k, min(o_orderdate) AS lo,
                 max(o_orderdate) AS hi
          FROM sides GROUP BY side
        ), lines AS (
          SELECT side, 'total_rows' AS statistic, CAST(n AS VARCHAR) AS v FROM figures
          UNION ALL SELECT side, 'unique_entities', CAST(k AS VARCHAR) FROM figures
          UNION ALL SELECT side, 'min_date', CAST(lo AS VARCHAR) FROM figures
          UNION ALL SELECT side, 'max_date', CAST(hi AS VARCHAR) FROM figures
        )
        SELECT s.statistic, s.v AS source_value, t.v AS target_value,
               CASE WHEN s.v = t.v THEN 'PASSED' ELSE 'FAILED' END AS status
        FROM lines s JOIN lines t USING (statistic) WHERE s.side = 's' AND t.side = 't'""",
    "float_tolerance": f"""
        WITH {CHANGED_ORDERS}
        SELECT 'o_totalprice' AS column_name, max(abs(s.o_totalprice - t.o_totalprice)) AS max_diff,
               max(abs(s.o_totalprice - t.o_totalprice)) <= 1e-9 AS within_tolerance
        FROM orders s JOIN changed_orders t USING (o_orderkey)""",
    "content_match": f"""
        WITH {CHANGED_ORDERS}, n AS (
          SELECT (SELECT count(*) FROM orders) AS source_rows,
                 (SELECT count(*) FROM changed_orders) AS target_rows,
                 (SELECT count(*) FROM (SELECT * FROM orders EXCEPT ALL SELECT * FROM changed_orders)) AS lost,
                 (SELECT count(*) FROM (SELECT * FROM changed_orders EXCEPT ALL SELECT * FROM orders)) AS made_up
        )
        SELECT source_rows, target_rows,
               CASE WHEN lost = 0 AND made_up = 0 THEN 'PASSED' ELSE 'FAILED' END AS status
        FROM n""",
    "content_diff": f"""
        WITH {CHANGED_ORDERS}, n AS (
          SELECT (SELECT count(*) FROM (SELECT * FROM orders EXCEPT ALL SELECT * FROM changed_orders))
                   AS only_in_source,
                 (SELECT count(*) FROM (SELECT * FROM changed_orders EXCEPT ALL SELECT * FROM orders))
                   AS only_in_target
        )
        SELECT *, CASE WHEN only_in_source = 0 AND only_in_target = 0 THEN 'PASSED' ELSE 'FAILED' END AS status
        FROM n""",
    "differing_rows": f"""
        WITH {CHANGED_ORDERS}, found AS (
          SELECT *, 'source' AS only_in FROM (SELECT * FROM orders EXCEPT ALL SELECT * FROM changed_orders)
          UNION ALL
          SELECT *, 'target' AS only_in FROM (SELECT * FROM changed_orders EXCEPT ALL SELECT * FROM orders)
        )
        SELECT *, count(*) AS copies FROM found GROUP BY ALL""",
    "keyed_diff": f"""
        WITH {CHANGED_ORDERS}
        SELECT coalesce(s.o_orderkey, t.o_orderkey) AS o_orderkey,
               CASE WHEN s.o_orderkey IS NULL THEN 'added' WHEN t.o_orderkey IS NULL THEN 'removed'
                    ELSE 'changed' END AS change
        FROM orders s FULL JOIN changed_orders t ON s.o_orderkey = t.o_orderkey
        WHERE s.o_orderkey IS NULL OR t.o_orderkey IS NULL
           OR s.o_custkey IS DISTINCT FROM t.o_custkey
           OR s.o_orderstatus IS DISTINCT FROM t.o_orderstatus
           OR s.o_totalprice IS DISTINCT FROM t.o_totalprice
           OR s.o_orderdate IS DISTINCT FROM t.o_orderdate
           OR s.o_orderpriority IS DISTINCT FROM t.o_orderpriority""",
    "audit_not_null": """
        SELECT 'l_orderkey' AS column_name, count(*) FILTER (WHERE l_orderkey IS NULL) AS violations FROM lineitem
        UNION ALL
        SELECT 'l_returnflag', count(*) FILTER (WHERE nullif(l_returnflag, 'N') IS NULL) FROM lineitem
        UNION ALL
        SELECT 'l_shipdate', count(*) FILTER (WHERE l_shipdate IS NULL) FROM lineitem""",
    "audit_unique": """
        SELECT l_orderkey, l_linenumber, count(*) AS copies
        FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "audit_foreign_key": """
        SELECT o_custkey, count(*) AS orphans FROM orders
        WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_mktsegment <> 'BUILDING')
        GROUP BY o_custkey""",
    "audit_contracts": f"""
        WITH named AS (
          SELECT c_custkey, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_name END AS c_name FROM customer
        ), held AS (SELECT * FROM part WHERE p_size > 1),
        placed AS (SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_orderstatus = 'P'),
        known AS (SELECT DISTINCT o_orderkey FROM orders)
        {" UNION ALL ".join(
            f"SELECT '{name}' AS table_name, 'not null' AS rule, '{column}' AS columns, "
            f"count(*) FILTER (WHERE {column} IS NULL) AS violations FROM {rows}"
            for name, rows, columns in (
                ("customer", "named", ("c_custkey", "c_name")),
                ("part", "held", ("p_partkey", "p_name", "p_brand")),
                ("orders", "placed", ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")),
                ("lineitem", "lineitem", ("l_orderkey", "l_partkey", "l_linenumber")),
                ("events", "events", ("event_id", "ts")),
            )
            for column in columns
        )}
        {"".join(
            f" UNION ALL SELECT '{name}', 'unique', '{key}', "
            f"(SELECT count(*) FROM {rows}) - (SELECT count(*) FROM (SELECT DISTINCT {key} FROM {rows}))"
            for name, rows, key in (
                ("customer", "named", "c_custkey"),
                ("part", "held", "p_partkey"),
                ("orders", "placed", "o_orderkey"),
                ("lineitem", "lineitem", "l_orderkey, l_linenumber"),
                ("events", "events", "event_id"),
            )
        )}
        UNION ALL SELECT 'orders', 'foreign key', 'o_custkey', count(*) FROM placed
          WHERE o_custkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM named WHERE c_custkey = o_custkey)
        UNION ALL SELECT 'lineitem', 'foreign key', 'l_orderkey', count(*) FROM lineitem
          WHERE l_orderkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM known WHERE o_orderkey = l_orderkey)
        UNION ALL SELECT 'lineitem', 'foreign key', 'l_partkey', count(*) FROM lineitem
          WHERE l_partkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM held WHERE p_partkey = l_partkey)""",
    "validation_report": f"""
        WITH {CHANGED_ORDERS}, pairs AS (
          {" UNION ALL ".join(
              f"SELECT '{name}' AS table_name, (SELECT count(*) FROM {name}) AS here, "
              f"(SELECT count(*) FROM {there}) AS there, "
              f"(SELECT count(*) FROM (SELECT * FROM {name} EXCEPT ALL SELECT * FROM {there})) AS lost, "
              f"(SELECT count(*) FROM (SELECT * FROM {there} EXCEPT ALL SELECT * FROM {name})) AS made_up"
              for name, there in ((n, "changed_orders" if n == "orders" else n) for n in COUNTED)
          )}
        ), checks AS (
          SELECT table_name, 'row_count' AS "check", CAST(here AS VARCHAR) AS expected, CAST(there AS VARCHAR) AS actual
          FROM pairs
          UNION ALL SELECT table_name, 'rows_lost', '0', CAST(lost AS VARCHAR) FROM pairs
          UNION ALL SELECT table_name, 'rows_made_up', '0', CAST(made_up AS VARCHAR) FROM pairs
          UNION ALL SELECT 'orders', 'total_rows', CAST(here AS VARCHAR), CAST(there AS VARCHAR) FROM pairs
            WHERE table_name = 'orders'
          UNION ALL SELECT 'orders', 'unique_entities', (SELECT CAST(count(DISTINCT o_custkey) AS VARCHAR) FROM orders),
            (SELECT CAST(count(DISTINCT o_custkey) AS VARCHAR) FROM changed_orders)
          UNION ALL SELECT 'orders', 'min_date', (SELECT CAST(min(o_orderdate) AS VARCHAR) FROM orders),
            (SELECT CAST(min(o_orderdate) AS VARCHAR) FROM changed_orders)
          UNION ALL SELECT 'orders', 'max_date', (SELECT CAST(max(o_orderdate) AS VARCHAR) FROM orders),
            (SELECT CAST(max(o_orderdate) AS VARCHAR) FROM changed_orders)
        )
        SELECT *, CASE WHEN expected IS NOT DISTINCT FROM actual THEN 'PASSED' ELSE 'FAILED' END AS status FROM checks""",
    "restore_subset": f"""
        SELECT name || '_backload' AS table_name, row_count, 'success' AS status, row_count AS rows
        FROM ({ALL_COUNTS}) WHERE name IN ('orders', 'part')""",
    "restore_before_migration": """
        SELECT 'customer' AS table_name, 'refused' AS status, CAST(0 AS BIGINT) AS rows, 'NotMigrated' AS error
        UNION ALL SELECT 'customer', 'success', count(*), NULL FROM customer""",
    "evolve_append": """
        SELECT p_partkey, CAST(p_size AS BIGINT) AS p_size, CAST(p_retailprice AS DECIMAL(19,2)) AS p_retailprice,
               CAST(CAST(p_retailprice / 2 AS FLOAT) AS DOUBLE) AS half_price, p_brand,
               CAST(NULL AS VARCHAR) AS p_type
        FROM part
        UNION ALL
        SELECT p_partkey, CAST(p_size AS BIGINT), CAST(p_retailprice AS DECIMAL(19,2)), p_retailprice / 2,
               NULL, p_type
        FROM part""",
    "migrate_report": f"""
        SELECT name AS table_name, 'success' AS status, row_count AS rows FROM ({ALL_COUNTS})
        UNION ALL SELECT 'supplier', 'failed', 0""",
    "restore_report": f"""
        SELECT name AS table_name, 'success' AS status, row_count AS rows, 'PASSED' AS validation
        FROM ({ALL_COUNTS})
        UNION ALL SELECT 'never_migrated', 'no_data', 0, NULL""",
    "restore_roundtrip": """
        SELECT event_id, ts, user_id, event_type,
               CASE WHEN event_type = 'error' THEN NULL ELSE value END AS value,
               hex(encode(props)) AS props
        FROM events""",
    "full_cycle": f"""
        SELECT name AS table_name, row_count AS source_rows, row_count AS migrated_rows,
               row_count AS restored_rows, 'PASSED' AS status
        FROM ({ALL_COUNTS})""",
}
