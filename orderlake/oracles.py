"""DuckDB oracle texts, one per query key (FIXTURES.md §2 and §5).

The CTEs rebuild the test feed and its dimensions from the driver's tables;
each oracle aliases its columns to the names the Spark query returns.
"""

from __future__ import annotations

D = "strptime({x}, '%d/%m/%Y %H:%M:%S')"

FEED = """feed AS (
  SELECT CAST(event_id % 30 AS INT) AS object_id,
         CAST((event_id * 91) % 1000 AS DOUBLE) / 100 AS latitude,
         CAST((event_id * 37) % 1000 AS DOUBLE) / 100 AS longitude,
         strftime(ts, '%d/%m/%Y %H:%M:%S') AS date,
         CAST(CASE WHEN user_id % 10 = 9 THEN -user_id ELSE user_id END AS INT) AS customer_id,
         CAST(event_id % 120 AS INT) AS employee_id,
         CAST(floor(value) AS INT) AS quantity_products,
         concat('evt-', lpad(CAST(event_id AS VARCHAR), 8, '0')) AS order_id
  FROM events)"""

CUSTOMERS = """customers AS (
  SELECT CAST(c_custkey AS INT) AS customer_id, c_name AS name, c_mktsegment AS phone,
         concat(c_name, '@x') AS email, c_mktsegment AS address
  FROM customer)"""

EMPLOYEES = """employees AS (
  SELECT CAST(s_suppkey AS INT) AS employee_id, s_name AS name, s_name AS phone,
         concat(s_name, '@x') AS email, s_name AS address, s_acctbal AS comission
  FROM supplier)"""

NEIGHBORHOODS = """neighborhoods AS (
  SELECT n_nationkey AS OBJECTID, n_name AS NOMBRE, r_name AS IDENTIFICACION
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""

SILVER = """silver AS (
  SELECT f.latitude, f.longitude, f.customer_id, f.employee_id, f.quantity_products, f.order_id,
         strptime(f.date, '%d/%m/%Y %H:%M:%S') AS event_date,
         strftime(strptime(f.date, '%d/%m/%Y %H:%M:%S'), '%d%m%Y') AS partition_date,
         CAST(day(strptime(f.date, '%d/%m/%Y %H:%M:%S')) AS INT) AS event_day,
         CAST(hour(strptime(f.date, '%d/%m/%Y %H:%M:%S')) AS INT) AS event_hour,
         CAST(minute(strptime(f.date, '%d/%m/%Y %H:%M:%S')) AS INT) AS event_minute,
         CAST(month(strptime(f.date, '%d/%m/%Y %H:%M:%S')) AS INT) AS event_month,
         CAST(second(strptime(f.date, '%d/%m/%Y %H:%M:%S')) AS INT) AS event_second,
         CAST(year(strptime(f.date, '%d/%m/%Y %H:%M:%S')) AS INT) AS event_year,
         n.NOMBRE AS neighborhood, n.IDENTIFICACION AS commune
  FROM feed f LEFT JOIN neighborhoods n ON f.object_id = n.OBJECTID)"""

GOLD = """gold AS (
  SELECT f.order_id, c.name AS customer_name, e.name AS employee_name,
         e.comission AS employee_commission, f.latitude, f.longitude,
         n.IDENTIFICACION AS commune, n.NOMBRE AS neighborhood, f.quantity_products,
         strptime(f.date, '%d/%m/%Y %H:%M:%S') AS event_date
  FROM feed f
  LEFT JOIN neighborhoods n ON f.object_id = n.OBJECTID
  LEFT JOIN customers c ON f.customer_id = c.customer_id
  LEFT JOIN employees e ON f.employee_id = e.employee_id)"""

# Edge table of the fixed test polygons (FIXTURES.md §3), closed rings, DOUBLE.
_RINGS = {
    1: [[(0, 0), (4, 0), (4, 2), (2, 2), (2, 4), (0, 4)]],
    2: [[(5, 5), (9, 5), (9, 9), (5, 9)], [(6, 6), (8, 6), (8, 8), (6, 8)]],
    3: [[(1, 0), (3, 0), (3, 2), (1, 2)]],
    0: [[(0, 0), (10, 0), (10, 9), (0, 9)]],
}


def _edge_rows(ids) -> str:
    rows = []
    for pid in ids:
        for ring in _RINGS[pid]:
            for i, (x1, y1) in enumerate(ring):
                x2, y2 = ring[(i + 1) % len(ring)]
                rows.append(f"({pid}, {x1}.0, {y1}.0, {x2}.0, {y2}.0)")
    return ", ".join(rows)


def edges_cte(ids, name: str = "edges") -> str:
    return (f"{name} AS (SELECT CAST(pid AS INT) AS pid, CAST(x1 AS DOUBLE) AS x1, CAST(y1 AS DOUBLE) AS y1, "
            f"CAST(x2 AS DOUBLE) AS x2, CAST(y2 AS DOUBLE) AS y2 FROM (VALUES {_edge_rows(ids)}) "
            f"AS t(pid, x1, y1, x2, y2))")


def contains_cte(edges: str = "edges", name: str = "hits") -> str:
    """Parity SQL: (point, polygon) pairs with an odd crossing count and no edge
    through the point. Edges are matched to points by their y-range (a range
    join, not a cross product)."""
    return f"""{name} AS (
  SELECT p.order_id, e.pid
  FROM feed p JOIN {edges} e
    ON p.latitude >= least(e.y1, e.y2) AND p.latitude <= greatest(e.y1, e.y2)
  GROUP BY p.order_id, e.pid
  HAVING sum(CASE WHEN (e.y1 > p.latitude) <> (e.y2 > p.latitude)
                   AND p.longitude < (e.x2 - e.x1) * (p.latitude - e.y1)
                       / (CASE WHEN e.y1 = e.y2 THEN 1 ELSE e.y2 - e.y1 END) + e.x1
                  THEN 1 ELSE 0 END) % 2 = 1
     AND NOT bool_or((e.x2 - e.x1) * (p.latitude - e.y1) = (e.y2 - e.y1) * (p.longitude - e.x1)
                     AND p.longitude BETWEEN least(e.x1, e.x2) AND greatest(e.x1, e.x2)))"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


FEED_COLS = ("object_id, latitude, longitude, date, customer_id, employee_id, "
             "quantity_products, order_id")

# The count gate over batches of three days, in order: a batch flushes once more than 600 rows are held.
GATE = """,
sizes AS (SELECT CAST(substring(date, 1, 2) AS INT) // 3 AS part, count(*) AS n FROM feed GROUP BY 1),
ordered AS (SELECT part, n, row_number() OVER (ORDER BY part) AS rn FROM sizes),
fold(rn, part, n, s, f, flushed) AS (
  SELECT rn, part, n, CAST(0 AS BIGINT), CAST(0 AS BIGINT), n > 600 FROM ordered WHERE rn = 1
  UNION ALL
  SELECT o.rn, o.part, o.n, CASE WHEN p.flushed THEN 0 ELSE p.s + p.n END, p.f + CASE WHEN p.flushed THEN 1 ELSE 0 END,
         (CASE WHEN p.flushed THEN 0 ELSE p.s + p.n END) + o.n > 600
  FROM fold p JOIN ordered o ON o.rn = p.rn + 1),
gate AS (SELECT rn, part, n, flushed,
    CAST(CASE WHEN f < (SELECT max(f + CASE WHEN flushed THEN 1 ELSE 0 END) FROM fold) THEN f + 1 END AS BIGINT) AS flush_id
  FROM fold)
"""

ORACLES: dict[str, str] = {
    "scan_parquet": "SELECT * FROM customer",
    "scan_landing_glob": with_(FEED) + "SELECT * FROM feed",
    "scan_json": with_(FEED) + "SELECT * FROM feed",
    "scan_table": with_(NEIGHBORHOODS) + "SELECT * FROM neighborhoods",
    "empty_frame": with_(FEED) + "SELECT * FROM feed",
    "sink_parquet_overwrite": with_(FEED) + "SELECT * FROM feed",
    "sink_parquet_append": with_(FEED) + "SELECT * FROM feed UNION ALL SELECT * FROM feed",
    "sink_table_append": with_(FEED) + "SELECT * FROM feed UNION ALL SELECT * FROM feed",
    "sink_table_overwrite": with_(FEED) + "SELECT * FROM feed",
    "sink_csv_roundtrip": with_(FEED, CUSTOMERS, EMPLOYEES, NEIGHBORHOODS, GOLD) + "SELECT * FROM gold",
    "publish_dims": ("SELECT 'customer' AS dim, CAST(c_custkey AS BIGINT) AS k, c_name AS name FROM customer UNION ALL "
                     "SELECT 'supplier', s_suppkey, s_name FROM supplier UNION ALL "
                     "SELECT 'nation', n_nationkey, n_name FROM nation"),
    "catalog_init": with_(CUSTOMERS, EMPLOYEES, NEIGHBORHOODS) + (
        "SELECT 'customers' AS table_name, CAST(customer_id AS BIGINT) AS k, name FROM customers UNION ALL "
        "SELECT 'employees', employee_id, name FROM employees UNION ALL "
        "SELECT 'neighborhoods', OBJECTID, NOMBRE FROM neighborhoods UNION ALL "
        "SELECT 'municipality', 0, 'boundary'"),
    "catalog_list": ("SELECT * FROM (VALUES ('customers'), ('employees'), ('municipality'), "
                     "('neighborhoods')) AS t(tableName)"),
    "project_star_plus": with_(FEED, NEIGHBORHOODS) + (
        "SELECT f.*, n.NOMBRE AS neighborhood FROM feed f "
        "LEFT JOIN neighborhoods n ON f.object_id = n.OBJECTID"),
    "project_alias": with_(NEIGHBORHOODS) + (
        "SELECT OBJECTID AS object_id, NOMBRE AS neighborhood, IDENTIFICACION AS commune "
        "FROM neighborhoods"),
    "project_rename": with_(FEED) + (
        "SELECT object_id, latitude, longitude, date, customer_id, employee_id, "
        "quantity_products, order_id AS order_key FROM feed"),
    "project_literal": with_(FEED) + "SELECT *, 'feed' AS source FROM feed",
    "filter_eq_and": with_(FEED) + "SELECT * FROM feed WHERE latitude = 0.91 AND longitude = 0.37",
    "sql_project_limit": with_(NEIGHBORHOODS) + (
        "SELECT OBJECTID, NOMBRE FROM neighborhoods ORDER BY OBJECTID LIMIT 5"),
    "silver_time_parts": with_(FEED) + """
SELECT object_id, latitude, longitude, customer_id, employee_id, quantity_products, order_id,
       strptime(date, '%d/%m/%Y %H:%M:%S') AS event_date,
       strftime(strptime(date, '%d/%m/%Y %H:%M:%S'), '%d%m%Y') AS partition_date,
       CAST(day(strptime(date, '%d/%m/%Y %H:%M:%S')) AS INT) AS event_day,
       CAST(hour(strptime(date, '%d/%m/%Y %H:%M:%S')) AS INT) AS event_hour,
       CAST(minute(strptime(date, '%d/%m/%Y %H:%M:%S')) AS INT) AS event_minute,
       CAST(month(strptime(date, '%d/%m/%Y %H:%M:%S')) AS INT) AS event_month,
       CAST(second(strptime(date, '%d/%m/%Y %H:%M:%S')) AS INT) AS event_second,
       CAST(year(strptime(date, '%d/%m/%Y %H:%M:%S')) AS INT) AS event_year
FROM feed""",
    "silver_neighborhood": with_(FEED, NEIGHBORHOODS) + """
SELECT f.latitude, f.longitude, f.date, f.customer_id, f.employee_id, f.quantity_products,
       f.order_id, n.NOMBRE AS neighborhood, n.IDENTIFICACION AS commune
FROM feed f LEFT JOIN neighborhoods n ON f.object_id = n.OBJECTID""",
    "silver_orders": with_(FEED, NEIGHBORHOODS, SILVER) + "SELECT * FROM silver",
    "silver_spatial": with_(FEED, NEIGHBORHOODS, edges_cte((1, 2, 3)), contains_cte()) + """,
first_hit AS (SELECT order_id, max(pid) AS pid FROM hits GROUP BY order_id)
SELECT f.latitude, f.longitude, f.customer_id, f.employee_id, f.quantity_products, f.order_id,
       strptime(f.date, '%d/%m/%Y %H:%M:%S') AS event_date,
       strftime(strptime(f.date, '%d/%m/%Y %H:%M:%S'), '%d%m%Y') AS partition_date,
       CAST(day(strptime(f.date, '%d/%m/%Y %H:%M:%S')) AS INT) AS event_day,
       CAST(hour(strptime(f.date, '%d/%m/%Y %H:%M:%S')) AS INT) AS event_hour,
       CAST(minute(strptime(f.date, '%d/%m/%Y %H:%M:%S')) AS INT) AS event_minute,
       CAST(month(strptime(f.date, '%d/%m/%Y %H:%M:%S')) AS INT) AS event_month,
       CAST(second(strptime(f.date, '%d/%m/%Y %H:%M:%S')) AS INT) AS event_second,
       CAST(year(strptime(f.date, '%d/%m/%Y %H:%M:%S')) AS INT) AS event_year,
       n.NOMBRE AS neighborhood, n.IDENTIFICACION AS commune
FROM feed f
LEFT JOIN first_hit h ON f.order_id = h.order_id
LEFT JOIN neighborhoods n ON h.pid = n.OBJECTID""",
    "enrich_customer": with_(FEED, CUSTOMERS) + """
SELECT f.*, c.name AS customer_name, c.phone AS customer_phone, c.email AS customer_email,
       c.address AS customer_address
FROM feed f LEFT JOIN customers c ON f.customer_id = c.customer_id""",
    "enrich_employee": with_(FEED, EMPLOYEES) + """
SELECT f.*, e.name AS employee_name, e.phone AS employee_phone, e.email AS employee_email,
       e.address AS employee_address, e.comission AS employee_commission
FROM feed f LEFT JOIN employees e ON f.employee_id = e.employee_id""",
    "gold_detailed_sales": with_(FEED, CUSTOMERS, EMPLOYEES, NEIGHBORHOODS, GOLD) + "SELECT * FROM gold",
    "join_coordinate_exact": with_(FEED, NEIGHBORHOODS) + """,
places AS (
  SELECT latitude, longitude, min(object_id) AS place_id FROM feed GROUP BY latitude, longitude)
SELECT f.order_id, f.latitude, f.longitude, p.place_id, n.NOMBRE AS neighborhood,
       n.IDENTIFICACION AS commune
FROM feed f
LEFT JOIN places p ON f.latitude = p.latitude AND f.longitude = p.longitude
LEFT JOIN neighborhoods n ON p.place_id = n.OBJECTID""",
    "spatial_point_in_polygon": with_(FEED, edges_cte((1, 2)), contains_cte()) + """
SELECT f.order_id, f.longitude, f.latitude, h.pid AS polygon_id
FROM feed f JOIN hits h ON f.order_id = h.order_id""",
    "spatial_assign_left": with_(FEED, edges_cte((1, 2, 3)), contains_cte()) + """,
first_hit AS (SELECT order_id, max(pid) AS polygon_id FROM hits GROUP BY order_id)
SELECT f.order_id, f.longitude, f.latitude, h.polygon_id
FROM feed f LEFT JOIN first_hit h ON f.order_id = h.order_id""",
    "spatial_semi": with_(FEED, edges_cte((0,), "bedges"), contains_cte("bedges", "in_boundary"),
                          edges_cte((1, 2, 3)), contains_cte()) + """
SELECT * FROM feed
WHERE order_id IN (SELECT order_id FROM in_boundary)
  AND order_id IN (SELECT order_id FROM hits)""",
    "spatial_bounds": with_(FEED) + """
SELECT order_id AS polygon_id, longitude AS min_x, latitude AS min_y, longitude + 0.5::DOUBLE AS max_x,
       latitude + 0.25::DOUBLE AS max_y
FROM feed""",
    "project_drop_ref": with_(FEED, NEIGHBORHOODS) + """
SELECT f.*, n.NOMBRE, n.IDENTIFICACION FROM feed f JOIN neighborhoods n ON f.object_id = n.OBJECTID""",
    "gold_incremental": with_(FEED, CUSTOMERS, EMPLOYEES, NEIGHBORHOODS, GOLD) + "SELECT * FROM gold",
    "ingest_with_quarantine": with_(FEED) + f"""
SELECT {FEED_COLS}, CAST(NULL AS VARCHAR) AS value, 'order' AS status FROM feed
UNION ALL SELECT 1, 1.5, 2.5, '01/01/2024 00:00:00', 1, 2, 3, 'single', NULL, 'order'
UNION ALL SELECT NULL, 1.0, 2.0, '02/01/2024 10:00:00', NULL, NULL, 4, 'badtypes', NULL, 'order'
UNION ALL SELECT 2, NULL, NULL, NULL, NULL, NULL, NULL, 'missing', NULL, 'order'
UNION ALL SELECT 3, NULL, NULL, NULL, NULL, NULL, NULL, 'first', NULL, 'order'
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, value, 'reject'
FROM (VALUES ('not json at all'), ('')) AS t(value)""",
    "ingest_gated": with_(FEED).replace("WITH", "WITH RECURSIVE", 1) + GATE + f"""
SELECT {FEED_COLS} FROM feed f JOIN gate g ON CAST(substring(date, 1, 2) AS INT) // 3 = g.part
WHERE g.flush_id IS NOT NULL""",
    "agg_count": with_(FEED) + "SELECT count(*) AS n FROM feed",
    "agg_qty_by_neighborhood": with_(FEED, CUSTOMERS, EMPLOYEES, NEIGHBORHOODS, GOLD) + """
SELECT neighborhood, CAST(coalesce(sum(quantity_products), 0) AS BIGINT) AS quantity_products
FROM gold WHERE neighborhood IS NOT NULL GROUP BY neighborhood""",
    "agg_qty_by_event_time": with_(FEED, CUSTOMERS, EMPLOYEES, NEIGHBORHOODS, GOLD) + """
SELECT strftime(event_date, '%Y-%m-%d %H:%M:%S') AS event_date,
       CAST(coalesce(sum(quantity_products), 0) AS BIGINT) AS quantity_products
FROM gold GROUP BY event_date""",
    "sort_desc": with_(FEED) + "SELECT * FROM feed ORDER BY order_id DESC NULLS LAST",
    "topk_latest": with_(FEED) + "SELECT * FROM feed ORDER BY order_id DESC NULLS LAST LIMIT 20",
    "union_all": with_(FEED) + "SELECT * FROM feed UNION ALL SELECT * FROM feed",
    "union_schema_versions": with_(FEED) + f"""
SELECT {FEED_COLS} FROM feed
UNION ALL
SELECT CAST(NULL AS INT) AS object_id, latitude, longitude, date, customer_id, employee_id,
       quantity_products, order_id FROM feed""",
    "time_epoch_roundtrip": with_(FEED) + """
SELECT order_id,
       CAST(epoch(strptime(date, '%d/%m/%Y %H:%M:%S')) AS BIGINT) AS event_epoch,
       strftime(strptime(date, '%d/%m/%Y %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS event_time_text,
       strftime(strptime(date, '%d/%m/%Y %H:%M:%S'), '%Y%m%d') AS event_day_text
FROM feed""",
    "time_parts_by_substring": with_(FEED) + """
SELECT order_id,
       CAST(substring(CAST(strptime(date, '%d/%m/%Y %H:%M:%S') AS VARCHAR), 1, 4) AS INT) AS event_year,
       CAST(substring(CAST(strptime(date, '%d/%m/%Y %H:%M:%S') AS VARCHAR), 6, 2) AS INT) AS event_month,
       CAST(substring(CAST(strptime(date, '%d/%m/%Y %H:%M:%S') AS VARCHAR), 9, 2) AS INT) AS event_day,
       CAST(substring(CAST(strptime(date, '%d/%m/%Y %H:%M:%S') AS VARCHAR), 12, 2) AS INT) AS event_hour,
       CAST(substring(CAST(strptime(date, '%d/%m/%Y %H:%M:%S') AS VARCHAR), 15, 2) AS INT) AS event_minute,
       CAST(substring(CAST(strptime(date, '%d/%m/%Y %H:%M:%S') AS VARCHAR), 18, 2) AS INT) AS event_second
FROM feed""",
    "wire_roundtrip": with_(FEED) + "SELECT * FROM feed",
    "ingest_stream": with_(FEED) + "SELECT * FROM feed",
    "ingest_parse": with_(FEED) + f"""
SELECT {FEED_COLS} FROM feed
UNION ALL SELECT 1, 1.5, 2.5, '01/01/2024 00:00:00', 1, 2, 3, 'single'
UNION ALL SELECT NULL, 1.0, 2.0, '02/01/2024 10:00:00', NULL, NULL, 4, 'badtypes'
UNION ALL SELECT 2, NULL, NULL, NULL, NULL, NULL, NULL, 'missing'
UNION ALL SELECT 3, NULL, NULL, NULL, NULL, NULL, NULL, 'first'""",
    "ingest_quarantine": "SELECT * FROM (VALUES ('not json at all'), ('')) AS t(value)",
    "consume_incremental": with_(FEED, NEIGHBORHOODS, SILVER) + "SELECT * FROM silver",
    "flush_by_count": with_(FEED).replace("WITH", "WITH RECURSIVE", 1) + GATE + "SELECT rn - 1 AS batch_id, n, flush_id, flushed FROM gate",
    "gold_gated": with_(FEED, CUSTOMERS, EMPLOYEES, NEIGHBORHOODS, GOLD).replace("WITH", "WITH RECURSIVE", 1) + GATE + """
SELECT * FROM gold WHERE order_id IN (
  SELECT order_id FROM feed f JOIN gate g ON CAST(substring(date, 1, 2) AS INT) // 3 = g.part WHERE g.flush_id IS NOT NULL)""",
    "sink_table_append_retry": with_(FEED) + "SELECT * FROM feed",
    "sink_table_overwrite_self": with_(FEED) + "SELECT * FROM feed WHERE object_id < 20",
    "catalog_databases": "SELECT lower(regexp_replace(r_name, '[^A-Za-z]', '_', 'g')) AS region FROM region",
}
ORACLES |= {"publish_dims_atomic": ORACLES["publish_dims"], "report_incremental_neighborhood": ORACLES["agg_qty_by_neighborhood"],
            "report_incremental_time": ORACLES["agg_qty_by_event_time"], "topk_latest_stored": ORACLES["topk_latest"],
            "sort_desc_stored": ORACLES["sort_desc"]}
