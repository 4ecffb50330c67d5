"""The result of each named query, stated as SQL over the given tables."""

from __future__ import annotations

LOGS = """
WITH purchase AS (
  SELECT e.happened AS transaction_datetime, CAST(e.happened AS DATE) AS transaction_date, purchase_id,
         buyer_id, prod_item_id, order_date, release_date, producer_id
  FROM (
    SELECT o_orderdate AS happened, CAST(NULL AS DATE) AS release_date,
           CAST(o_orderkey AS VARCHAR) AS purchase_id, CAST(o_custkey AS VARCHAR) AS buyer_id,
           o_orderpriority AS prod_item_id, o_orderstatus AS producer_id,
           CAST(o_orderdate AS DATE) AS order_date
    FROM orders
    UNION ALL
    SELECT paid_at, CAST(paid_at AS DATE), CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR),
           o_orderpriority, o_orderstatus, CAST(o_orderdate AS DATE)
    FROM (
      SELECT *, o_orderdate + to_days(CASE o_orderpriority WHEN '1-URGENT' THEN 5
                                      WHEN '2-HIGH' THEN 10 ELSE 15 END) AS paid_at
      FROM orders
    )
    WHERE o_orderstatus <> 'O'
    UNION ALL
    SELECT o_orderdate + to_days(25),
           CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_orderdate + to_days(23) AS DATE) END,
           CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR),
           o_orderpriority, o_orderstatus, CAST(o_orderdate AS DATE)
    FROM orders
    WHERE o_orderstatus = 'P'
  ) e
),
product_item AS (
  SELECT l_shipdate AS transaction_datetime, CAST(l_shipdate AS DATE) AS transaction_date,
         CAST(l_orderkey AS VARCHAR) AS purchase_id, CAST(l_partkey AS VARCHAR) AS product_id,
         CAST(l_quantity AS INT) AS item_quantity, {value} AS purchase_value
  FROM lineitem
),
extra_info AS (
  SELECT happened AS transaction_datetime, CAST(happened AS DATE) AS transaction_date,
         purchase_id, subsidiary
  FROM (
    SELECT o_orderdate + to_hours(1) AS happened, CAST(o_orderkey AS VARCHAR) AS purchase_id,
           r_name AS subsidiary
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
         JOIN region ON n_regionkey = r_regionkey
    UNION ALL
    SELECT o_orderdate + to_days(25) + to_hours(1), CAST(o_orderkey AS VARCHAR), n_name
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    WHERE o_orderstatus = 'P'
  )
)
"""

ORDER = {
    "purchase": [
        "transaction_datetime", "transaction_date", "release_date", "order_date", "buyer_id",
        "prod_item_id", "producer_id",
    ],
    "product_item": [
        "transaction_datetime", "item_quantity", "purchase_value", "product_id",
        "transaction_date",
    ],
    "extra_info": ["transaction_datetime", "subsidiary", "transaction_date"],
}

WINDOW = "transaction_date BETWEEN DATE '1997-03-01' AND DATE '1997-09-30'"
EARLY_END = "transaction_date BETWEEN DATE '1995-01-01' AND DATE '1998-06-30'"
BACKFILL = "transaction_date BETWEEN DATE '1996-01-01' AND DATE '1996-03-31'"
ALL = "transaction_date IS NOT NULL"
DEFAULT = (
    "transaction_date BETWEEN (SELECT min(transaction_date) FROM purchase)"
    " AND (SELECT max(transaction_date) FROM purchase)"
)


def over_logs(sql: str, value: str = "l_extendedprice") -> str:
    return LOGS.replace("{value}", value) + sql


def latest(name: str, where: str = ALL, keys: str = "purchase_id") -> str:
    order = ORDER["purchase" if name == "given" else name]
    newest_first = ", ".join(f"{c} DESC NULLS LAST" for c in order)
    return (
        f"(SELECT * FROM {name} WHERE {where} QUALIFY row_number() OVER "
        f"(PARTITION BY {keys} ORDER BY {newest_first}) = 1)"
    )


def gmv(where: str = ALL, item_keys: str = "purchase_id") -> str:
    return f"""
SELECT p.transaction_date, e.subsidiary,
       CAST(sum(CAST(i.purchase_value AS DECIMAL(18,2)) * i.item_quantity) AS DOUBLE) AS gmv
FROM {latest("purchase", where)} p
LEFT JOIN {latest("product_item", where, item_keys)} i ON p.purchase_id = i.purchase_id
LEFT JOIN {latest("extra_info", where)} e ON p.purchase_id = e.purchase_id
WHERE p.release_date IS NOT NULL
GROUP BY p.transaction_date, e.subsidiary
"""


def impacted(window: str) -> str:
    touched = " UNION ".join(
        f"SELECT purchase_id FROM {name} WHERE {window}" for name in ORDER
    )
    return (
        "SELECT DISTINCT transaction_date FROM purchase WHERE release_date IS NOT NULL "
        f"AND transaction_date IS NOT NULL AND purchase_id IN ({touched})"
    )


def state_complete(window: str) -> str:
    return f"SELECT * FROM ({gmv()}) WHERE transaction_date IN ({impacted(window)})"


def events_in(start: str, end: str) -> str:
    parts = [
        f"SELECT {start} AS start_date, {end} AS end_date, '{name}' AS table_name, "
        f"count(*) AS events FROM {name} WHERE transaction_date BETWEEN {start} AND {end}"
        for name in ORDER
    ]
    return " UNION ALL ".join(parts)


STATE = f"""
SELECT p.purchase_id, p.transaction_datetime AS purchase_transaction_datetime,
       p.transaction_date AS purchase_transaction_date, p.buyer_id, p.prod_item_id, p.order_date,
       p.release_date, p.producer_id, i.transaction_datetime AS item_transaction_datetime,
       i.transaction_date AS item_transaction_date, i.product_id, i.item_quantity,
       i.purchase_value, e.transaction_datetime AS extra_transaction_datetime,
       e.transaction_date AS extra_transaction_date, e.subsidiary
FROM {latest("purchase")} p
LEFT JOIN {latest("product_item")} i ON p.purchase_id = i.purchase_id
LEFT JOIN {latest("extra_info")} e ON p.purchase_id = e.purchase_id
"""

LINES = f"""
SELECT purchase_id, purchase_transaction_date, subsidiary, purchase_value, item_quantity,
       CAST(CAST(purchase_value AS DECIMAL(18,2)) * item_quantity AS DOUBLE) AS gmv_value
FROM ({STATE}) WHERE release_date IS NOT NULL
"""

# The unreadable cells of the malformed logs, by rule instead of by cast.
MALFORMED_ITEM = """
SELECT transaction_datetime, transaction_date, purchase_id, product_id,
       CASE WHEN item_quantity <= 40 THEN item_quantity END AS item_quantity,
       CASE WHEN item_quantity > 10 THEN purchase_value END AS purchase_value
FROM product_item
"""
MALFORMED_PURCHASE = """
SELECT CASE WHEN prod_item_id <> '5-LOW' THEN transaction_datetime END AS transaction_datetime,
       transaction_date, purchase_id, buyer_id, prod_item_id, order_date,
       CASE WHEN producer_id <> 'F' THEN release_date END AS release_date, producer_id
FROM purchase
"""
BAD_CELLS = """
SELECT 'purchase' AS table_name, 'release_date' AS column_name, count(*) AS bad_cells
FROM purchase WHERE producer_id = 'F' AND release_date IS NOT NULL
UNION ALL
SELECT 'purchase', 'transaction_datetime', count(*) FROM purchase WHERE prod_item_id = '5-LOW'
UNION ALL
SELECT 'product_item', 'item_quantity', count(*) FROM product_item WHERE item_quantity > 40
UNION ALL
SELECT 'product_item', 'purchase_value', count(*) FROM product_item WHERE item_quantity <= 10
UNION ALL
SELECT 'extra_info', 'transaction_date', count(*) FROM extra_info WHERE subsidiary = 'ASIA'
"""

COLUMNS = {
    "purchase": [
        "transaction_datetime", "transaction_date", "purchase_id", "buyer_id", "prod_item_id",
        "order_date", "release_date", "producer_id",
    ],
    "product_item": [
        "transaction_datetime", "transaction_date", "purchase_id", "product_id",
        "item_quantity", "purchase_value",
    ],
    "extra_info": ["transaction_datetime", "transaction_date", "purchase_id", "subsidiary"],
}


def null_counts() -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, '{column}' AS column_name, "
        f"count(*) FILTER (WHERE {column} IS NULL) AS null_count FROM {name}"
        for name, columns in COLUMNS.items()
        for column in columns
    )


def unmatched(events: str, other: str) -> str:
    return (
        f"SELECT purchase_id, count(*) AS events FROM {events} WHERE {WINDOW} AND purchase_id "
        f"NOT IN (SELECT purchase_id FROM {other} WHERE {WINDOW}) GROUP BY purchase_id"
    )


def duplicates() -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS events, "
        "count(DISTINCT purchase_id) AS purchases, "
        f"count(*) - count(DISTINCT purchase_id) AS superseded FROM {name}"
        for name in ORDER
    )


def freshness() -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, max(transaction_datetime) AS newest_event FROM {name}"
        for name in ORDER
    )


OVERWRITTEN = f"""
, fresh AS ({gmv(WINDOW)}), old AS ({gmv("transaction_date < DATE '1997-03-01'")})
SELECT * FROM fresh
UNION ALL
SELECT * FROM old WHERE transaction_date NOT IN (SELECT transaction_date FROM fresh)
"""


def contract(where: str) -> str:
    return f"""
SELECT *, concat_ws(',', CASE WHEN subsidiary IS NULL THEN 'subsidiary_null' END,
                    CASE WHEN gmv IS NULL THEN 'gmv_null' END) AS broken_rules
FROM ({gmv(where)}) WHERE subsidiary IS NULL OR gmv IS NULL
"""


QUARANTINED = """
SELECT table_name, purchase_id, bad_columns, count(*) AS n FROM (
  SELECT 'purchase' AS table_name, purchase_id, concat_ws(',',
           CASE WHEN prod_item_id = '5-LOW' THEN 'transaction_datetime' END,
           CASE WHEN producer_id = 'F' AND release_date IS NOT NULL THEN 'release_date' END
         ) AS bad_columns FROM purchase
  UNION ALL
  SELECT 'product_item', purchase_id, CASE WHEN item_quantity > 40 THEN 'item_quantity'
                                           WHEN item_quantity <= 10 THEN 'purchase_value' ELSE '' END
  FROM product_item
  UNION ALL
  SELECT 'extra_info', purchase_id, CASE WHEN subsidiary = 'ASIA' THEN 'transaction_date' ELSE '' END
  FROM extra_info
) WHERE bad_columns <> '' GROUP BY ALL
"""


def scaled_lines(factor: str) -> str:
    return (
        f"SELECT purchase_id, round(purchase_value * item_quantity / {factor}, 4) AS gmv_value "
        f"FROM ({STATE}) WHERE release_date IS NOT NULL"
    )



ANOMALY = f"""
SELECT transaction_date, subsidiary, gmv, z_score FROM (
  SELECT *, round((gmv - avg(gmv) OVER w) / nullif(stddev_samp(gmv) OVER w, 0), 4) AS z_score,
         count(gmv) OVER w AS rows_back
  FROM ({gmv()})
  WINDOW w AS (PARTITION BY subsidiary ORDER BY transaction_date
               ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING)
) WHERE rows_back >= 7 AND abs(z_score) > 3
"""

DELTA = f"""
SELECT *, round(gmv - previous_gmv, 2) AS delta FROM (
  SELECT *, lag(gmv) OVER (PARTITION BY subsidiary ORDER BY transaction_date) AS previous_gmv
  FROM ({gmv()})
)
"""

DROPS = f"""
, per_day AS (
  SELECT transaction_date, sum(coalesce(CAST(gmv AS DECIMAL(28,2)), 0)) AS total FROM ({gmv()})
  GROUP BY transaction_date
),
calendar AS (
  SELECT CAST(unnest(generate_series(min(transaction_date), max(transaction_date), INTERVAL 1 DAY))
              AS DATE) AS transaction_date FROM per_day
),
filled AS (
  SELECT c.transaction_date, coalesce(p.total, 0) AS total
  FROM calendar c LEFT JOIN per_day p ON c.transaction_date = p.transaction_date
)
SELECT d.transaction_date, CAST(d.total AS DOUBLE) AS gmv, CAST(b.total AS DOUBLE) AS previous_gmv
FROM filled d JOIN filled b ON d.transaction_date = b.transaction_date + 1
WHERE b.total > 0 AND d.total < CAST(0.8 AS DECIMAL(2,1)) * b.total
"""

LATE = "transaction_date BETWEEN DATE '2001-07-01' AND DATE '2002-12-31'"
REVERSED = "transaction_date BETWEEN DATE '1996-03-01' AND DATE '1996-03-31'"


METRICS = f"""
, gold AS ({state_complete(LATE)}), old AS ({gmv("transaction_date < DATE '2001-07-01'")})
SELECT 'purchase_events' AS metric, count(*) AS value FROM purchase
UNION ALL SELECT 'gold_rows', count(*) FROM gold
UNION ALL SELECT 'days_written', count(DISTINCT transaction_date) FROM gold
UNION ALL SELECT 'days_cleared', count(DISTINCT transaction_date) FROM old
  WHERE transaction_date IN ({impacted(LATE)})
    AND transaction_date NOT IN (SELECT transaction_date FROM gold)
UNION ALL SELECT 'undated_purchase', count(*) FROM purchase WHERE transaction_date IS NULL
UNION ALL SELECT 'contract_violations', count(*) FROM gold WHERE subsidiary IS NULL OR gmv IS NULL
UNION ALL SELECT 'grain_violations', 0
"""

FIRST_ROWS = f"SELECT * FROM ({gmv(DEFAULT)}) ORDER BY transaction_date, subsidiary NULLS FIRST"

FULL = gmv()
EVERY_PURCHASE = f"SELECT {', '.join(COLUMNS['purchase'])} FROM purchase"

def as_of_event_days(name: str, columns: str) -> str:
    """For every purchase and day of any of its events, the latest event of a log up to that day."""
    newest_first = ", ".join(f"x.{c} DESC NULLS LAST" for c in ORDER[name])
    return (
        f"(SELECT d.purchase_id, d.known_on, {columns} FROM event_days d JOIN {name} x "
        "ON x.purchase_id = d.purchase_id AND x.transaction_date <= d.known_on QUALIFY row_number() "
        f"OVER (PARTITION BY d.purchase_id, d.known_on ORDER BY {newest_first}) = 1)"
    )


CHANGES = f"""
, event_days AS (
  SELECT purchase_id, transaction_date AS known_on FROM purchase UNION
  SELECT purchase_id, transaction_date FROM product_item UNION
  SELECT purchase_id, transaction_date FROM extra_info
),
states AS (
  SELECT purchase_id, known_on, p.transaction_date, e.subsidiary, p.release_date IS NOT NULL AS paid,
         CAST(i.purchase_value AS DECIMAL(18,2)) * i.item_quantity AS amount
  FROM event_days
  LEFT JOIN {as_of_event_days("purchase", "x.transaction_date, x.release_date")} p USING (purchase_id, known_on)
  LEFT JOIN {as_of_event_days("product_item", "x.purchase_value, x.item_quantity")} i USING (purchase_id, known_on)
  LEFT JOIN {as_of_event_days("extra_info", "x.subsidiary")} e USING (purchase_id, known_on)
),
turns AS (
  SELECT *, lag(paid) OVER w AS was_paid, lag(transaction_date) OVER w AS old_date,
         lag(subsidiary) OVER w AS old_subsidiary, lag(amount) OVER w AS old_amount
  FROM states WINDOW w AS (PARTITION BY purchase_id ORDER BY known_on)
),
entries AS (
  SELECT known_on, transaction_date, subsidiary, 1 AS n, amount FROM turns WHERE paid
  UNION ALL
  SELECT known_on, old_date, old_subsidiary, -1, -old_amount FROM turns WHERE was_paid
)
SELECT known_on, transaction_date, subsidiary, CAST(sum(n) AS BIGINT) AS purchases
FROM entries GROUP BY known_on, transaction_date, subsidiary
HAVING sum(n) <> 0 OR sum(amount) <> 0 OR sum(CASE WHEN amount IS NOT NULL THEN n END) <> 0
"""

_SQL = {
    "bronze_purchase": EVERY_PURCHASE,
    "bronze_product_item": "SELECT * FROM product_item",
    "bronze_extra_info": "SELECT * FROM extra_info",
    "bronze_append": EVERY_PURCHASE,
    "bronze_typed_window": gmv(WINDOW),
    "cast_tolerance": MALFORMED_ITEM,
    "cast_tolerance_dates": MALFORMED_PURCHASE,
    "window_explicit": events_in("DATE '1997-03-01'", "DATE '1997-09-30'"),
    "window_start_only": events_in("DATE '2000-10-01'", "DATE '2000-12-31'"),
    "window_end_only": events_in("DATE '1999-12-01'", "DATE '1999-12-31'"),
    "window_default": events_in(
        "(SELECT min(transaction_date) FROM purchase)",
        "(SELECT max(transaction_date) FROM purchase)",
    ),
    "window_default_bounds": (
        "SELECT min(transaction_date) AS min_date, max(transaction_date) AS max_date FROM purchase"
    ),
    "window_purchase": f"{EVERY_PURCHASE} WHERE {WINDOW}",
    "window_product_item": f"SELECT * FROM product_item WHERE {WINDOW}",
    "window_extra_info": f"SELECT * FROM extra_info WHERE {WINDOW}",
    "silver_purchase": f"SELECT * FROM {latest('purchase')}",
    "silver_product_item": f"SELECT * FROM {latest('product_item')}",
    "silver_extra_info": f"SELECT * FROM {latest('extra_info')}",
    "silver_roundtrip_purchase": f"SELECT * FROM {latest('purchase')}",
    "silver_roundtrip_product_item": f"SELECT * FROM {latest('product_item')}",
    "silver_roundtrip_extra_info": f"SELECT * FROM {latest('extra_info')}",
    "purchase_state": STATE,
    "paid_purchases": f"SELECT * FROM {latest('purchase')} WHERE release_date IS NOT NULL",
    "unpaid_purchases": f"SELECT * FROM {latest('purchase')} WHERE release_date IS NULL",
    "gmv_lines": LINES,
    "daily_gmv": gmv(DEFAULT),
    "daily_gmv_window": gmv(WINDOW),
    "daily_gmv_window_early_end": gmv(EARLY_END),
    "daily_gmv_full_history": FULL,
    "daily_gmv_asof": gmv("transaction_date <= DATE '1998-06-30'"),
    "daily_gmv_multi_item": gmv(item_keys="purchase_id, product_id"),
    "daily_gmv_backfill": state_complete(BACKFILL),
    "daily_gmv_rebuild_days": (
        f"SELECT * FROM ({FULL}) WHERE transaction_date IN "
        "(DATE '1996-05-02', DATE '1998-01-15', DATE '2000-11-30')"
    ),
    "daily_gmv_state_complete": state_complete(WINDOW),
    "impacted_dates": impacted(WINDOW),
    "impacted_dates_indexed": impacted(WINDOW),
    "gold_roundtrip": FULL,
    "gold_roundtrip_csv": FULL,
    "gold_incremental_overwrite": OVERWRITTEN,
    "gold_from_snapshots": FULL,
    "gold_from_snapshots_gap": FULL,
    "gold_decimal": (
        "SELECT transaction_date, subsidiary, CAST(gmv AS DECIMAL(18,2)) AS gmv "
        f"FROM ({gmv(DEFAULT)}) WHERE transaction_date IS NOT NULL AND subsidiary IS NOT NULL "
        "AND gmv IS NOT NULL"
    ),
    "gold_external_table": FULL,
    "gold_query": f"SELECT * FROM ({FULL}) ORDER BY transaction_date, subsidiary",
    "gold_preview": f"{FIRST_ROWS} LIMIT 200",
    "empty_window": FULL,
    "no_paid_window": FULL,
    "dq_null_counts": null_counts(),
    "dq_orphan_items": unmatched("product_item", "purchase"),
    "dq_purchases_without_items": unmatched("purchase", "product_item"),
    "dq_bad_casts": BAD_CELLS,
    "dq_gold_contract": contract(WINDOW),
    "gold_quarantine": contract(DEFAULT),
    "bronze_quarantine": QUARANTINED,
    "bronze_ingested": gmv(WINDOW),
    "bronze_ingest_twice": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, CAST({number} AS BIGINT) AS arrival, count(*) AS events "
        f"FROM {name} WHERE {rule}"
        for name in ORDER
        for number, rule in enumerate((f"NOT ({WINDOW})", WINDOW))
    ),
    "bronze_odd_file": (
        "SELECT producer_id, count(*) AS events FROM purchase GROUP BY producer_id UNION ALL "
        "SELECT 'put aside', count(*) FROM purchase WHERE transaction_date >= DATE '2001-07-01'"
    ),
    "gold_late_by_arrival": FULL,
    "mon_typed_bounds": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, min(transaction_date) AS min_date, max(transaction_date) AS max_date, "
        f"max(transaction_datetime) AS newest_event FROM {name}"
        for name in ORDER
    ),
    "mon_duplicates_sketched": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS events, true AS near FROM {name}" for name in ORDER
    ),
    "dq_gmv_outliers": f"""
SELECT transaction_date, subsidiary, gmv, round((gmv - q[2]) / ((q[3] - q[1]) / 1.349), 4) AS score
FROM ({FULL}) JOIN (
  SELECT dayofweek(transaction_date) AS weekday, subsidiary, quantile_disc(gmv, [0.25, 0.5, 0.75]) AS q
  FROM ({FULL}) WHERE gmv IS NOT NULL GROUP BY ALL HAVING count(*) >= 8
) b USING (subsidiary)
WHERE dayofweek(transaction_date) = weekday AND q[3] > q[1]
  AND abs(round((gmv - q[2]) / ((q[3] - q[1]) / 1.349), 4)) > 3
""",
    "dq_unmatched_carried": (
        "SELECT purchase_id, count(*) AS events, min(transaction_date) AS first_day FROM purchase "
        "WHERE purchase_id NOT IN (SELECT purchase_id FROM product_item) GROUP BY purchase_id"
    ),
    "gold_ledger": CHANGES,
    "daily_gmv_asof_ledger": gmv("transaction_date <= DATE '1998-06-30'"),
    "dq_gold_grain": f"SELECT transaction_date, subsidiary, 2 AS n FROM ({FULL}) WHERE {REVERSED}",
    "dq_gmv_anomaly": ANOMALY,
    "mon_partition_rows": (
        f"SELECT transaction_date, count(*) AS row_count FROM ({FULL}) GROUP BY transaction_date"
    ),
    "mon_freshness": freshness(),
    "mon_duplicates": duplicates(),
    "mon_daily_delta": DELTA,
    "alert_gmv_drop": DROPS,
}

REFUNDS = "CASE WHEN l_returnflag = 'R' THEN -l_extendedprice ELSE l_extendedprice END"
WIDE_REFUNDS = "CASE WHEN l_returnflag = 'R' THEN -1e20 ELSE l_extendedprice END"

# Late events that take back the payment of every purchase of one month.
REVERSALS = f""", purchase AS (
  SELECT * FROM given
  UNION ALL
  SELECT TIMESTAMP '2001-07-11', DATE '2001-07-11', purchase_id, buyer_id, prod_item_id, order_date,
         NULL, producer_id
  FROM {latest("given", "transaction_date < DATE '2001-07-01'")}
  WHERE release_date IS NOT NULL AND {REVERSED}
)
"""


def over_reversed_logs(sql: str) -> str:
    given = over_logs("").replace("WITH purchase AS (", "WITH given AS (", 1)
    return given + REVERSALS + sql


WIDE_DAYS = f"""
SELECT p.transaction_date, e.subsidiary,
       round(sum(i.purchase_value * i.item_quantity) / 1e14, 2) AS gmv
FROM {latest("purchase")} p
LEFT JOIN {latest("product_item")} i ON p.purchase_id = i.purchase_id
LEFT JOIN {latest("extra_info")} e ON p.purchase_id = e.purchase_id
WHERE p.release_date IS NOT NULL
GROUP BY p.transaction_date, e.subsidiary
"""

ORACLES = {name: over_logs(sql) for name, sql in _SQL.items()} | {
    "gold_late_correction": over_reversed_logs(FULL),
    "gold_idempotent": over_reversed_logs(FULL),
    "gold_from_slices": over_reversed_logs(FULL),
    "gold_published": over_reversed_logs(f"SELECT * FROM ({FULL}) ORDER BY transaction_date, subsidiary"),
    "mon_run_metrics": over_reversed_logs(METRICS),
    "gmv_lines_fine": over_logs(scaled_lines("1e-10"), "l_extendedprice * 1e-10"),
    "gmv_lines_wide": over_logs(scaled_lines("1e14"), "l_extendedprice * 1e14"),
    "daily_gmv_wide": over_logs(WIDE_DAYS, "l_extendedprice * 1e14"),
    "dq_negative_lines": over_logs(f"SELECT * FROM ({LINES}) WHERE gmv_value < 0", REFUNDS),
    "dq_negative_lines_wide": over_logs(
        f"SELECT purchase_id, purchase_value * item_quantity AS gmv_value FROM ({STATE}) "
        "WHERE release_date IS NOT NULL AND purchase_value < 0",
        WIDE_REFUNDS,
    ),
    "dq_negative_gmv": over_logs(f"SELECT * FROM ({FULL}) WHERE gmv < 0", REFUNDS),
    "latest_event_per_user": (
        "SELECT * FROM events QUALIFY row_number() OVER "
        "(PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"
    ),
}
