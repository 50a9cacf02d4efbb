"""SQL that each registered query must equal, for DuckDB over the same tables."""

from __future__ import annotations

# One row per event, as registry.inputs.single_events has it.
_EVENTS = """
single AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id,
         CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y%m%d') AS order_id,
         CAST(user_id AS VARCHAR) AS customer_id,
         CASE event_type WHEN 'signup' THEN 'ORDER_CREATED' WHEN 'purchase' THEN 'PAYMENT_APPROVED'
              WHEN 'view' THEN 'SHIPPED' WHEN 'click' THEN 'DELIVERED' WHEN 'error' THEN 'CANCELLED' END AS event_type,
         ts AS original_event_time,
         date_trunc('hour', ts) AS event_time,
         ts + to_seconds(event_id % 90) AS first_ingestion,
         CASE event_type WHEN 'signup' THEN 'created' WHEN 'purchase' THEN 'approved'
              WHEN 'view' THEN 'shipped' WHEN 'click' THEN 'delivered' WHEN 'error' THEN 'cancelled' END AS order_status,
         CAST(user_id % 4 AS INTEGER) AS "partition",
         event_id AS number
  FROM events
)"""

# All deliveries, as registry.inputs.deliveries has them.
_LOG = f"""WITH {_EVENTS},
attempts AS (
  SELECT *, unnest(range(0, number % 3 + 1)) AS attempt FROM single
),
log AS (
  SELECT event_id, order_id, customer_id, event_type, original_event_time, event_time,
         first_ingestion + to_minutes(attempt * 10) AS ingestion_time,
         order_status, 'order-events' AS topic, "partition", number * 3 + attempt AS "offset",
         CAST(floor(epoch(TIMESTAMP '2024-02-01')) AS BIGINT)
           - CAST(floor(epoch(first_ingestion + to_minutes(attempt * 10))) AS BIGINT) AS lag_sec
  FROM attempts
),
deduped AS (
  SELECT * FROM log
  QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY ingestion_time DESC, "offset" DESC) = 1
)"""


def _latest(source: str, order: str = 'event_time DESC, "offset" DESC, event_id DESC', where: str = "TRUE") -> str:
    return (
        f"SELECT * FROM {source} WHERE {where} "
        f"QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY {order}) = 1"
    )


_BY_INGESTION = 'event_time DESC, ingestion_time DESC, "offset" DESC, event_id DESC'
_STATE_COLUMNS = 'order_id, event_id, event_type, event_time, ingestion_time, "offset"'


def _silver(source: str, stamp: str, status: str = "event_type", lag: str = "lag_sec") -> str:
    return f"""SELECT order_id, customer_id, event_id, event_type, original_event_time, event_time, ingestion_time,
       {status} AS current_status, {lag} AS ingestion_lag_sec, CAST(event_time AS DATE) AS event_date,
       TIMESTAMP '{stamp}' AS updated_at
FROM ({source})"""


_INGESTION_LAG = (
    "CAST(floor(epoch(ingestion_time)) AS BIGINT) - CAST(floor(epoch(event_time)) AS BIGINT)"
)
_EARLY = "event_type IN ('ORDER_CREATED', 'PAYMENT_APPROVED', 'SHIPPED')"
_LATE = "event_type IN ('SHIPPED', 'DELIVERED', 'CANCELLED')"
_SIDES = f"""{_LOG},
tgt AS ({_silver(_latest("deduped", where=_EARLY), "2024-02-01")}),
src AS ({_silver(_latest("deduped", where=_LATE), "2024-02-02")})"""
_SILVER_COLUMNS = [
    "customer_id", "event_id", "event_type", "original_event_time", "event_time", "ingestion_time",
    "current_status", "ingestion_lag_sec", "event_date", "updated_at",
]


def _merged(guard: str, sides: str = _SIDES) -> str:
    take = f"t.order_id IS NULL OR (s.order_id IS NOT NULL AND coalesce({guard}, FALSE))"
    columns = ",\n  ".join(f"CASE WHEN {take} THEN s.{c} ELSE t.{c} END AS {c}" for c in _SILVER_COLUMNS)
    return f"""{sides}
SELECT coalesce(t.order_id, s.order_id) AS order_id,
  {columns}
FROM tgt t FULL OUTER JOIN src s ON t.order_id = s.order_id"""


_COUNTS = {
    "created_orders": "ORDER_CREATED",
    "approved_orders": "PAYMENT_APPROVED",
    "shipped_orders": "SHIPPED",
    "delivered_orders": "DELIVERED",
}


def _daily(source: str, extra: str = "") -> str:
    counts = ", ".join(f"count(*) FILTER (WHERE current_status = '{v}') AS {c}" for c, v in _COUNTS.items())
    return f"""SELECT event_date AS order_date, count(*) AS total_orders, {counts},
       count(*) FILTER (WHERE current_status = 'DELIVERED') / count(*) AS delivery_rate{extra}
FROM ({source}) GROUP BY event_date"""


_STATE = _silver(_latest("deduped"), "2024-02-01")
_OTHER = (
    ", count(*) FILTER (WHERE current_status NOT IN ('ORDER_CREATED', 'PAYMENT_APPROVED', 'SHIPPED', 'DELIVERED'))"
    " AS other_orders"
)
_GOLD_COLUMNS = ["total_orders", *_COUNTS, "delivery_rate", "updated_at"]

_POSITIONS = """positions AS (
  SELECT topic, "partition", max("offset") + 1 AS next_offset FROM log
  WHERE ingestion_time < TIMESTAMP '2024-01-16' AND "partition" <> 3 GROUP BY ALL
)"""
_ADVANCED = """SELECT topic, "partition", max(next_offset) AS next_offset FROM (
  SELECT * FROM positions UNION ALL
  SELECT topic, "partition", max("offset") + 1 FROM log WHERE "partition" <> 1 GROUP BY ALL
) GROUP BY ALL"""

_WIDE = """wide AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
         o_orderstatus AS order_status, o_orderdate AS order_purchase_timestamp,
         CASE WHEN o_orderstatus IN ('P', 'F') THEN o_orderdate + INTERVAL 1 DAY END AS order_approved_at,
         first_ship AS order_delivered_carrier_date,
         CASE WHEN o_orderstatus = 'F' THEN last_ship END AS order_delivered_customer_date,
         CASE WHEN o_orderstatus = 'O' THEN o_orderdate + INTERVAL 2 DAY END AS order_cancelled_at
  FROM orders LEFT JOIN (
    SELECT l_orderkey, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship FROM lineitem GROUP BY l_orderkey
  ) ON l_orderkey = o_orderkey
)"""
_STAGES = [
    ("ORDER_CREATED", "created", "order_purchase_timestamp"),
    ("PAYMENT_APPROVED", "approved", "order_approved_at"),
    ("SHIPPED", "shipped", "order_delivered_carrier_date"),
    ("DELIVERED", "delivered", "order_delivered_customer_date"),
]
_CANCELLED = ("CANCELLED", "cancelled", "order_cancelled_at")


def _lifecycle(stages) -> str:
    branches = [
        f"SELECT sha256(order_id || '|{kind}') AS event_id, order_id, customer_id, '{kind}' AS event_type,"
        f" {time} AS event_time, '{status}' AS order_status FROM wide"
        + ("" if kind == "ORDER_CREATED" else f" WHERE {time} IS NOT NULL")
        for kind, status, time in stages
    ]
    return f"WITH {_WIDE}\n" + "\nUNION ALL\n".join(branches)


def _sample(caps: dict[str, int]) -> str:
    cap = " ".join(f"WHEN '{k}' THEN {v}" for k, v in caps.items())
    return f"""SELECT * FROM orders
QUALIFY row_number() OVER (PARTITION BY o_orderstatus ORDER BY md5(CAST(o_orderkey AS VARCHAR) || '-42'))
        <= CASE o_orderstatus {cap} ELSE 0 END"""


ORACLE: dict[str, str] = {
    "json_decode": """SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events""",
    "envelope_roundtrip": f"""{_LOG}
SELECT event_id, order_id, customer_id, event_type,
       strftime(original_event_time, '%Y-%m-%dT%H:%M:%S.%f') AS original_event_time,
       strftime(event_time, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS event_time,
       strftime(ingestion_time, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS ingestion_time,
       order_status, topic, "partition", "offset" FROM log""",
    "ingest_partitions": """SELECT event_id, CAST(ts AS DATE) AS raw_date, CAST(hour(ts) AS INTEGER) AS raw_hour FROM events""",
    "ingestion_lag": f"""{_LOG}
SELECT "offset", {_INGESTION_LAG} AS ingestion_lag_sec, lag_sec AS processing_lag_sec,
       CAST(event_time AS DATE) AS event_date FROM log""",
    "bronze_rows": f"""{_LOG}
SELECT event_id, order_id, "partition", "offset", ingestion_time AS kafka_timestamp,
       TIMESTAMP '2024-02-01' AS processing_time, ingestion_time AS ingestion_timestamp, lag_sec,
       DATE '2024-02-01' AS raw_date, CAST(0 AS INTEGER) AS raw_hour FROM log""",
    "quarantine_split": """SELECT event_id * 3 AS "offset",
       CASE event_id % 11 WHEN 0 THEN 'bad_json' WHEN 1 THEN 'missing_event_id' WHEN 2 THEN 'missing_order_id'
            WHEN 3 THEN 'bad_event_time' WHEN 4 THEN 'missing_event_id' WHEN 5 THEN 'missing_event_id' END AS reject_reason,
       CASE WHEN event_id % 11 = 0 THEN 'not json' END AS corrupt_record
FROM events""",
    "dedup_latest_ingestion": f"""{_LOG} SELECT event_id, order_id, ingestion_time, "offset" FROM deduped""",
    "drop_duplicates_keys": f"""{_LOG} SELECT DISTINCT event_id FROM log""",
    "silver_input": f"""{_LOG}
SELECT event_id, order_id, event_type, event_time, ingestion_time, {_INGESTION_LAG} AS ingestion_lag_sec,
       CAST(event_time AS DATE) AS event_date FROM deduped""",
    "latest_state": f"{_LOG} SELECT {_STATE_COLUMNS} FROM ({_latest('deduped')})",
    "latest_state_single_pass": f"{_LOG} SELECT {_STATE_COLUMNS} FROM ({_latest('deduped')})",
    "latest_state_variant_b": f"{_LOG} SELECT {_STATE_COLUMNS} FROM ({_latest('deduped', _BY_INGESTION)})",
    "latest_of_changed_orders": f"""{_LOG} SELECT {_STATE_COLUMNS} FROM ({_latest('deduped')})
WHERE order_id IN (SELECT order_id FROM log WHERE event_type = 'CANCELLED')""",
    "silver_increment_with_history": f"""{_LOG},
moved AS (
  SELECT * REPLACE (CASE WHEN CAST(event_id AS BIGINT) % 7 = 0 AND "offset" % 3 > 0 THEN order_id || '-m' ELSE order_id END AS order_id) FROM log),
single_copy AS (SELECT * FROM moved QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY ingestion_time DESC, "offset" DESC) = 1),
touched AS (SELECT DISTINCT order_id FROM moved WHERE event_id IN (SELECT event_id FROM moved WHERE ingestion_time >= TIMESTAMP '2024-01-16'))
SELECT {_STATE_COLUMNS} FROM ({_latest('single_copy')}) WHERE order_id IN (SELECT order_id FROM touched)""",
    "silver_projection": f"{_LOG} {_STATE}",
    "silver_projection_variant_b": f"""{_LOG}
{_silver(_latest('deduped', _BY_INGESTION), '2024-02-01', 'order_status', _INGESTION_LAG)}""",
    "merge_guarded": _merged("s.event_time >= t.event_time"),
    "merge_unconditional": _merged("TRUE"),
    "merge_skip_unchanged": _merged("s.event_time >= t.event_time AND s.event_id IS DISTINCT FROM t.event_id"),
    "gold_merge": f"""{_SIDES},
old AS (SELECT *, TIMESTAMP '2024-02-01' AS updated_at FROM ({_daily("SELECT * FROM tgt")}) WHERE order_date <= DATE '2024-01-20'),
new AS (SELECT *, TIMESTAMP '2024-02-02' AS updated_at
        FROM ({_daily("SELECT * FROM src")}) WHERE order_date >= DATE '2024-01-11')
SELECT coalesce(n.order_date, o.order_date) AS order_date,
  {", ".join(f"CASE WHEN n.order_date IS NULL THEN o.{c} ELSE n.{c} END AS {c}" for c in _GOLD_COLUMNS)}
FROM old o FULL OUTER JOIN new n ON o.order_date = n.order_date""",
    "gold_daily_summary": f"{_LOG} {_daily(_STATE, _OTHER)}",
    "medallion_daily": f"{_LOG} SELECT *, TIMESTAMP '2024-02-01' AS updated_at FROM ({_daily(_STATE)})",
    "medallion_daily_single_pass": f"{_LOG} SELECT *, TIMESTAMP '2024-02-01' AS updated_at FROM ({_daily(_STATE)})",
    "gold_ordered": f"{_LOG} SELECT order_date, total_orders FROM ({_daily(_STATE)}) ORDER BY order_date",
    "kpi_revenue": """SELECT CAST(o_orderdate AS DATE) AS order_date, count(*) AS total_orders,
       CAST(coalesce(sum(paid), 0) AS DOUBLE) AS revenue
FROM orders LEFT JOIN (
  SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS paid FROM lineitem GROUP BY l_orderkey
) ON l_orderkey = o_orderkey GROUP BY 1""",
    "kpi_cancellation": """SELECT CAST(o_orderdate AS DATE) AS order_date, count(*) AS total_orders,
       count(*) FILTER (WHERE o_orderstatus = 'O') AS cancelled_orders,
       count(*) FILTER (WHERE o_orderstatus = 'O') / count(*) AS cancellation_rate
FROM orders GROUP BY 1""",
    "kpi_delivery_time": f"""WITH {_WIDE}
SELECT CAST(order_purchase_timestamp AS DATE) AS order_date, count(*) AS delivered_orders,
       avg(CAST(floor(epoch(order_delivered_customer_date)) AS BIGINT)
           - CAST(floor(epoch(order_purchase_timestamp)) AS BIGINT)) AS avg_delivery_sec
FROM wide WHERE order_delivered_customer_date IS NOT NULL GROUP BY 1""",
    "log_next_offsets": f"""{_LOG} SELECT topic, "partition", max("offset") + 1 AS next_offset FROM log GROUP BY ALL""",
    "log_resume": f"""{_LOG}, {_POSITIONS}
SELECT log.topic, log."partition", log."offset" FROM log LEFT JOIN positions p
  ON p.topic = log.topic AND p."partition" = log."partition"
WHERE log."offset" >= coalesce(p.next_offset, 0)""",
    "log_resume_null_slots": f"""{_LOG},
dealt AS (
  SELECT slots, CASE WHEN "offset" % 7 > 0 THEN topic END AS topic, CAST(CASE WHEN "offset" % 11 > 0 THEN "offset" % slots END AS INTEGER) AS "partition",
         "offset", ingestion_time FROM log, (VALUES (4), (300)) v(slots)),
known AS (
  SELECT slots, topic, "partition", max("offset") + 1 AS next_offset FROM dealt
  WHERE ingestion_time < TIMESTAMP '2024-01-16' GROUP BY ALL)
SELECT slots, d.topic, d."partition", d."offset" FROM dealt d LEFT JOIN known k USING (slots, topic, "partition")
WHERE d."offset" >= coalesce(k.next_offset, 0)""",
    "log_advance": f"{_LOG}, {_POSITIONS} {_ADVANCED}",
    "stored_offsets": f"{_LOG}, {_POSITIONS} {_ADVANCED}",
    "lifecycle_unpivot": _lifecycle(_STAGES),
    "lifecycle_with_cancelled": _lifecycle([*_STAGES, _CANCELLED]),
    "lifecycle_records": f"""SELECT event_id, order_id, customer_id, event_type,
       strftime(event_time, '%Y-%m-%dT%H:%M:%S.%f') AS original_event_time,
       '2024-02-01T00:00:00.000000+00:00' AS event_time, '2024-02-01T00:00:00.000000+00:00' AS ingestion_time,
       order_status FROM ({_lifecycle(_STAGES)})""",
    "orders_to_daily": f"""WITH life AS (
  SELECT *, CASE event_type WHEN 'ORDER_CREATED' THEN 0 WHEN 'PAYMENT_APPROVED' THEN 1 WHEN 'SHIPPED' THEN 2 ELSE 3 END AS rank
  FROM ({_lifecycle(_STAGES)})
), state AS (
  SELECT CAST(event_time AS DATE) AS event_date, event_type AS current_status FROM life
  QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY event_time DESC, rank DESC) = 1
) {_daily("SELECT * FROM state")}""",
    "stratified_orders": f"""SELECT o_orderkey, o_orderstatus, o_totalprice
FROM ({_sample({"F": 500, "O": 70, "P": 2_000_000})})""",
    "child_semi_join": f"""SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
WHERE l_orderkey IN (SELECT o_orderkey FROM ({_sample({"F": 500, "O": 70})}))""",
    "value_counts": "SELECT c_mktsegment, count(*) AS customers FROM customer GROUP BY c_mktsegment",
    "state_counts": f"""{_LOG} SELECT current_status, count(*) AS order_count
FROM ({_silver(_latest('deduped', _BY_INGESTION), '2024-02-01', 'order_status')}) GROUP BY current_status""",
    "null_profile": f"""WITH {_WIDE} SELECT
  {", ".join(f"count(*) FILTER (WHERE {t} IS NULL) AS {t}" for _, _, t in _STAGES)} FROM wide""",
    "distinct_count": "SELECT count(DISTINCT l_orderkey) AS distinct_orders FROM lineitem",
    "row_count": "SELECT count(*) AS line_count FROM lineitem",
    "reconcile": f"""{_LOG} SELECT count(*) AS rows_before, count(DISTINCT event_id) AS rows_after,
  count(*) - count(DISTINCT event_id) AS duplicates_removed FROM log""",
    "top_k_recent": f"""WITH {_EVENTS}, latest AS (
  SELECT *, number * 3 AS "offset" FROM single
  QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY event_time DESC, number DESC) = 1
) SELECT order_id, event_type, event_time, "offset" FROM latest ORDER BY event_time DESC, "offset" DESC LIMIT 20""",
    "ingest_two_batches": f"""{_LOG}, early AS (
  SELECT "partition", max("offset") + 1 AS next_offset FROM log WHERE ingestion_time < TIMESTAMP '2024-01-16' GROUP BY ALL
), runs AS (
  SELECT *, TIMESTAMP '2024-02-01' AS run FROM log WHERE ingestion_time < TIMESTAMP '2024-01-16'
  UNION ALL
  SELECT log.*, TIMESTAMP '2024-02-02' FROM log LEFT JOIN early e ON e."partition" = log."partition"
  WHERE "offset" >= coalesce(next_offset, 0)
) SELECT event_id, "partition", "offset",
  CAST(floor(epoch(run)) AS BIGINT) - CAST(floor(epoch(ingestion_time)) AS BIGINT) AS lag_sec,
  CAST(run AS DATE) AS raw_date, CAST(0 AS INTEGER) AS raw_hour FROM runs""",
    "silver_table_two_refreshes": _merged("s.event_time >= t.event_time"),
    "silver_table_last_hours": _merged(
        "s.event_time >= t.event_time",
        f"""{_LOG},
tgt AS ({_silver(_latest("deduped", where=_EARLY), "2024-02-01")}),
src AS ({_silver(_latest("deduped", where="original_event_time >= TIMESTAMP '2024-01-30 12:00:00'"), "2024-02-02")})""",
    ),
    "gold_table_refresh": f"""{_LOG},
tgt AS ({_silver(_latest("deduped", where="event_type <> 'CANCELLED'"), "2024-02-01")}),
src AS ({_silver(_latest("deduped", where="event_type = 'CANCELLED'"), "2024-02-02")}),
state AS (
  SELECT CASE WHEN t.order_id IS NULL OR s.event_time >= t.event_time THEN s.event_date ELSE t.event_date END AS event_date,
         CASE WHEN t.order_id IS NULL OR s.event_time >= t.event_time THEN s.current_status ELSE t.current_status END
           AS current_status
  FROM tgt t FULL OUTER JOIN src s ON t.order_id = s.order_id
)
{_daily("SELECT * FROM state")}""",
    "ingest_nothing_new": f"""{_LOG}
SELECT topic, "partition", max("offset") + 1 AS next_offset, count(*) AS records, FALSE AS written_twice FROM log GROUP BY ALL""",
    "catalog_tables": f"""{_LOG}
SELECT order_date, total_orders, delivered_orders, 1 AS tables, TRUE AS all_columns FROM ({_daily(_STATE)})""",
    "sample_with_children": f"""WITH s AS (SELECT o_orderkey FROM ({_sample({"F": 500, "O": 70})})),
o AS (SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey IN (SELECT o_orderkey FROM s))
SELECT 'orders' AS part, count(*) AS rows, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM o
UNION ALL SELECT 'lines', count(*), CAST(sum(l_orderkey) AS BIGINT) FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM s)
UNION ALL SELECT 'customers', count(*), CAST(sum(c_custkey) AS BIGINT) FROM customer WHERE c_custkey IN (SELECT o_custkey FROM o)""",
    "profile_orders": f"""WITH {_WIDE}
SELECT 'category ' || order_status AS part, 'row_count' AS measure, count(*) AS value FROM wide WHERE order_status IS NOT NULL GROUP BY order_status
{" ".join(f"UNION ALL SELECT 'nulls', '{t}', count(*) FILTER (WHERE {t} IS NULL) FROM wide" for _, _, t in _STAGES)}
UNION ALL SELECT 'rows', 'row_count', count(*) FROM wide
UNION ALL SELECT 'keys', 'distinct_count', count(DISTINCT order_id) FROM wide""",
    "parse_with_pattern": "SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN date_trunc('second', ts) END AS event_time FROM events",
    "csv_roundtrip": f"WITH {_WIDE} SELECT * EXCLUDE (order_cancelled_at) FROM wide",
    "stream_to_bronze": f"""{_LOG}
SELECT event_id, order_id, event_type, "partition", "offset", ingestion_time AS ingestion_timestamp FROM log""",
    "stream_to_silver": f"""{_LOG}
SELECT order_id, event_type, event_time, event_type AS current_status, CAST(event_time AS DATE) AS event_date
FROM ({_latest('deduped')})""",
}

ORACLE["gold_by_changes"] = ORACLE["gold_table_refresh"].replace(
    _daily("SELECT * FROM state"),
    _daily("SELECT * FROM state WHERE NOT (event_date = DATE '2024-01-30' AND current_status = 'CANCELLED')"),
)

ORACLE["stream_latest_state"] = f"""{_LOG}
SELECT order_id, event_type, event_time, event_type AS current_status, CAST(event_time AS DATE) AS event_date,
       count(*) OVER () AS orders_held
FROM ({_latest('deduped')})"""
ORACLE["stream_events_once"] = f"WITH {_EVENTS} SELECT event_id, order_id, event_type FROM single"
ORACLE["stream_unguarded_repeat"] = ORACLE["merge_unconditional"]

ORACLE["audit_of_layers"] = f"""{_LOG},
state AS ({_STATE})
SELECT event_date AS day, count(*) AS raw_orders, count(*) AS state_orders, NOT bool_or(customer_id = '7') AS same_state, TRUE AS same_summary
FROM state GROUP BY event_date"""
ORACLE["fingerprints_of_days"] = f"""{_LOG},
state AS ({_STATE})
SELECT event_date AS day, count(*) AS left_rows, count(*) AS right_rows, TRUE AS same FROM state GROUP BY event_date"""
ORACLE["distinct_by_sketches"] = f"""{_LOG}
SELECT CAST(weekofyear(event_time) AS INTEGER) AS period, count(DISTINCT customer_id) AS customers, TRUE AS within_error FROM log GROUP BY 1"""
ORACLE["rejects_retried"] = f"""{_LOG},
usable AS (SELECT * FROM log WHERE CAST(event_id AS BIGINT) % 15 <> 7),
single_copy AS (SELECT * FROM usable QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY ingestion_time DESC, "offset" DESC) = 1)
SELECT order_id, event_id, event_type, event_time, event_type AS current_status, CAST(event_time AS DATE) AS event_date
FROM ({_latest('single_copy')})"""
ORACLE["checked_csv"] = """
SELECT part, count(*) AS rows, CAST(sum(key) AS BIGINT) AS keys FROM (
  SELECT CASE WHEN o_orderkey % 2 = 0 AND o_orderkey % 50 = 0 THEN 'fields: 1'
              WHEN o_orderkey % 53 = 1 THEN 'a value does not fit its type' ELSE o_orderstatus END AS part,
         CASE WHEN NOT (o_orderkey % 50 = 0) AND o_orderkey % 53 <> 1 THEN o_orderkey END AS key FROM orders) GROUP BY part"""

ORACLE["silver_catalog_table"] = f"{_LOG} SELECT *, TRUE AS properties_kept FROM ({_STATE})"

# An interrupted run leaves no trace once the next one has ended.
ORACLE["gold_after_interrupted_run"] = ORACLE["gold_table_refresh"]
