"""DuckDB statements for the queries about loading."""

from __future__ import annotations

from oracle.generators import Sql
from oracle.queries import EXTRACT_COLUMNS, METRICS_SQL, ORACLES, oracle
from oracle.tables import code

oracle(
    "links_any_keys",
    ("outage_raw", "outage_incident"),
    """
    SELECT link_id, outage_id, incident_ref
    FROM (SELECT row_number() OVER (ORDER BY outage_id) AS link_id, outage_id
          FROM (SELECT DISTINCT outage_id FROM outage_raw WHERE outage_id IS NOT NULL)) c
    JOIN (SELECT row_number() OVER (ORDER BY incident_ref) AS place, incident_ref
          FROM (SELECT DISTINCT incident_ref FROM outage_incident)) p
    ON p.place = 1 + (link_id - 1) % (SELECT count(DISTINCT incident_ref) FROM outage_incident)
    """,
)
PERFORMER = Sql(7, "incident_id").between("performer", 1, "(SELECT count(*) FROM named)")
oracle(
    "draws_any_keys",
    ("engineer", "outage_incident"),
    f"""
    , named AS (
        SELECT employee_no, row_number() OVER (ORDER BY employee_no) AS place
        FROM (SELECT DISTINCT employee_no FROM engineer)
    )
    SELECT incident_id, employee_no AS performed_by
    FROM (SELECT incident_id, {PERFORMER} AS spot FROM outage_incident)
    JOIN named ON place = spot
    """,
)
oracle(
    "numbered_codes",
    (),
    f"""
    SELECT event_id, {code("'EVT-'", "place")} AS event_code
    FROM (SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS place FROM events)
    """,
)

ORACLES["run_metrics"] = (
    ORACLES["extract_metrics"]
    + """
    UNION ALL
    SELECT 'outages', 'dates_unread', count(*) FROM outage_raw
    WHERE onset_dt IS NOT NULL AND try_cast(onset_dt AS timestamp) IS NULL
    """
)
oracle("published_logs", ("incident_logs",), "SELECT * FROM incident_logs")
oracle("published_events", ("extract_",), f"SELECT {EXTRACT_COLUMNS} FROM extract_")
oracle(
    "reports_one_scan",
    ("extract_",),
    f"""
    SELECT 'outages_by_province' AS report, province AS key, count(*) AS outages,
           round(avg(duration_min), 1) AS mean, cast(sum(customers_affected) AS double) AS total
    FROM extract_ GROUP BY province
    UNION ALL
    SELECT 'worst_outage_types', outage_type, count(*), round(avg(duration_min), 1),
           round(avg(customers_affected), 0)
    FROM extract_ GROUP BY outage_type
    UNION ALL
    SELECT 'escalation_rate_by_carrier', carrier, count(*),
           round(100.0::double * count(*) FILTER (is_escalation) / count(*), 1),
           cast(sum(cast(is_escalation AS integer)) AS double)
    FROM extract_ GROUP BY carrier
    UNION ALL
    SELECT 'monthly_trend', concat_ws('-', year, month), count(*), NULL,
           cast(sum(customers_affected) AS double)
    FROM extract_ GROUP BY year, month
    UNION ALL
    SELECT 'key_metrics', worst_province, total_outages, avg_duration_min, total_customers
    FROM ({METRICS_SQL})
    """,
)

OUTAGE = code("'OUT-'", "event_id + 1")
oracle(
    "dates_day_first",
    (),
    f"""
    SELECT outage_id, 'ON' AS province, onset_dt, year(onset_dt)::integer AS year,
           month(onset_dt)::integer AS month, dayname(onset_dt) AS weekday
    FROM (SELECT {OUTAGE} AS outage_id,
                 CASE WHEN event_id % 19 <> 3 THEN date_trunc('minute', ts) END AS onset_dt
          FROM events)
    """,
)
oracle(
    "csv_typed",
    (),
    f"""
    SELECT {OUTAGE} AS outage_id, CASE WHEN event_id % 7 <> 2 THEN 'ON' END AS province,
           CASE WHEN event_id % 4 = 0 THEN 15 + event_id % 400 + 0.5::double
                WHEN event_id % 31 <> 5 THEN 15 + event_id % 400 END AS duration_min,
           CASE WHEN event_id % 17 <> 4 THEN date_trunc('minute', ts) END AS onset_dt,
           CASE WHEN event_id % 29 <> 6 THEN event_id END AS customers_affected
    FROM events WHERE event_id % 101 <> 50
    """,
)
MINUTES = """CASE WHEN event_id % 4 = 0 THEN (15 + event_id % 400) || '.5'
                  WHEN event_id % 31 = 5 THEN 'two hours'
                  ELSE cast(15 + event_id % 400 AS varchar) END"""
oracle(
    "csv_rejects",
    (),
    f"""
    SELECT 'duration_min' AS "column", 'two hours' AS value, 'double' AS type, count(*) AS records
    FROM events WHERE event_id % 101 <> 50 AND event_id % 4 <> 0 AND event_id % 31 = 5
    UNION ALL
    SELECT 'onset_dt', 'soon', 'timestamp_ntz', count(*)
    FROM events WHERE event_id % 101 <> 50 AND event_id % 17 = 4
    UNION ALL
    SELECT 'customers_affected', '1e30', 'bigint', count(*)
    FROM events WHERE event_id % 101 <> 50 AND event_id % 29 = 6
    UNION ALL
    SELECT NULL, {OUTAGE} || ',' || CASE WHEN event_id % 7 = 2 THEN 'N/A' ELSE 'ON' END || ','
                 || {MINUTES}, 'record', 1
    FROM events WHERE event_id % 101 = 50
    """,
)

ORACLES["append_with_index"] = ORACLES["append_into_table"]
oracle(
    "key_lookup_indexed",
    ("outage_incident", "tower"),
    """
    SELECT tower_code, incident_ref, tower_id
    FROM outage_incident JOIN tower USING (tower_id)
    """,
)
