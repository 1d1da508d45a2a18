"""One DuckDB statement per registered query."""

from __future__ import annotations

from oracle.tables import with_tables

ORACLES: dict[str, str] = {}


def oracle(name: str, tables: tuple[str, ...], body: str) -> None:
    ORACLES[name] = with_tables(tables, body)


EXTRACT_COLUMNS = (
    "outage_id, province, city, outage_type, onset_dt, duration_min, customers_affected, carrier, "
    "year, month, weekday, log_text, engineer_name, log_duration_min, is_escalation"
)

oracle("parse_logs", ("parsed_logs",), "SELECT * FROM parsed_logs")
oracle("clean_outages", ("clean",), "SELECT * FROM clean")
oracle("build_extract", ("extract_",), f"SELECT {EXTRACT_COLUMNS} FROM extract_")

oracle(
    "outages_by_province",
    ("extract_",),
    """
    SELECT province, count(*) AS total_outages, round(avg(duration_min), 1) AS avg_duration_min,
           cast(sum(customers_affected) AS bigint) AS total_customers_hit
    FROM extract_ GROUP BY ALL
    """,
)
oracle(
    "worst_outage_types",
    ("extract_",),
    """
    SELECT outage_type, count(*) AS incidents, round(avg(duration_min), 1) AS avg_duration_min,
           round(avg(customers_affected), 0) AS avg_customers
    FROM extract_ GROUP BY ALL
    """,
)
oracle(
    "escalation_rate_by_carrier",
    ("extract_",),
    """
    SELECT carrier, count(*) AS total,
           cast(sum(cast(is_escalation AS integer)) AS bigint) AS escalations,
           round(100.0::double * sum(cast(is_escalation AS integer)) / count(*), 1)
               AS escalation_pct
    FROM extract_ GROUP BY carrier
    """,
)
oracle(
    "monthly_trend",
    ("extract_",),
    """
    SELECT year, month, count(*) AS outages,
           cast(sum(customers_affected) AS bigint) AS customers_affected
    FROM extract_ GROUP BY ALL
    """,
)
oracle(
    "top10_longest_outages",
    ("extract_",),
    """
    SELECT outage_id, province, carrier, outage_type, duration_min, customers_affected,
           engineer_name
    FROM extract_ ORDER BY duration_min DESC NULLS LAST, outage_id, engineer_name NULLS FIRST
    LIMIT 10
    """,
)

oracle(
    "incident_duration",
    ("outage_incident",),
    """
    SELECT incident_id, reported_at, resolved_at,
           cast(round((epoch(resolved_at) - epoch(reported_at)) / 60.0) AS integer)
               AS duration_min
    FROM (SELECT incident_id, reported_at,
                 resolved_at + (incident_id % 60) * INTERVAL '1' SECOND AS resolved_at
          FROM outage_incident)
    """,
)
oracle(
    "incidents_by_province",
    ("outage_incident", "tower"),
    """
    SELECT t.province_code, count(*) AS incidents,
           round(avg(i.duration_min), 1) AS avg_duration_min,
           cast(sum(i.customers_affected) AS bigint) AS customers_hit
    FROM outage_incident i JOIN tower t ON t.tower_id = i.tower_id
    GROUP BY t.province_code
    """,
)

WORKLOAD_TABLES = ("engineer", "incident_assignment", "outage_incident")
oracle(
    "engineer_workload_top10",
    WORKLOAD_TABLES,
    """
    SELECT full_name, specialisation, incidents, customers_handled
    FROM (SELECT e.engineer_id, e.full_name, e.specialisation, count(a.incident_id) AS incidents,
                 cast(sum(i.customers_affected) AS bigint) AS customers_handled
          FROM engineer e JOIN incident_assignment a ON a.engineer_id = e.engineer_id
          JOIN outage_incident i ON i.incident_id = a.incident_id
          GROUP BY ALL)
    ORDER BY incidents DESC, engineer_id LIMIT 10
    """,
)
oracle(
    "engineer_workload",
    WORKLOAD_TABLES,
    """
    SELECT e.employee_no, e.full_name, e.specialisation, count(a.incident_id) AS total_incidents,
           count(*) FILTER (a.role = 'LEAD') AS led_incidents,
           cast(sum(i.customers_affected) AS bigint) AS total_customers_handled,
           round(avg(i.duration_min), 1) AS avg_resolution_min
    FROM engineer e JOIN incident_assignment a ON a.engineer_id = e.engineer_id
    JOIN outage_incident i ON i.incident_id = a.incident_id
    GROUP BY e.engineer_id, e.employee_no, e.full_name, e.specialisation
    """,
)
for sla_name, label, total, where in (
    ("sla_compliance_all", "label", "total", ""),
    ("sla_compliance_resolved", "severity", "total_incidents", "WHERE i.resolved_at IS NOT NULL"),
):
    oracle(
        sla_name,
        ("outage_incident", "severity_"),
        f"""
        SELECT s.label AS {label}, s.sla_resolve_min, count(*) AS {total},
               count(*) FILTER (i.duration_min <= s.sla_resolve_min) AS within_sla,
               round(100.0::double * count(*) FILTER (i.duration_min <= s.sla_resolve_min)
                     / count(*), 1) AS sla_pct
        FROM outage_incident i JOIN severity_ s ON s.severity_id = i.severity_id {where}
        GROUP BY s.severity_id, s.label, s.sla_resolve_min
        """,
    )
oracle(
    "incident_summary",
    ("outage_incident", "tower", "carrier_", "outage_type_", "severity_"),
    """
    SELECT i.incident_ref, t.tower_code, t.city, t.province_code, c.carrier_name,
           o.type_code AS outage_type, s.label AS severity, i.reported_at, i.resolved_at,
           i.duration_min, i.customers_affected, i.is_escalated
    FROM outage_incident i JOIN tower t USING (tower_id) JOIN carrier_ c USING (carrier_id)
    JOIN outage_type_ o USING (outage_type_id) JOIN severity_ s USING (severity_id)
    """,
)
LINK_SQL = """
    SELECT l.outage_id, i.incident_ref, t.tower_code, t.city, o.type_code AS outage_type,
           i.duration_min, i.customers_affected
    FROM extract_link l JOIN outage_incident i USING (incident_id)
    JOIN tower t USING (tower_id) JOIN outage_type_ o USING (outage_type_id)
    """
LINK_TABLES = ("extract_link", "outage_incident", "tower", "outage_type_")
oracle("linked_incidents", LINK_TABLES, LINK_SQL)
oracle("extract_link_join", LINK_TABLES, LINK_SQL + "ORDER BY l.outage_id LIMIT 10")
oracle(
    "escalated_incidents", ("outage_incident",), "SELECT * FROM outage_incident WHERE is_escalated"
)

oracle(
    "panel_province",
    ("extract_",),
    "SELECT province, count(*) AS total_outages FROM extract_ GROUP BY province",
)
oracle(
    "panel_type_duration",
    ("extract_",),
    """
    SELECT *, avg_duration_min = max(avg_duration_min) OVER () AS is_max
    FROM (SELECT outage_type, round(avg(duration_min), 1) AS avg_duration_min
          FROM extract_ GROUP BY outage_type)
    """,
)
oracle(
    "panel_escalation",
    ("extract_",),
    """
    SELECT carrier, round(100.0::double * count(*) FILTER (is_escalation) / count(*), 1)
               AS escalation_pct
    FROM extract_ GROUP BY carrier
    """,
)
oracle(
    "panel_trend",
    ("extract_",),
    """
    SELECT strftime(make_date(year, month, 1), '%Y-%m') AS period, count(*) AS outages
    FROM extract_ GROUP BY year, month
    """,
)
METRICS_SQL = """
    SELECT (SELECT count(*) FROM extract_) AS total_outages,
           (SELECT cast(sum(customers_affected) AS bigint) FROM extract_) AS total_customers,
           (SELECT avg(m) FROM (SELECT round(avg(duration_min), 1) AS m
                                FROM extract_ GROUP BY outage_type)) AS avg_duration_min,
           (SELECT province FROM extract_ GROUP BY province
            ORDER BY count(*) DESC, province LIMIT 1) AS worst_province
    """
oracle("key_metrics", ("extract_",), METRICS_SQL)
oracle(
    "metric_cards",
    ("extract_",),
    f"""
    SELECT unnest(['Total outages', 'Customers affected', 'Avg duration',
                   'Most affected province']) AS label,
           unnest([format('{{:,}}', total_outages), format('{{:,}}', total_customers),
                   format('{{:.0f}} min', avg_duration_min), worst_province]) AS value
    FROM ({METRICS_SQL})
    """,
)


# Data-quality rules: one SELECT per rule, put together with UNION ALL.


def failing(table: str, rule: str, subject: str, condition: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, '{rule}' AS rule, '{subject}' AS subject, "
        f"count(*) AS violations FROM {table} WHERE {condition}"
    )


def null_rule(table: str, column: str) -> str:
    return failing(table, "not_null", column, f"{column} IS NULL")


def length_rule(table: str, column: str, limit: int) -> str:
    return failing(table, "length", column, f"length({column}) > {limit}")


def repeat_rule(table: str, rule: str, key: str) -> str:
    return (
        f"SELECT '{table}', '{rule}', '{key}', count(*) FROM (SELECT {key} FROM {table} "
        f"WHERE ({' AND '.join(c + ' IS NOT NULL' for c in key.split(', '))}) "
        f"GROUP BY {key} HAVING count(*) > 1)"
    )


def key_rules(table: str, key: str) -> list[str]:
    return [
        failing(table, "primary_key_null", key, f"{key} IS NULL"),
        repeat_rule(table, "primary_key_duplicate", key),
    ]


def parent_rule(table: str, column: str, parent: str, parent_column: str) -> str:
    return failing(
        table,
        "foreign_key",
        column,
        f"{column} IS NOT NULL AND NOT EXISTS "
        f"(SELECT 1 FROM {parent} p WHERE p.{parent_column} = {table}.{column})",
    )


def dq(name: str, tables: tuple[str, ...], rules: list[str]) -> None:
    body = "\nUNION ALL\n".join(rules)
    oracle(name, tables, f"SELECT * FROM ({body}) AS t(table_name, rule, subject, violations)")


NEGATIVE = "NOT (customers_affected >= 0)"
TOO_EARLY = "resolved_at IS NOT NULL AND NOT (resolved_at > reported_at)"
WRONG_DURATION = (
    "duration_min IS DISTINCT FROM "
    "cast(round((epoch(resolved_at) - epoch(reported_at)) / 60.0) AS integer)"
)
SITES = "('CELL_TOWER', 'EXCHANGE', 'DATA_CENTRE', 'FIBRE_NODE')"
ROLE_NAMES = "('LEAD', 'SUPPORT', 'ESCALATION')"

dq(
    "dq_primary_key",
    ("bad_incident", "resolution_log", "tower", "engineer"),
    key_rules("bad_incident", "incident_id")
    + key_rules("resolution_log", "log_id")
    + key_rules("tower", "tower_id")
    + key_rules("engineer", "engineer_id"),
)
dq(
    "dq_unique",
    ("bad_engineer", "tower", "outage_incident", "extract_link"),
    [
        repeat_rule("bad_engineer", "unique", "employee_no"),
        repeat_rule("bad_engineer", "unique", "email"),
        repeat_rule("tower", "unique", "tower_code"),
        repeat_rule("outage_incident", "unique", "incident_ref"),
        repeat_rule("extract_link", "unique", "outage_id"),
    ],
)
dq(
    "dq_composite_unique",
    ("bad_assignment", "resolution_log"),
    [
        repeat_rule("bad_assignment", "unique", "incident_id, engineer_id"),
        repeat_rule("resolution_log", "unique", "incident_id, action_id"),
    ],
)
dq(
    "dq_not_null",
    ("bad_incident", "bad_engineer", "bad_tower"),
    [
        null_rule("bad_incident", c)
        for c in ("incident_id", "tower_id", "severity_id", "reported_at", "customers_affected")
    ]
    + [null_rule("bad_engineer", c) for c in ("engineer_id", "employee_no", "full_name", "email")]
    + [null_rule("bad_tower", c) for c in ("tower_id", "site_type", "city")],
)
dq(
    "dq_foreign_key",
    (
        "bad_incident",
        "tower",
        "severity_",
        "bad_engineer",
        "province_",
        "incident_assignment",
        "engineer",
    ),
    [
        parent_rule("bad_incident", "tower_id", "tower", "tower_id"),
        parent_rule("bad_incident", "severity_id", "severity_", "severity_id"),
        parent_rule("bad_engineer", "province_code", "province_", "province_code"),
        parent_rule("incident_assignment", "incident_id", "bad_incident", "incident_id"),
        parent_rule("incident_assignment", "engineer_id", "engineer", "engineer_id"),
    ],
)
dq(
    "dq_domain",
    ("bad_tower", "bad_assignment"),
    [
        failing("bad_tower", "domain", "site_type", f"site_type NOT IN {SITES}"),
        failing("bad_assignment", "domain", "role", f"role NOT IN {ROLE_NAMES}"),
    ],
)
dq(
    "dq_range",
    ("bad_incident",),
    [failing("bad_incident", "check", "customers_not_negative", NEGATIVE)],
)
dq(
    "dq_temporal",
    ("bad_incident",),
    [failing("bad_incident", "check", "resolved_after_reported", TOO_EARLY)],
)
dq(
    "dq_length",
    ("bad_engineer",),
    [
        length_rule("bad_engineer", "employee_no", 20),
        length_rule("bad_engineer", "full_name", 120),
        length_rule("bad_engineer", "email", 150),
        length_rule("bad_engineer", "phone", 20),
    ],
)
dq(
    "dq_decimal",
    ("bad_tower",),
    [
        failing(
            "bad_tower", "decimal", c, f"{c} IS NOT NULL AND try_cast({c} AS decimal(9,6)) IS NULL"
        )
        for c in ("latitude", "longitude")
    ],
)
dq(
    "dq_derived",
    ("bad_incident",),
    [failing("bad_incident", "derived", "duration_min", WRONG_DURATION)],
)

# The lookup tables are literals that break no rule.
LOOKUP_RULES = {
    "province": {
        "not_null": ("province_code", "province_name"),
        "length": ("province_code", "province_name"),
        "primary_key_null": ("province_code",),
        "primary_key_duplicate": ("province_code",),
    },
    "outage_type": {
        "not_null": ("outage_type_id", "type_code"),
        "length": ("type_code",),
        "primary_key_null": ("outage_type_id",),
        "primary_key_duplicate": ("outage_type_id",),
        "unique": ("type_code",),
    },
    "severity_level": {
        "not_null": ("severity_id", "label", "sla_response_min", "sla_resolve_min"),
        "length": ("label",),
        "primary_key_null": ("severity_id",),
        "primary_key_duplicate": ("severity_id",),
        "unique": ("label",),
    },
    "resolution_action": {
        "not_null": ("action_id", "action_code"),
        "length": ("action_code",),
        "primary_key_null": ("action_id",),
        "primary_key_duplicate": ("action_id",),
        "unique": ("action_code",),
    },
    "carrier": {
        "not_null": ("carrier_id", "carrier_name"),
        "length": ("carrier_name", "ticker_symbol", "hq_province"),
        "primary_key_null": ("carrier_id",),
        "primary_key_duplicate": ("carrier_id",),
        "unique": ("carrier_name",),
        "foreign_key": ("hq_province",),
    },
}
dq(
    "dq_model",
    (
        "province_",
        "carrier_",
        "outage_type_",
        "severity_",
        "tower",
        "engineer",
        "outage_incident",
        "incident_assignment",
        "resolution_log",
        "extract_link",
    ),
    [
        f"SELECT '{table}', '{rule}', '{subject}', 0"
        for table, rules in LOOKUP_RULES.items()
        for rule, subjects in rules.items()
        for subject in subjects
    ]
    + [
        null_rule("tower", c)
        for c in ("tower_id", "tower_code", "carrier_id", "site_type", "city", "province_code")
    ]
    + [failing("tower", "domain", "site_type", f"site_type NOT IN {SITES}")]
    + [
        length_rule("tower", c, limit)
        for c, limit in (("tower_code", 20), ("site_type", 30), ("city", 100), ("province_code", 2))
    ]
    + key_rules("tower", "tower_id")
    + [
        repeat_rule("tower", "unique", "tower_code"),
        parent_rule("tower", "carrier_id", "carrier_", "carrier_id"),
        parent_rule("tower", "province_code", "province_", "province_code"),
    ]
    + [
        null_rule("engineer", c) for c in ("engineer_id", "employee_no", "full_name", "is_oncall")
    ]
    + [
        length_rule("engineer", c, limit)
        for c, limit in (
            ("employee_no", 20),
            ("full_name", 120),
            ("specialisation", 60),
            ("province_code", 2),
        )
    ]
    + key_rules("engineer", "engineer_id")
    + [
        repeat_rule("engineer", "unique", "employee_no"),
        parent_rule("engineer", "province_code", "province_", "province_code"),
    ]
    + [
        null_rule("outage_incident", c)
        for c in (
            "incident_id",
            "incident_ref",
            "tower_id",
            "outage_type_id",
            "severity_id",
            "reported_at",
            "customers_affected",
            "is_escalated",
        )
    ]
    + [
        failing("outage_incident", "check", "customers_not_negative", NEGATIVE),
        failing("outage_incident", "check", "resolved_after_reported", TOO_EARLY),
        length_rule("outage_incident", "incident_ref", 20),
        failing("outage_incident", "derived", "duration_min", WRONG_DURATION),
    ]
    + key_rules("outage_incident", "incident_id")
    + [
        repeat_rule("outage_incident", "unique", "incident_ref"),
        parent_rule("outage_incident", "tower_id", "tower", "tower_id"),
        parent_rule("outage_incident", "outage_type_id", "outage_type_", "outage_type_id"),
        parent_rule("outage_incident", "severity_id", "severity_", "severity_id"),
    ]
    + [null_rule("incident_assignment", c) for c in ("incident_id", "engineer_id", "role")]
    + [
        failing("incident_assignment", "domain", "role", f"role NOT IN {ROLE_NAMES}"),
        length_rule("incident_assignment", "role", 20),
        repeat_rule("incident_assignment", "unique", "incident_id, engineer_id"),
        parent_rule("incident_assignment", "incident_id", "outage_incident", "incident_id"),
        parent_rule("incident_assignment", "engineer_id", "engineer", "engineer_id"),
    ]
    + [
        null_rule("resolution_log", c)
        for c in ("log_id", "incident_id", "action_id", "performed_by", "performed_at")
    ]
    + key_rules("resolution_log", "log_id")
    + [
        repeat_rule("resolution_log", "unique", "incident_id, action_id"),
        parent_rule("resolution_log", "incident_id", "outage_incident", "incident_id"),
        failing("resolution_log", "foreign_key", "action_id", "action_id NOT BETWEEN 1 AND 8"),
        parent_rule("resolution_log", "performed_by", "engineer", "engineer_id"),
    ]
    + [
        null_rule("extract_link", "outage_id"),
        length_rule("extract_link", "outage_id", 20),
        repeat_rule("extract_link", "unique", "outage_id"),
        parent_rule("extract_link", "incident_id", "outage_incident", "incident_id"),
    ],
)
oracle(
    "dq_offending_rows",
    ("bad_incident",),
    "\nUNION ALL\n".join(
        f"SELECT *, '{rule}' AS rule, '{subject}' AS subject FROM bad_incident WHERE {condition}"
        for rule, subject, condition in [
            ("check", "customers_not_negative", NEGATIVE),
            ("check", "resolved_after_reported", TOO_EARLY),
            ("derived", "duration_min", WRONG_DURATION),
        ]
        + [
            ("not_null", c, f"{c} IS NULL")
            for c in ("incident_id", "tower_id", "severity_id", "reported_at", "customers_affected")
        ]
    ),
)
oracle(
    "dq_repeated_rows",
    ("bad_assignment",),
    """
    SELECT incident_id, engineer_id, role, assigned_at
    FROM (SELECT *, count(*) OVER (PARTITION BY incident_id, engineer_id) AS held_by
          FROM bad_assignment)
    WHERE held_by > 1
    """,
)
oracle(
    "dq_orphan_rows",
    ("bad_incident", "tower"),
    """
    SELECT b.* FROM bad_incident b LEFT JOIN tower t ON t.tower_id = b.tower_id
    WHERE b.tower_id IS NOT NULL AND t.tower_id IS NULL
    """,
)
oracle(
    "extract_metrics",
    ("outage_raw", "incident_logs", "extract_"),
    """
    SELECT 'outages' AS step, 'rows_loaded' AS metric, count(*) AS value FROM outage_raw
    UNION ALL
    SELECT 'outages', 'rows_dropped', count(*) FROM outage_raw
    WHERE outage_id IS NULL OR province IS NULL
    UNION ALL SELECT 'logs', 'rows_loaded', count(*) FROM incident_logs
    UNION ALL
    SELECT 'logs', 'escalations_flagged', count(*) FROM incident_logs
    WHERE regexp_matches(log_text, 'escalat', 'i')
    UNION ALL SELECT 'extract', 'rows', count(*) FROM extract_
    UNION ALL SELECT 'extract', 'columns', 15
    """,
)
oracle(
    "table_row_counts",
    (
        "tower",
        "engineer",
        "outage_incident",
        "incident_assignment",
        "resolution_log",
        "extract_link",
    ),
    "SELECT 'province' AS name, 13 AS row_count UNION ALL SELECT 'outage_type', 6 "
    "UNION ALL SELECT 'severity_level', 4 UNION ALL SELECT 'resolution_action', 8 "
    "UNION ALL SELECT 'carrier', 6 UNION ALL "
    + " UNION ALL ".join(
        f"SELECT '{t}', count(*) FROM {t}"
        for t in (
            "tower",
            "engineer",
            "outage_incident",
            "incident_assignment",
            "resolution_log",
            "extract_link",
        )
    ),
)

oracle(
    "csv_source",
    ("outage_raw",),
    "SELECT * REPLACE (try_cast(onset_dt AS timestamp) AS onset_dt) FROM outage_raw",
)
oracle("source_fallback", ("outage_raw",), "SELECT *, 'fallback' AS source FROM outage_raw")
oracle("table_round_trip", ("extract_",), f"SELECT {EXTRACT_COLUMNS} FROM extract_")
oracle(
    "incident_layout",
    ("outage_incident",),
    """
    SELECT *, cast(year(reported_at) AS integer) AS reported_year,
           cast(month(reported_at) AS integer) AS reported_month
    FROM outage_incident
    """,
)
oracle(
    "named_views",
    (*WORKLOAD_TABLES, "severity_", "tower", "carrier_", "outage_type_"),
    """
    SELECT 'v_incident_summary' AS view_name,
           concat_ws('|', i.incident_ref, t.tower_code, t.city, t.province_code, c.carrier_name,
                     o.type_code, s.label, i.duration_min, i.customers_affected) AS content
    FROM outage_incident i JOIN tower t USING (tower_id) JOIN carrier_ c USING (carrier_id)
    JOIN outage_type_ o USING (outage_type_id) JOIN severity_ s USING (severity_id)
    UNION ALL
    SELECT 'v_engineer_workload',
           concat_ws('|', e.employee_no, count(*), count(*) FILTER (a.role = 'LEAD'),
                     cast(sum(i.customers_affected) AS bigint))
    FROM engineer e JOIN incident_assignment a USING (engineer_id)
    JOIN outage_incident i USING (incident_id) GROUP BY e.engineer_id, e.employee_no
    UNION ALL
    SELECT 'v_sla_compliance',
           concat_ws('|', s.label, s.sla_resolve_min, count(*),
                     count(*) FILTER (i.duration_min <= s.sla_resolve_min))
    FROM outage_incident i JOIN severity_ s USING (severity_id)
    WHERE i.resolved_at IS NOT NULL GROUP BY s.label, s.sla_resolve_min
    UNION ALL
    SELECT 'v_escalated_incidents', concat_ws('|', incident_id, tower_id, severity_id)
    FROM outage_incident WHERE is_escalated
    """,
)
# The lookup rows, written out a second time.
LOOKUP_CONTENT = {
    "province": (
        "AB|Alberta", "BC|British Columbia", "MB|Manitoba", "NB|New Brunswick",
        "NL|Newfoundland and Labrador", "NS|Nova Scotia", "NT|Northwest Territories",
        "NU|Nunavut", "ON|Ontario", "PE|Prince Edward Island", "QC|Quebec", "SK|Saskatchewan",
        "YT|Yukon",
    ),
    "outage_type": (
        "1|FIBRE_CUT|Physical severance of fibre optic cable",
        "2|POWER_FAIL|Loss of commercial power / generator failure",
        "3|HW_FAULT|Hardware component failure at site or node",
        "4|SW_BUG|Software defect or failed firmware update",
        "5|WEATHER|Storm, flood, ice, or lightning damage",
        "6|PLANNED_MAINT|Scheduled maintenance window",
    ),
    "severity_level": (
        "1|P1 – Critical|15|240", "2|P2 – High|30|480", "3|P3 – Medium|60|1440",
        "4|P4 – Low|240|4320",
    ),
    "resolution_action": (
        "1|FIBRE_SPLICE|Spliced and re-buried severed fibre",
        "2|UPS_REPLACE|Replaced uninterruptible power supply unit",
        "3|FW_ROLLBACK|Rolled back to previous stable firmware",
        "4|HW_SWAP|Swapped failed hardware component",
        "5|CONFIG_REVERT|Reverted misconfigured routing or switch config",
        "6|CABINET_SEAL|Sealed cabinet and replaced water-damaged cards",
        "7|GENERATOR_START|Started backup generator, restored commercial power",
        "8|REMOTE_RESET|Performed remote equipment reset",
    ),
    "carrier": (
        "1|Rogers|RCI|ON", "2|Bell|BCE|QC", "3|Telus|T|BC", "4|Shaw|SJR|AB",
        "5|Videotron|QBR|QC", "6|SaskTel|-|SK",
    ),
}
LOOKUP_VALUES = ", ".join(
    f"('{name}', '{content}')" for name, rows in LOOKUP_CONTENT.items() for content in rows
)
oracle(
    "lookup_rows",
    ("outage_incident",),
    f"""
    SELECT lookup, content,
           CASE lookup
           WHEN 'outage_type' THEN (SELECT count(*) FROM outage_incident
                                    WHERE outage_type_id = try_cast(key AS integer))
           WHEN 'severity_level' THEN (SELECT count(*) FROM outage_incident
                                       WHERE severity_id = try_cast(key AS integer))
           ELSE 0 END AS incidents
    FROM (SELECT *, split_part(content, '|', 1) AS key
          FROM (VALUES {LOOKUP_VALUES}) AS t(lookup, content))
    """,
)
oracle(
    "optional_columns",
    ("outage_raw",),
    """
    SELECT outage_id, upper(trim(province)) AS province, city, outage_type, customers_affected,
           carrier
    FROM outage_raw WHERE outage_id IS NOT NULL AND province IS NOT NULL
    """,
)


def places(report: str, row: str, order: str, group: str, measures: str) -> str:
    return (
        f"SELECT '{report}' AS report, {row} AS row, row_number() OVER (ORDER BY {order}) AS place "
        f"FROM (SELECT {group}, {measures} FROM extract_ GROUP BY {group})"
    )


MEAN = "round(avg(duration_min), 1) AS mean"
RATE = "round(100.0::double * sum(cast(is_escalation AS integer)) / count(*), 1) AS rate"
oracle(
    "report_order",
    ("extract_",),
    " UNION ALL ".join(
        [
            places("outages_by_province", "province", "n DESC, province", "province", "count(*) n"),
            places("worst_outage_types", "outage_type", "mean DESC NULLS LAST, outage_type",
                   "outage_type", MEAN),
            places("escalation_rate_by_carrier", "carrier", "rate DESC NULLS LAST, carrier",
                   "carrier", RATE),
            places("monthly_trend", "concat_ws('-', year, month)",
                   "year NULLS LAST, month NULLS LAST", "year, month", "count(*) n"),
            places("panel_province", "province", "n, province DESC", "province", "count(*) n"),
            places("panel_type_duration", "outage_type", "mean NULLS FIRST, outage_type DESC",
                   "outage_type", MEAN),
            places("panel_escalation", "carrier", "rate NULLS FIRST, carrier DESC", "carrier",
                   RATE),
            places("panel_trend",
                   "coalesce(year || '-' || lpad(cast(month AS varchar), 2, '0'), '')",
                   "year NULLS LAST, month NULLS LAST", "year, month", "count(*) n"),
        ]
    ),
)
# A row is refused without a name or address, or for a number or address the row before it was stored with.
oracle(
    "append_into_table",
    ("bad_engineer",),
    """
    SELECT engineer_id, employee_no, full_name, email, false AS is_oncall
    FROM (SELECT *, lag(employee_no) OVER w AS last_no, lag(email) OVER w AS last_email,
                 lag(full_name) OVER w AS last_name
          FROM bad_engineer WINDOW w AS (ORDER BY engineer_id))
    WHERE full_name IS NOT NULL AND email IS NOT NULL
      AND NOT coalesce(last_name IS NOT NULL AND last_email IS NOT NULL
                       AND (employee_no = last_no OR email = last_email), false)
    """,
)
oracle(
    "csv_dirty_source",
    (),
    """
    SELECT 'OUT-' || CASE WHEN event_id + 1 < 1000
                          THEN lpad(cast(event_id + 1 AS varchar), 4, '0')
                          ELSE cast(event_id + 1 AS varchar) END AS outage_id,
           CASE WHEN event_id % 7 <> 2 THEN 'ON' END AS province,
           'said "no", event ' || cast(event_id AS varchar) AS remark,
           CASE event_id % 4 WHEN 1 THEN 16 + event_id % 400 WHEN 2 THEN NULL
                ELSE 15 + event_id % 400 END AS duration_min,
           CASE event_id % 3 WHEN 0 THEN date_trunc('minute', ts)
                WHEN 1 THEN date_trunc('second', ts) - INTERVAL '5' HOUR END AS onset_dt
    FROM events
    """,
)
oracle(
    "insert_ignore",
    (),
    """
    SELECT incident_id, engineer_id, role, assigned_at, batch, line
    FROM (
        SELECT *, row_number() OVER (PARTITION BY incident_id, engineer_id
                                     ORDER BY if(batch = 'F', 0, 1), line, role, assigned_at)
                      AS turn
        FROM (
            SELECT l_orderkey + 1 AS incident_id,
                   1 + l_partkey % (SELECT count(*) FROM customer) AS engineer_id,
                   if(l_linenumber = 1, 'LEAD', 'SUPPORT') AS role,
                   l_shipdate AS assigned_at, l_linestatus AS batch, l_linenumber AS line
            FROM lineitem))
    WHERE turn = 1
    """,
)
# One insert after the other, for all incidents side by side: a step takes each incident's
# next row and keeps it if neither its id nor its action was kept before. Both keys
# contain the incident, so incidents never clash with each other.
oracle(
    "insert_ignore_two_keys",
    (),
    """
    WITH RECURSIVE turns AS (
        SELECT *, row_number() OVER (PARTITION BY incident_id ORDER BY
                                     performed_at, log_id, action_id, performed_by) AS turn
        FROM (
            SELECT l_linenumber + 1048576 * (l_orderkey + 1) AS log_id, l_orderkey + 1 AS incident_id,
                   cast(1 + l_partkey % 8 AS integer) AS action_id,
                   1 + l_suppkey % (SELECT count(*) FROM customer) AS performed_by,
                   l_shipdate AS performed_at
            FROM lineitem)
    ), steps AS (
        SELECT *, [log_id] AS used_ids, [action_id] AS used_actions, true AS kept
        FROM turns WHERE turn = 1
        UNION ALL
        SELECT t.*,
               if(list_contains(s.used_ids, t.log_id)
                  OR list_contains(s.used_actions, t.action_id),
                  s.used_ids, list_append(s.used_ids, t.log_id)),
               if(list_contains(s.used_ids, t.log_id)
                  OR list_contains(s.used_actions, t.action_id),
                  s.used_actions, list_append(s.used_actions, t.action_id)),
               NOT (list_contains(s.used_ids, t.log_id)
                    OR list_contains(s.used_actions, t.action_id))
        FROM steps s JOIN turns t ON t.incident_id = s.incident_id AND t.turn = s.turn + 1
    )
    SELECT log_id, incident_id, action_id, performed_by, performed_at FROM steps WHERE kept
    """,
)
oracle(
    "key_lookup",
    ("outage_incident", "tower"),
    """
    SELECT incident_ref, asked AS tower_code, t.tower_id
    FROM (SELECT i.incident_ref,
                 CASE WHEN i.incident_id % 23 = 7 THEN 'NO-' || t.tower_code
                      ELSE t.tower_code END AS asked
          FROM outage_incident i JOIN tower t ON t.tower_id = i.tower_id)
    LEFT JOIN tower t ON t.tower_code = asked
    """,
)
oracle(
    "default_columns",
    ("outage_incident",),
    """
    SELECT incident_id, incident_ref, tower_id, outage_type_id, severity_id, reported_at,
           resolved_at, duration_min, cast(0 AS bigint) AS customers_affected,
           false AS is_escalated, cast(NULL AS varchar) AS root_cause_notes, true AS created_at
    FROM outage_incident
    """,
)
