"""DuckDB statements for the generators: the same hash draws, composed independently."""

from __future__ import annotations

from linewarden import vocabulary as words
from oracle.queries import oracle
from oracle.tables import code, one_of

SPECIALISATIONS = [
    "RF Optimisation",
    "Fibre Splicing",
    "Core Network",
    "Power Systems",
    "Software/Firmware",
    "Field Operations",
]
SITES = ["CELL_TOWER", "EXCHANGE", "DATA_CENTRE", "FIBRE_NODE"]


class Sql:
    """SQL of the draws for one seed and one id expression."""

    def __init__(self, seed: int, key: str):
        self.seed, self.key = seed, key

    def raw(self, label: str, digits: int = 8) -> str:
        text = f"md5('{self.seed}:{label}:' || cast({self.key} AS varchar))"
        return f"cast('0x' || substr({text}, 1, {digits}) AS bigint)"

    def between(self, label: str, low: int, high: int | str) -> str:
        digits = 15 if isinstance(high, str) else 8
        return f"({low} + {self.raw(label, digits)} % ({high} - {low} + 1))"

    def choice(self, label: str, values: list[str]) -> str:
        return one_of(values, f"({self.raw(label)} % {len(values)})")

    def chance(self, label: str, probability: float) -> str:
        return f"({self.raw(label)} / 4294967296 < {probability})"

    def coordinate(self, label: str, low: int, high: int) -> str:
        units = self.between(label, low * 1000000, high * 1000000)
        return f"cast(cast({units} / 1000000 AS decimal(9,6)) AS double)"

    def stamp(self, label: str) -> str:
        return (
            "(TIMESTAMP '2022-01-01' "
            f"+ {self.between(label + '/day', 0, 730)} * INTERVAL '1' DAY "
            f"+ {self.between(label + '/hour', 0, 23)} * INTERVAL '1' HOUR "
            f"+ {self.between(label + '/minute', 0, 59)} * INTERVAL '1' MINUTE)"
        )

    def duration(self) -> str:
        radius = f"(({self.raw('duration/radius')} + 1) / 4294967296.0::double)"
        angle = f"({self.raw('duration/angle')} / 4294967296.0::double)"
        normal = f"sqrt(-2 * ln({radius})) * cos(2 * pi() * {angle})"
        return f"greatest(15, cast(floor(exp(4.5::double + 1.2::double * {normal})) AS bigint))"

    def before(self, label: str, nearest: int, farthest: int) -> str:
        days = self.between(label, nearest, farthest)
        return f"cast(DATE '2025-01-01' - cast({days} AS int) AS date)"

    def person(self) -> str:
        first = self.choice("first", words.FIRST_NAMES)
        return f"{first} || ' ' || {self.choice('last', words.LAST_NAMES)}"


def two_digits(number: str) -> str:
    return f"lpad(cast({number} AS varchar), 2, '0')"


# --- outages and logs, one per event ---------------------------------------
d = Sql(42, "id")
oracle(
    "gen_outages",
    (),
    f"""
    SELECT {code("'OUT-'", "id")} AS outage_id, {d.choice('province', words.PROVINCE_CODES)}
               AS province,
           {d.choice('city', words.CITIES)} AS city, {d.choice('cause', words.CAUSES)}
               AS outage_type,
           {d.stamp('onset')} AS onset_dt, {d.duration()} AS duration_min,
           {d.between('customers', 50, 80000)} AS customers_affected,
           {d.choice('carrier', words.CARRIER_NAMES)} AS carrier
    FROM (SELECT event_id + 1 AS id FROM events)
    """,
)

d = Sql(42, "outage_id")
CLOCK = " || ':' || ".join(
    two_digits(d.between(f"time/{part}", 0, top))
    for part, top in (("hour", 23), ("minute", 59), ("second", 59))
)
ISSUE = d.choice("issue", words.ISSUES)
MINUTES = f"cast({d.between('minutes', 30, 480)} AS varchar)"
oracle(
    "gen_logs",
    (),
    f"""
    SELECT outage_id, CASE {d.raw('template')} % 4
        WHEN 0 THEN 'Technician ' || name || ' attended site at ' || clock || '. Issue: ' || issue
             || '. Resolution: ' || {d.choice('fix', words.FIXES)}
             || '. Customers restored after ' || {MINUTES} || ' minutes.'
        WHEN 1 THEN 'ESCALATION – ' || name || ' – outage ref ' || outage_id
             || '. Root cause identified as ' || issue
             || '. Crew dispatched. Full service restored at ' || clock || '.'
        WHEN 2 THEN 'Automated alert triggered at ' || clock || '. ' || issue
             || ' detected on node NODE-' || cast({d.between('node', 100, 999)} AS varchar)
             || '. On-call engineer ' || name || ' paged. Resolved in ' || {MINUTES} || ' min.'
        ELSE 'Field report by ' || name || ': attended ' || {d.choice('city', words.CITIES)}
             || ' exchange. ' || issue || '. Temporary fix applied at ' || clock
             || '; permanent repair scheduled.' END AS log_text
    FROM (SELECT outage_id, {d.person()} AS name, {CLOCK} AS clock, {ISSUE} AS issue
          FROM (SELECT {code("'OUT-'", "event_id + 1")} AS outage_id FROM events))
    """,
)

# --- towers and engineers ---------------------------------------------------
d = Sql(7, "id")
oracle(
    "gen_towers",
    (),
    f"""
    SELECT id AS tower_id,
           {code("province_code || '-' || left(site_type, 3) || '-'", "id")} AS tower_code,
           cast({d.between('carrier', 1, 6)} AS integer) AS carrier_id, site_type,
           {d.choice('city', words.CITIES)} AS city, province_code,
           {d.coordinate('latitude', 42, 60)} AS latitude,
           {d.coordinate('longitude', -140, -52)} AS longitude,
           {d.before('commissioned', 365, 5475)} AS commissioned_dt
    FROM (SELECT id, {d.choice('province', words.PROVINCE_CODES)} AS province_code,
                 {d.choice('site', SITES)} AS site_type
          FROM (SELECT s_suppkey + 1 AS id FROM supplier))
    """,
)
PHONE = (
    f"'+1 ' || {d.between('phone/0', 200, 999)} || '-' || {d.between('phone/1', 200, 999)} || '-' "
    f"|| {d.between('phone/2', 1000, 9999)} || ' ext ' || {d.between('phone/3', 1, 99999)}"
)
oracle(
    "gen_engineers",
    (),
    f"""
    SELECT id AS engineer_id, {code("'EMP-'", "id")} AS employee_no, full_name,
           lower(replace(full_name, ' ', '.')) || id || '@example.org' AS email,
           left({PHONE}, 20) AS phone,
           {d.choice('specialisation', SPECIALISATIONS)} AS specialisation,
           {d.choice('province', words.PROVINCE_CODES)} AS province_code,
           {d.before('hired', 183, 4380)} AS hire_date, {d.chance('oncall', 0.25)} AS is_oncall
    FROM (SELECT id, {d.person()} AS full_name
          FROM (SELECT c_custkey + 1 AS id FROM customer))
    """,
)

# --- incidents and what hangs on them ----------------------------------------
oracle(
    "gen_incidents",
    (),
    f"""
    SELECT id AS incident_id,
           {code("'INC-' || cast(year(reported_at) AS varchar) || '-'", "id")} AS incident_ref,
           {d.between('tower', 1, '(SELECT count(*) FROM supplier)')} AS tower_id,
           cast({d.between('cause', 1, 6)} AS integer) AS outage_type_id,
           CASE WHEN {d.raw('severity')} % 100 < 5 THEN 1
                WHEN {d.raw('severity')} % 100 < 25 THEN 2
                WHEN {d.raw('severity')} % 100 < 75 THEN 3 ELSE 4 END AS severity_id,
           reported_at, reported_at + duration_min * INTERVAL '1' MINUTE AS resolved_at,
           duration_min, {d.between('customers', 50, 80000)} AS customers_affected,
           {d.chance('escalated', 0.28)} AS is_escalated,
           'Root cause: ' || {d.choice('root_cause', words.ROOT_CAUSES)} || '. Affected area: '
               || {d.choice('city', words.CITIES)} || ' exchange.' AS root_cause_notes
    FROM (SELECT id, {d.stamp('reported')} AS reported_at,
                 cast({d.duration()} AS integer) AS duration_min
          FROM (SELECT o_orderkey + 1 AS id FROM orders))
    """,
)
ENGINEERS = "(SELECT count(*) FROM customer)"
pair = Sql(7, "(incident_id || '-' || engineer_id)")
oracle(
    "gen_assignments",
    (),
    f"""
    WITH seats AS (
        SELECT id AS incident_id, seat,
               CASE seat WHEN 0 THEN {d.between('seat/0', 1, ENGINEERS)}
                         WHEN 1 THEN {d.between('seat/1', 1, ENGINEERS)}
                         ELSE {d.between('seat/2', 1, ENGINEERS)} END AS engineer_id
        FROM (SELECT o_orderkey + 1 AS id FROM orders) CROSS JOIN range(3) AS r(seat)
        WHERE seat <= {d.between('support', 0, 2)}
    ), crew AS (
        SELECT incident_id, engineer_id, min(seat) AS first_seat FROM seats GROUP BY ALL
    ), ranked AS (
        SELECT *, row_number() OVER (PARTITION BY incident_id ORDER BY first_seat) AS place
        FROM crew
    )
    SELECT (incident_id - 1) * 3 + place AS assignment_id, incident_id, engineer_id,
           if(first_seat = 0, 'LEAD', 'SUPPORT') AS role, {pair.stamp('assigned')} AS assigned_at
    FROM ranked
    """,
)
SENTENCE = " || ' ' || ".join(d.choice(f"word/{i}", words.NOTE_WORDS) for i in range(8))
oracle(
    "gen_resolutions",
    (),
    f"""
    SELECT id AS log_id, id AS incident_id, cast({d.between('action', 1, 8)} AS integer)
               AS action_id,
           {d.between('performer', 1, ENGINEERS)} AS performed_by,
           {d.stamp('performed')} AS performed_at,
           upper(left(sentence, 1)) || substr(sentence, 2) || '.' AS notes
    FROM (SELECT id, {SENTENCE} AS sentence FROM (SELECT o_orderkey + 1 AS id FROM orders))
    """,
)
oracle(
    "gen_links",
    (),
    f"""
    SELECT event_id + 1 AS link_id, {code("'OUT-'", "event_id + 1")} AS outage_id,
           1 + event_id % (SELECT count(*) FROM orders) AS incident_id,
           TIMESTAMP '2025-01-01' AS linked_at, 'Linked from the outage extract' AS notes
    FROM events
    """,
)
