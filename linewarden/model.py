"""The relational model: table schemas, keys, rules and fixed lookup rows.

Spark keeps no primary keys or CHECKs for parquet tables, so the rules are
declared here and checked as jobs by ``operators.quality``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column as ColumnExpr
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linewarden.functions.times import minutes_between

STRING = T.StringType()
LONG = T.LongType()
INT = T.IntegerType()
BOOLEAN = T.BooleanType()
DATE = T.DateType()
TIMESTAMP = T.TimestampNTZType()
COORDINATE = T.DecimalType(9, 6)

NOW = "localtimestamp()"


@dataclass(frozen=True)
class Column:
    """One column: ``default`` is a SQL expression for rows that lack the column."""

    name: str
    type: T.DataType
    required: bool = False
    max_length: int | None = None
    default: str | None = None

    @property
    def ddl(self) -> str:
        type_text = f"VARCHAR({self.max_length})" if self.max_length else self.type.simpleString()
        not_null = " NOT NULL" if self.required else ""
        default = f" DEFAULT {self.default}" if self.default else ""
        return f"{self.name} {type_text}{not_null}{default}"


@dataclass(frozen=True)
class Table:
    """A table with its declared rules.

    ``unique`` lists the unique keys besides the primary key, ``references`` maps a
    column to (parent table, parent column), ``domains`` a column to its allowed
    values, ``checks`` a rule name to a SQL condition, ``derived`` a column to the
    expression it must equal.
    """

    name: str
    columns: tuple[Column, ...]
    primary_key: str
    unique: tuple[tuple[str, ...], ...] = ()
    references: dict[str, tuple[str, str]] = field(default_factory=dict)
    domains: dict[str, tuple[str, ...]] = field(default_factory=dict)
    checks: dict[str, str] = field(default_factory=dict)
    derived: dict[str, Callable[[], ColumnExpr]] = field(default_factory=dict)

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.type) for c in self.columns])

    @property
    def required(self) -> list[str]:
        return [c.name for c in self.columns if c.required]

    @property
    def lengths(self) -> dict[str, int]:
        return {c.name: c.max_length for c in self.columns if c.max_length}

    @property
    def unique_keys(self) -> list[tuple[str, ...]]:
        return [(self.primary_key,), *self.unique]

    @property
    def ddl(self) -> str:
        return ", ".join(c.ddl for c in self.columns)


# ---------------------------------------------------------------------------
# Lookup rows and allowed values of the model.

PROVINCES = [
    ("AB", "Alberta"),
    ("BC", "British Columbia"),
    ("MB", "Manitoba"),
    ("NB", "New Brunswick"),
    ("NL", "Newfoundland and Labrador"),
    ("NS", "Nova Scotia"),
    ("NT", "Northwest Territories"),
    ("NU", "Nunavut"),
    ("ON", "Ontario"),
    ("PE", "Prince Edward Island"),
    ("QC", "Quebec"),
    ("SK", "Saskatchewan"),
    ("YT", "Yukon"),
]
OUTAGE_TYPES = [
    (1, "FIBRE_CUT", "Physical severance of fibre optic cable"),
    (2, "POWER_FAIL", "Loss of commercial power / generator failure"),
    (3, "HW_FAULT", "Hardware component failure at site or node"),
    (4, "SW_BUG", "Software defect or failed firmware update"),
    (5, "WEATHER", "Storm, flood, ice, or lightning damage"),
    (6, "PLANNED_MAINT", "Scheduled maintenance window"),
]
SEVERITIES = [
    (1, "P1 – Critical", 15, 240),
    (2, "P2 – High", 30, 480),
    (3, "P3 – Medium", 60, 1440),
    (4, "P4 – Low", 240, 4320),
]
RESOLUTION_ACTIONS = [
    (1, "FIBRE_SPLICE", "Spliced and re-buried severed fibre"),
    (2, "UPS_REPLACE", "Replaced uninterruptible power supply unit"),
    (3, "FW_ROLLBACK", "Rolled back to previous stable firmware"),
    (4, "HW_SWAP", "Swapped failed hardware component"),
    (5, "CONFIG_REVERT", "Reverted misconfigured routing or switch config"),
    (6, "CABINET_SEAL", "Sealed cabinet and replaced water-damaged cards"),
    (7, "GENERATOR_START", "Started backup generator, restored commercial power"),
    (8, "REMOTE_RESET", "Performed remote equipment reset"),
]
CARRIERS = [
    (1, "Rogers", "RCI", "ON"),
    (2, "Bell", "BCE", "QC"),
    (3, "Telus", "T", "BC"),
    (4, "Shaw", "SJR", "AB"),
    (5, "Videotron", "QBR", "QC"),
    (6, "SaskTel", None, "SK"),
]
SITE_TYPES = ("CELL_TOWER", "EXCHANGE", "DATA_CENTRE", "FIBRE_NODE")
ROLES = ("LEAD", "SUPPORT", "ESCALATION")
SPECIALISATIONS = (
    "RF Optimisation",
    "Fibre Splicing",
    "Core Network",
    "Power Systems",
    "Software/Firmware",
    "Field Operations",
)
# ---------------------------------------------------------------------------

CREATED_AT = Column("created_at", TIMESTAMP, required=True, default=NOW)

OUTAGE_RECORDS = T.StructType(
    [
        T.StructField("outage_id", STRING),
        T.StructField("province", STRING),
        T.StructField("city", STRING),
        T.StructField("outage_type", STRING),
        T.StructField("onset_dt", TIMESTAMP),
        T.StructField("duration_min", LONG),
        T.StructField("customers_affected", LONG),
        T.StructField("carrier", STRING),
    ]
)

PROVINCE = Table(
    "province",
    (
        Column("province_code", STRING, required=True, max_length=2),
        Column("province_name", STRING, required=True, max_length=60),
    ),
    primary_key="province_code",
)

OUTAGE_TYPE = Table(
    "outage_type",
    (
        Column("outage_type_id", INT, required=True),
        Column("type_code", STRING, required=True, max_length=30),
        Column("description", STRING),
    ),
    primary_key="outage_type_id",
    unique=(("type_code",),),
)

SEVERITY_LEVEL = Table(
    "severity_level",
    (
        Column("severity_id", INT, required=True),
        Column("label", STRING, required=True, max_length=20),
        Column("sla_response_min", INT, required=True),
        Column("sla_resolve_min", INT, required=True),
    ),
    primary_key="severity_id",
    unique=(("label",),),
)

RESOLUTION_ACTION = Table(
    "resolution_action",
    (
        Column("action_id", INT, required=True),
        Column("action_code", STRING, required=True, max_length=40),
        Column("description", STRING),
    ),
    primary_key="action_id",
    unique=(("action_code",),),
)

CARRIER = Table(
    "carrier",
    (
        Column("carrier_id", INT, required=True),
        Column("carrier_name", STRING, required=True, max_length=100),
        Column("ticker_symbol", STRING, max_length=6),
        Column("hq_province", STRING, max_length=2),
        CREATED_AT,
    ),
    primary_key="carrier_id",
    unique=(("carrier_name",),),
    references={"hq_province": ("province", "province_code")},
)

TOWER = Table(
    "tower",
    (
        Column("tower_id", LONG, required=True),
        Column("tower_code", STRING, required=True, max_length=20),
        Column("carrier_id", INT, required=True),
        Column("site_type", STRING, required=True, max_length=30),
        Column("city", STRING, required=True, max_length=100),
        Column("province_code", STRING, required=True, max_length=2),
        Column("latitude", COORDINATE),
        Column("longitude", COORDINATE),
        Column("commissioned_dt", DATE),
        Column("is_active", BOOLEAN, required=True, default="true"),
        CREATED_AT,
    ),
    primary_key="tower_id",
    unique=(("tower_code",),),
    references={
        "carrier_id": ("carrier", "carrier_id"),
        "province_code": ("province", "province_code"),
    },
    domains={"site_type": SITE_TYPES},
)

ENGINEER = Table(
    "engineer",
    (
        Column("engineer_id", LONG, required=True),
        Column("employee_no", STRING, required=True, max_length=20),
        Column("full_name", STRING, required=True, max_length=120),
        Column("email", STRING, required=True, max_length=150),
        Column("phone", STRING, max_length=20),
        Column("specialisation", STRING, max_length=60),
        Column("province_code", STRING, max_length=2),
        Column("hire_date", DATE),
        Column("is_oncall", BOOLEAN, required=True, default="false"),
        CREATED_AT,
    ),
    primary_key="engineer_id",
    unique=(("employee_no",), ("email",)),
    references={"province_code": ("province", "province_code")},
)

OUTAGE_INCIDENT = Table(
    "outage_incident",
    (
        Column("incident_id", LONG, required=True),
        Column("incident_ref", STRING, required=True, max_length=20),
        Column("tower_id", LONG, required=True),
        Column("outage_type_id", INT, required=True),
        Column("severity_id", INT, required=True),
        Column("reported_at", TIMESTAMP, required=True),
        Column("resolved_at", TIMESTAMP),
        Column("duration_min", INT),
        Column("customers_affected", LONG, required=True, default="0"),
        Column("is_escalated", BOOLEAN, required=True, default="false"),
        Column("root_cause_notes", STRING),
        CREATED_AT,
    ),
    primary_key="incident_id",
    unique=(("incident_ref",),),
    references={
        "tower_id": ("tower", "tower_id"),
        "outage_type_id": ("outage_type", "outage_type_id"),
        "severity_id": ("severity_level", "severity_id"),
    },
    checks={
        "customers_not_negative": "customers_affected >= 0",
        "resolved_after_reported": "resolved_at IS NULL OR resolved_at > reported_at",
    },
    derived={
        "duration_min": lambda: minutes_between(F.col("reported_at"), F.col("resolved_at")),
    },
)

INCIDENT_ASSIGNMENT = Table(
    "incident_assignment",
    (
        Column("assignment_id", LONG, required=True),
        Column("incident_id", LONG, required=True),
        Column("engineer_id", LONG, required=True),
        Column("role", STRING, required=True, max_length=20),
        Column("assigned_at", TIMESTAMP, required=True, default=NOW),
        Column("released_at", TIMESTAMP),
    ),
    primary_key="assignment_id",
    unique=(("incident_id", "engineer_id"),),
    references={
        "incident_id": ("outage_incident", "incident_id"),
        "engineer_id": ("engineer", "engineer_id"),
    },
    domains={"role": ROLES},
)

RESOLUTION_LOG = Table(
    "resolution_log",
    (
        Column("log_id", LONG, required=True),
        Column("incident_id", LONG, required=True),
        Column("action_id", INT, required=True),
        Column("performed_by", LONG, required=True),
        Column("performed_at", TIMESTAMP, required=True, default=NOW),
        Column("notes", STRING),
    ),
    primary_key="log_id",
    unique=(("incident_id", "action_id"),),
    references={
        "incident_id": ("outage_incident", "incident_id"),
        "action_id": ("resolution_action", "action_id"),
        "performed_by": ("engineer", "engineer_id"),
    },
)

EXTRACT_LINK = Table(
    "extract_link",
    (
        Column("link_id", LONG, required=True),
        Column("outage_id", STRING, required=True, max_length=20),
        Column("incident_id", LONG),
        Column("linked_at", TIMESTAMP, required=True, default=NOW),
        Column("notes", STRING),
    ),
    primary_key="link_id",
    unique=(("outage_id",),),
    references={"incident_id": ("outage_incident", "incident_id")},
)

# Parents before children.
TABLES = {
    t.name: t
    for t in (
        PROVINCE,
        OUTAGE_TYPE,
        SEVERITY_LEVEL,
        RESOLUTION_ACTION,
        CARRIER,
        TOWER,
        ENGINEER,
        OUTAGE_INCIDENT,
        INCIDENT_ASSIGNMENT,
        RESOLUTION_LOG,
        EXTRACT_LINK,
    )
}

_LOOKUP_ROWS = {
    "province": PROVINCES,
    "outage_type": OUTAGE_TYPES,
    "severity_level": SEVERITIES,
    "resolution_action": RESOLUTION_ACTIONS,
    "carrier": CARRIERS,
}

# Tables whose rows are the literals above: the only ones that are always safe to broadcast.
LOOKUPS = tuple(_LOOKUP_ROWS)


def lookup_keys(name: str) -> list[int | str]:
    """The primary keys of a lookup table."""
    return [row[0] for row in _LOOKUP_ROWS[name]]


def lookup(spark: SparkSession, name: str) -> DataFrame:
    """A lookup table as a local relation."""
    names = [c.name for c in TABLES[name].columns][: len(_LOOKUP_ROWS[name][0])]
    schema = T.StructType([f for f in TABLES[name].schema.fields if f.name in names])
    rows = [dict(zip(names, row)) for row in _LOOKUP_ROWS[name]]
    return spark.createDataFrame(pa.Table.from_pylist(rows), schema=schema)
