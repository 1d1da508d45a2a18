"""Word lists of the outage domain."""

# ---------------------------------------------------------------------------
# Names, categories and log templates of the domain.

PROVINCE_CODES = ["MB", "ON", "BC", "AB", "QC", "SK", "NS", "NB", "NL", "PE"]
CAUSES = [
    "Fibre cut",
    "Power failure",
    "Hardware fault",
    "Software bug",
    "Weather",
    "Planned maintenance",
]
CARRIER_NAMES = ["Rogers", "Bell", "Telus", "Shaw", "Videotron", "SaskTel"]
ISSUES = [
    "fibre cut on main trunk",
    "battery backup exhausted",
    "firmware update loop",
    "water ingress in cabinet",
    "power surge from lightning strike",
    "misconfigured routing table",
]
FIXES = [
    "spliced and re-buried fibre",
    "replaced UPS unit",
    "rolled back firmware",
    "sealed cabinet, replaced cards",
    "reset circuit breakers",
    "reverted routing config",
]
ROOT_CAUSES = ["fibre cut on main trunk", "power surge", "firmware loop", "water ingress"]

TECHNICIAN_LOG = (
    "Technician {name} attended site at {time}. Issue: {issue}. "
    "Resolution: {fix}. Customers restored after {mins} minutes."
)
ESCALATION_LOG = (
    "ESCALATION – {name} – outage ref {ref}. Root cause identified as "
    "{issue}. Crew dispatched. Full service restored at {time}."
)
ALERT_LOG = (
    "Automated alert triggered at {time}. {issue} detected on node "
    "{node}. On-call engineer {name} paged. Resolved in {mins} min."
)
FIELD_LOG = (
    "Field report by {name}: attended {city} exchange. {issue}. "
    "Temporary fix applied at {time}; permanent repair scheduled."
)
LOG_TEMPLATES = [TECHNICIAN_LOG, ESCALATION_LOG, ALERT_LOG, FIELD_LOG]

ROOT_CAUSE_NOTE = "Root cause: {cause}. Affected area: {city} exchange."
# ---------------------------------------------------------------------------

# Words for invented people, places and notes.
FIRST_NAMES = [
    "Amelia",
    "Benoit",
    "Chantal",
    "Devon",
    "Elise",
    "Farid",
    "Grace",
    "Hugo",
    "Imani",
    "Jonas",
    "Keiko",
    "Lucie",
]
LAST_NAMES = [
    "Archer",
    "Beaulieu",
    "Campbell",
    "Dubois",
    "Evans",
    "Fraser",
    "Gagnon",
    "Hughes",
    "Ivanov",
    "Joshi",
    "Kowalski",
]
CITIES = [
    "Brandon",
    "Calgary",
    "Corner Brook",
    "Halifax",
    "Kelowna",
    "Moncton",
    "Ottawa",
    "Quebec",
    "Regina",
    "Saskatoon",
]
NOTE_WORDS = [
    "cabinet",
    "checked",
    "fibre",
    "line",
    "node",
    "power",
    "restored",
    "router",
    "site",
    "tested",
    "unit",
    "verified",
    "with",
]
