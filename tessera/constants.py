"""Fixed values.

Everything below must equal the values of the system this engine re-implements,
or results differ: enumerations, allow-lists, weights, thresholds, patterns and
formats.  They are stated plainly, in their natural order, in one place.
"""

# ---------------------------------------------------------------------------
# FIXED VALUES - enumerations of the data model
# ---------------------------------------------------------------------------
ENROLLMENT_STATES = ["anonymous", "inquiry", "application", "enrollment", "active", "alumni", "churned"]
IDENTIFIER_TYPES = ["email", "phone", "device_id", "session_id", "salesforce_id"]
EVENT_SOURCES = ["website", "app", "crm", "email", "whatsapp"]

# ---------------------------------------------------------------------------
# FIXED VALUES - ingestion
# ---------------------------------------------------------------------------
MOBILE_EVENT_TYPES = [
    "app_opened",
    "lesson_completed",
    "quiz_taken",
    "push_clicked",
    "course_downloaded",
    "study_session_started",
    "study_session_ended",
    "notification_received",
]
EMAIL_EVENT_TYPES = ["email_opened", "email_clicked", "email_bounced", "email_unsubscribed"]
MACHINE_OPEN_MARKERS = ["apple", "cfnetwork"]

# Named zone suffixes replaced by fixed offsets (plain substring replace, in this order).
TZ_OFFSETS = [("CET", "+01:00"), ("CEST", "+02:00"), ("EST", "-05:00"), ("PST", "-08:00"), ("IST", "+05:30")]

# Intent patterns, tried in order; first hit wins, else "general_message".
INTENT_PATTERNS = [
    ("enrollment_inquiry", r"\b(enroll|admission|apply|register)\b"),
    ("program_inquiry", r"\b(program|course|degree|master|bachelor)\b"),
    ("fee_inquiry", r"\b(fee|cost|price|tuition|payment)\b"),
    ("support_request", r"\b(help|support|problem|issue|error)\b"),
    ("schedule_inquiry", r"\b(schedule|deadline|start date|when)\b"),
]
DEFAULT_INTENT = "general_message"

# Entity patterns for chat text (email, phone, programme name; the last one case-insensitive).
ENTITY_PATTERNS = [
    ("email", r"[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z0-9-.]+", False),
    ("phone", r"\+?\d[\d\s\-()]{7,15}", False),
    ("program_name", r"\b(?:B\.?Sc|M\.?Sc|MBA|B\.?A|M\.?A)\b\.?\s*\w*", True),
]

# CRM field renames; other columns keep their value under an "sf_" prefix, "attributes" is dropped.
SF_FIELD_MAP = [
    ("Id", "salesforce_id"),
    ("FirstName", "first_name"),
    ("LastName", "last_name"),
    ("Email", "email"),
    ("Phone", "phone"),
    ("LeadStatus", "enrollment_status"),
    ("Program_of_Interest__c", "program_interest"),
    ("CreatedDate", "sf_created_at"),
    ("LastModifiedDate", "sf_modified_at"),
]
SF_REQUIRED_COLUMNS = ["Id", "Email"]
SF_CHANGES_LIMIT = 200
SF_DAILY_API_LIMIT = 100_000

# ---------------------------------------------------------------------------
# FIXED VALUES - identity resolution
# ---------------------------------------------------------------------------
CONFIDENCE_AUTO_MERGE = 0.85
NAME_WEIGHT = 0.6
OVERLAP_WEIGHT = 0.4

# ---------------------------------------------------------------------------
# FIXED VALUES - profile scoring
# ---------------------------------------------------------------------------
CONTACT_INFO_AUTHORITY = "crm"
RECENCY_WEIGHT = 0.55
FREQUENCY_WEIGHT = 0.45
RECENCY_HALF_LIFE_DAYS = 14.0
RECENCY_DECAY = 0.693
FREQUENCY_PER_EVENT = 2.5
FREQUENCY_CAP = 100.0
# Half-open bands [low, high); a score of exactly 100.0 falls in none of them.
SCORE_BANDS = [
    ("highly_engaged", 70.0, 100.0),
    ("moderately_engaged", 40.0, 70.0),
    ("at_risk", 15.0, 40.0),
    ("dormant", 0.0, 15.0),
]

# Built-in segment rules: (name, chain of (field, operator, value)) joined by AND.
BUILTIN_SEGMENT_RULES = [
    ("high_intent_prospect", [("total_events", ">=", 3), ("enrollment_status", "==", "inquiry")]),
    ("at_risk_student", [("days_since_last_login", ">=", 14), ("enrollment_status", "==", "active")]),
    ("engaged_learner", [("total_events", ">=", 5)]),
    ("mba_interested", [("viewed_mba_page", "==", True), ("downloaded_brochure", "==", True)]),
]
RULE_OPERATORS = [">=", "<=", ">", "<", "==", "!="]

# ---------------------------------------------------------------------------
# FIXED VALUES - quality gates
# ---------------------------------------------------------------------------
GATE1_SOURCES_AS_CODED = ["moodle", "canvas", "hubspot", "salesforce", "website", "app", "manual_import"]
EMAIL_REGEX = r"^[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z0-9-.]+$"
GATE3_MIN_COMPLETENESS = 0.6
GATE3_MIN_CONFIDENCE = 0.85
GATE4_COUNT_TOLERANCE = 0.2
GATE4_PII_FIELDS = ["email", "phone", "first_name", "last_name", "date_of_birth"]
FRESHNESS_MAX_AGE_HOURS = 24
CROSS_SOURCE_THRESHOLD = 0.9

# ---------------------------------------------------------------------------
# FIXED VALUES - privacy
# ---------------------------------------------------------------------------
CONSENT_CHANNELS = ["email", "whatsapp", "push", "sms", "analytics", "profiling"]
TERMS_VERSION = "v2.1"
MERGE_LEGAL_BASIS = "legitimate_interest"
ERASURE_WAREHOUSE_TABLES = [
    "cdp_bronze.raw_events",
    "cdp_silver.student_profiles",
    "cdp_silver.identity_graph",
    "cdp_gold.unified_profiles",
    "cdp_gold.segment_memberships",
    "cdp_reverse_etl.salesforce_sync",
]
ERASURE_DOCUMENT_COLLECTIONS = ["profiles", "events", "consents", "consent_audit_log", "segments"]
ERASURE_TOPICS = ["cdp.events.raw", "cdp.profiles.unified", "cdp.segments.updates", "cdp.reverse-etl.commands"]
ERASURE_SLA_HOURS = 72

# Log redaction: keys whose string value is replaced outright, then e-mail and phone patterns.
PII_LOG_KEYS = [
    "email",
    "email_address",
    "phone",
    "phone_number",
    "mobile",
    "first_name",
    "last_name",
    "full_name",
    "name",
    "student_name",
    "guardian_name",
    "parent_email",
    "personal_email",
]
LOG_EMAIL_RE = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
LOG_PHONE_RE = r"\+?\d[\d\-\s()]{7,}\d"
LOG_REDACTED = "[REDACTED]"
PROFILE_REDACTED = "***REDACTED***"

# ---------------------------------------------------------------------------
# FIXED VALUES - activation
# ---------------------------------------------------------------------------
PUSH_PII_FIELDS = ["email", "phone", "name", "address", "ssn"]
PUSH_AT_EXEMPT = ["email", "salesforce_id", "profile_id"]
WHATSAPP_PREFIX = "whatsapp:"
API_RATE_LIMIT = 1000
API_RATE_WINDOW_SECONDS = 60

# ---------------------------------------------------------------------------
# FIXED VALUES - metrics
# ---------------------------------------------------------------------------
LATENCY_BUCKETS = [0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0]
ACTIVE_PROFILE_DAYS = 90
DLQ_REASON_MAX = 120
ALERT_DLQ_SHARE = 0.01
ALERT_FRESHNESS_HOURS = 1
RETENTION_DAYS = [("bronze", 90), ("silver", 365), ("gold", 730)]
