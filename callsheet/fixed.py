"""Fixed values of the contact mart.

FIXED VALUES — these must equal the studied mart's values for results to
match: column names and types of the raw contact table, accepted domains,
ranges, segment labels and their thresholds, alert floors. They are stated
once, here, in their natural order; every operator reads them from this
module.
"""

from __future__ import annotations

# --- FIXED VALUES: raw contact columns and declared types (21) -------------
RAW_COLUMN_TYPES: list[tuple[str, str]] = [
    ("age", "bigint"),
    ("job", "string"),
    ("marital", "string"),
    ("education", "string"),
    ("default", "string"),
    ("housing", "string"),
    ("loan", "string"),
    ("contact", "string"),
    ("month", "string"),
    ("day_of_week", "string"),
    ("duration", "bigint"),
    ("campaign", "bigint"),
    ("pdays", "bigint"),
    ("previous", "bigint"),
    ("poutcome", "string"),
    ("emp_var_rate", "double"),
    ("cons_price_idx", "double"),
    ("cons_conf_idx", "double"),
    ("euribor3m", "double"),
    ("nr_employed", "double"),
    ("y", "string"),
]

# --- FIXED VALUES: loader type-by-name rule --------------------------------
LOADER_INT_COLUMNS = ["age", "duration", "campaign", "pdays", "previous", "day"]
LOADER_FLOAT_COLUMNS = ["balance"]

# --- FIXED VALUES: columns the loader requires (critical checks) -----------
LOADER_REQUIRED_COLUMNS = [
    "age", "job", "marital", "education", "default", "balance", "housing",
    "loan", "contact", "day", "month", "duration", "campaign", "pdays",
    "previous", "poutcome", "y",
]

# --- FIXED VALUES: loader soft checks (warn only) --------------------------
LOADER_AGE_RANGE = (18, 95)
LOADER_MIN_DURATION = 0
LOADER_MIN_CAMPAIGN = 1

# --- FIXED VALUES: staging renames (source -> staged) ----------------------
STAGE_RENAMES: list[tuple[str, str]] = [
    ("default", "has_default"),
    ("housing", "has_housing_loan"),
    ("loan", "has_personal_loan"),
    ("contact", "contact_type"),
    ("duration", "call_duration_seconds"),
    ("campaign", "campaign_number"),
    ("pdays", "days_since_last_contact"),
    ("previous", "previous_campaign_contacts"),
    ("poutcome", "previous_campaign_outcome"),
    ("emp_var_rate", "employment_variation_rate"),
    ("cons_price_idx", "consumer_price_index"),
    ("cons_conf_idx", "consumer_confidence_index"),
    ("euribor3m", "euribor_3m_rate"),
    ("nr_employed", "number_employed"),
    ("y", "subscribed"),
]

# --- FIXED VALUES: staging row filter ---------------------------------------
STAGE_AGE_RANGE = (18, 95)
STAGE_MIN_DURATION = 0
STAGE_MIN_CAMPAIGN = 1
STAGE_KEY_ORDER = ["age", "job", "marital"]

# --- FIXED VALUES: accepted domains (runtime suite and schema suite) -------
JOBS = [
    "admin.", "blue-collar", "entrepreneur", "housemaid", "management",
    "retired", "self-employed", "services", "student", "technician",
    "unemployed", "unknown",
]
MARITAL = ["divorced", "married", "single", "unknown"]
EDUCATION = [
    "basic.4y", "basic.6y", "basic.9y", "high.school", "illiterate",
    "professional.course", "university.degree", "unknown",
]
NO_UNKNOWN_YES = ["no", "unknown", "yes"]
CONTACT = ["cellular", "telephone"]
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
WEEKDAYS = ["mon", "tue", "wed", "thu", "fri"]
POUTCOME = ["failure", "nonexistent", "success"]
YES_NO = ["no", "yes"]

# --- FIXED VALUES: runtime suite --------------------------------------------
RUNTIME_REQUIRED = ["age", "job", "marital", "education", "duration", "campaign", "y"]
RUNTIME_RANGES: list[tuple[str, float, float]] = [
    ("age", 18, 95),
    ("duration", 0, 5000),
    ("campaign", 1, 100),
    ("pdays", -1, 1000),
    ("previous", 0, 10),
]

# --- FIXED VALUES: schema suite ranges ---------------------------------------
SCHEMA_AGE_VALUES = (18, 95)  # accepted_values list 18, 19, ..., 95
SCHEMA_RANGES: list[tuple[str, float, float]] = [
    ("duration", 0, 4918),
    ("campaign", 1, 56),
    ("pdays", -1, 999),
    ("previous", 0, 7),
    ("emp_var_rate", -3.4, 1.4),
    ("cons_price_idx", 92.201, 94.767),
    ("cons_conf_idx", -50.8, -26.9),
    ("euribor3m", 0.634, 5.045),
    ("nr_employed", 4963.6, 5228.1),
]

# --- FIXED VALUES: runtime test names (report order) ------------------------
TEST_DATA_TYPES = "Data Types Check"
TEST_NULLS = "Null Values Check"
TEST_RANGES = "Value Ranges Check"
TEST_ACCEPTED = "Accepted Values Check"
TEST_DUPLICATES = "Duplicate Records Check"
TEST_CONSISTENCY = "Data Consistency Check"

# --- FIXED VALUES: segment labels and thresholds ----------------------------
# (label, lo, hi): lo None means "value < hi", else lo <= value <= hi.
AGE_GROUPS = [
    ("Young (18-24)", None, 25),
    ("Young Adult (25-34)", 25, 34),
    ("Adult (35-44)", 35, 44),
    ("Middle Age (45-54)", 45, 54),
    ("Senior (55-64)", 55, 64),
]
AGE_GROUP_ELSE = "Elder (65+)"

AGE_CATEGORIES = [("Young", None, 30), ("Middle", 30, 50)]
AGE_CATEGORY_ELSE = "Senior"

JOB_CATEGORIES = [
    ("Professional", ["admin.", "management", "executive"]),
    ("Skilled", ["technician", "services", "entrepreneur"]),
    ("Manual", ["blue-collar", "housemaid", "unemployed"]),
    ("Student/Retired", ["student", "retired"]),
]
JOB_CATEGORY_ELSE = "Other"

INCOME_LEVELS = [
    ("High Income", ["admin.", "management", "executive", "technician"]),
    ("Medium Income", ["services", "entrepreneur", "blue-collar"]),
]
INCOME_LEVEL_ELSE = "Low Income"

RISK_HIGH = "High Risk"
RISK_MEDIUM = "Medium Risk"
RISK_LOW = "Low Risk"

ENGAGEMENT_LEVELS = [
    ("New Customer", 0, 0),
    ("Occasional", 1, 3),
    ("Regular", 4, 10),
]
ENGAGEMENT_ELSE = "Frequent"

PREVIOUS_OUTCOMES = [
    ("Previous Success", "success"),
    ("Previous Failure", "failure"),
    ("Previous Other", "other"),
]
PREVIOUS_OUTCOME_ELSE = "No Previous Contact"

CALL_DURATIONS = [("Long Call", 300), ("Medium Call", 120)]  # strictly greater than
CALL_DURATION_ELSE = "Short Call"

SEGMENT_PERFORMANCE = [("High Performer", 15), ("Medium Performer", 10), ("Low Performer", 5)]
SEGMENT_PERFORMANCE_ELSE = "Underperformer"

CAMPAIGN_PERFORMANCE = [("Excellent", 15), ("Good", 10), ("Average", 5)]
CAMPAIGN_PERFORMANCE_ELSE = "Poor"

# --- FIXED VALUES: fact pivots (label -> output column) ---------------------
AGE_PIVOT = [
    ("Young (18-24)", "young_conversions"),
    ("Young Adult (25-34)", "young_adult_conversions"),
    ("Adult (35-44)", "adult_conversions"),
    ("Middle Age (45-54)", "middle_age_conversions"),
    ("Senior (55-64)", "senior_conversions"),
    ("Elder (65+)", "elder_conversions"),
]
JOB_PIVOT = [
    ("Professional", "professional_conversions"),
    ("Skilled", "skilled_conversions"),
    ("Manual", "manual_conversions"),
    ("Student/Retired", "student_retired_conversions"),
]
RISK_PIVOT = [
    ("Low Risk", "low_risk_conversions"),
    ("Medium Risk", "medium_risk_conversions"),
    ("High Risk", "high_risk_conversions"),
]

# --- FIXED VALUES: alert floors and report sizes ----------------------------
CONVERSION_FLOOR = 5.0  # percent
QUALITY_FLOOR = 95.0  # percent
SLOW_RUN_MINUTES = 30
TOP_SEGMENTS = 10
TILE_TOP_SEGMENTS = 20
TILE_WINDOW_DAYS = 30
