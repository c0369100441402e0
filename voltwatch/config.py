"""Domain constants for the fleet-health engine.

Fixed values: these must equal the published behaviour of the system we
re-implement (thresholds, weights, label maps).  They are stated plainly and
kept together so every operator reads them from one place.
"""

# --- fixed values -----------------------------------------------------------

# Expected design lifetime in days, per canonical device type.
DEVICE_LIFETIME_DAYS = {"ZM1": 3650, "UM3": 3650, "MM3": 3650}
DEFAULT_LIFETIME_DAYS = 3650

# Temperature limit in degrees C (only the MM3 limit is used by scoring).
TEMP_LIMITS_C = {"ZM1": 70.0, "UM3": 85.0, "MM3": 85.0}

# MM3 line-current limits in amperes.
MM3_CURRENT_MIN_NORMAL = 1.0
MM3_CURRENT_MAX_NORMAL = 800.0
MM3_CURRENT_WARNING = 700.0
MM3_CURRENT_CRITICAL = 850.0
MM3_CURRENT_OFF_PEAK_MAX = 12.0

# ZM1 battery thresholds in percent.
ZM1_BATTERY_CRITICAL = 20.0
ZM1_BATTERY_WARNING = 30.0

# GPS jump threshold in metres and earth radius for haversine.
GPS_JUMP_THRESHOLD_M = 30.0
EARTH_RADIUS_M = 6371000.0

# Coordinate change threshold in degrees (labelling / prediction).
COORD_CHANGE_DEG = 0.001

# Replace when more than this percent of life is used.
REPLACE_LIFE_PCT = 90.0

# Prediction confidence threshold.
CONFIDENCE_THRESHOLD = 0.95

# Device types that get action models and labels.
ACTIVE_ML_TYPES = ("MM3", "ZM1")

# Current label map.
ACTION_LABELS = {0: "NO_ACTION", 1: "RECONFIGURE", 2: "REPLACE"}
ACTION_IDS = {v: k for k, v in ACTION_LABELS.items()}

# Default observed battery drain in percent per day.
DEFAULT_DRAIN_PER_DAY = 0.027

# Days per month used for age in months.
DAYS_PER_MONTH = 30.44

# Scoring weights (component weight, cap) per type.
ZM1_WEIGHTS = {"comm": (0.25, 365.0), "report": (0.25, 180.0), "life": (0.20, 1.0),
               "aabr": (0.20, 100.0), "urgency": (0.10, 1.0)}
UM3_WEIGHTS = {"comm": (0.70, 365.0), "life": (0.30, 1.0)}
MM3_WEIGHTS = {"comm": (0.30, 365.0), "current": (0.20, 1000.0), "temp": (0.15, 100.0),
               "life": (0.20, 1.0), "flags": (0.15, None)}

# Tokens pandas' CSV reader treats as missing (used for "raw value missing").
MISSING_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
                  "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
                  "n/a", "nan", "null")

# Aliases of the misspelled temperature column.
TEMPERATURE_ALIASES = ("LineTemperatrue", "LineTemperture", "LineTemp", "Line_Temperature")

# Risk-reason texts (D5), in the order the rules are checked.  "{}" marks a
# formatted number (comm days and drain as whole numbers, the rest with one
# decimal, formatted like Python).
REASON_TEXT = {
    "reconf_once": "Reconfigure attempted 1 time",
    "reconf_many": "Reconfigure attempted {} times",
    "reconf_multiple": "Multiple reconfigure attempts - consider replacement after 48 hours if no improvement",
    "missing_last_heard": "Missing Last_Heard date",
    "gps_drift": "GPS drift detected - reconfigure recommended",
    "gps_missing": "GPS coordinates missing - reconfigure recommended",
    "zm1_drain_fast": "Battery draining fast ({}%/year)",
    "zm1_drain_faster": "Battery draining faster than expected ({}%/year)",
    "zm1_battery_missing": "Missing battery data - check telemetry",
    "zm1_battery_low": "Battery critically low - reconfigure to verify",
    "zm1_battery_low_after": "Battery still low after reconfigure - consider replacement after 48 hours if no improvement",
    "mm3_critical": "CRITICAL: Current {}A exceeds max (850A)",
    "mm3_overheat": "Overheating ({}C) - check ventilation",
    "mm3_overheat_after": "Still overheating after reconfigure - consider replacement after 48 hours if no improvement",
    "mm3_high": "High current ({}A) - investigate",
    "mm3_low": "Low current ({}A) - check connection",
    "mm3_zero": "Zero current detected - reconfigure sensor",
    "mm3_offpeak": "High current during off-peak - investigate",
    "mm3_life": "Device past 90% expected life ({} years) - plan replacement",
    "mm3_no_comm": "No communication for {} days",
    "mm3_comm_gap": "Long communication gap ({} days)",
    "um3_no_comm": "No communication for {} days - reconfigure",
    "um3_no_comm_after": "Still no communication after reconfigure - consider replacement after 48 hours if no improvement",
    "um3_comm_persists": "Communication issue persists after reconfigure",
    "um3_comm_delay": "Communication delay ({} days)",
    "um3_life": "Device past 90% expected life - plan replacement",
    "normal": "Normal operating conditions",
}

# Trust-stack rule texts (D14), in rule order.
TRUST_RULE_TEXT = ["Battery <20%", "Battery <10%", "Battery <20% AND not heard >3d", "Not heard >7d",
                   "LineCurrent=0 with low battery", "LineCurrent=0 AND not heard >3d", "Temperature >85C",
                   "Temperature <-20C", "Installed/Active but LineCurrent=0"]
TRUST_NO_RULE = "No rule triggered"

# Fixed reference date used by tests and queries instead of wall clock.
DEFAULT_AS_OF = "2024-01-31"

# Output contract of build_health_features.
FEATURE_HEALTH_OUTPUT_COLUMNS = [
    "Serial", "Device_Type", "Last_Heard", "Last_Heard_dt", "comm_age_days",
    "LineCurrent", "LineTemperature", "LineCurrent_val", "LineTemperature_val",
    "battery_level", "battery_low_flag", "battery_warning_flag", "battery_report_age_days",
    "device_age_days", "device_age_months", "expected_lifetime_days", "pct_life_used",
    "battery_drain_rate", "battery_drain_rate_per_day", "aging_acceleration_factor",
    "battery_degradation_factor", "temperature_exceedence_count", "age_adjusted_battery_risk",
    "old_and_hot_flag", "maintenance_urgency_score", "Latitude", "Longitude",
    "distance_drift_m", "gps_jump_flag", "current_variance", "temp_variance",
    "zero_current_flag", "low_current_flag", "high_current_flag", "critical_current_flag",
    "high_offpeak_flag", "overheat_flag", "zero_current_frequency", "overheat_frequency",
    "comm_fail_frequency", "gps_jump_frequency", "risk_score_zm1", "risk_score_um3",
    "risk_score_mm3", "risk_score", "risk_reason",
]

# fixed values: columns that no action model may learn from
MODEL_DROP_COLUMNS = ["Region", "Substation", "Feeder", "Site", "Phase", "IP_Address", "NetworkGroup", "Profile_Name",
                      "SensorGateway", "device_type_display", "device_type_for_display"]
