"""Record schemas and value domains of a security event."""

from __future__ import annotations

from pyspark.sql import types as T

# The domains of the enumerated fields.
EVENT_TYPES = [
    "LOGIN_SUCCESS", "LOGIN_FAILURE", "LOGOUT", "PASSWORD_CHANGE", "MFA_CHALLENGE", "ACCOUNT_LOCKOUT",
    "UNAUTHORIZED_ACCESS", "PRIVILEGE_ESCALATION", "PERMISSION_CHANGE",
    "DATA_ACCESS", "DATA_MODIFICATION", "DATA_EXFILTRATION",
    "SYSTEM_STARTUP", "SYSTEM_SHUTDOWN", "CONFIG_CHANGE",
]
SEVERITIES = ["INFO", "LOW", "MEDIUM", "HIGH", "CRITICAL"]
USER_TYPES = ["EMPLOYEE", "CONTRACTOR", "ADMIN", "SYSTEM", "CUSTOMER", "ANONYMOUS"]
HIGH_SEVERITIES = ["HIGH", "CRITICAL"]

# Category, severity domain and usual status code per event type.
CATEGORY_OF_TYPE = {
    "authentication": ["LOGIN_SUCCESS", "LOGIN_FAILURE", "LOGOUT",
                       "PASSWORD_CHANGE", "MFA_CHALLENGE", "ACCOUNT_LOCKOUT"],
    "authorization": ["UNAUTHORIZED_ACCESS", "PRIVILEGE_ESCALATION", "PERMISSION_CHANGE"],
    "data": ["DATA_ACCESS", "DATA_MODIFICATION", "DATA_EXFILTRATION"],
    "system": ["SYSTEM_STARTUP", "SYSTEM_SHUTDOWN", "CONFIG_CHANGE"],
}
THREAT_TYPES = ["PRIVILEGE_ESCALATION", "DATA_EXFILTRATION"]
ALERT_TYPES = ["ACCOUNT_LOCKOUT", "LOGIN_FAILURE"]
SEVERITY_DOMAINS = [
    (["PRIVILEGE_ESCALATION", "DATA_EXFILTRATION", "ACCOUNT_LOCKOUT"], ["HIGH", "CRITICAL"]),
    (["UNAUTHORIZED_ACCESS", "DATA_MODIFICATION", "PERMISSION_CHANGE", "LOGIN_FAILURE"], ["MEDIUM", "HIGH"]),
    (["CONFIG_CHANGE", "MFA_CHALLENGE", "PASSWORD_CHANGE"], ["LOW", "MEDIUM"]),
    (["LOGIN_SUCCESS", "LOGOUT", "DATA_ACCESS", "SYSTEM_STARTUP", "SYSTEM_SHUTDOWN"], ["INFO"]),
]
STATUS_OF_TYPE = [
    (200, ["LOGIN_SUCCESS", "LOGOUT", "PASSWORD_CHANGE", "PERMISSION_CHANGE", "DATA_ACCESS",
           "DATA_MODIFICATION", "SYSTEM_STARTUP", "SYSTEM_SHUTDOWN", "CONFIG_CHANGE"]),
    (400, ["PRIVILEGE_ESCALATION", "DATA_EXFILTRATION"]),
    (401, ["LOGIN_FAILURE"]),
    (403, ["UNAUTHORIZED_ACCESS", "ACCOUNT_LOCKOUT"]),
]

GEO = T.StructType([
    T.StructField("country", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
])

# The record as it travels. ``additional_info`` is taken as JSON text here,
# because its keys and value types depend on the event type.
WIRE_EVENT = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("user_type", T.StringType()),
    T.StructField("ip_address", T.StringType()),
    T.StructField("geo_location", GEO),
    T.StructField("user_agent", T.StringType()),
    T.StructField("status_code", T.IntegerType()),
    T.StructField("message", T.StringType()),
    T.StructField("correlation_id", T.StringType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("severity", T.StringType()),
    T.StructField("source_system", T.StringType()),
    T.StructField("target_system", T.StringType()),
    T.StructField("tags", T.ArrayType(T.StringType())),
    T.StructField("additional_info", T.StringType()),
])
WIRE_FIELDS = WIRE_EVENT.fieldNames()

# The nine-field projection a light consumer parses.
BRIEF_EVENT = T.StructType([
    T.StructField(name, T.StringType()) for name in
    ["event_id", "timestamp", "event_type", "user_id", "user_type",
     "ip_address", "severity", "message", "source_system"]
])

KAFKA_RECORD = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("headers", T.ArrayType(T.StructType([
        T.StructField("key", T.StringType()),
        T.StructField("value", T.BinaryType()),
    ]))),
])

STATS = T.StructType([
    T.StructField("dimension", T.StringType()),
    T.StructField("key", T.StringType()),
    T.StructField("n", T.LongType()),
])

# The keys of ``additional_info`` per event type.
INFO_SCHEMAS = {
    "LOGIN_SUCCESS": "login_type string, device_type string, auth_provider string",
    "LOGIN_FAILURE": "failure_reason string, attempt_number int, device_type string",
    "LOGOUT": "logout_type string, session_duration int",
    "UNAUTHORIZED_ACCESS": "resource string, required_role string, user_role string",
    "PRIVILEGE_ESCALATION": "target_role string, method string, detection_source string",
    "PASSWORD_CHANGE": "initiated_by string, password_strength string, forced_change boolean",
    "MFA_CHALLENGE": "mfa_type string, success boolean, attempt_number int",
    "ACCOUNT_LOCKOUT": "failed_attempts int, lockout_duration_minutes int, unlock_method string",
    "DATA_ACCESS": "data_type string, records_accessed int, access_purpose string, data_classification string",
    "DATA_MODIFICATION": "data_type string, records_modified int, modification_type string, approved_change boolean",
    "DATA_EXFILTRATION": "data_type string, volume_mb int, detection_method string, destination_ip string, "
                         "confidence_score int",
    "SYSTEM_STARTUP": "server_id string, environment string, initiated_by string",
    "SYSTEM_SHUTDOWN": "server_id string, environment string, initiated_by string",
    "CONFIG_CHANGE": "component string, change_type string, approved_change boolean, change_ticket string",
    "PERMISSION_CHANGE": "target_user string, permission_type string, permission_change string, "
                         "permissions array<string>",
}
