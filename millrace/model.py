"""Row types of the three queues: raw payloads, atomic events and errors."""

from pyspark.sql import types as T

RAW = T.StructType(
    [
        T.StructField("schema", T.StringType(), False),
        T.StructField("ipAddress", T.StringType(), False),
        T.StructField("timestamp", T.LongType(), False),
        T.StructField("encoding", T.StringType(), False),
        T.StructField("collector", T.StringType(), False),
        T.StructField("userAgent", T.StringType()),
        T.StructField("refererUri", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("querystring", T.StringType()),
        T.StructField("body", T.BinaryType()),
        T.StructField("headers", T.ArrayType(T.StringType())),
        T.StructField("contentType", T.StringType()),
        T.StructField("hostname", T.StringType()),
        T.StructField("networkUserId", T.StringType()),
    ]
)
RAW_COLUMNS = RAW.fieldNames()

SELF_DESCRIBING = T.StructType(
    [T.StructField("schema", T.StringType()), T.StructField("data", T.StringType())]
)

_REQUIRED_ATOMIC = {
    "event_id", "collector_host", "platform", "event_vendor", "event_name", "event_version",
    "tstamp", "collector_tstamp", "etl_tstamp", "v_collector", "v_etl", "event",
}
_TIMESTAMPS = {
    "tstamp", "collector_tstamp", "dvce_created_tstamp", "dvce_sent_tstamp", "true_tstamp", "etl_tstamp",
}
_LONGS = {"session_idx", "domain_sessionidx"}

# Column order of the atomic event.
ATOMIC_COLUMNS = [
    "event_id", "collector_host", "collector_auth", "app_id", "platform",
    "event_vendor", "event_name", "event_version",
    "tstamp", "collector_tstamp", "dvce_created_tstamp", "dvce_sent_tstamp", "true_tstamp", "etl_tstamp",
    "v_tracker", "v_collector", "v_etl", "name_tracker",
    "user_ipaddress", "user_id", "session_id", "session_idx",
    "domain_userid", "domain_sessionid", "domain_sessionidx", "network_userid",
    "geo_country", "geo_region", "geo_city",
    "useragent", "language", "device_id", "tenant_id",
    "category", "action", "label", "property", "value",
    "contexts", "event",
]


def _atomic_type(name: str) -> T.DataType:
    if name in _TIMESTAMPS:
        return T.TimestampType()
    if name in _LONGS:
        return T.LongType()
    if name == "contexts":
        return T.ArrayType(SELF_DESCRIBING)
    if name == "event":
        return SELF_DESCRIBING
    return T.StringType()


ATOMIC = T.StructType(
    [T.StructField(n, _atomic_type(n), n not in _REQUIRED_ATOMIC) for n in ATOMIC_COLUMNS]
)
ATOMIC_REQUIRED = [n for n in ATOMIC_COLUMNS if n in _REQUIRED_ATOMIC]
ATOMIC_SCALARS = [n for n in ATOMIC_COLUMNS if n not in ("contexts", "event")]

ERRORS = T.StructType(
    [
        T.StructField("collector_domain", T.StringType(), False),
        T.StructField("reason", T.StringType(), False),
        T.StructField("tstamp", T.TimestampType(), False),
        T.StructField("payload", T.BinaryType()),
    ]
)
