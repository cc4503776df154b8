"""Binary and JSON forms of the three record types.

Encoding is SQL throughout. Avro and Thrift records, whose fields sit at positions known only while reading, are read by
Arrow batches, all records of a batch at once (``records``).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from millrace.functions import text
from millrace.functions.sqltext import let, lit
from millrace.model import ATOMIC, ATOMIC_COLUMNS, ATOMIC_REQUIRED, RAW, RAW_COLUMNS
from millrace.sources import records
from millrace.sources.queues import check_queue

# The schema names a record carries in each format.
AVRO_NAME = "CollectorPayload"
THRIFT_NAME = "iglu:com.snowplowanalytics.snowplow/CollectorPayload/thrift/1-0-0"

# Thrift field ids in writing order.
THRIFT_IDS = {
    "schema": 31337,
    "ipAddress": 100,
    "timestamp": 200,
    "encoding": 210,
    "collector": 220,
    "userAgent": 300,
    "refererUri": 310,
    "path": 320,
    "querystring": 330,
    "body": 340,
    "headers": 350,
    "contentType": 360,
    "hostname": 400,
    "networkUserId": 410,
}
_THRIFT_TYPES = {"timestamp": 10, "headers": 15}
_THRIFT_STRING = 11

ATOMIC_TIMES = [f.name for f in ATOMIC if isinstance(f.dataType, T.TimestampType)]


# --- Encoding ---------------------------------------------------------------------------------------


def _bytes(x: str) -> str:
    return f"CAST({x} AS BINARY)"


def varint(n: str) -> str:
    """Zig-zag variable length form of a BIGINT. One and two bytes, which nearly all lengths take, do without a lambda."""
    groups = "ceil(greatest(length(conv(hex(zz), 16, 2)), 1) / 7)"
    group = "shiftrightunsigned(zz, 7 * gi) & 127"
    byte = f"lpad(hex(IF(gi < {groups} - 1, ({group}) | 128, {group})), 2, '0')"
    one = f"lpad(hex(2 * {n}), 2, '0')"
    two = f"hex(((2 * {n}) & 127 | 128) * 256 + shiftright({n}, 6))"
    many = let(
        f"shiftleft(CAST({n} AS BIGINT), 1) ^ shiftright(CAST({n} AS BIGINT), 63)",
        "zz",
        f"array_join(transform(sequence(0, CAST({groups} AS INT) - 1), gi -> {byte}), '')",
    )
    return f"unhex(IF({n} BETWEEN 0 AND 63, {one}, IF({n} BETWEEN 64 AND 8191, {two}, {many})))"


def _avro_text(x: str) -> str:
    return f"concat({varint(f'octet_length({x})')}, {_bytes(x)})"


def _avro_optional(x: str, encoded: str) -> str:
    return f"IF({x} IS NULL, unhex('00'), concat(unhex('02'), {encoded}))"


def _avro_array(x: str, var: str, encoded: str) -> str:
    """One block of items and an end mark; only the end mark when empty."""
    items = f"aggregate(transform({x}, {var} -> {encoded}), CAST('' AS BINARY), (ab, ac) -> concat(ab, ac))"
    return f"IF(size({x}) = 0, unhex('00'), concat({varint(f'size({x})')}, {items}, unhex('00')))"


def raw_avro(body: str = "body") -> str:
    """A raw record as one schemaless Avro datum; ``body`` may name another expression."""
    parts = [_avro_text(lit(AVRO_NAME))]
    for field in RAW:
        x = body if field.name == "body" else field.name
        if field.name == "schema":
            continue
        if field.name == "timestamp":
            encoded = varint(x)
        elif field.name == "headers":
            encoded = _avro_array(x, "hd", _avro_text("hd"))
        else:
            encoded = _avro_text(x)
        parts.append(_avro_optional(x, encoded) if field.nullable else encoded)
    return f"concat({', '.join(parts)})"


def _fixed(n: str, size: int) -> str:
    return f"unhex(lpad(hex(CAST({n} AS BIGINT)), {size * 2}, '0'))"


def _thrift_text(x: str) -> str:
    return f"concat({_fixed(f'octet_length({x})', 4)}, {_bytes(x)})"


def raw_thrift(body: str = "body") -> str:
    """A raw record as a Thrift binary-protocol struct; absent fields are left out."""
    parts = []
    for name, number in THRIFT_IDS.items():
        x = {"body": body, "schema": lit(THRIFT_NAME)}.get(name, name)
        kind = _THRIFT_TYPES.get(name, _THRIFT_STRING)
        if name == "timestamp":
            encoded = _fixed(x, 8)
        elif name == "headers":
            items = f"aggregate(transform({x}, hd -> {_thrift_text('hd')}), CAST('' AS BINARY), (ab, ac) -> concat(ab, ac))"
            encoded = f"concat(unhex('{_THRIFT_STRING:02X}'), {_fixed(f'size({x})', 4)}, {items})"
        else:
            encoded = _thrift_text(x)
        parts.append(f"IF({x} IS NULL, CAST('' AS BINARY), concat(unhex('{kind:02X}{number:04X}'), {encoded}))")
    return f"concat({', '.join(parts)}, unhex('00'))"


RAW_ENCODERS = {"avro": raw_avro, "thrift": raw_thrift}


def encode_messages(raw: DataFrame, fmt: str) -> DataFrame:
    """Raw rows to a ``value`` column of serialised records."""
    return raw.select(F.expr(RAW_ENCODERS[fmt]()).alias("value"))


# --- Decoding ---------------------------------------------------------------------------------------


_KINDS = {"body": "bytes", "headers": "texts", "contexts": "pairs", "event": "pair"}


def _kind(field: T.StructField) -> str:
    return _KINDS.get(field.name, "long" if isinstance(field.dataType, T.LongType) else "text")


def _read_raw_avro(values: pa.Array) -> tuple[list[pa.Array], records.Records]:
    return records.read_avro(values, [(f.name, _kind(f), f.nullable) for f in RAW])


def _read_raw_thrift(values: pa.Array) -> tuple[list[pa.Array], records.Records]:
    return records.read_thrift(values, [(f.name, _kind(f), f.nullable, THRIFT_IDS[f.name]) for f in RAW])


def _read_atomic_avro(values: pa.Array) -> tuple[list[pa.Array], records.Records]:
    # contexts and the event are never unions with null
    return records.read_avro(values, [(f.name, _kind(f), f.nullable and f.name not in ("contexts", "event")) for f in ATOMIC])


RAW_READERS = {"avro": _read_raw_avro, "thrift": _read_raw_thrift}
Reader = Callable[[pa.Array], tuple[list[pa.Array], records.Records]]


def _decode(df: DataFrame, read: Reader, fields: T.StructType) -> DataFrame:
    """Add ``record`` and ``err`` to a table with a binary ``value``."""
    nullable = T.StructType([T.StructField(f.name, f.dataType) for f in fields])
    out = T.StructType(
        [
            T.StructField("value", T.BinaryType()),
            T.StructField("record", nullable),
            T.StructField("err", T.StringType()),
        ]
    )
    schema = to_arrow_schema(out)
    inner = schema.field("record").type

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for values in records.slices(batch.column(0)):
                columns, found = read(values)
                columns = [c.cast(inner.field(i).type) for i, c in enumerate(columns)]
                bad = found.reason > 0
                record = pa.StructArray.from_arrays(columns, fields=list(inner), mask=pa.array(bad))
                err = pa.array(found.reasons, pa.string()).take(pa.array(found.reason))
                yield pa.RecordBatch.from_arrays([values.cast(schema.field("value").type), record, err], schema=schema)

    return df.select("value").mapInArrow(decode, out)


def decode_messages(df: DataFrame, fmt: str) -> DataFrame:
    """``value`` bytes to ``(value, record, err)``; undecodable messages carry only ``err``."""
    return _decode(df, RAW_READERS[fmt], RAW)


def decoded_raw(decoded: DataFrame) -> DataFrame:
    return decoded.where("err IS NULL").select("record.*")


# --- Atomic events ----------------------------------------------------------------------------------


def _json_fields() -> str:
    fields = []
    for name in ATOMIC_COLUMNS:
        if name in ATOMIC_TIMES:
            fields.append(f"{text.iso_utc(name)} AS {name}")
        elif name == "contexts":
            fields.append(
                "transform(contexts, c -> named_struct('schema', c.schema, 'data', try_parse_json(c.data))) AS contexts"
            )
        elif name == "event":
            fields.append("named_struct('schema', event.schema, 'data', try_parse_json(event.data)) AS event")
        else:
            fields.append(name)
    return ", ".join(fields)


def atomic_json() -> str:
    """An atomic row as one JSON object: every field, nulls kept, data nested as objects."""
    return f"to_json(struct({_json_fields()}), map('ignoreNullFields', 'false'))"


def atomic_avro() -> str:
    """An atomic row as one schemaless Avro datum; times and data are texts."""
    pair = "concat(" + _avro_text("{0}.schema") + ", " + _avro_text("{0}.data") + ")"
    parts = []
    for field in ATOMIC:
        name = field.name
        if name == "contexts":
            parts.append(_avro_array(name, "cx", pair.format("cx")))
            continue
        if name == "event":
            parts.append(pair.format("event"))
            continue
        x = text.iso_utc(name) if name in ATOMIC_TIMES else name
        encoded = varint(x) if isinstance(field.dataType, T.LongType) else _avro_text(x)
        parts.append(_avro_optional(name, encoded) if field.nullable else encoded)
    return f"concat({', '.join(parts)})"


def encode_atomic(events: DataFrame, fmt: str = "json") -> DataFrame:
    if fmt == "json":
        return events.select(F.expr(f"CAST({atomic_json()} AS BINARY)").alias("value"))
    if fmt == "avro":
        return events.select(F.expr(atomic_avro()).alias("value"))
    raise ValueError(f"Unknown format {fmt}")


def _typed_atomic(df: DataFrame, record: str) -> DataFrame:
    columns = [
        F.expr(f"CAST({record}.{f.name} AS {f.dataType.simpleString()})").alias(f.name) for f in ATOMIC
    ]
    return df.select(F.col("value").alias("message"), "err", *columns)


def decode_atomic(df: DataFrame, fmt: str = "json") -> DataFrame:
    """``(message, err, atomic columns)``; ``err`` tells why a message is not an atomic event."""
    if fmt == "avro":
        return _typed_atomic(_decode(df, _read_atomic_avro, _text_times(ATOMIC)), "record")
    types = ", ".join(
        f"{f.name} ARRAY<STRUCT<schema: STRING, data: VARIANT>>"
        if f.name == "contexts"
        else "event STRUCT<schema: STRING, data: VARIANT>"
        if f.name == "event"
        else f"{f.name} {'STRING' if f.name in ATOMIC_TIMES else f.dataType.simpleString()}"
        for f in ATOMIC
    )
    parsed = df.withColumn("_text", F.expr("try_validate_utf8(CAST(value AS STRING))")).withColumn(
        "record", F.expr(f"from_json(_text, {lit(types)})")
    )
    missing = " OR ".join(
        f"try_cast(record.{n} AS {ATOMIC[n].dataType.simpleString()}) IS NULL" if n in ATOMIC_TIMES else f"record.{n} IS NULL"
        for n in ATOMIC_REQUIRED
    )
    err = (
        f"CASE WHEN _text IS NULL OR ({text.strict_json('_text')}) IS NULL THEN 'message is not JSON'"
        f" WHEN {missing} THEN 'a required field is missing'"
        " WHEN try_cast(record.event.data AS MAP<STRING, VARIANT>) IS NULL THEN 'event data is not an object' END"
    )
    parsed = parsed.withColumn("err", F.expr(err))
    columns = []
    for f in ATOMIC:
        if f.name == "contexts":
            sql = (
                "transform(coalesce(record.contexts, array()),"
                " c -> named_struct('schema', c.schema, 'data', CAST(c.data AS STRING)))"
            )
        elif f.name == "event":
            sql = "named_struct('schema', record.event.schema, 'data', CAST(record.event.data AS STRING))"
        elif f.name in ATOMIC_TIMES:
            sql = f"try_cast(record.{f.name} AS TIMESTAMP)"
        else:
            sql = f"record.{f.name}"
        columns.append(F.expr(f"IF(err IS NULL, {sql}, NULL)").alias(f.name))
    return parsed.select(F.col("value").alias("message"), "err", *columns)


def _text_times(schema: T.StructType) -> T.StructType:
    return T.StructType(
        [T.StructField(f.name, T.StringType() if f.name in ATOMIC_TIMES else f.dataType, f.nullable) for f in schema]
    )


# --- Errors -----------------------------------------------------------------------------------------


def encode_errors(errors: DataFrame) -> DataFrame:
    """One JSON object per error. A payload that is not UTF-8 text is base64, which ``payload_encoding`` then says."""
    fields = f"collector_domain, reason, {text.iso_utc('tstamp')} AS tstamp"
    plain = f"struct({fields}, CAST(payload AS STRING) AS payload)"
    encoded = f"struct({fields}, base64(payload) AS payload, 'base64' AS payload_encoding)"
    keep = "map('ignoreNullFields', 'false')"
    record = f"IF(payload IS NULL OR is_valid_utf8(CAST(payload AS STRING)), to_json({plain}, {keep}), to_json({encoded}, {keep}))"
    return errors.selectExpr(f"CAST({record} AS BINARY) AS value")


def decode_errors(df: DataFrame) -> DataFrame:
    """Error rows, plus ``raw``: the message itself where it is not an error record."""
    parsed = df.withColumn(
        "r",
        F.from_json(
            F.col("value").cast("string"),
            "collector_domain STRING, reason STRING, tstamp STRING, payload STRING, payload_encoding STRING",
        ),
    )
    ok = "(r.collector_domain IS NOT NULL AND r.reason IS NOT NULL)"
    return parsed.selectExpr(
        f"IF({ok}, r.collector_domain, NULL) AS collector_domain",
        f"IF({ok}, r.reason, NULL) AS reason",
        f"IF({ok}, try_cast(r.tstamp AS TIMESTAMP), NULL) AS tstamp",
        f"IF({ok}, IF(r.payload_encoding = 'base64', try_to_binary(r.payload, 'base64'), CAST(r.payload AS BINARY)), NULL) AS payload",
        f"IF({ok}, NULL, value) AS raw",
    )


# --- Text queues ------------------------------------------------------------------------------------


def to_queue_body(df: DataFrame, queue: str) -> DataFrame:
    """Bodies of a text-only queue: raw records as base64, everything else as UTF-8 text. Other queues are an error."""
    check_queue(queue)
    return df.selectExpr("base64(value) AS body" if queue == "raw" else "CAST(value AS STRING) AS body")


def from_queue_body(df: DataFrame, queue: str) -> DataFrame:
    check_queue(queue)
    return df.selectExpr(
        "try_to_binary(body, 'base64') AS value" if queue == "raw" else "CAST(body AS BINARY) AS value"
    )
