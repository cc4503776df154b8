"""Subject of a bearer token in the request headers (opt-in).

Splitting the token and reading its claims are SQL expressions; only the RSA signature check is Python,
applied to Arrow batches of distinct columns.
"""

from __future__ import annotations

import base64
import hashlib

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from millrace.config import PipelineConfig
from millrace.functions import net, text
from millrace.functions.sqltext import lit
from millrace.operators.lookup import lookup_join

# Fixed value: ASN.1 prefix of a SHA-256 digest in an RSASSA-PKCS1-v1_5 signature.
_SHA256_PREFIX = bytes.fromhex("3031300d060960864801650304020105000420")


def _der_item(data: bytes, at: int) -> tuple[bytes, int]:
    size, at = data[at + 1], at + 2
    if size & 0x80:
        n = size & 0x7F
        size, at = int.from_bytes(data[at : at + n], "big"), at + n
    return data[at : at + size], at + size


def rsa_numbers(pem: str) -> tuple[int, int]:
    """Modulus and exponent of a ``PUBLIC KEY`` PEM."""
    lines = [line for line in pem.strip().splitlines() if not line.startswith("-----")]
    outer, _ = _der_item(base64.b64decode("".join(lines)), 0)
    _, after_algorithm = _der_item(outer, 0)
    bits, _ = _der_item(outer, after_algorithm)
    pair, _ = _der_item(bits, 1)
    modulus, after_modulus = _der_item(pair, 0)
    exponent, _ = _der_item(pair, after_modulus)
    return int.from_bytes(modulus, "big"), int.from_bytes(exponent, "big")


def _unpad(part: str) -> bytes:
    return base64.urlsafe_b64decode(part + "=" * (-len(part) % 4))


def signature_holds(token: str, numbers: tuple[int, int] | None) -> bool:
    """RS256 check of a compact token against a key's modulus and exponent."""
    try:
        head, claims, signature = token.split(".")
        modulus, exponent = numbers or (0, 0)
        size = (modulus.bit_length() + 7) // 8
        opened = pow(int.from_bytes(_unpad(signature), "big"), exponent, modulus).to_bytes(size, "big")
    except (ValueError, IndexError):
        return False
    tail = _SHA256_PREFIX + hashlib.sha256(f"{head}.{claims}".encode()).digest()
    return opened == b"\x00\x01" + b"\xff" * (size - len(tail) - 3) + b"\x00" + tail


def _numbers_or_none(pem: str) -> tuple[int, int] | None:
    try:
        return rsa_numbers(pem)
    except (ValueError, IndexError):
        return None


@F.pandas_udf(BooleanType())
def _verified(tokens: pd.Series, keys: pd.Series) -> pd.Series:
    parsed = {k: _numbers_or_none(k) for k in keys.dropna().unique()}  # each key of the batch once
    return pd.Series([bool(t) and signature_holds(t, parsed.get(k)) for t, k in zip(tokens, keys)])


def with_auth_subject(raw: DataFrame, config: PipelineConfig, keys: DataFrame | None = None) -> DataFrame:
    """Add ``collector_auth``: a claim of a valid RS256 token, NULL in every other case.

    The key is the configured one, else the one listed for the token's issuer in ``keys``; of several keys of an issuer
    the last in text order counts. A claim is named as it stands in the token, dots included.
    """
    leeway = config.auth_leeway_seconds
    header = f"{net.headers_map('headers')}['authorization']"
    claims = text.base64_json("get(split(_token, '[.]'), 1)", urlsafe=True)
    algorithm = text.base64_json("get(split(_token, '[.]'), 0)", urlsafe=True)
    df = (
        raw.withColumn("_header", F.expr(header))
        .withColumn("_token", F.expr("CASE WHEN startswith(lower(_header), 'bearer ') THEN get(split(_header, ' '), 1) END"))
        .withColumn("_claims", F.expr(claims))
        .withColumn("_alg", F.expr(f"try_variant_get({algorithm}, '$.alg', 'string')"))
        .withColumn("issuer", F.expr("try_variant_get(_claims, '$.iss', 'string')"))
    )
    if config.auth_public_key:
        df = df.withColumn("issuer_key", F.lit(config.auth_public_key))
    elif keys is not None:
        df = lookup_join(df, keys.groupBy("issuer").agg(F.max("issuer_key").alias("issuer_key")), ["issuer"], config)
    else:
        df = df.withColumn("issuer_key", F.lit(None).cast("string"))
    now = "unix_timestamp(current_timestamp())"
    checks = [
        "_alg = 'RS256'",
        f"coalesce(try_variant_get(_claims, '$.exp', 'double') > {now} - {leeway}, true)",
        f"coalesce(try_variant_get(_claims, '$.nbf', 'double') <= {now} + {leeway}, true)",
        f"coalesce(try_variant_get(_claims, '$.iat', 'double') <= {now} + {leeway}, true)",
    ]
    if config.auth_audience:
        checks.append(f"try_variant_get(_claims, '$.aud', 'string') = {lit(config.auth_audience)}")
    # Rows without a token never reach Python.
    candidate = f"CASE WHEN {' AND '.join(checks)} THEN _token END"
    return (
        df.withColumn("_ok", _verified(F.expr(candidate), F.col("issuer_key")))
        .withColumn(
            "collector_auth", F.expr(f"CASE WHEN _ok THEN try_cast(try_cast(_claims AS MAP<STRING, VARIANT>)[{lit(config.auth_claim)}] AS STRING) END")
        )
        .drop("_header", "_token", "_claims", "_alg", "issuer", "issuer_key", "_ok")
    )
