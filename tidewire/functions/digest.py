"""PBKDF2-HMAC-SHA256 signatures of the two-decimal text of a value."""

from __future__ import annotations

import hashlib
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from tidewire.functions.text import two_decimals
from tidewire.workspace import ship

DIGEST_TEXT = "^[0-9a-f]{64}$"


def salt_text(token: str) -> str:
    """The salt behind a token of ``two_decimals``: only huge and special values need formatting."""
    return token if token[-3:-2] == "." and token[-1].isdigit() else f"{float(token):.2f}"


def digest_udf(key: str, iterations: int):
    """Pandas UDF from salt tokens to hex digests. The key is closed over, never in the plan.

    Equal tokens are hashed once per Python worker while they stay in a bounded cache.
    """
    secret = key.encode("utf-8")
    ship(SparkSession.active())

    @F.pandas_udf("string")
    def digest(tokens: pd.Series) -> pd.Series:
        known = _cached_digest
        return tokens.map(lambda t: None if t is None else known(secret, t, iterations))

    return digest


@lru_cache(maxsize=1 << 18)
def _cached_digest(secret: bytes, token: str, iterations: int) -> str:
    salt = salt_text(token).encode("utf-8")
    return hashlib.pbkdf2_hmac("sha256", secret, salt, iterations).hex()


def hmac_blocks(key: str) -> tuple[str, str]:
    """Hex of the inner and outer 64-byte HMAC key blocks."""
    raw = key.encode("utf-8")
    if len(raw) > 64:
        raw = hashlib.sha256(raw).digest()
    raw = raw.ljust(64, b"\0")
    return bytes(b ^ 0x36 for b in raw).hex(), bytes(b ^ 0x5C for b in raw).hex()


def native_digest(value: Column, key: str) -> Column:
    """The one-iteration digest as a built-in expression: no Python, no shuffle.

    The key blocks are literals, so they show in plans and event logs: use it only for keys that
    may be seen there. Finite values from 2**63 on have no built-in exact text and raise.
    """
    inner, outer = hmac_blocks(key)
    v = value.cast("double")
    # a case per special value keeps the usual one short
    salt = (
        F.when(F.abs(v) < 2.0**63, two_decimals(v))
        .when(F.isnan(v), F.lit("nan"))
        .when(F.abs(v) == float("inf"), F.replace(F.lower(v.cast("string")), F.lit("inity")))
        .when(
            v.isNotNull(),
            F.raise_error(F.lit("value too large for the native digest; use route='table'")),
        )
    )
    first = F.sha2(
        F.concat(F.unhex(F.lit(inner)), F.encode(salt, "UTF-8"), F.unhex(F.lit("00000001"))), 256
    )
    return F.sha2(F.concat(F.unhex(F.lit(outer)), F.unhex(first)), 256)
