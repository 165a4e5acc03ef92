"""Expressions used by several operators, as Spark SQL text.

Text keeps plan building cheap: one call to the JVM per projection instead of one per function.
"""

from __future__ import annotations

from zlib import crc32

# Hash range: a prime below 2^31, so every product below stays within a bigint.
HASH_RANGE = 2 ** 31 - 1


def ratio(num: str, den: str, default: str = "0.0D") -> str:
    """num / den, `default` where the denominator is 0 or either side is missing."""
    return f"coalesce(try_divide(cast({num} as double), cast({den} as double)), {default})"


def no_nan(col: str) -> str:
    """NaN read as missing, so that aggregates skip it."""
    return f"nanvl({col}, null)"


def key_hash(key: str, seed: int, copy: str = "0", purpose: str = "") -> str:
    """Deterministic hash of a key >= 0 (and a copy number) in [0, HASH_RANGE), never NULL.

    Plain bigint arithmetic: it stays inside generated code, costs a few nanoseconds, and any engine can repeat it.
    """
    salt = crc32(f"{purpose}|{seed}".encode()) % HASH_RANGE
    base = f"((({key} & 2147483647) * 902433191 + shiftright({key}, 31) * 1048573 + {copy} * 715827883 + {salt}L) % {HASH_RANGE}L)"
    first = f"((({base} ^ shiftright({base}, 15)) * 1597334677L) % {HASH_RANGE}L)"
    return f"coalesce((({first} ^ shiftright({first}, 13)) * 747796405L) % {HASH_RANGE}L, 0L)"


def key_unit(key: str, seed: int, copy: str = "0", purpose: str = "") -> str:
    """Deterministic value in [0, 1)."""
    return f"({key_hash(key, seed, copy, purpose)} / {HASH_RANGE}.0D)"


def log_bucket(col: str, per_fold: int = 2048) -> str:
    """Coarse order-preserving integer key for values of any size: equal steps of ln(1+|x|)."""
    return f"cast(signum({col}) * floor(log1p(abs({col})) * {per_fold}) as bigint)"


def logit_bucket(col: str, per_fold: int = 2048) -> str:
    """Coarse order-preserving integer key for probabilities: equal steps of the log odds."""
    odds = f"try_divide({col}, 1.0D - {col})"
    return (f"cast(case when {col} <= 0 then -2000000 when {col} >= 1 then 2000000 "
            f"else floor(ln({odds}) * {per_fold}) end as bigint)")
