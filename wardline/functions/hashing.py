"""Seeded hash order. Any SQL engine with md5 reproduces it exactly.

``hash_hex`` orders rows pseudo-randomly; ``hash_int`` is its first 60 bits and
``hash_unit`` the same as a number in [0, 1).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEED = 42


def _col(part) -> Column:
    return part if isinstance(part, Column) else F.lit(part)


def hash_hex(*parts) -> Column:
    return F.md5(F.concat_ws("|", *[_col(p).cast("string") for p in parts]))


def hash_int(*parts) -> Column:
    return F.conv(F.substring(hash_hex(*parts), 1, 15), 16, 10).cast("bigint")


def hash_unit(*parts) -> Column:
    return hash_int(*parts).cast("double") / F.lit(float(2**60))


def sql_hash_hex(*parts: str) -> str:
    """The same in portable SQL; every part is a SQL expression."""
    texts = [f"CAST({p} AS VARCHAR)" for p in parts]
    return "md5(" + " || '|' || ".join(texts) + ")"


def sql_hash_int(*parts: str) -> str:
    return f"CAST('0x' || substr({sql_hash_hex(*parts)}, 1, 15) AS BIGINT)"


def sql_hash_unit(*parts: str) -> str:
    return f"(CAST({sql_hash_int(*parts)} AS DOUBLE) / 1152921504606846976.0::DOUBLE)"
