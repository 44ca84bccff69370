"""Seeded random draws that depend on row identity only.

``rand()`` depends on how rows are partitioned, so a retried task or another
cluster size would change the result. A hash of (seed, row key) does not.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BITS = 48  # 12 hexadecimal digits of the digest


def unit(*parts) -> Column:
    """Uniform number in the open interval (0, 1) from the digest of ``parts``."""
    text = F.concat_ws("|", *[_as_column(p).cast("string") for p in parts])
    digits = F.conv(F.substring(F.md5(text.cast("binary")), 1, 12), 16, 10)
    return (digits.cast("double") + F.lit(0.5)) / F.lit(float(2**BITS))


def below(n, *parts) -> Column:
    """Uniform BIGINT in [0, n)."""
    return F.floor(unit(*parts) * _as_column(n)).cast("bigint")


def choice(values: list[str], *parts) -> Column:
    """Uniform pick from a short list of strings."""
    pool = F.array(*[F.lit(v) for v in values])
    return F.get(pool, below(len(values), *parts).cast("int"))


def _as_column(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)
