"""Deterministic vertex priorities.

A priority is a pure function of its parts (seed, round, vertex id), so a
re-run, a lost executor or a different partitioning gives the same value:
the first 15 hex digits of ``md5('part1:part2:...')`` read as a 60-bit
non-negative BIGINT.  DuckDB computes the same number (``sql_hash_priority``),
which is what lets the oracle SQL replay the Spark runs exactly.

Ties between equal priorities are broken by vertex id (``beats``), so the
order is total and every round of PIVOT / local search makes progress.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Number of hex digits kept from the md5 digest (15 -> 60 bits).
HEX_DIGITS = 15


def _as_col(part) -> Column:
    if isinstance(part, Column):
        return part.cast("string")
    if isinstance(part, str):
        return F.col(part).cast("string")
    return F.lit(str(part))


def hash_priority(*parts, method: str = "md5") -> Column:
    """60-bit priority of the given parts (columns, column names or literals).

    ``method='md5'`` is engine-portable (the oracle reproduces it);
    ``method='xxhash64'`` is faster but Spark-only.
    """
    cols = [_as_col(p) for p in parts]
    if method == "md5":
        digest = F.md5(F.concat_ws(":", *cols))
        return F.conv(F.substring(digest, 1, HEX_DIGITS), 16, 10).cast("bigint")
    if method == "xxhash64":
        return F.shiftright(F.xxhash64(F.concat_ws(":", *cols)), 4).bitwiseAND(F.lit((1 << 60) - 1))
    raise ValueError(f"unknown priority method {method!r}")


def beats(p_a: Column, id_a: Column, p_b: Column, id_b: Column) -> Column:
    """True when ``(p_a, id_a)`` orders strictly before ``(p_b, id_b)``."""
    return (p_a < p_b) | ((p_a == p_b) & (id_a < id_b))


def sql_hash_priority(*parts: str) -> str:
    """The same priority as ``hash_priority`` in DuckDB SQL (parts are SQL expressions)."""
    joined = ", ".join(f"CAST({p} AS VARCHAR)" for p in parts)
    return f"CAST(('0x' || substr(md5(concat_ws(':', {joined})), 1, {HEX_DIGITS})) AS BIGINT)"
