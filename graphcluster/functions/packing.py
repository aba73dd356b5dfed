"""Ordered pairs of integers as one decimal.

``min`` over a struct plans a sort-based aggregate; ``min`` over a decimal is a
hash aggregate with a map-side combine.  A pair ``(key, id)`` becomes
``key * 2**64 + (id + 2**63)``, which orders like the pair and holds any BIGINT
id and any key from 0 to 2**62 in a DECIMAL(38, 0).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPAN, _HALF = 1 << 64, 1 << 63
_SHORT = 1 << 31       # pairs of numbers from -_SHORT to _SHORT - 1 fit a BIGINT
KEY_OFFSET = 1 << 61   # added to keys that may be negative


def _dec(value: int) -> Column:
    return F.lit(str(value)).cast("decimal(20,0)")


def pack(key: Column, ident: Column) -> Column:
    """The pair as DECIMAL(38, 0); NULL if either is."""
    return (key.cast("decimal(19,0)") * _dec(_SPAN)
            + (ident.cast("decimal(20,0)") + _dec(_HALF))).cast("decimal(38,0)")


def packed_id(pair: Column) -> Column:
    """The id of a packed pair."""
    return (pair % _dec(_SPAN) - _dec(_HALF)).cast("bigint")


def packed_key(pair: Column) -> Column:
    """The key of a packed pair."""
    low = pair % _dec(_SPAN)
    return ((pair - low).cast("decimal(38,0)") / _dec(_SPAN)).cast("bigint")


def least_pair(key: Column, ident: Column, keep: Column) -> Column:
    """Aggregate: the smallest pair ``(KEY_OFFSET + key, ident)`` of the rows with ``keep``,
    packed as by ``pack``; ``key`` and ``ident`` are BIGINTs, NULLs are left out."""
    fits = key.between(-_SHORT, _SHORT - 1) & ident.between(-_SHORT, _SHORT - 1)
    short = F.min(F.when(keep & fits, F.shiftleft(key, 32) + (ident + F.lit(_SHORT))))
    wide = F.min(F.when(keep & ~fits, pack(F.lit(KEY_OFFSET) + key, ident)))
    low = short.bitwiseAND(F.lit((1 << 32) - 1))
    return F.least(pack(F.lit(KEY_OFFSET) + F.shiftright(short, 32), low - F.lit(_SHORT)), wide)
