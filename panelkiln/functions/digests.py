"""Order-free content digests that aggregate in parts.

A digest over a set is a count and two sums of 60-bit slices of each member's
SHA-1. Sums merge, so Spark combines them map-side and no task ever holds the
members of a group; two different sets agree only if 120 hash bits collide.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_SLICE = 15  # hex digits, so a slice fits a signed 64-bit integer


def sha1_prefix(value: Column, length: int = 12) -> Column:
    return F.substring(F.sha1(value.cast("binary")), 1, length)


def _slice(digest: Column, position: int) -> Column:
    piece = F.substring(digest, position, _SLICE)
    return F.conv(piece, 16, 10).cast("decimal(38,0)")


def set_digest(member: Column) -> Column:
    """Aggregate: hex digest of the multiset of ``member`` values in the group."""
    digest = F.sha1(F.coalesce(member, F.lit("")).cast("binary"))
    parts = F.concat_ws(
        ":",
        F.count(F.lit(1)).cast("string"),
        F.sum(_slice(digest, 1)).cast("string"),
        F.sum(_slice(digest, 1 + _SLICE)).cast("string"),
    )
    return F.sha1(parts.cast("binary"))
