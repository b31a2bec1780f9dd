"""MD5 as hex text and as an unsigned 128-bit integer reduced to a bucket."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def md5_hex(s: Column) -> Column:
    """Lower-case 32-digit MD5 of the UTF-8 bytes (FN-10)."""
    return F.md5(F.encode(s, "UTF-8"))


def md5_bucket(s: Column, n: int) -> Column:
    """(MD5 read as a big-endian unsigned 128-bit integer) mod ``n`` (FN-11).

    Spark has no 128-bit integer, so the value is split into two 64-bit halves,
    each exact as ``decimal(20,0)``: ``(hi * 2^64 + lo) mod n``.
    """
    h = md5_hex(s)
    hi = F.conv(F.substring(h, 1, 16), 16, 10).cast("decimal(20,0)")
    lo = F.conv(F.substring(h, 17, 16), 16, 10).cast("decimal(20,0)")
    two64_mod = F.lit(pow(2, 64, n)).cast("decimal(20,0)")
    nn = F.lit(n).cast("decimal(20,0)")
    return (((hi % nn) * two64_mod + (lo % nn)) % nn).cast("bigint")
