"""Hash expressions that give the same value on every engine."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from millrace.functions.arrays import bind


def md5_bucket(text: Column, buckets: int) -> Column:
    """The MD5 digest, read as one big-endian number, modulo `buckets`.

    The 128-bit number does not fit a decimal, so the 32 hex digits are folded eight
    at a time; the running remainder stays below 2**31 * 2**32. For a power of two the
    last eight digits alone decide.
    """
    if not 0 < buckets < 2**31:
        raise ValueError("buckets must lie between 1 and 2**31 - 1")
    starts = (25,) if buckets & (buckets - 1) == 0 else (1, 9, 17, 25)

    def fold(digest: Column) -> Column:
        remainder = F.lit(0).cast("bigint")
        for start in starts:
            digits = F.conv(F.substring(digest, start, 8), 16, 10).cast("bigint")
            remainder = (remainder * F.lit(2**32) + digits) % F.lit(buckets)
        return remainder.cast("int")

    return bind(F.md5(text), fold)


def unit_interval(*keys: Column) -> Column:
    """A repeatable number in [0, 1) for a row's key."""
    digest = F.md5(F.concat_ws("|", *[key.cast("string") for key in keys]))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(float(2**32))
