"""Stable hashing of a person key: md5 gives the same number in every engine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


HASH_BITS = 60


def hash_whole(key: Column | str, *salts: Column | str) -> Column:
    """First 60 bits of md5(key|salt…)."""
    key = F.col(key) if isinstance(key, str) else key
    parts = [key.cast("string")] + [F.lit(s) if isinstance(s, str) else s.cast("string") for s in salts]
    head = F.substring(F.md5(F.concat_ws("|", *parts)), 1, 15)
    return F.conv(head, 16, 10).cast("bigint")


def hash_mod(key: Column | str, n: int, *salts: Column | str) -> Column:
    """``hash_whole`` modulo n."""
    return F.pmod(hash_whole(key, *salts), F.lit(n))


def arm(key: Column | str, salt: str) -> Column:
    """Treated or control, half and half, fixed for life."""
    return F.when(hash_mod(key, 2, salt) == 0, F.lit("treated")).otherwise(F.lit("control"))
