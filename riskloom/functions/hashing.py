"""Deterministic key hashing.

``hash_bucket`` is the basis of the reproducible train/test split and of fold
assignment: a row's bucket depends only on its key text and a salt, never on how the
table is partitioned (unlike ``randomSplit``).  The expression is plain SQL
(md5 → first 7 hex digits → integer), so any engine can recompute it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

HEX_DIGITS = 7  # 28 bits: fits an int and keeps buckets uniform for any modulo used here


def key_text(salt: str, cols: Sequence[str | Column]) -> Column:
    """``salt|k1|k2|...`` with every key part cast to string."""
    parts = [F.col(c) if isinstance(c, str) else c for c in cols]
    return F.concat_ws("|", F.lit(salt), *[p.cast("string") for p in parts])


def hash_value(salt: str, cols: Sequence[str | Column]) -> Column:
    """Integer in [0, 16^7) derived from md5 of the salted key text."""
    digest = F.md5(key_text(salt, cols))
    return F.conv(F.substring(digest, 1, HEX_DIGITS), 16, 10).cast("bigint")


def hash_bucket(salt: str, cols: Sequence[str | Column], modulo: int) -> Column:
    """Bucket in [0, modulo) of the salted key."""
    return (hash_value(salt, cols) % F.lit(modulo)).cast("int")
