"""Reusable Column expressions (JVM-side; no Python UDFs)."""

from riskloom.functions.hashing import hash_bucket, key_text
from riskloom.functions.formatting import percent_text, thousands_text

__all__ = ["hash_bucket", "key_text", "percent_text", "thousands_text"]
