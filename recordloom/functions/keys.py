"""Identities, digests and buckets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def joined_key(*parts: Column) -> Column:
    """Parts joined by ``@``; null if any part is null."""
    return F.when(~F.greatest(*(p.isNull() for p in parts)) if len(parts) > 1 else parts[0].isNotNull(), F.concat_ws("@", *parts))


def digest(value: Column) -> Column:
    """SHA-256 of the text's UTF-8 bytes, with its kind in front."""
    return F.concat(F.lit("sha256:"), F.sha2(value, 256))


def bucket(key: Column, n: int = 64) -> Column:
    """One of ``n`` buckets (a power of two up to 256) by the first byte of the key's SHA-256."""
    return F.conv(F.substring(F.sha2(key, 256), 1, 2), 16, 10).cast("int") % n
