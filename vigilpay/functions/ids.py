"""Stable identifiers and hashes as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def name_uuid(text: Column) -> Column:
    """Version-3 UUID of a text without a namespace (the MD5 digest, with version and variant set)."""
    digest = F.md5(text.cast("binary"))
    part = lambda start, length: F.substring(digest, start, length)
    variant = F.translate(part(17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat(
        part(1, 8), F.lit("-"), part(9, 4), F.lit("-3"), part(14, 3), F.lit("-"),
        variant, part(18, 3), F.lit("-"), part(21, 12),
    )


def stable_id(*parts: Column) -> Column:
    return name_uuid(F.concat_ws("|", *parts))


def stable_hash(text: Column, length: int = 16) -> Column:
    """First ``length`` hex digits of the SHA-256 of the UTF-8 text."""
    return F.substring(F.sha2(text.cast("binary"), 256), 1, length)


def stable_int(text: Column, modulo: int) -> Column:
    """A text's hash as an integer in ``[0, modulo)``."""
    return F.conv(stable_hash(text, 8), 16, 10).cast("bigint") % F.lit(modulo)
