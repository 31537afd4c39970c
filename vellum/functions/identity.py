"""Content hashes and deterministic point ids (native expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Point ids keep the low 63 bits of the md5 of "<file_hash>_<chunk_id>".
LOW63_MASK = 9223372036854775807


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def file_sha256(content: Column | str) -> Column:
    """Hex SHA-256 of the bytes (strings hash as UTF-8)."""
    return F.sha2(_col(content), 256)


def file_md5(content: Column | str) -> Column:
    """Hex MD5 of the bytes (strings hash as UTF-8)."""
    return F.md5(_col(content))


def point_id(file_hash: Column | str, chunk_id: Column | str) -> Column:
    """``int(md5(f"{file_hash}_{chunk_id}"), 16) mod 2**63`` as bigint."""
    key = F.md5(F.concat_ws("_", _col(file_hash), _col(chunk_id).cast("string")))
    signed = F.conv(F.substring(key, 17, 16), 16, -10).cast("bigint")
    return signed.bitwiseAND(F.lit(LOW63_MASK))
