"""Hash helpers: user pseudonyms, message ids, seeded md5-mod-m, little-endian band keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_TWO_32 = 1 << 32


def user_hash(user_id: Column) -> Column:
    """Unsalted SHA-256 hex of the UTF-8 user id."""
    return F.sha2(user_id, 256)


def message_id(norm: Column) -> Column:
    """MD5 hex of the normalised text."""
    return F.md5(norm)


def hex_mod(hex32: Column, m: int) -> Column:
    """(128-bit big-endian integer of a 32-digit hex string) mod m, for 0 < m < 2**31.

    Folds four 32-bit chunks: acc = (acc * 2**32 + chunk) mod m stays below 2**63.
    """
    if not 0 < m < (1 << 31):
        raise ValueError("modulus must be in (0, 2**31)")
    acc = F.lit(0).cast("bigint")
    for i in range(4):
        chunk = F.conv(F.substring(hex32, 8 * i + 1, 8), 16, 10).cast("bigint")
        acc = (acc * F.lit(_TWO_32) + chunk) % F.lit(m)
    return acc


def md5_mod(text: Column, m: int) -> Column:
    """int(md5(text), 16) mod m."""
    return hex_mod(F.md5(text), m)


def seeded_bits(norm: Column, size: int, num_hashes: int) -> list[Column]:
    """Bloom bit index per seed: int(md5(str(seed) + text)) mod size."""
    return [md5_mod(F.concat(F.lit(str(seed)), norm), size) for seed in range(num_hashes)]


def le_int64_hex(value: Column) -> Column:
    """Hex of the 8 little-endian bytes of a non-negative int64."""
    parts = [F.lpad(F.hex(F.shiftright(value, 8 * j).bitwiseAND(F.lit(255))), 2, "0") for j in range(8)]
    return F.concat(*parts)


def band_key(counts: Sequence[Column], band_id: int = 0) -> Column:
    """"band_<id>_" + sha256 of the packed little-endian int64 counts."""
    packed = F.unhex(F.concat(*[le_int64_hex(c.cast("bigint")) for c in counts]))
    return F.concat(F.lit(f"band_{band_id}_"), F.sha2(packed, 256))


def unit_interval(key: Column, modulus: int = (1 << 31) - 1) -> Column:
    """Deterministic value in (0, 1) from a string key: (md5mod(key, p) + 0.5) / p."""
    return (md5_mod(key, modulus).cast("double") + F.lit(0.5)) / F.lit(float(modulus))


# A 32-digit hex id as three longs (15 + 15 + 2 hex digits, each below 2**63), so aggregates such
# as min_by(id, seq) keep fixed-width buffers and run as hash aggregates instead of sorts.
_HEX_PIECES = ((1, 15), (16, 15), (31, 2))


def hex32_pieces(hex32: Column) -> list[Column]:
    return [F.conv(F.substring(hex32, start, n), 16, 10).cast("bigint") for start, n in _HEX_PIECES]


def hex32_from_pieces(pieces: Sequence[Column]) -> Column:
    return F.lower(F.concat(*[F.lpad(F.hex(p), n, "0") for p, (_, n) in zip(pieces, _HEX_PIECES)]))


def md5_int60(text: Column) -> Column:
    """The first 60 bits of md5(text) as a non-negative long (one base conversion): a cheap
    uniform hash for generator choices, where the exact 128-bit value does not matter."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")
