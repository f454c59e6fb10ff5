"""CRC-32 in DuckDB's SQL, for statements that results are compared with."""

from __future__ import annotations

# The reversed polynomial (fixed value).
POLYNOMIAL = 0xEDB88320

# The sums of all single bytes, as a table expression of one row.
BYTES_SQL = f"""crc_bytes AS (SELECT list_transform(range(256), lambda b: list_reduce(range(8),
    lambda c, _: CASE WHEN c % 2 = 1 THEN xor(c // 2, {POLYNOMIAL}) ELSE c // 2 END, b)) AS crc_of)"""


def crc32_sql(text: str) -> str:
    """The unsigned sum of an ASCII text that is not empty; ``crc_bytes`` is in scope."""
    return f"""xor(4294967295, list_reduce(list_transform(string_split({text}, ''), lambda x: ord(x)::BIGINT),
    lambda c, x: xor(c // 256, crc_of[1 + xor(c % 256, x)]), 4294967295::BIGINT))"""
