"""SQL pieces shared by the statements that the queries are compared with."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lowered_sql(text: str) -> str:
    return f"translate({text}, '{UPPER}', '{LOWER}')"


def crc32_sql(text: str) -> str:
    """CRC-32 of a text's UTF-8 bytes, bit by bit (reflected polynomial 0xEDB88320)."""
    code = f"hex(encode({text}))"
    octets = f"list_transform(range(CAST(length({code}) / 2 AS BIGINT)), lambda i: CAST('0x' || substr({code}, CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT))"
    bits = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, i: xor(x >> 1, (x & 1) * 3988292384))"
    return f"xor(list_reduce(list_concat([4294967295], {octets}), lambda c, b: {bits}), 4294967295)"
