"""SQL fragments that several SQL twins share."""

from __future__ import annotations

#: A table ``crc_table(t)`` of one list, for ``crc32_sql``; the polynomial is a fixed value.
CRC_TABLE = """crc_table AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v
    FROM range(256) AS r(i)))"""


def crc32_sql(text: str) -> str:
    """Unsigned CRC-32 of an ASCII text, where ``crc_table`` is in scope."""
    codes = f"list_transform(string_split({text}, ''), lambda c: ord(c)::BIGINT)"
    step = "lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), {step}), 4294967295)"
