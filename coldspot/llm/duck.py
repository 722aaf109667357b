"""DuckDB SQL fragments shared by the oracle queries."""

# Steps (a list of common table expressions) that give crc32s(s, h): the unsigned crc32 of the
# UTF-8 bytes of each string of a table keys(s). The byte table is made from its polynomial.
CRC32 = r"""
crc_bits(i, v, k) AS (
  SELECT range, range, 0 FROM range(256)
  UNION ALL
  SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM crc_bits WHERE k < 8),
crc_table AS (SELECT i, v FROM crc_bits WHERE k = 8),
crc_state(s, x, i, c) AS (
  SELECT DISTINCT s, hex(s), 1, 4294967295::BIGINT FROM keys
  UNION ALL
  SELECT s, x, crc_state.i + 1, xor(c >> 8, v) FROM crc_state JOIN crc_table
    ON crc_table.i = xor(c, ('0x' || substring(x, 2 * crc_state.i - 1, 2))::BIGINT) & 255
  WHERE 2 * crc_state.i <= length(x)),
crc32s AS (SELECT s, xor(c, 4294967295) AS h FROM crc_state WHERE 2 * (i - 1) = length(x))
"""
