"""Text and number cleaning as SQL expressions over built-in functions."""

from __future__ import annotations

from leadlens.functions.shapes import text

# Tokens a CSV cell may hold instead of a value.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
)

# The characters that count as white space, beyond the blank that ``trim`` takes.
_SPACES = "".join(map(chr, (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
# Fixed value: the characters a plain decimal number is made of. The cast alone would also take
# 12d, 0x1p3, NaN and Infinity.
_NUMBER = r"^[-+.0-9eE\s]+$"


def is_token(cell: str) -> str:
    return f"{cell} IN ({', '.join(map(text, NA_TOKENS))})"


def stripped(cell: str) -> str:
    """Without white space of any kind at either end. A cell that begins and ends with a visible
    ASCII character, as almost all do, skips the slower search for white space."""
    return f"CASE WHEN {cell} RLIKE r'^[!-~](.*[!-~])?\\z' THEN {cell} ELSE btrim({cell}, {text(_SPACES)}) END"


def present(cell: str) -> str:
    """The stripped cell, NULL when it holds an NA token; tokens are compared before stripping."""
    return f"CASE WHEN NOT ({is_token(cell)}) THEN {stripped(cell)} END"


def finite(column: str) -> str:
    """NULL for NaN and infinities; NaN compares above every number in Spark. Give it a column, not
    a computation, which it would repeat."""
    return f"CASE WHEN abs({column}) < double('inf') THEN {column} END"


def parsed(cell: str) -> str:
    """The text as a double, NULL unless the whole text is a number; an overflow gives infinity."""
    return f"CASE WHEN {cell} RLIKE r'{_NUMBER}' THEN try_cast({cell} AS DOUBLE) END"
